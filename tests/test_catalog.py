"""The catalog against its SQL twins, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from landfall.operators.splitting import split_plan
from oracle import compare, connect

pytest.importorskip("duckdb")


@pytest.fixture(scope="module")
def con(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables here")
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_twin(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_split_plan_of_the_table_files(spark, sf_dir):
    rows = split_plan(spark, f"{sf_dir}/*.parquet", threshold_kb=100, target_kb=64).collect()
    assert {os.path.basename(r.path) for r in rows} == {f for f in os.listdir(sf_dir) if f.endswith(".parquet")}
    for r in rows:
        assert r.length == os.path.getsize(f"{sf_dir}/{os.path.basename(r.path)}")
        assert r.parts == max(1, int(r.length / 1024 / 64 + 0.999)) and r.split == (r.length // 1024 > 100)


def test_every_query_has_columns_to_compare(spark, sf_dir):
    for name, run in entry.queries().items():
        if name.startswith(("intake", "split", "xml_files", "json_array", "header", "raw_line")):
            continue
        columns = run(spark, sf_dir).columns
        assert len(columns) == len(set(columns)), name
