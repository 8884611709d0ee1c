"""Quoted records across line ends, however the file is cut."""

import gzip
import random

import pytest

from landfall import Policy
from landfall.contract import Contract, FieldRule
from landfall.operators.splitting import part_manifest, split_files
from landfall.sources import read_feed
from landfall.sources.quoted import quote_states, quoted_records


def plain_records(text):
    """Records of a whole text, a character at a time."""
    out, start, begun, inside, at_start, i = [], 0, 0, False, True, 0
    while i < len(text):
        c = text[i]
        if inside:
            if c == '"' and text[i + 1 : i + 2] == '"':
                i += 1
            elif c == '"':
                inside = False
        elif c == "\n":
            out.append(text[start:i])
            start, at_start = i + 1, True
        elif c == '"' and at_start:
            inside, at_start = True, False
        else:
            at_start = c == ","
        i += 1
    rest = text[start:]
    if inside:
        rest = rest.removesuffix("\n")
        out += rest.split("\n")
    elif rest:
        out.append(rest)
    return [r.removesuffix("\r") for r in out]


def session_of(spark, size):
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    session.conf.set("spark.sql.files.openCostInBytes", "1")
    return session


def random_text(rng, n):
    pieces = ['"', '"', '""', ",", ",", "\n", "\r\n", "a", "é", '"b\nc"', ',"x', '",', "long text "]
    return "".join(rng.choice(pieces) for _ in range(n))


def test_states_of_a_line():
    outside, inside = quote_states(",", '"')
    assert [outside(x) for x in ('a,b', '"a', '"a"', 'a"b', '"a""', '"a""",x', 'x,"y', '"a"b"', '"a","b', '')] == [
        False, True, False, False, True, False, True, False, True, False,
    ]
    assert [inside(x) for x in ("a", 'a"', 'a""', 'a",b', 'a","b', '"', "", '""",x', '"",x', '"x"')] == [
        True, False, True, False, True, False, True, False, True, False,
    ]
    assert quote_states("||", "'")[0]("a||'b|") and not quote_states("||", "'")[0]("a|'b")


@pytest.mark.parametrize("size", [1, 2, 7, 19, 100_000])
def test_records_of_random_files(spark, tmp_path, size):
    rng = random.Random(size)
    wanted = []
    for k in range(6):
        text = random_text(rng, 45)
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
        wanted += plain_records(text)
    got = [r.value for r in quoted_records(session_of(spark, size), str(tmp_path), ",", '"').collect()]
    assert sorted(got) == sorted(wanted)


def test_compressed_and_plain_are_equal(spark, tmp_path):
    text = random_text(random.Random(0), 400)
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(text.encode()))
    got = [r.value for r in quoted_records(spark, str(tmp_path), ",", '"').collect()]
    assert got == plain_records(text)


FEED = Contract((FieldRule("a"), FieldRule("b"), FieldRule("c")), quote='"')


@pytest.mark.parametrize("size", [9, 100_000])
def test_feed_with_line_ends_in_values(spark, tmp_path, size):
    (tmp_path / "x.csv").write_text('"a","b","c"\n1,"two\nlines",x\r\n2,"crlf\r\n""in"" quotes",y\n3,in"ch,z\n4,"5"" by 6",w\n')
    got = read_feed(session_of(spark, size), str(tmp_path), FEED).select("a", "b", "c", "_error.reason").collect()
    assert sorted(tuple(r) for r in got) == [
        ("1", "two\nlines", "x", None), ("2", 'crlf\r\n"in" quotes', "y", None), ("3", 'in"ch', "z", None), ("4", '5" by 6', "w", None),
    ]


@pytest.mark.parametrize("size", [5, 100_000])
def test_a_quote_that_never_closes_costs_its_line(spark, tmp_path, size):
    (tmp_path / "x.csv").write_text('1,"a\nb",x\n2,"open,y\n' + "".join(f"{k},b,c\n" for k in range(3, 40)))
    for policy, torn in ((Policy(), "unbalanced quote"), (Policy.lenient(), None)):
        c = Contract(FEED.fields, quote='"', has_header=False, policy=policy)
        got = read_feed(session_of(spark, size), str(tmp_path), c).select("a", "b", "c", "_error.reason").collect()
        assert sorted((tuple(r) for r in got), key=lambda r: int(r[0])) == [
            ("1", "a\nb", "x", None), ("2", '"open', "y", torn), *[(str(k), "b", "c", None) for k in range(3, 40)],
        ]


def test_parts_hold_whole_records(spark, tmp_path):
    rows = [f'{k},"line {k}\nnext ""{k}""",{"z" * (k % 50)}' for k in range(400)]
    (tmp_path / "in.csv").write_text("\n".join(["a,b,c", *rows]) + "\n")
    out = str(tmp_path / "parts")
    manifest = split_files(spark, str(tmp_path / "in.csv"), FEED, out, target_kb=2).collect()
    assert len(manifest) > 5 and sum(r.rows for r in manifest) == 400
    assert sorted(map(tuple, manifest)) == sorted(map(tuple, part_manifest(spark, out, FEED).collect()))
    got = read_feed(spark, out, FEED).filter("_error IS NULL").select("a", "b").collect()
    assert sorted(tuple(r) for r in got) == sorted((str(k), f'line {k}\nnext "{k}"') for k in range(400))
