"""Whole runs over small files of each format."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import boats
from landfall import Policy, parse_contract
from landfall.operators import audit
from landfall.operators.protect import decrypt_columns
from landfall.functions.crypto import key_column
from landfall.plans.intake import IntakeJob, loaded_rows, read_landing, rejected_rows, run_intake
from landfall.streaming import land_new_files

CSV = boats.descriptor("CSV", delimiter=",", csv_header=True)
JSON = boats.descriptor("JSON", encrypt=("phone", "fee", "emergency_contact"), is_json_array=True)
XML = boats.descriptor(
    "XML", encrypt=("phone", "fee", "emergency_contact"), optional=("owner", "notes"), row_tag="boat"
)

# name: (content, descriptor, lenient: valid and errors, strict: valid and errors)
GOLDEN = {
    "boats.csv": (
        boats.csv_file(), CSV,
        (2, [("VALIDATION_ERROR", "code", "empty")] * 2),
        (1, [("BLANK_ROW", "", ""), ("PARSE_ERROR", "", "12 values for 11 fields"),
             ("VALIDATION_ERROR", "code", "empty")]),
    ),
    "boats.json": (
        boats.json_file(), JSON,
        (2, [("VALIDATION_ERROR", "owner", "empty")]),
        (2, [("VALIDATION_ERROR", "owner", "empty")]),
    ),
    "boats.xml": (boats.xml_file(), XML, (3, []), (3, [])),
    "boats.txt": (boats.fixed_file(), boats.fixed_descriptor(), (3, []), (3, [])),
    "bad.csv": (
        boats.OTHER_CSV, CSV, (3, [("VALIDATION_ERROR", "code", "empty")]), None,
    ),
    "errors.csv": (
        boats.GAPS_CSV, CSV,
        (2, [("VALIDATION_ERROR", "code", "empty"), ("VALIDATION_ERROR", "hull", "empty"),
             ("VALIDATION_ERROR", "owner", "empty")]),
        None,
    ),
}


def job(tmp_path, name, text, contract, key, record_count=None, run="run-1"):
    (tmp_path / name).write_text(text)
    control = None
    if record_count is not None:
        control = tmp_path / "feed.properties"
        control.write_text(f"# delivered\n\nrecord_count={record_count}\n")
    return IntakeJob(
        [str(tmp_path / name)], contract, str(tmp_path / "table"), str(tmp_path / "audit"),
        control and str(control), key, run,
    )


@pytest.mark.parametrize("name", GOLDEN)
@pytest.mark.parametrize("strict", [False, True])
def test_golden_outcomes(spark, tmp_path, aes_key, name, strict):
    text, descriptor, lenient, strictly = GOLDEN[name]
    want = strictly if strict else lenient
    if want is None:
        pytest.skip("this layout has its own contract")
    contract = parse_contract(descriptor, Policy() if strict else Policy.lenient())
    result = run_intake(spark, job(tmp_path, name, text, contract, aes_key, 3))
    rejected = rejected_rows(spark, str(tmp_path / "table"), contract)
    found = sorted((r.error_type, r.field, r.reason) for r in rejected.collect())
    assert (result.actual_count, found) == want
    assert result.error_count == len(found)
    passed = want[0] == 3
    assert result.status == ("PASSED" if passed else "FAILED")
    if not passed:
        n = want[0]
        assert result.failure_reason == (
            f"Record count mismatch! Expected: 3, Actual: {n}, Difference: {n - 3}"
        )


@pytest.mark.parametrize("name", ["boats.json", "boats.xml", "boats.txt", "boats.csv"])
def test_loaded_values(spark, tmp_path, aes_key, name):
    contract = parse_contract(GOLDEN[name][1])
    run_intake(spark, job(tmp_path, name, GOLDEN[name][0], contract, aes_key))
    rows = loaded_rows(spark, str(tmp_path / "table"), contract)
    sealed = [f.warehouse_name for f in contract.encrypted if f.encrypt == "value" and f.name != "emergency_contact"]
    assert sealed == ["phone_encrypted", "fee_encrypted"]
    one = decrypt_columns(rows, sealed, key_column(spark, aes_key)).orderBy("code").first()
    who = boats.boat(1)
    assert one.code == who["code"]
    assert one.phone_encrypted == who["phone"]
    assert one.fee_encrypted == str(who["fee"])
    assert one.afloat == "false"
    assert one.execution_id == "run-1"
    assert one.source_creation_time is not None and one.ingestion_timestamp is not None
    if name == "boats.json":
        contact = json.loads(one.emergency_contact)
        assert contact["who"] == "Jo Brand" and contact["phone"] != who["emergency_contact"]["phone"]
        assert json.loads(one.skills) == ["mast", "keel"]
        assert json.loads(one.address)["town"] == "Emden"
    if name == "boats.csv":
        assert json.loads(one.skills) == ["mast", "keel"]
        assert json.loads(one.address) == {"raw": '"Pier Emden"'}
    if name == "boats.xml":
        plain = decrypt_columns(rows, ["emergency_contact"], key_column(spark, aes_key))
        assert json.loads(plain.orderBy("code").first().emergency_contact)["who"] == "Jo Brand"
    if name == "boats.txt":
        assert json.loads(one.emergency_contact)["phone"] != who["emergency_contact"]["phone"]


def test_no_secret_is_readable(spark, tmp_path, aes_key):
    contract = parse_contract(CSV)
    run_intake(spark, job(tmp_path, "boats.csv", boats.csv_file(), contract, aes_key))
    stored = " ".join(
        str(r) for r in read_landing(spark, str(tmp_path / "table"), contract).collect()
    )
    for i in range(1, 5):
        assert boats.boat(i)["phone"] not in stored
    raw = read_landing(spark, str(tmp_path / "table"), contract).filter("outcome = 'error'").select("raw_record")
    texts = {r[0] for r in decrypt_columns(raw, ["raw_record"], key_column(spark, aes_key)).collect()}
    assert "," * 9 in texts and len(texts) == 3


def test_nothing_secret_without_a_key(spark, tmp_path):
    fields = {"a": {"sensitive": True}, "b": {"required": True}}
    contract = parse_contract(json.dumps({"format": "CSV", "csv_header": False, "fields": fields}))
    run_intake(spark, job(tmp_path, "s.csv", "BBB-22,\nx,y,CCC-33\n", contract, None))
    stored = str(read_landing(spark, str(tmp_path / "table"), contract).collect())
    assert "BBB-22" not in stored and "CCC-33" not in stored


@pytest.mark.parametrize("fmt", ["JSON", "CSV"])
def test_every_kind_of_secret_is_sealed(spark, tmp_path, aes_key, fmt):
    """Lists, objects without a phone, optional and absent values; all come back."""
    fields = {n: {"encrypt": True, "sensitive": True} for n in ("skills", "address", "plain")} | {"id": {"required": True}}
    contract = parse_contract(json.dumps({"format": fmt, "csv_header": False, "fields": fields}))
    text = '{"skills": ["SEC-1"], "address": {"p": "SEC-2"}, "id": 1}\n' if fmt == "JSON" else "SEC-1;SEC-4,SEC-2,,1\n"
    run_intake(spark, job(tmp_path, "s.txt", text, contract, aes_key))
    row = loaded_rows(spark, str(tmp_path / "table"), contract)
    assert "SEC-" not in str(row.collect()) and row.count() == 1
    names = [f.warehouse_name for f in contract.encrypted if not (fmt == "CSV" and f.name == "address")]
    plain = str(decrypt_columns(row, names, key_column(spark, aes_key)).collect())
    assert "SEC-1" in plain and (fmt == "CSV" or "SEC-2" in plain)


def test_second_attempt_replaces_the_first(spark, tmp_path, aes_key):
    contract = parse_contract(CSV, Policy.lenient())
    run_intake(spark, job(tmp_path, "boats.csv", boats.csv_file(), contract, aes_key, 3))
    good = "\n".join(boats.csv_line(boats.boat(i)) for i in (1, 2, 3))
    result = run_intake(spark, job(tmp_path, "boats.csv", good, contract, aes_key, 3))
    assert (result.actual_count, result.error_count, result.status) == (3, 0, "PASSED")
    run_intake(spark, job(tmp_path, "boats.csv", good, contract, aes_key, run="run/2 x"))
    counts = {
        r.execution_id: r["count"]
        for r in loaded_rows(spark, str(tmp_path / "table"), contract).groupBy("execution_id").count().collect()
    }
    assert counts == {"run-1": 3, "run/2 x": 3}
    state = audit.run_states(audit.read_events(spark, str(tmp_path / "audit"))).filter("execution_id = 'run-1'").first()
    assert (state.status, state.expected_count, state.actual_count) == ("PASSED", 3, 3)
    assert state.failure_reason.startswith("Record count mismatch!")
    assert state.file_name == "boats.csv"


def test_problem_is_logged_and_raised(spark, tmp_path, aes_key):
    contract = parse_contract(CSV)
    bad = job(tmp_path, "boats.csv", boats.csv_file(), contract, aes_key)
    bad = IntakeJob([str(tmp_path / "gone.csv")], contract, bad.location, bad.audit_dir, None, aes_key, "run-9")
    with pytest.raises(Exception):
        run_intake(spark, bad)
    states = audit.run_states(audit.read_events(spark, bad.audit_dir))
    report = audit.failure_report(states).first()
    assert report.execution_id == "run-9" and report.status == "FAILED" and len(report.failure_reason) <= 1000


@pytest.mark.parametrize("fmt", ["CSV", "JSON"])
def test_odd_field_names(spark, tmp_path, aes_key, fmt):
    names = ["a b", "x.y", "it's", "select", "Ä"]
    fields = {n: {"required": True, "max_length": 9, "encrypt": n == "x.y"} for n in names}
    contract = parse_contract(json.dumps({"format": fmt, "fields": fields}))
    rows = [["1", "2", "3", "4", "5"], ["1", "2", "", "4", "5"]]
    if fmt == "CSV":
        text = "\n".join(",".join(r) for r in rows)
    else:
        text = "\n".join(json.dumps(dict(zip(names, r))) for r in rows)
    result = run_intake(spark, job(tmp_path, "odd.txt", text, contract, aes_key))
    assert (result.actual_count, result.error_count) == (1, 1)
    good = loaded_rows(spark, str(tmp_path / "table"), contract, "run-1").first().asDict()
    assert [good[n] for n in ("a b", "it's", "select", "Ä")] == ["1", "3", "4", "5"] and len(good["x.y_encrypted"]) > 30
    assert rejected_rows(spark, str(tmp_path / "table"), contract, "run-1").first().field == "it's"


def test_database_target(spark, tmp_path, aes_key, monkeypatch):
    """With the two database calls replaced by a Parquet table: what is loaded, counted and refused."""
    from landfall.operators.sinks import JdbcTable
    from landfall.plans import intake

    store = str(tmp_path / "db")
    contract = parse_contract(CSV, Policy.lenient())

    def stored(spark, target, execution_id):
        try:
            return spark.read.parquet(store).filter(F.col("execution_id") == execution_id).count()
        except Exception:
            return 0

    monkeypatch.setattr(intake, "loaded_in_jdbc", stored)
    monkeypatch.setattr(intake, "append_jdbc", lambda df, target: df.write.mode("append").parquet(store))
    run = replace(
        job(tmp_path, "boats.csv", boats.csv_file(), contract, aes_key, 2), database=JdbcTable("u", "stg", "a", "b")
    )
    assert run_intake(spark, run).status == "PASSED"
    columns = spark.read.parquet(store).columns
    assert columns[-3:] == ["ingestion_timestamp", "execution_id", "source_creation_time"] and len(columns) == 14
    with pytest.raises(ValueError, match="already holds"):
        run_intake(spark, replace(run, paths=[str(tmp_path / "gone.csv")]))
    assert spark.read.parquet(store).count() == 2
    assert loaded_rows(spark, run.location, contract, run.execution_id).count() == 2  # the landing table still agrees


def test_many_files_are_one_run(spark, tmp_path, aes_key):
    contract = parse_contract(CSV)
    paths = []
    for i in range(5):
        p = tmp_path / f"part{i}.csv"
        p.write_text(",".join(boats.FIELDS) + "\n" + boats.csv_line(boats.boat(i)) + "\n\n")
        paths.append(str(p))
    run = IntakeJob(paths, contract, str(tmp_path / "t"), str(tmp_path / "a"), None, aes_key, "r")
    result = run_intake(spark, run)
    assert (result.actual_count, result.error_count) == (5, 5)
    landed = read_landing(spark, str(tmp_path / "t"), contract)
    assert landed.select(F.countDistinct("source_file")).first()[0] == 5


def test_landing_needs_no_shuffle(spark, tmp_path, aes_key):
    from landfall.plans.intake import landing_rows
    from landfall.sources import read_feed

    (tmp_path / "f.csv").write_text(boats.csv_file())
    contract = parse_contract(CSV)
    import datetime

    rows = landing_rows(
        read_feed(spark, str(tmp_path / "f.csv"), contract), contract, "r",
        datetime.datetime.now(datetime.timezone.utc), key_column(spark, aes_key),
    )
    plan = rows._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan and aes_key not in plan


def test_stream_lands_each_file_once(spark, tmp_path, aes_key):
    contract = parse_contract(CSV)
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def run():
        q = land_new_files(
            spark, str(inbox), contract, str(tmp_path / "t"), "s", str(tmp_path / "cp"), aes_key
        )
        q.awaitTermination(120)
        return loaded_rows(spark, str(tmp_path / "t"), contract).count()

    (inbox / "a.csv").write_text(boats.csv_file())
    assert run() == 1
    (inbox / "b.csv").write_text("\n".join(boats.csv_line(boats.boat(i)) for i in (5, 6)))
    assert run() == 3
    assert run() == 3
    runs = loaded_rows(spark, str(tmp_path / "t"), contract).select("execution_id").distinct().collect()
    assert {r[0] for r in runs} == {"s-0", "s-1"}


def test_text_report_of_bad_rows(spark, tmp_path, aes_key):
    contract = parse_contract(CSV)
    run = replace(job(tmp_path, "boats.csv", boats.csv_file(), contract, aes_key), report_dir=str(tmp_path / "report"))
    run_intake(spark, run)
    report = "\n".join(r.value for r in spark.read.text(f"{run.report_dir}/execution_id={run.execution_id}").collect())
    assert report.count("Message") == 3 and "12 values for 11 fields" in report


def test_a_run_changes_no_setting(spark, tmp_path, aes_key):
    before = spark.conf.getAll
    run_intake(spark, job(tmp_path, "boats.csv", boats.csv_file(), parse_contract(CSV), aes_key))
    assert spark.conf.getAll == before


def test_encrypted_json_is_cleansed_and_keeps_its_numbers(spark, tmp_path, aes_key):
    fields = {"t": {}, "s": {"encrypt": True}, "o": {"encrypt": True}, "n": {"encrypt": True}, "big": {"encrypt": True}, "plain": {}}
    contract = parse_contract(json.dumps({"format": "JSON", "fields": fields}))
    big = "1" * 42
    text = '{"t": "a\\u007cnull|b", "s": "a|null|b", "o": {"x": ["c||d"]}, "n": 1.0, "big": %s, "plain": 1.0}\n' % big
    run_intake(spark, job(tmp_path, "s.json", text, contract, aes_key))
    sealed = [f.warehouse_name for f in contract.encrypted]
    row = decrypt_columns(loaded_rows(spark, str(tmp_path / "table"), contract), sealed, key_column(spark, aes_key)).first()
    assert (row.t, row.s_encrypted, row.o_encrypted) == ("a| |b", "a| |b", '{"x":["c| |d"]}')
    assert (row.n_encrypted, row.big_encrypted) == (row.plain, big)
