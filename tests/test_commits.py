"""Attempts, commits, claims, the run log and logged streams."""

import json
import threading
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest

from landfall import parse_contract
from landfall.operators import audit, sinks
from landfall.operators.shared_files import RunClaimed, claimed, create_file, names_in
from landfall.plans import intake
from landfall.plans.intake import IntakeJob, loaded_rows, read_landing, rejected_rows, run_intake
from landfall.streaming import land_new_files

C = parse_contract(json.dumps({"csv_header": False, "fields": {"a": {"required": True}, "b": {}}}))
ARRAY = parse_contract(json.dumps({"format": "JSON", "is_json_array": True, "fields": {"a": {"required": True}}}))


def job(tmp_path, text, run="run-1", **changes):
    (tmp_path / "in.csv").write_text(text)
    made = IntakeJob([str(tmp_path / "in.csv")], C, str(tmp_path / "table"), str(tmp_path / "audit"), execution_id=run)
    return replace(made, **changes)


def state_of(spark, tmp_path, run="run-1"):
    return audit.run_states(audit.read_events(spark, str(tmp_path / "audit"))).filter(f"execution_id = '{run}'").first()


def landed(spark, tmp_path):
    return sorted(r.a for r in loaded_rows(spark, str(tmp_path / "table"), C).collect())


@pytest.mark.parametrize("where", ["write", "commit", "report"])
def test_a_failed_attempt_changes_nothing(spark, tmp_path, monkeypatch, where):
    first = run_intake(spark, job(tmp_path, "1,x\n2,y\n,z\n"))
    assert (first.status, first.actual_count, first.error_count) == ("PASSED", 2, 1)
    before = state_of(spark, tmp_path)

    def broken(*args, **kwargs):
        raise OSError("disk gone")

    def half_written(df, location, run, attempt):
        sinks.write_landing(df.limit(1), location, run, attempt)
        raise OSError("disk gone")

    if where == "write":
        monkeypatch.setattr(intake, "write_landing", half_written)
    elif where == "commit":
        monkeypatch.setattr(intake, "commit_attempt", broken)
    else:
        monkeypatch.setattr(intake, "write_error_text", broken)
    with pytest.raises(OSError, match="disk gone"):
        run_intake(spark, job(tmp_path, "7,x\n", report_dir=str(tmp_path / "r")))
    monkeypatch.undo()
    assert landed(spark, tmp_path) == ["1", "2"]
    assert rejected_rows(spark, str(tmp_path / "table"), C).count() == 1
    after = state_of(spark, tmp_path)
    same = ("status", "expected_count", "actual_count", "failure_reason")
    assert [after[c] for c in same] == [before[c] for c in same] == ["PASSED", None, 2, None]
    old = sinks.superseded_attempts(spark, str(tmp_path / "table")).collect()
    assert [r.execution_id for r in old] == ["run-1"]
    third = run_intake(spark, job(tmp_path, "8,x\n9,x\n3,x\n"))
    assert third.actual_count == 3 and landed(spark, tmp_path) == ["3", "8", "9"]
    assert sinks.superseded_attempts(spark, str(tmp_path / "table")).count() == 2


def test_readers_never_see_a_half_written_run(spark, tmp_path, monkeypatch):
    run_intake(spark, job(tmp_path, "1,x\n"))
    seen = []

    def looked_at(*args):
        seen.append(landed(spark, tmp_path))  # all rows of the second attempt are written, none is committed
        sinks.commit_attempt(*args)

    monkeypatch.setattr(intake, "commit_attempt", looked_at)
    run_intake(spark, job(tmp_path, "5,x\n6,x\n"))
    assert seen == [["1"]] and landed(spark, tmp_path) == ["5", "6"]


@pytest.mark.parametrize("text", ["", "1,x\n", ",\n\n,x\n", "".join(f"{k},x\n" for k in range(5000))])
def test_counts_of_the_write_equal_the_files(spark, tmp_path, text):
    result = run_intake(spark, job(tmp_path, text))
    rows = read_landing(spark, str(tmp_path / "table"), C)
    assert result.actual_count == rows.filter("outcome = 'valid'").count()
    assert result.error_count == rows.filter("outcome = 'error'").count()
    assert sinks.committed_counts(spark, str(tmp_path / "table"), "run-1") == {"valid": result.actual_count, "error": result.error_count}
    assert sinks.committed_counts(spark, str(tmp_path / "table"), "other") is None


def test_of_two_attempts_at_once_one_runs(spark, tmp_path, monkeypatch):
    (tmp_path / "in.csv").write_text("1,x\n")
    both, outcome = threading.Barrier(2), []
    write = sinks.write_landing

    def slow(*args):
        import time

        time.sleep(3)
        return write(*args)

    monkeypatch.setattr(intake, "write_landing", slow)

    def attempt():
        both.wait()
        try:
            outcome.append(run_intake(spark, job(tmp_path, "1,x\n")).status)
        except RunClaimed:
            outcome.append("refused")

    threads = [threading.Thread(target=attempt) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(outcome) == ["PASSED", "refused"]
    assert audit.read_events(spark, str(tmp_path / "audit")).filter("kind = 'STARTED'").count() == 1
    assert run_intake(spark, job(tmp_path, "1,x\n")).status == "PASSED"  # the claim is gone


def test_an_expired_claim_is_no_claim(spark, tmp_path):
    create_file(spark, str(tmp_path / "_claims/r/1000-dead"))
    with claimed(spark, str(tmp_path), "r", 1.0):
        with pytest.raises(RunClaimed):
            with claimed(spark, str(tmp_path), "r", 1.0):
                pass
        with claimed(spark, str(tmp_path), "other", 1.0):
            pass


def events_of(runs, start=0):
    at = datetime(2026, 1, 1, tzinfo=timezone.utc)
    for k in range(start, start + runs):
        for attempt in range(1 + k % 3):
            begun = at + timedelta(minutes=k, seconds=attempt)
            base = {"execution_id": f"run-{k}", "attempt": begun, "event_time": begun}
            end = [("FINISHED", "PASSED"), ("FINISHED", "FAILED"), ("ABORTED", None)][(k + attempt) % 3]
            rows = [base | {"seq": 0, "kind": "STARTED", "status": "RUNNING", "file_name": f"f{k}"}]
            if attempt % 2 == 0 and end[0] == "FINISHED":
                rows.append(base | {"seq": 1, "kind": "COMMITTED"})
            rows += [base | {"seq": 2, "kind": "COUNTED", "actual_count": k}, base | {"seq": 4, "kind": end[0], "status": end[1], "failure_reason": None if end[1] == "PASSED" else "x"}]
            yield rows


def test_compaction_keeps_every_state(spark, tmp_path):
    log = str(tmp_path / "log")
    batches = list(events_of(60))
    spark.createDataFrame([e for b in batches for e in b], audit.EVENT_SCHEMA).repartition(60).write.parquet(log)
    states = lambda **k: sorted(map(str, audit.run_states(audit.read_events(spark, log, **k)).collect()))
    before, one = states(), states(execution_id="run-7")
    files = lambda: sum(n.endswith(".parquet") for n in names_in(spark, log))
    assert len(one) == 1 and audit.compact_events(spark, log) == files() == 60
    assert states() == before and states(execution_id="run-7") == one
    for rows in list(events_of(3, 100)):  # appended after
        audit.append_events(spark, rows, log)
    more = states()
    assert len(more) == 63 and set(before) < set(more)
    assert audit.compact_events(spark, log) >= 3 and states() == more
    assert files() < 20 and audit.compact_events(spark, log) == 0 and states() == more
    assert len([n for n in names_in(spark, f"{log}/_compacted") if not n.endswith(".json")]) == 2


def test_events_appended_during_compaction_are_kept(spark, tmp_path, monkeypatch):
    log = str(tmp_path / "log")
    first, second = list(events_of(2))[:2]
    audit.append_events(spark, first, log)
    create = audit.create_file

    def late(*args):
        audit.append_events(spark, second, log)
        create(*args)

    monkeypatch.setattr(audit, "create_file", late)
    audit.compact_events(spark, log)
    assert audit.read_events(spark, log).count() == len(first) + len(second)


def test_a_stream_of_json_arrays(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def run():
        q = land_new_files(spark, str(inbox), ARRAY, str(tmp_path / "t"), "s", str(tmp_path / "cp"), files_per_batch=1)
        q.awaitTermination(120)
        return sorted(r.a for r in loaded_rows(spark, str(tmp_path / "t"), ARRAY).collect())

    (inbox / "a.json").write_text('[{"a": "1"},\n {"a": "2"}]')
    (inbox / "b.json").write_text('[\n{"a": "3"}\n]')
    assert run() == ["1", "2", "3"]
    (inbox / "c.json").write_text('[{"a": "4"}]')
    assert run() == ["1", "2", "3", "4"] and run() == ["1", "2", "3", "4"]
    states = audit.run_states(audit.read_events(spark, str(tmp_path / "t/_runs"))).collect()
    assert sorted((r.execution_id, r.status) for r in states) == [("s-0", "PASSED"), ("s-1", "PASSED"), ("s-2", "PASSED")]
    assert sorted(r.actual_count for r in states) == [1, 1, 2]


def test_a_batch_that_aborts_is_tried_again(spark, tmp_path, monkeypatch):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    control = tmp_path / "c.properties"
    control.write_text("record_count=3\n")
    (inbox / "a.csv").write_text("1,x\n2,x\n")

    def run():
        q = land_new_files(
            spark, str(inbox), C, str(tmp_path / "t"), "s", str(tmp_path / "cp"), audit_dir=str(tmp_path / "audit"), control_of=lambda paths: str(control)
        )
        q.awaitTermination(120)

    monkeypatch.setattr(intake, "commit_attempt", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(Exception, match="gone"):
        run()
    assert state_of(spark, tmp_path, "s-0").status == "FAILED"
    monkeypatch.undo()
    run()
    state = state_of(spark, tmp_path, "s-0")
    assert (state.status, state.expected_count, state.actual_count) == ("FAILED", 3, 2) and state.failure_reason.startswith("Record count mismatch")
    assert landed_in(spark, tmp_path / "t") == ["1", "2"]
    assert audit.attempt_states(audit.read_events(spark, str(tmp_path / "audit"))).count() == 2


def landed_in(spark, table):
    return sorted(r.a for r in loaded_rows(spark, str(table), C).collect())
