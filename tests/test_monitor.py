import datetime as dt
import json

from awardloom.operators import monitor
from awardloom.sources import documents, sinks

AS_OF = dt.datetime(2024, 1, 8)


def step(status):
    return {"status": status, "timestamp": "2024-01-07T00:00:00", "details": "{}"}


RUNS = [
    {"run_id": "a", "status": "SUCCESS", "start_time": "2024-01-07T10:00:00.5", "end_time": "2024-01-07T10:15:12.5",
     "steps": {"x": step("SUCCESS"), "y": step("SUCCESS")}, "errors": [], "output_files": ["out/d/a.parquet", "r.txt"]},
    {"run_id": "b", "status": "FAILED", "start_time": "2024-01-06T10:00:00",
     "steps": {"x": step("FAILED"), "y": step("STARTED")}, "errors": ["e" * 100, "f", "g"]},
    {"run_id": "c", "status": "RUNNING", "start_time": "2024-01-05T10:00:00"},
    {"run_id": "d", "status": "SUCCESS", "start_time": "", "end_time": ""},
    {"run_id": "e", "status": "SUCCESS", "start_time": "2023-12-01T10:00:00"},
]


def ledger(spark, tmp_path):
    for r in RUNS:
        (tmp_path / f"run_results_{r['run_id']}.json").write_text(json.dumps(r, indent=2))
    (tmp_path / "run_results_z.json").write_text('{"run_id": "z", "start')
    found = documents.read_runs(spark, str(tmp_path), multi_line=True)
    assert documents.broken(found).count() == 1
    return documents.good(found)


def test_recent_runs(spark, tmp_path):
    runs = ledger(spark, tmp_path)
    recent = monitor.recent_runs(runs, AS_OF, 7)
    assert [r.run_id for r in monitor.newest(recent, 10).collect()] == ["a", "b", "c"]
    assert [r.run_id for r in monitor.newest(recent, 1).collect()] == ["a"]
    assert [r.run_id for r in monitor.rejected_runs(runs).collect()] == ["d"]


def test_success_rate(spark, tmp_path):
    r = monitor.success_rate(monitor.recent_runs(ledger(spark, tmp_path), AS_OF)).first()
    assert (r.runs, r.successes, r.failures, r.success_rate) == (3, 1, 2, 33.3333)


def test_success_rate_without_runs(spark, tmp_path):
    r = monitor.success_rate(ledger(spark, tmp_path).limit(0)).first()
    assert (r.runs, r.success_rate) == (0, None)


def test_metrics(spark, tmp_path):
    got = {r.run_id: tuple(r)[4:] for r in monitor.run_metrics(ledger(spark, tmp_path)).collect()}
    assert got["a"] == (15.2, 2, 0, 0, 2)
    assert got["b"] == (None, 0, 1, 3, 0)
    assert got["c"] == (None, 0, 0, 0, 0)
    assert got["d"] == (None, 0, 0, 0, 0)
    assert monitor.run_metrics(ledger(spark, tmp_path)).columns == list(monitor.RUN_METRIC_COLUMNS)


def test_a_field_of_odd_type_does_not_lose_the_record(spark, tmp_path):
    odd = {"run_id": "o", "status": "FAILED", "start_time": "2024-01-07T00:00:00", "errors": "not a list"}
    (tmp_path / "run_results_o.json").write_text(json.dumps(odd))
    found = documents.read_runs(spark, str(tmp_path), multi_line=True)
    assert [(r.run_id, r.errors) for r in documents.good(found).collect()] == [("o", None)]
    assert documents.broken(found).count() == 0


def test_export(spark, tmp_path):
    (tmp_path / "l").mkdir()
    metrics = monitor.run_metrics(ledger(spark, tmp_path / "l"))
    assert sinks.export_metrics(metrics.limit(0), str(tmp_path / "none")) is None
    out = sinks.export_metrics(metrics, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(out).count() == len(RUNS)


def test_errors_and_details(spark, tmp_path):
    runs = monitor.recent_runs(ledger(spark, tmp_path), AS_OF)
    assert [(r.run_id, r.pos, r.error) for r in monitor.error_heads(runs).collect()] == [("b", 0, "e" * 80), ("b", 1, "f")]
    got = {(r.run_id, r.kind, r.name): r.state for r in monitor.run_details(runs).collect()}
    assert got == {
        ("a", "step", "x"): "SUCCESS", ("a", "step", "y"): "SUCCESS", ("a", "file", "a.parquet"): None,
        ("a", "file", "r.txt"): None, ("b", "step", "x"): "FAILED", ("b", "step", "y"): "STARTED",
    }


def test_summary_text(spark, tmp_path):
    got = {r.run_id: r.summary for r in monitor.summary_text(ledger(spark, tmp_path)).collect()}
    assert got["a"].splitlines() == [
        "Status: SUCCESS", "Run: a", "Start: 2024-01-07T10:00:00.5", "End: 2024-01-07T10:15:12.5",
        "Steps:", "- x: SUCCESS", "- y: SUCCESS", "Output files:", "- a.parquet", "- r.txt",
    ]
    assert got["c"].splitlines() == ["Status: RUNNING", "Run: c", "Start: 2024-01-05T10:00:00", "End: Running..."]


def test_ledger_append(spark, tmp_path):
    out = str(tmp_path / "ledger")
    record = {"run_id": "1", "start_time": "2024-01-07T00:00:00", "status": "FAILED",
              "steps": {"x": sinks.step_entry("FAILED", "2024-01-07T00:00:00", {"error": "no"})},
              "errors": ["no"], "output_files": []}
    sinks.append_run(spark, out, record)
    sinks.append_run(spark, out, {**record, "run_id": "2", "status": "SUCCESS", "end_time": "2024-01-07T00:01:00"})
    runs = documents.good(documents.read_runs(spark, out))
    got = {r.run_id: (r.duration_minutes, r.failed_steps) for r in monitor.run_metrics(runs).collect()}
    assert got == {"1": (None, 1), "2": (1.0, 1)}
    assert json.loads(runs.first().steps["x"].details) == {"error": "no"}


REPORTS = [
    {"processing_timestamp": "2024-01-07T00:00:00", "data_quality_issues": [
        {"severity": s, "message": f"m{i} " + "x" * 80, "timestamp": "t", **({"count": c} if c is not None else {})}
        for i, (s, c) in enumerate([("ERROR", "5"), ("WARNING", 5), ("INFO", None), ("WARNING", 1), ("ERROR", 2), ("INFO", 3), ("INFO", 4)])
    ], "summary_statistics": {"total_rows": 200, "total_columns": 4, "null_counts": {"a": 0, "b": 50, "c": 200, "d": 0, "e": 7, "f": 7, "g": 1}}},
    {"processing_timestamp": "2024-01-06T00:00:00", "data_quality_issues": [], "summary_statistics": {"total_rows": 1}},
    {"processing_timestamp": "bad"},
]


def reports(spark, tmp_path):
    for i, r in enumerate(REPORTS):
        (tmp_path / f"{i}.json").write_text(json.dumps(r, indent=1))
    return documents.good(documents.read_quality_reports(spark, str(tmp_path), multi_line=True))


def test_quality_reports(spark, tmp_path):
    found = reports(spark, tmp_path)
    assert monitor.recent_reports(found, AS_OF).count() == 2
    latest = monitor.latest_report(found, AS_OF)
    issues = monitor.issue_rows(latest)
    assert [r.issue_count for r in issues.orderBy("pos").collect()] == [5, 5, None, 1, 2, 3, 4]
    counts = monitor.issue_counts(issues).first()
    assert (counts.errors, counts.warnings, counts.issues) == (2, 2, 7)
    last = monitor.last_issues(latest).orderBy("pos").collect()
    assert [r.message[:2] for r in last] == ["m2", "m3", "m4", "m5", "m6"] and len(last[0].message) == 60
    got = [tuple(r) for r in monitor.incomplete_columns(latest).collect()]
    assert got == [("c", 200, 0.0), ("b", 50, 75.0), ("e", 7, 96.5), ("f", 7, 96.5), ("g", 1, 99.5)]
