import bz2
import gzip
import json
import os
import time

import pytest

from awardloom import session
from awardloom.config import EngineConfig
from awardloom.operators import dedup
from awardloom.plans import transform
from awardloom.schema import NULL_TOKENS, SEARCH_FIELDS
from awardloom.sources import documents, landing, sinks
from awardloom.streaming import pages


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def scan(spark, root, formats=landing.FORMATS, **options):
    found = landing.scan_landing(spark, str(root), formats, **options)
    return dedup.union_all(found.groups), found


def test_files_with_other_column_order_are_read_by_name(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n")
    put(tmp_path / "deep" / "er" / "b.csv", "y,x\n20,10\n")
    rows, _ = scan(spark, tmp_path)
    assert sorted((r.x, r.y) for r in rows.collect()) == [("1", "2"), ("10", "20")]


def test_null_spellings(spark, tmp_path):
    put(tmp_path / "a.csv", "i,x\n" + "".join(f'{i},"{t}"\n' for i, t in enumerate(NULL_TOKENS)) + "99, nan\n")
    rows, _ = scan(spark, tmp_path)
    assert {r.i: r.x for r in rows.collect()} == {**{str(i): None for i in range(len(NULL_TOKENS))}, "99": " nan"}


@pytest.mark.parametrize("mode", ["auto", True])
def test_quotes_and_line_breaks(spark, tmp_path, mode):
    put(tmp_path / "a.csv", 'i,x\n1,"line one\nline two, ""quoted"""\n2,plain\n')
    put(tmp_path / "b.csv", "i,x\n3,no breaks\n")
    rows, found = scan(spark, tmp_path, multi_line=mode)
    assert {r.i: r.x for r in rows.collect()} == {
        "1": 'line one\nline two, "quoted"', "2": "plain", "3": "no breaks",
    }
    assert len(found.groups) == 1


def test_odd_headers(spark, tmp_path):
    put(tmp_path / "a.csv", "﻿a.b,A.B,dup,dup\n1,2,3,4\n")
    rows, _ = scan(spark, tmp_path)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert rows.columns[:3] == ["a.b", "A.B", "dup"]
        assert rows.select("`a.b`", "`A.B`", "dup").first() == ("1", "2", "3")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_bad_files_become_issues(spark, tmp_path):
    put(tmp_path / "good.csv", "x\n1\n")
    put(tmp_path / "empty.csv", "")
    put(tmp_path / "broken.parquet", "this is not parquet")
    put(tmp_path / "_temporary" / "x.csv", "x\n9\n")
    put(tmp_path / "notes.txt", "x\n9\n")
    rows, found = scan(spark, tmp_path)
    assert [r.x for r in rows.collect()] == ["1"]
    issues = {os.path.basename(r.source_file): r for r in found.issues.collect()}
    assert set(issues) == {"empty.csv", "broken.parquet"}
    assert all(r.severity == "ERROR" and r.message.startswith("Failed to load file") for r in issues.values())


def test_probe_runs_without_the_package(tmp_path):
    """Executors do not have this package on their path."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    put(tmp_path / "a.csv", "x,y\n1,2\n")
    (tmp_path / "probe.bin").write_bytes(cloudpickle.dumps(landing._probe))
    code = (
        "import pickle, sys, pandas as pd\n"
        "probe = pickle.load(open(sys.argv[1], 'rb'))\n"
        "rows = pd.DataFrame([('file:' + sys.argv[2], 'csv', 8)], columns=['path', 'format', 'size'])\n"
        "print(list(next(probe(iter([rows])))['columns'][0]))\n"
        "assert 'awardloom' not in sys.modules\n"
    )
    args = [sys.executable, "-c", code, str(tmp_path / "probe.bin"), str(tmp_path / "a.csv")]
    done = subprocess.run(args, capture_output=True, text=True, cwd=tmp_path, check=True)
    assert done.stdout.strip() == "['x', 'y']"


def test_inventory(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n3,4\n")
    put(tmp_path / "head.csv", "x,y\n")
    put(tmp_path / "empty.csv", "")
    got = {os.path.basename(r.path): r for r in landing.inventory(landing.scan_landing(spark, str(tmp_path))).collect()}
    assert (got["a.csv"].row_count, got["a.csv"].columns, got["a.csv"].size) == (2, ["x", "y"], 12)
    assert (got["head.csv"].row_count, got["head.csv"].readable) == (0, True)
    assert (got["empty.csv"].row_count, got["empty.csv"].is_empty, got["empty.csv"].readable) == (None, True, False)


def test_unsupported_suffix():
    for path in ("x.xlsx", "x"):
        with pytest.raises(ValueError):
            landing.format_of(path)
    assert landing.format_of("A.CSV") == "csv"


def test_csv_round_trip_keeps_text(spark, tmp_path):
    rows = [("1", " padded "), ("2", 'say "hi", ok'), ("3", "two\nlines"), ("4", None), ("5", "back\\slash")]
    out = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame(rows, "i string, x string"), out, "csv")
    back, _ = scan(spark, out)
    assert sorted((r.i, r.x) for r in back.collect()) == rows


def test_rows_keep_file_order(spark, tmp_path):
    put(tmp_path / "a.csv", "k,v\n" + "".join(f"k{i % 3},{i}\n" for i in range(1000)))
    rows, _ = scan(spark, tmp_path)
    first = dedup.keep_first(rows, ["k"], [landing.ROW_ORDER])
    assert sorted((r.k, r.v) for r in first.collect()) == [("k0", "0"), ("k1", "1"), ("k2", "2")]


def test_write_guard(spark, tmp_path):
    empty = spark.createDataFrame([], "x string")
    assert sinks.write_run_table(empty, str(tmp_path), "t", "r1") is None
    assert not (tmp_path / "t_r1.parquet").exists()
    full = spark.createDataFrame([("1",)], "x string")
    path = sinks.write_run_table(full, str(tmp_path), "t", "r1", "csv")
    assert path.endswith("t_r1.csv") and os.path.isdir(path)
    with pytest.raises(ValueError):
        sinks.write_table(full, str(tmp_path / "z"), "xlsx")


def test_landing_to_parquet_dedups_per_file(spark, tmp_path):
    head = "Award ID\tStart Date\tEnd Date\tLast Modified Date\tv\n"
    put(tmp_path / "in" / "a.tsv", head + "1\ts\te\tm\tfirst\n1\ts\te\tm\tsecond\n1\ts\t\tm\tx\n1\ts\t\tm\ty\n")
    put(tmp_path / "in" / "b.tsv", head + "1\ts\te\tm\tother file\n")
    out = sinks.landing_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert sorted(r.v for r in spark.read.parquet(out).collect()) == ["first", "other file", "x"]
    assert (tmp_path / "in" / "a.tsv").exists()


HEAD = "award_id_piid,modification_number,action_date,action_date_fiscal_year,federal_action_obligation,recipient_name,funding_agency_name,award_type"
LINES = ["p1,0,2024-01-02,2024,10.50, Acme ,A,DO", "p1,0,2024-01-02,2024,99,Later copy,A,DO", "p2,,bad,FY??,oops,Beta,,PO"]


def test_whole_transform(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    columns = HEAD.split(",")
    spark.createDataFrame(
        [tuple(v or None for v in line.split(",")) for line in LINES[:1]], ", ".join(f"{c} string" for c in columns)
    ).write.parquet(str(tmp_path / "in" / "copy"))
    put(tmp_path / "in" / "c.csv", "x,y\n1,2\n")
    put(tmp_path / "in" / "d.csv", "")
    done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r1")
    rows = sorted(spark.read.parquet(done.awards_path).collect(), key=lambda r: r["PIID"])
    assert [(r["PIID"], r["Legal Business Name"]) for r in rows] == [("p1", "Acme"), ("p2", "Beta")]
    assert float(rows[0]["Dollars Obligated"]) == 10.5 and rows[1]["Date Signed"] is None
    issues = spark.read.json(f"{done.report_path}/issues").collect()
    rules = {(os.path.basename(r.source_file or ""), r.rule) for r in issues}
    assert ("d.csv", "load") in rules and ("", "duplicates") in rules and ("a.csv", "numerics") in rules
    assert ("c.csv", "load") in rules
    removed = [r.issue_count for r in issues if r.rule == "duplicates"]
    assert removed == [2]
    profiles = {r.column_name: r for r in spark.read.json(f"{done.report_path}/profiles").collect()}
    assert len(profiles) == 23 and profiles["PIID"].unique_count == 2
    summary = transform.end_of_run_summary(spark, done).collect()
    assert {r.section for r in summary} >= {"records", "columns", "issues", "last_issues", "top_agencies", "fiscal_years"}
    assert [r.label for r in summary if r.section == "last_issues" and r.ord == 1] == ["INFO: Removed 2 duplicate rows"]


def test_transform_without_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    run = lambda where, name, *more: transform.process_landing(spark, str(tmp_path / where), str(tmp_path / name), "r", *more)
    assert run("none", "o1").awards_path is None
    put(tmp_path / "in" / "c.csv", "x,y\n1,2\n")
    done = run("in", "o2")
    assert done.awards_path is None and {r.rule for r in spark.read.json(f"{done.report_path}/issues").collect()} == {"missing_column", "load"}
    put(tmp_path / "f" / "a.csv", HEAD + "\n" + LINES[0] + "\n")
    late = {"fiscal_year_range": (2030, 2031)}
    done = run("f", "o3", None, late)
    assert done.awards_path is None and "filters" in {r.rule for r in spark.read.json(f"{done.report_path}/issues").collect()}


def test_processed_csv_has_declared_types(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    cfg = EngineConfig(output_format="csv")
    done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r1", cfg)
    df = landing.read_processed(spark, done.awards_path)
    assert dict(df.dtypes)["Dollars Obligated"] == "decimal(20,2)" and df.count() == 2


def test_search_pages(spark, tmp_path):
    row = {"Award ID": "1", "Award Amount": 5.5, "ignored": 1}
    put(tmp_path / "p" / "1.json", json.dumps({"results": [row, row], "page_metadata": {"hasNext": True}}))
    put(tmp_path / "p" / "2.json", json.dumps({"results": [], "page_metadata": {"hasNext": False}}))
    put(tmp_path / "p" / "3.json", '{"results": [ broken')
    found = documents.read_search_pages(spark, str(tmp_path / "p"))
    rows = documents.flatten_pages(found)
    assert rows.columns == list(SEARCH_FIELDS)
    assert [(r["Award ID"], r["Award Amount"]) for r in rows.collect()] == [("1", "5.5")] * 2
    assert documents.broken(found).count() == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    src, out, progress = tmp_path / "p", str(tmp_path / "out"), str(tmp_path / "progress")
    put(src / "1.json", json.dumps({"results": [{"Award ID": "1"}]}))
    assert pages.ingest_pages(spark, str(src), out, progress).count() == 1
    put(src / "2.json", json.dumps({"results": [{"Award ID": "2"}, {"Award ID": "3"}]}))
    assert pages.ingest_pages(spark, str(src), out, progress).count() == 3
    assert pages.ingest_pages(spark, str(src), out, progress).count() == 3


def test_stream_of_award_files(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    take = lambda: pages.ingest_awards(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"))
    got = take()
    assert sorted(r["Legal Business Name"] for r in got.collect()) == ["Acme", "Beta", "Later copy"]
    put(tmp_path / "in" / "other order" / "b [2].csv", ",".join(reversed(HEAD.split(","))) + "\n" + ",".join(reversed(LINES[0].split(","))) + "\n")
    put(tmp_path / "in" / "c.csv", "x,y\n1,2,3\n")
    again = take()
    assert sorted(r["Legal Business Name"] for r in again.collect()) == ["Acme", "Acme", "Beta", "Later copy"]
    assert {"source_file", "row_order"} <= set(again.columns)
    assert [r.rule for r in spark.read.json(f"{tmp_path}/out_issues").collect()] == ["load"]
    assert take().count() == 4


def test_any_file_name_is_read_as_it_is(spark, tmp_path):
    names = ["with space (1).csv", "a[1].csv", "50%25 off.csv", "a+b.csv", "{x,y}*.csv", "ü?.csv"]
    for i, name in enumerate(names):
        put(tmp_path / "deep [0]" / name, f'i,x\n{i},"one\ntwo"\n{i},plain\n')
    rows, found = scan(spark, tmp_path)
    assert sorted((r.i, r.x) for r in rows.collect()) == sorted((str(i), x) for i in range(len(names)) for x in ("one\ntwo", "plain"))
    counts = {os.path.basename(r.path): r.row_count for r in landing.inventory(found).collect()}
    assert counts == {n: 2 for n in names}
    assert {os.path.basename(r.source_file) for r in rows.collect()} == set(names)


def test_ragged_files_are_refused_whole(spark, tmp_path):
    put(tmp_path / "good.csv", 'x,y\n1,"a,b"\n2\n,\n')
    put(tmp_path / "long.csv", "x,y\n1,2\n3,4,5\n6,7\n")
    put(tmp_path / "long and broken.csv", 'x,y\n1,"2\n2"\n3,4,5\n')
    put(tmp_path / "trailing.csv", "x,y\n1,2,\n")
    rows, found = scan(spark, tmp_path)
    assert sorted((r.x or "", r.y or "") for r in rows.collect()) == [("", ""), ("1", "a,b"), ("2", "")]
    issues = {os.path.basename(r.source_file): r.message for r in found.issues.collect()}
    assert set(issues) == {"long.csv", "long and broken.csv", "trailing.csv"}
    assert issues["long.csv"] == "Failed to load file long.csv: expected 2 fields, saw 3"


def test_text_and_typed_files_share_a_landing(spark, tmp_path):
    """Declared text stays text: 0007 from a text file, 7 from a number column."""
    put(tmp_path / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    text, _ = scan(spark, tmp_path)
    typed = text.drop("source_file", "row_order").limit(1)
    key = next(c for c in typed.columns if "modification" in c)
    typed.withColumn(key, landing.F.lit(7).cast("bigint")).write.parquet(str(tmp_path / "typed"))
    done = transform.process_landing(spark, str(tmp_path), str(tmp_path / "out"), "r1")
    df = landing.read_processed(spark, done.awards_path)
    assert dict(df.dtypes)["Modification Number"] == "string" and "7" in {r["Modification Number"] for r in df.collect()}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_line_breaks_survive_the_whole_transform(spark, tmp_path, fmt):
    head = HEAD + ",description_of_requirement" if "description_of_requirement" not in HEAD else HEAD
    source = next(s for s, d in EngineConfig().column_mapping.items() if d == "Description of Requirement")
    head = HEAD if source in HEAD.split(",") else HEAD + "," + source
    lines = [line + f',"first {i}\nsecond"' for i, line in enumerate(LINES)] if head != HEAD else LINES
    put(tmp_path / "in" / "a.csv", head + "\n" + "\n".join(lines) + "\n")
    done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r1", EngineConfig(output_format=fmt))
    df = landing.read_processed(spark, done.awards_path)
    assert df.count() == 2 and all(r["PIID"] for r in df.collect())
    if head != HEAD:
        assert all(r["Description of Requirement"].endswith("\nsecond") for r in df.collect())
    profiles = {r.column_name: r for r in spark.read.json(f"{done.report_path}/profiles").collect()}
    assert profiles["PIID"].null_count == 0


def test_paths_take_one_form_and_separators_are_counted(spark):
    paths = {"file:///a/b+c.csv": "file:/a/b+c.csv", "file:/a/50%2525%20off%5B1%5D+.csv": "file:/a/50%25 off[1]+.csv", "s3a://b//c%20d": "s3a://b//c d", "/a/b": "/a/b"}
    df = spark.createDataFrame(list(paths), "string")
    assert [r[0] for r in df.select(landing.one_form(df.value)).collect()] == list(paths.values())
    texts = spark.createDataFrame([("a,b,é",), ("",), (',"x,y",',)], "value string")
    assert [r[0] for r in texts.select(landing._separators(texts.value, ",")).collect()] == [2, 0, 3]


def test_ragged_rows_beside_line_breaks(spark, tmp_path):
    put(tmp_path / "a.csv", 'i,x\n1,"one, two\nthree, four"\n2,b\n')
    put(tmp_path / "b.csv", 'i,x\n3,"one\ntwo"\n4,b,c\n')
    rows, found = scan(spark, tmp_path)
    assert sorted((r.i, r.x) for r in rows.collect()) == [("1", "one, two\nthree, four"), ("2", "b")]
    assert [r.message for r in found.issues.collect()] == ["Failed to load file b.csv: expected 2 fields, saw 3"]


def put_packed(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes((bz2 if path.suffix == ".bz2" else gzip).compress(text.encode()))


def test_packed_text_is_read_as_plain_text_is(spark, tmp_path):
    texts = {"plain.csv": 'i,x\n1,"a,b"\n2,\n', "other order.csv": "x,i\nc,3\n", "broken.csv": 'i,x\n4,"one\ntwo"\n5,d\n', "long.csv": "i,x\n6,7,8\n", "empty.csv": ""}
    for name, text in texts.items():
        put(tmp_path / "plain" / name, text)
        put_packed(tmp_path / "packed" / f"{name}.{'bz2' if 'order' in name else 'gz'}", text)
    put_packed(tmp_path / "packed" / "no text.gz", "i,x\n9,9\n")
    (plain, was), (packed, now) = scan(spark, tmp_path / "plain"), scan(spark, tmp_path / "packed")
    rows = lambda df: sorted((r.i, r.x) for r in df.collect())
    assert rows(packed) == rows(plain) == [("1", "a,b"), ("2", None), ("3", "c"), ("4", "one\ntwo"), ("5", "d")]
    files = lambda found: {os.path.basename(r.path).split(".")[0]: (r.format, r.readable, r.column_count, r.row_count) for r in landing.inventory(found).collect()}
    assert files(now) == files(was) and len(files(now)) == 5


def test_stream_takes_packed_award_files(spark, tmp_path):
    put_packed(tmp_path / "in" / "a.csv.gz", HEAD + "\n" + "\n".join(LINES) + "\n")
    got = pages.ingest_awards(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"))
    assert sorted(r["Legal Business Name"] for r in got.collect()) == ["Acme", "Beta", "Later copy"]


@pytest.mark.parametrize("pack", [True, False])
def test_a_csv_result_is_packed_unless_told_otherwise(spark, tmp_path, pack):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    cfg = EngineConfig.from_dict({"output": {"format": "csv", "pack_text": pack}})
    done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r", cfg)
    assert {f.partition(".")[2] for f in os.listdir(done.awards_path) if f.startswith("part-")} == {"csv.gz" if pack else "csv"}
    assert sorted(r["Legal Business Name"] for r in landing.read_processed(spark, done.awards_path).collect()) == ["Acme", "Beta"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_a_run_leaves_no_tables_between_its_steps(spark, tmp_path, fmt):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    put(tmp_path / "in" / "b.csv", 'recipient_name,award_id_piid\n"line\nbreak",p9\n')
    before = set(os.listdir(session.shared_dir(spark)))
    done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r", EngineConfig(output_format=fmt))
    sinks.landing_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "converted"))
    pages.ingest_awards(spark, str(tmp_path / "in"), str(tmp_path / "stream"), str(tmp_path / "progress"))
    assert set(os.listdir(session.shared_dir(spark))) == before
    assert landing.read_processed(spark, done.awards_path).count() == 3
    assert spark.read.parquet(str(tmp_path / "converted")).count() == 4


def test_shuffle_files_go_with_the_step_that_wrote_them(spark):
    def shuffles():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    session.free_shuffles(spark)
    before = shuffles()
    session.stored(spark.range(100_000).repartition(7, "id"), "dealt")
    for _ in range(100):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
