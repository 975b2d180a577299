"""One scan for any headers, and records whose quoted fields cross the splits of a file."""

import csv
import io
import random
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from awardloom.config import EngineConfig
from awardloom.operators import dedup
from awardloom.plans import transform
from awardloom.sources import landing, records
from test_landing import HEAD, LINES, put, scan


@contextmanager
def splits_of(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def jobs_of(spark, fn):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        return fn(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


def text_of(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(rows)
    return out.getvalue()


def messy_cells(rng):
    parts = ["plain", "a,b", 'say "x"', "two\nlines", '"', '""', "\n", "\n\n", ",\n,", '",\n"', "end\n", '\n"quoted", then', "é🙂\n", 'x"y']
    return "".join(rng.choice(parts) for _ in range(rng.randrange(0, 4)))


@pytest.mark.parametrize("seed,size", [(0, 37), (1, 64), (2, 200), (3, 1000), (4, 10**6)])
def test_records_across_splits_equal_the_unsplit_read(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    want = set()
    for name in ("a", "b [1]", "c"):
        rows = [[f"{name}{i}", messy_cells(rng), rng.choice(["1", "", messy_cells(rng)])] for i in range(rng.randrange(1, 60))]
        put(tmp_path / f"{name}.csv", text_of([["i", "x", "y"], *rows]))
        want |= {(i, x, y or None) for i, x, y in rows}
    with splits_of(spark, size):
        rows, _ = scan(spark, tmp_path, multi_line=True)
        got = [(r.i, r.x, r.y) for r in rows.collect()]
        auto = [(r.i, r.x, r.y) for r in scan(spark, tmp_path)[0].collect()]
    clean = lambda some: sorted(tuple(c or "" for c in r) for r in some)
    assert clean(got) == clean(want) and clean(auto) == clean(want)


def test_first_duplicate_is_by_file_order_across_splits(spark, tmp_path):
    put(tmp_path / "a.csv", text_of([["k", "v"], *[[f"k{i % 5}", f"{i}\nx"] for i in range(400)]]))
    with splits_of(spark, 150):
        rows, _ = scan(spark, tmp_path)
        first = dedup.keep_first(rows, ["k"], [landing.ROW_ORDER]).collect()
    assert sorted((r.k, r.v) for r in first) == [(f"k{i}", f"{i}\nx") for i in range(5)]


def test_one_line_break_keeps_the_splits(spark, tmp_path):
    lines = [f"{i},{'w' * 90}" for i in range(20_000)]
    lines[12_345] = '12345,"one\nbreak"'
    put(tmp_path / "a.csv", "i,x\n" + "\n".join(lines) + "\n")
    with splits_of(spark, 200_000):
        rows, found = scan(spark, tmp_path)
        starts = records.split_starts(landing._text_lines(spark, [r.path for r in found.files.collect()]), ",").collect()
        assert rows.agg(F.count("*"), F.countDistinct("i"), F.max(F.length("x"))).first() == (20_000, 20_000, 90)
        assert rows.where("x like 'one%'").select("x").first().x == "one\nbreak"
    assert len(starts) >= 9 and not any(r.whole for r in starts)


def test_a_field_larger_than_a_split_and_one_without_end(spark, tmp_path):
    long = "\n".join(f"line {i}" for i in range(300))
    put(tmp_path / "a.csv", text_of([["i", "x"], ["1", "one"], ["2", long], ["3", "three\n3"]]))
    put(tmp_path / "b.csv", text_of([["i", "x"], ["4", "f\nour"]]) + '5,"never\nclosed, 6\n7')
    with splits_of(spark, 100):
        rows, found = scan(spark, tmp_path)
        got = {r.i: r.x for r in rows.collect()}
    assert got == {"1": "one", "2": long, "3": "three\n3", "4": "f\nour", "5": "never\nclosed, 6\n7"}


def test_stray_quotes_open_no_field(spark, tmp_path):
    put(tmp_path / "a.csv", 'i,x\n1,5" pipe\n2,6" and 7" pipes\n3,end"\n4,"a\nb"\n5,plain\n')
    rows, _ = scan(spark, tmp_path)
    assert {r.i: r.x for r in rows.collect()} == {"1": '5" pipe', "2": '6" and 7" pipes', "3": 'end"', "4": "a\nb", "5": "plain"}


def test_lines_that_end_open(spark):
    lines = ['a,"b', '"a""', '"a"",b', 'a,"b"', 'a,b"', '"a","', '', '"', '""', '"""', ',"x,"y', '"a"b,"c', 'a"b,"c,d']
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    got = {r.v: r.o for r in df.select("v", records.ends_open(F.col("v"), ",").alias("o")).collect()}
    assert {v for v, o in got.items() if o} == {'a,"b', '"a""', '"a"",b', '"a","', '"', '"""', '"a"b,"c', 'a"b,"c,d'}


def test_five_hundred_headers_are_one_scan(spark, tmp_path):
    names = [f"c{i}" for i in range(40)]
    rng = random.Random(1)
    want = []
    for f in range(500):
        header = rng.sample(names, rng.randrange(3, 12))
        put(tmp_path / f"{f % 10}" / f"{f}.csv", ",".join(header) + "\n" + ",".join(f"{f}.{n}" for n in header) + "\n")
        want.append({n: f"{f}.{n}" for n in header})
    (rows, found), jobs = jobs_of(spark, lambda: scan(spark, tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "FileScan text" not in plan and "Union" not in plan and "Python" not in plan and "InPandas" not in plan
    # Probe, layouts and search for odd files, where Spark counts listings, broadcasts and shuffles as jobs of their own.
    assert jobs <= 8
    got = sorted(({k: v for k, v in r.asDict().items() if v is not None and k in names} for r in rows.collect()), key=str)
    assert got == sorted(want, key=str)
    some = landing.scan_landing(spark, str(tmp_path), columns=["c1", "none"])
    assert some.groups[0].columns == ["c1", "source_file", "row_order"]
    assert some.groups[0].count() == sum("c1" in w for w in want)


def test_a_cell_is_parsed_once(spark, tmp_path):
    put(tmp_path / "a.csv", "x,y\n1,2\n3,4\n")
    rows, _ = scan(spark, tmp_path)
    picked = rows.filter("x > 1 and y < 9").select("x")
    assert picked._jdf.queryExecution().executedPlan().toString().count("from_csv") == 1
    assert [r.x for r in picked.collect()] == ["3"]


def test_the_text_is_read_twice(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    seen = []
    real = transform.stored

    def watched(df, label):
        seen.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, label)

    transform.stored = watched
    try:
        done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r")
    finally:
        transform.stored = real
    scans = {label: plan.count("FileScan csv") + plan.count("FileScan text") for label, plan in seen}
    assert scans == {"typed": 1, "marks": 0, "issues": 0}  # beside the search for odd files
    assert done.awards_path


def test_marks_count_what_the_rules_count(spark, tmp_path):
    put(tmp_path / "in" / "a.csv", HEAD + "\n" + "\n".join(LINES * 3) + "\n")
    put(tmp_path / "in" / "b.csv", HEAD + "\n" + LINES[2] + "\n")
    put(tmp_path / "in" / "head.csv", HEAD + "\n")
    cfg = EngineConfig(fiscal_year_limits=(2030, 2031), min_dollars_limit=20, max_dollars_limit=50)
    done = transform.process_landing(spark, str(tmp_path / "in"), str(tmp_path / "out"), "r", cfg, {"fiscal_year_range": (2024, 2024)})
    got = {}
    for r in spark.read.json(f"{done.report_path}/issues").where("rule <> 'missing_column'").collect():
        got[(r.source_file or "").rsplit("/", 1)[-1], r.rule, r.message] = r.issue_count
    a = {k[1:]: n for k, n in got.items() if k[0] == "a.csv"}
    assert a["fiscal_year", "Found 6 records with invalid fiscal years"] == 6
    assert a["min_dollars", "Found 3 records below minimum dollar threshold"] == 3
    assert a["max_dollars", "Found 3 records above maximum dollar threshold"] == 3
    assert a["filters", "Applied filters: 9 -> 6 rows"] == 3
    assert got["b.csv", "filters", "Applied filters: 1 -> 0 rows"] == 1
    assert got["", "duplicates", "Removed 5 duplicate rows"] == 5
    assert not [k for k in got if k[0] == "head.csv"]
    ords = [r.ord for r in spark.read.json(f"{done.report_path}/issues").where("source_file like '%a.csv'").orderBy("ord").collect()]
    assert ords == sorted(set(ords))


def test_wide_rows_run_compiled(spark, tmp_path):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    put(tmp_path / "a.csv", HEAD + "\n" + "\n".join(LINES) + "\n")
    rows, _ = scan(spark, tmp_path)
    assert spark.conf.get(key) == "8000" and rows.count() == len(LINES)
    spark.conf.set(key, "9000")
    scan(spark, tmp_path)
    assert spark.conf.get(key) == "9000"
    spark.conf.unset(key)
