"""Shard table with a commit log, merged history, coverage, running totals, page index, sketches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from awardloom.operators import filters, planning, profile, sketches
from awardloom.sources import history, manifest
from awardloom.streaming import pages

D, DAY = dt.date, dt.timedelta(days=1)
KEYS = ["g", "s"]
KINDS = "v int"


def shard_frame(spark, rows):
    return spark.createDataFrame(rows, "v int, g string, s string")


def planned(spark, *keys):
    return spark.createDataFrame(keys, "g string, s string")


def state(spark, path):
    return sorted((r.v, r.g, r.s) for r in manifest.read_shards(spark, path, KEYS, KINDS).collect())


def test_a_pull_replaces_its_planned_shards(spark, tmp_path):
    path = str(tmp_path / "t")
    assert state(spark, path) == [] and manifest.current_shards(spark, path, KEYS).count() == 0
    all_ = planned(spark, ("a", "1"), ("a", "2"), ("b", "1"))
    manifest.pull_shards(shard_frame(spark, [(1, "a", "1"), (2, "a", "1"), (3, "a", "2"), (4, "b", "1")]), all_, path, KEYS)
    assert state(spark, path) == [(1, "a", "1"), (2, "a", "1"), (3, "a", "2"), (4, "b", "1")]
    # Changed, vanished, and untouched shards.
    manifest.pull_shards(shard_frame(spark, [(9, "a", "1")]), planned(spark, ("a", "1"), ("a", "2")), path, KEYS)
    assert state(spark, path) == [(4, "b", "1"), (9, "a", "1")]
    assert sorted((r.g, r.s, r.rows) for r in manifest.current_shards(spark, path, KEYS).collect()) == [("a", "1", 1), ("a", "2", 0), ("b", "1", 1)]
    # Nothing at all clears what was planned.
    manifest.pull_shards(shard_frame(spark, [(1, "x", "y")]).limit(0), all_, path, KEYS)
    assert state(spark, path) == [] and len(manifest.commits(spark, path)) == 3
    manifest.pull_shards(shard_frame(spark, [(5, "a", "2")]), planned(spark, ("a", "2")), path, KEYS)
    assert state(spark, path) == [(5, "a", "2")]


def test_a_writer_that_dies_leaves_no_trace(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows, shards = shard_frame(spark, [(1, "a", "1")]), planned(spark, ("a", "1"))
    manifest.pull_shards(rows, shards, path, KEYS)
    late = rows.withColumn("v", F.lit(7))
    manifest.write_pull(late, shards, path, KEYS)  # killed before the commit
    assert state(spark, path) == [(1, "a", "1")]
    with monkeypatch.context() as m:  # killed while rows are written
        m.setattr(manifest.sinks, "write_partitions", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            manifest.pull_shards(late, shards, path, KEYS)
    (tmp_path / "t" / "commits" / "000000000009").write_text("")  # killed between naming the commit and filling it
    assert state(spark, path) == [(1, "a", "1")]
    (tmp_path / "t" / "commits" / "000000000009").unlink()
    assert manifest.pull_shards(late, shards, path, KEYS) and state(spark, path) == [(7, "a", "1")]


def test_only_one_writer_gets_a_number(spark, tmp_path):
    path = str(tmp_path / "t")
    rows, shards = shard_frame(spark, [(1, "a", "1")]), planned(spark, ("a", "1"))
    one, two = (manifest.write_pull(rows.withColumn("v", F.lit(v)), shards, path, KEYS) for v in (1, 2))
    manifest.commit(spark, path, 1, two)
    with pytest.raises(RuntimeError, match="taken"):
        manifest.commit(spark, path, 1, one)
    assert state(spark, path) == [(2, "a", "1")]


def test_rows_outside_the_plan_stop_a_pull(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="not planned"):
        manifest.pull_shards(shard_frame(spark, [(1, "a", "1"), (2, "z", "1")]), planned(spark, ("a", "1")), path, KEYS)
    assert state(spark, path) == []


# History


def test_a_merge_leaves_the_history_where_it_is(spark, tmp_path):
    kinds = "`A key` string, k2 int, v string, n long"
    pull = lambda rows: spark.createDataFrame(rows, kinds)
    old = [(f"k{i % 50}" if i % 7 else None, i % 3 if i % 5 else None, f"old{i}", i) for i in range(400)]
    new = [(f"k{i % 80}" if i % 9 else None, i % 3 if i % 4 else None, f"new{i}", i) for i in range(200)]
    last = [("k1", 1, "last", 5), ("k1", 1, "first", 4), ("a:1", None, "odd", 0), ("a", None, "odd", 0)]
    keys, order = ["A key", "k2"], ["n"]
    first = history.create([pull(old)], str(tmp_path / "h1"), keys, order, 4)
    schema = spark.read.parquet(first).schema.toDDL()
    frame = history.merged(history.opened(spark, first, schema, 4), [pull(new), pull(last)], keys, order, 4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    # From the scan of the history up to the join with the pulls' keys there is no exchange.
    above = plan[: plan.index("Bucketed: true")].splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    path, at = [], 10**6
    for line in reversed(above):
        if depth(line) < at:
            path.append(line)
            at = depth(line)
    assert any("SortMergeJoin" in line for line in path) and not any("Exchange" in line for line in path), plan
    out = history.merge(spark, first, schema, [pull(new), pull(last)], str(tmp_path / "h2"), keys, order, 4)
    want = {}
    for rows in (old, new, last):
        mine = {}
        for r in sorted(rows, key=lambda r: r[3]):
            mine.setdefault(r[:2], r)
        want |= mine
    got = [tuple(r)[:4] for r in spark.read.parquet(out).select("A key", "k2", "v", "n").collect()]
    assert sorted(got, key=str) == sorted(want.values(), key=str)
    again = history.opened(spark, out, schema, 4)  # the next merge finds buckets too
    assert again.groupBy(history.KEY).count().filter("count > 1").count() == 0


def test_a_history_is_written_range_after_range_of_buckets(spark, tmp_path, monkeypatch):
    kinds, keys, order = "k string, n long", ["k"], ["n"]
    old = spark.createDataFrame([(f"k{i % 90}" if i % 7 else None, i) for i in range(300)], kinds)
    new = spark.createDataFrame([(f"k{i}" if i % 9 else None, -i) for i in range(60, 120)], kinds)
    assert (history.buckets_for(5, 8), history.buckets_for(history.BUCKET_BYTES * 20 + 1, 8)) == (8, 21)

    def versions(name):
        first = history.create([old], str(tmp_path / f"{name}1"), keys, order, 8)
        schema = spark.read.parquet(first).schema.toDDL()
        out = history.merge(spark, first, schema, [new], str(tmp_path / f"{name}2"), keys, order, 8)
        files = [f for f in os.listdir(out) if f.startswith("part-")]
        assert len(files) == len({f.split("_")[1][:5] for f in files})  # one a bucket, as a join without a sort needs
        return [sorted(map(str, spark.read.parquet(p).collect())) for p in (first, out)]

    want = versions("whole")
    writes, real = [], history.free_shuffles
    monkeypatch.setattr(history, "free_shuffles", lambda s: writes.append(1) or real(s))
    monkeypatch.setattr(history, "LEAST_AT_ONCE", 3)
    assert versions("ranges") == want and len(writes) == 6



# Coverage and running totals


@pytest.mark.parametrize("seed", range(3))
def test_missing_spans_equal_missing_days(spark, seed):
    rng = random.Random(seed)
    first = D(2024, 1, 1)
    day = lambda i: first + i * DAY
    wanted = [("a", 0, 60), ("b", 10, 40), (None, 5, 5), ("none", 3, 9), ("empty", 9, 3), ("whole", 2, 8)]
    covered = [(k, s, s + rng.choice([0, 1, 6, 6, 27])) for k in ("a", "b", None, "other") for s in rng.choices(range(-20, 70), k=8)]
    covered += [("a", 20, 50), ("a", 25, 30), ("a", 20, 30), ("whole", -9, 20), ("b", 39, 45)]
    spans = spark.createDataFrame([(k, f"{day(s)}_to_{day(e)}") for k, s, e in covered] + [("a", "all"), ("a", "2024-01-09_to_2024-01-02"), ("a", None)], "k string, shard string")
    want_frame = spark.createDataFrame([(k, day(a), day(b)) for k, a, b in wanted], "k string, first_day date, last_day date")
    missing = planning.missing_spans(want_frame, planning.parse_spans(spans), ["k"])
    got = {}
    for r in missing.collect():
        assert r.span_start <= r.span_end
        for i in range((r.span_end - r.span_start).days + 1):
            assert got.setdefault((r.k, r.span_start + i * DAY), True)
    want = {(k, day(i)) for k, a, b in wanted for i in range(a, b + 1) if not any(c == k and s <= i <= e for c, s, e in covered)}
    assert set(got) == want
    assert missing.count() == len({(k, d) for k, d in want if (k, d - DAY) not in want})  # as long as can be
    cut = planning.repull_list(missing, ["k"], 4).collect()
    assert {(r.k, r.shard_start + i * DAY) for r in cut for i in range((r.shard_end - r.shard_start).days + 1)} == want
    assert all((r.shard_end - r.shard_start).days < 4 for r in cut)


def test_counts_of_long_ranges_are_two_look_ups(spark):
    rng = random.Random(1)
    first = D(2000, 1, 1)
    days = [first + rng.randrange(3000) * DAY for _ in range(500)]
    daily = planning.daily_counts(spark.createDataFrame([(d,) for d in days] + [(None,)], "day date"), "day")
    spans = [(first + a * DAY, first + b * DAY) for a, b in ((rng.randrange(-4000, 4000), rng.randrange(-4000, 9000)) for _ in range(300))]
    ranges = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i int, range_start date, range_end date")
    counted = planning.count_ranges(ranges, daily)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan.split("scalar-subquery")[0] and "Generate" not in plan.split("scalar-subquery")[0]
    assert {r.i: r.row_count for r in counted.collect()} == {i: sum(a <= d <= b for d in days) for i, (a, b) in enumerate(spans)}
    assert {r.row_count for r in planning.count_ranges(ranges, daily.limit(0)).collect()} == {0}
    many = spark.range(100_000).select(F.date_add(F.lit(first), (F.col("id") % 999).cast("int")).alias("range_start"), F.lit(D(2030, 1, 1)).alias("range_end"))
    assert planning.count_ranges(many, daily).agg(F.count("*"), F.max("row_count")).first() == (100_000, 500)
    assert planning.split_until(ranges.limit(0), daily, 5).count() == 0


# Page index


def test_a_late_page_reads_two_parts(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 7919 % 3001).cast("decimal(20,2)").alias("amount"))
    stage = filters.index_pages(rows, str(tmp_path / "s"), ["k"])
    want = sorted(((-(i * 7919 % 3001), i) for i in range(20_000)))
    for page, size in ((1, 7), (1000, 7), (2, 9000), (2858, 7), (2857, 7), (20_000, 1), (20_001, 1)):
        got = filters.indexed_page(spark, stage, page, size)
        some = want[(page - 1) * size : page * size]
        assert sorted((-int(r.amount), r.k) for r in got.collect()) == some
        assert all(r.page == page and r.has_next == (page * size < 20_000) for r in got.collect())
    late = filters.indexed_page(spark, stage, 1000, 7)
    plan = late._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "PartitionFilters: [" in text and "_part" in text.split("PartitionFilters:")[1] and "Exchange" not in text and "_line" in text.split("PushedFilters:")[1]
    assert late.select(F.input_file_name()).distinct().count() <= 2 and late.rdd.getNumPartitions() <= 2
    none = filters.index_pages(rows.limit(0), str(tmp_path / "n"), ["k"])
    assert none and spark.read.parquet(f"{none}/index").count() == 0


# Agencies by combination


def test_specs_join_the_rows_once(spark):
    cols = "awarding_toptier string, awarding_subtier string, funding_toptier string, funding_subtier string, n int"
    rows = [("A", "a", "B", "b", 1), ("A", "x", "C", None, 2), (None, None, "B", "b", 3), (None, None, None, None, 4), ("D", "d", "D", "d", 5)] * 2
    df = spark.createDataFrame(rows, cols)
    specs = spark.createDataFrame([("A",), ("funding: b|B",), ("nobody",), ("d|X",)], "spec string")
    for given in (["A", "funding: b|B", "nobody", "d|X"], filters.parse_agency_specs(specs)):
        got = filters.agency_filter(df, given)
        assert sorted(r.n for r in got.collect()) == [1, 1, 2, 2, 3, 3] and got.columns == df.columns
        assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert filters.agency_filter(df, []).count() == 10 and filters.agency_filter(df, filters.parse_agency_specs(specs.limit(0))).count() == 10
    assert filters.agency_filter(df, ["nobody"]).count() == 0


# Sketches


def test_sketches_of_files_add_up_within_their_errors(spark):
    rng = random.Random(2)
    rows = [(f"f{rng.randrange(9)}", rng.randrange(50_000), f"t{rng.randrange(300)}" if rng.random() < 0.9 else None, None) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "f string, n int, t string, none double")
    kept = sketches.column_sketches(df, ["f"])
    assert kept.count() == 27
    got = {r.column_name: r for r in sketches.estimates(sketches.merge_sketches(kept)).collect()}
    numbers = sorted(r[1] for r in rows)
    n = got["n"]
    assert (n.row_count, n.null_count, int(n.total), n.least, n.most) == (60_000, 0, sum(numbers), min(numbers), max(numbers))
    exact = len(set(numbers))
    assert abs(n.distinct_estimate - exact) <= sketches.DISTINCT_ERROR * exact
    rank = sum(x <= n.median_estimate for x in numbers) / 60_000
    assert abs(rank - 0.5) <= sketches.RANK_ERROR
    t = got["t"]
    texts = [r[2] for r in rows if r[2] is not None]
    assert t.null_count == 60_000 - len(texts) and t.text_length == sum(map(len, texts)) and abs(t.distinct_estimate - 300) <= 15 and t.median_estimate is None
    assert got["none"].null_count == 60_000 and got["none"].median_estimate is None and got["none"].distinct_estimate == 0
    by_file = sketches.merge_sketches(kept, ["f"]).where("column_name = 'n'")
    assert by_file.agg(F.sum("row_count")).first()[0] == 60_000
    assert sketches.column_sketches(df.limit(0), ["f"]).count() == 0
    assert profile.profile_distinct(df.select("n")).first().unique_count == exact


# Streams


def test_a_stream_of_nothing_is_an_empty_table(spark, tmp_path):
    take = lambda: pages.ingest_awards(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"))
    (tmp_path / "in").mkdir()
    got = take()
    assert got.count() == 0 and "PIID" in got.columns and dict(got.dtypes)["Dollars Obligated"] == "decimal(20,2)"
    (tmp_path / "in" / "ragged.csv").write_text("x,y\n1,2,3\n")
    assert take().count() == 0
    (tmp_path / "in" / "a.csv").write_text("award_id_piid,modification_number\np1,0\n")
    assert [r["PIID"] for r in take().collect()] == ["p1"]
