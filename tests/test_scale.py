"""Plans and results that must hold on tables of any size: no row goes to one task for want of a key, no work is repeated."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventloom.operators.batch import number_rows
from eventloom.operators.joins import lookup_join
from eventloom.operators.lookup import lookup_definition
from eventloom.operators.expand import decode_parms
from eventloom.operators.route import route, route_as_of, subscription_intervals
from eventloom.plans.catalog import QUERIES
from eventloom.plans.catalog.lookups import definitions
from eventloom.sources.event_logs import read_event_log_rows, read_event_logs
from eventloom.session import shared_dir
from eventloom.schema import as_events


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_intervals_have_no_frame_to_the_end(spark):
    changes = spark.createDataFrame(
        [(1, "a", "add", ["x"]), (2, "a", "add_all", None), (4, "a", "add", ["y"]), (6, "a", "remove_all", None), (7, "b", "add", ["x"])],
        "seq long, listener string, op string, ueis array<string>")
    intervals = subscription_intervals(changes)
    assert "unboundedfollowing" not in _plan(intervals).lower()
    assert {tuple(r) for r in intervals.collect()} == {
        ("a", "x", 1, 2), ("a", None, 2, 4), ("a", "y", 4, 6), ("b", "x", 7, None)}


def test_events_are_joined_once_as_of(spark):
    intervals = spark.createDataFrame(
        [("a", "x", 1, 3), ("b", None, 2, None), ("a", None, 2, 6), ("c", "d/", 0, None)], "listener string, uei string, start long, stop long")
    events = spark.createDataFrame(
        [(1, "x"), (2, "x"), (5, None), (6, "d/e"), (7, ""), (None, "x"), (0, "x")], "seq long, uei string")
    out = route_as_of(events, intervals, 4)
    got = sorted((r.seq, r.uei or "", r.listener) for r in out.collect())
    assert got == [(1, "x", "a"), (2, "x", "a"), (2, "x", "b"), (5, "", "a"), (5, "", "b"), (6, "d/e", "b"), (6, "d/e", "c"), (7, "", "b")]
    assert "Join LeftOuter" not in _plan(out)


def test_rows_without_a_key_are_spread(spark):
    """In a shuffled join, rows whose key is null are not all in one partition."""
    left = spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, F.col("id")).alias("k"))
    right = spark.range(0, 4000, 200).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    out = lookup_join(left, right.hint("merge"), {"k": "key"})
    assert out.columns == ["id", "k", "v"]
    rows = out.withColumn("part", F.spark_partition_id())
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = rows.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
    assert sorted((r.id, r.v) for r in got) == [(k, 2 * k if k % 200 == 0 else None) for k in range(4000)]
    parts = [sum(r.part == p and r.k is None for r in got) for p in {r.part for r in got}]
    assert max(parts) < 4000 / 2


def test_definitions_and_decodes_are_sent_to_the_events(spark):
    events = as_events(spark.range(5).select(F.lit("u").alias("uei"))).withColumn("def_no", F.lit(1))
    assert "rightHint=(strategy=broadcast)" in _plan(lookup_definition(events, definitions(spark)))
    decodes = spark.createDataFrame([(1, "parm[#1]", "1", "one")], "def_no int, token string, value string, text string")
    assert "rightHint=(strategy=broadcast)" in _plan(decode_parms(events, decodes))


def test_salted_routing_is_the_same(spark):
    subs = spark.createDataFrame([("audit", None), ("d", "a/"), ("e", "a/b")], "listener string, uei string")
    names = spark.range(60).select("id", F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "a/b").otherwise("c")).alias("uei"))
    want, got = route(names, subs), route(names, subs, salts=4)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_numbers_over_all_levels(spark):
    """One source at one time, cut into more parts than one level holds."""
    ids = list(range(9000))
    random.Random(3).shuffle(ids)
    rows = spark.createDataFrame([(k,) for k in ids], "no long").select(
        F.when(F.col("no") % 50 > 0, F.lit("hot")).alias("source"), F.lit("2024-01-01").cast("timestamp").alias("ts"), "no")
    got = number_rows(rows, ["source"], "ts", ["no"], slice_rows=16)
    want = rows.withColumn("want", F.row_number().over(Window.partitionBy("source").orderBy("no")))
    assert got.join(want, "no").filter("rn = want").count() == 9000
    # No row carries all bounds: each list is compared with at most 255.
    assert _plan(got).count("_bounds") >= 3


def test_params_are_made_once(spark, sf):
    for name in ("event_time", "event_time_fractions"):
        assert _plan(QUERIES[name](spark, sf)).count("map_from_entries") == 1


def test_documents_are_parsed_once(spark, sf):
    assert _plan(QUERIES["event_log_files"](spark, sf)).count("from_xml") == 1
    path = shared_dir(spark, "test-rows")
    good = "<log><events><event><uei>a</uei></event><event><uei>b</uei></event></events></log>"
    spark.createDataFrame([(good + "<log><events/></log><log><events></evnt></log> rest",)], "value string").write.text(path)
    rows = read_event_log_rows(spark, path).select("doc_no", "seq", "uei", "rejected", "doc").collect()
    assert sorted((r.doc_no, r.uei or "", r.rejected, r.doc is None) for r in rows) == [
        (0, "a", False, True), (0, "b", False, True), (2, "", True, False), (3, "", True, False)]
    events, rejects = read_event_logs(spark, path)
    assert events.count() == 2 and sorted(r.doc_no for r in rejects.collect()) == [2, 3]
