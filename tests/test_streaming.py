import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.events import is_reload, to_events
from eventloom.plans.catalog.lookups import DEFAULT_UEI, definitions
from eventloom.plans.catalog.rules import RULES
from eventloom.plans.catalog.streams import _config, _envelope
from eventloom.plans.catalog.text import PATTERNS
from eventloom.plans.flow import Config, build_events, parse_messages
from eventloom.plans import views as V
from eventloom.session import shared_dir
from eventloom.sources.envelopes import read_envelopes
from eventloom.streaming.batch_log import with_late_rows, with_versions
from eventloom.streaming.size_or_time import batch_by_size_or_time
from eventloom.streaming.stream import (
    Sinks, batch_by_source_stream, needed_later, process_batch, reload_result, split_errors, with_reload, write_batch_folder,
)


def _events(spark, uei):
    return spark.createDataFrame([(uei,)], "uei string").withColumn(
        "parms", F.array().cast("array<struct<name:string,value:string>>"))


def test_reload_failure_keeps_state(spark):
    states, emitted = [], []
    answers = iter(["first", RuntimeError("no file"), "second"])

    def reader():
        answer = next(answers)
        if isinstance(answer, Exception):
            raise answer
        return answer

    def batch(df, batch_id, state):
        states.append(state)
        return df

    step = with_reload(batch, reader, is_reload("r", "changed", "d"), lambda reason, i, s: emitted.append((i, reason)))
    for i, uei in enumerate(["other", "changed", "changed", "other"]):
        step(_events(spark, uei), i)
    assert states == ["first", "first", "first", "second"]
    assert emitted == [(1, "no file"), (2, None)]


def test_reload_result(spark):
    failed = reload_result(spark, "ok", "events", "x" * 500).first()
    assert [(p["name"], len(p["value"])) for p in failed.parms] == [("daemonName", 6), ("reason", 128)]
    assert len(reload_result(spark, "ok", "events", None).first().parms) == 1


def test_stream_equals_batch(spark, sf):
    """The streamed batches hold each packet once, cut at the size."""
    root = shared_dir(spark, "test-stream")
    V.packets(spark, sf).repartition(4).write.parquet(f"{root}/in")
    packets = spark.readStream.schema(spark.read.parquet(f"{root}/in").schema).option("maxFilesPerTrigger", "4").parquet(f"{root}/in")
    out = batch_by_source_stream(packets, "30 days", "0 seconds", 3, "event_id", shards=2)
    run = out.writeStream.outputMode("update").foreachBatch(
        lambda df, i: write_batch_folder(df, f"{root}/out", i)).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    run.awaitTermination()
    rows = spark.read.parquet(f"{root}/out").collect()
    assert max(len(r.payloads) for r in rows) <= 3
    assert sorted(x for r in rows for x in r.payloads) == [r.event_id for r in V.packets(spark, sf).orderBy("event_id").collect()]


def test_flow_in_batch(spark, sf):
    """The lazy plan of the stream, run once over the table."""
    config = _config(spark, sf)
    envelopes = read_envelopes(_envelope(V.raw_mixed(spark, sf)).select("value"))
    good, bad = split_errors(parse_messages(envelopes, config, F.col("msg_time")))
    events = build_events(good, config)
    rows = events.filter("uei = 'uei.example.org/view'").select("severity", "descr", "nodeid", "interface").collect()
    assert rows and {(r.severity, r.descr) for r in rows} == {("Warning", "100 sure %")}
    assert bad.count() > 0


def _plain_batches(items, size, seconds, mark):
    """(payloads, reason) of one source's (second, place) items that leave up to ``mark``."""
    out, held = [], []
    for at, place in sorted(x for x in items if x[0] <= mark):
        if held and at >= held[0][0] + seconds:
            out.append(([str(p) for _, p in held], "time"))
            held = []
        held.append((at, place))
        if len(held) == size:
            out.append(([str(p) for _, p in held], "size"))
            held = []
    if held and held[0][0] + seconds <= mark:
        out.append(([str(p) for _, p in held], "time"))
    return out


def test_size_or_time_over_restarts(spark):
    """Items out of order inside the watermark, three runs over one checkpoint: each item is in one batch."""
    root = shared_dir(spark, "test-size-or-time")
    rng = random.Random(11)
    items = [(f"s{k % 3}", int(10 * k + rng.randint(-40, 40)), k) for k in range(120)] + [("end", 2000, 999)]
    for turn in range(3):
        part = items[turn * 40:(turn + 1) * 40 + (turn == 2)]
        spark.createDataFrame(part, "source string, s long, no long").withColumn("ts", F.timestamp_seconds("s")).coalesce(1).write.parquet(f"{root}/in/part={turn}")
        stream = spark.readStream.schema("source string, s long, no long, ts timestamp").parquet(f"{root}/in/*")
        out = batch_by_size_or_time(stream, 4, 60, "100 seconds", "no", "no", keys=("source",), shards=1)
        run = out.writeStream.outputMode("append").foreachBatch(
            lambda df, i: write_batch_folder(df, f"{root}/out", i)).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
        run.awaitTermination()
    rows = sorted(spark.read.parquet(f"{root}/out").collect(), key=lambda r: (r.source, r.batch_no))
    for source in ("s0", "s1", "s2"):
        mine = [r for r in rows if r.source == source]
        want = _plain_batches([(s, k) for x, s, k in items if x == source], 4, 60, 1900)
        assert [(r.payloads, r.reason) for r in mine] == want
        assert [r.batch_no for r in mine] == list(range(len(want)))
    assert {r.reason for r in rows} == {"size", "time"}


def test_late_rows_and_a_repeated_batch(spark):
    root = shared_dir(spark, "test-late")
    seen = {}

    def keep(df, batch_id):
        seen[batch_id] = sorted(r.s for r in df.filter("s is not null").collect()), df.filter("s is null").count()
        if len(seen) == 2 and not fails:
            fails.append(1)
            raise RuntimeError("lost")

    fails = []
    step = with_late_rows(keep, "ts", 10, f"{root}/late", f"{root}/log")

    def batch(*seconds):
        return spark.createDataFrame([(s,) for s in seconds], "s int").withColumn("ts", F.timestamp_seconds("s"))

    step(batch(100, 50, None), 0)
    with pytest.raises(RuntimeError):
        step(batch(89, 90, 300), 1)
    step(batch(89, 90, 300), 1)
    step(batch(200, 290, None), 2)
    assert seen == {0: ([50, 100], 1), 1: ([90, 300], 0), 2: ([290], 1)}
    late = {(r.batch_id, r.s, r.reject_reason) for r in spark.read.parquet(f"{root}/late").collect()}
    assert late == {(1, 89, "late"), (2, 200, "late")}


def test_version_in_force_survives_a_restart(spark):
    """A batch killed behind a reload, then a new process: it works on the version it first had."""
    root = shared_dir(spark, "test-versions")
    used, emitted, files = [], [], {"now": "v1", "bad": {"v3"}}

    def read(version):
        if version in files["bad"]:
            raise RuntimeError(f"no {version}")
        return version

    def start(fail_on=None):
        def batch(df, batch_id, state):
            used.append((batch_id, state))
            if batch_id == fail_on:
                raise RuntimeError("killed")
            return df

        return with_versions(batch, lambda: files["now"], read, is_reload("r", "changed", "d"),
                             lambda reason, i, s: emitted.append((i, reason)), f"{root}/log")

    step = start()
    step(_events(spark, "other"), 0)
    files["now"] = "v2"
    step(_events(spark, "changed"), 1)
    files["now"] = "v3"
    with pytest.raises(RuntimeError):
        start(fail_on=2)(_events(spark, "changed"), 2)
    start()(_events(spark, "changed"), 2)
    start()(_events(spark, "other"), 3)
    assert used == [(0, "v1"), (1, "v1"), (2, "v2"), (2, "v2"), (3, "v2")]
    assert emitted == [(1, None), (2, "no v3")]


def _cached_batches(df):
    """Batches that a persisted frame is kept in, after it was run."""
    return df._jdf.queryExecution().withCachedData().cacheBuilder().cachedColumnBuffers().count()


def test_a_batch_is_kept_in_small_parts(spark):
    """What a micro-batch persists is narrow and in batches of 500 rows, whatever the session's own size."""
    root = shared_dir(spark, "test-kept")
    raw = F.when(F.col("id") % 4 == 0, F.lit("<11>& first\nrest")).otherwise(F.concat(F.lit("<14>host1@ 2024-01-01 did signup amount "), "id"))
    lines = spark.range(0, 2000, 1, 1).select(
        F.lit(1).alias("event_id"), F.lit("2024-01-01").cast("timestamp").alias("ts"), F.col("id").alias("user_id"), raw.alias("raw"))
    rules = [r for r in RULES if r.rule_no != 7]
    config = Config(patterns=PATTERNS, rules=rules, discard_uei="DISCARD", definitions=definitions(spark), default_uei=DEFAULT_UEI)
    subscriptions = spark.createDataFrame([("audit", None)], "listener string, uei string")
    held = spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize")
    sinks = Sinks(f"{root}/table", f"{root}/routed", f"{root}/errors")
    events = process_batch(_envelope(lines).select("value"), 0, config, subscriptions, sinks)
    try:
        assert _cached_batches(events) >= 3
        assert "def" not in events.columns and events.count() == 1500
    finally:
        events.unpersist()
    assert spark.conf.get("spark.sql.inMemoryColumnarStorage.batchSize") == held
    bad = spark.read.parquet(sinks.errors)
    assert bad.filter("value like '<syslog-message-log%' and raw like '%first%'").count() == bad.count() == 500
    assert spark.read.parquet(sinks.table).count() == spark.read.parquet(sinks.routed).count() == 1500


def test_only_what_is_read_later_is_kept(spark, sf):
    """Errors and events are the same from the narrow messages, and whole envelopes stay with the errors alone."""
    config = _config(spark, sf)
    envelopes = read_envelopes(_envelope(V.raw_mixed(spark, sf)).select("value"))
    whole = parse_messages(envelopes, config, F.col("msg_time"))
    narrow = needed_later(whole)
    assert not {"params", "pattern_no", "msg_time"} & set(narrow.columns)
    assert narrow.filter("value is not null and reject_reason is null").isEmpty()
    (good, bad), (few, errors) = split_errors(whole), split_errors(narrow)
    assert errors.columns == bad.columns and errors.exceptAll(bad).isEmpty() and bad.exceptAll(errors).isEmpty()
    wide, slim = to_events(good), to_events(few)
    assert slim.columns == wide.columns and slim.exceptAll(wide).isEmpty() and wide.exceptAll(slim).isEmpty()
