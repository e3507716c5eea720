"""Streams over the events table, run to its end and read back."""

from pyspark.sql import functions as F

from ...operators.events import is_reload
from ...operators.expand import fill_from_definition
from ...operators.lookup import lookup_definition
from ...schema import as_events
from ...session import shared_dir
from ...sources.config import read_event_defs
from ...sources.kafka import read_file_logs
from ...streaming.batch_log import with_late_rows
from ...streaming.size_or_time import batch_by_size_or_time
from ...streaming.stream import Sinks, batch_by_source_stream, run_stream, split_errors, with_reload, reload_result, write_batch_folder
from ..flow import Config, parse_messages
from .. import views as V
from .lookups import DEFAULT_UEI, definitions
from .registry import BODY, CODE, STAMP, facility_sql, query, ref_time, severity_sql, stamp, with_views
from .rules import RULES
from .text import MIXED, PATTERNS, _envelope


def _envelope_files(spark, sf):
    path = shared_dir(spark, "envelopes")
    _envelope(V.raw_mixed(spark, sf)).select("value").write.text(path)
    return path


def _config(spark, sf):
    return Config(
        patterns=PATTERNS, rules=[r for r in RULES if r.rule_no != 7], discard_uei="DISCARD",
        definitions=definitions(spark), default_uei=DEFAULT_UEI, interfaces=V.interfaces(spark, sf),
        nodes=V.nodes(spark, sf),
    )


_RUNS: dict[tuple[str, str], Sinks] = {}


def _run_flow(spark, sf):
    """Run the whole stream, once per session and tables, and return where its outputs are."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = _flow_outputs(spark, sf)
    return _RUNS[key]


def _flow_outputs(spark, sf):
    root = shared_dir(spark, "stream")
    sinks = Sinks(f"{root}/table", f"{root}/routed", f"{root}/errors", f"{root}/control", f"{root}/metrics")
    subs = spark.createDataFrame(
        [("audit", None), ("view", "uei.example.org/view"), ("lines", "uei.example.org/syslog/")], "listener string, uei string")
    source = read_file_logs(spark, _envelope_files(spark, sf), wholetext=False)
    run = run_stream(source, _config(spark, sf), subs, sinks, f"{root}/checkpoint", available_now=True)
    run.awaitTermination()
    return sinks


RULED = f"""with {MIXED}, base as (select m.*, {facility_sql('coalesce(m.facility_code, 99)')} as facility,
  {severity_sql('coalesce(m.facility_code, 99)')} as severity from mixed m where pattern_no <> 5),
ruled as (select *, case when contains(message, 'did view') then 1
  when facility in ('local0', 'local1') and regexp_matches(message, 'amount ([0-9]+)') then 2
  when severity = 'Error' and regexp_matches(message, 'did (error|click)') then 3
  when process_name is not null and starts_with(process_name, 'sign') and regexp_matches(message, 'user ([0-9]+) did ([a-z]+)') then 4
  when hostname is not null and regexp_matches(hostname, 'host1[0-9]') and regexp_matches(message, 'user ([0-9]+) did ([a-z]+)') then 5
  end as rule_no from base),
named as (select *, case rule_no when 1 then 'uei.example.org/view' when 2 then 'uei.example.org/local'
  when 4 then 'uei.example.org/pair' when 5 then 'uei.example.org/any'
  else concat('uei.example.org/syslog/', facility, '/', severity) end as uei from ruled where coalesce(rule_no, 0) <> 3)
"""


@query("stream_flow", RULED + """
select uei as eventuei, case when uei = 'uei.example.org/view' then 'Warning' end as expected, message, count(*) as n from named group by all""")
def stream_flow(spark, sf):
    """The event table that the stream leaves. The log message is the line's own, so every event is stored."""
    rows = spark.read.parquet(_run_flow(spark, sf).table)
    return rows.groupBy("eventuei", F.col("eventlogmsg").alias("message")).agg(F.count(F.lit(1)).alias("n")).select(
        "eventuei", F.when(F.col("eventuei") == "uei.example.org/view", "Warning").alias("expected"), "message", "n")


@query("stream_dual_publish", RULED + """
select listener, uei, message, count(*) as n from (select 'audit' as listener, * from named union all
  select 'view', * from named where uei = 'uei.example.org/view' union all
  select 'lines', * from named where starts_with(uei, 'uei.example.org/syslog/')) group by all""")
def stream_dual_publish(spark, sf):
    rows = spark.read.parquet(_run_flow(spark, sf).routed)
    return rows.groupBy("listener", "uei", F.col("logmsg").alias("message")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_errors", f"""
select 'interior_newline' as reject_reason, concat('<', {CODE}, '>& first', chr(10), {BODY}) as raw, count(*) as n
from events where event_id % 6 = 5 group by all""")
def stream_errors(spark, sf):
    rows = spark.read.parquet(_run_flow(spark, sf).errors)
    return rows.groupBy("reject_reason", "raw").agg(F.count(F.lit(1)).alias("n"))


@query("stream_metrics", RULED + """
select 'logs' as stage, count(*) as n from events union all select 'messages', count(*) from events
union all select 'errors', count(*) from events where event_id % 6 = 5
union all select 'events', count(*) from named
union all select 'broadcast', count(*) + count(*) filter (where uei = 'uei.example.org/view' or starts_with(uei, 'uei.example.org/syslog/')) from named""")
def stream_metrics(spark, sf):
    """What each stage of the stream counted while it ran, over all batches."""
    rows = spark.read.parquet(_run_flow(spark, sf).metrics)
    return rows.groupBy("stage").agg(F.sum("rows").alias("n"))


@query("error_split", f"select event_id, 'interior_newline' as reject_reason from events where event_id % 6 = 5")
def error_split(spark, sf):
    flagged = parse_messages(V.raw_mixed(spark, sf), Config(PATTERNS, RULES), ref_time())
    return split_errors(flagged)[1].select("event_id", "reject_reason")


@query("kafka_log_replay", f"""
select event_id, case when event_id % 6 = 4 then concat('no priority ', {BODY}) end as raw from events""")
def kafka_log_replay(spark, sf):
    """Records of the log topic's shape, replayed from files as a stream."""
    root = shared_dir(spark, "replay")
    lines = V.raw_mixed(spark, sf).select(F.to_json(F.struct("event_id", "raw")).alias("value"))
    lines.write.text(f"{root}/in")
    source = read_file_logs(spark, f"{root}/in", wholetext=False)
    run = source.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    record = F.from_json("value", "event_id bigint, raw string")
    found = spark.read.parquet(f"{root}/out").select(record.alias("r")).select("r.*")
    return found.select("event_id", F.when(F.col("event_id") % 6 == 4, F.col("raw")).alias("raw"))


@query("stream_reload", """
select 'uei.example.org/internal/reloadSuccessful' as uei, 'daemonName=events' as parms, 'first' as descr_before, 'second' as descr_after
from events where event_type = 'signup' having count(*) > 0""")
def stream_reload(spark, sf):
    """A control event makes the stream read its definition file again: the next batch shows the changed text."""
    root = shared_dir(spark, "reload")
    events = V.table(spark, sf, "events").select("event_id", "event_type")
    events.write.parquet(f"{root}/in/part=0")
    versions = iter(["first", "second"])

    def reader():
        text = next(versions)
        path = f"{root}/definitions-{text}"
        xml = f"<events><event><uei>{DEFAULT_UEI}</uei><descr>{text}</descr><severity>Minor</severity></event></events>"
        spark.createDataFrame([(xml,)], "value string").write.text(path)
        return read_event_defs(spark, path)

    def batch(df, batch_id, defs):
        named = as_events(df.select("event_id", F.concat(F.lit("uei.example.org/"), "event_type").alias("uei")))
        filled = fill_from_definition(lookup_definition(named, defs, DEFAULT_UEI))
        write_batch_folder(filled.groupBy("descr").agg(F.count(F.lit(1)).alias("n")), f"{root}/seen", batch_id)
        return filled

    def emit(reason, batch_id, session):
        result = reload_result(session, "uei.example.org/internal/reloadSuccessful", "events", reason)
        write_batch_folder(result.select("uei", "parms"), f"{root}/out", batch_id)

    step = with_reload(batch, reader, is_reload("uei.example.org/reload", "uei.example.org/signup", "events"), emit)
    for turn in range(2):
        if turn:
            events.filter("event_type <> 'signup'").write.parquet(f"{root}/in/part=1")
        run = spark.readStream.schema(events.schema).parquet(f"{root}/in/*").writeStream.foreachBatch(step).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
    seen = spark.read.parquet(f"{root}/seen").agg(
        F.min_by("descr", "batch_id").alias("descr_before"), F.max_by("descr", "batch_id").alias("descr_after"))
    shown = F.array_join(F.transform("parms", lambda p: F.concat(p["name"], F.lit("="), p["value"])), ",").alias("parms")
    # One row each: the reload's answer and the two texts.
    told = spark.read.parquet(f"{root}/out").select(F.lit(1).alias("one"), "uei", shown)
    return told.join(seen.withColumn("one", F.lit(1)), "one").drop("one")


@query("stream_source_batches", with_views("packets") + f"""
select source_ip, source_port, strftime(slot, {STAMP}) as slot, batch_no, string_agg(cast(event_id as varchar), ',' order by ts, event_id) as payloads
from (select *, (row_number() over (partition by source_ip, source_port, slot order by ts, event_id) - 1) // 2 as batch_no
  from (select *, time_bucket(interval '1 hour', ts) as slot from packets)) group by 1, 2, 3, 4""")
def stream_source_batches(spark, sf):
    """Each batch comes out once, when its interval is over; a packet of a far later time ends them all."""
    root = shared_dir(spark, "batches")
    packets = V.packets(spark, sf)
    last = packets.limit(1).withColumn("ts", F.lit("2100-01-01").cast("timestamp"))
    packets.union(last).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(packets.schema).parquet(f"{root}/in")
    batches = batch_by_source_stream(stream, "1 hour", "0 seconds", 2, "event_id", shards=1)
    run = batches.writeStream.outputMode("append").foreachBatch(
        lambda df, batch_id: write_batch_folder(df, f"{root}/out", batch_id)
    ).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "source_ip", "source_port", stamp("slot").alias("slot"), F.col("batch_no").cast("bigint").alias("batch_no"),
        F.array_join("payloads", ",").alias("payloads"))


@query("stream_size_or_time", "with recursive " + with_views("packets")[len("with "):] + """, item as (
  select source_ip, source_port, event_id, row_number() over own as rn,
    count(*) over (own range between unbounded preceding and interval '5 days 23 hours 59 minutes 59.999999 seconds' following) as inside,
    count(*) over (partition by source_ip, source_port) as n from packets window own as (partition by source_ip, source_port order by ts)),
numbered as (select source_ip, source_port, event_id, inside, n,
    row_number() over (partition by source_ip, source_port order by rn, event_id) as rn from item),
step as (select *, least(rn + 4, inside + 1) as following from numbered),
batch as (
  select source_ip, source_port, rn, following, 0 as batch_no from step where rn = 1
  union all
  select s.source_ip, s.source_port, s.rn, s.following, b.batch_no + 1 from batch b join step s
    on s.source_ip = b.source_ip and s.source_port = b.source_port and s.rn = b.following)
select b.source_ip, b.source_port, b.batch_no, case when b.following - b.rn = 4 then 'size' else 'time' end as reason,
  string_agg(cast(s.event_id as varchar), ',' order by s.rn) as payloads
from batch b join step s on s.source_ip = b.source_ip and s.source_port = b.source_port and s.rn >= b.rn and s.rn < b.following
group by all""")
def stream_size_or_time(spark, sf):
    """Batches of four packets, or of six days from their first; a packet of a far later time ends them all."""
    root = shared_dir(spark, "size-or-time")
    packets = V.packets(spark, sf)
    last = packets.limit(1).withColumn("ts", F.lit("2100-01-01").cast("timestamp"))
    packets.union(last).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(packets.schema).parquet(f"{root}/in")
    batches = batch_by_size_or_time(stream, 4, 6 * 86400, "0 seconds", "event_id", "event_id", shards=1)
    run = batches.writeStream.outputMode("append").foreachBatch(
        lambda df, batch_id: write_batch_folder(df, f"{root}/out", batch_id)
    ).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(
        "source_ip", "source_port", "batch_no", "reason", F.array_join("payloads", ",").alias("payloads"))


@query("stream_late_rows", """
with mark as (select max(ts) filter (where event_id % 3 = 0) - interval '10 days' as first_mark,
  max(ts) filter (where event_id % 3 <> 2) - interval '10 days' as second_mark from events)
select event_id, case when event_id % 3 = 1 and ts < first_mark or event_id % 3 = 2 and ts < second_mark then 'late' end as reject_reason
from events, mark""")
def stream_late_rows(spark, sf):
    """Three batches over the same days: rows ten days behind what came before go to the error channel."""
    root = shared_dir(spark, "late")
    events = V.table(spark, sf, "events").select("event_id", "ts")
    step = with_late_rows(lambda df, batch_id: write_batch_folder(df, f"{root}/good", batch_id), "ts", 10 * 86400, f"{root}/late", f"{root}/log")
    for turn in range(3):
        events.filter(F.col("event_id") % 3 == turn).coalesce(1).write.parquet(f"{root}/in/part={turn}")
        run = spark.readStream.schema(events.schema).parquet(f"{root}/in/*").writeStream.foreachBatch(step).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        run.awaitTermination()
    good = spark.read.parquet(f"{root}/good").select("event_id", F.lit(None).cast("string").alias("reject_reason"))
    return good.union(spark.read.parquet(f"{root}/late").select("event_id", "reject_reason"))
