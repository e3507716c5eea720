"""Flat rows, routing, batches and metrics."""

from pyspark.sql import functions as F

from ...functions.columns import PARM_TYPE, parm
from ...functions.fixed import EVENT_COLUMNS
from ...operators.batch import (
    batch_by_source, cap_per_connection, ingest_metrics, number_rows, receipts, sort_events,
)
from ...operators.events import log_flags, serialize_list, serialize_parms, to_event_rows
from ...operators.route import effective_subscriptions, has_listener, route, route_as_of, subscription_intervals
from ...schema import as_events
from ...session import shared_dir
from ...sources.committed import read_committed, write_events_committed
from ...sources.sinks import event_rows, write_events
from .. import views as V
from .expansion import full_events
from .registry import AMOUNT, REF_TEXT, STAMP, ip_sql, query, ref_time, stamp, with_views
from .rules import dest_events

SUBSCRIPTIONS = [
    ("audit", None), ("errors", "uei.example.org/error/"), ("exact", "uei.example.org/click/u3/e"),
    ("deep", "uei.example.org/view/u1/"), ("errors", "uei.example.org/error/u1/"), ("all2", None),
    ("site", "uei.example.org/"), ("never", "uei.example.org/click/u3"),
]
ROUTED = """(select event_id, unnest(list_distinct(list_filter(['audit', 'all2',
  case when uei is not null then 'site' end,
  case when starts_with(uei, 'uei.example.org/error/') then 'errors' end,
  case when uei = 'uei.example.org/click/u3/e' then 'exact' end,
  case when starts_with(uei, 'uei.example.org/view/u1/') then 'deep' end], lambda x: x is not null))) as listener from event_names)"""


def subscriptions(spark):
    return spark.createDataFrame(SUBSCRIPTIONS, "listener string, uei string")


@query("prefix_routing", with_views("event_names") + f"select event_id, listener from {ROUTED}")
def prefix_routing(spark, sf):
    return route(V.event_names(spark, sf), subscriptions(spark)).select("event_id", "listener")


@query("null_name_routing", "select event_id, l as listener from events, (values ('audit'), ('all2')) t(l) where event_id % 50 = 0")
def null_name_routing(spark, sf):
    names = V.event_names(spark, sf).withColumn("uei", F.when(F.col("event_id") % 50 != 0, F.col("uei")))
    return route(names, subscriptions(spark)).filter(F.col("uei").isNull()).select("event_id", "listener")


def subscription_changes(spark, sf):
    """Every event is a change: the user is the listener, the type picks the kind."""
    kind = F.col("event_type")
    return V.table(spark, sf, "events").select(
        F.col("event_id").alias("seq"), (F.col("user_id") % 40).cast("string").alias("listener"),
        F.when(kind == "signup", "add_all").when(kind == "error", "remove_all").when(kind == "view", "remove")
        .otherwise("add").alias("op"),
        F.when(kind == "click", F.array(
            F.concat(F.lit("u"), (F.col("event_id") % 4).cast("string")), F.concat(F.lit("u"), (F.col("event_id") % 3).cast("string"))))
        .when(kind == "purchase", F.array().cast("array<string>"))
        .when(kind == "view", F.array(F.concat(F.lit("u"), (F.col("event_id") % 4).cast("string")))).alias("ueis"))


@query("subscription_state", """
with ch as (select event_id as seq, cast(user_id % 40 as varchar) as listener, event_type as kind,
  case event_type when 'click' then ['u' || event_id % 4, 'u' || event_id % 3] when 'view' then ['u' || event_id % 4] end as ueis
  from events where event_type <> 'purchase'),
each as (select seq, listener, kind, unnest(ueis) as uei from ch where kind in ('click', 'view')),
alive as (select distinct a.listener, a.uei from each a where a.kind = 'click'
  and not exists (select 1 from each b where b.listener = a.listener and b.uei = a.uei and b.kind = 'view' and b.seq > a.seq)
  and not exists (select 1 from ch c where c.listener = a.listener and c.kind in ('signup', 'error') and c.seq > a.seq)),
modes as (select listener, arg_max(kind, seq) as mode from ch where kind <> 'view' group by 1)
select listener, uei from alive union all select listener, null from modes where mode = 'signup'""")
def subscription_state(spark, sf):
    return effective_subscriptions(subscription_changes(spark, sf))


@query("routing_as_of", """
with ch as (select event_id as seq, cast(user_id % 40 as varchar) as listener, event_type as kind,
  case event_type when 'click' then ['u' || event_id % 4, 'u' || event_id % 3] when 'view' then ['u' || event_id % 4] end as ueis
  from events where event_type <> 'purchase'),
each as (select distinct seq, listener, kind, unnest(ueis) as uei from ch where kind in ('click', 'view')),
named as (select a.listener, a.uei, a.seq as start,
  least((select min(b.seq) from each b where b.listener = a.listener and b.uei = a.uei and b.seq > a.seq),
        (select min(c.seq) from ch c where c.listener = a.listener and c.kind in ('signup', 'error') and c.seq > a.seq)) as stop
  from each a where a.kind = 'click'),
every as (select a.listener, a.seq as start,
  (select min(c.seq) from ch c where c.listener = a.listener and c.kind <> 'view' and c.seq > a.seq) as stop from ch a where a.kind = 'signup')
select event_id, listener from events e join named i on i.uei = 'u' || e.event_id % 5 and i.start <= e.event_id and (i.stop is null or e.event_id < i.stop)
union
select event_id, listener from events e join every i on i.start <= e.event_id and (i.stop is null or e.event_id < i.stop)""")
def routing_as_of(spark, sf):
    """Each event goes to those who were subscribed when it came, while the same events change the subscriptions."""
    events = V.table(spark, sf, "events").select("event_id", F.concat(F.lit("u"), (F.col("event_id") % 5).cast("string")).alias("uei"))
    return route_as_of(events, subscription_intervals(subscription_changes(spark, sf)), 256, seq="event_id").select("event_id", "listener")


@query("listener_summary", """
select uei, true as has_listener from (select distinct concat('uei.example.org/', event_type) as uei from events)""")
def listener_summary(spark, sf):
    subs = V.table(spark, sf, "events").select(
        (F.col("user_id") % 10).cast("string").alias("listener"),
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("uei.example.org/"), "event_type")).alias("uei"))
    return has_listener(subs)


@query("log_flags", """
select event_id, case event_id % 6 when 0 then 'Y' when 3 then 'N' end as eventlog,
  case event_id % 6 when 0 then 'Y' when 3 then 'N' end as eventdisplay from events""")
def log_flags_query(spark, sf):
    log, display = log_flags(F.col("logmsg.dest"), F.col("logmsg").isNotNull())
    return dest_events(spark, sf).select("event_id", log.alias("eventlog"), display.alias("eventdisplay"))


@query("delimited_text", f"""
select event_id, concat('user=', user_id, '(string,text);kind=', event_type, '%59%61x(string,text);amount=', {AMOUNT}, '(string,text)') as parms,
  concat('a%44', event_type, ',on;b%59,off') as actions from events""")
def delimited_text(spark, sf):
    events = V.table(spark, sf, "events").select(
        "event_id",
        F.array(
            parm("user", F.col("user_id")), parm("kind", F.concat("event_type", F.lit(";=x"))),
            parm("amount", F.round(F.col("value") * 100).cast("bigint")),
        ).cast(PARM_TYPE).alias("parms"),
        F.array(
            F.struct(F.concat(F.lit("a,"), "event_type").alias("content"), F.lit("on").alias("state")),
            F.struct(F.lit("b;").alias("content"), F.lit("off").alias("state")),
        ).alias("actions"))
    return events.select("event_id", serialize_parms(F.col("parms")).alias("parms"),
                         serialize_list(F.col("actions"), ["content", "state"]).alias("actions"))


@query("event_rows", with_views("node_events") + f"""
select event_id as eventid, uei as eventuei, nodeid, strftime(ts, {STAMP}) as eventtime, interface as eventhost, interface as ipaddr,
  'dp1' as systemid, concat('svc', event_id % 4) as service_name, left(concat(repeat('x', 30), event_type), 32) as eventloggroup,
  concat('a b', event_type) as eventlogmsg, case when event_id % 2 = 0 then 'Y' else 'N' end as eventlog,
  case when event_id % 2 = 0 then 'N' else 'Y' end as eventdisplay, case when event_id % 3 = 0 then 5 else 1 end as eventseverity,
  case when event_id % 4 = 0 then 'T1' end as eventtticket, case when event_id % 4 = 0 then case when event_id % 8 = 0 then 1 else 0 end end as eventtticketstate,
  case when event_id % 5 = 0 then 'ann' end as eventackuser, case when event_id % 5 = 0 then '{REF_TEXT}' end as eventacktime,
  '{REF_TEXT}' as eventcreatetime, left(repeat('m', 60) || event_type, 64) as eventmouseovertext, 'agent' as eventsource,
  case when event_id % 2 = 0 then event_id % 8 end as ifindex from node_events""")
def event_rows_query(spark, sf):
    k = F.col("event_id")
    events = full_events(spark, sf).withColumns({
        "dbid": k,
        "loggroup": F.array(F.concat(F.repeat(F.lit("x"), 30), "event_type")),
        "logmsg": F.struct(F.when(k % 2 == 0, "logonly").otherwise("displayonly").alias("dest"),
                           F.concat(F.lit("a\x00b"), "event_type").alias("content")),
        "tticket": F.when(k % 4 == 0, F.struct(F.lit("T1").alias("content"), F.when(k % 8 == 0, "on").otherwise("off").alias("state"))),
        "autoacknowledge": F.struct(F.lit("ann").alias("content"), F.when(k % 5 == 0, "on").otherwise("off").alias("state")),
        "mouseovertext": F.concat(F.repeat(F.lit("m"), 60), "event_type"),
    })
    rows = to_event_rows(events, ref_time())
    assert rows.columns == EVENT_COLUMNS
    return rows.withColumn("service_name", F.concat(F.lit("svc"), (F.col("eventid") % 4).cast("string"))).select(
        "eventid", "eventuei", "nodeid", stamp("eventtime").alias("eventtime"), "eventhost", "ipaddr", "systemid",
        "service_name", "eventloggroup", "eventlogmsg", "eventlog", "eventdisplay", "eventseverity", "eventtticket",
        "eventtticketstate", "eventackuser", stamp("eventacktime").alias("eventacktime"),
        stamp("eventcreatetime").alias("eventcreatetime"), "eventmouseovertext", "eventsource", "ifindex")


@query("event_table_sink", "select event_type as eventlogmsg, count(*) as n from events where event_id % 6 in (0, 5) group by 1")
def event_table_sink(spark, sf):
    path = shared_dir(spark, "event-table")
    write_events(as_events(dest_events(spark, sf)), path)
    return spark.read.parquet(path).groupBy("eventlogmsg").agg(F.count(F.lit(1)).alias("n"))


@query("committed_events", """
select event_id % 3 as batch_id, event_type as eventlogmsg, count(*) as n from events where event_id % 6 in (0, 5) group by 1, 2""")
def committed_events(spark, sf):
    """Three batches, of which one is left half-written first and one is repeated."""
    path = shared_dir(spark, "committed-events")
    events = dest_events(spark, sf)
    half = event_rows(as_events(events.filter("event_id % 3 = 0")))
    half.write.parquet(f"{path}/data/batch_id=0/attempt=half")
    for batch in (0, 1, 2, 2):
        write_events_committed(as_events(events.filter(F.col("event_id") % 3 == batch)), path, batch)
    return read_committed(spark, path, half.schema).groupBy("batch_id", "eventlogmsg").agg(F.count(F.lit(1)).alias("n"))


BATCH_SQL = with_views("packets") + """
select source_ip, source_port, batch_no, count(*) as items, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as first_ts,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last_ts, string_agg(cast(event_id as varchar), ',' order by ts, event_id) as payloads
from (select *, (row_number() over (partition by source_ip, source_port order by ts, event_id) - 1) // 5 as batch_no from packets)
group by 1, 2, 3"""
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@query("source_batches", BATCH_SQL)
def source_batches(spark, sf):
    out = batch_by_source(V.packets(spark, sf), 5, payload="event_id", slice_seconds=86400)
    return out.select("source_ip", "source_port", "batch_no", "items", stamp("first_ts", MICROS).alias("first_ts"),
                      stamp("last_ts", MICROS).alias("last_ts"), F.array_join("payloads", ",").alias("payloads"))


@query("source_batches_timed", with_views("packets") + f"""
select source_ip, source_port, strftime(time_bucket(interval '1 day', ts), {STAMP}) as slot, batch_no, count(*) as items
from (select *, (row_number() over (partition by source_ip, source_port, time_bucket(interval '1 day', ts) order by ts, event_id) - 1) // 2 as batch_no
  from packets) group by 1, 2, 3, 4""")
def source_batches_timed(spark, sf):
    return batch_by_source(V.packets(spark, sf), 2, interval=86400).select(
        "source_ip", "source_port", stamp("slot").alias("slot"), "batch_no", "items")


@query("hot_source_batches", """
select batch_no, count(*) as items, min(event_id) as first_id, max(event_id) as last_id
from (select event_id, (row_number() over (order by event_id) - 1) // 5 as batch_no from events) group by 1""")
def hot_source_batches(spark, sf):
    """One source with all packets at the same time: numbered in parts of about a thousand rows."""
    packets = V.packets(spark, sf).withColumns({"source_ip": F.lit("hot"), "ts": F.lit(REF_TEXT).cast("timestamp")})
    numbered = number_rows(packets, ["source_ip"], "ts", ["event_id"], slice_rows=1000)
    return numbered.groupBy(F.floor((F.col("rn") - 1) / 5).alias("batch_no")).agg(
        F.count(F.lit(1)).alias("items"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))


@query("event_sort", """
select event_id, user_id as log_id, row_number() over (order by user_id,
  case when event_id % 5 = 0 then null else ts end nulls first, event_id) as place from events""")
def event_sort(spark, sf):
    """Rows come out in global order; the place is added for the comparison only.

    ``monotonically_increasing_id`` numbers the sorted partitions, and counts of the
    partitions before turn that into a place.
    """
    events = V.table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("log_id"), F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("time"))
    ordered = sort_events(events, seq="event_id").withColumn("_id", F.monotonically_increasing_id())
    ordered = ordered.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)})
    path = shared_dir(spark, "sorted")
    ordered.write.parquet(path)
    done = spark.read.parquet(path)
    sizes = {r["_part"]: r["n"] for r in done.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for part in sorted(sizes):
        before += [F.lit(part), F.lit(total)]
        total += sizes[part]
    offset = F.create_map(*before)[F.col("_part")] if before else F.lit(0)
    return done.select("event_id", "log_id", (F.col("_at") + offset + 1).cast("bigint").alias("place"))


@query("connection_cap", with_views("packets") + """
select source_ip, source_port, event_id from (select *, row_number() over (partition by source_ip, source_port order by ts, event_id) as rn
  from packets) where rn <= 3""")
def connection_cap(spark, sf):
    return cap_per_connection(V.packets(spark, sf), 3, ("source_ip", "source_port"), order=("event_id",)).select(
        "source_ip", "source_port", "event_id")


@query("receipts", f"""
select {ip_sql('user_id')} as sender, strftime(date_trunc('day', ts), {STAMP}) as log_id,
  string_agg(distinct concat('u', event_id // 2), ',' order by concat('u', event_id // 2)) as uuids
from events where event_id % 3 <> 0 group by 1, 2""")
def receipts_query(spark, sf):
    events = V.table(spark, sf, "events").select(
        V.ip_of(F.col("user_id")).alias("sender"), stamp(F.date_trunc("day", "ts")).alias("log_id"),
        F.when(F.col("event_id") % 3 != 0, F.concat(
            F.lit("u"), F.floor(F.col("event_id") / 2).cast("bigint").cast("string"))).alias("uuid"))
    return receipts(events).select("sender", "log_id", F.array_join("uuids", ",").alias("uuids"))


@query("ingest_metrics", with_views("packets") + f"""
select strftime(date_trunc('hour', ts), {STAMP}) as slot, count(*) as packets, cast(sum(size_bytes) as bigint) as bytes,
  min(size_bytes) as min_size, max(size_bytes) as max_size,
  cast(round(quantile_cont(size_bytes, 0.5) * 100) as bigint) as p50, cast(round(quantile_cont(size_bytes, 0.95) * 100) as bigint) as p95
from packets group by 1""")
def ingest_metrics_query(spark, sf):
    out = ingest_metrics(V.packets(spark, sf), 3600)
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    return out.select(stamp("slot").alias("slot"), "packets", "bytes", "min_size", "max_size",
                      cents("p50_size").alias("p50"), cents("p95_size").alias("p95"))
