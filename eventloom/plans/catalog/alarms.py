"""Alarms reduced from events."""

from pyspark.sql import functions as F

from ...operators.alarms import reduce_alarms
from ...operators.expand import alarm_keys
from ...schema import ALARM
from .. import views as V
from .registry import STAMP, query, stamp, with_views

SEVERITIES = {"error": "Major", "purchase": "Normal", "signup": "Warning"}


def alarm_events(spark, sf):
    """Errors raise an alarm of their node, purchases clear it; two types have one alarm in all, the rest one per user."""
    kind = F.col("event_type")
    key = F.when(kind == "click", F.lit("clicks")).otherwise(F.concat_ws(":", kind, F.col("nodeid").cast("string")))
    known = F.when(F.col("nodeid").isNotNull() | (kind == "click"), key)
    clear = F.when(F.col("event_id") % 11 == 0, F.lit("clicks")).otherwise(F.concat(F.lit("error:"), F.col("nodeid").cast("string")))
    data = F.struct(
        F.when(kind == "error", 1).when(kind == "purchase", 2).otherwise(3).alias("alarm_type"), known.alias("reduction_key"),
        F.when(kind == "purchase", clear).alias("clear_key"), F.lit(True).alias("auto_clean"), F.lit(None).alias("x733_alarm_type"),
        F.lit(None).alias("x733_probable_cause"), F.lit(None).alias("update_fields"))
    severity = F.coalesce(*[F.when(kind == k, v) for k, v in SEVERITIES.items()], F.lit("Indeterminate"))
    return alarm_keys(V.node_events(spark, sf).withColumns({"alarm_data": data.cast(ALARM), "severity": severity}))


@query("alarm_reduction", with_views("node_events", more="""
a as (select event_id, ts, case event_type when 'error' then 1 when 'purchase' then 2 else 3 end as alarm_type,
  case when event_type = 'click' then 'clicks' else concat(event_type || ':', cast(nodeid as varchar)) end as k,
  nodeid is null and event_type <> 'click' as unknown,
  case when event_type = 'purchase' then case when event_id % 11 = 0 then 'clicks' else 'error:' || cast(nodeid as varchar) end end as c,
  case event_type when 'error' then 'Major' when 'purchase' then 'Normal' when 'signup' then 'Warning' else 'Indeterminate' end as sev
  from node_events),
e as (select *, row_number() over (partition by k order by ts desc, event_id desc) as back from a where not unknown),
l as (select k, alarm_type, ts, event_id, sev from e where back = 1),
s as (select k, count(*) as n_events, min(ts) as first_ts, max(ts) as last_ts from e group by k),
c as (select c as k, ts, event_id from a where c is not null),
f as (select l.k, min(c.ts) as cleared_ts from l join c on l.k = c.k and (c.ts > l.ts or (c.ts = l.ts and c.event_id > l.event_id)) group by l.k),
o as (select e.k, count(*) as n_open from e where not exists (select 1 from c where c.k = e.k
  and (c.ts > e.ts or (c.ts = e.ts and c.event_id >= e.event_id))) group by e.k)""") + f"""
select s.k as reduction_key, l.alarm_type, s.n_events, strftime(s.first_ts, {STAMP}) as first_time,
  strftime(s.last_ts, {STAMP}) as last_time, l.sev as last_severity, f.k is not null as cleared,
  strftime(f.cleared_ts, {STAMP}) as cleared_time, coalesce(o.n_open, 0) as n_open
from s join l on s.k = l.k left join f on s.k = f.k left join o on s.k = o.k""")
def alarm_reduction(spark, sf):
    out = reduce_alarms(alarm_events(spark, sf))
    return out.withColumns({c: stamp(c) for c in ("first_time", "last_time", "cleared_time")})
