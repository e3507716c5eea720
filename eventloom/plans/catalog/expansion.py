"""Decoding, filling and template expansion."""

from pyspark.sql import functions as F

from ...functions.columns import split_extract
from ...functions.tokens import register_token, unregister_token
from ...operators.expand import (
    add_default_parms, alarm_keys, decode_parms, expand_event, expand_map, expand_templates, fill_from_definition,
)
from ...operators.lookup import lookup_definition
from ...plans.chain import run_chain
from ...schema import DEFINITION_FIELDS, as_events
from .. import views as V
from ..flow import Config, build_events, templates_by_field
from .lookups import DEFAULT_UEI, definitions
from .registry import AMOUNT, query, with_views


def _shown(col="parms"):
    return F.array_join(F.transform(col, lambda p: F.concat(p["name"], F.lit("="), p["value"])), "|")


def full_events(spark, sf):
    """Events with some fields of their own, the rest to be filled."""
    base = V.parm_events(spark, sf)
    third = F.col("event_id") % 3 == 0
    return as_events(base.withColumns({
        "source": F.lit("agent"), "dist_poller": F.lit("dp1"), "host": F.col("interface"),
        "service": F.concat(F.lit("svc"), (F.col("event_id") % 4).cast("string")),
        "ifindex": F.when(F.col("event_id") % 2 == 0, (F.col("event_id") % 8).cast("int")),
        "severity": F.when(third, F.lit("Minor")),
        "descr": F.when(third, F.concat(F.lit("own %parm[#1]% "), F.col("event_type"))),
        "snmp": F.when(F.col("event_id") % 5 != 0, F.struct(
            F.concat(F.lit(".1.3.6.1.4.1."), (F.col("event_id") % 7).cast("string")).alias("id"),
            F.when(F.col("event_id") % 2 == 0, F.lit(" a,b ")).alias("idtext"), F.lit("v2c").alias("version"),
            F.when(F.col("event_id") % 3 == 0, F.lit("public")).alias("community"),
            F.lit(6).alias("generic"),
            F.when(F.col("event_id") % 2 == 1, (F.col("event_id") % 9).cast("int")).alias("specific"),
        )),
    }))


def defined_events(spark, sf):
    events = full_events(spark, sf).withColumn(
        "def_no", F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), F.lit(1)))
    return lookup_definition(events, definitions(spark), DEFAULT_UEI)


DEF = """defs as (select *, case when event_type = 'error' and event_id % 2 = 0 then 1 when event_type = 'click' then 10
  when event_type = 'view' then 11 else 99 end as def_no, event_id % 3 = 0 as own,
  concat('.1.3.', event_id % 5, '.', user_id, '.9') as dotted, cast(user_id as varchar) as u,
  cast(coalesce(nodeid, 0) as varchar) as n, cast(round(value * 100) as bigint) as amount from node_events)"""


@query("varbind_decode", f"""
select event_id, concat('user=', case when event_id % 2 = 0 and user_id % 10 = 1 and user_id < 10 then 'one(1)'
    when event_id % 2 = 0 and user_id = 2 then 'two(2)' else cast(user_id as varchar) end,
  '| kind =', event_type, '|amount=', {AMOUNT}) as parms from events""")
def varbind_decode(spark, sf):
    decodes = spark.createDataFrame(
        [(0, "parm[#1]", "1", "one"), (0, "parm[#1]", "2", "two"), (7, "parm[user]", "3", "three")],
        "def_no int, token string, value string, text string")
    events = V.parm_events(spark, sf).withColumn("def_no", (F.col("event_id") % 2).cast("int"))
    return decode_parms(events, decodes).select("event_id", _shown(F.slice("parms", 1, 3)).alias("parms"))


@query("default_fill", with_views("node_events", more=DEF) + """
select event_id, case def_no when 1 then 'Error of %parm[user]% (%parm[##]%)' when 10 then 'Click by %parm[user]%'
    when 11 then '100%% sure %' else 'No definition for %uei%' end as descr,
  case when own then 'Minor' else case def_no when 1 then 'Major' when 10 then 'Normal' when 11 then 'Warning'
    else 'Indeterminate' end end as severity,
  case def_no when 1 then 'logndisplay' when 10 then 'logonly' when 11 then 'donotpersist' else 'logndisplay' end as dest,
  case when def_no = 1 then 'ops,net' end as loggroup, case def_no when 1 then 1 when 10 then 2 when 99 then 3 end as alarm_type,
  case when def_no = 10 then 'over %uei%' end as mouseovertext from defs""")
def default_fill(spark, sf):
    return fill_from_definition(defined_events(spark, sf), ("descr",)).select(
        "event_id", "descr", "severity", F.col("logmsg.dest").alias("dest"),
        F.array_join("loggroup", ",").alias("loggroup"), F.col("alarm_data.alarm_type").alias("alarm_type"), "mouseovertext")


@query("default_parms", with_views("node_events", more=DEF) + """
select event_id, concat('user=', u, '| kind =', event_type, '|amount=', amount, '|', dotted, '=', props,
  case when def_no = 1 then '|site=hq|note=by %parm[#1]%' else '' end) as parms from defs""")
def default_parms(spark, sf):
    return add_default_parms(defined_events(spark, sf)).select("event_id", _shown().alias("parms"))


TEMPLATE = "%uei% on %nodeid%: %parm[user]% 100% %nothing%%parm[#3]% %% open %uei"


@query("template_expand", with_views("node_events", more=DEF) + """
select event_id, concat(uei, ' on ', n, ': ', u, ' 100% ', amount, '  open %uei') as compiled,
  concat(uei, ' on ', n, ': ', u, ' 100% ', amount, '  open %uei') as per_row from defs""")
def template_expand(spark, sf):
    held = F.concat(F.lit(TEMPLATE), F.lit("").cast("string"))
    return expand_templates(full_events(spark, sf), {"compiled": TEMPLATE, "per_row": held}).select(
        "event_id", "compiled", "per_row")


SCALARS = ("%uei%|%eventid%|%source%|%dpname%|%nodeid%|%time%|%shorttime%|%host%|%interface%|%ifindex%|"
           "%interfaceresolve%|%snmphost%|%service%|%severity%|%tticketid%|%operinstruct%|%pctsign%|")


@query("scalar_tokens", with_views("node_events", more=DEF) + """
select event_id, concat(uei, '|eventid-unknown|agent|dp1|', n, '|', strftime(ts, '%A, %B %-d, %Y %-I:%M:%S %p UTC'), '|',
  strftime(ts, '%-m/%-d/%y %-I:%M %p'), '|', interface, '|', interface, '|',
  case when event_id % 2 = 0 then cast(event_id % 8 as varchar) else 'N/A' end, '|', interface, '||svc', event_id % 4, '|',
  case when own then 'Minor' else '' end, '||||') as text from defs""")
def scalar_tokens(spark, sf):
    return expand_templates(full_events(spark, sf), {"text": SCALARS}).select("event_id", "text")


@query("snmp_tokens", """
select event_id, case when event_id % 5 = 0 then '[]//////' else
  concat('[.1.3.6.1.4.1.', event_id % 7, ',', case when event_id % 2 = 0 then 'a%44b' else 'undefined' end, ',v2c,',
  case when event_id % 2 = 1 then cast(event_id % 9 as varchar) else 'undefined' end, ',6,',
  case when event_id % 3 = 0 then 'public' else 'undefined' end, ']/', '.1.3.6.1.4.1.', event_id % 7, '/',
  case when event_id % 2 = 0 then ' a,b ' else '' end, '/v2c/', case when event_id % 2 = 1 then cast(event_id % 9 as varchar) else '' end,
  '/6/', case when event_id % 3 = 0 then 'public' else '' end) end as text from events""")
def snmp_tokens(spark, sf):
    template = "[%snmp%]/%id%/%idtext%/%version%/%specific%/%generic%/%community%"
    return expand_templates(full_events(spark, sf), {"text": template}).select("event_id", "text")


PARM_TOKENS = ("%parm[##]%;%parm[#1]%;%parm[#9]%;%parm[name-#2]%;%parm[kind]%;%parm[ user ]%;%parm[none]%;"
               "%parm[values-all]%;%parm[names-all]%;%parm[all]%;%parm[name-#4.-2:]%")
PARM_SQL = """concat('4;', u, ';; kind ;', event_type, ';;;', u, ' ', event_type, ' ', amount, ' ', props, ';user kind amount ', dotted,
  ';user="', u, '" kind="', event_type, '" amount="', amount, '" ', dotted, '="', props, '";', u, '.9')"""


@query("parm_tokens", with_views("node_events", more=DEF) + f"select event_id, {PARM_SQL} as text, {PARM_SQL} as per_row from defs")
def parm_tokens(spark, sf):
    held = F.concat(F.lit(PARM_TOKENS.replace("%parm[ user ]%", "")), F.lit("").cast("string"))
    return expand_templates(full_events(spark, sf), {"text": PARM_TOKENS.replace("%parm[ user ]%", ""), "per_row": held}).select(
        "event_id", "text", "per_row")


@query("split_extract", with_views("node_events", more=DEF) + """
select event_id, u as second_last, concat('3.', event_id % 5, '.', u, '.9') as from_second,
  concat(u, '.9') as last_two, concat('1.3') as first_two, concat(event_id % 5, '.', u) as middle, '' as nothing,
  cast(null as varchar) as beyond from defs""")
def split_extract_query(spark, sf):
    name = F.element_at("parms", 4)["name"]
    return V.parm_events(spark, sf).select(
        "event_id", split_extract(name, ".", -2).alias("second_last"), split_extract(name, ".", 2, True).alias("from_second"),
        split_extract(name, ".", -2, True, 5).alias("last_two"), split_extract(name, ".", 1, True, 2).alias("first_two"),
        split_extract(name, ".", -3, True, 2).alias("middle"), split_extract(name, ".", 2, True, -2).alias("nothing"),
        split_extract(name, ".", 9).alias("beyond"))


@query("event_expand", with_views("node_events", more=DEF + """,
d as (select *, case when def_no = 1 and u = '1' then 'one(1)' when def_no = 1 and u = '2' then 'two(2)'
  when def_no = 10 and u = '3' then 'three(3)' else u end as u1 from defs)""") + """
select event_id,
  case when own then concat('own ', u1, ' ', event_type) else case def_no when 1 then concat('Error of ', u, ' (6)')
    when 10 then concat('Click by ', u) when 11 then '100 sure %' else concat('No definition for ', uei) end end as descr,
  case def_no when 1 then concat('error ', amount, ' at ', interface)
    when 10 then concat(event_type, ' user="', u, '" kind="', event_type, '" amount="', amount, '" ', dotted, '="', props, '"')
    when 11 then 'plain text' else concat('default from ', interface) end as content,
  case when def_no = 1 then concat('call ', n) end as operinstruct,
  case when def_no = 1 then concat('t-', u) end as tticket,
  case when def_no = 1 then concat('run ', uei) end as autoaction,
  case when def_no = 1 then concat('open ', n) end as operaction,
  case def_no when 1 then concat(uei, ':', n, ':', event_id % 5)
    when 10 then concat(uei, ':', n) when 99 then concat(uei, ':dp1:', n, ':', interface) end as reduction_key,
  case when def_no = 10 then concat('uei.example.org/error:', n, ':x') end as clear_key,
  case when def_no = 1 then concat('by ', u1) end as note from d""")
def event_expand(spark, sf):
    known = templates_by_field(definitions(spark))
    out = run_chain(defined_events(spark, sf), [
        fill_from_definition, add_default_parms, lambda df: expand_event(df, known)])
    return out.select(
        "event_id", "descr", F.col("logmsg.content").alias("content"), "operinstruct", F.col("tticket.content").alias("tticket"),
        F.try_element_at("autoaction", F.lit(1))["content"].alias("autoaction"),
        F.try_element_at("operaction", F.lit(1))["content"].alias("operaction"),
        F.col("alarm_data.reduction_key").alias("reduction_key"), F.col("alarm_data.clear_key").alias("clear_key"),
        F.try_element_at("parms", F.lit(6))["value"].alias("note"))


@query("map_expand", with_views("node_events", more=DEF) + """
select event_id, concat('node ', n) as a, 'fixed' as b, cast(null as varchar) as c, '' as d from defs""")
def map_expand(spark, sf):
    m = F.create_map(F.lit("a"), F.lit("node %nodeid%"), F.lit("b"), F.lit("fixed"), F.lit("c"), F.lit(None).cast("string"),
                     F.lit("d"), F.lit("%nothing%"))
    out = expand_map(full_events(spark, sf).withColumn("m", m), "m")
    return out.select("event_id", *[F.col("m")[k].alias(k) for k in "abcd"])


@query("alarm_keys", with_views("node_events", more=DEF) + """
select event_id, case def_no when 1 then concat(uei, ':', n, ':', event_id % 5)
    when 10 then concat(uei, ':', n) when 99 then concat(uei, ':dp1:', n, ':', interface) end as reduction_key,
  case when def_no = 10 then concat('uei.example.org/error:', n, ':x') end as clear_key,
  case def_no when 1 then 1 when 10 then 2 when 99 then 3 end as alarm_type,
  case def_no when 1 then false when 10 then true end as auto_clean,
  case when def_no = 1 then 'severity' end as update_fields from defs""")
def alarm_keys_query(spark, sf):
    known = templates_by_field(definitions(spark))
    out = alarm_keys(run_chain(defined_events(spark, sf), [fill_from_definition, lambda df: expand_event(df, known)]))
    return out.select("event_id", "reduction_key", "clear_key", "alarm_type", "auto_clean",
                      F.array_join(F.col("update_fields.field"), ",").alias("update_fields"))


@query("token_registry", with_views("node_events", more=DEF) + """
select event_id, concat(upper(event_type), '/', event_id % 7, '/') as text from defs""")
def token_registry(spark, sf):
    register_token("loudtype", lambda _, ctx: F.upper(F.regexp_extract(ctx["uei"], "[^/]+$", 0)))
    register_token("mod[", lambda t, ctx: F.pmod(F.col("event_id"), F.regexp_extract(t, r"\[(\d+)\]", 1).cast("int")).cast("string"), "prefix")
    try:
        return expand_templates(full_events(spark, sf), {"text": "%loudtype%/%mod[7]%/%other%"}).select("event_id", "text")
    finally:
        unregister_token("loudtype")
        unregister_token("mod[")


@query("step_chain", """
select event_type, count(*) as n from events where event_id % 2 = 0 group by 1""")
def step_chain(spark, sf):
    return run_chain(V.table(spark, sf, "events"), [
        lambda d: d.filter(F.col("event_id") % 2 == 0), lambda d: d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))])


@query("flow_node_tokens", with_views("node_events", "interfaces", "nodes", "assets") + """
select event_id, concat('on ', coalesce(n.label, 'Unknown'), ' in ', coalesce(n.location, 'Unknown'), ' of ',
    coalesce(a.category, 'Unknown'), ', ', case when i.nodeid is not null then coalesce(i.if_alias, '') else e.interface end) as descr,
  concat('did #', case when event_id % 2 = 0 then 'even' else 'odd' end) as content
from node_events e left join interfaces i on e.location = i.location and e.interface = i.ip and i.nodeid > 0
left join nodes n on i.nodeid = n.nodeid left join assets a on i.nodeid = a.nodeid""")
def flow_node_tokens(spark, sf):
    """The whole flow finds out by itself which dimensions and filters its definitions need."""
    text = F.concat(F.lit("did "), F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd"))
    matched = V.node_events(spark, sf).select(
        "event_id", "location", F.col("interface").alias("source_address"), F.lit("user").alias("facility"),
        F.lit("Notice").alias("severity"), text.alias("message"), text.alias("raw"), F.lit("p").alias("process_name"),
        F.lit(1).alias("process_id"), F.col("time").alias("event_time"))
    row = dict(def_no=1, uei=DEFAULT_UEI, descr="on %nodelabel% in %nodelocation% of %asset[Category]%, %ifalias%",
               logmsg=("logonly", "%parm[syslogmessage]%"), severity="Minor",
               filters=[("syslogmessage", "(even|odd)$", "#$1")])
    defs = spark.createDataFrame([tuple(row.get(n) for n in DEFINITION_FIELDS)], ", ".join(f"{n} {t}" for n, t in DEFINITION_FIELDS.items()))
    filtered = defs.union(defs.withColumns({"def_no": F.lit(2), "uei": F.lit("uei.example.org/syslog/user/Notice")}))
    config = Config(patterns=[], rules=[], definitions=filtered, default_uei=DEFAULT_UEI, interfaces=V.interfaces(spark, sf),
                    nodes=V.nodes(spark, sf), assets=V.assets(spark, sf))
    out = build_events(matched, config)
    return out.select("event_id", "descr", F.filter("parms", lambda p: p["name"] == "syslogmessage")[0]["value"].alias("content"))
