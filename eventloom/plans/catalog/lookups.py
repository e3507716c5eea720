"""Dimension lookups, masks and definitions."""

from pyspark.sql import functions as F

from ...functions.columns import PARM_TYPE, parm
from ...operators.lookup import (
    add_dimension_tokens, enrich_node, lookup_asset, lookup_definition, lookup_hardware, lookup_host,
    lookup_ifalias, lookup_node, match_masks, resolve_foreign_node, resolve_refs, unpivot_assets,
)
from ...schema import DEFINITION_FIELDS
from .. import views as V
from .registry import query, with_views


@query("node_lookup", with_views("node_events", "interfaces") + """
select e.event_id, i.nodeid from node_events e left join interfaces i
on e.location = i.location and e.interface = i.ip and i.nodeid > 0""")
def node_lookup(spark, sf):
    return lookup_node(V.node_events(spark, sf), V.interfaces(spark, sf)).select("event_id", "nodeid")


@query("node_lookup_salted", with_views("node_events", "interfaces") + """
select e.event_id, i.nodeid from node_events e left join interfaces i
on e.location = i.location and e.interface = i.ip and i.nodeid > 0""")
def node_lookup_salted(spark, sf):
    return lookup_node(V.node_events(spark, sf), V.interfaces(spark, sf), salts=8, spread=["event_id"]).select(
        "event_id", "nodeid")


@query("node_lookup_overwritten", "select event_id, 0 as nodeid from events")
def node_lookup_overwritten(spark, sf):
    return lookup_node(V.node_events(spark, sf), V.interfaces(spark, sf), as_reference=True).select("event_id", "nodeid")


@query("foreign_node", with_views("nodes", more="""keyed as (select event_id, case when event_id % 2 = 0 then 0 else user_id end as nodeid,
  c_mktsegment as fs, case when event_id % 4 = 0 then concat('f', user_id) end as fi
  from events left join customer on user_id = c_custkey)""") + """
select event_id, case when k.nodeid = 0 then coalesce(n.nodeid, 0) else k.nodeid end as nodeid
from keyed k left join nodes n on k.nodeid = 0 and k.fs = n.foreign_source and k.fi = n.foreign_id""")
def foreign_node(spark, sf):
    customer = V.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    events = V.table(spark, sf, "events").join(customer, F.col("user_id") == F.col("c_custkey"), "left").select(
        "event_id", F.when(F.col("event_id") % 2 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("nodeid"),
        F.array(
            parm("_foreignSource", F.col("c_mktsegment")),
            parm("_foreignId", F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("f"), F.col("user_id").cast("string")))),
        ).cast(PARM_TYPE).alias("parms"))
    return resolve_foreign_node(events, V.nodes(spark, sf)).select("event_id", "nodeid")


@query("node_enrich", with_views("node_events", "nodes") + """
select event_id, coalesce(label, 'Unknown') as nodelabel, coalesce(n.location, 'Unknown') as nodelocation,
  coalesce(foreign_source, '') as foreignsource, coalesce(foreign_id, '') as foreignid
from node_events e left join nodes n on e.nodeid = n.nodeid""")
def node_enrich(spark, sf):
    return enrich_node(V.node_events(spark, sf), V.nodes(spark, sf)).select(
        "event_id", "nodelabel", "nodelocation", "foreignsource", "foreignid")


@query("host_lookup", with_views("node_events", "interfaces") + """
select event_id, coalesce(i.hostname, e.host) as event_host
from (select *, case when event_id % 11 <> 0 then interface end as host from node_events) e
left join interfaces i on e.nodeid = i.nodeid and e.host = i.ip""")
def host_lookup(spark, sf):
    events = V.node_events(spark, sf).withColumn("host", F.when(F.col("event_id") % 11 != 0, F.col("interface")))
    return lookup_host(events, V.interfaces(spark, sf)).select("event_id", "event_host")


@query("ifalias_lookup", with_views("node_events", "interfaces") + """
select event_id, case when coalesce(e.nodeid, 0) > 0 then if_alias else interface end as ifalias
from node_events e left join interfaces i on e.nodeid = i.nodeid and e.interface = i.ip""")
def ifalias_lookup(spark, sf):
    return lookup_ifalias(V.node_events(spark, sf), V.interfaces(spark, sf)).select("event_id", "ifalias")


@query("asset_lookup", with_views("node_events", "assets") + """
select event_id, coalesce(category, 'Unknown') as category, 'Unknown' as colour
from node_events e left join assets a on e.nodeid = a.nodeid""")
def asset_lookup(spark, sf):
    out = lookup_asset(V.node_events(spark, sf), V.assets(spark, sf), "CateGory", "category")
    return lookup_asset(out, V.assets(spark, sf), "colour", "colour").select("event_id", "category", "colour")


@query("asset_unpivot", with_views("assets") + """
select nodeid, 'category' as field, category as value from assets union all select nodeid, 'region', region from assets""")
def asset_unpivot(spark, sf):
    return unpivot_assets(V.assets(spark, sf))


@query("hardware_lookup", with_views("node_events", "hardware") + """
, named as (select nodeid, arg_max(model, id) as m from hardware where ent_name like '%1%' group by nodeid),
exact as (select nodeid, arg_max(model, id) as m from hardware
  where ent_name = (select min(p_name) from part) group by nodeid)
select event_id, coalesce(h.model, 'Unknown') as by_index, coalesce(n.m, 'Unknown') as by_pattern,
  coalesce(x.m, 'Unknown') as by_name
from node_events e left join hardware h on e.nodeid = h.nodeid and h.ent_index = 2
left join named n on e.nodeid = n.nodeid left join exact x on e.nodeid = x.nodeid""")
def hardware_lookup(spark, sf):
    hardware = V.hardware(spark, sf)
    name = V.table(spark, sf, "part").agg(F.min("p_name")).first()[0]
    out = lookup_hardware(V.node_events(spark, sf), hardware, "2", "MODEL", "by_index")
    out = lookup_hardware(out, hardware, "~%1%", "model", "by_pattern")
    return lookup_hardware(out, hardware, name, "model", "by_name").select("event_id", "by_index", "by_pattern", "by_name")


@query("dimension_tokens", with_views("node_events", "assets", "hardware") + """
select event_id, concat(coalesce(a.region, 'Unknown'), '/', coalesce(h.model, 'Unknown')) as text
from node_events e left join assets a on e.nodeid = a.nodeid
left join hardware h on e.nodeid = h.nodeid and h.ent_index = 3""")
def dimension_tokens(spark, sf):
    from ...operators.expand import expand_templates

    template = "%asset[Region]%/%hardware[3:model]%"
    out = add_dimension_tokens(V.parm_events(spark, sf), [template], V.assets(spark, sf), V.hardware(spark, sf))
    return expand_templates(out, {"text": template}).select("event_id", "text")


@query("ref_chain", """
with services as (select s_name as name, s_suppkey as service_id from supplier),
systems as (select concat('dp', n_nationkey) as system_id from nation),
keyed as (select event_id, (select min(s_name) from supplier where s_suppkey = user_id) as service,
  case event_id % 3 when 0 then concat('dp', event_id % 40) when 1 then '  ' end as header_dp,
  case event_id % 4 when 0 then concat('dp', event_id % 30) when 1 then 'nobody' end as dist_poller from events)
select event_id, v.service_id, coalesce(a.system_id, b.system_id, 'here') as resolved_system
from keyed k left join services v on k.service = v.name
left join systems a on k.header_dp = a.system_id left join systems b on k.dist_poller = b.system_id""")
def ref_chain(spark, sf):
    services = V.table(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("service_id"))
    systems = V.table(spark, sf, "nation").select(F.concat(F.lit("dp"), F.col("n_nationkey").cast("string")).alias("system_id"))
    by_key = V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("service"))
    dp = lambda n: F.concat(F.lit("dp"), (F.col("event_id") % n).cast("string"))
    events = V.table(spark, sf, "events").join(by_key, F.col("user_id") == F.col("k"), "left").select(
        "event_id", "service",
        F.when(F.col("event_id") % 3 == 0, dp(40)).when(F.col("event_id") % 3 == 1, F.lit("  ")).alias("header_dp"),
        F.when(F.col("event_id") % 4 == 0, dp(30)).when(F.col("event_id") % 4 == 1, F.lit("nobody")).alias("dist_poller"))
    return resolve_refs(events, services, systems, "here").select("event_id", "service_id", "resolved_system")


MASKS = [
    (1, "event_type", "error"), (1, "bucket", "1"), (2, "event_type", "error"),
    (3, "event_type", "click"), (3, "event_type", "view"), (3, "bucket", "2"),
    (4, "event_type", "sign%"), (4, "bucket", "~[34]"), (5, "event_type", "signup"), (5, "missing", "x"),
]
MASK_SQL = """(case when event_type = 'error' and user_id % 5 = 1 then 1 when event_type = 'error' then 2
  when event_type in ('click', 'view') and user_id % 5 = 2 then 3
  when starts_with(event_type, 'sign') and user_id % 5 in (3, 4) then 4 end)"""


def _mask_elements():
    return {"event_type": F.col("event_type"), "bucket": F.col("user_id") % 5, "missing": F.lit(None)}


@query("mask_match", f"select event_id, {MASK_SQL} as def_no from events")
def mask_match(spark, sf):
    masks = spark.createDataFrame(MASKS, "def_no int, element string, val string")
    return match_masks(V.table(spark, sf, "events"), masks, _mask_elements()).select("event_id", "def_no")


@query("mask_match_literal", f"select event_id, {MASK_SQL} as def_no from events")
def mask_match_literal(spark, sf):
    return match_masks(V.table(spark, sf, "events"), MASKS, _mask_elements(), "event_type").select("event_id", "def_no")


DEFAULT_UEI = "uei.example.org/default/event"


def _definition(**fields):
    return tuple(fields.get(name) for name in DEFINITION_FIELDS)


def definitions(spark):
    """Definition 1 carries a mask; 10 and 11 are found by name; 99 is the default."""
    alarm = lambda kind, key, clear=None, clean=None, update=None: (kind, key, clear, clean, None, None, update)
    rows = [
        _definition(
            def_no=1, uei="uei.example.org/error", descr="Error of %parm[user]% (%parm[##]%)",
            logmsg=("logndisplay", "error %parm[#3]% at %interface%"), severity="Major", operinstruct="call %nodeid%",
            mask=[("event_type", ["error"])],
            alarm_data=alarm(1, "%uei%:%nodeid%:%parm[name-#4.-3:-1]%", clean=False, update=[("severity", True)]),
            tticket=("t-%parm[#1]%", "on"), loggroup=["ops", "net"], autoaction=[("run %uei%", "on")],
            operaction=[("open %nodeid%", "on", "Open")],
            decodes={"parm[#1]": {"1": "one", "2": "two"}, "parm[kind]": {"error": "bad"}},
            parameters=[("site", "hq", False), ("user", "nobody", False), ("note", "by %parm[#1]%", True)],
        ),
        _definition(
            def_no=10, uei="uei.example.org/click", descr="Click by %parm[user]%",
            logmsg=("logonly", "%parm[kind]% %parm[all]%"), severity="Normal", mouseovertext="over %uei%",
            alarm_data=alarm(2, "%uei%:%nodeid%", "uei.example.org/error:%nodeid%:x", True),
            decodes={"parm[#1]": {"3": "three"}},
        ),
        _definition(
            def_no=11, uei="uei.example.org/view", descr="100%% sure %", logmsg=("donotpersist", "plain text"),
            severity="Warning",
        ),
        _definition(
            def_no=99, uei=DEFAULT_UEI, descr="No definition for %uei%",
            logmsg=("logndisplay", "default from %interface%"), severity="Indeterminate",
            alarm_data=alarm(3, "%uei%:%dpname%:%nodeid%:%interface%"),
        ),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{n} {t}" for n, t in DEFINITION_FIELDS.items()))




@query("definition_lookup", """
select event_id, case when event_type = 'error' and event_id % 2 = 0 then 1 when event_type = 'click' then 10
  when event_type = 'view' then 11 else 99 end as def_no,
  case when event_type = 'error' and event_id % 2 = 0 then 'Major' when event_type = 'click' then 'Normal'
  when event_type = 'view' then 'Warning' else 'Indeterminate' end as severity from events""")
def definition_lookup(spark, sf):
    events = V.node_events(spark, sf).withColumn(
        "def_no", F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 0), F.lit(1)))
    return lookup_definition(events, definitions(spark), DEFAULT_UEI).select(
        "event_id", "def_no", F.col("def.severity").alias("severity"))


@query("lookup_repeated_keys", with_views("node_events", "nodes", "interfaces", "assets") + """
select event_id, i.nodeid as found, coalesce(n.label, 'Unknown') as nodelabel,
  coalesce(h.hostname, e.interface) as event_host,
  case when coalesce(e.nodeid, 0) > 0 then h.if_alias else e.interface end as ifalias,
  coalesce(a.category, 'Unknown') as category, s.service_id
from (select *, concat('s', event_id % 7) as service from node_events) e
left join interfaces i on e.location = i.location and e.interface = i.ip and i.nodeid > 0
left join nodes n on e.nodeid = n.nodeid
left join interfaces h on e.nodeid = h.nodeid and e.interface = h.ip
left join assets a on e.nodeid = a.nodeid
left join (select concat('s', n_nationkey % 5) as name, min(n_nationkey) as service_id from nation group by 1) s on e.service = s.name""")
def lookup_repeated_keys(spark, sf):
    """Dimensions whose keys repeat, with later values behind the true ones: no event is doubled."""
    twice = lambda df, **worse: df.union(df.withColumns(worse).select(*df.columns))
    after = lambda c: F.concat(F.col(c), F.lit("~"))
    interfaces, nodes = V.interfaces(spark, sf), V.nodes(spark, sf)
    assets = V.assets(spark, sf)
    services = V.table(spark, sf, "nation").select(
        F.concat(F.lit("s"), (F.col("n_nationkey") % 5).cast("string")).alias("name"), F.col("n_nationkey").alias("service_id"))
    systems = spark.createDataFrame([("dp1",), ("dp1",)], "system_id string")
    events = V.node_events(spark, sf).withColumns({
        "event_nodeid": F.col("nodeid"), "service": F.concat(F.lit("s"), (F.col("event_id") % 7).cast("string")),
        "header_dp": F.lit("dp1"), "dist_poller": F.lit(None).cast("string")})
    out = lookup_node(events, twice(interfaces, nodeid=F.col("nodeid") * 2)).withColumn("found", F.col("nodeid"))
    out = out.withColumn("nodeid", F.col("event_nodeid"))
    out = enrich_node(out, twice(nodes, label=after("label")))
    out = lookup_host(out, twice(interfaces, hostname=after("hostname")), "interface")
    out = lookup_ifalias(out, twice(interfaces, if_alias=after("if_alias")))
    out = lookup_asset(out, twice(assets, category=after("category")), "category", "category")
    return resolve_refs(out, services, systems, "here").select(
        "event_id", "found", "nodelabel", "event_host", "ifalias", "category", "service_id")


MANY_SQL = """(case when user_id % 400 >= 2 and user_id % 400 < 302 and event_type in ('click', 'view') then user_id % 400 + 1
  when starts_with(event_type, 'sig') and regexp_full_match(cast(event_id % 100 as varchar), '[0-4].?') then 1001 end)"""


@query("mask_many", f"select event_id, {MANY_SQL} as def_no from events")
def mask_many(spark, sf):
    """Three hundred definitions by an index element, and one by prefix and varbind regex."""
    masks = [row for k in range(2, 302) for row in ((k + 1, "id", f".1.{k}"), (k + 1, "event_type", "click"), (k + 1, "event_type", "view"))]
    masks += [(1001, "event_type", "sig%"), (1001, "varbind#1", "~[0-4].?")]
    elements = {"id": F.concat(F.lit(".1."), (F.col("user_id") % 400).cast("string")), "event_type": F.col("event_type"),
                "varbind#1": F.col("event_id") % 100}
    return match_masks(V.table(spark, sf, "events"), masks, elements, "id").select("event_id", "def_no")
