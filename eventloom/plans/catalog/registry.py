"""Named queries over the supplied tables, each with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...session import tune
from ...functions.fixed import FACILITY_NAMES, SEVERITY_NAMES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

REF_TEXT = "2024-06-15 12:30:00"


def ref_time():
    return F.lit(REF_TEXT).cast("timestamp")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf: fn(tune(spark), sf)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def stamp(col, pattern: str = "yyyy-MM-dd HH:mm:ss"):
    return F.date_format(col, pattern)


# --- SQL fragments ---------------------------------------------------------------

STAMP = "'%Y-%m-%d %H:%M:%S'"


def ip_sql(x: str) -> str:
    return f"concat('10.0.', cast(floor({x} / 256) as bigint), '.', {x} % 256)"


SEV = ("(case event_type when 'error' then 3 when 'purchase' then 5 when 'signup' then 4 "
       "when 'click' then 6 else 7 end)")
CODE = f"((event_id % 24) * 8 + {SEV})"
BODY = ("concat('user ', user_id, ' did ', event_type, ' amount ', "
        "cast(round(value * 100) as bigint), ' props ', props)")
HOST = "concat('host', user_id % 20)"
PROC = "concat(event_type, 'd')"
PID = "(1000 + event_id % 500)"
BSD = "strftime(ts, '%b %d %H:%M:%S')"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
DAY = "strftime(ts, '%Y-%m-%d')"
AMOUNT = "cast(round(value * 100) as bigint)"


def _list(names: list[str]) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


def facility_sql(code: str) -> str:
    names = _list(FACILITY_NAMES + ["unknown"])
    return f"(case when {code} = 99 then 'unknown' else ({names})[(({code} & 1016) >> 3) + 1] end)"


def severity_sql(code: str) -> str:
    return f"(case when {code} = 99 then 'Unknown' else ({_list(SEVERITY_NAMES)})[({code} & 7) + 1] end)"


VIEWS = {
    "lines": f"""lines as (select event_id, ts, user_id, event_type, value, props,
        {facility_sql(CODE)} as facility, {severity_sql(CODE)} as severity, {HOST} as hostname,
        case when event_id % 7 <> 0 then {PROC} end as process_name,
        case when event_id % 5 <> 0 then {PID} end as process_id,
        {BODY} as message, {ip_sql('user_id')} as source_address from events)""",
    "nodes": """nodes as (select c_custkey as nodeid, c_name as label, n_name as location,
        c_mktsegment as foreign_source, concat('f', c_custkey) as foreign_id
        from customer join nation on c_nationkey = n_nationkey)""",
    "interfaces": f"""interfaces as (select c_custkey as nodeid, n_name as location, {ip_sql('c_custkey')} as ip,
        case when c_custkey % 5 = 0 then null else concat('host', c_custkey % 20) end as hostname,
        case when c_custkey % 3 = 0 then null else concat('eth', c_custkey % 4) end as if_alias
        from customer join nation on c_nationkey = n_nationkey)""",
    "assets": """assets as (select c_custkey as nodeid, c_mktsegment as category, n_name as region
        from customer join nation on c_nationkey = n_nationkey where c_custkey % 4 <> 0)""",
    "hardware": """hardware as (select p_partkey as id, p_partkey % 50 as nodeid,
        cast(floor(p_partkey / 50) as bigint) as ent_index, p_name as ent_name, p_brand as model from part)""",
    "node_events": f"""node_events as (select event_id, ts, user_id, event_type, props, value,
        case when event_id % 9 <> 0 then user_id end as nodeid, n_name as location,
        {ip_sql('user_id')} as interface, concat('uei.example.org/', event_type) as uei
        from events left join customer on user_id = c_custkey left join nation on c_nationkey = n_nationkey)""",
    "packets": f"""packets as (select event_id, ts, {ip_sql('user_id')} as source_ip,
        1024 + event_id % 3 as source_port, length(props) as size_bytes from events)""",
    "event_names": """event_names as (select event_id,
        concat('uei.example.org/', event_type, '/u', user_id % 10, '/e') as uei from events)""",
}


def with_views(*names: str, more: str = "") -> str:
    parts = [VIEWS[n] for n in names] + ([more] if more else [])
    return "with " + ",\n".join(parts) + "\n"
