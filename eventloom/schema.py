"""Row shapes of events and event definitions, in Spark's DDL form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.columns import PARM_TYPE, empty_parms

ACTION = "array<struct<content:string,state:string>>"
MASK = "array<struct<name:string,values:array<string>>>"
ALARM = (
    "struct<alarm_type:int,reduction_key:string,clear_key:string,auto_clean:boolean,"
    "x733_alarm_type:string,x733_probable_cause:int,"
    "update_fields:array<struct<field:string,on_reduction:boolean>>>"
)

EVENT_FIELDS = {
    "event_id": "bigint", "uuid": "string", "dbid": "bigint", "uei": "string", "source": "string",
    "nodeid": "bigint", "time": "timestamp", "host": "string", "interface": "string",
    "ifindex": "int", "snmphost": "string", "service": "string", "severity": "string",
    "descr": "string", "logmsg": "struct<dest:string,content:string>", "operinstruct": "string",
    "mouseovertext": "string", "pathoutage": "string", "dist_poller": "string",
    "snmp": "struct<id:string,idtext:string,version:string,community:string,generic:int,specific:int>",
    "mask": MASK,
    "correlation": "struct<cuei:array<string>,cmin:string,cmax:string,ctime:string,state:string,path:string>",
    "autoaction": ACTION,
    "operaction": "array<struct<content:string,state:string,menutext:string>>",
    "autoacknowledge": "struct<content:string,state:string>",
    "loggroup": "array<string>", "tticket": "struct<content:string,state:string>",
    "forward": "array<struct<content:string,state:string,mechanism:string>>",
    "script": "array<struct<content:string,language:string>>",
    "alarm_data": ALARM, "parms": PARM_TYPE,
}

DEFINITION_FIELDS = {
    "def_no": "int", "uei": "string", "label": "string", "mask": MASK,
    "varbinds": "array<struct<number:int,values:array<string>>>",
    "snmp": EVENT_FIELDS["snmp"], "descr": "string", "logmsg": EVENT_FIELDS["logmsg"],
    "severity": "string", "correlation": EVENT_FIELDS["correlation"], "operinstruct": "string",
    "autoaction": ACTION, "operaction": EVENT_FIELDS["operaction"],
    "autoacknowledge": EVENT_FIELDS["autoacknowledge"], "loggroup": "array<string>",
    "tticket": EVENT_FIELDS["tticket"], "forward": EVENT_FIELDS["forward"],
    "script": EVENT_FIELDS["script"], "mouseovertext": "string", "alarm_data": ALARM,
    "decodes": "map<string,map<string,string>>",
    "parameters": "array<struct<name:string,value:string,expand:boolean>>",
    "filters": "array<struct<parm:string,pattern:string,replacement:string>>",
}


def _conform(df: DataFrame, fields: dict[str, str], keep: bool) -> DataFrame:
    cols: list[Column] = []
    for name, kind in fields.items():
        value = F.col(name) if name in df.columns else F.lit(None)
        cols.append(value.cast(kind).alias(name))
    extra = [F.col(c) for c in df.columns if c not in fields] if keep else []
    return df.select(*cols, *extra)


def as_events(df: DataFrame) -> DataFrame:
    """Give a frame every event column; absent ones are null and parms an empty list."""
    out = _conform(df, EVENT_FIELDS, keep=True)
    return out.withColumn("parms", F.coalesce("parms", empty_parms()))


def as_definitions(df: DataFrame) -> DataFrame:
    return _conform(df, DEFINITION_FIELDS, keep=False)
