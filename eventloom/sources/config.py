"""Match rules, hide rules, event definitions and pattern lists as ordered tables.

Order carries meaning. One configuration file is one small document, so it is read whole
and numbered by position inside it; many files are ordered by the list that names them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.rules import Rule, rules_from
from ..schema import as_definitions

_EXPR = "struct<_expression:string>"
_RULES = (
    "configuration struct<`_discard-uei`:string,`_forwarding-regexp`:string,"
    "`_matching-group-host`:int,`_matching-group-message`:int,_parser:string>, "
    "ueiList struct<ueiMatch:array<struct<facility:array<string>,severity:array<string>,"
    f"`process-match`:{_EXPR},`hostname-match`:{_EXPR},`hostaddr-match`:{_EXPR},"
    "match:struct<_type:string,_expression:string,`_default-parameter-mapping`:boolean>,uei:string,"
    "`parameter-assignment`:array<struct<`_matching-group`:int,`_parameter-name`:string>>>>>, "
    "hideMessage struct<hideMatch:array<struct<match:struct<_type:string,_expression:string>>>>"
)
_TEXTS = "array<struct<_VALUE:string,_state:string,_menutext:string,_mechanism:string,_language:string>>"
_DEFS = (
    "event array<struct<mask:struct<maskelement:array<struct<mename:string,mevalue:array<string>>>,"
    "varbind:array<struct<vbnumber:int,vbvalue:array<string>>>>,uei:string,`event-label`:string,"
    "snmp:struct<id:string,idtext:string,version:string,community:string,generic:int,specific:int>,"
    "descr:string,logmsg:struct<_dest:string,_VALUE:string>,severity:string,"
    "correlation:struct<_state:string,_path:string,cuei:array<string>,cmin:string,cmax:string,ctime:string>,"
    f"operinstruct:string,autoaction:{_TEXTS},operaction:{_TEXTS},"
    "autoacknowledge:struct<_VALUE:string,_state:string>,loggroup:array<string>,"
    f"tticket:struct<_VALUE:string,_state:string>,forward:{_TEXTS},script:{_TEXTS},mouseovertext:string,"
    "`alarm-data`:struct<`_reduction-key`:string,`_alarm-type`:int,`_clear-key`:string,`_auto-clean`:boolean,"
    "`_x733-alarm-type`:string,`_x733-probable-cause`:int,"
    "`update-field`:array<struct<`_field-name`:string,`_update-on-reduction`:boolean>>>,"
    "varbindsdecode:array<struct<parmid:string,decode:array<struct<_varbindvalue:string,_varbinddecodedstring:string>>>>,"
    "parameter:array<struct<_name:string,_value:string,_expand:boolean>>,"
    "filters:struct<filter:array<struct<_eventparm:string,_pattern:string,_replacement:string>>>>>"
)
_TAG_PREFIX = r"(</?)[A-Za-z0-9]+:"


def _documents(spark: SparkSession, paths: list[str], schema: str, trim: bool = True) -> DataFrame:
    parsed = F.from_xml(F.regexp_replace("value", _TAG_PREFIX, "$1"), F.lit(schema), {
        "mode": "PERMISSIVE", "ignoreSurroundingSpaces": str(trim).lower()})
    # Each file is read by itself, so its number depends on no file name.
    files = [spark.read.text(p, wholetext=True).select(F.lit(i).alias("file_no"), "value") for i, p in enumerate(paths)]
    together = files[0]
    for more in files[1:]:
        together = together.union(more)
    return together.select("file_no", parsed.alias("doc"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Match rules in file order."""
    rule = _documents(spark, [path], _RULES, trim=False).select(F.posexplode("doc.ueiList.ueiMatch").alias("pos", "r"))
    none = F.array().cast("array<string>")
    return rule.select(
        (F.col("pos") + 1).alias("rule_no"),
        F.col("r.match._type").alias("match_type"), F.col("r.match._expression").alias("expression"),
        F.trim("r.uei").alias("uei"),
        F.coalesce(F.transform("r.facility", lambda f: F.trim(f)), none).alias("facilities"),
        F.coalesce(F.transform("r.severity", lambda f: F.trim(f)), none).alias("severities"),
        F.col("r.process-match._expression").alias("process_expr"),
        F.col("r.hostname-match._expression").alias("hostname_expr"),
        F.col("r.hostaddr-match._expression").alias("hostaddr_expr"),
        F.coalesce("r.match._default-parameter-mapping", F.lit(True)).alias("default_mapping"),
        F.coalesce(F.transform("r.parameter-assignment", lambda a: F.struct(
            a["_matching-group"].alias("group"), a["_parameter-name"].alias("name")
        )), F.array().cast("array<struct<group:int,name:string>>")).alias("assignments"),
    )


def rule_list(rules: DataFrame) -> list[Rule]:
    """The rules on the driver, to be written into the plan. Rules are configuration."""
    return rules_from(rules)


def read_hide_rules(spark: SparkSession, path: str) -> DataFrame:
    """(rule_no, type, expression) of the hide rules."""
    hide = _documents(spark, [path], _RULES, trim=False).select(F.posexplode("doc.hideMessage.hideMatch").alias("pos", "h"))
    return hide.select(
        (F.col("pos") + 1).alias("rule_no"), F.col("h.match._type").alias("type"),
        F.col("h.match._expression").alias("expression"),
    )


def read_settings(spark: SparkSession, path: str) -> dict:
    """Parser settings: discard name, forwarding regex and its groups, format name."""
    row = _documents(spark, [path], _RULES, trim=False).select("doc.configuration.*").first()
    return {
        "discard_uei": row["_discard-uei"], "forwarding_regex": row["_forwarding-regexp"],
        "host_group": row["_matching-group-host"], "msg_group": row["_matching-group-message"],
        "format": row["_parser"],
    }


def read_event_defs(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Event definitions; ``def_no`` follows the file list, then the position in a file."""
    files = [paths] if isinstance(paths, str) else list(paths)
    rows = _documents(spark, files, _DEFS).select("file_no", F.posexplode("doc.event").alias("pos", "e"))
    # The files are configuration: a rank over all of their definitions is small.
    rows = rows.withColumn("def_no", F.row_number().over(Window.orderBy("file_no", "pos")))
    action = lambda c, *names: F.transform(f"e.{c}", lambda a: F.struct(
        F.trim(a["_VALUE"]).alias("content"), *[a[f"_{n}"].alias(n) for n in names]
    ))
    pair = lambda c: F.when(F.col(f"e.{c}").isNotNull(), F.struct(
        F.col(f"e.{c}._VALUE").alias("content"), F.col(f"e.{c}._state").alias("state")
    ))
    alarm = F.col("e.alarm-data")
    decodes = F.map_from_entries(F.transform("e.varbindsdecode", lambda d: F.struct(
        d["parmid"], F.map_from_entries(F.transform(
            d["decode"], lambda x: F.struct(x["_varbindvalue"], x["_varbinddecodedstring"])
        ))
    )))
    return as_definitions(rows.select(
        "def_no",
        F.col("e.uei"), F.col("e.event-label").alias("label"),
        F.transform("e.mask.maskelement", lambda m: F.struct(m["mename"].alias("name"), m["mevalue"].alias("values"))).alias("mask"),
        F.transform("e.mask.varbind", lambda v: F.struct(v["vbnumber"].alias("number"), v["vbvalue"].alias("values"))).alias("varbinds"),
        F.col("e.snmp"), F.col("e.descr"),
        F.when(F.col("e.logmsg").isNotNull(), F.struct(
            F.col("e.logmsg._dest").alias("dest"), F.trim("e.logmsg._VALUE").alias("content")
        )).alias("logmsg"),
        F.col("e.severity"),
        F.when(F.col("e.correlation").isNotNull(), F.struct(
            *[F.col(f"e.correlation.{c}").alias(c.lstrip("_")) for c in ("cuei", "cmin", "cmax", "ctime", "_state", "_path")]
        )).alias("correlation"),
        F.col("e.operinstruct"),
        action("autoaction", "state").alias("autoaction"),
        action("operaction", "state", "menutext").alias("operaction"),
        pair("autoacknowledge").alias("autoacknowledge"), F.col("e.loggroup"), pair("tticket").alias("tticket"),
        action("forward", "state", "mechanism").alias("forward"), action("script", "language").alias("script"),
        F.col("e.mouseovertext"),
        F.when(alarm.isNotNull(), F.struct(
            alarm["_alarm-type"].alias("alarm_type"), alarm["_reduction-key"].alias("reduction_key"),
            alarm["_clear-key"].alias("clear_key"), alarm["_auto-clean"].alias("auto_clean"),
            alarm["_x733-alarm-type"].alias("x733_alarm_type"), alarm["_x733-probable-cause"].alias("x733_probable_cause"),
            F.transform(alarm["update-field"], lambda u: F.struct(
                u["_field-name"].alias("field"), u["_update-on-reduction"].alias("on_reduction")
            )).alias("update_fields"),
        )).alias("alarm_data"),
        decodes.alias("decodes"),
        F.transform("e.parameter", lambda p: F.struct(
            p["_name"].alias("name"), p["_value"].alias("value"), p["_expand"].alias("expand")
        )).alias("parameters"),
        F.transform("e.filters.filter", lambda f: F.struct(
            f["_eventparm"].alias("parm"), f["_pattern"].alias("pattern"), f["_replacement"].alias("replacement")
        )).alias("filters"),
    ))


def parse_patterns(text: str) -> list[tuple[str, str]]:
    """(name, pattern) lines in file order. Comments, blank lines and repeats are dropped."""
    found: dict[str, str] = {}
    for line in text.splitlines():
        line = line.lstrip(" \t\f")
        if not line or line[0] in "#!":
            continue
        parts = re.match(r"((?:\\.|[^\\=: \t])*)[ \t]*[=:]?[ \t]*(.*)", line, re.DOTALL)
        unescape = lambda s: re.sub(r"\\(.)", r"\1", s)
        found.setdefault(unescape(parts[2]), unescape(parts[1]))
    return [(name, pattern) for pattern, name in found.items()]


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """(pattern_no, name, pattern), in file order."""
    text = spark.read.text(path, wholetext=True).first()[0]
    rows = [(i, n, p) for i, (n, p) in enumerate(parse_patterns(text), start=1)]
    return spark.createDataFrame(rows, "pattern_no int, name string, pattern string")
