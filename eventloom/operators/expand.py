"""Fill events from their definition and expand the templates in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import PARM_TYPE, parm
from ..functions.fixed import SECURABLE_TAGS
from ..functions.tokens import Context, expand_literal, expand_text, token_map
from .joins import compute_once, lookup_join

_PLAIN = ["uei", "dbid", "source", "dist_poller", "descr", "nodeid", "time", "host", "interface",
          "ifindex", "snmphost", "service", "snmp", "severity", "operinstruct", "mouseovertext", "parms"]
_LOOKED_UP = ["nodelabel", "nodelocation", "foreignsource", "foreignid", "ifalias", "dim_tokens", "interface_host"]
_SINGLE = ["mask", "descr", "logmsg", "severity", "correlation", "operinstruct",
           "autoacknowledge", "tticket", "mouseovertext"]
_MANY = ["autoaction", "operaction", "loggroup", "forward", "script"]
_ABSENT_ONLY = ["uei", "snmp", "alarm_data"]


def event_context(df: DataFrame, **overrides: Column) -> Context:
    """What the tokens read, from the columns that the frame has."""
    have = set(df.columns)
    ctx = {name: F.col(name) for name in _PLAIN + _LOOKED_UP if name in have}
    if "logmsg" in have:
        ctx["logmsg"] = F.col("logmsg.content")
    if "tticket" in have:
        ctx["tticket"] = F.col("tticket.content")
    return {**ctx, **overrides}


def decode_map(decodes: DataFrame) -> DataFrame:
    """(def_no, token, value, text) rows as one map per definition."""
    by_token = decodes.groupBy("def_no", "token", "value").agg(F.max("text").alias("text")).groupBy(
        "def_no", "token"
    ).agg(F.map_from_entries(F.collect_list(F.struct("value", "text"))).alias("texts"))
    return by_token.groupBy("def_no").agg(
        F.map_from_entries(F.collect_list(F.struct("token", "texts"))).alias("decodes")
    )


def decode_parms(df: DataFrame, decodes: DataFrame, **join) -> DataFrame:
    """Show coded parm values as ``text(value)``, by position or by name.

    The decodes are configuration, and a few definition numbers as keys of a shuffle would gather all
    events in few tasks; so they are sent to every task.
    """
    joined = lookup_join(df, F.broadcast(decode_map(decodes)), {"def_no": "def_no"}, **join)

    def shown(p: Column, i: Column) -> Column:
        by_position = F.concat(F.lit("parm[#"), (i + 1).cast("string"), F.lit("]"))
        by_name = F.concat(F.lit("parm["), p["name"], F.lit("]"))
        text = F.coalesce(*[
            F.try_element_at(F.try_element_at("decodes", token), p["value"]) for token in (by_position, by_name)
        ])
        return p.withField("value", F.coalesce(F.concat(text, F.lit("("), p["value"], F.lit(")")), p["value"]))

    return joined.withColumn("parms", F.transform("parms", shown)).drop("decodes")


def fill_from_definition(df: DataFrame, secure_tags: tuple[str, ...] = ()) -> DataFrame:
    """Fill event fields from ``def``. A secured field is cleared first, so that the
    definition's value is the only one; others are filled where absent (lists: where empty).
    """
    unknown = set(secure_tags) - set(SECURABLE_TAGS)
    if unknown:
        raise ValueError(f"cannot secure {sorted(unknown)}")
    have = set(df.columns)
    defined = F.col("def").isNotNull()
    filled: dict[str, Column] = {}
    for name in _SINGLE + _MANY + _ABSENT_ONLY:
        if name not in have:
            continue
        own, given = F.col(name), F.col(f"def.{name}")
        if name in secure_tags:
            filled[name] = F.when(defined, given).otherwise(own)
        elif name in _MANY:
            filled[name] = F.when(F.size(F.coalesce(own, F.array().cast(df.schema[name].dataType))) == 0, given).otherwise(own)
        else:
            filled[name] = F.coalesce(own, given)
    return df.withColumns(filled)


def add_default_parms(df: DataFrame) -> DataFrame:
    """Append the definition's parameters whose names the event does not carry."""
    given, own = F.col("def.parameters"), F.col("parms")
    named = lambda items, p: F.exists(items, lambda q: q["name"] == p["name"])
    new = F.filter(given, lambda p, i: ~named(own, p) & ~named(F.slice(given, F.lit(1), i), p))
    as_parm = F.transform(
        new, lambda p: parm(p["name"], p["value"]).withField("expand", F.coalesce(p["expand"], F.lit(False)))
    )
    return df.withColumn("parms", F.coalesce(F.concat(own, as_parm.cast(PARM_TYPE)), own))


def expand_templates(
    df: DataFrame, templates: dict[str, str | Column], decode: Column | None = None, **context: Column
) -> DataFrame:
    """Add one column per template. Text is compiled on the driver; a column is cut per row."""
    ctx = event_context(df, **context)
    compiled = {n: expand_literal(t, ctx, decode) for n, t in templates.items() if isinstance(t, str)}
    out = df.withColumns(compiled) if compiled else df
    held = {n: t for n, t in templates.items() if not isinstance(t, str)}
    if not held:
        return out
    out = compute_once(out, {"_tokens": token_map(ctx)})
    ctx = {**ctx, "tokens": F.col("_tokens")}
    return out.withColumns({n: expand_text(t, ctx, decode) for n, t in held.items()}).drop("_tokens")


def _expanded(text: Column, known: list[str], ctx: Context, spare: Context, decode: Column | None) -> Column:
    """Expansion of a text column. Texts among the ``known`` templates take a form compiled on the
    driver; any other is cut per row, in the context ``spare``."""
    out: Column | None = None
    for template in dict.fromkeys(known):
        out = (out.when if out is not None else F.when)(text == template, expand_literal(template, ctx, decode))
    cut = expand_text(text, spare, decode)
    return cut if out is None else out.otherwise(cut)


def _expand_parms(df: DataFrame, decode: Column | None, known: list[str]) -> Column:
    """Parms marked for it are expanded in order; each sees those before it expanded.

    A list with one marked parm is done in one pass, since that parm sees only unmarked ones
    and itself. Only lists with several are folded.
    """
    marked = lambda p: F.coalesce(p["expand"], F.lit(False))

    def rewritten(parms: Column, due) -> Column:
        ctx = event_context(df, parms=parms)
        new = lambda p: p.withField("value", _expanded(p["value"], known, ctx, ctx, decode))
        return F.transform(parms, lambda p, i: F.when(due(p, i) & p["value"].isNotNull(), new(p)).otherwise(p))

    parms = F.col("parms")
    folded = F.aggregate(F.sequence(F.lit(0), F.size(parms) - 1), parms,
                         lambda done, at: rewritten(done, lambda p, i: (i == at) & marked(p)))
    count = F.size(F.filter(parms, marked))
    return F.when(count == 1, rewritten(parms, lambda p, _: marked(p))).when(count > 1, folded).otherwise(parms)


# Fields that expansion itself changes, so that their tokens are read afresh each time.
_LIVE = frozenset({"descr", "logmsg", "operinstruct", "tticketid"})
#: Fields that ``expand_event`` may get known templates for.
EXPANDED = ("parms", "descr", "logmsg", "operinstruct", "autoaction", "operaction", "tticket", "reduction_key", "clear_key")


def expand_event(df: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Expand every field that may hold templates, in order: a field sees those before it
    expanded. Coded values are decoded in parms, description and log message only.

    ``templates`` gives the templates that are known for a field of ``EXPANDED``, as those of the
    definitions are. They are compiled on the driver; texts that come with the events are cut per row.
    """
    have, known = set(df.columns), templates or {}
    decode = F.col("def.decodes") if "def" in have else None

    def text(field: str, value: Column, d: Column | None = None) -> Column:
        ctx = event_context(df)
        return _expanded(value, known.get(field, []), ctx, {**ctx, "tokens": F.col("_tokens"), "live": _LIVE}, d)

    def cut(field: str, value: Column) -> Column:
        other = value.contains("%")
        names = known.get(field, [])
        return F.coalesce(other & ~value.isin(names) if names else other, F.lit(False))

    cut_action = lambda field: lambda a: cut(field, a["content"])
    content = lambda field: lambda a: a.withField("content", text(field, a["content"]))
    out = df.withColumn("parms", _expand_parms(df, decode, known.get("parms", [])))
    # The map of all fixed tokens is made only for rows that have a text to cut.
    needed = cut("descr", F.col("descr")) | cut("logmsg", F.col("logmsg.content"))
    if "operinstruct" in have:
        needed = needed | cut("operinstruct", F.col("operinstruct"))
    for name in ("autoaction", "operaction"):
        if name in have:
            needed = needed | F.coalesce(F.exists(name, cut_action(name)), F.lit(False))
    if "tticket" in have:
        needed = needed | cut("tticket", F.col("tticket.content"))
    if "alarm_data" in have:
        needed = needed | cut("reduction_key", F.col("alarm_data.reduction_key")) | cut("clear_key", F.col("alarm_data.clear_key"))
    out = compute_once(out, {"_tokens": F.when(needed, token_map(event_context(df), _LIVE))})
    out = compute_once(out, {"descr": text("descr", F.col("descr"), decode)})
    logmsg = F.col("logmsg")
    out = compute_once(out, {"logmsg": logmsg.withField("content", text("logmsg", logmsg["content"], decode))})
    if "operinstruct" in have:
        out = out.withColumn("operinstruct", text("operinstruct", F.col("operinstruct")))
    actions = {name: F.transform(name, content(name)) for name in ("autoaction", "operaction") if name in have}
    if "tticket" in have:
        actions["tticket"] = content("tticket")(F.col("tticket"))
    if actions:
        out = out.withColumns(actions)
    if "alarm_data" in have:
        alarm = F.col("alarm_data")
        out = out.withColumn("alarm_data", alarm.withField("reduction_key", text("reduction_key", alarm["reduction_key"]))
                             .withField("clear_key", text("clear_key", alarm["clear_key"])))
    return out.drop("_tokens")


def expand_map(df: DataFrame, col: str) -> DataFrame:
    """Expand the values of a map column; null values stay null."""
    ctx = event_context(df)
    return df.withColumn(col, F.transform_values(col, lambda _, v: expand_text(v, ctx)))


def alarm_keys(df: DataFrame) -> DataFrame:
    """The prepared alarm columns. Nothing is reduced here."""
    alarm = F.col("alarm_data")
    return df.withColumns({
        name: alarm[name]
        for name in ("reduction_key", "clear_key", "alarm_type", "auto_clean", "update_fields")
    })
