"""``%token%`` expansion as column expressions.

A template known on the driver becomes one flat ``concat``; text held in a column is cut
into constants and tokens per row. Both ask the same ordered list of resolvers.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import bind, escape_delimiter, split_extract, trim_control

TOKEN = r"%([^%\s]*)%"
_NAMED = r"^parm\[(.*)\]$"
_NUMBERED_NAME = r"^parm\[name-#(\d+)(?:([^0-9+-]+)([+-]?\d+)(?:(:)([+-]?\d+)?)?)?\]"
LONG_TIME = "EEEE, MMMM d, yyyy h:mm:ss a 'UTC'"
SHORT_TIME = "M/d/yy h:mm a"

Context = dict[str, Any]
Builder = Callable[[Column, Context], Column]


@dataclass(frozen=True)
class Resolver:
    """Gives the value of every token equal to ``text``, starting with it, or matching it."""

    kind: str
    text: str
    build: Builder

    def accepts(self, token: str) -> bool:
        if self.kind == "equals":
            return token == self.text
        if self.kind == "prefix":
            return token.startswith(self.text)
        return re.search(self.text, token) is not None

    def condition(self, token: Column) -> Column:
        if self.kind == "equals":
            return token == F.lit(self.text)
        if self.kind == "prefix":
            return F.startswith(token, F.lit(self.text))
        return token.rlike(self.text)


def _column(name: str, missing: str | None = None) -> Builder:
    def build(_: Column, ctx: Context) -> Column:
        value = ctx.get(name, F.lit(None)).cast("string")
        return value if missing is None else F.coalesce(value, F.lit(missing))

    return build


def _snmp(name: str) -> Builder:
    return lambda _, ctx: ctx["snmp"][name].cast("string")


def _time(pattern: str) -> Builder:
    return lambda _, ctx: F.date_format(ctx["time"], pattern)


def _snmp_all(_: Column, ctx: Context) -> Column:
    snmp = ctx["snmp"]
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("undefined"))
    joined = F.concat_ws(
        ",",
        F.coalesce(snmp["id"], F.lit("null")),
        shown(escape_delimiter(trim_control(snmp["idtext"]), ",")),
        F.coalesce(snmp["version"], F.lit("null")),
        shown(snmp["specific"]),
        shown(snmp["generic"]),
        shown(trim_control(snmp["community"])),
    )
    return F.when(snmp.isNotNull(), joined)


def _present(parms: Column) -> Column:
    return F.filter(parms, lambda p: p["value"].isNotNull())


def _joined(texts: Column) -> Column:
    """Blank-separated; texts that are empty add nothing before the first that is not."""
    return F.aggregate(
        texts, F.lit("").cast("string"),
        lambda acc, t: F.when(acc == "", t).otherwise(F.concat(acc, F.lit(" "), t)),
    )


def _all_values(_: Column, ctx: Context) -> Column:
    return _joined(F.transform(_present(ctx["parms"]), lambda p: p["value"]))


def _all_names(_: Column, ctx: Context) -> Column:
    named = F.filter(ctx["parms"], lambda p: p["name"].isNotNull())
    return _joined(F.transform(named, lambda p: trim_control(p["name"])))


def _all_parms(_: Column, ctx: Context) -> Column:
    shown = F.filter(ctx["parms"], lambda p: p["name"].isNotNull() & p["value"].isNotNull())
    return F.array_join(
        F.transform(shown, lambda p: F.concat(trim_control(p["name"]), F.lit('="'), p["value"], F.lit('"'))),
        " ",
    )


def _at(parms: Column, number: Column) -> Column:
    return F.when(number > 0, F.try_element_at(parms, number))


def _numbered_value(token: Column, ctx: Context) -> Column:
    number = F.regexp_extract(token, r"^parm\[#([+-]?\d+)\]", 1).try_cast("int")
    return _at(ctx["parms"], number)["value"]


def _numbered_name(token: Column, ctx: Context) -> Column:
    def name_of(spec: Column) -> Column:
        return _at(ctx["parms"], spec["number"])["name"]

    def cut(spec: Column) -> Column:
        part = split_extract(name_of(spec), spec["sep"], spec["offset"], spec["ranged"], spec["length"])
        return F.when(spec["sep"] == "", name_of(spec)).otherwise(part)

    part = lambda i: F.regexp_extract(token, _NUMBERED_NAME, i)
    return bind(F.struct(
        part(1).try_cast("int").alias("number"), part(2).alias("sep"), part(3).try_cast("int").alias("offset"),
        (part(4) == ":").alias("ranged"), F.coalesce(part(5).try_cast("int"), F.lit(0)).alias("length"),
    ), cut)


def _named_value(token: Column, ctx: Context) -> Column:
    wanted = trim_control(F.regexp_extract(token, _NAMED, 1))
    found = F.filter(ctx["parms"], lambda p: trim_control(p["name"]) == wanted)
    return F.try_element_at(found, F.lit(1))["value"]


def _dimension(token: Column, ctx: Context) -> Column:
    known = ctx.get("dim_tokens")
    value = F.lit(None).cast("string") if known is None else F.try_element_at(known, token)
    return F.coalesce(value, F.lit("Unknown"))


def _interface_name(_: Column, ctx: Context) -> Column:
    return F.coalesce(ctx.get("interface_host", F.lit(None)).cast("string"), ctx["interface"])


def _alias(_: Column, ctx: Context) -> Column:
    alias = ctx.get("ifalias", F.lit(None)).cast("string")
    return F.when((ctx["nodeid"] > 0) & ctx["interface"].isNotNull(), alias).otherwise(ctx["interface"])


STANDARD = [
    Resolver("equals", "uei", _column("uei")),
    Resolver("equals", "eventid", _column("dbid", "eventid-unknown")),
    Resolver("equals", "source", _column("source")),
    Resolver("equals", "dpname", _column("dist_poller")),
    Resolver("equals", "descr", _column("descr")),
    Resolver("equals", "logmsg", _column("logmsg")),
    Resolver("equals", "nodeid", _column("nodeid", "0")),
    Resolver("equals", "time", _time(LONG_TIME)),
    Resolver("equals", "shorttime", _time(SHORT_TIME)),
    Resolver("equals", "host", _column("host")),
    Resolver("equals", "interface", _column("interface")),
    Resolver("equals", "ifindex", _column("ifindex", "N/A")),
    Resolver("equals", "interfaceresolve", _interface_name),
    Resolver("equals", "snmphost", _column("snmphost")),
    Resolver("equals", "service", _column("service")),
    Resolver("equals", "snmp", _snmp_all),
    Resolver("equals", "id", _snmp("id")),
    Resolver("equals", "idtext", _snmp("idtext")),
    Resolver("equals", "version", _snmp("version")),
    Resolver("equals", "specific", _snmp("specific")),
    Resolver("equals", "generic", _snmp("generic")),
    Resolver("equals", "community", _snmp("community")),
    Resolver("equals", "severity", _column("severity")),
    Resolver("equals", "operinstruct", _column("operinstruct")),
    Resolver("equals", "mouseovertext", _column("mouseovertext")),
    Resolver("equals", "tticketid", _column("tticket", "")),
    Resolver("equals", "parm[values-all]", _all_values),
    Resolver("equals", "parm[names-all]", _all_names),
    Resolver("equals", "parm[all]", _all_parms),
    Resolver("equals", "parm[##]", lambda _, ctx: F.size(ctx["parms"]).cast("string")),
    Resolver("prefix", "parm[#", _numbered_value),
    Resolver("prefix", "parm[name-#", _numbered_name),
    Resolver("regex", _NAMED, _named_value),
    Resolver("prefix", "hardware[", _dimension),
    Resolver("prefix", "asset[", _dimension),
    Resolver("equals", "nodelabel", _column("nodelabel", "Unknown")),
    Resolver("equals", "nodelocation", _column("nodelocation", "Unknown")),
    Resolver("equals", "foreignsource", _column("foreignsource", "")),
    Resolver("equals", "foreignid", _column("foreignid", "")),
    Resolver("equals", "ifalias", _alias),
]

_REGISTERED: list[Resolver] = []


def register_token(text: str, build: Builder, kind: str = "equals") -> None:
    """Add a resolver. It is asked after the standard ones, in order of registration."""
    if kind not in ("equals", "prefix", "regex"):
        raise ValueError(f"unknown resolver kind {kind!r}")
    _REGISTERED.append(Resolver(kind, text, build))


def unregister_token(text: str) -> None:
    _REGISTERED[:] = [r for r in _REGISTERED if r.text != text]


def resolvers() -> list[Resolver]:
    return STANDARD + _REGISTERED


def template_tokens(*templates: str | None) -> set[str]:
    """All tokens that the templates use."""
    return {t for text in templates if text for t in re.findall(TOKEN, text, re.ASCII)}


def _decoded(token: Column, value: Column, decode: Column | None) -> Column:
    if decode is None:
        return value
    text = F.try_element_at(F.try_element_at(decode, token), value)
    return F.coalesce(F.concat(text, F.lit("("), value, F.lit(")")), value)


def token_map(ctx: Context, but: frozenset[str] = frozenset()) -> Column:
    """All tokens of a fixed name and their values, without those in ``but``."""
    fixed = [r for r in STANDARD if r.kind == "equals" and r.text not in but]
    return F.create_map(*[c for r in fixed for c in (F.lit(r.text), r.build(F.lit(r.text), ctx))])


def resolve(token: Column, ctx: Context, decode: Column | None = None) -> Column:
    """Value of a token held in a column; unknown tokens and missing values read empty.

    Where the context holds ``tokens``, a ``token_map``, fixed names are looked up there
    and only those it leaves out (``live``) and the open-ended ones are worked out here.
    """
    held, live = ctx.get("tokens"), ctx.get("live", frozenset())
    steps = [(r.condition(token), r.build(token, ctx)) for r in resolvers()
             if held is None or r.kind != "equals" or r.text in live or r in _REGISTERED]
    if held is not None:
        steps.insert(0, (F.map_contains_key(held, token), F.try_element_at(held, token)))
    chain = F.when(*steps[0])
    for step in steps[1:]:
        chain = chain.when(*step)
    return F.coalesce(_decoded(token, chain, decode), F.lit(""))


def expand_literal(template: str, ctx: Context, decode: Column | None = None) -> Column:
    """Expansion of a template known on the driver."""
    parts: list[Column] = []
    for i, piece in enumerate(re.split(TOKEN, template, flags=re.ASCII)):
        if i % 2 == 0:
            if piece:
                parts.append(F.lit(piece))
            continue
        resolver = next((r for r in resolvers() if r.accepts(piece)), None)
        if resolver is not None:
            token = F.lit(piece)
            value = _decoded(token, resolver.build(token, ctx), decode)
            parts.append(F.coalesce(value, F.lit("")))
    return F.concat(F.lit(""), *parts)


def expand_text(text: Column, ctx: Context, decode: Column | None = None) -> Column:
    """Expansion of templates held in a column. Text without a token stays as it is."""
    pieces = F.split(text, TOKEN, -1)
    values = F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(1)), lambda t: resolve(t, ctx, decode))
    woven = F.zip_with(pieces, values, lambda p, v: F.concat(p, F.coalesce(v, F.lit(""))))
    return F.when(text.rlike(TOKEN), F.array_join(woven, "")).otherwise(text)
