"""Dimension lookups: nodes, interfaces, assets, hardware, services, definitions.

Every dimension is brought to one row per key first: where a key repeats, the least row counts
(the smallest node or service number, the first text), so no lookup multiplies events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import parm_value, sanitize_html
from ..functions.tokens import template_tokens
from .joins import compute_once, lookup_join, one_per_key


def lookup_node(
    df: DataFrame, interfaces: DataFrame, address: str = "interface", as_reference: bool = False, **join
) -> DataFrame:
    """Set ``nodeid`` by (location, ip); numbers up to 0 count as not found.

    ``as_reference`` repeats the historic overwrite of every result with 0.
    """
    base = df.drop("nodeid")
    if as_reference:
        return base.withColumn("nodeid", F.when(F.col(address).isNotNull(), F.lit(0)).cast("bigint"))
    dim = interfaces.filter(F.col("nodeid") > 0).select("location", "ip", F.col("nodeid").cast("bigint"))
    dim = one_per_key(dim, ["location", "ip"])
    return lookup_join(base, dim, {"location": "location", address: "ip"}, **join)


def resolve_foreign_node(df: DataFrame, nodes: DataFrame, **join) -> DataFrame:
    """Where ``nodeid`` is 0, find the node by the foreign source and id among the parms."""
    open_row = F.coalesce("nodeid", F.lit(0)) == 0
    keyed = df.withColumns({
        "_fs": F.when(open_row, parm_value(F.col("parms"), "_foreignSource")),
        "_fi": F.when(open_row, parm_value(F.col("parms"), "_foreignId")),
    })
    dim = nodes.select("foreign_source", "foreign_id", F.col("nodeid").alias("_found"))
    dim = one_per_key(dim, ["foreign_source", "foreign_id"])
    out = lookup_join(keyed, dim, {"_fs": "foreign_source", "_fi": "foreign_id"}, **join)
    return out.withColumn("nodeid", F.coalesce("_found", "nodeid")).drop("_fs", "_fi", "_found")


def enrich_node(df: DataFrame, nodes: DataFrame, **join) -> DataFrame:
    """Add label, location and foreign ids of the node, made safe for display."""
    dim = nodes.select(
        F.col("nodeid"), F.col("label").alias("_label"), F.col("location").alias("_location"),
        F.col("foreign_source").alias("_fs"), F.col("foreign_id").alias("_fi"),
    )
    dim = one_per_key(dim, ["nodeid"])
    clean = lambda c, missing: F.coalesce(sanitize_html(F.col(c)), F.lit(missing))
    return lookup_join(df, dim, {"nodeid": "nodeid"}, **join).withColumns({
        "nodelabel": clean("_label", "Unknown"), "nodelocation": clean("_location", "Unknown"),
        "foreignsource": clean("_fs", ""), "foreignid": clean("_fi", ""),
    }).drop("_label", "_location", "_fs", "_fi")


def lookup_host(df: DataFrame, interfaces: DataFrame, host: str = "host", **join) -> DataFrame:
    """Add ``event_host``: the interface's host name, else the host itself."""
    dim = one_per_key(interfaces.select("nodeid", "ip", F.col("hostname").alias("_name")), ["nodeid", "ip"])
    out = lookup_join(df, dim, {"nodeid": "nodeid", host: "ip"}, **join)
    return out.withColumn("event_host", F.coalesce("_name", host)).drop("_name")


def lookup_ifalias(df: DataFrame, interfaces: DataFrame, address: str = "interface", **join) -> DataFrame:
    """Add ``ifalias``: for a known node its alias, which may be null; else the interface."""
    dim = one_per_key(interfaces.select("nodeid", "ip", F.col("if_alias").alias("_alias")), ["nodeid", "ip"])
    known = F.coalesce(F.col("nodeid") > 0, F.lit(False)) & F.col(address).isNotNull()
    out = lookup_join(df, dim, {"nodeid": "nodeid", address: "ip"}, **join)
    return out.withColumn("ifalias", F.when(known, F.col("_alias")).otherwise(F.col(address))).drop("_alias")


def _string_fields(dim: DataFrame, but: tuple[str, ...]) -> dict[str, str]:
    return {c.lower(): c for c, t in dim.dtypes if t == "string" and c not in but}


def lookup_asset(df: DataFrame, assets: DataFrame, field: str, out: str = "asset", **join) -> DataFrame:
    """Add one asset field of the node; field names ignore case, missing reads "Unknown"."""
    column = _string_fields(assets, ()).get(field.lower())
    if column is None:
        return df.withColumn(out, F.lit("Unknown"))
    dim = one_per_key(assets.select("nodeid", F.col(column).alias("_asset")), ["nodeid"])
    found = lookup_join(df, dim, {"nodeid": "nodeid"}, **join)
    return found.withColumn(out, F.coalesce("_asset", F.lit("Unknown"))).drop("_asset")


def unpivot_assets(assets: DataFrame) -> DataFrame:
    """Assets as (nodeid, field, value), for fields that differ from row to row."""
    fields = _string_fields(assets, ())
    return assets.unpivot("nodeid", list(fields.values()), "field", "value").withColumn("field", F.lower("field"))


def lookup_hardware(
    df: DataFrame, hardware: DataFrame, selector: str, field: str, out: str = "hardware", **join
) -> DataFrame:
    """Add one hardware field of the node.

    The selector is an entity index, ``~pattern`` in LIKE form, or an exact name. Where
    several entities fit, the one with the highest id counts. Missing reads "Unknown".
    """
    column = _string_fields(hardware, ()).get(field.lower())
    if column is None:
        return df.withColumn(out, F.lit("Unknown"))
    if selector.startswith("~"):
        fits = F.col("ent_name").like(selector[1:])
    elif selector.lstrip("+-").isdigit():
        fits = F.col("ent_index") == int(selector)
    else:
        fits = F.col("ent_name") == selector
    dim = hardware.filter(fits).groupBy("nodeid").agg(F.max_by(column, "id").alias("_hardware"))
    found = lookup_join(df, dim, {"nodeid": "nodeid"}, **join)
    return found.withColumn(out, F.coalesce("_hardware", F.lit("Unknown"))).drop("_hardware")


def add_dimension_tokens(
    df: DataFrame, templates: list[str], assets: DataFrame | None = None, hardware: DataFrame | None = None, **join
) -> DataFrame:
    """Join only the asset and hardware fields that the templates name, as ``dim_tokens``."""
    pairs: list[Column] = []
    for i, token in enumerate(sorted(template_tokens(*templates))):
        inner = token[token.find("[") + 1:-1] if token.endswith("]") else ""
        column = f"_token_{i}"
        if token.startswith("asset[") and inner and assets is not None:
            df = lookup_asset(df, assets, inner, column, **join)
        elif token.startswith("hardware[") and ":" in inner and hardware is not None:
            selector, field = inner.rsplit(":", 1)
            df = lookup_hardware(df, hardware, selector, field, column, **join)
        else:
            continue
        pairs += [F.lit(token), F.col(column)]
    tokens = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.withColumn("dim_tokens", tokens).drop(*[c for c in df.columns if c.startswith("_token_")])


def resolve_refs(
    df: DataFrame, services: DataFrame, systems: DataFrame, local: str,
    header: str = "header_dp", event: str = "dist_poller", **join
) -> DataFrame:
    """Add ``service_id`` by name, and ``resolved_system``: the header's system, else the
    event's, else the local one. Blank and unknown names are passed over."""
    named = lambda c: F.when(F.trim(F.col(c)) != "", F.col(c))
    out = df.withColumns({"_first": named(header), "_second": named(event)})
    by_name = one_per_key(services.select("name", "service_id"), ["name"])
    out = lookup_join(out, by_name, {"service": "name"}, **join)
    for key, found in (("_first", "_found_1"), ("_second", "_found_2")):
        known = systems.select(F.col("system_id"), F.col("system_id").alias(found)).distinct()
        out = lookup_join(out, known, {key: "system_id"}, **join)
    return out.withColumn("resolved_system", F.coalesce("_found_1", "_found_2", F.lit(local))).drop(
        "_first", "_second", "_found_1", "_found_2"
    )


# Definitions in one generated expression; more are tried block by block.
_BLOCK = 100


def _mask_test(by_element: dict[str, list[str]], elements: dict[str, Column]) -> Column:
    """Whether every element of a mask has a fitting value: equal; ``prefix%``; or ``~regex`` over all of it."""
    fits = F.lit(True)
    for element, values in by_element.items():
        value = elements[element].cast("string") if element in elements else F.lit(None).cast("string")
        plain = [v for v in values if not v.endswith("%") and not v.startswith("~")]
        test = value.isin(plain) if plain else F.lit(False)
        for v in dict.fromkeys(v for v in values if v not in plain):
            if v.endswith("%"):
                test = test | F.startswith(value, F.lit(v[:-1]))
            else:
                test = test | value.rlike(rf"\A(?:{v[1:]})\z")
        fits = fits & test
    return F.coalesce(fits, F.lit(False))


def match_masks(
    df: DataFrame, masks: list[tuple[int, str, str]] | DataFrame, elements: dict[str, Column], index: str | None = None
) -> DataFrame:
    """Add ``def_no``: the earliest definition whose every mask element has a fitting value.

    ``masks`` holds (def_no, element, value); a table of them is configuration and is read on the
    driver. They become literal tests, each regex compiled once per task, and nothing is
    shuffled. ``index`` names an element that most definitions give exact values for (a name
    or an id): the definitions of one value are then tried only for events that have it.
    """
    if isinstance(masks, DataFrame):
        masks = [(r.def_no, r.element, r.val) for r in masks.select("def_no", "element", "val").collect()]
    by_def: dict[int, dict[str, list[str]]] = {}
    for def_no, element, value in masks:
        by_def.setdefault(def_no, {}).setdefault(element, []).append(value)
    keyed: dict[str, list[int]] = {}
    others: list[int] = []
    for def_no in sorted(by_def):
        values = by_def[def_no].get(index or "", [])
        if values and index in elements and not any(v.endswith("%") or v.startswith("~") for v in values):
            for v in dict.fromkeys(values):
                keyed.setdefault(v, []).append(def_no)
        else:
            others.append(def_no)

    def first_of(numbers: list[int]) -> Column:
        found: Column | None = None
        for n in numbers:
            found = (found.when if found is not None else F.when)(_mask_test(by_def[n], elements), F.lit(n))
        return found

    blocks = [others[k:k + _BLOCK] for k in range(0, len(others), _BLOCK)]
    tests = [first_of(b) for b in blocks]
    values = list(keyed)
    for k in range(0, len(values), _BLOCK):
        chosen: Column | None = None
        for v in values[k:k + _BLOCK]:
            hit = elements[index].cast("string") == v
            chosen = (chosen.when if chosen is not None else F.when)(hit, first_of(keyed[v]))
        tests.append(chosen)
    out = df
    for k, test in enumerate(tests):
        out = compute_once(out, {f"_found_{k}": test})
    names = [f"_found_{k}" for k in range(len(tests))]
    number = F.lit(None).cast("int") if not names else F.col(names[0]) if len(names) == 1 else F.least(*names)
    return out.withColumn("def_no", number).drop(*names)


def mask_rows(defs: DataFrame) -> DataFrame:
    """(def_no, element, val) of all masks; a numbered varbind is element ``varbind#n``."""
    named = defs.select("def_no", F.inline("mask")).select(
        "def_no", F.col("name").alias("element"), F.explode("values").alias("val")
    )
    numbered = defs.select("def_no", F.inline("varbinds")).select(
        "def_no", F.concat(F.lit("varbind#"), F.col("number").cast("string")).alias("element"),
        F.explode("values").alias("val"),
    )
    return named.union(numbered)


def mask_elements(varbinds: int = 0) -> dict[str, Column]:
    """The event columns that mask elements name."""
    named = {
        "uei": F.col("uei"), "source": F.col("source"), "host": F.col("host"),
        "nodeid": F.col("nodeid"), "interface": F.col("interface"), "service": F.col("service"),
        "snmphost": F.col("snmphost"), "id": F.col("snmp.id"), "generic": F.col("snmp.generic"),
        "specific": F.col("snmp.specific"), "community": F.col("snmp.community"),
    }
    bound = {f"varbind#{i}": F.try_element_at("parms", F.lit(i))["value"] for i in range(1, varbinds + 1)}
    return {**named, **bound}


def lookup_definition(df: DataFrame, defs: DataFrame, default_uei: str | None = None, **join) -> DataFrame:
    """Add the definition as the struct ``def``.

    A mask match (``def_no``, where present) wins, then the earliest maskless definition
    of the event's name, then the one named ``default_uei``. Definitions are configuration and are
    sent to every task: a few names and numbers as keys of a shuffle would gather all events in few tasks.
    """
    maskless = defs.filter((F.size(F.coalesce("mask", F.array())) == 0) & (F.size(F.coalesce("varbinds", F.array())) == 0))
    by_name = maskless.groupBy("uei").agg(F.min("def_no").alias("_by_name"))
    default = F.lit(None).cast("int")
    if default_uei is not None:
        default = defs.filter(F.col("uei") == default_uei).agg(F.min("def_no")).scalar()
    masked = F.col("def_no") if "def_no" in df.columns else F.lit(None).cast("int")
    keyed = lookup_join(df, F.broadcast(by_name), {"uei": "uei"}, **join)
    keyed = keyed.withColumn("def_no", F.coalesce(masked, "_by_name", default)).drop("_by_name")
    dim = defs.select("def_no", F.struct(*defs.columns).alias("def"))
    return lookup_join(keyed, F.broadcast(dim), {"def_no": "def_no"}, **join)
