"""The whole way from a raw line to an expanded event, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.events import host_address, to_events
from ..operators.expand import add_default_parms, expand_event, fill_from_definition
from ..operators.extract import extract_fields, to_messages
from ..operators.lookup import (
    add_dimension_tokens, enrich_node, lookup_definition, lookup_host, lookup_ifalias, lookup_node,
    mask_elements, match_masks, resolve_foreign_node, resolve_refs,
)
from ..operators.rules import ParmFilter, Rule, flag_rejects, match_rules, rewrite_parms
from ..functions.tokens import template_tokens


@dataclass
class Config:
    """Everything that is not the stream itself: rules, definitions and dimensions."""

    patterns: list[str]
    rules: list[Rule]
    discard_uei: str = "DISCARD"
    definitions: DataFrame | None = None
    masks: list[tuple[int, str, str]] | DataFrame | None = None
    default_uei: str | None = None
    secure_tags: tuple[str, ...] = ()
    interfaces: DataFrame | None = None
    nodes: DataFrame | None = None
    hosts: DataFrame | None = None
    assets: DataFrame | None = None
    hardware: DataFrame | None = None
    services: DataFrame | None = None
    systems: DataFrame | None = None
    local_system: str = "local"
    templates: list[str] = field(default_factory=list)
    parm_filters: list[ParmFilter] = field(default_factory=list)
    uei_prefix: str = "uei.example.org/syslog"
    strict_patterns: bool = False
    varbinds: int = 0
    mask_index: str | None = "uei"
    salts: int = 1


def parse_messages(df: DataFrame, config: Config, ref_time: Column) -> DataFrame:
    """Raw lines to matched messages, with ``reject_reason`` and ``discarded`` flags.

    Rows that cannot go on keep their reason and are not dropped here.
    """
    parsed = to_messages(extract_fields(df, "raw", config.patterns, config.strict_patterns), ref_time)
    flagged = flag_rejects(parsed).withColumnRenamed("reject_reason", "parse_reason")
    matched = match_rules(
        host_address(flagged, config.hosts), config.rules, config.discard_uei, keep_discarded=True
    )
    return matched.withColumn("reject_reason", F.coalesce("parse_reason", "reject_reason")).drop("parse_reason")


def build_events(matched: DataFrame, config: Config) -> DataFrame:
    """Matched messages to expanded events. Only the dimensions that the templates name are joined.

    ``templates`` in the configuration take the place of those in the definitions. ``parm_filters``
    come before the filters of the definitions. ``salts`` splits hot keys in every lookup.
    """
    events = to_events(matched, config.uei_prefix)
    if config.interfaces is not None:
        events = lookup_node(events, config.interfaces, salts=config.salts)
    if config.nodes is not None:
        events = resolve_foreign_node(events, config.nodes, salts=config.salts)
    masked = events
    if config.masks is not None:
        masked = match_masks(events, config.masks, mask_elements(config.varbinds), config.mask_index)
    if config.definitions is None:
        return masked
    out = lookup_definition(masked, config.definitions, config.default_uei, salts=config.salts)
    out = add_default_parms(fill_from_definition(out, config.secure_tags))
    filters = config.parm_filters + definition_filters(config.definitions)
    if filters:
        out = rewrite_parms(out, filters)
    by_field = templates_by_field(config.definitions)
    templates = config.templates or [t for texts in by_field.values() for t in texts]
    used = template_tokens(*templates)
    if config.nodes is not None and used & {"nodelabel", "nodelocation", "foreignsource", "foreignid"}:
        out = enrich_node(out, config.nodes, salts=config.salts)
    if config.interfaces is not None and "ifalias" in used:
        out = lookup_ifalias(out, config.interfaces, salts=config.salts)
    if any(t.startswith(("asset[", "hardware[")) for t in used):
        out = add_dimension_tokens(out, templates, config.assets, config.hardware, salts=config.salts)
    return expand_event(out, by_field)


def add_row_lookups(events: DataFrame, config: Config) -> DataFrame:
    """Join what only the flat event table needs."""
    if config.interfaces is not None:
        events = lookup_host(events, config.interfaces, salts=config.salts)
    if config.services is not None and config.systems is not None:
        if "header_dp" not in events.columns:
            events = events.withColumn("header_dp", F.lit(None).cast("string"))
        events = resolve_refs(events, config.services, config.systems, config.local_system, salts=config.salts)
    return events


def templates_by_field(definitions: DataFrame) -> dict[str, list[str]]:
    """The templates of the definitions per field of ``EXPANDED``. They are configuration, read once."""
    texts = {
        "parms": F.coalesce(F.col("parameters.value"), F.array()), "descr": F.array("descr"), "logmsg": F.array("logmsg.content"),
        "operinstruct": F.array("operinstruct"), "autoaction": F.coalesce(F.col("autoaction.content"), F.array()),
        "operaction": F.coalesce(F.col("operaction.content"), F.array()), "tticket": F.array("tticket.content"),
        "reduction_key": F.array("alarm_data.reduction_key"), "clear_key": F.array("alarm_data.clear_key"),
    }
    each = F.concat(*[F.transform(t, lambda x, n=n: F.struct(F.lit(n).alias("field"), x.alias("text"))) for n, t in texts.items()])
    rows = definitions.select(F.inline(each)).filter(F.col("text").contains("%")).distinct().orderBy("field", "text").collect()
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.field, []).append(r.text)
    return out


def definition_templates(definitions: DataFrame) -> list[str]:
    """All template texts of the definitions."""
    return sorted({t for texts in templates_by_field(definitions).values() for t in texts})


def definition_filters(definitions: DataFrame) -> list[ParmFilter]:
    """The parm filters that the definitions carry, earlier definitions first."""
    rows = definitions.select("def_no", "uei", F.posexplode("filters").alias("pos", "f")).orderBy("def_no", "pos")
    return [ParmFilter(r.f["parm"], r.uei, r.f["pattern"], r.f["replacement"]) for r in rows.collect()]
