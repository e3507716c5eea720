"""Raw lines to fields, and fields to messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import dashed, to_int
from ..functions.patterns import Pattern, compile_patterns
from ..functions.priority import facility_of, severity_of
from ..functions.times import TIME_FIELDS, event_time_of
from .joins import compute_once


def extract_fields(
    df: DataFrame, col: str, patterns: list[str] | list[Pattern], strict: bool = False
) -> DataFrame:
    """Add ``pattern_no`` and the ``params`` map of the first pattern that matches.

    Patterns are tried in order and numbered from 1. Without a match the number is null
    and the map empty.
    """
    compiled = [p if isinstance(p, Pattern) else None for p in patterns]
    if None in compiled:
        compiled = compile_patterns(list(patterns), strict)
    text = F.col(col)
    number: Column | None = None
    for i, pattern in enumerate(compiled, start=1):
        number = (number.when if number is not None else F.when)(pattern.matches(text), F.lit(i))
    df = compute_once(df, {"pattern_no": number if number is not None else F.lit(None).cast("int")})
    groups: Column | None = None
    fields: Column | None = None
    for i, pattern in enumerate(compiled, start=1):
        hit = F.col("pattern_no") == i
        groups = (groups.when if groups is not None else F.when)(hit, pattern.groups(text))
        fields = (fields.when if fields is not None else F.when)(hit, pattern.fields(F.col("_groups")))
    empty = F.create_map().cast("map<string,string>")
    if fields is None:
        return df.withColumn("params", empty)
    grouped = compute_once(df, {"_groups": groups})
    return compute_once(grouped, {"params": fields.otherwise(empty)}).drop("_groups")


_FIELDS = ["facilityCode", "messageId", "hostname", "processName", "processId", "version", "message"]
_FIREWALL = ["firewallVersion", "recievedate", "recievetime", "serialnumber", "type", "subtype"]


def _unmarked(value: Column) -> Column:
    """Without a leading ``BOM``."""
    return F.when(F.startswith(value, F.lit("BOM")), F.substr(value, F.lit(4))).otherwise(value)


def _message(raw: Column) -> Column:
    """The message text; firewall lines are put together again from their parts."""
    part = lambda name: F.coalesce(F.try_element_at("params", F.lit(name)), F.lit("null"))
    version, date, time, *others = [part(name) for name in _FIREWALL]
    rebuilt = F.concat_ws(",", version, F.concat(date, F.lit(" "), time), *others, raw)
    firewall = raw.isNotNull() & F.map_contains_key("params", "firewallVersion")
    return F.when(F.startswith(raw, F.lit("BOM")), _unmarked(raw)).when(firewall, rebuilt).otherwise(raw)


def to_messages(df: DataFrame, ref_time: Column | None = None) -> DataFrame:
    """Add the message columns that the ``params`` map holds.

    ``facility`` is null where the code lies beyond the table; ``split_rejects`` sets
    those rows apart. ``event_time`` is added when a reference time is given.
    """
    read = {f"_{name}": dashed(F.try_element_at("params", F.lit(name))) for name in _FIELDS}
    text = lambda name: _unmarked(F.col(f"_{name}"))
    if ref_time is not None:
        read |= {f"_{name}": F.try_element_at("params", F.lit(name)) for name in TIME_FIELDS}
    out = compute_once(df, read)
    out = compute_once(out, {"_code": to_int(F.coalesce(text("facilityCode"), F.lit("99")))})
    fields = {
        "facility": facility_of(F.col("_code")),
        "severity": severity_of(F.col("_code")),
        "message_id": text("messageId"),
        "hostname": text("hostname"),
        "process_name": text("processName"),
        "process_id": to_int(text("processId")),
        "version": to_int(text("version")),
        "message": _message(F.col("_message")),
    }
    if ref_time is not None:
        fields["event_time"] = event_time_of({name: F.col(f"_{name}") for name in TIME_FIELDS}, ref_time)
    return compute_once(out, fields).drop("_code", *read)
