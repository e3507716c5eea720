"""Fixed line formats, by name, and the canonical rendering of a message."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.columns import bind, capture_all, dashed, group, to_int, trim_control
from ..functions.priority import facility_of, priority_number, severity_of
from ..functions.times import (
    format_bsd_time, format_rfc3339, parse_iso_time, parse_line_date,
)
from .joins import compute_once

Format = Callable[..., "dict[str, Column] | Column"]
_FORMATS: dict[str, Format] = {}

# Fields of a parsed line and their types. Formats leave out what they do not carry.
LINE_FIELDS = {
    "facility": "string", "severity": "string", "version": "int", "date": "timestamp",
    "hostname": "string", "process_name": "string", "process_id": "int",
    "message_id": "string", "message": "string", "matched_message": "string",
}


def register_format(name: str, fn: Format) -> None:
    """Register ``fn(text, ref_time, **options)`` -> columns by field name, with ``parsed``."""
    _FORMATS[name] = fn


def parse_lines(
    df: DataFrame, col: str, fmt: str, ref_time: Column | None = None, **options
) -> DataFrame:
    """Add the fields of a line format and ``parsed``; unknown names read as ``custom``."""
    ref = F.current_timestamp() if ref_time is None else ref_time
    fields = _FORMATS.get(fmt, _FORMATS["custom"])(F.col(col), ref, **options)
    out = compute_once(df, {"_line": line_struct(fields) if isinstance(fields, dict) else fields})
    parsed = F.coalesce(F.col("_line.parsed"), F.lit(False))
    return out.withColumns({
        **{name: F.when(parsed, F.col(f"_line.{name}")) for name in LINE_FIELDS}, "parsed": parsed,
    }).drop("_line")


def line_struct(fields: dict[str, Column]) -> Column:
    shaped = [fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in LINE_FIELDS.items()]
    return F.struct(*shaped, fields["parsed"].alias("parsed"))


def _read(text: Column, regex: str, count: int, build: Callable[[Callable[[int], Column]], dict[str, Column]]) -> Column:
    """Run the regex once and build the fields from its groups."""
    return bind(capture_all(text, regex, count), lambda g: line_struct({
        **build(lambda i: F.get(g, F.lit(i - 1))), "parsed": F.size(g) == count,
    }))


def _priority(code: Column) -> dict[str, Column]:
    return {"facility": facility_of(code), "severity": severity_of(code)}


def _number(text: Column) -> Column:
    return to_int(text, default=None)


def _rfc5424(text: Column, ref_time: Column, **_) -> Column:
    return _read(text, fixed.RFC5424_LINE, 9, lambda part: {
        **_priority(_number(part(1))),
        "version": _number(part(2)),
        "date": parse_iso_time(part(3)),
        "hostname": dashed(part(4)),
        "process_name": dashed(part(5)),
        "process_id": _number(part(6)),
        "message_id": dashed(part(7)),
        "message": F.when(part(9) != "", trim_control(part(9))),
    })


def _syslogng(text: Column, ref_time: Column, **_) -> Column:
    return _read(text, fixed.SYSLOGNG_LINE, 7, lambda part: {
        **_priority(_number(part(1))),
        "message_id": F.nullif(part(2), F.lit("")),
        "date": F.coalesce(parse_line_date(part(3), ref_time), ref_time),
        "hostname": part(4),
        "process_name": F.nullif(part(5), F.lit("")),
        "process_id": _number(part(6)),
        "message": trim_control(part(7)),
    })


def _juniper(text: Column, ref_time: Column, fallback: bool = False, **options) -> Column:
    """With ``fallback`` a line of another shape is read by the custom format."""
    own = _read(text, fixed.JUNIPER_LINE, 6, lambda part: {
        **_priority(_number(part(1))),
        "date": F.coalesce(parse_line_date(part(2), ref_time), ref_time),
        "hostname": part(3),
        "process_name": part(4),
        "process_id": _number(part(5)),
        "message": trim_control(part(6)),
    })
    if not fallback:
        return own
    other = _custom(text, ref_time, **options)
    return bind(own, lambda line: F.when(line["parsed"], line).otherwise(other))


def _custom(
    text: Column, ref_time: Column, forwarding_regex: str = "", host_group: int = 1, msg_group: int = 2, **_
) -> Column:
    """A priority, an optional ``id:``, an optional date, then the caller's own regex."""
    if not forwarding_regex:
        raise ValueError("the custom format needs a forwarding_regex")
    whole = rf"(?m)\A(?:{forwarding_regex})\z"

    def head(line: Column) -> Column:
        left, right = F.instr(line, "<"), F.instr(line, ">")
        return F.struct(
            ((left > 0) & (right > 0) & (left < right - 1)).alias("framed"),
            F.substr(line, left + 1, right - left - 1).alias("code"), F.substr(line, right + 1).alias("body"),
        )

    def with_id(h: Column) -> Column:
        lead = group(h["body"], fixed.CUSTOM_MESSAGE_ID, 1)
        # The blank before the rest of the line stays, so the id is cut one character short.
        return bind(lead, lambda text: F.struct(
            h["framed"].alias("framed"), h["code"].alias("code"),
            F.when(text != "", F.substr(h["body"], F.length(text))).otherwise(h["body"]).alias("body"),
            F.when(text != "", group(h["body"], fixed.CUSTOM_MESSAGE_ID, 2)).alias("message_id"),
        ))

    def with_date(h: Column) -> Column:
        old, iso = group(h["body"], fixed.CUSTOM_OLD_DATE, 1), group(h["body"], fixed.CUSTOM_ISO_DATE, 2)
        return bind(F.struct(old.alias("old"), iso.alias("iso")), lambda d: F.struct(
            h["framed"].alias("framed"), h["code"].alias("code"), h["message_id"].alias("message_id"),
            F.when(d["old"] != "", F.regexp_replace(h["body"], fixed.CUSTOM_OLD_DATE, "")).otherwise(h["body"]).alias("body"),
            F.when(d["old"] != "", parse_line_date(d["old"], ref_time))
            .when(d["iso"] != "", parse_line_date(d["iso"], ref_time)).otherwise(ref_time).alias("date"),
        ))

    def with_process(h: Column) -> Column:
        fields = F.struct(
            group(h["body"], whole, msg_group).alias("text"), group(h["body"], whole, host_group).alias("host"),
            h["body"].rlike(whole).alias("fits"),
        )
        return bind(fields, lambda m: bind(_process_of(m["text"]), lambda p: line_struct({
            **_priority(to_int(h["code"])),
            "message_id": h["message_id"], "date": h["date"], "hostname": m["host"],
            "process_name": p["name"], "process_id": p["number"], "message": trim_control(p["rest"]),
            "matched_message": m["text"], "parsed": h["framed"] & m["fits"] & p["cuts"],
        })))

    return bind(bind(bind(bind(text, head), with_id), with_date), with_process)


def _process_of(matched: Column) -> Column:
    """``name: rest`` or ``name[number]: rest``, told by where the first marks stand."""
    open_at, close_at = F.instr(matched, "["), F.instr(matched, "]")
    colon, blank = F.instr(matched, ":"), F.instr(matched, " ")
    marks = F.struct(open_at.alias("open"), close_at.alias("close"), colon.alias("colon"), blank.alias("blank"))

    def cut(at: Column) -> Column:
        plain = (at["open"] == 0) & (at["close"] == 0) & (at["colon"] > 1) & (at["blank"] == at["colon"] + 1)
        numbered = (
            ~plain & (at["open"] < at["close"] - 1) & (at["colon"] == at["close"] + 1) & (at["blank"] == at["colon"] + 1)
        )
        return F.struct(
            F.when(plain, F.substr(matched, F.lit(1), at["colon"] - 1))
            .when(numbered, F.substr(matched, F.lit(1), at["open"] - 1)).otherwise(F.lit("")).alias("name"),
            F.when(numbered, to_int(F.substr(matched, at["open"] + 1, at["close"] - at["open"] - 1)))
            .otherwise(F.lit(0)).alias("number"),
            F.when(plain | numbered, F.substr(matched, at["colon"] + 2)).otherwise(matched).alias("rest"),
            # A closing bracket without an opening one has no name to cut out.
            (~(numbered & (at["open"] == 0))).alias("cuts"),
        )

    return bind(marks, cut)


register_format("rfc5424", _rfc5424)
register_format("syslogng", _syslogng)
register_format("juniper", _juniper)
register_format("custom", _custom)


def full_text_column(date_style: str = "bsd", date: str = "date") -> Column:
    render = {"bsd": format_bsd_time, "rfc3339": format_rfc3339}[date_style]
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    head = F.concat(
        F.lit("<"), priority_number(F.col("facility"), F.col("severity")).cast("string"), F.lit(">"),
        shown(render(F.col(date))), F.lit(" "), shown(F.col("hostname")), F.lit(" "),
    )
    process, pid, message = F.col("process_name"), F.col("process_id"), shown(F.col("message"))
    return F.when(
        process.isNotNull() & pid.isNotNull(),
        F.concat(head, process, F.lit("["), pid.cast("string"), F.lit("]: "), message),
    ).when(process.isNotNull(), F.concat(head, process, F.lit(": "), message)).otherwise(
        F.concat(head, message)
    )


def full_text(df: DataFrame, date_style: str = "bsd", date: str = "date") -> DataFrame:
    """Add the canonical ``<pri>date host process[pid]: message`` text."""
    return df.withColumn("full_text", full_text_column(date_style, date))
