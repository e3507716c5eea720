"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_CONTROL = "".join(chr(i) for i in range(0x21))
PARM_TYPE = "array<struct<name:string,value:string,type:string,encoding:string,expand:boolean>>"


def trim_control(col: Column) -> Column:
    """Trim every leading and trailing character up to and including the blank."""
    return F.btrim(col, F.lit(_CONTROL))


def to_int(col: Column, default: int | None = 0) -> Column:
    """Text to a 32-bit int; what is not a plain signed number becomes ``default``."""
    value = F.when(col.rlike(r"^[+-]?[0-9]+$"), col.try_cast("int"))
    return value if default is None else F.coalesce(value, F.lit(default))


def group(col: Column, regex: str, number: int) -> Column:
    """A capture group; a group that took no part reads as the empty text."""
    return F.regexp_extract(col, regex, number)


MARK = "\x01"


def capture_all(text: Column, regex: str, count: int) -> Column:
    """All groups of a whole-line regex in one run; an empty array where it does not match.

    The groups are written side by side and split again. Text that holds the mark between
    them, or more than one line, is read group by group instead.
    """
    one_by_one = F.when(text.rlike(regex), F.array(*[F.regexp_extract(text, regex, i) for i in range(1, count + 1)]))
    joined = F.regexp_replace(text, regex, MARK.join(f"${i}" for i in range(1, count + 1)))
    groups = F.when(text.rlike("[\x01\n\r\u0085\u2028\u2029]"), one_by_one).otherwise(F.split(joined, MARK, -1))
    none = F.array().cast("array<string>")
    return bind(F.coalesce(groups, none), lambda g: F.when(F.size(g) == count, g).otherwise(none))


def dashed(col: Column) -> Column:
    """``-`` stands for a missing value."""
    return F.nullif(col, F.lit("-"))


def parm(name: str | Column, value: Column, expand: bool = False) -> Column:
    """One entry of the ordered parm list."""
    return F.struct(
        (F.lit(name) if isinstance(name, str) else name).alias("name"),
        value.cast("string").alias("value"),
        F.lit("string").alias("type"),
        F.lit("text").alias("encoding"),
        F.lit(expand).alias("expand"),
    )


def empty_parms() -> Column:
    return F.array().cast(PARM_TYPE)


def parm_value(parms: Column, name: str) -> Column:
    """Value of the first parm of that exact name."""
    return F.try_element_at(F.filter(parms, lambda p: p["name"] == F.lit(name)), F.lit(1))["value"]


def sanitize_html(col: Column) -> Column:
    """Neutralise mark-up in names that come from outside."""
    for raw, safe in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("(", "&#40;"), (")", "&#41;")):
        col = F.replace(col, F.lit(raw), F.lit(safe))
    return col


def escape_delimiter(col: Column, delim: str) -> Column:
    """Write a delimiter inside a value as ``%`` and its decimal code."""
    return F.replace(col, F.lit(delim), F.lit(f"%{ord(delim)}"))


def pretty_parms(parms: Column) -> Column:
    """``name=value`` list for event summaries; a missing part reads ``null``."""
    text = lambda c: F.coalesce(c, F.lit("null"))
    return F.transform(parms, lambda p: F.concat(text(p["name"]), F.lit("="), text(p["value"])))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Compute a value once and use it many times, which keeps nested expressions small."""
    return F.element_at(F.transform(F.array(value), use), 1)


def split_extract(
    text: Column, sep: Column | str, offset: Column | int, ranged: Column | bool = False,
    length: Column | int = 0,
) -> Column:
    """Split by a literal separator and take one part or a run of parts.

    One leading separator and all trailing empty parts are ignored. ``offset`` counts
    from 1, or from the end when negative. A run goes to the end (length 0), over
    ``length`` parts, or stops ``-length`` parts early. Runs past the end are clipped.
    """
    sep, offset, ranged, length = (
        c if isinstance(c, Column) else F.lit(c) for c in (sep, offset, ranged, length)
    )
    body = F.when(F.startswith(text, sep), F.substr(text, F.length(sep) + 1)).otherwise(text)
    quoted = F.concat(F.lit(r"\Q"), sep, F.lit(r"\E"))

    def parts_of(raw: Column) -> Column:
        last = F.array_max(F.transform(raw, lambda p, i: F.when(p != "", i + 1)))
        return F.when(F.size(raw) == 1, raw).otherwise(F.slice(raw, 1, F.coalesce(last, F.lit(0))))

    def pick(parts: Column) -> Column:
        n = F.size(parts)
        start = F.when(offset < 0, n + offset + 1).otherwise(offset)
        take = (
            F.when(~ranged, F.lit(1))
            .when(length == 0, n - start + 1)
            .when(length < 0, F.lit(2) + length)
            .otherwise(length)
        )
        run = F.slice(parts, start, F.greatest(take, F.lit(0)))
        return F.when((offset != 0) & (F.abs(offset) <= n), F.call_function("array_join", run, sep))

    return bind(F.split(body, quoted, -1), lambda raw: bind(parts_of(raw), pick))
