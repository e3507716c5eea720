"""Extraction patterns: ``%{TYPE:name}`` text compiled once, on the driver, to one Java regex.

A scan never backs up, so captures are possessive. A blank in a pattern stands for any
run of control characters and blanks, and something else must follow it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import MARK, trim_control
from .fixed import DATE_SHAPE, DATETIME_SHAPE, TIME_SHAPE

_BLANK = r"[\x00-\x20]"
_SOLID = r"[^\x00-\x20]"
_GAP = f"{_BLANK}*+(?={_SOLID})"
_DATE_TYPES = {"DATE", "TIMESTAMP", "TIMESTAMP_ISO8601"}
_TYPES = _DATE_TYPES | {"STRING", "INTEGER", "FIREWALLTIMPESTAMP"}
# Digits up to 2147483647, written so that a larger number does not match.
_MAGNITUDE = (
    r"(?:[0-9]{1,9}|1[0-9]{9}|20[0-9]{8}|21[0-3][0-9]{7}|214[0-6][0-9]{6}|2147[0-3][0-9]{5}"
    r"|21474[0-7][0-9]{4}|214748[0-2][0-9]{3}|2147483[0-5][0-9]{2}|21474836[0-3][0-9]|214748364[0-7])"
)
_SIGNED = rf"0*(?:[+-]?0*{_MAGNITUDE}|-0*2147483648)?(?={_BLANK})"
_UNSIGNED = rf"(?=[0-9])0*{_MAGNITUDE}?(?![0-9])"
_DATE_TOKEN = (
    f"(?:{DATETIME_SHAPE.replace('.(?', _SOLID + '(?')}|{DATE_SHAPE}|{TIME_SHAPE})(?={_BLANK})"
)


@dataclass(frozen=True)
class Capture:
    name: str
    kind: str
    at_end: bool


@dataclass(frozen=True)
class Pattern:
    """A compiled pattern: the regex and what each group means."""

    text: str
    regex: str
    captures: tuple[Capture, ...]

    def matches(self, col: Column) -> Column:
        return col.rlike(self.regex)

    def groups(self, col: Column) -> Column:
        """Array of the captured texts.

        One run of the regex writes all groups side by side; a line that holds the mark
        between them is read group by group instead.
        """
        if not self.captures:
            return F.array().cast("array<string>")
        numbers = range(1, len(self.captures) + 1)
        rest = "" if self.captures[-1].at_end else r"(?s:.*)"
        joined = F.regexp_replace(col, self.regex + rest, MARK.join(f"${i}" for i in numbers))
        one_by_one = F.array(*[F.regexp_extract(col, self.regex, i) for i in numbers])
        return F.when(F.contains(col, F.lit(MARK)), one_by_one).otherwise(F.split(joined, MARK, -1))

    def fields(self, groups: Column) -> Column:
        """Map of field name to value; of fields captured twice the last one counts."""
        values: dict[str, list[Column]] = {}
        for i, capture in enumerate(self.captures):
            values.setdefault(capture.name, []).insert(0, _value(groups[i], capture))
        if not values:
            return F.create_map().cast("map<string,string>")
        pairs = [c for name, found in values.items() for c in (F.lit(name), F.coalesce(*found))]
        fields = F.create_map(*pairs)
        # Only a blank rest of the line can be missing, so most maps need no filter.
        return F.map_filter(fields, lambda _, v: v.isNotNull()) if self.captures[-1].at_end else fields


def _value(value: Column, capture: Capture) -> Column:
    if capture.kind == "INTEGER":
        digits = F.ltrim(value, F.lit("0"))
        return F.coalesce(digits.try_cast("int"), F.lit(0)).cast("string")
    if capture.kind == "FIREWALLTIMPESTAMP":
        return F.regexp_replace(value, r"^([0-9:]+)[;:.,?-]$", "$1")
    if capture.at_end:
        return F.nullif(trim_control(value), F.lit(""))
    return value


def _literal(char: str) -> str:
    return char if char.isalnum() else "\\" + char if ord(char) > 0x20 else f"\\x{ord(char):02x}"


def _capture_regex(kind: str, terminator: str | None) -> str | None:
    """Regex of one capture and its terminator; None where the type takes no part."""
    if terminator == " ":
        if kind == "INTEGER":
            return f"({_SIGNED}){_GAP}"
        if kind in _DATE_TYPES:
            return f"({_DATE_TOKEN}){_GAP}"
        return f"({_SOLID}*+){_GAP}"
    if kind == "INTEGER":
        return f"({_UNSIGNED})" + ("(?=[^0-9])" if terminator is None else _literal(terminator))
    if kind == "STRING":
        if terminator is None:
            return "((?s:.*+))"
        stop = terminator if terminator.isalnum() else "\\" + terminator
        return f"([^{stop}]*+){_literal(terminator)}"
    return None


def compile_pattern(text: str, strict: bool = False) -> Pattern:
    """Compile one pattern.

    ``strict`` keeps the historic reading of ``[`` outside a capture: it only opens a
    capture and never stands for itself. The default reads it as a literal.
    """
    opener = r"[%\[]+" if strict else r"%+"
    scanner = re.compile(
        rf"(?P<capture>{opener}\{{(?P<type>[^:]*):(?P<name>[^}}\]]*)[}}\]])"
        rf"|(?P<open>{opener})|(?P<gap> )|\\(?P<escaped>.)|(?P<char>.)",
        re.DOTALL,
    )
    regex, captures, pos = [r"\A"], [], 0
    while pos < len(text):
        found = scanner.match(text, pos)
        pos = found.end() if found else len(text)
        if not found:
            break
        if found["capture"]:
            kind, name = found["type"], found["name"]
            if kind == "MONTH":
                raise ValueError("MONTH captures an index that no field uses; write STRING instead")
            if kind not in _TYPES:
                raise ValueError(f"unknown capture type {kind!r} in {text!r}")
            terminator = text[pos] if pos < len(text) else None
            pos += 1
            part = _capture_regex(kind, terminator)
            if part is not None:
                regex.append(part)
                captures.append(Capture(name, kind, terminator is None and kind == "STRING"))
        elif found["open"]:
            if pos >= len(text) or text[pos] == "{":
                break  # a capture left open at the end takes no part
            raise ValueError(f"a capture must open with '{{' in {text!r}")
        elif found["gap"]:
            regex.append(_GAP)
        else:
            regex.append(_literal(found["escaped"] or found["char"]))
    return Pattern(text, "".join(regex), tuple(captures))


def compile_patterns(texts: list[str], strict: bool = False) -> list[Pattern]:
    """Compile in order; a text seen before is left out."""
    return [compile_pattern(t, strict) for t in dict.fromkeys(texts)]
