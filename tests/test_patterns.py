"""What decides whether a pattern matches, one case at a time."""

import pytest
from pyspark.sql import functions as F

from eventloom.functions.patterns import compile_pattern, compile_patterns
from eventloom.operators.extract import extract_fields, to_messages
from eventloom.operators.rules import split_rejects
from eventloom.sources.config import parse_patterns


def fields(spark, pattern, text, strict=False):
    df = spark.createDataFrame([(text,)], "raw string")
    row = extract_fields(df, "raw", [pattern], strict).first()
    return row.params if row.pattern_no else None


CASES = [
    # A blank is any run of control characters and blanks, and something must follow.
    ("a %{STRING:m}", "a \t\n x", {"m": "x"}),
    ("a %{STRING:m}", "a  ", None),
    ("a b", "ab", {}),
    # Text up to a blank may be empty; it never backs up.
    ("<%{STRING:x} %{STRING:m}", "< rest", {"x": "", "m": "rest"}),
    ("%{STRING:x}:%{STRING:m}", "a:b:c", {"x": "a", "m": "b:c"}),
    ("%{STRING:x}: %{STRING:m}", "a b\nc: d", {"x": "a b\nc", "m": "d"}),
    # Whole numbers: leading zeros go, signs count before a blank only, too large fails.
    ("<%{INTEGER:n}>%{STRING:m}", "<007>x", {"n": "7", "m": "x"}),
    ("<%{INTEGER:n}>%{STRING:m}", "<-7>x", None),
    ("<%{INTEGER:n}>%{STRING:m}", "<2147483647>x", {"n": "2147483647", "m": "x"}),
    ("<%{INTEGER:n}>%{STRING:m}", "<2147483648>x", None),
    ("<%{INTEGER:n}>%{STRING:m}", "<>x", None),
    ("%{INTEGER:n} %{STRING:m}", "-012 x", {"n": "-12", "m": "x"}),
    ("%{INTEGER:n} %{STRING:m}", "+5 x", {"n": "5", "m": "x"}),
    ("%{INTEGER:n} %{STRING:m}", " x", {"n": "0", "m": "x"}),
    ("%{INTEGER:n} %{STRING:m}", "000 x", {"n": "0", "m": "x"}),
    ("%{INTEGER:n} %{STRING:m}", "5a x", None),
    ("%{INTEGER:n} %{STRING:m}", "-2147483648 x", {"n": "-2147483648", "m": "x"}),
    ("%{INTEGER:n} %{STRING:m}", "99999999999 x", None),
    ("a%{INTEGER:n}", "a12", None),
    ("a%{INTEGER:n}", "a12b", {"n": "12"}),
    # The rest of the line is trimmed, and missing when blank.
    ("a%{STRING:m}", "a  x \n", {"m": "x"}),
    ("a%{STRING:m}", "a  ", {}),
    # Date-like captures take any of the three shapes and nothing else.
    ("%{DATE:d} %{STRING:m}", "2024-01-01 x", {"d": "2024-01-01", "m": "x"}),
    ("%{DATE:d} %{STRING:m}", "10:00:00 x", {"d": "10:00:00", "m": "x"}),
    ("%{TIMESTAMP:d} %{STRING:m}", "2024/01/01T10:00:00.123Z x", {"d": "2024/01/01T10:00:00.123Z", "m": "x"}),
    ("%{TIMESTAMP_ISO8601:d} %{STRING:m}", "10:00 x", None),
    # Before another character a date-like capture takes no part but eats that character.
    ("%{DATE:d}:%{STRING:m}", "x", {"m": "x"}),
    ("%{FIREWALLTIMPESTAMP:t} %{STRING:m}", "10:00:00: x", {"t": "10:00:00", "m": "x"}),
    ("%{FIREWALLTIMPESTAMP:t} %{STRING:m}", "noon: x", {"t": "noon:", "m": "x"}),
    # A name captured twice keeps the last value.
    ("%{STRING:a}]%{STRING:a}]%{STRING:m}", "x]y]z", {"a": "y", "m": "z"}),
    # A pattern need not reach the end of the line.
    ("%{STRING:a}]", "x] more", {"a": "x"}),
    ("h [%{INTEGER:pid}]: %{STRING:m}", "h [12]: x", {"pid": "12", "m": "x"}),
    ("p[%{INTEGER:pid}]: %{STRING:m}", "p[12]: x", {"pid": "12", "m": "x"}),
    (r"a\%b%{STRING:m}", "a%bc", {"m": "c"}),
    # The mark that separates groups inside may stand in a line too.
    ("%{STRING:a}:%{STRING:b}:%{STRING:m}", "x\x01y:z:\x01w", {"a": "x\x01y", "b": "z", "m": "w"}),
]


@pytest.mark.parametrize("pattern,text,want", CASES)
def test_pattern(spark, pattern, text, want):
    assert fields(spark, pattern, text) == want


def test_strict_bracket(spark):
    assert fields(spark, "h [%{INTEGER:pid}]: %{STRING:m}", "h [12]: x", strict=True) is None
    assert fields(spark, "h [%{INTEGER:pid}]: %{STRING:m}", "h 12]: x", strict=True) == {"pid": "12", "m": "x"}
    assert fields(spark, "h [%{STRING:s}] %{STRING:m}", "h [a=b] x", strict=True) == {"s": "[a=b", "m": "x"}
    assert fields(spark, "p%{STRING:n}[%{INTEGER:pid}]: %{STRING:m}", "pq[12]: x", strict=True) == {
        "n": "q", "pid": "12", "m": "x"}


def test_bad_patterns():
    with pytest.raises(ValueError):
        compile_pattern("%{MONTH:m} x")
    with pytest.raises(ValueError):
        compile_pattern("%{WORD:m} x")
    with pytest.raises(ValueError):
        compile_pattern("a %b")


def test_first_pattern_wins_and_repeats_go(spark):
    patterns = ["<%{INTEGER:n}>%{STRING:m}", "%{STRING:m}", "<%{INTEGER:n}>%{STRING:m}"]
    assert len(compile_patterns(patterns)) == 2
    df = spark.createDataFrame([("<1>a",), ("b",), ("",)], "raw string")
    rows = extract_fields(df, "raw", patterns).collect()
    assert [(r.pattern_no, r.params) for r in rows] == [(1, {"n": "1", "m": "a"}), (2, {"m": "b"}), (2, {})]


def test_pattern_file():
    text = "# c\nA=<%{INTEGER:n}>%{STRING:m}\n\nB = x %{STRING:m}\nC=<%{INTEGER:n}>%{STRING:m}\n! d\n"
    assert parse_patterns(text) == [("A", "<%{INTEGER:n}>%{STRING:m}"), ("B", "x %{STRING:m}")]


def test_damaged_pattern_loads():
    text = "<%{INTEGER:n}>%{STRING:m}INTEGER:n}>%{STRING:rest %{INTEGER:day}:%{STRING:m}"
    assert compile_pattern(text).regex


def test_message_defaults_and_marks(spark):
    df = spark.createDataFrame([
        ({"facilityCode": "34", "message": "BOMhi BOM", "processId": "x", "hostname": "-"},),
        ({"message": "-"},), ({"facilityCode": "99", "message": "m"},), ({"facilityCode": "200", "message": "m"},),
        ({"facilityCode": "bad", "message": "m", "version": "1"},),
    ], "params map<string,string>")
    rows = to_messages(df).collect()
    assert (rows[0].facility, rows[0].severity, rows[0].message, rows[0].process_id, rows[0].hostname) == (
        "auth", "Critical", "hi BOM", 0, None)
    assert (rows[1].facility, rows[1].severity, rows[1].message) == ("unknown", "Unknown", None)
    assert (rows[2].facility, rows[2].severity) == ("unknown", "Unknown")
    assert rows[3].facility is None
    assert (rows[4].facility, rows[4].severity, rows[4].version) == ("kernel", "Emergency", 1)


def test_rejects(spark):
    df = spark.createDataFrame([("a",), ("a\n",), ("a\nb",), (None,), ("",)], "raw string")
    good, bad = split_rejects(df)
    assert [r.raw for r in good.collect()] == ["a", "a\n", ""]
    assert [(r.raw, r.reject_reason) for r in bad.collect()] == [("a\nb", "interior_newline"), (None, "null_record")]


def test_sample_line(spark):
    pattern = "<%{INTEGER:facilityCode}>%{STRING:messageId}; %{STRING:hostname} %{DATE:date} %{STRING:processName}: %{STRING:message}"
    df = spark.createDataFrame([("<30>door; gate7 2021-03-09 lock%a: latch open, 2 of 3",)], "raw string")
    row = to_messages(extract_fields(df, "raw", [pattern]), F.lit("2020-01-01").cast("timestamp")).first()
    assert (row.facility, row.severity, row.message_id, row.hostname, row.process_name, row.message) == (
        "system", "Informational", "door", "gate7", "lock%a", "latch open, 2 of 3")
    assert str(row.event_time) == "2021-03-09 00:00:00"
