"""Small cases, and brute force where a shortcut is taken."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.functions.columns import split_extract
from eventloom.functions.times import parse_bsd_time, parse_event_time, parse_iso_time
from eventloom.operators.batch import batch_by_source, cap_per_connection, number_rows, sort_events
from eventloom.operators.events import persistable
from eventloom.operators.expand import expand_event, fill_from_definition
from eventloom.operators.formats import parse_lines
from eventloom.operators.joins import compute_once, lookup_join
from eventloom.operators.lookup import match_masks
from eventloom.operators.route import effective_subscriptions, name_keys, route, route_as_of, subscription_intervals
from eventloom.operators.rules import Rule, mark_hidden, match_rules
from eventloom.plans.catalog.expansion import defined_events
from eventloom.schema import as_events


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def brute_split(src, sep, offset, ranged, length):
    if src.startswith(sep):
        src = src[len(sep):]
    parts = src.split(sep)
    if len(parts) > 1:
        while parts and parts[-1] == "":
            parts.pop()
    if offset == 0 or abs(offset) > len(parts):
        return None
    start = len(parts) + offset if offset < 0 else offset - 1
    if not ranged:
        return parts[start]
    end = len(parts) if length == 0 else start + 2 + length if length < 0 else start + length
    return sep.join(parts[start:max(start, end)])


def test_split_extract_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        sep = rng.choice([".", "::", "|", "+"])
        text = sep.join(rng.choice(["", "a", "bc", "1"]) for _ in range(rng.randint(1, 5)))
        rows.append((text, sep, rng.randint(-5, 5), rng.random() < 0.7, rng.randint(-3, 3)))
    df = spark.createDataFrame(rows, "t string, s string, o int, r boolean, l int")
    got = df.select("*", split_extract(F.col("t"), F.col("s"), F.col("o"), F.col("r"), F.col("l")).alias("v")).collect()
    for r in got:
        assert r.v == brute_split(r.t, r.s, r.o, r.r, r.l), r


def test_bsd_time(spark):
    ref = F.lit("2024-06-15 00:00:00").cast("timestamp")
    shown = lambda t: str(one(spark, parse_bsd_time(F.lit(t), ref)))
    assert shown("JAN 1 24:00:00") == "2024-01-02 00:00:00"
    assert shown("Feb  30  1:2:3") == "2024-03-01 01:02:03"
    for bad in ("Foo 1 1:1:1", "Jan 32 1:1:1", "Jan 0 1:1:1", "Jan 1 25:0:0", "Jan 1 1:60:0", "Jan 1 1:1", "Jan 1"):
        assert shown(bad) == "None", bad


def test_iso_time(spark):
    shown = lambda t: str(one(spark, parse_iso_time(F.lit(t))))
    assert shown("2024-01-01T10:00:00+02:00") == "2024-01-01 08:00:00"
    assert shown("2024-01-01T10:00:00.5-0130") == "2024-01-01 11:30:00.500000"
    assert shown("2024-13-01T10:00:00Z") == "None"
    assert shown("yesterday") == "None"


def test_event_time_falls_back(spark):
    ref = F.lit("2024-06-15 12:30:00").cast("timestamp")
    time = lambda **p: str(one(spark, parse_event_time(F.create_map(*[F.lit(x) for kv in p.items() for x in kv]), ref)))
    assert time(month="Feb", day="31", timestamp="10:00:00") == "2024-06-15 12:30:00"
    assert time(month="Feb", day="3", timestamp="10:00:00.123") == "2024-02-03 10:00:00.123000"
    assert time(timestamp="10:00:01") == "2024-06-15 10:00:01"
    assert time(date="2024/02/03", timestamp="25:00:00") == "2024-06-15 12:30:00"
    assert time(date="2024/02/03", timestamp="10:00:00.75junk") == "2024-06-15 12:30:00"
    assert time(month="Marble", day="3", timestamp="10:00:00") == "2024-06-15 12:30:00"
    assert time(month="MARCH", day="3", timestamp="10:00:00") == "2024-03-03 10:00:00"
    assert time(timestamp="2024-02-03T10:00:00.25Z") == "2024-02-03 10:00:00.250000"
    assert time(date="2023-01-02", timestamp="2024/02/03T10:00:00Z") == "2023-01-02 10:00:00"


def test_custom_format_edges(spark):
    rows = ["<34>Oct 11 22:14:15 host su[12]: hi ", "<x>2024-01-01 host plain", "no priority", "<>2024-01-01 h m",
            "<34>2024-01-01 host x]: odd", "<34>2024-01-01 host a:b c", "<34>id:2024-01-01 host p: m"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, raw string")
    out = parse_lines(df, "raw", "custom", F.lit("2024-06-01").cast("timestamp"),
                      forwarding_regex=r":?\s*(?:\d{4}-\d{2}-\d{2}\s+)?(\S+)\s(.*)").orderBy("i").collect()
    assert [r.parsed for r in out] == [True, True, False, False, False, True, True]
    assert (out[0].process_name, out[0].process_id, out[0].message, str(out[0].date)) == ("su", 12, "hi", "2024-10-11 22:14:15")
    assert (out[1].facility, out[1].message) == ("kernel", "plain")
    assert (out[5].process_name, out[5].message) == ("", "a:b c")
    assert (out[6].message_id, out[6].process_name, out[6].message) == ("id", "p", "m")


def test_line_formats_in_text_of_many_lines(spark):
    df = spark.createDataFrame([("junk\n<13>Jan 02 03:04:05 h p[7]: hi",), ("junk",)], "raw string")
    rows = parse_lines(df, "raw", "juniper", F.lit("2024-06-01").cast("timestamp")).collect()
    assert (rows[0].parsed, rows[0].hostname, rows[0].process_id, rows[0].message) == (True, "h", 7, "hi")
    assert rows[1].parsed is False and rows[1].hostname is None


def test_juniper_fallback(spark):
    df = spark.createDataFrame([("<13>2024-01-01 h p: hi",)], "raw string")
    ref = F.lit("2024-06-01").cast("timestamp")
    assert not parse_lines(df, "raw", "juniper", ref).first().parsed
    row = parse_lines(df, "raw", "juniper", ref, fallback=True,
                      forwarding_regex=r"(?:\d{4}-\d{2}-\d{2}\s+)?(\S+)\s(.*)").first()
    assert (row.parsed, row.hostname, row.process_name, row.message) == (True, "h", "p", "hi")


def test_numbering_matches_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("aaab"), None if rng.random() < 0.1 else rng.randint(0, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, k string, sec int").withColumn("ts", F.timestamp_seconds("sec"))
    got = {r.id: r.rn for r in number_rows(df, ["k"], "ts", ["id"], slice_seconds=7).collect()}
    want = {}
    for key in "ab":
        own = sorted((r for r in rows if r[1] == key), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        want |= {r[0]: i for i, r in enumerate(own, start=1)}
    assert got == want


def test_caps_agree(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("c"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"))
    small = cap_per_connection(df, 10, ("c",)).count()
    large = cap_per_connection(df, 1001, ("c",), slice_seconds=60).count()
    assert (small, large, cap_per_connection(df, -1, ("c",)).count()) == (30, 3000, 3000)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        assert {r.seq for r in cap_per_connection(df, 10, ("c",), slice_seconds=60).collect()} == set(range(30))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_batches_keep_everything(spark):
    df = spark.range(100).select(F.lit("h").alias("source_ip"), F.lit(1).alias("source_port"),
                                 F.timestamp_seconds("id").alias("ts"), F.col("id").alias("event_id"))
    out = batch_by_source(df, 7, payload="event_id", slice_seconds=10).orderBy("batch_no").collect()
    assert [x for r in out for x in r.payloads] == list(range(100))
    assert [r["items"] for r in out] == [7] * 14 + [2]


def test_sort_is_stable_with_nulls_first(spark):
    df = spark.createDataFrame([(1, 5, 0), (1, None, 1), (1, 5, 2), (0, 9, 3)], "log_id int, time int, seq int")
    assert [r.seq for r in sort_events(df).collect()] == [3, 1, 0, 2]


def test_lookup_join_with_salt_agrees(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(0, 1000, 2).select(F.col("id").alias("k"), F.col("id").alias("v"))
    plain = sorted(map(tuple, lookup_join(left, dim, {"k": "k"}).collect()), key=str)
    assert plain == sorted(map(tuple, lookup_join(left, dim, {"k": "k"}, salts=5, spread=["id"]).collect()), key=str)


def test_compute_once_is_not_pushed_down(spark):
    df = compute_once(spark.range(10), {"x": F.expr("regexp_replace(cast(id as string), '1', '2')")}).filter("x = '2'")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert [r.id for r in df.collect()] == [1, 2]


def test_masks_agree(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "ab", None]), rng.choice(["x", "y", "xy"]), rng.randint(0, 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, p string, q string, r int")
    masks = [(1, "p", "a%"), (1, "q", "x"), (2, "q", "~x.*"), (2, "r", "1"), (2, "r", "2"), (3, "q", "y"), (4, "p", "ab")]
    elements = {"p": F.col("p"), "q": F.col("q"), "r": F.col("r")}
    table = spark.createDataFrame(masks, "def_no int, element string, val string")
    a = {r.id: r.def_no for r in match_masks(df, table, elements).collect()}
    b = {r.id: r.def_no for r in match_masks(df, masks, elements, "q").collect()}
    assert a == b and set(a.values()) == {None, 1, 2, 3, 4}


def test_name_keys(spark):
    def walk(uei):
        keys = ["*"]
        while uei:
            keys.append("=" + uei)
            i = uei.rfind("/", 0, len(uei) - 1)
            if i <= 0:
                break
            uei = uei[:i + 1]
        return set(keys)

    for uei in ("a/b/c", "a/b/", "/a/b", "//a", "a", "/", "a//b", "", "uei.x/y/z/e"):
        assert set(one(spark, name_keys(F.lit(uei)))) == walk(uei), uei
    assert one(spark, name_keys(F.lit(None).cast("string"))) == ["*"]


def test_route_without_names(spark):
    subs = spark.createDataFrame([("all", None), ("one", "u/")], "listener string, uei string")
    events = spark.createDataFrame([(1, "u/a"), (2, None), (3, "v")], "id int, uei string")
    assert sorted((r.id, r.listener) for r in route(events, subs).collect()) == [(1, "all"), (1, "one"), (2, "all"), (3, "all")]


def test_subscription_changes(spark):
    rows = [(1, "l", "add", ["a", "b"]), (2, "l", "add", []), (3, "l", "remove", ["a"]), (4, "m", "add_all", None),
            (5, "m", "add", ["c"]), (6, "n", "add", ["d"]), (7, "n", "add_all", None), (8, "o", "add", ["e"]),
            (9, "o", "remove_all", None), (10, "o", "add", ["f"]), (11, "p", "add_all", None), (12, "p", "remove", ["x"])]
    df = spark.createDataFrame(rows, "seq int, listener string, op string, ueis array<string>")
    assert sorted((r.listener, r.uei or "*") for r in effective_subscriptions(df).collect()) == [
        ("l", "b"), ("m", "c"), ("n", "*"), ("o", "f"), ("p", "*")]


def test_persistable_needs_a_log_message(spark):
    df = as_events(spark.range(1).select(F.lit("u").alias("uei")))
    with pytest.raises(Exception, match="logmsg"):
        persistable(df).collect()


def test_secured_fields(spark, sf):
    events = defined_events(spark, sf).filter("event_id % 3 = 0 and event_type = 'view'")
    kept = fill_from_definition(events).first()
    secured = fill_from_definition(events, ("descr", "severity", "loggroup")).first()
    assert kept.severity == "Minor" and secured.severity == "Warning"
    assert secured.descr == "100%% sure %"
    with pytest.raises(ValueError):
        fill_from_definition(events, ("uei",))


def test_parms_expand_in_order(spark):
    parms = [("a", "%parm[b]%", True), ("b", "%uei%", True), ("c", "%parm[b]%", True), ("d", "%uei%", False)]
    df = as_events(spark.createDataFrame([("n", parms)], "uei string, p array<struct<name:string,value:string,expand:boolean>>").select(
        "uei", F.transform("p", lambda p: F.struct(
            p["name"], p["value"], F.lit("string").alias("type"), F.lit("text").alias("encoding"), p["expand"])).alias("parms")))
    got = [p["value"] for p in expand_event(df).first().parms]
    assert got == ["%uei%", "n", "n", "%uei%"]


def test_rules_skip_null_message_only_when_looked_at(spark):
    df = spark.createDataFrame([("mail", None), ("auth", None)], "facility string, message string").withColumns({
        c: F.lit(None).cast("string") for c in ("severity", "process_name", "hostname", "host_address")})
    out = match_rules(df, [Rule(1, "substr", "x", "u", facilities=("mail",))])
    assert [r.facility for r in out.collect()] == ["auth"]


def test_regex_over_lines_and_unmatched_groups(spark):
    df = spark.createDataFrame([("one\ntwo b",)], "message string").withColumns({
        c: F.lit(None).cast("string") for c in ("facility", "severity", "process_name", "hostname", "host_address")})
    row = match_rules(df, [Rule(1, "regex", "^two (a)?(b)$", "u")]).first()
    assert [(p["name"], p["value"]) for p in row.rule_parms] == [("group1", ""), ("group2", "b")]


def test_hide_can_replace(spark):
    df = spark.createDataFrame([("my secret",), ("fine",)], "full_text string").withColumn("message", F.col("full_text"))
    rows = mark_hidden(df, [("regex", "[Ss]ecret"), ("regex", "(")], apply="message").collect()
    assert [r.hidden for r in rows] == [True, False]
    assert "secret" not in rows[0].message and rows[1].message == "fine"


def test_numbers_of_a_hot_slice(spark):
    """All rows of a key at one time, with nulls and ties in the order, in many parts; other keys beside it."""
    rows = [("hot", None if k % 50 == 0 else k // 2, k) for k in range(3000)] + [("cold", 5, 1), (None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "key string, place int, tie int").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    got = {(r.key, r.place, r.tie): r.rn for r in number_rows(df, ["key"], "ts", ["place", "tie"], slice_rows=64).collect()}
    hot = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (-1 if r[1] is None else r[1], r[2]))
    assert [got[r] for r in hot] == list(range(1, 3001))
    assert (got["cold", 5, 1], got[None, 1, 1], got[None, 2, 2]) == (1, 1, 2)


def test_cap_over_slices(spark):
    rows = [("a", 3600 * (k // 2), k) for k in range(9)] + [(None, None, k) for k in range(4)]
    df = spark.createDataFrame(rows, "connection string, s int, seq int").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r.seq for r in cap_per_connection(df, 3).filter("connection = 'a'").collect()) == [0, 1, 2]
    assert sorted(r.seq for r in cap_per_connection(df, 3).filter("connection is null").collect()) == [0, 1, 2]
    assert cap_per_connection(df, 0).count() == 0 and cap_per_connection(df, -1).count() == 13


def test_routing_as_of(spark):
    """Directories, names added again, everything switched on and off, and events at the changes themselves."""
    changes = spark.createDataFrame([
        (1, "a", "add", ["x/"]), (3, "a", "add", ["x/"]), (5, "a", "remove", ["x/"]), (7, "a", "add_all", None), (9, "a", "add", ["y"]),
        (2, "b", "add_all", None), (4, "b", "add", []), (6, "b", "remove_all", None), (8, "b", "add", ["x/1", "x/"]),
    ], "seq long, listener string, op string, ueis array<string>")
    events = spark.createDataFrame([(k, u) for k in range(12) for u in ("x/1", "y", None)] + [(None, "y")], "seq long, uei string")
    got = {}
    for width in (2, 5, 100):
        rows = route_as_of(events, subscription_intervals(changes), width).collect()
        assert len({(r.seq, r.uei, r.listener) for r in rows}) == len(rows)
        got[width] = {(r.seq, r.uei, r.listener) for r in rows}
    want = {(k, "x/1", "a") for k in (1, 2, 3, 4, 7, 8)} | {(k, u, "a") for k in (7, 8) for u in ("y", None)} | {(k, "y", "a") for k in (9, 10, 11)}
    want |= {(k, u, "b") for k in (2, 3, 4, 5) for u in ("x/1", "y", None)} | {(k, "x/1", "b") for k in (8, 9, 10, 11)}
    assert got[2] == got[5] == got[100] == want


def test_a_thousand_rules(spark):
    """A list of the full size, each rule with a condition of its own: planned without a deep chain, first match wins."""
    rules = [Rule(k, "regex", f"user {k} did ([a-z]+)", f"u/{k}", facilities=("local0", f"f{k}")) for k in range(1, 1001)]
    rows = [(1, "user 7 did view", "local0"), (2, "user 1000 did sign", "f1000"), (3, "user 5 did view", "f6"), (4, "none", "local0")]
    df = spark.createDataFrame(rows, "id int, message string, facility string").withColumns({
        c: F.lit(None).cast("string") for c in ("severity", "process_name", "hostname", "host_address")})
    got = {r.id: (r.rule_no, r.uei, [p.value for p in r.rule_parms]) for r in match_rules(df, rules).collect()}
    assert got == {1: (7, "u/7", ["view"]), 2: (1000, "u/1000", ["sign"]), 3: (None, None, []), 4: (None, None, [])}
