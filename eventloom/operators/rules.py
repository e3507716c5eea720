"""Reject, match, discard, rewrite and hide by rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import PARM_TYPE, empty_parms, parm, trim_control
from ..functions.fixed import FACILITY_NAMES, SEVERITY_NAMES, UNKNOWN_FACILITY, UNKNOWN_SEVERITY
from .joins import compute_once

# Rules in one generated expression; more are tried block by block.
_BLOCK = 100

# Line ends that a one-line message may hold only as its very last character.
_ONE_LINE = r"\A.*$"


def flag_rejects(df: DataFrame, text: str = "raw") -> DataFrame:
    """Add ``reject_reason``: why a row cannot become an event, or null."""
    reason = F.when(F.col(text).isNull(), "null_record").when(~F.col(text).rlike(_ONE_LINE), "interior_newline")
    if "parsed" in df.columns:
        reason = reason.when(~F.col("parsed"), "not_parsed")
    if "params" in df.columns:
        reason = reason.when(F.size("params") == 0, "no_match")
    if "facility" in df.columns:
        reason = reason.when(F.col("facility").isNull(), "bad_facility")
    return df.withColumn("reject_reason", reason)


def split_rejects(df: DataFrame, text: str = "raw") -> tuple[DataFrame, DataFrame]:
    """The rows that can go on, and the others with their reason."""
    flagged = df if "reject_reason" in df.columns else flag_rejects(df, text)
    good = flagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, flagged.filter(F.col("reject_reason").isNotNull())


@dataclass(frozen=True)
class Rule:
    """A match rule. Empty lists and None stand for "any"."""

    rule_no: int
    match_type: str
    expression: str
    uei: str
    facilities: tuple[str, ...] = ()
    severities: tuple[str, ...] = ()
    process_expr: str | None = None
    hostname_expr: str | None = None
    hostaddr_expr: str | None = None
    default_mapping: bool = True
    assignments: tuple[tuple[int, str], ...] = field(default=())


def _group_counts(df: DataFrame, regexes: list[str]) -> dict[str, int | None]:
    """Capture groups per regex, None for one the JVM rejects. Configuration, read on the driver."""
    pattern = df.sparkSession._jvm.java.util.regex.Pattern
    counts: dict[str, int | None] = {}
    for regex in dict.fromkeys(regexes):
        try:
            counts[regex] = pattern.compile(regex).matcher("").groupCount()
        except Exception:
            counts[regex] = None
    return counts


def _finder(regex: str) -> str:
    return f"(?m){regex}"


def _in_list(col: str, wanted: tuple[str, ...]) -> Column | None:
    return F.lower(col).isin([w.lower() for w in wanted]) if wanted else None


def _find_in(col: str, regex: str | None, good: dict[str, int | None]) -> Column | None:
    if regex is None:
        return None
    if good[regex] is None:
        return F.lit(False)
    return F.coalesce(F.col(col).rlike(_finder(regex)), F.lit(False))


def _all(conditions: list[Column | None]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        if condition is not None:
            result = result & condition
    return result


def _any(conditions: list[Column]) -> Column:
    """All conditions joined by "or" in a tree: a chain of a thousand would be too deep for the planner."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2], strict=False)
        conditions = [a | b for a, b in pairs] + (conditions[-1:] if len(conditions) % 2 else [])
    return conditions[0] if conditions else F.lit(False)


def _message_test(rule: Rule, message: Column, good: dict[str, int | None]) -> Column | None:
    """The message part of a rule; None for a rule that can never match."""
    if rule.match_type == "substr":
        return F.contains(message, F.lit(rule.expression))
    if rule.match_type.startswith("regex") and good[rule.expression] is not None:
        return message.rlike(_finder(rule.expression))
    return None


def _rule_parms(rule: Rule, message: Column, good: dict[str, int | None]) -> Column:
    groups = good.get(rule.expression) if rule.match_type.startswith("regex") else 0
    if not groups:
        return empty_parms()
    value = lambda i: F.regexp_extract(message, _finder(rule.expression), i)
    found = [parm(f"group{i}", value(i)) for i in range(1, groups + 1)] if rule.default_mapping else []
    found += [parm(name, value(i)) for i, name in rule.assignments]
    return F.array(*found).cast(PARM_TYPE) if found else empty_parms()


def match_rules(
    df: DataFrame,
    rules: list[Rule] | DataFrame,
    discard_uei: str = "",
    message: str = "message",
    hostaddr: str = "host_address",
    keep_discarded: bool = False,
) -> DataFrame:
    """Add ``rule_no``, ``uei`` and ``rule_parms`` of the first rule that matches.

    Rows caught by a rule with the discard name are dropped, and so are rows without a
    message that a rule would have looked at; ``keep_discarded`` keeps both, told apart
    by ``discarded`` and ``reject_reason``. Cheap list tests come before regexes. A table of
    rules (``rules_frame``) is read on the driver. Long lists are tried block by block.
    """
    ordered = sorted(rules_from(rules) if isinstance(rules, DataFrame) else rules, key=lambda r: r.rule_no)
    regexes = [r.expression for r in ordered if r.match_type != "substr"]
    regexes += [e for r in ordered for e in (r.process_expr, r.hostname_expr, r.hostaddr_expr) if e]
    good = _group_counts(df, regexes)
    text = F.col(message)
    found: list[Column] = []
    looking: list[Column] = []
    always = False
    usable = 0
    for rule in ordered:
        test = _message_test(rule, text, good)
        if test is None:
            continue
        before = _all([
            _in_list("facility", rule.facilities),
            _in_list("severity", rule.severities),
            _find_in("process_name", rule.process_expr, good),
            _find_in("hostname", rule.hostname_expr, good),
            _find_in(hostaddr, rule.hostaddr_expr, good),
        ])
        looking.append(before)
        always = always or not (rule.facilities or rule.severities or rule.process_expr or rule.hostname_expr or rule.hostaddr_expr)
        if usable % _BLOCK == 0:
            found.append(F.when(before & test, F.lit(rule.rule_no)))
        else:
            found[-1] = found[-1].when(before & test, F.lit(rule.rule_no))
        usable += 1
    looked_at = F.lit(True) if always else _any(looking)
    out = df
    for k, block in enumerate(found):
        out = compute_once(out, {f"_block_{k}": block if k == 0 else F.coalesce(f"_block_{k - 1}", block)})
    number = F.col(f"_block_{len(found) - 1}") if found else F.lit(None).cast("int")
    out = compute_once(out, {"rule_no": number, "reject_reason": F.when(text.isNull() & looked_at, "null_message")})
    out = out.drop(*[f"_block_{k}" for k in range(len(found))])
    by_no = {r.rule_no: r for r in ordered}
    discarding = [n for n, r in by_no.items() if r.uei == discard_uei]
    uei: Column | None = None
    parms: Column | None = None
    for no, rule in by_no.items():
        hit = F.col("rule_no") == no
        uei = (uei.when if uei is not None else F.when)(hit, F.lit(rule.uei))
        parms = (parms.when if parms is not None else F.when)(hit, _rule_parms(rule, text, good))
    out = out.withColumns({
        "uei": uei if uei is not None else F.lit(None).cast("string"),
        "rule_parms": parms.otherwise(empty_parms()) if parms is not None else empty_parms(),
        "discarded": F.coalesce(F.col("rule_no").isin(discarding), F.lit(False)) if discarding else F.lit(False),
    })
    if keep_discarded:
        return out
    return out.filter(~F.col("discarded") & F.col("reject_reason").isNull()).drop("discarded", "reject_reason")


def rules_frame(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rules as a table of the shape that ``match_rules`` takes."""
    pair = T.StructType([T.StructField("group", T.IntegerType()), T.StructField("name", T.StringType())])
    schema = T.StructType([
        T.StructField("rule_no", T.IntegerType()), T.StructField("match_type", T.StringType()),
        T.StructField("expression", T.StringType()), T.StructField("uei", T.StringType()),
        T.StructField("facilities", T.ArrayType(T.StringType())),
        T.StructField("severities", T.ArrayType(T.StringType())),
        T.StructField("process_expr", T.StringType()), T.StructField("hostname_expr", T.StringType()),
        T.StructField("hostaddr_expr", T.StringType()), T.StructField("default_mapping", T.BooleanType()),
        T.StructField("assignments", T.ArrayType(pair)),
    ])
    rows = [
        (r.rule_no, r.match_type, r.expression, r.uei, list(r.facilities), list(r.severities),
         r.process_expr, r.hostname_expr, r.hostaddr_expr, r.default_mapping, list(r.assignments))
        for r in rules
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def rules_from(rules: DataFrame) -> list[Rule]:
    """A rule table as the list that ``match_rules`` takes. Rules are configuration, read on the driver."""
    have = set(rules.columns)
    pairs = lambda row: tuple((a["group"], a["name"]) for a in row.assignments or ())
    return [
        Rule(
            r.rule_no, r.match_type, r.expression, r.uei, tuple(r.facilities or ()), tuple(r.severities or ()),
            r.process_expr, r.hostname_expr, r.hostaddr_expr,
            r.default_mapping is not False if "default_mapping" in have else True,
            pairs(r) if "assignments" in have else (),
        )
        for r in rules.orderBy("rule_no").collect()
    ]


@dataclass(frozen=True)
class ParmFilter:
    """Rewrite the parm of that name, in events of that name, by a regex."""

    parm: str
    uei: str
    pattern: str
    replacement: str


def rewrite_parms(df: DataFrame, filters: list[ParmFilter], parms: str = "parms", uei: str = "uei") -> DataFrame:
    """Redact parm values: trim, then replace all matches. The first filter per key counts."""
    keyed: dict[tuple[str, str], ParmFilter] = {}
    for f in filters:
        keyed.setdefault((f.parm, f.uei), f)

    def rewrite(p: Column) -> Column:
        value: Column | None = None
        for f in keyed.values():
            hit = (p["name"] == f.parm) & (F.col(uei) == f.uei)
            new = F.regexp_replace(trim_control(p["value"]), f.pattern, f.replacement)
            value = (value.when if value is not None else F.when)(hit, new)
        return p.withField("value", F.coalesce(value, p["value"]))

    return df.withColumn(parms, F.transform(parms, rewrite)) if keyed else df


HIDDEN_TEXT = "The message has been removed because it may hold sensitive data."


def mark_hidden(
    df: DataFrame, hide_rules: list[tuple[str, str]], text: str = "full_text", apply: str | None = None
) -> DataFrame:
    """Add ``hidden``: whether a (type, expression) rule is found in the text.

    ``apply`` names a column to blank out where hidden; by default nothing changes.
    """
    hidden = F.lit(False)
    good = _group_counts(df, [e for kind, e in hide_rules if kind == "regex"])
    for kind, expression in hide_rules:
        if kind == "substr":
            hidden = hidden | F.contains(F.col(text), F.lit(expression))
        elif kind == "regex" and good[expression] is not None:
            hidden = hidden | F.col(text).rlike(_finder(expression))
    out = df.withColumn("hidden", F.coalesce(hidden, F.lit(False)))
    if apply:
        out = out.withColumn(apply, F.when(F.col("hidden"), F.lit(HIDDEN_TEXT)).otherwise(F.col(apply)))
    return out
