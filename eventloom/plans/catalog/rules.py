"""Rule matching, discarding, rewriting and hiding."""

from pyspark.sql import functions as F

from ...functions.columns import PARM_TYPE, parm, pretty_parms
from ...operators.events import broadcastable, is_reload, persistable
from ...operators.formats import full_text
from ...operators.rules import ParmFilter, Rule, mark_hidden, match_rules, rewrite_parms, rules_frame
from ...session import shared_dir
from ...sources.config import read_hide_rules, read_rules, rule_list
from .. import views as V
from .registry import AMOUNT, query, with_views

RULES = [
    Rule(1, "substr", "did view", "uei.example.org/view"),
    Rule(2, "regex", r"amount ([0-9]+)", "uei.example.org/local", facilities=("local0", "LOCAL1")),
    Rule(3, "regex", r"did (error|click)", "DISCARD", severities=("error",)),
    Rule(4, "regex", r"user ([0-9]+) did ([a-z]+)", "uei.example.org/pair", process_expr="^sign",
         assignments=((2, "what"), (1, "who")), default_mapping=False),
    Rule(5, "regex", r"user ([0-9]+) did ([a-z]+)", "uei.example.org/any", hostname_expr="host1[0-9]",
         assignments=((2, "what"),)),
    Rule(6, "regex", "(", "uei.example.org/never"),
    Rule(7, "substr", "purchase", "uei.example.org/address", hostaddr_expr=r"^192\.0\.2\."),
]
MATCHED = """matched as (select *, case
  when contains(message, 'did view') then 1
  when facility in ('local0', 'local1') and regexp_matches(message, 'amount ([0-9]+)') then 2
  when severity = 'Error' and regexp_matches(message, 'did (error|click)') then 3
  when process_name is not null and starts_with(process_name, 'sign') and regexp_matches(message, 'user ([0-9]+) did ([a-z]+)') then 4
  when regexp_matches(hostname, 'host1[0-9]') and regexp_matches(message, 'user ([0-9]+) did ([a-z]+)') then 5
  when event_id % 3 = 0 and contains(message, 'purchase') then 7 end as rule_no from lines)"""
NAMES = """(case rule_no when 1 then 'uei.example.org/view' when 2 then 'uei.example.org/local'
  when 4 then 'uei.example.org/pair' when 5 then 'uei.example.org/any' when 7 then 'uei.example.org/address' end)"""


def _lines(spark, sf):
    return V.parsed_lines(spark, sf).withColumn(
        "host_address", F.when(F.col("event_id") % 3 == 0, F.lit("192.0.2.7")))


def _shown(col="parms"):
    return F.array_join(F.transform(col, lambda p: F.concat(p["name"], F.lit("="), p["value"])), "|")


@query("rule_match", with_views("lines", more=MATCHED) + f"""
select event_id, rule_no, {NAMES} as uei from matched where rule_no is null or rule_no <> 3""")
def rule_match(spark, sf):
    return match_rules(_lines(spark, sf), RULES, "DISCARD").select("event_id", "rule_no", "uei")


@query("rule_match_table", with_views("lines", more=MATCHED) + f"""
select event_id, rule_no, {NAMES} as uei from matched where rule_no is null or rule_no <> 3""")
def rule_match_table(spark, sf):
    lines = _lines(spark, sf)
    return match_rules(lines, rules_frame(lines, RULES), "DISCARD").select("event_id", "rule_no", "uei")


@query("rule_discard", with_views("lines", more=MATCHED) + """
select facility, count(*) filter (where rule_no = 3) as dropped, count(*) filter (where coalesce(rule_no, 0) <> 3) as kept
from matched group by 1""")
def rule_discard(spark, sf):
    flagged = match_rules(_lines(spark, sf), RULES, "DISCARD", keep_discarded=True)
    return flagged.groupBy("facility").agg(
        F.count_if("discarded").alias("dropped"), F.count_if(~F.col("discarded")).alias("kept"))


@query("rule_null_message", with_views("lines") + """
select event_id, 'null_message' as reject_reason from lines
where event_id % 4 = 0""")
def rule_null_message(spark, sf):
    lines = _lines(spark, sf).withColumn("message", F.when(F.col("event_id") % 4 != 0, F.col("message")))
    flagged = match_rules(lines, RULES, "DISCARD", keep_discarded=True)
    return flagged.filter(F.col("reject_reason").isNotNull()).select("event_id", "reject_reason")


@query("rule_capture_parms", with_views("lines", more=MATCHED) + f"""
select event_id, case rule_no
  when 2 then concat('group1=', {AMOUNT})
  when 4 then concat('what=', event_type, '|who=', user_id)
  when 5 then concat('group1=', user_id, '|group2=', event_type, '|what=', event_type) else '' end as parms
from matched where rule_no is null or rule_no <> 3""")
def rule_capture_parms(spark, sf):
    return match_rules(_lines(spark, sf), RULES, "DISCARD").select("event_id", _shown("rule_parms").alias("parms"))


RULE_FILE = """<?xml version="1.0"?><syslog-configuration>
<configuration discard-uei="DISCARD"/>
<ueiList>
<ueiMatch><match type="substr" expression="did view"/><uei>uei.example.org/view</uei></ueiMatch>
<ueiMatch><facility>local0</facility><facility>LOCAL1</facility>
<match type="regex" expression="amount ([0-9]+)"/><uei>uei.example.org/local</uei></ueiMatch>
<ueiMatch><severity>Error</severity><match type="regex" expression="did (error|click)"/><uei>DISCARD</uei></ueiMatch>
<ueiMatch><process-match expression="^sign"/>
<match type="regex" expression="user ([0-9]+) did ([a-z]+)" default-parameter-mapping="false"/>
<uei>uei.example.org/pair</uei><parameter-assignment matching-group="2" parameter-name="what"/>
<parameter-assignment matching-group="1" parameter-name="who"/></ueiMatch>
<ueiMatch><hostname-match expression="host1[0-9]"/><match type="regex" expression="user ([0-9]+) did ([a-z]+)"/>
<uei>uei.example.org/any</uei><parameter-assignment matching-group="2" parameter-name="what"/></ueiMatch>
<ueiMatch><match type="regex" expression="("/><uei>uei.example.org/never</uei></ueiMatch>
<ueiMatch><hostaddr-match expression="^192[.]0[.]2[.]"/><match type="substr" expression="purchase"/>
<uei>uei.example.org/address</uei></ueiMatch>
</ueiList>
<hideMessage><hideMatch><match type="substr" expression="did purchase"/></hideMatch>
<hideMatch><match type="regex" expression="amount [0-9]*7 "/></hideMatch></hideMessage>
</syslog-configuration>"""


def _rule_file(spark):
    path = shared_dir(spark, "rules")
    spark.createDataFrame([(RULE_FILE,)], "value string").coalesce(1).write.text(path)
    return path


@query("rule_file_match", with_views("lines", more=MATCHED) + f"""
select event_id, rule_no, {NAMES} as uei from matched where rule_no is null or rule_no <> 3""")
def rule_file_match(spark, sf):
    rules = rule_list(read_rules(spark, _rule_file(spark)))
    return match_rules(_lines(spark, sf), rules, "DISCARD").select("event_id", "rule_no", "uei")


@query("hide_marking", with_views("lines") + f"""
select event_id, contains(message, 'did purchase') or regexp_matches(message, 'amount [0-9]*7 ') as hidden from lines""")
def hide_marking(spark, sf):
    rules = read_hide_rules(spark, _rule_file(spark)).orderBy("rule_no").collect()
    text = full_text(V.parsed_lines(spark, sf), date="event_time")
    return mark_hidden(text, [(r["type"], r["expression"]) for r in rules]).select("event_id", "hidden")


FILTERS = [
    ParmFilter("user", "uei.example.org/error", "[0-9]", "#"),
    ParmFilter("user", "uei.example.org/error", ".*", "second filter of a key is not used"),
    ParmFilter("amount", "uei.example.org/click", "([0-9])([0-9])", "$2$1"),
]


@query("parm_redaction", f"""
select event_id, concat('user=', case when event_type = 'error' then regexp_replace(cast(user_id as varchar), '[0-9]', '#', 'g')
  else cast(user_id as varchar) end, '| kind =', event_type, '|amount=',
  case when event_type = 'click' then regexp_replace(cast({AMOUNT} as varchar), '([0-9])([0-9])', '\\2\\1', 'g')
  else cast({AMOUNT} as varchar) end) as parms from events""")
def parm_redaction(spark, sf):
    out = rewrite_parms(V.parm_events(spark, sf), FILTERS)
    return out.select("event_id", _shown(F.slice("parms", 1, 3)).alias("parms"))


@query("document_redaction", """
select doc_id, md5(regexp_replace(trim(text, E' \\t\\n\\r'), '[0-9]{3,}', '###', 'g')) as text_md5,
  length(regexp_replace(trim(text, E' \\t\\n\\r'), '[0-9]{3,}', '###', 'g')) as n from documents""")
def document_redaction(spark, sf):
    docs = V.table(spark, sf, "documents").select(
        "doc_id", F.lit("document").alias("uei"), F.array(parm("text", F.col("text"))).cast(PARM_TYPE).alias("parms"))
    text = F.element_at("parms", 1)["value"]
    out = rewrite_parms(docs, [ParmFilter("text", "document", "[0-9]{3,}", "###")])
    return out.select("doc_id", F.md5(text.cast("binary")).alias("text_md5"), F.length(text).cast("bigint").alias("n"))


def _dest():
    kind = F.col("event_id") % 6
    return (F.when(kind == 0, "logndisplay").when(kind == 1, "donotpersist").when(kind == 2, "DoNotPersist")
            .when(kind == 3, "suppress").when(kind == 4, "SUPPRESS").otherwise(F.lit(None)))


def dest_events(spark, sf):
    return V.table(spark, sf, "events").select("event_id", "event_type", F.struct(
        _dest().alias("dest"), F.col("event_type").alias("content")).alias("logmsg"))


@query("persist_filter", "select event_id from events where event_id % 6 in (0, 5)")
def persist_filter(spark, sf):
    return persistable(dest_events(spark, sf)).select("event_id")


@query("broadcast_filter", "select event_id from events where event_id % 6 <> 3")
def broadcast_filter(spark, sf):
    return broadcastable(dest_events(spark, sf)).select("event_id")


@query("reload_filter", """
select event_id from events where (event_type = 'error' and event_id % 3 = 0) or event_type = 'view'""")
def reload_filter(spark, sf):
    daemon = F.when(F.col("event_id") % 3 == 0, "EVENTS").when(F.col("event_id") % 3 == 1, "other")
    events = V.table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("uei.example.org/"), "event_type").alias("uei"),
        F.array(parm("daemonName", daemon)).cast(PARM_TYPE).alias("parms"))
    wanted = is_reload("uei.example.org/error", "uei.example.org/view", "events")
    return events.filter(wanted).select("event_id")


@query("pretty_parms", f"""
select event_id, concat('user=', user_id, ', kind =', event_type, ',amount=', {AMOUNT}) as pretty from events""")
def pretty(spark, sf):
    return V.parm_events(spark, sf).select(
        "event_id", F.array_join(pretty_parms(F.slice("parms", 1, 3)), ",").alias("pretty"))


EDGE_SQL = """edge as (select event_id, case event_id % 5 when 0 then null when 1 then 'nowhere' else facility end as facility,
    case event_id % 7 when 0 then null when 1 then 'Odd' else severity end as severity, process_name, hostname,
    case when event_id % 6 <> 0 then message end as message, event_type, user_id, value from lines),
judged as (select *, case when contains(message, 'did view') then 1
    when facility in ('local0', 'local1') and regexp_matches(message, 'amount ([0-9]+)') then 2
    when severity = 'Error' and regexp_matches(message, 'did (error|click)') then 3
    when process_name is not null and starts_with(process_name, 'sign') and regexp_matches(message, 'user ([0-9]+) did ([a-z]+)') then 4
    when regexp_matches(hostname, 'host1[0-9]') and regexp_matches(message, 'user ([0-9]+) did ([a-z]+)') then 5
    when event_id % 3 = 0 and contains(message, 'purchase') then 7 end as rule_no from edge)"""


@query("rule_forms", with_views("lines", more=EDGE_SQL) + """
select event_id, form, rule_no, message is null as null_message, rule_no is not null and rule_no = 3 as discarded,
  case rule_no when 2 then 1 when 3 then 1 when 4 then 2 when 5 then 3 else 0 end as n_parms
from judged, (values ('list'), ('table')) f(form)""")
def rule_forms(spark, sf):
    """A list and a table of rules give the same: null and unlisted levels, null messages, a bad regex, parms."""
    k = F.col("event_id")
    lines = _lines(spark, sf).withColumns({
        "facility": F.when(k % 5 == 0, None).when(k % 5 == 1, "nowhere").otherwise(F.col("facility")),
        "severity": F.when(k % 7 == 0, None).when(k % 7 == 1, "Odd").otherwise(F.col("severity")),
        "message": F.when(k % 6 != 0, F.col("message"))})
    forms = {"list": RULES, "table": rules_frame(lines, RULES)}
    parts = [match_rules(lines, rules, "DISCARD", keep_discarded=True).select(
        "event_id", F.lit(form).alias("form"), "rule_no", (F.col("reject_reason") == "null_message").eqNullSafe(True).alias("null_message"),
        "discarded", F.size("rule_parms").alias("n_parms")) for form, rules in forms.items()]
    return parts[0].union(parts[1])
