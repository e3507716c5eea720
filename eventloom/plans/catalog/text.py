"""Lines to fields to messages."""

from pyspark.sql import functions as F

from ...functions.columns import dashed
from ...functions.priority import decode_priority, encode_priority
from ...functions.times import format_bsd_time, is_datetime_token, parse_bsd_time, parse_event_time
from ...operators.events import host_address, to_events
from ...operators.extract import extract_fields, to_messages
from ...operators.joins import compute_once
from ...operators.formats import full_text, parse_lines, register_format
from ...operators.rules import split_rejects
from ...sources.envelopes import read_envelopes
from ...session import shared_dir
from ...sources.event_logs import read_documents, read_event_log_rows
from .. import views as V
from .registry import (
    AMOUNT, BODY, BSD, CODE, DAY, HOST, ISO, PID, PROC, REF_TEXT, STAMP, facility_sql, ip_sql, query,
    ref_time, severity_sql, stamp, with_views,
)

PATTERNS = [
    "<%{INTEGER:facilityCode}>%{STRING:hostname}@ %{DATE:date} %{STRING:message}",
    "<%{INTEGER:facilityCode}>v%{INTEGER:version} %{TIMESTAMP_ISO8601:isotimestamp} "
    "%{STRING:hostname}/%{STRING:processName}/%{STRING:processId} %{STRING:messageId}={%{STRING:structureddata}} %{STRING:message}",
    "<%{INTEGER:facilityCode}>%{STRING:messageId}! %{STRING:hostname}~%{STRING:processName}~ %{DATE:date} %{STRING:message}",
    "<%{INTEGER:facilityCode}>%{STRING:processName}#%{INTEGER:processId} %{STRING:hostname} "
    "%{STRING:month} %{STRING:day} %{TIMESTAMP:timestamp} %{STRING:message}",
    "<%{INTEGER:facilityCode}>& %{STRING:hostname} %{STRING:message}",
    "%{STRING:message}",
]
FIREWALL = (
    "<%{INTEGER:facilityCode}>%{STRING:hostname} %{STRING:serialnumber}/%{STRING:type}/%{STRING:subtype} %{STRING:firewallVersion} "
    "%{STRING:recievedate} %{STRING:recievetime} %{STRING:month} %{STRING:day} %{TIMESTAMP:timestamp} %{STRING:message}"
)
KIND = "(event_id % 6)"
MIXED = f"""mixed as (select event_id, ts, {CODE} as code,
    (case {KIND} when 0 then 4 when 1 then 2 when 2 then 3 when 3 then 1 when 4 then 6 else 5 end) as pattern_no,
    case when {KIND} <> 4 then {CODE} end as facility_code,
    case when {KIND} = 5 then 'first' when {KIND} <> 4 then {HOST} end as hostname,
    case when {KIND} in (0, 1, 2) then {PROC} end as process_name,
    case when {KIND} in (0, 1) then {PID} end as process_id,
    case {KIND} when 1 then concat('ID', event_id % 7) when 2 then 'main' end as message_id,
    case when {KIND} = 4 then concat('no priority ', {BODY}) else {BODY} end as message from events)"""


def _envelope(df):
    payload = F.translate(F.base64(F.encode(F.concat("raw", F.lit("\x00\x00")), "UTF-8")), "\r\n", "")
    return df.select("event_id", "ts", F.concat(
        F.lit('<syslog-message-log source-address="'), V.ip_of(F.col("user_id")), F.lit('" source-port="'),
        (1024 + F.col("event_id") % 3).cast("string"), F.lit('" system-id="00" location="site'),
        (F.col("user_id") % 5).cast("string"), F.lit('"><messages timestamp="'),
        stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit('">'), payload, F.lit("</messages></syslog-message-log>"),
    ).alias("value"))


@query("envelope_ingest", f"""
select event_id, {ip_sql('user_id')} as source_address, 1024 + event_id % 3 as source_port,
  concat('site', user_id % 5) as location, '00' as system_id, strftime(ts, {STAMP}) as msg_time,
  concat('<', {CODE}, '>', {BSD}, ' ', {HOST}, ' ', {PROC}, '[', {PID}, ']: ', {BODY}) as raw from events""")
def envelope_ingest(spark, sf):
    return read_envelopes(_envelope(V.raw_syslog(spark, sf))).select(
        "event_id", "source_address", F.col("source_port").cast("bigint").alias("source_port"), "location",
        "system_id", stamp("msg_time").alias("msg_time"), "raw",
    )


def log_streams(spark, sf):
    """A stream of two or three documents per event; every tenth holds a broken one."""
    kind, amount = F.col("event_type"), F.round(F.col("value") * 100).cast("bigint").cast("string")
    iso = stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    plain = F.concat(
        F.lit("<log><header><dpName>dp"), (F.col("event_id") % 3).cast("string"),
        F.lit('</dpName></header><events><event uuid="u'), F.col("event_id").cast("string"),
        F.lit('"><uei>uei.example.org/'), kind, F.lit("</uei><time>"), iso, F.lit("</time><nodeid>"),
        F.col("user_id").cast("string"), F.lit('</nodeid><logmsg dest="logonly">did '), kind,
        F.lit('</logmsg><parms><parm><parmName>amount</parmName><value type="string" encoding="text">'),
        amount, F.lit("</value></parm></parms></event></events></log>\n"),
    )
    broken = F.when(F.col("event_id") % 10 == 0, F.lit("<log><events><event><uei>x</uei></evnt></events></log>\n"))
    prefixed = F.concat(
        F.lit('<n:log xmlns:n="urn:x"><n:events><n:event><n:uei>uei.example.org/again/'), kind,
        F.lit("</n:uei><n:time>"), iso, F.lit("</n:time></n:event></n:events></n:log>"),
    )
    return V.table(spark, sf, "events").select(
        "event_id", F.concat(plain, F.coalesce(broken, F.lit("")), prefixed).alias("stream"))


@query("event_log_documents", f"""
select event_id, 0 as doc_no, 0 as seq, concat('dp', event_id % 3) as header_dp, concat('u', event_id) as uuid,
  concat('uei.example.org/', event_type) as uei, user_id as nodeid, strftime(ts, {STAMP}) as event_time,
  'logonly' as dest, concat('did ', event_type) as content, concat('amount=', {AMOUNT}) as parms from events
union all
select event_id, case when event_id % 10 = 0 then 2 else 1 end, 0, null, null,
  concat('uei.example.org/again/', event_type), null, strftime(ts, {STAMP}), null, null, '' from events""")
def event_log_documents(spark, sf):
    events, _ = read_documents(log_streams(spark, sf), "stream", ["event_id"])
    return events.select(
        "event_id", "doc_no", "seq", "header_dp", "uuid", "uei", "nodeid", stamp("time").alias("event_time"),
        F.col("logmsg.dest").alias("dest"), F.col("logmsg.content").alias("content"),
        F.array_join(F.transform("parms", lambda p: F.concat(p["name"], F.lit("="), p["value"])), "|").alias("parms"),
    )


@query("event_log_rejects", "select event_id, 1 as doc_no from events where event_id % 10 = 0")
def event_log_rejects(spark, sf):
    return read_documents(log_streams(spark, sf), "stream", ["event_id"])[1].select("event_id", "doc_no")


def _fields(spark, sf, strict=False):
    return extract_fields(V.raw_mixed(spark, sf), "raw", PATTERNS, strict)


def _get(name):
    return F.try_element_at("params", F.lit(name))


@query("pattern_extraction", f"""with {MIXED}
select event_id, pattern_no, cast(facility_code as varchar) as facility_code, hostname, process_name,
  cast(process_id as varchar) as process_id, message_id, message from mixed""")
def pattern_extraction(spark, sf):
    return _fields(spark, sf).select(
        "event_id", "pattern_no", _get("facilityCode").alias("facility_code"), _get("hostname").alias("hostname"),
        _get("processName").alias("process_name"), _get("processId").alias("process_id"),
        _get("messageId").alias("message_id"), _get("message").alias("message"),
    )


# In the strict reading "[" only opens a capture, so a structured part keeps its own.
STRICT = [
    "<%{INTEGER:facilityCode}>%{INTEGER:version} %{TIMESTAMP_ISO8601:isotimestamp} %{STRING:hostname} "
    "%{STRING:processName} %{STRING:processId} %{STRING:messageId} [%{STRING:first}][%{STRING:second}] %{STRING:message}",
]


@query("pattern_extraction_strict", f"""
select event_id, case when event_id % 2 = 1 then 1 end as pattern_no,
  case when event_id % 2 = 1 then '[x@1 a="b"' end as first, case when event_id % 2 = 1 then '[y@1' end as second,
  case when event_id % 2 = 1 then concat(case when event_id % 5 = 0 then 'BOM' else '' end, {BODY}) end as message
from events""")
def pattern_extraction_strict(spark, sf):
    out = extract_fields(V.raw_rfc5424(spark, sf), "raw", STRICT, strict=True)
    return out.select("event_id", "pattern_no", _get("first").alias("first"), _get("second").alias("second"),
                      _get("message").alias("message"))


@query("message_record", f"""with {MIXED}
select event_id, {facility_sql('coalesce(facility_code, 99)')} as facility,
  {severity_sql('coalesce(facility_code, 99)')} as severity, case when pattern_no = 2 then 1 else 0 end as version,
  message_id, hostname, process_name, coalesce(process_id, 0) as process_id, message from mixed""")
def message_record(spark, sf):
    return to_messages(_fields(spark, sf)).select(
        "event_id", "facility", "severity", "version", "message_id", "hostname", "process_name", "process_id", "message")


@query("firewall_message", f"""
select event_id, concat('1,', strftime(ts, '%Y/%m/%d %H:%M:%S'), ',00', event_id, ',', event_type, ',end,', {BODY}) as message
from events""")
def firewall_message(spark, sf):
    raw = F.concat(
        F.lit("<14>fw 00"), F.col("event_id").cast("string"), F.lit("/"), F.col("event_type"), F.lit("/end 1 "),
        stamp("ts", "yyyy/MM/dd HH:mm:ss"), F.lit(" "), format_bsd_time(F.col("ts")), F.lit(" "), V.line_body(),
    )
    lines = V.table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return to_messages(extract_fields(lines, "raw", [FIREWALL])).select("event_id", "message")


@query("priority_decode", f"""
select event_id, event_id % 260 as code, {facility_sql('(event_id % 260)')} as facility,
  {severity_sql('(event_id % 260)')} as severity from events where event_id % 260 = 99 or (event_id % 260) < 200""")
def priority_decode(spark, sf):
    codes = V.table(spark, sf, "events").select("event_id", (F.col("event_id") % 260).alias("code"))
    return decode_priority(codes, F.col("code").cast("int"))


@query("priority_encode", with_views("lines") + """
select event_id, ((case when facility = 'unknown' then 99 else event_id % 24 end) & 1016)
  | (case severity when 'Error' then 3 when 'Warning' then 4 when 'Notice' then 5 when 'Informational' then 6
     when 'Debug' then 7 else 99 end) as priority from lines""")
def priority_encode(spark, sf):
    return encode_priority(V.parsed_lines(spark, sf)).select("event_id", F.col("priority").cast("bigint").alias("priority"))


@query("event_time", f"""
select event_id, case event_id % 5
  when 0 then strftime(ts, {STAMP}) when 1 then strftime(ts, {STAMP}) when 2 then strftime(ts, {STAMP})
  when 3 then strftime(ts, {STAMP}) else '{REF_TEXT}' end as event_time from events""")
def event_time(spark, sf):
    kind = F.col("event_id") % 5
    entry = lambda name, when, value: F.struct(F.lit(name).alias("k"), F.when(when, value).alias("v"))
    entries = F.array(
        entry("isotimestamp", kind == 0, stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        entry("date", kind == 1, stamp("ts", "yyyy/MM/dd")),
        entry("timestamp", kind.isin(1, 2, 3), stamp("ts", "HH:mm:ss")),
        entry("month", kind == 2, stamp("ts", "MMM")),
        entry("month", kind == 3, stamp("ts", "M")),
        entry("day", kind.isin(2, 3), stamp("ts", "d")),
        entry("year", kind == 3, stamp("ts", "yyyy")),
        entry("month", kind == 4, F.lit("Nonsense")),
    )
    params = F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))
    return compute_once(V.table(spark, sf, "events"), {"params": params}).select(
        "event_id", stamp(parse_event_time(F.col("params"), ref_time())).alias("event_time"))


@query("line_rfc5424", f"""
select event_id, {facility_sql(CODE)} as facility, {severity_sql(CODE)} as severity, 1 as version,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%g') as line_date, {HOST} as hostname, {PROC} as process_name,
  case when event_id % 3 <> 0 then {PID} end as process_id,
  case when event_id % 4 <> 0 then concat('ID', event_id % 7) end as message_id, {BODY} as message from events""")
def line_rfc5424(spark, sf):
    return parse_lines(V.raw_rfc5424(spark, sf), "raw", "rfc5424", ref_time()).filter("parsed").select(
        "event_id", "facility", "severity", "version", stamp("date", "yyyy-MM-dd HH:mm:ss.SSS").alias("line_date"),
        "hostname", "process_name", "process_id", "message_id", "message")


@query("line_syslogng", f"""
select event_id, {facility_sql(CODE)} as facility, {severity_sql(CODE)} as severity,
  case when event_id % 4 = 0 then {DAY} || ' 00:00:00' else strftime(ts, {STAMP}) end as line_date,
  {HOST} as hostname, case when event_id % 5 <> 0 then {PROC} end as process_name,
  case when event_id % 5 > 1 then {PID} end as process_id,
  case when event_id % 3 = 0 then 'main' end as message_id, {BODY} as message
from events where event_id % 5 <> 0
union all
select event_id, {facility_sql(CODE)}, {severity_sql(CODE)},
  case when event_id % 4 = 0 then {DAY} || ' 00:00:00' else strftime(ts, {STAMP}) end, {HOST},
  null, null, case when event_id % 3 = 0 then 'main' end, {BODY}
from events where event_id % 5 = 0""")
def line_syslogng(spark, sf):
    return parse_lines(V.raw_syslogng(spark, sf), "raw", "syslogng", ref_time()).filter("parsed").select(
        "event_id", "facility", "severity", stamp("date").alias("line_date"), "hostname", "process_name",
        "process_id", "message_id", "message")


@query("line_juniper", f"""
select event_id, {facility_sql(CODE)} as facility, {severity_sql(CODE)} as severity,
  strftime(ts, {STAMP}) as line_date, {HOST} as hostname, {PROC} as process_name, {PID} as process_id,
  {BODY} as message from events""")
def line_juniper(spark, sf):
    return parse_lines(V.raw_syslog(spark, sf), "raw", "juniper", ref_time()).filter("parsed").select(
        "event_id", "facility", "severity", stamp("date").alias("line_date"), "hostname", "process_name",
        "process_id", "message")


CUSTOM = {"forwarding_regex": r"\s*(?:\d{4}-\d{2}-\d{2}\s+)?(\S+)\s(.*)", "host_group": 1, "msg_group": 2}


@query("line_custom", f"""
select event_id, {facility_sql(CODE)} as facility, {severity_sql(CODE)} as severity, {DAY} || ' 00:00:00' as line_date,
  {HOST} as hostname, case when event_id % 5 <> 0 then {PROC} else '' end as process_name,
  case when event_id % 5 > 1 then {PID} else 0 end as process_id,
  case when event_id % 3 = 0 then 'main' end as message_id, concat('user ', user_id, ' did ', event_type) as message
from events""")
def line_custom(spark, sf):
    return parse_lines(V.raw_forwarded(spark, sf), "raw", "custom", ref_time(), **CUSTOM).filter("parsed").select(
        "event_id", "facility", "severity", stamp("date").alias("line_date"), "hostname", "process_name",
        "process_id", "message_id", "message")


@query("bsd_time", f"""
select event_id, case when event_id % 11 = 0 then null
  when event_id % 13 = 0 then strftime(date_trunc('day', ts) + interval 1 day + (ts - date_trunc('hour', ts)), {STAMP})
  else strftime(ts, {STAMP}) end as parsed,
  case when event_id % 11 = 0 then null
  when event_id % 13 = 0 then strftime(date_trunc('day', ts) + interval 1 day + (ts - date_trunc('hour', ts)), '%b %d %H:%M:%S')
  else {BSD} end as formatted from events""")
def bsd_time(spark, sf):
    month = F.when(F.col("event_id") % 2 == 0, F.upper(stamp("ts", "MMM"))).otherwise(stamp("ts", "MMM"))
    hour = F.when(F.col("event_id") % 13 == 0, F.lit("24")).otherwise(stamp("ts", "H"))
    minute = F.when(F.col("event_id") % 11 == 0, F.lit("60")).otherwise(stamp("ts", "mm"))
    gap = F.when(F.col("event_id") % 4 == 0, F.lit("  ")).otherwise(F.lit(" "))
    text = F.concat(month, gap, stamp("ts", "d"), F.lit(" "), hour, F.lit(":"), minute, F.lit(":"), stamp("ts", "ss"))
    parsed = parse_bsd_time(text, ref_time())
    return V.table(spark, sf, "events").select(
        "event_id", stamp(parsed).alias("parsed"), format_bsd_time(parsed).alias("formatted"))


@query("canonical_text", with_views("lines") + f"""
select event_id, concat('<', ((case when facility = 'unknown' then 99 else event_id % 24 end) & 1016)
  | (case severity when 'Error' then 3 when 'Warning' then 4 when 'Notice' then 5 when 'Informational' then 6
     when 'Debug' then 7 else 99 end), '>', {BSD}, ' ', hostname, ' ',
  case when process_name is null then '' when process_id is null then process_name || ': '
       else process_name || '[' || process_id || ']: ' end, message) as full_text from lines""")
def canonical_text(spark, sf):
    return full_text(V.parsed_lines(spark, sf), date="event_time").select("event_id", "full_text")


@query("event_build", with_views("lines") + f"""
select event_id, concat('uei.example.org/syslog/', facility, '/', severity) as uei, 'syslog' as source,
  '00000000' as dist_poller, strftime(ts, {STAMP}) as event_time,
  case when event_id % 3 = 0 then '192.0.2.' || (event_id % 250) else source_address end as interface,
  'logndisplay' as dest, message as content,
  concat_ws('|', 'rawmessage=' || message, 'syslogmessage=' || message, 'severity=' || severity,
    'timestamp=' || strftime(ts, '%a %b %d %H:%M:%S UTC %Y'), 'process=' || process_name,
    'service=' || facility, 'processid=' || process_id) as parms from lines""")
def event_build(spark, sf):
    lines = V.parsed_lines(spark, sf).withColumn("raw", F.col("message")).withColumn(
        "hostname", F.when(F.col("event_id") % 3 == 0, F.concat(
            F.lit("192.0.2."), (F.col("event_id") % 250).cast("string"))).otherwise(F.col("hostname")))
    return to_events(host_address(lines)).select(
        "event_id", "uei", "source", "dist_poller", stamp("time").alias("event_time"), "interface",
        F.col("logmsg.dest").alias("dest"), F.col("logmsg.content").alias("content"),
        F.array_join(F.transform("parms", lambda p: F.concat(p["name"], F.lit("="), p["value"])), "|").alias("parms"))


@query("host_names", with_views("lines", more="hosts as (select concat('host', r % 20) as name, concat('192.0.2.', min(r)) as ip "
       "from (select c_custkey % 15 as r from customer) group by 1)") + """
select event_id, ip as host_address from lines left join hosts on hostname = name""")
def host_names(spark, sf):
    number = F.col("c_custkey") % 15
    hosts = V.table(spark, sf, "customer").select(
        F.concat(F.lit("host"), (number % 20).cast("string")).alias("name"),
        F.concat(F.lit("192.0.2."), number.cast("string")).alias("ip")).distinct()
    return host_address(V.parsed_lines(spark, sf), hosts).select("event_id", "host_address")


@query("reject_split", f"""
select event_id, 'interior_newline' as reject_reason from events where {KIND} = 5""")
def reject_split(spark, sf):
    return split_rejects(to_messages(_fields(spark, sf)))[1].select("event_id", "reject_reason")


@query("accepted_lines", f"""with {MIXED}
select {facility_sql('coalesce(facility_code, 99)')} as facility, count(*) as n from mixed where pattern_no <> 5 group by 1""")
def accepted_lines(spark, sf):
    return split_rejects(to_messages(_fields(spark, sf)))[0].groupBy("facility").agg(F.count(F.lit(1)).alias("n"))


@query("datetime_token", f"""
select event_id, event_id % 6 in (0, 1, 2, 3) as is_time from events""")
def datetime_token(spark, sf):
    kind = F.col("event_id") % 6
    token = (
        F.when(kind == 0, stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(kind == 1, stamp("ts", "yyyy/MM/dd"))
        .when(kind == 2, stamp("ts", "HH:mm:ss")).when(kind == 3, stamp("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(kind == 4, stamp("ts", "HH:mm")).otherwise(F.col("event_type"))
    )
    return V.table(spark, sf, "events").select("event_id", is_datetime_token(token).alias("is_time"))


def _pairs(text, ref, **_):
    """``user U did K ...`` read as a format of its own."""
    regex = r"^user (\d+) did (\S+) (.*)$"
    return {
        "hostname": F.regexp_extract(text, regex, 1), "process_name": F.regexp_extract(text, regex, 2),
        "message": dashed(F.regexp_extract(text, regex, 3)), "date": ref, "parsed": text.rlike(regex),
    }


@query("format_registry", f"""
select event_id, cast(user_id as varchar) as hostname, event_type as process_name,
  concat('amount ', {AMOUNT}, ' props ', props) as message from events""")
def format_registry(spark, sf):
    register_format("pairs", _pairs)
    lines = V.table(spark, sf, "events").select("event_id", V.line_body().alias("raw"))
    return parse_lines(lines, "raw", "pairs", ref_time()).filter("parsed").select(
        "event_id", "hostname", "process_name", "message")


@query("event_time_fractions", f"""
select event_id, case event_id % 6
  when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') || '.250000' when 1 then strftime(ts, '%Y-%m-%d %H:%M:%S') || '.500000'
  when 2 then strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000000' when 3 then '{REF_TEXT}.000000'
  when 4 then '{REF_TEXT}.000000' else strftime(ts, '%Y-%m-%d') || ' 00:00:00.000000' end as event_time from events""")
def event_time_fractions(spark, sf):
    """Fractions, times with a date of their own, full month names, and texts that only begin like a time or month."""
    kind = F.col("event_id") % 6
    entry = lambda name, when, value: F.struct(F.lit(name).alias("k"), F.when(when, value).alias("v"))
    entries = F.array(
        entry("date", kind == 0, stamp("ts", "yyyy-MM-dd")),
        entry("timestamp", kind == 0, F.concat(stamp("ts", "HH:mm:ss"), F.lit(".25"))),
        entry("timestamp", kind == 1, stamp("ts", "yyyy-MM-dd'T'HH:mm:ss'.5Z'")),
        entry("year", kind == 2, stamp("ts", "yyyy")), entry("month", kind == 2, stamp("ts", "MMMM")),
        entry("day", kind == 2, stamp("ts", "d")), entry("timestamp", kind == 2, stamp("ts", "HH:mm:ss")),
        entry("month", kind == 3, F.lit("Marble")), entry("day", kind == 3, F.lit("3")),
        entry("date", kind == 4, stamp("ts", "yyyy-MM-dd")),
        entry("timestamp", kind == 4, F.concat(stamp("ts", "HH:mm:ss"), F.lit("junk"))),
        entry("timestamp", kind == 5, stamp("ts", "yyyy/MM/dd")),
    )
    params = F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))
    return compute_once(V.table(spark, sf, "events"), {"params": params}).select(
        "event_id", stamp(parse_event_time(F.col("params"), ref_time()), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"))


@query("envelope_many_messages", f"""
select event_id, no as message_no, {ip_sql('user_id')} as source_address, concat(event_type, ' ', no) as raw
from events, range(3) r(no) where no < event_id % 4
union all select event_id, null, {ip_sql('user_id')}, null from events where event_id % 4 = 0""")
def envelope_many_messages(spark, sf):
    """None to three messages in an envelope; each is a row."""
    body = lambda n: F.base64(F.encode(F.concat("event_type", F.lit(f" {n}")), "UTF-8"))
    messages = F.concat(*[F.when(F.col("event_id") % 4 > n, F.concat(F.lit("<messages>"), body(n), F.lit("</messages>"))).otherwise("")
                          for n in range(3)])
    envelopes = V.table(spark, sf, "events").select("event_id", F.concat(
        F.lit('<syslog-message-log source-address="'), V.ip_of(F.col("user_id")), F.lit('">'), messages, F.lit("</syslog-message-log>"),
    ).alias("value"))
    return read_envelopes(envelopes).select("event_id", F.col("message_no").cast("bigint").alias("message_no"), "source_address", "raw")


@query("event_log_remainder", "select event_id, 'cut <log><events>' as doc from events where event_id % 3 = 0")
def event_log_remainder(spark, sf):
    """Text behind the last document is a reject, not lost."""
    tail = F.when(F.col("event_id") % 3 == 0, F.lit(" cut <log><events>")).otherwise("\n ")
    streams = V.table(spark, sf, "events").select("event_id", F.concat(
        F.lit("<log><events><event><uei>x</uei></event></events></log>"), tail).alias("stream"))
    return read_documents(streams, "stream", ["event_id"])[1].select("event_id", "doc")


@query("event_log_files", f"""
select concat('dp', event_id % 3) as header_dp, concat('u', event_id) as uuid, concat('uei.example.org/', event_type) as uei,
  user_id as nodeid, strftime(ts, {STAMP}) as event_time, concat('did ', event_type) as content from events
union all
select null, null, concat('uei.example.org/again/', event_type), null, strftime(ts, {STAMP}), null from events
union all
select 'reject', null, null, null, null, null from events where event_id % 10 = 0""")
def event_log_files(spark, sf):
    """The streams of all events in files that are read split by split."""
    path = shared_dir(spark, "event-logs")
    log_streams(spark, sf).select("stream").write.text(path)
    rows = read_event_log_rows(spark, path)
    return rows.select(F.when(F.col("rejected"), "reject").otherwise(F.col("header_dp")).alias("header_dp"), "uuid", "uei", "nodeid",
                       stamp("time").alias("event_time"), F.col("logmsg.content").alias("content"))
