"""Messages to events, and events to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import escape_delimiter, parm, parm_value
from ..functions.fixed import EVENT_COLUMNS, EVENT_SEVERITY_IDS, EVENT_WIDTHS
from ..schema import as_events

_IPV4 = r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)$"


def host_address(df: DataFrame, hosts: DataFrame | None = None, host: str = "hostname") -> DataFrame:
    """Add ``host_address``: an IPv4 literal as it is, else from a ``hosts(name, ip)`` table."""
    literal = F.when(F.col(host).rlike(_IPV4), F.col(host))
    if hosts is None:
        return df.withColumn("host_address", literal)
    names = hosts.groupBy(F.col("name").alias("_host_name")).agg(F.min("ip").alias("_host_ip"))
    return (
        df.join(names, F.col(host) == F.col("_host_name"), "left")
        .withColumn("host_address", F.coalesce(literal, "_host_ip"))
        .drop("_host_name", "_host_ip")
    )


def java_date_text(col: Column) -> Column:
    return F.date_format(col, "EEE MMM dd HH:mm:ss 'UTC' yyyy")


#: The columns of matched messages that ``to_events`` reads, where a frame has them.
MESSAGE_FIELDS = (
    "event_id", "location", "nodeid", "raw", "message", "facility", "severity", "event_time", "process_name", "process_id",
    "host_address", "source_address", "system_id", "uei", "rule_parms",
)


def to_events(
    df: DataFrame, uei_prefix: str = "uei.example.org/syslog", source: str = "syslog",
    local_host: str = "localhost", raw: str = "raw",
) -> DataFrame:
    """Build events from matched messages.

    A rule's name wins over ``<prefix>/<facility>/<Severity>``. Rule parms come first,
    then the standing ones in a fixed order; a parm without a value is left out.
    """
    have = set(df.columns)
    address = F.col("host_address") if "host_address" in have else F.lit(None).cast("string")
    packet = F.col("source_address") if "source_address" in have else F.lit(None).cast("string")
    default_uei = F.concat_ws("/", F.lit(uei_prefix), F.col("facility"), F.col("severity"))
    standing = F.array(
        parm("rawmessage", F.col(raw)),
        parm("syslogmessage", F.col("message")),
        parm("severity", F.col("severity")),
        parm("timestamp", java_date_text(F.col("event_time"))),
        parm("process", F.col("process_name")),
        parm("service", F.col("facility")),
        parm("processid", F.col("process_id")),
    )
    parms = F.filter(standing, lambda p: p["value"].isNotNull())
    if "rule_parms" in have:
        parms = F.concat("rule_parms", parms)
    built = {
        "uei": F.coalesce("uei", default_uei) if "uei" in have else default_uei,
        "source": F.lit(source),
        "dist_poller": F.col("system_id") if "system_id" in have else F.lit(None).cast("string"),
        "time": F.col("event_time"),
        "host": F.lit(local_host),
        "interface": F.coalesce(address, packet),
        "logmsg": F.struct(F.lit("logndisplay").alias("dest"), F.col("message").alias("content")),
        "parms": parms,
    }
    kept = [c for c in ("event_id", "location", "nodeid") if c in have]
    return as_events(df.select(*kept, *[c.alias(n) for n, c in built.items()]))


def persistable(df: DataFrame) -> DataFrame:
    """Keep the events to store; an event without a log message is an error."""
    dest = F.when(
        F.col("logmsg").isNull(), F.raise_error(F.lit("event does not have a logmsg")).cast("string")
    ).otherwise(F.lower("logmsg.dest"))
    return df.filter(F.coalesce(~dest.isin("donotpersist", "suppress"), F.lit(True)))


def broadcastable(df: DataFrame) -> DataFrame:
    """Keep the events to hand on; only ``suppress``, spelled so, is held back."""
    return df.filter(F.coalesce(F.col("logmsg.dest") != "suppress", F.lit(True)))


def is_reload(
    reload_uei: str, changed_uei: str, daemon: str, uei: str = "uei", parms: str = "parms"
) -> Column:
    """Control events that ask this daemon to read its definitions again."""
    target = F.lower(parm_value(F.col(parms), "daemonName")) == daemon.lower()
    return F.coalesce(
        F.when(F.col(uei) == reload_uei, target).when(F.col(uei) == changed_uei, F.lit(True)), F.lit(False)
    )


def log_flags(dest: Column, has_logmsg: Column) -> tuple[Column, Column]:
    """The (log, display) flags of a destination."""
    pick = lambda both, log, shown, none: (
        F.when(~has_logmsg, "Y").when(dest == "logndisplay", both).when(dest == "logonly", log)
        .when(dest == "displayonly", shown).when(dest == "suppress", none)
    )
    return pick("Y", "Y", "N", "N"), pick("Y", "N", "Y", "N")


def serialize_list(items: Column, parts: list[str], item_delim: str = ";", part_delim: str = ",") -> Column:
    """Items joined by one delimiter and their parts by another, both escaped in values."""

    def text(value: Column) -> Column:
        return escape_delimiter(escape_delimiter(F.coalesce(value, F.lit("")), item_delim), part_delim)

    def one(item: Column) -> Column:
        return F.concat_ws(part_delim, *[text(item[p]) for p in parts]) if parts else text(item)

    return F.when(F.size(items) > 0, F.array_join(F.transform(items, one), item_delim))


def serialize_parms(parms: Column, item_delim: str = ";", name_delim: str = "=") -> Column:
    """``name=value(type,encoding)`` list."""

    def one(p: Column) -> Column:
        value = escape_delimiter(escape_delimiter(F.coalesce(p["value"], F.lit("")), item_delim), name_delim)
        return F.concat(
            escape_delimiter(p["name"], name_delim), F.lit(name_delim), value,
            F.lit("("), F.coalesce(p["type"], F.lit("string")), F.lit(","),
            F.coalesce(p["encoding"], F.lit("text")), F.lit(")"),
        )

    return F.when(F.size(parms) > 0, F.array_join(F.transform(parms, one), item_delim))


def fit(col: Column, width: int) -> Column:
    """Null bytes become blanks; text is cut to ``width`` unless that is 0."""
    clean = F.translate(col, "\x00", " ")
    return F.substring(clean, 1, width) if width else clean


def _snmp_text(snmp: Column) -> Column:
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("undefined"))
    return F.when(snmp.isNotNull(), F.concat_ws(
        ",", shown(snmp["id"]), shown(escape_delimiter(snmp["idtext"], ",")), shown(snmp["version"]),
        shown(snmp["specific"]), shown(snmp["generic"]), shown(snmp["community"]),
    ))


def to_event_rows(df: DataFrame, create_time: Column | None = None) -> DataFrame:
    """The flat event table. ``event_host``, ``service_id`` and ``resolved_system`` are used
    where the lookups have added them."""
    have = set(df.columns)
    now = F.current_timestamp() if create_time is None else create_time
    pick = lambda *names: F.coalesce(*[F.col(n) for n in names if n in have])
    log, display = log_flags(F.col("logmsg.dest"), F.col("logmsg").isNotNull())
    ids = F.create_map(*[F.lit(x) for pair in EVENT_SEVERITY_IDS.items() for x in pair])
    acked = F.coalesce(F.col("autoacknowledge.state") == "on", F.lit(False))
    menus = F.transform("operaction", lambda a: a["menutext"])
    null = F.lit(None)
    values = {
        "eventid": F.col("dbid"),
        "eventuei": F.col("uei"),
        "nodeid": F.col("nodeid"),
        "eventtime": F.col("time"),
        "eventhost": pick("event_host", "host"),
        "ipaddr": F.col("interface"),
        "systemid": pick("resolved_system", "dist_poller"),
        "eventsnmphost": F.col("snmphost"),
        "serviceid": F.col("service_id").cast("bigint") if "service_id" in have else null.cast("bigint"),
        "eventsnmp": _snmp_text(F.col("snmp")),
        "eventparms": serialize_parms(F.col("parms")),
        "eventcreatetime": now,
        "eventdescr": F.col("descr"),
        "eventloggroup": serialize_list(F.col("loggroup"), []),
        "eventlogmsg": F.col("logmsg.content"),
        "eventlog": log,
        "eventdisplay": display,
        "eventseverity": F.coalesce(F.try_element_at(ids, F.lower("severity")), F.lit(1)),
        "eventpathoutage": F.col("pathoutage"),
        "eventcorrelation": F.when(F.col("correlation").isNotNull(), F.concat_ws(
            ",", "correlation.state", "correlation.path", "correlation.cuei", "correlation.cmin",
            "correlation.cmax", "correlation.ctime",
        )),
        "eventsuppressedcount": null.cast("int"),
        "eventoperinstruct": F.col("operinstruct"),
        "eventautoaction": serialize_list(F.col("autoaction"), ["content", "state"]),
        "eventoperaction": serialize_list(F.col("operaction"), ["content", "state"]),
        "eventoperactionmenutext": serialize_list(menus, []),
        "eventnotification": null.cast("string"),
        "eventtticket": F.col("tticket.content"),
        "eventtticketstate": F.when(
            F.col("tticket").isNotNull(), F.when(F.col("tticket.state") == "on", 1).otherwise(0)
        ),
        "eventforward": serialize_list(F.col("forward"), ["content", "state", "mechanism"]),
        "eventmouseovertext": F.col("mouseovertext"),
        "eventackuser": F.when(acked, F.col("autoacknowledge.content")),
        "eventacktime": F.when(acked, now),
        "eventsource": F.col("source"),
        "ifindex": F.col("ifindex"),
    }
    return df.select(*[
        (fit(values[c], EVENT_WIDTHS[c]) if c in EVENT_WIDTHS else values[c]).alias(c)
        for c in EVENT_COLUMNS
    ])
