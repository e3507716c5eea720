"""Names, codes, widths and patterns that results depend on."""

# Facility names by code; 99 is "unknown".
FACILITY_NAMES = [
    "kernel", "user", "mail", "system", "auth", "syslog", "lpd", "news",
    "uucp", "clock", "authpriv", "ftp", "ntp", "audit", "alert", "cron",
    "local0", "local1", "local2", "local3", "local4", "local5", "local6", "local7",
]
UNKNOWN_FACILITY = "unknown"

# Severity names by code; 99 is "Unknown".
SEVERITY_NAMES = [
    "Emergency", "Alert", "Critical", "Error", "Warning",
    "Notice", "Informational", "Debug", "All",
]
UNKNOWN_SEVERITY = "Unknown"

UNKNOWN_CODE = 99
FACILITY_MASK = 0x03F8
SEVERITY_MASK = 0x0007

# Token shapes accepted for every date-like capture type.
DATETIME_SHAPE = r"\d{4}[-/]\d{2}[-/]\d{2}T\d{2}:\d{2}:\d{2}.(?:\d|-|:)*Z*"
DATE_SHAPE = r"\d{4}[-/]\d{2}[-/]\d{2}"
TIME_SHAPE = r"\d{2}:\d{2}:\d{2}"

MONTH_NAMES = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
LONG_MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december",
]

# Line formats.
RFC5424_LINE = (
    r"(?m)^<(\d{1,3})>(\d{0,2}?) (\S+T\S+) (\S*) (\S*) (\d+|-) (\S*) "
    r"((?:\[.*?\])*|-)(?: (?:BOM)?(.*?))?$"
)
SYSLOGNG_LINE = (
    r"(?m)^<(\d{1,3})>(?:(\S*?)(?::? )?)"
    r"((?:\d\d\d\d-\d\d-\d\d)|(?:\S\S\S\s+\d{1,2}\s+\d\d:\d\d:\d\d)) "
    r"(\S+) (?:(\S+?)(?:\[(\d+)\])?:\s+){0,1}(\S.*?)$"
)
JUNIPER_LINE = (
    r"(?m)^<(\d+)>\s*(\S\S\S\s+\d{1,2}\s+\d\d:\d\d:\d\d)\s+(\S+)\s+(\S+)\[(\d+)\]: (.*?)$"
)
CUSTOM_MESSAGE_ID = r"^((\S+):\s*)"
CUSTOM_OLD_DATE = r"^\s*(\S\S\S\s+\d{1,2}\s+\d\d:\d\d:\d\d)\s+"
CUSTOM_ISO_DATE = r"^\s*((\d\d\d\d-\d\d-\d\d)\s*)"
PLAIN_DATE = r"^((19|20)\d{2})-([1-9]|0[1-9]|1[0-2])-(0[1-9]|[1-9]|[12][0-9]|3[01])$"

# Text widths of the flat event table; 0 means unlimited.
EVENT_WIDTHS = {
    "eventuei": 256, "eventhost": 256, "eventsource": 128, "eventsnmphost": 256,
    "eventsnmp": 256, "eventloggroup": 32, "eventpathoutage": 1024,
    "eventcorrelation": 1024, "eventautoaction": 256, "eventoperaction": 256,
    "eventoperactionmenutext": 256, "eventtticket": 128, "eventforward": 256,
    "eventmouseovertext": 64, "eventackuser": 256,
    "eventparms": 0, "eventdescr": 0, "eventlogmsg": 0, "eventoperinstruct": 0,
}

# Columns of the flat event table, in insertion order.
EVENT_COLUMNS = [
    "eventid", "eventuei", "nodeid", "eventtime", "eventhost", "ipaddr", "systemid",
    "eventsnmphost", "serviceid", "eventsnmp", "eventparms", "eventcreatetime", "eventdescr",
    "eventloggroup", "eventlogmsg", "eventlog", "eventdisplay", "eventseverity",
    "eventpathoutage", "eventcorrelation", "eventsuppressedcount", "eventoperinstruct",
    "eventautoaction", "eventoperaction", "eventoperactionmenutext", "eventnotification",
    "eventtticket", "eventtticketstate", "eventforward", "eventmouseovertext",
    "eventackuser", "eventacktime", "eventsource", "ifindex",
]

# Severity ids of the event table.
EVENT_SEVERITY_IDS = {
    "indeterminate": 1, "cleared": 2, "normal": 3, "warning": 4,
    "minor": 5, "major": 6, "critical": 7,
}

# Fields a definition may protect: cleared on the event, then taken from the definition.
SECURABLE_TAGS = [
    "mask", "descr", "logmsg", "severity", "correlation", "operinstruct", "autoaction",
    "operaction", "autoacknowledge", "loggroup", "tticket", "forward", "script",
    "mouseovertext",
]
