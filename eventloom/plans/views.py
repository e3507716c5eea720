"""Event-shaped views over the supplied tables. Each grows with its table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import PARM_TYPE, parm
from ..functions.priority import facility_of, severity_of


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ip_of(number: Column) -> Column:
    number = number.cast("bigint")
    return F.concat(
        F.lit("10.0."), F.floor(number / 256).cast("bigint").cast("string"), F.lit("."), (number % 256).cast("string")
    )


def priority_of(event_id: Column, event_type: Column) -> Column:
    severity = F.when(event_type == "error", 3).when(event_type == "purchase", 5).when(
        event_type == "signup", 4
    ).when(event_type == "click", 6).otherwise(7)
    return (event_id % 24) * 8 + severity


def _text(spark_col: Column) -> Column:
    return spark_col.cast("string")


def line_body() -> Column:
    """``user 8 did error amount 655 props {"k": 69}``"""
    return F.concat(
        F.lit("user "), _text(F.col("user_id")), F.lit(" did "), F.col("event_type"), F.lit(" amount "),
        _text(F.round(F.col("value") * 100).cast("bigint")), F.lit(" props "), F.col("props"),
    )


def _pri() -> Column:
    return F.concat(F.lit("<"), _text(priority_of(F.col("event_id"), F.col("event_type"))), F.lit(">"))


def _host() -> Column:
    return F.concat(F.lit("host"), _text(F.col("user_id") % 20))


def _process() -> Column:
    return F.concat(F.col("event_type"), F.lit("d"))


def _pid() -> Column:
    return _text(1000 + F.col("event_id") % 500)


def raw_syslog(spark: SparkSession, sf: str) -> DataFrame:
    """BSD-style lines."""
    raw = F.concat(
        _pri(), F.date_format("ts", "MMM dd HH:mm:ss"), F.lit(" "), _host(), F.lit(" "), _process(),
        F.lit("["), _pid(), F.lit("]: "), line_body(),
    )
    return table(spark, sf, "events").select("event_id", "ts", "user_id", raw.alias("raw"))


def raw_mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of five shapes, one of them with an interior newline."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    day = F.date_format("ts", "yyyy-MM-dd")
    kind = F.col("event_id") % 6
    raw = (
        F.when(kind == 0, F.concat(
            _pri(), _process(), F.lit("#"), _pid(), F.lit(" "), _host(), F.lit(" "), F.date_format("ts", "MMM dd HH:mm:ss"),
            F.lit(" "), line_body()))
        .when(kind == 1, F.concat(
            _pri(), F.lit("v1 "), iso, F.lit(" "), _host(), F.lit("/"), _process(), F.lit("/"), _pid(),
            F.lit(" ID"), _text(F.col("event_id") % 7), F.lit("={-} "), line_body()))
        .when(kind == 2, F.concat(
            _pri(), F.lit("main! "), _host(), F.lit("~"), _process(), F.lit("~ "), day, F.lit(" "), line_body()))
        .when(kind == 3, F.concat(_pri(), _host(), F.lit("@ "), day, F.lit(" "), line_body()))
        .when(kind == 4, F.concat(F.lit("no priority "), line_body()))
        .otherwise(F.concat(_pri(), F.lit("& first\n"), line_body()))
    )
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", raw.alias("raw"))


def raw_rfc5424(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(
        _pri(), F.lit("1 "), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit(" "), _host(), F.lit(" "),
        _process(), F.lit(" "), F.when(F.col("event_id") % 3 == 0, F.lit("-")).otherwise(_pid()), F.lit(" "),
        F.when(F.col("event_id") % 4 == 0, F.lit("-")).otherwise(F.concat(F.lit("ID"), _text(F.col("event_id") % 7))),
        F.lit(" "),
        F.when(F.col("event_id") % 2 == 0, F.lit("-")).otherwise(F.lit('[x@1 a="b"][y@1]')),
        F.lit(" "), F.when(F.col("event_id") % 5 == 0, F.lit("BOM")).otherwise(F.lit("")), line_body(),
    )
    return table(spark, sf, "events").select("event_id", "ts", raw.alias("raw"))


def raw_syslogng(spark: SparkSession, sf: str) -> DataFrame:
    ident = F.when(F.col("event_id") % 3 == 0, F.lit("main: ")).otherwise(F.lit(""))
    stamp = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.date_format("ts", "MMM dd HH:mm:ss"))
    process = F.when(F.col("event_id") % 5 == 0, F.lit("")).when(
        F.col("event_id") % 5 == 1, F.concat(_process(), F.lit(": "))
    ).otherwise(F.concat(_process(), F.lit("["), _pid(), F.lit("]: ")))
    raw = F.concat(_pri(), ident, stamp, F.lit(" "), _host(), F.lit(" "), process, line_body())
    return table(spark, sf, "events").select("event_id", "ts", raw.alias("raw"))


def raw_forwarded(spark: SparkSession, sf: str) -> DataFrame:
    """Lines for the custom format: optional id, day, host, then process text."""
    ident = F.when(F.col("event_id") % 3 == 0, F.lit("main: ")).otherwise(F.lit(" "))
    process = F.when(F.col("event_id") % 5 == 0, F.lit("")).when(
        F.col("event_id") % 5 == 1, F.concat(_process(), F.lit(": "))
    ).otherwise(F.concat(_process(), F.lit("["), _pid(), F.lit("]: ")))
    text = F.concat(F.lit("user "), _text(F.col("user_id")), F.lit(" did "), F.col("event_type"))
    raw = F.concat(_pri(), ident, F.date_format("ts", "yyyy-MM-dd"), F.lit(" "), _host(), F.lit(" "), process, text)
    return table(spark, sf, "events").select("event_id", "ts", raw.alias("raw"))


def parsed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Message columns without going through text, for operators that start there."""
    events = table(spark, sf, "events")
    code = priority_of(F.col("event_id"), F.col("event_type"))
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), "user_id", "event_type",
        facility_of(code).alias("facility"), severity_of(code).alias("severity"),
        _host().alias("hostname"),
        F.when(F.col("event_id") % 7 != 0, _process()).alias("process_name"),
        F.when(F.col("event_id") % 5 != 0, _pid().cast("int")).alias("process_id"),
        line_body().alias("message"),
        ip_of(F.col("user_id")).alias("source_address"),
        F.lit("00000000").alias("system_id"),
    )


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.col("c_custkey").alias("nodeid"), F.col("c_name").alias("label"), F.col("n_name").alias("location"),
        F.col("c_mktsegment").alias("foreign_source"),
        F.concat(F.lit("f"), _text(F.col("c_custkey"))).alias("foreign_id"),
    )


def interfaces(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey")
    return joined.select(
        key.alias("nodeid"), F.col("n_name").alias("location"), ip_of(key).alias("ip"),
        F.when(key % 5 != 0, F.concat(F.lit("host"), _text(key % 20))).alias("hostname"),
        F.when(key % 3 != 0, F.concat(F.lit("eth"), _text(key % 4))).alias("if_alias"),
    )


def assets(spark: SparkSession, sf: str) -> DataFrame:
    """Every fourth node has none."""
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.filter(F.col("c_custkey") % 4 != 0).select(
        F.col("c_custkey").alias("nodeid"), F.col("c_mktsegment").alias("category"), F.col("n_name").alias("region"),
    )


def hardware(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf, "part").select(
        key.alias("id"), (key % 50).alias("nodeid"), F.floor(key / 50).cast("bigint").alias("ent_index"),
        F.col("p_name").alias("ent_name"), F.col("p_brand").alias("model"),
    )


def node_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with a node, an interface and ordered parms."""
    joined = table(spark, sf, "events").join(
        table(spark, sf, "customer").select("c_custkey", "c_nationkey"), F.col("user_id") == F.col("c_custkey"), "left"
    ).join(table(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        "event_id", F.col("ts").cast("timestamp").alias("time"), "user_id", "event_type", "props", "value",
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("nodeid"),
        F.col("n_name").alias("location"), ip_of(F.col("user_id")).alias("interface"),
        F.concat(F.lit("uei.example.org/"), F.col("event_type")).alias("uei"),
    )


def parm_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events with ordered parms: user, kind, amount, and a dotted name."""
    user = _text(F.col("user_id"))
    parms = F.array(
        parm("user", user),
        parm(" kind ", F.col("event_type")),
        parm("amount", _text(F.round(F.col("value") * 100).cast("bigint"))),
        parm(F.concat(F.lit(".1.3."), _text(F.col("event_id") % 5), F.lit("."), user, F.lit(".9")), F.col("props")),
    )
    base = node_events(spark, sf)
    return base.withColumn("parms", parms.cast(PARM_TYPE)).drop("value")


def packets(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), ip_of(F.col("user_id")).alias("source_ip"),
        (1024 + F.col("event_id") % 3).alias("source_port"), F.length("props").alias("size_bytes"),
    )


def event_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.concat(
        F.lit("uei.example.org/"), F.col("event_type"), F.lit("/u"), _text(F.col("user_id") % 10), F.lit("/e")
    ).alias("uei"))
