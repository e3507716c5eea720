"""Event log documents: consecutive XML ``<log>`` elements in a byte stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import PARM_TYPE, empty_parms
from ..functions.times import parse_iso_time
from ..operators.joins import compute_once

# A record runs from the first "<" after the one before to the next closing tag; what is left
# behind the last closing tag, if it is more than blanks, is a record too, and a broken one.
_RECORD = r"(?s)<.*?</(?:[a-zA-Z0-9]+:)?log>|\S(?!.*?</(?:[a-zA-Z0-9]+:)?log>).*\z"
_CLOSED = r"</(?:[a-zA-Z0-9]+:)?log>\z"
_TAG_PREFIX = r"(</?)[A-Za-z0-9]+:"
_EVENT = (
    "struct<_uuid:string,dbid:bigint,uei:string,source:string,nodeid:bigint,time:string,host:string,"
    "interface:string,ifindex:int,snmphost:string,service:string,severity:string,descr:string,"
    "logmsg:struct<_dest:string,_VALUE:string>,operinstruct:string,mouseovertext:string,"
    "pathoutage:string,distPoller:string,"
    "snmp:struct<id:string,idtext:string,version:string,community:string,generic:int,specific:int>,"
    "parms:struct<parm:array<struct<parmName:string,"
    "value:struct<_type:string,_encoding:string,_expand:boolean,_VALUE:string>>>>>"
)
_LOG = f"header struct<dpName:string>, events struct<event:array<{_EVENT}>>, _corrupt_record string"
_LONG_TIME = "MMMM d, yyyy h:mm:ss a z"
_WEEKDAY = r"^\s*[A-Za-z]+,\s*"


def split_documents(df: DataFrame, text: str, log_id: list[str]) -> DataFrame:
    """One row per record of a stream, with its position and parsed form."""
    return _parsed(df.select(*log_id, F.posexplode(F.regexp_extract_all(text, F.lit(_RECORD), F.lit(0))).alias("doc_no", "doc")))


def _parsed(docs: DataFrame) -> DataFrame:
    plain = F.regexp_replace("doc", _TAG_PREFIX, "$1")
    log = F.from_xml(plain, F.lit(_LOG), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return compute_once(docs, {"log": log})


def _time(col: Column) -> Column:
    # Spark reads no weekday, which says nothing that the date doesn't.
    plain = F.regexp_replace(F.regexp_replace(col, _WEEKDAY, ""), r"\s+", " ")
    return F.coalesce(parse_iso_time(col), F.try_to_timestamp(plain, F.lit(_LONG_TIME)))


def _parms(col: Column) -> Column:
    shaped = F.transform(col, lambda p: F.struct(
        p["parmName"].alias("name"), p["value"]["_VALUE"].alias("value"),
        F.coalesce(p["value"]["_type"], F.lit("string")).alias("type"),
        F.coalesce(p["value"]["_encoding"], F.lit("text")).alias("encoding"),
        F.coalesce(p["value"]["_expand"], F.lit(False)).alias("expand"),
    ))
    return F.coalesce(shaped.cast(PARM_TYPE), empty_parms())


def read_documents(df: DataFrame, text: str, log_id: list[str]) -> tuple[DataFrame, DataFrame]:
    """(events, rejected documents) of text that holds log documents."""
    return _events_and_rejects(split_documents(df, text, log_id), log_id)


def _event_rows(docs: DataFrame, log_id: list[str]) -> DataFrame:
    """A row per event and per rejected document, told apart by ``rejected``; ``doc`` is kept of the latter only."""
    bad = F.col("log").isNull() | F.col("log._corrupt_record").isNotNull() | ~F.col("doc").rlike(_CLOSED)
    flagged = compute_once(docs, {"rejected": F.coalesce(bad, F.lit(True))})
    none = F.array(F.lit(None).cast(_EVENT))
    rows = flagged.select(
        *log_id, "doc_no", "rejected", F.when(F.col("rejected"), F.col("doc")).alias("doc"),
        F.when(~F.col("rejected"), F.col("log.header.dpName")).alias("header_dp"),
        F.posexplode(F.when(F.col("rejected"), none).otherwise(F.col("log.events.event"))).alias("seq", "e"),
    )
    plain = ["dbid", "uei", "source", "nodeid", "host", "interface", "ifindex", "snmphost", "service",
             "severity", "descr", "operinstruct", "mouseovertext", "pathoutage", "snmp"]
    return rows.select(
        *log_id, "doc_no", "seq", "header_dp", F.col("e._uuid").alias("uuid"),
        *[F.col(f"e.{c}") for c in plain],
        F.col("e.distPoller").alias("dist_poller"),
        _time(F.col("e.time")).alias("time"),
        F.when(F.col("e.logmsg").isNotNull(), F.struct(
            F.col("e.logmsg._dest").alias("dest"), F.col("e.logmsg._VALUE").alias("content")
        )).alias("logmsg"),
        _parms(F.col("e.parms.parm")).alias("parms"), "rejected", "doc",
    )


def _events_and_rejects(docs: DataFrame, log_id: list[str]) -> tuple[DataFrame, DataFrame]:
    # Both parts come from one frame; the caller may persist what it reads twice.
    rows = _event_rows(docs, log_id)
    return rows.filter(~F.col("rejected")).drop("rejected", "doc"), rows.filter("rejected").select(*log_id, "doc_no", "doc")


_SEPARATOR = "log>"


def split_log_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, doc_no, doc`` of plain files of any size, each read by as many tasks as it has splits.

    Files are cut at every ``log>``, which Spark's reader finds from any offset on. A piece that ends
    with a closing tag's beginning ends a document. Pieces have a place: their split's offset in the file
    and their row in the split. Closing tags are counted per split, and the counts of the splits before
    are added, so that no file is gathered; a document's pieces are joined in order of their places.
    Junk before a document is left out; what follows the last document is one too, but for blanks.
    """
    pieces = spark.read.option("lineSep", _SEPARATOR).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    ends = F.col("value").rlike(r"</(?:[a-zA-Z0-9]+:)?\z")
    split = pieces.groupBy("file", "block").agg(
        F.sum(ends.cast("long")).alias("ended"), F.sum(F.octet_length("value") + len(_SEPARATOR)).alias("bytes"), F.max("at").alias("final"))
    of_file = Window.partitionBy("file")
    split = split.select(
        "file", "block", "final",
        F.coalesce(F.sum("ended").over(of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.max("block").over(of_file).alias("last"), F.sum("bytes").over(of_file).alias("bytes"))
    placed = pieces.join(split, ["file", "block"])
    # The reader doesn't tell whether a file's last piece had a separator behind it; the file's size does.
    cut = (F.col("block") == F.col("last")) & (F.col("at") == F.col("final")) & (F.col("bytes") != F.col("size"))
    placed = placed.withColumn("closes", ends & ~cut).withColumn("open_end", cut)
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("doc_no", F.col("before") + F.coalesce(F.sum(F.col("closes").cast("long")).over(inside), F.lit(0)))
    docs = numbered.groupBy("file", "doc_no").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("pieces"),
        F.max("closes").alias("closed"), F.max("open_end").alias("open_end"))
    text = F.array_join(F.transform("pieces", lambda p: p["value"]), _SEPARATOR)
    whole = F.when(F.col("open_end"), text).otherwise(F.concat(text, F.lit(_SEPARATOR)))
    doc = F.when(F.col("closed"), F.regexp_extract(whole, r"(?s)<.*", 0)).otherwise(F.regexp_extract(whole, r"(?s)\S.*", 0))
    return docs.select("file", F.col("doc_no").cast("int").alias("doc_no"), doc.alias("doc")).filter(F.col("doc") != "")


def read_event_log_rows(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_event_logs`` gives as one frame, in which each document is parsed once: a row per event and
    per rejected document. ``rejected`` tells the latter, which keep their text in ``doc``."""
    return _event_rows(_parsed(split_log_files(spark, path)), ["file"])


def read_event_logs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events, rejected documents) of files. A file is one connection's stream; a plain one is read in
    splits (``split_log_files``), of which a document may cross any number."""
    return _events_and_rejects(_parsed(split_log_files(spark, path)), ["file"])


def read_whole_event_logs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """As ``read_event_logs``, with a task per file: for compressed files, which can't be split."""
    files = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return read_documents(files, "value", ["file"])
