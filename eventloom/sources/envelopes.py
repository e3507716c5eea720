"""Log envelopes: an XML element around base64 messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import compute_once

_SCHEMA = (
    "`_source-address` string, `_source-port` int, `_system-id` string, `_location` string, "
    "messages array<struct<_timestamp:string,_VALUE:string>>, _corrupt_record string"
)


def read_envelopes(df: DataFrame, col: str = "value") -> DataFrame:
    """A row per message, with the envelope's columns, ``message_no`` and the text ``raw``, trailing NULs cut off.

    An envelope without a message, or one that cannot be read, is a row with a null ``raw``.
    """
    record = F.from_xml(F.col(col), F.lit(_SCHEMA), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    payload = F.regexp_replace(F.col("_message._VALUE"), r"\s+", "")
    # Bytes beyond ASCII have no text of their own and read as the replacement character.
    text = F.regexp_replace(F.decode(F.try_to_binary(payload, F.lit("base64")), "ISO-8859-1"), r"[^\x00-\x7f]", "�")
    read = compute_once(df, {"_envelope": record})
    each = read.select("*", F.posexplode_outer("_envelope.messages").alias("message_no", "_message"))
    return each.withColumns({
        "source_address": F.col("_envelope.`_source-address`"),
        "source_port": F.col("_envelope.`_source-port`"),
        "system_id": F.col("_envelope.`_system-id`"),
        "location": F.col("_envelope.`_location`"),
        "msg_time": F.try_to_timestamp(F.col("_message._timestamp")),
        "raw": F.regexp_replace(text, r"\x00+$", ""),
    }).drop("_envelope", "_message")
