"""Batches per source, order and caps inside a log, receipts, metrics.

No operator here puts a whole source into one task: numbering works on time slices of a
source, and running totals only on the slice counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def time_slice(ts: str, seconds: float) -> Column:
    """Start of the slice that holds ``ts``. Unlike ``window`` it keeps rows without a time."""
    micros, width = F.unix_micros(F.col(ts).cast("timestamp")), int(seconds * 1_000_000)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))


def _same(names: list[str], suffix: str) -> Column:
    same = F.lit(True)
    for k in names:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}{suffix}"))
    return same


# Bounds are searched in three levels of this many bits, as a row carries the list it is compared with.
_LEVEL_BITS = 8


def _at_most(bounds: Column, value: Column) -> Column:
    """How many of up to 255 sorted ``bounds`` are not above ``value``, by halving; 0 without bounds."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(_LEVEL_BITS))])
    return F.when(bounds.isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), lambda low, step: F.when(
        (low + step <= F.size(bounds)) & (F.get(bounds, low + step - 1) <= value), low + step).otherwise(low)))


def _sub_slices(sliced: DataFrame, keys: list[str], ts: str, order: list[str], counts: DataFrame, slice_rows: int) -> DataFrame:
    """Add ``_sub``: slices of more than ``slice_rows`` rows are cut at bounds in (ts, order).

    The bounds are every 16th of a sample by hash that holds about 16 rows per part, so that a run
    repeats them. Only such slices are sampled; the others are part 0. A row finds its part from level
    to level, each with a short list, so that its work grows with the logarithm of the number of parts.
    """
    by, place = [*keys, "_slice"], F.struct(ts, *order)
    hot = counts.filter(F.col("_n") > slice_rows).select(*[F.col(k).alias(f"{k}_h") for k in by])
    sampled = sliced.filter(F.pmod(F.xxhash64(ts, *order), F.lit(max(1, slice_rows // 16))) == 0)
    bounds = sampled.join(F.broadcast(hot), _same(by, "_h"), "left_semi").groupBy(*by).agg(F.array_sort(F.collect_list(place)).alias("_all")).select(
        *[F.col(k).alias(f"{k}_b") for k in by], F.posexplode(F.filter("_all", lambda x, i: i % 16 == 15)).alias("_no", "_bound"))
    joined = sliced.withColumn("_sub", F.lit(0))
    for bits in range(2 * _LEVEL_BITS, -1, -_LEVEL_BITS):
        # The last bound of every 2^bits, but for those that the level above has compared.
        last = F.col("_no") + 1
        ends = (F.pmod(last, F.lit(1 << bits)) == 0) & ((F.pmod(last, F.lit(1 << (bits + _LEVEL_BITS))) != 0) | F.lit(bits == 2 * _LEVEL_BITS))
        group = F.lit(0) if bits == 2 * _LEVEL_BITS else F.shiftright("_no", bits + _LEVEL_BITS)
        lists = bounds.filter(ends).groupBy(*[f"{k}_b" for k in by], group.alias("_group")).agg(
            F.array_sort(F.collect_list("_bound")).alias("_bounds"))
        found = joined.join(F.broadcast(lists), _same(by, "_b") & (F.col("_sub") == F.col("_group")), "left")
        sub = F.col("_sub") * (1 << (_LEVEL_BITS if bits < 2 * _LEVEL_BITS else 0)) + _at_most(F.col("_bounds"), place)
        joined = found.withColumn("_sub", sub).drop("_bounds", "_group", *[f"{k}_b" for k in by])
    return joined


def _offsets(counts: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """Per part of a key, the rows of all parts before it (``_before``); names get ``_o`` behind them."""
    before = Window.partitionBy(*keys).orderBy(*[F.col(p).asc_nulls_first() for p in parts]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return offsets.withColumnsRenamed({k: f"{k}_o" for k in [*keys, *parts]})


def number_rows(
    df: DataFrame, keys: list[str], ts: str, order: list[str], slice_seconds: float = 3600, out: str = "rn", slice_rows: int = 1_000_000,
) -> DataFrame:
    """Exact row number per key by (ts, order), nulls first, without gathering a key.

    Rows are numbered inside (key, time slice); the counts of earlier slices are added. A slice of more
    than ``slice_rows`` rows, such as a source with all its rows in one second, is cut into parts of
    about that size, each numbered by a task of its own.
    """
    sliced = df.withColumn("_slice", time_slice(ts, slice_seconds))
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    cut = _sub_slices(sliced, keys, ts, order, counts, slice_rows)
    parts = ["_slice", "_sub"]
    offsets = _offsets(cut.groupBy(*keys, *parts).agg(F.count(F.lit(1)).alias("_n")), keys, parts)
    inside = Window.partitionBy(*keys, *parts).orderBy(
        F.col(ts).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]
    )
    numbered = cut.withColumn("_in_slice", F.row_number().over(inside))
    return (
        numbered.join(offsets, _same([*keys, *parts], "_o"))
        .withColumn(out, F.col("_in_slice") + F.col("_before"))
        .drop(*parts, "_in_slice", "_before", *[f"{k}_o" for k in [*keys, *parts]])
    )


def batch_by_source(
    df: DataFrame, size: int, interval: float | None = None, keys: tuple[str, ...] = ("source_ip", "source_port"),
    ts: str = "ts", order: tuple[str, ...] = ("event_id",), payload: str | None = None, slice_seconds: float = 3600,
) -> DataFrame:
    """One row per batch of a source: full at ``size`` items, or at the end of ``interval`` seconds.

    ``payload`` names a column to gather in order; a batch holds at most ``size`` of them.
    """
    by = list(keys)
    if interval is None:
        numbered = number_rows(df, by, ts, list(order), slice_seconds)
        slot: list[str] = []
    else:
        by_slot = df.withColumn("slot", time_slice(ts, interval))
        inside = Window.partitionBy(*by, "slot").orderBy(F.col(ts).asc_nulls_first(), *order)
        numbered, slot = by_slot.withColumn("rn", F.row_number().over(inside)), ["slot"]
    numbered = numbered.withColumn("batch_no", F.floor((F.col("rn") - 1) / size).cast("bigint"))
    aggs = [F.count(F.lit(1)).alias("items"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")]
    if payload:
        gathered = F.array_sort(F.collect_list(F.struct("rn", payload)))
        aggs.append(F.transform(gathered, lambda x: x[payload]).alias("payloads"))
    return numbered.groupBy(*by, *slot, "batch_no").agg(*aggs)


def sort_events(df: DataFrame, log: str = "log_id", time: str = "time", seq: str = "seq") -> DataFrame:
    """Ascending time inside each log, null first, ties in arrival order."""
    return df.orderBy(F.col(log), F.col(time).asc_nulls_first(), F.col(seq))


def cap_per_connection(
    df: DataFrame, n: int, connection: tuple[str, ...] = ("connection",), ts: str = "ts",
    order: tuple[str, ...] = ("seq",), slice_seconds: float = 3600,
) -> DataFrame:
    """The first ``n`` records of every connection; -1 keeps all.

    Each task keeps the first ``n`` of a (connection, slice) before anything is shuffled, so that a busy
    connection sends few rows; slices behind the ``n``-th record send none further.
    """
    if n < 0:
        return df
    keys = list(connection)
    sliced = df.withColumn("_slice", time_slice(ts, slice_seconds))
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, keys, ["_slice"]).filter(F.col("_before") < n)
    inside = Window.partitionBy(*keys, "_slice").orderBy(
        F.col(ts).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    first = sliced.withColumn("_in_slice", F.row_number().over(inside)).filter(F.col("_in_slice") <= n)
    return (
        first.join(offsets, _same([*keys, "_slice"], "_o"))
        .filter(F.col("_in_slice") + F.col("_before") <= n)
        .drop("_slice", "_in_slice", "_before", *[f"{k}_o" for k in [*keys, "_slice"]])
    )


def receipts(
    df: DataFrame, by: tuple[str, ...] = ("sender", "log_id"), uuid: str = "uuid"
) -> DataFrame:
    """The distinct uuids accepted per sender and document. Events without one get no
    receipt. A document bounds the list, so ``by`` should hold the document."""
    return (
        df.filter(F.col(uuid).isNotNull())
        .select(*by, uuid).distinct()
        .groupBy(*by).agg(F.sort_array(F.collect_list(uuid)).alias("uuids"))
    )


def ingest_metrics(
    df: DataFrame, seconds: float, ts: str = "ts", size: str = "size_bytes", by: tuple[str, ...] = ()
) -> DataFrame:
    """Count, rate and size spread per time slot. All parts combine before the shuffle:
    the exact percentiles keep one counter per distinct size."""
    return df.withColumn("slot", time_slice(ts, seconds)).groupBy("slot", *by).agg(
        F.count(F.lit(1)).alias("packets"),
        F.sum(size).cast("bigint").alias("bytes"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
        F.percentile(size, F.lit(0.5)).alias("p50_size"),
        F.percentile(size, F.lit(0.95)).alias("p95_size"),
    ).withColumn("rate", F.col("packets") / F.lit(float(seconds)))
