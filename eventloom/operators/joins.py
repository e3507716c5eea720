"""The left join behind every lookup, and columns that are computed only once."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Parts that rows without a key go to in a shuffled lookup.
_KEYLESS_PARTS = 4096
_PLAIN_TYPES = ("string", "bigint", "int", "timestamp", "double", "date", "boolean", "smallint", "decimal")


def lookup_join(
    df: DataFrame, dim: DataFrame, on: dict[str, str], salts: int = 1, spread: list[str] | None = None,
) -> DataFrame:
    """Left join ``df`` to a dimension on ``{df column: dim column}`` pairs; dim keys go.

    No hint is set: Spark broadcasts the dimension only while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both sides, where
    adaptive execution splits a hot key on the left. Rows with a null in their key find nothing and
    are kept; in a shuffle they go to parts of their own, chosen by the ``spread`` columns (all plain
    ones by default), and not to one task. ``salts`` > 1 splits hot keys
    up front instead: rows with one key go to that many tasks, chosen by the ``spread``
    columns (together near unique), and the dimension is repeated once per salt.
    """
    renamed = {dim_col: f"_key_{i}" for i, dim_col in enumerate(dict.fromkeys(on.values()))}
    right = dim.withColumnsRenamed(renamed)
    keys: list[Column] = [F.col(c) == F.col(renamed[d]) for c, d in on.items()]
    drop = list(renamed.values())
    by = spread or [c for c, t in df.dtypes if t.startswith(_PLAIN_TYPES)] or list(on)
    keyless = reduce(or_, [F.col(c).isNull() for c in on])
    part = F.pmod(F.xxhash64(*by), F.lit(_KEYLESS_PARTS)).cast("int") + 1
    df = df.withColumn("_part", F.when(keyless, part).otherwise(0))
    # Part 0 of the dimension is no literal, which the optimizer would take out of the join's keys.
    right = right.withColumn("_part_r", F.pmod(F.hash(*renamed.values()), F.lit(1)))
    keys.append(F.col("_part") == F.col("_part_r"))
    drop += ["_part", "_part_r"]
    if salts > 1:
        by = spread or [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
        right = right.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        keys.append(F.col("_salt") == F.col("_salt_r"))
        drop += ["_salt", "_salt_r"]
    condition = keys[0]
    for key in keys[1:]:
        condition = condition & key
    return df.join(right, condition, "left").drop(*drop)


def one_per_key(dim: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the least of its other columns taken together, nulls last.

    A lookup then never multiplies rows. Minima combine before the shuffle.
    """
    others = [c for c in dim.columns if c not in keys]
    if not others:
        return dim.distinct()
    order = [x for c in others for x in (F.col(c).isNull(), F.col(c))]
    least = F.min_by(F.struct(*others), F.struct(*[x.alias(f"o{i}") for i, x in enumerate(order)]))
    return dim.groupBy(*keys).agg(least.alias("_least")).select(*keys, "_least.*")


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add expensive columns so that each is evaluated once per row.

    The finished columns pass through a generator of exactly one row. The optimizer does not
    push filters through a generator's output or inline it, so a long rule or pattern chain
    is neither repeated in every later filter nor multiplied inside the plan.
    """
    held = {n: f"_once_{n}" for n in columns}
    kept = [c for c in df.columns if c not in columns]
    computed = df.withColumns({held[n]: c for n, c in columns.items()})
    return computed.select(*kept, F.inline(F.array(F.struct(*[F.col(h).alias(n) for n, h in held.items()]))))
