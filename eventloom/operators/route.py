"""Who gets which event, by event name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def name_keys(uei: Column) -> Column:
    """The subscription keys of a name: all events, the name itself, and each directory
    prefix up to a ``/`` that is not its first character."""
    parts = F.split(uei, "/", -1)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda k: F.when(k < F.size(parts), F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))),
    )
    directories = F.filter(prefixes, lambda p: F.length(p) > 1)
    named = F.transform(F.array_distinct(F.concat(F.array(uei), directories)), lambda p: F.concat(F.lit("="), p))
    return F.when(uei.isNull() | (uei == ""), F.array(F.lit("*"))).otherwise(F.concat(F.array(F.lit("*")), named))


def routing_table(names: DataFrame, subscriptions: DataFrame, uei: str = "uei") -> DataFrame:
    """(uei, listeners) for the distinct names of a frame."""
    distinct = names.select(uei).distinct()
    keyed = subscriptions.select(
        "listener", F.coalesce(F.concat(F.lit("="), "uei"), F.lit("*")).alias("_key")
    ).distinct()
    return (
        distinct.withColumn("_key", F.explode(name_keys(F.col(uei))))
        .join(keyed, "_key")
        .groupBy(uei).agg(F.sort_array(F.collect_set("listener")).alias("listeners"))
    )


def route(df: DataFrame, subscriptions: DataFrame, uei: str = "uei", salts: int = 1) -> DataFrame:
    """One row per (event, listener), each listener once.

    ``subscriptions`` holds (listener, uei); a null name takes all events, one that ends
    in ``/`` a whole directory. Prefixes are walked once per distinct name, not per event,
    so events themselves are joined once, on the name, and never grouped. ``salts`` > 1 splits the events
    of a name up front, for streams, where Spark splits no hot key by itself.
    """
    table = routing_table(df, subscriptions, uei).withColumnRenamed(uei, "_name")
    same = F.col(uei).eqNullSafe(F.col("_name"))
    if salts > 1:
        plain = [c for c, t in df.dtypes if not t.startswith(("map", "array", "struct", "variant"))]
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))
        table = table.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same = same & (F.col("_salt") == F.col("_salt_r"))
    return (
        df.join(table, same)
        .withColumn("listener", F.explode("listeners"))
        .drop("_name", "listeners", "_salt", "_salt_r")
    )


def effective_subscriptions(changes: DataFrame) -> DataFrame:
    """(listener, uei) in force after a log of changes; a null name takes all events.

    ``changes`` holds (seq, listener, op, ueis). ``add_all`` replaces all names of the
    listener; ``add`` with names ends ``add_all`` and with none does nothing; ``remove``
    takes names away; ``remove_all`` takes everything.
    """
    listed = changes.filter(~((F.col("op") == "add") & (F.size(F.coalesce("ueis", F.array())) == 0)))
    wide = listed.filter(F.col("op") != "remove").groupBy("listener").agg(
        F.max_by("op", "seq").alias("mode"),
        F.max(F.when(F.col("op").isin("add_all", "remove_all"), F.col("seq"))).alias("cleared"),
    )
    named = (
        listed.filter(F.col("op").isin("add", "remove"))
        .select("seq", "listener", "op", F.explode("ueis").alias("uei"))
        .groupBy("listener", "uei").agg(F.max_by("op", "seq").alias("last"), F.max("seq").alias("at"))
        .filter(F.col("last") == "add")
    )
    specific = named.join(wide, "listener").filter(
        F.col("cleared").isNull() | (F.col("at") > F.col("cleared"))
    ).select("listener", "uei")
    everything = wide.filter(F.col("mode") == "add_all").select("listener", F.lit(None).cast("string").alias("uei"))
    return specific.union(everything)


def subscription_intervals(changes: DataFrame) -> DataFrame:
    """(listener, uei, start, stop): from which change to which a subscription is in force; a null ``stop`` is open.

    ``changes`` is as for ``effective_subscriptions``. A change holds from its own ``seq`` on. A name
    added again begins a further interval, so that those of a listener and name never overlap.
    """
    listed = changes.filter(~((F.col("op") == "add") & (F.size(F.coalesce("ueis", F.array())) == 0)))
    # Backwards, so that each minimum is the one before it and one more row; a frame that runs to the
    # end is worked out anew for every row.
    later = Window.partitionBy("listener").orderBy(F.col("seq").desc()).rowsBetween(Window.unboundedPreceding, -1)
    seen = listed.withColumns({
        "cleared": F.min(F.when(F.col("op").isin("add_all", "remove_all"), F.col("seq"))).over(later),
        "named": F.min(F.when(F.col("op") != "remove", F.col("seq"))).over(later),
    })
    each = seen.filter(F.col("op").isin("add", "remove")).select(
        "seq", "listener", "op", "cleared", F.explode(F.array_distinct("ueis")).alias("uei"))
    following = F.lead("seq").over(Window.partitionBy("listener", "uei").orderBy("seq"))
    specific = each.withColumn("next", following).filter(F.col("op") == "add").select(
        "listener", "uei", F.col("seq").alias("start"), F.least("next", "cleared").alias("stop"))
    everything = seen.filter(F.col("op") == "add_all").select(
        "listener", F.lit(None).cast("string").alias("uei"), F.col("seq").alias("start"), F.col("named").alias("stop"))
    return specific.union(everything)


def route_as_of(
    df: DataFrame, intervals: DataFrame, width: int, uei: str = "uei", seq: str = "seq",
) -> DataFrame:
    """One row per (event, listener): the listeners whose subscription was in force at the event's ``seq``.

    Time is cut into slots of ``width``; an interval is listed in each slot it touches up to the last
    event's. Lists are made once per (name, slot), with those who take all events, so that events are joined
    once, on both, are never multiplied by a key's whole history, and no list is shuffled with an event. The
    first and last slot are looked up at once. Events without a ``seq`` go to nobody.
    """
    slot = F.floor(F.col(seq) / width)
    low, high = df.agg(F.min(slot), F.max(slot)).first()
    low, high = F.lit(low).cast("bigint"), F.lit(high).cast("bigint")
    events = df.withColumn("_slot", slot)
    first, final = F.greatest(F.floor(F.col("start") / width), low), F.least(F.coalesce(F.floor(F.col("stop") / width), high), high)
    listed = (
        intervals.filter((first <= final) & low.isNotNull())
        .select("uei", F.struct("listener", "start", "stop").alias("_one"), F.explode(F.sequence(first, final)).alias("_slot"))
    )
    named = listed.filter(F.col("uei").isNotNull()).select(F.concat(F.lit("="), "uei").alias("_key"), "_slot", "_one")
    names = events.select(F.col(uei).alias("_name"), "_slot").filter("_slot is not null").distinct()
    keys = names.withColumn("_key", F.explode(F.filter(name_keys(F.col("_name")), lambda k: k != "*")))
    of_name = keys.join(named, ["_key", "_slot"]).select("_name", "_slot", "_one")
    of_all = listed.filter(F.col("uei").isNull()).select("_slot", "_one")
    of_all = names.join(of_all, "_slot").select("_name", "_slot", "_one")
    lists = of_name.union(of_all).groupBy("_name", F.col("_slot").alias("_of")).agg(F.collect_set("_one").alias("_listed"))
    joined = events.join(lists, F.col(uei).eqNullSafe(F.col("_name")) & (F.col("_slot") == F.col("_of")))
    inside = F.filter("_listed", lambda i: (i["start"] <= F.col(seq)) & (i["stop"].isNull() | (F.col(seq) < i["stop"])))
    listeners = F.array_distinct(F.transform(inside, lambda i: i["listener"]))
    return joined.withColumn("listener", F.explode(listeners)).drop("_slot", "_name", "_of", "_listed")


def has_listener(subscriptions: DataFrame) -> DataFrame:
    """(uei, has_listener) for every name that someone asks for by name."""
    return subscriptions.filter(F.col("uei").isNotNull()).groupBy("uei").agg(
        (F.count("listener") > 0).alias("has_listener")
    )
