"""Mix sources to target weights: fixed-length blocks, drawn per output shard. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import compute_once
from .common import fresh, parts_for, with_row_key, written

#: What counts as a token: a run of anything but space and 0x09-0x0D.
TOKEN = r"[^\x20\x09-\x0D]+"
_GAP = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixRules:
    """``block``: tokens in a block. ``shard_slots``: blocks in an output shard. ``weights``: given
    to the sources in code point order, over and over. ``cap``: times a source may be used."""

    block: int = 64
    shard_slots: int = 4096
    weights: tuple[int, ...] = (1, 2, 3)
    cap: int = 3
    seed: int = 17
    rounds: int = 24


#: Documents whose running size one task works out, and groups of them added up by one.
CHUNK_DOCS, CHUNK_GROUP = 256, 4096


def permuted(x: Column, n: Column, seed: Column, rounds: int, inverse: bool = False) -> Column:
    """Where ``x`` in 0..n-1 goes under a pseudorandom permutation of that range.

    A swap-or-not shuffle: each round pairs x with (key - x) mod n and swaps the two or not by
    a hash of the larger, so every round, and all of them, is a bijection for any n.
    """
    order = F.sequence(F.lit(rounds - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(rounds - 1))

    def swap(now: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(seed, r), n) - now, n)
        return F.when(F.pmod(F.xxhash64(seed, r, F.greatest(now, other)), F.lit(2)) == 0, other).otherwise(now)

    return F.aggregate(order, x, swap)


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``; a null text has no words."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(TOKEN)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """A row per source: ``source, source_no, source_size, weight, target, blocks, slots, first_slot``.

    Targets share out all words by weight. A source stops at ``cap`` times its size; what it
    leaves is shared among the others by weight. Filling from the source that fills first,
    source i is full just when its fill level is under the level of all that are left. The
    windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, rules.weights)), (F.pmod(F.col("source_no"), F.lit(len(rules.weights))) + 1).cast("int"))
    by_level = Window.orderBy("level", "source_no")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    named = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
             .withColumn("source_no", F.row_number().over(by_name) - 1).withColumn("weight", weight)
             .withColumn("most", rules.cap * F.col("source_size")).withColumn("level", F.col("most") / F.col("weight"))
             .withColumn("total", F.sum("source_size").over(whole)).withColumn("weights", F.sum("weight").over(whole)))
    left = named.withColumn("share", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0)))
                            / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    full = F.col("level") <= F.col("share")
    # Behind the first source that isn't full no other is.
    open_level = F.min_by("share", F.when(~full, F.struct("level", "source_no"))).over(whole)
    target = F.when(full, F.col("most").cast("double")).otherwise(open_level * F.col("weight"))
    # A block holds source_size / blocks words on average, the last one being shorter.
    slots = F.least(F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1))).cast("long"), rules.cap * F.col("blocks"))
    return (left.withColumn("target", target)
            .withColumn("blocks", F.ceil(F.col("source_size") / rules.block).cast("long")).withColumn("slots", slots)
            .withColumn("first_slot", F.sum("slots").over(by_name) - F.col("slots"))
            .withColumn("all_slots", F.sum("slots").over(whole))
            .select("source", "source_no", "source_size", "n_docs", "weight", "target", "blocks", "slots", "first_slot", "all_slots"))


def packed(sizes: DataFrame, sources: DataFrame, rules: MixRules, n_docs: int) -> DataFrame:
    """Each document's place in its source's token stream: ``doc_id, source_no, size, begin, row_no``.

    Documents are dealt into chunks by a hash; running sums go within a chunk, then over
    chunks in groups, then over groups, so no source is summed up in one task.
    """
    chunks = max(1, -(-n_docs // CHUNK_DOCS))
    numbered = sizes.join(sources.select("source", "source_no"), sizes.source.eqNullSafe(sources.source)).select(
        "doc_id", "source_no", "size", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"))
    inside = Window.partitionBy("source_no", "chunk").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    at = numbered.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    of_chunk = numbered.groupBy("source_no", "chunk").agg(F.sum("size").alias("chunk_size"))
    group = F.floor(F.col("chunk") / CHUNK_GROUP)
    in_group = Window.partitionBy("source_no", "group").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    over_groups = Window.partitionBy("source_no").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    of_group = of_chunk.groupBy("source_no", group.alias("group")).agg(F.sum("chunk_size").alias("group_size")).select(
        "source_no", "group", F.coalesce(F.sum("group_size").over(over_groups), F.lit(0)).alias("group_begin"))
    chunk_begin = of_chunk.withColumn("group", group).withColumn(
        "in_group", F.coalesce(F.sum("chunk_size").over(in_group), F.lit(0))).join(of_group, ["source_no", "group"]).select(
        "source_no", "chunk", (F.col("group_begin") + F.col("in_group")).alias("chunk_begin"))
    return at.join(chunk_begin, ["source_no", "chunk"]).select(
        "doc_id", "source_no", "size", (F.col("chunk_begin") + F.col("inside")).alias("begin"))


def drawn_slots(sources: DataFrame, rules: MixRules) -> DataFrame:
    """``shard, slot, source_no, block, pass``: which block fills each slot of the output.

    Each source owns as many slots as its target fills, and a permutation of all slots says
    where they stand, so that a shard's counts are a multinomial draw under the condition that
    all shards together meet the targets. A source's n-th slot takes the block that its own
    permutation puts n-th; after all blocks it starts over.
    """
    # Each task makes the slots of some pieces; the planner takes their number for that of the sources, so
    # it is told how many tasks to use here, and not to broadcast what comes out.
    step = 32768
    n_pieces = sources.agg(F.coalesce(F.sum(F.ceil(F.col("slots") / step)), F.lit(0))).first()[0]
    tasks = parts_for(sources.sparkSession, int(n_pieces), 8)
    piece = (sources.filter("slots > 0").select("source_no", "blocks", "slots", "first_slot", "all_slots",
             F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / step))).alias("piece"))
             .repartition(tasks, "source_no", "piece"))
    nth = piece.select("source_no", "blocks", "first_slot", "all_slots", F.explode(F.sequence(
        F.col("piece") * step, F.least((F.col("piece") + 1) * step, F.col("slots")) - 1)).alias("nth"))
    slot = permuted(F.col("first_slot") + F.col("nth"), F.col("all_slots"), F.lit(rules.seed), rules.rounds)
    block = permuted(F.pmod(F.col("nth"), F.col("blocks")), F.col("blocks"), F.col("source_no") + F.lit(1000 + rules.seed), rules.rounds)
    return nth.select(slot.alias("slot"), "source_no", block.alias("block"), F.floor(F.col("nth") / F.col("blocks")).alias("pass")).select(
        F.floor(F.col("slot") / rules.shard_slots).alias("shard"), "slot", "source_no", "block", "pass")


def block_pieces(placed: DataFrame, rules: MixRules) -> DataFrame:
    """``source_no, block, doc_id, begin, size, from_word, to_word``: the words of a document in each of its blocks."""
    last = F.floor((F.col("begin") + F.col("size") - 1) / rules.block)
    cut = placed.filter("size > 0").select("*", F.explode(F.sequence(F.floor(F.col("begin") / rules.block), last)).alias("block"))
    return cut.select(
        "source_no", "block", "doc_id", "begin", "size",
        F.greatest(F.lit(0), F.col("block") * rules.block - F.col("begin")).alias("from_word"),
        F.least("size", (F.col("block") + 1) * rules.block - F.col("begin")).alias("to_word"))


@dataclass(frozen=True)
class Mix:
    """Tables of a mix: see the functions that make them."""

    placed: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def plan_mix(docs: DataFrame, rules: MixRules = MixRules()) -> Mix:  # noqa: B008
    """Plan a mix of all documents.

    Null texts have no words; a null source is a source of its own, the last. An empty table,
    or one without words, gives no slots. Repeated rows are documents of their own.
    """
    sizes = written(sized(docs), "mix-sizes")
    sources = written(source_targets(sizes, rules), "mix-sources")
    placed = written(packed(sizes, sources, rules, sizes.count()), "mix-places")
    return Mix(placed, sources, drawn_slots(sources, rules), block_pieces(placed, rules))


def shard_counts(mix: Mix) -> DataFrame:
    """``shard, source, n_slots``: the drawn counts."""
    return mix.slots.groupBy("shard", "source_no").agg(F.count("*").alias("n_slots")).join(
        mix.sources.select("source_no", "source"), "source_no").select("shard", "source", "n_slots")


def mixed_pieces(mix: Mix) -> DataFrame:
    """``shard, slot, doc_id, from_word, to_word``: the mixed stream, in pieces of documents."""
    return mix.slots.hint("merge").join(mix.pieces.hint("merge"), ["source_no", "block"]).select("shard", "slot", "doc_id", "from_word", "to_word")


def taken_words(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:  # noqa: B008
    """``doc_id, size, source_size, target, taken``, a row per row of ``docs``; see ``plan_mix``."""
    mix = plan_mix(docs, rules)
    uses = mix.slots.groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    taken = (mix.pieces.join(uses.hint("merge"), ["source_no", "block"]).groupBy("source_no", "begin")
             .agg(F.sum((F.col("to_word") - F.col("from_word")) * F.col("uses")).alias("words")))
    # A document without words shares its place with the next one, and takes none.
    rows = mix.placed.withColumn("place", F.when(F.col("size") > 0, F.col("begin")))
    taken = taken.select(F.col("source_no").alias("no"), F.col("begin").alias("place_of"), "words")
    out = rows.join(taken.hint("merge"), (rows.source_no == taken.no) & (rows.place == taken.place_of), "left")
    totals = mix.sources.select("source_no", "source_size", "target")
    return out.join(totals, "source_no").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, rules: MixRules = MixRules()) -> DataFrame:  # noqa: B008
    """The mix as documents: a row per document and pass over its source, with the columns of ``docs``.

    A pass that takes the whole document keeps its text; another has the taken words, in
    order and joined by one space. ``n_chars`` follows the text where ``docs`` has it. Documents
    without a taken word are not in the mix. Rows with a null id, and different texts of one id, are
    documents of their own (``with_row_key``).
    """
    names = docs.columns
    row, doc, nth, begin, size, n, pieces = fresh(docs, "_row", "_doc", "_pass", "_begin", "_size", "_n", "_runs")
    keyed = with_row_key(docs, row)
    mix = plan_mix(keyed.select(F.col(row).alias("doc_id"), "text", "source"), rules)
    runs = (mix.slots.select("source_no", "block", "pass").hint("merge").join(mix.pieces, ["source_no", "block"])
            .groupBy(F.col("doc_id").alias(doc), F.col("pass").alias(nth), F.col("begin").alias(begin), F.col("size").alias(size))
            .agg(F.sum(F.col("to_word") - F.col("from_word")).alias(n),
                 F.sort_array(F.collect_list(F.struct(F.col("from_word").cast("int").alias("at"),
                                                      F.col("to_word").cast("int").alias("to")))).alias(pieces)))
    once = keyed.dropDuplicates([row])
    out = once.join(runs.hint("merge"), once[row] == runs[doc])
    words = F.filter(F.split("text", _GAP), lambda w: w != "")
    some = F.array_join(F.flatten(F.transform(pieces, lambda r: F.slice(words, r["at"] + 1, r["to"] - r["at"]))), " ")
    text = F.when(F.col(n) == F.col(size), F.col("text")).otherwise(some)
    out = compute_once(out, {"text": text})
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
