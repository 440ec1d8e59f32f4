"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

A source is cut into equal blocks of its own, of ``block`` words at most and
shorter ones where its target would not fill LEAST_BLOCKS of them; its target in
blocks is its weight in the mix. Cumulative weights cut [0, 1) into a stretch per
source, at multiples of 1 / N for the first power of two N that holds all blocks.
The points are van der Corput's, the binary digits of 0, 1, 2, ... mirrored: the
first N are every multiple of 1 / N once. A point inside a stretch is a slot of
that source, a point past the last stretch is none, so every source gets exactly
its weight, and any first part of the schedule holds each source close to its
share. A source's slots are ranked in that order, and its rank r takes block r of
the source's documents, shuffled by a seeded hash and laid end to end; past its
last block a source starts over. Rows of the mix stand in slot order.

No source is one group anywhere: slots are ranked and words are counted in
chunks first, then over chunk totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, numbered, read, small, stored, whole_rows
from riskloom.operators.ordering import dense_key, running_totals

WEIGHTS, MOST_EPOCHS, SEED = (5, 2, 1), 3, 42
#: Words of a block, fewer where the corpus would not fill LEAST_SLOTS slots of that size.
BLOCK, LEAST_SLOTS = 4096, 1 << 17
#: Blocks that a source's target holds at least, down to blocks of one word: whole blocks miss a target by half of one.
LEAST_BLOCKS = 64
_CHUNK = 1 << 14  # slots ranked together
_ROWS = 1 << 12  # documents laid end to end together
#: Words of the mix in a file, when its documents are written in slot order.
_FILE_WORDS = 1 << 23


def sized(documents: DataFrame, seed: int = SEED, *key: str) -> DataFrame:
    """Stored rows with ``key``, ``_row``, the source, the number of words and the place in the shuffle, no texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return numbered(
        documents.select(
            *key, "doc_id", "source",
            F.size(F.array_remove(F.split(text, f"[{SPACE}]+"), "")).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h"),
        ),
        "sized",
    )


def source_targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(_sid, source, source_size, weight, target), stored. Sources in code point order, null last, weigh ``weights``,
    repeating; a target stops at ``most`` times its source's size, what is left over is shared by weight again."""
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sums = dense_key(sums.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_sid", start=0)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_sid") % len(weights)).cast("int"))
    sums = stored(sums.select("_sid", "source", "source_size", weight.alias("weight")), "sources")
    cap = F.lit(float(most)) * F.col("source_size")
    level, capped = 0.0, -1
    while True:  # each round caps more sources; few rounds, each one sum over the sources
        over = F.col("weight") * F.lit(level) > cap
        total, held, free, n = sums.agg(
            F.sum("source_size"), F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)
        ).first()
        if n == capped or not free:
            break
        level, capped = (total - (held or 0.0)) / free, n
    return sums.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def block_words(targets: DataFrame, block: int = BLOCK, least_slots: int = LEAST_SLOTS) -> tuple[int, int]:
    """Words of a block and words of the whole mix."""
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    return max(1, min(block, -(-total // least_slots))), total


def cut(targets: DataFrame, block: int, most: int = MOST_EPOCHS) -> DataFrame:
    """``targets`` with ``_blocks``, the equal blocks a source is cut into, and ``_slots``, how many of them it takes."""
    size, target = F.col("source_size").cast("double"), F.col("target")
    finer = F.when(target > 0, F.ceil(F.least(size, F.lit(float(LEAST_BLOCKS)) * size / target))).otherwise(0)
    blocks = F.greatest(F.lit(1), F.ceil(size / F.lit(block)), finer).cast("long")
    taken = F.greatest(F.lit(1), F.round(target * F.col("_blocks") / size).cast("long"))
    slots = F.when((size > 0) & (target > 0), F.least(taken, F.col("_blocks") * most)).otherwise(0)
    return targets.withColumn("_blocks", blocks).withColumn("_slots", slots.cast("long"))


def _begin(block: Column) -> Column:
    """First word of a block: the first ``source_size % _blocks`` blocks are one word longer than the others."""
    return block * F.floor(F.col("source_size") / F.col("_blocks")) + F.least(block, F.col("source_size") % F.col("_blocks"))


def _holding(word: Column) -> Column:
    """The block that holds a word; past the last word the last block."""
    least, longer = F.floor(F.col("source_size") / F.col("_blocks")), F.col("source_size") % F.col("_blocks")
    after = longer + F.floor((word - longer * (least + 1)) / F.greatest(least, F.lit(1)))
    block = F.when(word < longer * (least + 1), F.floor(word / (least + 1))).otherwise(after)
    return F.least(block, F.col("_blocks") - 1)


def _mirrored(number: Column, digits: int) -> Column:
    """``number`` with its binary digits in opposite order: a van der Corput point in units of 1 / 2 ** digits."""
    return F.conv(F.reverse(F.lpad(F.bin(number), digits, "0")), 2, 10).cast("long")


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, _sid, rank, block, epoch), stored: which block of which source, from ``cut``, each slot of the mix takes.

    Slots are numbered without gaps by the numbers of their points. Mirroring is its own inverse, so the points inside
    a stretch of the cumulative weights are found by mirroring the multiples of 1 / N in it, without a join by ranges.
    """
    filled = stored(sources.filter("_slots > 0").select("_sid", "_blocks", "_slots"), "weights")
    digits = max(1, ((filled.agg(F.sum("_slots")).first()[0] or 1) - 1).bit_length())
    stretch = running_totals(filled, (), "_sid", ["_slots"]).withColumn("_from", F.col("_slots_upto") - F.col("_slots"))
    each = F.explode(F.sequence(F.col("_from"), F.col("_slots_upto") - 1, F.lit(_CHUNK).cast("long")))
    starts = stretch.select("_sid", "_blocks", "_slots_upto", each.alias("_s"))
    own = F.explode(F.sequence("_s", F.least(F.col("_s") + F.lit(_CHUNK), F.col("_slots_upto")) - 1))
    placed = starts.repartition("_s").select("_sid", "_blocks", own.alias("_y"))
    placed = dense_key(placed.select("_sid", "_blocks", _mirrored(F.col("_y"), digits).alias("_at")), ["_at"], "slot", start=0)
    placed = stored(placed.drop("_at").withColumn("_chunk", F.floor(F.col("slot") / _CHUNK)), "slots")

    before = Window.partitionBy("_sid").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = placed.groupBy("_sid", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    chunks = chunks.select("_sid", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_sid", "_chunk").orderBy("slot")
    ranked = placed.withColumn("_in", F.row_number().over(inside) - 1).join(chunks, ["_sid", "_chunk"])
    rank = F.col("_before") + F.col("_in")
    ranked = ranked.select("slot", "_sid", rank.alias("rank"), "_blocks")
    return stored(
        ranked.select(
            "slot", "_sid", "rank", (F.col("rank") % F.col("_blocks")).alias("block"),
            F.floor(F.col("rank") / F.col("_blocks")).alias("epoch"),
        ),
        "schedule",
    )


def laid_out(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's columns and ``_start``, the words of the same source before them in the shuffle."""
    bits = max(0, (rows.count() // _ROWS).bit_length())
    chunk = F.shiftrightunsigned("_h", 64 - bits) if bits else F.lit(0).cast("long")
    named = rows.alias("l").join(small(sources).alias("r"), F.col("l.source").eqNullSafe(F.col("r.source")))
    named = stored(named.select("l.*", "r._sid", "r.source_size", "r.target", "r._blocks", chunk.alias("_chunk")), "named")
    before = Window.partitionBy("_sid").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = named.groupBy("_sid", "_chunk").agg(F.sum("size").alias("_n"))
    chunks = chunks.select("_sid", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_sid", "_chunk").orderBy("_h", "doc_id", "size", "_row").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("size").over(inside), F.lit(0))
    out = named.withColumn("_within", within).join(chunks, ["_sid", "_chunk"])
    return out.withColumn("_start", F.col("_before") + F.col("_within")).drop("_before", "_within", "_chunk")


def mix(documents: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED, *key: str) -> tuple[DataFrame, DataFrame]:
    """The schedule, and per document: ``key`` columns, doc_id, size, source_size, target, taken, copies, place, in_slots.

    ``taken`` counts the document's words inside taken blocks, repeats included, at most three times its size.
    ``in_slots`` lists, in order, the slots that take the block with its first word, and ``copies`` counts them: whole
    documents, each in one block. ``place`` is the number of words of its source before it in the shuffle. A null text
    has size 0 and takes nothing; a null source is a source; repeated rows and null doc_ids are documents of their own.
    A corpus without words has targets 0 and no slots; one without rows gives no rows.
    """
    rows = sized(documents, seed, *key)
    targets = stored(source_targets(rows, weights), "targets")
    block, _ = block_words(targets)
    sources = stored(cut(targets, block), "cut")
    slots = schedule(sources)
    # a block is taken once an epoch, so its list has at most MOST_EPOCHS slots
    times = slots.groupBy("_sid", "block").agg(F.sort_array(F.collect_list("slot")).alias("_in"))
    laid = stored(laid_out(rows, sources), "laid-out")
    first, last = _holding(F.col("_start")), _holding(F.col("_start") + F.greatest("size", F.lit(1)) - 1)
    each = laid.select("_row", "_sid", "_start", "size", "source_size", "_blocks", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.greatest("_start", _begin(F.col("block")))
    end = F.least(F.col("_start") + F.col("size"), _begin(F.col("block") + 1))
    parts = each.select("_row", "_sid", "block", (end - begin).alias("_words"), (begin == F.col("_start")).alias("_first"))
    held = parts.join(times, ["_sid", "block"]).groupBy("_row").agg(
        F.sum(F.col("_words") * F.size("_in")).alias("taken"), F.max(F.when(F.col("_first"), F.col("_in"))).alias("_in")
    )
    in_slots = F.coalesce("_in", F.array().cast("array<bigint>"))
    return slots, laid.join(held, "_row", "left").select(
        *key, "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.size(in_slots).cast("long").alias("copies"), F.col("_start").alias("place"), in_slots.alias("in_slots"),
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in the mix; ``first_slot`` is the first slot of a document's first block, null if it is not taken."""
    _, mixed = mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.get("in_slots", F.lit(0)).alias("first_slot"))


def mixed_documents(documents: DataFrame, weights: Sequence[float] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The documents of the mix, whole and as often as it takes them, with their own columns, in slot order: the
    partitions one after the other, each in order. Slots hold about equal numbers of words, so a partition is a range of
    slot numbers and none has to be sampled."""
    rows = whole_rows(documents, "documents")
    slots, mixed = mix(rows.select(F.col("_row").alias("_key"), "_doc.doc_id", "_doc.source", "_doc.text"), weights, seed, "_key")
    kept = mixed.filter("copies > 0").select(F.col("_key").alias("_row"), "place", "in_slots", "size", "copies")
    kept = stored(kept, "copies")
    words, n = kept.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0, slots.count()
    files = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words // _FILE_WORDS))
    out = rows.join(small(kept), "_row").select("_row", "_doc", "place", F.explode("in_slots").alias("_slot"))
    out = out.repartitionById(files, F.floor(F.col("_slot") * files / F.lit(max(1, n))).cast("int"))
    return out.sortWithinPartitions("_slot", "place", "_row").select("_doc.*")
