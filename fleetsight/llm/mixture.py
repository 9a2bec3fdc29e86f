"""Mix sources to target weights, as DataFrame expressions only.

The words of each source, its documents in one fixed order, are cut into blocks of a fixed length.
A source whose target is t words of its s gets t div s whole passes over its blocks and one partial
pass; each place in a pass is a slot. First the counts of slots by (output shard, source) are drawn:
a multinomial over the shards whose total is the source's quota, so that the mix meets each target
to the word. Then a source's slots are numbered shard after shard: shard j holds as many as it drew.
In a pass, slot k takes the block at pi(k), where pi is a pseudorandom permutation of the block
numbers keyed by source and pass; slots and blocks are joined by that number, so each shard gets
blocks from all over its sources. The last slot of a source is cut to the words still due. Inside a
shard the slots of all sources stand in a random order (``seat``), in which documents are written.
The number of shards follows from the words of the mix (SHARD_WORDS each, on average).

The running position of a document in its source comes from sums over (source, bucket) of a hash of
id, size and text, so that no window holds a whole source, nor all rows without an id. Rows that
agree in all three share a bucket. One row a source passes one window for the targets, and one row
a shard and source passes one for the numbering.

Defined cases: null text has no words and is never taken; a null source is a source of its own (the
last in order); null ids and repeated rows count as rows of their own; with no words at all nothing
is taken; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetsight.llm.common import WORD, staged

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 256
BUCKETS = 4096
SHARD_WORDS = 1 << 19  # words of the mix for each output shard, on average
SLOT_RUN = 4096  # slots that one row of the plan expands to


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES) -> DataFrame:
    """Targets by source from (source, source_size): sources share all words (``all_words``) by weight, up to a cap.

    The shares that the caps leave over go to the other sources by weight. Sorted by cap over
    weight, the sources up to some place are capped, and the level of words for each unit of weight
    among the rest follows from sums over the sorted rows. One row a source passes the window.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(table, (place % len(weights) + 1).cast("int")))
    cap = (max_passes * F.col("source_size")).cast("double")
    capped = weighed.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    up = W.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = up.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0.0)
    left_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), zero)
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)
    levelled = capped.withColumn("level", left_words / left_weight)
    # the level that holds is the first at which the next source stays below its cap
    holds = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * holds, F.col("cap")))
    return levelled.select(
        "source", "source_size", "weight", target.alias("target"), F.sum("source_size").over(everything).alias("all_words")
    )


def _scattered(slots: DataFrame, seed: int) -> DataFrame:
    """``slots`` with ``moved``: a keyed permutation of ``place`` over 0..whole-1.

    Two turns of: two rounds on a grid of whole rows, then a rotation. On the grid the column is
    shifted by a hash of the row and the row by a hash of the column, so each step can be undone;
    numbers behind the last whole row stay until the rotation moves them. Each step is a column of
    its own, so that expressions stay small.
    """
    n = F.greatest(F.lit(1).cast("long"), F.col("whole"))
    key = (F.col("source"), F.col("pass"), F.lit(seed))
    out = slots.withColumn("n", n).withColumn("wide", F.floor(F.sqrt(F.col("n").cast("double"))).cast("long"))
    out = out.withColumn("tall", F.floor(F.col("n") / F.col("wide")).cast("long")).withColumn("moved", F.col("place"))
    wide, tall, n = F.col("wide"), F.col("tall"), F.col("n")
    for turn in (0, 1):
        out = out.withColumns({"row": F.floor(F.col("moved") / wide).cast("long"), "col": F.col("moved") % wide})
        out = out.withColumn("grid", F.col("row") < tall)
        for i, (axis, other, length) in enumerate((("col", "row", wide), ("row", "col", tall), ("col", "row", wide))):
            shift = F.pmod(F.xxhash64(other, F.lit(4 * turn + i), *key), length)
            out = out.withColumn(axis, F.when(F.col("grid"), F.pmod(F.col(axis) + shift, length)).otherwise(F.col(axis)))
        out = out.withColumn("moved", F.col("row") * wide + F.col("col"))
        out = out.withColumn("moved", F.pmod(F.col("moved") + F.pmod(F.xxhash64(F.lit(4 * turn + 3), *key), n), n))
    return out.drop("n", "wide", "tall", "row", "col", "grid")


def word_table(docs: DataFrame, id_col: str, text_col: str, source_col: str, buckets: int = BUCKETS) -> DataFrame:
    """Each document's place among its source's words: doc_id, source, size, bucket, nth, start.

    (source, bucket, nth) identifies a row. The result is staged, so texts are read once.
    """
    text = F.col(text_col).cast("string")
    size = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        size.alias("size"),
        F.xxhash64(text).alias("mark"),
    ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "mark"), F.lit(buckets)))
    rows = W.partitionBy("source", "bucket").orderBy("doc_id", "size", "mark")
    running = sized.select(
        "*",
        (F.row_number().over(rows)).alias("nth"),
        (F.sum("size").over(rows.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")).alias("in_bucket"),
    )
    held = staged(running, "mix-words")
    totals = held.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    before = W.partitionBy("source").orderBy("bucket")
    offsets = totals.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), (F.sum("words").over(before) - F.col("words")).alias("first")
    )
    joined = held.join(offsets, held["source"].eqNullSafe(offsets["s"]) & (held["bucket"] == offsets["b"]))
    return joined.select("doc_id", "source", "size", "bucket", "nth", (F.col("first") + F.col("in_bucket")).alias("start"))


def shard_counts(targets: DataFrame, block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = 0) -> DataFrame:
    """The slots that each shard draws from each source: source, shard, n, first, and the source's shape.

    A multinomial of the source's quota over equally likely shards, as counts of independent draws.
    They are made in runs, dealt out evenly, and combined before the shuffle. ``first`` is the number
    of the shard's first slot in the source.
    """
    size, due = F.col("source_size"), F.round("target").cast("long")
    shape = targets.filter((size > 0) & (due > 0)).select(
        "source",
        F.ceil(size / block).cast("long").alias("blocks"),
        F.floor(size / block).cast("long").alias("whole"),
        size.alias("s"),
        due.alias("due"),
        F.ceil(F.col("all_words") / shard_words).cast("long").alias("shards"),
    )
    passes, rest = F.floor(F.col("due") / F.col("s")).cast("long"), F.col("due") % F.col("s")
    count = passes * F.col("blocks") + F.ceil(rest / block).cast("long")
    runs = shape.withColumn("count", count).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((count - 1) / SLOT_RUN))))
    start = F.col("run") * SLOT_RUN
    draws = runs.repartition("source", "run").withColumn("draw", F.explode(F.sequence(start, F.least(F.col("count"), start + SLOT_RUN) - 1)))
    drawn = draws.withColumn("shard", F.pmod(F.xxhash64("source", "draw", F.lit(seed + 1)), F.col("shards")))
    counts = drawn.groupBy("source", "blocks", "whole", "s", "due", "shard").agg(F.count("*").alias("n"))
    before = W.partitionBy("source").orderBy("shard")
    return counts.withColumn("first", F.sum("n").over(before) - F.col("n"))


def slots(counts: DataFrame, block: int = BLOCK_WORDS, seed: int = 0) -> DataFrame:
    """One row for each slot of the mix, from ``shard_counts``: source, shard, seat, pass, place, block, words.

    ``words`` bounds what the slot takes from its block; ``seat`` orders the slots of a shard.
    """
    expanded = counts.repartition("source", "shard").withColumn(
        "slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1))
    )
    turn, place = F.floor(F.col("slot") / F.col("blocks")).cast("long"), F.col("slot") % F.col("blocks")
    placed = _scattered(expanded.select("*", turn.alias("pass"), place.alias("place")), seed)
    # the short block at a source's end keeps the last place of a pass
    chosen = F.when(F.col("place") < F.col("whole"), F.col("moved")).otherwise(F.col("place"))
    left = F.col("due") - F.col("pass") * F.col("s") - F.col("place") * block
    return placed.select(
        "source",
        "shard",
        F.xxhash64("source", "slot", F.lit(seed + 2)).alias("seat"),
        "pass",
        "place",
        # never null, so that no filter on it is pushed down through the permutation's steps
        F.coalesce(chosen, F.lit(-1)).alias("block"),
        F.least(F.lit(block).cast("long"), left).alias("words"),
    )


def pieces(words: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The part of each document in each block: block, from (in the block), at (in the document), length.

    A document without words has one row without a block, so that it isn't lost.
    """
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    spans = F.when(F.col("size") > 0, F.sequence(first, last))
    cut = words.withColumn("block", F.explode_outer(spans))
    begin = F.greatest(F.col("start"), F.col("block") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    return cut.select(
        "doc_id", "source", "size", "bucket", "nth", "block",
        (begin - F.col("block") * block).alias("from"), (begin - F.col("start")).alias("at"), (end - begin).alias("length"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 0,
) -> DataFrame:
    """The mix: a row for each part of a document in a slot, and one with null shard for each part not taken.

    Columns: doc_id, source, size, bucket, nth (a row's identity), source_size, target, shard, seat,
    pass, place, from, at (first word in the document), words (taken from there on, 0 if none).
    """
    words = staged(word_table(docs, id_col, text_col, source_col), "mix-places")
    sizes = words.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, max_passes), "mix-targets")
    counts = staged(shard_counts(targets, block, shard_words, seed), "mix-shards")
    drawn = slots(counts, block, seed).withColumnsRenamed({"source": "of", "block": "chosen", "words": "room"})
    parts = pieces(words, block)
    # slots grow with the mix, so they are never broadcast
    joined = parts.join(drawn.hint("merge"), parts["source"].eqNullSafe(drawn["of"]) & (parts["block"] == drawn["chosen"]), "left")
    reach = F.least(F.col("from") + F.col("length"), F.col("room")) - F.col("from")
    taken = F.when(F.col("room").isNotNull(), F.greatest(F.lit(0), reach))  # least() skips nulls
    by_source = targets.select(F.col("source").alias("name"), "source_size", "target")
    return (
        joined.withColumn("words", F.coalesce(taken, F.lit(0)).cast("long"))
        .join(by_source, F.col("source").eqNullSafe(F.col("name")), "left")
        .select("doc_id", "source", "size", "bucket", "nth", "source_size", "target", "shard", "seat", "pass", "place", "from", "at", "words")
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", chars_col: str = "n_chars", **options
) -> DataFrame:
    """The mix as documents: a row for each part that a slot takes, with the part as its text.

    All columns of ``docs`` stay; ``chars_col``, where present, is the part's length. Rows get
    numbers of their own when they are staged, so repeated ids stay apart. The rows of a shard lie in
    one partition, one after the other, in the order of the shard's seats.
    """
    key = f"_{uuid.uuid4().hex}"
    numbered = staged(docs.withColumn(key, F.monotonically_increasing_id()), "mix-rows")
    parts = mix(numbered, key, text_col, source_col, **options).filter("words > 0")
    spans = parts.groupBy(F.col("doc_id").alias(f"{key}r")).agg(F.collect_list(F.struct("shard", "seat", "from", "at", "words")).alias(f"{key}s"))
    joined = numbered.join(spans, numbered[key] == spans[f"{key}r"])
    words = F.regexp_extract_all(F.col(text_col), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    held = joined.withColumn(f"{key}w", words).withColumn(f"{key}p", F.explode(f"{key}s"))
    start, count = (F.col(f"{key}p.at") + 1).cast("int"), F.col(f"{key}p.words").cast("int")
    part = F.array_join(F.slice(f"{key}w", start, count), "")
    out = held.withColumn(text_col, part).withColumns({f"{key}{c}": F.col(f"{key}p.{c}") for c in ("shard", "seat", "from")}).drop(f"{key}w", f"{key}s")
    # with a number given, whole shards aren't merged into a few large tasks
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartition(tasks, f"{key}shard").sortWithinPartitions(f"{key}shard", f"{key}seat", f"{key}from")
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.length(text_col).cast(docs.schema[chars_col].dataType))
    return out.select(*docs.columns)


def taken_words(mixed: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, n_slots, first_shard for each document row of ``mix``'s result.

    ``n_slots`` counts the slots that take a part of the document, ``first_shard`` is the least shard that gets one.
    """
    some = F.col("words") > 0
    by_row = mixed.groupBy("source", "bucket", "nth", "doc_id", "size").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.sum("words").alias("taken"),
        F.count_if(some).alias("n_slots"), F.min(F.when(some, F.col("shard"))).alias("first_shard"),
    )
    return by_row.select("doc_id", "size", "source_size", "target", "taken", "n_slots", "first_shard")
