"""Near duplicates by one-permutation hashing with optimal densification.

A document's word shingles are hashed once and dealt into bins; a bin keeps its least hash. An empty
bin takes the value of the first filled bin in a random order of its own (the same for all
documents). Five bins make a band, and documents that agree in a band share a bucket. In a bucket,
only edges from one hub to the others are candidates, so a bucket of m documents gives
m - 1 pairs. Links are confirmed on the full shingle sets.

A star can miss a link between two members that the hub doesn't link. So when the components of the
confirmed links are known, the members of every bucket that still holds more than one component are
compared across components, in blocks within tasks: by the stored signatures (a pair whose equal bins
are six standard deviations below the least similarity is passed over, a chance of about 1 in 10^9 for
a link), then by the full sets of the members that are left. Only links leave those tasks.

Documents with the same set are one node, so copies never multiply. A node is the first 64 bits of
the MD5 of its sorted shingle hashes.

Defined cases: null or wordless texts have no shingles and link with nothing; rows with a null id
link with nothing and keep a null component (``deduplicate`` judges them too); rows that repeat an id
are judged by their own texts; an empty table gives no rows; other columns are ignored by
``near_duplicates``, kept by ``deduplicate``.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.llm import common
from fleetsight.llm.common import mix64, slices, text_buffer, word_hashes
from fleetsight.llm.components import components

BANDS, ROWS = 50, 5
BINS = BANDS * ROWS
WORDS = 5
PERCENT = 80
BLOCK = 512  # members of a bucket that one task compares with as many others
SLOTS = 1 << 22  # bits of the filter that picks the texts to confirm on
BATCH_BYTES = 4 << 20  # of texts or shingle sets that a Python function gets at once

staged = functools.partial(common.staged, batch_bytes=BATCH_BYTES)

_EMPTY = np.uint64(1 << 63)
_ORDER = mix64(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(1 << 40)).reshape(BINS, BINS)


def shingles(raw: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a text with fewer words has one of all its words."""
    hashes, counts = word_hashes(raw, offsets)
    if not len(hashes):
        return [np.zeros(0, np.uint64)] * len(counts)
    run = hashes.copy()
    chains = [run]
    for k in range(1, words):
        run = mix64(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[k:] if len(run) > 1 else run[:0])
        chains.append(run)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(chains[-1][at : at + n - words + 1]))
        elif n:
            out.append(chains[n - 1][at : at + 1] ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def signature(found: np.ndarray) -> np.ndarray:
    """The densified bins of a set of shingle hashes."""
    bins = np.full(BINS, _EMPTY)
    place = ((found >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(bins, place, found & np.uint64(0xFFFFFFFF))
    filled = bins != _EMPTY
    if not filled.all():
        full, empty = np.flatnonzero(filled), np.flatnonzero(~filled)
        bins[empty] = bins[full[_ORDER[np.ix_(empty, full)].argmin(axis=1)]]
    return bins


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(documents, BANDS) bucket keys of (documents, BINS) signatures."""
    rows = signatures.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(33), rows.shape[:2])
    for r in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key.view(np.int64)


def node_of(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.md5(found.tobytes()).digest()[:8], "little", signed=True)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, node (null without shingles or id), signature (a byte a bin), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = shingles(*text_buffer(part.column("text")), words)
                ids = part.column("doc_id")
                real = np.array([len(s) > 0 for s in sets]) & np.asarray(ids.is_valid())
                signs = np.zeros((len(sets), BINS), np.uint64)
                for i in np.flatnonzero(real):
                    signs[i] = signature(sets[i])
                keys = band_keys(signs)
                nodes = [node_of(s) if r else None for s, r in zip(sets, real, strict=True)]
                short = signs.astype(np.uint8)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array([s.tobytes() if r else None for s, r in zip(short, real, strict=True)], pa.binary()),
                        bands,
                    ],
                    ["doc_id", "n_shingles", "node", "signature", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long, signature binary, bands array<long>")


def _slot(column: str):
    return F.pmod(F.xxhash64(column), F.lit(SLOTS))


def sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the wanted documents (doc_id, node).

    A bitmap of SLOTS bits over hashes of the wanted ids goes to all tasks, so that few other texts
    are hashed or leave their task; the join then takes the wanted ones exactly.
    """
    slots = wanted.select((_slot("doc_id")).alias("slot"))
    maps = slots.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    bits = np.zeros(SLOTS + 2 * 32_768, bool)
    for r in maps.collect():  # at most SLOTS / 32,768 + 1 rows of 4 KB
        found = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little")
        begin = (r.bucket - 1) * 32_768 + 1 if r.bucket else 0
        bits[begin : begin + len(found)] |= found.astype(bool)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))
    lookup = docs.select("doc_id", "text", _slot("doc_id").alias("slot"), F.bitmap_bucket_number(_slot("doc_id")).alias("bucket"),
                         F.bitmap_bit_position(_slot("doc_id")).alias("bit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            bucket = batch.column("bucket").to_numpy(zero_copy_only=False)
            at = np.where(bucket > 0, (bucket - 1) * 32_768 + 1, 0) + batch.column("bit").to_numpy(zero_copy_only=False)
            picked = batch.filter(pa.array(held[at]))
            for part in slices(picked, "text", 1 << 20):
                sets = shingles(*text_buffer(part.column("text")), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["doc_id", "node", "shingles"],
                )

    found = lookup.filter("doc_id is not null").mapInArrow(run, "doc_id long, node long, shingles binary")
    joined = found.join(wanted.select("doc_id", "node"), ["doc_id", "node"], "left_semi")
    return joined.dropDuplicates(["node"]).select("node", "shingles")


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
            good = []
            for x, y in zip(a, b, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    good.append(False)
                    continue
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    return run


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) of nodes whose full sets are similar enough; nodes: node, doc_id, n_shingles."""
    sizes = nodes.select("node", "n_shingles")
    sized = (
        pairs.join(sizes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na")), "a")
        .join(sizes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb")), "b")
        .filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))  # no larger intersection is possible
    )
    likely = staged(sized.select("a", "b"), f"{name}-pairs")
    touched = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = staged(sets_of(docs, nodes.select("node", "doc_id").join(touched, "node"), words), f"{name}-sets")
    both = likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    return staged(both.select("a", "b", "sa", "sb").mapInArrow(_confirm(percent), "a long, b long"), f"{name}-links")


def least_agreement(size: np.ndarray, percent: int) -> np.ndarray:
    """The share of equal bins below which sets of ``size`` shingles aren't similar enough.

    Six standard deviations below the least similarity; a set fills about BINS(1 - exp(-size/BINS))
    bins by itself, and the others repeat those.
    """
    filled = BINS * -np.expm1(-np.asarray(size, np.float64) / BINS)
    least = percent / 100
    return least - 6 * np.sqrt(least * (1 - least) / filled)


def _possible(frame: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place, places) of pairs across components in two blocks of a bucket (or within one) that may be links.

    A pair is given in the first band that both its members share.
    """
    band, lo, hi = (int(frame[c].iloc[0]) for c in ("band", "lo", "hi"))
    left, right = np.flatnonzero(frame["block"] == lo), np.flatnonzero(frame["block"] == hi)
    signs = np.frombuffer(b"".join(frame["signature"]), np.uint8).reshape(-1, BINS)
    bands = np.stack([np.asarray(b) for b in frame["bands"]])
    size, root, node = (frame[c].to_numpy() for c in ("n_shingles", "root", "node"))
    for i in left.tolist():
        other = root[right] != root[i]
        other &= 100 * np.minimum(size[right], size[i]) >= percent * np.maximum(size[right], size[i])
        if lo == hi:
            other &= node[right] > node[i]
        at = right[other]
        agree = (signs[at] == signs[i]).mean(axis=1)
        at = at[agree >= least_agreement(np.minimum(size[at], size[i]), percent)]
        if len(at):
            first = (bands[at] == bands[i]).argmax(axis=1)
            at = at[bands[i][first] == band]
        if len(at):
            yield i, at


def _to_compare(percent: int):
    """The members of two blocks that are in any possible pair; one row each, however many pairs."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        used = np.zeros(len(frame), bool)
        for i, at in _possible(frame, percent):
            used[i] = True
            used[at] = True
        return frame.loc[used, ["band", "lo", "hi", "block", "node"]]

    return run


def _compared_in_full(percent: int):
    """The links among the possible pairs of two blocks, by the full sets; no other pair leaves the task."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        node = frame["node"].to_numpy()
        found = []
        for i, at in _possible(frame, percent):
            sizes = np.array([len(sets[j]) for j in at])
            all_of = np.concatenate([sets[j] for j in at])
            place = np.minimum(np.searchsorted(sets[i], all_of), len(sets[i]) - 1)
            common = np.add.reduceat((sets[i][place] == all_of).astype(np.int64), np.cumsum(sizes) - sizes)
            good = at[100 * common >= percent * (sizes + len(sets[i]) - common)]
            found += [(min(node[i], node[j]), max(node[i], node[j])) for j in good]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def dealt_to_blocks(rows: DataFrame) -> DataFrame:
    """band, node, root, block, lo, hi: a row for each pair (lo, hi) of blocks that a member of a bucket is in.

    Only buckets with several components are dealt; rows: node, band, root. Links inside a component
    change nothing, so in a bucket of more than BLOCK members those of its largest component have
    blocks of their own, which meet the blocks of all other members but not one another. A large
    component with up to BLOCK others costs a row a member and few more, however large it is.
    """
    parts = rows.groupBy("band", "root").agg(F.count("*").alias("n"))
    mixed = parts.groupBy("band").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), F.max(F.struct("n", "root")).alias("main"))
    whole = F.col("n") <= BLOCK
    mixed = mixed.filter("n > 2 and parts > 1").select(
        "band",
        F.col("main.root").alias("main"),
        F.when(whole, 0).otherwise(F.ceil(F.col("main.n") / BLOCK)).cast("int").alias("main_blocks"),
        F.when(whole, 1).otherwise(F.ceil((F.col("n") - F.col("main.n")) / BLOCK)).cast("int").alias("blocks"),
    )
    members = rows.join(mixed, "band").withColumn("in_main", (F.col("root") == F.col("main")) & (F.col("main_blocks") > 0))
    drawn = F.pmod(F.xxhash64("node", "band"), F.when(F.col("in_main"), F.col("main_blocks")).otherwise(F.col("blocks"))).cast("int")
    members = members.withColumn("block", drawn + F.when(F.col("in_main"), F.col("blocks")).otherwise(0))
    met = F.col("blocks") + F.when(F.col("in_main"), 0).otherwise(F.col("main_blocks"))
    dealt = members.withColumn("with", F.explode(F.sequence(F.lit(0), met - 1)))
    return dealt.select("band", "node", "root", "block", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"))


def unsettled_links(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, roots: DataFrame, words: int, percent: int) -> DataFrame:
    """Links across components in a bucket, which its star may have missed.

    First the signatures alone tell which members of a bucket's blocks could have any; only those
    get their full sets, and their blocks are compared in tasks.
    """
    rows = buckets.join(roots, "node", "left").select("node", "band", F.coalesce("root", "node").alias("root"))
    dealt = dealt_to_blocks(rows)
    traits = nodes.select("node", "n_shingles", "signature", "bands")
    schema = "band long, lo int, hi int, block int, node long"
    chosen = staged(dealt.join(traits, "node").groupBy("band", "lo", "hi").applyInPandas(_to_compare(percent), schema), "minhash-unsettled")
    if chosen.isEmpty():
        return nodes.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    wanted = nodes.select("node", "doc_id", "n_shingles", "signature", "bands").join(chosen.select("node").distinct(), "node")
    traits = staged(wanted.drop("doc_id").join(sets_of(docs, wanted.select("doc_id", "node"), words), "node"), "minhash-full-sets")
    traits = traits.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    compared = chosen.join(traits, "node").groupBy("band", "lo", "hi").applyInPandas(_compared_in_full(percent), "a long, b long")
    return staged(compared.distinct(), "minhash-full-links")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """(node, band, n): the buckets of n nodes, two at least; most nodes have none, and are left behind here."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    sizes = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    return staged(rows.join(sizes, "band"), "minhash-buckets")


def stars(buckets: DataFrame) -> DataFrame:
    """(node, hub, shared): candidate edges from each bucket's hub to its other members.

    The hub is the member whose buckets are largest in sum: among copies of one text that is the
    text itself, which is more similar to each of them than they are to one another.
    """
    weight = buckets.groupBy("node").agg(F.sum("n").alias("weight"))
    hubs = buckets.join(weight, "node").groupBy("band").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    edges = buckets.join(hubs, "band").filter("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("shared"))
    return staged(edges, "minhash-stars")


def links(docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(confirmed links, components) of the nodes; docs: doc_id, text."""
    buckets = shared_buckets(nodes)
    edges = stars(buckets)
    # most documents settle with the hub that they share most bands with
    best = edges.groupBy("node").agg(F.max(F.struct("shared", "hub"))["hub"].alias("a")).select("a", F.col("node").alias("b"))
    found = confirmed(docs, nodes, best, words, percent, "minhash-best")
    roots = components(found, "minhash-best")
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    rest = edges.select(F.col("hub").alias("a"), F.col("node").alias("b")).join(of("a"), "a", "left").join(of("b"), "b", "left")
    rest = rest.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b").join(best, ["a", "b"], "left_anti")
    found = found.unionByName(confirmed(docs, nodes, rest, words, percent, "minhash-rest"))
    roots = components(found, "minhash-stars")
    more = unsettled_links(docs, nodes, buckets, roots, words, percent)
    if not more.isEmpty():
        found = found.unionByName(more)
        roots = components(found, "minhash-all")
    return found, roots


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, node, component_id (smallest doc_id reachable), kept for each document."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = staged(sketches(source, words), "minhash-sketches")
    nodes = sketched.filter("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature"), F.first("bands").alias("bands")
    )
    nodes = staged(nodes, "minhash-nodes")
    _, roots = links(source, nodes, words, percent)
    members = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = staged(members, "minhash-members")
    least = members.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = members.join(least, "root").select("node", "component_id")
    joined = sketched.select("doc_id", "n_shingles", "node").join(classes, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select("doc_id", "n_shingles", "node", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each group, that with the smallest id, all columns kept.

    Rows without an id are judged like the others and come last in their group. Rows that share an id
    but not their text are documents of their own; of rows that share both, one stays. Rows without
    words all stay.
    """
    key, of = f"_{uuid.uuid4().hex}", F.col
    number, text = of(id_col).cast("long"), of(text_col).cast("string")
    keyed = docs.withColumn(key, F.xxhash64(number.isNull(), number, text))
    found = near_duplicates(keyed, key, text_col, words, percent).filter("node is not null")
    rows = found.groupBy(of("doc_id").alias(key)).agg(F.min("component_id").alias("component"), F.count("*").alias("n"))
    several = rows.groupBy("component").agg(F.sum("n").alias("rows")).filter("rows > 1").select("component")
    shared = staged(rows.join(several, "component"), "minhash-shared")
    numbers = keyed.select(key, F.struct(number.isNull().alias("none"), number.alias("id"), of(key).alias("row")).alias("place"))
    first = shared.join(numbers, key).groupBy("component").agg(F.min("place")["row"].alias("first"))
    stays = of(key) == of("first")
    special = staged(shared.join(first, "component").filter(~stays | (of("n") > 1)).select(key, stays.alias("stays")), "minhash-gone")
    single = keyed.join(special.select(key), key, "left_anti")  # most rows: what stays alone needs no join partner
    repeated = keyed.join(special.filter("stays").select(key), key, "left_semi").dropDuplicates([key])
    return single.unionByName(repeated).drop(key)
