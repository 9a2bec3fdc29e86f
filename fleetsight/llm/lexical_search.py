"""Ranked lexical search: the best documents of each query by summed term scores, in integers.

Documents are indexed in segments of neighbouring rows, for the terms that the queries of a block
hold. In a segment each query is evaluated by a hybrid of two orders. Its short lists are taken
term at a time: their scores are summed into one accumulator list. That list then counts as one
more iterator, bounded by its greatest sum, beside the long lists, and all are walked document at a
time in runs: iterators whose bounds together can't lift a document into the best k give no
candidates and are only searched, by skipping, for candidates that may still get there. The
threshold of a query rises from run to run and from segment to segment of a task. Each task gives
its best k of each query, and these meet by query.

Every row is indexed and scores are exact; bounds only spare work. Queries are taken in blocks of
about ``BLOCK_TERMS`` distinct terms, since a block's terms and weights are sent to all tasks. What
is collected is a number of occurrences for each term of a block.

Defined cases: null and empty texts hold no terms; such documents are never found, such queries get
no rows. Null ids are carried and come last among equal scores. Each row, repeated or not, is a
document or a query of its own. Scores of zero are left out. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetsight.llm.common import broadcast_value, slices, staged, text_buffer, word_hashes

# Fixed value: a term holds no ASCII but digits and letters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BEST = 10
BLOCK_TERMS = 1 << 20
SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 14, 1 << 20
SHORT = 1 / 32  # a list of at most this share of a segment's documents is summed beforehand
RUN = 4_096  # candidates that are walked before the threshold is looked at again

_APART = np.ones(256, dtype=bool)
_APART[128:] = False
_APART[np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = False


def term_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' terms in order, and how many each text has."""
    return word_hashes(raw, offsets, _APART)


# ---- queries ----------------------------------------------------------------------------------
def _query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each query: its id, its distinct terms' hashes and how often it holds each."""

    def hashed(batches):
        for batch in batches:
            hashes, counts = term_hashes(*text_buffer(batch.column("text")))
            ends = np.cumsum(counts)
            found = [np.unique(hashes[e - n : e], return_counts=True) for e, n in zip(ends, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item"),
                    pa.array([t.view(np.int64) for t, _ in found], pa.list_(pa.int64())),
                    pa.array([n.astype(np.int64) for _, n in found], pa.list_(pa.int64())),
                ],
                names=["item", "terms", "counts"],
            )

    rows = queries.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(hashed, "item long, terms array<long>, counts array<long>")


# ---- index ------------------------------------------------------------------------------------
_SEGMENT = (
    "ids array<long>, lengths array<long>, n_docs long, n_terms long, "
    "terms array<int>, found array<int>, places array<int>, times array<int>"
)


def build_index(docs: DataFrame, vocabulary: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the index, staged: documents with their lengths and, term by term, their postings.

    ``vocabulary`` holds the sorted hashes of the terms to index; a term is named by its place there.
    ``found`` is a term's number of documents in the segment, ``places`` and ``times`` its postings.
    """
    shared = broadcast_value(docs.sparkSession, vocabulary)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        mask = np.uint64((1 << max(10, (16 * len(wanted)).bit_length())) - 1)
        maybe = np.zeros(int(mask) + 1, dtype=bool)
        maybe[wanted & mask] = True
        ids, lengths, postings, n_docs, n_postings = [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            term, place, times = (np.concatenate(x) for x in zip(*postings, strict=True))
            order = np.argsort(term, kind="stable")  # documents came in ascending order
            term = term[order]
            heads = np.flatnonzero(np.diff(term, prepend=-1))
            n = np.concatenate(lengths)
            row = [
                pa.concat_arrays(ids), n, (n > 0).sum(), n.sum(),
                term[heads], np.diff(heads, append=len(term)), place[order], times[order],
            ]
            kinds = [pa.list_(pa.int64())] * 2 + [pa.int64()] * 2 + [pa.list_(pa.int32())] * 4
            return pa.RecordBatch.from_arrays([_one(x, k) for x, k in zip(row, kinds, strict=True)], names=_names(_SEGMENT))

        for batch in batches:
            for part in slices(batch, "text"):
                hashes, counts = term_hashes(*text_buffer(part.column("text")))
                at = np.flatnonzero(maybe[hashes & mask])
                near = np.searchsorted(wanted, hashes[at])
                near[near == len(wanted)] = 0
                same = wanted[near] == hashes[at] if len(wanted) else np.zeros(0, bool)
                doc = np.repeat(np.arange(len(counts)), counts)[at[same]]
                keys, times = np.unique((doc << 32) | near[same], return_counts=True)
                postings.append(((keys & 0xFFFFFFFF).astype(np.int32), ((keys >> 32) + n_docs).astype(np.int32), times.astype(np.int32)))
                column = part.column("id")
                ids.append(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
                lengths.append(counts)
                n_docs, n_postings = n_docs + len(counts), n_postings + len(keys)
                if n_docs >= SEGMENT_DOCS or n_postings >= SEGMENT_POSTINGS:
                    yield segment()
                    ids, lengths, postings, n_docs, n_postings = [], [], [], 0, 0
        if n_docs:
            yield segment()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return staged(rows.mapInArrow(indexed, _SEGMENT), "search-index")


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _one(value, kind: pa.DataType) -> pa.Array:
    """An Arrow column of one row."""
    if not pa.types.is_list(kind):
        return pa.array([int(value)], kind)
    values = value if isinstance(value, pa.Array) else pa.array(value, kind.value_type)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


# ---- evaluation -------------------------------------------------------------------------------
class Segment:
    """One segment while queries run over it: postings by term, their scores made when first asked for."""

    def __init__(self, batch: pa.RecordBatch, row: int, weights: np.ndarray, n_all: int, length_all: int):
        values = {name: batch.column(name)[row].values for name in ("ids", "lengths", "terms", "found", "places", "times")}
        self.no_id = np.asarray(values["ids"].is_null())
        self.ids = values["ids"].fill_null(0).to_numpy(zero_copy_only=False)
        n = values["lengths"].to_numpy()
        self.norm = 8 * (100 - 75 + (75 * n * n_all) // max(length_all, 1))
        terms = values["terms"].to_numpy()
        ends = np.cumsum(values["found"].to_numpy())
        self.lists = dict(zip(terms.tolist(), zip((ends - values["found"].to_numpy()).tolist(), ends.tolist(), strict=True), strict=True))
        self.places = values["places"].to_numpy()
        self.times = values["times"].to_numpy()
        self.weights = weights
        self.scored: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        """(documents, their scores, the greatest score) of a term."""
        if term not in self.lists:
            return None
        if term not in self.scored:
            start, end = self.lists[term]
            docs, tf = self.places[start:end], self.times[start:end].astype(np.int64)
            scores = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + self.norm[docs]))
            self.scored[term] = (docs, scores, int(scores.max()))
        return self.scored[term]


class Best:
    """The best k documents of a query so far: highest score first, then smallest id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.no_id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """What a score must reach to matter."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        no_id = np.concatenate([self.no_id, no_id])
        order = np.lexsort((ids, no_id, -scores))[: self.k]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]


def evaluate(segment: Segment, terms: list[tuple[int, int]], best: Best) -> None:
    """Take the documents of one segment into ``best``. ``terms``: (term, how often the query holds it)."""
    lists = [(docs, scores, bound, n) for t, n in terms if (p := segment.postings(t)) for docs, scores, bound in [p] if bound]
    limit = SHORT * len(segment.ids)
    short = [x for x in lists if len(x[0]) <= limit]
    # iterators: (bound, documents, scores, factor), the accumulators of the short lists being one
    walk = [(n * bound, docs, scores, n) for docs, scores, bound, n in lists if len(docs) > limit]
    if short:
        where, slot = np.unique(np.concatenate([x[0] for x in short]), return_inverse=True)
        sums = np.zeros(len(where), np.int64)
        np.add.at(sums, slot, np.concatenate([n * scores for _, scores, _, n in short]))
        walk.append((int(sums.max()), where, sums, 1))
    walk.sort(key=lambda x: x[0])
    reach = np.cumsum([x[0] for x in walk], dtype=np.int64)  # the most that the first i + 1 iterators can give
    if not walk or reach[-1] < best.least:
        return
    first = int(np.searchsorted(reach, best.least))  # iterators before it can't make a result by themselves
    essential = walk[first:]
    candidates = essential[0][1] if len(essential) == 1 else np.unique(np.concatenate([x[1] for x in essential]))
    for at in range(0, len(candidates), RUN):
        run = candidates[at : at + RUN]
        least = best.least
        if reach[-1] < least:
            return
        sums = np.zeros(len(run), np.int64)
        for i in range(len(walk) - 1, -1, -1):
            if i < len(walk) - 1:  # what is left can add no more than reach[i]
                alive = sums + reach[i] >= least
                if not alive.all():
                    run, sums = run[alive], sums[alive]
                    if not len(run):
                        break
            _, docs, scores, n = walk[i]
            place = np.searchsorted(docs, run)  # a skip to each candidate
            place[place == len(docs)] = 0
            hit = docs[place] == run
            sums[hit] += n * scores[place[hit]]
        if len(run):
            good = sums >= least
            best.add(sums[good], segment.ids[run[good]], segment.no_id[run[good]])


def _search_block(docs: DataFrame, block: pa.Table, k: int, id_col: str, text_col: str) -> DataFrame:
    """The best k of each task for the queries of one block."""
    items = block.column("item").to_pylist()
    hashes = [np.asarray(t, np.int64).view(np.uint64) for t in block.column("terms").to_pylist()]
    counts = block.column("counts").to_pylist()
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
    index = build_index(docs, vocabulary, id_col, text_col)
    held = index.select(F.sum("n_docs"), F.sum("n_terms")).first()
    n_all, length_all = held[0] or 0, held[1] or 0
    each = index.select(F.explode(F.arrays_zip("terms", "found")).alias("t")).groupBy("t.terms").agg(F.sum("t.found").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in each.collect():  # a row for each term of the block at most
        weights[term] = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df + 1)))
    asked = [list(zip(np.searchsorted(vocabulary, h).tolist(), c, strict=True)) for h, c in zip(hashes, counts, strict=True)]
    shared = broadcast_value(docs.sparkSession, (items, asked, weights))

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, asked, weights = shared.value
        best = [Best(k) for _ in items]
        for batch in batches:
            for row in range(batch.num_rows):
                segment = Segment(batch, row, weights, n_all, length_all)
                for terms, own in zip(asked, best, strict=True):
                    evaluate(segment, terms, own)
        if any(len(b.scores) for b in best):
            sizes = [len(b.scores) for b in best]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(items)), sizes), pa.int64()),
                    pa.array([i for i, n in zip(items, sizes, strict=True) for _ in range(n)], pa.int64()),
                    pa.array(np.concatenate([b.ids for b in best]), pa.int64(), mask=np.concatenate([b.no_id for b in best])),
                    pa.array(np.concatenate([b.scores for b in best]), pa.int64()),
                ],
                names=["query", "item", "doc_id", "score"],
            )

    return index.mapInArrow(ranked, "query long, item long, doc_id long, score long")


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = BEST,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query row."""
    asked = staged(_query_terms(queries, query_id, query_text), "search-queries")
    n_terms = asked.select(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, math.ceil(n_terms / block_terms))
    blocks = []
    for i in range(n_blocks):
        own = asked.filter(F.size("terms") > 0).filter(F.pmod(F.hash("terms"), F.lit(n_blocks)) == i)
        block = own.toArrow()
        if block.num_rows or not i:
            blocks.append(_search_block(docs, block, k, doc_id, doc_text).withColumn("block", F.lit(i)))
    found = blocks[0]
    for more in blocks[1:]:
        found = found.unionAll(more)
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(query_id), "rank", F.col("doc_id"), "score")
