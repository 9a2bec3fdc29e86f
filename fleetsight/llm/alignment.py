"""Alignment of two tokenizers' tokens over a corpus, each distinct text once.

Rows are shuffled by their full text and equal texts become one with a multiplicity. A text is
encoded by a byte-level BPE file (A, with a space in front) and by a sentencepiece BPE model (B,
which adds that space). Where tokens of both end at one byte, the text is cut into groups, and the
tokens that end there are linked. Links are counted by id pair over the corpus, each weighted by
its text's multiplicity. What a text's links then sum to joins its rows by the SHA-256 of the text.

Inside a task, texts are cut at single spaces and newlines, at which neither tokenizer joins, and
each distinct chunk is aligned once (a bounded cache). Texts that can't be cut are one chunk. The
texts of a block (about ``BLOCK_BYTES``) share one dictionary of chunks and of id pairs; only the
dictionary's pairs are shuffled, to be counted and to get the counts back.

Defined cases: null and empty texts, and texts whose tokens don't give their bytes back, have no
tokens and get zeros and the empty string. Null ids and repeated rows are kept. An empty table gives
no rows. Special tokens' strings in a text are plain text.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.llm.common import slices, staged

BLOCK_BYTES = 8 << 20
CACHE_ENTRIES = 250_000
_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligner(path_a: str, path_b: str) -> "Aligner":
    """One aligner for each worker process and pair of files."""
    key = (path_a, path_b)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(path_a, path_b)
    return _ALIGNERS[key]


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of a byte-level vocabulary: visible bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Chunks:
    """Aligned chunks: counts, the groups as text, and links as id pairs, by chunk number."""

    def __init__(self):
        self.n_a, self.n_b, self.groups, self.links = [], [], [], []

    def add(self, n_a: int, n_b: int, groups: bytes, links: np.ndarray) -> int:
        self.n_a.append(n_a)
        self.n_b.append(n_b)
        self.groups.append(groups)
        self.links.append(links)
        return len(self.n_a) - 1


class Aligner:
    """Tokens of both tokenizers, cut into groups where both end."""

    def __init__(self, path_a: str, path_b: str, cache_entries: int = CACHE_ENTRIES):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (self.a.get_vocab_size(with_added_tokens=True) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # no piece goes on behind a space or over a newline, so these are places to cut at
        self.cuts = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.space = self.b.piece_to_id("▁")
        # an id with what may stand behind it: the next of its side, the other side, the next group
        self.written = [b"%d%c" % (i, c) for i in range(max(len(pieces), len(self.bytes_a))) for c in b",|;"]
        self.cache_entries = cache_entries
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}  # chunk -> number, -1 if its bytes don't come back
        self.chunks = Chunks()

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts with a space in front, by A and by B. A text that opens with a newline has no space there."""
        opens = [t[0:1] == "\n" for t in texts]
        a = [e.ids for e in self.a.encode_batch_fast([t if o else " " + t for t, o in zip(texts, opens, strict=True)], add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1) if texts else []
        return a, [ids[1:] if o and ids[0] == self.space else ids for ids, o in zip(b, opens, strict=True)]

    def align(self, texts: list[str], whole: bool) -> list[int]:
        """Numbers of newly aligned chunks, or of whole texts, which may open with a newline and then still have their space."""
        if whole:
            a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
            b = self.b.encode(texts, num_threads=1)
            raw = [(" " + t).encode() for t in texts]
        else:
            a, b = self.encode(texts)
            raw = [(t if t[0] == "\n" else " " + t).encode() for t in texts]
        look_a, look_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        good = [b"".join(map(look_a, x)) == r and b"".join(map(look_b, y)) == r for x, y, r in zip(a, b, raw, strict=True)]
        numbers = [-1] * len(texts)
        if not any(good):
            return numbers
        a, b, raw = ([x for x, g in zip(xs, good, strict=True) if g] for xs in (a, b, raw))
        n_a, n_b = (np.array([len(x) for x in ids]) for ids in (a, b))
        ids_a, ids_b = (np.fromiter((i for x in ids for i in x), np.int64) for ids in (a, b))
        sizes_a, sizes_b = self.sizes
        ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        last_a, last_b = np.searchsorted(ends_a, cuts), np.searchsorted(ends_b, cuts)
        # all tokens in writing order: of each group those of A, then those of B
        before_b, through_a = np.append(0, last_b + 1), last_a + 1
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        tail_a, tail_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        tail_a[last_a], tail_b[last_b] = 1, 2
        codes[np.arange(len(ids_a)) + before_b[group_a]] = 3 * ids_a + tail_a
        codes[np.arange(len(ids_b)) + through_a[group_b]] = 3 * ids_b + tail_b
        parts = list(map(self.written.__getitem__, codes.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        edges = np.searchsorted(cuts, np.cumsum([len(r) for r in raw]))  # the last group of each chunk
        links = (ids_a[last_a] << 32) | ids_b[last_b]
        at = group = 0
        added = iter(range(len(texts)))
        for x, y, end, edge in zip(n_a.tolist(), n_b.tolist(), ends, edges.tolist(), strict=True):
            i = next(added)
            while not good[i]:
                i = next(added)
            numbers[i] = self.chunks.add(x, y, b"".join(parts[at:end])[:-1], links[group : edge + 1])
            at, group = end, edge + 1
        return numbers

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_sizes"):
            self._sizes = tuple(np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        return self._sizes

    def cut(self, text: str) -> list[str] | None:
        """Chunks of a text, or None if it can't be cut everywhere: what follows a space as itself, what opens a line behind a newline."""
        if not self.cuts:
            return None
        chunks: list[str] = []
        for line in text.split("\n"):
            words = line.split(" ")
            if chunks:
                words[0] = "\n" + words[0]
            chunks += words
        return chunks

    def numbers(self, texts: list[str]) -> list[list[int] | None]:
        """Chunk numbers of each text, in order; None for a text whose bytes don't come back."""
        cut = [self.cut(t) for t in texts]
        seen = set().union(*filter(None, cut))
        new = seen - self.known.keys()
        odd = []  # chunks at which a text can't be cut
        fit = []
        for c in new:
            body = c[1:] if c[0:1] == "\n" else c
            (odd if not body or body[0].isspace() or body[-1].isspace() else fit).append(c)
        self.known.update((c, -2) for c in odd)
        for at in range(0, len(fit), 5_000):
            run = fit[at : at + 5_000]
            self.known.update(zip(run, self.align(run, whole=False), strict=True))
        look_up = self.known.__getitem__
        out: list[list[int] | None] = []
        rest = []
        for i, chunks in enumerate(cut):
            found = [-2] if chunks is None else list(map(look_up, chunks))
            least = min(found)
            out.append(found if least >= 0 else None)
            if least == -2:
                rest.append(i)
        for i in rest:  # one by one: such a text may be long
            n = self.align([texts[i]], whole=True)[0]
            out[i] = None if n < 0 else [n]
        return out


_BLOCK = (
    "block string, keys array<binary>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, "
    "sizes array<int>, chunks array<int>, chunk_sizes array<int>, chunk_pairs array<int>, "
    "pairs array<long>, weights array<long>"
)


def _blocks(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Aligned texts by block. ``texts`` has the columns text, copies."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(path_a, path_b)
        held, copies, n_bytes = [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                held += part.column("text").to_pylist()
                copies += part.column("copies").to_pylist()
                n_bytes += part.column("text").nbytes
                if n_bytes >= BLOCK_BYTES:
                    yield _block(own, held, copies)
                    held, copies, n_bytes = [], [], 0
        if held:
            yield _block(own, held, copies)

    return staged(texts.mapInArrow(aligned, _BLOCK), "alignment-blocks")


def _block(own: Aligner, texts: list[str], copies: list[int]) -> pa.RecordBatch:
    """One row: measures of each text, its chunks by number, the chunks' links by number of a pair, the pairs with their weighted counts."""
    numbers = own.numbers(texts)
    sizes = np.array([len(n or ()) for n in numbers], np.int64)
    flat = np.fromiter((i for n in numbers for i in n or ()), np.int64, int(sizes.sum()))
    used, chunk_of = np.unique(flat, return_inverse=True)
    table = own.chunks
    links = [table.links[i] for i in used.tolist()]
    chunk_sizes = np.array([len(x) for x in links], np.int64)
    pairs, pair_of = np.unique(np.concatenate(links) if links else np.zeros(0, np.int64), return_inverse=True)
    weight_of_chunk = np.zeros(len(used), np.int64)
    np.add.at(weight_of_chunk, chunk_of, np.repeat(np.array(copies, np.int64), sizes))
    weights = np.zeros(len(pairs), np.int64)
    np.add.at(weights, pair_of, np.repeat(weight_of_chunk, chunk_sizes))
    digests = ["" if n is None else hashlib.sha256(b";".join(map(table.groups.__getitem__, n))).hexdigest() for n in numbers]
    of_chunk = [np.array(x, np.int64)[used] if len(used) else np.zeros(0, np.int64) for x in (table.n_a, table.n_b)]
    sums = [_sums(x[chunk_of], sizes) for x in (*of_chunk, chunk_sizes)]
    keys = [hashlib.sha256(t.encode()).digest() for t in texts]
    if len(own.known) > own.cache_entries or len(table.n_a) > 2 * own.cache_entries:
        own.clear()
    row = [uuid.uuid4().hex, keys, *sums, digests, sizes, chunk_of, chunk_sizes, pair_of, pairs, weights]
    schema = [pa.string(), pa.list_(pa.binary()), *[pa.list_(pa.int64())] * 3, pa.list_(pa.string()), *[pa.list_(pa.int32())] * 4, *[pa.list_(pa.int64())] * 2]
    arrays = [pa.array([v], t) if pa.types.is_string(t) else _listed(v, t) for v, t in zip(row, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in _BLOCK.split(", ")])


def _listed(values, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind.value_type))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over neighbouring runs of the given sizes; an empty run gives 0."""
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, links, best): how many links of the corpus hold an id pair, and whether no pair of its B id is held by more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p"))
    counted = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("links"))
    counted = staged(counted, "alignment-pairs").withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = counted.groupBy("b").agg(F.max("links").alias("most"))  # a row for each id of B at most
    return counted.join(F.broadcast(most), "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


_MEASURES = "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts from blocks that have got the counts of their pairs."""
    for batch in batches:
        for i in range(batch.num_rows):
            get = lambda name: batch.column(name)[i].values  # noqa: B023, E731
            places = get("answers").field("place").to_numpy()
            links, best = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
            links[places] = get("answers").field("links").to_numpy()
            best[places] = get("answers").field("best").to_numpy(zero_copy_only=False)
            pairs, chunk_sizes = get("chunk_pairs").to_numpy(), get("chunk_sizes").to_numpy()
            chunks, sizes = get("chunks").to_numpy(), get("sizes").to_numpy()
            of_text = [_sums(_sums(x[pairs], chunk_sizes)[chunks], sizes) for x in (best, links)]
            n_groups = get("n_groups")
            columns = [get("keys"), get("n_a"), get("n_b"), n_groups, n_groups, *map(pa.array, of_text), get("digests")]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _MEASURES.split(", ")])


def text_measures(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text_col: str = "text") -> DataFrame:
    """A row for each distinct text that isn't empty: its SHA-256, its counts and the digest of its groups.

    ``n_links`` equals ``n_groups``: no token is empty, so one token of each side ends at a cut.
    """
    a, b = default_tokenizers()
    text = F.col(text_col).cast("string")
    texts = docs.select(text.alias("text")).filter("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    blocks = _blocks(texts, path_a or a, path_b or b)
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answer = F.collect_list(F.struct("place", "links", "best")).alias("answers")
    answers = asked.join(pair_counts(blocks), "pair").groupBy("block").agg(answer)
    none = F.array().cast("array<struct<place: int, links: bigint, best: boolean>>")  # blocks without any pair
    full = blocks.drop("pairs", "weights").join(answers, "block", "left").withColumn("answers", F.coalesce("answers", none))
    return full.mapInArrow(_measures, _MEASURES)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id, counts of tokens, groups and links, sums over its links, digest of its groups."""
    measures = text_measures(docs, path_a, path_b, text_col)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    zeros = [F.lit(0).cast("long").alias(c) for c in measures.columns[1:-1]]
    without = rows.filter("text IS NULL OR text = ''").select("doc_id", *zeros, F.lit("").alias("groups_sha256"))
    keyed = rows.filter("text <> ''").select("doc_id", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("key"))
    found = keyed.join(measures, "key").select("doc_id", *measures.columns[1:])
    return found.unionByName(without)
