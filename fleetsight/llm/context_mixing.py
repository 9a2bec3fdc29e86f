"""Language-model scores by logistic mixing of hashed-context bit predictors.

Texts are coded bit by bit as UTF-8 bytes and one end byte. For each order k from 1 to 5, the last
k bytes and the bits of the current byte so far pick an entry, whose counts of ones and zeros in the
training texts predict the next bit. Entries are exact: no two contexts share one, and a context that
never occurred has none, whatever the input's size. A mixer adds the predictions as logits with
weights picked by a gate: the longest order that has seen its context, and whether it was sure. An
adaptive probability map refines the result by gate and logit. Weights and map are learned online,
block after block, on training texts whose bytes are not in the counts; tasks learn side by side
and their weights are averaged by the bits seen.

Counting is one pass: a task sorts its texts' byte 6-grams and gives each with its count, so what
is shuffled grows with the input. Orders 1 and 2 have 2**24 entries at most and are broadcast. The
6-grams of the higher orders stay dealt to parts by their last three context bytes, as many parts as
the distinct 6-grams ask for; blocks of texts send each part their distinct 6-grams and get entries
(to learn) or costs (to score) back. Scoring is frozen: equal texts have equal scores.

``score`` is log10 of the model's probability of the text; bits_per_byte follows from it. The base
is a unigram model of words over all training texts. Word counts are looked up for the most
frequent words from a bounded broadcast, for all others by a join.

Defined cases: null text counts as empty (its end alone is scored); a null id counts as the empty
text for the split; repeated rows are scored each; an empty table gives no rows, and without
training texts every bit has probability 1/2; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.llm.common import mix64, slices, staged, text_buffer, word_hashes

ORDERS = 5
LOW = 2  # orders up to this one are tables by context, broadcast
PARTS, GRAMS_A_PART = 64, 1 << 17  # least number of parts; distinct 6-grams to a part
KEY_RUNS = 256  # runs of keys that counts travel in
SLOT_BITS = 22  # of a table of hashed slots in memory
CHUNK_BITS = 8
TOP_WORDS = 65_536  # bound of the words whose counts are broadcast
MIXER_SHARE = 16  # one training text in so many teaches the mixer instead of the counts
BLOCK = 1 << 21  # bytes that are sorted at a time
CODED = 1 << 20  # bytes that are sorted with their places at a time
SCORE_BLOCK = 1 << 22  # bytes whose distinct 6-grams are asked for together to be scored
BATCH_BYTES = 1 << 23  # of texts or packed rows that a Python function gets at once
MIXER_BLOCK = 1 << 13  # bytes between two updates of the weights
GATES = 2 * (ORDERS + 1)
BUCKETS = 33
RATE = 0.5
_GRAM = ORDERS + 1
_IN_CHUNK = SLOT_BITS - CHUNK_BITS
_C = np.uint64(0x9E3779B97F4A7C15)


def padded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts with ORDERS zero bytes before and an end byte of zero behind each.

    Returns the buffer, the places of coded bytes (text and end) and where each text's places begin.
    """
    lengths = np.diff(offsets)
    gap = ORDERS + 1
    buffer = np.zeros(len(raw) + gap * len(lengths), np.uint8)
    coded = np.ones(len(buffer), bool)
    begins = offsets[:-1] + gap * np.arange(len(lengths))
    for k in range(ORDERS):
        coded[begins + k] = False
    places = np.flatnonzero(coded)
    ends = begins + ORDERS + lengths
    coded[ends] = False
    buffer[coded] = raw
    firsts = offsets[:-1] + np.arange(len(lengths))
    return buffer, places, firsts


def gram_keys(buffer: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The byte at each place and the ORDERS bytes before, the latest in the highest bits."""
    longer = np.concatenate([buffer, np.zeros(8 - _GRAM, np.uint8)])
    eight = np.ndarray(max(0, len(longer) - 7), "<u8", longer, strides=(1,))  # the eight bytes from each place on
    return eight[places - ORDERS] & np.uint64((1 << (8 * _GRAM)) - 1)


def _prefix(keys: np.ndarray, order: int) -> np.ndarray:
    """The gram of the byte and ``order`` bytes before."""
    return keys >> np.uint64(8 * (ORDERS - order))


def slots(grams: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For grams of an order: their chunk, slots in the chunk by bit (n, 8), and bits (n, 8)."""
    byte = (grams >> np.uint64(8 * order)).astype(np.int64)
    context = mix64((grams & np.uint64((1 << (8 * order)) - 1)) * _C + np.uint64(order))
    chunk = (context >> np.uint64(64 - CHUNK_BITS)).astype(np.int64)
    bits = np.arange(7, -1, -1)
    node = (1 << np.arange(8)) | (byte[:, None] >> (bits + 1))  # a leading one, then the bits so far
    at = mix64(context[:, None] + node.astype(np.uint64) * _C) & np.uint64((1 << _IN_CHUNK) - 1)
    return chunk, at.astype(np.int64), (byte[:, None] >> bits) & 1


# An entry holds a logit in steps of 1/256 (12 bits) and the logarithm of the count (4 bits).


def entries(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    logit = np.clip(np.round(256 * np.log((ones + 0.4) / (zeros + 0.4))), -2047, 2047).astype(np.int32)
    seen = np.minimum(np.ceil(np.log2(zeros + ones + 1)), 15).astype(np.int32)
    return ((logit + 2048) << 4 | seen).astype(np.uint16)


@dataclasses.dataclass
class Model:
    table: list[np.ndarray]  # by order: entries by context and bits for the orders up to LOW, or hashed slots for all
    weights: np.ndarray  # GATES x ORDERS
    refined: np.ndarray  # GATES x BUCKETS: probabilities at logits -8 to 8


def blank(table: list[np.ndarray]) -> Model:
    weights = np.full((GATES, ORDERS), 0.3)
    line = 1 / (1 + np.exp(-np.linspace(-8, 8, BUCKETS)))
    return Model(table, weights, np.tile(line, (GATES, 1)))


@dataclasses.dataclass
class Inputs:
    logits: np.ndarray  # (grams, 8, ORDERS)
    gate: np.ndarray  # (grams, 8)
    bits: np.ndarray  # (grams, 8)


def inputs(table: list[np.ndarray], grams: np.ndarray) -> Inputs:
    """What the predictors of a table of hashed slots say for sorted distinct 6-grams, bit by bit."""
    found = np.empty((len(grams), 8, ORDERS), np.uint16)
    for order in range(1, ORDERS + 1):
        short, copies = distinct(_prefix(grams, order))
        chunk, at, _ = slots(short, order)
        found[:, :, order - 1] = np.repeat(table[order - 1][(chunk[:, None] << _IN_CHUNK) | at], copies, axis=0)
    return given(found, grams)


def given(found: np.ndarray, grams: np.ndarray) -> Inputs:
    """What the entries (grams, 8, ORDERS) say for 6-grams, bit by bit."""
    seen = (found & 15) > 0
    logits = np.where(seen, ((found >> 4).astype(np.float32) - 2048) / 256, np.float32(0))
    state = np.where(seen, 2 * np.arange(1, ORDERS + 1, dtype=np.int8) + (np.abs(logits) > 2), 0)
    byte = (grams >> np.uint64(8 * ORDERS)).astype(np.int64)
    return Inputs(logits, state.max(axis=2).astype(np.int64), (byte[:, None] >> np.arange(7, -1, -1)) & 1)


def nodes(grams: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For grams of an order: their context and bits so far by bit (n, 8), and bits (n, 8)."""
    byte = (grams >> np.uint64(8 * order)).astype(np.int64)
    context = (grams & np.uint64((1 << (8 * order)) - 1)).astype(np.int64)
    bits = np.arange(7, -1, -1)
    node = (1 << np.arange(8)) | (byte[:, None] >> (bits + 1))
    return (context[:, None] << 8) | node, (byte[:, None] >> bits) & 1


def node_entries(grams: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted nodes of counted grams of an order, and their entries."""
    at, bits = nodes(grams, order)
    by = np.argsort(at, axis=None, kind="stable")
    at, ones, weight = at.ravel()[by], bits.ravel()[by], np.repeat(counts, 8)[by].astype(np.float64)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    if not len(first):
        return at, np.zeros(0, np.uint16)
    hits, tries = np.add.reduceat(weight * ones, first), np.add.reduceat(weight, first)
    return at[first], entries(tries - hits, hits)


EMPTY = entries(np.zeros(1), np.zeros(1))[0]


def part_tables(grams: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes and entries of the orders above LOW from a part's counted 6-grams."""
    grams, counts = _merge([(grams, counts)])
    out = []
    for order in range(LOW + 1, ORDERS + 1):
        out.append(node_entries(*_merge([(_prefix(grams, order), counts)]), order))
    return out


def high_entries(tables: list[tuple[np.ndarray, np.ndarray]], grams: np.ndarray) -> np.ndarray:
    """Entries (grams, 8, ORDERS - LOW) of sorted distinct 6-grams from their part's tables."""
    found = np.full((len(grams), 8, ORDERS - LOW), EMPTY, np.uint16)
    for k, (keys, values) in enumerate(tables):
        if len(keys):
            short, copies = distinct(_prefix(grams, LOW + 1 + k))
            want = nodes(short, LOW + 1 + k)[0]
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            found[:, :, k] = np.repeat(np.where(keys[at] == want, values[at], EMPTY), copies, axis=0)
    return found


def low_entries(low: list[np.ndarray], grams: np.ndarray) -> np.ndarray:
    """Entries (grams, 8, LOW) from the tables of the low orders."""
    return np.stack([low[k][nodes(_prefix(grams, k + 1), k + 1)[0]] for k in range(LOW)], axis=2)


def _mixed(model: Model, given: Inputs) -> np.ndarray:
    return np.clip(np.einsum("gbo,gbo->gb", given.logits, model.weights[given.gate].astype(np.float32)), -12, 12)


def _map_at(logit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = (np.clip(logit, -7.999, 7.999) + 8) * ((BUCKETS - 1) / 16)
    low = x.astype(np.int64)
    return low, x - low


def probabilities(model: Model, given: Inputs) -> np.ndarray:
    """P(bit = 1): the mean of the mixed and the refined one, kept off 0 and 1."""
    logit = _mixed(model, given)
    low, part = _map_at(logit)
    gate = given.gate
    fine = model.refined[gate, low] * (1 - part) + model.refined[gate, low + 1] * part
    return np.clip(0.5 * (1 / (1 + np.exp(-logit)) + fine), 1e-6, 1 - 1e-6)


def costs(model: Model, grams: np.ndarray) -> np.ndarray:
    """log10 probability of the byte of each sorted distinct 6-gram."""
    out = np.empty(len(grams))
    for at in range(0, len(grams), 65_536):  # in pieces that stay in the cache
        given = inputs(model.table, grams[at : at + 65_536])
        p = probabilities(model, given)
        out[at : at + 65_536] = np.log10(np.where(given.bits == 1, p, 1 - p)).sum(axis=1)
    return out


def found_costs(model: Model, tables: list[tuple[np.ndarray, np.ndarray]], grams: np.ndarray) -> np.ndarray:
    """log10 probability of the byte of each sorted distinct 6-gram of a part."""
    out = np.empty(len(grams))
    for at in range(0, len(grams), 65_536):
        some = grams[at : at + 65_536]
        inputs_ = given(np.concatenate([low_entries(model.table, some), high_entries(tables, some)], axis=2), some)
        p = probabilities(model, inputs_)
        out[at : at + 65_536] = np.log10(np.where(inputs_.bits == 1, p, 1 - p)).sum(axis=1)
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _by_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and for each key its place among them.

    Few byte values occur in one block, so a key and its place mostly fit 64 bits and one sort of
    plain integers does it; else the general way.
    """
    pairs = keys.astype("<u8", copy=False).view("<u2").reshape(-1, 4)[:, : _GRAM // 2]
    seen = np.zeros((256, 256), bool)
    for k in range(_GRAM // 2):
        seen.reshape(-1)[pairs[:, k]] = True
    used = seen.any(axis=0) | seen.any(axis=1)
    width, place_bits = max(1, int(used.sum() - 1).bit_length()), max(1, (len(keys) - 1).bit_length())
    if _GRAM * width + place_bits > 64:
        return np.unique(keys, return_inverse=True)
    rank = (np.cumsum(used) - 1).astype(np.uint64)
    of_pair = ((rank[:, None] << np.uint64(width)) | rank[None, :]).ravel()
    packed = np.zeros(len(keys), np.uint64)
    for k in range(_GRAM // 2 - 1, -1, -1):
        packed <<= np.uint64(2 * width)
        packed |= of_pair[pairs[:, k]]
    packed <<= np.uint64(place_bits)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    at = (packed & np.uint64((1 << place_bits) - 1)).astype(np.int64)
    packed >>= np.uint64(place_bits)
    new = np.concatenate([[True], packed[1:] != packed[:-1]])
    code = np.empty(len(keys), np.int32)
    code[at] = np.cumsum(new, dtype=np.int32) - 1
    return keys[at[new]], code


def text_scores(model: Model, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of each text and its end."""
    buffer, places, firsts = padded(raw, offsets)
    each = np.empty(len(places))
    for at in range(0, len(places), BLOCK):
        keys = gram_keys(buffer, places[at : at + BLOCK])
        grams, code = _by_key(keys)
        each[at : at + BLOCK] = costs(model, grams)[code]
    return np.add.reduceat(each, firsts) if len(firsts) else np.zeros(0)


def learn_block(model: Model, hits: np.ndarray, tries: np.ndarray, grams: np.ndarray, counts: np.ndarray, found: np.ndarray | None = None) -> None:
    """One online step: weights move against the gradient of the block's cost, the map's counts grow."""
    seen = inputs(model.table, grams) if found is None else given(found, grams)
    logit = _mixed(model, seen)
    weight = np.repeat(counts.astype(np.float64), 8)
    gate, bits = seen.gate.ravel(), seen.bits.ravel()
    error = (bits - 1 / (1 + np.exp(-logit.ravel()))) * weight
    total = np.bincount(gate, weight, GATES)
    for o in range(ORDERS):
        slope = np.bincount(gate, error * seen.logits[:, :, o].ravel(), GATES)
        model.weights[:, o] += RATE * slope / np.maximum(total, 1)
    low, part = _map_at(logit.ravel())
    for at, share in ((low, 1 - part), (low + 1, part)):
        flat = gate * BUCKETS + at
        tries += np.bincount(flat, weight * share, GATES * BUCKETS)
        hits += np.bincount(flat, weight * share * bits, GATES * BUCKETS)


# ---------------------------------------------------------------------------------- Spark jobs

_KIND_GRAM, _KIND_WORD = 0, 1
END = 0  # the end token's place among word hashes


def _merge(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes as signed integers, none of them END, and words by text."""
    hashes, counts = word_hashes(raw, offsets)
    hashes = hashes.view(np.int64)
    return np.where(hashes == END, 1, hashes), counts


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(kind, key, n): 6-grams of the texts for the counts, word hashes of all training texts.

    docs: text, mixer (this training text is kept for the mixer). A task merges its batches' counts
    and gives what it holds when that grows large, so its memory is bounded. They travel sorted and
    compressed in KEY_RUNS runs of keys, and a run is summed up at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {_KIND_GRAM: [], _KIND_WORD: []}

        def out(kind: int) -> Iterator[pa.RecordBatch]:
            keys, counts = _merge(held[kind])
            held[kind] = []
            for bucket, at in _by_part(keys.view(np.uint64), KEY_RUNS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind], pa.int32()), pa.array([bucket], pa.int32()), pa.array([_pack(np.concatenate([keys[at].view(np.int64), counts[at]]))], pa.binary())],
                    ["kind", "bucket", "payload"],
                )

        for batch in batches:
            for part in slices(batch, "text", BLOCK):
                raw, offsets = text_buffer(part.column("text"))
                words, _ = _words(raw, offsets)
                held[_KIND_WORD].append(np.unique(words, return_counts=True))
                counted = part.filter(pa.array(~part.column("mixer").to_numpy(zero_copy_only=False)))
                raw, offsets = text_buffer(counted.column("text"))
                buffer, places, _ = padded(raw, offsets)
                for at in range(0, len(places), BLOCK):
                    held[_KIND_GRAM].append(distinct(gram_keys(buffer, places[at : at + BLOCK])))
                for kind, parts in held.items():
                    if len(parts) >= 8:
                        held[kind] = [_merge(parts)]
                        if len(held[kind][0][0]) > 2_000_000:
                            yield from out(kind)
        for kind, parts in held.items():
            if parts:
                yield from out(kind)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, of = [], 0, None

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                keys, counts = _merge(held)
                kinds = np.full(len(keys), of[0], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(keys), pa.array(counts)], ["kind", "key", "n"])

        for batch in batches:
            for *place, raw in zip(batch.column("kind").to_pylist(), batch.column("bucket").to_pylist(), batch.column("payload"), strict=True):
                if place != of:
                    yield from out()
                    held, size, of = [], 0, place
                keys, counts = _unpack(raw.as_py(), np.int64).reshape(2, -1)
                held.append((keys, counts))
                size += len(keys)
                if size > 4_000_000:
                    held = [_merge(held)]
                    size = len(held[0][0])
        yield from out()

    packed = docs.select("text", "mixer").mapInArrow(run, "kind int, bucket int, payload binary")
    dealt = packed.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket")
    return dealt.mapInArrow(summed, "kind int, key long, n long")


def low_tables(counts: DataFrame) -> list[np.ndarray]:
    """The entries of the orders up to LOW, by context and bits so far; built in tasks by the last byte."""
    grams = counts.filter(F.col("kind") == _KIND_GRAM).groupBy(F.shiftright("key", 8 * (ORDERS - LOW)).alias("key")).agg(F.sum("n").alias("n"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("key").to_numpy().astype(np.uint64), b.column("n").to_numpy()) for b in batches]
        if held:
            keys, counts = _merge(held)
            for order in range(1, LOW + 1):
                at, values = node_entries(*_merge([(keys >> np.uint64(8 * (LOW - order)), counts)]), order)
                yield pa.RecordBatch.from_arrays([pa.array([order], pa.int32()), pa.array([at.astype("<i8").tobytes()]), pa.array([values.tobytes()])], ["order", "places", "entries"])

    last = F.pmod(F.shiftright("key", 8 * (LOW - 1)), F.lit(256))
    table = [np.full(1 << (8 * k + 8), EMPTY, np.uint16) for k in range(1, LOW + 1)]
    for r in grams.repartition(last).mapInArrow(build, "order int, places binary, entries binary").toLocalIterator():  # 2**24 entries at most
        table[r.order - 1][np.frombuffer(bytes(r.places), "<i8")] = np.frombuffer(bytes(r.entries), np.uint16)
    return table


def shared_tables(spark: SparkSession, low: list[np.ndarray]) -> Broadcast:
    """The tables of the low orders for all tasks, compressed: most of their entries are empty, and every machine keeps a copy on disk."""
    return spark.sparkContext.broadcast([zstandard.ZstdCompressor(level=1).compress(table) for table in low])


def read_tables(shared: Broadcast) -> list[np.ndarray]:
    return [np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint16) for raw in shared.value]


_ROWS = "slice long, part int, payload binary"
_TEXTS = -1  # in place of a part: the slice's texts; in place of a slice: a part's counts


def _parts_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of each 6-gram: by its last three context bytes, so all that the high orders ask for is in one part."""
    context = (grams >> np.uint64(8 * (ORDERS - LOW - 1))) & np.uint64((1 << (8 * (LOW + 1))) - 1)
    return (mix64((context + np.uint64(1)) * _C) % np.uint64(parts)).astype(np.int32)


def _pack(values: np.ndarray) -> bytes:
    """The values compressed byte place by byte place: sorted or alike, they compress well so."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes())


def _unpack(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _row(number: int, part: int, payload: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([part], pa.int32()), pa.array([payload], pa.binary())], ["slice", "part", "payload"])


def _by_part(grams: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs, and the places of its 6-grams in order."""
    part = _parts_of(grams, parts)
    by = np.argsort(part, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], part[by][1:] != part[by][:-1], [True]])) if len(by) else []
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(part[by[a]]), by[a:b]


def _block_grams(buffer: np.ndarray, places: np.ndarray) -> np.ndarray:
    pieces = [distinct(gram_keys(buffer, places[at : at + BLOCK]))[0] for at in range(0, len(places), BLOCK)]
    return pieces[0] if len(pieces) == 1 else distinct(np.concatenate([np.zeros(0, np.uint64), *pieces]))[0]


def counted(counts: DataFrame, parts: int) -> DataFrame:
    """The counts of 6-grams in rows by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            keys, n = _merge(held)
            for part, at in _by_part(keys, parts):
                yield _row(_TEXTS, part, _pack(np.concatenate([keys[at].astype(np.uint64), n[at].astype(np.uint64)])))

        for batch in batches:
            held.append((batch.column("key").to_numpy().astype(np.uint64), batch.column("n").to_numpy()))
            size += len(batch)
            if size > 1_000_000:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    return counts.filter(F.col("kind") == _KIND_GRAM).select("key", "n").mapInArrow(run, _ROWS)


def sliced(texts: DataFrame, size: int) -> DataFrame:
    """Slices of about ``size`` bytes of the texts, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", size):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as writer:
                    writer.write_batch(part)
                yield _row(at, _TEXTS, sink.getvalue().to_pybytes())
                at += 1

    return texts.mapInArrow(run, _ROWS)


def _texts_of(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_all().combine_chunks().to_batches()[0]


def asked_grams(rows: DataFrame, parts: int) -> DataFrame:
    """For each slice a row for each part with the slice's distinct 6-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw in zip(batch.column("slice").to_pylist(), batch.column("payload"), strict=True):
                buffer, places, _ = padded(*text_buffer(_texts_of(raw.as_py()).column("text")))
                grams = _block_grams(buffer, places)
                for part, chosen in _by_part(grams, parts):
                    yield _row(number, part, _pack(grams[chosen]))

    return rows.mapInArrow(run, _ROWS)


def answered(asked: DataFrame, known: DataFrame, answers: Callable) -> DataFrame:
    """For each row of 6-grams what a task's ``answers()(tables, grams)`` gives for them, in their order, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = answers()
        part, counts, tables, waiting, size = None, [], None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            every = np.unique(np.concatenate([g for _, g in waiting]))
            values = answer(tables, every)
            for number, grams in waiting:
                found = values[np.searchsorted(every, grams)]
                yield _row(number, part, _pack(found.reshape(len(grams), -1).T))  # 6-grams in order have runs of equal entries

        for batch in batches:
            for number, of, raw in zip(batch.column("slice").to_pylist(), batch.column("part").to_pylist(), batch.column("payload"), strict=True):
                if of != part:
                    if waiting:
                        yield from out()
                    part, counts, tables, waiting, size = of, [], None, [], 0
                raw = raw.as_py()
                if number == _TEXTS:
                    keys, n = _unpack(raw, np.uint64).reshape(2, -1)
                    counts.append((keys, n.astype(np.int64)))
                    continue
                if tables is None:
                    tables = part_tables(*_merge(counts)) if counts else []
                    counts = []
                waiting.append((number, _unpack(raw, np.uint64)))
                size += len(waiting[-1][1])
                if size > 250_000:
                    yield from out()
                    waiting, size = [], 0
        if waiting:
            yield from out()

    return asked.unionByName(known).repartition("part").sortWithinPartitions("part", "slice").mapInArrow(run, _ROWS)


def _coded(buffer: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct 6-grams at the places, and block after block their places among those."""
    found = [_by_key(gram_keys(buffer, places[at : at + CODED])) for at in range(0, len(places), CODED)]
    every = distinct(np.concatenate([np.zeros(0, np.uint64), *(grams for grams, _ in found)]))[0]
    return every, [np.searchsorted(every, grams).astype(np.int32)[code] for grams, code in found]


def _gathered(batches: Iterator[pa.RecordBatch], parts: int, kind: type, shape: tuple) -> Iterator[tuple]:
    """Of each slice, whose rows come one after the other: texts, distinct 6-grams, the places of all among them and the answers for them."""
    for batch in batches:
        for number, of, raw in zip(batch.column("slice").to_pylist(), batch.column("part").to_pylist(), batch.column("payload"), strict=True):
            raw = raw.as_py()
            if of == _TEXTS:
                texts = _texts_of(raw)
                buffer, places, firsts = padded(*text_buffer(texts.column("text")))
                grams, codes = _coded(buffer, places)
                del buffer, places
                chosen = dict(_by_part(grams, parts))
                values = np.empty((len(grams), *shape), kind)
            else:
                at = chosen.pop(of)
                values[at] = _unpack(raw, kind).reshape(-1, len(at)).T.reshape(-1, *shape)
            if not chosen:
                yield texts, firsts, grams, codes, values


def _with_texts(rows: DataFrame, answers: DataFrame) -> DataFrame:
    return rows.unionByName(answers).repartition("slice").sortWithinPartitions("slice", "part")


def train_mixer(rows: DataFrame, known: DataFrame, low: Broadcast, parts: int) -> Model:
    """Weights and map, without tables, from the blocks of the training texts kept for the mixer; one row for each task comes back."""
    answers = answered(asked_grams(rows, parts), known, lambda: high_entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, seen = blank(read_tables(low)), 0
        hits, tries = np.zeros(GATES * BUCKETS), np.zeros(GATES * BUCKETS)
        for _, _, every, codes, values in _gathered(batches, parts, np.uint16, (8, ORDERS - LOW)):
            code = np.concatenate(codes)
            for at in range(0, len(code), MIXER_BLOCK):
                chosen, counts = distinct(code[at : at + MIXER_BLOCK])
                grams = every[chosen]
                found = np.concatenate([low_entries(model.table, grams), values[chosen]], axis=2)
                learn_block(model, hits, tries, grams, counts, found)
                seen += int(counts.sum())
        if seen:
            values = np.concatenate([model.weights.ravel() * seen, hits, tries, [seen]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int64()), pa.array(values)], ["place", "value"])

    sums = _with_texts(rows, answers).mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    model = blank([])
    n = GATES * BUCKETS
    total = np.zeros(GATES * ORDERS + 2 * n + 1)
    for r in sums.collect():  # one row for each parameter
        total[r.place] = r.value
    if total[-1]:
        model.weights = (total[: GATES * ORDERS] / total[-1]).reshape(GATES, ORDERS)
        hits, tries = total[GATES * ORDERS :][:n].reshape(GATES, BUCKETS), total[GATES * ORDERS + n :][:n].reshape(GATES, BUCKETS)
        model.refined = (hits + 8 * model.refined) / (tries + 8)
    return model


def _scored(docs: DataFrame, known: DataFrame, parts: int, low: Broadcast, model: Model, top: tuple[np.ndarray, np.ndarray], base: tuple[float, float]) -> DataFrame:
    """A row for each document: its score, the base score of its known frequent words and end, and its other words."""
    context = docs.sparkSession.sparkContext
    shared, frequent = context.broadcast(model), context.broadcast(top)
    end_value, total = base
    rows = staged(sliced(docs.select("doc_id", "held_out", "text"), SCORE_BLOCK), "lm-blocks")

    def of_model() -> Callable:
        whole = dataclasses.replace(shared.value, table=read_tables(low))
        return lambda tables, grams: found_costs(whole, tables, grams).astype(np.float32)

    answers = answered(asked_grams(rows, parts), known, of_model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top_keys, top_values = frequent.value
        for part, firsts, _, codes, values in _gathered(batches, parts, np.float32, ()):
            _, offsets = text_buffer(part.column("text"))
            each = np.concatenate([values[code] for code in codes]).astype(np.float64)
            score = np.add.reduceat(each, firsts)
            found = [_words(*text_buffer(p.column("text"))) for p in slices(part, "text", CODED)]
            words, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            edges = np.concatenate([[0], np.cumsum(counts)])
            at = np.searchsorted(top_keys, words)
            at[at == len(top_keys)] = 0
            known = top_keys[at] == words if len(top_keys) else np.zeros(len(words), bool)
            sums = np.concatenate([[0.0], np.cumsum(np.where(known, top_values[at], 0.0) if len(top_keys) else np.zeros(len(words)))])
            found = np.concatenate([[0], np.cumsum(known)])
            rest_edges = edges - found[edges]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(counts + 1),
                    pa.array(found[edges[1:]] - found[edges[:-1]] + int(end_value[1])),
                    pa.array(sums[edges[1:]] - sums[edges[:-1]] + end_value[0]),
                    pa.array(score),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(pa.array(rest_edges.astype(np.int32)), pa.array(words[~known])),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes", "rest"],
            )

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long, rest array<long>"
    return _with_texts(rows, answers).mapInArrow(run, schema)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts, learned from those where ``held_out`` is false.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.
    """
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        held_out.alias("held_out"),
    )
    mixer = F.pmod(F.xxhash64("doc_id", F.lit("mixer")), F.lit(MIXER_SHARE)) == 0
    training = source.filter(~F.col("held_out")).withColumn("mixer", mixer)
    counts = staged(corpus_counts(training), "lm-counts", batch_bytes=BATCH_BYTES)
    parts = max(PARTS, -(-counts.filter(F.col("kind") == _KIND_GRAM).count() // GRAMS_A_PART))
    known = counted(counts, parts)
    learning = staged(sliced(training.filter("mixer").select("doc_id", "held_out", "text"), BLOCK), "lm-mixer")
    low = shared_tables(docs.sparkSession, low_tables(counts))
    model = train_mixer(learning, known, low, parts)

    words = counts.filter(F.col("kind") == _KIND_WORD).select("key", "n")
    ends = training.count()
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, kinds = (sums.n or 0) + ends, sums.v + (1 if ends else 0)
    scale = total + 0.5 * (kinds + 1)

    def value(n):
        return np.log10((n + 0.5) / scale)

    frequent = words.orderBy(F.desc("n"), "key").limit(TOP_WORDS).collect()  # TOP_WORDS rows at most
    keys = np.array(sorted(r.key for r in frequent), np.int64)
    by_key = {r.key: r.n for r in frequent}
    top = (keys, np.array([value(by_key[k]) for k in keys.tolist()], np.float64))
    rows = _scored(source, known, parts, low, model, top, ((float(value(ends)), bool(ends)), total))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "lm-scored", batch_bytes=BATCH_BYTES)

    rest = rows.select("row", F.explode("rest").alias("key"))
    log = F.log10((F.coalesce("n", F.lit(0)) + F.lit(0.5)) / F.lit(float(scale)))
    looked_up = rest.join(words, "key", "left").select("row", F.col("n").isNotNull().cast("long").alias("known"), log.alias("log"))
    others = looked_up.groupBy(F.col("row").alias("of")).agg(F.sum("log").alias("log"), F.sum("known").alias("known"))
    joined = rows.join(others, rows["row"] == others["of"], "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("log", F.lit(0.0))).alias("base_score"),
        "score",
        "n_bytes",
        (-F.col("score") / F.log10(F.lit(2.0)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
