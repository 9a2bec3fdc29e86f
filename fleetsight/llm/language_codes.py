"""Languages of whole texts by error-correcting output codes.

Each language gets a codeword. A binary classifier for each bit gives evidence for 1 over 0 from
hashed byte n-grams (2 to 4 bytes of lower-cased letters and the spaces between words): the sum of
learned log-odds over all n-grams of the text, on a logarithmic scale and through a logistic curve. A codeword's loss is the
sum over its bits of the logistic loss of the evidence, each bit weighted by how well its classifier
did on rows kept apart. The codeword of the least loss names the language; where the runner-up is
close, the row is flagged as ambiguous.

The classifiers are fitted on a bounded sample of labelled rows (``SAMPLE_DOCUMENTS``, shared evenly
by the languages and chosen by a hash); of them a quarter is kept apart for the curves and weights.
Scoring takes each row by itself; nothing is shuffled.

Up to five languages have the exhaustive code (all ways to split them in two); more have rows of a
seeded search that keeps codewords far apart, ``10 log2`` of the languages long.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text
if nothing could be learned. With one language it is that one with score 1. Null ids and repeated rows are
kept; a sampled row that is repeated counts each time. An empty table gives no rows.
"""

from __future__ import annotations

import dataclasses
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetsight.llm.common import PART_BYTES, broadcast_value, slices, staged, text_buffer

SAMPLE_DOCUMENTS = 4_000  # bound of the labelled rows that are learned from
BUCKETS = 1 << 16
UNKNOWN = "und"
AMBIGUOUS = 0.5  # a runner-up of at most this much more loss
LETTER = r"\p{L}"
BLOCK_BYTES = 32 << 20  # of log-odds that are looked up at once
HELD_LANGUAGES = 32  # whose counts a task holds

# letters of ASCII as themselves, other ASCII as a space, bytes of other characters as themselves
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclasses.dataclass
class Codes:
    """A fitted model. Row i of ``words`` (+1 or -1 a bit) is the codeword of ``languages[i]``."""

    languages: list[str]
    words: np.ndarray
    odds: np.ndarray  # BUCKETS x bits, log-odds of bit 1
    slope: np.ndarray  # of each bit's logistic curve
    offset: np.ndarray
    weight: np.ndarray  # sums to the number of bits


def grams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 2, 3 and 4 bytes: each n-gram's bucket, and where each text's n-grams begin.

    A text stands between two spaces, so a text of n bytes has n + 2 places; n-grams stay inside it.
    """
    n_texts = len(offsets) - 1
    starts = offsets[:-1] + 2 * np.arange(n_texts)
    stream = np.full(len(raw) + 2 * n_texts, 32, np.uint32)
    inside = np.ones(len(stream), bool)
    inside[starts] = inside[starts + np.diff(offsets) + 1] = False
    stream[inside] = _FOLD[raw]
    value = stream[:-1] << 8 | stream[1:]
    for n in (2, 3, 4):
        if n > 2:
            value = value[:-1] << np.uint32(8) | stream[n - 1 :]
        keys = (value * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(0xC2B2AE35) >> np.uint32(16)
        # drop what runs over a text's end: the last n - 1 places of each text
        keep = np.ones(len(keys), bool)
        ends = starts + np.diff(offsets) + 2
        for back in range(1, n):
            at = ends - back
            keep[at[(at < len(keep)) & (at >= 0)]] = False
        sizes = np.maximum(np.diff(offsets) + 2 - (n - 1), 0)
        yield keys[keep], np.cumsum(sizes) - sizes


def evidence(raw: np.ndarray, offsets: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Per text and bit: the summed log-odds of all n-grams, on a logarithmic scale either side of 0.

    N-grams overlap, so their sum grows too fast to be a probability's logit; its order is right.
    """
    lengths = np.diff(offsets)
    total = np.zeros((len(lengths), odds.shape[1]))
    block = max(1, BLOCK_BYTES // (odds.itemsize * max(1, odds.shape[1])))
    for keys, starts in grams(raw, offsets):
        if not len(keys):
            continue
        some = np.flatnonzero(np.diff(np.append(starts, len(keys))) > 0)
        begins = starts[some]
        for at in range(0, len(keys), block):  # a text longer than a block is summed in pieces
            stop = min(at + block, len(keys))
            low, high = np.searchsorted(begins, at, "right") - 1, np.searchsorted(begins, stop)
            cuts = np.maximum(begins[low:high], at) - at
            total[some[low:high]] += np.add.reduceat(odds[keys[at:stop]], cuts, axis=0)
    return np.sign(total) * np.log1p(np.abs(total))


# ---- codewords --------------------------------------------------------------------------------
def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n codewords of +1 and -1, any two of which differ in many bits."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:  # each split of the languages in two once; the first is always on the side of +1
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, dtype=float).T
    bits = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(50):
        words = rng.choice((-1.0, 1.0), (n, bits))
        words[:, (words == words[0]).all(axis=0)] *= np.where(np.arange(n) % 2, -1.0, 1.0)[:, None]
        agree = words @ words.T - 2 * bits * np.eye(n)
        least = (bits - agree.max()) / 2
        if least > apart:
            best, apart = words, least
    return best


# ---- training ---------------------------------------------------------------------------------
def _sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, limit: int) -> DataFrame:
    """(h, lang, text) of at most ``limit`` distinct rows, about as many of each language."""
    text, lang = F.col(text_col).cast("string"), F.col(lang_col).cast("string")
    rows = docs.filter(learn).select(F.xxhash64(F.col(id_col).cast("string"), text, lang).alias("h"), lang.alias("lang"), text.alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    # a language with fewer rows leaves its share to no other: the bound is all that matters
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = counts.select(F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.count(F.lit(1)))))).scalar()
    # rows that may be among a language's first by hash: about twice its share, so no task ranks a whole language
    likely = F.pmod("h", F.lit(1 << 20)) < F.ceil(F.lit(2 << 20) * (share + 50) / F.col("n"))
    # a sample of so many rows has no more languages: the most frequent ones, a row each
    known = counts.orderBy(F.desc("n"), "lang").limit(limit)
    few = rows.select("h", "lang").join(F.broadcast(known), "lang").filter(likely)
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 20)), "h")
    ranked = few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= share)
    chosen = ranked.orderBy("rank", "h").limit(limit).select("h").distinct()
    return rows.join(F.broadcast(chosen), "h")  # limit rows at most


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    limit: int = SAMPLE_DOCUMENTS,
) -> Codes:
    """Fit the classifiers on rows for which ``learn`` holds. What reaches the driver is bounded by ``limit``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([rows[lang]]), pa.array([at], pa.list_(pa.int64())), pa.array([total[at]], pa.list_(pa.int64()))],
                    names=["lang", "docs", "buckets", "counts"],
                )

        for batch in batches:
            parts = (part.slice(i, HELD_LANGUAGES) for part in slices(batch, "text", PART_BYTES) for i in range(0, part.num_rows, HELD_LANGUAGES))
            for part in parts:
                raw, offsets = text_buffer(pc.utf8_lower(part.column("text")))
                langs = part.column("lang").to_pylist()
                for keys, starts in grams(raw, offsets):
                    ends = np.append(starts[1:], len(keys))
                    for lang, s, e in zip(langs, starts.tolist(), ends.tolist(), strict=True):
                        sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                        sums[lang] += np.bincount(keys[s:e], minlength=BUCKETS)
                for lang in langs:
                    rows[lang] = rows.get(lang, 0) + 1
                if len(sums) > HELD_LANGUAGES:  # the driver adds up what tasks give, so a language may come again
                    yield from out()
                    sums, rows = {}, {}
        yield from out()

    sample = staged(_sample(docs, learn, id_col, text_col, lang_col, limit).repartition(8), "language-sample")
    apart = F.pmod("h", F.lit(4)) == 3
    found = sample.filter(~apart).select("lang", "text").mapInArrow(counted, "lang string, docs long, buckets array<long>, counts array<long>").toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    words = codewords(len(languages))
    bits = words.shape[1] if languages else 0
    by_lang = np.zeros((len(languages), BUCKETS))
    for lang, at, n in zip(found.column("lang").to_pylist(), found.column("buckets"), found.column("counts"), strict=True):
        by_lang[languages.index(lang), at.values.to_numpy()] += n.values.to_numpy()
    shares = by_lang / np.maximum(by_lang.sum(axis=1, keepdims=True), 1)  # languages weigh alike, however much text they have
    odds = np.zeros((BUCKETS, bits), np.float32)
    floor = 0.1 / BUCKETS
    for b in range(bits):
        ones, zeros = words[:, b] > 0, words[:, b] < 0
        if ones.any() and zeros.any():
            odds[:, b] = np.log((shares[ones].mean(axis=0) + floor) / (shares[zeros].mean(axis=0) + floor))
    codes = Codes(languages, words, odds, np.ones(bits), np.zeros(bits), np.ones(bits))
    if len(languages) < 2:
        return codes
    shared = broadcast_value(docs.sparkSession, codes)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", PART_BYTES):
                found = evidence(*text_buffer(pc.utf8_lower(part.column("text"))), shared.value.odds)
                yield pa.RecordBatch.from_arrays([part.column("h"), part.column("lang"), pa.array(list(found), pa.list_(pa.float64()))], names=["h", "lang", "z"])

    kept = sample.filter(apart).mapInArrow(weighed, "h long, lang string, z array<double>").dropDuplicates(["h"]).toArrow()
    known = [i for i, lang in enumerate(kept.column("lang").to_pylist()) if lang in set(languages)]
    if known:
        z = np.array(kept.column("z").to_pylist())[known]
        y = words[[languages.index(lang) for lang in np.array(kept.column("lang").to_pylist())[known]]]
        codes.slope, codes.offset, codes.weight = _curves(z, y)
    return codes


def _curves(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each bit's logistic curve (by Newton's method, slightly regularized) and its weight: how far it beats guessing."""
    bits = z.shape[1]
    slope, offset, weight = np.ones(bits), np.zeros(bits), np.ones(bits)
    for b in range(bits):
        x, t = z[:, b], (y[:, b] > 0).astype(float)
        design = np.stack([x, np.ones(len(x))], axis=1)
        w = np.array([1.0, 0.0])
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
            slack = 1e-3 * len(x)
            step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + slack * np.eye(2), design.T @ (p - t) + slack * (w - [1.0, 0.0]))
            w = w - step
            if np.abs(step).max() < 1e-9:
                break
        slope[b], offset[b] = w
        weight[b] = max((((design @ w) > 0) == (t > 0)).mean() - 0.5, 0.01)
    return slope, offset, weight * bits / weight.sum()


# ---- scoring ----------------------------------------------------------------------------------
def decode(codes: Codes, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(language's place, its share of exp(-loss), ambiguous) of each row of evidence."""
    margin = z * codes.slope + codes.offset
    agree = codes.weight * np.logaddexp(0, -margin)  # the loss of a bit that should be +1
    differ = codes.weight * np.logaddexp(0, margin)
    loss = agree @ (codes.words.T > 0) + differ @ (codes.words.T < 0)
    order = np.argsort(loss, axis=1, kind="stable")
    rows = np.arange(len(z))
    first, second = loss[rows, order[:, 0]], loss[rows, order[:, min(1, loss.shape[1] - 1)]]
    share = 1 / np.exp(first[:, None] - loss).sum(axis=1)
    return order[:, 0], share, (second - first <= AMBIGUOUS) & (len(codes.languages) > 1)


def predict(docs: DataFrame, codes: Codes, text_col: str = "text") -> DataFrame:
    """The rows with ``lang_pred``, ``score`` and ``ambiguous`` added (in place of columns of these names)."""
    shared = broadcast_value(docs.sparkSession, codes)
    added = "lang_pred string, score double, ambiguous boolean"
    rows = docs.drop("lang_pred", "score", "ambiguous")

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        names = np.array([*codes.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch, text_col, PART_BYTES):
                text = part.column(text_col)
                some = np.asarray(pc.fill_null(pc.match_substring_regex(text, LETTER), False))
                if len(codes.languages) > 1:
                    place, share, close = decode(codes, evidence(*text_buffer(pc.utf8_lower(text)), codes.odds))
                else:
                    place, share = np.zeros(len(some), int), np.full(len(some), float(len(codes.languages)))
                    close = np.zeros(len(some), bool)
                some = some & (len(codes.languages) > 0)
                place = np.where(some, place, len(codes.languages))
                columns = [*part.columns, pa.array(names[place], pa.string()), pa.array(np.where(some, share, 0.0)), pa.array(close & some)]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "lang_pred", "score", "ambiguous"])

    schema = StructType([*rows.schema.fields, *StructType.fromDDL(added).fields])
    return rows.mapInArrow(predicted, schema)
