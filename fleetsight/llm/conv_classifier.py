"""Quality of whole documents by a byte-level convolutional network in numpy.

A byte becomes a learned vector and one more channel, which says whether the eight bytes up to here
also stand up to 24 bytes before. Learned filters run over windows of 8 bytes at every second byte
of the whole document. Their responses are max-pooled over overlapping chunks (two neighbouring
spans of 256 bytes), a learned layer gives each chunk a logit, and the mean, least and greatest
logit of a document are combined into one probability.

The filters are trained on chunks of a bounded sample of labelled documents, the combination on
those documents as a whole. Scoring works on each row by itself; nothing is shuffled.

Defined cases: null and empty texts are one chunk of padding and get its score; null ids and
repeated rows are kept; an empty table gives no rows; a label with no document, or a null label, is
not learned from; without labels of both kinds, every score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetsight.llm.common import slices, text_buffer

SAMPLE_DOCUMENTS = 2_000  # bound of the labelled rows that are learned from
SAMPLE_CHUNKS = 4  # and of the chunks taken of each
THRESHOLD = 0.7
SPAN, WIDTH, STRIDE, VECTOR, FILTERS, REACH = 256, 8, 2, 8, 24, 24
EPOCHS, BATCH, RATE = 4, 64, 0.01
PLACES = SPAN // STRIDE
CHANNELS = VECTOR + 1


@dataclasses.dataclass
class Network:
    vectors: np.ndarray  # 256 x VECTOR
    filters: np.ndarray  # WIDTH * CHANNELS x FILTERS
    bias: np.ndarray  # FILTERS
    dense: np.ndarray  # FILTERS
    offset: float
    head: np.ndarray  # of mean, least, greatest logit, and a constant


def layout(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in zero-padded regions of whole spans, WIDTH zeros at least behind each; spans by text."""
    lengths = np.diff(offsets)
    spans = (lengths + WIDTH + SPAN - 1) // SPAN
    begins = (np.cumsum(spans) - spans) * SPAN
    out = np.zeros(int(spans.sum()) * SPAN, np.uint8)
    if len(raw):
        out[np.arange(len(raw)) + np.repeat(begins - offsets[:-1], lengths)] = raw
    return out, spans


def repeats(data: np.ndarray) -> np.ndarray:
    """1 where the eight bytes that end here also end 2 to REACH bytes before (0 for padding)."""
    out = np.zeros(len(data), np.float32)
    if len(data) < WIDTH + REACH:
        return out
    grams = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1)).copy().view(np.uint64)[:, 0]
    found = np.zeros(len(grams), bool)
    for lag in range(2, REACH + 1):
        found[lag:] |= grams[lag:] == grams[:-lag]
    out[7:] = found & (grams != 0)
    return out


def responses(net: Network, data: np.ndarray) -> np.ndarray:
    """Filter responses at every place: (spans, PLACES, FILTERS), before bias."""
    x = np.zeros((len(data) + WIDTH, CHANNELS), np.float32)
    x[: len(data), :VECTOR] = net.vectors[data]
    x[: len(data), VECTOR] = repeats(data)
    windows = np.lib.stride_tricks.as_strided(
        x, (len(data) // STRIDE, WIDTH * CHANNELS), (x.strides[0] * STRIDE, x.strides[1]), writeable=False
    )
    return (windows @ net.filters).reshape(-1, PLACES, FILTERS)


def chunk_logits(net: Network, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunks' logits of all texts, and the number of chunks of each."""
    data, spans = layout(raw, offsets)
    ends = np.cumsum(spans)
    pooled = np.empty((len(data) // SPAN, FILTERS), np.float32)
    step = 512  # spans at a time, so that the windows stay in the cache
    for at in range(0, len(pooled), step):
        stop = min(at + step, len(pooled))
        # one span more, so that windows at the edge see what follows, and one before, for repeats
        lead = SPAN if at else 0
        part = data[at * SPAN - lead : min((stop + 1) * SPAN, len(data))]
        found = responses(net, part)[(lead // SPAN) : (lead // SPAN) + stop - at]
        last = ends[(ends > at) & (ends <= stop)] - 1 - at
        found[last, PLACES - WIDTH // STRIDE + 1 :] = -np.inf  # these windows would reach into the next text
        pooled[at:stop] = found.max(axis=1)
    hidden = np.maximum(pooled + net.bias, 0)
    counts = np.maximum(spans - 1, 1)
    first = np.repeat(ends - spans - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    second = np.minimum(first + 1, np.repeat(ends - 1, counts))
    return np.maximum(hidden[first], hidden[second]) @ net.dense + net.offset, counts


def document_figures(net: Network, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean, least and greatest logit of the chunks of each text, and 1."""
    logits, counts = chunk_logits(net, raw, offsets)
    starts = np.cumsum(counts) - counts
    logits = logits.astype(np.float64)
    columns = [np.add.reduceat(logits, starts) / counts, np.minimum.reduceat(logits, starts), np.maximum.reduceat(logits, starts)]
    return np.stack([*columns, np.ones(len(counts))], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def train_filters(chunks: np.ndarray, labels: np.ndarray, seed: int = 0) -> Network:
    """Filters and dense layer by Adam on the log loss; chunks: (n, 2 * SPAN) bytes."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.5, (256, VECTOR)).astype(np.float32),
        rng.normal(0, 0.15, (WIDTH * CHANNELS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        rng.normal(0, 0.3, FILTERS).astype(np.float32),
        float(np.log((labels.mean() + 1e-3) / (1 - labels.mean() + 1e-3))),
        np.array([1.0, 0.0, 0.0, 0.0]),
    )
    offset = np.array([net.offset], np.float32)
    params = [net.vectors, net.filters, net.bias, net.dense, offset]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    places = (2 * SPAN - WIDTH) // STRIDE + 1
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(chunks))
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            data, y = chunks[pick], labels[pick]
            n = len(pick)
            x = np.empty((n, 2 * SPAN, CHANNELS), np.float32)
            x[:, :, :VECTOR] = net.vectors[data]
            x[:, :, VECTOR] = np.stack([repeats(d) for d in data])
            s = x.strides
            windows = np.lib.stride_tricks.as_strided(x, (n, places, WIDTH * CHANNELS), (s[0], s[1] * STRIDE, s[2]), writeable=False)
            found = (windows.reshape(n * places, -1) @ net.filters).reshape(n, places, FILTERS)
            best = found.argmax(axis=1)  # n x FILTERS
            peak = np.take_along_axis(found, best[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(peak, 0)
            error = (_sigmoid(hidden @ net.dense + offset[0]) - y).astype(np.float32) / n
            g_peak = error[:, None] * net.dense * (peak > 0)
            chosen = windows[np.arange(n)[:, None], best]  # n x FILTERS x WIDTH * CHANNELS
            g_filters = np.einsum("nf,nfw->wf", g_peak, chosen)
            back = (g_peak[:, :, None] * net.filters.T[None]).reshape(n, FILTERS, WIDTH, CHANNELS)[..., :VECTOR]
            bytes_at = data[np.arange(n)[:, None, None], best[:, :, None] * STRIDE + np.arange(WIDTH)]
            g_vectors = np.zeros_like(net.vectors)
            np.add.at(g_vectors, bytes_at.ravel(), back.reshape(-1, VECTOR))
            grads = [g_vectors, g_filters, g_peak.sum(0), hidden.T @ error + 1e-4 * net.dense, np.array([error.sum()], np.float32)]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.offset = float(offset[0])
    return net


def fit_head(figures: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression on the documents' figures by Newton steps with a small ridge."""
    w = np.array([1.0, 0.0, 0.0, 0.0])
    for _ in range(25):
        p = _sigmoid(figures @ w)
        hessian = (figures * (p * (1 - p))[:, None]).T @ figures + 1e-2 * np.eye(4)
        move = np.linalg.solve(hessian, figures.T @ (labels - p) - 1e-2 * (w - [1, 0, 0, 0]))
        w = w + np.clip(move, -2, 2)
    return w


def _sample_chunks(data: bytes, key: int) -> list[bytes]:
    """Some chunks of a training document, dealt over its whole length."""
    size = 2 * SPAN
    if len(data) <= size:
        return [data.ljust(size, b"\0")]
    n = min(SAMPLE_CHUNKS, -(-len(data) // SPAN) - 1)
    starts = np.random.default_rng(key).integers(0, len(data) - size + 1, n)
    return [data[s : s + size] for s in starts.tolist()]


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = SAMPLE_DOCUMENTS) -> Network:
    """Learn from at most ``sample`` labelled documents, those with the smallest hash of their id.

    docs: doc_id, text. labels: doc_id, label. usable: condition on the labels' rows. Only the
    sample's ids are joined to the documents, so texts aren't shuffled.
    """
    spark = docs.sparkSession
    kept = labels.filter(usable & F.col("label").isNotNull() & F.col("doc_id").isNotNull())
    chosen = kept.groupBy("doc_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = [(r.doc_id, float(r.label)) for r in chosen.collect()]
    few = F.broadcast(spark.createDataFrame(rows, "doc_id long, label double"))  # at most ``sample`` rows
    texts = docs.join(few, "doc_id").select("doc_id", "label", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (key, label, chunk)
                for key, label, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "text")), strict=True)
                for chunk in _sample_chunks((text or "").encode(), abs(key))
            ]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.float64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "chunk"])

    found = texts.mapInArrow(cut, "doc_id long, label double, chunk binary").orderBy("doc_id", "chunk").collect()
    y = np.array([r.label for r in found])
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        head = np.array([0, 0, 0, np.log(max(share, 1e-6) / max(1 - share, 1e-6))])
        zeros = np.zeros
        return Network(zeros((256, VECTOR), np.float32), zeros((WIDTH * CHANNELS, FILTERS), np.float32), zeros(FILTERS, np.float32), zeros(FILTERS, np.float32), 0.0, head)
    chunks = np.frombuffer(b"".join(bytes(r.chunk) for r in found), np.uint8).reshape(len(found), 2 * SPAN)
    net = train_filters(chunks, y)
    shared = spark.sparkContext.broadcast(net)

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                f = document_figures(shared.value, *text_buffer(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("label"), *map(pa.array, f.T[:3])], ["label", "mean", "least", "most"])

    whole = texts.mapInArrow(figures, "label double, mean double, least double, most double").orderBy("mean", "least", "most").collect()
    table = np.array([[r.mean, r.least, r.most, 1.0] for r in whole])
    net.head = fit_head(table, np.array([r.label for r in whole]))
    return net


def scores(net: Network, column: pa.Array) -> np.ndarray:
    return _sigmoid(document_figures(net, *text_buffer(column)) @ net.head)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, score for every document. docs: doc_id, text."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores(shared.value, part.column("text")))], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, net: Network, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents with a score of at least ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col, 1 << 20):
                yield part.filter(pa.array(scores(shared.value, part.column(text_col)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
