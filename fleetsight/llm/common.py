"""What the operators share: the word rule, Arrow access to texts, staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.session import checkpoint_dir

# Fixed value: words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

# Texts that a Python function works on at once: its arrays take 50 to 200 bytes for each byte of text.
PART_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None, batch_bytes: int | None = None) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    This cuts lineage like ``checkpoint()``, and later stages can prune its columns. The folder
    is that of ``spark.checkpoint.dir``; the deployment clears it as it clears checkpoints.
    ``batch_bytes`` bounds the Arrow batches that go to Python functions meanwhile: Spark's own bound
    of 64 MB is held several times by each task, in the JVM and in Python.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark, allow_local_default=True)}/llm-{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(BATCH_CONF, None)
    if batch_bytes:
        spark.conf.set(BATCH_CONF, str(batch_bytes))
    try:
        writer.parquet(path)
    finally:
        if batch_bytes:
            spark.conf.unset(BATCH_CONF) if before is None else spark.conf.set(BATCH_CONF, before)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, batch_bytes: int = 4 << 20) -> None:
    """Let the session's Arrow batches be of ``batch_bytes`` at most; a smaller bound stays.

    For functions whose result runs after they return, so that ``staged`` can't bound its batches.
    """
    held = spark.conf.get(BATCH_CONF, None)
    if held is None or not held.isdigit() or not 0 < int(held) <= batch_bytes:
        spark.conf.set(BATCH_CONF, str(batch_bytes))


def crc_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def broadcast_value(spark: SparkSession, value):
    return spark.sparkContext.broadcast(value)


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text (one row at least)."""
    column = batch.column(text)
    lengths = np.nan_to_num(np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.float64))
    start, held = 0, 0.0
    for i, n in enumerate(lengths):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0.0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit changes about half of the output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_KEYS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_STEP = 0xD6E8FEB86659FD93


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    filled = 1
    while filled < n:  # doubling: the next block is the first one times step^filled
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(_STEP, filled, 1 << 64))
        filled += more
    return out


def word_hashes(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased (A-Z) words of all texts, and how many words each has.

    ``raw`` and ``offsets`` are as from ``text_buffer``. Words never cross texts. ``apart`` marks
    the 256 byte values that stand between words, ASCII white space by default.
    """
    n_texts = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    low = _LOWER[raw]
    inside = ~apart[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    positions = np.flatnonzero(inside)
    word_of = np.cumsum(first)[positions] - 1
    within = positions - starts[word_of]
    powers = _powers(int(within.max()) + 1)
    parts = _BYTE_KEYS[low[positions]] * powers[within]
    heads = np.flatnonzero(first[positions])
    hashes = mix64(np.add.reduceat(parts, heads))
    counts = np.searchsorted(starts, offsets[1:]) - np.searchsorted(starts, offsets[:-1])
    return hashes, counts.astype(np.int64)
