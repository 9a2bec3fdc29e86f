"""Token ids in files: a shared zstandard dictionary, one frame for each document, an offset index.

The store is a folder of two Spark tables, so it works on any file system Spark writes to and
its commits survive lost tasks. ``dictionary`` has one row (hash, content). ``segments`` has one
row for each segment, whose ``content`` is the binary file format:

    4 bytes  magic "TIDS"
   32 bytes  SHA-256 of the dictionary
    4 bytes  n, documents in the segment
   24 * n    index: id (signed 64 bit), ids in the document (unsigned 32 bit), flags (1: the id is
             null), end of the document's frame behind the index (unsigned 64 bit)
    rest     frames: zstandard over little-endian unsigned 32-bit ids, one for each document

All numbers are little-endian. A reader takes one document with the index alone
(``read_document``), without inflating its neighbours.

Defined cases: null text counts as empty (the end id alone); null ids come first, repeated ids
stay in the order of their texts' bytes; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetsight.llm import tokens
from fleetsight.llm.common import slices

MAGIC = b"TIDS"
HEAD = 40
ENTRY = np.dtype([("id", "<i8"), ("n", "<u4"), ("flags", "<u4"), ("end", "<u8")])
SAMPLE_DOCUMENTS = 1_000  # bound of the rows that the dictionary is trained on
SAMPLE_TEXT_BYTES = 16_384  # longer texts aren't taken as samples
DICTIONARY_BYTES = 65_536
SEGMENT_BYTES = 1 << 20
_SEGMENTS = "part long, segment long, n_docs long, n_tokens long, content binary"
_ARROW = pa.schema([(n, pa.int64()) for n in ("part", "segment", "n_docs", "n_tokens")] + [("content", pa.binary())])
_DOCS = "part long, segment long, position long, doc_id long, n_tokens long, before long, ids_crc32 long"


def train_dictionary(docs: DataFrame, tokenizer: str, end: bytes) -> bytes:
    """A dictionary over the ids of a bounded sample: the documents with the smallest id hashes.

    The hashes are ranked alone, so that no task gathers texts but the few that are taken.
    """
    hashed = docs.filter(F.octet_length("text") <= SAMPLE_TEXT_BYTES).withColumn("h", F.xxhash64("doc_id"))
    least = [r.h for r in hashed.select("h").orderBy("h").limit(SAMPLE_DOCUMENTS).collect()]
    rows = hashed.filter(F.col("h") <= max(least)).select("h", "text").limit(SAMPLE_DOCUMENTS).collect() if least else []
    rows.sort(key=lambda r: (r.h, r.text))
    samples = [ids + end for ids in tokens.encoder(tokenizer).encode([r.text for r in rows])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few or too even samples to train on: they are the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def build_segment(digest: bytes, docs: list[tuple[int | None, int, bytes]]) -> bytes:
    """The file format over (id, ids in the document, frame)."""
    index = np.zeros(len(docs), ENTRY)
    index["id"] = [d or 0 for d, _, _ in docs]
    index["n"] = [n for _, n, _ in docs]
    index["flags"] = [d is None for d, _, _ in docs]
    index["end"] = np.cumsum([len(f) for _, _, f in docs])
    return b"".join([MAGIC, digest, len(docs).to_bytes(4, "little"), index.tobytes(), *(f for _, _, f in docs)])


def parse_index(content: bytes, dictionary: bytes) -> tuple[np.ndarray, int]:
    """The index of a segment and where its frames begin; the dictionary must be the segment's."""
    if content[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    if content[4:36] != hashlib.sha256(dictionary).digest():
        raise ValueError("the segment was written with another dictionary")
    n = int.from_bytes(content[36:HEAD], "little")
    return np.frombuffer(content, ENTRY, n, HEAD), HEAD + n * ENTRY.itemsize


def read_document(content: bytes, dictionary: bytes, position: int) -> np.ndarray:
    """The ids of one document of a segment."""
    index, base = parse_index(content, dictionary)
    begin = int(index["end"][position - 1]) if position else 0
    frame = content[base + begin : base + int(index["end"][position])]
    unpacked = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress(frame)
    return np.frombuffer(unpacked, "<u4")


def write_ids(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    level: int = 3,
) -> None:
    """Encode all texts and write the store at ``path``, in ascending order of the id."""
    spark = docs.sparkSession
    tokenizer = tokenizer or tokens.default_tokenizer()
    end = np.asarray([end_id], "<u4").tobytes()
    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    dictionary = train_dictionary(source, tokenizer, end)
    digest = hashlib.sha256(dictionary).digest()
    spark.createDataFrame([(digest, dictionary)], "hash binary, content binary").coalesce(1).write.parquet(f"{path}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(tokenizer)
        packer = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(shared.value))
        part, segment, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            row = [[part], [segment], [len(held)], [sum(n for _, n, _ in held)], [build_segment(digest, held)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, _ARROW.types, strict=True)], schema=_ARROW)

        for batch in batches:
            for rows in slices(batch, "text", 1 << 20):
                encoded = encoder.encode(rows.column("text").to_pylist())
                for doc, ids in zip(rows.column("doc_id").to_pylist(), encoded, strict=True):
                    frame = packer.compress(ids + end)
                    held.append((doc, len(ids) // 4 + 1, frame))
                    size += len(frame)
                    if size >= SEGMENT_BYTES:
                        yield out()
                        segment, held, size = segment + 1, [], 0
        if held:
            yield out()

    # the text's hash in the range key lets a repeated id spread over ranges
    spread = F.xxhash64("text")
    (
        source.repartitionByRange("doc_id", spread)
        .sortWithinPartitions("doc_id", spread, "text")
        .mapInArrow(run, _SEGMENTS)
        .write.option("compression", "none")
        .parquet(f"{path}/segments")
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the store: doc_id, start (ids of all before it), n_tokens, ids_crc32."""
    dictionary = bytes(spark.read.schema("hash binary, content binary").parquet(f"{path}/dictionary").first().content)
    shared = spark.sparkContext.broadcast(dictionary)
    segments = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))
        for batch in batches:
            for row in batch.to_pylist():
                content = memoryview(row["content"])
                index, base = parse_index(row["content"], shared.value)
                edges = [0, *index["end"].tolist()]
                frames = [inflate.decompress(bytes(content[base + a : base + b])) for a, b in zip(edges, edges[1:], strict=False)]
                counts = np.asarray([len(f) // 4 for f in frames], np.int64)
                n = len(frames)
                columns = [
                    pa.array(np.full(n, row["part"])),
                    pa.array(np.full(n, row["segment"])),
                    pa.array(np.arange(n)),
                    pa.array(index["id"].astype(np.int64), mask=index["flags"] == 1),
                    pa.array(counts),
                    pa.array(np.cumsum(counts) - counts),
                    pa.array(np.asarray([zlib.crc32(f) for f in frames], np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _DOCS.split(", ")])

    # two levels, so that no window holds more than the parts, or the segments of one part
    sizes = segments.select("part", "segment", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    parts = parts.select("part", (F.sum("tokens").over(W.orderBy("part")) - F.col("tokens")).alias("part_start"))
    in_part = F.sum("n_tokens").over(W.partitionBy("part").orderBy("segment")) - F.col("n_tokens")
    starts = sizes.select("part", "segment", in_part.alias("segment_start")).join(parts, "part")
    found = segments.select("part", "segment", "content").mapInArrow(run, _DOCS)
    start = F.col("part_start") + F.col("segment_start") + F.col("before")
    return found.join(starts, ["part", "segment"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")
