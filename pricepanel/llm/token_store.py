"""Token ids on disk: one zstandard frame per document, with a shared dictionary.

A store is a folder with two Parquet tables:

``dictionary``  one row: dict_hash (SHA-256 of the dictionary), dictionary, width (bytes of an id)
``segments``    rows of up to SEGMENT_BYTES: shard, segment, dict_hash, least_id and greatest_id (null without
                an id), doc_ids, n_tokens, offsets (of each document's frame in payload), payload,
                shard_start (ids before it in its shard)

Shards are ranges of doc_id in ascending order.  A short document is read by
decompressing its own frame only.  Segments are written by Spark's own
writer, so a task that runs twice leaves one copy, and any store that Spark
can reach will do.

Defined results: a null text is empty and gives the end id alone; rows with
one doc_id stay separate, ordered by their texts' hash; null ids come first;
an empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm import tokens
from pricepanel.llm.columns import text_slices

END_ID = 1
#: Compressed bytes after which a segment ends.
SEGMENT_BYTES = 4 << 20
#: The dictionary, and the bounded sample that it is trained on; it changes sizes, never contents.
DICTIONARY_BYTES = 32 << 10
SAMPLE_ROWS = 400
SAMPLE_CHARS = 32_000
LEVEL = 3

_SEGMENTS = pa.schema(
    [
        ("shard", pa.int64()),
        ("segment", pa.int64()),
        ("dict_hash", pa.string()),
        ("least_id", pa.int64()),
        ("greatest_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
        ("shard_start", pa.int64()),
    ]
)
_SEGMENTS_DDL = (
    "shard long, segment long, dict_hash string, least_id long, greatest_id long, doc_ids array<long>, "
    "n_tokens array<long>, offsets array<long>, payload binary, shard_start long"
)


def _chosen(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text")


def _dictionary(dictionary: bytes):
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def train(docs: DataFrame, path: str, width: int) -> bytes:
    """A dictionary from the id arrays of the SAMPLE_ROWS documents whose ids hash lowest (bounded length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples = []
        for batch in batches:
            for ids in tokens.encoder(path).ids_of(batch.column("text")):
                samples.append(ids.astype(f"<u{width}").tobytes())
        samples = [s for s in samples if s]
        if samples:
            try:
                made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
            except zstandard.ZstdError:  # too few samples: their own bytes serve as the dictionary
                made = b"".join(samples)[:DICTIONARY_BYTES]
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["dictionary"])

    # Only rows whose hash is low enough to be among the lowest take part, however many tasks there are.
    share = min(1.0, 4 * SAMPLE_ROWS / max(docs.count(), 1))
    bound = int((share - 0.5) * 2**64) - 1
    sample = (
        docs.filter((F.xxhash64("doc_id") <= bound) & (F.length("text") <= SAMPLE_CHARS))
        .orderBy(F.xxhash64("doc_id"), F.xxhash64("text"))
        .limit(SAMPLE_ROWS)
    )
    found = sample.coalesce(1).mapInArrow(run, "dictionary binary").collect()
    return bytes(found[0]["dictionary"]) if found else b""


def write(
    docs: DataFrame,
    folder: str,
    text: str = "text",
    id_col: str = "doc_id",
    end_id: int = END_ID,
    vocabulary: str | None = None,
) -> None:
    """Encode every whole text and write the store to ``folder``."""
    spark = docs.sparkSession
    ship(spark)
    path = vocabulary or tokens.default_path()
    chosen = _chosen(docs, text, id_col)
    width = 2 if max(tokens.encoder(path).size, end_id + 1) <= 1 << 16 else 4
    dictionary = train(chosen, path, width)
    dict_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame(
        [(dict_hash, bytearray(dictionary), width)], "dict_hash string, dictionary binary, width int"
    ).coalesce(1).write.parquet(f"{folder}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        shard = TaskContext.get().partitionId()
        segment = start = 0
        doc_ids, counts, frames = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal segment, start, doc_ids, counts, frames
            offsets = np.cumsum([0, *map(len, frames)])[:-1].tolist()
            known = [i for i in doc_ids if i is not None]
            span = [min(known, default=None), max(known, default=None)]
            row = [shard, segment, dict_hash, *span, doc_ids, counts, offsets, b"".join(frames), start]
            made = pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, _SEGMENTS)], schema=_SEGMENTS
            )
            segment, start = segment + 1, start + sum(counts)
            doc_ids, counts, frames = [], [], []
            return made

        size = 0
        for part in text_slices(batches, owner=tokens.OWNER):
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encode.ids_of(part.column("text"))):
                whole = np.append(ids, np.uint32(end_id))
                frame = pack.compress(whole.astype(f"<u{width}").tobytes())
                doc_ids.append(doc_id)
                counts.append(len(whole))
                frames.append(frame)
                size += len(frame)
                if size >= SEGMENT_BYTES:
                    yield flush()
                    size = 0
        if frames:
            yield flush()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = chosen.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(run, _SEGMENTS_DDL).write.parquet(f"{folder}/segments")


def read(spark: SparkSession, folder: str, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) from a store; with ``doc_ids`` only those frames are opened."""
    ship(spark)
    row = spark.read.parquet(f"{folder}/dictionary").first()
    dictionary, dict_hash, width = bytes(row["dictionary"]), row["dict_hash"], row["width"]
    if hashlib.sha256(dictionary).hexdigest() != dict_hash:
        raise ValueError(f"the dictionary in {folder} does not have its hash")
    segments = spark.read.parquet(f"{folder}/segments")
    # One row per shard: sums over a table as long as the number of write tasks.
    totals = segments.groupBy("shard").agg(
        F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")
    )
    before = F.sum("n").over(Window.orderBy("shard")) - F.col("n")
    bases = totals.select("shard", before.alias("base"))
    wanted = None if doc_ids is None else set(doc_ids)
    if wanted is not None:
        # The span of ids is compared in the scan, so other segments' payloads are not read.
        if wanted:
            segments = segments.filter((F.col("least_id") <= max(wanted)) & (F.col("greatest_id") >= min(wanted)))
        segments = segments.filter(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in wanted])))
    ddl = "shard long, doc_id long, local long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for row in batch.to_pylist():
                if row["dict_hash"] != dict_hash:
                    raise ValueError(f"a segment of shard {row['shard']} was written with another dictionary")
                payload, at = memoryview(row["payload"]), row["shard_start"]
                ends = [*row["offsets"][1:], len(payload)]
                out: list[list] = [[] for _ in range(6)]
                for doc_id, n, lo, hi in zip(row["doc_ids"], row["n_tokens"], row["offsets"], ends):
                    if wanted is None or doc_id in wanted:
                        ids = np.frombuffer(unpack.decompress(payload[lo:hi]), f"<u{width}")
                        if len(ids) != n:
                            raise ValueError(f"document {doc_id} has {len(ids)} ids instead of {n}")
                        values = [row["shard"], doc_id, at, n, tokens.crc32(ids), ids.astype(np.int32)]
                        for column, value in zip(out, values):
                            column.append(value)
                    at += n
                arrays = [pa.array(c, pa.int64()) for c in out[:5]]
                names = ["shard", "doc_id", "local", "n_tokens", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(out[5], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    columns = ["doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"]
    return (
        segments.mapInArrow(run, ddl).join(bases, "shard").select(*columns, *["ids"] * with_ids)
    )
