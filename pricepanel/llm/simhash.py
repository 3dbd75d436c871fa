"""SimHash near-duplicates: segment popcounts, a grid join under Manhattan distance, exact check.

A fingerprint of 64 bits is mapped to the bit counts of its 16 segments.  The
Manhattan distance of two such vectors is at most the Hamming distance of the
fingerprints, so fingerprints that differ in two bits or fewer have vectors
within two steps and meet in a grid cell one step or less from both: each
fingerprint is entered in its own cell and the 32 cells around it.

Cells with few fingerprints compare them in pairs.  In crowded cells (groups
of near copies) fingerprints meet instead at the 65 values within one bit of
them: all that meet at one value are within two bits of each other, so a link
to the least of them keeps every component, and no group is expanded into pairs.

Defined results: a null or empty text has fingerprint zero and is linked like
any other; rows with a null id have a fingerprint, but no component; repeated
rows get the same result; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.lineage import cut, ship
from pricepanel.llm.columns import VISIBLE, Words, text_slices
from pricepanel.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 16
#: Fingerprints of a cell that are compared in pairs; a cell with more uses the exact meeting values.
PAIRS_UP_TO = 24


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(XXH64 of every shingle, row of every shingle)."""
    lengths = words.end - words.start
    begin = np.concatenate([[0], np.cumsum(lengths + 1)]).astype(np.int64)
    joined = np.full(int(begin[-1]), 0x20, np.uint8)
    inside = np.arange(int(lengths.sum())) + np.repeat(np.arange(len(lengths)), lengths)
    joined[inside] = words.bytes[np.repeat(words.start - np.cumsum(lengths) + lengths, lengths) + np.arange(len(inside))]
    content = joined.tobytes()
    count = words.count
    number = np.where(count > 0, np.maximum(count - k + 1, 1), 0)
    row = np.repeat(np.arange(len(count)), number)
    first = words.first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
    last = first + np.minimum(count[row], k)
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(content[s:e], SEED) for s, e in zip(begin[first].tolist(), (begin[last] - 1).tolist())
    ]
    return np.array(hashes, np.uint64), row


def fingerprints(texts: pa.Array, k: int = SHINGLE) -> np.ndarray:
    """One unsigned 64-bit fingerprint per text."""
    words = Words(texts, VISIBLE, lower=True)
    hashes, row = shingle_hashes(words, k)
    out = np.zeros(len(texts), np.uint64)
    if len(hashes):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows, start = np.unique(row, return_index=True)
        ones = np.add.reduceat(bits, start, axis=0, dtype=np.int32)
        total = np.diff(np.append(start, len(row)))
        majority = (2 * ones > total[:, None]).astype(np.uint8)
        out[rows] = np.packbits(majority, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprint(docs: DataFrame, text: str = "text", id_col: str = "doc_id", k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed number."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            fp = fingerprints(part.column("text"), k).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    chosen = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(run, "doc_id long, fp long")


def _cells(nodes: DataFrame) -> DataFrame:
    """Every fingerprint in its own cell and those one step away; three bits of the key hold one count."""
    width = 64 // SEGMENTS
    mask = F.lit((1 << width) - 1).cast("long")
    key = F.lit(0).cast("long")
    for s in range(SEGMENTS):
        count = F.bit_count(F.shiftrightunsigned("fp", s * width).bitwiseAND(mask)).cast("long")
        key = key + (count + 1) * F.lit(1 << 3 * s).cast("long")
    steps = [0] + [sign << 3 * s for s in range(SEGMENTS) for sign in (1, -1)]
    return nodes.select("node", "fp", key.alias("key")).select(
        "node", "fp", F.explode(F.transform(F.array(*[F.lit(x).cast("long") for x in steps]), lambda x: F.col("key") + x)).alias("cell")
    )


def _crowded(nodes: DataFrame) -> DataFrame:
    """Links of fingerprints that meet at a value within one bit of both."""
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64) * (b == 63)).cast("long") for b in range(64)])
    meeting = nodes.select("node", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("value"))
    least = meeting.groupBy("value").agg(F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
    return meeting.join(least, "value").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) links between nodes (node, fp) with distinct fingerprints, enough for every component."""
    cells = _cells(nodes)
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut(cells.join(sizes, "cell"))
    member = F.struct("node", "fp")
    few = (
        shared.filter(F.col("n") <= PAIRS_UP_TO).groupBy("cell").agg(F.collect_list(member).alias("m"))
    )
    pairs = (
        few.select(F.posexplode("m").alias("i", "x"), "m")
        .select("x", F.explode(F.slice("m", F.col("i") + 2, F.size("m"))).alias("y"))
        .filter(F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= MAX_BITS)
        .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
        .distinct()
    )
    many = shared.filter(F.col("n") > PAIRS_UP_TO).select("node", "fp").distinct()
    return pairs.unionByName(_crowded(many))


def near_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, fp, component_id (least id that links lead to)."""
    found = cut(fingerprint(docs, text, id_col))
    nodes = cut(found.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")))
    joined = components(links(nodes), "a", "b")
    classes = nodes.join(joined, "node", "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "node").alias("_class")
    )
    return found.join(classes, found["fp"] == classes["_fp"], "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("_class")).alias("component_id")
    )


def representatives(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each component, that of its least id; rows without an id all stay."""
    names = docs.columns
    inner = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    body, key = F.col(f"_c{names.index(text)}"), F.col(f"_c{names.index(id_col)}").cast("long")
    found = near_duplicates(docs, text, id_col)
    kept = found.filter("component_id = doc_id").select(F.col("doc_id").alias("_kept")).distinct()
    # Rows of one id are one document: the one with the least hash of its text stands for them.
    first = F.row_number().over(Window.partitionBy("_id").orderBy(F.xxhash64(body)))
    rows = inner.select("*", key.alias("_id"))
    chosen = (
        rows.filter("_id IS NOT NULL")
        .join(kept, F.col("_id") == F.col("_kept"), "left_semi")
        .withColumn("_row", first)
        .filter("_row = 1")
        .drop("_row")
    )
    return chosen.unionByName(rows.filter("_id IS NULL")).drop("_id").toDF(*names)
