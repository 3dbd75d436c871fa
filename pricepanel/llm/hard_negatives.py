"""Hard negatives for contrastive training, by a secondary-sort shuffle.

Scores are integer inner products of scaled, floored vectors.  Anchors (a
stated query set) meet all rows in tiles: rows are packed into chunks, anchors
into blocks, and a round joins every chunk with the blocks of that round, whose
size is bounded by ROUND_BLOCKS x BLOCK_ROWS vectors whatever the table's size.

1. The rows of an anchor's own label give each task's best positives, then the
   anchor's.  They fix the windows of scores that negatives must lie in.
2. Rows of other labels inside a window give each task's best negatives per
   window.  What a task leaves out is behind enough rows of the same window
   and cannot be among its first ones.
3. Positives and negatives are packed into keys (anchor, descending score with
   positives first, id), dealt out by anchor and sorted within partitions.  An
   iterator over the sorted rows opens a window at each positive and emits the
   negatives that fall into open windows; it keeps a few numbers, never an
   anchor's rows.

Defined results: rows with a null id, label or vector, or with any null or
non-finite component, take no part; of repeated ids the row of the least
(label, vector) stands for all; missing components of shorter vectors count as
zero, so an empty vector scores zero with every row; equal scores are ordered
by id; a positive score below zero has an empty window; an empty table, or one
without anchors, gives no rows; other columns are not looked at.  Scores that do
not fit into 62 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm.registry import saved

#: Rows of a chunk, and anchors of a block on average.
CHUNK_ROWS = 2048
BLOCK_ROWS = 512
#: Blocks sent to the tasks of one round.
ROUND_BLOCKS = 16
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these percentages of the positive's.
LOW_PERCENT = 30
HIGH_PERCENT = 90

_LEAST = np.iinfo(np.int64).min
_ROWS_DDL = "ids array<long>, labels array<long>, sizes array<int>, cells array<long>"
_KEYS = "anchor_id long, place long, other_id long"
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def usable(vectors: DataFrame, scale: int, id_col: str, vector: str, label: str) -> DataFrame:
    """(id, label, cells): one row per id, cells as floored integers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return (
        vectors.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
        .select(
            F.col(id_col).cast("long").alias("id"),
            F.struct(
                F.col(label).cast("long").alias("label"),
                F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("cells"),
            ).alias("row"),
        )
        .groupBy("id")
        .agg(F.min("row").alias("row"))
        .select("id", "row.label", "row.cells")
    )


def _chunks(rows: DataFrame) -> DataFrame:
    """Rows packed by CHUNK_ROWS, without an exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                cells = part.column("cells")
                one = [part.column("id"), part.column("label"), cells.value_lengths(), cells.flatten()]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays([0, len(v)], v.cast(k)) for v, k in zip(one, kinds)],
                    names=["ids", "labels", "sizes", "cells"],
                )

    return rows.mapInArrow(run, _ROWS_DDL)


def _blocks(anchors: DataFrame, n_blocks: int) -> DataFrame:
    """Anchors dealt out to blocks 0..n_blocks-1 by a hash of their id; columns of positives come along."""
    extra = [c for c in anchors.columns if c not in ("id", "label", "cells")]
    dealt = anchors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    rows = F.array_sort(F.collect_list(F.struct("id", "label", "cells", *extra)))
    packed = dealt.groupBy("block").agg(rows.alias("r"))
    return packed.select(
        "block",
        F.col("r.id").alias("a_ids"),
        F.col("r.label").alias("a_labels"),
        F.transform("r", lambda x: F.size(x["cells"])).alias("a_sizes"),
        F.flatten("r.cells").alias("a_cells"),
        *[F.col(f"r.{c}").alias(f"a_{c}") for c in extra],
    )


def _matrix(cells: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One row per vector, shorter ones filled with zeros."""
    width = int(sizes.max()) if len(sizes) else 0
    if len(cells) == width * len(sizes):
        return cells.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = cells
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    bound = max(int(a.max()), -int(a.min())) * max(int(b.max()), -int(b.min())) * width
    if bound < 1 << 53:  # floating point is exact up to here
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if bound < 1 << 61:
        return a @ b.T
    raise ValueError("scores of these vectors may not fit into 62 bits; use a smaller scale")


def _first(score: np.ndarray, fits: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k first fitting cells of every row, by descending score, then id."""
    masked = np.where(fits, score, _LEAST)
    if masked.shape[1] > k:
        bar = np.partition(masked, masked.shape[1] - k, axis=1)[:, -k, None]
        fits = fits & (masked >= bar)
    row, column = np.nonzero(fits)
    order = np.lexsort((ids[column], -score[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def _window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer n with low * positive <= 100 * n <= high * positive."""
    return -((-low * positive) // 100), (high * positive) // 100


class _Best:
    """The first k rows of every (anchor, window) of a block, over all chunks of a task."""

    def __init__(self, k: int):
        self.k = k
        self.slot = self.score = self.other = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, other: np.ndarray) -> None:
        slot, score, other = (np.concatenate(p) for p in zip((self.slot, self.score, self.other), (slot, score, other)))
        order = np.lexsort((other, -score, slot))
        slot, score, other = slot[order], score[order], other[order]
        keep = np.arange(len(slot)) - np.searchsorted(slot, slot) < self.k
        self.slot, self.score, self.other = slot[keep], score[keep], other[keep]


def _ints(column: pa.Array, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Tiles one by one, as integer arrays by column; a chunk's matrix is ``rows``, a block's ``anchors``."""
    for batch in batches:
        for i in range(batch.num_rows):
            tile = {c: _ints(batch.column(c), i) for c in batch.schema.names if c not in ("block", "a_positives")}
            tile["block"] = batch.column("block")[i].as_py()
            tile["rows"] = _matrix(tile["cells"], tile["sizes"])
            tile["anchors"] = _matrix(tile["a_cells"], tile["a_sizes"])
            if "a_positives" in batch.schema.names:
                lists = batch.column("a_positives")[i].values
                tile["n_positives"] = lists.value_lengths().to_numpy(zero_copy_only=False)
                tile["positives"] = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield tile


def _keys(anchor: np.ndarray, score: np.ndarray, other: np.ndarray, negative: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor), pa.array(-2 * score + int(negative)), pa.array(other)],
        names=["anchor_id", "place", "other_id"],
    )


def _positive_keys(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, _Best]] = {}
        for t in _tiles(batches):
            _, state = best.setdefault(t["block"], (t["a_ids"], _Best(k)))
            for label in np.intersect1d(t["a_labels"], t["labels"]):
                a, b = np.flatnonzero(t["a_labels"] == label), np.flatnonzero(t["labels"] == label)
                score = scores(t["anchors"][a], t["rows"][b])
                row, column = _first(score, t["a_ids"][a][:, None] != t["ids"][b], t["ids"][b], k)
                state.add(a[row], score[row, column], t["ids"][b][column])
        for ids, state in best.values():
            yield _keys(ids[state.slot], state.score, state.other, negative=False)

    return run


def _negative_keys(positives: int, k: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, _Best]] = {}
        for t in _tiles(batches):
            _, state = best.setdefault(t["block"], (t["a_ids"], _Best(k)))
            score = scores(t["anchors"], t["rows"])
            other_label = t["a_labels"][:, None] != t["labels"]
            starts = np.cumsum(t["n_positives"]) - t["n_positives"]
            for p in range(positives):
                a = np.flatnonzero(t["n_positives"] > p)
                least, most = _window(t["positives"][starts[a] + p], low, high)
                fits = other_label[a] & (score[a] >= least[:, None]) & (score[a] <= most[:, None])
                row, column = _first(score[a], fits, t["ids"], k)
                state.add(a[row] * positives + p, score[a][row, column], t["ids"][column])
        for ids, state in best.values():
            # A row that fits several windows of its anchor is sent once.
            one = np.unique(np.stack([state.slot // positives, state.score, state.other]), axis=1)
            yield _keys(ids[one[0]], one[1], one[2], negative=True)

    return run


def _rounds(chunks: DataFrame, blocks: DataFrame, n_blocks: int, run, label: str) -> DataFrame:
    """Keys of all tiles; every round sends ROUND_BLOCKS blocks to the tasks that read the chunks."""
    parts = []
    for first in range(0, n_blocks, ROUND_BLOCKS):
        last = min(first + ROUND_BLOCKS, n_blocks) - 1
        chosen = blocks.filter(F.col("block").between(first, last))
        every = F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long")))
        tiles = chunks.withColumn("block", every).join(F.broadcast(chosen), "block")
        parts.append(saved(tiles.mapInArrow(run, _KEYS), label))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def emit(batches: Iterator[pa.RecordBatch], negatives: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Rows of the result from keys sorted by (anchor, place, id); holds the open windows of one anchor."""
    anchor, windows = None, []
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        out: list[tuple] = []
        for anchor_id, place, other in zip(*(batch.column(c).to_pylist() for c in ("anchor_id", "place", "other_id"))):
            if anchor_id != anchor:
                anchor, windows = anchor_id, []
            score = -(place >> 1)
            if place & 1:
                for w in windows:
                    if w[2] <= score <= w[3]:
                        w[4] += 1
                        out.append((anchor, w[0], w[4], other, w[1], score))
                if windows:
                    windows = [w for w in windows if w[4] < negatives and w[2] <= score]
            else:
                least, most = _window(score, low, high)
                windows.append([other, score, least, most, 0])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def mine(
    vectors: DataFrame,
    anchors: Column,
    scale: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """RESULT rows: for every anchor (a condition on ``id``) and positive, the first ``negatives`` in its window."""
    spark = vectors.sparkSession
    ship(spark)
    rows = saved(usable(vectors, scale, id_col, vector, label), "vectors")
    chosen = rows.filter(anchors)
    n_blocks = -(-chosen.count() // BLOCK_ROWS)
    if n_blocks == 0:
        return spark.createDataFrame([], RESULT)
    chunks = saved(_chunks(rows), "chunks")
    blocks = saved(_blocks(chosen, n_blocks), "anchors")
    found = _rounds(chunks, blocks, n_blocks, _positive_keys(positives), "positives")
    first = Window.partitionBy("anchor_id").orderBy("place", "other_id")
    best = saved(
        found.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= positives).drop("n"), "positives"
    )
    windows = best.groupBy(F.col("anchor_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.shiftright("place", 1))).alias("p")
    )
    opened = chosen.join(windows, "id").select(
        "id", "label", "cells", F.transform("p", lambda x: -x).alias("positives")
    )
    blocks = saved(_blocks(opened, n_blocks), "anchors")
    run = _negative_keys(positives, negatives, low_percent, high_percent)
    keys = best.unionByName(_rounds(chunks, blocks, n_blocks, run, "negatives"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # repartitionAndSortWithinPartitions in DataFrame form: dealt out by anchor, sorted by the packed key.
    ordered = keys.repartition(parts, "anchor_id").sortWithinPartitions("anchor_id", "place", "other_id")
    return ordered.mapInArrow(lambda batches: emit(batches, negatives, low_percent, high_percent), RESULT)
