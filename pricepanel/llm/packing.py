"""Sum-of-squares packing of token sequences into windows of fixed size.

Every task packs the rows of its own partition, online: full windows are cut
off a long document first; what is left of it goes to the fill level that
minimises the sum of squared counts of partially filled windows, held in an
array over all levels.  Windows still open at the end of the partition are
poured together: full windows first, then pieces whose sizes are powers of
two, which need no padding.  No rows move between tasks.

Defined results: a null text is empty and its document consists of the end id
alone; rows are packed independently, so repeated rows and null ids each get
their own pieces; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pricepanel.lineage import ship
from pricepanel.llm import tokens
from pricepanel.llm.columns import text_slices

#: Tokens of a window.
WINDOW = 4096
#: Id that ends a document.
END_ID = 2
#: Sequence ids are task number * 2**SEQUENCE_BITS + number in the task.
SEQUENCE_BITS = 36

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in SCHEMA.split(", ")])


class Levels:
    """Open windows by fill level, and the choice of a level for an item."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self._open: dict[int, list[list]] = {}

    def choose(self, item: int) -> int:
        """Level (0: a new window) whose sum of squared counts after the step is least; ties go to the fullest."""
        count, size = self.count, self.size
        # Change of the sum of squares, less the constant part, for levels 0..size-item.
        change = 2 * (count[item:] - count[: size - item + 1]) + 2
        change[0] = 2 * count[item] + 1
        change[size - item] = 1 - 2 * count[size - item]
        if item == size:
            return 0
        usable = count[: size - item + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return int(size - item - np.argmin(change[::-1]))

    def take(self, level: int) -> list:
        if level == 0:
            return []
        window = self._open[level].pop()
        self.count[level] -= 1
        return window

    def put(self, level: int, window: list) -> None:
        self._open.setdefault(level, []).append(window)
        self.count[level] += 1

    def rest(self) -> Iterator[list]:
        for level in sorted(self._open, reverse=True):
            yield from self._open[level]


class Packer:
    """Turns documents into rows (doc_id, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, size: int = WINDOW, first_sequence: int = 0):
        self.size, self.sequence = size, first_sequence
        self.levels = Levels(size)

    def _close(self, window: list) -> Iterator[tuple]:
        """A window is a list of (doc_id, start, doc_tokens, ids)."""
        offset = 0
        for doc_id, start, total, ids in window:
            yield doc_id, start, len(ids), tokens.crc32(ids), total, self.sequence, offset
            offset += len(ids)
        self.sequence += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        total, start = len(ids), 0
        while total - start >= self.size:
            yield from self._close([(doc_id, start, total, ids[start : start + self.size])])
            start += self.size
        item = total - start
        if item == 0:
            return
        level = self.levels.choose(item)
        window = self.levels.take(level)
        # Kept ids are copied so that a long document's array can go.
        window.append((doc_id, start, total, ids[start:].astype(np.uint32)))
        if level + item == self.size:
            yield from self._close(window)
        else:
            self.levels.put(level + item, window)

    def finish(self) -> Iterator[tuple]:
        """Pour the open windows, fullest first, into full windows and then powers of two."""
        pieces = [piece for window in self.levels.rest() for piece in window]
        left = sum(len(p[3]) for p in pieces)
        sizes = [self.size] * (left // self.size)
        left %= self.size
        sizes += [1 << b for b in range(self.size.bit_length(), -1, -1) if left >> b & 1]
        at = used = 0
        for size in sizes:
            window, room = [], size
            while room:
                doc_id, start, total, ids = pieces[at]
                step = min(room, len(ids) - used)
                window.append((doc_id, start + used, total, ids[used : used + step]))
                room, used = room - step, used + step
                if used == len(ids):
                    at, used = at + 1, 0
            yield from self._close(window)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)


def pack(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece of a document; pieces of one ``sequence_id`` lie gapless from ``offset`` 0."""
    path = vocabulary or tokens.default_path()
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path)
        packer = Packer(window, TaskContext.get().partitionId() << SEQUENCE_BITS)
        rows: list[tuple] = []
        for part in text_slices(batches, owner=tokens.OWNER):
            ids = encode.ids_of(part.column("text"))
            for doc_id, one in zip(part.column("doc_id").to_pylist(), ids):
                rows.extend(packer.add(doc_id, np.append(one, np.uint32(end_id))))
            if len(rows) >= 5000:
                yield _table(rows)
                rows = []
        rows.extend(packer.finish())
        if rows:
            yield _table(rows)

    chosen = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(run, SCHEMA)
