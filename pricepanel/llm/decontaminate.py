"""Benchmark passages in documents: Wu-Manber search over words.

Symbols are words, patterns are the runs of ten consecutive words of the
items.  A table over hashed blocks of two words tells how far the search may
jump; only where it says zero, the bucket of the window's last block gives
the patterns to test, and their words are compared one by one.  All rows of a
slice advance together, each by its own jump.

The patterns of a block of items (at most BLOCK_BYTES of text) go to the
tasks; more items than that are searched block by block and the results are
united, so the size of the benchmark has no bound.  One block needs no shuffle.

Defined results: null texts have no words and are clean; null item ids count
as the empty string; repeated rows get a row each; without items every
document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm.columns import ALNUM, Runs, Words, mix, text_slices

#: Words of a window.
WINDOW = 10
#: Text of the items that are searched for in one pass.
BLOCK_BYTES = 2 << 20
#: A document is walked in stretches of so many words side by side.
STRETCH = 2048


class WuManber:
    """Patterns of ``m`` words each: ``hashes`` of all their words as one array, and where each pattern starts."""

    def __init__(self, m: int, words: np.ndarray, starts: np.ndarray, keys: np.ndarray):
        self.m, self.block = m, min(2, m)
        self.bits = max(10, min(22, int(8 * len(starts) + 1).bit_length()))
        self._shift = np.full(1 << self.bits, m - self.block + 1, np.int64)
        for last in range(self.block - 1, m):
            np.minimum.at(self._shift, self._slot(words, starts + last), m - 1 - last)
        # Patterns by the slot of their last block.
        slot = self._slot(words, starts + m - 1)
        order = np.lexsort((keys, slot))
        self._keys, self._pattern = keys[order], order
        self._bucket = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1))

    def _slot(self, words: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Table index of the block that ends at word ``last``."""
        h = words[last]
        if self.block == 2:
            h = mix(words[last - 1] * np.uint64(3) + h)
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, words: np.ndarray, first: np.ndarray, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        """(last word, pattern) of the windows to compare; rows are ``first[r]:first[r+1]``."""
        begin, end = first[:-1] + self.m - 1, first[1:]
        pieces = np.maximum(-(-(end - begin) // STRETCH), 0)
        owner = np.repeat(np.arange(len(begin)), pieces)
        part = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = begin[owner] + part * STRETCH
        stop = np.minimum(at + STRETCH, end[owner])
        found = []
        while len(at):
            slot = self._slot(words, at)
            jump = self._shift[slot]
            here = jump == 0
            if here.any():
                found.append((at[here], slot[here]))
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        last, slot = (np.concatenate(x) for x in zip(*found))
        keys = runs.of(last - self.m + 1, last + 1)
        at_out, pattern_out = [], []
        order = np.argsort(slot, kind="stable")
        cuts = np.flatnonzero(np.diff(slot[order])) + 1
        for group in np.split(order, cuts):
            lo, hi = self._bucket[slot[group[0]]], self._bucket[slot[group[0]] + 1]
            bucket = self._keys[lo:hi]
            # A bucket holds each key once: patterns are distinct.
            place = np.searchsorted(bucket, keys[group])
            ok = place < len(bucket)
            ok[ok] = bucket[place[ok]] == keys[group[ok]]
            at_out.append(last[group[ok]])
            pattern_out.append(self._pattern[lo + place[ok]])
        return np.concatenate(at_out), np.concatenate(pattern_out)


class Patterns:
    """All windows of a block of items, by length."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        words = Words(pa.array([t for _, t in items], pa.string()), ALNUM, lower=True)
        hashes = words.hashes()
        runs = Runs(hashes)
        self.groups = []
        by_length: dict[int, list[tuple[int, int]]] = {}
        for row, n in enumerate(words.count.tolist()):
            m, first = min(n, window), int(words.first[row])
            if n:
                by_length.setdefault(m, []).extend((first + i, row) for i in range(n - m + 1))
        for m, places in by_length.items():
            starts = np.array([s for s, _ in places])
            keys, index, inverse = np.unique(runs.of(starts, starts + m), return_index=True, return_inverse=True)
            owners: list[set[str]] = [set() for _ in keys]
            for i, (_, row) in zip(inverse.tolist(), places):
                owners[i].add(items[row][0])
            chosen = starts[index]
            texts = [[words.word(s + k) for k in range(m)] for s in chosen.tolist()]
            self.groups.append((WuManber(m, hashes, chosen, keys), texts, owners))

    def hits(self, words: Words) -> list[tuple[int, int, set[str]]]:
        """(first word, end word, item ids) of every occurrence."""
        hashes = words.hashes()
        runs = Runs(hashes)
        out = []
        for search, texts, owners in self.groups:
            for last, pattern in zip(*(x.tolist() for x in search.search(hashes, words.first, runs))):
                start = last - search.m + 1
                if all(words.word(start + k) == w for k, w in enumerate(texts[pattern])):
                    out.append((start, last + 1, owners[pattern]))
        return out


_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_key", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)
_ROW_DDL = (
    "doc_id long, text_key long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"
)


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [{"start": s, "end": e} for s, e in out]


def _scan(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    made: dict[str, Patterns] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = made.setdefault("", Patterns(items, window))
        for part in text_slices(batches):
            words = Words(part.column("text"), ALNUM, lower=True)
            n = part.num_rows
            spans: list[list] = [[] for _ in range(n)]
            names: list[set] = [set() for _ in range(n)]
            found = patterns.hits(words)
            rows = np.searchsorted(words.first, [s for s, _, _ in found], "right") - 1
            for row, (start, end, owners) in zip(rows.tolist(), found):
                offset = int(words.first[row])
                spans[row].append((start - offset, end - offset))
                names[row] |= owners
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array(words.count, pa.int64()),
                    pa.array([_merged(s) for s in spans], _ROW.field("spans").type),
                    pa.array([sorted(s) for s in names], _ROW.field("items").type),
                ],
                schema=_ROW,
            )

    return docs.mapInArrow(run, _ROW_DDL)


def _covered(spans: Column) -> Column:
    """Words under spans that may overlap."""
    return F.aggregate(
        F.sort_array(spans),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["upto"], s["start"]))).alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
        lambda acc: acc["n"],
    )


def _blocks(items: DataFrame, item_text: str, item_id: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """(id, text) of the items, in blocks that hold about ``block_bytes`` of text; one empty block if there are none."""
    wanted = items.selectExpr(
        f"coalesce(cast(`{item_id}` as string), '') AS item_id", f"coalesce(`{item_text}`, '') AS text"
    )
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    for b in range(n_blocks):
        rows = (wanted.filter(block == b) if n_blocks > 1 else wanted).collect()
        yield [(r["item_id"], r["text"]) for r in rows]


def find(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: n_words, n_hit, hit ``spans`` (word ranges), ``items`` (sorted ids)."""
    blocks = list(_blocks(items, item_text, item_id, block_bytes))
    return _found(docs, blocks, text, id_col, window).drop("text_key")


def _found(docs: DataFrame, blocks: list[list[tuple[str, str]]], text: str, id_col: str, window: int) -> DataFrame:
    ship(docs.sparkSession)
    chosen = docs.selectExpr(
        f"cast(`{id_col}` as long) AS doc_id", f"xxhash64(`{text}`) AS text_key", f"`{text}` AS text"
    )
    scans = [_scan(chosen, block, window) for block in blocks]
    found, n_blocks = scans[0], len(scans)
    if n_blocks > 1:
        for more in scans[1:]:
            found = found.unionByName(more)
        found = (
            found.groupBy("doc_id", "text_key", "n_words")
            .agg(
                F.flatten(F.collect_list("spans")).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                (F.count("*") / n_blocks).cast("int").alias("copies"),
            )
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        )
    return found.select("doc_id", "text_key", "n_words", _covered(F.col("spans")).alias("n_hit"), "spans", "items")


def clean(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, without a passage of an item."""
    ship(docs.sparkSession)
    blocks = list(_blocks(items, item_text, item_id, block_bytes))
    first = blocks[0]
    if len(blocks) > 1:
        # One pass each, and the rows that any of them names go.
        found = _found(docs, blocks, text, id_col, window).filter("n_hit > 0")
        gone = found.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text")).distinct()
        names = docs.columns
        inner = docs.toDF(*[f"_c{i}" for i in range(len(names))])
        key, body = F.col(f"_c{names.index(id_col)}").cast("long"), F.col(f"_c{names.index(text)}")
        same = key.eqNullSafe(F.col("_doc")) & (F.xxhash64(body) == F.col("_text"))
        return inner.join(gone, same, "left_anti").toDF(*names)
    made: dict[str, Patterns] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = made.setdefault("", Patterns(first, window))
        for part in text_slices(batches, text):
            words = Words(part.column(text), ALNUM, lower=True)
            keep = np.ones(part.num_rows, bool)
            keep[np.searchsorted(words.first, [s for s, _, _ in patterns.hits(words)], "right") - 1] = False
            yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
