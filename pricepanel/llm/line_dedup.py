"""Near-duplicate lines: a join on deletion neighbourhoods, verified, earliest line kept.

A line (``\\n``-split, with a word) goes when an earlier line, by
(doc_id, line number), has the same words, or, both having MIN_WORDS words or
more, is one word insertion, deletion or replacement away.

Lines within one edit share a variant: the line itself or the line without
one word.  Before variants are emitted, lines that cannot have a partner are
set aside without loss: one edit leaves the first or the last m words alone,
so a line whose ends both occur in no other line has none.  Variants are
hashed keys; only the earliest line of each key and position is compared, and
its words are checked, so no group of lines is expanded into pairs.

Defined results: null texts are empty; lines without a word are never
removed; rows that share a doc_id count as one document and get the same
decisions; null ids count as the last of all; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricepanel.lineage import ship
from pricepanel.llm.registry import saved
from pricepanel.llm.columns import VISIBLE, Runs, Words, mix, text_slices

#: Lines of fewer words must be equal; one edit in so many words is a similarity of 0.8.
MIN_WORDS = 5
_NULL_ID = (1 << 63) - 1
_HEAD, _TAIL = np.uint64(0x51ED270B7F4A7C15), np.uint64(0xA0761D6478BD642F)


class Lines:
    """Lines with words of a slice of texts, as ranges ``start:end`` of its words."""

    def __init__(self, texts: pa.Array):
        self.words = words = Words(texts, VISIBLE)
        breaks = np.flatnonzero(words.bytes == 0x0A)
        number = np.searchsorted(breaks, words.start) - np.searchsorted(breaks, words.offsets[:-1])[words.row]
        row = words.row
        new = np.ones(len(number), bool)
        new[1:] = (np.diff(number) != 0) | (np.diff(row) != 0)
        self.start = np.flatnonzero(new)
        self.end = np.append(self.start[1:], len(number))
        self.row, self.number = row[self.start], number[self.start]
        self.runs = Runs(words.hashes())
        self.hash = self.runs.of(self.start, self.end).view(np.int64)

    def end_keys(self, shorter: int) -> np.ndarray:
        """Two keys per line, of the words at its head and tail that one edit of a line of size - shorter spares."""
        n = self.end - self.start - shorter
        m = np.where(n >= 8, n // 8 * 4, n // 2)
        head = mix(self.runs.of(self.start, self.start + m) ^ _HEAD)
        tail = mix(self.runs.of(self.end - m, self.end) ^ _TAIL)
        return np.stack([head, tail], axis=1).view(np.int64)


def _table(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    return docs.selectExpr(f"coalesce(cast(`{id_col}` as long), {_NULL_ID}L) AS doc_id", f"`{text}` AS text")


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, h, ends) of every line with a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            lines = Lines(part.column("text"))
            size = lines.end - lines.start
            both = np.concatenate([lines.end_keys(0), lines.end_keys(1)], axis=1)
            use = np.stack([size >= MIN_WORDS] * 2 + [size > MIN_WORDS] * 2, axis=1)
            # A line mostly has the same ends for both lengths.
            use[:, 2:] &= both[:, 2:] != both[:, :2]
            offsets = np.concatenate([[0], np.cumsum(use.sum(axis=1))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(lines.row)),
                    pa.array(lines.number.astype(np.int32)),
                    pa.array(lines.hash),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(both[use])),
                ],
                names=["doc_id", "line", "h", "ends"],
            )

    return docs.mapInArrow(run, "doc_id long, line int, h long, ends array<long>")


def _variants(rows: DataFrame, text: str) -> DataFrame:
    """From (text, doc_id, wanted: lines and hashes): keys of each wanted line and of it without each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            lines = Lines(part.column(text))
            wanted = [{(w["line"], w["h"]) for w in row} for row in part.column("wanted").to_pylist()]
            keep = np.array(
                [
                    (n, h) in wanted[r]
                    for r, n, h in zip(lines.row.tolist(), lines.number.tolist(), lines.hash.tolist())
                ],
                bool,
            )
            start, end = lines.start[keep], lines.end[keep]
            size = end - start
            owner = np.repeat(np.arange(len(start)), size)
            position = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
            without = lines.runs.without(start[owner], end[owner], start[owner] + position)
            owner = np.concatenate([np.arange(len(start)), owner])
            position = np.concatenate([np.full(len(start), -1), position])
            key = np.concatenate([lines.hash[keep], without.view(np.int64)])
            ids = part.column("doc_id").take(pa.array(lines.row[keep]))
            data, words = lines.words.bytes, lines.words
            whole = [data[words.start[s] : words.end[e - 1]].tobytes().decode() for s, e in zip(start, end)]
            texts = pa.array(whole + [None] * (len(owner) - len(whole)), pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array(position.astype(np.int32)),
                    ids.take(pa.array(owner)),
                    pa.array(lines.number[keep][owner].astype(np.int32)),
                    pa.array(lines.hash[keep][owner]),
                    texts,
                ],
                names=["key", "position", "doc_id", "line", "h", "line_text"],
            )

    return rows.mapInArrow(run, "key long, position int, doc_id long, line int, h long, line_text string")


def within_one_edit(a: list, b: list) -> bool:
    """Whether one insertion, deletion or replacement, or none, turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def _checked(pairs: DataFrame) -> DataFrame:
    """Pairs (h, text, other_text) whose words are within one edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("line_text").to_pylist(), batch.column("other_text").to_pylist()
            # Bytes of one kind of white space may differ; words are what VISIBLE bytes make.
            ok = [within_one_edit(_split(a), _split(b)) for a, b in zip(left, right)]
            yield pa.RecordBatch.from_arrays([batch.column("h").filter(pa.array(ok, pa.bool_()))], names=["h"])

    return pairs.select("h", "line_text", "other_text").mapInArrow(run, "h long")


def _split(line: str) -> list[str]:
    for c in "\t\x0b\x0c\r":
        line = line.replace(c, " ")
    return [w for w in line.split(" ") if w]


def _near(base: DataFrame, text: str, lines: DataFrame) -> DataFrame:
    """Hashes (h) of lines whose first occurrence has an earlier line one edit away."""
    ends = lines.select("h", "doc_id", "line", F.explode("ends").alias("end"))
    shared = ends.groupBy("end").agg(F.count("*").alias("n")).filter("n > 1").select("end")
    wanted = (
        ends.join(shared, "end", "left_semi")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("line", "h")).alias("wanted"))
    )
    every = _variants(base.join(wanted, F.col("_doc") == F.col("doc_id")), text)
    counted = every.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    variants = every.select("key", "position", "doc_id", "line", "h").join(counted, "key", "left_semi")
    order = F.struct("doc_id", "line", "h")
    # Of a key: the line itself, the earliest line that it is left of, and that by place of the word left out;
    # the places are those of one line's words.
    by_key = (
        variants.groupBy("key", "position")
        .agg(F.min(order).alias("best"))
        .groupBy("key")
        .agg(
            F.min(F.when(F.col("position") < 0, F.col("best"))).alias("itself"),
            F.min(F.when(F.col("position") >= 0, F.col("best"))).alias("longer"),
            F.collect_list(F.struct("position", "best")).alias("places"),
        )
    )
    place = F.filter("places", lambda p: p["position"] == F.col("position"))[0]["best"]
    rival = F.when(F.col("position") < 0, F.col("longer")).otherwise(F.least(place, F.col("itself")))
    before = F.struct("rival.doc_id", "rival.line") < F.struct("own.doc_id", "own.line")
    earlier = (
        variants.select("key", "position", order.alias("own"))
        .join(by_key, "key")
        .select("own", rival.alias("rival"))
        .filter(before)
        .groupBy(F.col("own.h").alias("h"))
        .agg(F.min("rival").alias("rival"))
        .select("h", F.col("rival.h").alias("other"))
    )
    texts = every.filter("position < 0").groupBy("h").agg(F.first("line_text").alias("line_text"))
    others = texts.select(F.col("h").alias("other"), F.col("line_text").alias("other_text"))
    return _checked(earlier.join(texts, "h").join(others, "other"))


def _keyed(docs: DataFrame, text: str, id_col: str) -> tuple[DataFrame, str]:
    """``docs`` as columns _c0, _c1 ... and _doc, dealt by _doc; the name that its text has there.

    Texts are needed twice by document: for the lines that may have partners,
    and for the lines that stay.  Both read this one exchange.
    """
    names = docs.columns
    inner = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    key = F.coalesce(F.col(f"_c{names.index(id_col)}").cast("long"), F.lit(_NULL_ID))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return inner.withColumn("_doc", key).repartition(parts, "_doc"), f"_c{names.index(text)}"


def _removed(docs: DataFrame, base: DataFrame, body: str, text: str, id_col: str) -> DataFrame:
    lines = saved(_lines(_table(docs, text, id_col)), "lines")
    first = saved(
        lines.groupBy("h").agg(
            F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n"), F.first("ends").alias("ends")
        ),
        "distinct-lines",
    )
    firsts = first.select("h", "first.doc_id", "first.line", "ends").filter(F.size("ends") > 0)
    near = _near(base, body, firsts).withColumn("near", F.lit(True))
    marked = first.drop("ends").join(near, "h", "left").filter("n > 1 OR near").select("h", "first", "near")
    gone = (
        lines.select("doc_id", "line", "h")
        .join(marked, "h")
        .filter(F.col("near") | (F.struct("doc_id", "line") > F.col("first")))
    )
    return gone.groupBy(F.col("doc_id").alias("_key")).agg(F.collect_set("line").alias("_gone"))


def removed_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, removed): numbers, from 0, of the lines that go; documents that keep all lines are not listed."""
    ship(docs.sparkSession)
    found = _removed(docs, *_keyed(docs, text, id_col), text, id_col)
    return found.select(F.col("_key").alias("doc_id"), F.col("_gone").alias("removed"))


def deduplicate(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", counts: bool = True, keep_emptied: bool = True
) -> DataFrame:
    """``docs`` with ``text`` less the removed lines.

    With ``counts``, n_lines and n_removed (lines with a word) are added, in
    place of columns of those names; without ``keep_emptied``, documents that
    lost every line with a word are left out.
    """
    ship(docs.sparkSession)
    names = docs.columns
    base, body = _keyed(docs, text, id_col)
    fields = base.drop("_doc").schema.fields
    columns_in = [f.name for f in fields]
    removed = _removed(docs, base, body, text, id_col)
    joined = base.join(removed, F.col("_doc") == F.col("_key"), "left").drop("_key", "_doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, body):
            texts, total, lost = [], [], []
            for one, gone in zip(part.column(body).to_pylist(), part.column("_gone").to_pylist()):
                lines, out = (one or "").split("\n"), set(gone or ())
                worded = [i for i, s in enumerate(lines) if _split(s)]
                total.append(len(worded))
                lost.append(sum(1 for i in worded if i in out))
                if out and one is not None:
                    one = "\n".join(s for i, s in enumerate(lines) if i not in out)
                texts.append(one)
            columns = [part.column(c) for c in columns_in]
            columns[names.index(text)] = pa.array(texts, part.column(body).type)
            made = pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(lost, pa.int64())],
                names=[*columns_in, "_n_lines", "_n_removed"],
            )
            if not keep_emptied:
                made = made.filter(pa.array([n == 0 or n > k for n, k in zip(total, lost)], pa.bool_()))
            yield made

    schema = T.StructType([*fields, T.StructField("_n_lines", T.LongType()), T.StructField("_n_removed", T.LongType())])
    out = joined.mapInArrow(run, schema)
    kept = [(f"_c{i}", n) for i, n in enumerate(names) if not counts or n not in ("n_lines", "n_removed")]
    kept += [("_n_lines", "n_lines"), ("_n_removed", "n_removed")] if counts else []
    return out.select(*[F.col(a).alias(b) for a, b in kept])
