"""Alignment of two tokenizers' tokens over the same bytes, and how usual each pairing is.

Both tokenizers encode a space and the text.  Tokens are runs of bytes, so
each side is an array of end offsets; offsets where both sides end cut the
tokens into groups, and two tokens are linked where their bytes overlap.

*Diagonal run skipping* (``groups``) walks both arrays at the current index
shift.  Doubling probes compare whole stretches of the arrays at that shift, so
one-to-one stretches are jumped up to their first difference; the irregular
group there is closed by stepping the side that is behind until both end
together, and the shift follows.  Long arrays are cut where words end, which
both sides do, and their parts walked side by side, one numpy call for all.

Pairs are counted in Spark.  A slice of documents is written with its list of
distinct pairs and, packed, which of them each document holds how often; the
lists of all slices are summed by pair, the highest count of each A id is taken,
and the figures go back to the slices that asked for them.  Nothing is broadcast
and no key holds documents: a pair in every document costs one row per slice.

Encoding keeps a bounded cache of words.  A text is cut before a blank between
two visible characters, where neither tokenizer joins anything (the A
tokenizer splits there, no B piece goes on from a visible character into a
blank; ``Pair`` checks the latter).  New words are encoded together, as one text.  A text with a piece whose bytes do not
come back is encoded whole, which decides.

Defined results: a text that is null or empty, or whose tokens of either side
do not give back its bytes, has no tokens, zeros and the digest ''; rows are
independent, so repeated rows and ids each have their own result and each
counts; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm.columns import text_slices
from pricepanel.llm.registry import saved

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Bytes of text in a slice; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
#: Bytes of text whose token arrays are in memory at once.
WORK_BYTES = 1 << 19
#: Tokens of a part of an array that is walked beside others.
LANE = 128
#: Pieces, and their characters, after which a worker's cache starts anew.
CACHE_PIECES = 120_000
CACHE_CHARS = 16 << 20
CALL_PIECES = 1024
#: A blank beside white space or at an end of the text.
_BESIDE_SPACE = re.compile(r"^ |\s | \s| \Z")
#: Fixed value: how the A vocabulary's tokenizer splits words.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Classes of characters below this one are the same in every version of Unicode.
_AGREED = "\u0300"
#: A pair is one number: A id << PAIR_BITS | B id.
PAIR_BITS = 32

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_SLICE_DDL = (
    "slice long, doc_ids array<long>, "
    + ", ".join(f"{c} array<long>" for c in COUNTS)
    + ", digests array<string>, pairs array<long>, holders array<long>, held array<int>, links binary"
)
RESULT = (
    "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", n_best long, count_sum long, groups_sha256 string"
)


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY_A), public_tokenizers.path(VOCABULARY_B)


# -- alignment of end arrays ----------------------------------------------------------------------------------


def groups(
    a_ends: np.ndarray, b_ends: np.ndarray, cuts: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Index behind the last token of every group, on both sides, by diagonal run skipping.

    ``cuts`` are places (numbers of tokens on either side) where both sides are known to end together; the
    stretches between them are walked side by side.
    """
    n, m = len(a_ends), len(b_ends)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none, none
    cut_a, cut_b = cuts if cuts is not None else (none, none)
    i, j = np.concatenate([[0], cut_a]), np.concatenate([[0], cut_b])
    end_a, end_b = np.append(i[1:], n), np.append(j[1:], m)
    runs = []  # (a index, b index, length) of stretches whose tokens end together
    while len(i):
        x, y = a_ends[i], b_ends[j]
        apart = np.flatnonzero(x != y)
        # An irregular group: the side that is behind takes its next token until both end together.
        while len(apart):
            behind = x[apart] < y[apart]
            i[apart] += behind
            j[apart] += ~behind
            x[apart], y[apart] = a_ends[i[apart]], b_ends[j[apart]]
            apart = apart[x[apart] != y[apart]]
        # Doubling probes at the shift j - i; a probe that differs somewhere ends its stretch there.
        most = np.minimum(end_a - i, end_b - j)
        length, step = np.ones(len(i), np.int64), 1
        probed = np.flatnonzero(length < most)
        while len(probed):
            ahead = length[probed, None] + np.arange(step)
            inside = ahead < most[probed, None]
            ahead = np.where(inside, ahead, 0)
            same = inside & (a_ends[i[probed, None] + ahead] == b_ends[j[probed, None] + ahead])
            whole = same.all(axis=1)
            length[probed] += np.where(whole, step, same.argmin(axis=1))
            probed = probed[whole]
            probed = probed[length[probed] < most[probed]]
            step *= 2
        runs.append(np.stack([i, j, length]))
        i, j = i + length, j + length
        left = (i < end_a) & (j < end_b)
        i, j, end_a, end_b = i[left], j[left], end_a[left], end_b[left]
    first_a, first_b, length = np.concatenate(runs, axis=1)
    order = np.argsort(first_a, kind="stable")
    first_a, first_b, length = first_a[order], first_b[order], length[order]
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return np.repeat(first_a, length) + within + 1, np.repeat(first_b, length) + within + 1


def links(a_ends: np.ndarray, b_ends: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a index, b index) of all pairs of tokens whose bytes overlap, in order of bytes."""
    inner = np.ones(len(b_ends), bool)
    inner[b_cuts - 1] = False
    every = np.sort(np.concatenate([a_ends, b_ends[inner]]), kind="stable")
    return np.searchsorted(a_ends, every), np.searchsorted(b_ends, every)


_DIGITS = 10 ** np.arange(9, -1, -1, dtype=np.int64)


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0..n-1 as bytes with a free last column, and which of them are shown."""
    scale = _DIGITS[-len(str(n)) :]
    ids = np.arange(n)[:, None]
    cells = np.zeros((n, len(scale) + 1), np.uint8)
    cells[:, :-1] = ids // scale % 10 + ord("0")
    shown = np.ones(cells.shape, bool)
    shown[:, : len(scale) - 1] = ids >= scale[:-1]
    return cells, shown


def group_text(a_ids, b_ids, a_cuts, b_cuts, decimals) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;`` and, per group, the byte behind its ';'."""
    n, m = len(a_ids), len(b_ids)
    # A token stands behind the B tokens of earlier groups, a B token behind the A tokens of its own, too.
    a_size, b_size = np.diff(a_cuts, prepend=0), np.diff(b_cuts, prepend=0)
    a_at = np.arange(n) + np.repeat(b_cuts - b_size, a_size)
    b_at = np.arange(m) + np.repeat(a_cuts, b_size)
    ids, mark = np.empty(n + m, np.int64), np.full(n + m, ord(","), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    mark[a_at[a_cuts - 1]] = ord("|")
    last = b_at[b_cuts - 1]
    mark[last] = ord(";")
    cells, shown = decimals[0][ids], decimals[1][ids]
    cells[:, -1] = mark
    return cells[shown], np.cumsum(np.count_nonzero(shown, axis=1))[last]


# -- encoding -------------------------------------------------------------------------------------------------


def _byte_level() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: visible bytes stand for themselves, the others follow U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, with the bytes of every id, and a cache of words."""

    def __init__(self, path_a: str, path_b: str):
        import tiktoken
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True  # their strings in a text are plain text
        self._b = SentencePieceProcessor(model_file=path_b)
        level = _byte_level()
        vocabulary = self._a.get_vocab()
        self._a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in level for c in token):
                self._a_bytes[i] = bytes(level[c] for c in token)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        ranks = {token: i for i, token in enumerate(self._a_bytes) if token}
        self._a_fast = tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})
        self._b_bytes = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        #: No piece goes on from a visible character into a blank, so words can be encoded apart.
        self._apart = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_sizes = np.array([len(t) for t in self._a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self._b_bytes], np.int64)
        self.decimals = _decimals(max(len(self.a_sizes), len(self.b_sizes)))
        self._forget()

    def _encode(self, pieces: list[str], together: bool) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of both sides on end with their number per piece, and which pieces' bytes come back on both sides."""
        raw = [b" " + p.encode() for p in pieces]
        ends = np.cumsum(list(map(len, raw)))
        whole, same, out = b"".join(raw), np.ones(len(raw), bool), []
        # Together, pieces are words of one text, cut where both tokenizers cut.
        text = " ".join(pieces) if together else ""
        for one, many, token, size in (
            (self._a_one, self._a_many, self._a_bytes, self.a_sizes),
            (self._b_one, self._b_many, self._b_bytes, self.b_sizes),
        ):
            flat, good = one(text) if together else [], False
            if flat:
                behind = np.cumsum(size[flat])
                stops = np.searchsorted(behind, ends) + 1
                good = stops[-1] == len(flat) and (behind[stops - 1] == ends).all()
            if not good or b"".join([token[i] for i in flat]) != whole:
                ids = many(pieces)
                flat = list(chain.from_iterable(ids))
                stops = np.cumsum(list(map(len, ids)))
                same &= [b"".join([token[i] for i in x]) == r for x, r in zip(ids, raw)]
            out += [np.array(flat, np.int32), np.diff(stops, prepend=0)]
        return out, same

    def _a_many(self, pieces: list[str]) -> list[list[int]]:
        found = self._a.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)
        return [e.ids for e in found]

    def _a_one(self, text: str) -> list[int]:
        # Where all engines agree on the classes of characters, the faster library gives the same ids.
        if text.isascii() or max(text) < _AGREED:
            return self._a_fast.encode_ordinary(" " + text)
        return self._a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids

    def _b_many(self, pieces: list[str]) -> list[list[int]]:
        return self._b.encode(pieces, num_threads=1)

    def _b_one(self, text: str) -> list[int]:
        return self._b.encode(text)

    def _pieces(self, text: str) -> list[str]:
        parts = text.split(" ")
        if not self._apart or len(parts) == 1:
            return [text]
        if not _BESIDE_SPACE.search(text):
            return parts
        out = parts[:1]
        for part in parts[1:]:
            before = out[-1]
            # A blank beside white space (or nothing) stays inside its piece.
            if part and before and not part[0].isspace() and not before[-1].isspace():
                out.append(part)
            else:
                out[-1] = f"{before} {part}"
        return out

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._chars = 0
        none = np.zeros(0, np.int64)
        self._known = [none.astype(np.int32), none, none.astype(np.int32), none, none.astype(bool)]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Bring ``pieces`` into the cache."""
        plain, other, index = [], [], self._index
        for piece in pieces:
            if piece not in index:
                # A blank beside a piece's white space would join it.
                (other if not piece or piece[0].isspace() or piece[-1].isspace() else plain).append(piece)
        plain.sort(key=lambda p: not p.isascii() and max(p) >= _AGREED)
        parts = [[known] for known in self._known]
        for group in (plain, other):
            for at in range(0, len(group), CALL_PIECES):
                part = group[at : at + CALL_PIECES]
                sides, same = self._encode(part, together=group is plain)
                index.update(zip(part, range(len(index), len(index) + len(part))))
                self._chars += sum(map(len, part))
                for column, value in zip(parts, (*sides, same)):
                    column.append(value)
        if plain or other:
            self._known = [np.concatenate(column) for column in parts]

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """A ids and B ids of all texts on end; pieces of each text; A ids and B ids of each piece.

        A text without tokens has no pieces.
        """
        if len(self._index) > CACHE_PIECES or self._chars > CACHE_CHARS:
            self._forget()
        split = [self._pieces(t) if t else [] for t in texts]
        self._learn(set(chain.from_iterable(split)))
        size = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter(map(self._index.__getitem__, chain.from_iterable(split)), np.int64, size.sum())
        good = self._known[4][at]
        if not good.all():
            # The whole text decides; without tokens it has no pieces.
            row = np.repeat(np.arange(len(texts)), size)
            odd = np.unique(row[~good])
            self._learn({texts[i] for i in odd})
            by_row = np.split(at, np.cumsum(size)[:-1])
            for i in odd:
                whole = self._index[texts[i]]
                by_row[i] = np.full(int(self._known[4][whole]), whole)
                size[i] = len(by_row[i])
            at = np.concatenate(by_row)
        flat, each = [], []
        for ids, count in (self._known[:2], self._known[2:4]):
            length, start = count[at], (np.cumsum(count) - count)[at]
            behind = np.cumsum(length)
            flat.append(ids[np.arange(length.sum()) + np.repeat(start - (behind - length), length)].astype(np.int64))
            each.append(length)
        return flat[0], flat[1], size, each[0], each[1]


_PAIRS: dict[tuple[str, str], Pair] = {}


def tokenizers(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per Python worker."""
    if (path_a, path_b) not in _PAIRS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker must not start a thread per core
        _PAIRS[path_a, path_b] = Pair(path_a, path_b)
    return _PAIRS[path_a, path_b]


class Aligned:
    """Tokens, groups and links of some texts, side by side in flat arrays."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        a, b, pieces, a_each, b_each = pair.ids(texts)
        stops = np.concatenate([[0], np.cumsum(pieces)])
        a_behind, b_behind = (np.concatenate([[0], np.cumsum(each)]) for each in (a_each, b_each))
        self.n_a, self.n_b = np.diff(a_behind[stops]), np.diff(b_behind[stops])
        lanes = np.unique(np.searchsorted(a_behind, np.arange(LANE, len(a), LANE)))
        lanes = lanes[a_behind[lanes] < len(a)]
        # Both sides of a text have the same bytes, so offsets over all texts stay comparable.
        a_ends, b_ends = np.cumsum(pair.a_sizes[a]), np.cumsum(pair.b_sizes[b])
        a_cuts, b_cuts = groups(a_ends, b_ends, (a_behind[lanes], b_behind[lanes]))
        behind = np.cumsum(self.n_a)
        group_end = np.searchsorted(a_cuts, behind, "right")
        self.n_groups = np.diff(group_end, prepend=0)
        x, y = links(a_ends, b_ends, b_cuts)
        link_end = np.searchsorted(x, behind)
        self.n_links = np.diff(link_end, prepend=0)
        self.pairs = a[x] << PAIR_BITS | b[y]
        content, ends = group_text(a, b, a_cuts, b_cuts, pair.decimals)
        raw, stops = content.tobytes(), np.concatenate([[0], ends])
        self.digests = [
            hashlib.sha256(raw[stops[end - n] : stops[end] - 1]).hexdigest() if n else ""
            for n, end in zip(self.n_groups.tolist(), group_end.tolist())
        ]


# -- over a table ---------------------------------------------------------------------------------------------


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, compressed by byte planes: most are small."""
    both = np.stack(columns).astype("<i4")
    return pa.compress(np.moveaxis(both.view(np.uint8).reshape(*both.shape, 4), 2, 0).tobytes(), "zstd", asbytes=True)


def _unpacked(packed: pa.Buffer, n_columns: int, size: int) -> np.ndarray:
    plain = pa.decompress(packed, 4 * n_columns * size, "zstd")
    planes = np.frombuffer(plain, np.uint8).reshape(4, n_columns, size)
    return np.ascontiguousarray(np.moveaxis(planes, 0, 2)).view("<i4")[:, :, 0]


def slices(docs: DataFrame, text: str, id_col: str, paths: tuple[str, str]) -> DataFrame:
    """One row per slice: figures of its documents, its distinct pairs with their documents, the documents' links.

    Sums over links do not ask for their order: ``held`` has how many distinct pairs each document links, ``links`` the
    step to each pair's index from the one before it, and how often the document links it.
    """
    kinds = {"digests": pa.string(), "held": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(*paths)
        number = TaskContext.get().partitionId() << 32
        for part in text_slices(batches, limit=SLICE_BYTES):
            figures: dict[str, list] = {c: [] for c in COUNTS}
            digests, seen = [], []
            for small in text_slices([part], limit=WORK_BYTES):
                found = Aligned(pair, small.column("text").to_pylist())
                digests += found.digests
                seen.append(found.pairs)
                for c in COUNTS:
                    figures[c].append(getattr(found, c))
            one = {c: np.concatenate(v) for c, v in figures.items()}
            pairs, index = np.unique(np.concatenate(seen), return_inverse=True)
            row = np.repeat(np.arange(part.num_rows), one["n_links"])
            found, times = np.unique(row * max(len(pairs), 1) + index, return_counts=True)
            row, index = np.divmod(found, max(len(pairs), 1))
            holders, held = np.bincount(index, minlength=len(pairs)), np.bincount(row, minlength=part.num_rows)
            values = {"doc_ids": part.column("doc_id"), **one, "digests": digests, "pairs": pairs, "holders": holders, "held": held}
            arrays = [pa.array([number])]
            for name, v in values.items():
                flat = v if isinstance(v, pa.Array) else pa.array(v, kinds.get(name, pa.int64()))
                arrays.append(pa.ListArray.from_arrays([0, len(flat)], flat))
            arrays.append(pa.array([_packed(np.diff(index, prepend=0), times)], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=["slice", *values, "links"])
            number += 1

    chosen = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(run, _SLICE_DDL)


def pair_counts(written: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold a pair linked, and whether no pair of its A id is held by more."""
    asked = written.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    counts = asked.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("n"))
    counts = saved(counts, "pair-counts")
    a_id = F.shiftright("pair", PAIR_BITS)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top"))
    joined = counts.withColumn("a", a_id).join(highest, "a")
    return joined.select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def digest(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", paths: tuple[str, str] | None = None
) -> DataFrame:
    """RESULT rows, one per row of ``docs``."""
    ship(docs.sparkSession)
    written = saved(slices(docs, text, id_col, paths or default_paths()), "aligned")
    counts = pair_counts(written)
    asked = written.select("slice", F.posexplode("pairs").alias("at", "pair"))
    # A figure and its mark in one number; a slice's figures come back in the order of its pairs.
    told = asked.join(counts, "pair").select("slice", "at", (F.col("n") * 2 + F.col("best").cast("long")).alias("v"))
    back = told.groupBy("slice").agg(F.collect_list(F.struct("at", "v")).alias("told"))
    both = written.drop("pairs", "holders").join(back, "slice", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                column = {c: batch.column(c)[i].values for c in batch.schema.names if c not in ("slice", "links")}
                stops = np.concatenate([[0], np.cumsum(column["held"].to_numpy(zero_copy_only=False), dtype=np.int64)])
                step, times = _unpacked(batch.column("links")[i].as_buffer(), 2, int(stops[-1]))
                index = np.cumsum(step, dtype=np.int64)
                value = np.zeros(0, np.int64)
                if column["told"] is not None:
                    at, v = (column["told"].field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    value = np.empty(len(at), np.int64)
                    value[at] = v
                best = np.concatenate([[0], np.cumsum((value[index] & 1) * times)])
                total = np.concatenate([[0], np.cumsum((value[index] >> 1) * times)])
                sums = [pa.array(s[stops[1:]] - s[stops[:-1]]) for s in (best, total)]
                yield pa.RecordBatch.from_arrays(
                    [column["doc_ids"], *[column[c] for c in COUNTS], *sums, column["digests"]],
                    names=[c.split()[0] for c in RESULT.split(", ")],
                )

    return both.mapInArrow(run, RESULT)
