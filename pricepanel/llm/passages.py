"""Fuzzy passages shared between documents: k-mer seeds, collinear chains, alignment.

Seeds are all runs of K words: any K equal words are a common seed.  Every
occurrence of a seed is joined with the seed's earliest occurrence, so a seed of n documents gives n - 1 matches, not n**2;
copies and shared passages are linked to the first document that has them.
The matches of a pair of documents are chained in order, with gap costs,
through a Fenwick tree of prefix maxima, and the words along each chain are
aligned to find the passage's borders and its share of equal words.
Occurrences that no passage covers then are joined with all places of their seed
in all documents before their own, because its earliest one may be a chance one.
Of documents with equal texts the first stands for all in that joining.  Pairs
whose runs of equal words cannot grow into a passage, by the words next to each
run, are dropped there before any text is fetched.

Defined results: null texts are empty; rows without an id are not compared;
rows that share an id count as one document; words are compared without case
and punctuation; matches inside one document are not reported.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm.columns import ALNUM, Runs, Words, mix, text_slices
from pricepanel.llm.registry import saved

#: Words of a seed.
K = 5
#: Of equal words on end, one seed in so many goes into a chain, and the last.
STEP = 5
#: Least words of a passage on either side, and least share of equal words.
MIN_WORDS = 40
MIN_IDENTITY = 0.8
#: Cost of a gap per skipped word of either side, against K for a seed.
GAP_COST = 0.05
#: Seeds of a chain.
MIN_SEEDS = 2
#: Bits of an id that differ within a block of later, and of earlier, documents: one block is compared with another at once.
LATER_BITS, EARLIER_BITS = 11, 14
#: Matches of two blocks held at once.
BLOCK_MATCHES = 1 << 19
#: Matches of pairs that are chained at once.
BATCH_MATCHES = 1 << 15
#: Words before and after a seed, as four bits each, that tell whether a run of equal words can grow into a passage.
BESIDE = 16
#: The lowest words of so many.
WITHIN = np.array([(1 << 4 * n) - 1 for n in range(BESIDE + 1)], np.uint64)
#: In the first joining those next to a seed, as two bits each.
NEAR = 8
#: Of pairs of documents with more runs of equal words than this and one, the runs are not looked at two by two.
LAGS = 7
#: Text whose seeds are packed at once; buckets of seeds, and tasks for blocks, for each partition of a shuffle.
DEALT_BYTES, BUCKETS = 4 << 20, 4
#: Setting by which Spark removes the files of a query's exchanges when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Setting of the most that goes to a worker at once: joined rows hold a text each.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Words beside a chain that are looked at to extend it; longer equal stretches hold seeds of their own.
MARGIN = 96
#: A stretch between seeds of so many words with fewer than half equal ends the passage.
BREAK = 20
#: Extension: cost of a different word, and the drop in score that ends it.
MISMATCH, DROP = 3, 12


def seeds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word position, hash) of the seeds of every text."""
    words = Words(texts, ALNUM, lower=True)
    return _seeds(words, words.hashes())


def _seeds(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(words.start)
    count = words.count - K + 1
    if n < K:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    at = np.arange(n - K + 1)
    h = mix(Runs(hashes).of(at, at + K)) | np.uint64(1)
    row = words.row[: len(h)]
    position = at - words.first[row]
    inside = position < count[row]
    keep = np.flatnonzero(inside)
    row, position, h = row[keep], position[keep], h[keep]
    # A seed that a text repeats also stands, with an even hash, for its second, third ... place, so that loops align with loops.
    order = np.lexsort((position, h, row))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(row[order]) != 0) | (np.diff(h[order]) != 0)
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.arange(len(order)) - first
    again = rank > 0
    ranked = mix(h[again] + rank[again]) & ~np.uint64(1)
    return (
        np.concatenate([row, row[again]]),
        np.concatenate([position, position[again]]),
        np.concatenate([h, ranked]),
    )


def thinned(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matches without repeats; of those that follow each other word by word, the first, the last and every STEP-th.

    A loop's words match at many places: matches inside MIN_WORDS equal words on end count only as part of those.
    """
    _, x, y = _thinned(np.zeros(len(x), np.int64), x.astype(np.int64), y.astype(np.int64))
    return x, y


def _thinned(pair: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``thinned`` of the matches of several pairs."""
    order = np.lexsort((x, y - x, pair))
    pair, x, y = pair[order], x[order], y[order]
    other = np.ones(len(x), bool)
    other[1:] = (np.diff(pair) != 0) | (np.diff(y - x) != 0)
    keep = other.copy()
    keep[1:] |= np.diff(x) != 0
    pair, x, y, other = (v[keep] for v in (pair, x, y, other))
    new = np.ones(len(x) + 1, bool)
    new[1:-1] = other[1:] | (np.diff(x) != 1)
    first = np.flatnonzero(new[:-1])
    size = np.diff(np.flatnonzero(new))
    at = np.arange(len(x)) - np.repeat(first, size)
    keep = (at % STEP == 0) | new[1:]
    # What lies inside long runs is told pair by pair.
    for p in np.unique(pair[first[size + K - 1 >= MIN_WORDS]]):
        a, b = np.searchsorted(pair, [p, p + 1])
        low, high = np.searchsorted(first, [a, b])
        keep[a:b] = _outside(x[a:b], size[low:high], keep[a:b])
    return pair[keep], x[keep], y[keep]


def _outside(x: np.ndarray, size: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """``keep`` without matches inside long runs at other places; matches ``x`` are runs of so many."""
    first, long = np.cumsum(size) - size, size + K - 1 >= MIN_WORDS
    if not long.any():
        return keep
    order = np.argsort(x[first[long]])
    start = x[first[long]][order]
    end = np.maximum.accumulate((start + size[long][order] + K - 1))
    i = np.searchsorted(start, x, "right") - 1
    return keep & (np.repeat(long, size) | (i < 0) | (end[i] < x + K))


def chains(x: list[int], y: list[int]) -> list[list[int]]:
    """Indices of matches (x, y), grouped into chains that ascend in both, best first.

    score(j) = K + max(0, best over i before j in both of score(i) - GAP_COST * skipped words);
    skipped words are linear in both places, so the best i is a prefix maximum over y.
    """
    size = len(x)
    rank = {v: r for r, v in enumerate(sorted(set(y)))}
    top = len(rank)
    # Prefix maxima of (score with the cost of the words before, match).
    tree: list[tuple[float, int]] = [(float("-inf"), -1)] * (top + 1)
    score, before = [0.0] * size, [-1] * size
    for a, negative, j in sorted(zip(x, (-v for v in y), range(size))):
        b = -negative
        place = at = rank[b]
        best = tree[0]
        while at:
            if tree[at] > best:
                best = tree[at]
            at &= at - 1
        gain = best[0] - GAP_COST * (a + b - 2 * K)
        if gain > 0:
            score[j], before[j] = K + gain, best[1]
        else:
            score[j] = float(K)
        entry, at = (score[j] + GAP_COST * (a + b), j), place + 1
        while at <= top:
            # Larger prefixes have no less.
            if entry <= tree[at]:
                break
            tree[at] = entry
            at += at & -at
    used, out = [False] * size, []
    for j in sorted(range(size), key=score.__getitem__, reverse=True):
        found = []
        while j >= 0 and not used[j]:
            used[j] = True
            found.append(j)
            j = before[j]
        if len(found) >= MIN_SEEDS:
            out.append(found[::-1])
    return out


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words in the best alignment of two short stretches."""
    if len(a) == len(b):
        return int((a == b).sum())
    if not len(a) or not len(b):
        return 0
    # Longest common subsequence, a row at a time.
    row = np.zeros(len(b) + 1, np.int64)
    for word in a:
        new = row.copy()
        new[1:] = np.maximum(row[1:], row[:-1] + (b == word))
        row = np.maximum.accumulate(new)
    return int(row[-1])


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words, equal words) by which the common start of ``a`` and ``b`` is worth taking."""
    n = min(len(a), len(b))
    if n == 0:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -MISMATCH))
    stop = np.flatnonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > DROP)
    if len(stop):
        score = score[: stop[0]]
    if not len(score) or score.max() <= 0:
        return 0, 0
    best = int(score.argmax()) + 1
    return best, int(same[:best].sum())


def _widest(a: np.ndarray, b: np.ndarray, a0: int, a1: int, b0: int, b1: int, equal: int) -> tuple[int, int, int]:
    """(words to the left, to the right, equal words among them): the most that leaves MIN_IDENTITY of all equal."""
    n, m = min(a0, b0, MARGIN), min(len(a) - a1, len(b) - b1, MARGIN)
    left = np.concatenate([[True], a[a0 - n : a0][::-1] == b[b0 - n : b0][::-1]])
    right = np.concatenate([[True], a[a1 : a1 + m] == b[b1 : b1 + m]])
    l, r = np.flatnonzero(left), np.flatnonzero(right)
    more = np.cumsum(left)[l][:, None] + np.cumsum(right)[r] - 2
    size = l[:, None] + r
    ok = equal + more >= MIN_IDENTITY * (max(a1 - a0, b1 - b0) + size)
    i, j = np.unravel_index(np.where(ok, size, -1).argmax(), size.shape)
    return (int(l[i]), int(r[j]), int(more[i, j])) if ok[i, j] else (0, 0, 0)


def _accepted(n: int, m: int, equal: int) -> bool:
    return min(n, m) >= MIN_WORDS and equal >= MIN_IDENTITY * max(n, m)


def align(a: np.ndarray, b: np.ndarray, x: list[int], y: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Passages (a start, a end, b start, b end, equal words) along a chain of seeds at (x, y)."""
    pieces, equal = [], 0
    first = (x[0], y[0])
    for (p, q), (r, s) in zip(zip(x, y), zip(x[1:], y[1:])):
        if r - p == s - q:
            got = np.count_nonzero(a[p:r] == b[q:s])
        elif r - p < K or s - q < K:
            got = min(r - p, s - q)
        else:
            got = K + _equal(a[p + K : r], b[q + K : s])
        longer = max(r - p, s - q) - K
        if longer >= BREAK and got - K < longer / 2:
            pieces.append((*first, p + K, q + K, equal + K))
            first, equal = (r, s), 0
        else:
            equal += got
    pieces.append((*first, x[-1] + K, y[-1] + K, equal + K))
    out = []
    for a0, b0, a1, b1, core in pieces:
        n, m = min(a0, b0), min(len(a) - a1, len(b) - b1)
        beside = np.count_nonzero(a[a0 - n : a0] == b[b0 - n : b0]) + np.count_nonzero(a[a1 : a1 + m] == b[b1 : b1 + m])
        if core + beside < MIN_IDENTITY * MIN_WORDS:
            continue
        left, left_equal = _extend(a[:a0][::-1], b[:b0][::-1])
        right, right_equal = _extend(a[a1:], b[b1:])
        equal = core + left_equal + right_equal
        if not _accepted(a1 - a0 + left + right, b1 - b0 + left + right, equal):
            # A passage near the limits may have more different words on end than an extension passes.
            left, right, more = _widest(a, b, a0, a1, b0, b1, core)
            equal = core + more
        a0, b0, a1, b1 = a0 - left, b0 - left, a1 + right, b1 + right
        if _accepted(a1 - a0, b1 - b0, equal):
            out.append((a0, a1, b0, b1, equal))
    return out


_DEALT = "bucket int, doc_id array<long>, count array<int>, hash binary, step binary, beside binary"


def _near(words: Words, hashes: np.ndarray, row: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Two bits of each of the NEAR words before seeds, the nearest lowest, and above them of those after; 0 beyond the text."""
    letter = np.zeros(len(hashes) + 2 * NEAR + K, np.uint32)
    letter[NEAR : NEAR + len(hashes)] = hashes >> np.uint64(62)
    at = words.first[row] + position + NEAR
    rest = words.count[row] - position - K
    out = np.zeros(len(row), np.uint32)
    for i in range(NEAR):
        out |= np.where(position > i, letter[at - 1 - i], 0).astype(np.uint32) << np.uint32(2 * i)
        out |= np.where(rest > i, letter[at + K + i], 0).astype(np.uint32) << np.uint32(2 * (NEAR + i))
    return out


def _dealt(docs: DataFrame, buckets: int) -> DataFrame:
    """Seeds, packed: of a slice of rows, those of one bucket of hashes make one row.

    A seed takes six bytes of hash, of which the bucket tells the rest, the step from the place before it in byte planes,
    which are mostly zeros, and four bytes of its neighbours.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=DEALT_BYTES):
            words = Words(part.column("text"), ALNUM, lower=True)
            hashes = words.hashes()
            row, position, h = _seeds(words, hashes)
            near = _near(words, hashes, row, position)
            bucket = (h >> np.uint64(48)).astype(np.int64) * buckets >> 16
            order = np.argsort(bucket << 44 | (words.first[row] + position), kind="stable")
            row, position, h, near, bucket = (v[order] for v in (row, position, h, near, bucket))
            new = np.ones(len(row) + 1, bool)
            new[1:-1] = (np.diff(bucket) != 0) | (np.diff(row) != 0)
            starts = np.flatnonzero(new[:-1])
            count = np.diff(np.flatnonzero(new)).astype(np.int32)
            step = position.copy()
            step[1:] -= np.where(new[1:-1], 0, position[:-1])
            tail = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
            planes = step.astype("<i4").view(np.uint8).reshape(-1, 4)
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            ends = list(zip(cuts.tolist(), cuts[1:].tolist()))
            runs = np.searchsorted(starts, cuts).astype(np.int32)
            ids = part.column("doc_id").take(pa.array(row[starts]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[cuts[:-1]].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(runs), ids),
                    pa.ListArray.from_arrays(pa.array(runs), pa.array(count)),
                    pa.array([tail[a:b].tobytes() for a, b in ends], pa.binary()),
                    pa.array([planes[a:b].T.tobytes() for a, b in ends], pa.binary()),
                    pa.array([near[a:b].tobytes() for a, b in ends], pa.binary()),
                ],
                names=[c.split()[0] for c in _DEALT.split(", ")],
            )

    return docs.mapInArrow(run, _DEALT)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """Successive rows with equal keys."""
    rows: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        values = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        cuts = np.flatnonzero((np.diff(values, axis=0) != 0).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)]):
            if rows and key != tuple(values[a : a + 1].ravel()):
                yield rows
                rows = []
            if b > a:
                key = tuple(values[a])
                rows.append(batch.slice(a, b - a))
    if rows:
        yield rows


def _unpacked(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, position, 48 bits of the hash, neighbours) of the seeds of a bucket."""
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for batch in rows:
        ids, counts = (batch.column(c) for c in ("doc_id", "count"))
        for i in range(batch.num_rows):
            doc, count = (c[i].values.to_numpy(zero_copy_only=False) for c in (ids, counts))
            tail, planes, near = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint8) for c in ("hash", "step", "beside"))
            n = len(near) // 4
            h = np.zeros((n, 8), np.uint8)
            h[:, :6] = tail.reshape(n, 6)
            total = np.cumsum(np.ascontiguousarray(planes.reshape(4, n).T).view("<i4")[:, 0], dtype=np.int64)
            first = np.cumsum(count) - count
            position = total - np.repeat(np.where(first > 0, total[first - 1], 0), count)
            for part, value in zip(parts, (np.repeat(doc, count), position.astype(np.int32), h.view("<u8")[:, 0], near.view("<u4"))):
                part.append(value)
    return tuple(np.concatenate(p) for p in parts)


_SHARED = "seed long, doc_id long, position int, other_id long, y int, differ int"


def _shared(docs: DataFrame) -> DataFrame:
    """Occurrences of seeds of several documents with the earliest one, and the neighbours that differ from those there."""
    buckets = min(BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << 15)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["bucket"]):
            bucket = rows[0].column("bucket")[0].as_py()
            doc, position, h, near = _unpacked(rows)
            order = np.argsort(h)
            same = np.zeros(len(h) + 1, bool)
            same[1:-1] = np.diff(h[order]) == 0
            order = order[same[1:] | same[:-1]]
            order = order[np.lexsort((position[order], doc[order], h[order]))]
            doc, position, h, near = (v[order] for v in (doc, position, h, near))
            new = np.ones(len(h) + 1, bool)
            new[1:-1] = np.diff(h) != 0
            ends = np.flatnonzero(new)
            first, size = ends[:-1], np.diff(ends)
            keep = np.repeat(doc[first] < doc[ends[1:] - 1], size)
            hub, i = np.repeat(first, size)[keep], np.flatnonzero(keep)
            differ = near[i] ^ near[hub]
            differ = (differ | differ >> np.uint32(1)) & np.uint32(0x55555555)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h[i].astype(np.int64) | bucket << 48),
                    pa.array(doc[i]),
                    pa.array(position[i]),
                    pa.array(doc[hub]),
                    pa.array(position[hub]),
                    pa.array(differ.view(np.int32)),
                ],
                names=[c.split()[0] for c in _SHARED.split(", ")],
            )

    dealt = _dealt(docs, buckets).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, _SHARED)


_CHAIN = "doc_id long, other_id long, x array<int>, y array<int>"


def _chain_batch(found: Iterator[tuple[int, int, list[int], list[int]]]) -> pa.RecordBatch:
    """A batch of chains (doc_id, other_id, x, y)."""
    out = list(zip(*found)) or [[]] * 4
    many = pa.list_(pa.int32())
    kinds = [pa.int64(), pa.int64(), many, many]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "other_id", "x", "y"])


def _chains_of(doc: np.ndarray, other: np.ndarray, pair: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[tuple]:
    """(doc_id, other_id, x, y, pair) of the chains of the matches of pairs, which are numbers of rows of ``doc`` and ``other``."""
    firsts = np.flatnonzero(np.diff(pair, prepend=-1))
    firsts = firsts[np.diff(firsts // BATCH_MATCHES, prepend=-1) > 0].tolist()
    for low, high in zip(firsts, [*firsts[1:], len(pair)]):
        part, xs, ys = _thinned(*(v[low:high].astype(np.int64) for v in (pair, x, y)))
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        which = part[starts]
        cuts = np.append(starts, len(part)).tolist()
        xs, ys = xs.tolist(), ys.tolist()
        for p, d, o, a, b in zip(which.tolist(), doc[which].tolist(), other[which].tolist(), cuts, cuts[1:]):
            for found in chains(xs[a:b], ys[a:b]) if b - a >= MIN_SEEDS else ():
                yield d, o, [xs[a + i] for i in found], [ys[a + i] for i in found], p


def _chain_rows(pairs: DataFrame) -> DataFrame:
    """From (doc_id, other_id, matches): one row per chain, of pairs whose runs of equal words can make a passage."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("matches")
            both = found.flatten()
            x, y, differ = (both.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y", "differ"))
            pair = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            order = np.lexsort((x, x - y, pair))
            pair, x, y, differ = (v[order] for v in (pair, x, y, differ))
            # Runs of equal words: matches that follow each other word by word; a repeated seed can give a match twice.
            new = np.ones(len(x) + 1, bool)
            new[1:-1] = (np.diff(pair) != 0) | (np.diff(x - y) != 0) | (np.diff(x) > 1)
            first, last = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
            begin, end = x[first].astype(np.int64), x[last].astype(np.int64)
            hopeful = _visibly_hopeful(end - begin + K, differ[first], differ[last])
            starts = np.flatnonzero(np.diff(pair[first], prepend=-1))
            wanted = _wanted(starts, begin, end, begin - y[first], hopeful)
            doc, other = (batch.column(c).to_numpy() for c in ("doc_id", "other_id"))
            go_on = np.zeros(batch.num_rows, bool)
            go_on[pair[first[starts]]] = wanted
            pair, x, y = (v[go_on[pair]] for v in (pair, x, y))
            yield _chain_batch(chain[:4] for chain in _chains_of(doc, other, pair, x, y))

    return pairs.mapInArrow(run, _CHAIN)


def _around(words: Words, hashes: np.ndarray, row: int, at: list[int]) -> tuple[np.ndarray, int, list[int]]:
    """(word hashes around a chain, the first one's position, places relative to it)."""
    lo, hi = int(words.first[row]), int(words.first[row + 1])
    begin = max(at[0] - MARGIN, 0)
    return hashes[lo + begin : min(lo + at[-1] + K + MARGIN, hi)], begin, [p - begin for p in at]


def _with_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words, np.ndarray, np.ndarray]]:
    """(rows, words of their different texts, word hashes, the text of every row): successive equal texts are read once."""
    for batch in batches:
        text = batch.column("text")
        new = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            new[1:] = pc.not_equal(text[1:], text[:-1]).fill_null(True).to_numpy(zero_copy_only=False)
        firsts = np.append(np.flatnonzero(new), batch.num_rows)
        different = pa.RecordBatch.from_arrays([text.filter(pa.array(new))], names=["text"])
        a = 0
        for part in text_slices(iter([different])):
            words = Words(part.column("text"), ALNUM, lower=True)
            b = a + part.num_rows
            sizes = np.diff(firsts[a : b + 1])
            rows = batch.slice(int(firsts[a]), int(sizes.sum()))
            yield rows, words, words.hashes().astype("<u8"), np.repeat(np.arange(len(sizes)), sizes)
            a = b


def _first_words(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Add to each chain the word hashes around it in its own document."""
    joined = rows.join(docs.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, hashes, texts in _with_words(batches):
            found = [_around(words, hashes, r, at) for r, at in zip(texts.tolist(), part.column("x").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("other_id"),
                    pa.array([places for _, _, places in found], pa.list_(pa.int32())),
                    part.column("y"),
                    pa.array([near.tobytes() for near, _, _ in found], pa.binary()),
                    pa.array([begin for _, begin, _ in found], pa.int32()),
                ],
                names=["doc_id", "other_id", "x", "y", "a", "a_from"],
            )

    return joined.select("doc_id", "other_id", "x", "y", "text").mapInArrow(run, f"{_CHAIN}, a binary, a_from int")


_PASSAGE = (
    "doc_id long, start_word long, end_word long, other_doc_id long, other_start long, other_end long, "
    "n_equal long"
)


def _aligned(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Passages along chains, which hold their own words; the other document's text is joined here."""
    joined = rows.join(docs.withColumnRenamed("doc_id", "_id"), F.col("other_id") == F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words, hashes, texts in _with_words(batches):
            out = []
            columns = (part.column(c).to_pylist() for c in ("doc_id", "other_id", "x", "y", "a", "a_from"))
            for r, doc, other, x, y, mine, i in zip(texts.tolist(), *columns):
                a = np.frombuffer(mine, "<u8")
                b, j, y = _around(words, hashes, r, y)
                # A place beyond the words means that two rows share the id; the other row has them.
                if x[-1] + K <= len(a) and y[-1] + K <= len(b):
                    for a0, a1, b0, b1, equal in align(a, b, x, y):
                        out.append((doc, a0 + i, a1 + i, other, b0 + j, b1 + j, equal))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in _PASSAGE.split(", ")]
            )

    return joined.select("doc_id", "other_id", "x", "y", "a", "a_from", "text").mapInArrow(run, _PASSAGE)


def _first_chains(matches: DataFrame) -> DataFrame:
    """Chains of matches (doc_id, other_id, x, y, differ)."""
    pairs = (
        matches.groupBy("doc_id", "other_id")
        .agg(F.collect_list(F.struct("x", "y", "differ")).alias("matches"))
        .filter(F.size("matches") >= MIN_SEEDS)
    )
    return _chain_rows(pairs)


def _written(df: DataFrame, label: str) -> DataFrame:
    """``saved``, and the files of its exchanges are removed as soon as it is written, not when the driver collects garbage."""
    conf = df.sparkSession.conf
    wanted = {CLEANUP: "true", BATCH_BYTES: "16m"}
    before = {key: conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        conf.set(key, value)
    try:
        return saved(df, label)
    finally:
        for key, value in before.items():
            conf.set(key, value) if value is not None else conf.unset(key)


def _linked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Passages along chains."""
    return _written(_aligned(_first_words(_written(rows, "chains"), docs), docs), "passages")


_PLACE = (
    "seed long, doc_id long, position int, before long, after long, single boolean, later boolean, covered boolean, earlier boolean"
)


def _beside(words: Words, hashes: np.ndarray, row: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The BESIDE words before and after seeds, the nearest lowest, as four bits of a number; 0 where the text ends."""
    letter = np.maximum(hashes >> np.uint64(56) & np.uint64(15), np.uint64(1))
    lo, hi = words.first[row], words.first[row + 1]
    sides = []
    for first, step in ((lo + position - 1, -1), (lo + position + K, 1)):
        out = np.zeros(len(row), np.uint64)
        for i in range(BESIDE):
            at = first + step * i
            there = (at >= lo) & (at < hi)
            out[there] |= letter[at[there]] << np.uint64(4 * i)
        sides.append(out.view(np.int64))
    return sides[0], sides[1]


def _places(shared: DataFrame, docs: DataFrame, found: DataFrame) -> DataFrame:
    """Occurrences of shared seeds that the second joining compares, with the words beside them.

    ``later``: not in the first document of the seed, and no passage of their document covers them; ``covered``: one
    does, but a chain of occurrences that are not could be extended to there.  ``earlier``: in the first document with its text.
    ``single``: only one row has the document's id.
    """
    hub = (F.col("doc_id") == F.col("other_id")).alias("hub")
    # A repeated seed's further places are places of the seed as well.
    seeds = shared.filter(F.col("seed").bitwiseAND(F.lit(1)) == 1)
    occurrences = seeds.groupBy("doc_id").agg(F.collect_set(F.struct("seed", "position", hub)).alias("found"))
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    firsts = docs.groupBy(F.sha2("text", 256)).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    rows = docs.groupBy("doc_id").agg(F.min("text").alias("text"), (F.count(F.lit(1)) == 1).alias("single"))
    joined = (
        rows.join(occurrences, "doc_id")
        .join(spans, "doc_id", "left")
        .join(firsts.withColumn("stands", F.lit(True)), "doc_id", "left")
        .select("doc_id", "text", "single", "found", "spans", F.coalesce("stands", F.lit(False)).alias("stands"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            words = Words(part.column("text"), ALNUM, lower=True)
            found = part.column("found")
            row = np.repeat(np.arange(part.num_rows), np.diff(found.offsets.to_numpy()))
            flat = found.flatten()
            seed, position, hub = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("seed", "position", "hub"))
            position = position.astype(np.int64)
            inside, covered = np.zeros(len(row), bool), np.zeros(len(row), bool)
            cuts = np.searchsorted(row, np.arange(part.num_rows + 1)).tolist()
            for a, b, near in zip(cuts, cuts[1:], part.column("spans").to_pylist()):
                at = position[a:b]
                for p in near or ():
                    inside[a:b] |= (p["start_word"] <= at) & (at + K <= p["end_word"])
                if near:
                    free = np.append(np.sort(at[~hub[a:b] & ~inside[a:b]]), 1 << 40)
                    i = np.searchsorted(free, at)
                    gap = np.minimum(free[i] - at, np.where(i > 0, at - free[i - 1], 1 << 40))
                    covered[a:b] = inside[a:b] & ~hub[a:b] & (gap <= MARGIN + 2 * K)
            stands = part.column("stands").to_numpy(zero_copy_only=False)[row]
            later = ~hub & ~inside
            keep = np.flatnonzero(later | covered | stands)
            row, seed, position, later, covered, stands = (v[keep] for v in (row, seed, position, later, covered, stands))
            before, after = _beside(words, words.hashes(), row, position)
            doc, single = (part.column(c).take(pa.array(row)) for c in ("doc_id", "single"))
            columns = [seed, doc, position.astype(np.int32), before, after, single, later, covered, stands]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in _PLACE.split(", ")])

    return joined.mapInArrow(run, _PLACE)


def _hopeful(
    words: np.ndarray,
    before: tuple[np.ndarray, np.ndarray],
    after: tuple[np.ndarray, np.ndarray],
    score: np.ndarray | None = None,
) -> np.ndarray:
    """Whether runs of so many equal words, of which no other run is in reach, can be part of a passage.

    Beside such a run every stretch up to a different word has 4 equal words at most, so with +1 for an equal and -4 for
    a different word (a passage has 0 or more, as 4 of 5 words are equal) either side adds 0 at most, and each must have
    -words or more.  What follows the first i words of a side adds 4 at most, so those have i - 5 * different >= -words - 4.
    One of the sides has half of the words that the run lacks, so a side whose text ends before is not that one.
    Where words of the run differ, ``score`` is what it has, instead of its words.
    """
    score = words if score is None else score
    near = np.clip((MIN_WORDS - words + 1) // 2, 0, BESIDE)
    # The lowest bit of each word that is looked at.
    within = np.uint64(0x1111111111111111) & WITHIN[near]
    some = np.zeros(len(words), bool)
    for a, b in (before, after):
        a, b = a.view(np.uint64), b.view(np.uint64)
        # Both sides of an end are 0, which is no equal word.
        equal = _nonzero(a) & ~_nonzero(a ^ b)
        differ = near - np.bitwise_count(equal & within).astype(np.int64)
        some |= near - 5 * differ >= -score - 4
    likely = np.flatnonzero(some)
    some[likely] = _reaches(words[likely], score[likely], *((a[likely], b[likely]) for a, b in (before, after)))
    return some


def _reaches(words: np.ndarray, score: np.ndarray, *sides: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """``_hopeful``, by all words beside: a passage ends with equal words, and takes so many of both sides that it has its size."""
    scores = []
    for a, b in sides:
        a, b = a.view(np.uint64), b.view(np.uint64)
        equal = (_nonzero(a) & ~_nonzero(a ^ b))[:, None] >> (4 * np.arange(BESIDE, dtype=np.uint64)) & np.uint64(1) > 0
        gain = np.zeros((len(words), BESIDE + 2), np.int64)
        np.cumsum(np.where(equal, 1, -4), axis=1, out=gain[:, 1:-1])
        gain[:, -1] = gain[:, -2] + 4
        gain[:, 1:-1][~equal] = -1000
        scores.append(gain)
    left, right = scores
    right = np.maximum.accumulate(right[:, ::-1], axis=1)[:, ::-1]
    lack = np.maximum(MIN_WORDS - words, 0)[:, None] - np.arange(BESIDE + 2)
    lack[:, -1] = 0
    best = left + np.take_along_axis(right, np.clip(lack, 0, BESIDE + 1), axis=1)
    return best.max(axis=1) >= -score


def _nonzero(v: np.ndarray) -> np.ndarray:
    """In the lowest of every four bits, whether one of the four is set."""
    v = v | v >> np.uint64(2)
    return v | v >> np.uint64(1)


def _linkable(
    begin: np.ndarray, end: np.ndarray, to: np.ndarray, last: np.ndarray, shift: np.ndarray, span: np.ndarray
) -> np.ndarray:
    """Whether a passage can go on from runs of seeds at begin..end to runs at to..last, whose x - y is ``shift`` more.

    A step to a seed ``most`` words ahead on the one side and ``most - off`` on the other is no end of the passage if
    fewer than BREAK words lie between or half of them can be equal.  A run of the same x - y may be in an extension.
    """
    off, ahead = np.abs(shift), np.maximum(-shift, 0)
    least = np.maximum(to - end + ahead, off + 1)
    most = np.minimum(last - begin + ahead, (span + off) // 2)
    step = (least <= most) & ((least < K + BREAK) | (most >= K + 2 * off))
    return step | ((shift == 0) & (to > begin) & (to - end <= MARGIN + 2 * K))


def _visibly_hopeful(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """``_hopeful`` by two bits a word, of what differs beside the first and the last seed of runs of so many words."""
    near = np.clip((MIN_WORDS - words + 1) // 2, 0, NEAR)
    within = (np.int64(1) << 2 * near) - 1
    sides = (first.astype(np.int64) & within, last.astype(np.int64) >> 2 * NEAR & within)
    some = [near - 5 * np.bitwise_count(side).astype(np.int64) >= -words - 4 for side in sides]
    return (words > K) & (some[0] | some[1])


def _wanted(starts: np.ndarray, begin: np.ndarray, end: np.ndarray, diagonal: np.ndarray, hopeful: np.ndarray) -> np.ndarray:
    """Which pairs, of runs of seeds from ``starts`` on, have a hopeful run or runs that can be linked."""
    sizes = np.diff(np.append(starts, len(begin)))
    which = np.repeat(np.arange(len(starts)), sizes)
    linked = hopeful.copy()
    several = np.flatnonzero(sizes[which] > 1)
    if len(several):
        pair, begin, end, diagonal = (v[several] for v in (which, begin, end, diagonal))
        seeds = end - begin + 1
        # Seeds of a chain before its step to another run: all but the least run's; what such a chain can span.
        kept = 2 + (seeds - 1) // STEP
        kept[seeds == 1] = 1
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        span = (np.add.reduceat(kept, first) - np.minimum.reduceat(kept, first)) * (K / GAP_COST + 2 * K) + 2 * K
        span = np.repeat(span, np.diff(np.append(first, len(pair))))
        for lag in range(1, LAGS + 1):
            i = np.flatnonzero(pair[lag:] == pair[:-lag])
            j = i + lag
            linked[several[i]] |= _linkable(begin[i], end[i], begin[j], end[j], diagonal[j] - diagonal[i], span[i])
            linked[several[i]] |= _linkable(begin[j], end[j], begin[i], end[i], diagonal[i] - diagonal[j], span[i])
    return np.logical_or.reduceat(linked, starts) | (sizes > LAGS + 1) if len(starts) else np.zeros(0, bool)


class _Runs:
    """Runs of equal words of some pairs of documents."""

    def __init__(self, pair: np.ndarray, begin: np.ndarray, y: np.ndarray, size: np.ndarray, ends: list[np.ndarray]):
        place = self._place(pair, begin - y)
        order = np.lexsort((begin, place))
        self.begin, self.end = begin[order], (begin + size - 1)[order]
        self.ends = [v[order] for v in ends]
        self._places, group = np.unique(place[order], return_inverse=True)
        self._group, self._key, self._key_of_end = group << 32, group << 32 | self.begin, group << 32 | self.end
        self._seeds = np.concatenate([[0], np.cumsum(size[order])])

    @staticmethod
    def _place(pair: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        return (pair << 33) + diagonal + (1 << 32)

    def of(self, pair: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The run that holds each match."""
        group = np.searchsorted(self._places, self._place(pair, x - y))
        return np.searchsorted(self._key, group << 32 | x, "right") - 1

    def beside(self, first: np.ndarray, last: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Seeds of the runs of the same x - y that lie so many words, or fewer, before ``first`` and after ``last``."""
        low = np.searchsorted(self._key_of_end, self._group[first] | np.maximum(self.begin[first] - far, 0))
        high = np.searchsorted(self._key, self._group[last] | self.end[last] + far, "right")
        return self._seeds[first] - self._seeds[low] + self._seeds[high] - self._seeds[last + 1]


def _reach(pair: np.ndarray, x: np.ndarray, y: np.ndarray, starts: np.ndarray, runs: _Runs) -> tuple[np.ndarray, ...]:
    """What ``_hopeful`` needs of the pieces that alignment makes of chains, which begin at ``starts``.

    (chain, whether it does not tell, words, score, the runs in which the piece begins and ends).  Alignment cuts where
    the shorter side of a step has too few words to equal half of the other's; where the words decide, ``_hopeful`` does
    not tell.  A step adds no more equal words than its shorter side has.  A piece is extended word by word: first
    through the rest of its first and last run, then beyond, where a run of n seeds that follows a different word adds n.
    """
    chain = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
    on = np.append(np.diff(chain) == 0, False)
    dx, dy = (np.where(on, np.diff(v, append=0), 0) for v in (x, y))
    least, most = np.minimum(dx, dy), np.maximum(dx, dy)
    wide = on & (most >= BREAK + K)
    cut = wide & (dx != dy) & ((least < K) | (2 * (least - K) < most - K))
    # Covered occurrences far from others are not compared: a run among them could lie in the middle of a long step.
    unsure = np.logical_or.reduceat(wide & (~cut | (dx > 2 * MARGIN)), starts)
    split = cut & ~unsure[chain]
    first = np.flatnonzero(np.diff(chain, prepend=-1) | np.append(False, split[:-1]))
    last = np.append(first[1:], len(x)) - 1
    chain = chain[first]
    whole = np.bincount(chain, minlength=len(starts))[chain] == 1
    i, j = runs.of(pair[first], x[first], y[first]), runs.of(pair[last], x[last], y[last])
    # The words at hand end MARGIN words beside the chain, but a piece may be extended along the others.
    beside = runs.beside(i, j, np.where(whole, MARGIN + 2 * K, 1 << 31))
    rest = x[first] - runs.begin[i] + runs.end[j] - x[last]
    n, m = x[last] - x[first] + K, y[last] - y[first] + K
    equal = K + np.add.reduceat(np.where(split, 0, least), first)
    return chain, unsure[chain], np.minimum(n, m) + rest, 5 * equal - 4 * np.maximum(n, m) + rest + beside, i, j


def _following(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each occurrence the one at the next word of its document, or -1."""
    order = np.lexsort((place, doc))
    out = np.full(len(doc), -1)
    on = np.flatnonzero((np.diff(doc[order]) == 0) & (np.diff(place[order]) == 1))
    out[order[on]] = order[on + 1]
    return out


def _batches(pairs: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Successive pairs that together have few matches, as each of two loops matches at all places of the other."""
    some, total = [], 0
    for pair in pairs:
        some.append(pair)
        total += int(pair[4].sum())
        if total >= BATCH_MATCHES:
            yield some
            some, total = [], 0
    if some:
        yield some


class _Block:
    """Occurrences of seeds in later and in earlier documents: rows of two lists, of one seed each.

    Runs of equal words are found from their first seeds: two occurrences of a seed before which the documents hold
    different seeds, or none that are compared.  So a phrase is looked at once for two of its holders.
    """

    def __init__(self, rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).combine_chunks()
        later, earlier = (table.column(c).combine_chunks() for c in ("later", "earlier"))
        flat = later.flatten()
        self.doc, self.x, self.before, self.after, self.alone, self.covered = (
            flat.field(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "x", "before", "after", "single", "covered")
        )
        both = earlier.flatten()
        other, y, before, after, single = (
            both.field(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "y", "before", "after", "single")
        )
        n = len(table)
        group, other_group = (np.repeat(np.arange(n), np.diff(c.offsets.to_numpy())) for c in (later, earlier))
        self.next, self.next_group, last_group = self._links(self.doc * 2 + self.covered, self.x, group)
        # The earlier occurrences of a seed by the seed before them.
        key = other_group * (n + 1) + self._links(other, y, other_group)[2]
        order = np.argsort(key, kind="stable")
        key = key[order]
        self.other, self.y, self.other_before, self.other_after, self.single = (v[order] for v in (other, y, before, after, single))
        self.other_next, self.other_next_group, _ = self._links(self.other, self.y, other_group[order])
        self.other_next_group[self.other_next < 0] = n + 1
        # Where those of each later occurrence's seed are, but for those with the same seed before: two ranges.
        begin, end = np.searchsorted(key, group * (n + 1)), np.searchsorted(key, (group + 1) * (n + 1))
        before = group * (n + 1) + last_group
        some = last_group < n
        self.ranges = (
            (begin, np.where(some, np.searchsorted(key, before), begin)),
            (np.where(some, np.searchsorted(key, before, "right"), begin), end),
        )
        self.count = sum(b - a for a, b in self.ranges)

    @staticmethod
    def _links(doc: np.ndarray, place: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(next occurrence or -1, its seed, the seed of the one before or the number of seeds)."""
        following = _following(doc, place)
        there = np.flatnonzero(following >= 0)
        after, before = np.full(len(doc), -1), np.full(len(doc), int(group[-1]) + 1 if len(group) else 0)
        after[there] = group[following[there]]
        before[following[there]] = group[there]
        return following, after, before

    def chain_batches(self) -> Iterator[pa.RecordBatch]:
        """Chains that can make a passage."""
        for some in _batches(self.pairs()):
            begin, y, size, covered, *ends = (np.concatenate(v) for v in list(zip(*some))[2:])
            doc, other = (np.array(v) for v in list(zip(*some))[:2])
            pair = np.repeat(np.arange(len(some)), [len(p[2]) for p in some])
            runs = _Runs(pair, begin, y, size, ends)
            begin, y, size, pair = (v[~covered] for v in (begin, y, size, pair))
            along = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            x, y, pair = np.repeat(begin, size) + along, np.repeat(y, size) + along, np.repeat(pair, size)
            found = list(_chains_of(doc, other, pair, x, y))
            if not found:
                continue
            sizes = np.array([len(c[2]) for c in found])
            x, y = (np.fromiter(chain.from_iterable(c[k] for c in found), np.int64, sizes.sum()) for k in (2, 3))
            pair = np.repeat([c[4] for c in found], sizes)
            which, always, words, score, first, last = _reach(pair, x, y, np.cumsum(sizes) - sizes, runs)
            (i, j), (i_last, j_last) = (v[first] for v in runs.ends[:2]), (v[last] for v in runs.ends[2:])
            hopeful = (
                always
                | ~(self.alone[i] & self.single[j])
                | _hopeful(words, (self.before[i], self.other_before[j]), (self.after[i_last], self.other_after[j_last]), score)
            )
            keep = np.zeros(len(found), bool)
            keep[which[hopeful]] = True
            yield _chain_batch(found[k][:4] for k in np.flatnonzero(keep).tolist())

    def pairs(self) -> Iterator[tuple]:
        """Pairs whose matches can make a passage: the documents, and of each run its places, its seeds, whether a passage covers it, its ends."""
        order = np.argsort(self.doc, kind="stable")
        doc, total = self.doc[order], np.cumsum(self.count[order])
        ends = np.append(np.flatnonzero(np.diff(doc)) + 1, len(doc))
        a = 0
        while a < len(doc):
            # All later occurrences of some documents: those of a pair must come together.
            limit = (total[a - 1] if a else 0) + BLOCK_MATCHES
            b = int(ends[max(np.searchsorted(total[ends - 1], limit, "right") - 1, np.searchsorted(ends, a, "right"))])
            yield from self._possible(order[a:b])
            a = b

    def _starts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First seeds of runs of equal words: occurrences in later documents and in documents before those."""
        mine, at = [], []
        for begin, end in self.ranges:
            first, count = begin[chosen], (end - begin)[chosen]
            i, j = np.repeat(chosen, count), np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            before = self.other[j] < self.doc[i]
            mine.append(i[before])
            at.append(j[before])
        return np.concatenate(mine), np.concatenate(at)

    def _possible(self, chosen: np.ndarray) -> Iterator[tuple]:
        mine, at = self._starts(chosen)
        if not len(mine):
            return
        doc, other = self.doc[mine], self.other[at]
        low = other.min()
        order = np.argsort((doc - doc.min()) * (other.max() - low + 1) + other - low, kind="stable")
        mine, at, doc, other = (v[order] for v in (mine, at, doc, other))
        # To the end of each run, a seed at a time.
        size, last, other_last = np.ones(len(mine), np.int64), mine.copy(), at.copy()
        live, i, j = np.arange(len(mine)), mine, at
        while len(live):
            on = np.flatnonzero(self.next_group[i] == self.other_next_group[j])
            live, i, j = live[on], self.next[i[on]], self.other_next[j[on]]
            size[live] += 1
            last[live], other_last[live] = i, j
        hopeful = np.zeros(len(mine), bool)
        covered = self.covered[mine]
        runs = np.flatnonzero((size >= MIN_SEEDS) & ~covered)
        i, j, i_last, j_last = mine[runs], at[runs], last[runs], other_last[runs]
        hopeful[runs] = ~(self.alone[i] & self.single[j]) | _hopeful(
            size[runs] + K - 1, (self.before[i], self.other_before[j]), (self.after[i_last], self.other_after[j_last])
        )
        starts = np.flatnonzero((np.diff(doc, prepend=doc[0] - 1) != 0) | (np.diff(other, prepend=other[0]) != 0))
        x, y = self.x[mine].astype(np.int64), self.y[at].astype(np.int64)
        wanted = _wanted(starts, x, x + size - 1, x - y, hopeful) & ~np.logical_and.reduceat(covered, starts)
        # Runs that lie together are no more than one run of the words between their ends.
        ends = np.append(starts[1:], len(x))
        words = np.minimum(*(np.maximum.reduceat(v + size, starts) - np.minimum.reduceat(v, starts) for v in (x, y))) + K - 1
        close = np.flatnonzero(wanted & (ends - starts > 1) & (words < MIN_WORDS))
        if len(close):
            count = (ends - starts)[close]
            first = np.cumsum(count) - count
            runs = np.repeat(starts[close] - first, count) + np.arange(count.sum())
            i, j, i_last, j_last = mine[runs], at[runs], last[runs], other_last[runs]
            grows = ~(self.alone[i] & self.single[j]) | _hopeful(
                np.repeat(words[close], count), (self.before[i], self.other_before[j]), (self.after[i_last], self.other_after[j_last])
            )
            wanted[close] = np.logical_or.reduceat(grows, first)
        cuts = np.append(starts, len(x)).tolist()
        for p in np.flatnonzero(wanted).tolist():
            a, b = cuts[p], cuts[p + 1]
            yield int(doc[a]), int(other[a]), x[a:b], y[a:b], size[a:b], covered[a:b], mine[a:b], at[a:b], last[a:b], other_last[a:b]


def _earlier_chains(places: DataFrame) -> DataFrame:
    """Chains of the matches of occurrences with all places in documents before theirs; of equal texts in the first.

    A block of documents, by id, meets each block before it, so that all matches of a pair come together without
    being exchanged one by one.
    """
    low, high = F.shiftright("doc_id", EARLIER_BITS).alias("low"), F.shiftright("doc_id", LATER_BITS).alias("high")
    earlier = (
        places.filter("earlier")
        .repartition("seed")
        .groupBy("seed", low)
        .agg(F.collect_list(F.struct("doc_id", F.col("position").alias("y"), "before", "after", "single")).alias("earlier"))
    )
    later = (
        places.filter("later OR covered")
        .repartition("seed")
        .groupBy("seed", high)
        .agg(F.collect_list(F.struct("doc_id", F.col("position").alias("x"), "before", "after", "single", "covered")).alias("later"))
    )
    # Blocks take time by their matches, not their bytes: more tasks, which are not merged by bytes.
    tasks = BUCKETS * int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        later.join(earlier, "seed")
        .filter(F.shiftleft("low", EARLIER_BITS) < F.shiftleft(F.col("high") + 1, LATER_BITS))
        .select("high", "low", "later", "earlier")
        .repartition(tasks, "high", "low")
        .sortWithinPartitions("high", "low")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["high", "low"]):
            yield from _Block(rows).chain_batches()

    return blocks.mapInArrow(run, _CHAIN)


def shared_passages(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per passage of a document that an earlier document (lesser id) holds too; ends are exclusive."""
    ship(docs.sparkSession)
    chosen = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text").filter("doc_id IS NOT NULL")
    shared = _written(_shared(chosen), "shared-seeds")
    matches = shared.filter("doc_id <> other_id").select("doc_id", "other_id", F.col("position").alias("x"), "y", "differ")
    first = _linked(_first_chains(matches), chosen)
    places = _written(_places(shared, chosen, first), "places")
    second = _linked(_earlier_chains(places), chosen)
    return first.unionByName(second).withColumn(
        "identity", F.col("n_equal") / F.greatest(F.col("end_word") - F.col("start_word"), F.col("other_end") - F.col("other_start"))
    ).distinct()
