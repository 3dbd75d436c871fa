"""Quality model, token alignment and hard negatives against plain-Python versions."""

import hashlib
import random
import zlib
from collections import defaultdict
from itertools import combinations

import corpus as C
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricepanel.llm import hard_negatives as H
from pricepanel.llm import quality_model as Q
from pricepanel.llm import token_alignment as A

# -- hard negatives -------------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, place string")


def mined(rows, every=10, positives=5, negatives=10):
    """All pairs, straight from the contract; of repeated ids the least (label, vector) counts."""
    known = {}
    for vec_id, v, label, _ in rows:
        if vec_id is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [int(np.floor(256 * float(np.float32(x)))) for x in v])
        known[vec_id] = min(known.get(vec_id, row), row)
    out = set()
    for a, (label, v) in known.items():
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in known.items() if i != a]
        for s, p, _ in sorted(r for r in scored if r[2] == label)[:positives]:
            fits = sorted(r for r in scored if r[2] != label and -30 * s <= -100 * r[0] <= -90 * s)
            out |= {(a, p, rank, i, -s, -n) for rank, (n, i, _) in enumerate(fits[:negatives], 1)}
    return out


def messy_vectors(n=260, dim=6):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-0.2, 1) for _ in range(dim)], rng.randint(0, 3), "x") for i in range(n)]
    rows += [(i + n, rows[i][1], rng.randint(0, 3), None) for i in range(60)]  # ties of scores
    rows += [rows[5], rows[5], (20, [0.5] * dim, 0, "again"), (30, [0.1, 0.9], 1, "short"), (40, [], 2, "empty")]
    rows += [(None, [1.0] * dim, 1, "x"), (1001, None, 1, "x"), (1002, [1.0] * dim, None, "x")]
    rows += [(1003, [None] + [1.0] * (dim - 1), 1, "x"), (1004, [float("nan")] * dim, 1, "x")]
    rows += [(1010, [float("inf")] * dim, 1, "x"), (1020, [0.0] * dim, 1, "zero"), (1030, [-1.0] * dim, 3, "below")]
    return rows


def test_hard_negatives_are_those_of_all_pairs(spark, monkeypatch):
    rows = messy_vectors()
    monkeypatch.setattr(H, "CHUNK_ROWS", 40)
    monkeypatch.setattr(H, "BLOCK_ROWS", 7)
    monkeypatch.setattr(H, "ROUND_BLOCKS", 2)  # several rounds
    found = H.mine(vectors(spark, rows).repartition(5), F.col("id") % 10 == 0)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == mined(rows)


def test_a_label_of_most_rows_and_negative_scores(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)], 7 if i % 3 else i % 5, "x") for i in range(300)]
    assert {tuple(r) for r in H.mine(vectors(spark, rows), F.col("id") % 10 == 0).collect()} == mined(rows)


def test_hard_negatives_of_nothing_and_of_wide_numbers(spark):
    assert H.mine(vectors(spark, []), F.col("id") % 10 == 0).count() == 0
    assert H.mine(vectors(spark, [(3, [1.0], 1, "x")]), F.col("id") % 10 == 0).count() == 0
    big = np.array([[1 << 28, 3]]), np.array([[1 << 27, 5], [-1, 1]])
    assert H.scores(*big).tolist() == [[(1 << 55) + 15, 3 - (1 << 28)]]
    with pytest.raises(ValueError):
        H.scores(np.array([[1 << 40]]), np.array([[1 << 40]]))


# -- token alignment ------------------------------------------------------------------------------------------


def bytes_of(pair, text):
    """Ids and end offsets by the plain tokenizers over the whole text."""
    a, b = pair._a.encode(" " + text, add_special_tokens=False).ids, pair._b.encode(text)
    ends = [np.cumsum([len(t[i]) for i in ids]).tolist() for ids, t in ((a, pair._a_bytes), (b, pair._b_bytes))]
    raw = (" " + text).encode()
    same = all(b"".join(t[i] for i in ids) == raw for ids, t in ((a, pair._a_bytes), (b, pair._b_bytes)))
    return (a, b, *ends) if text and same else ([], [], [], [])


def aligned(texts):
    """The contract's columns in plain Python, by looking at every common end."""
    pair = A.tokenizers(*A.default_paths())
    held, per = defaultdict(int), []
    for text in texts:
        a, b, x, y = bytes_of(pair, text or "")
        linked, i, j = [], 0, 0
        while i < len(a):
            linked.append((a[i], b[j]))
            i, j = i + (x[i] <= y[j]), j + (y[j] <= x[i])
        cut, i, j = [], 0, 0
        place_a, place_b = ({end: k + 1 for k, end in enumerate(side)} for side in (x, y))
        for end in sorted(set(x) & set(y)):
            p, q = place_a[end], place_b[end]
            cut.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            i, j = p, q
        for one in set(linked):
            held[one] += 1
        per.append((len(a), len(b), len(cut), linked, hashlib.sha256(";".join(cut).encode()).hexdigest() if a else ""))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return [
        (n_a, n_b, n_g, len(l), sum(held[p] == top[p[0]] for p in l), sum(held[p] for p in l), d)
        for n_a, n_b, n_g, l, d in per
    ]


def awkward_texts():
    rng = random.Random(1)
    signs = list("abcXYZ 019.,'!?  \n\t\x0b\x1c\x85\xa0éİΣß▁— 　​﻿ﬁÅ日本😀\x00<>|")
    signs += ["<|endoftext|>", "<s>", "</s>", "<0x0A>", "'ll", "'S"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(1500)]


def test_cached_words_give_the_ids_of_whole_texts():
    pair = A.tokenizers(*A.default_paths())
    texts = awkward_texts() + [C.prose(random.Random(2), 4000), "x" * 5000, " lead and trail ", "a▁b", None]
    for _ in range(2):
        a, b, pieces, a_each, b_each = pair.ids(texts)
        row = np.repeat(np.arange(len(texts)), pieces)
        n_a, n_b = (np.bincount(row, each, len(texts)).astype(int) for each in (a_each, b_each))
        stops = zip(np.cumsum(n_a), np.cumsum(n_b), n_a, n_b)
        for text, (x, y, n, m) in zip(texts, stops):
            assert (a[x - n : x].tolist(), b[y - m : y].tolist()) == bytes_of(pair, text or "")[:2], text


@pytest.mark.parametrize("seed", range(30))
def test_run_skipping_finds_all_common_ends(seed):
    rng = random.Random(seed)
    every = sorted(rng.sample(range(1, 3000), 900)) + [3000]
    share = rng.choice([0.02, 0.2, 0.5])
    a, b = ([e for e in every if e == 3000 or rng.random() > share] for _ in range(2))
    if seed % 3 == 0:  # long one-to-one stretches with a few breaks
        a = every
        b = [e for e in every if e % 97 or e == 3000]
    x, y = A.groups(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in x] == common == [b[j - 1] for j in y]


def test_alignment_of_messy_rows(spark, monkeypatch):
    monkeypatch.setattr(A, "SLICE_BYTES", 2000)
    monkeypatch.setattr(A, "WORK_BYTES", 500)
    rows = C.messy_rows()
    found = A.digest(C.messy(spark)).collect()
    got = sorted(tuple(-1 if v is None else v for v in r) for r in found)
    want = aligned([r[1] for r in rows])
    assert got == sorted((-1 if r[0] is None else r[0], *w) for r, w in zip(rows, want))


def test_alignment_of_awkward_texts_and_of_nothing(spark):
    texts = awkward_texts()[:400]
    found = {r["doc_id"]: tuple(r)[1:] for r in A.digest(C.plain(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == aligned(texts)
    assert A.digest(C.none(spark)).count() == 0
    assert [tuple(r)[1:] for r in A.digest(C.plain(spark, [None, ""])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_links_cross_the_network_packed(spark):
    rng = random.Random(6)
    texts = [C.prose(rng, 1500) for _ in range(40)] + ["of the " * 40_000, None, "x"]
    docs = C.plain(spark, texts)
    found = {r["doc_id"]: tuple(r)[1:] for r in A.digest(docs).collect()}
    assert [found[i] for i in range(len(texts))] == aligned(texts)
    written = A.slices(docs, "text", "doc_id", A.default_paths()).collect()
    # Four bytes a link, as they were before, make rows that take hundreds of MB of an executor.
    assert sum(len(r["links"]) for r in written) < sum(sum(r["n_links"]) for r in written) / 4
    assert sum(len(r["held"]) for r in written) == len(texts)


@pytest.mark.parametrize("size", [0, 1, 300])
def test_packed_numbers_come_back(size):
    rng = np.random.default_rng(size)
    columns = [rng.integers(-(2**31), 2**31, size), np.arange(size)]
    got = A._unpacked(pa.py_buffer(A._packed(*columns)), 2, size)
    assert got.shape == (2, size) and all((x == y).all() for x, y in zip(got, columns))


# -- quality model --------------------------------------------------------------------------------------------


def test_statistics_against_plain_python():
    text = "One two two.\nOne two two.\n\nABC 12 ## #x fin!"
    x = dict(zip(Q.FEATURES, Q.features(pa.array(["", text, None, "alone"]))[1]))
    words = text.split()
    share = lambda a, b: np.arcsin(np.sqrt(a / b))
    visible = sum(map(len, words))
    assert np.isclose(x["log words"], np.log1p(len(words)))
    assert np.isclose(x["log word length"], np.log1p(np.mean([len(w) for w in words])))
    assert np.isclose(x["spread of word length"], np.log1p(np.std([len(w) for w in words])))
    assert np.isclose(x["upper-case letters"], share(5, sum(c.isalpha() for c in text)))
    assert np.isclose(x["digits"], share(2, visible))
    assert np.isclose(x["symbols"], share(3, visible))
    assert np.isclose(x["line ends a word"], share(3, len(words)))
    for n, name in ((2, "repeated pairs of words"), (3, "repeated triples of words")):
        runs = list(zip(*[words[i:] for i in range(n)]))
        assert np.isclose(x[name], share(len(runs) - len(set(runs)), len(runs)))
    assert np.isclose(x["repeated lines"], share(1, 3))
    assert np.isclose(x["distinct words"], np.log1p(len(words)) - np.log1p(len(set(words))))
    assert np.isclose(x["words ending in a sentence end"], share(3, len(words)))
    assert np.isclose(x["words without letters"], share(2, len(words)))


def quality_corpus(spark, n=600):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        words = C.prose(rng, rng.randint(30, 200), rng.choice(["en", "fr"])).split(" ")
        good = i % 4 != 0
        text = " ".join(words) if good else rng.choice([" ".join(w + "###" for w in words), " ".join(words).upper() + "!!", " ".join(words[:3] * 40)])
        rows.append((i, text, None, None, len(text)))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int")


def test_densities_and_held_out_documents(spark):
    docs, labels = quality_corpus(spark)
    learns = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    measured = Q.measure(docs)
    model = Q.fit(measured, labels.filter(learns))
    # The moments and log-densities, from all rows in one place.
    x = {r["doc_id"]: np.array(r["x"]) for r in measured.collect()}
    kept = {c: np.array([x[i] for i in x if zlib.crc32(str(i).encode()) % 5 and (i % 4 != 0) == c]) for c in (0, 1)}
    n = sum(map(len, kept.values()))
    pooled = sum(((v - v.mean(0)) ** 2).sum(0) for v in kept.values()) / n
    every = np.array([x[i] for i in sorted(x)])
    logs = []
    for c in (0, 1):
        s = 0.9 * np.cov(kept[c].T, bias=True) + 0.1 * np.diag(np.maximum(pooled, Q.FLOOR))
        d = every - kept[c].mean(0)
        logs.append(np.log(len(kept[c]) / n) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,ij->i", d @ np.linalg.inv(s), d))
    assert np.allclose(model.log_odds(every), logs[1] - logs[0], rtol=1e-6, atol=1e-6)
    found = {r["doc_id"]: r for r in Q.rate(docs, labels, learns).collect()}
    held = [i for i in found if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([found[i]["predicted"] == int(i % 4 != 0) for i in held]) > 0.95
    pairs = [(found[i]["score"], found[j]["score"]) for i, j in combinations(held, 2) if i % 4 == 0 and j % 4]
    assert np.mean([a < b for a, b in pairs]) > 0.97


def test_quality_of_messy_rows_and_missing_labels(spark):
    learns = F.lit(True)
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = C.messy_rows()
    scored = Q.rate(C.messy(spark), none, learns).collect()
    assert len(scored) == len(rows) and {r["score"] for r in scored} == {0.5}
    labels = [(i, i % 2) for i in range(20)] + [(3, 1), (None, 1), (5, None), (6, 9)]
    scored = Q.rate(C.messy(spark), spark.createDataFrame(labels, "doc_id long, quality int"), learns).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 for r in scored)
    assert {r["predicted"] for r in scored} <= {0, 1}
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert {r["score"] for r in Q.rate(C.messy(spark), one, learns).collect()} == {1.0}
    assert Q.rate(C.none(spark), one, learns).count() == 0
