"""Operators that compare documents: line dedup, SimHash links, shared passages; and components."""

import random
from collections import Counter, defaultdict

import corpus
import numpy as np
import pyarrow as pa
import xxhash

from pricepanel.llm import line_dedup, passages, simhash
from pricepanel.llm.columns import ALNUM, VISIBLE, Runs, Words
from pricepanel.llm.components import components


def test_words_and_run_hashes_do_not_depend_on_place():
    texts = ["b a c", None, "", "x b a c", "a", "é a\tb", "b\x0ba\x0cc"]
    words = Words(pa.array(texts, pa.string()).slice(0), VISIBLE)
    got = [[words.word(i).decode() for i in range(a, b)] for a, b in zip(words.first, words.first[1:])]
    assert got == [corpus.VISIBLE.findall(t or "") for t in texts]
    hashes = words.hashes()
    names = [words.word(i) for i in range(len(hashes))]
    assert all((a == b) == (h == g) for a, h in zip(names, hashes) for b, g in zip(names, hashes))
    runs = Runs(hashes)
    a, b = runs.of(np.array([0]), np.array([3])), runs.of(np.array([4]), np.array([7]))
    assert a == b and runs.without(np.array([0]), np.array([3]), np.array([1])) == Runs(hashes[[0, 2]]).of(np.array([0]), np.array([2]))
    sliced = Words(pa.array(["zz", "Ab-c", "d"], pa.string()).slice(1, 2), ALNUM, lower=True)
    assert [sliced.word(i) for i in range(len(sliced.start))] == [b"ab", b"c", b"d"]


def removed(rows):
    """Lines that an earlier line equals, or is one word edit from, by the definition."""
    lines = []
    for doc_id, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            words = corpus.VISIBLE.findall(line)
            if words:
                lines.append(((2**63 - 1 if doc_id is None else doc_id, k), words))
    out = set()
    for at, a in lines:
        for other, b in lines:
            if other < at and (a == b or (min(len(a), len(b)) >= 5 and line_dedup.within_one_edit(a, b))):
                out.add(at)
                break
    return out


def expected_texts(rows):
    gone = removed(rows)
    out = []
    for doc_id, text in rows:
        key = 2**63 - 1 if doc_id is None else doc_id
        kept = [s for k, s in enumerate((text or "").split("\n")) if (key, k) not in gone]
        out.append((doc_id, None if text is None else "\n".join(kept)))
    return Counter(out)


def test_line_dedup_on_small_lines(spark):
    rng = random.Random(11)
    words = ["a", "b", "c", "d"]
    texts = ["\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 7))) for _ in range(6)) for _ in range(60)]
    docs = corpus.plain(spark, texts)
    found = line_dedup.deduplicate(docs)
    assert Counter((r["doc_id"], r["text"]) for r in found.collect()) == expected_texts(list(enumerate(texts)))


def test_line_dedup_on_messy_rows(spark):
    rows = [r for r in corpus.messy_rows() if r[0] != 17]
    extra = "a1 a2 a3 a4 a5 a6"
    more = [(100, f"{extra}\n{extra} a7\nb {extra}", "en", "s", 1), (101, f"a1 a2 a3 XX a5 a6\nshort line\n{extra}", "en", "s", 1), (102, "short line", "en", "s", 1)]
    rows += [(*r, *["c"] * len(corpus.CLASHES)) for r in more]
    docs = spark.createDataFrame(rows, corpus.SCHEMA).repartition(3)
    found = line_dedup.deduplicate(docs, counts=False)
    assert found.columns == docs.columns
    pairs = [r[:2] for r in rows]
    want = expected_texts(pairs)
    got = Counter((r["doc_id"], r["text"]) for r in found.collect())
    assert got == want
    assert {r["text"] for r in found.filter("doc_id = 102").collect()} == {""}
    assert line_dedup.deduplicate(docs, counts=False, keep_emptied=False).filter("doc_id = 102").count() == 0
    assert line_dedup.deduplicate(corpus.none(spark)).count() == 0


def fingerprint(text):
    words = corpus.VISIBLE.findall(corpus.fold(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(prints):
    """Least id of every id's component, over (id, fingerprint)."""
    parent = {i: i for i, _ in prints}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in prints:
        for j, b in prints:
            if bin(a ^ b).count("1") <= 2:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_simhash_on_messy_rows(spark):
    rows = corpus.messy_rows()
    found = simhash.near_duplicates(corpus.messy(spark)).collect()
    prints = [(r[0], fingerprint(r[1])) for r in rows]
    root = joined([p for p in prints if p[0] is not None])
    # Rows that share an id have a fingerprint each; both links count for the id.
    got = Counter((r["doc_id"], r["fp"] % 2**64) for r in found)
    assert got == Counter(prints)
    alone = Counter(r[0] for r in rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None
        elif alone[r["doc_id"]] == 1 and r["doc_id"] != 7:
            assert r["component_id"] == root[r["doc_id"]]
    assert simhash.near_duplicates(corpus.none(spark)).count() == 0
    kept = simhash.representatives(corpus.messy(spark))
    assert kept.columns == corpus.messy(spark).columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[None] == 2 and max(n for d, n in ids.items() if d is not None) == 1


def test_simhash_links_in_sparse_and_crowded_cells(spark):
    rng = random.Random(4)
    prints = []
    for size in (1, 2, 3, 5, 60, 150):
        center = rng.getrandbits(64)
        for _ in range(size):
            value = center
            for _ in range(rng.randint(0, 3)):
                value ^= 1 << rng.randrange(64)
            prints.append(value)
    prints = sorted(set(prints + [0, 1 << 63, 2**64 - 1, (1 << 63) | 1]))
    rng.shuffle(prints)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(signed, "node long, fp long")
    linked = components(simhash.links(nodes), "a", "b").collect()
    got = {i: i for i, _ in signed} | {r["node"]: r["component"] for r in linked}
    assert got == joined(list(enumerate(prints)))


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    edges += edges[:7]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long"), "b", "a")
    got = {r["node"]: r["component"] for r in found.collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)}}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_chains_have_the_best_score():
    rng = random.Random(6)
    for _ in range(40):
        n = rng.randint(1, 12)
        x, y = [rng.randint(0, 60) for _ in range(n)], [rng.randint(0, 60) for _ in range(n)]

        def value(chain):
            steps = zip(chain, chain[1:])
            return passages.K * len(chain) - sum(passages.GAP_COST * (x[b] - x[a] + y[b] - y[a] - 2 * passages.K) for a, b in steps)

        best = 0
        for mask in range(1, 1 << n):
            chain = sorted((i for i in range(n) if mask >> i & 1), key=lambda i: x[i])
            if all(x[a] < x[b] and y[a] < y[b] for a, b in zip(chain, chain[1:])):
                best = max(best, value(chain))
        found = passages.chains(x, y)
        for chain in found:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(chain, chain[1:]))
        if found:
            assert abs(max(map(value, found)) - best) < 1e-9


def test_shared_passages(spark):
    rng = random.Random(8)
    flat = lambda n: corpus.prose(rng, n).replace("\n", " ")
    exact, fuzzy, looped = flat(55), flat(120), " ".join(["go", "on", "now"] * 60)
    texts = [
        flat(200) + " " + exact + " " + flat(100),
        exact + " " + flat(80),
        flat(90) + " " + exact.upper() + "!",
        flat(50) + " " + fuzzy + " " + flat(60),
        flat(300) + " " + corpus.edited(rng, fuzzy, 15) + " " + flat(10),
        looped,
        looped,
        flat(3000),
        flat(30),
        None,
        "",
    ]
    found = passages.shared_passages(corpus.plain(spark, texts)).collect()
    pairs = {(r["doc_id"], r["other_doc_id"]) for r in found}
    assert pairs == {(1, 0), (2, 0), (4, 3), (6, 5)}
    words = [corpus.ALNUM.findall(corpus.fold(t)) for t in texts]
    for r in found:
        a = words[r["doc_id"]][r["start_word"] : r["end_word"]]
        b = words[r["other_doc_id"]][r["other_start"] : r["other_end"]]
        assert r["identity"] >= 0.8 and min(len(a), len(b)) >= passages.MIN_WORDS
        if r["identity"] == 1:
            assert a == b
    sizes = {(r["doc_id"], r["other_doc_id"]): r["end_word"] - r["start_word"] for r in found}
    assert sizes[1, 0] == sizes[2, 0] == 55 and sizes[4, 3] >= 110 and sizes[6, 5] == 180


def test_shared_passages_on_messy_rows(spark):
    found = passages.shared_passages(corpus.messy(spark)).collect()
    pairs = {(r["doc_id"], r["other_doc_id"]) for r in found}
    assert {(8, 0), (9, 0), (10, 1), (11, 3), (13, 12)} <= pairs
    assert not {17, 18, 15, 16, 19, 20} & {d for p in pairs for d in p}
    assert all(r["doc_id"] is not None for r in found)
    assert passages.shared_passages(corpus.none(spark)).count() == 0


def test_every_equal_run_holds_a_common_seed():
    rng = random.Random(12)
    words = [corpus.prose(rng, 1).strip(".") for _ in range(400)]
    shared = words[:16]
    a, b = " ".join(words[100:160] + shared + words[200:230]), " ".join(words[300:303] + shared)
    row, position, h = passages.seeds(pa.array([a, b, "one two", None]))
    by_row = defaultdict(set)
    for r, x in zip(row.tolist(), h.tolist()):
        by_row[r].add(x)
    assert by_row[0] & by_row[1] and not by_row[2]


def test_short_fuzzy_passages_are_found(spark):
    """Passages of 40 to 60 words with 80 to 85 % equal words, against brute force at the planted offset."""
    rng = random.Random(14)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    flat = lambda n: [word() for _ in range(n)]
    texts, planted = [], 0
    for i in range(400):
        size, share = rng.choice([40, 50, 60]), rng.choice([0.8, 0.85])
        passage = flat(size)
        other = list(passage)
        # The ends stay equal, so that the passage has its size.
        for at in rng.sample(range(1, size - 1), int(size * (1 - share) + 1e-9)):
            other[at] = word()
        runs = [all(a == b for a, b in zip(passage[p : p + 5], other[p : p + 5])) for p in range(size - 4)]
        planted += sum(runs) >= 2
        texts += [" ".join(flat(50) + passage + flat(50)), " ".join(flat(70) + other + flat(30))]
    found = {(r["doc_id"], r["other_doc_id"]) for r in passages.shared_passages(corpus.plain(spark, texts)).collect()}
    assert found <= {(2 * i + 1, 2 * i) for i in range(400)}
    print("found", len(found), "of 400; with two common seeds", planted)
    assert planted >= 395 and len(found) >= 0.98 * planted


def test_shared_passage_whose_seeds_occur_alone_before(spark):
    rng = random.Random(15)
    flat = lambda n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]
    passage = flat(60)
    alone = [[*flat(20), *passage[i : i + 5], *flat(20)] for i in range(56)]
    # B and C, next to each other, and with chance occurrences of all seeds before and between them.
    for docs, b, c in (([*alone, flat(40) + passage, passage + flat(40)], 56, 57), ([*alone, flat(40) + passage, *alone, passage + flat(40)], 56, 113)):
        found = passages.shared_passages(corpus.plain(spark, [" ".join(d) for d in docs])).collect()
        spans = {(r["doc_id"], r["other_doc_id"]): (r["start_word"], r["end_word"], r["other_start"], r["other_end"]) for r in found}
        assert spans[c, b] == (0, 60, 40, 100)


def test_shared_passage_beyond_many_documents_with_its_seeds(spark, monkeypatch):
    """Sixty documents between the two hold parts of the passage, each 30 words of 60: no passages themselves."""
    rng = random.Random(16)
    flat = lambda n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]
    passage = flat(60)
    parts = [[*flat(20), *passage[i : i + 30], *flat(20)] for i in (0, 30, 15) * 20]
    docs = [" ".join(d) for d in [*parts, flat(40) + passage, *parts, passage + flat(40)]]
    monkeypatch.setattr(passages, "BLOCK_MATCHES", 100)
    # Ids in blocks far apart, and below zero.
    for ids in (range(len(docs)), [i * 30_011 - 900_000 for i in range(len(docs))]):
        rows = spark.createDataFrame(list(zip(ids, docs)), "doc_id long, text string")
        found = passages.shared_passages(rows).collect()
        spans = {(r["doc_id"], r["other_doc_id"]): (r["start_word"], r["end_word"], r["other_start"], r["other_end"]) for r in found}
        assert spans[ids[-1], ids[60]] == (0, 60, 40, 100)


def test_shared_passage_after_its_parts_in_the_same_document(spark):
    """The earlier document holds parts of the passage, 30 words of 60, before the passage itself."""
    rng = random.Random(17)
    flat = lambda n: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]
    passage = flat(60)
    parts = [w for i in (0, 30, 15) for w in (*flat(150), *passage[i : i + 30])]
    docs = [" ".join(d) for d in (parts + flat(150) + passage, flat(10) + passage)]
    found = passages.shared_passages(corpus.plain(spark, docs)).collect()
    assert [(r["start_word"], r["end_word"], r["other_start"], r["other_end"]) for r in found] == [(10, 70, 690, 750)]


def test_runs_that_are_dropped_are_no_passages():
    """Runs of equal words in otherwise different words, at the limits: what a chain of the run alone aligns to."""
    rng = random.Random(18)
    kept = dropped = 0
    for _ in range(4000):
        size = rng.randint(6, 45)
        a = np.arange(1, 301, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        b = a.copy()
        b[:100] += np.uint64(1 << 57)
        b[100 + size :] += np.uint64(1 << 57)
        for step, at in ((-1, 99), (1, 100 + size)):
            # Next to the run up to 4 equal words after each one or two different ones, for some way.
            most = rng.choice([0, 1, 4, 4])
            for _ in range(rng.choice([0, 1, 3, 5, 7, 9])):
                at += step * rng.choice([1, 1, 1, 2])
                for _ in range(rng.choice([most, most, most, 3, 1])):
                    b[at] = a[at]
                    at += step
        words = passages.Words(pa.array([" ".join(["w"] * 300)]), ALNUM)
        row, first, last = np.array([0]), np.array([100]), np.array([100 + size - passages.K])
        sides = [[passages._beside(words, h, row, p)[side] for h in (a, b)] for side, p in ((0, first), (1, last))]
        hopeful = passages._hopeful(np.array([size]), *sides)[0]
        seeds = [100, 100 + size - passages.K]
        found = passages.align(a[100 - 96 : 100 + size + 96], b[100 - 96 : 100 + size + 96], [96, 96 + seeds[1] - 100], [96, 96 + seeds[1] - 100])
        assert hopeful or not found
        kept, dropped = kept + bool(found), dropped + (not hopeful)
    assert kept > 200 and dropped > 200


def test_seeds_are_packed_and_come_back(spark):
    """A seed takes 14 bytes at most between the tasks, with its hash, document, place and neighbours."""
    rng = random.Random(19)
    texts = [corpus.prose(rng, rng.choice([0, 3, 4, 5, 6, 40, 900])) for _ in range(200)] + ["go on now " * 200, None]
    ids = [i * 7 - 300 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(1)
    row, position, h = passages.seeds(pa.array(texts))
    want = Counter(((int(x) >> 48) * 24 >> 16, ids[r], p, int(x) & (1 << 48) - 1) for r, p, x in zip(row.tolist(), position.tolist(), h))
    rows = passages._dealt(docs, 24).toArrow().to_batches()
    got = Counter()
    for batch in rows:
        for i in range(batch.num_rows):
            doc, at, tail, near = passages._unpacked([batch.slice(i, 1)])
            got += Counter(zip([batch.column("bucket")[i].as_py()] * len(doc), doc.tolist(), at.tolist(), tail.tolist()))
            assert len(near) == len(doc)
    assert got == want
    size = sum(len(batch.column(c)[i].as_py()) for batch in rows for c in ("hash", "beside") for i in range(batch.num_rows))
    steps = sum(len(bytes(batch.column("step")[i].as_py()).strip(b"\0")) for batch in rows for i in range(batch.num_rows))
    assert size == 10 * len(h) and size + steps <= 14 * len(h)


def test_runs_are_looked_at_once_and_whole():
    """A phrase of 12 words in 30 documents, and a loop: one start for two holders of the phrase; all matches by brute force."""
    rng = random.Random(20)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    phrase = [word() for _ in range(12)]
    docs = [[word() for _ in range(30)] + phrase + [word() for _ in range(30)] for _ in range(30)] + [["go", "on"] * 8, ["on", "go"] * 7 + ["x"]]
    places = defaultdict(list)
    for d, words in enumerate(docs):
        for p in range(len(words) - passages.K + 1):
            places[tuple(words[p : p + passages.K])].append((d, p))
    shared = [v for v in places.values() if len({d for d, _ in v}) > 1]
    side = {"before": 0, "after": 0}
    later = [[{"doc_id": d, "x": p, **side, "single": False, "covered": False} for d, p in v] for v in shared]
    earlier = [[{"doc_id": d, "y": p, **side, "single": True} for d, p in v] for v in shared]
    block = passages._Block([pa.RecordBatch.from_pydict({"later": later, "earlier": earlier})])
    mine, at = block._starts(np.argsort(block.doc, kind="stable"))
    assert sum(block.doc[mine] < 30) == 30 * 29 // 2
    got = Counter()
    for doc, other, begin, y, size, *_ in block.pairs():
        got += Counter((doc, other, b + k, a + k) for b, a, n in zip(begin.tolist(), y.tolist(), size.tolist()) for k in range(n))
    assert got == Counter((d, e, p, q) for v in shared for d, p in v for e, q in v if e < d)


def test_exchanges_are_removed_when_a_table_is_written(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(passages, "saved", lambda df, label: asked.append(spark.conf.get(passages.CLEANUP)) or df)
    before = spark.conf.get(passages.CLEANUP, None)
    passages._written(spark.range(3), "rows")
    assert asked == ["true"] and spark.conf.get(passages.CLEANUP, None) == before


# -- chains that go on to texts ---------------------------------------------------------------------------------


def block_of(a, b):
    """A block of one later and one earlier document, both of words, and the word hashes of each."""
    sides = []
    for text in (" ".join(a), " ".join(b)):
        words = Words(pa.array([text]), ALNUM, lower=True)
        hashes = words.hashes()
        row, position, h = passages._seeds(words, hashes)
        plain = np.flatnonzero(h & np.uint64(1))
        before, after = passages._beside(words, hashes, row[plain], position[plain])
        sides.append((hashes, list(zip(h[plain].tolist(), position[plain].tolist(), before.tolist(), after.tolist()))))
    seeds = sorted({r[0] for r in sides[0][1]} & {r[0] for r in sides[1][1]})
    later = [[dict(doc_id=1, x=x, before=p, after=q, single=True, covered=False) for h, x, p, q in sides[0][1] if h == s] for s in seeds]
    earlier = [[dict(doc_id=0, y=y, before=p, after=q, single=True) for h, y, p, q in sides[1][1] if h == s] for s in seeds]
    place = lambda c: [(k, pa.int32() if k in ("x", "y") else pa.bool_() if k in ("single", "covered") else pa.int64()) for k in c]
    kinds = [pa.list_(pa.struct(place(c))) for c in (("doc_id", "x", "before", "after", "single", "covered"), ("doc_id", "y", "before", "after", "single"))]
    rows = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip((later, earlier), kinds)], names=["later", "earlier"])
    return [rows], sides[0][0], sides[1][0]


def around(hashes, at):
    begin = max(at[0] - passages.MARGIN, 0)
    return hashes[begin : at[-1] + passages.K + passages.MARGIN], [p - begin for p in at], begin


def aligned_chains(a, b, found):
    out = set()
    for x, y in found:
        (mine, x, i), (other, y, j) = around(a, x), around(b, y)
        out |= {(p + i, q + i, r + j, s + j, equal) for p, q, r, s, equal in passages.align(mine, other, x, y)}
    return out


def kept_and_all(a, b):
    """Chains that go on to texts and all chains of two documents, and the word hashes of these."""
    rows, one, two = block_of(a, b)
    kept = [(x, y) for c in passages._Block(rows).chain_batches() for x, y in zip(c["x"].to_pylist(), c["y"].to_pylist())]
    group = rows[0].to_pylist()
    both = np.array([(p["x"], q["y"]) for r in group for p in r["later"] for q in r["earlier"]], np.int64).reshape(-1, 2)
    zero = np.zeros(1, np.int64)
    every = [c[2:4] for c in passages._chains_of(zero + 1, zero, np.zeros(len(both), np.int64), both[:, 0], both[:, 1])]
    return kept, every, one, two


def test_chains_that_do_not_go_on_make_no_passage():
    rng = random.Random(12)
    word = lambda: rng.choice(["ha", "the", "of", "on", *(f"w{i}" for i in range(40))])
    n_kept = n_every = n_found = 0
    for _ in range(300):
        shared = [word() for _ in range(rng.randint(20, 160))]
        sides = []
        for _ in range(2):
            body = []
            for w in shared:
                change = rng.random() * 8
                body += [] if change < 0.25 else [word()] if change < 1 else [w, word()] if change < 1.25 else [w]
            loops = [[rng.choice(["ha", "the"])] * rng.randint(5, 60) for _ in range(2)]
            prose = lambda: [f"x{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))]
            sides.append([*prose(), *loops[0], *prose(), *body, *loops[1], *prose()])
        kept, every, a, b = kept_and_all(*sides)
        n_kept, n_every = n_kept + len(kept), n_every + len(every)
        want = aligned_chains(a, b, every)
        n_found += len(want)
        assert aligned_chains(a, b, kept) == want
    print("chains", n_every, "kept", n_kept, "passages", n_found)
    assert n_found > 200 and n_kept < n_every / 5  # by the words of a chain's ends alone, more than a quarter


def test_chains_across_loops_do_not_go_on():
    """A chain that goes on by 5 words of one loop for 1 word of another has a fifth of its words equal."""
    rng = random.Random(13)
    prose = lambda n: [f"x{rng.randrange(10**6)}" for _ in range(n)]
    sides = [[*prose(50), *["ha"] * n, *prose(m), *["the"] * 9, *prose(50)] for n, m in ((200, 30), (35, 8))]
    kept, every, a, b = kept_and_all(*sides)
    assert len(every) > 5 and not aligned_chains(a, b, every)
    assert not kept


def test_matches_of_many_pairs_are_thinned_like_those_of_one():
    rng = np.random.default_rng(5)
    pair = np.repeat(np.arange(30), 80)
    x, y = rng.integers(0, 25, len(pair)), rng.integers(0, 25, len(pair))
    for p in range(0, 30, 3):  # a long run among them
        x[pair == p], y[pair == p] = np.arange(80) // 2 + 5, np.arange(80) // 2 + 9
    got = list(zip(*(v.tolist() for v in passages._thinned(pair, x, y))))
    assert got == [(p, *m) for p in range(30) for m in zip(*(v.tolist() for v in passages.thinned(x[pair == p], y[pair == p])))]
