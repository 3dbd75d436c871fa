"""Language spans, main text of pages, and the whole pipeline."""

import importlib.util
import os
import random
import zlib
from collections import Counter, defaultdict
from xml.etree import ElementTree

import corpus
import numpy as np
import pytest
from test_across_documents import expected_texts, fingerprint, joined
from test_single_documents import decontamination, whole

from pricepanel.llm import language, templates

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def best_labels(scores, switch):
    """Plain Viterbi over one text."""
    n, k = scores.shape
    best, back = [list(map(float, scores[0]))], []
    for t in range(1, n):
        step, row = [], []
        for j in range(k):
            options = [best[-1][i] - (switch if i != j else 0) for i in range(k)]
            i = max(range(k), key=lambda i: (options[i], i == j, -i))
            step.append(i)
            row.append(options[i] + float(scores[t, j]))
        best.append(row)
        back.append(step)
    path = [int(np.argmax(best[-1]))]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1], max(best[-1])


def test_viterbi_side_by_side_is_the_best_path():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 5, 30, 2, 0, 17]
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(0, 4, (first[-1], 3)).round(3)
    labels = language.viterbi(scores, first, 3.0)
    for a, b in zip(first, first[1:]):
        if b > a:
            path, best = best_labels(scores[a:b], 3.0)
            mine = labels[a:b]
            value = scores[np.arange(a, b), mine].sum() - 3.0 * (np.diff(mine) != 0).sum()
            assert abs(value - best) < 1e-9 and mine.tolist() == path
    assert len(language.viterbi(np.zeros((0, 3)), np.zeros(1, np.int64))) == 0


def labelled(spark, n=120):
    rng = random.Random(21)
    langs = ["en", "fr", "ru"]
    rows = [(i, corpus.prose(rng, 30 + i % 50, langs[i % 3]), langs[i % 3]) for i in range(n)]
    rows += [(n, None, "en"), (n + 1, "12 34 !!", "en"), (n + 2, rows[0][1], None), (None, rows[1][1], "fr")]
    english = corpus.prose(rng, 40, "en")
    rows.append((n + 3, english + " " + corpus.prose(rng, 80, "fr"), None))
    rows.append((n + 4, corpus.prose(rng, 3000, "ru"), None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string"), n, len(english)


def test_language_of_held_out_documents_and_of_spans(spark):
    docs, n, border = labelled(spark)
    model = language.train(docs)
    assert model.languages == ["en", "fr", "ru"]
    found = {r["doc_id"]: r for r in language.predict(docs, model).collect()}
    for i in range(n):
        r = found[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r["lang_pred"] == ["en", "fr", "ru"][i % 3] and 0 <= r["score"] <= 1
    assert (found[n]["lang_pred"], found[n]["score"]) == ("und", 0.0) and found[n + 1]["lang_pred"] == "und"
    assert found[n + 4]["lang_pred"] == "ru" and found[n + 4]["score"] == 1
    spans = found[n + 3]["spans"]
    assert [s["lang"] for s in spans] == ["en", "fr"]
    assert spans[0]["start"] == 0 and spans[-1]["end"] > border
    # The labels change where the language does, give or take a word that both have.
    assert spans[0]["end"] <= spans[1]["start"]
    assert max(abs(spans[0]["end"] - border), abs(spans[1]["start"] - border)) <= 12, (spans, border)
    kept = language.accepted(docs, model, 0.5)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, r in found.items() if r["lang_pred"] != "und")


def test_language_on_messy_rows_and_without_labels(spark):
    model = language.train(corpus.messy(spark))
    found = language.predict(corpus.messy(spark), model)
    assert found.count() == len(corpus.messy_rows())
    assert language.accepted(corpus.messy(spark), model, 0.5).columns == corpus.messy(spark).columns
    nothing = language.train(corpus.none(spark))
    assert {r["lang_pred"] for r in language.predict(corpus.messy(spark), nothing).collect()} == {"und"}
    assert language.predict(corpus.none(spark), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>
<div class="top"><a href="/">Site</a> <a href="/x">Sections</a></div><div id="cookie-bar">Cookies?</div>
<div class="box1">Call us today, we are always glad to help you</div>
<article><h1>Title {i} &amp; more</h1><div class="share-buttons">Share</div><p>First <b>words</b> of {i}
 &eacute;<br>second<p>Third &lt;i&gt;<div>Fourth {i}</div><ul><li>one<li>two</ul><form>Mail <input></form>
 <div class="box2">Read our other stories about the same place</div></article>
<div class="box3"><p>Best of the week: a, b and c</p></div><aside>Side {i}</aside>
<section id="comments"><p>Nice {i}</p></section><footer>Foot</footer><script>if (a<b) "</p>"</script></body></html>"""
TEXT = "Title {i} & more\nFirst words of {i} é second\nThird <i>\nFourth {i}\none\ntwo"


def pages(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=i)) for i in range(12)]
    rows += [
        (50, "http://b.example/1", "<p>Only <b>text<p>of a page &am &amp"),
        (51, None, None),
        (52, "http://b.example/2", ""),
        (53, "//B.example:80/3", "<div>a<div>b</div>c</div><nav>no</nav>d <!-- x --> e<table><tr><td>f<td>g</table>"),
        (54, "http://b.example/4", "<main>" + "<div>" * 30_000 + "deep" + "</div>" * 100),
        (None, "http://b.example/5", "</p></div>plain < text > here <p"),
        (55, "http://b.example/6", "<p>" + "word " * 100_000 + "</p>"),
    ]
    rows += [rows[12], rows[12]]
    return spark.createDataFrame([(*r, "c", "c") for r in rows], "page_id long, url string, html string, text string, templates string")


@pytest.mark.parametrize("keys", [1000, 0])
def test_main_text_without_the_templates_of_the_site(spark, keys):
    found = templates.extract(pages(spark), broadcast_keys=keys).collect()
    texts = {r["page_id"]: r["text"] for r in found}
    assert all(texts[i] == TEXT.format(i=i) for i in range(12))
    assert texts[50] == "Only text\nof a page &am &" and texts[51] == "" == texts[52]
    assert texts[53] == "a\nb\nc\nd e\nf g" and texts[54] == "deep" and texts[None].startswith("plain < text > here")
    assert len(texts[55]) == 499_999
    assert all(r["n_chars"] == len(r["text"]) for r in found) and len(found) == 21
    assert templates.extract(pages(spark).limit(0)).count() == 0


def test_copies_of_an_article_keep_its_paragraphs(spark):
    page = "<body><article><h1>T</h1><p>One.</p><p>Two.</p></article></body>"
    rows = [(i, "http://a.example/", page) for i in range(30)]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r["text"] for r in found.collect()} == {"T\nOne.\nTwo."}


@pytest.mark.parametrize("keys", [1000, 0])
def test_rotating_adverts_of_a_hot_host(spark, keys):
    advert = "<div class=x{0}q>Advert {0} of ten, buy now</div>"
    rows = []
    for i in range(300):
        url, ad = f"http://hot.example/{i}", advert.format(i % 10)
        if i % 2:
            rows.append((i, url, f"<article><h1>T {i}</h1><p>Same lead.</p>{ad}<div>Text {i}</div></article>"))
        else:
            rows.append((i, url, f"<div>Text {i}</div>{ad}"))
    # Copies of a page keep its text, with and without an article, as do copies of an article beside other parts.
    rows += [(300 + i, "http://hot.example/copy", "<p>Copied.</p><div>All of it.</div>") for i in range(30)]
    rows += [(330 + i, "http://hot.example/", f"<article><div>Copied too.</div></article><div>{i}</div>") for i in range(30)]
    found = templates.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), broadcast_keys=keys)
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert all(texts[i] == (f"T {i}\nSame lead.\nText {i}" if i % 2 else f"Text {i}") for i in range(300))
    assert {texts[i] for i in range(300, 330)} == {"Copied.\nAll of it."}
    assert {texts[i] for i in range(330, 360)} == {"Copied too."}


def load_pipeline():
    spec = importlib.util.spec_from_file_location("corpus_pipeline", f"{_ROOT}/corpus_pipeline.py")
    if not os.path.exists(f"{_ROOT}/corpus_pipeline.py"):
        pytest.skip("no pipeline here")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_counting_decides_and_names_take_the_rest(spark, monkeypatch):
    page = "<form id=f><div class=q1>Part {0}</div><nav>Menu {0}</nav><footer>Foot {1}</footer><article><h1>T {1}</h1>" \
        "<div class=z9>Offer {0}</div><div>Text {1}</div></article><div>Outside {1}</div></form>"
    rows = [(i, "http://a.example/", page.format(i % 2, i)) for i in range(12)]
    rows.append((20, "http://b.example/", page.format(0, 20)))
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r for r in templates.extract(docs).collect()}
    assert all(found[i]["text"] == f"T {i}\nText {i}" for i in range(12))
    # On a small host names take what they can, and the count nothing.
    assert found[20]["text"] == "T 20\nOffer 0\nText 20"
    assert {tuple(found[i][c] for c in ("n_templates", "n_named", "n_outside")) for i in range(12)} == {(3, 1, 1)}
    assert tuple(found[20][c] for c in ("n_templates", "n_named", "n_outside")) == (0, 2, 2)
    monkeypatch.setattr(templates, "MIN_PAGES", 1000)
    without = {r["page_id"]: r["text"] for r in templates.extract(docs).collect()}
    assert all(without[i] == f"T {i}\nOffer {i % 2}\nText {i}" for i in range(12))


def test_template_counts_against_brute_force(spark):
    rng = random.Random(11)

    def part(depth):
        tag = rng.choice(["div", "nav", "section", "footer", "p"])
        if depth and tag != "p":
            return f"<{tag}>" + "".join(part(depth - 1) for _ in range(rng.randint(1, 2))) + f"</{tag}>"
        return f"<{tag}>w{rng.randint(0, 3)}</{tag}>"

    rows = []
    for i in range(150):
        article = f"<article><h1>t{rng.randint(0, 40)}</h1>{part(1)}{part(0)}</article>"
        body = f"{part(2)}<div>{article}</div>{part(1)}"
        rows.append((i, f"http://h{rng.randint(0, 2)}.example/{i}", f"<html><body>{body}</body></html>"))
    places = defaultdict(set)

    def walk(node, host, place, inside):
        content = node.tag == "article"
        if content:
            place = ElementTree.tostring(node)
        elif node.tag not in ("html", "body", "h1") and node.find(".//article") is None and not (inside and node.tag == "p"):
            places[host, ElementTree.tostring(node)].add(place)
        for child in node:
            walk(child, host, place, inside or content)

    for _, url, page in rows:
        walk(ElementTree.fromstring(page), url.split("/")[2], page, False)
    want = sum(len(found) >= templates.MIN_PAGES for found in places.values())
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = templates.template_keys(templates._keys(templates._chosen(docs, "html", "url", "page_id")))
    assert got.count() == want > 20


def test_pipeline_against_brute_force(spark, tmp_path):
    pipeline = load_pipeline()
    rng = random.Random(31)
    langs = ["en", "fr", "ru"]
    rows = [(i, corpus.prose(rng, 60 + i, langs[i % 3]), langs[i % 3]) for i in range(40)]
    bench = [(0, corpus.prose(rng, 30).replace("\n", " ")), (1, corpus.prose(rng, 14).replace("\n", " "))]
    rows += [
        (40, rows[3][1], "en"),
        (41, rows[6][1] + "\nand one new line of the copy that stays.", "en"),
        (42, corpus.prose(rng, 50) + "\n" + bench[0][1].upper(), "en"),
        (43, "12 34 -- !!", "en"),
        (44, None, None),
        (45, "", "fr"),
        (46, corpus.prose(rng, 5000), "en"),
    ]
    docs = spark.createDataFrame([(i, t, x, "s", len(t or "")) for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = pipeline.run(spark, f"file://{tmp_path}").collect()
    # By hand: 43 to 45 have no letters; 40 loses all its lines; lines, links and passages by definition.
    stay = [(i, t) for i, t, _ in rows if i not in (43, 44, 45)]
    stay = [(i, t) for (i, t), n in expected_texts(stay).items() if t.strip()]
    assert 40 not in dict(stay)
    root = joined([(i, fingerprint(t)) for i, t in stay])
    stay = [(i, t) for i, t in stay if root[i] == i]
    stay = [(i, t) for i, t in stay if not next(k[2] for k in decontamination([(i, t)], [(str(a), b) for a, b in bench]))]
    assert 42 not in dict(stay)
    sizes = {i: len(ids) + 1 for (i, _), ids in zip(stay, whole([t for _, t in stay]))}
    got = Counter()
    for r in found:
        assert r["doc_tokens"] == sizes[r["doc_id"]]
        got[r["doc_id"]] += r["length"]
    assert got == Counter(sizes)


def test_stages_take_messy_and_empty_rows(spark):
    pipeline = load_pipeline()
    folder = spark.createDataFrame([(1, "nothing of this is there at all")], "item_id long, text string")
    for name, stage in pipeline.STAGES:
        if name == "decontamination":
            continue
        for docs in (corpus.messy(spark), corpus.none(spark)):
            out = stage(spark, docs, "")
            if name != "packing":
                assert out.columns == docs.columns
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            out.count()
    assert folder.count() == 1
