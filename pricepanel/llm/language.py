"""Language of texts and of spans in them: script ranges, per-word scores, Viterbi.

Training counts letter trigrams and scripts per language over all labelled
training rows in one aggregation; the model is a table of TABLE buckets per
language, whatever the size of the corpus.  A word's script leaves the
languages that are written in it; the word's score per language is the sum of
its trigrams' log probabilities; Viterbi over the words with a switching
penalty labels them, many texts side by side.

Defined results: null texts and texts without letters are ``und`` with score
0; a text that holds letters always gets a learned language; ties go to the
language that sorts first; without any training row every text is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm.columns import mix, text_slices

#: Buckets of the trigram table.
TABLE = 1 << 16
#: Added to every count.
SMOOTHING = 0.5
#: Log-probability cost of a change of language between two words.
SWITCH = 12.0
#: A language is written in a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.005
#: Score of a word for a language that its script rules out.
EXCLUDED = -1000.0
#: Words of texts longer than this are walked together with those of other long texts.
LONG_WORDS = 1200
#: Word scores held for long texts at once.
POOL_SCORES = 2_000_000

#: First and last code points of scripts.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "ethiopic": [(0x1200, 0x137F)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
    "hangul": [(0xAC00, 0xD7A3), (0x1100, 0x11FF)],
}
N_SCRIPTS = len(SCRIPTS) + 1
_BMP = 1 << 16
_TABLES: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is letter, lower case, script number) of the code points of the basic plane; 0 is any other script."""
    if not _TABLES:
        chars = [chr(i) for i in range(_BMP)]
        letter = np.array([c.isalpha() for c in chars])
        lower = np.array([ord(x) if len(x := c.lower()) == 1 else i for i, c in enumerate(chars)], np.uint32)
        script = np.zeros(_BMP, np.int64)
        for number, ranges in enumerate(SCRIPTS.values(), 1):
            for a, b in ranges:
                script[a : b + 1] = number
        _TABLES.extend([letter, lower, script])
    return _TABLES[0], _TABLES[1], _TABLES[2]


class Letters:
    """Letter words of a slice of texts with the trigram bucket of every letter."""

    def __init__(self, texts: list[str | None]):
        letter, lower, script = _tables()
        lengths = np.array([len(t or "") for t in texts], np.int64)
        joined = "".join(t or "" for t in texts)
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        low = np.where(code < _BMP, code, 0)
        is_letter = letter[low]
        if (code >= _BMP).any():
            far = np.flatnonzero(code >= _BMP)
            is_letter[far] = [chr(c).isalpha() for c in code[far].tolist()]
        folded = np.where(code < _BMP, lower[low], code)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        n = len(code)
        edge = np.zeros(n + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(n, bool)
        before[1:] = is_letter[:-1]
        begins = is_letter & (~before | edge[:-1])
        self.start = np.flatnonzero(begins)
        after = np.zeros(n, bool)
        after[:-1] = is_letter[1:]
        self.end = np.flatnonzero(is_letter & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        folded = folded[is_letter]
        self.letters = self.end - self.start
        #: First letter of every word among the letters.
        self.base = np.cumsum(self.letters) - self.letters
        # The letter, those on its left and right in the word (0: none), in 21 bits each; one after the other,
        # as these are the largest arrays at work.
        key = np.zeros(len(folded), np.uint64)
        key[1:] = folded[:-1]
        key[self.base] = 0
        key <<= np.uint64(21)
        key |= folded
        key <<= np.uint64(21)
        right = np.zeros(len(folded), folded.dtype)
        right[:-1] = folded[1:]
        right[self.base + self.letters - 1] = 0
        key |= right
        self.bucket = (mix(key) >> np.uint64(48)).astype(np.int32)
        self.script = np.where(code[self.start] < _BMP, script[low[self.start]], 0)
        self.row = np.repeat(np.arange(len(texts)), np.diff(self.first))


@dataclass
class Model:
    languages: list[str]
    #: log probabilities, bucket by language
    weights: np.ndarray
    #: script by language
    allowed: np.ndarray


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> Model:
    """Counts over every training row; what reaches the driver is one number per language and used bucket."""
    ship(docs.sparkSession)
    rows = docs.filter(~held_out(F.col(id_col)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.selectExpr(f"`{text}` AS text", f"cast(`{lang}` as string) AS lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        for part in text_slices(batches):
            letters = Letters(part.column("text").to_pylist())
            names = part.column("lang").to_pylist()
            code = {name: i for i, name in enumerate(sorted(set(names)))}
            of_row = np.array([code[name] for name in names], np.int64)
            of_word = of_row[letters.row]
            flat = np.repeat(of_word, letters.letters) * TABLE + letters.bucket
            counts = np.bincount(flat, minlength=len(code) * TABLE).reshape(len(code), TABLE)
            scripts = np.bincount(
                of_word * N_SCRIPTS + letters.script, letters.letters, minlength=len(code) * N_SCRIPTS
            ).reshape(len(code), N_SCRIPTS)
            for name, i in code.items():
                both = np.concatenate([counts[i], scripts[i].astype(np.int64)])
                grams[name] = grams[name] + both if name in grams else both
        for name, both in grams.items():
            used = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(both[used])],
                names=["lang", "bucket", "n"],
            )

    counted = rows.mapInArrow(run, "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    index = {name: i for i, name in enumerate(languages)}
    table = np.zeros((TABLE + N_SCRIPTS, max(len(languages), 1)))
    if languages:
        table[found["bucket"].to_numpy(), found["lang"].map(index).to_numpy()] = found["n"].to_numpy()
    grams, scripts = table[:TABLE] + SMOOTHING, table[TABLE:]
    share = scripts / np.maximum(scripts.sum(axis=0), 1)
    allowed = share >= SCRIPT_SHARE
    # A script that no language is written in rules nothing out.
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32), allowed)


def word_scores(letters: Letters, model: Model) -> np.ndarray:
    """Word by language."""
    n = model.weights.shape[1]
    if not len(letters.start):
        return np.zeros((0, n), np.float32)
    scores = np.empty((len(letters.start), n), np.float32)
    for j in range(n):
        scores[:, j] = np.add.reduceat(model.weights[:, j][letters.bucket], letters.base)
    return np.where(model.allowed[letters.script], scores, np.float32(EXCLUDED))


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word; texts are ``first[r]:first[r+1]`` and walked side by side, longest first."""
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    counts, begin = counts[order], first[:-1][order]
    steps = int(counts[0]) if len(counts) else 0
    # Texts that have a word number t, for every t.
    alive = np.searchsorted(-counts, -np.arange(steps), "left")
    back = np.zeros(scores.shape, np.int16)
    own = np.arange(scores.shape[1], dtype=np.int16)
    labels = np.zeros(len(scores), np.int64)
    last = np.zeros((len(counts), scores.shape[1]))
    for t in range(steps):
        k = alive[t]
        at = begin[:k] + t
        if t:
            prior = last[:k]
            best = prior.argmax(axis=1)
            jump = prior[np.arange(k), best] - switch
            change = jump[:, None] > prior
            back[at] = np.where(change, best[:, None], own)
            last[:k] = np.where(change, jump[:, None], prior) + scores[at]
        else:
            last[:k] = scores[at]
    state = last.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = alive[t]
        at = begin[:k] + t
        labels[at] = state[:k]
        if t:
            state[:k] = back[at, state[:k]]
    return labels


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])
_DDL = (
    "doc_id long, held_out boolean, lang_pred string, score double, "
    "spans array<struct<start:long,end:long,lang:string>>"
)


def _labelled(start: np.ndarray, end: np.ndarray, labels: np.ndarray, names: list[str]) -> tuple[str, float, list]:
    """(prediction, score, spans) of one text from its words and their labels."""
    if not len(labels):
        return "und", 0.0, []
    weight = np.bincount(labels, (end - start).astype(np.float64), minlength=len(names))
    top = int(weight.argmax())
    cuts = np.flatnonzero(np.diff(labels)) + 1
    begins, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(labels)]]) - 1
    spans = [
        {"start": s, "end": e, "lang": names[m]}
        for s, e, m in zip(start[begins].tolist(), end[ends].tolist(), labels[begins].tolist())
    ]
    return names[top], float(weight[top] / weight.sum()), spans


def _predicted(
    batches: Iterator[pa.RecordBatch], text: str, model: Model, switch: float
) -> Iterator[tuple[pa.Table, list[tuple[str, float, list]]]]:
    """Rows, and (prediction, score, spans) of each; long texts come in tables of their own."""
    pool: list[tuple] = []
    pooled = 0

    def walk(rows: pa.Table, items: list[tuple]):
        first = np.concatenate([[0], np.cumsum([len(scores) for _, _, scores in items])]).astype(np.int64)
        labels = viterbi(np.concatenate([scores for _, _, scores in items]), first, switch)
        return rows, [
            _labelled(start, end, labels[a:b], model.languages)
            for (start, end, _), a, b in zip(items, first, first[1:])
        ]

    def drain():
        return walk(pa.concat_tables(row for row, _ in pool), [item for _, item in pool])

    for part in text_slices(batches, text):
        letters = Letters(part.column(text).to_pylist())
        scores = word_scores(letters, model)
        first = letters.first if model.languages else np.zeros_like(letters.first)
        short, items = [], []
        for r in range(part.num_rows):
            a, b = first[r], first[r + 1]
            item = (letters.start[a:b] - letters.offsets[r], letters.end[a:b] - letters.offsets[r], scores[a:b])
            if b - a <= LONG_WORDS:
                short.append(r)
                items.append(item)
            else:
                # Copies, so that the slice can go.
                row = pa.Table.from_batches([part.slice(r, 1)]).take(pa.array([0]))
                pool.append((row, tuple(x.copy() for x in item)))
                pooled += item[2].size
        if short:
            yield walk(pa.Table.from_batches([part]).take(pa.array(short)), items)
        if pooled > POOL_SCORES:
            yield drain()
            pool, pooled = [], 0
    if pool:
        yield drain()


def predict(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id", switch: float = SWITCH) -> DataFrame:
    """One row per document: held_out, lang_pred, score (its share of the letters), spans (code points)."""
    ship(docs.sparkSession)
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text).alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in _predicted(batches, "text", shared.value, switch):
            made = rows.select(["doc_id", "held_out"])
            made = made.append_column("lang_pred", pa.array([x[0] for x in found], pa.string()))
            made = made.append_column("score", pa.array([x[1] for x in found], pa.float64()))
            made = made.append_column("spans", pa.array([x[2] for x in found], pa.list_(_SPAN)))
            yield from made.to_batches()

    return chosen.mapInArrow(run, _DDL)


def accepted(docs: DataFrame, model: Model, min_score: float, text: str = "text", switch: float = SWITCH) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is mostly in one known language."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, found in _predicted(batches, text, shared.value, switch):
            keep = [name != "und" and score >= min_score for name, score, _ in found]
            yield from rows.filter(pa.array(keep, pa.bool_())).to_batches()

    return docs.mapInArrow(run, docs.schema)
