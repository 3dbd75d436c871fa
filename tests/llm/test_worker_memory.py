"""What Python workers hold, as they outlive their tasks."""

import random
import tracemalloc

import pyarrow as pa

from pricepanel.llm import columns, language, tokens


def test_a_worker_frees_the_encoder_when_it_turns_to_other_tasks():
    """Workers outlive their tasks; the pipeline's next stages need the memory."""
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["one two", None])})
    encoder = tokens.encoder(tokens.default_path())
    assert len(list(columns.text_slices(iter([batch]), owner=tokens.OWNER))) == 1
    assert tokens.encoder(tokens.default_path()) is encoder
    assert len(list(columns.text_slices(iter([batch])))) == 1
    assert not tokens._ENCODERS
    again = tokens.encoder(tokens.default_path())
    assert again is not encoder
    assert [x.tolist() for x in again.ids(["one two", None])] == [x.tolist() for x in encoder.ids(["one two", None])]


def test_known_units_and_letters_take_little_memory():
    rng = random.Random(41)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    texts = [" ".join(word() for _ in range(2000)) for _ in range(20)]
    encoder = tokens.Encoder(tokens.default_path())
    first = [x.copy() for x in encoder.ids(texts)]
    assert all((a == b).all() for a, b in zip(first, encoder.ids(texts)))
    tracemalloc.start()
    try:
        kept = tracemalloc.get_traced_memory()[0]
        list(encoder.ids([t[::-1] for t in texts]))
        known = tracemalloc.get_traced_memory()[0] - kept
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        letters = language.Letters(texts)
        peak = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    print("bytes a unit", known / 40_000, "bytes a letter", peak / len("".join(texts)))
    assert len(letters.start) == 40_000
    assert known <= 110 * 40_000 and peak <= 56 * len("".join(texts))
