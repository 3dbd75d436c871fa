"""Token ids of whole texts with a public tokenizer file.

White space never ends up inside a token of this kind of tokenizer, so a text
is cut at ASCII white space, and words of letters below U+0100 are cut from the
signs behind them.  Units are found and hashed for a whole slice of rows at once;
the ids of a unit that occurred before are taken from a bounded pool.  The ids
equal those of one call over the whole text; a text that names a special token
is encoded by such a call, as the tokenizer looks for these names first.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa

from pricepanel.llm.columns import VISIBLE, Words, byte_class, kept

#: Name of the default vocabulary file.
VOCABULARY = "word_bpe_49k.json"
#: Units, and ids of units, that a worker keeps; beyond that it starts anew.
POOL_UNITS = 600_000
POOL_IDS = 4_000_000
#: A text of more characters is encoded in parts of about so many, cut at white space.
PART_CHARS = 1 << 20
#: A unit of more bytes is encoded each time and not kept.
UNIT_BYTES = 64
#: Pieces encoded by one call.
CALL_PIECES = 4096
#: What the last token of a word ends with.
WORD_END = "</w>"
#: ASCII signs; the apostrophe has rules of its own.
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]")
#: Kinds of bytes: 1 letters, 2 signs, 0 all others.
_KIND = byte_class((0x41, 0x5A), (0x61, 0x7A)).astype(np.uint8)
_KIND[[ord(c) for c in _SIGNS]] = 2


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _lowered(piece: str) -> str:
    """The piece in lower case where that cannot change the ids."""
    if "\u03a3" not in piece and is_normalized("NFC", piece):
        lower = piece.lower()
        if is_normalized("NFC", lower):
            return lower
    return piece


def _kinds(content: np.ndarray) -> np.ndarray:
    """1 for bytes of letters below U+0100 (one letter in lower case, too), 2 for ASCII signs, else 0."""
    kind = _KIND[content]
    # U+00C0 to U+00FF are the byte C3 and one more; the multiplication and division signs are no letters.
    lead = np.flatnonzero(content == 0xC3)
    lead = lead[(content[lead + 1] != 0x97) & (content[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    return kind


def _units(words: Words) -> np.ndarray:
    """Cut words of letters below U+0100 from the signs behind them in ``words``; 1 such words, 2 signs, else 0."""
    kind = _kinds(words.bytes)
    change = np.zeros(len(kind) + 1, np.int64)
    change[1:-1] = np.cumsum(kind[1:] != kind[:-1])
    change[-1:] = change[-2:-1]
    other = np.zeros(len(kind) + 1, np.int64)
    np.cumsum(kind == 0, out=other[1:])
    start, end = words.start, words.end
    # change[i]: changes of kind up to and with byte i
    changes = change[end - 1] - change[start]
    plain = (other[end] == other[start]) & ((changes == 0) | ((changes == 1) & (kind[start] == 1)))
    cut = np.flatnonzero(plain & (changes == 1))
    at = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    split = at[change[start[cut]]]
    kinds = np.where(plain, kind[start], 0)
    words.start = np.insert(start, cut + 1, split)
    words.end = np.insert(end, cut, split)
    words.first = np.searchsorted(words.start, words.offsets)
    return np.insert(kinds, cut + 1, 2)


def _stays_letters(head: str) -> bool:
    """Letters only, also in lower case and NFC, which may end in a combining mark."""
    return head.isalpha() and (head.isascii() or normalize("NFC", normalize("NFC", head).lower()).isalpha())


class Encoder:
    """``ids(texts)`` gives one uint32 array per text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        names = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        #: What all names start with, up to the first letter; a text without it names none.
        self._opening = re.match(r"[\W_]*", os.path.commonprefix(names))[0]
        self._named = re.compile("|".join(map(re.escape, names)) or r"(?!)", re.IGNORECASE)
        self.size = self._tokenizer.get_vocab_size()
        self._forget()
        # Lower-case words of letters need no normalizer and no splitting but at blanks.
        self._bytes = Tokenizer.from_file(path)
        self._bytes.normalizer = None
        self._bytes.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # Bytes of ASCII letters stand for themselves.
        self._ascii = Tokenizer.from_file(path)
        self._ascii.normalizer = None
        self._ascii.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True

    def _forget(self) -> None:
        """Start with an empty pool."""
        #: Ids of known units, the units' hashes in order, and where the ids of each are: start * 2**16 + count.
        self._pool = np.zeros(1 << 16, "<u4")
        self._used = 0
        self._known = np.zeros(0, np.uint64)
        self._places = np.zeros(0, np.int64)

    def _encode(self, text: str) -> np.ndarray:
        found = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, "<u4")

    def _names_special(self, text: str) -> bool:
        """Whether a special token's name stands in the text, in any case."""
        return self._opening in text and self._named.search(text) is not None

    def _encode_words(self, words: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
        """(ids, count of each word) of lower-case words of letters: one call for many, cut where words end."""
        found = tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        flat = np.array(found.ids, "<u4")
        ends = np.flatnonzero(self._ends[flat]) + 1
        if len(ends) == len(words):
            return flat, np.diff(ends, prepend=0)
        each = [self._encode(w) for w in words]
        return np.concatenate(each), np.array([len(ids) for ids in each])

    def _encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of pieces that are not letters below U+0100 only."""
        known: dict[str, np.ndarray] = {}
        cut = []
        for piece in map(_lowered, pieces):
            # Letters and the signs behind them are never in one token.
            head = piece.rstrip(_SIGNS)
            cut.append((head, piece[len(head) :]) if head and _stays_letters(head) else (piece, ""))
        heads = {head for head, _ in cut}
        many = [w for w in heads if w.isalpha() and w.islower() and w == w.lower() and is_normalized("NFC", w)]
        for at in range(0, len(many), CALL_PIECES):
            part = many[at : at + CALL_PIECES]
            flat, counts = self._encode_words(part, self._bytes)
            stops = np.cumsum(counts).tolist()
            known.update(zip(part, [flat[a:b] for a, b in zip([0, *stops], stops)]))
        for unit in heads.union(tail for _, tail in cut).difference(known):
            known[unit] = self._encode(unit)
        return [np.concatenate([known[head], known[tail]]) if tail else known[head] for head, tail in cut]

    def _keep(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Add the ids of units to the pool; start * 2**16 + count of each."""
        end = self._used + len(flat)
        if end > len(self._pool):
            self._pool = np.concatenate([self._pool, np.zeros(max(end - len(self._pool), len(self._pool)), "<u4")])
        self._pool[self._used : end] = flat
        places = (self._used + np.cumsum(counts) - counts) * (1 << 16) + counts
        self._used = end
        return places

    def ids_of(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One uint32 array per text of a string column; null is empty."""
        if len(texts) == 1 and len(text := texts[0].as_py() or "") > PART_CHARS:
            yield self._of_parts(text)
        else:
            yield from self._of_slice(texts)

    def _of_parts(self, text: str) -> np.ndarray:
        """Ids of a long text with bounded memory besides them."""
        if self._names_special(text):
            return self._encode(text)
        at, out = 0, []
        while at < len(text):
            space = _SPACE.search(text, at + PART_CHARS)
            end = space.start() if space else len(text)
            out += self._of_slice(pa.array([text[at:end]], pa.string()))
            at = end
        return np.concatenate(out)

    def _of_slice(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if len(self._known) > POOL_UNITS or self._used > POOL_IDS:
            self._forget()
        words = Words(texts, VISIBLE)
        content = words.bytes.tobytes()
        kinds = _units(words) if len(words.start) else np.zeros(0, np.uint8)
        start, end = words.start, words.end
        unique, one, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
        at = np.searchsorted(self._known, unique)
        places = np.full(len(unique), -1, np.int64)
        seen = np.flatnonzero(at < len(self._known))
        seen = seen[self._known[at[seen]] == unique[seen]]
        places[seen] = self._places[at[seen]]
        short = end[one] - start[one] <= UNIT_BYTES
        fresh = np.flatnonzero((places < 0) & short)
        letters, rest = fresh[kinds[one[fresh]] == 1], fresh[kinds[one[fresh]] != 1]

        def read(i: np.ndarray) -> list[bytes]:
            return [content[a:b] for a, b in zip(start[i].tolist(), end[i].tolist())]

        for i in range(0, len(letters), CALL_PIECES):
            part = letters[i : i + CALL_PIECES]
            found = b" ".join(read(one[part])).decode().lower().split(" ")
            ascii_only = np.fromiter(map(str.isascii, found), bool, len(found))
            for mine, tokenizer in ((ascii_only, self._ascii), (~ascii_only, self._bytes)):
                if mine.any():
                    chosen = [found[i] for i in np.flatnonzero(mine).tolist()]
                    places[part[mine]] = self._keep(*self._encode_words(chosen, tokenizer))
        if len(rest):
            found = self._encode_pieces([b.decode() for b in read(one[rest])])
            places[rest] = self._keep(np.concatenate(found), np.array([len(ids) for ids in found]))
        self._places = np.insert(self._places, at[fresh], places[fresh])
        self._known = np.insert(self._known, at[fresh], unique[fresh])

        place = places[which]
        count, source = place & 0xFFFF, place >> 16
        long = np.flatnonzero(end - start > UNIT_BYTES)
        if len(long):
            # By place, not by hash; they go behind the pool for this slice only.
            found = [self._encode(b.decode()) for b in read(long)]
            sizes = np.array([len(ids) for ids in found])
            pool = np.concatenate([self._pool[: self._used], *found])
            count[long], source[long] = sizes, self._used + np.cumsum(sizes) - sizes
        else:
            pool = self._pool
        before = np.concatenate([[0], np.cumsum(count)])
        flat = pool[np.repeat(source - before[:-1], count) + np.arange(before[-1])]
        bounds = before[words.first].tolist()
        named = self._opening.encode()
        whole = not named or named in content
        for r, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if whole and (text := texts[r].as_py()) and self._names_special(text):
                yield self._encode(text)
            else:
                yield flat[a:b]

    def ids(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """One uint32 array per text."""
        return self.ids_of(pa.array(texts, pa.string()))


#: The owner of what a worker keeps of this module.
OWNER = "tokens"
_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file, until the worker turns to other tasks."""
    kept(OWNER, _ENCODERS.clear)
    if path not in _ENCODERS:
        # A worker is one of several on its machine; it must not start a thread per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())
