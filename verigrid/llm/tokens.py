"""Ids of whole texts from the ids of their words.

A pre-tokenizer that never joins characters across the blank before a word gives a text the ids
of its words, one after the other. The library encodes each different word once per worker and
the texts are put together with array lookups. Texts in which that cut could matter are cut more
carefully, and texts with control characters, unusual blanks or special tokens are encoded whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import count, islice, repeat
from operator import attrgetter

import numpy as np

from verigrid.llm.common import WORKER_TABLES

#: A word with the blanks before it, and what blanks remain at the end.
_CHUNKS = re.compile(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+\Z").findall
#: Letters of ASCII and Latin-1, then ASCII marks other than the apostrophe.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)\Z").match
_ID = attrgetter("id")
_NO_BLANKS = str.maketrans("", "", "\t\n\r\f\v")
#: How a key says what it stands for: the first word of a text, or a chunk as it is.
_FIRST, _AS_IS = "\x00", "\x01"


def _shown_bytes() -> dict[int, str]:
    """Blank and Latin-1 letters as byte-level vocabularies write their UTF-8 bytes."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    byte = [chr(b) if b in kept else chr(next(moved)) for b in range(256)]
    return {c: "".join(byte[b] for b in chr(c).encode()) for c in (0x20, *range(0xC0, 0x100))}


_SHOWN = _shown_bytes()
#: How byte-level vocabularies write a line end.
_SHOWN_LINE = "\u010A"


def _common(text: str) -> bool:
    """No special token, control character or blank other than the ASCII ones."""
    if "<|" in text:
        return False
    return text.replace("\n", "").isprintable() or text.translate(_NO_BLANKS).isprintable()


def _spaced_keys(text: str) -> list[str]:
    """Blanks belong to the ids: a word takes the blanks before it along."""
    if (
        "<|" not in text and text.replace("\n", "").isprintable() and "  " not in text
        and " \n" not in text and "\n " not in text and not text.endswith(" ")
    ):
        if "\n\n" not in text:  # a line end between two words is a unit of its own and goes with the second
            text = text.replace("\n", " \n")
        first, *rest = text.split(" ")
        return [_FIRST + first, *rest] if first else rest
    if _common(text):
        return [_AS_IS + chunk for chunk in _CHUNKS(text)]
    return [_AS_IS + text]


def _bare_keys(text: str) -> list[str]:
    """Blanks are dropped, and case too: words are enough."""
    if _common(text):
        return (text.lower() if text.isascii() else text).split()
    return [_AS_IS + text]


class WordEncoder:
    """Encodes batches of texts with a file of the tokenizers library.

    ``spaced`` tells that blanks belong to the ids (byte-level vocabularies); otherwise the
    vocabulary drops blanks and case. At ``most`` words or ``room`` characters the table of known
    words becomes the old table, from which words that come again are taken over, and the table
    that was old goes; memory is bounded whatever the corpus holds and frequent words stay known.
    """

    def __init__(self, path: str, spaced: bool, most: int = 750_000, room: int = 32_000_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.keys = _spaced_keys if spaced else _bare_keys
        self.blank = " " if spaced else ""
        self.most, self.room = most, room
        if spaced:
            vocabulary = self.library.get_vocab()
            self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
            self.begins[[i for token, i in vocabulary.items() if token[:1] in (_SHOWN[ord(" ")], _SHOWN_LINE)]] = True
        self._clear()
        self._age()

    def _age(self) -> None:
        """The table becomes the old one and a new one is begun."""
        self.old, self.old_flat, self.old_first, self.old_count = self.known, self.flat, self.first, self.count
        self._clear()

    def _clear(self) -> None:
        self.known: defaultdict[str, int] = defaultdict(count().__next__)  # an unknown word gets the next number
        self.held = self.used = 0
        self.flat = np.empty(0, np.uint32)
        self.first = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)

    def _text(self, key: str) -> str:
        return key[1:] if key[:1] in (_FIRST, _AS_IS) else key if key[:1] == "\n" else self.blank + key

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and how many belong to each."""
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([i for ids in found for i in ids], np.uint32), counts

    def _joined_ids(self, keys: list[str], run: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a blank or a line end before them, many in one text.

        Only the first id of such a word has the blank or the line end in it.
        """
        texts = [(" " + " ".join(keys[k : k + run])).replace(" \n", "\n") for k in range(0, len(keys), run)]
        flat, _ = self._encoded(texts)
        first = np.flatnonzero(self.begins[flat])
        if first.size != len(keys):  # the vocabulary is not of that kind
            return self._encoded([self._text(key) for key in keys])
        return flat, np.diff(np.append(first, flat.size))

    def _bare_ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of a vocabulary that drops blanks and case.

        Letters are one unit of the pre-tokenizer and the marks behind them are another. The
        normalizer changes nothing but the case of such letters, so the model of the library alone
        gives their ids.
        """
        tokenize = self.library.model.tokenize
        matches = [_PLAIN(key) for key in keys]
        others = [key for key, plain in zip(keys, matches, strict=True) if plain is None]
        encoded = iter(self.library.encode_batch_fast([self._text(key) for key in others], add_special_tokens=False))
        marks: dict[str, list[int]] = {}
        flat: list[int] = []
        ends: list[int] = []
        for plain in matches:
            if plain is None:
                flat += next(encoded).ids
            else:
                letters, mark = plain.groups()
                letters = letters.lower()
                if not letters.isascii():
                    letters = letters.translate(_SHOWN)
                flat.extend(map(_ID, tokenize(letters)))
                if mark:
                    if mark not in marks:
                        marks[mark] = [token.id for token in tokenize(mark)]
                    flat += marks[mark]
            ends.append(len(flat))
        return np.array(flat, np.uint32), np.diff(np.array(ends, np.int64), prepend=0)

    def _taken_over(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of the old table."""
        first, counts = self.old_first[at], self.old_count[at]
        before = np.cumsum(counts) - counts
        return self.old_flat[np.repeat(first - before, counts) + np.arange(counts.sum())], counts

    def _learn(self, keys: list[str]) -> None:
        """Ids of the words that were numbered last."""
        start = len(self.known) - len(keys)
        self.held += sum(map(len, keys))
        self.first, self.count = (_grown(x, start, len(keys)) for x in (self.first, self.count))
        at = np.fromiter(map(self.old.get, keys, repeat(-1)), np.int64, len(keys))
        again, fresh = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        self._add(start + again, *self._taken_over(at[again]))
        if not self.blank:
            self._add(start + fresh, *self._bare_ids([keys[i] for i in fresh.tolist()]))
            return
        alone = np.fromiter((key[0] in "\x00\x01" or "\n" in key[1:] for key in keys), bool, len(keys))
        for kind, ids in ((fresh[alone[fresh]], lambda some: self._encoded([self._text(key) for key in some])), (fresh[~alone[fresh]], self._joined_ids)):
            if kind.size:
                self._add(start + kind, *ids([keys[i] for i in kind.tolist()]))

    def _add(self, at: np.ndarray, flat: np.ndarray, counts: np.ndarray) -> None:
        self.first[at] = self.used + np.cumsum(counts) - counts
        self.count[at] = counts
        self.flat = _grown(self.flat, self.used, flat.size)
        self.flat[self.used : self.used + flat.size] = flat
        self.used += flat.size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many belong to each text."""
        if len(self.known) > self.most or self.held > self.room:
            self._age()
        keys: list[str] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        for i, text in enumerate(texts):
            keys += self.keys(text)
            ends[i + 1] = len(keys)
        known = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))
        if new := len(self.known) - known:
            self._learn(list(islice(reversed(self.known), new))[::-1])
        counts = self.count[at]
        before = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
        place = np.repeat(self.first[at] - before[:-1], counts) + np.arange(before[-1])
        return self.flat[place], np.diff(before[ends])


def _grown(values: np.ndarray, used: int, more: int) -> np.ndarray:
    """The array, or one of more room that begins with its used part."""
    if used + more <= values.size:
        return values
    out = np.empty(max(used + more, values.size + values.size // 2), values.dtype)
    out[:used] = values[:used]
    return out


def encoder(path: str, spaced: bool, **bounds: int) -> WordEncoder:
    """The worker's encoder of a vocabulary file; a reused worker keeps its tables of words."""
    key = (path, spaced, *bounds.items())
    if key not in WORKER_TABLES:
        WORKER_TABLES[key] = WordEncoder(path, spaced, **bounds)
    return WORKER_TABLES[key]
