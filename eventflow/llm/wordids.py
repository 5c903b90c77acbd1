"""Token ids of whole texts through a ``tokenizers`` file that drops white space.

The words between spaces and line breaks are encoded by the library, each distinct word once per
worker's memory (of bounded entries: words not met for a while leave it), and a text's ids are its
words' ids in a row, as the library gives for the whole text. Signs after a letter or digit are
words of their own. Texts are taken many at a time, so that their new words go to the library
together. Words of letters only, which the file's normaliser
and splitting rules leave in one piece, go straight to the library's BPE model, joined by spaces: its
tokens tell which of them end a word. Other words take the whole pipeline. Texts holding an added
token's string go to the library whole.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

# Distinct words whose ids a worker keeps, about; the half not met for longest goes when it is full.
KEPT_WORDS = 800_000
# Signs that end words: a run of them is a token run of its own after letters.
TAIL = ".,;:!?*$%&#|"
# Such a sign after a Latin or Cyrillic letter or a digit, which stay one letter or digit each
# when normalised (the dotted capital I does not).
SIGN = re.compile(f"[{TAIL}](?<=[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f\u0400-\u0481\u048a-\u052f].)")
_loaded: dict[str, WordIds] = {}


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: visible Latin-1 bytes
    are themselves, the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        m = spec["model"]
        merges = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in m["merges"]]
        # The same model without the library's own cache, which distinct words never hit.
        self.model = Tokenizer(models.BPE(vocab=m["vocab"], merges=merges, end_of_word_suffix=m["end_of_word_suffix"], cache_capacity=0))
        self.model.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        self.ends_word = np.zeros(max(m["vocab"].values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in m["vocab"].items() if token.endswith(m["end_of_word_suffix"])]] = True
        letters = _byte_letters()
        self.letters = {b: letters[b] for b in range(256) if b != 0x20 and letters[b] != chr(b)}
        self.words: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letter_words(self, words: list[str]) -> list[bytes]:
        """Ids of lower-case words of letters."""
        joined = " ".join(words)
        if not joined.isascii():
            joined = joined.encode().decode("latin-1").translate(self.letters)
        ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * np.flatnonzero(self.ends_word[ids]) + 4).tolist()
        if len(ends) != len(words):  # a file whose vocabulary lacks a letter at the end of a word
            return [np.array(self.model.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in joined.split(" ")]
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each of distinct words."""
        normal = unicodedata.is_normalized
        ascii_words = [w for w in words if w.isascii() and w.isalpha() and w.islower()]
        other_words = [w for w in words if not w.isascii() and w.isalpha() and w.islower() and normal("NFC", w)]
        out: dict[str, bytes] = {}
        for letter_words in (ascii_words, other_words):
            if letter_words:
                out.update(zip(letter_words, self._letter_words(letter_words), strict=True))
        if len(out) < len(words):
            parts, lows, others = [], set(), set()
            for w in words:
                if w in out:
                    continue
                core = w.rstrip(TAIL)
                low = core.lower()
                if core.isalpha() and (core.isascii() or low.isalpha() and "\u03a3" not in core and normal("NFC", core)):
                    tail = w[len(core):]
                    parts.append((w, low, tail))
                    lows.add(low)
                    others.add(tail)
                else:
                    others.add(w)
            for wanted, encode in ((lows, self._letter_words), (others, self._library)):
                if fresh := [w for w in wanted if w and w not in out]:
                    out.update(zip(fresh, encode(fresh), strict=True))
            for w, low, tail in parts:
                out[w] = out[low] + (out[tail] if tail else b"")
        return out

    def encode_all(self, texts: list[str], kept_words: int = KEPT_WORDS) -> list[bytes]:
        """Each text's ids, little-endian unsigned 32-bit."""
        if len(self.words) > kept_words // 2:
            self.words, self.older = {"": b""}, self.words
        whole = [any(a in text for a in self.added) for text in texts]
        splits = [[] if w else SIGN.sub(r" \g<0>", _lowered(text)).replace("\n", " ").split(" ") for text, w in zip(texts, whole, strict=True)]
        out = [list(map(self.words.get, split)) for split in splits]
        holes = [[k for k, ids in enumerate(got) if ids is None] for got in out]
        missing = {split[k] for split, at in zip(splits, holes, strict=True) for k in at}
        if missing:
            found = {w: self.older.get(w) for w in missing}
            if unknown := [w for w, ids in found.items() if ids is None]:
                found.update(self._encode_words(unknown))
            self.words.update(found)
            for split, got, at in zip(splits, out, holes, strict=True):
                for k in at:
                    got[k] = found[split[k]]
        return [self._library([text])[0] if w else b"".join(got) for text, got, w in zip(texts, out, whole, strict=True)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def _lowered(text: str) -> str:
    """The text in lower case where that is each character's own and leaves the normal form as it is
    (Latin-1); else as it is."""
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
    return text.lower()


def load(path: str) -> WordIds:
    """The encoder of a file, once per worker."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]
