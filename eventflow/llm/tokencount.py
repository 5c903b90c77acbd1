"""Exact token counts of every prefix of a text, by dynamic programming over the vocabulary.

For a sentencepiece BPE model, a text first splits where no piece can cross (before a space mark,
around characters that no piece holds, between characters that no piece holds side by side). Within
such a segment the encoding of a prefix is the encoding of a shorter prefix followed by one piece:
the only vocabulary piece ending there whose join with the piece before it is stable (encoding the
two pieces' characters gives these two pieces again). So one pass over the segment's positions
stores, for every prefix, its last piece and its token count. Counts of a text's prefixes are sums
over its segments; truncation and budget questions read the stored counts and encode nothing.

Segments repeat within and across texts; each worker keeps the arrays of those it has seen, in a
memory of bounded entries. Corner cases: null and empty texts have zero tokens, and one prefix (the
empty one); texts of any length are handled segment by segment, without truncation.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
# Segments whose arrays a worker keeps, at most; the memory is emptied when full.
KEPT_SEGMENTS = 1_200_000
TAIL = ".,;:!?*$%&#|"
_loaded: dict[str, PrefixCounter] = {}


class PrefixCounter:
    """Token counts of prefixes for one sentencepiece BPE model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.pieces = {m.id_to_piece(i) for i in range(m.get_piece_size())
                       if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))}
        self.longest = max(map(len, self.pieces))
        self.beside = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        # With this, a segment starts at every space mark that follows another character.
        if any(b[1] == MARK != b[0] for b in self.beside):
            raise ValueError("a piece of this model crosses the start of a word")
        # The encoder puts a mark before a text; a piece's own characters are read without it.
        self.stable_pairs: dict[tuple[str, str], bool] = {}
        self.memory: dict[str, bytes | tuple[int, ...]] = {}

    def _encode(self, chars: str) -> list[str]:
        """Pieces of characters that follow a line break (so no mark is put before them)."""
        got = self.model.encode("\n" + chars.replace(MARK, " "), out_type=str)
        return got[2:] if got[0] == MARK else got[1:]

    def _stable(self, left: str, right: str) -> bool:
        known = self.stable_pairs.get((left, right))
        if known is None:
            known = self.stable_pairs[left, right] = self._encode(left + right) == [left, right]
        return known

    def _run(self, run: str) -> list[int]:
        """Token counts of the prefixes of characters that may join, by the recurrence."""
        pieces, stable, longest = self.pieces, self._stable, self.longest
        last, count = [""], [0]
        for end in range(1, len(run) + 1):
            for start in range(max(0, end - longest), end):
                piece = run[start:end]
                if piece in pieces and (not start and (end == 1 or self._whole(piece)) or start and stable(last[start], piece)):
                    last.append(piece)
                    count.append(count[start] + 1)
                    break
            else:
                raise AssertionError(f"no piece ends the prefix {run[:end]!r}")
        return count

    def _whole(self, piece: str) -> bool:
        return self._stable("", piece) if ("", piece) in self.stable_pairs else self.stable_pairs.setdefault(("", piece), self._encode(piece) == [piece])

    def segment(self, chars: str) -> bytes | tuple[int, ...]:
        """Token counts of every prefix of a segment (``len(chars) + 1`` numbers)."""
        known = self.memory.get(chars)
        if known is None:
            core = chars.rstrip(TAIL)
            if core and core != chars and chars[len(core) - 1:len(core) + 1] not in self.beside:
                head = self.segment(core)  # words come with many ends: the word's array is shared
                counts, at, n = list(head), len(core), len(chars)
            else:
                counts, at, n = [0], 0, len(chars)
            while at < n:
                if chars[at] not in self.pieces:  # no piece: one token per UTF-8 byte
                    counts.append(counts[-1] + len(chars[at].encode()))
                    at += 1
                    continue
                end = at + 1
                while end < n and chars[end - 1:end + 1] in self.beside and chars[end] in self.pieces:
                    end += 1
                base = counts[-1]
                counts.extend(base + c for c in self._run(chars[at:end])[1:])
                at = end
            if len(self.memory) >= KEPT_SEGMENTS:
                self.memory.clear()
            known = self.memory[chars] = bytes(counts) if counts[-1] < 256 else tuple(counts)
        return known

    def segments(self, text: str) -> list[str]:
        """The text as the model sees it (a mark for every space and one in front), in segments that
        start with their marks: lines and words."""
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, " ")
        out = []
        for k, line in enumerate(text.split("\n")):
            words = line.split(" ")
            if k:
                out.append("\n")
                if words[0]:
                    out.append(words[0])
            else:
                out.append(MARK + words[0])
            marks = ""
            for w in words[1:]:
                marks += MARK
                if w:
                    out.append(marks + w)
                    marks = ""
            if marks:
                out.append(marks)
        if len(out) > 1 and out[0] == MARK and out[1][0] == MARK:  # leading spaces join the mark in front
            out[:2] = [MARK + out[1]]
        return out

    def table(self, text: str) -> PrefixTable:
        """The stored counts of a text's prefixes."""
        return PrefixTable(text, [self.segment(s) for s in self.segments(text)])

    def count(self, text: str) -> int:
        """Tokens of the whole text: the last stored count of each segment's table."""
        memory, segment = self.memory, self.segment
        return sum([(memory.get(s) or segment(s))[-1] for s in self.segments(text)])


class PrefixTable:
    """Token counts of all prefixes of one text, over its segments' shared arrays.

    Prefix k holds k characters of the text as the model sees it, after the mark in front (which
    belongs to every prefix but the empty one).
    """

    def __init__(self, text: str, arrays: list[bytes | tuple[int, ...]]):
        self.length = len(text)
        self.arrays = arrays
        self.starts = [0, *accumulate(len(a) - 1 for a in arrays)]
        self.before = [0, *accumulate(a[-1] for a in arrays)]

    @property
    def total(self) -> int:
        return self.before[-1]

    def counts(self) -> np.ndarray:
        """Token count of each prefix, from 0 to all characters."""
        if not self.arrays:
            return np.zeros(1, np.int64)
        whole = np.concatenate([np.zeros(1, np.int64), *(np.asarray(tuple(a[1:]), np.int64) + b for a, b in zip(self.arrays, self.before, strict=False))])
        out = whole[1:]  # skips the empty sequence; the mark alone stands for no text
        out[0] = 0
        return out

    def fits(self, budget: int) -> int:
        """Characters of the longest prefix whose own encoding has at most ``budget`` tokens."""
        return int(np.flatnonzero(self.counts() <= budget)[-1])


def load(path: str) -> PrefixCounter:
    """The counter of a model file, once per worker."""
    if path not in _loaded:
        _loaded[path] = PrefixCounter(path)
    return _loaded[path]


def count_tokens(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", budgets: tuple[int, ...] = ()) -> DataFrame:
    """doc_id, n_bytes and n_tokens of every whole text; for each of ``budgets`` also ``fit_<budget>``,
    the characters of its longest prefix within that many tokens. No shuffle."""
    names = [f"fit_{b}" for b in budgets]
    schema = df.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load(path)
        for batch in batches:
            n_bytes, n_tokens, fits = [], [], [[] for _ in budgets]
            for value in batch.column(1):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode()))
                if budgets:
                    table = counter.table(text)
                    n_tokens.append(table.total)
                    for got, budget in zip(fits, budgets, strict=True):
                        got.append(table.fits(budget))
                else:
                    n_tokens.append(counter.count(text))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()),
                                              *(pa.array(f, pa.int64()) for f in fits)], names=["doc_id", "n_bytes", "n_tokens", *names])

    return df.select(df[id_col], df[text_col]).mapInArrow(run, ", ".join([f"doc_id {schema}", "n_bytes long", "n_tokens long", *(f"{n} long" for n in names)]))
