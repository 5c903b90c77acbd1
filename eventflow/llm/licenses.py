"""License scans: MinHash bands over overlapping windows, then exact shingle containment.

Templates and texts are read as words (lower case, punctuation between words). Each template is
cut into windows of the largest of ``SIZES`` words that fits it, at every offset; each text into
overlapping windows of all sizes. A window's signature is ``BANDS`` bands of ``ROWS`` MinHash
values over its 5-word shingles, and a text window retrieves the templates with which it shares a
band. Two windows of Jaccard similarity s share one with probability 1 - (1 - s**ROWS)**BANDS:
above 0.99 from s = 0.6 on, and 1 for equal windows, one of which lies in every whole copy.

A retrieved template is verified on the words around the window: the share of its distinct
shingles that occur there must reach ``CONTAINED``, and of each phrase that tells its license from siblings
(``DECIDING``: a version, Affero, Lesser, BY/NC/SA) at least ``DECIDED`` of the shingles must be there. Overlapping
findings of a template are one. A sibling without a template of its own is not reported under another's name.

Corner cases: null, empty and short texts match nothing; texts of any length are scanned whole;
repeated rows are reported each; null ids are kept; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventflow.llm.textscan import PUNCTUATION, Words, chunks, mix, text_buffers

SHINGLE, SIZES = 5, (5, 8, 16, 32)
BANDS, ROWS = 12, 2
CONTAINED = 0.8

# Customary notices of licenses, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
                 "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
                 "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met:"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
                     "derived from this software without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Phrases that tell a license from its siblings. Those that a template has must be in the text.
DECIDING = ("version 1", "version 2", "version 3", "v 2", "gnu general", "gnu affero", "gnu lesser", "attribution 4", "sharealike 4",
            "noncommercial 4", "by 4", "nc 4", "sa 4", "apache license", "mit license", "mozilla public", "neither the name")
#: Share of a deciding phrase's shingles that a text must hold (a word beside it may differ).
DECIDED = 0.5


def _deciding(text: str, shingles: np.ndarray) -> list[np.ndarray]:
    """Per deciding phrase of a template, the shingles that contain it."""
    words = re.findall("[^ \\t-\\r!-/:-@\\[-`{-~]+", text.lower())
    out = []
    for phrase in (p.split() for p in DECIDING):
        for a in (a for a in range(len(words)) if words[a:a + len(phrase)] == phrase):
            out.append(shingles[max(0, a + len(phrase) - SHINGLE):a + 1])
    return out


def _words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, PUNCTUATION)


def _shingles(w: Words) -> np.ndarray:
    """Shingle hash at every word (across rows too: windows are checked for that)."""
    n = len(w.hash) - SHINGLE + 1
    total = np.zeros(max(n, 0), np.uint64)
    for j in range(SHINGLE if n > 0 else 0):
        total += w.hash[j:j + n] * np.uint64(2 * (j * 0x5851F42D4C957F2D % 2**62) + 1)
    return mix(total)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every run of ``width`` values."""
    span = 1
    while span < width:
        step = min(span, width - span)
        values = np.minimum(values[:-step], values[step:])
        span += step
    return values


def band_keys(shingles: np.ndarray, band: int) -> Iterator[tuple[int, np.ndarray]]:
    """(size, key of the band for every window start) for all window sizes."""
    hashes = [mix(shingles ^ np.uint64(0x9E3779B97F4A7C15 * (band * ROWS + r + 1) % 2**64)) for r in range(ROWS)]
    for size in SIZES:
        if len(shingles) < size - SHINGLE + 1:
            continue
        key = np.uint64(band * 64 + size)
        for h in hashes:
            key = mix(_least(h, size - SHINGLE + 1) + np.uint64(3) * key)
        yield size, key


class Templates:
    """The templates' band keys (of windows at every offset) and shingle sets."""

    def __init__(self, templates):
        self.names = [name for name, _ in templates]
        self.sets, self.words, self.deciding, keys, owners = [], [], [], [], []
        for i, (_, text) in enumerate(templates):
            w = _words(*text_buffers(pa.array([text], pa.large_string())))
            if len(w.hash) < SHINGLE:
                raise ValueError(f"template {i} has fewer than {SHINGLE} words")
            shingles = _shingles(w)
            self.sets.append(np.unique(shingles))
            self.words.append(len(w.hash))
            self.deciding.append(_deciding(text, shingles))
            best = max(s for s in SIZES if s <= len(w.hash))
            for band in range(BANDS):
                for size, key in band_keys(shingles, band):
                    if size == best:
                        keys.append(key)
                        owners.append(np.full(len(key), i))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.top = np.zeros(1 << 20, dtype=bool)
        self.top[self.keys >> np.uint64(44)] = True

    def retrieve(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``keys``, template) of all templates that share the band."""
        at = np.flatnonzero(self.top[keys >> np.uint64(44)])
        lo, hi = np.searchsorted(self.keys, keys[at]), np.searchsorted(self.keys, keys[at], side="right")
        counts = hi - lo
        own = np.repeat(np.arange(len(at)), counts)
        return at[own], self.owners[np.arange(counts.sum()) + (lo - np.cumsum(counts) + counts)[own]]


def find(t: Templates, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, int, int]]:
    """(row, template, containment, start byte, end byte) of a chunk's verified findings."""
    w = _words(data, offsets)
    if len(w.hash) < SHINGLE:
        return []
    shingles, rows = _shingles(w), w.row
    hits = []
    for band in range(BANDS):
        for size, keys in band_keys(shingles, band):
            place, template = t.retrieve(keys)
            whole = rows[place] == rows[place + size - 1]
            hits.append(np.stack([template[whole], place[whole], place[whole] + size], axis=1))
    hits = np.unique(np.concatenate(hits), axis=0)
    out = []
    at = 0
    while at < len(hits):
        # Windows of one template and row that lie within its length of each other are one finding.
        i, lo, hi = (int(x) for x in hits[at])
        n, row = t.words[i], int(rows[lo])
        at += 1
        while at < len(hits) and hits[at][0] == i and rows[hits[at][1]] == row and hits[at][1] <= hi + n:
            hi = max(hi, int(hits[at][2]))
            at += 1
        lo, hi = max(int(w.first[row]), lo - n), min(int(w.first[row + 1]), hi + n)
        around = shingles[lo:hi - SHINGLE + 1]
        held = np.isin(around, t.sets[i])
        share = len(np.unique(around[held])) / len(t.sets[i])
        if share >= CONTAINED and all(np.isin(d, around).mean() >= DECIDED for d in t.deciding[i]):
            inside = np.flatnonzero(held)
            begin = int(w.offsets[row])
            out.append((row, i, share, int(w.start[lo + inside[0]]) - begin, int(w.end[lo + inside[-1] + SHINGLE - 1]) - begin))
    return out


def scan(df: DataFrame, templates=TEMPLATES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per finding: doc_id, license, template, containment, start_byte, end_byte. No shuffle.

    The templates are sent to every task: a list of notices written in code, not a table."""
    kind = df.select(id_col).schema[0].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(Templates(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            found = [(lo + f[0], *f[1:]) for lo, hi in chunks(offsets) for f in find(t, data, offsets[lo:hi + 1])]
            if found:
                row, template, share, start, end = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array([t.names[i] for i in template]), pa.array(template, pa.int32()),
                     pa.array(share, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    names=["doc_id", "license", "template", "containment", "start_byte", "end_byte"])

    return df.select(df[id_col], df[text_col]).mapInArrow(
        run, f"doc_id {kind}, license string, template int, containment double, start_byte long, end_byte long")
