"""License templates in texts: MinHash bands over overlapping windows, then exact containment.

Texts and templates are lower-cased alphanumeric words and their 5-word shingles.
Templates of up to s shingles (s a power of two) are looked for in windows of 2s
shingles, one every s, so each occurrence lies inside a window. Window minima of
a level are the minima of two neighbours one level below, so all levels together
cost little more than the lowest. A band is one MinHash. An occurrence with the
least containment has a known least Jaccard similarity with its window, and the
number of bands is chosen so that all of them miss with a probability of at most
``MISS``. A window that shares a band with a template is verified: the share of
the template's shingles inside must reach ``CONTAINMENT``.

Whole texts are scanned where they are read; nothing is shuffled, and templates,
whose number and length the caller fixes, travel with the function.

Defined results: null texts and texts of fewer than five words match nothing;
each template is reported once per document, with its largest containment and the
first place where that is reached; templates of fewer than five words are refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import ALPHANUMERIC, Words, mix, slices

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-4

# Notices and opening or closing sentences of public licenses.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
           "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
               "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def least_similarity(size: int, level: int, containment: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a template of ``size`` shingles and a window of 2 * ``level`` that contains it."""
    shared = math.ceil(containment * size)
    return shared / (size + 2 * level - shared)


def bands_needed(similarity: float, miss: float = MISS) -> int:
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log(1 - similarity))


class Templates:
    """Shingles and MinHash values of the templates, by level."""

    def __init__(self, texts: Mapping[str, str], containment: float = CONTAINMENT, miss: float = MISS):
        self.names, self.containment = sorted(texts), containment
        self.shingles, self.levels = [], {}
        for at, name in enumerate(self.names):
            words = Words(pa.array([texts[name]]), ALPHANUMERIC)
            if len(words.hashes) < SHINGLE:
                raise ValueError(f"template {name} has fewer than {SHINGLE} words")
            self.shingles.append(np.unique(words.window_hashes(SHINGLE)))
            self.levels.setdefault(1 << (len(self.shingles[-1]) - 1).bit_length(), []).append(at)
        self.bands = {level: max(bands_needed(least_similarity(len(self.shingles[at]), level, containment), miss)
                                 for at in members) for level, members in self.levels.items()}
        self.keys = mix(np.arange(1, max(self.bands.values(), default=0) + 1, dtype=np.uint64)) | np.uint64(1)
        self.minima = [[int((s * k).min()) for k in self.keys] for s in self.shingles]

    def candidates(self, shingles: np.ndarray) -> set[tuple[int, int]]:
        """(template, first shingle of a window) that share a band; windows may reach over document ends."""
        found: set[tuple[int, int]] = set()
        for band, key in enumerate(self.keys):
            level, blocks = 1, shingles * key
            for wanted in sorted(self.levels):
                while level < wanted and len(blocks):
                    blocks = np.minimum(blocks[::2], np.append(blocks[1::2], blocks[-1:] if len(blocks) % 2 else blocks[:0]))
                    level *= 2
                if band < self.bands[wanted] and len(blocks):
                    windows = np.minimum(blocks, np.append(blocks[1:], blocks[-1:]))
                    for at in self.levels[wanted]:
                        found.update((at, int(w) * wanted) for w in np.flatnonzero(windows == np.uint64(self.minima[at][band])))
        return found

    def matches(self, texts: pa.Array) -> list[list[dict]]:
        """For each text the templates that it contains."""
        words = Words(texts, ALPHANUMERIC)
        shingles = words.window_hashes(SHINGLE)
        best: list[dict[int, tuple[float, int, int]]] = [{} for _ in range(len(texts))]
        for at, start in sorted(self.candidates(shingles)) if len(shingles) else ():
            mine, stop = self.shingles[at], min(start + 2 * (1 << (len(self.shingles[at]) - 1).bit_length()), len(shingles))
            doc = int(np.searchsorted(words.bounds, start, side="right")) - 1
            while doc < len(texts) and words.bounds[doc] < stop:
                first, last = max(start, words.bounds[doc]), min(stop, words.bounds[doc + 1] - SHINGLE + 1)
                places = first + np.flatnonzero(np.isin(shingles[first:last], mine)) if last > first else np.zeros(0, int)
                share = len(np.unique(shingles[places])) / len(mine)
                if share >= self.containment and (at not in best[doc] or share > best[doc][at][0]):
                    base = words.offsets[doc]
                    best[doc][at] = (share, int(words.starts[places[0]] - base), int(words.ends[places[-1] + SHINGLE - 1] - base))
                doc += 1
        return [[{"license": self.names[at], "containment": share, "first_byte": a, "end_byte": b}
                 for at, (share, a, b) in sorted(found.items())] for found in best]


MATCHES = T.ArrayType(T.StructType([T.StructField("license", T.StringType()), T.StructField("containment", T.DoubleType()),
                                    T.StructField("first_byte", T.LongType()), T.StructField("end_byte", T.LongType())]))


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, text_col: str = "text",
         matches_col: str = "licenses", containment: float = CONTAINMENT) -> DataFrame:
    """All rows and columns and an array of matches (an existing column of that name is replaced)."""
    known = Templates(TEMPLATES if templates is None else templates, containment)
    rows = docs.drop(matches_col)
    schema = T.StructType([*rows.schema, T.StructField(matches_col, MATCHES)])
    at = rows.schema.names.index(text_col)
    kind = pa.list_(pa.struct([("license", pa.string()), ("containment", pa.float64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(known.matches(part.column(at)), kind)], names=schema.names)

    return rows.mapInArrow(run, schema)
