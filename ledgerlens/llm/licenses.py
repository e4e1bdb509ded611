"""Licence scan by MinHash bands over overlapping text windows.

Templates are licence notices, cut into windows of at most 32 shingles that
overlap by half. Texts are cut into windows of twice as many shingles, again
overlapping by half, so that whatever run of a template window's length is
inside one of them. Windows are compared by MinHash: one that agrees on a band
with a template window retrieves that template. Bands have one row, and there
are ``BANDS`` of them: with four fifths of a template window inside a text
window their similarity is 0.36 at least, and (1 - 0.36) ** 52 < 1e-9 is the
probability of a miss. Only windows with a template's shingle are hashed; no
other can agree.

A template retrieved is verified exactly: the share of its shingles that the
whole text has, against ``CONTAINMENT``. Shingles have five words, or all words
of a shorter notice. Words are runs of letters, digits and bytes beyond ASCII,
lower-cased (A to Z).

Texts are read in place, whole, and nothing is shuffled; templates are a
parameter of bounded size. Null and empty texts hold no licence. Repeated rows
give repeated results. An empty table gives an empty result. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, hashed_words, mix64, slices

by_value(__name__)

SHINGLE = 5
CONTAINMENT = 0.8
BANDS = 52
# Largest number of template bytes that is sent to the tasks.
MAX_TEMPLATE_BYTES = 16_000_000
# Bytes between words: ASCII that is no letter or digit.
BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

# Wordings of licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
    "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions:",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
    "version.",
}


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for every ``k`` consecutive words; of two different sequences equal only by chance."""
    n = len(words) - k + 1
    out = np.full(max(0, n), k, np.uint64)
    for i in range(k if n > 0 else 0):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return out


def lanes(tokens: np.ndarray, bands: int) -> np.ndarray:
    """Hashes of each shingle under every band's permutation (shingle x band)."""
    seeds = mix64(np.arange(1, bands + 1, dtype=np.uint64))
    return mix64(tokens[:, None] ^ seeds[None, :])


class Notices:
    """Templates by shingle size, with the MinHash bands of their windows."""

    def __init__(self, templates: dict[str, str], bands: int, share: float):
        self.bands, self.share = bands, share
        self.names = list(templates)
        self.groups: list[dict] = []
        every, begin = hashed_words(pa.record_batch([pa.array(list(templates.values()), pa.string())], ["text"]), "text", True, BETWEEN)
        words = [every[a:b] for a, b in zip(begin[:-1], begin[1:])]
        by_size: dict[tuple[int, int], list[int]] = {}
        for i, w in enumerate(words):
            if len(w):
                count = max(1, len(w) - min(SHINGLE, len(w)) + 1)
                by_size.setdefault((min(SHINGLE, len(w)), min(32, 1 << (count - 1).bit_length())), []).append(i)
        for (k, span), mine in sorted(by_size.items()):
            keys: list[dict[int, set[int]]] = [{} for _ in range(bands)]
            sets = {}
            for i in mine:
                every = shingles(words[i], k)
                sets[i] = np.unique(every)
                for start in range(0, max(1, len(every) - span // 2), max(1, span // 2)):
                    low = lanes(every[start : start + span], bands).min(0)
                    for band, key in enumerate(low.tolist()):
                        keys[band].setdefault(key, set()).add(i)
            every = np.unique(np.concatenate([sets[i] for i in mine]))
            self.groups.append({"k": k, "span": span, "keys": keys, "sets": sets, "all": every})

    def retrieved(self, group: dict, tokens: np.ndarray) -> set[int]:
        """Templates that share a band with some window of the text."""
        step = group["span"]
        at = np.flatnonzero(np.isin(tokens, group["all"])) // step
        found: set[int] = set()
        for start in np.unique(np.maximum(0, np.concatenate([at, at - 1]))).tolist():
            low = lanes(tokens[start * step : (start + 2) * step], self.bands).min(0)
            for band, key in enumerate(low.tolist()):
                found |= group["keys"][band].get(key, set())
        return found

    def find(self, words: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, template, its shingles that the text has, its shingles) of every template that a text contains."""
        out = []
        for group in self.groups:
            k = group["k"]
            tokens = shingles(words, k)
            rows = np.unique(np.searchsorted(begin, np.flatnonzero(np.isin(tokens, group["all"])), side="right") - 1)
            for row in rows.tolist():
                # Shingles that reach into the next text are left out.
                mine = tokens[begin[row] : max(begin[row], begin[row + 1] - k + 1)]
                have = np.unique(mine)
                for i in self.retrieved(group, mine):
                    template = group["sets"][i]
                    shared = int(np.isin(template, have, assume_unique=True).sum())
                    if shared >= self.share * len(template) - 1e-9:
                        out.append((row, i, shared, len(template)))
        return sorted(out)


def find_notices(templates: dict[str, str], bands: int, share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notices = Notices(templates, bands, share)
        for batch in batches:
            for part, _ in slices(batch, "text"):
                doc_id = part.column("doc_id").to_pylist()
                rows = [
                    {"doc_id": doc_id[row], "license": notices.names[i], "n_shared": shared, "n_shingles": size}
                    for row, i, shared, size in notices.find(*hashed_words(part, "text", True, BETWEEN))
                ]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([
                        ("doc_id", pa.int64()), ("license", pa.string()), ("n_shared", pa.int64()), ("n_shingles", pa.int64()),
                    ]))

    return run


def licences(docs: DataFrame, templates: dict[str, str] | None = None, bands: int = BANDS, share: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, n_shared, n_shingles): every template of which a text has the share of shingles."""
    templates = TEMPLATES if templates is None else templates
    if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
        raise ValueError("templates are too large to be sent to the tasks; scan with a part of them at a time")
    given = docs.select(col("doc_id").cast("long"), "text").filter(F.length("text") > 0)
    return given.mapInArrow(find_notices(templates, bands, share), "doc_id long, license string, n_shared long, n_shingles long")


def op4_licenses(docs: DataFrame) -> DataFrame:
    return licences(docs)
