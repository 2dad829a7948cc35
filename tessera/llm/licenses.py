"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Templates are partitioned by size: class k holds those of at most ``2**k``
five-word shingles. A text is cut into blocks of ``2**(k-1)`` shingles; a
window is three blocks and the next begins one block later, so every stretch
of ``2**k`` shingles lies whole in a window. A template with 0.8 of its
shingles in a window has a Jaccard similarity of at least 0.8 * (2**(k-1) + 1)
/ (1.5 * 2**k + 0.2 * 2**k) > 0.23 to it. With ``BANDS`` bands of one row the
chance that no band agrees is below 0.77**96 < 2e-11, and below 0.67**96 for
one-shingle templates. A minimum over a window is the least of its blocks'
minima, so a band costs one pass over the text for all classes together.

Work stays inside the task that reads the text: nothing is shuffled, and a
source or group of copies with very many rows is spread like any rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tessera.llm.shared import by_text_size, map_batches
from tessera.llm.shingles import mix, shingle_hashes, word_hashes

THRESHOLD = 0.8
BANDS = 96
MAX_TEMPLATES = 4096
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)

# Parts that licences share, and the two that tell BSD-2 from BSD-3.
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met")
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE ")


def _gnu(name: str, version: str) -> str:
    """Short enough that another member of the family or another version leaves less than the threshold of it."""
    return (f"the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License")


#: Notices that projects place in their files, and whole short licences, by licence name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "Apache-2.0-title": "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE",
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        f"the Software. {_WARRANTY}AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": _gnu("General Public License", "3"),
    "GPL-2.0-notice": _gnu("General Public License", "2"),
    "GPL-3.0-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June",
    "GPL-2.0-title": "GNU GENERAL PUBLIC LICENSE Version 2, June",
    "LGPL-3.0-notice": _gnu("Lesser General Public License", "3"),
    "LGPL-2.1-notice": _gnu("Lesser General Public License", "2.1"),
    "LGPL-3.0-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "LGPL-2.1-title": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "AGPL-3.0-notice": _gnu("Affero General Public License", "3"),
    "AGPL-3.0-title": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."),
    "CC0-1.0-title": "Creative Commons Legal Code CC0 1.0 Universal",
    "BSD-conditions": _BSD_CONDITIONS,
    "BSD-2-Clause": (
        "documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE"),
    "BSD-3-Clause": (
        "nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author "
        "or authors of this software dedicate any and all copyright interest in the software to the public domain. We make "
        "this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend "
        "this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this "
        f"software under copyright law. {_WARRANTY}AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}
#: Notices of one to four words, found word for word.
SHORT_NOTICES = {
    "All-rights-reserved": "All rights reserved.",
    "MIT-SPDX": "SPDX-License-Identifier: MIT",
    "ISC-SPDX": "SPDX-License-Identifier: ISC",
    "Unlicense-SPDX": "SPDX-License-Identifier: Unlicense",
}


def _seeds(bands: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, bands + 1, dtype=np.uint64)
    return mix(n * np.uint64(0x9E3779B97F4A7C15)), mix(n * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def _prepared(templates: dict[str, str], bands: int) -> list[tuple[int, list[str], list[np.ndarray], np.ndarray]]:
    """Per size class: exponent, names, distinct shingles and ``(bands, templates)`` minima."""
    if len(templates) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    xor, factor = _seeds(bands)
    classes: dict[int, list[tuple[str, np.ndarray]]] = {}
    for name, text in sorted(templates.items()):
        shingles = np.unique(shingle_hashes([text])[0])
        if not len(shingles) or len(word_hashes([text])[0]) < 5:
            raise ValueError(f"template {name!r} has fewer than five words")
        classes.setdefault(max(1, int(np.ceil(np.log2(len(shingles))))), []).append((name, shingles))
    return [(k, [n for n, _ in found], [s for _, s in found],
             np.stack([((s[None, :] ^ xor[:, None]) * factor[:, None]).min(axis=1) for _, s in found], axis=1))
            for k, found in sorted(classes.items())]


def scan_texts(texts: list[str], prepared: list, bands: int, threshold: float) -> list[tuple[int, str, int, int, int]]:
    """``(text, template, template shingles, shared shingles, first shingle)`` of the best window of every match."""
    hashes, owner = shingle_hashes(texts)
    if not len(hashes):
        return []
    widest = 1 << (prepared[-1][0] - 1)
    sizes = np.bincount(owner, minlength=len(texts))
    padded = -(-sizes // widest) * widest
    starts = np.cumsum(padded) - padded
    place = starts[owner] + np.arange(len(hashes)) - (np.cumsum(sizes) - sizes)[owner]
    line = np.zeros(int(padded.sum()), np.uint64)
    empty = np.ones(len(line), bool)
    line[place], empty[place] = hashes, False
    text_at = np.full(len(line) // widest, 0, np.int64)
    text_at[place // widest] = owner
    hits: list[set[tuple[int, int]]] = [set() for _ in prepared]
    xor, factor = _seeds(bands)
    for band in range(bands):
        values = (line ^ xor[band]) * factor[band]
        values[empty] = _FULL
        least, width = values, 1
        for c, (k, _, _, minima) in enumerate(prepared):
            while width < 1 << (k - 1):
                least, width = np.minimum(least[::2], least[1::2]), width * 2
            window = least.copy()
            for shift in (1, 2):
                np.minimum(window[:-shift], least[shift:], out=window[:-shift])
            for t, value in enumerate(minima[band]):
                hits[c].update((int(i), t) for i in np.flatnonzero(window == value))
    best: dict[tuple[int, str], tuple[int, int, int]] = {}
    for (k, names, shingles, _), found in zip(prepared, hits):
        width = 1 << (k - 1)
        for i, t in found:
            doc = int(text_at[i * width // widest])
            # one block more on either side: a template with words put in is longer than its class
            lo = max(int(starts[doc]), (i - 1) * width)
            hi = min(int(starts[doc] + sizes[doc]), (i + 4) * width)
            part = line[lo:hi]
            wanted = shingles[t]
            shared = len(np.intersect1d(part, wanted))
            if shared >= threshold * len(wanted):
                first = lo - int(starts[doc]) + int(np.flatnonzero(np.isin(part, wanted))[0])
                new, old = (shared, -first, len(wanted)), best.get((doc, names[t]))
                if old is None or new > old:
                    best[doc, names[t]] = new
    return [(doc, name, n, shared, -first) for (doc, name), (shared, first, n) in sorted(best.items())]


def _prepared_notices(notices: dict[str, str]) -> list[tuple[str, np.ndarray]]:
    found = [(name, word_hashes([text])[0]) for name, text in sorted(notices.items())]
    for name, words in found:
        if not 1 <= len(words) <= 4:
            raise ValueError(f"notice {name!r} doesn't have one to four words")
    return found


def find_notices(texts: list[str], prepared: list[tuple[str, np.ndarray]]) -> list[tuple[int, str, int, int, int]]:
    """Rows like those of ``scan_texts`` for notices below five words: one shingle of the notice's own length."""
    words, owner = word_hashes(texts) if prepared else (np.empty(0, np.uint64), np.empty(0, np.int64))
    start = np.searchsorted(owner, np.arange(len(texts)))
    out = []
    for name, wanted in prepared:
        at = np.flatnonzero(words == wanted[0])
        at = at[at + len(wanted) <= len(words)]
        for k, word in enumerate(wanted):
            at = at[(words[at + k] == word) & (owner[at + k] == owner[at])]
        docs, first = np.unique(owner[at], return_index=True)
        out += [(int(d), name, 1, 1, int(at[f] - start[d])) for d, f in zip(docs, first)]
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
         bands: int = BANDS, notices: dict[str, str] | None = None) -> DataFrame:
    """``(doc_id, license, n_template, n_shared, containment, first_word)`` for every template found in a document.

    ``docs(doc_id, text)``; other columns are ignored. One row per document
    row and template, for the window that holds most of the template (ties:
    the earliest); ``first_word`` is the number of words before the first
    shared shingle there. Shingles are five lower-cased words; null texts and
    texts of fewer than five words match nothing. Repeated rows are scanned
    one by one, a null doc_id stays null, an empty table gives no rows. A
    template needs five words; there may be ``MAX_TEMPLATES`` of them.
    ``notices`` of one to four words are found word for word, in texts of any
    length, as one shingle of their own length.
    """
    prepared = _prepared(TEMPLATES if templates is None else templates, bands)
    short = _prepared_notices(notices or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in by_text_size(batches, "text"):
            texts = b["text"].tolist()
            found = scan_texts(texts, prepared, bands, threshold) + find_notices(texts, short)
            if found:
                row, name, n, shared, first = zip(*found)
                yield pd.DataFrame({
                    "doc_id": b["doc_id"].astype("Int64").iloc[list(row)].array, "license": name, "n_template": n,
                    "n_shared": shared, "containment": np.round(np.array(shared) / np.array(n), 6), "first_word": first})

    rows = docs.select("doc_id", "text").where("text is not null")
    return map_batches(rows, run, "doc_id long, license string, n_template long, n_shared long, containment double, "
                                  "first_word long")
