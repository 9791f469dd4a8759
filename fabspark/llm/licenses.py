"""License scan: winnowed fingerprints of templates, then banded alignment of the candidates.

Four-word hashes of every template are winnowed: of each few in a row the smallest enters the
inverted index; a short notice also enters it with the word pairs around the word that tells it. All four-word hashes of a document are looked up, so a fingerprint is found
wherever it stands. Hits of one template near one diagonal are one candidate, and a banded
alignment of the template against that part of the document gives what is matched and where. Of
relatives, such as the BSD or GNU licenses, a passage is only taken for the one whose telling words
it holds, and of overlapping passages the one with more matched words stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.text import buffers, column, pieces, spans, windows, word_hashes

GRAM = 4
SHORT = 16  # templates below this many words are also found by the pairs around their first telling word
WINDOW = 4
BAND = 12
COVERAGE = 0.75
REPORT = ("doc_id long, license string, coverage double, matched int, template_words int, "
          "spans array<struct<first_byte:int,last_byte:int,coverage:double>>")

# Public license notices and passages.
MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
             "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
             "is furnished to do so")
MIT_NOTICE = ("subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
              "substantial portions of the Software.")
BSD_SOURCE = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
              "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
              "following disclaimer.")
BSD_BINARY = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
              "in the documentation and/or other materials provided with the distribution.")
BSD_ADVERT = "All advertising materials mentioning features or use of this software must display the following acknowledgement:"
BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
             "from this software without specific prior written permission.")
ISC_USE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
ISC_NOTICE = "provided that the above copyright notice and this permission notice appear in all copies."
GNU_USE = ("This {work} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the "
           "Free Software Foundation{stop} either version {version} of the License, or (at your option) any later version.")
GNU_SHORT = "This work is licensed under the GNU {name}, version {version}."
GNU = [  # SPDX name, name in the notice, version, work, words that tell it from its relatives, words that belong to these
    ("GPL-2.0", "General Public License", "2", "program", "general 2", "lesser library affero 3"),
    ("GPL-3.0", "General Public License", "3", "program", "general 3", "lesser library affero"),
    ("LGPL-2.0", "Library General Public License", "2", "library", "general 2", "lesser affero 1"),
    ("LGPL-2.1", "Lesser General Public License", "2.1", "library", "lesser 2 1", "affero"),
    ("LGPL-3.0", "Lesser General Public License", "3", "library", "lesser 3", "affero"),
    ("AGPL-3.0", "Affero General Public License", "3", "program", "affero 3", "lesser"),
]
CC_PARTS = [("SA", "ShareAlike"), ("NC", "NonCommercial"), ("ND", "NoDerivatives")]
CC_KINDS = ["", "SA", "NC", "ND", "NC-SA", "NC-ND"]
CC_VERSIONS = [("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]
OTHERS = [  # SPDX name, text, words that must be in the passage, words that must not
    ("MIT", "Released under the MIT License.", "mit", ""),
    ("MIT", "Licensed under the MIT License.", "mit", ""),
    ("MIT", f"{MIT_GRANT}, {MIT_NOTICE}", "sublicense included", ""),
    ("MIT-0", f"{MIT_GRANT}.", "sublicense", "included"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2", ""),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache 2", ""),
    ("BSD-2-Clause", f"{BSD_SOURCE} {BSD_BINARY}", "binary reproduce", "endorse advertising"),
    ("BSD-3-Clause", f"{BSD_SOURCE} {BSD_BINARY} {BSD_NAMES}", "reproduce endorse", "advertising"),
    ("BSD-4-Clause", f"{BSD_SOURCE} {BSD_BINARY} {BSD_ADVERT} {BSD_NAMES}", "advertising endorse", ""),
    ("ISC", f"{ISC_USE}, {ISC_NOTICE}", "fee appear", ""),
    ("0BSD", f"{ISC_USE}.", "fee", "appear"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
                "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mozilla 2", ""),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered", ""),
]


class Template(NamedTuple):
    """A passage, words that must stand in what it matches, and words that must not, as they tell a relative."""

    license: str
    text: str
    needs: str = ""
    bars: str = ""


def gnu_templates() -> list[Template]:
    out = []
    for spdx, name, version, work, needs, bars in GNU:
        old = version[0] == "2"
        out.append(Template(spdx, GNU_SHORT.format(name=name, version=version), needs, bars))
        # Up to version 2 the notice has semicolons, later ones have a colon and a comma; either may name a program or a library.
        for kind in ("program", "library"):
            own = bars if not (spdx == "GPL-2.0" or spdx == "GPL-3.0") or kind == "program" else bars.replace("library ", "")
            out.append(Template(spdx, GNU_USE.format(work=kind, mark=";" if old else ":", stop=";" if old else ",", name=name, version=version), needs, own))
    return out


def creative_templates() -> list[Template]:
    out = []
    for version, region in CC_VERSIONS:
        major, minor = version.split(".")
        number = (f"{major} {minor}" if minor != "0" else major, "5" if version == "2.0" else "")
        for kind in CC_KINDS:
            own = [k for k in kind.split("-") if k]
            words = dict(CC_PARTS) | ({"ND": "NoDerivs"} if version != "4.0" else {})
            rest = [k for k, _ in CC_PARTS if k not in own]
            name = "-".join(["BY", *own])
            long = "-".join(["Attribution", *[words[k] for k in own]])
            out.append(Template(f"CC-{name}-{version}", f"Licensed under CC {name} {version}.",
                                f"cc {' '.join(own).lower()} {number[0]}", f"{' '.join(rest).lower()} {number[1]}"))
            out.append(Template(f"CC-{name}-{version}", f"This work is licensed under a Creative Commons {long} {version} {region} License.",
                                f"creative {' '.join(words[k] for k in own).lower()} {number[0]}", f"{' '.join(words[k] for k in rest).lower()} {number[1]}"))
    return out


TEMPLATES = [*(Template(*t) for t in OTHERS), *gnu_templates(), *creative_templates()]

_LETTERS = np.zeros(256, np.uint8)
_LETTERS[128:] = 1
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1


def word_rows(texts: pa.Array):
    """Hashes, first and last bytes of words (letters and digits), words before each row, and row starts."""
    data, offsets = buffers(texts)
    starts, ends, first = spans(data, offsets, _LETTERS)
    return word_hashes(data, starts, ends, gaps=True), starts, ends, first, offsets


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the smallest hash of each run of ``window``; of equal ones the last."""
    picks = set()
    for start in range(max(1, len(grams) - window + 1)):
        part = grams[start:start + window]
        picks.add(start + len(part) - 1 - int(np.argmin(part[::-1])))
    return np.array(sorted(picks), np.int64)


def hashes_of(text: str) -> np.ndarray:
    return word_rows(pa.array([text], pa.string()))[0]


def index_of(templates: list[Template]) -> tuple[list[np.ndarray], dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """Word hashes per template, and per gram width the inverted index: sorted fingerprints, their templates and places."""
    value, _, _, first, _ = word_rows(pa.array([t.text for t in templates], pa.string()))
    index = {}
    for width in (GRAM, 2):
        grams, before = windows(value, first, width)
        found, owner, place = [], [], []
        for k, t in enumerate(templates):
            own = grams[before[k]:before[k + 1]]
            if width == GRAM:
                picks = winnow(own) if len(own) else np.zeros(0, np.int64)
            else:
                telling = np.flatnonzero(value[first[k]:first[k + 1]] == hashes_of(t.needs)[0]) if t.needs.strip() and first[k + 1] - first[k] < SHORT else []
                picks = np.array(sorted({p for at in telling for p in (at - 1, at) if 0 <= p < len(own)}), np.int64)
            found.append(own[picks])
            owner.append(np.full(len(picks), k))
            place.append(picks)
        found, owner, place = (np.concatenate(x) for x in (found, owner, place))
        order = np.argsort(found, kind="stable")
        index[width] = found[order], owner[order], place[order]
    return [value[a:b] for a, b in zip(first[:-1], first[1:])], index


def align(template: np.ndarray, part: np.ndarray, shift: int, band: int = BAND) -> tuple[int, int, int]:
    """Matched words, first and last matched word of ``part``.

    Best alignment of the whole template with free ends in ``part``, where template word i may
    meet the words ``i + shift - band`` to ``i + shift + band``; as many matches as possible, and
    of equal ones the shortest part.
    """
    width, none = 2 * band + 1, -(1 << 40)
    score = np.zeros(width, np.int64)  # matches * 2^20 - words of the part that are skipped inside
    begin = np.full(width, -1, np.int64)
    stop = np.full(width, -1, np.int64)
    for i, word in enumerate(template):
        at = i + shift - band + np.arange(width)
        inside = (at >= 0) & (at < len(part))
        hit = inside & (part[np.clip(at, 0, len(part) - 1)] == word) if len(part) else inside
        # Column j stands for "part consumed up to at[j]"; the diagonal keeps the column.
        up = np.append(score[1:], none)  # template word without partner
        up_begin, up_stop = np.append(begin[1:], -1), np.append(stop[1:], -1)
        gain = score + np.where(hit, 1 << 20, 0)
        new = np.where(gain >= up, gain, up)
        came = gain >= up
        matched = came & hit
        new_begin = np.where(came, np.where(matched & (begin < 0), at, begin), up_begin)
        new_stop = np.where(matched, at, np.where(came, stop, up_stop))
        for j in range(1, width):  # words of the part without partner
            cost = 1 if new_begin[j - 1] >= 0 else 0
            if new[j - 1] - cost > new[j]:
                new[j], new_begin[j], new_stop[j] = new[j - 1] - cost, new_begin[j - 1], new_stop[j - 1]
        score, begin, stop = new, new_begin, new_stop
    best = int(np.argmax(score))
    return int((score[best] + (1 << 19)) >> 20), int(begin[best]), int(stop[best])


def scan(docs: DataFrame, templates: list[tuple] | None = None, text: str = "text", doc_id: str = "doc_id",
         coverage: float = COVERAGE, band: int = BAND) -> DataFrame:
    """Licenses of each document: ``doc_id``, ``license``, ``coverage``, ``matched``, ``template_words``, ``spans``.

    One row per row of ``docs`` and license with a passage of which at least ``coverage`` of a
    template's words are matched; the figures are those of its best passage, ``spans`` has all, as
    bytes of the UTF-8 text. ``templates`` are tuples as :class:`Template`. Where passages of templates
    overlap, the one with more matched words stands, then the one with the larger share, then the
    earlier template.
    Documents without one, null and empty texts give no row; equal rows give equal rows; other
    columns are ignored.
    """
    templates = [Template(*t) for t in templates or TEMPLATES]

    def passages(value: np.ndarray, hits: set[tuple[int, int]], words: list[np.ndarray], telling: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, int, int, int, int]]:
        """(coverage, matched, template, first word, last word), best first, without overlaps."""
        reach = [min(band, len(w) // 2) for w in words]  # so that a short notice does not reach the next one
        tries: dict[tuple[int, int], int] = {}
        last: dict[int, int] = {}
        for diagonal, k in sorted(hits):
            if k not in last or diagonal - last[k] > reach[k]:
                last[k] = diagonal
                tries[k, diagonal] = diagonal
        found = []
        for (k, _), diagonal in tries.items():
            size = len(words[k])
            low = max(0, diagonal - reach[k])
            matched, a, b = align(words[k], value[low:diagonal + size + 2 * reach[k]], diagonal - low, reach[k])
            if matched and matched / size >= coverage:
                held, (needs, bars) = value[low + a:low + b + 1], telling[k]
                if np.isin(needs, held).all() and not np.isin(bars, held).any():
                    found.append((matched / size, matched, k, low + a, low + b))
        kept: list[tuple[float, int, int, int, int]] = []
        for x in sorted(found, key=lambda x: (-x[1], -x[0], x[2], x[3])):
            if all(x[4] < y[3] or x[3] > y[4] for y in kept):
                kept.append(x)
        return kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, index = index_of(templates)
        telling = [(hashes_of(t.needs), hashes_of(t.bars)) for t in templates]
        for batch in batches:
            rows: list[dict] = []
            for start, texts in pieces(column(batch.column("text"))):
                value, begins, ends, first, offsets = word_rows(texts)
                per_row: dict[int, set[tuple[int, int]]] = {}
                for width, (known, owner, place) in index.items():
                    grams, before = windows(value, first, width)
                    low, high = np.searchsorted(known, grams, "left"), np.searchsorted(known, grams, "right")
                    seen = np.flatnonzero(high > low)
                    owners = np.searchsorted(before, seen, "right") - 1
                    for g, r in zip(seen.tolist(), owners.tolist()):
                        per_row.setdefault(r, set()).update(
                            (g - int(before[r]) - int(place[h]), int(owner[h])) for h in range(low[g], high[g]))
                for r, hits in per_row.items():
                    a, own = first[r], {}
                    for cover, matched, k, x, y in passages(value[a:first[r + 1]], hits, words, telling):
                        span = {"first_byte": int(begins[a + x] - offsets[r]), "last_byte": int(ends[a + y] - offsets[r]), "coverage": cover}
                        row = own.setdefault(templates[k].license, {
                            "doc_id": batch.column("doc_id")[start + r].as_py(), "license": templates[k].license, "coverage": cover,
                            "matched": matched, "template_words": len(words[k]), "spans": []})
                        row["spans"].append(span)
                    rows += own.values()
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                    ("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int32()),
                    ("template_words", pa.int32()), ("spans", pa.list_(pa.struct([
                        ("first_byte", pa.int32()), ("last_byte", pa.int32()), ("coverage", pa.float64())])))]))

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, REPORT)
