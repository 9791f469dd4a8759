"""Notices of license families, near misses among them, against a plain aligner."""

import re

import pytest

from fabspark.llm import licenses as L

GNU = ("This {0} is free software; you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software "
       "Foundation; either version {2} of the License, or (at your option) any later version.")
BSD2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
        "met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n"
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.")
NAMES = ("3. Neither the name of Acme nor the names of its contributors may be used to endorse or promote products derived from this software "
         "without specific prior written permission.")
ADVERT = ("3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes "
          "software developed by Acme.\n4." + NAMES[2:])
GRANT = L.MIT_GRANT
ISC = L.ISC_USE
NOTICES = [
    (BSD2, {"BSD-2-Clause"}), (f"{BSD2}\n{NAMES}", {"BSD-3-Clause"}), (f"{BSD2}\n{ADVERT}", {"BSD-4-Clause"}), (BSD2.upper(), {"BSD-2-Clause"}),
    (f"Copyright 2020 Acme.\n{BSD2}\nTHIS SOFTWARE IS PROVIDED AS IS", {"BSD-2-Clause"}), (f"{BSD2} {NAMES.replace('specific ', '')}", {"BSD-3-Clause"}),
    (GNU.format("program", "General Public License", "2"), {"GPL-2.0"}), (GNU.format("program", "General Public License", "3"), {"GPL-3.0"}),
    (GNU.format("library", "Lesser General Public License", "2.1"), {"LGPL-2.1"}), (GNU.format("library", "Lesser General Public License", "3"), {"LGPL-3.0"}),
    (GNU.format("library", "Library General Public License", "2"), {"LGPL-2.0"}), (GNU.format("program", "Affero General Public License", "3"), {"AGPL-3.0"}),
    (GNU.format("program", "Lesser General Public License", "2.1"), {"LGPL-2.1"}), (GNU.format("library", "General Public License", "2"), {"GPL-2.0"}),
    (GNU.format("software", "Affero General Public License", "3"), {"AGPL-3.0"}), (GNU.format("program", "General Public License", "4"), set()),
    *[(f"This work is licensed under the GNU {n}, version {v}.", {s}) for s, n, v, *_ in L.GNU],
    ("This work is licensed under the GNU General Public License, version 1.", set()),
    *[(f"Licensed under CC {k} {v}.", {f"CC-{k}-{v}"}) for v in ("2.0", "2.5", "3.0", "4.0") for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")],
    ("Licensed under CC BY 1.0.", set()), ("licensed as CC BY-SA 4.0", {"CC-BY-SA-4.0"}),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", {"CC-BY-3.0"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", {"CC-BY-NC-SA-4.0"}),
    ("This work is licensed under a Creative Commons Attribution-NoDerivs 2.5 Generic License.", {"CC-BY-ND-2.5"}),
    ("This text is licensed under the Creative Commons Attribution-ShareAlike 3.0 License.", {"CC-BY-SA-3.0"}),
    (f"{GRANT}, {L.MIT_NOTICE}", {"MIT"}), (f"{GRANT}.", {"MIT-0"}), (f"{ISC}, {L.ISC_NOTICE}", {"ISC"}), (f"{ISC}.", {"0BSD"}),
    ("Released under the MIT License.", {"MIT"}), ("Licensed under the BSD License.", set()), ("Licensed under the Apache License, Version 2.0.", {"Apache-2.0"}),
    ("Licensed under the Apache License, Version 1.1.", set()), ("Released under an MIT License", {"MIT"}), ("Released under the old License.", set()),
    ("mit dem und mit der Lizenz", set()), ("This is free and unencumbered software released into the public domain.", {"Unlicense"}),
    ("This is free software released into the public domain.", set()), (None, set()), ("", set()), (f"{BSD2} " * 3, {"BSD-2-Clause"}),
    ("word " * 20_000 + BSD2 + " word" * 20_000, {"BSD-2-Clause"}), ("Licensed under CC BY 4.0. Licensed under CC BY-SA 4.0.", {"CC-BY-4.0", "CC-BY-SA-4.0"}),
]


def common(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def words(text):
    return re.findall(r"[0-9a-z]+", (text or "").lower())


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, 1) for i, (t, _) in enumerate(NOTICES)] + [(0, NOTICES[0][0], 1)]
    out = {}
    for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string, matched int").repartition(4)).collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_licenses_are_named_right(found):
    assert len(NOTICES) >= 60
    wrong = [(t[:80], want, {r["license"] for r in found.get(i, [])}) for i, (t, want) in enumerate(NOTICES) if want != {r["license"] for r in found.get(i, [])}]
    assert not wrong, wrong
    assert len(found[0]) == 2  # equal rows, equal results


def test_coverage_equals_a_plain_alignment(found):
    for i, (text, _) in enumerate(NOTICES):
        if text and len(text) < 5000:
            for r in found.get(i, []):
                texts = [words(t.text) for t in L.TEMPLATES if t.license == r["license"] and len(words(t.text)) == r["template_words"]]
                best = max(common(t, words(text)) for t in texts)
                assert r["matched"] <= best and r["coverage"] == pytest.approx(r["matched"] / r["template_words"])
                assert len(r["spans"]) > 1 or r["matched"] == best
                for s in r["spans"]:
                    inside = words(text.encode()[s["first_byte"]:s["last_byte"]].decode())
                    assert max(common(t, inside) for t in texts) >= r["coverage"] * r["template_words"] - 1 or len(r["spans"]) > 1
    assert len(found[[i for i, (t, _) in enumerate(NOTICES) if t == f"{BSD2} " * 3][0]][0]["spans"]) == 3
