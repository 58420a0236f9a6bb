from __future__ import annotations

import hashlib
import random
import re
import textwrap

import pyarrow as pa

from martkit.llm import decontaminate, license_scan, secret_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hits(text, items, window):
    """Positions of hit words and the items found, by trying every item at every place."""
    words, places, found = lowered(text), set(), set()
    for item, item_text in items:
        own = lowered(item_text)
        size = min(window, len(own))
        for i in range(len(own) - size + 1) if own else ():
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    places |= set(range(j, j + size))
                    found.add(str(item))
    return words, places, found


ITEMS = [(1, "one two three four five six"), (2, "Seven, EIGHT nine"), (10, "seven eight nine"), (3, None), (4, "?!"), (None, "lost item words here"), (5, "ünï cödé wörds 12")]
TEXTS = [
    (1, "One two-three four; and seven eight nine."), (2, "two three four five"), (3, None), (4, ""), (5, "ÜNÏ ünï cödé wörds 12 x"),
    (None, "three four five six seven eight nine"), (1, "One two-three four; and seven eight nine."), (7, "w " * 200 + "seven eight nine"), (8, "lost item words here"),
]


def test_passages_against_plain_search(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    for block in (1 << 20, 40):  # one pass, and several
        rows = decontaminate.contamination_report(docs(TEXTS, clash=True), bench, window=4, block_bytes=block).collect()
        assert len(rows) == len(TEXTS)
        for (key, text), row in zip(TEXTS, rows, strict=True):
            words, places, found = hits(text, [i for i in ITEMS if i[0] is not None], 4)
            digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
            assert (row.doc_id, row.n_words, row.n_hit, row.n_items, row.items_sha256) == (key, len(words), len(places), len(found), digest)
            assert row.contaminated == (len(places) > 0 and 20 * len(places) >= len(words))


def test_cut_and_drop_passages(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    frame = docs(TEXTS, clash=True)
    kept = decontaminate.drop_contaminated(frame, bench, window=4)
    assert kept.columns == frame.columns
    clean = []
    for key, text in TEXTS:
        words, places, _ = hits(text, [i for i in ITEMS if i[0] is not None], 4)
        if not places or 20 * len(places) < len(words):
            clean.append((key, text))
    assert sorted(map(tuple, kept.select("doc_id", "text").collect()), key=str) == sorted(clean, key=str)
    cut = {r.doc_id: r.text for r in decontaminate.cut_passages(frame, bench, window=4).collect()}
    assert cut[1] == "; and ." and cut[5] == "ÜNÏ  x" and cut[3] is None and cut[8] == TEXTS[8][1]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(frame, none).count() == len(TEXTS)
    assert decontaminate.contamination_report(docs([]), bench).count() == 0


def test_a_pass_never_gets_the_windows_of_another(spark, docs, monkeypatch):
    """Two blocks whose items stand at the same address, in one worker."""
    place: list = []

    class Shared:
        def __init__(self, held):
            self.held = held

        @property
        def value(self):
            place[:] = self.held
            return place

    made, items = [], []
    monkeypatch.setattr(spark.sparkContext, "broadcast", Shared)
    monkeypatch.setattr(type(docs([])), "mapInArrow", lambda self, run, schema: made.append(run) or self)
    for held in ([("a", b"one two three")], [("b", b"four five six")]):
        decontaminate._one_pass(docs([]), held, 13, "text", {n: n for n in decontaminate._FOUND}, False)
    batch = pa.record_batch([pa.array([1]), pa.array(["one two three four five six"])], names=["doc_id", "text"])
    for run in made:
        items += [row["items"] for b in run(iter([batch])) for row in b.to_pylist()]
    assert items == [["a"], ["b"]]


SECRET = "k3J9xQ2mZ8pL5vT1rW7n"


def test_secrets(docs):
    texts = [
        (1, f"é password = '{SECRET}' and TOKEN:short, Api_Key=abcdefghijkl"),
        (2, "AKIA1234567890ABCD AKIASHORT deadbeefdeadbeef0 deadbeef"),
        (3, None), (4, ""), (None, f"free {SECRET}{SECRET[::-1]} string"), (5, "a" * 200_000),
        (6, "https://x.org/some/long/path/of/words abcdefghijklmnopqrstuvwxyz 12345678901234567890 example_" + SECRET),
        (7, "password: token: abcdefghijklmnop"),
    ]
    rows = {r.doc_id: r for r in secret_scan.secret_report(docs(texts, clash=True)).collect()}
    assert len(rows) == len(texts)
    assert (rows[1].n_assign, rows[2].n_access, rows[2].n_hex) == (2, 1, 1)
    assert rows[1].spans.split(",")[0] == f"assign:2:{2 + len('password = ') + 1 + 20}"
    assert rows[2].base_sha256 == hashlib.sha256(b"access:0:18,hex:29:46").hexdigest()
    assert rows[None].spans.startswith("entropy:5:") and rows[None].n_assign == 0
    assert rows[6].spans == "hex:65:85" and rows[7].n_assign == 0 and rows[4].spans == rows[3].spans == ""
    # A run of hex letters is a hex secret, whatever its entropy.
    assert rows[5].spans == "hex:0:200000"
    masked = {r.doc_id: r.text for r in secret_scan.mask_secrets(docs(texts)).collect()}
    assert SECRET not in masked[1] and len(masked[1]) == len(texts[0][1]) and masked[3] is None


def test_entropy_is_that_of_each_window():
    import math
    import random

    rng = random.Random(2)
    scan = secret_scan.EntropyScan(secret_scan.EntropyRules())
    for _ in range(200):
        text = "".join(rng.choice("abcdef0123456789" if rng.random() < 0.7 else "a") for _ in range(rng.randint(20, 60)))
        wanted = set()
        for i in range(len(text) - 19):
            w = text[i : i + 20]
            if -sum(w.count(c) / 20 * math.log2(w.count(c) / 20) for c in set(w)) >= 3.0 - 1e-9:
                wanted |= set(range(i, i + 20))
        assert {i for a, b in scan.windows(text, 3.0) for i in range(a, b)} == wanted


def dice(a, b):
    a, b = set(license_scan.bigrams_of(a)), set(license_scan.bigrams_of(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licenses_against_every_template(docs):
    apache = license_scan.TEMPLATES["Apache-2.0"]
    texts = [
        (1, "Intro line\nReleased under the MIT Licence.\nReleased under the MIT License."), (2, apache), (3, None), (4, ""), (5, "-- ..."),
        (None, apache.replace("express or implied", "stated")), (6, "ALL RIGHTS RESERVED\n\n"), (7, "word " * 20_000), (1, "x"),
    ]
    rows = license_scan.find_licenses(docs(texts, clash=True)).collect()
    for (key, text), row in zip(texts, rows, strict=True):
        lines = (text or "").split("\n")
        units = [text or "", *(lines if len(lines) > 1 else [])]
        wanted = sorted((i, n) for i, u in enumerate(units) for n, t in license_scan.TEMPLATES.items() if dice(u, t) >= license_scan.DICE)
        assert row.doc_id == key and sorted((m.unit, m.license) for m in row.matches) == wanted
    assert license_scan.license_report(docs([])).count() == 0
    assert license_scan.license_report(docs(texts), templates={"none": "!"}).agg({"n_matches": "sum"}).first()[0] == 0


def runs_by_force(text, templates):
    """Templates of which some run of as many words reaches the coefficient."""
    words = license_scan.normal_words(text)
    sizes = {n: len(license_scan.normal_words(t)) for n, t in templates.items()}
    return {
        n for n, t in templates.items() if any(dice(" ".join(words[i : i + sizes[n]]), t) >= license_scan.DICE for i in range(len(words) - sizes[n] + 1))
    }


def test_notices_wrapped_and_embedded(docs):
    filler = " ".join(f"word{i}" for i in range(300))
    wrapped = "\n".join(textwrap.wrap(license_scan.TEMPLATES["MIT grant"], 75))
    edited = wrapped.replace("free of charge", "without charge").replace("associated", "related")
    texts = [
        (1, f"{filler}\n{wrapped}\n{filler}"), (2, "This is a short intro to our little tool. Released under the MIT License."),
        (3, f"{filler}\n# " + edited.replace("\n", "\n# ") + f"\n{filler}"), (4, f"{filler} Licensed under the Apache\nLicense, Version 2.0. {filler}\nReleased under the MIT License. {filler}"),
        (5, filler), (6, f"{wrapped}\nall rights\nreserved {filler}"), (7, f"{filler} Released under the MIT License. Released under the MIT License."),
    ]
    rows = {r.doc_id: r for r in license_scan.find_licenses(docs(texts, clash=True)).collect()}
    named = {k: [(m.unit, m.license, m.word, m.words) for m in r.matches] for k, r in rows.items()}
    assert named[1] == [(2, "MIT grant", 300, 67)] and rows[1].matches[0].dice == 1.0
    assert named[2] == [(1, "MIT notice", 9, 5)]
    assert [m[:2] for m in named[3]] == [(2, "MIT grant")] and 0.8 <= rows[3].matches[0].dice < 1
    assert named[4] == [(1, "Apache-2.0 notice", 300, 8), (3, "MIT notice", 608, 5)]
    assert named[5] == [] and [m[1] for m in named[6]] == ["MIT grant", "Reserved"]
    assert named[7] == [(1, "MIT notice", 300, 5), (1, "MIT notice", 305, 5)]
    words = {n: t for n, t in license_scan.TEMPLATES.items() if n in ("MIT notice", "Reserved", "Apache-2.0 notice")} | {"one": "Zlib"}
    rng = random.Random(4)
    pool = [*license_scan.normal_words(" ".join(words.values())), "x"]
    mixed = [(i, " ".join(rng.choice(pool) if rng.random() < 0.3 else t for t in rng.choice(list(words.values())).split() * rng.randint(1, 3))) for i in range(150)]
    for r in license_scan.find_licenses(docs(mixed), templates=words).collect():
        text = mixed[r.doc_id][1]
        units = {n for n, t in words.items() if dice(text, t) >= license_scan.DICE}
        assert {m.license for m in r.matches} == units | runs_by_force(text, words)


# Texts and the licence they name, by hand.
NAMED = [
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("Some tool. It is licensed under the GNU Lesser General Public License version 2.1, see below for more.", "LGPL-2.1"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("The files here are Licensed under CC BY-NC 4.0. Other files are not.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("Licensed under CC BY-ND 3.0.", "CC-BY-ND-3.0"),
    ("Text and figures: CC BY-NC-SA 4.0, see the page of the journal", "CC-BY-NC-SA-4.0"),
    ("This work is licensed under a Creative Commons\nAttribution-NonCommercial-NoDerivatives 4.0\nInternational License.", "CC-BY-NC-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("// SPDX-License-Identifier: GPL-2.0-or-later\nint main(void) { return 0; }", "GPL-2.0-or-later"),
    ("# SPDX-License-Identifier: BSD-3-Clause\nimport os", "BSD-3-Clause"),
    ("To the extent possible under law, the author has waived all copyright and\nrelated or neighboring rights to this work.", "CC0-1.0"),
    ("prog.c - does things\n * This program is free software; you can redistribute it and/or\n * modify it under the terms of the GNU General Public License\n"
     " * as published by the Free Software Foundation; either version 2\n * of the License, or (at your option) any later version.\n * int x;", "GPL-2.0-or-later"),
    ("The MIT License (MIT)\n\nCopyright (c) 2020 Jane Doe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\n"
     'of this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\n'
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\n"
     "furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\n"
     'copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\n'
     "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\n"
     "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER\nLIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,\n"
     "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE\nSOFTWARE.\n", "MIT"),
]


def test_usual_licences_by_name(docs):
    """Each text names its licence and no other; none is taken from the templates."""
    rows = license_scan.license_report(docs([(i, t) for i, (t, _) in enumerate(NAMED)])).collect()
    found = {NAMED[r.doc_id]: {n.split(" ")[0] for n in r.licenses.split(",")} for r in rows}
    assert {k: v for k, v in found.items() if v != {k[1]}} == {}


def test_spans_of_a_long_text_take_linear_time():
    """Megabytes of hex words: base and entropy spans are merged in one walk."""
    import random
    import time

    rng = random.Random(4)
    words = ["".join(rng.choices("0123456789abcdef", k=40)) for _ in range(25_000)]
    scan = secret_scan.EntropyScan(secret_scan.EntropyRules())
    took = []
    for part in (words[:5_000], words):
        text = " ".join(part)
        start = time.process_time()
        spans = secret_scan.spans_of(text, scan)
        took.append(time.process_time() - start)
        assert [s for s in spans if s[2] == "hex"] == [(41 * i, 41 * i + 40, "hex") for i in range(len(part))]
        assert not [s for s in spans if s[2] == "entropy"]
    assert took[1] < 12 * took[0] + 1


def test_no_rows_give_no_rows(spark, docs):
    assert secret_scan.secret_report(docs([])).count() == 0
