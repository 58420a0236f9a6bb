"""Find licence notices in texts by the Dice coefficient over word bigrams, with DataFrame functions alone.

A text as a whole, each of its lines and each run of as many words as a template has is compared with every template whose
size allows the wanted coefficient: with Dice d or more, sizes differ by the factor (2 - d) / d at most.  All of it happens
inside a row; nothing is shuffled.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

DICE = 0.8

# Notices by licence, as their texts ask to be cited; SPDX identifiers where there are any.
TEMPLATES: dict[str, str] = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    "MIT notice": "Released under the MIT License.",
    "MIT grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions:""",
    "ISC grant": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "BSD grant": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met:""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Reserved": "All rights reserved.",
}


# Fixed value: whole texts and paragraphs of short licences, without the copyright line.
_MIT_REST = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
    Software."""
_MIT_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
    WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
    HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
    OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
    IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
    CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
    NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_TWO = """1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
    disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
    disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
    derived from this software without specific prior written permission."""
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
    INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
    EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
    BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING
    NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Fixed value: the GNU licences, SPDX identifier to name and version, the usual version of each first.
_GNU = {
    "GPL-3.0": ("GNU General Public License", "3", "29 June 2007"),
    "GPL-2.0": ("GNU General Public License", "2", "June 1991"),
    "GPL-1.0": ("GNU General Public License", "1", "February 1989"),
    "LGPL-3.0": ("GNU Lesser General Public License", "3", "29 June 2007"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1", "February 1999"),
    "LGPL-2.0": ("GNU Library General Public License", "2", "June 1991"),
    "AGPL-3.0": ("GNU Affero General Public License", "3", "19 November 2007"),
}
# Fixed value: the Creative Commons licences, and what their versions are called.
_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_CC_VERSIONS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}
_OTHERS = ("Apache-2.0", "MIT", "ISC", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "EPL-2.0", "BSL-1.0", "Zlib", "Unlicense", "CC0-1.0")


def _usual_notices() -> dict[str, str]:
    """Notices of the usual licences by name: sentences, names with version, identifiers, and whole short texts."""
    out = {
        "MIT": f"{TEMPLATES['MIT grant']} {_MIT_REST} {_MIT_WARRANTY}",
        "MIT condition": _MIT_REST,
        "MIT warranty": _MIT_WARRANTY,
        "ISC": f"{TEMPLATES['ISC grant']} {_ISC_WARRANTY}",
        "ISC warranty": _ISC_WARRANTY,
        "BSD-3-Clause": f"{TEMPLATES['BSD grant']} {_BSD_TWO} {_BSD_THIRD} {_BSD_WARRANTY}",
        "BSD-2-Clause": f"{TEMPLATES['BSD grant']} {_BSD_TWO} {_BSD_WARRANTY}",
        "BSD conditions": _BSD_TWO,
        "BSD-3-Clause third condition": _BSD_THIRD,
        "BSD warranty": _BSD_WARRANTY,
        "MIT sentence": "Licensed under the MIT License.",
        "MIT source notice": "This source code is licensed under the MIT license found in the LICENSE file in the root directory of this source tree.",
        "BSD-2-Clause name": "BSD 2-Clause License",
        "BSD-2-Clause long name": "Simplified BSD License",
        "BSD-3-Clause name": "BSD 3-Clause License",
        "BSD-3-Clause long name": "New BSD License",
        "ISC sentence": "Licensed under the ISC License.",
        "Apache-2.0 name": "Apache License, Version 2.0",
        "Apache-2.0 short name": "Apache License 2.0",
        "MPL-2.0 name": "Mozilla Public License, version 2.0",
        "CC0-1.0 name": "CC0 1.0 Universal",
        "CC0-1.0 sentence": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "CC0-1.0 short": "Licensed under CC0 1.0.",
    }
    for spdx, (name, version, date) in _GNU.items():
        full = version if "." in version else f"{version}.0"
        short = spdx.split("-")[0]
        out[f"{spdx} sentence"] = f"This work is licensed under the {name}, version {version}."
        # Named with a point, versions differ in two bigrams.
        out[f"{spdx} name"] = f"{name}, version {full}"
        out[f"{spdx} name v"] = f"{name} v{full}"
        out[f"{spdx} short"] = f"Licensed under the {short}-{full}."
        out[f"{spdx} shorter"] = f"Licensed under the {short}v{version}."
        out[f"{spdx} shortest"] = f"Licensed under {short}v{version}."
        out[f"{spdx} title"] = f"{name} Version {version}, {date}"
        program, verb = ("program", "the GNU General") if short == "GPL" else ("library" if version != "3" else "program", "the " + name.removesuffix(" Public License"))
        way = f"This {program} is free software: you can redistribute it and/or modify it under the terms of {verb} Public License as published by the Free Software Foundation"
        later = f"{way}, either version {version} of the License, or (at your option) any later version."
        if spdx != "GPL-3.0":
            out[f"{spdx}-or-later"] = later
        out[f"{spdx}-only"] = f"{way}, version {version} of the License."
        for kind in ("only", "or later"):
            out[f"{spdx}-{kind.replace(' ', '-')} SPDX"] = f"SPDX-License-Identifier: {spdx}-{kind}"
        out[f"{spdx} SPDX"] = f"SPDX-License-Identifier: {spdx}"
    for version, kind in _CC_VERSIONS.items():
        for short, name in _CC.items():
            # Before 4.0 the parts had the short order of NonCommercial-NoDerivs.
            name = name if version == "4.0" else name.replace("NoDerivatives", "NoDerivs")
            spdx = f"CC-{short}-{version}"
            if spdx not in TEMPLATES:
                out[spdx] = f"This work is licensed under a Creative Commons {name} {version} {kind} License."
            out[f"{spdx} short"] = f"Licensed under CC {short} {version}."
            out[f"{spdx} short name"] = f"CC {short} {version}"
            out[f"{spdx} name"] = f"Creative Commons {name} {version} {kind}"
            out[f"{spdx} SPDX"] = f"SPDX-License-Identifier: {spdx}"
    for spdx in _OTHERS:
        out[f"{spdx} SPDX"] = f"SPDX-License-Identifier: {spdx}"
    return out


def normal_words(text: str) -> list[str]:
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def bigrams_of(text: str) -> list[str]:
    """Distinct word bigrams of a template; a single word stands for itself."""
    words = normal_words(text)
    return sorted({" ".join(p) for p in zip(words, words[1:], strict=False)} or set(words))


def _split(notices: Mapping[str, str], least: float) -> tuple[dict[str, str], dict[str, str]]:
    """Notices that differ from all before, and those that the coefficient alone cannot tell from one before."""
    apart, near = {}, {}
    seen = [set(bigrams_of(t)) for t in TEMPLATES.values()]
    for name, text in notices.items():
        own = set(bigrams_of(text))
        (near if any(2 * len(own & o) >= least * (len(own) + len(o)) for o in seen) else apart)[name] = text
        seen.append(own)
    return apart, near


# Versions and parts of a name, in which a text differs from a template too little for the coefficient.  The operator knows them
# and names the best of a place; the SQL, which names all that reach the coefficient, would name them beside the right one.
_apart, VERSIONS = _split(_usual_notices(), DICE)
TEMPLATES |= _apart


def _words(unit: Column) -> Column:
    """Words of a text; one empty word if it has none."""
    return F.split(F.trim(F.regexp_replace(F.lower(unit), r"[^\p{L}\p{N}]+", " ")), " ")


def _pairs(words: Column) -> Column:
    """The word bigrams of some words in their order; of a single word, the word."""
    after = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(words) < 2, words).otherwise(after)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


_KNOWN = "array<struct<license:string,own:array<string>,n:int,need:int,low:int,high:int>>"
_MATCHES = "array<struct<unit:int,license:string,dice:double,word:int,words:int,common:int,own:array<string>>>"


# Fixed value: words that say little about a licence.
_COMMON = frozenset("a all and any as be by for in is it of on or that the this to under with you".split())


def _known(templates: Mapping[str, str], least: float) -> tuple[Column, Column, Column]:
    """Templates as one constant array, in the order of their names, all their bigrams, and bigrams of which every match has one.

    With Dice ``least`` or more, a unit has ``need`` of the template's bigrams at least; so it cannot miss all of any
    ``size - need + 1`` of them.  Those without common words and with the longest are taken, which few other texts have.
    """
    rows, marks = [], set()
    telling = lambda b: (len(_COMMON & set(b.split())), -min(map(len, b.split())), -len(b), b)
    for name, text in sorted(templates.items()):
        own, n = bigrams_of(text), len(normal_words(text))
        low, high = math.ceil(least / (2 - least) * len(own) - 1e-9), math.floor((2 - least) / least * len(own) + 1e-9)
        need = max(1, math.ceil(least * (low + len(own)) / 2 - 1e-9))
        rows.append({"license": name, "own": own, "n": n, "need": need, "low": low, "high": high})
        marks.update(sorted(own, key=telling)[: len(own) - need + 1])
    texts = lambda values: F.from_json(F.lit(json.dumps(sorted(values))), "array<string>")
    return F.from_json(F.lit(json.dumps(rows)), _KNOWN), texts({b for r in rows for b in r["own"]}), texts(marks)


def _match(unit: Column, t: Column, size: Column, common: Column, word: Column, words: Column) -> Column:
    dice = 2.0 * common / (size + F.size(t["own"]))
    values = {"unit": unit, "license": t["license"], "dice": dice, "word": word, "words": words, "common": common, "own": t["own"]}
    return F.struct(*[v.alias(k) for k, v in values.items()])


def _of_unit(unit: Column, words: Column, word: Column, known: Column, least: float) -> Column:
    """Matches of a whole text or line with all templates of a fitting size."""
    compared = lambda grams: F.transform(
        F.filter(known, lambda t: F.size(grams).between(t["low"], t["high"])),
        lambda t: _match(unit, t, F.size(grams), F.size(F.array_intersect(grams, t["own"])), word, F.size(words)),
    )
    return F.filter(_let(F.array_distinct(_pairs(words)), compared), lambda m: m["dice"] >= least)


def _windows(words: Column, pairs: Column, line_of: Column, known: Column, least: float) -> Column:
    """Matches of every run of as many words as a template has.

    A run of m bigrams starts in one of the stretches of m bigrams that follow each other, and lies in this and the next one.
    Only where both together have as many of the template's bigrams as a match needs, the runs are tried one by one.
    """

    def of(t: Column) -> Column:
        grams = F.when(t["n"] < 2, words).otherwise(pairs)
        m = F.greatest(t["n"] - 1, F.lit(1))

        def scan(v: Column) -> Column:
            g, m, last = v["g"], v["m"], F.size(v["g"]) - v["m"]
            bases = F.filter(
                F.transform(F.sequence(F.lit(0), F.floor(last / m).cast("int")), lambda k: k * m),
                lambda b: F.size(F.array_intersect(F.slice(g, b + 1, 2 * m), t["own"])) >= t["need"],
            )
            starts = F.flatten(F.transform(bases, lambda b: F.sequence(b, F.least(b + m - 1, last))))
            tried = lambda i: _let(
                F.array_distinct(F.slice(g, i + 1, m)),
                lambda d: _match(F.get(line_of, i), t, F.size(d), F.size(F.array_intersect(d, t["own"])), i, t["n"]),
            )
            return F.filter(F.transform(starts, tried), lambda x: x["dice"] >= least)

        none = F.array().cast(_MATCHES)
        return F.when(F.size(words) < t["n"], none).otherwise(_let(F.struct(grams.alias("g"), m.alias("m")), scan))

    return F.flatten(F.transform(known, of))


def _meet(a: Column, b: Column) -> Column:
    """Whether more than half of the words of a match lie in another one."""
    both = F.least(a["word"] + a["words"], b["word"] + b["words"]) - F.greatest(a["word"], b["word"])
    return 2 * both > a["words"]


def _alike(a: Column, b: Column) -> Column:
    """Whether most of what a match has of its template is in the other's template as well."""
    return 2 * (F.size(F.array_intersect(a["own"], b["own"])) - (F.size(a["own"]) - a["common"])) > a["common"]


def _best_windows(found: Column) -> Column:
    """Of runs that meet and are alike, the one with most bigrams of its template, then the largest coefficient, then the last start."""
    order = ("common", -1), ("dice", -1), ("word", -1)
    ranked = F.array_sort(F.transform(found, lambda m: F.struct(*[(m[k] * s).alias(k) for k, s in order], m["license"].alias("license"), m.alias("m"))))
    same = lambda a, b: a["license"] == b["license"]
    return F.aggregate(
        F.transform(ranked, lambda r: r["m"]),
        F.array().cast(_MATCHES),
        lambda kept, m: F.when(F.exists(kept, lambda k: _meet(m, k) & (same(m, k) | _alike(m, k))), kept).otherwise(F.concat(kept, F.array(m))),
    )


def _together(units: Column, windows: Column) -> Column:
    """Matches of units, and those of runs that no unit tells already.

    A unit gives way to a run in it that has more bigrams of a template alike, of the same licence's next version, say.
    """
    same = lambda a, b: a["license"] == b["license"]
    left = F.filter(units, lambda u: ~F.exists(windows, lambda w: ~same(u, w) & (w["common"] > u["common"]) & _meet(u, w) & _meet(w, u) & _alike(u, w)))
    more = F.filter(windows, lambda w: ~F.exists(units, lambda u: _meet(w, u) & (same(w, u) | ((u["common"] >= w["common"]) & _alike(w, u)))))
    return F.concat(left, F.array_sort(F.transform(more, lambda m: F.struct(m["word"].alias("at"), m["license"].alias("name"), m.alias("m"))))["m"])


def find_licenses(
    docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Mapping[str, str] | None = None, least: float = DICE
) -> DataFrame:
    """``(doc_id, matches)`` of each row: ``array<struct<unit,license,dice,word,words>>``.

    Unit 0 is the whole text, n its line n; a text of one line is one unit.  Then come notices inside a line or over several,
    found as runs of as many words as the template has: their unit is the line of their first word, a text's first line being 1.
    ``word`` says how many words of the text come before, ``words`` how many the match has.
    Letter case and all but letters and digits do not count.  A null or empty text, and one without words, matches nothing.
    Templates without words are never found.  Repeated rows give repeated rows.
    """
    named = {n: t for n, t in (TEMPLATES | VERSIONS if templates is None else templates).items() if normal_words(t)}
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    empty = F.array().cast("array<struct<unit:int,license:string,dice:double,word:int,words:int>>")
    if not named:
        return docs.select(F.col(f"`{key}`").alias("doc_id"), empty.alias("matches"))
    known, every, marks = _known(named, least)
    single = any(len(normal_words(t)) < 2 for t in named.values())

    def of_row(v: Column) -> Column:
        words, pairs = v["words"], v["pairs"]
        grams = F.concat(pairs, words) if single else pairs
        return F.when(F.arrays_overlap(grams, marks), _let(F.array_intersect(grams, every), lambda d: among(words, pairs, d))).otherwise(empty)

    def among(words: Column, pairs: Column, grams: Column) -> Column:
        # A template of which the whole text has too little is nowhere in it.
        own = F.filter(known, lambda t: F.size(F.array_intersect(grams, t["own"])) >= t["need"])
        by_line = F.transform(F.split(value, "\n", -1), _words)
        return _let(F.struct(own.alias("own"), by_line.alias("lines")), lambda v: _let(numbered(v), lambda n: matched(words, pairs, v, n)))

    def numbered(v: Column) -> Column:
        """The line of each word, from 1."""
        size = lambda w: F.when(F.get(w, F.lit(0)) == "", 0).otherwise(F.size(w))
        return F.flatten(F.transform(v["lines"], lambda w, i: F.array_repeat(i + 1, size(w))))

    def matched(words: Column, pairs: Column, v: Column, line_of: Column) -> Column:
        whole = _of_unit(F.lit(0), words, F.lit(0), v["own"], least)
        start = lambda i: (F.array_position(line_of, i) - 1).cast("int")
        lines = F.flatten(F.transform(v["lines"], lambda w, i: _of_unit(i + 1, w, start(i + 1), v["own"], least)))
        units = F.concat(whole, F.when(F.size(v["lines"]) > 1, lines).otherwise(F.slice(lines, 1, 0)))
        runs = _best_windows(_windows(words, pairs, line_of, v["own"], least))
        both = F.struct(units.alias("units"), runs.alias("runs"))
        plain = lambda m: F.struct(*[m[k].alias(k) for k in ("unit", "license", "dice", "word", "words")])
        return F.when(F.size(v["own"]) > 0, F.transform(_let(both, lambda b: _together(b["units"], b["runs"])), plain)).otherwise(empty)

    row = lambda w: _let(F.struct(w.alias("words"), _pairs(w).alias("pairs")), of_row)
    return docs.select(F.col(f"`{key}`").alias("doc_id"), _let(_words(value), row).alias("matches"))


def license_report(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: Mapping[str, str] | None = None) -> DataFrame:
    """Per row: key, number of matches, licences found by name, and the best coefficient (0 if none)."""
    m = F.col("matches")
    return find_licenses(docs, key, text, templates).select(
        "doc_id",
        F.size(m).cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(m, lambda x: x["license"]))), ",").alias("licenses"),
        F.coalesce(F.round(F.array_max(F.transform(m, lambda x: x["dice"])), 6), F.lit(0.0)).alias("best_dice"),
    )


def license_sql(templates: Mapping[str, str] | None = None, least: float = DICE) -> str:
    """The report in SQL over the table ``documents``, every unit against every template."""
    rows = ", ".join(
        "('" + n.replace("'", "''") + "', [" + ", ".join("'" + b.replace("'", "''") + "'" for b in bigrams_of(t)) + "])"
        for n, t in sorted((TEMPLATES if templates is None else templates).items())
    )
    return f"""
WITH templates(license, own) AS (VALUES {rows}),
lines AS (SELECT doc_id, coalesce(text, '') AS value, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
units AS (
    SELECT doc_id, unnest(CASE WHEN len(parts) > 1 THEN list_concat([value], parts) ELSE [value] END) AS unit FROM lines
),
worded AS (
    SELECT doc_id, string_split(trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units
),
paired AS (
    SELECT doc_id, CASE WHEN len(w) < 2 THEN w
        ELSE list_distinct([w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)]) END AS grams
    FROM worded
),
scored AS (
    SELECT doc_id, license, 2.0 * len(list_intersect(grams, own)) / (len(grams) + len(own)) AS dice
    FROM paired, templates
    WHERE len(grams) BETWEEN {least} / (2 - {least}) * len(own) - 1e-9 AND (2 - {least}) / {least} * len(own) + 1e-9
),
found AS (SELECT * FROM scored WHERE dice >= {least})
SELECT d.doc_id, count(f.license) AS n_matches,
       coalesce(string_agg(DISTINCT f.license, ',' ORDER BY f.license), '') AS licenses,
       coalesce(round(max(f.dice), 6), 0.0)::DOUBLE AS best_dice
FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id
GROUP BY d.doc_id
"""
