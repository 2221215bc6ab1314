"""License scans by conditional compression.

Around each cue in a text the block of words that a template can span is compressed alone and with the template as zstandard raw-content
dictionary, for every template whose telling words stand there. In the order of the bytes saved templates are aligned
word by word, and the first is confirmed whose wording differs in few words, in none that tells it from its relatives, and adds none that tells
a relative. The scan goes on behind it, so several licenses in a row are all found.

A template is tried on as many words before and behind the cue as it can span, across lines of any length and
blank ones. Cues are searched in every text by Spark itself; only texts with one reach Python. Templates are a parameter, as a
dictionary or a table of bounded size (template_table); rows are independent, so nothing is shuffled.

Edge cases: null and empty texts have no license; very long texts are scanned whole; a license that
stands several times in a text is found each time; repeated rows give their rows each; a null doc_id
stays null; an empty table gives an empty result; extra columns are ignored.
"""

import re
from bisect import bisect_right
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .decontaminate import best_match

# Public notices, headers and texts of licenses, and the words that must stand in each unchanged.
TEMPLATES = {
    "MIT": [
        ("Released under the MIT License.", "mit"),
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "merge sublicense furnished substantial portions",
        ),
    ],
    "Apache-2.0": [
        ("Licensed under the Apache License, Version 2.0.", "apache 2.0"),
        (
            "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
            "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
            "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
            "apache 2.0 compliance",
        ),
    ],
    "GPL-3.0": [("This work is licensed under the GNU General Public License, version 3.", "gnu general 3")],
    "GPL-2.0": [("This work is licensed under the GNU General Public License, version 2.", "gnu general 2")],
    "GPL-3.0-or-later": [
        (
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
            "of the License, or (at your option) any later version.",
            "gnu general 3 later",
        )
    ],
    "LGPL-3.0": [("This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3")],
    "AGPL-3.0": [("This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3")],
    "BSD-3-Clause": [
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
            "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
            "endorse or promote products derived from this software without specific prior written permission.",
            "redistributions binary neither endorse",
        ),
        ("Released under the BSD 3-Clause License.", "bsd 3-clause"),
    ],
    "BSD-2-Clause": [
        (
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain "
            "the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
            "following disclaimer in the documentation and/or other materials provided with the distribution.",
            "redistributions binary",
        ),
        ("Released under the BSD 2-Clause License.", "bsd 2-clause"),
    ],
    "ISC": [
        (
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice "
            "appear in all copies.",
            "fee appear",
        )
    ],
    "MPL-2.0": [
        (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
            "mozilla 2.0",
        )
    ],
    "Unlicense": [("This is free and unencumbered software released into the public domain.", "unencumbered domain")],
    "CC-BY-4.0": [("Licensed under CC BY 4.0.", "cc by 4.0"), ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "commons attribution 4.0")],
    "CC-BY-SA-4.0": [
        ("Licensed under CC BY-SA 4.0.", "cc by-sa 4.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "commons attribution-sharealike 4.0"),
    ],
    "CC-BY-NC-4.0": [
        ("Licensed under CC BY-NC 4.0.", "cc by-nc 4.0"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "commons attribution-noncommercial 4.0"),
    ],
    "CC0-1.0": [("Released under CC0 1.0 Universal.", "cc0 1.0")],
    "All-Rights-Reserved": [("All rights reserved.", "rights reserved")],
}
_GNU = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
TEMPLATES |= {
    "GPL-2.0-or-later": [(_GNU.format(";", "General", ";", "2"), "gnu general 2 later")],
    "LGPL-2.0-or-later": [(_GNU.format(";", "Library General", ";", "2"), "gnu library 2 later")],
    "LGPL-2.1-or-later": [(_GNU.format(";", "Lesser General", ";", "2.1").replace("program", "library"), "gnu lesser 2.1 later")],
    "LGPL-3.0-or-later": [(_GNU.format(":", "Lesser General", ",", "3"), "gnu lesser 3 later")],
    "AGPL-3.0-or-later": [(_GNU.format(":", "Affero General", ",", "3"), "gnu affero 3 later")],
    "BSL-1.0": [("Distributed under the Boost Software License, Version 1.0.", "boost 1.0")],
    "Zlib": [
        (
            "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
            "anyone alter commercial restrictions",
        )
    ],
}
#: The line by which source files name a license.
_IDENTIFIED = "SPDX-License-Identifier: {}"
for _name in [*TEMPLATES, "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only"]:
    if _name != "All-Rights-Reserved":
        TEMPLATES.setdefault(_name, []).append((_IDENTIFIED.format(_name), f"spdx-license-identifier {_name.lower()}"))
#: Added to another license's wording, such a word makes it one more license.
RELATIVES = frozenset("affero lesser noncommercial sharealike noderivatives attribution-noncommercial attribution-sharealike attribution-noderivatives by-sa by-nc by-nd 1.0 1.1 2.0 2.1 3.0 4.0".split())
#: Every template holds one of them; in a wording words are apart by one space, and "licence" is spelt "license".
CUES = ("licens", "permission", "redistribut", "copyright", "cc0", "public domain", "rights reserved", "cc by")
MAX_DIFFERENCE = 0.2
#: On so little text zstandard parses best, and still fast, at a high level.
LEVEL = 19
#: Characters of a table of templates that travel to the tasks, at most.
TEMPLATE_CHARS = 4_000_000
OUT = "doc_id long, line int, license string, saved int, words int, differences int, wording string"


def wording(text: str) -> list[str]:
    return [w.replace("licenc", "licens") for w in (x.strip(".,;:!?\"'()[]{}*#/<>|-“”") for x in text.casefold().split()) if w]


@lru_cache(maxsize=4)
def _templates(frozen):
    out = []
    for name, text, must in frozen:
        words = tuple(wording(text))
        made = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        out.append((name, words, set(must.split()), zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_dict_id=False)))
    return out, zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def _frozen(templates: dict):
    return tuple((name, text, must) for name, forms in templates.items() for text, must in forms)


def saving(words: list[str], template, plain) -> int:
    """Bytes that the template as dictionary saves on the words."""
    body = " ".join(words).encode()
    return len(plain.compress(body)) - len(template[3].compress(body))


def aligned(template: tuple[str, ...], words: list[str]) -> tuple[int, int, int]:
    """Least word edits of the template to a stretch of the block, and the stretch."""
    distance, end = best_match(template, words)
    _, back = best_match(template[::-1], words[:end][::-1])
    return distance, end - back, end


def differences(template: tuple[str, ...], words: list[str]) -> tuple[list[str], set[str]]:
    """Wording differences as -missing and +added words, and the template's words that they touch."""
    out, touched = [], set()
    for kind, a, b, c, d in SequenceMatcher(None, template, words, autojunk=False).get_opcodes():
        if kind != "equal":
            out += [f"-{w}" for w in template[a:b]] + [f"+{w}" for w in words[c:d]]
            touched.update(template[a:b])
    return out, touched


def _block(words: list[str], cue: int, floor: int, template) -> tuple[int, int]:
    """The words that the template can span over the cue."""
    reach = len(template[1]) + int(MAX_DIFFERENCE * len(template[1])) + 1
    return max(floor, cue - reach), min(len(words), cue + reach)


def around(words: list[str], cue: int, floor: int, template) -> tuple[int, list[str], set[str], int] | None:
    """Start, differences, touched words and distance of the template's alignment over the cue, if its wording confirms one; nothing before floor counts."""
    name, own, must, _ = template
    reach = len(own) + int(MAX_DIFFERENCE * len(own)) + 1
    lo, hi = max(floor, cue - reach), min(len(words), cue + reach)
    while must <= set(words[lo:hi]):
        distance, a, b = aligned(own, words[lo:hi])
        if distance > MAX_DIFFERENCE * len(own):
            return None
        if lo + a <= cue < lo + b:
            found, touched = differences(own, words[lo + a : lo + b])
            more = {x[1:] for x in found if x[0] == "+"} & RELATIVES
            return None if must & touched or more else (lo + a, lo + b, distance, found)
        # a better one stands beside the cue and has cues of its own
        lo, hi = (lo + b, hi) if lo + b <= cue else (lo, lo + a)
    return None


def confirmed(words: list[str], cue: int, floor: int, frozen):
    """(license, bytes saved, start, end, distance, differences) of the first template confirmed over the cue, in the order of the bytes it saves on its block; ties go to the longer one.

    The bytes returned are those of the confirmed stretch alone.
    """
    templates, plain = _templates(frozen)
    blocks = [(t, *_block(words, cue, floor, t)) for t in templates]
    ranked = [(saving(words[lo:hi], t, plain), len(t[1]), -i, t) for i, (t, lo, hi) in enumerate(blocks) if t[2] <= set(words[lo:hi])]
    for *_, template in sorted(ranked, key=lambda r: r[:3], reverse=True):
        found = around(words, cue, floor, template)
        if found:
            lo, hi, distance, edits = found
            return template[0], saving(words[lo:hi], template, plain), lo, hi, distance, edits
    return None


def _numbered(text: str) -> tuple[list[str], list[int]]:
    """The words of a text, and the line each stands in."""
    words, lines = [], []
    for i, line in enumerate(text.split("\n")):
        own = wording(line)
        words += own
        lines += [i] * len(own)
    return words, lines


def cues(words: list[str]) -> list[int]:
    """Numbers of the words in which a cue begins."""
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    return sorted({bisect_right(starts, m.start()) - 1 for m in _CUE.finditer(" ".join(words))})


_CUE = re.compile("|".join(CUES))


def licenses(text: str, templates: dict | None = None) -> list[tuple]:
    """(first line, license, bytes saved, words, differences, wording) for each license in the text.

    Around each cue that no license found before covers, each template gets as many words as it can span; lines, however
    long or blank, make no difference.
    """
    frozen, out, floor = _frozen(templates or TEMPLATES), [], 0
    words, lines = _numbered(text)
    for cue in cues(words):
        found = confirmed(words, cue, floor, frozen) if cue >= floor else None
        if found:
            name, saved, lo, floor, distance, edits = found
            out.append((lines[lo], name, saved, floor - lo, distance, " ".join(edits)))
    return out


def template_table(rows: DataFrame) -> dict:
    """Templates from a table (license, text, must) of bounded size; must: words, apart by spaces, that have to stand unchanged."""
    if (rows.agg(F.sum(F.length("text"))).first()[0] or 0) > TEMPLATE_CHARS:
        raise ValueError("templates travel to every task and may not be larger than TEMPLATE_CHARS")
    out: dict = {}
    for r in rows.where("text is not null and license is not null").orderBy("license", "text").collect():
        text, must = r["text"], r["must"] or ""
        if not cues(wording(text)) or not set(must.split()) <= set(wording(text)):
            raise ValueError(f"template of {r['license']} holds no cue or lacks a word it must have")
        out.setdefault(r["license"], []).append((text, must))
    return out


def scan_licenses(docs: DataFrame, templates: dict | None = None) -> DataFrame:
    """doc_id, line, license, saved, words, differences, wording: a row for each license found."""
    lower = F.lower("text")
    has = lambda word: F.contains(lower, F.lit(word))
    cue = has("licens") | has("licenc") | has("permission") | has("redistribut") | has("copyright") | has("cc0")
    # words of a cue may stand in two lines
    for first, second in (("public", "domain"), ("rights", "reserved"), ("cc", "by")):
        cue = cue | (has(second) & F.regexp_like(lower, F.lit(rf"\b{first}[^\p{{L}}\p{{N}}]+{second}")))

    def run(batches):
        for batch in batches:
            rows = [(doc_id, *x) for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for x in licenses(text, templates)]
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "line", "license", "saved", "words", "differences", "wording"])

    return docs.select("doc_id", "text").where(cue).mapInArrow(run, OUT)


def op9_license_scan(spark, sf_dir):
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
