"""License scans against whole lines of the tables, changed wordings and each edge case."""

import random
import textwrap

import pytest

from pressmill.llm import licenses
from pressmill.llm.licenses import TEMPLATES

LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "All rights reserved.": "All-Rights-Reserved",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}
FORMS = [(name, text) for name, forms in TEMPLATES.items() for text, _ in forms]


def names(text):
    return [x[1] for x in licenses.licenses(text)]


def test_query(spark, medium):
    got = sorted((r.doc_id, r.license) for r in licenses.op9_license_scan(spark, medium).collect())
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted((d.doc_id, LINES[x]) for d in docs for x in (d.text or "").split("\n") if x in LINES)


@pytest.mark.parametrize("name, text", FORMS)
def test_each_form(name, text):
    assert licenses.cues(licenses.wording(text))
    prose = "Some prose of no legal meaning stands here and goes on for a while. " * 5
    assert names(text) == [name]
    assert names(f"{prose}\n{text}\n{prose}") == [name]
    assert names("\n".join(textwrap.wrap(text.upper(), 60, break_on_hyphens=False))) == [name]
    assert names(prose) == []


@pytest.mark.parametrize("name, text", [x for x in FORMS if len(x[1]) > 150])
def test_changed_wording(name, text):
    words = text.split()
    words[len(words) // 2] = "CHANGED"
    (found,) = licenses.licenses(" ".join(words))
    assert found[1] == name and found[4] == 1 and "+changed" in found[5]


GNU = "This {what} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation{b} either version {v} of the License, or (at your option) any later version."


@pytest.mark.parametrize(
    "kind, version, name",
    [("General", "2", "GPL-2.0-or-later"), ("General", "3", "GPL-3.0-or-later"), ("Library General", "2", "LGPL-2.0-or-later"), ("Lesser General", "2.1", "LGPL-2.1-or-later"), ("Lesser General", "3", "LGPL-3.0-or-later"), ("Affero General", "3", "AGPL-3.0-or-later")],
)
def test_relatives(kind, version, name):
    for what in ("program", "library", "file"):
        for a, b in ((":", ","), (";", ";")):
            assert names(GNU.format(what=what, kind=kind, v=version, a=a, b=b)) == [name]
    assert names(GNU.format(what="program", kind=kind, v="7", a=";", b=";")) == []


def test_identifiers():
    for name in ("Apache-2.0", "MIT", "GPL-2.0-only", "AGPL-3.0-or-later", "Zlib", "BSL-1.0"):
        assert names(f"// SPDX-License-Identifier: {name}\nint main() {{ return 0; }}") == [name]
    assert names("SPDX-License-Identifier: Nobody-1.0") == []


def test_ranks_decide():
    # both wordings stand in the block and both can be confirmed; the one that saves more bytes is taken
    longer = next(t for t, _ in TEMPLATES["BSD-3-Clause"] if len(t) > 200)
    (found,) = licenses.licenses(longer)
    assert found[1] == "BSD-3-Clause" and found[2] > max(x[2] for x in licenses.licenses(next(t for t, _ in TEMPLATES["BSD-2-Clause"] if len(t) > 200)))


def test_rejects_and_repeats():
    assert names("Licensed under the Apache License, Version 1.1.") == []
    assert names("Her driving licence was renewed. We sell licensed goods and ask for permission.") == []
    assert names("Licensed under the MIT License.") == ["MIT"]
    assert names("Released under the MIT License.\nLicensed under CC BY 4.0.\nReleased under the MIT License.") == ["MIT", "CC-BY-4.0", "MIT"]


def test_edges(spark):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, mit), (3, mit), (None, mit), (4, "word " * 200_000 + "\n" + mit)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as license")
    got = licenses.scan_licenses(docs).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (3, "MIT"), (3, "MIT"), (4, "MIT")]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text, name", sorted(LINES.items()))
def test_notice_inside_a_long_line(text, name):
    common = "the of and to a in that is was he for it with as his on be at by had not are but from or have an they which one you were all her she there would their we him been has".split()
    prose = random.Random(0).choices(common, [1 / (i + 2) for i in range(len(common))], k=2500)
    for size in (250, 625, 1250, 2500):
        assert names(" ".join(prose[: size // 2] + text.split() + prose[size // 2 : size])) == [name]


MIT_TEXT = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD_TEXT = """Copyright (c) 2020, Some Body

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
NEITHER = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


@pytest.mark.parametrize("text, name", [(MIT_TEXT, "MIT"), (BSD_TEXT, "BSD-2-Clause"), (BSD_TEXT + NEITHER, "BSD-3-Clause")])
def test_published_texts_with_blank_lines(text, name):
    assert names(text) == [name]


PUBLISHED = {"MIT": MIT_TEXT, "BSD-2-Clause": BSD_TEXT, "BSD-3-Clause": BSD_TEXT + NEITHER} | {k: TEMPLATES[k][0][0] for k in ("ISC", "MPL-2.0")}


@pytest.mark.parametrize("name", sorted(PUBLISHED) + [k for k in sorted(TEMPLATES) if k.startswith("Apache")])
@pytest.mark.parametrize("width", [40, 80, 130, 200])
def test_widths_with_and_without_blank_lines(name, width):
    text = PUBLISHED.get(name) or max((t for t, _ in TEMPLATES[name]), key=len)
    parts = [" ".join(p.split()) for p in text.split("\n\n")]
    wrapped = ["\n".join(textwrap.wrap(p, width, break_on_hyphens=False)) for p in parts]
    for between in ("\n", "\n\n", "\n\n\n\n"):
        for mark in ("", "// ", " * "):
            body = "\n".join(mark + line for line in between.join(wrapped).split("\n"))
            assert names(f"int x = 1;\n{body}\nint y = 2; return x + y;\n") == [name]


def test_spelling_and_cues_across_lines(spark):
    assert names("Licenced under the MIT Licence.") == ["MIT"] and names("All rights\n# reserved.") == ["All-Rights-Reserved"]
    docs = spark.createDataFrame([(1, "All rights\nreserved."), (2, "by success"), (3, "Released under the MIT Licence.")], "doc_id long, text string")
    assert sorted((r.doc_id, r.license) for r in licenses.scan_licenses(docs).collect()) == [(1, "All-Rights-Reserved"), (3, "MIT")]


def test_many_licenses_in_one_text():
    mit = " ".join(MIT_TEXT.split())
    assert names(" and then ".join([mit, BSD_TEXT + NEITHER, mit, "Licensed under CC BY 4.0.", BSD_TEXT, mit])) == ["MIT", "BSD-3-Clause", "MIT", "CC-BY-4.0", "BSD-2-Clause", "MIT"]


def test_templates_from_a_table(spark):
    rows = [("Own-1", "This file comes under the Own License, first version.", "own first"), ("Own-2", "This file comes under the Own License, second version.", "own second"), (None, "x", None)]
    table = licenses.template_table(spark.createDataFrame(rows, "license string, text string, must string"))
    docs = spark.createDataFrame([(1, "This file comes under\nthe Own License, second version."), (2, "MIT License")], "doc_id long, text string")
    assert [(r.doc_id, r.license) for r in licenses.scan_licenses(docs, table).collect()] == [(1, "Own-2")]
    with pytest.raises(ValueError):
        licenses.template_table(spark.createDataFrame([("A", "no such word", "x")], "license string, text string, must string"))
