import textwrap

import pytest

from tallymark.llm.licenses import RULES, SENTENCES, documents_licenses, license_scan


def found(spark, *texts):
    df = spark.createDataFrame([(i, t, "l", "s") for i, t in enumerate(texts)], "doc_id bigint, text string, licenses string, license_sentences string")
    return [(r.license_sentences, r.licenses) for r in license_scan(df).orderBy("doc_id").collect()]


def test_every_sentence_and_rule(spark):
    for name, text in SENTENCES.items():
        ((ids, _),) = found(spark, f"Before it. {text}\nAfter it.")
        assert ids == [name]
    for name, steps in RULES:
        ((ids, licenses),) = found(spark, "\n".join(SENTENCES[s] for s in steps))
        assert ids == list(steps) and licenses == [name]


def test_order_spelling_and_gaps(spark):
    a, b = SENTENCES["apache-grant"], SENTENCES["apache-copy"]
    got = found(
        spark, f"x. {b}\n{a}", f"{a.upper()}\nsomething else\n{b}", "released   under the\tMIT -- license!! \nReleased under the MIT License. Released under the MIT License.",
        "Released under the MIT Licenses.", None, "", "z " * 100_000 + "\nAll rights reserved.",
        f"{SENTENCES['mit-grant']}\n{SENTENCES['bsd-grant']}\n{SENTENCES['mit-condition']}",
    )
    assert got[0] == (["apache-copy", "apache-grant"], ["Apache-2.0"])
    assert got[1] == (["apache-grant", "apache-copy"], ["Apache-2.0"])
    assert got[2] == (["mit-notice"] * 3, ["MIT"])
    assert got[3] == got[4] == got[5] == ([], [])
    assert got[6] == (["reserved"], ["proprietary"])
    assert got[7][1] == ["BSD-2-Clause", "MIT"]


def test_documents_and_bad_tables(spark):
    docs = spark.createDataFrame([(None, "Licensed under CC BY-NC 4.0.\nRandom."), (1, None), (1, None)], "doc_id bigint, text string")
    got = sorted((tuple(r) for r in documents_licenses(docs).collect()), key=repr)
    assert got == [(1, 0, "", ""), (1, 0, "", ""), (None, 1, "cc-by-nc-notice", "CC-BY-NC-4.0")]
    assert documents_licenses(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        license_scan(docs, rules=(("X", ("no-such",)),))
    with pytest.raises(ValueError):
        license_scan(docs, sentences={"a": "Same.", "b": "same"}, rules=())


MIT = """MIT License

Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License."""
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


def test_full_texts_wrapped_commented_and_on_one_line(spark):
    whole = {
        "MIT": (MIT, ["mit-grant", "mit-condition"]), "Apache-2.0": (APACHE, ["apache-grant", "apache-copy", "apache-warranty"]),
        "GPL-3.0-or-later": (GPL, ["gpl-grant", "gpl-warranty"]), "BSD-3-Clause": (BSD, ["bsd-grant", "bsd-name"]),
    }
    for name, (text, ids) in whole.items():
        wrapped = "\n\n".join(textwrap.fill(p, 72) for p in text.split("\n\n"))
        shapes = [wrapped, wrapped.replace("\n", "\r\n"), "/*\n" + textwrap.indent(wrapped, " * ", lambda _: True) + "\n */", " ".join(text.split()), " ".join(text.split()).lower()]
        shapes += [textwrap.indent(wrapped, mark, lambda _: True) for mark in ("# ", "// ", "dnl ", "REM ", ";; ")]
        assert found(spark, *shapes) == [(ids, [name])] * len(shapes)


def test_short_notices_begin_a_sentence(spark):
    got = found(spark, "It is not licensed under the MIT License.", "Copyright Jane Roe, all rights\n# reserved.", "Copyright Jane Roe All rights reserved")
    assert got == [([], []), (["reserved"], ["proprietary"]), (["reserved"], ["proprietary"])]


BSD4 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
   This product includes software developed by the organization.
4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""


def test_clauses_and_versions_that_tell_licences_apart(spark):
    isc = SENTENCES["isc-grant"]
    texts = {
        BSD4: "BSD-4-Clause", BSD4.split("\n4.")[0]: "BSD-4-Clause", textwrap.fill(BSD, 60): "BSD-3-Clause",
        "This project is licensed under the MIT License - see the LICENSE file for details.": "MIT",
        "This project is licensed under the Apache License 2.0, see LICENSE.": "Apache-2.0",
        textwrap.fill(isc, 70): "ISC", SENTENCES["zero-bsd-grant"]: "0BSD",
        textwrap.indent(textwrap.fill(SENTENCES["gpl2-grant"] + " " + SENTENCES["gpl-warranty"], 70), " * "): "GPL-2.0-or-later",
        SENTENCES["gpl2-only"]: "GPL-2.0-only", textwrap.fill(SENTENCES["lgpl21-grant"], 50): "LGPL-2.1-or-later",
        SENTENCES["lgpl3-grant"]: "LGPL-3.0-or-later", SENTENCES["agpl-grant"]: "AGPL-3.0-or-later", GPL: "GPL-3.0-or-later",
    }
    assert [licenses for _, licenses in found(spark, *texts)] == [[name] for name in texts.values()]
