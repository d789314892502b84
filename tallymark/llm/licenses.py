"""Licence scans by sentence rules: normalised sentences become identifiers, and sequences of identifiers match ordered rules.

All steps are column expressions on the row itself; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import LOWER, UPPER, ascii_lower

#: Known licence sentences by identifier, as public licence notices write them (fixed values); none goes beyond the place where the
#: SQL cuts a text (so the one of the Mozilla licence ends before its version).
SENTENCES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-grant": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-warranty": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "reserved": "All rights reserved.",
    "mit-project": "This project is licensed under the MIT License",
    "apache-project": "This project is licensed under the Apache License 2.0",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "zero-bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "gpl2-grant": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "lgpl21-grant": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-grant": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "unlicense-grant": "This is free and unencumbered software released into the public domain.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "cc0-grant": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
}

#: Licence, and the sentences that stand for it in this order; an earlier rule takes its sentences before a later one looks.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "mit-condition")),
    ("Apache-2.0", ("apache-grant", "apache-copy", "apache-warranty")),
    ("Apache-2.0", ("apache-grant", "apache-copy")),
    ("GPL-3.0-or-later", ("gpl-grant", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-grant", "gpl-warranty")),
    ("GPL-2.0-only", ("gpl2-only", "gpl-warranty")),
    ("AGPL-3.0-or-later", ("agpl-grant", "gpl-warranty")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-advertising", "bsd-name")),
    ("BSD-4-Clause", ("bsd-grant", "bsd-advertising")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-name")),
    ("BSD-2-Clause", ("bsd-grant",)),
    ("MIT", ("mit-grant",)),
    ("Apache-2.0", ("apache-grant",)),
    ("GPL-3.0-or-later", ("gpl-grant",)),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-licensed",)),
    ("Apache-2.0", ("apache-notice",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-notice",)),
    ("CC-BY-4.0", ("cc-by-notice",)),
    ("CC-BY-4.0", ("cc-by-long",)),
    ("MPL-2.0", ("mpl-notice",)),
    ("MIT", ("mit-project",)),
    ("Apache-2.0", ("apache-project",)),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("zero-bsd-grant",)),
    ("GPL-2.0-or-later", ("gpl2-grant",)),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("LGPL-2.1-or-later", ("lgpl21-grant",)),
    ("LGPL-3.0-or-later", ("lgpl3-grant",)),
    ("AGPL-3.0-or-later", ("agpl-grant",)),
    ("Unlicense", ("unlicense-grant",)),
    ("Zlib", ("zlib-grant",)),
    ("CC0-1.0", ("cc0-grant",)),
    ("proprietary", ("reserved",)),
)

#: Where the SQL cuts a text: line ends, and a full stop, question or exclamation mark before white space.
CUT = r"[\r\n]+|[.!?]+[ \t]+"
#: Known sentences of so many words count wherever they stand, shorter ones only where a sentence may begin (_marked).
LONG = 12
#: Stands before each word at which a sentence may begin.
START = "~"


def _plain(sentence: str) -> str:
    lowered = sentence.translate(str.maketrans(UPPER, LOWER))
    return " ".join("".join(c if c in LOWER + "0123456789" else " " for c in lowered).split())


def _checked(sentences: Mapping[str, str], rules: Sequence[tuple[str, tuple[str, ...]]]) -> dict[str, str]:
    known = {_plain(s): name for name, s in sentences.items()}
    if len(known) < len(sentences):
        raise ValueError("two known sentences are the same once normalised")
    unknown = {s for _, steps in rules for s in steps} - set(sentences)
    if unknown:
        raise ValueError(f"rules name unknown sentences: {sorted(unknown)}")
    return known


def _anchors(plain: Sequence[str]) -> list[str]:
    """Words of which every known sentence has one; a text without any of them can hold no known sentence."""
    chosen, rest = [], list(plain)
    while rest:
        words = {w for s in rest for w in s.split() if len(w) > 1} or {w for s in rest for w in s.split()}
        best = max(sorted(words), key=lambda w: (sum(w in s.split() for s in rest), len(w)))
        chosen.append(best)
        rest = [s for s in rest if best not in s.split()]
    return chosen


def _marked(text: Column) -> Column:
    """The words of a text in lower case, one space before each and one at the end; line ends and comment marks are spaces.

    START stands before a capital, and before a word that follows more than blanks: a line end, a mark or the start of the text.
    """
    lines = F.regexp_replace(F.concat(F.lit("\n"), text), r"(?i)([\r\n][ \t]*)(?:dnl|rem)(?![a-z0-9])", "$1")
    words = F.regexp_replace(F.regexp_replace(lines, r"[^A-Za-z0-9 \t][^A-Za-z0-9]*", f" {START}"), r"[ \t]+", " ")
    return F.concat(ascii_lower(F.regexp_replace(words, " (?=[A-Z])", f" {START}")), F.lit(" "))


def _pattern(plain: Sequence[str]) -> str:
    """Any of the sentences in a text of _marked(), of those that begin at one place the longest."""
    each = [("" if len(s.split()) < LONG else "?") + f" {START}?".join(s.split()) for s in sorted(plain, key=len, reverse=True)]
    return " (" + "|".join(START + s for s in each) + ")(?= )"


def sentence_ids(text: Column, known: Mapping[str, str]) -> Column:
    """The identifiers of the known sentences of a text, in order of place; no sentence for a null text."""
    if not known:
        return F.array().cast("array<string>")
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    found = F.transform(F.regexp_extract_all(_marked(text), F.lit(_pattern(list(known))), F.lit(1)), lambda s: names[F.replace(s, F.lit(START), F.lit(""))])
    none = F.array().cast("array<string>")
    return F.when(ascii_lower(text).rlike("|".join(_anchors(list(known)))), found).otherwise(none)


def license_scan(
    df: DataFrame, text: str = "text", sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, tuple[str, ...]]] = RULES
) -> DataFrame:
    """`df` with `license_sentences` (known identifiers in order) and `licenses` (array, in the order of the rules, no repeats).

    A known sentence may be wrapped, stand behind comment marks or between others on one line. Sentences of a rule must follow each
    other among the known sentences; what lies between them in the text does not matter.
    A null, empty or licence-free text has two empty arrays. Each row is judged by itself, so repeated rows get equal results.
    Columns of `df` named like the results are replaced.
    """
    known = _checked(sentences, rules)
    ids = sentence_ids(F.col(f"`{text}`"), known)
    marked = df.withColumn("license_sentences", ids)
    rest = F.concat(F.lit("<"), F.array_join("license_sentences", "><"), F.lit(">"))
    hits = []
    for name, steps in rules:
        rule = "".join(f"<{s}>" for s in steps)
        hits.append(F.when(F.contains(rest, F.lit(rule)), F.lit(name)))
        rest = F.replace(rest, F.lit(rule), F.lit("|"))
    found = F.array_distinct(F.array_compact(F.array(*hits)))
    none = F.array().cast("array<string>")
    return marked.withColumn("licenses", F.when(F.size("license_sentences") > 0, found).otherwise(none))


def documents_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_known, sentence_ids and licenses (both joined by commas)."""
    scanned = license_scan(docs.select("doc_id", "text"))
    return scanned.select(
        "doc_id",
        F.size("license_sentences").cast("bigint").alias("n_known"),
        F.array_join("license_sentences", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql() -> str:
    known = _checked(SENTENCES, RULES)
    if any(re.search(CUT, s) for s in SENTENCES.values()):
        raise ValueError("a known sentence would be cut in two")
    values = ", ".join(f"({_quoted(s)}, {_quoted(name)})" for s, name in known.items())
    steps, layers, order = "ids", [], []
    for i, (name, parts) in enumerate(RULES):
        rule = _quoted("".join(f"<{p}>" for p in parts))
        layers.append(f"s{i} AS (SELECT * EXCLUDE (rest), contains(rest, {rule}) AS h{i}, replace(rest, {rule}, '|') AS rest FROM {steps})")
        order.append(f"CASE WHEN h{i} THEN {_quoted(name)} END")
        steps = f"s{i}"
    distinct = "list_filter([%s], lambda x: x IS NOT NULL)" % ", ".join(order)
    return f"""
WITH known(s, name) AS (VALUES {values}),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
sentences AS (
  SELECT r, unnest(parts) AS raw, generate_subscripts(parts, 1) AS pos FROM (
    SELECT r, regexp_split_to_array(translate(text, '{UPPER}', '{LOWER}'), '[\\r\\n]+|[.!?]+[ \\t]+') AS parts FROM docs WHERE text IS NOT NULL)
), found AS (
  SELECT r, list(name ORDER BY pos) AS names
  FROM sentences JOIN known ON s = trim(regexp_replace(raw, '[^a-z0-9]+', ' ', 'g')) GROUP BY r
), ids AS (
  SELECT doc_id, coalesce(len(names), 0)::BIGINT AS n_known, coalesce(array_to_string(names, ','), '') AS sentence_ids,
    '<' || coalesce(array_to_string(names, '><'), '') || '>' AS rest
  FROM docs LEFT JOIN found USING (r)
), {", ".join(layers)}
SELECT doc_id, n_known, sentence_ids,
  array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') AS licenses
FROM (SELECT *, {distinct} AS l FROM {steps})
"""
