"""Licence notices found by Dice's coefficient over word bigrams, in DataFrame functions alone.

A text's passages are its lines and its paragraphs (blocks between blank lines). A passage is normalised: A-Z lower-cased, ASCII
marks and white space turned to blanks, cut into words. Its bigrams are compared, as bags, with those of each template:
2 * common / (passage + template). A template of m bigrams can reach ``least`` only with passages of
``least / (2 - least) * m`` to ``(2 - least) / least * m`` bigrams, so a passage's count of words rules out most templates
before any bigram is made. Everything happens inside a row: no shuffle, no join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.8

# Notices as their licences word them.
TEMPLATES = {
    "Apache-2.0 short": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    "Apache-2.0 terms": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-3-Clause short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "CC-BY-4.0 short": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 short": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0 short": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT short": "Released under the MIT License.",
    "MIT grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "MIT condition": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "\t\x0b\x0c\r!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def normal_words(text: str) -> list[str]:
    """The words of a template, by the rule that ``_normal`` applies to columns."""
    return [w for w in text.translate(str.maketrans(_UPPER + MARKS, _UPPER.lower() + " " * len(MARKS))).replace("\n", " ").split(" ") if w]


def bigrams(text: str) -> list[str]:
    words = normal_words(text)
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def size_bounds(m: int, least: float = LEAST) -> tuple[int, int]:
    """The fewest and most bigrams of a passage that can reach ``least`` with a template of ``m``."""
    return math.ceil(m * least / (2 - least) - 1e-9), math.floor(m * (2 - least) / least + 1e-9)


def _normal(text: Column) -> Column:
    return F.translate(text, _UPPER + MARKS, _UPPER.lower() + " " * len(MARKS))


def _common(own: Column, wanted: list[str]) -> Column:
    """The size of the common bag: distinct common bigrams, and further ones of those the template repeats."""
    times = Counter(wanted)
    total = F.size(F.array_intersect(own, F.array(*map(F.lit, times))))
    for gram, n in times.items():
        if n > 1:
            total = total + F.greatest(F.least(F.size(F.filter(own, _equals(gram))), F.lit(n)) - 1, F.lit(0))
    return total


def _equals(gram: str) -> Callable[[Column], Column]:
    return lambda x: x == gram


def license_column(text: Column, templates: dict[str, str] | None = None, least: float = LEAST) -> Column:
    """An array of struct<dice double, license string>, one for each passage that reaches ``least`` with a template, of its best template."""
    templates = TEMPLATES if templates is None else templates
    wanted = {name: bigrams(t) for name, t in templates.items()}
    bounds = {name: size_bounds(len(w), least) for name, w in wanted.items() if w}
    if not bounds:
        return F.array().cast("array<struct<dice:double,license:string>>")
    low, high = min(b[0] for b in bounds.values()), max(b[1] for b in bounds.values())

    clean = _normal(F.coalesce(text, F.lit("")))
    lines = F.split(clean, "\n")
    blocks = F.split(clean, "\n *\n")  # marks and white space are blanks by now
    # a paragraph of one line is that line
    passages = F.concat(lines, F.filter(blocks, lambda b: F.contains(b, F.lit("\n"))))
    words = F.transform(passages, lambda p: F.filter(F.split(F.replace(p, F.lit("\n"), F.lit(" ")), " "), lambda w: w != ""))
    fitting = F.filter(words, lambda w: (F.size(w) - 1 >= low) & (F.size(w) - 1 <= high))
    grams = F.transform(fitting, lambda w: F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat(a, F.lit(" "), b)))

    def best(own: Column) -> Column:
        scores = []
        for name, (lo, hi) in bounds.items():
            dice = F.round(2.0 * _common(own, wanted[name]) / (F.size(own) + len(wanted[name])), 6)
            scores.append(F.when((F.size(own) >= lo) & (F.size(own) <= hi), F.struct(dice.alias("dice"), F.lit(name).alias("license"))))
        return F.array_max(F.array(*scores))

    return F.filter(F.transform(grams, best), lambda x: x["dice"] >= least)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """(doc_id, n_passages, license, dice, licenses) for each row of ``docs`` (doc_id, text, any more columns).

    ``n_passages`` counts the passages that reach ``least``; ``license`` is the best template and ``dice`` its
    coefficient to six places (of equal ones the last name), null where none reaches it; ``licenses`` are all names found, sorted and
    joined by ``;``, empty where none. A null, empty or markless text has no passage; rows that repeat come back each.
    """
    found = docs.select("doc_id", license_column(F.col("text").cast("string"), templates, least).alias("f"))
    top = F.array_max("f")
    return found.select(
        "doc_id",
        F.size("f").cast("long").alias("n_passages"),
        top["license"].alias("license"),
        top["dice"].alias("dice"),
        F.concat_ws(";", F.array_sort(F.array_distinct(F.transform("f", lambda x: x["license"])))).alias("licenses"),
    )


def oracle_sql(templates: dict[str, str] | None = None, least: float = LEAST) -> str:
    """The same in DuckDB, without the size bounds."""
    templates = TEMPLATES if templates is None else templates
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    rows = ",\n".join(f"({quote(n)}, {quote(g)}, {c}, {len(bigrams(t))})" for n, t in templates.items() for g, c in Counter(bigrams(t)).items())
    marks = "chr(9) || chr(11) || chr(12) || chr(13) || " + quote(MARKS[4:])
    return f"""
WITH templates(license, gram, times, size) AS (VALUES {rows}),
clean AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}' || {marks}, '{_UPPER.lower()}' || repeat(' ', {len(MARKS)})) AS t FROM documents),
passages AS (
  SELECT doc_id, unnest(list_concat(string_split(t, chr(10)), list_filter(string_split_regex(t, '\\n *\\n'), lambda b: contains(b, chr(10))))) AS p FROM clean),
numbered AS (SELECT doc_id, row_number() OVER () AS passage, list_filter(string_split(replace(p, chr(10), ' '), ' '), lambda w: w <> '') AS w FROM passages),
grams AS (
  SELECT doc_id, passage, len(w) - 1 AS size, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM numbered),
bags AS (SELECT doc_id, passage, size, gram, count(*) AS times FROM grams GROUP BY ALL),
common AS (
  SELECT b.doc_id, b.passage, t.license, round(2.0 * sum(least(b.times, t.times))::DOUBLE / (any_value(b.size) + any_value(t.size)), 6) AS dice
  FROM bags b JOIN templates t USING (gram) GROUP BY ALL),
best AS (
  SELECT doc_id, passage, max(dice) AS dice, max(license) FILTER (dice = top) AS license
  FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id, passage) AS top FROM common) GROUP BY 1, 2),
hits AS (SELECT *, max(dice) OVER (PARTITION BY doc_id) AS top FROM best WHERE dice >= {least}),
found AS (
  SELECT doc_id, count(*) AS n, max(license) FILTER (dice = top) AS license, max(dice) AS dice, string_agg(DISTINCT license, ';' ORDER BY license) AS licenses FROM hits GROUP BY 1)
SELECT d.doc_id, coalesce(f.n, 0)::BIGINT AS n_passages, f.license, f.dice, coalesce(f.licenses, '') AS licenses FROM documents d LEFT JOIN found f USING (doc_id)
"""
