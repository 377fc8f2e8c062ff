"""Licence scans: lines and whole texts compared with templates by the Dice coefficient of their word bigrams."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import computed, text_or_empty

LEAST = 0.8
PARTS = r"[^\p{L}\p{N}\n]+"

# Notices of public licences, as their publishers word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
)


def bigrams_of(text: str) -> list[str]:
    """The distinct word bigrams of a template, in order."""
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def anchors(bigrams: Sequence[str], frequent: dict[str, int], least: float) -> list[str]:
    """Bigrams of which a text at `least` or above has one: it has at least least / (2 - least) of them all."""
    spare = len(bigrams) - math.ceil(least / (2 - least) * len(bigrams) - 1e-9) + 1
    return sorted(bigrams, key=lambda b: (-frequent[b], -len(b), b))[:spare]


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def licence_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, line_no, licence, template, dice, evidence) for every line (from 1) or whole text (0) that matches.

    Text is compared in small letters, words being runs of letters and digits.
    A unit is compared only with templates whose number of bigrams lets the
    coefficient reach `least`; before that, texts without any anchor bigram of
    any template go, which loses no match. The best template of a unit is
    returned, ties by order of `templates`. A one-line text is a line, not a
    text. Texts of under two words match nothing; null text is empty. Rows and
    ids may repeat or be null; other columns aren't read.
    """
    known = [(i, name, bigrams_of(text)) for i, (name, text) in enumerate(templates)]
    known = [x for x in known if x[2]]
    frequent: dict[str, int] = {}
    for _, _, bigrams in known:
        for b in bigrams:
            frequent[b] = frequent.get(b, 0) + 1
    wanted = sorted({a for _, _, bigrams in known for a in anchors(bigrams, frequent, least)})
    table = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(name).alias("name"), F.array(*map(F.lit, b)).alias("b")) for i, name, b in known])

    base = computed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), plain=F.regexp_replace(F.lower(text_or_empty("text")), PARTS, " "))
    base = computed(base, flat=F.regexp_replace("plain", r"[ \n]+", " "))
    flat = F.col("flat")
    some = F.lit(False)
    for a in wanted:
        some = some | F.contains(flat, F.lit(a))
    hit = base.where(some)
    lines = F.transform(F.split("plain", "\n", -1), lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("unit")))
    whole = F.when(F.contains("plain", F.lit("\n")), F.array(F.struct(F.lit(0).alias("line_no"), flat.alias("unit")))).otherwise(F.array().cast("array<struct<line_no:int,unit:string>>"))
    raw = F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("raw")
    units = hit.select("doc_id", raw, F.explode(F.concat(whole, lines)).alias("u")).select("doc_id", "raw", "u.*")
    units = computed(units, words=F.split(F.trim("unit"), " +", -1)).where(F.size("words") > 1)
    units = computed(units, b=_bigrams(F.col("words")))
    units = computed(units, n=F.size("b")).where("n > 0")
    low, high = least / (2 - least), (2 - least) / least
    near = F.filter(table, lambda t: (F.size(t["b"]) >= F.col("n") * low - 1e-9) & (F.size(t["b"]) <= F.col("n") * high + 1e-9))
    scored = F.transform(near, lambda t: F.struct((2 * F.size(F.array_intersect(F.col("b"), t["b"])) / (F.col("n") + F.size(t["b"]))).alias("dice"), (-t["i"]).alias("order"), t["name"].alias("licence")))
    best = computed(units, best=F.array_max(scored)).where(F.col("best.dice") >= least)
    evidence = F.when(F.col("line_no") > 0, F.element_at("raw", F.greatest("line_no", F.lit(1)))).otherwise(F.array_join("raw", "\n"))
    return best.select("doc_id", "line_no", F.col("best.licence").alias("licence"), (-F.col("best.order")).alias("template"), F.col("best.dice").alias("dice"), evidence.alias("evidence"))


def oracle(templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> str:
    """DuckDB SQL that compares every line and whole text with every template, without pruning."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({i}, {quote(name)}, [{', '.join(map(quote, bigrams_of(text)))}])" for i, (name, text) in enumerate(templates))
    return rf"""
        WITH t(i, licence, tb) AS (VALUES {rows}),
        p AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                     regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS plain FROM documents),
        l AS (SELECT r, doc_id, unnest(string_split(plain, chr(10))) AS unit, generate_subscripts(string_split(plain, chr(10)), 1) AS line_no,
                     unnest(string_split(text, chr(10))) AS evidence FROM p),
        u AS (SELECT r, doc_id, line_no, unit, evidence FROM l UNION ALL
              SELECT r, doc_id, 0, replace(plain, chr(10), ' '), text FROM p WHERE contains(plain, chr(10))),
        w AS (SELECT r, doc_id, line_no, evidence, list_filter(string_split(unit, ' '), lambda x: x <> '') AS ws FROM u),
        b AS (SELECT r, doc_id, line_no, evidence, list_distinct(list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1])) AS b FROM w WHERE len(ws) > 1),
        s AS (SELECT b.*, t.i, t.licence, 2 * len(list_intersect(b, tb)) / (len(b) + len(tb))::DOUBLE AS dice FROM b JOIN t ON len(b) <= 2 * len(tb) AND len(tb) <= 2 * len(b)),
        k AS (SELECT *, row_number() OVER (PARTITION BY r, line_no ORDER BY dice DESC, i) AS place FROM s)
        SELECT doc_id, line_no::INTEGER AS line_no, licence, i::INTEGER AS template, dice, evidence FROM k WHERE place = 1 AND dice >= {least}
    """
