"""Licence scans: normalised text units are compared to licence templates by the Dice coefficient over word bigrams.

Everything is DataFrame expressions, in one pass without a shuffle; the templates are literals of the plan: short notices
here, standard headers and whole texts in the folder ``licence_texts``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import text_of

# Short public notices that stand in files and pages, by SPDX identifier.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work."),
)

TEXTS = Path(__file__).parent / "licence_texts"
TEXTS_BYTES = 1 << 18  # what the folder holds at most: all of it becomes literals of the plan


def standard_templates() -> tuple[tuple[str, str], ...]:
    """Standard headers and whole texts from files named by SPDX identifier and kind (``MIT.text.txt``), by name."""
    files = sorted(TEXTS.glob("*.txt"))
    if sum(f.stat().st_size for f in files) > TEXTS_BYTES:
        raise ValueError(f"licence texts above {TEXTS_BYTES} bytes")
    return tuple((f.name.rsplit(".", 2)[0], f.read_text(encoding="utf-8")) for f in files)


#: The short notices first, so that of equal Dice they are reported.
STANDARD: tuple[tuple[str, str], ...] = (*TEMPLATES, *standard_templates())

THRESHOLD = 0.8
#: Templates are taken together by their distinct bigrams; each tier has anchors of its own, looked for only in units long
#: enough for its smallest template.
TIERS = (1, 16, 48, 128, 512, 1200, 2200, 1 << 62)


def plain_words(text: str) -> list[str]:
    """Normalised words of a template."""
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def opening(text: str) -> str:
    """The first two words of a template."""
    return " ".join(plain_words(text)[:2])


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template, in order."""
    words = plain_words(text)
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def least_common(n: int, threshold: float) -> int:
    """Bigrams of a template's ``n`` that a unit with ``dice >= threshold`` shares at least: ``n * t / (2 - t)``."""
    return math.ceil(n * threshold / (2 - threshold) - 1e-9)


def anchors(templates: Sequence[Sequence[str]], threshold: float) -> list[str]:
    """Words of which every unit with ``dice >= threshold`` to a template has at least one.

    Such a unit shares ``least_common`` of the template's ``b`` bigrams, so it has one of any ``b - least_common + 1`` of
    them, and both words of that one.  Long words that stand in many bigrams are taken first.
    """
    words: list[str] = []
    for grams in sorted(templates, key=len):
        allowed = least_common(len(grams), threshold) - 1  # bigrams that may stay without an anchor
        left = [g for g in grams if not set(g.split(" ")) & set(words)]
        while len(left) > allowed:
            count = Counter(w for g in left for w in set(g.split(" ")))
            words.append(max(sorted(count), key=lambda w: (min(len(w), 7), count[w])))
            left = [g for g in left if words[-1] not in g.split(" ")]
    return words


def _literal(texts: Sequence[str]) -> Column:
    """Strings without a line feed as one literal of the plan, however many they are."""
    return F.split(F.lit("\n".join(texts)), "\n")


def words_of(text: Column) -> Column:
    """Normalised words in lower case, everything but letters and digits between words."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def _units(text: Column, lines: Column) -> Column:
    """Words of the lines (given), of the paragraphs of several lines, and of the whole text where it has several paragraphs.

    No word goes over a line feed, so the words of a whole text are those of its lines.
    """
    between = r"\n[\x20\t\r]*\n"

    def unit(kind: str, number: Column, words: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), number.cast("int").alias("number"), words.alias("words"))

    numbered = F.transform(F.split(text, between), lambda x, i: F.struct(i.alias("number"), x.alias("body")))
    blocks = F.transform(
        F.filter(numbered, lambda p: F.contains(p["body"], F.lit("\n"))),
        lambda p: unit("paragraph", p["number"], words_of(p["body"])),
    )
    several = F.concat(blocks, F.array(unit("document", F.lit(0), F.flatten(lines))))
    single = F.array(unit("paragraph", F.lit(0), F.flatten(lines)))
    alone = F.array().cast("array<struct<kind:string,number:int,words:array<string>>>")
    larger = F.when(text.rlike(between), several).when(F.size(lines) > 1, single).otherwise(alone)
    return F.concat(F.transform(lines, lambda x, i: unit("line", i, x)), larger)


def scan_licences(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    templates: Sequence[tuple[str, str]] = STANDARD,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Units of the documents that match a template: doc_id, kind, number, licence, template, dice.

    Units are the lines (``number`` counts from 0), paragraphs of several lines, the whole text when it has several
    paragraphs, and passages: a passage begins at any word of the text (``number`` counts words from 0) where the first
    two words of a template stand, and has as many words as that template (fewer at the end of the text), wherever lines
    and paragraphs end.  So a notice is found inside a comment block or a long line too.  Dice is ``2 * common / (a + b)`` over distinct bigrams.  With ``dice >= t`` a unit has
    between ``t / (2 - t)`` and ``(2 - t) / t`` times as many bigrams as the template; templates outside are not
    compared.  Before that, units are left out that have none of the ``anchors`` of the templates of their size, or fewer
    words of these templates than the bound on common bigrams demands.  The template with the highest Dice is reported,
    of equal ones the first.  Null and empty texts have no units that match.  Repeated rows are reported each; other columns are not read.
    """
    made = [(name, i, template_bigrams(text)) for i, (name, text) in enumerate(templates)]
    made = [m for m in made if m[2]]

    def score(grams: Column, name: str, i: int, template: list[str]) -> Column:
        n, b = F.size(grams), len(template)
        fits = n.between(F.lit(threshold / (2 - threshold) * b - 1e-9), F.lit((2 - threshold) / threshold * b + 1e-9))
        common = F.size(F.array_intersect(grams, _literal(template)))
        dice = F.when(fits, F.lit(2.0) * common / (n + b))
        return F.struct(dice.alias("dice"), F.lit(-i).alias("order"), F.lit(name).alias("licence"))

    def best(u: Column) -> Column:
        scores = F.filter(F.array(*[score(u["grams"], *m) for m in made]), lambda s: s["dice"] >= threshold)
        return F.struct(u["kind"].alias("kind"), u["number"].alias("number"), F.array_max(scores).alias("best"))

    def with_grams(u: Column) -> Column:
        return F.struct(u["kind"].alias("kind"), u["number"].alias("number"), _bigrams(u["words"]).alias("grams"))

    tiers = [[m[2] for m in made if low <= len(m[2]) < high] for low, high in zip(TIERS, TIERS[1:])]

    def likely(u: Column, tier: list[list[str]]) -> Column:
        """Can the unit match a template of the tier: by its words, an anchor, its size, and the words it shares."""
        words, sizes = u["words"], [len(grams) for grams in tier]
        vocabulary = sorted({w for grams in tier for pair in grams for w in pair.split(" ")})
        least, most = min(sizes), (2 - threshold) / threshold * max(sizes)

        def by_distinct(distinct: Column) -> Column:  # a unit has at least ``distinct - 1`` bigrams
            known = F.size(F.filter(words, lambda w: w.isin(vocabulary)))
            return (distinct - 1 <= most + 1e-9) & (known >= (distinct - 1 + least) * (threshold / 2) - 1e-9)

        wanted = anchors(tier, threshold)
        return (
            (F.size(words) > least_common(least, threshold))
            & F.exists(words, lambda w: w.isin(wanted))
            & F.exists(F.array(F.size(F.array_distinct(words))), by_distinct)
        )

    def marked(u: Column) -> Column:
        return reduce(Column.__or__, [likely(u, tier) for tier in tiers if tier], F.lit(False))

    openings = sorted({opening(templates[i][1]) for _, i, _ in made})
    first_words = sorted({o.split(" ")[0] for o in openings})

    def at(words: Column, i: Column) -> Column:
        return F.concat(words[i], F.lit(" "), words[i + 1])

    def passage(words: Column, i: Column) -> Column:
        begun = at(words, i)

        def whole(name: str, order: int, template: list[str]) -> Column:
            n = len(plain_words(templates[order][1]))
            left = F.size(words) - i > least_common(len(template), threshold)
            cut = F.array(_bigrams(F.slice(words, i + 1, F.lit(n))))
            one = F.transform(cut, lambda grams: score(grams, name, order, template))[0]
            return F.when((begun == opening(templates[order][1])) & left, one)

        scores = F.filter(F.array(*[whole(*m) for m in made]), lambda s: s["dice"] >= threshold)
        return F.struct(F.lit("passage").alias("kind"), i.cast("int").alias("number"), F.array_max(scores).alias("best"))

    def passages(words: Column) -> Column:
        places = F.when(F.size(words) > 1, F.sequence(F.lit(0), F.size(words) - 2))
        begun = F.filter(places, lambda i: words[i].isin(first_words) & at(words, i).isin(openings))
        return F.transform(F.coalesce(begun, F.array().cast("array<int>")), lambda i: passage(words, i))

    def matched(lines: Column) -> Column:
        units = F.filter(_units(text, lines), marked)
        return F.concat(
            F.transform(F.transform(units, with_grams), best),
            F.transform(F.array(F.flatten(lines)), passages)[0],
        )

    # one nested expression: each lambda variable is evaluated once, where separate projections would be merged and
    # evaluated again for every use
    text = text_of(text_column)
    lines = F.array(F.transform(F.split(text, "\n"), words_of))
    found = F.filter(F.transform(lines, matched)[0], lambda u: u["best"].isNotNull())
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.explode(found).alias("u"))
    best = rows.select("doc_id", "u.kind", "u.number", "u.best")
    return best.select(
        "doc_id",
        "kind",
        "number",
        F.col("best.licence").alias("licence"),
        (-F.col("best.order")).alias("template"),
        F.round("best.dice", 6).alias("dice"),
    )
