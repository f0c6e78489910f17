"""Licence notices in documents, by Dice coefficient over word bigrams.

Texts are normalised (lower case, letters and digits, single spaces). Two sets of
a and b bigrams have a Dice coefficient of at most 2 min(a, b) / (a + b), so a
template can only match where most of its bigrams stand; a text that does not hold
them anywhere is done after one look at its bigrams. In the others a template is
compared with every window of words that has at most its longest admissible size,
wherever it starts, and with each line, each paragraph of several lines and the
whole text. Only DataFrame functions are used, row by row: nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomcast.llm.decontaminate import let

#: Short notices and headers of common licences, and the opening
#: grant of those that have no usual notice.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at",
    ),
    (
        "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This work is licensed under the Mozilla Public License, version 2.0."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "CC-BY-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    ("CC0-1.0", "Released into the public domain under CC0 1.0 Universal."),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    ("all-rights-reserved", "All rights reserved."),
)


LINE = "\r\n|\n|\r"
PARAGRAPH = f"({LINE})[ \t]*({LINE})"


@dataclass(frozen=True)
class LicenseSettings:
    """``templates`` are (licence, text) pairs; their number bounds the work a row."""

    threshold: float = 0.8
    templates: Sequence[tuple[str, str]] = TEMPLATES


def normal_words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    return F.array_remove(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), "")


def word_pairs(words: Column) -> Column:
    """Pairs of neighbouring words in their order; a single word is its own pair."""
    pairs = let(
        words,
        lambda w: F.zip_with(
            w,
            F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
            lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)),
        ),
    )
    return F.when(F.size(words) == 1, words).otherwise(F.filter(pairs, lambda p: p.isNotNull()))


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words; a single word is its own pair."""
    return F.array_distinct(word_pairs(words))


def template_pairs(settings: LicenseSettings) -> list[tuple[str, list[str]]]:
    """Pairs of the templates in their order, made on the driver by the same rule."""
    out = []
    for name, text in settings.templates:
        words = [w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w]
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)] or words
        if not pairs:
            raise ValueError(f"the template of {name} has no words")
        out.append((name, pairs))
    return out


def template_sets(settings: LicenseSettings) -> list[tuple[str, list[str]]]:
    """Distinct bigrams of the templates."""
    return [(name, sorted(set(pairs))) for name, pairs in template_pairs(settings)]


def neighbours(pairs: Column) -> Column:
    """Each pair with the places where it stands last before and next after its own."""
    placed = F.array_sort(F.transform(pairs, lambda p, i: F.struct(p.alias("p"), i.alias("i"))))

    def linked(x: Column) -> Column:
        def of(y: Column, i: Column) -> Column:
            before, after = F.get(x, i - 1), F.get(x, i + 1)
            return F.struct(
                y["i"].alias("i"),
                y["p"].alias("p"),
                F.when(before["p"] == y["p"], before["i"]).otherwise(-1).alias("last"),
                F.when(after["p"] == y["p"], after["i"]).alias("next"),
            )

        return F.transform(x, of)

    return F.array_sort(let(placed, linked))


def best_window(places: Column, own: Sequence[str], span: int) -> Column:
    """Highest coefficient over all windows of at most ``span`` places.

    A window does not get worse by one more pair of the template in front of it, so
    only those windows count that cannot be extended like that: at the start of a run
    of the template's pairs, or after a pair that stands in the window once more.
    """

    def ratio(x: Column, start: Column) -> Column:
        def step(state: Column, y: Column) -> Column:
            new = (y["last"] < start).cast("int")
            n = state["n"] + new
            shared = state["shared"] + new * y["own"].cast("int")
            return F.struct(
                n.alias("n"),
                shared.alias("shared"),
                F.greatest(state["best"], shared / (n + len(own))).alias("best"),
            )

        zero = F.struct(
            F.lit(0).alias("n"), F.lit(0).alias("shared"), F.lit(0.0).alias("best")
        )
        return F.aggregate(F.slice(x, start + 1, F.lit(span)), zero, step, lambda s: s["best"])

    def of(x: Column) -> Column:
        def starts(y: Column, i: Column) -> Column:
            before = F.get(x, i - 1)
            again = F.coalesce(before["next"] < i + span, F.lit(False))
            return y["own"] & (~F.coalesce(before["own"], F.lit(False)) | again)

        return F.array_max(F.transform(F.filter(x, starts), lambda y: ratio(x, y["i"])))

    marked = F.transform(
        places,
        lambda y: F.struct(
            y["i"].alias("i"),
            y["last"].alias("last"),
            y["next"].alias("next"),
            y["p"].isin(list(own)).alias("own"),
        ),
    )
    return F.coalesce(2 * let(marked, of), F.lit(0.0))


def passages(text: Column) -> Column:
    """Lines, paragraphs of several lines, and a whole text of several paragraphs."""
    blocks = F.split(text, PARAGRAPH)
    several = F.filter(blocks, lambda p: p.rlike(LINE))
    whole = F.when(F.size(blocks) > 1, F.array(text)).otherwise(
        F.array().cast("array<string>")
    )
    return F.concat(F.split(text, LINE), several, whole)


def scan_licenses(
    documents: DataFrame, settings: LicenseSettings = LicenseSettings()
) -> DataFrame:
    """One row per document: doc_id, n_licenses, licenses, best_license, best_dice.

    ``licenses`` are the distinct names found, sorted and comma-joined; the best is
    the one with the highest coefficient, ties to the smaller name. Null and empty
    texts have none: 0, the empty string and nulls. Other columns are ignored.
    """
    t = settings.threshold
    sets = template_sets(settings)
    sizes = [len(s) for _, s in sets]
    # 2 min / (a + b) >= t bounds one size by the other.
    least = min(sizes) * t / (2 - t)

    def found(pairs: Column) -> Column:
        n = F.size(pairs)
        scores = []
        for name, own in sets:
            shared = F.size(F.array_intersect(pairs, F.array(*map(F.lit, own))))
            dice = F.lit(2.0) * shared / (n + len(own))
            fits = (n >= len(own) * t / (2 - t)) & (n <= len(own) * (2 - t) / t)
            scores.append(
                F.when(
                    fits, F.struct(F.round(dice, 6).alias("dice"), F.lit(name).alias("name"))
                )
            )
        return F.filter(F.array(*scores), lambda s: s.isNotNull() & (s["dice"] >= t))

    def of_passage(passage: Column) -> Column:
        return let(
            normal_words(passage),
            # n words have at most n - 1 bigrams, or one.
            lambda w: F.when(
                (F.size(w) > 0) & (F.greatest(F.size(w) - 1, F.lit(1)) >= least),
                let(bigrams(w), found),
            ),
        )

    text = F.coalesce(F.col("text"), F.lit(""))
    nothing = F.array().cast("array<struct<dice:double,name:string>>")
    # As n >= shared, 2 shared / (n + b) reaches t only with so many shared bigrams.
    needs = [math.ceil(b * (t - 1e-6) / (2 - t + 1e-6) - 1e-9) for b in sizes]
    spans = [math.ceil(len(p) * (2 - t) / t) for _, p in template_pairs(settings)]
    every = sorted({p for _, own in sets for p in own})

    def among(own: list[str]):
        return lambda p: p.isin(own)

    def enough(words: Column, held: Column, i: int) -> Column:
        """Whether the text holds so much of template i that a window can match."""
        own = sets[i][1]
        if " " not in own[0]:
            return F.array_contains(words, own[0])
        shared = F.size(F.filter(held, among(own)))
        return (F.size(held) >= needs[i]) & (shared >= needs[i])

    def of_windows(words: Column, held: Column, places: Column) -> Column:
        scores = []
        for i, (name, own) in enumerate(sets):
            single = " " not in own[0]
            dice = F.lit(1.0) if single else F.round(best_window(places, own, spans[i]), 6)
            score = F.struct(dice.alias("dice"), F.lit(name).alias("name"))
            scores.append(F.when(enough(words, held, i), score))
        return F.filter(F.array(*scores), lambda s: s.isNotNull() & (s["dice"] >= t))

    def of_text(words: Column, pairs: Column) -> Column:
        def of_held(held: Column) -> Column:
            likely = reduce(or_, [enough(words, held, i) for i in range(len(sets))])
            windows = let(neighbours(pairs), lambda places: of_windows(words, held, places))
            whole = F.flatten(
                F.filter(F.transform(passages(text), of_passage), lambda x: x.isNotNull())
            )
            return F.when(likely, F.concat(windows, whole)).otherwise(nothing)

        return let(F.array_distinct(F.filter(pairs, among(every))), of_held)

    hits = let(
        normal_words(text), lambda words: let(word_pairs(words), lambda p: of_text(words, p))
    )
    ordered = F.array_sort(
        hits,
        lambda a, b: F.when(a["dice"] > b["dice"], -1)
        .when(a["dice"] < b["dice"], 1)
        .when(a["name"] < b["name"], -1)
        .when(a["name"] > b["name"], 1)
        .otherwise(0),
    )
    best = F.get("hits", F.lit(0))
    return documents.select("doc_id", ordered.alias("hits")).select(
        "doc_id",
        F.size(F.array_distinct("hits.name")).cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct("hits.name")), ",").alias("licenses"),
        best["name"].alias("best_license"),
        best["dice"].alias("best_dice"),
    )
