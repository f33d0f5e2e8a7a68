"""License scan: lines, runs of words and texts against license templates by the Dice coefficient of word bigrams.

Every line of a text, and the text as a whole, is normalised (lower case, everything but
letters and digits to single spaces) and turned into its set of word bigrams. Dice
``2 * |A & B| / (|A| + |B|)`` can reach the threshold t only if the sizes satisfy
``t / (2 - t) * |B| <= |A| <= (2 - t) / t * |B|``; templates outside these bounds are
skipped before any bigram is compared. DataFrame functions only, one row in and one row
out per document, without a shuffle.

A notice that is wrapped over lines or stands inside a longer line is found as a run of
neighbouring words of the whole text. Runs begin and end with bigrams of the template (cutting
others off never lowers Dice) and have at most as many bigrams as the upper bound; one that
has too few template bigrams after its start is skipped. Of overlapping runs of a template
the one of the largest Dice stays, of different templates the one that shares most bigrams. A run
is left out where a matching line it touches, or the matching whole text, already names its
template or one that contains it. The line of a run is that of its first word.

Defined results: null and empty texts have no match; a line of one word has
no bigram and no match; equal coefficients go to the template named first in the
alphabet; repeated rows come out repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public license notices, by SPDX-like name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the'
        " License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "Apache-2.0-disclaimer": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        ' "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.'
    ),
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released into the public domain under CC0 1.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"
        " as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
        " provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
        ' files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,'
        " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the"
        " Software is furnished to do so, subject to the following conditions:"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

#: Words are runs of letters and digits; the Java and DuckDB classes agree on these ranges.
NOT_WORD = r"[^\p{L}\p{Nd}]+"


def template_bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised ASCII template, in order."""
    words = re.findall(r"[a-z0-9]+", text.lower())
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """Least and largest number of bigrams that can reach the threshold against ``size``."""
    return math.ceil(threshold / (2 - threshold) * size - 1e-9), math.floor((2 - threshold) / threshold * size + 1e-9)


def _words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " ")), " ")


def _bigrams(words: Column) -> Column:
    """Distinct neighbouring pairs; fewer than two words give an empty array."""
    n = F.size(words)
    return F.when(
        n >= 2,
        F.array_distinct(F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))),
    ).otherwise(F.array().cast("array<string>"))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _apart(runs: Column, kind: str) -> Column:
    """Runs in sorting order, each only if it overlaps none before it."""
    return F.aggregate(
        F.array_sort(runs),
        F.array().cast(f"array<{kind}>"),
        lambda kept, m: F.when(
            F.exists(kept, lambda x: (x["start"] <= m["stop"]) & (m["start"] <= x["stop"])), kept
        ).otherwise(F.concat(kept, F.array(m))),
    )


RUN = "struct<fewer:int,less:double,license:string,start:int,stop:int>"


def _runs_of(words: Column, hits: Column, t: Column, threshold: float) -> Column:
    """Runs of one template ``t`` that reach the threshold, as ``RUN``; ``hits`` are the places of all templates' bigrams."""
    kind = "struct<less:double,start:int,stop:int,shared:int>"
    need, most = t["need"], t["most"]

    def distinct(h: Column, j: Column, n: Column) -> Column:
        return F.size(F.array_distinct(F.transform(F.slice(h, j + 1, n), lambda x: x["g"])))

    def best_from(h: Column, j: Column) -> Column:
        at = F.get(h, j)["i"]
        ends = F.filter(F.slice(h, j + need, most), lambda e: e["i"] - at < most)

        def to(e: Column, n: Column) -> Column:
            shared = distinct(h, j, n + need)
            size = F.size(_bigrams(F.slice(words, at + 1, e["i"] - at + 2)))
            dice = 2.0 * shared / (size + F.size(t["b"]))
            return F.struct((-dice).alias("less"), at.alias("start"), (e["i"] + 1).alias("stop"), shared.alias("shared"))

        return F.array_min(F.transform(ends, to))

    def runs(h: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(h) - need),
            # enough template bigrams in reach, then enough different ones
            lambda j: (F.get(h, j + need - 1)["i"] - F.get(h, j)["i"] < most) & (distinct(h, j, most) >= need),
        )
        good = F.filter(F.transform(starts, lambda j: best_from(h, j)), lambda m: m["less"] <= -threshold)
        return F.transform(
            _apart(good, kind),
            lambda m: F.struct(
                (-m["shared"]).alias("fewer"), m["less"].alias("less"), t["license"].alias("license"), m["start"].alias("start"), m["stop"].alias("stop")
            ),
        )

    own = F.filter(hits, lambda x: F.array_contains(t["b"], x["g"]))
    return _once(own, lambda h: F.when(F.size(h) >= need, runs(h)).otherwise(F.array().cast(f"array<{RUN}>")))


def _runs(words: Column, known: dict[str, list[str]], threshold: float) -> Column:
    """Runs of all templates in the words of a text, none overlapping."""
    every = sorted({g for b in known.values() for g in b})
    first = sorted({g.split(" ")[0] for g in every})
    bounds = {k: size_bounds(len(b), threshold) for k, b in known.items()}
    templates = F.array(
        *[
            F.struct(
                F.lit(k).alias("license"),
                F.array(*[F.lit(x) for x in b]).alias("b"),
                F.lit(bounds[k][0]).alias("need"),
                F.lit(bounds[k][1]).alias("most"),
            )
            for k, b in known.items()
        ]
    )
    least = min((need for need, _ in bounds.values()), default=1)

    def found(w: Column) -> Column:
        pairs = F.zip_with(
            w, F.slice(w, F.lit(2), F.size(w)), lambda x, y: F.when(x.isin(first) & y.isNotNull(), F.concat_ws(" ", x, y))
        )
        places = F.transform(pairs, lambda g, i: F.when(g.isin(every), F.struct(i.cast("int").alias("i"), g.alias("g"))))
        return _once(
            F.filter(places, lambda x: x.isNotNull()),
            lambda hits: F.when(
                F.size(hits) >= least, _apart(F.flatten(F.transform(templates, lambda t: _runs_of(w, hits, t, threshold))), RUN)
            ).otherwise(F.array().cast(f"array<{RUN}>")),
        )

    return _once(words, found)


def _as_matches(runs: Column, lines: Column, matches: Column, known: dict[str, list[str]], threshold: float) -> Column:
    """The runs that ``matches`` do not name yet, in the same form."""
    # templates of which enough is part of another one (or the same) to be named with it
    within = {k: [x for x, c in known.items() if len(set(b) & set(c)) >= size_bounds(len(b), threshold)[0]] for k, b in known.items()}
    kind = "array<struct<line:int,license:string,dice:double>>"
    line_of = F.flatten(F.transform(lines, lambda s, i: F.array_repeat(i.cast("int"), F.size(F.filter(_words(s), lambda w: w != "")))))

    def named(m: Column, r: Column, at: Column) -> Column:
        same = F.lit(False)
        for k, others in within.items():
            same = same | ((r["license"] == k) & m["license"].isin(others))
        return same & ((m["line"] == -1) | m["line"].between(F.get(at, r["start"]), F.get(at, r["stop"])))

    def fresh(at: Column) -> Column:
        left = F.filter(runs, lambda r: ~F.exists(matches, lambda m: named(m, r, at)))
        return F.transform(
            left, lambda r: F.struct(F.get(at, r["start"]).alias("line"), r["license"].alias("license"), (-r["less"]).alias("dice"))
        )

    return F.when(F.size(runs) > 0, _once(line_of, fresh)).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = 0.8) -> DataFrame:
    """doc_id, matches (line, license, dice; line -1 is the whole text; runs come last), n_matches, licenses, best_license, best_dice."""
    known = {k: template_bigrams(v) for k, v in sorted((templates or TEMPLATES).items())}
    known = {k: v for k, v in known.items() if v}
    bounds = {k: size_bounds(len(v), threshold) for k, v in known.items()}
    # words bound distinct bigrams from above only, so just the least size prunes by words
    least = min((a for a, _ in bounds.values()), default=1)
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")
    units = F.concat(
        F.transform(lines, lambda s, i: F.struct(i.cast("int").alias("line"), _words(s).alias("words"))),
        F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), _words(text).alias("words")))).otherwise(
            F.array().cast("array<struct<line:int,words:array<string>>>")
        ),
    )
    long_enough = F.filter(units, lambda u: F.size(u["words"]) > least)
    grams = F.transform(long_enough, lambda u: F.struct(u["line"].alias("line"), _bigrams(u["words"]).alias("b")))

    def against(u: Column) -> Column:
        size = F.size(u["b"])
        tried = [
            F.when(
                size.between(*bounds[k]),
                F.struct(
                    u["line"].alias("line"),
                    F.lit(k).alias("license"),
                    (2.0 * F.size(F.array_intersect(u["b"], F.array(*[F.lit(x) for x in b]))) / (size + len(b))).alias("dice"),
                ),
            )
            for k, b in known.items()
        ]
        good = F.filter(F.array(*tried), lambda m: m.isNotNull() & (m["dice"] >= threshold))
        # the first of equal coefficients is the first in the alphabet
        return F.aggregate(
            good,
            F.lit(None).cast("struct<line:int,license:string,dice:double>"),
            lambda best, m: F.when(best.isNull() | (m["dice"] > best["dice"]), m).otherwise(best),
        )

    matches = F.filter(F.transform(grams, against), lambda m: m.isNotNull())
    best = F.aggregate(
        F.col("matches"),
        F.lit(None).cast("struct<line:int,license:string,dice:double>"),
        lambda b, m: F.when(
            b.isNull() | (m["dice"] > b["dice"]) | ((m["dice"] == b["dice"]) & (m["license"] < b["license"])), m
        ).otherwise(b),
    )
    runs = _runs(_words(text), known, threshold)
    named = _once(
        F.struct(matches.alias("m"), runs.alias("r")),
        lambda x: F.concat(x["m"], _as_matches(x["r"], lines, x["m"], known, threshold)),
    )
    return docs.select("doc_id", named.alias("matches")).select(
        "doc_id",
        "matches",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_sort(F.array_distinct(F.col("matches.license"))).alias("licenses"),
        best["license"].alias("best_license"),
        best["dice"].alias("best_dice"),
    )
