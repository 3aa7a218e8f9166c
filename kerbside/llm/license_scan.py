"""Licence scans: a paragraph classifier over sparse word n-grams, with template comparison.

Paragraphs are the lines of a text. A multinomial logistic regression over word unigrams and
bigrams tells licence families from an ``unknown`` class; it is fitted by numpy on the driver from the
templates below (whole, and cut at random as notices are) and a bounded sample of the corpus's own
paragraphs, which are unknown unless they hold a template. A temperature fitted on rows kept apart calibrates the
probabilities. A predicted family is confirmed if enough of the 5-word shingles of one of its templates stand
in the paragraph (or all words of a shorter template in a row).

Scoring is joins and sums: words that carry no weight never leave the scan, because a paragraph without
any weighed word is unknown by the bias alone.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm.common import bounded_draw
from kerbside.session import stage

# Short public notices by which works state their licence.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("bsd-3-clause", "Use of this source code is governed by a BSD-style license."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("all-rights-reserved", "All rights reserved."),
    ("all-rights-reserved", "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission."),
)

UNKNOWN = "unknown"
FAMILIES = tuple(dict.fromkeys(f for f, _ in TEMPLATES))
_SPLIT = r"[^a-z0-9.\-]+|[.\-]+(?=[^a-z0-9]|$)"


def plain_words(text: str) -> list[str]:
    """Words as the scan sees them: lower-cased ASCII letters and digits, with inner points and hyphens."""
    return [w for w in re.split(_SPLIT, text.lower()) if w]


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def grams_of(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))}


@dataclass
class LicenceModel:
    """Weights per n-gram and class (the last class is unknown), class biases and the temperature."""

    grams: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_licences(background: list[str], copies: int = 30, epochs: int = 300) -> LicenceModel:
    """From the templates and paragraphs of the corpus, which count as unknown unless they hold a template.

    N-grams are those of the templates that less than one in a hundred background paragraphs has; a
    bigram needs at least one word that is itself among them.
    """
    rng = np.random.default_rng(3)
    templates = [(FAMILIES.index(f), plain_words(t)) for f, t in TEMPLATES]
    spelled = [" ".join(w) for _, w in templates]
    others = [w for w in map(plain_words, background) if not any(f" {s} " in f" {' '.join(w)} " for s in spelled)]
    common: dict[str, int] = {}
    for w in others:
        for g in grams_of(w):
            common[g] = common.get(g, 0) + 1
    limit = max(1, len(others) // 100)
    singles = {w for _, words in templates for w in words if common.get(w, 0) <= limit}
    grams = sorted({g for _, words in templates for g in grams_of(words) if common.get(g, 0) <= limit and not singles.isdisjoint(g.split(" "))})
    index = {g: i for i, g in enumerate(grams)}
    rows: list[tuple[list[int], int]] = []
    filler = [w for w in others if w] or [["text"]]
    for k, words in templates:
        for n in range(copies):
            cut = words
            if n % 3 == 1 and len(words) > 8:  # notices are often shortened
                at = int(rng.integers(0, len(words) // 3))
                cut = words[at : at + max(8, int(len(words) * rng.uniform(0.7, 1.0)))]
            if n % 3 == 2:  # or stand inside a line with other words
                cut = [*cut, *filler[int(rng.integers(len(filler)))][:12]]
            rows.append((sorted(index[g] for g in grams_of(cut) if g in index), k))
    unknown = len(FAMILIES)
    bare = 0
    for w in others:
        own = sorted(index[g] for g in grams_of(w) if g in index)
        bare += not own
        if own:
            rows.append((own, unknown))
    for _, words in templates:  # single licence words in running text are unknown
        for w in set(words) & singles:
            rows.append(([index[w]], unknown))
    rows += [([], unknown)] * min(bare, 50 * len(rows)) or [([], unknown)]
    apart = np.arange(len(rows)) % 5 == 4
    y = np.array([k for _, k in rows])
    x = np.zeros((len(rows), len(grams)))
    for r, (own, _) in enumerate(rows):
        x[r, own] = 1.0
    # The many rows without any n-gram are one row with a weight.
    full, first = np.flatnonzero(x.any(1) & ~apart), np.zeros((1, len(grams)))
    xs, ys = np.vstack([x[full], first]), np.append(y[full], unknown)
    weight = np.append(np.ones(len(full)), max(1.0, float((~x.any(1)).sum())))
    weight /= weight.sum()
    w, b = np.zeros((len(grams), unknown + 1)), np.zeros(unknown + 1)
    vw, vb, goal = np.zeros_like(w), np.zeros_like(b), np.eye(unknown + 1)[ys]
    for _ in range(epochs):
        g = (_softmax(xs @ w + b) - goal) * weight[:, None]
        vw, vb = 0.9 * vw - 2.0 * (xs.T @ g + 1e-6 * w), 0.9 * vb - 2.0 * g.sum(0)
        w, b = w + vw, b + vb
    held = np.flatnonzero(apart & x.any(1))
    held = held if len(held) else full
    z, target = x[held] @ w + b, y[held]

    def loss(t: float) -> float:
        return float(-np.log(_softmax(z / t)[np.arange(len(held)), target] + 1e-12).mean())

    temperature = min(np.exp(np.linspace(math.log(0.2), math.log(5), 41)).tolist(), key=loss)
    return LicenceModel(grams, w, b, temperature)


def scan_licences(
    documents: DataFrame, threshold: float = 0.5, confirm: float = 0.8, sample_rows: int = 4000
) -> DataFrame:
    """(doc_id, family, families, n_paragraphs, n_confirmed, probability) of every row of ``documents``.

    family is the likeliest confirmed family of the document (else the likeliest predicted one, else
    NULL), families all confirmed ones, sorted; n_paragraphs counts paragraphs predicted as a licence with
    ``threshold`` or more, n_confirmed those that hold ``confirm`` of a template's 5-word shingles and its version.
    NULL and empty texts have none. Repeated rows and rows with NULL ids are judged one by one.
    """
    spark = documents.sparkSession
    docs = documents.select("doc_id", "text")
    drawn = bounded_draw(docs.where(F.col("text").isNotNull()), sample_rows)
    lines = F.split(F.col("text"), "\n")  # one paragraph of each sampled document
    some = drawn.select(F.get(lines, F.pmod("draw", F.size(lines)).cast("int")).alias("p"))
    model = fit_licences(sorted(r.p for r in some.collect() if r.p))
    classes = [*FAMILIES, UNKNOWN]
    singles = [g for g in model.grams if " " not in g]

    marked = stage(
        docs.select("doc_id", F.monotonically_increasing_id().alias("row"), _candidates(F.col("text"), singles).alias("found")),
        "licence_paragraphs",
    )
    paragraphs = marked.select("row", F.explode("found").alias("words")).select(
        "row", F.monotonically_increasing_id().alias("paragraph"), "words"
    )
    paragraphs = stage(paragraphs, "licence_words")
    n = F.size("words")
    bigrams = F.when(
        n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)))
    ).otherwise(F.array().cast("array<string>"))
    grams = paragraphs.select("row", "paragraph", F.explode(F.array_distinct(F.concat("words", bigrams))).alias("gram"))
    weights = _weight_table(spark, model)
    scored = (
        grams.join(F.broadcast(weights), "gram")  # one row per n-gram of the templates
        .groupBy("row", "paragraph")
        .agg(*[F.sum(F.get("weights", F.lit(i))).alias(f"z{i}") for i in range(len(classes))])
    )
    logits = F.array(*[(F.col(f"z{i}") + F.lit(float(b))) / F.lit(model.temperature) for i, b in enumerate(model.bias)])
    predicted = (
        scored.select("row", "paragraph", logits.alias("logits"))
        .select("row", "paragraph", "logits", F.array_max("logits").alias("top"))
        .select(
            "row",
            "paragraph",
            F.element_at(F.array(*[F.lit(c) for c in classes]), F.array_position("logits", F.col("top")).cast("int")).alias("family"),
            (1 / F.aggregate("logits", F.lit(0.0), lambda s, z: s + F.exp(z - F.col("top")))).alias("p"),
        )
        .where((F.col("family") != UNKNOWN) & (F.col("p") >= threshold))
    )
    judged = predicted.join(paragraphs, ["row", "paragraph"]).select(
        "row", "family", "p", _confirmed(F.col("words"), F.col("family"), confirm).alias("confirmed")
    )
    per_row = judged.groupBy("row").agg(
        F.count("*").alias("n_paragraphs"),
        F.sum(F.col("confirmed").cast("long")).alias("n_confirmed"),
        F.max(F.struct("confirmed", "p", "family")).alias("best"),
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
    )
    return marked.select("doc_id", "row").join(per_row, "row", "left").select(
        "doc_id",
        F.col("best.family").alias("family"),
        F.concat_ws(",", F.coalesce("families", F.array().cast("array<string>"))).alias("families"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"),
        F.coalesce("n_confirmed", F.lit(0)).cast("long").alias("n_confirmed"),
        F.col("best.p").alias("probability"),
    )


def _candidates(text: Column, singles: list[str]) -> Column:
    """Word arrays of the paragraphs that hold at least one weighed word."""
    known = F.array(*[F.lit(w) for w in singles]) if singles else F.array().cast("array<string>")
    return F.filter(F.transform(F.split(text, "\n"), word_array), lambda words: F.arrays_overlap(words, known))


def _weight_table(spark: SparkSession, model: LicenceModel) -> DataFrame:
    """(gram, weights) as a DataFrame: one row per n-gram of the templates."""
    rows = F.array(
        *[
            F.struct(F.lit(g).alias("gram"), F.array(*[F.lit(float(v)) for v in w]).alias("weights"))
            for g, w in zip(model.grams, model.weights, strict=True)
        ]
    )
    return spark.range(1).select(F.inline(rows))


def _confirmed(words: Column, family: Column, confirm: float) -> Column:
    """Whether ``confirm`` of the shingles of one of the family's templates stand in the paragraph."""
    spelled = F.concat(F.lit(" "), F.concat_ws(" ", words), F.lit(" "))
    out = F.lit(False)
    for name, text in TEMPLATES:
        w = plain_words(text)
        shingles = sorted({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
        held = sum((spelled.contains(f" {s} ").cast("int") for s in shingles[1:]), spelled.contains(f" {shingles[0]} ").cast("int"))
        here = (family == name) & (held >= math.ceil(confirm * len(shingles)))
        for mark in {x for x in w if any(c.isdigit() for c in x)}:  # a version: one of the shingles it is in must stand there
            of = [spelled.contains(f" {s} ") for s in shingles if mark in s.split(" ")]
            here = here & reduce(or_, of)
        out = out | here
    return out
