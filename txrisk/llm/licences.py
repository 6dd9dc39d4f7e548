"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (lines of a text) are classified by a logistic regression over a sparse set of word 1- and 2-grams, the
n-grams of the licence templates without those of function words.  It is trained on the templates, each also with words
left out, against all ordinary paragraphs of the corpus as the class ``unknown``: they are counted by the n-grams that
they have, and together weigh ``ORDINARY`` at most.  A paragraph is given to a family
only above a threshold calibrated on the held-out half of the ordinary paragraphs, and only if its words, or a stretch of them, match a
template of the family.

DataFrame functions only: no shuffle of texts, no Python.

Defined results: null and empty texts have no paragraphs; a paragraph without any n-gram of the model is ``unknown``;
repeated rows are judged alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import smallest, written
from txrisk.llm.linear import doubles, fit, let, strings

#: Licence notices by family (fixed values).
TEMPLATES = {
    "Apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
               "SPDX-License-Identifier: Apache-2.0"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "CC": ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY 4.0.",
           "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "MIT": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}
FAMILIES = sorted(TEMPLATES)

#: Words without features of their own (fixed values).
FUNCTION_WORDS = set("a an and any are be by can for in is it may met not of or that the this to under use with without you".split())

#: Most weight of all ordinary paragraphs in training (a template's is 20), and share of those held out that is let through.
ORDINARY, LET_THROUGH = 2000.0, 0.001

#: Sets of n-grams for one task of the fit.
TASK_SETS = 100_000

#: Share of words that a paragraph and a template must have in common (twice the common words over all words).
CONFIRMED = 0.7


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^a-z0-9]+"), lambda w: w != "")


def grams(tokens: Column) -> Column:
    """Distinct 1- and 2-grams."""

    def of(t: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(t) - 2), lambda i: F.concat_ws(" ", F.get(t, i), F.get(t, i + 1)))
        return F.array_distinct(F.when(F.size(t) > 1, F.concat(t, pairs)).otherwise(t))

    return let(tokens, of)


def _tokens(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _vocabulary() -> list[str]:
    out = set()
    for text in (t for family in FAMILIES for t in TEMPLATES[family]):
        w = _tokens(text)
        out |= {x for x in w if x not in FUNCTION_WORDS and not x.isdigit()}
        out |= {f"{a} {b}" for a, b in zip(w, w[1:]) if not {a, b} <= FUNCTION_WORDS}
    return sorted(out)


VOCABULARY = _vocabulary()

#: A line without any of these words has no feature at all.
CUE = r"(?i)(?<![A-Za-z0-9])(?:" + "|".join(sorted({w for g in VOCABULARY for w in g.split() if w not in FUNCTION_WORDS})) + r")(?![A-Za-z0-9])"


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p.rlike(r"[^\x20\x09-\x0D]"))


def _variants(text: str) -> list[str]:
    """A template, and it with every fifth word left out, from each of five places."""
    w = text.split()
    return [text] + [" ".join(x for i, x in enumerate(w) if i % 5 != k) for k in range(5) if len(w) > 5]


def counted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(at, held, n): ordinary paragraphs of all texts by their places in the vocabulary, half of them, by hash, held out."""
    plain = (docs.select(F.explode(paragraphs(F.col(text_column))).alias("p"))
             .filter(~F.lower("p").rlike("licen[sc]|copyright|spdx|creative commons")))
    at = F.when(F.col("p").rlike(CUE), F.array_sort(places(grams(words(F.col("p")))))).otherwise(F.array().cast("array<int>"))
    found = plain.select(at.alias("at"), (F.xxhash64("p") % 2 == 0).alias("held"))
    return found.groupBy("at", "held").agg(F.count(F.lit(1)).alias("n")).sort("at", "held")


def train(docs: DataFrame, text_column: str = "text") -> tuple[list[list[float]], list[float], float]:
    """Weights and intercepts by class (families, then unknown), and the calibrated threshold."""
    spark = docs.sparkSession
    ordinary = written(counted(docs, text_column), "ordinary")
    size = {r["held"]: (r["sets"], r["n"]) for r in ordinary.groupBy("held").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("n")).collect()}
    sets, total = size.get(False, (0, 0))
    known = spark.createDataFrame([(v, float(k)) for k, f in enumerate(FAMILIES) for t in TEMPLATES[f] for v in _variants(t)],
                                  "p string, label double")
    unknown = F.lit(float(len(FAMILIES))).alias("label")
    names = strings(VOCABULARY)
    rows = known.select(grams(words(F.col("p"))).alias("features"), "label", F.lit(20.0).alias("weight")).unionByName(
        ordinary.filter("not held").select(F.transform("at", lambda i: F.get(names, i)).alias("features"), unknown,
                                           (F.col("n") * F.lit(min(1.0, ORDINARY / max(total, 1)))).alias("weight"))).unionByName(
        spark.range(1).select(F.array().cast("array<string>").alias("features"), unknown, F.lit(20.0).alias("weight")))
    weights, intercepts = fit(spark, rows, VOCABULARY, len(FAMILIES) + 1, 0.002, 0.5, 40, 1 + sets // TASK_SETS)
    top, held = 0.0, size.get(True, (0, 0))[1]
    if held:
        scored = written(ordinary.filter("held").select("n", powers(F.col("at"), (weights, intercepts)).alias("power"))
                         .select("n", best(F.col("power"))[1].alias("value")), "scores")
        place = (1 - LET_THROUGH) * (held - 1)
        low, high = smallest(scored, int(place)), smallest(scored, -int(-place // 1))
        top = low + (place - int(place)) * (high - low)
    return weights, intercepts, max(0.5, top)


def places(features: Column) -> Column:
    """Places of the features in the vocabulary; others are dropped."""
    names = strings(VOCABULARY)
    return F.filter(F.transform(features, lambda g: F.array_position(names, g).cast("int") - 1), lambda i: i >= 0)


def powers(at: Column, model: tuple) -> Column:
    """Unnormalised probabilities by class."""

    def score(weights: Column, intercept: float) -> Column:
        return F.exp(F.aggregate(at, F.lit(intercept), lambda a, i: a + F.get(weights, i)))

    return F.array(*(score(doubles(w), b) for w, b in zip(model[0], model[1])))


def best(power: Column) -> tuple[Column, Column]:
    """The likeliest family and its probability; ``power`` should be a column, not an expression."""
    families = F.slice(power, 1, len(FAMILIES))
    top = F.array_max(families)
    return (F.get(strings(FAMILIES), F.array_position(families, top).cast("int") - 1),
            top / F.aggregate(power, F.lit(0.0), lambda a, x: a + x))


def _inside(tokens: Column, template: list[str], others: set[str]) -> Column:
    """Whether some stretch of the tokens as long as the template has enough words in common with it, one of them its family's own."""
    own, size = sorted(set(template)), len(template)
    telling = strings([w for w in own if w not in FUNCTION_WORDS | others and not w.isdigit()])

    def like(i: Column) -> Column:
        part = F.slice(tokens, i + 1, F.lit(size))
        common = F.size(F.array_intersect(part, strings(own)))
        return F.arrays_overlap(part, telling) & (2 * common >= CONFIRMED * (F.size(F.array_distinct(part)) + len(own)))

    return F.when(F.size(tokens) >= size, F.exists(F.sequence(F.lit(0), F.size(tokens) - size), like)).otherwise(F.lit(False))


def _confirmed(tokens: Column, family: str) -> Column:
    out = F.lit(False)
    others = {w for f in FAMILIES if f != family for t in TEMPLATES[f] for w in _tokens(t)}
    for template in TEMPLATES[family]:
        own = sorted(set(_tokens(template)))
        common = F.size(F.array_intersect(tokens, strings(own)))
        out = out | (2 * common >= CONFIRMED * (F.size(F.array_distinct(tokens)) + len(own)))
        out = out | ((common >= len(own)) & F.lit(len(own) >= 8))  # a long template inside a longer paragraph
        out = out | _inside(tokens, _tokens(template), others)
    return out


def scan(docs: DataFrame, model: tuple, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_paragraphs, licences): the licensed paragraphs of every text, as structs (paragraph, family, score)."""
    weights, intercepts, threshold = model
    found = docs.select(F.col(id_column).alias("doc_id"), paragraphs(F.col(text_column)).alias("paragraphs"))
    # few paragraphs have a cue at all; only those are taken apart
    cued = found.withColumn("cued", F.filter(F.transform("paragraphs", lambda p, i: F.struct(i.alias("paragraph"), p.alias("p"))),
                                             lambda x: x["p"].rlike(CUE)))


    def taken(x: Column) -> Column:
        return F.struct(x["paragraph"].alias("paragraph"), words(x["p"]).alias("tokens"))

    def placed(x: Column) -> Column:
        return F.struct(x["paragraph"].alias("paragraph"), x["tokens"].alias("tokens"), places(grams(x["tokens"])).alias("at"))

    def weighed(x: Column) -> Column:
        return F.struct(x["paragraph"].alias("paragraph"), x["tokens"].alias("tokens"), powers(x["at"], (weights, intercepts)).alias("power"))

    def named(x: Column) -> Column:
        family, score = best(x["power"])
        return F.struct(x["paragraph"].alias("paragraph"), x["tokens"].alias("tokens"), family.alias("family"), score.alias("score"))

    def confirmed(x: Column) -> Column:
        sure = F.lit(False)
        for name in FAMILIES:
            sure = F.when(x["family"] == name, _confirmed(x["tokens"], name)).otherwise(sure)
        return (x["score"] >= threshold) & sure

    out = cued
    for step in (taken, placed, weighed, named):
        out = out.withColumn("cued", F.transform("cued", step))
    kept = F.filter("cued", confirmed)
    licences = F.transform(kept, lambda x: F.struct(x["paragraph"].alias("paragraph"), x["family"].alias("family"), x["score"].alias("score")))
    return out.select("doc_id", F.size("paragraphs").cast("long").alias("n_paragraphs"), licences.alias("licences"))
