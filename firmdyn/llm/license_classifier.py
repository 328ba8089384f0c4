"""License scans with a trained paragraph classifier, in DataFrame operations only.

A paragraph is a line with the ``window_lines - 1`` lines after it (notices are often wrapped), and
as many of these lines as end a sentence or stand before a blank line.
Its features are the word n-grams (one and two words) of the known notices that it holds. A
multinomial logistic regression over the licence families and an unknown class is trained on
variants of the notices (words left out, put before ordinary lines of the corpus) and, as unknown,
on ordinary lines and on beginnings of notices; a temperature fitted on a held-out part
calibrates it.

A paragraph may hold notices of several families (dual licences are common), so every family is
judged. Comparison with the notices confirms it: ``min_similarity`` of the word pairs of one of
its notices must be in the paragraph, among them one that no other family's notices have (if
there is one), and the same part of what the notice has beside any other family's notice that is
in the paragraph to an equal or greater part. So a GPL notice is not found in that of the LGPL, and
both are found where both are. A confirmed family counts if it is probable enough; the odds of
the other confirmed ones are left out of the sum, as they do not speak against it.

Hence a paragraph can only count if it holds one of the anchors: for each notice, its longest word
pairs, just enough of them that the others alone cannot confirm it. A regular expression finds
texts with anchors; all other work is done in the row, on those only, without any shuffle.

The training lines are a bounded sample (``sample_docs`` documents, ``sample_lines`` lines).

Defined cases: null or empty text has no license; texts of any length are judged whole, in their
row; families that are equally similar both count if each has word pairs of its own there, and a
family whose notice is part of another's on the same line (CC BY beside CC BY-SA) is not told
apart from it; repeated rows are judged alike; columns other than the id and the text are not
read; an empty table trains on the notices alone and gives no rows.
"""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmdyn.llm.common import fold
from firmdyn.session import stash

UNKNOWN = "unknown"
# The public short notices of the licence families.
NOTICES: dict[str, tuple[str, ...]] = {
    "AGPL": ("This program is licensed under the GNU Affero General Public License, version 3.",
             "You should have received a copy of the GNU Affero General Public License along with this program."),
    "Apache": ("Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
               "compliance with the License. You may obtain a copy of the License at",
               "Released under the Apache License.",
               "Licensed under either of Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0"),
    "BSD": ("Released under the BSD 3-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:",
            "Use of this source code is governed by a BSD-style license.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission.",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "CC-BY": ("Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0": ("Released under CC0 1.0 Universal Public Domain Dedication.",
            "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
            "to this work."),
    "EPL": ("This program and the accompanying materials are made available under the terms of the Eclipse Public "
            "License v2.0 which accompanies this distribution",
            "Licensed under the Eclipse Public License.", "SPDX-License-Identifier: EPL-2.0"),
    "GPL": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation",
            "You should have received a copy of the GNU General Public License along with this program.",
            "SPDX-License-Identifier: GPL-3.0-or-later"),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "Released under the ISC License.", "SPDX-License-Identifier: ISC"),
    "LGPL": ("This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "You should have received a copy of the GNU Lesser General Public License along with this library.",
             "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software.",
            "or MIT license at your option", "SPDX-License-Identifier: MIT"),
    "MPL": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Released under the Mozilla Public License.", "SPDX-License-Identifier: MPL-2.0"),
    "Proprietary": ("Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly "
                    "prohibited.",
                    "This software is proprietary; no license is granted without written permission."),
}
#: Sentences about licenses that are no notice.
NO_NOTICES = ("The license of the driver was checked at the border.", "Ask the public library for a license.",
              "A general license is a form that the public source can use.", "They were released under the bridge.")
VARIANTS = 16


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z]+)"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a lambda variable is never inlined)."""
    return F.transform(F.array(value), body)[0]


def word_pairs(found: Column) -> Column:
    return _let(found, lambda w: F.when(
        F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - 1, F.lit(1))),
                                   lambda i: F.concat_ws(" ", F.get(w, i - 1), F.get(w, i)))
    ).otherwise(F.array().cast("array<string>")))


def _local(spark: SparkSession, rows: list[tuple[str, ...]], *names: str) -> DataFrame:
    """A small table of strings, without leaving SQL."""
    structs = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows])
    return spark.range(1).select(F.inline(structs))


def notice_table(spark: SparkSession) -> DataFrame:
    """(family, notice, words, pairs): the notices' words and distinct pairs."""
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    return (_local(spark, rows, "family", "notice").withColumn("words", words(F.col("notice")))
            .withColumn("pairs", F.array_distinct(word_pairs(F.col("words")))))


def anchors(notices: list, min_similarity: float) -> list[str]:
    """Word pairs such that a paragraph without any of them is similar to no notice."""
    out = set()
    for row in notices:
        pairs = sorted(row["pairs"], key=lambda p: (-len(p), p))
        spare = len(pairs) - int(np.ceil(min_similarity * len(pairs) - 1e-9))  # may be missing
        out.update(pairs[:spare + 1])
    return sorted(out)


def anchor_pattern(found: list[str]) -> str:
    """A regular expression for lower-case texts that hold one of the word pairs. Common
    beginnings are shared, so at most word starts one character decides against it."""
    tree: dict = {}
    for pair in found:
        node = tree
        for c in pair + "$":
            node = node.setdefault(c, {})

    def written(node: dict) -> str:
        special = {" ": "[^a-z]+", "$": "(?![a-z])"}
        parts = [special.get(c, c) + written(below) for c, below in sorted(node.items())]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")" if parts else ""

    return f"(?<![a-z])(?=[{''.join(sorted(tree))}]){written(tree)}"


def _similar(pairs: Column, notice_pairs: Column, least: float) -> Column:
    return F.size(F.array_intersect(pairs, notice_pairs)) >= F.lit(least) * F.size(notice_pairs)


def training_rows(docs: DataFrame, notices: DataFrame, id_col: str, text_col: str, sample_docs: int,
                  sample_lines: int) -> DataFrame:
    """(family, grams, held): variants of notices, and unknown paragraphs."""
    spark = docs.sparkSession
    known = notices.select(F.col("notice").alias("known")).distinct()
    total = docs.count()
    step = max(1, total // sample_docs)
    lines = (docs.where(fold(id_col, step) == 0).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .orderBy(F.xxhash64("id"), "id", "text").limit(2 * sample_docs)
             .select(F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")))
    fams = notices.agg(F.collect_list("pairs").alias("all_pairs"))
    lines = (lines.where(F.length("line") > 0).distinct()
             .orderBy(F.xxhash64("line"), "line").limit(sample_lines)
             .join(F.broadcast(fams)).withColumn("words", words(F.col("line")))
             .withColumn("pairs", word_pairs(F.col("words")))
             .where(_let(F.col("pairs"), lambda own: ~F.exists("all_pairs", lambda p: _similar(own, p, 0.3))))
             .select("words"))
    ordinary = stash(lines.withColumn("nth", F.row_number().over(Window.orderBy(F.xxhash64("words"))) - 1))
    n_lines = max(1, ordinary.count())
    # a word of one family alone is never left out: without it the notice may be another's
    shared = (notices.select("family", F.explode("words").alias("word")).distinct().groupBy("word").count()
              .where("count > 1").agg(F.collect_list("word").alias("shared")))
    variants = (notices.join(F.broadcast(shared))
                .select("family", "words", "shared", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v"))
                .withColumn("key", F.xxhash64("words", "v"))
                .withColumn("left", F.filter("words", lambda w, i: (F.col("v") < 2) | ~F.array_contains("shared", w) | (
                    F.pmod(F.xxhash64(w, i, F.col("v")), F.lit(9)) != 0)))
                .withColumn("nth", F.pmod("key", F.lit(n_lines)).cast("int")))
    filler = F.when(F.pmod("v", F.lit(2)) == 1, F.coalesce(ordinary["words"], F.array())).otherwise(F.array())
    positive = variants.join(ordinary, "nth", "left").select("family", F.concat("left", filler).alias("words"), "key")
    begun = variants.where((F.col("v") < 3) & (F.size("words") > 5)).join(ordinary, "nth", "left").select(
        F.lit(UNKNOWN).alias("family"),
        F.concat(F.slice("left", 1, F.floor(F.size("left") * 0.3).cast("int")), filler).alias("words"), "key")
    plain = ordinary.select(F.lit(UNKNOWN).alias("family"), "words", F.xxhash64("words").alias("key"))
    told = _local(spark, [(x,) for x in NO_NOTICES], "text").select(
        F.lit(UNKNOWN).alias("family"), words(F.col("text")).alias("words"), F.xxhash64("text").alias("key"))
    rows = positive.unionByName(begun).unionByName(plain).unionByName(told)
    return rows.select("family", F.concat("words", word_pairs(F.col("words"))).alias("grams"),
                       (F.pmod(F.xxhash64("key", F.lit("held")), F.lit(4)) == 0).alias("held"))


def _constant(value, schema: str) -> Column:
    """A nested constant as one literal."""
    return F.from_json(F.lit(json.dumps(value)), schema)


class LicenseModel:
    """Families (the last is unknown), n-gram weights, biases and temperature."""

    def __init__(self, families, grams, weights, bias, temperature):
        self.families, self.grams, self.weights = families, grams, weights
        self.bias, self.temperature = bias, temperature


def train(docs: DataFrame, notices: DataFrame, id_col: str, text_col: str, sample_docs: int,
          sample_lines: int) -> LicenseModel:
    rows = training_rows(docs, notices, id_col, text_col, sample_docs, sample_lines)
    families = [*sorted(NOTICES), UNKNOWN]
    label = F.array_position(F.lit(families), F.col("family")) - 1
    rows = stash(rows.withColumn("label", label.cast("double")).coalesce(4))
    # the vocabulary is that of the notices
    vocabulary = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=1.0).fit(
        notices.select(F.concat("words", "pairs").alias("grams")).coalesce(1))
    data = vocabulary.transform(rows).cache()
    fit = LogisticRegression(regParam=5e-4, maxIter=80, family="multinomial").fit(data.where(~F.col("held")))
    weights, bias = fit.coefficientMatrix.toArray(), np.asarray(fit.interceptVector)
    held = fit.transform(data.where("held")).select("rawPrediction", "label").collect()  # of the bounded sample
    data.unpersist()
    raw = np.array([r["rawPrediction"].toArray() for r in held]).reshape(-1, len(bias))
    is_label = np.array([int(r["label"]) for r in held], int)

    def loss(t: float) -> float:
        z = raw / t
        top = z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z - top).sum(axis=1)) + top[:, 0] - z[np.arange(len(z)), is_label]).sum())

    temperature = min((2.0 ** (k / 4) for k in range(-12, 13)), key=loss)
    return LicenseModel(families[:len(bias)], list(vocabulary.vocabulary), weights, bias, temperature)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  window_lines: int = 3, min_probability: float = 0.5, min_similarity: float = 0.6,
                  sample_docs: int = 500, sample_lines: int = 3000, use_anchors: bool = True) -> DataFrame:
    """One row per input row: id, licenses (sorted families, comma-separated; empty if none),
    n_families, probability (of the surest confirmed family; null if none). ``use_anchors=False``
    judges every paragraph (slow, the same result)."""
    spark = docs.sparkSession
    notices = notice_table(spark)
    rows = notices.collect()  # the notices above
    model = train(docs, notices, id_col, text_col, sample_docs, sample_lines)

    text = F.col(text_col)
    find = anchor_pattern(anchors(rows, min_similarity))
    windows = _let(F.split(text, "\n"), lambda lines: F.transform(
        lines, lambda _, i: F.slice(lines, i + 1, window_lines)))

    def joined(lines: Column) -> Column:
        return F.concat_ws("\n", lines)

    if use_anchors:
        windows = F.when(F.lower(text).rlike(find), F.filter(windows, lambda w: F.lower(joined(w)).rlike(find)))
    windows = F.array_distinct(F.flatten(F.transform(windows, lambda w: F.transform(F.filter(
        F.sequence(F.lit(1), F.size(w)),
        lambda n: (n == F.size(w)) | F.get(w, n - 1).rlike(r"[.!?]\s*$") | F.get(w, n).rlike(r"^\s*$")),
        lambda n: joined(F.slice(w, 1, n))))))
    grams = _constant(model.grams, "array<string>")
    weight_of = _constant(dict(zip(model.grams, model.weights.T.tolist())), "map<string, array<double>>")
    bias, names = _constant(model.bias.tolist(), "array<double>"), _constant(model.families, "array<string>")
    holders: dict[str, set[str]] = {}
    for r in rows:
        for pair in r["pairs"]:
            holders.setdefault(pair, set()).add(r["family"])
    templates = _constant([{"family": r["family"], "pairs": r["pairs"], "own": [p for p in r["pairs"] if len(holders[p]) == 1]}
                           for r in rows], "array<struct<family: string, pairs: array<string>, own: array<string>>>")

    def features(w: Column) -> Column:
        return _let(words(w), lambda x: F.struct(x.alias("words"), word_pairs(x).alias("pairs")))

    def part(pairs: Column, of: Column) -> Column:
        return F.size(F.array_intersect(pairs, of)) / F.size(of)

    def similar(x: Column) -> Column:
        """The notices that the paragraph is similar to, with the part of them that it holds."""
        return F.filter(F.transform(templates, lambda t: F.struct(
            t["family"].alias("family"), t["pairs"].alias("pairs"), t["own"].alias("own"),
            part(x["pairs"], t["pairs"]).alias("part"))),
            lambda t: (t["part"] >= min_similarity) & ((F.size(t["own"]) == 0) | F.arrays_overlap(x["pairs"], t["own"])))

    def confirmed(x: Column) -> Column:
        """The families of those that no other one explains."""
        def explained(t: Column, other: Column) -> Column:
            return (other["family"] != t["family"]) & (other["part"] >= t["part"]) & _let(
                F.array_except(t["pairs"], other["pairs"]),
                lambda beside: (F.size(beside) == 0) | (part(x["pairs"], beside) < min_similarity))

        return F.array_distinct(F.transform(
            F.filter(x["near"], lambda t: ~F.exists(x["near"], lambda other: explained(t, other))), lambda t: t["family"]))

    def logits(x: Column) -> Column:
        held = F.array_intersect(F.concat(x["words"], x["pairs"]), grams)
        return F.aggregate(held, bias, lambda total, g: F.zip_with(
            total, F.element_at(weight_of, g), lambda a, b: a + b))

    def odds(x: Column) -> Column:
        return F.transform(x["logits"], lambda z: F.exp((z - F.array_max(x["logits"])) / F.lit(model.temperature)))

    def verdicts(x: Column) -> Column:
        """(family, p) of the confirmed families, p beside all that is not confirmed."""
        against = F.aggregate(F.zip_with(x["odds"], names, lambda o, f: F.when(F.array_contains(x["families"], f), 0.0).otherwise(o)),
                              F.lit(0.0), lambda a, b: a + b)
        return _let(against, lambda rest: F.transform(x["families"], lambda f: _let(
            F.element_at(x["odds"], F.array_position(names, f).cast("int")),
            lambda own: F.struct(f.alias("family"), F.coalesce(F.try_divide(own, own + rest), F.lit(0.0)).alias("p")))))

    found = F.coalesce(windows, F.array().cast("array<string>"))
    step = F.transform(found, features)
    step = F.filter(F.transform(step, lambda x: F.struct(x["words"].alias("words"), x["pairs"].alias("pairs"), similar(x).alias("near"))),
                    lambda x: F.size(x["near"]) > 0)
    step = F.transform(step, lambda x: F.struct(confirmed(x).alias("families"), logits(x).alias("logits")))
    step = F.transform(step, lambda x: F.struct(x["families"].alias("families"), odds(x).alias("odds")))
    step = F.filter(F.flatten(F.transform(step, verdicts)), lambda x: x["p"] >= min_probability)
    result = _let(step, lambda sure: _let(
        F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"]))),
        lambda families: F.struct(
            F.array_join(families, ",").alias("licenses"), F.size(families).alias("n_families"),
            F.array_max(F.transform(sure, lambda x: x["p"])).alias("probability"))))
    return docs.select(id_col, result.alias("_result")).select(id_col, "_result.*")
