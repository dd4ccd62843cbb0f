"""Licence scans by a trained paragraph classifier, all in DataFrame functions.

A paragraph is a line, or a run of lines. Its features are the word 1-grams and 2-grams that contain an anchor: a word of the licence
templates that is rare in the corpus outside of notices, however common those are. A sparse multinomial logistic regression over these tells the licence
families and the unknown class apart; it is trained on varied templates, on scraps of templates and on paragraphs
of a bounded sample of the corpus, ``SAMPLE`` documents whose ids hash lowest. A second logistic curve,
fitted on variants held back, calibrates known against unknown. A family predicted is confirmed if a template of
it is contained in the paragraph by ``CONTAINED`` of its 2-grams or more.

A notice may be wrapped over lines, with comment marks or without. From each line with an anchor, and from the line before
it, runs of lines up to a line without words are read as paragraphs too, as far as the longest template reaches. They
are classified and confirmed in the same way, if any template is contained in the longest run. Of confirmed runs that
share a line the one counts that holds most of its template, then the shortest, the surest and the first; it stands at
its first line.

A paragraph without an anchor has no feature, so it gets the same score as an empty one, which the calibration
puts among the unknown; documents without any anchor are told by one pattern match and never split. Weights and
templates are small and fixed in size, so they go to every task; paragraphs meet again by their own row only, so
no key is hot.

Defined cases: null and empty texts have no licence; a document's licence is the confirmed paragraph of highest
probability, then the first; repeated rows are told apart; very long texts and lines are read whole; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm.common import cut, sample_per_label, table

#: Notices by which licences are granted, by family.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Licensed under the BSD 2-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC0", "Released under CC0 1.0 Universal, public domain dedication."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                     "License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright (c) 2020 by the company. All rights reserved."),
    ("Proprietary", "No part of this publication may be reproduced without prior written permission."),
)
UNKNOWN = "unknown"
#: Documents of the corpus sample, and the share of its paragraphs that an anchor may be in at most.
SAMPLE = 2000
RARE = 0.005
#: Variants of each template, the hundredths of its words that a variant loses, and those that a scrap loses.
VARIANTS = 30
LOST, SCRAPPED = 12, 80
#: Share of a template's 2-grams that confirms it.
CONTAINED = 0.6
MODEL = {"regParam": 0.0005, "elasticNetParam": 0.5, "maxIter": 60, "standardization": False}


def words(paragraph: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}]+"), lambda word: word != "")


def bigrams(tokens: Column) -> Column:
    follow = F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))
    head = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0)))
    return F.zip_with(head, follow, lambda a, b: F.concat_ws(" ", a, b))


def features(tokens: Column, anchors: list[str]) -> Column:
    """The 1-grams and 2-grams that contain an anchor."""
    known = F.array(*[F.lit(anchor) for anchor in anchors])
    pairs = F.filter(bigrams(tokens), lambda pair: F.arrays_overlap(F.split(pair, " "), known))
    return F.concat(F.filter(tokens, lambda word: F.array_contains(known, word)), pairs)


def inline_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few fixed rows as a frame, by a literal."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def templates(spark: SparkSession) -> DataFrame:
    rows = [{"template": n, "family": family, "text": text} for n, (family, text) in enumerate(TEMPLATES)]
    return inline_rows(spark, rows, "template: int, family: string, text: string")


def lines(text: Column) -> Column:
    return F.split(text, r"\r\n|\r|\n")


def background(docs: DataFrame, sample: int) -> DataFrame:
    """``paragraph`` of the sampled documents."""
    few = docs.select("doc_id", "text").withColumn("all", F.lit("all"))
    rows = sample_per_label(few, "all", sample)
    return rows.select(F.explode(lines(F.coalesce("text", F.lit("")))).alias("paragraph")).filter("paragraph != ''")


def without_notices(corpus: DataFrame) -> DataFrame:
    """Paragraphs that hold no template: others are no example of the unknown, and do not make their words common."""
    own = [words(F.lit(text)) for _, text in TEMPLATES]
    return corpus.filter(~F.greatest(*[holds(words(F.col("paragraph")), tokens) for tokens in own]))


def find_anchors(spark: SparkSession, corpus: DataFrame) -> list[str]:
    """Words of the templates that are rare in the corpus sample, which holds no notices."""
    total = corpus.count()
    own = templates(spark).select(F.explode(words(F.col("text"))).alias("word")).distinct()
    seen = corpus.select(F.explode(F.array_distinct(words(F.col("paragraph")))).alias("word"))
    counts = seen.join(F.broadcast(own), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    rare = own.join(counts, "word", "left").filter(F.coalesce("n", F.lit(0)) <= RARE * total + 5)
    return sorted(row["word"] for row in rare.select("word").collect())  # fewer than the templates' words


def training_rows(spark: SparkSession, corpus: DataFrame, anchors: list[str]) -> DataFrame:
    """``family, grams, weight, held``: variants and scraps of templates, and corpus paragraphs without notices."""
    tokens = words(F.col("text"))

    def kept(share: int, salt: str) -> Column:
        draw = lambda i: F.pmod(F.xxhash64("template", "variant", i, F.lit(salt)), F.lit(100))
        return F.filter(tokens, lambda word, i: draw(i) >= F.when(F.col("variant") == 0, 0).otherwise(share))

    spread = templates(spark).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS))))
    held = F.pmod(F.xxhash64("template", "variant"), F.lit(3)) == 0
    varied = spread.select("family", kept(LOST, "varied").alias("tokens"), held.alias("held"))
    cut_off = spread.filter(F.size(tokens) > 12).select(
        "family",
        F.slice(
            tokens,
            F.floor(F.size(tokens) * F.pmod(F.xxhash64("variant", F.lit("at")), F.lit(40)) / 100).cast("int") + 1,
            F.ceil(F.size(tokens) * 0.6).cast("int"),
        ).alias("tokens"),
        held.alias("held"),
    )
    scraps = spread.filter("variant > 0").select(
        F.lit(UNKNOWN).alias("family"), kept(SCRAPPED, "scrap").alias("tokens"), held.alias("held")
    )
    scraps = scraps.filter(F.size("tokens") <= 2)
    plain = corpus.select(
        F.lit(UNKNOWN).alias("family"),
        words(F.col("paragraph")).alias("tokens"),
        (F.pmod(F.xxhash64("paragraph"), F.lit(3)) == 0).alias("held"),
    )
    some = varied.unionByName(cut_off).unionByName(scraps).unionByName(plain)
    return some.select("family", features(F.col("tokens"), anchors).alias("grams"), "held").filter(
        (F.col("family") == UNKNOWN) | (F.size("grams") > 0)
    )


def holds(tokens: Column, own: Column) -> Column:
    """Whether a paragraph has half of a template's 2-grams."""
    return F.size(F.array_intersect(bigrams(tokens), bigrams(own))) * 2 >= F.size(bigrams(own))


def fit(docs: DataFrame, sample: int = SAMPLE) -> dict:
    """A model: anchors, families, weights of each gram, intercepts and the calibrating curve."""
    spark = docs.sparkSession
    corpus = cut(without_notices(background(docs, sample).coalesce(4)), "licence-corpus")
    anchors = find_anchors(spark, corpus)
    rows = cut(training_rows(spark, corpus, anchors).coalesce(2), "licence-training")
    families = sorted({family for family, _ in TEMPLATES}) + [UNKNOWN]
    code = F.array_position(F.array(*map(F.lit, families)), F.col("family")).cast("double") - 1
    size = rows.filter("not held").groupBy("family").agg(F.count("*").alias("n"))
    weighed = rows.join(F.broadcast(size), "family").withColumn("weight", F.lit(100.0) / F.col("n"))
    counter = CountVectorizer(inputCol="grams", outputCol="features", minDF=2)
    counted = counter.fit(rows.filter("not held and size(grams) > 0"))
    ready = counted.transform(weighed.withColumn("label", code))
    ready = cut(ready.select("label", "features", "weight", "held", "grams"), "licence-ready")
    trained = LogisticRegression(family="multinomial", weightCol="weight", **MODEL).fit(ready.filter("not held"))
    matrix = trained.coefficientMatrix.toArray()
    model = {
        "anchors": anchors,
        "families": families,
        "intercepts": [float(x) for x in trained.interceptVector],
        "weights": {
            gram: [float(x) for x in matrix[:, column]]
            for column, gram in enumerate(counted.vocabulary)
            if matrix[:, column].any()
        },
        "curve": [1.0, 0.0],
    }
    # Known against unknown, on what was held back: a curve over the margin of the best family.
    numbered = cut(ready.filter("held").withColumn("row", F.monotonically_increasing_id()), "licence-held")
    scored = classified(numbered.select("row", "grams"), model, ["row"])
    truth = numbered.select("row", (F.col("label") < len(families) - 1).cast("double").alias("label"))
    curve_rows = scored.join(truth, "row").select("label", array_to_vector(F.array("margin")).alias("features"))
    curve = LogisticRegression(regParam=0.001, standardization=False).fit(cut(curve_rows.coalesce(1), "licence-curve"))
    model["curve"] = [float(curve.coefficients[0]), float(curve.intercept)]
    return model


def classified(rows: DataFrame, model: dict, keys: list[str]) -> DataFrame:
    """``keys, family, margin, score`` of rows with ``grams``: the best family, and known against unknown."""
    spark = rows.sparkSession
    count = len(model["families"])
    listed = [{"gram": gram, "w": own} for gram, own in model["weights"].items()]
    weights = inline_rows(spark, listed, "gram: string, w: array<double>")
    grams = rows.select(*keys, F.explode_outer("grams").alias("gram"))
    met = grams.join(F.broadcast(weights), "gram", "left")
    sums = [F.sum(F.coalesce(F.col("w")[n], F.lit(0.0))).alias(f"s{n}") for n in range(count)]
    total = met.groupBy(*keys).agg(*sums)
    logits = [F.col(f"s{n}") + F.lit(model["intercepts"][n]) for n in range(count)]
    # structs compare by logit, then by name
    best = F.greatest(*[F.struct(logits[n].alias("logit"), F.lit(model["families"][n]).alias("family")) for n in range(count - 1)])
    slope, shift = model["curve"]
    margin = F.col("best.logit") - logits[-1]
    return total.withColumn("best", best).select(
        *keys,
        F.col("best.family").alias("family"),
        margin.alias("margin"),
        (1 / (1 + F.exp(-(margin * slope + shift)))).alias("score"),
    )


def runs(near: Column, place: Column) -> Column:
    """``ahead, back, tokens`` of runs of two lines or more around a line: on to ``ahead`` lines, ``back`` lines before it.

    ``near`` has the line before, unless the line's ``place`` is 0, the line and those that follow. Runs end before
    a line without words, and once the lines after the first hold as many words as the longest template.
    """
    own = F.when(place > 0, 2).otherwise(1)
    longest = max(len(re.findall(r"[^\W_]+", text)) for _, text in TEMPLATES)
    here = words(F.get(near, own - 1))
    start = F.struct(F.array(here).alias("all"), F.lit(0).alias("words"), F.lit(True).alias("open"))

    def grown(state: Column, line: Column) -> Column:
        tokens = words(line)
        longer = F.struct(
            F.concat(state["all"], F.array(F.concat(F.element_at(state["all"], -1), tokens))).alias("all"),
            (state["words"] + F.size(tokens)).alias("words"),
            ((F.size(tokens) > 0) & (state["words"] + F.size(tokens) < longest)).alias("open"),
        )
        shut = F.struct(state["all"].alias("all"), state["words"].alias("words"), F.lit(False).alias("open"))
        return F.when(state["open"] & (F.size(tokens) > 0), longer).otherwise(shut)

    ahead = F.aggregate(F.slice(near, own + 1, longest), start, grown, lambda state: state["all"])
    before = F.when(place > 0, words(F.get(near, F.lit(0)))).otherwise(F.array().cast("array<string>"))

    def numbered(prefix: Column, back: int) -> Column:
        return F.transform(
            ahead, lambda tokens, n: F.struct(n.alias("ahead"), F.lit(back).alias("back"), F.concat(prefix, tokens).alias("tokens"))
        )

    both = F.concat(
        numbered(F.array().cast("array<string>"), 0),
        F.when(F.size(before) > 0, numbered(before, 1)).otherwise(F.filter(numbered(before, 1), lambda x: F.lit(False))),
    )
    return F.filter(both, lambda run: run["ahead"] + run["back"] > 0)


def may_hold(tokens: Column) -> Column:
    """Whether any template is contained in the tokens by ``CONTAINED``."""
    known = [re.findall(r"[^\W_]+", text.lower()) for _, text in TEMPLATES]
    pairs = [sorted({" ".join(pair) for pair in zip(own, own[1:], strict=False)}) for own in known]
    every = F.array(*[F.lit(pair) for pair in sorted(set().union(*pairs))])
    sized = F.array(*[
        F.struct(F.array(*map(F.lit, own)).alias("own"), F.lit(CONTAINED * len(own) - 1e-9).alias("least")) for own in pairs
    ])
    met = F.array_intersect(bigrams(tokens), every)
    fits = lambda known: F.size(F.array_intersect(met, known["own"])) >= known["least"]
    return F.when(F.size(met) >= 2, F.exists(sized, fits)).otherwise(False)


def wrapped(rows: DataFrame) -> DataFrame:
    """``row, paragraph, lines, tokens`` of runs of lines that may hold a template; ``rows`` has ``near`` for each line."""
    made = rows.select("row", "paragraph", runs(F.col("near"), F.col("paragraph")).alias("runs"))
    # The last run is the longest of those that begin with the line before, or else with the line.
    some = made.filter(F.size("runs") > 0).filter(may_hold(F.element_at("runs", -1)["tokens"]))
    each = some.select("row", "paragraph", F.explode("runs").alias("run"))
    return each.select(
        "row",
        (F.col("paragraph") - F.col("run.back")).alias("paragraph"),
        (F.col("run.ahead") + F.col("run.back") + 1).alias("lines"),
        "run.tokens",
    ).dropDuplicates(["row", "paragraph", "lines"])


def best_runs(confirmed: DataFrame) -> DataFrame:
    """Of confirmed paragraphs, those that are the best on each of their lines.

    Runs around a shorter one that holds as much of a template add nothing, and do not stand against others.
    """
    last = F.col("paragraph") + F.col("lines") - 1
    wide = confirmed.filter("lines > 1").withColumn("from", F.explode(F.sequence("paragraph", last))).alias("wide")
    inner = confirmed.select("row", F.col("paragraph").alias("from"), last.alias("to"), "lines", "contained").alias("inner")
    within = (F.col("inner.to") <= F.col("wide.paragraph") + F.col("wide.lines") - 1) & (
        F.col("inner.lines") < F.col("wide.lines")
    )
    same = (F.col("wide.row") == F.col("inner.row")) & (F.col("wide.from") == F.col("inner.from"))
    around = wide.join(inner, same & within & (F.col("inner.contained") >= F.col("wide.contained")), "left_semi")
    around = around.select("row", "paragraph", "lines").distinct()
    confirmed = confirmed.join(around, ["row", "paragraph", "lines"], "left_anti")
    order = F.struct("contained", (-F.col("lines")).alias("short"), "score", (-F.col("paragraph")).alias("back"), "family")
    ranked = confirmed.withColumn("order", order)
    spread = ranked.withColumn("line", F.explode(F.sequence("paragraph", last)))
    tops = spread.groupBy("row", "line").agg(F.max("order").alias("top"))
    met = spread.join(tops, ["row", "line"]).groupBy("row", "paragraph", "lines", "family", "score", "contained")
    return met.agg(F.min(F.col("top") == F.col("order")).alias("kept")).filter("kept").drop("kept")


def scan(docs: DataFrame, model: dict) -> DataFrame:
    """A row for each document: the licence it holds, where, and how sure.

    ``doc_id, family, score, contained, paragraph, n_licences``; family is ``unknown`` and the next three
    null where no paragraph is confirmed.
    """
    spark = docs.sparkSession
    pattern = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(model["anchors"]) + r")(?![\p{L}\p{N}])"
    numbered = F.transform("all", lambda line, place: F.struct(place.alias("paragraph"), line.alias("line")))
    # A run has no more lines than the longest template has words.
    most = 2 + max(len(text.split()) for _, text in TEMPLATES) * 2
    around = lambda own: F.slice(F.col("all"), F.greatest(own["paragraph"], F.lit(1)), F.lit(most))
    anchored = F.transform(
        F.filter(numbered, lambda own: own["line"].rlike(pattern)),
        lambda own: F.struct(own["paragraph"].alias("paragraph"), own["line"].alias("line"), around(own).alias("near")),
    )
    split = F.when(F.col("text").rlike(pattern), lines(F.col("text")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", split.alias("all"))
    rows = rows.select("row", "doc_id", anchored.alias("lines"))
    rows = rows.select("row", "doc_id", F.explode_outer("lines").alias("own")).select(
        "row", "doc_id", "own.paragraph", "own.line", "own.near"
    )
    rows = cut(rows, "licence-paragraphs")
    found = rows.filter("line is not null")
    single = found.select("row", "paragraph", F.lit(1).alias("lines"), words(F.col("line")).alias("tokens"))
    several = cut(wrapped(found), "licence-runs")
    grams = single.unionByName(several).withColumn("grams", features(F.col("tokens"), model["anchors"]))
    named = classified(grams, model, ["row", "paragraph", "lines", "tokens"])
    known = templates(spark).select("family", bigrams(words(F.col("text"))).alias("own"))
    compared = (
        named.filter("score >= 0.5")
        .withColumn("pairs", bigrams(F.col("tokens")))
        .join(F.broadcast(known), "family")
        .groupBy("row", "paragraph", "lines", "family", "score")
        .agg(F.max(F.size(F.array_intersect("pairs", "own")) / F.size("own")).alias("contained"))
        .filter(F.col("contained") >= CONTAINED)
    )
    best = best_runs(cut(compared, "licence-confirmed")).groupBy("row").agg(
        F.max(F.struct("score", (-F.col("paragraph")).alias("back"), "family", "contained")).alias("best"),
        F.count("*").alias("n"),
    )
    each = rows.groupBy("row").agg(F.min("doc_id").alias("doc_id"))
    return each.join(best, "row", "left").select(
        "doc_id",
        F.coalesce("best.family", F.lit(UNKNOWN)).alias("family"),
        F.col("best.score").alias("score"),
        F.col("best.contained").alias("contained"),
        (-F.col("best.back")).cast("long").alias("paragraph"),
        F.coalesce("n", F.lit(0)).alias("n_licences"),
    )


def op4_licenses(spark, sf_dir: str) -> DataFrame:
    """Per document: the licence family that it holds, if any, with its calibrated score and its paragraph."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, fit(docs))
