"""Licence scans: a sparse word n-gram classifier finds paragraphs that state a licence, templates confirm them.

A paragraph is a line with a word. Its features are its distinct words and word pairs. A multinomial logistic
regression with L1 (Spark ML) is trained on variants of the templates of each licence family and on half of all
paragraphs of the corpus as the class of unknown text. Its threshold is calibrated on the other half, so that one in a
thousand of unknown ones passes at most. Only features of the templates can have a weight, so both halves are counted by
the features they share with them and enter as weighted rows. A paragraph that passes must also share enough word pairs with a
template of its family: ``PAIRS`` at least, or all of a title that has fewer. The scan itself is DataFrame functions
only. Only paragraphs that share so many pairs with the templates can be confirmed, so only they are scored; their
features meet the weights in a broadcast join, and little is shuffled.

A line of one word ("GPLv3") has no pair and states no licence; nor does a family without templates.

Rules for odd input: a null or empty text has no paragraph and no licence; of several licences in a document the first
is named and all are counted; repeated rows are scanned row by row; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.operators.running import running_totals
from lapwise.operators.staging import stage

UNKNOWN = "unknown"
NONE = "none"
# All paragraphs that stand for unknown text weigh as much as so many variants of the templates, or one each if fewer.
UNKNOWN_WEIGHT = 4_000
# Share of unknown paragraphs that may pass the classifier.
PASSING = 0.001
# Least share of word pairs in common with a template, of the template's or the paragraph's pairs, and least number
# (for templates that have as many).
SIMILAR, PAIRS = 0.6, 3
# Rows that a title, which has no variants, is trained on.
TITLE_ROWS = 12

# Public wordings of licence notices, by family.
TEMPLATES = {
    "agpl": [
        "GNU Affero General Public License", "AGPL License", "License: AGPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "apache": [
        "Apache License", "License: Apache", "Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution.",
        "BSD License", "License: BSD", "BSD 3-Clause License", "BSD 2-Clause License",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "boost": [
        "Boost Software License", "License: BSL", "Boost Software License - Version 1.0",
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "cc0": [
        "CC0 1.0 Universal", "License: CC0", "CC0 License",
        "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
        "this work to the public domain worldwide.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "creative-commons": [
        "Licensed under CC BY 4.0.",
        "Licensed under CC BY-SA 4.0.",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "epl": [
        "Eclipse Public License", "License: EPL", "Eclipse Public License - v 2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "gpl": [
        "GPL License", "License: GPL", "GNU General Public License", "GNU GPL",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "isc": [
        "ISC License", "License: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "lgpl": [
        "LGPL License", "License: LGPL", "GNU Lesser General Public License", "GNU LGPL",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
    ],
    "mit": [
        "MIT License", "License: MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to "
        "the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "Mozilla Public License", "License: MPL", "Mozilla Public License Version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "unlicense": [
        "The Unlicense", "Unlicense License", "License: Unlicense",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "zlib": [
        "zlib License", "License: zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
        "SPDX-License-Identifier: Zlib",
    ],
}


def words(paragraph: Column) -> Column:
    """Lower-case words of a paragraph."""
    return F.filter(F.split(F.lower(paragraph), r"[^a-z0-9\x{80}-\x{10FFFF}]+"), lambda w: w != "")


def pairs(found: Column) -> Column:
    """Distinct word pairs."""
    n = F.greatest(F.size(found) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(found, 1, n), F.slice(found, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))


def paragraphs(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (row, key, paragraph, words) for every line with a word, and the first line of every text.

    ``row`` numbers the rows of ``df``.
    """
    return (
        df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
        # Words are made inside the generator, so no later use of them splits the line again.
        .select("row", "key", F.inline(F.transform(
            F.split(F.coalesce("text", F.lit("")), "\n"),
            lambda line, i: F.struct(i.alias("paragraph"), words(line).alias("words")),
        )))
        .filter((F.col("paragraph") == 0) | (F.size("words") > 0))
    )


def _literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [{"family": family, "line": line} for family, lines in TEMPLATES.items() for line in lines]
    return _literal(spark, rows, "family:string,line:string").select("family", words(F.col("line")).alias("words"))


def _known_pairs(spark: SparkSession) -> tuple[list[str], list[str]]:
    """The word pairs of all templates, and those of the titles."""
    found = _templates(spark).select(pairs(F.col("words")).alias("pairs")).collect()
    titles = {pair for row in found for pair in row["pairs"] if len(row["pairs"]) < PAIRS}
    return sorted({pair for row in found for pair in row["pairs"]}), sorted(titles)


def _variants(templates: DataFrame) -> DataFrame:
    """Templates whole, with any one word left out, and cut short to two thirds; titles whole only."""
    size = F.size("words")
    dropped = F.transform(
        F.sequence(F.lit(-1), size - 1), lambda gap: F.filter("words", lambda w, i: i != gap)
    )
    short = F.slice("words", 1, F.ceil(size * 2 / 3).cast("int"))
    title = F.size(pairs(F.col("words"))) < PAIRS
    cut = F.filter(F.concat(dropped, F.array(short)), lambda found: F.size(found) > 2)
    return templates.select(
        "family", F.explode(F.when(title, F.array_repeat("words", TITLE_ROWS)).otherwise(cut)).alias("words")
    )


def _features(found: DataFrame) -> DataFrame:
    """Distinct words and word pairs; the empty feature, without weight, keeps paragraphs that have no other."""
    return found.withColumn("features", F.concat(F.array_distinct("words"), pairs(F.col("words")), F.array(F.lit(""))))


class Classifier:
    """Weights by feature and family, intercepts, and the least probability of a licence."""

    def __init__(self, families: list[str], weights: list[dict], intercepts: list[float], least: float) -> None:
        self.families, self.weights, self.intercepts, self.least = families, weights, intercepts, least

    def probable(self, found: DataFrame, keys: list[str]) -> DataFrame:
        """Rows (keys, family, probability) of the likeliest family, for paragraphs with a weighted feature."""
        return self.likeliest(_features(found), keys)

    def likeliest(self, featured: DataFrame, keys: list[str]) -> DataFrame:
        """The same for rows with a column ``features``. Probabilities are rounded, so the order of sums moves none."""
        fields = ",".join(f"w{i}:double" for i in range(len(self.families)))
        weights = _literal(featured.sparkSession, self.weights, f"feature:string,{fields}")
        summed = (
            featured.select(*keys, F.explode("features").alias("feature"))
            .join(F.broadcast(weights), "feature")  # at most the words and pairs of the templates
            .groupBy(*keys).agg(*[F.sum(f"w{i}").alias(f"w{i}") for i in range(len(self.families))])
        )
        sums = [F.exp(F.col(f"w{i}") + b) for i, b in enumerate(self.intercepts)]
        whole = sum(sums[1:], sums[0])
        best = F.array_max(F.array(*[
            F.struct(F.round(s / whole, 9).alias("probability"), F.lit(family).alias("family"))
            for s, family in zip(sums, self.families) if family != UNKNOWN
        ]))
        return summed.select(*keys, best.alias("best")).select(*keys, "best.family", "best.probability")


def _unknown(df: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """Rows (calibrates, features, n): all paragraphs that quote no template, counted by their features of ``vocabulary``."""
    known, titles = _known_pairs(df.sparkSession)
    singles, doubles = [f for f in vocabulary if f and " " not in f], [f for f in vocabulary if " " in f]
    like = F.size(F.filter("pairs", lambda p: p.isin(known)))
    # Pairs are made inside a generator, so no later use of them makes them again.
    found = paragraphs(df, key, text).filter(F.size("words") > 0).select(
        "row", "key", "paragraph", "words", F.explode(F.array(pairs(F.col("words")))).alias("pairs")
    )
    shared = F.concat(
        F.array(F.lit("")), F.array_sort(F.array_distinct(F.filter("words", lambda w: w.isin(singles)))),
        F.array_sort(F.filter("pairs", lambda p: p.isin(doubles))),
    )
    return (
        found.filter(2 * like < F.greatest(F.size("pairs"), F.lit(1)))
        .filter(~F.exists("pairs", lambda p: p.isin(titles)))
        .groupBy((F.pmod(F.xxhash64("key", "row", "paragraph"), F.lit(2)) == 1).alias("calibrates"), shared.alias("features"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def least_probability(scored: DataFrame, passing: int) -> float | None:
    """The probability that more than ``passing`` rows reach, of those above 0.5, where a row counts ``n`` times."""
    values = scored.filter("probability > 0.5").groupBy("probability").agg(F.sum("n").alias("n"))
    reached = running_totals(
        values, [], [F.desc("probability")], {"reached": F.col("n")}, [F.floor(-F.col("probability") * 1000)]
    )
    return reached.filter(F.col("reached") > passing).agg(F.max("probability")).first()[0]


def train(df: DataFrame, key: str = "doc_id", text: str = "text") -> Classifier:
    """Train on the templates and half of all paragraphs, and calibrate on the other half."""
    variants = stage(_features(_variants(_templates(df.sparkSession))))
    vectors = CountVectorizer(inputCol="features", outputCol="vector", binary=True, minDF=2.0).fit(variants)
    unknown = stage(_unknown(df, key, text, vectors.vocabulary))
    totals = unknown.agg(
        F.sum(F.when(~F.col("calibrates"), F.col("n"))), F.sum(F.when(F.col("calibrates"), F.col("n")))
    ).first()
    share = min(1.0, UNKNOWN_WEIGHT / (totals[0] or 1))
    rows = variants.select("family", "features", F.lit(1.0).alias("weight")).union(
        unknown.filter("not calibrates").select(F.lit(UNKNOWN).alias("family"), "features", F.col("n") * share)
    )
    families = sorted([*TEMPLATES, UNKNOWN])
    labels = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    fitted = LogisticRegression(
        featuresCol="vector", weightCol="weight", family="multinomial", elasticNetParam=1.0, regParam=1e-3, maxIter=60,
        standardization=False,
    ).fit(vectors.transform(rows).select("vector", "weight", labels.cast("double").alias("label")))
    matrix = fitted.coefficientMatrix.toArray()
    # Without unknown rows the class does not occur; it then never wins.
    present = matrix.shape[0]
    weights = [
        {"feature": name} | {f"w{i}": float(matrix[i, j]) for i in range(present)}
        for j, name in enumerate(vectors.vocabulary) if matrix[:, j].any() and name
    ]
    weights.append({"feature": ""} | {f"w{i}": 0.0 for i in range(present)})
    model = Classifier(families[:present], weights, fitted.interceptVector.toArray().tolist(), 0.5)
    scored = model.likeliest(
        unknown.filter("calibrates").select("features", "n", F.monotonically_increasing_id().alias("vector")), ["vector", "n"]
    )
    model.least = least_probability(scored, int((totals[1] or 0) * PASSING)) or 0.5
    return model


def found_in(df: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Paragraphs that may state a licence, and the first of every text, with the verdict ``confirmed``.

    Columns: row, key, paragraph (from 0), words, family, probability, similarity, confirmed.
    """
    known, titles = _known_pairs(df.sparkSession)
    shared = F.filter(pairs(F.col("words")), lambda p: p.isin(known))
    titled = F.exists(shared, lambda p: p.isin(titles))
    near = paragraphs(df, key, text).filter((F.col("paragraph") == 0) | (F.size(shared) >= PAIRS) | titled)
    likely = model.probable(near, ["row", "key", "paragraph", "words"])
    patterns = [
        F.struct(F.lit(family).alias("family"), F.array(*map(F.lit, row["pattern"])).alias("pattern"))
        for family, row in [
            (r["family"], r) for r in _templates(df.sparkSession).select(
                "family", pairs(F.col("words")).alias("pattern")
            ).collect()
        ]
    ]
    own = pairs(F.col("words"))

    def similarity(template: Column) -> Column:
        both = F.size(F.array_intersect(own, template["pattern"]))
        share = F.greatest(both / F.size(template["pattern"]), both / F.greatest(F.size(own), F.lit(1)))
        enough = both >= F.least(F.lit(PAIRS), F.size(template["pattern"]))
        return F.when((template["family"] == F.col("family")) & enough, share).otherwise(0.0)

    found = likely.withColumn("similarity", F.array_max(F.transform(F.array(*patterns), similarity)))
    sure = (F.col("probability") >= model.least) & (F.col("similarity") >= SIMILAR)
    return found.withColumn("confirmed", sure)


def scan(df: DataFrame, model: Classifier, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, first confirmed licence or none, its paragraph, probability, similarity, count."""
    one = F.struct("paragraph", "family", "probability", "similarity")
    found = found_in(df, model, key, text).groupBy("row", "key").agg(
        F.min(F.when(F.col("confirmed"), one)).alias("first"), F.count_if("confirmed").alias("n_licenses")
    )
    return found.select(
        F.col("key").alias(key),
        F.coalesce("first.family", F.lit(NONE)).alias("license"),
        F.col("first.paragraph").alias("paragraph"),
        F.round("first.probability", 6).alias("probability"),
        F.round("first.similarity", 6).alias("similarity"),
        "n_licenses",
    )
