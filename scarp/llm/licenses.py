"""Licence scan: a trained paragraph classifier with an unknown class, confirmed by templates. DataFrame functions only.

A paragraph is a line of a text. Its features are the distinct one- and two-word sequences it holds (sparse, presence
only), and a multinomial logistic regression with an elastic-net penalty gives it a licence family, ``none`` or
``unknown``. Training rows are made from public notices (``NOTICES``): whole, in parts, and before or after paragraphs of a bounded sample of the
corpus, so a notice inside a long paragraph counts like one on its own; the sampled paragraphs themselves are ``none``,
notices of licences outside the families are ``unknown``. A part of the rows is kept apart: on it a temperature is fitted
for the probabilities, and the smallest threshold that reaches ``PRECISION``. What stays below it is ``unknown``.

A predicted family is confirmed when a template of it is found in the paragraph: at least the share ``CONFIRM`` of the
template's three-word sequences (of its words, if it has fewer than three). Predictions that no template confirms count
as unknown. Every paragraph of every text is classified whole; a text meets the model inside its own task, without a
shuffle, and the counts per text are combined before they are shuffled.

A notice may be wrapped: a line is judged a second time together with the ``WINDOW`` words that follow it up to the next
blank line. It is licensed when a template is found there that the line alone does not confirm and that the following
words do not hold as well without it. Lines after it, as far as these words reach, that are guessed the same family and
not confirmed belong to the notice and are not counted as unknown. Only windows that hold a template meet the model.

Defined results: null and empty texts have no paragraph; every row gives one row, repeated and null ids too; other columns
are ignored; an empty corpus still gives a model (from the notices alone).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_text, scratch_table

SAMPLE_DOCS = 300      # texts whose paragraphs stand for "none"
SAMPLE_CHARS = 20_000  # longer texts are not sampled
PARAGRAPHS = 1500      # of them at most
EMBEDDED = 6           # corpus paragraphs that each notice is put beside
VOCABULARY = 8192
PRECISION = 0.98
CONFIRM = 0.6
WINDOW = 64            # following words: over twice the longest notice
TEMPERATURES = (0.5, 0.75, 1.0, 1.5, 2.0, 3.0)
THRESHOLDS = (0.35, 0.45, 0.55, 0.65, 0.75, 0.85, 0.95)

# fixed values: public licence notices by family, in their usual short wordings
NOTICES = {
    "Apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "SPDX-License-Identifier: Apache-2.0", "Distributed under the terms of the Apache License 2.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Licensed under the BSD 3-Clause License.", "Released under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
            "This software is distributed under the terms of the BSD license."],
    "CC": ["Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 3.0.", "Licensed under CC BY-ND 4.0.",
           "This work is licensed under a Creative Commons Attribution 4.0 International License.",
           "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
           "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "Licensed under the GNU Lesser General Public License, version 2.1.", "Licensed under the GNU Affero General Public License, version 3.",
            "SPDX-License-Identifier: GPL-3.0-or-later"],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT", "Distributed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.",
            "SPDX-License-Identifier: MPL-2.0"],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved.", "All rights reserved. No part of this publication may be reproduced without permission.",
                    "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential."],
    "public domain": ["This work has been dedicated to the public domain.", "This is free and unencumbered software released into the public domain.",
                      "Released into the public domain under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "unknown": ["Licensed under the Eclipse Public License, version 2.0.", "Licensed under the Artistic License 2.0.", "Distributed under the zlib license.",
                "Distributed under the Boost Software License, Version 1.0.", "Licensed under the EUPL, version 1.2.", "Released under the ISC license.",
                "Use is subject to the terms of the licence agreement.", "Licensed under the Open Data Commons Open Database License.",
                "Licensed under the terms of a separate written agreement.", "Released under the SIL Open Font License, version 1.1."],
}
CLASSES = ("none", *NOTICES)
SUSPECT = r"(?i)licen[cs]|copyright|rights reserved|public domain|redistribut|permission|spdx|prohibited"


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def sequences(words: Column, n: int) -> Column:
    """Runs of ``n`` words of an array (none when there are fewer)."""
    at = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.transform(at, lambda i: F.concat_ws(" ", *[words[i + k] for k in range(n)]))
                  ).otherwise(F.array().cast("array<string>"))


def with_terms(paragraphs: DataFrame) -> DataFrame:
    """Add ``words`` and ``terms`` (one- and two-word sequences) of the column ``paragraph``."""
    cut = paragraphs.withColumn("words", word_array(F.col("paragraph")))
    return cut.withColumn("terms", F.concat("words", sequences(F.col("words"), 2)))


def paragraphs_of(docs: DataFrame, *keep: str) -> DataFrame:
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "[\r\n]+"), lambda x: F.trim(x) != "")
    return docs.select(*keep, F.explode_outer(lines).alias("paragraph"))


def notices(spark: SparkSession) -> DataFrame:
    rows = [(CLASSES.index(c), k, t) for c, texts in NOTICES.items() for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "label int, number int, paragraph string")


def sample_of(docs: DataFrame) -> DataFrame:
    """At most ``PARAGRAPHS`` paragraphs, numbered, of ``SAMPLE_DOCS`` texts in the order of a hash of the id."""
    short = docs.where(F.length("text").between(1, SAMPLE_CHARS)).withColumn("key", F.xxhash64("doc_id", "text"))
    picked = scratch_table(short.select("key").distinct().orderBy("key").limit(SAMPLE_DOCS), "picked")  # keys first: texts stay put
    texts = short.join(picked, "key")
    lines = paragraphs_of(texts).where(F.col("paragraph").isNotNull() & ~F.col("paragraph").rlike(SUSPECT)).distinct()
    lines = lines.orderBy(F.xxhash64("paragraph"), "paragraph").limit(PARAGRAPHS)
    return lines.withColumn("at", F.row_number().over(Window.orderBy(F.xxhash64("paragraph"), "paragraph")) - 1)  # bounded


def training_rows(docs: DataFrame) -> DataFrame:
    """``label, paragraph, apart``: notices in several shapes, and paragraphs of the corpus."""
    spark = docs.sparkSession
    own = scratch_table(sample_of(docs), "sample")
    n = max(1, own.count())
    base = notices(spark)
    ws = F.split("paragraph", " ")
    half = F.greatest(F.lit(4), F.ceil(F.size(ws) * 0.7)).cast("int")
    shapes = F.array(F.col("paragraph"), F.lower("paragraph"), F.upper("paragraph"),
                     F.array_join(F.slice(ws, F.lit(1), half), " "),
                     F.array_join(F.slice(ws, F.greatest(F.lit(1), F.size(ws) - half + 1), half), " "))
    alone = base.select("label", F.explode(shapes).alias("paragraph"))
    beside = base.select("label", F.col("paragraph").alias("notice"),
                         F.explode(F.sequence(F.lit(1), F.lit(EMBEDDED))).alias("k"), "number")
    beside = (beside.withColumn("at", F.pmod(F.xxhash64("label", "number", "k"), F.lit(n)).cast("int")).join(own, "at")
              .select("label", F.when(F.col("k") % 2 == 0, F.concat_ws(" ", "notice", "paragraph"))
                      .otherwise(F.concat_ws(" ", "paragraph", "notice")).alias("paragraph")))
    rows = alone.unionByName(beside).unionByName(own.select(F.lit(0).alias("label"), "paragraph"))
    return rows.withColumn("apart", F.pmod(F.xxhash64("paragraph", "label"), F.lit(4)) == 0)


@dataclass
class Scanner:
    vocabulary: CountVectorizerModel
    model: LogisticRegressionModel
    temperature: float
    threshold: float
    keys: list[str] | None = None

    def probabilities(self, terms: DataFrame) -> DataFrame:
        """Add ``p``: calibrated probabilities of ``CLASSES``."""
        raw = self.model.transform(self.vocabulary.transform(terms)).withColumn("raw", vector_to_array("rawPrediction"))
        return softened(raw, self.temperature).drop("features", "rawPrediction", "probability", "prediction", "raw")


def softened(raw: DataFrame, temperature: float, name: str = "p") -> DataFrame:
    top = raw.withColumn("top", F.array_max("raw"))
    power = top.withColumn("power", F.transform("raw", lambda x: F.exp((x - F.col("top")) / temperature)))
    total = F.aggregate("power", F.lit(0.0), lambda a, x: a + x)
    return power.withColumn("total", total).withColumn(name, F.transform("power", lambda x: x / F.col("total"))).drop("top", "power", "total")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Scanner:
    rows = scratch_table(with_terms(training_rows(id_text(docs, id_col, text_col))), "training")
    learn = rows.where(~F.col("apart"))
    vocabulary = CountVectorizer(inputCol="terms", outputCol="features", vocabSize=VOCABULARY, binary=True).fit(learn)
    sizes = {r["label"]: r["n"] for r in learn.groupBy("label").agg(F.count("*").alias("n")).collect()}  # one number per class
    weighted = learn.withColumn("weight", F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, n ** -0.5)]), F.col("label")))
    model = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=0.5, maxIter=60, weightCol="weight",
                               standardization=False).fit(scratch_table(vocabulary.transform(weighted).select("label", "weight", "features"), "features"))
    apart = scratch_table(Scanner(vocabulary, model, 1.0, 0.0).model.transform(vocabulary.transform(rows.where("apart")))
                          .select("label", vector_to_array("rawPrediction").alias("raw")), "apart")
    losses = [softened(apart, t).agg(F.avg(-F.log(F.greatest(F.element_at("p", F.col("label") + 1), F.lit(1e-12)))).alias("loss"))
              .select(F.lit(t).alias("t"), "loss") for t in TEMPERATURES]
    table = losses[0]
    for x in losses[1:]:
        table = table.unionByName(x)
    temperature = table.orderBy(F.col("loss").asc_nulls_last(), "t").first()["t"]
    judged = (softened(apart, temperature).withColumn("best", F.array_max("p"))
              .withColumn("guess", F.array_position("p", F.col("best")) - 1).where(F.col("guess") > 0))
    right = judged.agg(*[F.avg(F.when(F.col("best") >= t, (F.col("guess") == F.col("label")).cast("double"))).alias(f"t{k}")
                         for k, t in enumerate(THRESHOLDS)]).first()
    good = [t for k, t in enumerate(THRESHOLDS) if right[f"t{k}"] is not None and right[f"t{k}"] >= PRECISION]
    corpus = rows.where(F.col("label") == 0)
    return Scanner(vocabulary, model, temperature, good[0] if good else THRESHOLDS[-1], keys_for(corpus))


def templates(spark: SparkSession) -> dict[int, list[set[str]]]:
    """Word sequences of the notices by class (three words, or single words of short notices)."""
    out: dict[int, list[set[str]]] = {}
    cut = notices(spark).where(F.col("label") != CLASSES.index("unknown")).withColumn("words", word_array(F.col("paragraph")))
    for r in cut.select("label", F.when(F.size("words") >= 3, sequences(F.col("words"), 3)).otherwise(F.col("words")).alias("s")).collect():
        out.setdefault(r.label, []).append(set(r.s))
    return out


def confirmed(guess: Column, words: Column, spark: SparkSession) -> Column:
    """Whether a template of the guessed class lies in the paragraph."""
    both = F.concat(words, sequences(words, 3))
    hit = F.lit(False)
    for label, sets in templates(spark).items():
        found = F.lit(False)
        for s in sets:
            found = found | (F.size(F.array_intersect(F.array(*[F.lit(x) for x in sorted(s)]), both)) >= CONFIRM * len(s))
        hit = F.when(guess == label, found).otherwise(hit)
    return hit


def key_words(sets: list[set[str]], often: dict[str, int] | None = None) -> list[str]:
    """Words so chosen that no template can be confirmed in a text without any of them.

    Words that are rare in the corpus' own paragraphs (``often``: paragraphs that hold a word) are taken first, so that few
    texts hold one by chance.
    """
    often = often or {}
    keys: list[str] = []
    while True:
        free = [[q for q in s if not set(q.split()) & set(keys)] for s in sets]
        left = [f for f, s in zip(free, sets) if len(f) >= CONFIRM * len(s)]
        if not left:
            return keys
        weight: dict[str, float] = {}
        for f in left:
            for q in f:
                for w in set(q.split()):
                    weight[w] = weight.get(w, 0) + (1 if len(w) > 5 else 0.01) / len(f) / (1 + often.get(w, 0))
        keys.append(max(sorted(weight), key=weight.get))


def keys_for(paragraphs: DataFrame) -> list[str]:
    """Key words of the templates, by how many of the sampled paragraphs hold them (one number per template word)."""
    sets = [s for several in templates(paragraphs.sparkSession).values() for s in several]
    words = sorted({w for s in sets for q in s for w in q.split()})
    held = paragraphs.select(F.explode(F.array_distinct(word_array(F.col("paragraph")))).alias("w")).where(F.col("w").isin(words))
    return key_words(sets, {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()})


def windows_of(text: Column, keys: list[str]) -> Column:
    """``at, reach, own, rest`` of the lines whose windows hold a key word: last words of the line, words after it, and
    the number of the last line they reach."""
    found = r"(?<![\p{L}\p{N}])(?:" + "|".join(keys) + r")(?![\p{L}\p{N}])"
    blank = F.lit("\n")

    def line(x: Column) -> Column:
        return F.transform(F.array(word_array(x)), lambda w: F.struct(
            F.when(F.trim(x) == "", blank).otherwise(F.array_join(F.slice(w, 1, WINDOW), " ")).alias("head"),
            F.array_join(F.slice(w, F.greatest(F.lit(1), F.size(w) - WINDOW + 1), WINDOW), " ").alias("tail"),
            F.size(w).alias("n")))[0]

    def reach(lines: Column, at: Column) -> Column:
        start = F.struct(at.alias("last"), F.lit(0).alias("n"), F.lit(True).alias("on"))
        return F.aggregate(F.slice(lines, at + 2, WINDOW), start, lambda a, x: F.struct(
            (a["last"] + F.when(a["on"] & (x["head"] != blank) & (a["n"] < WINDOW), 1).otherwise(0)).alias("last"),
            (a["n"] + x["n"]).alias("n"), (a["on"] & (x["head"] != blank)).alias("on")))["last"]

    def windows(lines: Column) -> Column:
        def window(at: Column) -> Column:
            after = F.concat_ws(" ", F.transform(F.slice(lines, at + 2, WINDOW), lambda x: x["head"]))
            rest = F.substring_index(F.substring_index(after, "\n", 1), " ", WINDOW)
            return F.struct(at.alias("at"), lines[at]["tail"].alias("own"), rest.alias("rest"))
        cut = F.transform(F.sequence(F.lit(0), F.size(lines) - 1), window)
        kept = F.filter(cut, lambda w: (w["own"] != "") & (w["rest"] != "") & F.concat_ws(" ", w["own"], w["rest"]).rlike(found))
        return F.transform(kept, lambda w: F.struct(w["at"].alias("at"), reach(lines, w["at"]).alias("reach"),
                                                    w["own"].alias("own"), w["rest"].alias("rest")))

    # lines are bound once, by the outer lambda
    every = F.transform(F.array(F.transform(F.split(text, "\r\n|\r|\n"), line)), windows)[0]
    return F.when(F.lower(text).rlike(found), every)


def units_of(docs: DataFrame, *keep: str, keys: list[str] | None = None) -> DataFrame:
    """Every paragraph (``own`` is null) and the windows that hold a template, with the classes found in ``joined``."""
    sets = templates(docs.sparkSession)
    kind = "array<struct<at:int,reach:int,own:string,rest:string,paragraph:string>>"
    lines = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), "\r\n|\r|\n"), lambda x, k: F.struct(
        k.alias("at"), k.alias("reach"), F.lit(None).cast("string").alias("own"), F.lit(None).cast("string").alias("rest"), x.alias("paragraph"))),
        lambda x: F.trim(x["paragraph"]) != "").cast(kind)
    wide = F.transform(F.coalesce(windows_of(F.col("text"), keys or key_words([s for c in sets.values() for s in c])), F.array().cast(
        "array<struct<at:int,reach:int,own:string,rest:string>>")), lambda w: F.struct(
        w["at"], w["reach"], w["own"], w["rest"], F.concat_ws(" ", w["own"], w["rest"]).alias("paragraph"))).cast(kind)
    cut = docs.select(*keep, F.explode_outer(F.concat(lines, wide)).alias("unit")).select(*keep, "unit.*")

    def bound(source: str) -> Column:
        return F.transform(F.array(word_array(F.col(source))), lambda w: F.concat(w, sequences(w, 3)))[0]

    # exploded, so that the filter below is not moved before the sequences and does not cut them once for each template
    cut = cut.withColumn("s", F.explode(F.array(F.when(F.col("own").isNotNull(), F.struct(
        bound("paragraph").alias("all"), bound("own").alias("own"), bound("rest").alias("rest"))))))

    def hits(s: set[str], name: str) -> Column:
        return F.size(F.array_intersect(F.array(*[F.lit(x) for x in sorted(s)]), F.col(name)))
    classes = []
    for label, several in sets.items():
        held = F.lit(False)
        for s in several:
            held = held | ((hits(s, "s.all") >= CONFIRM * len(s)) & (hits(s, "s.own") < CONFIRM * len(s)) & (hits(s, "s.all") > hits(s, "s.rest")))
        classes.append(F.when(held, F.lit(label)))
    cut = cut.withColumn("joined", F.when(F.col("own").isNotNull(), F.array_compact(F.array(*classes))))
    return cut.where(F.col("own").isNull() | (F.size("joined") > 0)).drop("rest", "s")


def scan(docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, families, n_paragraphs, n_licensed, n_unknown, confidence``."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    lines = with_terms(units_of(rows, "row", "doc_id", keys=scanner.keys))
    judged = (scanner.probabilities(lines.withColumn("terms", F.coalesce("terms", F.array().cast("array<string>"))))
              .withColumn("best", F.array_max("p")).withColumn("guess", (F.array_position("p", F.col("best")) - 1).cast("int")))
    known = (F.col("guess") > 0) & (F.col("guess") != CLASSES.index("unknown")) & (F.col("best") >= scanner.threshold)
    sure = F.when(known, confirmed(F.col("guess"), F.col("words"), spark)).otherwise(F.lit(False))
    wide = F.col("own").isNotNull()
    sure = F.when(wide, F.coalesce(known & F.array_contains("joined", F.col("guess")), F.lit(False))).otherwise(sure)
    real = F.col("paragraph").isNotNull()
    marked = judged.select("row", "doc_id", "at", "reach", wide.alias("wide"), (real & ~wide).alias("real"), (real & sure).alias("sure"),
                           (real & ~wide & (F.col("guess") > 0)).alias("any"), "guess", "best")
    out = marked.groupBy("row", "doc_id").agg(
        F.sum(F.col("real").cast("long")).alias("n_paragraphs"),
        F.collect_set(F.when(F.col("sure"), F.col("at"))).alias("licensed"),  # bounded by the text's own lines
        F.collect_list(F.when(F.col("any") & ~F.col("sure"), F.struct("at", "guess"))).alias("unsure"),
        F.collect_list(F.when(F.col("sure") & F.col("wide"), F.struct("at", "reach", "guess"))).alias("notices"),
        F.coalesce(F.max(F.when(F.col("sure"), F.col("best"))), F.lit(0.0)).alias("confidence"),
        *[F.max((F.col("sure") & (F.col("guess") == k)).cast("int")).alias(f"c{k}") for k in range(1, len(CLASSES))])
    part = F.filter("unsure", lambda u: ~F.array_contains("licensed", u["at"]) & ~F.exists("notices", lambda w: (
        (w["guess"] == u["guess"]) & (w["at"] <= u["at"]) & (u["at"] <= w["reach"]))))
    out = out.withColumn("n_licensed", F.size("licensed").cast("long")).withColumn("n_unknown", F.size(part).cast("long"))
    names = F.concat_ws(",", *[F.when(F.col(f"c{k}") == 1, F.lit(c)) for k, c in enumerate(CLASSES) if k])
    return out.select("doc_id", names.alias("families"), "n_paragraphs", "n_licensed", "n_unknown", "confidence")
