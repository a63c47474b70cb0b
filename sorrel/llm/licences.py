"""Licence scans: a word n-gram classifier names the licence family of a paragraph's windows, and the family's templates confirm it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sorrel.llm.common import documents, written

#: Names and identifiers of public licences by family, from which labelled notices are made.
NAMES = {
    "mit": ("MIT License", "MIT license (Expat)", "Expat License"),
    "apache": ("Apache License, Version 2.0", "Apache License 2.0", "Apache Software License 2.0"),
    "gpl": ("GNU General Public License, version 3", "GNU General Public License v2.0 or later", "GNU GPL version 3", "GPLv3", "GPL v2"),
    "lgpl": ("GNU Lesser General Public License, version 2.1", "GNU LGPL version 3", "LGPLv3", "GNU Lesser General Public License"),
    "bsd": ("BSD 3-Clause License", "BSD 2-Clause License", "simplified BSD license", "New BSD License"),
    "mpl": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "MPL version 2.0"),
    "cc-by": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"),
    "cc-by-sa": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License"),
    "cc-by-nc": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License"),
}
IDENTIFIERS = {"mit": ("MIT",), "apache": ("Apache-2.0",), "gpl": ("GPL-3.0-or-later", "GPL-2.0-only"), "lgpl": ("LGPL-2.1-only", "LGPL-3.0-or-later"), "bsd": ("BSD-3-Clause", "BSD-2-Clause"), "mpl": ("MPL-2.0",), "cc-by": ("CC-BY-4.0",), "cc-by-sa": ("CC-BY-SA-4.0",), "cc-by-nc": ("CC-BY-NC-4.0",)}
#: Sentences of the licences themselves and of their standard headers.
SENTENCES = {
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",),
    "apache": ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    "gpl": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",),
    "lgpl": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License. If a copy of the MPL was not distributed with this file",),
}
#: Licences of none of the families, which teach what a notice of an unknown licence is: to fit, and to calibrate.
OTHER = ("Example Public License, version 1", "Beerware License", "Artistic License 2.0", "Eclipse Public License 2.0", "zlib License", "Python Software Foundation License", "SIL Open Font License 1.1", "Academic Free License 3.0", "Common Development and Distribution License", "Microsoft Reciprocal License", "Vim License", "PHP License 3.01", "Ruby License", "OpenSSL License", "Perl License", "W3C Software License", "Nokia Open Source License", "Fair License", "Unlicense", "university licence", "vendor licence", "proprietary licence", "publisher's licence", "licence of its own")
OTHER_HELD = ("Boost Software License 1.0", "ISC License", "European Union Public Licence", "Open Database License", "author's own licence")
RESERVED = ("All rights reserved.", "Copyright by the authors. All rights reserved.", "Licensed for personal use only.", "No part of this work may be copied without permission of the publisher.")
RESERVED_HELD = ("Copyright 2020, all rights are reserved.", "For internal use only; all rights reserved by the owner.")
#: Sentences with words of notices that declare nothing.
PLAIN = ("He lost his driving licence on the way home.", "She studied engineering at MIT and wrote free software.", "A licence to fish is issued by the council.", "The licence plate was stolen last night.", "Drivers without a licence pay a fine.", "She holds a pilot licence and a degree.", "The shop was licensed to sell wine.", "The bank is a licensed lender.", "The general public may use the library free of charge.", "Apache helicopters flew over the field.", "The terms of the contract are in version two of the file.", "Creative people met on the commons.", "Permission to build was granted by the city.", "The source of the river is in the hills.", "The copy of this letter was distributed to the members.")
PLAIN_HELD = ("The pub has a licence to sell beer.", "A fishing licence costs ten pounds.", "The poet took some licence with the facts.", "Her licence was renewed in May.", "The doctor is licensed in two states.", "The company paid a licence fee for the song.", "They work at MIT under the terms of a grant.", "Members of the public may obtain a copy from the office.", "The Mozilla browser was released in that version.")
#: Ways to name a licence: to fit, and to calibrate.
FRAMES = ("Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This project is licensed under the terms of the {}.", "License: {}", "Distributed under the {}.", "This work is licensed under a {}.", "See the {} for details.", "{}")
FRAMES_HELD = ("Published under the {}.", "The source code is available under the {}", "Use of these texts is subject to the {}.", "This file is covered by the {}.")
IDENTIFIER_FRAMES = ("SPDX-License-Identifier: {}", "license = {}", "License {}")
IDENTIFIER_FRAMES_HELD = ("license: {}", "Licence identifier {}")
#: Words that a window must have to confirm a family: one set of those in a row.
TEMPLATES = {
    "mit": ("mit license", "expat license", "license mit", "identifier mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    "apache": ("apache license", "apache software license", "license apache", "identifier apache", "apache 2 0", "you may not use this file except in compliance with the license", "unless required by applicable law or agreed to in writing software distributed under the license"),
    "gpl": ("gnu general public license", "gnu gpl", "license gpl", "gplv3", "gplv2", "gpl v2", "gpl v3", "gpl 3 0", "gpl 2 0"),
    "lgpl": ("gnu lesser general public license", "gnu lgpl", "license lgpl", "lgplv3", "lgpl 2 1", "lgpl 3 0"),
    "bsd": ("bsd license", "bsd 3 clause", "bsd 2 clause", "license bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    "mpl": ("mozilla public license", "license mpl", "mpl version 2 0", "mpl 2 0", "this source code form is subject to the terms of the mozilla public license"),
    "cc-by": ("cc by", "creative commons attribution"),
    "cc-by-sa": ("cc by sa", "creative commons attribution sharealike"),
    "cc-by-nc": ("cc by nc", "creative commons attribution noncommercial"),
}
CLASSES = ("none", "unknown", *NAMES)
#: A window's words, and from one window to the next.
WIDTH, STEP = 48, 24


@dataclass(frozen=True)
class Classifier:
    """`temperature` scales the scores, `least` is the probability below which a family is reported as unknown, `error` the expected calibration error on the rows that fitted neither weights nor vocabulary,
    and `cues` are words of which a window must have one to be anything but none."""

    features: CountVectorizerModel
    model: LogisticRegressionModel
    temperature: float
    least: float
    error: float
    cues: tuple[str, ...]


def _words(text) -> Column:
    return F.filter(F.split(F.replace(F.lower(text), F.lit("licenc"), F.lit("licens")), r"[^\p{L}\p{N}]+", -1), lambda x: x != "")


def _grams(rows: DataFrame) -> DataFrame:
    """Add grams: words, and pairs and triples of words, of column words."""
    return rows.withColumn("grams", F.expr("concat(words, transform(slice(words, 2, size(words)), (w, i) -> concat_ws(' ', words[i], w)), transform(slice(words, 3, size(words)), (w, i) -> concat_ws(' ', words[i], words[i + 1], w)))"))


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, paragraph (its number, from 0) and words of every paragraph with a word. Blank lines end a paragraph; a wrapped notice so stays whole."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, r"\n[\t\r ]*\n", -1)).alias("paragraph", "said"))
    # a generated column, as the optimizer would otherwise repeat the split for each use
    return rows.select("doc_id", "text_hash", "paragraph", F.explode(F.array(_words(F.col("said")))).alias("words")).where(F.size("words") > 0)


def _notices(spark: SparkSession) -> DataFrame:
    """notice, label, held (used to calibrate instead of to fit), place and said of all labelled notices."""
    rows = []
    for k, names in NAMES.items():
        for held, frames, of_ids in ((False, FRAMES, IDENTIFIER_FRAMES), (True, FRAMES_HELD, IDENTIFIER_FRAMES_HELD)):
            rows += [(k, held, f.format(n)) for n in names for f in frames] + [(k, held, f.format(n)) for n in IDENTIFIERS[k] for f in of_ids]
        rows += [(k, False, x) for x in SENTENCES.get(k, ())]
    for held, names, frames, reserved, plain in ((False, OTHER, FRAMES, RESERVED * 3, PLAIN), (True, OTHER_HELD, FRAMES_HELD, RESERVED_HELD, PLAIN_HELD)):
        rows += [("unknown", held, f.format(n)) for n in names for f in frames] + [("unknown", held, x) for x in reserved] + [("none", held, x) for x in plain]
    numbered = sorted(rows, key=lambda r: r[1])  # the place of a notice counts within those held and within the others
    first = sum(not held for _, held, _ in rows)
    values = ", ".join("({}, {}, {}, {}, '{}')".format(i, CLASSES.index(k), str(held).lower(), i - first * held, said.replace("'", "\\'")) for i, (k, held, said) in enumerate(numbered))
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(notice, label, held, place, said)")


def _sampled(docs: DataFrame, sample_docs: int, seed: int) -> DataFrame:
    """h and words of a window at a place of its own of each sampled document, unless it names a licence: about `sample_docs` documents (never above twice that), chosen by a seeded hash of their id, so repeatably and from everywhere."""
    share = min(1.0, sample_docs / max(1, docs.count()))
    drawn = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample_docs)
    rows = drawn.select(F.xxhash64("doc_id", "text", F.lit(seed + 1)).alias("h"), F.explode(F.array(_words(F.coalesce(F.col("text").cast("string"), F.lit(""))))).alias("all"))
    start = F.pmod("h", F.greatest(F.lit(1), F.size("all") - WIDTH + 1)).cast("int")
    rows = rows.where(F.size("all") > 0).select("h", F.slice("all", start + 1, WIDTH).alias("words"))
    return rows.where(~F.concat_ws(" ", "words").rlike(r"\blicens|\bcc by\b|copyright|rights reserved|\bspdx\b"))


def train(docs: DataFrame, sample_docs: int = 4000, seed: int = 7, common: float = 0.005) -> Classifier:
    """Fit multinomial logistic regression on the word n-grams of the labelled notices above, as they are and within sampled windows of the corpus, and of such windows alone (class none).

    n-grams of words that over the share `common` of sampled windows have aren't features. Notices of other wordings and of other licences than those that fit, and a third of the windows, calibrate: they
    set the temperature of the scores (least negative log likelihood), the calibration error, and `least`, the smallest probability at which none of them is taken for a family that it isn't.
    """
    spark = docs.sparkSession
    plain = written(_sampled(docs, sample_docs, seed), "licence-sample").withColumn("held", F.pmod("h", F.lit(3)) == 0)
    notices = _notices(spark).withColumn("said", _words(F.col("said")))
    sizes = {r.held: r.n for r in notices.groupBy("held").agg(F.count("*").alias("n")).collect()}
    place = F.pmod(F.shiftright("h", 4), F.when(F.col("held"), sizes[True]).otherwise(sizes[False])).cast("int")
    cut = F.pmod(F.shiftright("h", 20), F.lit(24)).cast("int")
    within = plain.withColumn("place", place).join(F.broadcast(notices), ["held", "place"])
    within = within.select("label", "held", F.slice(F.concat(F.slice("words", 1, cut), "said", F.slice("words", 25, WIDTH)), 1, WIDTH).alias("words"))
    data = written(_grams(within.unionByName(notices.select("label", "held", F.col("said").alias("words"))).unionByName(plain.select(F.lit(0).alias("label"), "held", "words"))), "licence-training")

    # in how many sampled windows each word of a notice stands
    said = notices.where("not held").select(F.col("said").alias("words"))
    words = said.select(F.explode("words").alias("word")).distinct()
    counts = plain.select(F.explode(F.array_distinct("words")).alias("word")).join(F.broadcast(words), "word").groupBy("word").agg(F.count("*").alias("n"))
    seen = {r.word: r.n for r in counts.collect()}  # words of the fixed notices, so bounded
    most = common * plain.count()
    grams = sorted(r.gram for r in _grams(said).select(F.explode("grams").alias("gram")).distinct().collect())
    rarest = {g: min(g.split(), key=lambda w: (seen.get(w, 0), w)) for g in grams}
    vocabulary = [g for g in grams if seen.get(rarest[g], 0) <= most]
    features = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features")
    features = features.setBinary(True)
    data = features.transform(data).select("label", "held", "features", F.when((F.col("label") > 0) | F.expr("exists(words, w -> w like 'licens%')"), 1.0).otherwise(0.1).alias("weight")).coalesce(2).cache()
    model = LogisticRegression(labelCol="label", weightCol="weight", maxIter=40, regParam=0.0005, elasticNetParam=0.2, family="multinomial").fit(data.where("not held"))

    held = model.transform(data.where("held")).select("label", vector_to_array("rawPrediction").alias("raw"))
    grid = [0.25 * 1.15**i for i in range(25)]
    losses = held.agg(*[F.avg(-F.log(F.greatest(F.lit(1e-12), F.get(_softmax(t), F.col("label"))))).alias(f"t{i}") for i, t in enumerate(grid)]).first()
    temperature = min(zip(losses, grid, strict=True), key=lambda x: x[0] if x[0] is not None else 0.0)[1]
    judged = held.withColumn("p", _softmax(temperature)).select("label", F.array_max("p").alias("top"), (F.array_position("p", F.array_max("p")) - 1).alias("said"))
    bins = judged.groupBy(F.floor(F.col("top") * 10)).agg(F.abs(F.sum(F.col("top")) - F.count_if(F.col("said") == F.col("label"))).alias("gap"), F.count("*").alias("n"))
    error = bins.agg(F.sum("gap") / F.sum("n")).first()[0]
    wrong = judged.where("said > 1 and label != said").agg(F.max("top")).first()[0]
    data.unpersist()
    weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    above = (weights[2:].max(axis=0) > weights[0]) | (weights[1] > weights[0])
    # without any n-gram that speaks for another class, none has the best score: only windows with the rarest word of such an n-gram are scored
    cues = {rarest[g] for g, x in zip(vocabulary, above, strict=True) if x} if bias.argmax() == 0 else set()
    return Classifier(features, model, temperature, max(0.5, min(0.99, (wrong or 0.0) + 1e-6)), float(error or 0.0), tuple(sorted(cues)))


def _softmax(temperature: float) -> Column:
    scores = F.transform("raw", lambda x: F.exp((x - F.array_max("raw")) / temperature))
    return F.transform(scores, lambda x: x / F.aggregate(scores, F.lit(0.0), lambda a, y: a + y))


def classify(rows: DataFrame, classifier: Classifier) -> DataFrame:
    """Of paragraphs (doc_id, text_hash, paragraph, words), the licences that they declare: doc_id, paragraph, family, start_word, probability and similarity.

    Overlapping windows of 48 words are scored. Each window that isn't none is reported, as its family if the calibrated probability is `least` or more and a template of the family has all its words in a row
    there (similarity 1; else it is the largest share of a template's words that the window has), and as unknown otherwise. Of the windows of a paragraph with the same family the
    likeliest is returned, and unknown ones only where no neighbouring window is confirmed.
    """
    cues = classifier.cues
    at = F.filter(F.transform("words", lambda x, i: F.when(x.isin(*cues), i).otherwise(-1)), lambda i: i >= 0) if cues else F.sequence(F.lit(0), F.size("words") - 1)
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array((i / STEP).cast("int") * STEP, (i / STEP).cast("int") * STEP - STEP))))
    windows = rows.select("doc_id", "text_hash", "paragraph", "words", F.explode(F.filter(starts, lambda s: s >= 0)).alias("start_word"))
    windows = _grams(windows.withColumn("words", F.expr(f"slice(words, start_word + 1, {WIDTH})")))
    scored = classifier.model.transform(classifier.features.transform(windows)).where("prediction > 0").withColumn("raw", vector_to_array("rawPrediction"))
    scored = scored.withColumns({"probability": F.array_max(_softmax(classifier.temperature)), "_said": F.concat(F.lit(" "), F.concat_ws(" ", "words"), F.lit(" "))})

    def likeness(templates: tuple[str, ...]) -> Column:
        shares = [F.when(F.contains("_said", F.lit(f" {t} ")), 1.0).otherwise(F.size(F.array_intersect(F.array(*[F.lit(w) for w in set(t.split())]), "words")) / F.lit(len(set(t.split())) + 1)) for t in templates]
        return F.greatest(*shares)

    similarity = F.get(F.array(*[likeness(t) for t in TEMPLATES.values()]), F.col("prediction").cast("int") - 2)
    nearest = F.greatest(*[likeness(t) for t in TEMPLATES.values()])
    scored = scored.withColumn("similarity", F.when(F.col("prediction") > 1, similarity).otherwise(nearest))
    sure = (F.col("prediction") > 1) & (F.col("probability") >= classifier.least) & (F.col("similarity") == 1)
    name = F.get(F.array(*[F.lit(c) for c in CLASSES]), F.col("prediction").cast("int"))
    scored = scored.select("doc_id", "text_hash", "paragraph", "start_word", F.when(sure, name).otherwise("unknown").alias("family"), "probability", "similarity")
    key = ["doc_id", "text_hash", "paragraph"]
    beside = Window.partitionBy(*key).orderBy("start_word").rangeBetween(-STEP, STEP)
    scored = scored.withColumn("_near", F.max(F.col("family") != "unknown").over(beside)).where("family != 'unknown' or not _near")
    best = F.max_by(F.struct("start_word", "probability", "similarity"), F.struct("similarity", "probability", -F.col("start_word"))).alias("x")
    return scored.groupBy(*key, "family").agg(best).select("doc_id", "paragraph", "family", "x.*")


def scan_licences(docs: DataFrame, sample_docs: int = 4000, seed: int = 7) -> DataFrame:
    """doc_id, paragraph, family, start_word, probability and similarity of every licence that a paragraph declares, unknown ones included.

    The classifier is fitted on a bounded, seeded sample (a window of each of about `sample_docs` documents, and the fixed notices) and applied to every paragraph of every whole text, in place: only windows that declare
    something are shuffled.

    Null and empty texts have no paragraphs. A null doc_id is returned as such. Rows with the same id and text are reported once. An empty table gives an empty result. Other
    columns are ignored.
    """
    return classify(paragraphs(docs), train(docs, sample_docs, seed))


def op4_licence_classifier(spark, sf_dir: str) -> DataFrame:
    out = scan_licences(documents(spark, sf_dir))
    return out.select("doc_id", "paragraph", "family", "start_word", F.round("probability", 6).alias("probability"), F.round("similarity", 6).alias("similarity"))
