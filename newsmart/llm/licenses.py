"""Licence notices in documents, by a trained paragraph classifier that templates confirm.

A paragraph is a line, or a run of following lines: notices in files are often wrapped. Every line is judged by
itself first, and is a notice of its own if it is confirmed and holds most of a template. Of the others, lines that
hold a signal word or stand between two that do, and follow one another without a blank line, are then judged
together; if together they are confirmed they are one notice, else each line stays what it was alone. Comment marks and other signs are no words, so they don't matter.

Features are the word pairs and single words (ASCII letters lower-cased, digits and dots kept) that occur in
templates of licence notices and not, as everyday words, in ordinary text. A sparse logistic regression gives each
family its probability, a class `unknown` that of licence-like text of no known family, and a last class that of
being no notice. It is trained on the driver in numpy on variants of the templates, on licence-like sentences with
invented names, and on a bounded sample of the documents' lines, and calibrated on variants and lines held back: a
temperature, and for each family the probability from which its predictions are held for right. A notice below that
is `unknown` too.

A prediction is confirmed if most of a template's word pairs stand in the paragraph, or most of the
paragraph's in a template of that family.

Scoring is all DataFrame operations. Only lines with one of the model's signal words, and those between two such,
are taken apart: the signal words are chosen so that a paragraph without any can't reach the threshold, whatever
else is in it.

Null and empty texts have no notices. Documents are handled row by row, with a row id of their own, so that
missing and repeated ids do no harm.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmart.llm.arrow import Stage

#: Lines of documents that are learned from as no notices, about, and the characters of the longest such line.
SAMPLE = 4000
SAMPLE_CHARS = 20_000
#: Variants of each template to train on, and to calibrate with.
VARIANTS = (60, 30)
#: Wrong notices among 1000 accepted paragraphs, at most, in calibration.
WRONG_PER_1000 = 10
NONE, UNKNOWN = "none", "unknown"
#: A template confirms a prediction from this part of shared word pairs.
SHARED = 0.6

#: Names of families and short notices of each, as licences and files commonly word them.
TEMPLATES = {
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file for details.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement.",
        "SPDX-License-Identifier: MIT",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Released under the BSD 2-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "zlib": [
        "Released under the zlib License.",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "SPDX-License-Identifier: Zlib",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Available under the Creative Commons Attribution license CC BY 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal.",
        "Released into the public domain under CC0 1.0.",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright 2020 The Company. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
#: Licence-like sentences of no known family; NAME stands for an invented name.
GENERIC = (
    "Licensed under the NAME License, Version 7.",
    "Licensed under the NAME license. See the LICENSE file for details.",
    "Released under the NAME License.",
    "Released under the terms of the NAME Public License, version 4.1.",
    "This program is distributed under the terms of the NAME Public License.",
    "This work is licensed under a NAME License.",
    "Use of this software is governed by the NAME license.",
    "SPDX-License-Identifier: NAME-1.0",
    "SPDX-License-Identifier: NAME",
    "See the LICENSE file for the license terms.",
)
#: Words too common to tell a notice.
EVERYDAY = frozenset(
    "the of and a an to in is this that under at by you we it he she they be are was were been has have had may can could will would "
    "not no or nor if for with without on as from into its their his her our your one all any some use used see so but which who what "
    "when there here also than then them these those do does did more most other such only very up out about over".split()
)


def words_of(line: str) -> list[str]:
    return re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", re.sub("[A-Z]", lambda m: m.group().lower(), line))


def line_words(line: Column) -> Column:
    """The words of a line, as words_of has them."""
    lower = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"), F.lit(0))


def pairs_of(words: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def word_pairs(words: Column) -> Column:
    return F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", F.get(words, i), w))


@dataclass
class Model:
    families: list[str]  # UNKNOWN and NONE are the last
    weights: dict[str, list[float]]
    bias: list[float]
    temperature: float
    least: dict[str, float]
    signals: list[str]

    def probabilities(self, line: str) -> np.ndarray:
        words = words_of(line)
        total = np.array(self.bias)
        for f in {*words, *pairs_of(words)}:
            if f in self.weights:
                total = total + self.weights[f]
        e = np.exp((total - total.max()) / self.temperature)
        return e / e.sum()


def _variants(rng: np.random.Generator, many: int) -> list[tuple[list[str], str]]:
    """Templates with words left out, words put in, and other words around them."""
    out = []
    filler = "foo bar baz qux x1 y2 z3".split()
    for family, templates in TEMPLATES.items():
        for template in templates:
            words = words_of(template)
            out.append((words, family))
            for _ in range(many - 1):
                drop = rng.random(len(words)) < 0.08 * (len(words) > 6)
                own = [w for w, d in zip(words, drop, strict=True) if not d]
                for _ in range(int(rng.integers(0, 3))):
                    own.insert(int(rng.integers(0, len(own) + 1)) * int(len(own) > 8) or 0, str(rng.choice(filler)))
                out.append((own, family))
    for sentence in GENERIC:
        for _ in range(many):
            name = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), int(rng.integers(2, 9))))
            out.append((words_of(sentence.replace("NAME", name)), UNKNOWN))
    return out


def _matrix(rows: list[list[str]], features: dict[str, int]) -> np.ndarray:
    x = np.zeros((len(rows), len(features)), dtype=np.float32)
    for i, words in enumerate(rows):
        for f in {*words, *pairs_of(words)}:
            if f in features:
                x[i, features[f]] = 1
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(ordinary: list[str], seed: int = 3) -> Model:
    """A model from the templates and from paragraphs of which nearly all are no notices."""
    rng = np.random.default_rng(seed)
    families = [*TEMPLATES, UNKNOWN, NONE]
    known = [words_of(t) for ts in TEMPLATES.values() for t in ts] + [words_of(t) for t in GENERIC]
    vocabulary = {f for w in known for f in (*w, *pairs_of(w)) if "name" not in f.split() or f == "the name"}
    # paragraphs that are templates themselves teach the wrong thing
    notices = {tuple(w) for w in known}
    plain = [w for w in map(words_of, ordinary) if w and tuple(w) not in notices and not ({"license", "licensed", "copyright", "licence"} & set(w))]
    seen: dict[str, int] = {}
    for w in plain:
        for f in {*w, *pairs_of(w)} & vocabulary:
            seen[f] = seen.get(f, 0) + 1
    rare = lambda f: seen.get(f, 0) <= 0.002 * len(plain) + 1 and any(c.isalpha() for c in f)
    kept = sorted(f for f in vocabulary if not set(f.split()) <= EVERYDAY and rare(f))
    features = {f: i for i, f in enumerate(kept)}

    def rows(many: int, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        own = _variants(rng, many)
        bits = [[str(x) for x in rng.choice(kept, int(rng.integers(1, 3)), replace=False)] for _ in range(len(own) // 2)]  # stray words are no notice
        lists = [w for w, _ in own] + texts + [b[0].split() for b in bits]
        names = [f for _, f in own] + [NONE] * (len(texts) + len(bits))
        return _matrix(lists, features), np.array([families.index(n) for n in names])

    half = len(plain) * 2 // 3
    x, y = rows(VARIANTS[0], plain[:half])
    w, b = np.zeros((x.shape[1], len(families))), np.zeros(len(families))
    b[-1] = 2.0
    dw, db = np.zeros_like(w), np.zeros_like(b)
    for _ in range(300):
        p = _softmax(x @ w + b)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        dw = 0.9 * dw - 2.0 * (x.T @ p + 1e-4 * w)
        db = 0.9 * db - 2.0 * p.sum(axis=0)
        w, b = w + dw, b + db
    w[np.abs(w) < 0.05] = 0
    x, y = rows(VARIANTS[1], plain[half:])
    z = x @ w + b
    loss = lambda t: -np.log(np.maximum(_softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
    t = float(min(np.geomspace(0.1, 4, 40), key=loss))
    p = _softmax(z / t)
    guess = p.argmax(axis=1)
    least = {}
    for k, family in enumerate(families[:-1]):
        own = np.flatnonzero(guess == k)
        order = own[np.argsort(-p[own, k])]
        wrong = np.cumsum(y[order] != k)
        fine = np.flatnonzero(1000 * wrong <= WRONG_PER_1000 * np.arange(1, len(order) + 1))
        least[family] = float(p[order[fine[-1]], k]) - 1e-9 if len(fine) else 1.0  # sums in another order are reached too
    weights = {f: [float(v) for v in w[i]] for f, i in features.items() if np.any(w[i])}
    return Model(families, weights, [float(v) for v in b], t, least, _signals(weights, b))


def _signals(weights: dict[str, list[float]], bias: np.ndarray) -> list[str]:
    """Words so chosen that a line without them can't be more likely a notice of any family than none."""
    gain = {f: np.maximum(np.array(v[:-1]) - v[-1], 0) for f, v in weights.items()}
    room = np.asarray(bias)[-1] - np.asarray(bias)[:-1]
    signals: list[str] = []
    while gain:
        total = sum(gain.values())
        if (total < room).all():
            break
        best: dict[str, float] = {}
        for f, g in gain.items():
            for word in set(f.split()) - EVERYDAY:
                best[word] = best.get(word, 0.0) + float(g[total >= room].sum())
        word = max(sorted(best), key=best.get)
        signals.append(word)
        gain = {f: g for f, g in gain.items() if word not in f.split()}
    return signals


def ordinary_paragraphs(docs: DataFrame, text: str = "text") -> list[str]:
    """A bounded sample of the documents' lines, chosen by their hash; lines over SAMPLE_CHARS are left out."""
    lines = docs.select(F.explode(F.split(F.col(text).cast("string"), "\n")).alias("t"))
    lines = lines.where("length(trim(t)) > 0").where(F.char_length("t") <= SAMPLE_CHARS)
    n = lines.count()
    if not n:
        return []
    part = F.pmod(F.xxhash64("t"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))
    return sorted(r.t for r in lines.where(part).distinct().limit(2 * SAMPLE).collect())


def _signal(model: Model) -> str:
    return "(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(w) for w in model.signals) + ")(?![a-z0-9])"


def _judged(paragraphs: DataFrame, model: Model) -> DataFrame:
    """Paragraphs (uid, line_no, line, words) that are notices, with family, score, shared, confirmed."""
    spark = paragraphs.sparkSession
    maybe = paragraphs.withColumn("pairs", F.array_distinct(word_pairs(F.col("words"))))
    grams = maybe.select("uid", "line_no", F.explode(F.array_distinct(F.concat("words", "pairs"))).alias("f"))
    k = len(model.families)
    # the model's features: as many rows as the templates have words and pairs
    table = F.broadcast(spark.createDataFrame([(f, *map(float, v)) for f, v in sorted(model.weights.items())], "f string, " + ", ".join(f"w{i} double" for i in range(k))))
    sums = grams.join(table, "f").groupBy("uid", "line_no").agg(*[F.sum(F.col(f"w{i}").cast("decimal(30,15)")).cast("double").alias(f"w{i}") for i in range(k)])
    logits = F.array(*[(F.col(f"w{i}") + F.lit(model.bias[i])) / F.lit(model.temperature) for i in range(k)])
    top = F.array_max("z")
    place = F.array_position("z", top).cast("int")
    total = F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    least = F.array(*[F.lit(float(model.least.get(f, 1.0))) for f in model.families])
    found = sums.select("uid", "line_no", logits.alias("z")).select(
        "uid", "line_no", F.element_at(F.lit(model.families), place).alias("guess"), (1 / total).alias("score"), F.element_at(least, place).alias("least")
    )
    lines = maybe.join(found.where(F.col("guess") != NONE), ["uid", "line_no"])
    # the templates' pairs: a row for each template
    known = [(f, sorted(set(pairs_of(words_of(t))))) for f, ts in TEMPLATES.items() for t in ts]
    templates = F.broadcast(spark.createDataFrame(known, "guess string, template array<string>"))
    smaller = F.greatest(F.least(F.size("pairs"), F.size("template")), F.lit(1))
    part = F.coalesce(F.size(F.array_intersect("pairs", "template")) / smaller, F.lit(0.0))
    cover = F.coalesce(F.size(F.array_intersect("pairs", "template")) / F.greatest(F.size("template"), F.lit(1)), F.lit(0.0))
    best = lines.join(templates, "guess", "left").groupBy("uid", "line_no", "guess", "score", "least").agg(
        F.max(part).alias("shared"), F.max(cover).alias("cover"), F.first("line").alias("line")
    )
    sure = F.col("score") >= F.col("least")
    named = F.when(sure, F.col("guess")).otherwise(F.lit(UNKNOWN))
    confirmed = sure & (F.col("shared") >= SHARED)
    return best.select("uid", "line_no", "line", named.alias("family"), "score", "shared", confirmed.alias("confirmed"), (confirmed & (F.col("cover") >= SHARED)).alias("whole"))


def notices(docs: DataFrame, model: Model, text: str = "text", stage: Stage | None = None) -> DataFrame:
    """docs' rows (uid, text) as one row for each notice: uid, line_no (its first), line, family, score, shared, confirmed."""
    stage = stage or Stage(docs.sparkSession, "licenses")
    signal = _signal(model)
    split = docs.where(F.col(text).rlike(signal)).select("uid", F.split(F.col(text), "\n").alias("lines"))
    split = split.withColumn("marks", F.transform("lines", lambda x: x.rlike(signal)))
    chosen = F.transform(
        "lines",
        lambda x, i: F.struct(
            x.alias("line"), i.alias("line_no"), F.get("marks", i).alias("signal"),
            (F.coalesce(F.get("marks", i - 1), F.lit(False)) & F.coalesce(F.get("marks", i + 1), F.lit(False)) & x.rlike("[A-Za-z0-9]")).alias("between"),
        ),
    )
    taken = split.select("uid", F.explode(F.filter(chosen, lambda x: x["signal"] | x["between"])).alias("x"))
    taken = taken.select("uid", "x.line_no", "x.line", "x.signal").withColumn("words", line_words(F.col("line")))
    taken = stage.save(taken, "lines")
    alone = stage.save(_judged(taken.where("signal").drop("signal"), model), "alone")
    open_lines = taken.join(alone.where("whole"), ["uid", "line_no"], "left_anti")
    # lines that follow one another differ in number as they do in place; a document's lines at most are in a window
    run = F.col("line_no") - F.row_number().over(Window.partitionBy("uid").orderBy("line_no"))
    runs = open_lines.withColumn("run", run).groupBy("uid", "run").agg(F.array_sort(F.collect_list(F.struct("line_no", "line", "words"))).alias("own"))
    runs = runs.where(F.size("own") > 1).select(
        "uid", F.element_at("own", 1)["line_no"].alias("line_no"), F.array_join("own.line", "\n").alias("line"), F.flatten("own.words").alias("words"),
        F.element_at("own", -1)["line_no"].alias("last"),
    )
    together = stage.save(_judged(runs.drop("last"), model).where("confirmed").join(runs.select("uid", "line_no", "last"), ["uid", "line_no"]), "together")
    parts = together.select("uid", F.explode(F.sequence("line_no", "last")).alias("line_no"))
    return alone.join(parts, ["uid", "line_no"], "left_anti").unionByName(together.drop("last")).drop("whole")


def fit(docs: DataFrame, text: str = "text") -> Model:
    return train(ordinary_paragraphs(docs, text))


def licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: Model | None = None) -> DataFrame:
    """One row a document: number of notices, confirmed and unknown ones, and the confirmed families, in order."""
    stage = Stage(docs.sparkSession, "licenses")
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).cast("string").alias("text"))
    model = model or fit(rows)
    rows = rows.withColumn("uid", F.monotonically_increasing_id())
    staged = stage.save(rows.select("uid", "doc", F.when(F.col("text").rlike(_signal(model)), F.col("text")).alias("text")), "docs")
    found = stage.save(notices(staged, model, stage=stage), "notices")
    each = found.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_notices"), F.count_if("confirmed").alias("n_confirmed"), F.count_if(F.col("family") == UNKNOWN).alias("n_unknown"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
    )
    out = staged.select("uid", "doc").join(each, "uid", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(F.col("doc").alias(doc_id), zero("n_notices"), zero("n_confirmed"), zero("n_unknown"), F.coalesce("families", F.lit("")).alias("families"))
