"""License scan in DataFrame functions only: sparse word n-gram logistic regression over paragraphs, confirmed by templates.

The model is small: its n-grams are those of the license templates, its weights a table of n-gram, family and weight. It
is fitted on the driver from the templates, cut and varied, and from a bounded sample of the corpus' own paragraphs as
the unknown class; Spark scores all paragraphs, and windows of the longer ones, by joining their hashed n-grams
with the table. A paragraph is taken for a family if its calibrated probability, or that of a window, is at least
MIN_CHANCE and a template of that family confirms it: the words shared are at least MIN_COMMON of the paragraph's, or the
trigrams shared are at least MIN_COMMON of the window's or of the template's.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Paragraphs of the corpus, by hash order, that the unknown class is fitted on.
SAMPLE_PARAGRAPHS = 1500
#: How many times the sample is let through to be sorted, and the range of hashes.
OVERSAMPLED, HASHES = 8, 1 << 40
MIN_CHANCE, MIN_COMMON, UNKNOWN = 0.5, 0.6, "unknown"
#: Words of the windows of a paragraph; each overlaps the next one by half. A notice of up to half a window is whole in one.
WINDOWS = (12, 48)
#: Names and customary notices of license families.
TEMPLATES: dict[str, list[str]] = {
    "apache": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Released under the BSD 3-Clause License.",
        "Licensed under the 2-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Released into the public domain under CC0 1.0.",
    ],
    "proprietary": [
        "Copyright. All rights reserved. No part of this work may be reproduced without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
}


def tokens(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def fitted(unknown: list[str], seed: int = 5) -> list[tuple[str, str, float]]:
    """Rows (n-gram, family, weight) of a multinomial logistic regression; the n-gram '' is the bias, scaled by the temperature.

    Each template is taken whole, cut, by sentences and windows, and with words dropped or added. A part is held out, on which a temperature is
    fitted that makes the probabilities true, the unknown class included.
    """
    rng = random.Random(seed)
    labels = [UNKNOWN, *sorted(TEMPLATES)]
    data: list[tuple[set[str], int]] = []
    for family, lines in sorted(TEMPLATES.items()):
        for line in lines:
            words = tokens(line)
            for i in range(24):
                w = [x for x in words if i < 4 or rng.random() > 0.08]
                if i % 3 == 1 and len(w) > 8:
                    w = w[: rng.randint(len(w) // 2, len(w))]
                if i % 4 == 3:
                    w += [rng.choice(["copyright", "c", "2019", "2023", "by", "the", "authors"]) for _ in range(3)]
                data.append((grams(w), labels.index(family)))
            sentences = [tokens(x) for x in re.split(r"(?<=[.;])\s+", line)]
            if len(sentences) > 1:
                data += [(grams(x), labels.index(family)) for x in sentences if len(x) > 2 for _ in range(6)]
            for _ in range(8 if len(words) > min(WINDOWS) else 0):
                at, size = rng.randrange(len(words) - min(WINDOWS) + 1), rng.choice(WINDOWS)
                data.append((grams(words[at : at + size]), labels.index(family)))
    common = [tokens(line) for lines in TEMPLATES.values() for line in lines]
    pool = [w for ws in common for w in ws]
    for text in unknown:
        data.append((grams(tokens(text)), 0))
    for _ in range(300):  # words of the templates in no order are no license
        data.append((grams([rng.choice(pool) for _ in range(rng.randint(2, 25))]), 0))
    names = sorted({g for x, y in data if y for g in x})
    index = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(data), len(names) + 1), np.float32)
    for row, (gs, _) in enumerate(data):
        own = [index[g] for g in gs if g in index]
        x[row, own] = 1 / np.sqrt(max(1, len(own)))
        x[row, -1] = 1
    y = np.array([label for _, label in data])
    held = np.array([rng.random() < 0.2 for _ in data])
    w = np.zeros((len(labels), x.shape[1]), np.float32)
    one, speed = np.eye(len(labels), dtype=np.float32)[y], np.zeros_like(w)
    weight = np.array([len(y) / (len(labels) * max(1, (y == k).sum())) for k in range(len(labels))], np.float32)[y] ** 0.5
    fit = ~held
    for _ in range(250):
        z = x[fit] @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        step = ((p - one[fit]) * weight[fit, None]).T @ x[fit] / fit.sum() + 1e-5 * w
        speed = 0.9 * speed - 4.0 * step
        w += speed
    z = x[held] @ w.T

    def loss(t: float) -> float:
        s = z / t
        return float(np.mean(np.log(np.exp(s - s.max(1, keepdims=True)).sum(1)) + s.max(1) - s[np.arange(len(s)), y[held]]))

    w /= min((0.25 * 1.2**i for i in range(20)), key=loss) if held.any() else 1
    rows = [(names[j] if j < len(names) else "", labels[k], float(w[k, j])) for k in range(len(labels)) for j in range(len(names) + 1)]
    return [r for r in rows if abs(r[2]) > 1e-4 or not r[0]]


def paragraphs(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, pos, words) of all lines that hold a letter or digit of ASCII."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    words = F.split(F.trim(F.regexp_replace(F.lower("line"), "[^a-z0-9]+", " ")), " ")
    return rows.select("doc_id", "th", "pos", words.alias("words")).where("words[0] <> ''")


def licensed(docs: DataFrame) -> DataFrame:
    """One row per paragraph of docs (doc_id, text) that names a license: doc_id, pos, family, score, common.

    pos is the line's number from 0, score the calibrated probability of it or of its likeliest confirmed window, common
    the share of words, or of a window's trigrams, in common with the closest template of the family. Defined results: null and empty texts have no rows; rows that repeat doc_id and text count
    once; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    lines = paragraphs(docs)
    # distinct paragraphs under a bound on their hash that lets about OVERSAMPLED times the sample through: what tasks send does not grow
    n_lines = docs.agg(F.sum(F.coalesce(F.size(F.split("text", "\n")), F.lit(0)))).first()[0] or 1
    bound = f"pmod(xxhash64(line), {HASHES}L) <= {HASHES}D * least(1D, {OVERSAMPLED * SAMPLE_PARAGRAPHS}D / {n_lines})"
    some = lines.where(F.size("words") >= 3).select(F.array_join("words", " ").alias("line")).where(bound).distinct()
    some = some.orderBy(F.expr(f"pmod(xxhash64(line), {HASHES}L)"), "line").limit(SAMPLE_PARAGRAPHS)
    marks = {w for ls in TEMPLATES.values() for line in ls for w in tokens(line)}
    sample = [r.line for r in some.collect() if len(set(r.line.split()) & marks) < 0.5 * len(set(r.line.split()))]
    rows = fitted(sample)
    families = sorted(TEMPLATES)
    bias = {f: w for g, f, w in rows if not g}
    by_gram: dict[str, dict[str, float]] = {}
    for g, f, w in rows:
        if g:
            by_gram.setdefault(g, {})[f] = w
    labels = [UNKNOWN, *families]
    # the model has the n-grams of the templates only: bounded by TEMPLATES
    model = spark.createDataFrame([(g, *[ws.get(f, 0.0) for f in labels]) for g, ws in by_gram.items()], "gram string, " + ", ".join(f"w{i} double" for i in range(len(labels))))
    model = model.withColumn("g", F.xxhash64("gram")).drop("gram")
    # a notice has a bigram of the templates; paragraphs without one are unknown
    pairs = sorted({g for g in by_gram if g.count(" ") == 1})
    n = F.size("words")
    two = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1)))
    hinted = lines.where(n > 1).select("doc_id", "th", "pos", "words", F.explode(two).alias("pair"))
    hint = spark.createDataFrame([(g,) for g in pairs if len(set(g.split()) - {"the", "of", "and", "to", "in", "is", "a", "or", "for", "be", "at", "as", "by", "on", "with", "this", "that"}) > 0], "pair string")
    # dealt by paragraph: what follows stays where it is
    hinted = hinted.join(F.broadcast(hint), "pair", "left_semi").groupBy("doc_id", "th", "pos").agg(F.first("words").alias("words"))

    # a window of a paragraph has its number, the whole paragraph 0

    def windows(size: int) -> F.Column:
        starts = F.sequence(F.lit(0), F.greatest(n - size // 2 - 1, F.lit(0)), F.lit(size // 2))
        cut = F.transform(starts, lambda i: F.struct((i * 100 + size).cast("int").alias("part"), F.slice("words", i + 1, size).alias("w")))
        return F.filter(cut, lambda x: n > size)

    wide = F.concat(F.array(F.struct(F.lit(0).alias("part"), F.col("words").alias("w"))), *[windows(size) for size in WINDOWS])
    hinted = hinted.select("doc_id", "th", "pos", F.explode(wide).alias("x")).select("doc_id", "th", "pos", "x.part", F.col("x.w").alias("words"))

    def ngrams(size: int) -> F.Column:
        span = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(span, lambda i: F.concat_ws(" ", *[F.element_at("words", i + k) for k in range(size)]))

    each = hinted.select("doc_id", "th", "pos", "part", "words", F.explode(F.array_distinct(F.concat(ngrams(1), ngrams(2), ngrams(3)))).alias("gram"))
    hits = each.withColumn("g", F.xxhash64("gram")).join(F.broadcast(model), "g")
    sums = hits.groupBy("doc_id", "th", "pos", "part", "words").agg(F.count("*").alias("hits"), *[F.sum(f"w{i}").alias(f"s{i}") for i in range(len(labels))])
    logits = [F.col(f"s{i}") / F.sqrt("hits") + F.lit(bias[f]) for i, f in enumerate(labels)]
    scored = sums.select("doc_id", "th", "pos", "part", "words", F.array(*logits).alias("z")).withColumn("top", F.array_max("z"))
    chance = 1 / F.aggregate("z", F.lit(0.0), lambda total, z: total + F.exp(z - F.col("top")))
    family = F.element_at(F.array(*[F.lit(f) for f in labels]), F.array_position("z", F.col("top")).cast("int"))
    taken = scored.select("doc_id", "th", "pos", "part", "words", family.alias("family"), chance.alias("score")).where((F.col("family") != UNKNOWN) & (F.col("score") >= MIN_CHANCE))
    threes = lambda line: sorted(g for g in grams(tokens(line)) if g.count(" ") == 2)
    known = spark.createDataFrame([(f, sorted(set(tokens(line))), threes(line)) for f, ls in sorted(TEMPLATES.items()) for line in ls], "family string, template array<string>, three array<string>")
    taken = taken.withColumn("own", F.array_distinct(ngrams(3))).withColumn("words", F.array_distinct("words"))
    both = taken.join(F.broadcast(known), "family")
    shared = F.size(F.array_intersect("own", "three"))
    inside = F.when(F.size("three") > 0, shared / F.greatest(F.least(F.size("three"), F.size("own")), F.lit(1))).otherwise(0.0)
    alike = F.when(F.col("part") == 0, F.size(F.array_intersect("words", "template")) / F.size("words")).otherwise(0.0)
    confirmed = both.withColumn("common", F.greatest(alike, inside)).where(F.col("common") >= MIN_COMMON)
    best = F.max(F.struct("score", "common", "family")).alias("best")
    return confirmed.groupBy("doc_id", "th", "pos").agg(best).select("doc_id", "pos", "best.family", "best.score", "best.common")
