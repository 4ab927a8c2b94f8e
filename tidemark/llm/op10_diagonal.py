"""License scans by diagonal voting.

Every 3-word window of every text is looked up among the 3-word windows of the
templates.  A hit at word ``pos`` of the text and ``at`` of the template votes
for the diagonal ``pos - at``; diagonals at most ``SLIP`` words apart are merged,
so that a word too many or too few does not split a passage.  A merged span is
accepted if it holds enough of the template's windows and is about as long as
the template.  Three short phrases are templates too, found just where all
their windows stand on one diagonal: the base.

The windows are made and joined in the scan's own stage: the templates are a
fixed list, so their table is broadcast, and only hits (and one row for each
document) leave it.

Defined cases: a null text is empty; no words: no labels and score 0; equal rows
are scanned once and reported once each; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import alnum_words, cut, same_row, table

K = 3
SLIP = 3
COVERED = 0.8
LONGER = 1.3

#: Phrases of the base and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
#: Passages of public licenses (openings, grants, conditions and disclaimers, so that a part is
#: found without the rest), and how works usually name them.
TEMPLATES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("Released under the MIT License", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License", "apache-2"),
    ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("This work is licensed under the GNU General Public License, version 3", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gpl"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "bsd"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions", "mit"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software", "mit"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied", "apache-2"),
    ("Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form", "apache-2"),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details", "gpl"),
    ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", "bsd"),
    ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd"),
    ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED", "bsd"),
    ("provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS", "isc"),
    ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means", "unlicense"),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required", "zlib"),
    ("If a copy of the MPL was not distributed with this file, You can obtain one at", "mpl-2"),
]


def template_words(text: str) -> list[str]:
    return re.findall(r"[0-9a-z]+", text.lower())


def grams(spark: SparkSession) -> DataFrame:
    """(gram_hash, entries): the windows of all templates, one row for each hash."""
    split = [(template_words(text), label) for text, label in BASE + TEMPLATES]
    rows = [F.struct(F.lit(t).alias("template"), F.split(F.lit(" ".join(words)), " ").alias("words"), F.lit(label).alias("label"), F.lit(t < len(BASE)).alias("is_base")) for t, (words, label) in enumerate(split)]
    whole = spark.range(1).select(F.inline(F.array(*rows))).withColumn("n_grams", F.size("words") - K + 1)
    windows = F.transform(F.sequence(F.lit(1), F.col("n_grams")), lambda i: F.array_join(F.slice("words", i, K), " "))
    made = whole.select("template", "label", "n_grams", "is_base", F.posexplode(windows).alias("at", "gram"))
    parts = F.split("gram", " ")
    return made.groupBy(F.xxhash64(*[parts[i] for i in range(K)]).alias("gram_hash")).agg(F.collect_list(F.struct("gram", "template", "at", "label", "n_grams", "is_base")).alias("entries"))


def scan(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, text_hash, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), alnum_words(F.col("text")).alias("words"))
    each = words.select("doc_id", "text_hash", "words", F.posexplode_outer("words").alias("pos", "word"))
    window = [F.get("words", F.col("pos") + i) for i in range(K)]
    looked = each.select("doc_id", "text_hash", F.size("words").alias("n_words"), "pos", F.array(*window).alias("window"), F.xxhash64(*window).alias("gram_hash"))
    found = looked.join(F.broadcast(grams(docs.sparkSession)), "gram_hash", "left").where("entries IS NOT NULL OR pos IS NULL OR pos = 0")
    seen = cut(found.select("doc_id", "text_hash", "n_words", "pos", F.array_join("window", " ").alias("gram"), "entries"))

    every = seen.where("pos IS NULL OR pos = 0").select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"))
    hits = seen.where("entries IS NOT NULL").select("doc_id", "text_hash", "pos", "gram", F.explode("entries").alias("e")).where("gram = e.gram").select("doc_id", "text_hash", "pos", "e.*").distinct()
    key = ["doc_id", "text_hash", "template"]
    votes = hits.groupBy(*key, "label", "n_grams", "is_base", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("low"), F.max("pos").alias("high"))

    along = W.partitionBy(*key).orderBy("diagonal")
    step = F.when(F.col("diagonal") - F.lag("diagonal").over(along) <= SLIP, 0).otherwise(1)
    band = F.when(F.col("is_base"), F.col("diagonal")).otherwise(F.sum("step").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
    bands = votes.withColumn("step", step).withColumn("band", band)
    spans = bands.groupBy(*key, "label", "n_grams", "is_base", "band").agg(F.least(F.sum("votes") / F.first("n_grams"), F.lit(1.0)).alias("coverage"), F.min("diagonal").alias("diagonal"), F.min("low").alias("low"), F.max("high").alias("high"))
    whole = F.col("coverage") == 1.0
    fits = (F.col("coverage") >= COVERED) & (F.col("high") - F.col("low") + 1 <= LONGER * F.col("n_grams") + SLIP)
    judged = spans.withColumn("accepted", F.when(F.col("is_base"), whole).otherwise(fits))

    base = F.col("accepted") & F.col("is_base")
    named = lambda cond: F.array_join(F.array_sort(F.collect_set(F.when(cond, F.col("label")))), ",")
    per_doc = judged.groupBy("doc_id", "text_hash").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("diagonal"))).cast("long").alias("last_word"),
        named(base).alias("base_labels"),
        named(F.col("accepted")).alias("labels"),
        F.max("coverage").alias("score"),
    )
    joined = every.alias("every").join(per_doc.alias("found"), same_row("every", "found"), "left")
    return joined.select(
        "every.doc_id", "every.text_hash", "every.n_words",
        F.coalesce("found.n_base", F.lit(0)).cast("long").alias("n_base"),
        "found.first_word", "found.last_word",
        F.coalesce("found.base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("found.labels", F.lit("")).alias("labels"),
        F.coalesce("found.score", F.lit(0.0)).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("text_hash")
