"""Licence scan by Dice coefficient over word bigrams, DataFrame functions only.

Units of a text are its lines, its paragraphs (parted by blank lines) and the
whole text.  A unit and a template are compared by their sets of word bigrams:
dice = 2 |A & B| / (|A| + |B|).  At a threshold t a template of b bigrams can
only match units of t b / (2 - t) to (2 - t) b / t bigrams, so the join on
bigrams drops all other templates.  The templates are a fixed table of a few
kilobytes; documents are never compared with each other.

Runs of words are compared as well, across lines and paragraphs or inside a
line: for each template the run of at most (2 - t) b / t bigrams with the
highest dice (the first of equals).  Such a run begins with a bigram of the
template, so only those places are tried, and only in texts that hold t b / (2 - t) different ones.

Words are those of the decontamination operator (A-Z lower-cased).  A null text
has no units.  Of equal scores the licence first in order of id is the best one.
Rows that agree in id and text get the same result.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, quoted
from .decontamination import item_words

THRESHOLD = 0.8

# ---- fixed values: public licence notices and texts, (SPDX id, text) --------
BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. ")
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
            "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
            "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
            "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
            "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
            "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
            "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
            "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
            "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
                   "governing permissions and limitations under the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the "
                         "GNU General Public License as published by the Free Software Foundation, either version 3 of "
                         "the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
                "MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD-2-Clause", BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_CONDITIONS + "Neither the name of the copyright holder nor the names of its contributors may be "
                     "used to endorse or promote products derived from this software without specific prior written "
                     "permission. " + BSD_DISCLAIMER),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
             "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
             "use this software for any purpose, including commercial applications, and to alter it and redistribute it "
             "freely, subject to the following restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                  "compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights "
                "to this work."),
)


def _pairs(words):
    """Hashes of the pairs of words that follow each other, in order."""
    return F.when(F.size(words) < 2, F.array().cast("array<bigint>")).otherwise(F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1))), F.lit(1), F.size(words) - 1))


def _bigrams(words):
    """Hashes of the distinct pairs of words that follow each other."""
    return F.array_distinct(_pairs(words))


def templates(spark: SparkSession, threshold: float = THRESHOLD, fixed=TEMPLATES) -> DataFrame:
    """One row per template and bigram, with the sizes that can reach the threshold."""
    made = spark.range(1).select(F.inline(F.array(*(
        F.struct(F.lit(i).alias("template"), F.lit(s).alias("licence"), F.lit(t).alias("text"))
        for i, (s, t) in enumerate(fixed)))))
    return (made.withColumn("grams", let(item_words(F.col("text")), _bigrams)).withColumn("size", F.size("grams"))
            .select("template", "licence", "size",
                    F.ceil(F.col("size") * threshold / (2 - threshold) - 1e-9).alias("least"),
                    F.floor(F.col("size") * (2 - threshold) / threshold + 1e-9).alias("most"),
                    F.explode("grams").alias("gram")))


def _best_run(grams, t):
    """(-dice, start, end) of the best run of bigrams for the template ``t``."""
    ordered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("gram"), i.alias("at"))))
    # each place with the one before it of the same bigram: it is new to a run that starts after that
    marked = let(ordered, lambda o: F.sort_array(F.transform(o, lambda x, k: F.struct(
        x["at"].alias("at"),
        F.when(F.get(o, k - 1)["gram"] == x["gram"], F.get(o, k - 1)["at"]).otherwise(F.lit(-1)).alias("before"),
        F.array_contains(t["grams"], x["gram"]).alias("hit")))))

    def grown(state, x, start):
        new = x["before"] < start
        n = state["n"] + new.cast("int")
        both = state["both"] + (new & x["hit"]).cast("int")
        dice = 2 * both / (n + t["size"])
        return F.struct(n.alias("n"), both.alias("both"), F.greatest(state["dice"], dice).alias("dice"),
                        F.when(dice > state["dice"], x["at"]).otherwise(state["end"]).alias("end"))

    def from_start(places, start):
        none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("both"), F.lit(0.0).alias("dice"), F.lit(-1).alias("end"))
        return F.aggregate(F.slice(places, start + 1, t["most"]), none, lambda a, x: grown(a, x, start),
                           lambda a: F.struct((-a["dice"]).alias("dice"), start.alias("start"), a["end"].alias("end")))

    def starts(hits):
        reach = F.transform(hits, lambda x, j: F.struct(x["at"].alias("at"), F.get(hits, j + t["least"] - 1)["at"].alias("far")))
        return F.filter(reach, lambda s: s["far"] - s["at"] < t["most"])

    return let(marked, lambda places: F.array_min(F.transform(
        let(F.filter(places, lambda x: x["hit"]), starts), lambda s: from_start(places, s["at"]))))


def best_runs(rows: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(doc_key, template, licence, dice, run): the best run of words for each
    template that reaches the threshold, of rows (doc_key, text)."""
    # the template table is fixed: a few kilobytes
    held = [r.asDict() for r in known.groupBy("template", "licence", "size", "least", "most")
            .agg(F.collect_list("gram").alias("grams")).collect()]
    shapes = F.from_json(F.lit(json.dumps(held)), "array<struct<template:int,licence:string,size:int,least:int,most:int,grams:array<bigint>>>")
    every, fewest = sorted({g for r in held for g in r["grams"]}), min((r["least"] for r in held), default=0)
    near = let(F.array_distinct(F.filter("grams", lambda g: g.isin(every))), lambda hits: F.when(
        F.size(hits) >= fewest, F.filter(shapes, lambda t: F.size(F.array_intersect(hits, t["grams"])) >= t["least"])))
    tried = (rows.select("doc_key", let(item_words(F.col("text")), _pairs).alias("grams"))
             .select("doc_key", "grams", F.explode(near).alias("t")))
    return (tried.select("doc_key", "t.template", "t.licence", _best_run(F.col("grams"), F.col("t")).alias("run"))
            .select("doc_key", "template", "licence", (-F.col("run.dice")).alias("dice"),
                    F.struct("run.start", "run.end").alias("run"))
            .where(F.col("dice") >= threshold))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
         fixed=TEMPLATES) -> DataFrame:
    """One row per document: its id, licence and dice of the best match (null if
    there is none), licences (all that match, sorted) and n_matches (units that
    match some template, and best runs for templates that no unit matches)."""
    spark = docs.sparkSession
    known = templates(spark, threshold, fixed)
    # the template table is fixed: two numbers
    least, most = known.agg(F.min("least"), F.max("most")).first()
    rows = docs.select(quoted(id_col).alias("id"), F.xxhash64(quoted(id_col), quoted(text_col)).alias("doc_key"),
                       F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    none = F.array().cast("array<array<string>>")

    def units(lines):
        blocks = F.when(F.col("text").rlike("\\n[ \\t\\r]*\\n"),
                        F.transform(F.split("text", "\\n[ \\t\\r]*\\n"), item_words)).otherwise(none)
        # a text of more distinct words than a match can have bigrams is no unit
        whole = let(F.flatten(lines), lambda w: F.when(F.size(F.array_distinct(w)) - 1 <= most, F.array(w)).otherwise(none))
        return F.array_distinct(F.concat(lines, blocks, whole))

    unit_grams = let(F.transform(F.split("text", "\\n"), item_words), lambda lines: F.filter(
        F.transform(let(units(lines), lambda u: F.filter(u, lambda w: F.size(w) > least)), _bigrams),
        lambda g: (F.size(g) >= least) & (F.size(g) <= most)))
    grams = (rows.select("doc_key", F.posexplode(unit_grams).alias("unit", "grams"))
             .select("doc_key", "unit", F.size("grams").alias("n"), F.explode("grams").alias("gram")))
    matches = (grams.join(F.broadcast(known), "gram")  # fixed size
               .where("n between least and most")
               .groupBy("doc_key", "unit", "n", "template", "licence", "size").agg(F.count("*").alias("both"))
               .withColumn("dice", 2 * F.col("both") / (F.col("n") + F.col("size")))
               .where(F.col("dice") >= threshold))
    runs = best_runs(rows, known, threshold)
    either = (matches.select("doc_key", "unit", "template", "licence", "dice", F.lit(None).cast(runs.schema["run"].dataType).alias("run"))
              .unionByName(runs.withColumn("unit", F.lit(None).cast("int"))))
    best = (either.groupBy("doc_key").agg(
        F.min(F.struct((-F.col("dice")).alias("dice"), "licence")).alias("best"),
        F.sort_array(F.collect_set("licence")).alias("licences"), F.collect_set("unit").alias("units"),
        F.collect_set(F.when(F.col("unit").isNotNull(), F.col("template"))).alias("by_unit"),
        F.collect_set(F.when(F.col("unit").isNull(), F.struct("template", "run"))).alias("runs"))
        .withColumn("more", F.filter("runs", lambda r: ~F.array_contains("by_unit", r["template"])))
        .withColumn("n_matches", F.size("units") + F.size(F.array_distinct(F.col("more.run")))))
    return (rows.select("id", "doc_key").join(best, "doc_key", "left")
            .select(F.col("id").alias(id_col), F.col("best.licence").alias("licence"), (-F.col("best.dice")).alias("dice"),
                    F.coalesce("licences", F.array().cast("array<string>")).alias("licences"),
                    F.coalesce("n_matches", F.lit(0)).cast("long").alias("n_matches")))
