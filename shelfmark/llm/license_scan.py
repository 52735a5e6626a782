"""Licence scans by Dice coefficient over word bigrams, in DataFrame functions only.

A text is compared with the templates line by line, paragraph by paragraph, as a whole and in windows of words, each lower-cased with all but letters and digits
turned into spaces. The Dice coefficient of two sets of bigrams of sizes a and b is at most 2 min(a, b) / (a + b), so it reaches t only for sizes
within t / (2 - t) and (2 - t) / t of each other, and only with t / (2 - t) of the template's bigrams in common. Each text is split into words once; all parts of a text hold
bigrams of that text only, so texts without that many of any template's bigrams are passed over before they are cut into parts. The templates are a fixed list of a few
kilobytes and are broadcast.

Notices that fill no line or paragraph are found in windows of words, across lines and paragraphs: from each place of a template's bigram up to
(2 - t) / t times the template's length, ending where the Dice coefficient is highest. Of overlapping windows the one with most bigrams of its template stays. A window inside a segment that matches its template is the
same find and isn't counted again, but may raise the coefficient. `OP3_SQL` has the segments only.

Long licences (Apache, GPL, LGPL, MPL) are known by the head of their text and by their notices.

Defined results: null and empty texts match nothing. Equal segments of a text count once, and so do equal windows. Rows that repeat a doc_id are scanned each by its own text;
rows with the same doc_id and text give one result. Texts of any length are scanned whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store, table, text_of

SIMILAR = 0.8

# Licence notices and short licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("Proprietary", "All rights reserved."),
)


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}]+", " "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def _pairs(words: Column) -> Column:
    """Hashes of all pairs of neighbouring words, in text order."""
    pairs = lambda w: F.when(F.size(w) > 1, F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(F.slice(w, i, 2))))
    return F.coalesce(F.transform(F.array(words), pairs)[0], F.array().cast("array<bigint>"))


def _bigrams(words: Column) -> Column:
    return F.array_distinct(_pairs(words))


def templates(spark: SparkSession) -> DataFrame:
    """license_id, template, size, bigrams of each template."""
    rows = spark.createDataFrame([(name, i, text) for i, (name, text) in enumerate(TEMPLATES)], "license_id string, template int, text string")
    return rows.select("license_id", "template", _bigrams(_words(F.col("text"))).alias("bigrams")).withColumn("size", F.size("bigrams"))


def segments(text: Column) -> Column:
    """Lines, paragraphs and the whole of a text, each once."""
    lines, paragraphs = F.split(text, "[\\r\\n]+"), F.split(text, "\\r?\\n(?:[ \\t]*\\r?\\n)+")
    return F.array_distinct(F.concat(lines, paragraphs, F.array(text)))


def _apart(found: Column) -> Column:
    """Of windows in order of preference those that overlap no window before them that stays."""
    none = F.filter(found, lambda w: F.lit(False))
    meets = lambda kept, w: F.exists(kept, lambda k: (k["begin"] <= w["end"]) & (w["begin"] <= k["end"]))
    return F.aggregate(found, none, lambda kept, w: F.when(meets(kept, w), kept).otherwise(F.concat(kept, F.array(w))))


def _fixed(spark: SparkSession, similar: float) -> tuple[Column, str]:
    """The templates as an array of structs, and all their bigrams as a list of SQL literals."""
    low, high = similar / (2 - similar), (2 - similar) / similar
    fixed = spark.createDataFrame([(name, i, text) for i, (name, text) in enumerate(TEMPLATES)], "license_id string, template int, text string")
    fixed = fixed.select("license_id", "template", _pairs(_words(F.col("text"))).alias("grams")).collect()
    longs = lambda xs: ", ".join(f"CAST({x} AS BIGINT)" for x in xs)
    each = []
    for t in fixed:
        grams = sorted(set(t["grams"]))
        need, span = ceil(low * len(grams) - 1e-9), int(high * len(t["grams"]) + 1e-9)
        each.append(f"named_struct('license_id', '{t['license_id']}', 'template', {t['template']}, 'b', {len(grams)}, 'need', {need}, 'span', {span}, 'grams', array({longs(grams)}))")
    return F.expr(f"array({', '.join(each)})"), longs(sorted({g for t in fixed for g in t["grams"]}))


def held(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, row, text, all (its bigrams in order), hits (places of template bigrams) of the texts that have enough of some template's bigrams."""
    known, any_gram = _fixed(docs.sparkSession, similar)
    text = text_of()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text"), _pairs(_words(text)).alias("all"))
    rows = rows.withColumn("hits", F.expr(f"filter(transform(all, (g, i) -> struct(i + 1 AS at, g AS gram)), x -> x.gram IN ({any_gram}))")).filter(F.size("hits") > 0)
    enough = lambda own: F.exists(known, lambda t: F.size(F.array_intersect(own, t["grams"])) >= t["need"])
    rows = rows.filter(F.transform(F.array(F.array_distinct(F.col("hits.gram"))), enough)[0])
    return store(rows.dropDuplicates(["doc_id", "row"]), "licence-texts")


def windows(rows: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, row, license_id, dice, covered (by a segment that matches): the windows like a template of each of the texts that `held` gives."""
    known, _ = _fixed(rows.sparkSession, similar)
    has = lambda own: F.filter(known, lambda t: F.size(F.array_intersect(own, t["grams"])) >= t["need"])
    rows = rows.select("*", F.explode(F.transform(F.array(F.array_distinct(F.col("hits.gram"))), has)[0]).alias("t"))
    at = F.transform(F.filter("hits", lambda x: F.array_contains(F.col("t.grams"), x["gram"])), lambda x: x["at"])
    rows = rows.select("doc_id", "row", "text", "all", "t", at.alias("at"))
    ends = F.col("at"), F.col("t.need") - 1
    starts = F.filter(ends[0], lambda p, i: F.coalesce(F.get("at", i + ends[1]) - p < F.col("t.span"), F.lit(False)))

    # The m-th of a template's bigrams that stands at place j of a window's distinct ones ends a window of j distinct bigrams with m in common.
    def best(p: Column) -> Column:
        own = F.array_distinct(F.slice("all", p, F.col("t.span")))
        own = F.filter(F.transform(own, lambda g, j: F.struct((j + 1).alias("j"), g.alias("g"))), lambda x: F.array_contains(F.col("t.grams"), x["g"]))
        score = F.transform(own, lambda x, m: F.struct((F.lit(2.0) * (m + 1) / (x["j"] + F.col("t.b"))).alias("dice"), (m + 1).alias("common"), x["g"].alias("last")))
        top = lambda x: F.struct(x["dice"].alias("dice"), x["common"].alias("common"), p.alias("begin"), (p - 1 + F.array_position(F.slice("all", p, F.col("t.span")), x["last"]).cast("int")).alias("end"))
        return F.transform(F.array(F.array_max(score)), top)[0]

    rows = rows.withColumn("found", F.filter(F.transform(starts, best), lambda w: w["dice"] >= similar - 1e-9))
    like = lambda s: 2 * F.size(F.array_intersect(s, F.col("t.grams"))) / (F.size(s) + F.col("t.b")) >= similar - 1e-9
    match = F.when(F.size("found") > 0, F.filter(F.transform(segments(F.col("text")), lambda s: _bigrams(_words(s))), like))
    rows = rows.select("doc_id", "row", "all", "t", "found", match.alias("match"))
    grams = lambda w: F.slice("all", w["begin"], w["end"] - w["begin"] + 1)
    whole = lambda w: F.exists("match", lambda s: F.size(F.array_except(grams(w), s)) == 0)
    told = F.transform("found", lambda w: F.struct((-w["dice"]).alias("less"), w["begin"].alias("begin"), w["end"].alias("end"), w["common"].alias("common"), F.xxhash64(grams(w)).alias("key"), whole(w).alias("covered")))
    rows = rows.select("doc_id", "row", F.col("t.license_id").alias("license_id"), F.col("t.template").alias("template"), F.inline(told))
    # Equal windows once, then apart from each other for each template, then for each text.
    rows = rows.groupBy("doc_id", "row", "license_id", "template", "key").agg(F.min(F.struct("less", "begin", "end", "common", "covered")).alias("w"))
    rows = rows.groupBy("doc_id", "row", "license_id", "template").agg(_apart(F.sort_array(F.collect_list("w"))).alias("w")).select("doc_id", "row", "license_id", F.inline("w"))
    one = F.struct((-F.col("common")).alias("fewer"), "less", "license_id", "begin", "end", "covered")
    rows = rows.groupBy("doc_id", "row").agg(_apart(F.sort_array(F.collect_list(one))).alias("w")).select("doc_id", "row", F.inline("w"))
    return rows.select("doc_id", "row", "license_id", (-F.col("less")).alias("dice"), "covered")


def licensed(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, license_id, n_segments, dice (of the best segment): one row for each text and licence it holds."""
    spark = docs.sparkSession
    known = templates(spark)
    # Two bigrams at most for each word, so sizes bound the number of words too.
    least, most = known.agg(F.min("size"), F.max("size")).first()
    low, high = similar / (2 - similar), (2 - similar) / similar
    texts = held(docs, similar)
    rows = texts.select("doc_id", "row", F.explode(segments(F.col("text"))).alias("segment"))
    # A segment of n characters has n / 2 bigrams at most; long ones may repeat words, so only the bigrams themselves bound those from above.
    rows = rows.filter(F.length("segment") >= 2 * least * low)
    rows = rows.withColumn("segment_id", F.xxhash64("segment")).select("doc_id", "row", "segment_id", _bigrams(_words(F.col("segment"))).alias("bigrams"))
    rows = rows.withColumn("a", F.size("bigrams")).filter((F.col("a") >= low * least - 1e-9) & (F.col("a") <= high * most + 1e-9))
    rows = rows.select("doc_id", "row", "segment_id", "a", F.explode("bigrams").alias("bigram"))
    grams = known.select("license_id", "template", F.col("size").alias("b"), F.explode("bigrams").alias("bigram"))
    bounds = (F.col("a") >= F.col("b") * low - 1e-9) & (F.col("a") <= F.col("b") * high + 1e-9)
    common = rows.join(F.broadcast(grams), "bigram").filter(bounds)
    common = common.groupBy("doc_id", "row", "segment_id", "license_id", "template").agg((2 * F.count(F.lit(1)) / F.first(F.col("a") + F.col("b"))).alias("dice"))
    # The likest licence of each segment; of equally like ones the first by name.
    best = common.filter(F.col("dice") >= similar - 1e-9).groupBy("doc_id", "row", "segment_id").agg(F.min(F.struct((-F.col("dice")).alias("less"), "license_id")).alias("best"))
    best = best.groupBy("doc_id", "row", F.col("best.license_id").alias("license_id"))
    best = best.agg(F.count(F.lit(1)).alias("n_segments"), (-F.min("best.less")).alias("dice"))
    more = windows(texts, similar).groupBy("doc_id", "row", "license_id").agg(F.count_if(~F.col("covered")).alias("n_segments"), F.max("dice").alias("dice"))
    both = best.unionByName(more).groupBy("doc_id", "row", "license_id").agg(F.sum("n_segments").alias("n_segments"), F.max("dice").alias("dice"))
    return both.filter("n_segments > 0").drop("row")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licensed(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license_id", "n_segments", F.floor(F.col("dice") * 1e6 + 0.5).cast("long").alias("dice_millionths"))


_VALUES = ", ".join("('{}', {}, '{}')".format(name, i, text.replace("'", "''")) for i, (name, text) in enumerate(TEMPLATES))
_WORDS = "list_filter(string_split(trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda w: w <> '')"
_PAIRS = "list_distinct(list_transform(generate_series(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1]))"
OP3_SQL = f"""
WITH t AS (SELECT column0 AS license_id, column1 AS template, {_WORDS.format('column2')} AS w FROM (VALUES {_VALUES}) AS v(column0, column1, column2)),
tb AS (SELECT license_id, template, {_PAIRS} AS g FROM t),
tg AS (SELECT license_id, template, len(g) AS b, unnest(g) AS g FROM tb),
s AS (SELECT DISTINCT doc_id, md5(text) AS row, list_distinct(list_concat(regexp_split_to_array(text, '[\\r\\n]+'), regexp_split_to_array(text, '\\r?\\n(?:[ \\t]*\\r?\\n)+'), [text])) AS s FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, row, unnest(s) AS seg FROM s),
w AS (SELECT doc_id, row, seg, {_WORDS.format('seg')} AS w FROM u),
p AS (SELECT doc_id, row, seg, {_PAIRS} AS g FROM w WHERE len(w) > 1),
pg AS (SELECT doc_id, row, seg, len(g) AS a, unnest(g) AS g FROM p),
c AS (SELECT doc_id, row, seg, license_id, template, 2.0 * count(*) / (max(a) + max(b)) AS dice FROM pg JOIN tg USING (g) GROUP BY ALL),
m AS (SELECT doc_id, row, seg, license_id, dice, row_number() OVER (PARTITION BY doc_id, row, seg ORDER BY dice DESC, license_id) AS place FROM c WHERE dice >= 0.8 - 1e-9)
SELECT doc_id, license_id, count(*) AS n_segments, CAST(floor(max(dice) * 1e6 + 0.5) AS BIGINT) AS dice_millionths FROM m WHERE place = 1 GROUP BY doc_id, row, license_id
"""
