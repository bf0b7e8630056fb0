"""License scans: Dice coefficient of word bigrams against license templates, in DataFrame functions only.

Units of a text are the whole text, its paragraphs (ended by a line without letters or digits, so
those of a comment block too), its lines and its sentences; equal units of a text are one. A notice
that is wrapped over lines is found as a paragraph or a sentence, one inside a line as a sentence, a
full license inside a longer text by the paragraphs that it has as templates. A unit is compared only
with templates whose number of bigrams lies in the range in which the threshold can be reached; units
that fit no template are dropped before their bigrams are laid out. A unit that reaches the threshold
lacks few of a template's bigrams, so it has one of any words that make up more of them: texts and
units without such a word are dropped first. The remaining bigrams meet the templates' through a hash
join; what is shared is counted for each unit and template.

Nulls: a null text has no units and matches nothing; a null template, or one of fewer than two words,
matches nothing. Equal texts share one comparison; equal rows get equal results. Empty tables give
empty results.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import row_of, text_key

# Common notices and licenses, in their usual wording.
MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
    "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution."
)
BSD_THREE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_REST = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_REST = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO '
    "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n'
    "http://www.apache.org/licenses/LICENSE-2.0\n\n"
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY '
    "KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
)
GPL_HEADER = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version."
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
    "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.", APACHE_HEADER],
    "BSD": [BSD_GRANT, f"{BSD_GRANT}\n\n{BSD_TWO}\n\n{BSD_REST}", f"{BSD_GRANT}\n\n{BSD_TWO}\n\n{BSD_THREE}\n\n{BSD_REST}"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", GPL_HEADER],
    "ISC": [ISC_GRANT, f"{ISC_GRANT}\n\n{ISC_REST}"],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", MIT_GRANT, f"{MIT_GRANT}\n\n{MIT_REST}"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved."],
    "public-domain": ["This is free and unencumbered software released into the public domain.", UNLICENSE],
}
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: A line without letters or digits, which ends a paragraph; what ends a sentence.
PARAGRAPH = "\\n[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*\\n"
SENTENCE = "[.!?][ \\n\\t\\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_BIGRAMS = 100_000
MOST_ANCHORS = 200


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, t) for k, texts in TEMPLATES.items() for t in texts], "license string, text string")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def bigrams(found: Column) -> Column:
    """The distinct pairs of neighbours, hashed."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(found) - 1), lambda i: F.xxhash64(F.element_at(found, i), F.element_at(found, i + 1)))
    return F.when(F.size(found) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<bigint>"))


def anchors(texts: list[str | None], threshold: float) -> set[str] | None:
    """Words of which every unit that reaches ``threshold`` with one of ``texts`` has one: the bigrams
    with one of them are more than such a unit can lack. ASCII words only, as these look the same
    after any lower-casing; those of six letters and more in many bigrams come first, and of these (and of
    shorter ones) those that are rarer as a part of the texts' words. None: a text can't be covered in this way."""
    chosen: set[str] = set()
    everything = " ".join(text or "" for text in texts).lower()
    for text in texts:
        found = re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").translate(str.maketrans(UPPER, LOWER)))
        pairs = set(zip(found, found[1:]))
        if not pairs:
            continue
        lacking = len(pairs) - math.ceil(len(pairs) * threshold / (2 - threshold) - 1e-9)
        covered = {p for p in pairs if chosen & set(p)}
        of = {w: {p for p in pairs if w in p} for w in set(found) if w.isascii()}
        for word in sorted(of, key=lambda w: (len(w) < 6, -len(of[w]), everything.count(w), -len(w), w)):
            if len(covered) > lacking:
                break
            if of[word] - covered:
                chosen.add(word)
                covered |= of[word]
        if len(covered) <= lacking:
            return None
    return chosen


def has_any(low: Column, words: set[str]) -> Column:
    return reduce(lambda a, b: a | b, [low.contains(w) for w in sorted(words)])


def with_words(rows: DataFrame, text: Column, words: set[str] | None) -> DataFrame:
    """``rows`` whose text has one of the words; it is lower-cased once, in a column that Catalyst doesn't fold into each test."""
    if words is None:
        return rows
    return rows.withColumn("_low", F.explode(F.array(F.lower(text)))).filter(has_any(F.col("_low"), words)).drop("_low")


def units(content: Column) -> Column:
    """The distinct units of a text."""
    return F.array_distinct(F.concat(F.array(content), F.split(content, PARAGRAPH, -1), F.split(content, "\n", -1), F.split(content, SENTENCE, -1)))


def matches(docs: DataFrame, licenses: DataFrame, *, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """text_id (md5 of the text), unit (its number), license and dice of all comparisons that reach
    ``threshold``. ``licenses``: license, text. Their bigrams, which are broadcast, may be
    ``MOST_BIGRAMS`` at most; more are joined by a shuffle. Texts without any of up to
    ``MOST_ANCHORS`` anchor words are left out before; with more such words none are."""
    known = licenses.select("license", F.md5("text").alias("template"), F.explode(F.array(bigrams(words(F.col("text"))))).alias("pairs")).withColumn("t", F.size("pairs")).filter("t > 0")
    low = F.ceil(F.col("t") * F.lit(threshold / (2 - threshold)) - 1e-9)
    high = F.floor(F.col("t") * F.lit((2 - threshold) / threshold) + 1e-9)
    known = known.withColumns({"low": low, "high": high})
    sums = known.agg(F.min("low"), F.max("high"), F.sum("t")).first()
    if not sums[2]:
        return docs.limit(0).select(F.lit("").alias("text_id"), F.lit(0).alias("unit"), F.lit("").alias("license"), F.lit(0.0).alias("dice"))
    least, most = sums[0], sums[1]
    few = sums[2] <= MOST_BIGRAMS
    marks = anchors([r["text"] for r in licenses.select("text").sort(F.length("text"), "text").collect()], threshold) if few else None
    marks = marks if marks and len(marks) <= MOST_ANCHORS else None
    texts = with_words(docs.select(F.col(text).alias("_text")), F.col("_text"), marks)
    texts = texts.groupBy(text_key(F.col("_text")).alias("text_id")).agg(F.first("_text").alias("_text"))  # copies are one before anything is cut
    parts = texts.select("text_id", F.posexplode(units(F.col("_text"))).alias("unit", "part"))
    parts = with_words(parts, F.col("part"), marks)
    found = parts.withColumn("found", words(F.col("part"))).filter(F.size("found") > F.lit(least)).select("text_id", "unit", F.explode(F.array(bigrams(F.col("found")))).alias("pairs"))
    found = found.withColumn("u", F.size("pairs")).filter(F.col("u").between(least, most))
    index = known.select("license", "template", "t", "low", "high", F.explode("pairs").alias("pair"))
    index = F.broadcast(index) if few else index
    met = found.select("text_id", "unit", "u", F.explode("pairs").alias("pair")).join(index, "pair").filter(F.col("u").between(F.col("low"), F.col("high")))
    shared = met.groupBy("text_id", "unit", "license", "template", "u", "t").agg(F.count_distinct("pair").alias("shared"))
    dice = 2 * F.col("shared") / (F.col("u") + F.col("t"))
    return shared.withColumn("dice", dice).filter(F.col("dice") >= threshold).groupBy("text_id", "unit", "license").agg(F.max("dice").alias("dice"))


def scan(docs: DataFrame, licenses: DataFrame, *, text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` without its text, with n_matches (units and licenses), licenses (sorted) and best_dice."""
    found = matches(docs, licenses, text=text, threshold=threshold)
    found = found.groupBy("text_id").agg(F.count("*").alias("n_matches"), F.array_sort(F.collect_set("license")).alias("licenses"), F.max("dice").alias("best_dice"))
    keyed = docs.select(row_of(docs, text, "n_matches", "licenses", "best_dice"), text_key(F.col(text)).alias("key"))
    joined = keyed.join(found, F.col("key") == F.col("text_id"), "left")
    return joined.select("row.*", F.coalesce("n_matches", F.lit(0)).alias("n_matches"), F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"), "best_dice")


def _sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(k)}, {quoted(t)})" for k, texts in TEMPLATES.items() for t in texts)
    pairs = "list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))"
    return f"""
WITH t0(license, text) AS (VALUES {rows}),
t1 AS (SELECT license, text, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM t0),
t AS (SELECT license, text, {pairs} AS p FROM t1 WHERE len(ws) > 1),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
l0 AS (SELECT rid, text AS part FROM d WHERE text IS NOT NULL UNION SELECT rid, unnest(string_split(text, chr(10))) FROM d
  UNION SELECT rid, unnest(string_split_regex(text, '{PARAGRAPH}')) FROM d UNION SELECT rid, unnest(string_split_regex(text, '{SENTENCE}')) FROM d),
l1 AS (SELECT rid, row_number() OVER () AS unit, regexp_extract_all(translate(part, '{UPPER}', '{LOWER}'), '{WORD}') AS ws FROM l0),
l AS (SELECT rid, unit, {pairs} AS p FROM l1 WHERE len(ws) > 1),
up AS (SELECT rid, unit, len(p) AS u, unnest(p) AS g FROM l),
tp AS (SELECT license, text, len(p) AS t, unnest(p) AS g FROM t),
m AS (SELECT rid, unit, license, max(dice) AS dice FROM (SELECT rid, unit, license, 2 * count(*) / (u + t)::double AS dice FROM up JOIN tp USING (g) GROUP BY rid, unit, license, text, u, t) WHERE dice >= 0.8::double GROUP BY ALL),
a AS (SELECT rid, count(*) AS n, array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses, max(dice) AS best FROM m GROUP BY rid)
SELECT doc_id, coalesce(n, 0)::bigint AS n_matches, coalesce(licenses, '') AS licenses, round(best, 6) AS best_dice FROM d LEFT JOIN a ON d.rid = a.rid
"""


SQL = _sql()
