"""Licence notices in documents: phrases, and an exact set-similarity join with templates.

Every template has text blocks of its own length: runs of twice its words, ``BLOCK`` at least, that start
at every half of that, so that every wording lies wholly in some block and other templates make no difference. A block
matches a template if it holds at least ``THRESHOLD`` of the template's distinct words. All
matching blocks are found, by the filters of a set-similarity join:

* words are ordered by their frequency in the corpus, rarest first (ties by the word itself);
* prefix: a match holds one of the first n - need + 1 words of the template in that order, where
  need is the number of words that make up the threshold. Only these words look up blocks;
* length: a block needs that many distinct words;
* position: at the first shared word, the words that follow on both sides must suffice. Words
  of no template can't be shared and are left out of the block's order.

What is left is counted in full. Frequencies are counted over all documents, for the words of
the templates. Templates are a parameter; their words make up the only broadcast table, some
hundreds of rows at most. Everything is DataFrame functions.

Null text counts as empty: no words, no labels, score 0. Equal rows get equal results. An empty
table gives an empty result. Texts of any length are taken whole, and blocks reach to their end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.llm.common import row_key

# Phrases of the contract and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wordings of public licences, in lower-case words.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("proprietary", "all rights reserved"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
        "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the software the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders "
        "be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
        "connection with the software or the use or other dealings in the software",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the "
        "above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all "
        "warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author "
        "be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or "
        "profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or "
        "performance of this software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
        "are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution this software is provided by the copyright holders and "
        "contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct "
        "indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or "
        "services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract "
        "strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the "
        "possibility of such damage",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may "
        "obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing "
        "software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express "
        "or implied see the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published "
        "by the free software foundation either version 3 of the license or at your option any later version this program is distributed in "
        "the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a "
        "particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public "
        "license along with this program",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages "
        "arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial "
        "applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must not "
        "be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in "
        "the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must "
        "not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution",
    ),
]
BLOCK, THRESHOLD = 64, 0.8


def step_of(wording: str) -> int:
    """Words from one block of a template to the next; a block is twice as long."""
    return max(BLOCK // 2, len(wording.split()))


def words_of(text: Column) -> Column:
    """Words of a text. Lower case beyond A-Z makes no difference to the words' number or to any phrase."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def _places(words: Column) -> Column:
    """(place, label) of every phrase."""

    def starts(i: Column) -> Column:
        label = F.lit(None).cast("string")
        for phrase, name in PHRASES.items():
            here = F.lit(True)
            for k, word in enumerate(phrase.split()):
                here = here & F.coalesce(F.get(words, i + k) == word, F.lit(False))
            label = F.when(here, F.lit(name)).otherwise(label)
        return F.struct(i.alias("place"), label.alias("label"))

    last = sorted({p.split()[-1] for p in PHRASES})
    some = F.arrays_overlap(words, F.array(*[F.lit(w) for w in last]))
    found = F.filter(F.transform(F.sequence(F.lit(0), F.size(words) - 1), starts), lambda x: x["label"].isNotNull())
    return F.when(some, found).otherwise(F.array().cast("array<struct<place:int,label:string>>"))


def frequency_order(rows: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words, rarest in the corpus first."""
    words = rows.select(F.explode("words").alias("word")).filter(F.col("word").isin(vocabulary))
    counts = {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}  # at most the templates' words
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def matches(rows: DataFrame, templates: list[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, row, template, label, block, score) of every block that meets the threshold, for rows (doc_id, row, words)."""
    spark = rows.sparkSession
    sets = [(label, set(text.split()), step_of(text)) for label, text in templates]
    order = frequency_order(rows, sorted(set().union(*[s for _, s, _ in sets])))
    rank = {w: i for i, w in enumerate(order)}
    index = []
    for number, (label, tokens, step) in enumerate(sets):
        listed = sorted(tokens, key=rank.__getitem__)
        need = next(k for k in range(1, len(listed) + 1) if k / len(listed) >= threshold)
        index += [(number, label, listed, need, p, listed[p], step) for p in range(len(listed) - need + 1)]
    prefixes = spark.createDataFrame(index, "template int, label string, listed array<string>, need int, p int, word string, step int")
    steps = spark.createDataFrame(sorted({(i[5], i[6]) for i in index}), "word string, step int")
    known = F.array(*[F.lit(w) for w in order])

    hits = rows.select("doc_id", "row", "words", F.posexplode("words").alias("at", "word")).filter(F.col("word").isin(sorted({i[5] for i in index})))
    # Both broadcast tables have as many rows as the templates' prefixes have words. Templates of one length share their blocks.
    sided = hits.join(F.broadcast(steps), "word")
    block = F.floor(F.col("at") / F.col("step")).cast("int")
    opened = sided.withColumn("block", F.explode(F.array(block, block - 1))).filter("block >= 0")
    sized = opened.withColumn("tokens", F.array_distinct(F.slice("words", F.col("block") * F.col("step") + 1, 2 * F.col("step")))).drop("words")
    pairs = sized.join(F.broadcast(prefixes), ["word", "step"]).filter(F.size("tokens") >= F.col("need"))
    shared = pairs.withColumn("first", F.get(F.array_intersect("listed", "tokens"), F.lit(0))).filter(F.col("first") == F.col("word"))
    ordered = shared.withColumn("ordered", F.array_intersect(known, "tokens"))
    room = 1 + F.least(F.size("listed") - 1 - F.col("p"), F.size("ordered") - F.array_position("ordered", F.col("word")).cast("int"))
    possible = ordered.filter(room >= F.col("need"))
    score = F.size(F.array_intersect("listed", "ordered")) / F.size("listed")
    return possible.withColumn("score", score).filter(F.col("score") >= threshold).select("doc_id", "row", "template", "label", "block", "score")


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per document with its phrases, labels and score."""
    rows = docs.select("doc_id", row_key("text").alias("row"), words_of(F.col("text")).alias("words"))
    found = matches(rows, templates).groupBy("doc_id", "row").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    found = found.withColumnsRenamed({"doc_id": "found_id", "row": "found_row"})
    base = rows.select("doc_id", "row", F.size("words").cast("bigint").alias("n_words"), _places(F.col("words")).alias("places"))
    joined = base.join(found, F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("row") == F.col("found_row")), "left")
    own = F.array_distinct(F.col("places.label"))
    more = F.coalesce("more", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places.place").cast("bigint").alias("first_word"),
        F.array_max("places.place").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, more)), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    listed = ", ".join(f"('{label}', string_split('{text}', ' '), {step_of(text)})" for label, text in TEMPLATES)
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM u WHERE "
        + " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
        for phrase, label in PHRASES.items()
    )
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), u AS (
  SELECT doc_id, words, generate_subscripts(words, 1) AS i FROM w
), p AS (
  {phrases}
), base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS own FROM p GROUP BY doc_id
), t AS (
  SELECT label, list_distinct(tokens) AS tokens, step FROM (VALUES {listed}) AS v(label, tokens, step)
), b AS (
  SELECT doc_id, step, words[s + 1 : s + 2 * step] AS block
  FROM (SELECT doc_id, words, step, unnest(range(0, len(words), step)) AS s FROM w, (SELECT DISTINCT step FROM t))
), m AS (
  SELECT doc_id, label, len(list_intersect(tokens, block)) / len(tokens) AS score FROM b JOIN t USING (step)
  WHERE len(list_intersect(tokens, block)) / len(tokens) >= {THRESHOLD}
), best AS (
  SELECT doc_id, max(score) AS score, list(DISTINCT label) AS more FROM m GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(own, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
"""


SQL = _sql()
