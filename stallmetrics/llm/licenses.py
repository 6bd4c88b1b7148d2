"""License scans by diagonal voting, in DataFrame operations only.

The rolling word k-grams of a text (k is 2 for base phrases, 3 for notices) are hashed and joined
with those of the templates. A match at word i of the text and j of a template votes for the
diagonal i - j. A base phrase counts where one diagonal has all its votes. For a notice, votes
that follow each other on a diagonal make a run, and runs whose diagonals are near each other
(words were put in or left out between them) are merged to a span. The span is verified: its runs
must follow each other in the text and in the template alike, the template's k-grams that they
cover must be the share ``SHARE`` of all or more, and the span may be ``STRETCH`` times as long
as the template. Among the ways to put runs together the one that covers most counts. K-grams
are compared by 64-bit hashes: over 10^13 words less than one false match is to be expected.

Templates may be given as tables (label, text). They are broadcast up to ``BROADCAST_GRAMS``
k-grams and joined by a shuffle beyond that. Phrases of one word and notices of fewer than three
have no k-grams and are never found; null labels or texts are left out. Only matches and one row
per text leave a task, and before spans are built, notices of which a text does not hold enough
different k-grams are dropped. Null or empty text: no words, no labels, score 0. Repeated rows
are scanned one by one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words of a k-gram, for phrases and for notices.
PHRASE_WORDS = 2
NOTICE_WORDS = 3
SHARE = 0.6
STRETCH = 1.5
#: Templates with more k-grams are not broadcast (a k-gram takes some 60 bytes).
BROADCAST_GRAMS = 500_000
#: Values over which the rows that stand for the texts themselves are spread in the join.
MARKS = 64

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Wording of common notices.
NOTICES = {
    "mit": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
           "documentation files the software to deal in the software without restriction",
    "apache-2.0": "licensed under the apache license version 2 0 the license you may not use this file except in "
                  "compliance with the license you may obtain a copy of the license at",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                  "general public license as published by the free software foundation",
    "mpl-2.0": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-notice": "this work is licensed under a creative commons attribution",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "no-warranty": "the software is provided as is without warranty of any kind express or implied",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                "documentation files the software to deal in the software without restriction including without limitation the "
                "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
                "persons to whom the software is furnished to do so subject to the following conditions the above copyright "
                "notice and this permission notice shall be included in all copies or substantial portions of the software the "
                "software is provided as is without warranty of any kind express or implied including but not limited to the "
                "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the "
                "authors or copyright holders be liable for any claim damages or other liability whether in an action of "
                "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings "
                "in the software",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted provided that the "
                "following conditions are met 1 redistributions of source code must retain the above copyright notice this list "
                "of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
                "notice this list of conditions and the following disclaimer in the documentation and or other materials "
                "provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors "
                "may be used to endorse or promote products derived from this software without specific prior written "
                "permission this software is provided by the copyright holders and contributors as is and any express or "
                "implied warranties including but not limited to the implied warranties of merchantability and fitness for a "
                "particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any "
                "direct indirect incidental special exemplary or consequential damages including but not limited to procurement "
                "of substitute goods or services loss of use data or profits or business interruption however caused and on any "
                "theory of liability whether in contract strict liability or tort including negligence or otherwise arising in "
                "any way out of the use of this software even if advised of the possibility of such damage",
    "isc-text": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
                "granted provided that the above copyright notice and this permission notice appear in all copies the software "
                "is provided as is and the author disclaims all warranties with regard to this software including all implied "
                "warranties of merchantability and fitness in no event shall the author be liable for any special direct "
                "indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether "
                "in an action of contract negligence or other tortious action arising out of or in connection with the use or "
                "performance of this software",
    "zlib-text": "this software is provided as is without any express or implied warranty in no event will the authors be held "
                 "liable for any damages arising from the use of this software permission is granted to anyone to use this "
                 "software for any purpose including commercial applications and to alter it and redistribute it freely subject "
                 "to the following restrictions 1 the origin of this software must not be misrepresented you must not claim "
                 "that you wrote the original software if you use this software in a product an acknowledgment in the product "
                 "documentation would be appreciated but is not required 2 altered source versions must be plainly marked as "
                 "such and must not be misrepresented as being the original software 3 this notice may not be removed or "
                 "altered from any source distribution",
    "apache-2.0-text": "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                       "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
                       "required by applicable law or agreed to in writing software distributed under the license is distributed "
                       "on an as is basis without warranties or conditions of any kind either express or implied see the license "
                       "for the specific language governing permissions and limitations under the license",
    "gpl-text": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
                "license as published by the free software foundation either version 3 of the license or at your option any "
                "later version this program is distributed in the hope that it will be useful but without any warranty without "
                "even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public "
                "license for more details you should have received a copy of the gnu general public license along with this "
                "program if not see http www gnu org licenses",
    "unlicense-text": "this is free and unencumbered software released into the public domain anyone is free to copy modify "
                      "publish use compile sell or distribute this software either in source code form or as a compiled binary "
                      "for any purpose commercial or non commercial and by any means",
}
# End of fixed values.


def words_of(text: Column) -> Column:
    """Words of the text with A-Z in lower case. Of other letters only the Kelvin sign would become one of a-z."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def as_table(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """A table (label, text) of the given pairs."""
    rows = json.dumps([{"label": label, "text": text} for label, text in texts])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<label:string,text:string>>")))


def grams_of(words: str, k: int) -> Column:
    """Hashes of the k-grams of a column of words, in order; empty for fewer than k words."""
    grams = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*(F.get(words, i + n) for n in range(k))))
    return F.when(F.size(words) >= k, grams).otherwise(F.array().cast("array<bigint>"))


def templates(phrases: DataFrame, notices: DataFrame) -> DataFrame:
    """(known, template, label, is_phrase, j, n_grams): the k-grams of each template, and the marks, which have no label."""

    def grams(table: DataFrame, k: int, is_phrase: bool) -> DataFrame:
        named = table.filter("label is not null").select("label", words_of(F.col("text")).alias("words")).distinct()
        cut = named.select("label", F.xxhash64(F.lit(is_phrase), "label", "words").alias("template"), grams_of("words", k).alias("grams"))
        return cut.select("template", "label", F.lit(is_phrase).alias("is_phrase"), F.size("grams").alias("n_grams"),
                          F.posexplode("grams").alias("j", "known"))

    marks = phrases.sparkSession.range(MARKS).select(
        F.lit(0).cast("long").alias("template"), F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("boolean").alias("is_phrase"), F.lit(0).alias("n_grams"), F.lit(0).alias("j"), F.col("id").alias("known"))
    return grams(phrases, PHRASE_WORDS, True).union(grams(notices, NOTICE_WORDS, False)).union(marks)


def _best_span() -> Column:
    """K-grams covered by the best chain of ``near`` runs that begins with the run of the row.

    A run follows another if it comes later in the text and in the template alike.
    """
    chain = lambda high, last, n: F.struct(high.alias("high"), last.alias("last"), n.alias("n"))
    n_words = F.col("n_grams") + NOTICE_WORDS - 1

    def fits(x: Column) -> Column:
        return ((x["high"] - F.col("low") + NOTICE_WORDS <= STRETCH * n_words)
                & (F.abs(x["diagonal"] - F.col("diagonal")) <= (STRETCH - 1) * n_words + NOTICE_WORDS))

    def extended(chains: Column, x: Column) -> Column:
        before = F.filter(chains, lambda y: (y["high"] < x["low"]) & (y["last"] < x["first"]))
        most = F.array_max(F.transform(before, lambda y: y["n"]))
        return F.when(most.isNull(), chains).otherwise(F.concat(chains, F.array(chain(x["high"], x["last"], most + x["n"]))))

    start = F.array(chain(F.col("high"), F.col("last"), F.col("n")))
    return F.array_max(F.transform(F.aggregate(F.filter("near", fits), start, extended), lambda y: y["n"]))


def scan_licenses(docs: DataFrame, phrases: DataFrame | None = None, notices: DataFrame | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of each row.

    ``phrases`` and ``notices`` are tables (label, text); without them, the ones above are taken.
    """
    spark = docs.sparkSession
    given = phrases is not None or notices is not None
    phrases = as_table(spark, [(label, text) for text, label in PHRASES.items()]) if phrases is None else phrases
    known = templates(phrases, as_table(spark, list(NOTICES.items())) if notices is None else notices)
    if not given or known.count() <= BROADCAST_GRAMS:
        known = F.broadcast(known)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words_of(F.col("text")).alias("words"))
    # the first entry stands for the text itself, so that a text without matches keeps a row
    grams = F.concat(F.array(F.pmod("row", F.lit(MARKS))), grams_of("words", PHRASE_WORDS), grams_of("words", NOTICE_WORDS))
    counted = rows.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), grams.alias("grams"))
    exploded = counted.select("doc_id", "row", "n_words", F.posexplode("grams").alias("p", "gram"))
    at = F.when(F.col("is_phrase"), F.col("p") - 1).otherwise(F.col("p") - F.col("n_words")).cast("int")
    votes = exploded.join(known, F.col("gram") == F.col("known")).select(
        "doc_id", "row", "n_words", "template", "label", "is_phrase", "n_grams", "j", at.alias("at"), (at - F.col("j")).alias("diagonal"))

    template = Window.partitionBy("row", "template")
    needed = F.when(F.col("is_phrase"), F.col("n_grams")).otherwise(SHARE * F.col("n_grams"))
    held = votes.repartition("row").withColumn("different", F.size(F.collect_set("j").over(template))).filter(
        F.col("label").isNull() | (F.col("different") >= needed))
    along = Window.partitionBy("row", "template", "diagonal").orderBy("at")
    runs = held.withColumn("run", F.col("at") - F.row_number().over(along)).groupBy(
        "row", "doc_id", "n_words", "template", "label", "is_phrase", "n_grams", "diagonal", "run").agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.min("j").alias("first"), F.max("j").alias("last"), F.count("*").alias("n"))
    # runs that begin within the longest span from here; their number is bounded by the template's length
    run = F.when(~F.col("is_phrase"), F.struct("low", "high", "first", "last", "diagonal", "n"))
    ahead = template.orderBy(F.col("low") / (STRETCH * (F.col("n_grams") + NOTICE_WORDS))).rangeBetween(0, 1)
    spans = runs.withColumn("near", F.array_sort(F.collect_list(run).over(ahead)))
    covered = F.when(F.col("is_phrase"), F.col("n")).when(~F.col("is_phrase"), _best_span())
    spans = spans.withColumn("share", F.when(F.col("n_grams") > 0, covered / F.col("n_grams")))

    place = F.coalesce(F.col("is_phrase") & (F.col("n") == F.col("n_grams")), F.lit(False))
    notice = F.coalesce(~F.col("is_phrase") & (F.col("share") >= SHARE), F.lit(False))
    start = F.when(place, F.col("diagonal").cast("long"))
    named = lambda hit: F.array_join(F.array_sort(F.collect_set(F.when(hit, F.col("label")))), ",")
    return spans.groupBy("row", "doc_id", "n_words").agg(
        F.sum(place.cast("long")).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        named(place).alias("base_labels"), named(place | notice).alias("labels"),
        F.coalesce(F.max(F.when(place | notice, F.col("share"))), F.lit(0.0)).alias("score")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
