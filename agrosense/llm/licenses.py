r"""Licence scans: Dice coefficient over word bigrams against licence templates.

A document's units are its lines, its paragraphs (between empty lines) and its whole text.
Units and templates are normalised alike: A-Z lower-cased, words are runs of ASCII letters
and digits. A coefficient of at least ``t`` is only possible when the two bigram sets differ
in size by a factor of at most ``(2 - t) / t``; so each template is listed under every bigram
count it can match, and units meet only the templates listed under their own count (an
equality join with a small broadcast table). Bigram sets are then intersected exactly.

Defined cases: null and empty texts have no unit; a unit with fewer than two words has no
bigram and matches nothing; of equal coefficients the licence first in name order wins; rows
with equal id and text get equal results; an empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.llm.common import ascii_lower, row_key, stored

MIN_DICE = 0.8

# Public licence notices (SPDX names).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                   "this file except in compliance with the License. You may obtain a copy of the "
                   "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or "
                "neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, "
            "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
                "If a copy of the MPL was not distributed with this file, You can obtain one at "
                "https://mozilla.org/MPL/2.0/."),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), "[^a-z0-9]+"), "")


def bigrams(words: str) -> Column:
    """Distinct word bigrams of a column of words. It must be a column, not an expression: the
    lambda would evaluate that for every word."""
    return F.array_distinct(F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
        lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1))))


def template_table(spark: SparkSession, templates=None, min_dice: float = MIN_DICE) -> DataFrame:
    """``license, size, grams, n``: a row for each bigram count ``n`` a template can match."""
    rows = spark.createDataFrame(templates or TEMPLATES, "license string, text string")
    t = rows.select("license", words_of(F.col("text")).alias("words"))
    t = t.select("license", bigrams("words").alias("grams")).withColumn("size", F.size("grams"))
    low = F.ceil(F.col("size") * (min_dice / (2 - min_dice)) - 1e-9).cast("int")
    high = F.floor(F.col("size") * ((2 - min_dice) / min_dice) + 1e-9).cast("int")
    return t.where("size > 0").withColumn(
        "n", F.explode(F.sequence(F.greatest(low, F.lit(1)), high)))


def license_matches(docs: DataFrame, templates=None, min_dice: float = MIN_DICE) -> DataFrame:
    """``k, license, dice``: the matches of each row's units; ``k`` is the row's key."""
    spark = docs.sparkSession
    listed = stored(template_table(spark, templates, min_dice), "license-templates")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    pieces = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t]*\n"), F.array(text)))
    units = (docs.select(row_key(F.col("doc_id"), F.col("text")).alias("k"), pieces.alias("pieces"))
             .select("k", F.explode_outer("pieces").alias("unit")))
    units = units.select("k", words_of(F.col("unit")).alias("words"))
    # each distinct word but the first ends a bigram of its own, so a unit with more of them than
    # any listed count admits needs no bigrams
    largest = listed.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    few = F.size(F.array_distinct("words")) <= largest + 1
    units = units.select("k", F.when(few, bigrams("words")).alias("unit_grams"))
    # a filter on the bigrams, even "is not null", would be pushed below the projection of the
    # words and split them inside the lambda; a non-null count needs none
    units = units.withColumn("n", F.coalesce(F.size("unit_grams"), F.lit(0)))
    shared = F.size(F.array_intersect("unit_grams", "grams"))
    return (units.join(F.broadcast(listed), "n")           # a few hundred rows: the templates
            .withColumn("dice", 2.0 * shared / (F.col("n") + F.col("size")))
            .where(F.col("dice") >= min_dice).select("k", "license", "dice"))


def license_scan(docs: DataFrame, templates=None, min_dice: float = MIN_DICE) -> DataFrame:
    """``doc_id, license, dice, licenses``: best match and all matched licences per document."""
    found = (license_matches(docs, templates, min_dice).groupBy("k", "license")
             .agg(F.max("dice").alias("dice")).groupBy("k")
             .agg(F.min(F.struct(-F.col("dice"), F.col("license"))).alias("best"),
                  F.concat_ws(",", F.array_sort(F.collect_set("license"))).alias("licenses"))
             .select("k", F.col("best.license").alias("license"),
                     (-F.col("best.col1")).alias("dice"), "licenses"))
    ids = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("k"))
    return ids.join(stored(found, "license-hits"), "k", "left").select(
        "doc_id", "license", F.coalesce("dice", F.lit(0.0)).alias("dice"),
        F.coalesce("licenses", F.lit("")).alias("licenses"))
