"""Licence scan: Dice coefficient of word bigrams against licence templates (DataFrame operations only).

A document's units are its lines, cut after sentences. A unit and a template are
normalised (lower case, other characters than letters and digits as one space)
and become the sets of their word bigrams. Dice is 2 i / (a + b) for sets of a
and b bigrams with i in common; it is at least t only if b t / (2 - t) <= a <=
b (2 - t) / t, so a unit meets only templates of about its size, and only if it
shares a bigram with any template at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENT = 80

#: Public licence notices (name, one sentence).
TEMPLATES = [
    ("agpl-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-terms", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "Released under the BSD 3-Clause License."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("mit-licensed", "Licensed under the MIT License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]

UNIT_ENDS = r"([.!?])[\x20\x09-\x0D]+"
NOT_WORDS = r"[^a-z0-9]+"


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bigrams(words: Column) -> Column:
    """Distinct neighbouring words, joined by a space; empty for fewer than two words."""
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(pairs)


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(_lower(text), NOT_WORDS, " ")), " ")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None, percent: int = PERCENT) -> DataFrame:
    """(doc_id, unit, template, n_bigrams, dice, notice): the units of ``docs``
    (doc_id, text, any others) that reach ``percent`` with a template.

    ``unit`` counts the document's units from 0, ``notice`` is its text; of
    several templates a unit is listed with the best, the first by name if
    tied. Null, empty and wordless texts have no rows, nor do documents without
    a notice; repeated rows are scanned each. Templates of one word never match
    (no bigrams); an empty list or table gives no rows. The templates are a
    parameter, held in the plan as literals.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(TEMPLATES if templates is None else templates, "name string, notice string")
    known = [(r["name"], sorted(r["b"])) for r in known.select("name", bigrams(words_of(F.col("notice"))).alias("b")).where("size(b) > 0").collect()]
    schema = "doc_id long, unit int, template string, n_bigrams int, dice double, notice string"
    if not known:
        return spark.createDataFrame([], schema)
    units = docs.select("doc_id", F.posexplode(F.split(F.regexp_replace("text", UNIT_ENDS, "$1\n"), "\n")).alias("unit", "notice"))
    least = min(-(-len(b) * percent // (200 - percent)) for _, b in known)
    units = units.withColumn("w", words_of(F.col("notice"))).where(F.size("w") > least)  # n words have n - 1 bigrams at most
    array = lambda b: F.array(*[F.lit(x) for x in b])
    units = units.withColumn("g", bigrams(F.col("w"))).where(F.arrays_overlap("g", array(sorted({x for _, b in known for x in b}))))

    def against(place: int, name: str, b: list[str]) -> Column:
        n = F.size("g")
        near = (n * (200 - percent) >= len(b) * percent) & (n * percent <= len(b) * (200 - percent))
        shared = F.when(near, F.size(F.array_intersect("g", array(b)))).otherwise(0)
        reaches = 200 * shared >= percent * (n + len(b))
        return F.when(reaches, F.struct((F.lit(2.0) * shared / (n + len(b))).alias("dice"), F.lit(-place).alias("place"), F.lit(name).alias("name")))

    best = F.array_max(F.array(*[against(i, n, b) for i, (n, b) in enumerate(sorted(known))]))  # nulls don't count
    rows = units.select("doc_id", "unit", F.size("g").alias("n_bigrams"), "notice", best.alias("t")).where("t is not null")
    return rows.select("doc_id", "unit", F.col("t.name").alias("template"), "n_bigrams", F.col("t.dice").alias("dice"), "notice")
