"""License scan: Dice coefficient of word bigrams against templates.

Units of a text are its lines, the blocks of lines between blank lines, one to three sentences
that follow one another in a block, whatever lines they go over, and the whole text.  A unit
matches a template if the Dice coefficient of their sets of word bigrams reaches the threshold
``t`` and is the largest of all templates'.  The threshold bounds the unit's number of bigrams from both sides, and it forces the unit to share some of any
``m - ceil(m * t / (2 - t)) + 1`` of a template's ``m`` bigrams: so only units that hold one of
that many chosen bigrams are compared at all.  Neither bound loses a match.  Built-in functions
only.
"""

from __future__ import annotations

import math
import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallylake.llm.common import staged

THRESHOLD = Fraction(4, 5)
#: Sentences of a unit inside a block, at most.
MOST_SENTENCES = 3

# The wording of public licences and of the usual notices.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),  # noqa: E501
    ("MIT", "MIT License Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),  # noqa: E501
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),  # noqa: E501
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),  # noqa: E501
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),  # noqa: E501
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),  # noqa: E501
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),  # noqa: E501
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),  # noqa: E501
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),  # noqa: E501
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),  # noqa: E501
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),  # noqa: E501
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All-rights-reserved", "All rights reserved."),
)

_NOT_WORD = r"[^\p{L}\p{N}]+"
_BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*\n"
#: After the mark that ends a sentence, before what may begin the next.
_SENTENCE_END = r"(?<=[.!?])\s+(?=[\p{Lu}\"'(#*/])"


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bigrams(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def size_bounds(size: int, threshold: Fraction) -> tuple[int, int]:
    """The least and most bigrams of a unit that may reach the threshold."""
    share = threshold / (2 - threshold)
    return math.ceil(size * share), math.floor(size / share)


def anchors(own: set[str], threshold: Fraction) -> list[str]:
    """Enough bigrams that no match can miss them all; those with long words are rare."""
    needed = len(own) - size_bounds(len(own), threshold)[0] + 1
    rank = lambda b: (-max(map(len, b.split())), -len(b), b)
    return sorted(own, key=rank)[:needed]


def normalised_words(text: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.lower(text), _NOT_WORD, " "))
    return F.filter(F.split(bare, " "), lambda w: w != "")


def word_bigrams(words: Column) -> Column:
    last = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, 1, last), F.slice(words, 2, last), lambda a, b: F.concat(a, F.lit(" "), b)
    )


def _sentence_units(block: Column) -> Column:
    """Some sentences of a block, one after another, but never all of them: that is the block."""

    def runs(sentences: Column, count: int) -> Column:
        starts = F.when(
            F.size(sentences) > count, F.sequence(F.lit(0), F.size(sentences) - count)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts, lambda n: F.concat_ws(" ", *[F.get(sentences, n + i) for i in range(count)])
        )

    # As the argument of a function the sentences are split once, not for each of their runs.
    return F.flatten(
        F.transform(
            F.array(F.split(block, _SENTENCE_END)),
            lambda s: F.concat(*[runs(s, n) for n in range(1, MOST_SENTENCES + 1)]),
        )
    )


def template_table(spark: SparkSession, templates, threshold: Fraction) -> DataFrame:
    rows = []
    for number, (name, text) in enumerate(templates):
        own = bigrams(template_words(text))
        low, high = size_bounds(len(own), threshold)
        rows += [(number, name, len(own), low, high, b) for b in sorted(own)]
    return spark.createDataFrame(
        rows, "template int, license string, t_size int, low int, high int, t_bigram string"
    )


def find_licenses(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates=TEMPLATES,
    threshold: Fraction = THRESHOLD,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, licenses, matches.

    ``matches`` lists (unit, license, common, unit_size, template_size) of every unit and
    template whose Dice coefficient ``2 * common / (unit_size + template_size)`` reaches the
    threshold and no other template's with that unit is larger; units are numbered, lines first,
    then blocks of several lines, the whole text if it has several blocks, and sentences.
    ``licenses`` holds their names, sorted.  Equal lines are units of their own.  A null or empty text has no matches; a line
    of one word has no bigrams and matches nothing.  Rows that repeat an id are rows of their
    own; other columns are ignored; an empty table gives no rows.  A very long text without
    the words of a licence is searched for these only.
    """
    spark = documents.sparkSession
    own = [bigrams(template_words(text)) for _, text in templates]
    sizes = [size_bounds(len(b), threshold) for b in own]
    least, most = min(low for low, _ in sizes), max(high for _, high in sizes)
    chosen = sorted({a for b in own for a in anchors(b, threshold)})
    lines = F.split("text", "\n")
    every = F.split("text", _BLANK_LINE)
    blocks = F.filter(every, lambda b: F.instr(b, "\n") > 0)
    whole = F.filter(F.array("text"), lambda t: F.size(every) > 1)
    sentences = F.flatten(F.transform(every, _sentence_units))
    units = F.transform(F.concat(lines, blocks, whole, sentences), normalised_words)
    # More words than bigrams may repeat, so only the lower bound holds for words.
    units = F.filter(
        F.transform(units, lambda w, n: F.struct(n.alias("unit"), w.alias("words"))),
        lambda u: F.size(u["words"]) > least,
    )
    units = F.transform(
        units,
        lambda u: F.struct(
            u["unit"].alias("unit"),
            F.array_distinct(word_bigrams(u["words"])).alias("bigrams"),
        ),
    )
    wanted = F.array(*[F.lit(a) for a in chosen])
    # The whole text, lines and all, holds every bigram that a unit of it holds; looked up by hash.
    hopeful = F.arrays_overlap(word_bigrams(F.col("words")), wanted)
    units = F.filter(
        units,
        lambda u: F.size(u["bigrams"]).between(least, most)
        & F.arrays_overlap(u["bigrams"], wanted),
    )
    none = F.expr("cast(array() as array<struct<unit:int,bigrams:array<string>>>)")
    rows = staged(
        documents.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        )
        .withColumn("words", normalised_words(F.col("text")))
        .withColumn("hopeful", hopeful)
        .select("row_id", "doc_id", F.when(F.col("hopeful"), units).otherwise(none).alias("units")),
        "license-units",
    )
    table = template_table(spark, templates, threshold)
    held = (
        rows.select("row_id", F.explode("units").alias("u"))
        .select("row_id", "u.unit", F.size("u.bigrams").alias("size"),
                F.explode("u.bigrams").alias("bigram"))
    )
    pairs = (
        held.join(
            table,
            (F.col("bigram") == F.col("t_bigram")) & F.col("size").between(F.col("low"), F.col("high")),
        )
        .groupBy("row_id", "unit", "size", "template", "license", "t_size")
        .agg(F.count("*").cast("int").alias("common"))
    )
    reached = 2 * threshold.denominator * F.col("common") >= threshold.numerator * (
        F.col("size") + F.col("t_size")
    )
    dice = F.col("common").cast("double") / (F.col("size") + F.col("t_size"))
    largest = F.max("dice").over(Window.partitionBy("row_id", "unit"))
    best = pairs.where(reached).withColumn("dice", dice).withColumn("largest", largest)
    found = best.where("dice = largest").groupBy("row_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "unit",
                    "license",
                    "common",
                    F.col("size").alias("unit_size"),
                    F.col("t_size").alias("template_size"),
                )
            )
        ).alias("matches")
    )
    empty = F.expr(
        "cast(array() as array<struct<unit:int,license:string,common:int,"
        "unit_size:int,template_size:int>>)"
    )
    return (
        rows.select("row_id", "doc_id")
        .join(found, "row_id", "left")
        .select("doc_id", F.coalesce("matches", empty).alias("matches"))
        .withColumn("licenses", F.array_sort(F.array_distinct("matches.license")))
    )
