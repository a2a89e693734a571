"""License scans by diagonal voting.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. All rolling word
pairs of a text are joined with the template positions of the same hash and words. Each join
row votes for a diagonal: document position minus template position. Votes are summed by (row,
template, diagonal). A diagonal with all of a template's pairs is a whole place of it. Otherwise neighbouring diagonals (at most
``slack`` apart: words inserted or left out) merge into one span, which is verified: it holds the template's *key* pair, if it
names one (a version number, say, that tells it from its sisters); at most as many pairs are missing as
``missing`` allows for its size (an inserted word breaks one pair, a replaced word two); and it is not too long.

*Base* templates are the contract's phrases. A place of one is a whole diagonal, before merging; so all places count, however
close. The method adds the labels of its own templates, notices and short license texts, which are a table: any other may be given.
``score`` is the largest share of a verified span, 1 for whole places.

NULL and empty texts have no words. Rows are judged one by one, repeated rows each. The template table is broadcast when it has at
most MAX_BROADCAST_PAIRS rows. Texts are read twice (votes, numbers of words) and never shuffled. Only DataFrame functions run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwise.llm.common import column, packed, plain_words, small, stable, stored, unpacked

MAX_BROADCAST_PAIRS = 200_000


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    key: str = ""  # a word pair that must be there

    @property
    def words(self) -> list[str]:
        return re.findall("[0-9a-z]+", self.text.lower())


# The contract's phrases, then public notices of the usual licenses.
BASE = (
    Template("gpl", "gnu general public license", True), Template("apache", "apache license", True),
    Template("cc-by", "cc by", True), Template("mit", "mit license", True),
)
NOTICES = (
    Template("gpl-3", "licensed under the GNU General Public License version 3", key="version 3"),
    Template("gpl-2", "licensed under the GNU General Public License version 2", key="version 2"),
    Template("lgpl", "under the terms of the GNU Lesser General Public License", key="lesser general"),
    Template("apache-2.0", "Licensed under the Apache License Version 2.0", key="2 0"),
    Template("cc-by-nc", "licensed under CC BY-NC 4.0", key="by nc"),
    Template("cc-by-sa", "licensed under CC BY-SA 4.0", key="by sa"),
    Template("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
             "associated documentation files (the Software), to deal in the Software without restriction"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("all-rights-reserved", "all rights reserved"),
)
# Short public license texts in whole.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. ")
_BSD_CLAUSES = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
                "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
                "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                "documentation and/or other materials provided with the distribution. ")
TEXTS = (
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
             "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject "
             "to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
             "the Software. " + _AS_IS + "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
             "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    Template("isc-text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
             "that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS "
             "ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
             "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
             "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    Template("bsd-2-clauses", _BSD_CLAUSES),
    Template("bsd-3-clauses", _BSD_CLAUSES + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission.", key="neither the"),
    Template("zlib-text", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
             "applications, and to alter it and redistribute it freely, subject to the following restrictions"),
    Template("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
             "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
             "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
             "or implied. See the License for the specific language governing permissions and limitations under the License."),
    Template("gpl-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
             "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
             "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
             "PURPOSE. See the GNU General Public License for more details."),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
             "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)


@dataclass(frozen=True)
class Settings:
    templates: tuple[Template, ...] = BASE + NOTICES + TEXTS
    slack: int = 2
    least_share: float = 0.75  # of templates beyond ``short`` pairs
    short: int = 12
    most_length: float = 1.5

    def missing(self, of: Column) -> Column:
        """How many pairs of a template of ``of`` a span may lack."""
        few = F.when(of < 4, 0).when(of < 6, 1).otherwise(2)
        return F.when(of <= self.short, few).otherwise(F.floor(of * (1 - self.least_share)))


def template_table(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(template, label, base, key, words): the templates as a table."""
    rows = [(i, t.label, t.base, t.key or None, t.words) for i, t in enumerate(templates)]
    return spark.createDataFrame(rows, "template int, label string, base boolean, key string, words array<string>")


def template_pairs(table: DataFrame) -> DataFrame:
    """(template, label, base, of, key_at, at, pair): every word pair of every template; ``of`` is their number."""
    last = F.size("words") - 1
    pairs = F.transform(F.slice("words", F.lit(1), F.greatest(last, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(F.col("words"), i + 1)))
    rows = table.select("template", "label", "base", last.alias("of"), (F.array_position(pairs, F.col("key")) - 1).alias("key_at"), F.posexplode(pairs).alias("at", "pair"))
    return rows.where("of > 0").withColumn("h", F.xxhash64("pair"))


def voting(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """(rid, template, label, base, of, key_at, diagonal, votes, lo, hi, ats): all rolling word pairs of the texts joined with the
    templates' and summed by diagonal."""
    words = docs.select(F.monotonically_increasing_id().alias("rid"), plain_words(column(text)).alias("w"))
    both = F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(F.col("w"), i + 1)))
    rolling = words.select("rid", F.posexplode(both).alias("pos", "pair")).withColumn("h", F.xxhash64("pair"))
    return (rolling.join(small(pairs, MAX_BROADCAST_PAIRS), ["h", "pair"])
            .groupBy("rid", "template", "label", "base", "of", "key_at", (F.col("pos") - F.col("at")).alias("diagonal"))
            .agg(F.count("*").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.collect_set("at").alias("ats")))


def verified(votes: DataFrame, s: Settings) -> DataFrame:
    """(rid, label, base, diagonal, share): whole places, and merged spans of templates that are not base."""
    places = votes.where("votes = of").select("rid", "label", "base", "diagonal", F.lit(1.0).alias("share"))
    # neighbouring diagonals of one template and row: few, a row's voting pairs at most
    w = Window.partitionBy("rid", "template").orderBy("diagonal")
    fresh = F.when(F.col("diagonal") - F.lag("diagonal").over(w) <= s.slack, 0).otherwise(1)
    spans = (votes.where("not base").withColumn("new", fresh).withColumn("span", F.sum("new").over(w))
             .groupBy("rid", "template", "span", "label", "of", "key_at")
             .agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), (F.max("hi") - F.min("lo") + 1).alias("length")))
    held = F.size("ats")
    keyed = F.col("key_at").isNull() | F.array_contains("ats", F.col("key_at").cast("int"))
    good = spans.where(keyed & (F.col("of") - held <= s.missing(F.col("of"))) & (F.col("length") <= s.most_length * F.col("of") + s.slack))
    return places.unionByName(good.select("rid", "label", F.lit(False).alias("base"), F.lit(None).cast("int").alias("diagonal"), (held / F.col("of")).alias("share")))


def scan(docs: DataFrame, settings: Settings = Settings(), *, text: str = "text", templates: DataFrame | None = None) -> DataFrame:
    """``docs`` without its text, with n_words, n_base, first_word, last_word, base_labels, labels, score. ``templates`` (as
    ``template_table``) stands for those of the settings."""
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    docs = stable(docs)
    table = template_table(docs.sparkSession, settings.templates) if templates is None else templates
    votes = stored(voting(docs, template_pairs(table), text), "license-votes")
    base = F.when(F.col("base"), F.col("diagonal"))
    found = stored(verified(votes, settings).groupBy("rid").agg(
        F.count(base).alias("_n"), F.min(base).cast("long").alias("first_word"), F.max(base).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("_base"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("_all"), F.max("share").alias("_score")), "license-found")
    rows = docs.select(packed(docs, (text, *names)), F.monotonically_increasing_id().alias("rid"), F.size(plain_words(column(text))).cast("long").alias("n_words"))
    zero, none = F.lit(0).cast("long"), F.lit("")
    return rows.join(small(found, MAX_BROADCAST_PAIRS), "rid", "left").select(
        *unpacked(rows), "n_words", F.coalesce("_n", zero).alias("n_base"), "first_word", "last_word",
        F.coalesce("_base", none).alias("base_labels"), F.coalesce("_all", none).alias("labels"), F.coalesce("_score", F.lit(0.0)).alias("score"))
