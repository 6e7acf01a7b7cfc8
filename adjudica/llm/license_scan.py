"""License scans by diagonal voting; DataFrame functions only.

All rolling k-grams of a text's words are hashed and joined to the places of the same k-grams in short notice templates.
A hit votes for the diagonal place - template place; neighbouring diagonals are merged (words put in or left out shift a
notice), and a merged span is verified by the share of the template's words it covers and by the grams that tell the
notice from others. The join comes before any
shuffle: only hits travel, keyed by document and template.

Base places are whole phrases whose words stand consecutively; their labels always stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.functions.text import let, running_sums
from adjudica.llm import _common as C

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: fixed values: phrases and their labels
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: fixed values: notice texts by paragraph, in words; a table of fixed size, so its k-grams are broadcast. A star marks a
#: word whose k-gram must be found: it tells the notice from its neighbours.
TEMPLATES = {
    "mit": [
        "released under the mit license",
        "*license identifier mit",
        "permission is hereby granted free of charge to any person obtaining a copy of *this software",
        "permission is hereby granted free of charge to any person obtaining a copy of *this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the *authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ],
    "apache-2": [
        "licensed under the apache license version 2 0",
        "*license identifier apache 2 0",
        "licensed under the *apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at",
        "you may not use this file except in compliance with the license",
        "subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable *copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",
        "you must cause any modified files to carry prominent notices stating that you changed the files and you must retain in the source form of any *derivative works that you distribute all copyright patent trademark and attribution notices from the source form of the work",
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages",
        "*license identifier bsd",
    ],
    "isc": [
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        "*license identifier isc",
    ],
    "gpl": [
        "this program is free software you can redistribute it and or modify it under the terms of the *gnu general public license",
        "you should have received a copy of the *gnu general public license along with this program if not see",
    ],
    "gpl-2": [
        "this program is free software you can redistribute it and or modify it under the terms of the *gnu general public license as published by the free software foundation either *version 2 of the license or at your option any later version",
        "licensed under the gnu general public *license version 2",
        "the licenses for *most software are designed to take away your freedom to share and change it by contrast the gnu general public *license is intended to guarantee your freedom to share and change free software",
        "*license identifier gpl *2 0",
    ],
    "gpl-3": [
        "this work is licensed under the gnu general public *license version 3",
        "the *gnu general public license is a free copyleft license for software and other kinds of works",
        "*gnu general public license version 3 29 june 2007",
        "this program is free software you can redistribute it and or modify it under the terms of the *gnu general public license as published by the free software foundation either *version 3 of the license or at your option any later version",
        "*license identifier gpl *3 0",
    ],
    "lgpl": [
        "this library is free software you can redistribute it and or modify it under the terms of the gnu *lesser general public license as published by the free software foundation",
        "licensed under the gnu *lesser general public license version",
        "*license identifier lgpl",
    ],
    "agpl-3": [
        "this program is free software you can redistribute it and or modify it under the terms of the gnu *affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        "*license identifier agpl *3 0",
        "the gnu *affero general public license is a free copyleft license for software and other kinds of works",
    ],
    "mpl-2": [
        "this source code form is subject to the terms of the *mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        "*license identifier mpl *2 0",
    ],
    "epl-2": ["this program and the accompanying materials are made available under the terms of the *eclipse public license 2 0"],
    "zlib": ["this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"],
    "boost-1": [
        "*boost software license version 1 0",
        "permission is hereby granted free of charge to any person or *organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
        "in no event shall the copyright holders or *anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ],
    "ofl-1": [
        "this font software is licensed under the sil *open font license version 1 1",
        "permission is hereby granted free of charge to any person obtaining a copy of the *font software to use study copy merge embed modify redistribute and sell modified and unmodified copies of the font software subject to the following conditions",
    ],
    "unlicense": ["this is free and unencumbered software released into the public domain", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"],
    "cc0": ["to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "this work is licensed under *cc0 1 0 universal"],
    "cc-by": ["this work is licensed under a creative commons *attribution 4 0 international license", "this work is licensed under *cc by 4 0"],
    "cc-by-sa": ["this work is licensed under a creative commons *attribution sharealike 4 0 international license", "this work is licensed under *cc by sa 4 0"],
    "cc-by-nc": ["this work is licensed under cc by nc 4 0", "this work is licensed under a creative commons *attribution noncommercial 4 0 international license"],
    "cc-by-nd": ["this work is licensed under a creative commons *attribution noderivatives 4 0 international license", "this work is licensed under *cc by nd 4 0"],
    "all-rights-reserved": ["all rights reserved no part of this publication may be reproduced", "all rights reserved no part of this publication may be reproduced distributed or transmitted in any form or by any means including photocopying recording or other electronic or mechanical methods without the prior written permission of the publisher"],
}
K = 3
#: diagonals this near each other are one span; a span covering less of its template is no notice
NEAR, LEAST_COVER = 2, 0.75


def words_text(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, joined by single spaces. Letters that lower() would turn into ASCII are
    put out of its way first; they are letters of a word either way."""
    t = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\u0138")), F.lit("\u0130"), F.lit("\u0138"))
    return F.trim(F.regexp_replace(F.lower(t), NOT_WORD, " "))


def _count_words(spaced: Column) -> Column:
    return F.when(spaced == "", 0).otherwise(F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("long")


def phrase_places(spaced: Column, phrase: str) -> Column:
    """First words (from 0) of all places of a phrase; every word has two spaces of its own, so places cannot overlap."""
    doubled = F.concat(F.lit(" "), F.replace(spaced, F.lit(" "), F.lit("  ")), F.lit(" "))
    wrapped = " " + phrase.replace(" ", "  ") + " "
    n = phrase.count(" ") + 1
    parts = F.split(doubled, wrapped, -1)
    before = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: ((F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit("")))) / 2).cast("long"))
    placed = let(before, lambda b: F.zip_with(running_sums(F.transform(b, lambda x: x + n)), b, lambda at, x: at + x))
    return F.when(F.contains(doubled, F.lit(wrapped)), placed).otherwise(F.array().cast("array<bigint>"))


def template_grams() -> list[tuple[str, int, int, int, str, bool]]:
    """(label, number, words, place, gram, whether it must be found) of every k-gram of every template."""
    rows = []
    for label, texts in TEMPLATES.items():
        for number, text in enumerate(texts):
            marked = text.split()
            words = [w.lstrip("*") for w in marked]
            # the last grams of a short template start before the marked word; its own gram then is the last one
            must = {min(i, len(words) - K) for i, w in enumerate(marked) if w[0] == "*"}
            rows += [(label, number, len(words), i, " ".join(words[i : i + K]), i in must) for i in range(len(words) - K + 1)]
    return rows


def _template_grams(spark) -> DataFrame:
    df = spark.createDataFrame(template_grams(), "label string, number int, n int, t_at int, gram string, must boolean")
    parts = F.split("gram", " ")
    needed = F.sum(F.col("must").cast("int")).over(Window.partitionBy("label", "number"))
    return df.select("label", "number", "n", "t_at", "must", needed.alias("needed"), F.xxhash64(*[parts[i] for i in range(K)]).alias("h"))


def spans(docs: DataFrame) -> DataFrame:
    """Verified template spans: doc_id, text_hash, label, first_word, last_word, cover (share of the template's words).

    Texts of fewer than K words have none; null texts are empty. Rows of the same id but another text keep apart.
    """
    words = F.split(words_text(F.col("text")), " ")
    grams = F.transform(F.sequence(F.lit(0), F.size("words") - K), lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(K)]))
    each = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words.alias("words")).where(F.size("words") >= K).select("doc_id", "text_hash", F.posexplode(grams).alias("at", "h"))
    hits = each.join(F.broadcast(_template_grams(docs.sparkSession)), "h")
    one = ["doc_id", "text_hash", "label", "number", "n", "needed"]
    must = F.collect_set(F.when(F.col("must"), F.col("t_at")))
    lines = hits.groupBy(*one, (F.col("at") - F.col("t_at")).alias("diagonal")).agg(F.collect_set("t_at").alias("t_at"), must.alias("must"), F.min("at").alias("a"), F.max("at").alias("z"))
    along = Window.partitionBy(*one).orderBy("diagonal")
    lines = lines.withColumn("new", (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(along), F.lit(-(10**9))) > NEAR).cast("int"))
    lines = lines.withColumn("island", F.sum("new").over(along))
    found = lines.groupBy(*one, "island").agg(F.flatten(F.collect_list("t_at")).alias("t_at"), F.size(F.array_distinct(F.flatten(F.collect_list("must")))).alias("told"), F.min("a").alias("first_word"), (F.max("z") + (K - 1)).alias("last_word"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("t_at", lambda t: F.sequence(t, t + (K - 1))))))
    found = found.withColumn("cover", covered / F.col("n"))
    return found.where((F.col("cover") >= LEAST_COVER) & (F.col("told") >= F.col("needed")) & (F.col("last_word") - F.col("first_word") < 2 * F.col("n"))).select("doc_id", "text_hash", "label", "first_word", "last_word", "cover")


def scan(docs: DataFrame) -> DataFrame:
    """Labels and places of license notices of every row: doc_id, n_words, places (first words of all base places),
    base_labels and labels (sorted arrays) and score.

    score is the best cover of a verified span, 1 where a base place stands, else 0. Null or empty text: no words, no
    labels. Rows of the same id are separate; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = C.Scratch(docs.sparkSession, "licenses")
    found = spans(docs).groupBy("doc_id", "text_hash").agg(F.collect_set("label").alias("more"), F.max("cover").alias("cover"))
    found = work.write(found, "found").select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "more", "cover")
    spaced = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_text(F.col("text")).alias("spaced"))
    places = {label: phrase_places(F.col("spaced"), phrase) for phrase, label in PHRASES.items()}
    base = spaced.select("doc_id", "text_hash", _count_words(F.col("spaced")).alias("n_words"), *[c.alias(label) for label, c in places.items()])
    both = base.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    own = F.array_compact(F.array(*[F.when(F.size(F.col(f"`{label}`")) > 0, F.lit(label)) for label in places]))
    return both.select(
        "doc_id",
        "n_words",
        F.concat(*[F.col(f"`{label}`") for label in places]).alias("places"),
        F.array_sort(own).alias("base_labels"),
        F.array_sort(F.array_union(own, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size(own) > 0, F.lit(1.0)).otherwise(F.coalesce("cover", F.lit(0.0))).alias("score"),
    )
