"""License scans by diagonal voting, in DataFrame functions and joins only.

Every text's words give rolling hashes of two and of three words; all of them are looked up among the templates' hashes
(a table of fixed size), and those found are joined to their places, word by word. A hit is a vote for the template at
the offset ``place in text - place in template``, its diagonal.

* Votes on one diagonal that lie close together in the text are a run. A place that votes for several places of a
  template counts for the one on the longest run only.
* Runs on neighbouring diagonals (some words more or less between) are merged to a span where they follow each other
  both in the text and in the template; so a span has every place of its template once at most, and repeating a
  phrase does not add votes.
* Where spans of several templates lie over each other, each place counts for the one with the most votes.
* A span is verified if the places it has left are a share of its template's and it has half of the places between its
  first and last one at least.

The base phrases are templates of pairs of words of which every pair must be there on one diagonal.

Defined results: null text is empty; rows equal in id and text are counted alike, each for itself; rows with a null id
are documents like any other; other columns, whatever their names, play no part; a long text takes time in proportion
to its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: Share of a template's word triples that a span must have, and the least number of them where there are so many.
SHARE = 0.3
VOTES = 5
#: Diagonals that are merged, and words between two votes of a span at most.
NEAR = 4
GAP = 30

# Phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Labels and texts of licenses' notices in their published wording, and a short statement of one.
NOTICES = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "apache": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "gpl": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "bsd": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "cc-by": """This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this
        license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866,
        Mountain View, CA 94042, USA.""",
    "cc-by-nc": """This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License. To view
        a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/ or send a letter to Creative Commons, PO
        Box 1866, Mountain View, CA 94042, USA.""",
}
STATEMENTS = {"cc-by-nc": "Licensed under CC BY-NC 4.0."}

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_ = F.octet_length(text) == F.char_length(text)
    return F.array_remove(F.split(F.when(ascii_, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower())), BREAKS), "")


def rolling(words: str) -> Column:
    """For every word its place, itself and the two behind it (null past the end), and the hashes of two and of three."""
    two, three = f"get({words}, i + 1)", f"get({words}, i + 2)"
    entry = f"struct(i as place, w as w1, {two} as w2, {three} as w3, xxhash64(w, {two}) as two, xxhash64(w, {two}, {three}) as three)"
    return F.expr(f"transform({words}, (w, i) -> {entry})")


def templates(spark: SparkSession) -> DataFrame:
    """Rows h, template, label, base, at (place in the template), its words t1 to t3, size (hashes of the template)."""
    rows = [(f"base {p}", label, True, p) for p, label in PHRASES.items()]
    rows += [(f"notice {label}", label, False, text) for label, text in NOTICES.items()]
    rows += [(f"statement {label}", label, False, text) for label, text in STATEMENTS.items()]
    df = spark.createDataFrame(rows, "template string, label string, base boolean, text string")
    df = df.withColumn("words", words_of(F.col("text"))).withColumn("e", F.explode(rolling("words")))
    df = df.where(F.when(F.col("base"), F.col("e.w2").isNotNull()).otherwise(F.col("e.w3").isNotNull()))
    size = F.count("*").over(Window.partitionBy("template"))
    return df.select(
        F.when(F.col("base"), F.col("e.two")).otherwise(F.col("e.three")).alias("h"),
        "template",
        "label",
        "base",
        F.col("e.place").alias("at"),
        F.col("e.w1").alias("t1"),
        F.col("e.w2").alias("t2"),
        F.when(~F.col("base"), F.col("e.w3")).alias("t3"),
        size.alias("size"),
    )


def key_of(id_column: str, text: str) -> Column:
    """The id and 128 bits of the text: rows that share them are alike."""
    text = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.struct(F.col(id_column).alias("id"), F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit("second")).alias("h2"))


def votes(docs: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """Rows key, template, label, base, size, place (in the text), at (in the template): every hit, once."""
    known = templates(docs.sparkSession)
    # The templates' hashes are some hundred literals, so that a word without a hit makes no row.
    wanted = sorted({row["h"] for row in known.select("h").collect()})
    df = docs.select(key.alias("key"), words_of(F.col(text)).alias("words"))
    found = F.filter(rolling("words"), lambda e: e.two.isin(wanted) | e.three.isin(wanted))
    df = df.select("key", F.explode(found).alias("e"))
    df = df.select("key", "e.place", "e.w1", "e.w2", "e.w3", F.explode(F.array("e.two", "e.three")).alias("h"))
    hits = df.join(F.broadcast(known), "h")
    same = (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2")) & (F.col("base") | (F.col("w3") == F.col("t3")))
    return hits.where(same).select("key", "template", "label", "base", "size", "place", "at").distinct()


def spans(hits: DataFrame) -> DataFrame:
    """Rows key, label, base, first (word), stop (word), share: verified spans."""
    hits = hits.withColumn("diagonal", F.col("place") - F.col("at"))
    phrases = (
        hits.where("base")
        .groupBy("key", "template", "label", "base", "size", "diagonal")
        .agg(F.count("*").alias("n"), F.min("place").alias("first"), (F.max("place") + 2).alias("stop"))
        .where("n = size")
        .select("key", "label", "base", "first", "stop", F.lit(1.0).alias("share"))
    )
    out = phrases.unionByName(notices(hits.where("not base")))
    return out.withColumns({"first": F.col("first").cast("long"), "stop": F.col("stop").cast("long")})


def notices(hits: DataFrame) -> DataFrame:
    """Verified spans of the notices."""
    one = ["key", "template"]

    def before(name: str, window: WindowSpec) -> Column:
        return F.lag(name).over(window)

    def numbered(starts: Column, window: WindowSpec) -> Column:
        return F.sum(F.coalesce(starts, F.lit(True)).cast("int")).over(window)

    line = Window.partitionBy(*one, "diagonal").orderBy("place")
    run = numbered(F.col("place") - before("place", line) > GAP, line)
    hits = hits.withColumn("run", run).withColumn("votes", F.count("*").over(Window.partitionBy(*one, "diagonal", "run")))
    choice = Window.partitionBy(*one, "place").orderBy(F.desc("votes"), "at")
    hits = hits.withColumn("choice", F.row_number().over(choice)).where("choice = 1")
    text = Window.partitionBy(*one).orderBy("place")
    breaks = (
        (F.col("place") - before("place", text) > GAP)
        | (F.col("at") <= before("at", text))
        | (F.abs(F.col("diagonal") - before("diagonal", text)) > NEAR)
    )
    hits = hits.withColumn("span", numbered(breaks, text)).withColumn("n", F.count("*").over(Window.partitionBy(*one, "span")))
    over = Window.partitionBy("key", "place").orderBy(F.desc("n"), F.desc(F.col("n") / F.col("size")), "template")
    hits = hits.withColumn("own", F.row_number().over(over) == 1)
    least = F.greatest(F.ceil(F.col("size") * SHARE), F.least(F.col("size"), F.lit(VOTES)))
    return (
        hits.groupBy(*one, "label", "base", "size", "span")
        .agg(
            F.count("*").alias("n"),
            F.count_if("own").alias("left"),
            F.min("place").alias("first"),
            (F.max("place") + 3).alias("stop"),
            (F.max("at") - F.min("at") + 1).alias("length"),
        )
        .where((F.col("left") >= least) & (2 * F.col("n") >= F.col("length")))
        .select("key", "label", "base", "first", "stop", (F.col("left") / F.col("size")).alias("share"))
    )


def scanned(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: words, places of base phrases, labels and the largest share of a template found."""
    key = key_of(id_column, text)
    found = (
        spans(votes(docs, key, text))
        .groupBy("key")
        .agg(
            F.count_if("base").alias("n_base"),
            F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
            F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
            F.max("share").alias("score"),
        )
    )
    rows = docs.select(F.col(id_column).alias("doc_id"), key.alias("key"), F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    out = rows.join(found, "key", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
