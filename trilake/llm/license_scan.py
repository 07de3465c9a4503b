"""License scans by diagonal voting.

A template is a known notice or phrase; a place of a text's gram minus the place of the
same gram in a template is its *diagonal*. A text that holds the template at word ``s`` has
all its votes on diagonal ``s``; inserted or lost words move the rest to a neighbouring one.

1. All rolling word k-grams of the texts are hashed and joined to the places of the
   templates' grams. ``k`` is 4 (``GRAM``), or a template's length if that is shorter. The
   words of a joined gram are compared too, so a hash collision gives no vote.
2. Votes are aggregated by text, template and diagonal (partly in every map task).
3. Diagonals at most ``SLACK`` apart are merged into a band.
4. Verification: a band is a span of the template if its grams cover at least ``SHARE`` of
   the template's words. Of overlapping bands the best stays, then the first.

Phrases (``PHRASES``) are exact: all their grams on one diagonal, nothing merged.

Only DataFrame functions run. The templates are parameters; their grams are broadcast up to
``MAX_BROADCAST`` rows (a longer list goes through a shuffled join). Only hits are shuffled:
neither texts nor grams are.

Cases: null and empty texts have no words (score 0, no labels); null or repeated doc_ids and
repeated rows: rows with the same doc_id and text are one document, and each row gets its
result; an empty table gives no rows; other columns are ignored. The words of one text are
held in memory by the task that reads it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import materialise

GRAM = 4
SLACK = 3
SHARE = 0.8
#: Least share of a template's grams that votes for a band.
VOTES = 0.25
#: Most template grams that are broadcast (about 100 bytes each).
MAX_BROADCAST = 50_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ASCII outside of words.
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (phrase, label): found where its words stand consecutively.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: (notice, label): public license notices as their stewards word them. Fixed values.
NOTICES = (
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at", "apache-2.0"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
     "on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache-2.0"),
    ("Released under the MIT License", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
     "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission.", "bsd-3-clause"),
    ("licensed under the GNU General Public License, version 3", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation", "gpl"),
    ("licensed under the GNU Lesser General Public License", "lgpl"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "agpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("Licensed under CC BY 4.0", "cc-by-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by-4.0"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
)

_KEY = ["doc_id", "_th"]


def text_words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased: everything else in ASCII becomes a blank, then
    the text is cut at blanks (much faster than matching a pattern word by word)."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER + _BETWEEN, LOWER + " " * len(_BETWEEN)), " "), "")


def split_words(text: str) -> list[str]:
    """``text_words`` of a template on the driver."""
    return re.findall(WORD, text.translate(str.maketrans(UPPER, LOWER)))


def template_list(phrases: Sequence = PHRASES, notices: Sequence = NOTICES, gram: int = GRAM) -> list[dict]:
    """The templates with their words, gram length and votes needed; those without words go."""
    out = []
    for exact, rows in ((True, phrases), (False, notices)):
        for text, label in rows:
            words = split_words(text)
            if words:
                n = min(gram, len(words))
                places = len(words) - n + 1
                out.append({"t": len(out), "label": label, "exact": exact, "words": words, "n": n,
                            "need": places if exact else max(1, -int(-VOTES * places // 1))})
    return out


def _gram_hash(n: int, words: list[Column]) -> Column:
    return F.xxhash64(F.lit(n), *words)


def template_grams(spark: SparkSession, templates: list[dict]) -> tuple[DataFrame, int]:
    """(h, t, tpos, tw) for every gram of every template, and their number."""
    rows = [(x["t"], i, x["words"][i:i + x["n"]]) for x in templates for i in range(len(x["words"]) - x["n"] + 1)]
    if not rows:
        return spark.range(0).select(F.lit(0).cast("long").alias("h"), F.lit(0).alias("t"), F.lit(0).cast("long").alias("tpos"),
                                     F.array(F.lit("")).alias("tw")), 0
    structs = [F.struct(_gram_hash(len(w), [F.lit(x) for x in w]).alias("h"), F.lit(t).alias("t"), F.lit(i).cast("long").alias("tpos"),
                        F.array(*[F.lit(x) for x in w]).alias("tw")) for t, i, w in rows]
    return spark.range(1).select(F.inline(F.array(*structs))), len(rows)


def rolling_grams(docs: DataFrame, sizes: Sequence[int], words: Column) -> DataFrame:
    """``docs`` and ``_w`` (its words) with a row (pos, h) for every rolling gram of every size."""
    shifted = docs.withColumn("_w", words)
    places = shifted.select("*", F.posexplode("_w").alias("_p", "_w0"))
    at = [F.col("_w0"), *[F.get("_w", F.col("_p") + j) for j in range(1, max(sizes))]]
    # a gram that runs over the end has a hash too; it fails the comparison of the words
    return places.select("*", F.explode(F.array(*[_gram_hash(n, at[:n]) for n in sizes])).alias("h")).withColumn(
        "pos", F.col("_p").cast("long"))


def diagonals(docs: DataFrame, templates: list[dict], max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, _th, t, diag, at: the voted diagonals with their template places (each once)."""
    grams, count = template_grams(docs.sparkSession, templates)
    key = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th"), "text")
    sizes = sorted({x["n"] for x in templates}) or [1]
    rolled = rolling_grams(key, sizes, text_words(F.col("text")))
    same = rolled["h"] == grams["h"]
    for j in range(max(sizes)):  # the words too, so that equal hashes of other grams do not vote
        same &= (F.size(grams["tw"]) <= j) | (F.get(grams["tw"], F.lit(j)) == F.get(rolled["_w"], rolled["_p"] + j))
    votes = rolled.join(F.broadcast(grams) if count <= max_broadcast else grams, same)
    return votes.groupBy(*_KEY, "t", (F.col("pos") - F.col("tpos")).alias("diag")).agg(F.collect_set("tpos").alias("at"))


def license_spans(docs: DataFrame, phrases: Sequence = PHRASES, notices: Sequence = NOTICES, gram: int = GRAM,
                  slack: int = SLACK, share: float = SHARE, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """doc_id, _th, label, exact, first_word, last_word, share: the verified spans. Words are
    counted from 0; ``share`` is the part of the template's words that the span holds."""
    templates = template_list(phrases, notices, gram)
    found = diagonals(docs, templates, max_broadcast)
    spark = docs.sparkSession
    facts = [F.struct(F.lit(x["t"]).alias("t"), F.lit(x["label"]).alias("label"), F.lit(x["exact"]).alias("exact"), F.lit(x["n"]).alias("n"),
                      F.lit(x["need"]).alias("need"), F.lit(len(x["words"])).alias("length")) for x in templates]
    about = spark.range(1).select(F.inline(F.array(*facts))) if facts else spark.range(0).select(
        F.lit(0).alias("t"), F.lit("").alias("label"), F.lit(True).alias("exact"), *[F.lit(0).alias(c) for c in ("n", "need", "length")])
    rows = found.join(F.broadcast(about) if len(facts) <= max_broadcast else about, "t")
    order = Window.partitionBy(*_KEY, "t").orderBy("diag")
    own = F.array(F.struct("diag", "at"))  # a phrase has no neighbours: its band is its diagonal
    merged = F.collect_list(F.struct("diag", "at")).over(order.rangeBetween(0, slack))
    bands = rows.withColumn("band", F.when(F.col("exact"), own).otherwise(merged)).withColumn("places", F.flatten("band.at"))
    bands = bands.where(F.size("places") >= F.col("need"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("n").cast("long") - 1)))))
    bands = bands.withColumn("share", covered / F.col("length")).where(F.col("exact") | (F.col("share") >= share))
    near = order.rangeBetween(-slack, slack)
    best = F.max(F.struct("share", (-F.col("diag")).alias("d"))).over(near)["d"]
    bands = bands.withColumn("best", best).where(F.col("exact") | (F.col("best") == -F.col("diag")))
    first = F.array_min(F.transform("band", lambda x: x["diag"] + F.array_min(x["at"])))
    last = F.array_max(F.transform("band", lambda x: x["diag"] + F.array_max(x["at"])))
    return bands.select(*_KEY, "label", "exact", first.alias("first_word"), (last + F.col("n") - 1).alias("last_word"), "share")


def scan_licenses(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word (starts of the exact
    phrases), base_labels, labels (arrays), score (largest share of a template)."""
    spans = license_spans(docs, **how)
    of_base = lambda c: F.when(F.col("exact"), F.col(c))
    found = spans.groupBy(*_KEY).agg(
        F.count(of_base("label")).alias("n_base"), F.min(of_base("first_word")).alias("first_word"),
        F.max(of_base("first_word")).alias("last_word"), F.array_sort(F.collect_set(of_base("label"))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"), F.max("share").alias("score"))
    # a table of its own, so that the join below has two plain sides and can split a hot key
    found = materialise(found, "licenses").alias("f")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th"),
                       F.size(text_words(F.col("text"))).cast("long").alias("n_words")).alias("d")
    out = rows.join(found, F.expr("d.doc_id <=> f.doc_id and d._th = f._th"), "left")
    none = F.array().cast("array<string>")
    return out.select("d.doc_id", "d.n_words", F.coalesce("f.n_base", F.lit(0)).cast("long").alias("n_base"), "f.first_word", "f.last_word",
                      F.coalesce("f.base_labels", none).alias("base_labels"), F.coalesce("f.labels", none).alias("labels"),
                      F.coalesce("f.score", F.lit(0.0)).alias("score"))
