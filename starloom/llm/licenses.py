"""License scans by diagonal voting (native: DataFrame functions only).

All rolling k-grams of a document's words (k = 2, the length of the shortest phrase) are joined, on their hash and then on the words themselves,
with the places of the templates that hold them. A match at document word p and template word t votes for diagonal
p - t: the place where the template would start. Votes are added up per document, template and diagonal (a set of template places as bits, so
repeated rows add nothing), as partial aggregates.

* A phrase stands where one diagonal holds all its k-grams: these places are the base result.
* A notice may have words put in, left out or changed, which shifts what follows to a neighbouring diagonal. Each diagonal is merged with those up
  to ``SLACK`` words beside it. The span from the first to the last matched word is verified: it holds ``COVER`` of the template's k-grams (all of a
  template of fewer than ``WHOLE``, as one word may tell two licenses apart), matched on merged diagonals, and is at most half as long again as the template (every match was compared word by word). Neighbouring
  diagonals that pass are one place, at the best of them.

A template is made of words a-z, 0-9 or beyond ASCII. Only matches are shuffled, as numbers under a digest of id and text; the templates are a parameter, broadcast, and bounded (``MAX_GRAMS`` places together,
60 k-grams each). A document's windows hold its own matches alone; a common word pair has as many matches as places, spread by document.

Defined results: a NULL or empty text has no words, no labels and score 0. Rows equal in id and text give equal rows each. NULL ids are kept apart by their
text. Texts of any length are read whole; an empty table gives an empty result; the document's other columns are not read.
``score``: the share of k-grams found in the best place (1 where a phrase or whole notice stands), 0 without a label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import read

#: A word before A-Z are made small: the capitals stand where the class of small words has no characters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K, SLACK, COVER, WHOLE, MAX_GRAMS = 2, 3, 0.8, 15, 10_000

# The phrases of the base result and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Wordings by which public licenses are declared (their notices in words: small letters, digits, no marks).
NOTICES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
               "without warranties or conditions of any kind either express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
            "without specific prior written permission"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by "
            "the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def small(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text, in its own capitals; none of a NULL one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def grams(w: Column, k: int = K) -> Column:
    """All rolling k-grams of an array of words, joined by a space (no word holds one)."""
    n = F.size(w) - (k - 1)
    out = F.slice(w, 1, F.greatest(n, F.lit(0)))
    for i in range(1, k):
        out = F.zip_with(out, F.slice(w, i + 1, F.greatest(n, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def template_places(spark, phrases=PHRASES, notices=NOTICES, k: int = K) -> tuple[DataFrame, DataFrame]:
    """(template, label, exact, n_grams, need: k-grams that must be found) and (template, at, gram, hash): bounded, see ``MAX_GRAMS``."""
    rows = [(i, label, exact, text.split()) for i, (label, text, exact) in enumerate(
        [(lab, text, True) for text, lab in phrases] + [(lab, text, False) for lab, text in notices])]
    if any(not k <= len(w) <= 60 + k - 1 for *_, w in rows) or sum(len(w) for *_, w in rows) > MAX_GRAMS:
        raise ValueError(f"a template has {k} to {60 + k - 1} words, all together {MAX_GRAMS}")
    templates = spark.createDataFrame([(i, lab, e, len(w) - k + 1) for i, lab, e, w in rows], "template int, label string, exact boolean, n_grams int")
    places = spark.createDataFrame([(i, at, " ".join(w[at:at + k])) for i, _, _, w in rows for at in range(len(w) - k + 1)],
                                   "template int, at int, gram string")
    need = F.when(F.col("exact") | (F.col("n_grams") < WHOLE), F.col("n_grams")).otherwise(F.ceil(F.lit(COVER) * F.col("n_grams")))
    return templates.withColumn("need", need), places.withColumn("hash", F.xxhash64("gram"))


def diagonals(docs: DataFrame, places: DataFrame, k: int = K) -> DataFrame:
    """doc_id, digest, template, diagonal, hits (bits of template places), first and last matched word, of all matches.

    ``docs``: doc_id, digest, w (words).
    """
    rolled = docs.select("doc_id", "digest", F.posexplode(grams(F.col("w"), k)).alias("p", "text_gram"))
    # lower() agrees with small() on whatever equals a template; beyond A-Z it may change more, and the comparison tells. As an equality
    # the comparison would become a join key, to be computed for every word; so each must start with the other.
    same = small(F.col("text_gram"))
    votes = (rolled.withColumn("hash", F.xxhash64(F.lower("text_gram"))).join(F.broadcast(places), "hash")  # bounded: MAX_GRAMS rows
             .filter(same.startswith(F.col("gram")) & F.col("gram").startswith(same)))
    return (votes.withColumn("diagonal", F.col("p") - F.col("at")).groupBy("doc_id", "digest", "template", "diagonal")
            .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("hits"), F.min("p").alias("first"), (F.max("p") + k - 1).alias("last")))


def merge_diagonals(voted: DataFrame, templates: DataFrame, k: int = K, slack: int = SLACK) -> DataFrame:
    """Verified places: doc_id, digest, template, label, exact, first, last, score."""
    own = W.partitionBy("doc_id", "digest", "template").orderBy("diagonal")
    near = own.rangeBetween(-slack, slack)
    of = lambda c, over: F.when(F.col("exact"), F.col(c)).otherwise(over)
    merged = (voted.join(F.broadcast(templates), "template")  # bounded: MAX_GRAMS rows
              .withColumns({"hits": of("hits", F.bit_or("hits").over(near)), "first": of("first", F.min("first").over(near)),
                            "last": of("last", F.max("last").over(near))})
              .withColumn("score", F.bit_count("hits") / F.col("n_grams"))
              .filter((F.bit_count("hits") >= F.col("need"))
                      & (F.col("last") - F.col("first") + 1 <= 1.5 * (F.col("n_grams") + k - 1))))
    alone = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(own) > slack)
    return (merged.withColumn("starts", F.coalesce(alone.cast("int"), F.lit(0))).withColumn("place", F.sum("starts").over(own))
            .groupBy("doc_id", "digest", "template", "label", "exact", "place")
            .agg(F.max(F.struct(F.col("score"), -F.col("diagonal"), F.col("first"), F.col("last"))).alias("best"))
            .select("doc_id", "digest", "template", "label", "exact", "best.first", "best.last", "best.score"))


def scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    templates, places = template_places(docs.sparkSession, phrases, notices)
    text = F.col(text_col)
    key = [F.col(id_col).cast("long").alias("doc_id"), F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("digest")]
    found = merge_diagonals(diagonals(docs.select(*key, words(text).alias("w")), places), templates)
    base = F.when(F.col("exact"), F.col("first"))
    per_document = found.groupBy("doc_id", "digest").agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("score").alias("score"))
    theirs = per_document.withColumnsRenamed({"doc_id": "_doc", "digest": "_digest"})
    return (docs.select(*key, F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
            .join(theirs, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")), "left")
            .select("doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
                    F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
                    F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                    F.coalesce("score", F.lit(0.0)).alias("score")))


def op13_licenses(spark, sf_dir):
    return scan(read(spark, sf_dir, "documents"))
