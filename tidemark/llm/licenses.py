"""License scans: phrases, and template spans found by diagonal voting over word k-grams.

Every k-gram of every document is hashed and joined with the places of the templates' k-grams. A
match votes for a diagonal, document place minus template place; neighbouring diagonals are merged,
so that a few inserted or missing words do not break a span, and a span is verified by the share of
the template's words that its matches cover. All of it is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, text_key

K = 4
#: Diagonals this close belong to one span.
GAP = 3
#: Least share of a template's words that a span's matches cover.
COVER = 0.6
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases with their labels, and well-known public notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def words(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def grams(w: Column, k: int = K) -> Column:
    """Array of (hash, place) of all runs of k words."""
    many = F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)),
                       lambda i: F.struct(F.xxhash64(*[F.element_at(w, i + j) for j in range(k)]).alias("h"), (i - 1).cast("long").alias("at")))
    return F.when(F.size(w) >= k, many)


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int = K) -> DataFrame:
    """One row per k-gram of each template: template, label, length, h, place."""
    rows = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    cut = rows.select("template", "label", words(F.col("text")).alias("w"))
    return cut.select("template", "label", F.size("w").cast("long").alias("size"), F.explode(grams(F.col("w"), k)).alias("g")).select(
        "template", "label", "size", F.col("g.h").alias("h"), F.col("g.at").alias("place"))


def template_spans(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
                   k: int = K, gap: int = GAP, cover: float = COVER) -> DataFrame:
    """id, key, label, template, start, end (words, exclusive), share of each verified span.

    Rows that repeat id and text are one here. Null and empty texts have no spans.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), words(F.col(text_col)).alias("w"))
    rolled = rows.select("id", "key", F.explode(grams(F.col("w"), k)).alias("g")).select("id", "key", F.col("g.h").alias("h"), F.col("g.at").alias("at"))
    # The templates are a constant of this module or a caller's list: their k-grams fit every task.
    votes = rolled.join(F.broadcast(template_grams(spark, templates, k)), "h")
    votes = votes.select("id", "key", "template", "label", "size", "at", "place").distinct()
    diagonals = (votes.groupBy("id", "key", "template", "label", "size", (F.col("at") - F.col("place")).alias("diagonal"))
                 .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("place").alias("places")))
    near = Window.partitionBy("id", "key", "template").orderBy("diagonal")
    apart = (F.col("diagonal") - F.lag("diagonal").over(near) > gap) | (F.col("first") - F.lag("last").over(near) > F.col("size"))
    grouped = diagonals.withColumn("span", F.sum(F.coalesce(apart, F.lit(True)).cast("int")).over(near))
    spans = grouped.groupBy("id", "key", "template", "label", "size", "span").agg(
        F.min("first").alias("start"), (F.max("last") + k).alias("end"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (k - 1))))))
    return spans.withColumn("share", covered / F.col("size")).where(F.col("share") >= cover).select(
        "id", "key", "label", "template", "start", "end", "share")


def _places(w: Column, phrase: list[str], label: str) -> Column:
    """Array of (at, label) of the places where the words of the phrase follow each other."""
    def stands(i: Column) -> Column:
        return reduce(and_, [F.element_at(w, i + j) == phrase[j] for j in reversed(range(len(phrase)))])
    at = F.filter(F.sequence(F.lit(1), F.size(w) - (len(phrase) - 1)), stands)
    told = F.transform(at, lambda i: F.struct((i - 1).cast("long").alias("at"), F.lit(label).alias("label")))
    held = F.array_contains(w, phrase[-1]) & (F.size(w) >= len(phrase))
    return F.when(held, told).otherwise(F.array().cast("array<struct<at:bigint,label:string>>"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of ASCII letters (A-Z as a-z), digits and characters beyond ASCII. The base are
    places where a phrase's words follow each other; first_word and last_word are the smallest and
    largest of them (null without any). ``labels`` adds those of verified template spans. ``score``
    is 1 where a phrase stands, else the largest share of a template that is covered, else 0. Null
    and empty texts have no words. Repeated rows and ids get repeated results; other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), words(F.col(text_col)).alias("w"))
    base = rows.select("id", "key", F.size("w").cast("long").alias("n_words"),
                       F.concat(*[_places(F.col("w"), phrase.split(), label) for phrase, label in PHRASES.items()]).alias("base"))
    spans = (template_spans(docs, templates, id_col, text_col).groupBy("id", "key")
             .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
             .select(F.col("id").alias("_id"), F.col("key").alias("_key"), "more", "share"))
    both = base.join(spans, base["id"].eqNullSafe(spans["_id"]) & (base["key"] == spans["_key"]), "left")
    own = F.array_distinct(F.transform("base", lambda b: b["label"]))
    every = F.array_distinct(F.concat(own, F.coalesce("more", F.array().cast("array<string>"))))
    return both.select(
        "id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["at"])).alias("first_word"), F.array_max(F.transform("base", lambda b: b["at"])).alias("last_word"),
        F.array_join(F.array_sort(own), ",").alias("base_labels"), F.array_join(F.array_sort(every), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"))
