"""Licence notices in documents, with DataFrame functions and Spark's own regression only.

Method. Paragraphs (lines, and windows of ``WINDOW`` lines for wrapped notices) are classified by a multinomial logistic regression over sparse word
1- to 3-grams of the notice templates. It is trained on the templates, on shortened forms
of them, on sentences that only sound alike and on a bounded sample of paragraphs, the last
two as class ``unknown``. A temperature fitted on held-out examples calibrates it, so the
probability of ``unknown`` is meant as one. A prediction counts as confirmed if the
paragraph also holds enough of the 3-grams of a template of that family.

A text or paragraph without any *anchor*, a template word of ``ANCHOR_LETTERS`` letters or one of
``SHORT_ANCHORS``, is ``unknown`` without further work; every template holds one.

Defined cases. A null or empty text has no paragraphs and no findings. Repeated rows count as
one; rows of one id, or of the null id, but different paragraphs are judged apart.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkdraft.llm.common import stored
from sparkdraft.llm.decontam import words
from sparkdraft.operators.reshape import bind

# Usual wordings of licence notices by family, and sentences that are none.
TEMPLATES = {
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.",
             "This program is free software: you can redistribute it and/or modify it under the "
             "terms of the GNU Affero General Public License as published by the Free Software "
             "Foundation."),
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the License); you may not use "
               "this file except in compliance with the License."),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, "
            "are permitted provided that the following conditions are met.",
            "Released under the BSD License."),
    "cc": ("Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC 4.0.",
           "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc0": ("Licensed under CC0 1.0 Universal.",
            "To the extent possible under law, the author has waived all copyright and related or "
            "neighboring rights to this work.",
            "Dedicated to the public domain under the CC0 1.0 Universal Public Domain Dedication."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the "
            "terms of the GNU General Public License as published by the Free Software Foundation."),
    "isc": ("Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with "
            "or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies."),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the "
             "terms of the GNU Lesser General Public License as published by the Free Software "
             "Foundation."),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files."),
    "mpl": ("Licensed under the Mozilla Public License, version 2.0.",
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "reserved": ("All rights reserved.", "Copyright the authors. All rights reserved.",
                 "No part of this publication may be reproduced without written permission."),
    "unlicense": ("Released under the Unlicense.",
                  "This is free and unencumbered software released into the public domain."),
}
NO_NOTICE = ("The licence of the driver was revoked last year.", "All rights belong to the people.",
             "The album was released under a new name.", "He is free to use the public road.",
             "The general public was not permitted to enter.", "Version 2 of the work is better.",
             "This work is done under the terms of the contract.", "A table was reserved for all.",
             "The foundation published a free copy of the files.", "under the", "of this", "all",
             "the work", "is free", "in the general", "with or without", "to any person")
ANCHOR_LETTERS = 6
SHORT_ANCHORS = ("bsd", "cc", "cc0", "gnu", "isc", "mit")
#: Most lines that a wrapped notice is looked for in.
WINDOW = 5
UNKNOWN = "unknown"
CLASSES = (*sorted(TEMPLATES), UNKNOWN)


@dataclass(frozen=True)
class Parameters:
    """``sampled`` bounds the paragraphs that are taken as examples of no notice."""

    sampled: int = 400
    regularisation: float = 1e-3
    probability: float = 0.5
    similarity: float = 0.5


@dataclass(frozen=True)
class Model:
    vocabulary: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]
    temperature: float


def _strings(values) -> Column:
    """An array literal of strings of letters, digits and blanks."""
    return F.expr("array(" + ", ".join(f"'{v}'" for v in values) + ")")


def _doubles(values) -> str:
    return "array(" + ", ".join(f"{v!r}D" for v in values) + ")"


def _plain(text: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _grams(w: list[str], sizes=(1, 2, 3)) -> list[str]:
    return sorted({" ".join(w[i:i + k]) for k in sizes for i in range(len(w) - k + 1)})


def grams(w: Column, vocabulary: tuple[str, ...]) -> Column:
    """The n-grams of an array of words that the vocabulary holds, each once."""
    known = _strings(vocabulary)

    def of(k: int) -> Column:
        at = F.sequence(F.lit(1), F.size(w) - k + 1)
        made = F.transform(at, lambda i: F.array_join(F.slice(w, i, F.lit(k)), " "))
        return F.when(F.size(w) >= k, made).otherwise(F.array().cast("array<string>"))

    single = F.array_intersect(w, known)
    more = F.array_intersect(F.concat(of(2), of(3)), known)
    return F.when(F.size(single) > 0, F.concat(single, more)).otherwise(single)


def anchored(text: Column) -> Column:
    """Whether a text holds a word that some licence notice needs."""
    found = sorted({w for ts in TEMPLATES.values() for t in ts for w in _plain(t)
                    if len(w) >= ANCHOR_LETTERS} | {*SHORT_ANCHORS})
    letter = r"[0-9A-Za-z\x{80}-\x{10FFFF}]"
    return F.coalesce(text.rlike(rf"(?i)(?<!{letter})(?:{'|'.join(found)})(?!{letter})"), F.lit(False))


def possible_grams(docs: DataFrame, vocabulary: tuple[str, ...]) -> Callable[[Column], Column]:
    """A function of an array of words: those of its n-grams that the vocabulary may hold.

    One binary of a byte for each hash cell travels with the plan; about one n-gram of sixteen
    that the vocabulary lacks gets through. An n-gram is made only where its first word may be
    a word of the vocabulary.
    """
    cells = 1 << max(12, (16 * len(vocabulary)).bit_length())
    cell = F.pmod(F.xxhash64("term"), F.lit(cells)).cast("int")
    terms = docs.sparkSession.createDataFrame([(v,) for v in vocabulary], "term string")
    held = bytearray(cells)
    for r in terms.select(cell.alias("cell")).collect():
        held[r.cell] = 1
    table = F.lit(bytes(held))

    def known(term: Column) -> Column:
        return F.substring(table, F.pmod(F.xxhash64(term), F.lit(cells)).cast("int") + 1, 1) == b"\1"

    def made(w: Column) -> Column:
        def starts(places: Column) -> Column:
            def of(k: int) -> Column:
                inside = F.filter(places, lambda i: i <= F.size(w) - k + 1)
                return F.filter(F.transform(inside, lambda i: F.array_join(
                    F.slice(w, i, F.lit(k)), " ")), known)

            return F.concat(F.transform(places, lambda i: F.get(w, i - 1)), of(2), of(3))

        at = F.when(F.size(w) > 0, F.sequence(F.lit(1), F.size(w))).otherwise(
            F.array().cast("array<int>"))
        return bind(F.filter(at, lambda i: known(F.get(w, i - 1))), starts)

    return made


def paragraphs(docs: DataFrame) -> DataFrame:
    """(doc columns, paragraph number from 0, its text) of each line that is not blank."""
    lines = F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\n")).alias("number", "line")
    return docs.select("doc_id", lines).where(F.trim("line") != "")


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, number, h, last, line): runs of ``WINDOW`` lines, or all up to a blank line.

    ``number`` is the first line, ``last`` the last; ``h`` is of the text that it was cut from.
    Windows are cut inside the text's own array of lines, and only around lines that hold a
    word of a notice: no row carries the lines of another.
    """
    def cut(lines: Column) -> Column:
        def window(number: Column) -> Column:
            part = F.slice(lines, number + 1, F.lit(WINDOW))
            blank = F.array_position(F.transform(part, lambda v: F.trim(v) == ""), F.lit(True))
            n = F.when(blank > 0, blank - 1).otherwise(F.size(part)).cast("int")
            return F.struct(number.alias("number"), (number + n - 1).alias("last"),
                            F.array_join(F.slice(part, F.lit(1), n), " ").alias("line"))

        def near(wanted: Column) -> Column:
            return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.exists(
                F.slice(wanted, i + 1, F.lit(WINDOW)), lambda w: w))

        found = F.transform(bind(F.transform(lines, anchored), near), window)
        return F.filter(found, lambda w: w["last"] > w["number"])

    return docs.where("text is not null").select(
        "doc_id", F.xxhash64("text").alias("h"), F.split(F.col("text"), r"\n").alias("lines")).select(
        "doc_id", "h", F.inline(bind(F.col("lines"), cut))).select("doc_id", "number", "h", "last", "line")


def _examples() -> list[tuple[str, str]]:
    rows = [(UNKNOWN, t) for t in NO_NOTICE]
    for family, texts in TEMPLATES.items():
        for t in texts:
            w = t.split()
            rows += [(family, t)] * 3
            for cut in range(1, max(2, len(w) // 3)):
                rows += [(family, " ".join(w[cut:])), (family, " ".join(w[:-cut]))]
                rows.append((family, "text before " + t + " and behind" * (cut % 3)))
    return rows


def fit(docs: DataFrame, p: Parameters = Parameters()) -> Model:
    """Train on the templates and on a bounded sample of the paragraphs of ``docs``."""
    spark = docs.sparkSession
    vocabulary = tuple(sorted({g for ts in TEMPLATES.values() for t in ts
                               for g in _grams(_plain(t))}))
    threes = [g for ts in TEMPLATES.values() for t in ts for g in _grams(_plain(t), (3,))]
    lines = docs.where("text is not null").select("doc_id", F.xxhash64("doc_id", "text").alias("h"),
                                                  "text").orderBy("h").limit(p.sampled)
    lines = paragraphs(lines).orderBy(F.xxhash64("doc_id", "number")).limit(p.sampled)
    lines = lines.select(words(F.col("line")).alias("w")).where("size(w) > 0")
    plain = lines.select(F.lit(UNKNOWN).alias("family"), grams(F.col("w"), vocabulary).alias("g"))
    plain = plain.where(~F.arrays_overlap("g", _strings(sorted(set(threes)))))
    made = spark.createDataFrame([(f, _plain(t)) for f, t in _examples()],
                                 "family string, w array<string>")
    made = made.select("family", grams(F.col("w"), vocabulary).alias("g"))
    rows = made.unionByName(plain).withColumn("held", F.pmod(F.xxhash64("family", "g"), F.lit(5)) == 0)
    dense = F.transform(_strings(vocabulary), lambda v: F.array_contains("g", v).cast("double"))
    label = F.array_position(_strings(CLASSES), F.col("family")) - 1
    # Every family has examples in the fit: only shortened forms are held out.
    data = stored(rows.select("g", "held", label.cast("double").alias("label")), "examples")
    data = data.withColumn("features", array_to_vector(dense))
    model = LogisticRegression(regParam=p.regularisation, maxIter=60, family="multinomial").fit(
        data.where(~F.col("held") | (F.size("g") > 60)))
    weights = [list(map(float, r)) for r in model.coefficientMatrix.toArray()]
    lacking = len(CLASSES) - len(weights)
    weights += [[0.0] * len(vocabulary)] * lacking
    intercepts = [*map(float, model.interceptVector), *[-20.0] * lacking]
    found = Model(vocabulary, tuple(map(tuple, weights)), tuple(intercepts), 1.0)
    held = logits(data.where("held").select("label", F.xxhash64("g").alias("h"), "g"),
                  ["label", "h"], found).collect()
    scores = [(int(r.label), [r[f"z{k}"] for k in range(len(CLASSES))]) for r in held]

    def loss(t: float) -> float:
        return sum(math.log(sum(math.exp((v - max(z)) / t) for v in z)) - (z[y] - max(z)) / t
                   for y, z in scores)

    best = min((2.0 ** (t / 4) for t in range(-4, 13)), key=loss)
    return Model(vocabulary, found.weights, found.intercepts, best)


def logits(rows: DataFrame, keys: list[str], model: Model) -> DataFrame:
    """``keys``, the n-grams ``g`` and the score of each class, ``z0`` and so on.

    ``rows`` has the keys and the array ``g``; the weight table is broadcast, which the
    templates bound.
    """
    spark = rows.sparkSession
    kinds = range(len(CLASSES))
    table = spark.createDataFrame(
        [(v, *row) for v, row in zip(model.vocabulary, zip(*model.weights))],
        "term string, " + ", ".join(f"w{k} double" for k in kinds))
    # The outer form keeps Spark from testing for an empty array first, by making it twice.
    terms = rows.select(*keys, F.explode_outer("g").alias("term")).where("term is not null")
    terms = terms.distinct()
    return terms.join(F.broadcast(table), "term").groupBy(*keys).agg(
        F.collect_list("term").alias("g"),
        *[((F.sum(f"w{k}") + F.lit(model.intercepts[k])) / F.lit(model.temperature)).alias(f"z{k}")
          for k in kinds])


def _judged(lines: DataFrame, keys: list[str], model: Model, p: Parameters) -> DataFrame:
    """``keys`` and the verdict on each ``line`` that is not ``unknown``."""
    # The words are a column of their own: inside of the n-grams they would be made anew for each.
    rows = lines.where(anchored(F.col("line"))).select(*keys, words(F.col("line")).alias("w"))
    # What the vocabulary lacks goes when the weights are joined.
    some = possible_grams(lines, model.vocabulary)
    rows = rows.select(*keys, some(F.col("w")).alias("g"))
    rows = stored(logits(rows, keys, model), "notices")
    z = [F.col(f"z{k}") for k in range(len(CLASSES))]
    rows = rows.withColumn("top", F.greatest(*z))
    total = sum((F.exp(v - F.col("top")) for v in z), F.lit(0.0))
    family = F.lit(UNKNOWN)
    for name, v in reversed(list(zip(CLASSES, z))):
        family = F.when(v == F.col("top"), name).otherwise(family)
    rows = rows.select(*keys, "g", (1.0 / total).alias("probability"),
                       (F.exp(z[-1] - F.col("top")) / total).alias("unknown"),
                       family.alias("family"))
    rows = rows.where((F.col("family") != UNKNOWN) & (F.col("probability") >= p.probability))
    similar = F.lit(0.0)
    for family, texts in TEMPLATES.items():
        each = []
        for t in texts:
            three = _grams(_plain(t), (3,))
            both = F.size(F.array_intersect("g", _strings(three)))
            each.append(both / len(three))
        similar = F.when(F.col("family") == family, F.greatest(*each)).otherwise(similar)
    return rows.withColumn("similarity", similar).select(
        *keys, "family", "probability", "unknown", "similarity",
        (F.col("similarity") >= p.similarity).alias("confirmed"))


def scanned(docs: DataFrame, model: Model, p: Parameters = Parameters()) -> DataFrame:
    """(doc_id, number, family, probability, unknown, similarity, confirmed) of paragraphs.

    Only paragraphs that are not ``unknown`` are returned. Wrapped notices are rows of their own,
    by their first line: those that are confirmed in a window but in none of its lines, of
    windows in a row the most similar one.
    """
    docs = docs.where(anchored(F.col("text")))
    keys = ["doc_id", "number", "h"]
    out = ["family", "probability", "unknown", "similarity", "confirmed"]
    lines = paragraphs(docs).withColumn("h", F.xxhash64("line"))
    single = stored(_judged(lines, keys, model, p), "single")
    wide = _judged(windows(docs), [*keys, "last"], model, p).where("confirmed")
    known = single.where("confirmed").select(
        F.col("doc_id").alias("d"), F.col("number").alias("n"), F.col("family").alias("f"))
    wide = stored(wide.join(known.distinct(), F.expr(
        "doc_id <=> d and family = f and n between number and last"), "left_anti"), "wide")
    near = wide.select(F.col("doc_id").alias("d"), F.col("h").alias("e"), F.col("family").alias("f"),
                       F.col("number").alias("n"), F.col("similarity").alias("s"))
    # Of windows that overlap, only the best one; of equal ones the last, which starts nearest.
    wide = wide.join(near, F.expr(
        f"doc_id <=> d and h = e and family = f and abs(n - number) < {WINDOW} and "
        "(s > similarity or s = similarity and n > number)"), "left_anti")
    return single.select("doc_id", "number", *out).unionByName(wide.select("doc_id", "number", *out))


def licences(docs: DataFrame, model: Model, p: Parameters = Parameters()) -> DataFrame:
    """(doc_id, families, n_notices, n_confirmed) of documents with a notice."""
    return scanned(docs, model, p).groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))).alias("families"),
        F.count("*").alias("n_notices"), F.count(F.when(F.col("confirmed"), 1)).alias("n_confirmed"))
