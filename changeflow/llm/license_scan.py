"""License scan by diagonal voting: rolling word k-gram hashes of documents and templates vote for alignments.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower case.

1. All k-grams of a document, for each k that a template uses, are hashed with their positions and joined to the templates'
   k-grams.
2. A hit votes for its diagonal, the document's position less the template's; votes are counted per text, template and
   diagonal.
3. Neighbouring diagonals (words put in or left out move an alignment by a few) are merged to one span.
4. The span so found is verified on the words themselves: a base template needs its words one after the other; any
   other one LEAST_PERCENT percent of its words in common order, by longest common subsequence, with at most a quarter as
   many other words put in between (one at least).

A base template is found wherever it stands, for it has all its votes on one diagonal. Any other one is found wherever step 4
accepts it: k is so small (``gram``) that some k-gram stays whole whatever words are missing or put in, and every span
with a vote is verified, with a margin for the words put in. ``WORD``, templates and figures are parameters of the method.

The templates' k-grams are broadcast while there are at most BROADCAST_ROWS of them; more are joined by shuffle, with the same
result. Texts are told apart by a 128-bit hash, so equal texts are worked on as one. A text is hashed and verified whole by one
task: one very long text needs about 30 bytes of memory per word and k.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import fresh_name, load, short_batches, stage

GRAM = 3
# Diagonals at most so far apart are neighbours; the least percentage of a template's words that a place must hold in order.
DRIFT = 3
LEAST_PERCENT = 80
BROADCAST_ROWS = 1_000_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
ODD = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Template:
    """A text to look for. ``base`` templates count where their words stand one after the other, all others also
    where most of them do."""

    label: str
    text: str
    base: bool = False


BASE = [
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
]
# Notices of public licenses, as their publishers word them.
NOTICES = [
    Template("apache", "Licensed under the Apache License, Version 2.0"),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
                    " that the following conditions are met"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    Template("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    Template("gpl", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
                    " General Public License as published by the Free Software Foundation"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
                    " associated documentation files"),
    Template("mit", "Released under the MIT License"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]


def _words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8").lower())


def _grams(words: list[bytes], sizes: list[int]) -> np.ndarray:
    """The hashes of all k-grams, for each size in turn, rolled from the hashes of words."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out, rolled = [], np.zeros(len(words), np.uint64)
    for k in range(1, max(sizes) + 1):
        rolled = rolled[:max(0, len(words) - k + 1)]
        rolled = (rolled ^ hashes[k - 1:]) * np.uint64(ODD)
        rolled ^= rolled >> np.uint64(31)
        if k in sizes:
            out.append(rolled ^ np.uint64(k))
    return out


def needed(m: int) -> int:
    """How many of a template's ``m`` words a place must hold in order."""
    return -(-m * LEAST_PERCENT // 100)


def put_in(m: int) -> int:
    """How many other words may stand between those of a template of ``m`` words."""
    return max(1, m // 4)


def gram(m: int, base: bool) -> int:
    """The greatest k up to GRAM of which a k-gram is whole in every place: words missing and put in break what is left of
    the template into at most so many runs, one of which has k words."""
    runs = m - needed(m) + put_in(m) + 1
    return min(GRAM, m) if base else next(k for k in range(GRAM, 0, -1) if k == 1 or needed(m) > (k - 1) * runs)


def _gram(template: Template) -> int:
    return gram(len(_words(template.text)), template.base)


def _sizes(templates: list[Template]) -> list[int]:
    return sorted({_gram(t) for t in templates})


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """(hash, template, at) of all k-grams of the templates; a template without words is refused."""
    rows = []
    for number, template in enumerate(templates):
        words = _words(template.text)
        if not words:
            raise ValueError(f"template {template.label!r} has no words")
        grams = _grams(words, [_gram(template)])[0]
        rows += [(h, number, at) for at, h in enumerate(grams.view(np.int64).tolist())]
    grams = spark.createDataFrame(rows, "hash long, template int, at int")
    return F.broadcast(grams) if len(rows) <= BROADCAST_ROWS else grams.hint("merge")


def _positions(sizes: list[int]):
    """Per text its number of words and the hashes of all k-grams, those of one size after those of the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                lists, counts = [np.empty(0, np.int64)], []
                for text in part["text"].to_pylist():
                    words = _words(text)
                    grams = np.concatenate(_grams(words, sizes)) if words else np.empty(0, np.uint64)
                    lists.append(grams.view(np.int64))
                    counts.append(len(words))
                offsets = pa.array(np.cumsum([len(g) for g in lists]), pa.int32())
                grams = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([part["k1"], part["k2"], pa.array(counts, pa.int64()), grams], ["k1", "k2", "n", "grams"])

    return run


def _place(words: list[bytes], template: list[bytes]) -> tuple[int, int, int] | None:
    """(words in common order, begin, end) of the place that holds most of the template, the earliest among equals; None
    where no place holds enough of it."""
    m, best = len(template), None
    at = {w: [j for j in range(m) if template[j] == w] for w in set(template)}
    # start[j, n]: the latest start of n words in common order with the template's first j; -1 where there are none.
    start = np.full((m + 1, m + 1), -1, np.int64)
    for i, word in enumerate(words):
        if word not in at:
            continue
        start[:, 0] = i
        before = start.copy()
        for j in at[word]:
            np.maximum(start[j + 1, 1:], before[j, :-1], out=start[j + 1, 1:])
        np.maximum.accumulate(start, axis=0, out=start)
        for n in range(m, max(needed(m) - 1, best[0] if best else 0), -1):
            if start[m, n] >= 0 and i + 1 - start[m, n] - n <= put_in(m):
                best = (n, int(start[m, n]), i + 1)
                break
    return best


def _verified(words: list[bytes], template: list[bytes], base: bool, begin: int, end: int) -> list[tuple[int, int, float]]:
    """(begin, end, share) of the places in the span and, but for base templates, its margins."""
    m = len(template)
    if base:
        begin, end = max(0, begin), min(len(words), end)
        return [(i, i + m, 1.0) for i in range(begin, end - m + 1) if words[i:i + m] == template]
    begin, end = max(0, begin - put_in(m)), min(len(words), end + put_in(m))
    # A place has at most so many words; a longer span is searched piece by piece, each of which reaches into the next.
    width, places, known = m + put_in(m), [], set(template)
    for at in range(begin, max(begin + 1, end - width), width):
        part = words[at:min(end, at + 2 * width)]
        if sum(w in known for w in part) < needed(m):
            continue
        if found := _place(part, template):
            places.append((at + found[1], at + found[2], found[0] / m))
    return places


def _verify(templates: list[Template], texts: Column, spans: Column) -> Column:
    sought = [(_words(t.text), t.base) for t in templates]

    @pandas_udf("n_words long, places array<struct<template: int, begin: long, stop: long, share: double>>")
    def of(texts: pd.Series, lists: pd.Series) -> pd.DataFrame:
        out = []
        for text, spans in zip(texts, lists):
            words, places = _words(text), set()
            for span in () if spans is None else spans:
                number = span["template"]
                for place in _verified(words, *sought[number], span["begin"], span["stop"]):
                    places.add((number, *place))
            out.append((len(words), [dict(zip(("template", "begin", "stop", "share"), p)) for p in sorted(places)]))
        return pd.DataFrame(out, columns=["n_words", "places"])

    return of(texts, spans)


def _keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def spans_of(docs: DataFrame, templates: list[Template], text: str) -> DataFrame:
    """(k1, k2, spans): for texts with enough votes, what to verify: array of (template, begin, stop)."""
    sizes = _sizes(templates)
    lengths = [len(_words(t.text)) for t in templates]
    texts = short_batches(docs).select(*_keys(F.col(text)), F.col(text).alias("text"))
    rows = texts.mapInArrow(_positions(sizes), "k1 long, k2 long, n long, grams array<long>")
    spread = rows.select("k1", "k2", "n", F.posexplode("grams").alias("place", "hash"))
    hits = spread.join(template_grams(docs.sparkSession, templates), "hash")

    def per_template(values: list[int]) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("template"))

    size, length = per_template([_gram(t) for t in templates]), per_template(lengths)
    # The k-grams of smaller sizes stand before those of the template's size.
    before = F.lit(0)
    for k in sizes:
        before = before + F.when(size > k, F.greatest(F.lit(0), F.col("n") - k + 1)).otherwise(0)
    diagonal = F.col("place") - before - F.col("at")
    group = ["k1", "k2", "template"]
    votes = hits.select(*group, diagonal.alias("diagonal"), "at").distinct()
    votes = votes.groupBy(*group, "diagonal").agg(F.count("*").alias("votes"))
    order = Window.partitionBy(*group).orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(order) > DRIFT
    votes = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    merged = votes.withColumn("island", F.sum("new").over(order)).groupBy(*group, "island").agg(
        F.min("diagonal").alias("begin"), (F.max("diagonal") + length).alias("stop"), F.sum("votes").alias("votes")
    )
    # A base template has all its k-grams whole, any other one at least one.
    enough = merged.where(F.col("votes") >= per_template([m - _gram(t) + 1 if t.base else 1 for t, m in zip(templates, lengths)]))
    return enough.groupBy("k1", "k2").agg(F.collect_list(F.struct("template", "begin", "stop")).alias("spans"))


def scan(docs: DataFrame, templates: list[Template], text: str = "text") -> DataFrame:
    """``docs`` with ``scan`` (``_scan`` where there is such a column), a struct of n_words and ``places``, the verified spans: array of (template, begin, stop,
    share), where ``template`` is the number in the list, [begin, stop) are words from 0 and ``share`` is that of the
    template's words.

    NULL and empty texts have no words and no places; repeated rows have their places each; overlapping places of
    different templates are all given. An empty table gives no rows.
    """
    into, *names = fresh_name(docs, "scan", "k1", "k2", "spans")
    spans = stage(spans_of(docs, templates, text)).toDF(*names)
    k1, k2 = _keys(docs[text])
    # The spans grow with the corpus, so this join shuffles at every size.
    found = docs.join(spans.hint("merge"), (k1 == spans[names[0]]) & (k2 == spans[names[1]]), "left")
    return found.withColumn(into, _verify(templates, F.col(text), F.col(names[2]))).drop(*names)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    templates = BASE + NOTICES
    found = scan(load(spark, sf_dir, "documents").select("doc_id", "text"), templates)
    names = F.array(*[F.lit(t.label) for t in templates])
    places = F.col("scan.places")
    base = F.filter(places, lambda p: p["template"] < len(BASE))

    def labels(of: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: F.get(names, p["template"])))), ",")

    starts = F.transform(base, lambda p: p["begin"])
    return found.select(
        "doc_id",
        F.col("scan.n_words").alias("n_words"),
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(places).alias("labels"),
        F.coalesce(F.array_max(F.transform(places, lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )
