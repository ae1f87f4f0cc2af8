"""License scans by diagonal voting.

Words are runs of ASCII letters and digits (lower-cased) and of anything beyond
ASCII. Base phrases are found word by word. Beyond them, the hashes of all
rolling five-word grams of every text are joined with the positions of the
same grams in a fixed set of license templates. A hit votes for its diagonal
(text position less template position); diagonals that differ by a few words
and follow each other are merged, so small insertions and omissions don't
break a match, and a merged span counts if the grams in it cover at least 0.8
of the template's words.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import small_batches, table, whole_texts

K, SIMILAR, DRIFT = 5, 0.8, 3
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: label -> passages in the wording of public license notices. Their number is fixed, so their grams are broadcast.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "This project is licensed under the terms of the MIT license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
]

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
SCANNED = "doc_id long, key binary, n_words long, n_base long, first_word long, last_word long, base array<string>"


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").lower())  # bytes.lower knows A-Z alone


class Words:
    """64-bit hashes of words, those met last kept."""

    def __init__(self, size: int = 100_000):
        self.memo: dict[bytes, int] = {}
        self.size = size

    def hashes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > self.size:
            memo.clear()
        out = []
        for w in words:
            h = memo.get(w)
            if h is None:
                h = memo[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
            out.append(h)
        return np.array(out, np.uint64)


def gram_hashes(words: list[bytes], known: Words) -> np.ndarray:
    h, n = known.hashes(words), len(words) - K + 1
    if n < 1:
        return np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(K):
        total += h[k : k + n] * _MIX[k]
        total ^= total >> np.uint64(29)
    return total.view(np.int64)


def template_grams(templates: list[tuple[str, str]]) -> list[tuple[int, str, int, int, int]]:
    """(template, label, its words, position, gram hash) of templates of K words or more."""
    known, out = Words(), []
    for t, (label, text) in enumerate(templates):
        w = words_of(text)
        out += [(t, label, len(w), p, int(h)) for p, h in enumerate(gram_hashes(w, known))]
    return out


def key_of(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8"), digest_size=16).digest()


def base_scan(words: list[bytes]) -> tuple[int, int | None, int | None, list[str]]:
    """Places of the base phrases: how many, the first and last word, their labels."""
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        want = [w.encode() for w in phrase.split()]
        rare, at = want[-1], -1
        while True:
            try:
                at = words.index(rare, at + 1)
            except ValueError:
                break
            start = at - len(want) + 1
            if start >= 0 and words[start : at + 1] == want:
                places.append(start)
                labels.add(label)
    return len(places), min(places, default=None), max(places, default=None), sorted(labels)


def spans(texts: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Verified spans: (key, label, first_word, end_word, score) for (key, gram hashes) of every text.

    Only hits leave the scan: the templates' grams are broadcast, being a fixed
    list. Copies of a text share a key and their hits are merged map-side.
    """
    spark = texts.sparkSession
    grams = spark.createDataFrame(template_grams(templates or TEMPLATES), "template int, label string, size int, tpos int, gram long")

    def roll(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            texts_, room = batch.column(0).to_pylist(), 200_000
            keys, pos, found = [], [], []
            for text in texts_:
                h = gram_hashes(words_of(text), known)
                if len(h):
                    keys.append((key_of(text), len(h)))
                    pos.append(np.arange(len(h), dtype=np.int32))
                    found.append(h)
                    room -= len(h)
                if room < 0:
                    yield rolled(keys, pos, found)
                    keys, pos, found, room = [], [], [], 200_000
            if keys:
                yield rolled(keys, pos, found)

    def rolled(keys: list, pos: list, found: list) -> pa.RecordBatch:
        column = pa.DictionaryArray.from_arrays(pa.array(np.repeat(np.arange(len(keys), dtype=np.int32), [n for _, n in keys])), pa.array([k for k, _ in keys], pa.binary()))
        return pa.RecordBatch.from_arrays([column.dictionary_decode(), pa.array(np.concatenate(pos)), pa.array(np.concatenate(found))], names=["key", "wpos", "gram"])

    rolling = texts.select("text").mapInArrow(roll, "key binary, wpos int, gram long")
    hits = rolling.join(F.broadcast(grams), "gram").select("key", "template", "label", "size", "wpos", "tpos").distinct()
    diagonal = F.col("wpos") - F.col("tpos")
    votes = hits.groupBy("key", "template", "label", "size", diagonal.alias("diagonal")).agg(F.min("wpos").alias("first"), (F.max("wpos") + K).alias("end"), F.sort_array(F.collect_set("tpos")).alias("tpos"))
    # neighbouring diagonals of one template, close in the text, belong to one match
    order = Window.partitionBy("key", "template").orderBy("first", "diagonal")
    near = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) <= DRIFT) & (F.col("first") - F.lag("end").over(order) <= DRIFT)
    runs = votes.withColumn("new", F.when(near, 0).otherwise(1)).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = runs.groupBy("key", "template", "label", "size", "run").agg(F.min("first").alias("first_word"), F.max("end").alias("end_word"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("tpos")))).alias("tpos"))
    # words of the template that grams cover: each gram K of them, less what it shares with the one before
    covered = F.aggregate("tpos", F.struct(F.lit(-K).alias("last"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("last"), (a.n + F.least(p - a.last, F.lit(K))).alias("n"))).n
    scored = merged.withColumn("score", covered / F.col("size"))
    return scored.filter(F.col("score") >= SIMILAR).select("key", "label", "first_word", "end_word", "score")


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """Counts of base phrases and labels of every document.

    ``score`` is 1 where a base phrase stands, else the best cover of a
    template, else 0. Null and empty texts have no words, no labels and null
    first and last words; repeated rows and null ids give a row each; an empty
    table gives none.
    """
    small_batches(docs.sparkSession)
    texts = whole_texts(docs)

    def base(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                w = words_of(text)
                rows.append((key_of(text), len(w), *base_scan(w)))
            if rows:
                kinds = [pa.binary(), *[pa.int64()] * 4, pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names=[x.split()[0] for x in SCANNED.split(", ")])

    found = spans(texts, templates).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    all_labels = F.array_sort(F.array_union("base", F.coalesce("more", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    out = texts.mapInArrow(base, SCANNED).join(found, "key", "left")
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(all_labels, ",").alias("labels"), score.alias("score"))


def op6_license_diagonals(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
