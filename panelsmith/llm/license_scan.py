"""License scans: phrases at their places, and an exact set-similarity join of
text blocks with license templates.

A template of w words is looked for in blocks of 2L words that begin at every
L-th word, L the least power of two that is w or more: whatever stands in L
consecutive words lies whole in one block. A block meets a template when it
holds at least num / den of the template's distinct words.

The join is by words in the order of their frequency in the whole corpus,
rarest first. Of a set of s words that must share o with another, one of the
first s - o + 1 is shared (prefix filter); a block with fewer than o words of
any template of its size is none (length filter); and a pair whose first
shared words leave fewer than o to come is none (positional filter). What is
left is verified by intersection.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.llm.words import chunks, word_runs
from panelsmith.session import cut_lineage

#: Bytes of words: digits, letters and all beyond ASCII.
INSIDE = np.ones(256, dtype=bool)
INSIDE[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False
#: Least L.
LEAST_BLOCK = 8
#: Template words up to which the templates' side of the join is broadcast.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Template:
    """A license text; ``label`` is given to the blocks that meet it."""

    label: str
    text: str


# Label and words of the phrases.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))

# Notices as their licenses publish them, and the usual one-line forms.
TEMPLATES = (
    Template("mit", "Released under the MIT License."),
    Template(
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so",
    ),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template(
        "apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    Template(
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    Template(
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    Template(
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    Template("unlicense", "This is free and unencumbered software released into the public domain."),
)


def words_of(text: str) -> list[str]:
    return [w.decode() for w in word_runs(pa.array([text], pa.large_string()), INSIDE)[0].to_pylist()]


def block_step(n_words: int) -> int:
    """L for a template of ``n_words`` words."""
    return max(LEAST_BLOCK, 1 << (n_words - 1).bit_length())


class _Vocabulary:
    """The distinct words of phrases and templates, numbered in the order of
    ``frequency``, rarest first (equal ones by their bytes)."""

    def __init__(self, templates: Sequence[Template], phrases: Sequence[tuple[str, str]], num: int, den: int, frequency: dict):
        lists = [words_of(t.text) for t in templates]
        self.phrases = [(label, words_of(p)) for label, p in phrases]
        self.words = sorted(
            {w for ws in lists for w in ws} | {w for _, ws in self.phrases for w in ws}, key=lambda w: (frequency.get(w, 0), w.encode())
        )
        number = {w: i for i, w in enumerate(self.words)}
        self.phrases = [(label, [number[w] for w in ws]) for label, ws in self.phrases]
        #: template number, L, its numbers in order, least overlap
        self.templates = [
            (t, block_step(len(ws)), sorted({number[w] for w in ws}), -(-num * len(set(ws)) // den)) for t, ws in enumerate(lists) if ws
        ]

    def value_set(self) -> pa.Array:
        return pa.array([w.encode() for w in self.words], pa.large_binary())


def _count_words(vocabulary: _Vocabulary, text_col: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = vocabulary.value_set(), np.zeros(len(vocabulary.words) + 1, dtype=np.int64)
        for batch in batches:
            for part in chunks(batch, text_col):
                words, _ = word_runs(part.column(text_col), INSIDE)
                ids = pc.fill_null(pc.index_in(words, known), len(known)).to_numpy()
                total += np.bincount(ids, minlength=len(total))
        yield pa.record_batch([pa.array(vocabulary.words, pa.string()), pa.array(total[:-1])], names=["word", "n"])

    return count


def _places(ids: np.ndarray, text: np.ndarray, hits: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Where the numbers of ``phrase`` stand consecutively in one text."""
    at = hits[ids[hits] == phrase[0]]
    at = at[at + len(phrase) <= len(ids)]
    for k, number in enumerate(phrase[1:], 1):
        at = at[(ids[at + k] == number) & (text[at + k] == text[at])]
    return at


def _blocks(numbers: np.ndarray, text: np.ndarray, place: np.ndarray, step: int, prefix: np.ndarray, least: int):
    """Blocks that hold a word of ``prefix`` and at least ``least`` of the
    given words: text, block, start in and end of ``numbers`` (sorted,
    distinct). ``place`` counts words inside a text."""
    block = place // step
    two = np.concatenate([block, block[place >= step] - 1])
    key = (np.concatenate([text, text[place >= step]]).astype(np.int64) << 32) | two
    numbers = np.concatenate([numbers, numbers[place >= step]])
    rare = np.unique(key[prefix[numbers]])
    some = np.isin(key, rare)
    key, numbers = key[some], numbers[some]
    order = np.lexsort((numbers, key))
    key, numbers = key[order], numbers[order]
    first = np.ones(len(key), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (numbers[1:] != numbers[:-1])
    key, numbers = key[first], numbers[first]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    end = np.append(begin[1:], len(key))
    enough = end - begin >= least
    begin, end = begin[enough], end[enough]
    return key[begin] >> 32, key[begin] & 0xFFFFFFFF, begin, end, numbers


_OUT = (
    "row long, id {}, n_words long, phrases array<struct<label:string,word:long>>, "
    "blocks array<struct<step:int,block:long,numbers:array<int>>>"
)


def _find_blocks(vocabulary: _Vocabulary, text_col: str):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = vocabulary.value_set(), len(vocabulary.words)
        steps = []
        for step in sorted({t[1] for t in vocabulary.templates}):
            mine = [t for t in vocabulary.templates if t[1] == step]
            member, prefix = np.zeros(size + 1, dtype=bool), np.zeros(size + 1, dtype=bool)
            for _, _, numbers, least in mine:
                member[numbers] = True
                prefix[numbers[: len(numbers) - least + 1]] = True
            steps.append((step, member, prefix, min(t[3] for t in mine)))
        for batch in batches:
            for part in chunks(batch, text_col):
                words, bounds = word_runs(part.column(text_col), INSIDE)
                ids = pc.fill_null(pc.index_in(words, known), size).to_numpy()
                counts = np.diff(bounds)
                hits = np.flatnonzero(ids < size)
                text = np.repeat(np.arange(len(counts)), counts)
                phrases = [[] for _ in counts]
                for label, phrase in vocabulary.phrases:
                    for at in _places(ids, text, hits, phrase).tolist():
                        phrases[text[at]].append({"label": label, "word": at - int(bounds[text[at]])})
                blocks = [[] for _ in counts]
                for step, member, prefix, least in steps:
                    own = hits[member[ids[hits]]]
                    found = _blocks(ids[own], text[own], own - bounds[text[own]], step, prefix, least)
                    for t, b, begin, end in zip(*(x.tolist() for x in found[:4])):
                        blocks[t].append({"step": step, "block": b, "numbers": found[4][begin:end].tolist()})
                yield pa.record_batch(
                    [
                        part.column("row"),
                        part.column("id"),
                        pa.array(counts, pa.int64()),
                        pa.array(phrases, pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
                        pa.array(
                            blocks,
                            pa.list_(pa.struct([("step", pa.int32()), ("block", pa.int64()), ("numbers", pa.list_(pa.int32()))])),
                        ),
                    ],
                    names=["row", "id", "n_words", "phrases", "blocks"],
                )

    return find


def _join_templates(scanned: DataFrame, vocabulary: _Vocabulary) -> DataFrame:
    """row, label, template, word (where the block begins), n_shared, n_template
    of every block that meets a template."""
    spark = scanned.sparkSession
    sides = [
        (step, number, t, place, numbers, least)
        for t, step, numbers, least in vocabulary.templates
        for place, number in enumerate(numbers[: len(numbers) - least + 1])
    ]
    schema = "step int, number int, template int, t_place int, t_numbers array<int>, least int"
    table = spark.createDataFrame(sides, schema)
    table = F.broadcast(table) if sum(len(s[4]) for s in sides) <= BROADCAST_ROWS else table
    blocks = scanned.select("row", F.inline("blocks"))
    tokens = blocks.select("row", "step", "block", "numbers", F.posexplode("numbers").alias("place", "number"))
    met = tokens.join(table, ["step", "number"])
    size, least = F.size("numbers"), F.col("least")
    met = met.where(
        (F.col("place") <= size - least)  # prefix
        & (size >= least)  # length
        & (F.least(size - F.col("place"), F.size("t_numbers") - F.col("t_place")) >= least)  # position of the first shared word
    )
    kept = [F.first(c).alias(c) for c in ("numbers", "t_numbers", "least")]
    pairs = met.groupBy("row", "step", "block", "template").agg(*kept)
    shared = F.size(F.array_intersect("numbers", "t_numbers"))
    return pairs.withColumn("n_shared", shared).where("n_shared >= least").select(
        "row", "template", (F.col("block") * F.col("step")).alias("word"), "n_shared", F.size("t_numbers").alias("n_template")
    )


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    num: int = 90,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, n_words, phrases (array of
    label and word, the place of the phrase's first word from 0) and blocks
    (array of template, label, word, n_shared, n_template: every block that
    holds num / den of a template's distinct words, from its first word).

    A null text is empty: no words, empty arrays. Null ids and repeated rows
    keep their rows. Texts are read whole, whatever their length; a text
    shorter than a block is one block. Overlapping blocks that meet a template
    are listed each. Other columns are not read, so that names cannot clash;
    an empty table gives no rows. Templates and phrases are arguments of
    the driver; a template or phrase without words is never met."""
    if not 0 < num <= den:
        raise ValueError("need 0 < num <= den")
    phrases = [p for p in phrases if words_of(p[1])]
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    plain = _Vocabulary(templates, phrases, num, den, {})
    counted = texts.mapInArrow(_count_words(plain, "text"), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequency = {r[0]: r[1] for r in counted.collect()}  # one row per word of the templates
    vocabulary = _Vocabulary(templates, phrases, num, den, frequency)

    # rows are known by their place in the scan, so that ids may repeat
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = _OUT.format(rows.schema["id"].dataType.simpleString())
    kept = cut_lineage(rows.mapInArrow(_find_blocks(vocabulary, "text"), schema), "license-blocks")
    found = _join_templates(kept, vocabulary)
    names = spark.createDataFrame(list(enumerate(t.label for t in templates)), "template int, label string")
    found = found.join(F.broadcast(names), "template").groupBy("row")
    found = found.agg(F.sort_array(F.collect_list(F.struct("template", "word", "label", "n_shared", "n_template"))).alias("met"))
    none = F.array().cast("array<struct<template:int,word:bigint,label:string,n_shared:int,n_template:int>>")
    out = kept.select("row", "id", "n_words", "phrases").join(found, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_words", "phrases", F.coalesce("met", none).alias("blocks"))
