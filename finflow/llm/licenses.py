"""License scan by diagonal voting.

Every rolling word k-gram of every text is hashed and joined by Spark with the
positions of the same gram in the templates. A hit votes for a diagonal, the
position in the text minus that in the template: an unbroken copy of a template
puts all its votes on one diagonal, an edited one on neighbouring diagonals.
Votes are counted by document, template and diagonal, diagonals at most
``DRIFT`` words apart are merged, and a merged span is verified by the share of
the template's words and of its own words that the votes cover.

The templates are a constant of the job (a few thousand positions), so they are
sent to all tasks and only hits are shuffled. A text comes as an array of
hashes in blocks of ``BLOCK`` words.

Edge cases. Null and empty texts have no words and no labels (score 0).
A document is an id with a text: repeated rows get the same answer each, rows of
one id with different texts their own. Null ids are kept. Equal votes are
counted once; equal scores need no order, labels are sorted. Further columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finflow.llm import words as w

BLOCK = 1 << 16
DRIFT = 4
# Words between two spans of one template that may be parts of one copy, and the share of the template that makes a part.
GAP, PART_SHARE = 60, 0.04
# Shares of the template's words and of the words from first to last that votes must cover.
TEMPLATE_SHARE, SPAN_SHARE = 0.6, 0.6
# Words of a gram: phrases are taken whole and short, license bodies by longer grams.
PHRASE_GRAM, BODY_GRAM = 2, 4


@dataclass(frozen=True)
class Template:
    name: str
    label: str
    text: str
    exact: bool = False

    @property
    def gram(self) -> int:
        return PHRASE_GRAM if self.exact else BODY_GRAM


# The phrases of the contract, taken only where they stand whole.
PHRASES = (
    Template("phrase mit", "mit", "mit license", exact=True),
    Template("phrase apache", "apache", "apache license", exact=True),
    Template("phrase gpl", "gpl", "general public license", exact=True),
)

# Public license texts and notices.
BODIES = (
    Template(
        "mit body", "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software.",
    ),
    Template(
        "apache notice", "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
        "and limitations under the License.",
    ),
    Template("apache line", "apache", "Licensed under the Apache License, Version 2.0"),
    Template("mit line", "mit", "Released under the MIT License"),
    Template(
        "gpl notice", "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    ),
    Template("gpl line", "gpl", "licensed under the GNU General Public License"),
    Template(
        "bsd body", "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer.",
    ),
    Template(
        "isc body", "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    Template(
        "mpl notice", "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    Template(
        "unlicense body", "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software.",
    ),
    Template("cc by line", "cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc by-nc line", "cc-by-nc", "Licensed under CC BY-NC 4.0"),
    Template("all rights line", "proprietary", "All rights reserved. No part of this may be reproduced without permission"),
)

TEMPLATES = PHRASES + BODIES


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[w.Words, np.ndarray]:
    lowered = w.LOWER[data]
    found = w.find_words(lowered, offsets, w.ALPHANUMERIC)
    return found, w.hash_words(lowered, found)


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of grams of ``size`` words, apart from those of other sizes."""
    return w.mix(w.window_hashes(h, size) + np.uint64(size))


def template_positions(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """``gram, template, label, exact, at, grams, n``: each gram of each template."""
    rows = []
    for t in templates:
        raw = np.frombuffer(t.text.encode(), np.uint8)
        h = _hashes(raw, np.array([0, len(raw)]))[1]
        grams = _grams(h, t.gram).view(np.int64)
        rows += [(int(g), t.name, t.label, t.exact, t.gram, i, len(grams), len(h)) for i, g in enumerate(grams)]
    schema = "gram long, template string, label string, exact boolean, size int, at long, grams int, n int"
    return spark.createDataFrame(rows, schema)


def text_grams(docs: DataFrame, sizes: Sequence[int] = (PHRASE_GRAM, BODY_GRAM)) -> DataFrame:
    """``doc_id, row, first, grams``: gram hashes of a block of words, the sizes taking turns (0 where a gram would not fit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            for a, b in w.runs(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                found, h = _hashes(part, own)
                grams = np.zeros((len(h), len(sizes)), np.uint64)
                for k, size in enumerate(sizes):
                    if len(h) >= size:
                        grams[: len(h) - size + 1, k] = _grams(h, size)
                    grams[~w.window_starts(found, size), k] = 0
                # Blocks of each text: bounds in words.
                blocks = -(-found.counts // BLOCK)
                owner = np.repeat(np.arange(b - a), blocks)
                place = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                begin = found.offsets[owner] + place * BLOCK
                bounds = np.append(begin, found.offsets[-1])
                lists = pa.ListArray.from_arrays(
                    pa.array((bounds * len(sizes)).astype(np.int32)), pa.array(grams.view(np.int64).ravel())
                )
                keys = _row_keys(part, own)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids[a:b].take(pa.array(owner)),
                        "row": pa.array(keys[owner]),
                        "first": pa.array(place * BLOCK, pa.int64()),
                        "grams": lists,
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, row long, first long, grams array<long>")


def _row_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits that name each text."""
    raw = data.tobytes()
    names = [hashlib.blake2b(raw[i:j], digest_size=8).digest() for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
    return np.frombuffer(b"".join(names), np.int64)


def text_sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n_words`` of every row."""

    def run(batches):
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            for a, b in w.runs(offsets):
                part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                found = w.find_words(w.LOWER[part], own, w.ALPHANUMERIC)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": ids[a:b], "row": pa.array(_row_keys(part, own)), "n_words": pa.array(found.counts, pa.int64())}
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, row long, n_words long")


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Verified spans: ``doc_id, row, template, label, exact, first, last, score``, words from 0, ``last`` inclusive."""
    sizes = (PHRASE_GRAM, BODY_GRAM)
    grams = text_grams(docs, sizes).select("doc_id", "row", "first", F.posexplode("grams").alias("i", "gram"))
    position = F.col("first") + F.floor(F.col("i") / len(sizes))
    hits = grams.join(F.broadcast(template_positions(docs.sparkSession, templates)), "gram").select(
        "doc_id", "row", "template", "label", "exact", "size", "grams", "n", "at",
        position.alias("place"), (position - F.col("at")).alias("diagonal"),
    )

    template = ["doc_id", "row", "template", "label", "exact", "size", "grams", "n"]
    votes = hits.groupBy(*template, "diagonal").agg(F.collect_set("at").alias("ats"))  # a template's length at most
    whole = votes.where("exact and size(ats) = grams").select(
        *template, F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("n") - 1).alias("last"), F.lit(1.0).alias("score")
    )

    # Neighbouring diagonals of one document and template: as many as its words at most.
    along = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    bodies = votes.where("not exact")
    breaks = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT, F.lit(True)).cast("int")
    merged = (
        bodies.withColumn("_break", breaks)
        .withColumn("_span", F.sum("_break").over(along))
        .select(*template, "_span", "diagonal", F.explode("ats").alias("at"))
        .select(*template, "_span", "at", (F.col("at") + F.col("diagonal")).alias("place"))
        .groupBy(*template, "_span")
        .agg(
            F.min("place").alias("first"),
            (F.max("place") + F.first("size") - 1).alias("last"),
            F.collect_set("at").alias("ats"),
            F.collect_set("place").alias("places"),
        )
    )
    # A copy with words put in between is several spans: each goes on in the template where the one before ended.
    covered = lambda name: F.size(F.array_distinct(F.flatten(F.transform(name, lambda p: F.sequence(p, p + F.col("size") - 1)))))
    parts = merged.where(covered("ats") >= PART_SHARE * F.col("n"))
    in_text = Window.partitionBy("doc_id", "row", "template").orderBy("first", "_span")
    before = lambda c: F.lag(c).over(in_text)
    goes_on = (F.col("first") - before(F.col("last")) <= GAP) & (F.array_min("ats") >= before(F.array_max("ats")) - DRIFT)
    copies = (
        parts.withColumn("_break", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
        .withColumn("_copy", F.sum("_break").over(in_text))
        .groupBy(*template, "_copy")
        .agg(
            F.min("first").alias("first"), F.max("last").alias("last"),
            F.flatten(F.collect_list("ats")).alias("ats"), F.flatten(F.collect_list("places")).alias("places"),
        )
    )
    of_template = covered("ats") / F.col("n")
    of_span = covered("places") / (F.col("last") - F.col("first") + 1)
    verified = (
        copies.withColumn("_t", of_template).withColumn("_s", of_span)
        .where((F.col("_t") >= TEMPLATE_SHARE) & (F.col("_s") >= SPAN_SHARE))
        .select(*template, "first", "last", (F.col("_t") * F.col("_s")).alias("score"))
    )
    return whole.unionByName(verified).select("doc_id", "row", "template", "label", "exact", "first", "last", "score")


def scan_licenses(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """Per document: words, places of the exact phrases, their labels and all labels, best score."""
    base = F.when(F.col("exact"), F.col("label"))
    found = (
        license_spans(docs, templates).groupBy("doc_id", "row")
        .agg(
            F.count(F.when(F.col("exact"), 1)).alias("n_base"),
            F.min(F.when(F.col("exact"), F.col("first"))).alias("first_word"),
            F.max(F.when(F.col("exact"), F.col("first"))).alias("last_word"),
            F.array_join(F.array_sort(F.collect_set(base)), ",").alias("base_labels"),
            F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
            F.max("score").alias("score"),
        )
    )
    sizes = text_sizes(docs)
    found = found.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    joined = sizes.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
