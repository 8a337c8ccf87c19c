"""Benchmark decontamination over a positional inverted index.

``build_index`` packs texts into shards and stores, for each shard, the
postings of its terms: term hashes in order, and per term the ascending word
positions. Shards cut the index by document, so a phrase is answered inside a
shard and no posting is shuffled; the index is written once to the shared
folder and serves any number of query sets.

A phrase is found by intersecting offset-adjusted postings, beginning with the
phrase's rarest terms in the whole corpus (their counts are one aggregate over
the index, limited to the terms asked for). Proximity matches ask that all
terms of the phrase occur within a number of words of its rarest term.

The query set is given in blocks of ``block_items`` items, one pass over the
index each, so what a task is sent does not grow with the query table. With a
``vocabulary`` the index keeps the postings of those terms only.

Edge cases. Null and empty texts have no words: such a document is never hit,
such an item never occurs. Items of fewer words than a window are one window.
Equal windows of several items count for each of them. A document is the row it
stands in; repeated rows and null ids get a row each. An item with a null id is
not asked for. Repeated items count once. Further columns are ignored. Empty
tables give no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm import words as w
from finflow.llm.store import small_batches, stored

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_ITEMS = 5_000
# Greatest distance, in words, of the terms of a proximity match from the rarest one.
NEAR = 2 * WINDOW

_INDEX = "shard long, ids binary, known binary, rows binary, counts binary, terms binary, sizes binary, steps binary"


def _hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[w.Words, np.ndarray]:
    found = w.find_words(data, offsets, w.ALPHANUMERIC)
    return found, w.hash_words(data, found)


def tokenized(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, and the number of words of each."""
    hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in w.runs(offsets):
        part = w.LOWER[data[offsets[a] : offsets[b]]]
        found, h = _hashes(part, offsets[a : b + 1] - offsets[a])
        hashes.append(h)
        counts.append(found.counts)
    return np.concatenate(hashes), np.concatenate(counts).astype(np.int64)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored index of ``docs``: a row per shard. ``vocabulary``: sorted hashes of the terms to keep.

    A column ``row`` of whole numbers, if there is one, is kept with each document.
    """
    row = F.col("row").cast("long") if "row" in docs.columns else F.lit(0).cast("long")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
            rows = batch.column(batch.schema.get_field_index("row")).fill_null(0).to_numpy(zero_copy_only=False)
            for a, b in w.runs(offsets, shard_bytes):
                hashes, counts = tokenized(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                at = np.arange(len(hashes))
                if vocabulary is not None:
                    at = at[_member(vocabulary, hashes)]
                order = at[np.argsort(hashes[at], kind="stable")]
                term = hashes[order]
                first = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else at
                steps = np.diff(order, prepend=0)
                steps[first] = order[first]
                binary = lambda v, kind: pa.array([np.ascontiguousarray(v, dtype=kind).tobytes()], pa.binary())
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([number], pa.int64()),
                        "ids": binary(ids[a:b], np.int64),
                        "known": binary(known[a:b], bool),
                        "rows": binary(rows[a:b], np.int64),
                        "counts": binary(counts, np.int64),
                        "terms": binary(term[first], np.uint64),
                        "sizes": binary(np.diff(np.append(first, len(term))), np.uint32),
                        "steps": binary(steps, np.uint32),
                    }
                )
                number += 1

    return stored(docs.select("doc_id", "text", row.alias("row")).mapInArrow(build, _INDEX), "postings")


def _member(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


@dataclass
class Shard:
    """Postings of one shard as sorted ``rank << 32 | position`` keys over the terms asked for."""

    ids: np.ndarray
    known: np.ndarray
    bounds: np.ndarray
    keys: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, row: dict, asked: np.ndarray) -> Shard:
        """``asked``: sorted term hashes; a term's rank is its place there."""
        terms, sizes = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
        steps = np.frombuffer(row["steps"], np.uint32)
        keep = _member(asked, terms)
        rank = np.searchsorted(asked, terms[keep])
        pick = np.repeat(keep, sizes)
        steps, length = steps[pick].astype(np.int64), sizes[keep]
        total = np.cumsum(steps)
        begin = np.append(0, np.cumsum(length))[:-1]
        base = total[begin] - steps[begin] if len(begin) else begin
        position = total - np.repeat(base, length)
        keys = (np.repeat(rank, length).astype(np.int64) << 32) | position
        counts = np.frombuffer(row["counts"], np.int64)
        starts = np.searchsorted(keys, np.arange(len(asked) + 1, dtype=np.int64) << 32)
        return cls(
            np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool), np.append(0, np.cumsum(counts)), keys, starts
        )

    def postings(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of each of ``ranks`` in turn, and the place in ``ranks`` each belongs to."""
        size = self.starts[ranks + 1] - self.starts[ranks]
        which = np.repeat(np.arange(len(ranks)), size)
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.starts[ranks], size)
        return self.keys[at] & 0xFFFFFFFF, which

    def has(self, ranks: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Does the term of ``rank`` stand at ``position``?"""
        return _member(self.keys, (ranks.astype(np.int64) << 32) | positions) & (positions >= 0)

    def near(self, ranks: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Does the term of ``rank`` stand anywhere from ``low`` to ``high``?"""
        rank = ranks.astype(np.int64) << 32
        return np.searchsorted(self.keys, rank | np.maximum(low, 0)) < np.searchsorted(self.keys, rank | np.maximum(high, 0), "right")


@dataclass
class Phrases:
    """Distinct windows of a block of items: term ranks in phrase order, -1 beyond the end."""

    asked: np.ndarray
    terms: np.ndarray
    lengths: np.ndarray
    by_rarity: np.ndarray
    items: list[list[str]]

    @classmethod
    def of(cls, texts: list[tuple[str, str]], window: int, counts: dict[int, int]) -> Phrases:
        windows: dict[bytes, set] = {}
        for item, text in texts:
            h = term_hashes(text)
            for i in range(max(1, len(h) - window + 1) if len(h) else 0):
                windows.setdefault(h[i : i + window].tobytes(), set()).add(item)
        rows = [np.frombuffer(k, np.uint64) for k in windows]
        asked = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.uint64)
        terms = np.full((len(rows), window), -1, np.int64)
        for i, row in enumerate(rows):
            terms[i, : len(row)] = np.searchsorted(asked, row)
        frequency = np.array([counts.get(int(t), 0) for t in asked.view(np.int64)], np.int64)
        weight = np.where(terms >= 0, frequency[terms] if len(asked) else 0, np.iinfo(np.int64).max)
        return cls(asked, terms, (terms >= 0).sum(1), np.argsort(weight, axis=1, kind="stable"), [sorted(s, key=lambda i: (i is not None, i)) for s in windows.values()])


def term_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return tokenized(data, np.array([0, len(data)], np.int64))[0]


def phrase_places(shard: Shard, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """``(phrase, position)`` of every exact occurrence inside one text."""
    if not len(phrases.terms):
        return np.zeros(0, int), np.zeros(0, int)
    rarest = phrases.by_rarity[:, 0]
    found, which = shard.postings(phrases.terms[np.arange(len(rarest)), rarest])
    start = found - rarest[which]
    for k in range(1, phrases.terms.shape[1]):
        offset = phrases.by_rarity[which, k]
        rank = phrases.terms[which, offset]
        keep = (rank < 0) | shard.has(rank, start + offset)
        which, start = which[keep], start[keep]
    keep = start >= 0
    which, start = which[keep], start[keep]
    doc = np.searchsorted(shard.bounds, start, "right") - 1
    keep = start + phrases.lengths[which] <= shard.bounds[doc + 1]
    return which[keep], start[keep]


def near_places(shard: Shard, phrases: Phrases, within: int) -> tuple[np.ndarray, np.ndarray]:
    """``(phrase, position of its rarest term)`` where all its terms stand within ``within`` words of it in one text."""
    if not len(phrases.terms):
        return np.zeros(0, int), np.zeros(0, int)
    rarest = phrases.by_rarity[:, 0]
    at, which = shard.postings(phrases.terms[np.arange(len(rarest)), rarest])
    doc = np.searchsorted(shard.bounds, at, "right") - 1
    low, high = np.maximum(at - within, shard.bounds[doc]), np.minimum(at + within, shard.bounds[doc + 1] - 1)
    for k in range(1, phrases.terms.shape[1]):
        rank = phrases.terms[which, phrases.by_rarity[which, k]]
        keep = (rank < 0) | shard.near(rank, low, high)
        at, which, low, high = at[keep], which[keep], low[keep], high[keep]
    return which, at


def _in_blocks(items: DataFrame, block_items: int) -> Iterator[list[tuple[str, str]]]:
    block: list[tuple[str, str]] = []
    rows = items.where("text is not null").select(F.col("item_id").cast("string"), "text").distinct()
    for row in rows.toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == block_items:
            yield block
            block = []
    if block:
        yield block


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def term_counts(index: DataFrame, asked: np.ndarray) -> dict[int, int]:
    """Occurrences in the whole index of each of the ``asked`` terms."""

    def count(batches):
        total = np.zeros(len(asked), np.int64)
        for row in _index_rows(batches):
            terms, sizes = np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["sizes"], np.uint32)
            keep = _member(asked, terms)
            total[np.searchsorted(asked, terms[keep])] += sizes[keep]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(asked[some].view(np.int64)), "n": pa.array(total[some])})

    counted = index.select("terms", "sizes").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in counted.collect()}  # the terms of one block of items at most


def matches(
    index: DataFrame, items: DataFrame, window: int = WINDOW, within: int = NEAR, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Exact and proximity matches: ``shard, doc, doc_id, item_id, kind, place, length``.

    ``place`` counts words from 0 in the document: the start of an exact window
    (kind ``phrase``), or the rarest term of a proximity match (``near``).
    """
    found = None
    for block in _in_blocks(items, block_items):
        asked = np.unique(np.concatenate([term_hashes(t) for _, t in block]))
        phrases = Phrases.of(block, window, term_counts(index, asked))

        def look(batches, phrases=phrases):
            for row in _index_rows(batches):
                shard = Shard.of(row, phrases.asked)
                parts = [(*phrase_places(shard, phrases), "phrase"), (*near_places(shard, phrases, within), "near")]
                for which, at, kind in parts:
                    doc = np.searchsorted(shard.bounds, at, "right") - 1
                    names = [phrases.items[i] for i in which]
                    again = np.array([len(n) for n in names], int)
                    spread = np.repeat(np.arange(len(at)), again)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": pa.array(np.full(len(spread), row["shard"]), pa.int64()),
                            "doc": pa.array(doc[spread].astype(np.int32)),
                            "doc_id": pa.array(shard.ids[doc][spread], pa.int64(), mask=~shard.known[doc][spread]),
                            "item_id": pa.array([n for many in names for n in many], pa.string()),
                            "kind": pa.array([kind] * len(spread), pa.string()),
                            "place": pa.array((at - shard.bounds[doc])[spread], pa.int64()),
                            "length": pa.array(phrases.lengths[which][spread], pa.int64()),
                        }
                    )

        part = index.mapInArrow(
            look, "shard long, doc int, doc_id long, item_id string, kind string, place long, length long"
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        empty = "shard long, doc int, doc_id long, item_id string, kind string, place long, length long"
        found = index.sparkSession.createDataFrame([], empty)
    return found


def indexed_documents(index: DataFrame) -> DataFrame:
    """``shard, doc, doc_id, row, n_words`` of every document of the index."""

    def unpack(batches):
        for row in _index_rows(batches):
            ids, known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array(np.full(len(ids), row["shard"]), pa.int64()),
                    "doc": pa.array(np.arange(len(ids)), pa.int32()),
                    "doc_id": pa.array(ids, pa.int64(), mask=~known),
                    "row": pa.array(np.frombuffer(row["rows"], np.int64)),
                    "n_words": pa.array(np.frombuffer(row["counts"], np.int64)),
                }
            )

    return index.select("shard", "ids", "known", "rows", "counts").mapInArrow(
        unpack, "shard long, doc int, doc_id long, row long, n_words long"
    )


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, within: int = NEAR, block_items: int = BLOCK_ITEMS
) -> DataFrame:
    """Per document: words, words inside an exact window, items found, and the verdict.

    Contaminated: a word is hit, and at least a twentieth of all words are.
    ``n_near`` counts items with a proximity match.
    """
    small_batches(docs.sparkSession)
    vocabulary = [np.zeros(0, np.uint64)]
    for block in _in_blocks(items, block_items):
        vocabulary.append(np.unique(np.concatenate([term_hashes(t) for _, t in block])))
    index = build_index(docs, np.unique(np.concatenate(vocabulary)))
    found = stored(matches(index, items, window, within, block_items), "matches")
    # A document has at most as many hit words and items as words, so its group is bounded by its text.
    key = ["shard", "doc"]
    phrase = found.where("kind = 'phrase'")
    hits = (
        phrase.select(*key, "place", "length").distinct()
        .select(*key, F.explode(F.sequence(F.col("place"), F.col("place") + F.col("length") - 1)).alias("word"))
        .distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit"))
    )
    # Items without an id hit words; there is nothing to name or count.
    names = phrase.where("item_id is not null").select(*key, "item_id").distinct().groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list("item_id")).alias("item_ids")
    )
    near = found.where("kind = 'near' and item_id is not null").select(*key, "item_id").distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_near"))
    none = F.lit(0).cast("long")
    joined = indexed_documents(index).join(hits, key, "left").join(names, key, "left").join(near, key, "left")
    return joined.select(
        "doc_id",
        "row",
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("n_near", none).alias("n_near"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
