"""Substring dedup by level-wise doubling.

Words covered by a window of ``window`` words that also starts in a document of
a smaller id are removed. Windows found in two documents at one length are
extended to twice that length, and so on until no candidate survives, which
gives the longest repeat of each document.

How it is laid out. Texts are packed into chunks of a few megabytes and written
to the shared folder once. Per chunk and level, each distinct window hash is
sent once, sorted and grouped by hash range (*bucket*); the answer for a bucket
goes back to the chunk in the same order, so neither positions nor texts travel,
and a window that a third of all documents share is one entry per chunk. The
first level asks with hashes cut to the bits the corpus size calls for, which
only drops windows found once; the second, which decides what is removed, uses
96 bits. Longer windows are made of two repeated halves and compare 64 bits.

Sizes: a task holds one chunk or one bucket, and there are tasks for all buckets. Entries
per message are ``chunk words * bucket words / all words``, so both sizes grow with the
cube root of the corpus as the optimizer expects it: from 4 MB and a million words up to
a gigabyte of text, to 128 MB and 64 million at 32 TB and beyond.

Edge cases. Null and empty texts have no words. A row whose id is null neither
removes nor is removed from. Rows that share an id never remove from one
another. Ties (equal windows in many documents) keep the smallest id's words.
Further columns of the input are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finflow.llm import words as w
from finflow.llm.store import dropped, release, stored
from finflow.operators.layout import expected_bytes

WINDOW = 13
CHUNK_BYTES, MOST_CHUNK_BYTES = 4 << 20, 128 << 20
BUCKET_WORDS, MOST_BUCKET_WORDS = 1 << 20, 64 << 20
# The optimizer gives sizes beyond an exabyte to what it knows nothing of.
_UNKNOWN = 1 << 60
# Bits beyond log2(words) in the hashes of the first question: one window in 2^17 passes by chance.
SPARE_BITS = 17
NO_ID = np.iinfo(np.int64).max

_CHUNKS = "chunk long, ids binary, offsets binary, blob binary, raw long, n_words long"
# Windows of a chunk by position: steps between positions, 64 bits of hash, 32 more at the first level.
_STATE = "chunk long, ids binary, n_words binary, steps binary, ha binary, hb binary, n long"


def _packed_ids(ids: pa.Array | pa.ChunkedArray) -> bytes:
    """Ids, null as the largest number, which removes nothing; then a byte each: is there an id?"""
    return ids.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64).tobytes() + np.asarray(ids.is_valid()).tobytes()


def _unpacked_ids(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    rows = len(packed) // 9
    return np.frombuffer(packed, np.int64, rows), np.frombuffer(packed, bool, rows, 8 * rows)


def pack_chunks(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Texts in rows of about ``chunk_bytes``; the chunk number is fixed once the table is stored."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            for first, last in w.runs(offsets, chunk_bytes):
                part = data[offsets[first] : offsets[last]]
                own = offsets[first : last + 1] - offsets[first]
                n = 0
                for a, b in w.runs(own):
                    n += len(w.find_words(part[own[a] : own[b]], own[a : b + 1] - own[a], w.NOT_SPACE).starts)
                blob = pa.compress(part.tobytes(), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "chunk": pa.array([number], pa.int64()),
                        "ids": pa.array([_packed_ids(ids[first:last])], pa.binary()),
                        "offsets": pa.array([own.tobytes()], pa.binary()),
                        "blob": pa.array([blob], pa.binary()),
                        "raw": pa.array([len(part)], pa.int64()),
                        "n_words": pa.array([n], pa.int64()),
                    }
                )
                number += 1

    return docs.select("doc_id", "text").mapInArrow(pack, _CHUNKS)


def _chunk_words(row: dict) -> tuple[bytes, np.ndarray, w.Words, np.ndarray]:
    """Text, text bounds, words and word hashes of a chunk."""
    raw = pa.decompress(row["blob"], decompressed_size=row["raw"], codec="zstd", asbytes=True) if row["raw"] else b""
    data, offsets = np.frombuffer(raw, np.uint8), np.frombuffer(row["offsets"], np.int64)
    starts, ends, hashes = [], [], []
    for a, b in w.runs(offsets):
        part = data[offsets[a] : offsets[b]]
        found = w.find_words(part, offsets[a : b + 1] - offsets[a], w.NOT_SPACE)
        hashes.append(w.hash_words(part, found))
        starts.append(found.starts + offsets[a])
        ends.append(found.ends + offsets[a])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    starts, ends = join(starts, np.int64), join(ends, np.int64)
    found = w.Words(starts, ends, np.searchsorted(starts, offsets))
    return raw, offsets, found, join(hashes, np.uint64)


def _bucket_bounds(sorted_hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """``(bucket numbers, bounds)`` of the runs of equal bucket in sorted 64-bit hashes."""
    bucket = ((sorted_hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, int)
    return bucket[first].astype(np.int64), np.append(first, len(bucket))


def _short_groups(row: dict, window: int, shift: int):
    """Distinct cut hashes of a chunk's windows: order, group of each window, values, seen in two texts."""
    _, _, found, hashes = _chunk_words(row)
    at = np.flatnonzero(w.window_starts(found, window))
    short = w.window_hashes(hashes, window)[at] >> np.uint64(shift)
    owner = found.owners()[at]
    order = np.argsort(short, kind="stable")
    value = short[order]
    new = np.concatenate(([True], value[1:] != value[:-1])) if len(value) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    own = owner[order]
    several = np.maximum.reduceat(own, first) != np.minimum.reduceat(own, first) if len(first) else np.zeros(0, bool)
    return order, np.cumsum(new) - 1, value[first], several


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, low bytes first: planes of equal bytes compress away."""
    top = int(values.max()) if len(values) else 0
    kind = np.uint32 if top < 1 << 32 else np.uint64
    width = kind().itemsize
    return bytes([width]) + np.ascontiguousarray(values).astype(kind).view(np.uint8).reshape(-1, width).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32 if width == 4 else np.uint64).ravel()


def _steps(values: np.ndarray) -> bytes:
    """Sorted numbers as the steps between them; the first counts from 0."""
    return _planes(np.diff(values, prepend=values.dtype.type(0)))


def _from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data), dtype=np.uint64)


def _bits(mask: np.ndarray) -> bytes:
    return np.packbits(mask).tobytes()


def _from_bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def _cut(encode, values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.array([encode(values[a:b]) for a, b in itertools.pairwise(bounds)], pa.binary())


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def _by_chunk(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join of a few rows that hold much: their files say little of their size, so neither side is broadcast."""
    return left.join(right.hint("merge"), "chunk", how)


def derived_sizes(docs: DataFrame) -> tuple[int, int]:
    """Bytes of a chunk and words of a bucket for a corpus of this size; the least of both if nothing is known of it."""
    expected = expected_bytes(docs.select("text"))
    times = max(1.0, (expected / (1 << 30)) ** (1 / 3)) if expected < _UNKNOWN else 1.0
    return min(MOST_CHUNK_BYTES, int(CHUNK_BYTES * times)), min(MOST_BUCKET_WORDS, int(BUCKET_WORDS * times))


def _once_or_more(chunks: DataFrame, window: int, shift: int, buckets: int) -> DataFrame:
    """Per chunk, which of its distinct cut hashes occur in two documents: ``(chunk, marks)``."""

    def ask(batches):
        for row in _rows(batches):
            _, _, values, several = _short_groups(row, window, shift)
            names, bounds = _bucket_bounds(values << np.uint64(shift), buckets)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(names, pa.int64()),
                    "chunk": pa.array(np.full(len(names), row["chunk"]), pa.int64()),
                    "first": pa.array(values[bounds[:-1]].astype(np.int64), pa.int64()),
                    "steps": pa.array([_planes(np.diff(values[a:b])) for a, b in itertools.pairwise(bounds)], pa.binary()),
                    "several": _cut(_bits, several, bounds),
                }
            )

    def answer(table: pa.Table) -> pa.Table:
        values = [
            np.append(np.uint64(0), _from_steps(s)) + np.uint64(f)
            for f, s in zip(table["first"].to_pylist(), table["steps"].to_pylist(), strict=True)
        ]
        sizes = [len(v) for v in values]
        several = np.concatenate(
            [_from_bits(s, n) for s, n in zip(table["several"].to_pylist(), sizes, strict=True)]
        )
        values = np.concatenate(values)
        order = np.argsort(values)
        ordered = values[order]
        equal = ordered[1:] == ordered[:-1]
        found = several
        found[order[1:][equal]] = True
        found[order[:-1][equal]] = True
        bounds = np.cumsum([0, *sizes])
        return pa.table(
            {
                "chunk": table["chunk"],
                "bucket": table["bucket"],
                "n": pa.array(sizes, pa.int64()),
                "marks": _cut(_bits, found, bounds),
            }
        )

    asked = chunks.mapInArrow(ask, "bucket long, chunk long, first long, steps binary, several binary")
    # Two tasks for a bucket, so that few get several.
    answered = asked.repartition(2 * buckets, "bucket").groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, n long, marks binary")
    return answered.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("bucket", "n", "marks"))).alias("answer"))


def _candidates(chunks: DataFrame, marks: DataFrame, window: int, shift: int) -> DataFrame:
    """Windows worth a full question, with what the result needs: clean texts are finished here."""
    schema = _STATE + ", kept array<string>, dirty array<string>"

    def pick(batches):
        for row in _rows(batches):
            raw, offsets, found, hashes = _chunk_words(row)
            order, group, _, _ = _short_groups(row, window, shift)
            marked = [_from_bits(a["marks"], a["n"]) for a in row["answer"] or ()]
            marked = np.concatenate(marked) if marked else np.zeros(0, bool)
            at = np.flatnonzero(w.window_starts(found, window))
            hit = np.zeros(len(at), bool)
            hit[order] = marked[group] if len(group) else False
            pos = at[hit]
            second = w.mix(hashes + np.uint64(0x632BE59BD9B4E019))
            ha, hb = w.window_hashes(hashes, window)[pos], w.window_hashes(second, window)[pos]
            is_dirty = np.zeros(len(offsets) - 1, bool)
            is_dirty[found.owners()[pos]] = True
            texts = [raw[a:b] for a, b in itertools.pairwise(offsets)]
            kept = [None if d else hashlib.sha256(b" ".join(t.split())).hexdigest() for t, d in zip(texts, is_dirty, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([row["chunk"]], pa.int64()),
                    "ids": pa.array([row["ids"]], pa.binary()),
                    "n_words": pa.array([_planes(found.counts)], pa.binary()),
                    **_arrays(pos, ha, hb >> np.uint64(32)),
                    "kept": pa.array([kept], pa.list_(pa.string())),
                    "dirty": pa.array([[t.decode() if d else None for t, d in zip(texts, is_dirty, strict=True)]], pa.list_(pa.string())),
                }
            )

    return _by_chunk(chunks, marks, "left").mapInArrow(pick, schema)


def _arrays(pos: np.ndarray, ha: np.ndarray, hb: np.ndarray) -> dict:
    return {
        "steps": pa.array([_steps(pos.astype(np.uint64))], pa.binary()),
        "ha": pa.array([ha.tobytes()], pa.binary()),
        "hb": pa.array([_planes(hb)], pa.binary()),
        "n": pa.array([len(pos)], pa.int64()),
    }


def _unpack(row: dict):
    """Ids, word bounds of the texts, and of each window: its text, position and hashes."""
    pos = _from_steps(row["steps"]).astype(np.int64)
    bounds = np.append(0, np.cumsum(_from_planes(row["n_words"]), dtype=np.int64))
    doc = np.searchsorted(bounds, pos, "right") - 1
    return (
        _unpacked_ids(row["ids"])[0], bounds, doc, pos,
        np.frombuffer(row["ha"], np.uint64), _from_planes(row["hb"]).astype(np.uint64),
    )


def _group(ha: np.ndarray, hb: np.ndarray):
    """Sort by 128 bits: order, group of each sorted entry, first entry of each group."""
    order = np.lexsort((hb, ha))
    a, b = ha[order], hb[order]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, bool)
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _owners_of(state: DataFrame, buckets: int, with_least: bool) -> DataFrame:
    """Per chunk and distinct window: the smallest id that has it, and whether two documents do."""

    def ask(batches):
        for row in _rows(batches):
            ids, _, doc, _, ha, hb = _unpack(row)
            order, _, first = _group(ha, hb)
            if not len(first):
                continue
            own = doc[order]
            least = np.minimum.reduceat(ids[own], first)
            several = np.maximum.reduceat(own, first) != np.minimum.reduceat(own, first)
            a, b = ha[order][first], hb[order][first]
            names, bounds = _bucket_bounds(a, buckets)
            yield pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array(names, pa.int64()),
                    "chunk": pa.array(np.full(len(names), row["chunk"]), pa.int64()),
                    "ha": _cut(_steps, a, bounds),
                    "hb": _cut(_planes, b, bounds),
                    "least": _cut(_planes, least if with_least else np.zeros(len(a), np.int64), bounds),
                    "several": _cut(_bits, several, bounds),
                }
            )

    def answer(table: pa.Table) -> pa.Table:
        join = lambda name, decode: np.concatenate([decode(v) for v in table[name].to_pylist()])
        ha = [_from_steps(v) for v in table["ha"].to_pylist()]
        sizes = [len(v) for v in ha]
        order, group, first = _group(np.concatenate(ha), join("hb", _from_planes))
        least = np.minimum.reduceat(join("least", _from_planes).astype(np.int64)[order], first)
        several = [_from_bits(v, n) for v, n in zip(table["several"].to_pylist(), sizes, strict=True)]
        several = np.logical_or.reduceat(np.concatenate(several)[order], first)
        several |= np.diff(np.append(first, len(order))) > 1
        out_least, out_several = np.empty(len(order), np.int64), np.empty(len(order), bool)
        out_least[order], out_several[order] = least[group], several[group]
        bounds = np.cumsum([0, *sizes])
        return pa.table(
            {
                "chunk": table["chunk"],
                "bucket": table["bucket"],
                "n": pa.array(sizes, pa.int64()),
                "least": _cut(_planes, out_least, bounds),
                "several": _cut(_bits, out_several, bounds),
            }
        )

    asked = state.select("chunk", "ids", "n_words", "steps", "ha", "hb").mapInArrow(
        ask, "bucket long, chunk long, ha binary, hb binary, least binary, several binary"
    )
    answered = asked.repartition(2 * buckets, "bucket").groupBy("bucket").applyInArrow(
        answer, "chunk long, bucket long, n long, least binary, several binary"
    )
    return answered.groupBy("chunk").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "n", "least", "several"))).alias("answer")
    )


def _verdicts(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a state row: found in two documents; smallest id that has it."""
    _, _, doc, _, ha, hb = _unpack(row)
    order, group, _ = _group(ha, hb)
    least, several = np.empty(len(doc), np.int64), np.zeros(len(doc), bool)
    if len(doc):
        answer = row["answer"]
        least[order] = np.concatenate([_from_planes(a["least"]).astype(np.int64) for a in answer])[group]
        several[order] = np.concatenate([_from_bits(a["several"], a["n"]) for a in answer])[group]
    return several, least


def _doubled(state: DataFrame, answers: DataFrame, length: int) -> DataFrame:
    """Windows of twice the length both of whose halves are repeated; ``docs`` had a repeat of ``length``."""

    def extend(batches):
        for row in _rows(batches):
            _, _, doc, pos, ha, _ = _unpack(row)
            several, _ = _verdicts(row)
            doc, pos, ha = doc[several], pos[several], ha[several]
            next_at = np.minimum(np.searchsorted(pos, pos + length), max(len(pos) - 1, 0))
            both = (pos[next_at] == pos + length) & (doc[next_at] == doc) if len(pos) else np.zeros(0, bool)
            left, right = np.flatnonzero(both), next_at[both]
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([row["chunk"]], pa.int64()),
                    "ids": pa.array([row["ids"]], pa.binary()),
                    "n_words": pa.array([row["n_words"]], pa.binary()),
                    **_arrays(pos[left], w.join_hashes(ha[left], ha[right]), np.zeros(len(left), np.uint64)),
                    "docs": pa.array([np.unique(doc).tolist()], pa.list_(pa.int32())),
                }
            )

    joined = _by_chunk(state.select("chunk", "ids", "n_words", "steps", "ha", "hb"), answers, "inner")
    return joined.mapInArrow(extend, _STATE + ", docs array<int>")


def _finished(state: DataFrame, answers: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """One row per document from the first full answer."""
    schema = "chunk long, doc int, doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"

    def finish(batches):
        for row in _rows(batches):
            ids, bounds, doc, pos, _, _ = _unpack(row)
            known = _unpacked_ids(row["ids"])[1]
            counts = np.diff(bounds)
            _, least = _verdicts(row)
            covering = pos[(least < ids[doc]) & known[doc]]
            change = np.zeros(bounds[-1] + window + 1, np.int64)
            np.add.at(change, covering, 1)
            np.add.at(change, covering + window, -1)
            removed = np.cumsum(change)[: bounds[-1]] > 0
            total = np.append(0, np.cumsum(removed))
            gone = total[bounds[1:]] - total[bounds[:-1]]
            kept, texts = list(row["kept"]), [None] * len(ids)
            for i, text in enumerate(row["dirty"]):
                if text is not None:
                    parts = text.encode().split()
                    text = b" ".join(itertools.compress(parts, ~removed[bounds[i] : bounds[i + 1]]))
                    kept[i] = hashlib.sha256(text).hexdigest()
                    texts[i] = text.decode() if keep_text else None
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(np.full(len(ids), row["chunk"]), pa.int64()),
                    "doc": pa.array(np.arange(len(ids)), pa.int32()),
                    "doc_id": pa.array(ids, pa.int64(), mask=~known),
                    "n_words": pa.array(counts, pa.int64()),
                    "n_removed": pa.array(gone, pa.int64()),
                    "kept_sha256": pa.array(kept, pa.string()),
                    "kept_text": pa.array(texts, pa.string()),
                }
            )

    return _by_chunk(state, answers, "left").mapInArrow(finish, schema)


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    chunk_bytes: int | None = None,
    bucket_words: int | None = None,
    keep_text: bool = False,
) -> DataFrame:
    """Per document: words, removed words, digest of the rest and the longest repeat found by doubling.

    ``doc_id, n_words, n_removed, kept_sha256, longest_repeat`` (words of the
    greatest level ``window * 2^k`` at which a window of the document is found
    in another document; 0 for none). With ``keep_text`` a document that may
    have lost words carries what is left in ``kept_text`` (else null: unchanged
    up to white space). The two sizes follow the corpus if they are not given.
    """
    own = derived_sizes(docs)
    chunk_bytes, bucket_words = chunk_bytes or own[0], bucket_words or own[1]
    chunks = stored(pack_chunks(docs, chunk_bytes), "chunks")
    total = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)).alias("n")).first()["n"]
    shift = max(0, 64 - int(total).bit_length() - SPARE_BITS)
    marks = _once_or_more(chunks, window, shift, max(16, total // bucket_words))
    first = stored(_candidates(chunks, marks, window, shift), "repeats")
    dropped(chunks)
    del chunks, marks
    release(docs.sparkSession)

    state, length, repeated, answers_of_window = first, window, [], None
    while True:
        count = state.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        if not count and answers_of_window is not None:
            break
        answers = stored(_owners_of(state, max(16, count // bucket_words), length == window), "answers")
        if answers_of_window is None:
            answers_of_window = answers
        longer = stored(_doubled(state, answers, length), "repeats")
        docs_of_level = longer.select("chunk", F.explode("docs").alias("doc"), F.lit(length).alias("length"))
        repeated.append(stored(docs_of_level, "repeated"))
        if length > window:
            dropped(answers)
            dropped(state)
        state, length = longer, length * 2
        del answers
        release(docs.sparkSession)

    longest = repeated[0]
    for more in repeated[1:]:
        longest = longest.unionByName(more)
    longest = longest.groupBy("chunk", "doc").agg(F.max("length").cast("long").alias("longest_repeat"))
    done = _finished(first, answers_of_window, window, keep_text)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if keep_text else [])]
    return done.join(longest, ["chunk", "doc"], "left").select(
        *columns, F.coalesce("longest_repeat", F.lit(0).cast("long")).alias("longest_repeat")
    )
