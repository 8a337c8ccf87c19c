"""Near-duplicate documents by HyperMinHash.

Signature. A document's distinct word shingles are dealt to ``registers`` by
hash. A register keeps the least hash of its shingles in compressed form: the
number of leading zeros and the ``MANTISSA`` bits after them, 16 bits in all.

Candidates. Documents of the same shingle set are one *class*; only classes go
on, numbered (``node``), so tables of groups, pairs and components are of two or three
numbers a row. For banding, an empty register borrows the value of the first filled one in
an order of its own, so a band of a short text holds several shingles as well.
``rows`` neighbouring registers make a band; classes that agree in a band are
candidates. With the defaults a pair at the threshold is missed by every
band with a chance below 1e-8. A band's group is never expanded into all its
pairs: each member is compared with the group's hub (the member that shares
groups with the most others). Groups that still hold several components go on
in turns: each member is compared with a few members of other components, drawn
anew in each turn, which soon leaves few pairs that are not connected. Groups
with few pairs left are compared in full. Once a turn closes less than an eighth
of the open pairs, the members of groups with many pairs left (texts that share a
common passage and little else) go through an exact join on each one's rarest
shingles instead, which two texts at the threshold always share. How rare a shingle
is comes from a count-min sketch of fixed size; any order common to all sets would
do, so its errors cost rows and no link. So every candidate pair is compared,
connected or ruled out.

Check. The Jaccard estimate from the registers, corrected for registers that
agree by chance, drops pairs far below the threshold (five standard errors);
the rest are confirmed on the full shingle sets. Components of confirmed links
are found by repeated star contraction on tables.

Edge cases. Null and empty texts have no shingles and are linked with nothing.
Texts shorter than a shingle count as one. Rows that share an id stand or fall
by their own text. Rows without an id link like any other, and never name a
component that holds an id.
Repeated rows are exact copies of each other. Further columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from finflow.llm import words as w
from finflow.llm.store import MOST_BROADCAST, dropped, release, small, small_batches, stored

SHINGLE = 5
THRESHOLD = 0.8
MANTISSA = 10
EMPTY = np.uint16(0xFFFF)
# Members each member is compared with in a turn; pairs per member up to which a group's pairs are all compared.
PIVOTS = 3
FEW_PAIRS = 8
# The sketch of shingle counts: rows of 2 ** SKETCH_BITS cells.
SKETCH_BITS = 18
_SKETCH_SALTS = (0xC2B2AE3D27D4EB4F, 0x27D4EB2F165667C5)
_PIECE_CELLS = 1 << 15


def bands_for(threshold: float, miss: float = 1e-8) -> tuple[int, int]:
    """Rows and bands so that a pair at ``threshold`` is missed with a chance below ``miss``."""
    for rows in (6, 5, 4, 3, 2, 1):
        bands = int(np.ceil(np.log(miss) / np.log1p(-(threshold**rows))))
        if bands <= 40:
            return rows, bands
    return 1, int(np.ceil(np.log(miss) / np.log1p(-threshold)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, one after the other; and their bounds."""
    found = w.find_words(data, offsets, w.NOT_SPACE)
    h = w.hash_words(data, found)
    at = np.flatnonzero(w.window_starts(found, size))
    grams, owner = w.window_hashes(h, size)[at], found.owners()[at]
    short = np.flatnonzero((found.counts > 0) & (found.counts < size))
    if len(short):
        # All words of a short text as one; the length keeps them apart from real shingles.
        whole = np.array([_fold(h[found.offsets[i] : found.offsets[i + 1]]) for i in short], np.uint64)
        grams, owner = np.append(grams, whole), np.append(owner, short)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.concatenate(([True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))) if len(grams) else np.zeros(0, bool)
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(offsets)))


def _fold(h: np.ndarray) -> int:
    total = w.mix(np.array([len(h)], np.uint64))
    for one in h:
        total = w.join_hashes(total, np.array([one]))
    return int(total[0])


def signatures(grams: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """Registers of each set, 16 bits each: leading zeros (at most 62) and mantissa, or EMPTY."""
    sets = len(bounds) - 1
    owner = np.repeat(np.arange(sets), np.diff(bounds))
    h = w.mix(grams ^ np.uint64(0x5851F42D4C957F2D))
    register = (w.mix(grams) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)
    cell = owner * registers + register.astype(np.int64)
    least = np.full(sets * registers, np.iinfo(np.uint64).max, np.uint64)
    order = np.argsort(cell, kind="stable")
    if len(cell):
        ordered = cell[order]
        first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        least[ordered[first]] = np.minimum.reduceat(h[order], first)
    filled = np.zeros(sets * registers, bool)
    filled[cell] = True
    # The exponent of a float64 gives the leading zeros, up to rounding at the top; take them exactly.
    zeros = np.zeros(len(least), np.uint64)
    rest = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        low = rest < (np.uint64(1) << np.uint64(64 - step))
        zeros[low] += np.uint64(step)
        rest[low] <<= np.uint64(step)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    packed = (np.minimum(zeros, np.uint64(62)) << np.uint64(MANTISSA)) | mantissa
    return np.where(filled, packed, EMPTY).astype(np.uint16).reshape(sets, registers)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of signature pairs and the number of registers each rests on."""
    used = (a != EMPTY) | (b != EMPTY)
    count = np.maximum(used.sum(1), 1)
    equal = ((a == b) & used).sum(1)
    # Two unrelated registers agree if their leading zeros and mantissas do.
    per = np.maximum(np.minimum(size_a, size_b) / a.shape[1], 1.0)
    chance = _chance(per)
    share = equal / count
    return np.clip((share - chance) / (1 - chance), 0, 1), count


def _chance(per_register: np.ndarray) -> np.ndarray:
    """Chance that two independent minima of ``n`` uniform hashes fall into the same compressed value.

    Their values lie around 1 / n, where a compressed value is 2^-(zeros + MANTISSA + 1) wide.
    """
    return np.minimum(1.0, per_register / (1 + per_register) ** 2 * 2.0 ** (1 - MANTISSA))


def describe(docs: DataFrame, size: int, registers: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_shingles, name, sig``: ``name`` is of the shingle set, null without shingles."""
    carried = docs.select(*carry).schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            ids = batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64())
            for a, b in w.runs(offsets):
                part = w.LOWER[data[offsets[a] : offsets[b]]]
                grams, bounds = shingle_sets(part, offsets[a : b + 1] - offsets[a], size)
                name, count = _names(grams, bounds), np.diff(bounds)
                sig = signatures(grams, bounds, registers)
                none = count == 0
                yield pa.RecordBatch.from_pydict(
                    {f.name: batch.column(f.name)[a:b] for f in carried}
                    | {
                        "doc_id": ids[a:b],
                        "n_shingles": pa.array(count, pa.int64()),
                        "name": pa.array([None if n else v.tobytes() for n, v in zip(none, name, strict=True)], pa.binary()),
                        "sig": pa.array([None if n else v.tobytes() for n, v in zip(none, sig, strict=True)], pa.binary()),
                    }
                )

    more = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in carried)
    return docs.select("doc_id", "text", *carry).mapInArrow(run, f"{more}doc_id long, n_shingles long, name binary, sig binary")


def _classes(described: DataFrame) -> DataFrame:
    """``name, sig, n_shingles, least, node`` of every shingle set; stored, which fixes the number ``node``."""
    found = described.where("name is not null").groupBy("name").agg(
        F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("least")
    )
    return stored(found.withColumn("node", F.monotonically_increasing_id()), "classes")


def _names(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits that name each set: two sums over its scattered hashes, with its size."""
    sums = []
    for salt in (0x9FB21C651E98DF25, 0xD1B54A32D192ED03):
        total = np.append(np.uint64(0), np.cumsum(w.mix(grams ^ np.uint64(salt)), dtype=np.uint64))
        sums.append(w.mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return np.stack(sums, axis=1)


def _filled_up(sig: np.ndarray) -> np.ndarray:
    """Registers with the empty ones borrowed; every set has a filled one."""
    sig, registers = sig.copy(), sig.shape[1]
    order = np.random.default_rng(registers).permuted(np.tile(np.arange(registers), (registers, 1)), axis=1)
    at, place = np.nonzero(sig == EMPTY)
    source = sig.copy()
    for turn in range(registers):
        if not len(at):
            break
        value = source[at, order[place, turn]]
        found = value != EMPTY
        sig[at[found], place[found]] = value[found]
        at, place = at[~found], place[~found]
    return sig


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """Key of every band of every set."""
    sets = sig.shape[0]
    cut = _filled_up(sig)[:, : rows * bands].reshape(sets, bands, rows)
    key = np.broadcast_to(w.mix(np.arange(1, bands + 1, dtype=np.uint64)), (sets, bands)).copy()
    for i in range(rows):
        key = w.join_hashes(key, cut[:, :, i].astype(np.uint64))
    return key


def _banded(classes: DataFrame, rows: int, bands: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            node = batch.column("node")
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(batch.num_rows, -1)
            key = band_keys(sig, rows, bands).view(np.int64).ravel()
            at = np.repeat(np.arange(batch.num_rows), bands)
            yield pa.RecordBatch.from_pydict({"key": pa.array(key), "node": node.take(pa.array(at))})

    return classes.select("node", "sig").mapInArrow(run, "key long, node long")


def _few(pairs: DataFrame) -> bool:
    """Whether stored ``pairs``, and so their nodes, are few enough to send to all tasks."""
    return pairs.count() <= MOST_BROADCAST


def _oriented(pairs: DataFrame, few: bool) -> DataFrame:
    """``pairs`` with the node that has more partners as ``b``."""
    often = _members(pairs).groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    side = lambda s: often.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"))
    sent = F.broadcast if few else (lambda rows: rows)
    known = pairs.join(sent(side("a")), "a", "left").join(sent(side("b")), "b", "left")
    swap = F.coalesce("a_n", F.lit(1)) > F.coalesce("b_n", F.lit(1))
    return known.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"))


def _both_sides(pairs: DataFrame, few: bool, table: DataFrame, *columns: str) -> DataFrame:
    """``a, b`` of ``pairs`` with ``columns`` of both nodes from ``table``, named ``a_`` and ``b_``.

    What is wide moves once: rows of ``table`` find their pairs where they lie (as long as pairs are
    few enough to send), and go to the few nodes that are ``b``.
    """
    side = lambda s, rows: rows.select(F.col("node").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in columns])
    sent = F.broadcast if few else (lambda rows: rows)
    hubs = sent(pairs.select(F.col("b").alias("node")).distinct())
    own = side("a", table).join(sent(pairs), "a")
    return own.join(side("b", table.join(hubs, "node", "left_semi")), "b")


def _plausible(pairs: DataFrame, classes: DataFrame, threshold: float) -> tuple[DataFrame, bool]:
    """Of ``pairs`` those whose estimate is not five standard errors below the threshold, and whether they are few; stored."""
    pairs = stored(pairs, "asked")
    few = _few(pairs)
    joined = _both_sides(stored(_oriented(pairs, few), "asked"), few, classes, "sig", "n_shingles")

    def run(batches):
        for batch in batches:
            sig = lambda n: np.frombuffer(b"".join(batch.column(n).to_pylist()), np.uint16).reshape(batch.num_rows, -1)  # noqa: E731, B023
            n_a, n_b = (batch.column(n).to_numpy() for n in ("a_n_shingles", "b_n_shingles"))
            near, count = estimate(sig("a_sig"), sig("b_sig"), n_a, n_b)
            error = np.sqrt(threshold * (1 - threshold) / count)
            # The sizes alone bound the Jaccard index.
            keep = (near >= threshold - 5 * error - 1 / count) & (np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    wanted = joined.select("a", "b", "a_sig", "b_sig", "a_n_shingles", "b_n_shingles")
    return stored(wanted.mapInArrow(run, "a long, b long"), "pairs"), few


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node"))


def _full_sets(docs: DataFrame, classes: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, grams`` of the classes ``nodes`` (distinct), from one document of each; stored."""
    one = stored(classes.select("name", "node", "least").join(nodes, "node", "left_semi"), "wanted")
    asked = one.where("least is not null").select(F.col("least").alias("doc_id"), "name", "node")
    texts = docs.select("doc_id", "text").join(small(asked), "doc_id").select("text", "name", "node")

    def run(batches):
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            asked, node = batch.column("name").to_pylist(), batch.column("node")
            for a, b in w.runs(offsets):
                part = w.LOWER[data[offsets[a] : offsets[b]]]
                grams, bounds = shingle_sets(part, offsets[a : b + 1] - offsets[a], size)
                names = [v.tobytes() for v in _names(grams, bounds)]
                keep = [i for i in range(b - a) if asked[a + i] in (None, names[i])]
                yield pa.RecordBatch.from_pydict(
                    {
                        "name": pa.array([names[i] for i in keep], pa.binary()),
                        "node": node.take(pa.array([a + i for i in keep], pa.int64())),
                        "grams": pa.array([grams[bounds[i] : bounds[i + 1]].tobytes() for i in keep], pa.binary()),
                    }
                )

    made = "name binary, node long, grams binary"
    found = texts.mapInArrow(run, made).select("node", "grams")
    nameless = one.where("least is null").select("name", "node")
    if not nameless.isEmpty():
        # Classes of rows without an id are looked up by name among those rows.
        others = docs.where("doc_id is null").select("text", F.lit(None).cast("binary").alias("name"), F.lit(None).cast("long").alias("node"))
        found = found.unionByName(others.mapInArrow(run, made).drop("node").join(nameless, "name").select("node", "grams"))
    found = stored(found, "sets")
    # Only rows equal in id and text, or without an id, bring a set twice; else sets need not be shuffled here.
    if found.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return found
    once = stored(found.dropDuplicates(["node"]), "sets")
    dropped(found)
    return once


def _confirmed(pairs: DataFrame, few: bool, sets: DataFrame, threshold: float) -> DataFrame:
    """Of stored ``pairs`` (``few`` as in :func:`_plausible`) those whose shingle sets meet the threshold, counted exactly."""
    percent = round(threshold * 100)
    joined = _both_sides(pairs, few, sets, "grams")

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a_grams"), batch.column("b_grams"), strict=True):
                a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "a_grams", "b_grams").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``edges`` (``a``, ``b``): alternating star contraction.

    Each round links a node's greater neighbours, then its smaller ones, to its
    least neighbour; the rounds grow with the logarithm of the nodes.
    """
    def kept(rows: DataFrame) -> tuple[DataFrame, dict]:
        """The edges, and what tells whether they changed, observed as they are written."""
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        return stored(rows, "edges"), seen.get

    now, state = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    before = None
    while state != before and state["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        before, last = state, now
        now, state = kept(small.where("u > v").distinct())
        dropped(last)
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return members.unionByName(roots).groupBy("node").agg(F.min("root").alias("root"))


def _joined_up(roots: DataFrame | None, added: DataFrame) -> DataFrame:
    """``node, root`` after further links: only components that a new link touches are contracted again."""
    if roots is None:
        return components(added)
    of = lambda s: roots.select(F.col("node").alias(s), F.col("root").alias(f"{s}_root"))
    between = added.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = between.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")).where("a <> b")
    moved = stored(components(between), "moved")
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return old.unionByName(moved.join(roots, "node", "left_anti"))


def _ordered(rows: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct pairs ``a < b`` of two columns of nodes."""
    return rows.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b")).distinct()


def _open_groups(groups: DataFrame, classes: DataFrame, roots: DataFrame) -> tuple[DataFrame, int, int]:
    """Rows of groups of several components, their number, and that of pairs across in large groups (``large``).

    Components only grow together, so a later turn asks among the rows that this one returns.
    """
    named = groups.drop("root", "large").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stored(named, "rooted")
    sizes = named.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inner"), F.count(F.lit(1)).alias("roots"))
    across = (F.col("n") * F.col("n") - F.col("inner")) / 2
    mixed = mixed.where("roots > 1").select("key", "n", across.alias("across"), (across > FEW_PAIRS * F.col("n")).alias("large"))
    rows = named.join(mixed, "key")
    if "n_shingles" not in groups.columns:
        rows = rows.join(classes.select("node", "n_shingles"), "node")
    # Each row brings its share of its group's pairs, so one reading of the rows counts both.
    rows = stored(rows.withColumn("share", F.when(F.col("large"), F.col("across") / F.col("n")).otherwise(0.0)).drop("n", "across"), "open")
    dropped(named)
    total = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("share"), F.lit(0.0)).alias("large")).first()
    return rows.drop("share"), int(total["rows"]), round(total["large"])


def _alike(threshold: float, size: str, other: str):
    """Sizes that allow the threshold."""
    return 100 * F.least(size, other) >= round(100 * threshold) * F.greatest(size, other)


def _pivots_across(open_: DataFrame, threshold: float, turn: int) -> DataFrame:
    """Each member with a few members of its group, drawn by hash anew in each turn, if they are of other components."""
    member = F.struct("node", "root", "n_shingles")
    drawn = [F.min_by(member, F.xxhash64("key", "node", F.lit(PIVOTS * turn + i))) for i in range(PIVOTS)]
    pivots = open_.groupBy("key").agg(F.array(*drawn).alias("pivots")).select("key", F.explode("pivots").alias("p"))
    pivots = pivots.select("key", F.col("p.node").alias("pivot"), F.col("p.root").alias("pivot_root"), F.col("p.n_shingles").alias("pivot_size"))
    both = open_.join(pivots, "key").where((F.col("root") != F.col("pivot_root")) & _alike(threshold, "n_shingles", "pivot_size"))
    return _ordered(both, "node", "pivot")


def _beside_largest(open_: DataFrame) -> DataFrame:
    """Members that are not of the component with most members in their group, and that component (``most``)."""
    sizes = open_.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.groupBy("key").agg(F.max(F.struct("n", "root"))["root"].alias("most"))
    return open_.join(most, "key").where(F.col("root") != F.col("most"))


def _all_across(open_: DataFrame, threshold: float) -> DataFrame:
    """All pairs of members of a group that are of different components.

    One of a pair is beside the group's largest component, so only those members meet
    the whole group: at most four rows for each pair across.
    """
    other = open_.select("key", F.col("node").alias("b"), F.col("root").alias("b_root"), F.col("n_shingles").alias("b_size"))
    once = (F.col("b_root") == F.col("most")) | (F.col("node") < F.col("b"))
    both = _beside_largest(open_).join(other, "key").where(once & (F.col("root") != F.col("b_root")) & _alike(threshold, "n_shingles", "b_size"))
    return _ordered(both, "node", "b")


def _cells(grams: np.ndarray) -> np.ndarray:
    """Cells of shingles in the sketch, one row of it after the other."""
    rows = [w.mix(grams ^ np.uint64(salt)) >> np.uint64(64 - SKETCH_BITS) for salt in _SKETCH_SALTS]
    return np.stack([(r.astype(np.int64) + (i << SKETCH_BITS)) for i, r in enumerate(rows)])


def sketch(sets: DataFrame) -> np.ndarray:
    """Count-min sketch of the shingles of ``sets``: counted by task, then added up in two steps.

    It travels in pieces of ``_PIECE_CELLS`` counters. The first step adds the pieces of every
    64th task, so no group holds those of all tasks.
    """
    cells = len(_SKETCH_SALTS) << SKETCH_BITS

    def run(batches):
        counts = np.zeros(cells, np.int64)
        for batch in batches:
            for grams in batch.column("grams"):
                np.add.at(counts, _cells(np.frombuffer(grams.as_py(), np.uint64)), 1)
        pieces = counts.reshape(-1, _PIECE_CELLS)
        some = np.flatnonzero(pieces.any(axis=1))
        part = TaskContext.get().partitionId() % 64
        yield pa.RecordBatch.from_pydict(
            {
                "piece": pa.array(some.astype(np.int32)),
                "part": pa.array(np.full(len(some), part, np.int32)),
                "counts": pa.array([pieces[i].tobytes() for i in some], pa.binary()),
            }
        )

    def added(pieces: pa.Table) -> pa.Table:
        total = np.zeros(_PIECE_CELLS, np.int64)
        for counts in pieces.column("counts"):
            total += np.frombuffer(counts.as_py(), np.int64)
        return pa.table({"piece": pieces.column("piece").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    by_task = sets.select("grams").mapInArrow(run, "piece int, part int, counts binary")
    by_part = by_task.groupBy("piece", "part").applyInArrow(added, "piece int, counts binary")
    found = by_part.groupBy("piece").applyInArrow(added, "piece int, counts binary").collect()
    counts = np.zeros((cells // _PIECE_CELLS, _PIECE_CELLS), np.int32)  # it goes to every task
    for row in found:
        counts[row["piece"]] = np.minimum(np.frombuffer(row["counts"], np.int64), np.iinfo(np.int32).max)
    return counts.ravel()


def _rarest_across(open_: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of open members of different components that share one of their rarest shingles.

    Two sets that overlap in ``o`` share one of the first ``n - o + 1`` shingles of
    each in any common order. The rarest come first, so a passage
    that many texts share brings none of them together.

    Sets, which are wide, stay where they lie. Where there are too many members to send, the starts
    of all sets are made and only those of members kept.
    """
    percent = round(100 * threshold)
    member = stored(open_.select("node", "root", "n_shingles").distinct(), "members")
    few = _few(member)
    if few:
        sets = sets.join(F.broadcast(member.select("node")), "node", "left_semi")
    counts = sketch(sets)

    def run(batches):
        for batch in batches:
            rarest = []
            for grams in batch.column("grams"):
                grams = np.frombuffer(grams.as_py(), np.uint64)
                often = counts[_cells(grams)].min(axis=0)
                first = len(grams) - -(-len(grams) * percent // 100) + 1
                rarest.append(grams[np.lexsort((grams, often))[:first]].view(np.int64))
            sizes = [len(r) for r in rarest]
            at = np.repeat(np.arange(len(sizes)), sizes)
            ranks = np.concatenate([*(np.arange(1, n + 1) for n in sizes), np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_pydict(
                {
                    "node": batch.column("node").take(pa.array(at)),
                    "gram": pa.array(np.concatenate([*rarest, np.zeros(0, np.int64)])),
                    "rank": pa.array(ranks.astype(np.int64)),
                }
            )

    rarest = sets.select("node", "grams").mapInArrow(run, "node long, gram long, rank long")
    first = stored(rarest.join(F.broadcast(member) if few else member, "node").select("gram", "node", "root", "n_shingles", "rank"), "rarest")
    other = first.select("gram", *[F.col(c).alias(f"b_{c}") for c in ("node", "root", "n_shingles", "rank")])
    # Linked with a set of its own size or more, a set overlaps by this share of itself, so a shorter
    # start must hold the common shingle. It ends before the shingles that most texts have.
    least = F.ceil(F.col("n_shingles") * (2 * percent) / (100 + percent))
    # With both sizes known, the overlap a link needs is too, and so are still shorter starts.
    overlap = F.ceil((F.col("n_shingles") + F.col("b_n_shingles")) * percent / (100 + percent))
    both = first.where(F.col("rank") <= F.col("n_shingles") - least + 1).join(other, "gram").where(
        (F.col("n_shingles") <= F.col("b_n_shingles"))
        & (F.col("root") != F.col("b_root"))
        & (F.col("rank") <= F.col("n_shingles") - overlap + 1)
        & (F.col("b_rank") <= F.col("b_n_shingles") - overlap + 1)
    )
    return _ordered(both, "node", "b_node")


def near_copies(
    docs: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    carry: tuple[str, ...] = (),
    named: bool = False,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document, and the columns named in ``carry``.

    ``component_id`` is the least id linked with the document, directly or
    through others; the document of that id is kept. Where ids repeat, components may
    share one: ``named`` adds ``component``, a name of its own (null without shingles).
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows, bands = bands_for(threshold)
    described = stored(describe(docs, shingle, rows * bands, carry), "signatures")
    classes = _classes(described)
    banded = _banded(classes, rows, bands)
    groups = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(banded.join(groups, "key"), "bands")
    release(spark)

    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = shared.join(weights, "node").groupBy("key").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    pairs = _ordered(shared.join(hubs, "key").where("node <> hub"), "node", "hub")
    # Texts are read once more, for the sets of all classes that may have a partner.
    sets = _full_sets(docs, classes, shared.select("node").distinct(), shingle)
    compared, few = _plausible(pairs, classes, threshold)
    roots, open_, found, before, turn = None, shared, compared, None, 0
    while True:
        added = stored(_confirmed(found, few, sets, threshold), "links")
        roots = stored(_joined_up(roots, added), "components")
        release(spark)
        turn += 1
        # Groups that are not of one component yet: compare across components.
        open_, members, large = _open_groups(open_, classes, roots)
        if not members:
            break
        last = not large or (before is not None and 8 * large > 7 * before)
        if not last:
            before, across = large, _pivots_across(open_.where("large"), threshold, turn)
        else:
            across = _all_across(open_.where("not large"), threshold)
            if large:
                across = across.unionByName(_rarest_across(open_.where("large"), sets, threshold)).distinct()
        known = _ordered(compared, "a", "b")
        found, few = _plausible(across.join(known, ["a", "b"], "left_anti"), classes, threshold)
        if last:
            added = stored(_confirmed(found, few, sets, threshold), "links")
            roots = stored(_joined_up(roots, added), "components")
            break
        compared = stored(compared.unionByName(found), "pairs")

    # Most classes are linked with none: only those that are meet to find the least id of their component.
    linked = classes.select("node", "least").join(roots, "node")
    names = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = linked.join(names, "root").select("node", "root", "component_id")
    by_name = classes.select("name", "node", "least").join(linked, "node", "left").select(
        "name", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("root", "node").alias("component")
    )
    own = described.select(*carry, "doc_id", "n_shingles", "name").join(by_name, "name", "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return own.select(
        *carry, "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), *(["component"] if named else []),
    )
