"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. *Targets.* Sources share ``total`` (150 percent of all words) by weight; none
   gets more than ``most_repeats`` times its own words, and what is cut off is
   shared again by weight among the others.
2. *Quotas.* Documents are cut into blocks of ``BLOCK`` words. A source gives as
   many whole passes over its blocks as fit its target, and a further pass, in
   permuted order, up to the block that comes nearest to the target.
3. *Tree.* The block quotas of all sources are split between the two halves of
   the output shards by a multivariate hypergeometric draw, each half again in
   the same way, down to single shards. Every shard so gets a random mix of
   exact size, and the quotas of all shards add up to those of the sources.
4. *Draw.* A source's blocks, numbered in permuted order, go to the shards in
   consecutive ranges, so draws are disjoint. Within a shard, places are given
   by hash: a local shuffle.

Only ids, sizes and hashes are shuffled. Blocks are numbered by ranges of their
hash: counts per range, running totals over the ranges, and a sort inside each
range, so a source with a third of all blocks is spread over many tasks. On the
driver are one row per source (the mixture the user states) and the tree's
table of shards by source, at most ``MOST_CELLS`` numbers: with very many sources and
shards there are fewer and larger shards, never fewer words. Hashes depend on ids,
texts and ``seed`` alone, so reruns agree.

Edge cases. Null and empty texts have size 0 and are never drawn. A null source
is a source, ordered last. Null ids are told apart by their texts; rows equal in
id, text and source are drawn separately and are interchangeable. Equal hashes
are ordered by id, text and block. Further columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finflow.llm.store import small, small_batches, stored

# Weights by order of the sources, repeating; share of all words; repeats of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2

BLOCK = 128
SHARD_BLOCKS = 1 << 14
RANGE_BLOCKS = 1 << 12
MOST_CELLS = 10_000_000
# numpy draws hypergeometric numbers from populations below this; larger ones are drawn here.
_POPULATION = 1_000_000_000
_ALL_FULL = 1e300  # words by weight

_WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, row, copy``: a row per document; ``row`` names its text."""
    own = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(_WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("row"),
    )
    copies = own.groupBy("doc_id", "source", "size", "row").agg(F.count(F.lit(1)).alias("_copies"))
    return copies.select("doc_id", "source", "size", "row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most_repeats: float = MOST_REPEATS
) -> DataFrame:
    """``source, source_size, target`` of every source, in words."""
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_turn", F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
        .withColumn("_weight", F.get(F.array(*[F.lit(float(x)) for x in weights]), F.col("_turn").cast("int")))
    )
    sources = stored(sources, "sources")
    limit, level, before = F.col("source_size") * float(most_repeats), None, None
    while True:
        full = F.lit(False) if level is None else limit < F.lit(level) * F.col("_weight")
        state = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)).alias("given"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(full, 1)).alias("full"),
        ).first()
        if state["full"] == before:
            break
        before = state["full"]
        # With every source full there is nobody left to give the excess to: all stay at their limit.
        level = (share * state["all"] - state["given"]) / state["weight"] if state["weight"] else _ALL_FULL
    target = F.least(limit, F.lit(level) * F.col("_weight"))
    return sources.select("source", "source_size", target.alias("target"))


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Blocks of each source (columns) in each shard (rows), by the splitting tree."""
    out = np.zeros((shards, len(quotas)), np.int64)
    todo = [(0, shards, np.asarray(quotas, np.int64))]
    while todo:
        first, last, own = todo.pop()
        if last - first == 1:
            out[first] = own
            continue
        middle = (first + last) // 2
        total = int(own.sum())
        left_size = total * (middle - first) // (last - first)
        left = _multivariate(np.random.default_rng([seed, first, last]), own, left_size)
        todo += [(first, middle, left), (middle, last, own - left)]
    return out


def _multivariate(rng: np.random.Generator, own: np.ndarray, size: int) -> np.ndarray:
    """How many of each kind are among ``size`` drawn without replacement."""
    rest = int(own.sum())
    if rest < _POPULATION:
        return rng.multivariate_hypergeometric(own, size, method="marginals")
    left = np.zeros(len(own), np.int64)
    for i, n in enumerate(own.tolist()):
        rest -= n
        left[i] = hypergeometric(rng, n, rest, size)
        size -= int(left[i])
    return left


def hypergeometric(rng: np.random.Generator, good: int, bad: int, size: int) -> int:
    """How many of ``good`` are among ``size`` drawn from ``good + bad`` without replacement, for any population.

    Ratio of uniforms around the mode. The ratio of two probabilities is the product of the
    steps between them, so nothing is lost where factorials of large numbers would cancel;
    there are a few standard deviations of steps.
    """
    total = good + bad
    if min(good, bad, size, total - size) == 0:
        return min(good, size) if bad == 0 or size == total else 0
    few, drawn = min(good, bad), min(size, total - size)  # the same draw seen from its smaller sides
    mean = drawn * (few / total)
    spread = math.sqrt(mean * ((total - few) / total) * ((total - drawn) / (total - 1)) + 0.5)
    width = 2 * math.sqrt(2 / math.e) * spread + 3 - 2 * math.sqrt(3 / math.e)
    mode, most = (drawn + 1) * (few + 1) // (total + 2), min(drawn, few)
    while True:
        u, v = rng.random(2)
        at = mean + 0.5 + width * (v - 0.5) / u if u else -1.0
        if not 0 <= at < most + 1:
            continue
        k = int(at)
        j = np.arange(min(k, mode), max(k, mode), dtype=float)
        steps = np.log((few - j) / (j + 1) * ((drawn - j) / (total - few - drawn + j + 1))).sum()
        if 2 * math.log(u) <= (steps if k > mode else -steps):
            break
    k = k if drawn == size else few - k
    return k if few == good else size - k


def _numbered(blocks: DataFrame) -> DataFrame:
    """Adds ``rank`` and ``before`` (words before the block) in permuted order, by source and pass."""
    group = ["source", "pass"]
    per_group = blocks.groupBy(*group).agg(F.count(F.lit(1)).alias("_blocks"))
    ranges = per_group.select(
        F.struct(*group).alias("_group"), F.ceil(F.col("_blocks") / RANGE_BLOCKS).alias("_ranges")
    )
    # Sources are few: sending their ranges to all tasks keeps a large source's blocks where they are.
    blocks = blocks.withColumn("_group", F.struct(*group)).join(small(ranges), "_group")
    # The high 31 bits of the hash, scaled: ranges follow the order of the hashes.
    high = F.shiftrightunsigned(F.col("hash"), 33)
    blocks = blocks.withColumn("_range", F.shiftright(high * F.col("_ranges"), 31)).drop("_ranges")
    sums = blocks.groupBy("_group", "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("words").alias("_words"))
    earlier = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = sums.select(
        "_group", "_range",
        F.coalesce(F.sum("_n").over(earlier), none).alias("_rank"),
        F.coalesce(F.sum("_words").over(earlier), none).alias("_before"),
    )
    inside = Window.partitionBy("_group", "_range").orderBy(
        F.shiftrightunsigned(F.col("hash"), 1), F.col("hash"), "doc_id", "row", "copy", "block"
    )
    return (
        blocks.withColumn("_own_rank", F.row_number().over(inside) - 1)
        .withColumn("_own_before", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
        .join(sums, ["_group", "_range"])
        .withColumn("rank", F.col("_rank") + F.col("_own_rank"))
        .withColumn("before", F.col("_before") + F.col("_own_before"))
        .drop("_group", "_range", "_rank", "_before", "_own_rank", "_own_before")
    )


def draw(
    sizes: DataFrame, goals: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 0
) -> DataFrame:
    """Drawn blocks: ``shard, place, doc_id, row, copy, source, pass, block, words``.

    ``goals`` comes from :func:`targets`. A block holds the words from
    ``block * BLOCK`` on. ``place`` orders a shard.
    """
    spark = sizes.sparkSession
    goal = small(goals.select(F.struct("source").alias("_source"), "source_size", "target"))
    drawn = (
        sizes.where("size > 0")
        .withColumn("_source", F.struct("source"))
        .join(goal, "_source")
        .withColumn("_passes", F.ceil(F.try_divide("target", "source_size")))
        .where("_passes > 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_passes"))))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / block))))
        .withColumn("words", F.least(F.lit(block).cast("long"), F.col("size") - F.col("block") * block))
        .withColumn("hash", F.xxhash64("doc_id", "row", "source", "copy", "block", "pass", F.lit(seed)))
        .withColumn("_left", F.col("target") - (F.col("pass") - 1) * F.col("source_size"))
        .drop("_source", "_passes", "size", "target", "source_size")
    )
    # A block is taken if its middle lies before the target: the nearest whole number of blocks.
    taken = _numbered(drawn).where(F.col("before") + F.col("words") / 2 <= F.col("_left"))
    taken = stored(taken.drop("before", "_left"), "draws")

    counts = taken.groupBy("source", "pass").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("source").asc_nulls_last(), "pass").collect()
    quotas = np.array([r["n"] for r in counts], np.int64)
    shards = int(max(1, min(-(-quotas.sum() // shard_blocks), MOST_CELLS // max(1, len(quotas)))))
    ends = split_quotas(quotas, shards, seed).cumsum(axis=0)
    column = {(r["source"], r["pass"]): i for i, r in enumerate(counts)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            source, number = batch.column("source").to_pylist(), batch.column("pass").to_pylist()
            which = np.array([column[k] for k in zip(source, number, strict=True)], int)
            shard = np.empty(len(rank), np.int64)
            for i in np.unique(which):
                own = which == i
                shard[own] = np.searchsorted(ends[:, i], rank[own], "right")
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", *batch.schema.names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields)
    placed = taken.mapInArrow(place, f"shard long, {schema}") if len(quotas) else spark.createDataFrame([], f"shard long, {schema}")
    return placed.withColumn("place", F.xxhash64("hash", F.lit("place"), F.lit(seed))).drop("rank", "hash")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, n_shards`` of every document."""
    small_batches(docs.sparkSession)
    sizes = stored(sized(docs), "sizes")
    goals = targets(sizes)
    key = ["doc_id", "source", "row", "copy"]
    drawn = (
        draw(sizes, goals, **options)
        .groupBy(F.struct(*key).alias("_key"))
        .agg(F.sum("words").alias("taken"), F.count_distinct("shard").alias("n_shards"))
    )
    none = F.lit(0).cast("long")
    joined = (
        sizes.withColumn("_key", F.struct(*key)).join(drawn, "_key", "left").withColumn("_source", F.struct("source"))
        .join(small(goals.select(F.struct("source").alias("_source"), "source_size", "target")), "_source")
    )
    return joined.select(
        "doc_id", "source", "row", "size", "source_size", "target",
        F.coalesce("taken", none).alias("taken"), F.coalesce("n_shards", none).alias("n_shards"),
    )


def shard_texts(docs: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """The mixture itself: ``shard, place, doc_id, block, text``, partitioned by shard and in order."""
    sizes = stored(sized(docs), "sizes")
    drawn = draw(sizes, targets(sizes), block, **options)
    texts = docs.select(F.struct("doc_id", "source", F.xxhash64("text").alias("row")).alias("_key"), "text").dropDuplicates(["_key"])
    drawn = drawn.withColumn("_key", F.struct("doc_id", "source", "row"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    part = F.array_join(F.slice(words, (F.col("block") * block + 1).cast("int"), F.lit(block)), " ")
    out = drawn.join(texts, "_key").select("shard", "place", "doc_id", "block", part.alias("text"))
    return out.repartition("shard").sortWithinPartitions("shard", "place", "doc_id", "block")
