"""Quality rules and a hashed n-gram log-likelihood ratio, in built-in functions only.

Every document is scored by the log-likelihood ratio of its word n-grams
(hashed to a fixed number of buckets) between trusted documents and the whole
raw corpus, divided by the number of n-grams. Weights are whole numbers
(millionths), so sums do not depend on the order of work and the threshold cuts
the same on every run. The threshold is a low quantile of the trusted
documents' own scores.

The raw counts are taken over all documents, the trusted ones over all that have
a label of quality 1. For the threshold each trusted document is scored by what the
other half of them (by hash of the id) says, as documents without a label are scored
by others as well; its quantile is exact, found by counting cells of scores that
get finer. The ids of trusted documents go to all tasks while they are few
(``store.MOST_BROADCAST``); beyond that the join shuffles the texts, once for the
counts and once for the scores. The weights (``buckets`` numbers) always go to all tasks.
Apart from that a document is rated where it is read, and no text is shuffled.

Edge cases. Null and empty texts have no words and fail the base rule. A row
with a null id is rated like any other and is never trusted. Repeated rows are
rated each. Without trusted rows all weights are 0 and only the base rule
drops; so it is where one half of them has no words, since nothing can judge the other. Ties with the threshold are kept. Further columns are ignored. An empty
table gives no rows. One text takes some hundred bytes of memory per word while
its repeated windows are sorted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.llm.store import small, stored

BUCKETS = 1 << 16
TRUSTED_QUANTILE = 0.002
SMOOTHING = 1.0
SCALE = 1_000_000

# White space between words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 5


def with_ngrams(docs: DataFrame) -> DataFrame:
    """Adds ``_text``, ``_words`` and the hashes of words (``_one``) and of word pairs (``_two``)."""
    return (
        docs.withColumn("_text", F.coalesce("text", F.lit("")))
        .withColumn("_words", F.array_remove(F.split("_text", SPACE), ""))
        .withColumn("_one", F.transform("_words", lambda word: F.xxhash64(word)))
        .withColumn("_two", _paired(F.col("_one"), F.col("_one"), 1))
    )


def _paired(left: Column, right: Column, step: int) -> Column:
    """Hash of each ``left[i]`` with ``right[i + step]``."""
    count = F.greatest(F.size(right) - step, F.lit(0))
    return F.zip_with(F.slice(left, 1, count), F.slice(right, step + 1, count), lambda a, b: F.xxhash64(a, b))


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(value, F.lit(buckets))


@dataclass(frozen=True)
class Ratio:
    """Weights by bucket, in millionths, and the score below which a document is dropped."""

    weights: list[int]
    threshold: float | None

    def score(self) -> Column:
        """Mean weight of the n-grams of a row from :func:`with_ngrams`; 0 without words."""
        table = F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<long>")

        def total(hashes: str) -> Column:
            add = lambda sum_, h: sum_ + F.get(table, _bucket(h, len(self.weights)).cast("int"))
            return F.aggregate(hashes, F.lit(0).cast("long"), add)

        count = (F.size("_one") + F.size("_two")).cast("long")
        return F.when(count > 0, (total("_one") + total("_two")) / (F.lit(SCALE) * count)).otherwise(F.lit(0.0))


def fit_ratio(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    quantile: float = TRUSTED_QUANTILE,
) -> Ratio:
    """Counts n-grams of all documents and of the trusted ones, by bucket."""
    trusted = small(
        labels.where("quality = 1 and doc_id is not null")
        .select(F.col("doc_id").alias("_trusted"))
        .distinct()
        .withColumn("_half", F.pmod(F.xxhash64("_trusted", F.lit("held out")), F.lit(2)))
    )
    texts = docs.select("doc_id", "text")
    of_half = lambda half: F.coalesce(F.col("_half") == half, F.lit(False)).cast("long")
    counts = (
        with_ngrams(texts.join(trusted, F.col("doc_id") == F.col("_trusted"), "left"))
        .select(of_half(0).alias("_first"), of_half(1).alias("_second"), F.explode(F.concat("_one", "_two")).alias("_gram"))
        .groupBy(_bucket(F.col("_gram"), buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("_first").alias("first"), F.sum("_second").alias("second"))
    )
    raw, first, second = [0] * buckets, [0] * buckets, [0] * buckets
    for row in counts.collect():  # one row per bucket at most
        raw[row["bucket"]], first[row["bucket"]], second[row["bucket"]] = row["raw"], row["first"], row["second"]
    good = [a + b for a, b in zip(first, second, strict=True)]
    if not any(good):
        return Ratio([0] * buckets, None)
    if not (any(first) and any(second)):
        return Ratio(_weights(good, raw), None)
    by_first, by_second = (Ratio(_weights(half, raw), None) for half in (first, second))
    own = with_ngrams(texts.join(trusted, F.col("doc_id") == F.col("_trusted"))).where(F.size("_one") > 0)
    judged = own.select(F.when(F.col("_half") == 0, by_second.score()).otherwise(by_first.score()).alias("score"))
    scores = stored(judged, "scores")
    return Ratio(_weights(good, raw), exact_quantile(scores, "score", quantile))


def _weights(good: list[int], raw: list[int]) -> list[int]:
    """Log-likelihood ratio of each bucket, smoothed, in millionths."""
    n_raw, n_good = sum(raw) + SMOOTHING * len(raw), sum(good) + SMOOTHING * len(good)
    return [
        round(SCALE * (math.log((g + SMOOTHING) / n_good) - math.log((r + SMOOTHING) / n_raw)))
        for g, r in zip(good, raw, strict=True)
    ]


def exact_quantile(df: DataFrame, column: str, quantile: float) -> float | None:
    """``percentile`` of a double column of moderate numbers, however many; None without rows.

    The built-in gathers all values in one task. Here they are counted in cells of a thousandth
    at first, then those of the cells that hold the two ranks in finer ones, until each of the
    two holds one value.
    """
    value, rows = F.col(column), df.select(column).where(F.col(column).isNotNull())
    below, position, level = 0, None, 10
    while True:
        cell = F.floor(value * F.lit(2.0**level)) if level <= 50 else value
        cells = rows.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("least"), F.max(column).alias("most"))
        cells = sorted(cells.collect())
        if position is None:
            if not cells:
                return None
            position = quantile * (sum(c["n"] for c in cells) - 1)
        found = []
        for rank in (math.floor(position), math.ceil(position)):
            before = below
            for c in cells:
                if rank < before + c["n"]:
                    break
                before += c["n"]
            found.append((c, before))
        (low, below), (high, _) = found
        if low["least"] == low["most"] and high["least"] == high["most"]:
            break
        rows, level = rows.where((value >= low["least"]) & (value <= high["most"])), level + 10
    if low["least"] == high["least"]:
        return low["least"]
    return (math.ceil(position) - position) * low["least"] + (position - math.floor(position)) * high["least"]


def rate(docs: DataFrame, ratio: Ratio) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``score`` and ``kept``."""
    no_repeat = F.array().cast("array<struct<h:bigint,p:int>>")
    rated = (
        with_ngrams(docs.select("doc_id", "text"))
        .withColumn("_four", _paired(F.col("_two"), F.col("_two"), 2))
        .withColumn("_five", _paired(F.col("_four"), F.col("_one"), 4))
        .withColumn(
            "_sorted",
            F.when(
                F.size(F.array_distinct("_five")) < F.size("_five"),
                F.sort_array(F.transform("_five", lambda h, i: F.struct(h.alias("h"), i.alias("p")))),
            ).otherwise(no_repeat),
        )
        .withColumn(
            "_again",
            F.sort_array(
                F.transform(
                    F.filter(
                        "_sorted",
                        lambda e, i: F.coalesce(F.get("_sorted", i + 1)["h"] == e["h"], F.lit(False))
                        | F.coalesce(F.get("_sorted", i - 1)["h"] == e["h"], F.lit(False)),
                    ),
                    lambda e: e["p"],
                )
            ),
        )
        .withColumn("_lines", F.filter(F.split("_text", "\n"), lambda line: line.rlike(NOT_SPACE)))
    )
    # A repeated window covers five words, or as many as lie before the next one's start.
    reach = F.zip_with(
        "_again",
        F.slice("_again", 2, F.greatest(F.size("_again"), F.lit(1))),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(REPEAT_WINDOW)), F.lit(REPEAT_WINDOW)),
    )
    rated = rated.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(reach, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_repeat_words"),
        ratio.score().alias("score"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = F.lit(True) if ratio.threshold is None else F.col("score") >= F.lit(ratio.threshold)
    return rated.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passes)
