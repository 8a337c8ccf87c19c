"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added up as log probabilities for each class, which is a
language or "other", none of the languages:

* the text: byte trigrams against one multinomial per declared language, counted
  over the whole corpus, hashed to ``BUCKETS`` and smoothed by the trigrams of all
  rows (the background), to which the probability is a ratio. "Other" is the better
  of the background and the rows of all codes too rare for a model; it starts from
  ``OTHER_SHARE``. Neighbouring trigrams are not independent, so a text speaks with
  the weight of ``TEXT_WEIGHT`` trigrams at most;
* the declared (markup) language: how often it is declared where the text alone
  speaks for a class;
* the suffix of the address, in the same way;
* the host: the share of each class among the host's documents, smoothed by
  that of its domain, which is smoothed by that of the corpus.

Counts are grouped aggregates over all documents and are joined back by their
keys as tables; a hot host or declaration is a skewed join of short rows (no
text), which adaptive execution splits. Languages are the declared codes with at
least ``LEAST_ROWS`` documents or ``LEAST_SHARE`` of all. The counts of trigrams
are a table; ``MOST_LANGUAGES`` languages at a time are sent to every task, and
beyond that the documents are passed over once more for each further block.

A document is rejected (``kept`` false) if it has no letters, its best class has a
posterior below ``LEAST_POSTERIOR``, or that class is "other" and nothing is
declared. Where "other" wins and a code is declared, the code stands: the text is
in a language too rare for a model, or in several at once.

Edge cases. Null and empty texts have no letters and are rejected, with a null
language. A null declaration, host or suffix is a value of its own that counts
like any other. Ties go to the first code in order. Repeated rows are judged
each. Further columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow.llm import words as w
from finflow.llm.store import dropped, small_batches, stored

BUCKETS = 1 << 15
LEAST_ROWS, LEAST_SHARE = 5, 1e-3
MOST_LANGUAGES = 256
OTHER_SHARE = 1e-3
TEXT_WEIGHT = 200
LEAST_POSTERIOR = 0.5
# Pseudo-counts of the parent level; a language also has those of so many trigrams of the background.
BACKGROUND_GRAMS = 1000.0
HOST_SMOOTHING, EVIDENCE_SMOOTHING, GRAM_SMOOTHING = 50.0, 1.0, 0.5

# Letters stay (lower-cased), all else is a space.
_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def trigrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams with a letter in the middle, and where they are."""
    b = _LETTER[data].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(BUCKETS).bit_length() + 1)
    at = np.flatnonzero(b[1:-1] != 0x20)
    return bucket[at].astype(np.int64), at


def _padded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space before and after each, so that trigrams stay inside a text."""
    rows = len(offsets) - 1
    out = np.full(len(data) + 2 * rows, 0x20, np.uint8)
    shift = 2 * np.repeat(np.arange(rows), np.diff(offsets)) + 1
    out[np.arange(len(data)) + shift] = data
    return out, offsets + 2 * np.arange(rows + 1)


def gram_counts(docs: DataFrame) -> DataFrame:
    """``declared, bucket, n`` over the whole table; a null declaration is a value."""

    def rows(totals: dict[str | None, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for code, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {"declared": pa.array([code] * len(some), pa.string()), "bucket": pa.array(some), "n": pa.array(total[some])}
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str | None, np.ndarray] = {}
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            declared = np.array(batch.column(batch.schema.get_field_index("declared")).to_pylist(), object)
            for a, b in w.runs(offsets):
                part, own = _padded(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                bucket, at = trigrams(part)
                owner = np.searchsorted(own, at, "right") - 1
                codes = declared[a:b]
                for code in set(codes):
                    count = np.bincount(bucket[(codes == code)[owner]], minlength=BUCKETS)
                    totals[code] = totals[code] + count if code in totals else count
                    if len(totals) > MOST_LANGUAGES:
                        yield from rows(totals)
                        totals.clear()
        yield from rows(totals)

    counted = docs.mapInArrow(run, "declared string, bucket long, n long")
    return counted.groupBy("declared", "bucket").agg(F.sum("n").alias("n"))


def _modelled(docs: DataFrame) -> list[str]:
    """The codes with rows enough for a model, in order."""
    shares = docs.groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    total = shares.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    enough = shares.where((F.col("n") >= min(LEAST_ROWS, total * LEAST_SHARE)) & F.col("declared").isNotNull())
    return sorted(r["declared"] for r in enough.collect())


def _by_bucket(counts: DataFrame) -> np.ndarray:
    out = np.zeros(BUCKETS)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def _ratios(counts: np.ndarray, background: np.ndarray) -> np.ndarray:
    """Log probability of each bucket by ``counts``, less that of the background."""
    share = (counts / background + BACKGROUND_GRAMS) / (counts.sum(-1, keepdims=True) + BACKGROUND_GRAMS)
    return np.log(share).astype(np.float32)


def _scores(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text by each row of ``table``, and how many trigrams it has."""
    rows = len(offsets) - 1
    scores, sizes = np.zeros((rows, len(table))), np.zeros(rows, np.int64)
    for a, b in w.runs(offsets):
        part, own = _padded(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        bucket, at = trigrams(part)
        bounds = np.searchsorted(at, own)
        sizes[a:b] = np.diff(bounds)
        for i in range(len(table)):
            sums = np.append(0.0, np.cumsum(table[i][bucket], dtype=np.float64))
            scores[a:b, i] = sums[bounds[1:]] - sums[bounds[:-1]]
    return scores * np.minimum(1.0, TEXT_WEIGHT / np.maximum(sizes, 1))[:, None], sizes


def _scored_block(docs: DataFrame, table: np.ndarray, last: bool) -> DataFrame:
    """Adds the scores by ``table`` to ``text_score``.

    The last block, whose last row is that of the rare codes, puts "other" at the
    end, adds ``grams`` and ``says`` (the place of the best) and drops ``text``.
    """
    before = "text_score" in docs.columns
    kept = [f for f in docs.schema.fields if f.name != "text_score" and not (last and f.name == "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, sizes = _scores(*w.text_column(batch, "text"), table)
            if last:
                scores[:, -1] = np.maximum(scores[:, -1], 0.0) + np.log(OTHER_SHARE)
            if before and batch.num_rows:
                old = batch.column(batch.schema.get_field_index("text_score")).flatten().to_numpy()
                scores = np.hstack([old.reshape(batch.num_rows, -1), scores])
            ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * scores.shape[1])
            columns = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in kept}
            columns["text_score"] = pa.ListArray.from_arrays(ends, pa.array(scores.ravel()))
            if last:
                columns["grams"] = pa.array(sizes)
                columns["says"] = pa.array(scores.argmax(1).astype(np.int32), mask=sizes == 0)
            yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", text_score array<double>"
    return docs.mapInArrow(run, schema + (", grams long, says int" if last else ""))


def text_scores(docs: DataFrame) -> tuple[list[str], DataFrame]:
    """Languages, and the columns of ``docs`` without ``text`` and with ``text_score``, ``grams`` and ``says``."""
    languages = _modelled(docs)
    counts = stored(gram_counts(docs.select("text", "declared")), "grams")
    background = _by_bucket(counts) + GRAM_SMOOTHING
    background /= background.sum()
    rare = _by_bucket(counts.where(F.col("declared").isNotNull() & ~F.col("declared").isin(languages)))
    blocks = [languages[i : i + MOST_LANGUAGES] for i in range(0, len(languages), MOST_LANGUAGES)] or [[]]
    scored = docs
    for number, block in enumerate(blocks, 1):
        table, place = np.zeros((len(block), BUCKETS)), {code: i for i, code in enumerate(block)}
        for row in counts.where(F.col("declared").isin(block)).toLocalIterator() if block else ():
            table[place[row["declared"]], row["bucket"]] = row["n"]
        last, before = number == len(blocks), scored
        scored = stored(_scored_block(before, _ratios(np.vstack([table, rare]) if last else table, background), last), "language")
        if number > 1:
            dropped(before)
    dropped(counts)
    return languages, scored


def _counts_by(scored: DataFrame, keys: list[str], classes: int) -> DataFrame:
    """``keys, n``: how many texts of each value speak for each class."""
    pairs = scored.where("says is not null").groupBy(*keys, "says").agg(F.count(F.lit(1)).cast("double").alias("m"))
    each = pairs.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("says", "m"))).alias("_of"))
    places = F.sequence(F.lit(0), F.lit(classes - 1))
    return each.select(*keys, F.transform(places, lambda i: F.coalesce(F.try_element_at("_of", i), F.lit(0.0))).alias("n"))


def _sum(column: str) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda a, b: a + b)


def _joined(rows: DataFrame, evidence: DataFrame, key: str, name: str) -> DataFrame:
    """``rows`` with the column ``name`` of ``evidence``; nulls of ``key`` match."""
    side = evidence.select(F.col(key).alias("_key"), F.col(name))
    return rows.join(side, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def identify(docs: DataFrame) -> DataFrame:
    """Fused language of each row of ``docs``.

    ``docs``: ``text``, ``declared``, ``host``, ``domain``, ``suffix`` and any
    columns to carry along, which the result has too, with ``language``,
    ``posterior`` and ``kept``.
    """
    small_batches(docs.sparkSession)
    languages, scored = text_scores(docs)
    classes = len(languages) + 1  # the last is "other"
    flat = F.array_repeat(F.lit(0.0), classes)
    total = scored.where("says is not null").groupBy("says").agg(F.count(F.lit(1)).alias("n")).collect()
    whole = {r["says"]: r["n"] for r in total}
    count = sum(whole.values())
    prior = F.lit([(whole.get(i, 0) + 1.0) / (count + classes) for i in range(classes)])
    by_class = F.lit([float(whole.get(i, 0)) for i in range(classes)])

    rows = scored
    for key in ("declared", "suffix"):
        counts = _counts_by(scored, [key], classes)
        values = counts.count()
        # P(value | class), one pseudo-count per value.
        share = F.zip_with("n", by_class, lambda n, m: F.log((n + EVIDENCE_SMOOTHING) / (m + EVIDENCE_SMOOTHING * (values + 1))))
        rows = _joined(rows, counts.select(key, share.alias(f"_{key}")), key, f"_{key}")
    smooth = lambda n, parent: F.zip_with(
        n, parent, lambda a, p: (a + HOST_SMOOTHING * p) / (_sum(n) + HOST_SMOOTHING)
    )
    domains = _counts_by(scored, ["domain"], classes).select("domain", smooth("n", prior).alias("_domain_prior"))
    hosts = _joined(_counts_by(scored, ["host", "domain"], classes), domains, "domain", "_domain_prior").select(
        F.struct("host", "domain").alias("_host"), smooth("n", "_domain_prior").alias("_prior")
    )
    rows = _joined(rows.withColumn("_host", F.struct("host", "domain")), hosts, "_host", "_prior")

    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    fused = F.col("text_score")
    for part in ("_declared", "_suffix"):
        fused = add(fused, F.coalesce(part, flat))
    fused = add(fused, F.transform(F.coalesce("_prior", prior), lambda p: F.log(p)))
    rows = rows.withColumn("_fused", fused).withColumn("_top", F.array_max("_fused"))
    best = F.get(F.lit([*languages, None]).cast("array<string>"), (F.array_position("_fused", F.col("_top")) - 1).cast("int"))
    sure = 1 / F.aggregate(F.transform("_fused", lambda v: F.exp(v - F.col("_top"))), F.lit(0.0), lambda a, b: a + b)
    rows = rows.withColumn("language", F.when(F.col("grams") > 0, F.coalesce(best, "declared")))
    rows = rows.withColumn("posterior", F.when(F.col("grams") > 0, sure).otherwise(F.lit(0.0)))
    carried = [c for c in docs.columns if c not in ("text", "domain")]
    return rows.select(*carried, "language", "posterior", (F.col("language").isNotNull() & (F.col("posterior") >= LEAST_POSTERIOR)).alias("kept"))


def host_parts(host: Column) -> tuple[Column, Column]:
    """``(domain, suffix)``: the last two labels, and the last one if there are two."""
    labels = F.split(host, r"\.")
    domain = F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host)
    return domain, F.when(F.size(labels) > 1, F.element_at(labels, -1)).otherwise(F.lit(""))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence of ``documents``: the language column declares, the source is the host."""
    domain, suffix = host_parts(F.col("source"))
    return docs.select(
        "doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"), domain.alias("domain"), suffix.alias("suffix")
    )


_MARKUP = r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[a-z/!?][^>]*(?:>|\z)"


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of web pages: the ``lang`` of the markup, the parts of the address, the text between the tags."""
    from finflow.llm.urls import split_url

    host, _ = split_url(F.col("url"))
    domain, suffix = host_parts(host)
    # What is opened and never closed reaches to the end, as in a browser, so a page is gone through once.
    bare = F.regexp_replace("html", _MARKUP, " ")
    declared = F.nullif(F.regexp_extract("html", r'(?i)<html\b[^>]*\blang\s*=\s*["\']?([a-z]{2,3})', 1), F.lit(""))
    return pages.select(
        "page_id", bare.alias("text"), F.lower(declared).alias("declared"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix")
    )
