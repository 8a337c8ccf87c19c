"""The corpus pipeline: each stage works on what the one before it kept.

A document is a row. Decisions are made by operators that return short rows and
are brought back by id and text hash: usually few rows are dropped or changed,
so their keys are broadcast (up to a fixed number of rows; beyond it the join
shuffles) and no text is shuffled. Null ids and ids that repeat with other
texts therefore need no rule of their own. Columns beyond those of
``documents`` are carried along; null and empty texts have no language and go
in the first stage. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.llm.language import document_evidence, identify
from finflow.llm.mixing import mix
from finflow.llm.nearcopies import near_copies
from finflow.llm.phrases import contamination
from finflow.llm.pii import labelled_lines, mask_personal_data
from finflow.llm.store import small, stored
from finflow.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# No SQL says the stages; tests/llm compares them with plain Python.
ORACLE_SQL = None


# Names the stages use beside a table's own columns.
_ID, _ROW, _LANG, _SOURCE = "_finflow_id", "_finflow_row", "_finflow_lang", "_finflow_source"


def _keyed(docs: DataFrame) -> DataFrame:
    """What the operators need: own columns cannot clash."""
    return docs.select("doc_id", "text", "lang", "source", F.xxhash64("text").alias("row"))


def _tagged(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_ROW, F.xxhash64("text"))


def _same(tagged: DataFrame, keys: DataFrame):
    return tagged["doc_id"].eqNullSafe(keys[_ID]) & (tagged[_ROW] == keys["_of_row"])


def _keys(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").alias(_ID), F.col("row").alias("_of_row")).distinct()


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and text are in ``gone`` (``doc_id``, ``row``)."""
    tagged, gone = _tagged(docs), small(stored(_keys(gone), "gone"))
    return tagged.join(gone, _same(tagged, gone), "left_anti").drop(_ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no sure language; ``lang`` becomes the language found."""
    found = identify(document_evidence(docs).withColumn("row", F.xxhash64("text")))
    changed = found.where(~F.col("kept") | ~F.col("language").eqNullSafe(F.col("declared"))).select(
        F.col("doc_id").alias(_ID), F.col("row").alias("_of_row"), F.col("declared").alias(_LANG),
        F.col("host").alias(_SOURCE), F.col("language").alias("_finflow_new"), F.col("kept").alias("_finflow_kept"),
    ).dropDuplicates([_ID, "_of_row", _LANG, _SOURCE])
    tagged, changed = _tagged(docs), small(stored(changed, "changed"))
    match = _same(tagged, changed) & tagged["lang"].eqNullSafe(changed[_LANG]) & tagged["source"].eqNullSafe(changed[_SOURCE])
    joined = tagged.join(changed, match, "left").where(F.coalesce("_finflow_kept", F.lit(True)))
    joined = joined.withColumn("lang", F.coalesce("_finflow_new", "lang"))
    return joined.drop(_ROW, *changed.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five words, 0.8).

    It is the one of the smallest id; of several rows with that id the one of the least
    text hash, and of rows equal in both the least by its other columns. Documents
    without words stay.
    """
    found = stored(near_copies(_keyed(docs), carry=("row",), named=True), "near")
    several = found.where("kept and component is not null").groupBy("component").agg(
        F.first("doc_id").alias("doc_id"), F.min("row").alias("row"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    several = stored(several, "several")
    gone = found.where(~F.col("kept")).select("doc_id", "row")
    if several.isEmpty():
        return _without(docs, gone)
    first = several.select("component", F.col("row").alias("_first"))
    other = found.where("kept").join(small(first), "component").where("row <> _first").select("doc_id", "row")
    rest = _tagged(_without(docs, gone.unionByName(other)))
    twice = small(stored(_keys(several), "twice"))
    own = F.struct("lang", "source", *[c for c in docs.columns if c not in ("lang", "source")])
    once = rest.join(twice, _same(rest, twice), "left_semi").groupBy("doc_id", _ROW).agg(F.min(own).alias("_least"))
    once = once.select(*[F.col("_least")[c].alias(c) for c in docs.columns])
    return rest.join(twice, _same(rest, twice), "left_anti").drop(_ROW).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in benchmark windows of 13 words."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _without(docs, contamination(_keyed(docs), items).where("contaminated"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts ``<KIND>`` in the place of personal data; ``n_chars`` follows the text."""
    masked = mask_personal_data(docs, labelled_lines(spark))
    return masked.withColumn("n_chars", F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, whole passes and drawn blocks together."""
    return mix(docs).select("doc_id", "source", "size", "source_size", "target", "taken", "n_shards")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("PII", personal_data),
    ("mixing", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
