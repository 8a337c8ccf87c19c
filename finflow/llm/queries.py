"""The numbered queries over the given tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F  # noqa: F401

from finflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return build(spark, folder.rstrip("/"))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op8_substring_dedup")
def op8(spark, folder):
    """Words removed because their window starts in an earlier document."""
    from finflow.llm.repeats import remove_repeats

    return remove_repeats(table(spark, folder, "documents"))


@query("op9_quality_rules")
def op9(spark, folder):
    """Quality rules and the likelihood ratio of every document."""
    from finflow.llm.quality import fit_ratio, rate

    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return rate(docs, fit_ratio(docs, labels))


# Rules of the contract. Listed as bad are hosts with one of these words in their name, and hosts of thin pages.
URL_RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
BAD_HOST_WORDS = ("casino", "farm", "porn", "spam", "warez")
THIN_PERCENT = 80

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL_SQL = f"""
    with rests as (
        select page_id, coalesce(html, '') as html,
               coalesce(case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end, '') as rest
        from pages
    ),
    parts as (
        select row_number() over () as n, page_id,
               translate(regexp_extract(rest, '^[^/?#]*'), '{_CAPITALS}', '{_CAPITALS.lower()}') as host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
               strlen(html)::hugeint as bytes
        from rests
    ),
    bad as (
        select host from parts, (select sum(bytes) as all_bytes, count(*) as pages from parts)
        group by host, all_bytes, pages
        having regexp_matches(host, '{"|".join(BAD_HOST_WORDS)}')
               or (host <> '' and 100 * sum(bytes) * pages < {THIN_PERCENT} * all_bytes * count(*))
    ),
    rules(action, rule_host, rule_path) as (values {", ".join(map(str, URL_RULES))}),
    fits as (
        select n, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
               arg_max(action, length(rule_host || rule_path)) as action
        from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        group by n
    )
    select page_id, host, path, rule,
           coalesce(action, case when host in (from bad) then 'block' else 'allow' end) as verdict
    from parts left join fits using (n)"""


@query("op10_url_filters", _URL_SQL)
def op10(spark, folder):
    """Verdict on every url: the longest rule's, else that of the list of bad hosts."""
    from finflow.llm.urls import judge_urls, split_url, thin_hosts

    pages = table(spark, folder, "pages")
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    named = pages.select(split_url(F.col("url"))[0].alias("key")).distinct().where(F.col("key").rlike("|".join(BAD_HOST_WORDS)))
    return judge_urls(pages, rules, named.unionByName(thin_hosts(pages, THIN_PERCENT)).distinct())


@query("op3_benchmark_decontamination")
def op3(spark, folder):
    """Words of every document that lie in a benchmark item's window of 13 words."""
    from finflow.llm.phrases import contamination

    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated", "n_near",
    )


@query("op7_minhash_near_dedup")
def op7(spark, folder):
    """Components of documents whose sets of 3-word shingles overlap by 85 percent."""
    from finflow.llm.nearcopies import near_copies

    return near_copies(table(spark, folder, "documents"), shingle=3, threshold=0.85)


@query("op2_license_scans")
def op2(spark, folder):
    """License phrases and texts in every document."""
    from finflow.llm.licenses import scan_licenses

    return scan_licenses(table(spark, folder, "documents"))


@query("op1_pii")
def op1(spark, folder):
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    from finflow.llm.pii import KINDS, find_personal_data, labelled_lines, written

    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_personal_data(docs, labelled_lines(spark))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:4]],
        F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"),
    )


@query("op6_language_id")
def op6(spark, folder):
    """Language of every page from its text, markup, host and suffix."""
    from finflow.llm.language import identify, page_evidence

    found = identify(page_evidence(table(spark, folder, "pages")))
    return found.select("page_id", "declared", "language", "posterior", "kept")


@query("op4_mixing_sources")
def op4(spark, folder):
    """Words the mix takes of every document."""
    from finflow.llm.mixing import mix

    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "n_shards")


_WARC_SQL = """
    with payloads as (
        select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest
        from pages
    ),
    responses as (
        select payload_digest, max(page_id) as response from payloads where payload_bytes >= 1000 group by payload_digest
    )
    select page_id, payload_bytes, p.payload_digest,
           case when response is distinct from page_id and response is not null then 'revisit' else 'response' end as record_type,
           case when response is distinct from page_id then response end as refers_to
    from payloads p left join responses r on p.payload_digest = r.payload_digest and payload_bytes >= 1000"""


@query("op5_warc", _WARC_SQL)
def op5(spark, folder):
    """Pages written to WARC archives and read back."""
    from finflow.llm.warc import page_records, read_archives, write_archives
    from finflow.session import work_folder

    path = work_folder(spark, "archives")
    write_archives(table(spark, folder, "pages"), path)
    return page_records(read_archives(spark, path))


@query("op12_bpe_encoding")
def op12(spark, folder):
    """Token ids of every document, and the text they decode to."""
    import public_tokenizers

    from finflow.llm.bpe import decode, encode

    path = public_tokenizers.path("word_bpe_49k.json")
    found = decode(encode(table(spark, folder, "documents"), path), path)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.select(
        "doc_id", "n_tokens",
        digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


@query("op13_embedding_whitening")
def op13(spark, folder):
    """Whitened embeddings by component, with the variance each explains."""
    from finflow.llm.whitening import whiten

    return whiten(table(spark, folder, "embeddings"))


_NEGATIVES_SQL = """
    with vectors as (
        select row_number() over () as n, vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end) as label,
               list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as v
        from embeddings
        where label is not null and len(embedding) > 0
              and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
    ),
    scores as (
        select a.n, a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
               list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::bigint as score
        from vectors a join vectors r on a.vec_id % 100 = 0 and a.n <> r.n and len(a.v) = len(r.v)
    ),
    positives as (
        select n, anchor_id, vec_id as positive_id, score as positive_score,
               row_number() over (partition by n order by score desc, vec_id) as place
        from scores where same qualify place <= 5
    ),
    ranked as (
        select anchor_id, positive_id, row_number() over (partition by p.n, place order by score desc, vec_id)::int as rank,
               vec_id as negative_id, positive_score, score as negative_score
        from positives p join scores s using (n, anchor_id)
        where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
    )
    select * from ranked where rank <= 5"""


@query("op11_hard_negative_mining", _NEGATIVES_SQL)
def op11(spark, folder):
    """First rows of another label below each of an anchor's positives."""
    from finflow.llm.negatives import mine

    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), F.col("vec_id") % 100 == 0)
