"""Operators against plain Python, on awkward rows and on the smallest tables."""

import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402

from finflow.llm import language, licenses, mixing, nearcopies, phrases, pii, quality, repeats, urls, warc  # noqa: E402
from finflow.llm import words as w  # noqa: E402
from finflow.llm.queries import BAD_HOST_WORDS, QUERIES, THIN_PERCENT, URL_RULES  # noqa: E402

LONG = " ".join(f"long{i % 977} word{i % 31}" for i in range(20_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ROWS = [
    (1, f"alpha beta {PASSAGE} end", "en", "a"),
    (2, f"other start {PASSAGE} fin", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \t\n ", "fr", "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " tail", "en", "a"),
    (8, "Deux mots", "fr", "c"),
    (8, "Deux mots", "fr", "c"),
    (9, "deux MOTS", "fr", "c"),
    (None, f"alpha beta {PASSAGE} end", "en", "a"),
    (None, None, None, None),
    (10, "one line here\none line here\n\nother line here one line here one line here again and again", "en", "a"),
    (11, "Mail a.b@mail1.example.com, ip 10.0.0.256 or 10.0.0.25, +1 (988) 555-2485 4532015112830366 é@x", "en", "a"),
    (12, "Released under the MIT License. mit license MIT LICENSE apache license general public license", "en", "d"),
    (13, "x\x0bé\u00a0y z\u2003w", "en", "d"),
]


@pytest.fixture(scope="module")
def messy(spark):
    """Awkward documents, with further columns whose names operators use inside."""
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    for name in ("row", "key", "node", "shard", "base", "spans", "n_words", "score", "chunk", "size", "pass"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs.withColumn("n_chars", F.length("text").cast("long")).repartition(3)


@pytest.fixture(scope="module")
def nothing(messy):
    return messy.limit(0)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def pairs(rows=ROWS):
    return [(r[0], r[1]) for r in rows]


def test_words_cut_like_the_patterns():
    texts = ["Ab é1\u00a0c,d", "", "  x", LONG[:5000], "\u2003", "a\x1fb\x0cc"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    for table, pattern in ((w.NOT_SPACE, brute.SPACE_WORD), (w.ALPHANUMERIC, brute.ALNUM_WORD)):
        lowered = w.LOWER[data]
        found = w.find_words(lowered, offsets, table)
        got = [lowered[a:b].tobytes().decode() for a, b in zip(found.starts, found.ends)]
        assert got == [x for t in texts for x in pattern.findall(brute.lower(t))]
        h = w.hash_words(lowered, found)
        assert len({(g, int(x)) for g, x in zip(got, h)}) == len(set(got)) == len(set(h.tolist()))


def test_personal_data(spark, messy, nothing):
    found = pii.find_personal_data(messy, pii.labelled_lines(spark))
    of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).alias(k)
    counts = [of(k) for k in pii.KINDS[:4]]
    digest = F.sha2(pii.written("base").cast("binary"), 256).alias("digest")
    got = rows_of(found.select("doc_id", *counts, digest), "doc_id", *pii.KINDS[:4], "digest")
    assert got == sorted(brute.personal_data(pairs()), key=repr)
    assert pii.find_personal_data(nothing, pii.labelled_lines(spark)).count() == 0
    masked = pii.mask_personal_data(messy, pii.labelled_lines(spark))
    assert masked.columns == messy.columns
    text = masked.where("doc_id = 11").first()["text"]
    assert text.startswith("Mail <EMAIL>, ip 10.0.0.256 or <IP>, <PHONE>") and "4532015112830366" not in text
    unlabelled = pii.find_personal_data(messy, pii.labelled_lines(spark).limit(0))
    assert unlabelled.where("size(spans) <> size(base)").count() == 0


def test_base_patterns_by_brute_force():
    texts = [
        "a@b@c.d.e x..y@z-1.org.", "@a.b", "1.2.3.4.5.6.7.8", "999.1.1.1 1.1.1.1", "4532 0151-1283 0366 1", "+1+22 333 4444 5555",
        "+1 234 567 890 ", "0000-0000 0000", "1" * 300, "+" * 50 + "1 2 3", "a" * 500 + "@", "0001.02.3.0255", "٣.1.1.1.1",
    ]
    for t in texts:
        mine = pii.base_spans(t)
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in mine)
        assert brute.hashlib.sha256(text.encode()).hexdigest() == brute.personal_data([(1, t)])[0][5], t


def test_chain_is_accurate_on_held_out_lines(spark):
    rows = [
        (r["text"], [(s["start"], pii.KINDS.index(s["kind"]), s["end"]) for s in r["spans"]])
        for r in pii.labelled_lines(spark).collect()
    ]
    chain = pii.train_chain(rows[:500])
    right = 0
    for (_, wanted), got in zip(rows[500:], pii.chain_spans([t for t, _ in rows[500:]], chain)):
        right += sorted(k for _, k, _ in wanted) == sorted(k for _, k, _ in got)
    assert right >= 0.95 * len(rows[500:])
    clean = ["in 2024, page 12 of 300; 4.0. v1.2.3", "12:30 and 1,299 items, $4,000.00 1999-12-31", "card 4465758382889438 no"]
    assert pii.chain_spans(clean, chain) == [[], [], []]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    chain = pii.Chain({}, np.zeros((0, 3)), rng.normal(size=(3, 3)))
    score = rng.normal(size=(5, 4, 3))
    import itertools

    for s, path in zip(score, chain.decode(score)):
        value = lambda p: sum(s[t, y] for t, y in enumerate(p)) + chain.move[0, p[0]] + chain.move[p[-1], 0] + sum(  # noqa: E731, B023
            chain.move[a, b] for a, b in itertools.pairwise(p)
        )
        assert value(tuple(path)) == pytest.approx(max(value(p) for p in itertools.product(range(3), repeat=4)))


def test_licenses(messy, nothing):
    found = licenses.scan_licenses(messy)
    got = rows_of(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(brute.license_phrases(pairs()), key=repr)
    assert licenses.scan_licenses(nothing).count() == 0


def test_edited_license_body(spark):
    body = next(t.text for t in licenses.BODIES if t.name == "mit body").split()
    edited = " ".join(["lead"] * 7 + body[:30] + ["added", "words"] + body[30:60] + body[62:] + ["tail"] * 9)
    docs = spark.createDataFrame([(1, edited), (2, " ".join(body[:12])), (3, "nothing here")], "doc_id long, text string")
    spans = licenses.license_spans(docs).where("template = 'mit body'").collect()
    assert [(s["doc_id"], s["first"]) for s in spans] == [(1, 7)] and 0.8 < spans[0]["score"] <= 1


def test_license_body_with_words_in_between(spark):
    """A page header in the middle keeps the label; half a body, or its halves far apart, has none."""
    body = next(t.text for t in licenses.BODIES if t.name == "mit body").split()
    half = len(body) // 2
    extra = "page two of this file".split()
    docs = [
        (1, body[:half] + extra + body[half:]), (2, body[:half]), (3, body[:half] + ["far"] * 500 + body[half:]),
        (4, body[:half] + extra + body[half:] + body[:half] + extra + extra + body[half:]), (5, body[half:] + body[:half]),
    ]
    found = licenses.scan_licenses(spark.createDataFrame([(d, " ".join(ws)) for d, ws in docs], "doc_id long, text string"))
    labels = {r["doc_id"]: r["labels"] for r in found.collect()}
    assert "mit" in labels[1] and "mit" in labels[4] and labels[2] == labels[3] == ""
    spans = licenses.license_spans(spark.createDataFrame([(d, " ".join(ws)) for d, ws in docs], "doc_id long, text string"))
    assert spans.where("template = 'mit body' and doc_id = 4").count() == 2


def test_decontamination(spark, messy, nothing):
    items = [(1, " ".join(f"Shared{i}" for i in range(5, 40))), (2, "deux mots"), (3, None), (4, ""), (5, LONG[3000:3300]), (None, "alpha beta"), (2, "deux mots")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(brute.contamination(pairs(), items), key=repr)
    for block in (phrases.BLOCK_ITEMS, 2):
        found = phrases.contamination(messy.drop("row"), bench, block_items=block)
        found = found.withColumn("digest", F.sha2(F.array_join("item_ids", ",").cast("binary"), 256))
        assert rows_of(found, "doc_id", "n_words", "n_hit", "n_items", "digest", "contaminated") == expected
    assert phrases.contamination(nothing.drop("row"), bench).count() == 0
    assert phrases.contamination(messy.drop("row"), bench.limit(0)).where("n_hit > 0").count() == 0


def test_proximity_and_phrase_places(spark):
    docs = spark.createDataFrame([(1, "x a b c y c b a"), (2, "a z b z c z z z z z z z a"), (3, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("i", "A b c")], "item_id string, text string")
    found = phrases.matches(phrases.build_index(docs), items, within=4)
    assert rows_of(found.where("kind = 'phrase'"), "doc_id", "place", "length") == [(1, 1, 3)]
    assert {r["doc_id"] for r in found.where("kind = 'near'").collect()} == {1, 2}


def test_mixing(spark, messy, nothing):
    got = mixing.mix(messy, block=50).collect()
    assert len(got) == len(ROWS)
    sizes, taken, goal = {}, {}, {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        goal[r["source"]] = r["target"]
    for source, total in sizes.items():
        assert abs(taken[source] - goal[source]) <= 50 and goal[source] <= 2 * total
    assert sum(goal.values()) == pytest.approx(1.5 * sum(sizes.values()))
    columns = ("doc_id", "source", "size", "target", "taken")
    again = mixing.mix(messy.repartition(5), block=50)
    assert sorted((tuple(r[c] for c in columns) for r in got), key=repr) == rows_of(again, *columns)
    assert mixing.mix(nothing).count() == 0


def test_targets_end_when_all_sources_are_full(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), (None, 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes, share=3.0).collect()}
    assert got == {"a": 200.0, "b": 20.0, None: 0.0}


@pytest.mark.parametrize(("good", "bad", "size"), [(7, 9, 5), (9, 7, 12), (3, 40, 20), (400, 100, 250), (1, 1, 1)])
def test_hypergeometric_draws(good, bad, size):
    """Frequencies of small draws against the exact probabilities."""
    import math

    rng, draws = np.random.default_rng(good), 20_000
    got = np.bincount([mixing.hypergeometric(rng, good, bad, size) for _ in range(draws)], minlength=good + 1)
    of = lambda k: math.comb(good, k) * math.comb(bad, size - k) / math.comb(good + bad, size) if 0 <= size - k <= bad else 0.0
    chances = np.array([of(k) for k in range(len(got))])
    assert got[chances == 0].sum() == 0
    assert np.abs(got - draws * chances).max() < 5 * np.sqrt(draws * chances.max())


def test_splitting_beyond_a_billion_blocks():
    """Quotas add up, and draws spread as they should where numpy has no draw."""
    quotas = np.array([3 * 10**9, 10**9, 5, 2 * 10**10])
    out = mixing.split_quotas(quotas, 4, 7)
    assert (out.sum(axis=0) == quotas).all() and (out >= 0).all() and np.ptp(out.sum(axis=1)) <= 1
    total, n = int(quotas.sum()), 10**9
    rng = np.random.default_rng(1)
    drawn = np.array([mixing.hypergeometric(rng, n, total - n, total // 2) for _ in range(60)], float)
    deviation = (n * (1 - n / total) / 4) ** 0.5
    assert abs(drawn.mean() - n / 2) < 4 * deviation / 60**0.5 and 0.7 < drawn.std() / deviation < 1.3
    assert mixing.hypergeometric(rng, 0, 10**10, 5) == 0 and mixing.hypergeometric(rng, 10**10, 0, 5) == 5


def mixed_by_hand(docs, **options):
    return sorted(((d, s, n, round(g, 6), t) for d, s, n, g, t in brute.mixture(docs, **options)), key=repr)


@pytest.mark.parametrize("block", [1, 50, 128])
def test_mixture_block_by_block(spark, messy, small, block):
    """The words taken of every document: targets, permuted order and cut in plain Python."""
    columns = ("doc_id", "source", "size", "target", "taken")
    for docs in (messy, spark.read.parquet(f"{small}/documents.parquet")):
        rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
        got = sorted(((*r[:3], round(r[3], 6), r[4]) for r in rows_of(mixing.mix(docs, block=block), *columns)), key=repr)
        assert got == mixed_by_hand(rows, block=block)


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 5)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    assert got["b"] == 20 and got[None] == 10 and got["a"] == 200
    assert got["c"] == pytest.approx(1.5 * 1115 - 230)


def test_splitting_tree_keeps_quotas():
    quotas = np.array([1000, 300, 77, 0])
    split = mixing.split_quotas(quotas, 7, seed=1)
    assert (split.sum(0) == quotas).all() and np.ptp(split.sum(1)) <= 1 and (split >= 0).all()
    big = mixing.split_quotas(np.array([3 * 10**9, 10**9 + 1]), 2, seed=1)
    assert (big.sum(0) == [3 * 10**9, 10**9 + 1]).all() and abs(big[0].sum() - big[1].sum()) <= 1


def test_shard_texts_hold_the_words_drawn(spark, messy):
    shards = mixing.shard_texts(messy, block=50, shard_blocks=300).collect()
    words = sum(len(brute.SPACE_WORD.findall(r["text"])) for r in shards)
    assert words == sum(r["taken"] for r in mixing.mix(messy, block=50, shard_blocks=300).collect())
    assert len({r["shard"] for r in shards}) > 1


PAGES = [
    (1, "http://a.org/x", "a" * 1200), (2, "http://a.org/\r\n x", "a" * 1200), (3, None, None), (4, "u", ""),
    (5, "u", "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"), (6, "u", "x\r\n"), (7, "u", "\r\n\r\n"),
    (8, "u", "\r\ny\r\n\r\nz\r"), (9, "u", "é\r\n\r\nWARC/1.0\r\nContent-Length: 0"), (10, "u", "b" * 50_000), (11, "u", "a" * 1200),
    (12, "u", "\r\n"), (13, "u", "WARC/1.0\r\n" * 3), (14, "u", "c" * 999), (15, "u", "c" * 999),
]


@pytest.mark.parametrize(("compression", "split"), [("gzip", "128m"), ("none", "700")])
def test_warc_round_trip(spark, tmp_path, compression, split):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path, before = str(tmp_path / "archives"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        warc.write_archives(pages.coalesce(2), path, compression=compression)
        got = rows_of(warc.page_records(warc.read_archives(spark, path)), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
        assert got == sorted(brute.warc([(p, h) for p, _, h in PAGES]), key=repr)
        texts = {r["id"]: r["payload"] for r in warc.read_archives(spark, path, with_payload=True).where("type = 'response'").collect()}
        assert all(texts[f"<urn:page:{p}>"] == (h or "") for p, _, h in PAGES if p not in (1, 2))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_warc_of_repeated_ids_and_pages_of_magic(spark, tmp_path):
    a, b = "a" * 1100, "b" * 1100
    magic = "WARC/1.0\r\nContent-Length: 4\r\n" * 100_000
    pages = [(7, a), (7, b), (3, a), (None, b), (4, magic), (5, magic), (6, "\r\n\r\n".join([magic[:3000]] * 3)), (7, a)]
    wanted = sorted(brute.warc(pages), key=repr)
    for n, rows in enumerate((pages, pages[::-1])):
        path = str(tmp_path / f"archives{n}")
        warc.write_archives(spark.createDataFrame([(p, None, h) for p, h in rows], "page_id long, url string, html string").coalesce(1), path)
        got = warc.page_records(warc.read_archives(spark, path))
        assert rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == wanted


def test_warc_of_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "none"))
    assert warc.page_records(warc.read_archives(spark, str(tmp_path / "none"))).count() == 0


def test_language(spark, messy, nothing, small):
    found = {(r["doc_id"], r["declared"]): r for r in language.identify(language.document_evidence(messy)).collect()}
    assert found[(1, "en")]["language"] == "en" and found[(1, "en")]["kept"]
    assert not found[(4, None)]["kept"] and found[(3, "en")]["language"] is None
    assert language.identify(language.document_evidence(nothing)).count() == 0
    pages = language.page_evidence(spark.read.parquet(os.path.join(os.path.dirname(small), "sf0.01", "pages.parquet")))
    hidden = pages.withColumn("truth", F.col("declared")).withColumn("declared", F.when(F.col("page_id") % 2 == 0, F.col("declared")))
    got = language.identify(hidden).where("declared is null").select(F.avg((F.col("truth") == F.col("language")).cast("int"))).first()[0]
    assert got >= 0.98


def test_evidence_beyond_the_text_decides_short_texts(spark):
    rows = [(i, "the quick of and", "en", "a.uk") for i in range(40)] + [(i + 40, "der und die mit", "de", "b.de") for i in range(40)]
    rows += [(100, "x", None, "b.de"), (101, "x", None, "a.uk"), (102, "12 3", "de", "b.de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language.identify(language.document_evidence(docs)).where("doc_id >= 100").collect()}
    assert got[100]["language"] == "de" and got[101]["language"] == "en" and not got[102]["kept"]


WORDS_OF = {
    "en": "the of and with that this have from they which would there their about could people",
    "de": "der und die mit nicht auch sich eine werden wurde durch nach sein haben oder zwischen",
    "fi": "että hän minä olla mutta niin kuin kaikki täällä yhdessä hyvää päivää kiitos paljon",
    "is": "það ekki þessi hefur verið þegar alltaf ætla þetta öll börnin góðan dag takk fyrir",
    "qu": "ñuqa qam pay ñuqanchik wasi llaqta yachay munay rimay qillqay tiyay puriy",
}


def rare_languages(spark):
    """7,000 texts, six in a rare language (ids from 7000), two in a rarer one (7100), undeclared ones (7200, 7201)."""
    pick = random.Random(1)
    say = lambda code: " ".join(pick.choice(WORDS_OF[code].split()) for _ in range(30))
    rows = [(i, say(code), code, f"src{i % 3}") for i in range(7000) for code in ["de" if i % 4 == 0 else "en"]]
    rows += [(7000 + i, say("fi"), "fi", "src0") for i in range(6)] + [(7100 + i, say("is"), "is", "src1") for i in range(2)]
    rows += [(7200, say("fi"), None, "src2"), (7201, say("qu"), None, "src2"), (7202, say("en"), None, "src2")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("most", [256, 2])
def test_rare_languages(spark, monkeypatch, most):
    monkeypatch.setattr(language, "MOST_LANGUAGES", most)
    got = {r["doc_id"]: (r["language"], r["kept"]) for r in language.identify(language.document_evidence(rare_languages(spark))).collect()}
    assert all(got[i] == ("de" if i % 4 == 0 else "en", True) for i in range(7000))
    assert all(got[7000 + i] == ("fi", True) for i in range(6)) and all(got[7100 + i] == ("is", True) for i in range(2))
    assert got[7200] == ("fi", True) and got[7201] == (None, False) and got[7202] == ("en", True)


def test_language_query_reads_the_evidence_of_pages(spark, tmp_path):
    page = '<html lang="{}"><script>var the="of and"</script><p>{}</p></html>'
    rows = [(i, f"http://www.a{i % 3}.uk/{i}", page.format("en", WORDS_OF["en"])) for i in range(40)]
    rows += [(40 + i, f"http://m.b{i % 3}.de/{i}", page.format("DE-at", WORDS_OF["de"])) for i in range(40)]
    rows += [(100, "http://new.de/", "<p>x</p>"), (101, "http://new.uk/", "<p>x</p>"), (102, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    out = QUERIES["op6_language_id"](spark, str(tmp_path))
    assert out.columns == ["page_id", "declared", "language", "posterior", "kept"]
    got = {r["page_id"]: r for r in out.collect()}
    assert len(got) == 83 and got[45]["declared"] == got[45]["language"] == "de" and got[5]["language"] == "en"
    assert got[100]["language"] == "de" and got[101]["language"] == "en" and not got[102]["kept"]


def test_text_between_the_tags(spark):
    """Scripts, comments and tags go, also unclosed ones; a page full of unclosed ones takes no longer than its length."""
    pages = [
        ("<p>one</p><script>two</script> three", "one three"), ("a <SCRIPT x=1>b</Script > c", "a c"), ("a < b and c", "a < b and c"),
        ("a<!-- b --> c<!-- d", "a c"), ("a <style>b", "a"), ("a <b c", "a"), ("<script>" * 200_000, ""), ("x" + "<!--" * 200_000, "x"), ("<a" * 200_000, ""),
    ]
    rows = spark.createDataFrame([(i, "http://a.b/", html) for i, (html, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: " ".join(r["text"].split()) for r in language.page_evidence(rows).collect()}
    assert got == {i: text for i, (_, text) in enumerate(pages)}


def test_posterior_is_the_sum_of_four_logarithms(spark, small):
    """Text, declaration, suffix and smoothed host priors of every page, added up in plain Python."""
    import math

    evidence = language.page_evidence(spark.read.parquet(f"{small}/pages.parquet"))
    languages, scored = language.text_scores(evidence)
    rows, classes = scored.collect(), len(languages) + 1
    speaks = [r for r in rows if r["says"] is not None]
    whole = [sum(r["says"] == c for r in speaks) for c in range(classes)]
    prior = [(n + 1) / (len(speaks) + classes) for n in whole]

    def counts(*keys):
        out = {}
        for r in speaks:
            out.setdefault(tuple(r[k] for k in keys), [0.0] * classes)[r["says"]] += 1
        return out

    def smoothed(n, parent):
        return [(a + language.HOST_SMOOTHING * p) / (sum(n) + language.HOST_SMOOTHING) for a, p in zip(n, parent)]

    by, smooth = {k: counts(k) for k in ("declared", "suffix", "domain")}, language.EVIDENCE_SMOOTHING
    hosts = counts("host", "domain")
    wanted = {}
    for r in rows:
        total = list(r["text_score"])
        for key in ("declared", "suffix"):
            if (r[key],) in by[key]:
                total = [t + math.log((n + smooth) / (m + smooth * (len(by[key]) + 1))) for t, n, m in zip(total, by[key][r[key],], whole)]
        at = prior
        if (r["host"], r["domain"]) in hosts:
            at = smoothed(hosts[r["host"], r["domain"]], smoothed(by["domain"][r["domain"],], prior))
        total = [t + math.log(p) for t, p in zip(total, at)]
        top = max(total)
        best = [*languages, r["declared"]][total.index(top)]
        wanted[r["page_id"]] = (best, 1 / sum(math.exp(t - top) for t in total)) if r["grams"] else (None, 0.0)
    got = {r["page_id"]: (r["language"], r["posterior"]) for r in language.identify(evidence).collect()}
    assert got.keys() == wanted.keys() and len(got) > 20
    for page, (best, sure) in wanted.items():
        assert got[page][0] == best and got[page][1] == pytest.approx(sure, rel=1e-9)


def test_a_large_component_does_not_meet_itself(spark):
    """100,000 members of one component and four others; all pairs would be 10^10."""
    same = spark.range(100_000).select(F.lit(1).alias("key"), "id", F.lit(-1).alias("root"))
    rest = spark.createDataFrame([(1, 200_000, 1), (1, 200_001, 1), (1, 200_002, 2), (1, 5_000_000, 3), (2, 7, 1), (2, 8, 2)], "key int, id long, root int")
    open_ = same.unionByName(rest).select("key", F.col("id").alias("node"), "root", F.lit(10).alias("n_shingles"))
    assert nearcopies._beside_largest(open_).where("key = 1").count() == 4
    got = nearcopies._all_across(open_, 0.8)
    assert got.count() == got.distinct().count() == 4 * 100_000 + 5 + 1
    assert set(rows_of(got.where("a >= 200000 or b = 8"), "a", "b")) == {
        (7, 8), (200_000, 200_002), (200_000, 5_000_000), (200_001, 200_002), (200_001, 5_000_000), (200_002, 5_000_000),
    }


@pytest.mark.parametrize(("shingle", "threshold"), [(3, 0.85), (5, 0.8)])
def test_near_copies(messy, nothing, shingle, threshold):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in nearcopies.near_copies(messy, shingle, threshold).collect()}
    expected = {x for x in brute.near_copies(pairs(), shingle, round(100 * threshold)) if x[0] is not None and x[1]}
    assert {x for x in got if x[0] is not None and x[1]} == expected
    assert {(x[0], x[2], x[3]) for x in got if not x[1] and x[0] is not None} == {(3, 3, True), (4, 4, True), (5, 5, True)}
    assert (None, 63 - shingle + 1, 1, False) in got
    assert nearcopies.near_copies(nothing, shingle, threshold).count() == 0


def test_large_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(300)]
    rng = np.random.default_rng(5)
    rows = []
    for i in range(200):
        words = list(base)
        for at in rng.choice(300, 4, replace=False):
            words[at] = f"v{i}_{at}"
        rows.append((i, " ".join(words)))
    rows.append((500, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, nearcopies.near_copies(docs, 3, 0.85).collect()))
    assert got == sorted(brute.near_copies(rows, 3, 85))
    assert sum(r[3] for r in got) == 1


def test_unlike_texts_that_share_a_passage_go_the_exact_way(spark, monkeypatch):
    """Members of large groups that no turn connects; among them a few pairs that are near copies."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(70)]
    rows = []
    for i in range(150):
        own = [f"u{i}x{j}" for j in range(10)]
        rows.append((2 * i, " ".join(passage + own)))
        if i % 10 == 0:
            own[rng.randint(3, 6)] = "changed"
            rows.append((2 * i + 1, " ".join(passage + own)))
        if i % 10 == 5:  # much in common beside the passage, but too little
            rows.append((2 * i + 1, " ".join([*passage[:20], "x", *passage[21:40], "y", *passage[41:], *own[:8], "z", "z"])))
    rows += [(None, rows[3][1] + " end"), (9_000, rows[3][1] + " end of"), (None, "only a null id has this"), (None, "only a null id has this")]
    exact = []
    whole = nearcopies._rarest_across
    monkeypatch.setattr(nearcopies, "_rarest_across", lambda *a: exact.append(whole(*a)) or exact[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, nearcopies.near_copies(docs, 3, 0.85).collect()), key=repr)
    assert got == sorted(((d, n, c, k if d is not None else c is None) for d, n, c, k in brute.near_copies(rows, 3, 85)), key=repr)
    assert exact and exact[0].count() > 0


@pytest.mark.parametrize("most", [500_000, 0])
def test_tables_of_groups_are_of_numbers_and_open_rows(spark, monkeypatch, most):
    """Wide names and sets do not travel with groups, and closed groups do not come again; also where nothing is sent to all tasks."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):  # one large group of near copies, soon closed
        rows.append((i, " ".join(f"v{i}" if j == rng.randrange(120) else x for j, x in enumerate(words))))
    for i in range(80):  # unlike texts that share a passage, and a few near copies of them
        own = [f"u{i}x{j}" for j in range(10)]
        rows.append((100 + 2 * i, " ".join([f"p{j}" for j in range(70)] + own)))
        if i % 8 == 0:
            rows.append((101 + 2 * i, " ".join([f"p{j}" for j in range(70)] + own[:9] + ["end"])))
    rows += [(None, rows[-1][1] + " more"), (None, None), (7, rows[7][1])]
    made, asked = [], []
    whole, old = nearcopies._open_groups, nearcopies.stored
    monkeypatch.setattr(nearcopies, "MOST_BROADCAST", most)
    monkeypatch.setattr("finflow.llm.store.MOST_BROADCAST", most)
    monkeypatch.setattr(nearcopies, "stored", lambda df, name: made.append((name, dict(df.dtypes))) or old(df, name))
    monkeypatch.setattr(nearcopies, "_open_groups", lambda *a: asked.append((a[0].count(), whole(*a))) or asked[-1][1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, nearcopies.near_copies(docs, 3, 0.85).collect()), key=repr)
    assert got == sorted(((d, n, c, k if d is not None else c is None) for d, n, c, k in brute.near_copies(rows, 3, 85)), key=repr)
    assert not [name for name, types in made if "binary" in types.values() and name not in ("signatures", "classes", "wanted", "sets")]
    assert "rarest" in dict(made)
    assert len(asked) > 1 and asked[1][0] == asked[0][1][1] < asked[0][0]


def test_links_through_rows_without_an_id(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (None, " ".join(words[2:] + ["x", "y"])), (2, " ".join(words[4:] + ["x", "y", "z", "q"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, nearcopies.near_copies(docs, 3, 0.85).collect()), key=repr)
    assert got == sorted(brute.near_copies(rows, 3, 85), key=repr)
    assert {r[2] for r in got} == {1}


def test_signature_estimate_is_close():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.9):
        both = rng.integers(1, 1 << 62, int(2000 * share), dtype=np.int64).astype(np.uint64)
        rest = [rng.integers(1, 1 << 62, int(1000 * (1 - share)), dtype=np.int64).astype(np.uint64) for _ in range(2)]
        sets = [np.unique(np.append(both, r)) for r in rest]
        sig = [nearcopies.signatures(s, np.array([0, len(s)]), 1024) for s in sets]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        got = nearcopies.estimate(sig[0], sig[1], np.array([len(sets[0])]), np.array([len(sets[1])]))[0][0]
        assert abs(got - true) < 5 * np.sqrt(true * (1 - true) / 1024)


def test_links_of_later_turns_join_components(spark):
    turns = [[("b", "c"), ("d", "e"), ("x", "y")], [("c", "e"), ("f", "g")], [], [("a", "e"), ("g", "h"), ("b", "c")]]
    roots = None
    for added in turns:
        edges = spark.createDataFrame(added, "a string, b string")
        roots = nearcopies._joined_up(roots, edges)
    want = {**dict.fromkeys("abcde", "a"), **dict.fromkeys("fgh", "f"), "x": "x", "y": "x"}
    got = roots.collect()
    assert len(got) == len(want) and {r["node"]: r["root"] for r in got} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf1")], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in nearcopies.components(edges).collect()}
    assert len(got) == 63 and {got[bytes([i])] for i in range(61)} == {b"\x00"} and got[b"\xf1"] == b"\xf0"


def test_repeats(messy, nothing):
    found = repeats.remove_repeats(messy, chunk_bytes=5_000, bucket_words=500, keep_text=True)
    got = rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(brute.remove_repeats(pairs()), key=repr)
    longest = {r["doc_id"]: r["longest_repeat"] for r in found.collect()}
    assert longest[2] == 52 and longest[7] == 13 * 2**11 and longest[8] == 0
    assert repeats.remove_repeats(nothing).count() == 0


def test_sizes_follow_the_corpus(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert repeats.derived_sizes(docs) == (4 << 20, 1 << 20)
    for size, times in ((1 << 30, 1), (27 << 30, 3), (1 << 45, 32), (1 << 59, 32), (1 << 62, 1)):
        monkeypatch.setattr(repeats, "expected_bytes", lambda df, size=size: size)
        chunk, bucket = repeats.derived_sizes(docs)
        assert chunk == pytest.approx(times * (4 << 20), rel=1e-6) and min(bucket / (1 << 20), 32) == pytest.approx(times, rel=1e-6)


def test_largest_and_least_ids_are_ids(spark):
    rows = [(2**63 - 1, f"x {PASSAGE}"), (None, f"y {PASSAGE}"), (-(2**63), f"z {PASSAGE}"), (2**63 - 1, f"q {PASSAGE}")]
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(brute.remove_repeats(rows), key=repr)


def test_quality(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (10, 0)], "doc_id long, quality int")
    ratio = quality.fit_ratio(messy, labels)
    got = rows_of(quality.rate(messy, ratio), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == sorted(brute.quality(pairs()), key=repr)
    assert quality.rate(nothing, ratio).count() == 0
    none = quality.fit_ratio(messy, labels.limit(0))
    assert quality.rate(messy, none).where("kept = base_failed").count() == 0


def test_quality_tells_trusted_words(spark):
    good = [(i, " ".join(f"good{(i * 7 + j) % 50}" for j in range(30)), 1) for i in range(60)]
    bad = [(i, " ".join(f"bad{(i * 7 + j) % 50}" for j in range(30)), 0) for i in range(100, 160)]
    docs = spark.createDataFrame([r[:2] for r in good + bad], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in good + bad if r[0] % 2], "doc_id long, quality int")
    kept = {r["doc_id"] for r in quality.rate(docs, quality.fit_ratio(docs, labels)).where("kept").collect()}
    assert kept <= set(range(60)) and len(kept) >= 58


def test_quality_counts_every_trusted_document(spark):
    """One word of its own in each of more trusted documents than were once sampled."""
    docs = spark.range(20_400).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 64).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    ratio = quality.fit_ratio(docs, labels, buckets=16)
    assert ratio.weights == [0] * 16 and ratio.threshold is not None  # all are trusted, so both counts are the same
    few = quality.fit_ratio(docs, labels.limit(1), buckets=16)
    assert few.threshold is None


@pytest.mark.parametrize("quantile", [0.0, 0.002, 0.37, 0.5, 1.0])
@pytest.mark.parametrize("rows", [1, 2, 7, 3000])
def test_exact_quantile_is_the_built_in_one(spark, rows, quantile):
    """Ties, negative values, and values far closer than a cell."""
    i = F.col("id")
    scores = spark.range(rows).select((F.when(i % 5 == 0, -1.25).otherwise((i % 611) * 1e-9 - 0.5 * (i % 3))).alias("score"))
    assert quality.exact_quantile(scores, "score", quantile) == scores.agg(F.percentile("score", quantile)).first()[0]
    assert quality.exact_quantile(scores.limit(0), "score", quantile) is None


URLS = [
    (1, "http://example.org/es/x?q"), (2, "https://m.EXAMPLE.org/en/1#a"), (3, "http://a.com/fr/"), (4, "ftp://x.com/de/é"), (5, None),
    (6, "no scheme"), (7, "http://org"), (8, "http://org/"), (9, "http://notexample.org/es/"), (10, "http://spam-farm.net/x"), (11, "://"),
    (12, "http://a..com/fr/"), (13, "http://xcom/fr/"), (13, "http://xcom/fr/"), (14, "http://b.spam.org/en/1"), (15, "x://y://z.com/de/"),
]


def judged(url, listed=lambda host: any(b in host for b in BAD_HOST_WORDS)):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = brute.re.match(r"[^/?#]*", rest)[0]
        path = brute.re.match(r"[^?#]*", rest[len(host) :])[0]
        host = brute.lower(host)
    fits = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fits) if fits else (0, None, "block" if listed(host) else "allow")
    return host, path, rule[1], rule[2]


@pytest.mark.parametrize(("bits", "most"), [(12, 64 << 20), (1, 1)])
def test_url_rules(spark, bits, most):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    hosts = pages.select(urls.split_url(F.col("url"))[0].alias("key")).where(F.col("key").rlike("|".join(BAD_HOST_WORDS)))
    got = rows_of(urls.judge_urls(pages, rules, hosts, bits, most), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted(((p, *judged(u)) for p, u in URLS), key=repr)
    assert urls.judge_urls(pages.limit(0), rules, hosts.limit(0)).count() == 0


def test_cascade_is_exact_with_tiny_filters(spark):
    universe = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("xxhash64(key) % 7 = 0")
    cascades = urls.build_cascades(universe, listed, bits_per_key=3)
    assert len(cascades[0].blocks[0]) > 2
    assert universe.where(cascades[0].holds(F.col("key"))).exceptAll(listed).count() == 0
    assert universe.where(cascades[0].holds(F.col("key"))).count() == listed.count()


BY_BRUTE_FORCE = {
    "op1_pii": (brute.personal_data, ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")),
    "op2_license_scans": (brute.license_phrases, ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")),
    "op7_minhash_near_dedup": (brute.near_copies, ("doc_id", "n_shingles", "component_id", "kept")),
    "op8_substring_dedup": (brute.remove_repeats, ("doc_id", "n_words", "n_removed", "kept_sha256")),
    "op9_quality_rules": (brute.quality, ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")),
}


@pytest.mark.parametrize("name", sorted(BY_BRUTE_FORCE))
def test_query_on_whole_table(spark, small, name):
    answer, columns = BY_BRUTE_FORCE[name]
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(QUERIES[name](spark, small), *columns) == sorted(answer(docs), key=repr)


def test_decontamination_query(spark, small):
    docs = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(QUERIES["op3_benchmark_decontamination"](spark, small), *columns) == sorted(brute.contamination(docs, items), key=repr)


def test_page_queries(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows_of(QUERIES["op5_warc"](spark, small), *columns) == sorted(brute.warc([(r["page_id"], r["html"]) for r in pages]), key=repr)
    got = rows_of(QUERIES["op10_url_filters"](spark, small), "page_id", "host", "path", "rule", "verdict")
    sizes = {}
    for r in pages:
        sizes.setdefault(judged(r["url"])[0], []).append(len((r["html"] or "").encode()))
    mean = sum(map(sum, sizes.values())) / len(pages)
    thin = {host for host, s in sizes.items() if host and 100 * sum(s) / len(s) < THIN_PERCENT * mean}
    assert thin
    bad = lambda host: host in thin or any(b in host for b in BAD_HOST_WORDS)
    assert got == sorted(((r["page_id"], *judged(r["url"], bad)) for r in pages), key=repr)


def test_thin_hosts(spark):
    pages = [("http://a/1", "x" * 10), ("http://A/2", "x" * 30), ("http://b", "y" * 25), ("http://b/2", None), ("http://c", "é" * 50)]
    pages += [(None, "x"), ("no host", None)]
    found = urls.thin_hosts(spark.createDataFrame(pages, "url string, html string"))
    mean = (10 + 30 + 25 + 0 + 100 + 1 + 0) / 7
    assert [k for k, m in (("a", 20), ("b", 12.5), ("c", 100)) if 100 * m < 80 * mean] == [r[0] for r in rows_of(found, "key")]
    assert urls.thin_hosts(spark.createDataFrame([], "url string, html string")).count() == 0
