"""Byte-pair encoding against the library that reads the same file."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from finflow.llm import bpe
from finflow.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Bpe(file.read())


def ids_of(own, text):
    return np.frombuffer(own.encode([text])[0], np.int32).tolist()


def test_merges_leftmost_of_lowest_rank():
    # 0 = a, 1 = b; aa -> 2 (rank 0), ab -> 3, 2a -> 4
    merges = bpe.Merges([(0, 0, 2), (0, 1, 3), (2, 0, 4)], 5)
    assert bpe.merge([0, 0, 0], merges) == [4]
    assert bpe.merge([0, 0, 0, 1], merges) == [2, 3]
    assert bpe.merge([1, 1], merges) == [1, 1]
    assert bpe.merge([0], merges) == [0] and bpe.merge([], merges) == []
    # A later rank may make a pair of an earlier one.
    assert bpe.merge([0, 1, 0, 1], bpe.Merges([(2, 2, 3), (0, 1, 2)], 4)) == [3]


def test_words_merged_together_are_merged_alone(own):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdehinorst'é漢", k=rng.randint(1, 40))).encode() for _ in range(3000)] + [b"a" * 64, b"a" * 65, b"x"]
    assert own.encode_words(words) == [own.encode_word(w) for w in words]
    assert own.encode_words([]) == []


def test_same_ids_and_texts_as_the_library(own, library):
    rng = random.Random(5)
    parts = [*"ab cd'sl'll\t\n\x1c\x85 ÉéÀİıſßẞΣσς1½²ªḉ’ 漢かがカ゚😀‍﻿힣가İ­"]
    parts += ["<|endoftext|>", "<|startoftext|>", "<|endof", "aaaa", "lol" * 5, "'re", " the ", "\r\n"]
    texts = ["", " ", "".join(parts), "x" * 3000]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(2000)]
    texts += ["".join(chr(rng.choice((rng.randint(0, 0x24F), rng.randint(0x2010, 0x2027), rng.randint(0, 0xD7FF)))) for _ in range(12)) for _ in range(500)]
    for text in texts:
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids_of(own, text) == wanted, repr(text)
        decoded = own.decode(pa.array([wanted], pa.list_(pa.int32()))).to_pylist()
        assert decoded == [library.decode(wanted, skip_special_tokens=False)]


def test_pieces_and_caches_do_not_change_ids(own, library, monkeypatch):
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdeé漢'", k=rng.randint(1, 9))) for _ in range(3000))
    wanted = library.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "MOST_CACHED", 20)
    monkeypatch.setattr(bpe, "LONGEST_CACHED", 4)
    assert ids_of(own, text) == wanted
    assert [len(x) // 4 for x in own.encode([text, "", text[:100], text])][::3] == [len(wanted)] * 2


def test_long_word(own, library):
    word = "".join(random.Random(7).choices("abcdefgh", k=60_000))
    assert ids_of(own, word) == library.encode(word, add_special_tokens=False).ids


def test_unsupported_file_says_why():
    with open(PATH, encoding="utf-8") as file:
        said = file.read()
    with pytest.raises(ValueError, match="dropout"):
        bpe.Bpe(said.replace('"dropout":null', '"dropout":0.5').replace('"dropout": null', '"dropout": 0.5'))


def test_rows_of_any_kind(spark, library):
    rows = [(1, "Hello World"), (2, None), (3, ""), (None, "x y"), (1, "Hello World"), (4, "long " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).withColumn("n_tokens", F.lit("clash"))
    found = bpe.decode(bpe.encode(docs, PATH), PATH)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in found.collect()), key=repr)
    wanted = []
    for d, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted.append((d, len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(wanted, key=repr)
    assert bpe.encode(docs.limit(0), PATH).collect() == []
    foreign = spark.createDataFrame([(1, 2, [518, None, 10**6, -1, 49407])], "doc_id long, n_tokens long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(foreign, PATH).collect()] == ["the</w> <|endoftext|>"]


def test_whole_table(spark, small, library):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    wanted = []
    for row in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.append((row["doc_id"], len(ids), digest(" ".join(map(str, ids))), digest(text)))
    assert sorted(map(tuple, QUERIES["op12_bpe_encoding"](spark, small).collect())) == sorted(wanted)
