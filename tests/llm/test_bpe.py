import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_file(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts_encode_as_the_library_does(codec, library):
    rng = random.Random(1)
    parts = ["a", "th", "er", " ", "  ", "\n", "1", "é", "<|endoftext|>", "<|end", "'s", "ing", "\x00", "　", "日本", "😀", "=="]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        want = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == want
        assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


def test_both_ways_of_cutting_agree():
    for c in [*range(0x250), 0x2028, 0x3000]:
        text = f"a{chr(c)}b {chr(c)}{chr(c)}1{chr(c)} 's{chr(c)}  {chr(c)}"
        if not bpe.NOT_LATIN.search(text):
            assert bpe.LATIN_WORDS.findall(text) == bpe.WORDS.findall(text), c


def test_runs_without_a_break_stay_linear_and_right(codec, library):
    for text in ["a" * 5000, "aab" * 2000, "=" * 5000, " " * 5000, "😀" * 2000]:
        assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_cut_sequences_decode_with_replacements(codec, library):
    ids = library.encode("日本😀", add_special_tokens=False).ids
    for n in range(len(ids)):
        assert codec.decode(ids[:n]) == library.decode(ids[:n], skip_special_tokens=False)


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.Codec(bpe.read_file(PATH))
    text = "one two three four five one two three " * 20
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_columns_on_nulls_empties_and_no_rows(spark):
    tokenizer = bpe.Tokenizer(spark, PATH)
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (2, "", 6), (3, "a b", 7)], "doc_id long, text string, ids long")
    rows = df.withColumn("b", tokenizer.round_trip("text")).orderBy("doc_id").collect()
    assert [len(r.b.ids) for r in rows] == [0, 0, 0, 2] and [r.b.decoded for r in rows] == ["", "", "", "a b"]
    assert df.limit(0).withColumn("b", tokenizer.encode("text")).collect() == []
    lists = spark.createDataFrame([(None,), ([64],)], "i array<int>").select(tokenizer.decode("i").alias("t"))
    assert sorted(r.t for r in lists.collect()) == ["", "a"]
    assert df.withColumn("ids", tokenizer.encode("text")).select(F.sum(F.size("ids"))).first()[0] == 2
