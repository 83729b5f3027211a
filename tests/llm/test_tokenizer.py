import os
import random

import pytest

from frameloom.llm import tokenizer

pytestmark = pytest.mark.skipif(not os.path.exists(tokenizer.VOCABULARY), reason="no vocabulary file here")


@pytest.fixture(scope="module")
def vocabulary():
    return tokenizer.read_vocabulary()


@pytest.fixture(scope="module")
def table(vocabulary):
    return tokenizer.PerfectHash(vocabulary)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(os.path.dirname(tokenizer.VOCABULARY), "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_perfect_hash(vocabulary, table):
    assert all(table.get(k) == i for k, i in vocabulary.items())
    assert len(table.keys) == len(vocabulary) and table.get(b"no such entry at all") == -1


TEXTS = ["", " ", "a", "Hello world", "it's IT'S don't 'tis", "  two  spaces \n\n\t tabs\r\n", "<|endoftext|> plain", "1²½Ⅷ３ ٣٤", "日本語のテキスト、テスト。", "🙂🙃👩‍👩‍👧 é é", "\x00\x1c\x85​﻿", "x" * 5000, " 　\xa0 y", "ÀÉÎ ñ ß ẞ", "a" * 64 + "b"]


@pytest.mark.parametrize("text", TEXTS)
def test_same_ids_as_the_library(table, library, text):
    assert tokenizer.Encoder(table).encode(text) == library(text)


def test_random_unicode(table, library):
    rng = random.Random(5)
    enc = tokenizer.Encoder(table)
    pools = ["abcXYZ '.,!?\n\t 019", "äöüßéèñçÅ ", "你好世界テスト한글 ", "\U0001F600\U00010348𝔘٣৪ ", "\x1c\x1d\x85 ‍\xad "]
    for _ in range(400):
        t = "".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(1, 60)))
        assert enc.encode(t) == library(t)


def test_whole_table(spark, sf, library):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.ids for r in tokenizer.encode(spark, df).collect()}
    rows = df.select("doc_id", "text").collect()
    assert len(got) == len(rows) and all(got[r.doc_id] == (library(r.text) if r.text else []) for r in rows)


def test_round_trip_and_bounds(spark, vocabulary, table, monkeypatch):
    back = {i: k for k, i in vocabulary.items()}
    monkeypatch.setattr(tokenizer, "REMEMBERED", 3)  # the memory starts anew all the time
    enc = tokenizer.Encoder(table)
    for t in TEXTS:
        assert b"".join(back[i] for i in enc.encode(t)).decode() == t
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b", 7)], "doc_id int, text string, ids int")
    assert {r.doc_id: len(r.ids) for r in tokenizer.encode(spark, df).collect()} == {1: 0, 2: 0, 3: 2}
    assert tokenizer.encode(spark, df.limit(0)).count() == 0
