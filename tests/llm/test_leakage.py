import random

import numpy as np
import pytest

from frameloom.llm import leakage

DOCS, ITEMS = "doc_id bigint, text string, similarity int", "item_id bigint, text string"


def found(spark, docs, items, **kw):
    d = spark.createDataFrame([(*x, 1) for x in docs], DOCS)
    return sorted((r.doc_id, r.item_id) for r in leakage.leaks(spark, d, spark.createDataFrame(items, ITEMS), **kw).collect())


def test_cases(spark):
    item = " ".join(f"w{i}" for i in range(20))
    docs = [(1, "before " + item.upper().replace(" ", ",\n") + " after"), (2, " ".join(f"w{i}" for i in range(4, 16))), (3, " ".join(f"w{i}" for i in range(4, 15))), (4, None), (5, ""), (6, item + " x " + item), (7, " ".join(f"w{i}" for i in range(19, -1, -1)))]
    items = [(1, item), (2, item + "!"), (3, None), (4, " "), (5, "w1 w2 w3")]
    assert found(spark, docs, items) == [(d, i) for d in (1, 2, 6) for i in (1, 2)]
    assert found(spark, docs, []) == [] and found(spark, [], items) == []


@pytest.mark.parametrize("block", [40, 10**6])
def test_against_brute_force(spark, block):
    rng = random.Random(7)
    words = [f"v{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(5, 40)))) for i in range(30)]
    docs = []
    for k in range(120):
        w = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        x = rng.choice(items)[1].split()
        a = rng.randint(0, len(x) - 1)
        docs.append((k, " ".join(w + x[a : a + rng.randint(1, 20)] + w[:5])))
    runs = lambda t: {tuple(t[i : i + 12]) for i in range(len(t) - 11)}
    want = sorted((d, i) for d, t in docs for i, x in items if runs(t.split()) & runs(x.split()))
    assert want and found(spark, docs, items, windows_per_block=block) == want


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(1)
    index = leakage.Index([(1, " ".join(f"w{i}" for i in range(60)))], 12, 3)
    turned = index.fps.copy()
    for k in range(len(turned)):
        for b in rng.choice(64, 3, replace=False):
            turned[k] ^= np.uint64(1 << int(b))
    p, q = index.near(turned)
    assert set(range(len(turned))) <= {int(a) for a, b in zip(p, q) if a == b}
    pairs = {(int(a), int(b)) for a, b in zip(p, q)}
    assert len(pairs) == len(p) and all(bin(int(turned[a] ^ index.fps[b])).count("1") <= 3 for a, b in pairs)


def test_similar_windows(spark):
    item = " ".join(f"word{i}" for i in range(12))
    near = item.replace("word11", "other")
    assert found(spark, [(1, near)], [(1, item)]) == []
    assert found(spark, [(1, near)], [(1, item)], radius=24, least=0.7) == [(1, 1)]
    assert leakage.similarity(item.split(), item.split()) == 1.0 and leakage.similarity(["a"], ["b"]) == 0.0


def test_very_long_document_and_vocabulary_bound(spark, monkeypatch):
    item = " ".join(f"q{i}" for i in range(14))
    doc = " ".join(f"n{i}" for i in range(150_000)) + " " + item
    assert found(spark, [(1, doc), (2, doc[:-4])], [(9, item)]) == [(1, 9), (2, 9)]
    v = leakage.Votes(2)
    a = v.look_up(["a", "b", "c"])
    v.clear()
    assert len(v.ids) == 0 and len(a) == 3


def test_items_with_words_changed_as_registered(spark):
    rng = random.Random(3)
    vocab = [f"v{i}" for i in range(400)] + ["a", "of", "to"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([40, 60])))) for i in range(20)]
    docs = []
    for k in range(60):
        w = rng.choice(items)[1].split()
        for p in rng.sample(range(len(w)), rng.randint(0, 8)):
            w[p] = rng.choice(vocab)
        docs.append((k, " ".join([*rng.sample(vocab, 5), *w[rng.randint(0, 2) :], *rng.sample(vocab, 5)])))
    want = {}
    for k, t in docs:
        for i, x in items:
            w, x = t.split(), x.split()
            sim = max((leakage.similarity(w[s : s + len(x)], x, 1) for s in range(len(w) - len(x) + 1)), default=0.0)
            if sim >= 0.8:
                want[k, i] = pytest.approx(sim)
    rows = leakage.near_items(spark, spark.createDataFrame([(*x, 1) for x in docs], DOCS), spark.createDataFrame(items, ITEMS), words_per_block=300).collect()
    assert len(want) > 20 and {(r.doc_id, r.item_id): r.similarity for r in rows} == want and len(rows) == len(want)


def test_very_long_document_holds_an_altered_item(spark):
    item = " ".join(f"q{i}" for i in range(40))
    doc = item.replace("q7 ", "x ") + " " + " ".join(f"q{i % 40}" if i % 3 else f"n{i}" for i in range(300_000)) + " " + item.replace("q20 ", "x ").replace("q30 ", "x ")
    d, i = spark.createDataFrame([(1, doc, 1)], DOCS), spark.createDataFrame([(9, item)], ITEMS)
    assert [(r.doc_id, r.item_id, r.similarity) for r in leakage.near_items(spark, d, i).collect()] == [(1, 9, pytest.approx(39 / 41, abs=0.01))]


def test_near_query_finds_items_altered_every_few_words(spark, monkeypatch):
    from frameloom.llm import queries

    item = " ".join(f"word{i}" for i in range(55))
    alter = lambda every: " ".join("other" if i % every == every - 1 else w for i, w in enumerate(item.split()))
    docs = [(1, f"so {alter(11)} then"), (2, f"so {alter(4)} then"), (3, item[:-8]), (4, None), (5, ""), (6, "so " + item)]
    t = {"documents": spark.createDataFrame(docs, "doc_id bigint, text string"), "eval_items": spark.createDataFrame([(1, item), (2, "word1 word2"), (3, None), (4, "")], ITEMS)}
    monkeypatch.setattr(queries, "table", lambda s, d, name: t[name])
    assert found(spark, docs, [(1, item)]) == [(3, 1), (6, 1)]
    got = {(r.doc_id, r.item_id): r.similarity for r in queries.p7_near(spark, "").collect()}
    assert got == {(1, 1): pytest.approx(100 / 119), (3, 1): 1.0, (6, 1): 1.0}
