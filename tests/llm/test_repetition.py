import random

from frameloom.llm import repetition


def brute(words, run=5):
    n = len(words)
    hit = [False] * n
    for i in range(n - run + 1):
        if any(words[j : j + run] == words[i : i + run] for j in range(i)):
            for k in range(i, i + run):
                hit[k] = True
    return sum(hit)


def test_repeated_words_against_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        w = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randint(0, 40))]
        assert repetition.repeated_words(w) == brute(w)


def test_measures():
    n, rep, run, sent, line, pair, distinct, bits = repetition.measure("One two three four five. " * 3)
    assert (n, rep) == (15, 10) and run == sent == 2 / 3 and bits & 0b11 == 0b11
    assert repetition.measure(None) == repetition.measure("") == repetition.measure(" .. \n") == (0, 0, 0.0, 0.0, 0.0, 0.0, 1.0, 0)
    assert repetition.measure("a b c d")[1] == 0
    assert repetition.measure("word " * 200_000)[2] > 0.99


def texts(spark, rows):
    return spark.createDataFrame([("t", i, x) for i, x in enumerate(rows)], "table_name string, row_key bigint, text string")


def test_ledger_policies_and_ablation(spark):
    loop = "a b c d e " * 4
    df = texts(spark, [loop, "all words differ in this one", None, "", "one two three four. five six seven eight. one two three four."])
    book = repetition.ledger(df)
    assert [r.row_key for r in repetition.cases(book, repetition.POLICIES[0]).collect()] == [0]
    assert sorted(r.row_key for r in repetition.cases(book, repetition.Policy("x", 0b10)).collect()) == [4]
    assert [r.row_key for r in repetition.cases(book, repetition.Policy("x", 0b11, every=True)).collect()] == []
    a = {r.rule: r for r in repetition.ablation(book, [repetition.Policy("p", 0b11)]).collect()}
    assert (a["run_share"].n_cases, a["run_share"].n_without, a["sentence_share"].n_without) == (2, 1, 1)
    assert repetition.ledger(df.limit(0)).count() == 0
