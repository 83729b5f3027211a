import random
from collections import defaultdict

import pytest

from frameloom.llm import captions

LABELS = captions.LABELS


def found(spark, rows, name="t"):
    df = spark.createDataFrame(rows, "k bigint, c string")
    return sorted((r.keep_key, r.copy_key) for r in captions.found(spark, {name: (df, "k", "c")}).collect())


def test_spelling_and_field_order(spark):
    rows = [
        (1, "A red fox, running!"), (2, "a  RED　fox-running"), (3, "aredfoxrun ning"), (4, "A red fox walking"), (5, None), (6, " .,; "), (7, ""),
        (8, "subject: a dog; action: runs"), (9, "Action = RUNS. | Subject=a  dog"), (10, '{"action": "runs", "subject": "A dog"}'), (11, "SUBJECT:a dog\r\nACTION:runs"),
        (12, "subject: a dog; action: runs; style: noir"), (13, "action: a dog; subject: runs"), (14, "so subject: a dog; action: runs"), (15, "[A red fox, running]"),
        (16, "STRASSE am See"), (17, "Straße am See"), (18, "subject: ; action: runs"), (19, "action: runs; subject:"), (20, "action: runs"),
    ]
    assert found(spark, rows) == [(1, 2), (1, 3), (1, 15), (8, 9), (8, 10), (8, 11), (16, 17), (18, 19)]


def test_broken_json_and_unknown_labels_are_plain(spark):
    rows = [(1, '{"subject": "a"'), (2, "subject a"), (3, '{"colour": "a"}'), (4, "colour: A"), (5, '{"subject": "a", "colour": "b"}'), (6, '{"colour": "b", "subject": "a"}'), (7, "{}x"), (8, "x")]
    assert found(spark, rows) == [(1, 2), (3, 4), (7, 8)]


def test_a_label_twice_counts_twice(spark):
    rows = [(1, "style: a; style: a; camera: b"), (2, "camera: b; style: a"), (3, "style:a|camera:b|style:a")]
    assert found(spark, rows) == [(1, 3)]


def test_many_fields_and_long_captions(spark):
    many = [f"style: v{i}" for i in range(300)]
    shuffled = random.Random(1).sample(many, 300)
    long = "word " * 200_000
    rows = [(1, "; ".join(many)), (2, "; ".join(shuffled)), (3, "; ".join(many[:-1])), (4, long), (5, long.upper()), (6, long + "x"), (7, ";" * 100_000 + "style"), (8, " " * 100_000)]
    assert found(spark, rows) == [(1, 2), (4, 5)]


def test_tables_stay_apart_and_may_be_empty(spark):
    a = spark.createDataFrame([(1, "x"), (2, "X")], "k bigint, c string")
    b = spark.createDataFrame([(1, "x")], "k bigint, c string")
    got = captions.found(spark, {"a": (a, "k", "c"), "b": (b, "k", "c"), "e": (b.limit(0), "k", "c")})
    assert [tuple(r) for r in got.select("table_name", "keep_key", "copy_key").collect()] == [("a", 1, 2)]


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, "x", "p", 3, 5), (2, "X.", "q", 4, 6)], "k bigint, c string, pairs string, f1 int, _salt int").withColumnRenamed("k", "seq")
    assert [(r.keep_key, r.copy_key) for r in captions.found(spark, {"t": (df, "seq", "c")}).collect()] == [(1, 2)]


def test_collapsed_counts(spark):
    df = spark.createDataFrame([(1, "x"), (2, "X"), (3, "y"), (4, None), (5, "!")], "k bigint, c string")
    got = sorted((r.k, r.n_copies) for r in captions.collapsed(spark, df, "k", "c").collect())
    assert got == [(1, 2), (3, 1)]


def test_collapsed_counts_both_tables(spark):
    a = spark.createDataFrame([(1, "x"), (2, "X"), (3, "y"), (4, None)], "k bigint, c string")
    b = spark.createDataFrame([(1, "Y!"), (5, "x"), (6, "y")], "n bigint, text string")
    got = captions.collapsed_tables(spark, {"a": (a, "k", "c"), "b": (b, "n", "text")})
    assert sorted((r.table_name, r.keep_key, r.caption, r.n_copies) for r in got.collect()) == [("a", 1, "x", 2), ("a", 3, "y", 1), ("b", 1, "Y!", 2), ("b", 5, "x", 1)]


def test_registered_collapse_covers_both_tables(spark, sf):
    from frameloom.llm import queries

    assert {r.table_name for r in queries.QUERIES["p1_collapsed_all"](spark, sf).select("table_name").distinct().collect()} == {"dataset_captions", "t2v_samples"}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(300):
        fields = [(rng.choice(LABELS), rng.choice(["a b", "c", "d e"])) for _ in range(rng.randint(1, 3))]
        if rng.random() < 0.4:
            rows.append((k, rng.choice(["a b c", "A-B C.", "abd", "c d e", "C, d e!"])))
        else:
            sep, eq = rng.choice([";", " | ", "\n"]), rng.choice([":", " = ", ": "])
            rows.append((k, sep.join(f"{rng.choice([str.upper, str.title, str])(f)}{eq}{v}" for f, v in fields)))
    groups = defaultdict(list)
    for k, c in rows:
        low = c.lower()
        parts = [p for s in low.split("\n") for q in s.split(";") for p in q.split("|")]
        labelled = all(p.strip().split(":")[0].split("=")[0].strip() in LABELS for p in parts)
        norm = lambda s: "".join(ch for ch in s if ch.isalnum())
        key = tuple(sorted(norm(p) for p in parts)) if labelled else norm(low)
        groups[labelled, key].append(k)
    want = sorted((min(g), k) for g in groups.values() for k in g if k != min(g))
    assert found(spark, rows) == want
