import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frameloom.llm import overlap

SCHEMA = "row_id bigint, split string, source string, caption string, video_path string"


def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in overlap.found(spark, df).collect())


def test_cases(spark):
    base = " ".join(f"w{i}" for i in range(20))
    four = " ".join(f"w{i}" if i % 5 else f"x{i}" for i in range(20))
    five = " ".join(f"w{i}" if i % 5 else f"x{i}" for i in range(19)) + " y"
    rows = [
        (1, "train", None, base.upper() + "!", "a/b/Clip_1.mp4"), (2, "test", "s", four, None), (3, "validation", "s", five, "x/clip-1.720p.webm"), (4, "train", "s", base, ""), (5, "test", None, None, "//.mp4"),
        (6, "train", None, "  ", None), (7, None, None, base, "clip1"), (8, "test", None, "one two", None), (9, "train", None, "One, two", None), (10, "train", None, "one two three", None), (11, "test", None, "...", "a/ ü9.x"), (12, "train", None, None, "Ü9"),
    ]
    assert found(spark, rows) == [(1, 2), (1, 3), (2, 4), (8, 9), (11, 12)]
    assert found(spark, []) == []


def brute(rows):
    tr = [(i, c.split()) for i, s, _, c, _ in rows if s == "train" and c and c.split()]
    ev = [(i, c.split()) for i, s, _, c, _ in rows if s in ("test", "validation") and c and c.split()]
    return sorted((min(i, j), max(i, j)) for i, a in tr for j, b in ev if overlap.within(a, b, int(max(len(a), len(b)) * 0.2 + 1e-9)))


@pytest.mark.parametrize("seed,longest", [(1, 4), (2, 12), (3, 30), (4, 60)])
def test_no_link_is_lost(spark, seed, longest):
    rng = random.Random(seed)
    bases = [[f"v{rng.randint(0, 30)}" for _ in range(rng.randint(1, longest))] for _ in range(12)]
    rows = []
    for i in range(160):
        w = list(rng.choice(bases))
        for _ in range(rng.randint(0, max(1, len(w) // 4))):
            k = rng.randint(0, len(w))
            op = rng.random()
            if op < 0.33:
                w.insert(k, f"n{rng.randint(0, 9)}")
            elif op < 0.66 and len(w) > 1:
                w.pop(min(k, len(w) - 1))
            elif k < len(w):
                w[k] = f"n{rng.randint(0, 9)}"
        rows.append((i, rng.choice(["train", "train", "test", "validation"]), "s", " ".join(w), None))
    want = brute(rows)
    assert want and found(spark, rows) == want


def test_a_caption_that_fills_a_third(spark):
    rows = [(i, "train" if i % 10 else "test", "s", "the same old caption of all" if i % 3 else f"only number {i} stands here alone", None) for i in range(200)]
    assert found(spark, rows) == brute(rows)


def test_very_long_caption(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    assert found(spark, [(1, "train", "s", long, None), (2, "test", "s", long + " more", None)]) == [(1, 2)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=9), st.lists(st.sampled_from("abc"), max_size=9), st.integers(0, 5))
def test_banded_distance(a, b, limit):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    assert overlap.within(a, b, limit) == (row[-1] <= limit)


def test_coverage(spark):
    w = " ".join(f"w{i}" for i in range(10))
    rows = [(1, "train", "s", "x y z " + w, None), (2, "test", "s", w + " q r", None), (3, "test", "s", "short one", None), (4, "test", "s", None, None)]
    got = {r.row: (r.n_words, r.n_covered) for r in overlap.coverage(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {2: (12, 10), 3: (2, 0)}


def test_report_counts(spark):
    rows = [(1, "train", "a", "p q", "c.mp4"), (2, "test", "b", "P Q", "d/c.mov"), (3, "test", None, "p q", None)]
    got = {(r.split, r.eval_source, r.train_source): (r.n_pairs, r.n_eval_rows, r.n_by_caption, r.n_by_path) for r in overlap.report(spark, spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("test", "b", "a"): (1, 1, 1, 1), ("test", None, "a"): (1, 1, 1, 0)}
