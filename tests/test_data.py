"""Copies, compaction and value-count profiles: nulls, empty tables, collisions, hot groups, clashing names."""

import os

import pytest
from pyspark.sql import functions as F

from frameloom.operators import compaction, profile
from frameloom.operators.copies import label_copies


def _label(spark, rows, fp, **kw):
    df = spark.createDataFrame(rows, "k bigint, v string").withColumns({"f1": fp, "f2": F.lit(0).cast("bigint")})
    out = label_copies(spark, df, [], ["f1", "f2"], "k", ["v"], lambda a, b: a["v"] == b["v"], lambda a: [a["v"]], **kw)
    return sorted(tuple(r) for r in out.collect())


def test_copies(spark):
    rows = [(3, "a"), (1, "a"), (2, "b"), (9, "a")]
    assert _label(spark, rows, F.xxhash64("v")) == [(1, 3), (1, 9)]
    assert _label(spark, [], F.xxhash64("v")) == []


def test_collisions_are_resolved_exactly(spark):
    rows = [(1, "a"), (2, "b"), (3, "a"), (4, "b"), (5, "c"), (6, "b")]
    assert _label(spark, rows, F.lit(7).cast("bigint")) == [(1, 3), (2, 4), (2, 6)]


def test_hot_group_is_salted(spark):
    rows = [(i, "hot" if i % 3 else f"v{i}") for i in range(1, 400)]
    got = _label(spark, rows, F.xxhash64("v"), rows_per_salt=20)
    assert got == [(1, i) for i in range(2, 400) if i % 3]


def _tiny(spark, path, rows, files):
    df = spark.createDataFrame(rows, "sample_no bigint, id string, vae_latent_bytes binary, _keep string")
    for i in range(files):
        df.where(f"sample_no % {files} = {i}").coalesce(1).write.mode("append").parquet(path)


def test_consolidation(spark, tmp_path):
    rows = [(1, "a", b"x", "k"), (2, "a", b"x", "other"), (3, "a", b"", "k"), (4, "a", b"", None), (5, None, b"x", "k"), (6, None, b"x", "k"), (7, "a", None, "k"), (8, "b", b"x", "k")]
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    _tiny(spark, src, rows, 8)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    done = compaction.consolidate(spark, [src], out)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert (done.rows_in, done.rows_out, done.plan.out_files) == (8, 6, 1) and done.plan.files >= 8
    assert sorted(tuple(r) for r in done.copies.collect()) == [(1, 2), (3, 4)]
    back = spark.read.parquet(out)
    assert sorted(r.sample_no for r in back.collect()) == [1, 3, 5, 6, 7, 8] and back.columns == ["sample_no", "id", "vae_latent_bytes", "_keep"]
    assert sum(f.endswith(".parquet") for f in os.listdir(out)) == 1 and not os.path.exists(f"{out}.staging")


def test_consolidation_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "sample_no bigint, id string, vae_latent_bytes binary").write.parquet(f"{tmp_path}/e")
    done = compaction.consolidate(spark, [f"{tmp_path}/e"], f"{tmp_path}/o")
    assert (done.rows_in, done.rows_out) == (0, 0)


def test_split_plan_charges_little_for_tiny_files(spark, tmp_path):
    _tiny(spark, f"{tmp_path}/t", [(i, "a", b"x", None) for i in range(40)], 20)
    plan = compaction.plan_splits(spark, [f"{tmp_path}/t"], 1 << 20)
    assert plan.open_cost < 2000 and plan.out_files == 1
    with compaction.packed_scan(spark, plan):
        assert spark.read.parquet(f"{tmp_path}/t").rdd.getNumPartitions() <= 4  # one split per core at least


NUMBERS = "load_id bigint, num_frames bigint, fps double, name string, raw binary"


def test_profile_metrics(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 5, nan, "a", b""), (1, None, inf, "", None), (1, -1, -0.0, None, b"x"), (1, 5, 0.0, "a" * 70, b"x"), (2, 1, 1.0, "b", b"y"), (None, 1, None, "b", b"y")]
    p = {(r.load_id, r.column_name): r for r in profile.profile(profile.delta(spark.createDataFrame(rows, NUMBERS), "load_id")).collect()}
    f = p[1, "fps"]
    assert (f.n_rows, f.n_null, f.n_distinct, f.least, f.greatest, f.n_violations) == (4, 0, 3, 0.0, 0.0, 4)
    assert f.entropy == pytest.approx(1.5)
    n = p[1, "num_frames"]
    assert (n.n_null, n.n_distinct, n.least, n.greatest, n.n_violations) == (1, 2, -1.0, 5.0, 1)
    s = p[1, "name"]
    assert (s.n_null, s.n_distinct, s.n_violations, s.greatest) == (1, 3, 1, 70.0)
    assert p[None, "fps"].entropy is None


def test_signed_deltas_cancel(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, 1.0, "a", b""), (2, 6, 2.0, "b", b"")], NUMBERS)
    store = profile.CountStore(spark, f"file://{tmp_path}/counts")
    assert store.read().count() == 0
    store.apply(profile.delta(df, "load_id", ["num_frames"]))
    left = store.apply(profile.delta(df.where("load_id = 1"), "load_id", ["num_frames"], sign=-1))
    assert [(r.load_id, r.num, r.n) for r in left.collect()] == [(2, 6.0, 1)]
    os.mkdir(f"{tmp_path}/counts/v=9")  # an unfinished version doesn't count
    assert store.read().count() == 1


def test_medians_against_brute_force(spark):
    import random
    import statistics

    rng = random.Random(3)
    rows = [(rng.randint(1, 5), None if rng.random() < 0.1 else rng.choice([rng.randint(1, 9), rng.randint(1, 10**6)]), rng.choice([float("nan"), rng.gauss(0, 9), 1.5]), None, None) for _ in range(600)]
    m = {(r.load_id, r.column_name): r for r in profile.medians(profile.delta(spark.createDataFrame(rows, NUMBERS), "load_id", ["num_frames", "fps"])).collect()}
    for load in range(1, 6):
        for k, c in ((1, "num_frames"), (2, "fps")):
            ok = lambda r: r[k] is not None and r[k] == r[k]  # noqa: B023, E731
            assert m[load, c].own == pytest.approx(statistics.median(r[k] for r in rows if r[0] == load and ok(r)))
            assert m[load, c].others == pytest.approx(statistics.median(r[k] for r in rows if r[0] != load and ok(r)))


def test_shifted_of_one_load_and_of_none(spark):
    one = spark.createDataFrame([(1, 5, 0.0, "a", b"")] * 3, NUMBERS)
    got = {r.column_name for r in profile.shifted(profile.delta(one, "load_id", ["num_frames", "fps"])).collect()}
    assert got == {"num_frames", "fps"}  # one value fills each; fps is zero besides
    assert profile.shifted(profile.delta(one.limit(0), "load_id", ["fps"])).count() == 0
