"""Validation, frames, shards, joins, catalog: small cases by hand."""

import pytest
from pyspark.sql import functions as F

from frameloom import schemas
from frameloom.operators import catalog, frames, joins, samples, shards


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_resample(spark):
    r = lambda n, fps: one(spark, frames.resample(F.lit(n).cast("bigint"), F.lit(fps), 16.0, 5).alias("x"))[0]
    assert r(1, 30.0) == [0] and r(8, 32.0) == [0, 2, 4, 6] and r(100, 16.0) == [0, 1, 2, 3, 4] and r(0, 16.0) == [] and r(9, 0.0) == []


def test_uniform_and_segments(spark):
    u = lambda n: one(spark, frames.uniform(F.lit(n).cast("bigint"), 3).alias("x"))[0]
    assert u(0) == [] and u(3) == [0, 1, 2] and u(10) == [0, 4, 9]
    s = lambda n: [tuple(x) for x in one(spark, frames.segments(F.lit(n).cast("bigint"), 10, 5, 0.15).alias("x"))[0]]
    assert s(10) == [(0, 10)] and s(1) == [] and s(4) == [(0, 4)] and s(12) == [(0, 10), (5, 7)]


def test_pad_unpad(spark):
    v, m = one(spark, *frames.pad_or_crop(F.array(F.lit(1), F.lit(2)), 4, F.lit(0)))
    assert (v, m) == ([1, 2, 0, 0], [1, 1, 0, 0])
    assert one(spark, frames.unpad(F.array(*map(F.lit, v)), F.array(*map(F.lit, m))).alias("x"))[0] == [1, 2]
    assert one(spark, *frames.pad_or_crop(F.array(*map(F.lit, range(6))), 4, F.lit(0)))[0] == [0, 1, 2, 3]


def test_dropout_is_stable_and_near_its_rate(spark):
    df = spark.range(20000).select(frames.dropout(0.1, 5, F.col("id")).alias("a"), frames.dropout(0.1, 5, F.col("id")).alias("b"))
    assert df.where("a <> b").count() == 0
    assert 0.085 < df.where("a").count() / 20000 < 0.115


def test_records(spark):
    df = spark.createDataFrame([("a", None)], "id string, width bigint")
    r = samples.build_records(df, schemas.sample_schema("t2v")).first()
    assert (r.id, r.width, r.caption, r.vae_latent_bytes, r.vae_latent_shape) == ("a", 0, "", b"", [])
    with pytest.raises(ValueError, match="unfilled"):
        samples.build_records(df, schemas.sample_schema("t2v"), strict=True)
    assert schemas.tensor_names(schemas.sample_schema("text_only")) == ["text_embedding"]
    with pytest.raises(ValueError):
        schemas.tensor_names(spark.createDataFrame([], "x_bytes binary").schema)


def test_first_failure_takes_null_for_failure(spark):
    f = samples.first_failure([("a", F.lit(True)), ("b", F.lit(None).cast("boolean")), ("c", F.lit(False))])
    assert one(spark, f.alias("x"))[0] == "b"


def test_positions_are_a_bijection(spark):
    df = shards.positions(spark.range(1000), shards.hash_order(3, F.col("id")))
    assert sorted(r.idx for r in df.collect()) == list(range(1000))
    again = shards.positions(spark.range(1000).repartition(7), shards.hash_order(3, F.col("id")))
    assert df.join(again, ["id", "idx"]).count() == 1000
    assert shards.positions(spark.range(0), ["id"]).count() == 0


def test_sampler_sizes(spark):
    df = shards.sampler(spark.range(10), ["id"], 10, 2, 2)
    assert df.count() == 8 and df.groupBy("group").count().where("count = 4").count() == 2
    df = shards.sampler(spark.range(10), ["id"], 10, 8, 3, drop_last=False)
    assert df.count() == 24 and df.where("id = 0").count() == 3
    assert shards.kept_total(0, 4, 2, False) == 0


def test_mix(spark):
    assert shards.parse_mix("a:2, b:0,c") == {"a": 2, "c": 1}
    for bad in ("a:x", "a:0", ""):
        with pytest.raises(ValueError):
            shards.parse_mix(bad)
    files = spark.createDataFrame([("a", "2"), ("a", "1"), ("b", "0")], "root string, path string")
    got = shards.mix(spark.createDataFrame([("a", 2), ("b", 0)], "root string, repeats int"), files)
    assert [r.path for r in got.collect()] == ["1", "1", "2", "2"]
    with pytest.raises(ValueError):
        shards.mix(spark.createDataFrame([("a", 0)], "root string, repeats int"), files)


def test_locate_across_blocks(spark):
    f = spark.createDataFrame([("a", 70000), ("b", 0), ("c", 5)], "path string, len bigint")
    w = spark.createDataFrame([(0,), (65536,), (69999,), (70000,), (70004,), (70005,), (-1,)], "i bigint")
    got = {r.i: (r.path, r.row_in_file) for r in shards.locate(f, ["path"], "len", w, "i").collect()}
    assert got == {0: ("a", 0), 65536: ("a", 65536), 69999: ("a", 69999), 70000: ("c", 0), 70004: ("c", 4)}


def test_pack_and_chunks(spark):
    f = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3), ("d", 2)], "path string, rows bigint")
    got = {r.path: (r.shard, r.serve) for r in shards.pack(f, 2, 1, 3).collect()}
    assert {got["a"][0], got["b"][0]} == {0, 1} and got["c"][0] == got["b"][0] and got["d"][0] == got["a"][0] and got["a"][1] == 6
    assert shards.chunk_ids(spark.range(25), ["id"], 10).count() == 20
    assert shards.chunk_ids(spark.range(25), ["id"], 10, remainder=True, first=4).groupBy("chunk").count().orderBy("chunk").collect()[-1].asDict() == {"chunk": 6, "count": 5}


def test_zip_refuses_unequal_sides(spark):
    with pytest.raises(joins.CountMismatch):
        joins.zip_positions(spark.range(3), ["id"], spark.range(4).withColumnRenamed("id", "k"), ["k"], strict=True)


def test_upsert_and_patch(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").withColumn("t", F.lit(0))
    ch = spark.createDataFrame([("b", None, 5), ("c", 7, 1), ("c", 8, 2)], "k string, v int, t int")
    assert sorted(tuple(r) for r in catalog.upsert(base, ch, ["k"], "t").select("k", "v").collect()) == [("a", 1), ("b", None), ("c", 8)]
    with pytest.raises(ValueError):
        catalog.patch(base, ch, "k", ["v"])


def test_page(spark):
    df = spark.createDataFrame([(i, i // 2) for i in range(10)], "k int, t int")
    assert [r.k for r in catalog.page(df, "t", "k", 4, 3).collect()] == [5, 6, 7]
    assert catalog.page(df, "t", "k", 99, 3).count() == 0
    assert [r.k for r in catalog.page(df, "t", "k", 4, 2, descending=True).collect()] == [3, 2]


def test_file_stem(spark):
    df = spark.createDataFrame([(' .a/b:  "c"\n d. ',), ("???",), (None,)], "p string")
    assert [r[0] for r in df.select(samples.file_stem(F.col("p"))).collect()] == ["ab c d", "output", "output"]


def test_clips_of_any_length(spark, monkeypatch):
    from frameloom.plans import sample_queries as q

    rows = [(1, "a", 30.0, 108_000, 1280, 720), (2, "a", 16.0, 100_000, 100_000, 1080), (3, "a", 30.0, 150, 1280, 720), (4, "a", 30.0, None, None, 720), (5, "a", 1e5, 100_000, 640, 10**6), (6, "a", 30.0, 10**12, 1280, 720)]
    t = spark.createDataFrame(rows, "sample_no bigint, caption string, fps double, num_frames bigint, width bigint, height bigint")
    monkeypatch.setattr(q, "table", lambda s, d, name: t)
    rows_of = lambda name: {r.sample_no: tuple(r)[1:] for r in q.QUERIES[name](spark, "").collect()}
    assert rows_of("manifest_first_failure_all") == {1: ("duration",), 2: ("duration",), 3: (None,), 4: ("workflow",), 5: ("short",), 6: ("duration",)}
    assert {r.sample_no: len(r.indices) for r in q.frames_resample_all(spark, "").collect()} == {1: 77, 2: 77, 3: 77, 4: 0, 5: 16, 6: 77}
    assert set(rows_of("frames_uniform_all")) == set(rows_of("frames_random_crop_all")) == {1, 2, 3, 5, 6}
    assert rows_of("frames_segments_all")[1] == (13_499, 16) and rows_of("frames_segments_all")[6] == (124_999_999_999, 16)
    assert set(rows_of("crop_geometry_all")) == {1, 2, 3, 5, 6}
    for size, step, least in ((16, 8, 0.15), (16, 16, None), (5, 3, 0.5)):
        s = frames.segments(F.col("id"), size, step, least)
        sizes = frames.segment_sizes(F.col("id"), size, step, least)
        assert spark.range(200).where((F.size(s) != sizes[0]) | (F.coalesce(F.try_element_at(s, F.lit(-1))["length"], F.lit(0)) != sizes[1])).count() == 0
