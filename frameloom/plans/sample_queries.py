"""Queries of sample validation, records, frames, shards, joins and the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom import schemas
from frameloom.operators import catalog, frames, joins, samples, shards
from frameloom.plans.tables import table

TRAIN_FPS, NUM_FRAMES = 16.0, 77


def _t(spark, d):
    return table(spark, d, "t2v_samples")


def _finite(c):
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def _clip(spark, d):
    return _t(spark, d).withColumns({"rate": _finite(F.col("fps")), "n": F.when(F.abs("num_frames") < 100000, F.col("num_frames"))})


def _rules():
    n, r = F.col("n"), F.col("rate")
    return [
        ("workflow", samples.workflow_valid(F.col("caption"), r, n)),
        ("resolution", samples.has_resolution(F.col("width"), F.col("height"))),
        ("duration", samples.duration_fits(n, r, NUM_FRAMES, TRAIN_FPS)),
        ("short", samples.keeps_short(n, r, NUM_FRAMES, TRAIN_FPS, 1.0, 7, F.col("sample_no"))),
    ]


def manifest_basic(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).where(samples.basic_valid(F.col("caption"), F.col("file_name"), F.col("duration_sec"), F.col("fps"))).select("sample_no")


def manifest_valid(spark: SparkSession, d: str) -> DataFrame:
    return _clip(spark, d).where(samples.first_failure(_rules()).isNull()).select("sample_no")


def manifest_filter_counts(spark: SparkSession, d: str) -> DataFrame:
    return samples.filter_counts(_clip(spark, d), _rules())


def manifest_first_failure(spark: SparkSession, d: str) -> DataFrame:
    return _clip(spark, d).select("sample_no", samples.first_failure(_rules()).alias("failure"))


def frames_short_drop(spark: SparkSession, d: str) -> DataFrame:
    n, r, k = F.col("n"), F.col("rate"), F.col("sample_no")
    keep = lambda ratio: samples.keeps_short(n, r, NUM_FRAMES, TRAIN_FPS, ratio, 7, k)
    return _clip(spark, d).select("sample_no", keep(0.0).alias("keep_none"), keep(1.0).alias("keep_all"))


def frame_histogram(spark: SparkSession, d: str) -> DataFrame:
    return samples.frame_histogram(_t(spark, d), "num_frames")


def frames_resample(spark: SparkSession, d: str) -> DataFrame:
    return _clip(spark, d).select("sample_no", frames.resample(F.col("n"), F.col("rate"), TRAIN_FPS, NUM_FRAMES).alias("indices"))


def frames_uniform(spark: SparkSession, d: str) -> DataFrame:
    return _clip(spark, d).where("n > 0").select("sample_no", frames.uniform(F.col("n"), 8).alias("indices"))


def frames_segments(spark: SparkSession, d: str) -> DataFrame:
    s = frames.segments(F.col("n"), 16, 8, 0.15)
    return _clip(spark, d).where("n >= 0").select("sample_no", F.size(s).alias("n_segments"), F.element_at(F.concat(F.array(F.lit(0).cast("bigint")), F.transform(s, lambda x: x["length"])), -1).alias("last_length"))


def frames_random_crop(spark: SparkSession, d: str) -> DataFrame:
    s = frames.random_crop(F.col("n"), 16, 3, F.col("sample_no"))
    return _clip(spark, d).where("n > 0").select("sample_no", "n", s.alias("start")).where("start >= 0 AND start <= greatest(n - 16, 0)").select("sample_no", "n")


def _clip_all(spark, d):
    """As _clip, without its bound on the number of frames."""
    return _t(spark, d).withColumns({"rate": _finite(F.col("fps")), "n": F.col("num_frames")})


def manifest_valid_all(spark: SparkSession, d: str) -> DataFrame:
    return _clip_all(spark, d).where(samples.first_failure(_rules()).isNull()).select("sample_no")


def manifest_filter_counts_all(spark: SparkSession, d: str) -> DataFrame:
    return samples.filter_counts(_clip_all(spark, d), _rules())


def manifest_first_failure_all(spark: SparkSession, d: str) -> DataFrame:
    return _clip_all(spark, d).select("sample_no", samples.first_failure(_rules()).alias("failure"))


def frames_short_drop_all(spark: SparkSession, d: str) -> DataFrame:
    n, r, k = F.col("n"), F.col("rate"), F.col("sample_no")
    keep = lambda ratio: samples.keeps_short(n, r, NUM_FRAMES, TRAIN_FPS, ratio, 7, k)
    return _clip_all(spark, d).select("sample_no", keep(0.0).alias("keep_none"), keep(1.0).alias("keep_all"))


def frames_resample_all(spark: SparkSession, d: str) -> DataFrame:
    return _clip_all(spark, d).select("sample_no", frames.resample(F.col("n"), F.col("rate"), TRAIN_FPS, NUM_FRAMES).alias("indices"))


def frames_uniform_all(spark: SparkSession, d: str) -> DataFrame:
    return _clip_all(spark, d).where("n > 0").select("sample_no", frames.uniform(F.col("n"), 8).alias("indices"))


def frames_segments_all(spark: SparkSession, d: str) -> DataFrame:
    return _clip_all(spark, d).where("n >= 0").select("sample_no", *frames.segment_sizes(F.col("n"), 16, 8, 0.15))


def frames_random_crop_all(spark: SparkSession, d: str) -> DataFrame:
    s = frames.random_crop(F.col("n"), 16, 3, F.col("sample_no"))
    return _clip_all(spark, d).where("n > 0").select("sample_no", "n", s.alias("start")).where("start >= 0 AND start <= greatest(n - 16, 0)").select("sample_no", "n")


def crop_geometry_all(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).where("width > 0 AND height > 0").select("sample_no", *samples.crop_geometry(F.col("width"), F.col("height"), 832, 480))


def sample_records(spark: SparkSession, d: str) -> DataFrame:
    r = samples.build_records(_t(spark, d).drop("media_type"), schemas.sample_schema("t2v"))
    return r.select("id", "file_name", "caption", "media_type", "width", "height", "num_frames", F.size("vae_latent_shape").alias("n_axes"), F.octet_length("vae_latent_bytes").alias("n_bytes"))


def sample_names(spark: SparkSession, d: str) -> DataFrame:
    f = F.col("file_name")
    return _t(spark, d).select("sample_no", samples.sample_id(f).alias("stem"), samples.media_kind(f).alias("kind"), samples.derived(F.col("num_frames"), _finite(F.col("fps"))).alias("seconds"), samples.latent_frames(F.col("vae_latent_shape")).alias("latent_frames"), *samples.pixel_size(F.col("vae_latent_shape")))


def aspect_filter(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).where(samples.wide_enough(F.col("width"), F.col("height"))).select("sample_no")


def nonzero_pixels(spark: SparkSession, d: str) -> DataFrame:
    v = F.transform(F.col("embedding"), lambda x: F.when(F.col("vec_id") % 3 == 0, F.lit(0.0)).otherwise(x))
    return table(spark, d, "embeddings").where(samples.any_nonzero(v)).select("vec_id")


def compact_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_splits").select("row_id", samples.without_nulls(["num_inference_steps", "height", "num_frames"]).alias("doc"))


def caption_given(spark: SparkSession, d: str) -> DataFrame:
    raw = F.when(F.col("caption_id") % 2 == 0, F.to_json(F.array("caption"))).otherwise(F.concat(F.lit('"'), F.regexp_replace("caption", r'["\\\p{Cntrl}]', " "), F.lit('"')))
    return table(spark, d, "dataset_captions").where(samples.caption_given(raw)).select("caption_id")


def media_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_splits").select("row_id", samples.resolve_path("/data/set", F.col("video_path")).alias("path"))


def annotated(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "datasets").select("id")
    return samples.annotate(r, ["id"], role="sample", weight=[float(i) for i in range(60)])


def crop_geometry(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).where("width > 0 AND height > 0 AND width < 100000 AND height < 100000").select("sample_no", *samples.crop_geometry(F.col("width"), F.col("height"), 832, 480))


def pixel_scaling(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.element_at(samples.scale_pixels(F.array("l_quantity")), 1).alias("sym"), F.element_at(samples.scale_pixels(F.array("l_quantity"), False), 1).alias("unit"))


def prompt_file_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_splits").select("row_id", samples.file_stem(F.col("caption"), F.col("row_id")).alias("name"))


def trailing_numbers(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).select("sample_no", samples.trailing_number(samples.sample_id(F.col("file_name"))).alias("number"))


def chunks_fixed_rows(spark: SparkSession, d: str) -> DataFrame:
    c = shards.chunk_ids(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 1000)
    return c.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_key"))


def mix_repeat_roots(spark: SparkSession, d: str) -> DataFrame:
    roots = table(spark, d, "region").select(F.col("r_regionkey").alias("root"), (F.col("r_regionkey") - 1).alias("repeats"))
    return shards.mix(roots, table(spark, d, "nation").select(F.col("n_regionkey").alias("root"), F.col("n_name").alias("path")))


def _docs(spark, d):
    x = table(spark, d, "documents").select("doc_id")
    return x, x.count()


def shard_contiguous(spark: SparkSession, d: str) -> DataFrame:
    x, n = _docs(spark, d)
    return shards.positions(x, ["doc_id"]).select("doc_id", shards.contiguous(F.col("idx"), n, 7).alias("shard"))


def shard_cyclic_pad(spark: SparkSession, d: str) -> DataFrame:
    x, n = _docs(spark, d)
    return shards.cyclic_pad(x, ["doc_id"], n, 7)


def shard_strided_batches(spark: SparkSession, d: str) -> DataFrame:
    x, n = _docs(spark, d)
    return shards.sampler(x, ["doc_id"], n, 8, 3, drop_last=True, skip_first=True)


def shard_wrapped_batches(spark: SparkSession, d: str) -> DataFrame:
    x, n = _docs(spark, d)
    return shards.sampler(x, ["doc_id"], n, 64, 9, drop_last=False)


def shard_permutation(spark: SparkSession, d: str) -> DataFrame:
    """A seeded permutation: its positions, each document's exactly one."""
    x, n = _docs(spark, d)
    return shards.positions(x, shards.hash_order(11, F.col("doc_id"))).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("idx").alias("n_idx"), F.max("idx").alias("last"))


def validation_shard(spark: SparkSession, d: str) -> DataFrame:
    x, n = _docs(spark, d)
    return shards.validation_shard(x, ["doc_id"], n, 9)


def repeat_sampler(spark: SparkSession, d: str) -> DataFrame:
    x, _ = _docs(spark, d)
    return shards.repeat_sampler(x, 5, "doc_id", 4, 6, 3).groupBy("rank").agg(F.count(F.lit(1)).alias("n"))


def pack_files(spark: SparkSession, d: str) -> DataFrame:
    f = _t(spark, d).groupBy(F.col("chunk_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return shards.pack(f, 8, 3, 4).groupBy("shard").agg(F.sum("rows").alias("rows"), F.max("serve").alias("serve"))


def global_row_lookup(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("len"))
    w = table(spark, d, "orders").select((F.col("o_orderkey") * 5).alias("index"))
    return shards.locate(f, ["l_orderkey"], "len", w, "index").select("index", "l_orderkey", "row_in_file")


def ragged_batches(spark: SparkSession, d: str) -> DataFrame:
    return frames.ragged(_t(spark, d), "load_id", "vae_latent_shape")


def pad_sequences(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "story_presets").select("preset_no", F.transform(F.coalesce("segment_prompts", F.array().cast("array<string>")), lambda s: F.length(s)).alias("v"))
    p, m = frames.pad_or_crop(F.col("v"), 5, F.lit(0))
    x = x.select("preset_no", p, m)
    return x.withColumn("back", frames.unpad(F.col("values"), F.col("mask")))


def pad_to_longest(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "story_presets").where("segment_prompts IS NOT NULL").select("preset_no", (F.col("preset_no") % 10).alias("batch"), F.transform("segment_prompts", lambda s: F.length(s)).alias("v"))
    return frames.pad_to_longest(x, ["batch"], "v", F.lit(0)).select("preset_no", "padded", F.size(F.array_remove("mask", 0)).alias("n_real"))


def cfg_dropout(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "prompt_splits")
    return x.select("row_id", frames.dropout(0.0, 9, F.col("row_id")).alias("never"), frames.dropout(1.0, 9, F.col("row_id")).alias("always"))


def tensor_stats(spark: SparkSession, d: str) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, d, "embeddings").select("vec_id", v.alias("v")).select("vec_id", *[c.alias(k) for k, c in frames.tensor_stats(F.col("v")).items()])


def zip_positional(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "datasets").select("id")
    b = table(spark, d, "name_parts").where("name_part IS NOT NULL").select("name_part").orderBy("name_part").limit(60)
    return joins.zip_positions(a, ["id"], b, ["name_part"], strict=True)


def leftover_refs(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "datasets").select("id")
    b = table(spark, d, "eval_items").select("item_id")
    return joins.zip_with_rest(a, ["id"], b, ["item_id"], "id")


def unknown_refs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "dataset_captions").where("file_name IS NOT NULL").select("caption_id", "file_name")
    return joins.unknown_references(c, _t(spark, d), ["file_name"]).select("caption_id")


def take_pairing(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("take"), "l_partkey", "l_suppkey")
    return joins.paired_takes(li, ["l_orderkey"], "take", F.struct("l_suppkey", "l_partkey"), "l_partkey")


def unpaired_takes(spark: SparkSession, d: str) -> DataFrame:
    return joins.unpaired(table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("take")), ["l_orderkey"], "take")


def present_in_all(spark: SparkSession, d: str) -> DataFrame:
    t = _t(spark, d).select("dataset_id")
    return joins.present_in_all([t.where("load_id <= 2"), t.where("load_id > 2"), table(spark, d, "datasets").select(F.col("id").alias("dataset_id"))], "dataset_id")


def renamed_keys(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d).select("sample_no", joins.renamed(F.col("chunk_path"), "latents/", "conditions/").alias("key"))


def caption_upsert(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "dataset_captions").where("dataset_id IS NOT NULL AND file_name IS NOT NULL").select("dataset_id", "file_name", "caption", "caption_id")
    base = c.where("caption_id % 3 = 0").groupBy("dataset_id", "file_name").agg(F.max_by("caption", "caption_id").alias("caption"), F.max("caption_id").alias("caption_id"))
    return catalog.upsert(base, c.where("caption_id % 3 <> 0"), ["dataset_id", "file_name"], "caption_id").select("dataset_id", "file_name", "caption", "caption_id")


def caption_patch(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    ch = c.where("c_custkey % 5 = 0").select("c_custkey", F.upper("c_mktsegment").alias("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, F.lit("x")).alias("c_name"))
    return catalog.patch(c, ch, "c_custkey", ["c_name", "c_mktsegment"])


def catalog_delete(spark: SparkSession, d: str) -> DataFrame:
    return catalog.delete(table(spark, d, "datasets").select("id", "name"), _t(spark, d).where("dataset_id IS NOT NULL AND load_id = 1").select(F.col("dataset_id").alias("id")), ["id"])


def page_cursor(spark: SparkSession, d: str) -> DataFrame:
    return catalog.page(table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice"), "o_orderdate", "o_orderkey", 77, 500)


def newest_first(spark: SparkSession, d: str) -> DataFrame:
    return catalog.newest_first(table(spark, d, "datasets").select("id", "created_at"), "created_at", "id", F.col("created_at") > 1.73e9)


def merged_lists(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "dataset_captions").select(F.lit("caption").alias("kind"), F.col("caption_id").alias("key"), F.col("uploaded_at").alias("at"))
    b = table(spark, d, "prompt_splits").select(F.lit("prompt").alias("kind"), F.col("row_id").alias("key"), F.col("added_at").alias("at"))
    return catalog.merged([a, b], "at")


def captions_of_files(spark: SparkSession, d: str) -> DataFrame:
    f = _t(spark, d).select("sample_no", "dataset_id", "file_name")
    c = table(spark, d, "dataset_captions").select("dataset_id", "file_name", F.col("caption_id"))
    return catalog.with_captions(f, c, ["dataset_id", "file_name"]).select("sample_no", "caption_id")


def replica_choice(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", (F.col("s_acctbal") > 5000).alias("up"), (F.col("s_suppkey") % 3 == 0).alias("main"))
    return catalog.first_healthy(s, "s_nationkey", "up", "main", "s_suppkey")


def dims_explode_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "story_presets").select(F.explode(F.split("label", " ")).alias("dimension")).groupBy("dimension").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (
    manifest_basic, manifest_valid, manifest_filter_counts, manifest_first_failure, frames_short_drop, frame_histogram, frames_resample, frames_uniform, frames_segments,
    frames_random_crop, sample_records, sample_names, aspect_filter, nonzero_pixels, compact_json, caption_given, media_paths, annotated, crop_geometry, pixel_scaling,
    prompt_file_names, trailing_numbers, chunks_fixed_rows, mix_repeat_roots, shard_contiguous, shard_cyclic_pad, shard_strided_batches, shard_wrapped_batches,
    shard_permutation, validation_shard, repeat_sampler, pack_files, global_row_lookup, ragged_batches, pad_sequences, pad_to_longest, cfg_dropout, tensor_stats,
    zip_positional, leftover_refs, unknown_refs, take_pairing, unpaired_takes, present_in_all, renamed_keys, caption_upsert, caption_patch, catalog_delete, page_cursor,
    newest_first, merged_lists, captions_of_files, replica_choice, dims_explode_group,
    manifest_valid_all, manifest_filter_counts_all, manifest_first_failure_all, frames_short_drop_all, frames_resample_all,
    frames_uniform_all, frames_segments_all, frames_random_crop_all, crop_geometry_all,
)}

_C = "(SELECT *, CASE WHEN isfinite(fps) THEN fps END AS rate, CASE WHEN abs(CAST(num_frames AS DOUBLE)) < 100000 THEN num_frames END AS n FROM t2v_samples)"
_COUNT = f"CASE WHEN rate > 0 AND n > 0 THEN CAST(ceil(n / (rate / {TRAIN_FPS} * 1.0)) AS BIGINT) ELSE 0 END"
_FAIL = f"""CASE WHEN NOT coalesce(caption <> '' AND rate > 0 AND n > 0, false) THEN 'workflow' WHEN width IS NULL OR height IS NULL THEN 'resolution'
  WHEN coalesce(n / rate > 2.0 * ({NUM_FRAMES} / {TRAIN_FPS}), false) THEN 'duration' WHEN {_COUNT} < {NUM_FRAMES} THEN 'short' END"""
_EXT = "lower(regexp_extract(file_name, '[^/]*$'))"
_KIND = f"CASE regexp_replace({_EXT}, '^.*\\.', '') WHEN 'mp4' THEN 'video' WHEN 'jpg' THEN 'image' END"
_IDX = "(SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx, count(*) OVER () AS n FROM documents)"
ORACLES = {
    "manifest_basic": f"SELECT sample_no FROM t2v_samples WHERE caption IS NOT NULL AND ({_KIND} = 'image' OR ({_KIND} = 'video' AND duration_sec IS NOT NULL AND fps IS NOT NULL))",
    "manifest_valid": f"SELECT sample_no FROM {_C} WHERE ({_FAIL}) IS NULL",
    "manifest_filter_counts": f"SELECT coalesce({_FAIL}, 'after') AS stage, count(*) AS n FROM {_C} GROUP BY 1 UNION ALL SELECT 'before', count(*) FROM t2v_samples",
    "manifest_first_failure": f"SELECT sample_no, {_FAIL} AS failure FROM {_C}",
    "frames_short_drop": f"SELECT sample_no, true AS keep_none, {_COUNT} >= {NUM_FRAMES} AS keep_all FROM {_C}",
    "frame_histogram": "SELECT num_frames, count(*) AS n FROM t2v_samples GROUP BY 1",
    "frames_resample": f"SELECT sample_no, CASE WHEN n = 1 THEN [0] ELSE list_transform(range(least({_COUNT}, {NUM_FRAMES})), lambda i: CAST(floor(i * (rate / {TRAIN_FPS})) AS BIGINT)) END AS indices FROM {_C}",
    "frames_uniform": f"SELECT sample_no, CASE WHEN n <= 8 THEN range(n) ELSE list_transform(range(8), lambda i: CAST(floor(i * ((n - 1) / 7)) AS BIGINT)) END AS indices FROM {_C} WHERE n > 0",
    "frames_segments": f"""SELECT sample_no, CAST(f + CASE WHEN tail THEN 1 ELSE 0 END AS INTEGER) AS n_segments, CASE WHEN tail THEN n - 8 * f WHEN f > 0 THEN 16 ELSE 0 END AS last_length FROM (
      SELECT *, n - 8 * f > 2.4 AND n > CASE WHEN f > 0 THEN (f - 1) * 8 + 16 ELSE 0 END AS tail FROM (SELECT *, CASE WHEN n >= 16 THEN (n - 16) // 8 + 1 ELSE 0 END AS f FROM {_C} WHERE n >= 0))""",
    "frames_random_crop": f"SELECT sample_no, n FROM {_C} WHERE n > 0",
    "sample_records": "SELECT coalesce(id, '') AS id, coalesce(file_name, '') AS file_name, coalesce(caption, '') AS caption, '' AS media_type, coalesce(width, 0) AS width, coalesce(height, 0) AS height, coalesce(num_frames, 0) AS num_frames, coalesce(len(vae_latent_shape), 0) AS n_axes, coalesce(octet_length(vae_latent_bytes), 0) AS n_bytes FROM t2v_samples",
    "sample_names": f"""SELECT sample_no, string_split(regexp_extract(file_name, '[^/]*$'), '.')[1] AS stem, {_KIND} AS kind, CASE WHEN isfinite(fps) AND fps > 0 THEN num_frames / fps ELSE 0.0 END AS seconds, vae_latent_shape[2] AS latent_frames,
      CASE WHEN len(vae_latent_shape) >= 2 THEN vae_latent_shape[-1] END AS latent_width, CASE WHEN len(vae_latent_shape) >= 2 THEN vae_latent_shape[-2] END AS latent_height FROM t2v_samples""",
    "aspect_filter": "SELECT sample_no FROM t2v_samples WHERE height > 0 AND abs(width / height - 16 / 9) <= 16 / 9 * 0.1",
    "nonzero_pixels": "SELECT vec_id FROM embeddings WHERE vec_id % 3 <> 0",
    "compact_json": """SELECT row_id, '{' || concat_ws(',', '"num_inference_steps":' || num_inference_steps, '"height":' || height, '"num_frames":' || num_frames) || '}' AS doc FROM prompt_splits""",
    "caption_given": r"SELECT caption_id FROM dataset_captions WHERE regexp_matches(CASE WHEN caption_id % 2 = 0 THEN caption ELSE regexp_replace(caption, '[\x00-\x1f\x7f\"\\]', ' ', 'g') END, '[^\s\p{Z}]')",
    "media_paths": "SELECT row_id, CASE WHEN trim(video_path) <> '' THEN CASE WHEN starts_with(video_path, '/') THEN video_path ELSE '/data/set/' || video_path END END AS path FROM prompt_splits",
    "annotated": "SELECT id, 'sample' AS role, CAST(row_number() OVER (ORDER BY id) - 1 AS DOUBLE) AS weight FROM datasets",
    "crop_geometry": """SELECT sample_no, crop_w, crop_h, (width - crop_w) // 2 AS crop_x, (height - crop_h) // 2 AS crop_y FROM (SELECT sample_no, width, height,
      CASE WHEN height * 832 < width * 480 THEN CAST(floor(height * 832 / 480) AS BIGINT) ELSE width END AS crop_w, CASE WHEN height * 832 < width * 480 THEN height ELSE CAST(floor(width * 480 / 832) AS BIGINT) END AS crop_h
      FROM t2v_samples WHERE width > 0 AND height > 0 AND width < 100000 AND height < 100000)""",
    "pixel_scaling": "SELECT l_orderkey, l_linenumber, l_quantity / 127.5 - 1 AS sym, l_quantity / 255 AS unit FROM lineitem",
    "prompt_file_names": r"""SELECT row_id, CASE WHEN s = '' THEN 'output' ELSE s END || '-' || row_id AS name FROM (SELECT row_id, regexp_replace(regexp_replace(regexp_replace(substr(coalesce(caption, ''), 1, 100), '[\\/:*?"<>|]', '', 'g'), '\s+', ' ', 'g'), '^[ .]+|[ .]+$', '', 'g') AS s FROM prompt_splits)""",
    "trailing_numbers": "SELECT sample_no, coalesce(TRY_CAST(regexp_extract(string_split(regexp_extract(file_name, '[^/]*$'), '.')[1], '([0-9]+)$', 1) AS BIGINT), -1) AS number FROM t2v_samples",
    "chunks_fixed_rows": """SELECT chunk, count(*) AS n, min(l_orderkey) AS first_key FROM (SELECT l_orderkey, (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 1000 AS chunk, count(*) OVER () // 1000 AS full_ FROM lineitem) WHERE chunk < full_ GROUP BY chunk""",
    "mix_repeat_roots": "SELECT n_regionkey AS root, n_name AS path, copy FROM nation JOIN region ON r_regionkey = n_regionkey, unnest(range(1, 5)) AS u(copy) WHERE copy <= r_regionkey - 1",
    "shard_contiguous": f"SELECT doc_id, idx // CAST(ceil(n / 7) AS BIGINT) AS shard FROM {_IDX}",
    "shard_cyclic_pad": f"SELECT doc_id, i AS idx, i // CAST(ceil(n / 7) AS BIGINT) AS \"group\" FROM (SELECT doc_id, idx + k * n AS i, n FROM {_IDX}, unnest(range(2)) AS u(k)) WHERE i < CAST(ceil(n / 7) AS BIGINT) * 7",
    "shard_strided_batches": f"SELECT doc_id, idx - 1 AS idx, (idx - 1) % 3 AS \"group\", (idx - 1) // 3 // 8 AS batch FROM {_IDX} WHERE idx > 0 AND idx - 1 < (n - 1) // 24 * 24",
    "shard_wrapped_batches": f"SELECT doc_id, i AS idx, i % 9 AS \"group\", i // 9 // 64 AS batch FROM (SELECT doc_id, idx + k * n AS i, n FROM {_IDX}, unnest(range(10)) AS u(k)) WHERE i < CAST(ceil(n / 576) AS BIGINT) * 576",
    "shard_permutation": "SELECT count(*) AS n, count(*) AS n_idx, count(*) - 1 AS last FROM documents",
    "validation_shard": f"SELECT doc_id, i AS idx, i % 9 AS \"group\", i < n AS real FROM (SELECT doc_id, idx + k * n AS i, n FROM {_IDX}, unnest(range(2)) AS u(k)) WHERE i < CAST(ceil(n / 9) AS BIGINT) * 9",
    "repeat_sampler": "SELECT rank, 6 AS n FROM unnest(range(4)) AS u(rank)",
    "global_row_lookup": """WITH f AS (SELECT l_orderkey, count(*) AS len FROM lineitem GROUP BY 1), s AS (SELECT *, sum(len) OVER (ORDER BY l_orderkey) AS e FROM f)
      SELECT o_orderkey * 5 AS index, l_orderkey, o_orderkey * 5 - (e - len) AS row_in_file FROM orders JOIN s ON o_orderkey * 5 >= e - len AND o_orderkey * 5 < e""",
    "ragged_batches": "SELECT load_id, count(DISTINCT vae_latent_shape) AS n_shapes FROM t2v_samples GROUP BY 1 HAVING count(DISTINCT vae_latent_shape) > 1",
    "pad_sequences": """SELECT preset_no, list_concat(v[1:5], list_transform(range(5 - least(len(v), 5)), lambda i: 0)) AS "values", list_concat(list_transform(range(least(len(v), 5)), lambda i: 1), list_transform(range(5 - least(len(v), 5)), lambda i: 0)) AS mask, v[1:5] AS back
      FROM (SELECT preset_no, list_transform(coalesce(segment_prompts, []), lambda s: length(s)) AS v FROM story_presets)""",
    "pad_to_longest": """SELECT preset_no, list_concat(v, list_transform(range(m - len(v)), lambda i: 0)) AS padded, len(v) AS n_real FROM (SELECT *, max(len(v)) OVER (PARTITION BY preset_no % 10) AS m FROM
      (SELECT preset_no, list_transform(segment_prompts, lambda s: length(s)) AS v FROM story_presets WHERE segment_prompts IS NOT NULL))""",
    "cfg_dropout": "SELECT row_id, false AS never, true AS always FROM prompt_splits",
    "tensor_stats": """SELECT vec_id, list_avg(list_transform(v, lambda x: abs(x))) AS abs_mean, list_sum(v) AS sum, list_min(v) AS min, list_max(v) AS max, list_avg(v) AS mean, list_stddev_samp(v) AS std, len(v) AS size
      FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)""",
    "zip_positional": """SELECT a.id, b.name_part, pos FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos FROM datasets) a JOIN (SELECT name_part, row_number() OVER (ORDER BY name_part) - 1 AS pos FROM name_parts) b USING (pos)""",
    "leftover_refs": """SELECT pos, id, item_id, CASE WHEN id IS NULL THEN 'reference' ELSE 'sample' END AS role FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos FROM datasets)
      FULL JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS pos FROM eval_items) USING (pos)""",
    "unknown_refs": "SELECT caption_id FROM dataset_captions c WHERE file_name IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t2v_samples t WHERE t.file_name = c.file_name)",
    "take_pairing": "SELECT l_orderkey, arg_max(l_partkey, (l_suppkey, l_partkey)) FILTER (WHERE l_linenumber = 1) AS take_1, arg_max(l_partkey, (l_suppkey, l_partkey)) FILTER (WHERE l_linenumber = 2) AS take_2 FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_linenumber = 1) > 0 AND count(*) FILTER (WHERE l_linenumber = 2) > 0",
    "unpaired_takes": "SELECT l_orderkey FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1 HAVING count(DISTINCT l_linenumber) < 2",
    "present_in_all": "SELECT dataset_id FROM t2v_samples WHERE load_id <= 2 INTERSECT SELECT dataset_id FROM t2v_samples WHERE load_id > 2 INTERSECT SELECT id FROM datasets",
    "renamed_keys": "SELECT sample_no, CASE WHEN starts_with(chunk_path, 'latents/') THEN 'conditions/' || substr(chunk_path, 9) ELSE chunk_path END AS key FROM t2v_samples",
    "caption_upsert": """SELECT dataset_id, file_name, arg_max_null(caption, (caption_id % 3 <> 0, caption_id)) AS caption, arg_max(caption_id, (caption_id % 3 <> 0, caption_id)) AS caption_id FROM dataset_captions
      WHERE dataset_id IS NOT NULL AND file_name IS NOT NULL GROUP BY 1, 2""",
    "caption_patch": "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'x' ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 = 0 THEN upper(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer",
    "catalog_delete": "SELECT id, name FROM datasets WHERE id NOT IN (SELECT dataset_id FROM t2v_samples WHERE dataset_id IS NOT NULL AND load_id = 1)",
    "page_cursor": "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE (o_orderdate, o_orderkey) > (SELECT (o_orderdate, o_orderkey) FROM orders WHERE o_orderkey = 77) ORDER BY o_orderdate, o_orderkey LIMIT 100",
    "newest_first": "SELECT id, created_at FROM datasets WHERE created_at > 1.73e9",
    "merged_lists": "SELECT 'caption' AS kind, caption_id AS key, uploaded_at AS at FROM dataset_captions UNION ALL SELECT 'prompt', row_id, added_at FROM prompt_splits",
    "captions_of_files": "SELECT sample_no, caption_id FROM t2v_samples LEFT JOIN dataset_captions USING (dataset_id, file_name)",
    "replica_choice": "SELECT s_nationkey, coalesce(min(s_suppkey) FILTER (WHERE s_acctbal > 5000 AND s_suppkey % 3 = 0), min(s_suppkey) FILTER (WHERE s_acctbal > 5000)) AS chosen FROM supplier GROUP BY 1",
    "dims_explode_group": "SELECT dimension, count(*) AS n FROM (SELECT unnest(string_split(label, ' ')) AS dimension FROM story_presets) GROUP BY 1",
}
_ALL = "(SELECT *, CASE WHEN isfinite(fps) THEN fps END AS rate, num_frames AS n FROM t2v_samples)"
ORACLES |= {f"{k}_all": ORACLES[k].replace(_C, _ALL) for k in (
    "manifest_valid", "manifest_filter_counts", "manifest_first_failure", "frames_short_drop", "frames_resample", "frames_uniform", "frames_segments", "frames_random_crop",
)}
ORACLES["crop_geometry_all"] = ORACLES["crop_geometry"].replace(" AND width < 100000 AND height < 100000", "")
