"""Validation, records and derived columns of media samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameloom.schemas import DEFAULTS

#: Media kinds by extension.
EXTENSIONS = {"mp4": "video", "jpg": "image"}


def extension(path: Column) -> Column:
    return F.lower(F.substring_index(F.substring_index(path, "/", -1), ".", -1))


def media_kind(path: Column) -> Column:
    out = F.lit(None).cast("string")
    for e, k in EXTENSIONS.items():
        out = F.when(extension(path) == e, k).otherwise(out)
    return out


def sample_id(path: Column) -> Column:
    """The base name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def basic_valid(caption: Column, path: Column, duration: Column, fps: Column) -> Column:
    """A caption, and for a video duration and fps; other kinds of files are rejected."""
    k = media_kind(path)
    return F.coalesce(caption.isNotNull() & ((k == "image") | ((k == "video") & duration.isNotNull() & fps.isNotNull())), F.lit(False))


def workflow_valid(caption: Column, fps: Column, frames: Column) -> Column:
    return F.coalesce((caption != "") & (fps > 0) & (frames > 0), F.lit(False))


def has_resolution(width: Column, height: Column) -> Column:
    return width.isNotNull() & height.isNotNull()


def duration_fits(frames: Column, fps: Column, num_frames: int, train_fps: float, speed: float = 1.0, tolerance: float = 2.0) -> Column:
    """False only if the clip lasts longer than the tolerance times what training uses."""
    return ~F.coalesce(F.when(fps > 0, frames / fps > tolerance * (num_frames / train_fps * speed)), F.lit(False))


def resampled_frames(frames: Column, fps: Column, train_fps: float, speed: float = 1.0) -> Column:
    return F.when((fps > 0) & (frames > 0), F.ceil(frames / (fps / train_fps * speed))).otherwise(0).cast("bigint")


def keeps_short(frames: Column, fps: Column, num_frames: int, train_fps: float, drop_ratio: float, seed: int, key: Column, speed: float = 1.0) -> Column:
    """Whether a clip that is too short after resampling stays; a seeded hash of the key decides, so a re-run decides alike."""
    short = resampled_frames(frames, fps, train_fps, speed) < num_frames
    draw = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / (1 << 30)
    return ~(short & (draw < drop_ratio))


def first_failure(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule, in order, that the row fails; null if it passes them all. A null verdict is a failure."""
    out = None
    for name, ok in rules:
        out = (F if out is None else out).when(~F.coalesce(ok, F.lit(False)), F.lit(name))
    return F.lit(None).cast("string") if out is None else out


def filter_counts(rows: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """stage, n: rows before, per rule those that fail it first, and rows after."""
    counts = rows.groupBy(first_failure(rules).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.explode(F.array(F.struct(F.lit("before").alias("stage"), F.col("n")), F.struct(F.coalesce("f", F.lit("after")).alias("stage"), F.col("n")))).alias("x")).groupBy("x.stage").agg(F.sum("x.n").alias("n"))


def frame_histogram(rows: DataFrame, frames: str) -> DataFrame:
    return rows.groupBy(frames).agg(F.count(F.lit(1)).alias("n"))


def any_nonzero(values: Column) -> Column:
    """False for a sample whose pixels are all zero; nulls don't count."""
    return F.exists(values, lambda x: F.coalesce(x != 0, F.lit(False)))


def wide_enough(width: Column, height: Column, ratio: float = 16 / 9, tolerance: float = 0.1) -> Column:
    return F.when(height > 0, F.abs(width / height - ratio) <= ratio * tolerance).otherwise(False)


def without_nulls(columns: Sequence[str]) -> Column:
    """A JSON object of the columns that aren't null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})


def caption_given(raw: Column) -> Column:
    """Whether JSON text is a non-empty string or a list whose first element is one."""
    first = F.when(raw.rlike(r'^\s*\[\s*"'), F.get(F.from_json(raw, "array<string>"), 0))
    return F.coalesce(F.when(raw.startswith("["), first.rlike(r"[^\s\p{Z}]")).when(raw.startswith('"'), F.get_json_object(F.concat(F.lit('{"x":'), raw, F.lit("}")), "$.x").rlike(r"[^\s\p{Z}]")), F.lit(False))


def build_records(rows: DataFrame, schema: T.StructType, strict: bool = False) -> DataFrame:
    """Rows in the schema's columns and types: missing ones and nulls get the default of their type.

    strict refuses a frame that lacks a column of the schema.
    """
    have = set(rows.columns)
    missing = [f.name for f in schema if f.name not in have]
    if strict and missing:
        raise ValueError(f"unfilled fields: {', '.join(missing)}")
    cols = []
    for f in schema:
        d = DEFAULTS[f.dataType.simpleString()]
        lit = F.array().cast(f.dataType) if d == [] else F.lit(d).cast(f.dataType)
        cols.append((F.coalesce(F.col(f.name).cast(f.dataType), lit) if f.name in have else lit).alias(f.name))
    return rows.select(*cols)


def derived(frames: Column, fps: Column) -> Column:
    """Seconds of a clip: frames over fps, 0 without fps."""
    return F.when(fps > 0, frames / fps).otherwise(0.0)


def latent_frames(shape: Column) -> Column:
    """Frames of a latent: axis 1 of its shape."""
    return F.get(shape, 1)


def pixel_size(shape: Column, legacy: bool = False) -> list[Column]:
    """width, height of a latent in channels, frames, height, width order; ``legacy`` swaps them as an old writer did."""
    n = F.size(shape)
    h, w = F.when(n >= 2, F.element_at(shape, -2)), F.when(n >= 2, F.element_at(shape, -1))
    return [(h if legacy else w).alias("latent_width"), (w if legacy else h).alias("latent_height")]


def resolve_path(folder: str, path: Column) -> Column:
    """A path relative to the folder made whole; absolute ones stay, null and blank ones are null."""
    return F.when(F.trim(path) != "", F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), path)))


def annotate(rows: DataFrame, order: Sequence[str], **values: object) -> DataFrame:
    """Scalars go to every row; a list goes to the rows by position and must have their number."""
    from frameloom.operators.joins import zip_positions

    for name, v in values.items():
        if isinstance(v, (list, tuple)):
            side = rows.sparkSession.createDataFrame([(i, x) for i, x in enumerate(v)], f"_pos bigint, `{name}` {'string' if v and isinstance(v[0], str) else 'double'}")
            rows = zip_positions(rows, order, side, ["_pos"], strict=True).drop("_pos", "pos")
        else:
            rows = rows.withColumn(name, F.lit(v))
    return rows


def crop_geometry(width: Column, height: Column, target_w: int, target_h: int, top: bool = False) -> list[Column]:
    """crop_w, crop_h, crop_x, crop_y: the largest crop of the target's aspect, centred or at the top."""
    wide = height * target_w < width * target_h
    cw = F.when(wide, F.floor(height * target_w / target_h)).otherwise(width).cast("bigint")
    ch = F.when(wide, height).otherwise(F.floor(width * target_h / target_w)).cast("bigint")
    return [cw.alias("crop_w"), ch.alias("crop_h"), F.floor((width - cw) / 2).alias("crop_x"), (F.lit(0).cast("bigint") if top else F.floor((height - ch) / 2)).alias("crop_y")]


def scale_pixels(values: Column, symmetric: bool = True) -> Column:
    """0..255 to -1..1, or to 0..1."""
    return F.transform(values, (lambda x: x / 127.5 - 1) if symmetric else (lambda x: x / 255))


def file_stem(prompt: Column, index: Column | None = None) -> Column:
    """A file name of a prompt: its first 100 characters without those that paths forbid, white space collapsed; 'output' if nothing is left."""
    s = F.regexp_replace(F.substring(F.coalesce(prompt, F.lit("")), 1, 100), r'[\\/:*?"<>|]', "")
    s = F.regexp_replace(F.regexp_replace(s, r"\s+", " "), r"^[ .]+|[ .]+$", "")
    s = F.when(s == "", "output").otherwise(s)
    return s if index is None else F.concat(s, F.lit("-"), index.cast("string"))


def trailing_number(stem: Column) -> Column:
    return F.coalesce(F.try_element_at(F.regexp_extract_all(stem, F.lit(r"(\d+)$"), 1), F.lit(1)).try_cast("bigint"), F.lit(-1))
