"""Readers: directories of tables, manifests, prompt files, event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from frameloom.operators.runs import parse_records
from frameloom.schemas import sample_schema
from frameloom.session import hadoop_path


class SourceError(ValueError):
    """A source that is absent, empty or of an unknown form."""


def parquet_files(spark: SparkSession, root: str) -> DataFrame:
    """path, bytes, n_rows of every Parquet file under ``root``, in order of paths; none is an error.

    Row counts come from the files' footers: the scan reads no column.
    """
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").format("binaryFile").load(root).select("path", F.col("length").alias("bytes"))
    if df.isEmpty():
        raise SourceError(f"no Parquet file under {root}")
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n_rows"))
    clean = F.regexp_replace("path", "^file:/+", "/")
    return df.withColumn("path", clean).join(rows.withColumn("path", clean), "path", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0))).orderBy("path")


def samples(spark: SparkSession, root: str, kind: str = "t2v") -> DataFrame:
    """Sample tables by their fixed schema; the scan prunes columns and pushes filters."""
    return spark.read.schema(sample_schema(kind)).option("recursiveFileLookup", True).parquet(root)


def manifest(spark: SparkSession, folder: str, annotation: str, lines: bool = False) -> DataFrame:
    """A JSON manifest with path and action_path made whole by the folder; cap is a list, whether written as text or list."""
    schema = "path string, resolution struct<width:bigint,height:bigint>, size bigint, fps double, duration double, num_frames bigint, cap string, action_path string"
    df = spark.read.schema(schema).option("multiLine", not lines).json(annotation)
    whole = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("/", F.lit(folder.rstrip("/")), F.col(c)))
    cap = F.when(F.col("cap").startswith("["), F.from_json("cap", "array<string>")).when(F.col("cap").isNotNull(), F.array("cap"))
    return df.withColumns({"path": whole("path"), "action_path": whole("action_path"), "cap": cap})


def manifest_of_manifests(spark: SparkSession, path: str) -> tuple[str, str]:
    """The one pair 'folder,annotation' of a list; more or fewer is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "").take(2)
    parts = [p.strip() for p in lines[0][0].split(",")] if len(lines) == 1 else []
    if len(parts) != 2:
        raise SourceError("exactly one pair of folder and annotation is allowed")
    return parts[0], parts[1]


def merged_captions(spark: SparkSession, folder: str, name: str = "videos2caption.json") -> DataFrame:
    """A captions file beside its videos: cap becomes caption, path becomes name, video is the file's path."""
    df = manifest(spark, "", f"{folder.rstrip('/')}/{name}")
    df = df.withColumnsRenamed({"cap": "caption", "path": "name"}).withColumn("name", F.ltrim(F.regexp_replace("name", "^/", "")))
    return df.withColumn("video", F.concat_ws("/", F.lit(folder.rstrip("/") + "/videos"), F.col("name")))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """idx, id, text of the lines that aren't blank, stripped, numbered in file order.

    The whole file is one row that is exploded with positions: prompt lists are
    single files, and line order matters.
    """
    df = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    df = df.select("line", F.regexp_replace("text", r"^\s+|\s+$", "").alias("text")).where("text <> ''")
    from frameloom.operators.shards import positions

    return positions(df, ["line"]).select("idx", F.concat(F.lit("text_"), F.col("idx").cast("string")).alias("id"), "text")


def by_suffix(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a .csv, .json (its field ``data``), .parquet or .arrow file; another suffix is an error."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if suffix == "json":
        raw = spark.read.option("multiLine", True).json(path)
        return raw.select(F.explode("data").alias("d")).select("d.*") if "data" in raw.columns else raw
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "arrow":
        import pyarrow as pa

        with pa.memory_map(path.removeprefix("file://")) as f:
            try:
                t = pa.ipc.open_file(f).read_all()
            except pa.ArrowInvalid:
                f.seek(0)
                t = pa.ipc.open_stream(f).read_all()
            return spark.createDataFrame(t.to_pandas())
    raise SourceError(f"no reader for .{suffix}")


def annotated_tensors(spark: SparkSession, annotation: str, tensors: str) -> DataFrame:
    """Annotation rows with the bytes of the file each names; a missing length counts as 1, a missing file as null bytes."""
    a = spark.read.option("multiLine", True).json(annotation)
    if "length" not in a.columns:
        a = a.withColumn("length", F.lit(1).cast("bigint"))
    f = spark.read.format("binaryFile").load(tensors).select(F.substring_index("path", "/", -1).alias("file"), "content")
    return a.withColumn("length", F.coalesce("length", F.lit(1))).join(f, "file", "left")


def parallel_directories(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """key, and per source its path, of the files that every source has; latent_X and condition_X are one key."""
    out = None
    for name, root in roots.items():
        key = F.regexp_replace(F.substring_index("path", "/", -1), "^(latent|condition)_", "")
        one = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(key.alias("key"), F.col("path").alias(name))
        out = one if out is None else out.join(one, "key")
    return out


def run_records(spark: SparkSession, root: str) -> DataFrame:
    """Run records of all JSON files under ``root``: undecodable ones left out, ordered by time (none first) and path."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root)
    return parse_records(raw.select("value", F.col("_metadata.file_path").alias("path")), keep=["path"]).orderBy(F.asc_nulls_first("ts"), "path")


def current_results(spark: SparkSession, folder: str) -> DataFrame:
    """path, value of the perf_*.json files of a folder, in order."""
    return spark.read.option("wholetext", True).option("pathGlobFilter", "perf_*.json").text(folder).select(F.col("_metadata.file_path").alias("path"), "value").orderBy("path")


def takes(rows: DataFrame, name: str = "scenario") -> DataFrame:
    """Parts of file names 'id_view_take-n_subject...': adds view, take, subject; another form leaves nulls."""
    m = lambda k: F.nullif(F.regexp_extract(name, r"^\w+?_(?:perspective-)?([a-z]+)_take-([12])_(?:trimmed-)?([\w-]+?)(?:\.\w+)?$", k), F.lit(""))
    return rows.withColumns({"view": m(1), "take": m(2).cast("int"), "subject": m(3)})


def corpus(spark: SparkSession, path: str, dimensions: Sequence[str] | None = None) -> DataFrame:
    """prompt, dimensions, info of a benchmark list, only of the wanted dimensions; of nested info one level is flattened, the later key winning."""
    raw = spark.read.schema("prompt_en string, dimension array<string>, auxiliary_info string").option("multiLine", True).json(path)
    info = F.from_json("auxiliary_info", "map<string,map<string,string>>")
    flat = F.aggregate(F.map_values(info), F.create_map().cast("map<string,string>"), lambda a, m: F.map_concat(F.map_filter(a, lambda k, v: ~F.map_contains_key(m, k)), m))
    df = raw.select(F.col("prompt_en").alias("prompt"), F.col("dimension").alias("dimensions"), F.coalesce(flat, F.create_map().cast("map<string,string>")).alias("info"))
    return df if dimensions is None else df.where(F.arrays_overlap("dimensions", F.array(*map(F.lit, dimensions))))


def expand_paths(spark: SparkSession, given: Sequence[str], extensions: Sequence[str]) -> list[str]:
    """Paths of files, folders (their files of the extensions, sorted) and globs, each once, in order of first mention."""
    out: dict[str, None] = {}
    for g in given:
        fs, p = hadoop_path(spark, g)
        for s in sorted(fs.globStatus(p) or [], key=lambda s: s.getPath().toString()):
            if s.isDirectory():
                for x in sorted(str(f.getPath().toString()) for f in fs.listStatus(s.getPath()) if not f.isDirectory()):
                    if x.rsplit(".", 1)[-1].lower() in extensions:
                        out[x] = None
            else:
                out[s.getPath().toString()] = None
    return [x.removeprefix("file:") for x in out]


def prompts(spark: SparkSession, path: str) -> DataFrame:
    """idx, prompt of a .jsonl or .json list whose items are strings or objects with prompt or text_prompt."""
    if path.endswith(".jsonl"):
        items = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.split("value", r"\r?\n")).alias("at", "item")).where("trim(item) <> ''")
    else:
        items = spark.read.option("wholetext", True).text(path).select(F.posexplode(F.from_json("value", "array<string>")).alias("at", "item"))
    obj = lambda k: F.when(F.col("item").startswith("{"), F.get_json_object("item", f"$.{k}"))
    bare = F.when(F.col("item").startswith('"'), F.get_json_object(F.concat(F.lit('{"x":'), "item", F.lit("}")), "$.x")).when(~F.col("item").startswith("{"), F.col("item"))
    from frameloom.operators.shards import positions

    return positions(items, ["at"]).select("idx", F.coalesce(obj("prompt"), obj("text_prompt"), bare).alias("prompt"))


def caption_import(rows: DataFrame, known: DataFrame, key: str = "file_name") -> DataFrame:
    """Captions of known files; a caption for an unknown file is refused."""
    from frameloom.operators.joins import unknown_references

    bad = unknown_references(rows, known, [key]).limit(3).collect()
    if bad:
        raise SourceError(f"captions of unknown files: {', '.join(str(r[key]) for r in bad)}")
    return rows


def captions_json(spark: SparkSession, path: str) -> DataFrame:
    """file_name, caption of a JSON list of objects or of a JSON object from file to caption."""
    raw = spark.read.option("wholetext", True).text(path)
    as_list = F.from_json("value", "array<struct<file_name:string,caption:string>>")
    as_map = F.transform(F.map_entries(F.from_json("value", "map<string,string>")), lambda e: F.struct(e["key"].alias("file_name"), e["value"].alias("caption")))
    return raw.select(F.explode(F.when(F.ltrim("value").startswith("["), as_list).otherwise(as_map)).alias("x")).select("x.*")


def requests(rows: DataFrame, n: int) -> DataFrame:
    """Exactly ``n`` rows of (idx, ...): the list repeated in order and cut. The list's length is counted once."""
    size = rows.count()
    if not size:
        raise SourceError("no prompt")
    laps = F.sequence(F.lit(0), F.lit(-(-n // size) - 1))
    return rows.withColumn("_l", F.explode(laps)).withColumn("idx", F.col("idx") + F.col("_l") * size).where(F.col("idx") < n).drop("_l")


EVENT = T.StructType([T.StructField("session_id", T.StringType()), T.StructField("event", T.StringType()), T.StructField("ts", T.DoubleType()), T.StructField("payload", T.MapType(T.StringType(), T.StringType()))])


def events(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """Session events from JSON lines, with their time as a timestamp; as a stream or as a table."""
    df = (spark.readStream if streaming else spark.read).schema(EVENT).json(folder)
    return df.withColumn("at", F.timestamp_micros((F.col("ts") * 1_000_000).cast("bigint")))


def clip_facts(frames: Column, fps: Column) -> Column:
    """Seconds of a clip whose frames were counted: 0 without a rate."""
    return F.when(fps > 0, frames / fps).otherwise(0.0)


def listed(rows: DataFrame, where: Column, newest: str) -> DataFrame:
    """Rows of a store's table, filtered, newest first."""
    return rows.where(where).orderBy(F.col(newest).desc())
