"""Queries of the training-text operators and, where SQL can say the same, their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameloom.llm import captions, leakage, overlap, private, repetition, tokenizer
from frameloom.plans.tables import table


def _captions(spark: SparkSession, d: str) -> dict[str, tuple[DataFrame, str, str]]:
    return {
        "dataset_captions": (table(spark, d, "dataset_captions"), "caption_id", "caption"),
        "t2v_samples": (table(spark, d, "t2v_samples"), "sample_no", "caption"),
    }


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return captions.found(spark, _captions(spark, d))


def p1_collapsed_all(spark: SparkSession, d: str) -> DataFrame:
    """One record per caption of both tables; p1_collapsed has dataset_captions alone."""
    return captions.collapsed_tables(spark, _captions(spark, d)).select("table_name", "keep_key", "n_copies")


def p1_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return captions.collapsed(spark, table(spark, d, "dataset_captions"), "caption_id", "caption").select("caption_id", "n_copies")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.found(spark, table(spark, d, "prompt_splits"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.report(spark, table(spark, d, "prompt_splits"))


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    return overlap.coverage(table(spark, d, "prompt_splits"))


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    caps = table(spark, d, "dataset_captions").select(F.lit("dataset_captions").alias("table_name"), F.col("caption_id").alias("row_key"), F.col("caption").alias("text"))
    presets = table(spark, d, "story_presets").select(F.lit("story_presets").alias("table_name"), F.col("preset_no").alias("row_key"), F.array_join("segment_prompts", " ").alias("text"))
    return repetition.ledger(caps.unionByName(presets))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.cases(_ledger(spark, d), repetition.POLICIES[0]).select("table_name", "row_key")


def p5_shares(spark: SparkSession, d: str) -> DataFrame:
    return _ledger(spark, d)


def p5_ablation(spark: SparkSession, d: str) -> DataFrame:
    return repetition.ablation(_ledger(spark, d))


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode(spark, table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(spark, table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p7_near(spark: SparkSession, d: str) -> DataFrame:
    """Windows of twelve words within three bits of an item's that are at least 0.8 like it, and windows as long as an item whose words are so like all of its: leaks with words changed."""
    docs, items = table(spark, d, "documents"), table(spark, d, "eval_items")
    both = leakage.leaks(spark, docs, items, radius=3, least=0.8).unionByName(leakage.near_items(spark, docs, items, least=0.8))
    return both.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return private.find(spark, table(spark, d, "documents"), table(spark, d, "name_parts"))


def p8_redacted(spark: SparkSession, d: str) -> DataFrame:
    return private.redacted(spark, table(spark, d, "documents"), table(spark, d, "name_parts"))


QUERIES = {
    "p1_found": p1_found, "p1_collapsed": p1_collapsed, "p1_collapsed_all": p1_collapsed_all,
    "p4_found": p4_found, "p4_report": p4_report, "p4_coverage": p4_coverage,
    "p5_found": p5_found, "p5_shares": p5_shares, "p5_ablation": p5_ablation,
    "p6_ids": p6_ids,
    "p7_found": p7_found, "p7_near": p7_near,
    "p8_found": p8_found, "p8_redacted": p8_redacted,
}

_L = "subject|action|setting|camera|lighting|style"


def _keyed(table_name: str, key: str) -> str:
    """k, class of each caption: the sequence of its letters and digits, or its sorted fields."""
    seq = "regexp_replace(lower(upper({})), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
    flat = "regexp_replace(regexp_replace(regexp_replace(lower(caption), '[^\\p{L}\\p{N};|\\r\\n:=]+', ' ', 'g'), ' ?[;|\\r\\n][ ;|\\r\\n]*', ';', 'g'), '^[ ;]+|[ ;]+$', '', 'g')"
    return f"""SELECT '{table_name}' AS table_name, {key} AS k,
      CASE WHEN json_valid(caption) AND json_type(CASE WHEN json_valid(caption) THEN caption END) = 'OBJECT' THEN
        list_sort(list_transform(json_keys(CASE WHEN json_valid(caption) THEN caption END), lambda x: lower(x) || {seq.format("json_extract_string(caption, '$.' || x)")}))
      WHEN regexp_matches({flat}, '^({_L}) ?[:=]') THEN
        list_sort(list_filter(list_transform(regexp_split_to_array(regexp_replace({flat}, '(^|;)({_L}) ?[:=]', '\\1@\\2:', 'g'), ';?@'), lambda x: {seq.format("x")}), lambda x: x <> ''))
      ELSE [{seq.format("caption")}] END AS c
      FROM {table_name} WHERE {seq.format("caption")} <> ''"""


ORACLES = {
    "p1_found": f"""SELECT table_name, keep_key, k AS copy_key FROM (
      SELECT table_name, k, min(k) OVER (PARTITION BY table_name, c) AS keep_key FROM ({_keyed('dataset_captions', 'caption_id')} UNION ALL {_keyed('t2v_samples', 'sample_no')}))
      WHERE k <> keep_key""",
    "p7_found": """WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(upper(text)), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
      i AS (SELECT item_id, list_filter(string_split(regexp_replace(lower(upper(text)), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM eval_items WHERE text IS NOT NULL),
      dw AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS k FROM d WHERE len(w) >= 12)),
      iw AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM i WHERE len(w) >= 12))
      SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (g)""",
    "p1_collapsed": f"SELECT min(k) AS caption_id, count(*) AS n_copies FROM ({_keyed('dataset_captions', 'caption_id')}) GROUP BY c",
    "p1_collapsed_all": f"""SELECT table_name, min(k) AS keep_key, count(*) AS n_copies FROM ({_keyed('dataset_captions', 'caption_id')} UNION ALL {_keyed('t2v_samples', 'sample_no')})
      GROUP BY table_name, c""",
}
