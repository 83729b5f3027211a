"""Records of evaluation splits that stand, exactly or almost, in the training split.

Method: a suffix array over the words of all distinct captions, partitioned by
the hash of a suffix's first words, so that each interval of suffixes with a
common prefix of HEAD words lies in one partition. Two captions within k word
edits share a computable number of such prefixes; under one global order from
rare to frequent they agree on one of their rarest, so only the intervals of
each caption's rarest suffixes are paired across the splits, and no link is
lost. A common prefix is a shared span; pairs whose spans lie too far apart, or
whose word signatures differ in too many bits, can't be within the limit. What
is left is verified by the edit distance of whole captions.

A suffix array's neighbours alone would lose links: the rule allows an edit at
every fifth word, so the longest span that a pair surely shares is four words,
and the neighbour in such an interval is as a rule another caption. Therefore
all cross-split pairs of a rare interval are looked at, not adjacent ones only.

Copies are folded first: equal captions (as words) are one text with its
members, so a caption that fills a third of a split is one suffix set, and
pairs of texts are found between representatives, then expanded by two joins.

Defined results: null, blank and wordless captions, and paths without a clip
name of letters or digits, are in no pair. A split other than train counts as
evaluation only if it is validation or test; a null split is neither.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from frameloom.functions.text import letters, run_hashes, words
from frameloom.operators.copies import salted_join
from frameloom.session import cut

#: Words of the common prefix that defines an interval of the suffix array.
HEAD = 3
#: Edits allowed per word of the longer caption.
SHARE = 0.2
#: Frequencies are known of this many heads at most (16 bytes each), and of none that stands fewer times than the second number.
FREQUENT, LEAST_FREQUENT = 1_000_000, 32
#: One code point per word: 41,000 code points without surrogates, so distances can only shrink, never grow.
_FIRST, _CODES = 0x3400, 0xD7FF - 0x3400


def allowed(n: Column) -> Column:
    """Whole edits at ``n`` words of the longer caption."""
    return F.floor(n * SHARE + 1e-9).cast("int")


def _needed(n: Column) -> Column:
    """Least number of padded heads that a caption of ``n`` words shares with one within the limit, whatever that one's length."""
    longest = F.floor(n / (1 - SHARE) + 1e-9).cast("int")
    per = lambda m: m + (HEAD - 1) - allowed(m) * HEAD
    return F.greatest(F.lit(1), F.array_min(F.transform(F.sequence(n, longest), per)))


def _code(w: Column) -> Column:
    """The words as a string of one code point each."""
    point = lambda x: F.lpad(F.hex(F.lit(_FIRST) + F.pmod(F.xxhash64(x), F.lit(_CODES))), 4, "0")
    return F.decode(F.unhex(F.array_join(F.transform(w, point), "")), "UTF-16BE")


def _signature(places: Column) -> list[Column]:
    """256 bits in four words, each bit the parity of the words that hash to it: one edit turns two at most."""
    turn = lambda k: lambda acc, h: F.when(F.shiftright(h, 6) == k, acc.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), h.bitwiseAND(F.lit(63))))).otherwise(acc)
    return [F.aggregate(places, F.lit(0).cast("bigint"), turn(k)).alias(f"s{k}") for k in range(4)]


def _heads(t: DataFrame) -> DataFrame:
    """Adds heads: the hash of the first HEAD words of every suffix, the text padded at both ends."""
    pad = F.array(*[F.lit("")] * (HEAD - 1))
    return t.withColumn("p", F.concat(pad, F.split("joined", " "), pad)).withColumn("heads", run_hashes(F.col("p"), HEAD)).drop("p")


def frequent_heads(spark: SparkSession, t: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Sorted heads and their frequencies: at most ``most`` of them, the most frequent ones.

    They only decide the global order; any order is lossless, so the rest needs
    no frequency. Heads are counted on the map side first.
    """
    counts = _heads(t).select(F.explode("heads").alias("head")).groupBy("head").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= LEAST_FREQUENT)
    counts = cut(spark, counts, "frequent")
    sizes = {r["e"]: r["n"] for r in counts.groupBy(F.floor(F.log2("df")).alias("e")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = 1 << 62, 0
    for e in sorted(sizes, reverse=True):  # whole powers of two, as long as the bound holds
        held += sizes[e]
        if held > most:
            break
        least = 1 << e
    got = counts.where(F.col("df") >= least).orderBy("head").toPandas()
    return got["head"].to_numpy(np.int64), got["df"].to_numpy(np.int64)


def rare_suffixes(spark: SparkSession, t: DataFrame, known: Broadcast, name: str) -> DataFrame:
    """The suffixes of each text that its partner must share one of: its rarest by (frequency, head); head and the text's columns."""
    carry = ["tid", "n", "s0", "s1", "s2", "s3"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, freq = known.value
        for b in batches:
            lists = b.column(0)
            head = lists.flatten().to_numpy(zero_copy_only=False)
            size = np.diff(lists.offsets.to_numpy())
            row = np.repeat(np.arange(len(size)), size)
            start = np.cumsum(size) - size
            df = np.zeros(len(head), np.int64)
            if len(hot) and len(head):
                at = np.minimum(np.searchsorted(hot, head), len(hot) - 1)
                df = np.where(hot[at] == head, freq[at], 0)
            order = np.lexsort((head, df, row))  # stable: equal heads stay in order of position
            keep = order[np.arange(len(order)) - start[row[order]] < b.column(1).to_numpy()[row[order]]] if len(order) else order
            take = pa.array(row[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(head[keep], pa.int64()), pa.array((keep - start[row[keep]]).astype(np.int32), pa.int32()), *[b.column(2 + i).take(take) for i in range(len(carry))]],
                names=["head", "pos", *carry],
            )

    wanted = (F.col("n") + HEAD - 1 - _needed(F.col("n")) + 1).cast("bigint")
    out = _heads(t).select("heads", wanted.alias("wanted"), *carry).mapInArrow(pick, "head bigint, pos int, tid bigint, n int, s0 bigint, s1 bigint, s2 bigint, s3 bigint")
    return out.select("head", *[F.col(c).alias(f"{name}_{c}") for c in ("pos", *carry)])


def near_texts(spark: SparkSession, t: DataFrame) -> DataFrame:
    """(t_tid, e_tid) of a train and an evaluation text, not equal, within the edit limit."""
    places = F.transform(F.split("joined", " "), lambda x: F.pmod(F.xxhash64(F.lit("bits"), x), F.lit(256)).cast("int"))
    base = t.select("tid", "joined", "n", "train", "evaluation", places.alias("places"))
    sig = cut(spark, base.select("tid", "joined", "n", "train", "evaluation", *_signature(F.col("places"))), "texts")
    known = spark.sparkContext.broadcast(frequent_heads(spark, sig))
    k = allowed(F.greatest("t_n", "e_n"))
    bits = sum((F.bit_count(F.col(f"t_s{i}").bitwiseXOR(F.col(f"e_s{i}"))) for i in range(1, 4)), F.bit_count(F.col("t_s0").bitwiseXOR(F.col("e_s0"))))
    pairs = (
        rare_suffixes(spark, sig.where("train"), known, "t").join(rare_suffixes(spark, sig.where("evaluation"), known, "e"), "head")
        .where((F.col("t_tid") != F.col("e_tid")) & (F.abs(F.col("t_n") - F.col("e_n")) <= k) & (F.abs(F.col("t_pos") - F.col("e_pos")) <= k) & (bits <= 2 * k))
        .select("t_tid", "e_tid").distinct()
    )
    full = lambda name: sig.select(*[F.col(c).alias(f"{name}_{c}") for c in ("tid", "n", "joined")])
    both = pairs.join(full("t"), "t_tid").join(full("e"), "e_tid").where(F.levenshtein(_code(F.split("t_joined", " ")), _code(F.split("e_joined", " "))) <= k)
    return both.select("t_tid", "e_tid", "t_joined", "e_joined").mapInArrow(_verify, "t_tid bigint, e_tid bigint")


def within(a: list[str], b: list[str], limit: int) -> bool:
    """Whether ``limit`` insertions, deletions or replacements of words turn ``a`` into ``b``; only a band of that width is looked at."""
    if abs(len(a) - len(b)) > limit:
        return False
    row = {j: j for j in range(min(len(b), limit) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - limit), min(len(b), i + limit) + 1):
            if j == 0:
                new[j] = i
                continue
            new[j] = min(row.get(j - 1, limit + 1) + (x != b[j - 1]), row.get(j, limit + 1) + 1, new.get(j - 1, limit + 1) + 1)
        row = new
        if min(row.values()) > limit:
            return False
    return row.get(len(b), limit + 1) <= limit


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
            u, v = x.split(" "), y.split(" ")
            keep.append(within(u, v, int(max(len(u), len(v)) * SHARE + 1e-9)))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["t_tid", "e_tid"])


def clip_name(path: Column) -> Column:
    """Letters and digits of the part after the last slash up to its first dot; null if there are none."""
    c = letters(F.substring_index(F.substring_index(path, "/", -1), ".", 1))
    return F.when(c != "", c)


def side_of(split: Column) -> Column:
    """True for train, false for validation and test, null for anything else."""
    return F.when(split == "train", True).when(split.isin("validation", "test"), False)


def pairs(spark: SparkSession, rows: DataFrame, key: str = "row_id", caption: str = "caption", path: str = "video_path", split: str = "split") -> DataFrame:
    """train_row, eval_row, by_caption, by_path: each pair of a train with an evaluation row once."""
    base = rows.select(F.col(key).alias("row"), side_of(F.col(split)).alias("is_train"), F.col(caption).alias("caption"), F.col(path).alias("path"))
    members = base.where("is_train IS NOT NULL").select("row", "is_train", F.array_join(words(F.col("caption")), " ").alias("joined")).where("joined <> ''")
    t = members.groupBy("joined").agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("tid"), F.max("is_train").alias("train"), F.max(~F.col("is_train")).alias("evaluation"))
    t = cut(spark, t.withColumn("n", F.size(F.split("joined", " "))), "distinct")
    tied = cut(spark, salted_join(members, t.select("joined", "tid", "size"), ["joined"], "row", "size").select("row", "is_train", "tid"), "members")
    links = near_texts(spark, t).unionByName(t.where("train AND evaluation").select(F.col("tid").alias("t_tid"), F.col("tid").alias("e_tid")))
    by_caption = (
        links.join(tied.where("is_train").select(F.col("tid").alias("t_tid"), F.col("row").alias("train_row")), "t_tid")
        .join(tied.where("NOT is_train").select(F.col("tid").alias("e_tid"), F.col("row").alias("eval_row")), "e_tid")
        .select("train_row", "eval_row", F.lit(True).alias("by_caption"), F.lit(False).alias("by_path"))
    )
    clips = base.where("is_train IS NOT NULL").select("row", "is_train", clip_name(F.col("path")).alias("clip")).where("clip IS NOT NULL")
    by_path = (
        clips.where("is_train").select("clip", F.col("row").alias("train_row")).join(clips.where("NOT is_train").select("clip", F.col("row").alias("eval_row")), "clip")
        .select("train_row", "eval_row", F.lit(False).alias("by_caption"), F.lit(True).alias("by_path"))
    )
    return by_caption.unionByName(by_path).groupBy("train_row", "eval_row").agg(F.max("by_caption").alias("by_caption"), F.max("by_path").alias("by_path"))


def coverage(rows: DataFrame, key: str = "row_id", caption: str = "caption", split: str = "split", span: int = 8) -> DataFrame:
    """Per evaluation row: words, words inside a span of ``span`` words that also stands in the training split.

    Suffixes meet by the hash of their first ``span`` words; the training side
    is folded to distinct hashes first, and overlapping spans are merged per row.
    """
    base = rows.select(F.col(key).alias("row"), side_of(F.col(split)).alias("is_train"), words(F.col(caption)).alias("w")).where("is_train IS NOT NULL AND size(w) > 0")
    heads = base.withColumn("hs", run_hashes(F.col("w"), span))
    train = heads.where("is_train").select(F.explode("hs").alias("h")).distinct()
    ev = heads.where("NOT is_train").select("row", F.size("w").alias("n_words"), F.posexplode("hs").alias("pos", "h"))
    hit = ev.join(train, "h", "left_semi").withColumn("next", F.lead("pos").over(W.partitionBy("row").orderBy("pos")))
    covered = hit.groupBy("row").agg(F.sum(F.least(F.lit(span), F.coalesce(F.col("next") - F.col("pos"), F.lit(span)))).alias("n_covered"))
    return heads.where("NOT is_train").select("row", F.size("w").alias("n_words")).join(covered, "row", "left").select("row", "n_words", F.coalesce("n_covered", F.lit(0)).cast("bigint").alias("n_covered"))


def found(spark: SparkSession, rows: DataFrame) -> DataFrame:
    p = pairs(spark, rows)
    return p.select(F.least("train_row", "eval_row").alias("row_a"), F.greatest("train_row", "eval_row").alias("row_b"))


def report(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Per evaluation split, its source and the training source: number of pairs and of evaluation rows in them."""
    p = pairs(spark, rows)
    r = rows.select("row_id", "split", "source")
    return (
        p.join(r.select(F.col("row_id").alias("eval_row"), "split", F.col("source").alias("eval_source")), "eval_row")
        .join(r.select(F.col("row_id").alias("train_row"), F.col("source").alias("train_source")), "train_row")
        .groupBy("split", "eval_source", "train_source")
        .agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("eval_row").alias("n_eval_rows"), F.count_if("by_caption").alias("n_by_caption"), F.count_if("by_path").alias("n_by_path"))
    )
