"""Evaluation items that stand, whole or in part, in a corpus.

Method: SimHash over windows of a fixed number of words - the piece of an item
that counts as a leak. Each word votes with its weight on 64 bits; the votes
of a window are differences of running sums, so a document of n words costs n.
Multi-index Hamming blocks (radius + 1 blocks of bits; two fingerprints within
the radius agree on one block at least) find every item window within the
radius of a document window. Candidates are verified by their exact weighted
shingle similarity, and for a verbatim leak by the words themselves.

The items are the stated query set. They are taken in blocks of bounded size,
each sent to the workers once and held against the whole corpus, so the corpus
is neither shuffled nor collected.

Defined results: null, empty and wordless documents and items have no window
and no case; an item shorter than the window has no case; items with the same
text each count; a document with several copies of an item counts once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W_]+")
WINDOW = 12
SHINGLE = 5
#: Item windows sent to the workers at once: about 150 bytes each, so 75 MB at most.
WINDOWS_PER_BLOCK = 500_000
#: Distinct words whose votes a worker keeps; beyond this it starts anew.
VOCABULARY = 300_000
#: Words whose running sums are held at once: 64 four-byte sums each.
CHUNK = 1 << 15
#: Bits between an item and a window as long as it: see the README for the recall measured at similarity 0.8.
ITEM_RADIUS = 20
_FLAG = 20


def words(text: str | None) -> list[str]:
    return WORD.findall(text.upper().lower()) if text else []


def weight(word: str) -> int:
    """Weight of a word in fingerprints and similarity: short words say less."""
    return 1 if len(word) < 4 else 2


def shingles(w: list[str], size: int = SHINGLE) -> dict[tuple, int]:
    out: dict[tuple, int] = {}
    for i in range(len(w) - size + 1):
        s = tuple(w[i : i + size])
        out[s] = out.get(s, 0) + sum(map(weight, s))
    return out


def similarity(a: list[str], b: list[str], size: int = SHINGLE) -> float:
    """Weighted Jaccard similarity of the shingle multisets."""
    x, y = shingles(a, size), shingles(b, size)
    if not x or not y:
        return 1.0 if a == b else 0.0
    low = sum(min(v, y.get(k, 0)) for k, v in x.items())
    return low / (sum(x.values()) + sum(y.values()) - low)


class Votes:
    """Words to rows of votes and to 64-bit hashes; grows with the words seen, up to a bound."""

    def __init__(self, bound: int = VOCABULARY):
        self.bound = bound
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.votes = np.empty((1024, 64), np.int8)
        self.hashes = np.empty(1024, np.uint64)

    def look_up(self, ws: list[str]) -> np.ndarray:
        ids = list(map(self.ids.get, ws))
        if None in ids:
            ids = [i if i is not None else self._add(w) for w, i in zip(ws, ids)]
        return np.array(ids, np.int64)

    def _add(self, w: str) -> int:
        i = self.ids.get(w)
        if i is not None:
            return i
        i = len(self.ids)
        if i == len(self.hashes):
            self.votes = np.concatenate([self.votes, np.empty_like(self.votes)])
            self.hashes = np.concatenate([self.hashes, np.empty_like(self.hashes)])
        h = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        self.hashes[i] = h
        bits = np.unpackbits(np.array([xxhash.xxh3_64_intdigest(h.to_bytes(8, "little"), 7)], np.uint64).view(np.uint8))
        self.votes[i] = (bits.astype(np.int8) * 2 - 1) * weight(w)
        self.ids[w] = i
        return i


def fingerprints(votes: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """SimHash of every window of consecutive words; a tie of votes counts as zero."""
    n = len(ids) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.empty(n, np.uint64)
    for at in range(0, n, CHUNK):
        part = ids[at : at + CHUNK + window - 1]
        sums = np.zeros((len(part) + 1, 64), np.int32)
        np.cumsum(votes[part], axis=0, dtype=np.int32, out=sums[1:])
        bits = (sums[window:] - sums[:-window]) > 0
        out[at : at + CHUNK] = np.packbits(bits, axis=1).view(np.uint64).ravel()
    return out


class Index:
    """Multi-index Hamming blocks over the windows of a block of items."""

    def __init__(self, items: list[tuple[int, str]], window: int, radius: int):
        self.window, self.radius = window, radius
        v = Votes(1 << 62)
        self.items, self.texts, fps, owner, start, hashes = [], [], [], [], [], []
        for key, text in items:
            w = words(text)
            ids = v.look_up(w)
            f = fingerprints(v.votes, ids, window)
            if len(f):
                k = len(self.items)
                self.items.append(key)
                self.texts.append(w)
                fps.append(f)
                owner.append(np.full(len(f), k, np.int32))
                start.append(np.arange(len(f), dtype=np.int32))
                h = v.hashes[ids]
                hashes.append(np.lib.stride_tricks.sliding_window_view(h, window).copy())
        cat = lambda xs, empty: np.concatenate(xs) if xs else empty
        self.fps = cat(fps, np.empty(0, np.uint64))
        self.owner, self.start = cat(owner, np.empty(0, np.int32)), cat(start, np.empty(0, np.int32))
        self.hashes = cat(hashes, np.empty((0, window), np.uint64))
        edges = [64 * i // (radius + 1) for i in range(radius + 2)]
        self.blocks = []
        for lo, hi in zip(edges, edges[1:]):
            key = (self.fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            order = np.argsort(key, kind="stable")
            flag = np.zeros(1 << min(_FLAG, hi - lo), bool)
            flag[key & np.uint64(len(flag) - 1)] = True
            self.blocks.append((lo, hi, key[order], order, flag))

    def near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``fps``, item window) of every pair within the radius, each pair once."""
        found = []
        for lo, hi, keys, order, flag in self.blocks:
            key = (fps >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
            at = np.flatnonzero(flag[key & np.uint64(len(flag) - 1)])
            key = key[at]
            left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            some = right > left
            at, left, size = at[some], left[some], (right - left)[some]
            for a in range(0, len(at), CHUNK):  # matches of one piece at a time
                n = size[a : a + CHUNK]
                p = np.repeat(at[a : a + CHUNK], n)
                q = order[np.repeat(left[a : a + CHUNK] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
                ok = np.bitwise_count(fps[p] ^ self.fps[q]) <= self.radius
                found.append((p[ok], q[ok]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        p, q = (np.concatenate(x) for x in zip(*found))
        if len(self.blocks) > 1 and len(p):
            pair = np.unique(p.astype(np.int64) * max(len(self.fps), 1) + q)
            p, q = pair // max(len(self.fps), 1), pair % max(len(self.fps), 1)
        return p, q


class ItemIndex:
    """Whole items by their number of words, each length with its own fingerprints, and the words of all."""

    def __init__(self, items: list[tuple[int, str]], least_words: int, radius: int):
        self.radius = radius
        sized: dict[int, list[tuple[int, str]]] = {}
        v, codes = Votes(1 << 62), [np.empty(0, np.uint64)]
        for key, text in items:
            w = words(text)
            if w and len(w) >= least_words:
                sized.setdefault(len(w), []).append((key, text))
                codes.append(v.hashes[v.look_up(w)])
        self.codes = np.unique(np.concatenate(codes))
        self.by_length = {}
        for n, x in sorted(sized.items()):
            part = Index(x, n, radius)
            own = part.owner[:, None].astype(np.int64) * len(self.codes) + np.searchsorted(self.codes, part.hashes)
            weights = np.array([sum(map(weight, w)) for w in part.texts], np.int64)
            self.by_length[n] = part, np.unique(own), weights

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word among the items' words, -1 of any other."""
        if not len(self.codes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.codes, hashes), len(self.codes) - 1)
        return np.where(self.codes[at] == hashes, at, -1)

    def near(self, part: Index, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As :meth:`Index.near`; few items are held against every fingerprint, as short blocks of bits part nothing."""
        if len(part.fps) > 256:
            return part.near(fps)
        return np.nonzero(np.bitwise_count(fps[:, None] ^ part.fps) <= self.radius)


def _search_items(index: ItemIndex, least: float):
    """Documents (key, text) to (key, item, similarity) rows of windows as long as the item.

    Similarity is that of the words (shingles of one), which are also what
    fingerprints are made of. Only windows are fingerprinted whose words are
    by weight to the share ``least`` words of some item: what two multisets
    share is at most that, and their union is at least the window, so no
    window of that similarity is left out here. The pairs within the radius
    are sifted likewise by the words of their own item before the exact
    similarity.
    """

    def flush(docs: list, ws: list[list[str]], v: Votes) -> Iterator[tuple]:
        flat = [w for x in ws for w in x]
        ids = v.look_up(flat)
        place = index.places(v.hashes[ids])
        heavy = np.abs(v.votes[ids, 0]).astype(np.int64)
        every = np.concatenate(([0], np.cumsum(heavy)))
        hit = np.concatenate(([0], np.cumsum(heavy * (place >= 0))))
        size = np.array([len(x) for x in ws])
        ends = np.cumsum(size)
        doc = np.repeat(np.arange(len(ws)), size)
        sums = None
        best: dict[tuple[int, int], float] = {}
        for n, (part, own, weights) in index.by_length.items():
            if n > len(flat):
                break
            at = np.flatnonzero(hit[n:] - hit[:-n] >= least * (every[n:] - every[:-n]) - 1e-9)
            at = at[at + n <= ends[doc[at]]]
            if sums is None and len(at) and len(flat) <= 8 * CHUNK:
                sums = np.zeros((len(flat) + 1, 64), np.int32)
                np.cumsum(v.votes[ids], axis=0, dtype=np.int32, out=sums[1:])
            piece, pairs = max((1 << 18) // n, 1), max((1 << 20) // n, 1)
            for lo in range(0, len(at), piece):
                pos = at[lo : lo + piece]
                if sums is None:  # a very long document
                    votes = v.votes[ids[pos[:, None] + np.arange(n)]].sum(1, dtype=np.int32)
                else:
                    votes = sums[pos + n] - sums[pos]
                p, q = index.near(part, np.packbits(votes > 0, axis=1).view(np.uint64).ravel())
                for k in range(0, len(p), pairs):
                    x, y = pos[p[k : k + pairs]], q[k : k + pairs]
                    cell = x[:, None] + np.arange(n)
                    want = part.owner[y][:, None].astype(np.int64) * len(index.codes) + place[cell]
                    found = own[np.minimum(np.searchsorted(own, want), len(own) - 1)] == want
                    share = (heavy[cell] * (found & (place[cell] >= 0))).sum(1)
                    total = every[x + n] - every[x] + weights[part.owner[y]]
                    ok = share * (1 + least) >= least * total - 1e-9
                    for s, o in zip(x[ok].tolist(), part.owner[y[ok]].tolist()):
                        sim = similarity(flat[s : s + n], part.texts[o], 1)
                        if sim >= least:
                            key = (int(doc[s]), part.items[o])
                            best[key] = max(sim, best.get(key, 0.0))
        for (d, i), sim in best.items():
            yield docs[d], i, sim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Votes()
        for b in batches:
            rows, docs, ws, n = [], [], [], 0
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(text)
                if not w:
                    continue
                docs.append(key)
                ws.append(w)
                n += len(w)
                if n > CHUNK:
                    rows += flush(docs, ws, v)
                    docs, ws, n = [], [], 0
                    if len(v.ids) > v.bound:
                        v.clear()
            if ws:
                rows += flush(docs, ws, v)
            keys, items, sims = zip(*rows) if rows else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.column(0).type), pa.array(items, pa.int64()), pa.array(sims, pa.float64())], names=["doc_id", "item_id", "similarity"])

    return run


def _search(index: Index, least: float):
    """Documents (key, text) to (key, item, similarity) rows."""
    verbatim = least >= 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Votes()
        for b in batches:
            keys, items, sims = [], [], []
            docs, ws, n = [], [], 0

            def flush() -> None:
                if not ws:
                    return
                flat = [w for x in ws for w in x]
                ids = v.look_up(flat)
                fps = fingerprints(v.votes, ids, index.window)
                size = np.array([len(x) for x in ws])
                ends = np.cumsum(size)
                doc = np.repeat(np.arange(len(ws)), size)[: len(fps)]
                inside = np.arange(len(fps)) + index.window <= ends[doc]
                pos = np.flatnonzero(inside)
                p, q = index.near(fps[pos])
                p = pos[p]
                if verbatim and len(p):
                    h = v.hashes[ids]
                    same = (h[p[:, None] + np.arange(index.window)] == index.hashes[q]).all(axis=1)
                    p, q = p[same], q[same]
                best: dict[tuple[int, int], float] = {}
                for x, y in zip(p.tolist(), q.tolist()):
                    k = (int(doc[x]), int(index.owner[y]))
                    if best.get(k, 0.0) >= 1.0:
                        continue
                    mine = flat[x : x + index.window]
                    s = int(index.start[y])
                    theirs = index.texts[k[1]][s : s + index.window]
                    sim = similarity(mine, theirs)
                    if sim >= least and (not verbatim or mine == theirs):
                        best[k] = max(sim, best.get(k, 0.0))
                for (d, i), sim in best.items():
                    keys.append(docs[d])
                    items.append(index.items[i])
                    sims.append(sim)
                docs.clear()
                ws.clear()
                if len(v.ids) > v.bound:
                    v.clear()

            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(text)
                if len(w) >= index.window:
                    docs.append(key)
                    ws.append(w)
                    n += len(w)
                    if n > 8 * CHUNK:
                        flush()
                        n = 0
            flush()
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.column(0).type), pa.array(items, pa.int64()), pa.array(sims, pa.float64())], names=["doc_id", "item_id", "similarity"])

    return run


def leaks(
    spark: SparkSession, docs: DataFrame, items: DataFrame, doc: str = "doc_id", doc_text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, radius: int = 1, least: float = 1.0, windows_per_block: int = WINDOWS_PER_BLOCK,
) -> DataFrame:
    """doc_id, item_id, similarity: documents with a window like a window of the item.

    At ``least`` = 1 a leak is verbatim: ``window`` consecutive words of the
    item in the document; any such window has the item window's fingerprint, so
    none is missed at any radius. Below 1, windows within ``radius`` of each
    other that are at least so similar.
    """
    return _in_blocks(spark, docs, items, doc, doc_text, item, item_text, windows_per_block, lambda block: Index(block, window, radius), lambda index: _search(index, least))


def near_items(
    spark: SparkSession, docs: DataFrame, items: DataFrame, doc: str = "doc_id", doc_text: str = "text", item: str = "item_id", item_text: str = "text",
    radius: int = ITEM_RADIUS, least: float = 0.8, least_words: int = WINDOW, words_per_block: int = WINDOWS_PER_BLOCK,
) -> DataFrame:
    """doc_id, item_id, similarity: documents with a window as long as the item, within ``radius`` of it and at least so similar.

    Similarity is that of the words, not of five-word shingles: an item that
    is 0.8 like a window by such shingles has twelve words unchanged in a row
    and is a verbatim leak; by words, one in nine may be changed.
    """
    return _in_blocks(spark, docs, items, doc, doc_text, item, item_text, words_per_block, lambda block: ItemIndex(block, least_words, radius), lambda index: _search_items(index, least))


def _in_blocks(spark: SparkSession, docs: DataFrame, items: DataFrame, doc: str, doc_text: str, item: str, item_text: str, bound: int, build: Callable, scan: Callable) -> DataFrame:
    """``scan`` of every document against ``build`` of one block of items after another."""
    kind = docs.schema[doc].dataType.simpleString()
    out = None
    block: list[tuple[int, str]] = []
    size = 0

    def search(block: list[tuple[int, str]]) -> DataFrame:
        index = spark.sparkContext.broadcast(build(block))
        rows = docs.select(F.col(f"`{doc}`"), F.col(f"`{doc_text}`")).where(F.col(f"`{doc_text}`").isNotNull())
        return rows.mapInArrow(lambda bs: scan(index.value)(bs), f"doc_id {kind}, item_id bigint, similarity double")

    wanted = items.select(F.col(f"`{item}`").cast("bigint").alias("i"), F.col(f"`{item_text}`").alias("t")).where("t IS NOT NULL")
    for r in wanted.toLocalIterator():  # the stated query set, one bounded block at a time
        block.append((r["i"], r["t"]))
        size += len(r["t"]) // 2
        if size > bound:
            out = search(block) if out is None else out.unionByName(search(block))
            block, size = [], 0
    if block or out is None:
        out = search(block) if out is None else out.unionByName(search(block))
    return out
