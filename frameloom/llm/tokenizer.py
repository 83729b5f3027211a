"""Byte-level BPE encoding of a corpus by a public vocabulary.

Method: two-tier lookup. A minimal perfect hash over the vocabulary resolves
each pre-token that is a vocabulary entry as a whole; the rest is merged by
rank with a heap over a doubly linked list of bytes, so a pre-token of n bytes
costs n log n. The vocabulary is read from its file on the driver, and the
hash (bounded by the vocabulary, under 2 MB) goes to each worker once.

Defined results: null and empty texts have the empty list; a text is taken as
it is, and what looks like a special token is plain text.
"""

from __future__ import annotations

import base64
import heapq
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Place of the vocabulary; a parameter of every function here.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokens of a worker whose ids are remembered; beyond this the memory starts anew.
REMEMBERED = 400_000
#: Longer pre-tokens aren't remembered.
REMEMBERED_CHARS = 48


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _ranges(kind: str) -> str:
    """A character class body of all characters whose general category starts with ``kind``."""
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        inside = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{c - 1:08x}")
            start = None
    return "".join(out)


@lru_cache(1)
def pattern() -> re.Pattern:
    """The pre-token pattern of the byte-level vocabulary, over Unicode letters, numbers and white space."""
    le, nu = _ranges("L"), _ranges("N")
    ws = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    return re.compile(f"'(?:[sdmt]|ll|ve|re)| ?[{le}]+| ?[{nu}]+| ?[^{ws}{le}{nu}]+|[{ws}]+(?![^{ws}])|[{ws}]+")


ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")


class PerfectHash:
    """A minimal perfect hash: keys in buckets, the largest bucket placed first, one seed per bucket."""

    def __init__(self, vocabulary: dict[bytes, int], per_bucket: int = 1):
        keys = list(vocabulary)
        n = self.n = max(1, len(keys))
        m = self.m = max(1, n // per_bucket)
        buckets: list[list[bytes]] = [[] for _ in range(m)]
        for k in keys:
            buckets[xxhash.xxh3_64_intdigest(k) % m].append(k)
        self.seeds = np.zeros(m, np.int32)
        slots: list[bytes | None] = [None] * n
        free = np.ones(n, bool)
        order = sorted(range(m), key=lambda b: -len(buckets[b]))
        singles = iter(())
        for at, b in enumerate(order):
            ks = buckets[b]
            if not ks:
                break
            if len(ks) == 1:
                singles = iter(order[at:])
                break
            seed = 1
            while True:
                places = [xxhash.xxh3_64_intdigest(k, seed) % n for k in ks]
                if len(set(places)) == len(ks) and all(free[p] for p in places):
                    break
                seed += 1
            self.seeds[b] = seed
            for k, p in zip(ks, places):
                slots[p], free[p] = k, False
        empty = iter(np.flatnonzero(free).tolist())
        for b in singles:
            if not buckets[b]:
                break
            p = next(empty)
            self.seeds[b] = -p - 1  # a bucket of one key names its slot
            slots[p] = buckets[b][0]
        self.keys = slots
        self.ids = np.array([vocabulary[k] if k is not None else -1 for k in slots], np.int32)

    def get(self, key: bytes) -> int:
        """The id of ``key``, or -1."""
        s = int(self.seeds[xxhash.xxh3_64_intdigest(key) % self.m])
        p = -s - 1 if s < 0 else xxhash.xxh3_64_intdigest(key, s) % self.n
        return int(self.ids[p]) if self.keys[p] == key else -1


class Encoder:
    def __init__(self, table: PerfectHash):
        self.table, self.known = table, {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of a pre-token that is no entry: pairs are merged by lowest rank, leftmost first."""
        get = self.table.get
        n = len(data)
        part: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            r = get(data[i : i + 2])
            if r >= 0:
                heap.append((r, i, 2))
        heapq.heapify(heap)
        while heap:
            r, i, size = heapq.heappop(heap)
            a = part[i]
            j = right[i] if a is not None else n
            if a is None or j >= n or len(a) + len(part[j]) != size or get(a + part[j]) != r:
                continue  # one of the two has been merged since
            part[i], part[j] = a + part[j], None
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                q = get(part[i] + part[k])
                if q >= 0:
                    heapq.heappush(heap, (q, i, size + len(part[k])))
            h = left[i]
            if h >= 0:
                q = get(part[h] + part[i])
                if q >= 0:
                    heapq.heappush(heap, (q, h, len(part[h]) + size))
        return [get(p) for p in part if p is not None]

    def token(self, t: str) -> list[int]:
        data = t.encode("utf-8", "surrogatepass")
        i = self.table.get(data)
        ids = [i] if i >= 0 else self.merge(data)
        if len(t) <= REMEMBERED_CHARS:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[t] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        toks = (ASCII if text.isascii() else pattern()).findall(text)
        known = list(map(self.known.get, toks))
        if None in known:
            known = [ids or self.token(t) for t, ids in zip(toks, known)]
        return list(chain.from_iterable(known))


def encode(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """key, ids of every document: one Arrow pass over two columns, no shuffle."""
    table = spark.sparkContext.broadcast(PerfectHash(read_vocabulary(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(table.value)
        for b in batches:
            size, ids = [0], []
            for t in b.column(1).to_pylist():
                ids.append(np.array(enc.encode(t), np.int32))
                size.append(size[-1] + len(ids[-1]))
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(run, f"`{key}` {kind}, ids array<int>")
