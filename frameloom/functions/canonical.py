"""Canonical JSON and the fingerprints made of it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(doc: object, drop: Sequence[str] = ()) -> str:
    """Keys sorted, no spaces, ASCII escapes, lists in order; dotted keys in ``drop`` are left out."""

    def prune(x: object, at: str) -> object:
        if isinstance(x, dict):
            return {k: prune(v, f"{at}{k}.") for k, v in x.items() if f"{at}{k}" not in drop}
        return [prune(v, at) for v in x] if isinstance(x, list) else x

    return json.dumps(prune(doc, ""), sort_keys=True, separators=(",", ":"), ensure_ascii=True)


def fingerprint(doc: Column, drop: Sequence[str] = (), digits: int = 64) -> Column:
    """SHA-256 of canonical JSON text, its first hex ``digits``; null for text that is no JSON."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        out = []
        for x in s:
            try:
                out.append(hashlib.sha256(canonical(json.loads(x), drop).encode()).hexdigest()[:digits] if x is not None else None)
            except ValueError:
                out.append(None)
        return pd.Series(out, dtype=object)

    return run(doc)


def major_minor(version: Column) -> Column:
    """'12.8' of '12.8.93+cu'; null without two numbers."""
    return F.nullif(F.regexp_extract(version, r"(\d+\.\d+)", 1), F.lit(""))


def folded_path(path: Column) -> Column:
    """A model path as one name: slashes at the end off, others folded to one underscore."""
    return F.regexp_replace(F.regexp_replace(path, r"[\\/]+$", ""), r"[\\/]+", "_")


def short_display(c: Column, most: int = 14, kept: int = 12) -> Column:
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, kept), F.lit(".."))).otherwise(c)
