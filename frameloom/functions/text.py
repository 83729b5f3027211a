"""Word and letter normal forms as Column expressions (whole-stage codegen).

A word is an unbroken run of letters and digits of any script, letter case
ignored. Case is folded through upper then lower, so that a letter whose
capital form is two letters equals its own capital spelling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_WORD = r"[^\p{L}\p{N}]+"


def letters(c: Column) -> Column:
    """The sequence of letters and digits, folded; everything else left out.

    The replacement stands between upper and lower, because the optimizer
    would take lower(upper(x)) for lower(x).
    """
    return F.lower(F.regexp_replace(F.upper(c), NOT_WORD, ""))


def words(c: Column) -> Column:
    """The words in order; an empty array for null and wordless text."""
    spaced = F.lower(F.regexp_replace(F.upper(c), NOT_WORD, " "))
    return F.coalesce(F.filter(F.split(spaced, " "), lambda x: x != ""), F.array().cast("array<string>"))


def run_hashes(w: Column, size: int) -> Column:
    """64-bit hashes of the runs of ``size`` consecutive elements of an array, in order; empty if it is shorter.

    Shifted slices are zipped instead of slicing inside a lambda: what a lambda
    captures is evaluated again for each element.
    """
    n = F.greatest(F.size(w) - (size - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice(w, k + 1, n).alias(f"x{k}") for k in range(size)])
    return F.transform(zipped, lambda z: F.xxhash64(*[z[f"x{k}"] for k in range(size)]))
