"""Stable row ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from civiclake.functions import as_column


def stable_string_hash(cols, *, separator: str = "|", method: str = "md5", seed: int = 42) -> Column:
    """Hash of the joined columns (null counts as empty text), as text. ``md5`` is equal on every
    engine; ``xxhash64`` is cheaper and takes the seed."""
    joined = F.concat_ws(separator, *[F.coalesce(as_column(c).cast("string"), F.lit("")) for c in cols])
    if method == "md5":
        return F.md5(joined)
    if method == "xxhash64":
        return F.xxhash64(F.lit(seed), joined).cast("string")
    raise ValueError(f"unknown hash method {method!r}")
