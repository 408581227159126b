"""Text functions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from civiclake.functions import as_column


def clean_text(col, *, uppercase: bool = True) -> Column:
    """Trim, collapse blanks to one space, optionally upper-case; null stays null."""
    text = F.trim(F.regexp_replace(as_column(col), r"(?U)\s+", " "))
    return F.upper(text) if uppercase else text


def apply_literal_replacements(col, replacements: dict[str, str], *, replace_all: bool = True) -> Column:
    """Apply literal replacements in order, everywhere or at the first occurrence only."""
    text = as_column(col)
    for old, new in replacements.items():
        if replace_all:
            text = F.replace(text, F.lit(old), F.lit(new))
        else:
            at = F.locate(old, text)
            text = F.when(at > 0, F.overlay(text, F.lit(new), at, F.lit(len(old)))).otherwise(text)
    return text


def split_and_clean_list(col, *, delimiter: str = ",") -> Column:
    """Split on a literal delimiter, trim the pieces and drop the empty ones."""
    pieces = F.split(as_column(col), re.escape(delimiter))
    trimmed = F.transform(pieces, lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", ""))
    return F.filter(trimmed, lambda p: F.length(p) > 0)
