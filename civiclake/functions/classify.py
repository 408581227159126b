"""Mapping and rule-based labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from civiclake.functions import as_column


def map_with_default(col, mapping: dict[str, str], *, default: str) -> Column:
    if not mapping:
        return F.lit(default)
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.coalesce(F.try_element_at(table, as_column(col)), F.lit(default))


def ordered_regex_classification(col, rules: list[tuple[str, str]], *, default: str) -> Column:
    """Label of the first ``(label, pattern)`` rule found in the text, else the default."""
    text = as_column(col)
    return F.coalesce(*[F.when(text.rlike(p), F.lit(label)) for label, p in rules], F.lit(default))


def assemble_annotations(conditions: list[tuple[Column, str]], *, separator: str = "; ") -> Column:
    """Messages of all true conditions, joined; null when none is true."""
    if not conditions:
        return F.lit(None).cast("string")
    messages = F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in conditions]))
    return F.nullif(F.array_join(messages, separator), F.lit(""))


def collect_matching_labels(col, rules: list[tuple[str, str]], *, separator: str = "; ") -> Column:
    """Labels of all rules found in the text, joined; null when none is found."""
    text = as_column(col)
    return assemble_annotations([(text.rlike(p), label) for label, p in rules], separator=separator)


# Upper depth limits in inches and their severity labels.
SEVERITY_BANDS = ((4.0, "minor"), (12.0, "moderate"), (24.0, "major"))
TOP_SEVERITY = "severe"
SEVERITIES = tuple(label for _, label in SEVERITY_BANDS) + (TOP_SEVERITY,)


def depth_severity(depth, *, null_is_severe: bool = True) -> Column:
    """Severity band of a depth. A missing depth counts as severe unless told otherwise."""
    depth = as_column(depth)
    bands = [F.when(depth < limit, F.lit(label)) for limit, label in SEVERITY_BANDS]
    top = F.lit(TOP_SEVERITY) if null_is_severe else F.when(depth.isNotNull(), F.lit(TOP_SEVERITY))
    return F.coalesce(*bands, top)


def label_rank(col, labels) -> Column:
    """1-based position of a label in an ordered list; null when it is not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in labels]), as_column(col)), F.lit(0))


def is_word(col, word: str = "Yes") -> Column:
    return as_column(col) == F.lit(word)
