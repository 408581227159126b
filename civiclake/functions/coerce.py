"""Lenient string-to-typed conversions: what cannot be read becomes null, never an error."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F, types as T

from civiclake.functions import as_column, strip
from civiclake.functions.temporal import local_wall_time, localize

NEW_YORK = "America/New_York"

# Accepted timestamp layouts (strftime notation), first success wins.
TIMESTAMP_LAYOUTS = (
    "%Y-%m-%dT%H:%M:%S%.fZ",
    "%Y-%m-%dT%H:%M:%SZ",
    "%Y-%m-%dT%H:%M:%S%.f",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M:%S%.f",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%d",
    "%Y%m%d",
    "%m/%d/%Y",
)

# Words read as booleans.
TRUE_WORDS = ("1", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "f", "false", "n", "no")

# strftime token -> (Spark pattern, pattern next to another number, shape of the text)
_TOKENS = {
    "%Y": ("yyyy", "yyyy", r"\d{4}"),
    "%m": ("M", "MM", r"\d{1,2}"),
    "%d": ("d", "dd", r"\d{1,2}"),
    "%H": ("H", "HH", r"\d{1,2}"),
    "%M": ("m", "mm", r"\d{1,2}"),
    "%S": ("s", "ss", r"\d{1,2}"),
    "%.f": ("[.SSSSSSSSS]", "[.SSSSSSSSS]", r"(\.\d{1,9})?"),
    "%z": ("xx", "xx", r"[+-]\d{4}"),
    "%b": ("MMM", "MMM", r"[A-Za-z]{3}"),
    "%B": ("MMMM", "MMMM", r"[A-Za-z]+"),
}
_NUMBERS = ("%Y", "%m", "%d", "%H", "%M", "%S")
_TOKEN_SPLIT = re.compile(r"(%\.f|%[A-Za-z])")


def spark_layout(layout: str) -> tuple[str, str]:
    """Translate a strftime layout to (Spark datetime pattern, regex the text must match)."""
    parts = [p for p in _TOKEN_SPLIT.split(layout) if p]
    pattern, shape = [], []
    for i, part in enumerate(parts):
        if part in _TOKENS:
            loose, exact, text = _TOKENS[part]
            packed = part in _NUMBERS and any(
                0 <= j < len(parts) and parts[j] in _NUMBERS for j in (i - 1, i + 1)
            )
            pattern.append(exact if packed else loose)
            shape.append(r"\d{2}" if packed and part != "%Y" else text)
        elif part.startswith("%"):
            raise ValueError(f"unsupported layout token {part!r} in {layout!r}")
        else:
            pattern.append("".join("'" + c + "'" if c.isalpha() else c for c in part))
            shape.append(re.escape(part))
    return "".join(pattern), "^" + "".join(shape) + "$"


def try_parse(text: Column, layout: str) -> Column:
    """Parse one layout. The shape test keeps texts of other layouts away from the parser,
    whose failures are far dearer than a regex."""
    pattern, shape = spark_layout(layout)
    return F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)))


def multi_parse_date(col, formats=TIMESTAMP_LAYOUTS, output_timezone: str = NEW_YORK) -> Column:
    """Read a timestamp in any of ``formats``. Layouts with ``Z`` or ``%z`` are instants; the others
    are wall time in ``output_timezone`` (missing hour of the year -> null, doubled hour -> the later).
    """
    text = as_column(col).cast("string")
    parsed = F.coalesce(*[try_parse(text, f) for f in formats])
    instants = [spark_layout(f)[1] for f in formats if "Z" in f or "%z" in f]
    return localize(parsed, output_timezone, unless=text.rlike("|".join(instants)) if instants else None)


def parse_local_date(col, formats=TIMESTAMP_LAYOUTS, timezone: str = NEW_YORK) -> Column:
    """Calendar day in ``timezone`` of a timestamp read by :func:`multi_parse_date`."""
    return F.to_date(local_wall_time(multi_parse_date(col, formats, timezone), timezone))


def safe_bool(col) -> Column:
    word = strip(F.lower(as_column(col).cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


_FLOAT_SHAPE = r"(?i)^[+-]?(\d+\.?\d*([e][+-]?\d+)?|\.\d+([e][+-]?\d+)?|inf|infinity|nan)$"


def _plain_float(text: Column, target: str = "double") -> Column:
    # The shape test refuses what Spark alone would read, such as '1d' or ' 5 '.
    return F.when(text.rlike(_FLOAT_SHAPE), text.try_cast(target))


def safe_float(col, target: str = "double") -> Column:
    """Number out of text such as ``$1,234.56``: currency signs, commas and blanks are ignored."""
    text = F.regexp_replace(as_column(col).cast("string"), r"(?U)[$,\s]", "")
    return _plain_float(text).cast(target)


# Whole numbers of 64 bits and less, with the largest value each type holds.
_LIMITS = {"tinyint": 2**7 - 1, "smallint": 2**15 - 1, "int": 2**31 - 1}


def safe_int(col, target: T.DataType = T.LongType(), low: int | None = None, high: int | None = None) -> Column:
    """Whole number out of text with thousands commas; ``12.0`` and padded text are null.
    ``low`` / ``high`` bound types Spark has no native equivalent for (unsigned)."""
    text = F.replace(as_column(col).cast("string"), F.lit(","), F.lit(""))
    wide = target if isinstance(target, T.DecimalType) else T.LongType()
    # A failing cast is dear, so texts with too many digits are refused by their shape already.
    digits = wide.precision if isinstance(wide, T.DecimalType) else 19
    number = F.when(text.rlike(rf"^[+-]?0*\d{{1,{digits}}}$"), text.try_cast(wide))
    name = target.simpleString()
    if low is None and name not in _LIMITS:
        return number
    if low is None:
        high = _LIMITS[name]
        low = -high - 1
    bounds = [F.lit(str(b)).cast(wide) for b in (low, high)]  # 2**64 has no integer literal
    return F.when(number.between(*bounds), number.cast(target))
