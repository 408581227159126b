"""Borough, coordinate, parcel and district functions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from civiclake.functions import as_column, strip

# Borough code -> (canonical name, spellings found in public datasets).
BOROUGHS = {
    1: ("Manhattan", ("MANHATTAN", "M", "MN", "1", "NEW YORK")),
    2: ("Bronx", ("BRONX", "B", "X", "BX", "2")),
    3: ("Brooklyn", ("BROOKLYN", "K", "BK", "3", "KINGS")),
    4: ("Queens", ("QUEENS", "Q", "QN", "4")),
    5: ("Staten Island", ("STATEN ISLAND", "S", "R", "SI", "5", "RICHMOND", "RICHMOND / STATEN ISLAND")),
}
# Bounding box of the city.
LATITUDES = (40.4, 40.95)
LONGITUDES = (-74.3, -73.65)


def _lookup(col, value_of) -> Column:
    pairs = [(F.lit(s), F.lit(value_of(code, name))) for code, (name, spellings) in BOROUGHS.items() for s in spellings]
    return F.try_element_at(F.create_map(*chain.from_iterable(pairs)), F.upper(strip(as_column(col))))


def borough_name(col) -> Column:
    return _lookup(col, lambda code, name: name)


def borough_code(col) -> Column:
    return _lookup(col, lambda code, name: code)


def borough_key(col) -> Column:
    return _lookup(col, lambda code, name: name.lower().replace(" ", "_"))


def add_borough_key(df: DataFrame, source_col: str = "borough", *, key: bool = True, code: bool = False,
                    canonical_name: bool = False) -> DataFrame:
    wanted = {
        "borough_key": (key, borough_key),
        "borough_code": (code, borough_code),
        "borough_name": (canonical_name, borough_name),
    }
    added = {name: fn(source_col) for name, (on, fn) in wanted.items() if on}
    return df.withColumns(added) if added else df


def has_valid_location(lat, lon, *, validate_bounds: bool = True) -> Column:
    lat, lon = (as_column(c).try_cast("double") for c in (lat, lon))
    present = lat.isNotNull() & lon.isNotNull()
    if validate_bounds:
        present = present & lat.between(*LATITUDES) & lon.between(*LONGITUDES)
    return F.coalesce(present, F.lit(False))


def add_location_flag(df: DataFrame, lat_col: str = "latitude", lon_col: str = "longitude", *,
                      validate_nyc_bounds: bool = True, alias: str = "has_location") -> DataFrame:
    return df.withColumn(alias, has_valid_location(lat_col, lon_col, validate_bounds=validate_nyc_bounds))


def pad_zeros(text: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is kept whole (``lpad`` alone would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def parcel_id(boro, block, lot) -> Column:
    """Ten-digit parcel id: borough digit, block of five, lot of four; any null part -> null."""
    digits = [pad_zeros(as_column(c).cast("string").try_cast("long").cast("string"), w) for c, w in ((block, 5), (lot, 4))]
    return F.concat(F.substring(as_column(boro).cast("string"), 1, 1), *digits)


def add_nyc_bbl(df: DataFrame, boro_col: str = "boro", block_col: str = "block", lot_col: str = "lot", *,
                alias: str = "bbl") -> DataFrame:
    return df.withColumn(alias, parcel_id(boro_col, block_col, lot_col))


def community_district_key(district, borough=None) -> Column:
    """Three-digit district key: borough code and a two-digit district, or the padded district alone."""
    text = strip(as_column(district).cast("string"))
    if borough is None:
        return pad_zeros(text, 3)
    return F.concat(borough_code(borough).cast("string"), pad_zeros(text, 2))


def add_community_district_key(df: DataFrame, district_col: str = "community_district",
                               borough_col: str | None = "borough", *,
                               alias: str = "community_district_key") -> DataFrame:
    return df.withColumn(alias, community_district_key(district_col, borough_col))


def board_borough(board) -> Column:
    """Upper-case borough name of a board number such as 312; null outside 100-599."""
    names = F.create_map(*chain.from_iterable((F.lit(c), F.lit(n.upper())) for c, (n, _) in BOROUGHS.items()))
    return F.try_element_at(names, F.floor(as_column(board) / 100).cast("int"))


def board_number(board) -> Column:
    return as_column(board) % 100
