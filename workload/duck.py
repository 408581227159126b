"""Pieces of DuckDB SQL shared by several counterparts."""

NY = "America/New_York"


def localize(ts: str, tz: str = NY) -> str:
    """Instant of a wall time: null in the skipped hour, the later one in the doubled hour."""
    instant = f"timezone('{tz}', {ts})"
    return (f"(CASE WHEN timezone('{tz}', {instant}) <> {ts} THEN NULL "
            f"WHEN timezone('{tz}', {instant} + INTERVAL 1 HOUR) = {ts} THEN {instant} + INTERVAL 1 HOUR "
            f"ELSE {instant} END)")


def utc_text(instant: str) -> str:
    return f"strftime(timezone('UTC', {instant}), '%Y-%m-%d %H:%M:%S.%f')"


def wall_text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S.%f')"


def local_wall(ts: str, tz: str = NY) -> str:
    """Wall time in ``tz`` of a timestamp holding UTC."""
    return f"timezone('{tz}', timezone('UTC', {ts}))"


def parsed_instant(text: str) -> str:
    # %f wants six digits in DuckDB, so fractions are filled up first.
    whole = f"regexp_replace({text}, '\\.(\\d+)(Z?)$', '')"
    fraction = (f"(CASE WHEN regexp_matches({text}, ':\\d\\d\\.\\d+Z?$') THEN CAST(rpad(regexp_extract({text}, "
                f"'\\.(\\d+)Z?$', 1), 6, '0') AS BIGINT) ELSE 0 END) * INTERVAL 1 MICROSECOND")
    z = f"try_strptime(replace({whole}, 'Z', ''), '%Y-%m-%dT%H:%M:%S') + {fraction}"
    wall = (f"try_strptime({whole}, ['%Y-%m-%dT%H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%Y%m%d', '%m/%d/%Y']) "
            f"+ {fraction}")
    return f"(CASE WHEN {text} LIKE '%Z' THEN timezone('UTC', {z}) ELSE {localize('(' + wall + ')')} END)"


def number(text: str) -> str:
    return f"TRY_CAST(regexp_replace({text}, '[$,\\s]', '', 'g') AS DOUBLE)"


def whole_number(text: str, kind: str = "BIGINT") -> str:
    plain = f"replace({text}, ',', '')"
    return f"CASE WHEN regexp_full_match({plain}, '[+-]?\\d+') THEN TRY_CAST({plain} AS {kind}) END"


def truth(text: str) -> str:
    word = f"regexp_replace(lower({text}), '^\\s+|\\s+$', '', 'g')"
    return f"CASE WHEN {word} IN ('1','t','true','y','yes') THEN true WHEN {word} IN ('0','f','false','n','no') THEN false END"


def pad(text: str, width: int) -> str:
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


BOROUGH_CODES = """CASE
    WHEN upper(trim(borough)) IN ('MANHATTAN','M','MN','1','NEW YORK') THEN 1
    WHEN upper(trim(borough)) IN ('BRONX','B','X','BX','2') THEN 2
    WHEN upper(trim(borough)) IN ('BROOKLYN','K','BK','3','KINGS') THEN 3
    WHEN upper(trim(borough)) IN ('QUEENS','Q','QN','4') THEN 4
    WHEN upper(trim(borough)) IN ('STATEN ISLAND','S','R','SI','5','RICHMOND','RICHMOND / STATEN ISLAND') THEN 5 END"""


def borough_name() -> str:
    return f"(['Manhattan','Bronx','Brooklyn','Queens','Staten Island'])[{BOROUGH_CODES}]"
