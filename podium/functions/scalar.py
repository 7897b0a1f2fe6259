"""Column-expression helpers. All are built-in Spark expressions (codegen),
never Python UDFs."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source data conventions.
# Whitespace stripped by a Python-style strip(): space, tab, LF, CR, FF, VT.
PY_WHITESPACE_CLASS = r"[ \t\n\r\f\x0B]"
# Timestamp layouts tried in order when coercing free-text times.
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][XXX][XX]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][XXX][XX]",
    "yyyy-MM-dd",
    "d MMM yyyy HH:mm:ss[ XX][ XXX]",
    "d MMM yyyy HH:mm:ss z",
]


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_double(c) -> Column:
    """NaN and NULL are both 'missing' (pandas semantics): NaN becomes NULL."""
    c = col_(c).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


def fill0(c) -> Column:
    """pandas ``fillna(0.0)``: NULL and NaN both become 0.0."""
    return F.coalesce(clean_double(c), F.lit(0.0))


def clip(c, lo=None, hi=None) -> Column:
    """pandas ``clip``: keeps NULL (``greatest``/``least`` would skip it)."""
    c = col_(c)
    out = c
    if lo is not None:
        out = F.when(out < F.lit(lo), F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > F.lit(hi), F.lit(hi)).otherwise(out)
    return F.when(c.isNull(), F.lit(None)).otherwise(out)


def py_strip(c) -> Column:
    """Python ``str.strip()`` for ASCII whitespace (SQL trim strips blanks only)."""
    ws = PY_WHITESPACE_CLASS
    return F.regexp_replace(col_(c), f"^{ws}+|{ws}+$", "")


def slug_id(title, prefix: str) -> Column:
    """``prefix || strip('_', regexp_replace(lower(title), '[^a-z0-9]+', '_'))``."""
    s = F.regexp_replace(F.lower(col_(title)), "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.concat(F.lit(prefix), s)


def sha_prefix_id(c, prefix: str, n: int = 12) -> Column:
    """``prefix || first n hex chars of sha256(c)``."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(col_(c).cast("string"), 256), 1, n))


def try_parse_timestamp(c, formats=None) -> Column:
    """First layout that parses; NULL when none does (no exception under ANSI).
    A leading weekday ('Mon, ') is dropped because Spark cannot parse EEE."""
    c = F.regexp_replace(py_strip(col_(c).cast("string")), r"^[A-Za-z]{3},\s*", "")
    fmts = formats or TIMESTAMP_FORMATS
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in fmts])


def local_year(c) -> Column:
    """Year of a date text in its *own* offset, as written, not after conversion
    to UTC: of ISO texts the leading year, of mail-style dates (``Thu, 1 Jan
    2026 00:30:00 +0200``) the one after the month. NULL where the text does
    not parse."""
    s = py_strip(col_(c).cast("string"))
    iso_year = F.regexp_extract(s, r"^(\d{4})-\d{2}-\d{2}", 1)
    mail_year = F.regexp_extract(s, r"^(?:[A-Za-z]{3},\s*)?\d{1,2}\s+[A-Za-z]{3}\s+(\d{4})\b", 1)
    parsed = try_parse_timestamp(s)
    return F.when(parsed.isNull(), F.lit(None).cast("int")).when(iso_year != "", iso_year.cast("int")).when(
        mail_year != "", mail_year.cast("int")).otherwise(F.year(parsed))


def try_to_double(c) -> Column:
    """``pd.to_numeric(errors='coerce')``: unparseable becomes NULL, NaN too."""
    return clean_double(col_(c).cast("string").try_cast("double"))


def dot(a, b) -> Column:
    """Inner product of two numeric arrays of equal length (double accumulator)."""
    return F.aggregate(
        F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def l2_normalize(c) -> Column:
    """Divide a vector by its L2 norm (zero vectors are returned unchanged)."""
    v = col_(c)
    norm = F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0).cast("double"), lambda a, x: a + x))
    return F.when(norm > 0, F.transform(v, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(v, lambda x: x.cast("double")))


def safe_div(a, b) -> Column:
    """Division that yields NULL instead of raising under ANSI (0/0, x/0)."""
    return F.try_divide(col_(a), col_(b))


def ts_string(c) -> Column:
    """Timestamp rendered as 'yyyy-MM-dd HH:mm:ss' (engine-neutral output)."""
    return F.date_format(col_(c), "yyyy-MM-dd HH:mm:ss")


def instant(micros: int, kind):
    """A literal of timestamp type ``kind`` at ``micros`` since the epoch; folded
    to a constant, so a comparison with a bare column is pushed to the scan."""
    return F.timestamp_micros(F.lit(int(micros)).cast("long")).cast(kind)
