"""Scalar column functions (F1-F11). All are built-in expressions, so they stay
inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values that must equal the reference's ----------------------------
# truthy words for text flags (trimmed, lower-cased)
TRUE_WORDS = ["y", "yes", "t", "true", "on", "1"]
# path parts that mark a multimedia file
MULTIMEDIA_PARTS = ["multimedia", "image", "images", "sounds"]
# version name timestamp layout: <alias>-YYYY-MM-DD-HH-MM
VERSION_TS_FORMAT = "yyyy-MM-dd-HH-mm"
VERSION_DATE_PATTERN = r".*-(\d{4}-\d{2}-\d{2})-.*"
# ------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_flag(c) -> Column:
    """text flag → boolean; null text is false."""
    return F.coalesce(F.lower(F.trim(_c(c))).isin(TRUE_WORDS), F.lit(False))


def media_type(path) -> Column:
    """'multimedia' when the path contains any multimedia part, else 'occurrence'."""
    p = _c(path)
    hit = None
    for part in MULTIMEDIA_PARTS:
        cond = p.contains(part)
        hit = cond if hit is None else (hit | cond)
    return F.when(hit, F.lit("multimedia")).otherwise(F.lit("occurrence"))


def file_name(path, strict: bool = True) -> Column:
    """last path segment; an empty segment is an error (strict) or null."""
    name = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    if not strict:
        return F.nullif(name, F.lit(""))
    return F.when(name == "", F.raise_error(F.concat(F.lit("Error not valid file path: "), _c(path)))
                  ).otherwise(name)


def version_name(alias, ts) -> Column:
    """'<alias>-YYYY-MM-DD-HH-MM'."""
    a = F.lit(alias) if isinstance(alias, str) else alias
    return F.concat(a, F.lit("-"), F.date_format(_c(ts), VERSION_TS_FORMAT))


def version_date(name) -> Column:
    """the date part of a version name (null when absent)."""
    return F.nullif(F.regexp_extract(_c(name), VERSION_DATE_PATTERN, 1), F.lit(""))


def is_null_id(c) -> Column:
    """null, or the text 'null' in any case."""
    x = _c(c)
    return x.isNull() | (F.lower(x) == "null")


def id_kind(c, strict: bool = True) -> Column:
    """'dr' for a dataset uid, 'dp' for a provider uid, else an error (or null)."""
    x = _c(c)
    other = (F.raise_error(F.concat(F.lit("Not a valid dataset or data provider uid: "), x))
             if strict else F.lit(None).cast("string"))
    return (F.when(x.startswith("dr"), F.lit("dr"))
            .when(x.startswith("dp"), F.lit("dp"))
            .otherwise(other))


def licence(rights, license_type) -> Column:
    """first non-empty of rights and licence type, else ''."""
    return F.coalesce(F.nullif(_c(rights), F.lit("")), F.nullif(_c(license_type), F.lit("")), F.lit(""))


def days_between(lo, hi) -> Column:
    """inclusive list of days from lo to hi (empty when lo > hi)."""
    lo_d, hi_d = _c(lo).cast("date"), _c(hi).cast("date")
    return F.when(lo_d <= hi_d, F.sequence(lo_d, hi_d, F.expr("interval 1 day"))
                  ).otherwise(F.array().cast("array<date>"))


def folder(key) -> Column:
    """parent folder segment of an object key ('a/dr1/x.zip' → 'dr1')."""
    return F.regexp_extract(_c(key), r"([^/]*)/[^/]*$", 1)


def split_uri(uri) -> Column:
    """'s3://bucket/some/path' → struct(bucket, path)."""
    u = _c(uri)
    return F.struct(
        F.regexp_extract(u, r"^[a-zA-Z0-9+.-]+://([^/]*)", 1).alias("bucket"),
        F.regexp_extract(u, r"^[a-zA-Z0-9+.-]+://[^/]*/?(.*)$", 1).alias("path"),
    )


def id_list(text) -> Column:
    """whitespace separated ids → array, blanks dropped (explode it for rows)."""
    parts = F.split(F.trim(_c(text)), r"\s+")
    return F.array_remove(parts, "")
