"""Join helpers: broadcast only behind a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florafold.session import ensure_checkpoint_dir, written

DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its rows take at most ``max_bytes``, else :func:`exchanged`. The size is one plain aggregate over the side table
    (vocabularies, lists, polygons), never over the big side: the length of
    each row as JSON, plus 64 bytes of overhead a row."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))) + 64)).first()[0]
    return F.broadcast(df) if (size or 0) <= max_bytes else exchanged(df)


def exchanged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that meets the other by an exchange, never through the driver.

    Spark takes the size of written tables from their compressed files, and that of exploded rows from the rows before: by
    both a side of many times the broadcast limit can look small."""
    return df.hint("merge")


def hot_keys(rows: DataFrame, key: str, hot_rows: int = 100_000) -> DataFrame | None:
    """The short list of keys with more than ``hot_rows`` rows, to be broadcast; None without any."""
    ensure_checkpoint_dir(rows.sparkSession)
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = written(counts.where(F.col("_n") > hot_rows).select(key), "hot")
    return None if hot.isEmpty() else bounded_broadcast(hot)


def split_by_key(rows: DataFrame, ids: DataFrame, key: str, hot_rows: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(rows whose ``key`` is one of ``ids``, all other rows): a semi-join and its anti-join, null keys among the others.

    Rows of a key with more than ``hot_rows`` rows meet a short list of such keys, and rows without a key meet
    nothing, so neither is exchanged and none makes a large task. ``ids`` are distinct."""
    return split_by_hot_key(rows, ids, key, hot_keys(rows, key, hot_rows))


def split_by_hot_key(rows: DataFrame, ids: DataFrame, key: str, hot: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``split_by_key`` where ``hot_keys`` are known."""
    named, nameless = rows.where(F.col(key).isNotNull()), rows.where(F.col(key).isNull())
    if hot is None:
        return named.join(ids, key, "left_semi"), named.join(ids, key, "left_anti").unionByName(nameless)
    known = F.broadcast(written(ids.join(hot, key, "left_semi"), "known"))
    often, rare = named.join(hot, key, "left_semi"), named.join(hot, key, "left_anti")
    placed = often.join(known, key, "left_semi").unionByName(rare.join(ids, key, "left_semi"))
    others = often.join(known, key, "left_anti").unionByName(rare.join(ids, key, "left_anti"))
    return placed, others.unionByName(nameless)
