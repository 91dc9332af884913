"""Exact duplicates by progressive refinement.

Rows are grouped by the length of their normalised text, refined by a hash of
its first characters, and only the rows whose (length, prefix hash) another row
shares have their whole text hashed (SHA-256). Equal SHA-256 counts as equal text.

Narrow facts (row id, length, prefix hash, what the caller carries) are written
once. Keys that several rows share are also set as bits of a bitmap of at most 16 MB, so
that texts of rows whose bit is not set are neither hashed nor moved; the
others meet the exact list of shared rows, and the hashes of survivors are
written before they are grouped. Counts are combined before each shuffle, and facts go back to the
rows of a group by (key, salt), with one fact row for each salt that occurs, so
that a group with a third of all rows is dealt over all partitions.

Normalised text: null becomes empty, and each run of the ASCII white space
characters 0x20 and 0x09-0x0D becomes one space.

Edge cases: empty and null texts are equal to each other. The kept row is the
one with the smallest id; a null id counts as larger than any other. Rows that
repeat an id are told apart only by their text: equal ones count each in
``group_size`` and share one verdict, and ``drop_duplicates`` keeps one of them.
An empty table gives an empty result. Columns named like an output column are
replaced. Very long texts are handled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir
from .hot import group_facts, per_salt, salt

OUTPUT = ("keep_id", "group_size", "kept")
BITS = 1 << 27
LEVEL = ["_length", "_head"]


def normalised(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # a text whose white space is single spaces is its own normalised form: finding that out is cheaper than replacing
    return F.when(text.rlike(r"[\x09-\x0D]|\x20\x20"), F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")).otherwise(text)


class _Bitmap:
    """Bits of the shared keys: a row whose bit is not set shares its key with no other."""

    def __init__(self, keys: DataFrame):
        self.size = min(BITS, 1 << max(15, (16 * keys.count()).bit_length()))
        at = self._place()
        self.bits = keys.groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits")).checkpoint()

    def _place(self) -> Column:
        return F.pmod(F.xxhash64(*LEVEL), F.lit(self.size)) + 1

    def split(self, rows: DataFrame, shared: bool) -> DataFrame:
        """Rows whose bit is set, or those whose bit is not."""
        pos = F.bitmap_bit_position(self._place()).cast("int")
        byte = F.conv(F.hex(F.substring("_bits", F.floor(pos / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        there = F.coalesce(F.getbit(byte, pos % 8) == 1, F.lit(False))
        # BITS / 32768 rows of 4 KB at most
        rows = rows.withColumn("_bucket", F.bitmap_bucket_number(self._place())).join(F.broadcast(self.bits), "_bucket", "left")
        return rows.where(there if shared else ~there).drop("_bucket", "_bits")


def _groups(rows: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Size and smallest id of each group of two rows or more, one row for each salt of its rows."""
    return per_salt(group_facts(rows, keys, id_col).where("group_size > 1")).withColumnRenamed("least_id", "keep_id")


def _levelled(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> DataFrame:
    norm = normalised(F.col(text_col))
    docs = docs.select("*", F.length(norm).alias("_length"), F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("_head"))
    return salt(docs, id_col)


def _refined(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int) -> tuple[DataFrame, DataFrame, _Bitmap]:
    """Rows alone in their length and prefix hash; the others with _full, keep_id and group_size, both
    without texts; and the bitmap of shared keys."""
    ensure_checkpoint_dir(docs.sparkSession)
    docs = _levelled(docs, id_col, text_col, prefix_chars)
    narrow = docs.drop(text_col).checkpoint()
    shared = _groups(narrow, LEVEL, id_col).select(*LEVEL, "_salt").checkpoint()
    alone = narrow.join(shared, [*LEVEL, "_salt"], "left_anti")
    bitmap = _Bitmap(shared.select(*LEVEL).distinct())
    # the second read of the texts; of the rows that share a key alone the text is moved and hashed
    whole = (bitmap.split(docs, True).join(shared, [*LEVEL, "_salt"], "left_semi")
             .withColumn("_full", F.unhex(F.sha2(normalised(F.col(text_col)), 256))).drop(text_col).checkpoint())
    groups = _groups(whole, ["_full"], id_col)
    return alone, whole.join(groups, ["_full", "_salt"], "left"), bitmap


def _keep(id_col: str) -> Column:
    return F.when(F.coalesce("group_size", F.lit(1)) > 1, F.col("keep_id")).otherwise(F.col(id_col))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = 256, hash_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` but the text, with keep_id, group_size and kept.

    ``hash_col`` adds the hexadecimal SHA-256 of every normalised text. Rows that the refinement did not
    hash get theirs in a pass of its own, by length and prefix hash, which they alone have."""
    docs = docs.drop(*OUTPUT, *([hash_col] if hash_col else []))
    alone, whole, _ = _refined(docs, id_col, text_col, prefix_chars)
    if hash_col:
        own = _levelled(docs.select(id_col, text_col), id_col, text_col, prefix_chars).select(
            *LEVEL, F.sha2(normalised(F.col(text_col)), 256).alias(hash_col))
        alone = alone.join(own, LEVEL)
        whole = whole.withColumn(hash_col, F.lower(F.hex("_full")))
    rows = alone.select("*", F.lit(None).cast(docs.schema[id_col].dataType).alias("keep_id"),
                        F.lit(1).cast("long").alias("group_size")).unionByName(whole.drop("_full"))
    keep = _keep(id_col)
    return rows.select(*[c for c in alone.columns if not c.startswith("_")], keep.alias("keep_id"),
                       F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                       keep.eqNullSafe(F.col(id_col)).alias("kept"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    prefix_chars: int = 256) -> DataFrame:
    """``docs`` without the rows that are not kept; rows equal in id and text leave one.

    Verdicts go back to rows by id, length and prefix hash, and by the whole
    text's hash where these agree, so an id that names several texts, or a null
    id, loses none of them.
    """
    _, whole, bitmap = _refined(docs.select(id_col, text_col), id_col, text_col, prefix_chars)
    verdicts = (whole.select(F.col(id_col).alias("_i"), F.col("_length").alias("_l"), F.col("_head").alias("_h"),
                             F.col("_full").alias("_f"), _keep(id_col).eqNullSafe(F.col(id_col)).alias("_kept"))
                .groupBy("_i", "_l", "_h", "_f").agg(F.max("_kept").alias("_kept"), F.count(F.lit(1)).alias("_rows"))
                .where("not _kept or _rows > 1").checkpoint())
    norm = normalised(F.col(text_col))
    # a residual condition, not a join key: whole texts are hashed only where the narrow keys agree
    same = (F.col(id_col).eqNullSafe(F.col("_i")) & (F.length(norm) == F.col("_l"))
            & (F.xxhash64(F.substring(norm, 1, prefix_chars)) == F.col("_h"))
            & F.when(F.col("_f").isNotNull(), F.unhex(F.sha2(norm, 256)) == F.col("_f")))
    marked = _levelled(docs, id_col, text_col, prefix_chars)
    alone = bitmap.split(marked, False).select(docs.columns)
    out = bitmap.split(marked, True).select(docs.columns).join(verdicts.where("not _kept"), same, "left_anti")
    repeated = verdicts.where("_kept and _rows > 1")
    if repeated.isEmpty():
        return alone.unionByName(out)
    one = (out.join(repeated, same, "left_semi").withColumn("_f", F.sha2(norm, 256))
           .dropDuplicates([id_col, "_f"]).drop("_f"))
    return alone.unionByName(out.join(repeated, same, "left_anti")).unionByName(one)
