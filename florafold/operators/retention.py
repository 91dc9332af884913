"""Which old versions may go.

Version lists are metadata (one row per version directory), but the ranking
still uses the distributed rank, so no step gathers the list into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from florafold.operators.ranking import with_global_rank

# ---- fixed values that must equal the reference's ----------------------------
VERSION_SUFFIX_PATTERN = r"-[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{2}-[0-9]{2}$"
OLD_VERSION_SUFFIX_PATTERN = r"_[0-9]{2}_[0-9]{2}_[0-9]{2}_[0-9]{2}_[0-9]{2}"
DEFAULT_KEEP = 1                 # versions kept besides the live and protected ones
DIR_SIZE_THRESHOLD = 3000000     # bytes; smaller directories are never removed
DIR_KEEP = 4                     # large directories kept per node
# ------------------------------------------------------------------------------


def _quote(s: str) -> str:
    import re
    return re.escape(s)


def retain_versions(versions: DataFrame, alias: str, keep: int = DEFAULT_KEEP,
                    protected: list[str] | tuple[str, ...] = (), live: str | None = None,
                    name_col: str = "name") -> DataFrame:
    """Among names ``^<alias>-YYYY-MM-DD-HH-MM$`` that are neither live
    nor protected, newest first; the first ``keep`` stay, the rest are deletable.
    Output: name, rank (0-based), action ('keep' | 'delete')."""
    excluded = [x for x in list(protected) + ([live] if live else []) if x]
    cand = versions.select(F.col(name_col).alias("name")).filter(
        F.col("name").rlike("^" + _quote(alias) + VERSION_SUFFIX_PATTERN))
    if excluded:
        cand = cand.filter(~F.col("name").isin(excluded))
    ranked = with_global_rank(cand, [F.col("name").desc()], "rank")
    return ranked.select("name", "rank",
                         F.when(F.col("rank") < keep, F.lit("keep")).otherwise(F.lit("delete")).alias("action"))


def remove_all_except(versions: DataFrame, alias: str, to_keep: str, name_col: str = "name") -> DataFrame:
    """U4: old-style names ``<alias>_DD_MM_HH_MM_SS`` other than ``to_keep`` are deletable.

    ``to_keep`` must be one of the names: otherwise every version would go."""
    if versions.filter(F.col(name_col) == F.lit(to_keep)).isEmpty():
        raise ValueError(f"{to_keep!r} is not among the versions; nothing would be kept")
    v = versions.select(F.col(name_col).alias("name")).filter(F.col("name") != F.lit(to_keep))
    return (v.filter(F.col("name").rlike(_quote(alias) + OLD_VERSION_SUFFIX_PATTERN))
            .select("name", F.lit("delete").alias("action")))


def retain_by_size(dirs: DataFrame, min_size: int = DIR_SIZE_THRESHOLD, keep: int = DIR_KEEP,
                   name_col: str = "name", size_col: str = "size") -> DataFrame:
    """Among directories larger than ``min_size``, by name descending,
    those after the first ``keep`` are deletable. Output: name, size, rank, action."""
    big = dirs.select(F.col(name_col).alias("name"), F.col(size_col).alias("size")) \
        .filter(F.col("size") > min_size)
    ranked = with_global_rank(big, [F.col("name").desc()], "rank")
    return ranked.select("name", "size", "rank",
                         F.when(F.col("rank") < keep, F.lit("keep")).otherwise(F.lit("delete")).alias("action"))
