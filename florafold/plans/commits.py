"""Publishing that survives a crash and two publishers.

Under a root folder:

* ``data/<version>-<token>``: the data of a version, written once and never overwritten;
* ``commits/<alias>/<number>.json``: one small file per commit, numbered without gaps.
  Creating the next number fails if it exists, so of two publishers that start
  from the same state one wins and the other raises :class:`PublishConflict`.

A reader takes the highest commit that can be read and the folder it names: the old
version until the commit file is whole, the new one after it. A crash before that
leaves an unnamed data folder, or an empty commit file, which keeps its number and counts for
nothing; :func:`abandoned` lists such folders. A roll-back is one more commit, and old versions are only
marked (W5) and deleted after a switch, never the live one.

The store must create a file without overwriting in one step (HDFS does; object stores
do through their committers or conditional writes).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from florafold.operators import retention as RT

COMMIT_SCHEMA = "number bigint, alias string, version string, action string, path string, at string"


class PublishConflict(RuntimeError):
    """Another publisher committed first."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _log(root: str, alias: str) -> str:
    return f"{root.rstrip('/')}/commits/{alias}"


def last_number(spark: SparkSession, root: str, alias: str) -> int:
    """Highest commit number, whole or not; 0 for none. One name per commit is read."""
    fs, p = _fs(spark, _log(root, alias))
    if not fs.exists(p):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def history(spark: SparkSession, root: str, alias: str) -> DataFrame:
    """number, alias, version, action ('publish' | 'roll back'), path and at of each whole commit."""
    if not last_number(spark, root, alias):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    rows = spark.read.schema(COMMIT_SCHEMA).option("pathGlobFilter", "*.json").json(_log(root, alias))
    return rows.where("number is not null and path is not null and at is not null")


def current(spark: SparkSession, root: str, alias: str) -> dict | None:
    """The commit readers follow (one row), None before the first."""
    row = history(spark, root, alias).orderBy(F.col("number").desc()).first()
    return row.asDict() if row else None


def read_current(spark: SparkSession, root: str, alias: str) -> DataFrame:
    row = current(spark, root, alias)
    if row is None:
        raise ValueError(f"{alias!r} has no version yet")
    return spark.read.parquet(row["path"])


def _commit(spark: SparkSession, root: str, alias: str, base: int, version: str, action: str, path: str) -> dict:
    row = {"number": base + 1, "alias": alias, "version": version, "action": action, "path": path,
           "at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
    fs, p = _fs(spark, f"{_log(root, alias)}/{base + 1:020d}.json")
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)  # fails if the number is taken
    except Exception as e:
        if fs.exists(p):
            raise PublishConflict(f"commit {base + 1} of {alias!r} was made by another publisher") from e
        raise
    out.write(bytearray(json.dumps(row).encode() + b"\n"))
    out.close()
    return row


def stage(df: DataFrame, root: str, version: str) -> str:
    """Write the data of a version into a folder of its own; no reader sees it before a commit names it."""
    path = f"{root.rstrip('/')}/data/{version}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(path)
    return path


def publish(df: DataFrame, root: str, alias: str, version: str, base: int | None = None, staged: str | None = None) -> dict:
    """Write ``df`` as a new version (unless it is ``staged`` already) and commit it. Returns the commit.

    ``base`` is the commit number the decision was taken on (now, if not given). A version name that was
    committed before is refused before anything is written; a conflict leaves the data folder unnamed."""
    spark = df.sparkSession
    base = last_number(spark, root, alias) if base is None else base
    if not history(spark, root, alias).where((F.col("version") == version) & (F.col("action") == "publish")).isEmpty():
        raise ValueError(f"version {version!r} of {alias!r} exists")
    return _commit(spark, root, alias, base, version, "publish", staged or stage(df, root, version))


def roll_back(spark: SparkSession, root: str, alias: str, version: str) -> dict:
    """Make an earlier version current again; its data must still be there."""
    base = last_number(spark, root, alias)
    row = history(spark, root, alias).where(F.col("version") == version).orderBy(F.col("number").desc()).first()
    if row is None:
        raise ValueError(f"{alias!r} never had version {version!r}")
    fs, p = _fs(spark, row["path"])
    if not fs.exists(p):
        raise ValueError(f"the data of {version!r} has been deleted")
    return _commit(spark, root, alias, base, version, "roll back", row["path"])


def stale_versions(spark: SparkSession, root: str, alias: str, keep: int = RT.DEFAULT_KEEP, protected: tuple[str, ...] = ()) -> DataFrame:
    """W5 over the committed versions whose data is there: name, rank, action; the live one is not listed."""
    live = current(spark, root, alias)
    versions = history(spark, root, alias).select(F.col("version").alias("name")).distinct()
    there = _folders(spark, root)
    paths = history(spark, root, alias).select(F.col("version").alias("name"), F.substring_index("path", "/", -1).alias("folder"))
    versions = versions.join(paths.join(there, "folder", "left_semi"), "name", "left_semi")
    return RT.retain_versions(versions, alias, keep, protected, live["version"] if live else None)


def _folders(spark: SparkSession, root: str) -> DataFrame:
    fs, p = _fs(spark, f"{root.rstrip('/')}/data")
    names = [(s.getPath().getName(),) for s in fs.listStatus(p)] if fs.exists(p) else []
    return spark.createDataFrame(names, "folder string")


def delete_stale(spark: SparkSession, root: str, alias: str, keep: int = RT.DEFAULT_KEEP, protected: tuple[str, ...] = ()) -> list[str]:
    """Delete the data of the versions W5 marks; returns their names. Commits stay."""
    marked = {r["name"] for r in stale_versions(spark, root, alias, keep, protected).where("action = 'delete'").collect()}
    live = current(spark, root, alias)
    for row in history(spark, root, alias).collect():
        if row["version"] in marked and row["path"] != live["path"]:
            fs, p = _fs(spark, row["path"])
            fs.delete(p, True)
    return sorted(marked)


def abandoned(spark: SparkSession, root: str, aliases: list[str]) -> DataFrame:
    """Data folders that no commit of these aliases names (crashed or beaten publishers)."""
    named = [history(spark, root, a).select(F.substring_index("path", "/", -1).alias("folder")) for a in aliases]
    out = _folders(spark, root)
    for n in named:
        out = out.join(n, "folder", "left_anti")
    return out
