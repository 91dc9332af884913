"""How text filters interact: what each removes, in every order of applying them.

Five filters fail a text (null counts as empty; words are the maximal runs
without the characters 0x20 and 0x09-0x0D, compared as they are):

* A: fewer than 50 words
* B: 100 * distinct words < 65 * words
* C: 100 * characters A-Z > 5 * code points
* D: a character of ``#$%&*|``
* E: a row with a smaller id has the same text

E is an existential self-join: rows whose text hash another row shares meet the
least id of each (hash, text) by a left semi-join on hash, exact text and smaller
id. The least ids are combined for each (hash, salt) first and sent to the
salts that occur, so that a text with a third of all rows is dealt over all
partitions. The ids that E marks are united with the rows' other failure bits and
aggregated to one combination of five bits for each row; what remains is a table
of at most 32 combinations for each part, from which every order and step is
counted. Only built-in functions are used.

Edge cases: null and empty texts equal each other, pass B, C and D and fail A.
A null id is neither smaller nor larger than another: such rows pass E and
mark none. Rows that repeat an id are counted each; they do not fail E by each
other, but do by a smaller id. A part is a value of the part column, null and
the empty string being one. A document's label is 1 if any of its label rows says
so. An empty table gives no rows. Very long texts are handled whole. Other
columns of the input are not read, whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import scratch_dir
from .hot import group_facts, per_salt, salt

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failure_bits(text: Column) -> Column:
    """Bits of A to D for a text that is not null."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    bit = lambda f, fails: F.when(fails, BIT[f]).otherwise(0)
    return (bit("A", n < 50) + bit("B", F.size(F.array_distinct(words)) * 100 < n * 65)
            + bit("C", upper.cast("long") * 100 > F.length(text).cast("long") * 5) + bit("D", text.rlike(r"[#$%&*|]")))


def repeated_later(docs: DataFrame) -> DataFrame:
    """Rows of (_id, _text, _hash, _salt, ...) of whose text a row with a smaller id has a copy; without the text."""
    narrow = docs.where("_id is not null").select("_id", "_hash", "_salt")
    shared = per_salt(group_facts(narrow, ["_hash"], "_id").where("group_size > 1")).select("_hash", "_salt").checkpoint()
    path = scratch_dir(docs.sparkSession, "copies")
    docs.where("_id is not null").join(shared, ["_hash", "_salt"], "left_semi").write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    least = per_salt(group_facts(rows, ["_hash", "_text"], "_id")).alias("least")
    row = rows.alias("row")
    same = [F.col(f"row.{c}") == F.col(f"least.{c}") for c in ("_hash", "_salt", "_text")]
    return row.join(least, [*same, F.col("least.least_id") < F.col("row._id")], "left_semi").drop("_text")


def failure_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(_id, part, bits, rows): the failure bits of each row; rows equal in all counted are one with their number."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("_text"))
    docs = salt(docs.withColumn("_hash", F.xxhash64("_text")), "_id")
    key = ["_id", "_hash", "part"]
    rows = docs.select(*key, failure_bits(F.col("_text")).alias("bits"), F.lit(1).alias("rows"))
    marked = repeated_later(docs).select(*key, F.lit(BIT["E"]).alias("bits"), F.lit(0).alias("rows"))
    return (rows.unionByName(marked).groupBy(*key).agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"))
            .drop("_hash"))


def _steps(spark) -> DataFrame:
    """filter_order, step, the filter's bit and the bits of those before it: 600 fixed rows."""
    rows = [("".join(o), k + 1, BIT[o[k]], sum(BIT[f] for f in o[:k])) for o in permutations(FILTERS) for k in range(len(o))]
    return spark.createDataFrame(rows, "filter_order string, step int, bit int, before int")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source", part_name: str = "part") -> DataFrame:
    """part, filter_order, step and the counts (docstring above) for each part, order and step.

    ``labels`` has the id column, quality and toxic (0 or 1, nulls count as 0).
    """
    good, toxic = (F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c) for c in ("quality", "toxic"))
    labels = labels.groupBy(F.col(id_col).alias("_id")).agg(good, toxic)
    cells = (failure_sets(docs, id_col, text_col, part_col).join(labels, "_id", "left").groupBy("part", "bits")
             .agg(F.sum("rows").alias("n"), F.sum(F.col("rows") * F.coalesce("quality", F.lit(0))).alias("good"),
                  F.sum(F.col("rows") * F.coalesce("toxic", F.lit(0))).alias("toxic")))
    pairs = F.array(*[F.struct(F.lit(BIT[f]).alias("bit"), F.lit(b).alias("before"))
                      for f in FILTERS for b in range(1 << len(FILTERS)) if not b & BIT[f]])
    each = cells.select("*", F.explode(pairs).alias("p")).select("part", "bits", "n", "good", "toxic", "p.*")
    fails, earlier = F.col("bits").bitwiseAND(F.col("bit")) > 0, F.col("bits").bitwiseAND(F.col("before")) > 0
    count = lambda of, when: F.sum(F.when(when, F.col(of)).otherwise(0))
    counted = each.groupBy("part", "bit", "before").agg(
        count("n", ~fails & ~earlier).alias("kept"), count("n", fails & ~earlier).alias("removed"),
        count("n", fails & earlier).alias("redundant"), count("n", F.col("bits") == F.col("bit")).alias("unique_fails"),
        count("good", fails & ~earlier).alias("good_lost"), count("toxic", fails & ~earlier).alias("toxic_lost"))
    # orders in which just these filters stand before: (their number)! * (the number after)!
    orders = F.element_at(F.array(*[F.lit(factorial(b) * factorial(len(FILTERS) - 1 - b)) for b in range(len(FILTERS))]),
                          F.bit_count("before") + 1)
    counted = counted.withColumn("shapley", F.sum(F.col("removed") * orders).over(Window.partitionBy("part", "bit")))
    # 600 rows, whatever the data
    out = counted.join(F.broadcast(_steps(docs.sparkSession)), ["bit", "before"])
    return out.select(F.col("part").alias(part_name), "filter_order", "step", *COUNTS)
