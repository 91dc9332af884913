"""URL filters: a sorted sweep of canonical URL keys over nested rules.

The canonical key of a host is its labels in reverse, each with a dot after it
(``blog.example.net`` is ``net.example.blog.``), so that a host and all its
subdomains are one interval of the sorted keys. Each task sorts the keys of its
own rows and merges them with the sorted rules; a stack holds the rules whose
intervals are open. Among the open rules whose path the URL's path starts with,
the longest rule string wins (on a tie of length the deeper host).

There is no exchange: rows stay where they were read. The rules go to the tasks
in blocks of at most ``block_rules`` rows; more blocks mean more sweeps over the
narrow rows, never a larger broadcast.

Edge cases: a null URL, or one without ``://``, has an empty host and path and
fits no rule, so it gets ``default``. Repeated rows are judged alike. Rules with
a null host, path or verdict are ignored; of rules for the same host and path
the smallest verdict string counts. Other columns pass through unchanged;
input columns named like an output column are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_AFTER = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _AFTER, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _AFTER, 2), F.lit(""))


def host_key(host: str) -> str:
    return "".join(x + "." for x in reversed(host.split("."))) if host else ""


class RuleSweep:
    """Merges sorted host keys with sorted rules, keeping the open rules on a stack."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        nodes: dict[str, list[tuple[str, str, str]]] = {}
        for host, path, verdict in rules:
            nodes.setdefault(host_key(host), []).append((path, host + path, verdict))
        self.keys = sorted(nodes)
        self.paths = []
        for key in self.keys:
            by_size: dict[int, dict[str, tuple[str, str]]] = {}
            for path, text, verdict in sorted(nodes[key], reverse=True):
                by_size.setdefault(len(path), {})[path] = (text, verdict)
            self.paths.append(sorted(by_size.items(), reverse=True))

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        keys = [host_key(h) for h in hosts]
        out: list[tuple[str, str] | None] = [None] * len(keys)
        stack: list[int] = []
        at = 0
        for i in sorted(range(len(keys)), key=keys.__getitem__):
            key = keys[i]
            while at < len(self.keys) and self.keys[at] <= key:
                self._open(stack, at)
                at += 1
            while stack and not key.startswith(self.keys[stack[-1]]):
                stack.pop()
            for node in reversed(stack):
                for size, by_path in self.paths[node]:
                    hit = by_path.get(paths[i][:size]) if len(paths[i]) >= size else None
                    if hit and (out[i] is None or len(hit[0]) > len(out[i][0])):
                        out[i] = hit
                        break
        return out

    def _open(self, stack: list[int], at: int) -> None:
        while stack and not self.keys[at].startswith(self.keys[stack[-1]]):
            stack.pop()
        stack.append(at)


def _rule_blocks(rules: DataFrame, block_rules: int):
    """The rules in blocks of at most about ``block_rules``, dealt by host so that each is small."""
    rules = (rules.where("host is not null and path is not null and verdict is not null")
             .groupBy("host", "path").agg(F.min("verdict").alias("verdict")))
    n = -(-rules.count() // block_rules)
    for k in range(max(1, n)):
        part = rules if n <= 1 else rules.where(F.pmod(F.xxhash64("host", "path"), F.lit(n)) == k)
        yield [(r.host, r.path, r.verdict) for r in part.collect()]


def judge_urls(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               block_rules: int = 200_000) -> DataFrame:
    """``urls`` with columns host, path, rule (null if none fits) and verdict.

    ``rules`` has columns host, path and verdict.
    """
    out = urls.drop("host", "path", "rule", "verdict")
    out = out.select("*", host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    out = out.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    for block in _rule_blocks(rules, block_rules):
        if block:
            out = _sweep(out, block)
    return out


def _sweep(rows: DataFrame, block: list[tuple[str, str, str]]) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    shared = rows.sparkSession.sparkContext.broadcast(block)

    def sweep(batches):
        rules = RuleSweep(shared.value)
        for batch in batches:
            got = rules.judge(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            rule, verdict = batch.column("rule").to_pylist(), batch.column("verdict").to_pylist()
            for i, hit in enumerate(got):
                if hit and (rule[i] is None or len(hit[0]) > len(rule[i])):
                    rule[i], verdict[i] = hit
            batch = batch.set_column(batch.schema.get_field_index("rule"), "rule", pa.array(rule, pa.string()))
            yield batch.set_column(batch.schema.get_field_index("verdict"), "verdict", pa.array(verdict, pa.string()))

    return rows.mapInArrow(sweep, schema)
