"""URL rules by a sort-merge range join.

The host of a rule, its labels reversed ("com.example."), is a prefix of the keys of all its subdomains, so it is
an interval of the sorted keys. Each task sorts its URLs by key and sweeps over them and over the sorted intervals
once; a stack holds the nested intervals that are open. Of the open rules whose path is a prefix of the URL's path,
the longest (host and path together, then host) decides.

Null URLs and URLs without "://" have an empty host and path; empty paths fit only rules without a path; equal
rules agree on the verdict "block" if any of them blocks; repeated URLs are judged each; an empty rule table gives
the default verdict; only the id and URL columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that one sweep takes; more rules take more sweeps. Bounds what is broadcast.
RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased. Path: then up to "?", "#" or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


class Interval:
    """The rules of one host: its key prefix and its paths by length."""

    def __init__(self, low: bytes) -> None:
        self.low, self.paths, self.lengths = low, {}, []

    def add(self, path: str, rule: str, verdict: str) -> None:
        if path not in self.paths or verdict == "block":
            self.paths[path] = (rule, verdict)
        self.lengths = sorted({len(p) for p in self.paths}, reverse=True)


def intervals(rules: Iterable[tuple[str, str, str, str]]) -> list[Interval]:
    """From (key, host, path, verdict), sorted by key; an interval comes before those inside it."""
    found: dict[bytes, Interval] = {}
    for key, host, path, verdict in rules:
        low = key.encode()
        found.setdefault(low, Interval(low)).add(path, host + path, verdict)
    return [found[k] for k in sorted(found)]


def sweep(keys: Iterable[tuple[bytes, str]], rules: list[Interval]) -> Iterator[tuple[str, str] | None]:
    """The deciding (rule, verdict) of each (key, path); the keys come in ascending order."""
    stack: list[Interval] = []
    at = 0
    for key, path in keys:
        while at < len(rules) and rules[at].low <= key:
            while stack and not rules[at].low.startswith(stack[-1].low):
                stack.pop()
            stack.append(rules[at])
            at += 1
        while stack and not key.startswith(stack[-1].low):
            stack.pop()
        best, size = None, (-1, -1)
        for node in stack:
            for n in node.lengths:
                if n <= len(path) and (hit := node.paths.get(path[:n])):
                    if (len(hit[0]), len(hit[0]) - n) > size:
                        best, size = hit, (len(hit[0]), len(hit[0]) - n)
                    break
        yield best


def filter_urls(urls: DataFrame, rules: DataFrame, *, default: str = "allow", id_col: str = "page_id", url_col: str = "url", max_rules: int = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row. rules has verdict (allow or block), host and path.

    URLs are sorted within their tasks only, without a shuffle, so no host's rows meet in one task.
    """
    spark = urls.sparkSession
    lower = F.translate(F.coalesce(F.col("host"), F.lit("")), UPPER, LOWER)
    clean = rules.select(host_key(lower).alias("key"), lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("verdict", F.lit("block")).alias("verdict"))
    blocks = max(1, -(-clean.count() // max_rules))
    url = F.col(url_col).cast("string")
    host, path = host_and_path(url)
    rows = urls.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    schema = "page_id long, host string, path string, rule string, verdict string"
    for block in range(blocks):
        some = clean if blocks == 1 else clean.where(F.pmod(F.xxhash64("host", "path"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([tuple(r) for r in some.toLocalIterator()])

        def step(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            nodes, held = intervals(sent.value), []

            def keys() -> Iterator[tuple[bytes, str]]:
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    held.append(batch)
                    yield from zip(batch.column("key").to_pylist(), batch.column("path").to_pylist())

            done: list = []
            for hit in sweep(keys(), nodes):
                done.append(hit)
                while held and len(done) >= len(held[0]):
                    yield _judged(held.pop(0), done)
                    done = []

        keyed = rows.withColumn("key", host_key(F.col("host")).cast("binary")).sortWithinPartitions("key")
        rows = keyed.mapInArrow(step, schema)
    return rows


def length(rule: str) -> tuple[int, int]:
    """Of the whole rule, then of its host (a host has no "/")."""
    return len(rule), len(rule.partition("/")[0])


def _judged(batch: pa.RecordBatch, found: list) -> pa.RecordBatch:
    """Where an earlier sweep has found a longer rule, that stays."""
    rules, verdicts = [], []
    for rule, verdict, hit in zip(batch.column("rule").to_pylist(), batch.column("verdict").to_pylist(), found):
        if hit and (rule is None or length(hit[0]) > length(rule)):
            rule, verdict = hit
        rules.append(rule)
        verdicts.append(verdict)
    return pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("page_id", "host", "path")), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])
