"""URL rules by a sort-merge range join on reversed hosts.

`www.example.org` becomes `org/example/www/` (no host holds a slash). A rule's host and all its subdomains then form one
interval of keys, and two such intervals are nested or disjoint. URLs are dealt out and sorted by
key; a sweep passes through URLs and rule intervals in one order and keeps the stack of intervals
that are open. The paths of a host's rules are prefixes in order, each with the longest one that starts
it: a search for the URL's path and a climb from there finds the longest that starts it, however many
rules a host has. Of the open hosts' rules found so the longest decides, by the characters of host and
path together; between equal rules with different verdicts, block.

A host's rows are split by the rest of the key and by row, so one host may hold any share of them.

Defined cases: a null URL or one without `://` has empty host and path and, like every URL that no
rule fits, gets the default verdict and a null rule. A rule with a null host or path is ignored; a
rule with an empty host fits every URL that has a host. Repeated rows are judged alike, very long URLs
whole; without rules every URL gets the default; an empty table of URLs gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.store import Store

Rule = tuple[str, str, str]  # verdict, host, path
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case. Path: from
    there up to `?`, `#` or the end."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each ended by a slash; the empty host stays empty."""
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "/"), F.lit("/"))
    return F.when(F.length(host) > 0, key).otherwise("")


def _key_of(host: str) -> str:
    return "".join(f"{label}/" for label in reversed(host.split("."))) if host else ""


class Paths:
    """The rules of one host, by path."""

    def __init__(self, rules: Sequence[Rule]):
        chosen: dict[str, Rule] = {}
        for rule in rules:  # between equal paths, block
            if rule[2] not in chosen or rule[0] == "block":
                chosen[rule[2]] = rule
        self.paths = sorted(chosen)
        self.rules = [chosen[path] for path in self.paths]
        # Of each path the longest other one that starts it; in order, those that do are on a stack.
        self.above: list[int] = []
        open_: list[int] = []
        for i, path in enumerate(self.paths):
            while open_ and not path.startswith(self.paths[open_[-1]]):
                open_.pop()
            self.above.append(open_[-1] if open_ else -1)
            open_.append(i)

    def longest(self, path: str) -> Rule | None:
        """The rule with the longest path that starts this one. The last path that isn't greater
        either starts it, or shares with it all paths that do."""
        i = bisect_right(self.paths, path) - 1
        while i >= 0 and not path.startswith(self.paths[i]):
            i = self.above[i]
        return self.rules[i] if i >= 0 else None


def sweep(rules: Sequence[Rule], urls: Iterator[tuple[str, str]]) -> Iterator[Rule | None]:
    """The deciding rule of each (key, path); keys must come in byte order."""
    grouped: dict[bytes, list[Rule]] = {}
    for rule in rules:
        grouped.setdefault(_key_of(rule[1]).encode(), []).append(rule)
    by_key = {key: Paths(own) for key, own in grouped.items()}
    starts = sorted(by_key)
    position, open_ = 0, []
    for key, path in urls:
        encoded = key.encode()
        if not encoded:
            yield None
            continue
        while position < len(starts) and starts[position] <= encoded:
            while open_ and not starts[position].startswith(open_[-1]):
                open_.pop()
            open_.append(starts[position])
            position += 1
        while open_ and not encoded.startswith(open_[-1]):
            open_.pop()
        best, best_rank = None, (-1, False)
        for start in open_:
            rule = by_key[start].longest(path)
            if rule is not None:
                rank = (len(rule[1]) + len(rule[2]), rule[0] == "block")
                if rank > best_rank:
                    best, best_rank = rule, rank
        yield best


def _swept(rules):
    """Takes the sorted rows of a partition; a later block of rules only wins by rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def urls():
            for batch in batches:
                kept.append(batch)
                yield from zip(batch["key"].to_pylist(), batch["path"].to_pylist())

        # The sweep's state runs on from batch to batch; results leave with their batch.
        found = sweep(rules.value, urls())
        out: list[Rule | None] = []
        for rule in found:
            out.append(rule)
            while kept and len(out) >= len(kept[0]):
                batch = kept.pop(0)
                yield _judged(batch, out[: len(batch)])
                out = out[len(batch):]

    return run


def _judged(batch: pa.RecordBatch, rules: list[Rule | None]) -> pa.RecordBatch:
    names, verdicts, ranks = [], [], []
    before = zip(*(batch[c].to_pylist() for c in ("rule", "verdict", "rank")))
    for rule, (name, verdict, rank) in zip(rules, before):
        if rule is not None:
            new = 2 * (len(rule[1]) + len(rule[2])) + (rule[0] == "block")
            if new > rank:
                name, verdict, rank = rule[1] + rule[2], rule[0], new
        names.append(name)
        verdicts.append(verdict)
        ranks.append(rank)
    return pa.RecordBatch.from_arrays(
        [batch[c] for c in batch.schema.names[:-3]]
        + [pa.array(names, pa.string()), pa.array(verdicts, pa.string()),
           pa.array(ranks, pa.int64())],
        names=batch.schema.names,
    )


def _blocks(rules: DataFrame, most_bytes: int) -> Iterator[list[Rule]]:
    """The rules, at most about `most_bytes` at a time."""
    rules = rules.select("verdict", "host", "path").dropna(subset=["host", "path"]).distinct()
    size = rules.agg(
        F.sum(F.octet_length("host") + F.octet_length("path") + F.lit(200))
    ).first()[0] or 0
    blocks = max(1, -(-int(size) // most_bytes))
    part = F.pmod(F.xxhash64("host", "path", "verdict"), F.lit(blocks))
    for block in range(blocks):
        yield [tuple(r) for r in rules.filter(part == block).collect()]


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
          most_bytes: int = 32 << 20) -> DataFrame:
    """Adds host, path, rule and verdict to every row, in place of columns of these names.

    Rules beyond `most_bytes` are taken block by block: each block is broadcast, its sweep keeps
    the better of its own rule and the one found so far. Pass few columns; rows are shuffled once.
    """
    spark = urls.sparkSession
    host, path = host_and_path(F.col(url))
    columns = urls.columns
    rows = urls.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        host.alias("host"), path.alias("path"),
        F.monotonically_increasing_id().alias("at"),
    ).withColumn("key", reversed_host(F.col("host")))
    # By range, so that the sweep meets few rules per partition; path and row split a hot host.
    # The count is left to the session; adaptive execution then merges what is small.
    rows = rows.repartitionByRange("key", "path", "at").sortWithinPartitions("key")
    rows = rows.select(
        "row", "host", "path", "key",
        F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"),
        F.lit(-1).cast("long").alias("rank"),
    )
    store, blocks = None, _blocks(rules, most_bytes)
    for number, block in enumerate(blocks):
        if number:  # one sweep's memory at a time
            store = store or Store(spark, "rules")
            rows = store.hold(rows, f"pass-{number}").sortWithinPartitions("key")
            store.drop(f"pass-{number - 1}")  # a copy of all rows; this pass has read it
        rows = rows.mapInArrow(_swept(spark.sparkContext.broadcast(block)), rows.schema)
    own = ["host", "path", "rule", "verdict"]
    return rows.select(*[F.col(f"row.`{c}`") for c in columns if c not in own], *own)
