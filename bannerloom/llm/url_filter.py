"""URL filters: a trie over reversed host labels and path segments, broadcast to the tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules in a broadcast trie: at under 1 KB a rule it stays below 200 MB.
MAX_BROADCAST_RULES = 200_000


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Node:
    __slots__ = ("down", "rules", "paths")

    def __init__(self) -> None:
        self.down: dict[str, Node] = {}
        self.rules: list[tuple[str, Rule]] = []  # (start of the next segment, rule)
        self.paths: Node | None = None


class Trie:
    """Host labels from the right, then path segments; a rule ends inside a segment."""

    def __init__(self, rules: Sequence[Rule]):
        self.root = Node()
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")):
                node = node.down.setdefault(label, Node())
            node.paths = node.paths or Node()
            node = node.paths
            *whole, rest = rule.path.split("/")
            for segment in whole:
                node = node.down.setdefault(segment, Node())
            node.rules = [(r, x) for r, x in node.rules if r != rest] + [(rest, rule)]

    def longest(self, host: str, path: str) -> Rule | None:
        """The fitting rule with the longest host, then the longest path."""
        node, best = self.root, None
        segments = path.split("/")
        for label in reversed(host.split(".")):
            node = node.down.get(label)
            if node is None:
                return best
            if node.paths:
                best = self._path(node.paths, segments) or best
        return best

    @staticmethod
    def _path(node: Node | None, segments: list[str]) -> Rule | None:
        best = None
        for segment in segments:
            fits = [(len(rest), rule) for rest, rule in node.rules if segment.startswith(rest)]
            if fits:
                best = max(fits, key=lambda x: x[0])[1]
            node = node.down.get(segment)
            if node is None:
                break
        return best


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both empty for a null url or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return pages.withColumns(
        {
            "path": F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1),
            "host": F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        }
    )


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", max_broadcast: int = MAX_BROADCAST_RULES) -> DataFrame:
    """``pages`` (with a ``url``) and ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains where the path starts with the rule's. The
    longest host wins, then the longest path; of two rules with one host and path the
    later. Without a rule the verdict is ``default`` and ``rule`` is null. Null urls have
    empty host and path; columns of the input named like a result are replaced; an empty
    table gives an empty one. More rules than ``max_broadcast`` are joined, not broadcast.
    """
    rules = list({(r.host, r.path): r for r in rules}.values())
    split = split_url(pages.drop("host", "path", "rule", "verdict"))
    if len(rules) > max_broadcast:
        return judge_by_join(split, rules, default)
    trie = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def look_up(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        find = trie.value.longest
        for hosts, paths in batches:
            found = [find(h, p) for h, p in zip(hosts, paths)]
            yield pd.DataFrame({"rule": [r and r.text for r in found], "verdict": [r.verdict if r else default for r in found]})

    kept = [c for c in split.columns]
    return split.withColumn("__found", look_up("host", "path")).select(*kept, "__found.rule", "__found.verdict")


def judge_by_join(split: DataFrame, rules: Sequence[Rule], default: str) -> DataFrame:
    """The same for any number of rules: every host suffix is joined with the rules' hosts."""
    spark = split.sparkSession
    table = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "v string, h string, p string")
    urls = split.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    fits = urls.withColumn("h", F.explode(suffixes)).join(table, "h").where(F.startswith("path", "p"))
    length = F.struct(F.length("h"), F.length("p"))
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("h", "p").alias("rule"), "v"), length).alias("best"))
    return split.join(best, ["host", "path"], "left").select(
        *split.columns, F.col("best.rule").alias("rule"), F.coalesce("best.v", F.lit(default)).alias("verdict")
    )
