"""URL filters: a trie over reversed host labels, with a trie over path segments at each host."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.llm.common import map_slices

#: A list of rules is sent to every executor, so its size is checked; longer lists belong in several calls.
MAX_RULE_CHARS = 64 << 20

SCHEMA = "page_id long, host string, path string, rule string, verdict string"

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains, where the path begins with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class PathNode:
    children: dict[str, PathNode] = field(default_factory=dict)
    ends: list[tuple[str, Rule]] = field(default_factory=list)  # what the next segment has to begin with


@dataclass
class HostNode:
    children: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode = field(default_factory=PathNode)
    bare: Rule | None = None  # a rule with no path at all


def stricter(a: Rule | None, b: Rule) -> Rule:
    """The longer rule; of equal ones the blocking one."""
    if a is None:
        return b
    return max(a, b, key=lambda r: (len(r.name), r.verdict == "block"))


def build_trie(rules: Iterable[Rule]) -> HostNode:
    rules = list(rules)
    if sum(len(r.name) for r in rules) > MAX_RULE_CHARS:
        raise ValueError("too many rules for one trie; judge the pages by parts of the list and keep the longest")
    root = HostNode()
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.children.setdefault(label, HostNode())
        if not rule.path:
            node.bare = stricter(node.bare, rule)
            continue
        if not rule.path.startswith("/"):
            raise ValueError(f"the path of rule {rule.name!r} has to begin with '/'")
        *whole, last = rule.path[1:].split("/")
        at = node.paths
        for segment in whole:
            at = at.children.setdefault(segment, PathNode())
        at.ends.append((last, rule))
    return root


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path: after the first ``://`` up to ``/``, ``?`` or ``#``; then up to ``?`` or ``#``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    for stop in "#?":
        rest = rest.partition(stop)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def longest_rule(root: HostNode, host: str, path: str) -> Rule | None:
    """The longest rule that fits, found by one walk down the labels and one down the segments at each."""
    best, node = None, root
    segments = path[1:].split("/") if path.startswith("/") else []
    for label in reversed(host.split(".")):
        node = node.children.get(label)
        if node is None:
            break
        if node.bare:
            best = stricter(best, node.bare)
        at = node.paths
        for segment in segments:
            for start, rule in at.ends:
                if segment.startswith(start):
                    best = stricter(best, rule)
            at = at.children.get(segment)
            if at is None:
                break
    return best


def judge_urls(
    pages: DataFrame, rules: Iterable[Rule], default: str = "allow", page_id: str = "page_id", url: str = "url",
) -> DataFrame:
    """One row per page: host, path, the longest rule that fits and its verdict, else ``default``.

    A null address and one without ``://`` have an empty host and path, and
    hence no rule. Repeated rows are judged each; other columns are not read.
    """
    trie = pages.sparkSession.sparkContext.broadcast(build_trie(rules))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, paths, names, verdicts = [], [], [], []
        for value in batch.column("url").to_pylist():
            host, path = split_url(value)
            rule = longest_rule(trie.value, host, path)
            hosts.append(host)
            paths.append(path)
            names.append(rule.name if rule else None)
            verdicts.append(rule.verdict if rule else default)
        text = pa.string()
        return pa.RecordBatch.from_arrays(
            [batch.column("page_id"), *(pa.array(x, text) for x in (hosts, paths, names, verdicts))],
            ["page_id", "host", "path", "rule", "verdict"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    return map_slices(rows, "url", SCHEMA, work)
