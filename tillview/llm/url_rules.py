"""Allow and block rules on URLs: a broadcast trie, and a join for long lists.

A rule has a host and a path. It fits its host and all subdomains if the URL's
path starts with the rule's path, character by character; so a rule path ``/``
does not fit a URL with an empty path. The longest rule wins: most host labels
first, then the longest path; where the same rule is both, block wins. Without a
rule the verdict is ``DEFAULT``.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z in lower case; the path goes on up to ``?``, ``#`` or the end. Null URLs and
those without ``://`` have both empty and get no rule. URLs of any length are judged whole,
repeated rows each, alike. Columns named like the four results are replaced, others
come through whatever their names; both ways show the same columns in the same order.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tillview.llm.shared import unused

DEFAULT = "allow"
#: Rules that are broadcast as a trie, at most; beyond that they are joined.
TRIE_RULES = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    def __str__(self) -> str:
        return self.host + self.path


def build(rules: Iterable[Rule]) -> dict:
    """Nodes are dicts: host labels from the right, then under ``/`` the path's
    segments; ``=`` holds what a last, unfinished segment may begin with."""
    root: dict = {}
    for rule in rules:
        node = root
        for label in reversed(rule.host.split(".")):
            node = node.setdefault((label,), {})
        node = node.setdefault("/", {})
        *whole, rest = rule.path.split("/")
        for segment in whole:
            node = node.setdefault((segment,), {})
        ends = node.setdefault("=", {})
        if ends.get(rest, ("", ""))[1] != "block":
            ends[rest] = (str(rule), rule.verdict)
    return root


def find(trie: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """The rule that wins, as text and verdict."""
    paths, node = [], trie
    for label in reversed(host.split(".")):
        node = node.get((label,))
        if node is None:
            break
        if "/" in node:
            paths.append(node["/"])
    segments = path.split("/")
    for node in reversed(paths):
        best = None
        for segment in segments:
            ends = node.get("=", {})
            for length in sorted({len(x) for x in ends}, reverse=True):
                if len(segment) >= length and segment[:length] in ends:
                    best = ends[segment[:length]]
                    break
            node = node.get((segment,))
            if node is None:
                break
        if best:
            return best
    return None, None


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return pages.withColumns({"host": F.translate(part(1), UPPER, LOWER), "path": part(2)})


def judge(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict. The trie of at most
    ``TRIE_RULES`` rules is broadcast; a longer list goes through ``judge_joined``."""
    if len(rules) > TRIE_RULES:
        listed = pages.sparkSession.createDataFrame([(r.host, r.path, r.verdict) for r in rules], "host string, path string, verdict string")
        return judge_joined(pages, listed, url)
    shared = pages.sparkSession.sparkContext.broadcast(build(rules))

    @arrow_udf("struct<rule: string, verdict: string>")
    def walk(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        trie = shared.value
        for hosts, paths in batches:
            found = [find(trie, h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)]
            yield pa.StructArray.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], ["rule", "verdict"])

    own = unused(pages, "found")
    judged = split_url(pages, url).withColumn(own, walk("host", "path"))
    return _shown(pages, judged.withColumns({"rule": F.col(own)["rule"], "verdict": F.coalesce(F.col(own)["verdict"], F.lit(DEFAULT))}))


def _shown(pages: DataFrame, judged: DataFrame) -> DataFrame:
    """The columns of ``pages``, then the four that both ways add; such columns of ``pages`` are replaced."""
    added = ["host", "path", "rule", "verdict"]
    return judged.select(*[c for c in pages.columns if c not in added], *added)


def judge_joined(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The same for rules in a table of any size: every distinct host and path meets
    the rules by equality of host suffix and path beginning. Runs one small job,
    for the lengths of rule paths."""
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()]
    once = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    split = split_url(pages, url)
    labels = F.split("host", r"\.")
    tail = F.expr("transform(sequence(1, size(_labels)), k -> array_join(slice(_labels, k, size(_labels)), '.'))")
    keys = split.select("host", "path").distinct().withColumn("_labels", labels).withColumn("_tail", F.explode(tail))
    starts = F.array(*(F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths)) if lengths else F.array().cast("array<string>")
    keys = keys.withColumn("_start", F.explode(starts)).where("_start is not null")
    once = once.select(F.col("host").alias("_tail"), F.col("path").alias("_start"), "verdict")
    order = Window.partitionBy("host", "path").orderBy(F.size(F.split("_tail", r"\.")).desc(), F.length("_start").desc())
    best = keys.join(once, ["_tail", "_start"]).withColumn("_n", F.row_number().over(order)).where("_n = 1")
    own = unused(pages, "found")
    best = best.select("host", "path", F.struct(F.concat("_tail", "_start").alias("rule"), "verdict").alias(own))
    joined = split.join(best, ["host", "path"], "left")
    return _shown(pages, joined.withColumns({"rule": F.col(own)["rule"], "verdict": F.coalesce(F.col(own)["verdict"], F.lit(DEFAULT))}))
