"""Allow and block rules for urls in a broadcast trie.

The trie goes down the host from its last label and then down the path by segments; the
last segment of a rule may be the beginning of one. Of all rules that fit a url the
longest (characters of host and path) decides, of equally long ones that with the longer
host, of equal ones the block.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

ALLOW, BLOCK = "allow", "block"
# Characters of rules in one broadcast trie; more rules go into further tries.
TRIE_CHARS = 16_000_000
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class Rule(NamedTuple):
    """Fits its host and all subdomains where the url's path begins with its path."""

    verdict: str
    host: str
    path: str


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path: up to "/", "?" or "#" after the first "://", then up to "?" or "#"."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def build_trie(rules: Sequence[Rule]) -> dict:
    """Nested dicts. Host nodes: labels below "hosts", a path node in "path". Path
    nodes: segments below "segments", "begins" from the beginning of a segment to
    (length, host length, is block, rule)."""
    root: dict = {"hosts": {}, "path": None}
    for rule in rules:
        if rule.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"not a verdict: {rule.verdict}")
        node = root
        for label in reversed(rule.host.translate(_LOWER).split(".")) if rule.host else ():
            node = node["hosts"].setdefault(label, {"hosts": {}, "path": None})
        if node["path"] is None:
            node["path"] = {"segments": {}, "begins": {}}
        node = node["path"]
        *whole, begin = rule.path.split("/")
        for segment in whole:
            node = node["segments"].setdefault(segment, {"segments": {}, "begins": {}})
        entry = (len(rule.host) + len(rule.path), len(rule.host), rule.verdict == BLOCK, rule.host + rule.path)
        node["begins"][begin] = max(entry, node["begins"].get(begin, entry))
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple | None:
    """The entry of the rule that decides, None where none fits."""
    best, segments = None, path.split("/")
    node, labels = trie, host.split(".") if host else []
    while node is not None:
        below = node["path"]
        for i, segment in enumerate(segments):
            if below is None:
                break
            for begin, entry in below["begins"].items() if len(below["begins"]) <= len(segment) else (
                (b, below["begins"][b]) for n in range(len(segment) + 1) if (b := segment[:n]) in below["begins"]
            ):
                if segment.startswith(begin) and (best is None or entry > best):
                    best = entry
            below = below["segments"].get(segment) if i + 1 < len(segments) else None
        node = node["hosts"].get(labels.pop()) if labels else None
    return best


def _chunks(rules: Sequence[Rule]) -> list[list[Rule]]:
    chunks, size = [[]], 0
    for rule in rules:
        chars = len(rule.host) + len(rule.path) + 1
        if chunks[-1] and size + chars > TRIE_CHARS:
            chunks.append([])
            size = 0
        chunks[-1].append(rule)
        size += chars
    return chunks


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to pages; columns of these names are replaced.

    rule is host and path of the rule that decides; without one it is null and the
    verdict is the default. A null url and one without "://" have empty host and path.
    Every row is judged by itself, nothing is shuffled, and repeated rows stay.
    """
    spark = pages.sparkSession
    result = "host string, path string, length int, host_length int, blocked boolean, rule string"

    def matcher(chunk: list[Rule]):
        trie = spark.sparkContext.broadcast(build_trie(chunk))

        @F.arrow_udf(result)
        def match(urls):
            import pyarrow as pa

            rows = []
            for value in urls.to_pylist():
                host, path = split_url(value)
                entry = longest_match(trie.value, host, path) or (None,) * 4
                rows.append(dict(zip(("host", "path", "length", "host_length", "blocked", "rule"), (host, path, *entry))))
            return pa.array(rows, pa.struct([
                ("host", pa.string()), ("path", pa.string()), ("length", pa.int32()), ("host_length", pa.int32()),
                ("blocked", pa.bool_()), ("rule", pa.string())]))

        return match

    def field(struct: Column, name: str) -> Column:
        return struct.getField(name)

    names = [f"__match{i}" for i in range(len(_chunks(rules)))]
    matched = pages.withColumns({n: matcher(c)(F.col(url)) for n, c in zip(names, _chunks(rules))})
    order = [F.struct(*[field(F.col(n), k) for k in ("length", "host_length", "blocked", "rule")]) for n in names]
    best = F.greatest(*order) if len(order) > 1 else order[0]
    return matched.withColumn("__best", best).withColumns({
        "host": field(F.col(names[0]), "host"), "path": field(F.col(names[0]), "path"),
        "rule": field(F.col("__best"), "rule"),
        "verdict": F.when(field(F.col("__best"), "blocked"), BLOCK)
        .when(field(F.col("__best"), "blocked").isNull(), default).otherwise(ALLOW),
    }).drop("__best", *names)
