"""Secrets by pattern, and by what a dictionary-primed compressor cannot foretell.

Three patterns give the base findings. Further candidates are long strings of letters and
digits with a sensitive word shortly before them on the same line. A zstandard compressor
is primed with the identifiers that are most frequent around candidates, counted over all
documents. The novelty of a candidate is the number of bytes that it adds to the
compressed text around it: names and repeated strings add a few, random ones nearly their
own length. Candidates that stay incompressible are reported as well; the novelty of the
base findings is measured in the same way, but decides nothing.

Documents are read twice, once for the identifiers and once for the findings; nothing but
identifiers is shuffled and no text is stored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

KINDS = ("assign", "access", "hex", "novel")
#: Characters of a candidate at least, of the text around it, and from it back to a sensitive word.
MIN_LENGTH, AROUND, REACH = 16, 256, 64
#: Bytes that each byte of a candidate has to add to the compressed text.
MIN_NOVELTY = 0.5
#: Identifiers of the dictionary, of at most 40 characters each.
DICTIONARY_WORDS = 2048
_LEVEL = 9

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# Runs are taken whole, so a lower bound in the pattern equals dropping short ones after it.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG = re.compile(rf"[A-Za-z0-9+/_=~-]{{{MIN_LENGTH},}}")
_SENSITIVE = re.compile(r"pass|pwd|secret|token|key|auth|cred|bearer|private|sign|salt|login", re.IGNORECASE | re.ASCII)
_IDENTIFIER = re.compile(r"[A-Za-z_]{4,40}")


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns, in code points."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of long strings with letters and digits in a sensitive context."""
    found = []
    for m in _LONG.finditer(text):
        value = m.group()
        if any(c.isdigit() for c in value) and any(c.isalpha() for c in value):
            before = text[max(0, m.start() - REACH) : m.start()]
            if _SENSITIVE.search(before, before.rfind("\n") + 1):
                found.append(m.span())
    return found


def surroundings(text: str, start: int, end: int) -> str:
    """The text on both sides, without further copies of the string itself."""
    around = f"{text[max(0, start - AROUND):start]}\n{text[end:end + AROUND]}"
    return around.replace(text[start:end], "")


@lru_cache(2)
def compressor(words: tuple[str, ...]):
    """A zstandard compressor primed with these words, most frequent first."""
    import zstandard

    # The most frequent words stand last, where matches cost least.
    content = "\n".join(reversed(words)).encode()
    if len(content) < 8:
        return zstandard.ZstdCompressor(level=_LEVEL, write_content_size=False)
    primed = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    primed.precompute_compress(level=_LEVEL)
    return zstandard.ZstdCompressor(dict_data=primed, write_content_size=False)


def novelty(value: str, around: str, primed) -> int:
    """Bytes that the value adds to the compressed text around it."""
    known = around.encode()
    return max(0, len(primed.compress(known + b"\n" + value.encode())) - len(primed.compress(known)))


def findings(text: str, primed) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, novelty) of a whole text, by start, then by kind as listed."""
    base = base_findings(text)
    found = [(s, k, e, novelty(text[s:e], surroundings(text, s, e), primed)) for s, k, e in base]
    at = 0
    reach = 0  # end of the base findings that begin before the candidate's end
    for start, end in candidates(text):
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][2])
            at += 1
        if reach > start:
            continue  # part of a base finding
        added = novelty(text[start:end], surroundings(text, start, end), primed)
        if added >= MIN_NOVELTY * (end - start):
            found.append((start, 3, end, added))
    return [(KINDS[k], s, e, n) for s, k, e, n in sorted(found)]


def _identifiers(batches: Iterator) -> Iterator:
    """Each identifier around the candidates of a document, once a document."""
    import pyarrow as pa

    for batch in batches:
        found: list[str] = []
        for value in batch.column(0):
            text = value.as_py() or ""
            words: set[str] = set()
            for start, end in candidates(text):
                around = surroundings(text, start, end)
                words.update(_IDENTIFIER.findall(_LONG.sub(_only_names, around)))
            found.extend(words)
        if found:
            yield pa.RecordBatch.from_pydict({"word": found})


def _only_names(run: re.Match) -> str:
    """Long runs with digits may be secrets themselves and give no identifiers."""
    return " " if any(c.isdigit() for c in run.group()) else run.group()


def identifiers(docs: DataFrame, text: str = "text", most: int = DICTIONARY_WORDS) -> tuple[str, ...]:
    """The identifiers around candidates that the most documents hold, two at least.

    Counted over all documents; only the `most` first ones, ties by name, come to the driver.
    """
    counts = docs.select(text).mapInArrow(_identifiers, "word string").groupBy("word").count()
    first = counts.filter(F.col("count") > 1).orderBy(F.desc("count"), "word").limit(most)
    return tuple(r["word"] for r in first.collect())


def scan(docs: DataFrame, words: tuple[str, ...], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, findings): all findings of every document, as array of (kind, start, end, novelty).

    start and end count code points, end exclusive. A null text counts as empty; empty
    texts have no findings. Rows are judged one by one: repeated rows, repeated and null
    keys have each their findings. Only the two columns are read.
    """

    @F.arrow_udf("array<struct<kind:string,start:long,end:long,novelty:long>>")
    def find(texts):
        import pyarrow as pa

        shape = pa.list_(pa.struct([
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.int64())]))
        primed = compressor(words)
        found = [findings(value.as_py() or "", primed) for value in texts]
        return pa.array([[dict(zip(("kind", "start", "end", "novelty"), f)) for f in row] for row in found], shape)

    return docs.select(key, find(F.col(text)).alias("findings"))
