"""Column functions over text.

Most of it runs as built-in Spark expressions. What Spark does not offer, or only by
several regular expressions over every text, are small Arrow functions: Unicode
normalisation, accents and sorted word sets.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

# What Python's str.split() and str.strip() treat as whitespace.
_ASCII_SPACE = r"\x09-\x0d\x1c-\x20"
_WIDE_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
ANY_SPACE = _ASCII_SPACE + "".join(map(chr, _WIDE_SPACES))
_WORD = r"[\p{L}\p{N}_]"


class _Bare(dict):
    """Code points to the characters that are left without accents, found on first use.

    Decomposition maps each character by itself, and the order of the marks does not
    matter as all of them go.
    """

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFKD", chr(code))
        self[code] = bare = "".join(c for c in parts if not unicodedata.combining(c))
        return bare


_BARE = _Bare()


def _normalize_one(text: str) -> str:
    # A text of ASCII characters is its own NFKC.
    flat = " ".join((text if text.isascii() else unicodedata.normalize("NFKC", text)).split())
    if not flat.isprintable():
        unprintable = {ord(c) for c in set(flat) if unicodedata.category(c)[0] == "C"}
        if unprintable:
            flat = " ".join(flat.translate(dict.fromkeys(unprintable)).split())
    return flat


def _per_text(fn: Callable, kind: DataType):
    """Arrow function that applies fn to every text; null stays null."""
    listed = isinstance(kind, ArrayType)

    def each(texts):
        import pyarrow as pa

        found = [None if t is None else fn(t) for t in texts.to_pylist()]
        return pa.array(found, pa.list_(pa.string()) if listed else pa.string())

    return F.arrow_udf(each, kind)


_normalized = _per_text(_normalize_one, StringType())
_stripped = _per_text(lambda t: t if t.isascii() else t.translate(_BARE), StringType())
# Code points and UTF-8 bytes sort alike, so this is Spark's order.
_word_set = _per_text(lambda t: sorted(set(t.split())), ArrayType(StringType()))


def evaluate_once(value: Column) -> Column:
    """Row generator of exactly the given value.

    Filters are not pushed through a generator, so a costly expression selected through
    it is evaluated once per row, however often later steps refer to it.
    """
    return F.explode(F.array(value))


def is_blank(text: Column) -> Column:
    """Null, empty or whitespace only."""
    return text.isNull() | ~text.rlike(f"[^{ANY_SPACE}]")


def normalize_text(text: Column) -> Column:
    """NFKC, whitespace runs to one space, control characters out, trimmed; null gives ''."""
    return F.coalesce(_normalized(text), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words in normalised text."""
    spaces = F.char_length(text) - F.char_length(F.replace(text, F.lit(" ")))
    return F.when(text == "", 0).otherwise(spaces + 1)


def words(text: Column) -> Column:
    """Whitespace separated words of any text, blank text gives an empty array."""
    parts = F.split(text, f"[{ANY_SPACE}]+")
    return F.filter(parts, lambda w: w != "")


def word_set(text: Column) -> Column:
    """Distinct lower-cased words, sorted so that equal sets are equal arrays."""
    return _word_set(F.lower(text))


def jaccard(left: Column, right: Column) -> Column:
    """Jaccard similarity of two word sets; two empty sets score 0."""
    shared = F.size(F.array_intersect(left, right))
    union = F.size(left) + F.size(right) - shared
    return F.when(union == 0, 0.0).otherwise(shared / union)


def preview(text: Column, length: int = 100) -> Column:
    return F.when(
        F.char_length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)


def strip_accents(text: Column) -> Column:
    return _stripped(text)


def word_tokens(text: Column) -> Column:
    """Runs of at least two word characters."""
    return F.regexp_extract_all(text, F.lit(_WORD + "{2,}"), F.lit(0))


def analyzer_tokens(text: Column, accents: bool = False) -> Column:
    """Lower-cased word tokens, without accents unless asked to keep them."""
    lowered = F.lower(text)
    return word_tokens(lowered if accents else strip_accents(lowered))


def remove_words(tokens: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(*stop_words))


def ngrams(tokens: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams for n in low..high, joined by one space."""
    grams = []
    for n in range(low, high + 1):
        gram = F.slice(tokens, 1, F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        for shift in range(1, n):
            rest = F.slice(tokens, shift + 1, F.size(gram))
            gram = F.zip_with(gram, rest, lambda a, b: F.concat_ws(" ", a, b))
        grams.append(gram)
    return F.concat(*grams)


def encode_label(label: Column, labels: Sequence[str]) -> Column:
    """Position of the label in its domain, null when outside."""
    position = F.array_position(F.array(*map(F.lit, labels)), label)
    return F.when(position > 0, (position - 1).cast("int"))


def decode_label(label_id: Column, labels: Sequence[str]) -> Column:
    return F.get(F.array(*map(F.lit, labels)), label_id)


def slug(name: Column) -> Column:
    return F.translate(name, "/", "-")


def length_bucket(words_column: Column, buckets) -> Column:
    """Name of the first bucket (name, lowest, highest) holding the word count."""
    chain = None
    for name, low, high in buckets:
        inside = words_column >= low
        if high is not None:
            inside = inside & (words_column <= high)
        chain = F.when(inside, name) if chain is None else chain.when(inside, name)
    return chain


def remove_punctuation(text: Column) -> Column:
    """Drop the ASCII punctuation characters."""
    return F.regexp_replace(text, r"\p{Punct}", "")


def swap_synonyms(text: Column, lexicon: Mapping[str, str]) -> Column:
    """Replace whole words of normalised text through a small lexicon."""
    if not lexicon:
        return text
    table = F.create_map(*[F.lit(x) for pair in lexicon.items() for x in pair])
    return F.array_join(
        F.transform(F.split(text, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " "
    )
