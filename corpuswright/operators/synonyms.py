"""Synonym swap with a lexicon of any size, phrases included.

The lexicon is a table. Each text offers its distinct word sequences, of the lengths that
phrases have, and meets the lexicon in one equi-join on them, so that a word which begins
very many phrases costs a text no more than another. What is found comes back as the
text's own small trie, and the text is put together again once, by longest match from
left to right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpuswright.sources.staging import stage


def phrase_table(lexicon: DataFrame, phrase: str = "phrase", replacement: str = "replacement") -> DataFrame:
    """(phrase, replacement, length): one replacement per phrase, staged.

    Phrases are words with single blanks between them, of equal phrases the smallest
    replacement counts. Null and empty phrases, and null replacements, are left out.
    """
    kept = lexicon.select(F.trim(F.col(phrase)).alias("phrase"), F.col(replacement).alias("replacement")).filter(
        (F.col("phrase") != "") & F.col("replacement").isNotNull())
    single = kept.groupBy("phrase").agg(F.min("replacement").alias("replacement"))
    return stage(single.withColumn("length", F.size(F.split("phrase", " "))), "phrases")


def _sequences(texts: Column, lengths: Sequence[int]) -> Column:
    """The distinct sequences of so many words of every text."""

    @F.arrow_udf("array<string>")
    def offer(texts):
        import pyarrow as pa

        def of(text: str) -> list[str]:
            words = text.split(" ")
            return list({s for n in lengths for s in (words if n == 1 else map(" ".join, zip(*(words[i:] for i in range(n)))))})

        return pa.array([None if t is None else of(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return offer(texts)


def _replaced(texts: Column, own: Column) -> Column:
    @F.arrow_udf("string")
    def swap(texts, own):
        import pyarrow as pa

        out = []
        for text, found in zip(texts, own):
            text, trie = text.as_py(), {}
            for entry in found.as_py() or ():
                node = trie
                for word in entry["phrase"].split(" "):
                    node = node.setdefault(word, {})
                node[None] = entry["replacement"]  # no word is None
            if text is None or not trie:
                out.append(text)
                continue
            words, kept, at = text.split(" "), [], 0
            while at < len(words):
                node, end, best = trie, at, None
                while end < len(words) and words[end] in node:
                    node, end = node[words[end]], end + 1
                    if None in node:
                        best = (end, node[None])
                at, word = best or (at + 1, words[at])
                kept.append(word)
            out.append(" ".join(kept))
        return pa.array(out, pa.string())

    return swap(texts, own)


def swap_phrases(rows: DataFrame, lexicon: DataFrame, text: str = "text") -> DataFrame:
    """rows with every phrase of the lexicon replaced, in texts of words with single blanks.

    lexicon: (phrase, replacement). The longest phrase counts where several begin, and
    what is replaced is not read again. Null texts stay null, rows are judged one by one,
    and an empty lexicon changes nothing. The lengths of the phrases come to the driver.
    """
    phrases = phrase_table(lexicon)
    lengths = sorted(r["length"] for r in phrases.select("length").distinct().collect())
    if not lengths:
        return rows
    # Staged with its row numbers, which have to be the same on both ways.
    placed = stage(rows.withColumn("__row", F.monotonically_increasing_id()), "texts")
    own = placed.select("__row", F.explode(_sequences(F.col(text), lengths)).alias("phrase")).join(phrases.drop("length"), "phrase").groupBy("__row").agg(
        F.collect_list(F.struct("phrase", "replacement")).alias("__own"))
    joined = placed.join(own, "__row", "left")
    return joined.withColumn(text, _replaced(F.col(text), F.col("__own"))).select(*rows.columns)
