"""Token counts of a byte-level BPE by a two-tier table of pre-token lengths.

First tier: the lengths (in tokens) of the most frequent pre-tokens, learned from a
bounded sample of rows and broadcast as one dictionary. Second tier: what is missing
there is encoded by the tokenizer itself once per worker and remembered in a bounded
cache. Counting is map-only; no pre-token is ever shuffled. The table changes only the
speed: every length in it and every miss comes from the tokenizer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.batches import small_batches

# Fixed value: the public split pattern of this tokenizer family.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Lengths(dict):
    """Pre-token -> number of tokens; encodes what it does not know, forgets all of it at ``limit``."""

    def __init__(self, frequent: dict[str, int], path: str, limit: int = 500_000):
        super().__init__(frequent)
        from tokenizers import Tokenizer

        self.frequent, self.limit = frequent, limit
        self.tokenizer = Tokenizer.from_file(path)

    def __missing__(self, pre_token: str) -> int:
        n = len(self.tokenizer.encode(pre_token, add_special_tokens=False).ids)
        if len(self) >= self.limit + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        self[pre_token] = n
        return n

    def specials(self) -> list[str]:
        """Strings that the tokenizer takes for one token wherever they stand."""
        return [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]


def splitter(specials: list[str]):
    """Function that cuts a text into pre-tokens, special strings first."""
    import regex

    words = regex.compile(PATTERN).findall
    if not specials:
        return words
    special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")")

    def cut(text: str) -> list[str]:
        if not any(s in text for s in specials):
            return words(text)
        parts = special.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else words(part))]

    return cut


def frequent_lengths(docs: DataFrame, text: str, path: str, sample_rows: int, entries: int) -> dict[str, int]:
    """Lengths of the ``entries`` most frequent pre-tokens of the first ``sample_rows`` rows."""
    lengths = Lengths({}, path, limit=entries + 1)
    cut, counts = splitter(lengths.specials()), Counter()
    for row in docs.select(F.col(text).alias("t")).take(sample_rows):
        counts.update(cut(row.t) if row.t else [])
    return {word: lengths[word] for word, _ in counts.most_common(entries)}


def count_tokens(
    docs: DataFrame,
    path: str,
    text: str = "text",
    out: str = "tokens",
    sample_rows: int = 1_000,
    entries: int = 50_000,
    cache: int = 300_000,
) -> DataFrame:
    """``docs`` with ``out``: tokens of the whole text under the tokenizer file ``path``.

    No begin, end or padding tokens, no truncation; special strings inside a text count
    as one token each. Null and empty texts have none. Rows are neither dropped nor
    joined, whatever their ids; other columns pass through, one called ``out`` is
    replaced. ``sample_rows`` and ``entries`` bound the broadcast table, ``cache`` what a
    worker remembers besides. The file must be readable on every executor.
    """
    spark = docs.sparkSession
    small_batches(spark)
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, text, path, sample_rows, entries))

    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths = Lengths(frequent.value, path, cache)
        cut, length = splitter(lengths.specials()), lengths.__getitem__
        for texts in batches:
            yield pd.Series([sum(map(length, cut(t))) if t else 0 for t in texts], dtype="int64")

    return docs.withColumn(out, F.pandas_udf(count, "long")(F.col(text)))


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over the limit."""
    counted = count_tokens(docs.select("doc_id", "text"), path, out="n_tokens")
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
