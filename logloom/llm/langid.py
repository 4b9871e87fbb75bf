"""Language identification by a linear-chain CRF over words.

Words of a code-switched text are labelled one by one: affix, n-gram and lexicon
features score a word under each language, learned transitions carry the languages of
its neighbours, forward-backward gives the probabilities. A document's language is the
one with the most probability mass, its score that language's share.

The field is fitted on a bounded sample of labelled documents (``rows_per_lang`` rows
of each language that occurs, ``sample_chars`` characters of any of them). The words of a sampled document carry its language; the training sequences
string together runs of different documents, so that transitions between languages
are learned from switches and not only from their absence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logloom.llm import crf
from logloom.llm.batches import crc_mod, free_name, small_batches

UNKNOWN = "und"
LETTERS = r"\p{L}+"


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    import regex

    return regex.findall(LETTERS, text.lower()) if text else []


def training_sample(docs: DataFrame, text: str, lang: str, rows_per_lang: int) -> list[tuple[str, str]]:
    """Up to ``rows_per_lang`` (language, text) of every language.

    Equal texts count once; which are taken depends only on a hash of the text.
    """
    named = docs.filter(F.col(lang).isNotNull() & F.col(text).rlike(LETTERS)).select(
        F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("h"), F.length(text).alias("n"), F.col(text).alias("text")
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    keys = named.select("lang", "h").distinct()
    picked = {(r["lang"], r["h"]) for r in keys.withColumn("r", rank).filter(F.col("r") <= rows_per_lang).collect()}
    hashes = sorted({h for _, h in picked})
    found = {}
    if hashes:
        for row in named.filter(F.col("h").isin(hashes)).groupBy("lang", "h").agg(F.min("text").alias("text")).collect():
            if (row["lang"], row["h"]) in picked:
                found[row["lang"], row["h"]] = row["text"]
    return [(lang, t) for (lang, _), t in sorted(found.items())]


def train(sample: list[tuple[str, str]], sample_chars: int = 6_000, seed: int = 7) -> crf.Model:
    """Fit the field on runs of 4 to 40 words of the sampled texts, dealt in random order."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for lang, _ in sample})
    runs = []
    for lang, text in sample:
        start = int(rng.integers(0, max(1, len(text) - sample_chars + 1)))
        words, at = words_of(text[start : start + sample_chars]), 0
        while at < len(words):
            size = int(rng.integers(4, 41))
            runs.append((words[at : at + size], labels.index(lang)))
            at += size
    order = rng.permutation(len(runs))
    sequences, at = [], 0
    while at < len(order):
        size = int(rng.integers(1, 6))
        part = [runs[i] for i in order[at : at + size]]
        sequences.append(([w for words, _ in part for w in words], [y for words, y in part for _ in words]))
        at += size
    return crf.fit(sequences, labels)


def identify(
    docs: DataFrame,
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    out: str = "language",
    rows_per_lang: int = 120,
) -> DataFrame:
    """``docs`` with a struct ``out``: ``lang_pred``, ``score``, ``n_words``, ``shares`` and ``sure``.

    ``shares`` maps every language to its part of the words' probability mass, ``sure`` is
    the mean of every word's highest probability, whichever language has it. A text
    that is null, empty or has no letter gets ``und`` with score 0; so does every text if
    ``labelled`` holds no labelled text. Ties go to the first language by name. Rows are
    kept as they are, repeated ids included; a column called ``out`` is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sample = training_sample(labelled, text, lang, rows_per_lang)
    model = spark.sparkContext.broadcast(train(sample).parts() if sample else None)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = crf.Tagger(crf.Model(*model.value)) if model.value else None
        for texts in batches:
            rows = []
            split = [words_of(t) for t in texts]
            for probs in tagger.tag(split) if tagger else [()] * len(split):
                if not len(probs):
                    rows.append((UNKNOWN, 0.0, 0, {}, 0.0))
                    continue
                share = probs.mean(axis=0)
                best = int(share.argmax())
                labels = model.value[0]
                shares = dict(zip(labels, share.tolist(), strict=True))
                sure = min(1.0, float(probs.max(axis=1).mean()))
                rows.append((labels[best], min(1.0, float(share[best])), len(probs), shares, sure))
            yield pd.DataFrame(rows, columns=["lang_pred", "score", "n_words", "shares", "sure"])

    kind = "lang_pred string, score double, n_words long, shares map<string,double>, sure double"
    return docs.withColumn(out, F.pandas_udf(run, kind)(F.col(text)))


def keep_identified(docs: DataFrame, labelled: DataFrame, min_sure: float = 0.4, text: str = "text", lang: str = "lang") -> DataFrame:
    """Documents whose words have a language each, sure by ``min_sure`` on average; columns stay as they are.

    How many languages share a text does not matter. Null, empty and letterless texts go.
    """
    out = free_name(docs, "language")
    found = identify(docs, labelled, text, lang, out)
    return found.filter((F.col(f"{out}.lang_pred") != UNKNOWN) & (F.col(f"{out}.sure") >= min_sure)).drop(out)


def learning_part(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents that may be learned from: crc32 of the id modulo 3 is not 1."""
    return docs.filter(crc_mod(doc_id, 3) != 1)


def language_ids(docs: DataFrame) -> DataFrame:
    """Predicted language of every document, and whether it was held out from learning."""
    found = identify(docs.select("doc_id", "text"), learning_part(docs))
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "language.lang_pred", "language.score")
