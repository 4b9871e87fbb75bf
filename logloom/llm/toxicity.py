"""Toxic spans by a linear-chain CRF over words, and document scores from its marginals.

Labels exist for documents, the field needs them for tokens. Corpus statistics close
the gap: for every word and prefix of a bounded sample of toxic texts, the different
toxic and clean texts that have it are counted over all labelled documents, copies of
one text once. Those whose share of the toxic texts is so much higher that chance does
not explain it mark tokens as toxic; the other words of toxic texts have no label. A field over two labels is then
fitted on the sample; affix and n-gram features carry it over to words never seen.

Forward-backward marginals give offending words with their offsets, and two figures per
document (the highest marginal, and how many words there are), from which a logistic
fit on the same sample makes the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm import crf
from logloom.llm.batches import crc_mod, small_batches

LETTERS = r"\p{L}+"
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
CROWDED = 48  # of 64 bits


def words_of(text: str | None) -> list[str]:
    """Runs of letters, each lower-cased."""
    import regex

    return [w.lower() for w in regex.findall(LETTERS, text)] if text else []


def marks_of(word: str) -> list[str]:
    """The word (closed by a blank) and its prefixes."""
    return [word + " "] + [word[:n] for n in PREFIXES if len(word) >= n]


def _bits(mask: Column) -> Column:
    return F.bit_count(F.coalesce(F.bit_or(mask), F.lit(0).cast("long")))


def text_counts(labelled: DataFrame, text: str, toxic: str, marks: set[str]) -> DataFrame:
    """About how many different texts have each of ``marks``: toxic ones (``bad``) and clean ones (``fine``).

    The empty mark stands for all texts. A text's key is the smallest hash of its words with their
    neighbours, which copies share, and many near copies. Keys are hashed to levels, each holding a
    sixteenth of the one before, and per level to 64 bits: the lowest level that is not crowded gives
    the number, at any size, from one 64-bit value per side, mark and level. Near copies with keys of
    their own still have most words between the same neighbours: ``places`` is the number of different
    pairs of neighbours in toxic texts while there are few (under a hundred), and ``bad`` beyond.
    """
    words = F.transform(F.regexp_extract_all(F.col(text), F.lit(LETTERS), 0), F.lower)
    rows = labelled.select((F.col(toxic) == 1).alias("is_bad"), words.alias("w"))
    placed_words = F.transform(
        "w",
        lambda x, i: F.struct(
            x.alias("w"),
            F.pmod(F.xxhash64(F.get("w", i - 1), F.lit(""), F.get("w", i + 1)), F.lit(64)).cast("int").alias("slot"),
        ),
    )
    smallest = F.array_min(F.transform("w", lambda x, i: F.xxhash64(F.get("w", i - 1), x, F.get("w", i + 1))))
    # Hashed once more: the smallest of many is itself not evenly spread. A column before the words are dealt
    # out: beside them it would be worked out for every word, from all words of its text.
    keyed = rows.withColumn("key", F.xxhash64(smallest, F.lit("key")))
    tokens = keyed.select("is_bad", "key", F.posexplode(placed_words).alias("at", "t")).select("is_bad", "key", "at", "t.w", "t.slot")
    level = F.expr("case " + " ".join(f"when key & {16 ** (n + 1) - 1}L <> 0 then {n}" for n in range(13)) + " else 13 end")
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(key, 58) as int))")
    prefixes = [F.when(F.length("w") >= n, F.substring("w", 1, n)) for n in PREFIXES]
    every = F.when(F.col("at") == 0, F.lit(""))  # once a text
    placed = tokens.select("is_bad", "at", "w", "slot", level.alias("level"), bit.alias("bit")).select(
        "is_bad", "slot", "level", "bit", F.explode(F.array(every, F.concat("w", F.lit(" ")), *prefixes)).alias("mark")
    )
    asked = labelled.sparkSession.createDataFrame(pa.table({"mark": pa.array(sorted(marks | {""}), pa.string())}))
    levels = placed.join(F.broadcast(asked), "mark").groupBy("mark", "level").agg(
        _bits(F.when(F.col("is_bad"), F.col("bit"))).alias("bad"),
        _bits(F.when(~F.col("is_bad"), F.col("bit"))).alias("fine"),
        F.bit_or(F.when(F.col("is_bad"), F.expr("shiftleft(1L, slot)"))).alias("around"),
    )

    def number(side: str):
        bits = F.least(F.col(side), F.lit(63))
        here = -64 * F.log(1 - bits / 64) * F.pow(F.lit(16.0), F.col("level") + 1) / 15
        return F.coalesce(F.min_by(here, F.when(F.col(side) <= CROWDED, F.col("level"))), F.max(here))

    pairs = _bits(F.col("around"))
    pairs = F.when((pairs <= CROWDED) & (F.col("mark") != ""), -64 * F.log(1 - pairs / 64))  # crowded: many, texts decide
    return levels.groupBy("mark").agg(
        number("bad").alias("bad"), number("fine").alias("fine"), F.coalesce(pairs, number("bad")).alias("places")
    )


def telling(bad: float, fine: float, all_bad: float, all_fine: float, lift: float, chance: float) -> bool:
    """Whether a mark found ``bad`` times in toxic and ``fine`` times in clean texts tells toxic texts.

    Its shares of all such texts differ ``lift`` times or more, with half a text as prior on both sides, and
    the probability of that by chance (the likelihood-ratio bound for so many texts) is at most ``chance``.
    """
    odds = ((bad + 0.5) / all_bad) / ((fine + 0.5) / all_fine)
    if odds < lift:
        return False
    share, usual = bad / (bad + fine), all_bad / (all_bad + all_fine)
    far = share * math.log(share / usual) + ((1 - share) * math.log((1 - share) / (1 - usual)) if share < 1 else 0.0)
    return (bad + fine) * far >= -math.log(chance)


def toxic_marks(
    labelled: DataFrame, text: str, toxic: str, sample: list[tuple[str, int]], lift: float = 20.0, wrong: float = 0.1
) -> tuple[set[str], set[str]]:
    """Words and prefixes of the toxic texts in ``sample`` that give toxic documents away, by all of ``labelled``.

    The first set has those told by the different places they stand at (several of one text count each),
    the second those told by the number of texts, which may be near copies of each other. ``wrong``: how many marks may be expected
    to be there by chance.
    """
    asked = {m for t, y in sample if y == 1 for w in set(words_of(t)) for m in marks_of(w)}
    counts = {r["mark"]: r for r in text_counts(labelled, text, toxic, asked).collect()}
    whole = counts.pop("", None)
    if whole is None or not whole["bad"] or not whole["fine"]:
        return set(), set()

    def told(by: str) -> set[str]:
        return {
            m for m, r in counts.items()
            if r[by] and telling(r[by], r["fine"], whole["bad"], whole["fine"], lift, wrong / len(asked))
        }

    return told("places"), told("bad")


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, toxic: str, rows: int) -> list[tuple[str, int]]:
    """Up to ``rows`` toxic and as many clean labelled texts, by a hash of their ids."""
    picked = None
    for value in (1, 0):
        ids = labels.filter(F.col(toxic) == value).select(doc_id).orderBy(F.xxhash64(doc_id), doc_id).limit(rows)
        part = ids.withColumn("y", F.lit(value))
        picked = part if picked is None else picked.unionByName(part)
    found = docs.select(doc_id, text).join(F.broadcast(picked), doc_id).select(text, "y")
    return sorted((r[text] or "", r["y"]) for r in found.collect())


def train(
    sample: list[tuple[str, int]], marks: set[str], weaker: set[str] = frozenset(), window: int = 20, piece: int = 150, seed: int = 7
) -> crf.Model:
    """Fit the field: words around marked ones in toxic texts, and pieces of clean ones from anywhere in them.

    Words of toxic texts that no mark covers have no label. ``weaker`` marks serve texts that have no other, and
    without any mark the documents' labels are their words'.
    """
    rng = np.random.default_rng(seed)
    sequences = []
    for text, y in sample:
        words = words_of(text)
        if y == 1:
            hot = np.array([any(m in marks for m in marks_of(w)) for w in words], dtype=bool)
            if not hot.any():
                hot = np.array([any(m in weaker for m in marks_of(w)) for w in words], dtype=bool)
            if not marks and not weaker:
                hot[:] = True
            if not hot.any():
                continue  # nothing is known about which of its words are toxic
            near = np.flatnonzero(np.convolve(hot, np.ones(window + 1))[window // 2 :][: len(words)] > 0)
            words, labels = [words[i] for i in near], np.where(hot[near], 1, crf.UNKNOWN).tolist()
        else:
            labels = [0] * len(words)
        start = int(rng.integers(0, max(1, len(words) - piece + 1)))
        if words:
            sequences.append((words[start : start + piece], labels[start : start + piece]))
    return crf.fit(sequences, ["fine", "toxic"])


def figures(probs: np.ndarray) -> tuple[float, float]:
    """Log-odds of the highest marginal, and the (damped) number of toxic words."""
    if not len(probs):
        return -8.0, 0.0
    p = probs[:, 1]
    top = float(np.clip(p.max(), 3e-4, 1 - 3e-4))
    return float(np.log(top / (1 - top))), float(np.log1p(p[p > 0.5].sum()))


def calibrate(tagged: list[np.ndarray], truth: list[int], weight: float) -> np.ndarray:
    """Logistic weights (bias, highest, number) by Newton steps; ``weight`` restores the clean texts' share."""
    x = np.array([[1.0, *figures(p)] for p in tagged])
    y = np.array(truth, dtype=float)
    importance = np.where(y == 1, 1.0, weight)
    w = np.zeros(3)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (importance * (y - p)) - 0.05 * w
        curve = (x.T * (importance * p * (1 - p))) @ x + 0.05 * np.eye(3)
        w = w + np.clip(np.linalg.solve(curve, slope), -2, 2)
    return w


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    out: str = "toxicity",
    rows: int = 1_000,
    window: int = 20,
    piece: int = 150,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with a struct ``out``: ``score``, ``predicted``, ``n_toxic`` and ``spans`` (start, end, marginal).

    Spans are runs of words with a marginal over one half, in code points, end exclusive.
    Labels that are null are ignored; of several for one id the highest counts. Null and
    empty texts get the score of a text without any toxic word. Without labelled texts of
    both kinds every score is the share of toxic labels (0 if there are none). Rows stay as
    they are, repeated ids included; a column called ``out`` is replaced.

    The field learns from at most ``rows`` texts of each label; of a toxic one, from what lies within
    ``window // 2`` words of a marked word, and of every text from at most ``piece`` words in a row,
    beginning anywhere. Statistics cover all labelled documents, and all texts are scored whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = labels.filter(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(toxic).alias(toxic))
    known = known.withColumn(toxic, (F.col(toxic) > 0).cast("int"))
    totals = {r[toxic]: r["n"] for r in known.groupBy(toxic).agg(F.count("*").alias("n")).collect()}
    n_bad, n_fine = totals.get(1, 0), totals.get(0, 0)
    fitted = None
    if n_bad and n_fine:
        # One way at every size; broadcasting labels would only hold while they are few.
        labelled = docs.select(doc_id, text).join(known.hint("merge"), doc_id).select(text, toxic)
        sample = training_sample(docs, known, doc_id, text, toxic, rows)
        if any(words_of(t) for t, y in sample if y == 1):
            model = train(sample, *toxic_marks(labelled, text, toxic, sample), window, piece)
            tagged = crf.Tagger(model).tag([words_of(t) for t, _ in sample])
            weight = (n_fine / max(1, min(n_fine, rows))) / (n_bad / max(1, min(n_bad, rows)))
            fitted = (model.parts(), calibrate(tagged, [y for _, y in sample], weight))
    held = spark.sparkContext.broadcast(fitted)
    base = n_bad / max(1, n_bad + n_fine)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import regex

        tagger = crf.Tagger(crf.Model(*held.value[0])) if held.value else None
        for texts in batches:
            out_rows = []
            tagged = tagger.tag([words_of(t) for t in texts]) if tagger else [None] * len(texts)
            for t, probs in zip(texts, tagged, strict=True):
                if probs is None:
                    out_rows.append((base, int(base >= threshold), 0, []))
                    continue
                score = float(1 / (1 + np.exp(-np.clip(held.value[1] @ np.array([1.0, *figures(probs)]), -30, 30))))
                hot = np.flatnonzero(probs[:, 1] > 0.5)
                spans: list[dict] = []
                if len(hot):
                    places = [m.span() for m in regex.finditer(LETTERS, t)]
                    for i, before in zip(hot.tolist(), [-2, *hot.tolist()], strict=False):
                        if i == before + 1:
                            spans[-1]["end"] = places[i][1]
                            spans[-1]["marginal"] = max(spans[-1]["marginal"], float(probs[i, 1]))
                        else:
                            spans.append({"start": places[i][0], "end": places[i][1], "marginal": float(probs[i, 1])})
                out_rows.append((score, int(score >= threshold), len(hot), spans))
            yield pd.DataFrame(out_rows, columns=["score", "predicted", "n_toxic", "spans"])

    kind = "score double, predicted int, n_toxic long, spans array<struct<start:int,end:int,marginal:double>>"
    return docs.withColumn(out, F.pandas_udf(run, kind)(F.col(text)))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of every document, learned from labels whose id's crc32 modulo 4 is not 2."""
    found = score_toxicity(docs.select("doc_id", "text"), labels.filter(crc_mod("doc_id", 4) != 2))
    return found.select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "toxicity.score", "toxicity.predicted", "toxicity.n_toxic", "toxicity.spans"
    )
