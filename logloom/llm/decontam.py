"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton of all benchmark items recognises every word sequence that occurs
in any of them. A document's words are streamed through it once; the state always
stands for the longest suffix read so far that occurs in an item. Each state of
``window`` words or more points to the state of its last ``window`` words, which
carries the items that hold that window; items shorter than a window are ends of
their own and are found on the suffix links.

The benchmark is cut into blocks of at most ``block_chars`` characters by a hash
of the item, so that what is broadcast and what a worker builds is bounded. One
block is the usual case and makes the whole job map-only. With more of them the
documents pass through block after block, stored in between.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.batches import free_name, small_batches
from logloom.session import materialize

WINDOW = 13
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Bytes that cannot be part of a word become blanks; A-Z become a-z.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 32
    for c in range(256)
)

HITS = "n_words long, n_hit long, items array<string>, runs array<struct<first:int,last:int>>"


def words_of(text: str | None) -> list[bytes]:
    """Normalised words, as UTF-8; null has none."""
    return text.encode().translate(_FOLD).split() if text else []


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the windows it looks for."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        ends: dict[int, set] = {}
        for item, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
            if 0 < len(words) < window:
                ends.setdefault(last, set()).add(item)
        # The state of a window is the lowest ancestor that is still that long.
        self.anchor = [0] * len(self.length)
        self.short: list[tuple] = [()] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            if self.length[state] >= window:
                self.anchor[state] = self.anchor[up] if self.length[up] >= window else state
            own = ((self.length[state], tuple(ends[state])),) if state in ends else ()
            self.short[state] = self.short[up] + own
        self.owners: dict[int, set] = {}
        for item, words in items:
            if len(words) >= window:
                for _, state, matched in self.matches(words):
                    if matched >= window:
                        self.owners.setdefault(self.anchor[state], set()).add(item)

    def _extend(self, last: int, word: bytes) -> int:
        step, link, length = self.next, self.link, self.length
        if word in step[last]:
            known = step[last][word]
            return known if length[known] == length[last] + 1 else self._clone(last, known, word)
        new = self._state({}, length[last] + 1, 0)
        at = last
        while at >= 0 and word not in step[at]:
            step[at][word] = new
            at = link[at]
        if at >= 0:
            known = step[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._clone(at, known, word)
        return new

    def _state(self, step: dict, length: int, link: int) -> int:
        self.next.append(step)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _clone(self, at: int, known: int, word: bytes) -> int:
        copy = self._state(dict(self.next[known]), self.length[at] + 1, self.link[known])
        self.link[known] = copy
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, state, matched words) wherever anything of an item matches."""
        step, link, length = self.next, self.link, self.length
        state = matched = 0
        for position, word in enumerate(words):
            to = step[state].get(word)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = step[state].get(word)
            if to is not None:
                state = to
                matched += 1
                yield position, state, matched

    def scan(self, words: list[bytes]) -> tuple[set, list[list[int]]]:
        """Items with occurring windows, and the runs of words inside such windows."""
        found: set = set()
        runs: list[list[int]] = []
        window, anchor, short, owners = self.window, self.anchor, self.short, self.owners
        for position, state, matched in self.matches(words):
            width = 0
            if matched >= window:
                found |= owners[anchor[state]]
                width = window
            for size, items in short[state]:
                if size <= matched:
                    found.update(items)
                    width = max(width, size)
            if width:
                first = position - width + 1
                while runs and runs[-1][0] >= first:
                    runs.pop()
                if runs and runs[-1][1] >= first - 1:
                    runs[-1][1] = position
                else:
                    runs.append([first, position])
        return found, runs


def union_runs(runs: list[list[int]]) -> list[list[int]]:
    """Overlapping and touching runs joined."""
    out: list[list[int]] = []
    for first, last in sorted(map(list, runs)):
        if out and out[-1][1] >= first - 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _scanner(items, window: int):
    """Pandas UDF (text, what earlier blocks found) -> HITS for one block of the benchmark."""

    def scan(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        automaton = SuffixAutomaton([(i, words_of(t)) for i, t in items.value], window)
        for texts, before in batches:
            rows = []
            for text, old_items, old_runs in zip(texts, before["items"], before["runs"], strict=True):
                words = words_of(text)
                found, runs = automaton.scan(words)
                if len(old_items):
                    found |= set(old_items)
                    runs = union_runs(runs + [[r["first"], r["last"]] for r in old_runs])
                hit = sum(last - first + 1 for first, last in runs)
                rows.append((len(words), hit, sorted(found), [{"first": a, "last": b} for a, b in runs]))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "runs"])

    return F.pandas_udf(scan, HITS)


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    out: str = "hits",
    window: int = WINDOW,
    block_chars: int = 2_000_000,
) -> DataFrame:
    """``docs`` with a struct ``out``: ``n_words``, ``n_hit``, ``items`` and ``runs`` of hit words.

    Words are lower-cased runs of letters, digits and non-ASCII characters. A window
    is ``window`` consecutive words of an item, or the whole of a shorter item. Every
    row of ``docs`` is kept once, repeated ids included; null and empty texts have no
    words; items without words, and an empty benchmark, have no windows; items with
    equal texts are all listed; a null item id counts as the text ``null``. Other
    columns pass through untouched; a column called ``out`` is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    items = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.coalesce(F.col(item_text), F.lit("")).alias("body"),
    )
    chars = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = max(1, -(-chars // block_chars))
    nothing = F.expr("named_struct('items', array(), 'runs', array())").cast(
        "struct<items:array<string>,runs:array<struct<first:int,last:int>>>"
    )
    found = docs.withColumn(out, nothing)
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        held = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        found = found.withColumn(out, _scanner(held, window)(F.col(text), F.col(out)))
        if block < blocks - 1:
            found = materialize(found.withColumn(out, F.struct(f"{out}.items", f"{out}.runs")))
    return found


def is_contaminated(hits: str = "hits", share: int = 20) -> Column:
    """At least one word in ``share`` lies inside a benchmark window."""
    n_hit, n_words = F.col(f"{hits}.n_hit"), F.col(f"{hits}.n_words")
    return (n_hit > 0) & (n_hit * share >= n_words)


def without_runs(text: str | None, runs) -> str | None:
    """The text without the words of ``runs`` and what lies between those of one run."""
    if text is None or not len(runs):
        return text
    # Folding A-Z changes no length, so offsets in the folded text hold in the text.
    folded = text.translate({c: c + 32 for c in range(65, 91)})
    spans = [m.span() for m in WORD.finditer(folded)]
    out, at = [], 0
    for run in runs:
        out.append(text[at : spans[run["first"]][0]])
        at = spans[run["last"]][1]
    return "".join(out) + text[at:]


def _cut(texts: pd.Series, runs: pd.Series) -> pd.Series:
    return pd.Series([without_runs(t, r) for t, r in zip(texts, runs, strict=True)], dtype=object)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, share: int = 20) -> DataFrame:
    """Drop contaminated documents, and cut the hit spans out of those below the coverage limit.

    Columns stay as they are; documents without a hit are not changed. Nulls, empty
    texts and an empty benchmark: as in ``find_hits``, no hit.
    """
    hits = free_name(docs, "hits")
    found = find_hits(docs, benchmark, text, out=hits, window=window)
    kept = found.filter(~is_contaminated(hits, share))
    cut = F.when(F.col(f"{hits}.n_hit") > 0, F.pandas_udf(_cut, "string")(F.col(text), F.col(f"{hits}.runs"))).otherwise(F.col(text))
    return kept.withColumn(text, cut).drop(hits)


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: word, hit and item counts, digest of the items, verdict."""
    found = find_hits(docs.select("doc_id", "text"), benchmark)
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def digest(items: list[str]) -> str:
    """What ``items_sha256`` holds, for tests."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
