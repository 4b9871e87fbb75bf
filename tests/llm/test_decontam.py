import random
import re

import pytest

from logloom.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window):
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            for j in range(len(doc) - k + 1):
                if doc[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
                    found.add(str(item))
    return len(doc), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(4))
def test_automaton_against_brute_force(spark, seed):
    rng = random.Random(seed)
    def text(n):
        return " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 4, 5, 6, 9, 14]))) for i in range(12)] + [(50, "a b A c, a"), (51, "a b a c a")]
    docs = [(i, text(rng.choice([0, 3, 20, 60]))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_chars in (10**6, 60):  # one block, and several with stored tables in between
        found = decontam.find_hits(frame, bench, window=5, block_chars=block_chars).collect()
        for row in found:
            got = (row.hits.n_words, row.hits.n_hit, row.hits["items"])
            assert got == brute(row.text, items, 5), row.text


def test_odd_documents(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three"), (2, None), (3, ""), (None, "text wordy text")], "item_id long, text string")
    rows = decontam.decontamination(odd_docs, bench).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert (by[1].n_words, by[1].n_hit, by[1].contaminated) == (0, 0, False)
    assert by[4].contaminated and by[4].items_sha256 == decontam.digest(["1"])
    assert by[6].n_hit == 10_000 - 1 and by[6].items_sha256 == decontam.digest(["null"])
    assert by[2].items_sha256 == decontam.digest([])
    assert decontam.decontamination(no_docs, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontamination(odd_docs, none).filter("n_hit > 0").count() == 0
    kept = decontam.decontaminate(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 7, 8]


def test_spans_are_cut_below_the_limit(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    docs = spark.createDataFrame([(1, "A, b " * 200 + passage.upper() + ". tail"), (2, passage + " rest")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    assert [tuple(r) for r in decontam.decontaminate(docs, bench).collect()] == [(1, "A, b " * 200 + ". tail")]
