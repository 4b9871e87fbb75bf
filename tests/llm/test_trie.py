"""The prefix trie against a dictionary of prefixes."""

import hashlib
import re
import zlib

import pytest

from logloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key int, words string"


def brute(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    nodes, kids = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out, leaves, saved = [], {}, {}
    for p in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in kids.get(p, [])) or 1
        saved[p] = (len(nodes[p]) - 1) * words + sum(saved[k] for k in kids.get(p, []))
        ends = ",".join(str(c) for c in sorted(nodes[p]) if len(built[c]) == len(p))
        parent = min(nodes[p[:-1]]) if p else None
        row = (min(nodes[p]), len(p), parent, len(nodes[p]), len(kids.get(p, [])), leaves[p], saved[p])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def talks():
    rows = []
    for c in range(0, 60):
        for t in range(c % 7):
            rows.append((c, t, "user" if t % 2 == 0 else None, f"turn {t} of {c % 3}\n x", "d", 1, "w"))
    for c in range(200, 260):  # copies, of a deep one too
        rows += [(c, t, "user", f"same {t}", "d", 1, "w") for t in range(3 if c % 2 else 40)]
    rows += [(300, None, None, None, "d", 1, "w"), (301, None, "b", "", "d", 1, "w"), (301, None, "a", "", "d", 1, "w")]
    rows += [(302, 1, "r", "long " * 5_000, "d", 1, "w"), (302, 1, "r", "long " * 5_000, "d", 1, "w"), (None, 1, "r", "x", "d", 1, "w")]
    return rows


@pytest.mark.parametrize("window", [1024, 4])
def test_equals_a_dictionary(spark, monkeypatch, window):
    monkeypatch.setattr(trie, "WINDOW_DEPTHS", window)
    rows = talks()
    assert rows_of(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_no_conversations(spark):
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_only_turnless_conversations(spark):
    # 1 borrows from an absent conversation and loses its own only turn (crc32("1") % 4 = 3)
    assert zlib.crc32(b"1") % 4 == 3
    rows = [(1, 0, "user", "hello", "d", 1, "w")]
    found = rows_of(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)))
    assert found == brute(rows) and found[0][:7] == (1, 0, None, 1, 0, 1, 0)


def test_one_conversation_holds_most_rows(spark):
    rows = [(7, t, "user", f"line {t % 5}", "d", 1, "w") for t in range(1_500)] + [(c, 0, "user", "line 0", "d", 1, "w") for c in range(100, 120)]
    rows += [(8, t, "user", f"line {t % 5}", "d", 1, "w") for t in range(1_400)]
    assert rows_of(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_digest_of_ends_in_pieces(spark):
    """Ids of one node that come in several stretches hash as one list."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        ends = spark.createDataFrame([(bytearray(b"k"), i) for i in range(1, 95)] + [(bytearray(b"l"), 5)], "key binary, conv long")
        found = {bytes(r.key): r.ends_sha256 for r in trie._end_digests(ends).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert found == {
        b"k": hashlib.sha256(",".join(map(str, range(1, 95))).encode()).hexdigest(),
        b"l": hashlib.sha256(b"5").hexdigest(),
    }
