import re

import numpy as np
import xxhash

from logloom.llm import neardup
from logloom.llm.components import components


def brute_print(text, size):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """{id: smallest id reachable} for (id, fingerprint) pairs."""
    root = {i: i for i, _ in prints}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def test_documents_against_brute_force(spark, documents):
    rows = {r.doc_id: r for r in neardup.simhash_components(documents).collect()}
    prints = [(r.doc_id, brute_print(r.text, 3)) for r in documents.collect()]
    assert {i: int(r.fingerprint, 16) for i, r in rows.items()} == dict(prints)
    assert {i: r.component_id for i, r in rows.items()} == brute_components(prints, 3)


def test_links_of_chains_and_dense_groups(spark):
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 2**63, 60, dtype=np.int64)
    values = {int(s) for s in seeds} | {0, -1, 1, 3, 7, 15, 31}
    for s in seeds[:20]:  # walks of few bits, and a ball around one value
        at = int(s)
        for _ in range(30):
            at ^= int(np.bitwise_or.reduce(np.left_shift(1, rng.integers(0, 62, rng.integers(1, 6)))))
            values.add(at)
    values |= {int(seeds[0]) ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)}
    rows = [(v,) for v in values]
    for tile in (4096, 5):
        links = neardup.tile_links(spark.createDataFrame(rows, "fp long"), 3, tile)
        found = {r.node: r.root for r in components(links).collect()}
        want = brute_components([(v, v & (2**64 - 1)) for v in sorted(values)], 3)
        assert {v: found.get(v, v) for v in values} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5, 5), (None, 3), (2, 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(spark, odd_docs, no_docs):
    rows = neardup.simhash_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert {by[i].fingerprint for i in (1, 2, 3)} == {"0" * 16}
    assert {by[i].component_id for i in (1, 2, 3)} == {1}
    assert by[None].component_id is None and by[4].component_id == 4
    kept = neardup.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 7, 8]
    assert neardup.simhash_components(no_docs).count() == 0
    assert neardup.drop_near_duplicates(no_docs).count() == 0


def test_pipeline_stage_against_brute_force(spark, documents):
    import corpus_pipeline

    rng = np.random.default_rng(3)
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    at = max(texts) + 1
    for n in (60, 200, 600):  # edited copies, and copies of copies, on both sides of three bits
        words = [f"w{k}" for k in rng.integers(0, 5_000, n)]
        for share in (0.0, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05):
            copy = [f"e{rng.integers(10**6)}" if x < share else w for x, w in zip(rng.random(n), words)]
            texts[at], texts[at + 1] = " ".join(copy), " ".join(copy[: n - n // 200])
            at += 2
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect()}
    groups = brute_components([(i, brute_print(t, 3)) for i, t in sorted(texts.items())], 3)
    assert kept == set(groups.values()) and len(kept) < len(texts)


def test_repeated_ids_with_different_texts(spark):
    def words(name):
        return " ".join(f"{name}{i}" for i in range(40))

    rows = [(1, words("a")), (2, words("b")), (2, words("a")), (2, words("c")), (3, words("b")), (3, words("B")), (4, words("c"))]
    rows += [(4, words("d")), (5, words("d").upper()), (6, words("e")), (6, words("e")), (None, words("a")), (None, words("f"))]
    kept = neardup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(1, words("a")), (2, words("b")), (2, words("c")), (4, words("d")), (6, words("e")), (None, words("f"))]
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted((i or 0, t) for i, t in want)
