"""Packing: a plain first-fit, whole sequences, and every id in one piece."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from logloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a <|endoftext|> b", "x" * 5000, " " * 300, "é日本 👍🏽     ñ", "\u0000\u001c12 +1\x85  @", "½ Ⅷ² '`s don't  \n\n x", "a\n \n  b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_library_s(library):
    encode, draw = packing.encoder(PATH), random.Random(3)
    odd = ODD + ["".join(draw.choice("aZ9 .,'\n\t éß中👍́‍²") for _ in range(60)) for _ in range(300)]
    for text in odd:
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids, text


def plain_first_fit(sizes, limit):
    bins = []
    for at, size in enumerate(sizes):
        for held in bins:
            if sum(sizes[i] for i in held) + size <= limit:
                held.append(at)
                break
        else:
            bins.append([at])
    return bins


@pytest.mark.parametrize("n", [0, 1, 2, 3, 64, 65, 400])
def test_tree_finds_the_first_bin(n):
    sizes = sorted((random.Random(n).choice([1, 7, 31, 32, random.Random(n + i).randrange(1, 64)]) for i in range(n)), reverse=True)
    assert packing.first_fit(sizes, 64) == plain_first_fit(sizes, 64)


@pytest.mark.parametrize("limit", [64, 100])
def test_no_padding(limit):
    draw = random.Random(5)
    pieces = [(i, 0, np.arange(draw.randrange(1, limit), dtype=np.uint32)) for i in range(300)]
    sizes = [sum(len(p[2]) for p in s) for s in packing.pack(pieces, limit)]
    assert all(n == limit or n & (n - 1) == 0 for n in sizes)
    assert sum(sizes) == sum(len(p[2]) for p in pieces) and sum(n != limit for n in sizes) <= limit.bit_length()


def check(rows, docs, library):
    """Pieces make up the documents, and sequences have no gaps."""
    want = sorted(
        (str(i), tuple([*library.encode(t, add_special_tokens=False).ids, 0] if t else [0])) for i, t in docs
    )
    sequences, documents, left = {}, [], {}
    for r in rows:
        ids = tuple(np.frombuffer(bytes(r.ids), dtype="<u4").tolist())
        assert len(ids) == r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        left.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, ids))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end == 1024 or (end < 1024 and end & (end - 1) == 0)
    for (name, size), pieces in left.items():
        copies = [x for x in want if x[0] == name and len(x[1]) == size]
        # rows with one id and size: every start is there once for each of them
        assert sum(len(ids) for _, ids in pieces) == size * len(copies)
        if len(copies) == 1:
            assert tuple(i for _, ids in sorted(pieces) for i in ids) == copies[0][1]
        documents += copies
    assert sorted(documents) == want


def test_odd_documents(spark, odd_docs, library):
    docs = odd_docs.select("doc_id", "text")
    rows = packing.pack_documents(odd_docs, PATH, group=3).collect()
    check(rows, [tuple(r) for r in docs.collect()], library)


def test_ids_are_exact_beside_nulls(spark):
    docs = spark.createDataFrame([(2**62 + 1, "a"), (None, "b")], "doc_id long, text string").coalesce(1)
    assert {r.doc_id for r in packing.pack_documents(docs, PATH).collect()} == {2**62 + 1, None}


def test_all_documents(spark, documents, library):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    check(packing.pack_documents(documents, PATH).collect(), docs, library)
    digests = packing.packed_documents(documents, PATH).collect()
    ids = {i: [*library.encode(t, add_special_tokens=False).ids, 0] for i, t in docs if t}
    for r in digests:
        if r.doc_id in ids:
            part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])


def test_no_documents(spark, no_docs):
    assert packing.packed_documents(no_docs, PATH).count() == 0


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        packing.encoder(public_tokenizers.path("word_bpe_49k.json"))
