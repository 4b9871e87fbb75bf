"""Packing of documents into sequences of a fixed number of tokens.

First-fit decreasing, run by itself in random groups of a task's documents: the bins of a
group are the leaves of a tournament tree whose nodes hold the largest capacity below
them, so the leftmost bin with room is found on one way down. Documents longer than a
sequence fill whole sequences with their beginnings; only their remainders are placed.

What first-fit leaves open is closed by cuts: the emptiest bins are cut up to fill the
gaps of the fullest, and the one bin that is left over is cut into powers of two, which
need no padding. Packing is map-only: a group holds remainders of one task, no text is
shuffled, and at most ``spread * group`` remainders are held at a time.
"""

from __future__ import annotations

import json
import random
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.batches import small_batches

COLUMNS = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
Piece = tuple[int, int, np.ndarray]  # number of the document in its group, start, ids


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text -> ids of the byte-level BPE of the tokenizer file ``path``, special strings as one id each.

    The vocabulary of the file is handed to tiktoken, whose ids are the same wherever ids follow the order
    of the merges (checked here), and which takes a third of the time of the tokenizers library.
    """
    import tiktoken

    from logloom.llm.tokencount import PATTERN

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["model"]["merges"]]
    ids = [model["model"]["vocab"][m] for m in merged]
    if model["model"]["type"] != "BPE" or ids != sorted(ids) or model["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError(f"{path} is not a byte-level BPE with ids in the order of its merges")
    encode = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special).encode_to_numpy
    return lambda text: encode(text, allowed_special="all")


def first_fit(sizes: list[int], limit: int) -> list[list[int]]:
    """Bins of positions in ``sizes``, which is in decreasing order, as first-fit fills bins of ``limit``."""
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [limit] * (2 * leaves)
    bins: list[list[int]] = []
    for at, size in enumerate(sizes):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        if node - leaves == len(bins):
            bins.append([])
        bins[node - leaves].append(at)
        room[node] -= size
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins


def powers(n: int) -> list[int]:
    """Powers of two that add up to ``n``, the largest first."""
    return [1 << i for i in reversed(range(n.bit_length())) if n >> i & 1]


def pack(pieces: list[Piece], limit: int) -> list[list[Piece]]:
    """Sequences of the pieces, each of ``limit`` ids or of a power of two; pieces are cut where that closes a gap."""
    pieces = sorted(pieces, key=lambda p: (-len(p[2]), p[0], p[1]))
    bins = [[pieces[at] for at in held] for held in first_fit([len(p[2]) for p in pieces], limit)]
    used = [sum(len(p[2]) for p in held) for held in bins]
    full = [held for held, n in zip(bins, used, strict=True) if n == limit]
    rest = sorted(((n, i) for i, n in enumerate(used) if n < limit), reverse=True)
    open_bins = [(n, list(bins[i])) for n, i in rest]
    while len(open_bins) > 1:
        (n, held), (m, donor) = open_bins[0], open_bins[-1]
        number, start, ids = donor.pop()
        gap = limit - n
        held.append((number, start, ids[:gap]))
        if len(ids) > gap:
            donor.append((number, start + gap, ids[gap:]))
        moved = min(gap, len(ids))
        if n + moved == limit:
            full.append(held)
            open_bins.pop(0)
        else:
            open_bins[0] = (n + moved, held)
        if m == moved:
            open_bins.pop()
        else:
            open_bins[-1] = (m - moved, donor)
    for n, held in open_bins:
        for size in powers(n):
            sequence: list[Piece] = []
            while size:
                number, start, ids = held.pop(0)
                sequence.append((number, start, ids[:size]))
                if len(ids) > size:
                    held.insert(0, (number, start + size, ids[size:]))
                size -= len(sequence[-1][2])
            full.append(sequence)
    return full


class _Group:
    """Documents whose remainders wait to be placed together."""

    def __init__(self):
        self.ids, self.tokens, self.pieces = [], [], []

    def add(self, doc_id, tokens: int, piece: Piece | None) -> None:
        if piece is not None:
            self.pieces.append((len(self.ids), *piece[1:]))
            self.ids.append(doc_id)
            self.tokens.append(tokens)


def _rows(sequences: list[list[Piece]], ids: list, tokens: list[int], first: int) -> list[tuple]:
    out = []
    for number, sequence in enumerate(sequences, first):
        offset = 0
        for doc, start, held in sequence:
            out.append((ids[doc], start, len(held), held.astype("<u4").tobytes(), tokens[doc], number, offset))
            offset += len(held)
    return out


def _packer(path: str, limit: int, end: int, group: int, spread: int, doc_id: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        part = TaskContext.get().partitionId()
        chance, number = random.Random(part), part << 33
        groups = [_Group() for _ in range(spread)]

        def written(sequences: list[list[Piece]], ids: list, tokens: list[int], kind: pa.DataType) -> pa.RecordBatch:
            nonlocal number
            columns = zip(*_rows(sequences, ids, tokens, number), strict=True)
            number += len(sequences)
            kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=[doc_id, *COLUMNS])

        def close(held: _Group) -> pa.RecordBatch:
            return written(pack(held.pieces, limit), held.ids, held.tokens, kind)

        for batch in batches:
            kind = batch.column(0).type
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                ids = np.append(encode(text) if text else np.array([], dtype=np.uint32), np.uint32(end)).astype(np.uint32)
                whole = len(ids) // limit
                if whole:
                    parts = [[(0, i * limit, ids[i * limit : (i + 1) * limit])] for i in range(whole)]
                    yield written(parts, [own], [len(ids)], kind)
                if len(ids) > whole * limit:
                    at = chance.randrange(spread)
                    groups[at].add(own, len(ids), (0, whole * limit, ids[whole * limit :].copy()))
                    if len(groups[at].pieces) >= group:
                        yield close(groups[at])
                        groups[at] = _Group()
        for held in groups:
            if held.pieces:
                yield close(held)

    return run


def pack_documents(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 1024,
    end: int = 0,
    group: int = 4096,
    spread: int = 2,
) -> DataFrame:
    """Pieces of all documents in sequences of ``limit`` ids, or of a power of two of them.

    One row per piece: id, ``start`` (ids of its document before it), ``length``, ``ids`` (little-endian unsigned
    32-bit numbers), ``doc_tokens`` (ids of the document), ``sequence_id`` and ``offset`` there; the pieces of a
    sequence lie side by side from 0. A document is the ids of its whole text under the tokenizer file ``path``
    and then ``end``; null and empty texts are ``end`` alone. Every id lies in exactly one piece. Rows are
    documents of their own, whatever their ids: repeated rows are packed as often as they stand there, a null id
    stays null. Other columns are not looked at. An empty table gives no rows.

    Every task deals its documents at random to ``spread`` open groups of at most ``group`` documents, so a larger
    table has more groups, not larger ones; sequences are numbered by partition. Of a group, every sequence is full
    but for at most log2(``limit``) that hold a power of two. The file must be readable on every executor.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"`{doc_id}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(_packer(path, limit, end, group, spread, doc_id), schema)


def packed_documents(docs: DataFrame, path: str) -> DataFrame:
    """Pieces of sequences of 1024 ids, with the checksum of their ids."""
    pieces = pack_documents(docs, path)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
