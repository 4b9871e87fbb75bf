"""SentencePiece encoding and decoding on a relational lattice.

A text is normalised as the model says (blanks become ``▁``, one in front) and cut into
units that no piece reaches across. All substrings of a unit up to the longest piece are
exploded and equi-joined to the piece table: those are the edges of its lattice. They
are grouped by unit, and a higher-order ``aggregate`` folds them, best score first, over
the unit's characters: every edge joins the two neighbouring tokens it is made of. For a
byte-pair model this is the model's own rule; the highest sum of scores, as in a unigram
model, is a different segmentation and would not give the model's ids. While folded, a
token is one character, whose code is the rank of its piece.

Units frequent in a sample of rows are encoded once: they form a dictionary of bounded
size that is broadcast. ``encode`` shuffles the others by unit; whole documents keep them,
several in one lattice, and need one shuffle of their drafts. Characters without a piece
become the model's byte pieces. The encoding runs on DataFrame functions; whole
documents are put together from encoded units on Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.batches import free_name, small_batches
from logloom.session import materialize

SPACE = "▁"
# Letters, other characters, or nothing after a run of spaces.
UNITS = rf"{SPACE}*[\p{{L}}\p{{M}}]+|{SPACE}*[^\p{{L}}\p{{M}}{SPACE}]+|{SPACE}+"
# Without regard to letters.
WORDS = rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
# Characters of tokens: three bytes each, up to the surrogates.
FIRST, LAST = 0x800, 0xD7FF
# Between units that share a lattice: a character no piece holds, and no code of a token.
GAP = "\ufdd0"
# Characters of such a lattice; a longer unit has one of its own.
LINE = 100
# Characters of texts that are cut at a time, and texts that are put together at a time.
MANY, FEW = 2_000_000, 250
# Bytes of a digest that tells whether a text came back.
DIGEST = 12


class Vocabulary:
    """The piece table of a byte-pair model file with byte fallback."""

    def __init__(self, spark: SparkSession, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("a byte-pair model with identity normalisation and a dummy prefix is needed")
        pieces = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type in (1, 4)]
        # Best score first; runs of spaces last, longest first, because they grow from the left.
        runs = {p for p, _, _ in pieces if len(p) > 1 and not p.strip(SPACE)}
        order = sorted(pieces, key=lambda p: (p[0] in runs, -len(p[0]) if p[0] in runs else -p[2], p[1]))
        in_bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        if len(in_bytes) < 256:
            raise ValueError("the model has no byte pieces")
        if FIRST + len(order) + 256 > LAST:
            raise ValueError("the model has too many pieces for one character each")
        if any(GAP in p for p, _, _ in pieces):
            raise ValueError("the model has a piece with the character that stands between units")
        self.longest = max(len(p) for p, _, _ in pieces)
        self.spark = spark
        ranks = {p: rank for rank, (p, _, _) in enumerate(order)}
        code = lambda p: chr(FIRST + ranks[p])
        self.single = "".join(p for p in ranks if len(p) == 1)
        self.single_codes = "".join(map(code, self.single))
        self.byte_codes = [chr(FIRST + len(order) + b) for b in range(256)]
        # The id of every code.
        self.ids = [i for _, i, _ in order] + [in_bytes[b] for b in range(256)]
        self.gap_ids = [in_bytes[b] for b in GAP.encode()]
        # A piece as an edge: its rank, which finds its code and those of the tokens it is made of in ``joins``.
        made = {p: [SPACE] * len(p) if p in runs else halves(p, ranks) for p in ranks if len(p) > 1}
        rows = [(p, ranks[p]) for p, parts in made.items() if parts]
        self.pieces = spark.createDataFrame(rows, "piece string, edge int")
        self.joins = [code(p) + "".join(map(code, made.get(p) or [])) for p in ranks]
        # Neighbouring characters that no piece holds: units can be cut between them.
        self.pairs = {p[i : i + 2] for p in ranks for i in range(len(p) - 1)}
        every = spark.createDataFrame([(p,) for p in ranks], "piece string")
        across = every.filter(F.size(F.regexp_extract_all("piece", F.lit(UNITS), 0)) != 1).filter("length(piece) > 1")
        # A piece that reaches across units must not exist, else they are no units; neither for Spark's patterns nor for Python's.
        held = all(cutter(UNITS)(p) == [p] for p in ranks)
        self.units = UNITS if held and across.limit(1).count() == 0 else WORDS
        # What every id stands for.
        self.raw = [
            bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(SPACE, " ").encode() if p.type in (1, 4) else b"" for p in model.pieces
        ]
        self.hex = F.split(F.lit(",".join(x.hex() for x in self.raw)), ",")

    def decoded(self, ids: Column) -> Column:
        """Pieces joined, bytes put together, spaces back."""
        return F.unhex(F.concat_ws("", F.transform(ids, lambda i: F.element_at(self.hex, i + 1)))).cast("string")


def halves(piece: str, ranks: dict[str, int]) -> list[str] | None:
    """The two tokens that the model joins last when it makes ``piece`` of characters; None if it never does.

    No other two can make it, in any text: until the piece is made, no token reaches across
    its ends, so what happens between them is what happens to the piece alone.
    """
    parts, last = list(piece), -1
    while len(parts) > 1:
        rank, i = min((ranks.get(a + b, len(ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == len(ranks):
            return None
        if rank < last:
            raise ValueError(f"{piece!r} is made of pieces with scores below its own")
        if len(parts) == 2:
            return parts
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        last = rank
    return None


@cache
def cutter(pattern: str) -> Callable[[str], list[str]]:
    """Function that cuts a normalised text as ``pattern`` says."""
    import regex

    whole = regex.compile(pattern).findall
    if pattern != UNITS:
        return whole
    # The same for characters of 16 bits, written out for ``re``: about half the time.
    kinds = [unicodedata.category(chr(i))[0] in "LM" for i in range(0x10000)] + [False]
    edges = [i for i in range(len(kinds)) if kinds[i] != (i > 0 and kinds[i - 1])]
    letters = "".join(f"\\u{a:04x}-\\u{b - 1:04x}" for a, b in zip(edges[::2], edges[1::2], strict=True))
    common = re.compile(rf"{SPACE}*+(?:[{letters}]++|[^{letters}{SPACE}]++)|{SPACE}++").findall
    higher = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: whole(text) if higher(text) else common(text)


def units_of(text: Column, vocabulary: Vocabulary) -> Column:
    """Units of the normalised text; null and empty texts have none."""
    whole = F.concat(F.lit(SPACE), F.replace(text, F.lit(" "), F.lit(SPACE)))
    return F.when(F.length(text) > 0, F.regexp_extract_all(whole, F.lit(vocabulary.units), 0)).otherwise(F.array().cast("array<string>"))


def lattice(units: DataFrame, vocabulary: Vocabulary, by: tuple[str, ...] = ("unit",)) -> DataFrame:
    """``units``, whose columns ``by`` tell rows apart, with ``edges``: ranks of the pieces that occur in a unit, in order."""
    rest = [c for c in units.columns if c not in by]
    at, n, ahead, found, piece, edge, code, own = (free_name(units, c) for c in ("at", "n_characters", "ahead", "found", "piece", "edge", "code", "own"))
    upto = lambda end: F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), end)))
    starts = units.select("*", upto(F.length("unit")).alias(at))
    # What pieces can hold from here on; the first character of each unit alone carries the other columns, in one, since edges are many.
    window = F.substring_index(F.col("unit").substr(F.col(at), F.lit(vocabulary.longest)), GAP, 1)
    starts = starts.select(*by, at, window.alias(ahead), F.when(F.col(at) == 1, F.struct(F.lit(1), *rest)).alias(own))
    # It stays, whatever it is.
    places = starts.select("*", upto(F.length(ahead)).alias(n)).filter((F.col(n) > 1) | (F.col(at) == 1))
    some = F.col(ahead).substr(F.lit(1), F.col(n)).alias(found)
    spans = places.select(*by, n, some, F.when(F.col(n) == 1, F.col(own)).alias(own))
    # Numbers are joined faster than strings, which are compared afterwards.
    table = vocabulary.pieces.select(F.xxhash64("piece").alias(code), F.col("piece").alias(piece), F.col("edge").alias(edge))
    joined = spans.withColumn(code, F.xxhash64(found)).join(F.broadcast(table), code, "left")  # bounded: the model's vocabulary
    edges = joined.withColumn(edge, F.when(F.col(found) == F.col(piece), F.col(edge))).filter(F.col(edge).isNotNull() | (F.col(n) == 1))
    whole = edges.groupBy(*by).agg(F.first(own, ignorenulls=True).alias(own), F.sort_array(F.collect_set(edge)).alias("edges"))
    return whole.select(*by, *[F.col(own)[c].alias(c) for c in rest], "edges")


def fold(edges: DataFrame, vocabulary: Vocabulary, between: str = "") -> DataFrame:
    """``edges`` folded to ``codes``: the tokens of every unit, a character each. The character ``between`` stays."""
    in_bytes = F.split(F.lit(",".join(vocabulary.byte_codes)), ",")

    def as_bytes(character: Column) -> Column:
        raw = character.cast("binary")
        values = F.transform(F.sequence(F.lit(1), F.octet_length(raw)), lambda i: F.conv(F.hex(F.substr(raw, i, F.lit(1))), 16, 10).cast("int"))
        return F.concat_ws("", F.transform(values, lambda b: F.element_at(in_bytes, b + 1)))

    strange = lambda text: F.translate(text, vocabulary.single + between, "") != ""
    mapped = lambda text: F.translate(text, vocabulary.single, vocabulary.single_codes)
    characters = F.regexp_extract_all("unit", F.lit("(?s)."), 0)
    slowly = F.concat_ws("", F.transform(characters, lambda c: F.when(strange(c), as_bytes(c)).otherwise(mapped(c))))
    begin = F.when(strange(F.col("unit")), slowly).otherwise(mapped(F.col("unit")))
    made = F.split(F.lit(",".join(x[:1] for x in vocabulary.joins)), ",")
    of = F.split(F.lit(",".join(x[1:] for x in vocabulary.joins)), ",")
    state = F.aggregate("edges", begin, lambda s, e: F.replace(s, F.get(of, e), F.get(made, e)))
    return edges.select(*[c for c in edges.columns if c != "edges"], state.alias("codes"))


def encode_units(units: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Distinct units, one row each, with ``codes`` and ``ids``; other columns stay."""
    ids = F.split(F.lit(",".join(map(str, vocabulary.ids))), ",").cast("array<int>")
    characters = F.regexp_extract_all("codes", F.lit("(?s)."), 0)
    return fold(lattice(units, vocabulary), vocabulary).withColumn("ids", F.transform(characters, lambda c: F.element_at(ids, F.ascii(c) - FIRST + 1)))


def checked(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(unit, ids, intact); ``intact``: the ids decode to the unit."""
    return encoded.select("unit", "ids", (vocabulary.decoded(F.col("ids")) == F.replace("unit", F.lit(SPACE), F.lit(" "))).alias("intact"))


def some_texts(texts: pa.Array) -> Iterator[list[str]]:
    """``texts`` in lists of one text, or of more with about ``MANY`` characters in all; null is empty."""
    some, room = [], MANY
    for text in texts:
        some.append(text.as_py() or "")
        room -= len(some[-1])
        if room < 0:
            yield some
            some, room = [], MANY
    if some:
        yield some


def units_in(text: str, pattern: str) -> list[str]:
    """Units of a text, cut here, because a list of them costs more on its way from Spark than the cutting."""
    return cutter(pattern)(SPACE + text.replace(" ", SPACE)) if text else []


def counts_of(text: Column, vocabulary: Vocabulary) -> Column:
    """Units of texts with their number, (unit, n), those of some texts together with one of them."""
    pattern = vocabulary.units

    def counts(texts: list[str]) -> list[list[tuple[str, int]]]:
        units = pa.concat_arrays([pa.array(units_in(t, pattern), pa.string()) for t in texts])
        found = units.value_counts()
        return [list(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True)), *[[]] * (len(texts) - 1)]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(chain.from_iterable(map(counts, some_texts(texts))), pa.list_(pa.struct([("unit", pa.string()), ("n", pa.int64())])))
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, "array<struct<unit: string, n: long>>")(text)


def frequent_units(docs: DataFrame, text: str, vocabulary: Vocabulary, sample_rows: int, entries: int) -> DataFrame:
    """(unit, n, ids) of at most ``entries`` units, the most frequent of about ``sample_rows`` rows."""
    small_batches(docs.sparkSession)
    rows = max(1, docs.count())
    sample = docs if rows <= sample_rows else docs.sample(sample_rows / rows, 5)
    counts = sample.select(F.explode(counts_of(F.col(text), vocabulary)).alias("x"))
    frequent = counts.groupBy(F.col("x.unit").alias("unit")).agg(F.sum("x.n").alias("n"))
    frequent = frequent.orderBy(F.desc("n"), "unit").limit(entries)
    return materialize(encode_units(materialize(frequent), vocabulary).select("unit", "n", "ids"))


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    row: str = "row",
    sample_rows: int = 20_000,
    entries: int = 150_000,
) -> DataFrame:
    """(row, position, unit, ids, intact): every unit of every text with its piece ids, in long form.

    ``row`` names a column of ``docs`` that tells its rows apart. Texts without units
    (null, empty) have no rows. The ids of a text are those of its units by position:
    ``assemble`` puts them in one array. The dictionary is learned from about
    ``sample_rows`` rows and has at most ``entries`` units; it changes the speed alone.
    """
    split = units_of(F.col(text), vocabulary)
    dictionary = checked(frequent_units(docs, text, vocabulary, sample_rows, entries), vocabulary)
    units = docs.select(F.col(row).alias("row"), F.posexplode(split).alias("position", "unit"))
    tier = units.join(F.broadcast(dictionary), "unit", "left")  # bounded by ``entries``
    rare = materialize(tier.filter("ids is null").select("row", "position", "unit"))
    rest = checked(encode_units(rare.select("unit").distinct(), vocabulary), vocabulary)
    columns = ["row", "position", "unit", "ids", "intact"]
    return tier.filter("ids is not null").select(columns).unionByName(rare.join(rest, "unit").select(columns))


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """Text of an array of ids: its pieces decoded, without the blank in front."""
    return F.substr(vocabulary.decoded(ids), F.lit(2))


def assemble(encoded: DataFrame) -> DataFrame:
    """(row, ids): the ids of every text in order."""
    parts = encoded.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("position", "ids"))).alias("parts"))
    return parts.select("row", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))


def parts_of(unit: str, pairs: set[str]) -> list[str]:
    """``unit`` cut between characters that no piece holds as neighbours."""
    ends = [i for i, pair in enumerate(map(str.__add__, unit, unit[1:]), 1) if pair not in pairs]
    return [unit[a:b] for a, b in zip([0, *ends], [*ends, len(unit)], strict=True)] if ends else [unit]


def lines_of(parts: Iterable[str]) -> list[str]:
    """``parts`` in lines of at most ``LINE`` characters, longer parts each in a line; at least one line."""
    lines, room = [], 0
    for part in parts:
        if lines and room >= len(part):
            lines[-1].append(part)
        else:
            lines.append([part])
            room = LINE
        room -= len(part) + 1
    return [GAP.join(line) for line in lines] or [""]


def draft_of(text: Column, words: Broadcast, vocabulary: Vocabulary) -> Column:
    """Units of a text: their ``numbers`` (packed, see ``pack``), how many (``n_units``), and ``lines`` of the parts without an entry.

    ``words`` are the entries. A unit that is none is cut to parts; those that are none either
    are numbered after all entries in the order of their first place, which is their order in
    the lines. Arrow's lookup takes a fraction of the memory of a Python dictionary.
    """
    pattern, pairs = vocabulary.units, vocabulary.pairs

    def found_in(units: pa.Array, entries: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(units, value_set=entries), -1).to_numpy(zero_copy_only=False)

    def some(texts: list[str]) -> pa.Array:
        units = [pa.array(units_in(t, pattern), pa.string()) for t in texts]
        lengths = np.array(list(map(len, units)), np.int32)
        units = pa.concat_arrays(units)
        found = found_in(units, words.value)
        lost = np.flatnonzero(found < 0)
        parts = [parts_of(u, pairs) for u in units.take(pa.array(lost)).to_pylist()]
        n_parts = np.ones(len(units), np.int32)
        n_parts[lost] = list(map(len, parts))
        numbers = np.repeat(found, n_parts)
        parts = list(chain.from_iterable(parts))
        # Parts are few, so the entries are looked up in them.
        names = {p: i for i, p in enumerate(dict.fromkeys(parts))}
        place = found_in(words.value, pa.array(list(names), pa.string()))
        known = np.full(len(names), -1, np.int32)
        known[place[place >= 0]] = np.flatnonzero(place >= 0)
        numbers[numbers < 0] = missing = known[[names[p] for p in parts]] if parts else []
        # Where texts end among the parts, and the text of each part that is no entry.
        ends = np.concatenate([[0], np.cumsum(n_parts, dtype=np.int64)])[np.cumsum([0, *lengths])]
        rows = np.searchsorted(ends, np.flatnonzero(numbers < 0), "right") - 1
        own, none = [{} for _ in texts], len(words.value)
        unknown = np.flatnonzero(np.array(missing, np.int32) < 0).tolist()
        numbers[numbers < 0] = [own[r].setdefault(parts[i], none + len(own[r])) for r, i in zip(rows.tolist(), unknown, strict=True)]
        packed = [pack(numbers[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        columns = [pa.array(packed, pa.binary()), pa.array(lengths), pa.array(list(map(lines_of, own)), pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(columns, ["numbers", "n_units", "lines"])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            drafts = [some(x) for x in some_texts(texts)]
            yield pa.concat_arrays(drafts) if drafts else some([""])[:0]
            pa.default_memory_pool().release_unused()  # workers that wait would keep it

    return F.arrow_udf(run, "numbers binary, n_units int, lines array<string>")(text)


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits, lowest bytes first, compressed: a shuffle carries less than half."""
    planes = numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<i4").ravel()


def filled(packed: Column, codes: Column, entries: Broadcast) -> Column:
    """``ids`` of a draft, its units looked up in ``entries`` and in ``codes`` of its own ones (``GAP`` between them), and the ``digest`` of their text.

    ``entries`` holds the sizes of the dictionary's units, their ids one after the other, the
    id of every code, and what every id stands for.
    """

    def some(packs: list[bytes], lists: list[str]) -> pa.Array:
        sizes, flat, id_of, raw = entries.value
        none = len(sizes)
        numbers = list(map(unpack, packs))
        n_lost = np.array([x.count(GAP) + 1 if x else 0 for x in lists], np.int64)
        tokens = np.frombuffer("".join(x + GAP for x in lists if x).encode("utf-32-le"), "<u4").astype(np.int64)
        n_own = np.diff(np.flatnonzero(tokens == ord(GAP)), prepend=-1) - 1
        own = id_of[tokens[tokens != ord(GAP)] - FIRST]
        units = np.concatenate(numbers).astype(np.int64)
        n_units = np.array(list(map(len, numbers)), np.int64)
        # A text's own units come after those of the texts before it.
        units += np.where(units < none, 0, np.repeat(np.cumsum(n_lost) - n_lost, n_units))
        n = np.concatenate([sizes, n_own])
        every = np.concatenate([flat, own])
        starts, n = (np.cumsum(n) - n)[units], n[units]
        ids = every[np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())]
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum([0, *n_units])]
        plain = raw[ids].tolist()
        digests = [sha256(b"".join(plain[a:b])[1:]).digest()[:DIGEST] for a, b in zip(ends, ends[1:], strict=False)]
        values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        return pa.StructArray.from_arrays([values, pa.array(digests, pa.binary())], ["ids", "digest"])

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch in batches:
            packs, lists = (x.to_pylist() for x in batch)
            # A few at a time: the arrays in between take many times a draft's bytes.
            parts = [some(packs[i : i + FEW], lists[i : i + FEW]) for i in range(0, len(packs), FEW)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("digest", pa.binary())]))
            pa.default_memory_pool().release_unused()

    return F.arrow_udf(run, "ids array<int>, digest binary")(packed, codes)


def encoded_documents(docs: DataFrame, path: str, text: str = "text", sample_rows: int = 20_000, entries: int = 300_000, partitions: int | None = None) -> DataFrame:
    """``docs`` without their text, with ``ids``, ``n_units``, ``n_pieces`` and ``round_trip``.

    ``ids`` are the piece ids of the whole text in order; ``round_trip`` says whether ``decode``
    gives the text back, which it does not if the text holds the model's own sign for a
    blank. Null and empty texts have no pieces. Rows with repeated or null ids are encoded
    each by itself; columns called like the new ones are replaced.

    Texts are read and cut once and not shuffled. Each becomes a draft, the numbers of its
    units, with the units that the dictionary lacks in lines of a few; drafts are dealt out
    once, and what follows stays where they are: each line is encoded over its lattice, and
    its units go into their draft. Copies are dealt out by their other columns, so they do
    not meet. ``sample_rows`` and ``entries`` as in ``encode``; what they leave out is encoded
    for each text that holds it. A draft grows manyfold in the lattice, so more ``partitions``
    of drafts than Spark would take by itself mean less memory for each task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = Vocabulary(spark, path)
    known = frequent_units(docs, text, vocabulary, sample_rows, entries).toArrow()  # bounded by ``entries``
    # Frequent units get small numbers, which pack better.
    known = known.sort_by([("n", "descending"), ("unit", "ascending")])
    found, words = known["ids"].combine_chunks(), known["unit"].to_pylist()
    sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = found.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    if GAP not in words:  # no piece holds it, so it is always a part by itself, and in no line if it has an entry
        words, sizes, flat = [*words, GAP], np.append(sizes, len(vocabulary.gap_ids)), np.append(flat, np.array(vocabulary.gap_ids, np.int32))
    entered = spark.sparkContext.broadcast(pa.array(words, pa.string()))
    raw = np.array([*vocabulary.raw, None], dtype=object)[:-1]
    table = spark.sparkContext.broadcast((sizes, flat, np.array(vocabulary.ids, np.int32), raw))
    rest = [c for c in docs.columns if c not in (text, "ids", "n_units", "n_pieces", "round_trip")]
    digest = F.substring(F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)), 1, DIGEST)
    marked = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], digest.alias("digest"), draft_of(F.col(text), entered, vocabulary).alias("draft"))
    # Equal keys do no harm: rows are told apart after they are dealt out.
    hashed = [c for c, kind in marked.drop("draft").dtypes if "map<" not in kind and "variant" not in kind]
    doc = F.struct(*[f"c{i}" for i in range(len(rest))], "digest", "draft.numbers", "draft.n_units")
    dealt = marked.select(F.xxhash64(*hashed).alias("key"), doc.alias("doc"), F.col("draft.lines").alias("lines"))
    dealt = dealt.repartition(partitions, "key") if partitions else dealt.repartition("key")
    lines = dealt.withColumn("row", F.monotonically_increasing_id()).select("key", "row", "doc", F.posexplode("lines").alias("place", "unit"))
    lines = lines.withColumns({"doc": F.when(F.col("place") == 0, F.col("doc")), "line": F.monotonically_increasing_id()})
    tokens = fold(lattice(lines, vocabulary, ("key", "line")), vocabulary, GAP)
    every = F.transform(F.sort_array(F.collect_list(F.struct("place", "codes"))), lambda x: x["codes"])
    whole = tokens.groupBy("key", "row").agg(F.first("doc", ignorenulls=True).alias("doc"), F.concat_ws(GAP, every).alias("codes"))
    whole = whole.select("doc", filled(F.col("doc.numbers"), F.col("codes"), table).alias("text"))
    return whole.select(
        *[F.col(f"doc.c{i}").alias(c) for i, c in enumerate(rest)],
        "doc.n_units",
        F.size("text.ids").alias("n_pieces"),
        "text.ids",
        (F.col("text.digest") == F.col("doc.digest")).alias("round_trip"),
    )


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """Piece ids of every document, with their counts and whether they decode to it."""
    return encoded_documents(docs.select("doc_id", "text"), path)
