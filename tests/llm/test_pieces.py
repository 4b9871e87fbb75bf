import public_tokenizers
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F

from logloom.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture()
def vocabulary(spark):
    return pieces.Vocabulary(spark, PATH)


def encoded(docs, vocabulary, **options):
    found = pieces.assemble(pieces.encode(docs, vocabulary, **options))
    return {r.row: (r.ids, r.text) for r in found.withColumn("text", pieces.decode(F.col("ids"), vocabulary)).collect()}


def test_every_piece_and_runs_of_spaces_as_the_library(spark, vocabulary):
    texts = [r.piece.replace("▁", " ") for r in vocabulary.pieces.collect()][::7]
    texts += [" " * n + "foo" for n in range(40)] + ["a" + " " * n for n in range(40)]
    texts += ["\u0001a\u0002 b\u0000 <s> <0x0A>", "日本語 👍🏽 x\ny\t.", "x" * 3000, "abc" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    got = encoded(docs, vocabulary)
    for i, text in enumerate(texts):
        assert got[i] == (MODEL.encode(text), text) if text else i not in got


def test_documents_as_the_library_on_both_tiers(documents, vocabulary):
    docs = documents.select(F.col("doc_id").alias("row"), "text")
    got = encoded(docs, vocabulary, entries=50)
    for doc in docs.collect():
        assert got.get(doc.row, ([], ""))[0] == MODEL.encode(doc.text or "")


def test_figures_of_odd_documents(odd_docs, no_docs):
    rows = pieces.encoded_documents(odd_docs, PATH)
    assert "text" not in rows.columns and "hits" in rows.columns and rows.count() == odd_docs.count()
    counts = sorted((r.doc_id or 0, r.n_pieces) for r in rows.collect())
    assert counts == sorted((r.doc_id or 0, len(MODEL.encode(r.text or ""))) for r in odd_docs.collect())
    assert all(r.round_trip for r in rows.collect())
    assert pieces.piece_counts(no_docs, PATH).count() == 0


def test_documents_with_patches_as_the_library(spark, documents):
    docs = documents.select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id < 5")).unionByName(spark.createDataFrame([(-1, "zq " * 4000 + "qz"), (None, "né\u0001")], docs.schema))
    rows = pieces.encoded_documents(docs, PATH, entries=40).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    assert all(r.ids == MODEL.encode(texts[r.doc_id]) for r in rows)
    few = docs.filter("doc_id is null or doc_id < 3")
    assert all(r.ids == MODEL.encode(texts[r.doc_id]) for r in pieces.encoded_documents(few, PATH, entries=0).collect())


def test_ids_and_round_trip_of_documents(spark, documents):
    texts = [(r.doc_id, r.text) for r in documents.limit(60).collect()]
    texts += [(-1, None), (-2, ""), (-3, "a\u2581b \u2581"), (-4, "a b  "), (-4, "\u0001日本\u0002")]
    rows = pieces.piece_counts(spark.createDataFrame(texts, "doc_id long, text string"), PATH).collect()
    assert sorted((r.doc_id, r.ids) for r in rows) == sorted((i, MODEL.encode(t or "")) for i, t in texts)
    assert [r.doc_id for r in rows if not r.round_trip] == [-3]
    assert all(r.n_pieces == len(r.ids) for r in rows)


def test_units_cut_to_parts_and_one_way_to_make_a_piece(spark, vocabulary):
    ranks = {"ab": 0, "bc": 1, "abc": 2, "abcd": 3, "a": 4, "b": 5, "c": 6, "d": 7}
    assert pieces.halves("abcd", ranks) == ["abc", "d"] and pieces.halves("abc", ranks) == ["ab", "c"] and pieces.halves("bcd", ranks) is None
    assert all(pieces.cutter(pieces.UNITS)(t) == regex.findall(pieces.UNITS, t) for t in ("▁▁aé1▁▁", "▁日本x!?▁\n", "▁𝒜a𝒜1▁👍🏽", ""))
    # Characters that no piece holds side by side, of which one has no piece at all.
    texts = ["qжqж zqж", "\U000f0001a", "aжa" * 200, "жq ࠁ ퟿"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for entries in (0, 3, 300):
        rows = pieces.encoded_documents(docs, PATH, entries=entries).collect()
        assert all(r.ids == MODEL.encode(texts[r.doc_id]) and r.round_trip for r in rows) and len(rows) == 4


def test_edges_of_a_unit_travel_with_it_once(spark, vocabulary):
    units = spark.createDataFrame([("▁the", 7), ("x", 8), ("ж\u0001", 9)], "unit string, tag int")
    edges = pieces.lattice(units, vocabulary)
    # One exchange at most, which groups the edges; units are not read a second time for those without any.
    plan = edges._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    got = {r.unit: r for r in pieces.encode_units(units, vocabulary).collect()}
    assert {u: r.tag for u, r in got.items()} == {"▁the": 7, "x": 8, "ж\u0001": 9}
    assert got["▁the"].ids == MODEL.encode("the")


def test_texts_are_cut_once_and_drafts_shuffled_once(spark, documents):
    rows = pieces.piece_counts(documents, PATH)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and plan.count("ArrowEvalPython") == 2
    # No digest of a text is worked out again for each of its units.
    assert "sha2" not in plan.split("Exchange hashpartitioning")[0]


def test_units_without_an_entry_share_lines(spark):
    assert pieces.lines_of([]) == [""] and pieces.lines_of(["a", "bc"]) == [f"a{pieces.GAP}bc"]
    long = "x" * (pieces.LINE + 1)
    assert pieces.lines_of(["a", long, "b"]) == ["a", long, "b"]
    parts = [f"unit{i}" for i in range(200)]
    lines = pieces.lines_of(parts)
    assert pieces.GAP.join(lines).split(pieces.GAP) == parts and max(map(len, lines)) <= pieces.LINE < sum(map(len, lines))
    # The character between units in texts, repeated rows, empty and long ones among them.
    texts = [pieces.GAP, f"a{pieces.GAP}b {pieces.GAP * 3}", "", "zqxj " * 300 + "jxqz", "", "zqxj " * 300 + "jxqz", f"zqxj{pieces.GAP}", "жqж" * 90]
    docs = spark.createDataFrame([(1, t) for t in texts], "`odd.name` int, text string")
    for entries in (0, 2, 1000):
        rows = pieces.encoded_documents(docs, PATH, entries=entries).collect()
        assert rows[0][0] == 1 and all(r.round_trip for r in rows)
        assert sorted(r.ids for r in rows) == sorted(MODEL.encode(t) for t in texts)


def test_drafts_are_dealt_out_to_as_many_tasks_as_asked(spark, documents):
    rows = pieces.encoded_documents(documents.select("doc_id", "text"), PATH, partitions=37)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and ", 37)" in plan
