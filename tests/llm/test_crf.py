import itertools

import numpy as np
import pytest

from logloom.llm import crf, langid, toxicity


def brute(scores, first, model):
    """Marginals by adding up every labelling of each text."""
    out = np.zeros_like(scores)
    starts = [*np.flatnonzero(first), len(first)]
    for a, b in zip(starts, starts[1:]):
        for path in itertools.product(range(scores.shape[1]), repeat=b - a):
            weight = model.start[path[0]] + sum(scores[a + t, y] for t, y in enumerate(path))
            weight = np.exp(weight + sum(model.step[x, y] for x, y in itertools.pairwise(path)))
            for t, y in enumerate(path):
                out[a + t, y] += weight
    return out / out.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("n", [1, 2, 5, 7])
def test_forward_backward_against_all_paths(n):
    rng = np.random.default_rng(n)
    model = crf.Model(list("abc"), None, rng.normal(size=(3, 3)), rng.normal(size=3))
    scores = rng.normal(size=(2 * n + 1, 3))
    first = np.zeros(len(scores), dtype=bool)
    first[[0, n]] = True
    got, moved = crf.marginals(scores, first, model)
    assert np.allclose(got, brute(scores, first, model))
    assert np.isclose(moved.sum(), (~first).sum())


def test_tagging_counts_no_transitions():
    rng = np.random.default_rng(3)
    model = crf.Model(list("abc"), None, rng.normal(size=(3, 3)), rng.normal(size=3))
    scores, first = rng.normal(size=(9, 3)), np.arange(9) % 4 == 0
    got, moved = crf.marginals(scores, first, model, moves=False)
    assert np.array_equal(got, crf.marginals(scores, first, model)[0]) and not moved.any()


def test_scores_do_not_depend_on_the_batch():
    model = crf.fit([(["aa", "ab"], [0, 0]), (["zz", "zy", "ab"], [1, 1, 0])], ["x", "y"], rounds=10)
    texts = [["aa"], [], ["zz", "ab", "neu"], ["aa"] * 500]
    together = crf.Tagger(model).tag(texts)
    for text, probs in zip(texts, together, strict=True):
        assert np.allclose(probs, crf.Tagger(model, limit=1).tag([text])[0], atol=1e-6)


def test_languages_of_held_out_documents(spark, documents):
    found = langid.language_ids(documents).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    held = [r for r in found if r.held_out and r.lang_pred != "und"]
    assert len(found) == len(truth) and len(held) > 40
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_code_switched_words():
    rng = np.random.default_rng(0)
    def text(stems):
        return " ".join(rng.choice(stems) + rng.choice(["in", "er"]) for _ in range(60))
    sample = [(lang, text(stems)) for lang, stems in (("p", ["alo", "amo"]), ("q", ["zek", "zuk"])) for _ in range(5)]
    tagger = crf.Tagger(langid.train(sample))
    probs = tagger.tag([["alor", "amoer", "zekin", "zukzek", "amo"]])[0]
    assert list(probs.argmax(axis=1)) == [0, 0, 1, 1, 0]


def test_odd_languages(spark, odd_docs, no_docs, documents):
    rows = langid.identify(odd_docs, documents, out="n_words")
    assert rows.columns == odd_docs.columns
    by = {r.doc_id: r.n_words for r in rows.collect()}
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (1, 2, 3, 8))
    assert by[4].lang_pred == "en" and rows.count() == odd_docs.count()
    unlearned = langid.identify(odd_docs, no_docs).select("language.lang_pred").distinct().collect()
    assert [r.lang_pred for r in unlearned] == ["und"]
    assert langid.language_ids(no_docs).count() == 0
    kept = langid.keep_identified(odd_docs, documents)
    assert kept.columns == odd_docs.columns and 4 in {r.doc_id for r in kept.collect()}


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert len(found) == docs.count()
    held = [(truth[i], r.predicted) for i, r in found.items() if r.held_out and i in truth]
    right = held.count((1, 1))
    assert right >= 0.7 * sum(y for y, _ in held) and held.count((0, 1)) <= 0.02 * len(held)
    texts = {r.doc_id: r.text for r in docs.collect()}
    spans = [texts[i][s.start : s.end] for i, r in found.items() if truth.get(i) == 1 for s in r.spans]
    assert spans and all(s[0].isalpha() and s[-1].isalpha() for s in spans)


def test_odd_toxicity(spark, odd_docs, no_docs):
    bad = [(100 + i, f"{w} you utter blockhead {w}{w} goes", None, "", 0, "", None) for i, w in enumerate("abcdefghijklmnopqrstuv")]
    fine = [(200 + i, f"{w} is a fine {w}{w} day", None, "", 0, "", None) for i, w in enumerate("abcdefghijklmnopqrstuv")]
    docs = odd_docs.unionByName(spark.createDataFrame(bad + fine, odd_docs.schema))
    labels = [(r[0], 0, 1) for r in bad] + [(r[0], 0, 0) for r in fine] + [(1, 0, None), (None, 0, 1), (100, 1, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(docs, known, out="tokens")
    assert rows.columns == odd_docs.columns and rows.count() == docs.count()
    by = {r.doc_id: r.tokens for r in rows.collect()}
    assert all(by[r[0]].score > 0.7 for r in bad) and all(by[r[0]].score < 0.3 for r in fine)
    assert by[1].score == by[2].score < 0.3 and by[1].spans == []
    none = toxicity.score_toxicity(odd_docs, known.filter("false")).select("toxicity.score").distinct().collect()
    assert [r.score for r in none] == [0.0]
    assert toxicity.toxicity_scores(no_docs, known).count() == 0


def test_switched_texts_stay_and_every_language_is_learned(spark):
    rng = np.random.default_rng(2)
    stems = {lang: [a + b + c for a in lang for b in "aeiou" for c in lang] for lang in ("bdg", "kpt", "lmn", "rsv", "fhj")}
    def text(lang, n=40):
        return " ".join("".join(rng.choice(stems[lang], 2)) for _ in range(n))
    docs = [(i, text(lang), lang) for i, lang in enumerate([*stems] * 8)]
    mixed = [(100, " ".join(text(lang, 12) for lang in stems), "mixed"), (101, "12 34 !", None), (102, None, "bdg")]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = langid.keep_identified(frame(docs + mixed), frame(docs)).collect()
    assert {r.doc_id for r in kept} == {*range(40), 100}
    many = frame([(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26)}", f"l{i}") for i in range(90)])
    assert len(langid.training_sample(many, "text", "lang", 2)) == 90


def labelled_texts(spark, rows):
    return spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")


def insult_rows(n_bad=30, n_fine=300):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 7))
    bad = [(" ".join([*(word() for _ in range(6)), "blockhead", word(), word()]), 1) for _ in range(n_bad)]
    return bad + [(" ".join(word() for _ in range(9)), 0) for _ in range(n_fine)]


def test_counts_of_different_texts(spark):
    rows = insult_rows(40, 3_000)
    counted = toxicity.text_counts(labelled_texts(spark, rows + rows[:5] * 3), "text", "toxic", {"blockhead ", "block", "none "})
    by = {r.mark: r for r in counted.collect()}
    assert set(by) == {"", "blockhead ", "block"}
    assert 25 <= by["blockhead "].bad <= 60 and by["blockhead "].fine == 0
    assert abs(by[""].fine - 3_000) < 1_200 and abs(by[""].bad - 40) < 20
    assert 25 <= by["block"].places <= 60


def test_words_do_not_carry_their_text(spark):
    """Work by text stays work by text: beside every word it grows with the square of a text's words."""
    docs = labelled_texts(spark, [*insult_rows(5, 5), ("once upon a time " * 2_000, 0)])
    plan = toxicity.text_counts(docs, "text", "toxic", {"blockhead "})._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("explode(transform(") :]
    assert "array_min" not in plan[: plan.index("explode(transform(")] and "array_min" in below


def test_marks_do_not_follow_copies(spark):
    rows = insult_rows()
    lone = ("quiet zebra walks alone along rivers", 1)
    want = toxicity.toxic_marks(labelled_texts(spark, [*rows, lone]), "text", "toxic", [*rows, lone])[0]
    copied = toxicity.toxic_marks(labelled_texts(spark, [*rows, *[lone] * 3_000]), "text", "toxic", [*rows, lone])[0]
    assert want == copied == {"blockhead ", "bloc", "block", "blockh"}


def test_unknown_labels_are_summed_over():
    known = [(["bad", "word"], [1, 0]), (["good", "word"], [0, 0])] * 5
    free = crf.fit([*known, (["odd", "bad"], [crf.UNKNOWN, 1])] * 3, ["fine", "toxic"])
    probs = crf.Tagger(free).tag([["bad", "word"], ["good", "word"]])
    assert probs[0][0, 1] > 0.9 and probs[0][1, 1] < 0.1 and probs[1][:, 1].max() < 0.1
    # A text without any known label says nothing: the fit without it is the same, but for the steps' length.
    model = crf.fit([(["a"], [crf.UNKNOWN]), (["b", "c"], [crf.UNKNOWN] * 2)], ["fine", "toxic"])
    assert not model.emit.any() and not model.step.any() and not model.start.any()


def test_scores_against_all_labellings(spark):
    """Marginals, spans and scores of the operator on a few documents, by adding up every labelling of each."""
    rows = insult_rows()
    docs = labelled_texts(spark, rows)
    found = {r.doc_id: r.toxicity for r in toxicity.score_toxicity(docs.drop("toxic"), docs.select("doc_id", "toxic")).collect()}
    known = sorted(rows)
    model = toxicity.train(known, *toxicity.toxic_marks(docs, "text", "toxic", known))
    def all_paths(text):
        words = toxicity.words_of(text)
        return brute(crf.emissions(words, model.emit), np.arange(len(words)) == 0, model)
    weights = toxicity.calibrate([all_paths(t) for t, _ in known], [y for _, y in known], 1.0)
    for i in (0, 1, 29, 30, 31):
        probs = all_paths(rows[i][0])
        score = 1 / (1 + np.exp(-weights @ np.array([1.0, *toxicity.figures(probs)])))
        assert abs(found[i].score - score) < 1e-3
        assert found[i].n_toxic == (probs[:, 1] > 0.5).sum()
        words = rows[i][0].split(" ")
        assert [rows[i][0][s.start : s.end] for s in found[i].spans] == [w for w, p in zip(words, probs[:, 1], strict=True) if p > 0.5]
