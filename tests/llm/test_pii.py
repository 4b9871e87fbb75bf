import hashlib
import re

import pytest

from logloom.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """The rules as they are written."""
    text = text or ""
    def digits(s):
        return [int(c) for c in s if c in "0123456789"]
    def luhn(s):
        d = digits(s)[::-1]
        return sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(m[0]) % 10 == 0]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


@pytest.mark.parametrize("text", [
    "a@b.c", "a@b", "@b.c", "a.b@c.d@e.f", "x@y..z q%w@r-s.t.u.", "a@b.c@d.e", "a@@b.c", "é1@b.cé", "1.2.3.4.5.6.7.8", "256.1.1.1 255.0.00000001.1",
    "12.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (988) 555-2485", "+1 2", "+12345678901234567",
    "+1 4111 1111 1111 1111", "++49 30 1234567", "9" * 400, "1." * 300, "a" * 5000 + "@", "👍 me@x.org 1.1.1.1", "",
])
def test_base_spans_as_written(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_every_document_as_written(spark, documents):
    rows = {r.doc_id: r for r in pii.personal_data(documents).collect()}
    seen = 0
    for doc in documents.collect():
        spans, row = plain_spans(doc.text), rows[doc.doc_id]
        seen += len(spans)
        assert row.base_sha256 == digest(spans)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        if not row.n_term:
            assert row.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    assert seen and len(rows) == documents.count()


def test_terms_that_reveal_an_entity(spark):
    filler = " ".join(f"common{i % 7} word{i % 11} to at" for i in range(60))
    docs = [(i, f"{filler} write{chr(97 + i)} to Zanzibar at joe@x.org about{chr(97 + i)} word1 {filler}") for i in range(6)]
    docs += [(100 + i, f"{filler} mail word2 box{i}@y.org {filler}") for i in range(30)]
    docs += [(200 + i, "equal rare Copies here sue@z.org same rare context") for i in range(10)]
    rows = {r.doc_id: r for r in pii.personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    at = docs[0][1].index("Zanzibar")
    assert rows[0].spans.startswith(f"term:{at}:{at + 8},") and rows[0].n_term >= 1
    assert all("common" not in docs[i][1][int(a) : int(b)] for i in range(6) for _, a, b in (s.split(":") for s in rows[i].spans.split(",")))
    assert all(rows[i].n_term == 0 for i in rows if i >= 100)  # one context each, copies or not
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all("Zanzibar" not in clean[i] and "joe@" not in clean[i] and "[EMAIL]" in clean[i] for i in range(6))
    assert clean[200] == "equal rare Copies here [EMAIL] same rare context"


def test_odd_documents(spark, odd_docs, no_docs):
    rows = pii.find_personal(odd_docs, out="hits")
    assert rows.columns == [c for c in odd_docs.columns if c != "hits"] + ["hits"] and rows.count() == odd_docs.count()
    assert all(r.hits == [] for r in rows.collect())
    clean = pii.sanitise(odd_docs)
    assert clean.columns == odd_docs.columns
    assert sorted(map(str, clean.collect())) == sorted(map(str, odd_docs.collect()))
    assert pii.personal_data(no_docs).count() == 0


def test_overlaps_are_hidden_once():
    spans = [{"kind": "card", "start": 2, "end": 9, "removed": False}, {"kind": "phone", "start": 0, "end": 6, "removed": False}]
    assert pii.hidden("0123456789", spans) == "[PHONE]9"


def test_copies_do_not_change_the_terms(spark):
    filler = " ".join(f"common{i % 7} word{i % 11} to at" for i in range(60))
    docs = [(i, f"{filler} write{chr(97 + i)} to Zanzibar at joe@x.org about{chr(97 + i)} word1 {filler}") for i in range(6)]
    rest = [(100 + i, f"{filler} mail word2 box{i}@y.org {filler}") for i in range(30)]

    def terms(rows):
        found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        return {(r.doc_id % 1000, r.spans) for r in found}

    once = terms(docs + rest)
    assert any("term:" in spans for _, spans in once)
    assert terms(docs + rest + [(1000 * k + i, t) for k in range(1, 60) for i, t in docs]) == once
