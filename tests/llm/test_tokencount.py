import public_tokenizers
from tokenizers import Tokenizer

from logloom.llm import tokencount

PATH = public_tokenizers.path("byte_bpe_50k.json")


def counted(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_every_document_as_the_tokenizer_counts(documents):
    rows = {r.doc_id: r for r in tokencount.token_counts(documents, PATH).collect()}
    tokenizer = Tokenizer.from_file(PATH)
    for doc in documents.collect():
        n = len(tokenizer.encode(doc.text or "", add_special_tokens=False).ids)
        size = len((doc.text or "").encode())
        assert tuple(rows[doc.doc_id])[1:] == (size, n, n > 1024)


def test_special_strings_and_small_caches(spark):
    texts = ["<|endoftext|>a <|endoftext|>  b", "I'll can't  'S \r\n\t x", "\u0085 \u001c日本 ﬁ é", "a" * 5000, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = tokencount.count_tokens(docs, PATH, entries=2, cache=1).collect()
    assert [r.tokens for r in sorted(got)] == [counted(t) for t in texts]


def test_odd_documents(odd_docs, no_docs):
    rows = tokencount.count_tokens(odd_docs, PATH)
    assert rows.columns == odd_docs.columns  # `tokens` is replaced
    assert sorted(r.tokens for r in rows.collect()) == sorted(counted(r.text) for r in odd_docs.collect())
    assert tokencount.token_counts(no_docs, PATH).count() == 0
