import base64
import hashlib

import pytest

from logloom.llm import warc

PAGES = [
    (1, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (3, "http://c/ d\r\ne", "<p>é👍</p>"), (4, None, None), (5, "u", ""),
    (6, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (7, "u", "z" * 100_000), (7, "u", "z" * 100_000), (8, "u", "z" * 100_000),
    (8, "v", "z" * 100_000), (None, "w", "<p>same</p>"), (None, "w", "only without id"), (None, "w", "only without id"),
]


@pytest.fixture()
def pages(spark):
    rows = [(*p, "x") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_archive_of_odd_pages(pages):
    rows = warc.archived_pages(pages).collect()
    assert len(rows) == len(PAGES)
    best = {}
    for i, _, html in PAGES:
        best[html or ""] = max(best.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in PAGES:
        raw, owner = (html or "").encode(), best[html or ""]
        owner = None if owner < 0 else owner
        sha1 = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((i, len(raw), sha1, "response" if i == owner else "revisit", None if i == owner else owner))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, want))


def test_payloads_once_and_records_rebuilt(spark, pages, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    stored = warc.read_payloads(spark, folder).collect()
    assert sorted(bytes(r.payload).decode() for r in stored) == sorted({html or "" for _, _, html in PAGES})
    records = [bytes(r.record) for r in warc.rebuild(spark, folder).collect()]
    assert len(records) == len(PAGES)
    for record in records:
        header, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in header.decode().split("\r\n")[1:])
        assert header.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields["Content-Length"]) == len(rest) - 4
        if fields["WARC-Type"] == "response":
            sha1 = base64.b32encode(hashlib.sha1(rest[:-4]).digest()).decode()
            assert fields["WARC-Payload-Digest"] == f"sha1:{sha1}"


def test_damage_is_noticed(spark, pages, tmp_path):
    from pyspark.sql import functions as F

    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit(b"other")).write.parquet(f"{folder}-2/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_payloads(spark, f"{folder}-2").collect()


def test_no_pages(pages):
    assert warc.archived_pages(pages.filter("false")).count() == 0
