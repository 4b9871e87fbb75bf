import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from logloom.session import materialize

MODEL = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_whole_run_on_the_smallest_tables(spark, tmp_path):
    sf_dir = "/root/testdata/sf0.001"
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "personal_data", "sentencepiece"]
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Extra rows: a copy, which goes, and a text without letters, which goes.
    copied = given.filter("length(text) > 200").orderBy("doc_id").limit(1)
    planted = copied.withColumn("doc_id", F.lit(10**6).cast("long")).unionByName(
        copied.withColumns({"doc_id": F.lit(10**6 + 1).cast("long"), "text": F.lit("12 34 --")})
    )
    docs = given.unionByName(planted)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, materialize(stage(spark, kept, str(tmp_path)))
        assert sorted(kept.columns) == sorted(given.columns)
        assert kept.select("doc_id").exceptAll(before.select("doc_id")).count() == 0
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert len(texts) > 0.5 * given.count() and not {10**6, 10**6 + 1} & texts.keys()

    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.ids == MODEL.encode(texts[r.doc_id]) and r.round_trip for r in rows)
