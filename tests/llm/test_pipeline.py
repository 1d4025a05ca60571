import hashlib
from collections import Counter

import corpus_pipeline
from ledgerhound.llm import bpe, catalog
from ledgerhound.llm.common import materialize

from .cases import corpus, frame, labels


def tables(spark, tmp_path, rows, more=()):
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars", *more).write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, rows).write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_stages_keep_columns_and_every_row_counts(spark, tmp_path):
    rows = corpus(n=120)
    sf = tables(spark, tmp_path, rows, ["score", "fp", "rank"])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = materialize(stage(spark, docs, sf), f"test-{k}")
        sizes.append(docs.count())
        if k + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        if k == 2:
            texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert sizes[1] <= sizes[0] and sizes[2] < sizes[1] and sizes[3] <= sizes[2] and sizes[4] >= sizes[3] and sizes[5] == sizes[4]
    enc = bpe.encoder(*bpe.vocabulary())
    got = Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in docs.collect())
    assert set(got) == {(i, len(enc.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts.items()}


def test_empty_table(spark, tmp_path):
    rows = corpus()
    frame(spark, rows).limit(0).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    labels(spark, rows).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_query_for_each_operator():
    assert sorted({int(q[2:].split("_")[0]) for q in catalog.queries()}) == list(range(1, 11))
