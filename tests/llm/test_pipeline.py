import base64
import hashlib

from conftest import clashing, documents

import corpus_pipeline
from meshroad.llm import shingle_join, toxicity


def test_stages_keep_the_columns_and_their_decisions_take_effect(spark, sf_dir):
    docs = clashing(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    clean = stages["toxicity"](spark, docs, sf_dir)
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = {r.doc_id for r in clean.collect()}
    assert clean.columns == docs.columns and len(ids) < docs.count()
    kept = [marks[i] for i in marks if i in ids]
    assert sum(kept) <= 0.2 * sum(marks.values()) and len([k for k in kept if not k]) >= 0.95 * len([m for m in marks.values() if not m])
    known = stages["language ID"](spark, clean, sf_dir)
    assert known.columns == docs.columns and {r.doc_id for r in known.collect()} <= ids
    single = stages["n-gram Jaccard join"](spark, known, sf_dir)
    groups = {r.doc_id: r.component_id for r in shingle_join.join(known).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in groups.items() if i == c) and single.columns == docs.columns
    mixed = stages["mixing sources to target weights"](spark, single, sf_dir)
    assert mixed.columns == docs.columns


def test_run_equals_a_plain_encoding_of_what_is_kept(spark, sf_dir):
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows
    for r in rows:
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_stages_on_edge_rows(spark, edge_docs, no_docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0, name
        stage(spark, clashing(edge_docs), sf_dir).collect()
    single = corpus_pipeline.near_copies_removed(spark, edge_docs, sf_dir).collect()
    # 7 goes, as one of its texts is that of 1; of the equal rows of 6 one stays; empty texts and null ids stay.
    assert sorted(repr(r.doc_id) for r in single) == ["1", "2", "3", "4", "5", "6", "8", "9", "None"]


def test_toxicity_of_an_empty_document_lets_it_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").union(documents(spark, [(10 ** 9, None, None, None)]))
    assert corpus_pipeline.toxic_removed(spark, docs, sf_dir).filter("doc_id = 1000000000").count() == 1
    assert toxicity.THRESHOLD == 0.3


def test_run_on_empty_tables_and_without_labels(spark, edge_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    for name, docs in (("empty", no_docs), ("unmarked", edge_docs)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    kept = corpus_pipeline.toxic_removed(spark, edge_docs, f"{tmp_path}/unmarked")
    assert kept.count() == edge_docs.count()
    unknown = edge_docs.withColumn("lang", edge_docs.lang.substr(99, 1)).selectExpr("doc_id", "text", "nullif(lang, '') lang", "source", "n_chars")
    assert corpus_pipeline.language_known(spark, unknown, str(tmp_path)).count() == 0
