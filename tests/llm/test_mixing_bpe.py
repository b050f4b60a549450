import base64
import hashlib

import duckdb
import pytest
from conftest import clashing, documents

from meshroad.llm import byte_bpe, mixing
from meshroad.llm.queries import ORACLE


def taken(df):
    return sorted((repr(r.doc_id), r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect())


def test_targets_share_by_weight_up_to_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 90)], "_source string, source_size long")
    got = {r._source: r.target for r in mixing.targets(sizes).collect()}
    # a is full at 30; the other 1,070 words go 2 : 1 to b and null, but null is full at 270.
    assert got == {"a": 30.0, "b": pytest.approx(800.0), None: 270.0}


def test_mix_equals_its_sql_and_repeats(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    want = sorted((repr(r[0]), r[1], r[2], round(r[3], 6), r[5]) for r in db.execute(ORACLE["op1_mixing"]).fetchall())
    assert taken(mixing.mix(docs)) == want
    assert taken(mixing.mix(docs.repartition(7))) == want


def test_each_source_is_near_its_target(spark, sf_dir):
    rows = mixing.mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    sources = {r.source for r in rows}
    for s in sources:
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)
    assert all(r.taken <= 3 * r.size for r in rows)


def test_mix_of_edge_rows(spark, edge_docs, no_docs):
    rows = mixing.mix(clashing(edge_docs)).collect()
    assert len(rows) == edge_docs.count()
    assert {r.size for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
    blank = documents(spark, [(1, "", "en", "a"), (2, None, "en", "b")])
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0] and mixing.mixed_rows(blank).count() == 0


def test_mixed_rows_are_the_documents_as_often_as_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    got = mixing.mixed_rows(clashing(docs)).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in got} == want


def test_hot_source_is_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10)
    docs = documents(spark, [(i, "w " * (i % 13 + 1), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(400)])
    one = taken(mixing.mix(docs))
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10 ** 6)
    assert taken(mixing.mix(docs)) == one


@pytest.fixture(scope="module")
def plain():
    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_plain_library_and_decode_to_the_text(spark, edge_docs, plain):
    odd = documents(spark, [(20, "<|endoftext|> isn't \r\n\r\n  x", "en", "a"), (21, "a" * 3000, "en", "a"), (22, "\x00\x1c\x85 ​ ٣Ⅷ", "en", "a")])
    rows = byte_bpe.decode(byte_bpe.encode(clashing(edge_docs.union(odd)), spans=True), as_text=True).collect()
    assert len(rows) == edge_docs.count() + 3
    for r in rows:
        text = r.text or ""
        ids = plain.encode_ordinary(text)
        assert bytes(r.token_ids) == b"".join(i.to_bytes(4, "little") for i in ids) and r.n_tokens == len(ids)
        assert bytes(r.decoded) == text.encode() and r.decoded_text == text
        if ids:
            assert r.byte_end[-1] == len(text.encode()) and r.char_start[0] == 0 and r.char_end[-1] == len(text)


def test_decoding_beside_encoding_is_decoding(spark, edge_docs):
    rows = byte_bpe.decode(byte_bpe.encode(clashing(edge_docs), decoded=True).withColumnRenamed("decoded", "beside")).collect()
    assert len(rows) == edge_docs.count()
    assert all(bytes(r.beside) == bytes(r.decoded) == (r.text or "").encode() for r in rows)


def test_split_characters(spark):
    codec = byte_bpe.Codec(*byte_bpe.default_vocabulary())
    text = "x\U0001f9ff"  # more tokens than characters
    ids = codec.encode([text])[0]
    assert len(ids) // 4 > len(text) and codec.decode(ids).decode() == text
    _, start, end = codec.spans(text, ids)
    assert start.tolist()[1:] == [1] * (len(start) - 1) and end.tolist()[1:] == [2] * (len(end) - 1)
    cut = spark.createDataFrame([(bytearray(ids[:-4]),), (None,)], "token_ids binary")
    rows = byte_bpe.decode(cut, as_text=True).collect()
    assert rows[0].decoded_text == "x�" and bytes(rows[1].decoded) == b""


def test_small_cache_gives_the_same(monkeypatch, edge_rows):
    texts = [t or "" for _, t, _, _ in edge_rows]
    whole = byte_bpe.Codec(*byte_bpe.default_vocabulary()).encode(texts)
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 3)
    monkeypatch.setattr(byte_bpe, "GATHER_CHARS", 10)
    assert byte_bpe.Codec(*byte_bpe.default_vocabulary()).encode(texts) == whole


def test_query_digests(spark, sf_dir):
    from meshroad.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op7_byte_bpe"](spark, sf_dir).collect()}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
