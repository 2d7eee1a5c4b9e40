import base64

import public_tokenizers
import pytest
import tiktoken

from boxloom.llm import op01_byte_bpe as bpe
from llm_cases import corpus, frame, sha, tables

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_against_the_library(spark, tmp_path, monkeypatch, coder):
    rows = [*corpus(), (900, "it's  spaced   out\n\n\n and odd 　 <|endoftext|> \U0001f600\U0001f468‍\U0001f469 12345 a\r\nb"), (901, "x" * 40_000), (901, "again"), (901, "again")]
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 3000)
    got = bpe.query(spark, tables(tmp_path, documents=frame(spark, rows))).collect()
    want = []
    for i, text in rows:
        ids = coder.encode_ordinary(text or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(text or "")))
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_empty_table_clashing_columns_and_unknown_ids(spark):
    docs = frame(spark, [(1, "words here"), (2, None)]).selectExpr("*", "text AS word", "doc_id AS chunk")
    assert bpe.encode(docs.where("false"), PATH, public_tokenizers.PATTERN).count() == 0
    assert {r.doc_id: len(r.ids) for r in bpe.encode(docs, PATH, public_tokenizers.PATTERN).collect()} == {1: 2, 2: 0}
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [50256])], "doc_id long, ids array<int>"), PATH).collect()


def test_a_round_trip_takes_one_worker_a_task(spark):
    docs = frame(spark, [(1, "words here, here"), (2, None), (2, "x\u00e9 \U0001f600")])
    both = bpe.digests(docs, PATH, public_tokenizers.PATTERN)
    # one encodes the words, one puts texts together and decodes them; texts were cut before
    assert both._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 2
    apart = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH).collect()
    whole = bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, r.ids, bytes(r.decoded)) for r in whole) == sorted((r.doc_id, r.ids, bytes(r.decoded)) for r in apart)
    assert sorted(bytes(r.decoded).decode() for r in whole) == ["", "words here, here", "x\u00e9 \U0001f600"]
