import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from boxloom.llm import op01_byte_bpe, op08_quality, op09_benchmark
from boxloom.llm.common import store
from pyspark.sql import functions as F
from llm_cases import corpus, frame, sha, tables
from test_lines import brute as lines_brute
from test_similar import brute as near_classes

SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_documents(spark):
    got = op08_quality.query(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.95
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) >= 0.97


def test_quality_odd_inputs(spark):
    docs = frame(spark, [(1, None), (2, ""), (3, "text " * 50_000), (3, "again"), (3, "again")]).selectExpr("*", "lang AS places", "doc_id AS quality")
    none = op08_quality.train(docs, spark.createDataFrame([(1, None), (2, 1), (None, 0)], "doc_id long, quality int"))
    assert {r.score for r in op08_quality.score(docs, none).collect()} == {0.5} and op08_quality.keep_good(docs, none).count() == 5
    assert op08_quality.score(docs.where("false"), none).count() == 0


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def leaks(rows, items):
    out = {}
    for doc_id, text in rows:
        words = op09_benchmark.words_of(text)
        for item_id, item in items:
            want = op09_benchmark.words_of(item)
            n = len(want)
            if n:
                found = min((edit(words[s : s + n], want), s) for s in range(max(1, len(words) - n + 1)))
                if found[0] <= int(0.2 * n + 1e-9):
                    out[doc_id, item_id] = (found[1], found[0])
    return out


def planted(seed=5):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdef") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(prose(n))) for i, n in enumerate([1, 3, 5, 8, 15, 20, 40, 57])] + [(90, None), (91, ""), (92, "Same, ITEM twice!"), (93, "same item twice")]
    rows = [(500, None), (501, ""), (502, "a " * 3000)]
    for k in range(60):
        text, item = prose(rng.choice([10, 60])), items[rng.randrange(8)][1].upper().split()
        for _ in range(rng.randint(0, max(1, len(item) // 4))):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["new"], [item[at] + ",", "new"]])
            item = item or ["x"]
        at = rng.randrange(len(text))
        rows.append((k, " ".join(text[:at] + item + text[at:])))
    return rows, items


@pytest.mark.parametrize("in_scan, recall", [(5, 0.97), (20_000, 0.97), (20_000, 2.0)])
def test_benchmark_against_brute_force(spark, tmp_path, monkeypatch, in_scan, recall):
    """Several blocks, one, and one without enough walks, which is then exact."""
    monkeypatch.setattr(op09_benchmark, "ITEMS_PER_SCAN", in_scan)
    monkeypatch.setattr(op09_benchmark, "RECALL", recall)
    rows, items = planted()
    docs = frame(spark, rows).selectExpr("*", "doc_id AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.distance) for r in op09_benchmark.query(spark, tables(tmp_path, documents=docs, benchmark=bench)).collect()}
    want = leaks(rows, items)
    assert set(got) <= set(want) and len(got) >= 0.97 * len(want) and (recall < 1 or got == want)
    assert all(got[k] == v for k, v in want.items() if v[1] == 0)
    left = {r.doc_id for r in op09_benchmark.remove_contaminated(docs, bench).collect()}
    assert left == {i for i, _ in rows} - {d for d, _ in got}
    assert op09_benchmark.find(docs, bench.where("false")).count() == 0 and op09_benchmark.find(docs.where("false"), bench).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    rows = corpus(21, 70)
    labels = [(i, int(i % 7 != 0), 0) for i, _ in rows]
    rows = [(i, t if i % 7 else "!!! $$$ ### " * (i % 50 + 1)) for i, t in rows]
    items = [(1, " ".join((rows[20][1] or "").split()[:30])), (2, "not in any document at all")]
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    label_frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    folder = tables(tmp_path, documents=docs, benchmark=bench, labels=label_frame)
    here = store(docs, "input")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        here = store(stage(spark, here, folder), name)
        assert here.columns == docs.columns
    got = {tuple(r) for r in corpus_pipeline.run(spark, folder).collect()}

    model = op08_quality.train(docs, label_frame)
    left = [(i, t) for i, t in rows if model.score(op08_quality.features(t)) >= 0.5]
    assert 0 < len(left) < len(rows)
    dropped, texts = lines_brute(left), dict(left)
    holders = {}
    for i, t in left:
        for line in (t or "").split("\n"):
            holders.setdefault(line.strip(" \t\n\x0b\x0c\r").lower(), set()).add(i)
    kept = {}
    for i, t in texts.items():
        key = lambda line: line.strip(" \t\n\x0b\x0c\r").lower()
        kept[i] = "\n".join(x for x in (t or "").split("\n") if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and i < max(holders[key(x)])))
        assert sha(kept[i]) == dropped[i][2]
    group = near_classes(list(kept.items()))
    kept = {i: t for i, t in kept.items() if group[i] == i}
    kept = {i: t for i, t in kept.items() if not leaks([(i, t)], items)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op01_byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = set()
    for i, t in kept.items():
        ids = coder.encode_ordinary(t)
        want.add((i, len(ids), sha(" ".join(map(str, ids))), sha(t)))
    assert got == want


CLASHING = ["packed", "keys", "kept", "n_lines", "n_dropped", "key", "row", "point", "text_hash", "component_id", "first", "score", "shard", "item_id", "block"]


def test_stages_with_clashing_names_and_odd_rows(spark, tmp_path):
    """Every stage but the last keeps the columns of its input, whatever they are called; nulls, repeated rows, empty tables."""
    texts = [(1, None), (2, ""), (3, "a shared line of more than twenty letters\nown"), (4, "a shared line of more than twenty letters"), (5, "A shared line of more than twenty letters "), (5, "other text"), (5, "other text"), (6, "long " * 30_000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels, bench = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"), spark.createDataFrame([(1, "not here")], "item_id long, text string")
    folder = tables(tmp_path, documents=docs, labels=labels, benchmark=bench)
    docs = docs.withColumns({name: F.col("doc_id") + 100 for name in CLASHING})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.schema.simpleString() == docs.schema.simpleString()
        left = after.collect()
        assert left and all(r[name] == r.doc_id + 100 for r in left for name in CLASHING)
        assert stage(spark, docs.where("false"), folder).count() == 0


def test_near_copies_judges_rows_that_repeat_an_id(spark):
    t, other = "one two three four five six seven", "a b c d e f g h i"
    rows = [(1, t), (5, t), (5, other), (8, other), (None, t), (None, other), (9, None), (10, "")]
    left = corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "").collect()
    assert sorted(((r.doc_id or 0, r.text) for r in left), key=str) == sorted([(1, t), (5, other), (0, t), (0, other), (9, None)], key=str)
