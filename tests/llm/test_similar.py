import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from boxloom.llm import similar_texts
from llm_cases import corpus, frame
from test_near import classes


def brute_sets(rows, width=5):
    for i, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
        yield i, {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))}


def brute(rows):
    held = dict(brute_sets(rows))
    pairs = [(a, b) for a in held for b in held if a < b and len(held[a] & held[b]) >= 0.8 * len(held[a] | held[b])]
    return classes(list(held), pairs)


def near_copies(seed=1):
    """Texts with some words changed, at similarities around 0.8."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows = []
    for k in range(40):
        base = [word() for _ in range(rng.choice([60, 150, 400]))]
        rows.append((k * 10, " ".join(base)))
        for c in range(1, 5):
            text = base[:]
            for _ in range(max(1, len(base) * c // 120)):
                text[rng.randrange(len(text))] = word()
            rows.append((k * 10 + c, " ".join(text)))
    return rows + [(900, None), (901, " "), (902, "one"), (903, "One")]


@pytest.mark.parametrize("block", [512, 3])
def test_similar_texts_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similar_texts, "BLOCK", block)
    for rows in (near_copies(), corpus(9, 90)):
        got = {r.doc_id: r.component_id for r in similar_texts.similar(frame(spark, rows)).collect()}
        assert got == brute(rows)


def test_stage_drops_every_near_copy(spark):
    rows = near_copies(2)
    want = brute(rows)
    got = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "").collect()}
    assert got == {i for i, c in want.items() if i == c} and len(got) < len(rows) - 60


def test_similar_texts_empty_table(spark):
    assert similar_texts.similar(frame(spark, [(1, "a")]).where("false")).count() == 0


def test_fingerprints_alone_find_close_copies(spark, monkeypatch):
    """The stage runs op7's method: without any key of minimum hashes its trees still link close copies, and the exact check judges them."""
    plain = similar_texts.sketches
    monkeypatch.setattr(similar_texts, "sketches", lambda docs, width: plain(docs, width).withColumn("keys", F.array().cast("array<long>")))
    rng = random.Random(4)
    rows = []
    for k in range(30):
        base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join([*base, "more"]))]
    got = {r.doc_id: r.component_id for r in similar_texts.similar(frame(spark, rows)).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}
