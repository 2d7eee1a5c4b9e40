import random

import pytest
from boxloom.llm import op13_exact as exact
from llm_cases import corpus, frame, sha, tables


def brute(rows, pick=max):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        same = groups[t or ""]
        keep = pick((x for x in same if x is not None), default=None)
        out.append((i, keep, len(same), i == keep, sha(t or "")))
    return out


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[4]))


def test_exact_against_brute_force(spark, tmp_path):
    rows = [*corpus(4, 120), (3, None), (3, "one"), (3, "one"), (None, "one"), (None, "alone"), (None, None)]
    docs = frame(spark, rows).selectExpr("*", "doc_id AS token", "text AS packed", "doc_id AS keep_id", "lang AS hash")
    got = exact.query(spark, tables(tmp_path, documents=docs))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert order(got.collect()) == order(brute(rows))


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("trie_bytes", [20_000, 90_000])
def test_spilled_subtrees(spark, largest, trie_bytes):
    rng = random.Random(5)
    stem = "a stem that is shared by many " * 3
    texts = [stem[: rng.randrange(len(stem))] + "".join(rng.choice("ab") for _ in range(rng.randrange(9))) for _ in range(800)]
    texts += ["hot " * 400] * 700 + ["x" * k for k in range(0, 300, 3)] * 2 + ["long" * 9_000, "long" * 9_000 + "s"] * 3
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    docs = frame(spark, rows).repartition(7)
    got = exact.owners(docs, largest, trie_bytes).selectExpr("doc_id", "keep_id", "group_size", "doc_id = keep_id", "lower(hex(sha))")
    assert order(got.collect()) == order(brute(rows, max if largest else min))


def test_spills_need_rounds(spark, monkeypatch):
    """One partition of a small trie spills subtrees; later rounds own what was spilled."""
    monkeypatch.setattr(exact, "MOST_PARTITIONS", 1)
    rounds = []
    merge = exact._merge
    monkeypatch.setattr(exact, "_merge", lambda *a: rounds.append(1) or merge(*a))
    rows = list(enumerate([f"{k % 800:05d} text" * 3 for k in range(1600)]))
    got = exact.owners(frame(spark, rows), True, 60_000).selectExpr("doc_id", "keep_id", "group_size", "doc_id = keep_id", "lower(hex(sha))")
    assert order(got.collect()) == order(brute(rows)) and len(rounds) > 2


def test_trie_closes_subtrees():
    rng = random.Random(1)
    for seed in range(30):
        trie, elsewhere, held = exact.Trie(), {}, set()
        for _ in range(400):
            text = bytes(rng.choice(b"abc") for _ in range(rng.randrange(12)))
            held.add(text)
            node, at = trie.find(text)
            if node.children is None:
                elsewhere[node.value].add(text[at:])
            elif node.value is None:
                node.value = 0
                trie.strings += 1
            if rng.random() < 0.03 and trie.strings > 1 and (found := trie.heaviest()):
                rest = [r for r, _ in trie.strings_below(found[1], b"")]
                trie.strings -= len(rest)
                elsewhere[found[2]] = set(rest)
                found[1].children, found[1].value = None, found[2]
        inside = [t for t, _ in trie.strings_below(trie.root, b"")]
        outside = [name + rest for name, rests in elsewhere.items() for rest in rests]
        assert sorted(inside + outside) == sorted(held) and len(elsewhere) > 1


def test_exact_keeps_rows_of_repeated_ids(spark):
    rows = [(1, "t"), (5, "t"), (5, "other"), (9, "other"), (7, None), (8, ""), (None, "alone")]
    docs = frame(spark, rows).selectExpr("*", "doc_id AS sha", "text AS row")
    left = exact.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(5, "t"), (9, "other"), (8, ""), (None, "alone")], key=str)
    assert exact.owners(docs.where("false")).count() == 0 and exact.drop_copies(docs.where("false")).count() == 0
