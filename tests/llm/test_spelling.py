import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from boxloom.llm import op11_spelling as spelling
from llm_cases import corpus, frame, tables


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def brute(rows):
    n = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] = n.get(run, 0) + 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def texts(seed=2, size=300):
    """Words around a few stems, with all sorts of damage, in upper and lower case."""
    rng = random.Random(seed)
    letters = "abcdenoéßÀ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 11))) for _ in range(40)]
    rows = []
    for i in range(size):
        line = []
        for _ in range(40):
            word = rng.choice(stems[: rng.randint(1, 40)])
            if rng.random() < 0.3:
                k = rng.randrange(len(word))
                word = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice(letters) + word[k:], word[:k] + rng.choice(letters) + word[k + 1 :]])
            line.append(rng.choice([word, word, word.upper().replace("SS", "ß"), word.title()]))
        rows.append((i, rng.choice([" ", ", ", "_", "中", "ā"]).join(line)))
    return rows


@pytest.mark.parametrize("shard", [30_000, 7])
def test_spelling_against_brute_force(spark, tmp_path, monkeypatch, shard):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    rows = [*texts(), *corpus(5, 50), (None, "hello hello hello hallo"), (7, "again again"), (7, "again again"), (900, "z" * 5000), (901, "z" * 5001), (902, ("z" * 5000 + " ") * 3)]
    docs = frame(spark, rows).selectExpr("*", "doc_id AS word", "text AS n", "lang AS root")
    got = spelling.query(spark, tables(tmp_path, documents=docs))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_leaf_that_counts_cannot_split(spark, monkeypatch):
    """Words of the same letters: parts of one leaf, and large leaves that meet by halves."""
    monkeypatch.setattr(spelling, "SHARD_WORDS", 40)
    monkeypatch.setattr(spelling, "MESH", 10)
    rng = random.Random(4)
    words = {"".join(rng.choice("cgkv") for _ in range(rng.choice([6, 6, 6, 7]))) for _ in range(500)}
    rows = [(k, f"{w} " * (3 + zlib.crc32(w.encode()) % 9)) for k, w in enumerate(sorted(words))]
    got = {tuple(r) for r in spelling.variants(spelling.words(frame(spark, rows))).collect()}
    assert got == brute(rows)


def test_search_reaches_every_vector_within_the_budget(monkeypatch):
    monkeypatch.setattr(spelling, "STATES", 50)
    rng = np.random.default_rng(1)
    letters = np.array(list("eainx"))
    words = sorted({"".join(rng.choice(letters, rng.integers(3, 7))) for _ in range(300)})
    held = spelling.Words(pa.table({"word": words, "n": list(range(len(words)))}))
    found = {(a, b) for q, h in spelling.near(held, held) for a, b in zip(q.tolist(), h.tolist())}
    assert found == {(a, b) for a, x in enumerate(held.words) for b, y in enumerate(held.words) if one_apart(x, y)}


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 8)
    text = "one été abcdefghijklmnop, x中y abcdefg".encode()
    assert b"".join(spelling.pieces(text)) == text
    assert [w for p in spelling.pieces(text) for w in spelling._RUN.findall(p)] == spelling._RUN.findall(text)


def test_spelling_empty_table(spark):
    for rows in ([], [(1, None), (2, ""), (3, "four")]):
        assert spelling.variants(spelling.words(frame(spark, rows))).count() == 0
