import random

import numpy as np
import pytest

from boxloom.llm import op02_phrases, op03_suffixes, windows
from llm_cases import corpus, frame, sha, tables


def words_brute(rows, length=13):
    first = {}
    split = {i: (t or "").encode().split() for i, t in rows}
    for i, words in split.items():
        for k in range(len(words) - length + 1):
            key = tuple(words[k : k + length])
            first[key] = min(i, first.get(key, i))
    out = {}
    for i, words in split.items():
        gone = set()
        for k in range(len(words) - length + 1):
            if first[tuple(words[k : k + length])] < i:
                gone.update(range(k, k + length))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out[i] = (len(words), len(gone), sha(kept))
    return out


def bytes_brute(rows, length=200):
    seen = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, text in texts:
        for k in range(len(text) - length + 1):
            seen[text[k : k + length]] = seen.get(text[k : k + length], 0) + 1
    out = []
    for i, text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for k in range(len(text) - length + 1):
            if seen[text[k : k + length]] > 1:
                gone[k : k + length] = True
        n_spans = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(text) else 0
        kept = bytes(b for b, away in zip(text, gone, strict=False) if not away)
        out.append((i, len(text), int(gone.sum()), n_spans, sha(kept)))
    return sorted(out)


@pytest.mark.parametrize("hot", [4000, 1])
def test_phrases_against_brute_force(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT", hot)
    rows = corpus()
    got = op02_phrases.query(spark, tables(tmp_path, documents=frame(spark, rows))).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == words_brute(rows)
    assert sum(r.n_removed for r in got) > 0


@pytest.mark.parametrize("hot", [4000, 1])
def test_strings_against_brute_force(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(windows, "HOT", hot)
    rows = corpus(5)
    got = op03_suffixes.query(spark, tables(tmp_path, documents=frame(spark, rows))).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == bytes_brute(rows)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_places(tmp_path, seed):
    rng = np.random.default_rng(seed)
    letters = lambda n: bytes(rng.integers(97, 99, n).astype(np.uint8))
    middle, texts, at, anchors = b"anchor", [], [], []
    for i in range(80):
        before, after = letters(30), letters(30)
        if i > 10 and rng.random() < 0.7:
            j = int(rng.integers(0, i))
            keep = int(rng.integers(0, 25))
            before = before[: max(0, 30 - keep)] + texts[j][max(0, at[j] - keep) : at[j]]
            after = texts[j][at[j] + 6 : at[j] + 6 + keep] + after
        texts.append(before + middle + after)
        at.append(len(before))
        anchors.append(i % 3)
    seen = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - 31):
            seen.setdefault((anchors[i], k - at[i], t[k : k + 32]), []).append((i, k))
    want = sorted(x for v in seen.values() if len(v) > 1 for x in v)
    found = op03_suffixes.repeated_places(texts, anchors, at, 32, str(tmp_path))
    assert want and sorted((i, int(k)) for i, places in enumerate(found) for k in places) == want


def test_empty_table_and_clashing_columns(spark, tmp_path):
    rows = frame(spark, [(1, "a b c")]).selectExpr("*", "text AS start", "doc_id AS anchor", "lang AS units")
    folder = tables(tmp_path, documents=rows.where("false"))
    assert op02_phrases.query(spark, folder).count() == 0 and op03_suffixes.query(spark, folder).count() == 0
    assert op02_phrases.remove_repeated_phrases(rows).first().kept == "a b c"
    assert bytes(op03_suffixes.remove_repeated_strings(rows).first().kept) == b"a b c"


def test_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(90))
    twice = frame(spark, [(4, text), (4, text)])
    assert [r.n_removed for r in op02_phrases.remove_repeated_phrases(twice).collect()] == [0, 0]
    assert [r.n_removed for r in op03_suffixes.remove_repeated_strings(twice).collect()] == [len(text)] * 2


def test_rows_without_doc_id_stay_whole(spark):
    text = "w " * 300
    rows = [(None, text), (None, text), (1, text), (2, "x" + text), (None, None)]
    phrases = {(r.doc_id, r.n_removed) for r in op02_phrases.remove_repeated_phrases(frame(spark, rows)).collect()}
    assert phrases == {(None, 0), (1, 0), (2, 299)}
    strings = [(r.doc_id, r.n_removed) for r in op03_suffixes.remove_repeated_strings(frame(spark, rows)).collect()]
    assert sorted(strings, key=str) == sorted([(None, 0)] * 3 + [(1, 600), (2, 600)], key=str)


def test_the_external_file_is_opened_once(tmp_path):
    """A file that is cut to nothing and closed in every round costs more than the round's order."""
    import sys

    from boxloom.llm.op03_suffixes import repeated_places

    opened = []
    sys.addaudithook(lambda event, args: opened.append(args[0]) if event == "open" and str(args[0]) == f"{tmp_path}/rows" else None)
    rng = random.Random(3)
    base = bytes(rng.choices(b"ab\xc3", k=900))
    texts = [base[i : i + rng.randrange(60, 200)] for i in (0, 5, 5, 40, 300, 310)] + [b"", b"a" * 150]
    anchors, at = [4, 4, 9, 4, 9, 9, 4, 9], [50, 45, 20, 10, 30, 20, 0, 3]
    found = repeated_places(texts, anchors, at, 33, str(tmp_path))
    for i, text in enumerate(texts):
        held = {
            p
            for j, other in enumerate(texts)
            if j != i and anchors[j] == anchors[i]
            for p in range(len(text) - 32)
            if 0 <= p - at[i] + at[j] and text[p : p + 33] == other[p - at[i] + at[j] : p - at[i] + at[j] + 33]
        }
        assert found[i].tolist() == sorted(held)
    assert sum(map(len, found)) > 50 and len(opened) == 1
