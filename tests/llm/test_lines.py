import numpy as np
import pytest

from boxloom.llm import op05_lines as lines
from llm_cases import corpus, frame, sha, tables

SPACE = " \t\n\x0b\x0c\r"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(low(line.strip(SPACE)), set()).add(i)
    out = {}
    for i, text in rows:
        parts = (text or "").split("\n")
        kept = []
        for line in parts:
            key = low(line.strip(SPACE))
            if not (len(key) >= 20 and len(holders[key]) >= 3 and i < max(holders[key])):
                kept.append(line)
        out[i] = (len(parts), len(parts) - len(kept), sha("\n".join(kept)))
    return out


@pytest.mark.parametrize("references", [400_000, 3])
def test_against_brute_force(spark, tmp_path, monkeypatch, references):
    monkeypatch.setattr(lines, "REFERENCES_PER_TASK", references)
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 2 if references == 3 else 200_000)
    wide = ["É" * 19, "é" * 20, "É" * 20, "É" * 20 + " "]
    rows = [*corpus(8), *((500 + k, "\n".join(wide) + "\n" + "  MiXed case line of text \r") for k in range(4))]
    got = lines.query(spark, tables(tmp_path, documents=frame(spark, rows))).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in got} == brute(rows)


def held(index):
    """Counts of an index, checked against its references, and its filters against the counts."""
    refs = {(r.key, r.doc_id) for r in index.read("references").collect()}
    counts = {r.key: (r.n_docs, r.last_doc) for r in index.read("counts").collect()}
    keys = {key for key, _ in refs}
    assert counts == {k: (sum(key == k for key, _ in refs), max((d for key, d in refs if key == k), default=None)) for k in keys}
    rows = index.read("counts").select(index._shard(), "key", "n_docs").collect()
    kept = {r.shard: lines.CuckooFilter.load(r["filter"]) for r in index.read("filters").collect()}
    for r in rows:
        if r.n_docs >= index.min_docs:
            assert kept[r.shard].contains(np.frombuffer(r.key, np.uint64)[:1].copy()).all()
    n_held = {r.shard: r.n_held for r in index.read("filters").collect()}
    assert sum(n_held.values()) == sum(r.n_docs >= index.min_docs for r in rows)
    return counts


def dropped(index):
    return sorted((r.doc_id, len(r["keys"])) for r in index.droppable().collect())


def test_insertions_and_deletions_are_reversible(spark, tmp_path):
    line, other = "a line of at least twenty characters", "another line of twenty characters"
    index = lines.LineIndex(spark, str(tmp_path / "index"), 4)
    index.insert(frame(spark, [(1, line), (2, line)]))
    first = held(index)
    assert dropped(index) == []
    second = frame(spark, [(3, f"{line}\n{line}\n{other}"), (4, "short")])
    index.insert(second)
    held(index)
    assert dropped(index) == [(1, 1), (2, 1)]
    index.insert(frame(spark, [(9, line), (1, other)]))  # 1 is replaced
    held(index)
    assert dropped(index) == [(2, 1), (3, 1)]
    index.delete(frame(spark, [(9, None), (77, None)]))
    index.insert(frame(spark, [(1, line)]))
    held(index)
    assert dropped(index) == [(1, 1), (2, 1)]
    index.delete(second)
    assert held(index) == first and dropped(index) == []


def test_an_update_writes_only_touched_shards(spark, tmp_path):
    index = lines.LineIndex(spark, str(tmp_path / "index"), 32)
    index.insert(frame(spark, [(i, f"one of many lines, number {i % 40}") for i in range(200)]))
    before = {name: kept.version().folders for name, (kept, _) in index.stores.items()}
    index.insert(frame(spark, [(1000, "one of many lines, number 3"), (1001, "one of many lines, number 3")]))
    index.delete(frame(spark, [(3, None)]))
    held(index)
    after = {name: kept.version().folders for name, (kept, _) in index.stores.items()}
    moved = {name: sum(before[name].get(b) != after[name].get(b) for b in after[name]) for name in after}
    assert moved["references"] <= 3 and moved["counts"] == 1 and moved["filters"] == 0


def test_an_update_that_died_is_repaired(spark, tmp_path):
    line = "a line of at least twenty characters"
    index = lines.LineIndex(spark, str(tmp_path / "index"), 4)
    index.insert(frame(spark, [(i, line) for i in range(3)]))
    write = index.stores["counts"][0].write

    def fail(*_):
        raise RuntimeError("lost")

    index.stores["counts"][0].write = fail
    with pytest.raises(RuntimeError, match="lost"):
        index.delete(frame(spark, [(2, None)]))
    index.stores["counts"][0].write = write
    index.insert(frame(spark, [(5, "nothing of that kind")]))
    held(index)
    assert dropped(index) == []


def test_a_filter_without_room_is_rebuilt(spark, tmp_path):
    index = lines.LineIndex(spark, str(tmp_path / "index"), 1)
    for start in (0, 40, 90):
        text = "\n".join(f"one of many lines, number {n}" for n in range(start, start + 50))
        index.insert(frame(spark, [(start + i, text) for i in range(3)]))
        held(index)
    row = index.read("filters").first()
    assert row.n_held == 140 and row.capacity >= 140


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    inside, outside = rng.integers(0, 2**63, (2, 5000), dtype=np.uint64)
    made = lines.CuckooFilter(5000)
    made.insert(inside)
    again = lines.CuckooFilter.load(made.dump())
    assert again.contains(inside).all() and again.contains(outside).mean() < 0.01
    again.delete(inside[:2500])
    assert again.contains(inside[2500:]).all() and again.contains(inside[:2500]).mean() < 0.01
    small = lines.CuckooFilter(4)
    small.insert(inside[:60])
    assert small.contains(inside[:60]).all() and small.stash


def test_empty_table_and_repeated_rows(spark):
    docs = frame(spark, [(1, "same line in every one of them")] * 3).selectExpr("*", "text AS key")
    assert lines.drop_repeated_lines(docs.where("false")).count() == 0
    assert [r.n_dropped for r in lines.drop_repeated_lines(docs).collect()] == [0, 0, 0]
    line = "same line in every one of them"
    rows = frame(spark, [(1, line), (1, line), (2, line), (None, line), (None, "x")])
    assert sorted((r.doc_id or 0, r.n_dropped) for r in lines.drop_repeated_lines(rows).collect()) == [(0, 0), (0, 0), (1, 1), (1, 1), (2, 0)]
