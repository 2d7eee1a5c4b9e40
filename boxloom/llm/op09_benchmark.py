"""Benchmark decontamination: CGK embedding of edit distance into Hamming distance, bit sampling, exact verification.

Words are runs of characters after A-Z are lower-cased and ASCII marks became spaces. An item of n words is found in
a document if some window of n words (the whole text, if that is shorter) has a word edit distance of at most
k = floor((1 - similarity) * n) from it.

1. Windows: by the q-gram lemma a window within distance k shares at least n - q + 1 - k q of the item's q-grams, so
   only windows that hold as many are looked at. This loses no window.
2. Each such window and each item is embedded by CGK random walks: step j writes the current symbol and
   moves on by a random bit that depends on j and the symbol. A table samples a few places of the walk; windows and
   items with equal samples collide. Walks are added until the recall measured on items with k random edits reaches
   `RECALL`; if `MOST_WALKS` walks of a length do not reach it, every window of step 1 is verified with its item instead.
3. Colliding pairs are verified by exact edit distance.

Items are dealt to blocks of about `BLOCK_CHARS` characters and `ITEMS_PER_SCAN` items, compiled in tasks and stored. The scan of the
documents is one map per block, which gets its block alone; with several blocks each scan is stored before the next
begins. So more items mean more scans, while driver and executors hold one block at a time.

Null and empty texts and items match nothing. Copies of an item are reported each by its item_id; repeated documents
are each reported. Other columns are ignored by `find` and passed on by `remove_contaminated`. Empty tables
give an empty result (no items: all documents stay).
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, store

SIMILARITY = 0.8
RECALL = 0.97
ITEMS_PER_SCAN = 20_000
BLOCK_CHARS = 8_000_000
MOST_WALKS = 64
TABLES_PER_WALK, SAMPLED = 8, 3

_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _MARKS, bytes(range(97, 123)) + b" " * len(_MARKS))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distance of each row of a from the same row of b."""
    steps = np.arange(b.shape[1] + 1)
    row = np.broadcast_to(steps, (len(a), b.shape[1] + 1)).copy()
    for i in range(a.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (a[:, i : i + 1] != b))
        row = np.minimum.accumulate(new - steps, axis=1) + steps
    return row[:, -1]


class Walks:
    """CGK walks over symbol sequences of one length, and tables of sampled places."""

    def __init__(self, length: int, walks: int):
        rng = np.random.default_rng(length)
        self.length, self.steps = length, 3 * length
        self.a = rng.integers(0, 2**63, (MOST_WALKS, self.steps), dtype=np.uint64)[:walks] | np.uint64(1)
        self.b = rng.integers(0, 2**63, (MOST_WALKS, self.steps), dtype=np.uint64)[:walks]
        self.places = rng.integers(0, self.steps, (MOST_WALKS, TABLES_PER_WALK, SAMPLED))[:walks]

    def keys(self, symbols: np.ndarray) -> np.ndarray:
        """tables x rows: the sampled places of each walk as one number."""
        n, size = symbols.shape
        padded = np.c_[symbols, np.zeros((n, 1), symbols.dtype)].astype(np.uint64)  # 0: the sequence has ended
        rows, out = np.arange(n), []
        for a, b, places in zip(self.a, self.b, self.places, strict=True):
            at, walk = np.zeros(n, np.int64), np.empty((self.steps, n), np.uint64)
            for j in range(self.steps):
                walk[j] = padded[rows, at]
                at = np.minimum(at + ((walk[j] * a[j] + b[j]) >> np.uint64(63)).astype(np.int64), size)
            for table in places:
                key = np.zeros(n, np.uint64)
                for place in table:
                    key = (key ^ walk[place]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(29)
                out.append(key)
        return np.array(out)


class Items:
    """A block of items, compiled for scanning."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float, recall: float):
        self.codes: dict[bytes, int] = {}
        self.ids, self.words, self.distance, self.need, self.grams = [], [], [], [], []
        self.by_gram: dict[int, dict[tuple, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = tuple(self.codes.setdefault(w, len(self.codes) + 2) for w in words_of(text))
            n = len(words)
            if not n:
                continue
            k = int((1 - similarity) * n + 1e-9)
            q = min(n, 3)
            while q > 1 and n - q + 1 - k * q < 1:
                q -= 1
            self.ids.append(item_id)
            self.words.append(words)
            self.distance.append(k)
            self.need.append(max(1, n - q + 1 - k * q))
            self.grams.append(q)
            for gram in {words[o : o + q] for o in range(n - q + 1)}:
                self.by_gram[q][gram].append(len(self.ids) - 1)
        self.by_gram = {q: dict(grams) for q, grams in self.by_gram.items()}
        self.of_length: dict[int, np.ndarray] = {}
        for i, words in enumerate(self.words):
            self.of_length.setdefault(len(words), []).append(i)
        self.tables = {}
        for n, members in self.of_length.items():
            members = np.array(members)
            symbols = np.array([self.words[i] for i in members], np.int64)
            walks = _walks_needed(symbols, self.distance[members[0]], recall)
            if walks is None:
                continue
            keys = walks.keys(symbols)
            order = np.argsort(keys, axis=1, kind="stable")
            self.tables[n] = (walks, members, symbols, np.take_along_axis(keys, order, 1), order)

    def windows(self, words: list[bytes]) -> dict[int, list[tuple[int, int, int]]]:
        """By item length: (start, last start, item) of windows that share enough grams with an item of it."""
        get = self.codes.get
        coded = [get(w, 1) for w in words]
        out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for q, grams in self.by_gram.items():
            hits: dict[int, list[int]] = defaultdict(list)
            for p, gram in enumerate(zip(*(coded[i:] for i in range(q)), strict=False)):
                if gram in grams:
                    for i in grams[gram]:
                        hits[i].append(p)
            for i, places in hits.items():
                n, need = len(self.words[i]), self.need[i]
                # the windows that hold the need-th place of some stretch of places
                for first, last in zip(places, places[need - 1 :], strict=False):
                    if last - first <= n - q:
                        out[n].append((max(0, last + q - n), first, i))
        self.coded = np.array(coded, np.int64)
        return out

    def find(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        """(item_id, start, distance): for each item found its best window, the first of equals."""
        best: dict[int, tuple[int, int]] = {}
        for n, ranges in self.windows(words).items():
            last, size = max(0, len(words) - n), min(n, len(words))
            starts = np.unique(np.concatenate([np.arange(min(a, last), min(b, last) + 1) for a, b, _ in ranges]))
            for at in range(0, len(starts), 5000):
                part = starts[at : at + 5000]
                symbols = self.coded[part[:, None] + np.arange(size)]
                found = self.verified(n, symbols) if n in self.tables else self.compared(n, symbols, part, ranges)
                for row, i, distance in found:
                    if (distance, int(part[row])) < best.get(i, (n + 1, 0)):
                        best[i] = (distance, int(part[row]))
        return [(self.ids[i], start, distance) for i, (distance, start) in sorted(best.items())]

    def compared(self, n: int, symbols: np.ndarray, starts: np.ndarray, ranges: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """What `verified` finds, from every window and the items that share enough grams with it."""
        spans: dict[int, np.ndarray] = {}
        for a, b, i in ranges:
            low, high = np.searchsorted(starts, a), np.searchsorted(starts, b, "right")
            # windows at the text's end stand for those that would reach beyond it
            low = min(low, len(starts) - 1) if a > starts[-1] else low
            spans.setdefault(i, np.zeros(len(starts), bool))[low : max(high, low + (a > starts[-1]))] = True
        out = []
        for i, mask in spans.items():
            rows = np.flatnonzero(mask)
            distance = edit_distances(symbols[rows], np.broadcast_to(np.array(self.words[i], np.int64), (len(rows), n)))
            ok = distance <= self.distance[i]
            out += [(row, i, d) for row, d in zip(rows[ok].tolist(), distance[ok].tolist(), strict=True)]
        return out

    def verified(self, n: int, symbols: np.ndarray) -> list[tuple[int, int, int]]:
        walks, members, items, keys, order = self.tables[n]
        pairs = []
        for mine, theirs, places in zip(walks.keys(symbols), keys, order, strict=True):
            low, high = np.searchsorted(theirs, mine, "left"), np.searchsorted(theirs, mine, "right")
            count = high - low
            rows = np.repeat(np.arange(len(mine)), count)
            offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            pairs.append(rows * len(members) + places[np.repeat(low, count) + offset])
        pairs = np.unique(np.concatenate(pairs))
        rows, which = pairs // len(members), pairs % len(members)
        out = []
        for at in range(0, len(rows), 20_000):
            r, w = rows[at : at + 20_000], which[at : at + 20_000]
            distance = edit_distances(symbols[r], items[w])
            ok = distance <= self.distance[members[0]]
            out += zip(r[ok].tolist(), members[w[ok]].tolist(), distance[ok].tolist(), strict=True)
        return out


def _walks_needed(symbols: np.ndarray, k: int, recall: float) -> Walks | None:
    """Walks, doubled until items with k random edits collide with their original often enough; None if they never do."""
    n, rng = symbols.shape[1], np.random.default_rng(17)
    tests = symbols[rng.integers(0, len(symbols), 200)]
    edited = []
    for row in tests.tolist():
        row = list(row)
        for kind, place in zip(rng.integers(0, 3, k).tolist(), rng.random(k).tolist(), strict=True):
            place = int(place * max(1, len(row)))
            if kind == 0 and row:
                row[place] = 1
            elif kind == 1 and row:
                del row[place]
            else:
                row.insert(place, 1)
        edited.append((row + [1] * n)[:n])
    edited = np.array(edited, np.int64).reshape(len(tests), n)
    near = edit_distances(tests, edited) <= k
    walks = 1
    while walks <= MOST_WALKS:
        made = Walks(n, walks)
        hit = (made.keys(tests) == made.keys(edited)).any(axis=0)
        if not near.any() or hit[near].mean() >= recall:
            return made
        walks *= 2
    return None


def compiled(items: DataFrame, similarity: float) -> tuple[DataFrame, int]:
    """block, compiled: the blocks of items, compiled in tasks; and how many blocks there may be."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    count, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks, recall = max(-(-count // ITEMS_PER_SCAN), -(-chars // BLOCK_CHARS)), RECALL

    def build(table: pa.Table) -> pa.Table:
        import pickle

        made = Items(sorted(zip(table["item_id"].to_pylist(), table["text"].to_pylist(), strict=True)), similarity, recall)
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "compiled": pa.array([pickle.dumps(made, protocol=5)], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks))).cast("int"))
    return store(dealt.groupBy("block").applyInArrow(build, "block int, compiled binary"), "items"), blocks


class _Block:
    """One compiled block on its way to the tasks, unpacked once per task."""

    def __init__(self, spark: SparkSession, blocks: DataFrame, number: int):
        row = blocks.where(F.col("block") == number).first()
        self.shared = spark.sparkContext.broadcast(row.compiled) if row else None

    def items(self) -> Items:
        import pickle

        return pickle.loads(self.shared.value)


def _scan(texts: DataFrame, block: _Block) -> DataFrame:
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("distance", pa.int32()), ("similarity", pa.float64()),
    ])

    def scan(batches):
        known, out = block.items(), Sink(schema)
        sizes = dict(zip(known.ids, map(len, known.words), strict=True))
        for batch in batches:
            for doc_id, text_hash, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for item_id, start, distance in known.find(words_of(text.as_py())):
                    out.add(doc_id, text_hash, item_id, start, distance, 1 - distance / sizes[item_id])
            if out.full():
                yield out.take()
        yield out.take()

    return texts.mapInArrow(scan, "doc_id long, text_hash long, item_id long, start int, distance int, similarity double")


def _find(docs: DataFrame, blocks: DataFrame, count: int) -> DataFrame:
    spark, text = docs.sparkSession, F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = None
    for number in range(count):
        block = _Block(spark, blocks, number)
        if block.shared is None:
            continue
        part = _scan(texts, block)
        if count > 1:
            part = store(part, "found")
            block.shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, text_hash long, item_id long, start int, distance int, similarity double")
    return found


def find(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start, distance, similarity of each item found in each document."""
    return _find(docs, *compiled(items, similarity)).drop("text_hash")


def remove_contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    blocks, count = compiled(items, similarity)
    if count != 1:  # none, or several: rows found by any scan go at the end
        gone = _find(docs, blocks, count).select("doc_id", "text_hash").distinct()
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("text_hash"))
        return rows.join(store(gone, "gone").hint("merge"), same, "left_anti").select("row.*")
    at, block = docs.columns.index("text"), _Block(docs.sparkSession, blocks, 0)

    def scan(batches):
        known = block.items()
        for batch in batches:
            yield batch.filter(pa.array([not known.find(words_of(t.as_py())) for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(scan, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return find(docs, items)
