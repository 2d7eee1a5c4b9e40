"""Spelling variant grouping: a trie over letter-group counts, searched with a budget of one surplus and one deficit.

A word is arranged by its length and then by how many of its letters fall into each group of `GROUPS`. One inserted, deleted
or replaced letter changes these counts by at most one surplus and one deficit, so a depth-first search that may
spend one of each reaches every near word; the words of the leaves it reaches are verified letter by letter.

The top of the trie deals the words: a node with more than `SHARD_WORDS` words is split at the next count, any other is a
shard. A word is held by one shard and asks all shards that the same budget leads to, so the answers about a word are
counts and a best word per shard. A leaf that no further count can split is dealt over parts by word. Splits are counted by
aggregation; the driver holds only nodes that were split, at most (words / SHARD_WORDS) for each of the trie's levels.

Null or empty text: no words. A null doc_id is written "null" where the digest needs it. Rows that repeat a doc_id or a whole
row count as often as they stand there. Other columns are ignored. An empty table gives an empty result. Very long texts are
read in pieces that end between words; a run of letters is one word whatever its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, rows_of, store

MIN_CHARS, MIN_COUNT, DAMAGE = 5, 3, 97
SHARD_WORDS = 30_000
PIECE = 1 << 20
STATES = 400_000
CELLS = 4_000_000
#: Leaf pairs with more word pairs than this meet through equal halves.
MESH = 4096

#: Letters of a level of the trie, common ones first; letters that no group names join by code point.
GROUPS = ("e", "a", "i", "n", "t", "o", "r", "s", "hq", "dj", "lx", "uz", "cgkv", "mpbfwy")
_LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
_GROUP_OF = {x: next((k for k, group in enumerate(GROUPS) if x in group), ord(x) % len(GROUPS)) for x in _LETTERS}

_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_BREAK = re.compile(rb"[^a-z\x80-\xff]")


def pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        end = _BREAK.search(text, at + PIECE)
        stop = end.start() if end else len(text)
        yield text[at:stop]
        at = stop


def damaged(run: bytes, h: int) -> bytes:
    """The run without its code point h % length."""
    if run.isascii():
        k = h % len(run)
        return run[:k] + run[k + 1 :]
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """word, n: the words of at least `min_chars` code points that occur at least `min_count` times."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def scan(batches):
        from zlib import crc32

        held: dict[bytes, int] = {}

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], schema=schema)
            held.clear()
            return batch

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            start = crc32(f"{'null' if doc_id is None else doc_id}:".encode())
            for piece in pieces((text or b"").lower()):
                for run, n in Counter(_RUN.findall(piece)).items():
                    h = crc32(run, start)
                    if h % damage == 0:
                        run = damaged(run, h)
                    if len(run) >= min_chars and len(run) - run.count(b"\xc3") >= min_chars:
                        held[run] = held.get(run, 0) + n
                if len(held) > 200_000:
                    yield flush()
        yield flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(scan, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def splits(counted: DataFrame) -> dict[tuple[int, ...], int]:
    """The nodes that are split, and over how many parts a leaf is dealt that no further count splits."""
    count_of = [F.length(F.translate("word", "".join(x for x in _LETTERS if _GROUP_OF[x] == k), "")) for k in range(len(GROUPS))]
    vector = F.array(F.length("word"), *[F.length("word") - left for left in count_of])
    vectors = store(counted.select(vector.alias("vector")).groupBy("vector").agg(F.count("*").alias("words")), "vectors")
    found: dict[tuple[int, ...], int] = {}
    left = vectors.withColumn("node", F.slice("vector", 1, 0))
    for depth in range(1, len(GROUPS) + 2):
        left = left.withColumn("node", F.slice("vector", 1, depth))
        heavy = left.groupBy("node").agg(F.sum("words").alias("words")).where(F.col("words") > SHARD_WORDS)
        rows = heavy.collect()  # at most words / SHARD_WORDS
        if not rows:
            break
        found |= {tuple(r.node): -(-r.words // SHARD_WORDS) for r in rows}
        left = vectors.join(left.sparkSession.createDataFrame([(r.node,) for r in rows], "up array<int>"), F.slice("vector", 1, depth) == F.col("up")).drop("up")
    return found


class Router:
    """Which shards hold a word, and which it has to ask."""

    def __init__(self, split: dict[tuple[int, ...], int]):
        self.split, self.last = split, len(GROUPS) + 1
        self.depth = min(self.last, max(map(len, split), default=0) + 1)
        self.known: dict[tuple[int, ...], list[tuple[tuple[int, ...], int]]] = {}

    def vector(self, word: str) -> tuple[int, ...]:
        counts = [0] * len(GROUPS)
        for x in word:
            counts[_GROUP_OF[x]] += 1
        return (len(word), *counts)

    def home(self, vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        """The shard's node, and its number of parts."""
        for depth in range(1, self.last):
            if vector[:depth] not in self.split:
                return vector[:depth], 1
        return vector, self.split.get(vector, 1)

    def asked(self, vector: tuple[int, ...]) -> list[tuple[tuple[int, ...], int]]:
        """The nodes that one surplus and one deficit lead to, depth first."""
        key = vector[: self.depth]
        if key not in self.known:
            if len(self.known) > 50_000:
                self.known.clear()
            out, length = [], vector[0]
            stack = [((length,), 1, 1), ((length + 1,), 1, 0), ((length - 1,), 0, 1)]
            while stack:
                node, surplus, deficit = stack.pop()
                depth = len(node)
                if node not in self.split or depth == self.last:
                    out.append((node, self.split.get(node, 1) if depth == self.last else 1))
                    continue
                here = vector[depth]
                stack.append(((*node, here), surplus, deficit))
                if surplus:
                    stack.append(((*node, here + 1), 0, deficit))
                if deficit and here:
                    stack.append(((*node, here - 1), surplus, 0))
            self.known[key] = out
        return self.known[key]


def _shard_id(node: tuple[int, ...], part: int) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(",".join(map(str, (*node, -part))).encode()) - (1 << 63)


def routed(counted: DataFrame, split: dict[tuple[int, ...], int]) -> DataFrame:
    """shard, held, word, n: a word once where it is held, and once for every shard that it asks."""
    schema = pa.schema([("shard", pa.int64()), ("held", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def scan(batches):
        from xxhash import xxh3_64_intdigest

        router, out, ids = Router(split), Sink(schema), {}
        for word, n in rows_of(batches, "word", "n"):
            vector = router.vector(word)
            node, parts = router.home(vector)
            out.add(_shard_id(node, xxh3_64_intdigest(word.encode()) % parts), True, word, n)
            for place, many in router.asked(vector):
                for part in range(many):
                    if (place, part) not in ids:
                        ids[place, part] = _shard_id(place, part)
                    out.add(ids[place, part], False, word, n)
            if len(ids) > 100_000:
                ids.clear()
            if out.full():
                yield out.take()
        yield out.take()

    return counted.mapInArrow(scan, "shard long, held boolean, word string, n long")


class Words:
    """Words in code-point order as Latin-1 codes, and their vectors."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("word")  # UTF-8 order is code-point order
        self.words = table["word"].to_pylist()
        self.n = table["n"].to_numpy()
        codes = [w.encode("latin-1") for w in self.words]
        self.sizes = np.fromiter(map(len, codes), np.int64, len(codes))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.codes = np.frombuffer(b"".join(codes), np.uint8)
        group = np.zeros(256, np.int64)
        for letter, k in _GROUP_OF.items():
            group[ord(letter)] = k
        cells = np.repeat(np.arange(len(codes)), self.sizes) * len(GROUPS) + group[self.codes]
        counts = np.bincount(cells, minlength=len(codes) * len(GROUPS)).reshape(len(codes), len(GROUPS))
        self.vectors, inverse = np.unique(np.c_[self.sizes, counts], axis=0, return_inverse=True)
        inverse = inverse.ravel()
        self.by_vector = np.argsort(inverse, kind="stable")
        self.many = np.bincount(inverse, minlength=len(self.vectors))
        self.first = np.cumsum(self.many) - self.many

    def letters(self, rows: np.ndarray, size: int) -> np.ndarray:
        return self.codes[self.starts[rows][:, None] + np.arange(size)]


def search(held: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asked vector, held vector) within the budget: depth-first over blocks of search states."""
    if not len(held) or not len(asked):
        return
    top = int(max(held.max(), asked.max())) + 3
    # node k of a level is its k-th different prefix; the table of a level lists (parent, count) of its nodes
    tables, parent = [], np.zeros(len(held), np.int64)
    for level in range(held.shape[1]):
        keys, parent = np.unique(parent * top + held[:, level], return_inverse=True)
        parent = parent.ravel()
        tables.append(keys)
    stack = [(0, np.arange(len(asked)), np.zeros(len(asked), np.int64), np.ones(len(asked), bool), np.ones(len(asked), bool))]
    while stack:
        level, query, node, surplus, deficit = stack.pop()
        if level == held.shape[1]:
            yield query, node
            continue
        table, found = tables[level], []
        for step, may in ((0, None), (1, surplus), (-1, deficit)):
            q, at, s, d = (query, node, surplus, deficit) if may is None else (query[may], node[may], surplus[may], deficit[may])
            key = at * top + asked[q, level] + step
            place = np.searchsorted(table, key)
            hit = (place < len(table)) & (table[np.minimum(place, len(table) - 1)] == key)
            if level == 0:  # a longer word has a surplus only, a shorter one a deficit only
                s, d = (s, d) if step == 0 else (s, np.zeros_like(d)) if step == 1 else (np.zeros_like(s), d)
            elif step:
                s, d = (np.zeros_like(s), d) if step == 1 else (s, np.zeros_like(d))
            found.append((q[hit], place[hit], s[hit], d[hit]))
        q, at, s, d = (np.concatenate(x) for x in zip(*found, strict=True))
        for a in range(0, len(q), STATES):
            part = slice(a, a + STATES)
            stack.append((level + 1, q[part], at[part], s[part], d[part]))


def _one_apart(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replacement (equal width) or one insertion (`long` is one wider)."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= short.shape[1]


def _by_halves(asked: Words, held: Words, q: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two large leaves that share the first or the last half: one edit leaves one of both as it is."""
    half = int(min(asked.sizes[q[0]], held.sizes[h[0]])) // 2
    rest = int(min(asked.sizes[q[0]], held.sizes[h[0]])) - half
    pairs = set()
    for cut in (slice(None, half), slice(-rest, None)):
        places: dict[str, list[int]] = {}
        for x in h.tolist():
            places.setdefault(held.words[x][cut], []).append(x)
        for x in q.tolist():
            pairs.update((x, y) for y in places.get(asked.words[x][cut], ()))
    both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def near(asked: Words, held: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (asked word, held word) that differ by exactly one inserted, deleted or replaced code point."""

    def verified(q: np.ndarray, h: np.ndarray, a: int, b: int):
        """Of pairs of words of `a` and `b` letters those one apart."""
        step = max(1, CELLS // max(a, b))
        for at in range(0, len(q), step):
            part = slice(at, at + step)
            left, right = asked.letters(q[part], a), held.letters(h[part], b)
            ok = _one_apart(left, right) if a <= b else _one_apart(right, left)
            yield q[part][ok], h[part][ok]

    def leaves(query: np.ndarray, leaf: np.ndarray, a: int, b: int):
        pairs = asked.many[query] * held.many[leaf]
        for k in np.flatnonzero(pairs > MESH).tolist():
            x, y = query[k], leaf[k]
            q = asked.by_vector[asked.first[x] : asked.first[x] + asked.many[x]]
            yield from verified(*_by_halves(asked, held, q, held.by_vector[held.first[y] : held.first[y] + held.many[y]]), a, b)
        small = pairs <= MESH
        query, leaf, pairs = query[small], leaf[small], pairs[small]
        ends, at = np.cumsum(pairs), 0
        while at < len(pairs):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - pairs[at] + CELLS // 10)))
            n = pairs[at:to]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, y = np.repeat(query[at:to], n), np.repeat(leaf[at:to], n)
            q = asked.by_vector[asked.first[x] + place // held.many[y]]
            yield from verified(q, held.by_vector[held.first[y] + place % held.many[y]], a, b)
            at = to

    for query, leaf in search(held.vectors, asked.vectors):
        size = asked.vectors[query, 0]
        more = held.vectors[leaf, 0] - size
        sizes, which = np.unique(size * 3 + more + 1, return_inverse=True)
        for k, code in enumerate(sizes.tolist()):
            rows = np.flatnonzero(which == k)
            yield from leaves(query[rows], leaf[rows], code // 3, code // 3 + code % 3 - 1)


def _answer(table: pa.Table) -> pa.Table:
    """Per asking word the number of its near words in this shard and the one of largest n, ties in code-point order."""
    import pyarrow.compute as pc

    empty = pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.int64()), "best_n": pa.array([], pa.int64()), "best": pa.array([], pa.string())})
    flags = table["held"].combine_chunks()
    held, asked = table.filter(flags), table.filter(pc.invert(flags))
    if not held.num_rows or not asked.num_rows:
        return empty
    held, asked = Words(held), Words(asked)
    count, best = np.zeros(len(asked.words), np.int64), np.full(len(asked.words), -1)
    # places in order of falling n, then of code points: the smallest place is the best word
    order = np.lexsort((np.arange(len(held.n)), -held.n))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first = np.full(len(asked.words), len(order))
    for q, h in near(asked, held):
        count += np.bincount(q, minlength=len(count))
        np.minimum.at(first, q, rank[h])
    some = np.flatnonzero(count)
    best = order[first[some]]
    return pa.table({
        "word": pa.array([asked.words[k] for k in some.tolist()], pa.string()), "near": pa.array(count[some]),
        "best_n": pa.array(held.n[best]), "best": pa.array([held.words[k] for k in best.tolist()], pa.string()),
    })


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words with a form (word, form): the way to the root is halved in every round."""
    here = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = here.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = store(here.join(up.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        here = after.select("word", "root")
        if not after.where("moved").head(1):
            return here


def variants(counted: DataFrame, more: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n; `counted` as of `words`. A form has at least `more` times the word's n."""
    counted = store(counted, "words")
    answers = routed(counted, splits(counted)).groupBy("shard").applyInArrow(_answer, "word string, near long, best_n long, best string")
    found = answers.select("word", "near", F.lit(None).cast("long").alias("n"), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")).alias("best"))
    own = counted.select("word", F.lit(0).cast("long").alias("near"), "n", F.lit(None).cast(found.schema["best"].dataType).alias("best"))
    every = found.unionByName(own).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    fits = -F.col("best.less") >= more * F.col("n")
    every = store(every.select("word", "n", "n_near", F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    ways = roots(every.where("form IS NOT NULL"))
    return every.join(ways.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(words(spark.read.parquet(f"{sf_dir}/documents.parquet")))
