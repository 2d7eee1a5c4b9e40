"""Exact dedup: compressed radix (Patricia) tries over whole byte strings, terminal nodes own a text.

Every map task puts its texts into a trie, so equal texts leave it as one partial entry with a count and the winning
doc_id; a member row says which entry (token) a document belongs to. Entries are dealt by length and content hash to
partitions, whose tries merge equal strings byte by byte: the hash only deals, it never decides. A terminal node keeps
the winning doc_id, the number of rows and the tokens of its entries (one per map task and eviction, not one per document).

A trie holds at most `trie_bytes`. In a map task the heaviest subtree leaves early as partial entries. In a partition the
heaviest subtree is closed: its strings, and all that reach it later, are spilled as rows of the stored result, and the
next round deals the spilled strings by subtree, length and content hash to tries of their own. Spills are tables in the
shared folder, so a lost executor only repeats its tasks.

Null text: empty. Null doc_id: such rows are documents too and win only where every equal text has a null doc_id. Rows that
repeat a doc_id and a text are copies, all of which are kept if that doc_id wins. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, rows_of, store, unpacker

TRIE_BYTES = 48_000_000
#: Partitions of one round; beyond it partitions get larger and tries spill.
MOST_PARTITIONS = 100_000
#: Bytes that a node takes besides its label, as measured on 64-bit Python.
NODE_BYTES = 400

SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
 sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _shared(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of `label` and `text[at:]`."""
    n = min(len(label), len(text) - at)
    if text.startswith(label[:n], at):
        return n
    low, step = 0, 16
    while text.startswith(label[low : low + step], at + low) and low + step <= n:
        low, step = low + step, 2 * step
    high = min(n, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle
    return low


class Node:
    """`children` by first byte; None: closed, what lies below is elsewhere and `value` names it."""

    __slots__ = ("children", "label", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.value, self.children = label, value, {}


class Trie:
    """A compressed radix tree from byte strings to values."""

    def __init__(self):
        self.root, self.bytes, self.strings = Node(b""), 0, 0

    def find(self, text: bytes) -> tuple[Node, int]:
        """The node that stands for `text`, made if need be; or a closed node above it. And how much of the text leads there."""
        node, at, n = self.root, 0, len(text)
        while at < n:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.bytes += n - at + NODE_BYTES
                return child, n
            label = child.label
            same = _shared(label, text, at)
            if same < len(label):
                above = node.children[text[at]] = Node(label[:same])
                child.label = label[same:]
                above.children[label[same]] = child
                self.bytes += NODE_BYTES
                child = above
            node, at = child, at + same
            if node.children is None:
                break
        return node, at

    def strings_below(self, top: Node, prefix: bytes) -> Iterator[tuple[bytes, Node]]:
        """Strings and nodes at and below `top`; `prefix` leads to it and is included."""
        stack, path = [(top, 0)], []
        while stack:
            node, depth = stack.pop()
            del path[depth:]
            path.append(prefix if node is top else node.label)
            if node.children is None:
                continue
            if node.value is not None:
                yield b"".join(path), node
            stack.extend((child, depth + 1) for child in node.children.values())

    def heaviest(self) -> tuple[Node, Node, bytes] | None:
        """Parent, subtree, string that leads to it: the heaviest of at most half of all bytes, or a leaf.

        Subtrees with a closed node inside are left out, since their strings already go elsewhere.
        """
        order, above = [self.root], {}
        for node in order:
            for child in (node.children or {}).values():
                above[child] = node
                order.append(child)
        weight, whole, best = {}, {}, None
        for node in reversed(order):
            below = (node.children or {}).values()
            weight[node] = len(node.label) + NODE_BYTES + sum(weight[c] for c in below)
            whole[node] = node.children is not None and all(whole[c] for c in below)
        for node in order[1:]:
            if whole[node] and (not node.children or weight[node] <= weight[self.root] / 2) and (best is None or weight[node] > weight[best]):
                best = node
        if best is None:
            return None
        self.bytes -= weight[best] - NODE_BYTES - len(best.label)
        path, node = [], best
        while node is not self.root:
            path.append(node.label)
            node = above[node]
        return above[best], best, b"".join(reversed(path))


def entries(docs: DataFrame, largest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Members (doc_id, token) and partial entries (token, size, hash, packed text, top: winning doc_id, n, sha)."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("token", pa.int64()), ("size", pa.int64()), ("hash", pa.int64()), ("packed", pa.binary()),
        ("top", pa.int64()), ("n", pa.int64()), ("sha", pa.binary()),
    ])
    better = max if largest else min

    def scan(batches):
        from hashlib import sha256

        import zstandard
        from pyspark import TaskContext
        from xxhash import xxh3_64_intdigest

        squeeze = zstandard.ZstdCompressor(level=3)
        trie, out, token = Trie(), Sink(schema), TaskContext.get().partitionId() << 36

        def leave(top: Node, prefix: bytes):
            for text, node in trie.strings_below(top, prefix):
                token, best, n = node.value
                trie.strings -= 1
                data = squeeze.compress(text)
                h = xxh3_64_intdigest(text) - (1 << 63)
                out.add(None, token, len(text), h, data, best, n, sha256(text).digest(), weight=len(data) // 50 + 1)
                if out.full():
                    yield out.take()

        for doc_id, text in rows_of(batches, "doc_id", "text"):
            node, _ = trie.find(text or b"")
            if node.value is None:
                node.value = [token, doc_id, 1]
                token += 1
                trie.strings += 1
            else:
                held = node.value
                held[1] = held[1] if doc_id is None else doc_id if held[1] is None else better(held[1], doc_id)
                held[2] += 1
            out.add(doc_id, node.value[0], *[None] * 6)
            if out.full():
                yield out.take()
            while trie.bytes > trie_bytes and trie.strings > 1 and (found := trie.heaviest()):
                parent, top, prefix = found
                yield from leave(top, prefix)
                del parent.children[top.label[0]]
                trie.bytes -= NODE_BYTES + len(top.label)
        yield from leave(trie.root, b"")
        yield out.take()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return texts.mapInArrow(scan, "doc_id long, token long, size long, hash long, packed binary, top long, n long, sha binary")


_OWNED = "token long, keep_id long, group_size long, sha binary, tree long, size long, hash long, packed binary, tokens array<long>"


def _merge(dealt: DataFrame, largest: bool, trie_bytes: int) -> DataFrame:
    """Owners of the tokens (token, keep_id, group_size, sha), and spilled strings (tree, size, hash, packed, tokens and the rest)."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    schema = pa.schema(list(zip((f.split()[0] for f in _OWNED.split(", ")), kinds, strict=True)))
    better = max if largest else min

    def scan(batches):
        import zstandard
        from pyspark import TaskContext

        squeeze, expand = zstandard.ZstdCompressor(level=3), unpacker()
        trie, out, tree = Trie(), Sink(schema), TaskContext.get().partitionId() << 36

        def spill(name, rest, size, h, sha, top, n, tokens):
            data = squeeze.compress(rest)
            out.add(None, top, n, sha, name, size, h, data, list(tokens), weight=len(data) // 50 + len(tokens) + 1)

        for above, size, h, data, top, n, sha, tokens in rows_of(batches, "tree", "size", "hash", "packed", "top", "n", "sha", "tokens"):
            text = above.to_bytes(8, "big") + expand(data)
            node, at = trie.find(text)
            if node.children is None:
                spill(node.value, text[at:], size, h, sha, top, n, tokens)
            elif node.value is None:
                node.value = [size, h, sha, top, n, array("q", tokens)]
                trie.strings += 1
                trie.bytes += 8 * len(tokens)
            else:
                held = node.value
                held[3] = held[3] if top is None else top if held[3] is None else better(held[3], top)
                held[4] += n
                held[5].extend(tokens)
                trie.bytes += 8 * len(tokens)
            while trie.bytes > trie_bytes and trie.strings > 1 and (found := trie.heaviest()):
                for rest, node in trie.strings_below(found[1], b""):
                    trie.strings -= 1
                    trie.bytes -= 8 * len(node.value[5])
                    spill(tree, rest, *node.value)
                    if out.full():
                        yield out.take()
                found[1].children, found[1].value = None, tree
                tree += 1
            if out.full():
                yield out.take()
        for _, node in trie.strings_below(trie.root, b""):
            _, _, sha, top, n, tokens = node.value
            for token in tokens:
                out.add(token, top, n, sha, *[None] * 5)
                if out.full():
                    yield out.take()
        yield out.take()

    return dealt.mapInArrow(scan, _OWNED)


def owners(docs: DataFrame, largest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, sha (digest of the text) of every row."""
    spark = docs.sparkSession
    held = store(entries(docs, largest, trie_bytes), "entries")
    left = held.where("packed IS NOT NULL").select(F.lit(0).cast("long").alias("tree"), "size", "hash", "packed", "top", "n", "sha", F.array("token").alias("tokens"))
    owned, least = None, int(spark.conf.get("spark.sql.shuffle.partitions"))
    while owned is None or left.head(1):
        total = left.agg(F.sum(F.col("size") + 2 * NODE_BYTES)).first()[0] or 0
        parts = min(max(least, -(-2 * total // trie_bytes)), MOST_PARTITIONS)
        done = store(_merge(left.repartition(parts, "tree", "size", "hash"), largest, trie_bytes), "owners")
        here = done.where("token IS NOT NULL").select("token", "keep_id", "group_size", "sha")
        owned = here if owned is None else owned.unionByName(here)
        left = done.where("token IS NULL").select("tree", "size", "hash", "packed", F.col("keep_id").alias("top"), F.col("group_size").alias("n"), "sha", "tokens")
    return held.where("packed IS NULL").select("doc_id", "token").join(owned.hint("merge"), "token").drop("token")


def drop_copies(docs: DataFrame, largest: bool = True) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    kept = owners(docs, largest).where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", F.lower(F.hex("sha")).alias("sha"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    wanted = store(kept.distinct(), "kept").hint("merge")
    text = F.sha2(F.coalesce(F.col("row.text").cast("string"), F.lit("")), 256)
    return rows.join(wanted, F.col("row.doc_id").cast("long").eqNullSafe(F.col("doc_id")) & (text == F.col("sha")), "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = owners(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )
