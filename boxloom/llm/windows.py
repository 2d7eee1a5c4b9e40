"""Repeated fixed-length windows of a corpus, found through content-chosen anchors.

Every window of `length` units (words or bytes) names its anchor: the gram of `gram` units in it with the
smallest hash, the leftmost of equals. Equal windows name equal anchors, so a repeated window lies at an anchor
that occurs at least twice. Neighbouring windows with one anchor form a run; its text is a segment. Per run one
small row is shuffled instead of one row per window, and texts are read only for what hashes leave open:

1. anchors are counted (partial aggregation), runs at single anchors go;
2. runs with equal segments settle each other;
3. only anchors with several different segments need the segments' texts (`segment_texts`), which the two
   substring operators compare by their own method;
4. an anchor with more than `HOT` different segments is compared window by window, by an aggregation over
   window digests, so no group of unbounded size reaches one task.

Runs and segments are told apart by two 64-bit hashes (of anchor and segment) together. Rows with a null doc_id are
compared with nothing: they stay whole and no other row loses anything because of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, packed, rows_of, store, unpacker

HOT = 4000
_EVEN = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


@dataclass(frozen=True)
class Unit:
    """words: runs of non-white-space bytes; else single bytes."""

    words: bool
    length: int
    gram: int


class Reader:
    """Turns UTF-8 text into hashes of its units."""

    def __init__(self, unit: Unit):
        self.unit, self.known = unit, {}
        self.table = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64)

    def hashes(self, text: bytes) -> np.ndarray:
        if not self.unit.words:
            return self.table[np.frombuffer(text, np.uint8)]
        from xxhash import xxh3_64_intdigest

        if len(self.known) > 300_000:
            self.known.clear()
        known, out = self.known, []
        for word in text.split():
            h = known.get(word)
            if h is None:
                h = known[word] = xxh3_64_intdigest(word)
            out.append(h)
        return np.array(out, np.uint64)


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` units from each place, in steps of powers of two."""
    done, out, level = 1, units, 0
    parts: list[tuple[int, np.ndarray]] = []
    while done <= gram:
        if gram & done:
            parts.append((done, out))
        if 2 * done <= gram:
            out = out[: len(out) - done] * _EVEN[level % 4] + (out[done:] ^ (out[done:] >> np.uint64(31)))
        done, level = 2 * done, level + 1
    n = len(units) - gram + 1
    total, at = np.zeros(n, np.uint64), 0
    for k, (size, part) in enumerate(parts):
        total = (total + part[at : at + n]) * _EVEN[(k + 1) % 4]
        at += size
    total ^= total >> np.uint64(29)
    return total * _EVEN[2]


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in each stretch of `width` values."""
    best, place, done = values, np.arange(len(values)), 1
    while 2 * done <= width:
        n = len(best) - done
        later = best[done:] < best[:n]
        best, place = np.where(later, best[done:], best[:n]), np.where(later, place[done:], place[:n])
        done *= 2
    if done < width:
        n, off = len(best) - (width - done), width - done
        place = np.where(best[off:] < best[:n], place[off:], place[:n])
    return place


def runs_of(units: np.ndarray, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window, number of windows, and the anchor's place after the first unit of each run."""
    if len(units) < unit.length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    grams = gram_hashes(units, unit.gram)
    place = lowest(grams, unit.length - unit.gram + 1)
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return grams[place[start]].view(np.int64), start, np.diff(np.r_[start, len(place)]), place[start] - start


def runs(docs: DataFrame, unit: Unit, only_anchors: bool = False) -> DataFrame:
    """One row per run: anchor, and unless only anchors are asked for doc_id, start, n (windows), at, seg (hash)."""
    fields = [("anchor", pa.int64())]
    if not only_anchors:
        fields += [("doc_id", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("at", pa.int32()), ("seg", pa.int64())]
    schema = pa.schema(fields)

    def scan(batches):
        from xxhash import xxh3_64_intdigest

        reader = Reader(unit)
        held: list[tuple[np.ndarray, ...]] = []
        weight = 0

        def flush():
            columns = [np.concatenate(c) for c in zip(*held, strict=True)] or [np.zeros(0, np.int64)] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for key, text in rows_of(batches, "doc_id", "text"):
            data = (text or "").encode("utf-8", "surrogatepass")
            units = reader.hashes(data)
            anchor, start, n, at = runs_of(units, unit)
            if not len(anchor):
                continue
            if only_anchors:
                held.append((anchor,))
            else:
                raw, size = (units.tobytes(), 8) if unit.words else (data, 1)
                raw, more = memoryview(raw), unit.length - 1
                seg = [xxh3_64_intdigest(raw[s * size : (s + k + more) * size]) for s, k in zip(start.tolist(), n.tolist(), strict=True)]
                held.append((anchor, np.full(len(anchor), key), start, n, at, np.array(seg, np.uint64).view(np.int64)))
            weight += len(anchor)
            if weight >= 100_000:
                yield flush()
                held.clear()
                weight = 0
        if held:
            yield flush()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL")
    kind = {"anchor": "long", "doc_id": "long", "start": "int", "n": "int", "at": "int", "seg": "long"}
    return texts.mapInArrow(scan, ", ".join(f"{f.name} {kind[f.name]}" for f in schema))


@dataclass
class Candidates:
    runs: DataFrame  # anchor, seg, doc_id, start, n, at, first_doc, copies: runs at recurring anchors
    texts: DataFrame  # anchor, seg, first_doc, copies, kinds, at, units: one per different segment of an open anchor


def candidates(docs: DataFrame, unit: Unit, open_only: str) -> Candidates:
    """Runs at recurring anchors, and the texts of the segments that hashes leave open.

    `open_only`: a condition on a segment (copies) that some segment of an anchor must meet to keep it open.
    """
    # stored, so that the join below has two plain shuffles, of which a hot anchor's can be split at run time
    recurring = store(runs(docs, unit, only_anchors=True).groupBy("anchor").count().where("count > 1").select("anchor"), "recurring")
    found = store(runs(docs, unit).join(recurring, "anchor", "left_semi"), "runs")
    # stored for the same reason: a segment of very many runs is a hot key of the join
    segments = store(found.groupBy("anchor", "seg").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("copies")), "kinds")
    known = store(found.join(segments.hint("merge"), ["anchor", "seg"]), "segments")
    kinds = segments.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max(F.expr(open_only).cast("int")).alias("open")).where("kinds > 1 AND open = 1")
    wanted = (
        known.where("doc_id = first_doc")
        .groupBy("anchor", "seg", "doc_id", "n", "at", "copies")
        .agg(F.min("start").alias("start"))
        .join(kinds.select("anchor", "kinds"), "anchor")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("anchor", "seg", "start", "n", "at", "copies", "kinds")).alias("wanted"))
    )
    return Candidates(known, store(segment_texts(docs, wanted, unit), "texts"))


def segment_texts(docs: DataFrame, wanted: DataFrame, unit: Unit) -> DataFrame:
    """Cut the wanted segments out of their documents; words are joined by one space."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("first_doc", pa.int64()), ("copies", pa.int64()), ("kinds", pa.int64()), ("at", pa.int32()), ("units", pa.binary())])

    def cut(batches):
        expand, out = unpacker(), Sink(schema, 4_000_000)
        for key, data, items in rows_of(batches, "doc_id", "packed", "wanted"):
            text = expand(data)
            if unit.words:
                text = text.split()
            for item in items:
                part = text[item["start"] : item["start"] + item["n"] + unit.length - 1]
                part = b" ".join(part) if unit.words else part
                out.add(item["anchor"], item["seg"], key, item["copies"], item["kinds"], item["at"], part, weight=len(part) + 40)
            if out.full():
                yield out.take()
        yield out.take()

    return (
        packed(docs).join(wanted.hint("merge"), "doc_id")
        .mapInArrow(cut, "anchor long, seg long, first_doc long, copies long, kinds long, at int, units binary")
    )


def hot_windows(texts: DataFrame, unit: Unit) -> DataFrame:
    """Of segments at hot anchors, one row per window: digest, owner, segment, place."""
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("first_doc", pa.int64()), ("copies", pa.int64()), ("place", pa.int32()), ("digest", pa.binary())])

    def explode(batches):
        from xxhash import xxh3_128_digest

        out = Sink(schema, 100_000)
        for anchor, seg, first, copies, data in rows_of(batches, "anchor", "seg", "first_doc", "copies", "units"):
            parts = data.split(b" ") if unit.words else data
            for i in range(len(parts) - unit.length + 1):
                part = parts[i : i + unit.length]
                out.add(anchor, seg, first, copies, i, xxh3_128_digest(b" ".join(part) if unit.words else part))
            if out.full():
                yield out.take()
        yield out.take()

    return texts.where(F.col("kinds") > HOT).mapInArrow(
        explode, "anchor long, seg long, first_doc long, copies long, place int, digest binary"
    )


def sharded(texts: DataFrame, bytes_each: int) -> DataFrame:
    """Deal the segments of ordinary anchors to shards of about `bytes_each` bytes, an anchor to one shard."""
    plain = texts.where(F.col("kinds") <= HOT)
    total = plain.agg(F.sum(F.length("units"))).first()[0] or 0
    shards = max(1, -(-total // bytes_each))
    return plain.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))


def spans(whole: DataFrame, runs_left: DataFrame, hits: DataFrame, unit: Unit) -> DataFrame:
    """Per document the arrays of starts and ends of what goes: whole runs, and single windows of others."""
    more = unit.length - 1
    single = runs_left.join(hits, ["anchor", "seg"]).select(
        "doc_id", F.explode("places").alias("place"), "start"
    ).select("doc_id", (F.col("start") + F.col("place")).alias("from"), (F.col("start") + F.col("place") + unit.length).alias("to"))
    both = whole.select("doc_id", F.col("start").alias("from"), (F.col("start") + F.col("n") + more).alias("to")).unionByName(single)
    return both.distinct().groupBy("doc_id").agg(F.collect_list("from").alias("from"), F.collect_list("to").alias("to"))


def covered(size: int, starts: list[int], ends: list[int]) -> np.ndarray:
    """Mask of the units inside any of the spans."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:size]) > 0
