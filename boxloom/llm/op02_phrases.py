"""Substring dedup by recurring phrases: sharded Aho-Corasick automata over word windows.

A window is `length` consecutive words of one document. Each word covered by a window that also starts in a
document with a smaller doc_id is removed; windows are judged on the input.

Method: recurring passages are confirmed through anchors (`boxloom.llm.windows`), the windows that occur in several
different segments are compiled into one automaton per shard (words coded as characters of a shard-local
alphabet, so a match is a match of whole words), and all open segments of the documents are streamed through
their shard's automaton to locate every occurrence together with the smallest document that holds it.

Null text: no words. Texts of fewer than `length` words stay whole. Rows that repeat a doc_id must repeat its
text; they do not remove each other. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, packed, rows_of, store, unpacker
from boxloom.llm.windows import Unit, candidates, covered, hot_windows, sharded, spans

SHARD_BYTES = 1_500_000


def _alphabet_code(n: int) -> str:
    """The n-th character outside the surrogates."""
    return chr(n if n < 0xD800 else n + 0x800)


def _occurrences(length: int):
    schema = pa.schema([("anchor", pa.int64()), ("seg", pa.int64()), ("places", pa.list_(pa.int32()))])

    def locate(table: pa.Table) -> pa.Table:
        import ahocorasick

        codes: dict[bytes, str] = {}
        coded, owners, out = [], [], Sink(schema)
        keys = list(zip(table["anchor"].to_pylist(), table["seg"].to_pylist(), strict=True))
        for owner, units in zip(table["first_doc"].to_pylist(), table["units"].to_pylist(), strict=True):
            coded.append("".join([codes.setdefault(w, _alphabet_code(len(codes) + 1)) for w in units.split(b" ")]))
            owners.append(owner)
        first: dict[str, int] = {}
        several: set[str] = set()
        for text, owner in zip(coded, owners, strict=True):
            for window in {text[i : i + length] for i in range(len(text) - length + 1)}:
                if window in first:
                    several.add(window)
                    first[window] = min(first[window], owner)
                else:
                    first[window] = owner
        automaton = ahocorasick.Automaton()
        for window in several:
            automaton.add_word(window, first[window])
        del first
        automaton.make_automaton()
        if len(automaton):
            for key, text, owner in zip(keys, coded, owners, strict=True):
                places = [end - length + 1 for end, smallest in automaton.iter(text) if smallest < owner]
                if places:
                    out.add(*key, places)
        return pa.Table.from_batches([out.take()])

    return locate


def remove_repeated_phrases(docs: DataFrame, length: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space)."""
    unit = Unit(words=True, length=length, gram=max(1, min(5, length - 4)))
    found = candidates(docs, unit, "copies >= 1")
    shards = sharded(found.texts, SHARD_BYTES)
    located = shards.groupBy("shard").applyInArrow(_occurrences(length), "anchor long, seg long, places array<int>")
    windows = hot_windows(found.texts, unit)
    smallest = windows.groupBy("digest").agg(F.min("first_doc").alias("smallest"), F.count("*").alias("times")).where("times > 1")
    hot = (
        windows.join(smallest, "digest").where("smallest < first_doc").groupBy("anchor", "seg").agg(F.collect_list("place").alias("places"))
    )
    hits = located.unionByName(hot)
    gone = spans(found.runs.where("doc_id > first_doc"), found.runs.where("doc_id = first_doc"), hits, unit)

    def keep(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
        expand, out = unpacker(), Sink(schema, 4_000_000)
        for key, data, starts, ends in rows_of(batches, "doc_id", "packed", "from", "to"):
            words = expand(data).split()
            left = words
            if starts:
                mask = covered(len(words), starts, ends)
                left = [w for w, away in zip(words, mask.tolist(), strict=True) if not away]
            kept = b" ".join(left).decode("utf-8", "replace")
            out.add(key, len(words), len(words) - len(left), kept, weight=len(kept) + 50)
            if out.full():
                yield out.take()
        yield out.take()

    return packed(docs).join(store(gone, "spans").hint("merge"), "doc_id", "left").mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeated_phrases(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH split AS (
 SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
 SELECT doc_id, place, array_to_string(list_slice(words, place, place + 12), ' ') AS phrase
 FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM split WHERE len(words) >= 13)
), owners AS (
 SELECT phrase, min(doc_id) AS owner FROM windows GROUP BY phrase
), gone AS (
 SELECT DISTINCT doc_id, w.place + step AS place FROM windows w JOIN owners USING (phrase), (SELECT unnest(range(13)) AS step) WHERE owner < doc_id
), placed AS (
 SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split
), kept AS (
 SELECT p.doc_id, count(*) AS n_words, count(g.place) AS n_removed, string_agg(word, ' ' ORDER BY p.place) FILTER (WHERE g.place IS NULL) AS kept
 FROM placed p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
