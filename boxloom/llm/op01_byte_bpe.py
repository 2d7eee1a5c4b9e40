"""Byte-level BPE: encode each distinct word once, join ids back, reassemble by position; decode by a table join.

Texts are cut into pre-tokens by the vocabulary's pattern. A task packs neighbouring documents into chunks: the
chunk's different pre-tokens, and for each position the number of its pre-token. One shuffle by word brings the
chunks' pre-tokens together, sorted; each distinct word is encoded once by the merge ranks and its ids go to all its
rows, which are the chunks that hold it. A second shuffle takes the ids back to their chunk, which is reassembled
by position. Nothing is grouped beyond a chunk of bounded size, and a word that every document holds is one row per
chunk. Decoding joins ids with the token-byte table, which has one
row per vocabulary entry and is therefore shipped to the tasks.

Null text: empty, no ids. Every row is encoded by itself, so repeated rows come back repeated. Other columns are
ignored. An empty table gives an empty result. An id outside the vocabulary is an error when decoding.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import Sink, rows_of, shared_dir, small_batches

CHUNK_CHARS = 16_000_000
#: Chunks of a task take numbers after its partition's; a word's reference is its chunk's number and its place there.
CHUNKS_PER_TASK = 1 << 12
PLACES = 1 << 31
#: Ids are sent back in blobs of this many words at most.
BLOB_WORDS = 200_000

Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def load_ranks(path: str) -> dict[bytes, int]:
    """Merge ranks from a file of lines: base64 of the token's bytes, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _planes(numbers: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes, which pack better than the numbers."""
    return numbers.view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _known(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, numbers of ids and ids of the words of a blob."""
    n = 4 * int(np.frombuffer(blob, np.uint32, 1)[0])
    return np.cumsum(_numbers(blob[4 : 4 + n]), dtype=np.uint32), _numbers(blob[4 + n : 4 + 2 * n]), _numbers(blob[4 + 2 * n :])


def _bucketed(chunks: DataFrame) -> DataFrame:
    """Write the chunks into the shared folder in buckets by chunk, so that ids are joined without moving them."""
    spark, name = chunks.sparkSession, f"llm_chunks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = chunks.write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}")
    writer.bucketBy(buckets, "chunk").saveAsTable(name)
    return spark.table(name)


def _chunks(docs: DataFrame, pattern: str) -> DataFrame:
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("places", pa.binary()), ("words", pa.list_(pa.string()))]
    )

    def cut(batches):
        import regex
        import zstandard
        from pyspark import TaskContext

        find, squeeze = regex.compile(pattern).findall, zstandard.ZstdCompressor(level=3)
        ids, sizes, places, words, held = [], [], [], {}, 0
        numbers = iter(range(TaskContext.get().partitionId() * CHUNKS_PER_TASK, (TaskContext.get().partitionId() + 1) * CHUNKS_PER_TASK))

        def chunk():
            out = Sink(schema)
            flat = np.concatenate(places) if places else np.zeros(0, np.uint32)
            # frequent words first, so numbers pack better; words of one frequency in order, so words do
            names, counts = list(words), np.bincount(flat, minlength=len(words)).tolist()
            often = sorted(sorted(range(len(names)), key=names.__getitem__), key=lambda i: -counts[i])
            number = np.empty(len(words), np.uint32)
            number[often] = np.arange(len(words), dtype=np.uint32)
            flat = number[flat]
            out.add(next(numbers), ids, sizes, squeeze.compress(_planes(flat)), [names[i] for i in often])
            return out.take()

        for key, text in rows_of(batches, "doc_id", "text"):
            found = find(text or "")
            places.append(np.array([words.setdefault(w, len(words)) for w in found], np.uint32))
            ids.append(key)
            sizes.append(len(found))
            held += len(text or "") + 100
            if held >= CHUNK_CHARS:
                yield chunk()
                ids, sizes, places, words, held = [], [], [], {}, 0
        if ids:
            yield chunk()

    return docs.mapInArrow(cut, "chunk long, doc_ids array<long>, sizes array<int>, places binary, words array<string>")


def _encoder(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, Batches]:
    """Chunks with the ids of their words, and what puts them together in a task: batches of doc_id, ids."""
    spark = small_batches(docs.sparkSession)
    ranks = spark.sparkContext.broadcast(load_ranks(path))
    chunks = _bucketed(_chunks(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), pattern))
    words = chunks.select("chunk", F.posexplode("words").alias("place", "word")).select("word", (F.col("chunk") * PLACES + F.col("place")).alias("ref"))

    def merge(batches):
        import tiktoken
        import zstandard

        # the pattern takes the whole word, since words are already cut
        coder = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks.value, special_tokens={})
        word, ids = None, b""
        held: dict[int, list] = {}
        count = 0

        def blobs():
            squeeze, out = zstandard.ZstdCompressor(level=3), Sink(schema)
            for chunk, items in held.items():
                items.sort()
                places, lists = zip(*items, strict=True)
                sizes = np.array([len(x) // 4 for x in lists], np.uint32)
                steps = np.diff(np.array(places, np.uint32), prepend=np.uint32(0))
                body = [np.uint32(len(items)).tobytes(), _planes(steps), _planes(sizes), _planes(np.frombuffer(b"".join(lists), np.uint32))]
                out.add(chunk, squeeze.compress(b"".join(body)))
            held.clear()
            return out.take()

        for batch in batches:
            for here, ref in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if here != word:
                    word, ids = here, np.array(coder.encode_ordinary(here), np.uint32).tobytes()
                held.setdefault(ref // PLACES, []).append((ref % PLACES, ids))
                count += 1
                if count >= BLOB_WORDS:
                    yield blobs()
                    count = 0
        yield blobs()

    schema = pa.schema([("chunk", pa.int64()), ("blob", pa.binary())])
    encoded = words.repartition("word").sortWithinPartitions("word").mapInArrow(merge, "chunk long, blob binary")
    joined = encoded.groupBy("chunk").agg(F.collect_list("blob").alias("blobs"))

    def reassemble(batches):
        import zstandard

        expand = zstandard.ZstdDecompressor()

        def texts(part):
            """doc_ids and ids of a chunk's texts; what leads to them is let go before they are sent."""
            column = lambda name: part.column(part.schema.get_field_index(name))
            sizes = np.asarray(column("sizes").flatten())
            places = _numbers(expand.decompress(column("places")[0].as_py()))
            known = [_known(expand.decompress(blob)) for blob in column("blobs")[0].as_py() or []]
            where, lengths, ids = (np.concatenate([k[i] for k in known]) if known else np.zeros(0, np.uint32) for i in range(3))
            words = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(ids.view(np.int32)))
            lists = words.take(pa.array(np.argsort(where))).take(pa.array(places))
            # the offsets count the ids already, up to each place
            ends = np.asarray(lists.offsets)[np.r_[0, np.cumsum(sizes)].astype(np.int64)]
            return column("doc_ids").flatten(), pa.ListArray.from_arrays(pa.array(ends - ends[0]), lists.flatten())

        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, ids = texts(batch.slice(row, 1))
                for at in range(0, len(ids), 500):
                    yield pa.RecordBatch.from_arrays([doc_ids.slice(at, 500), ids.slice(at, 500)], names=["doc_id", "ids"])

    return chunks.select("chunk", "doc_ids", "sizes", "places").join(joined.hint("merge"), "chunk", "left"), reassemble


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of each text, without special tokens."""
    chunks, reassemble = _encoder(docs, path, pattern, id_col, text_col)
    return chunks.mapInArrow(reassemble, "doc_id long, ids array<int>")


def _decoder(spark: SparkSession, path: str) -> Batches:
    """What adds to batches of doc_id, ids the bytes `decoded` that the ids stand for."""
    ranks = load_ranks(path)
    table = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    tokens = spark.sparkContext.broadcast(table)

    def join(batches):
        known = pa.array(tokens.value, pa.binary())
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lists = batch.column(1)
                ids = lists.flatten()
                if len(ids) and not 0 <= pc.min(ids).as_py() <= pc.max(ids).as_py() < len(known):
                    raise ValueError("an id outside the vocabulary")
                found = known.take(ids)
                if found.null_count:
                    raise ValueError("an id outside the vocabulary")
                ends = np.r_[0, np.cumsum(np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64))]
                offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1] if len(found) else np.zeros(1, np.int32)
                data = found.buffers()[2] if len(found) else pa.py_buffer(b"")
                texts = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(offsets[ends].astype(np.int32).tobytes()), data])
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, texts], names=["doc_id", "ids", "decoded"])

    return join


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, ids, decoded: the bytes that the ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(encoded.sparkSession, path), "doc_id long, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """`decode` of what `encode` gives, in one Python worker a task: two would each hold a chunk's ids."""
    chunks, reassemble = _encoder(docs, path, pattern)
    join = _decoder(docs.sparkSession, path)
    return chunks.mapInArrow(lambda batches: join(reassemble(batches)), "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text after a round trip."""
    return round_trip(docs, path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
