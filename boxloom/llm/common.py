"""What the operators share: intermediate tables, packed texts, Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; one of our own only where `spark.checkpoint.dir` is unset."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, most: int = 1000) -> SparkSession:
    """Let Arrow batches hold at most `most` rows from now on, since one row may be a whole text."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= most:
        spark.conf.set(name, str(most))
    return spark


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values, a thousand at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            yield from zip(*(part.column(part.schema.get_field_index(n)).to_pylist() for n in names), strict=True)


class Sink:
    """Collects columns and hands out Arrow batches of a bounded number of values."""

    def __init__(self, schema: pa.Schema, most: int = 200_000):
        self.schema, self.most = schema, most
        self.columns: list[list] = [[] for _ in schema]
        self.weight = 0

    def add(self, *values, weight: int = 1) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.weight += weight

    def full(self) -> bool:
        return self.weight >= self.most

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)], schema=self.schema
        )
        self.columns, self.weight = [[] for _ in self.schema], 0
        return batch


def packed(docs: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """doc_id, packed: the zstd-compressed UTF-8 text (null: empty), the form in which texts are shuffled; columns of `also`."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *also)
    schema = StructType([chosen.schema["doc_id"], StructField("packed", BinaryType()), *(chosen.schema[c] for c in also)])

    def pack(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=3)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                data = [squeeze.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(1)]
                columns = [batch.column(0), pa.array(data, pa.binary()), *batch.columns[2:]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "packed", *also])

    return chosen.mapInArrow(pack, schema)


def unpacker() -> Callable[[bytes], bytes]:
    import zstandard

    expand = zstandard.ZstdDecompressor()
    return lambda data: expand.decompress(data)
