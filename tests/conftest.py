import os
import struct
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    import boxloom

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield boxloom.configure(session)
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate columns on a single row."""

    def evaluate(*columns):
        return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0])

    return evaluate


@pytest.fixture(scope="session")
def write_png():
    """Write an RGB PNG whose pixel (x, y) is (x, y, 7)."""

    def write(path, width, height):
        rows = b"".join(b"\0" + bytes(v for x in range(width) for v in (x % 256, y % 256, 7)) for y in range(height))

        def chunk(kind, data):
            body = kind + data
            return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

        header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
        data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")
        with open(path, "wb") as out:
            out.write(data)

    return write
