"""Batch sinks. Stream sinks live in
``quarry.streaming.streams``."""

from __future__ import annotations

import struct
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, col: str | None = None, mode: str = "errorifexists") -> None:
    """SNK-1: one text line per row (a folder of part files)."""
    col = col or df.columns[0]
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "errorifexists") -> None:
    """SNK-5: rows as CSV (e.g. (i, value) rows of a vector or matrix)."""
    df.write.mode(mode).option("header", header).csv(path)


def kafka_frame(df: DataFrame, col: str = "value") -> DataFrame:
    """SNK-4: the (key, value) shape the Kafka sink expects, with a NULL key."""
    return df.select(F.lit(None).cast("string").alias("key"), F.col(col).cast("string").alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str, col: str = "value") -> None:
    """SNK-4: publish every row to ``topic``; waits for all in-sync replicas
    (acks=all). Needs the Kafka connector on the classpath."""
    (kafka_frame(df, col).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic)
     .option("kafka.acks", "all").save())


def grey_png(pixels: bytes, width: int, height: int) -> bytes:
    """An 8-bit grey image as a PNG file."""
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = b"".join(b"\0" + pixels[i * width:(i + 1) * width] for i in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def write_images(df: DataFrame, path: str, name: str, pixels: str, width: int, height: int) -> int:
    """Write each row's grey ``pixels`` (binary, row by row) as ``<name>.png`` under
    ``path``, a folder all executors reach; returns the number of files. A task that
    runs again writes the same files. Null pixels are left out."""
    def write(batches):
        import pandas as pd
        from pyarrow import fs
        target, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        target.create_dir(root)
        for pdf in batches:
            for key, raw in zip(pdf["name"], pdf["pixels"]):
                with target.open_output_stream(f"{root}/{key}.png") as f:
                    f.write(grey_png(bytes(raw), width, height))
            yield pd.DataFrame({"n": [len(pdf)]})
    rows = df.where(F.col(pixels).isNotNull()).select(F.col(name).cast("string").alias("name"), F.col(pixels).alias("pixels"))
    return rows.mapInPandas(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
