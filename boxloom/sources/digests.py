"""SHA-256 of files, those of a bounded size in the JVM, larger ones in blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.sources.stores import opened

BLOCK = 64 << 20


def with_sha256(files: DataFrame, block_bytes: int = BLOCK) -> DataFrame:
    """``files`` with ``sha256`` of the file at ``path``, read in blocks; files that cannot be read have null."""
    names = files.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = []
            for path in part.column(names.index("path")).to_pylist():
                if path is None:
                    found.append(None)
                    continue
                try:
                    digest = hashlib.sha256()
                    store, at = opened(path)
                    with store.open_input_stream(at) as file:
                        while block := file.read(block_bytes):
                            digest.update(block)
                    found.append(digest.hexdigest())
                except OSError:
                    found.append(None)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.string())], [*names, "sha256"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema.fields)
    return files.mapInArrow(run, f"{schema}, sha256 string")


def sha256_files(spark: SparkSession, path: str, block_bytes: int = BLOCK) -> DataFrame:
    """``path``, ``size_bytes`` and ``sha256`` of the files below a folder.

    Files of up to a block are read and hashed by Spark; the reader leaves larger ones out by their size, and
    they are hashed block by block, so that no file has to fit into a row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    small = files.where(F.col("length") <= block_bytes).select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > block_bytes).select("path", F.col("length").alias("size_bytes"))
    return small.unionByName(with_sha256(large, block_bytes))
