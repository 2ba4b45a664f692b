"""Tables that a job writes on its way, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from boxloom.sources.scratch import new_path


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage ends there.

    Parquet rather than ``checkpoint()``: it is compressed and later steps read only the columns
    they use. The table outlives a lost executor; it goes with ``removed`` or with the folder.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def removed(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that no frame still to be computed reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
