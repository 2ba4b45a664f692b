"""Files of one image each under its split, loose or in archives: sinks for label texts or other contents, and readers of such trees."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from boxloom.sources.stores import hadoop_path, opened

SPLITS = ("train", "validation", "val", "test", "cross_test")


@dataclass
class Written(WriterCommitMessage):
    n_files: int
    n_bytes: int
    archives: tuple[str, ...] = ()


def _file_names(*names: str) -> None:
    for name in names:
        if not name or "/" in name or name in (".", ".."):
            raise ValueError(f"not a file name: {name!r}")


class _Writer(DataSourceArrowWriter):
    """Tasks write ``<staging>/<split>/<image><suffix>``; nothing is published before the driver renames the staging folder.

    A file is written under a name of the attempt and then renamed, so that an attempt that is repeated, or runs
    twice at once, leaves whole files of equal content.
    """

    def __init__(self, staging: str, suffix: str):
        self.staging, self.suffix = staging, suffix

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.staging)
        made, n, size, attempt = set(), 0, 0, uuid.uuid4().hex
        for part in iterator:
            for split, image, data in zip(*(part.column(c).to_pylist() for c in ("split", "image_id", "content")), strict=True):
                _file_names(split, image)
                if split not in made:
                    store.create_dir(f"{root}/{split}", recursive=True)
                    made.add(split)
                with store.open_output_stream(f"{root}/{split}/.{image}.{attempt}") as file:
                    file.write(data)
                store.move(f"{root}/{split}/.{image}.{attempt}", f"{root}/{split}/{image}{self.suffix}")
                n, size = n + 1, size + len(data)
        return Written(n, size)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = opened(self.staging)
        if store.get_file_info(root).type.name == "Directory":
            store.delete_dir(root)


#: Files of an archive, and their bytes, at which it is closed.
ARCHIVE_FILES, ARCHIVE_BYTES = 10_000, 4 << 20


class _ArchiveWriter(_Writer):
    """Tasks pack files into ``<staging>/.pending/<split>-<attempt>-<number>.zip``; those of the attempts that Spark commits move to their split."""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = opened(self.staging)
        store.create_dir(f"{root}/.pending", recursive=True)
        n, total, attempt, done, held = 0, 0, uuid.uuid4().hex, [], {}

        def close(split: str) -> None:
            buffer, archive, _ = held.pop(split)
            archive.close()
            done.append(f"{split}/{attempt}-{len(done)}.zip")
            with store.open_output_stream(f"{root}/.pending/{done[-1].replace('/', '-')}") as file:
                file.write(buffer.getbuffer())

        for part in iterator:
            for split, image, data in zip(*(part.column(c).to_pylist() for c in ("split", "image_id", "content")), strict=True):
                _file_names(split, image)
                if split not in held:
                    buffer = io.BytesIO()
                    held[split] = [buffer, zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED), 0]
                held[split][1].writestr(image + self.suffix, data)
                held[split][2] += len(data)
                n, total = n + 1, total + len(data)
                if held[split][2] >= ARCHIVE_BYTES or len(held[split][1].filelist) >= ARCHIVE_FILES:
                    close(split)
        for split in list(held):
            close(split)
        return Written(n, total, tuple(done))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = opened(self.staging)
        store.create_dir(f"{root}/.pending", recursive=True)
        names = [name for m in messages if m for name in m.archives]
        for split in {name.split("/")[0] for name in names}:
            store.create_dir(f"{root}/{split}", recursive=True)
        for name in names:
            store.move(f"{root}/.pending/{name.replace('/', '-')}", f"{root}/{name}")
        store.delete_dir(f"{root}/.pending")


class ImageFiles(DataSource):
    """Format ``image_files`` with the options ``path``, ``suffix`` and ``archives`` (true or false): rows of split, image_id and content (bytes), a file each."""

    @classmethod
    def name(cls) -> str:
        return "image_files"

    def writer(self, schema, overwrite: bool) -> _Writer:
        missing = {"split", "image_id", "content"} - set(schema.fieldNames())
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")
        kind = _ArchiveWriter if self.options.get("archives") == "true" else _Writer
        return kind(self.options["path"], self.options["suffix"])


def write_files(files: DataFrame, path: str, suffix: str, archives: bool = False) -> None:
    """Write ``files`` (split, image_id, content) as ``<path>/<split>/<image_id><suffix>``, all of them or none.

    With ``archives`` the files of a split are members ``<image_id><suffix>`` of ``<path>/<split>/*.zip``: a loose file takes a
    block of the disk, however short it is. A path that exists, two rows of one image in a split, and a name that is no file name are refused.
    """
    spark = files.sparkSession
    store, target = hadoop_path(spark, path)
    if store.exists(target):
        raise ValueError(f"{path} exists")
    if files.groupBy("split", "image_id").count().where("count > 1").limit(1).count():
        raise ValueError("an image has two rows in a split")
    staging = f"{target.toString()}.staging-{uuid.uuid4().hex}"
    spark.dataSource.register(ImageFiles)
    rows = files.select(F.col("split").cast("string"), F.col("image_id").cast("string"), F.col("content").cast("binary"))
    try:
        rows.write.format("image_files").option("path", staging).option("suffix", suffix).option("archives", str(archives).lower()).mode("append").save()
        if not store.rename(hadoop_path(spark, staging)[1], target):
            raise ValueError(f"{path} cannot be published")
    finally:
        store.delete(hadoop_path(spark, staging)[1], True)


def write_label_files(labels: DataFrame, path: str, archives: bool = False) -> None:
    """Write ``labels`` (split, image_id, label_text) as ``.txt`` files, as ``write_files`` does.

    A null or empty text (a negative) gives an empty line, as Spark's readers do not see files without a byte.
    """
    content = F.concat(F.coalesce("label_text", F.lit("")), F.lit("\n"))
    write_files(labels.select("split", "image_id", content.alias("content")), path, ".txt", archives)


def list_assets(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".jpg", ".png"), splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """The files below ``path`` with ``split``, ``image_id``, size and ``issue``, without reading their content.

    UNEXPECTED_PATH: not ``<split>/<image><suffix>`` with a known split and suffix, so without split and image.
    DUPLICATE_ID: an image of that name is at more than one expected path; ``first`` marks the one to use. Spark
    lists no files without a byte.
    """
    root = str(hadoop_path(spark, path)[1].toString())
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    rows = rows.withColumn("relative_path", F.expr(f"substring(path, {len(root) + 2})"))
    part = F.split("relative_path", "/")
    expected = (F.size(part) == 2) & part[0].isin(*splits) & F.lower(F.regexp_extract("relative_path", r"(\.[^./]+)$", 1)).isin(*suffixes)
    rows = rows.withColumn("split", F.when(expected, part[0])).withColumn("image_id", F.when(expected, F.regexp_extract("relative_path", r"([^/]+)\.[^./]+$", 1)))
    ids = rows.where("image_id IS NOT NULL").groupBy("image_id").agg(F.count(F.lit(1)).alias("n"), F.min("relative_path").alias("least"))
    issue = F.when(F.col("image_id").isNull(), "UNEXPECTED_PATH").when(F.col("n") > 1, "DUPLICATE_ID")
    return rows.join(ids, "image_id", "left").select(
        "path", "relative_path", "length", "split", "image_id", issue.alias("issue"), F.coalesce(F.col("relative_path") == F.col("least"), F.lit(False)).alias("first")
    )


def _members(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for split, content in zip(*(part.column(c).to_pylist() for c in ("split", "content")), strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                names = [n for n in archive.namelist() if n.endswith(".txt")]
                rows = [[split] * len(names), [n[:-4] for n in names], [archive.read(n) for n in names]]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.binary())], names=["split", "image_id", "content"])


def read_label_files(spark: SparkSession, path: str, archives: bool = False) -> DataFrame:
    """Lines of ``<path>/<split>/<image>.txt`` with their place in the file; an image without a line has one row with a null line.

    With ``archives`` the files are those in ``<path>/<split>/*.zip``.
    """
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip" if archives else "*.txt").option("recursiveFileLookup", "true").load(path)
    split = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("split")
    if archives:
        rows = rows.select(split, "content").mapInArrow(_members, "split string, image_id string, content binary")
    else:
        rows = rows.select(split, F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1).alias("image_id"), "content")
    lines = F.filter(F.transform(F.split(F.decode("content", "utf-8"), r"\r\n|\r|\n"), lambda x, k: F.struct((k + 1).alias("line_no"), F.trim(x).alias("label_line"))), lambda x: x.label_line != "")
    rows = rows.select("split", "image_id", F.explode_outer(lines).alias("x"))
    return rows.select("split", "image_id", F.col("x.line_no").alias("line_no"), F.col("x.label_line").alias("label_line"))
