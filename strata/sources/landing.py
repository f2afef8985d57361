"""Landing copy of files, with a dead-letter output per file and per record.

``copy_files`` lists the datasets' files as rows and copies each of them in a guarded step of its own:
whatever goes wrong with a file (it cannot be opened, is cut short, fails its format's check)
becomes one dead-letter row ``(dataset, file_path, error)`` and the other files arrive.  A dataset whose folder
cannot be listed gives one row with ``file_path = 'ALL_FILES'``.  Bytes stream through the task in
blocks, so memory does not grow with a file, and a copy takes its name only once it is whole.

``land`` reads records in PERMISSIVE mode: parseable rows on one side, the rest as
dead-letter rows with their text.  ``land_dataset`` does both, so that the record reader sees only
files that were checked.  Nothing is collected.
"""

from __future__ import annotations

import hashlib
import re
import time
import uuid
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# Dead-letter marker for a failed listing.
ALL_FILES = "ALL_FILES"
DEAD_LETTER_SCHEMA = (
    "dataset string, file_path string, error string, record string, partial string")
LISTING_SCHEMA = "dataset string, root string, path string, bytes long, error string"
OUTCOME_SCHEMA = "dataset string, file_path string, target string, bytes long, sha256 string, error string"
BLOCK_BYTES = 4 << 20


@dataclass
class Landed:
    good: DataFrame
    dead_letter: DataFrame


def _listing_error(e: Exception) -> str | None:
    """The error text if ``e`` says that a folder cannot be listed, None for any other mistake."""
    if isinstance(e, AnalysisException):
        return str(e) if e.getCondition() == "PATH_NOT_FOUND" else None
    seen = e.java_exception
    while seen is not None:
        if seen.getClass().getName().startswith(("java.io.", "org.apache.hadoop.")):
            return str(seen.toString())
        seen = seen.getCause()
    return None


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSelector, FileSystem, FileType

    def rows(dataset: str, root: str, found: list) -> pa.RecordBatch:
        n = len(found)
        cols = [[dataset] * n, [root] * n, [p for p, _, _ in found], [b for _, b, _ in found], [e for _, _, e in found]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if i == 3 else pa.string()) for i, c in enumerate(cols)],
                                          names=["dataset", "root", "path", "bytes", "error"])

    for b in batches:
        for r in b.to_pylist():
            try:
                fs, top = FileSystem.from_uri(_uri(r["root"]))
                folders = [top]
                while folders:  # one folder's names at a time
                    found = fs.get_file_info(FileSelector(folders.pop()))
                    shown = [f for f in found if not f.base_name.startswith((".", "_"))]
                    folders += [f.path for f in shown if f.type == FileType.Directory]
                    yield rows(r["dataset"], r["root"], [(f"{r['root'].rstrip('/')}/{f.path[len(top):].lstrip('/')}", f.size, None)
                                                         for f in shown if f.type == FileType.File])
            except (OSError, pa.ArrowException) as e:
                yield rows(r["dataset"], r["root"], [(None, None, f"{type(e).__name__}: {e}")])


def list_files(spark: SparkSession, datasets: Mapping[str, str]) -> DataFrame:
    """``(dataset, root, path, bytes, error)``: a row per file of each dataset's folder, subfolders and empty files
    included, names with a leading ``.`` or ``_`` left out as Spark's readers do.

    Each dataset is listed by a task of its own; no file is opened. A folder that cannot be listed gives one row with the
    error and no path.
    """
    tops = spark.createDataFrame(list(datasets.items()), "dataset string, root string").repartition(max(1, len(datasets)), "dataset")
    return tops.mapInArrow(_list, LISTING_SCHEMA)


def _uri(path: str) -> str:
    """A URI with an authority: Spark writes ``file:/a`` where Arrow asks for ``file:///a``."""
    if path.startswith("/"):
        return f"file://{path}"
    return re.sub(r"^([a-z0-9]+):/(?!/)", r"\1:///", path)


def relative(path: str, root: str) -> str:
    """``path`` below ``root``."""
    return path[len(root.rstrip("/")) + 1:]


class _Gunzip:
    """Follows a gzip stream; ``close`` raises if it does not end where a member ends."""

    def __init__(self):
        self.member = zlib.decompressobj(31)
        self.begun = False

    def feed(self, block: bytes) -> None:
        while block:
            self.begun = True
            self.member.decompress(block, BLOCK_BYTES)  # a bounded piece, and not kept
            if self.member.eof:
                block, self.member, self.begun = self.member.unused_data, zlib.decompressobj(31), False
            else:
                block = self.member.unconsumed_tail

    def close(self) -> None:
        while self.begun and not self.member.eof:
            if not self.member.decompress(b"", BLOCK_BYTES) and not self.member.eof:
                raise EOFError("compressed file ends within a member")


def _check_parquet(fs, path: str) -> None:
    """Decode every value of a Parquet file, a batch at a time."""
    import pyarrow.parquet as pq

    with fs.open_input_file(path) as f:
        for _ in pq.ParquetFile(f).iter_batches(batch_size=8192):
            pass


def _copy(source: str, size: int, target: str, staging: str, check: bool) -> tuple[int, str]:
    """Copy one file in blocks; (bytes, SHA-256).  It appears under ``target`` whole or not at all."""
    from pyarrow.fs import FileSystem

    src, src_path = FileSystem.from_uri(_uri(source))
    dst, dst_path = FileSystem.from_uri(_uri(target))
    _, tmp_path = FileSystem.from_uri(_uri(f"{staging}/{uuid.uuid4().hex}"))
    digest, n = hashlib.sha256(), 0
    gunzip = _Gunzip() if check and source.endswith(".gz") else None
    dst.create_dir(tmp_path.rsplit("/", 1)[0], recursive=True)
    dst.create_dir(dst_path.rsplit("/", 1)[0], recursive=True)
    try:
        with src.open_input_stream(src_path, compression=None) as i, dst.open_output_stream(tmp_path, compression=None) as o:
            while block := i.read(BLOCK_BYTES):
                digest.update(block)
                n += len(block)
                if gunzip:
                    gunzip.feed(block)
                o.write(block)
        if n != size:
            raise EOFError(f"read {n} bytes of {size}")
        if gunzip:
            gunzip.close()
        if check and source.endswith(".parquet"):
            _check_parquet(dst, tmp_path)
        dst.move(tmp_path, dst_path)
    except BaseException:
        if dst.get_file_info(tmp_path).is_file:
            dst.delete_file(tmp_path)
        raise
    return n, digest.hexdigest()


def _copier(target_root: str, check: bool, attempts: int, wait: float):
    names = [f.split()[0] for f in OUTCOME_SCHEMA.split(", ")]
    types = [pa.int64() if " long" in f else pa.string() for f in OUTCOME_SCHEMA.split(", ")]

    def one(dataset: str, root: str, path: str, size: int) -> tuple:
        name = relative(path, root)
        target = f"{target_root}/{dataset}/{name}"
        for k in range(attempts):
            try:
                return (dataset, name, target, *_copy(path, size, target, f"{target_root}/_staging", check), None)
            except Exception as e:  # noqa: BLE001  -- the guard: a file's failure is its row, not the job's
                error = f"{type(e).__name__}: {e}"
                if not isinstance(e, OSError) or isinstance(e, (FileNotFoundError, PermissionError)):
                    break  # another try cannot help
                if k + 1 < attempts:
                    time.sleep(wait * 2 ** k)
        return dataset, name, None, None, None, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                row = (r["dataset"], ALL_FILES, None, None, None, r["error"]) if r["path"] is None else one(
                    r["dataset"], r["root"], r["path"], r["bytes"])
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)
    return run


def copy_files(spark: SparkSession, datasets: Mapping[str, str], target: str, log_path: str, check: bool = True,
               attempts: int = 3, wait: float = 0.5) -> Landed:
    """Copy every file of each dataset's folder to ``<target>/<dataset>/``.

    ``datasets`` maps a name to its folder.  ``good`` holds ``(dataset, file_path, target, bytes, sha256)`` of what
    arrived, ``dead_letter`` ``(dataset, file_path, error)`` of the rest; both read the log that the one run of the
    copy wrote to ``log_path``.  Input and output errors are tried ``attempts`` times, ``wait`` seconds and then twice as long
    apart.  ``check`` also decodes files named ``.gz`` and ``.parquet`` and fails those that are damaged.  An
    executor that is lost leaves at most a file under ``_staging``, which readers skip; its files are copied again.
    """
    files = list_files(spark, datasets)
    width = spark.sparkContext.defaultParallelism * 4
    done = files.repartition(width, "path").mapInArrow(_copier(target.rstrip("/"), check, attempts, wait), OUTCOME_SCHEMA)
    done.write.mode("overwrite").parquet(log_path)
    log = spark.read.schema(OUTCOME_SCHEMA).parquet(log_path)
    return Landed(log.filter("error is null").drop("error"), log.filter("error is not null").select("dataset", "file_path", "error"))


def land(spark: SparkSession, dataset: str, path: str, schema: T.StructType,
         fmt: str = "json") -> Landed:
    """Read ``path`` with ``schema``; split parseable rows from bad records.

    A folder that cannot be listed is one dead-letter row; any other error (a wrong format name) is raised.
    """
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    try:
        raw = (spark.read.format(fmt).schema(full).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT).load(path)
               .withColumn("_file", F.col("_metadata.file_path")))
        raw.schema  # noqa: B018  -- resolves the listing now
    except (AnalysisException, Py4JJavaError) as e:
        error = _listing_error(e)
        if error is None:
            raise
        dead = spark.createDataFrame([(dataset, ALL_FILES, error, None, None)],
                                     DEAD_LETTER_SCHEMA)
        return Landed(spark.createDataFrame([], schema), dead)

    # ``partial`` keeps the parsed fields: a scan may not read the corrupt
    # column alone
    every = F.concat_ws("", *[F.coalesce(F.col(f.name).cast("string"), F.lit(""))
                              for f in schema.fields])
    # an always-true test over every field keeps count() from pruning the
    # scan down to the corrupt column alone (which Spark refuses)
    good = raw.filter(F.col(CORRUPT).isNull() & (F.length(every) >= 0)).select(
        *[f.name for f in schema.fields])
    bad = F.col(CORRUPT).isNotNull() & (F.length(every) >= 0)
    dead = raw.filter(bad).select(
        F.lit(dataset).alias("dataset"), F.col("_file").alias("file_path"),
        F.lit("malformed record").alias("error"), F.col(CORRUPT).alias("record"),
        F.to_json(F.struct(*[F.col(f.name) for f in schema.fields])).alias("partial"))
    return Landed(good, dead)


def land_dataset(spark: SparkSession, dataset: str, path: str, schema: T.StructType, target: str, log_path: str,
                 fmt: str = "json", attempts: int = 3) -> Landed:
    """Copy the dataset's files, then read the records of those that arrived.

    Dead letters are the files that failed (no record) and the records that do not parse.
    """
    copied = copy_files(spark, {dataset: path}, target, log_path, attempts=attempts)
    failed = copied.dead_letter.withColumns({"record": F.lit(None).cast("string"), "partial": F.lit(None).cast("string")})
    if copied.good.isEmpty():
        return Landed(spark.createDataFrame([], schema), failed)
    records = land(spark, dataset, f"{target.rstrip('/')}/{dataset}", schema, fmt)
    return Landed(records.good, failed.unionByName(records.dead_letter))


def write_landed(landed: Landed, bronze_path: str, dead_letter_path: str) -> None:
    landed.good.write.mode("append").parquet(bronze_path)
    landed.dead_letter.write.mode("append").parquet(dead_letter_path)
