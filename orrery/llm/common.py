"""What several operators of this subpackage share: tables, scratch tables, folds."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20
ARROW_BYTES = 8 << 20
#: Bytes of a row group of scratch tables with arrays.
WIDE_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers once, so that they need not have it installed.

    Also sets the session's bytes of an Arrow batch, unless the caller has: long texts would make large ones in both processes.
    """
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if getattr(sc, "_orrery_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="orrery-"), f"{package.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._orrery_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session without that setting, as in tests, gets a folder of its own; on a cluster its absence is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="orrery-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/orrery/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str, wide: bool = False, by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors.

    ``wide`` rows, with arrays of hashes, get small row groups and no dictionaries, which hashes don't gain from.
    ``by`` is a column with few values, each of which gets a folder.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if wide:
        writer = writer.option("parquet.block.size", WIDE_BYTES).option("parquet.enable.dictionary", False)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {m.group() for f in df.inputFiles() if (m := re.match(r".*/orrery/[^/]+", f))}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def session_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Sets a session's setting for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def collected(df: DataFrame) -> dict:
    """The columns of a small ``df`` as numpy arrays, by Arrow, without a Python object for each row."""
    rows = df.toArrow()
    return {c: rows[c].to_numpy() for c in rows.column_names}


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, mod 5; 0 is held out. A null id has a null fold."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(5))


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold up to ``limit`` bytes each, or one row."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield at, end
        at = end


def flat_bytes(column: pa.Array) -> tuple:
    """UTF-8 bytes of a string column as one uint8 array, and the row offsets; nulls are empty."""
    import numpy as np
    import pyarrow.compute as pc

    col = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_texts(docs: DataFrame, text_col: str, make, fields: str, keep: list[str] | None = None, also: list[str] | None = None) -> DataFrame:
    """Adds columns that a numpy function computes from a text column, in Arrow batches.

    ``make()`` is called once a task and returns a function from one Arrow string column (up to
    ``SLICE_BYTES`` or one longer text) to the arrays of ``fields`` (a DDL string). ``keep`` names the
    columns of ``docs`` to pass through, all by default; one named like a new field is replaced. The function
    gets the columns ``also`` as further arrays.
    """
    from pyspark.sql.types import StructType

    ship(docs.sparkSession)
    new = StructType.fromDDL(fields)
    names = {n.lower() for n in new.names}
    kept = [n for n in (docs.columns if keep is None else keep) if n.lower() not in names]
    schema = StructType([docs.schema[n] for n in kept] + list(new))
    also = also or []
    read = docs.select(*[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate([*kept, text_col, *also])])  # by place, whatever their names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            at = len(kept)
            for a, b in text_slices(batch.column(at)):
                part = batch.slice(a, b - a)
                arrays = compute(*part.columns[at:])
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *arrays], names=[*kept, *new.names])

    return read.mapInArrow(run, schema)
