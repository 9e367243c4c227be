"""What several operators of this subpackage share."""

import os
import sys
import types
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom import session
from noteloom.session import fresh_path, stored, work_folder

__all__ = ["fresh_path", "stored", "work_folder"]

BATCH_ROWS = 2000  # texts that a Python worker is handed at a time


def configure(spark: SparkSession) -> SparkSession:
    """The library's settings, and batches of whole texts that leave room in a worker's memory."""
    session.configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """A text column as bytes; null is the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit("")).cast("binary")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; a null id counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case of its names."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def in_slices(df: DataFrame) -> int:
    """A number of shuffle partitions that follows the session's setting, not the machine."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4)


def worker_state(name: str, make):
    """A value kept in this Python worker from one task to the next."""
    home = sys.modules.setdefault("_noteloom_worker_state", types.ModuleType("_noteloom_worker_state"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the path in it, for use inside tasks."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(folder: str, name: str, parts: Iterable[bytes]) -> str:
    """Write one file under a name of its own, so that a second attempt of a task does no harm.

    Readers go by the list of names that the successful attempts return.
    """
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    stem, dot, ending = name.partition(".")
    target = f"{path}/{stem}-{uuid.uuid4().hex}{dot}{ending}"
    with system.open_output_stream(target, compression=None) as out:
        for part in parts:
            out.write(part)
    return f"{folder}/{os.path.basename(target)}"


def read_file(uri: str, start: int = 0, length: int | None = None) -> bytes:
    system, path = filesystem(uri)
    with system.open_input_file(path) as file:
        file.seek(start)
        return file.read() if length is None else file.read(length)


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The named columns row by row, a small slice of a batch at a time."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(name)) for name in names]
        for first in range(0, batch.num_rows, 256):
            yield from zip(*(column.slice(first, 256).to_pylist() for column in columns), strict=True)


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000, cells: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, bounded by rows and by the characters of their texts."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (str, bytes, list)))
        if len(held) >= size or weight >= cells:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
