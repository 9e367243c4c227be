"""Writing results.

What replaces rows is written beside them first and takes their place by renaming, so that a write
that fails leaves the old ones. Renaming a folder has to be one step for that, as it is on HDFS
and mounted file systems. One writer at a time replaces in a folder.
"""

import datetime as dt
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noteloom.sources.files import Folder


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts rows during the write itself, not in a second job."""
    rows = Observation()
    return df.observe(rows, F.count(F.lit(1)).alias("rows")), rows


def _writer(
    df: DataFrame, partition_by: Sequence[str], overwrite_partitions: bool
) -> DataFrameWriter:
    writer = df.write.mode("overwrite" if overwrite_partitions else "append")
    if overwrite_partitions:
        if not partition_by:
            raise ValueError("overwrite_partitions needs partition_by")
        writer = writer.option("partitionOverwriteMode", "dynamic")
    return writer.partitionBy(*partition_by) if partition_by else writer


def append_to_path(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    partition_by: Sequence[str] = (),
    overwrite_partitions: bool = False,
) -> int:
    """Append rows to a folder and return how many were written.

    Running twice appends twice. With ``overwrite_partitions`` a rerun replaces exactly
    the partitions it writes, so repeating a day leaves one copy of it; a partition without
    rows is not written and so keeps its old ones (``replace_in_path`` clears it).
    """
    df, rows = _counted(df)
    _writer(df, partition_by, overwrite_partitions).format(file_format).save(path)
    return rows.get["rows"]


def _named(partition: Mapping[str, object]) -> tuple[str, str]:
    if len(partition) != 1:
        raise ValueError("name one partition column and its value")
    ((column, value),) = partition.items()
    return column, str(value)


def replace_in_path(df: DataFrame, path: str, partition: Mapping[str, object]) -> int:
    """Make ``df`` the whole content of one partition of a parquet folder; returns its rows.

    The partition is named, so it is cleared even if ``df`` has no rows. All rows must belong
    to it; its column may be in ``df`` or not. Other partitions stay as they are, and if the write
    fails so does this one.
    """
    column, value = _named(partition)
    folder = Folder(df.sparkSession, path)
    return _replace(_of_partition(df, column, value), folder, f"{column}={quote(value, safe=' ')}", "parquet")


def _replace(df: DataFrame, folder: Folder, target: str, file_format: str) -> int:
    finish_replacing(folder)
    new = not folder.exists()
    df, rows = _counted(df)
    staged = f"_staged-{uuid.uuid4().hex}"
    try:
        df.write.format(file_format).save(f"{folder.uri}/{staged}")
        written = rows.get["rows"]
        kept = df.sparkSession.read.schema(df.schema).format(file_format).load(f"{folder.uri}/{staged}").count()
        if kept != written:
            raise OSError(f"{written} rows were written and {kept} are there")
    except BaseException:
        folder.delete("" if new else staged)
        raise
    plan = {"staged": staged, "target": target, "away": f"_away-{uuid.uuid4().hex}"}
    name = f"_replacing-{uuid.uuid4().hex}"
    folder.write(name, json.dumps(plan))
    _put_in_place(folder, name)
    return written


def _put_in_place(folder: Folder, name: str) -> None:
    """What a plan says, from wherever an earlier attempt left off."""
    plan = json.loads(folder.read(name))
    if folder.exists(plan["staged"]):
        if folder.exists(plan["target"]):
            folder.rename(plan["target"], plan["away"])
        folder.rename(plan["staged"], plan["target"])
    folder.delete(plan["away"])
    folder.delete(name)


def finish_replacing(folder: Folder) -> None:
    """Carry out replacements whose rows were complete when their driver was lost."""
    for name in folder.names():
        if name.startswith("_replacing-"):
            _put_in_place(folder, name)


def results_in(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a folder that is written here, after finishing what was interrupted."""
    finish_replacing(Folder(spark, path))
    return spark.read.schema(schema).parquet(path)


def append_once(
    df: DataFrame, path: str, run: str, file_format: str = "parquet", partition_by: Sequence[str] = ()
) -> int:
    """Append the rows of a run and return their number; 0 if that run's rows are there already.

    Rows are written beside the others and become visible by renaming their files, which carry the
    run's name; then the run is noted down. Repeating a run after a lost driver goes on from where
    it stopped: complete rows are not written again, and no file is there twice. Another run appends.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", run):
        raise ValueError("a run's name has letters, digits, '.', '_' and '-'")
    folder = Folder(df.sparkSession, path)
    staged, noted = f"_staged-{run}", f"_runs/{run}"
    if folder.exists(noted):
        folder.delete(staged)
        return 0
    if not folder.exists(f"{staged}/_rows"):
        folder.delete(staged)
        df, rows = _counted(df)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.format(file_format).save(f"{folder.uri}/{staged}")
        folder.write(f"{staged}/_rows", str(rows.get["rows"]))
    written = int(folder.read(f"{staged}/_rows"))
    for file in folder.files(staged):
        place, _, name = file.rpartition("/")
        if place:
            folder.make(place)
        folder.rename(f"{staged}/{file}", f"{place}/{run}-{name}".lstrip("/"))
    folder.make("_runs")
    folder.write(noted, json.dumps({"rows": written}))
    folder.delete(staged)
    return written


def append_once_to_table(df: DataFrame, table: str, run: str) -> int:
    """As ``append_once`` for a catalog table of files, which has to be there."""
    spark = df.sparkSession
    facts = _facts(spark, table)
    partitioned = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    written = append_once(_typed(df, table), facts["Location"], run, facts["Provider"].lower(), partitioned)
    if partitioned:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return written


def _facts(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE FORMATTED {table} {partition}").collect()
    # What is said of a partition stands before the same of its table.
    return {r["col_name"].rstrip(":"): r["data_type"] for r in reversed(rows)}


def _typed(df: DataFrame, table: str, but: str | None = None) -> DataFrame:
    """The columns of a table, in its order and types."""
    fields = [f for f in df.sparkSession.table(table).schema if f.name != but]
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])


def _of_partition(df: DataFrame, column: str, value: str) -> DataFrame:
    if column not in df.columns:
        return df
    same = F.col(column).cast("string").eqNullSafe(F.lit(value))
    wrong = F.raise_error(F.concat(F.lit(f"row outside {column}={value}: "), F.col(column).cast("string")))
    return df.filter(F.when(same, F.lit(True)).otherwise(wrong.cast("boolean"))).drop(column)


def replace_in_table(df: DataFrame, table: str, partition: Mapping[str, object]) -> int:
    """As ``replace_in_path`` for a catalog table, which is created if there is none.

    Tables whose format keeps a log of its own are left to that log.
    """
    column, value = _named(partition)
    spark = df.sparkSession
    df = _of_partition(df, column, value)
    if not spark.catalog.tableExists(table):
        kind = "date" if _is_date(value) else "string"
        empty = df.limit(0).withColumn(column, F.lit(value).cast(kind))
        empty.write.partitionBy(column).saveAsTable(table)
    of_value = f"PARTITION (`{column}` = '{value}')"
    facts = _facts(spark, table)
    if facts.get("Provider", "").lower() not in FILE_FORMATS:
        return _insert_overwrite(_typed(df, table, column), table, of_value)
    try:
        place = _facts(spark, table, of_value)["Location"]
    except AnalysisException:  # no such partition yet
        place = f"{facts['Location']}/{column}={quote(value, safe=' ')}"
    root, _, target = place.rstrip("/").rpartition("/")
    written = _replace(_typed(df, table, column), Folder(spark, root), target, facts["Provider"].lower())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {of_value}")
    spark.catalog.refreshTable(table)
    return written


FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def _insert_overwrite(df: DataFrame, table: str, of_value: str) -> int:
    df, rows = _counted(df)
    view = f"replacing_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} {of_value} SELECT * FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)
    return rows.get["rows"]


def _is_date(value: str) -> bool:
    try:
        return bool(dt.date.fromisoformat(value))
    except ValueError:
        return False


def append_to_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    overwrite_partitions: bool = False,
) -> int:
    """Append rows to a catalog table (schema-qualified name) and return their count."""
    df, rows = _counted(df)
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        # Columns go by position in an insert: put them in the table's order.
        df = df.select(*spark.table(table).columns)
        spark_mode = "dynamic" if overwrite_partitions else "static"
        df.write.option("partitionOverwriteMode", spark_mode).insertInto(
            table, overwrite=overwrite_partitions
        )
    else:
        _writer(df, partition_by, False).saveAsTable(table)
    return rows.get["rows"]


def append_to_jdbc(df: DataFrame, connection: Mapping[str, str], table: str) -> int:
    """Append rows to a database table; a failed write raises."""
    df, rows = _counted(df)
    df.write.format("jdbc").options(**connection, dbtable=table).mode("append").save()
    return rows.get["rows"]


def record_json(columns: Sequence[str | Column], pretty: bool = False) -> Column:
    """One record as JSON text: nulls kept, non-ASCII characters as they are."""
    options = {"ignoreNullFields": "false", "pretty": str(pretty).lower()}
    return F.to_json(F.struct(*columns), options)


def write_json(df: DataFrame, path: str, pretty: bool = False) -> None:
    """Records as JSON, one per line, or indented with one record after the other."""
    df.select(record_json(df.columns, pretty).alias("value")).write.text(path)
