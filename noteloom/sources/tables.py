"""Reading the star schema and running query files."""

from collections.abc import Mapping
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.schemas import REJECTS, STAR_TABLES

# Table -> column of the star schema -> what the warehouse calls it, where that differs.
WAREHOUSE_COLUMNS = {"dim_patient_episode_type": {"Unified_ShortName": "Unified ShortName"}}
Columns = Mapping[str, Mapping[str, str]]


def as_star_table(df: DataFrame, name: str, columns: Columns | None = None) -> DataFrame:
    """``df`` with the columns and types of a star-schema table.

    ``columns`` maps, per table, a star-schema column to its name in ``df``. Without it the
    warehouse's own names are looked for where the star schema's are missing.
    """
    given = _sources(df, name, columns)
    return df.select(
        *[F.col(f"`{given[f.name]}`").cast(f.dataType).alias(f.name) for f in STAR_TABLES[name]]
    )


def _sources(df: DataFrame, name: str, columns: Columns | None) -> dict[str, str]:
    """The column of ``df`` for each column of a star-schema table."""
    given = (columns or {}).get(name, {})
    usual = WAREHOUSE_COLUMNS.get(name, {})
    present = {c.lower() for c in df.columns}
    return {
        column: given.get(column, column if column.lower() in present else usual.get(column, column))
        for column in STAR_TABLES[name].fieldNames()
    }


def split_rejects(
    df: DataFrame, name: str, columns: Columns | None = None, key: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """As ``as_star_table``, without the rows that hold a value of another type; and these values.

    A row is left out as a whole, with one reject for each value that does not cast: the table, the
    row's key as text (``key`` names a column of ``df``; by default the table's first), the column and
    the value as text. Null is a value of any type. Neither a failed cast nor a silent null is left.
    """
    given = _sources(df, name, columns)
    key = key or next(iter(given.values()))
    cast = {f.name: F.col(f"`{given[f.name]}`").try_cast(f.dataType) for f in STAR_TABLES[name]}
    found = F.array(
        *[
            F.when(
                F.col(f"`{given[column]}`").isNotNull() & value.isNull(),
                F.struct(F.lit(column).alias("column"), F.col(f"`{given[column]}`").cast("string").alias("value")),
            )
            for column, value in cast.items()
        ]
    )
    wrong = F.array_compact(found)
    good = df.where(F.size(wrong) == 0).select(*[value.alias(column) for column, value in cast.items()])
    rejects = df.where(F.size(wrong) > 0).select(
        F.lit(name).alias("source"), F.col(f"`{key}`").cast("string").alias("row_key"), F.inline(wrong)
    )
    return good, rejects.select(*[F.col(f.name).cast(f.dataType) for f in REJECTS])


def star_and_rejects(
    star: Mapping[str, DataFrame], columns: Columns | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """The good rows of all tables, and the rejects of all of them."""
    parts = {name: split_rejects(df, name, columns) for name, df in star.items()}
    rejects = reduce(DataFrame.unionByName, [found for _, found in parts.values()])
    return {name: good for name, (good, _) in parts.items()}, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Per table and column: values that do not cast."""
    return rejects.groupBy("source", "column").agg(F.count(F.lit(1)).alias("rejected"))


def star_from_parquet(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """One parquet table per star-schema name under ``folder``."""
    return {
        name: spark.read.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parquet")
        for name, schema in STAR_TABLES.items()
    }


def star_from_catalog(
    spark: SparkSession,
    database: str,
    names: Mapping[str, str] | None = None,
    columns: Columns | None = None,
    typed: bool = True,
) -> dict[str, DataFrame]:
    """Catalog tables in the star schema's columns and types; as they are if not ``typed``.

    ``names`` maps a star-schema name to a differently named table, ``columns`` columns of
    it. A timestamp with time zone becomes the local time of the session's zone.
    """
    names = names or {}
    found = {name: spark.table(f"{database}.{names.get(name, name)}") for name in STAR_TABLES}
    return {name: as_star_table(df, name, columns) if typed else df for name, df in found.items()}


def star_from_jdbc(
    spark: SparkSession,
    connection: Mapping[str, str],
    tables: Mapping[str, str],
    split: Mapping[str, Mapping[str, str]] | None = None,
    columns: Columns | None = None,
    typed: bool = True,
) -> dict[str, DataFrame]:
    """Tables of a database in the star schema's columns and types; as they are if not ``typed``. ``connection`` holds the reader's options (url, user, ...).

    ``tables`` gives the database name of each table. ``split`` gives, per table, the
    options partitionColumn, lowerBound, upperBound and numPartitions, without which a
    table is read by one task. Filters and column lists reach the database as SQL.
    """
    split = split or {}
    found = {
        name: spark.read.format("jdbc")
        .option("preferTimestampNTZ", "true")  # the database's local times, as they stand
        .options(**connection, dbtable=tables[name], **split.get(name, {}))
        .load()
        for name in tables
    }
    return {name: as_star_table(df, name, columns) if typed else df for name, df in found.items()}


def read_query(path: str) -> str:
    """Text of a query file, UTF-8, without surrounding white space."""
    file = Path(path)
    if not file.is_file():
        raise FileNotFoundError(f"query file not found: {path}")
    return file.read_text(encoding="utf-8").strip()


def run_query_file(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
) -> DataFrame:
    """Run a Spark SQL file. ``{name}`` in the text refers to a DataFrame of ``tables``,
    ``:name`` to a value of ``args`` (such as the as-of date)."""
    return spark.sql(read_query(path), args=dict(args or {}), **dict(tables or {}))
