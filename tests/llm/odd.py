"""Tables with every odd case that the operators promise to handle."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, bucket int, kept string"
LONG = " ".join(f"word{i % 977} {i}" for i in range(30_000))
TEXTS = {
    1: "The quick brown fox jumps over the lazy dog near the river bank today.",
    2: "",
    3: None,
    4: "   \n\t ",
    5: "The quick brown fox jumps over the lazy dog near the river bank today.",
    6: "é 漢字 \U0001f600 ñandú. Call +1 (415) 555-0199 or mail a.b@c.example.org, 10.0.0.255!",
    7: "x",
    8: LONG,
    9: "a  b   c \n\n d " * 30,
}


def odd_documents(spark: SparkSession) -> DataFrame:
    rows = [(i, t, "en", "src0", None if t is None else len(t), 0.5, "f", 1, "no") for i, t in TEXTS.items()]
    rows += [rows[0], (None, TEXTS[1], None, None, None, None, None, None, None), (None, None, None, None, 0, 1.0, "", 2, "")]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def saved(df: DataFrame, folder, name: str = "documents") -> str:
    df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def whole(folder: str, columns: str = "doc_id, text", name: str = "documents") -> list[tuple]:
    import duckdb

    return duckdb.connect().execute(f"SELECT {columns} FROM '{folder}/{name}.parquet' ORDER BY 1").fetchall()
