"""Approximate nearest neighbours with an inverted multi-index.

The two halves of a vector are quantised separately; a cell is a pair of centroids, one of each
half. A query visits cells in order of the summed squared distance of its halves to the pair's
centroids, taken from a heap, until the cells hold a given share of the index. The entries of
those cells are reranked by exact distance. The share is set on the training sample so that
``TARGET`` of true neighbours lie in visited cells.

Only the centroids and the share come from the bounded sample (``SAMPLE`` vectors); every vector
is indexed. Equal vectors are one entry with their smallest ids, as many as can be asked for, so
a vector that many rows share is compared once for each query; queries with equal vectors are
searched once.

Edge cases: vectors that are null, empty, zero, hold null or non-finite components, or have
another length than most take no part, neither as query nor as candidate; rows without id
neither. Rows that repeat an id and a vector count once. With fewer candidates than asked for,
all are returned. Ties go to the smaller id. An empty table gives no rows. Other columns are not
read.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, in_slices, rows_of, stored, table

CENTROIDS = 64  # of each half
SAMPLE = 20_000  # vectors that the centroids are fitted on, by smallest hash
PROBES = 400  # sample vectors that the share is set on
TARGET = 0.96  # share of true neighbours of the probes that must lie in visited cells
BLOCK = 8192  # vectors of an index block, on average
QUERY_BLOCK = 256


# --- quantisation ---------------------------------------------------------------------


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ centroids.T + (centroids * centroids).sum(1)[None]


def _centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Lloyd's algorithm from distinct random points; an empty cluster keeps its centroid."""
    points = np.unique(x, axis=0)
    picked = np.random.default_rng(seed).permutation(len(points))[:k]
    centroids = points[np.sort(picked)].copy()
    for _ in range(rounds):
        nearest = _distances(x, centroids).argmin(1)
        sizes = np.bincount(nearest, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        full = sizes > 0
        centroids[full] = sums[full] / sizes[full, None]
    return centroids


class Quantiser:
    def __init__(self, sample: np.ndarray, k: int = CENTROIDS):
        self.half = sample.shape[1] // 2
        self.first = _centroids(sample[:, : self.half], k)
        self.second = _centroids(sample[:, self.half :], k)
        self.width = len(self.second)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _distances(x[:, : self.half], self.first), _distances(x[:, self.half :], self.second)

    def cells(self, x: np.ndarray) -> np.ndarray:
        first, second = self.halves(x)
        return first.argmin(1) * self.width + second.argmin(1)


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int):
    """Non-empty cells by summed distance until they hold ``wanted`` entries (or all are seen).

    ``first`` and ``second`` are one query's distances to the centroids of each half; a pair is
    pushed once the pair before it in its row, and for the first of a row the row before, is taken.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows], second[columns]
    heap = [(a[0] + b[0], 0, 0)]
    held = 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(rows[i]) * len(columns) + int(columns[j])
        if sizes[cell]:
            held += int(sizes[cell])
            yield cell
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


def share_for(quantiser: Quantiser, sample: np.ndarray, k: int, target: float, probes: int = PROBES) -> float:
    """Share of the index that must be visited so that ``target`` of true neighbours are met."""
    n = len(sample)
    if n < 2:
        return 1.0
    cells = quantiser.cells(sample)
    sizes = np.bincount(cells, minlength=len(quantiser.first) * quantiser.width)
    first, second = quantiser.halves(sample[:probes])
    needed = []
    for i in range(len(first)):
        gaps = ((sample - sample[i]) ** 2).sum(1)
        gaps[i] = np.inf
        near = np.argsort(gaps, kind="stable")[: min(k, n - 1)]
        sums = (first[i][:, None] + second[i][None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        before = np.empty(len(order))
        before[order] = np.cumsum(sizes[order]) - sizes[order]
        needed.extend((before[cells[near]] + 1) / n)
    return float(min(1.0, np.quantile(needed, target)))


# --- Spark jobs -----------------------------------------------------------------------


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector (array of double) of the rows that take part."""
    named = df.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).where("id is not null and vector is not null and size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = named.where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    # One row per length that occurs, the most frequent first.
    usual = named.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return named.where(F.size("vector") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def search(
    vectors: DataFrame,
    query_ids,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 10,
    target: float = TARGET,
    centroids: int = CENTROIDS,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found of each query.

    ``query_ids`` is a condition on the column ``id``: which rows are queries.
    """
    taking_part = usable(vectors, id_column, vector_column)
    # Every task sends at most k + 1 ids of a vector on.
    by_vector = W.partitionBy("vector").orderBy("id")
    few = taking_part.distinct().withColumn("nth", F.row_number().over(by_vector)).where(F.col("nth") <= k + 1)
    entries = stored(
        few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("rep", F.col("ids")[0]),
        "vectors",
    )
    sampled = entries.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).toPandas()
    if sampled.empty:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array(sampled["vector"].tolist())
    quantiser = Quantiser(sample, centroids)
    share = share_for(quantiser, sample, k, target)

    entry = pa.schema(
        [
            ("row", pa.int32()),
            ("column", pa.int32()),
            ("rep", pa.int64()),
            ("ids", pa.list_(pa.int64())),
            ("vector", pa.binary()),
        ]
    )

    def placed(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(2))
                cells = quantiser.cells(x).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(cells // quantiser.width),
                        pa.array(cells % quantiser.width),
                        *batch.columns[:2],
                        pa.array([v.tobytes() for v in x], type=pa.binary()),
                    ],
                    schema=entry,
                )

    index = stored(
        entries.select("rep", "ids", "vector").mapInArrow(
            placed, "row int, column int, rep long, ids array<long>, vector binary"
        ),
        "multi-index",
    )
    # One row per cell in use, at most centroids ** 2.
    counted = index.groupBy("row", "column").agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = np.zeros((len(quantiser.first), quantiser.width), dtype=np.int64)
    for found in counted:
        sizes[found["row"], found["column"]] = found["n"]
    wanted = max(int(np.ceil(share * sizes.sum())), k + 1)

    queries = taking_part.where(query_ids).distinct()
    asked = stored(
        queries.join(entries.select("vector", "rep"), "vector").select(F.col("id").alias("query_id"), "rep", "vector"),
        "queries",
    )
    distinct = asked.select("rep", "vector").dropDuplicates(["rep"])
    visit = pa.schema(
        [("row", pa.int32()), ("rep", pa.int64()), ("vector", pa.binary()), ("columns", pa.binary())]
    )

    def visits(batches):
        """For each query and row of the index, the columns of the cells that it visits."""

        def rows():
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(1))
                first, second = quantiser.halves(x)
                for i, rep in enumerate(batch.column(0).to_pylist()):
                    cells = np.array(list(traverse(first[i], second[i], sizes.ravel(), wanted)), dtype=np.int64)
                    for row in np.unique(cells // quantiser.width):
                        columns = cells[cells // quantiser.width == row] % quantiser.width
                        yield int(row), rep, x[i].tobytes(), columns.astype("<i4").tobytes()

        yield from batches_of(rows(), visit)

    visited = distinct.mapInArrow(visits, "row int, rep long, vector binary, columns binary")
    # Blocks of an index row, and of the queries that visit it; both bounded, neither cuts a row off.
    row_parts = F.array(*[F.lit(int(-(-n // BLOCK)) or 1) for n in sizes.sum(axis=1)])
    query_parts = F.lit(max(1, -(-distinct.count() // QUERY_BLOCK)))
    in_part = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    blocks = stored(
        index.withColumn("part", in_part(row_parts[F.col("row")]))
        .groupBy("row", "part")
        .agg(F.collect_list(F.struct("column", "ids", "vector")).alias("entries")),
        "index-blocks",
    )
    asking = stored(
        visited.withColumn("part", in_part(query_parts))
        .groupBy("row", "part")
        .agg(F.collect_list(F.struct("rep", "vector", "columns")).alias("queries")),
        "query-blocks",
    )
    together = asking.select("row", "queries").join(blocks.select("row", "entries"), "row").select("queries", "entries")
    found_schema = pa.schema([("rep", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])

    def reranked(batches):
        def rows():
            for asking, block in rows_of(batches, "queries", "entries"):
                x = np.frombuffer(b"".join(e["vector"] for e in block)).reshape(len(block), -1)
                columns = np.array([e["column"] for e in block])
                smallest = np.array([e["ids"][0] for e in block])
                for query in asking:
                    open_columns = np.zeros(quantiser.width, dtype=bool)
                    open_columns[np.frombuffer(query["columns"], dtype="<i4")] = True
                    met = np.flatnonzero(open_columns[columns])
                    gaps = x[met] - np.frombuffer(query["vector"])
                    scores = np.sqrt((gaps * gaps).sum(1))
                    if len(scores) > k + 1:
                        near = np.flatnonzero(scores <= np.partition(scores, k)[k])
                        met, scores = met[near], scores[near]
                    order = np.lexsort((smallest[met], scores))[: k + 1]
                    for i in order.tolist():
                        yield query["rep"], block[met[i]]["ids"], float(scores[i])

        yield from batches_of(rows(), found_schema, size=20_000)

    found = together.repartition(in_slices(vectors) * 2).mapInArrow(reranked, "rep long, ids array<long>, score double")
    nearest = W.partitionBy("rep").orderBy("score", F.col("ids")[0])
    best = stored(
        found.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k + 1).drop("nth"), "nearest"
    )
    # A query has at most k + 1 entries of at most k + 1 ids each.
    pairs = (
        asked.select("query_id", "rep")
        .join(best, "rep")
        .select("query_id", F.explode("ids").alias("vec_id"), "score")
        .where("query_id <> vec_id")
    )
    ranked = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        pairs.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_multi_index(spark: SparkSession, folder: str) -> DataFrame:
    """Ten nearest of every hundredth vector."""
    vectors = table(configure(spark), folder, "embeddings")
    return search(vectors, F.col("id") % 100 == 0)
