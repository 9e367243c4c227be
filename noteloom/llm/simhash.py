"""Near-duplicates by SimHash, with an exact comparison of all fingerprints in tiles.

A fingerprint bit is 1 if it is set in more than half of the hashes of a text's word shingles.
Two fingerprints link at ``radius`` or fewer differing bits. Equal fingerprints are one node.
The distinct ones are put into tiles by the numbers of set bits in their upper and lower half;
since these numbers differ by at most as many as the bits that differ, tiles whose numbers are
further apart than ``radius`` are never brought together, nor are the parts of two tiles whose
upper quarters are. What remains is compared exactly by exclusive-or and bit counts. A pair of
tiles yields links that span its groups, not all its pairs, so no link between groups is lost.

Edge cases: a null text is empty; a text without words has fingerprint zero and is linked like
any other; a text with fewer words than a shingle is one shingle. Rows without id get the
component of their text, whose id is the smallest one in it, null if it has none. Rows that
repeat an id each get their own text's component. An empty table gives no rows. Other columns
are not read; where rows are kept, they stay as they are.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, fresh_name, in_slices, rows_of, stored, table
from noteloom.llm.components import components

WORDS = 4  # of a shingle
RADIUS = 4  # bits
SEED = 42
TILE = 1 << 16  # fingerprints of a tile, on average at most
_CELLS = 1 << 18  # comparisons held at a time


# --- fingerprints ---------------------------------------------------------------------


def simhash(text: str, words_of_shingle: int = WORDS) -> int:
    """Fingerprint as an unsigned 64-bit number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    n = len(words) - words_of_shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    stops = ends[words_of_shingle - 1 :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for first in range(0, n, 1 << 14):
        part = b"".join(
            [digest(joined[a:b], SEED) for a, b in zip(starts[first : first + (1 << 14)], stops[first : first + (1 << 14)])]
        )
        bits = np.unpackbits(np.frombuffer(part, dtype=np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: Column, words_of_shingle: int = WORDS) -> Column:
    """Fingerprint column, as a signed long with the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.array([simhash(t, words_of_shingle) for t in texts], dtype=np.uint64)
        return pd.Series(found.view(np.int64))

    return of(F.coalesce(text.cast("string"), F.lit("")))


def hexadecimal(fingerprint_column: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fingerprint_column)), 16, "0"))


# --- comparison -----------------------------------------------------------------------


def _united(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the nodes ``a`` and ``b`` are linked; a label is the smallest node of its group."""
    while True:
        one, other = labels[a], labels[b]
        apart = one != other
        if not apart.any():
            return labels
        a, b, one, other = a[apart], b[apart], one[apart], other[apart]
        np.minimum.at(labels, np.maximum(one, other), np.minimum(one, other))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the groups of fingerprints within ``radius`` in one tile or between two.

    Each part of a tile with the same number of bits in the upper quarter meets only the parts
    of the other whose number is no further away than ``radius``.
    """
    quarter = lambda v: np.bitwise_count(v >> np.uint64(48)).astype(np.int64)
    left = left[np.argsort(quarter(left), kind="stable")]
    same = right is None
    right = left if same else right[np.argsort(quarter(right), kind="stable")]
    nodes = left if same else np.concatenate((left, right))
    shift = 0 if same else len(left)
    labels = np.arange(len(nodes))
    of_left, of_right = quarter(left), quarter(right)
    for bits in np.unique(of_left):
        first, last = np.searchsorted(of_left, [bits, bits + 1])
        low, high = np.searchsorted(of_right, [bits if same else bits - radius, bits + radius + 1])
        if low >= high:
            continue
        step = max(1, _CELLS // (high - low))
        for i in range(first, last, step):
            rows = left[i : min(i + step, last)]
            near = np.bitwise_count(rows[:, None] ^ right[None, low:high]) <= radius
            a, b = np.nonzero(near)
            a, b = a + i, b + (low + shift)
            if same:
                a, b = a[a < b], b[a < b]
            if len(a):
                labels = _united(labels, a, b)
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[labels[moved]], nodes[moved]


def links(fingerprints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that span the groups of distinct fingerprints (column ``fp``).

    The counts that come to the driver are one for each pair of bit numbers, at most 33 x 33.
    """
    low_half = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    classed = fingerprints.select(
        "fp",
        F.bit_count(F.shiftrightunsigned("fp", 32)).alias("upper"),
        F.bit_count(low_half).alias("lower"),
    )
    counted = classed.groupBy("upper", "lower").agg(F.count(F.lit(1)).alias("n")).collect()
    tiles_of = {(r["upper"], r["lower"]): -(-r["n"] // tile) for r in counted}

    number = F.lit(1)
    if tiles_of and max(tiles_of.values()) > 1:
        many = F.create_map(*[F.lit(v) for (u, d), n in tiles_of.items() if n > 1 for v in (u * 64 + d, n)])
        number = F.coalesce(F.element_at(many, F.col("upper") * 64 + F.col("lower")), F.lit(1))
    tiled = (
        classed.withColumn("part", F.pmod(F.xxhash64("fp"), number).cast("int"))
        .groupBy("upper", "lower", "part")
        .agg(F.collect_list("fp").alias("fps"))
    )

    # A tile is sent once to every pair it takes part in. The smaller (upper, lower, part) of a pair
    # is its left side.
    schema = pa.schema([("pair", pa.string()), ("side", pa.int32()), ("fps", pa.binary())])

    def sent(batches):
        def rows():
            for batch in batches:
                for u, d, p, fps in zip(*(batch.column(i) for i in range(4)), strict=True):
                    me = (u.as_py(), d.as_py(), p.as_py())
                    data = fps.values.to_numpy().astype("<i8").tobytes()
                    for du in range(-radius, radius + 1):
                        for dd in range(abs(du) - radius, radius - abs(du) + 1):
                            for part in range(tiles_of.get((me[0] + du, me[1] + dd), 0)):
                                you = (me[0] + du, me[1] + dd, part)
                                yield "/".join(map(str, min(me, you) + max(me, you))), int(me > you), data

        yield from batches_of(rows(), schema, cells=8_000_000)

    def compared(batches):
        def rows():
            key, left = None, None
            for pair, side, data in rows_of(batches, "pair", "side", "fps"):
                fps = np.frombuffer(data, dtype="<u8")
                halves = pair.split("/")
                if halves[:3] == halves[3:]:
                    found = tile_links(fps, None, radius)
                elif side == 0:
                    key, left = pair, fps
                    continue
                elif key == pair:
                    found = tile_links(left, fps, radius)
                else:
                    raise ValueError(f"tile pair {pair} without its left side")
                yield from zip(*(x.view(np.int64).tolist() for x in found), strict=True)

        yield from batches_of(rows(), pa.schema([("a", pa.int64()), ("b", pa.int64())]), size=50_000)

    paired = tiled.mapInArrow(sent, "pair string, side int, fps binary")
    together = paired.repartition(in_slices(fingerprints) * 2, "pair").sortWithinPartitions("pair", "side")
    return together.mapInArrow(compared, "a long, b long")


def near_duplicates(
    df: DataFrame, id_column: str, text_column: str, words_of_shingle: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """id, fp (signed long) and component_id (smallest id of the group) of every row."""
    return _grouped(df, id_column, text_column, words_of_shingle, radius).drop("label")


def _grouped(df: DataFrame, id_column: str, text_column: str, words_of_shingle: int, radius: int) -> DataFrame:
    """The same with the label of the group: an id that is there with several texts may be the
    smallest of several groups."""
    found = stored(
        df.select(F.col(id_column).cast("long").alias("id"), fingerprint(F.col(text_column), words_of_shingle).alias("fp")),
        "fingerprints",
    )
    distinct = stored(found.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct-fingerprints")
    labels = components(links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp")
    labelled = stored(
        distinct.join(labels, "fp", "left").select("fp", "first_id", F.coalesce("label", "fp").alias("label")),
        "labelled",
    )
    smallest = stored(labelled.groupBy("label").agg(F.min("first_id").alias("component_id")), "smallest")
    by_fingerprint = stored(labelled.join(smallest, "label").select("fp", "component_id", "label"), "components")
    return found.join(by_fingerprint, "fp").select("id", "fp", "component_id", "label")


def without_near_duplicates(
    df: DataFrame, id_column: str, text_column: str, words_of_shingle: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """The rows of ``df``, of each group only the document with the smallest id.

    Rows without id are never dropped. A row is dropped only for one whose text is near its own, so
    rows that repeat an id with other texts stay; of the rows of a group that have its smallest id,
    one of those with the smallest fingerprint does.
    """
    found = stored(_grouped(df, id_column, text_column, words_of_shingle, radius), "near-duplicates")
    named = found.where("id is not null")
    of_id = named.groupBy("id").agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("n"))
    of_id = stored(of_id.where("n > 1 or c < id"), "dropped-or-repeated")
    name = fresh_name(df, "dropped_id")
    own = F.col(id_column).cast("long")
    kept = df.join(of_id.select(F.col("id").alias(name)), own == F.col(name), "left_anti")
    repeated = of_id.where("n > 1").select("id")
    if repeated.isEmpty():
        return kept
    first = named.groupBy("label").agg(F.min(F.struct("id", "fp")).alias("first")).select("first.id", "first.fp")
    first = first.join(repeated, "id", "left_semi")
    mark = fresh_name(df, "own_fingerprint")
    again = df.join(repeated.select(F.col("id").alias(name)), own == F.col(name), "left_semi")
    again = again.withColumn(mark, fingerprint(F.col(text_column), words_of_shingle))
    first = first.select(F.col("id").alias(name), F.col("fp").alias(f"{mark}_"))
    again = again.join(first, (own == F.col(name)) & (F.col(mark) == F.col(f"{mark}_")), "left_semi")
    return kept.unionByName(again.dropDuplicates([id_column, mark]).select(*df.columns))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    documents = table(configure(spark), folder, "documents")
    found = near_duplicates(documents, "doc_id", "text")
    return found.select(F.col("id").alias("doc_id"), hexadecimal("fp").alias("fingerprint"), "component_id")
