"""Document fingerprints by winnowing.

Every k-gram of code points gets a rolling hash; of every ``window`` hashes in a row the smallest
is kept, the rightmost if several are equal. Two texts that share a passage of at least
``window + k - 1`` code points share a fingerprint entry, and entries keep their positions, so
the passage can be found.

A fingerprint is the entries in order of position: eight hex digits of the hash and two of the
distance from the entry before (from the start for the first).

Edge cases: a null text is empty and has the empty fingerprint; a text shorter than k has one
entry, the hash of all of it; one with fewer than ``window`` k-grams is one window. Likeness is
the Jaccard similarity of the sets of hashes, 1 for two empty fingerprints. Rows without id come
first in the order of ids; rows that repeat an id are ordered by their texts, and the first of
them is the next of the row before. One row alone is its own next document. An empty table gives
no rows. Other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, rows_of, table, worker_state
from noteloom.llm.ordering import Buckets

K = 20  # code points of a gram
WINDOW = 31  # hashes of a window: passages of 50 code points are sure to be met

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_MIX = np.uint64(0xD6E8FEB86659FD93)
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept in the worker and grown by doubling."""
    kept = worker_state("winnowing_powers", dict)
    if kept.get("n", 0) < n:
        size = max(n, 2 * kept.get("n", 0), 1 << 14)
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            kept[name] = np.multiply.accumulate(steps)
        kept["n"] = size
    return kept["up"][:n], kept["down"][:n]


def gram_hashes(points: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of all k-grams, from differences of one running sum."""
    up, down = _powers(len(points))
    sums = np.empty(len(points) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((points + np.uint64(1)) * up, out=sums[1:])
    hashes = (sums[k:] - sums[:-k]) * down[: len(points) - k + 1]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX
    return hashes >> np.uint64(32)


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the entries that are kept."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if not len(points):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    hashes = gram_hashes(points, min(k, len(points)))
    # One number per gram: hash first, then later positions before earlier ones.
    last = np.uint64(0xFFFFFFFF)
    least = (hashes << np.uint64(32)) | (last - np.arange(len(hashes), dtype=np.uint64))
    reach, span = min(window, len(hashes)), 1
    while 2 * span <= reach:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < reach:
        least = np.minimum(least[: len(least) - (reach - span)], least[reach - span :])
    kept = least[np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))]
    return (kept >> np.uint64(32)).astype(np.uint32), (last - (kept & last)).astype(np.int64)


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    entries = np.empty(len(hashes), dtype=[("hash", ">u4"), ("gap", "u1")])
    entries["hash"] = hashes
    entries["gap"] = np.diff(positions, prepend=0)
    return entries.tobytes().hex()


def from_text(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    entries = np.frombuffer(bytes.fromhex(fingerprint), dtype=[("hash", ">u4"), ("gap", "u1")])
    return entries["hash"].astype(np.uint32), np.cumsum(entries["gap"].astype(np.int64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate((a, b))
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(both) - common)


def fingerprints(df: DataFrame, id_column: str, text_column: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """``id_column``, fingerprint, and its hashes and positions, for every row."""
    _checked(k, window)
    schema = pa.schema(
        [
            ("id", pa.int64()),
            ("fingerprint", pa.string()),
            ("hashes", pa.list_(pa.int64())),
            ("positions", pa.list_(pa.int64())),
        ]
    )

    def work(batches):
        def rows():
            for doc_id, text in rows_of(batches, "id", "text"):
                hashes, positions = winnow(text, k, window)
                yield doc_id, as_text(hashes, positions), hashes.tolist(), positions.tolist()

        yield from batches_of(rows(), schema)

    read = df.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    found = read.mapInArrow(work, "id long, fingerprint string, hashes array<long>, positions array<long>")
    return found.withColumnRenamed("id", id_column)


def _checked(k: int, window: int) -> None:
    if k < 1 or not 1 <= window <= 255:
        raise ValueError("k is at least 1, window from 1 to 255")


def beside_next(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows sorted by bucket, place and id, so that the next document follows each in its task.

    The first document of every bucket is also sent, as a copy, to the bucket before; that of
    the first bucket goes to the last one. Texts move once, every bucket to a task of its own.
    """
    named = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    buckets = Buckets.of(named, "id")
    bucket = buckets.number(F.col("id"))
    # One row per bucket; a missing id is the smallest of all.
    firsts = sorted(
        (row["bucket"], None if row["without"] else row["first"])
        for row in named.groupBy(bucket.alias("bucket"))
        .agg(F.min("id").alias("first"), F.max(F.col("id").isNull()).alias("without"))
        .collect()
    )
    targets = {number: firsts[i - 1][0] for i, (number, _) in enumerate(firsts)}
    first_ids = dict(firsts)
    slots = range(len(buckets.bounds) + 1)
    first_of = F.array(*[F.lit(first_ids.get(i)).cast("long") for i in slots])
    target_of = F.array(*[F.lit(targets.get(i, 0)) for i in slots])
    at = bucket.alias("at")
    placed = named.select("id", "text", at).withColumn("is_first", F.col("id").eqNullSafe(first_of[F.col("at")]))
    own = F.struct(F.col("at").alias("bucket"), F.lit(False).alias("copy"))
    copy = F.struct(target_of[F.col("at")].alias("bucket"), F.lit(True).alias("copy"))
    return (
        placed.select("id", "text", F.explode(F.when(F.col("is_first"), F.array(own, copy)).otherwise(F.array(own))).alias("to"))
        .select("to.bucket", "to.copy", "id", "text")
        .repartitionById(len(slots), F.col("bucket"))
        .sortWithinPartitions("bucket", "copy", "id", "text")
    )


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_EDITED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the start of the next document."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def with_edits(df: DataFrame, id_column: str, text_column: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how near those and the next one are."""
    _checked(k, window)

    def work(batches):
        def taken(text):
            hashes, positions = winnow(text, k, window)
            return as_text(hashes, positions), np.unique(hashes)

        def rows():
            held = None
            for bucket, copy, doc_id, text in rows_of(batches, "bucket", "copy", "id", "text"):
                if held and held[0] != bucket:
                    held = None
                if held is None and copy:  # a second copy, of a row that repeats an id
                    continue
                now = (bucket, doc_id, text, *taken(text))
                if held:
                    _, before_id, before, fingerprint, hashes = held
                    changed = edited(before, text)
                    changed_fingerprint, changed_hashes = taken(changed)
                    yield (
                        before_id,
                        len(before),
                        hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        fingerprint,
                        changed_fingerprint,
                        likeness(hashes, changed_hashes),
                        likeness(hashes, now[4]),
                    )
                held = None if copy else now

        yield from batches_of(rows(), _EDITED)

    return beside_next(df, id_column, text_column).mapInArrow(work, EDITED)


def op2_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """Winnowing fingerprints of every document and of its edited text."""
    return with_edits(table(configure(spark), folder, "documents"), "doc_id", "text")
