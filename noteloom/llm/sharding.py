"""Shards of nearly equal bytes by Karmarkar-Karp differencing of indivisible groups.

A partial partition is one sum for each shard. The two with the largest spread (largest less smallest
sum) are combined, the larger sums of one with the smaller of the other, until one is left
(``differenced``). Groups of rows, by default those of equal texts, are never divided.

Rows are first summed up to groups. Small groups are dealt to buckets by a hash of the group, and each
bucket is differenced by a task of its own into as many parts as there are shards. The parts of all
buckets, and the groups that are larger than an average part, are differenced once more, by the driver:
a part for each shard of a bucket of ``GROUPS`` groups, and at most twice as many large groups, since more
do not fit into all bytes and rows. A group with more than an even share of the bytes gets a shard of its
own first (``dealt``), and the others share the rest evenly.

Large groups are joined to their rows by a broadcast of that bounded list, all others, none of which
is large, by a shuffle; no task gets the rows of a large group together. Slots are numbers in the order of
ids within a shard, by range partitions and their offsets, not by one task a shard.

Edge cases: a null text is the empty one, of size 1. Rows that repeat an id are rows of their own, in
their order of group and size; a null id comes last. With fewer groups than shards, some shards are
empty. A very long text is a group that may alone exceed the average of a shard. An empty table gives
no rows. Columns of the input are kept, whatever their names, but for those that the results need
(``shard``, ``slot``), which are replaced.
"""

import heapq
import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import configure, fresh_name, stored, table, utf8
from noteloom.operators.notes import with_row_id

SHARDS = 8
LAW = "bytes"
BUCKETS = 64  # at least
GROUPS = 400_000  # of a bucket, on average


def differenced(sizes: Sequence[int], parts: int) -> list[int]:
    """The part of each size, by differencing.

    Single sizes wait in descending order and become partial partitions when it is their turn. A
    node of the tree of combinations keeps which of its sums came from where; going down from the
    last one gives every size its part. Equal spreads are taken in order of their making.
    """
    n = len(sizes)
    if parts < 1:
        raise ValueError("there has to be a part")
    if not n:
        return []
    order = sorted(range(n), key=lambda i: (-sizes[i], i))
    rest = (0,) * (parts - 1)
    waiting: list[tuple] = []  # (minus the spread, node, sums in descending order)
    next_single = 0

    def largest() -> tuple[int, tuple[int, ...]]:
        nonlocal next_single
        if next_single < n and (not waiting or sizes[order[next_single]] >= -waiting[0][0]):
            next_single += 1
            return next_single - 1, (sizes[order[next_single - 1]], *rest)
        _, node, sums = heapq.heappop(waiting)
        return node, sums

    made: list[tuple[int, int, list[int]]] = []
    columns = range(parts)
    for _ in range(n - 1):
        (left, one), (right, other) = largest(), largest()
        sums = [a + b for a, b in zip(one, reversed(other), strict=True)]
        by_size = sorted(columns, key=sums.__getitem__, reverse=True)
        ordered = tuple([sums[i] for i in by_size])
        heapq.heappush(waiting, (ordered[-1] - ordered[0], n + len(made), ordered))
        made.append((left, right, by_size))

    labels: dict[int, Sequence[int]] = {n + len(made) - 1: columns}
    for node in range(n + len(made) - 1, n - 1, -1):
        left, right, by_size = made[node - n]
        of_sum = [0] * parts
        for label, column in zip(labels.pop(node), by_size, strict=True):
            of_sum[column] = label
        labels[left], labels[right] = of_sum, of_sum[::-1]
    found = [0] * n
    for place, i in enumerate(order):
        found[i] = labels[place][0]
    return found


def dealt(sizes: Sequence[int], parts: int) -> list[int]:
    """As ``differenced``, but a size that is no less than an even share of what is left gets a part of its
    own first: nothing could be added to it, and its spread would hide those of the other parts."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    rest, alone = sum(sizes), 0
    while alone < min(parts - 1, len(order)) and sizes[order[alone]] * (parts - alone) >= rest:
        rest -= sizes[order[alone]]
        alone += 1
    others = differenced([sizes[i] for i in order[alone:]], parts - alone)
    found = [0] * len(sizes)
    for i, part in zip(order, [*range(alone), *[alone + p for p in others]], strict=True):
        found[i] = part
    return found


def _divided(groups: DataFrame, parts: int) -> DataFrame:
    """``groups`` (bucket, group, bytes) with the part of their bucket's partition."""

    def run(bucket: pa.Table) -> pa.Table:
        # In an order of their own, whatever order the shuffle brings.
        bucket = bucket.sort_by([("bytes", "descending"), ("group", "ascending")])
        found = differenced(bucket.column("bytes").to_pylist(), parts)
        return bucket.append_column("part", pa.array(found, pa.int32()))

    return groups.groupBy("bucket").applyInArrow(run, "bucket long, group string, bytes long, part int")


def shards_of_groups(sized: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(group, shard) of the large groups, a bounded list, and of all others.

    ``sized`` has a row for each member: group (text) and size. Sizes are whole numbers from 0.
    """
    spark = sized.sparkSession
    groups = stored(
        sized.groupBy("group").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("members")), "groups"
    )
    n, size, members = groups.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("members")).first()
    buckets = max(BUCKETS, math.ceil(n / GROUPS))
    parts = buckets * shards
    large = (F.col("bytes") * parts > (size or 0)) | (F.col("members") * parts > (members or 0))
    bucket = F.pmod(F.xxhash64("group"), F.lit(buckets)).alias("bucket")
    divided = stored(_divided(groups.where(~large).select(bucket, "group", "bytes"), shards), "parts")

    # At most ``parts`` parts, and twice as many large groups.
    sums = divided.groupBy("bucket", "part").agg(F.sum("bytes").alias("bytes")).collect()
    singles = groups.where(large).select("group", "bytes").collect()
    items = sorted([(r["bytes"], r["bucket"], r["part"], "") for r in sums] + [(r["bytes"], -1, -1, r["group"]) for r in singles])
    found = list(zip(items, dealt([i[0] for i in items], shards), strict=True))
    of_part = [(b, p, s) for (_, b, p, _), s in found if b >= 0]
    of_single = [(g, s) for (_, b, _, g), s in found if b < 0]
    of_parts = spark.createDataFrame(of_part, "bucket long, part int, shard int")
    rest = divided.join(F.broadcast(of_parts), ["bucket", "part"]).select("group", "shard")
    return spark.createDataFrame(of_single, "group string, shard int"), rest


def with_shard(df: DataFrame, group: str, size: str, shards: int = SHARDS) -> DataFrame:
    """``df`` with the shard of every row; rows with the same group have the same shard."""
    df = df.drop("shard")
    key, shard = fresh_name(df, "shard_group"), fresh_name(df, "shard")
    sized = df.select(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("group"), F.col(size).cast("long").alias("size"))
    large, rest = shards_of_groups(sized, shards)
    keyed = df.withColumn(key, F.coalesce(F.col(group).cast("string"), F.lit("")))
    large = F.broadcast(large.select(F.col("group").alias(key), F.col("shard").alias(shard)))
    rest = rest.select(F.col("group").alias(key), F.col("shard").alias(shard))
    columns = [*df.columns, shard]
    of_large = keyed.join(large, key).select(*columns)
    return of_large.unionByName(keyed.join(large, key, "left_anti").join(rest, key).select(*columns))


def with_slot(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df``, which has a shard, with the number of each row in its shard, from 0, in that order."""
    df = df.drop("slot")
    number, first = fresh_name(df, "shard_number"), fresh_name(df, "shard_first")
    keys = [F.asc_nulls_last("shard"), *[F.asc_nulls_last(c) for c in order]]
    rows = with_row_id(df, keys, number, unique=False)
    # One row for each shard.
    firsts = rows.groupBy("shard").agg(F.min(number).alias(first))
    return rows.join(F.broadcast(firsts), "shard").select(*df.columns, (F.col(number) - F.col(first)).alias("slot"))


def measured(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes and one), text_crc32 and the group of equal texts of every row."""
    text = utf8(text_column)
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("text_group"),
    )


def write_shards(
    df: DataFrame, folder: str, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS
) -> None:
    """All columns of ``df`` as Parquet, a folder for each shard, files in the order of ids.

    Reading a shard's files by name gives its rows in the order of their slots.
    """
    group, size = fresh_name(df, "text_group"), fresh_name(df, "text_size")
    keyed = df.withColumns({group: F.sha2(utf8(text_column), 256), size: F.octet_length(utf8(text_column)) + 1})
    dealt = with_shard(keyed, group, size, shards)
    order = [F.asc_nulls_last("shard"), F.asc_nulls_last(id_column), F.asc(group)]
    # Ids alone would send copies of a row to one task.
    spread = [*order, F.rand(7)]
    placed = dealt.repartitionByRange(*spread).sortWithinPartitions(*order)
    placed.drop(group, size).write.partitionBy("shard").parquet(folder)


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document."""
    sized = stored(measured(table(configure(spark), folder, "documents")), "measured")
    placed = with_slot(with_shard(sized, "text_group", "size"), ["doc_id", "text_group", "size"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
