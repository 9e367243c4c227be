"""Packing documents into as few sequences of fixed length as can be found, by bin completion.

Only documents longer than a sequence are cut; their full pieces are sequences of their own, and
the shorter first piece is packed with the other documents. What has to be packed is described
by the count of every length, at most ``capacity - 1`` numbers whatever the corpus, so the search
runs on those counts and the plan is a short list of fillings, each with the number of sequences
that it makes.

The search takes the largest remaining length, enumerates fillings of the space beside it that no
other filling dominates (none of its parts can be replaced by one larger length that still fits),
least waste first, and uses the chosen one as often as the counts allow, then fewer times. The
first ``width`` fillings of a node are found by a faster search of few parts; after them come all
others. A branch ends when its waste so far and the bound of what remains cannot beat the incumbent. Incumbents are best-fit
packings, of all lengths and of what remains at each step. The search stops at the lower bound or
after ``effort`` fillings; what it returns then is its best plan, always of all documents.

The planned places are dealt to pieces by numbering the pieces of each length; the numbers are
counted per shard of the ids, so a length that a third of all documents share is spread out.

Edge cases: a null text is empty and is packed as its end id; rows without id or that repeat one
are packed like others; an empty table gives no rows. Other columns are not read.
"""

import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, in_slices, rows_of, stored, table
from noteloom.llm.tokens import MEMO_PIECES, ByteEncoder, Encoder, encoder, in_groups

CAPACITY = 2048
END_ID = 0
EFFORT = 6_000  # fillings that the search may try
WIDTH = 8  # fillings of a node that are sought among few parts, before all others
DEAD_ENDS = 500  # steps of the enumeration without a filling that count as a try

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


# --- the search, on counts of lengths -------------------------------------------------


@dataclass(frozen=True)
class Filling:
    """Lengths that share a sequence, and how many sequences are filled so."""

    lengths: tuple[int, ...]
    times: int


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: large lengths cannot share one, the rest fill what is left."""
    lengths = np.arange(len(counts))
    total = int((lengths * counts).sum())
    number = np.cumsum(counts)
    weight = np.cumsum(lengths * counts)
    half = capacity // 2
    best = -(-total // capacity)
    for low in range(half + 1):
        above = min(capacity - low, len(counts) - 1)  # longer ones share with nothing of `low` or more
        alone = int(number[-1] - number[above])
        middle = min(half, above)
        pairs = int(number[above] - number[middle])
        room = pairs * capacity - int(weight[above] - weight[middle])
        small = int(weight[middle] - (weight[low - 1] if low else 0))
        best = max(best, alone + pairs + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Largest first; each filling takes the largest length that still fits until none does."""
    left = {length: n for length, n in counts.items() if n}
    order = sorted(left, reverse=True)
    plan = []
    while order:
        gap, filling = capacity, Counter()
        for length in order:
            fits = min(left[length], gap // length)
            if fits:
                filling[length] = fits
                gap -= fits * length
                if not gap:
                    break
        times = min(left[length] // n for length, n in filling.items())
        plan.append(Filling(tuple(filling.elements()), times))
        for length, n in filling.items():
            left[length] -= n * times
        order = [length for length in order if left[length]]
    return plan


class _Sums:
    """Which sums up to ``gap`` one to four of the available lengths reach, and how."""

    def __init__(self, counts: np.ndarray, gap: int):
        self.counts, self.gap = counts, gap
        self.one = np.zeros(gap + 1, dtype=bool)
        self.one[1:] = counts[1 : gap + 1] > 0
        self._two = None

    @property
    def two(self) -> np.ndarray:
        """Sums of two lengths, equal ones included; whether two are there is seen when they are taken."""
        if self._two is None:
            available = np.flatnonzero(self.one).tolist()
            mask = sum(1 << length for length in available)
            reached = 0
            for length in available:
                reached |= mask << length
            raw = (reached & ((1 << (self.gap + 1)) - 1)).to_bytes(self.gap // 8 + 1, "little")
            self._two = np.unpackbits(np.frombuffer(raw, dtype=np.uint8), bitorder="little")[: self.gap + 1].astype(bool)
        return self._two

    def exact(self, total: int, parts: int, most: int):
        """Fillings of so many parts that sum up to ``total``, larger parts first."""
        if parts == 1:
            if self.one[total]:
                yield (total,)
            return
        first, rest = (self.one, self.one) if parts == 2 else (self.one, self.two) if parts == 3 else (self.two, self.two)
        low = -(-total // 2) if parts != 3 else 1
        fits = np.flatnonzero(first[low:total] & rest[total - low : 0 : -1]) + low
        found = 0
        for size in fits[::-1].tolist():
            heads = [(size,)] if parts < 4 else self.exact(size, 2, 2)
            for head in heads:
                for tail in self.exact(total - size, 1 if parts == 2 else 2, 2):
                    filling = head + tail
                    if parts == 3 and tail[0] > size:
                        continue
                    if all(self.counts[p] >= n for p, n in Counter(filling).items()):
                        yield tuple(sorted(filling, reverse=True))
                        found += 1
            if found >= most:
                return


def fillings(gap: int, counts: np.ndarray, width: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``gap`` from the lengths that ``counts`` still holds, least waste first.

    Where even four of the largest lengths do not reach the gap, largest ones are taken first.
    """
    head: list[int] = []
    counts = counts.copy()
    while True:
        available = np.flatnonzero(counts[: gap + 1])
        if not len(available) or available[-1] * 4 >= gap:
            break
        largest = int(available[-1])
        n = min(int(counts[largest]), max(1, (gap - 3 * largest) // largest))
        head += [largest] * n
        counts[largest] -= n
        gap -= n * largest
    if not len(available):
        return [tuple(head)]
    sums = _Sums(counts, gap)
    for total in range(gap, 0, -1):
        found: dict[tuple[int, ...], None] = {}
        for parts in range(1, 5):
            for filling in sums.exact(total, parts, width):
                if filling not in found and not _dominated(filling, gap - total, counts, gap):
                    found[filling] = None
            if len(found) >= width or (found and parts > 1):
                break
        if found:
            return [tuple(head) + f for f in list(found)[:width]]
    return [tuple(head)]


def _dominated(parts: tuple[int, ...], waste: int, counts: np.ndarray, gap: int) -> bool:
    """Whether a length could take the place of several parts, or of less than it with less waste."""
    picks = range(1, 1 << len(parts))
    for pick in picks:
        chosen = [p for i, p in enumerate(parts) if pick >> i & 1]
        size = sum(chosen)
        low = size if len(chosen) > 1 else size + 1
        for length in range(low, min(size + waste, gap) + 1):
            if counts[length] > parts.count(length):
                return True
    return False


def _within(mask: int, waste: int) -> int:
    """Numbers from which one of ``mask`` is at most ``waste`` away, upwards."""
    reach = 0
    while reach < waste:
        step = min(reach + 1, waste - reach)
        mask |= mask >> step
        reach += step
    return mask


def completions(gap: int, counts: np.ndarray, least: int = 1) -> Iterator[tuple[int, ...] | None]:
    """All undominated ways to fill ``gap`` down to ``least``, least waste first, then larger parts first.

    After every ``DEAD_ENDS`` steps without a filling comes a ``None``, so a caller can stop.
    Sets of lengths are numbers with a bit for each length.
    """
    lengths = np.flatnonzero(counts[: gap + 1]).tolist()
    number = {length: int(counts[length]) for length in lengths}
    within = (1 << (gap + 1)) - 1
    reached, below = [1], {}  # sums of the first lengths; place of each length
    for length in lengths:
        below[length] = len(reached) - 1
        sums, left, step = reached[-1], min(number[length], gap // length), 1
        while left:
            n = min(step, left)
            sums |= (sums << n * length) & within
            left, step = left - n, 2 * step
        reached.append(sums)
    everything = sum(1 << length for length in lengths)
    steps = 0

    def fit(total: int, waste: int, parts: tuple[int, ...], free: int):
        """Ways to go on from ``parts`` (largest first) by ``total``; ``free`` lengths are not used up."""
        nonlocal steps
        steps += 1
        if steps % DEAD_ENDS == 0:
            yield None
        near = _within(free, waste)
        if not total:
            if not free & ((2 << waste) - 2):  # else one more length would fit
                yield parts
            return
        # Next parts that a larger length could replace, alone or with parts taken before.
        bad = _within(free >> 1, waste - 1) if waste else 0
        for part in parts:
            bad |= bad >> part | near >> part
        last = parts[-1] if parts else total
        able = everything & ~bad & ((1 << (min(last, total) + 1)) - 1)
        if parts and parts.count(last) == number[last]:
            able &= ~(1 << last)
        while able:
            part = able.bit_length() - 1
            able ^= 1 << part
            used = parts.count(part) + 1
            # What is left to reach: by smaller lengths and by further ones of this.
            place, rest = below[part], total - part
            if not any(reached[place] >> (rest - n * part) & 1 for n in range(min(number[part] - used, rest // part) + 1)):
                continue
            yield from fit(rest, waste, (*parts, part), free & ~(1 << part) if used == number[part] else free)

    for total in range(gap, max(least, 1) - 1, -1):
        if reached[-1] >> total & 1:
            yield from fit(total, gap - total, (), everything)


def _branches(gap: int, counts: np.ndarray, width: int, least: int, most: int) -> Iterator[tuple[tuple[int, ...], int] | None]:
    """Fillings beside a largest length that is there ``most`` times, and how often to use each at most."""
    first = fillings(gap, counts, width)
    yield from ((filling, most) for filling in first)
    seen = {tuple(sorted(filling)) for filling in first}
    for filling in completions(gap, counts, least):
        if filling is None:
            yield None
        elif tuple(sorted(filling)) not in seen:
            yield filling, most
    if most > 1:  # once, and the rest of the largest length otherwise
        for filling in completions(gap, counts, least):
            yield filling and (filling, 1)
        if not counts[: gap + 1].any():
            yield (), 1


def bin_completion(counts: np.ndarray, capacity: int = CAPACITY, effort: int = EFFORT, width: int = WIDTH) -> list[Filling]:
    """A plan for ``counts[length]`` pieces of every length below ``capacity``."""
    counts = np.asarray(counts, dtype=np.int64).copy()
    counts[0] = 0
    lengths = np.arange(len(counts))
    bound = lower_bound(counts, capacity)
    used_by = lambda plan: sum(f.times for f in plan)
    as_dict = lambda left: {int(n): int(left[n]) for n in np.flatnonzero(left)}
    best = best_fit(as_dict(counts), capacity)
    tries = effort

    # Depth first: what remains, the plan so far as a chain, its sequences, and the fillings still to
    # be tried there. Plans share their beginnings.
    stack: list = [(counts, None, 0, 0, None)]
    while stack and used_by(best) > bound and tries > 0:
        left, chain, used, depth, branches = stack.pop()
        remaining = int((lengths * left).sum())
        if not remaining:
            if used < used_by(best):
                best = _unchained(chain)
            continue
        if used + -(-remaining // capacity) >= used_by(best):
            continue
        largest = int(np.flatnonzero(left)[-1])
        if branches is None:
            if depth % 64 == 63:
                rest = best_fit(as_dict(left), capacity)
                if used + used_by(rest) < used_by(best):
                    best = _unchained(chain) + rest
            without = left.copy()
            without[largest] -= 1
            least = remaining - largest - (used_by(best) - used - 2) * capacity
            branches = _branches(capacity - largest, without, width, least, int(left[largest]))
        tries -= 1
        branch = next(branches, False)
        if branch is False:
            continue
        stack.append((left, chain, used, depth, branches))
        if branch is None:
            continue
        first, most = branch
        filling = Counter((largest, *first))
        times = min(most, *(int(left[length]) // n for length, n in filling.items()))
        after = left.copy()
        for length, n in filling.items():
            after[length] -= n * times
        stack.append((after, (chain, Filling(tuple(filling.elements()), times)), used + times, depth + 1, None))
    return best


def _unchained(chain) -> list[Filling]:
    plan = []
    while chain is not None:
        chain, filling = chain
        plan.append(filling)
    return plan[::-1]


def places(plan: list[Filling]) -> np.ndarray:
    """Which numbers of each length go where.

    Rows (length, first number, end, number per sequence, first sequence, offset of the first),
    sorted: at most one row for each length of each filling.
    """
    given: Counter = Counter()
    rows, sequence = [], 0
    for filling in plan:
        offset = 0
        for length, n in sorted(Counter(filling.lengths).items(), reverse=True):
            first = given[length]
            given[length] += n * filling.times
            rows.append((length, first, given[length], n, sequence, offset))
            offset += length * n
        sequence += filling.times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


# --- Spark jobs -----------------------------------------------------------------------


def pieces(
    df: DataFrame,
    id_column: str,
    text_column: str,
    path: str,
    kind: type[Encoder],
    end_id: int,
    capacity: int,
    memo: int = MEMO_PIECES,
) -> DataFrame:
    """doc_id, piece, start, length and crc32 of the ids of every piece."""
    end = struct.pack("<I", end_id)

    def work(batches):
        encode = encoder(kind, path, memo=memo)

        def rows():
            for group in in_groups(rows_of(batches, "id", "text")):
                for (doc_id, _), ids in zip(group, encode.many([text for _, text in group]), strict=True):
                    yield from cut(doc_id, ids + end)

        def cut(doc_id, ids):
            total = len(ids) // 4
            start, stop, piece = 0, total % capacity or capacity, 0
            while start < total:
                yield doc_id, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])
                start, stop, piece = stop, stop + capacity, piece + 1

        yield from batches_of(rows(), _PIECES, size=10_000)

    named = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    return named.mapInArrow(work, PIECES)


def packed(found: DataFrame, capacity: int = CAPACITY, effort: int = EFFORT) -> DataFrame:
    """The pieces (``PIECES``, written before) with sequence_id and offset.

    Counts come to the driver as one row per length; full pieces need no search.
    """
    counted = found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in counted:
        counts[row["length"]] = row["n"]
    plan = bin_completion(counts[:capacity], capacity, effort)
    full = Filling((capacity,), int(counts[capacity]))
    table_of_places = places([*plan, full]) if full.times else places(plan)

    shards = in_slices(found)
    salted = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    per_shard = salted.groupBy("length", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_shard.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = W.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        salted.withColumn("rank", F.row_number().over(within))
        .join(offsets, ["length", "shard"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank") - 1).alias("number"))
    )

    schema = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        keys = table_of_places[:, 0] << 40 | table_of_places[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy()
            number = batch.column(5).to_numpy()
            row = table_of_places[np.searchsorted(keys, length << 40 | number, side="right") - 1]
            rank = number - row[:, 1]
            sequence = row[:, 4] + rank // row[:, 3]
            offset = row[:, 5] + rank % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], schema=schema)

    return numbered.mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    kind: type[Encoder] = ByteEncoder,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    memo: int = MEMO_PIECES,
) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packed(stored(pieces(df, id_column, text_column, tokenizer, kind, end_id, capacity, memo), "pieces"), capacity)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(table(configure(spark), folder, "documents"))
