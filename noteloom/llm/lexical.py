"""Ranked lexical search over bit-sliced Bloom signatures.

Every document has a Bloom signature of its terms; a term that occurs twice or more, or four times or
more, has bits of its own for that (``LEVELS``). Documents of like length lie side by side in blocks, and
a block keeps its signatures as slices: one bitmap over its documents for each bit. Conjoining the slices
of a term gives the documents that may hold it, never fewer than do. The sum of a query's term weights
over these bitmaps, level by level, times what a term can bring at most in a document of that length,
is an upper bound of the score. Documents are rescored exactly, from the terms that the block keeps, if
their bound reaches the lowest score among the best found so far; in the order of their bounds, so
that a block raises that score early. All others are proven not to belong to the best.

The index is a table of blocks and serves any queries. Each task returns its best documents of each
query, at most ``TOP`` of them, and Spark takes the best of all. Queries go out ``ITEMS`` at a time,
in blocks against all rows; their terms and weights are what a task is sent.

The score is that of the terms' frequencies against the length of the document (``length_part``), in
whole numbers: w * ((10**9 * tf) div (1000 * tf + 8 * m)) summed over the query's terms, repeats
included, with m = 25 + (75 * n * N) div L and w = floor(1000 * ln((2N + 2) / (2 df + 1))).

Edge cases: null texts and texts without terms are not counted and never found. Rows that repeat an
id are documents of their own and may both be among the best; a null id is found like any other and
comes last among equal scores. A query without terms, or whose terms occur nowhere, has no rows; a
repeated query id is a query of its own for each row. Very long texts are in blocks of few documents. An
empty table, of documents or of queries, gives no rows. Other columns are not read.
"""

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, rows_of, stored, table

# Letters and digits of ASCII, and everything beyond ASCII.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TOP = 10
ITEMS = 1000
LEVELS = (1, 2, 4)  # occurrences that have bits of their own
HASHES = 3
BITS_A_TERM = 12
LEAST_TERMS, CLASS_STEP = 16, 4  # distinct terms of the shortest class; each next one has so many times more
CELLS = 12_000_000  # bits of a block's signatures
DOCUMENTS = 2048  # of a block at most
FIRST = 64  # documents of a block that are rescored before the others are compared with what these bring


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.encode().lower().decode())  # bytes: A-Z alone are lower-cased


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the smallest unsigned type that holds them."""
    most = int(values.max()) if len(values) else 0
    kind = "<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8"
    return values.astype(kind).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, dtype=np.int64)


def bit_rows(terms: Iterable[str], bits: int) -> np.ndarray:
    """The slices of each term: one row a term, for each level HASHES of them."""
    hashes = np.array([xxhash.xxh64_intdigest(t.encode()) for t in terms], dtype=np.uint64)
    first, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    places = np.arange(len(LEVELS) * HASHES, dtype=np.uint64)
    found = (first[:, None] + places[None, :] * step[:, None]) % np.uint64(bits)
    return found.astype(np.int64).reshape(-1, len(LEVELS), HASHES)


class _Building:
    """Documents of one class of length, until they make a block."""

    def __init__(self, longest: int):
        self.bits = longest * BITS_A_TERM
        self.room = max(8, min(DOCUMENTS, CELLS // self.bits) // 8 * 8)
        self.clear()

    def clear(self) -> None:
        self.vocabulary: dict[str, int] = {}
        self.ids, self.lengths, self.sizes = [], [], []
        self.terms, self.counts = [], []

    def add(self, doc: int | None, length: int, counted: Counter) -> None:
        numbers = self.vocabulary
        self.terms.append(np.array([numbers.setdefault(t, len(numbers)) for t in counted], dtype=np.uint32))
        self.counts.append(np.array(list(counted.values()), dtype=np.uint32))
        self.ids.append(doc)
        self.lengths.append(length)
        self.sizes.append(len(counted))

    def block(self) -> tuple:
        terms, counts = (np.concatenate(x).astype(np.int64) for x in (self.terms, self.counts))
        document = np.repeat(np.arange(len(self.ids)), self.sizes)
        rows = bit_rows(self.vocabulary, self.bits)
        width = -(-len(self.ids) // 8) * 8
        signatures = np.zeros((self.bits, width), dtype=bool)
        for level, least in enumerate(LEVELS):
            held = counts >= least
            for k in range(HASHES):
                signatures[rows[terms[held], level, k], document[held]] = True
        found = (
            self.bits, len(self.ids), sum(self.lengths), self.ids, _packed(np.array(self.lengths)),
            np.packbits(signatures, axis=1).tobytes(), _packed(np.array(self.sizes)), _packed(terms), _packed(counts),
            "\n".join(self.vocabulary),
        )
        self.clear()
        return found


INDEX = (
    "bits int, n_docs long, n_terms long, ids array<long>, lengths binary, slices binary, "
    "sizes binary, terms binary, counts binary, vocabulary string"
)
_INDEX_ARROW = pa.schema(
    [
        ("bits", pa.int32()), ("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()), ("slices", pa.binary()), ("sizes", pa.binary()), ("terms", pa.binary()),
        ("counts", pa.binary()), ("vocabulary", pa.string()),
    ]
)


def build_index(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Blocks of all documents that have terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[tuple]:
            classes: dict[int, _Building] = {}
            for doc, text in rows_of(batches, "doc_id", "text"):
                terms = terms_of(text)
                if not terms:
                    continue
                counted = Counter(terms)
                longest = LEAST_TERMS
                while longest < len(counted):
                    longest *= CLASS_STEP
                building = classes.setdefault(longest, None) or _Building(longest)
                classes[longest] = building
                building.add(doc, len(terms), counted)
                if len(building.ids) == building.room:
                    yield building.block()
            for building in classes.values():
                if building.ids:
                    yield building.block()

        yield from batches_of(blocks(), _INDEX_ARROW, 1)

    narrow = df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    return narrow.mapInArrow(run, INDEX)


@dataclass(frozen=True)
class Queries:
    """Some queries: for each its key and id, and which of ``terms`` it has how often."""

    keys: list[int]
    ids: list[int | None]
    terms: list[str]
    held: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: Iterable[tuple[int, int | None, str | None]]) -> "Queries":
        numbers: dict[str, int] = {}
        keys, ids, held = [], [], []
        for key, item, text in rows:
            counted = Counter(terms_of(text or ""))
            keys.append(key)
            ids.append(item)
            places = np.array([numbers.setdefault(t, len(numbers)) for t in counted], dtype=np.int64)
            held.append((places, np.array(list(counted.values()), dtype=np.int64)))
        return cls(keys, ids, list(numbers), held)


def documents_with(index: DataFrame, terms: list[str]) -> dict[int, int]:
    """Number of documents that hold each of the terms, which are given by their places."""
    wanted = {t: i for i, t in enumerate(terms)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(wanted), dtype=np.int64)
        for n, sizes, held, vocabulary in rows_of(batches, "n_docs", "sizes", "terms", "vocabulary"):
            vocabulary = vocabulary.split("\n")
            counts = np.bincount(_unpacked(held, int(_unpacked(sizes, n).sum())), minlength=len(vocabulary))
            for i, term in enumerate(vocabulary):
                if term in wanted:
                    found[wanted[term]] += counts[i]
        places = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(found[places])], names=["term", "n"])

    columns = index.select("n_docs", "sizes", "terms", "vocabulary")
    sums = columns.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in sums.collect()}  # at most one row for each term of the queries


def length_part(lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m: 100 for a document of average length."""
    return 25 + (75 * lengths * documents) // terms


def _brought(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term of weight one brings that occurs so often; more for more occurrences."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Search:
    """The best documents of some queries among the blocks of a task."""

    def __init__(self, queries: Queries, weights: np.ndarray, documents: int, terms: int, top: int):
        self.queries, self.documents, self.terms, self.top = queries, documents, terms, top
        self.place = {t: i for i, t in enumerate(queries.terms)}
        # Terms that occur nowhere or weigh nothing bring nothing.
        self.wanted = []
        for places, times in queries.held:
            useful = weights[places] > 0
            self.wanted.append((places[useful], weights[places[useful]] * times[useful]))
        self.best: list[list[tuple]] = [[] for _ in queries.keys]
        self.least = [1] * len(queries.keys)
        self.rows: dict[int, np.ndarray] = {}
        self.compared = self.rescored = 0

    def _rows(self, bits: int) -> np.ndarray:
        if bits not in self.rows:
            self.rows[bits] = bit_rows(self.queries.terms, bits)
        return self.rows[bits]

    def block(self, bits, ids, lengths, slices, sizes, terms, counts, vocabulary) -> None:
        n = len(ids)
        lengths = _unpacked(lengths, n)
        m = length_part(lengths, self.documents, self.terms)
        slices = np.frombuffer(slices, dtype=np.uint8).reshape(bits, -1)
        rows = self._rows(bits)
        levels = []
        for level in range(len(LEVELS)):
            conjoined = slices[rows[:, level, 0]]
            for k in range(1, HASHES):
                conjoined = conjoined & slices[rows[:, level, k]]
            levels.append(np.unpackbits(conjoined, axis=1)[:, :n])
        any_of = [x.any(axis=1) for x in levels]
        # A term without the bits of the next level occurs at most once less often than that asks for.
        most = [_brought(np.minimum(lengths, least - 1), m) for least in LEVELS[1:]] + [_brought(lengths, m)]
        steps = [most[0], *[b - a for a, b in zip(most, most[1:], strict=False)]]
        exact: np.ndarray | None = None
        for q, (places, weights) in enumerate(self.wanted):
            bound = np.zeros(n)
            for held, some, step in zip(levels, any_of, steps, strict=True):
                there = some[places]
                if there.any():
                    bound += (weights[there].astype(float) @ held[places[there]].astype(float)) * step
            self.compared += n
            candidates = np.flatnonzero(bound >= self.least[q])
            if not len(candidates):
                continue
            if exact is None:
                exact = self._frequencies(n, sizes, terms, counts, vocabulary)
            if len(candidates) > FIRST:
                order = np.argpartition(-bound[candidates], FIRST)
                self._rescore(q, candidates[order[:FIRST]], exact, m, ids)
                rest = candidates[order[FIRST:]]
                candidates = rest[bound[rest] >= self.least[q]]
            if len(candidates):
                self._rescore(q, candidates, exact, m, ids)

    def _frequencies(self, n: int, sizes: bytes, terms: bytes, counts: bytes, vocabulary: str) -> np.ndarray:
        """Occurrences of the queries' terms (rows) in the block's documents."""
        place = np.array([self.place.get(t, -1) for t in vocabulary.split("\n")], dtype=np.int64)
        sizes = _unpacked(sizes, n)
        total = int(sizes.sum())
        row = place[_unpacked(terms, total)]
        known = row >= 0
        found = np.zeros((len(self.place), n), dtype=np.int64)
        found[row[known], np.repeat(np.arange(n), sizes)[known]] = _unpacked(counts, total)[known]
        return found

    def _rescore(self, q: int, candidates: np.ndarray, exact: np.ndarray, m: np.ndarray, ids: list) -> None:
        places, weights = self.wanted[q]
        self.rescored += len(candidates)
        tf = exact[places[:, None], candidates[None, :]]
        scores = (weights[:, None] * _brought(tf, m[candidates][None, :])).sum(axis=0)
        good = np.flatnonzero(scores >= self.least[q])
        if not len(good):
            return
        found = [(-int(scores[i]), ids[c] is None, ids[c] or 0) for i, c in zip(good, candidates[good], strict=True)]
        best = nsmallest(self.top, self.best[q] + found)
        self.best[q] = best
        if len(best) == self.top:
            self.least[q] = max(1, -best[-1][0])

    def rows_found(self) -> Iterator[tuple]:
        for key, item, best in zip(self.queries.keys, self.queries.ids, self.best, strict=True):
            for score, no_id, doc in best:
                yield key, item, None if no_id else doc, -score


FOUND = "query long, item_id long, doc_id long, score long"
_FOUND_ARROW = pa.schema([("query", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_READ = ("bits", "ids", "lengths", "slices", "sizes", "terms", "counts", "vocabulary")


def weight(documents: int, df: int) -> int:
    """What a term weighs that so many of the documents hold; 0 if none does."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) if df else 0


def _best(index: DataFrame, queries: Queries, documents: int, terms: int, top: int) -> DataFrame:
    held = documents_with(index, queries.terms)
    weights = np.array([weight(documents, held.get(i, 0)) for i in range(len(queries.terms))], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Search(queries, weights, documents, terms, top)
        for batch in batches:
            # One block at a time: a batch of several would be held twice.
            for i in range(batch.num_rows):
                found.block(*[batch.column(batch.schema.get_field_index(c))[i].as_py() for c in _READ])
        yield from batches_of(found.rows_found(), _FOUND_ARROW)

    return index.select(*_READ).mapInArrow(run, FOUND)


def _in_parts(queries: DataFrame) -> Iterator[Queries]:
    held = []
    for n, row in enumerate(queries.toLocalIterator()):
        held.append((n, row["item_id"], row["text"]))
        if len(held) == ITEMS:
            yield Queries.of(held)
            held = []
    if held:
        yield Queries.of(held)


def search(
    index: DataFrame, queries: DataFrame, id_column: str = "item_id", text_column: str = "text", top: int = TOP
) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of each query; ``index`` is a stored one."""
    documents, terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    found = index.sparkSession.createDataFrame([], FOUND)
    if documents:
        narrow = queries.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
        for part in _in_parts(narrow):
            found = found.unionByName(_best(index, part, documents, terms, top))
    of_query = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = stored(build_index(table(configure(spark), folder, "documents")), "signatures")
    return search(index, table(spark, folder, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
lengths AS MATERIALIZED (SELECT row, doc_id, len(terms)::BIGINT AS n FROM words WHERE len(terms) > 0),
corpus AS MATERIALIZED (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
items AS (
  SELECT row_number() OVER () AS query, item_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
wanted AS MATERIALIZED (SELECT query, item_id, term, count(*) AS times FROM items GROUP BY ALL),
held AS MATERIALIZED (
  SELECT row, term, count(*)::BIGINT AS tf FROM (SELECT row, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus),
scored AS (
  SELECT query, item_id, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // corpus.terms))))::BIGINT AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN lengths USING (row), corpus
  GROUP BY query, item_id, row, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
