"""Language-model scores of whole texts: a unigram base and a causal self-attention model.

Words are runs of characters other than ASCII white space, with A-Z in lower case; each text has
one end after its words. The base score takes the counts of all training words. The model reads
the subword ids of the words: attention predicts the class of the next id (see ``attention``), and
the id within its class has its share of the ids of all training texts. What follows a word's
first id, up to the start of the next word, is a mixture (``KNOWN``): the ids that attention
predicts, or one of the words that start so in the training texts, by its count. Rows whose id's
crc32 is divisible by ten are held out of all counts and of what attention is fitted on.

Texts are worked on in blocks with a vocabulary of their own, which end at a number of distinct
words or of words. The blocks' words meet in buckets by their hash, where they are counted, so
neither the words of the corpus nor its texts are ever in one place, and no row is made for a
single word. A block also counts which ids stand side by side. From the counts of all blocks come
the ids that occur at all, their classes (by the ids beside them) and the table of class pairs.
The weights of attention start from a fit on some texts (``SAMPLE``, ``SAMPLE_IDS`` ids of each) and
are then learned from every id of all training texts (``learned``): each block goes on from that start
with all its texts, and the weights are the blocks' mean by their number of ids. Blocks are read as
their files have them, without a shuffle. Texts are scored when their block meets its counts again.

Edge cases: a null or empty text is its end alone; a row without id has the empty text as its id
and so is held out; rows that repeat an id count as often as they occur. Without training rows
all counts are zero and the base is uniform over one token. An empty table gives no rows. Other
columns are not read.
"""

import copy
import math
import zlib
from itertools import chain, repeat
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.attention import CLASSES, INPUTS, Attention, clusters
from noteloom.llm.common import (
    batches_of,
    configure,
    filesystem,
    fresh_path,
    id_remainder,
    in_slices,
    rows_of,
    stored,
    table,
    worker_state,
)
from noteloom.llm.tokens import PUNCTUATION, ByteEncoder, as_ids, encoder

FOLDS = 10
SPACE = "\u0120"  # how byte-level vocabularies write the space that a word starts with
SAMPLE = 3_000  # training texts that the weights of attention start from, by hash of the text
SAMPLE_IDS = 512  # ids of each, from a place that the hash picks
SMOOTH = 0.1
KNOWN = 0.8  # share of the corpus's words in what follows a word's first id
BLOCK_WORDS = 300_000  # distinct words after which a block ends
BLOCK_TOKENS = 1_500_000  # words after which it ends in any case
MEMO = 400_000  # words that a worker remembers beside its block
SKETCH = 24  # cells that the ids on one side of an id are counted in
GROUP_WORDS = 50_000  # words of texts that are worked on at a time
CHARACTERS = 24  # of texts that are cut and looked up together, for each word of a group


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def _texts(words: list[bytes]) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in words]


# --- blocks ---------------------------------------------------------------------------

_ROWS = pa.schema(
    [
        ("block", pa.int64()),
        ("kind", pa.int32()),  # 0: the block's vocabulary, 1: a text, 2: ids side by side where words meet
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("words", pa.binary()),  # vocabulary: its words; text: their places in it; pairs: distinct ids before
        ("counts", pa.binary()),  # in training texts, of each word or pair
        ("sizes", pa.binary()),  # vocabulary: ids of each word; pairs: distinct ids after each id before
        ("ids", pa.binary()),
    ]
)
_ROWS_SQL = "block long, kind int, doc_id long, held_out boolean, words binary, counts binary, sizes binary, ids binary"


class _Words:
    """Subword ids of words by place."""

    def __init__(self, sizes: np.ndarray, ids: np.ndarray):
        self.sizes, self.ids = sizes, ids
        self.first = np.cumsum(sizes) - sizes

    def subwords(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words by place, and how many each has."""
        n = self.sizes[places]
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.first[places] - (ends - n), n) + np.arange(int(n.sum()))], n


class _Growing(_Words):
    """Words that are added to, in arrays with room for more."""

    def __init__(self):
        super().__init__(np.zeros(0, dtype=np.int64), np.zeros(0, dtype="<u4"))
        self.n = self.n_ids = 0

    def add(self, sizes: np.ndarray, ids: np.ndarray) -> None:
        n, n_ids = self.n + len(sizes), self.n_ids + len(ids)
        if n > len(self.sizes):
            self.sizes, self.first = (np.append(v[: self.n], np.zeros(2 * n - self.n, dtype=v.dtype)) for v in (self.sizes, self.first))
        if n_ids > len(self.ids):
            self.ids = np.append(self.ids[: self.n_ids], np.zeros(2 * n_ids - self.n_ids, dtype=self.ids.dtype))
        self.sizes[self.n : n], self.ids[self.n_ids : n_ids] = sizes, ids
        self.first[self.n : n] = self.n_ids + np.cumsum(sizes) - sizes
        self.n, self.n_ids = n, n_ids


class _Memo:
    """Subword ids of the words that a worker has met, in one array; when it is full it becomes the
    older one, from which words met again move on.

    Words are encoded many at a time, as one text. A space starts a new piece after anything that is
    no white space, and no id spans two pieces, so a word's ids begin with one that starts with a space.
    Marks after ASCII letters are cut off them anyway, so a word is put together from both. Words of
    ASCII letters are spelled as the vocabulary does, and cut at their spaces by a plain search.
    """

    def __init__(self, encode: ByteEncoder):
        from tokenizers import Tokenizer, pre_tokenizers

        self.encode = encode
        self.letters = Tokenizer(encode.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.Split(SPACE, "merged_with_next")
        vocabulary = encode.tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.starts[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        self.clear()
        self.older = self.numbers, self.words

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.words = _Growing()

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, one after the other, and how many each has."""
        found = _numbers(self.numbers, words)
        gaps = np.flatnonzero(found < 0)
        if len(gaps) and len(self.numbers) + len(gaps) > MEMO:
            full = self.numbers, self.words
            self.clear()
            self.older = full if len(full[0]) <= MEMO else (self.numbers, self.words)
            gaps = np.arange(len(words))
        if len(gaps):
            asked = [words[i] for i in gaps.tolist()]
            numbers, kept = self.older
            old = _numbers(numbers, asked)
            again, new = np.flatnonzero(old >= 0), np.flatnonzero(old < 0)
            if len(again):
                ids, sizes = kept.subwords(old[again])
                found[gaps[again]] = self._add([asked[i] for i in again.tolist()])
                self.words.add(sizes, ids)
            if len(new):
                found[gaps[new]] = self._learn([asked[i] for i in new.tolist()] if len(again) else asked)
        return self.words.subwords(found)

    def _add(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words that had none."""
        known = len(self.numbers)
        self.numbers.update(zip(words, range(known, known + len(words)), strict=True))
        return np.arange(known, known + len(words))

    def _learn(self, new: list[bytes]) -> np.ndarray:
        """Numbers of new words."""
        words = pa.array(new, pa.large_binary()).view(pa.large_string())
        core = pc.ascii_rtrim(words, PUNCTUATION)
        letters, ends = pc.ascii_is_alpha(words), pc.ascii_is_alpha(core)
        marked = pc.and_not(ends, letters)
        numbers = np.empty(len(new), dtype=np.int64)
        lists = []
        for kind in (letters, pc.invert(ends)):
            at = np.flatnonzero(kind)
            lists.append([new[i] for i in at.tolist()])
            numbers[at] = self._add(lists[-1])
        cores, of_core, fresh = self._parts(core.filter(marked))
        # No word holds a space, so one before its marks tells them from words.
        tails, of_tail, rest = self._parts(pc.ascii_ltrim(words.filter(marked), ascii_letters), b" ")
        each = [self.encode.plain(tail[1:].decode()) for tail in rest]
        for sizes, ids in chain(self._spaced(lists[0], True), self._spaced(lists[1]), self._spaced(fresh, True), [_sized(each)]):
            self.words.add(sizes, ids)
        at = np.flatnonzero(marked)
        numbers[at] = self._add([new[i] for i in at.tolist()])
        ids, sizes = self.words.subwords(np.stack((cores[of_core], tails[of_tail]), axis=1).reshape(-1))
        self.words.add(sizes.reshape(-1, 2).sum(axis=1), ids)
        return numbers

    def _parts(self, words: pa.Array, before: bytes = b"") -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Numbers of the different ones of words, which of them each word is, and those that had no number."""
        coded = words.dictionary_encode()
        each = [before + word for word in coded.dictionary.view(pa.large_binary()).to_pylist()]
        numbers = _numbers(self.numbers, each)
        fresh = np.flatnonzero(numbers < 0)
        new = [each[i] for i in fresh.tolist()]
        numbers[fresh] = self._add(new)
        return numbers, coded.indices.to_numpy(), new

    def _spaced(self, listed: list[bytes], letters: bool = False):
        """How many ids each word has with a space before it, and these, for some words at a time."""
        parts = [listed[i : i + 512] for i in range(0, len(listed), 512)]
        texts = [b" ".join(words).decode("utf-8", "surrogatepass") for words in parts]
        if letters:
            encoded = self.letters.encode_batch_fast([SPACE + text.replace(" ", SPACE) for text in texts], add_special_tokens=False)
        else:
            encoded = self.encode.tokenizer.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)
        for words, text, found in zip(parts, texts, encoded, strict=True):
            ids = np.array(found.ids, dtype="<u4")
            first = np.flatnonzero(self.starts[ids])
            # Beside other white space, spaces are cut in another way.
            plain = len(text.split()) == len(first) == len(words) and first[0] == 0
            yield (np.diff(first, append=len(ids)), ids) if plain else _sized(self.encode.words(_texts(words)))


def _numbers(known: dict[bytes, int], words: list[bytes]) -> np.ndarray:
    """Number of each word, -1 for those without."""
    return np.fromiter(map(known.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def _sized(each: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(e) // 4 for e in each], dtype=np.int64), as_ids(b"".join(each))


class _Block:
    """Vocabulary of a block: words by place, their training counts and their subword ids; and the
    ids that stand side by side where words of its training texts meet."""

    def __init__(self, number: int, memo: _Memo, end: int):
        self.number, self.memo, self.end = number, memo, end
        self.texts = self.tokens = 0
        self.places: dict[bytes, int] = {b"": 0}  # the end of a text
        self.counts = np.zeros(1 << 16, dtype=np.int64)
        self.first, self.last = (np.full(1 << 16, end, dtype=np.int64) for _ in range(2))
        self.sizes, self.ids = [np.ones(1, dtype=np.int64)], [np.array([end], dtype="<u4")]
        self.pairs: list[np.ndarray] = []

    def read(self, texts: list[str]) -> list[np.ndarray]:
        """Places of the words of each text and of its end. Each different word is looked up once."""
        cut = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
        words, ends = cut.flatten().cast(pa.large_binary()), cut.offsets.to_numpy()
        full = pc.binary_length(words).to_numpy() > 0  # white space at an end of a text leaves an empty word
        if not full.all():
            words, ends = words.filter(pa.array(full)), np.append(0, np.cumsum(full))[ends]
        coded = words.dictionary_encode()
        each = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = _numbers(self.places, each)
        new = np.flatnonzero(places < 0)
        if len(new):
            known = len(self.places)
            self.learn([each[i] for i in new.tolist()])
            places[new] = np.arange(known, known + len(new))
        every = places[coded.indices.to_numpy()]
        return [np.append(part, 0) for part in np.split(every, ends[1:-1])] if texts else []

    def learn(self, new: list[bytes]) -> None:
        known = len(self.places)
        self.places.update(zip(new, range(known, known + len(new)), strict=True))
        ids, sizes = self.memo(new)
        self.sizes.append(sizes)
        self.ids.append(ids)
        if len(self.places) > len(self.counts):
            more = np.zeros(len(self.places), dtype=np.int64)
            self.counts, self.first, self.last = (np.append(v, more) for v in (self.counts, self.first, self.last))
        ends = np.cumsum(sizes)
        self.first[known : len(self.places)] = ids[ends - sizes]
        self.last[known : len(self.places)] = ids[ends - 1]

    def count(self, places: np.ndarray, starts: np.ndarray) -> None:
        """Take in training texts, each from one of ``starts`` on."""
        self.counts += np.bincount(places, minlength=len(self.counts))
        before = np.append(0, self.last[places[:-1]])
        before[starts] = self.end + 1
        self.pairs.append(before * (self.end + 2) + self.first[places])

    def rows(self):
        n = len(self.places)
        sizes, ids = np.concatenate(self.sizes), np.concatenate(self.ids)
        counts = self.counts[:n].astype("<u4").tobytes()
        yield self.number, 0, None, None, b" ".join(self.places), counts, sizes.astype("<u4").tobytes(), ids.tobytes()
        if self.pairs:
            pairs, counts = np.unique(np.concatenate(self.pairs), return_counts=True)
            before, after = np.divmod(pairs, self.end + 2)
            before, sizes = np.unique(before, return_counts=True)
            packed = [v.astype("<u4").tobytes() for v in (before, counts, sizes)]
            yield self.number, 2, None, None, *packed, _planes(after)


def blocks(df: DataFrame, id_column: str, text_column: str, path: str, end: int) -> DataFrame:
    """Rows of vocabularies, texts and pairs (``_ROWS``), written once; ``end`` is the id of a text's end."""

    def work(batches):
        memo = worker_state("word-ids", dict).setdefault(path, _Memo(encoder(ByteEncoder, path, memo=MEMO // 4)))
        first = TaskContext.get().partitionId() << 24

        def flush(block, held):
            each = block.read([text for _, _, text in held])
            learned = [places for (_, held_out, _), places in zip(held, each, strict=True) if not held_out]
            if learned:
                block.count(np.concatenate(learned), np.cumsum([0] + [len(p) for p in learned[:-1]]))
            block.texts += len(held)
            block.tokens += sum(map(len, each))
            for (doc_id, held_out, _), places in zip(held, each, strict=True):
                yield block.number, 1, doc_id, held_out, _planes(places), None, None, None

        def rows():
            block, held, weight = _Block(first, memo, end), [], 0
            for doc_id, held_out, text in rows_of(batches, "doc_id", "held_out", "text"):
                held.append((doc_id, held_out, text))
                weight += len(text) + 1
                if weight >= GROUP_WORDS * CHARACTERS:
                    yield from flush(block, held)
                    held, weight = [], 0
                    if len(block.places) >= BLOCK_WORDS or block.tokens >= BLOCK_TOKENS:
                        yield from block.rows()
                        block = _Block(block.number + 1, memo, end)
            if held:
                yield from flush(block, held)
            if block.texts:
                yield from block.rows()

        yield from batches_of(rows(), _ROWS)

    found = _named(df, id_column, text_column).mapInArrow(work, _ROWS_SQL)
    location = fresh_path(df.sparkSession, "lm-blocks")
    # A scan task writes one file, so that no block is in two (``learned``).
    found.write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(location)
    return df.sparkSession.read.schema(found.schema).parquet(location)


def _named(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (id_remainder(id_column, FOLDS) == 0).alias("held_out"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


# --- the model ------------------------------------------------------------------------


def id_counts(rows: DataFrame, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """How often every id stands in all training texts, the end included, and how many of their words
    start with it.

    What comes to the driver is one row for each id of the vocabulary.
    """
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("words", pa.int64())])

    def work(batches):
        every, words = np.zeros(n_ids + 1, dtype=np.int64), np.zeros(n_ids + 1, dtype=np.int64)
        for counts, sizes, ids in rows_of(batches, "counts", "sizes", "ids"):
            n, sizes, ids = np.frombuffer(counts, "<u4"), np.frombuffer(sizes, "<u4"), as_ids(ids)
            every += np.bincount(ids, np.repeat(n, sizes), n_ids + 1).astype(np.int64)
            first = ids[np.cumsum(sizes, dtype=np.int64) - sizes]
            words += np.bincount(first, n, n_ids + 1).astype(np.int64)
        met = np.flatnonzero(every)
        yield from batches_of(zip(met.tolist(), every[met].tolist(), words[met].tolist(), strict=True), schema, size=50_000)

    vocabularies = rows.where("kind = 0").select("counts", "sizes", "ids").coalesce(in_slices(rows))
    sums = vocabularies.mapInArrow(work, "id long, n long, words long").groupBy("id")
    found = sums.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).toPandas()
    n, words = np.zeros(n_ids + 1), np.zeros(n_ids + 1)
    n[found["id"].to_numpy()] = found["n"].to_numpy()
    words[found["id"].to_numpy()] = found["words"].to_numpy()
    return n, words


def _side_by_side(batches):
    """Ids, the ids after them, and how often: within words by the words' counts, and where words meet."""
    for kind, words, counts, sizes, ids in rows_of(batches, "kind", "words", "counts", "sizes", "ids"):
        n, sizes = np.frombuffer(counts, "<u4").astype(np.int64), np.frombuffer(sizes, "<u4").astype(np.int64)
        if kind == 2:
            yield np.repeat(as_ids(words).astype(np.int64), sizes), _from_planes(ids), n
            continue
        ids, n = as_ids(ids).astype(np.int64), np.repeat(n, sizes)
        inner = n > 0
        inner[np.cumsum(sizes) - 1] = False
        at = np.flatnonzero(inner)
        if len(at):
            yield ids[at], ids[at + 1], n[at]


def _pair_rows(rows: DataFrame) -> DataFrame:
    """Vocabularies without their words, and pairs; in as few tasks as a shuffle has."""
    words = F.when(F.col("kind") == 2, F.col("words")).alias("words")
    return rows.where("kind != 1").select("kind", words, "counts", "sizes", "ids").coalesce(in_slices(rows))


def neighbours(rows: DataFrame, n_ids: int, seed: int = 5) -> np.ndarray:
    """For every id, signed counts of the ids after it and before it in all training texts, each
    neighbour in one of ``SKETCH`` cells of its side.

    Tasks sum up arrays of the vocabulary's size; ranges of ids are then summed over tasks. What comes to
    the driver has the size of the vocabulary.
    """
    rng = np.random.default_rng(seed)
    n, width = n_ids + 2, 2 * SKETCH
    cell, sign = rng.integers(0, SKETCH, n), rng.choice(np.array([-1, 1]), n)
    span = -(-n // 64)  # ids of a range
    schema = pa.schema([("range", pa.int32()), ("cells", pa.binary()), ("sums", pa.binary())])

    def work(batches):
        sums = np.zeros(n * width, dtype=np.int64)
        for before, after, count in _side_by_side(batches):
            np.add.at(sums, before * width + cell[after], count * sign[after])
            np.add.at(sums, after * width + SKETCH + cell[before], count * sign[before])
        for low in range(0, len(sums), span * width):
            part = sums[low : low + span * width]
            met = np.flatnonzero(part)
            if len(met):
                values = [(low // (span * width), met.astype("<u4").tobytes(), part[met].astype("<i8").tobytes())]
                yield from batches_of(values, schema)

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for number, cells, values in rows_of(batches, "range", "cells", "sums"):
            whole = sums.setdefault(number, np.zeros(span * width, dtype=np.int64))
            whole[np.frombuffer(cells, "<u4")] += np.frombuffer(values, "<i8")
        yield from batches_of(((k, None, v.tobytes()) for k, v in sums.items()), schema)

    sql = "range int, cells binary, sums binary"
    parts = _pair_rows(rows).mapInArrow(work, sql).repartitionById(min(64, in_slices(rows)), F.col("range"))
    found = np.zeros((64 * span, width), dtype=np.float32)
    for row in parts.mapInArrow(merge, sql).collect():  # 64 ranges at most
        found[row["range"] * span : (row["range"] + 1) * span] = np.frombuffer(row["sums"], np.int64).reshape(-1, width)
    return found[:n]


def class_pairs(rows: DataFrame, classes: np.ndarray) -> np.ndarray:
    """How often an id of one class stands before one of another in all training texts; ``CLASSES``
    squared rows come to the driver."""
    schema = pa.schema([("cell", pa.int64()), ("n", pa.int64())])

    def work(batches):
        sums = np.zeros(CLASSES * CLASSES, dtype=np.int64)
        for before, after, count in _side_by_side(batches):
            sums += np.bincount(classes[before] * CLASSES + classes[after], count, len(sums)).astype(np.int64)
        yield from batches_of(enumerate(sums.tolist()), schema)

    found = _pair_rows(rows).mapInArrow(work, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    pairs = np.zeros(CLASSES * CLASSES)
    pairs[found["cell"].to_numpy()] = found["n"].to_numpy()
    return pairs.reshape(CLASSES, CLASSES)


def sampled(df: DataFrame, id_column: str, text_column: str, path: str, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a bounded sample of training texts, and where each text starts."""
    named = _named(df, id_column, text_column).where("not held_out")
    total = named.count()
    chosen = F.xxhash64("text")
    if total > SAMPLE:
        named = named.where(F.pmod(chosen, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * SAMPLE / total)))
    schema = pa.schema([("pick", pa.int64()), ("ids", pa.binary())])

    def work(batches):
        encode = encoder(ByteEncoder, path)

        def rows():
            for pick, text in rows_of(batches, "pick", "text"):
                ids = b"".join(encode.words(_texts(words_of(text))))
                spare = max(0, len(ids) // 4 - SAMPLE_IDS + 1)
                first = pick % (spare + 1) if spare else 0
                yield pick, (as_ids(ids).tolist() + [n_ids])[first : first + SAMPLE_IDS]

        yield from batches_of(((p, np.array(i, dtype="<u4").tobytes()) for p, i in rows()), schema)

    picked = named.select(chosen.alias("pick"), "text").mapInArrow(work, "pick long, ids binary")
    kept = picked.orderBy("pick", "ids").limit(SAMPLE).toPandas()
    texts = [as_ids(bytes(b)).astype(np.int64) for b in kept["ids"]] or [np.array([n_ids])]
    return np.concatenate(texts), np.cumsum([0] + [len(t) for t in texts[:-1]])


def fit(rows: DataFrame, counts: np.ndarray, sample: tuple[np.ndarray, np.ndarray], starts_of_words) -> Attention:
    """Attention over classes made from all training texts; its weights start from the sample and are
    learned from all training texts.

    Classes are groups of ids inside words, ids that no training text has, then the same of ids that
    start a word, the end of a text, and what stands before one.
    """
    n_ids = len(counts) - 1
    by_count = np.argsort(-counts[:n_ids], kind="stable")
    seen = by_count[: int((counts[:n_ids] > 0).sum())]
    starting = np.zeros(n_ids, dtype=bool)
    starting[list(starts_of_words)] = True
    groups = (CLASSES - 4) // 2
    classes = np.where(starting, CLASSES - 3, groups)
    classes = np.append(classes, [CLASSES - 2, CLASSES - 1])
    beside = neighbours(rows, n_ids)
    for first, side in ((0, seen[~starting[seen]]), (groups + 1, seen[starting[seen]])):
        if len(side):
            classes[side] = first + clusters(beside[side], counts[side], groups)
    own = min(INPUTS, len(seen))
    inputs = own + classes
    inputs[seen[:own]] = np.arange(own)
    model = Attention(inputs, classes, CLASSES, first_start=groups + 1)
    model.fit(*sample, class_pairs(rows, classes))
    learned(rows, model)
    return model


def _whole_blocks(files):
    """Vocabulary and training texts (places of their words) of each block in files of ``blocks``."""
    columns = ["block", "kind", "held_out", "words", "sizes", "ids"]
    for path in files:
        system, place = filesystem(path)
        with system.open_input_file(place) as file:
            held, block = [], None
            batches = pq.ParquetFile(file).iter_batches(batch_size=256, columns=columns)
            for number, kind, held_out, places, sizes, ids in rows_of(batches, *columns):
                if held and number != block:
                    raise ValueError(f"block {block} without its vocabulary")
                if kind == 1 and not held_out:
                    held.append(places)
                    block = number
                elif kind == 0:
                    yield number, _Words(np.frombuffer(sizes, "<u4").astype(np.int64), as_ids(ids).astype(np.int64)), held
                    held = []
            if held:
                raise ValueError(f"block {block} without its vocabulary")


def _groups_of(words: _Words, held: list[bytes]):
    """Ids of texts and where each starts, some texts at a time."""
    each, weight = [], 0
    for i, places in enumerate(held):
        each.append(_from_planes(places))
        weight += len(each[-1])
        if weight >= GROUP_WORDS or i == len(held) - 1:
            n = np.array([len(e) for e in each])
            ids, sizes = words.subwords(np.concatenate(each))
            yield ids, (np.cumsum(sizes) - sizes)[np.cumsum(n) - n]
            each, weight = [], 0


def learned(rows: DataFrame, model: Attention) -> int:
    """Learn the weights from every id of all training texts, and return how many there were.

    Each block starts from the model as it is; the weights become the mean of the blocks', by their
    numbers of ids. ``rows`` are read file by file, as ``blocks`` wrote them: a block's texts, then its
    vocabulary. Tasks sum up weights, ranges of these are then summed over tasks, and what comes to the
    driver has the size of the model.
    """
    names = [k for k in model.weights if k != "table"]
    size = sum(model.weights[k].size for k in names)
    span = -(-size // 16)  # weights of a range
    schema = pa.schema([("range", pa.int32()), ("n", pa.int64()), ("sums", pa.binary())])
    sql = "range int, n long, sums binary"
    spark = rows.sparkSession

    def work(batches):
        sums, n = np.zeros(16 * span), 0
        for block, words, held in _whole_blocks(path for (path,) in rows_of(batches, "path")):
            if held:
                own = copy.copy(model)
                own.weights = {k: v.copy() for k, v in model.weights.items()}
                total = sum(int(words.sizes[_from_planes(places)].sum()) for places in held)
                done = own.learn(_groups_of(words, held), total, seed=block)
                sums[:size] += done * np.concatenate([own.weights[k].ravel() for k in names])
                n += done
        if n:
            parts = sums.reshape(16, span)
            yield from batches_of(((i, n, part.astype("<f8").tobytes()) for i, part in enumerate(parts)), schema)

    def merge(batches):
        found: dict[int, list] = {}
        for number, n, sums in rows_of(batches, "range", "n", "sums"):
            held = found.setdefault(number, [0, np.zeros(span)])
            held[0] += n
            held[1] += np.frombuffer(sums, "<f8")
        yield from batches_of(((i, n, sums.tobytes()) for i, (n, sums) in found.items()), schema)

    files = sorted(rows.inputFiles())
    if not files:
        return 0
    listed = spark.createDataFrame([(i, path) for i, path in enumerate(files)], "i int, path string")
    # A task has one file: all that one scan task wrote.
    dealt = listed.repartitionById(len(files), F.col("i")).select("path").mapInArrow(work, sql)
    sums, n = np.zeros((16, span)), 0
    for row in dealt.repartitionById(16, F.col("range")).mapInArrow(merge, sql).collect():  # 16 ranges
        sums[row["range"]], n = np.frombuffer(row["sums"], "<f8"), row["n"]
    if n:
        mean = np.split(sums.ravel()[:size] / n, np.cumsum([model.weights[k].size for k in names])[:-1])
        for k, values in zip(names, mean, strict=True):
            model.weights[k] = values.reshape(model.weights[k].shape).astype(np.float32)
    return n


def log_shares(counts: np.ndarray, model: Attention) -> np.ndarray:
    """Natural log of every id's share of its class, by its count in all training texts."""
    classes = model.classes[: len(counts)]
    smooth = counts + SMOOTH
    return np.log(smooth / np.bincount(classes, smooth, CLASSES)[classes])


# --- scores ---------------------------------------------------------------------------

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)
_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


_SPREAD = pa.schema(
    [
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("words", pa.binary()),
        ("places", pa.binary()),
        ("counts", pa.binary()),
    ]
)
_COUNTED = pa.schema(
    [
        ("block", pa.int64()),  # null: a bucket's sums
        ("places", pa.binary()),
        ("counts", pa.binary()),
        ("n", pa.int64()),
        ("v", pa.int64()),
    ]
)


def word_counts(rows: DataFrame) -> DataFrame:
    """For each block and bucket of words, places and corpus counts of the block's words in it; and
    for each bucket one row with the number of training words and of distinct ones.

    A word's bucket follows from its crc32. A bucket holds a share of the words of every block,
    so its size follows from the number of buckets, whatever words are frequent. That number grows
    with the number of blocks.
    """
    slices = max(in_slices(rows), rows.where("kind = 0").count() // 8)
    buckets = 4 * slices

    def spread(batches):
        def parts():
            for block, words, counts in rows_of(batches, "block", "words", "counts"):
                listed, n = _split([words]).flatten(), np.frombuffer(counts, "<u4")
                crc = map(zlib.crc32, listed.to_numpy(zero_copy_only=False))
                bucket = np.fromiter(crc, dtype=np.int64, count=len(listed)) % buckets
                order = np.argsort(bucket, kind="stable")
                cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
                sent = pa.LargeListArray.from_arrays(cuts, listed.take(pa.array(order)))
                sent = pc.binary_join(sent, pa.scalar(b" ", pa.large_binary()))
                for part, low, high in zip(sent.to_pylist(), cuts.tolist(), cuts[1:].tolist(), strict=False):
                    places = order[low:high]
                    yield int(bucket[places[0]]), block, part, places.astype("<u4").tobytes(), n[places].tobytes()

        yield from batches_of(parts(), _SPREAD)

    def merged(held):
        listed = _split([words for _, words, _, _ in held])
        coded, ends = listed.flatten().dictionary_encode(), listed.offsets.to_numpy()
        word = coded.indices.to_numpy()
        total = np.zeros(len(coded.dictionary), dtype=np.int64)
        np.add.at(total, word, np.concatenate([np.frombuffer(counts, "<u4") for *_, counts in held]).astype(np.int64))
        for (block, _, places, _), low, high in zip(held, ends.tolist(), ends[1:].tolist(), strict=False):
            yield block, places, total[word[low:high]].astype("<i8").tobytes(), None, None
        yield None, None, None, int(total.sum()), int((total > 0).sum())

    def count(batches):
        def found():
            held, now = [], None
            for bucket, *row in rows_of(batches, "bucket", "block", "words", "places", "counts"):
                if held and bucket != now:
                    yield from merged(held)
                    held = []
                now = bucket
                held.append(row)
            if held:
                yield from merged(held)

        yield from batches_of(found(), _COUNTED)

    vocabularies = rows.where("kind = 0").select("block", "words", "counts")
    sent = vocabularies.mapInArrow(spread, "bucket int, block long, words binary, places binary, counts binary")
    together = sent.repartitionById(slices, F.expr("bucket div 4").cast("int")).sortWithinPartitions("bucket")
    return stored(together.mapInArrow(count, "block long, places binary, counts binary, n long, v long"), "word-counts")


def _split(joined: list[bytes]) -> pa.ListArray:
    """Words of lists that were joined by spaces."""
    return pc.split_pattern(pa.array(joined, pa.large_binary()), b" ")


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as their lower halves, then their upper halves, which compress well."""
    return (values & 0xFFFF).astype("<u2").tobytes() + (values >> 16).astype("<u2").tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(data, "<u2").reshape(2, -1).astype(np.int64)
    return low | high << 16


class _Scorer:
    """Scores of texts of one block, whose words have these training counts."""

    def __init__(self, words: _Words, count: np.ndarray, model: Attention, shares: np.ndarray, starting: np.ndarray):
        self.words, self.model = words, model
        sums = np.concatenate(([0.0], np.cumsum(shares[words.ids])))
        starts = words.ids[words.first]
        self.heads = shares[starts]
        self.tails = sums[words.first + words.sizes] - sums[words.first] - self.heads
        whole = KNOWN * count / np.maximum(starting[starts], 1)
        whole[0] = KNOWN  # the end is complete
        with np.errstate(divide="ignore"):
            self.whole = np.log(whole)

    def __call__(self, each: list[np.ndarray]) -> np.ndarray:
        """Log10 probabilities of texts, given as places of their words and of the end."""
        every = np.concatenate(each)
        n = np.array([len(e) for e in each])
        text = np.cumsum(n) - n  # the first word of each
        ids, sizes = self.words.subwords(every)
        first = np.cumsum(sizes) - sizes
        of_class, of_start = self.model.log_chances(ids.astype(np.int64), first[text])
        # The start of a word ends the one before it; the first one of a text counts by itself.
        heads = of_class[first].astype(np.float64) - of_start[first]
        heads[text] += of_start[first[text]]
        rests = np.add.reduceat(of_class, first, dtype=np.float64) - of_class[first]
        rests[:-1] += of_start[first[1:]]
        rests[text + n - 1] = 0  # nothing follows an end
        follows = np.logaddexp(math.log(1 - KNOWN) + rests + self.tails[every], self.whole[every])
        return np.add.reduceat(heads + self.heads[every] + follows, text) / math.log(10)


def slots(rows: DataFrame) -> tuple[int, Column]:
    """A number of tasks, at least half that of blocks, and the one that a block goes to.

    The first blocks of all scan tasks are dealt out in turn, then the second ones. The number has no
    divisor in common with that of scan tasks, so many blocks of one of these spread over all.
    """
    found = rows.where("kind = 0").agg(F.count("*"), F.max(F.shiftright("block", 24))).first()
    scans = (found[1] or 0) + 1
    number = max(in_slices(rows), found[0] // 2)
    while math.gcd(number, scans) > 1:
        number += 1
    turn = F.shiftright("block", 24) + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)) * scans
    return number, F.pmod(turn, F.lit(number)).cast("int")


def scored(rows: DataFrame, model: Attention, counted: DataFrame, shares: np.ndarray, starting: np.ndarray) -> DataFrame:
    """Scores of all texts; ``starting`` is how many training words start with an id.

    Blocks are dealt out to tasks evenly (``slots``).
    """
    n_train, n_words = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    below = math.log10(n_train + SMOOTH * (n_words + 1))

    def work(batches):
        def flush(held, known, base, score):
            values = score([at for _, _, at in held])
            for (doc_id, held_out, at), value in zip(held, values.tolist(), strict=True):
                yield doc_id, held_out, len(at), int(known[at].sum()), n_train, float(base[at].sum()), value

        def found():
            block, tools, held, weight = None, (), [], 0
            parts: list[tuple[bytes, bytes]] = []
            columns = ("block", "kind", "doc_id", "held_out", "words", "counts", "sizes", "ids")
            for number, kind, doc_id, held_out, places, counts, sizes, ids in rows_of(batches, *columns):
                if held and (kind != 1 or weight >= GROUP_WORDS):
                    yield from flush(held, *tools)
                    held, weight = [], 0
                if kind == -1:
                    if number != block:
                        block, parts = number, []
                    parts.append((places, counts))
                    continue
                if number != block:
                    raise ValueError(f"block {number} without counts")
                if kind == 0:
                    words = _Words(np.frombuffer(sizes, "<u4").astype(np.int64), as_ids(ids))
                    count = np.zeros(len(words.sizes), dtype=np.int64)
                    for at, n in parts:
                        count[np.frombuffer(at, "<u4")] = np.frombuffer(n, "<i8")
                    parts = []
                    tools = count > 0, np.log10(count + SMOOTH) - below, _Scorer(words, count, model, shares, starting)
                    continue
                held.append((doc_id, held_out, _from_planes(places)))
                weight += len(held[-1][2])
            if held:
                yield from flush(held, *tools)

        yield from batches_of(found(), _SCORES, size=10_000)

    # Vocabularies go without their words and training counts, which are in the corpus's counts.
    of_text = lambda c: F.when(F.col("kind") == 1, F.col(c)).alias(c)
    texts = rows.where("kind != 2")
    texts = texts.select("block", "kind", "doc_id", "held_out", of_text("words"), of_text("counts"), "sizes", "ids")
    null = lambda c: F.lit(None).cast(rows.schema[c].dataType).alias(c)
    counts = counted.where("block is not null").select(
        "block", F.lit(-1).alias("kind"), null("doc_id"), null("held_out"),
        F.col("places").alias("words"), "counts", null("sizes"), null("ids"),
    )
    slices, slot = slots(rows)
    together = counts.union(texts).repartitionById(slices, slot).sortWithinPartitions("block", "kind")
    return together.mapInArrow(work, SCORES)


def score(df: DataFrame, id_column: str, text_column: str, path: str) -> DataFrame:
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(path).get_vocab()
    n_ids = len(vocabulary)
    starts = [i for token, i in vocabulary.items() if token.startswith(SPACE)]
    rows = blocks(df, id_column, text_column, path, end=n_ids)
    counts, starting = id_counts(rows, n_ids)
    model = fit(rows, counts, sampled(df, id_column, text_column, path, n_ids), starts)
    return scored(rows, model, word_counts(rows), log_shares(counts, model), starting)


def op6_lm(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Base and model score of every document."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return score(table(configure(spark), folder, "documents"), "doc_id", "text", tokenizer)
