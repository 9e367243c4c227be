"""Alignment of the tokens of two tokenizers over the bytes of a text.

Tokenizer A is byte-level, tokenizer B works on pieces and puts a space before a text; so a space
and the text go through A, and the text through B. Every token covers a range of bytes. A text's
tokens of A and its bytes make an incidence matrix, and so do those of B; the product of the one
and the other transposed (``csr.product``, row by row) has an entry for each pair of tokens that
share bytes: the overlap links, with the number of bytes shared. Byte offsets where tokens of both
end cut the tokens into groups; the product of the token-group matrices has the pairs within a group.

Neither tokenizer has a token across the place before a space or line break that stands between two
characters that are no white space, nor between letters and the marks after them. There texts are cut
into units, and the products are taken over the units that a worker does not remember, many at a time
as one block-diagonal matrix; ``Aligner`` checks that the vocabularies allow it, and takes whole texts
as units if they do not. A unit whose tokens do not spell it has its text aligned as a whole.

Corpus-wide counts (documents that hold a pair of ids linked) cover all documents. Documents are
read in blocks by the tasks that scan them; a block brings its distinct pairs with the number of its
documents that hold each, and each document its places in that list. The pairs of all blocks are
summed up by Spark, and come back to the blocks by a join on the pair and one on the block. A pair
that every block holds has one row a block, so no key grows with the documents.

Edge cases: null, empty and unspellable texts (such as those that contain U+2581) have no tokens:
zeros and an empty digest. Rows that repeat an id are documents of their own, and so are those with
a null id. Very long texts are one block each. An empty table gives no rows. Other columns are not read.
"""

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, rows_of, stored, table, worker_state
from noteloom.llm.csr import incidence, memberships, product
from noteloom.llm.tokens import PUNCTUATION, in_groups

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK = 2_000_000  # characters of the texts of a block
MEMO_UNITS, MEMO_LENGTH = 400_000, 64  # units that a worker remembers, and their longest
JOINED = 50_000  # characters of units that are tokenized together
SHIFT = 32  # a pair of ids is one number: that of A above, that of B below
SPACE = "▁"

_OTHER_SPACE = re.compile(r"[^\S \n]")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def tokenizer_file(name: str) -> str:
    """A public tokenizer's file; the folder that holds them is on the module path of the machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for
    themselves, the others in turn for those from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    found = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return found | {chr(256 + n): b for n, b in enumerate(rest)}


class Aligner:
    """Units of texts with their tokens of both kinds, groups and links."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_of_letter()
        special = set(self.a.get_added_tokens_decoder())
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = token.encode() if i in special else bytes(letters[c] for c in token)
        self.b_bytes = []
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        for i, piece in enumerate(pieces):
            byte = self.b.is_byte(i)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if byte else piece.replace(SPACE, " ").encode())
        # No piece has a space after another character, a line break, or a mark after a letter.
        self.cuts = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in pieces)
        after = {y for p in pieces for x, y in zip(p, p[1:], strict=False) if x.isalpha()}
        self.marks = "".join(c for c in PUNCTUATION if c not in after)
        self.lone = self.b.piece_to_id(SPACE)
        self.a_size, self.b_size = (np.array([len(x) for x in t], dtype=np.int64) for t in (self.a_bytes, self.b_bytes))
        # How ids are written: of A first, after another one, after a group; of B first and after another one.
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.written = [before + str(i) for before in ("", ",", ";") for i in range(n)]
        self.written += [before + str(i) for before in ("|", ",") for i in range(m)]
        self.memo: dict = {}
        self.led: dict = {}
        self.bare: dict = {}

    def units(self, text: str) -> list:
        """Units of a space and the text. One that starts with a line break or a letter stands as it
        is, without its space; any other one as a tuple of it."""
        if not self.cuts:
            return [(" " + text,)]
        together = "  " in text or "\n\n" in text or "\n " in text or " \n" in text
        if not together and text[0] not in " \n" and text[-1] not in " \n" and not _OTHER_SPACE.search(text):
            return text.replace("\n", " \n").split(" ")
        found = _CUT.split(" " + text)
        return [u if u[0] == "\n" else u[1:] if u[0] == " " and not u[1:2].isspace() and len(u) > 1 else (u,) for u in found]

    @staticmethod
    def spelled(unit) -> str:
        if isinstance(unit, tuple):
            return unit[0]
        return unit if unit[:1] == "\n" else " " + unit

    def _b_ids(self, text: str) -> list[int] | None:
        """Ids of B; the model puts a space before, which a text that starts otherwise has not."""
        if text[:1] == " ":
            return self.b.encode(text[1:])
        found = self.b.encode("\n" + text)
        # That space and the line break, which nothing is merged with.
        return found[2:] if found[:1] == [self.lone] and self.b_bytes[found[1]] == b"\n" else None

    def aligned(self, texts: list[str]) -> list[tuple | None]:
        """(groups as text, tokens of A, of B, groups, links within groups, pairs of linked ids as bytes)
        of each text, or None where its tokens do not spell it."""
        a_lists = [self.a.encode(t, add_special_tokens=False).ids for t in texts]
        b_lists = [self._b_ids(t) for t in texts]
        results: list[tuple | None] = [None] * len(texts)
        good = [i for i, t in enumerate(texts) if self._spells(t, a_lists[i], b_lists[i])]
        if good:
            a, b = ([x for i in good for x in lists[i]] for lists in (a_lists, b_lists))
            ends = np.cumsum([len(texts[i].encode()) for i in good])
            for i, entry in zip(good, self._entries(np.array(a), np.array(b), ends), strict=True):
                results[i] = entry
        return results

    def _spells(self, text: str, a: list[int], b: list[int] | None) -> bool:
        if not a or not b:
            return False
        return b"".join([self.a_bytes[x] for x in a]) == text.encode() == b"".join([self.b_bytes[x] for x in b])

    def _entries(self, a_ids: np.ndarray, b_ids: np.ndarray, ends: np.ndarray) -> list[tuple]:
        """What ``aligned`` returns for texts one after the other that end at these bytes; tokens of both
        kinds end at all of them."""
        a_high, b_high = np.cumsum(self.a_size[a_ids]), np.cumsum(self.b_size[b_ids])
        links = overlaps(a_high, b_high)
        pairs = ((a_ids[links.row_of_entry()] << SHIFT) | b_ids[links.columns]).astype("<i8")
        a_group, b_group, group_ends = grouped(a_high, b_high)
        together = shared_groups(a_group, b_group, len(group_ends))
        # Each group's tokens of A and then those of B, as they are written.
        a_cut, b_cut = (np.searchsorted(g, np.arange(len(group_ends) + 1)) for g in (a_group, b_group))
        a_first = a_cut[a_group] == np.arange(len(a_ids))
        b_first = b_cut[b_group] == np.arange(len(b_ids))
        low = np.concatenate([[0], ends[:-1]])
        text_first = np.isin(np.concatenate([[0], a_high[:-1]]), low)
        n = len(self.a_bytes)
        written = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        written[np.arange(len(a_ids)) + b_cut[a_group]] = a_ids + n * np.where(text_first, 0, np.where(a_first, 2, 1))
        written[np.arange(len(b_ids)) + a_cut[b_group + 1]] = b_ids + 3 * n + len(self.b_bytes) * np.where(b_first, 0, 1)
        at_a, at_b, at_group = (
            np.concatenate([[0], np.searchsorted(x, ends, side="right")]) for x in (a_high, b_high, group_ends)
        )
        at_link, at_together = links.starts[at_a].tolist(), together.starts[at_a]
        at = (at_a + at_b).tolist()
        data, codes, table = pairs.tobytes(), written.tolist(), self.written
        return [
            (
                "".join([table[c] for c in codes[i:j]]), n_a, n_b, n_groups, n_together, data[8 * k : 8 * l]
            )
            for i, j, n_a, n_b, n_groups, n_together, k, l in zip(
                at, at[1:], np.diff(at_a).tolist(), np.diff(at_b).tolist(), np.diff(at_group).tolist(),
                np.diff(at_together).tolist(), at_link, at_link[1:], strict=False,
            )
        ]

    def _joined(self, units: list[str], before: str) -> Iterator[tuple | None]:
        """What ``aligned`` returns for units that stand after a space or, without it, after a line break;
        many are tokenized as one text."""
        held: list[str] = []
        size = 0
        for unit in units:
            held.append(unit)
            size += len(unit) + 1
            if size > JOINED:
                yield from self._joined_once(held, before)
                held, size = [], 0
        if held:
            yield from self._joined_once(held, before)

    def _joined_once(self, units: list[str], before: str) -> list[tuple | None]:
        led = before == " "
        text = before + before.join(units)
        raw = text.encode()
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:]) if led else self.b.encode(text)[1:]
        sizes = np.array([len(u) if u.isascii() else len(u.encode()) for u in units])
        if led:
            ends = np.cumsum(sizes + 1)
        else:
            # The line breaks are texts of their own.
            ends = np.cumsum(np.stack([np.ones(len(units), dtype=np.int64), sizes], axis=1).ravel())
        if self._spells(text, a, b):
            a, b = np.array(a), np.array(b)
            if np.isin(ends, np.cumsum(self.a_size[a])).all() and np.isin(ends, np.cumsum(self.b_size[b])).all():
                assert ends[-1] == len(raw)
                found = self._entries(a, b, ends)
                return found if led else found[1::2]
        return self.aligned([" " + u for u in units] if led else units)

    def _learn(self, units: Iterable) -> dict:
        """What is found for units; a unit is put together from a word and the marks after it."""
        found: dict = {}
        parts: dict = {}
        led, bare = set(), set()
        for unit in units:
            if isinstance(unit, tuple):
                (found[unit],) = self.aligned([unit[0]])
                continue
            line = unit[0] == "\n"
            word = unit[1:] if line else unit
            stem = word.rstrip(self.marks)
            tail = word[len(stem) :] if stem.isalpha() else ""
            stem = stem if tail else word
            (bare if line else led).add(stem)
            if tail:
                bare.add(tail)
            if line:
                bare.add("\n")
            parts[unit] = (line, stem, tail)
        at_led, at_bare = self._parts(self.led, led, " "), self._parts(self.bare, bare, "\n")
        for unit, (line, stem, tail) in parts.items():
            entry = at_bare[stem] if line else at_led[stem]
            if line or tail:
                entries = [at_bare["\n"], entry] if line else [entry]
                entry = _after_another([*entries, at_bare[tail]] if tail else entries)
            found[unit] = entry
        return found

    def _parts(self, kept: dict, wanted: set[str], before: str) -> dict:
        """What is found for words or marks; short ones are added to ``kept``."""
        new = [u for u in wanted if u not in kept and u != "\n"]
        found = dict(zip(new, self._joined(new, before), strict=True))
        if "\n" in wanted and "\n" not in kept:
            (found["\n"],) = self.aligned(["\n"])
        if len(kept) + len(found) > MEMO_UNITS:
            found |= {u: kept[u] for u in wanted if u in kept}
            kept.clear()
        short = {u: x for u, x in found.items() if len(u) <= MEMO_LENGTH}
        kept.update(short)
        return kept if len(short) == len(found) else kept | found

    def documents(self, texts: list[str]) -> list[list[tuple] | None]:
        """What is found for the units of each text, or None where there are no tokens."""
        lists = [self.units(t) if t else [] for t in texts]
        missing = {u for units in lists for u in units if u not in self.memo}
        if len(self.memo) + len(missing) > MEMO_UNITS:
            self.memo.clear()
            missing = {u for units in lists for u in units}
        found = self._learn(missing)
        short = {u: x for u, x in found.items() if not isinstance(u, tuple) and len(u) <= MEMO_LENGTH}
        self.memo.update(short)
        here = self.memo if len(short) == len(found) else self.memo | found
        results: list[list[tuple] | None] = []
        for text, units in zip(texts, lists, strict=True):
            entries = [here[u] for u in units]
            if None in entries:
                (whole,) = self.aligned([" " + text])
                entries = [] if whole is None else [whole]
            results.append(entries or None)
        return results


def _after_another(entries: list[tuple | None]) -> tuple | None:
    """Texts that follow each other as one."""
    if None in entries:
        return None
    groups, n_a, n_b, n_groups, n_together, pairs = zip(*entries, strict=True)
    return ";".join(groups), sum(n_a), sum(n_b), sum(n_groups), sum(n_together), b"".join(pairs)


def overlaps(a_high: np.ndarray, b_high: np.ndarray):
    """Tokens of A by tokens of B, the bytes that both cover; tokens are given by their ends."""
    width = int(a_high[-1]) if len(a_high) else 0
    a = incidence(np.concatenate([[0], a_high[:-1]]).astype(np.int64), a_high, width)
    b = incidence(np.concatenate([[0], b_high[:-1]]).astype(np.int64), b_high, width)
    return product(a, b.transposed())


def grouped(a_high: np.ndarray, b_high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of every token of A and of B, and the ends of the groups."""
    ends = np.intersect1d(a_high, b_high)
    return np.searchsorted(ends, a_high), np.searchsorted(ends, b_high), ends


def shared_groups(a_group: np.ndarray, b_group: np.ndarray, groups: int):
    """Tokens of A by tokens of B, one where they are in the same group."""
    return product(memberships(a_group, groups), memberships(b_group, groups).transposed())


def aligner(a_path: str, b_path: str) -> Aligner:
    """This worker's aligner for two vocabulary files."""
    kept = worker_state("aligners", dict)
    if (a_path, b_path) not in kept:
        kept[a_path, b_path] = Aligner(a_path, b_path)
    return kept[a_path, b_path]


ALIGNED = (
    "doc_id long, a_ids array<int>, b_ids array<int>, groups array<struct<a_end:int,b_end:int>>, "
    "links array<struct<a:int,b:int,n_bytes:int>>"
)


def align(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    a_path: str | None = None, b_path: str | None = None,
) -> DataFrame:
    """Of every document the ids of both tokenizers, where its groups end (as token numbers), and
    its overlap links with the bytes shared."""
    a_path, b_path = a_path or tokenizer_file(A_FILE), b_path or tokenizer_file(B_FILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            tool = aligner(a_path, b_path)
            for part in in_groups(_texts(batches)):
                for (doc, _), entries in zip(part, tool.documents([t for _, t in part]), strict=True):
                    yield (doc, *_document(tool, entries or []))

        yield from batches_of(rows(), ARROW_ALIGNED, 200)

    return _narrow(df, id_column, text_column).mapInArrow(run, ALIGNED)


ARROW_ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()), ("a_ids", pa.list_(pa.int32())), ("b_ids", pa.list_(pa.int32())),
        ("groups", pa.list_(pa.struct([("a_end", pa.int32()), ("b_end", pa.int32())]))),
        ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n_bytes", pa.int32())]))),
    ]
)


def _document(tool: Aligner, entries: list[tuple]) -> tuple[list, list, list, list]:
    sides = [g.split("|") for e in entries for g in e[0].split(";")]
    a_ids = np.array([int(x) for a, _ in sides for x in a.split(",")], dtype=np.int64)
    b_ids = np.array([int(x) for _, b in sides for x in b.split(",")], dtype=np.int64)
    a_ends = np.cumsum([a.count(",") + 1 for a, _ in sides]).tolist() if sides else []
    b_ends = np.cumsum([b.count(",") + 1 for _, b in sides]).tolist() if sides else []
    links = []
    if sides:
        found = overlaps(np.cumsum(tool.a_size[a_ids]), np.cumsum(tool.b_size[b_ids]))
        links = [
            {"a": a, "b": b, "n_bytes": n}
            for a, b, n in zip(found.row_of_entry().tolist(), found.columns.tolist(), found.values.tolist(), strict=True)
        ]
    groups = [{"a_end": a, "b_end": b} for a, b in zip(a_ends, b_ends, strict=True)]
    return a_ids.tolist(), b_ids.tolist(), groups, links


def _narrow(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    return rows_of(batches, "doc_id", "text")


# Rows of documents, and in between one row for each block with its pairs.
_BLOCKS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, "
    "groups_sha256 string, at binary, times binary, pairs array<long>, held array<int>"
)
_BLOCKS_ARROW = pa.schema(
    [
        ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("n_group_links", pa.int64()), ("groups_sha256", pa.string()), ("at", pa.binary()),
        ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())),
    ]
)


def _block(number: int, held: list[tuple]) -> Iterator[tuple]:
    """Rows of a block; ``held`` has for each document its figures and its pairs as bytes."""
    sizes = np.array([len(pairs) // 8 for *_, pairs in held])
    pairs, place = np.unique(np.frombuffer(b"".join(x[-1] for x in held), dtype="<i8"), return_inverse=True)
    document = np.repeat(np.arange(len(held)), sizes)
    key, times = np.unique(document * max(len(pairs), 1) + place, return_counts=True)
    at = (key % max(len(pairs), 1)).astype("<u4")
    cuts = np.searchsorted(key, np.arange(len(held) + 1) * max(len(pairs), 1)).tolist()
    times = times.astype("<u4")
    for (*figures, _), n, low, high in zip(held, sizes.tolist(), cuts, cuts[1:], strict=False):
        doc, n_a, n_b, n_groups, n_together, digest = figures
        yield (
            number, doc, n_a, n_b, n_groups, n, n_together, digest,
            at[low:high].tobytes(), times[low:high].tobytes(), None, None,
        )
    counts = np.bincount(at, minlength=len(pairs))
    yield (number, *[None] * 9, pairs.tolist(), counts.tolist())


def _in_blocks(df: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def rows() -> Iterator[tuple]:
            tool = aligner(a_path, b_path)
            number, size, held = TaskContext.get().partitionId() << 32, 0, []
            for part in in_groups(_texts(batches)):
                for (doc, text), entries in zip(part, tool.documents([t for _, t in part]), strict=True):
                    if entries is None:
                        held.append((doc, 0, 0, 0, 0, "", b""))
                    else:
                        groups, n_a, n_b, n_groups, n_together, pairs = zip(*entries, strict=True)
                        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
                        held.append((doc, sum(n_a), sum(n_b), sum(n_groups), sum(n_together), digest, b"".join(pairs)))
                    size += len(text) + 50
                    if size >= BLOCK:
                        yield from _block(number, held)
                        number, size, held = number + 1, 0, []
            if held:
                yield from _block(number, held)

        yield from batches_of(rows(), _BLOCKS_ARROW, cells=2_000_000)

    return df.mapInArrow(run, _BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n_docs (documents that hold it linked) and best (no pair of its A id has more)."""
    sums = _pairs_of(blocks).groupBy("pair").agg(F.sum("held").alias("n_docs"))
    of_a = Window.partitionBy(F.shiftright("pair", SHIFT))  # at most as many rows as B has ids
    return sums.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_a))


def _pairs_of(blocks: DataFrame) -> DataFrame:
    each = F.arrays_zip("pairs", "held")
    return (
        blocks.where("pairs is not null")
        .select("block", F.posexplode(each).alias("place", "each"))
        .select("block", "place", F.col("each.pairs").alias("pair"), F.col("each.held").alias("held"))
    )


DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_group_links long"


def _scored(documents: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of one block, with the counts of its pairs."""
    n = counts.num_rows
    place = counts.column("place").to_numpy()
    n_docs, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    n_docs[place], best[place] = counts.column("n_docs").to_numpy(), counts.column("best").to_numpy().astype(np.int64)
    sums, bests = [], []
    for at, times in zip(documents.column("at").to_pylist(), documents.column("times").to_pylist(), strict=True):
        at, times = np.frombuffer(at, dtype="<u4"), np.frombuffer(times, dtype="<u4").astype(np.int64)
        sums.append(int((n_docs[at] * times).sum()))
        bests.append(int((best[at] * times).sum()))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_group_links"]
    found = {c: documents.column(c) for c in names}
    found |= {"n_best": pa.array(bests, pa.int64()), "count_sum": pa.array(sums, pa.int64())}
    return pa.table({c.split()[0]: found[c.split()[0]] for c in DIGEST.split(", ")})


def alignment_figures(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    a_path: str | None = None, b_path: str | None = None,
) -> DataFrame:
    """Of every document its numbers of tokens, groups and links, the links whose pair is the best of
    its A id, the sum of the pairs' counts, and the digest of its groups."""
    a_path, b_path = a_path or tokenizer_file(A_FILE), b_path or tokenizer_file(B_FILE)
    blocks = stored(_in_blocks(_narrow(df, id_column, text_column), a_path, b_path), "aligned")
    counts = stored(pair_counts(blocks), "pairs")
    known = _pairs_of(blocks).join(counts, "pair").select(F.col("block").alias("of_block"), "place", "n_docs", "best")
    documents = blocks.where("pairs is null").drop("pairs", "held")
    return documents.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_scored, DIGEST)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of the alignment of every document."""
    return alignment_figures(table(configure(spark), folder, "documents"))
