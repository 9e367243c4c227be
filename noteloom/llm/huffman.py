"""Token ids as canonical, length-limited Huffman codes in binary files.

The code lengths follow the counts of all ids (package-merge under a limit), so that one table of
2**limit entries decodes a symbol per look-up. Each document's codes start on a byte, and every
``block`` tokens a checkpoint gives the bit where the next block starts: blocks are decoded
independently, many at a time.

File format (little-endian): the magic ``NLHUFF01``; payload; then the footer and its place:

    footer    limit u1, id width u1 (4), 2 bytes 0, block u4, documents u4, symbols u4,
              then per symbol id u4 and code length u1, then per document id i8 (with a flag
              u1 for a missing id), first token i8, tokens u4, payload bytes u4,
              then per block its first bit within the document, u4
    tail      offset of the footer u8, crc32 of the footer u4, the magic

Edge cases: a null text is empty, so it holds the end id alone; rows without id come first;
rows that repeat an id are ordered by their ids' crc32 and length; one distinct id has a code of
one bit; an empty table writes no file and gives no rows. Other columns are not read.
"""

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import (
    batches_of,
    configure,
    fresh_path,
    in_slices,
    read_file,
    rows_of,
    stored,
    table,
    write_file,
)
from noteloom.llm.ordering import Buckets
from noteloom.llm.tokens import Encoder, WordEncoder, encoder, in_groups

MAGIC = b"NLHUFF01"
LIMIT = 16  # longest code in bits
BLOCK = 256  # tokens between checkpoints
END_ID = 1
FILE_BYTES = 32 << 20
MEMO = 1_200_000  # pieces that a worker remembers
GROUP_CHARACTERS = 2_000_000  # of texts that are encoded together

_HEAD = "<BBHIII"
_TAIL = "<QI8s"
_DOC = np.dtype([("id", "<i8"), ("missing", "u1"), ("start", "<i8"), ("tokens", "<u4"), ("bytes", "<u4")])
_SYMBOL = np.dtype([("id", "<u4"), ("length", "u1")])


# --- the code -------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no length above ``limit``, by package-merge."""
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    if n < 2:
        return np.ones(n, dtype=np.uint8)
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.int64)
    level, is_leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        packages = level[0 : len(level) - len(level) % 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        place = np.argsort(both, kind="stable")
        level = both[place]
        is_leaf.append(place < n)
    # The cheapest 2n-2 items of the last level; a package takes two items of the level below.
    lengths, taken = np.zeros(n, dtype=np.uint8), 2 * n - 2
    for flags in reversed(is_leaf):
        leaves_taken = int(flags[:taken].sum())
        lengths[:leaves_taken] += 1
        taken = 2 * (taken - leaves_taken)
    found = np.empty(n, dtype=np.uint8)
    found[order] = lengths
    return found


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes by length, then by place: they follow from the lengths alone."""
    order = np.argsort(lengths, kind="stable")
    steps = lengths[order].astype(np.int64)
    top = int(steps[-1]) if len(steps) else 0
    # Each code, written with `top` bits, starts where the one before ends.
    ends = np.cumsum(np.int64(1) << (top - steps))
    codes = np.empty(len(lengths), dtype=np.uint32)
    codes[order] = (np.concatenate(([0], ends[:-1])) >> (top - steps)).astype(np.uint32)
    return codes


class Code:
    """Symbols, their lengths and codes, and the table for decoding."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, limit: int = LIMIT):
        self.symbols, self.lengths, self.limit = symbols, lengths, limit
        self.codes = canonical_codes(lengths)
        self._by_id = None
        self._table = None

    @classmethod
    def from_counts(cls, symbols: np.ndarray, counts: np.ndarray, limit: int = LIMIT) -> "Code":
        order = np.argsort(symbols)
        return cls(symbols[order].astype(np.uint32), code_lengths(counts[order], limit), limit)

    def encode(self, ids: np.ndarray, starts: np.ndarray, block: int = BLOCK):
        """Documents (ids from ``starts`` on) as bytes: payload, bytes per document, block bits.

        Block bits are the first bit of each block within its document, document after document.
        """
        if self._by_id is None:
            size = int(self.symbols[-1]) + 1
            self._by_id = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.uint64)
            self._by_id[0][self.symbols] = self.lengths
            self._by_id[1][self.symbols] = self.codes
        sizes = self._by_id[0][ids]
        ends = np.cumsum(sizes, dtype=np.int64)
        tokens = np.diff(np.append(starts, len(ids)))
        first = ends[starts] - sizes[starts]
        n_bytes = (ends[starts + tokens - 1] - first + 7) // 8
        doc_bit = (np.cumsum(n_bytes) - n_bytes) * 8
        offset = ends - sizes
        offset += np.repeat(doc_bit - first, tokens)
        value = self._by_id[1][ids] << (64 - sizes - (offset & 31)).astype(np.uint64)
        word = offset >> 5
        words = int(n_bytes.sum() + 3) // 4 + 2
        packed = np.bincount(word, value >> np.uint64(32), words)
        packed[1:] += np.bincount(word, value & np.uint64(0xFFFFFFFF), words)[:-1]
        payload = packed.astype(">u4").tobytes()[: int(n_bytes.sum())]
        # The places where blocks start: every ``block`` tokens of each document.
        blocks = -(-tokens // block)
        rank = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        marks = offset[np.repeat(starts, blocks) + rank * block] - np.repeat(doc_bit, blocks)
        return payload, n_bytes, marks.astype("<u4")

    def decode(self, payload: np.ndarray, bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Blocks that start at ``bits`` and hold ``tokens`` ids each; all advance in step."""
        if self._table is None:
            widths = np.int64(1) << (self.limit - self.lengths.astype(np.int64))
            order = np.argsort(self.codes.astype(np.int64) << (self.limit - self.lengths.astype(np.int64)))
            filled = np.repeat(order, widths[order])
            place = np.zeros(1 << self.limit, dtype=np.int64)
            place[: len(filled)] = filled
            self._table = self.symbols[place], self.lengths[place].astype(np.int64)
        symbol, length = self._table
        padded = np.concatenate((payload, np.zeros(8, dtype=np.uint8)))
        words = np.ndarray((len(padded) - 3,), dtype=">u4", buffer=padded, strides=(1,))
        order = np.argsort(-tokens, kind="stable")
        at, left = bits[order].astype(np.int64), tokens[order]
        out = np.empty(int(tokens.sum()), dtype="<u4")
        target = (np.cumsum(tokens) - tokens)[order]
        mask = (1 << self.limit) - 1
        for step in range(int(left[0]) if len(left) else 0):
            n = int(np.searchsorted(-left, -step, side="left"))  # blocks that have more than `step` tokens
            here = at[:n]
            seen = (words[here >> 3].astype(np.int64) >> (32 - self.limit - (here & 7))) & mask
            out[target[:n] + step] = symbol[seen]
            at[:n] = here + length[seen]
        return out


# --- files ----------------------------------------------------------------------------


def file_parts(code: Code, docs: list[tuple], block: int = BLOCK) -> list[bytes]:
    """A file of (id, first token, tokens, payload, block bits) documents."""
    entries = np.zeros(len(docs), dtype=_DOC)
    for i, (doc_id, start, tokens, payload, _) in enumerate(docs):
        entries[i] = (doc_id or 0, doc_id is None, start, tokens, len(payload))
    symbols = np.zeros(len(code.symbols), dtype=_SYMBOL)
    symbols["id"], symbols["length"] = code.symbols, code.lengths
    footer = b"".join(
        [
            struct.pack(_HEAD, code.limit, 4, 0, block, len(docs), len(symbols)),
            symbols.tobytes(),
            entries.tobytes(),
            *[d[4] for d in docs],
        ]
    )
    size = len(MAGIC) + int(entries["bytes"].sum(dtype=np.int64))
    return [MAGIC, *[d[3] for d in docs], footer, struct.pack(_TAIL, size, zlib.crc32(footer), MAGIC)]


def read_documents(data: bytes, at_once: int = 1 << 20):
    """(id, first token, ids) of a file's documents, decoded about ``at_once`` tokens at a time."""
    if data[:8] != MAGIC or len(data) < 8 + struct.calcsize(_TAIL):
        raise ValueError("not a file of this format")
    foot, check, magic = struct.unpack_from(_TAIL, data, len(data) - struct.calcsize(_TAIL))
    footer = memoryview(data)[foot : len(data) - struct.calcsize(_TAIL)]
    if magic != MAGIC or zlib.crc32(footer) != check:
        raise ValueError("damaged footer")
    limit, _, _, block, n_docs, n_symbols = struct.unpack_from(_HEAD, footer)
    here = struct.calcsize(_HEAD)
    symbols = np.frombuffer(footer, _SYMBOL, n_symbols, here)
    here += symbols.nbytes
    docs = np.frombuffer(footer, _DOC, n_docs, here)
    here += docs.nbytes
    marks = np.frombuffer(footer, "<u4", offset=here).astype(np.int64)
    code = Code(symbols["id"].copy(), symbols["length"].copy(), limit)
    payload = np.frombuffer(data, np.uint8, foot - 8, 8)
    tokens = docs["tokens"].astype(np.int64)
    blocks = -(-tokens // block)
    first_block = np.concatenate(([0], np.cumsum(blocks)))
    first_byte = np.concatenate(([0], np.cumsum(docs["bytes"].astype(np.int64))))
    total = np.cumsum(tokens)
    low = 0
    while low < n_docs:
        done = int(total[low - 1]) if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + at_once, side="right")))
        b0, b1 = first_block[low], first_block[high]
        owner = np.repeat(np.arange(low, high), blocks[low:high])
        rank = np.arange(b0, b1) - first_block[owner]
        sizes = np.minimum(block, tokens[owner] - rank * block)
        part = payload[first_byte[low] : first_byte[high]]
        ids = code.decode(part, marks[b0:b1] + (first_byte[owner] - first_byte[low]) * 8, sizes)
        ends = np.cumsum(tokens[low:high])
        for i in range(low, high):
            entry = docs[i]
            end = int(ends[i - low])
            yield None if entry["missing"] else int(entry["id"]), int(entry["start"]), ids[end - int(tokens[i]) : end]
        low = high


# --- Spark jobs -----------------------------------------------------------------------

_IDS = pa.schema([("id", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64()), ("ids", pa.binary()), ("is_count", pa.bool_())])
_COUNTS = pa.schema([("token", pa.int64()), ("n", pa.int64())])
_CODED = pa.schema(
    [
        ("id", pa.int64()),
        ("bucket", pa.int32()),
        ("n", pa.int64()),
        ("crc", pa.int64()),
        ("payload", pa.binary()),
        ("marks", pa.binary()),
    ]
)
_FILES = pa.schema([("path", pa.string()), ("size", pa.int64()), ("documents", pa.int64()), ("tokens", pa.int64())])
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def tokenized(df: DataFrame, id_column: str, text_column: str, path: str, kind: type[Encoder], end_id: int) -> DataFrame:
    """Per text id, bucket of the id, number of ids and the ids (``_ids_of``), and, with is_count,
    how often each task has met every id; written once, the counts in files of their own."""
    named = df.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    buckets = Buckets.of(named, "id")

    def work(batches):
        encode = encoder(kind, path, narrow=True, memo=MEMO)
        end = end_id.to_bytes(encode.width, "little")
        flag = bytes([encode.width])

        def rows():
            counts = np.zeros(max(encode.tokenizer.get_vocab_size(), end_id + 1), dtype=np.int64)
            for group in in_groups(rows_of(batches, "id", "bucket", "text"), characters=GROUP_CHARACTERS):
                found = [ids + end for ids in encode.many([row[2] for row in group])]
                counts += np.bincount(np.frombuffer(b"".join(found), encode.kind), minlength=len(counts))
                for (doc_id, bucket, _), ids in zip(group, found, strict=True):
                    yield doc_id, bucket, len(ids) // encode.width, flag + ids, False
            met = np.flatnonzero(counts)
            if len(met):
                yield None, None, len(met), np.stack((met, counts[met])).astype("<i8").tobytes(), True

        yield from batches_of(rows(), _IDS)

    placed = named.select("id", buckets.number(F.col("id")).cast("int").alias("bucket"), "text")
    found = placed.mapInArrow(work, "id long, bucket int, n long, ids binary, is_count boolean")
    location = fresh_path(df.sparkSession, "token-ids")
    found.write.option("compression", "zstd").partitionBy("is_count").parquet(location)
    return df.sparkSession.read.schema(found.schema).parquet(location)


def _ids_of(data: bytes) -> np.ndarray:
    """Ids behind a byte that gives their width."""
    return np.frombuffer(data, f"<u{data[0]}", offset=1)


def id_counts(tokens: DataFrame) -> DataFrame:
    """Count of every id over all documents, from one row per task."""

    def work(batches):
        for (data,) in rows_of(batches, "ids"):
            ids, n = np.frombuffer(data, "<i8").reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], schema=_COUNTS)

    counted = tokens.where("is_count").select("ids").mapInArrow(work, "token long, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("n"))


def write_files(tokens: DataFrame, folder: str, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """Files of all documents in ascending order of id; returns their manifest.

    The counts that come to the driver are one row per id of the vocabulary, and the totals one
    row per bucket. Documents travel to their bucket as codes, smaller than their ids.
    """
    counted = id_counts(tokens).toPandas()
    tokens = tokens.where("not is_count")
    code = Code.from_counts(counted["token"].to_numpy(), counted["n"].to_numpy(), limit) if len(counted) else None
    totals = {r["bucket"]: r["n"] for r in tokens.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    starts, before = {}, 0
    for bucket in sorted(totals):
        starts[bucket] = before
        before += totals[bucket]

    def coded(batches):
        def flush(rows):
            arrays = [_ids_of(r[3]) for r in rows]
            sizes = np.array([len(a) for a in arrays])
            payload, n_bytes, marks = code.encode(np.concatenate(arrays), np.cumsum(sizes) - sizes, block)
            byte = mark = 0
            for (doc_id, bucket, n, _), ids, size in zip(rows, arrays, n_bytes.tolist(), strict=True):
                blocks = -(-n // block)
                yield (
                    doc_id,
                    bucket,
                    n,
                    zlib.crc32(ids.astype("<u4")),
                    payload[byte : byte + size],
                    marks[mark : mark + blocks].tobytes(),
                )
                byte, mark = byte + size, mark + blocks

        def rows():
            held, weight = [], 0
            for row in rows_of(batches, "id", "bucket", "n", "ids"):
                held.append(row)
                weight += row[2]
                if weight >= 1 << 18:
                    yield from flush(held)
                    held, weight = [], 0
            if held:
                yield from flush(held)

        yield from batches_of(rows(), _CODED)

    def write(batches):
        def rows():
            bucket, start, held, size, n_tokens = None, 0, [], 0, 0

            def close():
                parts = file_parts(code, held, block)
                path = write_file(folder, "part.nlhuff", parts)
                return path, sum(map(len, parts)), len(held), n_tokens

            for doc_id, at, n, payload, marks in rows_of(batches, "id", "bucket", "n", "payload", "marks"):
                if held and (at != bucket or size >= FILE_BYTES):
                    yield close()
                    held, size, n_tokens = [], 0, 0
                if at != bucket:
                    bucket, start = at, starts[at]
                held.append((doc_id, start, n, payload, marks))
                start += n
                size += len(payload)
                n_tokens += n
            if held:
                yield close()

        yield from batches_of(rows(), _FILES)

    sent = tokens.mapInArrow(coded, "id long, bucket int, n long, crc long, payload binary, marks binary")
    ordered = sent.repartition(in_slices(tokens), "bucket").sortWithinPartitions("bucket", "id", "crc", "n")
    return stored(
        ordered.mapInArrow(write, "path string, size long, documents long, tokens long"), "token-files"
    )


def read_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""

    def read(batches):
        def rows():
            for (path,) in rows_of(batches, "path"):
                for doc_id, start, ids in read_documents(read_file(path)):
                    yield doc_id, start, len(ids), zlib.crc32(ids.tobytes())

        yield from batches_of(rows(), _READ)

    files = manifest.select("path").repartition(in_slices(manifest), "path")
    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_huffman(spark: SparkSession, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Huffman round trip of the ids of every document."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    documents = table(configure(spark), folder, "documents")
    tokens = tokenized(documents, "doc_id", "text", tokenizer, WordEncoder, END_ID)
    return read_files(write_files(tokens, fresh_path(spark, "token-files-binary")))
