import heapq
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import no_documents, odd_documents, saved, whole
from tokenizers import Tokenizer

from noteloom.llm import huffman as h

SMALL = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def unlimited_cost(counts):
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def best_limited(counts, limit):
    """Least cost over all length lists that a prefix code can have, tried one by one."""
    counts = sorted(counts, reverse=True)
    best = [float("inf")]

    def place(i, low, room, cost):
        if cost >= best[0]:
            return
        if i == len(counts):
            best[0] = cost
            return
        for length in range(low, limit + 1):
            if room >= 2.0**-length:
                place(i + 1, length, room - 2.0**-length, cost + counts[i] * length)

    place(0, 1, 1.0, 0)
    return best[0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 10_000), min_size=2, max_size=60))
def test_as_good_as_huffman_where_the_limit_is_far(counts):
    lengths = h.code_lengths(np.array(counts), 60)
    assert int((lengths * np.array(counts)).sum()) == unlimited_cost(counts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=2, max_size=7), st.integers(3, 5))
def test_best_under_the_limit(counts, limit):
    lengths = h.code_lengths(np.array(counts), limit).astype(int)
    assert lengths.max() <= limit
    assert sum(2.0**-n for n in lengths) <= 1
    assert int((lengths * np.array(counts)).sum()) == best_limited(counts, limit)


def test_codes_are_prefix_free_and_canonical():
    lengths = h.code_lengths(np.array([50, 20, 10, 5, 5, 4, 3, 2, 1]), 6)
    codes = [format(c, f"0{n}b") for c, n in zip(h.canonical_codes(lengths).tolist(), lengths.tolist(), strict=True)]
    assert not any(a != b and b.startswith(a) for a in codes for b in codes)
    order = sorted(range(len(codes)), key=lambda i: (len(codes[i]), i))
    assert [codes[i] for i in order] == sorted(codes)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), min_size=1, max_size=40), min_size=1, max_size=12), st.integers(1, 9))
def test_file_round_trip(docs, block):
    arrays = [np.array(d, dtype="<u4") for d in docs]
    symbols, counts = np.unique(np.concatenate(arrays), return_counts=True)
    code = h.Code.from_counts(symbols, counts, 12)
    sizes = np.array([len(a) for a in arrays])
    payload, n_bytes, marks = code.encode(np.concatenate(arrays), np.cumsum(sizes) - sizes, block)
    rows, byte, mark, start = [], 0, 0, 0
    for i, a in enumerate(arrays):
        blocks = -(-len(a) // block)
        rows.append((i or None, start, len(a), payload[byte : byte + n_bytes[i]], marks[mark : mark + blocks].tobytes()))
        byte, mark, start = byte + n_bytes[i], mark + blocks, start + len(a)
    data = b"".join(h.file_parts(code, rows, block))
    found = list(h.read_documents(data, 50))
    assert [f[2].tolist() for f in found] == docs
    assert [f[:2] for f in found] == [r[:2] for r in rows]


def test_damaged_footer_is_refused():
    code = h.Code.from_counts(np.array([1, 2]), np.array([3, 4]))
    payload, _, marks = code.encode(np.array([1, 2, 2]), np.array([0]))
    data = bytearray(b"".join(h.file_parts(code, [(1, 0, 3, payload, marks.tobytes())])))
    data[len(data) - 25] ^= 1
    with pytest.raises(ValueError):
        list(h.read_documents(bytes(data)))


def test_too_many_symbols():
    with pytest.raises(ValueError):
        h.code_lengths(np.ones(9, dtype=np.int64), 3)


def brute(rows):
    ids = [(i, [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows]
    result, start = [], 0
    crc = lambda x: zlib.crc32(np.array(x, dtype="<u4").tobytes())
    for doc_id, one in sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0, crc(r[1]), len(r[1]))):
        result.append((doc_id, start, len(one), crc(one)))
        start += len(one)
    return sorted(result, key=repr)


def test_query(spark):
    assert sorted((tuple(r) for r in h.op9_huffman(spark, SMALL).collect()), key=repr) == brute(whole(SMALL))


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    found = h.op9_huffman(spark, saved(df, tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_no_documents(spark, tmp_path):
    assert h.op9_huffman(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_one_symbol_only(spark, tmp_path):
    df = odd_documents(spark).where("text is null or text = ''")
    assert {r["n_tokens"] for r in h.op9_huffman(spark, saved(df, tmp_path)).collect()} == {1}
