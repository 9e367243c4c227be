import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import no_documents, odd_documents, saved, whole
from tokenizers import Tokenizer

from noteloom.llm import packing as p

SMALL = "/root/testdata/sf0.001"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def optimum(lengths, capacity):
    """Fewest sequences, by trying every place for every piece."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for size in {b for b in bins if b + lengths[i] <= capacity}:
            changed = list(bins)
            changed.remove(size)
            place(i + 1, [*changed, size + lengths[i]])
        place(i + 1, [*bins, lengths[i]])

    place(0, [])
    return best[0] if lengths else 0


def checked(lengths, capacity, **options):
    plan = p.bin_completion(np.bincount(lengths, minlength=capacity), capacity, **options)
    got = Counter()
    for filling in plan:
        assert sum(filling.lengths) <= capacity
        for length in filling.lengths:
            got[length] += filling.times
    assert got == Counter(lengths)
    return sum(f.times for f in plan)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 29), max_size=9))
def test_optimal_on_small_sets(lengths):
    assert checked(lengths, 30) == optimum(lengths, 30)


def test_beats_best_fit_where_that_fails():
    lengths = [7, 6, 6, 4, 4, 3, 3, 3, 2, 2, 2, 2]  # 44 of 4 x 11
    assert checked(lengths, 11) == 4


def test_fillings_with_more_waste_are_tried():
    assert checked([1228, 1188, 1126, 800, 512, 450, 410, 410], 2048) == 3
    assert checked([60, 58, 55, 39, 25, 22, 20, 20], 100) == 3


def brute_undominated(gap, lengths):
    """Fillings whose parts no others cover: sets of parts that each fit a place of their own."""
    sets = {tuple(c) for n in range(1, len(lengths) + 1) for c in combinations(sorted(lengths, reverse=True), n)}
    sets = [s for s in sets if sum(s) <= gap]

    def covers(other, parts):
        def place(i, room):
            return i == len(parts) or any(
                place(i + 1, (*room[:k], r - parts[i], *room[k + 1 :])) for k, r in enumerate(room) if r >= parts[i]
            )

        return place(0, other)

    return {s for s in sets if not any(o != s and covers(o, s) and not (covers(s, o) and len(o) >= len(s)) for o in sets)}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 14), min_size=1, max_size=7), st.integers(3, 20))
def test_every_undominated_filling_comes_once_by_waste(lengths, gap):
    found = list(p.completions(gap, np.bincount(lengths, minlength=gap + 1)))
    assert len(found) == len(set(found))
    assert [sum(f) for f in found] == sorted(map(sum, found), reverse=True)
    assert brute_undominated(gap, lengths) <= set(found)


def test_never_worse_than_best_fit_and_never_below_the_bound():
    rng = np.random.default_rng(1)
    for low, high, n in ((1, 2048, 300), (400, 900, 200), (600, 700, 100), (1025, 2048, 50), (1, 100, 500)):
        lengths = rng.integers(low, high, n).tolist()
        counts = np.bincount(lengths, minlength=2048)
        plain = sum(f.times for f in p.best_fit(dict(Counter(lengths)), 2048))
        assert p.lower_bound(counts, 2048) <= checked(lengths, 2048, effort=300) <= plain


def test_undominated_fillings():
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40, 30, 20, 10]] = 1
    assert p.fillings(60, counts, 8)[0] == (60,)
    assert (30, 20) not in p.fillings(60, counts, 8)


def brute_pieces(rows, capacity=2048):
    for doc_id, text in rows:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            yield doc_id, n, a, b - a, zlib.crc32(ids[a:b].tobytes())


def assert_packed(found, rows):
    key = lambda r: repr(r)
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(brute_pieces(rows), key=key)
    places = defaultdict(list)
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_query(spark):
    found = p.op7_packing(spark, SMALL).collect()
    sequences = assert_packed(found, whole(SMALL))
    assert sequences == -(-sum(r["length"] for r in found) // 2048)


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    assert_packed(p.op7_packing(spark, saved(df, tmp_path)).collect(), [(r["doc_id"], r["text"]) for r in df.collect()])


def test_no_documents(spark, tmp_path):
    assert p.op7_packing(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_one_length_of_many_rows(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "700L AS length", "1L AS ids_crc32")
    found = p.packed(rows).collect()
    assert len({r["sequence_id"] for r in found}) == 1500
    assert Counter((r["sequence_id"], r["offset"]) for r in found).most_common(1)[0][1] == 1
