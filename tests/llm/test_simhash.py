import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from odd import no_documents, odd_documents, saved, whole

from noteloom.llm import simhash as s
from noteloom.llm.components import components

SMALL = "/root/testdata/sf0.001"


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aBc \t\n É", max_size=60))
def test_fingerprint(text):
    assert s.simhash(text) == plain(text)


def groups_of(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


def near(values):
    return [(i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= s.RADIUS]


def crowd(rng, n):
    """Fingerprints around a few centres, some just within reach of each other."""
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    found = set()
    while len(found) < n:
        value = int(rng.choice(centres))
        for bit in rng.integers(0, 64, rng.integers(0, 9)):
            value ^= 1 << int(bit)
        found.add(value)
    return sorted(found)


def test_tile_links_lose_no_group():
    rng = np.random.default_rng(3)
    for _ in range(10):
        values = crowd(rng, 120)
        a, b = s.tile_links(np.array(values, dtype=np.uint64), None)
        index = {v: i for i, v in enumerate(values)}
        spanned = groups_of(len(values), [(index[int(x)], index[int(y)]) for x, y in zip(a, b, strict=True)])
        assert spanned == groups_of(len(values), near(values))
        assert len(a) < len(values)


def test_links_over_many_tiles(spark):
    values = crowd(np.random.default_rng(4), 400)
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    index = {v: i for i, v in enumerate(signed)}
    found = [(index[r["a"]], index[r["b"]]) for r in s.links(df, tile=5).collect()]
    assert groups_of(400, found) == groups_of(400, near(values))


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 300, (220, 2)).tolist() + [[i, i + 1] for i in range(1000, 1100)] + [[2000, i] for i in range(2001, 2100)]
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    label = {r["node"]: r["label"] for r in rows}
    want = groups_of(2100, [p for p in pairs if p[0] != p[1]])
    assert {n: want[n] for n in label} == label
    assert set(label) == {n for p in pairs if p[0] != p[1] for n in p}


def brute(rows):
    values = [plain(t) for _, t in rows]
    labels = groups_of(len(rows), near(values))
    smallest = {}
    for (doc_id, _), label in zip(rows, labels, strict=True):
        if doc_id is not None:
            smallest[label] = min(doc_id, smallest.get(label, doc_id))
    return sorted(((i, f"{v:016x}", smallest.get(n)) for (i, _), v, n in zip(rows, values, labels, strict=True)), key=repr)


def test_query(spark):
    assert sorted((tuple(r) for r in s.op5_simhash(spark, SMALL).collect()), key=repr) == brute(whole(SMALL))


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    found = s.op5_simhash(spark, saved(df, tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_no_documents(spark, tmp_path):
    assert s.op5_simhash(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_one_document_of_each_group_stays(spark):
    df = odd_documents(spark)
    kept = s.without_near_duplicates(df, "doc_id", "text")
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    # 2, 3 and 4 have no words, 5 repeats 1, and 1 is there twice; rows without id stay.
    assert ids == sorted([1, 2, 6, 7, 8, 9, None, None], key=repr)


def test_other_texts_of_a_repeated_id_stay(spark):
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcd"]
    rows = [(1, words[0]), (1, words[1]), (1, words[1]), (2, words[0]), (3, words[2]), (4, words[2]), (4, words[3]), (None, words[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own_fingerprint", F.lit(1))
    kept = s.without_near_duplicates(df, "doc_id", "text")
    assert kept.columns == df.columns
    want = [(1, words[0]), (1, words[1]), (3, words[2]), (4, words[3]), (None, words[0])]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(want, key=repr)
