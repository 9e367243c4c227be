import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import LONG, no_documents, odd_documents, saved, whole

from noteloom.llm import winnowing as w

SMALL = "/root/testdata/sf0.001"
some_text = st.text(alphabet="abé\U0001f600", max_size=60)


def plain(text, k, window):
    """Winnowing by its definition, with the hash as given."""
    if not text:
        return []
    k = min(k, len(text))
    hashes = [int(w.gram_hashes(np.array([ord(c) for c in text[i : i + k]], dtype=np.uint64), k)[0]) for i in range(len(text) - k + 1)]
    window = min(window, len(hashes))
    kept = set()
    for i in range(len(hashes) - window + 1):
        part = hashes[i : i + window]
        kept.add(i + max(j for j, h in enumerate(part) if h == min(part)))
    return [(hashes[i], i) for i in sorted(kept)]


@settings(max_examples=200, deadline=None)
@given(some_text, st.integers(1, 6), st.integers(1, 9))
def test_as_defined(text, k, window):
    hashes, positions = w.winnow(text, k, window)
    assert list(zip(hashes.tolist(), positions.tolist(), strict=True)) == plain(text, k, window)
    again = w.from_text(w.as_text(hashes, positions))
    assert again[0].tolist() == hashes.tolist() and again[1].tolist() == positions.tolist()


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abcd ", min_size=50, max_size=80), some_text, some_text, some_text, some_text)
def test_shared_passage_is_met(passage, a, b, c, d):
    first, second = (set(w.winnow(x + passage + y)[0].tolist()) for x, y in ((a, b), (c, d)))
    assert first & second


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    result = []
    for n, (doc_id, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        prints = [w.winnow(x) for x in (text, changed, following)]
        sets = [set(h.tolist()) for h, _ in prints]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        sha = hashlib.sha256(changed.encode()).hexdigest()
        result.append((doc_id, len(text), sha, w.as_text(*prints[0]), w.as_text(*prints[1]), *near))
    return sorted(result, key=repr)


def test_query(spark):
    assert sorted((tuple(r) for r in w.op2_winnowing(spark, SMALL).collect()), key=repr) == brute(whole(SMALL))


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    found = w.op2_winnowing(spark, saved(df, tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert {r["n_chars"] for r in found} >= {0, 1, len(LONG)}


def test_one_document_is_its_own_next(spark, tmp_path):
    df = odd_documents(spark).where("doc_id = 6")
    (row,) = w.op2_winnowing(spark, saved(df, tmp_path)).collect()
    assert row["near_next"] == 1.0


def test_no_documents(spark, tmp_path):
    assert w.op2_winnowing(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_fingerprints_keep_positions(spark):
    rows = w.fingerprints(odd_documents(spark), "doc_id", "text").collect()
    for row in rows:
        hashes, positions = w.from_text(row["fingerprint"])
        assert row["hashes"] == hashes.tolist() and row["positions"] == positions.tolist()


def test_bad_parameters():
    with pytest.raises(ValueError):
        w._checked(20, 300)
