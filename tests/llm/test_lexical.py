import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from odd import no_documents, odd_documents, saved, whole
from pyspark.sql import functions as F

from noteloom.llm import lexical as lx

FOLDER = "/root/testdata/sf0.01"


def plain_terms(text):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = (text or "").translate(str.maketrans(upper, upper.lower()))
    return [t for t in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text) if t]


def plain_search(documents, items, top=10):
    """Every document scored for every item."""
    held = [(doc, Counter(plain_terms(text))) for doc, text in documents]
    held = [(doc, c) for doc, c in held if c]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    result = []
    for item, text in items:
        wanted, scores = Counter(plain_terms(text)), []
        for doc, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * len(held)) // total
            score = sum(
                k * math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, k in wanted.items()
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        result += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(scores[:top], 1)]
    return result


def found(df):
    return sorted((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def test_query_equals_scoring_everything(spark):
    want = plain_search(whole(FOLDER), whole(FOLDER, "item_id, text", "benchmark"))
    assert found(lx.op13_lexical(spark, FOLDER)) == sorted(want)
    assert len(want) == 400


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", FOLDER])
def test_query_equals_sql(spark, folder):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    assert found(lx.op13_lexical(spark, folder)) == sorted(connection.execute(lx.ORACLE).fetchall())


def test_small_blocks_and_few_queries_at_a_time(spark, monkeypatch):
    want = found(lx.op13_lexical(spark, "/root/testdata/sf0.001"))
    monkeypatch.setattr(lx, "DOCUMENTS", 8)
    monkeypatch.setattr(lx, "ITEMS", 7)
    monkeypatch.setattr(lx, "BITS_A_TERM", 1)  # signatures that say little
    assert found(lx.op13_lexical(spark, "/root/testdata/sf0.001")) == want


def blocks(documents):
    building = lx._Building(1024)
    for doc, text in documents:
        terms = lx.terms_of(text or "")
        if terms and len(set(terms)) <= 1024:
            building.add(doc, len(terms), Counter(terms))
        if len(building.ids) == building.room:
            yield building.block()
    if building.ids:
        yield building.block()


def test_bounds_hold_and_exclude(spark):
    documents, items = whole(FOLDER), whole(FOLDER, "item_id, text", "benchmark")
    queries = lx.Queries.of((n, *row) for n, row in enumerate(items))
    made = list(blocks(documents))
    n, total = sum(b[1] for b in made), sum(b[2] for b in made)
    df = Counter(t for _, text in documents for t in set(plain_terms(text)))
    weights = np.array([lx.weight(n, df[t]) for t in queries.terms], dtype=np.int64)
    run = lx.Search(queries, weights, n, total, 10)
    seen = []
    rescore = run._rescore

    def watched(q, candidates, *rest):
        seen.append((q, candidates))
        rescore(q, candidates, *rest)

    run._rescore = watched
    for block in made:
        run.block(block[0], block[3], *block[4:])
    assert run.rescored < 0.25 * run.compared
    # A bitmap has every document that holds the term so often.
    bits, count, _, ids, *_, vocabulary = block = made[0]
    slices = np.unpackbits(np.frombuffer(block[5], dtype=np.uint8).reshape(bits, -1), axis=1)
    texts = dict(documents)
    terms = vocabulary.split("\n")[:400]
    rows = lx.bit_rows(terms, bits)
    held = {i: Counter(plain_terms(texts[i])) for i in ids}
    false = 0
    for term, of_term in zip(terms, rows, strict=True):
        for level, least in enumerate(lx.LEVELS):
            may = np.logical_and.reduce([slices[of_term[level, k]] for k in range(lx.HASHES)])[:count]
            does = np.array([held[i][term] >= least for i in ids])
            assert not (does & ~may.astype(bool)).any()
            false += int((may.astype(bool) & ~does).sum())
    assert false < 0.01 * len(terms) * count * len(lx.LEVELS)


def test_terms():
    assert lx.terms_of("Don't ÀB_c9\x7fx~y É漢字 10,5") == ["don", "t", "Àb", "c9", "x", "y", "É漢字", "10", "5"]


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    folder = saved(df, tmp_path)
    items = [(1, "quick fox quick"), (2, None), (3, ""), (4, "nowhere"), (5, "word5 7 d a"), (5, "é 漢字"), (None, "the"), (1, "quick fox quick")]
    saved(spark.createDataFrame(items, "item_id long, text string"), tmp_path, "benchmark")
    want = plain_search([(r["doc_id"], r["text"]) for r in df.collect()], items)
    key = lambda r: tuple((v is None, v or 0) for v in r)
    rows = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lx.op13_lexical(spark, folder).collect()]
    assert sorted(rows, key=key) == sorted(want, key=key)
    assert [r for r in rows if r[0] == 1][:1]


def test_equal_scores_go_by_id(spark):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(None, "same words here"), (99, "others")]
    index = lx.stored(lx.build_index(spark.createDataFrame(rows, "doc_id long, text string")), "index")
    items = spark.createDataFrame([(7, "words")], "item_id long, text string")
    assert [(r["rank"], r["doc_id"]) for r in lx.search(index, items).orderBy("rank").collect()] == [(i, i) for i in range(1, 11)]
    assert [r["doc_id"] for r in lx.search(index, items, top=50).orderBy("rank").collect()] == [*range(1, 41), None]


def test_clashing_columns(spark):
    df = odd_documents(spark).withColumn("bits", F.lit(1)).withColumn("terms", F.lit("x"))
    assert lx.build_index(df).agg(F.sum("n_docs")).first()[0] == 8


def test_no_documents(spark, tmp_path):
    folder = saved(no_documents(spark), tmp_path)
    saved(spark.createDataFrame([(1, "a")], "item_id long, text string"), tmp_path, "benchmark")
    assert lx.op13_lexical(spark, folder).collect() == []


def test_no_queries(spark, tmp_path):
    folder = saved(odd_documents(spark), tmp_path)
    saved(spark.createDataFrame([], "item_id long, text string"), tmp_path, "benchmark")
    assert lx.op13_lexical(spark, folder).collect() == []
