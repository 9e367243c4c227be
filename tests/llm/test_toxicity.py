import itertools

import duckdb
import pytest
from odd import no_documents, odd_documents, saved

from noteloom.llm import toxicity as t
from noteloom.llm.transducers import best_output

FOLDER = "/root/testdata/sf0.1"
MACHINE = t.grammar()


@pytest.mark.parametrize(
    "letters, reading",
    [
        ("I", "I"), ("oIo", "oIo"), ("TI", "TJ"), ("ToooI", "ToooJ"), ("ToooooI", "ToooooI"), ("IT", "JT"), ("IoooT", "JoooT"),
        ("IooooT", "IooooT"), ("NI", "Ni"), ("NoooooI", "NoooooI"), ("QoI", "Qor"), ("IQ", "IQ"), ("TNI", "TNi"), ("QTI", "QTr"),
        ("HT", "KT"), ("NHT", "NhT"), ("TIoI", "TJoJ"), ("IIT", "JJT"), ("QH", "Qs"), ("", ""),
    ],
)
def test_readings(letters, reading):
    assert best_output(MACHINE, letters) == reading


def test_composition_is_one_after_the_other():
    first, then = t.reported(t._LETTERS), t.marked("N", {"I": "i", "H": "h"}, t._LETTERS + "rs")
    both = t.compose(first, then)
    for letters in itertools.product("INQo", repeat=5):
        text = "".join(letters)
        assert best_output(both, text) == best_output(then, best_output(first, text))


def model():
    return t.Model({"idiot": 2.0, "kill": 2.0}, {"blar": 2.0}, {r: 2 * w for r, w in t.READINGS.items()}, -3.0)


def test_matched_clauses_not_isolated_words():
    score = model().score
    clean = score("a fine day.")
    assert score(None) == score("") == clean < 0.1
    assert score("You are an idiot.") > score("An idiot.") > score("You are not an idiot.") > clean
    assert score("An idiot.") > score("They wrote that an idiot came.") > clean
    assert score("I will kill you") > score("I will not kill you")
    assert score("BLARGON!! x") > 0.2
    assert score("ablargon blar") == clean
    assert score("not today. an idiot") == score("an idiot")
    assert score("idiot " * 5000) <= 1.0


def labelled(folder):
    return dict(duckdb.connect().execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())


def test_held_out_accuracy(spark):
    rows = t.op8_toxicity(spark, FOLDER).collect()
    labels = labelled(FOLDER)
    assert len(rows) == 10_000
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    toxic = [p for p, y in held if y]
    clean = [p for p, y in held if not y]
    assert sum(toxic) >= 0.8 * len(toxic)
    assert sum(clean) <= 0.03 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = t.id_remainder("doc_id", t.FOLDS) == 0
    other = labels.withColumn("toxic", t.F.when(held, 1 - t.F.col("toxic")).otherwise(t.F.col("toxic")))
    assert t.learn(documents, labels) == t.learn(documents, other)


def test_odd_documents(spark, tmp_path):
    folder = saved(odd_documents(spark), tmp_path)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (5, 0, 1, "x"), (6, 1, None, "x"), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, text string")
    saved(labels, tmp_path, "labels")
    rows = t.op8_toxicity(spark, folder).collect()
    assert len(rows) == odd_documents(spark).count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {True}


def test_no_documents_and_no_labels(spark, tmp_path):
    saved(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    assert t.op8_toxicity(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_weights_keep_the_order_of_the_readings():
    found = t.ordered({"I": 2.7, "J": 2.4, "i": 3.0, "r": 0.1, "H": 1.0, "K": 0.2, "h": 0.0, "s": 5.0})
    assert found["J"] > found["I"] >= found["i"] and found["r"] == 0.1
    assert found["K"] > found["H"] >= found["s"]


def test_learned_weights_read_clauses_not_bags_of_words(spark):
    model = t.learn(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert model.weights["J"] > model.weights["I"] >= max(model.weights["i"], model.weights["r"])
    words = ["you", "are", "a", "moron", "said", "the", "other", "man", "today"]
    scores = {model.score(" ".join(words[k:] + words[:k])) for k in range(len(words))}
    assert len(scores) > 1  # the same words in other orders
    assert model.score("you moron") > model.score("a moron") >= model.score("he said that a moron came")
