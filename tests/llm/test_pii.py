import functools
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import no_documents, odd_documents, saved, whole

from noteloom.llm import crf, pii

FOLDER = "/root/testdata/sf0.1"


def plain_base(text):
    """The four patterns as they are stated."""
    found = []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0])):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a.@-+1250 ()%é_")), max_size=40))
def test_base_as_stated(text):
    assert pii.base_spans(text) == plain_base(text)


def test_base_of_real_texts():
    for _, text in whole("/root/testdata/sf0.001"):
        assert pii.base_spans(text or "") == plain_base(text or "")


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "@" * 100_000, "9 " * 100_000])
def test_hostile_texts_are_quick(text):
    pii.base_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_gradients():
    rng = np.random.default_rng(0)
    model = crf.Tagger(5, 4, 3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    ids = rng.integers(1, 99, (3, 7))
    ids[1, 5:] = 0
    tags = rng.integers(0, 5, (3, 7))
    _, grads = model._loss(ids, tags)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        sides = []
        for step in (1e-4, -2e-4):
            model.weights[name][at] += step
            sides.append(model._loss(ids, tags)[0])
        model.weights[name][at] += 1e-4
        assert grad[at] == pytest.approx((sides[0] - sides[1]) / 2e-4, rel=2e-3)


def test_decoding_as_all_paths():
    rng = np.random.default_rng(1)
    scores, first, trans = rng.normal(size=(2, 5, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    live = np.ones((2, 5), dtype=bool)
    live[1, 3:] = False
    paths, chances = crf.viterbi(scores, live, first, trans), crf.marginals(scores, live, first, trans)
    for row, length in ((0, 5), (1, 3)):
        value = {}
        for path in itertools.product(range(3), repeat=length):
            steps = sum(trans[a, b] for a, b in zip(path, path[1:], strict=False))
            value[path] = first[path[0]] + steps + sum(scores[row, t, k] for t, k in enumerate(path))
        assert tuple(paths[row, :length]) == max(value, key=value.get)
        total = sum(np.exp(v) for v in value.values())
        for t, k in itertools.product(range(length), range(3)):
            chance = sum(np.exp(v) for p, v in value.items() if p[t] == k) / total
            assert chances[row, t, k] == pytest.approx(chance)


@pytest.fixture(scope="module")
def model(spark):
    return pii.learn(spark.read.parquet(f"{FOLDER}/documents.parquet"))


def test_windows_reconciled_over_a_long_stretch(model):
    text = " ".join(f"nte {97 + i % 150}.{10 + i % 90}.17.173 ueadoos" for i in range(2000))
    (spans,) = pii.decode(model, [text])
    assert len({a for a, k, _ in spans if k == 1} & {a for a, k, _ in pii.base_spans(text)}) >= 1900


@functools.cache
def some_texts():
    return [text or "" for _, text in itertools.islice(whole(FOLDER), 300)]


def planted(seed, form, kind, n=100):
    """Texts of the corpus's words around one value each, with the value's span."""
    rng = np.random.default_rng(seed)
    words = np.array([w for text in some_texts() for w in text.split() if w.isalpha()])
    for _ in range(n):
        before, after = (" ".join(rng.choice(words, 8)) for _ in range(2))
        value = form(lambda n: "".join(map(str, rng.integers(0, 10, n))), lambda: str(rng.choice(words)).lower())
        start = len(before) + 1
        yield f"{before} {value} {after}", (start, kind, start + len(value))


WIDE = {ord("+"): 0xFF0B, **{48 + i: 0xFF10 + i for i in range(10)}}


@pytest.mark.parametrize(
    "kind, least, form",
    [
        (0, 0.5, lambda d, w: f"{w()}.{w()} (at) {w()}.com"),
        (1, 0.9, lambda d, w: "[.]".join(str(int(d(3)) % 256) for _ in range(4))),
        (2, 0.9, lambda d, w: ".".join(d(4) for _ in range(4))),
        (2, 0.9, lambda d, w: d(16).translate(WIDE)),
        (3, 0.9, lambda d, w: f"({d(3)}) {d(3)}-{d(4)}"),
        (3, 0.9, lambda d, w: f"+{d(2)} {d(3)} {d(3)} {d(3)}".translate(WIDE)),
    ],
)
def test_other_forms_are_found(model, kind, least, form):
    texts, spans = zip(*planted(kind, form, kind), strict=True)
    found = pii.all_spans(model, list(texts))
    met = [any(k == kind and a < span[2] and span[0] < b for a, k, b in every) for span, (_, every) in zip(spans, found, strict=True)]
    assert np.mean(met) >= least


def test_plain_words_are_left_alone(model):
    texts = [text for text, _ in planted(9, lambda d, w: f"{w()} at {w()}", 0)]
    assert pii.decode(model, texts) == [[] for _ in texts]


@pytest.mark.parametrize("kind, span", [(0, "ann@mail.net"), (1, "10.0.0.255"), (2, "4111 1111 1111 1111"), (3, "+44 20 7946 0199")])
def test_trained_forms_are_complete(kind, span):
    rng = np.random.default_rng(kind)
    forms = {pii.varied(rng, kind, span, ["cat", "dog2", "tree"]) for _ in range(200)}
    assert len(forms) > 3 and all(pii.complete(kind, form) for form in forms)


def test_query_keeps_the_base_and_adds(spark):
    rows = pii.op1_pii(spark, FOLDER).collect()
    texts = dict(whole(FOLDER))
    assert len(rows) == len(texts)
    added = missed = clean = 0
    for row in rows:
        text = texts[row["doc_id"]] or ""
        base = plain_base(text)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == n for x in base) for n in range(4)]
        assert row["base_sha256"] == pii.hashlib.sha256(pii.written(base).encode()).hexdigest()
        spans = row["spans"].split(",") if row["spans"] else []
        assert row["n_spans"] == len(spans)
        assert set(pii.written(base).split(",")) - {""} <= set(spans)
        added += len(spans) - len(base)
        if not re.search("[0-9@]", text):
            assert not spans
            clean += 1
        for m in re.finditer(r"(?<![0-9a-f])[0-9]{16}(?![0-9a-f])", text):
            missed += not any(a <= m.start() < b for a, b in (map(int, x.split(":")[1:]) for x in spans))
    assert added >= 5 * missed and clean


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    rows = pii.op1_pii(spark, saved(df, tmp_path)).collect()
    assert len(rows) == df.count()
    (six,) = [r for r in rows if r["doc_id"] == 6]
    assert (six["n_email"], six["n_ip"], six["n_card"], six["n_phone"]) == (1, 1, 0, 1)


def test_no_documents(spark, tmp_path):
    assert pii.op1_pii(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_no_labels_no_model(spark):
    assert pii.learn(odd_documents(spark).where("doc_id = 1")) is None


def test_mask(spark, model):
    df = odd_documents(spark)
    rows = pii.mask(df, model).collect()
    assert pii.mask(df, model).columns == df.columns
    (six,) = [r for r in rows if r["doc_id"] == 6]
    assert "[phone]" in six["text"] and "[email]" in six["text"] and "[ip]" in six["text"] and "0199" not in six["text"]
    assert six["n_chars"] == len(six["text"])
    (three,) = [r for r in rows if r["doc_id"] == 3]
    assert three["text"] is None and three["n_chars"] is None


def test_masked_spans_that_overlap():
    assert pii.masked("abcdefgh", [(1, 0, 4), (2, 3, 6)]) == "a[email]gh"
