import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from odd import no_documents, odd_documents, saved, whole

from noteloom.llm import lm
from noteloom.llm.attention import CHUNK, Attention

SMALL = "/root/testdata/sf0.001"


def small_model(size=3):
    rng = np.random.default_rng(4)
    model = Attention(np.arange(8), np.array([0, 1, 1, 2, 3, 4, 5, 6]), 7, first_start=2, size=size)
    model.weights = {k: rng.normal(size=v.shape) for k, v in model.weights.items()}
    return model


def texts_of(rng, *sizes):
    parts = [np.append(rng.integers(0, 6, n - 1), 6) for n in sizes]
    return np.concatenate(parts), np.cumsum([0] + [len(p) for p in parts[:-1]])


def test_gradients():
    model = small_model()
    read, wanted, rows, _ = model.chunked(*texts_of(np.random.default_rng(0), 5, 20, 40))
    _, grads = model._loss(read, wanted, rows)
    for name, grad in grads.items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        sides = []
        for step in (1e-5, -2e-5):
            model.weights[name][at] += step
            sides.append(model._loss(read, wanted, rows)[0])
        model.weights[name][at] += 1e-5
        assert grad[at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-3, abs=1e-7)


def test_sums_of_gradients():
    model = small_model()
    read, wanted, rows, _ = model.chunked(*texts_of(np.random.default_rng(0), 5, 20, 1, 40))
    _, grads = model._loss(read, wanted, rows)
    real = wanted >= 0
    aims, blank = model.classes[np.where(real, wanted, 0)], (read == model.start).any(axis=1)
    sums = model._sums(read, model.inputs[read], aims, real, blank, rows)
    for name, values in sums.items():
        assert np.allclose(values / real[rows].sum(), grads[name], atol=1e-6)
    assert sums.keys() | {"table"} == grads.keys()


def test_class_probabilities_sum_up_to_one_and_start_is_their_part():
    model = small_model()
    ids, starts = texts_of(np.random.default_rng(1), 30)
    for place in (0, 7, 29):
        sums = parts = 0.0
        for other in (0, 1, 3, 4, 5, 6, 7):  # one id of each class
            changed = ids.copy()
            changed[place] = other
            of_class, of_start = model.log_chances(changed, starts)
            sums += math.exp(of_class[place])
            parts += math.exp(of_class[place]) * (model.classes[other] >= model.first_start)
        assert sums == pytest.approx(1, rel=1e-5)
        assert parts == pytest.approx(math.exp(of_start[place]), rel=1e-5)


def test_only_what_came_before_matters_and_texts_do_not_mix():
    model = small_model()
    rng = np.random.default_rng(2)
    ids, starts = texts_of(rng, 50, 33, 1, 17)
    of_class, _ = model.log_chances(ids, starts)
    changed = ids.copy()
    changed[40:] = np.where(changed[40:] == 6, 6, (changed[40:] + 1) % 6)
    assert np.array_equal(model.log_chances(changed, starts)[0][:40], of_class[:40])
    for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
        alone = model.log_chances(ids[start:end], np.array([0]))[0]
        assert np.allclose(alone, of_class[start:end], atol=1e-6)


def test_context_reaches_a_chunk_back():
    model = small_model()
    ids = np.append(np.zeros(60, dtype=np.int64), 6)
    before = model.log_chances(ids, np.array([0]))[0]
    ids[59 - CHUNK] = 3
    assert model.log_chances(ids, np.array([0]))[0][59] != before[59]


def brute(rows):
    words = []
    for doc_id, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        held = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0
        words.append((doc_id, held, [*re.findall(r"[^\x20\x09-\x0D]+", text), None]))
    counts = Counter(w for _, held, ws in words if not held for w in ws)
    n, v = sum(counts.values()), len(counts)
    result = []
    for doc_id, held, ws in words:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        result.append((doc_id, held, len(ws), sum(counts[w] > 0 for w in ws), n, round(base, 6)))
    return sorted(result, key=repr)


def digest(rows):
    return sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in rows), key=repr)


def test_base(spark):
    rows = lm.op6_lm(spark, SMALL).collect()
    assert digest(rows) == brute(whole(SMALL))
    assert all(r["score"] < 0 for r in rows)


def test_blocks_of_any_size_give_the_same_base(spark, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_WORDS", 500)
    monkeypatch.setattr(lm, "GROUP_WORDS", 300)
    assert digest(lm.op6_lm(spark, SMALL).collect()) == brute(whole(SMALL))


def test_model_predicts_held_out_texts_better_than_the_base(spark):
    rows = [r for r in lm.op6_lm(spark, "/root/testdata/sf0.1").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_odd_documents(spark, tmp_path):
    df = odd_documents(spark)
    rows = lm.op6_lm(spark, saved(df, tmp_path)).collect()
    assert digest(rows) == brute([(r["doc_id"], r["text"]) for r in df.collect()])
    assert all(math.isfinite(r["score"]) for r in rows)


def test_held_out_rows_only(spark, tmp_path):
    df = odd_documents(spark).where("doc_id is null")
    rows = lm.op6_lm(spark, saved(df, tmp_path)).collect()
    assert digest(rows) == brute([(r["doc_id"], r["text"]) for r in df.collect()])


def test_no_documents(spark, tmp_path):
    assert lm.op6_lm(spark, saved(no_documents(spark), tmp_path)).collect() == []


def test_over_long_words(spark, tmp_path):
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
    long = [rng.choice(letters, 300_000).tobytes().decode() for _ in range(2)]
    held = next(i for i in range(20, 99) if zlib.crc32(str(i).encode()) % 10 == 0)
    rows = [(held, f"word {long[0]} word"), (held + 100, f"word {long[1]} word"), (1, "word and word"), (2, "and")]
    assert zlib.crc32(str(held + 100).encode()) % 10 != 0
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.op6_lm(spark, saved(df, tmp_path)).collect()
    assert digest(found) == brute(rows)
    score = {r["doc_id"]: r["score"] for r in found}
    assert all(math.isfinite(s) for s in score.values())
    assert score[held] < -100_000  # more than 65,535 ids that no training word explains


@pytest.mark.parametrize("limit", [400_000, 30])
def test_ids_of_words_learned_together_are_those_of_each(monkeypatch, limit):
    import public_tokenizers

    monkeypatch.setattr(lm, "MEMO", limit)
    encode = lm.ByteEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    memo = lm._Memo(encode)
    odd = ["a", "bc", "bc,", "bc.", "bc...", "don't", "555-4124", "a1b2", ",", "...", "\u00e4\u00f6", "\u0120x", "\ud83d\ude00".encode("utf-16", "surrogatepass").decode("utf-16")]
    white = ["a\u00a0b", "\u3000", "\u2003x", "x\u0085", "\x1c", "y\x1f"]
    marks = ["\x00", "\x00a", "<|endoftext|>", "a<|endoftext|>b", "\u200b", "\ufeffb"]
    asked = ["longerwords" + chr(97 + i) for i in range(26)]
    for words in (odd, asked, [*odd[2:], *white], [*asked, *marks], ["bc!"], []):
        words = [w.encode("utf-8") for w in words]
        ids, sizes = memo(words)
        each = [encode.plain(" " + w.decode("utf-8")) for w in words]
        assert sizes.tolist() == [len(e) // 4 for e in each]
        assert ids.astype("<u4").tobytes() == b"".join(each)
    assert limit > 30 or len(memo.numbers) <= len(asked) + len(marks) + 30


def test_chances_do_not_follow_how_many_rows_are_worked_on_at_once():
    model = small_model()
    ids, starts = texts_of(np.random.default_rng(6), 70, 1, 300, 33)
    for found, other in zip(model.log_chances(ids, starts), model.log_chances(ids, starts, 2), strict=True):
        assert np.allclose(found, other, atol=1e-6)


def subwords(tokenizer, text):
    """Ids of each word of a text by itself, and the end."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [tokenizer.encode(" " + w, add_special_tokens=False).ids for w in words] + [[tokenizer.get_vocab_size()]]


def place_by_place(model, ids):
    """Log probabilities of the classes at every place of one text, from the definition of a window."""
    w, read = model.weights, [model.start, *ids[:-1]]
    result = []
    for at in range(len(ids)):
        low = max(at // CHUNK * CHUNK - CHUNK, 0)
        window = range(low, at + 1) if at else [0]
        window = [j for j in window if j == at or read[j] != model.start]
        number = model.inputs[[read[j] for j in window]]
        query = w["query"][model.inputs[read[at]]].astype(float)
        weights = np.exp(w["key"][number] @ query + w["distance"][[at - j for j in window]])
        logits = (weights / weights.sum()) @ w["value"][number] @ w["out"] + w["table"][model.classes[read[at]]]
        result.append(logits - np.log(np.exp(logits).sum()))
    return np.array(result)


def brute_scores(model, tokenizer, rows):
    texts = {key: subwords(tokenizer, text) for key, text in enumerate(t for _, t in rows)}
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    train = [tuple(word) for key, words in texts.items() if not held[key] for word in words]
    of_word, of_id, starting = Counter(train), Counter(i for w in train for i in w), Counter(w[0] for w in train)
    of_class = Counter()
    for i, c in enumerate(model.classes[:-1].tolist()):
        of_class[c] += of_id[i] + lm.SMOOTH
    share = lambda i: (of_id[i] + lm.SMOOTH) / of_class[model.classes[i]]
    scores = []
    for words in texts.values():
        ids = [i for w in words for i in w]
        chances = place_by_place(model, ids)
        start = np.log(np.exp(chances[:, model.first_start :]).sum(axis=1))
        total, at = 0.0, 0
        for k, word in enumerate(words):
            total += chances[at][model.classes[word[0]]] + math.log(share(word[0])) - (start[at] if k else 0)
            rest = sum(chances[at + j][model.classes[i]] + math.log(share(i)) for j, i in enumerate(word) if j)
            at += len(word)
            last = k == len(words) - 1
            known = lm.KNOWN * (1 if last else of_word[tuple(word)] / max(starting[word[0]], 1))
            total += math.log((1 - lm.KNOWN) * math.exp(rest + (0 if last else start[at])) + known)
        scores.append(total / math.log(10))
    return scores, texts, held


def test_scores_and_what_the_model_gathers_from_all_training_texts(spark, tmp_path, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, text[:1500]) for i, text in whole(SMALL)[:60]] + [(900, ""), (901, None), (902, "Once"), (None, "once upon")]
    monkeypatch.setattr(lm, "SAMPLE", 5)  # the counts do not follow the sample
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(lm, "GROUP_WORDS", 150)
    used = []
    plain = lm.fit
    monkeypatch.setattr(lm, "fit", lambda *args: used.append(plain(*args)) or used[0])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in lm.op6_lm(spark, saved(df, tmp_path)).collect()}
    model = used[0]
    scores, texts, held = brute_scores(model, tokenizer, rows)
    for (doc_id, _), score in zip(rows, scores, strict=True):
        assert found[doc_id] == pytest.approx(score, rel=1e-5, abs=1e-4)
    pairs = np.zeros((lm.CLASSES, lm.CLASSES))
    for key, words in texts.items():
        if not held[key]:
            ids = [model.start, *(i for w in words for i in w)]
            np.add.at(pairs, (model.classes[ids[:-1]], model.classes[ids[1:]]), 1)
    column = pairs.sum(axis=0) + 1
    smooth = pairs + 5 * column / column.sum()
    assert np.allclose(model.weights["table"], np.log(smooth / smooth.sum(axis=1, keepdims=True)), atol=1e-5)
    met = {i for key, words in texts.items() if not held[key] for w in words[:-1] for i in w}
    absent = {(lm.CLASSES - 4) // 2, lm.CLASSES - 3}
    assert {i for i, c in enumerate(model.classes[:-2].tolist()) if c not in absent} == met


@pytest.mark.parametrize("blocks", [[3] * 32, [1] * 31 + [90], [2, 4, 3] * 20, [1], []])
def test_blocks_are_dealt_out_evenly(spark, blocks):
    numbers = [(scan << 24 | k, 0) for scan, n in enumerate(blocks) for k in range(n)]
    rows = spark.createDataFrame(numbers, "block long, kind int")
    slices, slot = lm.slots(rows)
    assert 2 * slices >= len(numbers)
    held = Counter(r[0] for r in rows.select(slot).collect())
    assert max(held.values(), default=0) <= -(-len(numbers) // slices) + 2
    assert all(0 <= s < slices for s in held)


def test_neighbours_of_ids(spark, tmp_path):
    """The sketch is linear in the counts of pairs, whatever blocks they come from."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    n_ids = tokenizer.get_vocab_size()
    rows = [(i, "a bc a strange antidisestablishmentarianism bc a") for i in range(1, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = lm.neighbours(lm.blocks(df, "doc_id", "text", path, n_ids), n_ids)
    trained = sum(zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows)
    ids = [n_ids + 1, *(i for w in subwords(tokenizer, rows[0][1]) for i in w)]
    after, before = Counter(ids[:-1]), Counter(ids[1:])
    for i in set(ids):
        sums = np.abs(found[i]).reshape(2, -1).sum(axis=1)
        assert sums[0] <= trained * after[i] and sums[1] <= trained * before[i]
        assert (sums > 0).tolist() == [after[i] > 0, before[i] > 0]
    assert not found[[i for i in range(n_ids + 2) if i not in set(ids)]].any()


def test_attention_is_learned_from_every_id_of_all_training_texts(spark, tmp_path, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(i, text[:1500]) for i, text in whole(SMALL)[:60]] + [(900, ""), (901, None), (None, "once upon")]
    monkeypatch.setattr(lm, "SAMPLE", 5)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(lm, "GROUP_WORDS", 60)
    texts, done = [], []
    plain = Attention.learn

    def learn(model, groups, n_ids, **rest):
        start = {k: v.copy() for k, v in model.weights.items()}
        groups = list(groups)
        texts.extend(tuple(t.tolist()) for ids, starts in groups for t in np.split(ids, starts[1:]))
        done.append((plain(model, groups, n_ids, **rest), {k: v.copy() for k, v in model.weights.items()}))
        assert done[-1][0] == n_ids and (start["table"] == model.weights["table"]).all()
        assert (start["out"] != model.weights["out"]).any()
        return done[-1][0]

    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    n_ids = Tokenizer.from_file(path).get_vocab_size()
    blocks = lm.blocks(df, "doc_id", "text", path, n_ids)
    counts, _ = lm.id_counts(blocks, n_ids)
    classes = np.append(np.arange(n_ids) % 60, [62, 63])
    model = Attention(60 + classes, classes, lm.CLASSES, first_start=30)
    alone = Attention(60 + classes, classes, lm.CLASSES, first_start=30)
    assert lm.learned(blocks, model) == counts.sum()  # every training id, the ends among them
    files = [f.removeprefix("file:").replace("//", "/") for f in sorted(blocks.inputFiles())]
    for number, words, held in lm._whole_blocks(files):
        if held:
            own = Attention(60 + classes, classes, lm.CLASSES, first_start=30)
            learn(own, lm._groups_of(words, held), int(sum(words.sizes[lm._from_planes(p)].sum() for p in held)), seed=number)
    assert len(done) > 5
    tokenizer = Tokenizer.from_file(path)
    trained = [text for i, text in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    assert Counter(texts) == Counter(tuple(i for w in subwords(tokenizer, t) for i in w) for t in trained)
    for k, values in model.weights.items():
        mean = sum(n * w[k].astype(float) for n, w in done) / sum(n for n, _ in done)
        assert np.allclose(values, mean, atol=1e-5)
        assert k == "table" or not np.allclose(values, alone.weights[k], atol=1e-3)


def test_words_met_again_are_not_encoded_again_when_the_memo_is_full(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(lm, "MEMO", 30)
    memo = lm._Memo(lm.ByteEncoder(public_tokenizers.path("byte_bpe_50k.json")))
    encoded = []
    plain = memo._learn
    monkeypatch.setattr(memo, "_learn", lambda new: encoded.extend(new) or plain(new))
    letters = [chr(97 + i) for i in range(10)]
    for first in letters:
        words = [b"often", *((first + second + "rare").encode() for second in letters)]
        ids, sizes = memo(words)
        each = [memo.encode.plain(" " + w.decode()) for w in words]
        assert sizes.tolist() == [len(e) // 4 for e in each] and ids.astype("<u4").tobytes() == b"".join(each)
    assert encoded.count(b"often") == 1 and len(encoded) == 101


def test_sums_of_gradients_do_not_follow_how_many_rows_are_worked_on_at_once():
    model = small_model()
    read, wanted, rows, _ = model.chunked(*texts_of(np.random.default_rng(8), 70, 1, 300, 33))
    real = wanted >= 0
    given = read, model.inputs[read], model.classes[np.where(real, wanted, 0)], real, (read == model.start).any(axis=1)
    whole = model._sums(*given, rows)
    for at_once in (1, 3, len(rows)):
        for name, values in model._sums(*given, rows, at_once).items():
            assert np.allclose(values, whole[name], atol=1e-9)


def test_words_of_letters_are_cut_without_the_pattern_of_the_vocabulary(monkeypatch):
    import public_tokenizers

    memo = lm._Memo(lm.ByteEncoder(public_tokenizers.path("byte_bpe_50k.json")))
    words = [b"words", b"antidisestablishmentarianism", b"qzx", b"s", *((chr(97 + i // 26) + chr(97 + i % 26)).encode() for i in range(600))]
    each = [memo.encode.plain(" " + w.decode()) for w in words]
    asked = []
    plain = SimpleNamespace(encode_batch_fast=lambda texts, **_: asked.extend(texts) or [])
    monkeypatch.setattr(memo.encode, "tokenizer", plain)
    ids, sizes = memo(words)
    assert sizes.tolist() == [len(e) // 4 for e in each] and ids.astype("<u4").tobytes() == b"".join(each)
    assert not asked
