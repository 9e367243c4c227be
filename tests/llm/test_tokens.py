import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, whole
from tokenizers import Tokenizer

from noteloom.llm.tokens import ByteEncoder, WordEncoder, as_ids

KINDS = {ByteEncoder: "byte_bpe_50k.json", WordEncoder: "word_bpe_49k.json"}
TRICKY = [
    "", " ", "a  b", " x", "x ", "a\n b", "a \nb", "foo\n\n bar", "a\nb\nc", "\na", "a\n", "a  b　c", "À é x",
    "tab\tx  y\r\n z", "don't  we'll I'M", "İstanbul ΣΑΣ ς", "a   b", "<|endoftext|> x", "x² Ⅷ _a_ 12ab",
    "## —dash— (a,b;c)", *[t for t in TEXTS.values() if t],
]


@pytest.fixture(scope="module", params=KINDS, ids=lambda k: k.__name__)
def both(request):
    path = public_tokenizers.path(KINDS[request.param])
    return request.param(path, memo=2000), Tokenizer.from_file(path)


def same(both, text):
    encode, tokenizer = both
    return as_ids(encode(text)).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_tricky_texts(both):
    assert [t for t in TRICKY if not same(both, t)] == []


def test_real_texts_with_a_memo_that_overflows(both):
    assert [i for i, t in whole("/root/testdata/sf0.001") if t and not same(both, t)] == []


def test_together_as_one_by_one(both):
    encode, _ = both
    assert encode.many(TRICKY) == [encode(t) for t in TRICKY]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB1 \n\t.,'séß中_$ ́")), max_size=40))
def test_any_text(both, text):
    assert same(both, text)


def test_frequent_pieces_are_learned_once_and_looked_up_once_for_all_texts(monkeypatch):
    encode = WordEncoder(public_tokenizers.path("word_bpe_49k.json"), memo=60)
    learned = []
    plain = encode._learn
    monkeypatch.setattr(encode, "_learn", lambda pieces: learned.extend(pieces) or plain(pieces))
    letters = "abcdefghij"
    for first in letters:
        texts = [f"often {first}{second}rare often" for second in letters]
        assert encode.many(texts) == [encode.plain(text) for text in texts]
    assert learned.count("often") == 1
    assert len(learned) == 101
    assert len(encode.memo) + len(encode.older) <= 100
