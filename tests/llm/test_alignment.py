import base64
import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import LONG, TEXTS, no_documents, odd_documents, saved, whole

from noteloom.llm import alignment as al
from noteloom.llm import csr

FOLDER = "/root/testdata/sf0.01"
A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def tool():
    return al.Aligner(A, B)


class Plain:
    """Whole texts by other libraries and entries, and links by comparing ranges."""

    def __init__(self):
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text)
        a_bytes, b_bytes = [self.a.decode_single_token_bytes(i) for i in a], [self.piece(i) for i in b]
        if not b"".join(a_bytes) == (" " + text).encode() == b"".join(b_bytes):
            return [], []
        return self.ranged(a, a_bytes), self.ranged(b, b_bytes)

    @staticmethod
    def ranged(ids, parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return [(i, e - len(p), e) for i, p, e in zip(ids, parts, ends, strict=True)]

    def links(self, text):
        a, b = self.tokens(text)
        found, first = [], 0
        for x, (_, low, high) in enumerate(a):
            while first < len(b) and b[first][2] <= low:
                first += 1
            y = first
            while y < len(b) and b[y][1] < high:
                found.append((x, y, min(high, b[y][2]) - max(low, b[y][1])))
                y += 1
        return a, b, found

    def groups(self, text):
        a, b = self.tokens(text)
        ends = {t[2] for t in a} & {t[2] for t in b}
        sides = []
        for side in (a, b):
            held, parts = [], []
            for i, _, end in side:
                held.append(str(i))
                if end in ends:
                    parts.append(",".join(held))
                    held = []
            sides.append(parts)
        return ["|".join(x) for x in zip(*sides, strict=True)]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, rows):
    linked = {n: plain.links(text) for n, (_, text) in enumerate(rows)}
    counts = Counter()
    for a, b, links in linked.values():
        counts.update({(a[x][0], b[y][0]) for x, y, _ in links})
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    result = []
    for n, (doc, text) in enumerate(rows):
        a, b, links = linked[n]
        pairs = [(a[x][0], b[y][0]) for x, y, _ in links]
        groups = plain.groups(text)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        best = sum(counts[p] == most[p[0]] for p in pairs)
        result.append((doc, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in pairs), digest))
    return result


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_equals_comparing_all_ranges(spark, plain):
    folder = "/root/testdata/sf0.001"
    found = al.op11_alignment(spark, folder).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == sorted(expected(plain, whole(folder)))


def test_blocks_do_not_change_the_result(spark, monkeypatch, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    folder = saved(df, tmp_path)
    one = al.op11_alignment(spark, folder).collect()
    monkeypatch.setattr(al, "BLOCK", 500)
    other = al.op11_alignment(spark, folder).collect()
    assert sorted(one) == sorted(other)
    assert len(one) == 60


HARD = [
    "a  b", "a b ", " a", "\n", "\na", "a \n b", "a\tb\t c", "a\t \tb", "don't  we'll", "<|endoftext|> x<|endoftext|>", "<s>x</s> <unk>",
    "<0x41> A", "\x00 \x01a", "x \u2581y z", "\u3000\u3000 x", "a\u00a0 b", "caf\u00e9 \u6f22\u5b57\U0001f600 \u00f1", "1234567 890", "\r\n a\r\nb",
    "  ", " \n x", "\u200b x", "\ufeffx", "e\u0301 x", "x\x1c y", "x\x85 y \u2028z",
]


@pytest.mark.parametrize("text", [*HARD, LONG[:30_000], "ab\n" * 500, "q" * 5000])
def test_units_give_the_tokens_of_whole_texts(tool, plain, text):
    (entries,) = tool.documents([text])
    assert ";".join(e[0] for e in entries or []) == ";".join(plain.groups(text))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1.'s \n\t\u00a0\u00e9\u6f22\u2581"), max_size=25))
def test_any_text_is_cut_right(text):
    tool, plain = al.aligner(A, B), PLAIN
    (entries,) = tool.documents([text])
    assert ";".join(e[0] for e in entries or []) == ";".join(plain.groups(text))


PLAIN = Plain()


def test_links_and_groups_of_documents(spark, plain):
    rows = al.align(spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)).collect()
    texts = dict(whole(FOLDER))
    for row in rows:
        a, b, links = plain.links(texts[row["doc_id"]])
        assert row["a_ids"] == [i for i, *_ in a]
        assert row["b_ids"] == [i for i, *_ in b]
        assert [tuple(x) for x in row["links"]] == links
        assert len(row["groups"]) == len(plain.groups(texts[row["doc_id"]]))


def test_links_within_groups(tool):
    (entries,) = tool.documents(["unbelievably \u6f22\u5b57 tokenizations"])
    want = sum((a.count(",") + 1) * (b.count(",") + 1) for e in entries for a, b in [g.split("|") for g in e[0].split(";")])
    assert sum(e[4] for e in entries) == want


def test_product_of_any_matrices():
    rng = np.random.default_rng(5)
    for rows, middle, columns in [(4, 6, 5), (1, 1, 1), (0, 3, 2), (3, 0, 2), (7, 9, 0)]:
        left, right = (np.where(rng.random(shape) < 0.4, rng.integers(1, 9, shape), 0) for shape in ((rows, middle), (middle, columns)))
        got = csr.product(sparse(left), sparse(right))
        assert (got.dense() == left @ right).all()
        assert (sparse(left).transposed().dense() == left.T).all()


def sparse(dense):
    row, column = np.nonzero(dense)
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=dense.shape[0]))]).astype(np.int64)
    return csr.Csr(starts, column.astype(np.int64), dense[row, column], dense.shape[1])


def test_odd_documents(spark, tmp_path, plain):
    df = odd_documents(spark)
    found = al.op11_alignment(spark, saved(df, tmp_path)).select(*COLUMNS).collect()
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(expected(plain, rows), key=key)
    assert {r["groups_sha256"] for r in found if r["doc_id"] in (2, 3)} == {""}
    assert len(TEXTS[8]) > 100_000


def test_no_documents(spark, tmp_path):
    assert al.op11_alignment(spark, saved(no_documents(spark), tmp_path)).collect() == []
    assert al.align(no_documents(spark)).collect() == []
