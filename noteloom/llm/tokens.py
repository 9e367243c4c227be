"""Token ids of public tokenizers, with a bounded memo of the pieces that texts are made of.

Merges never cross the places where a tokenizer cuts a text first, so a text's ids are those of
its pieces in order. Each piece still goes through the tokenizers library; a piece seen before
is looked up. The memo of a worker is emptied when it is full.
"""

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from noteloom.llm.common import worker_state

MEMO_PIECES = 800_000
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class Encoder:
    """Ids of whole texts as little-endian unsigned integers in bytes, of 32 bits or, if
    ``narrow``, of 16 where the vocabulary allows."""

    def __init__(self, path: str, memo: int = MEMO_PIECES, narrow: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if narrow and self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.memo, self.tails, self.starts, self.limit = {}, {}, {}, memo

    def _learn(self, pieces: set[str]) -> None:
        """A word and the punctuation after it are cut apart anyway, so each is learned once."""
        memo, other, split = self.memo, [], []
        words: set[str] = set()
        starts: set[str] = set()  # words that stand after a mark
        for piece in pieces:
            word = piece.rstrip(PUNCTUATION)
            marked = word[:1] in self.marks
            if not (word[1:] if marked else word).isalpha():
                other.append(piece)
                continue
            if word not in memo:
                (starts if marked else words).add(word)
            if len(word) < len(piece):
                split.append((piece, word))
        self._learn_words(list(words), *self.between)
        if starts:
            self._learn_words(list({word[1:] for word in starts}), "", "\n", 2, self.starts)
            memo.update((word, self.marks[word[0]] + self.starts[word[1:]]) for word in starts)
            self.starts.clear()
        for piece in other:
            memo[piece] = self.plain(self.spelled(piece))
        for piece, word in split:
            tail = piece[len(word) :]
            if tail not in self.tails:
                self.tails[tail] = self.plain(tail)
            memo[piece] = memo[word] + self.tails[tail]

    def _learn_words(self, words: list[str], before: str, between: str, step: int, into: dict | None = None) -> None:
        """Encode words as one text and deal its ids out by the place of the word each belongs to.

        A word and what separates it from the next take ``step`` places.
        """
        into = self.memo if into is None else into
        for i in range(0, len(words), 512):
            part = words[i : i + 512]
            found = self.tokenizer.encode(before + between.join(part), add_special_tokens=False)
            numbers = np.array(found.word_ids, dtype=np.int64)
            ids = np.array(found.ids, dtype=self.kind).tobytes()
            if not len(numbers) or numbers[-1] != step * (len(part) - 1):
                into.update((word, self.plain(before + word)) for word in part)  # some word was cut in another way
                continue
            at = step * np.arange(len(part))
            low = (self.width * np.searchsorted(numbers, at)).tolist()
            high = (self.width * np.searchsorted(numbers, at, side="right")).tolist()
            into.update((word, ids[a:b]) for word, a, b in zip(part, low, high, strict=True))

    # What stands before words that are encoded together and between them, and the places that a
    # word takes; and the ids of what a first character of a piece stands for, where it is a mark.
    between: tuple[str, str, int] = ("", " ", 1)
    marks: dict[str, bytes] = {}

    def spelled(self, piece: str) -> str:
        """The text that a piece stands for."""
        return piece

    def each(self, *lists: list[str]) -> list[list[bytes]]:
        """Ids of every piece of lists of pieces; new pieces of all lists are learned together."""
        found = [list(map(self.memo.get, pieces)) for pieces in lists]
        gaps = [[i for i, part in enumerate(parts) if part is None] if None in parts else [] for parts in found]
        missing = {pieces[i] for pieces, places in zip(lists, gaps, strict=True) for i in places}
        if missing:
            if len(self.memo) + len(missing) > self.limit:
                self.memo.clear()
                self.tails.clear()
            self._learn(missing)
            memo = self.memo
            for pieces, parts, places in zip(lists, found, gaps, strict=True):
                for i in places:
                    parts[i] = memo[pieces[i]]
        return found

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.kind).tobytes()

    def pieces(self, text: str) -> list[str] | None:
        raise NotImplementedError

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of every text."""
        lists = [self.pieces(t) if t and "<|" not in t else None for t in texts]
        found = iter(self.each(*[pieces for pieces in lists if pieces is not None]))
        return [
            (self.plain(text) if text else b"") if pieces is None else b"".join(next(found))
            for text, pieces in zip(texts, lists, strict=True)
        ]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


class ByteEncoder(Encoder):
    """Byte-level BPE whose words carry the space before them.

    A single space after something that is no space always starts a new piece, and a single
    line break between other characters is one. In the memo a piece stands without its space;
    one that starts a line stands with the break before it, one that starts a text with ``FIRST``.
    Texts where white space stands together or at an end are encoded as a whole.
    """

    FIRST = "\x00"
    between = (" ", " ", 1)

    def __init__(self, path: str, memo: int = MEMO_PIECES, narrow: bool = False):
        super().__init__(path, memo, narrow)
        self.marks = {"\n": self.plain("\n"), self.FIRST: b""}

    def pieces(self, text: str) -> list[str] | None:
        if "  " in text or "\n\n" in text or "\n " in text or " \n" in text or self.FIRST in text:
            return None
        if text[0] in " \n" or text[-1] in " \n":
            return None
        return (self.FIRST + text.replace("\n", " \n")).split(" ")

    def spelled(self, piece: str) -> str:
        if piece[:1] in self.marks:
            return piece.removeprefix(self.FIRST)
        return " " + piece

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of words, each with a space before it."""
        (found,) = self.each(words)
        return [
            self.plain(" " + word) if word[:1] in self.marks else ids for word, ids in zip(words, found, strict=True)
        ]


class WordEncoder(Encoder):
    """BPE on lower-cased words without white space: any white space ends a piece, and A-Z can be
    put in lower case before.

    No character combines with a space, so normal forms do not cross one either. Texts are cut and
    their different pieces found in Arrow, and each of these is looked up once. A memo that is half full
    becomes the older one; pieces asked for again move on from it, so frequent ones stay.
    """

    def __init__(self, path: str, memo: int = MEMO_PIECES, narrow: bool = False):
        super().__init__(path, memo, narrow)
        self.older: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        return text.encode().lower().decode().replace("\n", " ").split(" ")

    def _known(self, pieces: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        if len(self.memo) >= self.limit // 2:
            self.older = self.memo if len(self.memo) <= self.limit else {}
            self.memo = {}
            self.tails.clear()
        memo, older = self.memo, self.older
        found = list(map(memo.get, pieces))
        gaps = [i for i, part in enumerate(found) if part is None] if None in found else []
        missing = set()
        for i in gaps:
            piece = pieces[i]
            part = older.get(piece)
            if part is None:
                missing.add(piece)
            else:
                memo[piece] = found[i] = part
        if missing:
            self._learn(missing)
            for i in gaps:
                if found[i] is None:
                    found[i] = memo[pieces[i]]
        return found

    def many(self, texts: list[str]) -> list[bytes]:
        """As for any encoder, with one look-up for each different piece of all texts."""
        whole = [bool(t) and "<|" in t for t in texts]
        cut = pa.array(["" if w else t or "" for t, w in zip(texts, whole, strict=True)], pa.large_string())
        cut = pc.split_pattern(pc.replace_substring(pc.ascii_lower(cut), "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(coded.indices)
        _, places, data = ids.buffers()
        ends = np.frombuffer(places, "<i8", len(ids) + 1)[cut.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = data.to_pybytes() if data else b""
        return [
            self.plain(text) if w else data[low:high]
            for text, w, low, high in zip(texts, whole, ends, ends[1:], strict=False)
        ]


def encoder(kind: type[Encoder], path: str, narrow: bool = False, memo: int = MEMO_PIECES) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    kept = worker_state("encoders", dict)
    key = (kind.__name__, path, narrow, memo)
    if key not in kept:
        kept[key] = kind(path, memo, narrow)
    return kept[key]


def in_groups(rows, place: int = -1, characters: int = 400_000):
    """Rows as lists that hold about so many characters of text (the value at ``place``)."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += len(row[place]) + 100
        if weight >= characters:
            yield held
            held, weight = [], 0
    if held:
        yield held


def as_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
