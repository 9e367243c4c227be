"""Personal data in texts: email addresses, IP addresses, card and phone numbers.

The base is a set of exact patterns with checks. The method adds spans that these miss (a mistyped
card number, a phone number without its plus sign, an address with ``(at)`` for its at sign, digits
in full width): a character-level bidirectional LSTM with CRF transitions, trained on windows of a
bounded sample of documents whose base spans are the labels. Each text with base spans is trained on
a second time with its spans in another form (``VARIED``). Windows with a candidate that only failed
a check are left out of training, so the model does not learn the checks. All kinds need a digit, an
at sign or its name in letters; the model reads every stretch of a text around these, in overlapping
windows, whose scores are averaged with more weight on a window's middle, and one path is decoded
over the whole stretch. An added span must be likely (``LIKELY``), hold the parts of its kind
(``complete``), and meet no base span.

Edge cases: a null or empty text has no spans; a text of any length is read whole; if the sample
holds no base span nothing is added; rows without id are read like others; an empty table gives
no rows. Other columns are left as they are.
"""

import hashlib
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, fresh_name, rows_of, table
from noteloom.llm.crf import PAD, Tagger, char_ids, marginals, viterbi

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000  # documents whose windows may be trained on, by hash of id and text
WINDOWS = 4_000  # windows that are trained on, by smallest hash
WINDOW = 64  # characters
STRIDE = 32
CONTEXT = 24  # characters around a digit or at sign that belong to its stretch
LIKELY = 0.8
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind

# --- base patterns --------------------------------------------------------------------

_ANCHOR = re.compile("[0-9@]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can start inside a run of digits: it would also start at the run's first.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost matches, found from the at signs: the part before one is the run that ends there."""
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        after = _DOMAIN.match(text, at) if first < at else None
        if after:
            yield first, after.end()
            done = after.end()
        else:
            done = at + 1  # no match holds this sign, and a local part cannot reach over it
        at = text.find("@", max(done, at + 1))


def candidates(text: str):
    """(start, kind, end, passes its check) of every match, kind as a number."""
    if not _ANCHOR.search(text):
        return
    for first, last in _emails(text):
        yield first, 0, last, True
    for m in _IP.finditer(text):
        yield m.start(), 1, m.end(), all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) >= 14:  # shorter ones are not like cards at all
            yield m.start(), 2, m.end(), len(digits) <= 19 and luhn(digits)
    for m in _PHONE.finditer(text):
        yield m.start(), 3, m.end(), 10 <= len(_digits(m[0])) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), by start, then kind."""
    return sorted((a, k, b) for a, k, b, good in candidates(text) if good)


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- the model's spans ----------------------------------------------------------------


_WIDE = re.compile("[\uff01-\uff5e]")
_NARROW = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)}  # full-width forms of ASCII
_NEAR = re.compile(r"[0-9@]+|[(\[{] ?[aA][tT] ?[)\]}]|\b[aA][tT] (?=[A-Za-z0-9-]{1,63} [dD][oO][tT] )")


def narrow(text: str) -> str:
    """The text as the model reads it: full-width characters as their ASCII ones, place by place."""
    return text.translate(_NARROW) if not text.isascii() and _WIDE.search(text) else text


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within ``CONTEXT`` characters of a digit or at sign, merged."""
    found: list[list[int]] = []
    for m in _NEAR.finditer(text):
        first, last = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if found and first <= found[-1][1]:
            found[-1][1] = last
        else:
            found.append([first, last])
    return [(a, b) for a, b in found]


def window_starts(first: int, last: int) -> range:
    return range(first, max(first + 1, last - WINDOW + STRIDE), STRIDE)


# What stands for an at sign and a dot in an address that is written out.
_AT = re.compile(r" ?(?:@|[(\[{] ?at ?[)\]}]) ?| at ", re.I)
_DOT = re.compile(r" ?[(\[{] ?(?:dot|\.) ?[)\]}] ?| dot | ?\. ?", re.I)
_CARD_LIKE = re.compile(r"[0-9](?:[ ./_-]{0,3}[0-9]){12,18}")
_PHONE_LIKE = re.compile(r"(?:\(?\+|00)?\(?[0-9](?:[ ()./-]{0,3}[0-9]){6,14}")


def complete(kind: int, span: str) -> bool:
    """Whether a span has all the parts of its kind, whatever stands between them."""
    if kind == 2:
        return bool(_CARD_LIKE.fullmatch(span))
    if kind == 3:
        return bool(_PHONE_LIKE.fullmatch(span))
    parts = _DOT.split(span)
    if kind == 1:
        return len(parts) == 4 and all(1 <= len(p) <= 3 and p.isascii() and p.isdigit() for p in parts)
    sides = _AT.split(span)
    names = _DOT.split(sides[-1])
    return len(sides) == 2 and len(names) > 1 and all(p and not re.search(r"\s", p) for p in (sides[0], *names))


_EDGES = " \t\r\n.,;:!?|$%&*#\"'"


def _spans_of(text: str, offset: int, path: np.ndarray, likely: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of a decoded path that are likely enough and have the make-up of their kind."""
    found, i = [], 0
    while i < len(path):
        if not path[i]:
            i += 1
            continue
        kind, first = (int(path[i]) - 1) // 2, i
        i += 1
        while i < len(path) and path[i] == 2 * kind + 2:
            i += 1
        a, b = first, i
        while a < b and text[offset + a] in _EDGES:
            a += 1
        while b > a and text[offset + b - 1] in _EDGES:
            b -= 1
        # A number is one thing: a span that holds part of a run of digits holds all of it.
        while a and a < b and text[offset + a].isdigit() and text[offset + a - 1].isdigit():
            a -= 1
        while a < b < len(path) and text[offset + b - 1].isdigit() and text[offset + b].isdigit():
            b += 1
        if a < b and likely[a:b, kind].mean() >= LIKELY and complete(kind, text[offset + a : offset + b]):
            found.append((offset + a, kind, offset + b))
    return found


def _allowed() -> tuple[np.ndarray, np.ndarray]:
    """What forbids a path: an inside tag after anything but its own kind, or at the start."""
    trans, first = np.zeros((TAGS, TAGS), dtype=np.float32), np.zeros(TAGS, dtype=np.float32)
    for kind in range(len(KINDS)):
        inside = 2 * kind + 2
        trans[:, inside] = -1e4
        trans[[inside - 1, inside], inside] = 0
        first[inside] = -1e4
    return trans, first


def decode(model: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """Spans that the model finds in each text."""
    parts = [(n, a, b) for n, text in enumerate(texts) for a, b in stretches(text)]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    forbid_trans, forbid_first = _allowed()
    trans, start = model.weights["trans"] + forbid_trans, model.weights["first"] + forbid_first
    slope = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)
    # Stretches of like length together; a batch holds a bounded number of characters.
    parts.sort(key=lambda p: p[2] - p[1])
    at = 0
    while at < len(parts):
        longest = parts[at][2] - parts[at][1]
        end = at
        while end < len(parts) and end - at < 256 and (end == at or (end - at + 1) * (parts[end][2] - parts[end][1]) <= 1 << 16):
            longest = parts[end][2] - parts[end][1]
            end += 1
        group = parts[at:end]
        at = end
        scores = np.zeros((len(group), longest + WINDOW, TAGS), dtype=np.float32)
        weight = np.zeros((len(group), longest + WINDOW), dtype=np.float32)
        ids = np.full((len(group), longest + WINDOW), PAD, dtype=np.int64)
        places = []
        for row, (n, a, b) in enumerate(group):
            ids[row, : b - a] = char_ids(texts[n][a:b])
            places += [(row, w - a) for w in window_starts(a, b)]
        for i in range(0, len(places), 512):
            some = places[i : i + 512]
            windows = np.stack([ids[row, w : w + WINDOW] for row, w in some])
            got = model.emissions(windows) * slope[None, :, None]
            for (row, w), one in zip(some, got, strict=True):
                scores[row, w : w + WINDOW] += one
                weight[row, w : w + WINDOW] += slope
        # Sums over a long stretch need more digits than the network's own numbers have.
        scores = scores[:, :longest].astype(np.float64) / weight[:, :longest, None].clip(1)
        live = ids[:, :longest] != PAD
        path = viterbi(scores, live, start, trans)
        told = np.flatnonzero((path * live).any(1))
        if not len(told):
            continue
        chances = marginals(scores[told], live[told], start, trans)
        for row, chance in zip(told.tolist(), chances, strict=True):
            n, a, b = group[row]
            likely = chance[: b - a, 1::2] + chance[: b - a, 2::2]
            found[n] += _spans_of(texts[n], a, path[row, : b - a], likely)
    return found


def all_spans(model: Tagger | None, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of every text."""
    base = [base_spans(t) for t in texts]
    more = decode(model, [narrow(t) for t in texts]) if model else [[] for _ in texts]
    result = []
    for sure, added in zip(base, more, strict=True):
        new = [(a, k, b) for a, k, b in added if not any(a < d and c < b for c, _, d in sure)]
        result.append((sure, sorted(sure + new)))
    return result


# --- training -------------------------------------------------------------------------

_TRAINING = pa.schema([("window", pa.string()), ("tags", pa.binary())])


# Marks that stand between the parts of a span in its other form, by kind.
VARIED = {
    "at": (" (at) ", "(at)", "[at]", " [at] ", " at ", " @ "),
    "dot": (" (dot) ", "(dot)", "[dot]", ".", " dot ", "[.]"),
    "ip": ("[.]", "(.)", " . ", ". "),
    "card": (".", "/", "  ", "_", " - ", "-", " ", ""),
    "phone": (".", "/", " ", "-", " - ", ""),
    "prefix": ("", "", "00", "(+", "("),
    "ending": ("com", "org", "net", "edu", "info", "de", "fr"),
}


def varied(rng: np.random.Generator, kind: int, span: str, words: list[str]) -> str:
    """A base span in a form that the base patterns do not know; an address of words of its text."""
    pick = lambda name: VARIED[name][rng.integers(len(VARIED[name]))]
    if kind == 0:
        ending, at = pick("ending"), pick("at")
        dot = " dot " if at == " at " else pick("dot")
        some = [words[i] for i in rng.integers(len(words), size=4)]
        name = rng.choice([".", "_", "-", ""]).join(some[: rng.integers(1, 3)])
        return name + at + dot.join([*some[2 : rng.integers(3, 5)], ending])
    if kind == 1:
        return span.replace(".", pick("ip"))
    digits, mark = _digits(span), pick(KINDS[kind])
    if kind == 2:
        return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    prefix, cut = pick("prefix"), int(rng.integers(1, 4))
    close = ")" if "(" in prefix else mark
    rest = digits[cut:]
    return prefix + digits[:cut] + close + mark.join(rest[i : i + 3] for i in range(0, len(rest), 3))


def training_windows(text: str):
    """Windows of a text with their tags, but for those that hold a failed candidate; then the same
    of the text with its spans in other forms."""
    if not _ANCHOR.search(text):
        return
    tags = np.zeros(len(text), dtype=np.uint8)
    unclear = np.zeros(len(text), dtype=bool)
    spans = []
    for a, kind, b, good in candidates(text):
        if good and not tags[a:b].any():
            tags[a:b] = 2 * kind + 2
            tags[a] = 2 * kind + 1
            spans.append((a, kind, b))
        else:
            unclear[a:b] = True
    yield from _windows(text, tags, unclear)
    if not spans:
        return
    rng = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    words = re.findall("[A-Za-z0-9]{2,16}", text)
    texts, marks, doubts, done = [], [], [], 0
    for a, kind, b in sorted(spans):
        new = varied(rng, kind, text[a:b], words)
        texts += [text[done:a], new]
        marks += [tags[done:a], np.array([2 * kind + 1] + [2 * kind + 2] * (len(new) - 1), dtype=np.uint8)]
        doubts += [unclear[done:a], np.full(len(new), unclear[a:b].any())]
        done = b
    texts.append(text[done:])
    yield from _windows("".join(texts), np.concatenate((*marks, tags[done:])), np.concatenate((*doubts, unclear[done:])))


def _windows(text: str, tags: np.ndarray, unclear: np.ndarray):
    for first, last in stretches(text):
        for start in window_starts(first, last):
            end = min(start + WINDOW, last)
            if not unclear[start:end].any():
                yield text[start:end], tags[start:end].tobytes()


def learn(documents: DataFrame, text_column: str = "text", sample: int = SAMPLE, windows: int = WINDOWS) -> Tagger | None:
    """A model trained on at most ``windows`` windows of about ``sample`` documents.

    Documents are picked by a hash of their text, so copies of one are picked together; the
    windows that come to the driver are bounded.
    """
    texts = documents.select(F.col(text_column).cast("string").alias("text"))
    total = texts.count()
    if not total:
        return None
    picked = texts.where("text is not null")
    if total > sample:
        picked = picked.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * sample / total))

    def work(batches):
        yield from batches_of((w for (text,) in rows_of(batches, "text") for w in training_windows(text)), _TRAINING)

    rows = (
        picked.mapInArrow(work, "window string, tags binary")
        .distinct()
        .orderBy(F.xxhash64("window", "tags"), "window", "tags")
        .limit(windows)
        .toPandas()
    )
    ids = np.full((len(rows), WINDOW), PAD, dtype=np.int64)
    tags = np.zeros((len(rows), WINDOW), dtype=np.int64)
    for i, (window, marks) in enumerate(zip(rows["window"], rows["tags"], strict=True)):
        ids[i, : len(window)] = char_ids(window)
        tags[i, : len(window)] = np.frombuffer(bytes(marks), dtype=np.uint8)
    if not tags.any():
        return None
    model = Tagger(TAGS)
    model.fit(ids, tags, vary=_other_digits)
    return model


def _other_digits(rng: np.random.Generator, ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Labelled numbers with other digits: what makes them numbers of their kind is their form."""
    zero = char_ids("0")[0]
    digits = (tags > 0) & (ids >= zero) & (ids <= zero + 9)
    return np.where(digits, zero + rng.integers(0, 10, ids.shape), ids)


# --- Spark jobs -----------------------------------------------------------------------

_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def find(model: Tagger | None, text: Column) -> Column:
    """Struct of the counts and digest of base spans, all spans of a text column, and their number."""

    @F.pandas_udf(_FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for i in range(0, len(texts), 512):
            for base, every in all_spans(model, texts.iloc[i : i + 512].tolist()):
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(every), len(every)))
        return pd.DataFrame(rows, columns=[part.split()[0] for part in _FOUND.split(", ")])

    return found(F.coalesce(text.cast("string"), F.lit("")))


def masked(text: str, spans) -> str:
    """The text with every span, or run of spans that overlap, replaced by its first kind's name."""
    parts, done = [], 0
    for a, k, b in spans:
        if a >= done:
            parts += [text[done:a], f"[{KINDS[k]}]"]
        done = max(done, b)
    return "".join([*parts, text[done:]])


def mask(df: DataFrame, model: Tagger | None, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """``df`` with personal data masked in its texts, and the length brought up to date."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        kept = []
        for i in range(0, len(texts), 512):
            some = texts.iloc[i : i + 512].tolist()
            spans = all_spans(model, [t or "" for t in some])
            kept += [t and masked(t, every) for t, (_, every) in zip(some, spans, strict=True)]
        return pd.Series(kept, dtype=object)

    order, new = df.columns, fresh_name(df, "masked_text")
    changed = df.withColumn(new, clean(F.col(text_column).cast("string")))
    columns = []
    for name in order:
        column = F.col(name)
        if name == text_column:
            column = F.col(new)
        elif name == length_column:
            differs = ~F.col(new).eqNullSafe(F.col(text_column))
            column = F.when(differs, F.length(new).cast(df.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return changed.select(*columns)


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    documents = table(configure(spark), folder, "documents")
    model = learn(documents)
    return documents.select("doc_id", find(model, F.col("text")).alias("found")).select("doc_id", "found.*")
