"""Toxicity by a weighted finite-state grammar of clauses.

A text is cut into clauses and every word of a clause becomes a letter: insult, threat, target,
negation, report, or other. Five transducers are composed into one machine that rewrites these
letters: an insult or threat soon after a negation is a denied one, after a verb or sign of
reporting it is a reported one, and near a target it is aimed. The machine's best reading of a
clause says which of its words count, and as what; a word outside any matched clause counts for
nothing. The score is a logistic function of the weights of the matched readings.

Fixed seed words open the lexicon. Further insult words and stems, their weights and those of
the readings are learned from a bounded sample of labelled rows (``SAMPLE``): counts of words and
of their beginnings by label, made in tasks, then a small regression that is held to prior
weights of the readings where the sample says little.

Edge cases: a null or empty text has no matched clause and gets the score of the bias, below 0.5;
rows whose label is null are not learned from, rows labelled twice count twice; without labelled
rows the seeds and priors alone are used; a null id counts as held out. An empty table gives no
rows. Other columns are left as they are.
"""

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noteloom.llm.common import batches_of, configure, id_remainder, rows_of, stored, table, worker_state
from noteloom.llm.transducers import Transducer, best_output, compose

SAMPLE = 20_000  # labelled rows that are learned from, by smallest hash of their id
FOLDS = 5
REACH = 4  # words over which a negation, report or target acts
STEM = (4, 9)  # letters of a stem
LEAST_ROWS = 5  # toxic rows that a learned word or stem needs
LEAST_ODDS = 3.0  # and by how much (natural log of odds) it points to them

# Seed words of the classes.
SEED = {
    "insult": "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting imbecile "
    "idiota imbécil estúpido estúpida basura idiote imbécile stupide ordure dummkopf idioten abschaum dumm",
    "threat": "kill hurt destroy punch stab strangle töten umbringen schlagen tuer frapper détruire matar golpear destruir",
    "target": "you your yours yourself u he him she her they them their everyone du dich dir dein deine ihr euch sie "
    "tu te toi ton ta vous votre vos ils elles usted ustedes ti tú",
    "negation": "not never no nobody isn't aren't wasn't don't doesn't nicht kein keine nie niemals pas jamais aucun "
    "ne nunca jamás ningún",
    "report": "said says say saying quoted quotes quote wrote writes claimed claims called reported reportedly sagte sagt "
    "schrieb dit disait écrit dijo dice escribió",
}
LETTER = {"insult": "I", "threat": "H", "target": "T", "negation": "N", "report": "Q"}
OTHER = "o"

# What the machine may write for an insult or a threat, and the prior weight of that reading.
READINGS = {
    "I": 1.0,  # plain insult
    "J": 1.3,  # aimed insult
    "i": 0.2,  # denied insult
    "r": 0.3,  # reported insult
    "H": 0.3,  # threat word without aim
    "K": 1.0,  # aimed threat
    "h": 0.0,  # denied threat
    "s": 0.1,  # reported threat
}
BIAS = -3.0

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE_END = re.compile(r"[.!?;:\n\r|()…]+")


# --- the grammar ----------------------------------------------------------------------

_LETTERS = "IHTNQo"


def marked(mark: str, rewrite: dict[str, str], letters: str, reach: int = REACH) -> Transducer:
    """Rewrites letters that stand at most ``reach`` words after ``mark``."""
    machine = Transducer(start=0)
    for state in range(reach + 1):  # how many more words the mark acts on
        machine.end(state)
        for letter in letters:
            if letter == mark:
                machine.arc(state, letter, letter, 0.0, reach)
            else:
                written = rewrite.get(letter, letter) if state else letter
                machine.arc(state, letter, written, 0.0, max(state - 1, 0))
    return machine


def reported(letters: str) -> Transducer:
    """Whatever follows a report in its clause is reported."""
    machine = Transducer(start="own")
    for state in ("own", "reported"):
        machine.end(state)
        for letter in letters:
            written = {"I": "r", "H": "s"}.get(letter, letter) if state == "reported" else letter
            machine.arc(state, letter, written, 0.0, "reported" if letter == "Q" else state)
    return machine


def aimed_later(letters: str, reach: int = REACH) -> Transducer:
    """An insult or threat may be written as aimed if a target follows within ``reach`` words.

    The machine guesses and is then bound to find the target; a kept guess weighs more.
    """
    machine = Transducer(start=0)
    for state in range(reach + 1):  # words within which a target still has to come; 0: none
        if not state:
            machine.end(state)
        for letter in letters:
            if letter == "T":
                machine.arc(state, letter, letter, 0.0, 0)
                continue
            after = state - 1
            if state != 1:  # a target can still come in time
                machine.arc(state, letter, letter, 0.0, max(after, 0))
            if letter in "IH":
                machine.arc(state, letter, {"I": "J", "H": "K"}[letter], 1.0, after if state > 1 else reach)
    return machine


def grammar() -> Transducer:
    """Report, then negation, then target before, then target after, as one machine."""
    machine = reported(_LETTERS)
    machine = compose(machine, marked("N", {"I": "i", "H": "h"}, _LETTERS + "rs"))
    machine = compose(machine, marked("T", {"I": "J", "H": "K"}, _LETTERS + "rsih"))
    return compose(machine, aimed_later(_LETTERS + "rsihJK"))


# --- the model ------------------------------------------------------------------------


@dataclass
class Model:
    words: dict[str, float]  # insult words and threat words that a clause is matched for
    stems: dict[str, float]  # beginnings of insult words
    weights: dict[str, float]  # of readings
    bias: float

    def found(self, text: str) -> dict[str, float]:
        """Sum of word weights by reading, over the matched clauses of a text."""
        return _reader(self).found(text)

    def score(self, text: str | None) -> float:
        found = self.found(text) if text else {}
        z = self.bias + sum(self.weights[r] * v for r, v in found.items())
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


class _Reader:
    """A model's automaton, letters and grammar, built once in each worker."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        import ahocorasick

        self.words, self.stems = words, stems
        self.letters = {w: LETTER[kind] for kind in SEED for w in SEED[kind].split()}
        self.machine = grammar()
        self.memo: dict[str, str] = {}
        self.triggers = ahocorasick.Automaton()
        for entry in {*words, *stems}:
            self.triggers.add_word(entry, len(entry))
        self.triggers.make_automaton()
        self.stem_sizes = sorted({len(s) for s in stems}, reverse=True)

    def weigh(self, word: str) -> float | None:
        if word in self.words:
            return self.words[word]
        for size in self.stem_sizes:
            if len(word) > size and word[:size] in self.stems:
                return self.stems[word[:size]]
        return None

    def read(self, letters: str) -> str:
        if letters not in self.memo:
            if len(self.memo) > 50_000:
                self.memo.clear()
            self.memo[letters] = best_output(self.machine, letters) or letters
        return self.memo[letters]

    def clause(self, text: str) -> list[tuple[str, float]]:
        """Readings and word weights of one clause."""
        weights, letters, quiet = [], [], 0
        for match in _WORD.finditer(text):
            word = match[0]
            weight = self.weigh(word)
            letter = self.letters.get(word, OTHER)
            if weight is not None and letter != "H":
                letter = "I"
            if letter == OTHER:
                quiet += 1
                if quiet > REACH + 1:  # longer runs act like this one
                    continue
            else:
                quiet = 0
            letters.append(letter)
            weights.append(weight)
        if not any(w is not None for w in weights):
            return []
        read = self.read("".join(letters))
        return [(r, w) for r, w in zip(read, weights, strict=True) if w is not None and r in READINGS]

    def found(self, text: str) -> dict[str, float]:
        text = text.lower()
        sums: dict[str, float] = defaultdict(float)
        done = 0
        for last, size in self.triggers.iter(text):
            first = last - size + 1
            if first < done or (first and text[first - 1].isalpha()):
                continue
            start = done
            for end in _CLAUSE_END.finditer(text, done):
                if end.start() >= first:
                    stop = end.start()
                    break
                start = end.end()
            else:
                stop = len(text)
            for reading, weight in self.clause(text[start:stop]):
                sums[reading] += weight
            done = max(stop, last + 1)
        return {r: math.log1p(v) for r, v in sums.items()}


def _reader(model: Model) -> _Reader:
    kept = worker_state("toxicity_readers", dict)
    key = hash((tuple(sorted(model.words.items())), tuple(sorted(model.stems.items()))))
    if key not in kept:
        kept.clear()
        kept[key] = _Reader(model.words, model.stems)
    return kept[key]


# --- learning -------------------------------------------------------------------------

_COUNTS = pa.schema([("entry", pa.string()), ("is_stem", pa.bool_()), ("toxic", pa.int64()), ("clean", pa.int64())])
_FEATURES = pa.schema([("toxic", pa.int64()), *[(f"f{i}", pa.float64()) for i in range(len(READINGS))]])


def labelled_sample(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """text and toxic of at most ``bound`` labelled rows outside the held-out fold."""
    ids = (
        labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & (id_remainder("label_id", FOLDS) != 0))
        .orderBy(F.xxhash64("label_id"), "label_id", "toxic")
        .limit(bound)
    )
    texts = documents.select(F.col("doc_id").alias("text_id"), F.col("text").cast("string").alias("text"))
    # At most `bound` ids of a few bytes: small enough to send to every executor.
    joined = texts.join(F.broadcast(ids), texts["text_id"] == ids["label_id"])
    return stored(joined.where("text is not null").select("text", "toxic"), "labelled-sample")


def _word_counts(sample: DataFrame) -> list:
    """Rows with each word and each beginning of a word, by label; counted in tasks."""

    def work(batches):
        counts: dict[tuple[str, bool], list[int]] = defaultdict(lambda: [0, 0])
        for text, toxic in rows_of(batches, "text", "toxic"):
            words = {w for w in _WORD.findall(text.lower()) if len(w) > 2}
            stems = {w[:n] for w in words for n in range(STEM[0], min(STEM[1], len(w) - 1) + 1)}
            for entry, is_stem in [*((w, False) for w in words), *((s, True) for s in stems)]:
                counts[entry, is_stem][0 if toxic else 1] += 1
            if len(counts) > 150_000:
                yield from batches_of(((e, s, *n) for (e, s), n in counts.items()), _COUNTS, size=20_000)
                counts.clear()
        yield from batches_of(((e, s, *n) for (e, s), n in counts.items()), _COUNTS, size=20_000)

    totals = (
        sample.mapInArrow(work, "entry string, is_stem boolean, toxic long, clean long")
        .groupBy("entry", "is_stem")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    # Entries that point to toxic rows; at most one in LEAST_ROWS words of toxic sample rows.
    return totals.where((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") > 2 * F.col("clean"))).collect()


def _lexicon(counted: list, toxic: int, clean: int) -> tuple[dict[str, float], dict[str, float]]:
    def odds(row) -> float:
        with_it = math.log((row["toxic"] + 0.5) / (toxic - row["toxic"] + 0.5))
        return with_it - math.log((row["clean"] + 0.5) / (clean - row["clean"] + 0.5))

    strong = {(r["entry"], r["is_stem"]): (odds(r), r["toxic"]) for r in counted if odds(r) >= LEAST_ODDS}
    stems: dict[str, float] = {}
    for (entry, is_stem), (weight, rows) in sorted(strong.items(), key=lambda x: (len(x[0][0]), x[0])):
        if not is_stem or any(entry.startswith(s) for s in stems):
            continue
        # A stem stands for several words; if one word makes up its rows, the word is meant.
        alone = max((n for (w, s), (_, n) in strong.items() if not s and w.startswith(entry)), default=0)
        if rows > 1.5 * alone:
            stems[entry] = weight
    words = {e: w for (e, s), (w, _) in strong.items() if not s and not any(e.startswith(x) for x in stems)}
    return words, stems


def _regression(x: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float = 2.0) -> np.ndarray:
    """Logistic regression by Newton steps, held to ``prior``."""
    w = prior.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - strength * (w - prior)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def ordered(weights: dict[str, float]) -> dict[str, float]:
    """Weights in the order that the grammar means: an aimed insult or threat counts for more than a
    plain one, by the share of the priors at least, and a denied or reported one for no more."""
    found = dict(weights)
    for plain, aimed, lesser in (("I", "J", "ir"), ("H", "K", "hs")):
        found[aimed] = max(found[aimed], found[plain] * READINGS[aimed] / READINGS[plain])
        for reading in lesser:
            found[reading] = min(found[reading], found[plain])
    return found


def learn(documents: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Model:
    """A model from at most ``bound`` labelled rows; what comes to the driver is bounded by them."""
    sample = labelled_sample(documents, labels, bound)
    n = Counter({r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()})
    seeds = {w: 2.0 for kind in ("insult", "threat") for w in SEED[kind].split()}
    if not n[0] or not n[1]:
        return Model(seeds, {}, {r: 2 * w for r, w in READINGS.items()}, BIAS)
    words, stems = _lexicon(_word_counts(sample), n[1], n[0])
    model = Model(seeds | words, stems, dict(READINGS), BIAS)

    def features(batches):
        def rows():
            for text, toxic in rows_of(batches, "text", "toxic"):
                found = model.found(text)
                yield toxic, *[found.get(r, 0.0) for r in READINGS]

        yield from batches_of(rows(), _FEATURES)

    schema = ", ".join(f"{f.name} {'long' if f.name == 'toxic' else 'double'}" for f in _FEATURES)
    # Equal rows are counted, so a few distinct ones arrive.
    grouped = sample.mapInArrow(features, schema).groupBy(*_FEATURES.names).count().toPandas()
    x = np.column_stack([np.ones(len(grouped)), grouped[_FEATURES.names[1:]].to_numpy()])
    times = grouped["count"].to_numpy()
    x, y = np.repeat(x, times, axis=0), np.repeat(grouped["toxic"].to_numpy(dtype=float), times)
    prior = np.array([BIAS, *[2 * v for v in READINGS.values()]])
    fitted = _regression(x, y, prior)
    # More of a matched reading never makes a text less toxic, and none is not toxic.
    weights = ordered({r: max(0.0, float(w)) for r, w in zip(READINGS, fitted[1:], strict=True)})
    return Model(model.words, stems, weights, min(float(fitted[0]), -1.0))


def score(model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1."""

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: model.score(text)).astype("float64")

    return scores(F.coalesce(text.cast("string"), F.lit("")))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    documents = table(configure(spark), folder, "documents")
    model = learn(documents, table(spark, folder, "labels"))
    found = documents.select("doc_id", score(model, F.col("text")).alias("score"))
    return found.select(
        "doc_id",
        (id_remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
