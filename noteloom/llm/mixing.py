"""Mixing sources to target weights by raking (iterative proportional fitting).

Documents are summed up to cells of source, language and topic, weighted by their tokens. The sample
is to hold a ``share`` of all tokens. Each round scales the cells' weights so that the sums by source,
then by language, then by topic meet their targets; a cell counts with at most its own tokens, so
that what a small cell cannot give is asked of the others in the same rounds. At the end all weights
are scaled by one number with which the sample has its share. A cell's weight over its tokens is the
probability with which its documents are kept. Whether a document is kept follows from a hash of its
id alone. One odd row with a source of its own is kept, and changes nothing for the others.

Targets are given weights, or by default the observed token shares to a power (``TEMPER``; 1 keeps
them), and are scaled to sum up to one. A value without a given weight has its default target; a
given value that does not occur is left out. Targets that contradict each other, or ask for more
than there is, are met as far as the last round goes; see ``budget_margins``.

All of it is DataFrame operations. Sums are combined before they are shuffled. The targets become
columns of the cells, and a step is one window over the cells of a value: no joins, and a number of
jobs that depends on the number of rounds alone. Up to ``CELLS_OF_ONE_TASK`` cells the windows run in
one task without shuffles, beyond that they are dealt by value; the weights are the same. Cells are
joined back to documents by a join that Spark broadcasts if the cells are few, and splits where a
cell is hot if they are not.

Edge cases: a null source, language or topic is the value ``(none)``; a null or empty text has no
tokens and weighs nothing; its cell may have a rate from other documents, and if all of a cell's
documents are empty they are kept. A null id is hashed as the empty text; rows that repeat an id
are kept or not together within a cell. An empty table gives no rows. Columns of the input are not
touched by name beyond those named.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from noteloom.llm.common import configure, fresh_name, stored, table

DIMENSIONS = ("source", "lang", "topic")
TEMPER = {"source": 0.8, "lang": 0.8, "topic": 1.0}
ROUNDS = 10
STORED_ROUNDS = 5  # rounds between two writes of the weights, which bound the size of a plan
CELLS_OF_ONE_TASK = 1_000_000
SHARE = 0.75  # of the tokens, that a sample holds
SEED = "mix"
NONE = "(none)"


def word_count(text: Column) -> Column:
    """Number of words: runs of characters other than ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^ \\t-\\r]+")).cast("long")


def form(text: Column) -> Column:
    """What a text looks like; stands in for a topic where a table has none."""
    return (
        F.when(text.isNull() | (text == ""), NONE)
        .when(text.contains(" | "), "table")
        .when(text.contains("$$$") | text.contains("###"), "marked")
        .when(text.contains("!! "), "shouted")
        .when(F.length(text) < 1000, "short")
        .otherwise("prose")
    )


def measured(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", topic: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic and n_tokens of every row."""
    text = F.col(text_column).cast("string")
    named = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return df.select(
        F.col(id_column).alias("doc_id"),
        named(F.col("source")).alias("source"),
        named(F.col("lang")).alias("lang"),
        named(form(text) if topic is None else topic).alias("topic"),
        word_count(text).alias("n_tokens"),
    )


def targets_of(cells: DataFrame, dimension: str, temper: float, given: Mapping[str, float] | None = None) -> DataFrame:
    """value and target of every value of a dimension that has tokens; targets sum up to one."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("n")).where("n > 0")
    wanted = _wanted(F.col("n") / F.sum("n").over(_whole()), F.col("value"), temper, given)
    return sums.select("value", wanted.alias("wanted")).select(
        "value", (F.col("wanted") / F.sum("wanted").over(_whole())).alias("target")
    )


def _whole() -> WindowSpec:
    """All cells."""
    return Window.partitionBy()


def _wanted(share: Column, value: Column, temper: float, given: Mapping[str, float] | None) -> Column:
    wanted = F.pow(share, F.lit(float(temper)))
    if not given:
        return wanted
    stated = F.create_map(*[F.lit(x) for v, w in given.items() for x in (v, float(w))])
    return F.coalesce(F.element_at(stated, value), wanted)


def _together(cells: DataFrame, few: bool) -> DataFrame:
    """Cells in one partition, if they are few: windows over them need no shuffle then."""
    return cells.coalesce(1) if few else cells


def _few(cells: DataFrame) -> bool:
    return cells.count() <= CELLS_OF_ONE_TASK


def _target(dimension: str) -> str:
    return f"target_{dimension}"


def with_targets(cells: DataFrame, given: Mapping[str, Mapping[str, float]] | None = None) -> DataFrame:
    """``cells`` that have tokens, with a column of each dimension's target; the same as ``targets_of``."""
    found = cells.where("tokens > 0")
    for d in DIMENSIONS:
        of_value = Window.partitionBy(d)
        n = F.sum(F.col("tokens").cast("double"))
        # One cell of each value stands for it where values are summed up.
        first = F.row_number().over(of_value.orderBy(*DIMENSIONS)) == 1
        found = found.withColumns({"_n": n.over(of_value), "_all": n.over(_whole()), "_first": first})
        found = found.withColumn("_wanted", _wanted(F.col("_n") / F.col("_all"), F.col(d), TEMPER[d], (given or {}).get(d)))
        total = F.sum(F.when(F.col("_first"), F.col("_wanted"))).over(_whole())
        found = found.withColumn(_target(d), F.col("_wanted") / total).drop("_n", "_all", "_first", "_wanted")
    return found


def _joined(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """``cells`` that have tokens and targets in all dimensions, with these as columns."""
    found = cells.where("tokens > 0").select(*DIMENSIONS, "tokens")
    for d, target in targets.items():
        found = found.join(target.select(F.col("value").alias(d), F.col("target").alias(_target(d))), d)
    return stored(found, "cells")


def _rounds(cells: DataFrame, rounds: int, capped: bool, few: bool) -> DataFrame:
    """The column ``weight`` after so many rounds; ``cells`` has it, the tokens and the targets.

    With ``capped`` a cell counts with at most its tokens; its weight may go beyond, so that it
    stays the product of its tokens and one factor for each of its values.
    """
    counted = F.least("weight", "tokens") if capped else F.col("weight")
    now = _together(cells, few)
    for n in range(rounds):
        for d in [d for d in DIMENSIONS if _target(d) in cells.columns]:
            total = F.sum(counted).over(Window.partitionBy(d))
            scale = F.when(total > 0, F.col(_target(d)) / total).otherwise(0.0)
            now = now.withColumn("weight", F.col("weight") * scale)
        if (n + 1) % STORED_ROUNDS == 0 and n + 1 < rounds:
            now = _together(stored(now, "raked"), few)
    return now


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the dimensions, tokens) with the raked ``weight`` of each; weights sum up to one."""
    start = _joined(cells, targets).withColumn("weight", F.col("tokens").cast("double"))
    return stored(_rounds(start, rounds, capped=False, few=_few(start)).select(*DIMENSIONS, "tokens", "weight"), "raked")


def _scaled(cells: DataFrame, share: float) -> DataFrame:
    """Weights times the one number with which they, at most the tokens each, sum up to ``share``.

    In the order in which cells reach their tokens as that number grows, a cell is full if the
    number that just fills it does not ask for more than the budget of all.
    """
    ratio = F.when(F.col("weight") > 0, F.col("tokens") / F.col("weight"))
    before = Window.orderBy("_ratio", *DIMENSIONS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = cells.withColumns({"_ratio": ratio, "_budget": F.sum("tokens").over(_whole()) * F.lit(float(share))})
    usable = F.col("_ratio").isNotNull()
    weight, tokens = (F.when(usable, F.col(c)).otherwise(0.0) for c in ("weight", "tokens"))
    at_this = F.sum(tokens).over(before) + F.col("_ratio") * (F.sum(weight).over(_whole()) - F.sum(weight).over(before))
    found = found.withColumn("_full", F.coalesce(at_this <= F.col("_budget"), F.lit(False)))
    held = F.sum(F.when(F.col("_full"), F.col("tokens")).otherwise(0)).over(_whole())
    free = F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0.0)).over(_whole())
    found = found.withColumn("_scale", F.when(free > 0, (F.col("_budget") - held) / free).otherwise(0.0))
    full = F.col("tokens").cast("double")
    return found.select(
        *DIMENSIONS, "tokens", F.when(F.col("_full"), full).otherwise(F.least(full, F.col("weight") * F.col("_scale"))).alias("weight")
    )


def _to_budget(cells: DataFrame, share: float, rounds: int, few: bool) -> DataFrame:
    if share >= 1:
        return cells.select(*DIMENSIONS, "tokens", F.col("tokens").cast("double").alias("weight"))
    budget = F.sum("tokens").over(_whole()) * F.lit(float(share))
    start = cells.withColumns({_target(d): F.col(_target(d)) * budget for d in DIMENSIONS if _target(d) in cells.columns})
    start = start.withColumn("weight", F.col("tokens") * F.lit(float(share)))
    return _scaled(_rounds(start, rounds, capped=True, few=few), share)


def to_budget(cells: DataFrame, targets: Mapping[str, DataFrame], share: float, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (the dimensions, tokens) with ``weight``, the tokens to be expected of each.

    Weights sum up to ``share`` of all tokens and are nowhere above a cell's own. If all cells with a
    target above nothing hold less than that, they are kept whole.
    """
    start = _joined(cells, targets)
    return stored(_to_budget(start, share, rounds, _few(start)), "budget")


def margins(raked: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """dimension, value, target and raked weight: how far each target is met."""
    found = None
    for dimension, target in targets.items():
        sums = raked.groupBy(F.col(dimension).alias("value")).agg(F.sum("weight").alias("weight"))
        part = sums.join(target, "value").select(F.lit(dimension).alias("dimension"), "value", "target", "weight")
        found = part if found is None else found.unionByName(part)
    return found


def chance(id_column: str = "doc_id", seed: str = SEED) -> Column:
    """A number from 0 to below 1 that follows from the id alone."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)


def _cells(documents: DataFrame) -> DataFrame:
    return stored(documents.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")


def rates(
    documents: DataFrame,
    given: Mapping[str, Mapping[str, float]] | None = None,
    rounds: int = ROUNDS,
    share: float = SHARE,
) -> DataFrame:
    """source, lang, topic and the probability of each cell of ``documents`` (as from ``measured``)."""
    cells = _cells(documents)
    few = _few(cells)
    aimed = stored(with_targets(_together(cells, few), given), "targets")
    planned = _to_budget(aimed, share, rounds, few)
    found = planned.select(*DIMENSIONS, (F.col("weight") / F.col("tokens")).alias("probability"))
    empty = cells.where("tokens = 0").select(*DIMENSIONS, F.lit(1.0).alias("probability"))
    return stored(found.unionByName(empty), "rates")


def budget_margins(
    documents: DataFrame, share: float, given: Mapping[str, Mapping[str, float]] | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """``margins`` of a sample of ``share`` of the tokens: what targets the rounds leave unmet shows here."""
    cells = _cells(documents)
    targets = {d: targets_of(cells, d, TEMPER[d], (given or {}).get(d)) for d in DIMENSIONS}
    planned = to_budget(cells, targets, share, rounds)
    return margins(planned.withColumn("weight", F.col("weight") / F.sum("weight").over(_whole())), targets)


def mixed(
    documents: DataFrame, given: Mapping[str, Mapping[str, float]] | None = None, share: float = SHARE
) -> DataFrame:
    """``documents`` (as from ``measured``) with their probability and whether they are kept."""
    probability = rates(documents, given, share=share)
    return documents.join(probability, list(DIMENSIONS)).withColumn("kept", chance() < F.col("probability"))


def sample(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    share: float = SHARE,
    given: Mapping[str, Mapping[str, float]] | None = None,
    topic: Column | None = None,
) -> DataFrame:
    """The rows of ``df`` that the mix keeps, as they are.

    ``share`` is that of all tokens to keep, ``given`` has target weights by dimension and value, and
    ``topic`` takes the place of the form of the text.
    """
    found = stored(measured(df, id_column, text_column, topic), "measured")
    probability = rates(found, given, share=share)
    names = {d: fresh_name(df, f"mix_{d}") for d in DIMENSIONS}
    p = fresh_name(df, "mix_probability")
    of_cell = probability.select(*[F.col(d).alias(n) for d, n in names.items()], F.col("probability").alias(p))
    text = F.col(text_column).cast("string")
    named = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    placed = (
        df.withColumn(names["source"], named(F.col("source")))
        .withColumn(names["lang"], named(F.col("lang")))
        .withColumn(names["topic"], named(form(text) if topic is None else topic))
    )
    return placed.join(of_cell, list(names.values())).where(chance(id_column) < F.col(p)).select(*df.columns)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Cell, probability and choice of every document."""
    found = stored(measured(table(configure(spark), folder, "documents")), "measured")
    return mixed(found).select(
        "doc_id", "source", "lang", "topic", "n_tokens", F.round("probability", 6).alias("probability"), "kept"
    )


def oracle(rounds: int = ROUNDS) -> str:
    """The same in DuckDB: each round is three common table expressions."""
    parts = [
        """measured AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
    CASE WHEN text IS NULL OR text = '' THEN '(none)' WHEN contains(text, ' | ') THEN 'table'
      WHEN contains(text, '$$$') OR contains(text, '###') THEN 'marked'
      WHEN contains(text, '!! ') THEN 'shouted' WHEN length(text) < 1000 THEN 'short' ELSE 'prose' END AS topic,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS n_tokens
  FROM documents)""",
        """cells AS MATERIALIZED (
  SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM measured GROUP BY ALL)""",
    ]
    for d in DIMENSIONS:
        parts.append(f"""target_{d} AS MATERIALIZED (
  SELECT value, wanted / sum(wanted) OVER () AS target FROM (
    SELECT {d} AS value, pow(sum(tokens)::DOUBLE / (sum(sum(tokens)) OVER ())::DOUBLE, {TEMPER[d]!r}::DOUBLE) AS wanted
    FROM cells WHERE tokens > 0 GROUP BY {d}))""")
    before = "raked_0"
    joins = " ".join(f"JOIN target_{d} ON target_{d}.value = {d}" for d in DIMENSIONS)
    parts.append(f"""raked_0 AS MATERIALIZED (
  SELECT source, lang, topic, tokens, tokens * {SHARE!r}::DOUBLE AS weight, sum(tokens) OVER () * {SHARE!r}::DOUBLE AS budget,
    {", ".join(f"target_{d}.target AS t_{d}" for d in DIMENSIONS)}
  FROM cells {joins} WHERE tokens > 0)""")
    for n in range(rounds):
        for d in DIMENSIONS:
            name = f"raked_{n + 1}_{d}"
            parts.append(f"""{name} AS MATERIALIZED (
  SELECT * REPLACE (weight * (t_{d} * budget / sum(least(weight, tokens)) OVER (PARTITION BY {d})) AS weight) FROM {before})""")
            before = name
    parts.append(f"""filled AS MATERIALIZED (
  SELECT *, sum(tokens) OVER upto + tokens / weight * (sum(weight) OVER () - sum(weight) OVER upto) <= budget AS whole FROM {before}
  WINDOW upto AS (ORDER BY tokens / weight, source, lang, topic ROWS UNBOUNDED PRECEDING))""")
    parts.append("""rates AS (
  SELECT source, lang, topic, CASE WHEN whole THEN 1.0 ELSE least(tokens::DOUBLE,
    weight * ((budget - sum(CASE WHEN whole THEN tokens ELSE 0 END) OVER ()) / sum(CASE WHEN whole THEN 0.0 ELSE weight END) OVER ())) / tokens
  END AS probability FROM filled
  UNION ALL SELECT source, lang, topic, 1.0 FROM cells WHERE tokens = 0)""")
    return (
        "WITH " + ",\n".join(parts) + "\n"
        f"""SELECT doc_id, source, lang, topic, n_tokens, round(probability, 6) AS probability,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656 < probability AS kept
FROM measured JOIN rates USING (source, lang, topic)"""
    )
