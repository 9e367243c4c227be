"""Connected components of links, by contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noteloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``links`` (a, b: long); equal labels are connected.

    In each round every node points to its smallest neighbour or itself, pointers are followed
    once more, and links are replaced by links between what their ends point to, until none
    is left. Rounds are written tables, so a lost executor costs at most one of them, and a
    node with very many links meets its pointer in a join that Spark can split.
    """
    links = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
    labels = stored(ends.distinct().select("node", F.col("node").alias("label")), "labels")
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b"))
        steps = stored(near.select(F.col("a").alias("at"), F.least("a", "b").alias("to")), "steps")
        further = steps.select(F.col("at").alias("to"), F.col("to").alias("then"))
        steps = stored(steps.join(further, "to").select("at", F.col("then").alias("to")), "steps")
        of = lambda name: steps.select(F.col("at").alias(name), F.col("to").alias(f"{name}_to"))
        links = stored(
            links.join(of("a"), "a")
            .join(of("b"), "b")
            .where("a_to <> b_to")
            .select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .distinct(),
            "links",
        )
        labels = stored(
            labels.join(of("label"), "label", "left").select("node", F.coalesce("label_to", "label").alias("label")),
            "labels",
        )
    return labels
