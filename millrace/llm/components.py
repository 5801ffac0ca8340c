"""Connected components of a link table, by smallest labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import settle


def components(links: DataFrame) -> DataFrame:
    """``(id, component)``: the smallest id reachable from each id in ``links (a, b)``.

    Each round takes the smallest label among neighbours and then the label of the label, so a chain's length
    halves. Labels are combined map-side, and every round is written out, so a lost executor repeats one round.
    """
    both = settle(
        links.select(F.col("a").alias("x"), F.col("b").alias("y"))
        .unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y"))).distinct(),
        "links",
    )
    labels = settle(
        both.groupBy(F.col("x").alias("id")).agg(F.least(F.col("id"), F.min("y")).alias("component")), "labels"
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("id", "y"), "y").groupBy(F.col("x").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "id").select("id", "component", F.least("component", "near").alias("low"))
        lower = settle(lower, "labels")
        roots = lower.select(F.col("id").alias("low"), F.col("low").alias("root"))
        jumped = lower.join(roots, "low", "left").select(
            "id", "component", F.least("low", F.coalesce("root", "low")).alias("next")
        )
        jumped = settle(jumped, "labels")
        if jumped.filter(F.col("next") != F.col("component")).isEmpty():
            return jumped.select("id", "component")
        labels = jumped.select("id", F.col("next").alias("component"))
