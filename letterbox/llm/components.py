"""Connected components of links between numbers, without large groups or paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from . import common


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of links ``a``, ``b``.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label's node, so that labels travel in doubling steps. Rounds
    end when no label changes; each is written to the shared folder. Hot labels
    are joined by ``common.attach``.
    """
    both = common.saved(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct(),
        "links",
    )
    size = both.count()  # there are no more nodes than this
    labels = common.saved(
        both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("component")),
        "labels",
        size,
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("component").alias("near"))
        )
        stepped = common.saved(
            labels.join(near, "node").select(
                "node", "component", F.least("component", "near").alias("next")
            ),
            "labels",
            size,
        )
        if stepped.filter("next <> component").isEmpty():
            return labels
        sizes = stepped.groupBy("next").agg(F.count("*").alias("lb_size"))
        # A label is itself a node: what that node now points to is at least as small.
        jump = common.saved(
            stepped.select(F.col("node").alias("next"), F.col("next").alias("further")).join(sizes, "next"), "jumps", size
        )
        labels = common.saved(
            common.attach(stepped.select("node", "next"), jump, "next", "lb_size").select(
                "node", F.least("next", "further").alias("component")
            ),
            "labels",
            size,
        )
