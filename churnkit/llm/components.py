"""Connected components of a link table by randomised contraction, without collecting links or groups anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import stored


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links(a, b)``: nodes get one label exactly if links connect them.

    Each round maps every node to the neighbour (or itself) whose hash under the round's number is least, and redraws the
    links between the images. That keeps components apart and joined as they were, and the expected number of nodes with a
    link at least halves, whatever the shape of the graph, so the number of rounds grows with the logarithm of its size.
    A round aggregates map-side first; its joins are plain equi-joins that adaptive execution splits on a hot node. Rounds
    are cut by written tables. No links give no rows; null ends and self links are left out.
    """
    edges = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct(), "links")
    labels = None
    turn = 0
    while not edges.isEmpty():
        turn += 1
        order = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        both = edges.select(F.col("a").alias("node"), order("b").alias("o")).union(
            edges.select(F.col("b").alias("node"), order("a").alias("o")))
        image = both.groupBy("node").agg(F.min("o").alias("o")).select(
            "node", F.least("o", order("node"))["v"].alias("image"))
        image = stored(image, "images")
        named = image if labels is None else (
            labels.join(image.withColumnRenamed("node", "label"), "label", "left")
            .select("node", F.coalesce("image", "label").alias("image")))
        labels = stored(named.select("node", F.col("image").alias("label")), "labels")
        edges = stored(
            edges.join(image.select(F.col("node").alias("a"), F.col("image").alias("x")), "a")
            .join(image.select(F.col("node").alias("b"), F.col("image").alias("y")), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
