"""Connected components of a link table by alternating large and small stars; nothing is gathered in one place.

Each round is a grouped minimum and a join on the node, written to the shared folder, so lost executors cost no earlier
round. A hub's links are spread by the skew handling of the join. Rounds grow with the logarithm of the longest chain.
"""

from pyspark.sql import DataFrame, functions as F

from clickloom.llm.common import written


def _large(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """From links (u, v) of comparable ids: every linked node but the smallest of each component, with that as ``root``.

    Null ends and self links are ignored; repeated links count once; without links there are no rows.
    """
    links = links.where("u <> v").select("u", "v")
    mark = None
    while True:
        links = written(_small(_large(links)).where("u <> v").distinct(), "links")
        found = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = found
