"""Connected components of a link table, by alternating large and small stars
(Kiveris et al., 2014). Each step is a minimum per node, pre-aggregated in the
map tasks, joined back to the links; a node with very many links is a skewed
join key, which Spark splits. Links never reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm import store


def components(links: DataFrame) -> DataFrame:
    """``links`` has u and v (long); returns (node, label): the smallest node
    of the component, for every node but that smallest one."""
    now = store.materialise(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = store.materialise(small, "links")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = seen
