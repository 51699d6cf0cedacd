"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


#: A node of more than one in so many edges is joined by a broadcast of such nodes, of which there are no more than that.
HUBS = 512


def hub_join(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """Rows joined with a table of one row for each key, which also holds the number of rows with it (k).

    Keys with more than total / HUBS rows, HUBS at most, go out by broadcast, so no key fills a task; the
    others are shuffled. total: the rows of all keys.
    """
    hubs = table.where(F.col("k") > F.lit(total / HUBS)).drop("k")
    others = [c for c in hubs.columns if c != key]
    seen = rows.join(F.broadcast(hubs.withColumn("hub_", F.lit(True))), key, "left")
    rest = seen.where(F.col("hub_").isNull()).select(*rows.columns).join(table.drop("k"), key)
    return seen.where("hub_").select(*rows.columns, *others).unionByName(rest.select(*rows.columns, *others))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Each node ties its larger neighbours to the least of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("k"))
    tied = hub_join(both.where(F.col("v") > F.col("u")), least, "u", 2 * n)
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties itself and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    smaller = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) edges to (node, component), the component being the least id that a node reaches.

    Edges may repeat, run either way or be loops (a loop gives no row). Nodes without edges have no row. Nulls
    are ignored. Each round is written to the shared folder, so a lost executor costs one round at most.
    """
    edges = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u != v")
    state, seen = stored(_small_star(edges), "edges"), None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        state = stored(_small_star(_large_star(state, mark[0])), "edges")
    roots = state.select(F.col("v").alias("u"), "v")
    return state.select("u", "v").union(roots).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))


def with_new_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, component) after more links (a, b): only the components that they tie are worked on again."""

    def named(df: DataFrame, column: str) -> DataFrame:
        of = labels.select(F.col("node").alias(column), F.col("component").alias("c_"))
        return df.join(of, column, "left").withColumn(column, F.coalesce("c_", column)).drop("c_")

    tied = stored(connected_components(named(named(links, "a"), "b")), "tied")
    moved = labels.join(tied.select(F.col("node").alias("component"), F.col("component").alias("to_")), "component", "left")
    return moved.select("node", F.coalesce("to_", "component").alias("component")).unionByName(tied.join(labels, "node", "left_anti"))
