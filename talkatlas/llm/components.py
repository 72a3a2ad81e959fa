"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.llm.tables import kept


def _to_roots(hook: DataFrame) -> DataFrame:
    """Follow the parents of ``hook(c, p)`` to the end by doubling the step."""
    while True:
        up = hook.select(F.col("c").alias("p"), F.col("p").alias("q"))
        step = kept(
            hook.join(up, "p", "left").select(
                "c", F.coalesce("q", "p").alias("p"), (F.col("q") != F.col("p")).alias("moved")
            ),
            "step",
        )
        hook = step.select("c", "p")
        if step.where("moved").isEmpty():
            return hook


def _follow(rows: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    found = roots.select(F.col("c").alias(column), F.col("p").alias("_p"))
    rest = [c for c in rows.columns if c != column]
    return rows.join(found, column, "left").select(*rest, F.coalesce("_p", column).alias(column))


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has a link to another node.

    ``root`` is the smallest node of the component. In each round every node takes its smallest
    neighbour as its parent, parents are followed to their ends, and links are rewritten
    between the ends, so the number of rounds follows the logarithm of the longest path. A
    node with very many links is a hot key of plain joins on written tables, which Spark
    splits; their sizes are those of their files, so only a small one is broadcast. Minima are
    taken before the shuffle. Links with a NULL end and self links are ignored.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = kept(links.select(low.alias("a"), high.alias("b")).distinct(), "edges")
    nodes: DataFrame | None = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("c"), F.col("b").alias("o")).union(edges.select("b", "a"))
        hook = kept(both.groupBy("c").agg(F.min("o").alias("o")).select("c", F.least("c", "o").alias("p")), "hook")
        roots = _to_roots(hook)
        nodes = roots.select(F.col("c").alias("node"), F.col("p").alias("root")) if nodes is None else kept(
            _follow(nodes, "root", roots).select("node", "root"), "nodes"
        )
        edges = _follow(_follow(edges, "a", roots), "b", roots).where("a <> b")
        edges = kept(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if nodes is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes
