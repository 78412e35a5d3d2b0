"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id of a link with the smallest id it reaches.

    Each round every label takes the smallest label next to it and the links are
    rewritten to labels; those inside a label go. Links are only ever shortened, so
    nothing is lost, labels at least halve, and the smallest id of a component never
    changes its label. Groups of any size are aggregated map-side, never collected.
    """
    left = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = left.union(left.select("v", "u")).distinct()
    edges = stored(both, "links")
    found = edges.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    while not edges.isEmpty():
        parent = stored(
            edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("p")),
            "parents",
        )
        # One join a round, run when the caller uses the result: rounds are few.
        found = found.join(
            parent.withColumnsRenamed({"u": "c", "p": "up"}), F.col("component") == F.col("c"), "left"
        ).select("id", F.coalesce("up", "component").alias("component"))
        of_u = parent.withColumnsRenamed({"u": "u0", "p": "pu"})
        of_v = parent.withColumnsRenamed({"u": "v0", "p": "pv"})
        moved = (
            edges.join(of_u, F.col("u") == F.col("u0"))
            .join(of_v, F.col("v") == F.col("v0"))
            .where("pu <> pv")
            .select(F.col("pu").alias("u"), F.col("pv").alias("v"))
        )
        edges = stored(moved.distinct(), "links")
    return stored(found, "components")


def merged(found: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``components`` of earlier links with more links added, which may have new ids."""
    of_a = found.withColumnsRenamed({"id": "id_a", "component": "label_a"})
    of_b = found.withColumnsRenamed({"id": "id_b", "component": "label_b"})
    between = (
        links.join(of_a, F.col(a) == F.col("id_a"), "left")
        .join(of_b, F.col(b) == F.col("id_b"), "left")
        .select(F.coalesce("label_a", a).alias("a"), F.coalesce("label_b", b).alias("b"))
    )
    more = components(between)
    old = found.select("id", "component")
    moved = old.join(more.withColumnsRenamed({"id": "c", "component": "up"}), F.col("component") == F.col("c"), "left")
    known = moved.select("id", F.coalesce("up", "component").alias("component"))
    new = more.join(old.select(F.col("component").alias("c")).distinct(), F.col("id") == F.col("c"), "left_anti")
    return known.union(new.select("id", "component"))
