"""Connected components of a table of links, as joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldloop.llm.text import Shelf


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id with a link; the component is its smallest id.

    Alternating stars: each id hooks its larger neighbours to the smallest one, then its
    smaller ones. Both keep the components and, repeated, end in one star per component, after
    a number of rounds that grows with the logarithm of the size. A round is written to the
    shared folder, so lineage stays short, and replaces the one before it; a busy id's links are
    split by skew joins. Links with a null end and links of an id with itself say nothing.
    """
    shelf, turn = Shelf(links.sparkSession), 0
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = shelf.add(
        links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
        .distinct(), "edges-0")
    seen = fingerprint(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (
            both.join(smallest, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = shelf.add(large, "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        turn += 1
        edges = shelf.add(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(),
                          f"edges-{turn}")
        shelf.clear("large-stars", f"edges-{turn - 1}")
        now = fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def fingerprint(edges: DataFrame) -> tuple:
    """Number of rows and two sums of hashes, which tell different link tables apart."""
    def total(seed: int):
        return F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total(1), total(2)).first())


def roots(ids: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per row the smallest id it is connected with by links between rows x and rows y."""
    root = ids.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, x, before[y])
        np.minimum.at(root, y, before[x])
        if (root == before).all():
            return root
