"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells.

Equal vectors are first folded into one. Centroids are learned from a bounded sample, then every
vector belongs to its nearest cell and visits the cells it is near the border of. Two linked
vectors of different cells have both borders' angles within their own angle, so the nearer one to
the border visits the other's cell and no link is lost, however the centroids lie. Only vectors
of equal labels meet, so cells are sized by the largest label, and a label that fits one cell is
not divided. Within a cell, vectors at home there are compared with each other and with visitors,
visitors not among themselves, in blocks, as matrix products in double precision. A
block pair returns one row per linked vector: its number of links and the smallest vector it is
connected with there, so a dense cell does not put all its pairs into a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldloop.llm.graph import components, roots
from coldloop.llm.text import stored

#: Cosine from which on two vectors link.
THRESHOLD = 0.93
#: Vectors the centroids are learned from, vectors per cell and label that are aimed at, most
#: cells, and rounds of k-means.
SAMPLE, CELL_SIZE, MAX_CELLS, ROUNDS = 20_000, 4_096, 2_048, 8
#: Added to a border's width for the rounding of its cosines.
SLACK = 1e-9
#: Most vectors and most components per block of a cosine product, and vectors of one product.
BLOCK, BLOCK_VALUES, STRIP = 4_096, 2_000_000, 512


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors, starting from evenly spaced ones; empty cells stay."""
    centroids = vectors[np.linspace(0, len(vectors) - 1, k).astype(int)]
    for _ in range(rounds):
        cell = np.argmax(vectors @ centroids.T, axis=1)
        order = np.argsort(cell, kind="stable")
        found, first = np.unique(cell[order], return_index=True)
        sums = np.add.reduceat(vectors[order], first, axis=0)
        norms = np.linalg.norm(sums, axis=1)
        centroids = centroids.copy()
        centroids[found[norms > 0]] = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def usable(embedding: str) -> Column:
    """Whether a vector has a direction: not null, finite throughout and not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD,
                    id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per row of ``vectors``.

    Vectors link when their labels are equal and not null and their cosine is ``threshold`` or
    more. A vector that is null, zero or holds null or non-finite components links with nothing,
    and so does a row without an id; such a row keeps a null component and is kept. Rows with
    equal ids are vectors of their own in the counts and one in the components. Vectors of different length
    do not link. Extra columns are not read; an empty table gives an empty one.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"),
        F.col(vector_column).alias("v"))
    able = usable("v") & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    # Adding zero makes -0.0 equal to 0.0, as cosine sees them.
    keyed = rows.where(able).withColumn("v", F.transform("v", lambda x: x.cast("double") + 0.0))
    keyed = keyed.withColumn("key", F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.concat_ws(
        ",", F.transform("v", lambda x: x.cast("string")))), 256))
    distinct = stored(keyed.groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"),
        F.min("label").alias("label"), F.min("v").alias("v")), "vectors")
    found = stored(compared(distinct, threshold), "vector-links")
    of_rep = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # Equal ids of different vectors are one vertex, so representatives are joined by id.
    joined = components(found.select("rep", "root"), "rep", "root")
    copies = distinct.join(of_rep, "rep", "left").select(
        "key", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = stored(
        keyed.select("vec_id", "key").join(copies, "key")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .select("vec_id", "n_links", F.coalesce("component", "rep").alias("component_id")),
        "vector-members")
    alone = rows.where(~able).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def compared(distinct: DataFrame, threshold: float) -> DataFrame:
    """(rep, root, links) per block pair and linked vector; root is connected with rep."""
    sizes = distinct.groupBy("label").agg(F.count("*").alias("size"))
    large = stored(sizes.where(F.col("size") > CELL_SIZE), "large-labels")
    divided = distinct.join(F.broadcast(large), "label", "left").withColumn(
        "divided", F.col("size").isNotNull())
    members = divided.select("rep", "copies", "label", "v", "divided").mapInArrow(
        assigner(learned(divided, large), threshold),
        "rep long, copies long, label string, v array<double>, home int, cells array<int>")
    visits = members.withColumn("cell", F.explode("cells")).withColumn(
        "at_home", F.col("cell") == F.col("home"))
    # A cell's vectors are of one length.
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(BLOCK_VALUES / F.max(F.size("v")))))
    blocks = visits.groupBy("label", "cell").agg(
        F.ceil(F.count_if("at_home") / rows).cast("int").alias("homes"),
        F.ceil(F.count_if(~F.col("at_home")) / rows).cast("int").alias("guests"))
    # Blocks of vectors at home, then those of visitors. Each home block meets all blocks.
    drawn = F.xxhash64("v")
    dealt = visits.join(blocks.where("homes > 0"), ["label", "cell"]).withColumn("own", F.when(
        F.col("at_home"), F.pmod(drawn, F.col("homes"))).otherwise(
        F.col("homes") + F.pmod(drawn, F.col("guests"))).cast("int"))
    met = F.col("homes") + F.when(F.col("at_home"), F.col("guests")).otherwise(0)
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), met - 1))).select(
        "label", "cell", "rep", "copies", "v", "home", "own",
        F.when(F.col("at_home"), F.col("cells")).alias("cells"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return pairs.groupBy("label", "cell", "i", "j").applyInArrow(
        lambda table: block_links(table, threshold), "rep long, root long, links long")


def learned(divided: DataFrame, large: DataFrame) -> np.ndarray:
    """Centroids for the labels that fill several cells; none if there is no such label."""
    largest = large.agg(F.max("size")).first()[0]
    if largest is None:
        return np.empty((0, 0))
    # The lowest hashes: the same sample on every run, at most ``SAMPLE`` vectors.
    sample = divided.where("divided").select("v").orderBy(F.xxhash64("key"), "key").limit(
        SAMPLE).toPandas()["v"]
    length = sample.map(len).mode()[0]
    sample = unit(np.stack([v for v in sample if len(v) == length]))
    return spherical_kmeans(sample, min(len(sample), MAX_CELLS, -(-largest // CELL_SIZE)))


def borders(centroids: np.ndarray, threshold: float) -> np.ndarray:
    """Per pair of cells how far a vector's cosine with its own may exceed that with the other.

    The border of cells A and B is the plane at right angles to A - B. A vector x of A is
    arcsin(x(A - B) / |A - B|) away from it, and a vector of B is somewhere beyond. If the two
    link, the two distances are at most arccos(threshold) together, so one of them is at most
    half of that.
    """
    half = np.sqrt((1 - min(1.0, max(-1.0, threshold))) / 2)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * centroids @ centroids.T))
    return half * apart + SLACK


def assigner(centroids: np.ndarray, threshold: float):
    """Adds to vectors their nearest cell and all cells whose border is within reach of a link.

    Vectors of an undivided label, or of another length than the centroids, meet in one cell per
    length.
    """
    width = borders(centroids, threshold)

    def near(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosines = unit(points) @ centroids.T
        nearest = np.argmax(cosines, axis=1)
        return nearest, cosines.max(axis=1, keepdims=True) - cosines <= width[nearest]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            homes, counts = -lengths.astype(np.int32), np.ones(len(lengths), np.int64)
            divided = batch.column("divided").to_numpy(zero_copy_only=False).astype(bool)
            same, visited = np.flatnonzero(divided & (lengths == centroids.shape[1])), []
            for low in range(0, len(same), STRIP):
                part = same[low:low + STRIP]
                values = lists.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False)
                homes[part], visits = near(values.reshape(len(part), -1))
                counts[part] = visits.sum(axis=1)
                visited.append(np.nonzero(visits)[1])
            cells = np.repeat(homes, counts)
            if visited:
                inside = np.zeros(len(counts), bool)
                inside[same] = True
                cells[np.repeat(inside, counts)] = np.concatenate(visited)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("rep"), batch.column("copies"), batch.column("label").cast("string"),
                lists, pa.array(homes, pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(cells, pa.int32())),
            ], names=["rep", "copies", "label", "v", "home", "cells"])
    return assign


def block_links(table: pa.Table, threshold: float) -> pa.Table:
    """Links between block i, whose vectors are at home, and block j of one cell and label.

    A pair counts in a cell that is home to one of the two; when both visit the other's home, in
    the smaller of these cells only.
    """
    cell, i, j = (table.column(c)[0].as_py() for c in ("cell", "i", "j"))
    own = table.column("own").to_numpy()
    ids, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
    home = table.column("home").to_numpy()
    points = unit(table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1))
    a = np.flatnonzero(own == i)
    b = a if i == j else np.flatnonzero(own == j)
    elsewhere = places(table.column("cells").combine_chunks(), home)
    count, xs, ys = np.zeros(len(ids), np.int64), [], []
    for low in range(0, len(a), STRIP):
        ahead = b[low:] if i == j else b
        x, y = np.nonzero(points[a[low:low + STRIP]] @ points[ahead].T >= threshold)
        x, y = a[low + x], ahead[y]
        if i == j:
            once = x < y
        else:
            once = (home[y] >= cell) | ~elsewhere(x, home[y])
        x, y = x[once], y[once]
        np.add.at(count, x, copies[y])
        np.add.at(count, y, copies[x])
        # The strip's links as stars, of at most one link per vector.
        star = roots(np.arange(len(ids)), x, y) if len(x) else np.arange(len(ids))
        xs.append(np.flatnonzero(star != np.arange(len(ids))))
        ys.append(star[xs[-1]])
    linked = count > 0
    root = roots(ids, np.concatenate(xs), np.concatenate(ys)) if linked.any() else ids
    return pa.table({"rep": ids[linked], "root": root[linked], "links": count[linked]})


def places(cells: pa.ListArray, home: np.ndarray):
    """Whether rows visit given cells, as a function; a row without a list visits none."""
    lengths = cells.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat, rows = cells.flatten().to_numpy(), np.repeat(np.arange(len(lengths)), lengths)
    least = min(home.min(), flat.min())
    span = max(home.max(), flat.max()) - least + 1
    visited = rows * span + (flat - least)
    return lambda row, cell: np.isin(row * span + (cell - least), visited)
