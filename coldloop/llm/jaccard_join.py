"""N-gram Jaccard self-join: a size-aware heavy-light join on word shingles.

Documents with equal shingle sets are folded into one. A set can only have a link if the agreed
share of its shingles occurs in other documents too; an exchange of packed hashes finds the few
sets for which that holds, and all that follows works on them.

Shingles are ordered from rare to frequent. Linked sets share at least s shingles among their
first n - o + s, where o is the overlap that n shingles need. Small sets enumerate the
2-element subsets of that beginning (s = 2), large sets are looked up in inverted lists of their
beginning (s = 1), and sets that may link across the boundary do both. The boundary is where the
number of rows is smallest: a subset is one, a list entry is two, as it also meets its list's head.

Sets that meet in a list form candidate groups, linked to the list's smallest set and not to each
other. Each group is verified exactly, in blocks of bounded size, by scanning inverted lists of
the whole sets. A block returns a star per connected part, so no table holds all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldloop.llm.exchange import (
    Slice, answered, ask, bucket_count, dealt, gathered, pack_positions, recall, same_runs,
    unpack_positions)
from coldloop.llm.graph import components, roots
from coldloop.llm.text import Shelf, discard, mixed, stored, windows, word_hashes, words
from coldloop.session import scratch_path

SHINGLE, PERCENT = 4, 85
FACTOR = 0x9E3779B97F4A7C15
#: Sets per block of a candidate group.
BLOCK = 512
SIGNED = "doc_id long, n long, k1 long, k2 long, shingles array<long>"


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text and the text each belongs to, by text and hash.

    A-Z is lower-cased. A text with fewer than ``n`` words has its whole sequence as one shingle.
    """
    bounds, codes, distinct = words(pc.ascii_lower(pc.fill_null(texts, "")))
    hashes, count = word_hashes(distinct)[codes], np.diff(bounds)
    doc = np.repeat(np.arange(len(texts)), count)
    grams, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(doc) >= n:
        at = np.flatnonzero(doc[n - 1:] == doc[: len(doc) - n + 1])
        grams, owner = windows(hashes, n, FACTOR)[at], doc[at]
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            each = hashes[bounds[short][:, None] + np.arange(size)]
            total = np.full(len(short), size, np.uint64)
            for i in range(size):
                total = total * np.uint64(FACTOR) + each[:, i]
            grams, owner = np.concatenate([grams, mixed(total)]), np.concatenate([owner, short])
    order = np.argsort(grams, kind="stable")
    order = order[np.argsort(owner[order].astype(np.uint32), kind="stable")]
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[new], owner[new]


def needed(n, percent: int = PERCENT):
    """Overlap that a set of n shingles needs for any link."""
    return (percent * n + 99) // 100


def asked_shingles(part: Slice, shingle: int, n: int) -> list[tuple]:
    """Each distinct shingle of a slice once, with its document unless several have it."""
    grams, owner = shingle_sets(part.texts, shingle)
    rows: list[tuple] = []
    shared = np.zeros(len(grams), bool)
    if len(grams):
        order = np.argsort(grams, kind="stable")
        run, first = same_runs(grams[order])
        several = np.diff(np.append(first, len(grams))) > 1
        shared[order] = several[run]
        single, once = np.flatnonzero(~shared), order[first[several]]
        sent = np.concatenate([single, once])
        bucket = (grams[sent] & np.uint64(0xFFFFFFFF)) % np.uint64(n)
        mark = (grams[sent] >> np.uint64(32)).astype("<u4")
        place, starts = dealt(bucket, n)
        for b in range(n):
            some = place[starts[b]: starts[b + 1]]
            if len(some):
                mine, theirs = some[some < len(single)], some[some >= len(single)]
                rows.append((b, mark[mine].tobytes(), pack_positions(owner[sent[mine]]),
                             mark[theirs].tobytes(), b""))
    local = np.bincount(owner[shared], minlength=len(part.texts)).astype("<u4")
    rows.append((-1, local.tobytes(), b"", b"", b""))
    return rows


def repeated_shingles(table: pa.Table) -> Iterable[tuple]:
    """For each slice its documents' numbers of shingles that other slices have too."""
    marks, owners, origin = [], [], []
    for i, row in enumerate(table.select(["a", "b", "c"]).to_pylist()):
        mine, theirs = np.frombuffer(row["a"], "<u4"), np.frombuffer(row["c"], "<u4")
        marks += [mine, theirs]
        owners += [unpack_positions(row["b"]), np.full(len(theirs), -1)]
        origin.append(np.full(len(mine) + len(theirs), i, np.int32))
    mark, owner, source = np.concatenate(marks), np.concatenate(owners), np.concatenate(origin)
    order = np.argsort(mark, kind="stable")
    run, first = same_runs(mark[order])
    again = order[(np.diff(np.append(first, len(mark))) > 1)[run]]
    again = np.sort(again[owner[again] >= 0])
    if len(again):
        run, first = same_runs(source[again])
        for i, part in zip(source[again][first].tolist(), np.split(owner[again], first[1:])):
            found, count = np.unique(part, return_counts=True)
            yield i, pack_positions(found), count.astype("<u4").tobytes(), b"", b""


def signed(part: Slice, own: dict, replies: list[dict], shingle: int, percent: int) -> pa.Table:
    """Per document its set size, a 128-bit signature of the set, and the set if it may link."""
    grams, owner = shingle_sets(part.texts, shingle)
    docs = len(part.texts)
    size = np.bincount(owner, minlength=docs)
    repeated = np.frombuffer(own["a"], "<u4").astype(np.int64)
    for row in replies:
        repeated[unpack_positions(row["a"])] += np.frombuffer(row["b"], "<u4")
    sums = [np.zeros(docs, np.uint64) for _ in range(2)]
    for total, salt in zip(sums, (np.uint64(0x632BE59BD9B4E019), np.uint64(0xD6E8FEB86659FD93))):
        np.add.at(total, owner, mixed(grams ^ salt))
    able = (size > 0) & (repeated >= needed(size, percent))
    ends = np.cumsum(size)
    values = grams.view(np.int64)
    sets = [values[e - n: e] if ok else None
            for e, n, ok in zip(ends.tolist(), size.tolist(), able.tolist())]
    return pa.table({
        "doc_id": part.ids.cast(pa.int64()), "n": pa.array(size.astype(np.int64)),
        "k1": pa.array(sums[0].view(np.int64)), "k2": pa.array(sums[1].view(np.int64)),
        "shingles": pa.array(sets, pa.list_(pa.int64()))})


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Two documents link when their shingle sets' Jaccard similarity is ``percent`` hundredths or
    more; the component is the smallest doc_id reachable by links. Null and empty texts have an
    empty set and link with nothing, as do rows without an id (their component is null). Rows
    with equal ids are one vertex. Extra columns are not read; an empty table gives an empty one.
    Shingles are told apart by 64-bit hashes, sets by 128 bits.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark)
    folder, n = scratch_path(spark, "slices"), bucket_count(docs, text_column)
    docs = docs.withColumn(id_column, docs[id_column].cast("long"))
    asked = ask(docs, id_column, text_column, folder,
                lambda part: asked_shingles(part, shingle, n))
    sets = shelf.add(gathered(
        answered(asked, repeated_shingles), lambda name, own, replies: signed(
            recall(name, folder), own, replies, shingle, percent), SIGNED), "shingle-sets")
    discard(folder)
    known = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    of_set = ["k1", "k2", "n"]
    classes = known.groupBy(*of_set).agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    classes = shelf.add(classes, "set-classes")
    copies = shelf.add(known.select("doc_id", *of_set).join(
        classes.where("rows > 1"), of_set).where("doc_id <> rep").select("doc_id", "rep"), "copies")
    distinct = shelf.add(
        known.where(F.col("shingles").isNotNull()).join(classes, of_set)
        .where("doc_id = rep").dropDuplicates(of_set).select("rep", "n", "shingles"), "sets")
    sizes = stored(sets.select("doc_id", F.col("n").alias("n_shingles")), "set-sizes")
    shelf.clear("shingle-sets", "set-classes")
    groups = shelf.add(candidate_groups(distinct, percent), "candidate-groups")
    links = shelf.add(verified(distinct, groups, percent), "links")
    shelf.clear("candidate-groups", "sets")
    joined = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b"))
                        .unionByName(copies.select(F.col("doc_id").alias("a"),
                                                   F.col("rep").alias("b"))))
    shelf.clear()
    return sizes.join(
        joined.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component_id", F.coalesce("component", "doc_id")).drop("component")


def candidate_groups(distinct: DataFrame, percent: int) -> DataFrame:
    """(rep, comp): sets that meet in a list, directly or through others."""
    shelf = Shelf(distinct.sparkSession)
    each = distinct.select("rep", "n", F.explode("shingles").alias("s"))
    frequency = each.groupBy("s").agg(F.count("*").alias("df")).where("df > 1")
    ordered = shelf.add(
        each.join(frequency, "s").groupBy("rep", "n").agg(
            F.sort_array(F.collect_list(F.struct("df", "s"))).alias("common")), "ordered-shingles")
    # Shingles of one document come first in the order; what they leave of the beginning counts.
    alone = F.col("n") - F.size("common")
    begin = F.col("n") - F.expr(f"({percent} * n + 99) div 100") + 1 - alone
    # The largest set that a set may link with.
    ordered = ordered.withColumns({"begin": begin, "largest": F.expr(f"100 * n div {percent}")}
                                  ).where("begin + 1 > 0")
    boundary = cheapest_boundary(ordered)
    keys = shelf.add(list_keys(ordered, boundary, percent), "list-keys")
    shelf.clear("ordered-shingles")
    heads = keys.groupBy("key", "size_class").agg(
        F.min("rep").alias("head"), F.count("*").alias("sets")).where("sets > 1")
    meets = keys.join(heads, ["key", "size_class"]).where("rep <> head")
    found = components(meets, "rep", "head").select(F.col("id").alias("rep"),
                                                    F.col("component").alias("comp"))
    shelf.clear()
    return found


def list_keys(ordered: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(rep, key, size_class): the lists a set is in.

    A size class spans the sizes that can link with its smallest; a set is put into its own
    class and the next, so sets that can link by size share one and others mostly none.
    """
    size_class = F.floor(F.log("n") / F.log(F.lit(100 / percent)))
    ordered = ordered.withColumn("size_class", F.explode(F.array(size_class, size_class + 1)))
    # The smallest partner of a set above the boundary.
    bridge = -(-percent * (boundary + 1) // 100)
    single = ordered.where((F.col("n") >= bridge) & (F.col("begin") > 0)).select(
        "rep", "size_class", F.explode(F.transform(
            F.slice("common", F.lit(1), F.greatest(F.col("begin"), F.lit(0)).cast("int")),
            lambda x: x["s"])).alias("key"))
    first = F.slice("common", F.lit(1), (F.greatest(F.col("begin"), F.lit(0)) + 1).cast("int"))

    def with_later(x: Column, i: Column) -> Column:
        return F.transform(F.slice("_first", i + 2, F.greatest(F.size("_first") - i - 1, F.lit(0))),
                           lambda y: F.xxhash64(x["s"], y["s"]))

    paired = ordered.where(F.col("n") <= boundary).withColumn("_first", first).select(
        "rep", "size_class",
        F.explode(F.flatten(F.transform("_first", with_later))).alias("key"))
    return single.unionByName(paired)


def cheapest_boundary(ordered: DataFrame) -> int:
    """The size up to which enumerating subsets makes fewer rows than looking up lists.

    A subset is one row. A list entry is two, as every listed shingle is in some other set too and
    the entry meets its list's head. Costs are summed by size; the driver sees one row per
    distinct size.
    """
    start = F.greatest(F.col("begin"), F.lit(0))
    listed = F.least(start, F.size("common"))
    first = F.least(start + 1, F.size("common"))
    rows = ordered.groupBy("n", "largest").agg(
        F.sum(first * (first - 1) / 2).alias("subsets"), F.sum(2 * listed).alias("entries")).collect()
    if not rows:
        return 0
    # Larger sets may link with larger ones, so both orders are one.
    n, largest, subsets, entries = (np.array(x, float) for x in zip(*sorted(
        (r.n, r.largest, r.subsets, r.entries) for r in rows)))
    limits = np.concatenate([[0], n])
    enumerated = np.concatenate([[0], np.cumsum(subsets)])[np.searchsorted(n, limits, "right")]
    spared = np.concatenate([[0], np.cumsum(entries)])[np.searchsorted(largest, limits, "right")]
    return int(limits[np.argmin(enumerated - spared)])


def verified(distinct: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(rep, root) for sets with links: stars whose parts are connected by links.

    Small groups are verified many at a time; a large one is cut into blocks, and all pairs of
    blocks are compared.
    """
    total = groups.count()
    sizes = groups.groupBy("comp").count().select(
        "comp", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    placed = groups.join(sizes, "comp").join(distinct.select("rep", "shingles"), "rep")
    units = max(1, -(-total // (BLOCK // 4)))
    small = F.col("blocks") == 1
    placed = placed.withColumns({
        "own": F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"),
        "unit": F.when(small, F.pmod(F.xxhash64("comp"), F.lit(units))).otherwise(F.col("comp")),
        "large": ~small})
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return pairs.groupBy("large", "unit", "i", "j").applyInArrow(
        lambda table: block_stars(table, percent), "rep long, root long")


def block_stars(table: pa.Table, percent: int) -> pa.Table:
    """Stars of the linked sets of a unit: one block pair, or several whole groups."""
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    ids, comp = table.column("rep").to_numpy(), table.column("comp").to_numpy()
    own = table.column("own").to_numpy()
    lists = table.column("shingles").combine_chunks()
    flat, bounds = lists.flatten().to_numpy(), np.concatenate(
        [[0], np.cumsum(lists.value_lengths().to_numpy())])
    size = np.diff(bounds)
    # Codes of shingles within their group, so that groups of a unit do not meet.
    order = np.lexsort((flat, np.repeat(comp, size)))
    by_set = np.repeat(np.arange(len(ids)), size)
    new = np.ones(len(flat), bool)
    new[1:] = (flat[order][1:] != flat[order][:-1]) | (
        comp[by_set[order]][1:] != comp[by_set[order]][:-1])
    code = np.empty(len(flat), np.int64)
    code[order] = np.cumsum(new) - 1
    # Inverted lists of the sets of block j.
    listed = order[own[by_set[order]] == j]
    starts = np.searchsorted(code[listed], np.arange(new.sum() + 1))
    holders = by_set[listed]
    left, right = [], []
    for a in np.flatnonzero(own == i):
        mine = code[bounds[a]: bounds[a + 1]]
        met = np.concatenate([holders[s:e] for s, e in zip(
            starts[mine].tolist(), starts[mine + 1].tolist())])
        both = np.bincount(met, minlength=len(ids))
        found = np.flatnonzero(100 * both >= percent * (size[a] + size - both))
        left.append(np.full(len(found), a))
        right.append(found)
    x = np.concatenate(left) if left else np.zeros(0, np.int64)
    y = np.concatenate(right) if right else np.zeros(0, np.int64)
    different = x != y
    root = roots(ids, x[different], y[different])
    linked = root != ids
    return pa.table({"rep": ids[linked], "root": root[linked]})
