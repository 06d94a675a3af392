"""Mixing sources to target weights: highest-quotient apportionment of equal-token blocks.

Targets follow weights, capped at a multiple of a source's size. Blocks of equal numbers of
words are allocated by Sainte-Laguë quotients, first to sources and then to the shards of each
source, so every shard gets a whole number of blocks. A shard orders its documents by a seeded
hash, cuts the stream of their words into blocks and takes consecutive blocks, cyclically,
from a seeded one on; more blocks than it has mean repeats. Only DataFrame functions are used.

A source has about as many shards as a shard has documents (the root of their number), so
neither the apportionment nor the order within a shard meets a group that grows like the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldloop.llm.text import WORD, stored, word_count

WEIGHTS = (3, 1, 2)
#: Words per block, the seed, the share of all words that is asked for in hundredths, and how
#: often a word may be taken.
BLOCK_WORDS, SEED, SHARE_PERCENT, MOST_REPEATS = 32, "mix", 150, 2


def draw(*columns: str, seed: str = SEED) -> Column:
    """A seeded 60-bit number from columns; nulls count as empty."""
    text = F.concat_ws("|", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit(""))
                                           for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def apportion(parties: DataFrame, group: list[str], party: str) -> DataFrame:
    """Allocate ``seats`` of each group to its parties by highest quotients votes / (2s + 1).

    ``parties`` has ``votes`` and ``seats`` (the same in all rows of a group); the result adds
    ``won``. Ties go to the smaller ``party``. A party's seats differ from its proportional
    share by at most half a seat plus its part of half a seat per party, so only quotients in
    that range are ranked: about five a party, however many seats there are.
    """
    whole = Window.partitionBy(*group)
    parties = parties.withColumns({
        "_all": F.sum("votes").over(whole).cast("double"), "_k": F.count("*").over(whole)})
    share = F.when(F.col("_all") > 0, F.col("votes") / F.col("_all")).otherwise(0.0)
    slack = share * F.col("_k") / 2 + 1.5
    parties = parties.withColumns({
        "_low": F.greatest(F.lit(0), F.floor(share * F.col("seats") - slack)),
        "_high": F.ceil(share * F.col("seats") + slack)})
    parties = parties.withColumn("_left", F.col("seats") - F.sum("_low").over(whole))
    tried = parties.withColumn("_s", F.explode(F.sequence(F.col("_low"), F.col("_high"))))
    by_quotient = whole.orderBy(F.desc(F.col("votes") / (2 * F.col("_s") + 1)), party, "_s")
    ranked = tried.withColumn("_rank", F.row_number().over(by_quotient))
    kept = [c for c in parties.columns if not c.startswith("_")]
    return (
        ranked.groupBy(*kept, "_low")
        .agg(F.sum((F.col("_rank") <= F.col("_left")).cast("long")).alias("_more"))
        .withColumn("won", F.col("_low") + F.col("_more")).drop("_low", "_more"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source: number, weight, documents, size and target.

    The asked share of all words is dealt by weight. A target stops at the repeats allowed; what
    is above is dealt again by weight until none is. In the order of cap per weight the capped
    sources come first, so running sums give the level at which the others end.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)),
                          ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    everything = Window.partitionBy(F.lit(0))
    asked = F.sum("source_size").over(everything) * SHARE_PERCENT
    before = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    level = F.min_by("level", "place").over(everything)
    return (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                    F.count("*").alias("documents"))
        .withColumn("sid", F.row_number().over(by_name))
        .withColumns({"weight": weight, "cap": F.col("source_size") * MOST_REPEATS})
        .withColumns({"place": F.row_number().over(by_cap),
                      "level": (asked - 100 * before) / (100 * rest)})
        .withColumn("level", F.when(F.col("cap") > F.col("level") * F.col("weight"),
                                    F.col("level")))
        .withColumn("open_place", F.when(F.col("level").isNotNull(), F.col("place")))
        .withColumn("final", F.min_by("level", "open_place").over(everything))
        .withColumn("target", F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight")),
            F.col("cap").cast("double")))
        .select("source", "sid", "weight", "documents", "source_size", "target"))


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: str = SEED,
        id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", keep_rows: bool = False) -> DataFrame:
    """How many words of each document the mix takes.

    Returns doc_id, source, size, source_size, target, taken and, to cut by: ``copies`` (of the
    whole document) and two pieces of it, each from a word (``from1``, ``from2``) on for a
    number of words (``words1``, ``words2``, mostly 0). The pieces of a shard are one cyclic
    run, so nearly all documents are taken whole or left out. With ``keep_rows`` the column
    ``_row`` holds the document's own columns.

    Null texts have size 0; a null source is a source of its own, the last; rows with equal or
    null ids are documents of their own. Extra columns are not read. An empty table gives an
    empty result.
    """
    own = [F.struct(*docs.columns).alias("_row")] if keep_rows else []
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
                       word_count(F.col(text_column)).alias("size"), *own)
    sizes = stored(rows.drop("_row"), "mix-sizes")
    sources = source_targets(sizes)
    quotas = shard_quotas(dealt(sizes, sources, seed), block_words)
    mine = dealt(rows if keep_rows else sizes, sources, seed)
    order = Window.partitionBy("sid", "shard").orderBy("draw", "doc_id", "size")
    placed = mine.withColumn(
        "b", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("a", F.col("b") - F.col("size"))
    first = F.pmod(draw("sid", "shard", seed=seed), F.greatest("blocks", F.lit(1)))
    run = placed.join(quotas, ["sid", "shard"]).withColumns({
        "copies": F.expr("won div greatest(blocks, 1)"), "first": first})
    run = run.withColumns({
        "low": F.expr("(first * shard_size) div greatest(blocks, 1)"),
        "high": F.expr("((first + won % greatest(blocks, 1)) * shard_size) "
                       "div greatest(blocks, 1)")})

    def piece(offset: Column) -> tuple[Column, Column]:
        start = F.greatest(F.col("a") + offset, F.col("low"))
        stop = F.least(F.col("b") + offset, F.col("high"))
        return (start - F.col("a") - offset), F.greatest(stop - start, F.lit(0))

    (from1, words1), (from2, words2) = piece(F.lit(0)), piece(F.col("shard_size"))
    return run.withColumns({"from1": from1, "words1": words1, "from2": from2, "words2": words2}
                           ).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") * F.col("size") + F.col("words1") + F.col("words2")).alias("taken"),
        "copies", "from1", "words1", "from2", "words2", *(["_row"] if keep_rows else []))


def dealt(rows: DataFrame, sources: DataFrame, seed: str) -> DataFrame:
    """Rows with their source's figures, their seeded draw and their shard."""
    # Sources are few; their table is joined by value, a null source to itself.
    return (
        rows.join(sources.withColumnRenamed("source", "_source"),
                  F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("draw", draw("doc_id", seed=seed))
        .withColumn("shard", F.pmod("draw", F.ceil(F.sqrt("documents")))))


def shard_quotas(placed: DataFrame, block_words: int) -> DataFrame:
    """Per shard: its words, its blocks and the blocks it has to give."""
    shards = placed.groupBy("sid", "shard", "source_size", "target").agg(
        F.sum("size").alias("shard_size"))
    blocks = F.when(F.col("shard_size") > 0, F.greatest(F.lit(1), F.expr(
        f"(2 * shard_size + {block_words}) div {2 * block_words}"))).otherwise(0)
    of_source = Window.partitionBy("sid")
    shards = shards.withColumn("blocks", blocks.cast("long")).withColumn(
        "source_blocks", F.sum("blocks").over(of_source))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")
                    * F.col("source_blocks")).otherwise(0.0)
    sources = shards.select("sid", "source_blocks", wanted.alias("votes")).distinct().withColumn(
        "all", F.lit(0))
    sources = sources.withColumn("seats", F.floor(
        F.sum("votes").over(Window.partitionBy("all")) + 0.5))
    per_source = apportion(sources, ["all"], "sid").select(
        "sid", F.least("won", F.col("source_blocks") * MOST_REPEATS).alias("seats"))
    votes = shards.join(per_source, "sid").select(
        "sid", "shard", "shard_size", "blocks", F.col("blocks").alias("votes"), "seats")
    return apportion(votes, ["sid"], "shard").select("sid", "shard", "shard_size", "blocks", "won")


def taken_texts(plan: DataFrame, text_column: str = "text",
                length_column: str = "n_chars") -> DataFrame:
    """Documents as the mix takes them: whole copies, and pieces as rows of their own.

    ``plan`` is the result of ``mix`` with ``keep_rows``; the columns are those of the documents. A
    piece's words are joined by one space, and its length, if there is such a column, is its own.
    """
    def cut(start: str, n: str) -> Column:
        found = F.regexp_extract_all(text_column, F.lit(f"({WORD})"), F.lit(1))
        return F.array_join(F.slice(found, (F.col(start) + 1).cast("int"), F.col(n).cast("int")), " ")

    def entire(n: str) -> Column:
        return (F.col(n) == F.col("size")) & (F.col("size") > 0)

    nothing = F.lit(0).cast("long")
    wholes = F.array_repeat(F.struct(F.lit(True).alias("whole"), nothing.alias("a"), nothing.alias("n")),
                            (F.col("copies") + entire("words1").cast("int")
                             + entire("words2").cast("int")).cast("int"))
    pieces = F.filter(F.array(*(
        F.struct(F.lit(False).alias("whole"), F.col(a).cast("long").alias("a"),
                 F.when(~entire(n), F.col(n)).otherwise(nothing).cast("long").alias("n"))
        for a, n in (("from1", "words1"), ("from2", "words2")))), lambda x: x["n"] > 0)
    # One pass: the texts are shuffled once for both kinds of rows.
    rows = plan.withColumn("_take", F.explode(F.concat(wholes, pieces))).select(
        "_row.*", F.col("_take.whole").alias("_whole"), F.col("_take.a").alias("_a"),
        F.col("_take.n").alias("_n"))
    rows = rows.withColumn(text_column, F.when(F.col("_whole"), F.col(text_column)).otherwise(
        cut("_a", "_n")))
    if length_column in rows.columns:
        rows = rows.withColumn(length_column, F.when(F.col("_whole"), F.col(length_column)).otherwise(
            F.length(text_column).cast(rows.schema[length_column].dataType)))
    return rows.drop("_whole", "_a", "_n")
