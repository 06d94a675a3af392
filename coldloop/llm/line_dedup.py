"""Line dedup: overlapping windows of three lines, found again globally.

Every run of three consecutive lines of a document is hashed. A window that also occurs at an
earlier place, in the order of document ids and lines, marks its three lines; marked lines
go, overlapping windows marking a line once. Blank lines are not counted: a window spans three
lines with something in them, and blank lines stay where they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldloop.llm.text import stored

LINES = 3
# Fixed value: what a blank line consists of.
BLANK = r"\A[\x20\x09-\x0D]*\z"


def numbered_lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda x, i: F.struct(x.alias("line"), i.alias("i")))


def filled_lines(text: Column) -> Column:
    return F.filter(numbered_lines(text), lambda x: ~x["line"].rlike(BLANK))


def windows_of(lines: Column, n: int) -> Column:
    """Each run of ``n`` lines: its number, the places of its lines and two 64-bit hashes."""
    def window(i: Column) -> Column:
        run = [F.get(lines, i + k) for k in range(n)]
        return F.struct(i.alias("at"), F.array(*(x["i"] for x in run)).alias("places"),
                        *(F.xxhash64(F.lit(seed), *(x["line"] for x in run)).alias(f"h{seed}")
                          for seed in (1, 2)))

    last = F.size(lines) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), window))


def kept_lines(text: Column, gone: Column) -> Column:
    """The text without the lines at the places ``gone``, in time linear in its lines.

    The places that stay are a difference of sets. The split text is bound to a name first, as it
    would else be split again for every line.
    """
    def joined(x: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["gone"])
        return F.array_join(F.transform(places, lambda i: F.get(x["lines"], i)), "\n")

    bound = F.struct(F.split(text, "\n").alias("lines"), gone.alias("gone"))
    return F.when(text.isNotNull(), F.get(F.transform(F.array(bound), joined), F.lit(0)))


def deduplicate(docs: DataFrame, n: int = LINES, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed and kept (the text without the removed lines), row by row.

    ``n_lines`` counts lines with something in them. A window's first occurrence is the one of
    the smallest document id, then of the smallest position; a null id comes after all others.
    Rows with equal ids are the same place: what is first in one of them is first in all. Null
    texts have no lines and stay null. Other columns are not read; an empty table gives an empty
    result.

    Windows meet by 128 bits. The first occurrence is a pre-aggregated minimum, so a busy window
    costs one row per task, and the join back to a busy window is split by skew joins.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).alias("text"))
    # Written once, so that a row keeps its number when a task is repeated.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "lines")
    windows = rows.withColumn("filled", filled_lines(F.col("text"))).select(
        "row", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"),
        F.inline(windows_of(F.col("filled"), n)))
    first = windows.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "at")).alias("first"), F.count("*").alias("times")
    ).where("times > 1").drop("times")
    later = windows.join(first, ["h1", "h2"]).where(F.struct("doc", "at") != F.col("first"))
    marked = later.groupBy("row").agg(
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("gone"))
    nothing = F.array().cast("array<int>")
    found = rows.join(marked, "row", "left").withColumn("gone", F.coalesce("gone", nothing))
    return found.select(
        "doc_id", F.coalesce(F.size(filled_lines(F.col("text"))), F.lit(0)).alias("n_lines"),
        F.size("gone").alias("n_removed"),
        kept_lines(F.col("text"), F.col("gone")).alias("kept"))
