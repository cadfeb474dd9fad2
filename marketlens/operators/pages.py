"""Completeness of paged responses (SRC-5, SET-3) and of cursor chains (SRC-7, SRC-8).

A pager that gives up loads part of a day, and nothing in the data says so. Both operators look at one small row for each page; what they
return are the problems, none for a complete load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MISSING, NO_LAST, DOUBLE, EARLY_END, NO_NUMBER = "missing", "last page missing", "double", "pages after the last", "no number"
OVERLAP, HOLE = "overlap", "hole"


def page_problems(pages: DataFrame, keys: Sequence[str] = ("project", "day"), page: str = "page", more: str = "isNextPage") -> DataFrame:
    """Problems of the page sequences 1, 2, ... of each group: ``keys``, ``problem``, ``first_page``, ``last_page``.

    ``missing``: pages between (or before the first) that are not there, as a range. ``last page missing``: the highest page says that another follows
    (``last_page`` null). ``double``: a number that occurs more than once. ``pages after the last``: a page that says it is the last although
    higher ones exist. ``no number``: pages without one. A null ``more`` says nothing. Null keys form groups like any others.

    Gaps and islands by anti joins on (group, page), so a group with a third of all pages is spread over its page numbers; only the
    ends of the islands meet in a window.
    """
    group = F.struct(*[F.col(k) for k in keys]).alias("g")  # structs with nulls are equal to each other
    known = pages.groupBy(group, F.col(page).cast("long").alias("page")).agg(F.count(F.lit(1)).alias("copies"), F.max(F.col(more).cast("boolean")).alias("more"))
    numbered = known.filter("page is not null")
    first = numbered.join(numbered.select("g", (F.col("page") + 1).alias("page")), ["g", "page"], "left_anti")
    last = numbered.join(numbered.select("g", (F.col("page") - 1).alias("page")), ["g", "page"], "left_anti")
    ends = first.select("g", "page", F.lit(0).alias("side"), "more").unionByName(last.select("g", "page", F.lit(1).alias("side"), "more"))
    w = Window.partitionBy("g").orderBy("page", "side")
    ends = ends.select("g", "page", "side", "more", F.coalesce(F.lag("page").over(w), F.lit(0)).alias("before"), F.lead("page").over(w).alias("after"))
    missing = ends.filter("side = 0 and page > before + 1").select("g", F.lit(MISSING).alias("problem"), (F.col("before") + 1).alias("first_page"),
                                                                  (F.col("page") - 1).alias("last_page"))
    no_last = ends.filter("side = 1 and after is null and more").select("g", F.lit(NO_LAST).alias("problem"), (F.col("page") + 1).alias("first_page"),
                                                                        F.lit(None).cast("long").alias("last_page"))
    single = lambda df, problem: df.select("g", F.lit(problem).alias("problem"), F.col("page").alias("first_page"), F.col("page").alias("last_page"))
    highest = numbered.groupBy("g").agg(F.max("page").alias("highest"))
    early = numbered.filter(~F.col("more")).join(highest, "g").filter("page < highest")
    found = missing
    for part in (no_last, single(numbered.filter("copies > 1"), DOUBLE), single(early, EARLY_END), single(known.filter("page is null"), NO_NUMBER)):
        found = found.unionByName(part)
    return found.select(*[F.col(f"g.{k}").alias(k) for k in keys], "problem", "first_page", "last_page")


def complete_groups(df: DataFrame, problems: DataFrame, keys: Sequence[str] = ("project", "day")) -> DataFrame:
    """The rows of ``df`` whose group has no problem: the gate before a load."""
    bad = problems.select(*[F.col(k).alias(f"__b_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__b_{k}"))
    return df.join(bad, same, "left_anti")


def cursor_problems(pages: DataFrame, keys: Sequence[str] = ("project",), first: str = "first_id", last: str = "last_id", step: int = 1,
                    buckets: int = 256) -> DataFrame:
    """Overlaps and holes of pages that each continue after the last id seen: ``keys``, ``problem``, ``from_id``, ``to_id``.

    ``pages`` has the lowest and highest id of each page. They are swept by their lowest id with the running maximum of the highest: a page that
    begins at or below it was sent (in part) before (``overlap``, the ids sent again), one that begins more than ``step`` above it leaves
    a ``hole`` (the ids between). Pages without ids are passed over.

    Each group is cut into ``buckets`` stretches of the id range, swept apart; what the stretches before one reach is carried in from a
    row for each stretch, so a group with a third of all pages is many windows.
    """
    group = F.struct(*[F.col(k) for k in keys]).alias("g")
    rows = pages.select(group, F.col(first).cast("long").alias("lo"), F.col(last).cast("long").alias("hi")).dropna(subset=["lo", "hi"])
    span = rows.groupBy("g").agg(F.min("lo").alias("least"), ((F.max("lo") - F.min("lo")) / buckets + 1).alias("width"))
    rows = rows.join(span, "g").select("g", "lo", "hi", F.floor((F.col("lo") - F.col("least")) / F.col("width")).alias("bucket"))
    reached = rows.groupBy("g", "bucket").agg(F.max("hi").alias("top"))
    before = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = reached.select("g", "bucket", F.max("top").over(before).alias("carried"))
    w = Window.partitionBy("g", "bucket").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    swept = rows.join(carried, ["g", "bucket"]).withColumn("top", F.greatest(F.max("hi").over(w), F.col("carried")))
    overlap = swept.filter("lo <= top").select("g", F.lit(OVERLAP).alias("problem"), F.col("lo").alias("from_id"), F.least("hi", "top").alias("to_id"))
    hole = swept.filter(F.col("lo") > F.col("top") + step).select("g", F.lit(HOLE).alias("problem"), (F.col("top") + 1).alias("from_id"),
                                                                   (F.col("lo") - 1).alias("to_id"))
    return overlap.unionByName(hole).select(*[F.col(f"g.{k}").alias(k) for k in keys], "problem", "from_id", "to_id")
