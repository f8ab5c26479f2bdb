"""Priority deduplication, first-wins deduplication and greedy overlap resolution.

Order is never taken from row order: each operator names its sequence columns, so that results don't
depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority_rank(method: Column, priority: tuple[str, ...]) -> Column:
    """The method's place in the priority list; unknown methods come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, priority)), method), F.lit(0)), F.lit(len(priority) + 1)).cast("int")


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def priority_dedup(df: DataFrame, keys: list[str | Column], priority: tuple[str, ...], seq: list[str], method: str = "method") -> DataFrame:
    """One row for each key: of the best method, and of that method's rows the first by seq."""
    return first_per_key(df, keys, [priority_rank(F.col(method), priority), *seq])


def resolve_overlaps(df: DataFrame, rank: Column, seq: list[str], record: str = "id", start: str = "start", end: str = "end") -> DataFrame:
    """Greedy, for each record: spans in order of rank, then longest, then seq; a span stays if it overlaps none
    that stays already (half-open test). Rows without offsets always stay."""
    placed = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    spans = F.struct(rank.alias("rank"), (F.col(start) - F.col(end)).alias("short"), *[F.col(c) for c in seq], F.col(start).alias("s"), F.col(end).alias("e"), F.struct(*df.columns).alias("row"))
    # grouping by rows of one record only; a record is a sentence or a document, never an unbounded group
    grouped = placed.groupBy(record).agg(F.sort_array(F.collect_list(spans)).alias("spans"))
    empty = F.slice(F.col("spans"), 1, 0)
    kept = F.aggregate("spans", empty, lambda acc, x: F.when(F.exists(acc, lambda k: (k["s"] < x["e"]) & (x["s"] < k["e"])), acc).otherwise(F.array_append(acc, x)))
    chosen = grouped.select(F.explode(kept).alias("k")).select("k.row.*")
    return chosen.unionByName(df.where(F.col(start).isNull() | F.col(end).isNull()))


def longest_spans(df: DataFrame, seq: list[str], record: str = "id", start: str = "start", end: str = "end") -> DataFrame:
    """The spans that stay when overlaps go to the longest, and of equally long ones to the first: what a tagger's span
    filter does before spans are put on one sequence of tokens."""
    return resolve_overlaps(df, F.lit(0), [start, *seq], record, start, end)


def unordered_pair_dedup(df: DataFrame, keys: list[str], a: str, b: str, seq: list[str]) -> DataFrame:
    """The first row by seq for each unordered pair of values within the keys."""
    return first_per_key(df, [*keys, F.least(a, b), F.greatest(a, b)], seq)


def method_overlap(df: DataFrame, keys: list[str], method: str, first: str, second: str) -> DataFrame:
    """category (both, first_only, second_only), count, pct: how far two methods find the same keys."""
    sides = df.where(F.col(method).isin(first, second)).groupBy(*keys).agg(F.bool_or(F.col(method) == first).alias("a"), F.bool_or(F.col(method) == second).alias("b"))
    counted = sides.groupBy(F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), f"{first}_only").otherwise(f"{second}_only").alias("category")).count()
    named = df.sparkSession.createDataFrame([("both",), (f"{first}_only",), (f"{second}_only",)], "category string")
    full = named.join(counted, "category", "left").select("category", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    total = Window.partitionBy()
    return full.select("category", "count", F.when(F.sum("count").over(total) > 0, 100.0 * F.col("count") / F.sum("count").over(total)).otherwise(0.0).alias("pct"))
