"""Linking mentions to shared concepts by an alias table, and looking links up for relation endpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..functions.ontology import ASSERTION_FLAGS, LINK_THRESHOLD
from .dedup import first_per_key


#: Aliases up to so many go to the mentions; with more of them, both are dealt by word.
FEW = 100_000


def alias_links(mentions: DataFrame, aliases: DataFrame, threshold: float = LINK_THRESHOLD, few: bool | None = None) -> DataFrame:
    """mentions with cui, canonical_name and umls_score of the best alias (alias, cui, canonical_name, score) that
    equals the word whatever its case; unlinked ones have '' and no score. Ties go to the least cui.

    A table of few aliases is broadcast: dealt by word, all mentions of a frequent word would meet in one task."""
    few = aliases.limit(FEW + 1).count() <= FEW if few is None else few
    best = first_per_key(aliases.where(F.col("score") >= threshold).withColumn("_w", F.lower("alias")), ["_w"], [F.desc("score"), "cui"])
    best = best.select("_w", "cui", "canonical_name", F.bround("score", 4).alias("umls_score"))
    out = mentions.drop("cui", "canonical_name", "umls_score").withColumn("_w", F.lower("word")).join(F.broadcast(best) if few else best, "_w", "left").drop("_w")
    return out.withColumns({"cui": F.coalesce("cui", F.lit("")), "canonical_name": F.coalesce("canonical_name", F.lit(""))})


def trigrams(word):
    w = F.concat(F.lit("  "), F.lower(word), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 2, F.lit(1))), lambda i: w.substr(i, F.lit(3))))


def fuzzy_links(mentions: DataFrame, aliases: DataFrame, threshold: float = LINK_THRESHOLD) -> DataFrame:
    """Like alias_links, by the share of common character trigrams; the table's own score is not used.

    Two sets of a share of t have a common trigram among the n - ceil(t * n) + 1 rarest of each, and sizes within a factor
    of t. So distinct words meet aliases by an equi-join on rare trigrams only, and common ones make no candidates."""
    words = mentions.select(F.lower("word").alias("_w")).distinct().withColumn("_g", trigrams(F.col("_w")))
    named = aliases.select("alias", "cui", "canonical_name").distinct().withColumn("_h", trigrams(F.col("alias")))
    known = named.select(F.explode("_h").alias("_t")).groupBy("_t").count()

    def rarest(df: DataFrame, grams: str, keys: list[str]) -> DataFrame:
        """df with _t: one row for each trigram of the prefix; trigrams of no alias are the rarest."""
        rows = df.select("*", F.explode(grams).alias("_t")).join(known, "_t", "left")
        ordered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "_t"))).alias("_o"))
        n = F.size("_o")
        return ordered.select(*keys, F.explode(F.slice("_o", F.lit(1), (n - F.ceil(n * threshold - 1e-9) + 1).cast("int"))).alias("_x")).select(*keys, "_x._t")

    left, right = rarest(words, "_g", ["_w", "_g"]), rarest(named, "_h", ["alias", "cui", "canonical_name", "_h"])
    near = (F.size("_h") >= F.size("_g") * (threshold - 1e-9)) & (F.size("_g") >= F.size("_h") * (threshold - 1e-9))
    pairs = left.join(right, "_t").where(near).drop("_t").dropDuplicates(["_w", "alias", "cui", "canonical_name"])
    common = F.size(F.array_intersect("_g", "_h"))
    scored = pairs.select(F.col("_w").alias("alias"), "cui", "canonical_name", (common / (F.size("_g") + F.size("_h") - common)).alias("score"))
    return alias_links(mentions, scored, threshold, few=False)


LINKERS: dict[str, Callable[..., DataFrame]] = {"alias": alias_links, "fuzzy": fuzzy_links}
#: Named, but not built: it would need a model pack of its own.
UNAVAILABLE = ("medcat",)


def linked(mentions: DataFrame, aliases: DataFrame, backend: str = "alias", threshold: float = LINK_THRESHOLD) -> DataFrame:
    if backend in UNAVAILABLE:
        raise NotImplementedError(f"linker {backend!r} is not available")
    if backend not in LINKERS:
        raise ValueError(f"unknown linker {backend!r}")
    return LINKERS[backend](mentions, aliases, threshold)


def endpoint_links(relations: DataFrame, mentions: DataFrame) -> DataFrame:
    """relations with each endpoint's cui and canonical_name: those of the first mention (by seq) of its key, else ''."""
    by_key = mentions.groupBy("id", F.lower("word").alias("_w"), F.col("label").alias("_l")).agg(F.min_by(F.struct(F.coalesce("cui", F.lit("")).alias("cui"), F.coalesce("canonical_name", F.lit("")).alias("name")), "seq").alias("_c"))
    out = relations
    for k in (1, 2):
        side = by_key.select("id", F.col("_w").alias(f"_w{k}"), F.col("_l").alias(f"entity{k}_label"), F.col("_c").alias(f"_c{k}"))
        out = out.withColumn(f"_w{k}", F.lower(f"entity{k}")).join(side, ["id", f"_w{k}", f"entity{k}_label"], "left")
        out = out.withColumns({f"entity{k}_cui": F.coalesce(f"_c{k}.cui", F.lit("")), f"entity{k}_canonical_name": F.coalesce(f"_c{k}.name", F.lit(""))}).drop(f"_w{k}", f"_c{k}")
    return out




def annotated(relations: DataFrame, mentions: DataFrame) -> DataFrame:
    """assertion.endpoint_flags and endpoint_links in one join by record: a record's words are packed, and each relation finds
    its two ends among them in its row. Relations that are dealt by record already stay where they are."""
    names = [name for name, _ in ASSERTION_FLAGS]
    by_key = mentions.groupBy("id", F.lower("word").alias("_w"), F.col("label").alias("_l")).agg(
        *(F.bool_or(F.coalesce(n, F.lit(False))).alias(n) for n in names), F.min_by(F.struct(F.coalesce("cui", F.lit("")).alias("cui"), F.coalesce("canonical_name", F.lit("")).alias("name")), "seq").alias("_c")
    )
    own = by_key.groupBy("id").agg(F.collect_list(F.struct("_w", "_l", *names, "_c")).alias("_all"))
    out = relations.join(own, "id", "left")
    end = lambda word, label: F.get(F.filter("_all", lambda e: (e["_w"] == F.lower(word)) & (e["_l"] == F.col(label))), F.lit(0))
    out = out.withColumns({f"_{k}": end(f"entity{k}", f"entity{k}_label") for k in (1, 2)}).drop("_all")
    for k in (1, 2):
        flags = {f"entity{k}_{n.removeprefix('is_')}": F.coalesce(f"_{k}.{n}", F.lit(False)) for n in names}
        out = out.withColumns(flags | {f"entity{k}_cui": F.coalesce(f"_{k}._c.cui", F.lit("")), f"entity{k}_canonical_name": F.coalesce(f"_{k}._c.name", F.lit(""))})
    either = [(F.col(f"entity1_{n.removeprefix('is_')}") | F.col(f"entity2_{n.removeprefix('is_')}"), s) for n, s in ASSERTION_FLAGS]
    return out.drop("_1", "_2").withColumn("assertion", text.statuses(either))
