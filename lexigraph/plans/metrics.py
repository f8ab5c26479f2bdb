"""Metric tables over mentions and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ontology
from ..operators.dedup import method_overlap


def _pct(count: Column, of: Column) -> Column:
    return F.when(of > 0, F.lit(100.0) * count / of).otherwise(0.0)


def counts(df: DataFrame, *keys: str) -> DataFrame:
    """keys, count, pct. The window runs over the aggregated rows only."""
    return df.groupBy(*keys).count().withColumn("pct", _pct(F.col("count"), F.sum("count").over(Window.partitionBy())))


def label_distribution(mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """label, count, pct for every label of the ontology, zeros included."""
    full = labels.join(mentions.groupBy("label").count(), "label", "left").select("label", F.coalesce("count", F.lit(0)).cast("long").alias("count"))
    return full.withColumn("pct", _pct(F.col("count"), F.sum("count").over(Window.partitionBy())))


def ontology_coverage(mentions: DataFrame, labels: DataFrame) -> DataFrame:
    """label, present, count for every label."""
    return label_distribution(mentions, labels).select("label", (F.col("count") > 0).alias("present"), "count")


def coverage_summary(mentions: DataFrame, labels: DataFrame) -> DataFrame:
    return ontology_coverage(mentions, labels).agg(F.count_if("present").alias("used"), F.count("*").alias("total"), _pct(F.count_if("present"), F.count("*")).alias("pct"))


def method_counts(df: DataFrame) -> DataFrame:
    return counts(df, "method")


def confidence(mentions: DataFrame) -> DataFrame:
    """Score statistics of each method; quartiles interpolate."""
    quartile = lambda q: F.percentile("score", F.lit(q))
    return mentions.groupBy("method").agg(
        F.count("score").alias("count"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"), F.min("score").alias("min"), quartile(0.25).alias("q25"), quartile(0.5).alias("q50"), quartile(0.75).alias("q75"), F.max("score").alias("max")
    )


def mention_overlap(mentions: DataFrame, first: str = "neural", second: str = "gazetteer") -> DataFrame:
    return method_overlap(mentions.withColumn("_w", F.lower("word")), ["id", "_w", "label"], "method", first, second)


def relation_overlap(relations: DataFrame, first: str = "spacy_lexical", second: str = "biolink_bert") -> DataFrame:
    return method_overlap(relations, ["id", "entity1", "relation", "entity2"], "method", first, second)


def by_method(df: DataFrame, key: str, methods: tuple[str, ...]) -> DataFrame:
    """key, one count for each method named, and their total; other methods don't count."""
    table = df.groupBy(key).agg(*(F.count_if(F.col("method") == m).alias(m) for m in methods))
    return table.withColumn("total", sum((F.col(m) for m in methods[1:]), F.col(methods[0])))


def per_label(mentions: DataFrame, methods: tuple[str, ...] = ("neural", "gazetteer")) -> DataFrame:
    return by_method(mentions, "label", methods)


def per_relation(relations: DataFrame, methods: tuple[str, ...] = ("spacy_lexical", "biolink_bert")) -> DataFrame:
    return by_method(relations, "relation", methods)


def relation_distribution(relations: DataFrame) -> DataFrame:
    """relation, count, pct, cum_pct (from the most frequent on; ties by name). At most one row for each relation."""
    running = Window.orderBy(F.desc("count"), "relation").rowsBetween(Window.unboundedPreceding, 0)
    rows = relations.groupBy("relation").count()
    total = F.sum("count").over(Window.partitionBy())
    return rows.select("relation", "count", _pct(F.col("count"), total).alias("pct"), _pct(F.sum("count").over(running), total).alias("cum_pct"))


def top_patterns(relations: DataFrame, limit: int | None = None) -> DataFrame:
    """entity1_label, relation, entity2_label, count, pct; a limit gives the most frequent."""
    rows = counts(relations, "entity1_label", "relation", "entity2_label")
    return rows if limit is None else rows.orderBy(F.desc("count"), "entity1_label", "relation", "entity2_label").limit(limit)


def label_pairs(relations: DataFrame, labels: list[str] = ontology.ENTITY_LABELS) -> DataFrame:
    """Matrix of counts: a row for each first label, a column for each label of the ontology."""
    return relations.groupBy("entity1_label").agg(*(F.count_if(F.col("entity2_label") == x).alias(x) for x in labels))


def entity_hubs(relations: DataFrame, limit: int | None = None) -> DataFrame:
    """entity, label, out_degree, in_degree, total: one aggregation over both ends, no join."""
    ends = relations.select(F.inline(F.array(*(F.struct(F.col(f"entity{k}").alias("entity"), F.col(f"entity{k}_label").alias("label"), F.lit(k).alias("k")) for k in (1, 2)))))
    rows = ends.groupBy("entity", "label").agg(F.count_if(F.col("k") == 1).alias("out_degree"), F.count_if(F.col("k") == 2).alias("in_degree"), F.count("*").alias("total"))
    return rows if limit is None else rows.orderBy(F.desc("total"), "entity", "label").limit(limit)


def document_frequency(mentions: DataFrame, labels: DataFrame, n_docs: Column | None = None) -> DataFrame:
    """label, mentions, pct_mentions, docs, pct_docs (of records with a mention) for every label."""
    total = mentions.agg(F.count("*").alias("_m"), F.countDistinct("id").alias("_d"))
    rows = labels.join(mentions.groupBy("label").agg(F.count("*").alias("mentions"), F.countDistinct("id").alias("docs")), "label", "left")
    filled = rows.select("label", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("mentions", "docs"))).join(F.broadcast(total))  # one row of totals
    return filled.select("label", "mentions", _pct(F.col("mentions"), F.col("_m")).alias("pct_mentions"), "docs", _pct(F.col("docs"), F.col("_d")).alias("pct_docs"))


def id_counts(df: DataFrame, key: str = "id") -> DataFrame:
    return df.groupBy(key).count()


def agreement(found: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """precision, recall and f1 of distinct keys against a gold annotation."""
    sides = found.select(*keys, F.lit(True).alias("_f")).distinct().join(gold.select(*keys, F.lit(True).alias("_g")).distinct(), keys, "full_outer")
    n = sides.agg(F.count_if(F.col("_f") & F.col("_g")).alias("tp"), F.count_if("_f").alias("found"), F.count_if("_g").alias("gold"))
    p, r = F.try_divide("tp", "found"), F.try_divide("tp", "gold")
    return n.select("tp", "found", "gold", p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"))


def every(mentions: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """All metric tables of a run, by name."""
    spark = mentions.sparkSession
    labels = ontology.labels(spark)
    return {
        "label_distribution": label_distribution(mentions, labels), "ontology_coverage": ontology_coverage(mentions, labels), "coverage_summary": coverage_summary(mentions, labels),
        "mention_methods": method_counts(mentions), "confidence": confidence(mentions), "mention_overlap": mention_overlap(mentions), "mentions_per_label": per_label(mentions),
        "document_frequency": document_frequency(mentions, labels), "mention_ids": id_counts(mentions), "relation_methods": method_counts(relations), "relation_overlap": relation_overlap(relations),
        "relations_per_method": per_relation(relations), "relation_distribution": relation_distribution(relations), "top_patterns": top_patterns(relations), "label_pairs": label_pairs(relations),
        "entity_hubs": entity_hubs(relations), "relation_ids": id_counts(relations),
    }
