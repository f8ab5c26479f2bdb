"""The concept graph: nodes are shared concepts (or words), edges are relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ontology, text
from ..runtime import written

#: Other names of columns that relation tables come with.
DIALECT = {"entity1_label": "label1", "entity2_label": "label2", "score": "relation_score", "confidence": "relation_score"}


def normalised(relations: DataFrame) -> DataFrame:
    """label1, label2, relation_score and the link columns under these names, whatever dialect the table is in;
    a missing score is 1, missing links are ''."""
    out = relations
    for name, standard in DIALECT.items():
        if name in out.columns and standard not in out.columns:
            out = out.withColumnRenamed(name, standard)
    out = out if "relation_score" in out.columns else out.withColumn("relation_score", F.lit(1.0))
    links = [f"entity{k}_{c}" for k in (1, 2) for c in ("cui", "canonical_name")]
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in out.columns else F.lit("") for c in links})


def node_key(word: Column, cui: Column) -> Column:
    """The concept's identifier, or the word where it isn't linked."""
    return F.coalesce(text.usable(cui), word)


def display_name(word: Column, cui: Column, canonical: Column) -> Column:
    return F.when(text.usable(cui).isNotNull() & text.usable(canonical).isNotNull(), canonical).otherwise(word)


def endpoints(relations: DataFrame) -> DataFrame:
    """One row for each end of each relation: key, name, entity_type, cui and its order (first ends first)."""
    sides = []
    for k in (1, 2):
        word, cui = F.col(f"entity{k}"), F.col(f"entity{k}_cui")
        sides.append(
            F.struct(
                node_key(word, cui).alias("key"), display_name(word, cui, F.col(f"entity{k}_canonical_name")).alias("name"), F.col(f"label{k}").alias("entity_type"), cui.alias("cui"), F.struct(F.lit(k).alias("k"), F.col("seq").alias("seq")).alias("ord"),
            )
        )
    return relations.select(F.inline(F.array(*sides)))


def first_value(value: str, order: str) -> Column:
    """The first value that isn't null."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order)))


def numbered(df: DataFrame, key: str, name: str) -> DataFrame:
    """df with `name` 1..n in order of key. Rows are dealt to ranges once and written with their place in the range; the
    ranges' counts are read off what was written, so places and counts can't come from different ranges."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortWithinPartitions(key)
    # an id is the partition's number << 33 plus the place in it: equal ranges, in order of key
    placed = written(ranged.withColumn("_id", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumns({"_p": F.shiftright("_id", 33), "_n": F.col("_id").bitwiseAND((1 << 33) - 1)})
    before = placed.groupBy("_p").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_before")
    # one row for each range: no more than shuffle partitions, whatever the data
    return placed.join(F.broadcast(before), "_p").withColumn(name, F.col("_n") + F.col("_before") + 1).drop("_p", "_n", "_before", "_id")


def node_label(entity_type: Column, names: dict[str, str] = ontology.NODE_LABELS) -> Column:
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, entity_type), entity_type)


def nodes(relations: DataFrame) -> DataFrame:
    """entity_id, key, name, label, entity_type, cui, count: ends of all relations, merged by key; first values win."""
    merged = endpoints(relations).groupBy("key").agg(first_value("name", "ord").alias("name"), first_value("entity_type", "ord").alias("entity_type"), first_value("cui", "ord").alias("cui"), F.count("*").alias("count"))
    return numbered(merged, "key", "entity_id").select("entity_id", "key", "name", node_label(F.col("entity_type")).alias("label"), "entity_type", F.coalesce("cui", F.lit("")).alias("cui"), "count")


def edges(relations: DataFrame, node_table: DataFrame, threshold: float = ontology.EDGE_THRESHOLD) -> DataFrame:
    """start_id, end_id, start_key, end_key, relation, relation_score, source_id and, if there, assertion, of the
    relations that reach the threshold; parallel edges stay."""
    more = ["assertion"] if "assertion" in relations.columns else []
    rows = relations.where(F.col("relation_score") >= threshold).withColumns({"start_key": node_key(F.col("entity1"), F.col("entity1_cui")), "end_key": node_key(F.col("entity2"), F.col("entity2_cui"))})
    ids = lambda side: node_table.select(F.col("key").alias(f"{side}_key"), F.col("entity_id").alias(f"{side}_id"))
    return rows.join(ids("start"), "start_key").join(ids("end"), "end_key").select("start_id", "end_id", "start_key", "end_key", "relation", "relation_score", F.col("id").cast("string").alias("source_id"), *more)
