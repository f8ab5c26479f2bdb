"""Writers: quoted CSV, the bulk-import dialect of graph loaders, run snapshots, and graph upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ontology, text
from ..schema import conform


def write_csv(df: DataFrame, path: str, schema: T.StructType | None = None, quote_all: bool = True, mode: str = "overwrite") -> None:
    """CSV with a header; with a schema, those of its columns that exist, in its order."""
    if not isinstance(df, DataFrame):
        raise TypeError("a DataFrame is needed")
    out = conform(df, schema, missing=False) if schema is not None else df
    out.write.mode(mode).option("header", True).option("quoteAll", quote_all).option("escape", '"').csv(path)


#: Column names that bulk loaders of property graphs expect.
NODE_HEADER = {"entity_id": ":ID", "key": "key", "name": "name", "label": ":Label", "entity_type": "entity_type", "cui": "cui", "count": "count"}
EDGE_HEADER = {"start_id": ":START_ID", "end_id": ":END_ID", "type": ":TYPE", "start_key": "start_key", "end_key": "end_key", "relation": "relation", "relation_score": "relation_score", "source_id": "source_id", "assertion": "assertion"}
FACT_EDGE_HEADER = {"type": ":TYPE", "start_key": "start_key", "end_key": "end_key", "relation_score": "relation_score", "assertion": "assertion", "source_id": "source_id", "start": "start", "end": "end"}


def bulk_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.select(*(F.col(c).alias(name) for c, name in NODE_HEADER.items()))


def bulk_edges(edges: DataFrame) -> DataFrame:
    rows = edges.withColumn("type", F.col("relation"))
    return rows.select(*(F.col(c).alias(name) for c, name in EDGE_HEADER.items() if c in rows.columns))


def bulk_fact_edges(edges: DataFrame) -> DataFrame:
    return edges.select(*(F.col(c).alias(name) for c, name in FACT_EDGE_HEADER.items()))


def exists(spark: SparkSession, path: str) -> bool:
    """Through Spark's file systems, so that any store will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def materialised(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table at path; made and written first if it isn't there."""
    if not exists(spark, path):
        make().write.parquet(path)
    return spark.read.parquet(path)


def snapshot(tables: dict[str, DataFrame], run_dir: str) -> None:
    """All tables under a new folder; refuses to overwrite a saved run."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{run_dir.rstrip('/')}/{name}")


def of_run(run_dir: str | None, path: str) -> str:
    """The path itself, or the file of that name in a saved run."""
    return f"{run_dir.rstrip('/')}/{path.rsplit('/', 1)[-1]}" if run_dir else path


# ---- property-graph upserts -----------------------------------------------------------------------

def upserted(old: DataFrame | None, new: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """old with new merged in: one row for each key; of several new rows the last by `order` wins, new over old."""
    columns = [c for c in new.columns if c not in (*keys, order)]
    rows = new.select(*keys, F.struct(F.lit(1).alias("age"), F.col(order).cast("string").alias("o")).alias("_o"), F.struct(*columns).alias("_v"))
    if old is not None:
        rows = rows.unionByName(old.select(*keys, F.struct(F.lit(0).alias("age"), F.lit("").alias("o")).alias("_o"), F.struct(*columns).alias("_v")))
    return rows.groupBy(*keys).agg(F.max_by("_v", "_o").alias("_v")).select(*keys, "_v.*")


def concept_vertices(nodes: DataFrame) -> DataFrame:
    """key, label (made an identifier) and properties, ready to be merged."""
    return nodes.select("key", text.identifier(F.col("label"), "Entity").alias("label"), "name", "entity_type", "cui", "count")


def concept_links(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """start_key, end_key, type and properties of the edges whose ends both exist; the last of equal edges wins."""
    known = vertices.select("key")
    rows = edges.where(F.col("start_key").isNotNull() & F.col("end_key").isNotNull()).withColumn("type", text.identifier(F.col("relation"), "RELATED"))
    rows = rows.join(known.withColumnRenamed("key", "start_key"), "start_key", "left_semi").join(known.withColumnRenamed("key", "end_key"), "end_key", "left_semi")
    return rows.select("start_key", "end_key", "type", "relation", "relation_score", "source_id", *(["assertion"] if "assertion" in edges.columns else []))


def numeric(df: DataFrame, fields: Iterable[str] = ontology.NUMERIC_FIELDS) -> DataFrame:
    """df with numeric fields as their leading number and, where they have one, <field>_unit; no digits, no value."""
    out = df
    for f in (f for f in fields if f in df.columns):
        if f in ontology.UNIT_FIELDS:
            out = out.withColumn(f"{f}_unit", F.when(text.leading_number(F.col(f)).isNotNull(), text.unit_after_number(F.col(f))))
        out = out.withColumn(f, text.leading_number(F.col(f)))
    return out


def properties(df: DataFrame, *columns: str) -> DataFrame:
    """df with a map of the columns that have a usable value, instead of the columns."""
    pairs = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*(text.usable(F.col(c)) for c in columns)))
    return df.withColumn("properties", F.map_filter(pairs, lambda k, v: v.isNotNull())).drop(*columns)


def fact_vertices(patients: DataFrame, facts: DataFrame, concepts: DataFrame) -> DataFrame:
    """label, key, properties of all vertices of the fact graph; numbers split from units, blanks left out."""
    def shaped(df: DataFrame, label, keep: list[str]) -> DataFrame:
        wide = numeric(df.select(label.alias("_label"), F.col("key").alias("_key"), *keep))
        named = [c for c in wide.columns if c not in ("_label", "_key")]
        return properties(wide, *named).select(F.col("_label").alias("label"), F.col("_key").alias("key"), "properties")

    keep = lambda df, *drop: [c for c in df.columns if c not in ("key", *drop)]
    return (
        shaped(patients, F.lit("Patient"), keep(patients))
        .unionByName(shaped(facts, text.identifier(F.col("resource"), "Fact"), keep(facts, "label", "seq")))
        .unionByName(shaped(concepts, F.lit("Concept"), keep(concepts)))
    )


#: Labels of the ends of edges of these types: (start, end); other edges run between facts.
END_LABELS = {"SUBJECT": (None, "Patient"), "HAS_CODE": (None, "Concept"), "MENTIONS": ("Patient", "Concept")}


def fact_links(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """The edges whose ends both exist under the label that their type asks for."""
    kinds = vertices.select("key", F.when(F.col("label").isin("Patient", "Concept"), F.col("label")).otherwise("fact").alias("kind")).distinct()
    out = edges
    for k, side in enumerate(("start", "end")):
        wanted = F.lit("fact")
        for kind, ends in END_LABELS.items():
            wanted = F.when(F.col("type") == kind, F.lit(ends[k] or "fact")).otherwise(wanted)
        out = out.withColumn("_kind", wanted).join(kinds.select(F.col("key").alias(f"{side}_key"), F.col("kind").alias("_kind")), [f"{side}_key", "_kind"], "left_semi").drop("_kind")
    return out.select(*edges.columns)


def known_facts(facts: DataFrame, vertices: DataFrame) -> DataFrame:
    """The facts that exist as vertices."""
    return facts.join(vertices.where(~F.col("label").isin("Patient", "Concept")).select("key"), "key", "left_semi")


def for_each_batch(df: DataFrame, connect: Callable[[], Callable[[list[Row]], None]], size: int = 1000) -> None:
    """Sends rows to an outside store in batches; `connect` is called once for each partition."""

    def send(rows: Iterable[Row]) -> None:
        write, held = connect(), []
        for row in rows:
            held.append(row)
            if len(held) == size:
                write(held)
                held = []
        if held:
            write(held)

    df.foreachPartition(send)
