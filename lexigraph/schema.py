"""Schemas of the tables that stages exchange, and conforming to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.ontology import ASSERTION_FLAGS, ATTRIBUTE_FIELDS

_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType()}


def struct(text: str) -> T.StructType:
    """`name type, name type, ...` as a schema; needs no session."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (x.split() for x in text.split(","))])


DOCUMENTS = struct("id long, text string, text_en string, specjalizacja string, kategoria string")
MENTION_CORE = struct("id long, word string, label string, score double, text_en string, method string, start int, end int")
FLAGS = [name for name, _ in ASSERTION_FLAGS]
MENTIONS = T.StructType(
    [*MENTION_CORE.fields, *(T.StructField(f, T.BooleanType()) for f in FLAGS), T.StructField("cui", T.StringType()), T.StructField("canonical_name", T.StringType()), T.StructField("umls_score", T.DoubleType())]
)
RELATION_CORE = struct(
    "id long, entity1 string, entity1_label string, relation string, entity2 string, entity2_label string, score double, sentence string, method string"
)
RELATIONS = T.StructType(
    [
        *RELATION_CORE.fields,
        *(T.StructField(f"entity{k}_{f.removeprefix('is_')}", T.BooleanType()) for k in (1, 2) for f in FLAGS),
        T.StructField("assertion", T.StringType()),
        *(T.StructField(f"entity{k}_{f}", T.StringType()) for k in (1, 2) for f in ("cui", "canonical_name")),
    ]
)
NODES = struct("entity_id long, key string, name string, label string, entity_type string, cui string, count long")
EDGES = struct("start_id long, end_id long, start_key string, end_key string, relation string, relation_score double, source_id string, assertion string")
PATIENTS = struct("key string, id string, age string, height string, occupation string, personal_background string, sex string, weight string")
FACTS = struct(
    "key string, resource string, word string, name string, source_id string, start int, end int, cui string, code_key string, assertion string, "
    "verificationStatus string, clinicalStatus string, " + ", ".join(f"{f} string" for f in ATTRIBUTE_FIELDS) + ", relative string"
)
CONCEPTS = struct("key string, name string, entity_type string, cui string, count long")
FACT_EDGES = struct("type string, start_key string, end_key string, relation_score double, assertion string, source_id string, start int, end int")


def conform(df: DataFrame, schema: T.StructType, missing: bool = True) -> DataFrame:
    """df's columns in the schema's order and types; absent ones as typed nulls, or left out if `missing` is false."""
    return df.select(
        *(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema if missing or f.name in df.columns)
    )
