"""Joint extraction: one generated answer holds the entities and the relations of several records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ontology, text
from ..functions.ontology import ASSERTION_FLAGS
from .dedup import priority_dedup
from .models import batched
from .relations import licensed

METHOD = "holistic"
ANSWER = (
    "records array<struct<id: string, entities: array<struct<text: string, label: string, confidence: string, "
    + ", ".join(f"{s}: boolean" for _, s in ASSERTION_FLAGS)
    + ">>, relations: array<struct<entity1: string, entity2: string, relation: string, confidence: string>>>>"
)


def triples_by_subject(licences: dict[tuple[str, str], list[str]] = ontology.LICENCES) -> str:
    """The licence table as prompt text: one line for each subject label."""
    lines: dict[str, list[str]] = {}
    for (a, b), relations in licences.items():
        lines.setdefault(a, []).extend(f"{r} {b}" for r in relations)
    return "\n".join(f"{a}: " + ", ".join(x) for a, x in sorted(lines.items()))


def prompts(df: DataFrame, size: int = ontology.JOINT_BATCH, body: str = "text_en", with_assertions: bool = True) -> DataFrame:
    """batch, ids, prompt: `size` records as JSON under the ontology's labels and triples."""
    rows = batched(df.where(text.not_blank(F.col(body))).select("id", F.col(body).alias("text_en")), size, ["id"])
    flags = "".join(f', "{s}": false' for _, s in ASSERTION_FLAGS) if with_assertions else ""
    head = (
        "Extract the entities and the relations of each record.\nLabels: " + ", ".join(ontology.ENTITY_LABELS) + "\nRelations that a pair (subject: RELATION object) may have:\n" + triples_by_subject()
        + '\nAnswer with JSON alone: {"records": [{"id": "", "entities": [{"text": "", "label": "", "confidence": 0.0' + flags + '}], "relations": [{"entity1": "", "entity2": "", "relation": "", "confidence": 0.0}]}]}\nRecords: '
    )
    record = F.to_json(F.array_sort(F.collect_list(F.struct(F.col("id").cast("string").alias("id"), F.col("text_en").alias("sentence")))))
    return rows.groupBy("batch").agg(F.collect_list("id").alias("ids"), F.concat(F.lit(head), record).alias("prompt"))


def payloads(answers: DataFrame) -> DataFrame:
    """One row for each record of the answers: _id and payload. The JSON is what lies between the first { and the last }."""
    body = F.regexp_extract("answer", r"(?s)(\{.*\})", 1)
    return answers.select(F.explode(F.from_json(body, ANSWER)["records"]).alias("payload")).select(text.stripped(F.col("payload.id")).alias("_id"), "payload")


def extracted(answers: DataFrame, docs: DataFrame, licences: DataFrame, with_assertions: bool = True, threshold: float = ontology.GENERATED_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(mentions, relations): labels, licences and thresholds checked; a relation's ends must be extracted entities
    of its record, and have the label of the first entity with that text."""
    rows = docs.select("id", F.col("id").cast("string").alias("_id"), "text_en").join(payloads(answers), "_id")
    ents = rows.select("id", "text_en", F.posexplode("payload.entities").alias("seq", "_e"))
    word, score = text.stripped(F.col("_e.text")), F.coalesce(F.expr("try_cast(_e.confidence as double)"), F.lit(0.0))
    flags = [(F.coalesce(F.col(f"_e.{s}"), F.lit(False)) if with_assertions else F.lit(None).cast("boolean")).alias(c) for c, s in ASSERTION_FLAGS]
    named = ents.select("id", word.alias("word"), F.upper(text.stripped(F.col("_e.label"))).alias("label"), F.bround(score, 4).alias("score"), "text_en", F.col("seq").cast("long").alias("seq"), *flags)
    start = text.first_start(F.col("text_en"), F.col("word"))
    valid = named.where(F.col("label").isin(*ontology.ENTITY_LABELS) & (F.col("word") != ""))
    mentions = valid.select("id", "word", "label", "score", "text_en", F.lit(METHOD).alias("method"), start.cast("int").alias("start"), (start + F.length("word")).cast("int").alias("end"), "seq", *(c for c, _ in ASSERTION_FLAGS))
    first = mentions.groupBy("id", F.lower("word").alias("_w")).agg(F.min_by("label", "seq").alias("_label"))
    rels = rows.select("id", "text_en", F.posexplode("payload.relations").alias("seq", "_r"))
    flat = rels.select(
        "id", F.col("text_en").alias("sentence"), F.col("seq").cast("long").alias("seq"), text.stripped(F.col("_r.entity1")).alias("entity1"), text.stripped(F.col("_r.entity2")).alias("entity2"),
        F.upper(text.stripped(F.col("_r.relation"))).alias("relation"), F.bround(F.coalesce(F.expr("try_cast(_r.confidence as double)"), F.lit(0.0)), 4).alias("score"),
    ).where(F.col("score") >= threshold)
    for k in (1, 2):
        side = first.select("id", F.col("_w").alias(f"_w{k}"), F.col("_label").alias(f"entity{k}_label"))
        flat = flat.withColumn(f"_w{k}", F.lower(f"entity{k}")).join(side, ["id", f"_w{k}"])
    relations = licensed(flat, licences).select("id", "entity1", "entity1_label", "relation", "entity2", "entity2_label", "score", "sentence", F.lit(METHOD).alias("method"), "seq")
    keyed = priority_dedup(mentions.withColumn("_w", F.lower("word")), ["id", "_w", "label"], (METHOD,), ["seq"]).drop("_w")
    return keyed, priority_dedup(relations, ["id", "entity1", "entity2", "relation"], (METHOD,), ["seq"])


def lost_records(asked: DataFrame, answers: DataFrame) -> DataFrame:
    """id of the records that were asked about and that no answer has."""
    return asked.select(F.explode("ids").alias("id")).join(payloads(answers).select("_id"), F.col("id").cast("string") == F.col("_id"), "left_anti")
