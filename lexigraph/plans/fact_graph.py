"""The patient-centred fact graph: patients, facts, shared concepts, and edges between them.

Attribute values are found by a join and pivoted onto their facts; a fact is its (key, label).
Mentions: id, word, label, start, end, seq, the four flags, cui, canonical_name.
Relations: id, entity1, label1, relation, entity2, label2, relation_score, assertion, seq.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ontology, text
from ..functions.ontology import ATTRIBUTE_FIELDS, DEMOGRAPHIC_LABELS, RESOURCES
from ..operators.assertion import mention_status
from ..operators.dedup import first_per_key
from ..runtime import cut
from .concept_graph import display_name, first_value, node_key

FAMILY = "FAMILY_HISTORY"
FACT_LABELS = (*RESOURCES, FAMILY)


def _lookup(table: dict[str, str], key: Column, default: str | None) -> Column:
    found = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def patients(mentions: DataFrame) -> DataFrame:
    """One row for each record with a mention; of each demographic label the first word."""
    first = [F.min_by("word", F.when(F.col("label") == label, F.col("seq"))) for label in DEMOGRAPHIC_LABELS]
    return mentions.groupBy(F.col("id").cast("string").alias("id")).agg(*(F.coalesce(c, F.lit("")).alias(label.lower()) for c, label in zip(first, DEMOGRAPHIC_LABELS, strict=True))).select(F.col("id").alias("key"), "*")


def assertion_of_fact() -> Column:
    """The mention's statuses; family history always has the family axis."""
    status = mention_status()
    return F.when((F.col("label") != FAMILY) | F.contains(status, F.lit("family")), status).when(status == "affirmed", "family").otherwise(F.concat(status, F.lit("+family")))


def resource(label: Column, assertion: Column) -> Column:
    """Resource type; whatever concerns the family is FamilyMemberHistory, but places and body parts are not persons'."""
    own = _lookup(RESOURCES, label, "Observation")
    return F.when(F.contains(assertion, F.lit("family")) & ~own.isin("BodyStructure", "Location"), "FamilyMemberHistory").otherwise(own)


def verification(assertion: Column) -> Column:
    return F.when(F.contains(assertion, F.lit("negated")), "refuted").when(F.contains(assertion, F.lit("uncertain")), "provisional").otherwise("confirmed")


def clinical(assertion: Column) -> Column:
    return F.when(F.contains(assertion, F.lit("historical")), "inactive").otherwise("active")


def relative(word: Column) -> Column:
    """The first of the relatives' terms that the word contains, else ''."""
    return F.coalesce(F.get(F.filter(F.array(*map(F.lit, ontology.RELATIVES)), lambda t: F.contains(F.lower(word), t)), F.lit(0)), F.lit(""))


def bare_facts(mentions: DataFrame) -> DataFrame:
    """Facts without attribute fields, with label, id and seq."""
    rows = mentions.where(F.col("label").isin(*FACT_LABELS)).withColumn("assertion", assertion_of_fact())
    placed = F.concat_ws(":", F.col("id").cast("string"), F.col("start").cast("string"), F.col("end").cast("string"))
    key = F.when(F.col("start").isNotNull() & F.col("end").isNotNull(), placed).otherwise(F.concat_ws(":", F.col("id").cast("string"), F.lit("na"), F.col("seq").cast("string")))
    a = F.col("assertion")
    return rows.select(
        key.alias("key"), resource(F.col("label"), a).alias("resource"), "word", display_name(F.col("word"), F.col("cui"), F.col("canonical_name")).alias("name"), F.col("id").cast("string").alias("source_id"),
        "start", "end", F.coalesce(text.usable(F.col("cui")), F.lit("")).alias("cui"), node_key(F.col("word"), F.col("cui")).alias("code_key"), "assertion", verification(a).alias("verificationStatus"), clinical(a).alias("clinicalStatus"),
        F.when(F.col("label") == FAMILY, relative(F.col("word"))).otherwise("").alias("relative"), "label", "seq",
    )


def _ends(facts: DataFrame, k: int) -> DataFrame:
    """Facts by record, lower-cased word and label: _k<k> (key), _s<k> (seq)."""
    return facts.select(F.col("source_id"), F.lower("word").alias(f"_w{k}"), F.col("label").alias(f"label{k}"), F.col("key").alias(f"_k{k}"), F.col("seq").alias(f"_s{k}"))


def routed(relations: DataFrame, roles: DataFrame) -> DataFrame:
    """relations with role (default clinical), canonical type, inverse and field, and the lower-cased ends."""
    rows = relations.join(F.broadcast(roles), "relation", "left")  # the role table: a fixed argument
    return rows.withColumns(
        {"role": F.coalesce("role", F.lit("clinical")), "type": F.coalesce("canonical", "relation"), "inverse": F.coalesce("inverse", F.lit(False)), "source_id": F.col("id").cast("string"), "_w1": F.lower("entity1"), "_w2": F.lower("entity2")}
    )


def _has(facts: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with _f1 and _f2: whether their ends are facts. A record's facts are packed: one join, by record."""
    known = facts.select("source_id", F.lower("word").alias("_w"), F.col("label").alias("_l")).distinct().groupBy("source_id").agg(F.collect_list(F.struct("_w", "_l")).alias("_all"))
    out = rows.join(known, "source_id", "left")
    held = lambda k: F.coalesce(F.exists("_all", lambda e: (e["_w"] == F.col(f"_w{k}")) & (e["_l"] == F.col(f"label{k}"))), F.lit(False))
    return out.withColumns({"_f1": held(1), "_f2": held(2)}).drop("_all")


def attributes(facts: DataFrame, routed_relations: DataFrame) -> DataFrame:
    """source_id, _w1 (lower-cased word), label1 and one column for each field: of the values of these facts the first by
    the relations' order. All facts of a record's word and label have the same.

    The host is the end that is a fact; of two facts the subject, but a laboratory value is always the value."""
    rows = _has(facts, routed_relations.where("role = 'attribute'"))
    second = (F.col("_f1") & F.col("_f2") & (F.col("label1") == "LAB_VALUE")) | (~F.col("_f1") & F.col("_f2"))
    hosted = rows.where("_f1 or _f2").select(
        "source_id", F.when(second, F.col("_w2")).otherwise(F.col("_w1")).alias("_w1"), F.when(second, F.col("label2")).otherwise(F.col("label1")).alias("label1"), F.when(second, F.col("entity1")).otherwise(F.col("entity2")).alias("_value"), "field", F.col("seq").alias("_seq"),
    )
    return hosted.groupBy("source_id", "_w1", "label1").agg(*(F.min_by("_value", F.when((F.col("field") == f) & (F.col("_value") != ""), F.col("_seq"))).alias(f) for f in ATTRIBUTE_FIELDS))


def facts(mentions: DataFrame, relations: DataFrame, roles: DataFrame) -> DataFrame:
    """All facts with their attribute fields ('' where there is none), and label and seq."""
    bare = bare_facts(mentions)
    fields = attributes(bare, routed(relations, roles)).withColumnRenamed("label1", "label")
    return bare.withColumn("_w1", F.lower("word")).join(fields, ["source_id", "_w1", "label"], "left").select(*bare.columns, *ATTRIBUTE_FIELDS).withColumns({f: F.coalesce(f, F.lit("")) for f in ATTRIBUTE_FIELDS})


def coded_mentions(mentions: DataFrame) -> DataFrame:
    """Mentions that have a concept: all but demographics and subjects; with key and cname."""
    rows = mentions.where(~F.col("label").isin(*DEMOGRAPHIC_LABELS, "SUBJECT"))
    return rows.withColumns({"key": node_key(F.col("word"), F.col("cui")), "cname": display_name(F.col("word"), F.col("cui"), F.col("canonical_name"))})


def concepts(mentions: DataFrame) -> DataFrame:
    """key, name, entity_type, cui, count: first values by (id, seq)."""
    rows = coded_mentions(mentions).withColumn("_o", F.struct("id", "seq"))
    return rows.groupBy("key").agg(first_value("cname", "_o").alias("name"), first_value("label", "_o").alias("entity_type"), F.coalesce(first_value("cui", "_o"), F.lit("")).alias("cui"), F.count("*").alias("count"))


def swapped() -> Column:
    """Whether an edge runs from the object to the subject: for inverse relations, and where only the object's
    resource is one that the relation starts from."""
    turn = F.col("inverse")
    for relation, subjects in ontology.DIRECTIONS.items():
        r1, r2 = (_lookup(RESOURCES, F.col(f"label{k}"), "") for k in (1, 2))
        turn = turn | ((F.col("type") == relation) & r2.isin(*subjects) & ~r1.isin(*subjects))
    return turn


def clinical_edges(facts_: DataFrame, routed_relations: DataFrame) -> DataFrame:
    """One edge for each pair of facts that stand for a clinical relation's ends."""
    rows = routed_relations.where("role = 'clinical'").join(_ends(facts_, 1), ["source_id", "_w1", "label1"]).join(_ends(facts_, 2), ["source_id", "_w2", "label2"])
    turn = swapped()
    a, b = F.when(turn, F.col("_k2")).otherwise(F.col("_k1")), F.when(turn, F.col("_k1")).otherwise(F.col("_k2"))
    return rows.select(
        "type", a.alias("start_key"), b.alias("end_key"), F.col("relation_score").cast("double").alias("relation_score"), F.coalesce(text.usable(F.col("assertion")), F.lit("affirmed")).alias("assertion"), "source_id",
        F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(2).alias("phase"), F.struct(F.col("id").cast("string").alias("id"), F.col("seq").cast("string").alias("seq"), F.col("_s1").alias("a"), F.col("_s2").alias("b")).alias("order"),
    )


def edge_parts(mentions: DataFrame, relations: DataFrame, facts_: DataFrame, roles: DataFrame, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(bundles, singles): the edges, but those between facts as one row for all pairs of facts of two words.

    A word's facts in a record (of one label) have the same clinical edges, so a bundle holds both sides' facts (_starts and
    _ends: key, seq and the columns to carry) and stands for all pairs of them: nothing that grows with the pairs is ever exchanged or
    written. Records in which facts share a key, or a relation is named like one of the graph's own types, are settled edge
    by edge."""
    none, blank, no = F.lit(None).cast("double"), F.lit(""), F.lit(None).cast("int")
    order = F.struct(F.col("source_id").alias("id"), F.col("seq").cast("string").alias("seq"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")).alias("order")
    rows = cut(routed(relations, roles).where("role = 'clinical'").withColumn("_turn", swapped()))  # written: it is read in many places
    mixed = facts_.groupBy("source_id", "key").count().where("count > 1").select("source_id").unionByName(rows.where(F.col("type").isin(*OWN_TYPES)).select("source_id"))
    mixed = cut(mixed.distinct())
    plain = mixed.isEmpty()
    apart = lambda df, how: df.join(mixed, "source_id", how)
    subject = lambda df: df.select(F.lit("SUBJECT").alias("type"), F.col("key").alias("start_key"), F.col("source_id").alias("end_key"), none.alias("relation_score"), blank.alias("assertion"), "source_id", "start", "end", F.lit(0).alias("phase"), order)
    code = lambda df: df.select(F.lit("HAS_CODE").alias("type"), F.col("key").alias("start_key"), F.col("code_key").alias("end_key"), none.alias("relation_score"), blank.alias("assertion"), "source_id", no.alias("start"), no.alias("end"), F.lit(1).alias("phase"), order)
    context = coded_mentions(mentions).where(~F.col("label").isin(*FACT_LABELS)).withColumn("source_id", F.col("id").cast("string"))
    seen = context.select(F.lit("MENTIONS").alias("type"), F.col("source_id").alias("start_key"), F.col("key").alias("end_key"), none.alias("relation_score"), mention_status().alias("assertion"), "source_id", "start", "end", F.lit(3).alias("phase"), order)
    again = seen
    if not plain:
        odd = apart(facts_, "left_semi")
        again = seen.unionByName(subject(odd)).unionByName(code(odd)).unionByName(clinical_edges(odd, apart(rows, "left_semi")))
    own, rows = (facts_, rows) if plain else (apart(facts_, "left_anti"), apart(rows, "left_anti"))
    singles = first_per_key(again, ["type", "start_key", "end_key"], ["phase", "order"]).unionByName(subject(own)).unionByName(code(own)).drop("phase", "order")
    return _bundles(own, rows, carry), singles


#: Types of edges that aren't read off relations.
OWN_TYPES = ("SUBJECT", "HAS_CODE", "MENTIONS")


def _bundles(facts_: DataFrame, rows: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """source_id, type, _sw, _sl, _ew, _el (words and labels of both sides), _p and _q (the first relation as it stands and
    turned, by order), _starts and _ends."""
    turn = F.col("_turn")
    first = F.struct(F.struct(F.col("id").cast("string").alias("id"), F.col("seq").cast("string").alias("seq")).alias("o"), F.col("relation_score").cast("double").alias("relation_score"), F.coalesce(text.usable(F.col("assertion")), F.lit("affirmed")).alias("assertion"))
    side = lambda a, b: F.when(turn, F.col(b)).otherwise(F.col(a))
    grouped = rows.groupBy("source_id", "type", side("_w1", "_w2").alias("_sw"), side("label1", "label2").alias("_sl"), side("_w2", "_w1").alias("_ew"), side("label2", "label1").alias("_el")).agg(F.min(F.when(~turn, first)).alias("_p"), F.min(F.when(turn, first)).alias("_q"))
    held = facts_.groupBy("source_id", F.lower("word").alias("_w"), "label").agg(F.collect_list(F.struct("key", "seq", *carry)).alias("_f"))
    ends = lambda k, name: held.select("source_id", F.col("_w").alias(f"_{k}w"), F.col("label").alias(f"_{k}l"), F.col("_f").alias(name))
    return grouped.join(ends("s", "_starts"), ["source_id", "_sw", "_sl"]).join(ends("e", "_ends"), ["source_id", "_ew", "_el"])


def expanded(bundles: DataFrame, *carry: str) -> DataFrame:
    """The bundles' edges, and of their ends the columns carried. Of a relation and a turned one of equal order the one whose subject is mentioned first stays."""
    one = bundles.select("source_id", "type", "_p", "_q", "_ends", F.explode("_starts").alias("_a"))
    two = one.select("source_id", "type", "_p", "_q", "_a", F.explode("_ends").alias("_b"))
    straight = F.col("_q").isNull() | (F.col("_p.o") < F.col("_q.o")) | ((F.col("_p.o") == F.col("_q.o")) & (F.col("_a.seq") <= F.col("_b.seq")))
    of = lambda c: F.when(straight, F.col(f"_p.{c}")).otherwise(F.col(f"_q.{c}"))
    no = F.lit(None).cast("int")
    return two.select("type", F.col("_a.key").alias("start_key"), F.col("_b.key").alias("end_key"), of("relation_score").alias("relation_score"), of("assertion").alias("assertion"), "source_id", no.alias("start"), no.alias("end"), *(F.col(f"_b.{c}").alias(c) for c in carry))


def edges(mentions: DataFrame, relations: DataFrame, facts_: DataFrame, roles: DataFrame) -> DataFrame:
    """type, start_key, end_key, relation_score, assertion, source_id, start, end: subjects and codes of facts, then
    clinical relations, then mentions that are no facts; of equal (type, start, end) the first stays."""
    bundles, singles = edge_parts(mentions, relations, facts_, roles)
    return singles.unionByName(expanded(bundles))


def role_counts(facts_: DataFrame, relations: DataFrame, roles: DataFrame) -> DataFrame:
    """category, count: what became of the relations."""
    rows = _has(facts_, routed(relations, roles))
    what = (
        F.when(F.col("role") == "attribute", F.when(F.col("_f1") | F.col("_f2"), "attribute_field").otherwise("dropped_unresolved"))
        .when(F.col("role") == "clinical", F.when(F.col("_f1") & F.col("_f2"), "clinical").otherwise("dropped_unresolved"))
        .otherwise(F.col("role"))
    )
    return rows.groupBy(what.alias("category")).count()
