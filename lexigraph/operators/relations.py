"""Relations between a sentence's entities: lexical triggers, licensed pairs, and similarity to prototypes.

Entities meet only within (id, sent); every emitted relation is licensed for its pair of labels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ontology, text
from ..runtime import cut, kernel, small_batches
from . import scan
from .mentions import pieces
from .dedup import first_per_key, priority_dedup, unordered_pair_dedup

LEXICAL, EMBEDDING = "spacy_lexical", "biolink_bert"


def record_entities(mentions: DataFrame) -> DataFrame:
    """Distinct (word, label) of each record, in order of first mention: id, word, label, ord."""
    return mentions.where(text.not_blank(F.col("word"))).groupBy("id", "word", "label").agg(F.min("seq").alias("ord"))


def held_entities(sents: DataFrame, entities: DataFrame) -> DataFrame:
    """id, sent, sentence, _e: the record's entities (ord, word, label) whose words occur in the sentence, whatever the
    case and not bounded by words; only sentences with two or more.

    A record's entities are packed first, so that each sentence travels once and meets them in its row; what follows by
    record stays where it is."""
    own = entities.groupBy("id").agg(F.collect_list(F.struct("ord", "word", "label", F.lower("word").alias("_low"))).alias("_all"))
    # of whole texts (mentions.text_rows) not even sentences travel
    inside = sents.select("id", "_s").join(own, "id").select("id", "_all", F.posexplode(pieces("_s")).alias("sent", "sentence")) if "_s" in sents.columns else sents.select("id", "sent", "sentence").join(own, "id")
    # a lambda's argument: lower-cased once for all entities
    met = F.transform(F.array(F.lower("sentence")), lambda s: F.struct(F.filter("_all", lambda e: F.contains(s, e["_low"])).alias("_e")))
    held = inside.select("id", "sent", "sentence", F.inline(F.filter(met, lambda x: F.size(x["_e"]) >= 2)))
    return held.withColumn("_e", F.transform("_e", lambda e: e.dropFields("_low")))


def record_rows(texts: DataFrame, entities: DataFrame) -> DataFrame:
    """id, _s, _e: whole texts (mentions.text_rows) with all entities of their record: they meet by record, once."""
    own = entities.groupBy("id").agg(F.collect_list(F.struct("ord", "word", "label")).alias("_e"))
    return texts.join(own, "id")


def sentence_entities(sents: DataFrame, entities: DataFrame) -> DataFrame:
    """held_entities with a row for each entity."""
    return held_entities(sents, entities).select("id", "sent", "sentence", F.inline("_e"))


def packed(entities: DataFrame) -> DataFrame:
    """A sentence's entities in one row, as held_entities has them already."""
    return entities if "_e" in entities.columns else entities.groupBy("id", "sent", "sentence").agg(F.collect_list(F.struct("ord", "word", "label")).alias("_e"))


def licensed(pairs: DataFrame, licences: DataFrame) -> DataFrame:
    """The rows whose relation the pair of labels may have."""
    allowed = licences.select(F.col("label1").alias("entity1_label"), F.col("label2").alias("entity2_label"), "relation").distinct()
    return pairs.join(F.broadcast(allowed), ["entity1_label", "entity2_label", "relation"], "left_semi")  # the licence table: a fixed argument


def lexical_relations(entities: DataFrame, triggers: DataFrame, licences: DataFrame) -> DataFrame:
    """Entities before and after the first occurrence of a trigger. F: before -> after; I: after -> before.

    entities: id, sent, sentence, word, label, ord, or packed, or whole texts (record_rows). A kernel reads each text in its row
    and lays out licensed pairs only (scan.relater); no row is exchanged."""
    small_batches(entities.sparkSession)
    whole = "_s" in entities.columns
    found = entities if whole else packed(entities).withColumn("_s", F.array("sentence"))
    # triggers and licences are small fixed arguments
    listed = [(t["relation"], t["trigger"], t["direction"], t["ord"]) for t in triggers.select("relation", "trigger", F.lower("trigger").alias("low"), "direction", "ord").collect() if t["low"] is not None]
    lows = {t["trigger"]: t["low"] for t in triggers.select("trigger", F.lower("trigger").alias("low")).distinct().collect()}
    may = [tuple(r) for r in licences.select("label1", "label2", "relation").where("label1 is not null and label2 is not null").distinct().collect()]
    scanned = kernel(scan.relater([(r, lows[t], d) for r, t, d, _ in listed], may), scan.RELATED)
    hit = found.withColumn("_r", scanned("_s", _lowered()))
    one = hit.select("id", *([] if whole else ["sent"]), "_e", F.inline("_r"))
    own = F.array(*(F.struct(F.lit(r).alias("relation"), F.lit(t).alias("trigger"), F.lit(o).alias("_t")) for r, t, _, o in listed)) if listed else F.expr("cast(array() as array<struct<relation: string, trigger: string, _t: int>>)")
    laid = one.select("id", F.col("s").alias("sent") if whole else "sent", "sentence", F.get("_e", F.col("x")).alias("_x"), F.get("_e", F.col("y")).alias("_y"), F.get(own, F.col("t")).alias("_h"))
    return laid.select(
        "id", "sent", F.col("_x.word").alias("entity1"), F.col("_x.label").alias("entity1_label"), "_h.relation", F.col("_y.word").alias("entity2"), F.col("_y.label").alias("entity2_label"),
        F.lit(1.0).alias("score"), "sentence", F.lit(LEXICAL).alias("method"), "_h.trigger", F.struct("sent", "_h._t", F.col("_x.ord").alias("x"), F.col("_y.ord").alias("y")).alias("seq"),
    )


def _lowered() -> Column:
    """_e as the kernels read it."""
    return F.transform("_e", lambda e: F.struct(e["ord"].cast("long").alias("ord"), e["word"].alias("word"), F.lower(e["word"]).alias("low"), e["label"].alias("label")))


def all_pairs(entities: DataFrame) -> DataFrame:
    """Pairs of a sentence's entities, in order of the entities; different words only. They meet in the sentence's row."""
    first = packed(entities).select("id", "sent", "sentence", "_e", F.explode("_e").alias("_1"))
    pairs = first.select("id", "sent", "sentence", "_1", F.explode(F.filter("_e", lambda y: (y["ord"] > F.col("_1.ord")) & (y["word"] != F.col("_1.word")))).alias("_2"))
    return pairs.select(
        "id", "sent", "sentence", F.col("_1.word").alias("entity1"), F.col("_1.label").alias("entity1_label"), F.col("_2.word").alias("entity2"), F.col("_2.label").alias("entity2_label"),
        F.col("_1.ord").alias("ord1"), F.col("_2.ord").alias("ord2"),
    )


def candidates(pairs: DataFrame, licences: DataFrame, without: tuple[str, ...] = ontology.ATTACHMENT_RELATIONS) -> DataFrame:
    """Each pair's licensed relations (both orders of the pair are looked up), less those read off syntax only;
    pairs without any go, and of pairs with the same two words in a sentence the first stays."""
    offered = licences.where(~F.col("relation").isin(*without)) if without else licences
    lists = offered.groupBy("label1", "label2").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "relation"))), lambda x: x["relation"]).alias("relations"))
    swapped = pairs.select(
        "id", "sent", "sentence", F.col("entity2").alias("entity1"), F.col("entity2_label").alias("entity1_label"), F.col("entity1").alias("entity2"), F.col("entity1_label").alias("entity2_label"), "ord1", "ord2", F.lit(1).alias("swapped")
    )
    both = pairs.withColumn("swapped", F.lit(0)).unionByName(swapped)
    named = both.join(F.broadcast(lists), (F.col("entity1_label") == F.col("label1")) & (F.col("entity2_label") == F.col("label2"))).drop("label1", "label2")  # at most one row for each pair of labels
    return unordered_pair_dedup(named, ["id", "sentence"], "entity1", "entity2", ["sent", "ord1", "ord2", "swapped"]).drop("swapped")


def text_candidates(records: DataFrame, licences: DataFrame, without: tuple[str, ...] = ontology.ATTACHMENT_RELATIONS) -> DataFrame:
    """candidates of all pairs of a sentence's entities, in whole texts (record_rows): pairs are looked up and told apart in
    their text's row (scan.pairer), and only those that stay become rows. Texts that share an id become one row first."""
    small_batches(records.sparkSession)
    twice = cut(records.groupBy("id").count().where("count > 1").select("id"))
    parts = [records.withColumn("_n", F.expr("cast(null as array<int>)"))]
    if not twice.isEmpty():
        numbered = F.transform(pieces("_s"), lambda x, k: F.struct(k.alias("n"), x.alias("s")))
        joined = records.join(twice, "id", "left_semi").groupBy("id").agg(F.array_sort(F.flatten(F.collect_list(numbered))).alias("_p"), F.first("_e").alias("_e"))
        parts = [parts[0].join(twice, "id", "left_anti"), joined.select("id", F.transform("_p", lambda p: p["s"]).alias("_s"), "_e", F.transform("_p", lambda p: p["n"]).alias("_n"))]
    offered = licences.where(~F.col("relation").isin(*without)) if without else licences
    lists = offered.groupBy("label1", "label2").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "relation"))), lambda x: x["relation"]).alias("relations"))
    may = [tuple(r) for r in offered.select("label1", "label2").where("label1 is not null and label2 is not null").distinct().collect()]
    found = [df.withColumn("_r", kernel(scan.pairer(may), scan.PAIRED)("_s", _lowered())).select("id", "_e", "_n", F.inline("_r")) for df in parts]
    laid = reduce(DataFrame.unionByName, found).select(
        "id", F.coalesce(F.get("_n", F.col("s")), "s").alias("sent"), "sentence", F.get("_e", F.col("x")).alias("_x"), F.get("_e", F.col("y")).alias("_y"), "swapped"
    )
    named = laid.join(F.broadcast(lists), (F.col("_x.label") == F.col("label1")) & (F.col("_y.label") == F.col("label2")))
    first = lambda k: F.when(F.col("swapped") == k, F.col("_x.ord")).otherwise(F.col("_y.ord"))
    return named.select("id", "sent", "sentence", F.col("_x.word").alias("entity1"), F.col("_x.label").alias("entity1_label"), F.col("_y.word").alias("entity2"), F.col("_y.label").alias("entity2_label"), first(0).alias("ord1"), first(1).alias("ord2"), "relations")


def marked_sentence(sentence: Column, entity1: Column, entity2: Column) -> Column:
    return text.marked(text.marked(sentence, entity1, "[E1] ", " [/E1]"), entity2, "[E2] ", " [/E2]")


def cosine(x: Column, y: Column) -> Column:
    """Cosine similarity of two float arrays of equal length; null if one has no length."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    return F.when(norm > 0, dot(x, y) / norm)


def best_prototype(rows: DataFrame, prototypes: DataFrame, keys: list[str], vector: str = "vector", allowed: str | None = None, threshold: float = ontology.EMBEDDING_THRESHOLD) -> DataFrame:
    """For each row, the prototype (relation, prototype, ord) of largest cosine; of equals the first; floor 0.

    allowed: a column with the relations that may be taken. The prototypes are a fixed argument."""
    # one row of a single array: a row is scored against all prototypes where it stands, without a join of rows
    packed = prototypes.agg(F.array_sort(F.collect_list(F.struct("ord", "relation", "prototype"))).alias("_p"))
    scored = rows.join(F.broadcast(packed)).withColumn(
        "_s", F.transform("_p", lambda p: F.struct(F.when(F.array_contains(allowed, p["relation"]) if allowed else F.lit(True), cosine(F.col(vector), p["prototype"])).alias("score"), (-p["ord"]).alias("o"), p["relation"].alias("relation")))
    )
    best = scored.withColumn("_b", F.array_max(F.filter("_s", lambda s: s["score"] > 0)))
    return best.where(F.col("_b.score") >= threshold).select(*keys, F.col("_b.relation").alias("relation"), F.bround("_b.score", 4).alias("score"))


def reconciled(raw: DataFrame, seq: list[str], priority: tuple[str, ...] = ontology.RELATION_PRIORITY) -> DataFrame:
    """One relation for each record, entity words (in order and case) and relation: of the best method, its first."""
    return priority_dedup(raw, ["id", "entity1", "entity2", "relation"], priority, seq)
