"""Relations from a dependency parse. A sentence's tokens and entities are packed into one row, and what the rules and
paths ask of the parse is worked out there (parse.py, in Arrow batches): tokens are never joined with each other.

tokens: id, sent, i (place in the sentence), text, lemma, pos, dep, head (place), start, end. The parser is a
plug-in; any source of such rows will do. A root's head is itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ontology
from ..runtime import cut
from ..runtime import kernel as _kernel
from . import parse
from .dedup import first_per_key
from .relations import packed

KEY = ["id", "sent"]
METHOD = "spacy_dependency"
SKIPPED, CHUNK_DEPS = parse.SKIPPED, parse.CHUNK_DEPS


def _chained(start: DataFrame, step: DataFrame) -> DataFrame:
    """start (KEY, i, to) with `to` moved along step (KEY, to, next) as often as it goes: the steps are doubled until
    none moves. No chain has more steps than its sentence, so a circle ends too."""
    step = cut(step)
    most = step.groupBy(*KEY).count().agg(F.max("count")).first()[0] or 1
    for _ in range((most - 1).bit_length()):
        further = step.select(*KEY, F.col("to").alias("next"), F.col("next").alias("_further"))
        if step.join(further, [*KEY, "next"]).isEmpty():
            break
        step = cut(step.join(further, [*KEY, "next"], "left").select(*KEY, "to", F.coalesce("_further", "next").alias("next")))
    return start.join(step, [*KEY, "to"], "left").select(*KEY, "i", F.coalesce("next", "to").alias("to"))


def conjunct_groups(tokens: DataFrame) -> DataFrame:
    """KEY, i, lead: the first token of each token's coordination (itself, if it has none)."""
    conj = tokens.where("dep = 'conj'").select(*KEY, F.col("i").alias("to"), F.col("head").alias("next"))
    return _chained(tokens.select(*KEY, "i", F.col("i").alias("to")), conj).withColumnRenamed("to", "lead")


def packed_parse(tokens: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """A row for each sentence that has entities: id, sent, sentence, _e (by ord) and _t (its tokens, by place). Rows that
    are packed already, with _e and _t, stay as they are: then nothing is exchanged."""
    if entities is None:
        return tokens.withColumn("_e", F.array_sort("_e"))
    own = tokens.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("i", "text", "lemma", "dep", "head", "start", "end"))).alias("_t"))
    return packed(entities).withColumn("_e", F.array_sort("_e")).join(own, KEY)


def _named(dep: Column) -> Column:
    """A dependency's place in parse.DEPS, 0 for other ones, -1 if it is null."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, parse.DEPS)), dep), F.lit(-1)).cast("int")


def _related(rows: DataFrame, verbs: list[tuple[str, str]], licences: DataFrame, attached: bool) -> DataFrame:
    """What the rules find in each sentence's row, by the relations that the pair of labels may have: for verbs the verb's,
    for attachments any of ATTACHMENT_RELATIONS."""
    lemmas = sorted({v for v, _ in verbs})
    of = lambda c, t: F.struct(t["i"].cast("long").alias("i"), F.coalesce(t["head"], t["i"]).cast("long").alias("head"), _named(t["dep"]).alias("dep"), c.alias("verb"), F.lower(t["text"]).alias("low"), F.when(c > 0, t["text"]).alias("text"))
    found_verb = lambda t: F.coalesce(F.array_position(F.array(*map(F.lit, lemmas)), F.lower(t["lemma"])), F.lit(0)).cast("int") if lemmas else F.lit(0)
    laid = rows.select(*KEY, "sentence", "_e", _kernel(parse.related_of if attached else parse.verb_related_of, parse.RELATED)(F.transform("_t", lambda t: of(found_verb(t), t)), F.transform("_e", lambda e: F.lower(e["word"]))).alias("_r"))
    hit = laid.select(*KEY, "sentence", "_e", F.inline("_r")).select(*KEY, "sentence", "trigger", "verb", F.get("_e", F.col("x")).alias("_1"), F.get("_e", F.col("y")).alias("_2")).where("_1.word <> _2.word")
    may = licences.select("label1", "label2", "relation").distinct()
    named = licences.sparkSession.createDataFrame([(lemmas.index(v) + 1, r) for v, r in verbs] + [(0, r) for r in ontology.ATTACHMENT_RELATIONS if attached], "verb int, relation string")
    offers = may.join(F.broadcast(named), "relation").select(F.col("label1").alias("entity1_label"), F.col("label2").alias("entity2_label"), "verb", "relation")  # fixed arguments
    return hit.withColumns({"entity1_label": F.col("_1.label"), "entity2_label": F.col("_2.label")}).join(F.broadcast(offers), ["entity1_label", "entity2_label", "verb"]).select(
        "id", "sent", F.col("_1.word").alias("entity1"), "entity1_label", "relation", F.col("_2.word").alias("entity2"), "entity2_label", F.lit(1.0).alias("score"), "sentence", F.lit(METHOD).alias("method"), "trigger",
    )


def _listed(verbs: DataFrame) -> list[tuple[str, str]]:
    """The verb table: a small fixed argument."""
    return [(r["lemma"], r["relation"]) for r in verbs.select("lemma", "relation").collect()]


def verb_relations(tokens: DataFrame, entities: DataFrame | None, verbs: DataFrame, licences: DataFrame) -> DataFrame:
    """Subjects and objects of a verb whose lemma names a relation; direct children and what is coordinated with them."""
    return _related(packed_parse(tokens, entities), _listed(verbs), licences, False)


def attachment_relations(tokens: DataFrame, entities: DataFrame | None, licences: DataFrame) -> DataFrame:
    """Modifiers with their nouns, and predicates with their verb's subjects; in whichever order is licensed."""
    return _related(packed_parse(tokens, entities), [], licences, True)


def rule_relations(tokens: DataFrame, entities: DataFrame | None, verbs: DataFrame, licences: DataFrame) -> DataFrame:
    """verb_relations and attachment_relations in one pass over the parse."""
    return _related(packed_parse(tokens, entities), _listed(verbs), licences, True)


def collapsed_edges(tokens: DataFrame) -> DataFrame:
    """KEY, a, b in both directions: the parse without function words; a preposition is passed over to its
    object, and a conjunct hangs where its coordination hangs, past prepositions."""
    t = tokens.select(*KEY, "i", "dep", "head")
    head = t.select(*KEY, F.col("i").alias("head"), F.col("dep").alias("hdep"), F.col("head").alias("hhead"))
    plain = t.where(~F.col("dep").isin(*SKIPPED, "prep", "conj")).select(*KEY, F.col("i").alias("a"), F.col("head").alias("b"))
    over = t.where("dep = 'pobj'").join(head, [*KEY, "head"]).where("hdep = 'prep'").select(*KEY, F.col("hhead").alias("a"), F.col("i").alias("b"))
    up = t.where("dep = 'prep'").select(*KEY, F.col("i").alias("to"), F.col("head").alias("next"))
    conj = _chained(t.where("dep = 'conj'").join(head, [*KEY, "head"]).select(*KEY, "i", F.col("hhead").alias("to")), up).select(*KEY, F.col("i").alias("a"), F.col("to").alias("b"))
    one_way = plain.unionByName(over).unionByName(conj).where("a <> b")
    return one_way.unionByName(one_way.select(*KEY, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def entity_roots(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """KEY, i, word, label, ord: the head token of each entity's first occurrence; one entity for a token, the first by ord."""
    base = tokens.groupBy(*KEY).agg(F.min("start").alias("_base"))
    # the first token begins where the sentence's leading blanks end
    at = F.call_function("locate", F.lower("word"), F.lower(F.regexp_replace("sentence", r"(?U)^\s+", ""))) - 1
    spans = entities.join(base, KEY).withColumn("_s", F.col("_base") + at).withColumn("_e", F.col("_base") + at + F.length("word")).where(at >= 0)
    inside = spans.join(tokens.select(*KEY, "i", "head", "start", "end"), KEY).where("start < _e and _s < end")
    span = Window.partitionBy(*KEY, "word", "label")
    # the span's head: a token whose own head lies outside the span, or the root
    bounds = inside.withColumn("_lo", F.min("i").over(span)).withColumn("_hi", F.max("i").over(span))
    tops = first_per_key(bounds.where("head < _lo or head > _hi or head = i"), [*KEY, "word", "label"], ["i"])
    return first_per_key(tops, [*KEY, "i"], ["ord"]).select(*KEY, "i", "word", "label", "ord", "sentence")


def path_pairs(tokens: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Pairs of entities at most two edges apart in the collapsed parse, with no entity between them, not
    coordinated with each other, of different words; in order of the tokens. A path of at most two edges is an
    edge or two edges that meet: each sentence's are found in its row."""
    rows = packed_parse(tokens, entities)
    # the first token begins where the sentence's leading blanks end
    low = F.lower(F.regexp_replace("sentence", r"(?U)^\s+", ""))
    spans = F.transform(F.array(low), lambda s: F.struct(F.transform("_e", lambda e: F.struct((F.call_function("locate", F.lower(e["word"]), s) - 1).alias("at"), F.length(e["word"]).alias("n"))).alias("_s")))
    numbers = F.transform("_t", lambda t: F.struct(t["i"].cast("long").alias("i"), F.coalesce(t["head"], t["i"]).cast("long").alias("head"), _named(t["dep"]).alias("dep"), t["start"].cast("long").alias("start"), t["end"].cast("long").alias("end")))
    # inline: the sentence is made lower-case once for all of its entities
    laid = rows.select(*KEY, "sentence", "_e", "_t", F.inline(spans)).select(*KEY, "sentence", "_e", _kernel(parse.paths_of, parse.PATHS)(numbers, "_s").alias("_p"))
    hit = laid.select(*KEY, "sentence", "_e", F.inline("_p")).select(*KEY, "sentence", F.get("_e", F.col("x")).alias("_1"), F.get("_e", F.col("y")).alias("_2"), "a", "b", "length").where("_1.word <> _2.word")
    return hit.select("id", "sent", "sentence", F.col("_1.word").alias("entity1"), F.col("_1.label").alias("entity1_label"), F.col("_2.word").alias("entity2"), F.col("_2.label").alias("entity2_label"), F.col("a").cast("int").alias("ord1"), F.col("b").cast("int").alias("ord2"), "length")


def pair_verdicts(tokens: DataFrame, entities: DataFrame) -> DataFrame:
    """Every pair of entity roots with accepted, and the reason if it is not: coordinated, same word, interior
    entity, or too far (which includes disconnected)."""
    roots, lead, edges = entity_roots(tokens, entities), conjunct_groups(tokens), collapsed_edges(tokens)
    end = lambda k, i: roots.select(*KEY, F.col("i").alias(i), F.col("word").alias(f"entity{k}"), F.col("label").alias(f"entity{k}_label"))
    pairs = end(1, "a").join(end(2, "b"), KEY).where("a < b")
    leads = lambda i, name: lead.select(*KEY, F.col("i").alias(i), F.col("lead").alias(name))
    good = path_pairs(tokens, entities).select(*KEY, F.col("ord1").alias("a"), F.col("ord2").alias("b"), F.lit(True).alias("_ok"))
    two = edges.join(edges.select(*KEY, F.col("a").alias("b"), F.col("b").alias("c")), [*KEY, "b"]).select(*KEY, "a", F.col("c").alias("b"), F.lit(True).alias("_near")).distinct()
    out = pairs.join(leads("a", "la"), [*KEY, "a"]).join(leads("b", "lb"), [*KEY, "b"]).join(good, [*KEY, "a", "b"], "left").join(two, [*KEY, "a", "b"], "left")
    reason = F.when(F.col("_ok"), None).when(F.col("la") == F.col("lb"), "coordinated").when(F.col("entity1") == F.col("entity2"), "same word").when(F.col("_near"), "interior entity").otherwise("too far")
    return out.select(*KEY, "entity1", "entity2", F.coalesce("_ok", F.lit(False)).alias("accepted"), reason.alias("reason"))
