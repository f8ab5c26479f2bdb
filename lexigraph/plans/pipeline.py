"""The flows from documents to graphs, modular and joint."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ontology
from ..operators import assertion, dependency, joint, linking, mentions, models, relations
from ..runtime import cut
from . import concept_graph, fact_graph


@dataclass
class Options:
    """What a run uses: scorers are optional; without one its method finds nothing."""

    gazetteer: bool = True
    classifier: models.BuildClassifier | None = None
    generator: models.BuildGenerator | None = None
    lexical: bool = True
    embedder: object | None = None
    #: Sentences (id, sent, sent_start, sentence) to tokens, as operators/dependency.py describes them.
    parser: Callable[[DataFrame], DataFrame] | None = None
    #: Candidate pairs of a sentence: `syntax` (needs the parser; without one it falls back) or `all`.
    pairing: str = "syntax"
    translator: Callable[[], Callable[[list[str]], list[str]]] | None = None
    aliases: DataFrame | None = None
    linker: str = "alias"
    cues: DataFrame | None = None
    lexicon: dict[str, list[str]] = field(default_factory=lambda: ontology.LEXICONS)
    patterns: dict[str, str] = field(default_factory=lambda: ontology.PATTERNS)
    licences: dict[tuple[str, str], list[str]] = field(default_factory=lambda: ontology.LICENCES)
    generated_assertions: bool = True


def _enriched(found: DataFrame, docs: DataFrame, sents: DataFrame, options: Options, with_assertion: bool = True) -> DataFrame:
    out = assertion.asserted(found, docs, sents, options.cues) if with_assertion else found
    if options.aliases is not None:
        return linking.linked(out, options.aliases, options.linker)
    return out.withColumns({"cui": F.lit(""), "canonical_name": F.lit(""), "umls_score": F.lit(None).cast("double")})


def translated(docs: DataFrame, options: Options, source: str = "text") -> DataFrame:
    """docs with text_en: the translator's text for `source`; blank gives ''. docs that have text_en stay as they are."""
    if "text_en" in docs.columns or options.translator is None:
        return docs
    return cut(models.mapped_text(docs, options.translator, source, "text_en"))  # the model is asked once


def extract_mentions(docs: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """(reconciled and enriched, raw) mentions."""
    found = []
    if options.classifier is not None:
        found.append(models.classified(docs, options.classifier))
    if options.gazetteer:
        found.append(mentions.gazetteer(docs, options.lexicon, options.patterns))
    if options.generator is not None:
        answers = models.generated(models.mention_prompts(docs), options.generator)
        found.append(models.parsed_mentions(answers, docs))
    raw = mentions.united(found)
    raw = raw if raw is not None else mentions.empty(docs.sparkSession)
    return _enriched(mentions.reconciled(raw), docs, mentions.sentences(docs), options), raw


def candidate_pairs(tokens: DataFrame | None, ents: DataFrame, options: Options) -> DataFrame:
    """Pairs of a sentence's entities by syntax, or all of them."""
    if options.pairing not in ("syntax", "all"):
        raise ValueError(f"unknown pairing {options.pairing!r}")
    if tokens is None or options.pairing == "all":
        return relations.all_pairs(ents)
    return dependency.path_pairs(tokens, ents).drop("length")


def extract_relations(found: DataFrame, docs: DataFrame, options: Options, prototypes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(reconciled, raw) relations, both with assertions and links."""
    spark = docs.sparkSession
    licences = ontology.licences(spark, options.licences)
    sents = mentions.sentences(docs)
    ents = relations.sentence_entities(sents, relations.record_entities(found))
    tokens = None
    if options.parser is not None:  # many joins read them
        tokens, ents = cut(options.parser(sents)), cut(ents)
    columns = ["id", "entity1", "entity1_label", "relation", "entity2", "entity2_label", "score", "sentence", "method", "seq"]
    seq = F.to_json("seq").alias("seq")
    parts = []
    if options.lexical:
        parts.append(relations.lexical_relations(ents, ontology.triggers(spark), licences).select(*columns[:-1], seq))
    if tokens is not None:
        rules = dependency.rule_relations(tokens, ents, ontology.verbs(spark), licences)
        order = F.to_json(F.struct("sent", "trigger", "entity1", "entity1_label", "entity2", "entity2_label")).alias("seq")
        parts.append(rules.select(*columns[:-1], order))
    if options.embedder is not None or options.generator is not None:
        pairs = relations.candidates(candidate_pairs(tokens, ents, options), licences)
        if options.embedder is not None and prototypes is not None:
            vectors = models.embedded(pairs.withColumn("_m", relations.marked_sentence(F.col("sentence"), F.col("entity1"), F.col("entity2"))), options.embedder, "_m")
            keys = ["id", "entity1", "entity1_label", "entity2", "entity2_label", "sentence", "ord1", "ord2"]
            best = relations.best_prototype(vectors, prototypes, keys, allowed="relations")
            parts.append(best.withColumns({"method": F.lit(relations.EMBEDDING), "seq": F.to_json(F.struct("ord1", "ord2"))}).select(*columns))
        if options.generator is not None:
            asked = models.generated(models.relation_prompts(pairs), options.generator)
            parts.append(models.parsed_relations(asked).select(*columns[:-1], seq))
    raw = None
    for p in parts:
        raw = p if raw is None else raw.unionByName(p)
    if raw is None:
        raw = spark.createDataFrame([], "id long, entity1 string, entity1_label string, relation string, entity2 string, entity2_label string, score double, sentence string, method string, seq string")
    return linking.annotated(relations.reconciled(raw, ["seq"]), found), linking.annotated(raw, found)


def extract_jointly(docs: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """(mentions, relations) of the joint extractor; flags come from the answers, or from cues."""
    asked = joint.prompts(docs, with_assertions=options.generated_assertions)
    answers = models.generated(asked, options.generator)
    found, rels = joint.extracted(answers, docs, ontology.licences(docs.sparkSession, options.licences), options.generated_assertions)
    found = _enriched(found, docs, mentions.sentences(docs), options, not options.generated_assertions)
    return found, linking.endpoint_links(assertion.endpoint_flags(rels, found), found)


def concept_tables(rels: DataFrame) -> dict[str, DataFrame]:
    rows = concept_graph.normalised(rels)
    nodes = concept_graph.nodes(rows)
    return {"nodes": nodes, "edges": concept_graph.edges(rows, nodes)}


def fact_tables(found: DataFrame, rels: DataFrame) -> dict[str, DataFrame]:
    roles = ontology.roles(found.sparkSession)
    rows = concept_graph.normalised(rels)
    facts = fact_graph.facts(found, rows, roles)
    return {"patients": fact_graph.patients(found), "facts": facts, "concepts": fact_graph.concepts(found), "edges": fact_graph.edges(found, rows, facts, roles)}


GRAPHS = {"concept": lambda found, rels: concept_tables(rels), "fact": fact_tables}


def full(spark: SparkSession, docs: DataFrame, options: Options | None = None, mode: str = "modular", graph: str = "concept") -> dict[str, DataFrame]:
    """All tables of a run: mentions, relations and the graph's. mode: modular or joint."""
    options = options or Options()
    docs = translated(docs, options)
    if mode == "joint":
        found, rels = extract_jointly(docs, options)
        out = {"mentions": found, "raw_mentions": found, "relations": rels, "raw_relations": rels}
    elif mode == "modular":
        found, raw = extract_mentions(docs, options)
        found = cut(found)  # relations and graphs read the mentions again and again
        rels, raw_rels = extract_relations(found, docs, options)
        rels = cut(rels)
        out = {"mentions": found, "raw_mentions": raw, "relations": rels, "raw_relations": raw_rels}
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return out | GRAPHS[graph](found, rels)
