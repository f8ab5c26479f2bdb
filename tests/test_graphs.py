import pytest
from pyspark.sql import functions as F

from lexigraph.functions import ontology
from lexigraph.operators import relations
from lexigraph.plans import concept_graph, fact_graph, graph_queries, metrics, pipeline
from lexigraph.schema import MENTIONS, conform
from lexigraph.sources import corpora, sinks

MENTION = "id long, word string, label string, start int, end int, seq long, is_negated boolean, is_uncertain boolean, is_family boolean, is_historical boolean, cui string, canonical_name string"
RELATION = "id long, entity1 string, label1 string, relation string, entity2 string, label2 string, relation_score double, assertion string, seq long, entity1_cui string, entity1_canonical_name string, entity2_cui string, entity2_canonical_name string"


def mentions_of(spark, rows):
    return spark.createDataFrame([(1, w, lab, s, s + len(w), k, *([False] * 4), cui, name) for k, (w, lab, s, cui, name) in enumerate(rows)], MENTION)


def relations_of(spark, rows):
    return spark.createDataFrame([(1, a, la, r, b, lb, score, "affirmed", k, "", "", "", "") for k, (a, la, r, b, lb, score) in enumerate(rows)], RELATION)


def graph(spark, found, rels):
    roles = ontology.roles(spark)
    facts = fact_graph.facts(found, rels, roles)
    return facts, fact_graph.edges(found, rels, facts, roles), fact_graph.role_counts(facts, rels, roles)


def test_concept_graph_merges_by_link(spark):
    rows = [(1, "fever", "SIGN_SYMPTOM", "CAUSES", "pyrexia", "SIGN_SYMPTOM", 0.9, "affirmed", 1, "C1", "Fever", "C1", "Pyrexia"), (2, "b", "X", "R", "a", "Y", 0.4, "affirmed", 2, "", "", "", "")]
    rels = spark.createDataFrame(rows, RELATION)
    nodes = concept_graph.nodes(rels)
    got = [(r.entity_id, r.key, r.name, r.label, r["count"]) for r in nodes.orderBy("entity_id").collect()]
    assert got == [(1, "C1", "Fever", "SignSymptom", 2), (2, "a", "a", "Y", 1), (3, "b", "b", "X", 1)]
    edges = concept_graph.edges(rels, nodes).collect()  # isolated nodes stay, weak edges go
    assert [(r.start_id, r.end_id, r.relation) for r in edges] == [(1, 1, "CAUSES")]


def test_dialects():
    assert concept_graph.DIALECT["confidence"] == "relation_score"


def test_normalised_dialect(spark):
    df = spark.createDataFrame([("a", "L1", "b", "L2")], "entity1 string, label1 string, entity2 string, label2 string")
    row = concept_graph.normalised(df).first()
    assert row.relation_score == 1.0 and row.entity1_cui == ""


def test_attribute_routing(spark):
    found = mentions_of(spark, [("headache", "SIGN_SYMPTOM", 0, "", ""), ("1.8 m/s", "LAB_VALUE", 20, "", ""), ("severe", "SEVERITY", 40, "", ""), ("mild", "SEVERITY", 50, "", "")])
    rels = relations_of(spark, [
        ("headache", "SIGN_SYMPTOM", "HAS_SEVERITY", "severe", "SEVERITY", 1.0), ("headache", "SIGN_SYMPTOM", "HAS_SEVERITY", "mild", "SEVERITY", 1.0),
        ("1.8 m/s", "LAB_VALUE", "QUANTIFIES", "headache", "SIGN_SYMPTOM", 1.0), ("gone", "SEVERITY", "HAS_SEVERITY", "away", "SEVERITY", 1.0),
    ])
    facts, edges, counts = graph(spark, found, rels)
    got = {r.word: r for r in facts.collect()}
    assert got["headache"].severity == "severe" and got["headache"].value == "1.8 m/s" and got["1.8 m/s"].value == ""
    assert {r.type for r in edges.collect()} == {"SUBJECT", "HAS_CODE", "MENTIONS"}
    assert {r.category: r["count"] for r in counts.collect()} == {"attribute_field": 3, "dropped_unresolved": 1}


def test_clinical_routing(spark):
    found = mentions_of(spark, [("diabetes", "DISEASE_DISORDER", 0, "", ""), ("pump", "THERAPEUTIC_PROCEDURE", 20, "", ""), ("level", "AREA", 30, "", ""), ("node", "BIOLOGICAL_STRUCTURE", 40, "", ""), ("54", "AGE", 60, "", "")])
    rels = relations_of(spark, [
        ("diabetes", "DISEASE_DISORDER", "TREATS", "pump", "THERAPEUTIC_PROCEDURE", 0.1), ("level", "AREA", "CONTAINS", "node", "BIOLOGICAL_STRUCTURE", 1.0),
        ("pump", "THERAPEUTIC_PROCEDURE", "GIVEN_FOR", "diabetes", "DISEASE_DISORDER", 1.0), ("diabetes", "DISEASE_DISORDER", "HAS_AGE", "54", "AGE", 1.0), ("x", "SUBJECT", "HAS_FAMILY_HISTORY", "diabetes", "DISEASE_DISORDER", 1.0),
    ])
    facts, edges, counts = graph(spark, found, rels)
    key = {r.word: r.key for r in facts.collect()}
    got = {(r.type, r.start_key, r.end_key, r.relation_score) for r in edges.where("type not in ('SUBJECT', 'HAS_CODE', 'MENTIONS')").collect()}
    assert got == {("TREATS", key["pump"], key["diabetes"], 0.1), ("LOCATED_IN", key["node"], key["level"], 1.0)}
    assert {r.category: r["count"] for r in counts.collect()} == {"clinical": 3, "demographic": 1, "dropped_unresolved": 1}
    assert fact_graph.patients(found).first().age == "54"


def test_family_history(spark):
    found = mentions_of(spark, [("grandmother had cancer", "FAMILY_HISTORY", 0, "", ""), ("lung", "BIOLOGICAL_STRUCTURE", 30, "", "")]).withColumn("is_family", F.lit(True))
    rows = {r.word: r for r in fact_graph.bare_facts(found).collect()}
    assert rows["grandmother had cancer"].relative == "grandmother" and rows["grandmother had cancer"].resource == "FamilyMemberHistory"
    assert rows["lung"].resource == "BodyStructure" and rows["lung"].assertion == "family"


def test_every_code_has_its_concept(spark):
    found = mentions_of(spark, [("a", "SIGN_SYMPTOM", 0, "C1", "A"), ("b", "MEDICATION", 5, "", ""), ("red", "COLOR", 9, "", ""), ("it", "SUBJECT", 12, "", "")])
    facts, edges, _ = graph(spark, found, relations_of(spark, [("a", "SIGN_SYMPTOM", "CAUSES", "b", "MEDICATION", 1.0)]))
    keys = {r.key for r in fact_graph.concepts(found).collect()}
    assert {r.end_key for r in edges.where("type in ('HAS_CODE', 'MENTIONS')").collect()} == keys == {"C1", "b", "red"}
    vertices = sinks.fact_vertices(fact_graph.patients(found), facts, fact_graph.concepts(found))
    assert sinks.fact_links(edges, vertices).count() == edges.count()
    assert sinks.fact_links(edges, vertices.where("label <> 'Concept'")).where("type = 'HAS_CODE'").count() == 0
    props = {r.key: r.properties for r in vertices.collect()}
    assert "cui" not in props["b"] and props["C1"]["cui"] == "C1"


def test_numbers_and_units(spark):
    df = spark.createDataFrame([("70.5 kg", "54 years"), ("heavy", "none")], "weight string, age string")
    got = [tuple(r) for r in sinks.numeric(df).select("weight", "weight_unit", "age").collect()]
    assert got == [(70.5, "kg", 54.0), (None, None, None)]


def test_upsert_is_idempotent(spark):
    new = spark.createDataFrame([("k", "a", 1), ("k", "b", 2), ("m", "c", 1)], "key string, v string, seq int")
    once = sinks.upserted(None, new, ["key"])
    again = sinks.upserted(once, new, ["key"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [("k", "b"), ("m", "c")]


def test_chain_and_site(spark):
    edges = spark.createDataFrame([("LOCATED_IN", "a", "b"), ("LOCATED_IN", "b", "c"), ("LOCATED_IN", "c", "a"), ("X", "a", "d")], "type string, start_key string, end_key string")
    got = {(r.start_key, r.end_key): r.hops for r in graph_queries.chains(edges).collect()}
    assert got[("a", "c")] == 2 and got[("a", "a")] == 3 and ("a", "d") not in got


def test_chains_have_no_longest(spark):
    rows = [("LOCATED_IN", f"k{k}", f"k{k + 1}") for k in range(9)]
    edges = spark.createDataFrame(rows, "type string, start_key string, end_key string")
    got = {(r.start_key, r.end_key): r.hops for r in graph_queries.chains(edges).collect()}
    assert got == {(f"k{a}", f"k{b}"): b - a for a in range(10) for b in range(a + 1, 10)}
    assert max(r.hops for r in graph_queries.chains(edges, longest=2).collect()) == 2


def test_metrics(spark):
    m = spark.createDataFrame([(1, "A", "AGE", "x", 0.5), (1, "a", "AGE", "y", 1.0), (2, "b", "SEX", "x", 0.7)], "id long, word string, label string, method string, score double")
    labels = ontology.labels(spark)
    dist = {r.label: (r["count"], round(r.pct, 3)) for r in metrics.label_distribution(m, labels).collect()}
    assert len(dist) == 41 and dist["AGE"] == (2, 66.667) and dist["COLOR"] == (0, 0.0)
    assert {r.category: r["count"] for r in metrics.mention_overlap(m, "x", "y").collect()} == {"both": 1, "x_only": 1, "y_only": 0}
    assert metrics.label_distribution(m.limit(0), labels).agg(F.sum("pct")).first()[0] == 0.0
    r = metrics.agreement(m.where("method = 'x'"), m.where("method = 'y'"), ["id", "label"]).first()
    assert (r.precision, r.recall, round(r.f1, 4)) == (0.5, 1.0, 0.6667)


def test_blocks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("12\n first line\n\n second\n-  1. SPEC A   CAT B\n13\ntext\n- 2. S   C\n", encoding="utf-8")
    got = [(r.id, r.text, r.specjalizacja, r.kategoria) for r in corpora.read_corpus(spark, str(tmp_path / "a.txt")).orderBy("id").collect()]
    assert got == [(12, "first line second", "SPEC A", "CAT B"), (13, "text", "S", "C")]
    (tmp_path / "b.txt").write_text("12\ntext without end\n", encoding="utf-8")
    with pytest.raises(Exception, match="block without metadata"):
        corpora.read_corpus(spark, str(tmp_path / "b.txt")).collect()
    with pytest.raises(ValueError):
        corpora.read_corpus(spark, "x", "pdf")


def test_phrases_and_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text('filename;id;phrase\nf;1;"two"\nf;2;one\nf;3;"two"\n', encoding="utf-8")
    got = [(r.id, r.text, r.kategoria) for r in corpora.read_corpus(spark, str(tmp_path / "c.csv"), "csv").orderBy("id").collect()]
    assert got == [(1, "two", "Unknown"), (2, "one", "Unknown")]
    df = spark.createDataFrame([(1, 'say "hi", you\nthere', 0.5)], "id long, word string, score double")
    sinks.write_csv(df, str(tmp_path / "out"), MENTIONS)
    back = corpora.read_csv(spark, str(tmp_path / "out"), "id long, word string, score double").collect()
    assert [tuple(r) for r in back] == [(1, 'say "hi", you\nthere', 0.5)]
    assert conform(df, MENTIONS).columns == MENTIONS.fieldNames()
    made = []
    first = sinks.materialised(spark, str(tmp_path / "t"), lambda: made.append(1) or df)
    second = sinks.materialised(spark, str(tmp_path / "t"), lambda: made.append(1) or df)
    assert first.count() == second.count() == 1 and made == [1]
    sinks.snapshot({"m": df}, str(tmp_path / "run"))
    with pytest.raises(Exception):
        sinks.snapshot({"m": df}, str(tmp_path / "run"))
    assert sinks.of_run("/r/", "a/b.csv") == "/r/b.csv" and sinks.of_run(None, "a/b.csv") == "a/b.csv"


def test_full_run(spark):
    docs = spark.createDataFrame([(1, "CT scan showed a red lump; surgery was performed. The patient is 54 years old."), (2, None)], "id long, text_en string")
    for kind in ("concept", "fact"):
        tables = pipeline.full(spark, docs, graph=kind)
        assert tables["mentions"].count() == 5
        assert all(t.columns for t in tables.values())
    with pytest.raises(ValueError):
        pipeline.full(spark, docs, mode="other")


def test_stream(spark, tmp_path):
    from lexigraph.streaming import mentions as stream

    spark.createDataFrame([(1, "red lump"), (2, "none")], "id long, text_en string").write.parquet(str(tmp_path / "in"))
    seen = []
    q = stream.upserting(stream.files(spark, str(tmp_path / "in")), str(tmp_path / "cp"), lambda df, n: seen.extend(r.word for r in df.collect()))
    q.awaitTermination(60)
    assert seen == ["red"]


def test_numbered_over_sampled_ranges(spark):
    df = spark.range(0, 20_000, 1, 16).select(F.md5(F.col("id").cast("string")).alias("key"))
    out = concept_graph.numbered(df, "key", "n")
    got = [(r.n, r.key) for r in out.orderBy("n").collect()]
    assert [n for n, _ in got] == list(range(1, 20_001)) and [k for _, k in got] == sorted(k for _, k in got)
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()  # ranges were dealt once, before


def test_command_line(spark, tmp_path):
    from lexigraph import __main__ as cli

    spark.createDataFrame([(1, "A 54 years old male. Biopsy performed on the patient.")], "id long, text string").write.parquet(str(tmp_path / "docs"))
    cli.main(["graph", str(tmp_path / "docs"), str(tmp_path / "run"), "--graph", "fact"])
    cli.main(["metrics", str(tmp_path / "run"), str(tmp_path / "metrics"), "--csv"])
    assert spark.read.parquet(str(tmp_path / "metrics" / "label_distribution")).count() == 41
    assert (tmp_path / "metrics" / "entity_hubs.csv").exists()
    cli.main(["sentence", "Biopsy of a 54 years old male."])


def test_bundles_hold_all_pairs_in_one_row(spark):
    """Edges between repeated words stay packed until they are laid out, and facts that share a key are settled edge by edge."""
    words = [("mass", "SIGN_SYMPTOM", 10 * k, "", "") for k in range(6)] + [("lung", "BIOLOGICAL_STRUCTURE", 100 + 10 * k, "", "") for k in range(5)]
    rels = relations_of(spark, [("mass", "SIGN_SYMPTOM", "LOCATED_IN", "lung", "BIOLOGICAL_STRUCTURE", 0.7), ("mass", "SIGN_SYMPTOM", "LOCATED_IN", "lung", "BIOLOGICAL_STRUCTURE", 0.9)])
    roles = ontology.roles(spark)
    for more in ([], [("mass", "DISEASE_DISORDER", 0, "", "")]):  # the last: a second fact of the same key
        found = mentions_of(spark, words + more)
        facts = fact_graph.facts(found, rels, roles)
        bundles, singles = fact_graph.edge_parts(found, rels, facts, roles)
        assert bundles.count() == (0 if more else 1)
        edges = fact_graph.edges(found, rels, facts, roles).collect()
        got = [(r.start_key, r.end_key, r.relation_score) for r in edges if r.type == "LOCATED_IN"]
        assert sorted(got) == sorted((f"1:{10 * i}:{10 * i + 4}", f"1:{100 + 10 * j}:{104 + 10 * j}", 0.7) for i in range(6) for j in range(5))
        assert sum(r.type == "SUBJECT" for r in edges) == 11
        assert {(r.hops, r.n) for r in graph_queries.bundled_chains(bundles, singles).collect()} == {(1, 30)}


def test_repeated_entities_meet_in_one_row(spark):
    """A sentence travels once, with its entities packed; before, once for each entity."""
    sents = spark.createDataFrame([(1, 0, "Mass in the LUNG"), (1, 1, "lung only"), (2, 0, "lung mass")], "id long, sent int, sentence string")
    ents = spark.createDataFrame([(1, "mass", "A", 1), (1, "lung", "B", 2), (1, "mass", "C", 3), (2, "lung", "B", 1)], "id long, word string, label string, ord long")
    held = relations.held_entities(sents, ents).collect()
    assert [(r.id, r.sent, sorted((e.ord, e.word, e.label) for e in r._e)) for r in held] == [(1, 0, [(1, "mass", "A"), (2, "lung", "B"), (3, "mass", "C")])]
    pairs = relations.all_pairs(relations.held_entities(sents, ents)).collect()
    assert sorted((r.entity1, r.ord1, r.entity2, r.ord2) for r in pairs) == [("lung", 2, "mass", 3), ("mass", 1, "lung", 2)]


def test_sites_of_bundles_equal_those_of_edges(spark):
    """Rows of edges, repeats included, and facts without a site; shared keys too; pairs of facts are never joined."""
    words = [("mass", "SIGN_SYMPTOM", 10 * k, "", "") for k in range(3)] + [("lung", "BIOLOGICAL_STRUCTURE", 100, "C1", "Lung"), ("lung", "BIOLOGICAL_STRUCTURE", 110, "", ""), ("lung", "BIOLOGICAL_STRUCTURE", 120, "", ""), ("massive", "SIGN_SYMPTOM", 200, "", "")]
    rels = relations_of(spark, [("mass", "SIGN_SYMPTOM", "LOCATED_IN", "lung", "BIOLOGICAL_STRUCTURE", 0.7)])
    roles = ontology.roles(spark)
    for more in ([], [("mass", "DISEASE_DISORDER", 0, "", "")]):
        found = mentions_of(spark, words + more)
        facts, concepts = fact_graph.facts(found, rels, roles), fact_graph.concepts(found)
        edges = fact_graph.edges(found, rels, facts, roles)
        parts = fact_graph.edge_parts(found, rels, facts, roles, graph_queries.SITE_COLUMNS)
        rows = lambda df: sorted((r.fact, r.word, r.site or "") for r in df.collect())
        got = rows(graph_queries.bundled_sites(facts, concepts, *parts, "mass"))
        assert got == rows(graph_queries.with_site(facts, concepts, edges, "mass"))
        assert ("1:200:207", "massive", "") in got and sum(x[2] == "lung" for x in got) >= 6
