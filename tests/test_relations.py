from pyspark.sql import functions as F

from lexigraph.functions import ontology
from lexigraph.operators import assertion, dependency, joint, linking, mentions, models, relations


def entities_of(spark, sentence, pairs, id_=1):
    rows = [(id_, 0, sentence, w, lab, k) for k, (w, lab) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id long, sent int, sentence string, word string, label string, ord long")


def test_lexical_triggers(spark):
    sentence = "Metformin was given; neuropathy due to diabetes"
    ents = entities_of(spark, sentence, [("diabetes", "DISEASE_DISORDER"), ("neuropathy", "DISEASE_DISORDER")])
    got = relations.lexical_relations(ents, ontology.triggers(spark), ontology.licences(spark)).collect()
    assert {(r.entity1, r.relation, r.entity2) for r in got} == {("diabetes", "CAUSES", "neuropathy")}
    allowed = {(a, b, r) for (a, b), rs in ontology.LICENCES.items() for r in rs}
    assert all((r.entity1_label, r.entity2_label, r.relation) in allowed for r in got)


def test_candidates_look_up_both_orders(spark):
    ents = entities_of(spark, "diabetes treated with metformin", [("diabetes", "DISEASE_DISORDER"), ("metformin", "MEDICATION")])
    got = relations.candidates(relations.all_pairs(ents), ontology.licences(spark)).collect()
    assert len(got) == 1 and got[0].relations


def test_best_prototype_ties_and_floor(spark):
    protos = spark.createDataFrame([(0, "A", [1.0, 0.0]), (1, "B", [1.0, 0.0]), (2, "C", [0.0, 1.0])], "ord int, relation string, prototype array<float>")
    rows = spark.createDataFrame([(1, [2.0, 0.0], ["B", "A"]), (2, [-1.0, -1.0], ["A"]), (3, [0.0, 0.0], ["A"]), (4, [1.0, 0.1], ["C"])], "k int, vector array<float>, allowed array<string>")
    got = relations.best_prototype(rows, protos, ["k"], allowed="allowed").collect()
    assert [(r.k, r.relation, r.score) for r in got] == [(1, "A", 1.0)]


def test_assertion_axes(spark):
    docs = spark.createDataFrame(
        [(1, "There is no sign of enlarged lymph nodes; the patient denies fever."), (2, "The patient reports severe chest pain."), (3, "Findings are suggestive of possible pneumonia."), (4, "Mother had breast cancer at age 50."),
         (5, "Past medical history of myocardial infarction."), (6, "No evidence of metastatic disease."), (7, "Lesions were not found."), (8, "denies fever, ECG showed changes")],
        "id long, text_en string",
    )
    words = {1: ["lymph nodes", "fever"], 2: ["chest pain"], 3: ["pneumonia"], 4: ["breast cancer"], 5: ["myocardial infarction"], 6: ["metastatic disease"], 7: ["Lesions"], 8: ["fever", "ECG", "absent"]}
    m = spark.createDataFrame([(i, w) for i, ws in words.items() for w in ws], "id long, word string").withColumns({"start": F.lit(None).cast("int"), "end": F.lit(None).cast("int")})
    out = assertion.asserted(m, docs, mentions.sentences(docs)).withColumn("s", assertion.mention_status())
    got = {(r.id, r.word): r.s for r in out.collect()}
    assert got == {
        (1, "lymph nodes"): "negated", (1, "fever"): "negated", (2, "chest pain"): "affirmed", (3, "pneumonia"): "uncertain", (4, "breast cancer"): "family", (5, "myocardial infarction"): "historical",
        (6, "metastatic disease"): "negated", (7, "Lesions"): "negated", (8, "fever"): "negated", (8, "ECG"): "affirmed", (8, "absent"): "affirmed",
    }


def test_endpoint_flags_and_links(spark):
    m = spark.createDataFrame([(1, "Fever", "S", 1, False, None, False, False, "C1", "Fever"), (1, "fever", "S", 2, True, False, False, False, "C2", "x"), (1, "lung", "B", 3, False, False, True, False, "", "")],
                              "id long, word string, label string, seq long, is_negated boolean, is_uncertain boolean, is_family boolean, is_historical boolean, cui string, canonical_name string")
    rel = spark.createDataFrame([(1, "FEVER", "S", "lung", "B"), (1, "gone", "S", "lung", "B")], "id long, entity1 string, entity1_label string, entity2 string, entity2_label string")
    got = {r.entity1: r for r in linking.endpoint_links(assertion.endpoint_flags(rel, m), m).collect()}
    assert got["FEVER"].assertion == "negated+family" and got["FEVER"].entity1_cui == "C1" and got["FEVER"].entity2_cui == ""
    assert got["gone"].assertion == "family" and got["gone"].entity1_canonical_name == ""


def test_linker_backends(spark):
    import pytest

    m = spark.createDataFrame([(1, "Fever"), (1, "fevers")], "id long, word string")
    aliases = spark.createDataFrame([("fever", "C2", "B", 0.9), ("FEVER", "C1", "A", 0.9), ("low", "C3", "L", 0.2)], "alias string, cui string, canonical_name string, score double")
    assert {r.word: r.cui for r in linking.linked(m, aliases).collect()} == {"Fever": "C1", "fevers": ""}
    assert {r.word: r.cui for r in linking.linked(m, aliases, "fuzzy", 0.5).collect()} == {"Fever": "C1", "fevers": "C1"}
    with pytest.raises(NotImplementedError):
        linking.linked(m, aliases, "medcat")
    with pytest.raises(ValueError):
        linking.linked(m, aliases, "nope")


def parse(spark, words, start=0):
    """words: (text, lemma, dep, head) -> token rows of one sentence, single blanks between."""
    rows, at = [], start
    for i, (t, lemma, dep, head) in enumerate(words):
        rows.append((1, 0, i, t, lemma, "X", dep, head, at, at + len(t)))
        at += len(t) + 1
    return spark.createDataFrame(rows, "id long, sent int, i int, text string, lemma string, pos string, dep string, head int, start int, end int")


def test_coordinated_subjects(spark):
    words = [("Diabetes", "diabetes", "nsubj", 3), ("and", "and", "cc", 0), ("hypertension", "hypertension", "conj", 0), ("cause", "cause", "ROOT", 3), ("neuropathy", "neuropathy", "dobj", 3)]
    tokens = parse(spark, words)
    ents = entities_of(spark, "Diabetes and hypertension cause neuropathy", [("Diabetes", "DISEASE_DISORDER"), ("hypertension", "DISEASE_DISORDER"), ("neuropathy", "DISEASE_DISORDER")])
    got = dependency.verb_relations(tokens, ents, ontology.verbs(spark), ontology.licences(spark)).collect()
    assert {(r.entity1, r.relation, r.entity2) for r in got} == {("Diabetes", "CAUSES", "neuropathy"), ("hypertension", "CAUSES", "neuropathy")}
    pairs = {(r.entity1, r.entity2) for r in dependency.path_pairs(tokens, ents).collect()}
    assert pairs == {("Diabetes", "neuropathy"), ("hypertension", "neuropathy")}
    why = {(r.entity1, r.entity2): r.reason for r in dependency.pair_verdicts(tokens, ents).collect()}
    assert why[("Diabetes", "hypertension")] == "coordinated" and why[("Diabetes", "neuropathy")] is None


def test_interior_entity_and_distance(spark):
    words = [("lesion", "lesion", "ROOT", 0), ("in", "in", "prep", 0), ("lobe", "lobe", "pobj", 1), ("of", "of", "prep", 2), ("thyroid", "thyroid", "pobj", 3)]
    tokens = parse(spark, words)
    ents = entities_of(spark, "lesion in lobe of thyroid", [("lesion", "SIGN_SYMPTOM"), ("lobe", "BIOLOGICAL_STRUCTURE"), ("thyroid", "BIOLOGICAL_STRUCTURE")])
    assert {(r.entity1, r.entity2) for r in dependency.path_pairs(tokens, ents).collect()} == {("lesion", "lobe"), ("lobe", "thyroid")}
    why = {(r.entity1, r.entity2): r.reason for r in dependency.pair_verdicts(tokens, ents).collect()}
    assert why[("lesion", "thyroid")] == "interior entity"


def test_long_chains(spark):
    n = 20
    words = [("w0", "w0", "nsubj", n)] + [(f"w{k}", f"w{k}", "conj", k - 1) for k in range(1, n)] + [("cause", "cause", "ROOT", n), ("pain", "pain", "dobj", n)]
    tokens = parse(spark, words)
    assert {r.lead for r in dependency.conjunct_groups(tokens).where(f"i < {n}").collect()} == {0}
    ents = entities_of(spark, " ".join(w for w, *_ in words), [(f"w{k}", "DISEASE_DISORDER") for k in (0, 18, 19)] + [("pain", "DISEASE_DISORDER")])
    got = dependency.verb_relations(tokens, ents, ontology.verbs(spark), ontology.licences(spark)).collect()
    assert {(r.entity1, r.entity2) for r in got} == {(f"w{k}", "pain") for k in (0, 18, 19)}
    assert {(r.entity1, r.entity2) for r in dependency.path_pairs(tokens, ents).collect()} == {("w0", "pain")}
    preps = parse(spark, [("a", "a", "ROOT", 0)] + [("of", "of", "prep", k) for k in range(12)] + [("x", "x", "pobj", 12), ("y", "y", "conj", 12)])
    assert (14, 0) in {(r.a, r.b) for r in dependency.collapsed_edges(preps).collect()}


def test_attachments(spark):
    words = [("severe", "severe", "amod", 3), ("and", "and", "cc", 0), ("red", "red", "conj", 0), ("lesion", "lesion", "ROOT", 3)]
    ents = entities_of(spark, "severe and red lesion", [("severe", "SEVERITY"), ("red", "COLOR"), ("lesion", "SIGN_SYMPTOM")])
    got = dependency.attachment_relations(parse(spark, words), ents, ontology.licences(spark)).collect()
    assert {(r.entity1, r.relation, r.entity2) for r in got} == {("lesion", "HAS_SEVERITY", "severe"), ("lesion", "HAS_COLOR", "red")}


def test_numbered_answers(spark):
    pairs = relations.candidates(relations.all_pairs(entities_of(spark, "metformin for diabetes and pain", [("metformin", "MEDICATION"), ("diabetes", "DISEASE_DISORDER"), ("pain", "SIGN_SYMPTOM")])), ontology.licences(spark))
    asked = models.relation_prompts(pairs)
    n = pairs.count()
    answer = f"{n}. NO_RELATION | 0.9\n1. treats | 0.87654\n2. CAUSES | x"
    got = models.parsed_relations(asked.withColumn("answer", F.lit(answer))).collect()
    assert [(r.relation, r.score) for r in got] == [("TREATS", 0.8765)]
    by_place = models.parsed_relations(asked.withColumn("answer", F.lit("TREATS | 0.5\nTREATS | 0.05"))).collect()
    assert [(r.relation, r.score) for r in by_place] == [("TREATS", 0.5)]


def test_joint_answers(spark):
    docs = spark.createDataFrame([(1, "Metformin for Diabetes"), (2, "other")], "id long, text_en string")
    answer = """text {"records": [{"id": "1", "entities": [{"text": "metformin", "label": "medication", "confidence": 0.9, "negated": true}, {"text": "Diabetes", "label": "DISEASE_DISORDER", "confidence": "bad"},
        {"text": "x", "label": "WRONG"}], "relations": [{"entity1": "Metformin", "entity2": "diabetes", "relation": "treats", "confidence": 0.8},
        {"entity1": "metformin", "entity2": "diabetes", "relation": "LOCATED_IN", "confidence": 0.8}, {"entity1": "metformin", "entity2": "unseen", "relation": "TREATS", "confidence": 0.8}]}]} end"""
    answers = spark.createDataFrame([(answer,), ("no json",)], "answer string")
    found, rels = joint.extracted(answers, docs, ontology.licences(spark))
    assert [(r.word, r.label, r.score, r.start, r.is_negated) for r in found.orderBy("seq").collect()] == [("metformin", "MEDICATION", 0.9, 0, True), ("Diabetes", "DISEASE_DISORDER", 0.0, 14, False)]
    assert [(r.entity1, r.relation, r.entity2, r.score) for r in rels.collect()] == [("Metformin", "TREATS", "diabetes", 0.8)]
    assert [r.id for r in joint.lost_records(joint.prompts(docs), answers).collect()] == [2]


def test_cues_of_any_length(spark):
    cues = spark.createDataFrame([("a b c d e f", "is_negated", False, 3), ("g", "is_family", True, 2)], "cue string, category string, backward boolean, scope int")
    tokens = spark.createDataFrame([(1, 0, p, t) for p, t in enumerate("x a b c d e f y z g".split())], "id long, sent int, p int, tok string")
    assert sorted((r.category, r.first, r.last) for r in assertion.cue_scopes(tokens, cues, []).collect()) == [("is_family", 7, 8), ("is_negated", 7, 9)]


def test_parser_and_translator_in_the_flow(spark):
    from lexigraph.plans import pipeline

    words = [("Diabetes", "diabetes", "nsubj", 3), ("and", "and", "cc", 0), ("hypertension", "hypertension", "conj", 0), ("cause", "cause", "ROOT", 3), ("neuropathy", "neuropathy", "dobj", 3)]
    docs = spark.createDataFrame([(1, "DIABETES I")], "id long, text string")
    sentence = "Diabetes and hypertension cause neuropathy"
    options = pipeline.Options(parser=lambda sents: parse(spark, words), translator=lambda: lambda texts: [sentence] * len(texts), lexicon={"DISEASE_DISORDER": ["diabetes", "hypertension", "neuropathy"]})
    found = pipeline.full(spark, docs, options)["relations"].where("method = 'spacy_dependency'").collect()
    assert {(r.entity1, r.relation, r.entity2) for r in found} == {("Diabetes", "CAUSES", "neuropathy"), ("hypertension", "CAUSES", "neuropathy")}
    ents = entities_of(spark, sentence, [("Diabetes", "DISEASE_DISORDER"), ("hypertension", "DISEASE_DISORDER"), ("neuropathy", "DISEASE_DISORDER")])
    by_syntax = pipeline.candidate_pairs(parse(spark, words), ents, options).collect()
    assert len(by_syntax) < pipeline.candidate_pairs(None, ents, options).count() == 3
    assert all({r.entity1, r.entity2} != {"Diabetes", "hypertension"} for r in by_syntax)


def test_sentence_with_leading_blanks(spark):
    tokens = parse(spark, [("CT", "ct", "ROOT", 0), ("mass", "mass", "dobj", 0)], start=2)
    ents = entities_of(spark, "  CT mass", [("CT", "DIAGNOSTIC_PROCEDURE"), ("mass", "SIGN_SYMPTOM")])
    assert [(r.entity1, r.entity2) for r in dependency.path_pairs(tokens, ents).collect()] == [("CT", "mass")]


def test_fuzzy_links_equal_brute_force(spark):
    import random

    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abc ") for _ in range(rng.randint(1, 9))).strip() or "a" for _ in range(120)})
    grams = lambda w: {f"  {w.lower()} "[k : k + 3] for k in range(len(w) + 1)}
    m = spark.createDataFrame([(k, w) for k, w in enumerate(names)], "id long, word string")
    aliases = spark.createDataFrame([(w + "a", f"C{k:03d}", w, 1.0) for k, w in enumerate(names)], "alias string, cui string, canonical_name string, score double")
    want = {}
    for w in names:
        scored = [(len(grams(w) & grams(a + "a")) / len(grams(w) | grams(a + "a")), f"C{k:03d}") for k, a in enumerate(names)]
        best = min(((-s, c) for s, c in scored if s >= 0.6), default=(0, ""))
        want[w] = best[1]
    assert {r.word: r.cui for r in linking.linked(m, aliases, "fuzzy", 0.6).collect()} == want


def test_random_parses_equal_brute_force(spark):
    """Kernels over packed sentences against loops: chains, circles, heads outside of the sentence, tokens out of order."""
    import random

    rng = random.Random(7)
    deps = ["nsubj", "prep", "pobj", "amod", "dobj", "conj", "det", "ROOT", "acomp", None]
    tokens, held = [], []
    for sent in range(60):
        words = [rng.choice(["aa", "bb", "cc", "dd", "to"]) for _ in range(rng.randint(1, 9))]
        at = 0
        for i, w in enumerate(words):
            tokens.append((1, sent, i, w, w, "X", rng.choice(deps), rng.choice([max(i - 1, 0), i, rng.randint(0, len(words)) if sent % 3 else max(i - 1, 0)]), at, at + len(w)))
            at += len(w) + 1
        held += [(1, sent, " ".join(words), w, "DISEASE_DISORDER", k) for k, w in enumerate(["aa", "bb", "cc"]) if w in words]
    t = spark.createDataFrame(tokens, "id long, sent int, i int, text string, lemma string, pos string, dep string, head int, start int, end int")
    e = spark.createDataFrame(held, "id long, sent int, sentence string, word string, label string, ord int")
    edges, roots = {(r.sent, r.a, r.b) for r in dependency.collapsed_edges(t).collect()}, {(r.sent, r.i): r.word for r in dependency.entity_roots(t, e).collect()}
    straight = {s for s in range(60) if s % 3 == 0}  # in these no circle of conjuncts, whose lead is nothing certain
    lead = {(r.sent, r.i): r.lead for r in dependency.conjunct_groups(t).collect()}
    want = set()
    for (s, a), x in roots.items():
        for (s2, b), y in roots.items():
            if s == s2 and a < b and x != y and s in straight and lead[s, a] != lead[s, b]:
                near = [m for (q, p, m) in edges if q == s and p == a and (s, m) not in roots and (s, m, b) in edges]
                if (s, a, b) in edges or near:
                    want.add((s, x, y, a, b, 1 if (s, a, b) in edges else 2))
    got = {(r.sent, r.entity1, r.entity2, r.ord1, r.ord2, r.length) for r in dependency.path_pairs(t, e).collect()}
    assert {g for g in got if g[0] in straight} == want and want


def test_long_sentence_is_one_row(spark):
    """Coordinations of thousands of words: pairs of tokens are never laid out."""
    n = 4000
    words = [("w0", "w0", "amod", n)] + [(f"w{k}", f"w{k}", "conj", k - 1) for k in range(1, n)] + [("pain", "pain", "ROOT", n)]
    ents = entities_of(spark, " ".join(w for w, *_ in words), [("w3999", "SEVERITY"), ("pain", "SIGN_SYMPTOM")])
    rows = dependency.attachment_relations(parse(spark, words), ents, ontology.licences(spark))
    assert {(r.entity1, r.relation, r.entity2) for r in rows.collect()} == {("pain", "HAS_SEVERITY", "w3999")}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 3  # tokens with entities, and the licences


def test_ends_are_looked_up_in_one_join(spark):
    """linking.annotated equals the flags and the links looked up end by end, and joins by record only."""
    found = spark.createDataFrame(
        [(1, "Pain", "SIGN_SYMPTOM", 5, True, False, False, None, "C1", "ache"), (1, "pain", "SIGN_SYMPTOM", 2, False, True, False, False, "C2", "pain"), (1, "lobe", "ORGAN", 1, False, False, True, False, None, None), (2, "pain", "X", 1, True, True, True, True, "C3", "x")],
        "id long, word string, label string, seq long, is_negated boolean, is_uncertain boolean, is_family boolean, is_historical boolean, cui string, canonical_name string",
    )
    rels = spark.createDataFrame([(1, "PAIN", "SIGN_SYMPTOM", "lobe", "ORGAN"), (1, "lobe", "SIGN_SYMPTOM", "pain", None), (3, "pain", "X", "pain", "X"), (2, "pain", "X", "lobe", "ORGAN")], "id long, entity1 string, entity1_label string, entity2 string, entity2_label string")
    got = linking.annotated(rels, found)
    want = linking.endpoint_links(assertion.endpoint_flags(rels, found), found)
    rows = lambda df: sorted(tuple(map(str, r)) for r in df.select(*sorted(want.columns)).collect())
    assert rows(got) == rows(want) and sorted(got.columns) == sorted(want.columns)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
