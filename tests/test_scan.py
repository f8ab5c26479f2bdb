"""Whole texts are read by kernels in their row: equal to the plain steps over rows of words and sentences."""

import random

import pytest
from lexigraph.functions import ontology
from lexigraph.operators import mentions, relations, scan

TEXTS = [
    (1, "The mass of the lung. to the LUNG by mass?! of the mass from lung"), (2, ""), (3, None), (4, "..the."), (5, "the"), (6, ". The .\n lung to mass. lung to mass. Lung to mass!"),
    (7, "İn the Kidney of…the État. ΑΣ.Β mass to lung ΑΣ"), (8, "hypertensive1 hypertensive of hypertensive1 lung to hypertensive1"), (9, "mass\tto lungmass to lung. the  of the"), (4, "mass to lung. of the mass by lung"),
]
LEXICON = {"A": ["the", "mass", "of the"], "B": ["lung", "the of the", "hypertensive1"], "C": ["mass", "in"]}
LICENCES = {("A", "B"): ["CAUSES", "TREATS"], ("B", "A"): ["CAUSES"], ("C", "B"): ["TREATS"]}


@pytest.fixture(scope="module")
def frames(spark):
    made = random.Random(5)
    more = [(20 + k, "".join(made.choice([" ", " ", ". ", "\n", "the", "mass", "lung", "Of the", " to ", " by ", "é", "in"]) for _ in range(made.randrange(90)))) for k in range(40)]
    docs = spark.createDataFrame(TEXTS + more, "k long, t string")
    return mentions.text_rows(docs, "k", "t"), mentions.word_rows(docs, "k", "t")


def test_terms_of_whole_texts(spark, frames, monkeypatch):
    rows = lambda df: sorted(map(tuple, df.select("id", "sent", "p", "n", "word", "label", "ord").collect()))
    got = rows(mentions.gram_mentions(frames[0], LEXICON))
    assert len(got) > 200 and got == rows(mentions.gram_mentions(frames[1], LEXICON))
    assert rows(mentions.gram_mentions(frames[0], {"A": ["the ", "é"]})) == rows(mentions.gram_mentions(frames[1], {"A": ["the ", "é"]}))
    assert mentions.gram_mentions(frames[0], {}).count() == mentions.gram_mentions(frames[0], {"A": []}).count() == 0


def _entities(spark, frames):
    return relations.record_entities(mentions.gram_mentions(frames[1], LEXICON).selectExpr("id", "word", "label", "cast(sent * 1000 + p * 10 + ord as long) as seq"))


def test_relations_of_whole_texts(spark, frames):
    entities, licences = _entities(spark, frames), ontology.licences(spark, LICENCES)
    triggers = ontology.triggers(spark, {"CAUSES": [" to "], "TREATS": [" by "]}, {"CAUSES": [" BY "]})
    got = relations.lexical_relations(relations.record_rows(frames[0], entities), triggers, licences)
    want = set()
    held = relations.held_entities(frames[1], entities).collect()
    for r in held:
        low = r.sentence.lower()
        for relation, trigger, direction in (("CAUSES", " to ", "F"), ("TREATS", " by ", "F"), ("CAUSES", " by ", "I")):
            before, found, after = low.partition(trigger)
            for x in r._e:
                for y in r._e:
                    one, two = (before, after) if direction == "F" else (after, before)
                    if found and x.word in one and y.word in two and x.word != y.word and relation in LICENCES.get((x.label, y.label), []):
                        want.add((r.id, r.sent, r.sentence, relation, direction, x.word, x.label, y.word, y.label))
    rows = [(r.id, r.sent, r.sentence, r.relation, "I" if r.trigger == " BY " else "F", r.entity1, r.entity1_label, r.entity2, r.entity2_label) for r in got.collect()]
    assert len(want) > 20 and len(rows) == len(set(rows)) and set(rows) == want
    # sentences travel inside their text, once, and pairs are told apart before they become rows
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Generate ") - entities._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


def test_candidates_of_whole_texts(spark, frames, monkeypatch):
    entities, licences = _entities(spark, frames), ontology.licences(spark, LICENCES)
    rows = lambda df: sorted(map(tuple, df.select("id", "sent", "sentence", "entity1", "entity1_label", "entity2", "entity2_label", "ord1", "ord2", "relations").collect()))
    want = rows(relations.candidates(relations.all_pairs(relations.held_entities(frames[1], entities)), licences))
    got = rows(relations.text_candidates(relations.record_rows(frames[0], entities), licences))
    assert len(got) > 20 and got == want


def test_kernels_in_small_chunks(monkeypatch):
    import pyarrow as pa

    texts = pa.array([t for _, t in TEXTS])
    kernel = scan.finder(["the", "of the", "hypertensive1"])
    want = kernel(texts).to_pylist()
    monkeypatch.setattr(scan, "CHUNK", 8)
    assert kernel(texts).to_pylist() == want and kernel(texts.slice(3, 4)).to_pylist() == want[3:7]
    e = pa.array([[{"ord": k, "word": w, "low": w, "label": b} for k, (w, b) in enumerate((("mass", "A"), ("lung", "B")))]] * len(texts))
    found = scan.relater([("CAUSES", " to ", "F")], [("A", "B", "CAUSES"), ("B", "A", "CAUSES")])
    small = found(texts, e).to_pylist()
    monkeypatch.setattr(scan, "CHUNK", 1 << 20)
    whole = found(texts, e).to_pylist()
    monkeypatch.setattr(scan, "WORDS", 1)
    assert small == whole == found(texts, e).to_pylist() and sum(map(len, whole)) > 5


def test_lower_case_is_spark_s(spark):
    points = [k for k in range(1, 0x1F000) if not 0xD800 <= k < 0xE000]
    rows = spark.createDataFrame([(k, f"a{chr(k)}b") for k in points], "k int, t string").selectExpr("k", "t", "lower(t) as low").collect()
    assert [hex(r.k) for r in rows if scan._lower(r.t, True) != r.low] == []
