from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexigraph.functions import ontology
from lexigraph.operators import dedup, mentions, models


def test_gazetteer(spark):
    df = spark.createDataFrame([(1, "Patient, 5 years old: X-ray and CT  scan; 70.5 kg, 3 cm, 12 cm"), (2, "   "), (3, None), (4, "6 months")], "id long, text_en string")
    rows = mentions.gazetteer(df).orderBy("id", "seq").collect()
    assert [(r.id, r.word, r.label, r.start) for r in rows] == [
        (1, "Patient", "SUBJECT", 0), (1, "X-ray", "DIAGNOSTIC_PROCEDURE", 22), (1, "CT  scan", "DIAGNOSTIC_PROCEDURE", 32), (1, "5 years", "AGE", 9), (1, "5 years", "DURATION", 9),
        (1, "70.5 kg", "WEIGHT", 42), (1, "12 cm", "HEIGHT", 57), (4, "6 months", "DURATION", 0),
    ]
    kept = mentions.reconciled(mentions.united([mentions.gazetteer(df)])).where("word = '5 years'").collect()
    assert [r.label for r in kept] == ["AGE"]


def test_overlapping_phrases_all_match(spark):
    df = spark.createDataFrame([(1, "blood test")], "id long, text_en string")
    got = mentions.lexicon_mentions(df, {"A": ["blood", "blood test"], "B": ["test"]}).orderBy("start", "end").collect()
    assert [(r.word, r.label) for r in got] == [("blood", "A"), ("blood test", "A"), ("test", "B")]


def test_priority_and_threshold(spark):
    rows = [(1, "chest pain", "A", 0.9, "neural", 0, 10, 0), (1, "Chest Pain", "B", 1.0, "gazetteer", 0, 10, 1), (1, "pain", "A", 0.3, "neural", 6, 10, 2), (1, "x", "A", 0.9, "other", None, None, 3)]
    df = spark.createDataFrame(rows, "id long, word string, label string, score double, method string, start int, end int, seq long")
    got = sorted((r.word, r.method) for r in mentions.reconciled(df).collect())
    assert got == [("Chest Pain", "gazetteer"), ("x", "other")]


def greedy(spans):
    kept = []
    for rank, start, end, seq in sorted(spans, key=lambda s: (s[0], s[1] - s[2], s[3])):
        if not any(a < end and start < b for _, a, b, _ in kept):
            kept.append((rank, start, end, seq))
    return sorted(k[3] for k in kept)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 20), st.integers(1, 6)), min_size=1, max_size=25))
def test_overlap_resolution_is_greedy(spark, spans):
    rows = [(1, r, s, s + n, k) for k, (r, s, n) in enumerate(spans)]
    df = spark.createDataFrame(rows, "id long, rank int, start int, end int, seq long").repartition(3)
    got = sorted(r.seq for r in dedup.resolve_overlaps(df, F.col("rank"), ["seq"]).collect())
    assert got == greedy([(r, s, e, k) for _, r, s, e, k in rows])


def test_first_per_key_does_not_depend_on_partitions(spark):
    rows = [(k % 5, k) for k in range(100)]
    df = spark.createDataFrame(rows, "a long, b long")
    want = {(k, k) for k in range(5)}
    for n in (1, 7):
        assert {(r.a, r.b) for r in dedup.first_per_key(df.repartition(n), ["a"], ["b"]).collect()} == want


def test_empty_table(spark):
    assert mentions.empty(spark).count() == 0
    empty = spark.createDataFrame([], "id long, text_en string")
    assert mentions.reconciled(mentions.united([mentions.gazetteer(empty)])).count() == 0


def build_classifier():
    return lambda texts: [[("mass", "sign_symptom", 0.87654, 0, 4)] if "mass" in t else [] for t in texts]


def build_failing():
    def call(prompt):
        raise RuntimeError("no")

    return call


def test_scorers(spark):
    docs = spark.createDataFrame([(1, "mass here"), (2, None), (3, "none")], "id long, text_en string")
    got = models.classified(docs, build_classifier).collect()
    assert [(r.id, r.word, r.label, r.score) for r in got] == [(1, "mass", "SIGN_SYMPTOM", 0.8765)]
    asked = models.mention_prompts(docs)
    assert asked.where("prompt like '%mass here%'").count() == 1
    none = models.generated(asked, None).collect()
    assert all(r.answer == "" and r.status == "unavailable" for r in none)
    failed = models.generated(asked, build_failing, wait=0.0)
    counts = models.call_counts(failed).first()
    assert counts.failed == counts.calls == asked.count() and counts.retries == ontology.RETRIES * counts.calls
    upper = models.mapped_text(docs, lambda: lambda texts: [t.upper() for t in texts], "text_en", "up")
    assert {r.id: r.up for r in upper.collect()} == {1: "MASS HERE", 2: "", 3: "NONE"}


def test_answer_lines(spark):
    docs = spark.createDataFrame([(1, "A red Mass")], "id long, text_en string")
    answer = '1 || "mass" || sign_symptom || 0.91236\n1 || gone || COLOR || bad\n2 || x || COLOR || 1\n1 || y || NOPE || 1\nshort || line'
    df = spark.createDataFrame([(answer,)], "answer string")
    got = [(r.word, r.label, r.score, r.start, r.end) for r in models.parsed_mentions(df, docs).orderBy("seq").collect()]
    assert got == [("mass", "SIGN_SYMPTOM", 0.9124, 6, 10), ("gone", "COLOR", 0.0, None, None)]


def test_large_lexicon_keeps_order(spark):
    terms = [f"t{k}" for k in range(2_000)] + ["b a", "b"]
    df = spark.createDataFrame([(1, "b a t1999 t0 5 years")], "id long, text_en string")
    rows = mentions.gazetteer(df, {"X": terms}).orderBy("seq").collect()
    assert [(r.word, r.label) for r in rows] == [("b a", "X"), ("b", "X"), ("t1999", "X"), ("t0", "X"), ("5 years", "AGE"), ("5 years", "DURATION")]


def test_longest_spans(spark):
    df = spark.createDataFrame([(1, 0, 2, 0), (1, 1, 4, 1), (1, 3, 6, 2), (1, 7, 8, 3), (1, 7, 8, 4)], "id long, start int, end int, seq long")
    assert sorted(r.seq for r in dedup.longest_spans(df, ["seq"]).collect()) == [1, 3]


def test_runs_meet_the_lexicon_in_their_row(spark):
    rows = mentions.word_rows(spark.createDataFrame([(1, "of the in. the of the")], "k long, t string"), "k", "t")
    got = sorted((r.sent, r.p, r.n, r.word) for r in mentions.gram_mentions(rows, {"A": ["the", "of the"], "B": ["the of the"]}).collect())
    assert got == [(0, 0, 2, "of the"), (0, 1, 1, "the"), (1, 1, 1, "the"), (1, 1, 3, "the of the"), (1, 2, 2, "of the"), (1, 3, 1, "the")]
    assert mentions.gram_mentions(rows, {}).count() == 0
