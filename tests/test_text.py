import re

from pyspark.sql import functions as F

from lexigraph.functions import ontology, text
from lexigraph.operators import mentions


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_find_all_equals_finditer(spark):
    bodies = ["Zażółć 5 years, 70.5 kg and 12 cm; 6 MONTHS old", "", "no numbers", "1 kg 2 kg\n3kg", "é 10 ml"]
    for label, pattern in ontology.PATTERNS.items():
        for body in bodies:
            got = [(r["word"], r["start"], r["end"]) for r in one(spark, text.find_all(F.col("b"), pattern), b=body, k=1)]
            assert got == [(m[0], m.start(), m.end()) for m in re.finditer(pattern, body, re.I)], (label, body)


def test_scalar_functions(spark):
    assert one(spark, text.clean_text(F.lit('  " quoted text " '))) == "quoted text"
    assert one(spark, text.clean_text(F.lit(" 'x' "))) == "x"
    assert one(spark, text.clean_text(F.lit("'"))) == "'"
    assert one(spark, text.marked(F.lit("The Lung and lung"), F.lit("lung"), "[E1] ", " [/E1]")) == "The [E1] lung [/E1] and lung"
    assert one(spark, text.first_start(F.lit("abc"), F.lit("z"))) is None
    assert one(spark, text.identifier(F.lit("__a-b c_"), "D")) == "a_b_c"
    assert one(spark, text.identifier(F.lit("--"), "D")) == "D"
    for body, number, unit in (("70.5 kg", 70.5, "kg"), ("54-year-old", 54.0, "year-old"), ("120 mg/dl", 120.0, "mg/dl"), ("none", None, None), ("7", 7.0, None)):
        assert one(spark, text.leading_number(F.lit(body))) == number
        assert one(spark, text.unit_after_number(F.lit(body))) == unit
    assert one(spark, text.usable(F.lit(" NaN "))) is None
    flags = [(F.lit(True), "negated"), (F.lit(None).cast("boolean"), "uncertain"), (F.lit(True), "family")]
    assert one(spark, text.statuses(flags)) == "negated+family"
    assert one(spark, text.statuses([(F.lit(False), "negated")])) == "affirmed"


def test_ontology_counts():
    assert (len(ontology.ENTITY_LABELS), len(ontology.RELATION_LABELS)) == (41, 43)
    assert sum(map(len, ontology.LEXICONS.values())) == 78
    assert sum(map(len, ontology.FORWARD.values())) == 197 and sum(map(len, ontology.INVERTED.values())) == 82
    assert (len(ontology.LICENCES), sum(map(len, ontology.LICENCES.values()))) == (112, 142)
    assert (len(ontology.VERBS), len(ontology.PROTOTYPES), len(ontology.ROLES)) == (62, 43, 42)
    known = set(ontology.RELATION_LABELS)
    assert all(r in known for rs in ontology.LICENCES.values() for r in rs)


def test_sentences(spark):
    df = spark.createDataFrame([(1, "One here. Two there! three\nFour"), (2, None), (3, "")], "id long, text_en string")
    got = [(r.id, r.sent, r.sent_start, r.sentence) for r in mentions.sentences(df).orderBy("id", "sent").collect()]
    assert got == [(1, 0, 0, "One here."), (1, 1, 10, "Two there! three"), (1, 2, 27, "Four")]


def test_offsets_beyond_one_chunk(spark):
    body = " ".join(f"w{k}" for k in range(3 * text.CHUNK + 5)) + "."
    got = one(spark, text.tokens(F.col("b")), b=body, k=1)
    assert len(got) == 3 * text.CHUNK + 6 and all(body[r["start"] : r["end"]] == r["word"] for r in got)
