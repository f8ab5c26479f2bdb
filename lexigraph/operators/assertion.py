"""Assertion of mentions: cue phrases within a bounded scope of the same sentence.

The cue table is an argument; CUES is a small list in the manner of the published NegEx and ConText rules.
Everything is a join on (id, sent): cues meet the mentions of their own sentence only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ontology, text
from ..functions.ontology import ASSERTION_FLAGS

#: category: cues that look forward; `<` marks cues that look back.
CUE_TEXT = """
negated: no; denies; denied; without; no evidence of; no sign of; no signs of; negative for; absence of; free of; rules out; ruled out; never; not
uncertain: possible; possibly; probable; suspected; suspicion of; suggestive of; may be; cannot exclude; questionable; likely; rule out
family: mother; father; sister; brother; grandmother; grandfather; family history of; aunt; uncle; cousin; maternal; paternal
historical: history of; past medical history of; previous; previously; prior; past; status post
"""


def cue_table(spark, scope: int = ontology.ASSERTION_SCOPE) -> DataFrame:
    """cue, category (a flag column), backward, scope."""
    flag = {status: column for column, status in ASSERTION_FLAGS}
    rows = [(c, flag[k], False, scope) for k, _, body in (line.partition(": ") for line in CUE_TEXT.strip().splitlines()) for c in body.split("; ")]
    rows += [(c, "is_negated", True, scope) for c in ontology.BACKWARD_NEGATION]
    return spark.createDataFrame(rows, "cue string, category string, backward boolean, scope int")


def token_rows(sents: DataFrame, body: str = "sentence") -> DataFrame:
    """id, sent, p (place in the sentence), tok (lower case), start and end within the record."""
    rows = sents.select("id", "sent", "sent_start", F.posexplode(text.tokens(F.col(body))).alias("p", "_t"))
    return rows.select("id", "sent", "p", F.lower("_t.word").alias("tok"), (F.col("_t.start") + F.col("sent_start")).alias("start"), (F.col("_t.end") + F.col("sent_start")).alias("end"))


def cue_scopes(tokens: DataFrame, cues: DataFrame, terminators: list[str] = ontology.TERMINATORS) -> DataFrame:
    """id, sent, category, first, last: the token places that each cue reaches.

    A cue reaches at most `scope` tokens ahead of its end (or before its start, if it looks back), and not past a terminator."""
    line = Window.partitionBy("id", "sent").orderBy("p")
    stop = F.when(F.col("tok").isin(*terminators), F.col("p"))
    words = tokens.withColumn("_next", F.min(stop).over(line.rowsBetween(1, Window.unboundedFollowing))).withColumn("_before", F.max(stop).over(line.rowsBetween(Window.unboundedPreceding, -1)))
    parts = cues.withColumn("_cue", F.split("cue", " ")).withColumn("_n", F.size("_cue"))
    longest = parts.agg(F.max("_n")).first()[0] or 1  # words of the longest cue
    ahead = words.withColumn("_words", F.collect_list("tok").over(line.rowsBetween(0, longest - 1))).withColumn("_stops", F.collect_list(F.coalesce("_next", F.lit(-1))).over(line.rowsBetween(0, longest - 1)))
    hits = ahead.join(F.broadcast(parts), F.col("tok") == F.col("_cue")[0]).where(F.slice("_words", 1, F.greatest("_n", F.lit(1))) == F.col("_cue"))  # the cue table: a fixed argument
    last_of_cue = F.col("p") + F.col("_n") - 1
    after = F.element_at("_stops", F.col("_n"))
    forward_end = F.least(last_of_cue + F.col("scope"), F.when(after >= 0, after - 1).otherwise(last_of_cue + F.col("scope")))
    backward_start = F.greatest(F.col("p") - F.col("scope"), F.coalesce(F.col("_before") + 1, F.col("p") - F.col("scope")))
    return hits.select(
        "id", "sent", "category",
        F.when(F.col("backward"), backward_start).otherwise(last_of_cue + 1).alias("first"),
        F.when(F.col("backward"), F.col("p") - 1).otherwise(forward_end).alias("last"),
    ).where("first <= last")


def flag_spans(placed: DataFrame, scopes: DataFrame, keys: list[str]) -> DataFrame:
    """keys and one boolean for each flag: whether a scope of that category overlaps the tokens first_tok .. last_tok."""
    names = [name for name, _ in ASSERTION_FLAGS]
    hit = placed.join(scopes, ["id", "sent"], "left").withColumn("_in", (F.col("first") <= F.col("last_tok")) & (F.col("first_tok") <= F.col("last")))
    return hit.groupBy(*keys).agg(*(F.coalesce(F.bool_or(F.col("_in") & (F.col("category") == n)), F.lit(False)).alias(n) for n in names))


def span_offsets(start: Column, end: Column, body: Column, word: Column) -> tuple[Column, Column]:
    """The given offsets, or those of the word's first occurrence; null if there is none."""
    at = F.when(start.isNotNull() & end.isNotNull(), start).otherwise(text.first_start(body, word))
    return at, F.when(start.isNotNull() & end.isNotNull(), end).otherwise(at + F.length(word))


def asserted(mentions: DataFrame, docs: DataFrame, sents: DataFrame, cues: DataFrame | None = None, terminators: list[str] = ontology.TERMINATORS) -> DataFrame:
    """mentions with the four flags. Places grow to token borders; mentions that can't be placed stay all false."""
    names = [name for name, _ in ASSERTION_FLAGS]
    cues = cues if cues is not None else cue_table(mentions.sparkSession)
    tokens = token_rows(sents)
    bodies = docs.select("id", F.col("text_en").alias("_body"))
    start, end = span_offsets(F.col("start"), F.col("end"), F.col("_body"), F.col("word"))
    spans = mentions.select("id", "start", "end", "word").distinct().join(bodies, "id").select("id", "word", F.col("start").alias("start0"), F.col("end").alias("end0"), start.alias("s"), end.alias("e"))
    covered = spans.join(tokens.select("id", "sent", "p", F.col("start").alias("ts"), F.col("end").alias("te")), "id").where("ts < e and s < te")
    placed = covered.groupBy("id", "word", "start0", "end0").agg(F.min("sent").alias("sent"), F.min("p").alias("first_tok"), F.max("p").alias("last_tok"))
    flags = flag_spans(placed, cue_scopes(tokens, cues, terminators), ["id", "word", "start0", "end0"])
    m, f = mentions.drop(*names).alias("m"), flags.alias("f")
    on = (F.col("m.id") == F.col("f.id")) & (F.col("m.word") == F.col("f.word")) & F.col("m.start").eqNullSafe(F.col("f.start0")) & F.col("m.end").eqNullSafe(F.col("f.end0"))
    return m.join(f, on, "left").select("m.*", *(F.coalesce(F.col(f"f.{n}"), F.lit(False)).alias(n) for n in names))


def mention_status() -> Column:
    """A mention's statuses, joined by + in order of precedence, or affirmed."""
    return text.statuses([(F.col(c), s) for c, s in ASSERTION_FLAGS])


def endpoint_flags(relations: DataFrame, mentions: DataFrame) -> DataFrame:
    """relations with each endpoint's flags (any mention of the record, word and label counts) and their assertion."""
    names = [name for name, _ in ASSERTION_FLAGS]
    by_key = mentions.groupBy("id", F.lower("word").alias("_w"), F.col("label").alias("_l")).agg(*(F.bool_or(F.coalesce(n, F.lit(False))).alias(n) for n in names))
    out = relations
    for k in (1, 2):
        side = by_key.select(F.col("id"), F.col("_w").alias(f"_w{k}"), F.col("_l").alias(f"entity{k}_label"), *(F.col(n).alias(f"_{k}{n}") for n in names))
        out = out.withColumn(f"_w{k}", F.lower(f"entity{k}")).join(side, ["id", f"_w{k}", f"entity{k}_label"], "left")
        out = out.withColumns({f"entity{k}_{n.removeprefix('is_')}": F.coalesce(f"_{k}{n}", F.lit(False)) for n in names}).drop(f"_w{k}", *(f"_{k}{n}" for n in names))
    either = [(F.col(f"entity1_{n.removeprefix('is_')}") | F.col(f"entity2_{n.removeprefix('is_')}"), s) for n, s in ASSERTION_FLAGS]
    return out.withColumn("assertion", text.statuses(either))
