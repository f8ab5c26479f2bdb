"""Text to mentions: lexicon phrases, patterns, and the union of extraction methods.

A mention's `seq` orders it within its record. Bits 56 and up: the method; bit 55: patterns, after the lexicon; below,
offset * number of terms + term for the lexicon, pattern << 31 + offset for patterns. Offsets are under 2 ** 31.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ontology, text
from ..runtime import kernel, small_batches
from ..schema import MENTION_CORE, conform
from . import scan
from .dedup import priority_dedup, priority_rank, resolve_overlaps

#: Terms of one lexicon: with offsets under 2 ** 31, seq keeps within 55 bits.
MOST_TERMS = 1 << 24


def phrase_key(words: Column) -> Column:
    """Lower-cased tokens with single spaces between them."""
    return F.lower(F.array_join(words, " "))


def sentences(df: DataFrame, body: str = "text_en", pattern: str = text.SENTENCE_END) -> DataFrame:
    """df with a row for each sentence: sent (from 0), sent_start and sentence."""
    # pieces keep their separators: the text is cut where a separator ends
    ends = F.regexp_extract_all(F.col(body), F.lit(f"(?s)(.*?)((?:{pattern})|$)"), F.lit(1))
    gaps = F.regexp_extract_all(F.col(body), F.lit(f"(?s)(.*?)((?:{pattern})|$)"), F.lit(2))
    laid = text.laid_out(F.concat(F.array(F.lit("")), F.slice(gaps, 1, F.greatest(F.size(gaps) - 1, F.lit(0)))), ends)
    rows = df.select("*", F.posexplode(F.filter(laid, lambda x: x["word"] != "")).alias("sent", "_s"))
    return rows.select(*df.columns, "sent", F.col("_s.start").alias("sent_start"), F.col("_s.word").alias("sentence"))


def lexicon_mentions(df: DataFrame, lexicon: dict[str, list[str]] = ontology.LEXICONS, body: str = "text_en", method: str = "gazetteer") -> DataFrame:
    """All matches of lexicon phrases, token by token and whatever the case; overlapping ones, too."""
    spark = df.sparkSession
    rows = [(label, term) for label, terms in lexicon.items() for term in terms]
    if len(rows) > MOST_TERMS:
        raise ValueError(f"a lexicon of more than {MOST_TERMS} terms leaves no room for offsets in seq")
    listed = spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(rows)], "label string, term string, ord int")
    listed = listed.withColumn("_t", F.transform(text.tokens(F.col("term")), lambda x: x["word"])).select("label", "ord", F.size("_t").alias("_n"), phrase_key(F.col("_t")).alias("_key"))
    longest = max([len(t.split()) + 2 * t.count("-") for _, t in rows] or [1])
    words = df.where(text.not_blank(F.col(body))).withColumn("_words", text.tokens(F.col(body)))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(longest)),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.greatest(F.size("_words") - n + 1, F.lit(1))),
                lambda i: F.struct(n.alias("n"), F.element_at("_words", i)["start"].alias("start"), F.try_element_at("_words", i + n - 1)["end"].alias("end"), phrase_key(F.transform(F.slice("_words", i, n), lambda x: x["word"])).alias("key")),
            ),
        )
    )
    found = words.select(*df.columns, F.explode(grams).alias("_g")).where("_g.end is not null")
    hits = found.join(F.broadcast(listed), (F.col("_g.key") == F.col("_key")) & (F.col("_g.n") == F.col("_n")))  # the lexicon: a fixed argument
    return hits.select(
        "id", F.col(body).substr(F.col("_g.start") + 1, F.col("_g.end") - F.col("_g.start")).alias("word"), "label", F.lit(1.0).alias("score"), F.col(body).alias("text_en"),
        F.lit(method).alias("method"), F.col("_g.start").alias("start"), F.col("_g.end").alias("end"), (F.col("_g.start").cast("long") * max(len(rows), 1) + F.col("ord")).alias("seq"),
    )


def pattern_mentions(df: DataFrame, patterns: dict[str, str] = ontology.PATTERNS, body: str = "text_en", method: str = "gazetteer") -> DataFrame:
    """All non-overlapping matches of each pattern, whatever the case; ordered by pattern, after the lexicon."""
    rows = df.where(text.not_blank(F.col(body)))
    listed = F.array(*(F.struct(F.lit(label).alias("label"), F.lit(k).alias("ord"), text.find_all(F.col(body), p).alias("found")) for k, (label, p) in enumerate(patterns.items())))
    hits = rows.select("id", body, F.explode(listed).alias("_p")).select("id", body, "_p.label", "_p.ord", F.explode("_p.found").alias("_f"))
    return hits.select(
        "id", F.col("_f.word").alias("word"), "label", F.lit(1.0).alias("score"), F.col(body).alias("text_en"), F.lit(method).alias("method"),
        F.col("_f.start").alias("start"), F.col("_f.end").alias("end"), (F.lit(1 << 55) + F.col("ord").cast("long") * (1 << 31) + F.col("_f.start")).alias("seq"),
    )


def gazetteer(df: DataFrame, lexicon: dict[str, list[str]] = ontology.LEXICONS, patterns: dict[str, str] = ontology.PATTERNS, body: str = "text_en") -> DataFrame:
    """Lexicon mentions and then pattern mentions of each non-blank record."""
    return lexicon_mentions(df, lexicon, body).unionByName(pattern_mentions(df, patterns, body))


def united(methods: list[DataFrame], seq: str = "seq") -> DataFrame | None:
    """The methods' mentions as one table, in order of the methods; blank words go. None without methods."""
    if not methods:
        return None
    numbered = [m.withColumn("seq", F.col(seq) + F.lit(k) * (1 << 56)) for k, m in enumerate(methods)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered).where(text.not_blank(F.col("word")))


def reconciled(raw: DataFrame, threshold: float = ontology.MENTION_THRESHOLD, priority: tuple[str, ...] = ontology.MENTION_PRIORITY) -> DataFrame:
    """Scores under the threshold go, one mention stays for each record and lower-cased word, overlaps are resolved."""
    kept = raw.where(F.col("score") >= threshold) if threshold > 0 else raw
    kept = priority_dedup(kept.withColumn("_lower", F.lower("word")), ["id", "_lower"], priority, ["seq"]).drop("_lower")
    return resolve_overlaps(kept, priority_rank(F.col("method"), priority), ["seq"])


def empty(spark) -> DataFrame:
    return conform(spark.createDataFrame([], MENTION_CORE), MENTION_CORE).withColumn("seq", F.lit(0).cast("long"))


def text_rows(df: DataFrame, key: str, body: str) -> DataFrame:
    """id, _s: whole texts, whose sentences are the pieces between sentence marks (scan.MARKS), numbered by place."""
    return df.select(F.col(key).alias("id"), F.col(body).alias("_s"))


def pieces(body: str) -> Column:
    """The sentences of one of text_rows."""
    return F.split(body, f"[{scan.MARKS}]+", -1)


def word_rows(df: DataFrame, key: str, body: str) -> DataFrame:
    """id, sent, sentence, words: pieces between sentence marks, and their ASCII words in lower case. A plain
    splitter for texts whose offsets are counted in words."""
    rows = df.select(F.col(key).alias("id"), F.posexplode(pieces(body)).alias("sent", "sentence"))
    return rows.withColumn("words", F.split(F.lower("sentence"), "[^a-z0-9]+", -1))


def gram_mentions(rows: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    """id, sent, p, n, word, label, ord: every run of n words that is a phrase of the lexicon. rows: of word_rows or text_rows.

    Whole texts are scanned by a kernel in their row (scan.finder), if all terms are ASCII words. In rows of words, a word that
    starts a term is looked for first, in generated code; only there are runs put together and compared with the terms of
    their length. No row is exchanged."""
    if "_s" in rows.columns:
        if lexicon and all(_PLAIN.fullmatch(t) for own in lexicon.values() for t in own):
            return _scanned(rows, lexicon)
        rows = rows.select("id", F.posexplode(pieces("_s")).alias("sent", "sentence")).withColumn("words", F.split(F.lower("sentence"), "[^a-z0-9]+", -1))
    listed = ontology.terms(rows.sparkSession, lexicon)
    terms: dict[int, list[str]] = {}
    for t in dict.fromkeys(t for own in lexicon.values() for t in own):
        terms.setdefault(len(t.split(" ")), []).append(t)
    if not terms:
        terms[1] = [""]
    heads = {n: sorted({t.split(" ")[0] for t in own}) for n, own in terms.items()}

    def run(n: int) -> Column:
        term = F.col("_w") if n == 1 else F.array_join(F.slice("words", F.col("p") + 1, n), " ")
        whole = F.lit(True) if n == 1 else F.col("_w").isin(*heads[n]) & (F.col("p") + n <= F.size("words"))
        return F.when(whole & term.isin(*terms[n]), F.struct(F.lit(n).alias("n"), term.alias("term")))

    first = rows.select("id", "sent", "words", F.posexplode("words").alias("p", "_w")).where(F.col("_w").isin(*sorted({h for own in heads.values() for h in own})))
    found = first.select("id", "sent", "p", F.explode(F.array(*map(run, sorted(terms)))).alias("g")).where("g is not null").select("id", "sent", "p", "g.*")
    return found.join(F.broadcast(listed), "term").select("id", "sent", "p", "n", F.col("term").alias("word"), "label", "ord")  # the lexicon: a dict that the driver holds


#: Terms that a run of words can equal without empty words.
_PLAIN = re.compile("[a-z0-9]+( [a-z0-9]+)*")


def _scanned(rows: DataFrame, lexicon: dict[str, list[str]]) -> DataFrame:
    spark = rows.sparkSession
    small_batches(spark)
    terms = list(dict.fromkeys(t for own in lexicon.values() for t in own))
    if not terms:
        return gram_mentions(rows, {})
    number = {t: k for k, t in enumerate(terms)}
    every = [(label, t) for label, own in lexicon.items() for t in own]
    listed = spark.createDataFrame([(number[t], len(t.split(" ")), t, label, k) for k, (label, t) in enumerate(every)], "t int, n int, word string, label string, ord int")
    found = rows.select("id", kernel(scan.finder(terms), scan.FOUND)("_s").alias("_f")).select("id", F.inline("_f"))
    return found.join(F.broadcast(listed), "t").select("id", "sent", "p", "n", "word", "label", "ord")  # the lexicon: a dict that the driver holds
