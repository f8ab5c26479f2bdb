"""Scalar text functions as Column expressions; everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words and single marks, as phrase matching sees a text.
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
#: A sentence ends at . ! or ? before white space and a capital, or at a line's end.
SENTENCE_END = r"(?<=[.!?])\s+(?=\p{Lu})|\n+"


def stripped(text: Column) -> Column:
    """Without white space (any Unicode kind) at the ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def not_blank(text: Column) -> Column:
    return text.isNotNull() & text.rlike(r"(?U)\S")


def clean_text(text: Column) -> Column:
    """Stripped, without one pair of equal outer quotes, stripped again; null stays null."""
    s = stripped(text)
    quoted = (F.length(s) >= 2) & (F.substring(s, 1, 1).isin('"', "'")) & (F.substring(s, 1, 1) == F.substring(s, -1, 1))
    return F.when(quoted, stripped(s.substr(F.lit(2), F.length(s) - 2))).otherwise(s)


#: Parts that are laid out one after another; appending copies no longer an array than this.
CHUNK = 256


def laid_out(gaps: Column, parts: Column) -> Column:
    """array<struct<word,start,end>> of parts[i], each preceded by gaps[i].

    Parts are laid out in chunks, each from 0, and the chunks are then shifted, so that a text of n parts takes
    about n * CHUNK steps at most."""
    pairs = F.zip_with(gaps, parts, lambda g, p: F.struct(F.length(g).alias("gap"), p.alias("part")))
    chunk_type = "struct<at: int, found: array<struct<word: string, start: int, end: int>>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["part"])
        return F.struct(end.alias("at"), F.array_append(acc["found"], F.struct(x["part"].alias("word"), start.alias("start"), end.alias("end"))).alias("found"))

    def chunk(x: Column) -> Column:
        return F.aggregate(x, F.expr(f"cast(struct(0, array()) as {chunk_type})"), step)

    n = F.size(pairs)
    many = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK)), lambda k: chunk(F.slice(pairs, (k * CHUNK + 1).cast("int"), F.lit(CHUNK))))
    # where each chunk begins: one more element than there are chunks
    begins = F.aggregate(many, F.expr("struct(0 as at, array(0) as begins)"), lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.array_append(acc["begins"], acc["at"] + c["at"]).alias("begins")))["begins"]
    moved = F.zip_with(many, F.slice(begins, F.lit(1), F.size(many)), lambda c, at: F.transform(c["found"], lambda x: F.struct(x["word"].alias("word"), (x["start"] + at).alias("start"), (x["end"] + at).alias("end"))))
    return F.when(n <= CHUNK, chunk(pairs)["found"]).when(n > CHUNK, F.flatten(moved))


def find_all(text: Column, pattern: str, flags: str = "i") -> Column:
    """array<struct<word,start,end>> of the pattern's non-overlapping matches; offsets are code points.

    Each search starts where the last match ended, so a text without matches is read once."""
    whole = F.lit(f"(?{flags}sU)\\G(.*?)({pattern})")
    return laid_out(F.regexp_extract_all(text, whole, F.lit(1)), F.regexp_extract_all(text, whole, F.lit(2)))


def tokens(text: Column) -> Column:
    return find_all(text, TOKEN)


def first_start(text: Column, word: Column) -> Column:
    """0-based place of the first occurrence, whatever the case; null if there is none or the word is empty."""
    at = F.call_function("locate", F.lower(word), F.lower(text))
    return F.when((at > 0) & (F.length(word) > 0), at - 1)


def marked(text: Column, word: Column, left: str, right: str) -> Column:
    """The first occurrence of word, whatever its case, replaced by the word itself between two marks."""
    at = first_start(text, word)
    new = F.concat(text.substr(F.lit(1), at), F.lit(left), word, F.lit(right), text.substr(at + F.length(word) + 1, F.length(text)))
    return F.when(at.isNull(), text).otherwise(new)


def identifier(name: Column, default: str) -> Column:
    """Only letters, digits and inner underscores; the default if nothing is left."""
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(name, "[^A-Za-z0-9_]", "_"), F.lit("_")), F.lit("")), F.lit(default))


def leading_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\d+(?:\.\d+)?", 0), F.lit("")).cast("double")


def unit_after_number(text: Column) -> Column:
    """What follows the first number, without blanks and hyphens at the ends; null if there is no number or no unit."""
    rest = F.regexp_extract(text, r"(?s)^.*?\d+(?:\.\d+)?(.*)$", 1)
    return F.nullif(F.btrim(rest, F.lit(" -")), F.lit(""))


def usable(value: Column) -> Column:
    """Null for what counts as no value: null, blank, nan and none."""
    s = stripped(value.cast("string"))
    return F.when(F.lower(s).isin("", "nan", "none"), None).otherwise(s)


def statuses(flags: list[tuple[Column, str]]) -> Column:
    """The names of the true flags joined by +, or affirmed; null counts as false."""
    named = F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for c, name in flags))
    return F.coalesce(F.nullif(F.array_join(named, "+"), F.lit("")), F.lit("affirmed"))
