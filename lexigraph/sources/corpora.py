"""Readers: raw text blocks, delimited corpora, and the tables that stages exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..operators.dedup import first_per_key
from ..schema import DOCUMENTS, conform

#: The line that ends a block: a number, a speciality, two or more blanks, a category.
META = r"\d+\.\s*(.+?)\s{2,}(.+)$"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """file, value: each file's complete text (UTF-8)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header; quotes are doubled, values may have line breaks. Without a schema all columns are strings."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("sep", sep)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def parse_blocks(files: DataFrame) -> DataFrame:
    """file, id, text, specjalizacja, kategoria of blocks: an id line, text lines, and a line that starts with `-` and
    carries the metadata. Blank lines don't count. A block without valid metadata is an error."""
    lines = files.select("file", F.posexplode(F.split("value", r"\r\n|[\n\r]")).alias("n", "line")).withColumn("line", text.stripped(F.col("line"))).where("line <> ''")
    order = Window.partitionBy("file").orderBy("n")
    # the first line of a block is its id, whatever it looks like; a dash ends a block from its second line on
    numbered = lines.withColumn("_ends", F.startswith("line", F.lit("-")).cast("int"))
    block = F.coalesce(F.sum("_ends").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = numbered.withColumn("block", block)
    grouped = rows.groupBy("file", "block").agg(
        F.min_by("line", "n").alias("_id"), F.max_by("line", "n").alias("_meta"), F.max("_ends").alias("_closed"), F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"]).alias("_lines")
    )
    bad = F.raise_error(F.concat(F.lit("block without metadata after "), F.col("_id")))
    checked = grouped.withColumn("_m", F.when((F.col("_closed") == 0) | (F.regexp_extract("_meta", META, 0) == ""), bad).otherwise(F.col("_meta")))
    return checked.select(
        "file", "block", F.try_to_number(F.regexp_extract("_id", r"\d+", 0), F.lit("999999999999999999")).cast("long").alias("id"), F.array_join(F.slice("_lines", 2, F.greatest(F.size("_lines") - 2, F.lit(0))), " ").alias("text"),
        text.stripped(F.regexp_extract("_m", META, 1)).alias("specjalizacja"), text.stripped(F.regexp_extract("_m", META, 2)).alias("kategoria"),
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a block corpus; text_en is the cleaned text until a translator fills it in."""
    return conform(parse_blocks(whole_files(spark, path)).withColumn("text_en", text.clean_text(F.col("text"))), DOCUMENTS)


def distinct_phrases(rows: DataFrame, phrase: str = "phrase", seq: str = "seq") -> DataFrame:
    """Documents of a phrase table: equal phrases once (the first by seq), ids from 1 in order of first appearance."""
    from ..plans.concept_graph import numbered

    first = first_per_key(rows.where(F.col(phrase).isNotNull()), [phrase], [seq])
    out = numbered(first.select(F.col(seq).alias("_seq"), F.col(phrase).alias("text")), "_seq", "id")
    unknown = F.lit("Unknown")
    return conform(out.withColumns({"text_en": text.clean_text(F.col("text")), "specjalizacja": unknown, "kategoria": unknown}), DOCUMENTS)


def read_phrases(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a `;`-separated corpus with a column phrase."""
    rows = read_csv(spark, path, sep=";")
    return distinct_phrases(rows.withColumn("seq", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())).select("phrase", "seq"))


READERS = {"txt": read_blocks, "csv": read_phrases}


def read_corpus(spark: SparkSession, path: str, data_format: str = "txt") -> DataFrame:
    if data_format not in READERS:
        raise ValueError(f"unknown corpus format {data_format!r}")
    return READERS[data_format](spark, path)


def converted(rows: DataFrame, key: str = "id", phrase: str = "phrase", seq: str = "seq") -> DataFrame:
    """id, text_en of a wide corpus: cleaned phrases; rows without id or phrase, and empty phrases, go; first row of each id."""
    kept = rows.select(F.col(key).cast("long").alias("id"), text.clean_text(F.col(phrase)).alias("text_en"), seq).where("id is not null and text_en <> ''")
    return first_per_key(kept, ["id"], [seq]).select("id", "text_en")


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)
