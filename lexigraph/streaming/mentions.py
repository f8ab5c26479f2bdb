"""The row-local extractors over streams, and micro-batch upserts of what they find.

Extraction is stateless: a streaming frame of documents goes through the same operators as a table. What needs
a record's mentions together (priority, overlaps) runs within a micro-batch, because a record arrives whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import ontology
from ..operators import mentions


def extracted(docs: DataFrame, lexicon: dict[str, list[str]] = ontology.LEXICONS, patterns: dict[str, str] = ontology.PATTERNS) -> DataFrame:
    """Raw gazetteer mentions of a batch or streaming frame of documents (id, text_en)."""
    return mentions.gazetteer(docs, lexicon, patterns)


def windowed_counts(found: DataFrame, at: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Mentions by label and event-time window; windows close `late` after the watermark passes them."""
    return found.withWatermark(at, late).groupBy(F.window(at, width), "label").count()


def upserting(docs: DataFrame, checkpoint: str, store: Callable[[DataFrame, int], None], **trigger) -> StreamingQuery:
    """Reconciled mentions of each micro-batch handed to store(df, batch_id); a store that merges by key makes the
    stream repeatable, because a batch is handed over again after a failure."""

    def each(batch: DataFrame, number: int) -> None:
        raw = mentions.united([mentions.gazetteer(batch)])
        store(mentions.reconciled(raw), number)

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def files(spark: SparkSession, path: str, schema: str = "id long, text_en string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
