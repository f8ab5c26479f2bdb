"""Quality rules with cross-document line frequency.

Lines are normalised (ASCII letters lower-cased, runs of white space to one space, ends trimmed) and
hashed together with their host; a line that stands in more than LINE_LIMIT documents of its host is
boilerplate there and is removed; a document that loses more than DEPLETED of its words is rejected.
Base rules (length, repeated windows) are judged on the whole text beside that.

A document sends each of its line hashes once, counts combine before the exchange, and the join that
brings frequent lines back is on the hash, so that Spark can split a hot line. Nothing is broadcast by hand.

Defined cases: null text has no words and fails the base rule; null host is a host of its own; rows
without doc_id get no row; each row counts as a document, repeated ones too; very long texts are
measured alone in their batch; extra columns are unread, whatever their names; empty table, empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, identified, in_blocks, mixed, powers, signed, small_batches, text_bytes, word_hashes, words, written

#: A line in more documents of one host than this is boilerplate.
LINE_LIMIT = 50
#: A document that loses more than this percentage of its words is rejected.
DEPLETED = 50
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_document(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[ends[1:]] - total[ends[:-1]]


def repeated_words(hashes: np.ndarray, doc: np.ndarray, n: int, width: int = WINDOW) -> np.ndarray:
    """Words of each document that lie in a window of `width` words found twice or more in it."""
    if len(hashes) < width:
        return np.zeros(n, np.int64)
    m = len(hashes) - width + 1
    gram = np.zeros(m, np.uint64)
    for k in range(width):
        gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + m]
    gram = mixed(gram + doc[:m].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    at = np.flatnonzero(doc[:m] == doc[width - 1 :])
    _, back, count = np.unique(gram[at], return_inverse=True, return_counts=True)
    at = at[count[back] > 1]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\v\f\r"):
            if line in seen:
                again += 1
            else:
                seen.add(line)
    return again


def line_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the normalised line, its words, its document) for each line that has a word."""
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.cumsum(data == 10)[start] + doc  # distinct for lines of different documents, too
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    size = np.diff(np.concatenate([first, [len(line)]]))
    h = word_hashes(LOWER[data], start, end)
    h = h * powers(int(size.max()), 0xC2B2AE3D27D4EB4F)[np.arange(len(h)) - np.repeat(first, size)]
    return mixed(np.add.reduceat(h, first) + size.astype(np.uint64)), size, doc[first]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, host -> measures and, by document, its distinct (line hash, words in such lines) lists."""
    for batch in in_blocks(batches, 1 << 21):
        data, ends = text_bytes(batch.column(1))
        n = batch.num_rows
        start, end, doc = words(data, ends)
        inside = np.zeros(len(data), bool)
        whole = (data & 0xC0) != 0x80
        if len(data):
            edge = np.zeros(len(data) + 1, np.int8)
            edge[start] += 1
            edge[end] -= 1
            inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
        raw = word_hashes(data, start, end)
        h, size, of = line_hashes(data, start, end, doc)
        order = np.lexsort((h, of))
        h, size, of = h[order], size[order], of[order]
        head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (of[1:] != of[:-1])])) if len(h) else np.zeros(0, np.int64)
        total = np.add.reduceat(size, head) if len(head) else size
        cuts = np.concatenate([[0], np.cumsum(np.bincount(of[head], minlength=n))]).astype(np.int32)
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "host": batch.column(2),
                "n_words": pa.array(np.bincount(doc, minlength=n)),
                "word_chars": pa.array(_per_document(whole & inside, ends)),
                "n_symbols": pa.array(_per_document(_SYMBOL[data], ends)),
                "n_dup_lines": pa.array([duplicate_lines(t) if t else 0 for t in batch.column(1).to_pylist()], pa.int64()),
                "n_repeat_words": pa.array(repeated_words(raw, doc, n)),
                "lines": pa.ListArray.from_arrays(pa.array(cuts), pa.array(signed(h[head]))),
                "line_words": pa.ListArray.from_arrays(pa.array(cuts), pa.array(total)),
            }
        )


MEASURES = "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<long>"


def judged(df: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id", line_limit: int = LINE_LIMIT, depleted: int = DEPLETED) -> DataFrame:
    """One row for each row of df: key, the measures, base_failed, n_removed_lines, n_removed_words, kept."""
    small_batches(df.sparkSession)
    rows = identified(df, text, host, key=key).toDF("doc_id", "text", "host").withColumn("host", F.col("host").cast("string"))
    measured = rows.mapInArrow(_measured, MEASURES).withColumn("_row", F.monotonically_increasing_id())
    held = written(measured, "quality-lines")
    lines = held.select("_row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("l")).select(
        "_row", F.xxhash64("host", "l.lines").alias("_line"), F.col("l.line_words").alias("_words")
    )
    frequent = lines.groupBy("_line").count().where(F.col("count") > line_limit).select("_line")
    removed = lines.join(frequent, "_line").groupBy("_row").agg(F.count("*").alias("n_removed_lines"), F.sum("_words").alias("n_removed_words"))
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    lost = F.coalesce("n_removed_words", F.lit(0))
    return (
        held.drop("lines", "line_words", "host")
        .join(removed, "_row", "left")
        .select(
            F.col("doc_id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"),
            F.coalesce("n_removed_lines", F.lit(0)).alias("n_removed_lines"), lost.alias("n_removed_words"),
            (~base_failed & (100 * lost <= depleted * F.col("n_words"))).alias("kept"),
        )
    )


def cleaned(df: DataFrame, text: str = "text", host: str = "source", key: str = "doc_id", line_limit: int = LINE_LIMIT) -> DataFrame:
    """key and the text without its host's frequent lines, for rows with a key; lines keep their order."""
    norm = lambda x: F.regexp_replace(F.trim(F.regexp_replace(F.translate(x, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[\x20\x09-\x0D]+", " ")), "^ | $", "")
    rows = identified(df, text, host, key=key).withColumn("_row", F.monotonically_increasing_id())
    held = written(rows, "quality-texts")
    lines = held.select("_row", host, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("_at", "_raw")).withColumn("_line", norm(F.col("_raw")))
    keyed = lines.where("_line <> ''").select("_row", "_at", F.xxhash64(host, "_line").alias("_h"))
    frequent = keyed.dropDuplicates(["_row", "_h"]).groupBy("_h").count().where(F.col("count") > line_limit).select("_h")
    gone = keyed.join(frequent, "_h").groupBy("_row").agg(F.collect_set("_at").alias("_gone"))
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x, k: ~F.coalesce(F.array_contains("_gone", k), F.lit(False)))
    return held.join(gone, "_row", "left").select(key, F.array_join(parts, "\n").alias(text))
