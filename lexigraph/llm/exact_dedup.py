"""Exact deduplication by Grace hashing.

Level 0 is a combiner and Spark's exchange: each input partition collapses equal texts inside bounded
runs, so that a group of copies sends one text for each run, however large the group is; the survivors
are dealt by content hash. Inside a task the Grace recursion goes on: while a bucket is over the memory
budget its records are partitioned into spill files by the next hash bits, and a bucket that fits goes
through an open-addressing table that compares complete contents.

Membership travels apart from content: each row remembers its run's representative (`uid`), and a join
on uid brings the verdict back. No task ever holds a whole group of copies: a bucket of one hash, however many
copies each run has sent, streams past the one content that is held. The spill files lie in the task's own
temporary folder and go with the task; a lost executor's task starts again from the exchange.

Defined cases: null text counts as empty, and all empty texts are equal; a row without doc_id has no
identity and gets no result row; if the smallest doc_id of a group occurs in several equal rows, exactly
one of them stays; an empty table gives an empty result; extra columns are ignored (or, in
`deduplicated`, carried along unread).
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import identified, small_batches, written

#: Bytes of text that a combiner run or a Grace bucket may hold in memory.
RUN_BYTES = 16 << 20
BUCKET_BYTES = 32 << 20
FANOUT_BITS = 4


def normalised(text: str | None) -> str:
    """Each run of `[\\x20\\x09-\\x0D]` becomes one space; null is empty."""
    if not text:
        return ""
    for c in "\t\n\v\f\r":
        if c in text:
            text = text.replace(c, " ")
    while "  " in text:
        text = text.replace("  ", " ")
    return text


class ContentTable:
    """Open addressing with linear probing; equality is decided on the complete content."""

    def __init__(self, bits: int = 10):
        self.slots = np.full(1 << bits, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def __len__(self) -> int:
        return len(self.contents)

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for k, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k

    def find_or_add(self, h: int, content: bytes) -> int:
        """The number of this content, counted from 0 in order of first arrival."""
        mask = len(self.slots) - 1
        at = h & mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == h and self.contents[k] == content:
                return int(k)
            at = (at + 1) & mask
        k = len(self.contents)
        self.slots[at] = k
        self.hashes.append(h)
        self.contents.append(content)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return k


def content_hash(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _runs(batches: Iterator[pa.RecordBatch], text: str, most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(batch.schema.get_field_index(text)).nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def combiner(text: str, key: str, run_bytes: int = RUN_BYTES):
    """mapInArrow body: adds _run (place of the run's representative, unique with _part), _rep, _n, _hash, _sha, _norm."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = 0
        for run in _runs(batches, text, run_bytes):
            seen, best, count, of, shas, hashes = ContentTable(), [], [], [], [], []
            keys = run.column(key).to_pylist()
            norms = []
            for row, value in enumerate(run.column(text).to_pylist()):
                norm = normalised(value).encode()
                digest = hashlib.sha256(norm).digest()
                h = content_hash(digest)
                k = seen.find_or_add(h, norm)
                norms.append(norm)
                shas.append(digest.hex())
                hashes.append(h)
                of.append(k)
                if k == len(best):
                    best.append(row)
                    count.append(0)
                elif keys[row] < keys[best[k]]:
                    best[k] = row
                count[k] += 1
            rep = [best[k] == row for row, k in enumerate(of)]
            out = run
            for name, value in (
                ("_run", pa.array([made + best[k] for k in of], pa.int64())),
                ("_rep", pa.array(rep, pa.bool_())),
                ("_n", pa.array([count[k] for k in of], pa.int64())),
                ("_hash", pa.array(hashes, pa.int64())),
                ("_sha", pa.array(shas, pa.string())),
                ("_norm", pa.array([x if r else None for x, r in zip(norms, rep, strict=True)], pa.binary())),
            ):
                out = out.append_column(name, value)
            made += run.num_rows
            yield from out.combine_chunks().to_batches(max_chunksize=1000)

    return combine


ADDED = [
    T.StructField("_run", T.LongType()), T.StructField("_rep", T.BooleanType()), T.StructField("_n", T.LongType()),
    T.StructField("_hash", T.LongType()), T.StructField("_sha", T.StringType()), T.StructField("_norm", T.BinaryType()),
]


def grace(batches: Iterator[pa.RecordBatch], solve, most: int = BUCKET_BYTES, level: int = 0) -> Iterator[pa.RecordBatch]:
    """Buckets of records whose `_hash` agrees in ever more bits; solve() gets each bucket that fits. A bucket of one
    hash, which no bits can split (copies of one text, most likely), streams through solve(), whatever its size."""
    held, size, files, folder = [], 0, None, None
    try:
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size > most:
                if files is None:
                    folder, files = tempfile.mkdtemp(prefix="grace-"), {}
                _spill(held, files, folder, level)
                held, size = [], 0
        if files is None:
            if held:
                yield from solve(held)
            return
        _spill(held, files, folder, level)
        held = []
        for sink, writer, *_ in files.values():
            writer.close()
            sink.close()
        for k in sorted(files):
            _, _, path, low, high = files[k]
            with pa.OSFile(path, "rb") as source:
                stream = iter(pa.ipc.open_stream(source))
                yield from solve(stream) if low == high else grace(stream, solve, most, level + 1)
            os.remove(path)
    finally:
        if folder:
            shutil.rmtree(folder, ignore_errors=True)


def _spill(held: list[pa.RecordBatch], files: dict, folder: str, level: int) -> None:
    for batch in held:
        h = batch.column(batch.schema.get_field_index("_hash")).to_numpy(zero_copy_only=False).view(np.uint64)
        part = (h >> np.uint64(64 - FANOUT_BITS * (level + 1))) & np.uint64((1 << FANOUT_BITS) - 1)
        for k in np.unique(part).tolist():
            if k not in files:
                path = os.path.join(folder, f"{k}.arrow")
                sink = pa.OSFile(path, "wb")
                files[k] = [sink, pa.ipc.new_stream(sink, batch.schema), path, None, None]
            at = np.flatnonzero(part == k)
            files[k][1].write_batch(batch.take(pa.array(at)))
            low, high = int(h[at].min()), int(h[at].max())
            files[k][3:] = (low, high) if files[k][3] is None else (min(low, files[k][3]), max(high, files[k][4]))


def resolver(key: str, keep_columns: list[str] | None, bucket_bytes: int = BUCKET_BYTES):
    """mapInArrow body over one level-0 partition: verdicts by uid, or the complete rows that stay."""

    def solve(held: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Holds each distinct content and, where rows are kept, the best row of each; of all other rows their ids."""
        seen, of, best, count = ContentTable(), [], [], []
        keys, uids, kept = [], [], {}
        for batch in held:
            first = len(keys)
            new_keys, new_uids, counts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (key, "_uid", "_n"))
            keys += new_keys
            uids += new_uids
            changed = set()
            for row, h, norm, n in zip(range(first, len(keys)), *(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_hash", "_norm")), counts, strict=True):
                k = seen.find_or_add(h, norm)
                of.append(k)
                if k == len(best):
                    best.append(row)
                    count.append(0)
                    changed.add(k)
                elif (keys[row], uids[row]) < (keys[best[k]], uids[best[k]]):
                    best[k] = row
                    changed.add(k)
                count[k] += n
            if keep_columns is not None and changed:
                own = sorted(changed)
                rows = batch.select(keep_columns).take(pa.array([best[k] - first for k in own]))  # a copy: the batch can go
                for j, k in enumerate(own):
                    kept[k] = rows.slice(j, 1)
        if keep_columns is not None:
            for at in range(0, len(best), 1000):
                yield from pa.Table.from_batches([kept[k] for k in range(at, min(at + 1000, len(best)))]).combine_chunks().to_batches()
        else:
            yield pa.RecordBatch.from_pydict(
                {
                    "_uid": pa.array(uids, pa.string()),
                    "keep_id": pa.array([keys[best[k]] for k in of], pa.int64()),
                    "_winner": pa.array([uids[best[k]] for k in of], pa.string()),
                    "group_size": pa.array([count[k] for k in of], pa.int64()),
                }
            )

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grace(batches, solve, bucket_bytes)

    return resolve


def _combined(df: DataFrame, text: str, key: str, run_bytes: int) -> DataFrame:
    small_batches(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *ADDED])
    return df.mapInArrow(combiner(text, key, run_bytes), schema).withColumn("_uid", F.concat_ws(":", F.spark_partition_id(), "_run"))


def exact_groups(df: DataFrame, text: str = "text", key: str = "doc_id", run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row for each row of df: key, keep_id, group_size, kept, text_sha256."""
    runs = written(_combined(identified(df, text, key=key), text, key, run_bytes).drop(text), "exact-runs")
    reps = runs.where("_rep").select(key, "_uid", "_n", "_hash", "_norm").repartition("_hash")
    verdicts = reps.mapInArrow(resolver(key, None, bucket_bytes), "_uid string, keep_id long, _winner string, group_size long")
    rows = runs.select(key, "_uid", "_rep", F.col("_sha").alias("text_sha256"))
    return rows.join(verdicts, "_uid").select(key, "keep_id", "group_size", (F.col("_rep") & (F.col("_winner") == F.col("_uid"))).alias("kept"), "text_sha256")


def deduplicated(df: DataFrame, text: str = "text", key: str = "doc_id", run_bytes: int = RUN_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of df that stay, with all their columns as they were."""
    held = [f"_own{k}" for k in range(len(df.columns))]  # own names can't clash with the working columns
    inner = df.toDF(*held).where(F.col(held[df.columns.index(key)]).isNotNull())
    inner_text, inner_key = (held[df.columns.index(c)] for c in (text, key))
    reps = _combined(inner, inner_text, inner_key, run_bytes).where("_rep").drop("_rep", "_sha", "_run").repartition("_hash")
    return reps.mapInArrow(resolver(inner_key, held, bucket_bytes), inner.schema).toDF(*df.columns)
