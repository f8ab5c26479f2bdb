"""Sharding by histogram sort.

Rows are sorted by (hash of the text, doc_id) without sorting them to find out where to cut: each round
counts the exact bytes below candidate key boundaries, in all partitions at once, for the key intervals
that still hold a cut, and splits those intervals finer. A cut stands when a boundary is within tolerance
of its target, or when its interval holds a single key. Then the rows are exchanged once. What a round
brings to the driver is bounded by the numbers of cuts and probes.

Equal texts have equal hashes, so copies lie together; a boundary inside a group of copies is only
probed (on doc_id) where a group is larger than the tolerance, so that a huge group is cut as well.

The law is `bytes`: shards are consecutive key ranges of near equal size.

Defined cases: null text has no bytes (size 16, crc32 of the empty string); rows without doc_id have no
place in the order and get no shard; rows with equal text and doc_id can't be told apart by the key and
share a shard; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, identified

SHARDS = 40
#: Hashes fall into coarse bins by all but their last COARSE bits: the probes of the first round.
COARSE = 54
#: Probes of each interval in later rounds, at least.
PROBES = 128
#: How far from its target a cut may be, as a share of a shard's size.
TOLERANCE = 0.002
#: Consecutive key ranges of a shard that are numbered apart, so that no task sorts a whole shard.
RANGES = 8

LOW, HIGH = -(1 << 63), (1 << 63) - 1

Key = tuple[int, int]  # (hash of the text, doc_id)


@dataclass(frozen=True)
class Interval:
    """Keys (h, d): with one h (`inner`) those with lo <= d <= hi, else those with lo <= h <= hi."""

    h: int | None
    lo: int
    hi: int
    below: int  # exact bytes of all keys before the interval

    @property
    def inner(self) -> bool:
        return self.h is not None

    def row(self, number: int) -> str:
        """As a row of SQL VALUES: coarse bin, number, inner, h, lo, hi, shift from keys to probes."""
        shift = max(0, (self.hi - self.lo).bit_length() - PROBES.bit_length() + 1)
        h = self.h if self.inner else self.lo
        return f"({h >> COARSE}L, {number}, {str(self.inner).lower()}, {_long(h)}, {_long(self.lo)}, {_long(self.hi)}, {shift})"


def _long(x: int) -> str:
    return f"cast('{x}' as bigint)"


def keyed(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, h: all that sharding needs, so that texts are read once."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = identified(df, text, key=key)
    return rows.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("h"))


def splitters(rows: DataFrame, shares: list[float], tolerance: float) -> tuple[list[Key], int]:
    """For each share of all bytes, the key before which that many bytes lie, within `tolerance` bytes; and the total."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    targets = [s * total for s in shares]
    found: dict[int, Key] = {}
    open_ = {Interval(None, LOW, HIGH, 0): list(range(len(targets)))} if total else {}
    first = True
    while open_:
        asked = list(open_)
        if first:
            probed = rows.select("h", "doc_id", "size", F.lit(0).alias("i"), F.shiftright("h", COARSE).alias("b"))
        else:
            table = rows.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(x.row(k) for k, x in enumerate(asked))} AS t(c, i, inner_, h_, lo, hi, shift)")
            probed = (
                rows.withColumn("c", F.shiftright("h", COARSE)).join(F.broadcast(table), "c")  # a row for each open cut at most
                .withColumn("x", F.expr("CASE WHEN inner_ THEN doc_id ELSE h END")).where("x BETWEEN lo AND hi AND (NOT inner_ OR h = h_)")
                .select("h", "doc_id", "size", "i", F.expr("shiftright(x, shift) - shiftright(lo, shift)").alias("b"))
            )
        counted = (
            probed.groupBy("i", "b")
            .agg(F.sum("size").alias("bytes"), F.min("h").alias("h0"), F.max("h").alias("h1"), F.min("doc_id").alias("d0"), F.max("doc_id").alias("d1"))
            .collect()
        )
        first = False
        finer: dict[Interval, list[int]] = {}
        of: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: r.b):
            of.setdefault(r.i, []).append(r)
        for k, interval in enumerate(asked):
            bins = of.get(k, [])
            below = [interval.below]
            for r in bins:
                below.append(below[-1] + r.bytes)
            for t in open_[interval]:
                at = max(0, min(len(bins) - 1, bisect_right(below, targets[t]) - 1))
                near, left, right = bins[at], below[at], below[at + 1]
                # the boundary before this bin or the one after it, if near enough; or nothing finer is left
                choice = at if targets[t] - left <= right - targets[t] else at + 1
                single = near.h0 == near.h1 and near.d0 == near.d1
                if single or abs(below[choice] - targets[t]) <= tolerance:
                    found[t] = (bins[choice].h0, bins[choice].d0 if interval.inner or bins[choice].h0 == bins[choice].h1 else LOW) if choice < len(bins) else _after(interval, near)
                elif near.h0 == near.h1:
                    finer.setdefault(Interval(near.h0, near.d0, near.d1, left), []).append(t)
                else:
                    finer.setdefault(Interval(None, near.h0, near.h1, left), []).append(t)
        open_ = finer
    return [found.get(t, (HIGH, HIGH)) for t in range(len(targets))], total


def _after(interval: Interval, last) -> Key:
    """The first key after a bin that ends its interval."""
    if interval.inner or last.h0 == last.h1:
        return (last.h1, last.d1 + 1) if last.d1 < HIGH else (last.h1 + 1, LOW)
    return (last.h1 + 1, LOW) if last.h1 < HIGH else (HIGH, HIGH)


def with_ranges(rows: DataFrame, cuts: list[Key]) -> DataFrame:
    """rows with `_range`, how many cuts are at or before the row's key. Each coarse bin of hashes knows the
    cuts before it and those inside it; that table has one row for each of the 2 ** (64 - COARSE) bins."""
    inside: dict[int, list[Key]] = {}
    for h, d in cuts:
        inside.setdefault(h >> COARSE, []).append((h, d))
    lines, before = [], 0
    for c in range(LOW >> COARSE, (HIGH >> COARSE) + 1):
        own = inside.get(c, [])
        held = ", ".join(f"named_struct('h', {_long(h)}, 'd', {_long(d)})" for h, d in own)
        lines.append(f"({c}L, {before}, " + (f"array({held}))" if own else "cast(array() as array<struct<h: bigint, d: bigint>>))"))
        before += len(own)
    table = rows.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS t(c, n, cuts)")
    passed = F.size(F.filter("cuts", lambda x: (x.h < F.col("h")) | ((x.h == F.col("h")) & (x.d <= F.col("doc_id")))))
    return rows.withColumn("c", F.shiftright("h", COARSE)).join(F.broadcast(table), "c").withColumn("_range", (F.col("n") + passed).cast("int")).drop("c", "n", "cuts")


def sharded(df: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id", ranges: int = RANGES, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is not `key`)."""
    rows = cut(keyed(df, text, key))
    parts = shards * ranges
    shares = [k / parts for k in range(1, parts)]
    cuts, total = splitters(rows, shares, tolerance * (rows.agg(F.sum("size")).first()[0] or 0) / shards)
    cuts = sorted(cuts)
    placed = with_ranges(rows, cuts)
    counted = {r[0]: r[1] for r in placed.groupBy("_range").count().collect()}  # at most shards * ranges rows
    first, offsets = 0, []
    for k in range(parts):
        first = 0 if k % ranges == 0 else first
        offsets.append(first)
        first += counted.get(k, 0)
    offset = F.element_at(F.array(*map(F.lit, offsets)), F.col("_range") + 1)
    order = Window.partitionBy("_range").orderBy("h", "doc_id")
    return placed.select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), F.expr(f"cast(_range div {ranges} as int)").alias("shard"),
        (F.row_number().over(order) - 1 + offset).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
