"""Temperature mixing of sources to target weights.

Each source's share of all tokens is raised to an exponent and normalised. The exponent is bisected: the
flattest mixture (smallest exponent) whose entropy stays at or under a target, or in which no source is
repeated more often than a limit. The budget is either given in tokens or, by default, the least one
with which every source gets a full pass, so that mixing repeats documents but drops none.

A weight becomes whole passes over its source plus one partial pass. Every pass visits the source's blocks
(documents dealt by hash, about BLOCK_TOKENS each) in the order of a permutation drawn for that pass; the
partial pass takes blocks in that order, and documents of its last block in a hashed order, until the
source's token budget is met to the nearest document. The partial pass comes down to one boundary for
each source, so a document's passes follow from its own row and a table with one row for each source:
nothing is joined or exchanged to apply the mixture.

Defined cases: null source is a source of its own; null or empty text has no tokens and takes part in the
whole passes of its source, as do sources without any token (one pass); rows without doc_id get no row;
repeated rows are mixed as separate documents; a very long text makes its block that much larger; extra columns
are unread (`mixed_documents` carries them), whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_TOKENS = 1 << 18
REPETITION_LIMIT = 1.5
SEED = 20
#: What reaches the driver is one row for each source; more sources than this are refused.
MOST_SOURCES = 10_000
#: Bits of a block's place that its bin leaves out: a source has at most 2 ** (64 - COARSE) bins.
COARSE = 50


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(shares: list[float], exponent: float) -> list[float]:
    raised = [p**exponent if p > 0 else 0.0 for p in shares]
    return [x / sum(raised) for x in raised]


def repetitions(shares: list[float], weights: list[float], budget: float | None) -> list[float]:
    """Passes over each source; budget is in multiples of all tokens, None: the least with a full pass each."""
    budget = max(p / w for p, w in zip(shares, weights, strict=True) if p > 0) if budget is None else budget
    return [w * budget / p if p > 0 else 1.0 for p, w in zip(shares, weights, strict=True)]


def bisected(shares: list[float], target_entropy: float | None, limit: float | None, budget: float | None, rounds: int = 60) -> float:
    """The smallest exponent in [0, 1] that meets the target entropy and the repetition limit; 1 if none does."""

    def met(exponent: float) -> bool:
        w = tempered(shares, exponent)
        return (target_entropy is None or entropy(w) <= target_entropy) and (limit is None or max(repetitions(shares, w, budget)) <= limit)

    if met(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(rounds):
        mid = (low + high) / 2
        low, high = (low, mid) if met(mid) else (mid, high)
    return high


@dataclass(frozen=True)
class Share:
    """One source's part of the mixture: whole passes, and the boundary of the partial pass."""

    source: str  # as source_key() gives it
    tokens: int
    blocks: int
    weight: float
    passes: int
    rest: int  # tokens of the partial pass
    block: int | None = None  # order hash of its last block
    doc: int | None = None  # order hash of the last document in that block
    doc_id: int | None = None


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`: the token measure of the mixture."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _values(shares: list[Share], spark) -> DataFrame:
    def cell(x) -> str:
        if x is None:
            return "cast(null as bigint)"
        if isinstance(x, str):
            return f"cast(X'{x.encode().hex()}' as string)"
        return f"cast('{x}' as {'double' if isinstance(x, float) else 'bigint'})"

    rows = ", ".join("(" + ", ".join(map(cell, (s.source, s.blocks, s.weight, s.passes, s.rest, s.block, s.doc, s.doc_id))) + ")" for s in shares)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(_source, _blocks, _weight, _passes, _rest, _last_block, _last_doc, _last_id)")


def _placed(rows: DataFrame, shares: list[Share], key: str, seed: int) -> DataFrame:
    """rows (with _source) and its source's share, its place in block and document order of the partial pass."""
    joined = rows.join(F.broadcast(_values(shares, rows.sparkSession)), "_source")  # at most MOST_SOURCES rows
    block = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.col("_blocks"))
    return joined.withColumn("_block", block).withColumn("_block_order", F.xxhash64("_block", "_source", F.lit(seed + 1))).withColumn("_doc_order", F.xxhash64(F.col(key), F.lit(seed + 2)))


def planned(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", target_entropy: float | None = None,
            repetition_limit: float | None = REPETITION_LIMIT, budget_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> list[Share]:
    """The mixture of df's sources."""
    rows = cut(df.where(F.col(key).isNotNull()).select(F.col(key).alias("doc_id"), source_key(F.col(source)).alias("_source"), word_count(F.col(text)).alias("n_tokens")))
    totals = rows.groupBy("_source").agg(F.sum("n_tokens").alias("n")).orderBy("_source").limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    total = sum(r.n for r in totals)
    if not totals:
        return []
    parts = [r.n / total if total else 0.0 for r in totals]
    budget = budget_tokens / total if budget_tokens is not None and total else None
    weights = tempered(parts, bisected(parts, target_entropy, repetition_limit, budget)) if total else [1 / len(parts)] * len(parts)
    often = repetitions(parts, weights, budget) if total else [1.0] * len(parts)
    shares = [
        Share(r._source, r.n, max(1, -(-r.n // block_tokens)), w, (whole := int(x + 1e-9)), max(0, round((x - whole) * r.n)))
        for r, w, x in zip(totals, weights, often, strict=True)
    ]
    placed = _placed(rows, shares, "doc_id", seed).where("_rest > 0")
    bins = crossed(placed.withColumn("_bin", F.shiftright("_block_order", COARSE)), "_bin", {})  # at most 2 ** (64 - COARSE) a source
    inner = placed.where(F.shiftright("_block_order", COARSE) == _of_source({s: b for s, (b, _) in bins.items()})) if bins else placed
    last = crossed(inner, "_block_order", {s: n for s, (_, n) in bins.items()})
    shares = [Share(*_fields(s)[:6], *((last[s.source][0], None, None) if s.source in last else (None, None, None))) for s in shares]
    inside = _placed(rows, shares, "doc_id", seed).where("_block_order = _last_block")
    before = F.create_map(*[x for s, (_, n) in last.items() for x in (F.lit(s), F.lit(n))]) if last else None
    if before is not None:
        docs = inside.withColumn("upto", F.sum("n_tokens").over(Window.partitionBy("_source").orderBy("_doc_order", "doc_id")) + before[F.col("_source")])
        near = docs.where("2 * upto - n_tokens <= 2 * _rest").groupBy("_source").agg(F.max(F.struct("_doc_order", "doc_id")).alias("d"))
        ends = {r._source: (r.d._doc_order, r.d.doc_id) for r in near.collect()}
        shares = [Share(*_fields(s)[:7], *ends.get(s.source, (None, None))) for s in shares]
    return shares


def _of_source(values: dict[str, int]) -> Column:
    return F.try_element_at(F.create_map(*[x for s, v in values.items() for x in (F.lit(s), F.lit(v).cast("long"))]), F.col("_source"))


def crossed(placed: DataFrame, unit: str, before: dict[str, int]) -> dict[str, tuple[int, int]]:
    """For each source, the first unit (in order) up to which at least `_rest` tokens lie, and the tokens before it;
    `before`: tokens that lie before all of placed's units."""
    start = F.coalesce(_of_source(before), F.lit(0)) if before else F.lit(0)
    units = placed.groupBy("_source", unit, "_rest").agg(F.sum("n_tokens").alias("n"))
    upto = units.withColumn("upto", F.sum("n").over(Window.partitionBy("_source").orderBy(unit)) + start)
    first = upto.where("upto >= _rest").groupBy("_source").agg(F.min(F.struct("upto", unit, "n")).alias("b"))
    return {r._source: (r.b[unit], r.b.upto - r.b.n) for r in first.collect()}


def _fields(s: Share) -> tuple:
    return (s.source, s.tokens, s.blocks, s.weight, s.passes, s.rest, s.block, s.doc, s.doc_id)


_IN_PARTIAL = """_last_block IS NOT NULL AND (_block_order < _last_block OR _block_order = _last_block AND _last_doc IS NOT NULL
    AND (_doc_order < _last_doc OR _doc_order = _last_doc AND {key} <= _last_id))"""


def applied(df: DataFrame, shares: list[Share], source: str = "source", key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """df's rows, each as often as the mixture says, with _epoch, _weight, _block_order of the epoch and _position."""
    if not shares:
        return df.limit(0).selectExpr("*", "0 AS _epoch", "0D AS _weight", "0L AS _block_order", "0L AS _position")
    placed = _placed(df.where(F.col(key).isNotNull()).withColumn("_source", source_key(F.col(source))), shares, key, seed)
    often = F.expr(f"int(_passes) + int({_IN_PARTIAL.format(key=key)})")
    out = placed.withColumn("_often", often).where("_often > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("_often") - 1)))
    # the partial pass is the last epoch and keeps the order that its boundary was found in
    partial = F.col("_epoch") == F.col("_passes")
    out = out.withColumn("_block_order", F.when(partial, F.col("_block_order")).otherwise(F.xxhash64("_block", "_source", F.lit(seed + 1), "_epoch")))
    out = out.withColumn("_position", F.when(partial, F.col("_doc_order")).otherwise(F.xxhash64(F.col(key), F.lit(seed + 2), "_epoch")))
    return out.select(*df.columns, "_epoch", "_weight", "_block_order", "_position")


def mixed_rows(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **plan) -> DataFrame:
    """One row for each visit: key, source, n_tokens, epoch, weight, block_order, position (sort by the last three of
    epoch, block_order, position for the training order)."""
    df = df.select(key, text, source)
    rows = applied(df, planned(df, text, source, key, **plan), source, key)
    return rows.select(key, source, word_count(F.col(text)).alias("n_tokens"), F.col("_epoch").alias("epoch"), F.col("_weight").alias("weight"), F.col("_block_order").alias("block_order"), F.col("_position").alias("position"))


def mixed_documents(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", **plan) -> DataFrame:
    """df's rows as often as the mixture visits them, with df's columns."""
    own = [f"_own{k}" for k in range(len(df.columns))]
    inner = df.toDF(*own)
    t, s, k = (own[df.columns.index(c)] for c in (text, source, key))
    return applied(inner, planned(inner, t, s, k, **plan), s, k).select(*own).toDF(*df.columns)
