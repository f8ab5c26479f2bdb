"""Near-duplicate groups by b-bit MinHash.

Each document's distinct 5-word shingles are hashed, and PERMUTATIONS minima are taken in numpy, a batch of
documents at a time. Bands of ROWS full minima give candidate buckets; then only the low BITS of each
minimum are kept, packed into a few longs. Documents with equal sets are one node from then on; nodes have
numbers of their own, so that a doc_id that stands on two texts is two nodes.

A bucket's least node is its first hub: each member's pair with it is estimated from the packed bits (bit
counts of the XOR, corrected for chance collisions), and what reaches the estimate is confirmed on the full
shingle sets, each member's best pair first. Buckets that still hold several components get HUBS - 2 further
hubs, which meet the members outside the bucket's largest component. Of two members in different components at
least one is outside the largest, so in a bucket of fewer than HUBS members every pair has then been
confirmed, refused, or was within one component already.

Larger buckets that are still open (clouds of variants, of which some are similar to many and near enough to
none) are settled in blocks: open buckets that share members form clusters; the members outside a cluster's
largest component are its queries; a task holds the sets of one block of queries, streams one stripe of the
cluster's members past them, counts the shared shingles of all those pairs, and gives out the links that join
components. So nothing is capped, a group of n near copies costs about n confirmations, and pairs that come to
nothing never become rows. What grows with the square of a cluster is stated here: its members travel once for
each QUERY_SHINGLES of its queries' shingles, its queries once for each MEMBER_SHINGLES of its members'.

Facts about buckets, clusters, components and sets meet their rows by `spread`: keys with more than a fixed
share of all rows, of which there can only be a fixed number, by broadcast, and all others by a merge join. No
step gathers a bucket, a cluster, a component or a group of copies in one task.

Components come from contraction: each node hooks to its least neighbour, paths are halved, and the edges
between roots are the next round's graph. Links, labels and sets stay in distributed tables throughout.

A pair of similarity 0.75 shares no band with probability (1 - 0.75 ** 4) ** 32 = 5e-6, and its estimate is
five standard deviations above the estimate threshold.

Defined cases: null text, or text without words: no shingles, linked with nothing, kept; fewer words than
five: the whole sequence is the one shingle; rows without doc_id get no row; rows that repeat a doc_id each
get a row, in the component of their own text (whose component_id is the smallest doc_id in it); very long texts
are hashed alone in their batch; extra columns are unread, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from .common import LOWER, cut, identified, in_blocks, mixed, signed, small_batches, text_bytes, word_hashes, words, written

WIDTH = 5
PERCENT = 75
BANDS, ROWS, BITS = 32, 4, 4
PERMUTATIONS = BANDS * ROWS
#: Buckets of so many members are settled in blocks, if HUBS - 1 hubs haven't made one component of them.
HUBS = 8
#: Shingles of a block's queries, which its task holds, and of its members, which stream past them.
QUERY_SHINGLES, MEMBER_SHINGLES = 1 << 21, 1 << 23
#: Estimated similarity from which a candidate pair is confirmed on full sets.
ESTIMATE = 0.55

_odd = np.random.default_rng(7).integers(1, 1 << 31, (2, PERMUTATIONS), dtype=np.int64).astype(np.uint32)
MULTIPLIER, ADDEND = _odd[0] * np.uint32(2) + np.uint32(1), _odd[1]


def shingles(data: np.ndarray, ends: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash, document) of each document's distinct shingles, by document and hash."""
    data = LOWER[data]
    start, end, doc = words(data, ends)
    n = len(ends) - 1
    h = word_hashes(data, start, end)
    count = np.bincount(doc, minlength=n)
    first = np.cumsum(count) - count
    weight = [np.uint64((2 * k + 3) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) for k in range(width)]
    out, of = [], []
    m = len(h) - width + 1
    if m > 0:
        at = np.flatnonzero(doc[:m] == doc[width - 1 :])
        gram = np.zeros(len(at), np.uint64)
        for k in range(width):
            gram += mixed(h[at + k] * weight[k])
        out.append(mixed(gram))
        of.append(doc[at])
    for size in range(1, width):  # whole sequences of short documents
        short = np.flatnonzero(count == size)
        if len(short):
            gram = np.full(len(short), np.uint64(size * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
            for k in range(size):
                gram += mixed(h[first[short] + k] * weight[k])
            out.append(mixed(gram))
            of.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    gram, of = np.concatenate(out), np.concatenate(of)
    order = np.lexsort((gram, of))
    gram, of = gram[order], of[order]
    new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])])
    return gram[new], of[new]


def minima(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(documents, PERMUTATIONS) minima; first: where each document's shingles begin."""
    x = (gram >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(first), PERMUTATIONS), np.uint32)
    step = np.empty_like(x)
    for k in range(PERMUTATIONS):
        np.multiply(x, MULTIPLIER[k], out=step)
        np.add(step, ADDEND[k], out=step)
        out[:, k] = np.minimum.reduceat(step, first)
    return out


def packed(low: np.ndarray) -> np.ndarray:
    """(documents, PERMUTATIONS * BITS / 64) longs of the minima's low bits."""
    lanes = 64 // BITS
    x = (mixed(low.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).reshape(len(low), -1, lanes)
    return signed(np.bitwise_or.reduce(x << (np.arange(lanes, dtype=np.uint64) * np.uint64(BITS)), axis=2))


def band_keys(low: np.ndarray) -> np.ndarray:
    x = low.astype(np.uint64).reshape(len(low), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F), x.shape[:2]).copy()
    for k in range(ROWS):
        key = mixed(key ^ x[:, :, k])
    return signed(key)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_blocks(batches, 1 << 20):
        n = batch.num_rows
        gram, of = shingles(*text_bytes(batch.column(1)))
        size = np.bincount(of, minlength=n)
        has = np.flatnonzero(size)
        set_a, set_b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        counts = np.zeros(n, np.int32)
        sketch = bands = np.zeros((0, 1), np.int64)
        if len(has):
            first = (np.cumsum(size) - size)[has]
            set_a[has] = np.add.reduceat(mixed(gram + np.uint64(1)), first)
            set_b[has] = np.add.reduceat(mixed(gram ^ np.uint64(0xA5A5A5A5A5A5A5A5)), first)
            low = minima(gram, first)
            sketch, bands = packed(low), band_keys(low)
            counts[has] = 1

        def lists(x: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * np.int32(x.shape[1])), pa.array(x.ravel()))

        yield pa.RecordBatch.from_pydict(
            {"doc_id": batch.column(0), "text_hash": batch.column(2), "n_shingles": pa.array(size.astype(np.int64)), "set_a": pa.array(signed(set_a)), "set_b": pa.array(signed(set_b)), "sketch": lists(sketch), "bands": lists(bands)}
        )


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b, and both texts -> a, b of the pairs whose full sets are similar enough."""
    for batch in batches:
        at = 0
        sizes = np.diff(text_bytes(batch.column(2))[1]) + np.diff(text_bytes(batch.column(3))[1])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + (1 << 21), "right")) - 1)
            part = batch.slice(at, to - at)
            at = to
            (ga, da), (gb, db) = (shingles(*text_bytes(part.column(k))) for k in (2, 3))
            n = part.num_rows
            gram, of = np.concatenate([ga, gb]), np.concatenate([da, db])
            order = np.lexsort((gram, of))
            gram, of = gram[order], of[order]
            both = np.bincount(of[1:][(gram[1:] == gram[:-1]) & (of[1:] == of[:-1])], minlength=n)
            union = np.bincount(da, minlength=n) + np.bincount(db, minlength=n) - both
            good = pa.array((100 * both >= PERCENT * union) & (both > 0))
            yield pa.RecordBatch.from_arrays([part.column(0).filter(good), part.column(1).filter(good)], names=["a", "b"])


class _Block:
    """The shingle sets of a block's queries, and the links that members make with them."""

    def __init__(self, nodes: list[int], labels: list[int], texts: list[bytes]):
        self.nodes, self.labels = nodes, labels
        gram, of = shingles(*text_bytes(pa.array(texts, pa.binary())))
        self.size = np.bincount(of, minlength=len(nodes))
        order = np.argsort(gram, kind="stable")
        self.gram, self.of = gram[order], of[order]
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def links(self, nodes: list[int], labels: list[int], texts: pa.Array) -> Iterator[tuple[int, int]]:
        """The pairs of a query and one of these members that are similar and join two labels."""
        gram, of = shingles(*text_bytes(texts))
        size = np.bincount(of, minlength=len(nodes))
        low, high = np.searchsorted(self.gram, gram, "left"), np.searchsorted(self.gram, gram, "right")
        work = np.concatenate([[0], np.cumsum(high - low)])
        edges = np.concatenate([np.searchsorted(of, np.arange(len(nodes))), [len(of)]])
        at, queries = 0, len(self.nodes)
        while at < len(nodes):  # as many members at a time as shared shingles allow
            to = at + 1
            while to < len(nodes) and work[edges[to + 1]] - work[edges[at]] <= 1 << 21 and (to + 1 - at) * queries <= 1 << 21:
                to += 1
            a, b = edges[at], edges[to]
            n = (high - low)[a:b]
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[a:b], n)
            row = np.repeat(of[a:b] - at, n)
            both = np.bincount(row * queries + self.of[place], minlength=(to - at) * queries).reshape(to - at, -1)
            union = size[at:to][:, None] + self.size[None] - both
            for m, q in zip(*np.nonzero((100 * both >= PERCENT * union) & (both > 0)), strict=True):
                x, y = self.root(labels[at + m]), self.root(self.labels[q])
                if x != y:
                    self.parent[max(x, y)] = min(x, y)
                    yield min(nodes[at + m], self.nodes[q]), max(nodes[at + m], self.nodes[q])
            at = to


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cluster, m, q, member, node, label, text, sorted by the first four -> pairs a, b that join two labels.

    A block's queries come first and are held; its members stream past them."""
    here, block, held = None, None, ([], [], [])
    for batch in in_blocks(batches, 1 << 20):
        key = list(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True))
        member = np.array(batch.column(3).to_pylist(), np.int64)
        out: list[tuple[int, int]] = []
        cuts = [0, *(k for k in range(1, len(key)) if key[k] != key[k - 1] or member[k] != member[k - 1]), len(key)]
        for at, to in zip(cuts, cuts[1:], strict=False):
            if to == at:
                continue
            if key[at] != here:
                here, block, held = key[at], None, ([], [], [])
            part = batch.slice(at, to - at)
            nodes, labels = part.column(4).to_pylist(), part.column(5).to_pylist()
            if not member[at]:
                for own, new in zip(held, (nodes, labels, part.column(6).cast(pa.binary()).to_pylist()), strict=True):
                    own.extend(new)
            elif held[0]:
                if block is None:
                    block = _Block(*held)
                out += block.links(nodes, labels, part.column(6))
        yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def estimate(x: Column, y: Column) -> Column:
    """Similarity from two packed sketches: the share of agreeing lanes, corrected for chance agreement."""
    lanes = 64 // BITS
    mask = sum(1 << (BITS * k) for k in range(lanes))
    differing = F.lit(0)
    for k in range(PERMUTATIONS * BITS // 64):
        bits = x[k].bitwiseXOR(y[k])
        folded = bits
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(bits, s))
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(mask)))
    chance = 2.0**-BITS
    return ((1 - differing / float(PERMUTATIONS)) - chance) / (1 - chance)


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """df as a table of the shared folder, and its number of rows, in one job."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, seen.get["n"]


def mapped(df: DataFrame, column: str, hook: DataFrame, keep: bool) -> DataFrame:
    """df with `column` replaced by its root in hook; nodes without one stay or their rows go. The join is
    by merging, so that many small steps leave no broadcast tables on the driver."""
    to = hook.select(F.col("node").alias(column), F.col("root").alias("_root")).hint("merge")
    rest = [c for c in df.columns if c != column]
    return df.join(to, column, "left" if keep else "inner").select(*rest, F.coalesce("_root", column).alias(column))


def contracted(edges: DataFrame) -> list[DataFrame]:
    """Maps (node, root), to be applied one after another, that take each node of edges (a, b) to the least of its component."""
    edges, n = counted(edges.where("a <> b").distinct())
    hooks = []
    while n:
        both = edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
        hook = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        hook = cut(mapped(hook, "root", hook, False))
        hooks.append(hook)
        edges, n = counted(mapped(mapped(edges, "a", hook, False), "b", hook, False).where("a <> b").distinct())
    return hooks


def spread(rows: DataFrame, facts: DataFrame, keys: list[str], total: int) -> DataFrame:
    """rows with the facts of their keys; rows whose key has none go. facts: one row for each key, with n, the number
    of its rows; total: the number of all rows.

    Keys with more than one in 4 P of all rows, at most 4 P keys (P: shuffle partitions), are broadcast, so that their
    rows stay where they are; the rows of all other keys are joined by merging. Without such keys there is one join."""
    seen = Observation()
    facts = cut(facts.observe(seen, F.max("n").alias("most")))
    share = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if (seen.get["most"] or 0) * share <= total:
        return rows.join(facts.hint("merge"), keys)
    own = [c for c in facts.columns if c not in keys]
    heavy = facts.where(F.col("n") * share > total).select(*keys, F.struct(*own).alias("_heavy"))
    marked = rows.join(F.broadcast(heavy), keys, "left")
    light = marked.where("_heavy is null").drop("_heavy").join(facts.where(F.col("n") * share <= total).hint("merge"), keys)
    return marked.where("_heavy is not null").select(*rows.columns, "_heavy.*").unionByName(light)


class _Labels:
    """Component labels of the candidate nodes, and the confirmation of pairs."""

    def __init__(self, nodes: DataFrame, sketches: DataFrame, texts: DataFrame):
        self.labels = cut(nodes.select("node", F.col("node").alias("label")))
        self.sketches, self.texts = sketches, texts

    def side(self, c: str, what: DataFrame, value: str) -> DataFrame:
        return what.select(F.col("node").alias(c), F.col(value).alias(f"{value}_{c}")).hint("merge")

    def with_both(self, pairs: DataFrame, what: DataFrame, value: str) -> DataFrame:
        return pairs.join(self.side("a", what, value), "a").join(self.side("b", what, value), "b")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are not within one component."""
        return self.with_both(pairs, self.labels, "label").where("label_a <> label_b").drop("label_a", "label_b")

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose packed sketches are similar enough, with the estimate e."""
        both = self.with_both(pairs, self.sketches, "sketch")
        return both.select("a", "b", estimate(F.col("sketch_a"), F.col("sketch_b")).alias("e")).where(F.col("e") >= ESTIMATE)

    def confirm(self, pairs: DataFrame) -> None:
        """Joins the components of the pairs whose full sets are similar enough."""
        full = self.with_both(pairs.select("a", "b"), self.texts, "text").select("a", "b", "text_a", "text_b")
        self.join(full.mapInArrow(_confirmed, "a long, b long"))

    def join(self, links: DataFrame) -> None:
        """Makes one component of the components that each link connects."""
        links, n = counted(links)
        if n:
            by_label = self.with_both(links, self.labels, "label").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
            labels = self.labels
            for hook in contracted(by_label):
                labels = mapped(labels, "label", hook, True)
            self.labels = cut(labels)


    def opened(self, members: DataFrame) -> tuple[DataFrame, int]:
        """(bucket, first, node, label, major, n) of the buckets that hold several components, and how many rows."""
        labelled, total = counted(members.select("bucket", "first", "node").join(self.labels.hint("merge"), "node"))
        sizes = labelled.groupBy("bucket", "label").count().groupBy("bucket")
        facts = sizes.agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("major"), F.sum("count").alias("n"), F.count("*").alias("_k")).where("_k > 1").drop("_k")
        return counted(spread(labelled, facts, ["bucket"], total))

    def settle(self, members: DataFrame, sizes: DataFrame) -> None:
        """Confirms in blocks whatever pairs the buckets of `members` still hold. sizes: node, n_shingles."""
        placed = members.select("node").distinct().withColumn("cluster", F.col("node"))
        for hook in contracted(members.select(F.col("first").alias("a"), F.col("node").alias("b"))):
            placed = mapped(placed, "cluster", hook, True)
        placed, total = counted(placed.join(self.labels.hint("merge"), "node").join(sizes.hint("merge"), "node"))
        by_label = placed.groupBy("cluster", "label").agg(F.count("*").alias("_c"), F.sum("n_shingles").alias("_s"))
        facts = by_label.groupBy("cluster").agg(F.max(F.struct("_c", -F.col("label"), "label", "_s")).alias("_m"), F.sum("_c").alias("n"), F.sum("_s").alias("_s"))
        facts = facts.where("_s > _m._s").select("cluster", "n", F.col("_m.label").alias("major"), F.ceil((F.col("_s") - F.col("_m._s")) / QUERY_SHINGLES).cast("int").alias("qs"), F.ceil(F.col("_s") / MEMBER_SHINGLES).cast("int").alias("ms"))
        rows = spread(placed, facts, ["cluster"], total)
        hashed = lambda of: F.pmod(F.xxhash64("node"), F.col(of)).cast("int")
        every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
        as_member = rows.select("cluster", hashed("ms").alias("m"), every("qs").alias("q"), F.lit(1).alias("member"), "node", "label")
        as_query = rows.where("label <> major").select("cluster", every("ms").alias("m"), hashed("qs").alias("q"), F.lit(0).alias("member"), "node", "label")
        dealt = as_member.unionByName(as_query).join(self.texts.hint("merge"), "node").select("cluster", "m", "q", "member", "node", "label", "text")
        blocks = dealt.repartition("cluster", "m", "q").sortWithinPartitions("cluster", "m", "q", "member")
        self.join(blocks.mapInArrow(_block_links, "a long, b long"))


def _components(sets: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, label) of the nodes that share a bucket with another. See the module."""
    total = BANDS * sets.count()
    banded = sets.select("node", F.explode("bands").alias("bucket"))
    facts = banded.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    members, n = counted(spread(banded, facts, ["bucket"], total).select("bucket", "first", "node"))
    nodes = cut(members.select("node").distinct())
    texts = docs.join(sets.join(nodes, "node", "left_semi").select("node", "doc_id", "text_hash").hint("merge"), ["doc_id", "text_hash"])
    texts = written(texts.select("node", "text").dropDuplicates(["node"]), "near-texts")
    labels = _Labels(nodes, sets.select("node", "sketch").join(nodes, "node", "left_semi"), texts)
    if n:
        pairs, found = counted(labels.near(members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()))
        if found:
            labels.confirm(pairs.groupBy("b").agg(F.max_by("a", F.struct("e", -F.col("a"))).alias("a")))
            pairs, found = counted(labels.apart(pairs))
        if found:
            labels.confirm(pairs)
        members, n = labels.opened(members)
    if n:
        ranked = members.where("node <> first").withColumn("_r", F.row_number().over(Window.partitionBy("bucket").orderBy("node"))).where(F.col("_r") <= HUBS - 2)
        hubs = ranked.groupBy("bucket").agg(F.collect_list(F.struct("node", "label")).alias("_hubs"), F.first("n").alias("n"))
        met = spread(members.where("label <> major").drop("n"), hubs, ["bucket"], n).withColumn("_h", F.explode("_hubs")).where("label <> _h.label")
        pairs, found = counted(labels.near(met.select(F.least("node", "_h.node").alias("a"), F.greatest("node", "_h.node").alias("b")).distinct()))
        if found:
            labels.confirm(pairs)
        members, n = labels.opened(members.where(F.col("n") >= HUBS))
    if n:
        labels.settle(members, sets.select("node", "n_shingles"))
    return labels.labels


def _grouped(df: DataFrame, text: str, key: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, component for each row of df that has a key."""
    small_batches(df.sparkSession, 256)
    docs = identified(df, text, key=key).toDF("doc_id", "text").withColumn("text_hash", F.xxhash64("text"))
    fields = "doc_id long, text_hash long, n_shingles long, set_a long, set_b long, sketch array<long>, bands array<long>"
    sketched = written(docs.mapInArrow(_sketches, fields), "near-sketches")
    filled = sketched.where("n_shingles > 0")
    one = F.min(F.struct("doc_id", "text_hash", "n_shingles", "sketch", "bands")).alias("_m")
    sets = filled.groupBy("set_a", "set_b").agg(one, F.count("*").alias("n")).select("set_a", "set_b", "n", "_m.*")
    sets = written(sets.withColumn("node", F.monotonically_increasing_id()), "near-sets")
    labelled, found = counted(sets.select("node", "doc_id").join(_components(sets, docs).hint("merge"), "node"))
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component"), F.count("*").alias("n"))
    named = spread(labelled.select("node", "label"), least, ["label"], found).select("node", "component")
    facts = sets.select("node", "set_a", "set_b", "n", "doc_id").join(named.hint("merge"), "node", "left").select("set_a", "set_b", "n", F.coalesce("component", "doc_id").alias("component"))
    rows = sketched.select("doc_id", "text_hash", "n_shingles", "set_a", "set_b")
    with_set = spread(rows.where("n_shingles > 0"), facts, ["set_a", "set_b"], sketched.count())
    bare = rows.where("n_shingles = 0").withColumn("component", F.col("doc_id"))
    columns = ["doc_id", "text_hash", "n_shingles", "component"]
    return with_set.select(*columns).unionByName(bare.select(*columns))


def groups(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_shingles, component_id, kept for each row of df."""
    out = _grouped(df, text, key)
    return out.select(F.col("doc_id").alias(key), "n_shingles", F.col("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))


def deduplicated(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of df whose document stays, with df's columns."""
    kept = _grouped(df, text, key).where("doc_id = component").select(F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")).distinct()
    return df.join(kept, (df[key] == kept["_kept_id"]) & (F.xxhash64(df[text]) == kept["_kept_hash"]), "left_semi")
