"""URL filter lists held in a Bloom filter cascade: exact membership without a join.

The keys that a list may be asked about are finite: the host suffixes and path prefixes that occur in
the corpus. Level 1 encodes the listed keys; the corpus's other keys that it lets through (its false
positives, about as many as there are listed keys, because level 1 is sized for that) are encoded in
level 2; listed keys that level 2 lets through go into level 3, and so on until a level lets nothing
through. A key's answer is the parity of the first level that rejects it, which is exact for every key
of the corpus. Only the cascade travels to the executors; its size follows the list, not the corpus.

Defined cases: a null url or one without `://` has empty host and path, no rule and the verdict allow;
repeated rows each get a row; of rules of one length, the one with the longer host wins; of a very long host, only as
many labels are asked as a listed host has; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

#: (host, path prefix, verdict); the longest rule that fits wins.
RULES = (
    ("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"), ("org", "/es/", "block"),
)
#: The method's own list, also given in the README: families of hosts, under each of the tops that pages are served from.
BLOCKED_FAMILIES = ("spam-farm", "cheap-pills", "casino-win", "free-bets", "adult-x", "ads-track")
TOPS = ("com", "net", "org")
#: Hosts that are blocked with all their subdomains where no rule fits.
BLOCKED_HOSTS = tuple(f"{name}.example.{top}" for name in BLOCKED_FAMILIES for top in TOPS)

URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
UPPER = {c: c + 32 for c in range(65, 91)}


def host_and_path(url: str | None) -> tuple[str, str]:
    found = URL.search(url) if url else None
    return (found[1].translate(UPPER), found[2]) if found else ("", "")


def suffixes(host: str, most: int) -> Iterator[str]:
    """The host and the domains above it, as far as they have at most `most` labels: no listed host has more."""
    labels = host.rsplit(".", most)[-most:]
    for k in range(len(labels)):
        if found := ".".join(labels[k:]):
            yield found


def digests(keys: Iterable[str], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(k, seed=seed) for k in keys), np.uint64)


@dataclass
class Bloom:
    bits: np.ndarray
    probes: int
    seed: int

    @classmethod
    def of(cls, keys: list[str], rate: float, seed: int) -> Bloom:
        """Sized for a false positive rate over keys that it does not hold."""
        rate = min(max(rate, 1e-12), 0.5)
        m = 1 << max(6, math.ceil(math.log2(max(1.0, -len(keys) * math.log(rate) / math.log(2) ** 2))))
        out = cls(np.zeros(m, bool), max(1, round(-math.log2(rate))), seed)
        for at in out._places(digests(keys, seed)):
            out.bits[at] = True
        return out

    def _places(self, h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(self.probes):
            yield ((h + np.uint64(k) * step) & np.uint64(len(self.bits) - 1)).astype(np.int64)

    def passes(self, keys: list[str]) -> np.ndarray:
        h = digests(keys, self.seed)
        out = np.ones(len(h), bool)
        for at in self._places(h):
            out &= self.bits[at]
        return out


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    def contains(self, keys: list[str]) -> np.ndarray:
        """Exact for the listed keys and for every key of the universe that the cascade was built over."""
        out = np.zeros(len(keys), bool)
        open_ = np.arange(len(keys))
        for k, level in enumerate(self.levels):
            if not len(open_):
                break
            passed = level.passes([keys[i] for i in open_])
            open_ = open_[passed]
            out[open_] = k % 2 == 0
        return out


def build(listed: list[str], universe: DataFrame, bound: int | None = None) -> Cascade:
    """universe: one string column `key` with the corpus's distinct keys. What reaches the driver is what
    level 1 lets through: expected |listed|, held under `bound` by giving level 1 more bits."""
    listed = sorted(set(listed))
    if not listed:
        return Cascade()
    bound = bound or 1000 + 10 * len(listed)
    size = universe.count()
    rate, seed = len(listed) / max(size, 2 * len(listed)), 1
    known = frozenset(listed)
    while True:
        first = Bloom.of(listed, rate, seed)

        def through(batches: Iterator[pa.RecordBatch], first=first) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, p in zip(keys, first.passes(keys), strict=True) if p and k not in known], pa.string())})

        wrong = [r.key for r in universe.mapInArrow(through, "key string").limit(bound + 1).collect()]
        if len(wrong) <= bound:
            break
        rate, seed = rate / 16, seed + 1
    levels, inside, outside = [first], sorted(wrong), listed
    while inside:
        level = Bloom.of(inside, 0.5, seed + len(levels))
        levels.append(level)
        inside, outside = [k for k, p in zip(outside, level.passes(outside), strict=True) if p], inside
    return Cascade(levels)


def candidates(host: str, path: str, lengths: list[int], most: int) -> list[str]:
    """Each key that a list may hold about this url: a host above it, or such a host with a path prefix."""
    out = []
    for s in suffixes(host, most):
        out.append(f"host {s}")
        out += [f"rule {s}{path[:n]}" for n in lengths if n <= len(path)]
    return out


def judged(pages: DataFrame, key: str = "page_id", url: str = "url", rules: tuple = RULES, blocked_hosts: tuple = BLOCKED_HOSTS) -> DataFrame:
    """key, host, path, rule, verdict for each row of pages."""
    small_batches(pages.sparkSession, 10_000)
    lengths = sorted({len(p) for _, p, _ in rules})
    most = max([h.count(".") + 1 for h in (*(h for h, _, _ in rules), *blocked_hosts)] or [1])  # labels of the longest listed host
    verdicts = {f"rule {h}{p}": (f"{h}{p}", v) for h, p, v in rules}
    listed = [*verdicts, *(f"host {h}" for h in blocked_hosts)]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {k for u in set(batch.column(0).to_pylist()) for k in candidates(*host_and_path(u), lengths, most)}
            yield pa.RecordBatch.from_pydict({"key": pa.array(sorted(found), pa.string())})

    cascade = build(listed, written(pages.select(url).mapInArrow(keys, "key string").distinct(), "url-keys"))

    def verdict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column(1).to_pylist()]
            asked = [candidates(h, p, lengths, most) for h, p in parts]
            flat = [k for x in asked for k in x]
            found = cascade.contains(flat)
            at, rule, out = 0, [], []
            for own in asked:
                hits = [k for k, yes in zip(own, found[at : at + len(own)], strict=True) if yes]
                at += len(own)
                fits = [verdicts[k] for k in hits if k.startswith("rule ")]  # the cascade says which rules; here is what they say
                best = max(fits, key=lambda x: len(x[0]), default=None)
                rule.append(best and best[0])
                out.append(best[1] if best else "block" if hits else "allow")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.string()) for x in ([h for h, _ in parts], [p for _, p in parts], rule, out))],
                names=[key, "host", "path", "rule", "verdict"],
            )

    kind = dict(pages.dtypes)[key]
    return pages.select(F.col(key), F.col(url)).mapInArrow(verdict, f"`{key}` {kind}, host string, path string, rule string, verdict string")


