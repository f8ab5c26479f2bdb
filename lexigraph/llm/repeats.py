"""Removal of repeated byte strings with a logarithmic family of suffix arrays.

Every byte covered by a LENGTH-byte string that also starts in a document with a smaller doc_id is removed.

Texts are dealt to parts of about PART_BYTES by a hash of their id, in one exchange that all passes read.
1. Each part finds its strings' content keys (see anchors) and sends each distinct key once, packed, with the
   number of its documents that have it.
2. Each key bucket answers which keys occur in two documents or more; all other strings are unrepeated.
3. Each part sends the segments that have such keys, equal segments once, to the bucket of their key. A
   segment that a smaller document of the part has too is settled there. Keys of over `hot` documents would
   fill one bucket (the edges of a widely shared passage differ in every document): their segments fall into
   single strings, which are dealt by the string.
4. Each bucket takes its segments in order of doc_id, in batches. A batch gets a suffix array (the places of
   its LENGTH-byte strings in sorted order, with their smallest document), is merge-scanned against every
   level of the index family, and enters it as a new level; levels of equal size merge, so there are
   logarithmically many.
5. Each part joins the removed spans of its texts and cuts them out.

A passage that a third of all documents share sends one segment for each part, not for each document.
Messages between n parts and n buckets go in hops: one message for each of RADIX ranges of destinations, split
further by tasks that gather RADIX senders of one range. That is at most RADIX messages a part and hop, whatever
n is; each hop writes what it carries once more.
Comparison is on complete strings; hashes only deal them out and rule strings out.

Defined cases: null text counts as empty; a text shorter than LENGTH bytes loses nothing; rows without
doc_id get no row; rows with the same doc_id are not smaller than each other; a very long text makes its part that much larger and is
keyed as a block of its own; extra columns are unread, whatever their names; an empty table, empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import segments
from .common import identified, small_batches

LENGTH = 50
PART_BYTES = 8 << 20
BLOCK_BYTES = 1 << 20
#: Strings that a batch of the index family holds, at least.
BATCH = 1 << 17
#: Strings of a level that a scan or merge holds at once.
STEP = 1 << 16
#: Ranges of destinations that a task sends messages to: one hop up to 64 GiB of text, two up to 512 TiB.
RADIX = 1 << 13
#: Documents beyond which a key's segments are dealt string by string.
HOT = 1 << 14
NOWHERE = np.iinfo(np.int64).max


def _pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays of any lengths as one compressed blob; columns of equal bytes lie together."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4))
        out.append(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) else b"")
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpack(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    at, out = 4, []
    for _ in range(int.from_bytes(raw[:4], "little")):
        n, kind = int.from_bytes(raw[at : at + 8], "little"), np.dtype(raw[at + 8 : at + 12].decode().strip())
        at += 12
        size = n * kind.itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += size
    return out


def _ordered(part: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(ids, bytes, ends) of a part's texts in order of doc_id and text; a row's place in it is its number."""
    texts = part.column("body").to_pylist()
    ids = part.column("doc_id").to_pylist()
    order = sorted(range(len(ids)), key=lambda k: (ids[k], texts[k] or b""))
    body = [texts[k] or b"" for k in order]
    ends = np.concatenate([[0], np.cumsum([len(b) for b in body])]).astype(np.int64)
    return [ids[k] for k in order], np.frombuffer(b"".join(body), np.uint8), ends


def _blocks(ends: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    at, n = 0, len(ends) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, to
        at = to


def _keyed(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(48-bit key, row, first, last) of the segments of each block of rows; places are within the row."""
    for a, b in _blocks(ends):
        key, row, first, last = segments(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], LENGTH)
        base = ends[a : b + 1][row] - ends[a]
        yield key >> np.uint64(16), row + a, first - base, last - base


# ---- messages: rows of integer columns, the first of them the destination ------------------------------

MESSAGE = "at long, via long, payload binary"
#: For each column of a message: None, or the column that holds the lengths of its lists.
KEYS = (None, None, None, None)  # bucket, part, key, documents
SHARED = (None, None, None)  # part, key, hot
SEGMENTS = (None, None, None, None, 3, 3, None, 6)  # bucket, part, doc, number of places, rows, places, size, bytes
SPANS = (None, None, None, None)  # part, row, start, end


def _joined(table: pa.Table, columns: int) -> list[np.ndarray]:
    sent = [_unpack(x) for x in table.column("payload").to_pylist()]
    return [np.concatenate(x) for x in zip(*sent, strict=True)] if sent else [np.zeros(0, np.int64)] * columns


def _taken(arrays: list[np.ndarray], lists: tuple, order: np.ndarray) -> list[np.ndarray]:
    """The rows of `order`, with their lists."""
    out = []
    for a, by in zip(arrays, lists, strict=True):
        if by is None:
            out.append(a[order])
        else:
            n = arrays[by].astype(np.int64)
            m = n[order]
            out.append(a[np.repeat((np.cumsum(n) - n)[order] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))])
    return out


def _messages(arrays: list[np.ndarray], lists: tuple, width: int, via: int) -> pa.Table:
    """One message for each range of `width` destinations that rows go to."""
    at = arrays[0].astype(np.int64) // width
    order = np.argsort(at, kind="stable")
    arrays, at = _taken(arrays, lists, order), at[order]
    cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]])) if len(at) else np.zeros(1, np.int64)
    ends = [None if by is None else np.concatenate([[0], np.cumsum(arrays[by], dtype=np.int64)]) for by in lists]
    out = [_pack(*(a[i:j] if e is None else a[e[i] : e[j]] for a, e in zip(arrays, ends, strict=True))) for i, j in zip(cuts, cuts[1:], strict=False)]
    return pa.table({"at": pa.array(at[cuts[:-1]], pa.int64()), "via": pa.array([via] * len(out), pa.int64()), "payload": pa.array(out, pa.binary())})


def _first_width(n: int, radix: int) -> int:
    width = 1
    while width * radix < n:
        width *= radix
    return width


def _routed(sent: DataFrame, lists: tuple, n: int, radix: int) -> DataFrame:
    """Messages to ranges of destinations as messages to single ones (`at`), `radix` at most to each."""

    def hop(width: int):
        def split(messages: pa.Table) -> pa.Table:
            return _messages(_joined(messages, len(lists)), lists, width, messages.column("via")[0].as_py() // radix)

        return split

    width = _first_width(n, radix)
    while width > 1:
        width //= radix
        sent = sent.groupBy("at", "via").applyInArrow(hop(width), MESSAGE)
    return sent


# ---- passes ---------------------------------------------------------------------------------------------

def _keys_of_part(n: int, radix: int):
    def keys(part: pa.Table) -> pa.Table:
        ids, data, ends = _ordered(part)
        doc = np.unique(np.array(ids, np.int64), return_inverse=True)[1].astype(np.int64)
        key, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for k, row, _, _ in _keyed(data, ends):
            k, d = _distinct(k, doc[row])
            key.append(k)
            of.append(d)
        key, _ = _distinct(np.concatenate(key), np.concatenate(of))
        key, documents = np.unique(key, return_counts=True)
        me = part.column("part")[0].as_py()
        bucket = (key % np.uint64(n)).astype(np.int32)
        return _messages([bucket, np.full(len(key), me, np.int32), key // np.uint64(n), documents.astype(np.int32)], KEYS, _first_width(n, radix), me // radix)

    return keys


def _distinct(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]) if len(key) else np.zeros(0, bool)
    return key[new], doc[new]


def _shared_keys(n: int, radix: int, hot: int):
    """Which of its keys each part shares with another document."""

    def answer(messages: pa.Table) -> pa.Table:
        to, part, key, documents = _joined(messages, len(KEYS))
        value, back = np.unique(key, return_inverse=True)
        total = np.zeros(len(value), np.int64)
        np.add.at(total, back, documents)
        total = total[back]
        own = np.flatnonzero(total > 1)
        return _messages([part[own], key[own] * np.uint64(n) + to[own].astype(np.uint64), (total[own] > hot).astype(np.uint8)], SHARED, _first_width(n, radix), int(to[0]) // radix)

    return answer


class Spans:
    """Removed spans (row, start, end), merged as they come."""

    def __init__(self):
        self.row, self.start, self.end = [], [], []

    def add(self, row: int, start: int, end: int) -> None:
        if self.row and self.row[-1] == row and self.start[-1] <= start <= self.end[-1]:
            self.end[-1] = max(self.end[-1], end)
        else:
            self.row.append(row)
            self.start.append(start)
            self.end.append(end)


def _segments_of_part(n: int, radix: int):
    """A row without bytes is a span that the part has settled; its `doc` is the span's end."""

    def send(part: pa.Table, shared: pa.Table) -> pa.Table:
        own_to, own_doc, own_body, places, local, me = [], [], [], [], Spans(), 0
        if part.num_rows and shared.num_rows:
            me = part.column("part")[0].as_py()
            ids, data, ends = _ordered(part)
            _, known, hot = _joined(shared, len(SHARED))
            order = np.argsort(known)
            known, hot = known[order], hot[order]
            raw = data.tobytes()
            seen: dict[bytes, tuple[int, int]] = {}  # segment: id of its first document, its number

            def put(to: int, r: int, p: int, body: bytes) -> None:
                found = seen.get(body)
                if found is None:
                    seen[body] = (ids[r], len(own_to))
                    own_to.append(to)
                    own_doc.append(ids[r])
                    own_body.append(body)
                    places.append([(r, p)])
                elif found[0] < ids[r]:
                    local.add(r, p, p + len(body))
                else:
                    places[found[1]].append((r, p))

            for key, row, first, last in _keyed(data, ends):
                at = np.searchsorted(known, key)
                at[at == len(known)] = 0
                hit = np.flatnonzero(known[at] == key)
                to = (key[hit] % np.uint64(n)).astype(np.int64)
                for t, r, p, size, split in zip(to.tolist(), row[hit].tolist(), first[hit].tolist(), (last[hit] - first[hit] + LENGTH).tolist(), hot[at[hit]].tolist(), strict=True):
                    a = int(ends[r]) + p
                    if split:
                        for k in range(size - LENGTH + 1):
                            body = raw[a + k : a + k + LENGTH]
                            put(zlib.crc32(body) % n, r, p + k, body)
                    else:
                        put(t, r, p, raw[a : a + size])
        k, flat = len(local.row), [x for own in places for x in own]
        arrays = [
            np.array(own_to + [me] * k, np.int32),
            np.full(len(own_to) + k, me, np.int32),
            np.array(own_doc + local.end, np.int64),
            np.array([len(own) for own in places] + [1] * k, np.int32),
            np.array([r for r, _ in flat] + local.row, np.int32),
            np.array([p for _, p in flat] + local.start, np.int32),
            np.array([len(body) for body in own_body] + [0] * k, np.int32),
            np.frombuffer(b"".join(own_body), np.uint8),
        ]
        return _messages(arrays, SEGMENTS, _first_width(n, radix), me // radix)

    return send


class Level:
    """A suffix array cut at LENGTH bytes: the places in `text` of distinct strings, in order of the strings, each
    with its smallest document."""

    def __init__(self, text: np.ndarray, place: np.ndarray, doc: np.ndarray):
        self.text, self.place, self.doc = text, place.astype(np.int32 if len(text) < 1 << 31 else np.int64, copy=False), doc

    @classmethod
    def of(cls, text: np.ndarray, place: np.ndarray, doc: np.ndarray) -> tuple[Level, np.ndarray]:
        """The level of the strings at some places whose documents ascend (of equal strings the first has the
        smallest), and each one's number in it."""
        strings = _strings(text, place)
        order = np.argsort(strings, kind="stable")
        strings = strings[order]
        new = np.concatenate([[True], strings[1:] != strings[:-1]]) if len(strings) else np.zeros(0, bool)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return cls(text, place[order][new], doc[order][new]), number

    def __len__(self) -> int:
        return len(self.place)

    def strings(self, first: int = 0, last: int | None = None) -> np.ndarray:
        return _strings(self.text, self.place[first:last])

    def kept(self, which: np.ndarray) -> Level:
        return Level(self.text, self.place[which], self.doc[which])

    def scan(self, strings: np.ndarray, low: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(place in this level, whether it stands there) of each of some strings in order, from `low` on: a merge
        scan, both sides moving on block by block."""
        at, same, done = np.full(len(strings), len(self), np.int64), np.zeros(len(strings), bool), 0
        while low < len(self) and done < len(strings):
            block = self.strings(low, low + STEP)
            to = done + int(np.searchsorted(strings[done:], block[-1], "right"))
            k = np.searchsorted(block, strings[done:to])
            at[done:to] = low + k
            same[done:to] = block[k] == strings[done:to]
            low, done = low + STEP, to
        return at, same

    def merged(self, other: Level) -> Level:
        """Both levels as one; they have no string in common."""
        at, low = [np.zeros(0, np.int64)], 0
        for a in range(0, len(other), STEP):
            at.append(self.scan(other.strings(a, a + STEP), low)[0])
            low = int(at[-1][-1])
        at = np.concatenate(at)
        place = other.place.astype(np.int64) + len(self.text)
        return Level(np.concatenate([self.text, other.text]), np.insert(self.place.astype(np.int64), at, place), np.insert(self.doc, at, other.doc))


class IndexFamily:
    """Levels of at least doubling size; documents arrive in ascending order."""

    def __init__(self):
        self.levels: list[Level] = []

    def meet(self, batch: Level) -> np.ndarray:
        """Each string's smallest document so far; the batch's new strings enter as a level of their own."""
        known, strings = np.full(len(batch), NOWHERE), batch.strings()
        for level in self.levels:
            at, same = level.scan(strings)
            known[same] = np.minimum(known[same], level.doc[at[same]])
        new = known == NOWHERE
        if new.any():
            self.levels.append(batch.kept(new))
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            self.levels.append(a.merged(b))
        return np.minimum(known, batch.doc)


def _strings(text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The LENGTH-byte strings at some places, as fixed-width byte strings (equal lengths, so padding can't confuse)."""
    return np.ndarray((len(text) - LENGTH + 1,), f"S{LENGTH}", text, 0, (1,))[place] if len(place) else np.zeros(0, f"S{LENGTH}")


def repeated(docs: np.ndarray, sizes: np.ndarray, body: np.ndarray, batch: int = BATCH) -> np.ndarray:
    """For segments in ascending order of document (bodies one after another), a flag for each string in turn:
    whether a smaller document has it."""
    n = sizes - LENGTH + 1
    flags = np.zeros(int(n.sum()), bool)
    ends, begin = np.cumsum(n), np.cumsum(sizes) - sizes
    family, at = IndexFamily(), 0
    while at < len(docs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + batch, "right")))
        while to < len(docs) and docs[to] == docs[to - 1]:  # a document's strings enter together
            to += 1
        m = n[at:to]
        low = ends[at] - n[at]
        which = np.repeat(np.arange(at, to), m)
        start = np.arange(len(which)) - np.repeat(np.cumsum(m) - m, m) + (begin[which] - begin[at])
        level, number = Level.of(body[begin[at] : begin[to - 1] + sizes[to - 1]], start, docs[which])
        flags[low : low + len(which)] = family.meet(level)[number] < docs[which]
        at = to
    return flags


def _repeats_of_bucket(n: int, radix: int):
    def find(messages: pa.Table) -> pa.Table:
        rows = _joined(messages, len(SEGMENTS))
        me = int(rows[0][0])
        settled = np.flatnonzero(rows[6] == 0)
        _, own, end, _, own_row, own_start, _, _ = _taken(rows, SEGMENTS, settled)
        order = np.flatnonzero(rows[6])
        _, part, doc, count, row, place, size, body = _taken(rows, SEGMENTS, order[np.argsort(rows[2][order], kind="stable")])
        del rows
        size, count = size.astype(np.int64), count.astype(np.int64)
        flags = repeated(doc, size, body)
        m = size - LENGTH + 1
        begin = np.cumsum(m) - m
        before, after = np.concatenate([[False], flags[:-1]])[: len(flags)], np.concatenate([flags[1:], [False]])[: len(flags)]
        before[begin] = False
        after[begin + m - 1] = False
        first, last = np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after)
        segment = np.searchsorted(begin, first, "right") - 1
        first, last = first - begin[segment], last - begin[segment] + LENGTH
        k, held = count[segment], np.cumsum(count) - count
        run = np.repeat(np.arange(len(segment)), k)
        at = np.repeat(held[segment] - (np.cumsum(k) - k), k) + np.arange(len(run))
        spans = [np.concatenate(x).astype(np.int32) for x in ((own, part[segment][run]), (own_row, row[at]), (own_start, place[at] + first[run]), (end, place[at] + last[run]))]
        return _messages(_taken(spans, SPANS, np.lexsort((spans[2], spans[1], spans[0]))), SPANS, _first_width(n, radix), me // radix)

    return find


def _cut_part(texts: bool):
    def cut(part: pa.Table, spans: pa.Table) -> pa.Table:
        if not part.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "n_spans": pa.array([], pa.int64()), "kept": pa.array([], pa.binary())})
        ids, data, ends = _ordered(part)
        _, row, start, end = (a.astype(np.int64) for a in _joined(spans, len(SPANS)))
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, ends[row] + start, 1)
        np.add.at(edge, ends[row] + end, -1)
        gone = np.cumsum(edge[:-1]) > 0
        n_removed, n_spans, kept = [], [], []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            own = gone[a:b]
            n_removed.append(int(own.sum()))
            n_spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
            body = data[a:b][~own].tobytes()
            kept.append(body if texts else hashlib.sha256(body).digest())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(np.diff(ends)), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept": pa.array(kept, pa.binary())})

    return cut


def without_repeats(df: DataFrame, text: str = "text", key: str = "doc_id", texts: bool = True, part_bytes: int = PART_BYTES, radix: int = RADIX, hot: int = HOT) -> DataFrame:
    """key, n_bytes, n_removed, n_spans and kept: the remaining bytes, or their SHA-256 if `texts` is false."""
    small_batches(df.sparkSession)
    docs = identified(df, text, key=key).select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("body"))
    total = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = max(8, -(-total // part_bytes))
    dealt = docs.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(n)))
    keys = _routed(dealt.groupBy("part").applyInArrow(_keys_of_part(n, radix), MESSAGE), KEYS, n, radix)
    shared = _routed(keys.groupBy("at").applyInArrow(_shared_keys(n, radix, hot), MESSAGE), SHARED, n, radix)
    sent = dealt.groupBy("part").cogroup(shared.groupBy("at")).applyInArrow(_segments_of_part(n, radix), MESSAGE)
    spans = _routed(_routed(sent, SEGMENTS, n, radix).groupBy("at").applyInArrow(_repeats_of_bucket(n, radix), MESSAGE), SPANS, n, radix)
    out = dealt.groupBy("part").cogroup(spans.groupBy("at")).applyInArrow(_cut_part(texts), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("doc_id", key)
