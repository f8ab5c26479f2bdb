"""Kernels over the texts of a batch of records: numpy over the bytes of all their sentences at once.

A record's text is a string, whose sentences stand between MARKS, or a list of sentences; what is found is a list for each
record. Records are taken together up to CHUNK bytes of text and WORDS different words of entities, so that memory doesn't
grow with the batch. Texts are split and lower-cased here: to split and pack them beforehand costs more than to read them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .parse import _listed

FOUND = "array<struct<sent: int, p: int, t: int>>"
RELATED = "array<struct<s: int, sentence: string, t: int, x: int, y: int>>"
PAIRED = "array<struct<s: int, sentence: string, x: int, y: int, swapped: int>>"

CHUNK, WORDS = 1 << 20, 64

#: A run of these ends a sentence.
MARKS = ".!?\n"
_RUN = re.compile(f"([{MARKS}]+)")
#: Letters of Unicode 16, whose lower case Spark knows and Python 3.13 doesn't.
_NEWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B} | {k: k + 32 for k in range(0x10D50, 0x10D66)}
_NEW = re.compile(f"[{''.join(map(chr, _NEWER))}]")
_MARK = np.zeros(256, bool)
_MARK[[*map(ord, MARKS)]] = True

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123)]] = True
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def _whole(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all values one after another, offsets of n + 1 ends); null counts as empty."""
    column = _whole(column)
    counts = np.asarray(column.value_lengths().fill_null(0), np.int64)
    return _whole(column.flatten()), np.concatenate([[0], np.cumsum(counts)])


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all strings one after another, offsets of n + 1 ends); null counts as empty."""
    values = values.fill_null("") if values.null_count else values
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(values.type) else np.int32
    ends = np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[ends[0] : ends[-1]] if values.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, value): for each k the numbers starts[k], starts[k] + 1, ... of its count."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)


class Texts:
    """Sentences of some records: d (lower-cased bytes, padded), start and end of each, first sentence of each record;
    sentence(k): as they stand."""

    def __init__(self, texts: pa.Array):
        whole = not pa.types.is_list(texts.type)
        values, first = (_whole(texts), np.arange(len(texts) + 1)) if whole else _lists(texts)
        values = values.fill_null("") if whole and values.null_count else values
        data, ends = _bytes(pa.array([_lower(x, whole) for x in values.to_pylist()], pa.large_string()))
        self.n, self.first, self.start, self.end = len(data), first, ends[:-1], ends[1:]
        if whole:
            self.start, self.end, self.first = _split(data, ends)
        self._values, self._whole, self._plain = values, whole, None
        self.d = np.concatenate([data, np.zeros(8, np.uint8)])
        self.record = np.repeat(np.arange(len(texts)), np.diff(self.first))
        wide = np.ndarray((self.n + 1,), "<u8", self.d, strides=(1,))
        self.at = lambda k: wide[k]
        self._two: tuple[np.ndarray, np.ndarray] | None = None

    def sentence(self, k: np.ndarray) -> pa.Array:
        return self.plain().take(pa.array(k, pa.int64()))

    def plain(self) -> pa.Array:
        """All sentences as they stand."""
        if self._plain is None:
            self._plain = self._values.cast(pa.large_string())
            if self._whole:
                data, ends = _bytes(self._values)
                start, end, _ = _split(data, ends)
                # sentences and what stands between them take turns
                turns = np.append(np.stack([start, end], axis=1).ravel(), len(data))
                laid = pa.LargeStringArray.from_buffers(len(turns) - 1, pa.py_buffer(turns), pa.py_buffer(np.ascontiguousarray(data)))
                self._plain = laid.take(pa.array(np.arange(0, len(turns) - 1, 2)))
        return self._plain

    def equal(self, at: np.ndarray, term: bytes) -> np.ndarray:
        """Whether the term stands at these places; it may not run past the end of the bytes."""
        good = at + len(term) <= self.n
        for k in range(0, len(term), 8):
            part = term[k : k + 8]
            good &= self.at(np.minimum(at + k, self.n)) & _MASKS[len(part)] == np.uint64(int.from_bytes(part, "little"))
        return good

    def places(self, term: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(place, sentence) of all occurrences of a term, within sentences."""
        if self._two is None:
            # places by their two bytes: each term reads only those that start like it
            two = self.d[: self.n].astype(np.uint16) << 8 | self.d[1 : self.n + 1]
            self._two = np.argsort(two, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(two, minlength=1 << 16))])
        order, begin = self._two
        low = term[0] << 8 | (term[1] if len(term) > 1 else 0)
        at = order[begin[low] : begin[low + (1 if len(term) > 1 else 256)]]
        at = np.sort(at) if len(term) == 1 else at
        at = at[self.equal(at, term)] if len(term) > 2 else at
        s = np.searchsorted(self.start, at, "right") - 1
        inside = at + len(term) <= self.end[s]
        return at[inside], s[inside]

    def bounds(self, term: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each sentence where its first occurrence starts and its last one; -1 if there is none."""
        if not term:
            return self.start.copy(), self.end.copy()
        first, last = np.full((2, len(self.start)), -1, np.int64)
        at, s = self.places(term)
        if len(at):
            new = np.flatnonzero(np.diff(s, prepend=-1))
            first[s[new]] = at[new]
            last[s[new]] = at[np.append(new[1:], len(at)) - 1]
        return first, last


def _lower(text: str | None, whole: bool) -> str:
    """Lower-cased as each sentence alone: what a final sigma becomes depends on what follows it."""
    if text is None:
        return ""
    if text.isascii():
        return text.lower()
    low = "".join(x.lower() for x in _RUN.split(text)) if whole and "\u03a3" in text else text.lower()
    return low.translate(_NEWER) if _NEW.search(low) else low


def _split(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of all sentences of texts, and the first one of each text; empty ones between, before and after marks too."""
    mark = _MARK[data]
    before, after = np.zeros((2, len(data)), bool)
    before[1:], after[:-1] = mark[:-1], mark[1:]
    full = np.diff(ends) > 0
    before[ends[:-1][full]], after[ends[1:][full] - 1] = False, False
    runs, stops = np.flatnonzero(mark & ~before), np.flatnonzero(mark & ~after) + 1
    first = np.arange(len(ends)) + np.searchsorted(runs, ends)
    return np.sort(np.concatenate([ends[:-1], stops])), np.sort(np.concatenate([runs, ends[1:]])), first


def _chunks(texts: pa.Array, words: np.ndarray | None = None, own: np.ndarray | None = None) -> Iterator[tuple[int, int, Texts]]:
    """(first record, end, their texts); words and own: entities' words as numbers, and each record's first entity."""
    texts = _whole(texts)
    if pa.types.is_list(texts.type):
        values, first = _lists(texts)
        ends = _bytes(values)[1][first]
    else:
        ends = _bytes(texts)[1]
    n, a = len(texts), 0
    todo = []
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + CHUNK, "right")) - 1)
        todo.append((a, min(b, n)))
        a = b
    while todo:
        a, b = todo.pop(0)
        if words is not None and b - a > 1 and len(np.unique(words[own[a] : own[b]])) > WORDS:
            todo[:0] = [(a, (a + b) // 2), ((a + b) // 2, b)]
            continue
        yield a, b, Texts(texts[a:b])


def finder(terms: list[str]) -> Callable[[pa.Array], pa.Array]:
    """Kernel: where runs of words are one of the terms (words of a-z and 0-9 with single spaces between them). p is the
    word's place as a split at all else counts it: a sentence that starts otherwise has an empty word first."""
    split = [[w.encode() for w in t.split(" ")] for t in terms]
    codes = {}
    for k, own in enumerate(split):
        codes.setdefault(int.from_bytes(own[0][:8], "little"), []).append(k)
    heads = np.array(sorted(codes), np.uint64)
    lengths = np.unique([len(own[0]) for own in split])

    def found(t: Texts) -> list[np.ndarray]:
        word = _WORD[t.d[: t.n]]
        full = t.end > t.start
        before, after = np.zeros((2, t.n), bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        before[t.start[full]], after[t.end[full] - 1] = False, False
        start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        size = end - start
        some = np.flatnonzero(np.isin(size, lengths))
        code = t.at(start[some]) & _MASKS[np.minimum(size[some], 8)]
        which = np.minimum(np.searchsorted(heads, code), len(heads) - 1)
        hit = heads[which] == code
        some, which = some[hit], which[hit]
        order = np.argsort(which, kind="stable")
        some, cut = some[order], np.searchsorted(which[order], np.arange(len(heads) + 1))
        own, leading = np.searchsorted(start, t.start), np.zeros(len(t.start), np.int64)
        leading[full] = ~word[t.start[full]]
        out = []
        for h, head in enumerate(heads):
            token = some[cut[h] : cut[h + 1]]
            sent = np.searchsorted(t.start, start[token], "right") - 1
            stop = np.append(own[1:], len(start))[sent]
            for k in codes[int(head)]:
                good = token + len(split[k]) <= stop
                for j, w in enumerate(split[k]):
                    at = np.minimum(token + j, len(start) - 1)
                    good &= size[at] == len(w)
                    if j or len(w) > 8:
                        good &= t.equal(start[at], w)
                at, s = token[good], sent[good]
                out.append(np.stack([t.record[s], s - t.first[t.record[s]], at - own[s] + leading[s], np.full(len(at), k)]))
        return out

    def kernel(texts: pa.Array) -> pa.Array:
        parts = [np.zeros((4, 0), np.int64)]
        for a, _, t in _chunks(texts):
            if t.n:
                for part in found(t):
                    part[0] += a
                    parts.append(part)
        row, *rest = _by_row(parts)
        return _listed(row, len(texts), FOUND, rest)

    return kernel


def _with_sentences(texts: pa.Array, e: Entities, kind: str, of: Callable) -> pa.Array:
    """What `of` finds (record, sentence and numbers) in each chunk that has entities, with the sentences themselves."""
    lists, at = [], 0
    for a, b, t in _chunks(texts, e.low, e.own):
        if e.own[b] == e.own[a]:
            continue
        row, s, *rest = _by_row([np.zeros((5, 0), np.int64), *of(t, a, b)])
        sentence = t.sentence(t.first[row - a] + s).cast(pa.string())
        if a > at:
            lists.append(_listed(row[:0], a - at, kind, [s[:0], sentence[:0], *(c[:0] for c in rest)]))
        lists.append(_listed(row - a, b - a, kind, [s, sentence, *rest]))
        at = b
    if at < len(texts):
        no = np.zeros(0, np.int64)
        lists.append(_listed(no, len(texts) - at, kind, [no, pa.array([], pa.string()), no, no, no]))
    return pa.concat_arrays(lists)


def _by_row(parts: list[np.ndarray]) -> np.ndarray:
    out = np.concatenate(parts, axis=1)
    return out[:, np.argsort(out[0], kind="stable")]


class Entities:
    """Entities of a batch: own (first of each record), word and low (numbers of the words and of the lower-cased ones),
    label (its place among the labels, else -1), ord."""

    def __init__(self, column: pa.Array, labels: list[str]):
        values, self.own = _lists(column)
        number = lambda name: pc.dictionary_encode(values.field(name), null_encoding="encode")
        word, low = number("word"), number("low")
        self.word, self.low = np.asarray(word.indices, np.int64), np.asarray(low.indices, np.int64)
        self.lows = [(x or "").encode() for x in low.dictionary.to_pylist()]
        self.label = np.asarray(pc.fill_null(pc.index_in(values.field("label"), pa.array(labels, values.field("label").type)), -1), np.int64)
        self.ord = np.asarray(values.field("ord"), np.int64)


def _places(t: Texts, e: Entities, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of records a to b: (row for each word's number, first, last), a row for each word, as bounds."""
    used = np.unique(e.low[e.own[a] : e.own[b]])
    row = np.zeros(len(e.lows), np.int64)
    row[used] = np.arange(len(used))
    found = [t.bounds(e.lows[w]) for w in used]
    both = np.array(found, np.int64).reshape(len(used), 2, len(t.start))
    return row, both[:, 0], both[:, 1]


def _pairs(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of equal values, below n; both come in order."""
    counts = np.bincount(right, minlength=n)
    at = (np.cumsum(counts) - counts)[left]
    return _spread(at, counts[left])


def _matrix(labels: list[str], pairs: set[tuple[str, str]]) -> np.ndarray:
    """Which pairs of labels are among the pairs; the last row and column, of unknown labels, are not."""
    out = np.zeros((len(labels) + 1, len(labels) + 1), bool)
    for x, y in pairs:
        out[labels.index(x), labels.index(y)] = True
    return out


def relater(triggers: list[tuple[str, str, str]], licences: list[tuple[str, str, str]]) -> Callable[[pa.Array, pa.Array], pa.Array]:
    """Kernel: pairs of entities on both sides of the first occurrence of a trigger (relation, lower-cased trigger, direction),
    of different words, where the pair of labels may have the relation. x is the relation's subject."""
    labels = sorted({x for a, b, _ in licences for x in (a, b)})
    allowed = [_matrix(labels, {(a, b) for a, b, r in licences if r == relation}) for relation, _, _ in triggers]

    def related(t: Texts, e: Entities, a: int, b: int) -> Iterator[np.ndarray]:
        row, first, last = _places(t, e, a, b)
        size = np.array([len(w) for w in e.lows], np.int64)
        count = np.diff(e.own)[a:b]
        for k, (_, trigger, direction) in enumerate(triggers):
            may = allowed[k] if direction == "F" else allowed[k].T  # by the side before the trigger and the side after it
            at = t.bounds(trigger.encode())[0]
            hit = np.flatnonzero(at >= 0)
            s, x = _spread(e.own[a:b][t.record[hit]], count[t.record[hit]])
            low, sent = e.low[x], hit[s]
            start = first[row[low], sent]
            before = np.flatnonzero((start >= 0) & (start + size[low] <= at[sent]) & may.any(axis=1)[e.label[x]])
            after = np.flatnonzero((last[row[low], sent] >= at[sent] + len(trigger.encode())) & may.any(axis=0)[e.label[x]])
            p, q = _pairs(s[before], s[after], len(hit))
            p, q = before[p], after[q]
            good = may[e.label[x[p]], e.label[x[q]]] & (e.word[x[p]] != e.word[x[q]])
            p, q = p[good], q[good]
            own = t.record[sent[p]]
            one, two = (p, q) if direction == "F" else (q, p)
            yield np.stack([own + a, sent[p] - t.first[own], np.full(len(p), k), x[one] - e.own[a + own], x[two] - e.own[a + own]])

    def kernel(texts: pa.Array, entities: pa.Array) -> pa.Array:
        e = Entities(entities, labels)
        return _with_sentences(texts, e, RELATED, lambda t, a, b: related(t, e, a, b))

    return kernel


def pairer(licences: list[tuple[str, str]]) -> Callable[[pa.Array, pa.Array, pa.Array], pa.Array]:
    """Kernel: pairs of a sentence's entities (x before y by ord, of different words) whose labels may have a relation as they
    stand or swapped. Of a record's pairs with equal sentences and the same two words only the first is returned."""
    labels = sorted({x for pair in licences for x in pair})
    may = _matrix(labels, set(licences))
    either = may | may.T

    def paired(t: Texts, e: Entities, a: int, b: int) -> np.ndarray:
        same = np.asarray(pc.dictionary_encode(t.plain(), null_encoding="encode").indices, np.int64)
        row, first, _ = _places(t, e, a, b)
        s, x = _spread(e.own[a:b][t.record], np.diff(e.own)[a:b][t.record])
        held = first[row[e.low[x]], s] >= 0
        s, x = s[held], x[held]
        p, q = _pairs(s, s, len(t.start))
        good = (e.ord[x[p]] < e.ord[x[q]]) & either[e.label[x[p]], e.label[x[q]]] & (e.word[x[p]] != e.word[x[q]])
        s, x, y = s[p[good]], x[p[good]], x[q[good]]
        text = np.unique(t.record * (same.max(initial=0) + 1) + same, return_inverse=True)[1]
        words, w = np.unique(np.concatenate([e.word[x], e.word[y]]), return_inverse=True)
        v, w, n = w[: len(x)], w[len(x) :], len(words)
        # rows come in order of sentence and x; by y within them, so that the first of a group is the first in order
        order = np.lexsort((e.ord[y], e.ord[x], s))
        s, x, y, v, w = (c[order] for c in (s, x, y, v, w))
        kept = np.sort(np.unique((text[s] * n + np.minimum(v, w)) * n + np.maximum(v, w), return_index=True)[1])
        s, x, y = s[kept], x[kept], y[kept]
        own, turned = t.record[s], ~may[e.label[x], e.label[y]]
        return np.stack([own + a, s - t.first[own], np.where(turned, y, x) - e.own[a + own], np.where(turned, x, y) - e.own[a + own], turned])

    def kernel(texts: pa.Array, entities: pa.Array) -> pa.Array:
        e = Entities(entities, labels)
        return _with_sentences(texts, e, PAIRED, lambda t, a, b: [paired(t, e, a, b)])

    return kernel
