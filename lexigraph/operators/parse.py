"""Kernels over the parses of a batch of sentences: numpy over all tokens at once, plain Python only where texts meet.

Tokens come sorted by place, each sentence's heads as places of its own. A head that is no token of the sentence gets a
node of its own, of dependency -1.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from ..functions import ontology

SKIPPED = ("det", "punct", "cc")
#: Dependents that belong to the noun chunk of their head.
CHUNK_DEPS = ("det", "amod", "compound", "nummod", "poss", "nmod", "quantmod")
#: Dependencies that some rule names; in batches they are numbers from 1, 0 for others and -1 for null.
DEPS = tuple(dict.fromkeys((*SKIPPED, "prep", "conj", "pobj", *CHUNK_DEPS, *ontology.SUBJECT_DEPS, *ontology.OBJECT_DEPS, *ontology.MODIFIER_DEPS, *ontology.PREDICATE_DEPS)))

PATHS = "array<struct<x: int, y: int, a: bigint, b: bigint, length: int>>"
RELATED = "array<struct<x: int, y: int, verb: int, trigger: string>>"

#: A row's number is shifted so far; places and offsets have 32 bits and stand above 0.
SHIFT, LIFT = 33, 1 << 31


def _is(dep: np.ndarray, *names: str) -> np.ndarray:
    return np.isin(dep, [DEPS.index(x) + 1 for x in names])


def _followed(following: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Where each node ends up that goes on to `following` as long as it is `moved`; steps are doubled, circles end."""
    to = np.where(moved, following, np.arange(len(following)))
    for _ in range(31):
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    return to


class Batch:
    """Nodes of all sentences of a batch: row, i, dep, head (a node); tokens are the first n of them, by row and place."""

    def __init__(self, tokens: pa.Array):
        if isinstance(tokens, pa.ChunkedArray):
            tokens = tokens.combine_chunks()
        self.counts = np.asarray(tokens.value_lengths().fill_null(0), np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.rows, self.n, self.values = len(tokens), int(self.starts[-1]), tokens.flatten()
        i, head, dep = (np.asarray(self.field(c), np.int64) for c in ("i", "head", "dep"))
        row = np.repeat(np.arange(self.rows), self.counts)
        own, want = ((row << SHIFT) + v + LIFT for v in (i, head))
        at = np.minimum(np.searchsorted(own, want), max(self.n - 1, 0))
        out = own[at] != want
        lone, inverse = np.unique(want[out], return_inverse=True)
        at[out] = self.n + inverse
        self.row, self.i = np.concatenate([row, lone >> SHIFT]), np.concatenate([i, (lone & ((1 << SHIFT) - 1)) - LIFT])
        self.head, self.dep = np.concatenate([at, self.n + np.arange(len(lone))]), np.concatenate([dep, np.full(len(lone), -1)])
        self.lead = _followed(self.head, _is(self.dep, "conj"))

    def field(self, name: str) -> pa.Array:
        return self.values.field(name)


def _listed(row: np.ndarray, rows: int, kind: str, columns: list) -> pa.Array:
    """The columns' values as a list for each row; they come in order of rows."""
    fields = [x.split(":") for x in kind.removeprefix("array<struct<").removesuffix(">>").split(", ")]
    types = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    arrays = [pa.array(c, types[t.strip()]) for c, (_, t) in zip(columns, fields, strict=True)]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, [n for n, _ in fields]))


def _edges(t: Batch) -> tuple[np.ndarray, np.ndarray]:
    """The collapsed parse, one way: without function words; a preposition is passed over to its object, and a conjunct
    hangs where its coordination hangs, past prepositions."""
    k, token = np.arange(len(t.dep)), np.arange(len(t.dep)) < t.n
    prep, conj = _is(t.dep, "prep"), _is(t.dep, "conj")
    plain = (t.dep >= 0) & ~_is(t.dep, *SKIPPED) & ~prep & ~conj
    over = _is(t.dep, "pobj") & prep[t.head]
    hung = conj & token[t.head]
    past = _followed(t.head, prep)
    a = np.concatenate([k[plain], t.head[t.head[over]], k[hung]])
    b = np.concatenate([t.head[plain], k[over], past[t.head[t.head[hung]]]])
    return a[a != b], b[a != b]


def _roots(t: Batch, spans: pa.Array) -> np.ndarray:
    """For each node the entity (its place among all of the batch) whose first occurrence it heads, else -1; one entity for a
    token, the first."""
    values = spans.flatten()
    counts = np.asarray(spans.value_lengths().fill_null(0), np.int64)
    row, at, n = np.repeat(np.arange(t.rows), counts), np.asarray(values.field("at"), np.int64), np.asarray(values.field("n"), np.int64)
    start, end = (np.asarray(t.field(c), np.int64) for c in ("start", "end"))
    base = np.zeros(t.rows, np.int64)
    full = t.counts > 0
    if full.any():
        base[full] = np.minimum.reduceat(start, t.starts[:-1][full])
    first, last = base[row] + at, base[row] + at + n
    root = np.full(len(t.dep), -1)
    entity = np.flatnonzero((at >= 0) & full[row])
    same = t.row[1 : t.n] == t.row[: max(t.n - 1, 0)]
    head = np.full(len(row), -1)
    if not (same & ((np.diff(start) < 0) | (np.diff(end) < 0))).any():
        low, high = ((t.row[: t.n] << SHIFT) + v + LIFT for v in (end, start))
        lo = np.searchsorted(low, (row[entity] << SHIFT) + first[entity] + LIFT, "right")
        hi = np.searchsorted(high, (row[entity] << SHIFT) + last[entity] + LIFT, "left") - 1
        entity, lo, hi = (x[lo <= hi] for x in (entity, lo, hi))
        open_ = np.arange(len(entity))
        k = 0
        while len(open_):
            c = lo[open_] + k
            top = (t.head[c] == c) | (t.i[t.head[c]] < t.i[lo[open_]]) | (t.i[t.head[c]] > t.i[hi[open_]])
            head[entity[open_[top]]] = c[top]
            k += 1
            open_ = open_[~top & (c < hi[open_])]
    else:  # tokens that don't stand in order of their offsets
        for e in entity:
            own = slice(t.starts[row[e]], t.starts[row[e] + 1])
            inside = np.flatnonzero((start[own] < last[e]) & (first[e] < end[own])) + t.starts[row[e]]
            if len(inside):
                up = t.head[inside]
                tops = inside[(up == inside) | (t.i[up] < t.i[inside[0]]) | (t.i[up] > t.i[inside[-1]])]
                head[e] = tops[0] if len(tops) else -1
    placed = np.flatnonzero(head >= 0)
    nodes, which = np.unique(head[placed], return_index=True)
    root[nodes] = placed[which]
    return root


def paths_of(tokens: pa.Array, spans: pa.Array) -> pa.Array:
    """x, y (entities of the sentence), a, b (their tokens' places) and length of each path."""
    t = Batch(tokens)
    spans = spans.combine_chunks() if isinstance(spans, pa.ChunkedArray) else spans
    root, nodes = _roots(t, spans), np.int64(len(t.dep) + 1)
    a, b = _edges(t)
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    straight = (root[a] >= 0) & (root[b] >= 0) & (a < b)
    # two edges meet in a node that is no entity's: of its neighbours only entities' are laid out
    meet = (root[a] < 0) & (root[b] >= 0)
    middle, end = np.divmod(np.unique(a[meet] * nodes + b[meet]), nodes)
    size = np.unique(middle, return_counts=True)[1]
    place = np.arange(len(middle)) - np.repeat(np.cumsum(size) - size, size)
    more = np.repeat(size, size) - 1 - place
    one = np.repeat(np.arange(len(middle)), more)
    two = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(more) - more, more)
    a, b = np.concatenate([a[straight], end[one]]), np.concatenate([b[straight], end[two]])
    length = np.concatenate([np.full(int(straight.sum()), 1), np.full(len(one), 2)])
    pairs, which = np.unique(a * nodes + b, return_index=True)  # of equal ones the first, which is the shorter
    (a, b), length = np.divmod(pairs, nodes), length[which]
    apart = t.lead[a] != t.lead[b]
    a, b, length = a[apart], b[apart], length[apart]
    base = np.concatenate([[0], np.cumsum(np.asarray(spans.value_lengths().fill_null(0), np.int64))])
    row = t.row[a]
    return _listed(row, t.rows, PATHS, [root[a] - base[row], root[b] - base[row], t.i[a], t.i[b], length])


_BLANKS = re.compile("[ \t\n\x0b\f\r]+")


def verb_related_of(tokens: pa.Array, words: pa.Array) -> pa.Array:
    return _related(tokens, words, False)


def related_of(tokens: pa.Array, words: pa.Array) -> pa.Array:
    return _related(tokens, words, True)


def _related(tokens: pa.Array, words: pa.Array, attached: bool) -> pa.Array:
    """x, y (entities of the sentence), verb (its number, 0 for attachments) and trigger. words: the entities' words, in
    lower case and in order."""
    t = Batch(tokens)
    low, verb, heads, leads, deps = t.field("low").to_pylist(), np.asarray(t.field("verb"), np.int64), t.head.tolist(), t.lead.tolist(), t.dep.tolist()
    top = _followed(t.head, _is(t.dep, *CHUNK_DEPS))
    chunk = list(low)  # a token alone is its own chunk
    members: dict[int, list[int]] = {}
    for k, to in _several(top[: t.n]):
        members.setdefault(to, []).append(k)
    for own in members.values():
        joined = " ".join(x for k in own if (x := low[k]) is not None)
        for k in own:
            chunk[k] = joined
    group: dict[int, list[int]] = {}
    for k, to in _several(t.lead[: t.n]):
        group.setdefault(to, []).append(k)
    subject, object_, modifier, predicate = (_is(t.dep[: t.n], *d) for d in (ontology.SUBJECT_DEPS, ontology.OBJECT_DEPS, ontology.MODIFIER_DEPS, ontology.PREDICATE_DEPS))
    verbs = np.flatnonzero(verb > 0)
    of_verb = np.isin(t.head[: t.n], verbs) if len(verbs) else np.zeros(t.n, bool)
    asked = ((modifier | predicate) if attached else np.zeros(t.n, bool)) | (of_verb & (subject | object_))
    out: tuple[list, ...] = ([], [], [], [], [])
    texts, entities, row_of = t.field("text"), words.to_pylist(), t.row[: t.n]
    # subjects of heads that have predicates or are verbs, each by its head
    heard = np.unique(t.head[: t.n][predicate]) if attached else np.zeros(0, np.int64)
    subjects: dict[int, list[int]] = {}
    for k in np.flatnonzero(subject & np.isin(t.head[: t.n], heard)).tolist():
        subjects.setdefault(heads[k], []).append(k)
    marks = np.flatnonzero(asked)
    rows, begins = np.unique(row_of[marks], return_index=True)
    ends = [*begins[1:].tolist(), len(marks)]
    marks, mod, pred, subj, obj, ofv = marks.tolist(), modifier.tolist(), predicate.tolist(), subject.tolist(), object_.tolist(), of_verb.tolist()
    for row, begin, end in zip(rows.tolist(), begins.tolist(), ends, strict=True):
        own = [(x, w, _BLANKS.split(w) if _BLANKS.search(w) else ()) for x, w in enumerate(entities[row] or ())]
        if not own:
            continue
        exact: dict[str, int] = {}
        for x, w, _ in own:
            exact.setdefault(w, x)
        known: dict[int, int] = {}

        def entity(k: int) -> int:
            """The entity that a token stands for: one of the same text, else the first that overlaps its noun chunk; else -1."""
            found = known.get(k)
            if found is None:
                s, c = low[k], chunk[k]
                found = exact.get(s, -1)
                if found < 0:
                    found = next((x for x, w, parts in own if w in c or c in w or s in parts), -1) if c is not None else -1
                known[k] = found
            return found

        seen: set = set()
        arguments: dict[int, tuple[set, set]] = {}
        for k in marks[begin:end]:
            others = group.get(leads[k]) or (k,)
            if attached and (mod[k] or pred[k]):
                ends_ = None
                if mod[k] and heads[k] < t.n and (y := entity(heads[k])) >= 0:
                    ends_ = {e for o in others if (e := entity(o)) >= 0}
                    seen.update((deps[k], e, y) for e in ends_)
                if pred[k] and (by := subjects.get(heads[k])):
                    ends_ = ends_ if ends_ is not None else {e for o in others if (e := entity(o)) >= 0}
                    seen.update((deps[k], x, e) for s in by if (x := entity(s)) >= 0 for e in ends_)
            if ofv[k]:
                meets = {x for o in others if (c := chunk[o]) is not None for x, w, _ in own if w in c or c in w}
                sides = arguments.setdefault(heads[k], (set(), set()))
                if subj[k]:
                    sides[0].update(meets)
                if obj[k]:
                    sides[1].update(meets)
        for d, x, y in seen:
            for one, two in ((x, y), (y, x)):
                for column, value in zip(out, (row, one, two, 0, DEPS[d - 1]), strict=True):
                    column.append(value)
        for v, (first, second) in arguments.items():
            for x in first:
                for y in second:
                    for column, value in zip(out, (row, x, y, int(verb[v]), texts[v].as_py()), strict=True):
                        column.append(value)
    return _listed(np.asarray(out[0], np.int64), t.rows, RELATED, list(out[1:]))


def _several(to: np.ndarray) -> list[tuple[int, int]]:
    """(k, to[k]) of those that share it with others, in order."""
    _, inverse, counts = np.unique(to, return_inverse=True, return_counts=True)
    k = np.flatnonzero(counts[inverse] > 1)
    return list(zip(k.tolist(), to[k].tolist(), strict=True))
