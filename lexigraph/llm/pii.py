"""Personal data: exact base patterns, plus spans that a linear-chain CRF adds.

The base spans are fixed patterns with checks (IP parts, Luhn, digit counts). The CRF labels the words of
each line by their shape and their neighbours' shapes; it is trained here, from a small labelled table, by
gradient ascent on the regularised likelihood, and decoded by Viterbi over padded numpy batches. It finds
what the patterns leave: phone numbers without a plus, addresses with a port or brackets, and the like. A
CRF span that touches a base span is dropped, and so is a card number that fails Luhn's check (the patterns
have judged the plain ones); base spans always stay.

Words without a digit and without `@` can only be labelled `O` (a constraint of the model, in training
and decoding), so a line's best labelling is exactly the best labelling of the runs between such words,
and only these runs are decoded.

Defined cases: null text counts as empty and has no spans; rows without doc_id get no row; repeated rows
each get a row; very long texts are read alone in their batch, in linear time; extra columns are unread, whatever
their names; an empty table gives an empty result; offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import identified, in_blocks, small_batches

KINDS = ("email", "ip", "card", "phone")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: Possessive forms: digit runs are maximal where a match can begin, so giving digits back never helps.
IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
IP_SKIP = re.compile(r"[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = max(done, at + 1)  # no match can contain this @
        at = text.find("@", max(done, at + 1))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while run := IP_SKIP.search(text, at):
        found = IP.match(text, run.start())
        if found:
            at = found.end()
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found[0].split(".")):
                yield found.span()
        else:
            at = run.end()


def base_spans(text: str | None) -> list[Span]:
    """The spans of the fixed patterns, by start and kind."""
    if not text:
        return []
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(a, 1, b) for a, b in _ips(text)] if "." in text else []
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def written_out(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


# ---- the linear-chain CRF -------------------------------------------------------------------------

LABELS = ("O", *KINDS)

#: Shapes of the labelled table: `9` stands for a digit, `a` and `A` for letters; each word has its label's
#: letter (o none, e email, i ip, c card, p phone). The table is every row with every filling of its digits
#: by the rule in labelled(). Rows of `o` alone are what must be left alone.
LABELLED = (
    ("call (999) 999-9999 now", "oppo"), ("tel 999-999-9999.", "op"), ("999.999.9999", "p"), ("phone 9999 999 999", "oppp"),
    ("+9 (999) 999-9999 aaa", "pppo"), ("aaa +99 99 9999 9999", "opppp"), ("aaa +999 999 9999 aaa", "opppo"), ("99-999-999-9999", "p"),
    ("(999)999-9999", "p"), ("aaa 999-999-9999 aaa", "opo"), ("aaa (99) 9999-9999, aaa", "oppo"), ("aaa +9-999-999-9999", "op"),
    ("aaa 999.99.9.999 aaa", "oio"), ("999.999.9.99:9999", "i"), ("aaa [99.9.9.99] aaa", "oio"), ("99.99.99.99/99", "i"), ("(99.999.99.9),", "i"),
    ("aaa.99@aaaa9.aaa.aaa aaa", "eo"), ("aaa <aa@aaa.aa> aaa", "oeo"), ("aaa@aaa.aa,", "e"), ("aaa a.a@aaa.aa.", "oe"), ("aaa@aaaa aaa", "eo"),
    ("aaa 9999.9999.9999.9999 aaa", "oco"), ("aaa 9999/9999/9999/9999, aaa", "oco"), ("9999_9999_9999_9999", "c"), ("9999.999999.99999 aaa", "co"),
    ("9999 9999 9999 9999 aaa", "ooooo"), ("aaa 9999-9999-9999-9999.", "oo"), ("aaa 9999999999999999 aaa", "ooo"), ("aaa 9999 999999 99999", "oooo"),
    ("aaa 9999 aaa", "ooo"), ("99 aaa 9999 aaa", "oooo"), ("9999-99-99 aaa", "oo"), ("aaa 99/99/9999 aaa", "ooo"), ("aaa 9.9. aaa", "ooo"),
    ("aaa 9.9.9 aaa", "ooo"), ("aaa $9,999.99 aaa", "ooo"), ("aaa 99:99:99 aaa", "ooo"), ("aaa 9. aaa", "ooo"), ("aaa 99% aaa", "ooo"),
    ("aaa = \"a9aa99a9a99aa99a9a9a\" aaa", "oooo"), ("aaa=99aa99a9aaa9a9 aaa", "oo"), ("@aaa aaa", "oo"), ("aaa @ aaa", "ooo"), ("aaa 9999, 9999 aaa", "oooo"),
    ("99 99 99 aaa", "oooo"), ("aaa a9 a99 aaa", "oooo"), ("aaa v9.9.9-aaa9 aaa", "ooo"), ("999,999 aaa", "oo"), ("aaa 99-99 aaa", "ooo"), ("99999-9999 aaa", "oo"),
    ("aaa 999 999 aaa", "oooo"), ("aaa 99999999 aaa", "ooo"), ("aaa (9999) aaa", "ooo"), ("aaa [99] aaa", "ooo"), ("9) aaa 9) aaa", "oooo"), ("AA 9.9 aaa", "ooo"),
    ("AA-99 aaa 999.", "ooo"), ("aaa 9999 99 aaa", "oooo"), ("aaa 999-99-9999 aaa", "ooo"), ("aaa 99.99 99.99 aaa", "oooo"), ("9a9a-99aa-9a99 aaa", "oo"),
)
_LETTER = {"o": 0, "e": 1, "i": 2, "c": 3, "p": 4}


def labelled() -> list[tuple[list[str], list[int]]]:
    """The small labelled table: each row of LABELLED with three fillings of its digits."""
    return [
        ([re.sub("9", lambda m, k=k: str((7 * m.start() + 3 * k + 1) % 10), w) for w in text.split()], [_LETTER[c] for c in labels])
        for text, labels in LABELLED
        for k in range(3)
    ]


def free(word: str) -> bool:
    """Whether the word may have a label other than O."""
    return "@" in word or DIGIT.search(word) is not None


def shape(word: str) -> str:
    """Digits to 9, letters to a, runs of letters to one; runs of over four digits to their length class."""
    s = re.sub(r"[^\W\d_]+", "a", word)
    return re.sub(r"[0-9]+", lambda m: "9" * len(m[0]) if len(m[0]) <= 4 else f"<{min(len(m[0]), 20)}>", s)


def features(word: str | None) -> list[str]:
    """Shape features of a word; None is the line's edge."""
    if word is None:
        return ["edge"]
    if not free(word):
        return ["plain"]
    core = word.strip(".,;:!?\"'<>#$%&*|")
    n = sum(c.isdigit() for c in core)
    return [
        f"shape {shape(core)}", f"digits {min(n, 20)}", f"at {min(core.count('@'), 2)}{'.' in core.partition('@')[2]}", f"dots {min(core.count('.'), 5)}",
        f"dashes {min(core.count('-'), 4)}", f"plus {core[:1] == '+'}", f"bracket {core[:1] in '(['}{core[-1:] in ')]'}", f"letters {re.search('[A-Za-z]', core) is not None}",
    ]


@dataclass
class Crf:
    """Weights of the shape features (own, of the word before, of the word after) and of label pairs."""

    place: dict[str, int]
    own: np.ndarray
    step: np.ndarray

    def emissions(self, words: list[str | None]) -> np.ndarray:
        """(len(words) - 2, labels): the first and last word are context only."""
        named = [features(w) for w in words]
        out = np.zeros((len(words) - 2, len(LABELS)))
        for k in range(1, len(words) - 1):
            for j, tag in ((k - 1, "<"), (k, ""), (k + 1, ">")):
                for f in named[j]:
                    at = self.place.get(tag + f)
                    if at is not None:
                        out[k - 1] += self.own[at]
        return out

    def viterbi(self, runs: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each run; O stands before and after every run."""
        if not runs:
            return []
        n, longest = len(runs), max(map(len, runs))
        emit = np.zeros((n, longest, len(LABELS)))
        size = np.array([len(r) for r in runs])
        for k, r in enumerate(runs):
            emit[k, : len(r)] = r
        score = np.full((n, len(LABELS)), -1e9)
        score[:, 0] = 0
        back = np.zeros((n, longest + 1, len(LABELS)), np.int8)
        for t in range(longest + 1):
            reach = score[:, :, None] + self.step[None]
            back[:, t] = reach.argmax(axis=1)
            best = reach.max(axis=1)
            if t < longest:
                score = np.where((t < size)[:, None], best + emit[:, t], score)
        ending = (score + self.step[:, 0]).argmax(axis=1)
        out = []
        for k in range(n):
            path = np.zeros(size[k], np.int64)
            label = int(ending[k])
            for t in range(size[k] - 1, -1, -1):
                path[t] = label
                label = int(back[k, t, label])
            out.append(path)
        return out


def trained(rounds: int = 200, rate: float = 0.15, ridge: float = 0.02) -> Crf:
    """The CRF of the labelled table: Adam on the mean log-likelihood less a ridge; the same weights each time."""
    runs, place = [], {}
    for text, labels in labelled():
        padded = [None, *text, None]
        k = 0
        while k < len(text):
            if not free(text[k]):
                k += 1
                continue
            end = k
            while end < len(text) and free(text[end]):
                end += 1
            rows = []
            for j in range(k + 1, end + 1):
                names = [t + f for i, t in ((j - 1, "<"), (j, ""), (j + 1, ">")) for f in features(padded[i])]
                rows.append([place.setdefault(x, len(place)) for x in names])
            runs.append((rows, labels[k:end]))
            k = end
    n, longest, states = len(runs), max(len(r) for r, _ in runs), len(LABELS)
    x = np.zeros((n, longest, len(place)))
    y = np.zeros((n, longest, states))
    live = np.zeros((n, longest), bool)
    pairs = np.zeros((states, states))
    for k, (rows, labels) in enumerate(runs):
        for t, r in enumerate(rows):
            x[k, t, r] = 1
            y[k, t, labels[t]] = 1
            live[k, t] = True
        for a, b in zip([0, *labels], [*labels, 0], strict=True):
            pairs[a, b] += 1
    size = live.sum(axis=1)
    weights = [np.zeros((len(place), states)), np.zeros((states, states))]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    total = lambda a, axis: (m := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis=axis))
    for turn in range(1, rounds + 1):
        own, step = weights
        emit = x @ own
        ahead = np.zeros((n, longest, states))
        ahead[:, 0] = step[0] + emit[:, 0]
        for t in range(1, longest):
            ahead[:, t] = total(ahead[:, t - 1, :, None] + step, 1) + emit[:, t]
        behind = np.zeros((n, longest, states))
        for t in range(longest - 1, -1, -1):
            last = (t == size - 1)[:, None]
            inner = total(step[None] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2) if t + 1 < longest else 0
            behind[:, t] = np.where(last, step[:, 0], inner)
        whole = total(ahead[:, 0] + behind[:, 0], 1)
        own_p = np.exp(ahead + behind - whole[:, None, None]) * live[..., None]
        expected = np.zeros((states, states))
        expected[0] += own_p[:, 0].sum(axis=0)
        expected[:, 0] += own_p[np.arange(n), size - 1].sum(axis=0)
        for t in range(longest - 1):
            both = np.exp(ahead[:, t, :, None] + step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :] - whole[:, None, None])
            expected += (both * live[:, t + 1, None, None]).sum(axis=0)
        slope = [np.einsum("nlf,nls->fs", x, y - own_p) / n - ridge * own / 10, (pairs - expected) / n - ridge * step / 10]
        for k in range(2):
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.99 * second[k] + 0.01 * slope[k] ** 2
            weights[k] = weights[k] + rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)
    return Crf(place, *weights)


WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRIM = ".,;:!?\"'<>#$%&*|"


def added_spans(texts: list[str], base: list[list[Span]], crf: Crf) -> list[list[Span]]:
    """For each text, the CRF's spans that touch no base span; one Viterbi batch for all texts."""
    runs, owner = [], []
    for d, text in enumerate(texts):
        if "@" not in text and not DIGIT.search(text):
            continue
        start = 0
        for line in text.split("\n"):
            if "@" in line or DIGIT.search(line):
                held = [(m[0], start + m.start()) for m in WORD.finditer(line)]
                padded = [None, *(w for w, _ in held), None]
                k = 0
                while k < len(held):
                    if not free(held[k][0]):
                        k += 1
                        continue
                    end = k
                    while end < len(held) and free(held[end][0]):
                        end += 1
                    runs.append(crf.emissions(padded[k : end + 2]))
                    owner.append((d, held[k:end]))
                    k = end
            start += len(line) + 1
    # of each text's base spans: starts in order, and the largest end up to each
    starts = [sorted(x for x, _, _ in own) for own in base]
    ends = [list(accumulate((y for _, _, y in sorted(own)), max)) for own in base]

    def touches(d: int, a: int, b: int) -> bool:
        before = bisect_left(starts[d], b)
        return before > 0 and ends[d][before - 1] > a

    out: list[list[Span]] = [[] for _ in texts]
    for group in _by_length(runs):
        for k, path in zip(group, crf.viterbi([runs[i] for i in group]), strict=True):
            d, held = owner[k]
            t = 0
            while t < len(path):
                end = t + 1
                while end < len(path) and path[end] == path[t]:
                    end += 1
                if path[t]:
                    a = held[t][1] + len(held[t][0]) - len(held[t][0].lstrip(TRIM))
                    b = held[end - 1][1] + len(held[end - 1][0].rstrip(TRIM))
                    card = "".join(c for c in texts[d][a:b] if "0" <= c <= "9") if path[t] == 3 else None
                    if a < b and (card is None or luhn(card)) and not touches(d, a, b):
                        out[d].append((a, int(path[t]) - 1, b))
                t = end
    return out


def _by_length(runs: list[np.ndarray], cells: int = 1 << 16) -> Iterator[list[int]]:
    """Places of runs, shortest first, in groups whose padded size stays under `cells` words."""
    group: list[int] = []
    for k in sorted(range(len(runs)), key=lambda k: len(runs[k])):
        if group and (len(group) + 1) * len(runs[k]) > cells:
            yield group
            group = []
        group.append(k)
    if group:
        yield group


def found(df: DataFrame, crf: Crf | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_email, n_ip, n_card, n_phone (base spans), base (text form), spans (all spans)."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(crf or trained())  # a few thousand floats

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 1 << 21, text):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            base = [base_spans(t) for t in texts]
            more = added_spans(texts, base, shared.value)
            yield pa.RecordBatch.from_pydict(
                {
                    key: batch.column(0),
                    **{f"n_{kind}": pa.array([sum(s[1] == k for s in x) for x in base], pa.int64()) for k, kind in enumerate(KINDS)},
                    "base": pa.array(map(written_out, base), pa.string()),
                    "spans": pa.array([written_out(a + b) for a, b in zip(base, more, strict=True)], pa.string()),
                }
            )

    kind = dict(df.dtypes)[key]
    return identified(df, text, key=key).mapInArrow(find, f"`{key}` {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
