"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

For each distinct pre-token an Aho-Corasick pass lists the longest vocabulary match at every position.
The encoder takes longest matches from the left; a match stands only if it is compatible with the token
before it, that is, if the merge order would never join anything across their border. If it isn't, the
next shorter token at that place is tried, and if none is left, the token before it is taken back. Each
border is settled once, so the work is linear in the length of the pre-token, and the result is exactly
what applying the merges by rank gives. A pre-token's ids are kept in a bounded table in each worker.

Decoding reads all token strings from one byte blob through an offset table, a batch at a time.

The vocabulary file is a parameter; its tables (bounded by the vocabulary, about a megabyte) are
broadcast, so executors need no file.

Defined cases: null text counts as empty; empty text has no tokens and decodes to ''; rows without
doc_id get no row; repeated rows each get a row; very long texts are encoded alone in their batch; extra columns are unread, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import pickle
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import identified, in_blocks, small_batches

#: Pre-tokens whose ids a worker keeps; the table starts afresh when it is full.
KEPT = 150_000

#: White space of the normaliser, as a character class body.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
GENERAL = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+")
#: Latin text in which every character is its own normal form and its class is known: the same pattern without tables.
_LATIN = "a-z\\xdf-\\xf6\\xf8-\\u012f\\u0131-\\u017f"
PLAIN = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{_LATIN}]+|[0-9]|[^\s0-9{_LATIN}]+")
NOT_PLAIN = re.compile("[^\\t-\\r -~\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u012f\\u0131-\\u017f\\u2010-\\u2027]")


@dataclass
class Vocabulary:
    """What a vocabulary file says, as plain tables."""

    tokens: list[str]
    merges: list[tuple[str, str]]
    special: dict[str, int]
    suffix: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        tokens = [""] * (1 + max([*spec["model"]["vocab"].values(), *special.values()]))
        for token, k in [*spec["model"]["vocab"].items(), *special.items()]:
            tokens[k] = token
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        return cls(tokens, merges, special, spec["model"]["end_of_word_suffix"] or "")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: a printable Latin-1 byte is itself, the others follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Encoder:
    vocabulary: Vocabulary
    kept: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self):
        v, back = self.vocabulary, byte_alphabet()

        def symbols(token: str) -> str:
            """One character for each byte; the byte that ends a word is moved up by 256."""
            ends = bool(v.suffix) and token.endswith(v.suffix)
            codes = [back[c] for c in (token[: -len(v.suffix)] if ends else token)]
            return "".join(map(chr, codes[:-1])) + chr(codes[-1] + 256 * ends) if codes else ""

        own = [symbols(t) if t and t not in v.special else "" for t in v.tokens]
        self.id_of = {s: k for k, s in enumerate(own) if s}
        self.length = [len(s) for s in own]
        self.rank: dict[tuple[int, int], int] = {}
        self.product: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        place = {t: k for k, t in enumerate(v.tokens) if t}
        for rank, (a, b) in enumerate(v.merges):
            whole = a[: -len(v.suffix)] + b if v.suffix and a.endswith(v.suffix) else a + b
            pair = (place[a], place[b])
            self.rank[pair] = rank
            self.product[pair] = place[whole]
            self.parts.setdefault(place[whole], (*pair, rank))
        self.matcher = ahocorasick.Automaton()
        for s, k in self.id_of.items():
            self.matcher.add_word(s, k)
        self.matcher.make_automaton()
        self.shorter = [-1] * len(own)
        for s, k in self.id_of.items():
            for n in range(len(s) - 1, 0, -1):
                if s[:n] in self.id_of:
                    self.shorter[k] = self.id_of[s[:n]]
                    break
        self.fits: dict[tuple[int, int], bool] = {}
        self.special_at = re.compile("|".join(map(re.escape, sorted(v.special, key=len, reverse=True)))) if v.special else None
        self.special_mark = os.path.commonprefix(list(v.special))  # a cheap test that most texts fail
        blob = [(t + " ").encode() for t in v.tokens]
        self.sizes = np.array([len(b) for b in blob], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.blob = np.frombuffer(b"".join(blob), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merge order leaves the border between two adjacent tokens alone.

        Undoes the merges of both from the latest on; the pair that meets at the border at each moment
        must not have a merge that would have come before the one just undone."""
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 500_000:
                self.fits.clear()
            known = self.fits[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        before = (len(self.rank), False)  # the merge just undone, and whether it lies right of the border
        while True:
            found = self.rank.get((left, right))
            # of equal ranks the left one is applied first
            if found is not None and (found < before[0] or found == before[0] and before[1]):
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and a[2] > b[2]:
                before, left = (a[2], False), a[1]
            else:
                before, right = (b[2], True), b[0]

    def encode_symbols(self, s: str) -> list[int]:
        whole = self.id_of.get(s)
        if whole is not None:
            return [whole]
        longest = [-1] * len(s)
        length = self.length
        for end, k in self.matcher.iter(s):
            at = end + 1 - length[k]
            if longest[at] < 0 or length[longest[at]] < length[k]:
                longest[at] = k
        n, out, at, token = len(s), [], 0, longest[0]
        dead = bytearray(n + 1)
        while at < n:
            while token >= 0:
                end = at + length[token]
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < n else -1
            else:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = self.shorter[token]
        return out

    def encode_word(self, word: str) -> bytes:
        raw = word.encode()
        s = raw[:-1].decode("latin-1") + chr(raw[-1] + (256 if self.vocabulary.suffix else 0))
        return np.array(self.encode_symbols(s), "<u4").tobytes()

    def _piece(self, text: str) -> list[bytes]:
        if NOT_PLAIN.search(text) is None:
            found = PLAIN.findall(text.lower())
        else:
            found = GENERAL.findall("".join(map(str.lower, unicodedata.normalize("NFC", text))))
        kept = self.kept
        try:
            return list(map(kept.__getitem__, found))
        except KeyError:
            pass
        out = []
        for word in found:
            ids = kept.get(word)
            if ids is None:
                if len(kept) >= KEPT:
                    kept.clear()
                ids = kept[word] = self.encode_word(word)
            out.append(ids)
        return out

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_at is None or self.special_mark not in text:
            return b"".join(self._piece(text))
        out, at = [], 0
        for m in self.special_at.finditer(text):
            out += self._piece(text[at : m.start()])
            out.append(np.array([self.vocabulary.special[m[0]]], "<u4").tobytes())
            at = m.end()
        return b"".join(out + self._piece(text[at:]))

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """UTF-8 texts: each row's token strings with single spaces between them, through the offset table."""
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
        size = self.sizes[flat]
        ends = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.offsets[flat] - ends[:-1], size)
        at += np.arange(len(at))
        text = self.blob[at].tobytes()
        cuts = ends[np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int64)].tolist()
        return [text[a : b - 1] if b > a else b"" for a, b in zip(cuts, cuts[1:], strict=False)]


_encoders: dict[str, Encoder] = {}


def _encoder(shared) -> Encoder:
    if shared.id not in _encoders:
        _encoders.clear()
        _encoders[shared.id] = Encoder(shared.value)
    return _encoders[shared.id]


class _Shared:
    """A broadcast with an id by which a worker recognises the encoder it has built."""

    def __init__(self, spark, vocabulary: Vocabulary):
        self.held = spark.sparkContext.broadcast(vocabulary)
        self.id = hashlib.sha256(pickle.dumps(vocabulary)).hexdigest()  # of the whole vocabulary

    @property
    def value(self) -> Vocabulary:
        return self.held.value


def encoded(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """key, n_tokens, ids (binary: little-endian unsigned 32-bit) and, if asked for, the decoded text."""
    spark = df.sparkSession
    small_batches(spark)
    shared = _Shared(spark, Vocabulary.load(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in in_blocks(batches, 1 << 19, text):
            encoder = encoder or _encoder(shared)
            ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            out = {key: batch.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if decoded:
                out["decoded"] = pa.array(encoder.decode(ids), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(out)

    kind = dict(df.dtypes)[key]
    return identified(df, text, key=key).mapInArrow(encode, f"`{key}` {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)


def token_lists(df: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, input_ids (array of int): what a trainer reads."""
    spark = df.sparkSession
    small_batches(spark)
    shared = _Shared(spark, Vocabulary.load(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in in_blocks(batches, 1 << 19, text):
            encoder = encoder or _encoder(shared)
            ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "n_tokens": pa.array(np.diff(ends).astype(np.int64)), "input_ids": lists})

    kind = dict(df.dtypes)[key]
    return identified(df, text, key=key).mapInArrow(encode, f"`{key}` {kind}, n_tokens long, input_ids array<int>")


def decoded(df: DataFrame, path: str, ids: str = "ids", key: str = "doc_id") -> DataFrame:
    """key and text for rows of key and ids (binary, as `encoded` returns them); null ids decode to ''."""
    spark = df.sparkSession
    small_batches(spark)
    shared = _Shared(spark, Vocabulary.load(path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 1 << 19, ids):
            yield pa.RecordBatch.from_pydict({key: batch.column(0), "text": pa.array(_encoder(shared).decode([x or b"" for x in batch.column(1).to_pylist()]), pa.binary()).cast(pa.string())})

    return df.select(key, ids).mapInArrow(decode, f"`{key}` {dict(df.dtypes)[key]}, text string")
