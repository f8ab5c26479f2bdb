"""Language identification by nearest centroid over normalised TF-IDF n-gram vectors.

Byte bigrams and trigrams of the lower-cased text are hashed into a fixed number of dimensions, weighted
by log(1 + tf) * idf and scaled to length one. Each language has several centroids, found by spherical
k-means over a bounded sample of its labelled rows. A text goes to the language of the centroid with the
largest cosine; a text whose cosine is below a distance learned from the sample is rejected. A text with
few n-grams can't come near a centroid of many, so the distance is learned by size (the number of different
n-grams, in powers of two) from pieces of 1 to 64 words of the sample's texts; a text of fewer than JUDGED
different n-grams (a short word) is too little to be judged by distance: with a letter, it stays.

The sample is bounded by `sample` rows for each language (those with the smallest hash of their id), the
same bound at every size of the corpus; prediction covers every whole text. What reaches the driver is
the sample's vectors, sample x languages x DIMENSIONS floats, and the first HEAD bytes of its texts.

Defined cases: null text, or text without a letter: `und`, score 0, rejected; no labelled row to learn
from: `und` for all; rows without doc_id get no row; repeated rows each get a row; of languages with the same cosine,
the first by name; very long texts are counted alone in their batch; extra columns are unread, whatever their names;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, identified, in_blocks, small_batches, text_bytes, words

DIMENSIONS = 4096
CLUSTERS = 3
SAMPLE = 300
#: Labelled rows that the model is fitted on in all languages together, where that leaves LEAST for each.
FITTED, LEAST = 12_000, 20
#: A text is rejected below this share of the smallest cosine that 99.5 % of the sample's texts or pieces of its size reach.
REJECT = 0.35
#: Different n-grams from which a text is judged by distance.
JUDGED = 12
#: Words of the pieces that the distances of short texts are learned from, pieces of each text and length, and bytes of
#: each text that they are taken from.
PIECES, EACH, HEAD = (1, 2, 4, 8, 16, 32, 64), 4, 2048

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[65:91] = LOWER[65:91]
_LETTERS[97:123] = np.arange(97, 123)


def counts(data: np.ndarray, ends: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """(texts, dimensions) counts of hashed letter bigrams and trigrams; a gram never crosses texts."""
    n = len(ends) - 1
    x = _LETTERS[data].astype(np.uint32)
    doc = np.repeat(np.arange(n), np.diff(ends))
    out = np.zeros(n * dimensions, np.int64)
    for width, salt in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        if len(x) < width:
            continue
        code = np.zeros(len(x) - width + 1, np.uint32)
        solid = np.zeros(len(code), bool)
        for k in range(width):
            part = x[k : k + len(code)]
            code = (code << np.uint32(8)) | part
            solid |= part != 32
        same = (doc[: len(code)] == doc[width - 1 :]) & solid
        code = (code * np.uint32(salt)) ^ ((code * np.uint32(salt)) >> np.uint32(15))
        at = doc[: len(code)][same] * dimensions + ((code[same] * np.uint32(0x2C1B3C6D)) >> np.uint32(20)) % dimensions
        out += np.bincount(at, minlength=n * dimensions)
    return out.reshape(n, dimensions)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    least: np.ndarray  # by size()

    def vectors(self, tf: np.ndarray) -> np.ndarray:
        v = np.log1p(tf.astype(np.float32)) * self.idf
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)

    def predict(self, tf: np.ndarray) -> tuple[list[str], np.ndarray]:
        cosine = self.vectors(tf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        return [self.languages[k] for k in best], np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)

    def bounds(self, tf: np.ndarray) -> np.ndarray:
        """The cosine below which each text is rejected."""
        return np.where(np.count_nonzero(tf, axis=1) < JUDGED, 0.0, self.least[size(tf)])


def size(tf: np.ndarray) -> np.ndarray:
    """Bits of the number of different n-grams of each text."""
    return np.frexp(np.count_nonzero(tf, axis=1))[1]


def clustered(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from the mean's nearest row and then the rows farthest from all starts."""
    start = [int((v @ v.mean(axis=0)).argmax())]
    while len(start) < min(k, len(v)):
        start.append(int((v @ v[start].T).max(axis=1).argmin()))
    c = v[start]
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.stack([v[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def pieces(heads: list[bytes], length: int) -> list[bytes]:
    """Up to EACH runs of `length` words of each text, spread over it."""
    out = []
    for head in heads:
        start, end, _ = words(np.frombuffer(head, np.uint8), np.array([0, len(head)]))
        last = len(start) - length
        if last >= 0:
            out += [head[start[k] : end[k + length - 1]] for k in sorted({last * j // max(1, EACH - 1) for j in range(EACH)})]
    return out


def learned_bounds(model: Model, tf: np.ndarray, heads: list[bytes], reject: float) -> np.ndarray:
    """The least cosine by size, never larger for a smaller size."""

    def seen(tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return size(tf), model.predict(tf)[1]

    parts = [seen(tf)]
    for length in PIECES:
        cut = pieces(heads, length)
        for at in range(0, len(cut), 256):  # a few MB of counts at a time
            parts.append(seen(counts(*text_bytes(pa.array(cut[at : at + 256], pa.binary())))))
    sizes, cosine = (np.concatenate(x) for x in zip(*parts, strict=True))
    least = np.zeros(size(np.ones((1, model.centroids.shape[1])))[0] + 1)
    bound = reject * float(np.quantile(parts[0][1], 0.005))  # of the whole texts
    for k in reversed(range(len(least))):
        if (sizes == k).any():
            bound = min(bound, reject * float(np.quantile(cosine[sizes == k], 0.005)))
        least[k] = bound
    return least


def fit(tf: np.ndarray, langs: list[str], heads: list[bytes], clusters: int = CLUSTERS, reject: float = REJECT) -> Model:
    idf = np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))).astype(np.float32) + 1
    model = Model(idf, np.zeros((0, tf.shape[1]), np.float32), [], np.zeros(1))
    v, names = model.vectors(tf), np.array(langs)
    for lang in sorted(set(langs)):
        c = clustered(v[names == lang], clusters)
        model.centroids = np.concatenate([model.centroids, c.astype(np.float32)])
        model.languages += [lang] * len(c)
    model.least = learned_bounds(model, tf, heads, reject)
    return model


def held_out(key: str = "doc_id"):
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def learned(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE) -> Model | None:
    """A model from a bounded sample of the labelled rows that are not held out; None without such rows."""
    small_batches(df.sparkSession)
    usable = identified(df, text, lang, key=key).where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
    found = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    sample = min(sample, max(LEAST, FITTED // max(1, len(found))))
    # the rows of least hash: about four times the sample pass the bound of their language, however many there are
    bounds = [F.lit(x) for name, n in found.items() for x in (name, min(2.0**63, -(2.0**63) + 2.0**64 * 4 * sample / n))]
    low = usable.where(F.xxhash64(key).cast("double") <= F.try_element_at(F.create_map(*bounds), F.col(lang))) if found else usable
    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    ids = [r[0] for r in low.select(key, lang).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample).select(key).collect()]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_blocks(batches, 1 << 20, text):
            tf = counts(*text_bytes(batch.column(1))).astype(np.int32)
            head = [(t or "").encode()[:HEAD] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"key": batch.column(0).cast(pa.int64()), "lang": batch.column(2).cast(pa.string()), "tf": pa.array([x.tobytes() for x in tf], pa.binary()), "head": pa.array(head, pa.binary())})

    rows = usable.where(F.col(key).isin(ids)).mapInArrow(vectors, "key long, lang string, tf binary, head binary").collect() if ids else []
    if not rows:
        return None
    rows.sort(key=lambda r: (r.key, r.lang))
    return fit(np.stack([np.frombuffer(r.tf, np.int32) for r in rows]), [r.lang for r in rows], [r.head for r in rows])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def predicted(df: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """key, lang_pred, score and rejected for each row; with `carry`, the rows that are not rejected, with those columns."""
    spark = df.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # DIMENSIONS x (clusters of all languages) floats
    inner = df.select(key, text) if carry is None else df.select(*carry)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        place = None
        for batch in in_blocks(batches, 1 << 20, text):
            place = batch.schema.get_field_index(text)
            column = batch.column(place)
            if model is None:
                lang, score, least = ["und"] * batch.num_rows, np.zeros(batch.num_rows), 0
            else:
                tf = counts(*text_bytes(column))
                lang, score = model.predict(tf)
                least = model.bounds(tf)
                bare = [k for k, t in enumerate(column.to_pylist()) if not has_letter(t)]
                for k in bare:
                    lang[k], score[k] = "und", 0.0
            rejected = np.array([x == "und" for x in lang]) | (score < least)
            if carry is not None:
                yield batch.filter(pa.array(~rejected))
            else:
                yield pa.RecordBatch.from_pydict({key: batch.column(0), "lang_pred": pa.array(lang, pa.string()), "score": pa.array(np.round(score, 5)), "rejected": pa.array(rejected)})

    if carry is not None:
        return inner.mapInArrow(predict, inner.schema)
    return inner.mapInArrow(predict, f"`{key}` {dict(df.dtypes)[key]}, lang_pred string, score double, rejected boolean")


def languages(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """key, held_out, lang_pred, score, rejected for each row that has a key."""
    model = learned(df, text, lang, key)
    return predicted(identified(df, text, key=key), model, text, key).select(key, held_out(key).alias("held_out"), "lang_pred", "score", "rejected")
