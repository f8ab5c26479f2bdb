import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest

from lexigraph.llm import anchors, exact_dedup, near_dedup, repeats
from lexigraph.llm.common import text_bytes, word_hashes, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(partitions)


# ---- exact deduplication ----------------------------------------------------------------------------

ODD = [(5, "a  b"), (3, "a\tb"), (9, None), (4, ""), (7, "a b "), (3, "a b"), (8, "x" * 300_000), (2, "x" * 300_000), (6, "\u00a0"), (None, "a b")]


def exact_by_hand(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        if i is not None:
            groups[norm(t)].append(i)
    return sorted((i, min(own), len(own), hashlib.sha256(t.encode()).hexdigest()) for t, own in groups.items() for i in own)


@pytest.mark.parametrize("limits", [(1 << 24, 1 << 25), (1, 40), (50, 1)])
def test_exact_groups(spark, limits):
    rows = ODD + [(100 + k, f"copy {k % 7}") for k in range(60)]
    out = exact_dedup.exact_groups(docs(spark, rows), run_bytes=limits[0], bucket_bytes=limits[1]).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out) == exact_by_hand(rows)
    kept = [r.doc_id for r in out if r.kept]
    assert len(kept) == len({r.text_sha256 for r in out}) and all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_keeps_whole_rows(spark):
    df = docs(spark, ODD).withColumnRenamed("lang", "_uid").withColumnRenamed("n_chars", "kept")  # clashing names
    out = exact_dedup.deduplicated(df, bucket_bytes=60)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [2, 3, 4, 6, 7]
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_copies_of_one_text_stream_through(monkeypatch):
    """A bucket of one hash is not split any further, and one content of it is held."""
    import pyarrow as pa

    big, sizes = b"x" * 100_000, []
    batch = lambda k, body: pa.RecordBatch.from_pydict({"doc_id": [k], "_uid": [f"{k}"], "_n": [1], "_hash": [exact_dedup.content_hash(hashlib.sha256(body).digest())], "_norm": pa.array([body], pa.binary())})
    rows = (batch(500 - k, big if k % 10 else b"%d" % k) for k in range(400))
    levels = []
    inner = exact_dedup._spill
    monkeypatch.setattr(exact_dedup, "_spill", lambda held, files, folder, level: (levels.append(level), sizes.append(sum(b.nbytes for b in held)), inner(held, files, folder, level)))
    out = [r for b in exact_dedup.resolver("doc_id", None, 300_000)(rows) for r in b.to_pylist()]
    assert len(out) == 400 and max(sizes) < 500_000 and max(levels) <= 1
    assert {(r["keep_id"], r["group_size"]) for r in out if r["group_size"] > 1} == {(101, 360)}


def test_content_table_compares_contents():
    t = exact_dedup.ContentTable(1)
    assert [t.find_or_add(7, b) for b in (b"a", b"b", b"a", b"c", b"b")] == [0, 1, 0, 2, 1] and len(t) == 3


# ---- near-duplicates --------------------------------------------------------------------------------

def near_by_hand(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def variants(seed=3):
    """Unrelated texts, a chain whose ends are not similar, a cloud of edits of one text, copies, and short texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "w" + str(rng.integers(5000))
    rows = [(k, " ".join(word() for _ in range(60))) for k in range(20)]
    base = [word() for _ in range(80)]
    for k in range(12):  # each link changes two words of the one before
        base[5 * k + 3] = word()
        rows.append((100 + k, " ".join(base)))
    cloud = [word() for _ in range(100)]
    for k in range(60):
        own = list(cloud)
        for at in rng.choice(100, size=rng.integers(0, 7), replace=False):
            own[at] = word()
        rows.append((300 - k, " ".join(own)))
    return rows + [(500, None), (501, ""), (502, "a b"), (503, "A  b"), (504, "a b c"), (505, rows[0][1].upper().replace("W", "w")), (506, " \n"), (507, "q " * 20_000), (508, "q " * 9)]


@pytest.mark.parametrize("hubs", [16, near_dedup.HUBS, 3])
def test_near_groups(spark, hubs, monkeypatch):
    monkeypatch.setattr(near_dedup, "HUBS", hubs)
    monkeypatch.setattr(near_dedup, "QUERY_SHINGLES", 300)
    monkeypatch.setattr(near_dedup, "MEMBER_SHINGLES", 700)
    rows = variants()
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.groups(docs(spark, rows)).collect())
    assert got == near_by_hand(rows)


def test_near_doc_id_on_two_texts(spark):
    rng = np.random.default_rng(8)
    a, b = (" ".join("w" + str(x) for x in rng.integers(5000, size=60)) for _ in range(2))
    rows = [(5, a), (5, b), (7, a + " x"), (9, b + " y"), (9, b + " y"), (3, b + " z")]
    got = sorted((r.doc_id, r.component_id) for r in near_dedup.groups(docs(spark, rows)).collect())
    assert got == [(3, 3), (5, 3), (5, 5), (7, 5), (9, 3), (9, 3)]
    assert sorted(r.text for r in near_dedup.deduplicated(docs(spark, rows)).collect()) == sorted([a, b + " z"])


def test_near_stage_keeps_columns(spark):
    df = docs(spark, variants()).withColumnRenamed("lang", "label").withColumnRenamed("n_chars", "component_id")
    out = near_dedup.deduplicated(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [i for i, _, _, kept in near_by_hand(variants()) if kept]
    assert near_dedup.groups(df.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    b = a.copy()
    b[:200] = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    low = near_dedup.minima(np.concatenate([a, b]), np.array([0, 1000]))
    x, y = near_dedup.packed(low).view(np.uint64)
    lanes = [((int(p) ^ int(q)) >> (4 * k)) & 15 for p, q in zip(x, y, strict=True) for k in range(16)]
    same = sum(v == 0 for v in lanes) / 128
    assert abs((same - 1 / 16) / (15 / 16) - 800 / 1200) < 0.15


# ---- repeated byte strings --------------------------------------------------------------------------

def repeats_by_hand(rows):
    first, out = {}, []
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for i, b in bodies:
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], i), i)
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return sorted(out)


def passages(seed=5):
    rng = np.random.default_rng(seed)
    text = lambda n: "".join(rng.choice(list("abcdefgh ,\u00e9"), n))
    shared, periodic = text(120), "ab " * 60
    rows = [(k, text(150) + (shared if k % 3 == 0 else "") + text(40)) for k in range(30)]
    rows += [(40, periodic), (41, periodic + "z" + periodic), (42, shared[:49]), (43, shared[:50]), (44, shared), (44, shared + "x"), (45, None), (46, ""), (-1, shared[30:100]), (47, "\0" * 60), (48, "\0" * 70), (49, rows[2][1])]
    return rows


@pytest.mark.parametrize("limits", [(1 << 30, 128, 1 << 14), (600, 128, 1 << 14), (600, 3, 1)])
def test_repeats(spark, limits):
    """Of one part, of several, and with messages in several hops and most keys dealt string by string."""
    rows = passages()
    out = repeats.without_repeats(docs(spark, rows), part_bytes=limits[0], radix=limits[1], hot=limits[2])
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()) == repeats_by_hand(rows)
    assert repeats.without_repeats(docs(spark, rows).limit(0)).count() == 0


def test_index_family_merges_geometrically(monkeypatch):
    monkeypatch.setattr(repeats, "STEP", 7)
    rng = np.random.default_rng(1)
    docs_, sizes, body = [], [], []
    for d in range(200):
        b = bytes(rng.integers(97, 99, 70, dtype=np.uint8))
        docs_.append(d)
        sizes.append(len(b))
        body.append(b)
    data = np.frombuffer(b"".join(body), np.uint8)
    a = repeats.repeated(np.array(docs_), np.array(sizes), data, batch=64)
    b = repeats.repeated(np.array(docs_), np.array(sizes), data, batch=1 << 20)
    assert (a == b).all()
    family = repeats.IndexFamily()
    for k in range(64):
        text = np.frombuffer(f"{k:050d}{k // 2:050d}".encode(), np.uint8)
        family.meet(repeats.Level.of(text, np.array([0, 50]), np.array([k, k]))[0])
    assert len(family.levels) <= 7 and sum(map(len, family.levels)) == 64


def test_messages_of_a_task_are_bounded():
    """A part sends at most `radix` messages, however many buckets there are, and every row arrives."""
    import pyarrow as pa

    n, radix = 1000, 10
    width = repeats._first_width(n, radix)
    to = np.arange(n, dtype=np.int32)
    lists = np.repeat(to, to % 3)
    sent, rounds = repeats._messages([to, to % 3, lists], (None, None, 1), width, 0), 1
    assert sent.num_rows == radix and set(sent.column("at").to_pylist()) == set(range(radix))
    while width > 1:
        width //= radix
        parts = [repeats._messages(repeats._joined(sent.slice(k, 1), 3), (None, None, 1), width, 0) for k in range(sent.num_rows)]
        assert all(p.num_rows <= radix for p in parts)
        sent, rounds = pa.concat_tables(parts), rounds + 1
    assert rounds == 3 and sent.num_rows == n
    got = [repeats._unpack(x) for x in sent.column("payload").to_pylist()]
    assert all(int(a[0]) == at and c.tolist() == [at] * (at % 3) for at, (a, _, c) in zip(sent.column("at").to_pylist(), got, strict=True))


def test_segment_keys_depend_on_the_string_alone():
    rng = np.random.default_rng(2)
    common = rng.integers(97, 123, 90, dtype=np.uint8)
    keys = []
    for n in (3, 200):
        data = np.concatenate([rng.integers(97, 123, n, dtype=np.uint8), common])
        key, _, first, last = anchors.segments(data, np.array([0, len(data)]))
        at = {int(p): int(k) for k, a, b in zip(key, first, last, strict=True) for p in range(a, b + 1)}
        keys.append([at[n + k] for k in range(41)])
    assert keys[0] == keys[1]


def test_word_kernels():
    import pyarrow as pa

    texts = ["a bb\tccc", None, "", " x ", "\u00e9\u00a0y"]
    data, ends = text_bytes(pa.array(texts))
    start, end, doc = words(data, ends)
    got = [(d, data[s:e].tobytes()) for s, e, d in zip(start, end, doc, strict=True)]
    assert got == [(d, w) for d, t in enumerate(texts) for w in (t or "").encode().split()]
    assert len(set(word_hashes(data, start, end).tolist())) == len(got)
