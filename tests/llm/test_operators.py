import itertools
import math
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexigraph.llm import bpe, language_id, mixing, pii, quality, sharding, url_filter
from lexigraph.llm.common import text_bytes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], SCHEMA).repartition(partitions)


# ---- sharding ---------------------------------------------------------------------------------------

def test_shards(spark):
    rng = random.Random(1)
    rows = [(k, "x" * rng.randint(0, 400), "en", "s") for k in range(2000)] + [(5000 + k, "hot " * 50, "en", "s") for k in range(1000)] + [(9000, None, None, None), (None, "gone", "en", "s"), (1 << 62, "far", "en", "s"), (-(1 << 62), "far", "en", "s")]
    df = docs(spark, rows).withColumnRenamed("lang", "shard").withColumnRenamed("n_chars", "h")
    out = sharding.sharded(df).collect()
    want = {i: t or "" for i, t, _, _ in rows if i is not None}
    assert {r.doc_id: (r.size, r.text_crc32) for r in out} == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in want.items()} and len(out) == len(want)
    sizes, slots = Counter(), {}
    for r in out:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    mean = sum(sizes.values()) / 40
    assert sorted(sizes) == list(range(40)) and max(sizes.values()) < 1.06 * mean and min(sizes.values()) > 0.94 * mean
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    split = {c for c, n in Counter(c for c, _ in {(r.text_crc32, r.shard) for r in out}).items() if n > 1}
    assert len(split) <= 40  # only groups that a boundary falls into are cut
    plan = sharding.sharded(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_shards_of_few_rows(spark):
    out = sharding.sharded(docs(spark, [(1, "a", "en", "s"), (1, "a", "en", "s"), (2, "", "en", "s")])).collect()
    assert sorted(r.doc_id for r in out) == [1, 1, 2] and all(0 <= r.shard < 40 and r.grown_shard is None and r.law == "bytes" for r in out)
    assert sharding.sharded(docs(spark, [(1, "a", "en", "s")]).limit(0)).count() == 0


# ---- personal data ----------------------------------------------------------------------------------

def base_by_hand(text):
    out = []
    for k, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")) or k == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits)) or k == 3 and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(4)
    for _ in range(20_000):
        body = "".join(rng.choice("12.5@a-+ (0)b.4.2@\u00e99") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(body) == base_by_hand(body), body
    pii.base_spans("1" * 200_000 + "@" + "a." * 50_000)  # linear


def test_crf(spark):
    crf = pii.trained()
    right = 0
    table = pii.labelled()
    for tokens, labels in table:
        text = " ".join(tokens)
        got = pii.added_spans([text], [[]], crf)[0]
        ends = list(itertools.accumulate(len(t) + 1 for t in tokens))
        hit = [any(a < e - 1 and e - 1 - len(t) < b for a, _, b in got) for t, e in zip(tokens, ends, strict=True)]
        right += all(h == (lab > 0) or lab == 3 for h, lab in zip(hit, labels, strict=True))
    assert right / len(table) > 0.95
    best = max(itertools.product(range(5), repeat=3), key=lambda p: _score(crf, ["(415)", "555-0132", "2019,"], p))
    assert crf.viterbi([crf.emissions([None, "(415)", "555-0132", "2019,", None])])[0].tolist() == list(best)


def _score(crf, tokens, labels):
    e = crf.emissions([None, *tokens, None])
    path = [0, *labels, 0]
    return sum(e[k, lab] for k, lab in enumerate(labels)) + sum(crf.step[a, b] for a, b in zip(path, path[1:], strict=False))


def test_found(spark):
    rows = [(1, "\u00e9 a.b@c.example.com, 10.0.0.1 call +1 (743) 555-3824 or (743) 555-3824.\n4111 1111 1111 1111", "en", "s"), (2, None, "en", "s"), (3, "clean words only", "en", "s"), (4, "in 2019 about 3.1 of 4111111111111112", "en", "s"), (None, "a@b.cd", "en", "s")]
    got = {r.doc_id: r for r in pii.found(docs(spark, rows)).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert (got[1].n_email, got[1].n_ip, got[1].n_card, got[1].n_phone) == (1, 1, 1, 1)
    assert got[1].base == pii.written_out(base_by_hand(rows[0][1])) and "phone:56:70" in got[1].spans.split(",") and set(got[1].base.split(",")) < set(got[1].spans.split(","))
    assert all(got[k].spans == got[k].base == "" for k in (2, 3, 4))
    assert pii.found(docs(spark, rows).limit(0)).count() == 0


# ---- quality ----------------------------------------------------------------------------------------

def test_quality(spark):
    own = lambda k, n: " ".join(f"word{k}x{j}" for j in range(n))
    boiler = "All  rights reserved by the owner of this page"
    rows = [(k, own(k, 30) + f"\n{boiler.upper() if k % 2 else boiler}\n", "en", "a") for k in range(8)]
    rows += [(20 + k, f"{boiler}\n" * 2 + f"{boiler} {k}\n" + own(20 + k, 12), "en", "a" if k < 3 else None) for k in range(5)]
    rows += [(40, None, "en", "a"), (41, "", "en", None), (42, " \n\t", "en", "a"), (43, "a b # $ <é>\n a b\n a b\n" + "x y z w " * 40, "en", "b"), (None, "gone", "en", "a"), (44, "\x85 \xa0\u00e9 \u65e5\u672c", "en", "b")]
    got = {r.doc_id: r for r in quality.judged(docs(spark, rows), line_limit=5).collect()}
    word = re.compile(r"[^\x20\x09-\x0D]+")
    norm = lambda x: " ".join(word.findall(x)).lower()  # noqa: E731  ASCII in these rows
    seen = Counter((s, line) for i, t, _, s in rows if i is not None for line in {norm(x) for x in (t or "").split("\n")} if line)
    for i, t, _, s in rows:
        if i is None:
            continue
        w = word.findall(t or "")
        grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        marked = {j for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
        lines = (t or "").split("\n")
        dup = sum(bool(word.search(x)) and x in lines[:k] for k, x in enumerate(lines))
        gone = sum(len(word.findall(x)) for x in lines if seen[s, norm(x)] > 5)
        failed = len(w) < 20 or 100 * len(marked) > 30 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.n_removed_words, r.kept) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(marked), failed, gone, not failed and 100 * gone <= 50 * len(w),
        ), i
    assert len(got) == len(rows) - 1 and not all(r.kept for r in got.values())
    cleaned = {r.doc_id: r.text for r in quality.cleaned(docs(spark, rows), line_limit=5).collect()}
    assert cleaned[0] == own(0, 30) + "\n" and cleaned[43] == rows[16][1] and cleaned[40] == ""
    assert quality.judged(docs(spark, rows).limit(0)).count() == 0


# ---- BPE --------------------------------------------------------------------------------------------

VOCABULARY = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers") + "/word_bpe_49k.json"
ODD_TEXTS = [
    None, "", " \n", "<|endoftext|>Hi <|startoftext|> THE'S<|endoftext|>x", "\u0391\u03a3 \u0391\u03a3. \u0130stanbul \u0149 \u017f", "don't we'll I'm 'sup 12th \u00bd\u00b2", "e\u0301 \u0301x \ud55c\uae00 \u4e2d\u6587 \U0001f600!!?", "a\u2028b\u00a0c\x85d\x1ce", "Orre " * 5000, "x" * 20_000,
]


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(7)
    texts = ODD_TEXTS + ["".join(rng.choice("etaoinshrdlu'st \u00e9\u00f1\u00df9!? -") for _ in range(rng.randint(1, 300))) for _ in range(400)]
    out = {r.doc_id: r for r in bpe.encoded(docs(spark, [(k, t, "en", "s") for k, t in enumerate(texts)] + [(None, "gone", "en", "s")]), VOCABULARY, decoded=True).collect()}
    assert len(out) == len(texts)
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(out[k].ids, "<u4").tolist() == ids and out[k].n_tokens == len(ids), repr(t)[:80]
        assert out[k].decoded == library.decode(ids, skip_special_tokens=False)
    lists = {r.doc_id: r.input_ids for r in bpe.token_lists(docs(spark, [(1, "Hello there", "en", "s"), (2, None, "en", "s")]), VOCABULARY).collect()}
    assert lists == {1: library.encode("Hello there", add_special_tokens=False).ids, 2: []}
    back = bpe.decoded(bpe.encoded(docs(spark, [(1, "Hello there", "en", "s")]), VOCABULARY), VOCABULARY).first()
    assert back.text == library.decode(lists[1], skip_special_tokens=False)


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary file")
def test_bpe_equals_plain_merging():
    e = bpe.Encoder(bpe.Vocabulary.load(VOCABULARY))
    rng = random.Random(9)
    for _ in range(3000):
        word = "".join(rng.choice("etaoinshrdlucm") for _ in range(rng.randint(1, 24)))
        s = word[:-1] + chr(ord(word[-1]) + 256)
        ids = [e.id_of[c] for c in s]
        while True:
            ranked = [(e.rank[p], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in e.rank]
            if not ranked:
                break
            k = min(ranked)[1]
            ids[k : k + 2] = [e.product[ids[k], ids[k + 1]]]
        assert e.encode_symbols(s) == ids, word


# ---- language ---------------------------------------------------------------------------------------

def test_languages(spark):
    rng = random.Random(2)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["zu", "erg", "tch"], "zz": ["\u00e9n", "o\u00e7a", "\u00fbl"]}
    rows = [(k, " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(rng.randint(3, 60))), lang, "s") for k, lang in enumerate(rng.choices(list(parts), k=400))]
    odd = [(1000, None, "xx", "s"), (1001, "", "xx", "s"), (1002, "12 34 !", None, "s"), (1003, "qwvjq bbbbb", None, "s"), (None, "ka", "xx", "s")]
    out = {r.doc_id: r for r in language_id.languages(docs(spark, rows + odd)).collect()}
    assert len(out) == len(rows) + len(odd) - 1
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in out.items())
    unseen = [out[i].lang_pred == lang for i, _, lang, _ in rows if out[i].held_out]
    assert sum(unseen) / len(unseen) > 0.98
    assert all(out[k].lang_pred == "und" and out[k].rejected for k in (1000, 1001, 1002)) and out[1003].rejected and out[1003].lang_pred != "und"
    kept = language_id.predicted(docs(spark, rows + odd), language_id.learned(docs(spark, rows)), carry=["doc_id", "text", "lang", "source", "n_chars"])
    assert {r.doc_id for r in kept.collect()} - {None} == {i for i, *_ in rows}
    assert language_id.languages(docs(spark, rows).limit(0)).count() == 0
    assert {r.lang_pred for r in language_id.languages(docs(spark, [(1, "ka", None, "s")])).collect()} == {"und"}


def test_one_word_documents_stay(spark):
    rng = random.Random(6)
    made = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(2000)] for lang, letters in {"xx": "abcdefghij", "yy": "klmnopqrs", "zz": "\u00e9\u00e8tuvwxyz"}.items()}
    rows = [(k, " ".join(rng.choice(made[lang]) for _ in range(150)) + ".", lang, "s") for k, lang in enumerate(rng.choices(list(made), k=240))]
    model = language_id.learned(docs(spark, rows))
    short = [(1000 + k, word.capitalize() + ".", lang, "s") for k, (lang, word) in enumerate((lang, w) for lang in made for w in rng.sample(made[lang], 60))]
    odd = [(2000, "a", None, "s"), (2001, "7.", None, "s"), (2002, "\u65e5\u672c\u8a9e\u6587\u66f8\u4e2d\u56fd", None, "s")]
    kept = language_id.predicted(docs(spark, short + odd), model, carry=["doc_id", "text"])
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, *_ in short] + [2000]
    assert (np.diff(model.least) >= 0).all() and model.least[0] < model.least[-1]


# ---- URLs -------------------------------------------------------------------------------------------

def judged_by_hand(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [(h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
    blocked = any(host == b or host.endswith("." + b) for b in url_filter.BLOCKED_HOSTS)
    return host, path, rule, verdict or ("block" if blocked else "allow")


def test_urls(spark):
    hosts = ["example.com", "A.Example.COM", "example.net", "m.example.net", "example.org", "com", "xcom", "spam-farm.example.org", "x.spam-farm.example.org", "notspam-farm.example.org", "cheap-pills.example.com:80", ""]
    paths = ["", "/", "/en/", "/en/7", "/en/70?x#y", "/EN/7", "/de/8", "/de/", "/es/1#t", "?q=/en/", "#://x/y", "/en"]
    urls = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "//x/y", "a://b://c/d", "http://\u00c9X.com/en/\n"]
    df = spark.createDataFrame(list(enumerate(urls)) + [(3, urls[3]), (None, urls[9])], "page_id long, url string").withColumn("rule", F.lit("clash")).repartition(3)
    got = sorted(((r.page_id is None, r.page_id or 0), (r.host, r.path, r.rule, r.verdict)) for r in url_filter.judged(df).collect())
    want = sorted(((i is None, i or 0), judged_by_hand(u)) for i, u in [*enumerate(urls), (3, urls[3]), (None, urls[9])])
    assert [g[1] for g in got] == [w[1] for w in want]
    assert url_filter.judged(df.limit(0)).count() == 0


@pytest.mark.parametrize("family", ["spam-farm", "cheap-pills", "casino-win", "free-bets", "adult-x", "ads-track"])
def test_every_family_of_hosts_is_blocked(spark, family):
    hosts = [f"{sub}{family}.example.{top}" for sub in ("", "m.", "a.b.") for top in ("com", "net", "org")]
    near = [f"not{family}.example.com", f"{family}.example.com.x", f"{family}x.example.net"]
    df = spark.createDataFrame(list(enumerate(f"http://{h}/p" for h in hosts + near)), "page_id long, url string")
    got = {r.host: r.verdict for r in url_filter.judged(df).collect()}
    assert got == {h: "block" for h in hosts} | {h: "allow" for h in near}


def test_cascade_is_exact(spark):
    keys = [f"k{n}" for n in range(5000)]
    listed = keys[::40] + ["not in the corpus"]
    cascade = url_filter.build(listed, spark.createDataFrame([(k,) for k in keys], "key string"))
    assert len(cascade.levels) > 1
    assert [k for k, yes in zip(keys, cascade.contains(keys), strict=True) if yes] == keys[::40]
    assert not url_filter.build([], spark.createDataFrame([("a",)], "key string")).contains(["a"]).any()


# ---- mixing -----------------------------------------------------------------------------------------

def test_mixture(spark):
    rng = random.Random(3)
    rows = [(k, "w " * rng.randint(1, 60), "en", rng.choices(["big", "mid", "small"], [80, 15, 5])[0]) for k in range(3000)] + [(9001, None, "en", None), (9002, "", "en", "empty"), (None, "w", "en", "big")]
    df = docs(spark, rows)
    shares = {s.source: s for s in mixing.planned(df, block_tokens=500)}
    out = mixing.mixed_rows(df, block_tokens=500).collect()
    tokens, have = Counter(), Counter()
    for i, t, _, s in rows:
        if i is not None:
            have[s] += len((t or "").split())
    for r in out:
        tokens[r.source] += r.n_tokens
    assert {r.doc_id for r in out} == {i for i, *_ in rows if i is not None}  # without a budget nothing is dropped
    assert max(Counter(r.doc_id for r in out).values()) == 2
    for name in ("big", "mid", "small"):
        s = shares["=" + name]
        assert s.tokens == have[name] and abs(tokens[name] - (s.passes * s.tokens + s.rest)) <= 60
        assert tokens[name] / have[name] <= mixing.REPETITION_LIMIT + 60 / have[name]
        assert abs(tokens[name] / sum(tokens.values()) - s.weight) < 0.01
    blocks = Counter((r.source, r.block_order) for r in out if r.epoch == 1)
    assert len(blocks) > 3
    plan = mixing.mixed_rows(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    small = mixing.mixed_rows(df, budget_tokens=5000, block_tokens=500).collect()
    assert abs(sum(r.n_tokens for r in small) - 5000) <= 3 * 60
    assert mixing.mixed_rows(df.limit(0)).count() == 0
    odd = df.withColumnRenamed("lang", "_passes").withColumnRenamed("n_chars", "_block")
    assert mixing.mixed_documents(odd).columns == odd.columns and mixing.mixed_documents(odd, block_tokens=500).count() == len(out)


def test_exponent():
    shares = [0.7, 0.2, 0.1]
    e = mixing.bisected(shares, None, 2.0, None)
    assert math.isclose(max(mixing.repetitions(shares, mixing.tempered(shares, e), None)), 2.0, rel_tol=1e-6)
    e = mixing.bisected(shares, 1.0, None, None)
    assert math.isclose(mixing.entropy(mixing.tempered(shares, e)), 1.0, rel_tol=1e-6)
    assert mixing.bisected(shares, 2.0, None, None) == 0.0 and mixing.bisected([0.5, 0.5], None, 1.0, None) == 0.0


def test_boundary_in_two_levels(spark):
    rng = random.Random(12)
    rows = [(k, " ".join("w" for _ in range(rng.randint(0, 30))), "en", "big" if k % 4 else "small") for k in range(1500)]
    shares = mixing.planned(docs(spark, rows), block_tokens=50)
    placed = mixing._placed(docs(spark, rows).select("doc_id", mixing.source_key(F.col("source")).alias("_source"), mixing.word_count(F.col("text")).alias("n_tokens")), shares, "doc_id", mixing.SEED).collect()
    for s in (s for s in shares if s.rest):
        blocks = Counter()
        for r in placed:
            if r._source == s.source:
                blocks[r._block_order] += r.n_tokens
        upto, want = 0, None
        for order in sorted(blocks):
            upto += blocks[order]
            if upto >= s.rest:
                want = order
                break
        assert s.block == want


# ---- bounds -----------------------------------------------------------------------------------------

def test_centroids_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(k, " ".join("".join(rng.choice("abcdefgh" if k % 2 else "klmnop") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(5, 40))), "xx" if k % 2 else "yy", "s") for k in range(80)]
    model = language_id.learned(docs(spark, rows))
    tf = language_id.counts(*text_bytes(pa.array([t for _, t, _, _ in rows])))
    for (_, t, _, _), row in zip(rows[:20], tf, strict=False):  # pairs and triples with a letter
        assert row.sum() == sum(any(c != " " for c in t[k : k + n]) for n in (2, 3) for k in range(len(t) - n + 1))
    got, score = model.predict(tf)
    for k, row in enumerate(tf.tolist()):
        v = [math.log1p(x) * float(i) for x, i in zip(row, model.idf, strict=True)]
        norm = math.sqrt(sum(x * x for x in v))
        cosines = [sum(a * float(b) for a, b in zip(v, c, strict=True) if a) / norm for c in model.centroids]
        best = max(range(len(cosines)), key=lambda j: (cosines[j], -j))
        assert got[k] == model.languages[best] and abs(score[k] - cosines[best]) < 1e-4


def test_sample_takes_the_least_hashes(spark, monkeypatch):
    rows = [(k, f"text {k}", "xx" if k % 3 else "yy", "s") for k in range(3000)]
    taken = []
    monkeypatch.setattr(language_id, "fit", lambda tf, langs, heads: taken.append(Counter(langs)))
    language_id.learned(docs(spark, rows), sample=40)
    assert taken == [Counter(xx=40, yy=40)]


def test_spans_that_touch_base_spans():
    text = "call 4111 1111 1111 1111 or a@b.cc, 10.0.0.1 " * 50
    base = pii.base_spans(text)
    more = pii.added_spans([text], [base], pii.trained())[0]
    assert all(not (a < y and x < b) for a, _, b in more for x, _, y in base)


def test_long_hosts_and_large_lists(spark):
    assert list(url_filter.suffixes("a." * 100_000 + "net", 2)) == ["a.net", "net"]
    assert list(url_filter.suffixes("a..b", 9)) == ["a..b", ".b", "b"] and list(url_filter.suffixes("com.", 3)) == ["com."] and list(url_filter.suffixes("", 3)) == []
    hosts = tuple(f"h{k}.example.org" for k in range(100_000))
    urls = [(0, "http://" + "a." * 100_000 + "h5.example.org/x"), (1, "http://h99999.example.org"), (2, "http://h100000.example.org"), (3, "http://net/de/1"), (4, None)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    assert {r.page_id: (r.rule, r.verdict) for r in url_filter.judged(pages, blocked_hosts=hosts).collect()} == {0: (None, "block"), 1: (None, "block"), 2: (None, "allow"), 3: ("net/de/", "allow"), 4: (None, "allow")}
