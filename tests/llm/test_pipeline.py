import os
import random

import numpy as np
import pytest

pipeline = pytest.importorskip("corpus_pipeline")

from lexigraph.llm import mixing  # noqa: E402
from lexigraph.llm.queries import tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(11)
    parts = {"xx": ["ka", "lo", "mi", "sen"], "yy": ["zu", "erg", "tch", "aff"]}
    word = lambda lang: "".join(rng.choice(parts[lang]) for _ in range(rng.randint(2, 4)))
    rows = []
    for k in range(120):
        lang = rng.choice(list(parts))
        rows.append((k, " ".join(word(lang) for _ in range(rng.randint(20, 80))), lang, "hot" if k % 3 == 0 else f"s{k % 5}"))
    for k in range(30):  # exact copies up to white space, and near copies
        _, text, lang, _ = rows[k]
        rows.append((200 + k, text.replace(" ", "  \n"), lang, "s1"))
        words = text.split()
        rows.append((300 + k, " ".join(words[:-1] + ["kalo"]), lang, "s2"))
    return rows + [(400, None, "xx", "s1"), (401, "", "xx", None), (402, "12 !!", None, "s1")]


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept, columns = spark.read.parquet(str(tmp_path / "documents.parquet")), {}, SCHEMA.count(",") + 1
    for k, (name, stage) in enumerate(pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert len(docs.columns) == columns
        docs.write.parquet(str(tmp_path / f"stage{k}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{k}"))
        kept[name] = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    ids = {name: sorted(i for i, _, _ in own) for name, own in kept.items()}
    assert ids["language"] == sorted(i for i, *_ in rows if i < 400)
    norm = {}
    for i, t, _ in sorted(kept["language"]):
        norm.setdefault(" ".join(t.split()), i)
    assert ids["exact"] == sorted(norm.values())
    sets = {}
    for i, t, _ in kept["exact"]:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    assert ids["near"] == sorted({root(i) for i in sets})
    assert set(ids["mix"]) == set(ids["near"]) and max(map(ids["mix"].count, ids["near"])) <= 2
    shares = mixing.planned(spark.read.parquet(str(tmp_path / "stage2")))
    assert abs(sum(len(t.split()) for _, t, _ in kept["mix"]) - sum(s.passes * s.tokens + s.rest for s in shares)) <= 80 * len(shares)
    from tokenizers import Tokenizer

    if not os.path.exists(tokenizer_path()):
        pytest.skip("no vocabulary file")
    library = Tokenizer.from_file(tokenizer_path())
    text = {i: t for i, t, _ in kept["mix"]}
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == ids["mix"]
    assert all(np.array_equal(r.input_ids, library.encode(text[r.doc_id], add_special_tokens=False).ids) and r.n_tokens == len(r.input_ids) for r in out)


def test_stages_pass_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0
