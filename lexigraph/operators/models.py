"""Models behind a plug-in interface: token classifiers, translators, embedders and text generators.

A scorer is a picklable callable over one batch; it is called once for each Arrow batch and built once for
each Python worker (`build`). Nothing is installed here: without a scorer, a method finds nothing. Answers of
generators are read by expressions in the JVM.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ontology, text
from ..runtime import written
from .dedup import first_per_key

#: () -> (texts -> for each text a list of (word, label, score, start, end))
BuildClassifier = Callable[[], Callable[[list[str]], list[list[tuple[str, str, float, int, int]]]]]
#: () -> (prompt -> answer); raises on a failed call
BuildGenerator = Callable[[], Callable[[str], str]]

_workers: dict[object, object] = {}


def once(build: Callable[[], object]) -> object:
    """The worker's only instance of what `build` makes."""
    key = getattr(build, "__qualname__", repr(build))
    if key not in _workers:
        _workers[key] = build()
    return _workers[key]


def classified(df: DataFrame, build: BuildClassifier, body: str = "text_en", method: str = "neural") -> DataFrame:
    """Mentions of a token classifier; labels in upper case, scores rounded to 4 places."""
    kind = T.ArrayType(T._parse_datatype_string("word string, label string, score double, start int, end int"))

    @F.pandas_udf(kind)
    def entities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = once(build)
        for batch in batches:
            yield pd.Series([[dict(zip(("word", "label", "score", "start", "end"), e, strict=True)) for e in found] for found in run(batch.tolist())])

    rows = df.where(text.not_blank(F.col(body))).select("id", F.col(body).alias("text_en")).withColumn("_e", entities("text_en"))
    flat = rows.select("id", "text_en", F.posexplode("_e").alias("_k", "_x"))
    return flat.select("id", "_x.word", F.upper("_x.label").alias("label"), F.bround("_x.score", 4).alias("score"), "text_en", F.lit(method).alias("method"), "_x.start", "_x.end", F.col("_k").cast("long").alias("seq"))


def mapped_text(df: DataFrame, build: Callable[[], Callable[[list[str]], list[str]]], source: str, target: str) -> DataFrame:
    """df with `target`: a model's text for `source` (a translation, say); blank gives ''. Equal texts are asked once."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = once(build)
        for batch in batches:
            yield pd.Series(model(batch.tolist()), dtype=object)

    asked = df.where(text.not_blank(F.col(source))).select(source).distinct().withColumn("_out", run(source))
    return df.join(asked, source, "left").withColumn(target, F.coalesce("_out", F.lit(""))).select(*df.columns, target)


def embedded(df: DataFrame, build: Callable[[], Callable[[list[str]], list[list[float]]]], source: str, target: str = "vector") -> DataFrame:
    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = once(build)
        for batch in batches:
            yield pd.Series(model(batch.tolist()))

    return df.withColumn(target, run(source))


def generated(prompts: DataFrame, build: BuildGenerator | None, prompt: str = "prompt", retries: int = ontology.RETRIES, wait: float = 2.0) -> DataFrame:
    """prompts with answer, status (ok, failed or unavailable) and tries. A failed call is tried again after
    wait, 2 * wait, ... seconds; without a generator every answer is '' and unavailable."""
    if build is None:
        return prompts.withColumns({"answer": F.lit(""), "status": F.lit("unavailable"), "tries": F.lit(0)})

    @F.pandas_udf("answer string, status string, tries int")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        call = once(build)
        for batch in batches:
            rows = []
            for p in batch:
                row = ("", "failed", retries + 1)
                for attempt in range(retries + 1):
                    try:
                        row = (call(p), "ok", attempt + 1)
                        break
                    except Exception:  # noqa: BLE001  whatever a remote model raises counts as a failed try
                        if attempt < retries:
                            time.sleep(wait * 2**attempt)
                rows.append(row)
            yield pd.DataFrame(rows, columns=["answer", "status", "tries"])

    return prompts.withColumn("_a", ask(prompt)).select(*prompts.columns, "_a.answer", "_a.status", "_a.tries")


def call_counts(answers: DataFrame) -> DataFrame:
    """calls, retries, failed over generated() rows."""
    return answers.agg(F.count_if(F.col("status") != "unavailable").alias("calls"), F.coalesce(F.sum(F.greatest(F.col("tries") - 1, F.lit(0))), F.lit(0)).alias("retries"), F.count_if(F.col("status") == "failed").alias("failed"))


def batched(df: DataFrame, size: int, order: list[str], within: Column | None = None) -> DataFrame:
    """df with batch and place: `size` rows in order make a batch. Numbers run within hash groups, as many as the rows
    need, so that no task sorts more than about 2 ** 16 of them."""
    return _grouped(df, size, order, within).drop("_g")


def _grouped(df: DataFrame, size: int, order: list[str], within: Column | None = None) -> DataFrame:
    """batched, with the hash group as _g."""
    group = within if within is not None else F.pmod(F.xxhash64(*order), F.lit(max(64, df.count() >> 16)))
    w = Window.partitionBy("_g").orderBy(*order)
    return df.withColumn("_g", group).withColumn("_n", F.row_number().over(w) - 1).select(*df.columns, "_g", F.concat_ws("-", "_g", F.floor(F.col("_n") / size)).alias("batch"), (F.col("_n") % size).cast("int").alias("place"))


def mention_prompts(df: DataFrame, size: int = ontology.MENTION_BATCH, labels: list[str] = ontology.ENTITY_LABELS, body: str = "text_en") -> DataFrame:
    """batch, prompt: numbered records for a generator, one answer line for each entity."""
    rows = batched(df.where(text.not_blank(F.col(body))).select("id", F.col(body).alias("text_en")), size, ["id"])
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat_ws(" || ", F.col("id").cast("string"), "text_en").alias("line")))), lambda x: x["line"]), "\n")
    head = "Find the clinical entities of each record. Answer with one line for each entity:\nid || text || LABEL || confidence\nLabels: " + ", ".join(labels) + "\nRecords (id || sentence):\n"
    return rows.groupBy("batch").agg(F.concat(F.lit(head), lines).alias("prompt"))


def parsed_mentions(answers: DataFrame, docs: DataFrame, labels: list[str] = ontology.ENTITY_LABELS, method: str = "llm") -> DataFrame:
    """Mentions from answer lines `id || text || LABEL || confidence`; unknown labels, invented ids and short lines
    go, an unreadable confidence is 0; offsets are those of the first occurrence."""
    lines = answers.select(F.posexplode(F.split("answer", "\n")).alias("_k", "_line")).withColumn("_f", F.transform(F.split("_line", r"\|\|"), lambda x: text.stripped(x))).where(F.size("_f") >= 4)
    rows = lines.select(F.get("_f", F.lit(0)).alias("_id"), F.regexp_replace(F.get("_f", F.lit(1)), "^[\"']+|[\"']+$", "").alias("word"), F.upper(F.get("_f", F.lit(2))).alias("label"), F.coalesce(F.expr("try_cast(get(_f, 3) as double)"), F.lit(0.0)).alias("score"), F.col("_k").cast("long").alias("seq"))
    known = docs.select(F.col("id"), F.col("id").cast("string").alias("_id"), "text_en")
    out = rows.where(F.col("label").isin(*labels) & text.not_blank(F.col("word"))).join(known, "_id")
    start = text.first_start(F.col("text_en"), F.col("word"))
    return out.select("id", "word", "label", F.bround("score", 4).alias("score"), "text_en", F.lit(method).alias("method"), start.cast("int").alias("start"), (start + F.length("word")).cast("int").alias("end"), "seq")


def relation_prompts(candidates: DataFrame, size: int = ontology.RELATION_BATCH) -> DataFrame:
    """batch, pairs (numbered, with their candidate rows) and prompt: `size` sentences make a batch.

    A sentence's candidates travel together with the sentence once: packed, written, and dealt once to their batches."""
    own = ["ord1", "ord2", "entity1", "entity1_label", "entity2", "entity2_label", "relations"]
    sents = written(candidates.groupBy("id", "sent", "sentence").agg(F.array_sort(F.collect_list(F.struct(*own))).alias("_c")), "candidates")
    rows = _grouped(sents, size, ["id", "sent"])
    # a batch lies in one hash group, so it is gathered where its group is
    gathered = rows.groupBy("_g", "batch").agg(F.array_sort(F.collect_list(F.struct("place", "id", "sent", "sentence", "_c"))).alias("_s"))
    keep = ["entity1", "entity1_label", "entity2", "entity2_label", "relations"]
    flat = F.flatten(F.transform("_s", lambda s: F.transform(s["_c"], lambda c: F.struct(s["id"].alias("id"), s["sent"].alias("sent"), s["sentence"].alias("sentence"), *(c[k].alias(k) for k in keep)))))
    pairs = F.transform(F.col("_flat"), lambda x, i: F.struct((i + 1).alias("idx"), *(x[k].alias(k) for k in ("id", "sent", "sentence", *keep))))
    line = lambda p: F.concat(p["idx"].cast("string"), F.lit(". ["), p["sentence"], F.lit('] "'), p["entity1"], F.lit('" ('), p["entity1_label"], F.lit(') -> "'), p["entity2"], F.lit('" ('), p["entity2_label"], F.lit("): "), F.array_join(p["relations"], ", "))
    head = "Choose for each numbered pair one of its own relations, or NO_RELATION, judged by its own sentence.\nAnswer with one line for each pair: number. RELATION | confidence\n"
    return gathered.select("batch", flat.alias("_flat")).select("batch", pairs.alias("pairs")).select("batch", "pairs", F.concat(F.lit(head), F.array_join(F.transform("pairs", line), "\n")).alias("prompt"))


def parsed_relations(answers: DataFrame, method: str = "llm", threshold: float = ontology.GENERATED_THRESHOLD) -> DataFrame:
    """Relations from answer lines `number. RELATION | confidence` (split at the last bar). Lines are matched by
    number; only if an answer has no numbered line at all, by position. Relations that a pair doesn't offer and
    scores under the threshold go."""
    lines = F.filter(F.split("answer", "\n"), lambda x: F.contains(x, F.lit("|")))
    read = F.transform(
        lines,
        lambda x, k: F.struct(
            F.nullif(F.regexp_extract(x, r"^\s*(\d+)\s*[.)]", 1), F.lit("")).cast("int").alias("number"), (k + 1).cast("int").alias("position"),
            F.upper(text.stripped(F.regexp_extract(x, r"^(?:\s*\d+\s*[.)])?\s*(.*)\|[^|]*$", 1))).alias("relation"), text.stripped(F.regexp_extract(x, r"\|([^|]*)$", 1)).alias("score"),
        ),
    )
    rows = answers.select("batch", "pairs", read.alias("_r")).withColumn("_numbered", F.exists("_r", lambda r: r["number"].isNotNull()))
    number = lambda r: F.when(F.col("_numbered"), r["number"]).otherwise(r["position"])
    # a line takes its pair along from its own row; pairs are numbered from 1 without gaps
    said = F.transform("_r", lambda r: F.struct(number(r).alias("idx"), r["position"].alias("_p"), F.struct(r["relation"].alias("relation"), F.coalesce(r["score"].try_cast("double"), F.lit(0.0)).alias("score")).alias("_s"), F.get("pairs", number(r) - 1).alias("_c")))
    placed = rows.select("batch", F.inline(said)).where("_c is not null")
    last = first_per_key(placed, ["batch", "idx"], [F.desc("_p")])
    out = last.where(F.expr("array_contains(_c.relations, _s.relation)") & (F.col("_s.score") >= threshold)).select("_c.*", "_s")
    return out.select("id", "entity1", "entity1_label", F.col("_s.relation").alias("relation"), "entity2", "entity2_label", F.bround("_s.score", 4).alias("score"), "sentence", F.lit(method).alias("method"), F.struct("sent", "idx").alias("seq"))
