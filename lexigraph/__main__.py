"""Command line: python -m lexigraph COMMAND ...

    mentions  DOCS OUT            mentions of the records of a table with id and text_en (or text)
    relations DOCS OUT            relations, with the mentions they rest on
    graph     DOCS OUT --graph    all tables of the concept or the fact graph
    metrics   RUN OUT             every metric table of a saved run (mentions, relations)
    sentence  TEXT                one sentence's mentions and relations, on the screen

DOCS is a folder or file of Parquet or CSV; tables are written as Parquet, with --csv as CSV too.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import metrics, pipeline
from .runtime import shipped
from .sources import corpora, sinks


def documents(spark: SparkSession, path: str) -> DataFrame:
    """id and text_en of a table of records."""
    df = corpora.read_csv(spark, path) if path.rstrip("/").endswith(".csv") else spark.read.parquet(path)
    body = "text_en" if "text_en" in df.columns else "text"
    return df.select(F.col("id").cast("long").alias("id"), F.col(body).alias("text_en"))


def saved(tables: dict[str, DataFrame], out: str, csv: bool) -> None:
    """Each table under its name; refuses a folder that holds a run already."""
    sinks.snapshot(tables, out)
    if csv:
        spark = next(iter(tables.values())).sparkSession
        for name in tables:
            sinks.write_csv(spark.read.parquet(f"{out.rstrip('/')}/{name}"), f"{out.rstrip('/')}/{name}.csv")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="lexigraph", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("mentions", "relations", "graph", "metrics"):
        own = commands.add_parser(name)
        own.add_argument("source")
        own.add_argument("out")
        own.add_argument("--csv", action="store_true")
        if name == "graph":
            own.add_argument("--graph", choices=sorted(pipeline.GRAPHS), default="concept")
    commands.add_parser("sentence").add_argument("text")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("lexigraph").getOrCreate()
    shipped(spark)
    if args.command == "metrics":
        run = {name: spark.read.parquet(f"{args.source.rstrip('/')}/{name}") for name in ("mentions", "relations")}
        saved(metrics.every(run["mentions"], run["relations"]), args.out, args.csv)
        return
    docs = spark.createDataFrame([(0, args.text)], "id long, text_en string") if args.command == "sentence" else documents(spark, args.source)
    options = pipeline.Options()
    if args.command == "graph":
        saved(pipeline.full(spark, docs, options, graph=args.graph), args.out, args.csv)
        return
    found, raw = pipeline.extract_mentions(docs, options)
    tables = {"mentions": found, "raw_mentions": raw}
    if args.command != "mentions":
        tables["relations"] = pipeline.extract_relations(found, docs, options)[0]
    if args.command == "sentence":
        found.select("word", "label", "score", "method", "start", "end").orderBy("start").show(truncate=False)
        tables["relations"].select("entity1", "relation", "entity2", "method", "assertion").show(truncate=False)
        return
    saved(tables, args.out, args.csv)


if __name__ == "__main__":
    main()
