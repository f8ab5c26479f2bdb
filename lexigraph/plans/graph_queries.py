"""Questions to the fact graph, as joins over its vertex and edge tables.

All take (facts, concepts, patients, edges) as needed; by default only confirmed facts count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..runtime import cut


def current(facts: DataFrame, confirmed: bool = True, active: bool = False) -> DataFrame:
    out = facts.where("verificationStatus = 'confirmed'") if confirmed else facts
    return out.where("clinicalStatus = 'active'") if active else out


def has_term(term: str, *columns: str) -> Column:
    """Whether one of the columns contains the term, whatever the case."""
    out = F.lit(False)
    for c in columns:
        out = out | F.contains(F.lower(F.col(c)), F.lit(term.lower()))
    return out


def of_patients(facts: DataFrame, edges: DataFrame) -> DataFrame:
    """facts with patient, along SUBJECT edges."""
    return facts.join(edges.where("type = 'SUBJECT'").select(F.col("start_key").alias("key"), F.col("end_key").alias("patient")), "key")


def with_codes(facts: DataFrame, edges: DataFrame, concepts: DataFrame) -> DataFrame:
    """facts with concept and concept_name, along HAS_CODE edges."""
    codes = edges.where("type = 'HAS_CODE'").select(F.col("start_key").alias("key"), F.col("end_key").alias("concept"))
    return facts.join(codes, "key").join(concepts.select(F.col("key").alias("concept"), F.col("name").alias("concept_name")), "concept")


def patients_with(facts: DataFrame, concepts: DataFrame, edges: DataFrame, term: str, resource: str = "Condition") -> DataFrame:
    """patient: who has a fact of the resource whose concept or word has the term."""
    rows = with_codes(of_patients(current(facts.where(F.col("resource") == resource)), edges), edges, concepts)
    return rows.where(has_term(term, "concept_name", "word")).select("patient").distinct()


def average_age(facts: DataFrame, concepts: DataFrame, edges: DataFrame, patients: DataFrame, term: str, resource: str = "Condition") -> DataFrame:
    """avg_age over the facts that match (one for each fact, so a patient may count more than once)."""
    rows = with_codes(of_patients(current(facts.where(F.col("resource") == resource)), edges), edges, concepts).where(has_term(term, "concept_name", "word"))
    return rows.join(patients.select(F.col("key").alias("patient"), text.leading_number(F.col("age")).alias("age")), "patient").agg(F.avg("age").alias("avg_age"))


def scale_count(facts: DataFrame, edges: DataFrame, pattern: str) -> DataFrame:
    """n_patients with a fact whose word matches the pattern as a whole, whatever the case."""
    return of_patients(current(facts), edges).where(F.col("word").rlike(f"(?is)^(?:{pattern})$")).agg(F.countDistinct("patient").alias("n_patients"))


def with_term(facts: DataFrame, term: str) -> DataFrame:
    """fact, word of the confirmed facts with the term."""
    return current(facts).where(has_term(term, "name", "word")).select(F.col("key").alias("fact"), "word")


def with_site(facts: DataFrame, concepts: DataFrame, edges: DataFrame, term: str, along: tuple[str, ...] = ("LOCATED_IN", "AFFECTS")) -> DataFrame:
    """fact, word, site: facts with the term, with the concept of the place they are linked to, if there is one."""
    found = with_term(facts, term)
    steps = edges.where(F.col("type").isin(*along)).select(F.col("start_key").alias("fact"), F.col("end_key").alias("key"))
    codes = edges.where("type = 'HAS_CODE'").select(F.col("start_key").alias("key"), F.col("end_key").alias("concept"))
    sites = steps.join(codes, "key").join(concepts.select(F.col("key").alias("concept"), F.col("name").alias("site")), "concept").select("fact", "site")
    return found.join(sites, "fact", "left")


#: What bundles must carry of their facts for bundled_sites.
SITE_COLUMNS = ("code_key", "word", "name", "verificationStatus")


def bundled_sites(facts: DataFrame, concepts: DataFrame, bundles: DataFrame, singles: DataFrame, term: str, along: tuple[str, ...] = ("LOCATED_IN", "AFFECTS")) -> DataFrame:
    """with_site over bundles that carry SITE_COLUMNS. Only a bundle's codes meet the concepts; a row for each edge is laid out
    last, and nothing that grows with the pairs of facts is exchanged."""
    names = concepts.select(F.col("key").alias("concept"), F.col("name").alias("site"))
    wanted = lambda x: (x["verificationStatus"] == "confirmed") & (F.contains(F.lower(x["name"]), F.lit(term.lower())) | F.contains(F.lower(x["word"]), F.lit(term.lower())))
    own = bundles.where(F.col("type").isin(*along)).select(
        F.transform(F.filter("_starts", wanted), lambda x: F.struct(x["key"].alias("fact"), x["word"].alias("word"))).alias("_found"), F.transform("_ends", lambda x: x["code_key"]).alias("_codes")
    )
    codes = own.where(F.size("_found") > 0).select("_found", "_codes", F.explode(F.array_distinct("_codes")).alias("concept"))
    # one place for each of the bundle's ends with that code
    times = codes.select("_found", "concept", F.filter("_codes", lambda c: c == F.col("concept")).alias("_times"))
    sited = cut(times.join(names, "concept").select("_found", "_times", "site"))
    laid = sited.select("_times", "site", F.inline("_found")).select("fact", "word", "site", F.explode("_times")).select("fact", "word", "site")
    found = with_term(facts, term)
    steps = singles.where(F.col("type").isin(*along)).select(F.col("start_key").alias("fact"), F.col("end_key").alias("key"))
    coded = singles.where("type = 'HAS_CODE'").select(F.col("start_key").alias("key"), F.col("end_key").alias("concept"))
    alone = cut(found.join(steps, "fact").join(coded, "key").join(names, "concept").select("fact", "word", "site"))
    known = sited.select(F.explode("_found.fact").alias("fact")).unionByName(alone.select("fact")).distinct()
    without = found.join(known, "fact", "left_anti").select("fact", "word", F.lit(None).cast("string").alias("site"))
    return laid.unionByName(alone).unionByName(without)


def family_history(facts: DataFrame, edges: DataFrame, term: str) -> DataFrame:
    """patient, relative, word of family facts with the term."""
    rows = of_patients(facts.where("resource = 'FamilyMemberHistory'"), edges).where(has_term(term, "name", "word"))
    return rows.select("patient", "relative", "word").distinct()


def with_assertion(facts: DataFrame, status: str) -> DataFrame:
    """Facts whose (possibly composite) assertion has the status."""
    return facts.where(F.contains("assertion", F.lit(status)))


def measured(facts: DataFrame, field: str, at_least: float, unit: str) -> DataFrame:
    """key, number, unit of facts whose field is a number of that unit, not under at_least."""
    rows = facts.select("key", text.leading_number(F.col(field)).alias("number"), text.unit_after_number(F.col(field)).alias("unit"))
    return rows.where((F.lower("unit") == unit.lower()) & (F.col("number") >= at_least))


def chains(edges: DataFrame, relation: str | None = "LOCATED_IN", longest: int | None = None) -> DataFrame:
    """start_key, end_key, hops: the shortest chain of edges of one type (None: of any) between two facts, of any length, or up to
    `longest` hops. A join for each length until no new pair is met, so cycles end too."""
    step = cut((edges if relation is None else edges.where(F.col("type") == relation)).select("start_key", "end_key").distinct())
    reach = new = step.withColumn("hops", F.lit(1))
    n = 1
    while longest is None or n < longest:
        n += 1
        further = new.select("start_key", F.col("end_key").alias("_m")).join(step.withColumnRenamed("start_key", "_m"), "_m").select("start_key", "end_key").distinct()
        new = cut(further.join(reach.select("start_key", "end_key"), ["start_key", "end_key"], "left_anti").withColumn("hops", F.lit(n)))
        if new.isEmpty():
            break
        reach = reach.unionByName(new)
    return reach


def bundled_chains(bundles: DataFrame, singles: DataFrame, relation: str = "LOCATED_IN") -> DataFrame:
    """hops, n: how many pairs of facts have a shortest chain of so many edges, as chains() finds them.

    The facts of one side of a bundle have the same edges, so chains run between sides, and a chain counts for all pairs of
    their facts; facts of single edges stand for themselves."""
    own, alone = bundles.where(F.col("type") == relation), singles.where(F.col("type") == relation)
    name = lambda k: F.to_json(F.struct("source_id", *(F.col(f"_{k}{c}").alias(c) for c in "wl")))
    sides = cut(own.select(name("s").alias("start_key"), name("e").alias("end_key"), F.size("_starts").alias("_n1"), F.size("_ends").alias("_n2")).unionByName(alone.select("start_key", "end_key", F.lit(1).alias("_n1"), F.lit(1).alias("_n2"))))
    sizes = sides.select(F.inline(F.array(*(F.struct(F.col(k).alias("key"), F.col(n).cast("long").alias("_n")) for k, n in (("start_key", "_n1"), ("end_key", "_n2")))))).distinct()
    found = chains(sides, None)
    of = lambda k, n: sizes.select(F.col("key").alias(k), F.col("_n").alias(n))
    return found.join(of("start_key", "_s"), "start_key").join(of("end_key", "_e"), "end_key").groupBy("hops").agg(F.sum(F.col("_s") * F.col("_e")).alias("n"))


def concept_hubs(facts: DataFrame, edges: DataFrame, concepts: DataFrame) -> DataFrame:
    """concept, concept_name, n_patients, n_facts: how many patients share a concept."""
    return with_codes(of_patients(facts, edges), edges, concepts).groupBy("concept", "concept_name").agg(F.countDistinct("patient").alias("n_patients"), F.count("*").alias("n_facts"))


def as_views(**tables: DataFrame) -> None:
    """Registers the graph's tables under their names, so that questions can be plain SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
