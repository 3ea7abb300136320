"""From raw documents to a training mix: five stages, each one operator of ``flowlens.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the
last return the columns of ``documents``. From the near-duplicates on, a
document is known by a hash of its whole row, not by its ``doc_id``: rows with
a null ``doc_id``, and rows that repeat one, are documents of their own. Rows
that are equal in every column are near-duplicates of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.llm.common import read_table, shared_table
from flowlens.llm.decontam import contained_items
from flowlens.llm.line_dedup import line_dedup
from flowlens.llm.mixing import mix_sources
from flowlens.llm.queries import remainder
from flowlens.llm.simhash import simhash_components
from flowlens.llm.toxicity import fit, score_toxicity

#: No SQL expresses the classifier, the fingerprints and the sampling: the
#: stages are tested against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below their language's threshold."""
    fitted = fit(docs, read_table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return score_toxicity(docs, fitted).where(~F.col("flagged")).select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that other documents keep."""
    return line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def row_key(names: list[str]) -> Column:
    """A 64-bit hash of the columns; nulls, which the hash skips, count by their place."""
    return F.xxhash64(*[x for n in names for x in (F.col(n), F.col(n).isNull())]).alias("__key")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id (nulls last)."""
    keyed = docs.select("*", row_key(docs.columns))
    groups = simhash_components(keyed, id_col="__key", k=3, max_bits=3).select(F.col("id").alias("__key"), "component").distinct()
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__key")).alias("least")
    kept = keyed.select("__key", "doc_id").distinct().join(groups, "__key").groupBy("component").agg(least).select("least.__key")
    rest = [c for c in docs.columns if c != "doc_id"]
    return (keyed.join(kept, "__key", "left_semi")  # equal rows are left; one of them stays
            .groupBy("__key", "doc_id").agg(F.min(F.struct(*rest)).alias("__row"))
            .select("doc_id", "__row.*").select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    keyed = docs.select("*", row_key(docs.columns))
    found = contained_items(keyed, read_table(spark, sf_dir, "benchmark"), id_col="__key").select(F.col("id").alias("__key")).distinct()
    return keyed.join(found, "__key", "left_anti").select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of copies to take of each."""
    added = ["size", "source_size", "target", "copies", "taken"]
    keyed = docs.select("*", row_key(docs.columns))
    # equal rows are units of their own, told apart by number
    units = (mix_sources(keyed, id_col="__key").groupBy(F.col("id").alias("__key"))
             .agg(F.sort_array(F.collect_list(F.struct("copies", *[c for c in added if c != "copies"]))).alias("__units")))
    number = F.row_number().over(Window.partitionBy("__key").orderBy("__key"))
    return (keyed.join(units.where(F.exists("__units", lambda u: u["copies"] > 0)), "__key")
            .withColumn("__unit", F.element_at("__units", number)).where("__unit.copies > 0")
            .select(*[c for c in docs.columns if c not in added], *[F.col(f"__unit.{c}").alias(c) for c in added]))


STAGES = [("toxicity", toxicity), ("line dedup", lines), ("SimHash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("mixing sources", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
