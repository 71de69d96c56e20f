"""The registered queries of the subpackage: each applies one operator to
its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propval.llm import collocations, decontaminate, hmm, jaccard, langid, licenses, mixing, negatives, quality, render, rotation, suffixes, warc
from propval.session import workers_import

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_import(spark)
            return fn(spark, sf_dir)
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition coverage and base counts of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs).drop("text")


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_suffix_array_dedup")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 100-byte strings that start earlier leave of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.deduplicate(docs).drop("text", "kept_text")


@query("op6_jaccard_join")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of Jaccard 0.9 or more."""
    return jaccard.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    net = langid.fit(docs.where(~langid.held_out("doc_id", 3) & F.col("doc_id").isNotNull()))
    asked = docs.select("doc_id", langid.held_out("doc_id", 3).alias("held_out"), "text")
    return langid.identify(asked, net).drop("text")


@query("op4_hmm_lm")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under the hidden Markov model."""
    return hmm.score(table(spark, sf_dir, "documents"), langid.held_out("doc_id", 5))


@query("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and the benchmark items that it contains."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_perspective_rotation", rotation.ORACLE)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant."""
    return rotation.digest(rotation.rotate(table(spark, sf_dir, "conversations")))


@query("op8_html_rendering")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page, laid out."""
    return render.render_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


@query("op5_license_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op13_collocations", collocations.ORACLE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", negatives.ORACLE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives that score nearly as high as an anchor's positives."""
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query("op12_warc", warc.ORACLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, as the archives that are written of them give it back."""
    return warc.pages_digest(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
