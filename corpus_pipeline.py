"""The corpus pipeline: five training-data operators in a row, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns the kept documents with the columns of
``documents`` (texts may be shorter; ``n_chars`` follows the text); the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.decontaminate import template_leaks
from folio.llm.jaccard_join import grouped_prefix_join
from folio.llm.line_dedup import line_dedup
from folio.llm.packing import best_fit_packing
from folio.llm.quality import co_trained_quality
from folio.llm.storage import written

NEAR_WORDS, NEAR_PERCENT = 5, 80  # shingles and similarity of the near-duplicate stage
ORACLE_SQL = None  # a classifier, similarity components and a tokenizer are beyond SQL; see tests/llm


def _packed(docs: DataFrame, *more: F.Column) -> DataFrame:
    """All columns of the documents in one struct ``d``, beside (id, crc): no name of theirs can clash with the stage's own."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col("doc_id").alias("id"), crc.alias("crc"), *more)


def _beside(judged: DataFrame, *more: str) -> DataFrame:
    """Decisions by id and text, joined by shuffle at every size: their number grows with the documents. Texts among them are sorted, which can spill."""
    rows = judged.select(F.col("doc_id").alias("judged_id"), F.col("crc").alias("judged_crc"), *more)
    return rows.hint("merge" if more else "shuffle_hash")


_SAME = "id <=> judged_id and crc = judged_crc"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = written(spark, co_trained_quality(spark, docs, labels).filter("predicted = 0").select("doc_id", "crc").distinct(), "stage-quality")
    return _packed(docs).join(_beside(rejected), F.expr(_SAME), "left_anti").select("d.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: frequent lines go from all documents but one."""
    kept = line_dedup(spark, docs, with_text=True).filter("n_dropped > 0").select("doc_id", "crc", "kept_text")
    kept = written(spark, kept.dropDuplicates(["doc_id", "crc"]), "stage-lines")
    joined = _packed(docs).join(_beside(kept, "kept_text"), F.expr(_SAME), "left")
    text = F.coalesce("kept_text", "d.text")
    size = F.when(F.col("kept_text").isNull(), F.col("d.n_chars")).otherwise(F.length("kept_text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*[text.alias(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(f"d.`{c}`") for c in docs.columns])


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(d, id, crc, row) with a number for each row that every scan repeats: from a Parquet row's file and place in it.

    Two rows are taken for one only if number and crc agree, some 96 bits. Documents that aren't read straight from files are written first.
    """
    try:
        return _packed(docs, F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row"))
    except AnalysisException:
        return written(spark, _packed(docs, F.monotonically_increasing_id().alias("row")), "stage-near-rows")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3 on shingles of five words from a similarity of 0.8: of each group of linked documents one row stays.

    It is the one with the smallest id; of several rows with that id the one with the smallest crc, and one of equal rows. A null id counts as the
    largest. Texts without words are linked with nothing and stay.

    Three words and 0.9 is the contract of op3's query alone.
    """
    numbered = _numbered(spark, docs)
    joined = grouped_prefix_join(spark, numbered.select("row", "d.text"), id_col="row", size=NEAR_WORDS, percent=NEAR_PERCENT)
    group = joined.select(F.col("doc_id").alias("row"), "crc", F.col("component_id").alias("group"))
    order = F.struct(F.col("id").isNull().alias("unknown"), "id", "crc", "row")
    ranked = numbered.select("row", "id", "crc").join(group, ["row", "crc"])
    kept = written(spark, ranked.groupBy("group").agg(F.min(order).alias("first")).select("first.row", "first.crc"), "stage-near")
    return numbered.join(kept.hint("shuffle_hash"), ["row", "crc"], "left_semi").select("d.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a benchmark item go."""
    leaks = template_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = written(spark, leaks.select("doc_id", "crc").distinct(), "stage-leaks")
    return _packed(docs).join(_beside(leaked), F.expr(_SAME), "left_anti").select("d.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: all documents left, packed into sequences."""
    return best_fit_packing(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality), ("line_dedup", lines), ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination), ("best_fit_packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
