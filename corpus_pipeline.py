"""From raw documents to packed sequences: five stages, each written before the next reads it.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. Part of the ``dosewright.llm`` operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dosewright.llm import near_copies
from dosewright.llm.line_dedup import line_dedup
from dosewright.llm.mixing import mixed_documents
from dosewright.llm.packing import packed_documents
from dosewright.llm.quality_rules import quality_rules_kept
from dosewright.session import stored

#: A source stands in the mix twice at most; the largest stands there once.
MAX_EPOCHS = 2.0
#: What line dedup adds or replaces.
LINE_COLUMNS = ("n_lines", "n_dropped", "drops")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules_kept(docs)


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of an earlier one; those left without a word go."""
    clashing = {c: f"__own_{c}" for c in docs.columns if c in LINE_COLUMNS}
    cut = line_dedup(docs.withColumnsRenamed(clashing)).drop(*LINE_COLUMNS)
    cut = cut.withColumnsRenamed({inside: c for c, inside in clashing.items()})
    cut = cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return cut.where(F.col("text").rlike("[^\\x20\\x09-\\x0D]")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (SimHash within two bits; five words, 0.8), the one of the smallest id."""
    return near_copies.without_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources holds them, each at least once."""
    return mixed_documents(docs, max_epochs=MAX_EPOCHS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents and their places in sequences."""
    return packed_documents(docs)


STAGES = [
    ("quality rules", good_documents),
    ("line dedup", without_shared_lines),
    ("simhash near-dedup", without_near_copies),
    ("mixing sources", mixed),
    ("best-fit packing", packed),
]

#: Tokenizing, fingerprints and quality figures are not SQL; a brute-force version checks them in tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
