"""Quality classifier: boosted trees over statistics of whole documents.

Statistics of every document are taken in one pass and stored as a few numbers
a row; learning and scoring read those. The trees are learnt from a bounded
sample of labelled rows, drawn by a hash of their id.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm import boosting, quality_rules
from dosewright.llm.common import as_texts, held_out, map_documents, record_batch
from dosewright.session import stored

#: Labelled rows learnt from, at most.
SAMPLE_ROWS = 20_000
#: From this score on a document is predicted to be good.
THRESHOLD = 0.3

FEATURES = (
    "words", "word_length", "word_spread", "distinct", "top_share", "same_as_before", "symbols", "bars", "marks",
    "upper_words", "upper_letters", "digits", "letters", "sentence_ends", "lines", "line_words", "repeated_lines",
    "repeated_words", "run_coverage", "line_coverage", "compressed", "longest_word", "entropy",
)
_STATS = pa.schema([("doc_id", pa.int64()), ("stats", pa.binary())])
_UPPER, _DIGIT, _LETTER = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d"), re.compile(r"[^\W\d_]")


def statistics(text: str) -> list[float]:
    """The features of one text; zeros where it has no words."""
    words = quality_rules.WORDS.findall(text)
    n, chars = len(words), max(len(text), 1)
    if not n:
        return [0.0] * len(FEATURES)
    _, total, symbols, dup_lines, repeated, _, _, run_coverage, line_coverage, _ = quality_rules.measure(text)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
    counts = Counter(words)
    share = np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) / n
    letters = len(_LETTER.findall(text))
    lines = text.split("\n")
    data = text.encode("utf-8", "replace")
    return [
        np.log1p(n),
        total / n,
        float(lengths.std()),
        len(counts) / n,
        float(share.max()),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        symbols / n,
        text.count("|") / n,
        (text.count("!") + text.count("?")) / n,
        sum(map(str.isupper, words)) / n,
        len(_UPPER.findall(text)) / max(letters, 1),
        len(_DIGIT.findall(text)) / chars,
        letters / chars,
        (text.count(". ") + text.count(".\n")) / n,
        np.log1p(len(lines)),
        n / len(lines),
        dup_lines / len(lines),
        repeated / n,
        run_coverage,
        line_coverage,
        len(zlib.compress(data, 1)) / max(len(data), 1),
        float(lengths.max()),
        float(-(share * np.log(share)).sum()),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): the features as little-endian doubles."""

    def run(batch):
        packed = [np.array(statistics(t), dtype="<f8").tobytes() for t in as_texts(batch.column("text"))]
        yield record_batch(_STATS, batch.column("doc_id"), packed)

    return map_documents(docs, ["doc_id", "text"], run, "doc_id long, stats binary")


def matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), dtype="<f8").reshape(-1, len(FEATURES))


def sample(rows: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows, those of smallest hash of ``doc_id``; all rows if there are no more."""
    n = rows.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # thinned out first, so that few more rows than the limit are sorted
    return rows.where(share < min(1.0, 1.2 * limit / max(n, 1))).orderBy(F.xxhash64("doc_id"), *rows.columns).limit(limit)


def learn(stats: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> boosting.Trees:
    """Trees from labelled rows that are not held out; rows with a null label are passed over."""
    known = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    rows = sample(stats.join(known, "doc_id"), limit).select("stats", "quality").collect()
    x = matrix([r[0] for r in rows])
    return boosting.fit(x, np.array([r[1] for r in rows], dtype=np.float64))


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for each row of ``docs``.

    ``labels`` has ``doc_id`` and ``quality``. Null and empty texts have the
    statistics zero and are scored like any other; repeated rows are scored
    alike. Without usable labels all scores are the prior (one half).
    """
    stats = stored(document_statistics(docs), "statistics")
    trees = learn(stats, labels, limit)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batch):
        yield record_batch(schema, batch.column("doc_id"), trees.score(matrix(batch.column("stats").to_pylist())))

    scored = map_documents(stats, ["doc_id", "stats"], run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
