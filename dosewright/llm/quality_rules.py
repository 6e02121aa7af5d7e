"""Quality rules on repetition: how much of a text lies inside duplicated word runs and lines.

Words of a document become small numbers, numbers become random 64-bit values,
and hashes of word runs of length n are rolled from those of length n - 1. Runs
of equal hash are compared word by word, so no hash decides alone. One pass,
no shuffle; memory is bounded by one Arrow batch and one document.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dosewright.llm.common import SPACE, as_texts, map_documents, record_batch, short_batches

WORDS = re.compile("[^\\x20\\x09-\\x0D]+")
SYMBOLS = "#*$%&|<>"

#: Run lengths, and the share of a text's word characters that may lie inside
#: duplicated runs of that length.
RUN_LIMITS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
#: Share of word characters in repeated lines, and symbols for each word, that a text may have.
LINE_LIMIT = 0.30
SYMBOL_LIMIT = 0.10
#: Of the words of a text, the share that may end in "!!".
SHOUT_LIMIT = 0.30

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("run_coverage", pa.float64()),
        ("line_coverage", pa.float64()),
        ("reason", pa.string()),
    ]
)
DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, run_coverage double, line_coverage double, reason string"
)

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _scatter(ids: np.ndarray) -> np.ndarray:
    """A fixed random-looking 64-bit value for each small number."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _repeated(ids: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Starts of the runs of ``n`` words that stand in the text at least twice."""
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    if not len(same):
        return same
    left, right = order[same], order[same + 1]
    equal = np.ones(len(same), dtype=bool)
    for k in range(n):
        equal &= ids[left + k] == ids[right + k]
    if not equal.all():  # two different runs of one hash: compare the runs themselves
        rows = np.lib.stride_tricks.sliding_window_view(ids, n)
        _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        return np.flatnonzero(counts[inverse.ravel()] > 1)
    starts = np.zeros(len(hashes), dtype=bool)
    starts[left] = starts[right] = True
    return np.flatnonzero(starts)


def _inside(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie inside a run of ``n`` words that begins at ``starts``."""
    edges = np.zeros(words + 1, dtype=np.int64)
    edges[starts] += 1
    np.subtract.at(edges, starts + n, 1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: str) -> tuple:
    """Figures of one text, in the order of the schema without the id."""
    words = WORDS.findall(text)
    n = len(words)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    chars = np.fromiter(map(len, words), dtype=np.int64, count=n)
    total = int(chars.sum())
    symbols = sum(map(text.count, SYMBOLS))

    seen: set[str] = set()
    dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(map(len, WORDS.findall(line)))
        elif line.strip(SPACE):
            seen.add(line)

    repeat_words, run_coverage, reason = 0, 0.0, None
    longest = max(RUN_LIMITS)
    if n >= min(RUN_LIMITS):
        values = _scatter(ids)
        hashes = values
        for length in range(2, min(longest, n) + 1):
            hashes = hashes[:-1] * _ODD + values[length - 1 :]
            if length not in RUN_LIMITS:
                continue
            starts = _repeated(ids, hashes, length)
            if not len(starts):
                break
            covered = _inside(starts, length, n)
            if length == min(RUN_LIMITS):
                repeat_words = int(covered.sum())
            share = float(chars[covered].sum()) / total
            run_coverage = max(run_coverage, share)
            if share > RUN_LIMITS[length] and reason is None:
                reason = f"runs of {length} words repeat"
    line_coverage = dup_line_chars / total if total else 0.0
    if line_coverage > LINE_LIMIT:
        reason = reason or "lines repeat"
    if n and symbols > SYMBOL_LIMIT * n:
        reason = reason or "symbols"
    if n and sum(w.endswith("!!") for w in words) > SHOUT_LIMIT * n:
        reason = reason or "shouting"
    failed = n < 10 or 100 * repeat_words > 20 * n
    if failed:
        reason = "too few words" if n < 10 else "word runs repeat"
    return (
        n, total, symbols, dup_lines, repeat_words, failed, reason is None,
        run_coverage, line_coverage, reason,
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with its figures and the verdict ``kept``.

    A null or empty text has no words and fails; repeated rows are measured
    apart; other columns are ignored. An empty table gives an empty result.
    """

    def measured(batch):
        rows = [measure(text) for text in as_texts(batch.column("text"))]
        yield record_batch(SCHEMA, batch.column("doc_id"), *(zip(*rows) if rows else [[]] * (len(SCHEMA) - 1)))

    return map_documents(docs, ["doc_id", "text"], measured, DDL)


def quality_rules_kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with their columns as they are.

    The figures are taken where the row is, so nothing is joined or shuffled.
    """

    def kept(batches):
        for batch in batches:
            verdicts = [measure(text)[6] for text in as_texts(batch.column("text"))]
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return short_batches(docs).mapInArrow(kept, docs.schema)
