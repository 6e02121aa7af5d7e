"""Language identification by compression.

Every language gets a zstandard dictionary of raw content: texts of a bounded
sample of its training rows. A text is compressed once with each dictionary; the
one under which it becomes smallest shares most with it and names the language.
Where that is by a small margin, a thorough compressor decides instead, for texts of any size.
Margins are relative to the runner-up; a narrow one rejects the decision
(``rejected``), though the nearest language is still named.
"""

from __future__ import annotations

import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm.common import held_out, map_documents, record_batch

#: The bounded sample: documents a language, characters of each, bytes of a dictionary.
SAMPLE_DOCUMENTS = 96
SAMPLE_CHARS = 4000
DICTIONARY_BYTES = 100_000
#: Below this relative margin a decision is rejected.
NARROW = 0.01
#: Below this margin the fast compressors leave the decision to the thorough ones.
CLOSE = 0.05
UNKNOWN = "und"

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("rejected", pa.bool_()),
        ("margin", pa.float64()),
    ]
)
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-cased letters of a text, everything between them one blank."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Raw dictionary of each language, from rows that are not held out.

    Rows are drawn by a hash of their id. The number of languages, not of
    documents, bounds what reaches the driver.
    """
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("lang", F.xxhash64("doc_id").alias("h"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    # a rate at which a language's rows are thinned out before the exact cut
    bounds = {lang: min(1.0, 4 * SAMPLE_DOCUMENTS / n) for lang, n in counts.items()}
    rate = F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair))
    share = F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30)
    thinned = rows.where(share < F.element_at(rate, F.col("lang")))
    best = thinned.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("h", "text"))).alias("rows"))
    out = {}
    for lang, sample in best.select("lang", F.slice("rows", 1, SAMPLE_DOCUMENTS).alias("rows")).collect():
        raw = b" ".join(letters(r["text"]) for r in sample)[-DICTIONARY_BYTES:]
        if raw.strip():
            out[lang] = raw
    return dict(sorted(out.items()))


class Compressors:
    """One fast and one thorough compressor a language."""

    def __init__(self, raw: dict[str, bytes]):
        self.names = list(raw)
        self.fast, self.thorough = [], []
        for content in raw.values():
            for level, kept in ((3, self.fast), (19, self.thorough)):
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=level)
                kept.append(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False))

    def decide(self, text: str) -> tuple[str, float, bool, float]:
        """(language, score, rejected, margin) of one text; ``und`` without a letter."""
        data = letters(text)
        if not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True, 0.0
        sizes = [len(c.compress(data)) for c in self.fast]
        if len(sizes) > 1:
            least, next_least = sorted(sizes)[:2]
            if next_least - least < CLOSE * next_least:
                sizes = [len(c.compress(data)) for c in self.thorough]
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], self.names[i]))
        if len(order) == 1:
            return self.names[0], 1.0, False, 1.0
        least, next_least = sizes[order[0]], sizes[order[1]]
        margin = (next_least - least) / next_least
        return self.names[order[0]], margin / (margin + NARROW), margin < NARROW, margin


def identify(docs: DataFrame, raw: dict[str, bytes]) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``rejected``, ``margin`` for each row of ``docs``.

    The score is the margin mapped to 0..1, one half at the narrow margin. Null
    texts and texts without a letter are ``und`` with score 0. Ties go to the
    first name. Without dictionaries every row is ``und``. Repeated rows are
    judged apart and alike.
    """
    held: list[Compressors] = []

    def run(batch):
        if not held:
            held.append(Compressors(raw))
        rows = [held[0].decide(text or "") for text in batch.column("text").to_pylist()]
        yield record_batch(_SCHEMA, batch.column("doc_id"), *(zip(*rows) if rows else [[]] * 4))

    return map_documents(
        docs, ["doc_id", "text"], run, "doc_id long, lang_pred string, score double, rejected boolean, margin double"
    )


def language_id(docs: DataFrame) -> DataFrame:
    """Learns from the rows of ``docs`` that are not held out, then judges all rows."""
    found = identify(docs, dictionaries(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected", "margin")
