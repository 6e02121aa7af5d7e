"""Line deduplication: lines that several documents share stay in one of them only.

Two Bloom filters tell keys seen once from keys seen twice. At corpus size
neither fits one machine, so both are cut into hash ranges:

1. Each task reads its documents once with a small filter of its own. The first
   sighting of a key goes, as a 16-byte digest with its document's number, to the
   range the digest falls in; every later sighting is a suspect already and needs
   no test. A batch with later sightings of a key sends one mark to its range; no
   filter holds marks back, as a mark left out could lose the first sighting.
2. A range's task fills its pair of filters from what all tasks sent and lets
   through the sightings whose key is in the twice-seen filter.
3. Only these suspects are shuffled again, for the exact answer: the 16-byte
   digests are grouped, a key needs two different documents, and the smallest
   document keeps its lines. What false positives let in ends here.
4. Digests to drop are joined to the documents, the one time texts move.

Filters never decide; a full filter costs time, not correctness. Lines travel as
BLAKE2b digests of 128 bits, so keys count as equal when those are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from dosewright.llm.common import as_bytes, record_batch, short_batches
from dosewright.session import stored

MIN_CODE_POINTS = 10
#: Bits of a filter for each key expected in it, and keys expected in a task's own filter.
BITS_FOR_KEY = 16
TASK_KEYS = 1 << 18
#: Documents whose sightings one range is laid out for.
DOCUMENTS_OF_A_RANGE = 1 << 15

_STRIP = b" \t\n\x0b\x0c\r"
_SIGHTING = pa.schema([("shard", pa.int32()), ("kind", pa.int8()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64())])
_FIRST, _MARK, _SUSPECT = 0, 1, 2


class Bloom:
    """A bit array with three positions for each 128-bit digest."""

    def __init__(self, keys: int):
        self.mask = np.uint64((1 << max(10, (keys * BITS_FOR_KEY - 1).bit_length())) - 1)
        self.bits = np.zeros((int(self.mask) + 1) // 8, dtype=np.uint8)

    def _positions(self, h1: np.ndarray, h2: np.ndarray) -> list[np.ndarray]:
        a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
        return [(a + np.uint64(k) * b) >> np.uint64(7) & self.mask for k in range(3)]

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        for p in self._positions(h1, h2):
            np.bitwise_or.at(self.bits, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        found = np.ones(len(h1), dtype=bool)
        for p in self._positions(h1, h2):
            found &= (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


def line_key(line: bytes) -> bytes | None:
    """Key of a lower-cased line; None if it is too short to count."""
    key = line.strip(_STRIP)
    size = len(key)
    if size < MIN_CODE_POINTS or size < 4 * MIN_CODE_POINTS and len(key.decode("utf-8", "replace")) < MIN_CODE_POINTS:
        return None
    return key


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _lead(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """True at the first occurrence of each digest."""
    order = np.lexsort((h2, h1))
    new = np.ones(len(h1), dtype=bool)
    new[1:] = (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])
    lead = np.zeros(len(h1), dtype=bool)
    lead[order[new]] = True  # lexsort is stable: the first of equals comes first
    return lead


def _sightings(shards: int):
    """Step 1 for the batches of one task."""

    def run(batches):
        once = Bloom(TASK_KEYS)
        for batch in batches:
            digests, owners = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                if doc_id is None:
                    continue
                keys = set(map(line_key, text.lower().split(b"\n")))
                keys.discard(None)
                digests.extend(map(digest, keys))
                owners.extend([doc_id] * len(keys))
            if not digests:
                continue
            halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
            h1, h2 = np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])
            owners = np.array(owners, dtype=np.int64)
            lead = _lead(h1, h2)
            first = lead & ~once.has(h1, h2)
            once.add(h1[first], h2[first])
            again = ~first
            # one mark for a key and batch
            mark = np.zeros(len(h1), dtype=bool)
            at = np.flatnonzero(again)
            mark[at[_lead(h1[at], h2[at])]] = True
            shard = (h1.view(np.uint64) % np.uint64(shards)).astype(np.int32)
            scattered = (owners.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(shards)
            for kind, chosen, to in ((_FIRST, first, shard), (_MARK, mark, shard), (_SUSPECT, again, scattered)):
                if chosen.any():
                    yield record_batch(
                        _SIGHTING, to[chosen].astype(np.int32), np.full(chosen.sum(), kind, dtype=np.int8),
                        h1[chosen], h2[chosen], owners[chosen],
                    )

    return run


_PAIR = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64())])


def _tested(batches):
    """Step 2 for one range, or a few: fill the pair of filters, then test the first sightings."""
    firsts, marks = [], []
    for batch in batches:
        kind, h1, h2, doc_id = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 5))
        suspect = kind == _SUSPECT
        if suspect.any():
            yield record_batch(_PAIR, h1[suspect], h2[suspect], doc_id[suspect])
        for wanted, kept in ((_FIRST, firsts), (_MARK, marks)):
            chosen = kind == wanted
            kept.append((h1[chosen], h2[chosen], doc_id[chosen]))
    total = sum(len(x[0]) for x in firsts)
    once, twice = Bloom(max(total, 1)), Bloom(max(total, 1))
    for h1, h2, _ in marks:
        twice.add(h1, h2)
    for h1, h2, _ in firsts:
        lead = _lead(h1, h2)
        repeat = once.has(h1, h2) | ~lead
        twice.add(h1[repeat], h2[repeat])
        once.add(h1, h2)
    for h1, h2, doc_id in firsts:
        found = twice.has(h1, h2)
        if found.any():
            yield record_batch(_PAIR, h1[found], h2[found], doc_id[found])


def repeated_keys(docs: DataFrame) -> DataFrame:
    """(doc_id, h1, h2): the keys that a document must lose, as digests."""
    n = docs.agg(F.count("*")).first()[0]
    shards = max(1, -(-n // DOCUMENTS_OF_A_RANGE))
    suspects = (
        docs.select("doc_id", "text")
        .mapInArrow(_sightings(shards), "shard int, kind tinyint, h1 long, h2 long, doc_id long")
        .repartition(max(shards, 8), "shard")
        .mapInArrow(_tested, "h1 long, h2 long, doc_id long")
    )
    suspects = stored(suspects, "suspects")
    keys = suspects.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    keys = keys.where("first < last").select("h1", "h2", "first")
    return suspects.join(keys, ["h1", "h2"]).where("doc_id > first").select("doc_id", "h1", "h2").distinct()


def without_lines(text: bytes, drop: set[bytes]) -> tuple[bytes, int, int]:
    """(remaining text, lines before, lines dropped)."""
    if not drop:
        return text, text.count(b"\n") + 1, 0
    lines, lowered = text.split(b"\n"), text.lower().split(b"\n")
    kept = [line for line, low in zip(lines, lowered) if (key := line_key(low)) is None or digest(key) not in drop]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _cut(batches):
    """Step 4: rows of documents with the digests to drop, as ``drops``."""
    for batch in batches:
        texts, before, dropped = [], [], []
        for text, drops in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("drops").to_pylist()):
            packed = {np.array((d["h1"], d["h2"]), dtype=np.int64).tobytes() for d in drops or ()}
            rest, lines, less = without_lines(text or b"", packed)
            texts.append(None if text is None else rest)
            before.append(lines)
            dropped.append(less)
        columns = {n: batch.column(n) for n in batch.schema.names if n != "drops"}
        columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
        columns["n_lines"], columns["n_dropped"] = pa.array(before, pa.int64()), pa.array(dropped, pa.int64())
        yield pa.RecordBatch.from_pydict(columns)


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the lines that an earlier document has, and ``n_lines``, ``n_dropped`` (long).

    A null or empty text is one empty line; a null text stays null. Rows of one
    ``doc_id`` are one document. Rows without a ``doc_id`` neither lose lines nor
    make others lose them. Blank and short lines always stay. A text that loses
    all its lines becomes empty. Further columns pass through; those named like
    the two counts are replaced. An empty table gives an empty result.
    """
    docs = short_batches(docs).drop("n_lines", "n_dropped", "drops")
    drops = repeated_keys(docs).groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("drops"))
    schema = StructType([*docs.schema.fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    return docs.join(drops, "doc_id", "left").select(*docs.columns, "drops").mapInArrow(_cut, schema)
