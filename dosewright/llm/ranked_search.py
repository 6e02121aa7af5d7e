"""Ranked lexical search: every item of a query set against all documents, the best few of each.

Scores are integers of the BM25 family. A first pass keeps of each document its length and the
counts of the terms that some item asks for; document frequencies, the number of documents and
their total length come from these rows. A second pass deals the rows into shards of bounded
size. Within a shard each term has a list of documents by falling impact, and an item is answered
by the Best Position Algorithm: the lists are read from the top in parallel, a document met is
looked up directly in the other lists, and each list remembers the *best position*, the end of
the unbroken run of positions seen by either kind of access. No unseen document can score more
than the impacts at the best positions add up to; reading ends once that sum is strictly below
the k-th best score, so that ties are still decided by document. Only the best few of a task
leave it. Items are answered in blocks of bounded size; nothing of the documents reaches the driver
but the document frequencies of a block's terms.

Odd cases: null and empty texts, and texts without a term, are no documents and no queries. Rows
of one ``doc_id`` are separate documents and rows of one ``item_id`` separate items, each with its own
ranks. A null ``doc_id`` comes after all others among equal scores. Other columns are not looked at.
Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dosewright.llm.common import as_bytes, short_batches
from dosewright.session import stored

BEST = 20
#: A block of items; its vocabulary goes to every task.
BLOCK_ITEMS, BLOCK_BYTES = 2000, 1_000_000
#: A shard is closed at so many postings.
SHARD_POSTINGS = 1_500_000
#: Positions read from each list in the first round; doubled with each.
FIRST_DEPTH = 16

# ASCII letters and digits and all bytes of other characters are terms; the rest separates them.
_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

_COUNTED = "doc_id long, n long, terms array<int>, counts array<long>"
_FOUND = "item int, doc_id long, score long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _counter(numbers: dict[bytes, int]):
    """Maps texts to lengths and to the counts of the numbered terms."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths, ends, terms, counts = [], [], [0], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                words = terms_of(text)
                if not words:
                    continue
                for word, count in Counter(words).items():
                    number = numbers.get(word)
                    if number is not None:
                        terms.append(number)
                        counts.append(count)
                ids.append(doc_id)
                lengths.append(len(words))
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return counted


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Shard:
    """Impact lists of some documents, with the place of each document in each list."""

    def __init__(self, doc, term, impact, n_docs: int):
        by_doc = np.lexsort((doc, term))
        doc, term, impact = doc[by_doc], term[by_doc], impact[by_doc]
        by_impact = np.lexsort((doc, -impact, term))
        self.n_docs = n_docs
        #: (term, document), ascending; the place of each in the lists.
        self.keys = term.astype(np.int64) * n_docs + doc
        self.place = np.empty(len(doc), dtype=np.int64)
        self.place[by_impact] = np.arange(len(doc))
        #: The lists, one after the other, and where that of a term begins.
        self.doc, self.impact = doc[by_impact], impact[by_impact]
        self.listed, starts = np.unique(term, return_index=True)
        self.start, self.end = starts, np.append(starts[1:], len(doc))
        self._met = np.full(n_docs, -1, dtype=np.int32)
        self._seen = np.full(len(doc), -1, dtype=np.int32)

    def best(self, item: int, terms: np.ndarray, times: np.ndarray, k: int, floor: int):
        """(documents, scores) holding all that may be among the k best and reach ``floor``."""
        at = np.searchsorted(self.listed, terms)
        here = at < len(self.listed)
        here[here] = self.listed[at[here]] == terms[here]
        terms, times, at = terms[here].astype(np.int64), times[here], at[here]
        start, end = self.start[at], self.end[at]
        best = start.copy()  # one past the best position of each list
        docs, scores = [], []
        kth, n_met, depth, step = floor, 0, 0, FIRST_DEPTH
        while len(terms) and (start + depth < end).any():
            read = [np.arange(s, min(s + step, e)) for s, e in zip(start + depth, end) if s < e]
            depth, step = depth + step, step * 2
            met = np.unique(self.doc[np.concatenate(read)])
            met = met[self._met[met] != item]
            if len(met):
                self._met[met] = item
                wanted = (terms[:, None] * self.n_docs + met).ravel()
                found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                there = self.keys[found] == wanted
                place = self.place[found]
                self._seen[place[there]] = item
                score = (np.where(there, self.impact[place], 0).reshape(len(terms), -1) * times[:, None]).sum(axis=0)
                docs.append(met)
                scores.append(score)
                n_met += len(met)
                if n_met >= k:
                    together = np.concatenate(scores)
                    kth = max(floor, int(np.partition(together, len(together) - k)[len(together) - k]))
            bound = 0
            for i, (b, e) in enumerate(zip(best.tolist(), end.tolist())):
                run = self._seen[b:e] != item
                first = int(run.argmax()) if len(run) else 0
                best[i] = e if len(run) == 0 or not run[first] else b + first
                if best[i] < e:
                    bound += int(times[i]) * int(self.impact[best[i] - 1])
            if bound < kth:  # strictly: an unseen document of the same score could have a smaller id
                break
        if not docs:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        good = (scores >= kth) & (scores > 0)
        return docs[good], scores[good]


def _impacts(n, count, weights, documents: int, length: int):
    """Weight times saturated count; lengths and counts of postings."""
    if 25 * int(n.max()) * documents < 1 << 63:
        m = 75 + 25 * n * documents // length
    else:  # beyond 64 bits on the way only
        m = np.array([75 + 25 * int(x) * documents // length for x in n], dtype=np.int64)
    return weights * (1_000_000_000 * count // (1000 * count + 12 * m))


def _searcher(queries: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, documents: int, length: int, k: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Best few of each item so far: (-score, id is null, id).
        top: list[list[tuple[int, bool, int]]] = [[] for _ in queries]

        def answer(parts):
            ids, lengths, sizes, terms, counts = (np.concatenate(x) for x in zip(*parts))
            doc = np.repeat(np.arange(len(ids)), sizes)
            impact = _impacts(lengths[doc], counts, weights[terms], documents, length)
            useful = impact > 0
            if not useful.any():
                return
            shard = Shard(doc[useful], terms[useful], impact[useful], len(ids))
            for item, (asked, times) in enumerate(queries):
                floor = -top[item][-1][0] if len(top[item]) == k else 0
                found, scores = shard.best(item, asked, times, k, floor)
                if len(found):
                    if len(found) > k:  # all that tie with the k-th stay
                        least = np.partition(scores, len(scores) - k)[len(scores) - k]
                        found, scores = found[scores >= least], scores[scores >= least]
                    more = [(-s, i is None, i or 0) for s, i in zip(scores.tolist(), ids[found].tolist())]
                    top[item] = sorted(top[item] + more)[:k]

        parts, waiting = [], 0
        for batch in batches:
            terms, counts = batch.column("terms"), batch.column("counts")
            parts.append(
                (
                    np.array(batch.column("doc_id").to_pylist(), dtype=object),
                    batch.column("n").to_numpy(),
                    np.diff(terms.offsets.to_numpy()),
                    terms.flatten().to_numpy(),
                    counts.flatten().to_numpy(),
                )
            )
            waiting += len(parts[-1][3])
            if waiting >= SHARD_POSTINGS:
                answer(parts)
                parts, waiting = [], 0
        if waiting:
            answer(parts)
        rows = [(item, None if null else i, -s) for item, best in enumerate(top) for s, null, i in best]
        if rows:
            items, ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                names=["item", "doc_id", "score"],
            )

    return searched


def _blocks(items: DataFrame):
    """The query set in lists of (item_id, term counts), each within the bounds of a block."""
    block, size = [], 0
    for item_id, text in items.select("item_id", "text").toLocalIterator():
        counts = Counter(terms_of((text or "").encode()))
        if not counts:
            continue
        weighs = sum(map(len, counts))
        if block and (len(block) >= BLOCK_ITEMS or size + weighs > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((item_id, counts))
        size += weighs
    if block:
        yield block


def _search_block(docs: DataFrame, block, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    numbers = {term: at for at, term in enumerate(sorted(set().union(*(counts for _, counts in block))))}
    counted = stored(docs.mapInArrow(_counter(numbers), _COUNTED), "counted-terms")
    documents, length = counted.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(numbers), dtype=np.int64)
    for term, count in holding:  # a row for each term of the block
        weights[term] = weight(documents, count)
    queries = []
    for _, counts in block:
        asked = sorted((numbers[term], times) for term, times in counts.items())
        queries.append((np.array([t for t, _ in asked]), np.array([n for _, n in asked], dtype=np.int64)))
    names = spark.createDataFrame([(at, item_id) for at, (item_id, _) in enumerate(block)], "item int, item_id long")
    found = counted.mapInArrow(_searcher(queries, weights, documents, length, k), _FOUND)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of each item, fewer where fewer score above 0.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``.
    """
    docs = short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = [found for block in _blocks(items) if (found := _search_block(docs, block, k)) is not None]
    if not parts:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, parts)
