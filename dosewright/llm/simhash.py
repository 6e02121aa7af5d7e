"""SimHash near-deduplication by an inverted index over byte positions.

A fingerprint has eight bytes. Two bits that differ touch at most two of them,
so fingerprints within two bits share at least six positional bytes: six is the
guaranteed minimum of matches. Postings of single bytes would pair a 256th of the
corpus with itself, so a posting holds four positional bytes: of four groups of two
positions, two at least are untouched, so a pair meets in one of the six choices of two
groups. There the shared positional bytes of each pair are tallied, pairs that
reach six are retained, and those are verified by counting differing bits.

Postings with many fingerprints are handed on to an index by all 28 choices of six
positions, where a pair meets exactly if its tally reaches six. Members of such an entry
differ in the other two bytes only, so it has at most 65,536 different fingerprints,
however many documents there are.

Documents of equal fingerprint are one node (their smallest ``doc_id``), so
groups of copies cost six index rows, not six a copy. Inside an entry only a
spanning forest of the verified links is written, never all pairs.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm.common import as_bytes, map_documents, record_batch
from dosewright.llm.components import components, contract_batches, forest
from dosewright.session import stored

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
BYTES = 8
MATCHES = BYTES - MAX_BITS
#: With more fingerprints than this, a posting is handed on, and an entry of six positions is linked by
#: masked values instead of in pairs.
PAIRWISE = 512

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_PRINT = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
#: A link (a, b), or a fingerprint handed on with its node.
_TALLIED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("handed", pa.bool_())])


def shingle_hashes(text: bytes, shingle_words: int) -> list[int]:
    """XXH64 of all word shingles; a shorter text is one shingle, a text without words has none."""
    words = _WORDS.findall(text.lower())
    n = len(words)
    if not n:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, n)
    hashed, seed = xxhash.xxh64_intdigest, SEED
    return [hashed(joined[s:e], seed) for s, e in zip(starts[: n - k + 1].tolist(), ends[k - 1 :].tolist())]


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 for a text without words."""
    values = shingle_hashes(text, shingle_words)
    if not values:
        return 0
    bits = np.unpackbits(np.array(values, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    counts = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(values)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""

    def run(batch):
        values = [fingerprint(text, shingle_words) for text in as_bytes(batch.column("text"))]
        yield record_batch(_PRINT, batch.column("doc_id"), np.array(values, dtype=np.uint64).view(np.int64))

    return map_documents(docs, ["doc_id", "text"], run, "doc_id long, fp long")


#: Positions of a posting: two of four groups of two.
_POSTINGS = [(2 * i, 2 * i + 1, 2 * j, 2 * j + 1) for i, j in combinations(range(BYTES // 2), 2)]
_CHOICES = list(combinations(range(BYTES), MATCHES))


def octets_of(fp: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fp).view(np.uint8).reshape(-1, BYTES)


def _index(choices):
    """(key, fp, node) for each choice of positions; the key holds the choice and its bytes."""

    def run(batches):
        for batch in batches:
            node, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            octets = octets_of(fp).astype(np.int64)
            for number, chosen in enumerate(choices):
                key = np.full(len(fp), number, dtype=np.int64)
                for position in chosen:
                    key = key << 8 | octets[:, position]
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp), pa.array(node)], names=["key", "fp", "node"])

    return run


def _retained(fp: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs share six positional bytes, by a tally, and differ in two bits or fewer."""
    octets, values = octets_of(fp), fp.view(np.uint64)
    kept = np.flatnonzero((octets[left] == octets[right]).sum(axis=1) >= MATCHES)
    return kept[np.bitwise_count(values[left[kept]] ^ values[right[kept]]) <= MAX_BITS]


def _tallied(pairwise: int):
    """Forests of the links of sorted postings; fingerprints of postings beyond ``pairwise`` are handed on."""

    def linked(key, fp, node):
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        sizes = np.diff(edges)
        a, b = [node[:0]], [node[:0]]
        for n in np.unique(sizes):  # postings of a size at once, a million pairs at most
            one, other = np.triu_indices(n, 1)
            starts = edges[:-1][sizes == n]
            for some in np.array_split(starts, 1 + len(starts) * len(one) // 1_000_000):
                left, right = ((some[:, None] + side).ravel() for side in (one, other))
                near = _retained(fp, left, right)
                a.append(node[left[near]])
                b.append(node[right[near]])
        child, root = forest(np.concatenate(a), np.concatenate(b))
        if len(child):
            yield record_batch(_TALLIED, root, child, np.zeros(len(child), dtype=bool))

    def handed(fp, node):
        if len(fp):
            yield record_batch(_TALLIED, fp, node, np.ones(len(fp), dtype=bool))

    def run(batches):
        carried, large = [np.zeros(0, dtype=np.int64)] * 3, None
        for batch in batches:
            part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if large is not None:
                rest = int(np.searchsorted(part[0], large, side="right"))
                yield from handed(part[1][:rest], part[2][:rest])
                part = [x[rest:] for x in part]
            if not len(part[0]):
                continue
            large = None
            part = [np.concatenate(x) for x in zip(carried, part)]
            cut = int(np.searchsorted(part[0], part[0][-1]))  # the last posting may go on
            carried = [x[cut:] for x in part]
            whole = [x[:cut] for x in part]
            yield from settled(*whole)
            if len(carried[0]) > pairwise:
                large = carried[0][0]
                yield from handed(carried[1], carried[2])
                carried = [x[:0] for x in carried]
        yield from settled(*carried)

    def settled(key, fp, node):
        if not len(key):
            return
        _, inverse, sizes = np.unique(key, return_inverse=True, return_counts=True)
        many = sizes[inverse] > pairwise
        yield from handed(fp[many], node[many])
        few = ~many & (sizes[inverse] > 1)
        if few.any():
            yield from linked(key[few], fp[few], node[few])

    return run


def _links_of_entry(fp: np.ndarray, node: np.ndarray, pairwise: int = PAIRWISE) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the verified links among the different fingerprints of one entry of six positions."""
    n = len(fp)
    values = fp.view(np.uint64)
    if n <= pairwise:
        left, right = np.triu_indices(n, 1)
        near = np.bitwise_count(values[left] ^ values[right]) <= MAX_BITS
        left, right = left[near], right[near]
    else:
        # Two values within two bits agree once those two bits are masked, and values that agree then
        # are within two bits: each group of equal masked values is linked as a star.
        free = [b for b in range(64) if ((values ^ values[0]) >> np.uint64(b) & np.uint64(1)).any()]
        pairs = list(combinations(free, MAX_BITS)) or [(b,) for b in free]
        left, right = [], []
        for bits in pairs:
            mask = ~np.bitwise_or.reduce(np.array([1 << b for b in bits], dtype=np.uint64))
            _, lead, group = np.unique(values & mask, return_index=True, return_inverse=True)
            star = lead[group]
            moved = np.flatnonzero(star != np.arange(n))
            left.append(star[moved])
            right.append(moved)
        left, right = np.concatenate(left), np.concatenate(right)
    if not len(left):
        return node[:0], node[:0]
    return forest(node[left], node[right])


def _links(pairwise: int):
    """Links of sorted rows of six positions; an entry that goes on in the next batch is carried over."""

    def run(batches):
        carried = None
        for batch in batches:
            part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if carried is not None:
                part = [np.concatenate(x) for x in zip(carried, part)]
            if not len(part[0]):
                continue
            cut = int(np.searchsorted(part[0], part[0][-1]))  # the last entry may go on
            carried = [x[cut:] for x in part]
            yield from of_run(*(x[:cut] for x in part))
        if carried is not None:
            yield from of_run(*carried)

    def of_run(key, fp, node):
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, dtype=np.int64)
        a, b = [node[:0]], [node[:0]]
        for at, end in zip(edges[:-1], edges[1:]):
            if end - at > 1:
                moved, root = _links_of_entry(np.ascontiguousarray(fp[at:end]), node[at:end], pairwise)
                a.append(root)
                b.append(moved)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            yield record_batch(_LINK, a, b)

    # Contracted in the same function, so that a task needs one Python worker.
    return lambda batches: contract_batches(run(batches))


def _entered(nodes: DataFrame, choices) -> DataFrame:
    index = nodes.select("node", "fp").mapInArrow(_index(choices), "key long, fp long, node long")
    return index.repartition("key").sortWithinPartitions("key")


def links(nodes: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """Links (a, b) that connect all of ``nodes`` (node, fp), of different fp, within two bits."""
    made = stored(_entered(nodes, _POSTINGS).mapInArrow(_tallied(pairwise), "a long, b long, handed boolean"), "tallied")
    found = made.where("not handed").select("a", "b")
    again = made.where("handed").select(F.col("a").alias("fp"), F.col("b").alias("node")).distinct()
    if again.isEmpty():
        return found
    return found.unionByName(_entered(again, _CHOICES).mapInArrow(_links(pairwise), "a long, b long"))


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (hex), ``component_id``, ``kept``.

    ``component_id`` is the smallest ``doc_id`` reachable over fingerprints that
    differ in two bits or fewer, ``kept`` marks that document. Null and empty
    texts have the fingerprint zero and are linked like any other. Repeated rows
    of a ``doc_id`` share their row's component. A row without a ``doc_id`` gets
    the component of its fingerprint, null if no document has it, and is not
    kept. Other columns are ignored; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, shingle_words), "fingerprints")
    nodes = stored(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    roots = components(links(nodes), contracted=True)
    classes = nodes.join(roots, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(classes, "fp", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
