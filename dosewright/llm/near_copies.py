"""Near copies: documents whose SimHash fingerprints differ in two bits or fewer, and documents whose sets of
five-word shingles have a Jaccard similarity of 0.8 or more.

The first are found as op8 finds them (``simhash``): an index over byte positions, a tally of the
positional bytes that a pair shares, six or more retained, bits counted. All of them are found.

Copies with more words changed are further apart than two bits. Their candidates come from
min-hashing: a set has 32 bands of five smallest hashes, and
two documents meet if a band is equal. At similarity 0.8 a pair misses all bands in
three of a million cases, above that more seldom. Every pair that meets is decided
by the exact similarity of its shingle sets, so nothing is linked by chance.

Documents of equal shingles are one node, so groups of copies cost one index row,
not one a copy. Buckets of equal members are verified once. A task holds the
shingles of one bucket and compares a member with a document of each group found
in the bucket before it looks at the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm.common import as_bytes, record_batch, short_batches
from dosewright.llm.components import components, contract_batches
from dosewright.llm.simhash import SEED, fingerprint, links as simhash_links, shingle_hashes
from dosewright.session import stored

SHINGLE_WORDS = 5
#: Least similarity, as a fraction.
SIMILAR = (4, 5)
BANDS, BAND_HASHES = 32, 5
#: Shingles hashed at once.
BLOCK = 512
#: Column that numbers the rows of the documents meanwhile.
ROW = "__near_copies_row"

_draw = np.random.default_rng(SEED)
_FACTOR = _draw.integers(0, 1 << 63, (BANDS * BAND_HASHES, 1), dtype=np.uint64) << np.uint64(1) | np.uint64(1)
_FLIP = _draw.integers(0, 1 << 63, (BANDS * BAND_HASHES, 1), dtype=np.uint64) << np.uint64(1)

_INDEX = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("fp", pa.int64()), ("bands", pa.list_(pa.int64()))])
_MEMBER = pa.schema([("b1", pa.int64()), ("b2", pa.int64()), ("node", pa.int64())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingles(text: bytes) -> np.ndarray:
    """Different hashes of the shingles, ascending; empty for a text without words."""
    return np.unique(np.array(shingle_hashes(text, SHINGLE_WORDS), dtype=np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    least, whole = SIMILAR
    if whole * min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return whole * both >= least * (len(a) + len(b) - both)


def bands(values: np.ndarray) -> list[int]:
    """A key for each band of smallest hashes; none for no shingles."""
    if not len(values):
        return []
    least = np.full(len(_FACTOR), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), BLOCK):
        np.minimum(least, ((values[at : at + BLOCK] ^ _FLIP) * _FACTOR).min(axis=1), out=least)
    packed = least.reshape(BANDS, BAND_HASHES)
    return [xxhash.xxh64_intdigest(band.tobytes(), number) - (1 << 63) for number, band in enumerate(packed)]


def _halves(content: bytes) -> tuple[int, int]:
    key = hashlib.blake2b(content, digest_size=16).digest()
    return int.from_bytes(key[:8], "little", signed=True), int.from_bytes(key[8:], "little", signed=True)


def _indexed(batches):
    for batch in batches:
        h1, h2, prints, keys = [], [], [], []
        for text in as_bytes(batch.column("text")):
            values = shingles(text)
            one, two = _halves(values.tobytes())
            h1.append(one)
            h2.append(two)
            prints.append(fingerprint(text))
            keys.append(bands(values))
        fp = np.array(prints, dtype=np.uint64).view(np.int64)
        yield record_batch(_INDEX, batch.column("row"), batch.column("doc_id").cast(pa.int64()), h1, h2, fp, keys)


def _buckets(batches):
    """(bucket, node) of the keys, in order, that several nodes have; a bucket is named by its members."""
    carried = None
    for batch in batches:
        part = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)]
        if carried is not None:
            part = [np.concatenate(x) for x in zip(carried, part)]
        if not len(part[0]):
            continue
        cut = int(np.searchsorted(part[0], part[0][-1]))  # the last key may go on
        carried = [x[cut:] for x in part]
        yield from _buckets_of_run(*(x[:cut] for x in part))
    if carried is not None:
        yield from _buckets_of_run(*carried)


def _buckets_of_run(key, node):
    if len(key) < 2:
        return
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(edges)
    for at, size in zip(edges[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        members = np.sort(node[at : at + size])
        b1, b2 = _halves(members.tobytes())
        yield record_batch(_MEMBER, [b1] * size, [b2] * size, members)


def _links(batches):
    """Verified links of the members of each bucket, enough to connect all that are linked."""
    bucket, groups, a, b = None, [], [], []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("b1", "b2", "node"))
        for b1, b2, node, text in zip(*columns, as_bytes(batch.column("text"))):
            if (b1, b2) != bucket:
                bucket, groups = (b1, b2), []
            own = shingles(text)
            joined, apart = [(node, own)], []
            for group in groups:
                near = next((other for other, values in group if similar(own, values)), None)
                if near is None:
                    apart.append(group)
                else:
                    a.append(near)
                    b.append(node)
                    joined = group + joined if len(joined) == 1 else joined + group
            groups = [*apart, joined]
        if a:
            yield record_batch(_LINK, a, b)
            a, b = [], []


def _contracted_links(batches):
    return contract_batches(_links(batches))


def _within_bits(index: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the nodes whose documents have fingerprints within two bits.

    Documents of equal shingles may differ in how often they have them, and so in their
    fingerprints: a node is linked by each of these.
    """
    kinds = index.select("h1", "h2", "fp").distinct()
    kinds = stored(kinds.join(nodes.select("h1", "h2", F.col("row").alias("node")), ["h1", "h2"]).select("node", "fp"), "prints")
    of_print = stored(kinds.groupBy("fp").agg(F.min("node").alias("node"), F.count("*").alias("n")), "nodes-of-prints")
    several = of_print.where("n > 1").select("fp", F.col("node").alias("a"))
    equal = kinds.join(several, "fp").where("a <> node").select("a", F.col("node").alias("b"))
    return simhash_links(of_print.select("node", "fp")).select("a", "b").unionByName(equal)


def without_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, that of the smallest ``doc_id``.

    A group is what is connected by fingerprints within two bits and by similarities of 0.8 or
    more, texts of equal shingles and texts without words among themselves included. All columns pass.
    Rows without a ``doc_id`` are looked at like any other and stay unless their
    group has a row with one, or they are repeated: exactly one row of a group
    stays. Rows of one ``doc_id`` with texts of different groups all stay.
    """
    columns = docs.columns
    rows = stored(short_batches(docs).withColumn(ROW, F.monotonically_increasing_id()), "rows")
    index = stored(
        rows.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _indexed, "row long, doc_id long, h1 long, h2 long, fp long, bands array<long>"
        ),
        "shingles",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    nodes = stored(index.groupBy("h1", "h2").agg(first).select("h1", "h2", "first.*"), "nodes")
    within_bits = _within_bits(index, nodes)
    members = (
        index.join(nodes.select("row"), "row", "left_semi")
        .select(F.explode("bands").alias("key"), F.col("row").alias("node"))
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_buckets, "b1 long, b2 long, node long")
    )
    members = stored(members.distinct(), "buckets")
    # Written apart, so that its size is known: texts are read where they lie while it is small, and only those of
    # members travel in any case.
    compared = stored(members.select("node").distinct(), "compared")
    texts = rows.select(F.col(ROW).alias("node"), "text").join(compared, "node", "left_semi")
    links = (
        members.join(texts, "node")
        .repartition("b1", "b2")
        .sortWithinPartitions("b1", "b2", "node")
        .select("b1", "b2", "node", "text")
        .mapInArrow(_contracted_links, "a long, b long")
    )
    roots = components(links.unionByName(within_bits), contracted=True)
    kept = (
        nodes.join(roots, F.col("row") == F.col("node"), "left")
        .groupBy(F.coalesce("component", "row").alias("group"))
        .agg(first)
        .select(F.col("first.row").alias("row"))
    )
    # Few rows go, nearly all stay: the rows are told from those that go.
    dropped = stored(index.select("row").join(kept, "row", "left_anti"), "dropped")
    return rows.join(dropped.withColumnRenamed("row", ROW), ROW, "left_anti").select(*columns)
