"""Connected components of a table of links, by alternating star contraction.

Each round rewires links towards the smallest neighbour, first of the larger
nodes, then of the smaller ones, until every node points at the smallest node of
its component. Rounds are written to the shared folder, so a lost executor costs
a re-read; only counts and checksums reach the driver. Neighbour minima are
combined before the shuffle, and joins on a node with many links are ordinary
joins, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.session import stored

_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its tree) of the links given, nodes that are their own smallest left out."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        while True:  # follow labels to their ends
            further = label[label]
            if (further == label).all():
                break
            label = further
        if (before == label).all():
            break
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def contract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the links of each batch by a forest with the same components."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if len(a):
            node, root = forest(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], schema=_EDGE)


def _toward_minimum(links: DataFrame, larger: bool) -> DataFrame:
    """One half round: neighbours of a node are linked to the smallest of them.

    Links have a < b. With ``larger``, a node hands its smallest neighbour (or
    itself) to its larger neighbours; without, to its smaller ones and itself.
    """
    if larger:
        both = links.select(F.col("b").alias("u"), F.col("a").alias("v")).unionByName(
            links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = links.withColumnRenamed("a", "u").join(least, "u").select(F.col("m").alias("a"), "b")
    else:
        least = links.groupBy("b").agg(F.min("a").alias("m"))
        joined = links.join(least, "b")
        out = joined.select(F.col("m").alias("x"), F.col("a").alias("y")).unionByName(
            least.select(F.col("m").alias("x"), F.col("b").alias("y"))
        )
        out = out.select(F.col("x").alias("a"), F.col("y").alias("b"))
    return out.where("a < b").distinct()


def components(links: DataFrame, contracted: bool = False) -> DataFrame:
    """(node, component) of every node that is not the smallest of its component.

    ``links`` has two long columns ``a`` and ``b``; order, repeats and self
    links do not matter, links with a null end are dropped. No links give an
    empty table. ``component`` is the smallest node reachable. ``contracted``
    says that :func:`contract_batches` has been applied where the links are made.
    """
    links = links.where("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    if not contracted:
        links = links.mapInArrow(contract_batches, "a long, b long")
    links = stored(links.distinct(), "links")
    mark = None
    while True:
        now = links.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now[0] == 0 or now == mark:
            break
        mark = now
        links = stored(_toward_minimum(_toward_minimum(links, True), False), "links")
    return links.select(F.col("b").alias("node"), F.col("a").alias("component"))
