"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine c are 2 - 2c apart, squared. Vectors are rotated (random
signs and a Hadamard transform, so that no block holds more of a distance than
another) and split into blocks of 16 dimensions. The squared distance allowed is
shared out in proportion to the blocks' dimensions; a pair within the whole
distance is within its share in one block at least. So each block is range-joined
alone, and the union of what they find is verified by cosines of the vectors as
given, in double precision.

A block's range join: the signs of its first dimensions name a cell. Points of
different cells differ in sign in some dimensions; of their squared distance
there, which is at least the sum of both points' squares, one of the two has half
or less. So a point is at home in its cell and visits the cells it reaches for
half of the block's share. Cells with many points are cut into parts. A pair
that several blocks or cells find counts in the first block and cell only, which
each task can tell by itself: coordinates are made by additions in fixed order,
equal to the last bit wherever they are made.

Equal vectors are one class. Tasks write link counts and a forest of the links
they verify, not the pairs. At cosine 0.9 a share rules out few pairs of
directions spread evenly over the sphere: work grows nearly with the square of
such input, with a small factor; clustered embeddings cost less.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from dosewright.llm.common import record_batch, short_batches
from dosewright.llm.components import components, forest
from dosewright.session import stored

THRESHOLD = 0.9
BLOCK = 16
#: Points that a part of a cell has at home; cells get one dimension for each doubling beyond.
HOME = 16384
MOST_SIGNS = 8
TILE = 1024
#: Points in a row of a cell. Arrow batches count rows, so this bounds their bytes.
ROW = 32
SEED = 29
#: Room for rounding in squared distances.
SLACK = 1e-9

_RAW = pa.schema([("vec_id", pa.int64()), ("raw", pa.binary())])


def usable_vectors(table: DataFrame, column: str, kind: str) -> DataFrame:
    """(vec_id, raw): components as little-endian bytes; raw is null for vectors that link with nothing."""

    def run(batches):
        for batch in batches:
            raws = []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = None
                if vec_id is not None and v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype(kind)
                    with np.errstate(over="ignore"):
                        length = float(np.linalg.norm(x.astype("<f8")))
                    if np.isfinite(x).all() and 0 < length < math.inf:
                        raw = x.tobytes()
                raws.append(raw)
            yield record_batch(_RAW, batch.column(0), raws)

    return table.select(F.col("vec_id").cast("long"), F.col(column)).mapInArrow(run, "vec_id long, raw binary")


class Geometry:
    """Blocks, shares and cells for vectors of one dimension."""

    def __init__(self, dimension: int, points: int, threshold: float):
        self.dimension = dimension
        self.padded = max(1, 1 << (dimension - 1).bit_length())
        self.blocks = max(1, self.padded // BLOCK)
        self.size = self.padded // self.blocks
        self.threshold = threshold
        self.allowed = 2 - 2 * threshold + SLACK
        self.share = self.allowed / self.blocks  # blocks are of equal dimension
        self.signs = min(MOST_SIGNS, self.size, max(1, math.ceil(math.log2(max(points, 1) / HOME))) if points > HOME else 1)
        self.flip = np.where(np.random.default_rng(SEED).random(self.padded) < 0.5, -1.0, 1.0)

    def rotate(self, x: np.ndarray) -> np.ndarray:
        """Rotated unit vectors; additions in fixed order, row by row."""
        squares = np.zeros(len(x))
        for k in range(self.dimension):
            squares += x[:, k] * x[:, k]
        out = np.zeros((len(x), self.padded))
        out[:, : self.dimension] = x / np.sqrt(squares)[:, None]
        out *= self.flip
        step = 1
        while step < self.padded:
            pairs = out.reshape(len(x), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            out = out.reshape(len(x), self.padded)
            step *= 2
        return out / math.sqrt(self.padded)

    def block(self, rotated: np.ndarray, b: int) -> np.ndarray:
        return rotated[:, b * self.size : (b + 1) * self.size]

    def cells(self, part: np.ndarray) -> np.ndarray:
        home = np.zeros(len(part), dtype=np.int64)
        for k in range(self.signs):
            home |= (part[:, k] >= 0).astype(np.int64) << k
        return home

    def reach(self, part: np.ndarray) -> np.ndarray:
        """Squared distance to each change of signs, by mask."""
        cost = np.zeros((len(part), 1 << self.signs))
        for mask in range(1, 1 << self.signs):
            low = (mask & -mask).bit_length() - 1
            cost[:, mask] = cost[:, mask & (mask - 1)] + part[:, low] * part[:, low]
        return cost

    def shares(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Squared distance of each pair of rows in each block."""
        d = a - b
        d *= d
        out = np.zeros((len(a), self.blocks))
        for k in range(self.size):
            out += d[:, k :: self.size]
        return out


_VISIT = pa.schema(
    [("cell", pa.int64()), ("visits", pa.bool_()), ("n", pa.int64()), ("ids", pa.binary()), ("sizes", pa.binary()), ("raws", pa.binary())]
)
_VISIT_DDL = "cell long, visits boolean, n long, ids binary, sizes binary, raws binary"


def _cell_code(dimension: int, block: int, cell: np.ndarray | int):
    return (dimension << 32 | block << 16) + cell


def _placed(geometries: dict[int, Geometry], kind: str):
    """Rows of cells: the points at home there, and those that visit, packed by batch."""
    width = np.dtype(kind).itemsize

    def run(batches):
        for batch in batches:
            ids = batch.column("rep").to_numpy(zero_copy_only=False)
            sizes = batch.column("n").to_numpy(zero_copy_only=False)
            raws = batch.column("raw").to_pylist()
            lengths = np.array([len(r) // width for r in raws])
            rows_of_cells: list[tuple] = []
            for dimension in np.unique(lengths):
                g = geometries[int(dimension)]
                rows = np.flatnonzero(lengths == dimension)
                own, many = ids[rows], sizes[rows]
                x = np.frombuffer(b"".join(raws[i] for i in rows), dtype=kind).reshape(len(rows), -1)
                rotated = g.rotate(x.astype("<f8"))
                for b in range(g.blocks):
                    part = g.block(rotated, b)
                    home, near = g.cells(part), g.reach(part) <= g.share / 2
                    for cell in range(1 << g.signs):
                        there = home == cell
                        for visits, chosen in ((False, there), (True, ~there & near[np.arange(len(rows)), home ^ cell])):
                            at = np.flatnonzero(chosen)
                            for start in range(0, len(at), ROW):
                                some = at[start : start + ROW]
                                rows_of_cells.append(
                                    (
                                        _cell_code(int(dimension), b, cell), visits, len(some),
                                        own[some].tobytes(), many[some].tobytes(), x[some].tobytes(),
                                    )
                                )
                                if len(rows_of_cells) == 1024:
                                    yield record_batch(_VISIT, *zip(*rows_of_cells))
                                    rows_of_cells.clear()
            if rows_of_cells:
                yield record_batch(_VISIT, *zip(*rows_of_cells))

    return run


class _Points:
    """Points of a cell, unpacked."""

    def __init__(self, g: Geometry, b: int, kind: str, ids: bytes, sizes: bytes, raws: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.sizes = np.frombuffer(sizes, dtype=np.int64)
        self.x = np.frombuffer(raws, dtype=kind).reshape(len(self.ids), -1).astype("<f8")
        self.rotated = g.rotate(self.x)
        part = g.block(self.rotated, b)
        self.home, self.cost = g.cells(part), g.reach(part)
        self.flat = part.astype(np.float32)
        self.norm = np.einsum("ij,ij->i", self.flat, self.flat)
        self.length = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        self.links = np.zeros(len(self.ids), dtype=np.int64)


ALL, LESS, VISITS = range(3)


def _compare(g: Geometry, b: int, home: _Points, other: _Points, rule: int, edges: list) -> None:
    """Counts the verified links of home points with others.

    ``rule`` says which pairs count here: all of them; those where the home
    point has the smaller id, as the others are at home too and meet twice; or,
    of visitors, those that do not meet in a smaller cell.
    """
    half = g.share / 2
    for i in range(0, len(home.ids), TILE):
        for j in range(0, len(other.ids), TILE):
            h, o = slice(i, i + TILE), slice(j, j + TILE)
            near = home.norm[h, None] + other.norm[None, o] - 2 * home.flat[h] @ other.flat[o].T
            left, right = np.nonzero(near <= g.share + 1e-4)
            for at in range(0, len(left), 1 << 16):
                p, q = left[at : at + (1 << 16)] + i, right[at : at + (1 << 16)] + j
                if rule == ALL:
                    once = np.ones(len(p), dtype=bool)
                elif rule == LESS:
                    once = home.ids[p] < other.ids[q]
                else:  # both may visit each other's cell: the pair counts in the smaller one
                    change = home.home[p] ^ other.home[q]
                    once = (home.cost[p, change] > half) | (home.home[p] < other.home[q])
                p, q = p[once], q[once]
                shares = g.shares(home.rotated[p], other.rotated[q])
                first = (shares[:, b] <= g.share) & (shares[:, :b] > g.share).all(axis=1)
                p, q = p[first], q[first]
                cosine = np.einsum("ij,ij->i", home.x[p], other.x[q]) / (home.length[p] * other.length[q])
                p, q = p[cosine >= g.threshold], q[cosine >= g.threshold]
                if len(p):
                    np.add.at(home.links, p, other.sizes[q])
                    np.add.at(other.links, q, home.sizes[p])
                    root, node = forest(home.ids[p], other.ids[q])
                    edges.append((root, node))


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _joined(geometries: dict[int, Geometry], kind: str):
    """Range join of sorted cell rows: a part's home points first, then those that are compared with them."""

    def links(points: _Points):
        found = np.flatnonzero(points.links)
        if len(found):
            yield record_batch(_FOUND, points.ids[found], pa.nulls(len(found), pa.int64()), points.links[found])

    def chunks(batches):
        """Rows of one cell, part and kind put together up to a tile's points."""
        key, held, size = None, [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("cell", "part", "parts", "own", "visits", "ids", "sizes", "raws"))
            for *now, ids, sizes, raws in zip(*columns):
                if held and (now != key or size >= TILE):
                    yield key, [b"".join(x) for x in zip(*held)]
                    held, size = [], 0
                key = now
                held.append((ids, sizes, raws))
                size += len(ids) // 8
        if held:
            yield key, [b"".join(x) for x in zip(*held)]

    def run(batches):
        current, homes = None, []
        for (cell, part, parts, own, visits), packed in chunks(batches):
            g, b = geometries[cell >> 32], cell >> 16 & 0xFFFF
            edges: list = []
            if (cell, part) != current:
                for points in homes:
                    yield from links(points)
                current, homes = (cell, part), []
            points = _Points(g, b, kind, *packed)
            if own:
                if parts == 1:  # else home points come as guests of all parts, this one included
                    for home in homes:
                        _compare(g, b, home, points, ALL, edges)
                    _compare(g, b, points, points, LESS, edges)
                homes.append(points)
            else:
                for home in homes:
                    _compare(g, b, home, points, VISITS if visits else LESS, edges)
                yield from links(points)
            if edges:
                x, y = (np.concatenate(e) for e in zip(*edges))
                x, y = forest(x, y)
                yield record_batch(_FOUND, x, y, pa.nulls(len(x), pa.int64()))
        for points in homes:
            yield from links(points)

    return run


def embedding_groups(table: DataFrame, column: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for each row of ``table``.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without a ``vec_id``, link with nothing. Vectors of different dimension
    do not link. Repeated rows of a vector are one vector. ``threshold`` is
    positive. Other columns are ignored; an empty table gives an empty result.
    """
    single = isinstance(table.schema[column].dataType, ArrayType) and isinstance(
        table.schema[column].dataType.elementType, FloatType
    )
    kind = "<f4" if single else "<f8"
    width = np.dtype(kind).itemsize
    vectors = stored(usable_vectors(short_batches(table), column, kind), "vectors")
    usable = vectors.where("raw is not null").distinct()
    classes = stored(usable.groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "classes")
    counts = classes.groupBy((F.length("raw") / width).cast("int").alias("d")).count().collect()  # by dimension
    geometries = {r[0]: Geometry(r[0], r[1], threshold) for r in counts}

    cells = stored(classes.mapInArrow(_placed(geometries, kind), _VISIT_DDL), "cells")
    parts = cells.where("not visits").groupBy("cell").agg(F.ceil(F.sum("n") / HOME).cast("int").alias("parts"))
    cut = cells.join(parts, "cell")  # a cell where nobody is at home has no pairs
    dealt = F.pmod(F.xxhash64("ids"), F.col("parts")).cast("int")
    home = cut.where("not visits").select("*", dealt.alias("part"), F.lit(True).alias("own"))
    guests = cut.where("visits or parts > 1").select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("own"))
    found = (
        home.unionByName(guests.select(*home.columns))
        .repartition("cell", "part")
        .sortWithinPartitions("cell", "part", F.col("own").desc())
        .mapInArrow(_joined(geometries, kind), "a long, b long, links long")
    )
    found = stored(found, "embedding-links")
    degree = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    labelled = (
        classes.join(degree, "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .select("raw", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("root"))
    )
    return vectors.join(labelled, "raw", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("root", "vec_id"), F.lit(False)).alias("kept"),
    )
