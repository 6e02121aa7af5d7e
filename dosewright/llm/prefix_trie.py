"""Trie of conversation prefixes with totals of every subtree, by time-forward processing.

A conversation is rebuilt first: it begins with the first ``h`` turns of the conversation
whose id is the hundred below its own, and goes on with its own turns from the ``h``-th on,
``h`` being a checksum of its id. Every different sequence of first turns is a node.

Turns travel as 128 bits of SHA-256 of role and text, never as texts. A prefix is told by
the 128-bit sum of the hashes of its turns with their places, so the turns of one very long
conversation can be summed in several tasks: rows are dealt by ranges of (conversation,
place), and only the one conversation that crosses into a range gets an offset.

Subtree totals follow the time-forward method. The shards are those ranges. Within a shard
the nodes are sorted by Spark in reverse level order, children before parents; a node takes
the messages addressed to it from a priority queue, adds what it owns, and sends the total to
its parent. The queue writes sorted runs to a file of its task when it exceeds its bound.
A message whose parent lies in another shard leaves the shard: to the root of the trie, or,
for the conversation cut by the border, to its part in the shard before. These shard roots, at
most one a shard, are then processed forward in the same way among themselves, and what arrives
is added along the path. A node that conversations of several shards share has the sum of
what each shard found.

Odd cases: null role or text is empty; turns of one number come in the order of their digest,
null numbers first; repeated rows are repeated turns. Rows without a ``conv_id`` belong to no
conversation. A conversation left without turns ends at the root. An id that is a hundred itself is
its own beginning; for negative ids the hundred is the next towards zero. An empty table has
no node. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dosewright.llm.common import record_batch, short_batches
from dosewright.session import stored

#: A conversation begins with at most this many turns of another, less one.
HEADS = 6
FAMILY = 100
#: Messages a queue holds in memory, and records read from a run at once.
QUEUE_MESSAGES, RUN_RECORDS = 200_000, 1024
#: Ids in one block of a node's ending conversations.
BLOCK_IDS = 4096

_PLACED = pa.schema(
    [("conv_id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("size", pa.int64()), ("part", pa.int64()), ("local", pa.int64())]
)
_PREFIX = pa.schema(
    [("conv_id", pa.int64()), ("pos", pa.int64()), ("size", pa.int64()), ("turns", pa.int64()), ("part", pa.int64())]
    + [(c, pa.int64()) for c in ("p1", "p2", "k1", "k2")]
)
_TOTAL = pa.schema(
    [("shard", pa.int64()), ("leaving", pa.bool_())]
    + [(c, pa.int64()) for c in ("depth", "k1", "k2", "leaves", "saved", "children")]
)
_BLOCK = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_ENDS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])

NO_ENDS = hashlib.sha256(b"").hexdigest()


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.bool_(): "boolean", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal values, and for each value the number of its run."""
    new = np.concatenate([[True], values[1:] != values[:-1]])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the turns of each conversation within the task, from 1."""
    part, last, so_far = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts, run = _runs(conv)
        local = np.arange(len(conv)) - starts[run] + 1
        if conv[0] == last:
            local[run == 0] += so_far
        last, so_far = conv[-1], int(local[-1])
        columns = (batch.column(c) for c in ("conv_id", "d1", "d2", "size"))
        yield record_batch(_PLACED, *columns, np.full(len(conv), part), local)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sums, modulo 2^64, of the two lanes of each conversation within the task."""
    part, last, carried = TaskContext.get().partitionId(), None, np.zeros(2, dtype=np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        starts, run = _runs(conv)
        out = []
        for lane, name in enumerate(("l1", "l2")):
            value = batch.column(name).to_numpy().astype(np.uint64)
            total = np.cumsum(value)
            total -= (total[starts] - value[starts])[run]
            if conv[0] == last:
                total[run == 0] += carried[lane]
            carried[lane] = total[-1]
            out.append(((total - value).astype(np.int64), total.astype(np.int64)))
        last = conv[-1]
        columns = (batch.column(c) for c in ("conv_id", "pos", "size", "turns"))
        (p1, k1), (p2, k2) = out
        yield record_batch(_PREFIX, *columns, np.full(len(conv), part), p1, p2, k1, k2)


class ForwardQueue:
    """Priority queue of messages (order, k1, k2, leaves, saved, children) in bounded memory.

    Beyond ``limit`` messages those in memory become a sorted run in an unnamed file, gone with
    the task.
    """

    _RECORD = struct.Struct("<6q")

    def __init__(self, limit: int = QUEUE_MESSAGES):
        self.limit, self.heap, self.heads, self.runs = limit, [], [], []

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        run.writelines(self._RECORD.pack(*m) for m in sorted(self.heap))
        run.seek(0)
        self.heap = []
        self.runs.append(self._read(run))
        self._next_of(len(self.runs) - 1)

    def _read(self, run):
        with run:
            while block := run.read(self._RECORD.size * RUN_RECORDS):
                yield from self._RECORD.iter_unpack(block)

    def _next_of(self, number: int) -> None:
        if (message := next(self.runs[number], None)) is not None:
            heapq.heappush(self.heads, (message, number))

    def first(self) -> tuple[int, ...] | None:
        heads = [self.heap[0]] if self.heap else []
        if self.heads:
            heads.append(self.heads[0][0])
        return min(heads) if heads else None

    def pop(self) -> tuple[int, ...]:
        if self.heads and not (self.heap and self.heap[0] <= self.heads[0][0]):
            message, number = heapq.heappop(self.heads)
            self._next_of(number)
            return message
        return heapq.heappop(self.heap)

    def pop_through(self, key: tuple[int, int, int] | None):
        """Sums (key, leaves, saved, children) of all messages up to ``key``, or of all, in order."""
        found = None
        while (top := self.first()) is not None and (key is None or top[:3] <= key):
            message = self.pop()
            if found is not None and found[0] == message[:3]:
                found = (found[0], *(a + b for a, b in zip(found[1:], message[3:])))
            else:
                if found is not None:
                    yield found
                found = (message[:3], *message[3:])
        if found is not None:
            yield found


def forward(batches: Iterator[pa.RecordBatch], limit: int = QUEUE_MESSAGES) -> Iterator[pa.RecordBatch]:
    """Totals of the nodes of each shard; rows come by shard, in reverse level order.

    Rows of one node are added up. What no node of the shard takes is marked ``leaving``.
    """
    names = ("shard", "depth", "k1", "k2", "p1", "p2", "leaves", "saved", "owned")

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in names))

    out: list[tuple] = []
    for shard, of_shard in groupby(rows(), key=lambda r: r[0]):
        queue = ForwardQueue(limit)
        for (depth, k1, k2), same in groupby(of_shard, key=lambda r: r[1:4]):
            leaves = saved = owned = children = 0
            for row in same:
                p1, p2 = row[4:6]
                leaves, saved, owned = leaves + row[6], saved + row[7], owned + row[8]
            key = (-depth, k1, k2)
            for to, *more in queue.pop_through(key):
                if to == key:
                    leaves, saved, children = leaves + more[0], saved + more[1], children + more[2]
                else:
                    out.append((shard, True, -to[0], *to[1:], *more))
            out.append((shard, False, depth, k1, k2, leaves, saved, children))
            queue.push((1 - depth, p1, p2, leaves, saved, owned))
            if len(out) >= 10_000:
                yield record_batch(_TOTAL, *zip(*out))
                out = []
        out += [(shard, True, -to[0], *to[1:], *more) for to, *more in queue.pop_through(None)]
    if out:
        yield record_batch(_TOTAL, *zip(*out))


def _time_forward(rows: DataFrame) -> DataFrame:
    names = ("shard", "depth", "k1", "k2", "p1", "p2", "leaves", "saved", "owned")
    return (
        rows.select(*(F.col(c).cast("long").alias(c) for c in names))
        .repartition("shard")
        .sortWithinPartitions("shard", F.desc("depth"), "k1", "k2")
        .mapInArrow(forward, _ddl(_TOTAL))
    )


def _id_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the ids of each node, in order, to texts of bounded length."""
    names = ("k1", "k2", "depth", "conv_id")
    key, ids, out = None, [], []

    def close():
        out.append((*key, ids[0], ",".join(map(str, ids))))

    for batch in batches:
        for *node, conv_id in zip(*(batch.column(c).to_pylist() for c in names)):
            if ids and (node != key or len(ids) >= BLOCK_IDS):
                close()
                ids = []
            key = node
            ids.append(conv_id)
        if out:
            yield record_batch(_BLOCK, *zip(*out))
            out = []
    if ids:
        close()
        yield record_batch(_BLOCK, *zip(*out))


def _id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined blocks of each node; one block is in memory at a time."""
    key, digest = None, None
    for batch in batches:
        out = []
        for *node, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "depth", "ids"))):
            if node == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = node, hashlib.sha256()
            digest.update(ids.encode())
        if out:
            yield record_batch(_ENDS, *zip(*out))
    if key is not None:
        yield record_batch(_ENDS, *zip((*key, digest.hexdigest())))


def _wrapped(a: Column, b: Column) -> Column:
    """a + b modulo 2^64, as a signed long."""
    total = a.cast("decimal(38,0)") + b.cast("decimal(38,0)")
    whole = F.lit(str(2**64)).cast("decimal(38,0)")
    low = F.pmod(total, whole)
    return F.when(low >= F.lit(str(2**63)).cast("decimal(38,0)"), low - whole).otherwise(low).cast("long")


def _own_turns(talks: DataFrame) -> DataFrame:
    """(conv_id, pos, d1, d2, size) of all turns in order; ``pos`` from 1."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turns = (
        short_batches(talks)
        .where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("size"))
        # Rows that are equal in all these would be one range; a number parts them.
        .withColumn("salt", F.monotonically_increasing_id())
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "digest", "salt"]
    half = [F.conv(F.substring("digest", at, 15), 16, 10).cast("long").alias(n) for at, n in ((1, "d1"), (16, "d2"))]
    placed = stored(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv_id", *half, "size")
        .mapInArrow(_placed, _ddl(_PLACED)),
        "turns",
    )
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("conv_id", "part")
        .agg(F.count("*").alias("n"))
        .select("conv_id", "part", F.sum("n").over(earlier).alias("before"))
        .where("before is not null")  # one row for a part at most
    )
    return placed.join(offsets, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "d1", "d2", "size"
    )


def rebuilt_turns(talks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turns) of all conversations as rebuilt, and their rows (conv_id, pos, d1, d2, size, turns)."""
    own = stored(_own_turns(talks), "own-turns")
    first = F.sort_array(F.collect_list(F.struct("pos", "d1", "d2", "size")))
    heads = own.where((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS)).groupBy("conv_id").agg(first.alias("head"))
    heads = heads.withColumnRenamed("conv_id", "family")
    checksum = F.crc32(F.col("conv_id").cast("string").cast("binary"))
    talks = (
        own.groupBy("conv_id")
        .agg(F.count("*").alias("n"))
        .withColumns({"h": checksum % HEADS, "family": F.col("conv_id") - F.col("conv_id") % FAMILY})
        .join(heads, "family", "left")
        .withColumn("k", F.least("h", F.coalesce(F.size("head"), F.lit(0)).cast("long")))
        .withColumn("k", F.greatest("k", F.lit(0)))
        .withColumn("turns", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv_id", "h", "k", "turns", "head")
    )
    talks = stored(talks, "talks")
    begun = talks.where("k > 0").select("conv_id", "turns", F.inline(F.slice("head", F.lit(1), F.col("k").cast("int"))))
    went_on = own.join(talks.select("conv_id", "h", "k", "turns"), "conv_id").where("pos > h")
    columns = ["conv_id", "pos", "d1", "d2", "size", "turns"]
    rows = begun.select(*columns).unionByName(
        went_on.withColumn("pos", F.col("pos") - F.col("h") + F.col("k")).select(*columns)
    )
    return talks.select("conv_id", "turns"), rows


def _prefix_rows(rows: DataFrame) -> DataFrame:
    """A row for each first turns of each conversation: keys of the prefix and of the one before."""
    lanes = rows.select(
        "conv_id", "pos", "size", "turns", F.xxhash64("pos", "d1", "d2").alias("l1"), F.xxhash64("d2", "pos", "d1").alias("l2")
    )
    summed = stored(
        lanes.repartitionByRange("conv_id", "pos").sortWithinPartitions("conv_id", "pos").mapInArrow(_prefixes, _ddl(_PREFIX)),
        "sums",
    )
    last = F.max_by(F.struct("k1", "k2"), "pos").alias("sum")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        summed.groupBy("conv_id", "part")
        .agg(last)
        .select("conv_id", "part", *(F.sum(F.col(f"sum.{k}").cast("decimal(38,0)")).over(earlier).alias(o) for k, o in (("k1", "o1"), ("k2", "o2"))))
        .where("o1 is not null")
    )
    joined = summed.join(offsets, ["conv_id", "part"], "left")
    moved = {
        c: F.when(F.col(o).isNull(), F.col(c)).otherwise(_wrapped(F.col(c), F.col(o)))
        for c, o in (("p1", "o1"), ("k1", "o1"), ("p2", "o2"), ("k2", "o2"))
    }
    return joined.withColumns(moved).drop("o1", "o2")


def _along_cut_paths(rows: DataFrame, leaving: DataFrame) -> DataFrame:
    """What shard roots pass to the parts that their conversation has in earlier shards."""
    parts = rows.groupBy("conv_id", "part").agg(F.min("pos").alias("from"), F.max("pos").alias("to"))
    order = Window.partitionBy("conv_id").orderBy("part")
    parts = parts.withColumns({"number": F.row_number().over(order), "before": F.lag("part").over(order), "cut": F.lead("from").over(order)})
    parts = parts.where("before is not null or cut is not null")
    # The part a message comes from begins one turn below the parent it is addressed to.
    sent = leaving.select(F.col("shard").alias("part"), (F.col("depth") + 1).alias("from"), "leaves", "saved")
    roots = parts.where("before is not null").join(sent, ["part", "from"]).select(
        F.col("conv_id").alias("shard"), F.col("number").alias("depth"), F.col("conv_id").alias("k1"), F.col("part").alias("k2"),
        F.col("conv_id").alias("p1"), F.col("before").alias("p2"), "leaves", "saved", F.lit(0).alias("owned"),
    )
    arriving = _time_forward(roots).where("not leaving").select(
        F.col("k1").alias("conv_id"), (F.col("depth") - 1).alias("number"), F.col("leaves"), F.col("saved")
    )
    to = parts.select("conv_id", "part", "number").join(arriving, ["conv_id", "number"]).drop("number")
    return rows.select("conv_id", "part", "pos", "k1", "k2").join(to, ["conv_id", "part"]).select(
        F.col("pos").alias("depth"), "k1", "k2", "leaves", "saved", F.lit(0).cast("long").alias("children")
    )


def prefix_trie(talks: DataFrame) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``talks`` has ``conv_id``, ``turn``, ``role`` and ``text``.
    """
    whole, turns = rebuilt_turns(talks)
    rows = stored(_prefix_rows(turns), "prefixes")
    long0 = F.lit(0).cast("long")
    root = whole.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.coalesce(F.sum(F.when(F.col("turns") == 0, 1).otherwise(0)), F.lit(0)).alias("n_ends"))
    root = root.where("n_convs > 0").select(
        long0.alias("depth"), long0.alias("k1"), long0.alias("k2"), long0.alias("p1"), long0.alias("p2"), "conv_id", "n_convs", "n_ends", long0.alias("size")
    )
    nodes = (
        rows.groupBy(F.col("pos").alias("depth"), "k1", "k2")
        .agg(
            F.min(F.struct("p1", "p2")).alias("p"),
            F.min("conv_id").alias("conv_id"),
            F.count("*").alias("n_convs"),
            F.sum(F.when(F.col("pos") == F.col("turns"), 1).otherwise(0)).alias("n_ends"),
            F.max("size").alias("size"),
        )
        .select("depth", "k1", "k2", "p.p1", "p.p2", "conv_id", "n_convs", "n_ends", "size")
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    # A node is owned by the smallest conversation that has it; (conversation, depth) is a key of both sides.
    own = nodes.select(
        "conv_id", F.col("depth").alias("pos"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
        F.lit(1).alias("owned"),
    )
    owned = rows.join(own, ["conv_id", "pos"], "left").select(
        F.col("part").alias("shard"), F.col("pos").alias("depth"), "k1", "k2", "p1", "p2",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("leaves", "saved", "owned")),
    )
    sent = stored(_time_forward(owned), "totals")
    leaving = sent.where("leaving")
    columns = ["depth", "k1", "k2", "leaves", "saved", "children"]
    of_root = own.where("pos = 0").select(long0.alias("depth"), long0.alias("k1"), long0.alias("k2"), "leaves", "saved", long0.alias("children"))
    cut = leaving.where("depth > 0")
    parts = [
        sent.where("not leaving or depth = 0"),
        of_root,
        cut.withColumns({"leaves": long0, "saved": long0}),
        cut.select(long0.alias("depth"), long0.alias("k1"), long0.alias("k2"), "leaves", "saved", long0.alias("children")),
        _along_cut_paths(rows, cut),
    ]
    totals = parts[0].select(*columns)
    for part in parts[1:]:
        totals = totals.unionByName(part.select(*columns))
    totals = totals.groupBy("depth", "k1", "k2").agg(*(F.sum(c).alias(c) for c in columns[3:]))

    ends = rows.where("pos = turns").select("k1", "k2", F.col("pos").alias("depth"), "conv_id").unionByName(
        whole.where("turns = 0").select(long0.alias("k1"), long0.alias("k2"), long0.alias("depth"), "conv_id")
    )
    order = ["k1", "k2", "depth", "conv_id"]
    blocks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_id_blocks, _ddl(_BLOCK))
    digests = (
        blocks.repartition("k1", "k2", "depth")
        .sortWithinPartitions("k1", "k2", "depth", "first")
        .mapInArrow(_id_digests, _ddl(_ENDS))
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    key = ["depth", "k1", "k2"]
    return (
        nodes.join(totals, key)
        .join(digests, key, "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
