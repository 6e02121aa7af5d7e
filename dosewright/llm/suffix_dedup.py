"""Substring dedup: every byte covered by a 100-byte string that also starts earlier is removed.

Anchors. Each string of ``LENGTH`` bytes has an anchor, the position of the smallest hash among
its ``GRAM``-byte grams (the leftmost of equals). Equal strings have it at the same place, so
only strings that share an anchor gram need to be compared. Successive strings with one anchor
are a segment; a text has one for some 35 bytes, and one row of fixed size travels for it.

Equal segments. Rows meet by anchor gram. Of equal segments, told by 128 bits of two
polynomial hashes, all but those of the earliest document are repeats as a whole. Grams with
one kind of segment are done.

Suffix sort. The rest, one segment of each kind, are cut from the texts and suffix-sorted by
anchor gram: prefix polynomial hashes and binary search give the common extension of two
suffixes, so a comparison in the merge sort takes logarithmically many steps. Neighbours that
agree for the whole length are compared byte by byte; where hashes lied, the suffixes are
sorted by their bytes. The merges of all groups in a block run together in numpy. A gram is
never cut: one whose segments take more than a block is a block of its own.

A gram with more than ``MOST_SEGMENTS`` kinds of segments (a passage that very many documents
quote between different words) is not sorted in one task: its strings go out as
128-bit hashes, and the smallest document of each is found by an ordinary aggregate.

Odd cases: null and empty texts have no bytes. A null ``doc_id`` counts as the largest long. Rows
of one ``doc_id`` are no earlier than one another: each is compared with smaller ids and with
itself. Texts are bytes; what is left may not be UTF-8, so it is given as binary. Long texts
are hashed in blocks. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm.common import record_batch, short_batches
from dosewright.session import stored

LENGTH, GRAM = 100, 32
#: Grams of a string.
GRAMS = LENGTH - GRAM + 1
MOST_SEGMENTS = 4096
#: Strings hashed at once; bytes of segments sorted at once.
BLOCK, SORT_BYTES = 1 << 18, 1 << 19
LAST_ID = (1 << 63) - 1

_draw = np.random.default_rng(100)


def _odd() -> int:
    return int(_draw.integers(1 << 62, 1 << 63)) * 2 + 1


_BASES = (_odd(), _odd())
_MIX = np.uint64(_odd())
_BYTE = _draw.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


#: Powers of the bases and of their inverses, by lane; longer ones take their place where they are too short.
_POWER = [np.empty(0, dtype=np.uint64)] * 2
_INVERSE = [np.empty(0, dtype=np.uint64)] * 2


def _reach(lane: int, size: int) -> None:
    """Powers for ``size`` bytes. A gram is sorted whole, so its segments may take more than ``SORT_BYTES``."""
    if len(_INVERSE[lane]) <= size:
        size = max(size, BLOCK + LENGTH, SORT_BYTES)
        _POWER[lane] = _powers(_BASES[lane], size)
        _INVERSE[lane] = _powers(pow(_BASES[lane], -1, 1 << 64), size + 1)


_ROW = pa.schema([(c, pa.int64()) for c in ("gram", "segment", "doc", "sub", "at")])
_DECIDED = pa.schema([(c, pa.int64()) for c in ("gram", "doc", "sub", "start", "strings", "anchor")])
_CUT = pa.schema(
    [(c, pa.int64()) for c in ("gram", "other", "doc", "sub", "start", "strings", "anchor")] + [("bytes", pa.binary())]
)
_REPEAT = pa.schema([(c, pa.int64()) for c in ("doc", "sub", "start", "strings")])
_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'long'}" for f in schema)


class Hashes:
    """Prefix hashes of some bytes; any substring's hash is a difference of two."""

    def __init__(self, data: np.ndarray, lane: int):
        _reach(lane, len(data))
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[lane][data] * _POWER[lane][: len(data)], out=self.prefix[1:])
        self.inverse = _INVERSE[lane]

    def of(self, start, end):
        return (self.prefix[end] - self.prefix[start]) * self.inverse[start]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def anchors(grams: np.ndarray) -> np.ndarray:
    """For each run of ``GRAMS`` values, how far from its start its smallest stands, the leftmost of equals."""
    value, away, width = grams, np.zeros(len(grams), dtype=np.uint8), 1
    while width < GRAMS:
        shift = min(width, GRAMS - width)
        right = value[shift:] < value[:-shift]
        away = np.where(right, away[shift:] + np.uint8(shift), away[:-shift])
        value = np.where(right, value[shift:], value[:-shift])
        width += shift
    return away


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, gram, segment, start, strings - 1, anchor - start) of the segments of texts laid end to end.

    ``ends`` are the ends of the texts in ``data``.
    """
    found = []
    for low in range(0, len(data) - LENGTH + 1, BLOCK):
        part = data[low : low + BLOCK + LENGTH - 1]
        count = len(part) - LENGTH + 1
        one, two = Hashes(part, 0), Hashes(part, 1)
        at = np.arange(len(part) - GRAM + 1)
        gram = _mixed(one.of(at, at + GRAM))
        start = at[:count]
        anchor = start + anchors(gram)
        first, last = np.searchsorted(ends, (low, low + count - 1), "right")
        inside = np.diff(np.clip(ends[first : last + 1] - low, 0, count), prepend=0)
        text = np.repeat(np.arange(first, last + 1), inside)
        whole = ends[text] - low - start >= LENGTH
        new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
        begin = np.flatnonzero(new & whole)
        # A segment goes on to the next one's start or to the last whole string of its text.
        stop = np.flatnonzero(whole & np.concatenate([new[1:] | ~whole[1:], [True]]))
        more = stop - begin
        kind = two.of(begin, stop + LENGTH) ^ (one.of(begin, stop + LENGTH) * _MIX) ^ more.astype(np.uint64)
        found.append((text[begin], gram[anchor[begin]], _mixed(kind), begin + low, more, anchor[begin] - begin))
    if not found:
        return tuple(np.empty(0, dtype=t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found))


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and their offsets."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _later(same: np.ndarray, doc, sub, at) -> np.ndarray:
    """Which rows have an earlier one in their run; rows are sorted by run, document and place.

    ``same`` tells for each row but the first whether it goes on with the run before it.
    Rows of one document number but different texts (``sub``) are not earlier than each other.
    """
    new = np.concatenate([[True], ~same])
    of_run = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    new_text = new | np.concatenate([[True], (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1])])
    of_text = np.maximum.accumulate(np.where(new_text, np.arange(len(new)), 0))
    return (doc > doc[of_run]) | (at > at[of_text])


def _packed(start, more, anchor):
    return start << 14 | more << 7 | anchor


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the texts; those that repeat an earlier one of the batch are told as repeats.

    A repeat has a negative place, and the number of its strings in ``segment``.
    """
    for batch in batches:
        data, offsets = _texts(batch.column("text"))
        text, gram, kind, start, more, anchor = segments(data, offsets[1:])
        if not len(text):
            continue
        doc, sub = (batch.column(c).to_numpy()[text] for c in ("doc", "sub"))
        at = _packed(start - offsets[text], more, anchor)
        gram, kind = gram.view(np.int64), kind.view(np.int64)
        order = np.lexsort((at, sub, doc, kind, gram))
        gram, kind, doc, sub, at = (c[order] for c in (gram, kind, doc, sub, at))
        later = _later((gram[1:] == gram[:-1]) & (kind[1:] == kind[:-1]), doc, sub, at)
        yield record_batch(_ROW, *(c[~later] for c in (gram, kind, doc, sub, at)))
        if later.any():
            doc, sub, start, strings = _joined(doc[later], sub[later], at[later] >> 14, (at[later] >> 7 & 127) + 1)
            spread = _mixed((doc ^ start).astype(np.uint64)).view(np.int64)
            yield record_batch(_ROW, spread, strings, doc, sub, -1 - start)


def _joined(doc, sub, start, strings):
    """Runs of strings that follow one another in a text, as one."""
    order = np.lexsort((start, sub, doc))
    doc, sub, start, strings = (c[order] for c in (doc, sub, start, strings))
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (sub[1:] != sub[:-1]) | (start[1:] != start[:-1] + strings[:-1])
    at = np.flatnonzero(new)
    return doc[at], sub[at], start[at], np.add.reduceat(strings, at) if len(at) else strings


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats of whole segments, and the segments to be compared with others of their gram.

    Rows come by gram, kind of segment, document and place. Of the run that may go on in the next batch
    its first row and the first of its last text are kept, and one kind of segments at most.
    """
    ghosts = [np.empty(0, dtype=np.int64)] * 5
    waiting = [np.empty(0, dtype=np.int64)] * 5
    compared = None  # the gram whose segments are being compared
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in range(5)]
        told = rows[4] < 0
        if told.any():
            _, strings, doc, sub, at = (c[told] for c in rows)
            yield _as_repeats(doc, sub, -1 - at, strings)
            rows = [c[~told] for c in rows]
        if not len(rows[0]):
            continue
        n_ghosts = len(ghosts[0])
        gram, kind, doc, sub, at = rows = [np.concatenate(x) for x in zip(ghosts, rows)]
        same = (gram[1:] == gram[:-1]) & (kind[1:] == kind[:-1])
        later = _later(same, doc, sub, at)
        new = np.flatnonzero(np.concatenate([[True], ~same]))[-1]
        text = new + np.flatnonzero((doc[new:] != doc[-1]) | (sub[new:] != sub[-1]))[-1:] + 1
        ghosts = [c[[new, *text]] for c in rows]
        later[:n_ghosts] = False
        if later.any():
            yield _as_repeats(doc[later], sub[later], at[later] >> 14, (at[later] >> 7 & 127) + 1)
        first = ~later
        first[:n_ghosts] = False
        gram, kind, doc, sub, at = rows = [np.concatenate([w, c[first]]) for w, c in zip(waiting, rows)]
        if not len(gram):
            continue
        new = np.concatenate([[True], gram[1:] != gram[:-1]])
        group = np.cumsum(new) - 1
        kinds = np.concatenate([[False], (gram[1:] == gram[:-1]) & (kind[1:] != kind[:-1])])
        several = np.zeros(group[-1] + 1, dtype=bool)
        several[group[kinds]] = True
        several |= gram[new] == compared if compared is not None else False
        open_ = group == group[-1]
        compared = int(gram[-1]) if several[-1] else None
        waiting = [c[:0] if several[-1] else c[open_] for c in rows]
        out = several[group]
        if out.any():
            yield record_batch(_DECIDED, gram[out], doc[out], sub[out], at[out] >> 14, (at[out] >> 7 & 127) + 1, at[out] & 127)


def _as_repeats(doc, sub, start, strings) -> pa.RecordBatch:
    nothing = pa.nulls(len(doc), pa.int64())
    return record_batch(_DECIDED, nothing, doc, sub, start, strings, nothing)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the segments to be compared; of crowded grams the hash of each string instead."""
    for batch in batches:
        data, offsets = _texts(batch.column("text"))
        wanted = batch.column("wanted")
        row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        fields = wanted.flatten()
        gram, start, strings, anchor = (fields.field(c).to_numpy() for c in ("gram", "start", "strings", "anchor"))
        crowded = fields.field("crowded").to_numpy(zero_copy_only=False)
        doc, sub = (batch.column(c).to_numpy()[row] for c in ("doc", "sub"))
        here = np.flatnonzero(~crowded)
        for part in np.array_split(here, len(here) // 4096 + 1):
            base = offsets[row[part]] + start[part]
            cut = [data[b : b + n].tobytes() for b, n in zip(base.tolist(), (strings[part] + LENGTH - 1).tolist())]
            nothing = pa.nulls(len(part), pa.int64())
            yield record_batch(_CUT, gram[part], nothing, doc[part], sub[part], start[part], strings[part], anchor[part], cut)
        for at in np.flatnonzero(crowded).tolist():
            base = int(offsets[row[at]] + start[at])
            piece = data[base : base + int(strings[at]) + LENGTH - 1]
            begin = np.arange(int(strings[at]))
            h1, h2 = (_mixed(Hashes(piece, lane).of(begin, begin + LENGTH)).view(np.int64) for lane in (0, 1))
            many = [np.full(len(begin), c[at]) for c in (doc, sub)]
            none = pa.nulls(len(begin), pa.binary())
            yield record_batch(_CUT, h1, h2, *many, start[at] + begin, np.ones_like(begin), np.zeros_like(begin), none)


class SuffixSort:
    """Merge sort of suffixes in groups, compared through prefix hashes up to ``LENGTH`` bytes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.hashes = Hashes(data, 0)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bytes that suffixes have in common, by binary search."""
        length, step = np.zeros(len(a), dtype=np.int64), 64
        while step:
            longer = length + step
            fits = longer <= LENGTH
            end = np.where(fits, longer, length)
            equal = self.hashes.of(a + length, a + end) == self.hashes.of(b + length, b + end)
            length = np.where(fits & equal, longer, length)
            step //= 2
        return length

    def before(self, a, b, rank_a, rank_b) -> np.ndarray:
        """Whether suffix a comes before b; equals by rank."""
        length = self.common(a, b)
        equal = length == LENGTH
        at = np.minimum(length, LENGTH - 1)
        return np.where(equal, rank_a < rank_b, self.data[a + at] < self.data[b + at])

    def order(self, suffix: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Permutation that sorts within groups, which stand together; equals stay in order."""
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(starts, len(group)))
        start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
        order, width = np.arange(len(suffix)), 1
        while (active := np.flatnonzero(size > width)).size:
            low, end = start[active], start[active] + size[active]
            block = (active - low) // width
            pair = low + (block & ~1) * width
            left = np.minimum(low + (block ^ 1) * width, end)
            other = left.copy()
            right = np.minimum(left + width, end)
            own = order[active]
            while (open_ := np.flatnonzero(left < right)).size:
                middle = (left[open_] + right[open_]) // 2
                theirs, mine = order[middle], own[open_]
                less = self.before(suffix[theirs], suffix[mine], theirs, mine)
                left[open_] = np.where(less, middle + 1, left[open_])
                right[open_] = np.where(less, right[open_], middle)
            to = pair + (active - low) % width + (left - other)
            order[to] = own
            width *= 2
        return order

    def runs(self, suffix: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(order, same): sorted suffixes, and whether each but the first equals the one before it, as bytes."""
        order = self.order(suffix, group)
        same, lied = self._same(suffix, group, order)
        if lied.any():
            # A hash took different bytes for equal ones: these groups are sorted by their bytes.
            for wrong in np.unique(group[order][1:][lied]).tolist():
                at = np.flatnonzero(group == wrong)
                texts = [self.data[s : s + LENGTH].tobytes() for s in suffix[at].tolist()]
                order[at] = at[sorted(range(len(at)), key=lambda i: (texts[i], i))]
            same, _ = self._same(suffix, group, order, by_bytes=True)
        return order, same

    def _same(self, suffix, group, order, by_bytes: bool = False):
        a, b = suffix[order][:-1], suffix[order][1:]
        together = group[order][1:] == group[order][:-1]
        maybe = np.flatnonzero(together if by_bytes else together & (self.common(a, b) == LENGTH))
        same, lied = np.zeros(len(a), dtype=bool), np.zeros(len(a), dtype=bool)
        for part in np.array_split(maybe, len(maybe) // 8192 + 1):
            span = np.arange(LENGTH)
            equal = (self.data[a[part][:, None] + span] == self.data[b[part][:, None] + span]).all(axis=1)
            same[part], lied[part] = equal, ~equal
        return same, lied


def _sorted_block(rows: list[tuple]) -> pa.RecordBatch | None:
    """Repeats among the strings of segments (gram, doc, sub, start, strings, anchor, bytes), by gram."""
    gram, doc, sub, start, strings, anchor = (np.array(c, dtype=np.int64) for c in list(zip(*rows))[:6])
    data = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    base = np.concatenate([[0], np.cumsum(strings + LENGTH - 1)[:-1]])
    row = np.repeat(np.arange(len(rows)), strings)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
    # Only strings of one gram that have it at the same place can be equal.
    number = np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]]))
    group = number[row] * (2 * LENGTH) + anchor[row] - inner
    place = start[row] + inner
    by_group = np.lexsort((place, sub[row], doc[row], group))
    row, inner, group, place = row[by_group], inner[by_group], group[by_group], place[by_group]
    order, same = SuffixSort(data).runs(base[row] + inner, group)
    row, place = row[order], place[order]
    later = _later(same, doc[row], sub[row], place)
    if not later.any():
        return None
    return record_batch(_REPEAT, *_joined(doc[row][later], sub[row][later], place[later], np.ones(later.sum(), dtype=np.int64)))


def _suffix_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorts segments, which come by gram, in blocks of whole grams."""
    names = ("gram", "doc", "sub", "start", "strings", "anchor", "bytes")
    rows, size, whole = [], 0, 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if rows and row[0] != rows[-1][0]:
                whole = len(rows)
            rows.append(row)
            size += len(row[6])
            if size >= SORT_BYTES // 2 and whole:
                if (found := _sorted_block(rows[:whole])) is not None:
                    yield found
                rows, whole = rows[whole:], 0
                size = sum(len(r[6]) for r in rows)
    if rows and (found := _sorted_block(rows)) is not None:
        yield found


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text, repeats in zip(*(batch.column(c) for c in ("doc_id", "text", "repeats"))):
            text = text.as_buffer() if text.is_valid else b""
            data = np.frombuffer(text, np.uint8)
            spans, kept = [], text
            if repeats.is_valid:
                start = repeats.values.field("start").to_numpy()
                end = start + repeats.values.field("strings").to_numpy() + LENGTH - 1
                order = np.argsort(start, kind="stable")
                start, end = start[order], np.maximum.accumulate(end[order])
                new = np.concatenate([[True], start[1:] > end[:-1]])
                first = np.flatnonzero(new)
                start, end = start[first], end[np.append(first[1:], len(new)) - 1]
                edge = np.zeros(len(data) + 1, dtype=np.int8)
                edge[start], edge[end] = 1, -1
                kept = data[np.cumsum(edge[:-1], dtype=np.int8) == 0].tobytes()
                spans = [{"start": s, "end": e} for s, e in zip(start.tolist(), end.tolist())]
            out.append((doc_id.as_py(), len(data), len(data) - len(kept), spans, bytes(kept)))
        if out:
            ids, sizes, removed, spans, kept = zip(*out)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )


def _with_key(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``doc`` orders documents; ``sub`` tells texts of one ``doc_id`` apart where an id is repeated at all, as is told."""
    docs = short_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("doc", F.coalesce("doc_id", F.lit(LAST_ID)))
    repeated = docs.groupBy("doc").count().where("count > 1").limit(1).count() > 0
    return docs.withColumn("sub", F.xxhash64("text") if repeated else F.lit(0).cast("long")), repeated


def repeated_strings(docs: DataFrame, alike: bool = True) -> DataFrame:
    """(doc, sub, start, strings): runs of strings of ``LENGTH`` bytes that also start earlier.

    ``alike`` tells that rows may be alike in id and text. They give the same segments, which are compared
    once: otherwise each copy would meet the segments of all others.
    """
    rows = docs.select("doc", "sub", "text").mapInArrow(_index, _ddl(_ROW))
    decided = stored(
        rows.repartition("gram")
        .sortWithinPartitions("gram", "segment", "doc", "sub", "at")
        .mapInArrow(_decide, _ddl(_DECIDED)),
        "segments",
    )
    open_ = decided.where("gram is not null")
    if alike:
        open_ = open_.distinct()
    crowded = open_.groupBy("gram").count().where(F.col("count") > MOST_SEGMENTS).select("gram", F.lit(True).alias("crowded"))
    wanted = (
        open_.join(crowded, "gram", "left")
        .groupBy("doc", "sub")
        .agg(
            F.collect_list(
                F.struct("gram", "start", "strings", "anchor", F.coalesce("crowded", F.lit(False)).alias("crowded"))
            ).alias("wanted")
        )
    )
    texts = docs.select("doc", "sub", "text").join(wanted, ["doc", "sub"])
    if alike:
        texts = texts.dropDuplicates(["doc", "sub"])
    cut = stored(texts.mapInArrow(_cut, _ddl(_CUT)), "cut")
    by_sort = (
        cut.where("bytes is not null")
        .repartition("gram")
        .sortWithinPartitions("gram", "doc", "sub", "start")
        .mapInArrow(_suffix_sorted, _ddl(_REPEAT))
    )
    strings = cut.where("bytes is null").select(F.col("gram").alias("h1"), F.col("other").alias("h2"), "doc", "sub", "start")
    earliest = strings.groupBy("h1", "h2").agg(F.min("doc").alias("least"))
    own = strings.groupBy("h1", "h2", "doc", "sub").agg(F.min("start").alias("first"), F.collect_set("start").alias("starts"))
    by_hash = (
        own.join(earliest, ["h1", "h2"])
        .select("doc", "sub", F.explode("starts").alias("start"), (F.col("doc") > F.col("least")).alias("later"), "first")
        .where("later or start > first")
        .select("doc", "sub", "start", F.lit(1).cast("long").alias("strings"))
    )
    whole = decided.where("gram is null").select("doc", "sub", "start", "strings")
    found = whole.unionByName(by_sort).unionByName(by_hash)
    return found.distinct() if alike else found


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): each document without the bytes of strings that start earlier.

    ``spans`` are the maximal runs removed, as places in the input; ``kept`` are the bytes left.
    """
    docs, repeated = _with_key(docs)
    repeats = (
        repeated_strings(docs, repeated)
        .groupBy("doc", "sub")
        .agg(F.collect_list(F.struct("start", "strings")).alias("repeats"))
    )
    return (
        docs.join(repeats, ["doc", "sub"], "left")
        .select("doc_id", F.col("text").cast("binary").alias("text"), "repeats")
        .mapInArrow(_cleaned, _RESULT)
    )
