"""Best-fit packing of token pieces into sequences, after dominance reduction.

A packing depends on lengths only, and there are at most 2,048 of them: the
histogram of lengths is the whole instance, however large the corpus, and its
size is proven. The plan is made on it: first the dominance criterion of Martello
and Toth fixes sets (a piece alone, or with one partner) that no other choice can
beat, in bulk, and shrinks the instance; then the rest is packed by best fit in
decreasing order, where bins of one filling are handled as one group. The plan
says which ranks of a length go to which sequences at which offset.

Pieces get their rank among those of their length by two-level counting: counts
by (stored part, length) are summed up over parts, then rows are numbered inside
a part. A length that a third of all pieces have is so spread over all parts.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from dosewright.llm.common import record_batch, short_batches
from dosewright.session import stored

CAPACITY = 2048
END = 0
TOKENIZER = "word_bpe_49k.json"
#: Tokenized words in one generation of a task's memory, which is emptied at its end.
REMEMBERED = 200_000
#: Bytes of text that are split into words at once, and distinct words of it that are looked up at once.
AT_ONCE = 4_000_000
WORDS_AT_ONCE = 20_000

# Normaliser and splits of the tokenizer's own file.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_SPLITS = [
    {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Pieces of words that stand in lines, and the line ends between them.
_SPLIT = regex.compile(_PATTERN + r"|\n")
#: Words of plain characters are normalised alike by Python and by the tokenizer; others, and parts of special tokens, are not.
_NOT_PLAIN = re.compile(r"[^\n\x21-\x7E\xA1-ſ]|<\|")

_PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.binary()),
    ]
)


class Memory:
    """Results of a function of many keys, of two generations: when the younger is full, the older is let go.

    What is asked for again moves to the younger one, so frequent keys stay.
    """

    def __init__(self, make, limit: int):
        self.make, self.limit = make, limit
        self.forget()

    def learn(self, keys: set) -> None:
        """Afterwards the younger generation holds all ``keys``."""
        new = keys.difference(self.younger)
        if self.younger and len(self.younger) + len(new) > self.limit:
            self.younger, self.older = {}, self.younger
            new = keys
        unknown = new.difference(self.older)
        older = self.older
        self.younger.update((key, older[key]) for key in new.difference(unknown))
        if unknown:
            made = list(unknown)
            self.younger.update(zip(made, self.make(made), strict=True))

    def forget(self) -> None:
        self.younger, self.older = {}, {}


class WordTokenizer:
    """Ids of whole texts as little-endian bytes, from remembered words.

    A tokenizer that splits as ``TOKENIZER`` does never joins what white space
    parts, so a text's ids are those of its words (here: what stands between ASCII white
    space). New words of plain letters and signs are normalised and split together, and
    their new pieces go through the model alone; all others, those with other white space,
    and special tokens go through the whole tokenizer. A tokenizer of any other kind is
    given whole texts.
    """

    #: Stands for a line end between words. Ids are far smaller, so their bytes never hold it.
    _LINE_END = b"\xff\xff\xff\xff"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.by_words = self._splits_words(json.loads(self.whole.to_str()))
        self.words = Memory(self._new_words, REMEMBERED)
        self.pieces = Memory(self._new_pieces, REMEMBERED)
        letters = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in letters]
        # bytes as the byte-level model spells them: printable ones as they are, others from U+0100 on
        self.spelling = {b: chr(b) for b in letters} | {b: chr(256 + i) for i, b in enumerate(rest)}

    @staticmethod
    def _splits_words(parts: dict) -> bool:
        normalizer, splits, model = parts["normalizer"] or {}, parts["pre_tokenizer"] or {}, parts["model"]
        special = [t["content"] for t in parts["added_tokens"]]
        return (
            normalizer.get("normalizers") == _NORMALIZERS
            and splits.get("pretokenizers") == _SPLITS
            and model["type"] == "BPE"
            and not parts["post_processor"]
            and not parts["truncation"]
            and all(t.startswith("<|") and not re.search(r"\s", t) for t in special)
        )

    def _whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _new_words(self, words: list[str]) -> Iterable[bytes]:
        lines = "\n".join(words)
        if not _NOT_PLAIN.search(lines):
            return self._plain_words(lines)
        ids = {word: self._whole(word) for word in words if _NOT_PLAIN.search(word)}
        plain = [word for word in words if word not in ids]
        ids.update(zip(plain, self._plain_words("\n".join(plain))))
        return map(ids.__getitem__, words)

    def _plain_words(self, lines: str) -> list[bytes]:
        """Ids of each line, a word of plain characters."""
        if not lines.isascii():
            lines = unicodedata.normalize("NFC", lines)
        words = lines.lower().split("\n")
        alone = [word.isalpha() for word in words]  # letters are one piece
        parts = _SPLIT.findall("\n".join([word for word, one in zip(words, alone) if not one]))
        self.pieces.learn({*parts, *compress(words, alone)})
        known = self.pieces.younger
        split = iter(b"".join(map(known.__getitem__, parts)).split(self._LINE_END))
        return [known[word] if one else next(split) for word, one in zip(words, alone)]

    def _new_pieces(self, parts: list[str]) -> Iterator[bytes]:
        spelling, tokenize = self.spelling, self.model.tokenize
        for part in parts:
            if part == "\n":
                yield self._LINE_END
                continue
            ids = [t.id for t in tokenize(part if part.isascii() else "".join(map(spelling.__getitem__, part.encode())))]
            yield struct.pack(f"<{len(ids)}I", *ids)

    def forget(self) -> None:
        self.words.forget()
        self.pieces.forget()

    def _of_words(self, texts: pa.Array) -> Iterator[bytes]:
        split = pc.ascii_split_whitespace(texts)
        words = split.values.dictionary_encode()
        ids: list[bytes] = []
        for k in range(0, len(words.dictionary), WORDS_AT_ONCE):
            part = words.dictionary.slice(k, WORDS_AT_ONCE).to_numpy(zero_copy_only=False).tolist()
            known = list(map(self.words.younger.get, part))
            missing = [word for word, found in zip(part, known) if found is None]
            self.words.learn(set(missing))
            learnt = map(self.words.younger.__getitem__, missing)
            ids += [next(learnt) if found is None else found for found in known]
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        length = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        start = np.cumsum(length) - length
        place = words.indices.to_numpy()
        n = length[place]
        ends = np.concatenate([[0], np.cumsum(n)])
        taken = flat[np.repeat(start[place] - ends[:-1], n) + np.arange(ends[-1])]
        of_text = ends[split.offsets.to_numpy()].tolist()
        for first, end in zip(of_text, of_text[1:]):
            yield taken[first:end].tobytes()

    def each(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each of ``texts``, in order; null counts as empty."""
        texts = texts.fill_null("")
        if not self.by_words:
            yield from map(self._whole, texts.to_pylist())
            return
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        first = 0
        while first < len(texts):  # a longer text is alone
            room = AT_ONCE + (ends[first - 1] if first else 0)
            end = max(first + 1, int(np.searchsorted(ends, room, side="right")))
            yield from self._of_words(texts.slice(first, end - first))
            first = end

    def __call__(self, text: str) -> bytes:
        return next(self.each(pa.array([text], pa.string())))


@lru_cache(maxsize=2)
def word_tokenizer(path: str | None) -> WordTokenizer:
    """One tokenizer a Python worker; without a path, the public file of this machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    return WordTokenizer(path)


def tokenized(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32, ids`` (little-endian 32-bit).

    Without ``with_ids`` the ids themselves do not leave the Python worker.
    A document is its ids and the end id; only documents longer than ``capacity``
    are cut, the last piece may be shorter. A null text counts as empty and is
    the end id alone. Repeated rows are documents of their own.
    """
    end = np.array([END], dtype="<u4").tobytes()
    schema = _PIECE if with_ids else _PIECE.remove(_PIECE.get_field_index("ids"))

    def run(batches):
        encode = word_tokenizer(path)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode.each(batch.column("text")), strict=True):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    rows.append((doc_id, piece, start // 4, len(part) // 4, zlib.crc32(part), part))
            if rows:
                yield record_batch(schema, *zip(*rows))
        encode.forget()  # the Python worker goes on to other tasks

    return short_batches(docs).select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    )


class Plan:
    """Packing of a histogram ``{length: pieces}`` into bins of ``capacity``.

    ``rows`` are (length, first rank, ranks, first bin, ranks to a bin, offset).
    """

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in histogram.items():
            self.left[length] = n
        self.used = np.zeros(capacity + 1, dtype=np.int64)  # ranks given out
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0
        self.fixed = 0
        self._reduce()
        self._best_fit()

    def _place(self, length: int, n: int, first_bin: int, each: int, offset: int) -> None:
        self.rows.append((length, int(self.used[length]), n, first_bin, each, offset))
        self.used[length] += n
        self.left[length] -= n

    def _largest(self, room: int, besides: int) -> int:
        """Largest piece left that fits, one of length ``besides`` not counted; 0 if none."""
        fits = np.flatnonzero(self.left[: room + 1])
        if len(fits) and fits[-1] == besides and self.left[besides] < 2:
            fits = fits[:-1]
        return int(fits[-1]) if len(fits) else 0

    def _smallest(self, n: int, besides: int) -> list[int]:
        """The ``n`` smallest pieces left, one of length ``besides`` not counted."""
        out: list[int] = []
        for length in np.flatnonzero(self.left):
            count = int(self.left[length]) - (length == besides)
            out += [int(length)] * min(n - len(out), count)
            if len(out) == n:
                break
        return out

    def _best_pair(self, room: int, besides: int) -> int:
        """Largest sum of two pieces left that fits; 0 if none does."""
        lengths = np.flatnonzero(self.left[: room + 1])
        counts = self.left[lengths] - (lengths == besides)
        lengths, counts = lengths[counts > 0], counts[counts > 0]
        sums = lengths[:, None] + lengths[None, :]
        same = np.eye(len(lengths), dtype=bool) & (counts < 2)[:, None]
        sums = sums[(sums <= room) & ~same]
        return int(sums.max()) if sums.size else 0

    def _partner(self, length: int) -> int | None:
        """Partner of the dominating set of a piece; 0: it stays alone; None: no set dominates."""
        room = self.capacity - length
        best = self._largest(room, length)
        if not best or best == room:
            return best
        least = self._smallest(3, length)
        if len(least) < 2 or least[0] + least[1] > room:
            return best  # nothing but a single piece fits beside it
        if (len(least) < 3 or sum(least) > room) and self._best_pair(room, length) <= best:
            return best  # pairs fit, but the single piece is worth them
        return None

    def _reduce(self) -> None:
        """Fixes dominating sets until no length has one."""
        changed = True
        while changed:
            changed = False
            for length in range(self.capacity, 0, -1):
                while self.left[length] and (partner := self._partner(length)) is not None:
                    if partner == length:
                        n = int(self.left[length]) // 2
                        self._place(length, 2 * n, self.bins, 2, 0)
                    elif partner:
                        n = int(min(self.left[length], self.left[partner]))
                        self._place(length, n, self.bins, 1, 0)
                        self._place(partner, n, self.bins, 1, length)
                    else:
                        n = int(self.left[length])
                        self._place(length, n, self.bins, 1, 0)
                    self.bins += n
                    self.fixed += n
                    changed = True

    def _best_fit(self) -> None:
        """Best fit in decreasing order over groups of equally filled bins."""
        open_bins: dict[int, list[tuple[int, int]]] = {}  # room -> [(first bin, bins)]
        for length in range(self.capacity, 0, -1):
            while n := int(self.left[length]):
                room = min((r for r in open_bins if r >= length), default=None)
                if room is None:
                    first, count, room = self.bins, n, self.capacity
                    self.bins += -(-n // (room // length))
                    count = self.bins - first
                else:
                    first, count = open_bins[room].pop()
                    if not open_bins[room]:
                        del open_bins[room]
                each = room // length  # best fit keeps to a bin while the length fits
                offset = self.capacity - room
                full = min(count, n // each)
                rest = n - full * each if full < count else 0
                if full:
                    self._place(length, full * each, first, each, offset)
                    open_bins.setdefault(room - each * length, []).append((first, full))
                if rest:
                    self._place(length, rest, first + full, rest, offset)
                    open_bins.setdefault(room - rest * length, []).append((first + full, 1))
                untouched = count - full - bool(rest)
                if untouched:
                    open_bins.setdefault(room, []).append((first + full + bool(rest), untouched))
            open_bins.pop(0, None)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``, from 1 to ``capacity``) and their ``sequence_id`` and ``offset``.

    Rows are packed as they are, repeated rows and null ids included; an empty
    table gives an empty result. Columns named like the two results are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    columns = pieces.columns
    held = stored(pieces.withColumn("__part", F.spark_partition_id()), "pieces")
    by_part = held.groupBy("__part", "length").agg(F.count("*").alias("__n"))
    by_part = stored(by_part, "piece-counts")
    histogram = {r[0]: r[1] for r in by_part.groupBy("length").agg(F.sum("__n")).collect()}  # at most one row a length
    plan = Plan(histogram, capacity)
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    by_part = by_part.select("__part", "length", F.coalesce(before, F.lit(0)).alias("__before"))
    # ordered by every column: rows that tie are equal, so a task that runs again numbers alike
    number = F.row_number().over(Window.partitionBy("__part", "length").orderBy(*columns))
    ranked = held.withColumn("__number", number).join(by_part, ["__part", "length"])
    ranked = ranked.select(*columns, (F.col("__before") + F.col("__number") - 1).alias("__rank"))
    rows = np.array(sorted(plan.rows), dtype=np.int64).reshape(-1, 6)

    def placed(batches):
        # ranks of a length are counted on from those of shorter ones, so one search finds a row of the plan
        first = rows[:, 0] * (1 << 48) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "__rank"))
            row = rows[np.searchsorted(first, length * (1 << 48) + rank, side="right") - 1]
            at = rank - row[:, 1]
            out = {c: batch.column(c) for c in columns}
            out["sequence_id"] = pa.array(row[:, 3] + at // row[:, 4])
            out["offset"] = pa.array(row[:, 5] + at % row[:, 4] * length)
            yield pa.RecordBatch.from_pydict(out)

    fields = [*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return ranked.mapInArrow(placed, StructType(fields))


def packed_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs`` with their place, without the ids themselves."""
    return pack(tokenized(docs, path, capacity, with_ids=False), capacity)
