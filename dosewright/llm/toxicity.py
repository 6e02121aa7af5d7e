"""Toxicity: undo obfuscation with a noisy-channel model, then score the restored words.

Channel: a writer replaces letters by look-alikes (``1d10t``), puts signs or
blanks between them (``i.d i o t``) or repeats them (``idiooot``). A word so
written is a lattice of readings for each character, each with a channel cost.
Viterbi decoding picks the reading most likely under a character trigram model,
which is counted over all documents. Words of letters without such traces, at the
end or elsewhere, have a single reading and are taken as they stand, as are
tokens without a letter. Tokens of more than 64 characters are decoded in pieces
cut at signs. Decoded words are remembered.

Blanks are symbols of the channel as well: in stretches of short fragments with two
single characters in a row (``y o u i d i o t``, ``m o ron``, ``i  d  i  o  t``), a blank or
sign is read as nothing or as the end of a word, as the model finds likelier. Long stretches
are decoded in windows that overlap by half. Words cut in two without a single character
(``id iot``) are left as they stand: to tell them, all short words would have to be decoded.

Scoring: words and word beginnings of restored text, learnt from a bounded sample
of labelled rows. Candidates occur in toxic rows almost only. Those that would
not be so by chance, given how many were looked at, are kept; of the others, a
greedy cover keeps the few that explain toxic rows left unexplained.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dosewright.llm.common import as_texts, held_out, record_batch, short_batches
from dosewright.llm.quality_model import sample
from dosewright.session import stored

#: Labelled rows learnt from, at most.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
#: A candidate stands in so many toxic rows at least, and so purely.
MIN_TOXIC, MIN_PURITY = 4, 0.95
#: Features expected to pass for toxic by chance.
BY_CHANCE = 0.05
#: Letters of the word beginnings that count as features of their own.
BEGINNINGS = (4, 5, 6, 7)
#: Words that a Python worker remembers; the memory is emptied when full.
REMEMBERED = 150_000

# Letters that signs and digits stand for.
LOOK_ALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c",
}
#: Signs put between letters, or in place of one.
FILLERS = ".-_*'~·•"
SUBSTITUTED, FILLED, SHORTENED, DROPPED, WILD = 1.5, 0.5, 0.5, 5.0, 2.0
#: A single blank or sign between fragments that ends a word.
ENDED = 0.5

_EDGE = ".,;:?\"'()[]{}<>#*%&|!~-_"
_LETTERS = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(r"[0-9@$!|+€£(.\-_*'~·•]")
_REPEATED = re.compile(r"([^\W\d_])\1\1")
#: What parts the words of a token: signs that are no look-alikes, and no star in place of a letter.
_PARTS = re.compile(r"[^\w@$!|+€£(*]+|_+")
_LONG_RUN = re.compile(r"(.)\1{3,}")
_AROUND = ".,;:?\"'()[]{}<>"
#: Characters decoded at once; longer stretches go in pieces that overlap by half.
PIECE = 64
#: Fragments of a spelt-out stretch, what stands between them, and two single characters in a row.
_FRAGMENT, _BETWEEN = r"[\w@$!|+]{1,3}", r"[ .\-_*]{1,3}"
_TWO_SINGLES = re.compile(rf"(?<!\S)[\w@$!|+]{_BETWEEN}[\w@$!|+](?![^\s.,;:?!\-_*])")
_ONWARD = re.compile(rf"(?:{_BETWEEN}{_FRAGMENT}(?![^\s.,;:?!\-_*]))*")
_BEFORE = re.compile(rf"(?<!\S){_FRAGMENT}{_BETWEEN}$")
_BLANKS = re.compile(r"([ .\-_*]{1,3})")
#: Fragments decoded at once; longer stretches go in windows that overlap by half.
WINDOW = 48
#: Four or more single characters, one sign or blank between each.
_SPACED = re.compile(r"(?<!\S)(?:[\w@$!|+][ .\-_*]){3,}[\w@$!|+](?![^\s.,;:?!])")

# Character classes of the model: 0 edge, 1-26 letters without marks, 27 other letters.
CLASSES = 28


def _class(c: str) -> int:
    base = unicodedata.normalize("NFD", c.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 if c.isalpha() else 0


_TABLE = np.array([_class(chr(i)) for i in range(0x250)] + [27], dtype=np.int64)
_TRIGRAM = pa.schema([("code", pa.int32()), ("n", pa.int64())])


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")
    return _TABLE[np.minimum(points, 0x250)]


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, n) over all documents; at most 28 ** 3 rows."""

    def run(batches):
        total = np.zeros(CLASSES**3, dtype=np.int64)
        for batch in batches:
            for text in as_texts(batch.column("text")):
                c = np.concatenate([[0, 0], classes(text), [0]])
                total += np.bincount(c[:-2] * CLASSES * CLASSES + c[1:-1] * CLASSES + c[2:], minlength=CLASSES**3)
        found = np.flatnonzero(total)
        yield record_batch(_TRIGRAM, found.astype(np.int32), total[found])

    counted = docs.select("text").mapInArrow(run, "code int, n long")
    return counted.groupBy("code").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """ln P(third | first two), smoothed."""
    n = np.zeros(CLASSES**3)
    for code, count in counts.collect():  # at most 28 ** 3 rows
        n[code] = count
    n = n.reshape(CLASSES, CLASSES, CLASSES)
    pairs = n.sum(axis=0)
    backed = (pairs + 0.5) / (pairs + 0.5).sum(axis=1, keepdims=True)
    return np.log((n + 5.0 * backed[None]) / (n.sum(axis=2, keepdims=True) + 5.0))


def has_traces(written: str) -> bool:
    """Whether letters come with a look-alike or a filler, at whatever place, or a letter is repeated."""
    return bool(_LETTERS.search(written) and (_SIGN.search(written) or _REPEATED.search(written)))


def pieces(token: str) -> list[str]:
    """What is decoded of a token: the whole, its parts between signs, and overlapping pieces where it is long."""
    whole = _LONG_RUN.sub(r"\1\1\1", token.strip(_AROUND))  # more than three say no more than three
    if not has_traces(whole):
        return []
    parts = [p for p in _PARTS.split(whole) if p]
    found = dict.fromkeys(p for p in (whole, *parts) if len(p) <= PIECE)
    if len(whole) > PIECE:
        for part in parts:
            if len(part) > PIECE:
                found.update(dict.fromkeys(part[at : at + PIECE] for at in range(0, len(part) - PIECE // 2, PIECE // 2)))
        # words spelt with signs between: runs of single characters, then stretches from part to part
        spelt: list[str] = []
        for part in (*parts, ""):
            if len(part) == 1:
                spelt.append(part)
                continue
            text = "-".join(spelt)
            if len(spelt) > 1:
                found.update(dict.fromkeys(text[at : at + PIECE] for at in range(0, max(1, len(text) - PIECE // 2), PIECE // 2)))
            spelt = []
        for first, part in enumerate(parts):
            stretch = part
            for further in parts[first + 1 :]:
                stretch += "-" + further
                if len(stretch) > PIECE // 2:
                    break
                found[stretch] = None
    return list(found)


class Restorer:
    """Restores words under a character model given as nested lists."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        """Readings (letters, cost) of each stretch of a lower-cased word."""
        out: list[list[tuple[str, float]]] = []
        for run in re.finditer(r"(.)\1*", word):
            c, n = run[1], len(run[0])
            if c in LOOK_ALIKE:
                single = [(x, SUBSTITUTED) for x in LOOK_ALIKE[c]]
                if not c.isalnum():
                    single.append(("", DROPPED))
                out += [single] * min(n, 2)
            elif c in FILLERS or not c.isalnum():
                if c == "*" and n <= 2:  # rather a letter left out than a sign put between
                    out += [[("", DROPPED), *((chr(97 + i), WILD) for i in range(26))]] * n
                else:
                    out.append([("", FILLED)])
            elif n >= 3:
                out.append([(c, SHORTENED), (c * 2, SHORTENED)])
            else:
                out += [[(c, 0.0)]] * n
        return out

    def decode(self, word: str) -> str:
        """The cheapest reading; letters only."""
        return self.cheapest(self.lattice(word))

    def cheapest(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The cheapest path by costs of the channel and of the model, by Viterbi's recursion."""
        model = self.model
        beams: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for readings in lattice:
            following: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (cost, read) in beams.items():
                for letters, price in readings:
                    x, y, total = a, b, cost + price
                    for letter in letters:
                        z = _class(letter)
                        total -= model[x][y][z]
                        x, y = y, z
                    known = following.get((x, y))
                    if known is None or total < known[0]:
                        following[x, y] = (total, read + letters)
            beams = following
        return min(((cost - model[a][b][0], read) for (a, b), (cost, read) in beams.items()), default=(0, ""))[1]

    def words(self, token: str) -> tuple[str, ...]:
        """Restored words of a lower-cased stretch without white space.

        A ``!`` at the end is read both as a mark and as a letter.
        """
        plain = _LETTERS.findall(token.strip(_EDGE))
        decoded = dict.fromkeys(plain)
        for piece in pieces(token):
            for written in {piece, piece.rstrip("!")}:
                if has_traces(written):
                    decoded[self.decode(written)] = None
        return tuple(decoded)

    def spaced(self, text: str) -> list[str]:
        """Restored words of spelt-out stretches (``i d i o t``) of a lower-cased text, word ends found and not."""
        out: dict[str, None] = {}
        for stretch in spelt_stretches(text):
            out.update(dict.fromkeys(self.decode(re.sub(r"[ .\-_*]", "", m)) for m in _SPACED.findall(stretch)))
            written = _BLANKS.split(stretch)  # fragments, and what stands between, in turn
            for at in range(0, max(1, len(written) - WINDOW), WINDOW):
                lattice: list[list[tuple[str, float]]] = []
                for number, part in enumerate(written[at : at + 2 * WINDOW - 1]):
                    if number % 2:
                        lattice.append([("", FILLED * len(part)), (" ", ENDED if len(part) == 1 else 0.0)])
                    else:
                        lattice += self.lattice(part)
                out.update(dict.fromkeys(self.cheapest(lattice).split()))
        return list(out)


def spelt_stretches(text: str):
    """Stretches of fragments of one to three characters around two single ones in a row."""
    done = 0
    while found := _TWO_SINGLES.search(text, done):
        begin, end = found.start(), _ONWARD.match(text, found.end()).end()
        for _ in range(2):  # a word may begin with fragments of more than one letter
            before = _BEFORE.search(text, max(done, begin - 6), begin)
            if before is None:
                break
            begin = before.start()
        yield text[begin:end]
        done = end


def features_of(word: str) -> tuple[str, ...]:
    """A word, and its beginnings marked with a hyphen."""
    return (word, *(word[:n] + "-" for n in BEGINNINGS if n < len(word)))


class Words:
    """Different restored words of a text, by remembered tokens."""

    def __init__(self, model: np.ndarray):
        self.restorer = Restorer(model)
        self.known: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str) -> set[str]:
        text = text.lower()
        known, out = self.known, set()
        for token in set(text.split()):
            words = known.get(token)
            if words is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                words = self.restorer.words(token)
                if len(token) <= 64:
                    known[token] = words
            out.update(words)
        out.update(self.restorer.spaced(text))
        return out


_COUNT = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("rows", pa.int64())])


def _counted(model):
    """Rows and toxic rows of each feature, summed up within a task as far as memory is given."""

    def flush(toxic, rows):
        return record_batch(_COUNT, list(rows), [toxic[f] for f in rows], list(rows.values()))

    def run(batches):
        words = Words(model)
        toxic: Counter = Counter()
        rows: Counter = Counter()
        for batch in batches:
            for text, label in zip(as_texts(batch.column("text")), batch.column("toxic").to_pylist()):
                found = {f for w in words(text) for f in features_of(w)}
                rows.update(found)
                if label:
                    toxic.update(found)
                if len(rows) > REMEMBERED:
                    yield flush(toxic, rows)
                    toxic.clear()
                    rows.clear()
        if rows:
            yield flush(toxic, rows)

    return run


_HELD = pa.schema([("row", pa.int64()), ("feature", pa.string())])


_KEYED = pa.schema([("row", pa.int64()), ("toxic", pa.int32()), ("text", pa.string())])
RUN = 5


def _keyed(batches):
    """Rows with the smallest hash of their runs of five words."""
    for batch in batches:
        keys = []
        for text in as_texts(batch.column("text")):
            words = text.encode("utf-8", "replace").split()
            runs = (b" ".join(words[i : i + RUN]) for i in range(max(1, len(words) - RUN + 1)))
            keys.append(min(map(xxhash.xxh64_intdigest, runs)) - (1 << 63))
        yield record_batch(_KEYED, keys, batch.column("toxic").cast(pa.int32()), batch.column("text"))


def without_shadows(candidates: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
    """Candidates without the beginnings that are toxic only through one whole word.

    What a beginning holds besides its words that are candidates must be as pure
    as a candidate. Rows with several of the words are taken off several times,
    which leaves less than there is; nothing left says nothing.
    """
    toxic: Counter = Counter()
    rows: Counter = Counter()
    for feature, (t, r) in candidates.items():
        if not feature.endswith("-"):
            for beginning in features_of(feature)[1:]:
                toxic[beginning] += t
                rows[beginning] += r
    return {
        f: (t, r)
        for f, (t, r) in candidates.items()
        if not f.endswith("-") or r <= rows[f] or t - toxic[f] >= MIN_PURITY * (r - rows[f])
    }


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, limit: int = SAMPLE_ROWS) -> tuple[dict[str, float], float]:
    """(purity by feature, share of toxic rows) from labelled rows that are not held out.

    Rows with a null label are passed over; of labels of a row that differ, the
    toxic one holds. Copies and near copies of one label, told by the smallest
    hash of their word runs, count once: a word is no more toxic for being copied.
    """
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    drawn = sample(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), limit)
    rows = stored(
        docs.select("doc_id", "text").join(drawn, "doc_id")
        .mapInArrow(_keyed, "row long, toxic int, text string")
        .groupBy("row", "toxic").agg(F.min("text").alias("text"))
        .select(F.xxhash64("row", "toxic").alias("row"), "toxic", "text"),
        "labelled",
    )
    n, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n or not toxic:
        return {}, (toxic + 1) / (n + 2) if n else 0.5
    counts = stored(
        rows.mapInArrow(_counted(model), "feature string, toxic long, rows long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows")),
        "features",
    )
    candidates = {
        r[0]: (r[1], r[2])
        for r in counts.where((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_PURITY * F.col("rows"))).collect()
    }  # words of a bounded sample
    candidates = without_shadows(candidates)
    seen = counts.where("rows >= 2").groupBy("rows").count().orderBy("rows").collect()
    share = toxic / n
    significant = {f for f, (t, r) in candidates.items() if surprise(t, r, share) >= math.log(tried(seen, r) / BY_CHANCE)}

    def incidence(batches):
        words = Words(model)
        for batch in batches:
            pairs = [
                (row, f)
                for row, text in zip(batch.column("row").to_pylist(), as_texts(batch.column("text")))
                for f in {f for w in words(text) for f in features_of(w)} & candidates.keys()
            ]
            if pairs:
                yield record_batch(_HELD, *zip(*pairs))

    held = rows.where("toxic = 1").select("row", "text").mapInArrow(incidence, "row long, feature string").collect()
    return cover(held, candidates, significant), share


def surprise(toxic: int, rows: int, share: float) -> float:
    """Bound on -ln of the chance that so many of ``rows`` are toxic."""
    p = toxic / rows
    return rows * (p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0))


def tried(seen, rows: int) -> int:
    """Features that stand in so many rows or more, from (rows, features)."""
    return max(1, sum(n for r, n in seen if r >= rows))


def cover(held, candidates: dict[str, tuple[int, int]], significant: set[str]) -> dict[str, float]:
    """Purity of the significant features, and of those that cover further toxic rows, best first."""
    rows_of: dict[str, set] = defaultdict(set)
    for row, feature in held:
        rows_of[feature].add(row)
    chosen = {f: (candidates[f][0] + 0.5) / (candidates[f][1] + 1.0) for f in significant}
    explained = {row for row, feature in held if feature in significant}
    rows_of = {f: rest for f, r in rows_of.items() if (rest := r - explained)}
    while rows_of:
        feature = max(rows_of, key=lambda f: (len(rows_of[f]), -candidates[f][1], f))
        explained = rows_of[feature]
        if len(explained) < MIN_TOXIC:
            break
        toxic, rows = candidates[feature]
        chosen[feature] = (toxic + 0.5) / (rows + 1.0)
        rows_of = {f: rest for f, r in rows_of.items() if (rest := r - explained)}
    return chosen


_SCORE = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("found", pa.list_(pa.string()))])


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``found`` for each row of ``docs``.

    ``labels`` has ``doc_id`` and ``toxic``. The score is the chance that at least
    one feature found is rightly toxic; without any it is a tenth of the share of
    toxic rows, also for null and empty texts. ``found`` lists the features.
    Repeated rows are scored alike. Without usable labels no feature is known.
    """
    short_batches(docs)
    model = language_model(trigram_counts(docs))
    lexicon, prior = learn(docs, labels, model, limit)

    def run(batches):
        words, weights = Words(model), {}
        for batch in batches:
            scores, hits = [], []
            for text in as_texts(batch.column("text")):
                found = set()
                for w in words(text):
                    h = weights.get(w)
                    if h is None:
                        if len(weights) >= REMEMBERED:
                            weights.clear()
                        h = weights[w] = tuple(f for f in features_of(w) if f in lexicon)
                    found.update(h)
                clean = math.prod(1.0 - lexicon[f] for f in found)
                scores.append(1.0 - clean if found else prior / 10)
                hits.append(sorted(found))
            yield record_batch(_SCORE, batch.column("doc_id"), scores, hits)

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, found array<string>")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        "found",
    )
