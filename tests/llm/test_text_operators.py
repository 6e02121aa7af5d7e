"""Text operators against plain versions, and their defined odd cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from dosewright.llm import line_dedup, quality_rules, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, n_lines long, component_id string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [
    "a shared line of some length\nown line number one\nshort\nshort",
    "\t A Shared Line of some length \n\nown line number two\nAnother shared line",
    "another SHARED line\nanother shared line\nÄnother shared line",
    None,
    "",
    " \n \x0b\n",
    "one two three four five six seven eight nine ten eleven twelve",
    "one two three four five six seven eight nine ten eleven twelve",
    "one two three four five six seven eight nine ten eleven thirteen",
    LONG,
    LONG + " tail",
    "x y " * 40,
    "éé éé éé éé éé éé éé éé éé\nüüüüüüüüü\nüüüüüüüüüü",
    "ok*** fine*** good*** well*** yes*** no*** may*** be*** not*** so***",
    "üüüüüüüüüü\nüüüüüüüüü",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", 5, "clash") for i, t in enumerate(TEXTS)]
    rows.append((1, TEXTS[1], "en", 5, "clash"))  # a repeated row
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain_rules(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i : i + 5])].append(i)
    repeat = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(repeat) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed


def test_quality_rules_against_plain_version(docs):
    rows = quality_rules.quality_rules(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert tuple(r)[1:7] == plain_rules(TEXTS[r.doc_id]), r
        assert not (r.base_failed and r.kept)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9].kept and not by_id[13].kept and by_id[13].reason == "symbols"
    assert quality_rules.quality_rules_kept(docs).columns == docs.columns
    assert {r.doc_id for r in quality_rules.quality_rules_kept(docs).collect()} == {r.doc_id for r in rows if r.kept}


def test_runs_of_equal_hash_are_compared():
    import numpy as np

    ids = np.array([1, 2, 3, 1, 2, 4])
    assert list(quality_rules._repeated(ids, np.zeros(5, dtype=np.uint64), 2)) == [0, 3]


def plain_line_dedup(texts):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )
    holders = defaultdict(set)
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = {}
    for i, t in texts.items():
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 2 or min(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize("bits", [16, 0])  # with filters full from the start all lines are suspects
def test_line_dedup_against_plain_version(docs, monkeypatch, bits):
    monkeypatch.setattr(line_dedup, "BITS_FOR_KEY", bits)
    wanted = plain_line_dedup(dict(enumerate(TEXTS)))
    cut = line_dedup.line_dedup(docs)
    assert cut.columns == ["doc_id", "text", "lang", "component_id", "n_lines", "n_dropped"]
    rows = cut.collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert (r.n_lines, r.n_dropped, hashlib.sha256((r.text or "").encode()).hexdigest()) == wanted[r.doc_id]
    assert {r.doc_id: r.text for r in rows}[3] is None


@pytest.mark.parametrize("task_keys", [64, 128, 256, 512])
def test_nearly_full_filters_lose_no_repeat(monkeypatch, task_keys):
    """Several batches of one task: every document that shares a line is a suspect of it."""
    import pyarrow as pa

    monkeypatch.setattr(line_dedup, "TASK_KEYS", task_keys)
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
    lines = [f"line number {i} of many" for i in range(2000)]
    held = [[lines[(i * 7 + j * 131) % len(lines)] for j in range(8)] for i in range(300)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(i, i + 20)), pa.array(["\n".join(x) for x in held[i : i + 20]])], schema=schema)
        for i in range(0, 300, 20)
    ]
    found = {
        (h1, h2, doc_id)
        for batch in line_dedup._tested(line_dedup._sightings(1)(batches))
        for h1, h2, doc_id in zip(*(c.to_pylist() for c in batch.columns))
    }
    holders = defaultdict(set)
    for i, held_lines in enumerate(held):
        for line in held_lines:
            holders[line].add(i)
    for line, ids in holders.items():
        key = line_dedup.digest(line.encode())
        halves = [int.from_bytes(key[at : at + 8], "little", signed=True) for at in (0, 8)]
        assert len(ids) < 2 or all((*halves, i) in found for i in ids), line


def test_line_dedup_of_a_line_that_all_have(spark):
    docs = spark.range(0, 3000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("the line that all have\nown line "), F.col("id")).alias("text")
    )
    rows = line_dedup.line_dedup(docs.repartition(16)).collect()
    assert sorted(r.n_dropped for r in rows) == [0] + [1] * 2999
    assert {r.doc_id: r.n_dropped for r in rows}[0] == 0


def test_no_document_id(spark):
    docs = spark.createDataFrame([(None, "a line that is shared"), (None, "a line that is shared"), (4, "a line that is shared")], "doc_id long, text string")
    assert [r.n_dropped for r in line_dedup.line_dedup(docs).collect()] == [0, 0, 0]
    groups = simhash.simhash_groups(docs).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in groups} == {(None, 4, False), (4, 4, True)}


def plain_fingerprint(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    root = {i: i for i in values}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(values, 2):
        if (values[a] ^ values[b]).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: find(i) for i in values}


def test_simhash_against_plain_version(docs):
    prints = {i: plain_fingerprint(t) for i, t in enumerate(TEXTS)}
    wanted = plain_components(prints)
    rows = simhash.simhash_groups(docs).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == wanted[r.doc_id]
        assert r.kept == (wanted[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("pairwise", [512, 2])
def test_links_of_random_fingerprints(spark, pairwise):
    import random

    draw = random.Random(5)
    values = {}
    for i in range(40):
        base = draw.getrandbits(64)
        for j in range(12):
            values[i * 12 + j] = base
            for _ in range(draw.randrange(3)):
                base ^= 1 << draw.randrange(64)
    first = {}
    for i, v in values.items():
        first.setdefault(v, i)
    nodes = {i: v for v, i in first.items()}
    frame = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in nodes.items()], "node long, fp long")
    found = {r.node: r.component for r in simhash.components(simhash.links(frame, pairwise)).collect()}
    assert {i: found.get(i, i) for i in nodes} == plain_components(nodes)


def test_links_of_one_crowded_posting(spark):
    """Fingerprints that share four bytes, more than are compared in pairs, over several Arrow batches."""
    import random

    draw = random.Random(11)
    values = sorted({0x1234567800000000 | draw.getrandbits(14) << 3 * draw.randrange(6) for _ in range(3000)})
    nodes = dict(enumerate(values))
    masks = {}
    root = list(nodes)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, v in nodes.items():  # all values within two bits, looked up
        for x, y in combinations(range(32), 2):
            for near in (v ^ (1 << x), v ^ (1 << x) ^ (1 << y)):
                if (j := masks.get(near)) is not None:
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
        masks[v] = i
        if (j := masks.get(v ^ (1 << 31))) is not None:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    frame = spark.createDataFrame(list(nodes.items()), "node long, fp long")
    for pairwise in (simhash.PAIRWISE, 4096):
        found = {r.node: r.component for r in simhash.components(simhash.links(frame, pairwise), contracted=True).collect()}
        assert {i: found.get(i, i) for i in nodes} == {i: find(i) for i in nodes}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules.quality_rules(none).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    assert simhash.simhash_groups(none).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7), (None, 3), (2000, 1999)]
    found = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, **{i: 1000 for i in range(1001, 1400)}, 2000: 1999}
