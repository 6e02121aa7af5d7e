"""Prefix trie, ranked search and substring dedup against plain versions, and their defined odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dosewright.llm import prefix_trie, ranked_search, suffix_dedup

NO_EXTRA = "rank int, component string, n long"


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


# Prefix trie


def plain_trie(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            talks[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {conv: [said for *_, said in sorted(turns)] for conv, turns in talks.items()}
    whole = {}
    for conv, turns in own.items():
        heads = zlib.crc32(str(conv).encode()) % 6
        whole[conv] = tuple(own.get(conv - conv % 100, [])[:heads] + turns[heads:])
    nodes, below = defaultdict(list), defaultdict(list)
    for conv, turns in whole.items():
        for depth in range(len(turns) + 1):
            nodes[turns[:depth]].append(conv)
    for prefix in nodes:
        if prefix:
            below[prefix[:-1]].append(prefix)
    leaves, saved, out = {}, {}, []
    for prefix in sorted(nodes, key=len, reverse=True):
        inside = below[prefix]
        leaves[prefix] = sum(leaves[x] for x in inside) if inside else 1
        last = len(prefix[-1][1]) if prefix else 0
        saved[prefix] = (len(nodes[prefix]) - 1) * last + sum(saved[x] for x in inside)
        ends = ",".join(str(c) for c in sorted(c for c in nodes[prefix] if len(whole[c]) == len(prefix)))
        above = min(nodes[prefix[:-1]]) if prefix else None
        members = nodes[prefix]
        out.append(
            (min(members), len(prefix), above, len(members), len(inside), leaves[prefix], saved[prefix],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return out


TALKS = "conv_id long, turn long, role string, text string"


def trie_rows():
    draw = random.Random(7)
    rows = [
        (conv, turn if draw.random() < 0.8 else draw.choice([None, 2, 3]), draw.choice(["user", "assistant", None]), draw.choice(["x", "yy", None, "é", ""]))
        for conv in (0, 1, 2, 3, 5, 7, 100, 101, 105, 199, 250, -150, -100)
        for turn in range(draw.randrange(0, 9))
    ]
    rows += [(1, turn, "user", draw.choice("ab")) for turn in range(1500)]  # one holds most rows
    rows += [(2, turn, "user", "a") for turn in range(700)]
    return rows + [(None, 1, "user", "lost")] + [(3, 4, "user", "again")] * 300


def test_trie_equals_plain(spark):
    rows = trie_rows()
    rows = [r for r in rows if r[0] is None or r[0] >= 0]
    talks = spark.createDataFrame(rows, TALKS).withColumns({"depth": F.lit("x"), "part": F.lit(1)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = prefix_trie.prefix_trie(talks.repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert in_order(got) == in_order(plain_trie(rows))


def test_trie_of_negative_ids_and_nothing(spark):
    # The hundred of -150 is -100: towards zero.
    rows = [(-150, t, "user", f"own {t}") for t in range(8)] + [(-100, t, "user", f"head {t}") for t in range(8)]
    got = {(r.conv_id, r.depth): r for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, TALKS)).collect()}
    heads = zlib.crc32(b"-150") % 6
    assert got[(-150, 0)].n_convs == 2
    assert all(got[(-150, d)].n_convs == (2 if d <= heads else 1) for d in range(9))
    empty = prefix_trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], TALKS))
    assert empty.collect() == [] and empty.columns[0] == "conv_id"


def test_conversation_left_without_turns(spark):
    conv = next(c for c in range(201, 299) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = prefix_trie.prefix_trie(spark.createDataFrame([(conv, 1, "user", "x")], TALKS)).collect()
    assert [tuple(r) for r in rows] == [(conv, 0, None, 1, 0, 1, 0, hashlib.sha256(str(conv).encode()).hexdigest())]


def test_queue_spills_and_keeps_order():
    draw = random.Random(1)
    queue, plain = prefix_trie.ForwardQueue(limit=7), []
    for _ in range(500):
        message = (-draw.randrange(5), draw.randrange(4), 0, 1, draw.randrange(9), 1)
        queue.push(message)
        plain.append(message)
    assert len(queue.heap) <= 7 and queue.runs
    sums = defaultdict(lambda: [0, 0, 0])
    for *key, a, b, c in plain:
        for i, x in enumerate((a, b, c)):
            sums[tuple(key)][i] += x
    assert list(queue.pop_through(None)) == [(k, *v) for k, v in sorted(sums.items())]


def test_ends_are_hashed_in_blocks(spark, monkeypatch):
    rows = [(conv, 9, "user", "same") for conv in range(100, 400)]
    monkeypatch.setattr(prefix_trie, "BLOCK_IDS", 7)
    assert in_order(prefix_trie.prefix_trie(spark.createDataFrame(rows, TALKS)).collect()) == in_order(plain_trie(rows))


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    counted = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs if plain_terms(text)]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    holding = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, counts in counted:
            m = 75 + 25 * sum(counts.values()) * n_docs // length
            score = 0
            for term in plain_terms(text):
                if term in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += w * (1000000000 * counts[term] // (1000 * counts[term] + 12 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return out


def search_tables(spark):
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "ÜNDER", "x-y", "the", "The", "42"]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda n: " ".join(draw.choices(words, weights, k=n))
    docs = [(i, text(draw.randrange(0, 80))) for i in range(400)]
    docs += [(i, "the same words again") for i in range(400, 460)]  # ties beyond the k-th
    docs += [(None, "the same words again"), (None, None), (460, ""), (461, "... !"), (3, docs[3][1]), (462, text(20_000))]
    items = [(i, text(12)) for i in range(20)] + [(20, "the same words again"), (21, None), (22, "?"), (23, "unheard"), (5, "again same"), (24, "w1 " * 40)]
    return docs, items


def test_search_equals_plain(spark, monkeypatch):
    docs, items = search_tables(spark)
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], "doc_id long, text string, " + NO_EXTRA).repartition(3)
    q = spark.createDataFrame([(*r, 1, "x", 2) for r in items], "item_id long, text string, " + NO_EXTRA)
    for postings, depth, block in ((1_500_000, 16, 2000), (500, 1, 7)):
        monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
        monkeypatch.setattr(ranked_search, "FIRST_DEPTH", depth)
        monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", block)
        got = in_order(ranked_search.search(d, q).collect())
        assert got == in_order(plain_search(docs, items, 20))


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search.search(none, items).collect() == []
    assert ranked_search.search(docs, items.limit(0)).collect() == []
    assert ranked_search.search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_best_positions_end_reading_early():
    n = 5000
    impact = np.arange(n, 0, -1)
    shard = ranked_search.Shard(np.tile(np.arange(n), 2), np.repeat([0, 1], n), np.tile(impact, 2), n)
    docs, scores = shard.best(0, np.array([0, 1]), np.array([1, 1]), 3, 0)
    assert sorted(docs[scores >= 2 * (n - 2)].tolist()) == [0, 1, 2]
    assert (shard._met == 0).sum() < 100


# Substrings


def plain_repeats(rows):
    least = {}
    texts = [(suffix_dedup.LAST_ID if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, text in texts:
        for at in range(len(text) - 99):
            string = text[at : at + 100]
            least[string] = min(key, least.get(string, key))
    out = []
    for key, doc_id, text in texts:
        seen, gone = set(), bytearray(len(text))
        for at in range(len(text) - 99):
            string = text[at : at + 100]
            if least[string] < key or string in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(string)
        spans = len(re.findall(b"\1+", gone))
        kept = bytes(c for c, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, kept))
    return out


def repeat_rows():
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 8)))
    base, passage = " ".join(word() for _ in range(400)), " ".join(word() for _ in range(40))[:130]
    rows = [
        (i, " ".join(word() for _ in range(draw.randrange(60))) + (passage if i % 2 else "") + " ".join(word() for _ in range(60)))
        for i in range(60)
    ]
    return rows + [
        (100, base), (101, base), (102, base[:900] + "X" + base[900:]), (103, base + base), (None, base[50:]),
        (None, base[300:]), (104, None), (105, ""), (106, "a" * 500), (107, "a" * 99), (50, base), (50, base[10:700]),
        (100, base), (108, "ab" * 300 + "a" * 250), (108, "ab" * 300 + "a" * 250), (109, "a" * 100),
    ]


@pytest.mark.parametrize("most, block", [(4096, 1 << 18), (4, 128)])
def test_repeats_equal_plain(spark, monkeypatch, most, block):
    rows = repeat_rows()
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", most)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, sub int, gram string, doc long")
    got = suffix_dedup.remove_repeats(docs.repartition(4)).collect()
    assert in_order((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == in_order(plain_repeats(rows))
    for row in got:  # spans are what is gone, and longest runs
        assert sum(s.end - s.start for s in row.spans) == row.n_removed
        assert all(a.end < b.start for a, b in zip(row.spans, row.spans[1:]))


def rare_gram():
    """Bytes of one gram with a hash so small that it is the anchor of every string it is in."""
    draw = np.random.default_rng(7)
    data = draw.integers(97, 123, 200_000, dtype=np.uint8)
    at = np.arange(len(data) - suffix_dedup.GRAM + 1)
    least = int(np.argmin(suffix_dedup._mixed(suffix_dedup.Hashes(data, 0).of(at, at + suffix_dedup.GRAM))))
    return data[least : least + suffix_dedup.GRAM].tobytes().decode()


def around(gram, count):
    """(doc_id, text): texts of 168 bytes that have the gram in their middle; every third has much of another's words."""
    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=68))
    rows = [[word(), word()] for _ in range(count)]
    for i in range(3, count, 3):
        before, after = rows[draw.randrange(i)]
        rows[i] = [word()[:18] + before[18:], after[:50] + word()[50:]]
    return [(i, before + gram + after) for i, (before, after) in enumerate(rows)]


def test_one_gram_takes_more_than_a_block(spark):
    rows = around(rare_gram(), 3300)
    whole = [t for _, t in rows if len(suffix_dedup.segments(np.frombuffer(t.encode(), np.uint8), np.array([len(t)]))[0]) == 1]
    assert suffix_dedup.SORT_BYTES + 4 * suffix_dedup.LENGTH < sum(len(t) for t in whole)
    assert len(rows) < suffix_dedup.MOST_SEGMENTS
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    got = in_order((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got)
    assert got == in_order(plain_repeats(rows))
    assert sum(r[2] > 0 for r in got) >= 1000


def test_hashes_of_any_length():
    data = np.tile(np.arange(250, dtype=np.uint8), 5000)
    hashes = suffix_dedup.Hashes(data, 0)
    start = np.array([0, 250, 250 * 4000])
    assert len(set(hashes.of(start, start + 100).tolist())) == 1
    assert hashes.of(start, start + 99)[0] != hashes.of(start, start + 100)[0]
    assert suffix_dedup.Hashes(data[:400], 0).of(start[:2], start[:2] + 100).tolist() == hashes.of(start[:2], start[:2] + 100).tolist()


@pytest.mark.parametrize("most", [4096, 4])
def test_rows_alike_are_compared_once(spark, monkeypatch, most):
    base = around(rare_gram(), 30)
    rows = [*base, *[base[9]] * 40, *[(None, base[12][1] + "!")] * 40]
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", most)
    sizes = {}

    def counted(df, name, keep=suffix_dedup.stored):
        df = keep(df, name)
        sizes[name] = df.count()
        return df

    monkeypatch.setattr(suffix_dedup, "stored", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.remove_repeats(docs.repartition(8)).collect()
    assert in_order((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == in_order(plain_repeats(rows))
    assert sizes["cut"] <= (len(set(rows)) if most > 4 else 70 * len(set(rows)))


def test_repeats_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_segments_do_not_depend_on_blocks(monkeypatch):
    texts = [t.encode() for _, t in repeat_rows() if t]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])

    def covered():
        text, _, _, start, more, anchor = suffix_dedup.segments(data, ends)
        return {(t, s + i, s + a) for t, s, m, a in zip(*(c.tolist() for c in (text, start, more, anchor))) for i in range(m + 1)}

    whole = covered()
    assert {(t, s) for t, s, _ in whole} == {
        (t, int(ends[t]) - len(x) + i) for t, x in enumerate(texts) for i in range(len(x) - 99)
    }
    monkeypatch.setattr(suffix_dedup, "BLOCK", 77)
    assert covered() == whole


def test_suffix_sort_survives_lying_hashes(monkeypatch):
    draw = np.random.default_rng(2)
    data = np.concatenate([draw.integers(97, 99, 300, dtype=np.uint8), np.full(150, 97, dtype=np.uint8)] * 2)
    suffix = np.arange(len(data) - 99)
    texts = [data[s : s + 100].tobytes() for s in suffix]
    for lie in (False, True):
        sort = suffix_dedup.SuffixSort(data)
        if lie:
            monkeypatch.setattr(sort.hashes, "of", lambda start, end: np.zeros(np.broadcast(start, end).shape))
        order, same = sort.runs(suffix, np.zeros(len(suffix), dtype=np.int64))
        assert order.tolist() == sorted(range(len(suffix)), key=lambda i: (texts[i], i))
        assert same.tolist() == [texts[a] == texts[b] for a, b in zip(order[:-1], order[1:])]
