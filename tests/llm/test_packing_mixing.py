"""Packing and mixing against plain versions and their own promises."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dosewright.llm import mixing, packing

public_tokenizers = pytest.importorskip("public_tokenizers")
TEXTS = [
    "Plain words, and more words!", None, "", "   ", "Naïve ÉCOLE straße İstanbul ΣΑΣ Σ x́ ﬁ ½ ²³ ٣",
    "it's we'll I'D don't 12.5% C++ <|endoftext|> a<|startoftext|>b <| |>", "tab\tand\x1cother\x85spaces here\xa0x",
    "word " * 5000, "#*$%&|<> --- ...", "日本語 текст עברית 🙂🙂", "été café",
]


def test_tokens_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    whole, words = Tokenizer.from_file(path), packing.WordTokenizer(path)
    for text in TEXTS:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        for _ in range(2):  # the second time from memory
            assert np.frombuffer(words(text or ""), dtype="<u4").tolist() == ids, text


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packed_documents(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x", 1), (None, "no id", "x", 1)],
        "doc_id long, text string, length string, offset long",
    )
    rows = packing.packed_documents(docs).collect()
    check_packing(rows, 2048)
    wanted = Counter()
    for i, t in [*enumerate(TEXTS), (0, TEXTS[0]), (None, "no id")]:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], dtype="<u4")
            wanted[i, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in rows) == wanted
    assert packing.packed_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once(seed):
    draw = random.Random(seed)
    capacity = draw.choice([10, 64, 2048])
    histogram = Counter(min(capacity, max(1, int(draw.lognormvariate(math.log(capacity / 4), 1)))) for _ in range(3000))
    plan = packing.Plan(dict(histogram), capacity)
    placed, fill = Counter(), Counter()
    for length, first, n, bin0, each, offset in plan.rows:
        assert first == placed[length]
        placed[length] += n
        for k in range(n):
            fill[bin0 + k // each] += length
    assert placed == histogram and max(fill.values()) <= capacity and len(fill) == plan.bins
    total = sum(k * n for k, n in histogram.items())
    assert plan.bins <= max(-(-total // capacity) * 1.03 + 1, sum(n for k, n in histogram.items() if 2 * k > capacity) * 1.03 + 1)


def test_reduction_is_optimal_where_it_decides():
    # 7 + 3 fit exactly, 6 has no partner but 3 or 2, 8 goes with 2: three pairs and the rest
    plan = packing.Plan({7: 2, 3: 2, 8: 1, 2: 1, 6: 1}, 10)
    assert plan.bins == 4 and plan.fixed == 4


def best(sizes, capacity):
    """Least bins, by search."""
    sizes = sorted(sizes, reverse=True)
    result = [len(sizes)]

    def go(i, bins):
        if len(bins) >= result[0]:
            return
        if i == len(sizes):
            result[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                bins[k] += sizes[i]
                go(i + 1, bins)
                bins[k] -= sizes[i]
        go(i + 1, [*bins, sizes[i]])

    go(0, [])
    return result[0]


@pytest.mark.parametrize("seed", range(30))
def test_sets_fixed_by_dominance_lose_nothing(seed):
    draw = random.Random(seed)
    sizes = [draw.randint(3, 19) for _ in range(9)]
    plan = packing.Plan(dict(Counter(sizes)), 20)
    rest = Counter(sizes)
    fixed_bins = plan.fixed
    for length, _, n, bin0, each, _ in plan.rows:
        if bin0 + (n - 1) // each < fixed_bins:
            rest[length] -= n
    assert fixed_bins + best(list(rest.elements()), 20) == best(sizes, 20)


@pytest.fixture(scope="module")
def mixed_docs(spark):
    draw = random.Random(3)
    rows = []
    for i in range(900):
        source = "big" if i % 3 else draw.choice(["a", "b", "c", None])
        rows.append((i, "w " * draw.randint(0, 40), source, "clash", 1))
    rows += [(10_000 + i, "", "empty", "clash", 1) for i in range(5)] + [(1, "twice the row", "big", "clash", 1)] * 2
    rows.append((None, "no id here", "a", "clash", 1))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, weight string, n long").repartition(5)


@pytest.mark.parametrize("target", [{}, {"entropy_share": 1.0, "max_epochs": 3.0}, {"budget": 5000}, {"entropy_share": 0.0}])
def test_mix_keeps_to_its_budget(mixed_docs, target):
    rows = mixing.mix(mixed_docs, **target).collect()
    tokens = Counter()
    for r in mixed_docs.collect():
        tokens[r.source] += len(r.text.split())
    total = sum(tokens.values())
    sources = [s for s in tokens if tokens[s]]
    held = Counter()
    for r in rows:
        held[r.source] += r.tokens
    weights = {r.source: r.weight for r in rows}
    assert abs(sum(weights[s] for s in sources if s in weights) - 1) < 1e-4
    a, budget = mixing.exponent(
        mixed_docs.groupBy("source").agg(F.sum(mixing.token_count(F.col("text"))).alias("tokens")), **target
    )
    z = sum(tokens[s] ** a for s in sources)
    for s in sources:
        wanted = budget * tokens[s] ** a / z
        assert wanted - 45 <= held[s] <= wanted + 1, s  # short of the budget by less than the document that is cut off
        epochs = wanted / tokens[s]
        if "budget" not in target:
            assert 1 - 1e-6 <= epochs <= target.get("max_epochs", mixing.MAX_EPOCHS) + 1e-3
    if "budget" not in target:
        assert {r.doc_id for r in rows} == {r.doc_id for r in mixed_docs.collect()}
    share = {s: tokens[s] ** a / z for s in sources}
    entropy = -sum(p * math.log(p) for p in share.values())
    natural = -sum(tokens[s] / total * math.log(tokens[s] / total) for s in sources)
    assert entropy >= natural - 1e-9
    if not target:
        lower = {s: tokens[s] ** (a + 2 / mixing.GRID) for s in sources}
        x = sum(lower.values())
        assert entropy >= 0.95 * math.log(len(sources)) - 1e-6 or a < 1
        if a < 1:
            assert -sum(p / x * math.log(p / x) for p in lower.values()) < 0.95 * math.log(len(sources)) + 1e-6


def test_blocks_are_beginnings_of_permutations(mixed_docs):
    rows = mixing.mix(mixed_docs, budget=3000).collect()
    by_source = defaultdict(lambda: defaultdict(set))
    for r in rows:
        by_source[r.source][r.epoch].add(r.doc_id)
    for blocks in by_source.values():
        whole = blocks[1]
        for epoch in sorted(blocks):
            assert blocks[epoch] <= whole
            whole = blocks[epoch]


def test_mixed_documents_keep_their_columns(mixed_docs, spark):
    out = mixing.mixed_documents(mixed_docs, max_epochs=2.0)
    assert out.columns == mixed_docs.columns
    times = Counter(tuple(r) for r in out.collect())
    assert set(times) == {tuple(r) for r in mixed_docs.collect()}
    assert mixing.mix(mixed_docs.limit(0)).count() == 0
    assert mixing.mixed_documents(mixed_docs.limit(0)).count() == 0


def test_no_python_on_the_way(mixed_docs):
    plan = mixing.mix(mixed_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_tokenizers_of_another_kind_are_given_whole_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, own = Tokenizer.from_file(path), packing.WordTokenizer(path)
    assert not own.by_words and packing.word_tokenizer(None).by_words
    for text in ("Two  words, don't\n split", "", " lead", "naïve 123 ſ ǅ <|endoftext|>"):
        ids = np.frombuffer(own(text), dtype="<u4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids


def test_words_are_learnt_in_bulk_and_pieces_once(monkeypatch):
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    whole, words = Tokenizer.from_file(path), packing.WordTokenizer(path)
    asked, made = [], words.pieces.make
    words.pieces.make = lambda parts: asked.append(list(parts)) or made(parts)
    list(words.each(pa.array(["Lemonade lemonade, LEMONADE!", "lemonade? (Lemonade)", None])))
    assert len(asked) == 1 and asked[0].count("lemonade") == 1  # one call for all texts, one piece for all spellings

    draw = random.Random(5)
    spaces = [" ", "\n", "\t\t", "\x0b", "\x0c", "\r\n", "\x1c", "\x85", "\xa0", " ", "　"]
    signs = ["ab", "É", "ß", "İ", "ŉ", "'s", "'", "12", "½", "²", "<|", "<|endoftext|>", "\xad", "x́", "Σ", "日本", "🙂", "\x00", "\xb5", "..", "ª"]
    texts = [
        "".join("".join(draw.choices(signs, k=draw.randint(0, 4))) + draw.choice(spaces) for _ in range(draw.randint(0, 80)))
        for _ in range(120)
    ] + [None, "", "\n", "long " * 900]
    wanted = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    for at_once, limit in ((1, 1), (300, 7), (4_000_000, 200_000)):
        monkeypatch.setattr(packing, "AT_ONCE", at_once)
        monkeypatch.setattr(packing, "WORDS_AT_ONCE", limit)
        monkeypatch.setattr(packing, "REMEMBERED", limit)
        tokenizer = packing.WordTokenizer(path)
        for kind in (pa.string(), pa.large_string()):
            column = pa.array([None, *texts], kind).slice(1)
            assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in tokenizer.each(column)] == wanted
        if limit == 7:
            assert len(tokenizer.words.younger) <= limit and len(tokenizer.words.older) <= limit
