"""The five stages over a small corpus against a plain version of each."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest

import corpus_pipeline
from dosewright.llm import mixing, near_copies, quality_rules, simhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = []
    for i in range(60):
        body = "\n".join(" ".join(f"word{(i * 37 + j * 11 + k * k) % 501}" for k in range(12)) for j in range(4))
        if i % 4 == 0:
            body = "a line that many documents share\n" + body
        rows.append((i, body, "en", "big" if i % 3 else "small", len(body)))
    rows.append((60, rows[5][1], "en", "big", len(rows[5][1])))
    rows.append((61, rows[7][1] + " one", "en", "small", len(rows[7][1]) + 4))
    rows += [(62, None, "en", "big", 0), (63, "few words", "en", "big", 9), (64, "same again " * 40, "en", None, 400)]
    rows.append((65, " ".join(f"long{i % 7919}x{i % 13}" for i in range(9000)), "en", None, 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet"
    )
    return folder


def test_stages_against_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    docs = stages["quality rules"](spark, docs, folder)
    assert docs.columns == columns
    texts = {i: t for i, t in texts.items() if quality_rules.measure(t or "")[6]}
    assert {r.doc_id: r.text for r in docs.collect()} == texts
    assert not {62, 63, 64} & set(texts) and {60, 61, 65} <= set(texts)

    docs = stages["line dedup"](spark, docs, folder)
    assert docs.columns == columns
    first: dict = {}
    for i in sorted(texts):
        for line in texts[i].split("\n"):
            first.setdefault(line.strip().lower(), i)
    texts = {
        i: "\n".join(x for x in t.split("\n") if len(x.strip()) < 10 or first[x.strip().lower()] == i)
        for i, t in texts.items()
    }
    texts = {i: t for i, t in texts.items() if WORDS.search(t)}
    got = docs.collect()
    assert {r.doc_id: r.text for r in got} == texts and all(r.n_chars == len(r.text) for r in got)
    assert 60 not in texts

    docs = stages["simhash near-dedup"](spark, docs, folder)
    assert docs.columns == columns
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    root = {i: i for i in sorted(sets)}
    changed = True
    while changed:  # components by repeated relabelling
        changed = False
        for a, b in combinations(root, 2):
            low, high = sorted((root[a], root[b]))
            if low < high and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root = {i: low if r == high else r for i, r in root.items()}
                changed = True
    texts = {i: t for i, t in texts.items() if root[i] == i}
    assert {r.doc_id: r.text for r in docs.collect()} == texts

    docs = stages["mixing sources"](spark, docs, folder)
    assert docs.columns == columns
    times = Counter(r.doc_id for r in docs.collect())
    assert set(times) == set(texts) and max(times.values()) <= 2
    assert {r.doc_id: r.text for r in docs.collect()} == texts

    rows = stages["best-fit packing"](spark, docs, folder).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0) == times
    fill: Counter = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert len(fill) <= -(-sum(fill.values()) // 2048) * 1.1 + 1


def test_run_goes_through_all_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
    ]
    assert corpus_pipeline.run(spark, folder).count() > 50
    assert corpus_pipeline.ORACLE_SQL is None and mixing.MAX_EPOCHS >= corpus_pipeline.MAX_EPOCHS


def plain_shingles(text):
    words = [w.lower() for w in WORDS.findall(text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def copies():
    """Chains of documents, each with some words of the one before changed, on both sides of 0.8."""
    draw = random.Random(3)
    texts = []
    for _ in range(25):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.randrange(60, 300))]
        for changed in (0, 1, 2, 4, 6, 9):
            for _ in range(changed):
                words[draw.randrange(len(words))] = f"n{draw.randrange(5000)}"
            texts.append(" ".join(words))
    texts += ["one two three", "One two  three", "one two four", "a b c d e", "a b c d e f"]
    draw.shuffle(texts)
    return texts


def test_near_copies_against_all_pairs(spark, copies):
    sets = [plain_shingles(t) for t in copies]
    root = list(range(len(copies)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    beyond_two_bits = 0
    for i, j in combinations(range(len(copies)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            low, high = sorted((find(i), find(j)))
            root[high] = low
            prints = [simhash.fingerprint(copies[k].encode()) for k in (i, j)]
            beyond_two_bits += (prints[0] ^ prints[1]).bit_count() > 2
    assert beyond_two_bits > 20  # what the two-bit rule of op8 would leave
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(copies)], "doc_id long, text string, lang string")
    kept = corpus_pipeline.without_near_copies(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    assert {r.doc_id: r.text for r in kept.collect()} == {i: t for i, t in enumerate(copies) if find(i) == i}
    assert near_copies.without_near_copies(docs.limit(0)).count() == 0


def test_rows_without_id_and_repeated_rows(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "abc")
    rows = [(None, one), (None, one + " more"), (7, two), (7, two), (None, two), (8, two + " more"), (9, three), (9, one + " tail end")]
    docs = spark.createDataFrame(rows[:7], "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in near_copies.without_near_copies(docs).collect()]
    assert len(kept) == 3 and {(7, two), (9, three)} <= set(kept)
    assert [t for i, t in kept if i is None][0] in (one, one + " more")  # unique but for its copies, so one stays
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in near_copies.without_near_copies(docs).collect()]
    assert sorted(kept) == sorted([(7, two), (9, three), (9, one + " tail end")])


def test_clashing_columns_pass_through(spark):
    names = ["row", "drops", "n_lines", "n_dropped", "node", "first", "key", "component", "weight", "epoch", "tokens"]
    one = " ".join(f"a{i}" for i in range(300)) + "\na line that both of them have"
    rows = [(1, one, "en", "s", 1, *range(11)), (2, one.replace("a7 ", "b7 "), "en", "s", 1, *range(11)), (3, "a line that both of them have\n" + " ".join(f"c{i}" for i in range(40)), "en", "s", 1, *range(11))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *names]
        docs = spark.createDataFrame(docs.collect(), schema)
        assert all(tuple(r)[5:] == tuple(range(11)) for r in docs.collect())
    assert {r.doc_id for r in docs.collect()} == {1, 3}
    assert corpus_pipeline.packed(spark, docs, "").count() >= 2
