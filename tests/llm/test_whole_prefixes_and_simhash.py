"""Chat prefixes are rendered whole at every turn, and near copies are found by SimHash too."""

from pyspark.sql import functions as F

import corpus_pipeline
from dosewright.llm import chat, near_copies, simhash


def test_every_prefix_is_rendered_whole(spark):
    def late_rewriter(turns):
        """Wrongly declared: cuts its first turn between two of the numbers of turns that a declaration is checked at."""
        cut = 34 <= len(turns) < 60
        return "".join(f"<{t[:2] if cut and not i else t}>" for i, (_, t) in enumerate(turns))

    chat.append_only(late_rewriter)
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(62)]
    talks = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    turns = [(r, t) for *_, r, t in rows]
    wanted = [not late_rewriter(turns[: i + 1]).startswith(late_rewriter(turns[:i])) for i in range(62)]
    assert [i for i, rewritten in enumerate(wanted) if rewritten] == [33, 59]
    got = chat.formatted_turns(talks, late_rewriter).orderBy("number").collect()
    assert [r.rewritten for r in got] == wanted


def test_the_query_renders_each_prefix_of_its_own_template(monkeypatch):
    seen = []
    rendered = chat.append_only(lambda turns: seen.append(len(turns)) or chat.template(turns))
    prefixes = chat.Prefixes(rendered, whole=True)
    for i in range(30):
        prefixes.add("user", f"t{i}", False)
    assert seen == list(range(31))


def test_a_declaration_is_checked_beyond_a_thousand_turns():
    late = chat.append_only(lambda turns: "".join("x" if len(turns) > 1500 and not i else t for i, (_, t) in enumerate(turns)))
    prefixes = chat.Prefixes(late)
    assert [n for n in range(1, 2049) if prefixes.add("user", "ab", False)[3]] == [2048]


def test_near_copies_by_fingerprint(spark):
    """Texts that a much repeated passage brings within two bits, though their sets of shingles differ."""
    passage = "alpha beta gamma " * 400
    tails = [" ".join(f"{c}{i}" for i in range(20)) for c in "xyz"]
    one, two = passage + tails[0], passage + tails[1]
    prints = [simhash.fingerprint(t.encode()) for t in (one, two)]
    assert (prints[0] ^ prints[1]).bit_count() <= 2
    assert not near_copies.similar(*(near_copies.shingles(t.encode()) for t in (one, two)))
    rows = [(4, one), (2, two), (3, tails[2]), (7, one), (9, None), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.without_near_copies(spark, docs, "")
    assert {r.doc_id: r.text for r in kept.collect()} == {2: two, 3: tails[2], 8: " "}


def test_groups_are_those_of_op8_where_no_sets_are_similar(spark):
    texts = [" ".join(f"w{(i // 2 * 31 + j * j) % 997}" for j in range(40)) * (1 + i % 2) for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in simhash.simhash_groups(docs).collect()}
    kept = {r.doc_id for r in near_copies.without_near_copies(docs).select(F.col("doc_id")).collect()}
    # whatever op8 links, one row of its group stays at most
    assert all(len(kept & {i for i in groups if groups[i] == g}) <= 1 for g in set(groups.values()))
