"""Embeddings, chats and classifiers against plain versions, round trips and held-out accuracy."""

import hashlib
import math
import os
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dosewright.llm import boosting, chat, embedding_dedup, language_id, quality_model, toxicity

SF = "/root/testdata/sf0.01"


def plain_groups(vectors, threshold=0.9):
    ids = sorted({i for i, _ in vectors if i is not None})
    by_id = {i: np.array(v, dtype=float) for i, v in vectors if i is not None and usable(v)}
    links = defaultdict(set)
    for a in by_id:
        for b in by_id:
            x, y = by_id[a], by_id[b]
            if a != b and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a].add(b)
    out = {}
    for i in ids:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def usable(v):
    return bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)


def vectors(dimension, seed):
    draw = np.random.default_rng(seed)
    rows, n = [], 0
    for size in (1, 1, 2, 3, 9, 40):
        base = draw.normal(size=dimension)
        for _ in range(size):
            # on both sides of the threshold
            v = base + draw.normal(size=dimension) * draw.choice([0.0, 0.01, 0.3, 0.5])
            rows.append((n, [float(np.float32(c)) for c in v * draw.uniform(0.1, 9)]))
            n += 1
    rows += [(n + i, [float(np.float32(c)) for c in draw.normal(size=dimension)]) for i in range(60)]
    return rows


@pytest.mark.parametrize("dimension,home,row", [(64, 16384, 32), (64, 8, 2), (48, 16, 4), (5, 16384, 32), (1, 4, 1)])
def test_embedding_groups_against_all_pairs(spark, monkeypatch, dimension, home, row):
    monkeypatch.setattr(embedding_dedup, "HOME", home)  # few at home: many cells, cut into parts
    monkeypatch.setattr(embedding_dedup, "ROW", row)
    monkeypatch.setattr(embedding_dedup, "TILE", 16)
    rows = vectors(dimension, dimension + home)
    n = len(rows)
    odd = [None, [], [0.0] * dimension, [float("nan")] * dimension, [None] * dimension, [math.inf] + [1.0] * (dimension - 1)]
    rows += [(n + i, v) for i, v in enumerate(odd)] + [(n + 10, rows[0][1][:-1] + [0.0, 1.0]), (None, rows[0][1]), rows[5]]
    frame = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, raw string")
    got = embedding_dedup.embedding_groups(frame.repartition(3)).collect()
    assert len(got) == len(rows)
    wanted = plain_groups(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, False)
        else:
            assert (r.n_links, r.component_id) == wanted[r.vec_id], r
            assert r.kept == (wanted[r.vec_id][1] == r.vec_id)


def test_embeddings_of_doubles_and_none(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, math.sqrt(0.19)]), (3, [0.899, 0.5])], "vec_id long, embedding array<double>")
    rows = {r.vec_id: tuple(r)[1:3] for r in embedding_dedup.embedding_groups(frame).collect()}
    x, y, z = (np.array(r.embedding) for r in frame.orderBy("vec_id").collect())
    assert rows == {i: plain_groups([(1, list(x)), (2, list(y)), (3, list(z))])[i] for i in (1, 2, 3)}
    assert embedding_dedup.embedding_groups(frame.limit(0)).count() == 0


def test_rotation_keeps_lengths_and_rows_apart():
    g = embedding_dedup.Geometry(48, 10, 0.9)
    x = np.random.default_rng(1).normal(size=(50, 48))
    r = g.rotate(x)
    assert np.allclose((r**2).sum(axis=1), 1)
    assert all((g.rotate(x[i : i + 1]) == r[i]).all() for i in range(50))  # to the last bit


# --- chats -------------------------------------------------------------------

TALKS = [
    (1, 0, "system", "be <|turn|>good\\"), (1, 1, "user", "hi"), (1, 2, "assistant", "</s><|end|> \\<| é🙂\n"),
    (2, 5, "assistant", None), (2, 5, None, "x"), (2, 5, "assistant", "probe"), (2, 5, "assistant", "probe"),
    (None, None, "assistant", "no id"), (3, 0, "assistant", "<"), (3, None, "user<|text|>", ""),
    *((9, i, "assistant" if i % 2 else "user", f"turn {i} " + "long " * 90) for i in range(120)),
]


def test_chat_round_trip(spark):
    talks = spark.createDataFrame([(*t, "clash") for t in TALKS], "conv_id long, turn long, role string, text string, number string")
    got = {r.conv_id: r for r in chat.digests(talks.repartition(4)).collect()}
    by_id = defaultdict(list)
    for conv_id, turn, role, text in TALKS:
        by_id[conv_id].append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(by_id)
    for conv_id, held in by_id.items():
        r = got[conv_id]
        held.sort()
        whole = chat.template([(role, text) for _, role, text in held])
        assert chat.read_back(whole) == [(role, text) for _, role, text in held]
        loss = "".join(text for _, role, text in held if role == "assistant")
        sha = hashlib.sha256("".join(f"{role}\n{text}\n" for _, role, text in held).encode()).hexdigest()
        assert tuple(r)[1:] == (
            len(held), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(whole), False,
        )
        pieces = chat.formatted_turns(talks).where(F.col("conv_id").eqNullSafe(conv_id)).orderBy("number").collect()
        assert "".join(p.formatted for p in pieces) == whole
    assert chat.digests(talks.limit(0)).count() == 0


def test_trial_conversation(spark):
    talks = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    r = chat.digests(chat.with_trial(talks)).first()
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-1, 2, 21)
    assert r.loss_sha256 == hashlib.sha256(b"</s>[INST] ok [/INST]").hexdigest()


def brackets(turns):
    """A template of another kind, which the operator knows nothing of."""
    return "".join(f"[INST] {t} [/INST]" if r == "user" else f" {t.strip()}</s>" for r, t in turns)


def forgetful(turns):
    """Drops what was thought in earlier turns: it rewrites its history."""
    last = len(turns) - 1
    return "".join(f"<{r}>{t if i == last else t.split('</think>')[-1]}" for i, (r, t) in enumerate(turns))


def test_black_box_spans():
    prefixes = chat.Prefixes(brackets)
    pieces = [prefixes.add(r, t, True) for r, t in (("user", "a"), ("assistant", "[/INST] b"), ("user", ""), ("assistant", "c"))]
    assert "".join(p[0] for p in pieces) == brackets([("user", "a"), ("assistant", "[/INST] b"), ("user", ""), ("assistant", "c")])
    assert [p[0][p[1] : p[2]] for p in pieces] == ["a", "[/INST] b", "", "c"]
    assert not any(p[3] for p in pieces)
    prefixes = chat.Prefixes(forgetful)
    flags = [prefixes.add("x", t, False)[3] for t in ("plain", "a</think>b", "next")]
    assert flags == [False, False, True]


def numbered(turns):
    return "".join(f"{'first' if not i else i}:{t};" for i, (_, t) in enumerate(turns))


def trimmed(turns):
    """Cuts the first turn once there are more than thirty."""
    return "".join(t[:3] if not i and len(turns) > 30 else t for i, (_, t) in enumerate(turns))


def test_long_conversations_are_rendered_whole():
    turns = [("user", f"turn {i} " + "long " * 150) for i in range(40)]
    prefixes = chat.Prefixes(numbered)
    assert "".join(prefixes.add(*t, True)[0] for t in turns) == numbered(turns)
    prefixes = chat.Prefixes(trimmed)
    assert [prefixes.add(*t, False)[3] for t in turns] == [i == 30 for i in range(40)]
    prefixes = chat.Prefixes(chat.template)  # declared as append-only: goes on from the last turns
    assert "".join(prefixes.add(*t, True)[0] for t in turns) == chat.template(turns)
    assert len(prefixes.turns) == chat.CONTEXT


@pytest.mark.parametrize("words", [1, 200, 2000])
def test_the_way_of_a_declared_template_does_not_depend_on_sizes(words):
    turns = [("user", f"turn {i} " + "long " * words) for i in range(70)]
    prefixes = chat.Prefixes(chat.append_only(lambda t: chat.template(t)))
    pieces = [prefixes.add(*t, True) for t in turns]
    assert "".join(p[0] for p in pieces) == chat.template(turns) and not any(p[3] for p in pieces)
    assert all(chat.unescape(p[0][p[1] : p[2]]) == t for p, (_, t) in zip(pieces, turns))
    # a declaration that does not hold is found at a doubling number of turns
    for wrong, seen in ((numbered, 4), (trimmed, 31)):
        prefixes = chat.Prefixes(chat.append_only(lambda t, wrong=wrong: wrong(t)))
        flags = [prefixes.add(*t, False)[3] for t in turns]
        assert not any(flags[:seen]) and any(flags[seen:])


def test_probes_that_the_template_or_the_role_contain():
    probing = lambda turns: "".join(f"probe other {r}:{t}/probe;" for r, t in turns)
    prefixes = chat.Prefixes(probing)
    for role, text in (("probe", "other"), ("x", ""), ("other", "probe"), ("y", "e")):
        added, start, end, _ = prefixes.add(role, text, True)
        assert added[start:end] == text


def test_languages_near_and_beyond_the_old_size_limit():
    draw = random.Random(4)
    words = {"a": ["kalo", "mira", "sento", "vapu"], "b": ["grund", "hakt", "mirz", "vorn"]}
    text = lambda lang, n: " ".join(draw.choices(words[lang], k=n))
    raw = {lang: text(lang, 400).encode() for lang in words}
    held = language_id.Compressors(raw)
    for lang in words:
        for n in (5, 90, 95, 100, 105, 110, 2000):
            name, score, rejected, margin = held.decide(text(lang, n))
            assert name == lang and (score > 0.5) == (not rejected) == (margin > language_id.NARROW)
    # plain recompression: the smallest of all, by the compressors that the margin asks for
    for n in (3, 40, 300):
        mixed = text("a", n) + " " + text("b", n)
        data = language_id.letters(mixed)
        sizes = [len(c.compress(data)) for c in held.fast]
        if abs(sizes[0] - sizes[1]) < language_id.CLOSE * max(sizes):
            sizes = [len(c.compress(data)) for c in held.thorough]
        assert held.decide(mixed)[0] == ("a" if sizes[0] <= sizes[1] else "b")


# --- classifiers -------------------------------------------------------------


def test_trees_learn_and_are_flat():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(x[:2000], y[:2000], trees=40)
    assert ((trees.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.97
    assert trees.feature.shape == (40, 15) and trees.leaf.shape == (40, 16)
    walked = []
    for row in x[:20]:  # tree by tree and node by node
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < 15:
                node = 2 * node + 1 + int(row[f[node]] > t[node])
            total += leaf[node - 15]
        walked.append(1 / (1 + math.exp(-total)))
    assert np.allclose(trees.score(x[:20]), walked)
    assert len(boosting.fit(x[:0], y[:0]).leaf) == 0
    assert 0.99 < boosting.fit(x[:500], np.ones(500)).score(x[:1])[0] < 1


ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 ... !!"), (5, "word " * 30_000), (5, "word " * 30_000), (None, "no id")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "x", 0.5) for i, t in ODD], "doc_id long, text string, lang string, stats string, score double")


def test_odd_documents_are_scored(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for scored in (quality_model.score_documents(odd, none), toxicity.score_documents(odd, none)):
        rows = scored.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    some = spark.createDataFrame([(1, None, None), (2, 1, 0), (3, 0, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality_model.score_documents(odd, some).count() == len(ODD)
    assert toxicity.score_documents(odd, some).count() == len(ODD)
    rows = {r.doc_id: r for r in language_id.language_id(odd).collect()}
    assert len(rows) == 6 and [rows[i].lang_pred for i in (1, 2, 3, 4)] == ["und"] * 4
    assert language_id.language_id(odd.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0
    for empty in (
        quality_model.score_documents(odd.limit(0), some), toxicity.score_documents(odd.limit(0), some),
        language_id.language_id(odd.limit(0)),
    ):
        assert empty.count() == 0


def test_held_out_rows_are_those_of_the_checksum(odd):
    got = {r.doc_id: r.held_out for r in language_id.language_id(odd).collect()}
    assert got == {i: i is None or zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in ODD}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not there")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = quality_model.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    found = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) >= 0.95 * len(found)
    toxic = toxicity.score_documents(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted for r in toxic if not r.toxic) <= 0.02 * len(toxic)
    assert sum(r.predicted == r.toxic for r in toxic) >= 0.95 * len(toxic)


def test_obfuscated_words_are_restored(spark):
    words = "stupid idiot moron the of and that there other with from have this they will would could people good book".split()
    draw = random.Random(1)
    text = " ".join(draw.choice(words) for _ in range(4000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    restore = toxicity.Words(toxicity.language_model(toxicity.trigram_counts(docs)))
    for written, meant in (
        ("1d10t", "idiot"), ("m0r0n!", "moron"), ("$tup1d", "stupid"), ("st.up.id", "stupid"), ("idiooooot", "idiot"),
        ("so i d i o t you", "idiot"), ("s-t-u-p-i-d", "stupid"), ("MORON", "moron"), ("id*ot", "idiot"),
    ):
        assert meant in restore(written), written
    assert restore("plain words, as they stand.") == {"plain", "words", "as", "they", "stand"}


def test_words_with_look_alikes_at_the_end_and_long_tokens_are_restored(spark):
    words = "stupid idiot moron class ass the of and that there other with from have this they will would people good".split()
    draw = random.Random(1)
    docs = spark.createDataFrame([(1, " ".join(draw.choice(words) for _ in range(4000)))], "doc_id long, text string")
    restore = toxicity.Words(toxicity.language_model(toxicity.trigram_counts(docs)))
    joined = "-".join(["people", "of", "that"] * 10)
    for written, meant in (
        ("idio7", "idiot"), ("idio7!", "idiot"), ("a$$", "ass"), ("idio+", "idiot"),
        ("idi" + "o" * 90 + "t", "idiot"), (f"{joined}-1d10t-{joined}", "idiot"), (f"{joined}/m0r0n", "moron"),
        (f"{joined}-i.d.i.o.t-{joined}", "idiot"), (f"{joined}.st.up1d.{joined}", "stupid"), (f"{joined}.st.u.p1d.{joined}", "stupid"), (f"{joined}-idio7", "idiot"),
        ("you-are-1d10t-there", "idiot"),
    ):
        assert meant in restore(written), written


def test_words_learnt_as_toxic(spark):
    draw = random.Random(4)
    plain = [f"{a}{b}" for a in ("ba", "ce", "di", "fo") for b in ("na", "le", "mi", "ro", "su", "ta", "vo")]
    rows, labels = [], []
    for i in range(600):
        words = [draw.choice(plain) for _ in range(40)]
        toxic = int(i % 6 == 0)
        if toxic:
            words[7] = draw.choice(["grumble", "gr0uch", "vequandor", "vequimel", "vequost"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert all(r.predicted == labels[r.doc_id][1] for r in scored)
    shadows = toxicity.without_shadows({"loser": (60, 60), "lose-": (60, 63), "vequ-": (40, 40), "vequandor": (9, 9)})
    assert set(shadows) == {"loser", "vequ-", "vequandor"}
