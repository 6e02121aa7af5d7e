"""Decoding, tree growing and compression of the learnt operators, against plain versions."""

import itertools
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from dosewright.llm import boosting, language_id, toxicity

PLAIN = "you are a stupid moron and an idiot , said the loser of the town . he is so kind to us all , my friend "


@pytest.fixture(scope="module")
def restorer(spark):
    docs = spark.createDataFrame([(PLAIN * 20,)], "text string").repartition(2)
    return toxicity.Restorer(toxicity.language_model(toxicity.trigram_counts(docs)))


def cost(model, reading):
    """Cost of the channel and of the model of one path through a lattice."""
    text = "".join(letters for letters, _ in reading)
    c = [0, 0, *map(toxicity._class, text), 0]
    return sum(price for _, price in reading) - sum(model[x][y][z] for x, y, z in zip(c, c[1:], c[2:]))


@pytest.mark.parametrize("written", ["1d10t", "m0r0n", "l.o.s.e.r", "idi*t", "stuuupid", "$tup!d", "i|1|0t", "", "7"])
def test_decoding_against_all_readings(restorer, written):
    lattice = restorer.lattice(written)
    best = min(cost(restorer.model, path) for path in itertools.product(*lattice))
    found = restorer.decode(written)
    same = [p for p in itertools.product(*lattice) if "".join(x for x, _ in p) == found]
    assert min(cost(restorer.model, p) for p in same) == pytest.approx(best)


def test_blanks_against_all_readings(restorer):
    draw = random.Random(2)
    for _ in range(20):
        lattice = []
        for c in "".join(draw.choice("idot1") for _ in range(6)):
            lattice += restorer.lattice(c)
            lattice.append([("", toxicity.FILLED), (" ", toxicity.ENDED)])
        paths = list(itertools.product(*lattice))
        best = min(cost(restorer.model, path) for path in paths)
        found = restorer.cheapest(lattice)
        assert min(cost(restorer.model, p) for p in paths if "".join(x for x, _ in p) == found) == pytest.approx(best)


@pytest.mark.parametrize(
    "written, words",
    [
        ("y o u i d i o t", {"you", "idiot"}),
        ("so s t u p i d m o r o n !", {"stupid", "moron"}),
        ("the m o ron", {"moron"}),
        ("i  d  i  o  t", {"idiot"}),
        ("he is an i d 1 o t", {"idiot"}),
        ("l.o.s.e.r", {"loser"}),
    ],
)
def test_word_ends_of_spelt_stretches(restorer, written, words):
    assert words <= set(restorer.spaced(written))


def test_spelt_stretches_at_any_place(restorer):
    assert list(toxicity.spelt_stretches("plain words of any length, 12 of them")) == []
    assert list(toxicity.spelt_stretches("")) == []
    # the word stands across the borders of windows, wherever it begins
    for before in range(0, 40, 3):
        assert "idiot" in restorer.spaced("t o w n " * before + "i d i o t" + " t o w n" * 30)


def test_one_tree_against_all_splits():
    draw = np.random.default_rng(4)
    x = np.round(draw.normal(size=(300, 4)), 1)
    y = ((x[:, 2] > 0.4) ^ (draw.random(300) < 0.1)).astype(float)
    tree = boosting.fit(x, y, trees=1, depth=1, rate=0.3, smooth=1.0, least=8)
    p = (y.sum() + 1) / (len(y) + 2)
    gradient, weight = p - y, np.full(len(y), p * (1 - p))

    def part(rows):
        return gradient[rows].sum() ** 2 / (weight[rows].sum() + 1.0)

    gains = {}
    for f in range(4):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, boosting.BINS + 1)[1:-1])):
            right = x[:, f] > cut
            if min(right.sum(), (~right).sum()) >= 8:
                gains[f, cut] = part(right) + part(~right) - part(slice(None))
    f, cut = tree.feature[0][0], tree.threshold[0][0]
    assert gains[f, cut] == pytest.approx(max(gains.values()))
    right = x[:, f] > cut
    for leaf, rows in zip(tree.leaf[0], (~right, right)):
        assert leaf == pytest.approx(-0.3 * gradient[rows].sum() / (weight[rows].sum() + 1.0))


def test_languages_against_plain_compression(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    raw = language_id.dictionaries(docs)
    found = {r.doc_id: r for r in language_id.identify(docs, raw).collect()}
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    assert len(found) == len(rows) and len(raw) > 2

    def sizes(data, level):
        out = {}
        for name, content in raw.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            out[name] = len(zstandard.ZstdCompressor(dict_data=d, level=level, write_content_size=False).compress(data))
        return out

    for r in rows[::4]:
        data = language_id.letters(r.text)
        if not any(c.isalpha() for c in r.text):
            assert found[r.doc_id].lang_pred == "und"
            continue
        size = sizes(data, 3)
        least, after = sorted(size.values())[:2]
        if after - least < language_id.CLOSE * after:
            size = sizes(data, 19)
            least, after = sorted(size.values())[:2]
        assert size[found[r.doc_id].lang_pred] == least
        assert found[r.doc_id].margin == pytest.approx((after - least) / after)
