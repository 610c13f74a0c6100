"""Long patterned words, limits from a gap, texts without an id, held-out floors."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from oreflow.llm.op2_quality_rules import KNEE, quality_rules, quartiles, sketch
from oreflow.llm.op3_lm_scoring import lm_scores
from oreflow.llm.op4_minhash_dedup import near_duplicates
from oreflow.llm.op5_suffix_dedup import suffix_dedup
from oreflow.llm.op6_decontamination import contaminated
from oreflow.llm.op8_quality_classifier import op8_quality_classifier
from oreflow.llm.op9_toxicity import op9_toxicity
from oreflow.llm.textvec import Flat, flat

DOCS = "doc_id bigint, text string, lang string, source string"


def thue_morse(n):
    """A sequence over two letters and its complement: sums of any polynomial
    modulo 2^64 over them are equal from 1024 letters on."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [8, 9, 16, 512, 1024, 4096])
def test_patterned_words_have_different_hashes(n):
    f = flat(pa.array(thue_morse(n)))
    for lower in (True, False):
        h = f.range_hashes(f.offs[:-1], f.offs[1:], lower)
        assert h[0] != h[1]


def test_range_hashes_depend_on_the_bytes_alone():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcÄé ") for _ in range(rnd.choice([0, 1, 7, 8, 9, 15, 16, 17, 40]))) for _ in range(400)]
    one = flat(pa.array(words))
    h = one.range_hashes(one.offs[:-1], one.offs[1:], lower=False)
    by = {}
    for w, x in zip(words, h.tolist()):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    alone = [flat(pa.array([w])) for w in words]
    assert [int(f.range_hashes(f.offs[:-1], f.offs[1:], lower=False)[0]) for f in alone] == h.tolist()
    up = flat(pa.array(["ABC def", "abc DEF"]))
    low = up.range_hashes(up.offs[:-1], up.offs[1:])
    assert low[0] == low[1]
    empty = Flat(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    assert len(empty.range_hashes(empty.offs[:-1], empty.offs[1:])) == 0


def test_patterned_words_in_the_operators(spark):
    a, b = thue_morse(1024)
    df = spark.createDataFrame([(1, a, "en", "s"), (2, b, "en", "s"), (3, f"{a}\n{b}\n" + "word " * 60, "en", "s")], DOCS)
    comp = {r.doc_id: r.component_id for r in near_duplicates(df, words=2).collect()}
    assert comp == {1: 1, 2: 2, 3: 3}
    assert {r.doc_id: r.n_dup_lines for r in quality_rules(df).collect()} == {1: 0, 2: 0, 3: 0}
    known = {r.doc_id: r.n_known for r in lm_scores(df).collect()}
    assert set(known) == {1, 2, 3}
    bench = spark.createDataFrame([(1, " ".join([a] * 8))], "item_id bigint, text string")
    hits = contaminated(spark.createDataFrame([(1, " ".join([b] * 8), "en", "s"), (2, " ".join([a] * 8), "en", "s")], DOCS), bench)
    assert {r.id for r in hits.collect()} == {2}


def brute_knee(values, spared):
    width = lambda v: 2 ** max(v.bit_length() - 7, 0)
    bins = sorted(Counter(v - v % width(v) for v in values).items())
    best, cum = None, 0
    for (lo, n), nxt in zip(bins, [*bins[1:], None]):
        cum += n
        if nxt and cum * 100 >= len(values) * spared:
            last = lo + width(lo) - 1
            ratio = (nxt[0] + 1) / (last + 1)
            if ratio >= KNEE and (best is None or ratio > best[0]):
                best = (ratio, int(((last + 1) * (nxt[0] + 1)) ** 0.5) - 1)
    lo = bins[-1][0]
    return best[1] if best else lo + width(lo) - 1


def test_the_gap_of_a_sketch(spark):
    rnd = random.Random(1)
    groups = {"prose": [0] * 300 + [rnd.randrange(90, 400) for _ in range(30)], "code": [rnd.randrange(15, 70) for _ in range(300)] + [900, 950],
              "clean": [0] * 250, "even": [rnd.randrange(0, 4) for _ in range(250)], "late": [0] * 10 + [500] * 240}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    sk = sketch(spark.createDataFrame(rows, "g string, symbol_pm bigint"), ["g"], ["symbol_pm"])
    got = {r.g: r.knee for r in quartiles(sk, ["g"]).collect()}
    assert got == {g: brute_knee(vs, 75) for g, vs in groups.items()}
    assert got["prose"] < 90 and got["clean"] == 0 and 70 < got["code"] < 900 and got["late"] >= 500


def test_sources_that_differ_get_different_verdicts(spark):
    rnd = random.Random(7)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    text = lambda share: " ".join(rnd.choice(vocab) + ("#" if rnd.random() < share else "") for _ in range(80))
    rows = [(i, text(0.0), "en", "prose") for i in range(230)] + [(1000 + i, text(0.25), "en", "code") for i in range(230)]
    rows += [(5000, text(0.25), "en", "prose"), (5001, text(0.25), "en", "code")]
    rows += [(6000 + i, " ".join("#$%&*" for _ in range(60)) + " " + text(0.9), "en", s) for i, s in enumerate(["prose"] * 3)]
    got = {r.doc_id: r.kept for r in quality_rules(spark.createDataFrame(rows, DOCS)).collect()}
    assert not got[5000] and got[5001]
    assert sum(got[i] for i in range(230)) >= 225 and sum(got[1000 + i] for i in range(230)) >= 225
    assert not any(got[6000 + i] for i in range(3))


def test_texts_without_an_id_keep_their_own_spans(spark):
    rnd = random.Random(5)
    rows = [(None, "".join(rnd.choice("abcdefghijklmnop") for _ in range(150))) for _ in range(3000)]
    rows += [(None, rows[0][1] + "tail"), (7, rows[1][1]), (7, "x" * 20), (7, rows[1][1])]
    got = suffix_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    removed = Counter((r.doc_id, r.n_bytes, r.n_removed) for r in got)
    assert len(got) == len(rows)
    # one of the pair that shares 150 bytes loses them; id 7's copies of a text without an id go whole
    assert removed[(None, 150, 0)] + removed[(None, 150, 150)] == 3000 and removed[(None, 150, 150)] + removed[(None, 154, 150)] == 1
    assert removed[(7, 150, 150)] == 2 and removed[(7, 20, 0)] == 1


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.01"


def test_quality_scores_hold_out(spark, sf):
    y = spark.read.parquet(f"{sf}/labels.parquet").where("quality is not null").select("doc_id", "quality")
    r = op8_quality_classifier(spark, sf).where("held_out").join(y, "doc_id").groupBy("quality", "predicted").count().collect()
    n = {(x.quality, x.predicted): x["count"] for x in r}
    good, bad = n.get((1, 1), 0) + n.get((1, 0), 0), n.get((0, 1), 0) + n.get((0, 0), 0)
    assert n.get((1, 1), 0) >= 0.95 * good and n.get((0, 0), 0) >= 0.9 * bad and good > 20 and bad > 3


def test_toxicity_scores_hold_out(spark):
    sf = "/root/testdata/sf0.1"          # sf0.01 holds out six toxic texts only
    y = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").select("doc_id", "toxic")
    r = op9_toxicity(spark, sf).where("held_out").join(y, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(x.toxic, x.predicted): x["count"] for x in r}
    assert n.get((1, 1), 0) >= 0.85 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 0), 0) >= 0.95 * (n.get((0, 0), 0) + n.get((0, 1), 0))


def test_language_model_beats_the_base_on_held_out_texts(spark, sf):
    d = lm_scores(spark.read.parquet(f"{sf}/documents.parquet")).where("held_out and n_tokens > 1")
    r = d.agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.avg((F.col("score") > F.col("base_score")).cast("int")).alias("n")).first()
    assert r.s > r.b and r.n > 0.9
