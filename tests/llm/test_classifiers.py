"""Language, quality and toxicity: held-out accuracy, odd rows, and what must not count."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotewire.llm import lang_id, quality, toxicity
from quotewire.llm.folds import held_out
from quotewire.llm.queries import QUERIES
from quotewire.llm.samples import one_text_per_key

FOLDER = "/root/testdata/sf0.01"


def rows(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = QUERIES[name](spark, FOLDER).join(docs, "doc_id", "left").join(labels, "doc_id", "left").collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in got)
    return got


def test_folds(spark):
    got = spark.range(50).toDF("doc_id").select("doc_id", held_out(4, 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert spark.sql("SELECT cast(NULL AS long) doc_id").select(held_out(1, 0)).first()[0] is False


def test_language_held_out(spark):
    got = [r for r in rows(spark, "op1_language_id") if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.98


def test_quality_held_out(spark):
    got = [r for r in rows(spark, "op3_quality") if r["held_out"] and r["quality"] is not None]
    assert np.mean([r["quality"] == r["predicted"] for r in got]) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_toxicity_held_out(spark):
    got = [r for r in rows(spark, "op4_toxicity") if r["held_out"] and r["toxic"] is not None]
    assert np.mean([r["toxic"] == r["predicted"] for r in got]) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got)


ODD = [(1, None, "x"), (2, "", "x"), (3, " \n12 %$", "x"), (None, "some letters", "x"), (4, "é" * 50_000, "x"),
       (4, "é" * 50_000, "x"), (5, "a", "x"), (6, "ab", "x"), (7, "\U0001F600 \U00020000 ab", "x")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, score string").repartition(2)


def scores(df):
    assert df.count() == len(ODD)
    return {(r["doc_id"], r["text"]): r["score"] for r in df.collect()}


def test_language_of_odd_rows(spark, odd):
    docs = spark.createDataFrame([("aaa bbb", "x"), ("ccc ddd", "y"), (None, "x"), ("eee", None)], "text string, lang string")
    model = lang_id.train(docs, F.lit(True))
    assert model[0] == ["x", "y"]
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in lang_id.predict(odd, *model, keep_text=True).collect()}
    assert {got[k] for k in [(1, None), (2, ""), (3, " \n12 %$")]} == {("und", 0.0)}
    assert got[(5, "a")][0] == "x" and got[(7, "\U0001F600 \U00020000 ab")][0] == "x"
    nothing = lang_id.train(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in lang_id.predict(odd, *nothing).collect()} == {"und"}
    assert lang_id.predict(odd.limit(0), *model).count() == 0


def test_language_counts_every_gram(spark):
    """The table against counts by plain loops, over texts cut into many slices."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc é.\n") for _ in range(rng.randint(0, 30))) for _ in range(40)]
    grams = lang_id._Grams(16)

    def count(column):
        out = np.zeros(1 << 16, int)
        for _, found in grams.of(column):
            out += np.bincount(found, minlength=1 << 16)
        return out

    whole = count(pa.array(texts))
    assert (whole == sum(count(pa.array([t])) for t in texts)).all()
    kept = [[c if c.isalpha() else " " for c in "  " + t] for t in texts]
    n = sum(3 for k in kept for a, b in zip(k[1:], k[2:]) if a + b != "  ")
    assert whole.sum() == n


def test_quality_of_odd_rows(spark, odd):
    w, prior = quality.train(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"), F.lit(True))
    assert max(scores(quality.predict(odd, w, keep_text=True)).values()) < 1e-9
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 0, 0), (6, None, 1)], "doc_id long, quality int, toxic int")
    w, prior = quality.train(odd, labels, F.lit(True))
    assert 0 <= prior <= 1 and np.isfinite(w).all()
    assert quality.predict(odd.limit(0), w).count() == 0
    assert all(0 <= s <= 1 for s in scores(quality.predict(odd, w, keep_text=True)).values())


def test_prior_and_risk():
    rng = np.random.RandomState(1)
    good, bad = rng.standard_normal((3000, 5)) + 2, rng.standard_normal((900, 5)) - 2
    positive, unlabelled = good[:1500], np.vstack([good[1500:2100], bad[:600]])
    w, prior = quality.fit(positive.astype(np.float32), unlabelled.astype(np.float32))
    assert abs(prior - 0.5) < 0.06
    score = quality._logistic(np.vstack([good[2100:], bad[600:]]) @ w[:-1] + w[-1])
    assert (score[:900] > 0.5).mean() > 0.97 and (score[900:] < 0.5).mean() > 0.97


@pytest.mark.parametrize("label, other_weight", [(1, 1), (1, 99), (0, 99)])
def test_toxicity_penalty_counts_texts_of_the_rarer_label(label, other_weight):
    """Ten texts of the rarer label explain a word and one does not, however the sample is weighed."""
    rng = random.Random(4)
    common = [f"c{chr(97 + i)}" for i in range(20)]
    texts = [rng.choices(common, k=8) for _ in range(600)]
    labels = np.array([float(label if i < 200 else 1 - label) for i in range(600)])
    for i in range(10):
        texts[i].append("telling")
    texts[10].append("single")
    weights = np.where(labels == label, 1.0, float(other_weight))
    table, _ = toxicity.fit(sets_of([" ".join(t) for t in texts]), labels, weights)
    told, once = (table[sets_of([w])[0]][0] * (1 if label else -1) for w in ("telling", "single"))
    assert told > 1 and once == 0


def test_toxicity_of_odd_rows(spark, odd):
    model = toxicity.train(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"), F.lit(True))
    assert max(scores(toxicity.predict(odd, model, keep_text=True)).values()) < 1e-9
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (6, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, labels, F.lit(True))
    found = scores(toxicity.predict(odd, model, keep_text=True))
    assert found[(1, None)] == found[(2, "")] and all(0 <= s <= 1 for s in found.values())
    assert toxicity.predict(odd.limit(0), model).count() == 0


def sets_of(texts):
    words, heads = toxicity._hasher().words(pa.array(texts))
    found = toxicity._buckets(words)
    return [np.unique(found[a:b]) for a, b in zip(heads, heads[1:])]


def test_neutral_mentions_gain_no_weight():
    """Toxic texts name one group far more often; only the counterfactual fit ignores it."""
    rng = random.Random(6)
    neutral = [f"n{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    texts, labels = [], []
    for i in range(1200):
        toxic = i % 4 == 0
        words = rng.choices(neutral, k=12)
        if toxic and rng.random() < 0.5:
            words.append(rng.choice(["vile", "scum"]))
        if rng.random() < (0.9 if toxic else 0.03):
            words.append("muslim")
        if not toxic and rng.random() < 0.5:
            words.append("christian")
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(float(toxic))
    sets, labels, ones = sets_of(texts), np.array(labels), np.ones(len(texts))
    plain = toxicity.fit(sets, labels, ones, change_penalty=0.0)
    fair = toxicity.fit(sets, labels, ones, change_penalty=100.0)

    def score(model, text):
        return 1 / (1 + np.exp(-model[0][sets_of([text])[0]].sum() - model[1]))

    mention = "a muslim neighbour came by"
    assert score(plain, mention) > 0.7 > 0.5 > score(fair, mention)
    assert abs(score(fair, mention) - score(fair, mention.replace("muslim", "christian"))) < 0.1
    assert score(fair, "you vile scum") > 0.9


def test_swaps_are_the_differences():
    sets = sets_of(["the Woman and the man", "nothing here"])
    rows_, columns, values, n = toxicity.swaps(sets, {"k": ("woman", "man", "girl")})
    assert n == 4  # woman to man or girl, man to woman or girl
    assert sorted(np.bincount(rows_, values, minlength=n)) == [0, 0, 1, 1]


@pytest.mark.parametrize("model,name", [(quality, "quality"), (toxicity, "toxic")])
def test_fit_on_a_bounded_number_of_rows(spark, monkeypatch, model, name):
    """One doc_id that 20,000 rows share is one text of the sample."""
    words = ["ill", "good", "tree", "house", "river"]
    docs = spark.range(22_000).select(
        F.when(F.col("id") < 20_000, -1).otherwise(F.col("id")).alias("doc_id"),
        F.concat_ws(" ", *[F.element_at(F.array(*map(F.lit, words)), (F.col("id") % n + 1).cast("int")) for n in (2, 3, 5)],
                    F.col("id").cast("string")).alias("text"),
    )
    # Labels cover far more ids than the table; the sample comes from those it has.
    labels = spark.range(-1, 200_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).cast("int").alias(name)
    )
    met, features = [], model.features

    def counted(texts):
        out = features(texts).cache()
        met.append(out.count())
        return out

    monkeypatch.setattr(model, "features", counted)
    model.train(docs, labels, ~held_out(5, 0), most=300)
    assert 150 < met[0] < 450


def test_one_text_per_key_is_the_same_in_any_order(spark):
    rows = spark.createDataFrame([(i % 7, f"text {i}", 1) for i in range(100)], "doc_id long, text string, label int")
    got = [
        {(r["doc_id"], r["text"]) for r in one_text_per_key(df).collect()}
        for df in (rows.repartition(5), rows.orderBy(F.desc("text")))
    ]
    assert got[0] == got[1] and len(got[0]) == 7


def test_terms_of_swaps_are_an_argument(spark):
    """Through the query's own fit: a neutral mention of a group gains no weight by its swaps."""
    rng = random.Random(5)
    common = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    rows = []
    for i in range(600):
        toxic = i % 2
        words = rng.choices(common, k=30) + (["vile"] if toxic and i % 4 == 1 else [])
        if rng.random() < (0.6 if toxic else 0.1):
            words.append("zorg")
        elif rng.random() < 0.1:
            words.append("blarg")
        rows.append((i, " ".join(words), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    docs, labels, learn = df.select("doc_id", "text"), df.select("doc_id", "toxic"), F.lit(True)
    plain = toxicity.train(docs, labels, learn, terms={})
    fair = toxicity.train(docs, labels, learn, terms={"kind": ("zorg", "blarg")})
    mentions = spark.createDataFrame([(0, "zorg"), (1, "blarg"), (2, "vile")], "doc_id long, text string")

    def gap(model):
        s = {r["doc_id"]: r["score"] for r in toxicity.predict(mentions, model).collect()}
        return abs(s[0] - s[1]), s[2]

    assert gap(fair)[0] < 0.5 * gap(plain)[0]
    assert gap(fair)[1] > 0.7
