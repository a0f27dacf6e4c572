"""Term settings from one count, votes by both metrics, stored options."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.operators import features, neighbours, ngrams
from opinara.operators.features import TermSetting
from opinara.operators.text_neighbours import nearest_texts
from opinara.plans import classification as cl
from test_text_neighbours import plain_ngrams


def test_settings_share_one_count(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    docs = [[words[min(49, int(rng.expovariate(0.12)))] for _ in range(rng.randint(0, 30))] for _ in range(90)] + [["w2", "w3"] * 25, []]
    df = spark.createDataFrame([(d,) for d in docs], "tokens array<string>").repartition(5)
    settings = [
        TermSetting((1, 3), (), 30, 1), TermSetting((1, 1), (), 12, 4), TermSetting((1, 2), (), 400, 0.05),
        TermSetting((1, 3), (), 25, 9), TermSetting((2, 3), (), 15, 2), TermSetting((3, 3), (), 5000, 1),
    ]
    for setting, model in zip(settings, features.fit_settings(df, "tokens", settings), strict=True):
        least = math.ceil(setting.min_df * len(docs)) if isinstance(setting.min_df, float) else setting.min_df
        want = plain_ngrams(docs, *setting.ngram_range, setting.max_features, least)
        assert dict(zip(model.terms, zip(model.ctf, model.df, strict=True), strict=True)) == want, setting
        assert model.terms == sorted(model.terms) and model.n_docs == len(docs)


def test_settings_of_no_texts(spark):
    df = spark.createDataFrame([], "tokens array<string>")
    for model in features.fit_settings(df, "tokens", [TermSetting(), TermSetting((2, 2)), TermSetting((1, 1), (), 5, 0.5)]):
        assert model.terms == [] and model.n_docs == 0


def _unit(entries):
    norm = math.sqrt(sum(x * x for x in entries.values())) or 1.0
    keys = sorted(entries)
    return keys, [entries[i] / norm for i in keys]


@pytest.mark.parametrize("k", [1, 4, 9])
def test_chords_match_plain_distances(spark, k):
    """Zero vectors, equal vectors and vectors without a common term, self left out."""
    rng = random.Random(k)
    rows = []
    for i in range(60):
        entries = {} if i % 9 == 0 else {rng.randrange(12): rng.random() + 0.1 for _ in range(rng.randint(1, 4))}
        rows.append((i, i % 3, *_unit(entries)))
    rows += [(100 + i, 1, *rows[i][2:]) for i in (0, 5, 7)]
    df = spark.createDataFrame(rows, "id int, label int, i array<int>, v array<double>")
    df = df.select("id", "label", F.struct(F.col("i").alias("indices"), F.col("v").alias("values")).alias("vector"))
    found = nearest_texts(
        df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "b"), k, 12, "q", "b", carry=["label"], exclude_self=True,
        block_rows=8, query_rows=8, metric="euclidean",
    ).collect()
    dense = {r[0]: [dict(zip(r[2], r[3], strict=True)).get(t, 0.0) for t in range(12)] for r in rows}
    for q, x in dense.items():
        far = {b: sum((s - t) ** 2 for s, t in zip(x, y, strict=True)) for b, y in dense.items() if b != q}
        mine = sorted((r for r in found if r["q"] == q), key=lambda r: r["rank"])
        assert [r["dist_nano"] for r in mine] == sorted(r["dist_nano"] for r in mine) and len(mine) == k
        want = sorted(far.values())[:k]
        assert [r["dist_nano"] / 1e9 for r in mine] == pytest.approx(want, abs=3e-9)
        assert all(far[r["b"]] == pytest.approx(r["dist_nano"] / 1e9, abs=3e-9) for r in mine)


def test_votes(spark):
    near = [(1, 0, 250_000_000), (1, 1, 1_000_000_000), (1, 1, 1_000_000_000), (2, 1, 0), (2, 0, 1), (2, 0, 1)]
    df = spark.createDataFrame(near, "q int, label int, dist_nano long")

    def of(**options):
        return {r["q"]: r["prediction"] for r in neighbours.vote(df, "q", "label", **options).collect()}

    # Row 1: 4 against 2 by cosine distance; 2 against 2 by distance, the tie to the smaller label.
    assert of() == {1: 0, 2: 1}
    assert of(metric="euclidean") == {1: 0, 2: 1}
    assert of(weights="uniform") == {1: 1, 2: 0}


def test_balanced_weights_and_stored_options(spark, tmp_path):
    rows = [(f"r{i}", "bad slow app" if i % 4 else "good app", 0 if i % 4 else 1) for i in range(40)]
    df = spark.createDataFrame(rows, "reviewId string, content string, label int")
    assert cl.balanced_weights(df) == {0: 40 / 60, 1: 40 / 20}
    scores, best = cl.model_grid(
        {"None": df}, df,
        models={"far": cl.Knn(3, "euclidean", "uniform"), "even": cl.Logistic(class_weights="balanced"), "none": cl.Logistic(class_weights=None)},
        terms={"one": TermSetting((1, 1), ("app",), 10, 0.1), "two": TermSetting((2, 2), (), 10, 1)},
    )
    got = scores.collect()
    assert [(r["terms"], r["model"]) for r in got] == [(t, m) for t in ("one", "two") for m in ("far", "even", "none")]
    assert [r["best"] for r in got] == [True, False, False, False, False, False] and got[0]["macro_f1"] == 1.0
    best.save(str(tmp_path / "m"))
    again = cl.load_model(spark, str(tmp_path / "m"), "KNN")
    assert (again.k, again.metric, again.weights) == (3, "euclidean", "uniform")
    assert again.vectoriser.getOrDefault("stopWords") == ["app"] and again.vectoriser.getOrDefault("ngramRange") == [1, 1]
    assert again.predict(df).where("prediction <> label").count() == 0


@pytest.mark.parametrize("metric,options", [
    ("euclidean", dict(cell_rows=8, block_rows=4, query_rows=5)), ("cosine", dict(cell_rows=8, block_rows=4, query_rows=5)),
    ("euclidean", dict(cell_rows=16, max_cells=6)), ("euclidean", {}),
])
def test_neighbours_within_groups(spark, metric, options):
    """Groups with many cells, groups with one, a group of one row; queries of a group without base rows get none."""
    rng = random.Random(11)
    sizes = {0: 90, 1: 1, 2: 5, 3: 40, 5: 30}
    rows = [(g * 1000 + i, g, [rng.gauss(g, 1) for _ in range(3)]) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id int, g int, v array<double>").repartition(4)
    base = df.where("g <> 5 or id % 1000 < 20").withColumnRenamed("id", "b")
    asked = df.unionByName(spark.createDataFrame([(9000, 4, [0.0, 0.0, 1.0]), (9001, 9, [1.0, 0.0, 1.0])], df.schema))
    found = neighbours.nearest(
        asked.withColumnRenamed("id", "q"), base, 4, 3, "q", "b", "v", metric=metric, exclude_self=True, group="g", **options
    ).collect()

    def apart(x, y):
        if metric == "euclidean":
            return sum((s - t) ** 2 for s, t in zip(x, y, strict=True))
        return 1 - sum(s * t for s, t in zip(x, y, strict=True)) / math.sqrt(sum(s * s for s in x) * sum(t * t for t in y))

    for q, g, x in rows:
        want = sorted((apart(x, y), b) for b, h, y in rows if h == g and b != q and (h != 5 or b % 1000 < 20))[:4]
        mine = sorted((r for r in found if r["q"] == q), key=lambda r: r["rank"])
        assert [r["b"] for r in mine] == [b for _, b in want]
    assert not [r for r in found if r["q"] >= 9000]


def test_lots_name_the_same_ngrams(spark, monkeypatch):
    """Tasks give up what they hold after each lot, and no frequent pair is lost by that."""
    from opinara.operators import ngrams

    rows = [([k % 3, (k * 7) % 5, k % 3, k % 2],) for k in range(400)]
    df = spark.createDataFrame(rows, "codes array<int>").coalesce(1)
    monkeypatch.setattr(ngrams, "_PIECE_ROWS", 16)
    merged = ngrams._merged
    sizes = []
    monkeypatch.setattr(ngrams, "_merged", lambda found, counts: sizes.append(len(found)) or merged(found, counts))
    monkeypatch.setattr(ngrams, "_LOT_TOKENS", 128)
    pairs = Counter((a, b) for r, in rows for a, b in zip(r, r[1:]))
    least = sorted(pairs.values())[len(pairs) // 2]
    named = ngrams._named(df, 2, 5, None, least / 1600, least)
    assert {a * 5 + b for (a, b), n in pairs.items() if n >= least} <= set(named.tolist())
    assert len(list(ngrams._pieces(df.toArrow().to_batches()))) == 25


def test_texts_are_weighed_in_pieces():
    """A batch of any size is worked on in parts, whose arrays over all n-grams are what a task holds."""
    seen = []

    def sizes(lists):
        seen.append(len(lists))
        return pa.array([len(x) for x in lists.to_pylist()], pa.int32())

    lists = pa.array([["w"] * (i % 4) for i in range(2500)], pa.list_(pa.string()))
    assert ngrams._in_pieces(lists, sizes).to_pylist() == [i % 4 for i in range(2500)]
    assert seen == [1024, 1024, 452]
    assert len(ngrams._in_pieces(lists.slice(0, 0), sizes)) == 0
