"""The multi-step jobs end to end on the smallest tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import inputs
from catalog.texts import EMOJI, STOP, _lexicon
from opinara.operators import topics
from opinara.operators.balance import stratified_split
from opinara.plans import classification as cl
from opinara.plans.dashboards import build_dashboards
from opinara.plans.voices import normalise_texts, topic_report
from opinara.session import saved

SF = "/root/testdata/sf0.001"
SEGMENTS = [("AppA", "positive"), ("AppB", "negative"), ("AppC", "positive")]


def test_dashboards(spark, tmp_path):
    out = str(tmp_path / "dash")
    names = build_dashboards(inputs.raw(spark, SF), inputs.countries(spark, SF), out, "AppA", "AppB")
    assert len(names) == 23
    summary = spark.read.option("header", True).csv(f"{out}/score_summary")
    assert summary.columns == ["app", "mean", "median", "std", "count"] and summary.count() == 2
    plan = spark.read.parquet(f"{out}/reviews_geo").where("app = 'AppA'").select("score")
    assert "PartitionFilters: [isnotnull(app" in plan._jdf.queryExecution().executedPlan().toString()


def test_texts_to_topics(spark):
    df = inputs.reviews(spark, SF)
    texts, vocab = normalise_texts(df, _lexicon(spark, SF), STOP, EMOJI, min_count=2, threshold=1.0)
    texts = texts.cache()
    assert 0 < texts.count() <= df.count() and set(vocab.columns) == {"term", "df"}
    assert texts.where(F.col("text_final").contains("_")).count() > 0
    table, words = topic_report(
        texts.drop("country"), SEGMENTS, topics.topic_names(spark), n_init=1, passes=1, threshold=150
    )
    rows = table.collect()
    assert {(r["app"], r["sentimiento_analisis"]) for r in rows} == set(SEGMENTS[:2])
    for r in rows:
        probs = [r[f"Prob_Topico_{i}"] for i in range(4)]
        assert abs(sum(probs) - 1) < 1e-6
        assert r["Modelo"] == ("LDA" if r["num_palabras"] > 150 else "K-Means")
        if r["Modelo"] == "LDA":
            assert r["Cluster_Dominante"] == probs.index(max(probs))
        assert r["Tema_Nombre"] == topics.TOPIC_NAMES[r["sentimiento_analisis"]][r["Cluster_Dominante"]]
    assert {"LDA", "K-Means"} == {r["Modelo"] for r in rows}
    per = words.groupBy("app", "sentimiento_analisis", "Tema_Nombre").count().collect()
    assert per and max(r["count"] for r in per) <= 50


def test_models(spark, tmp_path):
    split = saved(stratified_split(inputs.labelled(spark, SF)), "split")
    train, dev = (split.where(F.col("split") == s).drop("split") for s in ("train", "dev"))
    scores, best = cl.model_grid({"None": train, "SMOTE": train}, dev, max_features=300)
    rows = scores.collect()
    assert [(r["strategy"], r["model"]) for r in rows] == [
        ("None", "KNN"), ("None", "LR"), ("SMOTE", "KNN"), ("SMOTE", "LR")
    ]
    top = max(r["macro_f1"] for r in rows)
    assert next(r for r in rows if r["macro_f1"] == top)["best"]
    path = str(tmp_path / "best")
    best.save(path)
    before = {(r["reviewId"], r["prediction"]) for r in best.predict(dev).collect()}
    again = cl.load_model(spark, path, best.kind)
    assert {(r["reviewId"], r["prediction"]) for r in again.predict(dev).collect()} == before
    assert {p for _, p in before} <= {0, 1, 2} and len(before) == dev.count()
    report = {r["row"]: r for r in cl.holdout_eval(spark, path, best.kind, dev).collect()}
    assert report["accuracy"]["support"] == dev.count()


def test_weights_move_the_decision(spark):
    """A heavier class weight never lowers that class's predictions."""
    df = spark.createDataFrame(
        [(f"r{i}", "bad app" if i % 3 else "good app", 0 if i % 2 else 2) for i in range(60)], "reviewId string, content string, label int"
    )
    v = cl.TfidfVectoriser(inputCol="content", ngramRange=[1, 1]).fit(df, max_features=10)
    rows = cl.training_vectors(df, v)

    def zeros(weights):
        return cl.train_model("LR", rows, v, class_weights=weights).predict(df).where("prediction = 0").count()

    assert zeros({0: 5.0, 2: 0.2}) >= zeros({0: 0.2, 2: 5.0})
