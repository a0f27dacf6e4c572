"""The grid does once what its models have in common."""

from __future__ import annotations

import random

from opinara.operators.features import TermSetting
from opinara.plans import classification as cl


def test_models_that_vote_share_a_search(spark, monkeypatch):
    """One search a term setting and metric; each model votes by the first k of its neighbours."""
    rng = random.Random(11)
    words = ["good", "bad", "fine", "slow", "fast", "app", "chat", "pay"]
    rows = [(f"r{i:03d}", " ".join(rng.choices(words, k=rng.randint(1, 6))), i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "reviewId string, content string, label int")
    train, dev = df.where("reviewId < 'r080'"), df.where("reviewId >= 'r080'")
    models = {
        "one": cl.Knn(1, "euclidean", "uniform"), "seven": cl.Knn(7, "euclidean", "uniform"),
        "near": cl.Knn(3, "euclidean", "distance"), "angle": cl.Knn(4, "cosine", "distance"),
    }
    searched, search = [], cl.nearest_texts

    def counted(queries, base, k, dim, **options):
        searched.append((options["metric"], k))
        return search(queries, base, k, dim, **options)

    terms = {"words": TermSetting((1, 1), (), 20, 1)}
    want = {}
    for name, options in models.items():
        scores, _ = cl.model_grid({"None": train}, dev, models={name: options}, terms=terms)
        want[name] = scores.first()["macro_f1"]
    monkeypatch.setattr(cl, "nearest_texts", counted)
    scores, _ = cl.model_grid({"None": train}, dev, models=models, terms=terms)
    assert {r["model"]: r["macro_f1"] for r in scores.collect()} == want
    assert sorted(searched) == [("cosine", 4), ("euclidean", 7)]
