"""Text-model jobs, sentiment models and topic models."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog import query
from catalog.inputs import labelled, reviews, sql
from catalog.learning import (
    _PRED, _SPLIT, _TOPIC_SQL, LABEL_PROMPT, LABEL_SQL, STAR_PROMPT, TOPIC_PROMPT, _r6, _requests_sql,
)
from catalog.texts import STOP, WORD, _in, sql_clean_letters, sql_words
from opinara.functions.text import clean_letters
from opinara.operators import coherence as co
from opinara.operators import topics as tp
from opinara.operators.balance import stratified_split
from opinara.operators.centroids import fit_clusters
from opinara.operators.features import TermSetting, TfidfVectoriser
from opinara.operators.generate import augment, classify_with_model
from opinara.operators.lda import fit_topics
from opinara.plans import classification as cl
from opinara.session import saved, scratch_path

# Stand-ins for a text model: pure functions of the prompt.


def write_reviews(batch: list[str]) -> list[str]:
    out = []
    for p in batch:
        n, mark = int(re.search(r"Number of texts: (\d+)", p).group(1)), hashlib.md5(p.encode()).hexdigest()[:12]
        parts = [f' "Review {i} written for request {mark}" ' for i in range(n)]
        out.append("Sure, here are the reviews:\n" + "##".join([*parts, "short", *parts[:1]]))
    return out


def judge(batch: list[str]) -> list[str]:
    table_ = {**dict.fromkeys("012345", "0"), **dict.fromkeys("6789", " 1"), **dict.fromkeys("abcd", "2\n")}
    return [table_.get(hashlib.md5(p.encode()).hexdigest()[0], "I am not sure") for p in batch]


@query(
    "b5_augment_apply",
    sql(
        "labelled",
        """select label, content from labelled union all
        select label, 'Review ' || i || ' written for request ' || substr(md5(prompt), 1, 12)
        from prompts, range(5) r(i) where i < n_wanted""",
        **_requests_sql(5, 3, _TOPIC_SQL),
    ),
)
def _(spark, sf):
    df = labelled(spark, sf)
    full = augment(df, "label", "content", write_reviews, TOPIC_PROMPT, classes=[0, 1, 2, 7])
    return full.select("label", "content")


@query(
    "b5_augment_loose",
    sql(
        "labelled",
        """select label, n + lack + (lack + 3) // 4 as n from (select label, n, max(n) over () - n as lack
        from (select label, count(*) as n from labelled group by 1))""",
    ),
)
def _(spark, sf):
    """Class sizes; each request of four texts brings one more than asked for, which the loose form keeps."""
    full = augment(labelled(spark, sf), "label", "content", write_reviews, STAR_PROMPT, strict=False, batch=4, k=2)
    return full.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s9_augmentation_checkpoint",
    sql("labelled", "select label, count(*) as n_requests, cast(sum(n_wanted) as bigint) as n_rows from prompts group by label",
        **_requests_sql(5, 3, _TOPIC_SQL)),
)
def _(spark, sf):
    """A second run over the stored replies asks for nothing and adds nothing."""
    path = scratch_path(spark, "replies")
    args = (labelled(spark, sf), "label", "content", write_reviews, TOPIC_PROMPT, [0, 1, 2, 7])
    augment(*args, path=path)
    augment(*args, path=path)
    stored = spark.read.parquet(path)
    return stored.groupBy("label").agg(F.count(F.lit(1)).alias("n_requests"), F.sum("n_wanted").alias("n_rows"))


_JUDGED = """select content, case when h <= '5' then 0 when h in ('a', 'b', 'c', 'd') then 2 else 1 end as prediction
    from (select content, substr(md5(p), 1, 1) as h from (select content, {p} as p from {rows}))"""


@query(
    "m20_generative_classify",
    sql(
        "reviews",
        _JUDGED.format(
            p=LABEL_SQL,
            rows="(select * from reviews order by md5(reviewId), reviewId limit 100)",
        ),
    ),
)
def _(spark, sf):
    return classify_with_model(reviews(spark, sf), judge, LABEL_PROMPT)


# Sentiment models.

_FEATURES = 7000


def _tables(spark, sf):
    split = saved(stratified_split(labelled(spark, sf)), "split")
    return [split.where(F.col("split") == s).drop("split") for s in ("train", "dev", "test")]


def _vectors(train):
    """(vectoriser, training vectors); the texts are cut into tokens once."""
    blank, tokens = TfidfVectoriser(inputCol="content"), F.col("_tokens")
    rows = saved(train.withColumn("_tokens", blank.tokens()).drop("content"), "train-tokens")
    vectoriser = blank.fit(rows, max_features=_FEATURES, tokens=tokens)
    return vectoriser, cl.training_vectors(rows, vectoriser, tokens=tokens)


def _fitted(spark, sf, kind="LR"):
    train, dev, test = _tables(spark, sf)
    vectoriser, vectors = _vectors(train)
    return cl.train_model(kind, vectors, vectoriser), dev, test


@query("m6_logreg_fit")
def _(spark, sf):
    model, _, _ = _fitted(spark, sf)
    lr = model.pipeline.stages[-1]
    rows = [
        (c, float(lr.interceptVector[c]), float(sum(x * x for x in lr.coefficientMatrix.toArray()[c])))
        for c in range(lr.numClasses)
    ]
    return spark.createDataFrame(rows, "label int, intercept double, squared_norm double")


def _long(rows, id_col, keep):
    """(id, keep..., term_id, weight) of the non-zero entries of packed vectors."""
    pairs = F.explode(F.arrays_zip("vector.indices", "vector.values"))
    return rows.select(id_col, *keep, pairs.alias("p")).select(id_col, *keep, F.col("p.indices").alias("term_id"), F.col("p.values").alias("weight"))


def _coefficients(spark, lr):
    """(class, term_id, coef), with the intercept as term -1."""
    matrix = lr.coefficientMatrix.toArray()
    rows = [(int(c), int(t), float(matrix[c, t])) for c, t in zip(*matrix.nonzero(), strict=True)]
    rows += [(c, -1, float(x)) for c, x in enumerate(lr.interceptVector)]
    return spark.createDataFrame(rows, "class int, term_id int, coef double")


def _margins(rows, coefs, id_col):
    """(id, class, margin): sums of weight times coefficient over a join by term."""
    terms = _long(rows, id_col, []).join(coefs, "term_id").select(id_col, "class", (F.col("weight") * F.col("coef")).alias("x"))
    start = rows.select(id_col).withColumn("term_id", F.lit(-1)).join(coefs, "term_id").select(id_col, "class", F.col("coef").alias("x"))
    return terms.unionByName(start).groupBy(id_col, "class").agg(F.sum("x").alias("margin"))


@query(
    "m6_logreg_stationary",
    sql("labelled", "select label, count(*) as n_rows, true as stationary from split where split = 'train' group by label", **_SPLIT),
)
def _(spark, sf):
    """Whether the gradient of the penalised loss is zero at the fitted coefficients, class by class.

    The loss is convex, so that a zero gradient means the best fit. It is computed by joins and
    sums over the stored coefficients, not by the code that fitted them.
    """
    train, _, _ = _tables(spark, sf)
    vectoriser, vectors = _vectors(train)
    coefs = saved(_coefficients(spark, cl.train_model("LR", vectors, vectoriser, tol=1e-9).pipeline.stages[-1]), "coefficients")
    weight = F.lit(1.0)
    for c, x in cl.CLASS_WEIGHTS.items():
        weight = F.when(F.col("label") == c, x).otherwise(weight)
    margins = _margins(vectors, coefs, "row_id")
    whole = F.sum(F.exp("margin")).over(Window.partitionBy("row_id"))
    share = margins.select("row_id", "class", (F.exp("margin") / whole).alias("p")).join(vectors.select("row_id", "label"), "row_id")
    error = saved(share.select("row_id", "class", (weight * (F.col("p") - (F.col("label") == F.col("class")).cast("int"))).alias("e")), "errors")
    slopes = _long(vectors, "row_id", []).join(error, "row_id").groupBy("class", "term_id").agg(F.sum(F.col("weight") * F.col("e")).alias("g"))
    slopes = slopes.unionByName(error.groupBy("class").agg(F.sum("e").alias("g")).withColumn("term_id", F.lit(-1)))
    # Loss = sum of weighted log losses + |coefficients|^2 / (2 C); intercepts are not penalised.
    penalty = F.when(F.col("term_id") >= 0, F.coalesce("coef", F.lit(0.0)) / 0.5).otherwise(0.0)
    flat = slopes.join(coefs, ["class", "term_id"], "full").select(F.col("class").alias("label"), (F.coalesce("g", F.lit(0.0)) + penalty).alias("g"))
    worst = flat.groupBy("label").agg(F.max(F.abs("g")).alias("g"))
    sizes = vectors.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.max("label").alias("c"))
    # A gradient of a ten-thousandth for each row of a class, where a wrong fit has tenths.
    return sizes.join(worst, "label").select("label", "n_rows", (F.col("g") <= F.col("n_rows") * 1e-4).alias("stationary"))


@query(
    "m7_predict_margins",
    sql("labelled", "select reviewId, label, true as agrees from split where split = 'test'", **_SPLIT),
)
def _(spark, sf):
    """Whether every prediction has the largest margin, with margins summed over a join by term."""
    model, _, test = _fitted(spark, sf)
    vectoriser, lr = model.pipeline.stages
    found = saved(model.predict(test).select("reviewId", "label", "prediction"), "predictions")
    margins = _margins(vectoriser.weights(test, "vector"), _coefficients(spark, lr), "reviewId")
    top = margins.groupBy("reviewId").agg(F.max("margin").alias("top"), F.max_by("class", "margin").alias("first"))
    mine = found.join(top, "reviewId").join(margins.withColumnRenamed("class", "prediction"), ["reviewId", "prediction"])
    return mine.select("reviewId", "label", (F.col("margin") >= F.col("top") - 1e-9).alias("agrees"))


@query("m7_predict")
def _(spark, sf):
    model, _, test = _fitted(spark, sf)
    return model.predict(test).select("reviewId", "label", "prediction")


@query("s10_model_sink", sql("labelled", "select count(*) as n_rows, 0 as n_changed from split where split = 'dev'", **_SPLIT))
def _(spark, sf):
    model, dev, _ = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    model.save(path)
    again = cl.load_model(spark, path, "LR").predict(dev).select("reviewId", F.col("prediction").alias("again"))
    both = model.predict(dev).select("reviewId", "prediction").join(again, "reviewId")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("prediction") != F.col("again")).cast("int").alias("n_changed")
    )


@query("m10_model_grid")
def _(spark, sf):
    train, dev, _ = _tables(spark, sf)
    richer = saved(
        augment(train, "label", "content", write_reviews, TOPIC_PROMPT, classes=[0, 1]), "train-augmented"
    )
    scores, _ = cl.model_grid({"None": train, "IA": richer, "SMOTE": train}, dev, max_features=_FEATURES)
    return scores.drop("terms")


# Two term settings and two ways to vote, away from the defaults, scored in SQL as well.

_TERMS = {
    "short": TermSetting((1, 2), tuple(STOP), 400, 0.01),
    "pairs": TermSetting((2, 3), (), 300, 3),
}
_VOTES = {"uniform": cl.Knn(7, "euclidean", "uniform"), "near": cl.Knn(3, "euclidean", "distance")}


def _setting_sql(name: str, setting: TermSetting) -> dict[str, str]:
    """Distances between dev and train rows under a term setting."""
    low, high = setting.ngram_range
    toks = f"regexp_extract_all({sql_clean_letters('content')}, '{WORD}{{2,}}')"
    if setting.stop_words:
        toks = f"list_filter({toks}, lambda x: x not in {_in(setting.stop_words)})"
    gram = ["tok", "tok || ' ' || n1", "tok || ' ' || n1 || ' ' || n2"]
    whole = ["tok", "n1", "n2"]
    parts = [f"select reviewId, split, {gram[n - 1]} as term from flat_{name} where {whole[n - 1]} is not null" for n in range(low, high + 1)]
    n_docs = "(select count(*) from split where split = 'train')"
    least = f"{setting.min_df}::double * {n_docs}" if isinstance(setting.min_df, float) else str(setting.min_df)
    return {
        f"flat_{name}": f"""select reviewId, split, tok, lead(tok) over w as n1, lead(tok, 2) over w as n2 from (
            select reviewId, split, unnest(toks) as tok, unnest(range(len(toks))) as pos from (
            select reviewId, split, {toks} as toks from split where split <> 'test'))
            window w as (partition by reviewId order by pos)""",
        f"tf_{name}": f"select reviewId, split, term, count(*) as tf from ({' union all '.join(parts)}) group by all",
        f"vocab_{name}": f"""select term, ln((1 + {n_docs})::double / (1 + count(*))::double) + 1.0::double as idf
            from tf_{name} where split = 'train' group by term having count(*) >= {least}
            order by sum(tf) desc, term limit {setting.max_features}""",
        f"w_{name}": f"""select reviewId, split, term, w / sqrt(sum(w * w) over (partition by reviewId)) as w from (
            select reviewId, split, term, (1 + ln(tf)) * idf as w from tf_{name} join vocab_{name} using (term))""",
        f"sims_{name}": f"""select q.reviewId as qid, b.reviewId as bid, sum(q.w * b.w) as s from w_{name} q join w_{name} b
            using (term) where q.split = 'dev' and b.split = 'train' group by all""",
        f"far_{name}": f"""select q.reviewId, q.label as truth, b.reviewId as neighbour, b.label, cast(
            case when q.reviewId not in (select reviewId from w_{name}) and b.reviewId not in (select reviewId from w_{name}) then 0
            when q.reviewId not in (select reviewId from w_{name}) or b.reviewId not in (select reviewId from w_{name}) then 1e9
            else 2 * floor((1 - coalesce(s, 0.0::double)) * 1e9 + 0.5) end as bigint) as d
            from (select * from split where split = 'dev') q cross join (select * from split where split = 'train') b
            left join sims_{name} on qid = q.reviewId and bid = b.reviewId""",
    }


def _vote_sql(terms: str, name: str, votes: cl.Knn) -> dict[str, str]:
    weight = "1.0::double"
    if votes.weights == "distance":
        weight = """case when nearest = 0 then case when d = 0 then 1.0::double else 0.0::double end
            else sqrt(1e9::double / d) end"""
    key = f"{terms}_{name}"
    return {
        f"top_{key}": f"""select *, min(d) over (partition by reviewId) as nearest from (select *, row_number() over (
            partition by reviewId order by d, neighbour) as rn from far_{terms}) where rn <= {votes.k}""",
        f"pred_{key}": f"""select truth as label, label as prediction from (select *, row_number() over (
            partition by reviewId order by s desc, label) as r from (select reviewId, truth, label,
            floor(sum({weight}) * 1000 + 0.5) as s from top_{key} group by all)) where r = 1""",
        f"per_{key}": _PRED["per"].replace("from pred", f"from pred_{key}"),
        f"scores_{key}": _PRED["scores"].replace("from per", f"from per_{key}"),
        f"f1_{key}": f"select '{terms}' as terms, '{name}' as model, {_r6('avg(f1)')} as macro_f1 from scores_{key}",
    }


_GRID = {k: v for t, setting in _TERMS.items() for k, v in _setting_sql(t, setting).items()}
_GRID |= {k: v for t in _TERMS for n, votes in _VOTES.items() for k, v in _vote_sql(t, n, votes).items()}
_GRID_ROWS = " union all ".join(f"select * from f1_{t}_{n}" for t in _TERMS for n in _VOTES)


@query(
    "m10_grid_settings",
    sql(
        "labelled",
        "select 'None' as strategy, *, macro_f1 = max(macro_f1) over () as best from grid",
        **_SPLIT, **_GRID, grid=_GRID_ROWS,
    ),
)
def _(spark, sf):
    """Every row that reaches the best score is marked, so that ties do not depend on the order of trial."""
    train, dev, _ = _tables(spark, sf)
    scores, _ = cl.model_grid({"None": train}, dev, models=_VOTES, terms=_TERMS)
    return scores.withColumn("best", F.col("macro_f1") == F.max("macro_f1").over(Window.partitionBy()))


@query("m11_holdout_eval")
def _(spark, sf):
    model, _, test = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    model.save(path)
    return cl.holdout_eval(spark, path, "LR", test)


@query(
    "m11_holdout_recount",
    sql(
        "labelled",
        """select cast(label as varchar) as "row", count(*) as support, true as equal from split where split = 'test' group by 1
        union all select 'accuracy', count(*), true from split where split = 'test'""",
        **_SPLIT,
    ),
)
def _(spark, sf):
    """Report of the stored model against F1 and accuracy counted from the predictions of the model at hand."""
    model, _, test = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    model.save(path)
    report = cl.holdout_eval(spark, path, "LR", test)
    found = saved(model.predict(test).select("label", "prediction"), "predictions")
    hit = F.count_if(F.col("label") == F.col("prediction"))
    true = found.groupBy(F.col("label").alias("c")).agg(F.count(F.lit(1)).alias("n"), hit.alias("tp"))
    said = found.groupBy(F.col("prediction").alias("c")).agg(F.count(F.lit(1)).alias("m"))
    f1 = true.join(said, "c", "left").select(F.col("c").cast("string").alias("row"), (2 * F.col("tp") / (F.col("n") + F.coalesce("m", F.lit(0)))).alias("again"))
    right = found.agg((hit / F.count(F.lit(1))).alias("again")).select(F.lit("accuracy").alias("row"), "again")
    both = report.join(f1.unionByName(right), "row")
    return both.select("row", "support", (F.abs(F.col("f1") - F.col("again")) < 1e-6).alias("equal"))


# Topics.


@query(
    "j5_topic_name_lookup",
    sql(
        "reviews",
        "select reviewId, name as Tema_Nombre from (select *, cast(substr(reviewId, 2) as bigint) % 5 as c from reviews) "
        "left join (values " + ", ".join(
            f"('{s}', {i}, '{n}')" for s, names in tp.TOPIC_NAMES.items() for i, n in enumerate(names)
        ) + ") t(s, k, name) on s = sentiment and k = c",
    ),
)
def _(spark, sf):
    df = reviews(spark, sf).withColumn("cluster", (F.substring("reviewId", 2, 30).cast("bigint") % 5).cast("int"))
    return tp.name_topics(df, tp.topic_names(spark)).select("reviewId", "Tema_Nombre")


_PROBS = [f"content_length * {7 + 4 * i} % {11 + i}" for i in range(4)]


@query(
    "w5_dominant_topic",
    sql("reviews", f"select reviewId, cast(list_position(p, list_max(p)) - 1 as int) as topic "
        f"from (select reviewId, [{', '.join(_PROBS)}] as p from reviews)"),
)
def _(spark, sf):
    p = F.array(*[F.expr(e) for e in _PROBS])
    return reviews(spark, sf).select("reviewId", tp.dominant_topic(p).alias("topic"))


@query(
    "m18_hybrid_topic",
    sql(
        "reviews",
        """select reviewId, case when word_count > 100 then score else content_length % 4 end as cluster,
        case when word_count > 100 then 'LDA' else 'K-Means' end as model from reviews""",
    ),
)
def _(spark, sf):
    cluster, used = tp.hybrid_topic(F.col("word_count"), F.col("score"), F.col("content_length") % 4, threshold=100)
    return reviews(spark, sf).select("reviewId", cluster.alias("cluster"), used.alias("model"))


def _topic_texts(spark, sf):
    return reviews(spark, sf).withColumn("texto_limpio", clean_letters(F.col("content")))


_SEGMENTS = [(a, s) for a in ("AppA", "AppB") for s in ("negative", "neutral", "positive")]


_KEYS = ["app", "sentiment"]


def _segment_texts(spark, sf):
    return _topic_texts(spark, sf).select("reviewId", *_KEYS, "texto_limpio")


def _segment_rows(spark, sf):
    """The reviews of all segments with their words; written once."""
    return saved(_segment_texts(spark, sf).withColumn("tokens", F.split("texto_limpio", " ")), "segments")


def _clusters(spark, sf, ks, n_init=10):
    texts = saved(_segment_texts(spark, sf), "segment-texts")
    features, _ = tp.segment_features(texts, "texto_limpio", _KEYS, stop_words=STOP)
    features = saved(features.select("reviewId", *_KEYS, "features"), "features")
    return features, fit_clusters(features, "reviewId", 1000, _KEYS, ks, n_init)


def _distances(spark, features, models, ks):
    """(reviewId, keys, k, cluster, d): squared distance of each review to every centroid of the best models."""
    cells, norms = [], []
    for s in sorted({key[0] for key in models.centroids}):
        for k in ks:
            for c, v in enumerate(models.centroids[models.best(s, k)]):
                norms.append((*s, k, c, float(v @ v)))
                cells += [(*s, k, c, i, float(v[i])) for i in v.nonzero()[0].tolist()]
    table_ = spark.createDataFrame(cells, "app string, sentiment string, k int, cluster int, i int, v double")
    centres = spark.createDataFrame(norms, "app string, sentiment string, k int, cluster int, cc double")
    long = features.select("reviewId", *_KEYS, F.explode(F.arrays_zip("features.indices", "features.values")).alias("f"))
    long = long.select("reviewId", *_KEYS, F.col("f.indices").alias("i"), F.col("f.values").alias("x"))
    dots = long.join(F.broadcast(table_), [*_KEYS, "i"]).groupBy("reviewId", *_KEYS, "k", "cluster").agg(F.sum(F.col("x") * F.col("v")).alias("xc"))
    squares = F.aggregate("features.values", F.lit(0.0), lambda a, x: a + x * x)
    every = features.select("reviewId", *_KEYS, squares.alias("xx")).join(F.broadcast(centres), _KEYS)
    joined = every.join(dots, ["reviewId", *_KEYS, "k", "cluster"], "left")
    return joined.withColumn("d", F.col("xx") + F.col("cc") - 2 * F.coalesce("xc", F.lit(0.0)))


@query("m12_kmeans_assign")
def _(spark, sf):
    features, models = _clusters(spark, sf, [4])
    return features.select("reviewId", *_KEYS, models.assign(F.col("features"), 4).alias("kmeans_cluster"))


@query("m12_kmeans_nearest", sql("reviews", "select reviewId, app, sentiment, true as nearest from reviews"))
def _(spark, sf):
    """Every review is in the cluster whose centroid is nearest by distances computed term by term."""
    features, models = _clusters(spark, sf, [4])
    given = features.select("reviewId", *_KEYS, models.assign(F.col("features"), 4).alias("given"))
    d = _distances(spark, features, models, [4]).join(given, ["reviewId", *_KEYS])
    own = F.min(F.when(F.col("cluster") == F.col("given"), F.col("d")))
    return d.groupBy("reviewId", *_KEYS).agg((own <= F.min("d") + 1e-9).alias("nearest"))


_ELBOW = range(2, 8)


@query("m13_elbow_sweep")
def _(spark, sf):
    _, models = _clusters(spark, sf, _ELBOW)
    return spark.createDataFrame(models.elbow(), "app string, sentiment string, k int, inertia double")


@query(
    "m13_elbow_adds_up",
    sql("reviews", """select app, sentiment, cast(k as int) as k, count(*) as n_reviews, 10 as n_starts, true as adds_up,
        true as least from reviews, range(2, 8) r(k) group by all"""),
)
def _(spark, sf):
    """The inertia is the sum of the reviews' distances to their nearest centroid, and that of the best start."""
    features, models = _clusters(spark, sf, _ELBOW)
    near = _distances(spark, features, models, _ELBOW).groupBy("reviewId", *_KEYS, "k").agg(F.min("d").alias("d"))
    rows = []
    for *s, k, inertia in models.elbow():
        starts = [v for key, v in models.inertia.items() if key[:2] == (tuple(s), k)]
        rows.append((*s, k, inertia, len(starts), min(starts)))
    swept = spark.createDataFrame(rows, "app string, sentiment string, k int, inertia double, n_starts int, low double")
    sums = near.groupBy(*_KEYS, "k").agg(F.count(F.lit(1)).alias("n_reviews"), F.sum("d").alias("d"))
    return sums.join(swept, [*_KEYS, "k"]).select(
        *_KEYS, "k", "n_reviews", "n_starts", (F.abs(F.col("d") - F.col("inertia")) <= 1e-6 * F.col("d") + 1e-6).alias("adds_up"),
        (F.col("inertia") <= F.col("low")).alias("least"),
    )


def _topic_models(spark, sf, ks=(4,), passes=10):
    rows = _segment_rows(spark, sf)
    return rows, fit_topics(rows, "tokens", "reviewId", _KEYS, ks, passes)


@query("m14_lda_fit")
def _(spark, sf):
    _, models = _topic_models(spark, sf)
    return models.top_words(10).select(*_KEYS, "topic", "rank", "word")


@query(
    "m14_lda_vocabulary",
    sql(
        "reviews",
        f"""select app, sentiment, t as topic, cast(least(10, count(distinct w)) as bigint) as n_words, true as in_segment,
        true as falls, true as adds_up from (select app, sentiment, unnest(string_split({sql_clean_letters("content")}, ' ')) as w from reviews),
        range(4) r(t) group by app, sentiment, t""".replace("t as topic", "cast(t as int) as topic"),
    ),
)
def _(spark, sf):
    """Each topic: its words are those of its segment, weights fall, and all word weights add up to one."""
    rows, models = _topic_models(spark, sf)
    words = saved(models.top_words(10), "topic-words")
    own = rows.select(*_KEYS, F.explode("tokens").alias("word")).distinct().withColumn("own", F.lit(True))
    whole = models.top_words(1 << 30).groupBy(*_KEYS, "topic").agg(F.sum("weight").alias("total"))
    listed = words.join(own, [*_KEYS, "word"], "left").groupBy(*_KEYS, "topic").agg(
        F.count_distinct("word").alias("n_words"), F.bool_and(F.coalesce("own", F.lit(False))).alias("in_segment"),
        F.sort_array(F.collect_list(F.struct("rank", "weight")))["weight"].alias("w"),
    )
    falls = F.forall(F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))), lambda i: F.coalesce(F.get("w", i) <= F.get("w", i - 1), F.lit(True)))
    return listed.join(whole, [*_KEYS, "topic"]).select(
        *_KEYS, "topic", "n_words", "in_segment", falls.alias("falls"), (F.abs(F.col("total") - 1) < 1e-9).alias("adds_up")
    )


@query(
    "m15_topic_probabilities",
    sql("reviews", "select reviewId, app, sentiment, 4 as n_topics, true as adds_up, true as non_negative from reviews"),
)
def _(spark, sf):
    """Every review has four probabilities, none negative, that add up to one."""
    rows, models = _topic_models(spark, sf)
    total = F.aggregate("lda_probs", F.lit(0.0), lambda x, y: x + y)
    return tp.with_topic_probabilities(rows, models).select(
        "reviewId", *_KEYS, F.size("lda_probs").alias("n_topics"),
        (F.abs(total - 1) < 1e-6).alias("adds_up"), F.forall("lda_probs", lambda x: x >= 0).alias("non_negative"),
    )


_TOPIC_WORDS = [["the", "and", "of", "onin", "ering"], ["la", "le", "les", "du", "en"]]


def _tokens(spark, sf):
    return reviews(spark, sf).select(F.regexp_extract_all(F.lower("content"), F.lit(WORD + "+"), F.lit(0)).alias("tokens"))


_COHERENCE = {
    "words": "select * from (values " + ", ".join(
        f"({t}, {i}, '{w}')" for t, ws in enumerate(_TOPIC_WORDS) for i, w in enumerate(ws)
    ) + ") v(topic, i, w)",
    "docs": f"select reviewId, toks, len(toks) as len from (select reviewId, {sql_words('content')} as toks from reviews)",
    "occ": f"""select * from (select reviewId, len, unnest(toks) as w, unnest(range(len)) as p from docs)
        where w in {_in([w for t in _TOPIC_WORDS for w in t])}""",
}
_JOINT = """select a.topic, a.i, b.i as j, ni.n as n_i, nj.n as n_j, coalesce(n.n, 0) as n_ij
    from words a join words b using (topic) left join co n on n.a = a.w and n.b = b.w
    left join co ni on ni.a = a.w and ni.b = a.w left join co nj on nj.a = b.w and nj.b = b.w"""


@query(
    "m16_coherence_cv",
    sql(
        "reviews",
        """select topic, cast(floor(avg(cos) * 1e6 + 0.5) as bigint) as coherence_micro from (
        select topic, i, sum(v * s) / sqrt(sum(v * v) * sum(s * s)) as cos from npmi
        join (select topic, j, sum(v) as s from npmi group by all) using (topic, j) group by topic, i) group by topic""",
        **_COHERENCE,
        win="""select distinct reviewId, w, unnest(range(greatest(0, p - 109), least(p, greatest(len - 110, 0)) + 1)) as s
            from occ""",
        co="select a.w as a, b.w as b, count(*) as n from win a join win b using (reviewId, s) group by all",
        total="""select sum(greatest(1, len - 109))::double as t from (select distinct reviewId, len from occ)""",
        joint=_JOINT,
        npmi="""select topic, i, j, case when n_i > 0 and n_j > 0 then
            ln((n_ij / t + 1e-12) / (n_i / t * (n_j / t))) / -ln(n_ij / t + 1e-12) else 0.0 end as v from joint, total""",
    ),
)
def _(spark, sf):
    c = co.coherence_cv(_tokens(spark, sf), _TOPIC_WORDS)
    return c.select("topic", F.floor(F.col("coherence") * 1e6 + 0.5).alias("coherence_micro"))


@query(
    "m17_coherence_umass",
    sql(
        "reviews",
        """select topic, cast(floor(avg(ln((n_ij + 1.0::double) / n_j)) * 1e6 + 0.5) as bigint) as coherence_micro
        from joint where j < i and n_j > 0 group by topic""",
        **_COHERENCE,
        pres="select distinct reviewId, w from occ",
        co="select a.w as a, b.w as b, count(*) as n from pres a join pres b using (reviewId) group by all",
        joint=_JOINT,
    ),
)
def _(spark, sf):
    c = co.coherence_umass(_tokens(spark, sf), _TOPIC_WORDS)
    return c.select("topic", F.floor(F.col("coherence") * 1e6 + 0.5).alias("coherence_micro"))


@query("m16_coherence_cv_sweep")
def _(spark, sf):
    """Mean c_v of the LDA topics for k = 2 .. 6 in every segment."""
    rows, models = _topic_models(spark, sf, range(2, 7), passes=5)
    topics = saved(models.top_words(20).select(*_KEYS, "k", "topic", F.col("rank").alias("i"), F.col("word").alias("w")), "topics")
    found = co.coherence_sweep(rows, topics, _KEYS, ["k"])
    return found.groupBy(*_KEYS, "k").agg(F.avg("coherence").alias("coherence"))


_RANKED = 5


@query(
    "m16_coherence_cv_ranked",
    sql(
        "reviews",
        """select app, sentiment, k, cast(floor(avg(c) * 1e6 + 0.5) as bigint) as coherence_micro from (
        select app, sentiment, k, topic, avg(case when vv * ss > 0 then vs / sqrt(vv * ss) else 0.0 end) as c from (
        select app, sentiment, k, topic, i, sum(v * s) as vs, sum(v * v) as vv, sum(s * s) as ss from npmi
        join (select app, sentiment, k, topic, j, sum(v) as s from npmi group by all) using (app, sentiment, k, topic, j)
        group by all) group by all) group by all""",
        docs=f"select reviewId, app, sentiment, toks, len(toks) as len from (select reviewId, app, sentiment, "
        f"string_split({sql_clean_letters('content')}, ' ') as toks from reviews)",
        flat="select reviewId, app, sentiment, len, unnest(toks) as w, unnest(range(len)) as p from docs",
        ranks="""select app, sentiment, w, row_number() over (partition by app, sentiment order by n desc, w) - 1 as r
            from (select app, sentiment, w, count(*) as n from flat group by all)""",
        topics=f"select app, sentiment, cast(k as int) as k, cast(r % k as int) as topic, r // k as i, w from ranks, range(2, 7) t(k) where r < {_RANKED} * k",
        occ=f"select reviewId, app, sentiment, len, p, w, r from flat join ranks using (app, sentiment, w) where r < {_RANKED * 6}",
        win="""select distinct reviewId, app, sentiment, w, unnest(range(greatest(0, p - 109), least(p, greatest(len - 110, 0)) + 1)) as s
            from occ""",
        co="""select a.app, a.sentiment, a.w as a, b.w as b, count(*) as n from win a join win b using (reviewId, s) group by all""",
        total=f"""select app, sentiment, k, sum(greatest(1, len - 109))::double as t from (
            select distinct reviewId, app, sentiment, len, k from occ, range(2, 7) t(k) where r < {_RANKED} * k) group by all""",
        joint="""select a.app, a.sentiment, a.k, a.topic, a.i, b.i as j, ni.n as n_i, nj.n as n_j, coalesce(n.n, 0) as n_ij
            from topics a join topics b using (app, sentiment, k, topic)
            left join co n on n.app = a.app and n.sentiment = a.sentiment and n.a = a.w and n.b = b.w
            left join co ni on ni.app = a.app and ni.sentiment = a.sentiment and ni.a = a.w and ni.b = a.w
            left join co nj on nj.app = a.app and nj.sentiment = a.sentiment and nj.a = b.w and nj.b = b.w""",
        npmi="""select app, sentiment, k, topic, i, j, case when n_i > 0 and n_j > 0 then
            ln((n_ij / t + 1e-12) / (n_i / t * (n_j / t))) / -ln(n_ij / t + 1e-12) else 0.0 end as v
            from joint join total using (app, sentiment, k)""",
    ),
)
def _(spark, sf):
    """The sweep with each segment's most frequent words dealt out to k topics, k = 2 .. 6."""
    rows = _segment_rows(spark, sf)
    counts = rows.select(*_KEYS, F.explode("tokens").alias("w")).groupBy(*_KEYS, "w").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*_KEYS).orderBy(F.desc("n"), "w")
    ranked = counts.withColumn("r", F.row_number().over(order) - 1).where(F.col("r") < _RANKED * 6)
    topics = ranked.select(*_KEYS, "w", "r", F.explode(F.array(*[F.lit(k) for k in range(2, 7)])).alias("k")).where(F.col("r") < _RANKED * F.col("k"))
    topics = saved(topics.select(*_KEYS, "k", (F.col("r") % F.col("k")).alias("topic"), F.floor(F.col("r") / F.col("k")).alias("i"), "w"), "topics")
    found = co.coherence_sweep(rows, topics, _KEYS, ["k"])
    return found.groupBy(*_KEYS, "k").agg(F.floor(F.avg("coherence") * 1e6 + 0.5).alias("coherence_micro"))


def _topic_table(spark, sf):
    texts = _topic_texts(spark, sf).drop("country", "city")
    return tp.topic_table(texts, _SEGMENTS, tp.topic_names(spark), stop_words=STOP).withColumn("date", F.col("date").cast("string"))


@query("m19_topic_table")
def _(spark, sf):
    return _topic_table(spark, sf)


_WORDS_SQL = f"list_filter(string_split({sql_clean_letters('content')}, ' '), lambda x: x <> '')"


@query(
    "m19_topic_columns",
    sql(
        "reviews",
        f"""select reviewId, app, sentiment as sentimiento_analisis, content, score, cast(date as varchar) as date, len(ws) as num_palabras,
        len(ws) as Longitud, case when len(ws) > 10 then 'LDA' else 'K-Means' end as Modelo, array_to_string(ws[1:8], ', ') as Palabras_Clave,
        true as adds_up, true as argmax, true as named from (select *, {_WORDS_SQL} as ws from reviews)""",
    ),
)
def _(spark, sf):
    """The topic table with what the models decide replaced by the rules that it has to follow."""
    probs = F.array(*[F.col(f"Prob_Topico_{i}") for i in range(4)])
    names = tp.topic_names(spark).select(F.col("sentiment").alias("s"), F.col("cluster").alias("c"), "name")
    rows = _topic_table(spark, sf)
    rows = rows.join(names, (F.col("s") == F.col("sentimiento_analisis")) & (F.col("c") == F.col("Cluster_Dominante")), "left")
    best = F.get(probs, F.col("Cluster_Dominante")) == F.array_max(probs)
    return rows.select(
        "reviewId", "app", "sentimiento_analisis", "content", "score", "date", "num_palabras", "Longitud", "Modelo", "Palabras_Clave",
        (F.abs(F.aggregate(probs, F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).alias("adds_up"),
        F.when(F.col("Modelo") == "LDA", best).otherwise(F.col("Cluster_Dominante").between(0, 3)).alias("argmax"),
        F.col("Tema_Nombre").eqNullSafe(F.col("name")).alias("named"),
    )
