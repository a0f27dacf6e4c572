"""Nearest neighbours and synthetic oversampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.inputs import labelled, sql, table
from catalog.learning import _SPLIT, _gram_ctes, _vocab_cte
from catalog.texts import sql_clean_letters
from opinara.operators.balance import stratified_split
from opinara.operators.features import TfidfVectoriser
from opinara.operators.neighbours import knn_classify, nearest, smote
from opinara.operators.text_neighbours import nearest_texts
from opinara.operators.topics import assign_to_centroids
from opinara.session import saved

_DENSE = {
    "vec": "select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings",
    "test": "select * from vec where vec_id % 10 >= 7",
    "train": "select * from vec where vec_id % 10 < 7",
    "pairs": """select q.vec_id, b.vec_id as neighbour, b.label, cast(floor((1 - list_dot_product(q.v, b.v)
        / sqrt(list_dot_product(q.v, q.v) * list_dot_product(b.v, b.v))) * 1e9 + 0.5) as bigint) as dist_nano
        from test q, train b""",
}

_TOP = {
    "top": """select *, cast(rn as int) as "rank" from (select *, row_number() over (partition by {id}
        order by dist_nano, neighbour) as rn from pairs) where rn <= 5""",
    "votes": """select {id}, label, cast(floor(sum(case when nearest = 0 then case when dist_nano = 0 then 1.0::double
        else 0.0::double end else 1e9::double / dist_nano end) * 1000 + 0.5) as bigint) as s
        from (select *, min(dist_nano) over (partition by {id}) as nearest from top) group by all""",
}
_PREDICT = """select {id}, label as prediction from (select *, row_number() over (partition by {id}
    order by s desc, label) as r from votes) where r = 1"""


def _top(id_col: str) -> dict[str, str]:
    return {k: v.format(id=id_col) for k, v in _TOP.items()}


def _vectors(spark, sf):
    return table(spark, sf, "embeddings")


@query(
    "m5_nearest",
    sql("", """select vec_id, neighbour, label, dist_nano, "rank" from top""", **_DENSE, **_top("vec_id")),
)
def _(spark, sf):
    v = _vectors(spark, sf)
    found = nearest(
        v.where("vec_id % 10 >= 7"), v.where("vec_id % 10 < 7").withColumnRenamed("vec_id", "neighbour"), 5, 64,
        query_id="vec_id", base_id="neighbour", vector="embedding", carry=["label"],
    )
    return found


@query("m5_knn_classify", sql("", _PREDICT.format(id="vec_id"), **_DENSE, **_top("vec_id")))
def _(spark, sf):
    v = _vectors(spark, sf)
    return knn_classify(
        v.where("vec_id % 10 >= 7"), v.where("vec_id % 10 < 7"), 64, "vec_id", "label", vector="embedding",
        cell_rows=128, block_rows=64, query_rows=64,
    )


_TEXT = {
    **_SPLIT,
    "train": "select * from split where split = 'train'",
    **_gram_ctes("train", sql_clean_letters("content")),
    "vocab": _vocab_cte(7000),
    **{f"test_{k}": v.replace("flat", "test_flat").replace("docs", "test_docs").replace("grams", "test_grams")
       for k, v in _gram_ctes("(select * from split where split = 'test')", sql_clean_letters("content")).items()},
    "w": """select reviewId, term, w / sqrt(sum(w * w) over (partition by reviewId)) as w from (
        select reviewId, term, (1 + ln(tf)) * idf as w from tf join vocab using (term))""",
    "tw": """select reviewId, term, w / sqrt(sum(w * w) over (partition by reviewId)) as w from (
        select reviewId, term, (1 + ln(tf)) * idf as w from test_tf join vocab using (term))""",
    "sims": """select q.reviewId as qid, b.reviewId as bid, sum(q.w * b.w) as s from tw q join w b using (term)
        group by all""",
    "pairs": """select q.reviewId as reviewId, b.reviewId as neighbour, b.label,
        cast(floor((1 - coalesce(s, 0.0::double)) * 1e9 + 0.5) as bigint) as dist_nano
        from (select * from split where split = 'test') q cross join train b
        left join sims on qid = q.reviewId and bid = b.reviewId""",
}


@query("m5_knn_text", sql("labelled", _PREDICT.format(id="reviewId"), **_TEXT, **_top("reviewId")))
def _(spark, sf):
    split = saved(stratified_split(labelled(spark, sf)), "split")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    model = TfidfVectoriser(inputCol="content").fit(train, max_features=7000)
    return knn_classify(
        model.weights(test, "vector"), model.weights(train, "vector"), 7000, "reviewId", "label", search=nearest_texts
    )


def _uneven(spark, sf):
    """All vectors, in three classes of six, three and one of the ten labels."""
    three = F.when(F.col("label") < 6, 0).when(F.col("label") < 9, 1).otherwise(2)
    return _vectors(spark, sf).select("vec_id", three.alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))


_SMOTE = {
    "vec": """select vec_id, case when label < 6 then 0 when label < 9 then 1 else 2 end as label,
        list_transform(embedding, lambda x: x::double) as v from embeddings""",
    "sizes": "select label, n, max(n) over () - n as lack from (select label, count(*) as n from vec group by label)",
    "near": """select a.vec_id, b.vec_id as neighbour, b.v as y, row_number() over (partition by a.vec_id order by
        cast(floor(greatest(list_dot_product(a.v, a.v) + list_dot_product(b.v, b.v) - 2 * list_dot_product(a.v, b.v), 0)
        * 1e9 + 0.5) as bigint), b.vec_id) as rn
        from vec a join vec b on a.label = b.label and a.vec_id <> b.vec_id""",
    "copies": """select vec_id, label, v, n, unnest(range(lack // n + case when rn <= lack % n then 1 else 0 end)) as copy
        from (select *, row_number() over (partition by label order by md5(cast(vec_id as varchar)), vec_id) as rn
        from vec join sizes using (label))""",
    "drawn": """select *, ('0x' || substr(md5(vec_id || ':' || copy), 1, 8))::bigint % least(5, n - 1) + 1 as rn,
        ('0x' || substr(md5(vec_id || ':' || copy), 9, 8))::bigint % 1000000 / 1e6::double as u from copies""",
}


@query(
    "b6_smote",
    sql(
        "",
        """select vec_id, copy, neighbour, u, label,
        cast(floor(list_sum(list_transform(range(1, 65), lambda i: v[i] + u * (y[i] - v[i]))) * 1e6 + 0.5) as bigint)
            as sum_micro,
        cast(floor((v[1] + u * (y[1] - v[1])) * 1e6 + 0.5) as bigint) as first_micro
        from drawn join near using (vec_id, rn)""",
        **_SMOTE,
    ),
)
def _(spark, sf):
    v = _uneven(spark, sf)
    new = smote(v, 64, "vec_id", "label", vector="embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x)
    return new.select(
        "vec_id", "copy", "neighbour", "u", "label",
        F.floor(total * 1e6 + 0.5).alias("sum_micro"), F.floor(F.col("embedding")[0] * 1e6 + 0.5).alias("first_micro"),
    )


@query(
    "b6_smote_class_sizes",
    sql("", "select label, max(n) over () as n from (select label, count(*) as n from vec group by label)", vec=_SMOTE["vec"]),
)
def _(spark, sf):
    v = _uneven(spark, sf)
    both = v.select("label").unionByName(smote(v, 64, "vec_id", "label", vector="embedding").select("label"))
    return both.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "m12_fixed_centroids",
    sql(
        "",
        """select vec_id, cluster, dist_nano from (select v.vec_id, c.vec_id as cluster,
        cast(floor((list_dot_product(v.v, v.v) + list_dot_product(c.v, c.v) - 2 * list_dot_product(v.v, c.v)) * 1e9 + 0.5)
            as bigint) as dist_nano,
        row_number() over (partition by v.vec_id order by dist_nano, c.vec_id) as rn
        from vec v, (select * from vec where vec_id < 4) c) where rn = 1""",
        vec=_DENSE["vec"],
    ),
)
def _(spark, sf):
    """One assignment step of K-Means with the first four vectors as centroids."""
    v = _vectors(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    centroids = v.where("vec_id < 4").withColumnRenamed("vec_id", "cluster")
    return assign_to_centroids(v, centroids, 64, "vec_id")
