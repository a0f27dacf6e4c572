"""Features, splits, balancing and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.inputs import labelled, raw, reviews, sql, table
from catalog.texts import STOP, WORD, _in, sql_clean_letters, sql_words
from opinara.functions import prompts
from opinara.functions.text import clean_letters, feature_tokens
from opinara.operators import balance as b
from opinara.operators import evaluate as ev
from opinara.operators import features as f

# TF-IDF over the cleaned texts.


def _gram_ctes(source: str, text: str, stop: str = "", grams: int = 3) -> dict[str, str]:
    """Long list of n-grams per review."""
    toks = f"regexp_extract_all({text}, '{WORD}{{2,}}')"
    if stop:
        toks = f"list_filter({toks}, lambda x: x not in {stop})"
    parts = ["select reviewId, tok as term from flat"]
    if grams > 1:
        parts.append("select reviewId, tok || ' ' || n1 from flat where n1 is not null")
    if grams > 2:
        parts.append("select reviewId, tok || ' ' || n1 || ' ' || n2 from flat where n2 is not null")
    return {
        "docs": f"select reviewId, {toks} as toks from {source}",
        "flat": """select reviewId, tok, lead(tok) over w as n1, lead(tok, 2) over w as n2 from (
            select reviewId, unnest(toks) as tok, unnest(range(len(toks))) as pos from docs)
            window w as (partition by reviewId order by pos)""",
        "grams": " union all ".join(parts),
        "tf": "select reviewId, term, count(*) as tf from grams group by all",
    }


def _vocab_cte(limit: int, min_df: int = 1) -> str:
    return f"""select term, cast(sum(tf) as bigint) as ctf, count(*) as df,
        ln((1 + (select count(*) from docs))::double / (1 + count(*))::double) + 1.0::double as idf
        from tf group by term having count(*) >= {min_df} order by ctf desc, term limit {limit}"""


_WEIGHTS = """select reviewId, term, cast(floor(w / sqrt(sum(w * w) over (partition by reviewId)) * 1e6 + 0.5) as bigint)
    as weight_micro from (select reviewId, term, {tf} * idf as w from tf join vocab using (term))"""

_TRAIN_CTES = {**_gram_ctes("reviews", sql_clean_letters("content")), "vocab": _vocab_cte(7000)}


def _texts(spark, sf):
    return reviews(spark, sf).select("reviewId", "content")


def _tokens():
    return feature_tokens(clean_letters(F.col("content")))


def _micro(name: str):
    return F.floor(F.col(name) * 1e6 + 0.5).alias(f"{name}_micro")


@query(
    "m1_tfidf_fit",
    sql("reviews", "select term, ctf, df, cast(floor(idf * 1e6 + 0.5) as bigint) as idf_micro from vocab", **_TRAIN_CTES),
)
def _(spark, sf):
    return f.fit_ngrams(_texts(spark, sf), _tokens()).table(spark).select("term", "ctf", "df", _micro("idf"))


@query(
    "m1_tfidf_min_df",
    sql(
        "reviews",
        "select term, ctf, df from vocab",
        **_gram_ctes("reviews", sql_clean_letters("content")),
        vocab=_vocab_cte(3000, 7),
    ),
)
def _(spark, sf):
    return f.fit_ngrams(_texts(spark, sf), _tokens(), max_features=3000, min_df=7).table(spark).select("term", "ctf", "df")


@query("m2_tfidf_transform", sql("reviews", _WEIGHTS.format(tf="(1 + ln(tf))"), **_TRAIN_CTES))
def _(spark, sf):
    texts = _texts(spark, sf)
    return f.fit_ngrams(texts, _tokens()).long_ngrams(texts, _tokens()).select("reviewId", "term", _micro("weight"))


@query(
    "m3_tfidf_topics",
    sql(
        "reviews",
        _WEIGHTS.format(tf="tf"),
        **_gram_ctes("reviews", "lower(content)", _in(STOP), grams=1),
        vocab=_vocab_cte(1000),
    ),
)
def _(spark, sf):
    terms = f.with_terms(reviews(spark, sf).select("reviewId", "content"), F.col("content"), (1, 1), STOP)
    return f.fit_tfidf(terms, max_features=1000, sublinear=False).long(terms).select("reviewId", "term", _micro("weight"))


@query(
    "m4_bag_of_words",
    sql(
        "reviews",
        f"""select reviewId, term, count(*) as n from (
        select reviewId, unnest({sql_words("content")}) as term from reviews) group by all""",
    ),
)
def _(spark, sf):
    df = reviews(spark, sf).select(
        "reviewId", F.regexp_extract_all(F.lower("content"), F.lit(WORD + "+"), F.lit(0)).alias("tokens")
    )
    return f.bag_of_words(df)


# Evaluation. The prediction is a shifted label, as a stand-in for a model.

_PRED = {
    "pred": "select label, (label + case when doc % 5 = 0 then 1 else 0 end) % 3 as prediction from "
    "(select label, cast(substr(reviewId, 2) as bigint) as doc from labelled)",
    "per": """select c as class, sum(tp)::double as tp, sum(sup)::double as sup, sum(prd)::double as prd from (
        select label as c, count(*) as sup, 0 as prd, count(*) filter (label = prediction) as tp from pred group by 1
        union all select prediction, 0, count(*), 0 from pred group by 1) group by c""",
    "scores": """select class, case when prd > 0 then tp / prd else 0.0 end::double as precision,
        case when sup > 0 then tp / sup else 0.0 end::double as recall,
        case when prd + sup > 0 then 2 * tp / (prd + sup) else 0.0 end::double as f1, sup, tp from per""",
}


def _r6(x: str) -> str:
    return f"floor(({x}) * 1000000.0::double + 0.5::double) / 1000000.0::double"


def _predicted(spark, sf):
    df = labelled(spark, sf).withColumn("doc", F.substring("reviewId", 2, 30).cast("bigint"))
    shifted = F.col("label") + F.when(F.col("doc") % 5 == 0, 1).otherwise(0)
    return df.select("label", (shifted % 3).alias("prediction"))


@query("m8_macro_f1", sql("labelled", f"select {_r6('avg(f1)')} as macro_f1 from scores", **_PRED))
def _(spark, sf):
    return ev.macro_f1(_predicted(spark, sf))


_REPORT = f"""select cast(class as varchar) as "row", {_r6("precision")} as precision, {_r6("recall")} as recall,
    {_r6("f1")} as f1, cast(sup as bigint) as support from scores
    union all select 'accuracy', null, null, {_r6("sum(tp) / sum(sup)")}, cast(sum(sup) as bigint) from scores
    union all select 'macro avg', {_r6("avg(precision)")}, {_r6("avg(recall)")}, {_r6("avg(f1)")},
        cast(sum(sup) as bigint) from scores
    union all select 'weighted avg', {_r6("sum(precision * sup) / sum(sup)")}, {_r6("sum(recall * sup) / sum(sup)")},
        {_r6("sum(f1 * sup) / sum(sup)")}, cast(sum(sup) as bigint) from scores"""


@query("m9_classification_report", sql("labelled", _REPORT, **_PRED))
def _(spark, sf):
    return ev.classification_report(_predicted(spark, sf))


@query(
    "m9_quality_vs_toxic",
    sql("", _REPORT, pred="select quality as label, 1 - toxic as prediction from labels", per=_PRED["per"], scores=_PRED["scores"]),
)
def _(spark, sf):
    truth = table(spark, sf, "labels").select(F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction"))
    return ev.classification_report(truth)


# Split, sample and exemplars.

_SPLIT = {
    "sizes": "select label, count(*)::hugeint as n from labelled group by label",
    "totals": "select sum(n)::hugeint as t, (sum(n)::hugeint * 30 + 99) // 100 as rest from sizes",
    "tr": """select label, n, n * (t - rest) // t + case when row_number() over (order by n * (t - rest) % t desc, label)
        <= (t - rest) - sum(n * (t - rest) // t) over () then 1 else 0 end as n_train, rest from sizes, totals""",
    "dv": """select label, n_train, l * d // rest + case when row_number() over (order by l * d % rest desc, label)
        <= d - sum(l * d // rest) over () then 1 else 0 end as n_dev
        from (select *, n - n_train as l, rest - (rest + 1) // 2 as d from tr)""",
    "split": """select reviewId, label, content, case when rn <= n_train then 'train' when rn <= n_train + n_dev then 'dev'
        else 'test' end as split from (select *, row_number() over (partition by label
        order by md5(reviewId), reviewId) as rn from labelled) join dv using (label)""",
}


@query("b1_stratified_split", sql("labelled", "select reviewId, label, split from split", **_SPLIT))
def _(spark, sf):
    return b.stratified_split(labelled(spark, sf)).select("reviewId", "label", "split")


@query(
    "s8_sink_by_split",
    sql("labelled", "select split, label, count(*) as n from split group by all", **_SPLIT),
)
def _(spark, sf):
    from opinara.session import scratch_path
    from opinara.sources.tables import write_by_split

    path = scratch_path(spark, "by-split")
    write_by_split(b.stratified_split(labelled(spark, sf)), path)
    back = spark.read.schema("reviewId string, content string, label int, split string").parquet(path)
    return back.groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


@query("l4_sample_n", sql("raw", "select reviewId, score from raw order by md5(reviewId), reviewId limit 100"))
def _(spark, sf):
    return b.sample_n(raw(spark, sf)).select("reviewId", "score")


def _shown(k: int, label: str = "label") -> str:
    return f"""select {label}, string_agg(content, ' | ' order by reviewId) as exemplars from (
        select *, row_number() over (partition by {label} order by reviewId) as rn from labelled where content is not null)
        where rn <= {k} group by {label}"""


@query("w2_class_exemplars", sql("labelled", _shown(2)))
def _(spark, sf):
    return b.exemplars(labelled(spark, sf), "label", "content", k=2)


_DEFICIT = """select label, coalesce(n, 0) as n, majority, majority - coalesce(n, 0) as deficit
    from (select unnest([0, 1, 2, 7]) as label) left join (select label, count(*) as n from labelled group by label)
    using (label), (select max(n) as majority from (select count(*) as n from labelled group by label))"""


@query("b2_class_deficit", sql("labelled", _DEFICIT))
def _(spark, sf):
    return b.class_deficit(labelled(spark, sf), classes=[0, 1, 2, 7])


@query(
    "b3_template_augment",
    sql(
        "reviews",
        """select reviewId, app, content, score, sentiment from reviews union all
        select null, app, 'New ' || kind || ' review generated for ' || app || ' by IA', s, label from (
        select app, unnest([['POSITIVA', 'positive', '5'], ['NEGATIVA', 'negative', '1'], ['NEUTRA', 'neutral', '3']]) as x,
            x[1] as kind, x[2] as label, cast(x[3] as int) as s,
            greatest(p, g, u) - case x[2] when 'positive' then p when 'negative' then g else u end as deficit
        from bands), range(100000) r(i) where r.i < deficit""",
        bands="""select app, count(*) filter (score >= 4) as p, count(*) filter (score <= 2) as g,
            count(*) filter (score = 3) as u from reviews group by app""",
    ),
)
def _(spark, sf):
    df = reviews(spark, sf).select("reviewId", "app", "content", "score", "sentiment")
    return b.template_augment(df)


def _requests_sql(batch: int, k: int, prompt: str) -> dict[str, str]:
    return {
        "deficits": _DEFICIT,
        "shown": _shown(k),
        "requests": f"""select label, i as request_no, cast(least({batch}, deficit - i * {batch}) as int) as n_wanted,
            coalesce(exemplars, '') as shown from deficits left join shown using (label),
            range(100000) r(i) where deficit > 0 and i < (deficit + {batch - 1}) // {batch}""",
        "prompts": f"select label, request_no, n_wanted, {prompt} as prompt from requests",
    }


def _prompt_sql(template: str, **slots: str) -> str:
    text = "'" + template.replace("'", "''") + "'"
    for slot, value in slots.items():
        text = f"replace({text}, '{{{slot}}}', {value})"
    return text


# Templates and examples of the catalogue; a user brings their own.
STARS = "Stars: {label}. Samples: {exemplars}. Number of texts: {n}. Separator: ##"
TOPIC = "Topic: {topic}. Class: {label}. Samples: {exemplars}. Number of texts: {n}. Separator: ##"
LABEL = "Digit for the text.\n{examples}\n{text} =>"
EXAMPLES = [("fine weather", "2"), ("lost luggage", "0")]
STAR_PROMPT = prompts.request_prompt(STARS)
TOPIC_PROMPT = prompts.request_prompt(TOPIC, topic="dating")
LABEL_PROMPT = prompts.label_prompt(LABEL, EXAMPLES)

_STAR_SQL = _prompt_sql(STARS, n="cast(n_wanted as varchar)", label="cast(label as varchar)", exemplars="shown")
_TOPIC_SQL = _prompt_sql(TOPIC, topic="'dating'", n="cast(n_wanted as varchar)", label="cast(label as varchar)", exemplars="shown")
LABEL_SQL = _prompt_sql(LABEL, examples="'" + "\n".join(f"{t} => {x}" for t, x in EXAMPLES) + "'", text="content")


@query("b4_augment_requests", sql("labelled", "select * from prompts", **_requests_sql(5, 3, _TOPIC_SQL)))
def _(spark, sf):
    return b.augment_requests(
        labelled(spark, sf), "label", "content", TOPIC_PROMPT, classes=[0, 1, 2, 7]
    )


@query("t17_build_prompt", sql("labelled", "select * from prompts", **_requests_sql(4, 2, _STAR_SQL)))
def _(spark, sf):
    return b.augment_requests(
        labelled(spark, sf), "label", "content", STAR_PROMPT, classes=[0, 1, 2, 7], batch=4, k=2
    )


@query(
    "t17_classify_prompt",
    sql("reviews", f"select reviewId, {LABEL_SQL} as prompt from reviews"),
)
def _(spark, sf):
    return reviews(spark, sf).select("reviewId", LABEL_PROMPT(F.col("content")).alias("prompt"))
