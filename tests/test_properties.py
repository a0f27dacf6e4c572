"""Properties of operators that have no SQL twin, and of the tricky plans."""

from __future__ import annotations

import csv
import io
import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import inputs
from catalog.learning import LABEL_PROMPT, TOPIC_PROMPT
from catalog.models import judge, write_reviews
from opinara.functions import prompts, rounding
from opinara.functions.labels import to_number
from opinara.functions.text import CONTRACTIONS, expand_contractions, parse_label
from opinara.operators import balance, coherence, evaluate, features, neighbours
from opinara.operators.clean import require_columns, split_location
from opinara.operators.generate import ask, augment, classify_with_model
from opinara.operators.hash_order import cut_by_hash, numbered, share_out
from opinara.operators.tokens import apply_phrases, lemmatise
from opinara.sources import records
from opinara.sources import tables as tb

SF = "/root/testdata/sf0.001"


def vectors(spark, n, dim, seed, classes=3, repeats=0):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=dim).round(3)], int(rng.integers(classes))) for i in range(n)]
    rows += [(n + i, rows[i % n][1], rows[i % n][2]) for i in range(repeats)]
    return spark.createDataFrame(rows, "id bigint, v array<double>, label int"), rows


def brute(queries, base, k, metric, exclude_self=False):
    out = {}
    for qid, q, _ in queries:
        q, found = np.array(q), []
        for bid, b, _ in base:
            if exclude_self and bid == qid:
                continue
            b = np.array(b)
            if metric == "cosine":
                nq, nb = np.linalg.norm(q), np.linalg.norm(b)
                d = 1.0 if nq == 0 or nb == 0 else 1 - q @ b / (nq * nb)
            else:
                d = ((q - b) ** 2).sum()
            found.append((int(np.floor(d * 1e9 + 0.5)), bid))
        out[qid] = [b for _, b in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("cell_rows,block_rows", [(1000, 1000), (40, 15)])
def test_nearest_is_exact(spark, metric, cell_rows, block_rows):
    base, base_rows = vectors(spark, 230, 4, 1, repeats=30)
    queries, query_rows = vectors(spark, 90, 4, 2)
    zero = [(900, [0.0] * 4, 0)]
    base_rows, query_rows = base_rows + zero, query_rows + zero
    base = base.unionByName(spark.createDataFrame(zero, base.schema))
    queries = queries.unionByName(spark.createDataFrame(zero, queries.schema))
    found = neighbours.nearest(
        queries.withColumnRenamed("id", "q"), base.withColumnRenamed("id", "b"), 5, 4, "q", "b", "v", metric,
        cell_rows=cell_rows, block_rows=block_rows, query_rows=20,
    )
    got = {}
    for r in sorted(found.collect(), key=lambda r: r["rank"]):
        got.setdefault(r["q"], []).append(r["b"])
    want = brute(query_rows, base_rows, 5, metric)
    assert got == want


def test_nearest_excludes_self(spark):
    df, rows = vectors(spark, 60, 3, 5)
    found = neighbours.nearest(
        df.withColumnRenamed("id", "q"), df.withColumnRenamed("id", "b"), 3, 3, "q", "b", "v", "euclidean",
        exclude_self=True, cell_rows=20, block_rows=10,
    ).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["q"], []).append(r["b"])
    assert got == brute(rows, rows, 3, "euclidean", exclude_self=True)


def test_sparse_and_dense_agree(spark):
    df, _ = vectors(spark, 50, 6, 9)
    sparse = df.withColumn(
        "v", F.struct(F.sequence(F.lit(0), F.lit(5)).alias("indices"), F.col("v").alias("values"))
    )

    def run(d):
        return {
            (r["q"], r["b"], r["rank"])
            for r in neighbours.nearest(d.withColumnRenamed("id", "q"), d.withColumnRenamed("id", "b"), 4, 6, "q", "b", "v").collect()
        }

    assert run(df) == run(sparse)


def test_smote_fills_classes_on_segments(spark):
    rng = np.random.default_rng(3)
    sizes = {0: 40, 1: 13, 2: 6}
    rows = [(f"r{c}-{i}", [float(x) for x in rng.normal(size=3)], c) for c, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "id string, v array<double>, label int")
    new = neighbours.smote(df, 3, "id", "label", "v").collect()
    made = {c: sum(r["label"] == c for r in new) for c in sizes}
    assert made == {0: 0, 1: 27, 2: 34}
    at = {i: (np.array(v), c) for i, v, c in rows}
    for r in new:
        x, y = at[r["id"]][0], at[r["neighbour"]][0]
        assert at[r["id"]][1] == at[r["neighbour"]][1] == r["label"] and r["id"] != r["neighbour"]
        assert np.allclose(r["v"], x + r["u"] * (y - x)) and 0 <= r["u"] < 1


def test_smote_refuses_single_row(spark):
    df = spark.createDataFrame([("a", [1.0], 0), ("b", [2.0], 0), ("c", [3.0], 1)], "id string, v array<double>, label int")
    with pytest.raises(ValueError):
        neighbours.smote(df, 1, "id", "label", "v")


def test_sparse_interpolation(spark):
    df = spark.sql(
        "select named_struct('indices', array(0, 3), 'values', array(1D, 2D)) x, "
        "named_struct('indices', array(1, 3), 'values', array(4D, 4D)) y"
    )
    r = df.select(neighbours.interpolate(F.col("x"), F.col("y"), F.lit(0.5), True).alias("z")).first()["z"]
    assert r["indices"] == [0, 1, 3] and r["values"] == [0.5, 2.0, 3.0]


def test_vote(spark):
    rows = [("a", 0, 10), ("a", 1, 5), ("a", 0, 20), ("b", 1, 0), ("b", 0, 1), ("b", 0, 1), ("c", 1, 8), ("c", 0, 8)]
    df = spark.createDataFrame(rows, "q string, label int, dist_nano bigint")
    got = {r["q"]: r["prediction"] for r in neighbours.vote(df, "q", "label").collect()}
    assert got == {"a": 1, "b": 1, "c": 0}


def test_cuts_match_plain_ranking(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3 * F.col("id") % 2).cast("int").alias("g"))
    third = F.floor(F.col("n") / 3)
    cuts = lambda sizes: sizes.select("g", F.array(F.lit(0), third, third + 7, F.col("n")).alias("cuts"))
    got = {r["id"]: r["segment"] for r in cut_by_hash(df, "g", "id", cuts).collect()}
    import hashlib

    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append((hashlib.md5(str(r["id"]).encode()).hexdigest(), r["id"]))
    for g, members in groups.items():
        n = len(members)
        for rank, (_, i) in enumerate(sorted(members), 1):
            assert got[i] == sum(rank > c for c in (0, n // 3, n // 3 + 7, n))


def plain_shares(sizes, total):
    everything = sum(sizes.values())
    parts = {g: n * total // everything for g, n in sizes.items()}
    order = sorted(sizes, key=lambda g: (-(sizes[g] * total % everything), g))
    for g in order[: total - sum(parts.values())]:
        parts[g] += 1
    return parts


def as_sizes(spark, sizes, kind="int"):
    return spark.createDataFrame(list(sizes.items()), f"g {kind}, n bigint")


def test_split_sizes(spark):
    sizes = {0: 401, 1: 77, 2: 1003}
    cuts = {r["g"]: r["cuts"] for r in balance.split_sizes(as_sizes(spark, sizes), "g").collect()}
    total = sum(sizes.values())
    rest = -(-total * 30 // 100)
    assert sum(c[0] for c in cuts.values()) == total - rest
    assert sum(sizes[g] - c[1] for g, c in cuts.items()) == -(-rest // 2)
    assert all(abs(c[0] - 0.7 * sizes[g]) <= 1 for g, c in cuts.items())
    thirds = share_out(as_sizes(spark, {"a": 1, "b": 1, "c": 1}, "string"), "g", "n", 2, "part")
    assert {r["g"]: r["part"] for r in thirds.collect()} == {"a": 1, "b": 1, "c": 0}


@pytest.mark.parametrize("scale", (1, 10**13))
def test_shares_against_plain_arithmetic(spark, scale):
    rng = random.Random(scale)
    sizes = {g: rng.choice((0, 1, 2, rng.randrange(1, 500))) * scale + rng.randrange(3) for g in range(400)}
    total = sum(sizes.values()) * 7 // 10
    got = share_out(as_sizes(spark, sizes), "g", "n", total, "part")
    assert {r["g"]: r["part"] for r in got.collect()} == plain_shares(sizes, total)
    empty = share_out(as_sizes(spark, {0: 0, 1: 0}), "g", "n", 0, "part")
    assert [r["part"] for r in empty.collect()] == [0, 0]


def test_100_000_classes_are_split_and_levelled(spark):
    df = spark.range(250_000).select("id", F.least(F.col("id"), F.lit(100_000)).alias("g"))
    out = balance.stratified_split(df, "g", "id")
    by_set = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert by_set == {"train": 175_000, "dev": 37_500, "test": 37_500}
    hot = {r["split"]: r["n"] for r in out.where("g = 100000").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert hot == {"train": 105_000, "dev": 22_500, "test": 22_500}
    lack = balance.class_deficit(df, "g")
    assert lack.count() == 100_001 and lack.where("deficit = 149999").count() == 100_000
    few = balance.class_deficit(df, "g", [5, -1, 100_000]).collect()
    assert sorted(tuple(r) for r in few) == [(-1, 0, 150_000, 150_000), (5, 1, 150_000, 149_999), (100_000, 150_000, 150_000, 0)]


def test_split_is_disjoint_and_whole(spark):
    df = inputs.labelled(spark, SF)
    out = balance.stratified_split(df)
    assert out.count() == df.count() == out.select("reviewId").distinct().count()


def test_numbered_spreads_large_counts(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 7)], "k string, n int")
    for spread in (True, False):
        got = numbered(df, F.col("n"), "i", spread=spread, chunk=4).groupBy("k").agg(
            F.count("*").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.count_distinct("i").alias("d")
        )
        assert {tuple(r) for r in got.collect()} == {("a", 25, 0, 24, 25), ("c", 7, 0, 6, 7)}


def test_apply_phrases_greedy(spark):
    rng = random.Random(4)
    pairs = {("a", "b"), ("b", "a"), ("a", "a"), ("c", "a")}
    docs = [(i, [rng.choice("abcd") for _ in range(rng.randint(0, 30))]) for i in range(80)]

    def merge(tokens):
        out, i = [], 0
        while i < len(tokens):
            if i + 1 < len(tokens) and (tokens[i], tokens[i + 1]) in pairs:
                out.append(f"{tokens[i]}_{tokens[i + 1]}")
                i += 2
            else:
                out.append(tokens[i])
                i += 1
        return out

    df = spark.createDataFrame(docs, "reviewId int, tokens array<string>")
    got = apply_phrases(df, spark.createDataFrame(sorted(pairs), "a string, b string"))
    assert {r["reviewId"]: r["tokens"] for r in got.collect()} == {i: merge(t) for i, t in docs}


def test_window_counts_match_brute_force(spark):
    rng = random.Random(7)
    docs = [[rng.choice("abcdefgh") for _ in range(rng.choice([0, 3, 9, 10, 11, 40]))] for _ in range(40)]
    topics_ = [["a", "b", "c"], ["c", "d"]]
    df = spark.createDataFrame([(d,) for d in docs], "tokens array<string>")
    counts, total = coherence.window_counts(df, topics_, window=10)
    words = {w for t in topics_ for w in t}
    windows = [
        set(d[s : s + 10]) for d in docs if words & set(d) for s in range(max(1, len(d) - 9))
    ]
    assert total.first()[0] == len(windows)
    pairs = {(w, w) for w in words} | {tuple(sorted(p)) for t in topics_ for p in combinations(t, 2)}
    want = {p: sum(p[0] in w and p[1] in w for w in windows) for p in pairs}
    got = {(r["a"], r["b"]): r["n"] for r in counts.collect()}
    assert got == {p: n for p, n in want.items() if n or p in got}


def test_bag_of_words_and_tfidf_norm(spark):
    df = spark.createDataFrame([("1", ["x", "y", "x"]), ("2", []), ("3", ["z"])], "reviewId string, tokens array<string>")
    got = {(r["reviewId"], r["term"], r["n"]) for r in features.bag_of_words(df).collect()}
    assert got == {("1", "x", 2), ("1", "y", 1), ("3", "z", 1)}
    model = features.fit_tfidf(df, "tokens", max_features=2)
    assert model.terms == ["x", "y"] and model.n_docs == 3
    norms = model.weights(df, "tokens").select(F.aggregate("w.values", F.lit(0.0), lambda a, x: a + x * x)).collect()
    assert sorted(round(r[0], 9) for r in norms) == [0.0, 0.0, 1.0]


def test_report_averages(spark):
    rows = [(0, 0)] * 30 + [(0, 1)] * 10 + [(1, 1)] * 5 + [(1, 2)] * 5 + [(2, 2)] * 49 + [(3, 0)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r["row"]: r for r in evaluate.classification_report(df).collect()}
    classes = [rep[c] for c in "0123"]
    for part in ("precision", "recall", "f1"):
        assert rep["macro avg"][part] == pytest.approx(sum(c[part] for c in classes) / 4, abs=2e-6)
        assert rep["weighted avg"][part] == pytest.approx(sum(c[part] * c["support"] for c in classes) / 100, abs=2e-6)
    assert rep["accuracy"]["f1"] == 0.84 and rep["3"]["f1"] == 0.0
    assert evaluate.macro_f1(df).first()[0] == pytest.approx(rep["macro avg"]["f1"], abs=2e-6)


def test_strict_augmentation_reaches_target_over_rounds(spark, tmp_path):
    df = spark.createDataFrame(
        [(f"r{i}", f"text {i}", 2 if i < 20 else 0 if i < 27 else 1) for i in range(30)], "reviewId string, content string, label int"
    )

    def flaky(batch):
        if len(batch) > 1:
            raise RuntimeError("one at a time")
        full = write_reviews(batch)
        # Every other request yields only its first review.
        return [r.split("##")[0] if hash_even(p) else r for p, r in zip(batch, full)]

    def hash_even(p):
        return sum(p.encode()) % 2 == 0

    path = str(tmp_path / "replies")
    out = augment(df, "label", "content", flaky, TOPIC_PROMPT, path=path)
    assert {r["label"]: r["count"] for r in out.groupBy("label").count().collect()} == {0: 20, 1: 20, 2: 20}
    before = spark.read.parquet(path).count()
    augment(df, "label", "content", flaky, TOPIC_PROMPT, path=path)
    assert spark.read.parquet(path).count() == before


def test_failing_model_gives_fallback(spark):
    def broken(batch):
        raise RuntimeError("down")

    df = spark.createDataFrame([("a", "x"), ("b", "y")], "reviewId string, content string")
    assert {r["prediction"] for r in classify_with_model(df, broken, LABEL_PROMPT, n=None).collect()} == {1}
    assert classify_with_model(df, judge, LABEL_PROMPT, n=1).count() == 1
    asked = ask(df.withColumn("prompt", F.col("content")), lambda b: [p * 2 for p in b])
    assert {(r["reply"], r["error"]) for r in asked.collect()} == {("xx", None), ("yy", None)}
    failed = ask(df.withColumn("prompt", F.col("content")), broken).collect()
    assert {(r["reply"], r["error"]) for r in failed} == {(None, "RuntimeError: down")}
    with pytest.raises(RuntimeError, match="down"):
        more = spark.createDataFrame([("a", "x", 0), ("b", "y", 0), ("c", "z", 1)], "reviewId string, content string, label int")
        augment(more, "label", "content", broken, TOPIC_PROMPT)


def test_prompts_hold_the_users_words(spark):
    one = spark.range(1)
    ask_for = prompts.request_prompt("{n} of {label} about {what}: {exemplars}{other}", what="cats")
    text = ask_for(F.lit(3), F.lit(1), F.lit("a {n}"))
    assert one.select(text).first()[0] == "3 of 1 about cats: a {n}{other}"
    label = prompts.label_prompt("{examples}\n{text}?", [("x", "1"), ("y", "2")])
    assert one.select(label(F.lit(None).cast("string"))).first()[0] == "x => 1\ny => 2\n?"


def test_equal_new_texts_fill_a_class_exactly(spark):
    from opinara.plans.classification import training_vectors

    df = spark.createDataFrame(
        [(f"r{i}", f"good word{i}", 0) for i in range(12)] + [(f"s{i}", "bad app", 1) for i in range(4)], "reviewId string, content string, label int"
    )
    new = spark.createDataFrame([(None, "bad app", 1)] * 3, df.schema)
    vectoriser = features.TfidfVectoriser(inputCol="content", ngramRange=[1, 1]).fit(df, max_features=20)
    rows = training_vectors(df.unionByName(new), vectoriser, oversample=True)
    assert dict(rows.groupBy("label").count().collect()) == {0: 12, 1: 12}
    twice = df.unionByName(df.where("reviewId = 's1'")).withColumn("v", F.array(F.lit(1.0)))
    with pytest.raises(ValueError, match="s1"):
        neighbours.smote(twice, 1, "reviewId", "label", "v")


def test_generated_rows_have_ids(spark):
    df = spark.createDataFrame([(f"r{i}", f"text {i}", int(i > 8)) for i in range(12)], "reviewId string, content string, label int")
    out = augment(df, "label", "content", write_reviews, TOPIC_PROMPT)
    ids = [r["reviewId"] for r in out.collect()]
    assert len(ids) == 18 and len(set(ids)) == 18 and None not in ids


def test_rows_of_one_id_stay_apart(spark):
    lexicon = spark.createDataFrame([("cat", "cat", "NOUN"), ("dog", "dog", "NOUN"), ("not", "not", "PART"), ("good", "good", "ADJ")], "token string, lemma string, pos string")
    rows = [("1", ["cat"], "x"), ("1", ["dog"], "y"), (None, ["not", "good", "cat"], "z"), ("2", [], "e"), ("3", None, "n")]
    df = spark.createDataFrame(rows, "reviewId string, tokens array<string>, lemma string")
    got = {r["lemma"]: r["lemmas"] for r in lemmatise(df, lexicon, []).collect()}
    assert got == {"x": ["cat"], "y": ["dog"], "z": ["not_good", "cat"], "e": [], "n": []}
    pairs = spark.createDataFrame([("a", "b")], "a string, b string")
    docs = spark.createDataFrame([("1", ["a", "b"]), ("1", ["b", "a", "b"]), ("1", ["a", "b"])], "reviewId string, tokens array<string>")
    assert sorted(r["tokens"] for r in apply_phrases(docs, pairs).collect()) == [["a_b"], ["a_b"], ["b", "a_b"]]


def test_small_rules(spark):
    text = spark.createDataFrame([(x,) for x in ["5", " 4.0 ", "5d", "1e0", ".5", "", "x", None]], "s string")
    got = [r[0] for r in text.select(to_number(F.col("s"))).collect()]
    assert got == [5.0, 4.0, None, 1.0, 0.5, None, None, None]
    one = spark.range(1)
    assert one.select(expand_contractions(F.lit("Its significant, visits here"))).first()[0] == "it is significan not, visit is here"
    assert len(CONTRACTIONS) == 23
    assert one.select(parse_label(F.lit(" 2\n")), parse_label(F.lit("2.")), parse_label(F.lit(None))).first()[:] == (2, 1, 1)
    city, country = split_location(F.col("l"))
    places = spark.createDataFrame([("A, B, C",), ("Peru",), ("  ",), (None,)], "l string").select(city, country)
    assert [tuple(r) for r in places.collect()] == [("A", "C"), (None, "Peru"), (None, None), (None, None)]
    r = one.select(rounding.percent(F.lit(1), F.lit(8)), rounding.mean(F.lit(2), F.lit(3)), rounding.percent(F.lit(0), F.lit(0)))
    assert r.first()[:] == (12.5, 0.667, None)
    with pytest.raises(ValueError):
        require_columns(one, ("label", "score"))


def test_csv_edge_cases(spark, tmp_path):
    path = tmp_path / "first_positive.csv"
    path.write_text('id,text,score\n1,"two\nlines, ""quoted""",5\n2,None,4\n3,short\n4,a,b,surplus\n5,,1\n')
    df = tb.read_csv(spark, str(path), ["id", "text", "score"], with_file=True)
    rows = {r["id"]: (r["text"], r["score"]) for r in df.collect()}
    assert rows == {"1": ('two\nlines, "quoted"', "5"), "2": (None, "4"), "3": ("short", None), "5": (None, "1")}
    tagged = tb.tag_from_file_name(df, {"first": "First"}, "Second").first()
    assert (tagged["app"], tagged["sentimiento_analisis"]) == ("First", "positive")
    assert tb.existing_paths(spark, [str(path), str(tmp_path / "none.csv")]) == [str(path)]


def test_csv_rows_with_surplus_fields_go(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,txt\n1,one\n2,one,\n3,two,,\n4,first-empty,,y\n5,"a,b"\n\n6\n7,"x""y"\n8,a"b"c\n')
    got = {r["id"]: r["txt"] for r in tb.read_csv(spark, str(tmp_path), ["id", "txt"]).collect()}
    assert got == {"1": "one", "5": "a,b", "6": None, "7": 'x"y', "8": 'a"b"c'}


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_csv_splits_inside_quoted_fields(spark, tmp_path, newline):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        text = "".join(rng.choice(["a", "b,", '"', "\n", " ", "é", "line\n\nline"]) for _ in range(rng.randint(0, 40)))
        rows.append((str(i), text or None, str(i % 5)))
    rows.append(("300", "x\n" * 3000, "1"))
    rows.append(("301", 'quote "," inside\n"', "2"))
    rng.shuffle(rows)
    for part in range(2):
        with open(tmp_path / f"f{part}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f, lineterminator=newline)
            out.writerow(["id", "text", "score"] if part else ["score", "id", "text"])
            out.writerows([(r if part else (r[2], r[0], r[1])) for r in rows if int(r[0]) % 2 == part])
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        df = tb.read_csv(spark, str(tmp_path), ["id", "text", "score"])
        assert df.select("id").rdd.getNumPartitions() > 10
        got = sorted((r["id"], r["text"], r["score"]) for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted(rows)


def test_csv_line_states(spark):
    rng = random.Random(6)
    for _ in range(3000):
        line = "".join(rng.choice(['"', ",", "a", " "]) for _ in range(rng.randint(0, 9)))
        probe = line + '\nMARK,x\n'
        after = list(csv.reader(io.StringIO(probe, newline="")))
        assert records.ends_inside(line, False) == (after[-1][:1] != ["MARK"]), line


def test_csv_fields_go_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("score,id,text\n5,1,one\n4,2,two,\n3,3\n")
    (tmp_path / "b c.csv").write_text("Unnamed: 0,text,score,id,Unnamed: 9\n0,four,1,4,x\n1,five,2,5,x,surplus\n")
    (tmp_path / "empty.csv").write_text("")
    got = sorted(tuple(r) for r in tb.read_csv(spark, str(tmp_path), ["id", "text", "score"]).collect())
    assert got == [("1", "one", "5"), ("3", None, "3"), ("4", "four", "1")]
    every = tb.read_csv(spark, str(tmp_path))
    assert sorted(every.columns) == ["id", "score", "text"] and every.count() == 3
    assert tb.read_csv(spark, str(tmp_path / "empty.csv"), ["id"]).count() == 0


def test_white_space_of_any_kind(spark):
    from opinara.operators.clean import derive, nonblank, reject_report, validate

    row = {"reviewId": "r", "content": "one\u00a0two\u3000three", "score": "5", "gender": "male", "date": "2020-01-02", "app": "A"}
    df = spark.createDataFrame([{**row, "location": "\tLima\u00a0,\u00a0Peru\u3000"}, {**row, "content": "\u00a0\t\u3000", "location": "x"}])
    got = derive(validate(df)).select("city", "country", "word_count").collect()
    assert [tuple(r) for r in got] == [("Lima", "Peru", 3)]
    assert df.where(nonblank(F.col("content"))).count() == 1
    assert reject_report(df).first()["dropped_content"] == 1


def test_repeated_names_do_not_multiply_reviews(spark):
    from opinara.operators.geo import geo_enrich, resolve_names

    dim = spark.createDataFrame([("Peru", 1.0, 2.0, "PER", "S"), ("Peru", 3.0, 4.0, "PER", "S")], "country string, lat double, lon double, iso3 string, continent string")
    assert geo_enrich(spark.createDataFrame([("Peru",)], "country string"), dim).count() == 1
    names = spark.createDataFrame([("Peru",), ("Pe",)], "name string")
    aliases = spark.createDataFrame([("Pe", "Peru"), ("Pe", "Peru")], "alias string, canonical string")
    assert resolve_names(names, dim.withColumnRenamed("country", "name"), aliases).count() == 2


def test_augmentation_that_cannot_reach_its_target_fails(spark):
    from opinara.operators.generate import augment

    df = spark.createDataFrame([("1", "a", 0), ("2", "b", 0), ("3", "c", 1)], "reviewId string, content string, label int")
    short = lambda prompts: ["no"] * len(prompts)
    with pytest.raises(RuntimeError, match="still short"):
        augment(df, "label", "content", short, lambda c, n, t: F.concat_ws(" ", c.cast("string"), n.cast("string")), max_rounds=1)


def test_a_stopped_round_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    from opinara.operators import generate

    df = spark.createDataFrame([(str(k), f"text {k}", int(k == 0)) for k in range(12)], "reviewId string, content string, label int")
    log = tmp_path / "asked"

    def reply(batch):
        with open(log, "a") as f:
            f.writelines("x\n" for _ in batch)
        return write_reviews(batch)

    args = (df, "label", "content", reply, TOPIC_PROMPT)
    options = {"batch": 1, "path": str(tmp_path / "replies"), "commit_every": 1}
    calls, real = [], generate.ask

    def stops(*a, **k):
        calls.append(1)
        if len(calls) == 4:
            raise KeyboardInterrupt
        return real(*a, **k)

    monkeypatch.setattr(generate, "ask", stops)
    with pytest.raises(KeyboardInterrupt):
        augment(*args, **options)
    first = len(log.read_text().splitlines())
    monkeypatch.setattr(generate, "ask", real)
    full = augment(*args, **options)
    assert dict(full.groupBy("label").count().collect()) == {0: 11, 1: 11}
    assert 0 <= first < 10 and len(log.read_text().splitlines()) == 10


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from opinara.session import work_root

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="x"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_root(fake)


def test_empty_inputs(spark):
    docs = spark.createDataFrame([("1", ["a", "b"]), ("2", [])], "reviewId string, tokens array<string>")
    none = spark.createDataFrame([], "a string, b string")
    got = {r["reviewId"]: r["tokens"] for r in apply_phrases(docs, none).collect()}
    assert got == {"1": ["a", "b"], "2": []}
    assert features.fit_tfidf(docs.where("false"), "tokens").terms == []
    rows = spark.createDataFrame([], "reviewId string, content string, label int")
    assert balance.class_deficit(rows, "label", [0, 1]).collect() == [(0, 0, 0, 0), (1, 0, 0, 0)]
    assert balance.stratified_split(rows).count() == 0


def test_hot_class_is_cut_exactly(spark):
    """A class with nearly all rows gets the same exact shares as a small one."""
    df = spark.range(30000).select(
        F.concat(F.lit("r"), F.col("id")).alias("reviewId"), F.when(F.col("id") % 100 == 0, 1).otherwise(0).alias("label")
    )
    got = {(r["label"], r["split"]): r["count"] for r in balance.stratified_split(df).groupBy("label", "split").count().collect()}
    assert got == {
        (0, "train"): 20790, (0, "dev"): 4455, (0, "test"): 4455, (1, "train"): 210, (1, "dev"): 45, (1, "test"): 45
    }


def test_commits_do_not_read_the_rows_again(spark, tmp_path):
    """Examples and open requests are found once for a round, and prompts are made behind the shuffle."""
    log = tmp_path / "read"

    @F.udf("string")
    def seen(text):
        with open(log, "a") as f:
            f.write("x\n")
        return text

    df = spark.createDataFrame([(str(k), f"text {k}", int(k == 0)) for k in range(12)], "reviewId string, content string, label int")
    df = df.withColumn("content", seen.asNondeterministic()("content"))
    full = augment(df, "label", "content", write_reviews, TOPIC_PROMPT, batch=1, commit_every=1)
    # A dozen rows a scan; one scan for each of the ten commits would need over 120.
    assert len(log.read_text().splitlines()) <= 60
    assert dict(full.groupBy("label").count().collect()) == {0: 11, 1: 11}
    sent = []
    shown = spark.createDataFrame([(0, "x"), (1, "y")], "label int, exemplars string")
    requests = spark.createDataFrame([(0, 0, 1), (1, 0, 2)], "label int, request_no long, n_wanted int")
    render = lambda d: sent.append(d.columns) or balance.with_prompts(d, shown, "label", TOPIC_PROMPT)
    asked = ask(requests, lambda b: [p[:5] for p in b], key=["label", "request_no"], render=render)
    assert sent == [["label", "request_no", "n_wanted"]]
    assert sorted(asked.collect()) == [(0, 0, 1, "Topic", None), (1, 0, 2, "Topic", None)]


def test_rows_meet_the_pivots_in_pieces():
    """A number for each row and pivot is held for some rows at a time, not for a whole batch."""
    seen = []

    def first(v, groups):
        seen.append(len(v))
        return pa.array([x["indices"][0] + g for x, g in zip(v.to_pylist(), groups.to_pylist())], pa.int32())

    v = pa.array([{"indices": [i, i + 1]} for i in range(1200)], pa.struct([("indices", pa.list_(pa.int32()))]))
    found = neighbours._in_pieces(first, pa.int32(), v, pa.array([5] * 1200))
    assert found.to_pylist() == [i + 5 for i in range(1200)] and seen == [512, 512, 176]
    assert len(neighbours._in_pieces(first, pa.int32(), v.slice(0, 0), pa.array([], pa.int64()))) == 0
