"""Term counts by pieces of the rows, and vectorisers fitted on tokens."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from opinara.operators import ngrams
from opinara.operators.features import TfidfVectoriser, term_stats


def test_terms_are_counted_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "_PIECE_ROWS", 4)
    lists = [["a", "b", "a"], None, [], ["b", None, "c", None], [None], ["a"], ["é", "", "é"]] * 3
    df = spark.createDataFrame([(x,) for x in lists], "terms array<string>").coalesce(1)
    assert df.count() == 21
    # One row for each term of a piece: 6 pieces with up to 5 terms, where there are 24 tokens.
    assert ngrams.counted_terms(df, "terms").count() < 24
    ctf, texts = (Counter(w for x in lists if x for w in f(x) if w is not None) for f in (list, set))
    got = {r["term"]: (r["ctf"], r["df"]) for r in term_stats(df).collect()}
    assert got == {w: (ctf[w], texts[w]) for w in ctf}
    assert term_stats(df.where("size(terms) = 0")).collect() == []


def test_fit_on_tokens_equals_fit_on_texts(spark):
    df = spark.createDataFrame([("the cat sat",), ("the dog! sat down",), (None,), ("",)], "content string")
    blank = TfidfVectoriser(inputCol="content")
    rows = df.select(blank.tokens().alias("_tokens"))
    one, two = blank.fit(df, max_features=6), blank.fit(rows, max_features=6, tokens=F.col("_tokens"))
    assert [one.getOrDefault(x) for x in ("vocabulary", "idf")] == [two.getOrDefault(x) for x in ("vocabulary", "idf")]
