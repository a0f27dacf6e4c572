"""Token lists looked up by blocks, against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import tokens as tok

STOP = ("the", "w7")


def _lemmas(words, lexicon):
    hits = [lexicon.get(w) for w in words]
    out = []
    for i, (w, hit) in enumerate(zip(words, hits)):
        before, after = (hits[j] if 0 <= j < len(hits) else None for j in (i - 1, i + 1))
        merges = lambda x, y: bool(x and y) and x[0] in tok.NEGATIONS and y[1] in tok.NEGATED_POS
        if merges(before, hit):
            continue
        if merges(hit, after):
            out += [] if after[0] is None else ["not_" + after[0]]
        elif hit and hit[0] and len(hit[0]) > 1 and hit[1] in tok.CONTENT_POS and w not in STOP and w.isalpha():
            out.append(hit[0])
    return out


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_lemmas_by_blocks(spark, monkeypatch, block_rows):
    monkeypatch.setattr(tok, "_BLOCK_ROWS", block_rows)
    draw = random.Random(5)
    words = ["the", "not", "never", "good", "run", "x9", "unlisted", "cat", "w7", "nolemma", "é"]
    lexicon = {"the": ("the", "NOUN"), "not": ("not", "PART"), "never": ("never", "ADJ"), "good": ("good", "ADJ"), "run": ("run", "VERB"),
               "x9": ("x9", "NOUN"), "cat": ("cat", "NOUN"), "w7": ("w", "NOUN"), "nolemma": (None, "VERB"), "é": ("ée", "PROPN"), "unused": ("u", "ADJ")}
    lists = [[draw.choice(words) for _ in range(draw.randrange(9))] for _ in range(40)] + [None, ["not", None, "good"], ["unlisted"]]
    rows = [(i % 30, t) for i, t in enumerate(lists)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>").coalesce(2)
    lex = spark.createDataFrame([(k, *v) for k, v in lexicon.items()], "token string, lemma string, pos string")
    got = sorted((r["id"], r["tokens"] or [], r["lemmas"]) for r in tok.lemmatise(df, lex, STOP).select("id", F.transform("tokens", lambda x: F.coalesce(x, F.lit("-"))).alias("tokens"), "lemmas").collect())
    assert got == sorted((i, [w or "-" for w in t or []], _lemmas(t or [], lexicon)) for i, t in rows)


def test_lemmas_of_a_repeated_lexicon_row(spark):
    df = spark.createDataFrame([(1, ["cat", "not", "good"])], "id int, tokens array<string>")
    lex = spark.createDataFrame([("cat", "cat", "NOUN"), ("cat", "kitty", "NOUN"), ("not", "not", "PART"), ("good", "good", "ADJ")], "token string, lemma string, pos string")
    assert tok.lemmatise(df, lex, []).first()["lemmas"] == ["cat", "kitty", "not_good"]
    assert tok.lemmatise(df, lex.where("token = 'none'"), []).first()["lemmas"] == []


def test_tokens_are_not_shuffled_for_the_lexicon(spark):
    """The lexicon meets the different words of a block, one here, and not all 9,000 tokens."""
    df = spark.range(1000, numPartitions=1).select("id", F.array_repeat(F.lit("good"), 9).alias("tokens"))
    lex = spark.createDataFrame([("good", "good", "ADJ")], "token string, lemma string, pos string")
    found = tok.lemmatise(df, lex, [])
    assert "CoGroup" in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.agg(F.sum(F.size("lemmas"))).first()[0] == 9000


def test_phrases_over_numbered_rows(spark):
    lists = [["a", "b", "a", "b", "c"], ["b", "c", "a"], [], ["a", "a", "b"], None, ["c"]] * 6
    df = spark.createDataFrame([(i % 7, t) for i, t in enumerate(lists)], "id int, tokens array<string>")
    rows = tok.numbered_rows(df)
    pairs = tok.learn_phrases(rows, min_count=1, threshold=0.1).select("a", "b")
    one, two = (sorted(map(str, x.collect())) for x in (tok.apply_phrases(rows, pairs, row="_row"), tok.apply_phrases(df, pairs)))
    assert one == two and any("a_b" in x for x in one)
