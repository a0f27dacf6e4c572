"""Token lists: lexicon tagging with negations, learned word pairs, vocabulary."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from opinara.functions.text import unfold
from opinara.session import saved

# Fixed values of the lemma filter.
NEGATIONS = ("not", "no", "never")
NEGATED_POS = ("ADJ", "VERB")
CONTENT_POS = ("NOUN", "ADJ", "VERB", "PROPN")


def numbered_rows(df: DataFrame) -> DataFrame:
    """df with `_row`, a number of each row that stays the same when it is read again."""
    return saved(df.withColumn("_row", F.monotonically_increasing_id()), "rows")


_NEGATES, _NEGATED, _CONTENT = 1, 2, 4
# Texts that look their words up together.
_BLOCK_ROWS = 4096


def _marked(lexicon: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """(tok, lemma, tag, marks): what the merge needs to know of a token, worked out once for each lexicon row."""
    token, lemma, pos = F.col("token"), F.col("lemma"), F.col("pos")
    content = ~token.isin(*stop_words) & token.rlike(r"^\p{L}+$") & (F.length(lemma) > 1) & pos.isin(*CONTENT_POS)
    rules = ((lemma.isin(*NEGATIONS), _NEGATES), (pos.isin(*NEGATED_POS), _NEGATED), (content, _CONTENT))
    marks = sum((F.when(rule, mark).otherwise(0) for rule, mark in rules), F.lit(0))
    return lexicon.select(token.alias("tok"), "lemma", pos.alias("tag"), marks.alias("marks"))


def _merged_lemmas(rows: pa.Table, known: pa.Table) -> pa.Table:
    """(_row, lemmas) of a block of token lists, from the lexicon rows of its words."""
    order = [(c, "ascending") for c in ("tok", "lemma", "tag")]
    known = known.take(pc.sort_indices(known, sort_keys=order, null_placement="at_start"))
    lists = rows["tokens"].combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    words = known["tok"].combine_chunks().dictionary_encode()
    counts = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
    code = pc.index_in(lists.flatten(), value_set=words.dictionary)
    place = np.flatnonzero(pc.is_valid(code).to_numpy(zero_copy_only=False))
    code = pc.drop_null(code).to_numpy()
    # A token takes the place of as many entries as the lexicon has rows for it: one, as a rule.
    many = counts[code]
    place, first = np.repeat(place, many), np.repeat((np.cumsum(counts) - counts)[code], many)
    entry = first + np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many)
    row = np.repeat(np.arange(len(sizes)), sizes)[place]
    marks = known["marks"].to_numpy()[entry]
    # Words that the lexicon does not list leave a gap between places.
    beside = (row[1:] == row[:-1]) & (place[1:] - place[:-1] <= 1)
    merges = beside & (marks[:-1] & _NEGATES > 0) & (marks[1:] & _NEGATED > 0)
    swallowed, prefixed = (np.concatenate(x)[: len(row)] for x in (([False], merges), (merges, [False])))
    prefixed = prefixed & ~swallowed
    kept = np.flatnonzero(~swallowed & (prefixed | (marks & _CONTENT > 0)))
    joined = prefixed[kept]
    lemma = known["lemma"].combine_chunks().take(pa.array(entry[np.minimum(kept + joined, max(len(entry) - 1, 0))]))
    lemma = pc.if_else(pa.array(joined), pc.binary_join_element_wise("not_", lemma, ""), lemma)
    held = pc.is_valid(lemma).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[kept][held], minlength=len(sizes)))])
    return pa.table({"_row": rows["_row"], "lemmas": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), lemma.filter(pa.array(held)))})


def lemmatise(
    df: DataFrame, lexicon: DataFrame, stop_words: Sequence[str], tokens: str = "tokens"
) -> DataFrame:
    """Content lemmas per review, with 'not_<lemma>' for a negated ADJ or VERB.

    lexicon(token, lemma, pos), one row per token, is joined with the different words of each
    block of reviews, never with all tokens; a block then looks its words up in place. Rows
    have a number of their own: ids may repeat. Reviews without a lemma keep an empty list.
    """
    rows = numbered_rows(df)
    block = F.floor(F.col("_row") / _BLOCK_ROWS).alias("_block")
    words = rows.select(block, F.explode(tokens).alias("tok")).distinct()
    known = words.join(_marked(lexicon, stop_words), "tok")
    lists = rows.select(block, "_row", F.col(tokens).alias("tokens")).groupBy("_block").cogroup(known.groupBy("_block"))
    found = lists.applyInArrow(_merged_lemmas, "_row bigint, lemmas array<string>")
    out = rows.join(found, "_row", "left").drop("_row")
    return out.withColumn("lemmas", F.coalesce("lemmas", F.array().cast("array<string>")))


def _pairs(df: DataFrame, tokens: str) -> DataFrame:
    """df with (pos, a, b) of each token and the next one."""
    each = df.select("*", F.posexplode(tokens).alias("pos", "a"))
    return each.withColumn("b", F.get(tokens, F.col("pos") + 1)).where(F.col("b").isNotNull()).drop(tokens)


def learn_phrases(df: DataFrame, tokens: str = "tokens", min_count: int = 5, threshold: float = 10.0) -> DataFrame:
    """Word pairs (a, b) that occur together more than chance.

    score = (n_ab - min_count) * V / (n_a * n_b), V distinct words plus distinct
    pairs. Rare pairs are dropped before the two joins with the word counts. df is read
    twice, so lists that take long to make are better saved before.
    """
    t = F.col(tokens)
    words = df.select(unfold(t).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    words = saved(words, "word-counts")
    pairs = (
        _pairs(df.select(tokens), tokens)
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("n_ab"))
    )
    # The distinct pairs are counted while the frequent ones are written.
    seen = Observation()
    counted = pairs.observe(seen, F.count(F.lit(1)).alias("n")).where(F.col("n_ab") >= min_count)
    frequent = saved(counted, "pair-counts")
    vocabulary = words.count() + seen.get["n"]
    joined = frequent.join(words.select(F.col("w").alias("a"), F.col("n").alias("n_a")), "a").join(
        words.select(F.col("w").alias("b"), F.col("n").alias("n_b")), "b"
    )
    score = (F.col("n_ab") - min_count).cast("double") * vocabulary / F.col("n_a") / F.col("n_b")
    return joined.select("a", "b", "n_ab", "n_a", "n_b", score.alias("score")).where(F.col("score") > threshold)


def apply_phrases(df: DataFrame, phrases: DataFrame, tokens: str = "tokens", row: str | None = None) -> DataFrame:
    """Merge learned pairs to 'a_b', left to right without overlap.

    The pairs are written once, so that Spark knows their bytes: if they are few, they are
    broadcast and only the positions of learned pairs are shuffled. In each run of consecutive
    positions the 1st, 3rd, 5th ... pair merges. The list is then rebuilt in
    place from slices. Rows have a number of their own: ids may repeat. `row` names that
    column, as of `numbered_rows`, if df has it already; it is left out of the result.
    """
    df = numbered_rows(df) if row is None else df.withColumnRenamed(row, "_row")
    t = F.col(tokens)
    side = saved(phrases.select("a", "b"), "phrases")
    hits = (
        _pairs(df.select("_row", tokens), tokens)
        .join(side, ["a", "b"])
        .select("_row", "pos")
    )
    by_pos = Window.partitionBy("_row").orderBy("pos")
    runs = hits.withColumn("run", F.col("pos") - F.row_number().over(by_pos))
    in_run = Window.partitionBy("_row", "run").orderBy("pos")
    starts = (
        runs.withColumn("k", F.row_number().over(in_run))
        .where(F.col("k") % 2 == 1)
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list("pos")).alias("_s"))
    )
    joined = df.join(starts, "_row", "left")
    s = F.col("_s")
    # Piece i: the words after merge i-1 up to merge i, then the merged pair.
    before = F.concat(F.array(F.lit(-2)), F.slice(s, F.lit(1), F.size(s) - 1))
    pieces = F.transform(
        F.arrays_zip(s.alias("at"), before.alias("last")),
        lambda z: F.concat(
            F.slice(t, z["last"] + 3, z["at"] - z["last"] - 2),
            F.array(F.concat_ws("_", F.element_at(t, z["at"] + 1), F.element_at(t, z["at"] + 2))),
        ),
    )
    last = F.element_at(s, -1)
    tail = F.slice(t, last + 3, F.size(t) - last - 2)
    merged = F.when(s.isNull(), t).otherwise(F.concat(F.flatten(pieces), tail))
    return joined.withColumn("_m", merged).drop("_s", "_row", tokens).withColumnRenamed("_m", tokens)


def vocabulary(
    df: DataFrame, tokens: str = "tokens", no_below: int = 5, no_above: float = 0.5, keep_n: int = 100_000
) -> DataFrame:
    """Terms in at least no_below and at most a share no_above of the reviews."""
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    terms = df.select(F.explode(F.array_distinct(tokens)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    kept = terms.where((F.col("df") >= no_below) & (F.col("df") <= n_docs * no_above))
    return kept.orderBy(F.desc("df"), "term").limit(keep_n)


def join_tokens(df: DataFrame, tokens: str = "tokens", name: str = "text_final") -> DataFrame:
    """Tokens joined by blanks; reviews with no token left are dropped."""
    return df.withColumn(name, F.array_join(tokens, " ")).where(F.trim(name) != "")
