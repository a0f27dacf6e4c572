"""Text normalisation, token lists and word counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import query
from catalog.inputs import APPS, raw, reviews, sql, table
from opinara.functions import text as t
from opinara.operators import tokens as tok
from opinara.operators import words as w
from opinara.session import saved

SPACE, WORD = t.SPACE, t.WORD_CHAR

# A small stop list for the synthetic texts, next to the fixed custom words.
STOP = (*t.CUSTOM_STOP_WORDS, "the", "of", "and", "is", "la", "les", "du", "en", "to", "with")
EMOJI = {"😀": "grinning_face", "👍": "thumbs_up", "👍🏽": "thumbs_up_medium_skin_tone", "❤️": "red_heart", "🇪🇸": "Spain"}


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def sql_squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def sql_clean_letters(x: str) -> str:
    punctuation = t.PUNCTUATION.replace("'", "''") + r"|\p{Nd}"
    return sql_squeeze(f"regexp_replace(lower(coalesce({x}, 'nan')), '{punctuation}', '', 'g')")


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}|{SPACE}$', '', 'g')"


def sql_words(x: str, length: int = 1) -> str:
    return f"regexp_extract_all(lower({x}), '{WORD}{{{length},}}')"


@query("t1_clean_train", sql("raw", f"select reviewId, {sql_clean_letters('content')} as clean from raw"))
def _(spark, sf):
    return raw(spark, sf).select("reviewId", t.clean_letters(F.col("content")).alias("clean"))


@query("t2_clean_test", sql("raw", f"select {sql_clean_letters('content')} as clean, count(*) as n from raw group by all"))
def _(spark, sf):
    clean = t.clean_letters(F.col("content")).alias("clean")
    return raw(spark, sf).select(clean).groupBy("clean").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t3_clean_ascii",
    sql(
        "raw",
        "select reviewId, "
        + sql_strip(f"regexp_replace(lower(coalesce(content, '')), '[^a-z0-9{t.SPACE_CHARS}]', '', 'g')")
        + " as clean from raw",
    ),
)
def _(spark, sf):
    return raw(spark, sf).select("reviewId", t.clean_ascii(F.col("content")).alias("clean"))


def _emoji_text():
    """Emoji at the front, inside and at the end of the given texts."""
    k = F.col("k")
    return (
        F.when(k % 5 == 0, F.concat(F.lit("👍🏽:"), F.col("content"), F.lit(" snake_case 😀😀")))
        .when(k % 5 == 1, F.replace(F.col("content"), F.lit(","), F.lit("❤️🇪🇸")))
        .when(k % 5 == 2, F.concat(F.col("content"), F.lit("👍")))
        .otherwise(F.col("content"))
    )


def _emoji_sql() -> str:
    x = "emo"
    for e in sorted(EMOJI, key=lambda e: -len(e)):
        x = f"replace({x}, '{e}', ' {EMOJI[e]} ')"
    return sql_squeeze(f"translate({x}, ':_', '  ')")


@query(
    "t4_emoji_to_words",
    sql(
        "raw",
        f"select reviewId, {_emoji_sql()} as words from emo_text",
        emo_text="""select reviewId, case when k % 5 = 0 then '👍🏽:' || content || ' snake_case 😀😀'
        when k % 5 = 1 then replace(content, ',', '❤️🇪🇸') when k % 5 = 2 then content || '👍' else content end as emo
        from (select *, cast(substr(reviewId, 2) as bigint) as k from raw)""",
    ),
)
def _(spark, sf):
    df = raw(spark, sf).withColumn("k", F.substring("reviewId", 2, 30).cast("bigint"))
    return df.select("reviewId", t.emoji_to_words(_emoji_text(), EMOJI).alias("words"))


def _contractions_sql(x: str) -> str:
    x = f"lower({x})"
    for pattern, by in t.CONTRACTIONS:
        if "(?=" in pattern:
            x = f"regexp_replace({x}, 'it''s', 'it is', 'g')"
            x = f"regexp_replace({x}, 'its([{t.SPACE_CHARS}])', 'it is\\1', 'g')"
        else:
            x = f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{by}', 'g')"
    return x


_CONTRACTED = """case when k % 3 = 0 then replace(content, ',', ' don''t cant its it''s') when k % 3 = 1
    then 'We''re significant visits here: ' || content || ' I''ve wouldn''t' else content end"""


@query(
    "t5_expand_contractions",
    sql(
        "raw",
        f"select reviewId, {_contractions_sql('txt')} as expanded from texts",
        texts=f"""select reviewId, {_CONTRACTED} as txt
        from (select *, cast(substr(reviewId, 2) as bigint) as k from raw)""",
    ),
)
def _(spark, sf):
    df = raw(spark, sf).withColumn("k", F.substring("reviewId", 2, 30).cast("bigint"))
    k, c = F.col("k"), F.col("content")
    txt = (
        F.when(k % 3 == 0, F.replace(c, F.lit(","), F.lit(" don't cant its it's")))
        .when(k % 3 == 1, F.concat(F.lit("We're significant visits here: "), c, F.lit(" I've wouldn't")))
        .otherwise(c)
    )
    return df.select("reviewId", t.expand_contractions(txt).alias("expanded"))


@query(
    "t6_stopword_filter",
    sql(
        "reviews",
        f"""select reviewId, array_to_string(list_filter({sql_words("content")},
        lambda x: x not in {_in(STOP)}), ' ') as kept from reviews""",
    ),
)
def _(spark, sf):
    words = F.regexp_extract_all(F.lower("content"), F.lit(WORD + "+"), F.lit(0))
    return reviews(spark, sf).select("reviewId", F.array_join(t.drop_stop_words(words, STOP), " ").alias("kept"))


# A lexicon over the words of the given documents. The frequent words 'the',
# 'la' and 'de' play the negations.
_LEX = """select token, case when token in ('the', 'la') then 'not' when token = 'de' then 'never'
    else regexp_replace(token, 's$', '') end as lemma,
    case when token in ('the', 'la', 'de') then 'PART' else element_at_pos end as pos from (
    select token, case length(token) % 5 when 0 then 'NOUN' when 1 then 'ADJ' when 2 then 'VERB' when 3 then 'ADP'
    else 'PROPN' end as element_at_pos from (select distinct token from word_list))"""


def _lexicon(spark, sf):
    docs = table(spark, sf, "documents")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD + "+"), F.lit(0))).alias("token")).distinct()
    n, token = F.length("token") % 5, F.col("token")
    pos = F.when(n == 0, "NOUN").when(n == 1, "ADJ").when(n == 2, "VERB").when(n == 3, "ADP").otherwise("PROPN")
    negation = token.isin("the", "la", "de")
    lemma = (
        F.when(token.isin("the", "la"), "not").when(token == "de", "never").otherwise(F.regexp_replace(token, "s$", ""))
    )
    return words.select("token", lemma.alias("lemma"), F.when(negation, "PART").otherwise(pos).alias("pos"))


_TAG_CTES = {
    "word_list": f"select unnest({sql_words('text')}) as token from documents",
    "lexicon": _LEX,
    "flat": f"""select reviewId, unnest(toks) as tok, unnest(range(len(toks))) as pos
        from (select reviewId, {sql_words('content')} as toks from reviews)""",
    "tagged": """select f.reviewId, f.pos, f.tok, l.lemma, l.pos as tag,
        lead(l.lemma) over w as next_lemma, lead(l.pos) over w as next_tag, lag(l.lemma) over w as prev_lemma
        from flat f left join lexicon l on f.tok = l.token window w as (partition by f.reviewId order by f.pos)""",
    "emitted": f"""select reviewId, pos, case
        when coalesce(prev_lemma in ('not', 'no', 'never') and tag in ('ADJ', 'VERB'), false) then null
        when lemma in ('not', 'no', 'never') and next_tag in ('ADJ', 'VERB') then 'not_' || next_lemma
        when tok not in {_in(STOP)} and regexp_matches(tok, '^\\p{{L}}+$') and length(lemma) > 1
            and tag in ('NOUN', 'ADJ', 'VERB', 'PROPN') then lemma end as out from tagged""",
}


def _lemmas(spark, sf):
    df = reviews(spark, sf).select(
        "reviewId", F.regexp_extract_all(F.lower("content"), F.lit(WORD + "+"), F.lit(0)).alias("tokens")
    )
    return tok.lemmatise(df, _lexicon(spark, sf), STOP)


@query(
    "t7_negation_merge",
    sql(
        "reviews",
        "select out as term, count(*) as n from emitted where starts_with(out, 'not_') group by out",
        **_TAG_CTES,
    ),
)
def _(spark, sf):
    terms = _lemmas(spark, sf).select(F.explode("lemmas").alias("term"))
    return terms.where(F.startswith("term", F.lit("not_"))).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t8_pos_lemma_filter",
    sql(
        "reviews",
        """select reviewId, coalesce(string_agg(out, ' ' order by pos), '') as lemmas from emitted group by reviewId""",
        **_TAG_CTES,
    ),
)
def _(spark, sf):
    return _lemmas(spark, sf).select("reviewId", F.array_join("lemmas", " ").alias("lemmas"))


_PHRASE_CTES = {
    "docs": f"select reviewId, {sql_words('content')} as toks from reviews",
    "flat": "select reviewId, unnest(toks) as tok, unnest(range(len(toks))) as pos from docs",
    "uni": "select tok, count(*) as n from flat group by tok",
    "seq": "select *, lead(tok) over (partition by reviewId order by pos) as nxt from flat",
    "bi": "select tok as a, nxt as b, count(*) as n_ab from seq where nxt is not null group by all",
    "phrases": """select a, b, n_ab, ua.n as n_a, ub.n as n_b,
        (n_ab - 5)::double * ((select count(*) from uni) + (select count(*) from bi)) / ua.n / ub.n as score
        from bi join uni ua on ua.tok = a join uni ub on ub.tok = b where n_ab >= 5""",
}


def _word_lists(spark, sf):
    return reviews(spark, sf).select(
        "reviewId", F.regexp_extract_all(F.lower("content"), F.lit(WORD + "+"), F.lit(0)).alias("tokens")
    )


@query(
    "t9_phrases",
    sql(
        "reviews",
        "select a, b, n_ab, n_a, n_b, cast(floor(score * 1e6 + 0.5) as bigint) as score_micro from phrases where score > 10",
        **_PHRASE_CTES,
    ),
)
def _(spark, sf):
    p = tok.learn_phrases(saved(_word_lists(spark, sf), "word-lists"))
    return p.select("a", "b", "n_ab", "n_a", "n_b", F.floor(F.col("score") * 1e6 + 0.5).alias("score_micro"))


@query(
    "t10_apply_phrases",
    sql(
        "reviews",
        """select reviewId, string_agg(piece, ' ' order by pos) as merged from (
        select *, case when starts then tok || '_' || nxt when not coalesce(lag(starts) over (partition by reviewId order by pos), false)
            then tok end as piece from placed) where piece is not null group by reviewId""",
        **_PHRASE_CTES,
        flagged="""select s.*, p.a is not null as hit from seq s
            left join (select a, b from phrases where score > 10) p on p.a = tok and p.b = nxt""",
        runs="select *, pos - row_number() over (partition by reviewId, hit order by pos) as run from flagged",
        placed="""select *, hit and (row_number() over (partition by reviewId, hit, run order by pos)) % 2 = 1 as starts
            from runs""",
    ),
)
def _(spark, sf):
    docs = tok.numbered_rows(_word_lists(spark, sf))
    merged = tok.apply_phrases(docs, tok.learn_phrases(docs), row="_row")
    return merged.select("reviewId", F.array_join("tokens", " ").alias("merged"))


@query(
    "t11_vocab_filter",
    sql(
        "reviews",
        """select term, df from (select tok as term, count(distinct reviewId) as df from flat group by tok)
        where df >= 5 and df <= 0.5 * (select count(*) from docs) order by df desc, term limit 100000""",
        docs=_PHRASE_CTES["docs"],
        flat=_PHRASE_CTES["flat"],
    ),
)
def _(spark, sf):
    return tok.vocabulary(_word_lists(spark, sf))


@query("s6_dictionary_sink", sql("reviews", "select count(*) as n_terms, cast(sum(df) as bigint) as total_df from v",
    docs=_PHRASE_CTES["docs"], flat=_PHRASE_CTES["flat"],
    v="""select term, df from (select tok as term, count(distinct reviewId) as df from flat group by tok)
        where df >= 5 and df <= 0.5 * (select count(*) from docs)"""))
def _(spark, sf):
    stored = saved(tok.vocabulary(_word_lists(spark, sf)), "vocabulary")
    return stored.agg(F.count(F.lit(1)).alias("n_terms"), F.sum("df").alias("total_df"))


_LONG = f"list_filter({sql_words('content')}, lambda x: length(x) >= 12)"


@query(
    "t12_join_tokens",
    sql(
        "reviews",
        f"select reviewId, array_to_string(long, ' ') as text_final from (select reviewId, {_LONG} as long from reviews) where len(long) > 0",
    ),
)
def _(spark, sf):
    words = _word_lists(spark, sf).withColumn("tokens", F.filter("tokens", lambda x: F.length(x) >= 12))
    return tok.join_tokens(words).select("reviewId", "text_final")


_COUNTED = f"list_filter({sql_words('content')}, lambda x: length(x) > 2 and x not in {_in(t.COUNT_STOP_WORDS)})"


@query("t13_word_tokens", sql("reviews", f"select reviewId, array_to_string({_COUNTED}, ' ') as words from reviews"))
def _(spark, sf):
    return reviews(spark, sf).select("reviewId", F.array_join(t.word_tokens(F.col("content")), " ").alias("words"))


_REPLY = """'Sure, here you go' || chr(10) || '"' || replace(content, '.', '##') || '" ## ok' || chr(10) || '  Here ends'"""


def _reply():
    c = F.col("content")
    return F.concat(
        F.lit("Sure, here you go\n\""), F.replace(c, F.lit("."), F.lit("##")), F.lit("\" ## ok\n  Here ends")
    )


@query(
    "t14_parse_replies",
    sql(
        "raw",
        f"""select reviewId, unnest(list_filter(list_transform(string_split({_REPLY}, '##'),
        lambda x: {sql_strip('x')}), lambda x: length(x) > 5)) as review from raw""",
    ),
)
def _(spark, sf):
    return raw(spark, sf).select("reviewId", F.explode(t.parse_replies(_reply())).alias("review"))


@query(
    "t15_parse_replies_strict",
    sql(
        "raw",
        f"""select reviewId, unnest(list_transform(list_filter(list_transform(string_split(kept, '##'),
        lambda x: {sql_strip('x')}), lambda x: length(x) > 20), lambda x: replace(x, '"', ''))[1:5]) as review
        from (select reviewId, array_to_string(list_filter(string_split({_REPLY}, chr(10)), lambda s:
            not regexp_matches({sql_strip('s')}, '^(Here|Sure|I''ll|OK|Certainly)')), chr(10)) as kept from raw)""",
    ),
)
def _(spark, sf):
    return raw(spark, sf).select("reviewId", F.explode(t.parse_replies_strict(_reply(), F.lit(5))).alias("review"))


@query(
    "t16_parse_label",
    sql(
        "raw",
        f"""select reviewId, case when {sql_strip('reply')} in ('0', '1', '2') then cast({sql_strip('reply')} as int) else 1 end
        as prediction from (select *, case doc % 6 when 0 then '0' when 1 then ' 1 ' when 2 then '2' || chr(10)
        when 3 then 'Positive' when 4 then content end as reply
        from (select *, cast(substr(reviewId, 2) as bigint) as doc from raw))""",
    ),
)
def _(spark, sf):
    k = F.substring("reviewId", 2, 30).cast("bigint") % 6
    reply = (
        F.when(k == 0, "0").when(k == 1, " 1 ").when(k == 2, "2\n").when(k == 3, "Positive").when(k == 4, F.col("content"))
    )
    return raw(spark, sf).select("reviewId", t.parse_label(reply).alias("prediction"))


@query(
    "t18_split_by_underscore",
    sql("raw", "select distinct lower(split_part(file, '_', 1)) as prefix, file from "
        "(select app || '_' || gender || '_clean.csv' as file from raw)"),
)
def _(spark, sf):
    files = raw(spark, sf).select(F.concat_ws("_", "app", "gender", F.lit("clean.csv")).alias("file")).distinct()
    return files.select(t.file_prefix(F.col("file")).alias("prefix"), "file")


@query(
    "l5_first_k_tokens",
    sql(
        "reviews",
        f"select reviewId, array_to_string(string_split({sql_squeeze('content')}, ' ')[1:8], ', ') as first_words from reviews",
    ),
)
def _(spark, sf):
    return reviews(spark, sf).select("reviewId", t.first_k(F.col("content")).alias("first_words"))


# Word counts. The topic of a review is stood in for by its gender and score.

_TOPIC = "case when score >= 4 then 'high ' || gender else 'low ' || gender end"
_WC = {
    "topical": f"select app, sentiment, {_TOPIC} as topic, {_COUNTED} as toks from reviews",
    "wc": "select app, sentiment, topic, word, count(*) as freq from "
    "(select app, sentiment, topic, unnest(toks) as word from topical) group by all",
}


def _topical(spark, sf):
    level = F.when(F.col("score") >= 4, "high ").otherwise("low ")
    return reviews(spark, sf).withColumn("topic", F.concat(level, F.col("gender")))


@query("a22_word_counts", sql("reviews", "select * from wc", **_WC))
def _(spark, sf):
    return w.word_counts(_topical(spark, sf), ["app", "sentiment", "topic"], "content")


@query(
    "w3_top_words_per_topic",
    sql(
        "reviews",
        """select * exclude (rn) from (select *, row_number() over (partition by app, sentiment, topic
        order by freq desc, word) as rn from wc) where rn <= 50""",
        **_WC,
    ),
)
def _(spark, sf):
    return w.top_words_per_topic(_topical(spark, sf), ["app", "sentiment", "topic"], "content")


_SEGMENT = {
    "sc": """select app, sentiment, word, count(*) as freq from (select app, sentiment,
        unnest(regexp_extract_all(lower(content), '[a-z]{3,}')) as word from reviews) group by all""",
    "sizes": "select app, sentiment, count(*) as n_reviews_in_segment from reviews group by all",
    "top": """select app, sentiment, word, freq, n_reviews_in_segment,
        floor(freq / n_reviews_in_segment * 10000.0::double + 0.5::double) / 10000.0::double as freq_per_review from (
        select *, row_number() over (partition by app, sentiment order by freq desc, word) as rn from sc)
        join sizes using (app, sentiment) where rn <= 30""",
}


@query("w4_top_words_per_segment", sql("reviews", "select * from top", **_SEGMENT))
def _(spark, sf):
    return w.top_words_per_segment(reviews(spark, sf), "content")


_SEGMENTS = [(a, s) for a in APPS for s in ("negative", "neutral", "positive")]


@query(
    "a23_words_pivot",
    sql(
        "reviews",
        "select word, "
        + ", ".join(
            f"""coalesce(sum(freq) filter (app = '{a}' and sentiment = '{s}'), 0)::double as "{a}_{s}" """ for a, s in _SEGMENTS
        )
        + "from top group by word",
        **_SEGMENT,
    ),
)
def _(spark, sf):
    return w.words_pivot(w.top_words_per_segment(reviews(spark, sf), "content"), _SEGMENTS)


@query(
    "d8_worst_words",
    sql(
        "reviews",
        "select word, freq from sc where app = 'AppB' and sentiment = 'negative' order by freq desc, word limit 10",
        **_SEGMENT,
    ),
)
def _(spark, sf):
    return w.worst_words(reviews(spark, sf), "content", "AppB", "negative")
