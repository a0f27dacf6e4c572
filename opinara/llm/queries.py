"""One query for each operator of this subpackage, over its whole table, and the SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinara.llm.common import crc_remainder, table
from opinara.llm.contamination import contamination
from opinara.llm.importance import drawn, importance
from opinara.llm.line_dedup import line_report
from opinara.llm.mixing import mixture
from opinara.llm.neural_lm import language_scores
from opinara.llm.order_minhash import near_duplicates
from opinara.llm.paragraph_dedup import repeated_paragraphs
from opinara.llm.passages import repeated_passages
from opinara.llm.pseudonyms import pseudonymise
from opinara.llm.toxicity import rejected, toxicity, train
from opinara.llm.url_filter import SOFT_TERMS, STRICT_TERMS, Rule, filter_urls
from opinara.llm.vector_links import vector_links
from opinara.llm.warc import frames_of, read_frames, write_bundles
from opinara.llm.word_runs import word_runs

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.col("contamination")
    ids = F.array_join(F.array_sort(F.transform(hit["items"], lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        hit["n_words"].alias("n_words"),
        hit["n_hit"].alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (hit["n_hit"] > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    " '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLE["op4_benchmark_decontamination"] = f"""
with items as (select item_id, {_WORDS} as ws from benchmark),
cuts as (select item_id, ws, least(10, len(ws)) as n, unnest(range(1, greatest(1, len(ws) - 9) + 1)) as s
         from items where len(ws) > 0),
wins as (select distinct item_id, n, array_to_string(ws[s : s + n - 1], ' ') as w from cuts),
docs as (select row_number() over () as k, doc_id, {_WORDS} as ws from documents),
sizes as (select distinct n from wins),
grams as (select k, ws, n, unnest(range(1, len(ws) - n + 2)) as s from docs, sizes where len(ws) >= n),
hits as (select k, s, a.n, item_id from (select k, s, n, array_to_string(ws[s : s + n - 1], ' ') as w from grams) a
         join wins on a.n = wins.n and a.w = wins.w),
pos as (select k, count(distinct p) as n_hit from (select k, unnest(range(s, s + n)) as p from hits) group by k),
own as (select k, count(*) as n_items, string_agg(i, ',' order by i) as ids
        from (select distinct k, cast(item_id as varchar) as i from hits) group by k)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join pos using (k) left join own using (k)"""


@query
def op2_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), key="corpus-2024")


@query
def op1_warc_seekable_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_bundles(table(spark, sf_dir, "pages"))
    records = read_frames(frames_of(spark, index), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op1_warc_seekable_bundles"] = """
with p as (select page_id, coalesce(html, '') as h from pages),
d as (select page_id, h, octet_length(encode(h)) as n, sha1(h) as x from p),
bits as (select *, max(page_id) over (partition by h) as top from d),
b32 as (select x, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        cast(('0x' || substr(x, 1 + 5 * (k // 4), 5))::bigint // power(32, 3 - k % 4)::bigint % 32 as int) + 1, 1), '' order by k) as b
        from (select distinct x from d), range(32) t(k) group by x)
select page_id, n as payload_bytes, b as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from bits join b32 using (x)"""


@query
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder("doc_id", 5) == 0
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out))
    scored = toxicity(docs, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        rejected(model).alias("rejected"),
    )


@query
def op7_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines of 40 words and more by number, and repeated passages inside and across lines by words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = repeated_paragraphs(docs).select("doc_id", "paragraph", "first_doc_id", "first_paragraph", "members", "removed")
    passages = repeated_passages(docs).select("doc_id", "from_word", "to_word", "first_doc_id", "first_word", "members", "removed")
    return lines.unionByName(passages, allowMissingColumns=True)


@query
def op9_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "copy", "position")


@query
def op8_log_bilinear_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return language_scores(docs, held_out=crc_remainder("doc_id", 7) == 2)


@query
def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


ORACLE["op5_nn_descent"] = """
with recursive v as (select row_number() over () as k, vec_id, embedding::double[] as e from embeddings),
ok as (select k, vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as n from v
       where e is not null and len(e) > 0 and list_count(e) = len(e)
         and len(list_filter(e, lambda x: not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.k as a, b.k as b, b.vec_id as other from ok a join ok b on a.k <> b.k and len(a.e) = len(b.e)
          where list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
reach as (select k as a, k as b from v union select r.a, l.b from reach r join links l on r.b = l.a),
comps as (select r.a as k, min(v.vec_id) as component_id from reach r join v on v.k = r.b group by 1),
degrees as (select a as k, count(*) as n_links from links group by 1)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from v join comps using (k) left join degrees using (k)"""


# CRC-32 in SQL: its table, and the sum over a list of byte values named {bytes}.
_CRC_TABLE = """crc_steps(i, k, c) as (select i, 0, i::bigint from range(256) r(i) union all
    select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_steps where k < 8),
crc as (select list(c order by i) as tab from crc_steps where k = 8)"""
_CRC = (
    "xor(list_reduce({bytes}, lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8), 4294967295::bigint), 4294967295::bigint)"
)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): one document in ten, by the CRC-32 of its id, repeats itself from some word on."""
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    n = F.size(words)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    chosen = (h % 10 == 0) & F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    return docs.select("doc_id", F.when(chosen, planted).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")))
    at = F.col("word_runs")
    runs = at["runs"]
    # The longest run; of equal ones the first in the list, which is sorted by start, then period.
    best = F.aggregate(runs, F.get(runs, F.lit(0)), lambda x, r: F.when(r["length"] > x["length"], r).otherwise(x))
    lines = F.transform(runs, lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(best["length"] * 1000 / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(at["collapsed"], 256).alias("collapsed_sha256"),
    )


ORACLE["op11_periodic_runs"] = f"""
with recursive {_CRC_TABLE},
raw as (select row_number() over () as k, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as ws from documents),
keyed as (select *, {_CRC.format(bytes="list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::bigint)")} as h,
    len(ws) as n from raw, crc),
cuts as (select *, (h // 10) % n as a from keyed),
steps as (select *, 1 + (n - a) // (3 + (h // 10) % 8) as p from cuts),
docs as (select k, doc_id, n, case when h % 10 = 0 and n > 0 then
    list_transform(range(n), lambda i: ws[case when i < a then i else a + (i - a) % p end + 1]) else ws end as ws from steps),
grams as (select k, s, hash(array_to_string(ws[s + 1 : s + 6], ' ')) as g from (select k, ws, unnest(range(n - 5)) as s from docs)),
equal as (select x.k, x.s, y.s - x.s as q from grams x join grams y on x.k = y.k and x.g = y.g and x.s < y.s),
islands as (select k, q, min(s) as start, count(*) + 5 + q as length
    from (select *, s - row_number() over (partition by k, q order by s) as island from equal) group by k, q, island),
runs as (select k, start, length, min(q) as period from islands where length >= greatest(12, 2 * q) group by all),
dropped as (select distinct k, unnest(range(start + period, start + length)) as i from runs),
words as (select k, unnest(range(n)) as i, unnest(ws) as w from docs),
kept as (select k, string_agg(w, ' ' order by i) as text from words anti join dropped using (k, i) group by k),
listed as (select k, count(*) as n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as t,
    first(struct_pack(s := start, l := length, p := period) order by length desc, start, period) as best from runs group by k)
select doc_id, coalesce(n_runs, 0) as n_runs, best.s as start, best.l as length, best.p as period,
  1000 * best.l // best.p as exponent_milli, sha256(coalesce(t, '')) as runs_sha256, sha256(coalesce(text, '')) as collapsed_sha256
from docs left join listed using (k) left join kept using (k)"""


#: The rules of the query.
URL_RULES = (
    Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@query
def op12_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    at = F.col("url_filter")
    terms = F.array_join(F.array_sort(F.concat(at["strict"], at["soft"])), ",")
    return judged.select(
        "page_id", at["host"].alias("host"), at["path"].alias("path"), at["rule"].alias("rule"), at["verdict"].alias("verdict"),
        terms.alias("terms"),
    )


_TERMS = ", ".join([f"('{t}', true)" for t in STRICT_TERMS] + [f"('{t}', false)" for t in SOFT_TERMS])
_EDGE = "[^0-9a-z\\x{80}-\\x{10FFFF}]"

ORACLE["op12_url_vocabulary"] = f"""
with terms(term, strict) as (values {_TERMS}),
u as (select row_number() over () as k, page_id, coalesce(url, '') as url from pages),
low as (select *, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as l,
    regexp_extract(url, '(?s)://([^/?#]*)([^?#]*)', 2) as path from u),
parts as (select *, regexp_extract(l, '(?s)://([^/?#]*)', 1) as host, regexp_replace(l, '%[0-9a-f][0-9a-f]', '   ', 'g') as scan from low),
hits as (select k, string_agg(term, ',' order by term) as terms, bool_or(strict) or count(*) >= 2 as rejected
    from parts join terms on regexp_matches(scan, '(^|{_EDGE})' || term || '($|{_EDGE})') group by k),
ruled as (select *, case
    when ('.' || host) like '%.example.net' and path like '/en/%' then 'example.net/en/'
    when ('.' || host) like '%.example.com' and path like '/de/%' then 'example.com/de/'
    when ('.' || host) like '%.org' and path like '/fr/%' then 'org/fr/'
    when ('.' || host) like '%.net' and path like '/%' then 'net/' end as rule from parts)
select page_id, host, path, rule, case when rule in ('example.net/en/', 'org/fr/') then 'allow'
    when rule is not null then 'block' when coalesce(rejected, false) then 'block' else 'allow' end as verdict,
  coalesce(terms, '') as terms
from ruled left join hits using (k)"""


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = importance(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    at = F.col("importance")
    return drawn(scored.select("doc_id", "importance")).select(
        "doc_id", *[at[c].alias(c) for c in ("n_features", "weight", "score", "rank")]
    )


ORACLE["op13_importance_resampling"] = f"""
with recursive {_CRC_TABLE},
docs as (select row_number() over () as k, doc_id, {_WORDS} as ws from documents),
items as (select unnest({_WORDS}) as w from benchmark),
flat as (select k, unnest(ws) as w from docs),
vocabulary as (select w, hex(encode(w)) as x from (select w from flat union select w from items)),
hashed as (select w, {_CRC.format(bytes="list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)")} % 10000 as b
    from vocabulary, crc),
source as (select b, count(*) as n from flat join hashed using (w) group by b),
target as (select b, count(*) as n from items join hashed using (w) group by b),
totals as (select (select count(*) from flat)::double as s, (select count(*) from items)::double as t),
gains as (select b, floor(1000 * ln(((coalesce(target.n, 0) + 1) * (s + 10000)) / ((source.n + 1) * (t + 10000))))::bigint as gain
    from source left join target using (b), totals),
weights as (select k, sum(gain)::bigint as w from flat join hashed using (w) join gains using (b) group by k),
scored as (select k, doc_id, len(ws)::bigint as n_features, coalesce(w, 0) as weight,
    ('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint as h from docs left join weights using (k)),
final as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from scored),
ranks as (select k, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from final where n_features >= 20)
select doc_id, n_features, weight, score, case when r <= 10 * n // 100 then r end as rank
from final left join ranks using (k)"""
