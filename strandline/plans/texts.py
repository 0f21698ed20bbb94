"""Queries over documents, titles, abstracts, quotations and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import keys, text
from strandline.operators import documents as docs, relational as rel, similarity
from strandline.plans.registry import Registry
from strandline.session import cut, table
from strandline.streaming import ledgers

query = Registry()
_KEY = "coalesce(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]', '', 'g'), '')"
_FOLD = "regexp_replace(lower(regexp_replace(regexp_replace({c}, '</?[A-Za-z][A-Za-z0-9]*(\\s[^<>\\n]{{0,120}})?/?>', ' ', 'g'), '\\\\(mathrm|mathbf|text|textit|mathit|operatorname|mu|pm|times|cdot|circ|sim|approx|le|ge|leq|geq|,|;|!| )', ' ', 'g')), '[^a-z0-9]', '', 'g')"


@query(f"select entry_id, {_KEY.format(c='title')} as title_key, coalesce(regexp_replace(lower(strip_accents(authors[1].family)), '[^a-z]', '', 'g'), '') as slug from manifest")
def q_title_key(spark: SparkSession, d: str) -> DataFrame:
    """Comparison keys of titles and first authors."""
    return table(spark, d, "manifest").select("entry_id", text.title_key(F.col("title")).alias("title_key"), text.name_slug(F.get("authors.family", F.lit(0))).alias("slug"))


_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


_WORDS = "regexp_extract_all(strip_accents(title), '[A-Za-z0-9]+')"
_CASED = f"(case when upper(strip_accents(title)) = strip_accents(title) and regexp_matches(strip_accents(title), '[A-Z]') then list_transform({_WORDS}, lambda x: upper(x[1]) || lower(x[2:])) else {_WORDS} end)"
_KEPT = f"(case when len(list_filter({_CASED}, lambda x: lower(x) not in ({_STOP}))) > 0 then list_filter({_CASED}, lambda x: lower(x) not in ({_STOP})) else {_CASED} end)[1:8]"
_COMPACT = f"array_to_string(list_transform({_KEPT}, lambda x: case when upper(x) = x and regexp_matches(x, '[A-Z]') and length(x) <= 6 then x else upper(x[1]) || x[2:] end), '')"


@query(f"select entry_id, {_COMPACT} as compact from manifest where title is not null")
def q_compact_title(spark: SparkSession, d: str) -> DataFrame:
    """CamelCase short titles; those all in capitals are set in title case first."""
    return table(spark, d, "manifest").where("title is not null").select("entry_id", text.compact_title(F.col("title")).alias("compact"))


@query("""
with m as (select entry_id, lower(regexp_replace(doi, '^[\\s\\x{00a0}]+|[\\s\\x{00a0}]+$', '', 'g')) as k from manifest),
a as (select entry_id, regexp_replace(regexp_replace(regexp_replace(translate(k, 'DASHES', 'HYPHENS'), '[).,;:''"\\]}>]+$', ''), '[\\s\\x{00a0}]+', '', 'g'), '(received|accepted|published|available|downloaded|http).*$', '') as k from m),
b as (select entry_id, regexp_replace(k, '\\.$', '') as k from a)
select entry_id, case when not starts_with(k, '10.1016/j.brs.0000') and regexp_matches(k, '^10\\.[0-9]{4,9}/\\S+$') and length(k) >= 12 then k end as clean from b
""".replace("DASHES", text.DASHES).replace("HYPHENS", "-" * len(text.DASHES)))
def q_clean_key(spark: SparkSession, d: str) -> DataFrame:
    """Keys in canonical form, null where there is none."""
    return table(spark, d, "manifest").select("entry_id", keys.clean_key(F.col("doi")).alias("clean"))


@query("select doc_id, len(regexp_extract_all(text, '[0-9]+ kHz')) as n_frequencies, text is not null and regexp_matches(text, '(?i)sham|placebo') as has_control from documents")
def q_pattern_counts(spark: SparkSession, d: str) -> DataFrame:
    """Pattern counts and predicates over whole texts."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.regexp_count(t, F.lit("[0-9]+ kHz")).alias("n_frequencies"), F.coalesce(t.rlike("(?i)sham|placebo"), F.lit(False)).alias("has_control"))


_ENT = "regexp_replace(text, '<[^<>]*>', ' ', 'g')"
for _e, _c in text.ENTITIES:
    _ENT = "replace({}, '{}', '{}')".format(_ENT, _e, _c.replace("'", "''"))


_WS = r"\t\n\x0b\f\r \x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@query(f"select abstract_id, trim(regexp_replace({_ENT}, '[{_WS}]+', ' ', 'g')) as body from abstracts")
def q_html_text(spark: SparkSession, d: str) -> DataFrame:
    """Abstracts without markup, entities decoded, white space squeezed."""
    return table(spark, d, "abstracts").select("abstract_id", text.strip_markup(F.col("text")).alias("body"))


@query("""
with w as (select lang, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) as word from documents where lang is not null and text is not null),
c as (select lang, word, count(*) as n from w where word not in (STOP) group by all)
select lang, word, n from (select *, row_number() over (partition by lang order by n desc, word) as r from c) where r <= 20
""".replace("STOP", ", ".join(f"'{w}'" for w in text.BAG_STOP_WORDS)))
def q_word_bag(spark: SparkSession, d: str) -> DataFrame:
    """The 20 most frequent words per label, stop words left out."""
    w = table(spark, d, "documents").where("lang is not null").select("lang", F.explode(text.word_bag(F.col("text"), text.BAG_STOP_WORDS)).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return w.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where("r <= 20").drop("r")


@query(r"select doc_id from documents where length(regexp_replace(text, '\PL', '', 'g')) > 25 and length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > 0.9 * length(regexp_replace(text, '\PL', '', 'g'))")
def q_all_caps(spark: SparkSession, d: str) -> DataFrame:
    """Texts set in capitals."""
    return table(spark, d, "documents").where(text.is_all_caps(F.col("text"))).select("doc_id")


_RULES = [
    ("no_title", "title is null or trim(title) = ''"),
    ("no_key", "doi is null or not contains(doi, '10.')"),
    ("reply", "regexp_matches(title, '(?i)^\\s*(re:|response|reply|comment|correction|erratum)')"),
    ("preprint", "preprint.doi is not null"),
    ("meeting", "record_class = 'conference_abstract'"),
    ("deferred", "body is null or trim(body) = ''"),
    ("on_topic", "regexp_matches(body, '(?i)ultraso|sonicat|acoustic') and regexp_matches(body, '(?i)cortex|nerve|neur|brain|thalam')"),
    ("modality_only", "regexp_matches(body, '(?i)ultraso|sonicat|acoustic')"),
]


@query(
    "with a as (select citekey, min(text) as body from abstracts where citekey is not null group by citekey), m as (select manifest.*, body from manifest left join a using (citekey)) select outcome, count(*) as n from (select case "
    + " ".join(f"when {t} then '{n}'" for n, t in _RULES)
    + " else 'off_topic' end as outcome from m) group by outcome"
)
def q_cascade_counts(spark: SparkSession, d: str) -> DataFrame:
    """An ordered cascade of rules over entries and abstracts, counted by outcome; missing
    evidence defers before any rule looks at it."""
    a = table(spark, d, "abstracts").where("citekey is not null").groupBy("citekey").agg(F.min("text").alias("body"))
    m = table(spark, d, "manifest").join(a, "citekey", "left")
    rules = [(F.expr(t.replace("regexp_matches(", "regexp_like(").replace("\\s", "\\\\s")), n) for n, t in _RULES]
    return m.select(rel.cascade(rules, "off_topic").alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_SIGNALS = [("stimulation", "stimulat|neuromodulat"), ("imaging", "imaging|fmri|magnetic resonance"), ("sham", "sham|placebo"), ("animal", "\\b(mice|rats|macaques|sheep|pigs)\\b"), ("clinical", "patients|clinical")]


@query("select entry_id, signal from (select entry_id, unnest([" + ", ".join(f"case when regexp_matches(lower(translate(title, '{text.DASHES}', '{'-' * len(text.DASHES)}')), '{p}') then '{n}' end" for n, p in _SIGNALS) + "]) as signal from manifest) where signal is not null")
def q_multi_label_scan(spark: SparkSession, d: str) -> DataFrame:
    """One row per entry and signal that its title carries."""
    t = F.lower(text.fold_dashes(F.col("title")))
    return rel.signals(table(spark, d, "manifest"), [(n, t.rlike(p)) for n, p in _SIGNALS], ["entry_id"])


@query("""
with s as (select entry_id, signal from (select entry_id, unnest([case when contains(lower(title), 'patients') then 'clinical' end, case when contains(lower(title), 'rats') then 'animal' end]) as signal from manifest) where signal is not null),
k as (select distinct entry_id from manifest where screening.reason is not null)
select signal, entry_id in (select entry_id from k) as acknowledged, count(*) as n from s group by all
""")
def q_ack_split(spark: SparkSession, d: str) -> DataFrame:
    """Flags split by whether the entry's screening gives a reason."""
    m = table(spark, d, "manifest")
    t = F.lower("title")
    s = rel.signals(m, [("clinical", F.contains(t, F.lit("patients"))), ("animal", F.contains(t, F.lit("rats")))], ["entry_id"])
    return rel.split_acknowledged(s, m.where("screening.reason is not null"), ["entry_id"]).groupBy("signal", "acknowledged").agg(F.count(F.lit(1)).alias("n"))


@query("""
with p as (select citekey, greatest(0, coalesce(page_no, 0)) as page, string_agg(text, chr(10) || chr(10) order by doc_id) as t from documents where citekey is not null and text <> '' group by all),
f as (select citekey, z, unnest(range(0, z + 1)) as page from (select citekey, max(page) as z from p group by citekey))
select f.citekey, cast(f.page // 100 as bigint) as chunk_no, cast(min(f.page) as int) as first_page, cast(count(*) as int) as n_pages,
  md5(replace(string_agg(coalesce(t, '') || chr(10), chr(12) order by f.page), chr(173), '')) as text_md5
from f left join p on p.citekey = f.citekey and p.page = f.page group by f.citekey, f.page // 100
""")
def q_page_assembly(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a document as blocks of its pages, in pieces of 100 pages from page 0 on."""
    got = docs.assemble(table(spark, d, "documents").select("citekey", "page_no", "doc_id", "text"), "citekey", "page_no", "doc_id", "text")
    return got.select("citekey", "chunk_no", "first_page", "n_pages", F.md5("text").alias("text_md5"))


@query("""
with t as (select doc_id, coalesce(text, '') as t, replace(coalesce(text, ''), chr(12), '') as f from documents),
q as (select *, length(trim(f)) as n, string_split(t, chr(12)) as pages,
  list_transform(regexp_extract_all(f, '(?m)^(#+ +)?([0-9]{1,2}\\.[0-9]{1,2})\\s+[A-Za-z]', 2), lambda s: [cast(split_part(s, '.', 1) as int), cast(split_part(s, '.', 2) as int)]) as v from t)
select doc_id, case when n < 500 then 'too_short' else array_to_string(list_filter([
  case when len(pages) > 2 and len(list_filter(pages, lambda p: length(trim(p)) < 40)) > 0.25 * len(pages) then 'thin_pages' end,
  case when len(list_filter(range(2, len(v) + 1), lambda i: v[i] < v[i - 1])) > 0 then 'section_order' end,
  case when contains(f, chr(173)) then 'soft_hyphens' end,
  case when not regexp_matches(f, '(?m)^#{1,6}\\s') and not (contains(f, '<table') and length(f) < 8000) then 'no_headings' end], lambda x: x is not null), ',') end as warnings
from q
""")
def q_doc_quality_gate(spark: SparkSession, d: str) -> DataFrame:
    """Warnings about every text."""
    got = table(spark, d, "documents").select("doc_id", docs.quality(F.col("text")).alias("w"))
    return got.select("doc_id", F.array_join("w", ",").alias("warnings"))


@query("""
with l as (select doc_id, list_transform(regexp_extract_all(text, '(?m)^(#+ +)?([0-9]{1,2}\\.[0-9]{1,2})\\s+[A-Za-z]', 2), lambda s: [cast(split_part(s, '.', 1) as int), cast(split_part(s, '.', 2) as int)]) as v from documents where text is not null)
select doc_id, len(v) as n_sections, len(list_filter(range(2, len(v) + 1), lambda i: v[i] < v[i - 1])) as n_inversions from l where len(v) > 0
""")
def q_inversions(spark: SparkSession, d: str) -> DataFrame:
    """Numbered headings that are followed by a smaller number."""
    t = F.col("text")
    n = F.size(F.regexp_extract_all(t, F.lit(r"(?m)^(?:#+ +)?([0-9]{1,2}\.[0-9]{1,2})\s+[A-Za-z]"), 1))
    return table(spark, d, "documents").where(t.isNotNull()).select("doc_id", n.alias("n_sections"), docs.section_inversions(t).alias("n_inversions")).where("n_sections > 0")


_QF = _FOLD.format(c="quote")


@query(f"""
with q as (select record_id, citekey, unnest(map_keys(provenance.source_quotes)) as path, unnest(map_values(provenance.source_quotes)) as quote from papers),
t as (select citekey, {_FOLD.format(c='min(text)')} as k from abstracts where citekey is not null and text is not null group by citekey),
p as (select record_id, path, k, list_filter(list_transform(regexp_split_to_array(quote, '\\[\\s*(?:\\.\\.\\.|\\x{{2026}})\\s*\\]|\\.\\.\\.|\\x{{2026}}'), lambda s: {_FOLD.format(c='s')}), lambda s: s <> '') as parts from q left join t using (citekey))
select record_id, path, case when k is null then null when len(parts) > 1 then len(list_filter(parts, lambda s: length(s) < 8 or not contains(k, s))) = 0
  when len(parts) = 1 and length(parts[1]) >= 12 then contains(k, parts[1]) or
    (case when length(parts[1]) // 3 >= 10 and contains(k, substring(parts[1], 1, length(parts[1]) // 3)) then 1 else 0 end
   + case when length(parts[1]) // 3 >= 10 and contains(k, substring(parts[1], length(parts[1]) // 3 + 1, length(parts[1]) // 3)) then 1 else 0 end
   + case when length(parts[1]) - 2 * (length(parts[1]) // 3) >= 10 and contains(k, substring(parts[1], 2 * (length(parts[1]) // 3) + 1)) then 1 else 0 end) >= 2
  else false end as found from p
""")
def q_quotes(spark: SparkSession, d: str) -> DataFrame:
    """Quotations of the records, looked for in the abstract of the same key."""
    q = table(spark, d, "papers").select("record_id", "citekey", F.explode("provenance.source_quotes").alias("path", "quote"))
    t = table(spark, d, "abstracts").where("citekey is not null").select("citekey", "text")
    return docs.quotes_checked(q, t, "citekey").select("record_id", "path", "found")


@query("""
with a as (select citekey, lower(strip_accents(min(text))) as body from abstracts where citekey is not null and text is not null group by citekey),
w as (select entry_id, body, list_distinct(regexp_extract_all(lower(strip_accents(title)), '[a-z]{4,}')) as ws from manifest join a using (citekey) where title is not null)
select entry_id, case when length(body) < 200 then true else coalesce(len(list_filter(ws, lambda x: contains(body, x))) / nullif(len(ws), 0) >= 0.4, true) end as matches from w
""")
def q_title_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Does the abstract hold the words of the title?"""
    a = table(spark, d, "abstracts").where("citekey is not null and text is not null").groupBy("citekey").agg(F.min("text").alias("body"))
    m = table(spark, d, "manifest").where("title is not null").join(a, "citekey")
    return m.select("entry_id", text.title_words_found(F.col("title"), F.col("body")).alias("matches"))


@query(f"select abstract_id, md5(trim(regexp_replace(text, '[{_WS}]+', ' ', 'g'))) as text_md5 from abstracts where text is not null")
def q_inverted_index(spark: SparkSession, d: str) -> DataFrame:
    """Texts to inverted indexes and back: equal to the squeezed text."""
    got = docs.inverted(table(spark, d, "abstracts"), "abstract_id", "text")
    return got.select("abstract_id", F.md5(text.restore_inverted(F.col("index"))).alias("text_md5"))


_TOK = "list_sort(list_distinct(list_concat(list_filter(regexp_extract_all(lower(strip_accents(title)), '[a-z0-9]+'), lambda w: length(w) > 2), ['@' || regexp_replace(lower(strip_accents(authors[1].family)), '[^a-z]', '', 'g')])))"


def _titles(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    m = table(spark, d, "manifest").where("title is not null and size(authors) > 0 and authors[0].family is not null")
    words = F.filter(F.regexp_extract_all(F.lower(text.strip_accents(F.col("title"))), F.lit("([a-z0-9]+)"), 1), lambda w: F.length(w) > 2)
    tokens = F.concat(words, F.array(F.concat(F.lit("@"), text.name_slug(F.get("authors.family", F.lit(0))))))
    return similarity.set_join(m, "entry_id", tokens, 0.85)


@query(f"""
with s as (select entry_id, {_TOK} as s from manifest where title is not null and len(authors) > 0 and authors[1].family is not null),
c as (select s, min(entry_id) as class_id from s group by s),
l as (select a.class_id as a, b.class_id as b from c a join c b on a.class_id < b.class_id and least(len(a.s), len(b.s)) >= 0.85 * greatest(len(a.s), len(b.s)) where len(list_intersect(a.s, b.s)) >= 0.85 * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))) - 1e-9),
n as (select x, count(*) as n from (select a as x from l union all select b from l) group by x)
select entry_id, class_id, coalesce(n.n, 0) as n_links from s join c using (s) left join n on n.x = class_id
""")
def q_title_links(spark: SparkSession, d: str) -> DataFrame:
    """Entries with their class of equal title and first author, and the class's similar ones."""
    members, links = _titles(spark, d)
    return similarity.link_counts(members, links, "entry_id")


@query()
def q_ratio_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Titles of the same first author within three years whose sequence ratio is 0.85 or more,
    and their agreement; errata, conference abstracts and letters, which share their parent's
    title, and entries without a key are left out, as in the reference."""
    parts = F.coalesce(F.col("record_class").isin("erratum", "conference_abstract", "letter_commentary"), F.lit(False))
    m = table(spark, d, "manifest").where("doi <> ''").where(~parts)
    m = m.select("entry_id", "title", "year", F.lower(F.get("authors.family", F.lit(0))).alias("author"), text.title_key(F.col("title")).alias("key"))
    got = cut(similarity.author_pairs(m, "entry_id", "author", "key", "year"))
    a, b = m.select(F.col("entry_id").alias("a"), F.col("title").alias("ta")), m.select(F.col("entry_id").alias("b"), F.col("title").alias("tb"))
    agreement = text.title_agreement(F.col("ta"), F.col("tb"), F.col("ratio"))
    return got.join(a, "a").join(b, "b").select("a", "b", "rows_a", "rows_b", F.round("ratio", 6).alias("ratio"), F.round(agreement, 6).alias("agreement"))


@query("""
with e as (select citekey, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]{3,}'))) as w from abstracts where citekey is not null and length(text) > 0),
p as (select citekey, first(w order by len(w), w) as a, last(w order by len(w), w) as b, count(*) as n from e group by citekey having count(*) > 1)
select citekey, round(len(list_intersect(a, b)) / nullif(least(len(a), len(b)), 0), 6) as overlap from p
""")
def q_overlap_coeff(spark: SparkSession, d: str) -> DataFrame:
    """Overlap of the words of the shortest and longest text fetched for a key."""
    e = table(spark, d, "abstracts").where("citekey is not null and length(text) > 0").select("citekey", F.array_sort(F.array_distinct(text.word_bag(F.col("text")))).alias("w"))
    s = F.struct(F.size("w").alias("n"), "w")
    p = e.groupBy("citekey").agg(F.min(s).alias("a"), F.max(s).alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return p.select("citekey", F.round(similarity.overlap_coefficient(F.col("a.w"), F.col("b.w")), 6).alias("overlap"))


@query("""
with q as (select vec_id, embedding from embeddings where vec_id % 50 = 0),
s as (select q.vec_id as query, e.vec_id as neighbour, list_cosine_similarity(q.embedding::double[], e.embedding::double[]) as c from q join embeddings e on e.vec_id <> q.vec_id)
select query, neighbour, round(c, 6) as cosine from (select *, row_number() over (partition by query order by round(c, 9) desc, neighbour) as r from s) where r = 1
""")
def q_vector_cosine(spark: SparkSession, d: str) -> DataFrame:
    """Nearest other vector of every vector whose id is divisible by 50."""
    got = similarity.nearest(table(spark, d, "embeddings"), "vec_id", "embedding", F.col("k") % 50 == 0)
    return got.select("query", "neighbour", F.round("cosine", 6).alias("cosine"))


_STREAM = """
with s as (select user_id, ts, event_id, event_type, lag(event_type) over (partition by user_id order by ts, event_id) as prev from events where user_id is not null and event_type is not null)
select user_id, arg_max(event_type, (ts, event_id)) as event_type, count(*) filter (prev <> event_type) as n_replaced from s group by user_id
"""


@query(_STREAM)
def q_event_history(spark: SparkSession, d: str) -> DataFrame:
    """Current state and number of changes per user, in batch."""
    e = table(spark, d, "events").where("event_type is not null").select("user_id", "ts", "event_id", "event_type")
    return rel.current_with_history(e, "user_id", ["ts", "event_id"], ["event_type"]).select("user_id", "event_type", "n_replaced")


@query(_STREAM)
def q_stream_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The same from a stream with keyed state."""
    out = ledgers.drain(ledgers.history(ledgers.source(spark, d, "events")), "update")
    return rel.last_wins(out, "user_id", ["_batch"]).select("user_id", "event_type", "n_replaced")


@query("""
with e as (select user_id, ts, case when ts <= lag(ts) over w + interval 30 minute then 0 else 1 end as new from events where ts is not null window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(new) over (partition by user_id order by ts rows unbounded preceding) as no from e)
select user_id, min(ts) as "start", max(ts) + interval 30 minute as "end", count(*) as n from s group by user_id, no
""")
def q_stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Session windows of a stream at its end, those included that no later event has closed."""
    out = ledgers.drain(ledgers.sessions(ledgers.source(spark, d, "events")), "complete")
    last = out.agg(F.max("_batch").alias("_batch"))
    got = out.join(F.broadcast(last), "_batch").drop("_batch")  # one row
    return got.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("select user_id, min(event_id) as first_id from (select *, row_number() over (partition by user_id order by ts, event_id) as r from events where user_id is not null) where r = 1 group by user_id")
def q_event_first(spark: SparkSession, d: str) -> DataFrame:
    """The first event of every user."""
    return rel.first_wins(table(spark, d, "events").select("user_id", "ts", "event_id"), "user_id", ["ts", "event_id"]).select("user_id", F.col("event_id").alias("first_id"))
