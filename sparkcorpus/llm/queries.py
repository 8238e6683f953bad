"""The operators of this subpackage as registered queries over the given tables, next to the same question in SQL where
SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkcorpus.llm import conversation_trie, decontamination, embedding_dedup, html_extraction, lm_scoring, quality_classifier, quality_rules, simhash_dedup, source_mixing, spelling_variants, suffix_dedup, token_rollups, warc_dedup
from sparkcorpus.llm.common import save, word_count
from sparkcorpus.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


MIX_WEIGHTS, MIX_SHARE, MIX_MOST, MIX_SEED = (5, 2, 1), 1.5, 2.0, 17
SYMBOLS = "#*$%&|<>"


def mix_quality(text: str = "text"):
    """The share of a text's characters that are no mark-up symbols."""
    chars = F.length(text)
    return F.when(chars > 0, F.length(F.translate(text, SYMBOLS, "")) / chars)


def mixed(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return source_mixing.mix(docs, word_count("text"), mix_quality(), MIX_WEIGHTS, MIX_SHARE, MIX_MOST, MIX_SEED, keep=keep)


MIX_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         -ln((('0x' || md5('17|' || coalesce(doc_id::varchar, 'null'))[1:13])::bigint + 1) / 4503599627370497.0)
           / greatest(coalesce(length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) / nullif(length(text), 0)::double, 0.001), 0.001) as k
  from documents),
s as (select source, sum(size)::double as size, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as w
      from d group by source),
r as (select *, 2 * size / w as ratio from s),
l as (select a.ratio, (select 1.5 * sum(size) from s) as whole,
             coalesce((select sum(2 * size) from r b where b.ratio < a.ratio), 0) as capped,
             (select sum(w) from r b where b.ratio >= a.ratio) as free from r a),
level as (select arg_min((whole - capped) / free, ratio) as lvl from l where (whole - capped) / free <= ratio),
t as (select source, size::bigint as source_size, least(2 * size, lvl * w) as target from s, level),
e as (select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as epochs from t),
o as (select d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size as rest,
             coalesce(sum(d.size) over (partition by d.source order by d.k, d.doc_id rows between unbounded preceding and 1 preceding), 0) as before
      from d join e on d.source is not distinct from e.source)
select doc_id, size, source_size, target,
       (size * (epochs + case when before + size / 2.0 <= rest and size > 0 then 1 else 0 end))::bigint as taken
from o
"""


@query(MIX_SQL)
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document does a mix of all sources by weight 5, 2, 1 take?"""
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed(table(spark, sf_dir, "documents"), ["doc_id"]).select("row.doc_id", "size", "source_size", "target", taken)


WARC_SQL = """
with p as (select page_id, sha1(coalesce(html, '')) as digest, strlen(coalesce(html, ''))::bigint as size from pages),
o as (select digest, size, max(page_id) as original, count(*) as n from p where size >= 1000 group by digest, size)
select page_id, p.size as payload_bytes, p.digest as payload_digest,
       case when original is null or page_id is not distinct from original then 'response' else 'revisit' end as record_type,
       case when original is not null and page_id is distinct from original then original end as refers_to, true as intact
from p left join o on p.digest = o.digest and p.size = o.size and o.n > 1
"""


@query(WARC_SQL)
def op2_warc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records does an archive of all pages hold, with equal payloads stored once?"""
    return warc_dedup.archive_pages(table(spark, sf_dir, "pages"), fresh_path(spark, "archive"))


@query()
def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents are near-duplicates, by fingerprints that differ in three bits or fewer?"""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents repeat themselves too much, and by how much?"""
    found = table(spark, sf_dir, "documents").select("doc_id", quality_rules.repetition("text").alias("r"))
    return found.select("doc_id", "r.*").drop("dup_ngram_chars")


@query()
def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely is each document under a unigram and an attention model of the training documents?"""
    return lm_scoring.score(table(spark, sf_dir, "documents"))


@query()
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is the main text of each page, by the consensus of its host?"""
    found = html_extraction.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


@query()
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the 400-byte strings that occur twice in the corpus?"""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    found = suffix_dedup.remove_repeats(docs, keep=["doc_id", "sha256"], in_place=True)
    digest = F.coalesce(F.sha2("kept", 256), F.col("row.sha256")).alias("kept_sha256")
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", digest)


@query()
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How good is each document, and is it toxic, by text and metadata classifiers that taught each other?"""
    names = ["quality", "toxic"]
    views = quality_classifier.document_views(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), names, in_place=True)
    models = quality_classifier.fit_views(views, names)
    scored = views.select(F.col("id").alias("doc_id"), quality_classifier.view_scores(models).alias("s"))
    scored = scored.select("doc_id", F.col("s.quality").alias("quality_score"), F.col("s.toxic").alias("toxic_score"))
    toxic = F.col("toxic_score") >= 0.5
    return scored.withColumns({"toxic": toxic, "kept": (F.col("quality_score") >= 0.5) & ~toxic})


ROLLUP_SQL = r"""
with d as (
  select doc_id, source, lang, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as words,
         coalesce(len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 0)::bigint as bare,
         coalesce(strlen(text), 0)::bigint as bytes from documents),
live as (
  select source, lang, 'words' as version, case when lang = 'en' then words else bare end as n from d where words >= 50
  union all select source, lang, 'bytes', bytes from d where words >= 50
  union all select 'returned', lang, 'words', words from d where words < 50 and words >= 20)
select source, lang, version, count(*) as n_docs, sum(n)::bigint as n_tokens from live group by source, lang, version
"""


@query(ROLLUP_SQL)
def op9_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens has each source and language by tokenizer, after inserts, revisions, deletions and repeats of
    the documents' counts?"""
    count = [word_count("text").alias("words"), decontamination.word_count("text").alias("bare"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")]
    docs = save(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", *count), "token-counts")

    def changes(op: str, version: str, n: str, where: str = "true", source: str = "source") -> DataFrame:
        fixed = [F.lit(version).alias("version"), F.lit(op).alias("op"), F.lit(0).alias("seq")]
        return docs.filter(where).select("doc_id", *fixed, F.col(n).cast("long").alias("n_tokens"), F.expr(source).alias("source"), "lang")

    rollup = token_rollups.TokenRollup(spark, fresh_path(spark, "rollup"))
    first = changes("insert", "words", "words").union(changes("insert", "bytes", "bytes"))
    rollup.commit("first", first)
    rollup.commit("revision", changes("revise", "words", "bare", "not lang <=> 'en'"))
    rollup.commit("first", first)
    short = changes("delete", "words", "words", "words < 50").union(changes("delete", "bytes", "bytes", "words < 50"))
    rollup.commit("deletion", short)
    rollup.commit("return", changes("insert", "words", "words", "words between 20 and 49", "'returned'"))
    rollup.commit("revision", changes("revise", "words", "bare", "not lang <=> 'en'"))
    return rollup.totals()


@query()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of which documents occur in ten-word windows of the benchmark?"""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


TRIE_SQL = r"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as n,
         coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
sizes as (select conv_id, count(*) as size, xor(list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 as h
  from t group by conv_id),
c as (select s.conv_id, s.h, b.conv_id as base, least(s.h, coalesce(b.size, 0)) as head
      from sizes s left join sizes b on b.conv_id = s.conv_id - s.conv_id % 20),
r as (
  select c.conv_id, t.n as d, role, text from c join t on t.conv_id = c.base and t.n <= c.head
  union all select c.conv_id, t.n - c.h + c.head, role, text from c join t on t.conv_id = c.conv_id and t.n > c.h),
p as (
  select conv_id, d, list({'r': role, 't': text}) over (partition by conv_id order by d) as key,
         coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::bigint as words, d = max(d) over (partition by conv_id) as last from r
  union all select conv_id, 0, [], 0, conv_id not in (select conv_id from r) from c),
nodes as (select key, d as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) * (count(*) - 1) as saved,
                 sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '')) as ends_sha256 from p group by key, d),
children as (select key[1:depth - 1] as key, count(*) as n from nodes where depth > 0 group by 1),
full_nodes as (select n.*, coalesce(c.n, 0) as n_children from nodes n left join children c using (key)),
below as (select key, sum(saved)::bigint as saved_tokens, count(*) filter (where leaf) as n_leaves
          from (select key[1:i] as key, saved, n_children = 0 as leaf from full_nodes, unnest(range(0, depth + 1)) u(i)) group by key)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, n.ends_sha256
from full_nodes n join below b using (key) left join nodes p on n.depth > 0 and p.key = n.key[1:n.depth - 1]
"""


@query(TRIE_SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which prefixes do conversations share that begin with the head of another one, and what do they save?"""
    return conversation_trie.build(table(spark, sf_dir, "conversations")).drop("ref_conv", "ref_n")


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words are one edit away from others, and which is the usual form of each?"""
    return spelling_variants.group_variants(spelling_variants.word_counts(table(spark, sf_dir, "documents")))


@query()
def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which vectors are near-duplicates by cosine, whatever their labels?"""
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
