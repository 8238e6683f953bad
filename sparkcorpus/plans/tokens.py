"""Token queries over `documents`."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcorpus.functions.chat import SPECIAL_TOKENS, special_id
from sparkcorpus.functions.text import byte_ids, pretokens
from sparkcorpus.operators import tokenization as tok
from sparkcorpus.plans.registry import query, table
from sparkcorpus.session import fresh_path

MERGES = 512


# The pre-token pattern for an engine without look-ahead. A white-space run before text gives up its last character
# (unless that is a line end) to the next pre-token; a private-use mark is set there first and dropped afterwards.
SPACE, MARK = r"\t-\r \x{85}\p{Z}", "\ue000"
PRETOKEN_PATTERN = rf"""'''(?i:[sdmt]|ll|ve|re)|[^\r\n\p{{L}}\p{{N}}{MARK}]?\p{{L}}+|\p{{N}}{{1,2}}| ?[^{SPACE}\p{{L}}\p{{N}}{MARK}]+[\r\n]*|[{SPACE}]*[\r\n]|{MARK}|[{SPACE}]+'"""
PRETOKENS_SQL = rf"""
marked as (
  select doc_id, lang, regexp_replace(text, '([{SPACE}])([\t\x0b\x0c \x{{85}}\p{{Z}}])([^{SPACE}])', '\1{MARK}\2\3', 'g') as text from documents),
pretokens as (
  select doc_id, lang, list_filter(list_transform(regexp_extract_all(text, {PRETOKEN_PATTERN}),
    lambda w: replace(w, '{MARK}', '')), lambda w: w <> '') as words from marked)"""


@query(f"""
with {PRETOKENS_SQL}
select doc_id, len(words) as n_words, md5(array_to_string(words, '|')) as digest, md5(array_to_string(words, '')) as text_digest from pretokens""")
def pretokenize(spark, sf_dir):
    """Pre-tokens of each document; joined without separator they are the text again."""
    docs = table(spark, sf_dir, "documents").withColumn("words", pretokens(F.col("text")))
    return docs.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.md5(F.array_join("words", "|")).alias("digest"),
        F.md5(F.array_join("words", "")).alias("text_digest"),
    )


@query(f"with {PRETOKENS_SQL} select lang, word, count(*) as n from (select lang, unnest(words) as word from pretokens) group by 1, 2")
def pretoken_counts(spark, sf_dir):
    return tok.pretoken_counts(table(spark, sf_dir, "documents"), by=["lang"])


@query(f"""
with bytes as (select unnest(regexp_extract_all(hex(encode(text)), '..')) as h from documents),
uses as (select ('0x' || h)::int as token_id, count(*) as uses from bytes group by 1),
vocab as (
  select i::int as token_id, hex(i::utinyint) as token_hex, false as is_special from range(256) t(i)
  union all select 256 + i::int, hex(encode(list_extract({SPECIAL_TOKENS!r}, i::int + 1))), true from range(9) t(i))
select v.token_id, lpad(v.token_hex, greatest(length(v.token_hex), 2)::int, '0') as token_hex, v.is_special, coalesce(u.uses, 0) as uses
from vocab v left join uses u using (token_id)""")
def vocab_table(spark, sf_dir):
    """Byte vocabulary with its specials and how often the corpus uses each token."""
    docs = table(spark, sf_dir, "documents")
    uses = docs.select(F.explode(byte_ids(F.col("text"))).alias("token_id")).groupBy("token_id").agg(F.count("*").alias("uses"))
    vocab = tok.vocab_table(tok.byte_ranks(spark))
    return vocab.join(uses, "token_id", "left").select(
        "token_id", F.hex("token_bytes").alias("token_hex"), "is_special", F.coalesce("uses", F.lit(0)).alias("uses")
    )


@query("select lang, sum(strlen(text))::bigint as n_bytes, (sum(strlen(text)) + 2 * count(*))::bigint as n_tokens from documents group by 1")
def token_bytes_table(spark, sf_dir):
    """Bytes counted through the byte-length table: specials count as tokens without bytes."""
    lengths = tok.token_bytes_table(tok.vocab_table(tok.byte_ranks(spark)))
    ids = tok.with_specials(byte_ids(F.col("text")), special_id("bos"), special_id("assistant_end"))
    tokens = table(spark, sf_dir, "documents").select("lang", F.explode(ids).alias("token_id"))
    uses = tokens.groupBy("lang", "token_id").agg(F.count("*").alias("n"))
    return uses.join(lengths, "token_id").groupBy("lang").agg(
        F.sum(F.col("n") * F.col("n_bytes")).cast("long").alias("n_bytes"), F.sum("n").cast("long").alias("n_tokens")
    )


BYTE_LIST = "list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: ('0x' || h)::int)"


@query(f"""
select doc_id, len(ids) as n_tokens, list_sum(ids)::bigint as id_sum, ids[1] as first_id, ids[-1] as last_id
from (select doc_id, {BYTE_LIST} as ids from documents)""")
def encode_bytes(spark, sf_dir):
    """Byte ids of each document. An empty text has no ids, so neither a sum nor a first or last one."""
    docs = tok.encode_bytes(table(spark, sf_dir, "documents"))
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda a, i: a + i)
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.when(F.size("ids") > 0, total).alias("id_sum"),
        F.get("ids", F.lit(0)).alias("first_id"), F.try_element_at("ids", F.lit(-1)).alias("last_id"),
    )


@query("""
select doc_id, strlen(text) + 2 as n_tokens, 256 as first_id, 260 as last_id, md5(text) as digest from documents""")
def with_specials(spark, sf_dir):
    ids = tok.with_specials(byte_ids(F.col("text")), special_id("bos"), special_id("assistant_end"))
    docs = table(spark, sf_dir, "documents").select("doc_id", ids.alias("ids"))
    inner = F.array_join(F.transform(F.filter("ids", lambda i: i < 256), lambda i: F.char(i)), "")
    text = F.decode(F.encode(inner, "ISO-8859-1"), "UTF-8")
    return docs.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.get("ids", F.lit(0)).alias("first_id"),
        F.element_at("ids", -1).alias("last_id"), F.md5(text).alias("digest"),
    )


def trained(spark, sf_dir, merges: int = MERGES):
    words = tok.pretoken_counts(table(spark, sf_dir, "documents"))
    return tok.train_bpe(words, 256 + merges + len(SPECIAL_TOKENS))


# Greedy merging one pair at a time. A symbol is one character; bytes are characters below 256.
BPE_SQL = f"""
with recursive {PRETOKENS_SQL},
words as (
  select array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: chr(('0x' || h)::int)), '') as w, n
  from (select word, count(*) as n from (select unnest(words) as word from pretokens) group by 1)),
run as (
  select 255 as rank, null::varchar as pair, w, n from words where length(w) > 1
  union all
  select rank + 1, best, replace(w, best, chr(rank + 1)), n from run, (
    select pair as best from (
      select w[i:i + 1] as pair, sum(n) as total from (select w, n, unnest(range(1, length(w))) as i from run) group by 1)
    order by total desc, greatest(pair[1], pair[2]), pair limit 1)
  where rank < {255 + MERGES})
select distinct rank, unicode(pair[1]) as left_rank, unicode(pair[2]) as right_rank from run where pair is not null"""


@query(BPE_SQL)
def train_bpe(spark, sf_dir):
    """Merges learned from the whole corpus."""
    return trained(spark, sf_dir).filter("rank >= 256").select("rank", "left_rank", "right_rank")


@query("select source, count(*) as documents, 0::bigint as mismatches, sum(strlen(text))::bigint as decoded_bytes from documents group by 1")
def roundtrip_audit(spark, sf_dir):
    docs = tok.encode_bytes(table(spark, sf_dir, "documents"))
    return tok.roundtrip_audit(docs, tok.vocab_table(tok.byte_ranks(spark)), by=["source"])


REPORT_SQL = """
report as (
  select 'byte' as tokenizer, lang, sum(strlen(text))::bigint as n_bytes, sum(strlen(text))::bigint as n_tokens from documents group by lang
  union all
  select 'char', lang, sum(strlen(text))::bigint, sum(length(text))::bigint from documents group by lang)"""


def two_tokenizers(spark, sf_dir):
    """Token counts of a byte and of a character tokenizer."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("lang", F.octet_length("text").alias("b"), F.explode(F.array(
        F.struct(F.lit("byte").alias("tokenizer"), F.octet_length("text").alias("t")),
        F.struct(F.lit("char").alias("tokenizer"), F.length("text").alias("t")),
    )).alias("e")).select("lang", "b", "e.*")


@query(f"with {REPORT_SQL} select *, round(n_bytes / n_tokens, 6) as bytes_per_token from report")
def compression_report(spark, sf_dir):
    report = tok.compression_report(two_tokenizers(spark, sf_dir), ["tokenizer", "lang"], F.col("b"), F.col("t"))
    return report.withColumn("bytes_per_token", F.round("bytes_per_token", 6))


# Every distinct word after each merge, one symbol a character, with its counts by language.
MERGED_WORDS_SQL = f"""
{PRETOKENS_SQL},
counts as (select lang, word, count(*) as n from (select lang, unnest(words) as word from pretokens) group by 1, 2),
words as (
  select word, array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: chr(('0x' || h)::int)), '') as w, sum(n) as n
  from counts group by 1),
run as (
  select 255 as rank, word, w, n from words
  union all
  select rank + 1, word, replace(w, best, chr(rank + 1)), n from run, (
    select pair as best from (
      select w[i:i + 1] as pair, sum(n) as total from (select w, n, unnest(range(1, length(w))) as i from run) group by 1)
    order by total desc, greatest(pair[1], pair[2]), pair limit 1)
  where rank < {255 + MERGES})"""


@query(f"""
with recursive {MERGED_WORDS_SQL}
select lang, sum(c.n * strlen(word))::bigint as n_bytes, sum(c.n * length(w))::bigint as n_tokens,
       round(sum(c.n * strlen(word)) / sum(c.n * length(w)), 6) as bytes_per_token
from counts c join run using (word) where rank = {255 + MERGES} group by 1""")
def compression_by_histogram(spark, sf_dir):
    """Trained vocabulary against bytes, per language. Tokens are counted on distinct words times their frequency; the
    texts are cut once, into a saved histogram that all steps read."""
    path = fresh_path(spark, "pretoken-counts")
    tok.pretoken_counts(table(spark, sf_dir, "documents"), by=["lang"]).write.parquet(path)
    counts = spark.read.parquet(path)
    ranks = tok.train_bpe(counts.groupBy("word").agg(F.sum("n").alias("n")), 256 + MERGES + len(SPECIAL_TOKENS))
    lengths = tok.encode_words(counts.select("word").distinct(), ranks).select("word", F.size("ids").alias("t"))
    rows = counts.join(lengths, "word")
    report = tok.compression_report(rows, ["lang"], F.col("n") * F.octet_length("word"), F.col("n") * F.col("t"))
    return report.withColumn("bytes_per_token", F.round("bytes_per_token", 6))


@query(f"""
with recursive {MERGED_WORDS_SQL}
select lang, documents, n_bytes, 0::bigint as mismatches, n_tokens, id_sum
from (select lang, sum(c.n * strlen(word))::bigint as n_bytes, sum(c.n * length(w))::bigint as n_tokens,
             sum(c.n * list_sum(list_transform(string_split(w, ''), lambda x: unicode(x))))::bigint as id_sum
      from counts c join run using (word) where rank = {255 + MERGES} group by 1)
join (select lang, count(*) as documents from documents group by 1) using (lang)""")
def encode_corpus(spark, sf_dir):
    """Encode with a vocabulary trained on the corpus, decode, compare; bytes counted on the decoded side, tokens and
    the sum of their ids on the encoded one."""
    ranks = trained(spark, sf_dir)
    encoded = tok.encode_corpus(table(spark, sf_dir, "documents"), ranks)
    id_sum = F.aggregate("ids", F.lit(0).cast("long"), lambda total, i: total + i)
    totals = [F.sum(F.size("ids")).alias("n_tokens"), F.sum(id_sum).alias("id_sum")]
    audit = tok.roundtrip_audit(encoded, tok.vocab_table(ranks), by=["lang"], also=totals).filter("lang is not null")
    return audit.select("lang", "documents", F.col("decoded_bytes").alias("n_bytes"), "mismatches", "n_tokens", "id_sum")



@query(f"""
with {REPORT_SQL},
sides as (
  select b.lang, b.n_bytes as base_bytes, b.n_tokens as base_tokens, b.n_bytes / b.n_tokens as base_ratio,
         o.n_bytes as ours_bytes, o.n_tokens as ours_tokens, o.n_bytes / o.n_tokens as ours_ratio
  from report b join report o on b.lang = o.lang and b.tokenizer = 'byte' and o.tokenizer = 'char')
select lang, base_bytes, base_tokens, round(base_ratio, 6) as base_ratio, ours_bytes, ours_tokens, round(ours_ratio, 6) as ours_ratio,
       round((base_tokens - ours_tokens) / base_tokens * 100, 6) as relative_diff,
       case when base_ratio > ours_ratio then 'byte' when ours_ratio > base_ratio then 'char' else 'tie' end as better from sides""")
def compare_tokenizers(spark, sf_dir):
    report = tok.compression_report(two_tokenizers(spark, sf_dir), ["tokenizer", "lang"], F.col("b"), F.col("t"))
    both = tok.compare_tokenizers(report, ["lang"], "byte", "char")
    return both.select(
        "lang", "base_bytes", "base_tokens", F.round("base_ratio", 6).alias("base_ratio"), "ours_bytes", "ours_tokens",
        F.round("ours_ratio", 6).alias("ours_ratio"), F.round("relative_diff", 6).alias("relative_diff"), "better",
    )


SMALL_MERGES = 128


def merged_run(name: str, weight: str, merges: int) -> str:
    """Every distinct word after each merge of a vocabulary that learns from words as often as `weight` says."""
    return f"""
{name} as (
  select 255 as rank, word, w, {weight} as n from words
  union all
  select rank + 1, word, replace(w, best, chr(rank + 1)), n from {name}, (
    select pair as best from (
      select w[i:i + 1] as pair, sum(n) as total from (select w, n, unnest(range(1, length(w))) as i from {name}) group by 1 having sum(n) > 0)
    order by total desc, greatest(pair[1], pair[2]), pair limit 1)
  where rank < {255 + merges})"""


@query(f"""
with recursive {PRETOKENS_SQL},
counts as (select lang, word, count(*) as n from (select lang, unnest(words) as word from pretokens) group by 1, 2),
words as (
  select word, array_to_string(list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda h: chr(('0x' || h)::int)), '') as w,
         sum(n) as n_all, coalesce(sum(n) filter (lang = 'en'), 0) as n_en from counts group by 1),
{merged_run("all_run", "n_all", MERGES)},
{merged_run("en_run", "n_en", MERGES)},
lengths as (
  select word, 'english' as tokenizer, length(w) as t from en_run where rank = {255 + MERGES}
  union all select word, 'small', length(w) from all_run where rank = {255 + SMALL_MERGES}
  union all select word, 'all', length(w) from all_run where rank = {255 + MERGES}),
report as (
  select tokenizer, lang, sum(n * strlen(word))::bigint as b, sum(n * t)::bigint as t from counts join lengths using (word) group by 1, 2)
select x.tokenizer as base, x.lang, x.b as n_bytes, x.t as base_tokens, y.t as ours_tokens, round((x.t - y.t) / x.t * 100, 6) as relative_diff,
       case when x.b / x.t > y.b / y.t then x.tokenizer when y.b / y.t > x.b / x.t then 'all' else 'tie' end as better
from report x join report y on x.lang = y.lang and y.tokenizer = 'all' and x.tokenizer <> 'all'""")
def compare_trained_tokenizers(spark, sf_dir):
    """A vocabulary trained on all documents against a smaller one and one trained on English alone, per language."""
    counts = tok.pretoken_counts(table(spark, sf_dir, "documents"), by=["lang"])
    words = counts.groupBy("word").agg(F.sum("n").alias("n"))
    size = 256 + MERGES + len(SPECIAL_TOKENS)
    everything = tok.train_bpe(words, size)
    small = everything.filter(F.col("rank") < 256 + SMALL_MERGES)  # one-by-one merging begins alike
    english = tok.train_bpe(counts.filter("lang = 'en'").select("word", "n"), size)
    lengths = tok.count_tokens(words.select("word"), {"all": everything, "small": small, "english": english})
    report = tok.compression_report(counts.join(lengths, "word"), ["tokenizer", "lang"], F.col("n") * F.octet_length("word"), F.col("n") * F.col("n_tokens"))
    both = [tok.compare_tokenizers(report, ["lang"], base, "all").withColumn("base", F.lit(base)) for base in ("english", "small")]
    return both[0].union(both[1]).select(
        "base", "lang", F.col("base_bytes").alias("n_bytes"), "base_tokens", "ours_tokens", F.round("relative_diff", 6).alias("relative_diff"), "better"
    )


@query("""
select lang as grp, source as sample, sum(length(text))::bigint as characters, sum(strlen(text))::bigint as n_bytes,
       sum(strlen(text) + 1)::bigint as n_tokens, round(sum(strlen(text) + 1) / sum(length(text)), 6) as tokens_per_char,
       round(sum(length(text)) / sum(strlen(text) + 1), 6) as chars_per_token
from documents group by grouping sets ((lang, source), (lang))""")
def fertility_report(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    report = tok.fertility_report(docs, "source", "lang", F.length("text"), F.octet_length("text"), F.octet_length("text") + 1)
    return report.withColumn("tokens_per_char", F.round("tokens_per_char", 6)).withColumn(
        "chars_per_token", F.round("chars_per_token", 6)
    )
