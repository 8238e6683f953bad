"""Corpus scans, splits, order, budgets, manifests and audits over `documents`."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcorpus.functions.keys import hex_bucket, key_digits, shuffle_key, width_bucket
from sparkcorpus.functions.text import byte_ids
from sparkcorpus.operators import ordering, packing, sampling, tokenization
from sparkcorpus.plans.registry import query, table
from sparkcorpus.session import fresh_path
from sparkcorpus.sources import corpus, reports

SEED = 42
DOCS_PER_SHARD, GROUP_ROWS = 100, 32


def sharded(spark, sf_dir):
    """Documents as shards of 100 with their position in the shard."""
    docs = table(spark, sf_dir, "documents")
    return docs.withColumn("shard", F.floor(F.col("doc_id") / DOCS_PER_SHARD).cast("int")).withColumn(
        "pos", F.pmod("doc_id", F.lit(DOCS_PER_SHARD))
    )


SHARDED = "(select *, (doc_id // 100)::int as shard, doc_id % 100 as pos, (doc_id % 100) // 32 as group_no from documents)"


@query("select (doc_id // 100)::int as shard, doc_id % 100 as pos, doc_id, length(text) as chars from documents")
def scan_corpus(spark, sf_dir):
    path = fresh_path(spark, "shards")
    corpus.write_shards(sharded(spark, sf_dir), path, "shard", "pos", ["doc_id", "text"], GROUP_ROWS)
    scan = corpus.scan_corpus(spark, path, columns=["doc_id", "text"])
    return scan.select("shard", "pos", "doc_id", F.length("text").cast("long").alias("chars"))


@query(f"select shard, count(*) as documents, sum(length(text))::bigint as characters from {SHARDED} group by 1")
def shard_report(spark, sf_dir):
    return corpus.shard_report(sharded(spark, sf_dir))


@query(f"""
select case when shard = (select max(shard) from {SHARDED}) then 'val' else 'train' end as split,
       count(*) as documents, sum(length(text))::bigint as characters from {SHARDED} group by 1""")
def split_by_last_shard(spark, sf_dir):
    return corpus.shard_report(corpus.split_by_last_shard(sharded(spark, sf_dir)), "split")


@query(f"""
select shard, group_no, count(*) as documents, min(doc_id) as first_doc, max(doc_id) as last_doc
from {SHARDED} where group_no >= 1 and (group_no - 1) % 2 = 0 group by 1, 2""")
def stride_groups(spark, sf_dir):
    strided = ordering.stride_groups(sharded(spark, sf_dir), "pos", GROUP_ROWS, 1, 2)
    return strided.groupBy("shard", "group_no").agg(
        F.count("*").alias("documents"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


@query(f"""
select shard, group_no, (pos % 32) // 10 as batch_no, count(*) as documents,
       md5(string_agg(text, '|' order by pos)) as digest from {SHARDED} group by 1, 2, 3""")
def batch_documents(spark, sf_dir):
    docs = sharded(spark, sf_dir).withColumn("group_no", F.floor(F.col("pos") / GROUP_ROWS).cast("long"))
    batches = corpus.batch_documents(docs, ["shard", "group_no"], "pos", GROUP_ROWS, 10, "text")
    return batches.select(
        "shard", "group_no", "batch_no", F.size("batch").cast("long").alias("documents"),
        F.md5(F.array_join("batch", "|")).alias("digest"),
    )


@query(f"""
select epoch, shard, group_no, count(*) as documents, sum(length(text))::bigint as characters
from {SHARDED} cross join (select unnest([1, 2, 3]) as epoch)
where group_no % 2 = 1 and (epoch > 2 or (epoch = 2 and shard > 1) or (epoch = 2 and shard = 1 and group_no >= (0 // 2 + 1) * 2))
group by 1, 2, 3""")
def resume_from(spark, sf_dir):
    docs = sharded(spark, sf_dir).withColumn("group_no", F.floor(F.col("pos") / GROUP_ROWS).cast("long"))
    left = corpus.resume_from(corpus.replay_epochs(docs, 3), worker=1, workers=2, epoch=2, shard=1, group=0)
    return left.groupBy("epoch", "shard", "group_no").agg(
        F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters")
    )


@query("""
select epoch, lang, count(*) as documents, sum(length(text))::bigint as characters
from documents cross join (select unnest([1, 2, 3]) as epoch) group by 1, 2""")
def replay_epochs(spark, sf_dir):
    return corpus.replay_epochs(table(spark, sf_dir, "documents"), 3).groupBy("epoch", "lang").agg(
        F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters")
    )


@query("select lang, count(*) as documents, sum(length(text))::bigint as characters, min(doc_id) as first_doc from documents group by 1")
def read_manifested(spark, sf_dir):
    path, manifest = fresh_path(spark, "hub"), fresh_path(spark, "manifest")
    table(spark, sf_dir, "documents").hint("rebalance").write.parquet(path)  # files of bounded size, however many
    corpus.write_list_manifest(spark, path, manifest)
    return corpus.read_manifested(spark, manifest).groupBy("lang").agg(
        F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters"), F.min("doc_id").alias("first_doc")
    )


@query("""
with present as (select distinct doc_id // 100 as shard from documents where (doc_id // 100) % 3 <> 1),
     wanted as (select unnest(range(20)) as shard union select 6542)
select shard from wanted where shard not in (select shard from present)""")
def missing_shards(spark, sf_dir):
    present = sharded(spark, sf_dir).filter(F.col("shard") % 3 != 1)
    return corpus.missing_shards(present, 20, 6542)


@query("select doc_id, text from documents")
def project_text(spark, sf_dir):
    return corpus.project_text(table(spark, sf_dir, "documents").withColumnRenamed("text", "body"), "body", ["doc_id"])


@query("select doc_id, md5(text) as digest, length(text) as chars from documents")
def decode_corpus(spark, sf_dir):
    docs = tokenization.encode_bytes(table(spark, sf_dir, "documents")).select("doc_id", "ids")
    vocab = tokenization.vocab_table(tokenization.byte_ranks(spark))
    text = tokenization.decode_corpus(docs, vocab)
    return text.select("doc_id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("chars"))


@query(f"select doc_id, row_number() over (order by md5('{SEED}|' || doc_id), doc_id) - 1 as shuffled_pos from documents")
def seeded_shuffle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return ordering.seeded_shuffle(docs, SEED, "doc_id").select("doc_id", "shuffled_pos")


SHARD_CHARS, BLOCK_ROWS = 60_000, 16

SHARDS_SQL = f"""
with recursive blocks as (
  select doc_id // {BLOCK_ROWS} as block, sum(length(text))::bigint as chars, count(*) as docs from documents group by 1),
fold as (
  select -1::bigint as block, 0::bigint as shard, 0::bigint as acc, false as closes
  union all
  select b.block, f.shard + f.closes::bigint, (case when f.closes then 0 else f.acc end) + b.chars,
         (case when f.closes then 0 else f.acc end) + b.chars >= {SHARD_CHARS} and b.docs = {BLOCK_ROWS}
  from fold f join blocks b on b.block = f.block + 1),
finished as (select max(shard) as last_shard from fold where closes)
select shard::int as shard, count(*) as documents, sum(length(text))::bigint as characters,
       min(doc_id) as first_doc, max(doc_id) as last_doc
from documents join fold on fold.block = doc_id // {BLOCK_ROWS}, finished where shard <= last_shard group by 1"""


@query(SHARDS_SQL)
def assign_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    shards = corpus.assign_shards(docs, "doc_id", F.length("text"), SHARD_CHARS, BLOCK_ROWS)
    return shards.groupBy("shard").agg(
        F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
    )


@query("""
select lang, count(*) as documents, sum(length(text))::bigint as characters, sum(strlen(text))::bigint as n_bytes
from documents group by 1""")
def jsonl_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "jsonl")
    corpus.write_jsonl(table(spark, sf_dir, "documents").select("lang", "text"), path)
    return corpus.read_jsonl(spark, path, "lang string, text string").groupBy("lang").agg(
        F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters"),
        F.sum(F.octet_length("text")).cast("long").alias("n_bytes"),
    )


@query("select doc_id, length(text[1:500]) as chars, md5(text[1:500]) as digest from documents")
def cap_text(spark, sf_dir):
    capped = sampling.cap_text(table(spark, sf_dir, "documents"), 500)
    return capped.select("doc_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


CAP, CHAR_BUDGET, BYTE_BUDGET = 3000, 150_000, 151_003


@query(f"""
with running as (
  select doc_id, text[1:{CAP}] as text, sum(length(text[1:{CAP}])) over (order by doc_id rows unbounded preceding) as through from documents)
select doc_id, length(text) as chars, md5(text) as digest from running where through - length(text) <= {CHAR_BUDGET}""")
def char_budget(spark, sf_dir):
    docs = sampling.cap_text(table(spark, sf_dir, "documents"), CAP)
    kept = sampling.char_budget(docs, ["doc_id"], width_bucket(F.col("doc_id"), 128), CHAR_BUDGET)
    return kept.select("doc_id", F.length("text").cast("long").alias("chars"), F.md5("text").alias("digest"))


def budget_sql(budget: int) -> str:
    """Rows (doc_id, lang, source, text) of a byte budget in seeded order, after the character cap. Cutting to a
    character boundary: the longest prefix of characters whose bytes fit."""
    return f"""
with keyed as (
  select doc_id, lang, source, text[1:{CAP}] as text, md5('{SEED}|' || doc_id) as k from documents where text <> ''),
running as (
  select *, sum(strlen(text)) over (order by k, doc_id rows unbounded preceding) - strlen(text) as bytes_before from keyed),
cut as (
  select doc_id, lang, source,
         case when strlen(text) <= {budget} - bytes_before then text
              else text[1:list_max(list_filter(range(length(text) + 1), lambda n: strlen(text[1:n]) <= {budget} - bytes_before))] end as text
  from running where bytes_before < {budget}),
sample as (select * from cut where text <> '')"""


def budgeted_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    digits = key_digits(docs.count())
    docs = sampling.cap_text(docs, CAP).withColumn("_key", shuffle_key(SEED, "doc_id"))
    return sampling.byte_budget(docs, ["_key", "doc_id"], hex_bucket(F.col("_key"), digits), BYTE_BUDGET)


@query(budget_sql(BYTE_BUDGET) + " select doc_id, strlen(text) as n_bytes, md5(text) as digest from sample")
def byte_budget(spark, sf_dir):
    sample = budgeted_sample(spark, sf_dir)
    return sample.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("digest"))


@query(budget_sql(BYTE_BUDGET) + """
select lang, count(*) as documents, sum(length(text))::bigint as characters, sum(strlen(text))::bigint as n_bytes,
       sum(strlen(text) + 1)::bigint as n_tokens, round(sum(strlen(text)) / sum(strlen(text) + 1), 6) as bytes_per_token
from sample group by 1""")
def budgeted_tokenizer_sample(spark, sf_dir):
    """What would a budgeted tokenizer sample contain? Seeded order, per-document cap, byte budget, then documents,
    characters, bytes and bytes per token (byte tokenizer with document start) by language."""
    sample = budgeted_sample(spark, sf_dir).select(
        "lang", F.length("text").alias("c"), F.octet_length("text").alias("b"), (F.size(byte_ids(F.col("text"))) + 1).alias("t")
    )
    counts = sample.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("c").cast("long").alias("characters"),
                                        F.sum("b").cast("long").alias("n_bytes"), F.sum("t").cast("long").alias("n_tokens"))
    return counts.withColumn("bytes_per_token", F.round(F.col("n_bytes") / F.col("n_tokens"), 6))


@query(budget_sql(BYTE_BUDGET) + f"""
, lanes as (select source, length(text) as c, strlen(text) as b, sha256(doc_id || '|' || text) as h from sample),
buckets as (
  select h[1:2] as bucket, count(*) as documents, sum(c)::bigint as characters, sum(b)::bigint as bytes,
         sum(('0x' || h[3:14])::bigint)::hugeint as hs from lanes group by 1)
select sum(documents)::bigint as documents, sum(characters)::bigint as characters, sum(bytes)::bigint as bytes,
       md5(string_agg(bucket || ':' || documents || ':' || hs, ',' order by bucket || ':' || documents || ':' || hs)) as digest,
       (select count(distinct source) from lanes) as sources, sum(bytes) < {BYTE_BUDGET} as truncated_short from buckets""")
def sample_manifest(spark, sf_dir):
    return sampling.sample_manifest(budgeted_sample(spark, sf_dir), "doc_id", "source", BYTE_BUDGET)


@query("""
with actual as (select source, count(*) as documents, sum(length(text))::bigint as characters from documents group by 1),
manifest as (
  select source, documents + (documents % 2 = 0 and ascii(source[-1:]) % 3 = 0)::int as documents, characters from actual
  where ascii(source[-1:]) % 5 <> 0
  union all select 'absent', 1, 1)
select coalesce(a.source, m.source) as source, a.documents as actual_documents, a.characters as actual_characters,
       m.documents as manifest_documents, m.characters as manifest_characters,
       case when a.source is null then 'missing' when m.source is null then 'unlisted' else 'changed' end as status
from actual a full join manifest m on a.source = m.source
where a.source is null or m.source is null or a.documents <> m.documents or a.characters <> m.characters""")
def verify_manifest(spark, sf_dir):
    actual = table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("characters")
    )
    last = F.ascii(F.substring("source", -1, 1))
    off = F.when((F.col("documents") % 2 == 0) & (last % 3 == 0), 1).otherwise(0)
    manifest = actual.filter(last % 5 != 0).select("source", (F.col("documents") + off).alias("documents"), "characters")
    absent = spark.createDataFrame([("absent", 1, 1)], "source string, documents long, characters long")
    return sampling.verify_manifest(actual, manifest.unionByName(absent), ["source"], ["documents", "characters"])


@query("""
select count(distinct source) as runs, count(distinct md5(lang || (doc_id // 500))) as digests,
       count(distinct md5(lang || (doc_id // 500))) = 1 as consistent from documents""")
def single_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    marked = docs.withColumn("digest", F.md5(F.concat("lang", F.floor(F.col("doc_id") / 500).cast("string"))))
    return sampling.single_source(marked, "source", "digest")


@query("select doc_id, (doc_id - 7) // 3 as doc_pos from documents where doc_id >= 7 and doc_id < 900 and (doc_id - 7) % 3 = 0")
def slice_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").alias("doc_pos"))
    return ordering.slice_rows(docs, "doc_pos", 7, 900, 3)


@query("""
select source, doc_id from (
  select source, doc_id, row_number() over (partition by source order by md5('1337|' || source || '|' || doc_id), doc_id) as r from documents)
where r <= 5""")
def sample_per_task(spark, sf_dir):
    return sampling.sample_per_task(table(spark, sf_dir, "documents").select("source", "doc_id"), "source", "doc_id", 5, 1337)


@query("select worker, count(*) as documents, sum(doc_id)::bigint as ids from (select (doc_id % 6)::int as worker, doc_id from documents) group by 1")
def assign_workers(spark, sf_dir):
    assigned = ordering.assign_workers(table(spark, sf_dir, "documents"), "doc_id", 6)
    return assigned.groupBy("worker").agg(F.count("*").alias("documents"), F.sum("doc_id").cast("long").alias("ids"))


EVAL_ROWS, EVAL_LEN, EVAL_BUDGET = 4, 512, 60_000


@query(f"""
with rows as (
  select split, used // ({EVAL_LEN} + 1) as row_no, used from (
    select case when doc_id // 100 = (select max(doc_id // 100) from documents) then 'val' else 'train' end as split,
           sum(strlen(text) + 1) over (partition by doc_id // 100 = (select max(doc_id // 100) from documents)
                                       order by doc_id rows unbounded preceding) - (strlen(text) + 1) as used from documents)),
full_rows as (
  select split, unnest(range((total + {EVAL_LEN}) // ({EVAL_LEN} + 1))) as row_no from (
    select case when doc_id // 100 = (select max(doc_id // 100) from documents) then 'val' else 'train' end as split,
           sum(strlen(text) + 1)::bigint as total from documents group by 1))
select split, count(*) as n_rows from full_rows
where row_no < {EVAL_ROWS} * ({EVAL_BUDGET} // ({EVAL_ROWS} * {EVAL_LEN})) group by 1""")
def fixed_eval_subset(spark, sf_dir):
    docs = corpus.split_by_last_shard(sharded(spark, sf_dir)).withColumn("n_tokens", F.octet_length("text") + 1)
    packed = None
    for split in ("train", "val"):
        part = packing.pack_concat(
            docs.filter(F.col("split") == split), "doc_id", ["doc_id"], width_bucket(F.col("doc_id"), 256), "n_tokens", EVAL_LEN + 1
        ).withColumn("split", F.lit(split))
        packed = part if packed is None else packed.unionByName(part)
    limits = ("split", "row_no", EVAL_ROWS, EVAL_LEN, EVAL_BUDGET)
    folder = fresh_path(spark, "eval-subset")
    sampling.kept_eval_subset(packed, folder, *limits)
    kept = sampling.kept_eval_subset(packed.limit(0), folder, *limits)  # a later measurement, when the corpus is gone
    return kept.groupBy("split").agg(F.countDistinct("row_no").alias("n_rows"))


@query("""
select doc_id, text, (select count(*) from documents) as total_rows, length(text) as chars, lang as tag
from documents where doc_id < 20""")
def inspect_dataset(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    converted = docs.select("doc_id", F.length("text").cast("long").alias("chars"), F.col("lang").alias("tag"))
    return sampling.inspect_dataset(docs.select("doc_id", "text"), converted, "doc_id", 20)


@query("""
with files as (
  select lpad((doc_id // 100)::varchar, 5, '0') as shard, sha256(string_agg(text || chr(10), '' order by doc_id)) as sha
  from documents group by 1)
select shard, sha as actual, case when shard::int % 3 = 0 then sha[2:] when shard::int % 3 = 1 then sha end as expected,
       case when shard::int % 3 = 0 then 'changed' when shard::int % 3 = 1 then 'ok' else 'unlisted' end as status from files
union all select 'gone', null, 'abc', 'missing'""")
def audit_files(spark, sf_dir):
    path = fresh_path(spark, "audit")
    docs = sharded(spark, sf_dir).withColumn("shard_dir", F.lpad(F.col("shard").cast("string"), 5, "0"))
    docs.repartition("shard_dir").sortWithinPartitions("shard_dir", "doc_id").select("shard_dir", "text").write.partitionBy("shard_dir").text(path)
    hashed = sampling.hash_files(spark, path, "*.txt").withColumn("path", F.regexp_extract("path", r"shard_dir=(\d+)/", 1))
    third = F.col("path").cast("int") % 3
    manifest = hashed.drop("n_bytes").filter(third < 2).withColumn("sha256", F.when(third == 0, F.substring("sha256", 2, 64)).otherwise(F.col("sha256")))
    gone = spark.createDataFrame([("gone", "abc")], "path string, sha256 string")
    return sampling.audit_files(hashed, manifest.unionByName(gone)).withColumnRenamed("path", "shard")


@query("""
with listing as (
  select '/ckpt/u' || o_custkey % 20 as root,
         case when o_custkey % 20 < 15 then 'd' || (o_orderkey % 13 + 4) else 'tag' || o_orderkey % 5 end as folder,
         o_orderkey % 900 as step, o_orderdate as modified from orders),
folders as (
  select root, folder, max(step) as last_step, max(modified) as modified from listing group by 1, 2),
ranked as (
  select *, row_number() over (partition by root order by coalesce(try_cast(regexp_extract(folder, '^d([0-9]+)', 1) as bigint), -1) desc, modified desc, folder desc) as r
  from folders)
select root, count(*) as folders, max(folder) filter (r = 1) as best_folder, max(last_step) filter (r = 1) as last_step from ranked group by 1""")
def latest_artifacts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    user, key = F.col("o_custkey") % 20, F.col("o_orderkey")
    folder = F.when(user < 15, F.concat(F.lit("d"), (key % 13 + 4).cast("string"))).otherwise(F.concat(F.lit("tag"), (key % 5).cast("string")))
    path = F.concat(F.lit("/ckpt/u"), user.cast("string"), F.lit("/"), folder, F.lit("/model_"), F.lpad((key % 900).cast("string"), 6, "0"), F.lit(".pt"))
    return sampling.latest_artifacts(orders.select(path.alias("path"), F.col("o_orderdate").alias("modified")))


# --- evaluation bundle, reports, logs as files --------------------------------------------------------------------


@query("""
select 'task' || item_id % 3 as label, count(*) as items, sum(length(text))::bigint as chars,
       max(case item_id % 3 when 0 then 'multiple_choice' when 1 then 'schema' else 'language_modeling' end) as task_type,
       max(case item_id % 3 when 0 then ' ' when 1 then '; ' else ' ' end) as delimiter,
       max(round((item_id % 3) * 0.125::double, 6)) as random_baseline from benchmark group by 1""")
def read_eval_bundle(spark, sf_dir):
    bench = table(spark, sf_dir, "benchmark").withColumn("t", F.col("item_id") % 3)
    label = F.concat(F.lit("task"), F.col("t").cast("string"))
    items, tasks, baselines = (fresh_path(spark, n) for n in ("items", "tasks", "baselines"))
    bench.select(label.alias("label"), F.col("item_id").cast("int").alias("idx"), F.col("text").alias("query")).write.json(items)
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("multiple_choice", "schema", "language_modeling")]), (F.col("t") + 1).cast("int"))
    bench.select(
        label.alias("label"), kinds.alias("task_type"), F.lit(0).alias("num_fewshot"),
        F.when(F.col("t") == 1, "; ").alias("continuation_delimiter"),
    ).distinct().write.json(tasks)
    bench.select(label.alias("Eval Task"), (F.col("t") * 12.5).alias("Random baseline")).distinct().write.option("header", "true").csv(baselines)
    bundle = reports.read_eval_bundle(spark, items, tasks, baselines)
    return bundle.groupBy("label").agg(
        F.count("*").alias("items"), F.sum(F.length("query")).cast("long").alias("chars"), F.max("task_type").alias("task_type"),
        F.max("continuation_delimiter").alias("delimiter"), F.max(F.round("random_baseline", 6)).alias("random_baseline"),
    )


@query("""
with scores as (
  select source as label, avg(quality)::double as accuracy, (avg(quality) - 0.25) / 0.75 as centered
  from documents join labels using (doc_id) group by 1)
select label, round(accuracy, 6) as accuracy, round(centered, 6) as centered from scores
union all select 'CORE', null, round(avg(centered), 6) from scores""")
def score_report(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    scores = rows.groupBy(F.col("source").alias("label")).agg(F.avg("quality").alias("accuracy")).withColumn(
        "centered", (F.col("accuracy") - 0.25) / 0.75
    )
    path = fresh_path(spark, "report")
    reports.write_score_report(scores, path)
    back = reports.read_score_report(spark, path)
    return back.select("label", F.round("accuracy", 6).alias("accuracy"), F.round("centered", 6).alias("centered"))


@query("""
select 'run' || o_custkey % 8 as run, count(*) * 2 as lines, min(o_orderkey) as first_key,
       count(*) filter (o_orderpriority[1:1] = '1') as urgent from orders group by 1""")
def read_logs(spark, sf_dir):
    path = fresh_path(spark, "logs")
    rows = table(spark, sf_dir, "orders").withColumn("run", F.concat(F.lit("run"), (F.col("o_custkey") % 8).cast("string")))
    text = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit("\n  priority "), F.col("o_orderpriority"))
    rows.select("run", "o_orderkey", text.alias("value")).repartition("run").sortWithinPartitions("run", "o_orderkey").select(
        "run", "value"
    ).write.partitionBy("run").text(path)
    lines = reports.read_logs(spark, path).filter("line <> ''").withColumn("run", F.regexp_extract("path", r"run=([^/]+)", 1))
    first = F.min(F.when(F.col("line_no") == 0, F.regexp_extract("line", r"order (\d+)", 1).try_cast("long")))
    return lines.groupBy("run").agg(
        F.count("*").alias("lines"), first.alias("first_key"), F.count(F.when(F.col("line").startswith("  priority 1"), 1)).alias("urgent")
    )
