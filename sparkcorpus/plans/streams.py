"""Streaming queries: the tables are written as files that arrive, then each stream runs to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcorpus.plans.chats import REQUESTS_SQL, requests
from sparkcorpus.plans.corpus import sharded
from sparkcorpus.plans.registry import query, table
from sparkcorpus.plans.runs import EMA_SQL
from sparkcorpus.session import fresh_path
from sparkcorpus.sources.corpus import write_shards
from sparkcorpus.streaming import streams


@query("""
select source, count(*) as documents, sum(length(text))::bigint as characters, sum(strlen(text))::bigint as n_bytes from documents group by 1""")
def stream_shard_totals(spark, sf_dir):
    path = fresh_path(spark, "arriving")
    write_shards(sharded(spark, sf_dir), path, "shard", "pos", ["source", "text"])
    return streams.stream_shard_totals(
        spark, path, "source string, text string", fresh_path(spark, "totals"), fresh_path(spark, "totals-state"), files_per_batch=32
    )


@query(f"""
with {EMA_SQL}
select user_id as run, event_id as step, round(ema, 6) as ema, min(value) over (partition by user_id order by event_id rows unbounded preceding) as best_so_far
from smoothed""")
def stream_ema(spark, sf_dir):
    path = fresh_path(spark, "metrics")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss"))
    rows.repartition(7).write.json(path)
    out = streams.stream_ema(spark, path, fresh_path(spark, "ema"), fresh_path(spark, "ema-state"))
    return out.withColumn("ema", F.round("ema", 6))


@query(REQUESTS_SQL)
def stream_requests(spark, sf_dir):
    path = fresh_path(spark, "requests")
    requests(spark, sf_dir).write.json(path)
    return streams.stream_requests(spark, path, fresh_path(spark, "checked"), fresh_path(spark, "checked-state")).select("request_id", "reason")
