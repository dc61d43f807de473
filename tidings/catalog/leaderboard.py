"""Queries over metric tables and model files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidings.catalog import inputs
from tidings.catalog.registry import query
from tidings.functions.text import model_key
from tidings.operators.leaderboard import merge_leaderboards, model_metrics
from tidings.session import fresh_path
from tidings.sources.leaderboard import scan_leaderboards

# Every event is one metric row; three "files" by priority, ids give the order.
_SCAN = """select event_id as row_pos, user_id%3 as priority, 'file'||cast(user_id%3 as string) as __source,
 case when event_id%11=0 then '  ' else ' '||event_type||cast(user_id%20 as string)||' ' end as Model,
 case when user_id%3=1 then null else value end as Accuracy, cast(event_id%100 as bigint) as n from events"""
_PATH = """case event_id%4 when 0 then 'models/all_'||event_type||cast(user_id%20 as string)||'_20260128_005432.joblib'
 when 1 then event_type||cast(user_id%20 as string)||'.joblib' when 2 then '/x/y.z/'||event_type||'_2026012_1.joblib' else 'all_b_c_20260101_7.tar.gz' end"""
_KEY = """regexp_replace(regexp_replace(regexp_replace(regexp_extract(path,'([^/]*)$',1),'^(.+)[.][^.]+$','\\1'),'^all_',''),'^(.*)_[0-9]{8}_[0-9]+$','\\1')"""
MERGED_CTE = f"""scan as ({_SCAN}), merged as (select trim(Model) as "Model", __source, Accuracy as "Accuracy", n from scan where trim(Model)<>''
 qualify row_number() over (partition by trim(Model) order by priority desc, row_pos desc)=1)"""


def _scan(spark, sf):
    return spark.sql(_SCAN.replace("from events", "from {t}"), t=inputs.table(spark, sf, "events"))


@query("a08_s05_leaderboard_merge", f"with {MERGED_CTE} select * from merged")
def a08(spark, sf):
    return merge_leaderboards(_scan(spark, sf))


_FILE = "select event_type||cast(user_id%20 as string) as Model, avg(value) as Accuracy, count(*) as n from events where user_id%3={} group by 1"


@query("s05_scanned_leaderboards", f"""with files as ({' union all '.join(f"select {k} as priority, * from ({_FILE.format(k)})" for k in range(3))})
select Model as "Model", round(Accuracy, 6) as "Accuracy", n::double as n from files qualify row_number() over (partition by Model order by priority desc)=1""")
def s05(spark, sf):
    """Three files with metrics, one that is missing and one without a Model column."""
    path, events = fresh_path(spark, "leaderboards"), inputs.table(spark, sf, "events")
    for k in range(3):
        file = spark.sql(_FILE.format(k).replace("from events", "from {t}"), t=events)
        file.write.options(header=True).csv(f"{path}/{k}.csv")
    events.select("event_id").write.options(header=True).csv(f"{path}/other.csv")
    scanned = scan_leaderboards(spark, [f"{path}/{name}.csv" for name in ("0", "missing", "1", "other", "2")])
    return merge_leaderboards(scanned).select("Model", F.round("Accuracy", 6).alias("Accuracy"), "n")


@query("m01_model_metrics", f"""with {MERGED_CTE}, f as (select event_id, {_PATH} as path from events)
select event_id, path, k as model_key, __source, "Accuracy", n from (select *, {_KEY} as k from f) left join merged on k="Model" """)
def m01(spark, sf):
    files = inputs.table(spark, sf, "events").selectExpr("event_id", f"{_PATH} as path")
    return model_metrics(files, a08(spark, sf))


@query("m02_model_key", f"select path, {_KEY} as model_key, count(*) as n from (select {_PATH} as path from events) group by path")
def m02(spark, sf):
    files = inputs.table(spark, sf, "events").selectExpr(f"{_PATH} as path")
    return files.select("path", model_key(F.col("path")).alias("model_key")).groupBy("path", "model_key").agg(
        F.count("*").alias("n")
    )
