"""Calls that are made once: a table of answers by call, to which committed groups of calls are added."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidings.session import written

SCHEMA = "call string, raw string, error string"
# Calls per commit: what is lost at most when a run is broken off.
COMMIT = 10_000


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """`call, raw, error`: what was answered so far; a success counts before a failure."""
    try:
        rows = spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)
    best = F.max_by(F.struct("raw", "error"), F.struct(F.col("error").isNull(), "raw", "error"))
    return rows.groupBy("call").agg(best.alias("_best")).select("call", "_best.*")


def ask(requests: DataFrame, load_chat: Callable[[], Callable[[str, str], str]], path: str, *, commit: int = COMMIT) -> DataFrame:
    """The ledger's rows for `call, system, user`, after asking those that have no answer yet.

    Calls are asked and written in groups of about `commit`; a group's rows
    appear together when its job is committed, so a run that is broken off
    keeps the groups before it, and a second run with the same path asks the
    rest. A call that fails is a row with its error and is asked again by the
    next run. `call` names a request for good; repeats are asked once.
    """
    spark = requests.sparkSession
    known = ledger(spark, path).where("error IS NULL").select("call")
    # Written first: later groups must not see what earlier ones have added.
    wanted = requests.select("call", "system", "user").dropDuplicates(["call"])
    open_calls = written(wanted.join(known, "call", "left_anti"), "open-calls")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chat = load_chat()

        def answer(system: str, user: str) -> tuple[str | None, str | None]:
            try:
                return chat(system, user), None
            except Exception as failed:
                return None, f"{type(failed).__name__}: {failed}"

        for pdf in batches:
            answers = [answer(s, u) for s, u in zip(pdf["system"], pdf["user"])]
            yield pd.DataFrame({"call": pdf["call"], "raw": [a for a, _ in answers], "error": [e for _, e in answers]})

    n = open_calls.count()
    groups = -(-n // max(1, commit))
    place = F.pmod(F.xxhash64("call"), F.lit(max(1, groups)))
    for group in range(groups):
        open_calls.where(place == group).mapInPandas(run, SCHEMA).write.mode("append").parquet(path)
    return requests.select("call").distinct().join(ledger(spark, path), "call")
