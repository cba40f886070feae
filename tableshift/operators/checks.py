"""Check results as rows: records, reruns, dependencies, counts, verdict, report."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableshift.functions.text import single_line
from tableshift.operators.compare import all_true
from tableshift.operators.graph import reach
from tableshift.operators.mutate import first_per_key
from tableshift.sources.sides import union_all

STATUSES = ("pass", "warn", "fail", "skip")
DETAIL_LIMIT = 500
RESULT_SCHEMA = "check string, status string, detail string, fix string, seconds double"


def records(results: DataFrame) -> DataFrame:
    """Results with the detail on one line of at most 500 characters, and the fix shown on warn and fail only."""
    detail = F.left(single_line(F.coalesce("detail", F.lit(""))), F.lit(DETAIL_LIMIT))
    fix = F.when(F.col("status").isin("warn", "fail"), F.col("fix")).otherwise("")
    return results.withColumn("detail", detail).withColumn("fix", fix)


def latest_results(results: DataFrame, check: str = "check", order: str = "ord") -> DataFrame:
    """A rerun replaces the earlier row of its check."""
    return first_per_key(results, [check], [order], last=True)


def status_counts(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return results.groupBy(*by).agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUSES])


def verdict_column(fails: Column, warns: Column, total: Column) -> Column:
    return (F.when((total == 0) | (fails > 0), "not ready").when(warns > 0, "ready with notes").otherwise("ready"))


def verdict(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts and verdict. A failure, or no result at all, is not ready; skips alone change nothing."""
    counted = status_counts(results, by)
    total = sum((F.col(f"n_{s}") for s in STATUSES[1:]), F.col(f"n_{STATUSES[0]}"))
    return counted.withColumn("verdict", verdict_column(F.col("n_fail"), F.col("n_warn"), total))


def with_skips(outcomes: DataFrame, needs: DataFrame) -> DataFrame:
    """(check, status, detail): a check is skipped when one it needs did not pass, was skipped itself, or never ran.

    ``outcomes`` has (check, status), what each would report if it ran; ``needs`` has (check, needed). A warning blocks
    too. Every check that did not pass spreads along the edges; each round reaches the next level.
    """
    needs = needs.select("check", "needed").distinct()
    never_ran = (needs.select(F.col("needed").alias("check")).distinct()
                 .join(outcomes.select("check"), "check", "left_anti"))
    bad = outcomes.filter("status <> 'pass'").select("check").unionByName(never_ran)
    edges = needs.select(F.col("needed").alias("source"), F.col("check").alias("target"))
    not_passed = reach(bad, edges, "check")
    blocking = needs.join(not_passed.withColumnRenamed("check", "needed"), "needed", "left_semi")
    # The text of one row names that check's own unmet needs.
    unmet = blocking.groupBy("check").agg(
        F.expr("concat('needs: ', listagg(cast(needed as string), ', ') within group (order by cast(needed as string)))")
        .alias("unmet"))
    joined = outcomes.join(unmet, "check", "left")
    skipped = F.col("unmet").isNotNull()
    return joined.select("check", F.when(skipped, "skip").otherwise(F.col("status")).alias("status"),
                         F.when(skipped, F.col("unmet")).otherwise("").alias("detail"))


def gate(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, passed) of one-row frames whose only column is a condition; an empty or unknown one does not pass."""
    return union_all(df.toDF("ok").agg(all_true(F.col("ok")).alias("passed"))
                     .select(F.lit(name).alias("check"), "passed") for name, df in checks.items())


def gate_summary(gated: DataFrame) -> DataFrame:
    """One row (passed, total, go)."""
    return gated.agg(F.count_if("passed").alias("passed"), F.count(F.lit(1)).alias("total"),
                     all_true(F.col("passed")).alias("go"))


def report_lines(results: DataFrame) -> DataFrame:
    """(check, document): one JSON document per check. For any number of checks."""
    return results.select("check", F.to_json(F.struct("check", "status", "detail", "fix")).alias("document"))


def read_report_lines(documents: DataFrame, column: str = "document") -> DataFrame:
    parsed = F.from_json(column, "check string, status string, detail string, fix string")
    return documents.select(parsed.alias("r")).select("r.*")


def report_documents(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(…by, document): per group, the verdict and every result as one JSON text, made on the executors.

    A document holds all results of its group; group by run or database for long lists.
    """
    final = verdict(results, by).select(*by, "verdict")
    row = F.struct("check", "status", "detail", "fix")
    listed = results.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("results"))
    joined = final.join(listed, list(by), "left") if by else final.crossJoin(listed)  # without groups, one row each
    return joined.select(*by, F.to_json(F.struct("verdict", "results"), {"ignoreNullFields": "false"}).alias("document"))


@dataclass(frozen=True)
class Check:
    """A named check. ``body`` gives a one-row frame (status, detail); ``fix`` says what helps; ``needs`` must have passed."""

    name: str
    body: Callable[[], DataFrame]
    fix: str = ""
    needs: Sequence[str] = ()


def run_checks(spark, checks: Sequence[Check], earlier: DataFrame | None = None) -> DataFrame:
    """(check, status, detail, fix, seconds): run a short list of checks in order of their needs.

    A check with a need that did not pass, or that is unknown or in a loop, is skipped and its body is not run. A body that
    raises, or gives no known status, fails. ``earlier`` results stay unless their check ran again.
    """
    by_name, done, order = {c.name: c for c in checks}, {}, []
    waiting = list(checks)
    while waiting:
        able = [c for c in waiting if all(n in done or n not in by_name for n in c.needs)]
        for c in able or waiting:
            unmet = sorted(n for n in c.needs if n not in done or done[n][1] != "pass")
            started = time.perf_counter()
            if unmet:
                status, detail = "skip", f"needs: {', '.join(unmet)}"
            else:
                try:
                    found = c.body().select("status", "detail").first()
                    status, detail = (found["status"], found["detail"]) if found else ("fail", "no result")
                    if status not in STATUSES:
                        status, detail = "fail", f"unknown status {status}"
                except Exception as e:  # a check that breaks is a failed check
                    status, detail = "fail", f"{type(e).__name__}: {e}"
            done[c.name] = (c.name, status, detail, c.fix, time.perf_counter() - started)
            order.append(c.name)
        waiting = [c for c in waiting if c.name not in done]
    fresh = records(spark.createDataFrame([done[n] for n in order], RESULT_SCHEMA))
    if earlier is None:
        return fresh
    return earlier.join(fresh.select("check"), "check", "left_anti").select(*fresh.columns).unionByName(fresh)
