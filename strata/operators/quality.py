"""Data-quality rules that warn, drop or fail, and report their own counts.

A rule is (name, condition, action). ``passed`` means the condition is TRUE;
a NULL result counts as a violation (rules that accept NULL say so in their
condition). All counts of a set of rules come from one aggregate pass (or
from ``DataFrame.observe`` on the write itself); FAIL rules are evaluated
inside the plan with ``raise_error`` so the job aborts before any output is
committed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

WARN, DROP, FAIL = "warn", "drop", "fail"

# Gate verdicts and the default limit on the violation rate.
STATUS_OK, STATUS_ALERT = "OK", "ALERTA"
DEFAULT_LIMIT = 0.05


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str | Column
    action: str = WARN

    def passed(self) -> Column:
        c = F.expr(self.condition) if isinstance(self.condition, str) else self.condition
        return F.coalesce(c, F.lit(False))


def _passed_cols(rules) -> list[Column]:
    return [r.passed().alias(f"__ok_{i}") for i, r in enumerate(rules)]


def expect(df: DataFrame, rules: list[Rule], observation: Observation | None = None) -> DataFrame:
    """Apply rules: WARN keeps the row, DROP removes it, FAIL aborts the job.

    With ``observation`` the per-rule failure counts (over the input rows) are
    collected during whatever action runs the result, without a second scan.
    """
    if not rules:
        return df
    flagged = df.select("*", *_passed_cols(rules))
    if observation is not None:
        aggs = [F.count(F.lit(1)).alias("__rows")]
        aggs += [F.count_if(~F.col(f"__ok_{i}")).alias(r.name) for i, r in enumerate(rules)]
        flagged = flagged.observe(observation, *aggs)
    # One CASE predicate: FAIL violations raise first, then DROP rules decide. A single
    # CASE is neither split into conjuncts nor pushed into the scan, so every input row
    # reaches the FAIL checks (a pushed-down or short-circuited DROP conjunct could
    # otherwise hide a FAIL violation).
    keep = F.lit(True)
    for i, r in enumerate(rules):
        if r.action == DROP:
            keep = keep & F.col(f"__ok_{i}")
    fails = [(i, r) for i, r in enumerate(rules) if r.action == FAIL]
    if fails:
        i0, r0 = fails[0]
        pred = F.when(~F.col(f"__ok_{i0}"), _fail(r0))
        for i, r in fails[1:]:
            pred = pred.when(~F.col(f"__ok_{i}"), _fail(r))
        keep = pred.otherwise(keep)
    out = flagged.filter(keep) if (fails or any(r.action == DROP for r in rules)) else flagged
    return out.drop(*[f"__ok_{i}" for i in range(len(rules))])


def _fail(rule: Rule) -> Column:
    return F.raise_error(F.lit(f"expectation '{rule.name}' violated (ON VIOLATION FAIL UPDATE)")).cast("boolean")


def observed_metrics(observation: Observation, rules: list[Rule], dataset: str) -> list[dict]:
    """Rows (dataset, name, passed, failed) from an Observation after the action ran."""
    m = observation.get
    total = m["__rows"]
    return [dict(dataset=dataset, name=r.name, passed_records=total - m[r.name], failed_records=m[r.name])
            for r in rules]


def expectation_metrics(df: DataFrame, rules: list[Rule], dataset: str, by: list[str] | None = None) -> DataFrame:
    """(dataset, [by...], name, action, passed_records, failed_records): one aggregate, then unpivot.

    ``by`` gives per-batch (e.g. per-day) counts in the same single pass.
    """
    by = list(by or [])
    aggs = []
    for i, r in enumerate(rules):
        ok = r.passed()
        aggs += [F.count_if(ok).alias(f"p{i}"), F.count_if(~ok).alias(f"f{i}")]
    one = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    structs = [F.struct(F.lit(r.name).alias("name"), F.lit(r.action).alias("action"),
                        F.col(f"p{i}").alias("passed_records"), F.col(f"f{i}").alias("failed_records"))
               for i, r in enumerate(rules)]
    return (one.select(*by, F.inline(F.array(*structs)))
               .select(F.lit(dataset).alias("dataset"), *by, "name", "action", "passed_records", "failed_records"))


def rule_flags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add one boolean column per rule (``ok_<name>``)."""
    return df.select("*", *[r.passed().alias(f"ok_{r.name}") for r in rules])


# ---------------------------------------------------------------- event log

EXPECTATION_ARRAY = T.ArrayType(T.StructType([
    T.StructField("name", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("passed_records", T.LongType()), T.StructField("failed_records", T.LongType()),
]))


def metrics_from_event_log(log: DataFrame, event_type_col: str = "event_type",
                           details_col: str = "details") -> DataFrame:
    """Sum expectation counts per (dataset, name) from flow_progress events.

    ``details`` is JSON holding flow_progress.data_quality.expectations as an
    array of {name, dataset, passed_records, failed_records}.
    """
    exp = F.get_json_object(F.col(details_col), "$.flow_progress.data_quality.expectations")
    e = (log.filter(F.col(event_type_col) == "flow_progress")
            .select(F.explode(F.from_json(exp, EXPECTATION_ARRAY)).alias("e")))
    return (e.groupBy(F.col("e.dataset").alias("dataset"), F.col("e.name").alias("name"))
             .agg(F.sum("e.passed_records").alias("aprovados"), F.sum("e.failed_records").alias("reprovados")))


def to_event_log(metrics_by_batch: DataFrame, batch_cols: list[str], dataset_col: str = "dataset") -> DataFrame:
    """Pack per-batch metric rows into one flow_progress event per batch (JSON details)."""
    arr = F.collect_list(F.struct(F.col("name"), F.col(dataset_col).alias("dataset"),
                                  F.col("passed_records").cast("long").alias("passed_records"),
                                  F.col("failed_records").cast("long").alias("failed_records")))
    g = metrics_by_batch.groupBy(*batch_cols).agg(arr.alias("exps"))
    details = F.to_json(F.struct(F.struct(F.struct(F.col("exps").alias("expectations")).alias("data_quality"))
                                 .alias("flow_progress")))
    return g.select(*batch_cols, F.lit("flow_progress").alias("event_type"), details.alias("details"))


# ---------------------------------------------------------------- gate

def quality_gate(metrics: DataFrame, limit: float = DEFAULT_LIMIT, passed_col: str = "aprovados",
                 failed_col: str = "reprovados", mode: str = "violations") -> DataFrame:
    """One row (status, rate, passed, failed): rate = failed / max(passed + failed, 1).

    ``mode='violations'`` uses every failed record (WARN included);
    ``mode='dropped_rows'`` expects metrics restricted to DROP rules by the caller.
    With no metrics at all the rate is 0 and the status OK.
    """
    agg = metrics.agg(F.coalesce(F.sum(passed_col), F.lit(0)).cast("long").alias("passed"),
                      F.coalesce(F.sum(failed_col), F.lit(0)).cast("long").alias("failed"))
    rate = F.col("failed") / F.greatest(F.col("passed") + F.col("failed"), F.lit(1))
    return (agg.withColumn("rate", F.round(rate, 6))
               .withColumn("status", F.when(F.col("rate") <= F.lit(limit), F.lit(STATUS_OK)).otherwise(F.lit(STATUS_ALERT)))
               .select("status", "rate", "passed", "failed"))


def gate_verdict(metrics: DataFrame, limit: float = DEFAULT_LIMIT, **kw) -> tuple[str, float]:
    """Driver-side verdict; unreadable metrics fail closed (ALERTA)."""
    try:
        row = quality_gate(metrics, limit, **kw).collect()[0]
        return row["status"], float(row["rate"])
    except Exception:  # noqa: BLE001 - any failure to read metrics blocks publication
        return STATUS_ALERT, float("nan")


# ---------------------------------------------------------------- table checks

def table_quality(df: DataFrame, keys: list[str], rules: list[Rule] = (), columns: list[str] | None = None) -> DataFrame:
    """One pass: total rows, NULLs per column, duplicate keys, failures per rule.

    Long form (metric, column, value) so no MAP reaches the caller; the MAP
    form is ``null_count_map``.
    """
    columns = columns or df.columns
    key = F.struct(*[F.col(k) for k in keys])
    aggs = [F.count(F.lit(1)).alias("total"), F.count_distinct(key).alias("distinct_keys")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    aggs += [F.count_if(~r.passed()).alias(f"r{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    items = [F.struct(F.lit("total_rows").alias("metric"), F.lit(None).cast("string").alias("column"), F.col("total").alias("value")),
             F.struct(F.lit("duplicate_keys").alias("metric"), F.lit(",".join(keys)).alias("column"),
                      (F.col("total") - F.col("distinct_keys")).alias("value"))]
    items += [F.struct(F.lit("null_count").alias("metric"), F.lit(c).alias("column"), F.col(f"n{i}").alias("value"))
              for i, c in enumerate(columns)]
    items += [F.struct(F.lit("rule_failures").alias("metric"), F.lit(r.name).alias("column"), F.col(f"r{i}").alias("value"))
              for i, r in enumerate(rules)]
    return one.select(F.inline(F.array(*items)))


def null_count_map(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, one MAP<STRING, BIGINT> column ``null_counts``."""
    columns = columns or df.columns
    kv = []
    for c in columns:
        kv += [F.lit(c), F.count_if(F.col(c).isNull())]
    return df.agg(F.create_map(*kv).alias("null_counts"))


def duplicates_per_group(df: DataFrame, group: list[str], key: list[str]) -> DataFrame:
    """Per group: rows, distinct keys, duplicates = rows - distinct keys."""
    k = F.struct(*[F.col(c) for c in key])
    return (df.groupBy(*group)
              .agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(k).alias("distinct_keys"))
              .withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys")))


@dataclass
class Contract:
    """Data contract: expected columns (name -> (type DDL, nullable)), unique key, rules, freshness."""
    columns: dict
    unique_key: list[str]
    rules: list[Rule]
    freshness_col: str | None = None
    max_age_hours: float | None = None


def check_contract(df: DataFrame, contract: Contract, as_of: datetime) -> DataFrame:
    """(check, passed, detail) rows. Schema is compared on the driver (metadata only);
    nullability, uniqueness, rules and freshness share one aggregate."""
    spark = df.sparkSession
    checks = []
    actual = {f.name: f for f in df.schema.fields}
    for name, (ddl, nullable) in contract.columns.items():
        f = actual.get(name)
        ok = f is not None and f.dataType.simpleString() == T._parse_datatype_string(ddl).simpleString()
        checks.append((f"type:{name}", ok, f.dataType.simpleString() if f else "missing"))
    aggs = [F.count(F.lit(1)).alias("total"),
            F.count_distinct(F.struct(*[F.col(k) for k in contract.unique_key])).alias("distinct_keys")]
    nn = [n for n, (_, nullable) in contract.columns.items() if not nullable and n in actual]
    aggs += [F.count_if(F.col(n).isNull()).alias(f"null_{i}") for i, n in enumerate(nn)]
    aggs += [F.count_if(~r.passed()).alias(f"rule_{i}") for i, r in enumerate(contract.rules)]
    if contract.freshness_col:
        aggs.append(F.max(contract.freshness_col).cast("timestamp_ntz").alias("latest"))
    one = df.agg(*aggs)
    items = [F.struct(F.lit("unique_key").alias("check"), (F.col("total") == F.col("distinct_keys")).alias("passed"),
                      (F.col("total") - F.col("distinct_keys")).cast("string").alias("detail"))]
    items += [F.struct(F.lit(f"not_null:{n}").alias("check"), (F.col(f"null_{i}") == 0).alias("passed"),
                       F.col(f"null_{i}").cast("string").alias("detail")) for i, n in enumerate(nn)]
    items += [F.struct(F.lit(f"rule:{r.name}").alias("check"), (F.col(f"rule_{i}") == 0).alias("passed"),
                       F.col(f"rule_{i}").cast("string").alias("detail")) for i, r in enumerate(contract.rules)]
    if contract.freshness_col:
        lag_h = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(3.6e9)
        items.append(F.struct(F.lit("freshness").alias("check"),
                              F.coalesce(lag_h <= F.lit(contract.max_age_hours), F.lit(False)).alias("passed"),
                              F.round(lag_h, 3).cast("string").alias("detail")))
    body = one.select(F.inline(F.array(*items)))
    schema_rows = spark.createDataFrame(checks, "check string, passed boolean, detail string")
    return schema_rows.unionByName(body)


def reconcile(detail: DataFrame, summary: DataFrame, measures: dict[str, str], tolerance: float = 1e-6) -> DataFrame:
    """Gold check: totals of detail vs summary per measure -> (measure, detail_total, summary_total, diff, ok).

    ``measures`` maps detail column -> summary column. Sums are exact (DECIMAL).
    """
    # Stack both sides (two columns per measure, one of them NULL) and sum once:
    # no join of the two one-row results is needed.
    d = detail.select(*[F.col(a).cast("decimal(38,4)").alias(f"d{i}") for i, a in enumerate(measures)],
                      *[F.lit(None).cast("decimal(38,4)").alias(f"s{i}") for i in range(len(measures))])
    s = summary.select(*[F.lit(None).cast("decimal(38,4)").alias(f"d{i}") for i in range(len(measures))],
                       *[F.col(b).cast("decimal(38,4)").alias(f"s{i}") for i, b in enumerate(measures.values())])
    both = d.unionByName(s).agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(len(measures))],
                                *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(measures))])
    items = [F.struct(F.lit(a).alias("measure"), F.col(f"d{i}").cast("double").alias("detail_total"),
                      F.col(f"s{i}").cast("double").alias("summary_total"),
                      (F.col(f"d{i}") - F.col(f"s{i}")).cast("double").alias("diff"),
                      (F.abs(F.col(f"d{i}") - F.col(f"s{i}")) <= F.lit(tolerance)).alias("ok"))
             for i, a in enumerate(measures)]
    return both.select(F.inline(F.array(*items)))


def freshness(df: DataFrame, ts_col: str, as_of: datetime, max_age_hours: float, name: str) -> DataFrame:
    """(table_name, latest, lag_hours, ok): is the newest row recent enough at ``as_of``."""
    latest = F.max(F.col(ts_col)).cast("timestamp_ntz")
    one = df.agg(latest.alias("latest"))
    lag = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(3.6e9)
    return one.select(F.lit(name).alias("table_name"), "latest", F.round(lag, 3).alias("lag_hours"),
                      F.coalesce(lag <= F.lit(max_age_hours), F.lit(False)).alias("ok"))


def ingestion_sla(log: DataFrame) -> DataFrame:
    """Per table and day: loads, successes, failures, last load time."""
    return (log.groupBy("table_name", "load_date")
               .agg(F.count(F.lit(1)).alias("loads"),
                    F.count_if(F.col("status") == "SUCCESS").alias("successes"),
                    F.count_if(F.col("status") != "SUCCESS").alias("failures"),
                    F.max("logged_at").alias("last_load")))
