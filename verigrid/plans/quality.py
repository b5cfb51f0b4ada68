"""Data-quality evidence, gates and cross-layer reconciliation (DQ*)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verigrid.operators.resolve import multiset_mark
from verigrid.operators.scale import latest_batch, latest_per_key, with_context

STOP, FLAG = "stop", "flag"
TERMINAL = ("SUCCESS", "SKIPPED_IDEMPOTENT")


@dataclass(frozen=True)
class Check:
    """One check: ``failed`` and ``total`` are aggregates over the checked table.

    The default total is the row count. A NULL failed count means the check could not
    be computed.
    """

    attribute: str
    name: str
    failed: Column
    action: str = STOP
    total: Column | None = None
    details: str = ""


class GateError(RuntimeError):
    """A blocking check failed; the evidence was saved before."""


def check_status(failed: Column, action: Column) -> Column:
    """0 failed is PASS; otherwise stop gives FAIL and flag gives FLAG; not computable is ERROR."""
    return (
        F.when(failed.isNull(), "ERROR")
        .when(failed == 0, "PASS")
        .when(action == STOP, "FAIL")
        .otherwise("FLAG")
    )


def checks(df: DataFrame, table: str, specs: Sequence[Check]) -> DataFrame:
    """One row per check from a single scan: one aggregate, then an array laid out as rows."""
    measures = []
    for i, spec in enumerate(specs):
        total = F.count(F.lit(1)) if spec.total is None else spec.total
        measures += [spec.failed.cast("bigint").alias(f"f{i}"), total.cast("bigint").alias(f"t{i}")]
    one = df.agg(*measures)
    laid_out = F.array(
        *[
            F.struct(
                F.lit(spec.attribute).alias("attribute"), F.lit(spec.name).alias("check_name"),
                F.col(f"f{i}").alias("failed_rows"), F.col(f"t{i}").alias("total_rows"),
                F.lit(spec.action).alias("action"), F.lit(spec.details).alias("details"),
            )
            for i, spec in enumerate(specs)
        ]
    )
    rows = one.select(F.inline(laid_out))
    failed, total = F.col("failed_rows"), F.col("total_rows")
    return rows.select(
        F.lit(table).alias("table_name"), "attribute", "check_name", failed, total,
        F.round(F.when(total > 0, 100.0 * failed / total), 4).alias("percentage"),
        check_status(failed, F.col("action")).alias("status"), "action", "details",
    )


def gate(results: DataFrame) -> None:
    """Raise when a blocking finding exists and name every failed check; a suite's rows are bounded."""
    blocking = results.filter(is_blocking())
    names = [row["check_name"] for row in blocking.select("check_name").collect()]
    if names:
        raise GateError(f"{len(names)} blocking checks failed: {', '.join(names)}")


def save_then_gate(results: DataFrame, path: str) -> None:
    """Evidence is written before the gate can raise, so a failed run still explains itself."""
    results.write.mode("append").parquet(path)
    gate(results.sparkSession.read.parquet(path))


def is_blocking() -> Column:
    """A stop check that is not PASS, any ERROR and any unknown action block."""
    status, action = F.col("status"), F.col("action")
    return (
        status.eqNullSafe("ERROR")
        | ((action == STOP) & ~status.eqNullSafe("PASS"))
        | (status.isNotNull() & ~F.coalesce(action.isin(STOP, FLAG), F.lit(False)))
    )


# --- generated check families ------------------------------------------------

def not_null(*cols: str) -> list[Check]:
    return [Check("Completeness", f"{c} is not missing", F.count_if(F.col(c).isNull())) for c in cols]


def vocabulary(col: str, allowed: Sequence[str], nullable: bool = False) -> Check:
    """Values outside a controlled vocabulary; NULL counts unless it is allowed."""
    inside = F.coalesce(F.col(col).isin(*allowed), F.lit(nullable))
    return Check("Validity", f"{col} uses the controlled vocabulary", F.count_if(~inside))


def in_range(col: str, lo, hi, action: str = FLAG) -> Check:
    outside = (F.col(col) < lo) | (F.col(col) > hi)
    return Check("Validity", f"{col} is inside {lo} to {hi}", F.count_if(outside), action)


def consistent(name: str, rule: Column, action: str = STOP) -> Check:
    """Rows whose rule is not TRUE; an unknown result counts as failed."""
    return Check("Consistency", name, F.count_if(~F.coalesce(rule, F.lit(False))), action)


def zero_not_null(name: str, has_data: Column, measure: Column) -> list[Check]:
    """Real zeros where there is data, NULL where there is none."""
    return [
        Check("Accuracy", f"{name} is published where data exists", F.count_if(has_data & measure.isNull())),
        Check("Accuracy", f"{name} is NULL where no data exists", F.count_if(~has_data & measure.isNotNull())),
    ]


def unique_key(df: DataFrame, table: str, keys: Sequence[str], action: str = STOP) -> DataFrame:
    """Rows beyond the first per key, from a count per key."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    spec = Check(
        "Uniqueness", f"{'+'.join(keys)} is unique", F.coalesce(F.sum("n") - F.count(F.lit(1)), F.lit(0)),
        action, F.coalesce(F.sum("n"), F.lit(0)),
    )
    return checks(groups, table, [spec])


def references(df: DataFrame, table: str, col: str, targets: DataFrame, target: str) -> DataFrame:
    """Rows whose non-NULL value has no target, reduced to distinct values before the join."""
    used = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    known = targets.select(F.col(target).alias("v")).distinct().withColumn("hit", F.lit(True))
    joined = used.join(known, "v", "left")
    spec = Check(
        "Integrity", f"{col} has a target",
        F.coalesce(F.sum(F.when(F.col("hit").isNull(), F.col("n")).otherwise(0)), F.lit(0)),
        STOP, F.coalesce(F.sum("n"), F.lit(0)),
    )
    return checks(joined, table, [spec])


def all_of(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def hash_reproduces(df: DataFrame, table: str, key: str, expected: Column) -> DataFrame:
    """Keys that do not equal their recomputed hash."""
    return checks(df, table, [consistent(f"{key} reproduces", F.col(key).eqNullSafe(expected))])


def compare(
    expected: DataFrame, actual: DataFrame, table: str, keys: Sequence[str],
    families: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Rebuild check: full outer compare, one check per column family plus row presence."""
    condition = F.lit(True)
    left = expected.select(F.struct("*").alias("e"))
    right = actual.select(F.struct("*").alias("a"))
    for key in keys:
        condition = condition & F.col(f"e.{key}").eqNullSafe(F.col(f"a.{key}"))
    both = left.join(right, condition, "full_outer")
    in_both = F.col("e").isNotNull() & F.col("a").isNotNull()
    specs = [
        Check("Completeness", "no expected row is missing", F.count_if(F.col("a").isNull())),
        Check("Completeness", "no unexpected row exists", F.count_if(F.col("e").isNull())),
    ]
    for family, columns in families.items():
        differs = F.lit(False)
        for column in columns:
            differs = differs | ~F.col(f"e.{column}").eqNullSafe(F.col(f"a.{column}"))
        specs.append(Check("Accuracy", f"{family} equals the rebuild", F.count_if(in_both & differs)))
    return checks(both, table, specs)


# --- evidence ------------------------------------------------------------------

def latest_loads(log: DataFrame) -> DataFrame:
    """The newest terminal load event per table."""
    done = log.filter(F.col("completed_at").isNotNull())
    return latest_per_key(done, ["table_name"], [F.col("completed_at"), F.col("run_id")])


def latest_validation(evidence: DataFrame) -> DataFrame:
    """Every row of the newest validation batch per table."""
    return latest_batch(evidence, ["table_name"], "run_ts")


def latest_safe(log: DataFrame, evidence: DataFrame) -> DataFrame:
    """Whether each table may be used: newest load good, identified and non-empty, newest evidence clean."""
    loads = latest_loads(log).select("table_name", "snapshot_id", "status", "rows_loaded")
    judged = latest_validation(evidence).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(is_blocking()).alias("blocking")
    )
    joined = loads.join(judged, "table_name", "left")
    state = (
        F.when(~F.col("status").isin(*TERMINAL), "NEWEST_LOAD_NOT_SUCCESSFUL")
        .when(F.col("snapshot_id").isNull(), "LOAD_NOT_IDENTIFIED")
        .when(F.coalesce(F.col("rows_loaded"), F.lit(0)) <= 0, "LOAD_EMPTY")
        .when(F.col("checks").isNull(), "NO_VALIDATION_EVIDENCE")
        .when(F.col("blocking") > 0, "BLOCKING_FINDINGS")
        .otherwise("SAFE")
    )
    return joined.select("table_name", "snapshot_id", state.alias("safety"))


def rerun_stability(first: DataFrame, second: DataFrame) -> DataFrame:
    """Checks whose counts moved between two runs of one validation id."""
    on = ["validation_run_id", "table_name", "check_name"]
    a = first.select(*on, F.col("failed_rows").alias("f1"), F.col("total_rows").alias("t1"))
    b = second.select(*on, F.col("failed_rows").alias("f2"), F.col("total_rows").alias("t2"))
    return a.join(b, on, "full_outer").select(
        *on, "f1", "t1", "f2", "t2",
        (F.col("f1").eqNullSafe(F.col("f2")) & F.col("t1").eqNullSafe(F.col("t2"))).alias("is_stable"),
    )


def end_to_end(required: DataFrame, evidence: DataFrame, log: DataFrame) -> DataFrame:
    """Judge each required validator by its newest evidence.

    ``required`` has layer, scope, results_table, anchor_table and expected_tables. The
    newest ``run_ts`` of the anchor table marks the validator's last execution; the rows
    with exactly that stamp are what it saved. Evidence older than the newest load event,
    a missing table or a blocking finding fails the scope.
    """
    anchors = evidence.groupBy(F.col("results_table"), F.col("table_name").alias("anchor_table")).agg(
        F.max("run_ts").alias("evidence_run_ts")
    )
    newest_load = log.agg(F.max(F.coalesce("completed_at", "started_at")).alias("newest_load"))
    latest = required.join(anchors, ["results_table", "anchor_table"], "left")
    rows = evidence.select(
        F.col("results_table").alias("r"), F.col("run_ts").alias("ts"), "table_name", "status", "action"
    )
    keys = ["layer", "scope", "results_table", "anchor_table", "expected_tables", "evidence_run_ts"]
    counted = (
        latest.join(
            rows, (F.col("results_table") == F.col("r")) & (F.col("evidence_run_ts") == F.col("ts")), "left"
        )
        .groupBy(*keys)
        .agg(
            F.count("status").alias("required_checks"),
            F.count_if(F.col("status") == "PASS").alias("passed_checks"),
            F.count_if((F.col("action") == FLAG) & F.col("status").isin("FLAG", "FAIL")).alias("flagged_checks"),
            F.count_if(is_blocking()).alias("failed_stop_checks"),
            F.collect_set("table_name").alias("covered"),
        )
    )
    judged = counted.transform(with_context, newest_load).withColumns(
        {
            "missing": F.array_sort(F.array_except("expected_tables", "covered")),
            "is_current": F.coalesce(F.col("evidence_run_ts") >= F.col("newest_load"), F.lit(False)),
        }
    )
    failed = (
        (F.col("required_checks") == 0)
        | ~F.col("is_current")
        | (F.size("missing") > 0)
        | (F.col("failed_stop_checks") > 0)
    )
    return judged.select(
        "layer", "scope", "required_checks", "passed_checks", "flagged_checks", "failed_stop_checks",
        F.when(F.col("is_current"), F.size("missing")).otherwise(F.size("expected_tables")).cast("bigint").alias(
            "missing_checks"
        ),
        F.when(failed, "FAIL").when(F.col("flagged_checks") > 0, "FLAG").otherwise("PASS").alias("status"),
        F.concat_ws(
            "; ",
            F.when(F.col("evidence_run_ts").isNull(), "no saved evidence"),
            F.when(F.col("evidence_run_ts") < F.col("newest_load"), "stale evidence"),
            F.when(
                F.col("evidence_run_ts").isNotNull() & (F.size("missing") > 0),
                F.concat(F.lit("missing tables: "), F.array_join("missing", ", ")),
            ),
            F.when(
                F.col("failed_stop_checks") > 0,
                F.concat(F.col("failed_stop_checks").cast("string"), F.lit(" blocking checks failed")),
            ),
        ).alias("details"),
    )


def cross_layer(layers: Mapping[str, DataFrame], money: str, snapshot: str) -> DataFrame:
    """Whether layers agree: one snapshot, equal counts, equal money, against the first layer."""
    one_row = None
    names = list(layers)
    for name, df in layers.items():
        part = df.agg(
            F.count(F.lit(1)).alias(f"{name}_rows"), F.sum(money).alias(f"{name}_money"),
            F.min(snapshot).alias(f"{name}_lo"), F.max(snapshot).alias(f"{name}_hi"),
        )
        one_row = part if one_row is None else one_row.transform(with_context, part)
    base = names[0]
    rows = []
    for name in names[1:]:
        tests = {
            "row count agrees": F.col(f"{name}_rows") == F.col(f"{base}_rows"),
            "money agrees": F.col(f"{name}_money").eqNullSafe(F.col(f"{base}_money")),
            "one snapshot": (F.col(f"{name}_lo") == F.col(f"{base}_lo")) & (F.col(f"{name}_hi") == F.col(f"{base}_lo")),
        }
        rows += [
            F.struct(
                F.lit(name).alias("layer"), F.lit(test).alias("check_name"),
                F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
            )
            for test, ok in tests.items()
        ]
    return one_row.select(F.inline(F.array(*rows)))


def summary(results: DataFrame) -> DataFrame:
    """One row per layer and one ALL row: PASS, FLAG or STOP with the reasons."""
    bad = ~F.col("status").isin("PASS", "FLAG")
    totals = [
        F.sum(c).alias(c)
        for c in ("required_checks", "passed_checks", "flagged_checks", "failed_stop_checks", "missing_checks")
    ]
    grouped = results.groupingSets([["layer"], []], "layer").agg(
        *totals,
        F.when(F.count_if(bad) > 0, "STOP").when(F.count_if(F.col("status") == "FLAG") > 0, "FLAG").otherwise(
            "PASS"
        ).alias("gate_status"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(bad, F.concat("scope", F.lit(": "), "details")))), "; "
        ).alias("failure_reason"),
    )
    return grouped.withColumn("layer", F.coalesce("layer", F.lit("ALL"))).withColumn(
        "failure_reason", F.when(F.col("failure_reason") != "", F.col("failure_reason"))
    )


def acceptance(evidence: DataFrame) -> DataFrame:
    """The newest saved result per table and check."""
    return latest_per_key(
        evidence, ["table_name", "check_name"], [F.col("run_ts"), F.col("validation_run_id")]
    )


def table_mark(df: DataFrame) -> DataFrame:
    """One row that marks all columns of all rows, whatever their order."""
    return df.agg(*multiset_mark([F.col(c) for c in df.columns]))



def two_level_reconciliation(
    areas: DataFrame, regions: DataFrame, region_key: str, value: str, unresolved: Column
) -> DataFrame:
    """Areas summed per parent region against the region's own total, with what stays unresolved."""
    lower = areas.groupBy(region_key).agg(
        F.sum(F.when(~unresolved, F.col(value))).alias("area_total"),
        F.sum(F.when(unresolved, F.col(value))).alias("unresolved_total"),
    )
    upper = regions.groupBy(region_key).agg(F.sum(value).alias("region_total"))
    joined = upper.join(lower, region_key, "full_outer")
    zero = F.lit(0)
    difference = (
        F.coalesce("region_total", zero) - F.coalesce("area_total", zero) - F.coalesce("unresolved_total", zero)
    )
    return joined.withColumn("difference", difference).withColumn(
        "reconciliation_status", F.when(difference == 0, "RECONCILED").otherwise("DIFFERENT")
    )
