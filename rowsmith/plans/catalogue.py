"""The registered queries: every job on views over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import dates, text
from ..operators import (
    audit,
    checks,
    clean,
    dedupe,
    integrity,
    matching,
    profile,
    reconcile,
    rules,
    runs,
    sla,
    survivorship,
)
from ..sources.documents import parse_history, parse_manifest, typed_steps
from ..session import shared_folder
from ..sources.records import apply_schema, scan_records, with_row_idx
from ..sources.sinks import write_csv
from .etl import transform
from .views import table, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = dt.date(1998, 6, 1)
SLA_DAYS = 30
DATE_COLUMNS = ["due_date", "completed_at"]
COMPARED = ["score", "status", "email", "department"]

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("score", T.IntegerType()),
        T.StructField("due_date", T.DateType()),
        T.StructField("completed_at", T.DateType()),
    ]
)

RULES = {
    "key_column": "student_id",
    "required_columns": ["student_id", "email", "due_date"],
    "rules": [
        {"name": "key_shape", "type": "regex", "column": "student_id", "pattern": "(stu|new)[0-9]{12}"},
        {"name": "team_named", "type": "required", "column": "department"},
        {"name": "score_in_reach", "type": "range", "column": "score", "min": 1, "max": 88},
        {
            "name": "known_state",
            "type": "allowed_values",
            "column": "status",
            "values": ["Open", "in_progress", "closed"],
        },
        {
            "name": "end_planned",
            "type": "required",
            "column": "completed_at",
            "when": {"column": "status", "equals": "OPEN"},
        },
        {"name": "mail_place", "type": "regex", "column": "email", "pattern": r"[a-z]+[0-9]+@example\.edu"},
        {
            "name": "team_ceiling",
            "type": "range",
            "column": "score",
            "max": 70,
            "when": {"column": "department", "in": ["Dept 1", "DEPT 5"]},
        },
    ],
}

# Two rules of one name, and one that nothing violates.
SUMMARY_RULES = RULES | {
    "rules": [
        *RULES["rules"],
        {"name": "team_named", "type": "required", "column": "email"},
        {"name": "any_state", "type": "regex", "column": "status", "pattern": ".*"},
    ]
}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def src(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "src")


def tgt(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "tgt")


def typed_src(spark: SparkSession, folder: str) -> DataFrame:
    """The source records cleaned of date layouts and cast to a typed schema."""
    records = src(spark, folder)
    return apply_schema(
        records.withColumns({c: dates.norm_date(c) for c in DATE_COLUMNS}), RECORD_SCHEMA
    )


# Quality: integrity, duplicates, first-wins


@query("integrity_scorecard")
def _(spark, folder):
    return integrity.integrity_scorecard(typed_src(spark, folder))


@query("duplicate_groups")
def _(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return dedupe.ordered_duplicate_groups(lines, ["l_orderkey", "l_linenumber"])


@query("duplicate_groups_records")
def _(spark, folder):
    return dedupe.duplicate_groups(src(spark, folder), ["student_id", "email"])


@query("duplicate_documents")
def _(spark, folder):
    documents = table(spark, folder, "documents").select("text")
    return dedupe.duplicate_groups(documents, ["text"])


@query("duplicate_rows")
def _(spark, folder):
    return dedupe.duplicate_rows(src(spark, folder), ["student_id"])


@query("duplicate_lineitems")
def _(spark, folder):
    lines = table(spark, folder, "lineitem")
    return dedupe.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query("dedupe_first")
def _(spark, folder):
    return dedupe.dedupe_first(src(spark, folder), ["student_id"], "row_idx")


@query("dedupe_first_composite")
def _(spark, folder):
    return dedupe.dedupe_first(src(spark, folder), ["department", "score"], "row_idx")


@query("index_by_key")
def _(spark, folder):
    return dedupe.index_by(src(spark, folder), "student_id", "row_idx")


@query("index_counts")
def _(spark, folder):
    return dedupe.index_counts(src(spark, folder), "student_id")


# Quality: clean, ETL, profile


@query("clean_records")
def _(spark, folder):
    renamed = src(spark, folder).withColumnsRenamed(
        {"student_id": " Student ID", "due_date": "Due-Date", "email": "E mail"}
    )
    return clean.clean(renamed, ["Due-Date", "completed_at"], ["Student ID"])


@query("clean_without_dedupe")
def _(spark, folder):
    return clean.clean(src(spark, folder), DATE_COLUMNS)


def _etl(spark, folder):
    return transform(
        src(spark, folder),
        required_columns=["student_id", "email", "department", "status"],
        date_columns=DATE_COLUMNS,
        drop_duplicates_by=["student_id"],
    )


@query("etl_records")
def _(spark, folder):
    return _etl(spark, folder).records


@query("etl_summary")
def _(spark, folder):
    return _etl(spark, folder).summary


def flat_profile(df: DataFrame) -> DataFrame:
    return df.drop("ordinal").withColumn("sample_values", F.concat_ws("|", "sample_values"))


@query("profile_records")
def _(spark, folder):
    records = src(spark, folder).drop("row_idx")
    return flat_profile(profile.profile(records))


@query("profile_customer")
def _(spark, folder):
    customers = table(spark, folder, "customer")
    return flat_profile(profile.profile(customers))


@query("profile_lineitem")
def _(spark, folder):
    return flat_profile(profile.profile(table(spark, folder, "lineitem")))


@query("profile_documents")
def _(spark, folder):
    return flat_profile(profile.profile(table(spark, folder, "documents")))


@query("table_size")
def _(spark, folder):
    return profile.table_size(table(spark, folder, "lineitem"))


# Quality: rules


def rule_query(name: str, rule: dict) -> None:
    def run(spark, folder):
        return rules.validate(src(spark, folder), {"rules": [rule]})

    QUERIES[name] = run


rule_query("rule_required", {"type": "required", "column": "email"})
rule_query(
    "rule_allowed_values",
    {
        "name": "status_exact",
        "type": "allowed_values",
        "column": "status",
        "values": ["open", "closed", "in_progress"],
        "case_sensitive": True,
    },
)
rule_query("rule_range", {"type": "range", "column": "score", "min": 0, "max": 99.5})
rule_query("rule_regex", {"type": "regex", "column": "student_id", "pattern": "stu[0-9]+"})
rule_query(
    "rule_equals_column",
    {"type": "equals_column", "column": "due_date", "other_column": "completed_at"},
)
rule_query(
    "rule_when_equals",
    {"type": "required", "column": "completed_at", "when": {"column": "status", "equals": "Open"}},
)
rule_query(
    "rule_when_not_equals",
    {
        "type": "required",
        "column": "score",
        "when": {"column": "status", "not_equals": "Closed", "case_sensitive": True},
    },
)
rule_query(
    "rule_when_in",
    {
        "type": "range",
        "column": "score",
        "max": 50,
        "when": {"column": "department", "in": ["dept 1", "DEPT 2"]},
    },
)


def flat_counts(summary: DataFrame) -> DataFrame:
    each = F.transform(
        "violations_by_rule",
        lambda r: F.concat(r["rule_name"], F.lit("="), r["violation_count"].cast("string")),
    )
    return summary.withColumn("violations_by_rule", F.array_join(each, "|"))


@query("rule_values_of_a_table")
def _(spark, folder):
    """Keys that no target record has; the allowed keys are a table of any length."""
    rule = {"name": "known_key", "type": "allowed_values", "column": "student_id", "table": "keys"}
    keys = tgt(spark, folder).select("student_id")
    return rules.validate(src(spark, folder), {"rules": [rule]}, tables={"keys": keys})


@query("validate_violations")
def _(spark, folder):
    return rules.validate(src(spark, folder), RULES)


@query("violations_by_rule")
def _(spark, folder):
    return rules.violations_by_rule(rules.validate(src(spark, folder), RULES))


@query("validation_summary")
def _(spark, folder):
    return flat_counts(rules.validation_summary(src(spark, folder), SUMMARY_RULES))


@query("validate_missing_columns")
def _(spark, folder):
    pack = {"required_columns": ["campus"], "rules": [{"type": "required", "column": "advisor"}]}
    return flat_counts(rules.validation_summary(src(spark, folder), pack))


# Quality: flags, filters, constraints, table sets


@query("flag_first_issue")
def _(spark, folder):
    return checks.flag_first_issue(typed_src(spark, folder), checks.issue_checks())


@query("dq_status_counts")
def _(spark, folder):
    flagged = checks.flag_first_issue(typed_src(spark, folder), checks.issue_checks())
    return flagged.groupBy("dq_issue", "dq_status").agg(F.count(F.lit(1)).alias("record_count"))


@query("sanitize_rows")
def _(spark, folder):
    return checks.sanitize(view(spark, folder, "lenient_src"))


@query("check_constraints")
def _(spark, folder):
    spec = {
        "email": {"contains": "@"},
        "score": {"between": (0, 100)},
        "status": {"in": ["open", "closed", "in_progress", "completed"]},
    }
    return checks.check_constraints(src(spark, folder), spec, key="student_id")


@query("validate_tables")
def _(spark, folder):
    return checks.validate_tables(
        {
            "Records": src(spark, folder).withColumnRenamed("status", " status "),
            "Tasks": view(spark, folder, "tasks"),
        },
        required=["Records", "Grades"],
        columns={"Grades": ["grade"], "Records": ["student_id", "campus"], "Tasks": ["owner"]},
        allowed={
            ("Records", "status"): ["open", "Closed", "in_progress"],
            ("Tasks", "priority"): ["1-urgent", "2-high", "3-medium"],
            ("Tasks", "campus"): ["north"],
            ("Grades", "grade"): ["A"],
        },
    )


# Reconciliation


@query("reconcile")
def _(spark, folder):
    return reconcile.reconcile(src(spark, folder), tgt(spark, folder), "student_id", COMPARED)


@query("reconcile_counts")
def _(spark, folder):
    result = reconcile.reconcile(src(spark, folder), tgt(spark, folder), "student_id", COMPARED)
    return reconcile.state_counts(result)


@query("reconcile_mismatches")
def _(spark, folder):
    result = reconcile.reconcile(src(spark, folder), tgt(spark, folder), "student_id", COMPARED)
    return reconcile.state_counts(result, "mismatch_columns")


@query("reconcile_summary")
def _(spark, folder):
    source, target = src(spark, folder), tgt(spark, folder)
    return reconcile.reconcile_summary(source, target, "student_id", COMPARED)


@query("reconcile_sql")
def _(spark, folder):
    # Blank keys are real keys to the template; here they count as null.
    source = src(spark, folder).withColumn("student_id", F.expr("nullif(student_id, '')"))
    return reconcile.reconcile_sql(source, tgt(spark, folder), "student_id", COMPARED)


def _merge(spark, folder, priority=("target", "source")):
    return survivorship.survivorship(src(spark, folder), tgt(spark, folder), priority=priority)


@query("survivorship_merged")
def _(spark, folder):
    return _merge(spark, folder).merged


@query("survivorship_merged_source_first")
def _(spark, folder):
    return _merge(spark, folder, ["source"]).merged


@query("survivorship_conflicts")
def _(spark, folder):
    return _merge(spark, folder).conflicts


@query("survivorship_summary")
def _(spark, folder):
    return _merge(spark, folder).summary


def _equal_names(spark, folder):
    return matching.fuzzy_match(
        view(spark, folder, "equal_src"),
        view(spark, folder, "equal_tgt"),
        department_column="",
        threshold=1.0,
    )


@query("fuzzy_equal_names")
def _(spark, folder):
    return _equal_names(spark, folder).decisions


@query("fuzzy_unmatched_targets")
def _(spark, folder):
    return _equal_names(spark, folder).unmatched_targets


def _people(spark, folder):
    return matching.fuzzy_match(
        view(spark, folder, "people_src"), view(spark, folder, "people_tgt"), threshold=0.86
    )


@query("fuzzy_match")
def _(spark, folder):
    return _people(spark, folder).decisions


@query("fuzzy_counts")
def _(spark, folder):
    summary = _people(spark, folder).summary
    return summary.withColumn("name_columns", F.array_join("name_columns", "|"))


@query("name_keys")
def _(spark, folder):
    people = view(spark, folder, "people_src")
    shown = text.join_name([F.col("first_name"), F.col("last_name")])
    return people.select("row_idx", shown.alias("name"), text.name_key(shown).alias("name_key"))


# Reporting


@query("sla_states")
def _(spark, folder):
    return sla.classify_sla(view(spark, folder, "tasks"), AS_OF, SLA_DAYS)


@query("sla_at_risk")
def _(spark, folder):
    return sla.sla_at_risk(view(spark, folder, "tasks"), AS_OF, SLA_DAYS)


@query("sla_state_counts")
def _(spark, folder):
    states = sla.classify_sla(view(spark, folder, "tasks"), AS_OF, SLA_DAYS)
    return reconcile.state_counts(states, "risk_state")


@query("sla_summary")
def _(spark, folder):
    states = sla.classify_sla(view(spark, folder, "tasks"), AS_OF, SLA_DAYS)
    return sla.sla_summary(states, AS_OF, SLA_DAYS).select("*", "state_counts.*").drop("state_counts")


@query("audit_anomalies")
def _(spark, folder):
    return audit.audit_packet(src(spark, folder)).anomalies


@query("audit_summary")
def _(spark, folder):
    return audit.audit_packet(src(spark, folder)).summary


@query("step_log")
def _(spark, folder):
    return typed_steps(view(spark, folder, "steps"))


@query("run_counts")
def _(spark, folder):
    artifacts = view(spark, folder, "artifacts")
    return runs.run_counts(
        typed_steps(view(spark, folder, "steps")),
        artifacts.where("relative_path like 'reports/%'"),
        artifacts.where("relative_path like 'logs/%'"),
    )


def _manifest(spark, folder):
    artifacts = view(spark, folder, "artifacts")
    return runs.run_manifest(
        "run-1",
        "success",
        "2024-02-01T00:00:00+00:00",
        typed_steps(view(spark, folder, "steps")),
        artifacts.where("relative_path like 'reports/%'"),
        artifacts.where("relative_path like 'logs/%'"),
        paths={"log_file": "logs/run-1.log"},
        log_size=12,
    )


@query("run_manifest")
def _(spark, folder):
    return _manifest(spark, folder).header.select(
        "run_id", "status", "generated_utc", "paths.log_file", "counts.*", "log.exists",
        F.col("log.size_bytes").alias("log_size_bytes"),
    )


@query("run_manifest_steps")
def _(spark, folder):
    return _manifest(spark, folder).steps


@query("run_manifest_files")
def _(spark, folder):
    manifest = _manifest(spark, folder)
    reports = manifest.reports.withColumn("section", F.lit("reports"))
    return reports.unionByName(manifest.outputs.withColumn("section", F.lit("outputs")))


@query("history_upsert")
def _(spark, folder):
    history = view(spark, folder, "runs")
    last = history.where("run_id <> ''").agg(
        F.max_by(F.struct(*[c for c in history.columns if c != "ordinal"]), "ordinal").alias("e")
    )
    entry = last.select("e.*").withColumn("status", F.lit("rerun"))
    return runs.upsert_history(history, entry, max_entries=500).drop("ordinal")


@query("expired_artifacts")
def _(spark, folder):
    patterns = {"logs": "^logs/daily-run-.*", "manifests": "^reports/run_manifest-.*"}
    return runs.expired_artifacts(view(spark, folder, "artifacts"), patterns, keep=15)


@query("read_history_json")
def _(spark, folder):
    events = table(spark, folder, "events")
    documents = events.select(
        F.format_string(
            '{"runs": [{"run_id": "r%d", "status": "%s", "counts": {"report_files": %s}}, 7]}',
            "event_id",
            "event_type",
            F.get_json_object("props", "$.k"),
        ).alias("value")
    )
    return parse_history(documents)


@query("read_manifest_json")
def _(spark, folder):
    events = table(spark, folder, "events")
    documents = events.select(
        F.format_string(
            '{"run_id": " r%d ", "paths": {"log_file": "%s.log"}, "counts": {"steps_total": %s}}',
            "event_id",
            "event_type",
            F.get_json_object("props", "$.k"),
        ).alias("value")
    )
    return parse_manifest(documents)


@query("csv_records")
def _(spark, folder):
    """Whole documents written as CSV, fully quoted, and read again by many tasks a file."""
    columns = ["doc_id", "lang", "source", "n_chars", "text"]
    path = shared_folder(spark)
    write_csv(table(spark, folder, "documents").select(*columns), path, quote_all=True)
    records = scan_records(spark, path)
    return records.select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


@query("record_ordinals")
def _(spark, folder):
    lines = with_row_idx(table(spark, folder, "lineitem"))
    return lines.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("row_idx").alias("first"),
        F.max("row_idx").alias("last"),
        F.count_distinct("row_idx").alias("ordinals"),
    )


@query("typed_records")
def _(spark, folder):
    return typed_src(spark, folder)
