"""Jobs on small tables with hand-worked results, and the shape of their plans."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from rowsmith import streaming
from rowsmith.operators import (
    audit, checks, clean, dedupe, integrity, profile, reconcile, rules, runs, sla, survivorship,
)
from rowsmith.plans import etl
from rowsmith.sources import documents, records, sinks


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def people(spark):
    data = [
        (2, "S1", "a@x", "Law", "78", "open"),
        (3, "S2 ", "b@x", "", "nan", "Closed "),
        (4, "S1", "c@x", "Law", "106", "open"),
        (5, "", "bad", None, "", "pending"),
        (6, " ", "@x", "Law", "n.a.", None),
        (7, "S3", None, "Art", "-4", "closed"),
    ]
    schema = "row_idx bigint, student_id string, email string, department string, score string, status string"
    return spark.createDataFrame(data, schema).cache()


def test_dedupe_and_index(people):
    kept = dedupe.dedupe_first(people, ["student_id"], "row_idx")
    assert rows(kept, "row_idx") == [(2,), (3,), (5,), (7,)]
    index = dedupe.index_by(people, "student_id", "row_idx")
    assert rows(index, "record_key", "row_idx") == [("S1", 2), ("S2", 3), ("S3", 7)]
    assert tuple(dedupe.index_counts(people, "student_id").first()) == (6, 1, 2)
    with pytest.raises(ValueError, match="Available columns"):
        dedupe.dedupe_first(people, ["campus"], "row_idx")


def test_dedupe_does_not_depend_on_partitions(people):
    one = rows(dedupe.dedupe_first(people.repartition(1), ["department"], "row_idx"), "row_idx")
    seven = rows(dedupe.dedupe_first(people.repartition(7), ["department"], "row_idx"), "row_idx")
    assert one == seven == [(2,), (3,), (7,)]


def test_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("", 3), ("", 4), ("a", 5)], "k string, v int")
    assert {tuple(r) for r in dedupe.duplicate_groups(df, ["k"]).collect()} == {(None, 2), ("", 2)}
    assert rows(dedupe.duplicate_rows(df, ["k"])) == [("", 3), ("", 4)]


def test_rule_configuration_errors():
    for rule in (
        7,
        {"type": "length", "column": "a"},
        {"type": "required"},
        {"type": "allowed_values", "column": "a", "values": []},
        {"type": "regex", "column": "a"},
    ):
        with pytest.raises(ValueError):
            rules.prepare_rules({"rules": [rule]})
    with pytest.raises(ValueError):
        rules.prepare_rules({"rules": {}})
    assert rules.prepare_rules({"rules": [{"type": " Required ", "column": "a"}]}).rules[0].name == "rule_1"


def messages(df, *raw, **options):
    found = rules.validate(df, {"rules": list(raw)}, **options)
    return [(n, m) for n, m in rows(found, "row_number", "message")]


def test_rules(people):
    assert messages(people, {"type": "range", "column": "score", "min": 0, "max": 100}) == [
        (4, "value 106 is above max 100"),
        (6, "value 'n.a.' is not numeric"),
        (7, "value -4 is below min 0"),
    ]
    assert messages(people, {"type": "allowed_values", "column": "status", "values": ["OPEN", "closed"]}) == [
        (5, "value 'pending' is not in allowed set")
    ]
    assert messages(people, {"type": "regex", "column": "student_id", "pattern": "s[12]"}) == [
        (7, "value 'S3' does not match required pattern")
    ]
    assert messages(people, {"type": "equals_column", "column": "email", "other_column": ""})[0] == (
        2, "rule misconfigured: other_column is required"
    )
    unguarded = {"type": "required", "column": "department", "when": {"equals": "x"}}
    assert [n for n, _ in messages(people, unguarded)] == [3, 5]
    empty_list = {"type": "required", "column": "department", "when": {"column": "status", "in": []}}
    assert messages(people, empty_list) == []


def test_regex_is_a_full_match(spark):
    df = spark.createDataFrame([(2, "ab\nx"), (3, "AB"), (4, "É1")], "row_idx bigint, c string")
    assert messages(df, {"type": "regex", "column": "c", "pattern": "^ab$"}) == [
        (2, "value 'ab\nx' does not match required pattern"),
        (4, "value 'É1' does not match required pattern"),
    ]
    assert [n for n, _ in messages(df, {"type": "regex", "column": "c", "pattern": r"(?P<w>\w)\d"})] == [2, 3]


def test_missing_columns_stop_the_check(people):
    pack = rules.prepare_rules(
        {"required_columns": ["z"], "rules": [{"type": "required", "column": "y", "when": {"column": "x"}}]}
    )
    assert pack.missing_columns(people) == ["x", "y", "z"]
    assert rules.validate(people, pack).count() == 0
    # A missing key column is no error.
    found = rules.validate(people, {"rules": [{"type": "required", "column": "email"}]}, key="nope")
    assert rows(found, "record_key") == [("",)]


def test_row_local_jobs_do_not_shuffle(spark, people):
    violations = rules.validate(people, {"rules": [{"type": "required", "column": "email"}]})
    assert "Exchange" not in plan(violations)
    assert "Exchange" not in plan(checks.sanitize(people))
    assert "Exchange" not in plan(audit.anomalies(people))
    # The rank by beginning, read for short and for long values, and the rank by value.
    assert plan(profile.profile(people, ["score"])).count("WindowGroupLimit") == 6
    card = integrity.integrity_scorecard(
        people.selectExpr("*", "1 as s", "current_date() as due_date", "current_date() as completed_at"),
        integrity.IntegritySpec(score="s"),
    )
    assert plan(card).count("Exchange") == 2


def test_profile_aggregates_once(spark):
    df = spark.createDataFrame([("a@x", "1"), (None, "x")], "email string, score string")
    found = profile.profile(df)
    found.collect()
    final = plan(found).split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1


def test_keyed_comparison_joins_on_the_index_partitioning(spark):
    source, target = pair(spark)
    found = plan(reconcile.reconcile(source, target, "id", ["v"]))
    assert found.count("Exchange hashpartitioning") == 2


def test_flags_and_filters(spark, people):
    typed = records.apply_schema(people, T.StructType([T.StructField("score", T.LongType())]))
    flagged = checks.flag_first_issue(typed, checks.issue_checks())
    assert rows(flagged, "row_idx", F.coalesce("dq_issue", F.lit("")), "dq_status") == [
        (2, "", "pass"),
        (3, "missing_score", "fail"),
        (4, "invalid_score_range", "fail"),
        (5, "missing_student_id", "fail"),
        (6, "missing_student_id", "fail"),
        (7, "invalid_email", "fail"),
    ]
    blank_score = people.withColumn("score", F.lit(""))
    assert rows(checks.sanitize(blank_score), "row_idx") == [(2,), (3,), (4,)]
    found = checks.check_constraints(
        people, {"email": {"contains": "@"}, "score": {"between": (0, 100)}, "status": {"in": ["open"]}}
    )
    assert rows(found, "row_number", "rule_name") == [
        (3, "score_between"), (3, "status_in"), (4, "score_between"), (5, "email_contains"),
        (5, "status_in"), (6, "score_between"), (7, "score_between"), (7, "status_in"),
    ]


def test_table_sets(people):
    padded = people.withColumnRenamed("status", " status ")
    issues = checks.validate_tables(
        {"P": padded}, ["P", "Q"], {"Q": ["a"], "P": ["email", "campus"]}, {("P", "status"): {"open"}}
    )
    assert rows(issues) == [
        ("invalid_value", "P", "status row 3: Closed"),
        ("invalid_value", "P", "status row 5: pending"),
        ("invalid_value", "P", "status row 7: closed"),
        ("missing_column", "P", "campus"),
        ("missing_sheet", "Q", "Required for column validation"),
        ("missing_sheet", "Q", "Sheet not found"),
    ]
    assert tuple(checks.table_set_summary(issues).first()) == (6, False)


def test_profile(spark, people):
    found = {r.column_name: r for r in profile.profile(people.drop("row_idx")).collect()}
    assert found["student_id"].null_count == 2 and found["student_id"].distinct_count == 3
    assert found["department"].null_rate == round(2 / 6, 4)
    numeric = spark.createDataFrame([("0",), ("-3",), ("-4",), ("104",), (None,), ("NA",)], "s string")
    row = profile.profile(numeric).first()
    assert row.sample_values == ["-3", "-4", "0", "104"]
    assert (row.numeric_min, row.numeric_max, row.null_count) == (-4.0, 104.0, 2)
    empty = profile.profile(numeric.where("false")).first()
    assert (empty.null_rate, empty.distinct_count, empty.sample_values) == (0.0, 0, [])
    rough = profile.profile(numeric, approximate=True).first()
    assert rough.distinct_count == 4 and rough.numeric_max == 104.0


def test_clean_and_etl(spark):
    df = spark.createDataFrame(
        [(2, " 1 ", "04/08/2025"), (3, "1", "x"), (4, "", None), (5, " ", "")],
        "row_idx bigint, `Key Id` string, `Due` string",
    )
    kept = clean.clean(df, ["Due"], ["Key Id"])
    assert rows(kept, "row_idx", "key_id", "due") == [(2, "1", "2025-04-08"), (4, "", "")]
    with pytest.raises(ValueError):
        clean.clean(df, dedupe_keys=["campus"])
    result = etl.transform(df, ["Key Id"], ["Due"], ["Key Id"])
    summary = result.summary.first()
    assert (summary.input_rows, summary.output_rows, summary.duplicate_rows_removed) == (4, 2, 2)
    assert summary.rows_missing_required_values == 2
    absent = etl.transform(df, ["Campus"]).summary.first()
    assert absent.rows_missing_required_values == 4 and absent.missing_required_columns == "Campus"
    assert absent.output_rows == 4


def pair(spark):
    source = spark.createDataFrame(
        [(1, "a", "1", "x"), (2, "a", "9", "x"), (3, "b", " 2", None), (4, "", "5", "q"), (5, "c", "3", "y")],
        "row_idx bigint, id string, v string, w string",
    )
    target = spark.createDataFrame(
        [(1, "a", "1", "y"), (2, "b", "2 ", ""), (3, "d", "4", "z"), (4, None, "5", "q")],
        "row_idx bigint, id string, v string, w string",
    )
    return source, target


def test_reconcile(spark):
    source, target = pair(spark)
    result = reconcile.reconcile(source, target, "id", ["v", "w", "extra"])
    assert rows(result, "record_key", "status", "mismatch_columns", "source_w", "target_w") == [
        ("a", "mismatch", "w", "x", "y"),
        ("b", "match", "", "", ""),
        ("c", "source_only", "", "y", ""),
        ("d", "target_only", "", "", "z"),
    ]
    summary = reconcile.reconcile_summary(source, target, "id", ["v", "w", "extra"]).first().asDict()
    assert summary == {
        "source_records": 5, "source_duplicates_ignored": 1, "source_missing_key_rows": 1,
        "target_records": 4, "target_duplicates_ignored": 0, "target_missing_key_rows": 1,
        "match": 1, "mismatch": 1, "source_only": 1, "target_only": 1,
    }


def test_reconcile_sql_equals_the_full_outer_join(spark):
    source, target = pair(spark)
    source = source.unionByName(spark.createDataFrame([(6, None, "7", "n")], source.schema))
    got = reconcile.reconcile_sql(source, target, "id", ["v"])
    source.createOrReplaceTempView("s")
    target.createOrReplaceTempView("t")
    expected = spark.sql(
        """select coalesce(s.id, t.id) record_key, case when s.id is null then 'target_only'
        when t.id is null then 'source_only' when coalesce(s.v, '') <> coalesce(t.v, '')
        then 'mismatch' else 'match' end reconciliation_status, s.v source_v, t.v target_v
        from s full outer join t on s.id = t.id"""
    )
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_survivorship(spark):
    source, target = pair(spark)
    merge = survivorship.survivorship(source, target, "id", priority=["source"])
    assert rows(merge.merged, "id", "record_origin", "w", "source_of_w", "source_of_v") == [
        ("a", "both", "x", "source", "both"),
        ("b", "both", "", "none", "both"),
        ("c", "source_only", "y", "source", "source"),
        ("d", "target_only", "z", "target", "target"),
    ]
    assert rows(merge.conflicts) == [("a", "w", "x", "y", "x", "source", "source>target")]
    assert merge.summary.first().field_conflicts == 1
    assert survivorship.clean_priority([]) == ["target", "source"]
    assert survivorship.clean_priority([" Source ", "source"]) == ["source", "target"]
    with pytest.raises(ValueError):
        survivorship.clean_priority(["both"])


def test_sla(spark):
    day = dt.date(2025, 4, 9)
    data = [
        ("open", "2025-04-08", None, "overdue", -1),
        ("Open ", "09-04-2025", "", "at_risk", 0),
        ("in_progress", "2025-04-11", None, "at_risk", 2),
        ("open", "2025-04-12", None, "on_track", 3),
        ("blocked", "2025-04-01", None, "not_active", -8),
        ("blocked", "2025-04-01", "2025-04-02", "late_completed", -8),
        ("open", "2025-04-10", "2025/04/10", "completed_on_time", 1),
        ("open", "2025-04-10 00:00:00", "2025-04-10", "no_due_date", None),
    ]
    df = spark.createDataFrame(
        [(i, *row[:3]) for i, row in enumerate(data)],
        "i int, status string, due_date string, completed_at string",
    )
    got = sla.classify_sla(df, day).orderBy("i").collect()
    assert [(r.risk_state, r.days_to_due) for r in got] == [row[3:] for row in data]
    assert rows(sla.sla_at_risk(df, day), "i") == [(0,), (1,), (2,)]


def test_audit(people, tmp_path):
    packet = audit.audit_packet(people)
    assert rows(packet.anomalies, "row_idx", "issue") == [
        (5, "missing_score"), (5, "missing_student_id"), (6, "invalid_score"),
        (6, "missing_student_id"), (7, "low_score"),
    ]
    audit.write_packet(packet, str(tmp_path))
    assert json.loads(next((tmp_path / "summary").glob("*.json")).read_text())["anomaly_rows"] == 5


def test_runs(spark, tmp_path):
    steps = records.read_records(spark, write(tmp_path / "steps.csv", (
        "step,attempt,max_attempts,exit_code,start_utc,end_utc,duration_seconds,status\n"
        "load,1,2,-1,a,b,3,failed\nload,2,2,0,a,b,x,success\n"
    )))
    typed = documents.typed_steps(steps)
    assert [r.exit_code for r in typed.collect()] == [-1, 0]
    assert [r.duration_seconds for r in typed.collect()] == [3, None]
    (tmp_path / "out" / "sub").mkdir(parents=True)
    write(tmp_path / "out" / "sub" / "b.txt", "12345")
    write(tmp_path / "out" / "a.txt", "1")
    files = documents.file_inventory(spark, str(tmp_path / "out"))
    assert rows(files, "relative_path", "size_bytes") == [("a.txt", 1), ("sub/b.txt", 5)]
    assert documents.file_inventory(spark, str(tmp_path / "none")).count() == 0
    assert documents.read_steps(spark, str(tmp_path / "none.csv")).count() == 0
    manifest = runs.run_manifest("r1", "success", "2026-01-02", typed, files.limit(0), files, log_size=4)
    counts = manifest.header.first().counts
    assert (counts.total_files, counts.steps_total, counts.steps_failed, counts.steps_retried) == (2, 2, 1, 1)
    runs.write_manifest(manifest, str(tmp_path / "manifest"))
    entry = documents.read_manifest(spark, str(tmp_path / "manifest" / "header"))
    # A folder of part files may hold empty ones; the header is the row with an id.
    entry = entry.where("run_id <> ''")
    assert (entry.first().run_id, entry.first().steps_retried) == ("r1", 1)

    history = documents.read_history(spark, write(tmp_path / "h.json", json.dumps({"runs": [
        {"run_id": "r1", "generated_utc": "2026-01-01"}, 5, {"run_id": None, "generated_utc": "2026-01-02"},
        {"run_id": "r0", "generated_utc": "2026-01-03", "counts": {"steps_total": 2}},
    ]})))
    merged = runs.upsert_history(history, entry, max_entries=3).collect()
    assert [(r.run_id, r.generated_utc) for r in merged] == [
        ("r0", "2026-01-03"), ("", "2026-01-02"), ("r1", "2026-01-02"),
    ]
    assert documents.read_history(spark, write(tmp_path / "bad.json", "{oops")).count() == 0
    assert documents.read_history(spark, write(tmp_path / "list.json", '[{"run_id": "x"}]')).count() == 1
    assert documents.read_history(spark, str(tmp_path / "missing.json")).count() == 0
    with pytest.raises(ValueError):
        runs.upsert_history(history, entry, max_entries=0)
    runs.write_history(runs.upsert_history(history, entry), str(tmp_path / "hist"), "2026-02-01")
    header = spark.read.json(str(tmp_path / "hist" / "header")).first()
    assert (header.updated_utc, header.max_entries, header.total_runs) == ("2026-02-01", 200, 3)
    assert spark.read.json(str(tmp_path / "hist" / "runs")).count() == 3


def test_retention(spark):
    files = spark.createDataFrame(
        [(f"logs/run-{i}.log", i, f"2026-01-0{i}") for i in range(1, 6)] + [("x", 1, "2026-01-01")],
        "relative_path string, size_bytes bigint, modified_utc string",
    )
    old = runs.expired_artifacts(files, {"logs": "^logs/run-.*"}, keep=2)
    assert rows(old, "relative_path") == [("logs/run-1.log",), ("logs/run-2.log",), ("logs/run-3.log",)]


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_record_files(spark, tmp_path):
    write(tmp_path / "b.csv", 'id,note\n3,"x ""q"""\n4,\n')
    write(tmp_path / "a.csv", 'id,note\n1,"line\nbreak"\n\n2,short,extra\n')
    numbered = records.with_row_idx(records.read_records(spark, str(tmp_path / "*.csv")))
    assert rows(numbered, "row_idx", "id", F.coalesce("note", F.lit(""))) == [
        (2, "1", "line\nbreak"), (3, "2", "short"), (4, "3", 'x "q"'), (5, "4", ""),
    ]
    sinks.write_csv(numbered.drop("row_idx"), str(tmp_path / "out"), quote_all=True)
    back = records.read_records(spark, str(tmp_path / "out"))
    assert rows(back, "id", F.coalesce("note", F.lit(""))) == rows(
        numbered, "id", F.coalesce("note", F.lit(""))
    )


@pytest.mark.parametrize("kind", ["csv", "parquet"])
def test_ordinals_hold_when_files_are_split_anew(spark, tmp_path, kind):
    parts = [spark.range(a, a + 700).selectExpr("id", "repeat('x', 40) as note").coalesce(1) for a in (0, 700)]
    for name, part in zip("ab", parts):
        part.write.option("header", True).format(kind).save(str(tmp_path / name))
    reader = spark.read.option("header", True).format(kind)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
        numbered = records.with_row_idx(reader.load([str(tmp_path / "a"), str(tmp_path / "b")]))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        found = {int(r.id): r.row_idx for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {i: i + 2 for i in range(1400)}


def test_numbering_sends_no_rows_by_path(spark, tmp_path):
    """Whatever Spark believes of the sizes, the rows of a file do not meet in one task."""
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "a"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        numbered = records.with_row_idx(spark.read.parquet(str(tmp_path / "a")))
        plan = numbered._jdf.queryExecution().sparkPlan().toString()
        found = {r.id: r.row_idx for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    outer = [line for line in plan.splitlines() if "LeftOuter" in line]
    assert len(outer) == 1 and "BroadcastHashJoin" in outer[0]
    assert found == {i: i + 2 for i in range(50)}


def test_output_in_key_order(spark, tmp_path):
    sinks.write_csv(spark.range(50).selectExpr("cast(100 - id as string) as k").repartition(4), str(tmp_path / "o"), order_by=["k"])
    lines = [x for f in sorted((tmp_path / "o").glob("part-*")) for x in f.read_text().split()[1:]]
    assert lines == sorted(lines) and len(lines) == 50


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1, "", "x"), (2, "b", "y")], "`row.no` bigint, `a.b` string, k string")
    found = rules.validate(df, {"rules": [{"type": "required", "column": "a.b"}]}, row_number="row.no", key="k")
    assert rows(found, "row_number", "record_key") == [(1, "x")]
    merged = survivorship.survivorship(df, df, key="k", order_by="row.no")
    assert merged.merged.count() == 2 and merged.summary.first().both_sources == 2


def test_run_etl_writes_only_when_applied(spark, tmp_path):
    config = {
        "source_csv": write(tmp_path / "in.csv", "id,due\n1,04/08/2025\n1,x\n,\n"),
        "output_csv": str(tmp_path / "out"),
        "summary_json": str(tmp_path / "summary"),
        "required_columns": ["id"],
        "date_columns": ["due"],
        "drop_duplicates_by": ["id"],
    }
    etl.run_etl(spark, config)
    assert not (tmp_path / "out").exists() and (tmp_path / "summary").exists()
    etl.run_etl(spark, config, apply=True)
    back = records.read_records(spark, str(tmp_path / "out"))
    assert {tuple(r) for r in back.collect()} == {("1", "2025-04-08"), (None, None)}


def test_streaming_records(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "1.csv", "row_idx,id\n2,a\n3,\n")
    stream = streaming.record_stream(spark, str(folder), "row_idx string, id string")
    job = lambda df: rules.validate(df, {"rules": [{"type": "required", "column": "id"}]}, key="id")
    for more in (None, "4,b\n5, \n"):
        if more:
            write(folder / "2.csv", "row_idx,id\n" + more)
        streaming.start_job(stream, job, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination(60)
    assert rows(spark.read.parquet(str(tmp_path / "o")), "row_number") == [(3,), (5,)]
