"""Quoted records read by many tasks, and allowed values given as a table."""

from __future__ import annotations

import csv
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowsmith.operators import profile, reconcile, rules, runs
from rowsmith.sources import records, sinks


@pytest.fixture
def small_splits(spark):
    names = {"maxPartitionBytes": "3000", "openCostInBytes": "1", "minPartitionNum": "1"}
    for name, value in names.items():
        spark.conf.set(f"spark.sql.files.{name}", value)
    yield
    for name in names:
        spark.conf.unset(f"spark.sql.files.{name}")


def cells(rng):
    parts = ["a", "b", " ", ",", '"', "\n", '5" x', "", "é", "x\n\ny", '""', "\n" * 3]
    return ["".join(rng.choices(parts, k=rng.randint(0, 6))) for _ in range(3)]


@pytest.mark.parametrize("kind", ["mixed", "one long cell", "plain"])
def test_scan_of_quoted_records(spark, tmp_path, small_splits, kind):
    rng = random.Random(kind)
    body = [[f"k{i}", *cells(rng)] for i in range(300)]
    if kind == "one long cell":
        body[100][1] = 'line, with "quotes"\n' * 600
    if kind == "plain":
        body = [[f"k{i}", "x", str(i), "y" * 9] for i in range(700)]
    path = f"{tmp_path}/a.csv"
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n")
        writer.writerows([["id", "x", "y", "z"], *body])
        out.write('p1,5" pipe,b"c"d,e\n\nlast,"","q ""r""",z')
    with open(path, newline="") as lines:
        want = Counter(tuple(r) for r in list(csv.reader(lines))[1:] if r)
    assert spark.read.text(path).rdd.getNumPartitions() > 2
    found = records.scan_records(spark, path)
    assert found.columns == ["id", "x", "y", "z"]
    assert Counter(tuple(c or "" for c in r) for r in found.collect()) == want


def test_scan_of_several_written_files(spark, tmp_path):
    data = [(i, f" {i}, \"q\"\n ", None if i % 3 else "ü") for i in range(40)]
    df = spark.createDataFrame(data, "id int, text string, other string").repartition(3)
    sinks.write_csv(df, f"{tmp_path}/out", quote_all=True)
    found = records.scan_records(spark, f"{tmp_path}/out").collect()
    assert sorted((int(r.id), r.text, r.other or "") for r in found) == [(i, t, o or "") for i, t, o in data]


def test_scan_of_a_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n")
    assert records.scan_records(spark, f"{tmp_path}/a.csv").collect() == []


def test_allowed_values_of_a_table(spark):
    """A list of any length as a table gives what the same list gives in the rule."""
    people = spark.createDataFrame(
        [(i, f"S{i}", v) for i, v in enumerate(["Open", " open ", "lost", "", None, "K77", "k999999", "K1000000"])],
        "row_idx int, student_id string, status string",
    )
    known = spark.range(1_000_000).selectExpr("concat('k', id) as word").union(
        spark.createDataFrame([("OPEN",), ("open",), (None,)], "word string")
    )
    for exact in (False, True):
        listed = {"type": "allowed_values", "column": "status", "case_sensitive": exact}
        words = ["OPEN", "open", "k77", "k999999"]
        some = rules.validate(people, {"rules": [listed | {"values": words}]})
        many = rules.validate(
            people, {"rules": [listed | {"table": "known"}]}, tables={"known": known}
        )
        assert sorted(map(tuple, many.collect())) == sorted(map(tuple, some.collect()))
        summary = rules.validation_summary(
            people, {"rules": [listed | {"table": "known"}]}, tables={"known": known}
        ).first()
        assert summary.violation_count == some.count()
    with pytest.raises(ValueError):
        rules.validate(people, {"rules": [listed | {"table": "absent"}]})


def test_profile_of_long_values(spark):
    """Long values count by digest; of those with one beginning the smallest are shown."""
    head = "h" * 200
    values = [head + str(i % 7) for i in range(30)] + ["0" * 300 + "5", "zz", None, "n/a", head[:128]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, text string")
    text = profile.profile(df).where("column_name = 'text'").first()
    kept = sorted({v for v in values if v not in (None, "n/a")})
    assert text.null_count == 2
    assert text.distinct_count == len(kept)
    assert text.sample_values == kept[:5]
    assert text.numeric_min is None
    numbers = spark.createDataFrame([("0" * 300 + "5",), ("7",)], "x string")
    row = profile.profile(numbers).first()
    assert (row.numeric_min, row.numeric_max, row.distinct_count) == (5.0, 7.0, 2)


def test_profile_shuffles_no_long_text(spark):
    df = spark.createDataFrame([("x" * 9999,)], "text string")
    lines = profile.profile(df)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    keys = [line for line in lines if "Aggregate [ordinal" in line]
    assert any("head" in k and "digest" in k for k in keys)
    assert not any("Aggregate [ordinal#" in k and "value#" in k.split("]")[0] for k in keys)


def document(folder):
    """The part files below a folder, joined in the order of their paths."""
    parts = sorted(folder.rglob("part-*"))
    return json.loads("".join(p.read_text() for p in parts))


@pytest.mark.parametrize("n", [0, 1, 50])
def test_manifest_as_one_document(spark, tmp_path, n):
    steps = spark.createDataFrame(
        [(f"s{i % 40:02}", "ok", None) for i in range(n)], "step string, status string, note string"
    ).repartition(3)
    files = spark.createDataFrame([(f'r/"{i}"', i) for i in range(n)], "relative_path string, size long")
    header = spark.createDataFrame([("run-1", None)], "run_id string, log string")
    manifest = runs.Manifest(header, steps, files, files.limit(0))
    runs.write_manifest_document(manifest, f"{tmp_path}/doc")
    found = document(tmp_path / "doc")
    assert list(found) == ["run_id", "log", "steps", "reports", "outputs"]
    assert [s["step"] for s in found["steps"]] == sorted(f"s{i % 40:02}" for i in range(n))
    assert [f["size"] for f in found["reports"]] == [i for _, i in sorted((f'r/"{i}"', i) for i in range(n))]
    assert found["outputs"] == [] and found["log"] is None


def test_history_replaced_while_it_is_read(spark, tmp_path, monkeypatch):
    root, kind = f"{tmp_path}/history", "run_id string, generated_utc string, status string"
    order = F.monotonically_increasing_id().alias("ordinal")

    def now():
        return sinks.current(spark, root, "runs", kind)

    def add(name, at):
        entry = spark.createDataFrame([(name, at, "ok")], kind)
        merged = runs.upsert_history(now().select("*", order), entry, max_entries=2)
        return runs.publish_history(merged, root, at, max_entries=2)

    assert now().count() == 0
    for k in range(3):
        add(f"r{k}", f"2024-01-0{k + 1}")
    assert [r.run_id for r in now().collect()] == ["r2", "r1"]

    def dies(*args):
        raise RuntimeError("killed between write and switch")

    monkeypatch.setattr(sinks, "switch", dies)
    with pytest.raises(RuntimeError):
        add("r9", "2024-02-01")
    assert [r.run_id for r in now().collect()] == ["r2", "r1"]
    monkeypatch.undo()
    add("r9", "2024-02-01")
    assert [r.run_id for r in now().collect()] == ["r9", "r2"]


def test_key_hot_on_both_sides_meets_in_a_grid(spark, monkeypatch):
    """Every pair of rows of the key is there once, and no cell holds many rows."""
    monkeypatch.setattr(reconcile, "HOT", 10)
    key = lambda i, n: "hot" if i < n else f"k{i}" if i % 5 else None
    source = spark.createDataFrame([(key(i, 64), str(i % 3)) for i in range(90)], "id string, v string")
    target = spark.createDataFrame([(key(i, 45), str(i % 4)) for i in range(100)], "id string, v string")
    found = reconcile.reconcile_sql(source, target, "id", ["v"]).collect()
    want = source.alias("s").join(target.alias("t"), F.col("s.id") == F.col("t.id"), "full").select(
        F.coalesce("s.id", "t.id"), "s.v", "t.v"
    ).collect()
    shown = Counter((r.record_key, r.source_v, r.target_v) for r in found)
    assert shown == Counter(map(tuple, want))
    assert sum(r.record_key == "hot" for r in found) == 64 * 45
    left, right = (df.where("id = 'hot'").coalesce(1) for df in (source, target))
    for df, n in zip(reconcile.gridded(left, right, reconcile.hot_keys(left, right, ["id"]), ["id"]), (7, 5)):
        cells = df.groupBy("__row", "__column").count().collect()
        assert len(cells) == 35 and max(c["count"] for c in cells) <= 10
