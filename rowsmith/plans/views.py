"""Record tables derived from the given tables.

Each view is a list of SQL expressions over one table, so the same text builds it
in Spark and in the checking database.  Defects (blank keys, bad dates, changed
values, repeated records) are planted by arithmetic on the key; every row of the
base table is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Parts that several columns use, computed once per order.
_ORDER_PARTS = {
    "iso_day": "cast(cast(o_orderdate as date) as string)",
    "id_text": "lpad(cast(o_orderkey as string), 12, '0')",
    "customer_text": "cast(o_custkey as string)",
}
_DAY, _ID, _CUST = _ORDER_PARTS
_LATER = "cast(cast(o_orderdate as date) + cast(o_orderkey % 7 - 3 as int) as string)"
_SCORE = "cast(floor(o_totalprice / 5000) as bigint)"
_DEPT = "'Dept ' || substr(o_orderpriority, 1, 1)"

_DUE = f"""case
    when o_orderkey % 53 = 10 then null
    when o_orderkey % 47 = 11 then 'not a date'
    when o_orderkey % 7 = 1 then substr({_DAY}, 9, 2) || '-' || substr({_DAY}, 6, 2) || '-' || substr({_DAY}, 1, 4)
    when o_orderkey % 7 = 2 then replace({_DAY}, '-', '/')
    when o_orderkey % 7 = 3 then substr({_DAY}, 6, 2) || '/' || substr({_DAY}, 9, 2) || '/' || substr({_DAY}, 1, 4)
    when o_orderkey % 7 = 4 and o_orderkey % 3 = 0 then {_DAY} || ' 09:05:03'
    else ' ' || {_DAY} end"""

SOURCE_RECORDS = {
    "row_idx": "cast(o_orderkey * 2 + copy as bigint)",
    "student_id": f"""case when o_orderkey % 97 = 5 then ''
        when o_orderkey % 13 = 0 then 'NEW' || {_ID} else 'STU' || {_ID} end""",
    "first_name": f"'user' || {_CUST}",
    "last_name": "lower(o_orderpriority)",
    "email": f"""case when o_orderkey % 23 = 1 then null
        when o_orderkey % 59 = 2 then 'bad-email'
        when copy = 1 then 'alt' || {_CUST} || '@example.edu'
        else 'user' || {_CUST} || '@example.edu' end""",
    "department": f"""case when o_orderkey % 41 = 3 then null
        when o_orderkey % 61 = 7 then chr(9) || {_DEPT} || chr(10) else {_DEPT} end""",
    "score": f"""case when o_orderkey % 29 = 4 then null
        when o_orderkey % 37 = 6 then '106'
        when o_orderkey % 43 = 7 then '-4'
        when o_orderkey % 67 = 8 then 'n.a.'
        else cast({_SCORE} as string) end""",
    "status": """case when o_orderkey % 31 = 9 then 'pending_review'
        when o_orderstatus = 'F' then ' Closed '
        when o_orderstatus = 'O' then 'open' else 'in_progress' end""",
    "due_date": _DUE,
    "completed_at": f"case when o_orderstatus = 'F' then {_LATER} end",
}

# Scores as a spreadsheet script reads them.
LENIENT_RECORDS = SOURCE_RECORDS | {
    "score": f"""case when o_orderkey % 71 = 3 then '1_0' when o_orderkey % 73 = 4 then '0x10'
        when o_orderkey % 79 = 5 then '0xfff' when o_orderkey % 83 = 6 then ' 7. '
        else {SOURCE_RECORDS['score']} end""",
}

TARGET_RECORDS = {
    "row_idx": "cast(o_orderkey * 2 as bigint)",
    "student_id": f"case when o_orderkey % 11 = 0 then 'OLD' || {_ID} else 'STU' || {_ID} end",
    "first_name": f"'user' || {_CUST}",
    "last_name": "lower(o_orderpriority)",
    "email": f"""case when o_orderkey % 19 = 3 then 'new' else 'user' end
        || {_CUST} || '@example.edu'""",
    "department": _DEPT,
    "score": f"cast({_SCORE} + case when o_orderkey % 5 = 0 then 1 else 0 end as string)",
    "status": """case when o_orderkey % 17 = 2 then 'open' when o_orderstatus = 'F' then 'Closed'
        when o_orderstatus = 'O' then 'open' else 'in_progress' end""",
    "due_date": _DAY,
    "completed_at": f"case when o_orderstatus = 'F' then {_DAY} end",
    "reviewer": "case when o_orderkey % 3 = 0 then 'panel ' || cast(o_custkey % 9 as string) end",
}

TASKS = {
    "row_idx": "cast(o_orderkey as bigint)",
    "task_id": f"'TSK' || {_ID}",
    "owner": "'Team ' || cast(o_custkey % 16 as string)",
    "status": """case when o_orderkey % 31 = 9 then 'blocked' when o_orderstatus = 'F' then 'completed'
        when o_orderstatus = 'O' then ' Open' else 'in_progress' end""",
    "due_date": _DUE,
    "completed_at": f"case when o_orderstatus = 'F' and o_orderkey % 4 <> 1 then {_LATER} end",
    "priority": "lower(o_orderpriority)",
}

# Invented names: letters from a digest of the customer key.
_LETTERS = "'0123456789abcdef', 'aeioulnrstmdbkgv'"
_WORD1 = f"translate(substr(md5(cast(c_custkey as string)), 1, 8), {_LETTERS})"
_WORD2 = f"translate(substr(md5(cast(c_custkey as string)), 9, 9), {_LETTERS})"
_CKEY = "lpad(cast(c_custkey as string), 12, '0')"

# Sources without a partner are named in digits: they share the space between two words
# with every target and nothing else, so their best score is 2 * 1 / (18 + 18), with the
# boost where a target of their department was unused at their turn.
_ALONE = "c_custkey % 70 = 0"

PEOPLE_SOURCE = {
    "row_idx": "cast(c_custkey as bigint)",
    "student_id": f"""case when c_custkey % 3 = 0 then ''
        when c_custkey % 3 = 1 then 'C' || {_CKEY} else 'X' || {_CKEY} end""",
    "first_name": f"""case when {_ALONE} then substr({_CKEY}, 5, 8)
        when c_custkey % 2 = 0 then 'x' || substr({_WORD1}, 2) else upper({_WORD1}) end""",
    "last_name": f"case when {_ALONE} then ' ' || substr({_CKEY}, 4, 9) || ' ' else {_WORD2} end",
    "department": "case when c_custkey % 10 = 4 then null else lower(c_mktsegment) end",
}

PEOPLE_TARGET = {
    "row_idx": "cast(c_custkey as bigint)",
    "student_id": f"case when {_ALONE} then '' else 'C' || {_CKEY} end",
    "first_name": _WORD1,
    "last_name": _WORD2,
    "department": "c_mktsegment",
}

# Names are shared by many parts; keyed and unkeyed parts have names of their own, some
# parts have none, and every name has at least as many targets as sources.
EQUAL_SOURCE = {
    "row_idx": "cast(p_partkey as bigint)",
    "student_id": "case when p_partkey % 3 = 1 then 'P' || cast(p_partkey as string) else '' end",
    "first_name": """case when p_partkey % 3 = 1 then 'keyed' when p_partkey % 3 = 0 then 'Plain'
        else ' ' end""",
    "last_name": "case when p_partkey % 3 = 2 then '' else p_name end",
    "department": "p_type",
}

EQUAL_TARGET = {
    "row_idx": "cast(p_partkey as bigint)",
    "student_id": "'P' || cast(p_partkey as string)",
    "first_name": """case when p_partkey % 3 = 1 then 'keyed'
        when p_partkey % 3 = 0 or p_partkey % 2 = 0 then 'plain' else 'spare' end""",
    "last_name": "p_name",
    "department": "p_type",
}

# Events stand in for workflow runs, their steps and their artifacts.
STEP_RECORDS = {
    "step": "' ' || event_type || ' '",
    "attempt": "case when event_id % 17 = 0 then 'x' else cast(event_id % 4 as string) end",
    "max_attempts": "'3'",
    "status": "case when event_type = 'error' then 'failed' else 'success' end",
    "exit_code": "case when event_id % 11 = 0 then '' when event_type = 'error' then '-1' else '0' end",
    "start_utc": "cast(ts as string)",
    "end_utc": "cast(ts as string)",
    "duration_seconds": "cast(cast(floor(value) as bigint) as string)",
}

RUN_ENTRIES = {
    "ordinal": "cast(event_id as bigint)",
    "run_id": """case when event_id % 19 = 0 then ''
        else 'run-' || cast(user_id as string) || '-' || cast(event_id as string) end""",
    "status": "case when event_type = 'error' then 'failed' else 'success' end",
    "generated_utc": "cast(cast(ts as date) as string)",
    "manifest_file": "'manifest-' || cast(event_id as string)",
    "log_file": "'log-' || cast(event_id as string)",
    "steps_file": "''",
    "report_files": "cast(event_id % 5 as bigint)",
    "output_files": "cast(event_id % 3 as bigint)",
    "steps_total": "cast(9 as bigint)",
    "steps_failed": "cast(case when event_type = 'error' then 1 else 0 end as bigint)",
    "steps_retried": "cast(event_id % 2 as bigint)",
}

ARTIFACTS = {
    "relative_path": """case when event_id % 3 = 0 then 'logs/daily-run-'
        when event_id % 3 = 1 then 'reports/run_manifest-' else 'other/note-' end
        || cast(event_id as string) || '.txt'""",
    "size_bytes": "cast(event_id % 1000 as bigint)",
    "modified_utc": "cast(ts as string)",
}

_COPIES = "case when o_orderkey % 50 = 12 then 2 else 1 end"

BASE = {
    "src": ("orders", SOURCE_RECORDS),
    "lenient_src": ("orders", LENIENT_RECORDS),
    "tgt": ("orders", TARGET_RECORDS),
    "tasks": ("orders", TASKS),
    "people_src": ("customer", PEOPLE_SOURCE),
    "people_tgt": ("customer", PEOPLE_TARGET),
    "equal_src": ("part", EQUAL_SOURCE),
    "equal_tgt": ("part", EQUAL_TARGET),
    "steps": ("events", STEP_RECORDS),
    "runs": ("events", RUN_ENTRIES),
    "artifacts": ("events", ARTIFACTS),
}


#: Views that repeat some records.
REPEATED = ("src", "lenient_src")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A derived view; ``src`` reads each base row once and repeats some."""
    base, columns = BASE[name]
    rows = table(spark, folder, base)
    if base == "orders":
        rows = rows.selectExpr("*", *[f"{sql} as {part}" for part, sql in _ORDER_PARTS.items()])
    if name in REPEATED:
        rows = rows.selectExpr("*", f"explode(sequence(0, {_COPIES} - 1)) as copy")
    return rows.selectExpr(*[f"{sql} as {column}" for column, sql in columns.items()])


def view_sql(name: str) -> str:
    """The same view as a query of the checking database."""
    base, columns = BASE[name]
    select = ", ".join(f"{sql} as {column}" for column, sql in columns.items())
    if base == "orders":
        parts = ", ".join(f"{sql} as {part}" for part, sql in _ORDER_PARTS.items())
        base = f"(select *, {parts} from orders)"
    if name in REPEATED:
        base = f"(select *, unnest(range({_COPIES})) as copy from {base})"
    return f"select {select} from {base}"
