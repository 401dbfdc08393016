"""The registered queries as SQL for the checking database."""

from __future__ import annotations

from .catalogue import AS_OF, COMPARED, SLA_DAYS
from .views import view_sql

_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"
_LAYOUTS = "'%Y-%m-%d', '%Y/%m/%d', '%d-%m-%Y', '%m/%d/%Y'"
SRC_COLUMNS = [
    "student_id", "first_name", "last_name", "email", "department", "score", "status",
    "due_date", "completed_at",
]
MERGED = [c for c in SRC_COLUMNS if c != "student_id"] + ["reviewer"]


def n(c: str) -> str:
    return f"trim(coalesce(cast({c} as varchar), ''), {_WS})"


def norm_date(c: str) -> str:
    parsed = f"try_strptime({n(c)}, [{_LAYOUTS}, '%Y-%m-%d %H:%M:%S'])"
    return f"coalesce(strftime({parsed}, '%Y-%m-%d'), {n(c)})"


def date(c: str) -> str:
    return f"cast(try_strptime({n(c)}, [{_LAYOUTS}]) as date)"


def number(c: str) -> str:
    return f"try_cast({n(c)} as double)"


def views(*names: str, **extra: str) -> str:
    parts = [f"{name} as ({view_sql(name)})" for name in names]
    parts += [f"{name} as ({sql})" for name, sql in extra.items()]
    return "with " + ", ".join(parts) + " "


def first_wins(table: str, keys: list[str], where: str = "true") -> str:
    by = ", ".join(keys)
    return (
        f"select * exclude (rn) from (select *, row_number() over (partition by {by} "
        f"order by row_idx) as rn from {table} where {where}) where rn = 1"
    )


TYPED = f"""select row_idx, student_id, first_name, last_name, email, department,
    try_cast(trim(score) as integer) as score, status,
    try_cast({norm_date('due_date')} as date) as due_date,
    try_cast({norm_date('completed_at')} as date) as completed_at from src"""
TYPED_VIEWS = views("src", typed=TYPED)

CLEAN = ", ".join(
    f"{norm_date(c) if c in ('due_date', 'completed_at') else n(c)} as {c}" for c in SRC_COLUMNS
)
CLEAN_VIEWS = views("src", cleaned=f"select row_idx, {CLEAN} from src")
COUNTS = f"""(select count(*) as {{0}}records,
    cast(count(*) filter ({n('student_id')} <> '')
        - count(distinct nullif({n('student_id')}, '')) as bigint) as {{0}}duplicates_ignored,
    count(*) filter ({n('student_id')} = '') as {{0}}missing_key_rows from {{1}})"""

STATUSES = "('open', 'closed', 'in_progress', 'completed')"


def profile(table: str, columns: list[str], with_clause: str = "") -> str:
    parts = []
    for c in columns:
        value = f"case when lower({n(c)}) not in ('', 'null', 'none', 'na', 'n/a') then {n(c)} end"
        parts.append(f"select '{c}' as column_name, {value} as v from {table}")
    sample = ", coalesce(array_to_string(list_sort(list(distinct v)"
    sample += " filter (v is not null))[1:5], '|'), '') as sample_values"
    numeric = "count(v) > 0 and count(v) = count(try_cast(v as double))"
    return f"""{with_clause} select column_name,
        count(*) filter (v is null) as null_count,
        round_even(count(*) filter (v is null) / count(*), 4) as null_rate,
        count(distinct v) as distinct_count,
        case when {numeric} then min(try_cast(v as double)) end as numeric_min,
        case when {numeric} then max(try_cast(v as double)) end as numeric_max
        {sample}
        from ({' union all '.join(parts)}) group by column_name"""


def g(c: str) -> str:
    """A number of the test data in its shortest form."""
    return f"regexp_replace(cast({c} as varchar), '\\.0$', '')"


def rule(name: str, kind: str, column: str, condition: str, message: str) -> str:
    return f"""select cast(row_idx as bigint) as row_number, {n('student_id')} as record_key,
        '{name}' as rule_name, '{kind}' as rule_type, '{column}' as "column",
        {n(column)} as value, {message} as message from src where {condition}"""


def required(name: str, column: str, when: str = "true") -> str:
    return rule(name, "required", column, f"{n(column)} = '' and {when}", "'value is required'")


def allowed(name: str, values: str, when: str = "true", exact: bool = False) -> str:
    value = n("status") if exact else f"lower({n('status')})"
    return rule(
        name, "allowed_values", "status",
        f"{n('status')} <> '' and {value} not in {values} and {when}",
        f"'value ''' || {n('status')} || ''' is not in allowed set'",
    )


def in_range(name: str, low: str | None, high: str, when: str = "true") -> str:
    v = number("score")
    bad = f"{v} is null or {v} > {high}" + (f" or {v} < {low}" if low else "")
    below = f"when {v} < {low} then 'value ' || {g(v)} || ' is below min {low}'" if low else ""
    message = f"""case when {v} is null then 'value ''' || {n('score')} || ''' is not numeric'
        {below} else 'value ' || {g(v)} || ' is above max {high}' end"""
    return rule(name, "range", "score", f"{n('score')} <> '' and ({bad}) and {when}", message)


def regex(name: str, column: str, pattern: str, flags: str = "i") -> str:
    return rule(
        name, "regex", column,
        f"{n(column)} <> '' and not regexp_full_match({n(column)}, '{pattern}', '{flags}')",
        f"'value ''' || {n(column)} || ''' does not match required pattern'",
    )


def equal(name: str, column: str, other: str, when: str = "true") -> str:
    return rule(
        name, "equals_column", column, f"{n(column)} <> {n(other)} and {when}",
        f"'value ''' || {n(column)} || ''' does not match {other} ''' || {n(other)} || ''''",
    )


PACK = {
    "key_shape": regex("key_shape", "student_id", "(stu|new)[0-9]{12}"),
    "team_named": required("team_named", "department"),
    "score_in_reach": in_range("score_in_reach", "1", "88"),
    "known_state": allowed("known_state", "('open', 'in_progress', 'closed')"),
    "end_planned": required("end_planned", "completed_at", f"lower({n('status')}) = 'open'"),
    "mail_place": regex("mail_place", "email", r"[a-z]+[0-9]+@example\.edu"),
    "team_ceiling": in_range(
        "team_ceiling", None, "70", f"lower({n('department')}) in ('dept 1', 'dept 5')"
    ),
}
VIOLATIONS = " union all ".join(PACK.values())
BY_RULE = "concat_ws('|', " + ", ".join(
    f"""case when count_if(rule_name = '{name}') > 0
        then '{name}=' || cast(count_if(rule_name = '{name}') as varchar) end""" for name in PACK
) + ")"
RULE_VIEWS = views("src")

FLAGS = f"""select *, case
    when student_id is null or {n('student_id')} = '' then 'missing_student_id'
    when email is null or strpos(email, '@') <= 1 then 'invalid_email'
    when score is null then 'missing_score'
    when score < 0 or score > 100 then 'invalid_score_range'
    when status is null or lower({n('status')}) not in {STATUSES} then 'invalid_status' end
    as dq_issue from typed"""
FLAGGED = f"""select *, case when dq_issue is null then 'pass' else 'fail' end as dq_status
    from ({FLAGS})"""


def constraint(column: str, kind: str, bad: str, message: str) -> str:
    return rule(f"{column}_{kind}", kind, column, f"{n(column)} <> '' and {bad}", f"'{message}'")


_PAIRED = {
    "s": first_wins("src", [n("student_id")], f"{n('student_id')} <> ''"),
    "t": first_wins("tgt", [n("student_id")], f"{n('student_id')} <> ''"),
}
_ON = f"on {n('s.student_id')} = {n('t.student_id')}"
_DIFFERS = ", ".join(
    f"case when {n('s.' + c)} <> {n('t.' + c)} then '{c}' end" for c in COMPARED
)
RECONCILED = f"""select coalesce({n('s.student_id')}, '') ||
        case when s.student_id is null then {n('t.student_id')} else '' end as record_key,
    case when t.student_id is null then 'source_only' when s.student_id is null then 'target_only'
        when concat_ws('|', {_DIFFERS}) <> '' then 'mismatch' else 'match' end as status,
    case when s.student_id is null or t.student_id is null then ''
        else concat_ws('|', {_DIFFERS}) end as mismatch_columns,
    {', '.join(f"{n('s.' + c)} as source_{c}, {n('t.' + c)} as target_{c}" for c in COMPARED)}
    from s full outer join t {_ON}"""
RECONCILE_VIEWS = views("src", "tgt", **_PAIRED, result=RECONCILED)

_SQL_DIFFERS = " or ".join(f"coalesce(s.{c}, '') <> coalesce(t.{c}, '')" for c in COMPARED)
RECONCILE_SQL = (
    views("src", "tgt", s="select * replace (nullif(student_id, '') as student_id) from src")
    + f"""select coalesce(s.student_id, t.student_id) as record_key,
    case when s.student_id is null then 'target_only' when t.student_id is null then 'source_only'
        when {_SQL_DIFFERS} then 'mismatch' else 'match' end as reconciliation_status,
    {', '.join(f"s.{c} as source_{c}, t.{c} as target_{c}" for c in COMPARED)}
    from s full outer join tgt t on s.student_id = t.student_id"""
)


def survivors(prefer: str) -> str:
    cells = []
    for c in MERGED:
        ours = n("s." + c) if c != "reviewer" else "''"
        theirs = n("t." + c)
        first, second = (theirs, ours) if prefer == "target" else (ours, theirs)
        cells.append(f"coalesce(nullif({first}, ''), {second}) as {c}")
        cells.append(
            f"case when {ours} = '' and {theirs} = '' then 'none' when {ours} = {theirs} then 'both' "
            f"when {first} <> '' then '{prefer}' "
            f"else '{'source' if prefer == 'target' else 'target'}' end as source_of_{c}"
        )
    return f"""select coalesce(nullif({n('s.student_id')}, ''), {n('t.student_id')}) as student_id,
        case when s.student_id is not null and t.student_id is not null then 'both'
            when s.student_id is not null then 'source_only' else 'target_only' end
            as record_origin, {', '.join(cells)}
        from s full outer join t {_ON}"""


CONFLICTS = " union all ".join(
    f"""select {n('s.student_id')} as record_key, '{c}' as "column", {n('s.' + c)} as source_value,
    {n('t.' + c)} as target_value, {n('t.' + c)} as chosen_value, 'target' as chosen_from,
    'target>source' as priority from s join t {_ON}
    where {n('s.' + c)} <> '' and {n('t.' + c)} <> '' and {n('s.' + c)} <> {n('t.' + c)}"""
    for c in MERGED if c != "reviewer"
)
MERGE_VIEWS = views("src", "tgt", **_PAIRED)

SLA = f"""select *, case when due is null then 'no_due_date'
        when done > due then 'late_completed' when done is not null then 'completed_on_time'
        when lower({n('status')}) not in ('open', 'in_progress') then 'not_active'
        when days_to_due < 0 then 'overdue' when days_to_due <= {SLA_DAYS} then 'at_risk'
        else 'on_track' end as risk_state
    from (select *, {date('due_date')} as due, {date('completed_at')} as done,
        cast({date('due_date')} - date '{AS_OF}' as integer) as days_to_due from tasks)"""
SLA_VIEWS = views("tasks", states=f"select * exclude (due, done) from ({SLA})")

ANOMALIES = f"""select *, 'missing_student_id' as issue from src where {n('student_id')} = ''
    union all select *, case when {n('score')} = '' then 'missing_score'
        when {number('score')} is null then 'invalid_score' else 'low_score' end
    from src where {n('score')} = '' or {number('score')} is null or {number('score')} < 50"""

_NAME = "lower(trim(first_name) || ' ' || trim(last_name))"
EQUAL_VIEWS = views(
    "equal_src",
    "equal_tgt",
    exact="select s.row_idx as s, t.row_idx as t from equal_src s join equal_tgt t "
    "on s.student_id = t.student_id where s.student_id <> ''",
    s=f"""select *, {_NAME} as nk, row_number() over (partition by {_NAME} order by row_idx) as k
        from equal_src where row_idx not in (select s from exact)""",
    t=f"""select *, {_NAME} as nk, row_number() over (partition by {_NAME} order by row_idx) as k
        from equal_tgt where row_idx not in (select t from exact)""",
    pairs="""select s, t, true as by_key from exact union all
        select s.row_idx, t.row_idx, false from s join t on s.nk = t.nk and s.k = t.k""",
)

# Every target with a key has one source of its own: the same customer.  Its name differs
# in the first letter for even keys.  Sources in digits are left over; the targets unused
# at their turn are those further down, so the last one of a department sees none of it.
PEOPLE_VIEWS = views(
    "people_src",
    "people_tgt",
    usable="select row_idx, lower(department) as team from people_tgt where student_id <> ''",
    later="""select s.row_idx, count(u.row_idx) > 0 as any_left,
        count(*) filter (u.team = s.department) > 0 as team_left
        from people_src s left join usable u on u.row_idx > s.row_idx
        where s.row_idx % 70 = 0 group by s.row_idx""",
    scored="""select s.*, t.student_id as target_record_key, t.first_name || ' ' || t.last_name
            as target_name, t.department as target_department,
        s.student_id = t.student_id and s.student_id <> '' as by_key,
        case when t.row_idx is null then
            case when team_left then 2 / 36 + 0.06 when any_left then 2 / 36 else 0 end
            when s.student_id = t.student_id then 1
            else least(1.0, case when s.row_idx % 2 = 0 then 34 / 36 else 1 end
                + case when s.department = lower(t.department) then 0.06 else 0 end) end as score
        from people_src s left join people_tgt t on s.row_idx = t.row_idx and t.student_id <> ''
        left join later on later.row_idx = s.row_idx""",
    decided="""select row_idx, student_id as source_record_key,
        trim(first_name) || ' ' || trim(last_name) as source_name,
        coalesce(department, '') as source_department,
        coalesce(target_record_key, '') as target_record_key,
        coalesce(target_name, '') as target_name,
        coalesce(target_department, '') as target_department,
        case when target_record_key is null then 'no_match' when by_key then 'exact_key'
            else 'fuzzy_name' end as match_type,
        printf('%.3f', score) as match_score,
        case when by_key then 'Key match' when target_record_key is not null
            then 'Name similarity match'
            else case when student_id = '' then 'Best candidate'
                else 'Source key ' || chr(39) || student_id || chr(39)
                    || ' not present in target and best candidate'
                end || printf(' score %.3f below threshold 0.86', score) end as reason
        from scored""",
)

_STEP_INT = "case when regexp_full_match({0}, '{1}[0-9]+') then cast({0} as bigint) end as {0}"
STEPS = f"""select trim(step) as step, {_STEP_INT.format('attempt', '')},
    {_STEP_INT.format('max_attempts', '')}, status, {_STEP_INT.format('exit_code', '-?')},
    start_utc, end_utc, {_STEP_INT.format('duration_seconds', '')} from steps"""

RUN_TOTALS = """(select count(*) filter (relative_path like 'reports/%') as report_files,
        count(*) filter (relative_path like 'logs/%') as output_files,
        count(*) filter (relative_path like 'reports/%' or relative_path like 'logs/%')
            as total_files from artifacts),
    (select count(*) as steps_total, count(*) filter (status = 'failed') as steps_failed,
        count(*) filter (attempt > 1) as steps_retried from typed)"""

ORACLES: dict[str, str] = {
    "integrity_scorecard": TYPED_VIEWS
    + f""", per_row as (select *, count(*) over (partition by student_id) as copies,
            row_number() over (partition by student_id) as copy from typed),
        totals as (select
            count(*) filter (coalesce(score not between 0 and 100, true)) as bad_score,
            count(*) filter (copies > 1 and copy = 1) as repeated,
            count(*) filter (least(length(trim(coalesce(student_id, ''))),
                length(trim(coalesce(email, ''))), length(trim(coalesce(department, '')))) = 0)
                as incomplete,
            count(*) filter (coalesce(lower(trim(status)) not in {STATUSES}, true)) as bad_status,
            count(*) filter (coalesce(completed_at > due_date, false)) as late from per_row)
        select unnest(['missing_or_invalid_score', 'duplicate_student_id',
                'missing_required_fields', 'invalid_status_values', 'completed_after_due_date'])
                as check_name,
            unnest([bad_score, repeated, incomplete, bad_status, late]) as issue_count
        from totals""",
    "duplicate_groups": """select l_orderkey, l_linenumber, count(*) as duplicate_count
        from lineitem group by l_orderkey, l_linenumber having count(*) > 1""",
    "duplicate_groups_records": views("src")
    + """select student_id, email, count(*) as duplicate_count
        from src group by student_id, email having count(*) > 1""",
    "duplicate_documents": """select text, count(*) as duplicate_count
        from documents group by text having count(*) > 1""",
    "duplicate_rows": views("src")
    + """select * exclude (copies) from (select *, count(*) over (partition by student_id)
        as copies from src where student_id is not null) where copies > 1""",
    "duplicate_lineitems": """select lineitem.* from lineitem join (select l_orderkey, l_linenumber from lineitem
        group by l_orderkey, l_linenumber having count(*) > 1) using (l_orderkey, l_linenumber)""",
    "dedupe_first": views("src") + first_wins("src", [n("student_id")]),
    "dedupe_first_composite": views("src") + first_wins("src", [n("department"), n("score")]),
    "index_by_key": views("src", kept=first_wins("src", [n("student_id")], f"{n('student_id')} <> ''"))
    + f"select {n('student_id')} as record_key, kept.* from kept",
    "index_counts": views("src") + "select * from " + COUNTS.format("", "src"),
    "clean_records": CLEAN_VIEWS
    + first_wins("cleaned", ["student_id"]).replace(
        "* exclude (rn)",
        "* exclude (rn, email), email as e_mail",
    ),
    "clean_without_dedupe": CLEAN_VIEWS + "select * from cleaned",
    "etl_records": CLEAN_VIEWS + first_wins("cleaned", ["student_id"]),
    "etl_summary": CLEAN_VIEWS
    + """select true as dry_run, count(*) as input_rows,
        count(distinct student_id) as output_rows,
        cast(count(*) - count(distinct student_id) as bigint) as duplicate_rows_removed,
        '' as missing_required_columns,
        count(*) filter (student_id = '' or email = '' or department = '' or status = '')
            as rows_missing_required_values,
        'student_id|email|department|status' as required_columns from cleaned""",
    "profile_records": profile("src", SRC_COLUMNS, views("src")),
    "profile_customer": profile(
        "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    ),
    "profile_lineitem": profile(
        "lineitem",
        [
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        ],
    ),
    "profile_documents": profile("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "table_size": """select count(*) as row_count,
        (select count(*) from (describe lineitem)) as column_count from lineitem""",
    "rule_required": RULE_VIEWS + required("rule_1", "email"),
    "rule_allowed_values": RULE_VIEWS
    + allowed("status_exact", "('open', 'closed', 'in_progress')", exact=True),
    "rule_range": RULE_VIEWS + in_range("rule_1", "0", "99.5"),
    "rule_regex": RULE_VIEWS + regex("rule_1", "student_id", "stu[0-9]+"),
    "rule_equals_column": RULE_VIEWS + equal("rule_1", "due_date", "completed_at"),
    "rule_when_equals": RULE_VIEWS
    + required("rule_1", "completed_at", f"lower({n('status')}) = 'open'"),
    "rule_when_not_equals": RULE_VIEWS + required("rule_1", "score", f"{n('status')} <> 'Closed'"),
    "rule_when_in": RULE_VIEWS
    + in_range("rule_1", None, "50", f"lower({n('department')}) in ('dept 1', 'dept 2')"),
    "validate_violations": RULE_VIEWS + VIOLATIONS,
    "rule_values_of_a_table": views("src", "tgt")
    + rule(
        "known_key", "allowed_values", "student_id",
        f"{n('student_id')} <> '' and lower({n('student_id')}) not in "
        f"(select lower({n('student_id')}) from tgt where {n('student_id')} is not null)",
        f"'value ''' || {n('student_id')} || ''' is not in allowed set'",
    ),
    "violations_by_rule": RULE_VIEWS
    + f"select rule_name, count(*) as violation_count from ({VIOLATIONS}) group by rule_name",
    "validation_summary": RULE_VIEWS
    + f"""select (select count(*) from src) as rows_scanned, cast(9 as bigint) as rule_count,
        'student_id' as key_column, 'student_id|email|due_date' as required_columns,
        '' as missing_columns, count(*) as violation_count, {BY_RULE} as violations_by_rule
        from ({VIOLATIONS} union all {required('team_named', 'email')})""",
    "validate_missing_columns": RULE_VIEWS
    + """select count(*) as rows_scanned, cast(1 as bigint) as rule_count,
        'student_id' as key_column, 'campus' as required_columns,
        'advisor|campus' as missing_columns, cast(0 as bigint) as violation_count,
        '' as violations_by_rule from src""",
    "flag_first_issue": TYPED_VIEWS + FLAGGED,
    "dq_status_counts": TYPED_VIEWS
    + f"select dq_issue, dq_status, count(*) as record_count from ({FLAGGED}) group by all",
    "sanitize_rows": views("lenient_src")
    + f"""select * from lenient_src where {n('student_id')} <> '' and strpos({n('email')}, '@') > 1
        and (case when {n('score')} = '' then 0 when {n('score')} = '0x10' then 16
            when {n('score')} = '0xfff' then 4095 when {n('score')} = '7.' then 7
            when {n('score')} = '1_0' then null else {number('score')} end) between 0 and 100
        and lower({n('status')}) in {STATUSES}""",
    "check_constraints": views("src")
    + " union all ".join(
        [
            constraint("email", "contains", f"strpos({n('email')}, '@') = 0", "value must contain ''@''"),
            constraint(
                "score", "between", f"coalesce({number('score')} not between 0 and 100, true)",
                "value must be between 0 and 100",
            ),
            constraint(
                "status", "in", f"{n('status')} not in {STATUSES}",
                "value must be one of open, closed, in_progress, completed",
            ),
        ]
    ),
    "validate_tables": views("src", "tasks")
    + f"""select 'missing_sheet' as type, 'Grades' as sheet, 'Sheet not found' as detail
        union all select 'missing_sheet', 'Grades', 'Required for column validation'
        union all select 'missing_column', 'Records', 'campus'
        union all select 'invalid_value', 'Records',
            'status row ' || cast(row_idx as varchar) || ': ' || {n('status')} from src
            where {n('status')} not in ('', 'open', 'Closed', 'in_progress')
        union all select 'invalid_value', 'Tasks',
            'priority row ' || cast(row_idx as varchar) || ': ' || {n('priority')} from tasks
            where {n('priority')} not in ('', '1-urgent', '2-high', '3-medium')""",
    "reconcile": RECONCILE_VIEWS + "select * from result",
    "reconcile_counts": RECONCILE_VIEWS
    + "select status, count(*) as record_count from result group by status",
    "reconcile_mismatches": RECONCILE_VIEWS
    + "select mismatch_columns, count(*) as record_count from result group by mismatch_columns",
    "reconcile_summary": RECONCILE_VIEWS
    + "select * from "
    + COUNTS.format("source_", "src")
    + ", "
    + COUNTS.format("target_", "tgt")
    + """, (select count(*) filter (status = 'match') as match,
        count(*) filter (status = 'mismatch') as mismatch,
        count(*) filter (status = 'source_only') as source_only,
        count(*) filter (status = 'target_only') as target_only from result)""",
    "reconcile_sql": RECONCILE_SQL,
    "survivorship_merged": MERGE_VIEWS + survivors("target"),
    "survivorship_merged_source_first": MERGE_VIEWS + survivors("source"),
    "survivorship_conflicts": MERGE_VIEWS + CONFLICTS,
    "survivorship_summary": MERGE_VIEWS
    + "select * from "
    + COUNTS.format("source_", "src")
    + ", "
    + COUNTS.format("target_", "tgt")
    + f""", (select count(*) as merged_records,
        count(*) filter (s.student_id is not null and t.student_id is not null) as both_sources,
        count(*) filter (t.student_id is null) as source_only,
        count(*) filter (s.student_id is null) as target_only from s full outer join t {_ON}),
        (select count(*) as field_conflicts from ({CONFLICTS}))""",
    "fuzzy_equal_names": EQUAL_VIEWS
    + """select s.row_idx, s.student_id as source_record_key,
        trim(s.first_name || ' ' || s.last_name) as source_name, '' as source_department,
        coalesce(t.student_id, '') as target_record_key,
        coalesce(t.first_name || ' ' || t.last_name, '') as target_name, '' as target_department,
        case when t is null then 'no_match' when by_key then 'exact_key' else 'fuzzy_name' end
            as match_type,
        case when t is null then '0.000' else '1.000' end as match_score,
        case when t is null then 'No usable source name fields for fuzzy match'
            when by_key then 'Key match' else 'Name similarity match' end as reason
        from equal_src s left join pairs p on p.s = s.row_idx
        left join equal_tgt t on t.row_idx = p.t""",
    "fuzzy_unmatched_targets": EQUAL_VIEWS
    + """select student_id as target_record_key, first_name || ' ' || last_name as target_name,
        '' as target_department from equal_tgt where row_idx not in (select t from pairs)""",
    "fuzzy_match": PEOPLE_VIEWS + "select * from decided",
    "fuzzy_counts": PEOPLE_VIEWS
    + """select count(*) as source_records, (select count(*) from people_tgt) as target_records,
        cast(0.86 as double) as threshold,
        count(*) filter (match_type = 'exact_key') as exact_key,
        count(*) filter (match_type = 'fuzzy_name') as fuzzy_name,
        count(*) filter (match_type = 'no_match') as no_match,
        cast(0 as bigint) as target_unmatched_records,
        cast(0 as bigint) as target_duplicates_ignored,
        (select count(*) from people_tgt where student_id = '') as target_missing_key_rows,
        'first_name|last_name' as name_columns, 'department' as department_column
        from decided""",
    "name_keys": views("people_src")
    + """select row_idx, trim(first_name) || ' ' || trim(last_name) as name,
        lower(trim(first_name) || ' ' || trim(last_name)) as name_key from people_src""",
    "sla_states": SLA_VIEWS + "select * from states",
    "sla_at_risk": SLA_VIEWS
    + "select * from states where risk_state in ('at_risk', 'overdue')",
    "sla_state_counts": SLA_VIEWS
    + "select risk_state, count(*) as record_count from states group by risk_state",
    "sla_summary": SLA_VIEWS
    + f"""select '{AS_OF}' as as_of, cast({SLA_DAYS} as bigint) as threshold_days,
        count(*) as total_rows,
        count(*) filter (risk_state in ('at_risk', 'overdue')) as at_risk_rows,
        count(*) filter (risk_state = 'no_due_date') as no_due_date,
        count(*) filter (risk_state = 'late_completed') as late_completed,
        count(*) filter (risk_state = 'completed_on_time') as completed_on_time,
        count(*) filter (risk_state = 'not_active') as not_active,
        count(*) filter (risk_state = 'overdue') as overdue,
        count(*) filter (risk_state = 'at_risk') as at_risk,
        count(*) filter (risk_state = 'on_track') as on_track from states""",
    "audit_anomalies": views("src") + ANOMALIES,
    "audit_summary": views("src")
    + f"""select (select count(*) from src) as rows, count(*) as anomaly_rows,
        'student_id' as key_column, 'score' as score_column,
        cast(50 as double) as low_score_threshold from ({ANOMALIES})""",
    "step_log": views("steps") + STEPS,
    "run_counts": views("steps", "artifacts", typed=STEPS) + "select * from " + RUN_TOTALS,
    "run_manifest": views("steps", "artifacts", typed=STEPS)
    + """select 'run-1' as run_id, 'success' as status,
        '2024-02-01T00:00:00+00:00' as generated_utc, 'logs/run-1.log' as log_file, totals.*,
        true as exists, cast(12 as bigint) as log_size_bytes from (select * from """
    + RUN_TOTALS
    + ") totals",
    "run_manifest_steps": views("steps") + STEPS,
    "run_manifest_files": views("artifacts")
    + """select *, case when relative_path like 'reports/%' then 'reports' else 'outputs' end
        as section from artifacts
        where relative_path like 'reports/%' or relative_path like 'logs/%'""",
    "history_upsert": views(
        "runs",
        entry="select * from runs where run_id <> '' order by ordinal desc limit 1",
        merged="""select * from runs where run_id not in (select run_id from entry)
            union all select * replace ('rerun' as status, 9223372036854775807 as ordinal)
            from entry""",
    )
    + "select * exclude (ordinal) from merged order by generated_utc desc, ordinal limit 500",
    "expired_artifacts": views("artifacts")
    + """select pattern, relative_path, size_bytes, modified_utc from (
        select *, row_number() over (partition by pattern
            order by modified_utc desc, relative_path) as rn from (
            select *, case when relative_path like 'logs/daily-run-%' then 'logs'
                when relative_path like 'reports/run_manifest-%' then 'manifests' end as pattern
            from artifacts) where pattern is not null) where rn > 15""",
    "read_history_json": """select cast(0 as integer) as ordinal, 'r' || cast(event_id as varchar) as run_id,
        event_type as status, '' as generated_utc, '' as manifest_file, '' as log_file,
        '' as steps_file, cast(json_extract_string(props, '$.k') as bigint) as report_files,
        cast(0 as bigint) as output_files, cast(0 as bigint) as steps_total,
        cast(0 as bigint) as steps_failed, cast(0 as bigint) as steps_retried from events""",
    "read_manifest_json": """select 'r' || cast(event_id as varchar) as run_id, '' as status,
        '' as generated_utc, '' as manifest_file, event_type || '.log' as log_file,
        '' as steps_file, cast(0 as bigint) as report_files, cast(0 as bigint) as output_files,
        cast(json_extract_string(props, '$.k') as bigint) as steps_total,
        cast(0 as bigint) as steps_failed, cast(0 as bigint) as steps_retried from events""",
    "csv_records": """select cast(doc_id as varchar) as doc_id, coalesce(lang, '') as lang,
        coalesce(source, '') as source, coalesce(cast(n_chars as varchar), '') as n_chars,
        coalesce(text, '') as text from documents""",
    "record_ordinals": """select count(*) as records, cast(2 as bigint) as first,
        cast(count(*) + 1 as bigint) as last, count(*) as ordinals from lineitem""",
    "typed_records": TYPED_VIEWS + "select * from typed",
}
