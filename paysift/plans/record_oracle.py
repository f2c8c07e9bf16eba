"""DuckDB SQL for ``plans.record_queries``, from the pieces of ``plans.oracle``."""

from __future__ import annotations

from paysift.operators.forms import FORM_B, FORM_C, FORMS
from paysift.plans.oracle import (
    _UNIFIED,
    ORACLE_SQL,
    RAW,
    _base,
    _clean_sql,
    _counts,
    _good_pred,
    _prepared_select,
    _reason_rows,
    _reasons,
    _rejected_sql,
    _with,
    location_a,
)
from paysift.sources.derived import DAMAGED_LINES_SQL, LINE_COLUMNS


def _record(form: str) -> str:
    parts = [f"'{n}=' || coalesce({n}, '?')" for n in sorted(FORMS[form].names)]
    return " || '|' || ".join(parts)


def _quarantine() -> str:
    rows = [f"select '{f}' as form, row_id, {_reasons(f)} as reasons, {_record(f)} as record from p{f.lower()} where not ({_good_pred(f)})" for f in "ABC"]
    return _base("ABC") + " union all ".join(rows)


def _corrections() -> str:
    names = ", ".join(n for n in FORM_B.names if n != "Base_Salary_2018")
    fixed = f"select row_id, {names}, regexp_replace(Base_Salary_2018, '[A-Za-z]', '', 'g') as Base_Salary_2018 from pb where not ({_good_pred('B')}) and row_id % 2 = 0"
    return _with(
        ("raw", RAW), ("pb", _prepared_select("B")), ("fixed", fixed), ("good", _clean_sql("B")), ("again", _clean_sql("B", source="fixed")),
        ("rows", f"select row_id, 0 as version, {_UNIFIED['B']} from good union all select row_id, 1 as version, {_UNIFIED['B']} from again"),
    ) + "select 'B' as form, * from rows"


def _damaged() -> str:
    """Form C as read from the lines: nulls for blanks, short rows padded, torn rows with the torn text as their first answer."""
    kind = "case row_id % 23 when 0 then 'long_row' when 1 then 'short_row' when 2 then 'torn_row' end"
    columns = []
    for i, name in enumerate(LINE_COLUMNS):
        cell = f"nullif({LINE_COLUMNS[name]}, '')"
        if i == 0:
            cell = f"case when damage = 'torn_row' then torn else {cell} end"
        else:
            cell = f"case when damage = 'torn_row'{' or damage = ' + chr(39) + 'short_row' + chr(39) if i >= len(LINE_COLUMNS) - 2 else ''} then null else {cell} end"
        default = {s.name: s.default for s in FORM_C.sources}[name]
        columns.append(f"coalesce(trim({cell}), '{default}') as {name}")
    lines = DAMAGED_LINES_SQL.format(base="raw")
    extra = [(k, f"damage = '{k}'") for k in ("torn_row", "long_row", "short_row")]
    return _with(
        ("raw", RAW),
        ("lines", lines),
        ("kinds", f"select *, {kind} as damage, 'torn,' || cast(row_id as varchar) as torn from raw"),
        ("pc", f"select row_id, coalesce(damage, '') as damage, {', '.join(columns)} from kinds"),
    ) + (
        f"select pc.row_id, lot, {_reasons('C', extra)} as reasons, case when damage <> '' then value end as damaged_text "
        f"from pc join lines on lines.place = pc.row_id where not ({_good_pred('C')}) or damage <> ''"
    )


def _duplicates() -> str:
    names = ", ".join(FORM_B.names)
    return _with(
        ("raw", RAW),
        ("one", _prepared_select("B")),
        ("twice", f"select row_id, {names} from one union all select row_id + 1000000000, {names} from one where row_id % 7 = 0"),
        ("pb", f"select *, min(row_id) over (partition by {names}) as first_id from twice"),
    ) + f"select row_id, {_reasons('B', [('duplicate_submission', 'row_id > first_id')])} as reasons from pb where not ({_good_pred('B')}) or row_id > first_id"


def _contradictions() -> str:
    sex = "case when upper(Gender) in ('MALE', 'FEMALE') then upper(Gender) end"
    facts = f"select Created_At || '|' || Job_Title as k, min({sex}) as lo, max({sex}) as hi from pc group by all having min({sex}) = max({sex})"
    test = f"coalesce({sex} <> lo, false)"
    return _base("BC") + (
        f", facts as ({facts}) select row_id, {_reasons('B', [('contradicts_form_c', test)])} as reasons "
        f"from pb left join facts on Created_At || '|' || Job_Title = k where not ({_good_pred('B')}) or {test}"
    )


def _inexact(values: str, entries: str, distance: int, columns: str, on: str, out: str) -> str:
    """``values`` as ``rows``, ``entries`` as ``d(k, v)``: every pair measured."""
    return (
        f"rows as ({values}), d as ({entries}), "
        f"near as (select x, k, v, levenshtein(x, k) as dist from (select distinct {on} as x from rows) join d on levenshtein(x, k) <= {distance}), "
        f"best as (select x, v from near qualify row_number() over (partition by x order by dist, k) = 1) "
        f"select {columns}, coalesce(v, {on}) as {out} from rows left join best on {on} = x"
    )


def build() -> dict[str, str]:
    q = {
        "quarantine_long": _quarantine(),
        "quarantine_restored": _base("C") + _rejected_sql("C"),
        "corrections_merged": _corrections(),
        "csv_damaged_rows": _damaged(),
        "duplicate_submissions": _duplicates(),
        "contradicting_answers": _contradictions(),
    }
    q["location_inexact"] = _base("A") + ", " + _inexact(
        f"select row_id, {location_a('Location')} as Location from pa",
        "select lower(replace(n_name, ' ', '')) || '_uk' as k, min(n_name || '/UK') as v from nation group by 1", 1, "row_id", "Location", "Location",
    )
    q["customer_inexact"] = "with " + _inexact(
        "select s_suppkey, 'Custmer#' || lpad(cast(s_suppkey * 7 as varchar), 8, '0') as name from supplier",
        "select c_name as k, min(cast(c_custkey as varchar)) as v from customer group by 1", 2, "s_suppkey, name", "name", "customer",
    )
    q["priority_as_of"] = (
        "with d as (select o_custkey k, o_orderdate since, min(o_orderpriority) v from orders where o_orderkey % 3 = 0 group by all) "
        "select o_orderkey, o_custkey, o_orderdate, v as priority from orders asof left join d on o_custkey = k and o_orderdate >= since"
    )
    q["location_as_of"] = _base("B") + (
        f", good as ({_clean_sql('B')}), "
        "d as (select distinct lower(c_mktsegment) || '_' || lower(replace(n_name, ' ', '')) k, make_timestamp(year(o_orderdate), 7, 1, 0, 0, 0) since, "
        "n_name || '@' || year(o_orderdate) v from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey), "
        "one as (select k, since, min(v) v from d group by all) "
        "select row_id, Created_At, Location, v as Name from good asof left join one on Location = k and Created_At >= since"
    )
    for name in ("role", "location", "cash", "happy", "hours"):
        q[f"live_report_{name}"] = ORACLE_SQL[f"report_{name}"]
    for f in "abc":
        q[f"form_{f}_sql"] = ORACLE_SQL[f"form_{f}_clean"]
    strict = "select * replace (regexp_replace(Created_At, '/97 ', '/1997 ') as Created_At, '$' || cast(row_id as varchar) as Annual_Salary) from one"
    q["strict_cast_raise"] = _with(("raw", RAW), ("one", _prepared_select("A")), ("pa", strict)) + _clean_sql("A")

    q["batch_observed"] = _base("ABC", null_blank=True) + _counts(" union all ".join(_reason_rows(f, False) for f in "ABC"))
    q["batch_audit"] = _base("C", null_blank=True) + f"select * exclude (row_id) from ({_rejected_sql('C')})"
    uni, batch = ORACLE_SQL["unify_forms"].rsplit("select * from unified", 1)[0], ORACLE_SQL["batch_unified"].rsplit("select * exclude", 1)[0]
    for name in ("role", "cash", "hours"):
        q[f"batch_report_{name}"] = ORACLE_SQL[f"report_{name}"].replace(uni, batch)
    q["batch_csv_report"] = ORACLE_SQL["batch_report_location"]
    q["published_report"] = ORACLE_SQL["report_location"]
    return q


RECORD_SQL = build()
