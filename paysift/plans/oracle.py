"""DuckDB SQL for every registered query (the correctness oracle).

Written in DuckDB's own dialect, independently of the Spark code: ``||`` for
NULL-propagating concatenation, ``split_part`` / 1-based ``str_split`` for
Spark's ``substring_index`` / 0-based ``split``, ``regexp_matches`` for
``rlike``, and exact integer arithmetic for Spark's decimal averages (DuckDB's
``avg(decimal)`` is DOUBLE). The derived survey text is the one shared SQL
text of ``paysift.sources.derived``.
"""

from __future__ import annotations

from paysift.operators.forms import FORMS
from paysift.operators.reports import ROLE_KEYWORDS
from paysift.sources.derived import BASE_SQL, FORM_COLUMNS, RAW_SURVEY_SQL

RAW = RAW_SURVEY_SQL.format(base="(" + BASE_SQL.format(orders="orders", customer="customer", nation="nation") + ")")


def _lit(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _prepared_select(form: str, source: str = "raw", null_blank: bool = False, flag: bool = False) -> str:
    """Trim + NULL default per column (optionally '' read back as NULL first;
    with ``flag``, ``Salary_Defaulted`` marks a missing salary answer)."""
    defaults = {s.name: s.default for s in FORMS[form].sources}
    cols = [f"({FORM_COLUMNS[form][FORMS[form].salary]} is null) as Salary_Defaulted"] if flag else []
    for dst, src in FORM_COLUMNS[form].items():
        x = f"nullif({src}, '')" if null_blank else src
        cols.append(f"coalesce(trim({x}), {_lit(defaults[dst])}) as {dst}")
    return f"select row_id, {', '.join(cols)} from {source}"


def _with(*ctes: tuple[str, str]) -> str:
    return "with " + ",\n".join(f"{name} as ({body})" for name, body in ctes) + "\n"


def _base(forms: str = "ABC", null_blank: bool = False) -> str:
    return _with(("raw", RAW), *[(f"p{f.lower()}", _prepared_select(f, null_blank=null_blank)) for f in forms])


# ---- scalar pieces -----------------------------------------------------------------------

TS_RE = "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{1,2}:[0-9]{2}:[0-9]{2}"
INT_RE = "^\\s*([+-]?[0-9]+)(\\.[0-9]*)?\\s*$"


def ts(x: str) -> str:
    return f"case when regexp_full_match({x}, '{TS_RE}') then try_strptime({x}, '%m/%d/%Y %H:%M:%S') end"


def _no_underscore(x: str, cast: str) -> str:
    # DuckDB reads '1_0' as 10; Spark's number parsing never accepts '_'.
    return f"(case when contains({x}, '_') then null else try_cast({x} as {cast}) end)"


def money(x: str) -> str:
    return _no_underscore(x, "decimal(38,2)")


def flt(x: str) -> str:
    return _no_underscore(x, "float")


def int_trunc(x: str) -> str:
    whole = f"try_cast(regexp_extract({x}, '{INT_RE}', 1) as integer)"
    return f"(case when regexp_matches({x}, '^\\s*[+-]?\\.[0-9]*\\s*$') then 0 else {whole} end)"


def part(x: str, i: int) -> str:
    """0-based element ``i`` of ``x`` split on '-', NULL past the end."""
    return f"str_split({x}, '-')[{i + 1}]"


def hi_or_lo(x: str) -> str:
    return f"coalesce({part(x, 1)}, {part(x, 0)})"


def money_a(x: str) -> str:
    return f"regexp_replace(split_part({x}, '(', 1), '[$£~, ]', '', 'g')"


def money_c_base(x: str) -> str:
    return f"regexp_replace({x}, '[$€£, ]', '', 'g')"


def money_c_signing(x: str) -> str:
    return f"translate({x}, '$,', '')"


def money_c_annual(x: str) -> str:
    return f"translate({x}, '£$,', '')"


def exp_a(x: str) -> str:
    return f"split_part(replace({x}, ' - ', '-'), ' y', 1)"


def plus_range(x: str) -> str:
    return f"translate({x}, ' +', '')"


def location_a(x: str) -> str:
    return f"split_part(lower(translate({x}, '/, ', '_')), '(', 1)"


def location_b(city: str, country: str) -> str:
    merged = (
        f"case when {city} = '' and {country} = '' then '' when {city} = '' then lower({country}) "
        f"else lower({city} || '_' || {country}) end"
    )
    return f"split_part(translate({merged}, ' ,', ''), '(', 1)"


def location_c(x: str) -> str:
    low = f"lower(translate({x}, ',; ', '__'))"
    return f"case when regexp_matches({low}, '[^0-9]') then {low} else '' end"


def industry_b(x: str) -> str:
    return f"replace(replace(upper({x}), ' - ', '-'), '/', '-')"


def gender_c(x: str) -> str:
    g = f"upper(trim({x}))"
    return f"case when {g} in ('MALE', 'FEMALE') then {g} else 'OTHER' end"


def exp_c(x: str) -> str:
    # step by step: drop < and +, join numbers around a dash (twice: matches don't overlap),
    # keep the first word, drop dashes at its ends, keep what follows the last dash
    joined = f"trim(translate({x}, '<+', ''))"
    for _ in range(2):
        joined = f"regexp_replace({joined}, '([0-9.]) *- *([0-9.])', '\\1-\\2', 'g')"
    return f"split_part(trim(split_part({joined}, ' ', 1), '-'), '-', -1)"


def letter(x: str) -> str:
    return f"regexp_matches({x}, '[A-Za-z]')"


def avg2(x: str) -> str:
    """Spark's round(avg(decimal(38,2)), 2) as DOUBLE: the mean rounded HALF_UP
    to 6 places, then HALF_UP to 2, in exact integers."""
    s = f"sum(cast({x} * 100 as hugeint))"
    n = f"count({x})"
    micro = f"((2 * abs({s}) * 10000 + {n}) // (2 * {n}))"
    cents = f"(({micro} + 5000) // 10000)"
    return f"(case when {n} = 0 then null else cast((case when {s} < 0 then -1 else 1 end) * {cents} as double) / 100 end)"


# ---- per-form clean and reject SQL ------------------------------------------------------

RULES = {
    "A": [("salary_alpha", letter("Annual_Salary"))],
    "B": [("salary_alpha", letter("Base_Salary_2018")), ("bonus_alpha", letter("Bonus_2018"))],
    "C": [
        ("salary_alpha", letter("Annual_Base_Salary")),
        ("signing_alpha", letter("Signing_Bonus")),
        ("annual_bonus_format", "regexp_matches(Annual_Bonus, '[A-Za-z%-]')"),
    ],
}

# Typed fields per form: (name, kind, cleaned text over the prepared columns).
FIELDS = {
    "A": [
        ("Created_At", "timestamp", "Created_At"),
        ("Industry", "string", "upper(Industry)"),
        ("Job_Title", "string", "upper(Job_Title)"),
        ("Annual_Salary", "money", money_a("Annual_Salary")),
        ("Location", "string", location_a("Location")),
        ("Min_Age", "int", part("Age_Range", 0)),
        ("Max_Age", "int", part("Age_Range", 1)),
        ("Min_Exp", "float", part(exp_a("Work_Experience"), 0)),
        ("Max_Exp", "float", hi_or_lo(exp_a("Work_Experience"))),
    ],
    "B": [
        ("Created_At", "timestamp", "Created_At"),
        ("Company_Name", "string", "upper(Company_Name)"),
        ("Location", "string", location_b("City", "Country")),
        ("Industry", "string", industry_b("Industry")),
        ("Job_Title", "string", "upper(Job_Title)"),
        ("Base_Salary_2018", "money", "Base_Salary_2018"),
        ("Bonus_2018", "money", "Bonus_2018"),
        ("Annual_Vacation_In_Weeks", "int", "replace(Annual_Vacation_In_Weeks, '+', '')"),
        ("Happy_With_Job", "string", "upper(Happy_With_Job)"),
        ("Want_To_Resign", "string", "upper(Want_To_Resign)"),
        ("Gender", "string", "upper(Gender)"),
        ("Min_Exp", "float", part(plus_range("Work_Exp"), 0)),
        ("Max_Exp", "float", hi_or_lo(plus_range("Work_Exp"))),
        ("Min_Hours_Per_Week", "int", part(plus_range("Hours_Per_Week"), 0)),
        ("Max_Hours_Per_Week", "int", hi_or_lo(plus_range("Hours_Per_Week"))),
        ("Min_Actual_Hours_Per_Week", "int", part(plus_range("Actual_Hours_Per_Week"), 0)),
        ("Max_Actual_Hours_Per_Week", "int", hi_or_lo(plus_range("Actual_Hours_Per_Week"))),
    ],
    "C": [
        ("Created_At", "timestamp", "Created_At"),
        ("Company_Name", "string", "upper(Company_Name)"),
        ("Location", "string", location_c("Location")),
        ("Job_Title", "string", "upper(Job_Title)"),
        ("Work_Exp", "float", exp_c("Work_Exp")),
        ("Annual_Base_Salary", "money", money_c_base("Annual_Base_Salary")),
        ("Signing_Bonus", "money", money_c_signing("Signing_Bonus")),
        ("Annual_Bonus", "money", money_c_annual("Annual_Bonus")),
        ("Gender", "string", gender_c("Gender")),
    ],
}

_CAST = {"timestamp": ts, "money": money, "int": int_trunc, "float": flt, "string": lambda x: x}


def _typed(form: str) -> str:
    return ", ".join(f"{_CAST[k](t)} as {n}" for n, k, t in FIELDS[form])


def _good_pred(form: str) -> str:
    return " and ".join(f"not {p}" for _, p in RULES[form])


def _reasons(form: str, extra: list[tuple[str, str]] = ()) -> str:
    parts = [f"case when {p} then '{n}' end" for n, p in [*RULES[form], *extra]]
    return f"concat_ws(',', {', '.join(parts)})"


def _clean_sql(form: str, source: str | None = None, extra: str = "") -> str:
    src = source or f"p{form.lower()}"
    return f"select row_id, {extra}{_typed(form)} from {src} where {_good_pred(form)}"


def _rejected_sql(form: str) -> str:
    names = ", ".join(FORMS[form].names)
    return (
        f"select row_id, {names}, {_reasons(form)} as reasons from p{form.lower()} "
        f"where not ({_good_pred(form)})"
    )


def _reason_rows(form: str, first_only: bool, extra: list[tuple[str, str]] = (), casts: bool = False) -> str:
    """One row per (rejected row, reason); with ``first_only`` the first reason."""
    tests = [*RULES[form], *extra]
    if casts:
        # only where no rule rejects the row; an open age band is no defect
        passes = " and ".join(f"not ({p})" for _, p in RULES[form]) or "true"
        for n, k, t in FIELDS[form]:
            if k != "string" and n not in ("Min_Age", "Max_Age"):
                tests.append((f"cast_{n}", f"({passes}) and ({t}) is not null and {_CAST[k](t)} is null"))
    src = f"p{form.lower()}"
    if first_only:
        case = " ".join(f"when {p} then '{n}'" for n, p in tests)
        return f"select '{form}' as form, case {case} end as reason from {src} where " + " or ".join(
            f"({p})" for _, p in tests
        )
    return " union all ".join(f"select '{form}' as form, '{n}' as reason from {src} where {p}" for n, p in tests)


def _counts(rows: str) -> str:
    return f"select form, reason, count(*) as n from ({rows}) group by form, reason"


# ---- unified table -----------------------------------------------------------------------

# The unified table's columns and the constants of columns that a form lacks.
_UNIFIED = {
    "A": (
        "Created_At, '' as Company_Name, Location, Industry, Job_Title, Annual_Salary as Salary, "
        "cast(0 as decimal(38,2)) as Bonus, cast(0 as integer) as Annual_Vacation_In_Weeks, "
        "'' as Happy_With_Job, '' as Want_To_Resign, 'OTHER' as Gender, Min_Exp, Max_Exp, "
        "cast(0 as float) as Min_Hours_Per_Week, cast(0 as float) as Max_Hours_Per_Week, "
        "cast(0 as float) as Min_Actual_Hours_Per_Week, cast(0 as float) as Max_Actual_Hours_Per_Week"
    ),
    "B": (
        "Created_At, Company_Name, Location, Industry, Job_Title, Base_Salary_2018 as Salary, "
        "Bonus_2018 as Bonus, Annual_Vacation_In_Weeks, Happy_With_Job, Want_To_Resign, Gender, Min_Exp, "
        "Max_Exp, cast(Min_Hours_Per_Week as float) as Min_Hours_Per_Week, "
        "cast(Max_Hours_Per_Week as float) as Max_Hours_Per_Week, "
        "cast(Min_Actual_Hours_Per_Week as float) as Min_Actual_Hours_Per_Week, "
        "cast(Max_Actual_Hours_Per_Week as float) as Max_Actual_Hours_Per_Week"
    ),
    "C": (
        "Created_At, Company_Name, Location, '' as Industry, Job_Title, Annual_Base_Salary as Salary, "
        "Annual_Bonus as Bonus, cast(0 as integer) as Annual_Vacation_In_Weeks, '' as Happy_With_Job, "
        "'' as Want_To_Resign, Gender, cast(0 as float) as Min_Exp, Work_Exp as Max_Exp, "
        "cast(0 as float) as Min_Hours_Per_Week, cast(0 as float) as Max_Hours_Per_Week, "
        "cast(0 as float) as Min_Actual_Hours_Per_Week, cast(0 as float) as Max_Actual_Hours_Per_Week"
    ),
}


def _unified_base(flag: bool = False, null_blank: bool = False) -> str:
    extra = "Salary_Defaulted, " if flag else ""
    return _with(
        ("raw", RAW),
        *[(f"p{f.lower()}", _prepared_select(f, flag=flag, null_blank=null_blank)) for f in "ABC"],
        *[(f"g{f.lower()}", _clean_sql(f, extra=extra)) for f in "ABC"],
        ("unified", " union all ".join(f"select row_id, {extra}{_UNIFIED[f]} from g{f.lower()}" for f in "ABC")),
    )


ROLE_KEYWORDS_SQL = " or ".join(f"contains(Job_Title, '{k}')" for k in ROLE_KEYWORDS)


def _w(col: str, form: str, name: str) -> str:
    default = {s.name: s.default for s in FORMS[form].sources}[name]
    return f"coalesce(trim({col}), {_lit(default)})"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    pb = _base("B")
    q["null_defaults"] = _with(("raw", RAW)) + _prepared_select("B")
    q["trim_upper_lower"] = (
        "select p_partkey, trim('  ' || p_name || ' ') as trimmed, upper('  ' || p_name || ' ') as upper_name, "
        "lower(upper(p_name)) as lower_name from part"
    )
    q["money_clean"] = _with(("raw", RAW)) + (
        "select row_id, "
        f"{money(money_a(_w('salary_a', 'A', 'Annual_Salary')))} as Annual_Salary, "
        f"{money(money_c_base(_w('base_c', 'C', 'Annual_Base_Salary')))} as Annual_Base_Salary, "
        f"{money(money_c_signing(_w('signing_c', 'C', 'Signing_Bonus')))} as Signing_Bonus, "
        f"{money(money_c_annual(_w('annual_bonus_c', 'C', 'Annual_Bonus')))} as Annual_Bonus from raw"
    )
    q["timestamp_parse"] = _with(("raw", RAW)) + f"select row_id, created_at as created_text, {ts('created_at')} as Created_At from raw"
    q["range_split_dash"] = (
        f"select o_orderkey, {int_trunc(part('o_orderpriority', 0))} as priority_code, "
        f"{part('o_orderpriority', 1)} as priority_name from orders"
    )
    pa = _base("A")
    q["age_range_split"] = pa + (
        f"select row_id, {int_trunc(part('Age_Range', 0))} as Min_Age, {int_trunc(part('Age_Range', 1))} as Max_Age from pa"
    )
    q["experience_a"] = pa + (
        f"select row_id, {flt(part(exp_a('Work_Experience'), 0))} as Min_Exp, "
        f"{flt(hi_or_lo(exp_a('Work_Experience')))} as Max_Exp from pa"
    )
    q["range_plus"] = pb + (
        f"select row_id, {flt(part(plus_range('Work_Exp'), 0))} as Min_Exp, "
        f"{flt(hi_or_lo(plus_range('Work_Exp')))} as Max_Exp, "
        f"{int_trunc(part(plus_range('Hours_Per_Week'), 0))} as Min_Hours_Per_Week, "
        f"{int_trunc(hi_or_lo(plus_range('Hours_Per_Week')))} as Max_Hours_Per_Week, "
        f"{int_trunc(part(plus_range('Actual_Hours_Per_Week'), 0))} as Min_Actual_Hours_Per_Week, "
        f"{int_trunc(hi_or_lo(plus_range('Actual_Hours_Per_Week')))} as Max_Actual_Hours_Per_Week from pb"
    )
    pc = _base("C")
    q["location_a"] = pa + f"select row_id, {location_a('Location')} as Location from pa"
    q["location_b_merge"] = pb + f"select row_id, {location_b('City', 'Country')} as Location from pb"
    q["location_c"] = pc + f"select row_id, {location_c('Location')} as Location from pc"
    q["industry_dash"] = pb + f"select row_id, {industry_b('Industry')} as Industry from pb"
    q["gender_normalise"] = _with(("raw", RAW)) + (
        f"select row_id, upper({_w('gender_b', 'B', 'Gender')}) as Gender_B, "
        f"{gender_c(_w('gender_c', 'C', 'Gender'))} as Gender_C from raw"
    )
    vacation = int_trunc("replace(Annual_Vacation_In_Weeks, '+', '')")
    q["int_truncating_cast"] = pb + f"select row_id, {vacation} as Annual_Vacation_In_Weeks from pb"
    q["experience_c"] = pc + f"select row_id, {flt(exp_c('Work_Exp'))} as Work_Exp from pc"

    for f in "ABC":
        base = _base(f)
        q[f"form_{f.lower()}_clean"] = base + _clean_sql(f)
        q[f"form_{f.lower()}_rejected"] = base + _rejected_sql(f)

    all3 = _base("ABC")
    q["letter_quarantine_counts"] = all3 + _counts(" union all ".join(_reason_rows(f, False) for f in "ABC"))
    q["cascade_bucket_counts"] = all3 + _counts(" union all ".join(f"({_reason_rows(f, True)})" for f in "ABC"))
    q["bonus_format_route"] = pc + (
        "select row_id, Annual_Bonus, "
        f"case when {_good_pred('C')} then 'good' else 'rejected' end as route, "
        f"case {' '.join(f'when {p} then {_lit(n)}' for n, p in RULES['C'])} end as first_reason from pc"
    )
    q["strict_cast_quarantine"] = all3 + _counts(
        " union all ".join(_reason_rows(f, False, casts=True) for f in "ABC")
    )
    extra_b = [
        ("happy_unknown", "not (upper(Happy_With_Job) in ('YES', 'NO', ''))"),
        ("company_blank", "Company_Name = ''"),
    ]
    q["validation_rules"] = pb + _counts(_reason_rows("B", False, extra=extra_b))

    uni = _unified_base()
    q["unify_forms"] = uni + "select * from unified"
    q["report_role"] = uni + (
        f"select Job_Title, {avg2('Salary')} as Compensation from unified where {ROLE_KEYWORDS_SQL} group by Job_Title"
    )
    q["report_location"] = uni + (
        f"select Location, {avg2('Salary')} as Average_Compensation, min(Salary) as Min_Compensation, "
        "max(Salary) as Max_Compensation from unified group by Location"
    )
    q["report_location_answered"] = _unified_base(flag=True) + (
        f"select Location, {avg2('Salary')} as Average_Compensation, min(Salary) as Min_Compensation, "
        "max(Salary) as Max_Compensation from unified where not Salary_Defaulted group by Location"
    )
    q["report_cash"] = uni + "select Salary as Cash_Compensation, Bonus as Other_Forms_Of_Compensation from unified"
    q["report_happy"] = uni + (
        "select Industry, count(Happy_With_Job) as happy_counts from unified where Happy_With_Job = 'YES' "
        "group by Industry order by happy_counts desc nulls last, Industry asc nulls last limit 5"
    )
    q["report_hours"] = uni + (
        "select Company_Name, max(Max_Actual_Hours_Per_Week) as actual_max_number_of_hours from unified "
        "where Company_Name != '' group by Company_Name "
        "order by actual_max_number_of_hours desc nulls last, Company_Name asc nulls last limit 4"
    )

    # through CSV files and the batch job: a blank answer comes back as NULL
    batch = _unified_base(null_blank=True)
    columns = "select * exclude (row_id) from unified"
    q["batch_unified"] = batch + columns
    q["batch_quality"] = _base("ABC", null_blank=True) + _counts(" union all ".join(_reason_rows(f, False) for f in "ABC"))
    q["batch_report_location"] = q["report_location"].replace(uni, batch)
    q["batch_report_happy"] = q["report_happy"].replace(uni, batch)

    q["role_compensation"] = (
        "with p as (select upper(p_name) as Job_Title, cast(p_retailprice as decimal(38,2)) as Salary from part) "
        f"select Job_Title, {avg2('Salary')} as Compensation from p "
        "where contains(Job_Title, 'BOLT') or contains(Job_Title, 'GEAR') or contains(Job_Title, 'RING') "
        "group by Job_Title"
    )
    q["location_compensation"] = (
        "with c as (select c_nationkey as Location, cast(c_acctbal as decimal(38,2)) as Salary from customer) "
        f"select Location, {avg2('Salary')} as Average_Compensation, min(Salary) as Min_Compensation, "
        "max(Salary) as Max_Compensation from c group by Location"
    )
    q["cash_vs_other"] = (
        "select cast(l_extendedprice as decimal(38,2)) as Cash_Compensation, "
        "cast(l_quantity as decimal(38,2)) as Other_Forms_Of_Compensation from lineitem"
    )
    q["top5_happy"] = (
        "select user_id, count(event_type) as happy_counts from events where event_type = 'purchase' "
        "group by user_id order by happy_counts desc nulls last, user_id asc nulls last limit 5"
    )
    q["top4_hours"] = (
        "select user_id, max(value) as actual_max_number_of_hours from events where event_type != 'signup' "
        "group by user_id order by actual_max_number_of_hours desc nulls last, user_id asc nulls last limit 4"
    )
    q["dictionary_standardise"] = (
        "select c.c_custkey, c.c_nationkey, c.c_mktsegment, coalesce(d.v, cast(c.c_nationkey as varchar)) as c_nation "
        "from customer c left join (select n_nationkey as k, min(n_name) as v from nation group by n_nationkey) d "
        "on c.c_nationkey = d.k"
    )
    q["location_dictionary"] = pb + (
        f", gb as ({_clean_sql('B')}), "
        "d as (select lower(n_name) as k, min(n_name || '/' || r_name) as v from nation "
        "join region on n_regionkey = r_regionkey group by lower(n_name)) "
        "select gb.row_id, coalesce(d.v, gb.Location) as Location from gb left join d on gb.Location = d.k"
    )
    q["csv_round_trip"] = _with(("raw", RAW)) + (
        "select row_id, "
        + ", ".join(f"nullif({src}, '') as {dst}" for dst, src in FORM_COLUMNS["B"].items())
        + " from raw"
    )
    q["stream_form_b"] = _base("B", null_blank=True) + _clean_sql("B")
    return q


ORACLE_SQL = build()
