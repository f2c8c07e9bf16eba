"""Raw survey text derived from the driver tables.

The driver tables are clean, so dirty survey answers are derived from them
with one SQL text that Spark and DuckDB both run unchanged: every row of
``orders`` (joined to its customer and nation) becomes one answer per form,
its text chosen by key arithmetic and built from the row's own values. The
work therefore grows with ``orders``; no row is dropped.

``{orders}``, ``{customer}``, ``{nation}`` and ``{base}`` are placeholders:
Spark fills them with DataFrames (``spark.sql(text, orders=df, ...)``), the
oracle with view names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysift.operators.forms import FORMS

RAW_SURVEY_SQL = """
select
  o_orderkey as row_id,
  case when o_orderkey % 97 = 0 then null else concat(
    cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/',
    case when o_orderkey % 89 = 0 then '97' else cast(year(o_orderdate) as string) end, ' ',
    cast(o_orderkey % 24 as string), ':', lpad(cast(o_orderkey % 60 as string), 2, '0'), ':',
    lpad(cast(o_custkey % 60 as string), 2, '0')) end as created_at,
  case o_custkey % 12
    when 0 then 'Software Engineer' when 1 then 'Senior Data Analyst' when 2 then 'project manager'
    when 3 then 'Luxury Sales Associate' when 4 then 'Web Developer' when 5 then 'Registered Nurse'
    when 6 then 'UX Designer' when 7 then 'Full Stack Developer' when 8 then 'Solutions Architect'
    when 9 then 'Accountant' when 10 then ' Tech Lead ' else null end as job_title,
  case o_orderkey % 6 when 0 then '25-34' when 1 then '65 or over' when 2 then 'under 18'
    when 3 then '35-44' when 4 then ' 45-54 ' else null end as age_range,
  case o_orderkey % 4 when 0 then lower(c_mktsegment) when 1 then c_mktsegment
    when 2 then concat(c_mktsegment, ' - services') else null end as industry_a,
  case o_orderkey % 8
    when 0 then concat('$', cast(cast(o_totalprice as decimal(38,2)) as string))
    when 1 then concat(cast(o_custkey as string), ',', lpad(cast(o_orderkey % 1000 as string), 3, '0'))
    when 2 then concat(cast(o_custkey as string), 'k')
    when 3 then concat('~', cast(o_custkey as string), ' 000')
    when 4 then concat(cast(o_custkey as string), ' (', cast(o_orderkey as string), ')')
    when 5 then concat(cast(o_custkey as string), ' USD')
    when 6 then concat('£', cast(o_custkey as string)) else null end as salary_a,
  case o_orderkey % 6 when 0 then concat(n_name, ', UK')
    when 1 then concat(lower(c_mktsegment), '/', n_name, '/USA')
    when 2 then concat('New York (', n_name, '), NY') when 3 then ' (remote)'
    when 4 then null else concat(' ', n_name, ' ') end as location_a,
  case o_orderkey % 5 when 0 then '8 - 10 years' when 1 then '1 year or less'
    when 2 then '41 years or more' when 3 then '5-7 years' else null end as experience_a,
  case when o_orderkey % 9 = 0 then null when o_orderkey % 9 = 1 then ''
    when o_orderkey % 9 = 2 then concat(' acme ', cast(o_custkey % 40 as string), ' ')
    when o_orderkey % 9 = 3 then concat('Acme "', cast(o_custkey % 40 as string), '" & Sons,', chr(10), 'Ltd')
    when o_orderkey % 9 = 4 then concat('"', cast(o_custkey % 40 as string), '",', chr(10), chr(10), '""')
    else concat('Acme ', cast(o_custkey % 40 as string)) end as company_b,
  case when o_orderkey % 11 = 0 then '' when o_orderkey % 11 = 1 then null
    else n_name end as country_b,
  case when o_orderkey % 7 = 0 then '' when o_orderkey % 13 = 0
    then concat(c_mktsegment, ' (HQ), x') when o_orderkey % 17 = 0
    then concat(lower(c_mktsegment), ', north') else c_mktsegment end as city_b,
  case o_orderkey % 5 when 0 then concat(lower(c_mktsegment), ' - saas')
    when 1 then concat(c_mktsegment, '/retail') when 2 then c_mktsegment
    when 3 then concat(c_mktsegment, '- x') else null end as industry_b,
  case o_orderkey % 8 when 0 then '5-10' when 1 then '40+' when 2 then '5 - 10' when 3 then '20'
    when 4 then '10-20-30' when 5 then '-5' when 6 then 'n/a' else null end as experience_b,
  case o_orderkey % 7 when 0 then '40+' when 1 then '40 - 50' when 2 then '45' when 3 then '2.5'
    when 4 then 'n/a' when 5 then '-5' else null end as hours_b,
  case when o_orderkey % 10 = 0 then null
    when o_orderkey % 10 = 1 then concat(cast(40 + o_custkey % 23 as string), '+')
    else concat(cast(30 + o_orderkey % 37 as string), ' - ', cast(45 + o_custkey % 41 as string))
    end as actual_hours_b,
  case o_orderkey % 7
    when 0 then concat('$', cast(cast(o_totalprice as decimal(38,2)) as string))
    when 1 then cast(cast(o_totalprice as decimal(38,2)) as string)
    when 2 then concat(cast(o_custkey as string), 'k')
    when 3 then cast(o_custkey * 100 as string)
    when 4 then concat(cast(o_custkey as string), ',000')
    when 5 then ' 12.345 ' else null end as base_b,
  case o_orderkey % 5 when 0 then cast(o_custkey % 1000 as string) when 1 then '10k'
    when 2 then '' when 3 then '2.5' else null end as bonus_b,
  case o_orderkey % 6 when 0 then '4+' when 1 then '3' when 2 then '2.5' when 3 then 'unlimited'
    when 4 then ' 6 ' else null end as vacation_b,
  case o_orderkey % 4 when 0 then 'YES' when 1 then 'no' when 2 then ' yes ' else null end as happy_b,
  case o_orderkey % 3 when 0 then 'No' when 1 then 'maybe' else null end as resign_b,
  case o_orderkey % 5 when 0 then 'Male' when 1 then ' FEMALE ' when 2 then 'prefer not to say'
    when 3 then '' else null end as gender_b,
  case when o_orderkey % 8 = 0 then null
    else concat('Firm ', cast(o_custkey % 30 as string)) end as employer_c,
  case o_orderkey % 7 when 0 then concat(n_name, ', ', c_mktsegment)
    when 1 then concat(n_name, ';UK') when 2 then cast(10000 + o_custkey % 90000 as string)
    when 3 then '12 34' when 4 then '' when 5 then lower(n_name) else null end as location_c,
  case o_orderkey % 10 when 0 then '5' when 1 then '<1' when 2 then '3 years (ML)' when 3 then '-2'
    when 4 then '' when 5 then '5-10' when 6 then '10+ years' when 7 then '< 1'
    when 8 then '5 - 10 years' else null end as experience_c,
  case o_orderkey % 7 when 0 then concat('$', cast(o_custkey as string), ',000')
    when 1 then concat('€ ', cast(o_custkey % 900 as string), ' 000')
    when 2 then concat('£', cast(o_custkey as string), ',500') when 3 then '-1'
    when 4 then '100/200' when 5 then concat(cast(o_custkey as string), '000 USD')
    else null end as base_c,
  case o_orderkey % 5 when 0 then concat('$', cast(o_custkey % 50 as string), ',000')
    when 1 then '10k' when 2 then '0' when 3 then cast(o_custkey as string) else null end as signing_c,
  case o_orderkey % 10 when 0 then '5000'
    when 1 then concat('£', cast(o_custkey % 10 as string), ',000') when 2 then ''
    when 3 then '10%' when 4 then '5-10%' when 5 then '10k' when 6 then '1-2' when 7 then '10% - 20k'
    when 8 then cast(o_custkey as string) else null end as annual_bonus_c,
  case o_orderkey % 6 when 0 then 'male' when 1 then 'Female ' when 2 then 'prefer not'
    when 3 then 'other' when 4 then '' else null end as gender_c
from {base}
"""

# The rows the answers are derived from: every order with its customer's
# segment and nation name.
BASE_SQL = """
select o_orderkey, o_custkey, o_totalprice, o_orderdate, c_mktsegment, n_name
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
"""

# Which derived column feeds which renamed form column.
FORM_COLUMNS = {
    "A": {
        "Created_At": "created_at", "Age_Range": "age_range", "Industry": "industry_a",
        "Job_Title": "job_title", "Annual_Salary": "salary_a", "Location": "location_a",
        "Work_Experience": "experience_a",
    },
    "B": {
        "Created_At": "created_at", "Company_Name": "company_b", "Country": "country_b", "City": "city_b",
        "Industry": "industry_b", "Work_Exp": "experience_b", "Job_Title": "job_title",
        "Hours_Per_Week": "hours_b", "Actual_Hours_Per_Week": "actual_hours_b",
        "Base_Salary_2018": "base_b", "Bonus_2018": "bonus_b", "Annual_Vacation_In_Weeks": "vacation_b",
        "Happy_With_Job": "happy_b", "Want_To_Resign": "resign_b", "Gender": "gender_b",
    },
    "C": {
        "Created_At": "created_at", "Company_Name": "employer_c", "Location": "location_c",
        "Job_Title": "job_title", "Work_Exp": "experience_c", "Annual_Base_Salary": "base_c",
        "Signing_Bonus": "signing_c", "Annual_Bonus": "annual_bonus_c", "Gender": "gender_c",
    },
}

# Consistency check: the derived forms carry exactly the spec's columns, in order.
for _f, _m in FORM_COLUMNS.items():
    assert list(_m) == FORMS[_f].names, _f


# Form C's answers in the order of its columns, for :func:`damaged_lines`.
LINE_COLUMNS = FORM_COLUMNS["C"]


def _cell(column: str) -> str:
    return f"""case when {column} is null then '' else concat('"', replace({column}, '"', '""'), '"') end"""


def _line(columns: list[str]) -> str:
    return "concat(cast(row_id as string), " + ", ".join(f"',', {_cell(c)}" for c in columns) + ")"


# Form C as CSV lines in eight files, some with a field too many, two too few, or a quote that never closes.
DAMAGED_LINES_SQL = f"""
select cast(row_id % 8 as int) as lot, row_id as place, case row_id % 23
    when 0 then concat({_line(list(LINE_COLUMNS.values()))}, ',one, too many')
    when 1 then {_line(list(LINE_COLUMNS.values())[:-2])}
    when 2 then concat(cast(row_id as string), ',"torn,', cast(row_id as string))
    else {_line(list(LINE_COLUMNS.values()))} end as value
from {{base}}
"""


def damaged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lot, place, value): the lines, with each file's header at place -1."""
    wide = raw_survey(spark, sf_dir)
    header = ",".join(["row_id", *FORMS["C"].headers])
    lines = spark.sql(DAMAGED_LINES_SQL, base=wide)
    heads = lines.groupBy("lot").agg(F.min(F.lit(-1).cast("long")).alias("place"), F.min(F.lit(header)).alias("value"))
    return lines.unionByName(heads)


def resubmitted(raw: DataFrame) -> DataFrame:
    """A raw form whose every seventh row comes again under another row_id."""
    return raw.unionByName(raw.where("row_id % 7 = 0").withColumn("row_id", F.col("row_id") + 1_000_000_000))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def survey_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return spark.sql(
        BASE_SQL,
        orders=orders,
        customer=load_table(spark, sf_dir, "customer"),
        nation=load_table(spark, sf_dir, "nation"),
    )


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide derived table: ``row_id`` plus every raw answer column."""
    return spark.sql(RAW_SURVEY_SQL, base=survey_base(spark, sf_dir))


def written_survey(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """:func:`raw_survey` over its rows as written to ``path``, dealt evenly.

    The text of an order is many times its row in ``orders``, whose few files would be as few
    tasks, and as few CSV files that no reader can split. The joins run once for all forms.
    """
    survey_base(spark, sf_dir).repartition("o_orderkey", "o_custkey").write.parquet(path)
    return spark.sql(RAW_SURVEY_SQL, base=spark.read.parquet(path))


def form_projection_sql(form: str, source: str = "raw") -> str:
    """SQL select list that turns the wide table into one renamed raw form."""
    cols = ", ".join(f"{src} as {dst}" for dst, src in FORM_COLUMNS[form].items())
    return f"select row_id, {cols} from {source}"


def raw_form(spark: SparkSession, sf_dir: str, form: str, wide: DataFrame | None = None) -> DataFrame:
    """One raw form as all-string renamed columns plus ``row_id``."""
    wide = raw_survey(spark, sf_dir) if wide is None else wide
    return wide.select("row_id", *[wide[src].alias(dst) for dst, src in FORM_COLUMNS[form].items()])
