"""Quarantine, damaged rows, keyed rules, dictionaries, live reports, corrections, counts, SQL functions and publishing."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from survey_helpers import plan_of

from paysift import FORM_A, FORM_B, FORM_C, FORMS, process_form, reason_counts, unify
from paysift.functions.sql_functions import clean_with_sql
from paysift.operators import live_reports
from paysift.operators.clean import counted_reasons, prepare, tag
from paysift.operators.corrections import merge, read_merged, return_corrections, still_open, unified_rows
from paysift.operators.dictionary import closest_keys, standardise_as_of, standardise_inexact
from paysift.operators.group_rules import GroupRule, contradicts, duplicate_submission, process_with_groups
from paysift.operators.quarantine import amend, long_form, long_quarantine, restore
from paysift.plans.batch import build_reports, quarantine_of, run_batch
from paysift.sources.damaged import LINEAGE, damage_rules, header_of, read_checked
from paysift.sources.derived import raw_form, raw_survey
from paysift.sources.publish import current, new_version, pointers, publish, vacuum
from paysift.sources.sinks import write_report

KEEP = ["row_id"]


@pytest.fixture(scope="module")
def wide(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("wide") / "w")
    raw_survey(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def form_rows(spark, form, *rows):
    """Raw rows of a form with a row_id; answers that a row leaves out are null."""
    names = FORMS[form].names
    data = [(i, *[r.get(n) for n in names]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "row_id long, " + ", ".join(f"{n} string" for n in names))


def key(rows):
    return sorted(map(tuple, rows), key=repr)


# ---- long quarantine ---------------------------------------------------------------------


def test_long_quarantine_keeps_every_reject_and_answer(spark, sf_dir, wide):
    rejected = {f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f], KEEP).rejected for f in "ABC"}
    long = long_quarantine(rejected, KEEP)
    assert dict(long.dtypes) == {"form": "string", "row_id": "bigint", "reasons": "array<string>", "record": "map<string,string>"}
    for f in "ABC":
        assert key(restore(long, FORMS[f], KEEP).collect()) == key(rejected[f].collect())


def test_long_form_of_missing_answers_and_amended_rows(spark):
    rejected = process_form(form_rows(spark, "C", {"Annual_Base_Salary": "10k", "Gender": "x"}, {"Signing_Bonus": "ask"}), FORM_C, KEEP).rejected
    long = long_form(rejected.withColumn("Location", F.lit(None).cast("string")), FORM_C, KEEP)
    assert all(len(r.record) == 9 and r.record["Location"] is None for r in long.collect())
    answers = spark.createDataFrame(
        [("C", 0, "Annual_Base_Salary", "10000"), ("C", 0, "Annual_Base_Salary", "1"), ("C", 0, "No_Such", "x"), ("B", 1, "Signing_Bonus", "5"), ("C", 9, "Gender", "y")],
        "form string, row_id long, column string, answer string",
    )
    got = amend(long, answers, KEEP).collect()
    assert [(r.row_id, r.record["Annual_Base_Salary"], r.record["Gender"], len(r.record)) for r in got] == [(0, "10000", "x", 9)]
    assert long_form(rejected.limit(0), FORM_C, KEEP).count() == 0


# ---- damaged CSV rows --------------------------------------------------------------------


def form_c_file(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(",".join(FORM_C.headers) + "\n" + "\n".join(lines))
    return str(path.parent)


def test_damaged_rows_are_told_apart_with_their_file(spark, tmp_path):
    whole = '1/2/2020 1:02:03,"Acme ""X"", Ltd","Rome,\nItaly",Dev,5,100,0,0,male'
    folder = form_c_file(tmp_path / "in" / "one.csv", whole, whole + ",extra,more", "1/2/2020 1:02:03,Short")
    form_c_file(tmp_path / "in" / "two.csv", whole.replace("100", "10k") + ",x", '1/2/2020 1:02:03,"Torn,Rome', "swallowed,line")
    header = header_of(spark, folder)
    raw = read_checked(spark, folder, FORM_C, header=header)
    result = process_form(raw, FORM_C, LINEAGE, extra_rules=damage_rules(len(header)))
    got = sorted((r.source_file.rsplit("/", 1)[1], r.reasons, r.damaged_text) for r in result.rejected.collect())
    assert [g[:2] for g in got] == [("one.csv", ["long_row"]), ("one.csv", ["short_row"]), ("two.csv", ["salary_alpha", "long_row"]), ("two.csv", ["torn_row"])]
    assert got[1][2] == "1/2/2020 1:02:03,Short" and got[3][2].endswith("swallowed,line") and got[0][2].endswith(",extra,more")
    good = result.good.collect()
    assert len(good) == 1 and good[0]["Company_Name"] == 'ACME "X", LTD' and good[0].source_file.endswith("one.csv") and good[0].damaged_text is None


def test_batch_job_lands_damaged_rows_in_the_quarantine(spark, tmp_path):
    folder = form_c_file(tmp_path / "in" / "c.csv", "1/2/2020 1:02:03,A,Rome,Dev,5,100,0,0,male", "1/2/2020 1:02:03,B", "1/2/2020 1:02:03,C,Rome,Dev,5,1k,0,0,male")
    res = run_batch(spark, {"C": folder}, f"{tmp_path}/out", report_format="parquet", check_rows=True)
    long = quarantine_of(spark, res, ["source_file"]).collect()
    assert sorted((r.form, *r.reasons, r.record["Company_Name"]) for r in long) == [("C", "salary_alpha", "C"), ("C", "short_row", "B")]
    assert all(r.source_file.endswith("c.csv") for r in long) and res.counts["C"].rows == 3 and res.counts["C"].rejected == 2
    assert spark.read.parquet(res.unified).count() == 1


# ---- rules over several rows ---------------------------------------------------------------


def test_duplicate_submissions_under_a_hot_key(spark):
    n = 3_000
    rows = spark.range(n).select(F.col("id").alias("row_id"), *[F.lit(None).cast("string").alias(x) for x in FORM_B.names if x != "Company_Name"],
                                 F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 1500).cast("string"))).alias("Company_Name"))
    result = process_with_groups(rows.repartition(7), FORM_B, [duplicate_submission(FORM_B, "row_id")], KEEP)
    good, rejected = {r.row_id for r in result.good.collect()}, {r.row_id: r.reasons for r in result.rejected.collect()}
    first = {}
    for i in range(n):
        first.setdefault("hot" if i % 3 == 0 else i % 1500, i)
    assert good == set(first.values()) and set(rejected) == set(range(n)) - good and set(map(tuple, rejected.values())) == {("duplicate_submission",)}
    plan = plan_of(result.rejected)
    assert "Window" not in plan and "partial_count" in plan


def test_equal_answers_need_equal_fields(spark):
    """Answers that read the same when written one after the other are not the same."""
    rows = form_rows(spark, "B", {"Company_Name": "ab", "Country": "c"}, {"Company_Name": "a", "Country": "bc"}, {"Company_Name": " ab ", "Country": "c"})
    result = process_with_groups(rows, FORM_B, [duplicate_submission(FORM_B, "row_id")], KEEP)
    assert [r.row_id for r in result.rejected.collect()] == [2]


def test_contradictions_need_an_agreed_answer(spark):
    same = {"Created_At": "1/1/2020 1:00:00", "Job_Title": "Dev"}
    b = form_rows(spark, "B", same | {"Gender": "Male"}, same | {"Gender": "female"}, same | {"Gender": None}, {"Job_Title": "Ops", "Gender": "Male"})
    sex = lambda: F.when(F.upper("Gender").isin("MALE", "FEMALE"), F.upper("Gender"))
    by = lambda: F.concat_ws("|", "Created_At", "Job_Title")

    def rejected(*c):
        rule = contradicts("other_form", by, sex, prepare(form_rows(spark, "C", *c), FORM_C))
        return sorted(r.row_id for r in process_with_groups(b, FORM_B, [rule], KEEP).rejected.collect())

    assert rejected(same | {"Gender": "female"}, same | {"Gender": "?"}) == [0]
    assert rejected(same | {"Gender": "female"}, same | {"Gender": "male"}) == []
    assert rejected({"Job_Title": "Ops", "Gender": "female"}) == [3]


def test_group_rule_by_a_null_key_rejects_nobody(spark):
    rule = GroupRule("crowd", lambda: F.nullif(F.col("Company_Name"), F.lit("")), lambda: {"c": F.count("*")}, lambda: F.col("c") > 1, lambda: F.lit(True))
    rows = form_rows(spark, "B", {}, {}, {"Company_Name": "x"}, {"Company_Name": "x"})
    result = process_with_groups(rows, FORM_B, [rule], KEEP)
    assert sorted(r.row_id for r in result.rejected.collect()) == [2, 3] and result.good.columns[0] == "row_id" and "c" not in result.good.columns
    assert process_with_groups(rows.limit(0), FORM_B, [rule], KEEP).good.count() == 0


# ---- dictionaries ------------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_blocks_lose_no_pair(spark, distance):
    rng = random.Random(distance)
    words = {"".join(rng.choice("ab_é") for _ in range(rng.randint(0, 9))) for _ in range(260)}
    keys, values = [w for w in sorted(words) if rng.random() < 0.4], sorted(words)
    found = closest_keys(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(k,) for k in keys], "key string"), distance)
    want = []
    for v in values:
        d, k = min((edits(v, k), k) for k in keys)
        if d <= distance:
            want.append((v, k, d))
    assert key(found.collect()) == key(want)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


@pytest.mark.parametrize("distance", [1, 2, 3])
@pytest.mark.parametrize("many", [0, 1, 4])
def test_pieces_that_many_keys_share_lose_no_pair(spark, distance, many):
    rng = random.Random(distance + 10 * many)
    keys = sorted({"".join(rng.choice("aab") for _ in range(rng.randint(0, 7))) for _ in range(25)} | {"éa", "aaaaaa", "No#0001", "No#0012", "No#0110"})
    values = sorted({"".join(rng.choice("aab") for _ in range(rng.randint(0, 8))) for _ in range(25)} | {"éb", "N#001", "Noo#0010", "No#00112", "zzzzzzz"})
    found = closest_keys(spark.createDataFrame([(v,) for v in values], "value string"), spark.createDataFrame([(k,) for k in keys], "key string"), distance, many=many)
    want = [(v, k, d) for v in values for d, k in [min((edits(v, k), k) for k in keys)] if d <= distance]
    assert key(found.collect()) == key(want)


def test_one_common_piece_does_not_meet_all_keys(spark):
    keys = spark.range(3000).select(F.concat(F.lit("Customer#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("key"))
    values = spark.range(300).select(F.concat(F.lit("Custmer#"), F.lpad((F.col("id") * 7).cast("string"), 8, "0")).alias("value"))
    found = closest_keys(values, keys, 2)
    assert found.where("distance = 2").count() == 300
    joined = []  # rows out of each join of the executed plan

    def walk(node):
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            joined.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            walk(node.plan())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.queryExecution().toRdd().count()
    walk(plan)
    assert joined and max(joined) < 100_000  # every pair would be 900,000


def test_inexact_standardisation_keeps_rows_and_prefers_the_exact_key(spark):
    df = spark.createDataFrame([(1, "londonuk"), (2, "london_uk"), (3, "paris"), (4, None), (5, "londonuk"), (6, "")], "i int, loc string")
    d = spark.createDataFrame([("london_uk", "London/UK"), ("london_uk", "~"), ("londonux", "LX"), (None, "none")], "k string, v string")
    got = {r.i: r["loc"] for r in standardise_inexact(df, d, "loc", "k", "v").collect()}
    assert got == {1: "London/UK", 2: "London/UK", 3: "paris", 4: None, 5: "London/UK", 6: ""}
    assert {r["loc"] for r in standardise_inexact(df, d.limit(0), "loc", "k", "v").collect()} == {"londonuk", "london_uk", "paris", None, ""}


def test_dictionary_as_of_equals_brute_force(spark):
    rng, day = random.Random(5), datetime(2020, 1, 1)
    entries = [(rng.choice("abc"), day + timedelta(hours=rng.randint(0, 24 * 900)), f"v{rng.randint(0, 9)}") for _ in range(60)] + [(None, day, "x"), ("a", None, "y")]
    rows = [(i, rng.choice(["a", "b", "c", "d", None]), day + timedelta(hours=rng.randint(-900, 24 * 1000))) for i in range(400)] + [(400, "a", None), (401, entries[0][0], entries[0][1])]
    df = spark.createDataFrame(rows, "i int, k string, t timestamp")
    d = spark.createDataFrame(entries, "dk string, since timestamp, v string")
    got = standardise_as_of(df, d, "k", "t", "dk", "v", "since", out="name", bin_days=30)
    want = []
    for i, k, t in rows:
        valid = [(s, v) for dk, s, v in entries if dk == k and dk is not None and s is not None and t is not None and s <= t]
        last = max((s for s, _ in valid), default=None)
        want.append((i, k, t, min((v for s, v in valid if s == last), default=None)))
    assert key(got.collect()) == key(want)
    assert "NestedLoop" not in plan_of(got) and "Cartesian" not in plan_of(got)
    assert got.columns == ["i", "k", "t", "name"]


# ---- live reports ------------------------------------------------------------------------


def test_live_reports_equal_full_ones(spark, sf_dir, wide, tmp_path):
    good = {f: process_form(raw_form(spark, sf_dir, f, wide), FORMS[f], KEEP).good for f in "ABC"}
    unify(good, KEEP).write.parquet(f"{tmp_path}/u")
    unified = spark.read.parquet(f"{tmp_path}/u")
    full = {name: key(df.collect()) for name, df in build_reports(unified).items()}
    out = f"{tmp_path}/states"

    def same():
        return all(key(live_reports.live_report(spark, out, name).collect()) == rows for name, rows in full.items())

    parts = [unified.where(f"row_id % 3 = {i}") for i in range(3)]
    for i in (0, 1):
        live_reports.write_states(parts[i], out, i)
    assert not same()
    live_reports.write_states(parts[2], out, 2)
    assert same()
    live_reports.write_states(parts[1], out, 1)  # a replayed batch
    assert same()
    live_reports.compact(spark, out, 1)
    live_reports.write_states(parts[0], out, 0)  # replayed once it is part of the compacted states
    assert same()
    live_reports.compact(spark, out, 2)
    assert same()
    with pytest.raises(FileNotFoundError):
        live_reports.live_report(spark, f"{tmp_path}/none", "cash_vs_other")


def test_sums_that_overflow_in_any_batch_are_null(spark, tmp_path):
    big = spark.createDataFrame([("X", "9" * 36)] * 2, "Location string, s string").select("Location", F.col("s").cast("decimal(38,2)").alias("Salary"))
    few = spark.createDataFrame([("X", "1"), ("Y", "2"), ("Z", None)], "Location string, s string").select("Location", F.col("s").cast("decimal(38,2)").alias("Salary"))
    for parts in ([big, few], [few, big]):
        states = [live_reports.partial_state(p, "location_compensation") for p in parts]
        got = live_reports.finish(live_reports.merge_states(states[0].unionByName(states[1]), "location_compensation"), "location_compensation")
        assert {r.Location: r.Average_Compensation and float(r.Average_Compensation) for r in got.collect()} == {"X": None, "Y": 2.0, "Z": None}


# ---- corrections -------------------------------------------------------------------------


def test_corrected_rows_come_back_once(spark, tmp_path):
    base = f"{tmp_path}/t"
    raw = form_rows(spark, "B", {"Base_Salary_2018": "100", "Gender": "a"}, {"Base_Salary_2018": "10k", "Gender": "b"}, {"Base_Salary_2018": "x", "Bonus_2018": "y", "Gender": "c"})
    result = process_form(raw, FORM_B, KEEP)
    assert merge(spark, base, unified_rows(result.good.withColumn("version", F.lit(0)), FORM_B, KEEP), ["form", *KEEP], buckets=4)
    long = long_form(result.rejected, FORM_B, KEEP)
    assert sorted(r.row_id for r in still_open(long, spark, base, KEEP).collect()) == [1, 2]
    fix = restore(long, FORM_B, KEEP).drop("reasons").withColumn("Base_Salary_2018", F.lit("7")).withColumn("version", F.lit(1))
    again = return_corrections(spark, base, fix, FORM_B, KEEP)
    assert [(r.row_id, r.reasons) for r in again.collect()] == [(2, ["bonus_alpha"])]

    def table():
        return key((r.row_id, r.version, float(r.Salary)) for r in read_merged(spark, base).collect())

    assert table() == [(0, 0, 100.0), (1, 1, 7.0)]
    before = pointers(spark, base)
    return_corrections(spark, base, fix, FORM_B, KEEP)  # a second run changes nothing
    assert table() == [(0, 0, 100.0), (1, 1, 7.0)] and pointers(spark, base) == before
    older = fix.withColumn("version", F.lit(0)).withColumn("Base_Salary_2018", F.lit("9"))
    return_corrections(spark, base, older.where("row_id = 1"), FORM_B, KEEP)
    newer = fix.withColumn("version", F.col("row_id") + 4).withColumn("Base_Salary_2018", F.lit("8")).withColumn("Bonus_2018", F.lit("1"))
    return_corrections(spark, base, newer.unionByName(newer.withColumn("version", F.lit(3))), FORM_B, KEEP)
    assert table() == [(0, 0, 100.0), (1, 5, 8.0), (2, 6, 8.0)]
    assert still_open(long, spark, base, KEEP).count() == 0


def test_merge_rewrites_only_the_buckets_it_changes(spark, tmp_path):
    base = f"{tmp_path}/t"
    rows = spark.range(200).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(0).alias("version"), F.lit("a").alias("v"))
    assert len(merge(spark, base, rows, ["k"], buckets=8)) == 8
    first = current(spark, base)
    changed = merge(spark, base, rows.where("k = 17 or k is null").withColumn("version", F.lit(2)).withColumn("v", F.lit("b")), ["k"])
    second = current(spark, base)
    assert 1 <= len(changed) <= 2 and {b for b in first if first[b] != second[b]} == {str(b) for b in changed}
    got = read_merged(spark, base)
    assert got.count() == 200 and {r.k for r in got.where("v = 'b'").collect()} == {17, None}
    assert merge(spark, base, rows.limit(0), ["k"]) == []


# ---- counts taken while writing ------------------------------------------------------------


def test_observed_counts_equal_reason_counts_without_another_job(spark, sf_dir, wide, tmp_path):
    sc = spark.sparkContext

    def jobs(group, run):
        sc.setJobGroup(group, group)
        try:
            return run(), len(sc.statusTracker().getJobIdsForGroup(group))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    for f in "ABC":
        raw = raw_form(spark, sf_dir, f, wide)
        result, n_counted = jobs(f"counted-{f}", lambda raw=raw, f=f: process_form(raw, FORMS[f], KEEP, on_cast_fail="quarantine", land_to=f"{tmp_path}/{f}"))
        tagged = tag(prepare(raw, FORMS[f], KEEP), FORMS[f], KEEP, "quarantine")
        _, n_plain = jobs(f"plain-{f}", lambda t=tagged, f=f: t.write.parquet(f"{tmp_path}/plain-{f}"))
        assert n_counted == n_plain
        for first in (False, True):
            assert key(counted_reasons(spark, {f: result.counts}, first).collect()) == key(reason_counts(tagged, f, first).collect())
        assert (result.counts.rows, result.counts.good) == (raw.count(), result.good.count())


def test_landing_without_rejects_has_an_empty_audit_table(spark, tmp_path):
    result = process_form(form_rows(spark, "A", {"Annual_Salary": "1"}), FORM_A, KEEP, land_to=f"{tmp_path}/l")
    assert result.counts.rejected == 0 and result.counts.reasons == {}
    assert spark.read.parquet(f"{tmp_path}/l/status=rejected").count() == 0 and result.good.count() == 1 and result.rejected.count() == 0
    empty = process_form(form_rows(spark, "A").limit(0), FORM_A, KEEP, land_to=f"{tmp_path}/e")
    assert empty.counts.rows == 0 and empty.good.count() == 0


# ---- zone, SQL functions, publishing --------------------------------------------------------


def test_times_do_not_depend_on_the_session_zone(spark, tmp_path):
    rows = form_rows(spark, "A", {"Created_At": "3/10/2019 2:30:00", "Annual_Salary": "1"}, {"Created_At": "11/3/2019 1:30:00", "Annual_Salary": "1"})
    want = [1552185000, 1572744600]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        good = process_form(rows, FORM_A, KEEP, land_to=f"{tmp_path}/l").good
        assert [r[0] for r in good.orderBy("row_id").select(F.unix_seconds("Created_At")).collect()] == want
        assert [r[0] for r in clean_with_sql(rows, "A", ("row_id",)).orderBy("row_id").select(F.unix_seconds("Created_At")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("form", "ABC")
def test_sql_text_gives_the_clean_table_without_python(spark, sf_dir, wide, form):
    raw = raw_form(spark, sf_dir, form, wide)
    by_sql, by_api = clean_with_sql(raw, form, ("row_id",)), process_form(raw, FORMS[form], KEEP).good
    assert by_sql.dtypes == by_api.dtypes and key(by_sql.collect()) == key(by_api.collect())
    assert "Python" not in plan_of(by_sql) and "*(1)" in plan_of(by_sql)


def test_publishing_is_whole_or_nothing(spark, tmp_path):
    base = f"{tmp_path}/p"
    assert current(spark, base) == {}
    one, two = spark.range(3), spark.range(5)
    publish(spark, base, {"a": one, "b": one})
    write_report(two, f"{base}/{new_version(base)}/a", "parquet")  # a job dies after its first table


    with pytest.raises(Exception):
        publish(spark, base, {"a": two, "b": two.select(F.raise_error(F.lit("no")).alias("id"))})
    now = current(spark, base)
    assert {n: spark.read.parquet(p).count() for n, p in now.items()} == {"a": 3, "b": 3}
    (tmp_path / "p" / "_pointers" / "000000000009.json").write_text('{"a": "vers')  # died within its pointer
    assert current(spark, base) == now
    publish(spark, base, {"a": two, "b": two})
    assert {n: spark.read.parquet(p).count() for n, p in current(spark, base).items()} == {"a": 5, "b": 5}
    assert vacuum(spark, base, keep=1) == 3
    assert {n: spark.read.parquet(p).count() for n, p in current(spark, base).items()} == {"a": 5, "b": 5} and len(pointers(spark, base)) == 1


def test_a_failed_run_leaves_the_old_reports(spark, tmp_path):
    folder = form_c_file(tmp_path / "in" / "c.csv", "1/2/2020 1:02:03,A,Rome,Dev,5,100,0,0,male")
    run_batch(spark, {"C": folder}, f"{tmp_path}/out", report_format="parquet")
    old = current(spark, f"{tmp_path}/out/reports")
    form_c_file(tmp_path / "in" / "d.csv", "1/2/2020 1:02:03,A,Rome,Dev,5,1.2.3,0,0,male")
    with pytest.raises(Exception):
        run_batch(spark, {"C": folder}, f"{tmp_path}/out", report_format="parquet", on_cast_fail="raise")
    assert current(spark, f"{tmp_path}/out/reports") == old and spark.read.parquet(old["location_compensation"]).count() == 1
