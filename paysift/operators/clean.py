"""Prepare, tag, clean and route one survey form.

One projection computes, per row, the prepared text, the typed output fields
and an ordered ``reasons`` array. Good rows (no reason) and rejected rows are
two filters over that one tagged relation, so the raw input is not re-tested
once per rule, and ``reasons[0]`` names the first failed test in rule order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from paysift.functions.casts import to_kind
from paysift.functions.text import trim_or_default
from paysift.operators.forms import FormSpec, Rule

REASONS = "reasons"
TYPED = "typed__"
DEFAULTED = "Salary_Defaulted"
CAST_FAIL_MODES = ("null", "quarantine", "raise")


@dataclass(frozen=True)
class LandedCounts:
    """Rows of a landing: all, good, and per reason (of all reasons, and of each row's first one)."""

    rows: int
    good: int
    reasons: dict[str, int]
    first_reasons: dict[str, int]

    @property
    def rejected(self) -> int:
        return self.rows - self.good


class CleanResult:
    """Typed good rows and rejected rows (prepared text plus ``reasons``).

    Each side is a DataFrame built on first access, so a caller that uses
    one side does not pay for planning the other. ``counts`` is what a landing
    counted while it wrote (see :func:`land`), else None."""

    def __init__(self, good: Callable[[], DataFrame], rejected: Callable[[], DataFrame], counts: LandedCounts | None = None):
        self._make = {"good": good, "rejected": rejected}
        self._built: dict[str, DataFrame] = {}
        self.counts = counts

    def _side(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._make[name]()
        return self._built[name]

    @property
    def good(self) -> DataFrame:
        return self._side("good")

    @property
    def rejected(self) -> DataFrame:
        return self._side("rejected")


def prepare(raw: DataFrame, spec: FormSpec, keep: Sequence[str] = (), flag_defaulted: bool = False) -> DataFrame:
    """Trim every source column and replace NULL by the form's default.
    ``flag_defaulted`` adds ``Salary_Defaulted``: the salary answer was
    missing and now holds the default 0."""
    flag = [F.col(spec.salary).isNull().alias(DEFAULTED)] if flag_defaulted else []
    return raw.select(*keep, *flag, *[trim_or_default(s.name, s.default).alias(s.name) for s in spec.sources])


def _empty() -> Column:
    return F.array().cast("array<string>")


def _named_if(test: Column, name: str) -> Column:
    return F.when(test, F.array(F.lit(name))).otherwise(_empty())


def reasons_of(tests: Iterable[tuple[str, Column]]) -> Column:
    """Names of the failed tests, in order (empty array when none).

    Built from ``concat``/``when``/``array`` only: unlike ``array_compact``
    (a lambda function), these compile into whole-stage codegen, so the
    tests stay in generated code with common subexpressions shared.
    """
    parts = [_named_if(test, name) for name, test in tests]
    if not parts:
        return _empty()
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def tag(
    prepared: DataFrame,
    spec: FormSpec,
    keep: Sequence[str] = (),
    on_cast_fail: str = "null",
    extra_rules: Sequence[Rule] = (),
) -> DataFrame:
    """Prepared text + typed fields (prefixed ``typed__``) + ``reasons``.

    ``on_cast_fail``: ``null`` keeps a value that does not convert as NULL;
    ``quarantine`` rejects the row with reason ``cast_<field>``; ``raise``
    fails the job naming the field and the text. Both act only on rows that no
    rule rejects, so one defect has one reason and a quarantined row never
    fails the job; fields whose text may be open (``65 or over``) are left out.
    """
    if on_cast_fail not in CAST_FAIL_MODES:
        raise ValueError(f"on_cast_fail must be one of {CAST_FAIL_MODES}")
    typed, fails = [], []
    tests = [(r.name, r.test()) for r in [*spec.rules, *extra_rules]]
    passes = ~reduce(or_, [F.coalesce(t, F.lit(False)) for _, t in tests], F.lit(False))
    for f in spec.fields:
        text = f.text()
        value = to_kind(text, f.kind)
        strict = f.kind != "string" and not f.may_be_open
        failed = passes & text.isNotNull() & value.isNull() if strict else None
        if on_cast_fail == "raise" and failed is not None:
            msg = F.concat(F.lit(f"cannot convert {f.name} to {f.kind}: "), text)
            value = F.when(failed, F.raise_error(msg)).otherwise(value)
        if on_cast_fail == "quarantine" and failed is not None:
            fails.append((f"cast_{f.name}", failed))
        typed.append(value.alias(TYPED + f.name))
    reasons = reasons_of([*tests, *fails])
    return prepared.select(*keep, *spec.names, *typed, reasons.alias(REASONS))


def route(tagged: DataFrame, spec: FormSpec, keep: Sequence[str] = ()) -> CleanResult:
    def good() -> DataFrame:
        ok = F.size(REASONS) == 0
        return tagged.filter(ok).select(*keep, *[F.col(TYPED + n).alias(n) for n in spec.field_names])

    def rejected() -> DataFrame:
        return tagged.filter(F.size(REASONS) > 0).select(*keep, *spec.names, REASONS)

    return CleanResult(good, rejected)


def reason_names(spec: FormSpec, on_cast_fail: str = "null", extra_rules: Sequence[Rule] = ()) -> list[str]:
    """Every reason that :func:`tag` can give, in order."""
    casts = [f"cast_{f.name}" for f in spec.fields if f.kind != "string" and not f.may_be_open]
    return [*[r.name for r in [*spec.rules, *extra_rules]], *(casts if on_cast_fail == "quarantine" else [])]


def land(tagged: DataFrame, path: str, text_columns: Sequence[str] | None = None, reasons: Sequence[str] | None = None) -> LandedCounts | None:
    """Write a tagged form once, split by status (``status=good|rejected``).

    Each row keeps the half that its status needs: typed values if good, the
    prepared text (``text_columns``) if rejected. The whole landing is replaced, whatever the
    session's partition overwrite mode. With ``spark.sql.maxConcurrentOutputFileWriters``
    of 2 or more in the session, tasks write both sides at once and don't sort their rows by status.

    With ``reasons`` (all names that may occur), rows are counted by an
    ``Observation`` as they are written, and no one reads them again to count;
    the landing then has a readable ``status=rejected`` folder even if it is empty.
    """
    counted, observation = _observed(tagged, reasons) if reasons is not None else (tagged, None)
    _write_landing(counted, path, text_columns)
    if observation is None:
        return None
    counts = _counts(observation, reasons)
    if not counts.rejected:
        none = tagged.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in tagged.schema.fields]).limit(0)
        none.write.mode("overwrite").parquet(f"{path}/status=rejected")
    return counts


def _observed(tagged: DataFrame, reasons: Sequence[str]) -> tuple[DataFrame, Observation]:
    observation = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(REASONS) == 0).alias("good")]
    for i, name in enumerate(reasons):
        metrics.append(F.count_if(F.array_contains(REASONS, name)).alias(f"any_{i}"))
        metrics.append(F.count_if(F.get(F.col(REASONS), 0) == name).alias(f"first_{i}"))
    return tagged.observe(observation, *metrics), observation


def _counts(observation: Observation, reasons: Sequence[str]) -> LandedCounts:
    got = observation.get
    each = {kind: {name: got[f"{kind}_{i}"] for i, name in enumerate(reasons) if got[f"{kind}_{i}"]} for kind in ("any", "first")}
    return LandedCounts(got["rows"], got["good"], each["any"], each["first"])


def counted_reasons(spark, counts: dict[str, LandedCounts], first_only: bool = False) -> DataFrame:
    """The data-quality table (form, reason, n) from what the landings counted; equal to :func:`reason_counts`."""
    rows = [(form, reason, n) for form, c in counts.items() for reason, n in (c.first_reasons if first_only else c.reasons).items()]
    return spark.createDataFrame(rows, "form string, reason string, n long")


def _write_landing(tagged: DataFrame, path: str, text_columns: Sequence[str] | None) -> None:
    good = F.size(REASONS) == 0
    landed = [c for c in tagged.columns if c.startswith(TYPED)]
    text = [c for c in (text_columns or ()) if c in tagged.columns]
    halves = {c: F.when(good, F.col(c)) for c in landed} | {c: F.when(~good, F.col(c)) for c in text}
    out = tagged.select(*[halves.get(c, F.col(c)).alias(c) for c in tagged.columns], F.when(good, "good").otherwise("rejected").alias("status"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("status").parquet(path)


def route_landed(
    spark, path: str, spec: FormSpec, keep: Sequence[str] = (), schema: StructType | None = None
) -> CleanResult:
    """Good and rejected rows as partition-pruned reads of a landed form
    (``schema``: the tagged schema, so an empty landing still reads)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType([*schema.fields, StructField("status", StringType())]))
    landed = reader.parquet(path)

    def good() -> DataFrame:
        rows = landed.filter(F.col("status") == "good")
        return rows.select(*keep, *[F.col(TYPED + n).alias(n) for n in spec.field_names])

    def rejected() -> DataFrame:
        return landed.filter(F.col("status") == "rejected").select(*keep, *spec.names, REASONS)

    return CleanResult(good, rejected)


def process_form(
    raw: DataFrame,
    spec: FormSpec,
    keep: Sequence[str] = (),
    on_cast_fail: str = "null",
    extra_rules: Sequence[Rule] = (),
    land_to: str | None = None,
    flag_defaulted: bool = False,
) -> CleanResult:
    """Raw renamed strings -> CleanResult(good typed rows, rejected rows).

    Lazily, ``good`` and ``rejected`` are two filters over one tagged
    projection; reading both scans the input twice. With ``land_to`` (a
    folder on shared storage) the tagged rows are written once and both
    sides are partition-pruned reads of that table; the result then has
    ``counts``. ``flag_defaulted`` carries a ``Salary_Defaulted`` column through to both sides.
    """
    prepared = prepare(raw, spec, keep, flag_defaulted)
    keep = [*keep, DEFAULTED] if flag_defaulted else keep
    tagged = tag(prepared, spec, keep, on_cast_fail, extra_rules)
    if land_to is None:
        return route(tagged, spec, keep)
    counts = land(tagged, land_to, spec.names, reason_names(spec, on_cast_fail, extra_rules))
    result = route_landed(raw.sparkSession, land_to, spec, keep, schema=tagged.schema)
    result.counts = counts
    return result


def clean(raw: DataFrame, spec: FormSpec, keep: Sequence[str] = (), on_cast_fail: str = "null") -> DataFrame:
    """Typed good rows only."""
    return process_form(raw, spec, keep, on_cast_fail).good


def reason_counts(tagged: DataFrame, form: str | None = None, first_only: bool = False) -> DataFrame:
    """Data-quality table: rows per reject reason (or per first reason, the
    bucket a cascade of filters would have put the row in).

    Takes a tagged or a rejected frame. ``explode_outer`` plus a filter on
    its output keeps ``reasons`` computed once, in the projection (an inner
    ``explode`` would add an inferred ``size(reasons) > 0`` filter that
    Catalyst pushes below that projection, evaluating every test twice).
    """
    reason = F.get(F.col(REASONS), 0) if first_only else F.explode_outer(REASONS)
    out = tagged.select(reason.alias("reason")).filter(F.col("reason").isNotNull())
    if form is not None:
        out = out.select(F.lit(form).alias("form"), "reason")
    keys = ["form", "reason"] if form is not None else ["reason"]
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
