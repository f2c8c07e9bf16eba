"""Reject rules that look at several rows: repeated submissions, answers that contradict other rows.

A :class:`Rule` is one row's Column. A :class:`GroupRule` compares a row with
aggregates (facts) over all rows of its key, of the same form or of another
one. Facts are algebraic, so they are summed up before the shuffle, and a key
that holds a third of all rows costs one row per task. Only keys that ``suspect``
singles out are joined back to the rows, once each, so rows can't multiply; the
join is left to Spark, which broadcasts few keys and splits a hot one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysift.operators.clean import CleanResult, prepare, route, tag
from paysift.operators.forms import FormSpec, Rule


@dataclass(frozen=True)
class GroupRule:
    """Rejects a row if ``test`` holds for it and the facts of its key.

    ``key`` is computed from a row (of the form, and of ``over``); a null key is
    in no group. ``facts`` are named aggregates, ``suspect`` a condition on them
    that ``test`` can't hold without, ``test`` a condition on facts and the row's
    columns (null: the row passes). ``over`` are prepared rows of another form.
    """

    name: str
    key: Callable[[], Column]
    facts: Callable[[], dict[str, Column]]
    suspect: Callable[[], Column]
    test: Callable[[], Column]
    over: DataFrame | None = None


def with_group_rules(prepared: DataFrame, rules: Sequence[GroupRule]) -> tuple[DataFrame, list[Rule]]:
    """The prepared rows with one flag column per rule, and ordinary rules that read the flags."""
    out = prepared
    for rule in rules:
        over = prepared if rule.over is None else rule.over
        key, flag = f"__key_{rule.name}", _flag(rule.name)
        facts = over.select("*", rule.key().alias(key)).groupBy(key).agg(*[c.alias(n) for n, c in rule.facts().items()])
        facts = facts.where(rule.suspect() & F.col(key).isNotNull()).withColumnRenamed(key, key + "_met")
        keyed = out.select("*", rule.key().alias(key))
        met = keyed.join(facts, F.col(key) == F.col(key + "_met"), "left")
        test = F.coalesce(F.col(key + "_met").isNotNull() & rule.test(), F.lit(False))
        out = met.select(*out.columns, test.alias(flag))
    return out, [Rule(r.name, lambda f=_flag(r.name): F.col(f)) for r in rules]


def _flag(name: str) -> str:
    return f"__flag_{name}"


def answers_key(spec: FormSpec, leave_out: Sequence[str] = ()) -> Callable[[], Column]:
    """A 128-bit digest of a row's answers; each is preceded by its length, so no two rows read alike."""

    def key() -> Column:
        texts = [F.coalesce(F.col(n), F.lit("")) for n in spec.names if n not in leave_out]
        return F.md5(F.concat(*[part for t in texts for part in (F.length(t).cast("string"), F.lit(":"), t)]))

    return key


def duplicate_submission(spec: FormSpec, order: str, key: Callable[[], Column] | None = None) -> GroupRule:
    """Rejects all but the first (by ``order``) of the rows that give the same answers.

    Rows that agree in ``order`` as well can't be told apart and stay together.
    """
    return GroupRule(
        name="duplicate_submission",
        key=key or answers_key(spec),
        facts=lambda: {"__rows": F.count("*"), "__first": F.min(order)},
        suspect=lambda: F.col("__rows") > 1,
        test=lambda: F.col(order) > F.col("__first"),
    )


def contradicts(name: str, key: Callable[[], Column], answer: Callable[[], Column], over: DataFrame) -> GroupRule:
    """Rejects a row whose ``answer`` is not the one that all rows of its key in ``over`` give.

    A null answer says nothing: on either side it contradicts no one. A key whose rows
    in ``over`` differ among themselves proves nothing, either.
    """
    low, high = f"__low_{name}", f"__high_{name}"
    return GroupRule(
        name=name,
        key=key,
        facts=lambda: {low: F.min(answer()), high: F.max(answer())},
        suspect=lambda: F.col(low) == F.col(high),
        test=lambda: answer() != F.col(low),
        over=over,
    )


def tag_with_groups(
    raw: DataFrame, spec: FormSpec, group_rules: Sequence[GroupRule], keep: Sequence[str] = (), on_cast_fail: str = "null", extra_rules: Sequence[Rule] = ()
) -> DataFrame:
    """Like ``tag(prepare(raw))``, with the group rules' names after all other reasons."""
    prepared, rules = with_group_rules(prepare(raw, spec, keep), group_rules)
    return tag(prepared, spec, keep, on_cast_fail, [*extra_rules, *rules])


def process_with_groups(raw: DataFrame, spec: FormSpec, group_rules: Sequence[GroupRule], keep: Sequence[str] = (), **modes) -> CleanResult:
    return route(tag_with_groups(raw, spec, group_rules, keep, **modes), spec, keep)
