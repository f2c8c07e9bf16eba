"""Data dictionary standardisation (X3): map raw values to agreed ones.

The dictionary is reduced to one value per key first (a deterministic pick,
so a duplicated key cannot multiply rows). How it is joined is left to Spark:
AQE broadcasts it when its measured size is below
``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits a hot key of a
shuffle join otherwise.

:func:`standardise` takes exact keys, :func:`standardise_inexact` keys within an
edit distance, :func:`standardise_as_of` keys whose values change over time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A piece that more keys share is not looked up by itself (see :func:`closest_keys`).
MANY = 256


def standardise(
    df: DataFrame,
    dictionary: DataFrame,
    on: str,
    key: str,
    value: str,
    out: str | None = None,
) -> DataFrame:
    """Left-join ``df.on`` to ``dictionary.key``; ``out`` takes the dictionary
    value, or the original value (as text of the same type) when no key matches."""
    std = "__std_value"
    d = dictionary.groupBy(F.col(key).alias("__std_key")).agg(F.min(value).alias(std))
    value_type = dictionary.schema[value].dataType
    joined = df.join(d, df[on] == d["__std_key"], "left")
    keep = [df[c] for c in df.columns if c != (out or on)]
    return joined.select(*keep, F.coalesce(d[std], df[on].cast(value_type)).alias(out or on))


# ---- keys within an edit distance --------------------------------------------------------


def _piece(size: Column, i: Column, pieces: int) -> tuple[Column, Column]:
    """(start from 0, length) of piece ``i`` of a key of ``size`` letters cut into ``pieces``."""
    start = F.floor(size * i / pieces)
    return start.cast("int"), (F.floor(size * (i + 1) / pieces) - start).cast("int")


def _range(low: int, high: int) -> Column:
    return F.explode(F.array(*[F.lit(i) for i in range(low, high + 1)]))


def _shorter(rows: DataFrame, letters: int) -> DataFrame:
    """Rows whose ``text`` lost ``letters`` letters, in every way that gives another text (a shorter text is
    then empty). Of a run of equal letters the last one goes, and letters go from left to right."""
    out = rows.withColumn("first", F.lit(1))
    for _ in range(letters):
        n = F.length("text")
        out = out.withColumn("at", F.explode(F.when(n > 0, F.sequence("first", n)).otherwise(F.array(F.lit(0)))))
        out = out.where("at = length(text) or substring(text, at, 1) <> substring(text, at + 1, 1)")
        left = F.when(F.col("at") == 0, "").otherwise(F.expr("concat(substring(text, 1, at - 1), substring(text, at + 1))"))
        out = out.withColumn("text", left).withColumn("first", F.greatest(F.col("at") - 1, F.lit(1)))
    return out


def _by_letters_left(rows: DataFrame, name: str, lost: Column, distance: int) -> DataFrame:
    """(name, left): a hash of each text that is left of ``name`` when it loses ``lost`` letters, with its size and ``longer``."""
    rows = rows.withColumn("text", F.col(name)).withColumn("lost", lost)
    levels = [_shorter(rows.where(F.col("lost") == n), n).select(name, F.xxhash64("size", "longer", "text").alias("left")) for n in range(distance + 1)]
    return reduce(DataFrame.unionByName, levels)


def closest_keys(values: DataFrame, keys: DataFrame, distance: int, many: int = MANY) -> DataFrame:
    """(value, key, distance): for each of the distinct ``values`` (value) within ``distance``
    edits of any of the distinct ``keys`` (key), the nearest key; ties: the smallest.

    Blocks lose no pair: a key is cut into distance + 1 pieces. So many edits
    touch at most ``distance`` of them, so one piece stands unchanged in the
    value, moved by the insertions and deletions before it: by ``distance``
    places at most. A value is therefore looked up with its substrings at all
    these places, for every key length within reach, in an equi-join on (key
    length, piece number, piece); each pair met is then measured.

    A piece that more than ``many`` keys share (``Custom`` of ``Customer#000000123``)
    would meet all of them. Values and keys with such a piece meet by the letters that
    edits leave instead: if a key is ``longer`` than a value by d letters (d may be
    negative) and within k edits of it, some text is left both when the key loses
    k + min(d, 0) letters and when the value loses k - max(d, 0). That join is exact
    too, and meets few pairs but near ones.
    """
    pieces = distance + 1
    dealt = keys.select("key", F.length("key").alias("size"), _range(0, distance).alias("i"))
    start, length = _piece(F.col("size"), F.col("i"), pieces)
    dealt = dealt.select("key", "size", "i", F.substring("key", start + 1, length).alias("piece"))

    asked = values.select("value", _range(-distance, distance).alias("longer")).select("value", "longer", (F.length("value") + F.col("longer")).alias("size"))
    asked = asked.where("size >= 0").select("value", "longer", "size", _range(0, distance).alias("i")).select("*", _range(-distance, distance).alias("moved"))
    start, length = _piece(F.col("size"), F.col("i"), pieces)
    at = start + F.col("moved")
    asked = asked.where((at >= 0) & (at + length <= F.length("value"))).select("value", "longer", "size", "i", F.substring("value", at + 1, length).alias("piece")).distinct()

    on = ["size", "i", "piece"]
    shared = dealt.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > many).drop("n")
    rare = asked.join(shared, on, "left_anti").join(dealt, on).select("value", "key")

    common = asked.join(shared, on, "left_semi").select("value", "size", "longer").distinct()
    reached = dealt.join(shared, on, "left_semi").select("key", "size").distinct().join(common.select("size", "longer").distinct(), "size")
    zero, longer = F.lit(0), F.col("longer")
    near = _by_letters_left(common, "value", distance - F.greatest(longer, zero), distance).join(
        _by_letters_left(reached, "key", distance + F.least(longer, zero), distance), "left"
    )

    met = rare.unionByName(near.select("value", "key")).select("value", "key", F.levenshtein("value", "key", distance).alias("distance"))
    best = met.where("distance >= 0").groupBy("value").agg(F.min(F.struct("distance", "key")).alias("one"))
    return best.select("value", F.col("one.key").alias("key"), F.col("one.distance").alias("distance"))


def standardise_inexact(
    df: DataFrame, dictionary: DataFrame, on: str, key: str, value: str, distance: int = 1, out: str | None = None
) -> DataFrame:
    """Like :func:`standardise`, but a value without its own key takes the nearest key
    within ``distance`` edits (ties: the smallest key); others stay as they are.

    Distinct values are matched, not rows, so a value that a third of all rows
    share is looked up once. Null values stay null.
    """
    d = dictionary.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(value).alias("std"))
    found = closest_keys(df.select(F.col(on).alias("value")).where("value is not null").distinct(), d.select("key"), distance)
    names = found.join(d, "key").select(F.col("value").alias("raw"), "std")
    return standardise(df, names, on, "raw", "std", out)


# ---- keys whose values change over time ---------------------------------------------------


def standardise_as_of(
    df: DataFrame, dictionary: DataFrame, on: str, at: str, key: str, value: str, valid_from: str, out: str, bin_days: int = 90
) -> DataFrame:
    """``out`` is the dictionary value of ``on`` that is valid at the time ``at``: that of the
    latest ``valid_from`` not after it; null if there is none (or on, at is null).

    Of several values with one key and time the smallest counts. A version ends
    where the next one of its key begins. Ended versions are written to each
    bin of ``bin_days`` days that they touch and met by key and bin, so a hot key
    is spread over the bins; a key's last version has no end and is met by key
    alone. Both are equi-joins, no range is compared across keys, and a row
    meets one version at most.
    """
    versions = dictionary.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).groupBy(F.col(key).alias("__key"), F.col(valid_from).alias("__from")).agg(F.min(value).alias("__value"))
    versions = versions.withColumn("__to", F.lead("__from").over(W.partitionBy("__key").orderBy("__from")))

    def bin_of(c: str) -> Column:
        return F.floor(F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")) / bin_days)

    ended = versions.where("__to is not null").withColumn("__bin", F.explode(F.sequence(bin_of("__from"), bin_of("__to"))))
    last = versions.where("__to is null").select(F.col("__key").alias("__last_key"), F.col("__from").alias("__last_from"), F.col("__value").alias("__last_value"))
    rows = df.select("*", bin_of(at).alias("__at_bin"))
    met = rows.join(ended, (F.col(on) == F.col("__key")) & (F.col("__at_bin") == F.col("__bin")) & (F.col(at) >= F.col("__from")) & (F.col(at) < F.col("__to")), "left")
    met = met.join(last, (F.col(on) == F.col("__last_key")) & (F.col(at) >= F.col("__last_from")), "left")
    keep = [F.col(c) for c in df.columns if c != out]
    return met.select(*keep, F.coalesce("__value", "__last_value").alias(out))
