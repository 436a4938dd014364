"""Exact continuous quantiles (linear interpolation, NULLs ignored) at any group size.

Spark's built-in ``percentile`` keeps a value->count map per group and merges
it in one task, so one hot group (a feed with most of the rows) would hold
every distinct value in one task. Here a histogram guides the selection:

1. one scan counts rows per distinct (group, value), combined map-side, and
   stores the counts once, with the value's bin. A bin is a whole number that
   never falls as the value grows, the same for every group and known
   beforehand (steps of the logarithm), so nothing has to be sampled, ranged
   or sorted to find it;
2. the histogram, rows per (group, bin), is a sum of the counts: a few hundred
   rows a group. Running sums over a group's bins place the wanted ranks
   (floor and ceil of p*(n-1)) in bins; all other bins are done with;
3. a bin that holds a rank and more than ``slice_values`` distinct values is
   cut again, into ``SPLITS`` equal steps between its least and largest value,
   until every such bin is small;
4. a running count inside each such bin finds the value at each rank: no more
   than ``slice_values`` values are ever sorted together, whatever the group;
5. interpolate between the two ranks as Spark's ``percentile`` does.

A group without any value (all NULL) has NULL quantiles and a NULL mean. NaN
is larger than any number, as everywhere in Spark. Results equal ``percentile``;
``quantile_cont`` agrees to the last binary digit or two.
"""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabflow.session import remove, work_dir

SLICE_VALUES = 500_000
STEPS = 64  # bins for each factor of e
SPLITS = 1024
_BEYOND = 1 << 40  # bins of the infinities and of NaN


def value_bin(v: Column) -> Column:
    """A whole number that does not fall as ``v`` grows; infinities and NaN have bins of their own."""
    step = F.floor(F.log1p(F.abs(v)) * STEPS)
    return (
        F.when(F.isnan(v), _BEYOND + 1)
        .when(F.abs(v) == float("inf"), F.when(v > 0, _BEYOND).otherwise(-_BEYOND))
        .when(v < 0, -step)
        .otherwise(step)
        .cast("long")
    )


def _histogram(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct values and ends of each bin, and the number of rows before it in its group (or cut bin)."""
    bins = counts.groupBy(*keys, "_bin").agg(
        F.sum("_n").alias("_n"),
        F.count("_v").alias("_d"),
        F.min("_v").alias("_low"),
        F.max("_v").alias("_high"),
        F.sum(F.col("_v") * F.col("_n")).alias("_sum"),
    )
    return bins.withColumn("_before", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bin")) - F.col("_n"))


def _holds(before: Column) -> Column:
    return (F.col("_rank") >= before) & (F.col("_rank") < before + F.col("_n"))


def _sorted_values(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The only values that are sorted: those in bins that hold a rank."""
    return counts.join(wanted.select("_g", "_bin").distinct(), ["_g", "_bin"], "left_semi")


def exact_quantiles(
    df: DataFrame,
    group_cols: list[str],
    value_col: str,
    probs: list[float],
    slice_values: int = SLICE_VALUES,
) -> DataFrame:
    """Return ``(group_cols..., prob, value, mean)``: the exact quantiles and the mean of each group."""
    # A group is one struct, so that NULLs in its columns join as equal.
    group = F.struct(*[F.col(c) for c in group_cols]).alias("_g")
    values = df.select(group, F.col(value_col).cast("double").alias("_v"))
    return quantiles_of_counts(values.groupBy("_g", "_v").agg(F.count("_v").alias("_n")), probs, slice_values)


def quantiles_of_counts(counted: DataFrame, probs: list[float], slice_values: int = SLICE_VALUES) -> DataFrame:
    """``exact_quantiles`` of rows counted per distinct value: ``(_g, _v, _n)``, the group a struct of its columns."""
    spark = counted.sparkSession
    group_cols = counted.schema["_g"].dataType.names
    base = work_dir(spark, f"quantiles/{uuid.uuid4().hex}")
    prob_list = [float(p) for p in probs]

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{base}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{base}/{name}")

    counts = kept(counted.withColumn("_bin", F.array(value_bin(F.col("_v")))), "counts")
    bins = kept(_histogram(counts, ["_g"]), "histogram")
    totals = bins.groupBy("_g").agg(
        F.sum("_n").alias("_total"), F.try_divide(F.sum("_sum"), F.sum("_n")).alias("mean")
    )
    last = F.col("_total") - 1
    targets = (
        totals.select("_g", "_total", "mean", F.explode(F.array(*[F.lit(p) for p in prob_list])).alias("prob"))
        .withColumn("_pos", F.when(F.col("_total") > 0, F.col("prob") * last.cast("double")))
        .withColumn("_lo", F.floor("_pos").cast("long"))
        .withColumn("_hi", F.ceil("_pos").cast("long"))
    )
    ranks = targets.select("_g", F.explode(F.array("_lo", "_hi")).alias("_rank")).filter("_rank IS NOT NULL").distinct()
    found_in = ["_g", "_bin", "_rank", "_before", "_d", "_low", "_high"]
    wanted = kept(ranks.join(bins, "_g").where(_holds(F.col("_before"))).select(*found_in), "wanted-0")
    rounds = 0
    while not wanted.filter(F.col("_d") > slice_values).isEmpty():
        rounds += 1
        large = F.col("_d") > slice_values
        cut = F.floor(F.try_divide(F.col("_v") - F.col("_low"), F.col("_high") - F.col("_low")) * SPLITS).cast("long")
        cuts = wanted.select("_g", "_bin", "_d", "_low", "_high").distinct()
        finer = counts.join(cuts, ["_g", "_bin"]).select(
            "_g", F.col("_bin").alias("_in"), F.when(large, F.concat("_bin", F.array(cut))).otherwise(F.col("_bin")).alias("_bin"), "_v", "_n"
        )
        counts = kept(finer, f"counts-{rounds}")
        outer = wanted.select("_g", F.col("_bin").alias("_in"), "_rank", F.col("_before").alias("_outer"))
        inner = outer.join(_histogram(counts, ["_g", "_in"]), ["_g", "_in"]).withColumn("_before", F.col("_outer") + F.col("_before"))
        wanted = kept(inner.where(_holds(F.col("_before"))).select(*found_in), f"wanted-{rounds}")
        counts = counts.drop("_in")

    within = Window.partitionBy("_g", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = _sorted_values(counts, wanted).withColumn("_cum", F.sum("_n").over(within))
    hits = (
        cum.join(wanted.select("_g", "_bin", "_rank", "_before"), ["_g", "_bin"])
        .where(_holds(F.col("_before") + F.col("_cum") - F.col("_n")))
        .select("_g", "_rank", "_v")
    )
    lo = hits.withColumnRenamed("_rank", "_lo").withColumnRenamed("_v", "_vlo")
    hi = hits.withColumnRenamed("_rank", "_hi").withColumnRenamed("_v", "_vhi")
    # Spark's own interpolation, so the result equals ``percentile`` bit for bit.
    same = (F.col("_lo") == F.col("_hi")) | (F.col("_vlo") == F.col("_vhi"))
    value = F.when(same, F.col("_vlo")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - F.col("_lo")) * F.col("_vhi")
    )
    found = targets.join(lo, ["_g", "_lo"], "left").join(hi, ["_g", "_hi"], "left")
    names = [F.col("_g")[c].alias(c) for c in group_cols]
    result = found.select(*names, "prob", value.alias("value"), "mean").coalesce(1).checkpoint()  # groups x probabilities rows
    remove(spark, base)
    return result


# Measures reported by the quantile queries (output prefix, source column).
MEASURES = (("distance", "trip_distance"), ("duration", "duration_minutes"), ("total", "total_amount"))


def _stacked(valid: DataFrame) -> DataFrame:
    """One (taxi_type, measure, value) row per trip and measure: one pass for all three."""
    items = [
        F.struct(F.lit(name).alias("measure"), F.col(src).cast("double").alias("value")) for name, src in MEASURES
    ]
    return valid.select("taxi_type", F.explode(F.array(*items)).alias("_m")).select(
        "taxi_type", "_m.measure", "_m.value"
    )


def _label(prob: float) -> str:
    """``p50``, ``p99``, ``p99_5``: the probability in percent, every digit of it."""
    percent = format(Decimal(str(prob)) * 100, "f")
    percent = percent.rstrip("0").rstrip(".") if "." in percent else percent
    return "p" + percent.replace(".", "_")


def quantiles(valid: DataFrame, probs: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """Per taxi type: one scalar column per measure and probability (``distance_p50`` ...)."""
    return _wide(exact_quantiles(_stacked(valid), ["taxi_type", "measure"], "value", list(probs)), probs)


def quantiles_of(counts: DataFrame, probs: tuple[float, ...] = (0.5, 0.99)) -> DataFrame:
    """``quantiles`` from (taxi_type, measure, value, n): how many valid trips have each value."""
    counted = counts.select(
        F.struct("taxi_type", "measure").alias("_g"),
        F.col("value").alias("_v"),
        F.when(F.col("value").isNotNull(), F.col("n")).otherwise(F.lit(0)).cast("long").alias("_n"),
    )
    return _wide(quantiles_of_counts(counted, list(probs)), probs)


def _wide(q: DataFrame, probs: tuple[float, ...]) -> DataFrame:
    labels = {p: _label(p) for p in probs}
    name = F.concat(F.col("measure"), F.lit("_"), F.create_map(*[x for p, l in labels.items() for x in (F.lit(p), F.lit(l))])[F.col("prob")])
    cols = [f"{m}_{labels[p]}" for m, _ in MEASURES for p in probs]
    return q.withColumn("_name", name).groupBy("taxi_type").pivot("_name", cols).agg(F.first("value")).orderBy("taxi_type")


def quantiles_list(valid: DataFrame, probs: tuple[float, ...] = (0.5, 0.9, 0.99)) -> DataFrame:
    """Per taxi type: one array per measure, ordered like ``probs``."""
    q = exact_quantiles(_stacked(valid), ["taxi_type", "measure"], "value", list(probs))
    arr = F.transform(F.array_sort(F.collect_list(F.struct("prob", "value"))), lambda s: s["value"])
    per_measure = q.groupBy("taxi_type", "measure").agg(arr.alias("values"))
    return per_measure.groupBy("taxi_type").pivot("measure", [m for m, _ in MEASURES]).agg(
        F.first("values")
    ).select("taxi_type", *[F.col(m).alias(f"{m}_quantiles") for m, _ in MEASURES])
