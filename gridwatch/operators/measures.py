"""Quality checks, trends, anomaly scores and classifier measures as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridwatch.sources.shared import materialize


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row for each column: rows, nulls, min and max as text; one pass."""
    one = df.agg(*[f(F.col(c)).alias(f"{c}__{n}") for c in columns for n, f in (("n", lambda _: F.count(F.lit(1))), ("nulls", lambda x: F.count_if(x.isNull())), ("min", F.min), ("max", F.max))])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("rows"), F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__min").cast("double").alias("min"), F.col(f"{c}__max").cast("double").alias("max")) for c in columns]
    return one.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def integrity(features: DataFrame) -> DataFrame:
    """A row for each rule: rule, issues, status."""
    rules = {
        "duplicate_keys": F.count(F.lit(1)) - F.count_distinct(F.struct("grid_id", "date")),
        "label_without_fires": F.count_if((F.col("fire_occurred") == 1) & (F.col("fire_count") == 0)),
        "fires_without_label": F.count_if((F.col("fire_occurred") == 0) & (F.col("fire_count") > 0)),
        "negative_precipitation": F.count_if(F.col("precipitation_sum") < 0),
        "negative_dry_days": F.count_if(F.col("dry_days_count") < 0),
        "negative_fire_count": F.count_if(F.col("fire_count") < 0),
    }
    one = features.agg(*[c.cast("long").alias(k) for k, c in rules.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("issues"), F.when(F.col(k) == 0, "PASS").otherwise("WARN").alias("status")) for k in rules])))


def monthly_trend(fires: DataFrame) -> DataFrame:
    month = F.trunc("acq_date", "month").alias("month")
    return fires.groupBy(month).agg(F.count(F.lit(1)).alias("points"), F.sum("frp").alias("frp_total")).withColumn("frp_avg", F.col("frp_total") / F.greatest("points", F.lit(1)))


def anomalies(features: DataFrame, z: float = 3.0) -> DataFrame:
    """The latest day's cells against their history: mean, sample deviation (0 for one day), z-score, threshold."""
    latest = features.agg(F.max("date").alias("_last"))
    dated = features.crossJoin(F.broadcast(latest))
    history = dated.filter("date < _last").groupBy("grid_id").agg(F.avg("fire_count").alias("mean"), F.stddev_samp("fire_count").alias("std"), F.count(F.lit(1)).alias("days"))
    today = dated.filter("date = _last").select("grid_id", "date", "fire_count").join(history, "grid_id", "left").fillna(0.0, ["mean", "std"]).fillna(0, ["days"])
    n, mean, std = F.col("fire_count"), F.col("mean"), F.col("std")
    out = today.withColumns({"z_score": F.when(std > 0, (n - mean) / std).otherwise(0.0), "threshold": mean + z * std})
    return out.withColumn("is_anomaly", (n > 0) & (n > F.col("threshold")))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: counts and balanced weights n / (2 * n_class). Refuses data of one class when evaluated."""
    one = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("n1")).withColumn("n0", F.col("n") - F.col("n1"))
    fine = F.when((F.col("n0") == 0) | (F.col("n1") == 0), F.raise_error(F.lit("a class is absent"))).otherwise(F.col("n"))
    return one.select("n0", "n1", (fine / (2 * F.col("n0"))).alias("weight0"), (fine / (2 * F.col("n1"))).alias("weight1"))


def _measures(df: DataFrame) -> DataFrame:
    div = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    out = df.withColumns({"precision": div(tp, tp + fp), "recall": div(tp, tp + fn), "specificity": div(tn, tn + fp), "accuracy": div(tp + tn, tp + tn + fp + fn)})
    return out.withColumn("f1", div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def threshold_curve(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """Confusion counts and measures at each threshold. Scores are first counted by value, so thresholds multiply few rows."""
    values = scores.groupBy("probability").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    cuts = values.select("*", F.explode(F.array(*map(F.lit, thresholds))).alias("threshold"))
    hit = F.col("probability") >= F.col("threshold")
    count = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    return _measures(cuts.groupBy("threshold").agg(count("pos", hit).alias("tp"), count("neg", hit).alias("fp"), count("neg", ~hit).alias("tn"), count("pos", ~hit).alias("fn")))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The row of greatest (f1, recall, -fp)."""
    return curve.agg(F.max_by(F.struct("threshold", "f1", "recall", "fp"), F.struct("f1", "recall", -F.col("fp"))).alias("b")).select("b.*")


def ranges(df: DataFrame, *order) -> DataFrame:
    """The rows with `_part`: ranges of about as many rows each, in order. Written, so that they stay as they were cut."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranges")


def sums_before(ranged: DataFrame, columns: list[str]) -> DataFrame:
    """For each range of `ranges`: the columns' sums (`_<column>`), and those of the ranges before it (`_<column>_off`). One row a range."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    return sums.select("*", *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}_off") for c in columns])


def _above(values: DataFrame, columns: list[str]) -> DataFrame:
    """values (probability, columns) with, for each column, the sum over greater probabilities (`<column>_above`).

    Sums run within ranges of equally many values and are offset by those of the ranges above, so no task holds all
    scores, however close they are.
    """
    ranged = ranges(values, F.desc("probability"))
    within = Window.partitionBy("_part").orderBy(F.desc("probability")).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.join(F.broadcast(sums_before(ranged, columns).select("_part", *[f"_{c}_off" for c in columns])), "_part")
    return summed.withColumns({f"{c}_above": F.coalesce(F.sum(c).over(within), F.lit(0)) + F.col(f"_{c}_off") for c in columns}).drop("_part", *[f"_{c}_off" for c in columns])


def _by_score(scores: DataFrame) -> DataFrame:
    return scores.groupBy("probability").agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("q"), F.count(F.lit(1)).alias("n"))


def at_top_fraction(scores: DataFrame, fraction: float = 0.1) -> DataFrame:
    """Precision and recall among the best k = max(1, round-half-even(n * fraction)), ties by event_id.

    Scores are counted by value and summed from the top; the rows of the score at which k is reached are counted by ranges of
    ids, and only the range in which it is reached is ranked.
    """
    values = _by_score(scores)
    size = values.agg(F.sum("n").alias("rows"), F.sum("p").alias("positives")).withColumn("k", F.greatest(F.lit(1), F.bround(F.col("rows") * fraction, 0).cast("long")))
    ranked = _above(values, ["n"]).crossJoin(F.broadcast(size))
    whole = ranked.filter(F.col("n_above") + F.col("n") <= F.col("k")).agg(F.coalesce(F.sum("p"), F.lit(0)).alias("sure"))
    edge = ranked.filter((F.col("n_above") < F.col("k")) & (F.col("n_above") + F.col("n") > F.col("k"))).select("probability", (F.col("k") - F.col("n_above")).alias("left"))
    # Ranges of ids before the one in which the rest is reached count whole; only that one is ranked.
    tied = ranges(scores.join(F.broadcast(edge), "probability").select("event_id", "left", F.lit(1).alias("n"), (F.col("label") == 1).cast("int").alias("p")), "event_id")
    ends = tied.select("left").distinct().crossJoin(sums_before(tied, ["n", "p"]))
    early = ends.filter("_n_off + _n <= left").agg(F.coalesce(F.sum("_p"), F.lit(0)).alias("early"))
    last = tied.join(F.broadcast(ends.filter("_n_off < left and _n_off + _n > left").select("_part", "_n_off")), "_part").withColumn("_r", F.row_number().over(Window.partitionBy("_part").orderBy("event_id")))
    more = last.filter("_r + _n_off <= left").agg(F.coalesce(F.sum("p"), F.lit(0)).alias("late")).crossJoin(early).select((F.col("early") + F.col("late")).alias("more"))
    hits = F.col("sure") + F.col("more")
    return size.crossJoin(whole).crossJoin(more).select("k", hits.alias("hits"), (hits / F.col("k")).alias("precision"), F.coalesce(F.try_divide(hits, F.col("positives")), F.lit(0.0)).alias("recall"))


def calibration(scores: DataFrame, bins: int = 10) -> DataFrame:
    b = F.least(F.lit(bins - 1), F.greatest(F.lit(0), F.floor(F.col("probability") * bins))).cast("int").alias("bin")
    return scores.groupBy(b).agg(F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_predicted"), F.avg("label").alias("actual_rate"))


def areas(scores: DataFrame) -> DataFrame:
    """One row (auc, auc_pr), from counts by score that are summed from the top once."""
    ranked = _above(_by_score(scores), ["p", "q"])
    roc = F.try_divide(F.sum(F.col("q") * (F.col("p_above") + F.col("p") / 2)), F.sum("p") * F.sum("q"))
    after = (F.col("p_above") + F.col("p")) / (F.col("p_above") + F.col("p") + F.col("q_above") + F.col("q"))
    before = F.coalesce(F.try_divide("p_above", F.col("p_above") + F.col("q_above")), after)
    return ranked.agg(roc.alias("auc"), F.try_divide(F.sum(F.col("p") * (before + after) / 2), F.sum("p")).alias("auc_pr"))


def auc_roc(scores: DataFrame) -> DataFrame:
    """The rank statistic with ties at one half; null without rows of both labels."""
    return areas(scores).select("auc")


def auc_pr(scores: DataFrame) -> DataFrame:
    """The area under precision by recall, as trapezoids between scores, begun at the first one's precision; null without positives."""
    return areas(scores).select("auc_pr")


def evaluation(validation: DataFrame, test: DataFrame, model: str, thresholds: list[float], fraction: float = 0.1) -> DataFrame:
    """One row of measures for a model's scored rows: the threshold is tuned on `validation`, the rest told of `test`."""
    best = best_threshold(threshold_curve(validation, thresholds)).select(F.col("threshold").alias("optimal_threshold"))
    at = threshold_curve(test, thresholds).join(F.broadcast(best), F.col("threshold") == F.col("optimal_threshold"))
    top = at_top_fraction(test, fraction).select("k", F.col("precision").alias("precision_at_k"), F.col("recall").alias("recall_at_k"))
    rank = areas(test).withColumnRenamed("auc", "auc_roc")
    own = areas(validation).select(F.col("auc").alias("validation_auc_roc"), F.col("auc_pr").alias("validation_auc_pr"))
    row = at.crossJoin(rank).crossJoin(own).crossJoin(top).withColumn("model", F.lit(model))
    return row.select(
        "model", "validation_auc_roc", "validation_auc_pr", "auc_roc", "auc_pr", "precision", "recall", "f1", "accuracy", "specificity", "precision_at_k", "recall_at_k", "k", "optimal_threshold",
        F.col("tp").alias("true_positive"), F.col("fp").alias("false_positive"), F.col("tn").alias("true_negative"), F.col("fn").alias("false_negative"),
    )


def compared(rows: DataFrame, targets: dict[str, tuple[str, float]]) -> DataFrame:
    """evaluation's rows with each one's uplift in auc_roc over its own base, whether that meets its own target, and the best by validation.

    targets: model -> (base, least uplift). A model without a target, or whose base is not there, has null for both. The models are few: one row each.
    """
    table = rows.sparkSession.createDataFrame([(m, b, float(x)) for m, (b, x) in targets.items()], "model string, _against string, _least double")
    known = rows.select(F.col("model").alias("_against"), F.col("auc_roc").alias("_base"))
    best = rows.agg(F.max_by("model", F.struct("validation_auc_roc", "model")).alias("_best"))
    out = rows.join(F.broadcast(table), "model", "left").join(F.broadcast(known), "_against", "left").crossJoin(F.broadcast(best))
    out = out.withColumns({"uplift": F.col("auc_roc") - F.col("_base"), "is_best": F.col("model") == F.col("_best")})
    return out.withColumn("target_met", F.col("uplift") >= F.col("_least")).drop("_base", "_best", "_against", "_least")
