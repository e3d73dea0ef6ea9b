"""What dashboards, request handlers and alert senders ask of the tables, as joins and aggregates."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridwatch.functions.grid import fixed_text, severity_rank
from gridwatch.operators.measures import ranges, sums_before

#: Fixed value: degrees that coordinates may have.
WORLD = (-180.0, -90.0, 180.0, 90.0)


def parsed_box(text: Column) -> Column:
    """"min_lon,min_lat,max_lon,max_lat" as a struct with `valid`: four numbers in the world, each least below its most.

    Numbers that can't be read are null; a null text is not valid.
    """
    parts = F.split(text, ",")
    x0, y0, x1, y1 = (F.trim(F.get(parts, k)).try_cast("double") for k in range(4))
    fine = (F.size(parts) == 4) & (x0 < x1) & (y0 < y1) & (x0 >= WORLD[0]) & (x1 <= WORLD[2]) & (y0 >= WORLD[1]) & (y1 <= WORLD[3])
    return F.struct(x0.alias("min_lon"), y0.alias("min_lat"), x1.alias("max_lon"), y1.alias("max_lat"), F.coalesce(fine, F.lit(False)).alias("valid"))


def day_filter(df: DataFrame, day: str, box: tuple[float, float, float, float] | None = None, lat: str = "latitude", lon: str = "longitude", date: str = "date") -> DataFrame:
    """One day's rows, in a box (min_lon, min_lat, max_lon, max_lat; inclusive) if there is one."""
    rows = df.filter(F.col(date) == F.lit(day).cast("date"))
    return rows if box is None else rows.filter(F.col(lon).between(box[0], box[2]) & F.col(lat).between(box[1], box[3]))


def newest(df: DataFrame, order: list[str], limit: int = 1500) -> DataFrame:
    """The `limit` newest rows by the columns of `order`, each descending."""
    return df.orderBy(*map(F.desc, order)).limit(limit)


def risk_kpis(predictions: DataFrame) -> DataFrame:
    """One row: cells, mean score, cells of high risk, latest day."""
    return predictions.agg(F.count_distinct("grid_id").alias("cells"), F.avg("risk_score").alias("mean_score"), F.count_if(F.col("risk_level") == 2).alias("high"), F.max("date").alias("latest"))


def peak_month(trend: DataFrame) -> DataFrame:
    """monthly_trend's rows as one: total points, the month of most (the first of equals) and the mean of months."""
    return trend.agg(F.sum("points").alias("total"), F.max_by("month", F.struct("points", F.datediff(F.lit("9999-12-31").cast("date"), "month"))).alias("peak_month"), F.avg("points").alias("monthly_mean"))


def cluster_summary(clustered: DataFrame) -> DataFrame:
    """Each cluster's points, mean confidence, greatest radiative power (null if none is known), first and last time."""
    return clustered.filter("cluster_id >= 0").groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("point_count"), F.avg("confidence_score").alias("mean_confidence_score"), F.max("frp").alias("max_frp"), F.min("acquired_at").alias("start_time"), F.max("acquired_at").alias("end_time")
    )


def clustering_summary(clustered: DataFrame) -> DataFrame:
    """One row: points, those in clusters, noise, clusters."""
    inside = F.col("cluster_id") >= 0
    return clustered.agg(F.count(F.lit(1)).alias("points"), F.count_if(inside).alias("clustered"), F.count_if(~inside).alias("noise"), F.count_distinct(F.when(inside, F.col("cluster_id"))).alias("clusters"))


def cell_stations(features: DataFrame) -> DataFrame:
    return features.groupBy("grid_id").agg(F.avg("station_distance_km").alias("avg_station_distance_km"), F.avg("weather_points_count").alias("avg_weather_points"))


def delivery_counts(log: DataFrame, times: str | None = None) -> DataFrame:
    """Deliveries of each alert: sent by channel, skipped and failed. A row stands for one delivery, or for as many as `times` tells."""
    n = F.lit(1) if times is None else F.col(times)
    told = lambda hit: F.sum(F.when(hit, n).otherwise(0)).cast("long")
    return log.groupBy("alert_id").agg(
        *[told((F.col("status") == "sent") & (F.col("channel") == c)).alias(c) for c in ("telegram", "email")],
        *[told(F.col("status") == s).alias(s) for s in ("skipped", "failed")],
    )


def partial_update(old: DataFrame, changes: DataFrame, keys: list[str], at: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of `old` with the non-null values of `changes` (one row for a key), and the changes with whether they matched.

    A changed row's updated_at is `at`. Columns that `changes` lacks stay.
    """
    names = [c for c in changes.columns if c not in keys]
    new = changes.select(*keys, F.struct(*names).alias("_new"))
    both = old.join(new, keys, "left")
    stays = lambda c: F.coalesce(F.col(f"_new.{c}"), F.col(c)).alias(c) if c in names else F.col(c)
    columns = [c for c in old.columns if c != "updated_at"]
    before = F.col("updated_at") if "updated_at" in old.columns else F.lit(None).cast("timestamp")
    rows = both.select(*[stays(c) for c in columns], F.when(F.col("_new").isNotNull(), at).otherwise(before).alias("updated_at"))
    held = old.select(*keys).distinct().withColumn("matched", F.lit(True))
    return rows, changes.join(held, keys, "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def subscribed(table: DataFrame, requests: DataFrame, at: Column) -> DataFrame:
    """Rows to append for subscription requests: ids after the table's greatest in order of channel and address, active from `at`.

    Numbers run within ranges of the order and are offset by the ranges before.
    """
    last = table.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    cut = ranges(requests.withColumn("_one", F.lit(1)), "channel", "address")
    number = F.row_number().over(Window.partitionBy("_part").orderBy("channel", "address")) + F.col("_one_off")
    numbered = cut.join(F.broadcast(sums_before(cut, ["_one"]).select("_part", F.col("__one_off").alias("_one_off"))), "_part").withColumn("_n", number)
    return numbered.crossJoin(F.broadcast(last)).withColumns({"id": F.col("_last") + F.col("_n"), "status": F.lit("active"), "created_at": at}).drop("_n", "_last", "_one", "_one_off", "_part")


def subscribe(table: DataFrame, requests: DataFrame, at: Column) -> DataFrame:
    """The table after subscription requests (channel, address, min_severity_rank and, if they have them, the box; one for a channel and address).

    A known subscriber takes the request's rank and box, null ones too, is active again and updated at `at`; others are added.
    """
    keys, taken = ["channel", "address"], [c for c in requests.columns if c not in ("channel", "address")]
    both = table.join(requests.select(*keys, F.struct(*taken).alias("_new")), keys, "left")
    hit = F.col("_new").isNotNull()
    now = lambda c: F.when(hit, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
    before = F.col("updated_at") if "updated_at" in table.columns else F.lit(None).cast("timestamp_ntz")
    kept = both.select(*[now(c) for c in table.columns if c not in ("status", "updated_at")], F.when(hit, "active").otherwise(F.col("status")).alias("status"), F.when(hit, at).otherwise(before).alias("updated_at"))
    new = subscribed(table, requests.join(table.select(keys), keys, "left_anti"), at).drop("created_at")
    return kept.unionByName(new, allowMissingColumns=True)


def with_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Each row with itself as JSON text, nulls included: what a serving table keeps beside its columns."""
    return df.withColumn(payload, F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}))


def weather_means(predictions: DataFrame, columns: tuple[str, ...] = ("temperature_2m_max", "relative_humidity_2m_min", "wind_speed_10m_max", "precipitation_sum")) -> DataFrame:
    """A row for each column: its mean over rows that have a value."""
    one = predictions.agg(*[F.avg(c).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("mean")) for c in columns])))


def active_fires(fires: DataFrame, day: str, box: tuple[float, float, float, float], least_confidence: float) -> DataFrame:
    """One row: a day's fires in a box of a confidence or more, and their mean radiative power."""
    of_day = day_filter(fires, day, box, date="acq_date").filter(F.col("confidence_score") >= least_confidence)
    return of_day.agg(F.count(F.lit(1)).alias("active_fires"), F.avg("frp").alias("mean_frp"))


def anomaly_counts(found: DataFrame) -> DataFrame:
    """Cell days by whether they are anomalies."""
    return found.groupBy("is_anomaly").agg(F.count(F.lit(1)).alias("grid_days"))


def served_rows(predictions: DataFrame) -> DataFrame:
    """One row: how many predictions are served."""
    return predictions.agg(F.count(F.lit(1)).alias("cached_predictions"))


def known_dates(*tables: tuple[DataFrame, str]) -> DataFrame:
    """The distinct dates of several tables' columns, each table's own first."""
    dates = [df.select(F.col(c).cast("date").alias("date")).filter("date is not null").distinct() for df, c in tables]
    return reduce(DataFrame.unionByName, dates).distinct()


def complete(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows in which all required columns have a value that is not an empty text."""
    for c in required:
        df = df.filter(F.col(c).isNotNull() & (F.col(c).cast("string") != ""))
    return df


def ranked(df: DataFrame, column: str) -> DataFrame:
    """df with severity_rank of the column's words or numbers, and `rejected` where a value has none; null is not rejected."""
    rank = severity_rank(F.col(column))
    return df.withColumns({"severity_rank": rank, "rejected": F.col(column).isNotNull() & rank.isNull()})


def parsed_alerts(messages: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """The JSON objects of `value`, and `rejected`: no JSON object, or one without alert_id. Null texts are rejected.

    Rejects stay as rows, so that both kinds are counted in one pass; filter on `rejected` to send on the rest.
    """
    told = messages.select(F.from_json(value, schema).alias("m")).select("m.*")
    return told.withColumn("rejected", F.coalesce(F.col("alert_id") == "", F.lit(True)))


#: The words of a message, for a forecast and for a hot zone.
HEADINGS = {"subject": "Wildfire alert (%s): grid %s", "forecast": "Wildfire forecast: %s risk on %s", "zone": "Wildfire alert: %s severity hot zone"}
OPT_OUT = "You receive this because you subscribed to wildfire alerts. Reply STOP or use the unsubscribe command on the Telegram bot to opt out."
CHAT_END = "Reply /status for the latest 5 alerts in your region, /unsubscribe to stop."
CAPTION_LENGTH = 1024


def rendered(alerts: DataFrame) -> DataFrame:
    """alert_id with `subject` and `body` of a mail, `caption` of a picture and the longer `chat` text, for forecasts and hot zones.

    Needs the columns of normalized_alerts and forecast_date, threshold, window_start, window_end, map_url. Lines
    of null values are left out; a caption has CAPTION_LENGTH characters at most.
    """
    forecast = F.col("alert_type") == "FORECAST_RISK"
    word = F.upper("severity_label")
    line = lambda form, *c: F.when(reduce(and_, [F.col(x).isNotNull() for x in c]), F.format_string(form, *c))
    place = F.concat(fixed_text("latitude", 4), F.lit(", "), fixed_text("longitude", 4))
    score = F.when(forecast, fixed_text("risk_score", 2))
    counts = F.when(~forecast, line("Fire count: %d (threshold %d)", "fire_count", "threshold"))
    window = F.when(~forecast, line("Window: %s -> %s", "window_start", "window_end"))
    head = F.when(forecast, F.format_string(HEADINGS["forecast"], word, "forecast_date")).otherwise(F.format_string(HEADINGS["zone"], word))
    said = lambda name, c: F.concat(F.lit(name), c)  # noqa: E731  null where c is
    lines = [
        said("Grid: ", F.col("grid_id")), said("Location: ", place), F.when(forecast, said("Forecast date: ", F.col("forecast_date"))), said("Risk score: ", score), counts, window,
        said("Alert ID: ", F.col("alert_id")), said("Map preview: ", F.col("map_url")),
    ]
    shown = [
        F.when(forecast, said("🛰️ <b>Wildfire Forecast: ", F.concat(word, F.lit("</b>")))).otherwise(said("🔥 <b>Wildfire Alert: ", F.concat(word, F.lit("</b>")))), F.lit(""),
        said("📍 Grid: <code>", F.concat("grid_id", F.lit("</code>"))), said("🧭 ", place), F.when(forecast, said("📅 Forecast date: ", F.col("forecast_date"))), said("📈 Risk score: ", score),
        F.when(~forecast, line("🔥 Fires: %d (>%d / %s → %s)", "fire_count", "threshold", "window_start", "window_end")), said("🆔 <code>", F.concat("alert_id", F.lit("</code>"))),
    ]
    chat = [
        *shown[:3], said("🧭 Location: ", place), *shown[4:6], F.when(~forecast, line("🔥 Fire count: %d (threshold: %d)", "fire_count", "threshold")), F.when(~forecast, line("🕐 Window: %s → %s", "window_start", "window_end")),
        said("🆔 Alert ID: <code>", F.concat("alert_id", F.lit("</code>"))), F.coalesce(said("🗺️ Map: ", F.col("map_url")), F.lit("")), F.lit(""), F.lit(CHAT_END), F.lit(""),
    ]
    return alerts.select(
        "alert_id", F.format_string(HEADINGS["subject"], word, "grid_id").alias("subject"), F.concat_ws("\n", head, F.lit(""), *lines, F.lit(""), F.lit(OPT_OUT)).alias("body"),
        F.left(F.concat_ws("\n", *shown), F.lit(CAPTION_LENGTH)).alias("caption"), F.concat_ws("\n", *chat).alias("chat"),
    )


def ring_centre(ring: Column) -> Column:
    """The mean of a ring's vertices (lon, lat pairs; incomplete ones left out) as a struct (lat, lon); null without any."""
    whole = F.filter(ring, lambda p: F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())
    mean = lambda k: F.try_divide(F.aggregate(whole, F.lit(0.0), lambda s, p: s + F.get(p, F.lit(k))), F.size(whole))
    return F.when(F.size(whole) > 0, F.struct(mean(1).alias("lat"), mean(0).alias("lon")))


def normalized_alerts(alerts: DataFrame, size: float = 0.5) -> DataFrame:
    """Alerts of either kind in one shape: place (their own, else the cell's centre), severity word and rank, counts, map link.

    Absent kinds are HOT_ZONE, absent severities the risk label or else high; unknown words rank as high.
    """
    have = lambda c, kind: F.col(c) if c in alerts.columns else F.lit(None).cast(kind)
    text = lambda c: F.when(have(c, "string") != "", have(c, "string"))
    own = have("latitude", "double").isNotNull() & have("longitude", "double").isNotNull()
    centre = lambda c: (have(c, "int") + 0.5) * size
    lat = F.when(own, have("latitude", "double")).otherwise(centre("grid_lat_index"))
    lon = F.when(own, have("longitude", "double")).otherwise(centre("grid_lon_index"))
    severity = F.lower(F.coalesce(text("severity"), text("risk_label"), F.lit("high")))
    rank = F.when(severity == "low", 0).when(severity == "medium", 1).otherwise(2)
    cell = F.concat_ws("_", have("grid_lat_index", "int").cast("string"), have("grid_lon_index", "int").cast("string"))
    out = alerts.select(
        F.coalesce(text("alert_id"), F.lit("")).alias("alert_id"), F.coalesce(text("alert_type"), F.lit("HOT_ZONE")).alias("alert_type"), severity.alias("severity_label"), rank.alias("severity_rank"),
        F.coalesce(text("grid_id"), cell).alias("grid_id"), F.coalesce(have("fire_count", "int"), F.lit(0)).alias("fire_count"), have("risk_score", "double").alias("risk_score"), lat.alias("latitude"), lon.alias("longitude"),
    )
    place = lambda c: F.col(c).cast("string")
    link = F.concat(F.lit("https://www.openstreetmap.org/?mlat="), place("latitude"), F.lit("&mlon="), place("longitude"), F.lit("#map=10/"), place("latitude"), F.lit("/"), place("longitude"))
    return out.withColumn("map_link", link)


def presented(df: DataFrame, names: dict[str, str], words: list[str], numbers: list[str], digits: int = 3) -> DataFrame:
    """The columns of `names` under their new names; words in title case, numbers rounded."""
    shown = lambda c: F.initcap(c) if c in words else F.round(c, digits) if c in numbers else F.col(c)
    return df.select(*[shown(c).alias(new) for c, new in names.items()])


def station_fan_out(assigned: DataFrame, daily: DataFrame) -> DataFrame:
    """Each point (point_id, latitude, longitude, station_id, station_distance_km) with its station's days."""
    weather = ["temperature_2m_max", "relative_humidity_2m_min", "wind_speed_10m_max", "precipitation_sum"]
    return assigned.join(daily.select("station_id", "date", *weather), "station_id").select("point_id", "latitude", "longitude", "station_id", "station_distance_km", "date", *weather)
