"""Grid and scalar column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_KM = 6371.0088
#: Words and letters for a detection's confidence.
CONFIDENCE = {"high": 100, "h": 100, "nominal": 50, "n": 50, "medium": 50, "low": 0, "l": 0}
DASHBOARD_CONFIDENCE = {"l": 30, "n": 60, "h": 90}


@dataclass(frozen=True)
class Grid:
    """Square cells of `size` degrees; a cell has its lower and left edges."""

    size: float = 0.5

    def with_cells(self, df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
        """Adds grid_id, grid_lat_index, grid_lon_index and the corner grid_lat, grid_lon."""
        i, j = (F.floor(F.col(c) / F.lit(self.size)).cast("int") for c in (lat, lon))
        return df.withColumns({"grid_lat_index": i, "grid_lon_index": j}).withColumns(
            {
                "grid_id": F.concat_ws("_", F.col("grid_lat_index").cast("string"), F.col("grid_lon_index").cast("string")),
                "grid_lat": F.round(F.col("grid_lat_index") * self.size, 6),
                "grid_lon": F.round(F.col("grid_lon_index") * self.size, 6),
            }
        )

    def centre(self, index: str) -> Column:
        return F.round((F.col(index) + 0.5) * self.size, 5)

    def envelope(self, lat: str = "grid_lat", lon: str = "grid_lon") -> Column:
        """The closed ring of a cell as an array of (lon, lat)."""
        x, y = F.col(lon), F.col(lat)
        at = lambda a, b: F.array(a, b)
        return F.array(at(x, y), at(x + self.size, y), at(x + self.size, y + self.size), at(x, y + self.size), at(x, y))


def confidence_score(column: str, words: dict[str, int] = CONFIDENCE) -> Column:
    """Words and letters by the map, numbers as they are, anything else null."""
    text = F.lower(F.trim(F.col(column)))
    said = reduce(lambda w, kv: w.when(text == kv[0], F.lit(float(kv[1]))), list(words.items())[1:], F.when(text == next(iter(words)), F.lit(float(next(iter(words.values()))))))
    return said.when(text.rlike(r"^[0-9]+(\.[0-9]+)?$"), text.try_cast("double"))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(a))


def time_features(date: str = "date") -> dict[str, Column]:
    """Month and day of the year as doubles, and both as turns of a circle; the names are fixed values."""
    m, d = F.month(date).cast("double"), F.dayofyear(date).cast("double")
    turn = lambda x, n: 2 * F.pi() * x / n
    return {"month": m, "dayofyear": d, "month_sin": F.sin(turn(m, 12)), "month_cos": F.cos(turn(m, 12)), "dayofyear_sin": F.sin(turn(d, 366)), "dayofyear_cos": F.cos(turn(d, 366))}


def acquired_at(date: str, hhmm: str) -> Column:
    """Timestamp of a date and an HHMM number; a bad time counts as midnight."""
    t = F.lpad(F.coalesce(F.col(hhmm), F.lit(0)).cast("string"), 4, "0")
    day = F.date_format(date, "yyyy-MM-dd")
    return F.coalesce(F.try_to_timestamp(F.concat_ws(" ", day, t), F.lit("yyyy-MM-dd HHmm")), F.col(date).cast("timestamp"))


def acquired_or_null(date: str, hhmm: str) -> Column:
    """As `acquired_at`, but null where the date or the time can't be read; a missing time is midnight."""
    t = F.lpad(F.trim(F.coalesce(F.col(hhmm).cast("string"), F.lit("0000"))), 4, "0")
    return F.try_to_timestamp(F.concat_ws(" ", F.date_format(F.col(date).try_cast("date"), "yyyy-MM-dd"), t), F.lit("yyyy-MM-dd HHmm"))


def risk_level(score: Column, medium: float = 0.33, high: float = 0.75) -> Column:
    return F.when(score >= high, 2).when(score >= medium, 1).otherwise(0)


def risk_label(level: Column) -> Column:
    return F.when(level == 2, "high").when(level == 1, "medium").when(level == 0, "low")


def severity_rank(column: Column) -> Column:
    """0, 1, 2 from numbers or words; anything else null."""
    text = F.lower(F.trim(column.cast("string")))
    return F.when(text.isin("0", "low"), 0).when(text.isin("1", "medium"), 1).when(text.isin("2", "high"), 2)


def composite_date(name: Column) -> Column:
    """The date in a raster's file name: 20YYMMDD, else doyYYYYDDD; null for none and for a bad date."""
    plain = F.regexp_extract(name, r"(?<![0-9])(20[0-9]{6})", 1)
    year, day = (F.regexp_extract(name, r"(?i)doy(20[0-9]{2})([0-9]{3})", k).try_cast("int") for k in (1, 2))
    return F.when(plain != "", F.try_to_timestamp(plain, F.lit("yyyyMMdd")).cast("date")).otherwise(F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day - 1))


def safe_name(column: Column) -> Column:
    return F.regexp_replace(column, r"[^A-Za-z0-9_.-]+", "_")


def byte_text(n: Column) -> Column:
    """A size with one decimal, from B to GB; ties go to the even digit. Null stays null."""
    size = lambda unit, name: F.format_string(f"%.1f {name}", F.bround(n / unit, 1))
    return F.when(n < 1 << 10, size(1, "B")).when(n < 1 << 20, size(1 << 10, "KB")).when(n < 1 << 30, size(1 << 20, "MB")).when(n.isNotNull(), size(1 << 30, "GB"))


def fixed_text(name: str, digits: int) -> Column:
    """A double's text with so many digits, rounded as the exact value of its bits says, as printf does in C; ties go to the even digit.

    Java rounds the shortest text instead: 0.975, whose bits lie below it, would be 0.98. The value is cut into halves whose products
    with a power of ten are exact, so what is left over the half digit has the right sign. Beyond 2^40 Java's text stands.
    """
    x, scale = F.col(name).cast("double"), F.lit(10.0**digits)
    y = F.abs(x)
    high = y * 134217729.0 - (y * 134217729.0 - y)
    below = F.floor(y * scale)
    over = (high * scale - (below + 0.5)) + (y - high) * scale
    up = F.when((over > 0) | ((over == 0) & (below % 2 == 1)), 1).otherwise(0)
    shown = F.when(y < 2.0**40, F.signum(x) * ((below + up) / scale)).otherwise(x)
    return F.when(x.isNotNull(), F.format_string(f"%.{digits}f", shown))
