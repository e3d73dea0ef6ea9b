"""Geographic views over the star-schema tables, in SQL that Spark and DuckDB both take (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("events", "lineitem", "orders", "supplier", "customer")

VIEWS = {
    "fires_raw": """
SELECT CASE CAST(e.event_id % 3 AS INT) WHEN 0 THEN 'VIIRS_NOAA20_SP' WHEN 1 THEN 'VIIRS_SNPP_SP' ELSE 'MODIS_SP' END AS firms_source,
       CAST(8 AS DOUBLE) + CAST((e.user_id * 91) % 960 AS DOUBLE) / 64 AS latitude,
       CAST(102 AS DOUBLE) + CAST((e.user_id * 37) % 512 AS DOUBLE) / 64 AS longitude,
       CAST(e.ts AS DATE) AS acq_date, CAST(hour(e.ts) * 100 + minute(e.ts) AS INT) AS acq_time,
       'N' AS satellite, 'VIIRS' AS instrument,
       CASE e.event_type WHEN 'click' THEN 'l' WHEN 'view' THEN ' Nominal ' WHEN 'purchase' THEN 'h'
            WHEN 'signup' THEN CAST(e.event_id % 101 AS STRING) ELSE 'bad' END AS confidence,
       e.value AS frp, e.ts AS acquired_at, e.event_id
FROM {events} e JOIN (SELECT 1 AS c UNION ALL SELECT 2 AS c) d ON d.c = 1 OR e.event_id % 20 = 0""",
    "hourly_obs": """
SELECT l_suppkey AS station_id,
       CAST(8 AS DOUBLE) + CAST((l_suppkey * 91) % 960 AS DOUBLE) / 64 AS latitude,
       CAST(102 AS DOUBLE) + CAST((l_suppkey * 37) % 512 AS DOUBLE) / 64 AS longitude,
       DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT) AS date,
       l_quantity AS temp, l_discount * 1000 AS rhum, l_tax * 100 AS wspd,
       CASE WHEN (l_suppkey + l_orderkey % 30) % 11 = 0 THEN NULL
            WHEN (l_suppkey + l_orderkey % 30) % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS prcp
FROM {lineitem}""",
    "ndvi_pixels": """
SELECT CAST(8 AS DOUBLE) + CAST(((o_custkey % 150) * 91) % 960 AS DOUBLE) / 64 AS y,
       CAST(102 AS DOUBLE) + CAST(((o_custkey % 150) * 37) % 512 AS DOUBLE) / 64 AS x,
       DATE '2023-12-19' + CAST(16 * (o_orderkey % 3) AS INT) AS composite_date,
       CAST(o_orderkey % 12000 - 3000 AS DOUBLE) AS raw
FROM {orders}""",
    "stations": """
SELECT s_suppkey AS id, CAST(8 AS DOUBLE) + CAST((s_suppkey * 53) % 960 AS DOUBLE) / 64 AS latitude,
       CAST(102 AS DOUBLE) + CAST((s_suppkey * 29) % 512 AS DOUBLE) / 64 AS longitude FROM {supplier}""",
    "subscribers": """
SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'telegram' ELSE 'email' END AS channel, c_name AS address,
       CAST(c_nationkey % 3 AS INT) AS min_severity_rank,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(102 + c_custkey % 6 AS DOUBLE) END AS bbox_min_lon,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(8 + c_custkey % 12 AS DOUBLE) END AS bbox_min_lat,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(104 + c_custkey % 6 AS DOUBLE) END AS bbox_max_lon,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(11 + c_custkey % 12 AS DOUBLE) END AS bbox_max_lat,
       CASE WHEN c_custkey % 10 = 0 THEN 'inactive' ELSE 'active' END AS status
FROM {customer}""",
    "scores": """
SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INT) AS label,
       CAST((event_id * 7919) % 1024 AS DOUBLE) / 1024 AS probability FROM {events}""",
    "raster_names": """
SELECT o_orderkey, CASE CAST(o_orderkey % 3 AS INT)
            WHEN 0 THEN concat('ndvi_doy', CAST(2020 + o_custkey % 5 AS STRING), lpad(CAST(1 + o_orderkey % 366 AS STRING), 3, '0'), '.tif')
            WHEN 1 THEN concat('ndvi_20', CAST(20 + o_custkey % 5 AS STRING), lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0'), lpad(CAST(1 + o_custkey % 30 AS STRING), 2, '0'), '.tif')
            ELSE 'ndvi.tif' END AS file_name
FROM {orders}""",
    "edges": """
SELECT poly, ring, seq, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2 FROM (VALUES
 (0,0,0,103.0,9.0,109.0,9.0),(0,0,1,109.0,9.0,109.0,20.0),(0,0,2,109.0,20.0,106.0,22.5),(0,0,3,106.0,22.5,103.0,20.0),(0,0,4,103.0,20.0,103.0,9.0),
 (0,1,0,105.0,12.0,107.0,12.0),(0,1,1,107.0,12.0,107.0,14.0),(0,1,2,107.0,14.0,105.0,14.0),(0,1,3,105.0,14.0,105.0,12.0),
 (1,0,0,109.25,21.0,109.75,21.0),(1,0,1,109.75,21.0,109.75,22.0),(1,0,2,109.75,22.0,109.25,22.0),(1,0,3,109.25,22.0,109.25,21.0)
) AS t(poly, ring, seq, x1, y1, x2, y2)""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in sql})


def duck(*names: str) -> str:
    """The views as the start of a WITH clause for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)
