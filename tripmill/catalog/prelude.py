"""The trip inputs as SQL over the given tables, written independently of the adapters."""

from __future__ import annotations


def total(col: str) -> str:
    """Exact sum of a double column, as double."""
    return f"CAST(sum(CAST({col} AS DECIMAL(18,4))) AS DOUBLE)"


def mean(col: str) -> str:
    """Exact mean of a numeric column, as double."""
    return f"{total(col)} / count({col})"


def number_text(col: str) -> str:
    return f"rtrim(rtrim(CAST(CAST({col} AS DECIMAL(18,4)) AS VARCHAR), '0'), '.')"


_COMMON = """VendorID, pickup_datetime, dropoff_datetime, store_and_fwd_flag, RatecodeID,
  PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra, mta_tax,
  tip_amount, tolls_amount, improvement_surcharge, total_amount, payment_type,
  congestion_surcharge"""

PRELUDE = f"""
WITH line_money AS (
  SELECT *,
    CASE WHEN l_orderkey % 97 = 0 THEN CAST(0 AS DECIMAL(12,2))
         ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS fare,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 10 AS DECIMAL(4,2)) AS surcharge,
    CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
         AS DECIMAL(12,2)) AS tip,
    CASE WHEN l_partkey % 10 = 0 THEN 6.55 ELSE 0.00 END AS tolls,
    CASE WHEN l_suppkey % 2 = 0 THEN 2.50 END AS congestion
  FROM lineitem
), base AS (
  SELECT l_linestatus, l_orderkey, l_linenumber,
    CAST(l_shipdate AS DATE) AS pickup_date,
    CAST(nullif(l_suppkey % 5, 0) AS INTEGER) AS VendorID,
    l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400) AS pickup_datetime,
    l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400
                            + 60 + (l_partkey * 31) % 5400) AS dropoff_datetime,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_partkey % 6 + 1 AS INTEGER) AS RatecodeID,
    CAST(l_suppkey % 27 AS INTEGER) AS PULocationID,
    CAST(l_partkey % 27 AS INTEGER) AS DOLocationID,
    CAST(l_quantity AS INTEGER) % 7 AS passenger_count,
    l_quantity * l_linenumber / 2 AS trip_distance,
    CAST(fare AS DOUBLE) AS fare_amount,
    CAST(surcharge AS DOUBLE) AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(tip AS DOUBLE) AS tip_amount,
    CAST(tolls AS DOUBLE) AS tolls_amount,
    CAST(NULL AS DOUBLE) AS ehail_fee,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    CAST(fare + surcharge + 0.50 + tip + tolls + 0.30 + coalesce(congestion, 0.00) AS DOUBLE)
      AS total_amount,
    nullif(l_linenumber, 7) AS payment_type,
    CAST(l_suppkey % 2 + 1 AS INTEGER) AS trip_type,
    CAST(congestion AS DOUBLE) AS congestion_surcharge
  FROM line_money
), green AS (
  SELECT VendorID, pickup_datetime AS lpep_pickup_datetime,
    dropoff_datetime AS lpep_dropoff_datetime, store_and_fwd_flag, RatecodeID, PULocationID,
    DOLocationID, passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount,
    tolls_amount, ehail_fee, improvement_surcharge, total_amount, payment_type, trip_type,
    congestion_surcharge
  FROM base WHERE l_linestatus = 'O'
), yellow AS (
  SELECT VendorID, pickup_datetime AS tpep_pickup_datetime,
    dropoff_datetime AS tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID,
    store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax,
    tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge
  FROM base WHERE l_linestatus = 'F'
), trips AS (
  SELECT {_COMMON}, CASE l_linestatus WHEN 'O' THEN 'green' ELSE 'yellow' END AS service_type,
    pickup_date
  FROM base WHERE l_linestatus IN ('O', 'F')
), hvfhv AS (
  SELECT 'HV000' || CAST(l_linenumber % 4 + 2 AS VARCHAR) AS hvfhs_license_num,
    'B' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS dispatching_base_num,
    l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400) AS pickup_datetime,
    l_shipdate + to_seconds((l_orderkey * 7 + l_linenumber) % 86400
                            + 60 + (l_partkey * 31) % 5400) AS dropoff_datetime,
    CAST(l_suppkey % 27 AS INTEGER) AS PULocationID,
    CAST(l_partkey % 27 AS INTEGER) AS DOLocationID,
    CASE WHEN l_returnflag = 'A' THEN '1' END AS SR_Flag
  FROM lineitem
), zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
    CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
), payments(payment_type, description) AS (
  VALUES (0, 'Unknown'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
         (5, 'Unknown'), (6, 'Voided trip')
), payment_names(payment_type_id, payment_type_name) AS (
  VALUES (0, 'flex_fare'), (1, 'credit_card'), (2, 'cash'), (3, 'no_charge'), (4, 'dispute'),
         (5, 'unknown'), (6, 'voided_trip')
), rides AS (
  SELECT CAST(user_id % 27 AS INTEGER) AS PULocationID,
    CAST(event_id % 27 AS INTEGER) AS DOLocationID,
    (event_id % 200) / 10 AS trip_distance, value AS total_amount,
    epoch_us(ts) // 1000 AS tpep_pickup_datetime
  FROM events
), recent AS (
  SELECT event_id AS trip_id, CAST(ts AS DATE) AS pickup_date,
    CAST(nullif(user_id % 5, 0) AS INTEGER) AS VendorID,
    date_trunc('second', ts) AS pickup_datetime,
    date_trunc('second', ts) + to_seconds(60 + (event_id * 31) % 5400) AS dropoff_datetime,
    CAST(event_id % 7 AS INTEGER) AS passenger_count,
    (event_id % 200) / 10 AS trip_distance,
    CAST(event_id % 6 + 1 AS INTEGER) AS RatecodeID,
    CASE WHEN event_type = 'error' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(user_id % 27 AS INTEGER) AS PULocationID,
    CAST(event_id % 27 AS INTEGER) AS DOLocationID,
    CAST(nullif(event_id % 8, 7) AS INTEGER) AS payment_type,
    value AS fare_amount, CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
    CASE WHEN event_type = 'purchase' THEN CAST(2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      AS tip_amount,
    CAST(0 AS DOUBLE) AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    CAST(CAST(value AS DECIMAL(12,2)) + 1.30
         + CASE WHEN event_type = 'purchase' THEN 2.0 ELSE 0.0 END AS DOUBLE) AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge
  FROM events
), recent_trips AS (
  SELECT trip_id, VendorID, PULocationID, DOLocationID, pickup_datetime, dropoff_datetime,
    fare_amount, tip_amount, total_amount, pickup_date
  FROM recent
), products AS (
  SELECT p_partkey AS id, p_name AS title,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS brand, p_retailprice AS price
  FROM part
), players AS (
  SELECT c_mktsegment || '-' || CAST(c_nationkey AS VARCHAR) AS name FROM customer
)
"""
