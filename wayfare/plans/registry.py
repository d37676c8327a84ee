"""Every registered query with its DuckDB counterpart, over the supplied test tables.

Orders joined with their line items stand for trips, events stand for trips with exact times, and suppliers with
their nation and region stand for zones. Decimals become doubles and dates become text at this edge only, because
the two engines hand these types to Python differently.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wayfare.functions import (
    duration_minutes_exact,
    duration_minutes_whole,
    fingerprint,
    fingerprint_sql,
)
from wayfare.operators import checks, cleaning, comparison, history, joins, profile, ranking, rolling
from wayfare.plans import reports, tuning, warehouse
from wayfare.schemas import FINGERPRINT, RAW, TRIPS
from wayfare.session import held, scoped_conf, work_folder
from wayfare.sources import readers, sinks
from wayfare.sources.drift import drift_changes
from wayfare.sources.generated import date_series
from wayfare.sources.history_table import HistoryTable
from wayfare.sources.versioned import VersionedTable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MIN_FARE = 10_000.0
ZONE_BOUNDS = (1, 2_000_000_000)
RULES = {"min_fare": MIN_FARE, "zones": ZONE_BOUNDS}
ANCHOR_STEP = 7  # of the rolling check: a seventh of all seconds


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text."""
    target = {T.DecimalType: "double", T.DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(target[type(f.dataType)]).alias(f.name) if type(f.dataType) in target else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# --- the test tables in their roles -----------------------------------------------------------------------------


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips(spark: SparkSession, folder: str, named: bool = False) -> DataFrame:
    """Line items as trips. Returned goods occur twice, the seventh line lacks its counts, some flags are NULL.

    Two columns of the raw layout are absent. ``named`` adds a person name.
    """
    rows = single_trips(spark, folder, named)
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def copied(rows: DataFrame) -> DataFrame:
    """Single trips with their copies. Columns that were added are computed once for all copies of a row, while a plain
    ``explode`` of the number would compute them for each."""
    columns = [c for c in rows.columns if c != "copies"]
    return rows.select(F.inline(F.array_repeat(F.struct(*columns), F.col("copies"))))


def single_trips(spark: SparkSession, folder: str, named: bool = False) -> DataFrame:
    """Line items as trips, with the number of their ``copies``."""
    items, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    # both sides grow with the data, so neither is a candidate for broadcasting
    rows = items.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    names = []
    if named:
        rows = rows.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        names = [F.col("p_name").alias("driver_name")]
    counted = F.col("l_linenumber") != 7
    copies = F.when(F.col("l_returnflag") == "R", 2).otherwise(1)
    return rows.select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.when(counted, F.col("l_quantity").cast("bigint")).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.when(counted, F.col("l_linenumber").cast("bigint")).alias("RatecodeID"),
        F.when(F.col("l_linestatus") == "F", F.col("l_returnflag")).alias("store_and_fwd_flag"),
        F.col("l_suppkey").cast("int").alias("PULocationID"),
        F.col("l_partkey").cast("int").alias("DOLocationID"),
        F.col("l_quantity").cast("bigint").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_tax").alias("tolls_amount"),
        F.col("l_tax").alias("improvement_surcharge"),
        F.col("o_totalprice").alias("total_amount"),
        *names,
        copies.alias("copies"),
    )


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trips of a user; error events have no vendor."""
    return table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.length("event_type")).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("user_id").cast("int").alias("PULocationID"),
        F.col("value").alias("fare_amount"),
    )


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as zones."""
    supplier, nation, region = (table(spark, folder, n) for n in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").cast("int").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.col("s_name").alias("service_zone"),
        )
    )


def order_days(spark: SparkSession, folder: str) -> DataFrame:
    """Every day between the first and the last order."""
    bounds = table(spark, folder, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return date_series(bounds, "lo", "hi")


def models(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return warehouse.build_models(
        trips(spark, folder, named=True), zones(spark, folder), order_days(spark, folder), **RULES
    )


SQL_TRIP_COLUMNS = """
    l_linenumber as VendorID, o_orderdate as tpep_pickup_datetime, l_shipdate as tpep_dropoff_datetime,
    case when l_linenumber <> 7 then cast(l_quantity as bigint) end as passenger_count,
    l_quantity as trip_distance,
    case when l_linenumber <> 7 then cast(l_linenumber as bigint) end as RatecodeID,
    case when l_linestatus = 'F' then l_returnflag end as store_and_fwd_flag,
    cast(l_suppkey as integer) as PULocationID, cast(l_partkey as integer) as DOLocationID,
    cast(l_quantity as bigint) as payment_type, l_extendedprice as fare_amount, l_discount as extra,
    l_tax as mta_tax, l_discount as tip_amount, l_tax as tolls_amount, l_tax as improvement_surcharge,
    o_totalprice as total_amount"""
SQL_LINES = "lineitem join orders on l_orderkey = o_orderkey"
SQL_TRIPS = f"""trips as (
    select {SQL_TRIP_COLUMNS} from {SQL_LINES}
    union all
    select {SQL_TRIP_COLUMNS} from {SQL_LINES} where l_returnflag = 'R')"""
SQL_NAMED_TRIPS = f"""trips as (
    select {SQL_TRIP_COLUMNS}, p_name as driver_name from {SQL_LINES} join part on l_partkey = p_partkey
    union all
    select {SQL_TRIP_COLUMNS}, p_name from {SQL_LINES} join part on l_partkey = p_partkey where l_returnflag = 'R')"""
SQL_EVENTS = """trips as (
    select event_id, case when event_type <> 'error' then cast(length(event_type) as integer) end as VendorID,
           ts as tpep_pickup_datetime, cast(user_id as integer) as PULocationID, value as fare_amount
    from events)"""
SQL_ZONES = """zones as (
    select cast(s_suppkey as integer) as LocationID, r_name as Borough, n_name as Zone, s_name as service_zone
    from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""
SQL_VALID = f"""fare_amount >= {MIN_FARE} and tpep_dropoff_datetime > tpep_pickup_datetime
    and PULocationID between {ZONE_BOUNDS[0]} and {ZONE_BOUNDS[1]}
    and DOLocationID between {ZONE_BOUNDS[0]} and {ZONE_BOUNDS[1]}"""
SQL_WHOLE = "(epoch_us(tpep_dropoff_datetime) // 1000000 - epoch_us(tpep_pickup_datetime) // 1000000) / 60.0::double"


def _sql_text(column: str, kind: str) -> str:
    return {
        "int": f"cast(cast({column} as bigint) as varchar)",
        "ts": f"strftime({column}, '%Y-%m-%d %H:%M:%S')",
        "dec": f"cast(cast({column} as decimal(12,2)) as varchar)",
        "str": f"cast({column} as varchar)",
    }[kind]


def _sql_hash(columns: list[tuple[str, str]], token: str | None = None) -> str:
    parts = [_sql_text(c, k) for c, k in columns]
    if token is not None:
        parts = [f"coalesce({p}, '{token}')" for p in parts]
    return f"sha256(concat_ws('||', {', '.join(parts)}))"


# the columns of the fingerprint that the test trips have
ABSENT = {"congestion_surcharge", "Airport_fee", "driver_name"}
TRIP_KINDS = [(name, kind) for name, kind in FINGERPRINT if name not in ABSENT]
SQL_HASH = _sql_hash(TRIP_KINDS)
SQL_NAMED_HASH = _sql_hash([*TRIP_KINDS, ("driver_name", "str")])
RAW_NAMES = ", ".join(c for c, _ in TRIP_KINDS)
SQL_CLEANED = f"""cleaned as (
    select * exclude (position) from (
        select *, {SQL_WHOLE} as trip_duration_minutes, {SQL_HASH} as trip_fingerprint,
               row_number() over (partition by {SQL_HASH} order by tpep_pickup_datetime) as position
        from trips where {SQL_VALID}) where position = 1)"""


# --- filters, durations, fingerprints ---------------------------------------------------------------------------


@register(f"with {SQL_TRIPS} select {RAW_NAMES} from trips where {SQL_VALID}")
def trip_filter(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).filter(cleaning.is_valid_trip(**RULES))


@register(
    """select event_id, (epoch_us(ts) // 1000000 - epoch_us(date_trunc('day', ts)) // 1000000) / 60.0::double as minutes
       from events"""
)
def trip_duration_whole(spark: SparkSession, folder: str) -> DataFrame:
    start = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return table(spark, folder, "events").select("event_id", duration_minutes_whole(start, "ts").alias("minutes"))


@register(
    """select event_id, (epoch_us(ts) - epoch_us(date_trunc('day', ts))) / 60000000.0::double as minutes from events"""
)
def trip_duration_exact(spark: SparkSession, folder: str) -> DataFrame:
    start = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return table(spark, folder, "events").select("event_id", duration_minutes_exact(start, "ts").alias("minutes"))


@register("select event_id, cast(hour(ts) as integer) as pickup_hour from events")
def trip_hour(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.hour("ts").alias("pickup_hour"))


@register(f"with {SQL_TRIPS} select {RAW_NAMES}, {SQL_HASH} as trip_fingerprint from trips")
def trip_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    rows = single_trips(spark, folder)
    return copied(rows.withColumn("trip_fingerprint", fingerprint(rows)))


@register(
    f"""with {SQL_TRIPS} select VendorID, PULocationID, DOLocationID, {SQL_HASH} as trip_fingerprint from trips
        where {SQL_VALID}"""
)
def trip_fingerprint_sql(spark: SparkSession, folder: str) -> DataFrame:
    rows = trips(spark, folder)
    rows.createOrReplaceTempView("fingerprint_trips")
    return spark.sql(
        f"""select VendorID, PULocationID, DOLocationID, {fingerprint_sql(rows)} as trip_fingerprint
            from fingerprint_trips
            where fare_amount >= {MIN_FARE}D and tpep_dropoff_datetime > tpep_pickup_datetime
              and PULocationID between {ZONE_BOUNDS[0]} and {ZONE_BOUNDS[1]}
              and DOLocationID between {ZONE_BOUNDS[0]} and {ZONE_BOUNDS[1]}"""
    )


@register(
    f"""with {SQL_TRIPS} select VendorID, PULocationID, DOLocationID,
        {_sql_hash(TRIP_KINDS, "<null>")} as trip_fingerprint from trips"""
)
def trip_fingerprint_nullsafe(spark: SparkSession, folder: str) -> DataFrame:
    rows = single_trips(spark, folder)
    key = fingerprint(rows, null_token="<null>").alias("trip_fingerprint")
    return copied(rows.select("VendorID", "PULocationID", "DOLocationID", key, "copies"))


# --- deduplication ----------------------------------------------------------------------------------------------

ITEM_ORDER = "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus"


@register(
    f"""select * exclude (position) from (
            select *, row_number() over (partition by l_orderkey, l_linenumber
                                         order by {", ".join(ITEM_ORDER.split())}) as position
            from lineitem) where position = 1"""
)
def dedup_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.keep_first(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ITEM_ORDER.split())


@register("select distinct l_orderkey, l_linenumber from lineitem")
def dedup_any_keys(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return cleaning.keep_any(table(spark, folder, "lineitem"), keys).select(*keys)


@register(f"with {SQL_TRIPS}, {SQL_CLEANED} select * from cleaned")
def clean_trips(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_trips(trips(spark, folder), **RULES)


@register(f"with {SQL_TRIPS}, {SQL_CLEANED} select * from cleaned")
def clean_trips_sql(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_trips_sql(trips(spark, folder), **RULES)


@register(
    f"""with {SQL_TRIPS}, counted as (
            select count(*) as raw_rows, count(distinct case when {SQL_VALID} then {SQL_HASH} end) as cleaned_rows
            from trips)
        select raw_rows, cleaned_rows, (raw_rows - cleaned_rows) / raw_rows * 100 as dropped_pct from counted"""
)
def retention_rate(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.retention(trips(spark, folder), **RULES)


# --- windows, ranks, top groups ---------------------------------------------------------------------------------

SQL_RANKED = f"""with {SQL_EVENTS}, ranked as (
    select *, cast(hour(tpep_pickup_datetime) as integer) as pickup_hour,
           cast(dense_rank() over (partition by PULocationID, hour(tpep_pickup_datetime)
                                   order by fare_amount desc) as integer) as fare_rank
    from trips)"""


@register(f"{SQL_RANKED} select * from ranked")
def fare_dense_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.rank_trips_by_fare(event_trips(spark, folder))


@register(f"{SQL_RANKED} select * exclude (fare_rank) from ranked where fare_rank = 1")
def top_fare_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.top_fares(event_trips(spark, folder))


@register(
    f"""with {SQL_EVENTS} select PULocationID, cast(hour(tpep_pickup_datetime) as integer) as pickup_hour,
        count(*) as trips from trips group by 1, 2 order by trips desc, 1, 2 limit 1"""
)
def busiest_group(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.busiest_groups(event_trips(spark, folder))


@register(
    f"""with {SQL_EVENTS}, busiest as (
            select PULocationID, hour(tpep_pickup_datetime) as h, count(*) as n from trips
            group by 1, 2 order by n desc, 1, 2 limit 1)
        select max(fare_amount) as max_fare from trips join busiest using (PULocationID)
        where hour(tpep_pickup_datetime) = h"""
)
def max_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Highest fare within the busiest group."""
    rows = event_trips(spark, folder).withColumn(ranking.HOUR, F.hour(RAW.pickup))
    busiest = ranking.busiest_groups(event_trips(spark, folder)).drop("trips")
    # one row by its limit, so it may be broadcast
    return rows.join(F.broadcast(busiest), [RAW.pickup_zone, ranking.HOUR]).agg(F.max(RAW.fare).alias("max_fare"))


def _sql_rolling(counted: str) -> str:
    return f"""with {SQL_EVENTS}, timed as (
            select *, epoch_us(tpep_pickup_datetime) // 1000000 as pickup_ts from trips)
        select *, count({counted}) over (partition by PULocationID order by pickup_ts
                 range between 604800 preceding and current row) as rolling_7d_trip_count from timed"""


@register(_sql_rolling("*"))
def rolling_7d_trips(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.rolling_trip_count(event_trips(spark, folder))


@register(_sql_rolling("VendorID"))
def rolling_7d_vendor_trips(spark: SparkSession, folder: str) -> DataFrame:
    return rolling.rolling_trip_count(event_trips(spark, folder), counted=F.col("VendorID"))


@register(
    f"""with {SQL_TRIPS} select PULocationID, DOLocationID, count(VendorID) as trip_count from trips group by 1, 2"""
)
def pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.pair_counts(trips(spark, folder))


# --- joins ------------------------------------------------------------------------------------------------------

SQL_ZONED = f"""with {SQL_TRIPS}, {SQL_ZONES}
    select {RAW_NAMES}, LocationID, Borough, Zone, service_zone from trips join zones on PULocationID = LocationID"""


@register(SQL_ZONED)
def join_broadcast_zone(spark: SparkSession, folder: str) -> DataFrame:
    return joins.lookup_join(trips(spark, folder), zones(spark, folder), F.col("PULocationID") == F.col("LocationID"))


@register(SQL_ZONED)
def join_merge_zone(spark: SparkSession, folder: str) -> DataFrame:
    return joins.merge_join(trips(spark, folder), zones(spark, folder), F.col("PULocationID") == F.col("LocationID"))


SQL_INITIALS = """case when driver_name is null then null
    when len(string_split(driver_name, ' ')) >= 2
    then substring(split_part(driver_name, ' ', 1), 1, 1) || '.' || substring(split_part(driver_name, ' ', 2), 1, 1) || '.'
    else substring(driver_name, 1, 1) || '.' end"""
SQL_STAGED = f"""{SQL_NAMED_TRIPS}, typed as (
    select VendorID as vendor_id, tpep_pickup_datetime as pickup_datetime, tpep_dropoff_datetime as dropoff_datetime,
           cast(passenger_count as integer) as passenger_count,
           PULocationID as pickup_location_id, DOLocationID as dropoff_location_id,
           {", ".join(
               f"cast(cast({c} as decimal(10,2)) as double) as {c}"
               for c in ("trip_distance fare_amount extra mta_tax tip_amount tolls_amount improvement_surcharge"
                         " total_amount").split()
           )},
           left(store_and_fwd_flag, 1) as store_and_fwd_flag,
           cast(case when VendorID = 1 then 1 else passenger_count % 5 + 1 end as integer) as rate_code_id,
           cast(passenger_count % 2 + 1 as integer) as payment_type_id,
           (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0::double
               as trip_duration_minutes,
           {SQL_INITIALS} as driver_initials,
           {SQL_NAMED_HASH} as trip_fingerprint
    from trips
), stg_trips as (
    select * exclude (position) from (
        select *, row_number() over (partition by trip_fingerprint order by pickup_datetime) as position
        from typed
        where fare_amount >= {MIN_FARE} and dropoff_datetime > pickup_datetime
          and pickup_location_id between {ZONE_BOUNDS[0]} and {ZONE_BOUNDS[1]}
          and dropoff_location_id between {ZONE_BOUNDS[0]} and {ZONE_BOUNDS[1]}) where position = 1
), fact_trips as (
    select *, strftime(pickup_datetime, '%Y-%m-%d') as pickup_date from stg_trips)"""
SQL_LOCATION = f"""{SQL_ZONES}, dim_location as (
    select LocationID as location_id, left(Borough, 50) as borough, left(Zone, 100) as zone_name,
           left(service_zone, 50) as service_zone from zones)"""
SQL_DATE = """dim_date as (
    select strftime(d, '%Y-%m-%d') as date_day, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
           cast(day(d) as integer) as day, cast(dayofweek(d) as integer) as day_of_week,
           rpad(monthname(d), 9, ' ') as month_name, rpad(dayname(d), 9, ' ') as day_name,
           dayofweek(d) in (0, 6) as is_weekend
    from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as d from orders))"""
SQL_CONSTANTS = ", ".join(
    f"{name}({key}, description) as (values {', '.join(f'''({k}, '{v}')''' for k, v in rows)})"
    for name, key, rows in (
        ("dim_rate_code", "rate_code_id", warehouse.RATE_CODES),
        ("dim_payment_type", "payment_type_id", warehouse.PAYMENT_TYPES),
    )
)
SQL_MODELS = f"with {SQL_STAGED}, {SQL_LOCATION}, {SQL_DATE}, {SQL_CONSTANTS}"


@register(
    f"""with {SQL_NAMED_TRIPS}, both_sides as (
            select {SQL_NAMED_HASH} as f,
                   {SQL_VALID} as in_lake, {SQL_VALID} and VendorID <> 1 as in_part from trips),
        per_key as (
            select f, max(in_lake)::int as l, max(in_part)::int as r from both_sides where in_lake group by f)
        select case when r = 0 then 'left_only' else 'matched' end as outcome, count(*) as fingerprints,
               cast(sum(l) as bigint) as left_rows, cast(sum(r) as bigint) as right_rows
        from per_key group by 1"""
)
def match_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned trips against staged trips of all vendors but the first."""
    raw = trips(spark, folder, named=True)
    staged = warehouse.stage_trips(raw, **RULES, binary=True).filter("vendor_id <> 1")
    return joins.match_fingerprints(cleaning.clean_trips(raw, **RULES, binary=True), staged)


@register(
    f"""with {SQL_STAGED}
        select trip_fingerprint, fare_amount as lake_fare, fare_amount as warehouse_fare, driver_initials from stg_trips"""
)
def join_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned and the staged form of the same trips, joined on their fingerprints."""
    raw = trips(spark, folder, named=True)
    lake = cleaning.clean_trips(raw, **RULES, binary=True).select("trip_fingerprint", F.col("fare_amount").alias("lake_fare"))
    staged = warehouse.stage_trips(raw, **RULES, binary=True).select(
        "trip_fingerprint", F.col("fare_amount").alias("warehouse_fare"), "driver_initials"
    )
    joined = joins.join_on_fingerprint(lake, staged)
    return portable(joined.withColumn("trip_fingerprint", F.lower(F.hex("trip_fingerprint"))))


@register(
    f"""{SQL_MODELS}
        select trip_fingerprint, pickup_location_id, dropoff_location_id, rate_code_id, payment_type_id,
               p.zone_name as pickup_zone_name, p.borough as pickup_borough, q.zone_name as dropoff_zone_name,
               d.day_name as date_day_name, d.is_weekend as date_is_weekend,
               r.description as rate_code_description, t.description as payment_type_description
        from fact_trips
        left join dim_location p on pickup_location_id = p.location_id
        left join dim_location q on dropoff_location_id = q.location_id
        left join dim_date d on pickup_date = d.date_day
        left join dim_rate_code r using (rate_code_id)
        left join dim_payment_type t using (payment_type_id)"""
)
def star_lookup(spark: SparkSession, folder: str) -> DataFrame:
    star = models(spark, folder)
    return joins.star_lookup(star["fact_trips"], warehouse.star_dimensions(star)).select(
        "trip_fingerprint",
        "pickup_location_id",
        "dropoff_location_id",
        "rate_code_id",
        "payment_type_id",
        "pickup_zone_name",
        "pickup_borough",
        "dropoff_zone_name",
        "date_day_name",
        "date_is_weekend",
        "rate_code_description",
        "payment_type_description",
    )


# --- models -----------------------------------------------------------------------------------------------------


@register(
    f"""with {SQL_TRIPS} select {RAW_NAMES}, cast(null as double) as congestion_surcharge,
        cast(null as double) as Airport_fee, cast(null as varchar) as driver_name from trips"""
)
def schema_conform(spark: SparkSession, folder: str) -> DataFrame:
    return readers.conform(trips(spark, folder).withColumn("undeclared", F.lit(1)))


@register(f"with {SQL_STAGED} select * from stg_trips")
def stg_trips(spark: SparkSession, folder: str) -> DataFrame:
    return portable(models(spark, folder)["stg_trips"])


@register(f"with {SQL_LOCATION} select * from dim_location")
def stg_zones(spark: SparkSession, folder: str) -> DataFrame:
    return models(spark, folder)["stg_zones"]


@register(f"with {SQL_STAGED} select * from fact_trips")
def fact_trips(spark: SparkSession, folder: str) -> DataFrame:
    return portable(models(spark, folder)["fact_trips"])


@register(f"with {SQL_LOCATION} select * from dim_location")
def dim_location(spark: SparkSession, folder: str) -> DataFrame:
    return models(spark, folder)["dim_location"]


@register(f"with {SQL_DATE} select * from dim_date")
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return portable(models(spark, folder)["dim_date"])


# --- checks and comparisons -------------------------------------------------------------------------------------


@register(
    """select l_orderkey, count(*) as n_rows from (
           select case when l_returnflag <> 'A' then l_orderkey end as l_orderkey from lineitem)
       where l_orderkey is not null group by 1 having count(*) > 1"""
)
def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    key = F.when(F.col("l_returnflag") != "A", F.col("l_orderkey"))
    return checks.duplicate_keys(table(spark, folder, "lineitem").select(key.alias("l_orderkey")), "l_orderkey")


@register(
    f"""with {SQL_TRIPS} select
        {", ".join(f"cast(count(*) filter (where {c} is null) as bigint) as {c}" for c, _ in TRIP_KINDS)} from trips"""
)
def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    rows = trips(spark, folder)
    return checks.null_counts(rows, rows.columns)


@register(
    """select l_suppkey, count(*) as child_rows from lineitem
       where l_suppkey not in (select s_suppkey from supplier where s_acctbal >= 1000) group by 1"""
)
def check_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of suppliers that are missing once those with a low balance are left out."""
    parent = table(spark, folder, "supplier").filter("s_acctbal >= 1000")
    return joins.orphans(table(spark, folder, "lineitem"), "l_suppkey", parent, "s_suppkey")


def _sql_check(c: checks.Check) -> str:
    failures = {
        "not_null": f"select count(*) from {c.model} where {c.column} is null",
        "unique": f"""select count(*) from (select {c.column} from {c.model} where {c.column} is not null
                      group by 1 having count(*) > 1)""",
        "relationships": f"""select count(*) from {c.model} where {c.column} is not null
                             and {c.column} not in (select {c.parent_column} from {c.parent})""",
    }[c.kind]
    return f"select '{c.model}' as model, '{c.column}' as \"column\", '{c.kind}' as \"check\", ({failures}) as failures"


@register(
    f"{SQL_MODELS}, stg_zones as (select * from dim_location) " + " union all ".join(map(_sql_check, warehouse.CHECKS))
)
def declared_checks(spark: SparkSession, folder: str) -> DataFrame:
    """All declared checks, on models that were written first."""
    base = work_folder(spark, "models")
    built = models(spark, folder)
    staged = VersionedTable(spark, f"{base}/stg_trips")
    staged.write(built["stg_trips"])
    built["stg_trips"] = staged.read()
    built["fact_trips"] = warehouse.fact_trips(built["stg_trips"])
    return checks.run_checks(built, warehouse.CHECKS)


SQL_FAULTS = """child as (
        select case when l_linenumber = 7 then null else l_suppkey end as supplier, cast(l_partkey as double) as part,
               case when l_linenumber < 3 then l_orderkey end as code from lineitem),
    one as (select s_suppkey from supplier where s_acctbal >= 1000), two as (select s_suppkey from supplier where s_acctbal < 5000),
    parts as (select cast(p_partkey as integer) as p_partkey from part where p_size > 10)"""


FAULT_CHECKS = [
    *checks.not_null("child", "supplier", "code"),
    *checks.unique("child", "code", "part"),
    *checks.relationship("child", "part", "parts", "p_partkey"),
    *checks.relationship("child", "supplier", "one", "s_suppkey"),
    *checks.relationship("child", "supplier", "two", "s_suppkey"),
]


@register(f"with {SQL_FAULTS} " + " union all ".join(map(_sql_check, FAULT_CHECKS)))
def declared_checks_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Checks that fail: NULLs, repeats, a double key with an integer parent, one column with two parents."""
    line, supplier = F.col("l_linenumber"), table(spark, folder, "supplier")
    child = table(spark, folder, "lineitem").select(
        F.when(line != 7, F.col("l_suppkey")).alias("supplier"),
        F.col("l_partkey").cast("double").alias("part"),
        F.when(line < 3, F.col("l_orderkey")).alias("code"),
    )
    parts = table(spark, folder, "part").filter("p_size > 10").select(F.col("p_partkey").cast("int"))
    faulty = {"child": child, "one": supplier.filter("s_acctbal >= 1000"), "two": supplier.filter("s_acctbal < 5000"), "parts": parts}
    return checks.run_checks(faulty, FAULT_CHECKS)


SQL_SIDES = """l as (select l_suppkey, l_partkey, l_quantity from lineitem),
    r as (select l_suppkey, l_partkey, l_quantity + case when l_linenumber = 3 then 1 else 0 end as l_quantity
          from lineitem where l_linenumber <> 5)"""


def _two_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Line items, and the same with some quantities changed and some lines left out."""
    items = table(spark, folder, "lineitem")
    columns = ["l_suppkey", "l_partkey", "l_quantity"]
    changed = items.filter("l_linenumber <> 5").withColumn(
        "l_quantity", F.col("l_quantity") + F.when(F.col("l_linenumber") == 3, 1).otherwise(0)
    )
    return items.select(*columns, F.lit("left").alias("only_left")), changed.select(*columns)


@register(
    f"""with {SQL_SIDES}, lo as (select * from l except all select * from r), ro as (select * from r except all select * from l)
        select (select count(*) from l) as left_rows, (select count(*) from r) as right_rows,
               (select count(*) from lo) as left_only, (select count(*) from ro) as right_only,
               (select count(*) from lo) = 0 and (select count(*) from ro) = 0 as identical"""
)
def row_diff(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.compare_rows(*_two_sides(spark, folder))


@register(f"with {SQL_SIDES} select * from l except all select * from r")
def bag_difference(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.missing_rows(*_two_sides(spark, folder))


@register("select l_partkey, l_quantity, l_suppkey from lineitem")
def common_columns(spark: SparkSession, folder: str) -> DataFrame:
    left, right = _two_sides(spark, folder)
    return left.select(*comparison.common_columns(left, right))


@register(f"with {SQL_TRIPS}, {SQL_CLEANED} select count(*) as left_rows, count(*) as right_rows, 0::bigint as left_only, "
          "0::bigint as right_only, true as identical from cleaned")
def sql_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    """The DataFrame form of the cleaned trips against the SQL form."""
    raw = trips(spark, folder)
    return comparison.compare_rows(cleaning.clean_trips(raw, **RULES), cleaning.clean_trips_sql(raw, **RULES))


@register(
    f"""{SQL_RANKED}
        select PULocationID, pickup_hour, max(fare_amount) as max_fare,
               min(fare_amount) filter (where fare_rank = 1) as lowest_first,
               max(fare_amount) filter (where fare_rank = 1) as highest_first, true as ok
        from ranked group by 1, 2"""
)
def rank_spot_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_trips(spark, folder)
    return checks.rank_check(rows, ranking.rank_trips_by_fare(rows))


@register(
    f"""with {SQL_EVENTS}, timed as (
            select PULocationID, epoch_us(tpep_pickup_datetime) // 1000000 as pickup_ts from trips),
        anchors as (
            select distinct PULocationID, pickup_ts as anchor from timed where pickup_ts % {ANCHOR_STEP} = 0
            union select PULocationID, max(pickup_ts) from timed group by 1)
        select PULocationID, anchor, count(*) as window_count, count(*) as recount, true as ok
        from timed join anchors using (PULocationID) where pickup_ts between anchor - 604800 and anchor group by 1, 2"""
)
def rolling_spot_check(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_trips(spark, folder)
    return checks.rolling_check(rows, rolling.rolling_trip_count(rows), every=ANCHOR_STEP)


@register(
    f"""with {SQL_EVENTS}, timed as (
            select PULocationID, epoch_us(tpep_pickup_datetime) // 1000000 as pickup_ts from trips),
        anchors as (
            select distinct PULocationID, pickup_ts as anchor from timed where pickup_ts % {ANCHOR_STEP} = 0
            union select PULocationID, max(pickup_ts) from timed group by 1),
        counted as (
            select PULocationID, anchor, count(*) as recount from timed join anchors using (PULocationID)
            where pickup_ts between anchor - 604800 and anchor group by 1, 2)
        select PULocationID, anchor, recount + 1 as window_count, recount, false as ok
        from counted where anchor % {2 * ANCHOR_STEP} = 0"""
)
def rolling_spot_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Counts made wrong by one in the middle of the series, as the check finds them."""
    rows = event_trips(spark, folder)
    wrong = (F.col(rolling.SECOND) % (2 * ANCHOR_STEP) == 0).cast("int")
    spoiled = rolling.rolling_trip_count(rows).withColumn(rolling.ROLLING, F.col(rolling.ROLLING) + wrong)
    return checks.rolling_check(rows, spoiled, every=ANCHOR_STEP).filter(~F.col("ok"))


# --- history ----------------------------------------------------------------------------------------------------

INSTANTS = [datetime(2024, month, 1, tzinfo=timezone.utc) for month in (1, 2, 3)]
SQL_HISTORY = f"""{SQL_LOCATION}, located as (
        select d.*, s_acctbal from dim_location d join supplier on location_id = s_suppkey),
    v1 as (select location_id, borough, zone_name, service_zone from located where s_acctbal >= 1000),
    v2 as (select location_id, borough, case when s_acctbal >= 5000 then zone_name || ' Updated' else zone_name end
                  as zone_name, service_zone from located),
    v3 as (select location_id, borough, zone_name, case when s_acctbal < 3000 then null else service_zone end
                  as service_zone from located where s_acctbal < 8000),
    s1 as (select *, timestamp '2024-01-01' as t from v1), s2 as (select *, timestamp '2024-02-01' as t from v2),
    s3 as (select *, timestamp '2024-03-01' as t from v3),
    seen as (select * from s1 union all select * from s2 union all select * from s3),
    starts as (
        select *, lag(t) over w is null or borough is distinct from lag(borough) over w
                  or zone_name is distinct from lag(zone_name) over w
                  or service_zone is distinct from lag(service_zone) over w as opens
        from seen window w as (partition by location_id order by t)),
    history as (
        select location_id, borough, zone_name, service_zone, t as valid_from,
               lead(t) over (partition by location_id order by t) as valid_to
        from starts where opens)"""


def _versions(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Three states of the locations: some missing; all, some renamed; some gone, names back, some attributes NULL."""
    located = warehouse.dim_location(warehouse.stage_zones(zones(spark, folder))).join(
        table(spark, folder, "supplier").select(F.col("s_suppkey").cast("int").alias("location_id"), "s_acctbal"),
        "location_id",
    )
    balance = F.col("s_acctbal")
    renamed = history.update_rows(located, balance >= 5000, zone_name=F.concat("zone_name", F.lit(" Updated")))
    blanked = history.update_rows(located.filter(balance < 8000), balance < 3000, service_zone=None)
    return [v.drop("s_acctbal") for v in (located.filter(balance >= 1000), renamed, blanked)]


def _history(spark: SparkSession, folder: str) -> DataFrame:
    first, *later = _versions(spark, folder)
    result = history.start_history(first, INSTANTS[0])
    for version, instant in zip(later, INSTANTS[1:], strict=True):
        # each merge reads the history once, so the plan grows by one scan of the locations
        result = history.merge_history(result, version, warehouse.HISTORY_KEY, warehouse.HISTORY_CHECKED, instant)
    return result.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (history.FROM, history.TO)})


@register(f"with {SQL_HISTORY} select * from history")
def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder)


@register(f"with {SQL_HISTORY} select * from history")
def scd2_history_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same history kept as a table: each merge reads and writes open rows only; the last one is run twice."""
    states = list(zip(_versions(spark, folder), INSTANTS, strict=True))
    target = HistoryTable(spark, work_folder(spark, "history"), warehouse.HISTORY_KEY, warehouse.HISTORY_CHECKED)
    for state, instant in [*states, states[-1]]:
        target.merge(state, instant)
    return target.read().withColumns({c: F.col(c).cast("timestamp_ntz") for c in (history.FROM, history.TO)})


@register(f"with {SQL_HISTORY} select location_id, count(*) as versions from history group by 1 having count(*) > 1")
def scd2_changed_keys(spark: SparkSession, folder: str) -> DataFrame:
    return history.changed_keys(_history(spark, folder), "location_id")


@register(
    f"""with {SQL_HISTORY} select count(distinct location_id) as keys, 0::bigint as not_one_open,
        0::bigint as reversed_interval, 0::bigint as gap_or_overlap from history"""
)
def scd2_invariants(spark: SparkSession, folder: str) -> DataFrame:
    return history.history_violations(_history(spark, folder), "location_id")


@register(
    f"""with {SQL_HISTORY}, latest as (select max_by(location_id, n * 1000000000 - location_id) as location_id from (
            select location_id, count(*) as n from history group by 1))
        select history.* from history join latest using (location_id) order by valid_from"""
)
def scd2_history_key(spark: SparkSession, folder: str) -> DataFrame:
    """All versions of the key with most versions, the lowest such key on a tie."""
    per_key = F.count(F.lit(1)).over(Window.partitionBy("location_id"))
    rows = _history(spark, folder).withColumn("__first", F.struct(per_key.alias("n"), (-F.col("location_id")).alias("key")))
    best = rows.agg(F.max("__first").alias("__best"))
    # one row, as it is an aggregate without keys
    found = rows.join(F.broadcast(best), F.col("__first") == F.col("__best")).drop("__first", "__best")
    return found.orderBy(history.FROM)


@register(
    f"""with {SQL_LOCATION} select location_id, borough,
        case when borough = 'ASIA' then zone_name || ' Updated' else zone_name end as zone_name, service_zone
        from dim_location"""
)
def conditional_update(spark: SparkSession, folder: str) -> DataFrame:
    """A table, updated by condition and written as its next version."""
    location = warehouse.dim_location(warehouse.stage_zones(zones(spark, folder)))
    target = VersionedTable(spark, work_folder(spark, "update"))
    target.write(location)
    changed = F.concat("zone_name", F.lit(" Updated"))
    target.write(history.update_rows(target.read(), F.col("borough") == "ASIA", zone_name=changed))
    return target.read()


# --- tables and files -------------------------------------------------------------------------------------------


def _two_commits(spark: SparkSession, folder: str) -> VersionedTable:
    """All line items, then those of finished lines only."""
    items = table(spark, folder, "lineitem")
    target = VersionedTable(spark, work_folder(spark, "items"))
    target.write(items, committed_at=INSTANTS[0])
    target.write(items.filter("l_linestatus = 'F'"), cluster_by=["l_suppkey"], committed_at=INSTANTS[1])
    return target


@register("select * from lineitem where l_linestatus = 'F'")
def versioned_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    return _two_commits(spark, folder).read()


@register("select * from lineitem")
def versioned_earlier(spark: SparkSession, folder: str) -> DataFrame:
    """The replaced version, found through the parent of the current one."""
    target = _two_commits(spark, folder)
    return target.read(target.snapshots().collect()[-1].parent_id)


@register(
    """select timestamp '2024-01-01' as committed_at, 'append' as operation, false as has_parent,
              count(*) as rows from lineitem
       union all
       select timestamp '2024-02-01', 'overwrite', true, count(*) from lineitem where l_linestatus = 'F'"""
)
def snapshot_log(spark: SparkSession, folder: str) -> DataFrame:
    log = _two_commits(spark, folder).snapshots()
    made = F.col("committed_at").cast("timestamp_ntz").alias("committed_at")
    return log.select(made, "operation", F.col("parent_id").isNotNull().alias("has_parent"), F.col("record_count").alias("rows"))


@register("select count(*) as rows, true as every_file_has_size from lineitem where l_linestatus = 'F'")
def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    return _two_commits(spark, folder).files().agg(
        F.sum("record_count").alias("rows"), F.bool_and(F.col("file_size_in_bytes") > 0).alias("every_file_has_size")
    )


@register(
    f"""with {SQL_TRIPS} select 2::bigint as files, cast(count(*) as bigint) as rows, cast(sum(n) as bigint) as trips
        from (select count(*) as n from trips group by VendorID, payment_type)"""
)
def coalesced_files(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per vendor and payment type, few whatever the input, in two files."""
    path = work_folder(spark, "coalesced")
    counts = ranking.pair_counts(trips(spark, folder), replace(RAW, pickup_zone="VendorID", dropoff_zone="payment_type"))
    sinks.write_coalesced(counts.repartition(8), path)
    written = spark.read.parquet(path)
    return written.agg(
        F.count_distinct("_metadata.file_path").alias("files"),
        F.count(F.lit(1)).alias("rows"),
        F.sum("trip_count").alias("trips"),
    )


@register("select * from orders")
def table_sink(spark: SparkSession, folder: str) -> DataFrame:
    """A catalog table made, replaced and read back."""
    name, path = "wayfare_sink.orders", work_folder(spark, "orders")
    sinks.create_namespace(spark, "wayfare_sink", work_folder(spark, "namespace"))
    sinks.drop_table(spark, name)
    sinks.write_table(table(spark, folder, "orders"), name, path)
    return spark.table(name)


def _fare_files(spark: SparkSession, folder: str) -> str:
    """Trips in one file for each line status, named as monthly files are, and a file that the name pattern leaves out."""
    base = work_folder(spark, "trip-files")
    rows = trips(spark, folder).withColumn("status", F.when(F.col("store_and_fwd_flag").isNull(), "O").otherwise("F"))
    rows.filter("status = 'F'").drop("status").write.parquet(f"{base}/yellow_tripdata_F.parquet")
    rows.filter("status = 'O'").drop("status").write.parquet(f"{base}/yellow_tripdata_O.parquet")
    rows.limit(0).write.parquet(f"{base}/other.parquet")
    return base


@register(
    f"""with {SQL_TRIPS} select case when store_and_fwd_flag is null then 'O' else 'F' end as month, count(*) as trips,
        cast(sum(passenger_count) as bigint) as passengers, cast(count(congestion) as bigint) as surcharges
        from (select *, null as congestion from trips) group by 1"""
)
def many_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Several trip files read as one table by the declared schema, with the file that each row comes from."""
    rows = readers.read_trips(spark, _fare_files(spark, folder), schema=TRIPS, lineage="source_file")
    month = F.regexp_extract("source_file", r"yellow_tripdata_([A-Z])", 1).alias("month")
    return rows.groupBy(month).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("passenger_count").alias("passengers"),
        F.count("congestion_surcharge").alias("surcharges"),
    )


DRIFTING = "VendorID passenger_count fare_amount store_and_fwd_flag surcharge".split()
SQL_DRIFTING = f"""with {SQL_TRIPS}, drifting as (
    select VendorID, passenger_count::double + case when VendorID in (3, 4) and payment_type % 2 = 0 then 0.5 else 0 end as passenger_count,
           round(fare_amount, 2) as fare_amount, case when VendorID < 5 then store_and_fwd_flag end as store_and_fwd_flag,
           case when VendorID >= 5 then payment_type / 4 end as surcharge
    from trips)"""


def _drifting_files(spark: SparkSession, folder: str) -> str:
    """Trips in three files as a layout drifts: whole types, then wider and fractional ones, then a column lost and one won."""
    base, vendor = work_folder(spark, "drifting"), F.col("VendorID")
    rows = trips(spark, folder).select("VendorID", "passenger_count", "fare_amount", "store_and_fwd_flag", "payment_type")
    rows = rows.withColumn("fare_amount", F.round("fare_amount", 2))
    first = rows.filter(vendor < 3)
    half = F.when(F.col("payment_type") % 2 == 0, 0.5).otherwise(0.0)
    second = rows.filter(vendor.between(3, 4)).withColumns(
        {"VendorID": vendor.cast("bigint"), "passenger_count": F.col("passenger_count") + half, "fare_amount": F.col("fare_amount").cast("decimal(12,2)")}
    )
    third = rows.filter(vendor >= 5).drop("store_and_fwd_flag").withColumn("surcharge", F.col("payment_type") / 4)
    third = third.withColumn("passenger_count", F.col("passenger_count").cast("int"))
    for month, part in enumerate((first, second, third), 1):
        part.drop("payment_type").write.parquet(f"{base}/yellow_tripdata_2024-0{month}.parquet")
    return base


@register(f"{SQL_DRIFTING} select cast(VendorID as bigint) as VendorID, * exclude (VendorID) from drifting")
def drifted_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Files of whole, long, decimal and double columns, one of them absent and one extra, read in their common types."""
    return readers.read_trips(spark, _drifting_files(spark, folder)).select(*DRIFTING)


@register(
    f"""{SQL_DRIFTING} select "column", type, target, cast(coalesce(sum(n), 0) as bigint) as changed from (
            values ('VendorID', 'int', 'int'), ('VendorID', 'bigint', 'int'), ('passenger_count', 'bigint', 'bigint'),
                   ('passenger_count', 'double', 'bigint'), ('passenger_count', 'int', 'bigint'), ('fare_amount', 'double', 'double'),
                   ('fare_amount', 'decimal(12,2)', 'double'), ('store_and_fwd_flag', 'string', 'string')
        ) as kinds("column", type, target) left join (
            select 'passenger_count' as c, 'double' as t, count(*) as n from drifting where passenger_count % 1 <> 0
        ) on c = "column" and t = type group by 1, 2, 3"""
)
def drifted_values(spark: SparkSession, folder: str) -> DataFrame:
    """How many values of each type found in the files the declared schema changes."""
    path = f"{_drifting_files(spark, folder)}/{readers.TRIP_FILES}"
    return drift_changes(spark, path, TRIPS).drop("files")


@register(f"with {SQL_ZONES} select * from zones")
def csv_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The zones as a CSV file with a header, read back by the declared schema."""
    path = work_folder(spark, "zones-csv")
    zones(spark, folder).write.csv(path, header=True)
    return readers.read_zones(spark, path)


@register("select * from orders where o_orderstatus <> 'F'")
def parquet_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of Parquet files replaced by others."""
    path, orders = work_folder(spark, "overwrite"), table(spark, folder, "orders")
    sinks.write_parquet(orders, path)
    sinks.write_parquet(orders.filter("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path)


@register(
    """select 'before' as step, false as present, 0::bigint as rows
       union all select 'written', true, count(*) from supplier
       union all select 'dropped', false, 0::bigint union all select 'with its namespace', false, 0::bigint"""
)
def table_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a catalog table is there before it is written, after it, after its drop and after that of its namespace."""
    name = "wayfare_steps.supplier"
    sinks.create_namespace(spark, "wayfare_steps", work_folder(spark, "steps"))
    sinks.drop_table(spark, name)
    steps = []

    def look(step: str) -> None:
        present = sinks.table_exists(spark, name)
        steps.append((step, present, spark.table(name).count() if present else 0))

    look("before")
    sinks.write_table(table(spark, folder, "supplier"), name)
    look("written")
    sinks.drop_table(spark, name)
    look("dropped")
    sinks.write_table(table(spark, folder, "supplier"), name)
    sinks.drop_namespace(spark, "wayfare_steps")
    look("with its namespace")
    return spark.createDataFrame(steps, "step string, present boolean, rows bigint")


@register(
    """select s_suppkey, s_name, not exists (select 1 from supplier t where t.s_suppkey = m + 1) as next_is_missing
       from supplier join (select max(s_suppkey) as m from supplier) on s_suppkey = m"""
)
def point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """One row by its key, and the error for a key that no row has."""
    suppliers = table(spark, folder, "supplier")
    last = suppliers.agg(F.max("s_suppkey")).first()[0]
    row = history.find_row(suppliers, "s_suppkey", last)
    try:
        history.find_row(suppliers, "s_suppkey", last + 1)
        missing = False
    except LookupError:
        missing = True
    return spark.createDataFrame([(row.s_suppkey, row.s_name, missing)], "s_suppkey bigint, s_name string, next_is_missing boolean")


@register(
    """select cast(column_index - 1 as integer) as position, column_name as "column",
              case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
                             when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' else data_type end as type,
              is_nullable as nullable
       from duckdb_columns() where table_name = 'lineitem'"""
)
def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    return profile.schema_rows(table(spark, folder, "lineitem"))


# --- values that do not fit -------------------------------------------------------------------------------------

SQL_FAULTY = f"""with {SQL_TRIPS}, faulty as (
    select * replace (case when VendorID = 1 then 1e8 when VendorID = 2 then 2e10 when VendorID = 3 then 3e10
                           else fare_amount end as fare_amount), VendorID = 4 as bad_count from trips)"""


def _faulty_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips with fares beyond the staged type, and beyond the hashed one, and counts that are no number."""
    vendor = F.col("VendorID")
    fare = F.when(vendor == 1, 1e8).when(vendor == 2, 2e10).when(vendor == 3, 3e10).otherwise(F.col("fare_amount"))
    count = F.when(vendor == 4, F.lit("four")).otherwise(F.col("passenger_count").cast("string"))
    return trips(spark, folder).withColumn("fare_amount", fare).withColumn("passenger_count", count)


@register(
    f"""{SQL_FAULTY} select case when VendorID in (1, 2, 3) then 'fare_amount' when bad_count then 'passenger_count' else '' end
        as unfit, count(*) as rows from faulty group by 1"""
)
def unfit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every raw row, staged or set aside, by the columns whose values do not fit."""
    fit, unfit = warehouse.split_unfit(_faulty_trips(spark, folder))
    names = unfit.select(F.array_join("unfit", ",").alias("unfit")).unionAll(fit.select(F.lit("").alias("unfit")))
    return names.groupBy("unfit").agg(F.count(F.lit(1)).alias("rows"))


@register(
    f"""{SQL_FAULTY} select 'passenger_count' as "column", count(*) as unreadable from faulty where bad_count"""
)
def unreadable_values(spark: SparkSession, folder: str) -> DataFrame:
    """Columns with values that their declared types can't hold."""
    return readers.unreadable_counts(_faulty_trips(spark, folder)).filter("unreadable > 0")


@register(
    f"""{SQL_FAULTY}, valid as (select distinct * from faulty where {SQL_VALID})
        select (fare_amount >= 1e8) as large, count(*) as rows from valid group by 1"""
)
def large_fares_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned trips with and without a fare beyond the hashed type: none merges with another."""
    faulty = _faulty_trips(spark, folder)
    return cleaning.clean_trips(faulty, **RULES).groupBy((F.col("fare_amount") >= 1e8).alias("large")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# --- profile ----------------------------------------------------------------------------------------------------


@register("select count(*) as total_rows, true as consistent from lineitem")
def partition_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all partitions together, and whether the balance report agrees with itself."""
    skew = profile.partition_skew(table(spark, folder, "lineitem"))
    mean = F.col("total_rows") / F.col("partitions")
    return skew.select(
        "total_rows",
        (
            (F.col("partitions") == F.col("populated_partitions") + F.col("empty_partitions"))
            & F.col("min_rows").cast("double").between(0, F.col("avg_rows"))
            & (F.col("max_rows") >= F.col("avg_rows"))
            & (F.abs(F.col("avg_rows") - mean) < 1e-9 * mean)
            & (F.abs(F.col("skew_ratio") - F.col("max_rows") / mean) < 1e-9)
        ).alias("consistent"),
    )


SQL_PLACED = """with counted as (select (l_linenumber + 1) % 10 as place, count(*) as n from lineitem group by 1),
    places as (select coalesce(n, 0) as n
               from (select unnest(range(0, (select max(place) + 1 from counted))) as place) left join counted using (place)),
    balance as (select cast(sum(n) as bigint) as total_rows, count(*) as partitions, count(*) filter (n > 0) as populated_partitions,
               count(*) filter (n = 0) as empty_partitions, min(n) as min_rows, max(n) as max_rows, avg(n) as avg_rows,
               avg(n) filter (n > 0) as avg_rows_populated, max(n) / avg(n) as skew_ratio from places)"""


def _placed_items(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in partitions that their line numbers name; the first two of them, and later ones, are empty."""
    return table(spark, folder, "lineitem").repartitionById(10, (F.col("l_linenumber") + 1).cast("int"))


@register(f"{SQL_PLACED} select * from balance")
def partition_skew(spark: SparkSession, folder: str) -> DataFrame:
    return profile.partition_skew(_placed_items(spark, folder))


@register(
    f"""{SQL_PLACED} select 'partitions' as "check", metric, value from (
            unpivot (select {", ".join(f"cast({c} as varchar) as {c}" for c in profile.BALANCE)} from balance)
            on {", ".join(profile.BALANCE)} into name metric value value)
        union all
        select 'schema', column_name,
               case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int' when 'DOUBLE' then 'double'
                              when 'VARCHAR' then 'string' when 'TIMESTAMP' then 'timestamp_ntz' else data_type end
               || case when is_nullable then ' null' else ' not null' end
        from duckdb_columns() where table_name = 'lineitem'"""
)
def data_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Partition balance and schema as one report."""
    items = _placed_items(spark, folder)
    return reports.combine(
        [
            reports.from_row(profile.partition_skew(items), "partitions"),
            reports.from_schema(profile.schema_rows(items), "schema"),
        ]
    )


# --- reports, plans and comparisons -----------------------------------------------------------------------------


@register(
    f"""with {SQL_TRIPS}, counts as (
            select count(*) as rows, count(VendorID) as vendors, count(passenger_count) as counted, count(store_and_fwd_flag) as flagged
            from trips)
        select 'Trips' as title, true as timed, 'columns' as "check", metric, cast(value as varchar) as value
        from (unpivot counts on rows, vendors, counted, flagged into name metric value value)"""
)
def saved_report(spark: SparkSession, folder: str) -> DataFrame:
    """A report of the trips as it was saved, with its title and time."""
    counts = {"vendors": "VendorID", "counted": "passenger_count", "flagged": "store_and_fwd_flag"}
    row = trips(spark, folder).agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(name) for name, c in counts.items()])
    saved = reports.write_report(reports.from_row(row, "columns"), work_folder(spark, "report"), "Trips")
    return saved.withColumn("timed", F.col("captured_at").isNotNull()).drop("captured_at")


SAMPLE_ROWS, SAMPLE_WIDTH = 10, 16


@register(
    f"""select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
            case when length(note) > {SAMPLE_WIDTH} then substr(note, 1, {SAMPLE_WIDTH - 3}) || '...' else note end as note
        from (select *, 'order ' || o_orderkey || ': ' || o_orderpriority as note from orders)
        order by o_totalprice desc, cast(o_orderkey as bigint) limit {SAMPLE_ROWS}"""
)
def sample_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The ten dearest orders as the text table shows them, long values cut; read back from its lines."""
    note = F.concat(F.lit("order "), F.col("o_orderkey").cast("string"), F.lit(": "), "o_orderpriority").alias("note")
    dearest = table(spark, folder, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_custkey", note)
    lines = reports.sample_text(dearest, SAMPLE_ROWS, SAMPLE_WIDTH).splitlines()
    names, *rows = [[cell.strip() for cell in line.split("|")[1:-1]] for line in lines if line.startswith("|")]
    return spark.createDataFrame(rows, ", ".join(f"{name} string" for name in names))


@register(
    f"""with {SQL_TRIPS}
        select 'vendor' as "check", cast(VendorID as varchar) as metric, cast(count(*) as varchar) as value from trips group by 2
        union all select 'zone', cast(PULocationID as varchar), cast(count(*) as varchar) from trips group by 2"""
)
def held_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Totals by vendor and by zone from trips that are held in memory meanwhile."""
    path = work_folder(spark, "totals")
    with held(trips(spark, folder).select("VendorID", "PULocationID")) as rows:
        totals = {name: rows.groupBy(column).count() for name, column in (("vendor", "VendorID"), ("zone", "PULocationID"))}
        report = reports.combine([reports.from_pairs(df, name) for name, df in totals.items()])
        reports.assert_plan_contains(report, "InMemoryTableScan")
        report.write.parquet(path)
    return spark.read.parquet(path)


@register(
    """select count(*) as rows, 5 as partitions, true as restored from lineitem"""
)
def scoped_settings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items shuffled into a number of partitions that holds for one block, and whether the former number is back."""
    path, name = work_folder(spark, "scoped"), "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with scoped_conf(spark, **{"spark.sql.adaptive.enabled": "false", name: 5}):
        orders = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
        orders.withColumn("part", F.spark_partition_id()).write.parquet(path)
    restored = F.lit(spark.conf.get(name) == before).alias("restored")
    written = spark.read.parquet(path)
    return written.agg(F.sum("n").alias("rows"), (F.max("part") + 1).alias("partitions")).withColumn("restored", restored)


def _written(df: DataFrame, purpose: str) -> DataFrame:
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _zoned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, Column]:
    """Trips and zones as written tables, whose plans hold nothing but their scans, and the condition that joins them."""
    rows = trips(spark, folder).select("VendorID", "PULocationID", "DOLocationID", "fare_amount", "tpep_pickup_datetime")
    return _written(rows, "fact"), _written(zones(spark, folder), "lookup"), F.col("PULocationID") == F.col("LocationID")


PLAN_OPERATORS = ("BroadcastHashJoin", "SortMergeJoin", "WindowGroupLimit", "HashAggregate", "CartesianProduct", "PushedFilters")


@register(
    f"""with {SQL_TRIPS}, {SQL_ZONES}, zoned as (select * from trips join zones on PULocationID = LocationID), plans as (
            select 'broadcast' as "check", ['BroadcastHashJoin', 'PushedFilters'] as there, (select count(*) from zoned) as n
            union all select 'merge', ['SortMergeJoin', 'PushedFilters'], (select count(*) from zoned)
            union all select 'first', ['WindowGroupLimit'], (select count(*) from (select distinct VendorID from trips))
            union all select 'dear', ['PushedFilters'], (select count(*) from trips where fare_amount >= {MIN_FARE})
            union all select 'pairs', ['HashAggregate'], (select count(*) from (select distinct PULocationID, DOLocationID from trips)))
        select "check", operator as metric, cast(list_contains(there, operator) as varchar) as value
        from plans, (select unnest({list(PLAN_OPERATORS)}) as operator)
        union all select "check", 'rows', cast(n as varchar) from plans"""
)
def plan_check(spark: SparkSession, folder: str) -> DataFrame:
    """Which operators the plans of five queries have, and the rows that each yields in a run without output."""
    rows, lookup, on = _zoned(spark, folder)
    first = Window.partitionBy("VendorID").orderBy("tpep_pickup_datetime")
    plans = {
        "broadcast": joins.lookup_join(rows, lookup, on),
        "merge": joins.merge_join(rows, lookup, on),
        "first": rows.withColumn("place", F.row_number().over(first)).filter("place = 1"),
        "dear": rows.filter(F.col("fare_amount") >= MIN_FARE),
        "pairs": ranking.pair_counts(rows),
    }
    counted = [reports.from_values(spark, name, {"rows": sinks.run_counted(df)[1]}) for name, df in plans.items()]
    return reports.combine([reports.plan_operators(plans, PLAN_OPERATORS, spark), *counted])


def _outcomes(report: DataFrame) -> DataFrame:
    """What a comparison found, without its times."""
    return report.filter(F.col("metric").rlike("(_rows|_in_plan|coalesced_files)$"))


@register(
    f"""with {SQL_TRIPS}, {SQL_ZONES}
        select 'join_strategy' as "check", metric, value from (
            values ('broadcast_in_plan', 'True'), ('sort_merge_in_plan', 'True')) as plans(metric, value)
        union all select 'join_strategy', unnest(['broadcast_rows', 'sort_merge_rows']), cast(count(*) as varchar)
        from trips join zones on PULocationID = LocationID"""
)
def join_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Broadcast against sort-merge join of trips and zones: the operators of their plans, and the rows of both."""
    return _outcomes(tuning.compare_joins(*_zoned(spark, folder), runs=1))


@register(
    f"""with {SQL_TRIPS} select 'shuffle_partitions' as "check", unnest(['default_rows', 'tuned_rows']) as metric,
            cast(count(*) as varchar) as value from (select distinct PULocationID, DOLocationID from trips)"""
)
def shuffle_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """The two-zone count with many and with few shuffle partitions: the rows of both."""
    return _outcomes(tuning.compare_shuffle_partitions(_zoned(spark, folder)[0], default=40, tuned=4, runs=1))


@register(
    f"""with {SQL_TRIPS}, pairs as (select count(*) as n from (select distinct PULocationID, DOLocationID from trips))
        select 'output_files' as "check", unnest(['plain_rows', 'coalesced_rows']) as metric, cast(n as varchar) as value from pairs
        union all select 'output_files', 'coalesced_files', '2'"""
)
def output_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """The two-zone count written as partitioned and as two files: the rows of both and the files of the latter."""
    return _outcomes(tuning.compare_output_files(_zoned(spark, folder)[0], partitions=6, files=2))
