"""Every query of the package over the fixture tables, with its SQL counterpart.

The SQL side is written independently, mostly with windows and joins where the Spark
side aggregates, so that agreement means something.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import fixtures, schemas
from fleetlake.functions.lines import parse_target_ids
from fleetlake.operators import contracts, fleet, matching, quality, reports, sketches
from fleetlake.operators.pick import keep_first
from fleetlake.oracle_views import with_views
from fleetlake.plans import backfill, compaction, daily, dedup, lineage, retention, tables
from fleetlake.plans.append import append, create_tables, idempotent_append
from fleetlake.plans.status import refresh_fleet_status
from fleetlake.session import scratch_path
from fleetlake.sources import files, snapshots
from fleetlake.sources.layers import Lake, read_silver, read_table
from fleetlake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, tuple[str, tuple[str, ...]]] = {}

# Parameters used on the fixture tables.
LINE = "click-10"
LINE_ID = 1003
TARGET_IDS = [1, 2, 3, 4]
DELAY_LINES = ["click-10", "view-10", "error-10"]
DAY = date(2024, 1, 15)
AS_OF = datetime(2024, 1, 31, 2)


def _query(sql: str, *views: str, name: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        _ORACLE[name or function.__name__] = (sql, views)
        return function

    return register


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql, *views) for name, (sql, views) in _ORACLE.items()}


# --- Fleet -----------------------------------------------------------------------


@_query("select * from fleet_status", "fleet_status")
def fleet_status(spark: SparkSession, folder: str) -> DataFrame:
    return fixtures.fleet_status(fixtures.events(spark, folder))


@_query(
    """
select vehicle_id, stop_id, predicted_at from (
  select *, row_number() over (partition by vehicle_id order by predicted_at asc nulls last, collected_at, id) as rn
  from predictions) t where rn = 1
""",
    "predictions",
)
def first_prediction(spark: SparkSession, folder: str) -> DataFrame:
    return fleet.first_prediction(fixtures.predictions(fixtures.events(spark, folder)))


@_query(
    """
select vehicle_id, lat, lon from (
  select *, row_number() over (partition by vehicle_id order by analyzed_at desc, id desc) as rn
  from fleet_status) t
where rn = 1 and lat is not null and lon is not null
""",
    "fleet_status",
)
def latest_position(spark: SparkSession, folder: str) -> DataFrame:
    return fleet.latest_position(fixtures.vehicle_track(fixtures.events(spark, folder)))


@_query(
    """
select vehicle_id, lat, lon from (
  select *, row_number() over (partition by vehicle_id order by analyzed_at desc, id desc) as rn
  from fleet_status where line_code = 'click-10') t
where rn = 1 and lat is not null and lon is not null
""",
    "fleet_status",
)
def latest_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return fleet.latest_position(fixtures.vehicle_track(fixtures.events(spark, folder)), LINE)


_STUCK = """
with r as (
  select *, row_number() over (partition by vehicle_id order by analyzed_at, id) as a,
    row_number() over (partition by vehicle_id order by analyzed_at desc, id desc) as z
  from fleet_status),
l as (
  select vehicle_id, line_code from (
    select vehicle_id, line_code, row_number() over (partition by vehicle_id order by analyzed_at, id) as k
    from fleet_status where line_code is not null) x where k = 1),
g as (
  select vehicle_id, min(analyzed_at) as t0, max(analyzed_at) as t1,
    max(case when a = 1 then lat end) as la, max(case when a = 1 then lon end) as lo,
    max(case when z = 1 then lat end) as lb, max(case when z = 1 then lon end) as lp
  from r group by vehicle_id),
k as (
  select *, 2 * 6371.009e0 * asin(least(1e0, sqrt(pow(sin(radians(lb - la) / 2), 2)
    + cos(radians(la)) * cos(radians(lb)) * pow(sin(radians(lp - lo) / 2), 2)))) as km
  from g),
stuck as (
  select k.vehicle_id, l.line_code, round(km, 6) as distance_km
  from k left join l on k.vehicle_id = l.vehicle_id
  where t1 > t0 + interval '10' minute and km < 0.1)
"""


@_query(_STUCK + "select * from stuck", "fleet_status")
def stuck_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    stuck = fleet.stuck_vehicles(fixtures.vehicle_track(fixtures.events(spark, folder)))
    return stuck.select("vehicle_id", "line_code", F.round("distance_km", 6).alias("distance_km"))


_LINE_JOIN = """
left join line_catalog l on split_part(r.line_code, '-', 1) = l.line_number
  and case when instr(r.line_code, '-') > 0 then try_cast(split_part(r.line_code, '-', 2) as bigint) else 10 end = l.line_suffix
"""


@_query(
    _STUCK
    + """
select r.line_code, r.n, coalesce(l.outbound_name || ' / ' || l.return_name, r.line_code) as line_name
from (select line_code, count(*) as n from stuck where line_code is not null group by line_code) r
"""
    + _LINE_JOIN,
    "fleet_status",
    "line_catalog",
)
def stuck_by_line(spark: SparkSession, folder: str) -> DataFrame:
    ev = fixtures.events(spark, folder)
    counted = fleet.count_by_line(fleet.stuck_vehicles(fixtures.vehicle_track(ev)), ordered=False)
    return fleet.enrich_line_names(counted, fixtures.line_catalog(ev))


_BUNCHED = """
with p as (
  select analyzed_at, line_code, vehicle_id, lat as la, lon as lo,
    lead(vehicle_id) over w as next_vehicle_id, lead(lat) over w as lb, lead(lon) over w as lp
  from fleet_status where line_code is not null and analyzed_at is not null
  window w as (partition by analyzed_at, line_code order by lat, lon, id)),
k as (
  select *, 1000 * 2 * 6371.009e0 * asin(least(1e0, sqrt(pow(sin(radians(lb - la) / 2), 2)
    + cos(radians(la)) * cos(radians(lb)) * pow(sin(radians(lp - lo) / 2), 2)))) as m
  from p where lb is not null),
bunched as (
  select analyzed_at, line_code, vehicle_id, next_vehicle_id, round(m, 3) as distance_m from k where m < 200)
"""


@_query(_BUNCHED + "select * from bunched", "fleet_status")
def bunched_events(spark: SparkSession, folder: str) -> DataFrame:
    found = fleet.bunched_events(fixtures.vehicle_track(fixtures.events(spark, folder)))
    return found.withColumn("distance_m", F.round("distance_m", 3))


@_query(_BUNCHED + "select line_code, count(*) as n from bunched group by line_code", "fleet_status")
def bunched_by_line(spark: SparkSession, folder: str) -> DataFrame:
    found = fleet.bunched_events(fixtures.vehicle_track(fixtures.events(spark, folder)))
    return fleet.count_by_line(found)


@_query(
    """
select r.line_code, r.n, coalesce(l.outbound_name || ' / ' || l.return_name, r.line_code) as line_name
from (select line_code, count(*) as n from fleet_status where line_code is not null group by line_code) r
"""
    + _LINE_JOIN,
    "fleet_status",
    "line_catalog",
)
def enrich_line_names(spark: SparkSession, folder: str) -> DataFrame:
    ev = fixtures.events(spark, folder)
    counted = fleet.count_by_line(fixtures.vehicle_track(ev), ordered=False)
    return fleet.enrich_line_names(counted, fixtures.line_catalog(ev))


@_query(
    _BUNCHED
    + """
select (select count(*) from fleet_status) as total_rows,
  (select count(distinct line_code) from fleet_status) as lines,
  (select count(*) from bunched) as bunching_events
""",
    "fleet_status",
)
def fleet_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return fleet.fleet_kpis(fixtures.vehicle_track(fixtures.events(spark, folder)))


@_query(
    "select distinct line_code from fleet_status where line_code is not null order by line_code",
    "fleet_status",
)
def line_list(spark: SparkSession, folder: str) -> DataFrame:
    return fleet.line_list(fixtures.vehicle_track(fixtures.events(spark, folder)))


# --- Reports ---------------------------------------------------------------------


@_query(
    """
with per_line as (
  select line_code, count(*) as total, count(next_stop_id) as with_prediction from fleet_status group by all)
select * from per_line qualify row_number() over (order by total desc, line_code nulls last) <= 20
""",
    "fleet_status",
)
def top_lines_by_volume(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_lines_by_volume(fixtures.fleet_status(fixtures.events(spark, folder)))


@_query(
    """
select line_code, count(*) as n,
  round(100e0 * sum(case when next_stop_id is not null then 1 else 0 end) / count(*), 6) as completeness_pct
from fleet_status where line_code is not null
group by line_code
""",
    "fleet_status",
)
def prediction_completeness(spark: SparkSession, folder: str) -> DataFrame:
    return reports.prediction_completeness(fixtures.fleet_status(fixtures.events(spark, folder)))


@_query(
    """
select line_code, round(avg(lat), 6) as avg_lat, round(avg(lon), 6) as avg_lon, count(*) as n
from fleet_status where line_code is not null group by line_code
""",
    "fleet_status",
)
def line_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return reports.rounded_centroids(fixtures.vehicle_track(fixtures.events(spark, folder)))


@_query(
    """
select vehicle_id, round(avg_lat, 6) as avg_lat, round(avg_lon, 6) as avg_lon, n,
  case when avg_lat > -23.57e0 and avg_lat < -23.55e0 and avg_lon > -46.65e0 and avg_lon < -46.55e0 then 'Centre'
    when avg_lon > -46.65e0 then 'East' else 'West' end as region
from (select vehicle_id, avg(lat) as avg_lat, avg(lon) as avg_lon, count(*) as n
  from fleet_status group by vehicle_id) t
""",
    "fleet_status",
)
def region_estimate(spark: SparkSession, folder: str) -> DataFrame:
    # Grouped by vehicle, because only then all three regions occur in the fixture.
    return reports.region_estimate(
        fixtures.vehicle_track(fixtures.events(spark, folder)), ["vehicle_id"]
    )


@_query(
    """
select line_code, round(avg(lat), 6) as avg_lat, round(avg(lon), 6) as avg_lon, count(*) as n
from fleet_status
where line_code is not null and lat is not null and lon is not null and position_at is not null
  and next_stop_id is not null and predicted_arrival is not null
group by line_code
""",
    "fleet_status",
)
def trusted_line_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return reports.trusted_line_metrics(fixtures.fleet_status(fixtures.events(spark, folder)))


@_query(
    """
with predicted as (
  select s.*, row_number() over (order by analyzed_at, id) as place
  from fleet_status s where next_stop_id is not null)
select analyzed_at, vehicle_id, line_code, next_stop_id, predicted_arrival from predicted where place <= 10
""",
    "fleet_status",
)
def sample_with_prediction(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sample_with_prediction(fixtures.fleet_status(fixtures.events(spark, folder)))


@_query(
    """
with newest as (
  select p.*, rank() over (partition by line_code order by collected_at desc, id desc) as age from positions p)
select id, collected_at, lat, lon, line_code from newest where age <= 50 and line_code = 'click-10'
""",
    "positions",
)
def recent_by_line(spark: SparkSession, folder: str) -> DataFrame:
    return reports.recent_by_line(fixtures.positions(fixtures.events(spark, folder)), LINE)


@_query(
    """
with newest as (
  select p.*, rank() over (partition by line_id order by collected_at desc, id desc) as age from predictions p)
select id, collected_at, stop_id, predicted_at from newest where age <= 50 and line_id = 1003
""",
    "predictions",
)
def recent_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return reports.recent_predictions(fixtures.predictions(fixtures.events(spark, folder)), LINE_ID)


@_query(
    """
select period,
  coalesce(avg(case when line_code = 'click-10' then delay_min end), 0) as click_10,
  coalesce(avg(case when line_code = 'view-10' then delay_min end), 0) as view_10,
  coalesce(avg(case when line_code = 'error-10' then delay_min end), 0) as error_10
from delays where period is not null group by period
""",
    "delays",
)
def delay_by_period_line(spark: SparkSession, folder: str) -> DataFrame:
    return reports.delay_by_period_line(fixtures.delays(fixtures.events(spark, folder)), DELAY_LINES)


@_query(
    """
with m as (select line_code, avg(delay_min) as d from delays group by line_code)
select (select round(avg(delay_min), 6) from delays) as mean_delay,
  (select line_code from m order by d desc, line_code limit 1) as worst_line,
  (select line_code from m order by d asc, line_code limit 1) as best_line
""",
    "delays",
)
def delay_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return reports.delay_kpis(fixtures.delays(fixtures.events(spark, folder)))


@_query("select day, round(avg(delay_min), 6) as mean_delay from delays group by day", "delays")
def delay_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.delay_trend(fixtures.delays(fixtures.events(spark, folder)))


_MATCH = """
with recent as (
  select * from positions where line_code = 'click-10' order by collected_at desc, id desc limit 50),
m as (
  select p.id, p.collected_at, e.ref_at, hour(p.collected_at) as our_hour, e.ref_hour,
    row_number() over (partition by p.id order by abs(e.ref_hour - hour(p.collected_at)), e.ord) as rn
  from recent p cross join external_times e)
"""


@_query(
    _MATCH
    + "select id, cast(our_hour as bigint) as our_hour, cast(ref_hour as bigint) as ref_hour from m where rn = 1",
    "positions",
    "external_times",
)
def external_time_match(spark: SparkSession, folder: str) -> DataFrame:
    recent = reports.recent_by_line(fixtures.positions(fixtures.events(spark, folder)), LINE)
    matched = matching.external_time_match(recent, fixtures.external_times(spark))
    return matched.select(
        "id", F.col("our_hour").cast("bigint"), F.col("ref_hour").cast("bigint")
    )


@_query(
    _MATCH
    + """
select count(g) as n, round(avg(g), 6) as mean, round(stddev_samp(g), 6) as std, min(g) as min,
  round(quantile_cont(g, 0.25), 6) as p25, round(quantile_cont(g, 0.5), 6) as p50,
  round(quantile_cont(g, 0.75), 6) as p75, max(g) as max, cast(count_if(g > 10) as bigint) as over_10
from (select abs(epoch(collected_at) - epoch(ref_at)) / 60e0 as g from m where rn = 1) t
""",
    "positions",
    "external_times",
)
def external_gap_stats(spark: SparkSession, folder: str) -> DataFrame:
    recent = reports.recent_by_line(fixtures.positions(fixtures.events(spark, folder)), LINE)
    return matching.external_gap_stats(
        matching.external_time_match(recent, fixtures.external_times(spark))
    )


# --- Quality ---------------------------------------------------------------------


def _tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    ev = fixtures.events(spark, folder)
    return {"positions": fixtures.positions(ev), "predictions": fixtures.predictions(ev)}


@_query(
    """
select table_name, count(*) as row_count from (
  select 'positions' as table_name from positions union all by name
  select 'predictions' as table_name from predictions union all by name
  select 'fleet_status' as table_name from fleet_status) t
group by table_name
""",
    "fleet_status",
)
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    status = fixtures.fleet_status(fixtures.events(spark, folder))
    return quality.table_counts({**_tables(spark, folder), "fleet_status": status})


@_query(
    """
select metric, value from (unpivot (select count(*) as positions_total,
    count(*) - count(line_code) as positions_line_code_null,
    count(*) - count(position_at) as positions_position_at_null
  from positions) on columns(*) into name metric value value)
union all
select metric, value from (unpivot (select count(*) as predictions_total,
    count(*) - count(stop_id) as predictions_stop_id_null,
    count(*) - count(predicted_at) as predictions_predicted_at_null
  from predictions) on columns(*) into name metric value value)
union all
select metric, value from (unpivot (select count(*) as fleet_status_total,
    count(*) - count(line_code) as fleet_status_line_code_null,
    count(*) - count(lat) as fleet_status_lat_null,
    count(*) - count(lon) as fleet_status_lon_null,
    count(*) - count(position_at) as fleet_status_position_at_null,
    count(*) - count(next_stop_id) as fleet_status_next_stop_id_null,
    count(*) - count(predicted_arrival) as fleet_status_predicted_arrival_null
  from fleet_status) on columns(*) into name metric value value)
""",
    "fleet_status",
)
def null_audit(spark: SparkSession, folder: str) -> DataFrame:
    tables = _tables(spark, folder)
    status = fixtures.fleet_status(fixtures.events(spark, folder))
    return quality.null_audit(
        {
            "positions": (tables["positions"], ["line_code", "position_at"]),
            "predictions": (tables["predictions"], ["stop_id", "predicted_at"]),
            "fleet_status": (
                status,
                ["line_code", "lat", "lon", "position_at", "next_stop_id", "predicted_arrival"],
            ),
        }
    )


@_query(
    """
select 'positions' as table_name, max(collected_at) is null as is_empty,
  max(collected_at) < timestamp '2024-01-31 02:00:00' - interval '60' minute as is_stale from positions
union all
select 'predictions', max(collected_at) is null,
  max(collected_at) < timestamp '2024-01-31 02:00:00' - interval '60' minute from predictions
""",
    "positions",
    "predictions",
)
def freshness_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.freshness(_tables(spark, folder), AS_OF)


@_query(
    """
with ranked as (
  select 'positions' as table_name, dense_rank() over (order by collected_at desc) as age from positions
  union all
  select 'predictions', dense_rank() over (order by collected_at desc) from predictions)
select table_name, count(*) as batch_rows from ranked where age = 1 group by table_name
""",
    "positions",
    "predictions",
)
def last_batch_check(spark: SparkSession, folder: str) -> DataFrame:
    return quality.last_batch(_tables(spark, folder))


@_query(
    """
select bronze, silver, round(abs(bronze - silver) * 100e0 / bronze, 1) as diff_pct,
  abs(bronze - silver) * 100e0 / bronze <= 5 as passed
from (select count(*) as bronze from positions) b,
  (select count(*) as silver from (select distinct collected_at, vehicle_id from positions) d) s
""",
    "positions",
)
def reconcile_layers(spark: SparkSession, folder: str) -> DataFrame:
    # Silver is compacted without duplicates, so it holds fewer rows than bronze.
    bronze, silver = _compacted(spark, folder, drop_duplicates=True)
    return quality.reconcile(bronze, read_table(spark, silver, "positions"))


@_query(
    """
select b.dt, bronze, silver, round(abs(bronze - silver) * 100e0 / bronze, 1) as diff_pct,
  abs(bronze - silver) * 100e0 / bronze <= 5 as passed
from (select cast(collected_at as date) as dt, count(*) as bronze from positions group by 1) b
join (select cast(collected_at as date) as dt, count(*) as silver
  from (select distinct collected_at, vehicle_id from positions) d group by 1) s on b.dt = s.dt
""",
    "positions",
)
def reconcile_layers_by_day(spark: SparkSession, folder: str) -> DataFrame:
    bronze, silver = _compacted(spark, folder, drop_duplicates=True)
    bronze = bronze.withColumn("dt", F.to_date("collected_at"))
    return quality.reconcile(bronze, read_table(spark, silver, "positions"), by_day=True)


@_query(
    """
select count(*) as total, cast(sum(case when collected_at is not null and vehicle_id > 0
  and (line_code is null or length(line_code) <= 20)
  and lat between -90 and 90 and lon between -180 and 180 then 1 else 0 end) as bigint) as valid
from positions
""",
    "positions",
)
def contract_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = fixtures.positions(fixtures.events(spark, folder))
    return contracts.contract_summary(rows, contracts.position_rules())


@_query(
    """
select count(*) as total, cast(sum(case when collected_at is not null and line_id > 0 and vehicle_id > 0
  and (predicted_at is null or length(predicted_at) <= 30) then 1 else 0 end) as bigint) as valid
from predictions
""",
    "predictions",
)
def contract_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = fixtures.predictions(fixtures.events(spark, folder))
    return contracts.contract_summary(rows, contracts.prediction_rules())


@_query(
    """
select count(*) as total, cast(count_if(regexp_matches(dt, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')) as bigint) as valid
from (select case when position_at is null then strftime(collected_at, '%d-%m-%Y')
    else strftime(collected_at, '%Y-%m-%d') end as dt
  from positions) t
""",
    "positions",
)
def contract_silver_dt(spark: SparkSession, folder: str) -> DataFrame:
    # Rows without a GPS time carry their day in the wrong order.
    rows = fixtures.positions(fixtures.events(spark, folder))
    day = F.when(
        F.col("position_at").isNull(), F.date_format("collected_at", "dd-MM-yyyy")
    ).otherwise(F.date_format("collected_at", "yyyy-MM-dd"))
    return contracts.contract_summary(
        rows.withColumn("dt", day), contracts.silver_rules(contracts.position_rules())
    )


@_query(
    """
select id,
  case when vehicle_id > 5 then '' else 'vehicle;' end ||
  case when lat between -23.56e0 and 90e0 then '' else 'lat;' end ||
  case when line_code is null or length(line_code) <= 9 then '' else 'line;' end as reasons
from positions
where not (vehicle_id > 5 and lat between -23.56e0 and 90e0 and (line_code is null or length(line_code) <= 9))
""",
    "positions",
)
def contract_rejects(spark: SparkSession, folder: str) -> DataFrame:
    # Tighter limits than the contract's, which no fixture row breaks.
    rules = contracts.position_rules(min_vehicle=6, lat_range=(-23.56, 90.0), max_line_length=9)
    rows = fixtures.positions(fixtures.events(spark, folder))
    return contracts.rejects(rows, rules).select("id", "reasons")


# --- Ingestion -------------------------------------------------------------------


@_query("select * exclude (id) from positions", "positions")
def flatten_positions(spark: SparkSession, folder: str) -> DataFrame:
    landed = fixtures.as_json(fixtures.position_snapshots(fixtures.events(spark, folder)))
    parsed = landed.select(F.from_json("value", schemas.POSITION_SNAPSHOT).alias("doc")).select("doc.*")
    return snapshots.flatten_positions(parsed).drop("ordinal", "unreadable")


@_query("select * exclude (id) from predictions", "predictions")
def flatten_predictions(spark: SparkSession, folder: str) -> DataFrame:
    landed = fixtures.as_json(fixtures.prediction_snapshots(fixtures.events(spark, folder)))
    parsed = landed.select(F.from_json("value", schemas.PREDICTION_SNAPSHOT).alias("doc")).select("doc.*")
    return snapshots.flatten_predictions(parsed).drop("ordinal", "unreadable")


@_query("select * exclude (id) from positions", "positions")
def flatten_indented(spark: SparkSession, folder: str) -> DataFrame:
    # Every collection is one file; half of them are written over several lines, as one array.
    path = scratch_path(spark, "indented")
    landed = fixtures.position_snapshots(fixtures.events(spark, folder))
    plain = F.hour("collected_at") % 2 == 0
    fixtures.as_json(landed.where(plain)).write.text(f"{path}/lines")
    arrays = landed.where(~plain).groupBy("collected_at").agg(F.collect_list(F.struct("*")).alias("all"))
    options = {"ignoreNullFields": "false", "pretty": "true"}
    arrays.select(F.to_json("all", options).alias("value"), F.col("collected_at").alias("hour")).write.partitionBy("hour").text(f"{path}/arrays")
    read = [snapshots.read_position_snapshots(spark, f"{path}/{kind}", whole_files=True) for kind in ("lines", "arrays")]
    return snapshots.flatten_positions(read[0].unionByName(read[1].select(*read[0].columns))).drop("ordinal", "unreadable")


@_query(
    """
select p.id from positions p
where exists (select 1 from line_catalog l where l.line_id <= 4
  and l.line_number || '-' || cast(l.line_suffix as varchar(9)) = p.line_code)
""",
    "positions",
    "line_catalog",
)
def filter_target_lines(spark: SparkSession, folder: str) -> DataFrame:
    ev = fixtures.events(spark, folder)
    codes = snapshots.target_codes(fixtures.line_catalog(ev), TARGET_IDS)
    return snapshots.filter_target_lines(fixtures.positions(ev), codes).select("id")


@_query(
    """
select id from positions
where cast(position_at as time) between time '05:00:00' and time '23:00:00'
""",
    "positions",
)
def operating_hours(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.operating_hours(fixtures.positions(fixtures.events(spark, folder))).select("id")


@_query(
    """
select distinct collected_at, line_id, vehicle_id, stop_id, predicted_at from predictions
where stop_id is not null and predicted_at is not null
union all
select collected_at, line_id, vehicle_id, stop_id, predicted_at from predictions
where stop_id is null or predicted_at is null
""",
    "predictions",
)
def stream_ingest_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, "predictions").select(*schemas.PREDICTIONS_KEY)


@_query(
    """
select distinct collected_at, vehicle_id from positions
where cast(collected_at as time) between time '05:00:00' and time '23:00:00'
""",
    "positions",
    name="stream_ingest",
)
def stream_ingest_positions(spark: SparkSession, folder: str) -> DataFrame:
    # Which copy of a key arrives first is not defined, so only the key is compared.
    return _streamed(spark, folder, "positions").select(*schemas.POSITIONS_KEY)


def _streamed(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The fixture rows, landed as JSON files and taken in by the stream."""
    nest = {"positions": fixtures.position_snapshots, "predictions": fixtures.prediction_snapshots}
    root = scratch_path(spark, f"stream_{table}")
    fixtures.as_json(nest[table](fixtures.events(spark, folder))).write.text(f"{root}/landing")
    lake = Lake(f"{root}/lake")
    ingest.stream_ingest(spark, f"{root}/landing", lake, f"{root}/checkpoint", table)
    return read_table(spark, lake.path("bronze", table), table)


@_query(
    """
select distinct collected_at, vehicle_id from positions
where cast(collected_at as time) between time '05:00:00' and time '23:00:00'
""",
    "positions",
)
def stream_then_batch(spark: SparkSession, folder: str) -> DataFrame:
    # The stream takes the even hours, the batch collector everything.
    root = scratch_path(spark, "shared")
    lake = Lake(f"{root}/lake")
    landed = fixtures.position_snapshots(fixtures.events(spark, folder))
    fixtures.as_json(landed.where(F.hour("collected_at") % 2 == 0)).write.text(f"{root}/even")
    fixtures.as_json(landed).write.text(f"{root}/all")
    ingest.stream_ingest(spark, f"{root}/even", lake, f"{root}/checkpoint", "positions")
    rows = snapshots.flatten_positions(snapshots.read_position_snapshots(spark, f"{root}/all"))
    daily.collect(spark, lake, "positions", rows, AS_OF)
    return read_table(spark, lake.path("bronze", "positions"), "positions").select(*schemas.POSITIONS_KEY)


@_query(
    """
select count(*) as landed, max(collected_at) as newest,
  count(distinct (collected_at, vehicle_id)) filter (where hour(collected_at) >= 5) as added,
  count(*) filter (where hour(collected_at) < 5) as outside_hours
from positions
""",
    "positions",
)
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    # Several landed files, two in a micro-batch; batches are added up.
    root = scratch_path(spark, "progress")
    landed = fixtures.as_json(fixtures.position_snapshots(fixtures.events(spark, folder)))
    landed.repartition(6).write.text(f"{root}/landing")
    lake = Lake(f"{root}/lake")
    ingest.stream_ingest(spark, f"{root}/landing", lake, f"{root}/checkpoint", "positions", max_files=2)
    batches = ingest.stream_progress(spark, lake, "positions")
    return batches.agg(
        *[F.sum(c).alias(c) for c in ("landed", "added", "outside_hours")], F.max("newest").alias("newest")
    )


@_query(
    """
select reasons, count(*) as n from (
  select case when id % 7 = 0 then 'vehicle;' else '' end || case when id % 5 = 0 then 'lat;' else '' end ||
    case when id % 11 = 0 then 'unreadable;' else '' end as reasons from positions) t
where reasons <> '' group by reasons
""",
    "positions",
)
def quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    # Every seventh, fifth and eleventh row is spoilt.
    lake = Lake(scratch_path(spark, "lake"))
    rows = fixtures.positions(fixtures.events(spark, folder)).withColumns(
        {
            "vehicle_id": F.when(F.col("id") % 7 == 0, -F.col("vehicle_id")).otherwise(F.col("vehicle_id")),
            "lat": F.when(F.col("id") % 5 == 0, F.lit(200.0)).otherwise(F.col("lat")),
            "unreadable": F.when(F.col("id") % 11 == 0, "position_at"),
            "ordinal": F.col("id"),
        }
    )
    daily.store_batch(spark, lake, "positions", rows, "spoilt")
    refused = spark.read.parquet(daily.quarantine_path(lake, "positions", "spoilt"))
    return refused.groupBy("reasons").agg(F.count("*").alias("n"))


@_query("select collected_at, count(*) as delivered from positions group by collected_at", "positions")
def collection_counts(spark: SparkSession, folder: str) -> DataFrame:
    landed = fixtures.as_json(fixtures.position_snapshots(fixtures.events(spark, folder)))
    parsed = landed.select(F.from_json("value", schemas.POSITION_SNAPSHOT).alias("doc")).select("doc.*")
    return snapshots.delivered(parsed, "l").groupBy("collected_at").agg(F.sum("delivered").alias("delivered"))


# --- Lake ------------------------------------------------------------------------


def _compacted(
    spark: SparkSession, folder: str, day: date | None = None, drop_duplicates: bool = False
) -> tuple[DataFrame, str]:
    """The positions and the path of a silver table compacted from them."""
    rows = fixtures.positions(fixtures.events(spark, folder))
    silver = scratch_path(spark, "silver")
    compaction.compact(rows, silver, "positions", day, drop_duplicates)
    return rows, silver


@_query("select * from positions", "positions", name="read_silver")
def read_silver_table(spark: SparkSession, folder: str) -> DataFrame:
    _, silver = _compacted(spark, folder)
    return read_silver(spark, silver, "positions")


@_query(
    """
select id, vehicle_id, line_code, lat, lon from positions where cast(collected_at as date) = date '2024-01-15'
""",
    "positions",
)
def compact_day(spark: SparkSession, folder: str) -> DataFrame:
    _, silver = _compacted(spark, folder, DAY)
    return read_silver(spark, silver, "positions").select("id", "vehicle_id", "line_code", "lat", "lon")


@_query("select cast(collected_at as date) as dt, count(*) as n from positions group by 1", "positions")
def compact_counts(spark: SparkSession, folder: str) -> DataFrame:
    _, silver = _compacted(spark, folder)
    return compaction.partition_counts(spark, silver, "positions")


@_query(
    """
select min(id) as id, collected_at, line_id, vehicle_id, stop_id, predicted_at
from predictions_dup
group by collected_at, line_id, vehicle_id, stop_id, predicted_at
""",
    "predictions_dup",
)
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = fixtures.predictions_dup(fixtures.events(spark, folder))
    return keep_first(rows, schemas.PREDICTIONS_KEY, ["id"])


@_query(
    """
select id from (
  select id, stop_id, predicted_at, row_number() over (
    partition by collected_at, line_id, vehicle_id, stop_id, predicted_at order by id) as rn
  from predictions_dup) t
where rn = 1 or stop_id is null or predicted_at is null
""",
    "predictions_dup",
    name="idempotent_append",
)
def idempotent_append_rows(spark: SparkSession, folder: str) -> DataFrame:
    # The second batch repeats keys of the first.
    ev = fixtures.events(spark, folder)
    path = scratch_path(spark, "bronze")
    idempotent_append(fixtures.predictions(ev), path, "predictions")
    idempotent_append(fixtures.prediction_copies(ev), path, "predictions")
    return read_table(spark, path, "predictions").select("id")


@_query(
    """
select 'positions' as table_name, count(*) as source_rows,
  (select count(*) from (select distinct collected_at, vehicle_id from positions) d) as target_rows
from positions
union all
select 'predictions', count(*), cast(sum(case when rn = 1 or stop_id is null or predicted_at is null then 1 else 0 end) as bigint)
from (
  select stop_id, predicted_at, row_number() over (
    partition by collected_at, line_id, vehicle_id, stop_id, predicted_at order by id) as rn
  from predictions_dup) t
""",
    "positions",
    "predictions_dup",
)
def backfill_counts(spark: SparkSession, folder: str) -> DataFrame:
    ev = fixtures.events(spark, folder)
    sources = {"positions": fixtures.positions(ev), "predictions": fixtures.predictions_dup(ev)}
    return backfill.backfill(spark, sources, Lake(scratch_path(spark, "lake")))


@_query(
    """
select id from (
  select id, stop_id, predicted_at, row_number() over (
    partition by collected_at, line_id, vehicle_id, stop_id, predicted_at order by id) as rn
  from predictions_dup) t
where rn = 1 or stop_id is null or predicted_at is null
""",
    "predictions_dup",
)
def backfill_resumed(spark: SparkSession, folder: str) -> DataFrame:
    # The first call ends after two slices, the second goes on.
    sources = {"predictions": fixtures.predictions_dup(fixtures.events(spark, folder))}
    lake = Lake(scratch_path(spark, "lake"))
    backfill.backfill(spark, sources, lake, slice_days=7, at_most=2)
    backfill.backfill(spark, sources, lake, slice_days=7)
    return read_table(spark, lake.path("bronze", "predictions"), "predictions").select("id")


@_query(
    """
select 'positions' as table_name, cast(count(*) as bigint) as to_remove from positions
where collected_at < (select max(collected_at) - interval '7' day from positions)
union all
select 'predictions', count(*) from predictions
where collected_at < (select max(collected_at) - interval '7' day from predictions)
""",
    "positions",
    "predictions",
)
def retention_dry_run(spark: SparkSession, folder: str) -> DataFrame:
    return retention.dry_run(_tables(spark, folder))


@_query(
    """
select id from positions
where collected_at >= (select max(collected_at) - interval '7' day from positions)
""",
    "positions",
)
def retention_apply(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    append(fixtures.positions(fixtures.events(spark, folder)), path, "positions")
    newest = read_table(spark, path, "positions").agg(F.max("collected_at")).first()[0]
    if newest is not None:
        retention.purge(spark, path, "positions", newest - timedelta(days=retention.KEEP_DAYS))
    return read_table(spark, path, "positions").select("id")


@_query(
    """
select asset_name, layer, row_count, status, run_timestamp from lineage_audit
order by run_timestamp desc, id desc limit 10
""",
    "lineage_audit",
)
def lineage_recent(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.recent_runs(fixtures.lineage_audit(fixtures.events(spark, folder)))


@_query(
    """
select asset_name, layer, row_count, status, run_timestamp from (
  select *, row_number() over (partition by asset_name order by run_timestamp desc, id desc) as rn
  from lineage_audit) t
where rn = 1
""",
    "lineage_audit",
)
def lineage_last_per_asset(spark: SparkSession, folder: str) -> DataFrame:
    return lineage.last_run_per_asset(fixtures.lineage_audit(fixtures.events(spark, folder)))


def _late_lake(spark: SparkSession, folder: str) -> Lake:
    """A lake whose positions came in two parts, with a compaction between, then purged."""
    lake = Lake(scratch_path(spark, "lake"))
    rows = fixtures.positions(fixtures.events(spark, folder))
    bronze = lake.path("bronze", "positions")
    append(rows.where("id % 3 <> 0"), bronze, "positions")
    daily.compact_day(spark, lake, "positions", DAY, AS_OF)
    append(rows.where("id % 3 = 0"), bronze, "positions")
    daily.purge_table(spark, lake, "positions", AS_OF)
    return lake


@_query("select id from positions", "positions")
def daily_chain(spark: SparkSession, folder: str) -> DataFrame:
    lake = _late_lake(spark, folder)
    return read_table(spark, lake.path("silver", "positions"), "positions").select("id")


@_query("select id from positions where collected_at >= timestamp '2024-01-24 02:00:00'", "positions")
def purge_archived(spark: SparkSession, folder: str) -> DataFrame:
    lake = _late_lake(spark, folder)
    return read_table(spark, lake.path("bronze", "positions"), "positions").select("id")


@_query(
    """
select distinct collected_at, line_id, vehicle_id, stop_id, predicted_at from predictions_dup
where stop_id is not null and predicted_at is not null
union all
select collected_at, line_id, vehicle_id, stop_id, predicted_at from predictions_dup
where stop_id is null or predicted_at is null
""",
    "predictions_dup",
)
def backfill_without_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = fixtures.predictions_dup(fixtures.events(spark, folder)).drop("id")
    lake = Lake(scratch_path(spark, "lake"))
    backfill.backfill(spark, {"predictions": rows}, lake, ["collected_at"])
    return read_table(spark, lake.path("bronze", "predictions"), "predictions").select(*schemas.PREDICTIONS_KEY)


@_query(
    """
select min(id) as id from predictions_dup
group by collected_at, line_id, vehicle_id, stop_id, predicted_at
""",
    "predictions_dup",
)
def dedup_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    append(fixtures.predictions_dup(fixtures.events(spark, folder)), path, "predictions")
    dedup.remove_duplicates(spark, path, "predictions")
    return read_table(spark, path, "predictions").select("id")


@_query(
    """
select cast(c.day as date) as day, round(avg(d.delay_min), 6) as mean_delay
from (select unnest(generate_series(date '2024-01-10', date '2024-02-08', interval 1 day)) as day) c
left join delays d on d.day = c.day group by c.day
""",
    "delays",
)
def delay_trend_over(spark: SparkSession, folder: str) -> DataFrame:
    calendar = reports.day_calendar(spark, date(2024, 1, 10), 30)
    return reports.delay_trend_over(fixtures.delays(fixtures.events(spark, folder)), calendar)


@_query("select * from fleet_status", "fleet_status")
def stored_fleet_status(spark: SparkSession, folder: str) -> DataFrame:
    ev = fixtures.events(spark, folder)
    lake = Lake(scratch_path(spark, "lake"))
    append(fixtures.positions(ev), lake.path("bronze", "positions"), "positions")
    append(fixtures.predictions(ev), lake.path("bronze", "predictions"), "predictions")
    refresh_fleet_status(spark, lake)
    return read_table(spark, lake.path("bronze", "fleet_status"), "fleet_status").drop("dt")


@_query(
    """
select count(*) as total, cast(count_if(line_id > 0 and vehicle_id > 0
  and (predicted_at is null or length(predicted_at) <= 30) and regexp_matches(dt, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$'))
  as bigint) as valid
from (select *, case when stop_id is null then strftime(collected_at, '%d-%m-%Y')
    else strftime(collected_at, '%Y-%m-%d') end as dt
  from predictions) t
""",
    "predictions",
)
def contract_silver_predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = fixtures.predictions(fixtures.events(spark, folder))
    day = F.when(F.col("stop_id").isNull(), F.date_format("collected_at", "dd-MM-yyyy")).otherwise(
        F.date_format("collected_at", "yyyy-MM-dd")
    )
    return contracts.contract_summary(
        rows.withColumn("dt", day), contracts.silver_rules(contracts.prediction_rules())
    )


# --- Named tables ----------------------------------------------------------------


def _database(spark: SparkSession, root: str) -> str:
    """A database of its own for the tables below ``root``."""
    name = "lake_" + "".join(c if c.isalnum() else "_" for c in root.rsplit("/", 1)[-1])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name


@_query("select id, dt from (select id, cast(collected_at as date) as dt from positions) t", "positions")
def named_compaction(spark: SparkSession, folder: str) -> DataFrame:
    # A third of the rows comes late; days are replaced by name while their folders stay.
    path = scratch_path(spark, "silver")
    rows = fixtures.positions(fixtures.events(spark, folder))
    name = f"{_database(spark, path)}.positions"
    append(rows.where("id % 3 <> 0"), path, "positions")
    tables.register(spark, name, "positions", path)
    tables.compact_into(rows, name, "positions")
    return spark.table(name).select("id", "dt")


@_query(
    "select * from fleet_status where next_stop_id is not null union all select * from fleet_status where id % 2 = 0",
    "fleet_status",
)
def named_replacement(spark: SparkSession, folder: str) -> DataFrame:
    # The whole table is replaced by fewer rows, then rows are appended to days that have moved.
    path = scratch_path(spark, "status")
    rows = fixtures.fleet_status(fixtures.events(spark, folder))
    name = f"{_database(spark, path)}.fleet_status"
    tables.register(spark, name, "fleet_status", path)
    tables.append_rows(rows.where("id % 5 = 0"), name, "fleet_status")
    tables.replace_all(rows.where("next_stop_id is not null"), name, "fleet_status")
    tables.append_rows(rows.where("id % 2 = 0"), name, "fleet_status")
    tables.remove_unused(spark, name, keep_hours=0)
    return spark.table(name).drop("dt")


@_query(
    """
select 'positions' as table_name, cast(collected_at as date) as dt, count(*) as n from positions group by 2
union all select 'predictions', cast(collected_at as date), count(*) from predictions group by 2
union all select 'fleet_status', cast(analyzed_at as date), count(*) from fleet_status where id % 2 = 0 group by 2
union all select 'lineage_audit', cast(run_timestamp as date), count(*) from lineage_audit group by 2
""",
    "positions",
    "predictions",
    "fleet_status",
    "lineage_audit",
)
def created_tables(spark: SparkSession, folder: str) -> DataFrame:
    # The tables are created over an empty lake and once more over the written one.
    ev, root = fixtures.events(spark, folder), scratch_path(spark, "created")
    lake, database = Lake(root), _database(spark, root)
    create_tables(spark, root, database)
    append(fixtures.positions(ev), lake.path("bronze", "positions"), "positions")
    append(fixtures.predictions(ev), lake.path("bronze", "predictions"), "predictions")
    append(fixtures.fleet_status(ev).where("id % 2 = 0"), lake.path("bronze", "fleet_status"), "fleet_status")
    append(fixtures.lineage_audit(ev), daily.audit_path(lake), "lineage_audit")
    counts = [
        spark.table(name).groupBy("dt").agg(F.count("*").alias("n")).select(F.lit(name.split(".")[1]).alias("table_name"), "dt", "n")
        for name in create_tables(spark, root, database)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


# --- Files and the whole chain ---------------------------------------------------


@_query(
    """
select p.line_code, c.outbound_name, c.return_name, count(*) as n
from line_catalog c join positions p on p.line_code = c.line_number || '-' || cast(c.line_suffix as varchar(9))
where c.line_id in (1, 2, 3, 4) group by 1, 2, 3
""",
    "positions",
    "line_catalog",
)
def catalog_names(spark: SparkSession, folder: str) -> DataFrame:
    # The catalogue is a file whose columns have other names and another order.
    ev, path = fixtures.events(spark, folder), scratch_path(spark, "catalog")
    names = {"nome_ida": "outbound_name", "numero": "line_number", "codigo": "line_id"}
    written = fixtures.line_catalog(ev).withColumnsRenamed({v: k for k, v in names.items()})
    written.select("nome_ida", "return_name", "numero", "codigo", "line_suffix").write.csv(path, header=True)
    catalog = files.read_catalog(spark, path, names=names)
    wanted = catalog.where(F.col("line_id").isin(parse_target_ids("1, 2,3 ,4")))
    code = F.concat_ws("-", "line_number", "line_suffix").alias("line_code")
    rows = fixtures.positions(ev).groupBy("line_code").agg(F.count("*").alias("n"))
    return rows.join(wanted.select(code, "outbound_name", "return_name"), "line_code")


@_query(
    """
select line_code, n, prediction_share * 100 as completeness_pct from (
  select line_code, count(*) as n, count(next_stop_id) / cast(count(*) as double) as prediction_share
  from fleet_status where line_code is not null group by line_code) t
""",
    "fleet_status",
)
def completeness_report(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "report")
    status = fixtures.fleet_status(fixtures.events(spark, folder)).where("line_code is not null")
    status.groupBy("line_code").agg(
        F.count("*").alias("n"), (F.count("next_stop_id") / F.count("*")).alias("prediction_share")
    ).write.csv(path, sep="|")
    return files.read_completeness_report(spark, path)


@_query("select id, collected_at, vehicle_id, line_code, lat, lon, position_at from positions", "positions")
def gps_export(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "gps")
    rows = fixtures.positions(fixtures.events(spark, folder))
    marked = F.date_format("position_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rows.withColumn("position_at", marked).write.csv(path, sep="|")
    return files.read_gps_sample(spark, path)


@_query(
    """
select line_code, round(avg(lat), 6) as avg_lat, round(avg(lon), 6) as avg_lon, count(*) as n
from fleet_status
where line_code = 'click-10' and lat is not null and lon is not null and position_at is not null
  and next_stop_id is not null and predicted_arrival is not null
group by line_code
""",
    "fleet_status",
)
def one_line_metrics(spark: SparkSession, folder: str) -> DataFrame:
    status = fixtures.fleet_status(fixtures.events(spark, folder))
    return reports.one_line(reports.trusted_line_metrics(status), LINE)


@_query(
    """
select 'refused' as kind, id from positions where id % 13 = 0 or id % 17 = 0
union all
select 'stored', min(id) from positions where id % 13 <> 0 and id % 17 <> 0 group by collected_at, vehicle_id
""",
    "positions",
)
def incomplete_rows(spark: SparkSession, folder: str) -> DataFrame:
    # Every 13th row lacks its vehicle, every 17th its time.
    path, refused = scratch_path(spark, "bronze"), scratch_path(spark, "refused")
    rows = fixtures.positions(fixtures.events(spark, folder)).withColumns(
        {
            "vehicle_id": F.when(F.col("id") % 13 != 0, F.col("vehicle_id")),
            "collected_at": F.when(F.col("id") % 17 != 0, F.col("collected_at")),
        }
    )
    idempotent_append(rows, path, "positions", quarantine=refused)
    stored = read_table(spark, path, "positions").select(F.lit("stored").alias("kind"), "id")
    return stored.unionByName(spark.read.parquet(refused).select(F.lit("refused").alias("kind"), "id"))


_CHAIN = """
with kept as (
  select 'positions' as table_name, collected_at from (
    select distinct p.collected_at, p.vehicle_id from positions p
    join (select line_number || '-' || cast(line_suffix as varchar(9)) as code from line_catalog where line_id <= 4) c
      on c.code = p.line_code
    where cast(p.collected_at as time) between time '05:00:00' and time '23:00:00') a
  union all
  select 'predictions', collected_at from (
    select distinct collected_at, line_id, vehicle_id, stop_id, predicted_at from predictions
    where stop_id is not null and predicted_at is not null
    union all
    select collected_at, line_id, vehicle_id, stop_id, predicted_at from predictions
    where stop_id is null or predicted_at is null) b),
steps as (
  select table_name, 'collected' as step, count(*) as n from kept group by 1
  union all
  select table_name, 'compacted', count_if(cast(collected_at as date) = date '2024-01-15') from kept group by 1
  union all
  select table_name, 'late', count_if(cast(collected_at as date) <> date '2024-01-15') from kept group by 1
  union all
  select table_name, 'purged', count_if(collected_at < timestamp '2024-01-24 02:00:00') from kept group by 1)
"""


@_query(
    f"""{_CHAIN},
kinds(step, asset, layer) as (
  values ('collected', 'collect', 'bronze'), ('compacted', 'compact', 'silver'), ('late', 'compact', 'silver'),
    ('purged', 'purge', 'bronze'))
select 'returned' as origin, table_name, step as name, null as layer, cast(n as bigint) as n, null as status,
  null as run_timestamp
from steps
union all
select 'audit', table_name, asset || '_' || table_name, layer, n, 'ok', timestamp '2024-01-31 02:00:00'
from steps join kinds on kinds.step = steps.step where n > 0 or asset = 'collect'
union all
select 'audit', t, 'reconcile_' || t, 'silver', 0, 'ok', timestamp '2024-01-31 02:00:00'
from (values ('positions'), ('predictions')) checked(t)
""",
    "positions",
    "predictions",
    "line_catalog",
)
def run_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    # The whole chain from landed files to the purge: the counts it returns, and its audit rows.
    ev, root = fixtures.events(spark, folder), scratch_path(spark, "chain")
    fixtures.as_json(fixtures.position_snapshots(ev)).write.text(f"{root}/positions")
    fixtures.as_json(fixtures.prediction_snapshots(ev)).write.text(f"{root}/predictions")
    lake = Lake(f"{root}/lake")
    catalog = fixtures.line_catalog(ev)
    landing = f"{root}/positions", f"{root}/predictions"
    done = daily.run_daily(spark, lake, DAY, AS_OF, *landing, catalog, TARGET_IDS)
    counts = [("returned", table, step, n) for table, steps in done.items() for step, n in steps.items()]
    returned = spark.createDataFrame(counts, "origin string, table_name string, name string, n long")
    audit = read_table(spark, daily.audit_path(lake), "lineage_audit").select(
        F.lit("audit").alias("origin"),
        "table_name",
        F.col("asset_name").alias("name"),
        "layer",
        F.col("row_count").alias("n"),
        "status",
        "run_timestamp",
    )
    return returned.unionByName(audit, allowMissingColumns=True)


@_query(
    """
select 'vehicle_id' as name, count(*) as n, count(distinct vehicle_id) as distinct_exact, true as near
from positions where collected_at < timestamp '2024-01-20 00:00:00'
union all
select 'line_code', count(*), count(distinct line_code), true
from positions where collected_at < timestamp '2024-01-20 00:00:00'
""",
    "positions",
)
def distinct_by_sketch(spark: SparkSession, folder: str) -> DataFrame:
    # Sketches of all days are stored, then those of a span united and held against the exact count.
    path, values = scratch_path(spark, "sketches"), ["vehicle_id", "line_code"]
    rows = fixtures.positions(fixtures.events(spark, folder)).withColumn("dt", F.to_date("collected_at"))
    sketches.store_sketches(rows, path, values)
    span = F.col("dt") < F.lit("2024-01-20").cast("date")
    estimated = sketches.distinct_estimate(sketches.read_sketches(spark, path), span)
    exact = sketches.distinct_exact(rows, values, span).drop("rows")
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.lit(4 * sketches.error()) * F.col("exact")
    return estimated.join(exact, "column").select(
        F.col("column").alias("name"), F.col("rows").alias("n"), F.col("exact").alias("distinct_exact"), near.alias("near")
    )
