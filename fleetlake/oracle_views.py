"""SQL definitions of the fixture tables, prefixed as CTEs to every oracle query."""

VIEWS = {
    "positions": """
select event_id as id,
  date_trunc('hour', ts) as collected_at,
  user_id + 1 as vehicle_id,
  case when event_id % 97 = 0 then null else event_type || '-' || cast(10 + user_id % 3 as varchar(9)) end as line_code,
  -23.54e0 - cast(case when user_id % 10 = 0 then user_id * 7 + event_id % 3 else event_id * 37 + user_id * 11 end % 400 as double) / 1e4 as lat,
  -46.62e0 - cast(case when user_id % 10 = 0 then user_id * 3 else event_id * 13 + user_id * 7 end % 400 as double) / 1e4 as lon,
  case when event_id % 89 = 0 then null else ts end as position_at
from events""",
    "predictions": """
select event_id as id,
  date_trunc('hour', ts) as collected_at,
  1000 + user_id % 7 as line_id,
  user_id + 1 as vehicle_id,
  case when event_id % 83 = 0 then null else 5000 + event_id % 41 end as stop_id,
  case when event_id % 79 = 0 then null else lpad(cast((event_id * 7) % 24 as varchar(9)), 2, '0') || ':' || lpad(cast((event_id * 11) % 60 as varchar(9)), 2, '0') end as predicted_at
from events
where event_id % 2 = 0 and user_id % 5 <> 0""",
    "predictions_dup": """
select * from predictions
union all
select id + 1000000000 as id, collected_at, line_id, vehicle_id, stop_id, predicted_at
from predictions where id % 3 = 0""",
    "line_catalog": """
select cast(dense_rank() over (order by event_type, line_suffix) as bigint) as line_id,
  event_type as line_number,
  line_suffix,
  'Terminal ' || upper(event_type) as outbound_name,
  case when line_suffix = 12 then null else 'Bairro ' || cast(line_suffix as varchar(9)) end as return_name
from (select distinct event_type, 10 + user_id % 3 as line_suffix from events) t""",
    "fleet_status": """
select p.id, p.collected_at as analyzed_at, p.vehicle_id, p.line_code, p.lat, p.lon, p.position_at,
  u.stop_id as next_stop_id, u.predicted_at as predicted_arrival
from positions p left join (
  select *, row_number() over (partition by vehicle_id order by predicted_at asc nulls last, collected_at, id) as rn
  from predictions) u on p.vehicle_id = u.vehicle_id and u.rn = 1""",
    "lineage_audit": """
select event_id as id,
  'compact_' || event_type as asset_name,
  event_type as table_name,
  case when user_id % 2 = 0 then 'bronze' else 'silver' end as layer,
  ts as run_timestamp,
  cast(user_id * 10 as bigint) as row_count,
  case when event_id % 10 = 0 then 'alert' else 'ok' end as status
from events""",
    "external_times": """
select ord, ref_at, hour(ref_at) as ref_hour from (
  select 1 as ord, timestamp '2024-01-15 05:00:00' as ref_at
  union all select 2, timestamp '2024-01-15 12:00:00'
  union all select 3, timestamp '2024-01-15 21:00:00') t""",
    "delays": """
select id, line_code,
  case when hour(position_at) between 7 and 8 then 'morning' when hour(position_at) between 17 and 18 then 'afternoon' when hour(position_at) between 20 and 20 then 'evening' end as period,
  cast(position_at as date) as day,
  cast(id % 20 as double) as delay_min
from positions where line_code is not null and position_at is not null""",
}

# Views a view is built on.
NEEDS = {
    "predictions_dup": ["predictions"],
    "fleet_status": ["positions", "predictions"],
    "delays": ["positions"],
}


def with_views(query: str, *names: str) -> str:
    """``query`` with the named views, and those they need, in front of it."""
    ordered: list[str] = []
    for name in names:
        for needed in (*NEEDS.get(name, []), name):
            if needed not in ordered:
                ordered.append(needed)
    head = ",\n".join(f"{name} as ({VIEWS[name]})" for name in ordered)
    body = query.strip()
    if body.startswith("with "):
        return f"with {head},\n{body[len('with '):]}"
    return f"with {head}\n{body}" if head else body
