"""Check SQL (DuckDB) for the registered queries, over the same tables."""

from __future__ import annotations

import re

from countlake.plans.views import TABLES, VIEWS

_DAILY_COLUMNS = (
    "date, agency_name, counter_id, unit, daily_visitor_count, weekday,"
    " avg_visits_4_weekday, prev_avg_4_visits, pct_change"
)


def _metric_chain(counts: str) -> str:
    return f"""
select date, agency_name, counter_id, unit, daily_visitor_count, weekday, avg_visits_4_weekday, prev_avg_4_visits,
       round(100 * (daily_visitor_count / prev_avg_4_visits - 1)) + 0.0 as pct_change
from (
  select *, lag(avg_visits_4_weekday) over (partition by agency_name, counter_id, weekday order by date) as prev_avg_4_visits
  from (
    select *, round(avg(daily_visitor_count) over (
        partition by agency_name, counter_id, weekday order by date rows between 3 preceding and current row)) + 0.0
      as avg_visits_4_weekday
    from (select *, cast(dayofweek(date) + 1 as int) as weekday from {counts})))"""


def _rollup(daily: str, extra: str = "", where: str = "true") -> str:
    return f"""
select date, agency_name, daily_visitor_count, avg_visits_4_weekday, prev_avg_4_visits{", baseline_sensors" if extra else ""},
       case when prev_avg_4_visits = 0 then cast('inf' as double)
            else 100 * (daily_visitor_count / prev_avg_4_visits - 1) end as pct_change
from (
  select date, agency_name, cast(sum(daily_visitor_count) as bigint) as daily_visitor_count,
         coalesce(sum(avg_visits_4_weekday), 0.0) as avg_visits_4_weekday,
         coalesce(sum(prev_avg_4_visits), 0.0) as prev_avg_4_visits{extra}
  from {daily} where {where} group by date, agency_name)"""


def _closest(names: str) -> str:
    return f"""
select agency_name, arg_min(entry, (levenshtein(agency_name, entry), entry)) as closest_match
from {names} cross join (select distinct replace(lower(agency_name), ' ', '_') as entry from v_dictionary)
group by agency_name"""


# Fixed values, written out here apart from those of the package.
_TRAFFIC = """
    when agency_size = 'small' and location_type = 'countryside' then 20
    when agency_size = 'small' and location_type = 'mid_sized_city' then 50
    when agency_size = 'small' and location_type = 'metropolis' then 80
    when agency_size = 'medium' and location_type = 'countryside' then 40
    when agency_size = 'medium' and location_type = 'mid_sized_city' then 100
    when agency_size = 'medium' and location_type = 'metropolis' then 200
    when agency_size = 'big' and location_type = 'countryside' then 100
    when agency_size = 'big' and location_type = 'mid_sized_city' then 300
    when agency_size = 'big' and location_type = 'metropolis' then 500"""
_SENSORS = """
    when location_type not in ('countryside', 'mid_sized_city', 'metropolis') then null
    when agency_size = 'small' then 1 when agency_size = 'medium' then 2 when agency_size = 'big' then 3"""
_WEEKDAYS = "[1.0::double, 1.25, 1.3, 1.6, 1.8, 0, 0]"
_HOURS = (
    "[0::double, 0, 0, 0, 0, 0, 0, 0, 0, 0.2, 0.25, 0.25, 0, 0.1, 0.1, 0.02, 0.03, 0.05, 0, 0, 0, 0, 0, 0]"
)
_WEEKDAY_MULTIPLIER = f"{_WEEKDAYS}[isodow(date)]"
_HOUR_MULTIPLIER = f"{_HOURS}[hour + 1]"


def _dimension(agencies: str) -> str:
    return f"""
select agency_name, agency_size, location_type, cast(case {_TRAFFIC} end as int) as base_traffic,
       cast(case {_SENSORS} end as int) as counter_number
from {agencies}"""


def _bands(factor: str) -> str:
    return f"""
select date, agency_name, counter_id, daily_visitor_count, avg_visits_4_weekday, prev_avg_4_visits, pct_change,
       case when prev_avg_4_visits > 0 then prev_avg_4_visits * cast({factor} as double) end as upper_threshold,
       case when prev_avg_4_visits > 0 then prev_avg_4_visits * (2 - cast({factor} as double)) end as lower_threshold,
       coalesce(prev_avg_4_visits > 0 and daily_visitor_count > prev_avg_4_visits * cast({factor} as double), false) as is_above,
       coalesce(prev_avg_4_visits > 0 and daily_visitor_count < prev_avg_4_visits * (2 - cast({factor} as double)), false) as is_below"""


# Named parts the check statements build on; ``view`` texts come from VIEWS.
_PARTS = {
    "dated": """
select *, cast(try_strptime(date_time, '%Y-%m-%d %H:%M') as date) as date,
       case when regexp_full_match(counter_id, '[0-9]+') then try_cast(counter_id as int) end as counter_number,
       case when regexp_full_match(visitor_count, '[0-9]+') then try_cast(visitor_count as int) end as count_number
from v_raw_dirty""",
    "judged": """
select *, case when date is null then 'bad_date' when agency_name is null then 'null_agency'
               when coalesce(count_number, 0) <= 0 then 'bad_count'
               when coalesce(counter_number, -1) not between 0 and 10 then 'bad_sensor'
               when coalesce(lower(unit), '') <> 'visitors' then 'bad_unit' end as reason
from dated""",
    "named": "select *, replace(lower(agency_name), ' ', '_') as plain_name from judged where agency_name is not null",
    "unmatched": """
select distinct plain_name as agency_name from named
where plain_name not in (select replace(lower(agency_name), ' ', '_') from v_dictionary)""",
    "corrections": _closest("unmatched"),
    "corrected": """
select named.* exclude (agency_name), coalesce(closest_match, plain_name) as agency_name
from named left join corrections on plain_name = corrections.agency_name""",
    "clean_counts": """
select date, agency_name, counter_number as counter_id, lower(unit) as unit,
       cast(sum(count_number) as bigint) as daily_visitor_count
from corrected where reason is null group by all""",
    "kept": "select * from v_readings where visitor_count > 0 and counter_id between 0 and 10",
    "counts": """
select date, agency_name, counter_id, unit, cast(sum(visitor_count) as bigint) as daily_visitor_count
from kept group by all""",
    "v_daily": _metric_chain("counts"),
    "v_daily_metrics_long": _metric_chain("v_daily_long"),
    "rollup": _rollup("v_daily"),
    "rollup_long": _rollup("v_daily_metrics_long"),
    "dimension": _dimension("v_agencies"),
    "updated_dimension": _dimension("v_agency_updates"),
    # Shares of 1, 2 or 3 sensors, as listed for the dimension's sizes.
    "sensors": """
select agency_name, cast(counter_id as int) as counter_id, share, cast(floor(base_traffic * share) as int) as base_traffic
from (
  select agency_name, base_traffic, counter_id,
         (case counter_number when 1 then [1.0::double] when 2 then [0.8::double, 0.2]
              when 3 then [0.4::double, 0.4, 0.2] end)[counter_id + 1] as share
  from dimension, lateral (select unnest(range(counter_number)) as counter_id))""",
    "merged_counts": """
select * from counts where date < date '2024-01-20'
union all
select date, agency_name, counter_id, unit, daily_visitor_count + 1 from counts where date >= date '2024-01-20'""",
    "redone": _metric_chain("merged_counts"),
    "json_fields": """
select json, json_valid(json) as ok,
       case when json_valid(json) then json_type(json, '$.agency_name') end as name_type,
       case when json_valid(json) then json_type(json, '$.visitor_count') end as count_type,
       case when json_valid(json) then json_type(json, '$.unit') end as unit_type,
       case when json_valid(json) then coalesce(json_type(json, '$.counter_id'), 'NULL') end as counter_type,
       case when json_valid(json) then json_extract_string(json, '$.agency_name') end as agency_name,
       case when json_valid(json) then json_extract_string(json, '$.date_time') end as date_time,
       case when json_valid(json) then try_cast(json_extract_string(json, '$.visitor_count') as int) end as visitor_count,
       case when json_valid(json) then json_extract_string(json, '$.unit') end as unit,
       case when json_valid(json) then try_cast(json_extract_string(json, '$.counter_id') as int) end as counter_id
from v_json""",
    "json_judged": """
select *, case when not ok then 'malformed'
               when name_type is distinct from 'VARCHAR' then 'agency_name'
               when count_type is null or count_type not in ('BIGINT', 'UBIGINT') then 'visitor_count'
               when unit_type is distinct from 'VARCHAR' then 'unit'
               when counter_type not in ('NULL', 'BIGINT', 'UBIGINT') then 'counter_id' end as error
from json_fields""",
}

_STATUS = """case visitor_count when -10 then 'broken' when -1 then 'closed'
             else case when visitor_count >= 0 then 'measured' else 'invalid' end end"""

_LONG = "date between date '1996-03-01' and date '1998-09-30'"

_LOOKUP = """
select agency_name, date_time, visitor_count, unit, counter_id from v_hourly
where date_time = '2024-01-10 10:00' and agency_name = 'nation_1' and counter_id = 1"""

_MERGED = f"""
select {_DAILY_COLUMNS} from v_daily where date < date '2024-01-20'
union all
select * replace (daily_visitor_count + 1 as daily_visitor_count) from v_daily where date >= date '2024-01-20'"""

_CHECKS = {
    "scan_raw_readings": """
select date_time, agency_name,
       case when regexp_full_match(counter_id, '-?[0-9]+') then try_cast(counter_id as int) end as counter_id,
       case when regexp_full_match(visitor_count, '-?[0-9]+') then try_cast(visitor_count as int) end as visitor_count,
       unit
from v_raw_dirty""",
    # An empty CSV field is null.
    "write_raw_csv": """
select date_time, agency_name, counter_id, nullif(visitor_count, '') as visitor_count, unit from v_raw_dirty""",
    "scan_daily": "select * from v_daily",
    "scan_raw_mixed": """
select date_time, agency_name,
       case when regexp_full_match(counter_id, '-?[0-9]+') then try_cast(counter_id as int) end as counter_id,
       case when regexp_full_match(visitor_count, '-?[0-9]+') then try_cast(visitor_count as int) end as visitor_count,
       unit
from v_raw_dirty where coalesce(agency_name, '') not like '%4'""",
    "transform_rejects": """
select reason, count(*) as row_count
from (select case when agency_name like '%4' then 'unmapped_file' else reason end as reason from judged)
where reason is not null group by 1""",
    "write_daily": """
select cast(year(date) as int) as year, cast(month(date) as int) as month, count(*) as row_count,
       cast(sum(daily_visitor_count) as bigint) as visitors
from v_daily_metrics_long group by 1, 2""",
    "ingest_json": "select agency_name, date_time, visitor_count, unit, counter_id from json_judged where error is null",
    "ingest_json_errors": "select json, error from json_judged where error is not null",
    "peek": "select * from v_daily order by agency_name, counter_id, date limit 2",
    "extract_date": "select date_time, agency_name, counter_id, visitor_count, unit, date from dated",
    "clean_visitor_count": """
select date_time, agency_name, counter_id, count_number as visitor_count, unit from dated where count_number > 0""",
    "clean_counter_id": """
select date_time, agency_name, counter_number as counter_id, visitor_count, unit
from dated where counter_number between 0 and 10""",
    "clean_unit": """
select date_time, agency_name, counter_id, visitor_count, lower(unit) as unit
from v_raw_dirty where lower(unit) = 'visitors'""",
    "clean_agency_name": "select date_time, agency_name, counter_id, visitor_count, unit from corrected",
    "clean_readings": """
select date_time, agency_name, counter_number as counter_id, count_number as visitor_count, lower(unit) as unit, date
from corrected where reason is null""",
    "clean_readings_undated": """
select date_time, agency_name, counter_number as counter_id, count_number as visitor_count, lower(unit) as unit, date
from corrected where count_number > 0 and counter_number between 0 and 10 and lower(unit) = 'visitors'""",
    "rejects": "select coalesce(reason, 'kept') as reason, count(*) as row_count from judged group by 1",
    "rejected_readings": """
select date_time, agency_name, counter_id, visitor_count, unit, reason from judged where reason is not null""",
    "agency_dictionary": "select distinct replace(lower(agency_name), ' ', '_') as entry from v_dictionary",
    "unmatched_names": "select * from unmatched",
    "closest_match": "select * from corrections",
    "closest_match_large": """
select agency_name, arg_min(entry, (levenshtein(agency_name, entry), entry)) as closest_match
from (select distinct agency_name from v_misspelled)
cross join (select distinct replace(lower(agency_name), ' ', '_') as entry from v_customer_names)
group by agency_name""",
    "correct_agency_name": "select agency_name, count(*) as reading_count from corrected group by 1",
    "daily_metrics": "select * from v_daily",
    "daily_visitors": "select * from counts",
    "monthly_visitors": """
select cast(year(date) as int) as year, cast(month(date) as int) as month, agency_name, counter_id,
       cast(sum(daily_visitor_count) as bigint) as monthly_visitor_count
from v_daily_long group by 1, 2, 3, 4""",
    "add_weekday": "select *, cast(dayofweek(date) + 1 as int) as weekday from v_daily_long",
    "rolling_metrics": "select * exclude (pct_change) from v_daily_metrics_long",
    "pct_change": "select * from v_daily_metrics_long",
    "daily_sorted": "select * from v_daily order by agency_name, counter_id, date",
    "agency_daily_rollup": "select * from rollup",
    "agency_daily_rollup_range": _rollup(
        "v_daily_metrics_long", where=f"agency_name in ('nation_0', 'nation_2', 'nation_3') and {_LONG}"
    ),
    "agency_daily_rollup_baseline": _rollup("v_daily", ", count(prev_avg_4_visits) as baseline_sensors"),
    "sensor_series": "select * from v_daily where agency_name = 'nation_1' and counter_id = 2",
    "sensor_series_range": """
select * from v_daily where agency_name = 'nation_1' and counter_id = 2
and date between date '2024-01-05' and date '2024-01-25'""",
    "avg_daily_per_agency": """
select agency_name, avg(daily_visitor_count) as avg_daily_visitors from v_daily_long group by 1""",
    "agency_hourly_total": """
select agency_name, date_time, cast(sum(visitor_count) filter (visitor_count >= 0) as bigint) as visitor_count,
       count(*) filter (visitor_count = -1) as closed_sensors, count(*) filter (visitor_count = -10) as broken_sensors
from v_hourly group by 1, 2""",
    "reading_lookup": _LOOKUP,
    "reading_lookup_stored": _LOOKUP,
    "reading_lookup_all_sensors": """
select agency_name, date_time, cast(sum(visitor_count) filter (visitor_count >= 0) as bigint) as visitor_count,
       'visitors' as unit, cast(null as int) as counter_id
from v_hourly where date_time = '2024-01-10 10:00' and agency_name = 'nation_1' group by 1, 2""",
    "sensor_list": "select distinct agency_name, counter_id from v_daily_long",
    "agency_list": "select distinct agency_name from v_daily_long",
    "agency_sensors": "select distinct counter_id from v_daily_long where agency_name = 'nation_7'",
    "filter_time": f"select * from v_daily_metrics_long where {_LONG} and year(date) in (1996, 1998)",
    "filter_months_weeks": """
select * from v_daily_metrics_long where month(date) in (1, 12) and weekofyear(date) in (1, 2, 52)""",
    "traffic_view": _bands("1.2")
    + """
from (select *, cast(null as int) as counter_id from rollup_long)
where agency_name in ('nation_4', 'nation_9', 'nation_11') and date between date '1995-01-01' and date '1997-12-31'
and year(date) in (1995, 1997) and month(date) in (3, 4, 10)""",
    "traffic_view_stored": _bands("1.2")
    + """
from (select *, cast(null as int) as counter_id from rollup_long)
where agency_name in ('nation_4', 'nation_9', 'nation_11')
and year(date) in (1995, 1997) and month(date) in (3, 4, 10)""",
    "traffic_view_agency": _bands("1.35")
    + """
from (select *, cast(null as int) as counter_id from rollup)
where agency_name = 'nation_2' and year(date) = 2024""",
    "traffic_view_sensor": _bands("1.2")
    + """
from v_daily_metrics_long
where agency_name = 'nation_4' and counter_id = 3 and year(date) in (1996, 1997) and weekofyear(date) in (1, 10, 20, 53)""",
    "threshold_bands": """
select *, prev_avg_4_visits * cast(1.2 as double) as upper_threshold,
       prev_avg_4_visits * (2 - cast(1.2 as double)) as lower_threshold
from v_daily where prev_avg_4_visits > 0""",
    "band_breaches": """
select * from (
  select *, case when daily_visitor_count > upper_threshold then 'above'
                 when daily_visitor_count < lower_threshold then 'below' end as side
  from (select *, prev_avg_4_visits * cast(1.2 as double) as upper_threshold,
               prev_avg_4_visits * (2 - cast(1.2 as double)) as lower_threshold
        from v_daily_metrics_long where prev_avg_4_visits > 0))
where side is not null""",
    "is_exceeding": """
select *, coalesce(prev_avg_4_visits > 0 and daily_visitor_count > prev_avg_4_visits * cast(1.2 as double), false) as is_exceeding
from v_daily""",
    "variation_sign": """
select *, case when pct_change >= 0 then 'up' when pct_change < 0 then 'down' end as variation from v_daily""",
    "alert_count": """
select count(*) as alert_days from rollup_long
where prev_avg_4_visits > 0 and daily_visitor_count > cast(1.2 as double) * prev_avg_4_visits""",
    "relative_alerts": """
select *, round_even(daily_visitor_count / prev_avg_4_visits * 100, 0) / 100 as ratio
from (select date, agency_name, daily_visitor_count, prev_avg_4_visits from rollup_long
      where prev_avg_4_visits > 0 and daily_visitor_count > cast(1.2 as double) * prev_avg_4_visits
      order by daily_visitor_count desc, date, agency_name limit 10)""",
    "traffic_alerts": """
select *, round_even(daily_visitor_count / prev_avg_4_visits * 100, 0) / 100 as ratio
from (select date, agency_name, daily_visitor_count, prev_avg_4_visits from rollup_long
      where agency_name in ('nation_4', 'nation_9') and year(date) in (1995, 1996)
      and prev_avg_4_visits > 0 and daily_visitor_count > cast(1.2 as double) * prev_avg_4_visits
      order by daily_visitor_count desc, date, agency_name limit 10)""",
    "merge_daily": _MERGED,
    "merge_daily_table": _MERGED,
    "merge_daily_snapshot": f"""
select cast(version as int) as version, {_DAILY_COLUMNS} from v_daily
cross join (select unnest([0, 1]) as version) where date < date '2024-01-20'
union all
select cast(2 as int) as version, {_DAILY_COLUMNS} from ({_MERGED})""",
    "merge_daily_units": f"""
select {_DAILY_COLUMNS} from v_daily
union all
select * replace ('entries' as unit) from v_daily where date >= date '2024-01-20'""",
    "recompute_daily_table": "select * from redone",
    "transform_run": _metric_chain("clean_counts"),
    "agency_upsert": """
select * from updated_dimension
union all
select * from dimension where agency_name not in (select agency_name from updated_dimension)""",
    "agency_upsert_repeated": """
select * from updated_dimension
union all
select * from dimension where agency_name not in (select agency_name from updated_dimension)""",
    "partial_update_repeated": """
select b.id, case when u.id is not null then coalesce(u.name, 'old') else b.name end as name, b.address,
       case when u.id is not null then coalesce(u.city, 'Old Town') else b.city end as city,
       coalesce(u.postal_code, b.postal_code) as postal_code, coalesce(u.is_active, b.is_active) as is_active,
       case when u.id is not null then timestamp '2024-02-01 00:00:00' end as updated_at
from v_branches b left join v_branch_updates u on b.id = u.id""",
    "partial_update": """
select b.id, coalesce(u.name, b.name) as name, b.address, coalesce(u.city, b.city) as city,
       coalesce(u.postal_code, b.postal_code) as postal_code, coalesce(u.is_active, b.is_active) as is_active,
       case when u.id is not null then timestamp '2024-02-01 00:00:00' end as updated_at
from v_branches b left join v_branch_updates u on b.id = u.id""",
    "agency_dimension": "select * from dimension",
    "sensor_dimension": "select * from sensors",
    "readings_with_agency": """
select r.*, d.* exclude (agency_name) from v_readings r join dimension d on r.agency_name = d.agency_name""",
    "readings_with_agency_asof": """
select r.*,
       case when r.agency_name = 'nation_3' and date >= date '2024-01-21' then 'big'
            when r.agency_name = 'nation_3' and date >= date '2024-01-12' then 'medium'
            when r.agency_name = 'nation_1' and date >= date '2024-01-10' then 'big'
            when r.agency_name <> 'nation_4' then d.agency_size end as agency_size,
       cast(case when r.agency_name = 'nation_3' and date >= date '2024-01-21' then 9000
                 when r.agency_name = 'nation_3' and date >= date '2024-01-12' then 700
                 when r.agency_name = 'nation_1' and date >= date '2024-01-10' then 5000
                 when r.agency_name <> 'nation_4' then d.base_traffic end as int) as base_traffic
from v_readings r left join dimension d on r.agency_name = d.agency_name""",
    "opening_calendar": f"""
select date, hour, {_WEEKDAY_MULTIPLIER} as weekday_multiplier, {_HOUR_MULTIPLIER} as hour_multiplier,
       {_WEEKDAY_MULTIPLIER} > 0 and {_HOUR_MULTIPLIER} > 0 as is_open
from (select distinct date, hour from v_readings)""",
    "expected_traffic": f"""
select *, case when expected_visitors >= 0 and visitor_count >= 0 then visitor_count - expected_visitors end as deviation
from (
  select r.agency_name, r.counter_id, date_time, visitor_count,
         case when base_traffic is null then null
              when {_WEEKDAY_MULTIPLIER} > 0 and {_HOUR_MULTIPLIER} > 0
              then cast(floor((base_traffic * {_WEEKDAY_MULTIPLIER}) * {_HOUR_MULTIPLIER}) as int)
              else -1 end as expected_visitors
  from v_readings r left join sensors s on r.agency_name = s.agency_name and r.counter_id = s.counter_id)""",
    "reading_status": f"""
select agency_name, counter_id, {_STATUS} as status, count(*) as reading_count from v_readings group by 1, 2, 3""",
    "stable_bucket": """
select *, cast(seed % 16 as int) as bucket
from (select date, agency_name, counter_id,
             cast('0x' || substr(sha256(strftime(date, '%Y%m%d') || agency_name || cast(counter_id as varchar)), 57, 8) as bigint) as seed
      from v_daily_long)""",
    "missing_hours": """
select s.agency_name, s.counter_id, d.date, h.hour
from (select distinct agency_name, counter_id from v_readings) s
cross join (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from v_readings) d
cross join (select cast(unnest([9, 10, 11, 13, 14, 15, 16, 17]) as int) as hour) h
where isodow(d.date) <= 5 and not exists (
  select 1 from v_readings r where r.agency_name = s.agency_name and r.counter_id = s.counter_id
  and r.date = d.date and r.hour = h.hour)""",
    "missing_spans": """
select agency_name, counter_id, arg_min(date, n) as first_date, arg_min(hour, n) as first_hour,
       arg_max(date, n) as last_date, arg_max(hour, n) as last_hour, count(*) as hours
from (select s.*, g.date, g.hour, g.n, g.n - row_number() over (partition by s.agency_name, s.counter_id order by g.n) as island
      from (select distinct agency_name, counter_id from v_readings) s
      cross join (select d.date, h.hour, row_number() over (order by d.date, h.hour) as n
                  from (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from v_readings) d
                  cross join (select cast(unnest([9, 10, 11, 13, 14, 15, 16, 17]) as int) as hour) h
                  where isodow(d.date) <= 5) g
      where not exists (select 1 from v_readings r where r.agency_name = s.agency_name
                        and r.counter_id = s.counter_id and r.date = g.date and r.hour = g.hour))
group by agency_name, counter_id, island""",
    "validate_footfall": """
select unnest(['branch_id_present', 'detector_id_max_50', 'timestamp_present', 'visitor_count_min_0',
               'entry_count_min_0', 'exit_count_min_0']) as rule,
       unnest([count(*) filter (branch_id is null),
               count(*) filter (coalesce(length(detector_id) > 50, true)), count(*) filter (timestamp is null),
               count(*) filter (coalesce(visitor_count < 0, true)), count(*) filter (coalesce(entry_count < 0, true)),
               count(*) filter (coalesce(exit_count < 0, true))]) as violations,
       count(*) as rows_checked
from v_footfall""",
    "invalid_footfall": """
select * from (
  select *, concat_ws(',', case when branch_id is null then 'branch_id_present' end,
           case when coalesce(length(detector_id) > 50, true) then 'detector_id_max_50' end,
           case when timestamp is null then 'timestamp_present' end,
           case when coalesce(visitor_count < 0, true) then 'visitor_count_min_0' end,
           case when coalesce(entry_count < 0, true) then 'entry_count_min_0' end,
           case when coalesce(exit_count < 0, true) then 'exit_count_min_0' end) as violations
  from v_footfall)
where violations <> ''""",
    "validate_branch": """
select unnest(['name_max_100', 'address_max_200', 'city_max_50', 'postal_code_max_10']) as rule,
       unnest([count(*) filter (coalesce(length(name) > 100, true)), count(*) filter (coalesce(length(address) > 200, true)),
               count(*) filter (coalesce(length(city) > 50, true)),
               count(*) filter (coalesce(length(postal_code) > 10, true))]) as violations,
       count(*) as rows_checked
from v_branches""",
    "branch_defaults": "select * replace (coalesce(is_active, true) as is_active) from v_branches",
    "orphan_footfall": "select * from v_footfall where branch_id not in (select id from v_branches)",
    "footfall_with_branch": """
select f.*, b.name as branch_name, b.city as branch_city from v_footfall f join v_branches b on f.branch_id = b.id""",
    "stream_ingest": _metric_chain("clean_counts"),
    "stream_ingest_batches": _metric_chain("clean_counts"),
    "stream_daily": "select date, agency_name, counter_id, daily_visitor_count from counts",
    "stream_replayed": "select date, agency_name, counter_id, daily_visitor_count from counts",
    "stream_rolling": "select * from v_daily_metrics_long",
    "stream_late_readings": """
select date, agency_name, counter_id,
       cast(coalesce(sum(visitor_count) filter (not is_late), 0) as bigint) as on_time_count,
       cast(coalesce(sum(visitor_count) filter (is_late), 0) as bigint) as late_count,
       cast(sum(visitor_count) as bigint) as all_count
from (select cast(ts as date) as date, concat('nation_', cast(user_id % 5 as varchar)) as agency_name,
             cast(event_id % 3 as int) as counter_id, cast(floor(value) as int) as visitor_count,
             event_id % 10 = 9 and cast(cast(ts as date) + 1 as timestamp) <=
               max(ts) filter (event_id % 10 <> 9) over () - interval 1 day as is_late
      from events where event_type not in ('error', 'signup') and floor(value) > 0)
group by 1, 2, 3""",
}


def _part(name: str) -> str:
    if name in VIEWS:
        return VIEWS[name].format(**{n: n for n in [*TABLES, *VIEWS]})
    return _PARTS[name]


def _needed(sql: str, done: list[str]) -> list[str]:
    """Names of the parts that ``sql`` uses, each after the parts it uses."""
    for name in [*VIEWS, *_PARTS]:
        if name not in done and re.search(rf"\b(?:from|join|in|,)\s*\(*\s*{name}\b|\bfrom {name}\b", sql):
            _needed(_part(name), done)
            done.append(name)
    return done


def check_sql(name: str) -> str:
    parts = _needed(_CHECKS[name], [])
    head = ",\n".join(f"{p} as materialized ({_part(p)})" for p in parts)
    return f"with {head}\n{_CHECKS[name]}" if parts else _CHECKS[name]


CHECKED = list(_CHECKS)
