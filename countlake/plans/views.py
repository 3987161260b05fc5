"""Input views over the benchmark tables.

The texts run unchanged in Spark SQL and in the SQL that checks the results;
``{table}`` stands for a table or another view.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["nation", "customer", "supplier", "orders", "events"]

VIEWS = {
    # All columns text, as landed, with every kind of dirt.
    "v_raw_dirty": """
select case when event_id % 97 = 0 then 'bad-date' else substr(cast(ts as varchar(30)), 1, 16) end as date_time,
       case when event_id % 89 = 0 then null
            when event_id % 3 = 0 then concat('NATION ', cast(user_id % 25 as varchar(10)))
            when event_id % 7 = 0 then concat('Naton_', cast(user_id % 25 as varchar(10)))
            else concat('Nation_', cast(user_id % 25 as varchar(10))) end as agency_name,
       case when event_id % 83 = 0 then 'x1' else cast(user_id % 14 - 1 as varchar(10)) end as counter_id,
       case when event_id % 79 = 0 then '' when event_id % 73 = 0 then 'n/a'
            when event_type = 'error' then '-10' when event_type = 'signup' then '-1'
            else cast(cast(floor(value) as int) as varchar(20)) end as visitor_count,
       case when event_id % 71 = 0 then null when event_id % 61 = 0 then 'entries'
            when event_id % 2 = 0 then 'Visitors' else 'visitors' end as unit
from {events}""",
    # Typed readings of 30 days, 5 agencies x 3 sensors, sentinels included.
    "v_readings": """
select substr(cast(ts as varchar(30)), 1, 16) as date_time, cast(ts as date) as date,
       cast(hour(ts) as int) as hour, concat('nation_', cast(user_id % 5 as varchar(10))) as agency_name,
       cast(event_id % 3 as int) as counter_id,
       case when event_type = 'error' then -10 when event_type = 'signup' then -1
            else cast(floor(value) as int) end as visitor_count, 'visitors' as unit
from {events}""",
    # The same readings stamped with the full hour.
    "v_hourly": """
select concat(substr(date_time, 1, 13), ':00') as date_time, agency_name, counter_id, visitor_count, unit
from {v_readings}""",
    # Six years of daily counts, 25 agencies x 5 sensors.
    "v_daily_long": """
select cast(o_orderdate as date) as date, lower(n_name) as agency_name,
       cast(substr(o_orderpriority, 1, 1) as int) as counter_id, 'visitors' as unit,
       cast(sum(cast(floor(o_totalprice / 1000) as int)) as bigint) as daily_visitor_count
from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey
group by 1, 2, 3, 4""",
    "v_agencies": """
select lower(n_name) as agency_name,
       case n_nationkey % 3 when 0 then 'small' when 1 then 'medium' else 'big' end as agency_size,
       case n_regionkey % 3 when 0 then 'countryside' when 1 then 'mid_sized_city' else 'metropolis' end as location_type
from {nation}""",
    # Changed and new agencies: the names overlap in part with v_agencies.
    "v_agency_updates": """
select concat('nation_', cast(n_nationkey + 10 as varchar(10))) as agency_name,
       'big' as agency_size,
       case n_nationkey % 2 when 0 then 'metropolis' else 'seaside' end as location_type
from {nation}""",
    "v_dictionary": """
select lower(n_name) as agency_name from {nation}""",
    # A dictionary of all customers, and names like theirs with letters changed or lost.
    "v_customer_names": """
select c_name as agency_name from {customer}""",
    "v_misspelled": """
select case c_custkey % 4 when 0 then replace(lower(c_name), '#', '') when 1 then substr(lower(c_name), 2)
            when 2 then replace(lower(c_name), 'customer#0', 'kustomar 1')
            else concat('the_', lower(c_name), '_' , cast(c_custkey as varchar(10))) end as agency_name
from {customer}""",
    "v_branches": """
select cast(s_suppkey as int) as id, s_name as name, concat('Street ', cast(s_suppkey as varchar(10))) as address,
       n_name as city, cast(10000 + s_suppkey as varchar(10)) as postal_code,
       case when s_suppkey % 7 = 0 then null else s_acctbal > 0 end as is_active
from {supplier} join {nation} on s_nationkey = n_nationkey""",
    # One update row per supplier; a null leaves the branch's value.
    "v_branch_updates": """
select cast(s_suppkey * 2 as int) as id, case when s_acctbal < 0 then upper(s_name) end as name,
       cast(null as varchar(10)) as city,
       case when s_acctbal < 5000 then cast(20000 + s_suppkey as varchar(10)) end as postal_code,
       case when s_acctbal > 8000 then false end as is_active
from {supplier}""",
    "v_footfall": """
select cast(user_id as int) as branch_id, concat(event_type, '-', cast(user_id as varchar(10))) as detector_id,
       ts as timestamp, cast(floor(value) as int) as visitor_count,
       cast(floor(value / 2) as int) as entry_count, cast(floor(value) as int) - 5 as exit_count
from {events}""",
    # Reading records as JSON: some with wrong types, missing fields or broken text.
    "v_json": """
select concat(
         case when event_id % 53 = 0 then '[' else '{{' end,
         case when event_id % 47 = 0 then '' when event_id % 43 = 0 then '"agency_name": 17, '
              else concat('"agency_name": "nation_', cast(user_id % 25 as varchar(10)), '", ') end,
         '"date_time": "', substr(cast(ts as varchar(30)), 1, 16), '", ',
         '"visitor_count": ',
         case when event_id % 41 = 0 then 'null' when event_id % 37 = 0 then '"many"'
              when event_id % 31 = 0 then '12.5'
              else cast(cast(floor(value) as int) as varchar(20)) end,
         case when event_id % 29 = 0 then '' else ', "unit": "visitors"' end,
         case when event_id % 5 = 0 then '' when event_id % 7 = 0 then ', "counter_id": null'
              when event_id % 23 = 0 then ', "counter_id": "first"'
              else concat(', "counter_id": ', cast(event_id % 3 as varchar(10))) end,
         '}}') as json
from {events}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view of the given data directory."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    needed = [n for n in [*TABLES, *VIEWS] if "{" + n + "}" in text]
    return spark.sql(text, **{n: view(spark, sf_dir, n) for n in needed})
