"""Input tables of the engine derived from the given parquet tables.

Every statement is plain SQL that Spark and DuckDB both accept, covers whole tables, and uses nothing random. ``%``
only varies values, never selects rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ACCOUNTS = """
select case when p.p_partkey % 2 = 0 then 'north_dist' else 'south_dist' end as distributor,
 concat('A', lpad(cast(p.p_partkey as string), 8, '0')) as account_id,
 concat('Acct ', p.p_name) as original_name,
 concat(p.p_name, case p.p_size % 3 when 0 then ' Liquors LLC' when 1 then ' Wine & Spirits' else '' end) as clean_name,
 concat(cast(p.p_size as string), ' Main St') as clean_address,
 case when p.p_partkey % 10 = 0 then null else concat('city ', cast(n.n_nationkey as string)) end as city,
 case when p.p_partkey % 50 = 0 then null else substr('NJNYCATXFL', cast(n.n_nationkey % 5 * 2 + 1 as int), 2) end
  as state,
 lpad(cast(7000 + p.p_partkey % 97 as string), 5, '0') as zip_code,
 cast(p.p_size * 12 as decimal(18, 2)) as case_volume,
 case when p.p_partkey % 9 = 0 then null else cast(p.p_retailprice as decimal(18, 2)) end as revenue,
 cast(p.p_size + 0.25 as decimal(18, 2)) as revenue_per_case
from part p join nation n on n.n_nationkey = p.p_partkey % 25
"""

STORES = """
select concat('S', lpad(cast(c.c_custkey as string), 8, '0')) as store_id,
 concat('Brand ', c.c_mktsegment) as brand,
 case c.c_custkey % 6 when 0 then concat(p.p_name, ' Liquor') when 1 then concat(p.p_name, chr(39), 's Wines Inc.')
  when 2 then concat(p.p_name, ' Dispensary') when 3 then concat(substr(p.p_name, 2, 60), ' Shop')
  when 4 then 'Wine Shop' else p.p_name end as store_name,
 case when c.c_custkey % 23 = 0 then null else
  concat(cast(c.c_custkey % 50 as string), case when c.c_custkey % 3 = 0 then ' Main Street' else ' Oak Ave.' end)
  end as address,
 concat('555-', lpad(cast(c.c_custkey as string), 7, '0')) as phone, cast(null as string) as email,
 'US' as parsed_country,
 case when c.c_custkey % 7 = 0 then '' else concat('City ', cast(n.n_nationkey as string)) end as parsed_city,
 cast(c.c_custkey % 50 as string) as house_number,
 case when c.c_custkey % 3 = 0 then 'Main Street' else 'Oak Ave.' end as road,
 case when c.c_custkey % 4 = 0 then null else lpad(cast(7000 + c.c_custkey % 97 as string), 5, '0') end as zip,
 substr('NJNYCATXFL', cast(n.n_nationkey % 5 * 2 + 1 as int), 2) as state,
 c.c_acctbal < 0 as is_chain, cast(null as string) as chain_name, c.c_acctbal as rating, c.c_custkey as review_count,
 cast(null as string) as nj_abc_license_number
from customer c join nation n on n.n_nationkey = c.c_nationkey join part p on p.p_partkey = c.c_custkey
"""

SCRAPES = """
select concat('Brand ', cast(c.c_custkey % 9 as string)) as brand,
 concat('  Joe', chr(39), 's St. ', c.c_mktsegment, ' ', cast(c.c_custkey as string)) as store_name,
 concat(cast(c.c_custkey % 50 as string), ' N Main St') as address,
 concat('555-', cast(c.c_custkey as string)) as phone, ' ' as email, 'US' as parsed_country,
 concat('City ', cast(c.c_nationkey as string)) as parsed_city,
 cast(c.c_custkey % 50 as string) as house_number, 'N Main St' as road,
 case when c.c_custkey % 4 = 0 then '' else lpad(cast(7000 + c.c_custkey % 97 as string), 5, '0') end as zip,
 'NJ' as state,
 case o.o_orderkey % 5 when 0 then 'TRUE' when 1 then 'n' when 2 then '' when 3 then 'maybe' else ' Yes ' end
  as is_chain,
 '' as chain_name,
 case o.o_orderkey % 5 when 0 then '4.5' when 1 then ' 3 ' when 2 then 'bad' when 3 then '1_0.5' else '' end as rating,
 case o.o_orderkey % 4 when 0 then '142' when 1 then '89.9' when 2 then '-7.9' else 'x' end as review_count,
 concat('scrape_', cast(year(o.o_orderdate) as string), '.csv') as source_file,
 cast(o.o_orderdate as timestamp) as seen_at
from orders o join customer c on c.c_custkey = o.o_custkey
"""

ZIP_RAW = """
select cast(500 + p_partkey as string) as zip, concat(' Town ', cast(p_size as string)) as city, 'nj' as state_id,
 case when p_partkey % 11 = 0 then '' else 'Essex' end as county_name,
 case when p_partkey % 13 = 0 then 'n/a' else concat('40.', cast(p_partkey % 1000 as string)) end as lat,
 concat('-74.', cast(p_partkey % 1000 as string)) as lng,
 case when p_partkey % 17 = 0 then '' else cast(p_partkey * 13 % 15000 as string) end as density,
 concat(cast(p_partkey % 50000 as string), '.7') as population
from part
"""

GEOCODE_RAW = """
select concat('S', lpad(cast(c_custkey as string), 8, '0')) as store_id,
 case c_custkey % 5
  when 0 then '{"status":"ZERO_RESULTS","results":[]}'
  when 1 then '{"status":"INVALID_REQUEST"}'
  when 2 then '{"status":"REQUEST_DENIED","error_message":"bad key"}'
  when 3 then case when c_custkey % 4 = 0 then '{"status":"OK","results":[]}' else concat('{"status":"OK","results":[',
   '{"geometry":{"location":{"lat":41.5,"lng":-73.25}},"address_components":[]}]}') end
  else concat('{"status":"OK","results":[{"geometry":{"location":{"lat":40.', cast(c_custkey % 90 + 10 as string),
   ',"lng":-74.5},"location_type":"ROOFTOP"},"formatted_address":"x","address_components":[{"types":["route"],',
   '"short_name":"Main St"},{"types":["postal_code"],"short_name":"',
   lpad(cast(500 + c_custkey % 997 as string), 5, '0'), '-1234"}]}]}') end as body
from customer
"""

CENSUS_RAW = """
select concat('S', lpad(cast(c_custkey as string), 8, '0')) as store_id,
 case c_custkey % 4 when 0 then 'No_Match' when 1 then 'Tie' when 2 then 'Tied' else 'Match' end as match_flag,
 concat(cast(10000 + c_custkey as string), ' MAIN ST, TOWN, NJ', case when c_custkey % 3 = 0 then ''
  else concat(', ', lpad(cast(7000 + c_custkey % 97 as string), 5, '0')) end) as matched_address,
 case when c_custkey % 7 = 0 then '' when c_custkey % 7 = 1 then '-74.1,x'
  else concat('-74.', cast(c_custkey % 90 as string), ',40.5') end as coords
from customer
"""

# The sign-up job stops succeeding two days before the end of the month.
RUNS = """
select concat('r', cast(event_id as string)) as run_id, concat('job_', event_type) as component,
 cast(null as string) as mode,
 case when event_id % 10 = 0 or (event_type = 'signup' and ts >= timestamp '2024-01-29 00:00:00') then 'failure'
  else 'success' end as status,
 user_id as rows_processed, cast(ts as timestamp) as finished_at
from events
"""

ERRORS = """
select concat('e', cast(event_id as string)) as error_id, cast(ts as timestamp) as occurred_at,
 concat('job_', event_type) as component, 'function' as test_type, 'run_failed' as check_name,
 case when event_id % 3 = 0 then 'WARNING' else 'ERROR' end as severity, 'run failed' as message,
 props as context, concat('r', cast(event_id as string)) as run_id
from events where event_type = 'error'
"""

# Licences: one per supplier; a store carries its number where one names it.
LICENCES = """
select concat('L', lpad(cast(s_suppkey as string), 6, '0')) as licence_number,
 case when s_acctbal > 0 then concat('S', lpad(cast(s_suppkey as string), 8, '0')) end as store_id,
 s_name as licensee, concat('City ', cast(s_nationkey as string)) as city, 'NJ' as state
from supplier
"""

STATEMENTS = {
    "accounts": ACCOUNTS, "stores": STORES, "scrapes": SCRAPES, "zip_raw": ZIP_RAW, "geocode_raw": GEOCODE_RAW,
    "census_raw": CENSUS_RAW, "runs": RUNS, "errors": ERRORS, "licences": LICENCES,
}


# Tables that grow; the others are fixed lists.
GROWING = ("customer", "supplier", "part", "orders", "lineitem", "events")


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A small file of one row group is one task however many cores wait; only then are its rows spread."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if table in GROWING and df.rdd.getNumPartitions() < cores else df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    statement = STATEMENTS[name]
    for table in BASE_TABLES:
        if table in statement:
            read_table(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(statement)
