"""The SQL that each query of ``star_schema`` must agree with, for an ANSI engine."""

from __future__ import annotations

_INPUTS = """
with sales as (
  select l_orderkey as order_id, o_custkey as customer_id, l_partkey as product_id,
         cast(l_quantity as bigint) as quantity, l_extendedprice as price,
         cast(o_orderdate as date) as order_date
  from lineitem join orders on l_orderkey = o_orderkey
),
users as (
  select c_custkey as id, c_name as name, n_name as "address.city"
  from customer join nation on c_nationkey = n_nationkey
),
weather as (
  select user_id as user_info_table_id, event_type as weather_main, value as temp
  from (select *, row_number() over (partition by user_id order by event_id desc) as place
        from events) ranked
  where place = 1
),
wide as (
  select sales.*, weather.*, users.*
  from sales
  join users on sales.customer_id = users.id
  left join weather on weather.user_info_table_id = users.id
)
"""

_TOTAL = "cast(sum(cast(price as decimal(18,2))) as double)"

_CUSTOMERS = f"select name, {_TOTAL} as price from wide where name is not null group by name"
_CITIES = f"""select "address.city", {_TOTAL} as price from wide
where "address.city" is not null group by "address.city" """
_WEATHERS = f"""select weather_main, {_TOTAL} / count(price) as price from wide
where weather_main is not null group by weather_main"""
_QUANTITIES = """select product_id, avg(quantity) as quantity from wide
where product_id is not null group by product_id"""
_TOP_PRODUCTS = """select product_id, cast(sum(quantity) as bigint) as quantity from wide
where product_id is not null group by product_id order by 2 desc, 1 limit 5"""
_TOP_CUSTOMERS = f"{_CUSTOMERS} order by 2 desc, 1 limit 5"
_DAYS = f"""select order_date, {_TOTAL} as price from wide
where order_date is not null group by order_date"""


def _periods(unit: str) -> str:
    return f"""select cast(date_trunc('{unit}', order_date) as date) as order_date,
{_TOTAL} as price from wide where order_date is not null group by 1"""


_FLAT_USERS = """
select c_custkey as id, c_name as name, lower(c_name) as username,
       cast(c_custkey as varchar) || '@example.com' as email,
       cast(c_custkey as varchar) as phone, cast(null as varchar) as website,
       n_name || ' street' as "address.street", c_mktsegment as "address.suite",
       n_name as "address.city", cast(c_nationkey as varchar) as "address.zipcode",
       cast(c_custkey as varchar) as "address.geo.lat",
       cast(n_regionkey as varchar) as "address.geo.lng",
       c_mktsegment as "company.name", lower(c_mktsegment) as "company.catchPhrase",
       r_name as "company.bs"
from customer
join nation on c_nationkey = n_nationkey
join region on n_regionkey = r_regionkey
"""

_RESULTS = {
    "total_sales_per_customer": (_CUSTOMERS, "name", "price"),
    "top_selling_customers": (_TOP_CUSTOMERS, "name", "price"),
    "total_sales_per_address_city": (_CITIES, '"address.city"', "price"),
    "average_sales_per_weather": (_WEATHERS, "weather_main", "price"),
    "average_order_quantity_per_product": (_QUANTITIES, "product_id", "quantity"),
    "top_selling_products": (_TOP_PRODUCTS, "product_id", "quantity"),
    "sales_trends_over_time": (_DAYS, "order_date", "price"),
    "monthly_sales": (_periods("month"), "order_date", "price"),
    "quarterly_sales": (_periods("quarter"), "order_date", "price"),
}

_PAYLOAD = """
event_id as weather_id, event_type as weather_main, props as weather_description,
'e' as weather_icon, value as temp, value + 1 as feels_like, value - 1 as temp_min,
value * 2 as temp_max, user_id as pressure,
cast(json_extract_string(props, '$.k') as bigint) as humidity, value / 2 as wind_speed,
cast(json_extract_string(props, '$.k') as bigint) as wind_deg, event_id % 101 as cloudiness
"""

SQL = {
    "sales_enriched": f"{_INPUTS} select * from wide",
    "sales_enriched_sql": f"{_INPUTS} select * from wide",
    "users_with_weather": f"""{_INPUTS} select weather.*, users.*
from weather right join users on weather.user_info_table_id = users.id""",
    "sales_with_users": f"""{_INPUTS} select sales.*, users.*
from sales join users on sales.customer_id = users.id""",
    "preview": f"""{_INPUTS} select * from wide
order by order_id, product_id, quantity, price limit 5""",
    "total_sales_per_customer": _INPUTS + _CUSTOMERS,
    "top_selling_customers": _INPUTS + _TOP_CUSTOMERS,
    "total_sales_per_city": _INPUTS + _CITIES,
    "average_sales_per_weather": _INPUTS + _WEATHERS,
    "average_order_quantity_per_product": _INPUTS + _QUANTITIES,
    "top_selling_products": _INPUTS + _TOP_PRODUCTS,
    "sales_trends_daily": _INPUTS + _DAYS,
    "sales_trends_monthly": _INPUTS + _periods("month"),
    "sales_trends_quarterly": _INPUTS + _periods("quarter"),
    "reaggregated_customer_totals": f"""{_INPUTS}
select name, {_TOTAL} as price from ({_CUSTOMERS}) totals group by name""",
    "flatten_customer": _FLAT_USERS,
    "extract_payload": f"""
select {_PAYLOAD}, event_id * 10 as visibility, event_id
from events where event_type not in ('error', 'click', 'signup')""",
    "landed_payloads": f"""
select {_PAYLOAD}, event_id as visibility, user_id as user_info_table_id
from (select *, row_number() over (partition by user_id order by event_id desc) as place
      from events) ranked
where place = 1""",
    "lookup_enrich": """
select cast(800 + c_nationkey as bigint) as weather_id,
       case when c_nationkey % 2 = 1 then 'Clear' else 'Clouds' end as weather_main,
       'sky ' || cast(c_nationkey as varchar) as weather_description, '01d' as weather_icon,
       c_custkey / 4.0::double as temp, c_custkey / 8.0::double as feels_like,
       cast(c_nationkey as double) as temp_min, c_nationkey + 0.5::double as temp_max,
       cast(1000 + c_nationkey as bigint) as pressure, c_custkey % 100 as humidity,
       cast(10000 as bigint) as visibility, c_nationkey / 2.0::double as wind_speed,
       c_custkey % 360 as wind_deg, cast(c_nationkey as bigint) as cloudiness,
       c_custkey as user_info_table_id
from customer where c_custkey % 10 not in (3, 4, 5)""",
    "customer_ordinal": """
select c_custkey, c_name, row_number() over (order by c_custkey) as ordinal from customer""",
    "csv_roundtrip": f"{_INPUTS} select * from sales",
    "csv_row_index": """
select row_number() over (order by o_orderkey) - 1 as "index", o_orderkey, o_orderpriority
from orders""",
    "csv_line_breaks": """
select row_number() over (order by o_orderkey) - 1 as "index", o_orderkey,
  o_orderpriority || chr(10) || '"' || o_orderstatus || '",' || chr(10) || chr(10) || 'end' as o_note
from orders""",
    "json_roundtrip": _FLAT_USERS,
    "table_replace": f"{_INPUTS} select * from users",
    "snapshot_restore": f"""{_INPUTS} select sales.*, users.*
from sales join users on sales.customer_id = users.id""",
    "full_refresh_results": _INPUTS
    + " union all ".join(
        f"(select '{name}' as result, cast({key} as varchar) as key, "
        f"cast({value} as double) as value from ({text}) r)"
        for name, (text, key, value) in _RESULTS.items()
    ),
    "charges_by_flag": """select l_returnflag, cast(sum(cast(cast(l_extendedprice * l_discount * l_tax
as varchar) as decimal(38,20))) as double) as charge from lineitem group by l_returnflag""",
    # Each share is a whole number of 2**-66; the sum of those is exact and is rounded once.
    "shares_by_flag": """
select l_returnflag, t as total_share, t / n as mean_share from (
  select l_returnflag, n, ((s // 1099511627776)::double * 1099511627776::double + (s % 1099511627776)::double)
    / 73786976294838206464::double as t
  from (
    select l_returnflag, count(*)::double as n,
      sum((l_extendedprice::double / 3e5::double * 73786976294838206464::double)::hugeint)::hugeint as s
    from lineitem group by l_returnflag))""",
}
