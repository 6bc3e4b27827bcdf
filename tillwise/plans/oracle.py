"""Oracle SQL (DuckDB dialect) for every catalog key.

The oracle states each result the direct way (whole-partition windows,
EXISTS tests, joins at row grain), independent of the pre-aggregated and
skew-safe plans the Spark side uses, so agreement checks those rewrites.
Money is summed as integer cents, ``floor(x*100+0.5)``, exactly as on the
Spark side.  Averages and window frames add all binary digits of the values as
128-bit integers, another way than the Spark side's, and round once.
"""

from __future__ import annotations

import re

INGEST = "date '2001-08-01'"
RECENT_FROM = "date '1998-08-01'"  # as_of 2001-08-01 minus 36 months
GROWTH_START = "'2001-02'"          # as_of minus 6 months


def _cents(x: str) -> str:
    return f"cast(floor(({x})*100+0.5) as bigint)"


def _money_sum(x: str) -> str:
    return f"cast(sum({_cents(x)}) as double)/100"


def _digits(x: str) -> str:
    """A double as a whole number of 2^-75 (its binary digits, nothing rounded)."""
    return f"cast(({x}) * pow(2, 75) as hugeint)"


def _nearest(total: str) -> str:
    """The double nearest to a whole number of 2^-75 (through its decimal text)."""
    return f"cast(cast({total} as varchar) as double) / pow(2, 75)"


def _exact_avg(x: str) -> str:
    """Mean from the sum of all binary digits of the values."""
    return f"{_nearest(f'sum({_digits(x)})')} / count({x})"


def _exact_over(x: str, w: str) -> str:
    return _nearest(f"sum({_digits(x)}) over {w}")


VIEWS: dict[str, str] = {
    # ---- raw retail datasets derived from the driver tables
    "raw_stores": """
select n_nationkey as store_id,
  case when n_nationkey % 3 = 0 then concat('  ', n_name, ' ') else n_name end as location,
  case when r_name='AMERICA' and n_nationkey % 2 = 0 then 'NE'
       when r_name='AMERICA' then 'North-East'
       when r_name='ASIA' then 'Northeast' else r_name end as region,
  case n_nationkey % 8 when 0 then 'Small' when 1 then 'S' when 2 then 'Medium' when 3 then 'm'
       when 4 then 'Large' when 5 then 'L' when 6 then null else 'XXL' end as size,
  date '1990-01-01' + n_nationkey as opening_date
from nation join region on n_regionkey=r_regionkey""",
    "raw_customers": """
select c_custkey as customer_id,
  date '1995-01-01' + cast((c_custkey*37) % 2400 as int) as signup_date,
  c_mktsegment as segment,
  case when c_custkey % 11 = 0 then null
       else concat(c_name,'| ', case when c_custkey % 2 = 0 then 'F' else 'M' end,' |',
                   cast(18 + c_custkey % 60 as varchar)) end as demographics
from customer""",
    "raw_tx_base": """
select o_orderkey as transaction_id, cast(o_orderkey % 25 as int) as store_id,
  o_custkey as customer_id, cast(o_orderdate as date) as transaction_date,
  case when o_orderkey % 97 = 0 then null else o_totalprice end as total_amount
from orders""",
    "raw_transactions": """
select * from raw_tx_base union all
select transaction_id, store_id, customer_id,
  case when transaction_id % 3 = 1 then cast(transaction_date - 1 as date) else transaction_date end,
  case transaction_id % 3 when 1 then total_amount + 1000 when 2 then total_amount - 1
       else total_amount end
from raw_tx_base where transaction_id % 50 = 0""",
    "raw_items": """
select l_orderkey as transaction_id, l_partkey as product_id, cast(l_quantity as int) as quantity,
  case when l_linenumber = 7 then null
       else cast(floor(l_extendedprice / l_quantity * 1000) as double) / 1000 end as unit_price,
  case when l_returnflag='R' and l_linenumber = 1 then null
       else cast(round(l_discount*100) as double)*4 end as discount
from lineitem""",
    "raw_products": """
select p_partkey as product_id,
  concat(p_name, case when p_type='ECONOMY' then ' Eco' else '' end) as product_name,
  p_size as category_id,
  case when p_partkey % 101 = 0 then null when p_partkey % 103 = 1 then 699.995e0
       else cast((p_partkey*50) % 1000 as double) end as base_price,
  p_partkey % (select count(*) from supplier) as supplier_id
from part""",
    "raw_inventory": """
select cast(l_suppkey % 27 as int) as store_id, l_partkey as product_id,
  cast(max(l_shipdate) as date) as date,
  cast(sum(l_quantity) as int) % 60 - case when l_partkey % 53 = 0 then 60 else 0 end as quantity,
  cast(l_partkey % 50 as int) as reorder_point
from lineitem group by l_suppkey % 27, l_partkey""",
    "raw_promotions": """
select p_partkey as promo_id,
  date '1995-01-01' + cast(s as int) as start_date, date '1995-01-01' + cast(s + 180 as int) as end_date,
  p_type as discount_type,
  case when p_partkey % 7 = 0 then p_partkey + 100000000 when p_partkey % 5 = 0 then p_partkey - 1
       else p_partkey end as product_id
from (select *, case when p_partkey % 5 = 0 and p_partkey % 11 <> 0 then ((p_partkey - 1) * 13) % 2000 + 60
                     else (p_partkey * 13) % 2000 + case when p_partkey % 11 = 0 then 20000 else 0 end
                     end as s from part)""",
    "raw_suppliers": """
select s_suppkey as supplier_id, cast(1 + (s_suppkey*7) % 30 as int) as lead_time,
  case when s_suppkey % 7 = 3 then null else floor((s_acctbal+1000)/11000*50000)/10000 end as reliability_score,
  n_name as country, s_nationkey as store_id
from supplier join nation on s_nationkey=n_nationkey""",
    # ---- cleaned datasets
    "tx_dedup": """
select transaction_id, store_id, customer_id, transaction_date, total_amount from (
  select *, row_number() over (partition by transaction_id, store_id
    order by transaction_date desc nulls last, total_amount desc nulls last,
             customer_id desc nulls last) as rn
  from raw_transactions) where rn = 1""",
    "transactions_clean": f"""
select *, cast(month(transaction_date) as int) as month, {INGEST} as file_received_date
from tx_dedup where total_amount is not null and total_amount > 0""",
    "item_means": f"""
select product_id, {_exact_avg('unit_price')} as mean_price
from raw_items where unit_price is not null group by product_id""",
    "items_clean": f"""
select i.transaction_id, i.product_id, i.quantity,
  coalesce(i.unit_price, m.mean_price) as unit_price, i.discount,
  {INGEST} as file_received_date,
  case when i.discount < 20 then 'L' when i.discount >= 20 then 'H'
       else cast(i.discount as varchar) end as high_discount_flag
from raw_items i left join item_means m on i.product_id is not distinct from m.product_id""",
    "stores_clean": f"""
select *, {INGEST} as file_received_date,
  case when lower(region) in ('north-east', 'ne') then 'Northeast' else region end as new_region,
  concat_ws('_', region, location) as full_location
from raw_stores""",
    "customers_clean": f"""
select c.*, {INGEST} as file_received_date, cast(year(signup_date) as int) as year
from raw_customers c
where customer_id in (select customer_id from transactions_clean
                      where transaction_date >= {RECENT_FROM})""",
    "products_clean": f"""
select *, {INGEST} as file_received_date,
  case when base_price <= 400 then 'Low'
       when base_price between 399.99 and 699.99 then 'Medium'
       when base_price >= 700 then 'High'
       else cast(base_price as varchar) end as price_range
from raw_products""",
    "inventory_gap": f"""
select *, {INGEST} as file_received_date, quantity - reorder_point as quantity_gap,
  round((quantity - reorder_point) / nullif(quantity, 0) * 100) as quantity_percent
from raw_inventory""",
    "inventory_clean": """
select *, case when quantity_percent < 50 then 'L' when quantity_percent >= 50 then 'H'
               else cast(quantity_percent as varchar) end as critical_quantity_gap_flag
from inventory_gap""",
    "promotions_clean": f"select *, {INGEST} as file_received_date from raw_promotions",
    "suppliers_clean": f"select *, {INGEST} as file_received_date from raw_suppliers",
    # ---- shared intermediate results
    "valid_stores": """
select store_id,
  case lower(size) when 'small' then 'Small' when 's' then 'Small'
                   when 'medium' then 'Medium' when 'm' then 'Medium'
                   when 'large' then 'Large' when 'l' then 'Large' else size end as size,
  new_region
from stores_clean where size in ('Small', 'Large', 'Medium', 'S', 'L', 'M')""",
    "orphan_items": """
select i.* from items_clean i
where not exists (select 1 from transactions_clean t where t.transaction_id = i.transaction_id)""",
    "orphan_inventory": """
select i.* from inventory_clean i
where not exists (select 1 from stores_clean s where s.store_id = i.store_id)""",
    "orphan_promotions": """
select p.* from promotions_clean p
where not exists (select 1 from products_clean x where x.product_id = p.product_id)""",
    "region_reliability": """
select s.new_region, su.supplier_id, max(su.reliability_score) as max_reliability_score
from suppliers_clean su join stores_clean s on su.store_id = s.store_id
where su.supplier_id in (select supplier_id from products_clean)
group by s.new_region, su.supplier_id""",
    "monthly_sales": f"""
select i.product_id, strftime(t.transaction_date, '%Y-%m') as year_month,
  {_money_sum('i.quantity * i.unit_price')} as monthly_sales
from items_clean i join transactions_clean t on i.transaction_id = t.transaction_id
where i.product_id in (select product_id from products_clean)
group by 1, 2""",
    "monthly_growth": """
select product_id, year_month, monthly_sales,
  lag(monthly_sales) over (partition by product_id order by year_month) as previous_month_sales,
  (monthly_sales - lag(monthly_sales) over (partition by product_id order by year_month))
    / nullif(lag(monthly_sales) over (partition by product_id order by year_month), 0) * 100
    as sales_growth
from monthly_sales""",
    "promo_lines": """
select i.transaction_id, i.product_id, i.quantity, i.unit_price, t.transaction_date,
  case when exists (select 1 from promotions_clean p where p.product_id = i.product_id
                    and t.transaction_date between p.start_date and p.end_date)
       then 1 else 0 end as is_promoted
from items_clean i join transactions_clean t on i.transaction_id = t.transaction_id""",
}

_W_RUN = "(partition by store_id order by transaction_date)"

QUERIES: dict[str, str] = {
    "src_dated_scan": "select * from raw_transactions",
    "src_items": "select * from raw_items",
    "src_customers": "select * from raw_customers",
    "src_products": "select * from raw_products",
    "src_inventory": "select * from raw_inventory",
    "src_promotions": "select * from raw_promotions",
    "src_suppliers": "select * from raw_suppliers",
    "src_ingest_date": f"select *, {INGEST} as file_received_date from raw_stores",
    "clean_dedup_transactions": "select * from tx_dedup",
    "filter_valid_amount": "select * from transactions_clean",
    "filter_recent_transactions": f"""
select transaction_id, customer_id, transaction_date, total_amount
from transactions_clean where transaction_date >= {RECENT_FROM}""",
    "date_transaction_month": "select transaction_id, transaction_date, month from transactions_clean",
    "filter_discounted_items": "select * from items_clean where discount is not null",
    "clean_discount_flag": """
select transaction_id, product_id, discount,
  case when discount < 20 then 'L' when discount >= 20 then 'H'
       else cast(discount as varchar) end as high_discount_flag
from raw_items""",
    "clean_impute_price": "select transaction_id, product_id, quantity, unit_price from items_clean",
    "proj_line_revenue": """
select transaction_id, product_id, quantity, unit_price, quantity * unit_price as line_revenue
from items_clean""",
    "clean_price_band": "select product_id, base_price, price_range from products_clean",
    "filter_product_like": """
select product_id, product_name, category_id, base_price, supplier_id
from products_clean where product_name like '%Eco%'""",
    "clean_critical_stock": """
select store_id, product_id, quantity_percent, critical_quantity_gap_flag from inventory_clean""",
    "clean_inventory_gap": """
select store_id, product_id, quantity, reorder_point, quantity_gap, quantity_percent
from inventory_clean""",
    "clean_region": "select store_id, region, new_region from stores_clean",
    "clean_fill_size": """
select store_id, region, coalesce(size, (
  select size from stores_clean where size is not null
  group by size order by count(*) desc, size asc limit 1)) as size
from stores_clean""",
    "clean_fill_size_by_region": """
select s.store_id, s.region, coalesce(s.size, m.size) as size
from stores_clean s left join (
  select region, size from (
    select region, size, row_number() over (partition by region order by n desc, size asc) as rn
    from (select region, size, count(*) as n from stores_clean where size is not null
          group by region, size)) where rn = 1) m
  on s.region is not distinct from m.region""",
    "clean_demographics_unknown": """
select customer_id, segment,
  string_split(coalesce(demographics, 'unknown'), '|')[1] as name,
  trim(string_split(coalesce(demographics, 'unknown'), '|')[2]) as sex,
  try_cast(trim(string_split(coalesce(demographics, 'unknown'), '|')[3]) as integer) as age
from customers_clean""",
    "clean_impute_reliability": f"""
with pc as (select supplier_id, count(distinct product_id) as product_count
            from products_clean group by supplier_id),
     sc as (select supplier_id, {_exact_avg('reliability_score')} as ws
            from suppliers_clean where reliability_score is not null group by supplier_id),
     w as (select sc.ws / pc.product_count as wavg from sc join pc on sc.supplier_id = pc.supplier_id),
     g as (select {_exact_avg('wavg')} as m from w)
select supplier_id, country, reliability_score,
  coalesce(reliability_score, (select m from g)) as imputed_reliability_score
from suppliers_clean""",
    "str_split_demographics": """
select customer_id,
  string_split(demographics, '|')[1] as name,
  trim(string_split(demographics, '|')[2]) as sex,
  try_cast(trim(string_split(demographics, '|')[3]) as integer) as age
from customers_clean""",
    "str_trim_location": "select store_id, trim(location) as location from stores_clean",
    "str_upper_size": "select store_id, upper(size) as size from stores_clean",
    "str_full_location": "select store_id, full_location from stores_clean",
    "date_signup_year": "select customer_id, signup_date, year from customers_clean",
    "validate_orphan_items": """
select transaction_id, product_id, quantity, unit_price, discount from orphan_items""",
    "validate_inventory_store": """
select store_id, product_id, date, quantity, reorder_point from orphan_inventory""",
    "validate_non_negative": """
select store_id, product_id, quantity, 'invalid' as quantity_status
from inventory_clean where quantity < 0""",
    "validate_promo_product": """
select promo_id, product_id,
  exists (select 1 from products_clean x where x.product_id = p.product_id) as is_valid
from promotions_clean p""",
    "validate_store_size": "select store_id, size, new_region from valid_stores",
    "validate_summary": """
select 'orphan_items' as rule, count(*) as violations from orphan_items
union all select 'inventory_store', count(*) from orphan_inventory
union all select 'negative_quantity', count(*) from inventory_clean where quantity < 0
union all select 'promo_product', count(*) from orphan_promotions
union all select 'store_size', count(*) from stores_clean
  where not coalesce(size in ('Small', 'Large', 'Medium', 'S', 'L', 'M'), false)""",
    "join_three_way": """
select t.transaction_id, t.store_id, t.customer_id, t.transaction_date, i.product_id,
  i.quantity, i.unit_price, p.category_id, p.product_name
from transactions_clean t join items_clean i on t.transaction_id = i.transaction_id
join products_clean p on i.product_id = p.product_id""",
    "join_category_revenue_share": f"""
with c as (
  select p.category_id, sum({_cents('i.quantity * i.unit_price')}) as cents
  from items_clean i join products_clean p on i.product_id = p.product_id
  where i.transaction_id in (select transaction_id from transactions_clean)
  group by p.category_id)
select category_id, cast(cents as double)/100 as total_revenue,
  (cast(cents as double)/100) / (select cast(sum(cents) as double)/100 from c) * 100 as revenue_share
from c""",
    "join_promo_customers": """
select customer_id, string_split(coalesce(demographics, 'unknown'), '|')[1] as name
from customers_clean
where customer_id in (
  select t.customer_id from transactions_clean t join items_clean i
    on t.transaction_id = i.transaction_id
  where i.product_id in (select product_id from promotions_clean))""",
    "join_region_reliability": "select * from region_reliability",
    "join_region_best_supplier": """
select new_region, supplier_id, max_reliability_score from (
  select *, rank() over (partition by new_region
                         order by max_reliability_score desc nulls last) as r
  from region_reliability) where r = 1""",
    "join_stockouts": """
select i.store_id, i.product_id, i.quantity, i.reorder_point, v.new_region, v.size,
  true as stock_out
from inventory_clean i join valid_stores v on i.store_id = v.store_id
where coalesce(i.quantity <= i.reorder_point, false)""",
    "join_segment_revenue": f"""
select c.segment, {_money_sum('t.total_amount')} as total_revenue
from transactions_clean t join customers_clean c on t.customer_id = c.customer_id
group by c.segment""",
    "join_recent_customers": f"""
select c.customer_id, c.segment, t.transaction_id, cast(year(c.signup_date) as int) as year
from raw_customers c join transactions_clean t on c.customer_id = t.customer_id
where t.transaction_date >= {RECENT_FROM}""",
    "join_promo_interval": """
select i.transaction_id, i.product_id, t.transaction_date, i.quantity, i.unit_price,
  p.promo_id, p.start_date, p.end_date
from items_clean i join transactions_clean t on i.transaction_id = t.transaction_id
left join promotions_clean p on i.product_id = p.product_id
  and t.transaction_date between p.start_date and p.end_date""",
    "join_broadcast_stores": """
select t.transaction_id, t.store_id, t.total_amount, s.new_region, s.size
from transactions_clean t join stores_clean s on t.store_id = s.store_id""",
    "agg_median_lead_time": """
select country, quantile_disc(lead_time, 0.5) as median_lead_time
from suppliers_clean group by country""",
    "agg_mode_size": """
select size, count(*) as frequency from stores_clean where size is not null
group by size order by frequency desc, size asc limit 1""",
    "agg_distinct_rows": "select distinct * from raw_transactions",
    "window_running_avg": f"""
select transaction_id, store_id, transaction_date,
  {_exact_over('total_amount', _W_RUN)} / count(total_amount) over {_W_RUN} as running_avg
from transactions_clean""",
    "window_running_sum": f"""
select transaction_id, store_id, transaction_date,
  {_exact_over('total_amount', _W_RUN)} as running_sum
from transactions_clean""",
    "window_running_count": f"""
select transaction_id, store_id, transaction_date,
  count(total_amount) over {_W_RUN} as running_count
from transactions_clean""",
    "window_rolling_7_rows": f"""
select transaction_id, store_id, transaction_date,
  {_exact_over('total_amount', 'w')} / count(total_amount) over w
    as rolling_avg_7_rows
from transactions_clean
window w as (partition by store_id order by transaction_date, transaction_id
             rows between 6 preceding and current row)""",
    "window_rolling_7_days": f"""
select transaction_id, store_id, transaction_date,
  {_exact_over('total_amount', 'w')} / count(total_amount) over w
    as rolling_avg_7_days
from transactions_clean
window w as (partition by store_id order by transaction_date
             range between interval 6 days preceding and current row)""",
    "calc_retention": """
with a as (select count(distinct c.customer_id) as n
           from customers_clean c join transactions_clean t on c.customer_id = t.customer_id
           where t.transaction_date >= c.signup_date),
     b as (select count(distinct customer_id) as n from customers_clean)
select a.n as active_customers, b.n as total_customers, a.n / b.n as retention_rate
from a, b""",
    "calc_monthly_growth": "select * from monthly_growth",
    "calc_consistent_growth": f"""
select product_id, count(case when sales_growth > 0 then 1 end) as positive_growth_count,
  count(sales_growth) as total_months
from monthly_growth where year_month >= {GROWTH_START}
group by product_id
having count(case when sales_growth > 0 then 1 end) = count(sales_growth)
   and count(sales_growth) > 0""",
    "calc_supplier_rank": """
select supplier_id, country, reliability_score,
  cast(rank() over (partition by country order by reliability_score asc nulls first) as int)
    as reliability_rank
from suppliers_clean""",
    "calc_category_lead_time": """
select p.category_id, cast(sum(s.lead_time) as double) / count(s.lead_time) as avg_lead_time
from products_clean p join suppliers_clean s on p.supplier_id = s.supplier_id
group by p.category_id""",
    "rep_weekly_revenue": f"""
select store_id, cast(week(transaction_date) as int) as week_of_year,
  {_money_sum('total_amount')} as weekly_revenue
from transactions_clean where store_id in (select store_id from stores_clean)
group by 1, 2""",
    "rep_weekly_revenue_by_year": f"""
select store_id, cast(isoyear(transaction_date) as int) as iso_year,
  cast(week(transaction_date) as int) as week_of_year,
  {_money_sum('total_amount')} as weekly_revenue
from transactions_clean where store_id in (select store_id from stores_clean)
group by 1, 2, 3""",
    "rep_discount_impact": f"""
with pr as (select * from items_clean where unit_price is not null
            and product_id in (select product_id from products_clean)),
     l as (select distinct transaction_id, product_id, quantity, unit_price, discount from pr
           where discount = (select max(discount) from pr))
select product_id, {_money_sum('quantity * unit_price')} as total_revenue,
  {_money_sum('quantity * unit_price - (discount / 100 * unit_price) * quantity')}
    as discounted_revenue
from l group by product_id""",
    "rep_promo_revenue": f"""
select is_promoted, {_money_sum('quantity * unit_price')} as total_revenue,
  count(distinct transaction_id) as transaction_count, count(*) as line_count
from promo_lines group by is_promoted""",
    "rep_promo_uplift": f"""
with s as (
  select cast(sum(case when is_promoted = 1 then {_cents('quantity * unit_price')} end)
              as double)/100 as promoted_revenue,
         cast(sum(case when is_promoted = 0 then {_cents('quantity * unit_price')} end)
              as double)/100 as non_promoted_revenue
  from promo_lines)
select promoted_revenue, non_promoted_revenue,
  (promoted_revenue - non_promoted_revenue) / nullif(non_promoted_revenue, 0) * 100 as uplift_pct
from s""",
    "rep_top_stores": f"""
with rev as (select store_id, {_money_sum('total_amount')} as total_revenue
             from transactions_clean where store_id in (select store_id from stores_clean)
             group by store_id),
     sup as (select s.store_id, count(distinct p.product_id) as distinct_products
             from products_clean p join suppliers_clean s on p.supplier_id = s.supplier_id
             group by s.store_id)
select rev.store_id, total_revenue, distinct_products
from rev join sup on rev.store_id = sup.store_id
order by total_revenue desc, distinct_products desc, rev.store_id asc limit 5""",
    "rep_region_dashboard": f"""
with tx as (select t.*, s.region from transactions_clean t join stores_clean s
            on t.store_id = s.store_id),
     rev as (select region, {_money_sum('total_amount')} as total_revenue from tx group by region),
     lines as (select i.transaction_id, i.product_id, i.discount, tx.region
               from items_clean i join tx on i.transaction_id = tx.transaction_id),
     disc as (select region, {_exact_avg('discount')} as average_discount
              from lines group by region),
     pp as (select l.region, l.product_id, p.product_name, count(l.transaction_id) as product_sales
            from lines l join products_clean p on l.product_id = p.product_id
            group by l.region, l.product_id, p.product_name),
     top as (select region, product_name as top_product from (
               select *, row_number() over (partition by region
                                            order by product_sales desc, product_id asc) as rn
               from pp) where rn = 1),
     tot as (select region, cast(sum(product_sales) as bigint) as total_sales from pp
             group by region)
select rev.region, total_revenue, average_discount, top_product, total_sales
from rev join disc on rev.region = disc.region join top on rev.region = top.region
join tot on rev.region = tot.region
order by total_sales desc, rev.region asc""",
    "layout_repartition_product": """
select transaction_id, product_id, quantity, unit_price, discount from items_clean""",
}


def _deps(sql: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]


def resolve(sql: str) -> str:
    """Prefix ``sql`` with the views it uses (transitively), in order."""
    ordered: list[str] = []

    def visit(name: str, seen: tuple = ()):
        if name in ordered:
            return
        for dep in _deps(VIEWS[name]):
            if dep != name and dep not in seen:
                visit(dep, seen + (name,))
        ordered.append(name)

    for name in _deps(sql):
        visit(name)
    if not ordered:
        return sql.strip()
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in ordered)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"


def oracle_sql() -> dict[str, str]:
    return {key: resolve(sql) for key, sql in QUERIES.items()}
