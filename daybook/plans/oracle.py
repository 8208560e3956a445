"""The same results in plain SQL over the star-schema tables, for the queries in `queries.py`."""

from __future__ import annotations

ORDERS = """
d_orders as (
  select o_orderkey as order_id, o_custkey as user_id, cast(o_orderdate as date) as order_date
  from orders)"""
ITEMS = """
d_items as (
  select l_orderkey as order_id, l_linenumber as item_id, l_partkey as product_id,
         cast(l_extendedprice as float) as sale_price,
         case when l_returnflag = 'R' then 1 else 0 end as is_returned
  from lineitem)"""
PRODUCTS = """
d_products as (select p_partkey as product_id, p_type as category from part)"""
GAPS = """
d_products as (select p_partkey as product_id, nullif(p_type, 'PROMO') as category from part)"""

CATEGORY = """
category_days as (
  select category, order_date,
         round(sum(sale_price), 2) as daily_revenue,
         round(sum(sale_price) / count(distinct i.order_id), 2) as avg_order_value,
         round(sum(is_returned) / count(distinct i.order_id), 4) as avg_return_rate
  from d_items i join d_orders o on i.order_id = o.order_id
       join d_products p on i.product_id = p.product_id
  group by category, order_date)"""
DAYS = """
days as (
  select order_date,
         count(distinct i.order_id) as total_orders,
         round(sum(sale_price), 2) as total_revenue,
         count(item_id) as total_items_sold,
         round(sum(is_returned) / count(distinct i.order_id), 4) as return_rate,
         count(distinct user_id) as unique_customers
  from d_items i join d_orders o on i.order_id = o.order_id
  group by order_date)"""


def _with(*parts: str, select: str) -> str:
    return "with " + ",".join(parts) + "\n" + select


def _category(select: str = "select * from category_days", products: str = PRODUCTS) -> str:
    return _with(ORDERS, ITEMS, products, CATEGORY, select=select)


def _days(select: str = "select * from days") -> str:
    return _with(ORDERS, ITEMS, DAYS, select=select)


# --- file drops ------------------------------------------------------------------------------

CATALOGUE = """
catalogue as (
  select 'orders' as dataset, 'orders/' || o_custkey || '/' || o_orderpriority || '.csv' as key,
         case o_orderpriority
           when '1-URGENT' then 'order_id,user_id,created_at,status'
           when '2-HIGH' then '"order_id", user_id ,created_at,"status"'
           when '3-MEDIUM' then 'note,user_id,order_id,status,created_at'
           when '4-NOT SPECIFIED' then 'order_id,user_id,created_at' end as header_line
  from (select distinct o_custkey, o_orderpriority from orders)
  union all
  select 'order_items', 'order_items/' || l_suppkey || '/' || state || '.csv',
         case state
           when 'RF' then 'id,order_id,product_id,sale_price'
           when 'RO' then 'id,order_id,product_id,sale_price,status,order_date'
           when 'AF' then 'id,order_id,product_id'
           when 'NF' then '"id","order_id","product_id","sale_price","gift, wrapped"'
           when 'NO' then '  ' end
  from (select distinct l_suppkey, l_returnflag || l_linestatus as state from lineitem)
  union all
  select 'products', 'products/' || p_brand || '/' || p_type || '/' || p_size || '.csv',
         case p_type
           when 'STANDARD' then 'id,sku,cost,category,retail_price'
           when 'SMALL' then 'id,sku,cost,category,retail_price'
           when 'ECONOMY' then 'id,name,retail_price'
           when 'MEDIUM' then 'retail_price,category,cost,sku,id'
           when 'PROMO' then 'Id,SKU,cost,category,retail_price'
           when 'LARGE' then 'id,sku,cost,category,retail_price,say ""hi""' end
  from (select distinct p_brand, p_type, p_size from part))"""

# Names of each header line, spelled out rather than parsed.
NAMED = """
named as (
  select *,
    case
      when header_line is null or trim(header_line) = '' then null
      when header_line like '%gift, wrapped%' then ['id','order_id','product_id','sale_price','gift, wrapped']
      when header_line like '"%' then ['order_id','user_id','created_at','status']
      else string_split(header_line, ',') end as found,
    case dataset
      when 'orders' then ['order_id','user_id','created_at','status']
      when 'order_items' then ['id','order_id','product_id','sale_price']
      else ['id','sku','cost','category','retail_price'] end as required
  from catalogue)"""

CHECKED = """
checked as (
  select *, found is not null and len(missing) = 0 as is_valid from (
    select *,
      case when found is null then [] else list_filter(required, lambda c: not list_contains(found, c)) end as missing,
      case when found is null then [] else list_filter(found, lambda c: not list_contains(required, c)) end as extra
    from named))"""

ISSUES = """concat_ws('; ',
    case when found is null then 'Could not read file headers' end,
    case when len(missing) > 0 then 'Missing mandatory fields: [''' || array_to_string(missing, ''', ''') || ''']' end,
    case when len(extra) > 0 then 'Additional fields found: [''' || array_to_string(extra, ''', ''') || ''']' end)"""

VERDICTS = f"""
verdicts as (
  select dataset, key,
    case when is_valid then 'passed' when found is not null then 'quarantined' else 'failed' end as status,
    case when is_valid then '' else {ISSUES} end as issues
  from checked)"""

ROLLUP = """
per_dataset as (
  select d.dataset, count(v.key) as total_files,
         count(*) filter (v.status = 'passed') as passed,
         count(*) filter (v.status <> 'passed') as failed,
         count(*) filter (v.status = 'quarantined') as quarantined
  from (values ('orders'), ('order_items'), ('products')) d(dataset)
       left join verdicts v on v.dataset = d.dataset
  group by d.dataset)"""


def _files(select: str, *more: str) -> str:
    return _with(CATALOGUE, NAMED, CHECKED, *more, select=select)


MIXED_FOLDERS = """
folders as (
  select 'orders' as dataset,
    case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high' when '3-MEDIUM' then 'medium'
      when '4-NOT SPECIFIED' then 'unspecified' else 'low' end as folder,
    case o_orderpriority when '1-URGENT' then 'order_id,user_id,created_at,status'
      when '2-HIGH' then 'user_id,order_id,created_at,status'
      when '3-MEDIUM' then 'note,status,created_at,user_id,order_id'
      when '4-NOT SPECIFIED' then 'order_id,user_id,created_at'
      else '"order_id","user_id","created_at","status"' end as header_line, count(*) as rows
  from orders group by all
  union all
  select 'order_items', 'all', 'id,order_id,product_id,sale_price,status', count(*) from lineitem group by all
  union all
  select 'products', 'all', 'id,sku,cost,category,retail_price', count(*) from part group by all)"""

ARRIVALS = """
arrivals as (
  select distinct cast(o_orderdate as date) as day, 'orders' as dataset, o_orderpriority as name from orders
  union all
  select distinct cast(l_shipdate as date), 'order_items', l_returnflag from lineitem
  union all
  select min(cast(l_shipdate as date)), 'products', cast(l_partkey as varchar) from lineitem group by l_partkey)"""

COUNTS = """
counts as (
  select 'orders' as dataset, count(*) as source_rows from orders
  union all select 'order_items', count(*) from lineitem
  union all select 'products', count(*) from part)"""

OUTCOME = """
  select count(*) filter (category is not null and order_date is not null) as written,
         count(*) filter (category is null or order_date is null) as rejected
  from category_days"""

REPORT_PARTS = (
    CATALOGUE,
    NAMED,
    CHECKED,
    VERDICTS,
    ORDERS,
    ITEMS,
    GAPS,
    CATEGORY,
    DAYS,
    "\noutcome as (" + OUTCOME + ")",
    """
facts as (
  select (select written from outcome) as category_rows,
         (select rejected from outcome) as rejected,
         (select count(*) from days) as order_rows,
         count(*) as total_files,
         count(*) filter (status = 'passed') as passed,
         count(*) filter (status <> 'passed') as failed,
         count(*) filter (status = 'quarantined') as quarantined,
         count(*) filter (status = 'failed') as unmoved,
         count(*) filter (status = 'passed' and dataset = 'orders') as n_orders,
         count(*) filter (status = 'passed' and dataset = 'order_items') as n_items,
         count(*) filter (status = 'passed' and dataset = 'products') as n_products
  from verdicts)""",
)

# Exact cents: half-up division of integers.
CENTS_ITEMS = """
c_items as (
  select l_orderkey as order_id, l_linenumber as item_id, l_partkey as product_id,
         cast(round(l_extendedprice * 100) as bigint) as cents,
         case when l_returnflag = 'R' then 1 else 0 end as is_returned
  from lineitem)"""


def _half(state: str, name: str) -> str:
    return f"""
{name} as (
  select order_date,
         count(distinct i.order_id) as total_orders,
         round(sum(sale_price), 2) as total_revenue,
         count(item_id) as total_items_sold,
         round(sum(is_returned) / count(distinct i.order_id), 4) as return_rate,
         count(distinct user_id) as unique_customers
  from (select l_orderkey as order_id, l_linenumber as item_id, cast(l_extendedprice as float) as sale_price,
               case when l_returnflag = 'R' then 1 else 0 end as is_returned
        from lineitem where l_linestatus = '{state}') i
       join d_orders o on i.order_id = o.order_id
  group by order_date)"""


ITEM_STATUS = "case l_returnflag when 'R' then 'returned' when 'A' then 'completed' else 'shipped' end"

ORACLE: dict[str, str] = {
    "csv_scan": f"""select cast(l_linenumber as bigint) as id, l_orderkey as order_id, l_partkey as product_id,
        cast(l_extendedprice as float) as sale_price, {ITEM_STATUS} as status from lineitem""",
    "csv_union_by_name": """select o_orderkey as order_id, o_custkey as user_id,
        cast(o_orderdate as date) as order_date from orders where o_orderpriority <> '4-NOT SPECIFIED'""",
    "file_inventory": _with(
        MIXED_FOLDERS, select="select dataset, folder, true as has_files, true as has_bytes, rows from folders"
    ),
    "base_prefix": _with(
        CATALOGUE,
        """
keys as (
  select url as key from pages
  union all select key from catalogue
  union all select replace(key, '.csv', '/') from catalogue
  union all select p_name from part)""",
        select="select key, regexp_extract(key, '^(.*/)', 1) as prefix from keys",
    ),
    "source_counts": _with(COUNTS, select="select * from counts"),
    "non_empty_guard": _with(COUNTS, select="select dataset, source_rows, source_rows > 0 as has_rows from counts"),
    "quarantine_verdicts": _with(
        MIXED_FOLDERS,
        select="""select dataset, folder, case folder when 'unspecified' then 'quarantined' else 'passed' end as status,
       rows from folders""",
    ),
    "file_headers": _with(MIXED_FOLDERS, select="select * from folders"),
    "file_headers_scanned": _with(MIXED_FOLDERS, select="select * from folders"),
    "header_columns": _files("select key, array_to_string(found, '|') as names from checked"),
    "schema_verdict": _files(
        f"""select dataset, key, is_valid, array_to_string(missing, '|') as missing,
        array_to_string(extra, '|') as extra, {ISSUES} as issues from checked"""
    ),
    "file_verdicts": _files("select * from verdicts", VERDICTS),
    "validation_rollup": _files(
        """select *, case when total_files = 0 then 'no_files' else 'processed' end as status from per_dataset
union all
select 'all', cast(sum(total_files) as bigint), cast(sum(passed) as bigint), cast(sum(failed) as bigint),
       cast(sum(quarantined) as bigint), null from per_dataset""",
        VERDICTS,
        ROLLUP,
    ),
    "validation_status": _files(
        """select case when min(total_files) = 0 then 'failure' when sum(failed) > 0 then 'partial_success'
         else 'success' end as status,
       case when min(total_files) = 0 then 'Missing required data folders' when sum(failed) > 0
         then sum(failed) || ' files failed validation and were quarantined' end as message,
       coalesce(string_agg(case when total_files = 0 then dataset end, '|'), '') as missing_datasets,
       cast(sum(total_files) as bigint) as total_files, cast(sum(failed) as bigint) as failed,
       cast(sum(passed) as bigint) as usable_files, min(passed) as usable_per_dataset
from per_dataset""",
        VERDICTS,
        ROLLUP,
    ),
    "quarantine_split": """select o_orderkey as order_id,
        case when o_orderpriority = '4-NOT SPECIFIED' then 'quarantined' else 'good' end as side from orders""",
    "completeness_gate": _with(
        ARRIVALS,
        """
per_day as (
  select day, count(*) filter (dataset = 'orders') as orders_files,
         count(*) filter (dataset = 'order_items') as order_items_files,
         count(*) filter (dataset = 'products') as products_files
  from arrivals group by day)""",
        select="""select day, orders_files > 0 as has_orders, order_items_files > 0 as has_order_items,
       products_files > 0 as has_products, orders_files, order_items_files, products_files,
       concat_ws('|', case when orders_files = 0 then 'orders' end,
                      case when order_items_files = 0 then 'order_items' end,
                      case when products_files = 0 then 'products' end) as missing_folders,
       orders_files > 0 and order_items_files > 0 and products_files > 0 as triggered,
       case when orders_files > 0 and order_items_files > 0 and products_files > 0
            then 'Complete file set' else 'Waiting for complete file set' end as message
from per_day""",
    ),
    "project_items": _with(ITEMS, select="select order_id, item_id, sale_price, is_returned from d_items"),
    "order_dates": _with(ORDERS, select="select * from d_orders"),
    "float_price": _with(ITEMS, select="select order_id, product_id, sale_price from d_items"),
    "returned_flag": f"""select l_orderkey as order_id, l_linenumber as id, {ITEM_STATUS} as status,
        case when l_returnflag = 'R' then 1 else 0 end as is_returned from lineitem""",
    "rounded_ratio": _with(
        ITEMS,
        select="""select order_id, round(sum(sale_price) / count(*), 2) as avg_price,
        round(sum(is_returned) / count(*), 4) as returned_share from d_items group by order_id""",
    ),
    "sink_key_filter": _category("select * from category_days where category is not null", GAPS),
    "sink_rows": _category(
        """select category, strftime(order_date, '%Y-%m-%d') as order_date,
        cast(cast(daily_revenue as varchar) as decimal(38,18)) as daily_revenue,
        cast(cast(avg_order_value as varchar) as decimal(38,18)) as avg_order_value,
        cast(cast(avg_return_rate as varchar) as decimal(38,18)) as avg_return_rate from category_days"""
    ),
    "sink_rows_six_digits": """select cast(o_orderkey as decimal(28,0)) as o_orderkey,
       cast(cast(o_totalprice as decimal(14,2)) * cast('0.000123' as decimal(7,6)) as decimal(24,8)) as share,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000007' as late,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as o_orderdate
from orders""",
    "sink_rows_orders": _days(
        """select strftime(order_date, '%Y-%m-%d') as order_date,
        cast(total_orders as decimal(28,0)) as total_orders, cast(cast(total_revenue as varchar) as decimal(38,18)) as total_revenue,
        cast(total_items_sold as decimal(28,0)) as total_items_sold,
        cast(cast(return_rate as varchar) as decimal(38,18)) as return_rate,
        cast(unique_customers as decimal(28,0)) as unique_customers from days"""
    ),
    "archive_paths": """select o_orderkey as order_id, 'processed/run-1/' || strftime(o_orderdate, '%Y%m%d_%H%M%S')
        || '/orders/' || o_orderkey || '.csv' as target_path from orders""",
    "items_orders": _with(
        ORDERS,
        ITEMS,
        select="""select i.order_id, item_id, product_id, sale_price, is_returned, user_id, order_date
from d_items i join d_orders o on i.order_id = o.order_id""",
    ),
    "items_orders_products": _with(
        ORDERS,
        ITEMS,
        PRODUCTS,
        select="""select i.product_id, i.order_id, item_id, sale_price, is_returned, user_id, order_date, category
from d_items i join d_orders o on i.order_id = o.order_id join d_products p on i.product_id = p.product_id""",
    ),
    "revenue_by_category_day": _category("select category, order_date, daily_revenue from category_days"),
    "revenue_by_day": _days("select order_date, total_revenue from days"),
    "distinct_orders_by_day": _days("select order_date, total_orders from days"),
    "distinct_customers_by_day": _days("select order_date, unique_customers from days"),
    "stream_archive": """select 'orders' as dataset, count(*) as rows from orders
        union all select 'order_items', count(*) from lineitem""",
    "stream_batch_replayed": _days(),
    "sketched_customers_by_day": _days("select order_date, unique_customers, true as near from days"),
    "sketched_customers_by_month": """select strftime(o_orderdate, '%Y-%m') as order_month,
        count(distinct o_custkey) as unique_customers, true as near
        from orders join lineitem on l_orderkey = o_orderkey group by 1""",
    "avg_order_value": _category("select category, order_date, avg_order_value from category_days"),
    "return_rate_by_day": _days("select order_date, return_rate from days"),
    "items_sold_by_day": _days("select order_date, total_items_sold from days"),
    "prepared_items": _with(ITEMS, select="select * from d_items"),
    "category_daily_kpis": _category(),
    "order_daily_kpis": _days(),
    "order_daily_kpis_two_step": _days(),
    "category_kpis_of_lines": _category(),
    "order_kpis_of_lines": _days(),
    "category_daily_kpis_decimal": _with(
        ORDERS,
        CENTS_ITEMS,
        PRODUCTS,
        """
sums as (
  select category, order_date, sum(cents) as s, count(distinct i.order_id) as n, sum(is_returned) as r
  from c_items i join d_orders o on i.order_id = o.order_id join d_products p on i.product_id = p.product_id
  group by category, order_date)""",
        select="""select category, order_date, cast(s / 100 as decimal(28,2)) as daily_revenue,
       cast(((2 * s + n) // (2 * n)) / 100 as decimal(28,2)) as avg_order_value,
       round(r / n, 4) as avg_return_rate
from sums""",
    ),
    "order_daily_kpis_decimal": _with(
        ORDERS,
        CENTS_ITEMS,
        select="""select order_date, count(distinct i.order_id) as total_orders,
       cast(sum(cents) / 100 as decimal(28,2)) as total_revenue, count(item_id) as total_items_sold,
       round(sum(is_returned) / count(distinct i.order_id), 4) as return_rate,
       count(distinct user_id) as unique_customers
from c_items i join d_orders o on i.order_id = o.order_id group by order_date""",
    ),
    "kpi_upsert_replace": _with(
        ORDERS,
        _half("F", "first_half"),
        _half("O", "second_half"),
        select="""select * from second_half
union all select * from first_half where order_date not in (select order_date from second_half)""",
    ),
    "kpi_upsert_recompute": _days(),
    "kpi_recompute_after_replace": _days(),
    "dedup_last_by_key": """select order_id, user_id, created_at, status from (
  select o_orderkey as order_id, o_custkey as user_id, o_orderdate as created_at, o_orderstatus as status,
         row_number() over (partition by o_custkey order by o_orderkey desc) as place from orders)
where place = 1""",
    "writer_parallelism": _with(
        COUNTS,
        select="""select dataset, source_rows,
        cast(greatest(1, least(10, source_rows // 1000)) as integer) as writers from counts""",
    ),
    "write_outcome": _category(OUTCOME, GAPS),
    "keyed_put": _category(
        """select category, strftime(order_date, '%Y-%m-%d') as order_date,
        cast(cast(daily_revenue as varchar) as decimal(38,18)) as daily_revenue,
        cast(cast(avg_order_value as varchar) as decimal(38,18)) as avg_order_value,
        cast(cast(avg_return_rate as varchar) as decimal(38,18)) as avg_return_rate,
        count(*) over () as successful, cast(0 as bigint) as failed from category_days"""
    ),
    "archive_manifest": _files(
        """select dataset, key,
       case when status = 'passed' then 'processed/run-1/20260102_030405/' || key
            else 'quarantine/' || dataset || '/' || regexp_extract(key, '[^/]*$') end as target_path,
       status, issues, status <> 'failed' as moved
from verdicts""",
        VERDICTS,
    ),
    "archive_status": _files(
        """select count(*) filter (status <> 'failed') as moved_files,
       count(*) filter (status = 'failed') as failed_files,
       case when count(*) filter (status = 'failed') = 0 then 'success' else 'partial_failure' end as archive_status
from verdicts""",
        VERDICTS,
    ),
    "run_report": _with(
        *REPORT_PARTS,
        select="""select 'success' as status, category_rows + order_rows as "recordsProcessed",
       category_rows as "categoryMetrics", order_rows as "orderMetrics", rejected as "failedRecords",
       case when unmoved = 0 then 'success' else 'partial_failure' end as "archiveStatus",
       'run-1' as "executionId", n_orders as "processed_orders", n_items as "processed_orderItems",
       n_products as "processed_products", (select count(*) from orders) as "source_orders",
       (select count(*) from lineitem) as "source_orderItems", (select count(*) from part) as "source_products"
from facts""",
    ),
    "run_report_text": _with(
        *REPORT_PARTS,
        select="""select 'SUCCESS: Execution run-1 - Folder drop processed successfully. Validation Results: '
  || 'Total files: ' || total_files || ', Passed: ' || passed || ', Failed: ' || failed || ', Quarantined: '
  || quarantined || '. Transformation Results: Records processed: ' || (category_rows + order_rows)
  || ', Category metrics: ' || category_rows || ', Order metrics: ' || order_rows || ', Failed records: ' || rejected
  || ', Archive status: ' || case when unmoved = 0 then 'success' else 'partial_failure' end as message
from facts""",
    ),
    "daily_run_category": _category(),
    "stream_order_daily_kpis": _days(),
    "stream_gate": _category(),
}
