"""SQL over the test tables that must give the same rows as the registered queries.

Each statement is a final SELECT over named blocks; ``statements`` puts the blocks that it needs, directly or
indirectly, in front of it.  The arithmetic is exact on both sides: sums of decimals, ratios as quotients of whole
numbers rounded half up, averages as one double division.
"""

from __future__ import annotations

import re

from tillmark.plans import quality


def _units(column: str, digits: int) -> str:
    """A decimal as a whole number of 10**-digits."""
    return f"cast(cast({column} as decimal(26,{digits})) * cast(1{'0' * digits} as decimal(7,0)) as hugeint)"


def _half_up(top: str, bottom: str) -> str:
    """top / bottom in hundredths, rounded half away from zero; null for a zero bottom."""
    return (
        f"cast(sign({top}) * sign({bottom}) * ((2 * abs({top}) * 100 + abs({bottom})) // "
        f"nullif(2 * abs({bottom}), 0)) as double) / 100"
    )


def _per(total: str, units: str) -> str:
    return _half_up(_units(total, 4), f"(cast({units} as hugeint) * 10000)")


def _percent(part: str, whole: str) -> str:
    return _half_up(f"({_units(part, 5)} * 100)", f"({_units(whole, 4)} * 10)")


def _avg(column: str) -> str:
    return f"cast(sum({column}) as double) / nullif(count({column}), 0)"


def _md5(*columns: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return f"md5({' || chr(45) || '.join(parts)})"


def _case(rules, default: str) -> str:
    return "case " + " ".join(f"when {when} then {then}" for when, then in rules) + f" else {default} end"


def _labels(column: str, operator: str, limits, default: str) -> str:
    return _case([(f"{column} {operator} {limit}", f"'{label}'") for limit, label in limits], f"'{default}'")


def _text_key(column: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(lower(trim(coalesce({column}, ''))), '[^a-z0-9 ]+', '', 'g'), "
        "' +', ' ', 'g'))"
    )


def _cast_all(columns, sql_type: str) -> str:
    return ", ".join(f"cast({c} as {sql_type}) as {c}" for c in columns.split())


def _final(block: str, money: str = "", whole: str = "", text: str = "", rounded: str = "") -> str:
    """All columns of a block, those named cast to the compared types."""
    casts = [_cast_all(money, "double"), _cast_all(whole, "bigint"), _cast_all(text, "varchar")]
    casts += [f"round({c}, 6) as {c}" for c in rounded.split()]
    casts = [c for c in casts if c]
    return f"select * replace ({', '.join(casts)}) from {block}" if casts else f"select * from {block}"


def _segment(label_rules, default: str) -> str:
    return _case([(when, f"'{label}'") for when, label in label_rules], f"'{default}'")


_CHAMPION = ("r >= 4 and f >= 4 and m >= 4", "Champions")
_LOYAL = ("r >= 4 and f >= 3", "Loyal Customers")
_NEW = ("r = 5 and f <= 2", "New Customers")
_POTENTIAL = ("r in (3, 4) and m >= 4", "Potential Loyalists")
_AT_RISK = ("r <= 2 and f >= 4 and m >= 4", "At Risk High Value")
_ASLEEP = ("r <= 2 and f <= 2", "Hibernating")

_SID = (
    "((l_orderkey * 7 + l_linenumber) * 1000000 "
    "+ (l_partkey * 1009 + l_suppkey * 13 + cast(l_quantity as bigint)) % 1000000)"
)
_KIND = "cast('0x' || substr(md5(p_type), 1, 7) as bigint)"
_REGION_CODE = "case when length(r_name) > 6 then substr(r_name, 3, 2) else substr(r_name, 1, 2) end"

_GRAIN = "year, month, day, day_of_week, customer_country, customer_country_code, salesperson_country, product_id"

BLOCKS: dict[str, str] = {
    # --- the retail tables seen through the test tables ---------------------------------------------------------------
    "src_sales": f"""
        select sid as SalesID, l_suppkey as SalesPersonID, o_custkey as CustomerID, l_partkey as ProductID,
               cast(l_quantity as bigint) as Quantity, cast(l_discount as decimal(18,4)) as Discount,
               cast(case when sid % 11 = 0 then null when sid % 13 = 0 then 0
                         else cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))
                    end as decimal(18,4)) as TotalPrice,
               case when sid % 97 <> 0 then o_orderdate end as SalesDate,
               cast(l_orderkey as varchar) as TransactionNumber
        from (select *, {_SID} as sid from lineitem) join orders on l_orderkey = o_orderkey""",
    "src_products": f"""
        select p_partkey as ProductID, p_name as ProductName,
               cast(p_retailprice - 900 as decimal(18,4)) as Price, {_KIND} as CategoryID,
               case when p_size <= 17 then 'Low' when p_size <= 34 then 'Medium' else 'High' end as Class,
               timestamp '2001-01-01 00:00:00' as ModifyDate, 'Durable' as Resistant, 'False' as IsAllergic,
               cast(p_size as double) as VitalityDays
        from part""",
    "src_categories": f"select distinct {_KIND} as CategoryID, p_type as CategoryName from part",
    "src_customers": """
        select c_custkey as CustomerID, c_mktsegment as FirstName,
               case when c_custkey % 3 <> 0 then 'M' end as MiddleInitial, c_name as LastName,
               cast(c_nationkey as bigint) as cityID, c_name as Address
        from customer""",
    "src_employees": """
        select s_suppkey as EmployeeID, 'Sales' as FirstName,
               case when s_suppkey % 3 <> 0 then 'S' end as MiddleInitial, s_name as LastName,
               date '1960-01-01' + cast((s_suppkey * 53) % 9000 as integer) as BirthDate,
               case when s_suppkey % 2 = 0 then 'M' else 'F' end as Gender,
               cast(s_nationkey as bigint) as CityID,
               date '1985-01-01' + cast((s_suppkey * 613) % 6100 as integer) as HireDate
        from supplier""",
    "src_cities": """
        select cast(n_nationkey as bigint) as CityID, n_name as CityName,
               lpad(cast(n_nationkey as varchar), 5, '0') as Zipcode, cast(n_regionkey as bigint) as CountryID
        from nation""",
    "src_countries": """
        select cast(r_regionkey as bigint) as CountryID, r_name as CountryName, substr(r_name, 1, 2) as CountryCode
        from region""",
    "iso": f"""
        select r_name as country_name, {_REGION_CODE} as alpha_2 from region
        union all
        select distinct c_mktsegment, substr(c_mktsegment, 1, 2) from customer where length(c_mktsegment) < 10""",
    "world": f"""
        select lower(n_name) as city_name,
               case when c_acctbal < 5000 then {_REGION_CODE} else substr(c_mktsegment, 1, 2) end as country_code,
               cast(floor(c_acctbal) as bigint) as population
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    # --- staging --------------------------------------------------------------------------------------------------------
    "geo": """
        select CityID as place, CityName as city_name, Zipcode as zipcode, CountryName as country_name,
               CountryCode as country_code
        from src_cities left join src_countries using (CountryID)""",
    "customers_clean": f"""
        select {_md5('CustomerID')} as customer_key, CustomerID as customer_id,
               FirstName || ' ' || coalesce(MiddleInitial, '') || ' ' || LastName as full_name,
               FirstName as first_name, MiddleInitial as middle_initial, LastName as last_name, cityID as city_id,
               city_name, zipcode, country_name, country_code, Address as address
        from src_customers left join geo on cityID = place""",
    "employees_clean": f"""
        select {_md5('EmployeeID')} as employee_key, EmployeeID as employee_id,
               FirstName || ' ' || coalesce(MiddleInitial, '') || ' ' || LastName as full_name,
               FirstName as first_name, MiddleInitial as middle_initial, LastName as last_name,
               BirthDate as birth_date, Gender as gender, CityID as city_id, city_name, zipcode, country_name,
               country_code, HireDate as hire_date, 2001 - year(HireDate) as years_employed,
               {_labels('2001 - year(HireDate)', '>=', ((10, 'Senior'), (5, 'Mid-level')), 'Junior')}
                   as experience_level
        from src_employees left join geo on CityID = place""",
    "products_clean": f"""
        select {_md5('ProductID')} as product_key, ProductID as product_id, ProductName as product_name,
               Price as price, CategoryID as category_id, CategoryName as category_name, Class as class,
               ModifyDate as modify_date, Resistant as resistant, IsAllergic as is_allergic,
               VitalityDays as vitality_days,
               {_labels('Price', '<', ((5, 'Budget'), (15, 'Standard'), (50, 'Premium')), 'Luxury')}
                   as price_category
        from src_products left join src_categories using (CategoryID)""",
    "lines": """
        select cast(SalesID as varchar) as sales_id, SalesPersonID as salesperson_id, CustomerID as customer_id,
               s.ProductID as product_id, Quantity as quantity, Discount as discount,
               cast(Price * Quantity - Discount as decimal(18,4)) as total_price, SalesDate as sales_date,
               TransactionNumber as transaction_number, year(SalesDate) as year, month(SalesDate) as month,
               day(SalesDate) as day, dayofweek(SalesDate) + 1 as day_of_week
        from src_sales s left join src_products p on s.ProductID = p.ProductID
        where SalesDate is not null""",
    # --- facts ----------------------------------------------------------------------------------------------------------
    "star": f"""
        select {_md5('sales_id')} as sales_summary_id, sales_id, salesperson_id, e.full_name as salesperson_name,
               e.city_name as salesperson_city, e.country_name as salesperson_country, l.customer_id,
               c.city_name as customer_city, c.country_name as customer_country,
               c.country_code as customer_country_code, l.product_id, product_name, category_name, class,
               price_category, quantity, discount, total_price,
               cast(total_price - cast(quantity as decimal(9,0)) * price * 0.7 as decimal(24,5)) as estimated_profit,
               sales_date, transaction_number, year, month, day, day_of_week
        from lines l
        left join products_clean p on p.product_id = l.product_id
        left join customers_clean c on c.customer_id = l.customer_id
        left join employees_clean e on e.employee_id = l.salesperson_id""",
    "behavior": f"""
        select {_md5('customer_id')} as customer_behavior_id, *,
               {_labels('purchase_count', '>=', ((50, 'High Value'), (20, 'Medium Value')), 'Low Value')}
                   as customer_value_segment,
               {_labels("date_diff('day', cast(last_purchase_date as date), data_as_of_date)", '<=',
                        ((30, 'Active'), (90, 'At Risk')), 'Dormant')} as engagement_status
        from (select customer_id, count(distinct sales_id) as purchase_count,
                     count(distinct product_id) as distinct_products_purchased, sum(quantity) as total_quantity,
                     sum(total_price) as total_spend, {_avg('total_price')} as avg_transaction_value,
                     max(sales_date) as last_purchase_date, min(sales_date) as first_purchase_date,
                     date_diff('day', cast(min(sales_date) as date), cast(max(sales_date) as date))
                         as days_between_first_last_purchase,
                     sum(discount) as total_discount_received, {_avg('discount')} as avg_discount_per_transaction,
                     (select cast(max(sales_date) as date) from lines) as data_as_of_date
              from lines group by customer_id)""",
    "performance": f"""
        select {_md5('employee_id')} as employee_performance_id, employee_id, full_name as employee_name,
               city_name as employee_city, country_name as employee_country, experience_level,
               count(distinct sales_id) as total_sales_transactions,
               count(distinct customer_id) as unique_customers_served, sum(quantity) as total_units_sold,
               sum(total_price) as total_sales_revenue, {_avg('total_price')} as avg_transaction_value,
               sum(discount) as total_discounts_given, years_employed,
               {_per('sum(total_price)', 'count(distinct sales_id)')} as revenue_per_transaction
        from employees_clean left join lines on employee_id = salesperson_id
        group by employee_id, full_name, city_name, country_name, experience_level, years_employed""",
    # --- marts ----------------------------------------------------------------------------------------------------------
    "spend": f"""
        select customer_id, count(distinct sales_id) as total_orders,
               count(distinct cast(sales_date as date)) as days_active, sum(total_price) as total_spent,
               {_avg('total_price')} as avg_order_value, max(sales_date) as last_purchase_date,
               min(sales_date) as first_purchase_date,
               date_diff('day', cast(min(sales_date) as date), cast(max(sales_date) as date)) as customer_tenure_days
        from lines group by customer_id""",
    "lifetime": f"""
        select s.customer_id, full_name as customer_name, first_name, last_name, total_orders, days_active,
               total_spent, avg_order_value, last_purchase_date, first_purchase_date, customer_tenure_days,
               {_per('total_spent', 'customer_tenure_days + 1')} as daily_avg_spent,
               {_per('total_spent', '1')} as estimated_clv, value_quintile,
               {_labels('value_quintile', '=', ((1, 'Most Valuable'), (2, 'High Value'), (3, 'Mid Value'),
                                                (4, 'Low Value')), 'Emerging')} as customer_value_tier,
               customer_spend_rank
        from (select *, ntile(5) over (order by total_spent desc nulls last, customer_id) as value_quintile,
                     rank() over (order by total_spent desc nulls last) as customer_spend_rank from spend) s
        left join customers_clean c on c.customer_id = s.customer_id""",
    "behavior_scores": """
        select *, date_diff('day', cast(last_purchase_date as date), data_as_of_date) as idle,
               6 - ntile(5) over (order by date_diff('day', cast(last_purchase_date as date), data_as_of_date)
                                  nulls first, customer_id) as r,
               ntile(5) over (order by purchase_count nulls first, customer_id) as f,
               ntile(5) over (order by total_spend nulls first, customer_id) as m
        from behavior""",
    "engagement": f"""
        select customer_behavior_id, b.customer_id, first_name, last_name, full_name, city_name as customer_city,
               country_name as customer_country, country_code as customer_country_code,
               cast(null as varchar) as date_of_birth, cast(null as varchar) as gender,
               cast(null as varchar) as registration_date, purchase_count, distinct_products_purchased,
               total_quantity, total_spend, avg_transaction_value, customer_value_segment, engagement_status,
               data_as_of_date, last_purchase_date, first_purchase_date, days_between_first_last_purchase,
               total_discount_received, avg_discount_per_transaction, idle as days_since_last_purchase,
               date_diff('day', cast(first_purchase_date as date), data_as_of_date) as customer_tenure_days,
               {_per('total_spend', 'days_between_first_last_purchase + 1')} as daily_avg_spend,
               cast(null as bigint) as age, 'Unknown' as age_group, r as recency_score, f as frequency_score,
               m as monetary_score, concat(r, f, m) as rfm_score,
               {_segment((_CHAMPION, _LOYAL, _NEW, _POTENTIAL, _AT_RISK, _ASLEEP), 'Needs Attention')}
                   as rfm_segment,
               {_segment((('r <= 2 and m >= 4', 'Win-back premium offers'),
                          ('r >= 4 and f >= 4', 'VIP retention and loyalty rewards'),
                          ('r = 5 and f <= 2', 'Welcome and first-repeat incentives'),
                          ('f >= 4 and m in (2, 3)', 'Bundle and cross-sell campaigns')),
                         'General nurture campaigns')} as marketing_action
        from behavior_scores b left join customers_clean c on c.customer_id = b.customer_id""",
    "scorecard": f"""
        select *, {_labels('total_sales_revenue', '>=', ((100000, 'Top Performer'), (50000, 'Strong Performer'),
                                                         (10000, 'Average Performer')), 'Development Needed')}
                   as performance_tier,
               {_percent('total_sales_revenue', 'sum(total_sales_revenue) over (partition by employee_country)')}
                   as pct_country_revenue,
               rank() over (partition by employee_country order by total_sales_revenue desc nulls last)
                   as country_rank,
               rank() over (order by total_sales_revenue desc nulls last) as company_rank
        from performance""",
    "totals": f"""
        select {_GRAIN}, product_name, category_name, class, price_category,
               count(distinct sales_id) as transaction_count, sum(quantity) as total_units_sold,
               sum(total_price) as total_revenue, sum(estimated_profit) as total_profit,
               {_avg('total_price')} as avg_transaction_value, min(total_price) as min_transaction_value,
               max(total_price) as max_transaction_value, count(distinct customer_id) as unique_customers,
               count(distinct product_id) as unique_products, count(distinct salesperson_id) as unique_salespeople,
               sum(discount) as total_discounts_given
        from star group by {_GRAIN}, product_name, category_name, class, price_category""",
    "sales_mart": f"""
        select *,
               {_case([(f'day_of_week = {n}', f"'{d}'") for n, d in enumerate(
                   ('Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'), 1)], 'null')}
                   as day_name,
               'Q' || (1 + (month % 12) // 3) as quarter,
               {_percent('total_profit', 'total_revenue')} as profit_margin_percentage,
               {_per('total_revenue', 'unique_customers')} as revenue_per_customer,
               {_per('total_units_sold', 'unique_customers')} as units_per_customer,
               {_percent('total_discounts_given', 'total_revenue')} as discount_percentage,
               rank() over (partition by year, month order by total_units_sold desc, total_revenue desc)
                   as monthly_hot_selling_product_rank,
               rank() over (partition by year, month, category_name order by total_revenue desc)
                   as monthly_category_revenue_rank
        from totals""",
    # --- recommendations -----------------------------------------------------------------------------------------------
    "bought": """
        select customer_id, product_id, count(distinct sales_id) as times, sum(total_price) as spent
        from lines group by customer_id, product_id""",
    "together": """
        select x.product_id as a, y.product_id as b, count(distinct x.transaction_number) as baskets,
               count(*) as line_pairs, sum(y.quantity) as units
        from lines x join lines y on x.transaction_number = y.transaction_number and x.product_id <> y.product_id
        group by x.product_id, y.product_id""",
}

BLOCKS["suggested"] = """
        select h.customer_id, t.a, t.b, t.baskets, t.units,
               0.45::double * times + 0.35::double * baskets + 0.20::double * ln(1 + cast(spent as double)) as score
        from (select * from bought
              qualify row_number() over (partition by customer_id
                                         order by times desc, spent desc nulls last, product_id) <= 10) h
        join together t on h.product_id = t.a
        where t.baskets >= 2
          and not exists (select 1 from bought o where o.customer_id = h.customer_id and o.product_id = t.b)"""

BLOCKS["recommend_mart"] = f"""
        select {_md5('customer_id', 'a', 'b')} as recommendation_id, customer_id, a as purchased_product,
               pa.product_name as purchased_product_name, pa.category_name as purchased_category,
               pa.class as purchased_class, pa.price_category as purchased_price_category, b as recommended_product,
               pb.product_name as recommended_product_name, pb.category_name as recommended_category,
               pb.class as recommended_class, pb.price_category as recommended_price_category,
               baskets as co_purchase_txn_count, units as related_units_sold, score as recommendation_score,
               place as recommendation_rank,
               {_labels('place', '<=', ((1, 'High Priority'), (3, 'Medium Priority')), 'Low Priority')}
                   as recommendation_priority,
               {_case([('pa.category_name = pb.category_name', "'Same Category'"),
                       ('pa.class = pb.class', "'Same Class'")], "'Cross Category'")} as recommendation_type,
               case when pa.price_category = pb.price_category then 'Same Price Tier'
                    when list_position(tiers, pa.price_category) < list_position(tiers, pb.price_category)
                    then 'Upsell' else 'Downsell' end as price_movement
        from (select *, ['Budget', 'Standard', 'Premium', 'Luxury'] as tiers,
                     row_number() over (partition by customer_id order by score desc nulls last, baskets desc, a, b)
                         as place
              from suggested)
        left join products_clean pa on pa.product_id = a
        left join products_clean pb on pb.product_id = b
        where place <= 10"""

_REPAIR = """
        select SalesDate, CustomerID, s.ProductID, Quantity, Discount, TransactionNumber,
               cast(greatest(case when TotalPrice > 0 then TotalPrice
                                  else coalesce(Quantity, 0) * coalesce(Price, 0) - coalesce(Discount, 0) end, 0)
                    as decimal(18,4)) as TotalPrice
        from {source} s left join src_products p on s.ProductID = p.ProductID
        where SalesDate is not null and CustomerID is not null and s.ProductID is not null
          and Quantity is not null and TransactionNumber is not null"""

BLOCKS |= {
    "repaired_raw": _REPAIR.format(source="src_sales"),
    "curated": """
        select sales_date as SalesDate, customer_id as CustomerID, product_id as ProductID, quantity as Quantity,
               discount as Discount, total_price as TotalPrice, transaction_number as TransactionNumber from lines""",
    "model_lines": _REPAIR.format(source="curated"),
    "rfm_base": f"""
        select CustomerID as customer_id, count(distinct TransactionNumber) as frequency,
               sum(TotalPrice) as monetary, {_avg('TotalPrice')} as avg_order_value,
               {_avg('Quantity')} as avg_quantity, max(SalesDate) as last_purchase_date,
               (select max(SalesDate) from model_lines) as snapshot_date
        from model_lines group by CustomerID""",
    "rfm": """
        select *, date_diff('day', cast(last_purchase_date as date), cast(snapshot_date as date)) as recency_days,
               6 - ntile(5) over (order by date_diff('day', cast(last_purchase_date as date),
                                                     cast(snapshot_date as date)), customer_id) as r,
               ntile(5) over (order by frequency, customer_id) as f,
               ntile(5) over (order by monetary, customer_id) as m
        from rfm_base""",
    "segments": f"""
        select *, cast({_case([("segment_name = 'Champions'", '5'), ("segment_name = 'Loyal Customers'", '4'),
                               ("segment_name = 'New Customers'", '3'), ("segment_name = 'Needs Attention'", '2'),
                               ("segment_name = 'At Risk High Value'", '1')], '0')} as bigint) as segment_id
        from (select customer_id, frequency, monetary, avg_order_value, avg_quantity, last_purchase_date,
                     snapshot_date, recency_days, r as recency_score, f as frequency_score, m as monetary_score,
                     concat(r, f, m) as rfm_score,
                     {_segment((_CHAMPION, _LOYAL, _NEW, _AT_RISK, _ASLEEP), 'Needs Attention')} as segment_name
              from rfm)""",
    "labels_of_products": """
        select ProductID as product_id, ProductName as product_name, CategoryID as category_id,
               CategoryName as category_name, Price as product_price
        from src_products left join src_categories using (CategoryID)""",
    "labels_of_customers": """
        select CustomerID as customer_id, trim(coalesce(FirstName, '') || ' ' || coalesce(LastName, ''))
                   as customer_name from src_customers""",
    "has": "select distinct CustomerID as customer_id, ProductID as product_id from model_lines",
    "met": """
        select x.ProductID as a, y.ProductID as b, count(*) as n
        from model_lines x join model_lines y
          on x.TransactionNumber = y.TransactionNumber and x.ProductID <> y.ProductID
        group by all""",
    "heuristic": """
        select k.customer_id, customer_name, k.product_id, product_name, category_id, category_name, score,
               recommendation_rank, 'HEURISTIC_FALLBACK' as model_type
        from (select h.customer_id, b as product_id, cast(n as double) as score,
                     row_number() over (partition by h.customer_id order by n desc, b) as recommendation_rank
              from has h join met on h.product_id = a
              anti join has o on o.customer_id = h.customer_id and o.product_id = b
              qualify recommendation_rank <= 10) k
        left join labels_of_products p on p.product_id = k.product_id
        left join labels_of_customers c on c.customer_id = k.customer_id""",
    "src_sales_changed": """
        select * replace (case when SalesPersonID % 2 = 1 then Quantity + 1 else Quantity end as Quantity)
        from src_sales""",
    "lines_changed": BLOCKS["lines"].replace("src_sales", "src_sales_changed"),
    "star_changed": BLOCKS["star"].replace("from lines l", "from lines_changed l"),
    "hot_items": """
        select case when day % 3 = 0 then 'hot' else transaction_number end as basket,
               case when day % 3 = 1 then 0 else product_id % 97 end as product, count(*) as n, sum(quantity) as u
        from lines group by all""",
    # --- geography -----------------------------------------------------------------------------------------------------
    "iso_keys": f"select {_text_key('country_name')} as k, min(alpha_2) as code from iso group by 1",
    "countries_ok": f"""
        select CountryID, CountryName, coalesce(code, CountryCode) as CountryCode,
               coalesce(code <> coalesce(upper(trim(CountryCode)), ''), false) as code_changed
        from src_countries left join iso_keys on k = {_text_key('CountryName')}""",
    "city_code": f"""
        select city_key, min(country_code) as country_code
        from (select {_text_key('city_name')} as city_key, upper(trim(country_code)) as country_code,
                     coalesce(population, 0) as people from world
              qualify people = max(people) over (partition by city_key))
        group by city_key""",
    "wanted": f"""
        select CityID, country_code, (select min(country_name) from iso where alpha_2 = country_code) as iso_name,
               (select max(CountryID) from countries_ok k where k.CountryCode = country_code) as known_id
        from src_cities join city_code on city_key = {_text_key('CityName')}""",
    "added": """
        select (select max(CountryID) from countries_ok)
                   + row_number() over (order by min(CityID), country_code) as CountryID,
               iso_name as CountryName, country_code as CountryCode
        from wanted where known_id is null and iso_name is not null group by country_code, iso_name""",
    "all_countries": """
        select CountryID, CountryName, CountryCode from countries_ok
        union all select CountryID, CountryName, CountryCode from added""",
    "cities_ok": """
        select c.CityID, CityName, Zipcode, coalesce(k.CountryID, c.CountryID) as CountryID,
               case when k.CountryID is null then 'unresolved' when k.CountryID = c.CountryID then 'unchanged'
                    else 'updated' end as status
        from src_cities c left join wanted w on w.CityID = c.CityID
        left join all_countries k on k.CountryCode = w.country_code""",
}


def _revenue_by(*columns: str, measures: str = "units revenue profit") -> str:
    source = {"units": "total_units_sold", "revenue": "total_revenue", "profit": "total_profit"}
    kind = {"units": "bigint", "revenue": "double", "profit": "double"}
    sums = ", ".join(f"cast(sum({source[m]}) as {kind[m]}) as {m}" for m in measures.split())
    return f"select {', '.join(columns)}, {sums} from totals group by {', '.join(columns)}"


_HEURISTIC_CATALOG = "customer_id, customer_name, recommendation_rank, product_name, category_name"

FINAL: dict[str, str] = {
    "dim_categories": "select * from src_categories",
    "dim_cities": "select * from src_cities",
    "dim_countries": "select * from src_countries",
    "product_labels": _final("labels_of_products", money="product_price"),
    "customer_labels": "select * from labels_of_customers",
    "sales_source_fallback": """
        select SalesDate::varchar as SalesDate, CustomerID, ProductID, TotalPrice::double as TotalPrice, Quantity,
               Discount::double as Discount, TransactionNumber from src_sales""",
    "curated_sales": """
        select SalesDate::varchar as SalesDate, CustomerID, ProductID, TotalPrice::double as TotalPrice, Quantity,
               Discount::double as Discount, TransactionNumber from curated""",
    "upserted_fact": _final("star_changed", money="discount total_price estimated_profit", text="sales_date"),
    "refreshed_sales_totals": """
        select year, month, customer_country, cast(sum(transaction_count) as bigint) as transactions,
               cast(sum(total_revenue) as double) as revenue from totals group by all""",
    "published_sales_totals": """
        select year, month, customer_country, cast(sum(transaction_count) as bigint) as transactions,
               cast(sum(total_revenue) as double) as revenue from totals group by all""",
    "measured_writes": f"""
        select 'dim_categories' as table_name, 'rows' as measure, count(*) as value from src_categories
        union all select 'dim_cities', 'rows', count(*) from src_cities
        union all select 'dim_countries', 'rows', count(*) from src_countries
        union all select 'st_customers', 'rows', count(*) from customers_clean
        union all select 'st_employees', 'rows', count(*) from employees_clean
        union all select 'st_products', 'rows', count(*) from products_clean
        union all select 'st_sales', 'rows', count(*) from lines
        union all select 'fct_sales_summary', 'rows', count(*) from star
        union all select 'dim_cities', 'forbidden_cities', count(*) from src_cities
                  where CityName in {quality.FORBIDDEN_CITIES}
        union all select 'dim_countries', 'malformed_country_codes', count(*) from src_countries
                  where not coalesce(regexp_full_match(CountryCode, '[A-Z]{{2}}'), false)
        union all select 'dim_countries', 'wrong_country_codes', count(*)
                  from (values {", ".join(map(str, quality.CORE_COUNTRY_CODES.items()))}) v(name, code)
                  left join src_countries on CountryName = v.name
                  where CountryCode is null or CountryCode <> v.code""",
    "hot_basket_pairs": """
        select a as anchor, b as related, count(*) as baskets, cast(sum(n * m) as bigint) as line_pairs,
               cast(sum(n * u) as bigint) as related_units
        from (select x.product as a, y.product as b, x.n, y.n as m, y.u from hot_items x join hot_items y
              on x.basket = y.basket and x.product <> y.product)
        group by all having count(*) >= 2""",
    "als_checks": """
        select count(*) > 0 as has_rows, cast(0 as bigint) as ranks_beyond, cast(0 as bigint) as rank_gaps,
               cast(0 as bigint) as scores_out_of_order, cast(0 as bigint) as other_models,
               cast(0 as bigint) as owned_recommended, cast(0 as bigint) as unknown_products from model_lines""",
    "sparse_recommendations": "select * from heuristic",
    "upserted_sales": """
        select * replace (total_price::double as total_price, discount::double as discount,
                          sales_date::varchar as sales_date,
                          case when salesperson_id % 2 = 1 then quantity + 1 else quantity end as quantity)
        from lines
        union all
        select * replace (total_price::double as total_price, discount::double as discount,
                          sales_date::varchar as sales_date, 'new-' || sales_id as sales_id,
                          quantity + 1 as quantity)
        from lines where salesperson_id % 2 = 1""",
    "st_customers": "select * from customers_clean",
    "st_employees": _final("employees_clean", text="birth_date hire_date"),
    "st_products": _final("products_clean", money="price", text="modify_date"),
    "st_sales": _final("lines", money="discount total_price", text="sales_date"),
    "fct_sales_summary": _final("star", money="discount total_price estimated_profit", text="sales_date"),
    "fct_customer_behavior": _final(
        "behavior",
        money="total_spend total_discount_received",
        whole="total_quantity",
        text="last_purchase_date first_purchase_date data_as_of_date",
    ),
    "fct_employee_performance": _final(
        "performance", money="total_sales_revenue total_discounts_given", whole="total_units_sold"
    ),
    "customer_lifetime_value": _final(
        "lifetime", money="total_spent", text="last_purchase_date first_purchase_date"
    ),
    "mart_customer_behavior": _final(
        "engagement",
        money="total_spend total_discount_received",
        whole="total_quantity",
        text="last_purchase_date first_purchase_date data_as_of_date",
    ),
    "mart_employee_performance": _final(
        "scorecard", money="total_sales_revenue total_discounts_given", whole="total_units_sold"
    ),
    "mart_sales_summary": _final(
        "sales_mart",
        money="total_revenue total_profit min_transaction_value max_transaction_value total_discounts_given",
        whole="total_units_sold",
    ),
    "product_pairs": """
        select a as anchor_product_id, b as related_product_id, baskets as co_purchase_txn_count,
               line_pairs as co_purchase_count, cast(units as bigint) as related_units_sold from together""",
    "mart_recommend": _final("recommend_mart", whole="related_units_sold", rounded="recommendation_score"),
    "repaired_sales": _final("repaired_raw", money="TotalPrice Discount", text="SalesDate"),
    "customer_segments": _final("segments", money="monetary", text="last_purchase_date snapshot_date"),
    "als_ratings": """
        select *, round(ln(1 + raw_rating), 6) as rating
        from (select CustomerID as customer_id, ProductID as product_id,
                     cast(sum(case when TotalPrice > 0 then TotalPrice else Quantity end) as double) as raw_rating,
                     count(*) as lines
              from model_lines group by all)""",
    "model_gate": """
        select count(distinct CustomerID) as users, count(distinct ProductID) as items, count(*) as interactions
        from model_lines""",
    "heuristic_recommendations": "select * from heuristic",
    "normalized_countries": "select * from countries_ok",
    "city_codes": "select * from city_code",
    "completed_countries": "select * from all_countries",
    "normalized_cities": "select * from cities_ok",
    "geography_counters": """
        select (select count(*) from countries_ok where code_changed) as countries_updated,
               (select count(*) from added) as countries_created,
               (select count(*) from cities_ok where status = 'updated') as cities_updated,
               (select count(*) from cities_ok where status = 'unresolved') as cities_unresolved""",
    "forbidden_cities": """
        select CityName as city_name from src_cities where CityName in ('NATION_3', 'NATION_11', 'Kansas')""",
    "wrong_country_codes": """
        select v.name as country_name, v.code as expected_country_code, CountryCode as actual_country_code
        from (values ('AFRICA', 'AF'), ('ASIA', 'IN'), ('India', 'IN')) v(name, code)
        left join src_countries on CountryName = v.name
        where CountryCode is null or CountryCode <> v.code""",
    "rank_violations": """
        select customer_id, max(recommendation_rank) as max_rank, count(*) as recommendation_count
        from heuristic group by customer_id having max(recommendation_rank) > 10""",
    "stricter_rank_violations": """
        select customer_id, max(recommendation_rank) as max_rank, count(*) as recommendation_count
        from heuristic group by customer_id having max(recommendation_rank) > 7""",
    "misspelt_country_codes": """
        select CountryID, CountryName, code as CountryCode
        from (select *, case when CountryID % 2 = 0 then lower(CountryCode) when CountryID <> 1 then CountryCode end
                         as code from src_countries)
        where code is null or code <> upper(code) or length(code) <> 2""",
    "controlled_revenue": """
        select year, month, category_name, cast(sum(total_revenue) as double) as revenue from totals
        where make_date(year, month, day) between date '1995-03-15' and date '1996-11-20'
          and customer_country in ('AFRICA', 'ASIA')
          and category_name in ('PROMO', 'SMALL') group by all""",
    "both_model_scorecards": """
        select count(distinct customer_id) as customers, count(product_id) as recommendations,
               avg(score) as avg_score,
               cast(count(*) filter (customer_id % 2 = 0) as double) / count(product_id) as als_coverage,
               cast(count(*) filter (customer_id % 2 = 1) as double) / count(product_id) as fallback_coverage
        from heuristic""",
    "controlled_recommendations": f"""
        select {_HEURISTIC_CATALOG}, score from heuristic where customer_id % 2 = 0 and recommendation_rank <= 3""",
    "most_recommended_products": """
        select product_name, category_name, count(product_id) as recommendations, avg(score) as avg_score
        from heuristic group by product_name, category_name
        order by recommendations desc, product_name, category_name limit 20""",
    "segment_counts": """
        select count(*) as segment_rows, count(distinct customer_id) as customers_segmented from segments""",
    "recommendation_counts": """
        select count(*) as recommendation_rows, count(distinct customer_id) as customers_with_reco,
               avg(score) as avg_reco_score, count(distinct model_type) as model_types_present from heuristic""",
    "malformed_country_codes": """
        select * from src_countries where not coalesce(regexp_full_match(CountryCode, '[A-Z]{2}'), false)""",
    "top_customers": """
        select customer_id, cast(total_spent as double) as total_spent, estimated_clv, customer_value_tier,
               customer_spend_rank
        from lifetime order by lifetime.total_spent desc nulls last, customer_id limit 10""",
    "customers_by_rank": """
        select customer_id, customer_value_tier, cast(total_spent as double) as total_spent, estimated_clv,
               customer_spend_rank from lifetime""",
    "top_salespeople": """
        select employee_id, employee_name, employee_country, cast(total_sales_revenue as double)
                   as total_sales_revenue, company_rank, performance_tier
        from scorecard order by company_rank, employee_id limit 10""",
    "employee_table": """
        select employee_name, employee_country, performance_tier, cast(total_sales_revenue as double)
                   as total_sales_revenue, total_sales_transactions, unique_customers_served, company_rank
        from scorecard""",
    "employee_bars": """
        select employee_name, cast(sum(total_sales_revenue) as double) as total_sales_revenue
        from scorecard group by employee_name order by 2 desc nulls last, 1 limit 10""",
    "employee_countries": f"""
        select employee_country, cast(sum(total_sales_revenue) as double) as total_revenue,
               {_avg('total_sales_revenue')} as avg_revenue from scorecard group by employee_country""",
    "monthly_category_revenue": _revenue_by("year", "month", "category_name", measures="revenue"),
    "category_trend": """
        select cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') as year_month, category_name,
               cast(sum(total_revenue) as double) as revenue from totals group by all""",
    "hot_sellers": """
        select year, month, product_id, product_name, cast(total_units_sold as bigint) as total_units_sold,
               monthly_hot_selling_product_rank from sales_mart where monthly_hot_selling_product_rank <= 10""",
    "hot_seller_units": """
        select product_name, cast(sum(total_units_sold) as bigint) as total_units_sold
        from sales_mart where monthly_hot_selling_product_rank <= 10 group by product_name""",
    "category_leaders": """
        select year, month, category_name, product_id, product_name, cast(total_revenue as double) as total_revenue,
               monthly_category_revenue_rank from sales_mart where monthly_category_revenue_rank <= 3""",
    "scorecards": """
        select cast(sum(total_revenue) as double) as total_revenue, cast(sum(total_profit) as double) as total_profit,
               cast(sum(total_profit) as double) / nullif(cast(sum(total_revenue) as double), 0) as profit_margin_pct
        from totals""",
    "monthly_revenue": """
        select cast(year as varchar) || '-' || lpad(cast(month as varchar), 2, '0') as year_month, revenue, profit,
               lag(revenue) over (order by year, month) as previous_revenue,
               lag(profit) over (order by year, month) as previous_profit
        from (select year, month, cast(sum(total_revenue) as double) as revenue,
                     cast(sum(total_profit) as double) as profit from totals group by year, month)""",
    "country_revenue": _revenue_by("customer_country", measures="revenue profit"),
    "price_category_revenue": _revenue_by("price_category", measures="revenue"),
    "product_table": _revenue_by("product_name", "category_name"),
    "product_scatter": _revenue_by("product_name"),
    "campaign_list": """
        select customer_id, full_name, rfm_score, rfm_segment, marketing_action, engagement_status from engagement""",
    "segment_table": f"""
        select rfm_segment, marketing_action, count(distinct customer_id) as customers,
               {_avg('total_spend')} as avg_total_spend from engagement group by rfm_segment, marketing_action""",
    "segment_sizes": "select rfm_segment, count(distinct customer_id) as customers from engagement group by 1",
    "engagement_sizes": """
        select engagement_status, count(distinct customer_id) as customers from engagement group by 1""",
    "recommendations_of_customer": """
        select customer_id, recommended_product, recommended_product_name,
               round(recommendation_score, 6) as recommendation_score, recommendation_priority, recommendation_type,
               price_movement from recommend_mart where customer_id = 123""",
    "recommendation_table": f"select {_HEURISTIC_CATALOG}, score from heuristic",
    "first_choices": """
        select customer_id, customer_name, product_name, category_name, score
        from heuristic where recommendation_rank = 1""",
    "segment_distribution": """
        select segment_name, count(distinct customer_id) as customers from segments group by segment_name""",
    "segment_means": f"""
        select segment_id, segment_name, count(distinct customer_id) as customer_count,
               round({_avg('monetary')}, 2) as avg_spend, round(avg(avg_order_value), 2) as avg_order_value,
               {_avg('frequency')} as avg_frequency, {_avg('recency_days')} as avg_recency_days
        from segments group by segment_id, segment_name""",
    "recommendation_scorecards": """
        select count(distinct customer_id) as customers, count(product_id) as recommendations,
               avg(score) as avg_score,
               cast(count(*) filter (model_type = 'ALS') as double) / count(product_id) as als_coverage,
               cast(count(*) filter (model_type = 'HEURISTIC_FALLBACK') as double) / count(product_id)
                   as fallback_coverage
        from heuristic""",
    "most_recommended": """
        select product_name, category_id, model_type, count(*) as recommendation_count,
               round(avg(score), 2) as avg_score
        from heuristic group by product_name, category_id, model_type
        order by recommendation_count desc, product_name, category_id, model_type limit 20""",
    "recommendation_explorer": f"""
        select {_HEURISTIC_CATALOG}, model_type, score from heuristic where recommendation_rank <= 5""",
}


def _needed(sql: str, seen: set[str]) -> set[str]:
    for word in set(re.findall(r"\b[a-z_]+\b", sql)):
        if word in BLOCKS and word not in seen:
            seen.add(word)
            _needed(BLOCKS[word], seen)
    return seen


def statement(name: str) -> str:
    needed = _needed(FINAL[name], set())
    blocks = ",\n".join(f"    {block} as ({sql.strip()})" for block, sql in BLOCKS.items() if block in needed)
    return f"with\n{blocks}\n{FINAL[name].strip()}"


# Sale lines of customers with the last digit 3 after a batch: one unit more, every second one 40 days later.
_MOVED = """
        select * replace (Quantity + 1 as Quantity,
                          case when SalesID % 2 = 0 then SalesDate + interval 40 day else SalesDate end as SalesDate)
        from src_sales_before where CustomerID % 10 = 3
        union all
        select * from src_sales_before where CustomerID is null or CustomerID % 10 <> 3"""

AFTER_A_BATCH = {
    "upserted_sales_mart": "mart_sales_summary",
    "upserted_lifetime_value": "customer_lifetime_value",
    "upserted_customer_mart": "mart_customer_behavior",
    "upserted_employee_mart": "mart_employee_performance",
}


def _after_a_batch(name: str) -> str:
    """The statement of a table, over the changed sale lines."""
    before = f"    src_sales as ({BLOCKS['src_sales'].strip()})"
    whole = statement(name)
    assert before in whole
    return whole.replace(before, f"{before.replace('src_sales as', 'src_sales_before as')},\n    src_sales as ({_MOVED.strip()})")


def statements() -> dict[str, str]:
    found = {name: statement(name) for name in FINAL}
    return found | {name: _after_a_batch(table) for name, table in AFTER_A_BATCH.items()}
