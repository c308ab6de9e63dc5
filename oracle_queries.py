"""DuckDB SQL equal to the queries in ``__spark_entry__``, by query name."""

from __future__ import annotations

OBS = """
obs as (
  select event_id,
    case when day(ts) = 1 then 'New Years Day' else 'None' end as holiday,
    value / 8 + 270 as temp,
    value / 64 as rain_1h,
    case when event_type = 'signup' then value / 128 else 0.0 end as snow_1h,
    (event_id % 101)::integer as clouds_all,
    case event_type when 'view' then 'Clear' when 'click' then 'Rain' when 'signup' then 'Snow'
      when 'error' then 'Fog' when 'purchase' then 'Clouds' end as weather_main,
    lower(case event_type when 'view' then 'Clear' when 'click' then 'Rain'
      when 'signup' then 'Snow' when 'error' then 'Fog' when 'purchase' then 'Clouds' end)
      || ' conditions' as weather_description,
    ts as date_time,
    floor(value * 40)::integer as traffic_volume
  from events
)"""

DERIVED = OBS + """,
derived as (
  select *, hour(date_time)::integer as hour, (dayofweek(date_time) + 1)::integer as day_of_week,
    month(date_time)::integer as month,
    case when dayofweek(date_time) in (0, 6) then 1 else 0 end as is_weekend,
    case when month(date_time) in (12, 1, 2) then 'winter'
      when month(date_time) in (3, 4, 5) then 'spring'
      when month(date_time) in (6, 7, 8) then 'summer' else 'fall' end as season,
    case when holiday = 'None' then 0 else 1 end as is_holiday,
    temp - 273.15 as temp_c,
    case when traffic_volume <= 1500 then 'low' when traffic_volume >= 3500 then 'high'
      else 'medium' end as congestion
  from obs
)"""

DAY_NAME = ("(['Sunday','Monday','Tuesday','Wednesday','Thursday','Friday','Saturday']"
            "[(dayofweek({0}) + 1)::integer])")

# Level 0.8, the others 0.1.
CONTEXTS = DERIVED + f""",
contexts as (
  select event_id, congestion as level,
    case when congestion = 'low' then 0.8 else 0.1 end::double as p_low,
    case when congestion = 'medium' then 0.8 else 0.1 end::double as p_medium,
    case when congestion = 'high' then 0.8 else 0.1 end::double as p_high,
    {DAY_NAME.format('date_time')} as day_name, hour,
    weather_main, weather_description, temp_c, holiday
  from derived
)"""

ALERT = """
  case {level} when 'high' then 'Heavy' when 'medium' then 'Moderate' else 'Light' end
  || ' traffic is expected on ' || {day} || ' around ' || lpad({hour}::varchar, 2, '0')
  || ':00 (model confidence ~{percent}%).'
  || case when {weather} in ('Rain', 'Snow')
       then ' Wet/slick conditions (' || {detail} || ') may slow traffic further.'
       when {weather} in ('Fog', 'Mist', 'Haze')
       then ' Reduced visibility from ' || {detail} || ' could compound delays.' else '' end
  || case when {holiday} not in ('', 'None')
       then ' Note: ' || {holiday} || ' may shift typical traffic patterns.' else '' end
  || ' ' || case {level}
       when 'high' then 'Plan for significant delays, build in extra travel time, '
         || 'and consider transit or off-peak departures.'
       when 'medium' then 'Expect moderate delays; standard rush-hour buffers '
         || 'should be sufficient.'
       else 'Travel times should be normal.' end"""

PROMPT = """
  'Prediction:' || chr(10) || '- Predicted congestion level: ' || level || chr(10)
  || '- Class probabilities: low=' || printf('%.2f', p_low) || ', medium='
  || printf('%.2f', p_medium) || ', high=' || printf('%.2f', p_high) || chr(10)
  || '- Day: ' || day_name || chr(10)
  || '- Time: ' || lpad(hour::varchar, 2, '0') || ':00' || chr(10)
  || '- Weather: ' || weather_main || ' (' || weather_description || ')' || chr(10)
  || '- Temperature: ' || printf('%.1f', temp_c) || '°C' || chr(10)
  || '- Holiday: ' || holiday || chr(10) || chr(10) || 'Write the alert.'"""

# Fixed value: the published system prompt.
SYSTEM = (
    "You are a concise traffic-alert writer for a U.S. metropolitan area. Given a structured "
    "congestion prediction, produce a single short alert (2–3 sentences, plain English, no "
    "markdown, no preamble) that a commuter or city-traffic operator could act on. Mention the "
    "day, time, predicted level, weather context, and a brief recommendation."
)

# The level of 200 vehicles per hour of day, and the hash split of the event.
RULE = """
ruled as (
  select *, case when hour(ts) * 200 <= 1500 then 'low' when hour(ts) * 200 >= 3500 then 'high'
      else 'medium' end as level,
    concat('0x', substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80 as is_train
  from events
)"""

# Two rule baselines over events: the average of the row's hour, or hour and weekday.
BASELINE = """
means as (
  select ts, value,
    round(avg(value) over (partition by hour(ts)), 6) as hour_mean,
    round(avg(value) over (partition by hour(ts), dayofweek(ts)), 6) as cell_mean
  from events
),
scored as (
  select 'hour_mean' as model, case when value <= 49 then 1 when value >= 50 then 0 else 2 end
      as label,
    case when hour_mean <= 49 then 1 when hour_mean >= 50 then 0 else 2 end as prediction
  from means
  union all
  select 'hour_dow_mean', case when value <= 49 then 1 when value >= 50 then 0 else 2 end,
    case when cell_mean <= 49 then 1 when cell_mean >= 50 then 0 else 2 end
  from means
),
grid as (
  select m.model, a.i as label, p.i as prediction
  from (values ('hour_mean'), ('hour_dow_mean')) m(model),
    (values (0), (1), (2)) a(i), (values (0), (1), (2)) p(i)
),
matrix as (
  select g.model, g.label, g.prediction, count(s.label) as n
  from grid g left join scored s
    on s.model = g.model and s.label = g.label and s.prediction = g.prediction
  group by all
),
classes as (
  select model, ['high', 'low', 'medium'][c + 1] as level, support, hit,
    case when claimed > 0 then hit / claimed::double else 0 end as precision,
    case when support > 0 then hit / support::double else 0 end as recall
  from (
    select model, i.c as c,
      sum(case when label = i.c then n else 0 end)::bigint as support,
      sum(case when prediction = i.c then n else 0 end)::bigint as claimed,
      sum(case when label = i.c and prediction = i.c then n else 0 end)::bigint as hit
    from matrix, (values (0), (1), (2)) i(c) group by model, i.c
  )
),
per_class as (
  select *, case when precision + recall > 0
      then 2 * precision * recall / (precision + recall) else 0 end as f1
  from classes
),
weighted as (
  select model, sum(hit) / sum(support)::double as accuracy,
    sum(precision * support) / sum(support) as precision,
    sum(recall * support) / sum(support) as recall,
    sum(f1 * support) / sum(support) as f1, sum(support)::bigint as n_rows
  from per_class group by model
)"""

LEVEL_OF_QUANTITY = ("case when l_quantity <= 15 then 'low' when l_quantity >= 35 then 'high' "
                     "else 'medium' end")


def _numeric(column: str) -> str:
    return (f"select '{column}' as \"column\", count({column}) as count, "
            f"round(avg({column}), 4) as mean, round(stddev_samp({column}), 4) as stddev, "
            f"min({column})::double as min, max({column})::double as max from lineitem")


def _nulls(column: str) -> str:
    return (f"select '{column}' as \"column\", "
            f"count(*) filter (where {column} is null) as nulls from joined")


def _slots() -> str:
    weathers = ("Clear", "Clouds", "Rain", "Snow", "Fog")
    one_hot = [f"case when weather_main = '{w}' then 1.0 else 0.0 end::double "
               f"as weather_main_vec_{w.lower()}" for w in weathers]
    return ", ".join([
        "hour::double as hour", "day_of_week::double as day_of_week", "month::double as month",
        "is_weekend::double as is_weekend", "is_holiday::double as is_holiday",
        "temp_c", "rain_1h", "snow_1h", "clouds_all::double as clouds_all",
        *one_hot, "1.0::double as season_vec_winter",
    ])


RULE_SCORES = f"""
        with {RULE} select level as congestion, level as predicted_level, count(*) as n
        from ruled where not is_train group by level"""

# The level of hour, weekend and rain together; every 17th event lacks an input.
CELL_RULE = """
volumes as (
  select *, hour(ts) * 150 + case when dayofweek(ts) in (0, 6) then 800 else 0 end
    + case when event_type = 'click' then 600 else 0 end as volume from events
),
ruled as (
  select *, case when volume <= 1500 then 'low' when volume >= 3500 then 'high'
      else 'medium' end as level,
    case when event_id % 17 <> 0 then level end as predicted,
    concat('0x', substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80 as is_train
  from volumes
)"""

SCALARS = ("hour", "day_of_week", "month", "is_weekend", "is_holiday", "temp_c", "rain_1h",
           "snow_1h", "clouds_all")
WEATHERS = ("clear", "clouds", "rain", "snow", "fog")

RAW_FILE = f"""
    with {OBS} select holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, weather_description,
      strftime(date_trunc('second', date_time), '%Y-%m-%d %H:%M:%S') as date_time, traffic_volume
    from obs"""

HOURLY_EVENTS = """
hourly as (
  select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as hour_start, value, event_id,
    user_id, event_type
  from events
)"""

# The noisy rule, its best rule and what figures follow from a matrix.
NOISY = """
noisy as (
  select event_id, ts, event_type, case event_type
      when 'view' then case when event_id % 5 = 0 then 'medium' else 'low' end
      when 'click' then case when event_id % 4 = 0 then 'low' else 'high' end
      when 'signup' then case when event_id % 7 = 0 then 'high' else 'medium' end
      when 'error' then case when event_id % 9 = 0 then 'low' else 'high' end
      when 'purchase' then case when event_id % 6 = 0 then 'medium' else 'low' end end as level,
    concat('0x', substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80 as trained,
    (concat('0x', substr(md5('fold' || event_id::varchar), 1, 8))::bigint % 3)::integer as fold
  from events)"""


def _metrics(cells: str) -> str:
    """CTEs from ``cells`` (part, level, predicted, n) to ``metrics`` by part."""
    return f"""
shares as (
  select part, class, sum(actual) as support, sum(claimed) as claimed, sum(hit) as hit from (
    select part, level as class, n as actual, 0 as claimed,
      case when level = predicted then n else 0 end as hit from {cells}
    union all select part, predicted, 0, n, 0 from {cells}) group by part, class),
rates as (select *, case when claimed = 0 then 0 else hit / claimed end as p,
    case when support = 0 then 0 else hit / support end as r from shares),
metrics as (select part, sum(hit) / sum(support) as accuracy, sum(p * support) / sum(support) as precision,
    sum(r * support) / sum(support) as recall, sum(support)::bigint as n_rows,
    sum(case when p + r = 0 then 0 else 2 * p * r / (p + r) end * support) / sum(support) as f1
  from rates group by part)"""


FOLD_SCORE = f"""
{NOISY},
votes as (select f.fold, event_type, level, count(*) as n from noisy, (values (0), (1), (2)) f(fold)
  where trained and noisy.fold <> f.fold group by f.fold, event_type, level),
best as (select fold, event_type, arg_max(level, n) as predicted from votes group by fold, event_type),
cells as (select noisy.fold as part, level, predicted, count(*) as n
  from noisy join best on noisy.fold = best.fold and noisy.event_type = best.event_type
  where trained group by noisy.fold, level, predicted),
{_metrics('cells')},
score as (select round(avg(f1), 4) as f1 from metrics)"""

GRID_POINTS = """(values
    ('LogisticRegression', 0, 'elasticNetParam=0.0,regParam=0.0'),
    ('LogisticRegression', 1, 'elasticNetParam=0.5,regParam=0.0'),
    ('LogisticRegression', 2, 'elasticNetParam=0.0,regParam=0.01'),
    ('LogisticRegression', 3, 'elasticNetParam=0.5,regParam=0.01'),
    ('LogisticRegression', 4, 'elasticNetParam=0.0,regParam=0.1'),
    ('LogisticRegression', 5, 'elasticNetParam=0.5,regParam=0.1'),
    ('DecisionTree', 0, 'maxDepth=6'), ('DecisionTree', 1, 'maxDepth=8'),
    ('DecisionTree', 2, 'maxDepth=10'), ('DecisionTree', 3, 'maxDepth=12'),
    ('RandomForest', 0, 'maxDepth=12,numTrees=60'), ('RandomForest', 1, 'maxDepth=15,numTrees=60'),
    ('RandomForest', 2, 'maxDepth=12,numTrees=100'), ('RandomForest', 3, 'maxDepth=15,numTrees=100')
  ) points(model, position, params)"""

ADDITIVE = f"""
{OBS}, ruled as (select event_id, hour(date_time) as hour, case weather_main when 'Clouds' then 1000
    when 'Snow' then 2000 when 'Fog' then 3000 when 'Rain' then 4000 else 0 end
  + case when dayofweek(date_time) in (0, 6) then 1000 else 0 end
  - case when hour(date_time) < 6 then 3000 else 0 end as volume from obs),
levels as (select hour, case when volume <= 1500 then 'low' when volume >= 3500 then 'high'
    else 'medium' end as congestion from ruled
  where not concat('0x', substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80)"""

TEST_SCORE = f"""
{NOISY},
votes as (select event_type, level, count(*) as n from noisy where trained group by event_type, level),
best as (select event_type, arg_max(level, n) as predicted from votes group by event_type),
cells as (select 0 as part, level, predicted, count(*) as n from noisy join best using (event_type)
  where not trained group by level, predicted),
{_metrics('cells')},
grid as (select i, j, coalesce(n, 0) as n from (values (0, 'high'), (1, 'low'), (2, 'medium')) a(i, x)
  cross join (values (0, 'high'), (1, 'low'), (2, 'medium')) b(j, y)
  left join cells on level = x and predicted = y),
rounded as (select round(accuracy, 4) as accuracy, round(precision, 4) as precision,
    round(recall, 4) as recall, round(f1, 4) as f1, n_rows from metrics)"""


ORACLES: dict[str, str] = {
    "hourly_profile": """
        select hour(ts)::integer as hour, round(avg(value), 4) as avg_volume,
          quantile_disc(value, 0.5) as median_volume, count(*) as n_records
        from events group by 1""",
    "dow_profile": """
        select (dayofweek(ts) + 1)::integer as dow, round(avg(value), 4) as avg_volume,
          count(*) as n_records from events group by 1""",
    "monthly_profile": """
        select month(o_orderdate)::integer as month, round(avg(o_totalprice), 4) as avg_volume
        from orders group by 1""",
    "category_profile": """
        select o_orderpriority, round(avg(o_totalprice), 4) as avg_volume, count(*) as n_records
        from orders group by 1""",
    "text_category_profile": """
        select lang, round(avg(n_chars), 4) as avg_volume, count(*) as n_records
        from documents group by 1""",
    "category_topn": """
        select p_type, count(*) as count from part group by 1
        order by count desc, p_type limit 20""",
    "category_topn_many": """
        select o_custkey, count(*) as count from orders group by 1
        order by count desc, o_custkey limit 20""",
    "numeric_summary": " union all ".join(
        _numeric(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "null_audit": """
        with joined as (
          select d.doc_id, lang, source, quality, toxic
          from documents d left join labels l on d.doc_id = l.doc_id) """ + " union all ".join(
        _nulls(c) for c in ("doc_id", "lang", "source", "quality", "toxic")),
    "quantiles_exact": """
        select p as prob, round(list_extract(q, i), 4) as value from (
          select unnest([0.05, 0.25, 0.5, 0.75, 0.95]::double[]) as p,
            unnest([1, 2, 3, 4, 5]) as i,
            (select quantile_cont(value, [0.05, 0.25, 0.5, 0.75, 0.95]) from events) as q)""",
    "quantiles_exact_lineitem": """
        select p as prob, round(list_extract(q, i), 4) as value from (
          select unnest([0, 0.01, 0.5, 0.999, 1]::double[]) as p,
            unnest([1, 2, 3, 4, 5]) as i,
            (select quantile_cont(l_extendedprice, [0, 0.01, 0.5, 0.999, 1])
             from lineitem) as q)""",
    "load_summary": """
        select count(*) as rows, 6 as columns,
          strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') as date_range_start,
          strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') as date_range_end,
          'orders' as source from orders""",
    "profile_suite": f"""
        with {OBS}
        select case when grouping(h) = 0 then 'hour' when grouping(d) = 0 then 'dow'
            when grouping(m) = 0 then 'month' when grouping(weather_main) = 0
            then 'weather_main' else 'holiday' end as dimension,
          coalesce(h, d, m, weather_main, holiday) as value,
          round(avg(traffic_volume), 4) as avg_volume, count(*) as n_records
        from (select hour(date_time)::varchar as h, (dayofweek(date_time) + 1)::varchar as d,
            month(date_time)::varchar as m, * from obs)
        group by grouping sets ((h), (d), (m), (weather_main), (holiday))""",
    "dow_chart": f"""
        select (dayofweek(ts) + 1)::integer as dow, substr({DAY_NAME.format('min(ts)')}, 1, 3)
            as day, round(avg(value), 4) as avg_volume,
          case when dayofweek(min(ts)) in (0, 6) then 1 else 0 end as is_weekend
        from events group by 1""",
    "category_chart": """
        select event_type, round(avg(value), 4) as avg_volume from events group by 1""",
    "clean_observations": f"""
        with {HOURLY_EVENTS}
        select * from (select * from hourly qualify row_number() over (
          partition by hour_start order by value nulls first, event_id nulls first) = 1)
        where value > 1""",
    "clean_filter_first": f"""
        with {HOURLY_EVENTS}
        select * from hourly where value > 1 qualify row_number() over (
          partition by hour_start order by value nulls first, event_id nulls first) = 1""",
    "distinct_customers": """
        select o_custkey, o_totalprice, o_orderkey, o_orderpriority from orders
        qualify row_number() over (partition by o_custkey order by o_totalprice, o_orderkey) = 1""",
    "calendar_features": """
        with o as (select *, case o_orderstatus when 'F' then 'None' when 'O' then 'Labor Day'
            end as holiday from orders)
        select o_orderkey, holiday, hour(o_orderdate)::integer as hour,
          (dayofweek(o_orderdate) + 1)::integer as day_of_week,
          month(o_orderdate)::integer as month,
          case when dayofweek(o_orderdate) in (0, 6) then 1 else 0 end as is_weekend,
          case when month(o_orderdate) in (12, 1, 2) then 'winter'
            when month(o_orderdate) in (3, 4, 5) then 'spring'
            when month(o_orderdate) in (6, 7, 8) then 'summer' else 'fall' end as season,
          case when holiday = 'None' then 0 else 1 end as is_holiday,
          o_totalprice / 1024 - 273.15 as temp_c from o""",
    "hour_buckets": """
        select event_id, hour(ts)::integer as hour, (hour(ts) // 3)::bigint as hour_bucket,
          strftime(ts, '%Y-%m-%d %H:%M:%S') as time_text, strftime(ts, '%H:00') as clock
        from events""",
    "day_name": """
        select (dayofweek(ts) + 1)::integer as day_of_week, dayname(ts) as day_name,
          count(*) as n from events group by all""",
    "holiday_days": """
        with marked as (select ts::date as day,
            case when hour(ts) = 0 and day(ts) % 7 = 1 then 1 else 0 end as hit from events)
        select strftime(day, '%Y-%m-%d') as day, max(hit) as is_holiday, count(*) as n
        from marked group by day""",
    "null_defaults": f"""
        select event_id,
          case when event_id % 3 = 0 then event_type else 'Clear' end as weather_main,
          case when event_id % 3 = 1 then props else 'sky is clear' end as weather_description,
          case when event_id % 3 = 2 then value else 0.0 end as temp_c,
          case when event_id % 3 = 1 then 'Labor Day' else 'None' end as holiday,
          case when event_id % 3 = 0 then 'Unknown' else {DAY_NAME.format('ts')} end as day_name
        from events""",
    "congestion_label": f"""
        select l_orderkey, l_linenumber, l_quantity, {LEVEL_OF_QUANTITY} as congestion
        from lineitem""",
    "class_counts": f"""
        select {LEVEL_OF_QUANTITY} as congestion, count(*) as count from lineitem group by 1""",
    "stratified_pick": f"""
        with {DERIVED}, picked as (
          select * from (select *, (hour // 3)::bigint as hour_bucket from derived)
          qualify row_number() over (
            partition by hour_bucket, congestion order by date_time, event_id) = 1)
        select event_id, strftime(date_time, '%Y-%m-%d %H:%M:%S') as datetime, hour_bucket,
          congestion, weather_main
        from picked order by datetime, hour_bucket, congestion limit 8""",
    "deterministic_sample": """
        select event_id, strftime(ts, '%Y-%m-%d') as day, value from events
        order by md5(event_id::varchar), event_id limit 4000""",
    "processed_rows": f"""
        with {DERIVED}
        select date_time::varchar as date_time, hour, day_of_week, is_weekend,
          temp_c, rain_1h, snow_1h, weather_main, season, is_holiday,
          traffic_volume, congestion
        from derived order by md5(event_id::varchar), event_id limit 4000""",
    "hash_split_counts": """
        select case when concat('0x', substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80
          then 'train' else 'test' end as split, count(*) as n from events group by 1""",
    "hash_folds": """
        select (concat('0x', substr(md5('fold' || o_orderkey::varchar), 1, 8))::bigint
          % 3)::integer as fold, count(*) as n from orders group by 1""",
    "category_index": """
        select event_type as value, count(*) as n,
          (row_number() over (order by count(*) desc, event_type) - 1)::double as "index"
        from events group by 1""",
    "label_index": f"""
        select congestion, case congestion when 'high' then 0.0 when 'low' then 1.0 else 2.0
          end::double as label, count(*) as n
        from (select {LEVEL_OF_QUANTITY} as congestion from lineitem) group by 1""",
    "one_hot_flat": """
        with indexed as (select event_type, (row_number() over (
          order by count(*) desc, event_type) - 1)::double as i from events group by 1)
        select event_id, i as event_type_idx,
          case when e.event_type = 'click' then 1.0 else 0.0 end::double as click,
          case when e.event_type = 'error' then 1.0 else 0.0 end::double as error,
          case when e.event_type = 'purchase' then 1.0 else 0.0 end::double as purchase,
          case when e.event_type = 'signup' then 1.0 else 0.0 end::double as signup,
          case when e.event_type = 'view' then 1.0 else 0.0 end::double as view
        from events e join indexed x on e.event_type = x.event_type""",
    "assembled_features": f"""
        with {DERIVED} select event_id, {_slots()} from derived""",
    "histogram50": """
        with r as (select min(value) as lo, max(value) as hi from events),
        bins as (select least(floor((value - lo) / ((hi - lo) / 50)), 49)::integer as bin,
            count(*) as n from events, r group by 1),
        edges as (select i::integer as bin, lo + i * ((hi - lo) / 50) as lower,
            lo + (i + 1) * ((hi - lo) / 50) as upper from r, range(50) t(i))
        select e.bin, round(lower, 4) as lower, round(upper, 4) as upper,
          coalesce(n, 0)::bigint as n,
          case when 20 >= lower and (20 < upper or (e.bin = 49 and 20 <= upper))
            then 1 else 0 end as has_low_max,
          case when 100 >= lower and (100 < upper or (e.bin = 49 and 100 <= upper))
            then 1 else 0 end as has_high_min
        from edges e left join bins b on e.bin = b.bin""",
    "hexbin40": """
        with r as (select min(l_quantity) as x0, (max(l_quantity) - min(l_quantity)) / 40 as dx,
            min(l_extendedprice) as y0,
            (max(l_extendedprice) - min(l_extendedprice)) / 23 as dy from lineitem),
        scaled as (select *, (l_quantity - x0) / dx as u, (l_extendedprice - y0) / dy as v
            from lineitem, r),
        centres as (select *, round_even(u, 0) as u0, round_even(v, 0) as v0,
            least(floor(u), 39) + 0.5 as u1, least(floor(v), 22) + 0.5 as v1 from scaled),
        placed as (select *, (u - u0) ** 2 + 3 * (v - v0) ** 2
            < (u - u1) ** 2 + 3 * (v - v1) ** 2 as whole from centres)
        select case when whole then 0 else 1 end as lattice,
          round(case when whole then u0 else u1 end * dx + x0, 4) as center_x,
          round(case when whole then v0 else v1 end * dy + y0, 4) as center_y, count(*) as n
        from placed group by 1, 2, 3""",
    "confusion_dense": f"with {BASELINE} select * from matrix",
    "confusion_named": f"""
        with {BASELINE} select model, ['high', 'low', 'medium'][label + 1] as actual,
          ['high', 'low', 'medium'][prediction + 1] as predicted, n from matrix""",
    "weighted_metrics": f"""
        with {BASELINE} select model, round(accuracy, 4) as accuracy,
          round(precision, 4) as precision, round(recall, 4) as recall, round(f1, 4) as f1,
          n_rows from weighted""",
    "per_class_metrics": f"""
        with {BASELINE} select model, level, round(precision, 4) as precision,
          round(recall, 4) as recall, round(f1, 4) as f1, support from per_class""",
    "metrics_long": f"""
        with {BASELINE} select model, metric, round(value, 4) as value
        from (select model, accuracy, precision, recall, f1 from weighted)
          unpivot (value for metric in (accuracy, precision, recall, f1))""",
    "best_worst_model": f"""
        with {BASELINE} select arg_max(model, f1) as best, arg_min(model, f1) as worst,
          round((max(f1) - min(f1)) * 100, 4) as f1_gap_points from weighted""",
    "model_gap": f"""
        with {BASELINE} select case when a.f1 >= b.f1 then a.model else b.model end as leader,
          round(abs(a.f1 - b.f1) * 100, 4) as gap_points
        from weighted a, weighted b where a.model = 'hour_mean' and b.model = 'hour_dow_mean'""",
    "best_recall_range": f"""
        with {BASELINE} select model, round(min(recall), 4) as min_recall,
          round(max(recall), 4) as max_recall
        from per_class where model = (select arg_max(model, f1) from weighted) group by model""",
    "alert_text": f"with {CONTEXTS} select event_id, " + ALERT.format(
        level="level", day="day_name", hour="hour", percent="80", weather="weather_main",
        detail="weather_description", holiday="holiday") + " as alert from contexts",
    "prompt_table": f"with {CONTEXTS} select event_id, {PROMPT} as prompt from contexts",
    "request_bodies": f"""
        with {CONTEXTS}, prompts as (select event_id, {PROMPT} as prompt from contexts)
        select event_id, json_object('anthropic_version', 'bedrock-2023-05-31',
          'max_tokens', 256, 'temperature', 0.3::double, 'system', '{SYSTEM}',
          'messages', json_array(json_object('role', 'user', 'content', prompt)))::varchar as body
        from prompts""",
    "response_parse": "select event_id, 'About ' || event_type || ' today.' as reply from events",
    "adhoc_alerts": """
        with asked as (select event_id, hour(ts) as hour, case when hour(ts) <= 7 then 'low'
            when hour(ts) >= 17 then 'high' else 'medium' end as level from events)
        select event_id, """ + ALERT.format(
        level="level", day="'Monday'", hour="hour", percent="80", weather="'Clear'",
        detail="'sky is clear'", holiday="'None'") + " as alert from asked",
    "lr_scores": RULE_SCORES,
    "rf_scores": RULE_SCORES,
    "dt_scores": f"""
        with {CELL_RULE} select level as congestion, predicted as predicted_level, count(*) as n
        from ruled where not is_train group by all""",
    "saved_model_scores": f"""
        with {CELL_RULE} select predicted as predicted_level, count(*) as n
        from ruled where not is_train group by all""",
    "predicted_alerts": f"""
        with {CELL_RULE}, {OBS}
        select r.event_id, """ + ALERT.format(
        level="r.level", day=DAY_NAME.format("r.ts"), hour="hour(r.ts)", percent="100",
        weather="o.weather_main", detail="o.weather_description", holiday="o.holiday") + """
        as alert from ruled r join obs o on r.event_id = o.event_id
        where not is_train and predicted is not null""",
    "importances": "select unnest([" + ", ".join(
        f"'{s}'" for s in (*SCALARS, *(f"weather_main_vec_{w}" for w in WEATHERS),
                           "season_vec_winter")) + """]) as feature,
          feature = 'hour' as is_top, 1.0::double as total""",
    "importances_by_source": "select unnest([" + ", ".join(
        f"'{s}'" for s in (*SCALARS, "weather_main", "season")) + """]) as feature,
          case when feature = 'hour' then 1.0 else 0.0 end::double as importance""",
    "model_results": f"""
        with {DERIVED}, tests as (
          select congestion, count(*) as n from derived
          where not concat('0x', substr(md5(event_id::varchar), 1, 8))::bigint % 100 < 80
          group by 1),
        totals as (select sum(n)::bigint as n_rows,
          coalesce(sum(n) filter (congestion = 'high'), 0)::bigint as support_high,
          coalesce(sum(n) filter (congestion = 'low'), 0)::bigint as support_low,
          coalesce(sum(n) filter (congestion = 'medium'), 0)::bigint as support_medium from tests)
        select position, model, n_rows, support_high, support_low, support_medium,
          true as accuracy_follows, true as timed, parameters
        from totals, (values
          (0, 'LogisticRegression', 'class=LogisticRegressionModel,elasticNetParam=0.0,maxIter=100,regParam=0.0'),
          (1, 'DecisionTree', 'class=DecisionTreeClassificationModel,maxBins=64,maxDepth=7'),
          (2, 'RandomForest', 'class=RandomForestClassificationModel,featureSubsetStrategy=log2,'
            || 'maxBins=64,maxDepth=15,numTrees=50,subsamplingRate=0.9')) m(position, model, parameters)""",
    "cv_best": """
        select unnest([0, 1, 2, 3])::integer as position,
          'maxDepth=' || (6 + 2 * position) as params, 1.0::double as f1, position = 0 as is_best""",
    "quantiles_approx": """
        select c as "column", p as prob, true as within
        from (select unnest(['l_extendedprice', 'l_quantity']) as c),
          (select unnest([0.05, 0.25, 0.5, 0.75, 0.95]::double[]) as p)""",
    "profile_categories_wide": """
        select case when grouping(h) = 0 then 'hour' when grouping(d) = 0 then 'dow'
            when grouping(m) = 0 then 'month' when grouping(c) = 0 then 'o_custkey'
            else 'o_orderstatus' end as dimension, coalesce(h, d, m, c, o_orderstatus) as value,
          round(avg(o_totalprice), 1) as avg_volume, count(*) as n_records
        from (select hour(o_orderdate)::varchar as h, (dayofweek(o_orderdate) + 1)::varchar as d,
            month(o_orderdate)::varchar as m, o_custkey::varchar as c, * from orders)
        group by grouping sets ((h), (d), (m), (c), (o_orderstatus))""",
    "profile_document": f"with {OBS}, long as (" + " union all ".join([
        "select 'totals' as section, 'rows' as key, 'row_count' as name, count(*)::double as value from obs",
        *[f"select 'null_counts', '{c}', 'nulls', count(*) filter ({c} is null) from obs"
          for c in ("event_id", "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
                    "weather_main", "weather_description", "date_time", "traffic_volume")],
        *[f"select 'numeric_summary', '{k}', '{c}', {f}({c})::double from obs"
          for c in ("temp", "rain_1h", "snow_1h", "clouds_all", "traffic_volume")
          for k, f in (("count", "count"), ("mean", "avg"), ("stddev", "stddev_samp"),
                       ("min", "min"), ("max", "max"))],
        "select 'profile_weather_main', weather_main, 'count', count(*) from obs group by 2",
        "select 'profile_holiday', holiday, 'count', count(*) from obs group by 2",
        *[f"select 'profile_hourly_volume', hour(date_time)::varchar, '{n}', {f} from obs group by 2"
          for n, f in (("avg_volume", "avg(traffic_volume)"), ("n_records", "count(*)"),
                       ("median_volume", "quantile_disc(traffic_volume, 0.5)"))],
        *[f"select 'profile_dow_volume', (dayofweek(date_time) + 1)::varchar, '{n}', {f} from obs group by 2"
          for n, f in (("avg_volume", "avg(traffic_volume)"), ("n_records", "count(*)"))],
        "select 'profile_monthly_volume', month(date_time)::varchar, 'avg_volume', "
        "avg(traffic_volume) from obs group by 2",
        *[f"select 'profile_weather_volume', weather_main, '{n}', {f} from obs group by 2"
          for n, f in (("avg_volume", "avg(traffic_volume)"), ("n_records", "count(*)"))],
    ]) + ") select section, key, name, round(value, 4) as value from long",
    "describe_text": " union all ".join(
        f"select '{f}' as summary, {f}(p_size)::varchar as p_size, "
        f"{f}(p_retailprice)::varchar as p_retailprice from part" for f in ("count", "min", "max")),
    "holiday_null_rule": """
        with hit as (select distinct o_orderdate::date as day from orders where o_orderkey % 997 = 0)
        select o_orderkey, case when o_orderdate::date in (select day from hit) then 1 else 0 end
          as is_holiday from orders""",
    "hash_split_seeded": """
        select event_id, case when concat('0x', substr(md5('second' || event_id::varchar), 1, 8))
          ::bigint % 1000000 < 855000 then 'train' else 'test' end as split from events""",
    "category_index_wide": """
        select o_custkey::varchar as value, count(*) as n, (row_number() over (
          order by count(*) desc, o_custkey::varchar) - 1)::double as "index"
        from orders group by o_custkey""",
    "csv_scan": RAW_FILE,
    "gzip_csv_scan": RAW_FILE,
    "saved_profile": f"""
        with {OBS} select weather_main, round(avg(traffic_volume), 4) as avg_volume,
          count(*) as n_records from obs group by 1""",
    "saved_class_counts": f"""
        select {LEVEL_OF_QUANTITY} as congestion, count(*) as count from lineitem group by 1""",
    "saved_class_metrics": f"""
        with {BASELINE} select model, level, round(precision, 4) as precision,
          round(recall, 4) as recall, round(f1, 4) as f1, support from per_class""",
    "saved_alerts": f"""
        with {CONTEXTS}, picked as (
          select c.*, date_time from contexts c join derived d using (event_id)
          qualify row_number() over (partition by (c.hour // 3), level
            order by date_time, c.hour, d.day_of_week, c.weather_main) = 1),
        first as (select * from picked order by strftime(date_time, '%Y-%m-%d %H:%M:%S'),
          hour // 3, level limit 8)
        select strftime(date_time, '%Y-%m-%d %H:%M:%S') as datetime, level as predicted_level,
        """ + ALERT.format(
        level="level", day="day_name", hour="hour", percent="80", weather="weather_main",
        detail="weather_description", holiday="holiday") + " as alert from first",
    "cv_best_linear": f"""
        with {FOLD_SCORE} select position::integer as position, params, f1, position = 0 as is_best
        from score, {GRID_POINTS} where model = 'LogisticRegression'""",
    "cv_best_forest": f"""
        with {FOLD_SCORE} select position::integer as position, params, f1, position = 0 as is_best
        from score, {GRID_POINTS} where model = 'RandomForest'""",
    "grid_search": f"""
        with {FOLD_SCORE} select model, position::integer as position, params, f1,
          position = 0 as is_best from score, {GRID_POINTS}""",
    "rf_scores_cells": f"with {ADDITIVE} select congestion, congestion as predicted_level, count(*) as n "
                       "from levels group by 1",
    "lr_scores_cells": f"with {ADDITIVE} select congestion, congestion as predicted_level, count(*) as n "
                       "from levels where hour >= 6 group by 1",
    "resumed_results": f"""
        with {TEST_SCORE} select position::integer as position, model, rounded.*,
          (select string_agg(n::varchar, ',' order by i, j) from grid) as cells
        from rounded, (values (0, 'LogisticRegression'), (1, 'DecisionTree'), (2, 'RandomForest'))
          models(position, model)""",
    "run_summary_document": f"""
        with {TEST_SCORE}, counted as (
          select count(*) filter (trained) as train, count(*) filter (not trained) as test,
            count(*) as n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') as first,
            strftime(max(ts), '%Y-%m-%d %H:%M:%S') as last from noisy)
        select path, value from counted, rounded, lateral (values
          ('load.rows', n::varchar), ('load.columns', '10'), ('load.date_range_start', first),
          ('load.date_range_end', last), ('load.source', 'events'), ('best_model', 'DecisionTree'),
          ('train_rows', train::varchar), ('test_rows', test::varchar), ('n_sample_alerts', '8'),
          ('run_id', 'summary'), ('run_log', null), ('cross_validation', 'false'),
          ('model_results[0].position', '0'), ('model_results[0].model', 'DecisionTree'),
          ('model_results[0].accuracy', accuracy::varchar),
          ('model_results[0].precision', precision::varchar),
          ('model_results[0].recall', recall::varchar), ('model_results[0].f1', f1::varchar),
          ('model_results[0].n_rows', n_rows::varchar),
          ('model_results[0].parameters.class', 'DecisionTreeClassificationModel'),
          ('model_results[0].parameters.maxBins', '64'),
          ('model_results[0].parameters.maxDepth', '7')) t(path, value)
        union all select 'model_results[0].confusion_matrix[' || i || '][' || j || ']', n::varchar from grid""",
    "hashed_features": """
        select o_orderkey, o_totalprice::double as price,
          concat('0x', substr(md5('o_custkey=' || o_custkey::varchar), 1, 8))::bigint % 256 as slot,
          1.0::double as total from orders""",
    "kept_sketches": """
        with x as (select year(l_shipdate)::integer as y, l_extendedprice::double as l_extendedprice,
            l_quantity::double as l_quantity from lineitem),
        long as (select unnest([y, 0]) as year, 'l_extendedprice' as c, l_extendedprice as v from x
          union all select unnest([y, 0]), 'l_quantity', l_quantity from x)
        select year::integer as year, c as "column", n, lowest, highest, p as prob, true as within
        from (select year, c, count(*) as n, min(v) as lowest, max(v) as highest from long group by 1, 2),
          (select unnest([0.05, 0.25, 0.5, 0.75, 0.95]::double[]) as p)""",
    "mounted_tables": RAW_FILE,
    "saved_alert_contexts": f"""
        with {CONTEXTS}, picked as (
          select c.*, date_time from contexts c join derived d using (event_id)
          qualify row_number() over (partition by (c.hour // 3), level
            order by date_time, c.hour, d.day_of_week, c.weather_main) = 1),
        first as (select * from picked order by strftime(date_time, '%Y-%m-%d %H:%M:%S'),
          hour // 3, level limit 8)
        select strftime(date_time, '%Y-%m-%d %H:%M:%S') as datetime, level, hour, day_name,
          weather_main, weather_description, holiday, p_low, p_medium, p_high,
          round(temp_c, 4) as temp_c from first""",
    "schema_listing": """
        select table_name as "table", (ordinal_position - 1)::integer as position,
          column_name as name, case data_type when 'BIGINT' then 'bigint' when 'INTEGER' then 'int'
            when 'VARCHAR' then 'string' when 'DOUBLE' then 'double' when 'DATE' then 'date'
            else 'time' end as type
        from information_schema.columns
        where table_name in ('events', 'orders', 'documents', 'conversations')""",
    "profile_document_paths": f"""
        with {OBS}, hours as (select hour(date_time) as h, count(*) as n from obs group by 1),
        weather as (select weather_main as w, count(*) as n from obs group by 1
          order by n desc, w limit 20),
        days as (select holiday as w, count(*) as n from obs group by 1 order by n desc, w limit 20)
        select 'row_count' as path, count(*)::varchar as value from obs
        union all select 'column_count', '10'
        union all select 'weather_volume_table', 'profile_weather_volume'
        union all select 'hourly_volume[' || (row_number() over (order by h) - 1) || '].hour', h::varchar
          from hours
        union all select 'hourly_volume[' || (row_number() over (order by h) - 1) || '].n_records',
          n::varchar from hours
        union all select 'weather_main_distribution[' || (row_number() over (order by n desc, w) - 1)
          || '].weather_main', w from weather
        union all select 'weather_main_distribution[' || (row_number() over (order by n desc, w) - 1)
          || '].count', n::varchar from weather
        union all select 'holiday_distribution[' || (row_number() over (order by n desc, w) - 1)
          || '].holiday', w from days
        union all select 'holiday_distribution[' || (row_number() over (order by n desc, w) - 1)
          || '].count', n::varchar from days
        """ + "".join(
            f"union all select 'null_counts.{c}', (count(*) filter ({c} is null))::varchar from obs "
            for c in ("event_id", "holiday", "temp", "rain_1h", "snow_1h", "clouds_all",
                      "weather_main", "weather_description", "date_time", "traffic_volume")),
    "run_log_events": """
        select 'run-' || (length(event_type) % 2) as run_id, 'both' as experiment, 'events' as source,
          ['first', 'second'][length(event_type) % 2 + 1] as models, count(*)::double as row_count,
          max(value) as most, true as in_order from events group by length(event_type) % 2""",
}

ORACLES["saved_sample"] = ORACLES["processed_rows"]
