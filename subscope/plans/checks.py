"""The registered queries as DuckDB SQL over the same tables."""

from ..operators.modeling import GRID
from ..schemas import EVENT_SCHEMA, FEATURES, RAW_SCHEMA
from ..sources.fixtures import event_rows_sql, usage_raw_sql

_RAW = [f.name for f in RAW_SCHEMA.fields]
_TEXT = ("customer_id", "area_code")
_FLAGS = ("international_plan", "voice_mail_plan", "churn")
_RAW_TEXT = (*_TEXT, *_FLAGS)
_RAW_DOUBLES = [f.name for f in RAW_SCHEMA.fields if f.dataType.typeName() == "double"]
_CAPPED = [c for c in _RAW if c not in (*_TEXT, "churn")]
_NUMERIC = [c for c in _RAW if c not in _TEXT] + list(FEATURES[17:])


def _single(expression: str, name: str) -> str:
    """A double at single precision, as the queries return it."""
    return f"cast(cast({expression} as float) as double) as {name}"


def _names(columns) -> str:
    return ", ".join(columns)


def _encoded(columns=_RAW) -> str:
    parts = [
        f"case when {c} = 'yes' then 1 else 0 end as {c}" if c in _FLAGS else c
        for c in columns
    ]
    return f"usage_raw as ({usage_raw_sql()}), encoded as (select {_names(parts)} from usage_raw)"


def _capped(include_label: bool = False) -> str:
    capped = [*_CAPPED, "churn"] if include_label else _CAPPED
    stats = [f"avg({c}) as m_{c}, stddev_samp({c}) as s_{c}" for c in capped]
    parts = [
        f"case when {c} is null then m_{c} when {c} > m_{c} + 3 * s_{c} "
        f"then m_{c} + 3 * s_{c} when {c} < m_{c} - 3 * s_{c} "
        f"then m_{c} - 3 * s_{c} else cast({c} as double) end as {c}"
        if c in capped
        else c
        for c in _RAW
    ]
    return (
        f"with {_encoded()}, stats as (select {_names(stats)} from encoded), "
        f"cleaned as (select {_names(parts)} from encoded, stats)"
    )


def _processed() -> str:
    return (
        f"{_capped()}, totals as (select *, "
        "total_day_minutes + total_eve_minutes + total_night_minutes as total_minutes, "
        "total_day_calls + total_eve_calls + total_night_calls as total_calls, "
        "total_day_charge + total_eve_charge + total_night_charge + total_intl_charge "
        "as total_charge from cleaned), "
        "processed as (select *, case when total_calls > 0 "
        "then total_minutes / total_calls else 0 end as avg_minutes_per_call, "
        "total_day_minutes / nullif(total_minutes, 0) as daytime_ratio from totals)"
    )


def _values(columns) -> str:
    """Long form of numeric columns per class, without NULLs."""
    kept = [f"cast({c} as double) as {c}" for c in columns if c != "churn"]
    return (
        f"narrow as (select churn, {_names(kept)} from processed), "
        f"vals as (unpivot narrow on {_names(c for c in columns if c != 'churn')} "
        'into name "column" value v)'
    )


def _all_processed() -> str:
    parts = [c if c in (*_TEXT, "churn") else _single(c, c) for c in _RAW]
    parts += [_single(c, c) for c in FEATURES[17:]]
    return f"{_processed()} select {_names(parts)} from processed"


def _raw_scan() -> str:
    parts = [_single(c, c) if c in _RAW_DOUBLES else c for c in _RAW]
    return f"with usage_raw as ({usage_raw_sql()}) select {_names(parts)} from usage_raw"


def _profile(aggregates: str, final: str) -> str:
    kept = [f"cast({c} as double) as {c}" for c in _NUMERIC]
    return (
        f"{_processed()}, narrow as (select {_names(kept)} from processed), "
        'vals as (select * from narrow unpivot include nulls (v for "column" in '
        f"({_names(_NUMERIC)}))) "
        f'select "column", {final} from '
        f'(select "column", {aggregates} from vals group by "column")'
    )


def _histogram(bins: str) -> str:
    """Shared edges per column, counts per class; ``bins`` is an SQL expression."""
    return (
        f"{_processed()}, {_values(FEATURES)}, "
        'span as (select "column", min(v) as lo, max(v) as hi, count(*) as n, '
        'quantile_cont(v, 0.75) - quantile_cont(v, 0.25) as iqr from vals group by "column"), '
        f'sized as (select "column", lo, hi, {bins} as bins from span), '
        'edges as (select "column", lo, hi, bins, (hi - lo) / bins as w from sized), '
        "guessed as (select churn, vals.\"column\", v, lo, w, bins, "
        "least(floor((v - lo) / w), bins - 1) as g from vals join edges "
        'on vals."column" = edges."column"), '
        'placed as (select churn, "column", cast(case when v < lo + g * w then g - 1 '
        "when g < bins - 1 and v >= lo + (g + 1) * w then g + 1 else g end as bigint) "
        "as bin from guessed), "
        'counted as (select churn, "column", bin, count(*) as n from placed group by all), '
        'classes as (select churn, "column", count(*) as rows from vals group by all), '
        "spine as (select churn, classes.\"column\", rows, lo, hi, w, bins, "
        "unnest(range(cast(bins as bigint))) as bin "
        'from classes join edges on classes."column" = edges."column") '
        'select spine.churn, spine."column", spine.bin, '
        f"{_single('lo + spine.bin * w', 'bin_low')}, "
        f"{_single('case when spine.bin = bins - 1 then hi else lo + (spine.bin + 1) * w end', 'bin_high')}, "
        'coalesce(n, 0) as "count", '
        f"{_single('coalesce(n, 0) / (rows * w)', 'density')} "
        'from spine left join counted on spine.churn = counted.churn '
        'and spine."column" = counted."column" and spine.bin = counted.bin'
    )


_AUTO_BINS = (
    "case when hi = lo then 1 else ceil((hi - lo) / case when iqr > 0 then "
    "least(2.0e0 * iqr / pow(n, 1e0 / 3), (hi - lo) / (log2(n) + 1)) "
    "else (hi - lo) / (log2(n) + 1) end) end"
)


def _density(gathered: str) -> str:
    return (
        f"{_processed()}, {_values(FEATURES)}, "
        'span as (select "column", min(v) as lo, max(v) as hi from vals group by "column"), '
        'shape as (select churn, vals."column", count(*) as rows, '
        "stddev_samp(v) * pow(count(*), -0.2e0) as h, any_value(lo) as lo, "
        "(any_value(hi) - any_value(lo)) / 199 as step from vals join span "
        'on vals."column" = span."column" group by churn, vals."column" '
        "having min(v) < max(v)), "
        f"gathered as ({gathered}), "
        "points as (select unnest(range(200)) as point), "
        'curve as (select shape.churn, shape."column", point, any_value(lo + point * step) as x, '
        "sum(c * exp(-0.5e0 * pow((lo + point * step - v) / h, 2))) / "
        "(any_value(rows) * any_value(h) * sqrt(2 * pi())) as density "
        "from gathered join shape on gathered.churn = shape.churn "
        'and gathered."column" = shape."column" cross join points '
        'group by shape.churn, shape."column", point) '
        'select churn, "column", cast(point as int) as point, '
        f"{_single('x', 'x')}, {_single('density', 'density')} from curve"
    )


def _boxes() -> str:
    return (
        f"{_processed()}, {_values(FEATURES)}, "
        'box as (select churn, "column", count(*) as n, quantile_cont(v, 0.25) as q1, '
        "quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3 "
        "from vals group by all), "
        "fences as (select *, q1 - 1.5e0 * (q3 - q1) as lo, q3 + 1.5e0 * (q3 - q1) as hi "
        "from box), "
        'reach as (select fences.churn, fences."column", any_value(n) as n, any_value(q1) as q1, '
        "any_value(median) as median, any_value(q3) as q3, "
        "min(v) filter (where v between lo and hi) as low, "
        "max(v) filter (where v between lo and hi) as high, "
        "count(*) filter (where v < lo or v > hi) as outliers "
        "from vals join fences on vals.churn = fences.churn "
        'and vals."column" = fences."column" group by fences.churn, fences."column") '
        f'select churn, "column", n as "count", {_single("q1", "q1")}, '
        f"{_single('median', 'median')}, {_single('q3', 'q3')}, "
        f"{_single('least(low, q1)', 'whisker_low')}, "
        f"{_single('greatest(high, q3)', 'whisker_high')}, outliers from reach"
    )


def _correlation(lower: bool) -> str:
    pairs = [
        (i, j)
        for i in range(len(_NUMERIC))
        for j in range(len(_NUMERIC))
        if not lower or i > j
    ]
    parts = [f"corr({_NUMERIC[i]}, {_NUMERIC[j]}) as c_{i}_{j}" for i, j in pairs]
    cases = [
        f"({i}, '{_NUMERIC[i]}', {j}, '{_NUMERIC[j]}', 'c_{i}_{j}')" for i, j in pairs
    ]
    return (
        f"{_processed()}, wide as (select {_names(parts)} from processed), "
        "long as (unpivot wide on columns(*) into name pair value c), "
        f"pairs(row_index, row_name, column_index, column_name, pair) as (values {_names(cases)}) "
        "select cast(row_index as int) as row_index, row_name, "
        "cast(column_index as int) as column_index, column_name, "
        "round(c, 6) + 0e0 as correlation from pairs left join long using (pair)"
    )


def _events(columns, enriched: bool, drop: bool = False) -> str:
    def source(name: str) -> str:
        return "epoch_us(event_ts)" if name == "timestamp" else name

    def value(expression: str) -> str:
        return f"case when event_id % 50 <> 0 then {expression} end"

    kinds = {f.name: f.dataType.typeName() for f in EVENT_SCHEMA.fields}
    parts = [
        _single(value(source(c)), c)
        if kinds[c] == "double"
        else f'{value(source(c))} as "{c}"'
        for c in columns
    ]
    if enriched:
        parts.append(f"{value('epoch_us(event_ts)')} as processing_time")
        parts.append(f"{value('cast(roaming = 1 as int)')} as is_roaming")
    where = " where event_id % 50 <> 0" if drop else ""
    return (
        f"with event_rows as ({event_rows_sql()}) select {_names(parts)} "
        f"from event_rows{where}"
    )


def _categories(top: bool) -> str:
    names = "area_code, international_plan, voice_mail_plan"
    base = (
        f"with usage_raw as ({usage_raw_sql()}), "
        f"narrow as (select churn, {names} from usage_raw), "
        'long as (select * from narrow unpivot include nulls (category for "column" in '
        f"({names}))), "
        'counted as (select "column", category, churn, count(*) as "count" from long group by all)'
    )
    if not top:
        return f"{base} select * from counted"
    return (
        f'{base}, totals as (select "column", category, sum("count") as t from counted group by all), '
        'ranked as (select "column", category, row_number() over (partition by "column" '
        "order by t desc, category nulls first) as r from totals) "
        "select counted.* from counted join ranked on counted.\"column\" = ranked.\"column\" "
        "and counted.category is not distinct from ranked.category where r <= 2"
    )


def oracle() -> dict[str, str]:
    encoded = [c if c not in _RAW_DOUBLES else _single(c, c) for c in _RAW]
    imputed = [
        _single(f"coalesce(cast({c} as double), avg({c}) over ())", c) if c in _CAPPED else c
        for c in _RAW
    ]
    capped = [_single(c, c) if c in _CAPPED else c for c in _RAW]
    capped_all = [c if c in _TEXT else _single(c, c) for c in _RAW]
    valid = "daytime_ratio is not null"
    event_fields = [f.name for f in EVENT_SCHEMA.fields]
    lineitem = (
        "l_orderkey, l_partkey, l_suppkey, l_linenumber, "
        + _names(
            _single(c, c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        )
        + ", l_returnflag, l_linestatus, cast(l_shipdate as varchar) as l_shipdate"
    )
    null_parts = [f"count(*) filter (where {c} is null) as {c}" for c in _RAW]
    rule = "case when total_intl_minutes >= 10 and voice_mail_plan = 0 then 1 else 0 end"
    standard = [
        f"round(({c} - avg({c}) over ()) / stddev_samp({c}) over (), 6) + 0e0 as {c}"
        for c in FEATURES
    ]
    return {
        "csv_scan": _raw_scan(),
        "parquet_scan": f"select {lineitem} from lineitem",
        "parquet_roundtrip": _raw_scan(),
        "binarize": f"with {_encoded()} select {_names(encoded)} from encoded",
        "impute_mean": f"with {_encoded()} select {_names(imputed)} from encoded",
        "sigma_cap": f"{_capped()} select {_names(capped)} from cleaned",
        "sigma_cap_with_label": f"{_capped(True)} select {_names(capped_all)} from cleaned",
        "feature_totals": f"{_processed()} select customer_id, "
        + _names(_single(c, c) for c in ("total_minutes", "total_calls", "total_charge"))
        + " from processed",
        "feature_ratios": f"{_processed()} select customer_id, "
        + _names(_single(c, c) for c in ("avg_minutes_per_call", "daytime_ratio"))
        + " from processed",
        "processed_table": _all_processed(),
        "etl_job": _all_processed(),
        "column_stats": _profile(
            "avg(v) as m, stddev_samp(v) as s, count(*) as row_count",
            f"{_single('m', 'mean')}, {_single('s', 'std')}, row_count",
        ),
        "column_profile": _profile(
            "avg(v) as m, stddev_samp(v) as s, min(v) as lo, max(v) as hi, "
            "count(*) - count(v) as null_count",
            f"{_single('m', 'mean')}, {_single('s', 'std')}, {_single('lo', 'min')}, "
            f"{_single('hi', 'max')}, null_count",
        ),
        "null_counts": f"with usage_raw as ({usage_raw_sql()}), counts as "
        f"(select {_names(null_parts)} from usage_raw) "
        f'unpivot counts on {_names(_RAW)} into name "column" value null_count',
        "label_distribution": f"with {_encoded()} "
        'select churn, count(*) as "count" from encoded group by churn',
        "label_rate": f"with {_encoded()} select count(*) as total_records, "
        f"{_single('count(*) filter (where churn = 1) / count(*) * 100', 'label_rate')} "
        "from encoded",
        "category_by_label": _categories(top=False),
        "category_top": _categories(top=True),
        "histogram_by_label": _histogram("20"),
        "histogram_auto_bins": f"select * from ({_histogram(_AUTO_BINS)}) where \"count\" > 0",
        "kde_by_label": _density(
            'select churn, "column", v, count(*) as c from vals group by all'
        ),
        "heavy_categories": "with vals as (select l_returnflag, unnest(['l_linestatus', 'l_quantity', 'l_partkey', "
        "'l_orderkey', 'l_suppkey']) as \"column\", unnest([l_linestatus, l_quantity::bigint::varchar, l_partkey::varchar, "
        "l_orderkey::varchar, l_suppkey::varchar]) as category from lineitem), totals as (select \"column\", category, "
        "count(*) as total from vals group by all having count(*) >= 1e-3 * (select count(*) from lineitem)) "
        "select vals.\"column\", vals.category, l_returnflag, count(*) as count, total from vals join totals on "
        "vals.\"column\" = totals.\"column\" and vals.category is not distinct from totals.category group by all",
        "kde_binned": _density(
            'select churn, vals."column", avg(v) as v, count(*) as c '
            'from vals join span on vals."column" = span."column" group by churn, '
            'vals."column", least(floor((v - lo) / ((hi - lo) / 1024)), 1023)'
        ),
        "box_stats_by_label": _boxes(),
        "correlation_matrix": _correlation(lower=False),
        "correlation_lower": _correlation(lower=True),
        "merged_correlation": _correlation(lower=False),
        "merged_profile": _profile(
            "avg(v) as m, stddev_samp(v) as s, min(v) as lo, max(v) as hi, "
            "count(*) - count(v) as null_count",
            f"{_single('m', 'mean')}, {_single('s', 'std')}, {_single('lo', 'min')}, "
            f"{_single('hi', 'max')}, null_count",
        ),
        "eda_report": f"with {_encoded()} select count(*) as total_records, "
        f"{_single('count(*) filter (where churn = 1) / count(*) * 100', 'label_rate')}, "
        f"'{_names(_NUMERIC)}' as numeric_columns, 'area_code' as categorical_columns "
        "from encoded",
        "profile_job": "with long as (" + _categories(top=False) + "), "
        f"histogram as (select * from ({_histogram(_AUTO_BINS)}) where \"count\" > 0), boxes as ({_processed()}, "
        f"{_values(FEATURES)} select churn, \"column\", count(*) as n, min(v) < max(v) as curved from vals group by all), "
        f"profiled as ({_processed()} select count(*) as n, count(distinct churn) as classes, "
        f"{' + '.join(f'count(*) - count({c})' for c in _NUMERIC)} as missing from processed), "
        "report as (select 'category_by_label' as table_name, count(*) as rows, sum(\"count\") as counted from long "
        "where \"column\" = 'area_code' "
        "union all select 'histogram_by_label', count(*), sum(\"count\") from histogram "
        "union all select 'density_by_label', 200 * count(*) filter (curved), 0 from boxes "
        "union all select 'box_stats_by_label', count(*), sum(n) from boxes "
        f"union all select 'column_profile', {len(_NUMERIC)}, missing from profiled "
        f"union all select 'correlation_lower', {len(_NUMERIC) * (len(_NUMERIC) - 1) // 2}, 0 "
        "union all select 'label_distribution', classes, n from profiled "
        "union all select 'summary', 1, n from profiled) "
        "select table_name, cast(rows as bigint) as rows, cast(counted as bigint) as counted from report",
        "stream_decode": _events(event_fields, enriched=False),
        "stream_enrich": _events(event_fields, enriched=True, drop=True),
        "stream_parquet_sink": "select case when event_id % 50 = 0 then 'malformed' "
        "else 'event' end as kind, count(*) as records from events group by all",
        "stream_end_to_end": _events(event_fields, enriched=True),
        "stream_restart": _events(event_fields, enriched=True),
        "stream_quarantine": f"with event_rows as ({event_rows_sql()}), marked as (select "
        "case when event_id % 50 <> 0 then customer_id end as customer_id, case when event_id % 50 = 0 then '<record>' "
        "when sms_count = 5 then 'sms_count,location_lat' when sms_count = 7 then 'location_lat' else '' end as failing "
        "from event_rows) select customer_id, failing, count(*) as records, count(*) as placed from marked group by all",
        "stream_compaction": f"with event_rows as ({event_rows_sql()}), decoded as (select case when event_id % 50 <> 0 "
        "then customer_id end as customer_id, case when event_id % 50 <> 0 then sms_count end as sms_count from event_rows) "
        "select customer_id, count(*) as events, cast(sum(sms_count) as bigint) as messages, 1 as fewer_files "
        "from decoded group by customer_id",
        "assembled_features": f"{_processed()} select customer_id, "
        + _names(_single(c, c) for c in FEATURES)
        + f" from processed where {valid}",
        "standardized": f"{_processed()} select customer_id, {_names(standard)} "
        f"from processed where {valid}",
        "split_sizes": f"with usage_raw as ({usage_raw_sql()}) select count(*) as rows, "
        "count(distinct customer_id) as customers, cast(0 as bigint) as customers_in_both, "
        "1 as share_as_asked from usage_raw",
        "class_weights": f"with {_encoded()}, sizes as "
        "(select churn, count(*) as n from encoded group by churn), "
        "totals as (select sum(n) as t, count(*) as k from sizes) "
        f"select churn, n as rows, {_single('t / (k * n)', 'class_weight')}, "
        f"{_single('t / k', 'total_weight')} from sizes, totals",
        "confusion_metrics": f"{_processed()}, scored as (select churn as y, {rule} as p "
        "from processed), classes as (select y as c, count(*) as n from scored group by y), "
        "sides as (select c, n, (select count(*) from scored where p = c) as np, "
        "(select count(*) from scored where p = c and y = c) as tp from classes) "
        f"select {_single('sum(n * 2e0 * tp / (n + np)) / sum(n)', 'f1')}, "
        f"{_single('sum(tp) / sum(n)', 'accuracy')}, "
        f"{_single('sum(n * case when np = 0 then 0 else tp / np end) / sum(n)', 'weighted_precision')}, "
        f"{_single('sum(n * (tp / n)) / sum(n)', 'weighted_recall')} from sides",
        "auc": f"{_processed()}, ranked as (select churn, rank() over (order by "
        "total_intl_minutes) + (count(*) over (partition by total_intl_minutes) - 1) / 2e0 "
        "as r from processed), sums as (select sum(r) filter (where churn = 1) as r1, "
        "count(*) filter (where churn = 1) as n1, count(*) filter (where churn = 0) as n0 "
        "from ranked) "
        f"select {_single('(r1 - n1 * (n1 + 1) / 2e0) / (n1 * n0)', 'auc_roc')} from sums",
        "preview": f"with usage_raw as ({usage_raw_sql()}) select count(*) as rows, "
        "cast(0 as bigint) as not_in_table from (select * from usage_raw limit 5)",
        "box_stats_approx": f"{_processed()}, {_values(FEATURES)} select churn, "
        '"column", count(*) as rows, 1 as within_accuracy from vals group by churn, "column"',
        "sketched_boxes": f"{_processed()}, {_values(FEATURES)} select churn, "
        f'"column", count(*) as rows, {_single("min(v)", "low")}, {_single("max(v)", "high")}, '
        '1 as within_accuracy from vals group by churn, "column"',
        "sketched_histogram": f"{_processed()}, {_values(FEATURES)} select churn, "
        '"column", count(*) as rows, count(*) as counted, 1 as bins_within from vals group by churn, "column"',
        "gbt_predictions": f"{_processed()} select customer_id, churn, "
        f"cast({valid} as int) as scored, cast({valid} as int) as follows_probability "
        "from processed where cast(regexp_extract(customer_id, '^c([0-9]+)-', 1) as bigint) % 5 = 0",
        "cv_scores": "select max_depth, step_size, 1 as has_score, 1 as chosen_is_best from "
        f"(select unnest({list(GRID['maxDepth'])}) as max_depth), "
        f"(select unnest({list(GRID['stepSize'])}::double[]) as step_size)",
        "synthetic_minority": f"{_processed()}, sizes as (select churn, count(*) as n from processed where {valid} "
        "group by churn), added as (select churn, n, case when n = (select min(n) from sizes) "
        "then n * ((select max(n) from sizes) // n - 1) else 0 end as new_rows from sizes) "
        "select churn, n + new_rows as rows, new_rows, new_rows as parents_of_the_class, "
        "new_rows as between_parents from added",
        "halving_search": f"{_processed()}, complete as (select count(*) filter (churn = 0) as no, "
        f"count(*) filter (churn = 1) as yes from processed where {valid}) "
        "select rung, rounds, points, survivors, points * no as predicted_no, points * yes as predicted_yes, "
        "1 as kept_the_best from complete, (values (0, 1, 81, 27), (1, 1, 27, 9), (2, 2, 9, 3), (3, 6, 3, 1)) "
        "as plan(rung, rounds, points, survivors)",
        "early_stopping": f"{_processed()}, numbered as (select churn, "
        "cast(regexp_extract(customer_id, '^c([0-9]+)-', 1) as bigint) % 5 as part from processed "
        f"where {valid}) select churn, count(*) filter (part = 1) as held_out, count(*) filter (part <> 1) as fitted, "
        "1 as fewer_trees, 1 as loss_not_above from numbered where part <> 0 group by churn",
        "evaluation": f"{_processed()}, sizes as (select churn, count(*) as test_rows, "
        f"count(*) filter (where {valid}) as scored from processed "
        "where cast(regexp_extract(customer_id, '^c([0-9]+)-', 1) as bigint) % 5 = 0 group by churn) "
        "select churn, test_rows, scored, metric, 1 as agrees from sizes, (select unnest(['f1_score', 'accuracy', "
        "'weighted_precision', 'weighted_recall', 'auc_roc', 'unscored_rows', 'top_importances']) as metric)",
        "feature_importance": f"select unnest({list(FEATURES)}) as feature, 1 as in_order, "
        "1e0 as total",
        "run_metrics": "select * from (values "
        "('param', 'model_type', 0::bigint, 1::bigint), ('param', 'max_depth', 1, 0), "
        "('param', 'max_iter', 1, 0), ('param', 'step_size', 1, 0), "
        "('param', 'feature_columns', 0, 1), ('metric', 'f1_score', 1, 0), "
        "('metric', 'auc_roc', 1, 0), ('metric', 'accuracy', 1, 0), "
        "('metric', 'weighted_precision', 1, 0), ('metric', 'weighted_recall', 1, 0), "
        "('metric', 'unscored_rows', 1, 0), ('metric', 'importance', 10, 0)) "
        "as t(kind, name, numbers, texts)",
        "batch_scores": f"{_processed()} select customer_id, cast({valid} as int) as has_class, "
        f"cast({valid} as int) as has_probability from processed",
        "model_roundtrip": f"{_processed()} select count(*) as rows, count(*) filter "
        f"(where {valid}) as scored, cast(0 as bigint) as different from processed",
        "scored_stream": f"{_processed()}, known as (select distinct 'cust_' || "
        "regexp_extract(customer_id, '^c([0-9]+)-', 1) as customer_id from processed "
        f"where {valid}), event_rows as ({event_rows_sql()}), decoded as (select "
        "case when event_id % 50 <> 0 then customer_id end as customer_id from event_rows) "
        "select decoded.customer_id, count(*) as events, count(known.customer_id) "
        "as scored_events, count(known.customer_id) as events_with_batch_score "
        "from decoded left join known "
        "on decoded.customer_id = known.customer_id group by decoded.customer_id",
        "keyed_stream": f"{_processed()}, made as (select 'cust_' || regexp_extract(customer_id, '^c([0-9]+)-', 1) "
        "as customer_id, cast(churn as double) as prediction, daytime_ratio as probability, row_number() over ("
        "partition by regexp_extract(customer_id, '^c([0-9]+)-', 1) order by cast(regexp_extract(customer_id, "
        "'^c[0-9]+-([0-9]+)-', 1) as bigint) desc, daytime_ratio desc nulls last, churn desc) as place "
        f"from processed), known as (select * from made where place = 1), event_rows as ({event_rows_sql()}), "
        "decoded as (select case when event_id % 50 <> 0 then customer_id end as customer_id from event_rows) "
        "select decoded.customer_id, count(*) as events, min(prediction) as least_prediction, "
        "max(prediction) as greatest_prediction, " + _single("min(probability)", "least_probability") + ", "
        + _single("max(probability)", "greatest_probability") + " from decoded left join known "
        "on decoded.customer_id = known.customer_id group by decoded.customer_id",
        "job_record": f"{_processed()} select 'rows' as name, cast(count(*) as double) as value "
        "from processed union all select 'rows_without_minutes', "
        "cast(count(*) filter (where daytime_ratio is null) as double) from processed",
    }
