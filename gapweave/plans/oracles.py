"""SQL counterparts of the registered queries, written for DuckDB over the same tables."""

from __future__ import annotations

from gapweave.plans.views import VIEWS, view_sql

ORACLES: dict[str, str] = {}

_MACROS = ["energy", "fat", "carbohydrates", "sugars", "proteins"]
_FEATURES = ["energy", "fat", "saturated_fat", "carbohydrates", "sugars", "proteins", "sodium", "salt"]
_LIMITS = {"energy": 950, "fat": 95, "sugars": 80, "salt": 6}
_PRODUCT_NAMES = ["code", "grp", "grade", "fr_score", "uk_score", *_FEATURES]


def _r(x: str, n: int = 6) -> str:
    return f"(round({x}, {n}) + 0e0)"


def _sig(x: str) -> str:
    """Nine decimals behind the leading digit."""
    unit = f"pow(10e0, floor(log10(abs({x}))))"
    return f"(CASE WHEN ({x}) <> 0 THEN round(({x}) / {unit}, 9) * {unit} ELSE 0e0 END)"


def _with(views: str, body: str, *ctes: str) -> str:
    parts = [f"{v} AS ({view_sql(v)})" for v in views.split() if v in VIEWS]
    return "WITH RECURSIVE " + ", ".join([*parts, *ctes]) + " " + body if parts or ctes else body


def _add(name: str, views: str, body: str, *ctes: str) -> None:
    ORACLES[name] = _with(views, body, *ctes)


def _union(rows) -> str:
    return " UNION ALL ".join(rows)


def _long(source: str, columns: list[str], keys: str = "") -> str:
    """(keys, column, value) of the non-null cells."""
    lead = keys + ", " if keys else ""
    return _union(f"SELECT {lead}'{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {source} WHERE {c} IS NOT NULL" for c in columns)


def _mode(source: str, column: str, by: str = "") -> str:
    """Most frequent value, the lowest among equals."""
    group = f"{by}, {column}" if by else column
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return (
        f"SELECT {lead}{column} AS mode, n FROM (SELECT {lead}{column}, count(*) AS n, row_number() OVER ({part} ORDER BY count(*) DESC, {column}) AS r "
        f"FROM {source} WHERE {column} IS NOT NULL GROUP BY {group}) x WHERE r = 1"
    )


# --- sources and sinks --------------------------------------------------------------------------

_ORDERS = f"SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, {_r('o_totalprice')} AS o_totalprice FROM orders_m"
_add("scan_delimited", "orders_m", _ORDERS)
_add("drop_empty_columns", "orders_m", _ORDERS)
_add("scan_separator_fallback", "orders_m", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders_m")
_add(
    "scan_grouped",
    "orders_m",
    """SELECT CAST(CASE WHEN o_orderkey % 3 = 2 THEN 2 ELSE 3 END AS BIGINT) AS width, o_orderkey % 3 = 0 AS commas, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
 CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders_m""",
)
_add(
    "scan_tolerant",
    "",
    """SELECT CASE WHEN event_id % 50 <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
 CASE WHEN event_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
 CASE WHEN event_id % 50 <> 0 AND event_id % 70 <> 3 THEN event_type END AS event_type,
 CASE WHEN event_id % 50 = 0 THEN concat(event_id, ',', user_id, ',', event_type, ',extra') END AS line FROM events""",
)
_COMBINATIONS = "SELECT o_orderstatus, o_orderpriority, count(*) AS frequency FROM orders_m GROUP BY 1, 2"
_add("load_cached", "orders_m", _COMBINATIONS)
_add("combination_counts", "orders_m", _COMBINATIONS)
_add("write_formats", "orders_m", _union(f"SELECT *, '{k}' AS kind FROM c" for k in ("csv", "json", "parquet")), f"c AS ({_COMBINATIONS})")
_add(
    "cast_by_suffix",
    "event_times",
    f"""SELECT CAST(event_id AS VARCHAR) AS code, CASE WHEN event_id % 9 <> 5 THEN created_t END AS created_t,
 CAST(CAST(TRY_CAST(created_datetime AS TIMESTAMP) AS DATE) AS VARCHAR) AS created_day,
 CASE WHEN event_id % 8 <> 3 THEN {_r('value')} END AS value_100g,
 CASE WHEN event_id % 4 = 1 THEN 'a|b|c' ELSE 'd' END AS kinds FROM event_times""",
)
_add(
    "nested_groups",
    "orders_m",
    """SELECT coalesce(o_orderpriority, 'nan') AS "group", o_orderpriority AS a, o_orderstatus AS b, frequency,
 CAST(sum(frequency) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total_frequency FROM c""",
    f"c AS ({_COMBINATIONS})",
)
_add(
    "frame_summary",
    "orders_m",
    f"""SELECT 'orders' AS frame, count(*) AS rows, CAST(5 AS BIGINT) AS columns,
 count(*) * 5 - count(o_orderkey) - count(o_custkey) - count(o_orderstatus) - count(o_orderpriority) - count(o_totalprice) AS missing,
 {_r('(count(*) * 5 - count(o_orderkey) - count(o_custkey) - count(o_orderstatus) - count(o_orderpriority) - count(o_totalprice)) * 100e0 / (count(*) * 5)')} AS missing_pct,
 'bigint=2, double=1, string=2' AS column_types FROM orders_m""",
)
_add(
    "version_compare",
    "part_m",
    "SELECT *, 'Added' AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'Removed' AS change FROM (SELECT * FROM o EXCEPT SELECT * FROM n)",
    "o AS (SELECT p_partkey, p_name, p_brand FROM part_m)",
    "n AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 20 = 1 THEN 'Brand#0' ELSE p_brand END AS p_brand FROM part_m WHERE p_partkey % 50 <> 3)",
)

# --- projections, filters, samples --------------------------------------------------------------

_add("select_by_kind", "orders_m", f"SELECT o_orderkey, {_r('o_totalprice')} AS o_totalprice FROM orders_m")
_add("keep_filled_columns", "events_m", "SELECT event_id, user_id, event_type FROM events_m")
_add(
    "filter_rows",
    "orders_m",
    f"SELECT o_orderkey, o_orderstatus, o_orderpriority, {_r('o_totalprice')} AS price FROM orders_m WHERE o_totalprice IS NOT NULL AND o_orderstatus IN ('F', 'O')",
)
_PRESENT = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _FEATURES)
_add(
    "most_complete_rows",
    "products",
    "SELECT code FROM k WHERE n >= (SELECT quantile_cont(CAST(n AS DOUBLE), 0.65) FROM k)",
    f"k AS (SELECT code, {_PRESENT} AS n FROM products)",
)
_add("exact_sample", "orders_m", "SELECT o_orderkey FROM orders_m ORDER BY o_orderkey * 7919 % 10007, o_orderkey LIMIT 500")
_add("stable_split", "orders_m", "SELECT CASE WHEN o_orderkey * 31 % 100 < 80 THEN 'train' ELSE 'test' END AS part, o_orderstatus, count(*) AS n FROM orders_m GROUP BY 1, 2")
_IQR = "q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events_m)"
_IQR_BOUNDS = "b AS (SELECT q1 - 1.5e0 * (q3 - q1) AS lower, q3 + 1.5e0 * (q3 - q1) AS upper FROM q)"
_add(
    "outlier_samples",
    "events_m",
    f"SELECT event_id, 'value' AS \"column\", {_r('value')} AS value FROM events_m, b WHERE value < lower OR value > upper ORDER BY event_id * 7919 % 10007, event_id LIMIT 100",
    _IQR,
    _IQR_BOUNDS,
)

# --- scalar functions ---------------------------------------------------------------------------

_NORMAL = r"trim(regexp_replace(regexp_replace(lower({0}), '-', ' ', 'g'), '\s+', ' ', 'g'))"
_TOKENS = r"array_to_string(list_sort([w FOR w IN string_split_regex(lower(regexp_replace({0}, '\W', ' ', 'g')), '\s+') IF w <> '']), ' ')"
_add(
    "label_functions",
    "part_labels",
    f"""SELECT p_partkey, {_NORMAL.format('label')} AS normal, {_TOKENS.format('label')} AS sorted_tokens,
 p_partkey % 10 = 3 AS bad_null, nullif(parent, 'unknown') AS parent, coalesce(parent, 'none') AS parent_filled, CAST(3 AS BIGINT) AS n_tags,
 CASE WHEN substr(label, 1, 3) = 'red' THEN 'Yes' ELSE 'No' END AS is_red FROM part_labels""",
)


def _grade_of(score: str) -> str:
    return f"CASE WHEN {score} <= 0 THEN 'a' WHEN {score} <= 3 THEN 'b' WHEN {score} <= 10 THEN 'c' WHEN {score} <= 18 THEN 'd' WHEN {score} IS NOT NULL THEN 'e' END"


_add(
    "number_functions",
    "products",
    f"""SELECT code, CASE WHEN code % 5 <> 1 THEN energy END AS number, CAST(ascii(grade) - 96 AS BIGINT) AS grade_number,
 CASE WHEN fr_score IS NOT NULL THEN chr(CAST(96 + CASE WHEN round_even(fr_score / 2, 0) < 1 THEN 1 WHEN round_even(fr_score / 2, 0) > 5 THEN 5 ELSE round_even(fr_score / 2, 0) END AS INTEGER)) END AS grade_of_half,
 {_grade_of('fr_score')} AS grade_of_score, CAST(round_even(fr_score / 2, 0) AS BIGINT) AS half_even,
 CASE WHEN energy < 100 THEN 100e0 WHEN energy > 900 THEN 900e0 ELSE energy END AS clipped,
 CASE WHEN code % 7 = 1 THEN 0e0 ELSE {_r('fat')} END AS fat,
 CASE WHEN code % 4 = 0 THEN 'New' ELSE printf('%.1f%%', round_even(energy * 0.5e0, 1)) END AS change FROM products""",
)
_UNIX_DAY = "CAST(make_timestamp(created_t * 1000000) AS DATE)"
_ISO = "TRY_CAST(created_datetime AS TIMESTAMP)"
_add("time_functions", "event_times", f"SELECT event_id, CAST({_UNIX_DAY} AS VARCHAR) AS unix_day, CAST(CAST({_ISO} AS DATE) AS VARCHAR) AS iso_day FROM event_times")
_add("tuple_text", "order_labels", "SELECT o_orderkey, b, CAST(a AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS c FROM order_labels")

# --- joins --------------------------------------------------------------------------------------

_add(
    "map_labels",
    "customer_geo",
    "SELECT c.c_custkey, c.n_name, r.r_name AS region FROM customer_geo c LEFT JOIN nation n ON c.n_name = n.n_name LEFT JOIN region r ON n.n_regionkey = r.r_regionkey",
)
_add(
    "write_back_cells",
    "orders_m",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN coalesce(o_orderstatus, 'X') ELSE o_orderstatus END AS o_orderstatus, o_orderpriority,
 {_r('CASE WHEN o_orderkey % 3 = 0 THEN coalesce(o_totalprice, 1.5e0) ELSE o_totalprice END')} AS o_totalprice FROM orders_m""",
)
_add(
    "member_filter",
    "part_m",
    """SELECT p_partkey, p_brand FROM part_m WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size < 10 AND p_retailprice < 950)
 AND p_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 10)""",
)
_add(
    "nearest_vectors",
    "",
    f"SELECT vec_id, r AS rank, donor, {_r('d')} AS distance FROM k WHERE r <= 5",
    """p AS (SELECT q.vec_id, e.vec_id AS donor, list_sum([(CAST(q.embedding[i] AS DOUBLE) - CAST(e.embedding[i] AS DOUBLE)) * (CAST(q.embedding[i] AS DOUBLE) - CAST(e.embedding[i] AS DOUBLE)) FOR i IN generate_series(1, 64)]) AS s
 FROM embeddings q JOIN embeddings e ON q.vec_id <> e.vec_id)""",
    f"k AS (SELECT vec_id, donor, sqrt(s) AS d, row_number() OVER (PARTITION BY vec_id ORDER BY {_sig('s')}, donor) AS r FROM p)",
)
_add(
    "nearest_small_scale",
    "",
    "SELECT c_custkey, donor FROM k WHERE r = 1",
    "p AS (SELECT q.c_custkey, e.c_custkey AS donor, (q.c_acctbal * 1e-9 - e.c_acctbal * 1e-9) * (q.c_acctbal * 1e-9 - e.c_acctbal * 1e-9) AS s FROM customer q JOIN customer e ON q.c_custkey <> e.c_custkey)",
    f"k AS (SELECT c_custkey, donor, row_number() OVER (PARTITION BY c_custkey ORDER BY {_sig('s')}, donor) AS r FROM p)",
)

# --- profiles and aggregations ------------------------------------------------------------------

_PART_TYPES = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int", "p_retailprice": "double"}


def _profile(source: str, types: dict[str, str], frame: str) -> str:
    return _union(
        f"""SELECT '{frame}' AS frame, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
 {_r(f'count({c}) * 100e0 / count(*)', 2)} AS fill_pct, count(DISTINCT {c}) AS "distinct", {_r(f'count(DISTINCT {c}) * 100e0 / nullif(count({c}), 0)', 2)} AS unique_pct,
 (SELECT mode FROM ({_mode(f"(SELECT CAST({c} AS VARCHAR) AS v FROM {source})", "v")})) AS most_common,
 (SELECT n FROM ({_mode(f"(SELECT CAST({c} AS VARCHAR) AS v FROM {source})", "v")})) AS most_common_count FROM {source}"""
        for c, t in types.items()
    )


_add("column_profile", "part_m", _profile("part_m", _PART_TYPES, "part"))
_LINE_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
    "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
_add(
    "column_profile_sketched",
    "",
    _union(
        f"""SELECT 'lineitem' AS frame, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls, {_r(f'count({c}) * 100e0 / count(*)', 2)} AS fill_pct FROM lineitem"""
        for c, t in _LINE_TYPES.items()
    ),
)
_FEW = ("l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax")
_add(
    "incremental_profile",
    "",
    _union(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls, {_r(f'count({c}) * 100e0 / count(*)')} AS fill_pct,
 {_r(f'CAST(min({c}) AS DOUBLE)') if t in ('bigint', 'int', 'double') else 'CAST(NULL AS DOUBLE)'} AS low, {_r(f'CAST(max({c}) AS DOUBLE)') if t in ('bigint', 'int', 'double') else 'CAST(NULL AS DOUBLE)'} AS high,
 true AS distinct_within, {f'(SELECT count(*) FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1)' if c in _FEW else 'CAST(NULL AS BIGINT)'} AS most_common_count FROM lineitem"""
        for c, t in _LINE_TYPES.items()
    ),
)
_KIND = {"bigint": "int", "int": "int", "double": "float", "string": "str"}


def _type_row(c: str, t: str, observed: str | None = None) -> str:
    observed = observed or f"concat('{_KIND[t]}(', max(strlen(CAST({c} AS VARCHAR))), ')')"
    return f"""SELECT '{c}' AS "column", '{t}' AS dtype, {observed} AS observed_type, {_r(f'count({c}) * 100e0 / count(*)')} AS fill_pct,
 {_r(f'(count(*) - count({c})) * 100e0 / count(*)')} AS missing_pct, {_r(f"count_if(CAST({c} AS VARCHAR) IN ('', 'None', 'NULL', 'null')) * 100e0 / count(*)")} AS bad_null_pct,
 {_r(f'(count({c}) - count(DISTINCT {c})) * 100e0 / count({c})')} AS duplicate_pct FROM m"""


_INTS = "count_if(regexp_full_match(mixed, '[0-9]+'))"
_INT_PCT = f"printf('int: %.2f%%', {_INTS} * 100e0 / count(mixed))"
_STR_PCT = f"printf('str: %.2f%%', (count(mixed) - {_INTS}) * 100e0 / count(mixed))"
_MIXED = f"concat('errorType(', CASE WHEN {_INTS} * 2 >= count(mixed) THEN concat({_INT_PCT}, ', ', {_STR_PCT}) ELSE concat({_STR_PCT}, ', ', {_INT_PCT}) END, ')')"
_add(
    "type_profile",
    "part_m",
    _union([*[_type_row(c, t) for c, t in _PART_TYPES.items()], _type_row("mixed", "string", _MIXED)]),
    "m AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR) WHEN p_partkey % 10 = 1 THEN 'NULL' ELSE p_name END AS mixed FROM part_m)",
)
_DECLARED = {"p_partkey": ("integer", "Yes"), "p_name": ("string", "Yes"), "p_brand": ("strict", "Yes"), "p_retailprice": ("double", "No")}
_add(
    "dictionary_match",
    "part_m",
    _union(
        f"""SELECT '{c}' AS "column", concat('{_KIND[t]}(', max(strlen(CAST({c} AS VARCHAR))), ')') AS observed_type, '{_DECLARED.get(c, ('Unknown', 'No'))[0]}' AS declared_type,
 '{_DECLARED.get(c, ('Unknown', 'No'))[1]}' AS types_match FROM part_m"""
        for c, t in _PART_TYPES.items()
    ),
)
_add(
    "column_categories",
    "part_m",
    """SELECT "column", id_like, categorical, "binary", NOT id_like AND NOT categorical AND NOT "binary" AND dtype <> 'string' AS "numeric", low_fill FROM
 (SELECT "column", dtype, unique_pct > 90 AND "distinct" > 1000 AS id_like, unique_pct <= 90 AND unique_pct > 5 AND dtype = 'string' AS categorical,
 "distinct" BETWEEN 2 AND 5 AS "binary", fill_pct < 25 AS low_fill FROM p) x""",
    f"p AS ({_profile('part_m', _PART_TYPES, 'part')})",
)
_add(
    "missing_report",
    "products",
    "SELECT * FROM ("
    + _union(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, {_r(f'(count(*) - count({c})) * 100e0 / count(*)')} AS missing_pct, '{'bigint' if c == 'code' else 'string' if c in ('grp', 'grade') else 'double'}' AS dtype FROM products"
        for c in _PRODUCT_NAMES
    )
    + ") x WHERE missing > 0",
)
_add("columns_by_missing", "products", _union(f"SELECT '{c}' AS \"column\", (count(*) - count({c})) * 1e0 / count(*) > 0.1e0 AS above FROM products" for c in _PRODUCT_NAMES))
_add("top_values", "part_m", "SELECT p_brand AS value, count(*) AS n FROM part_m WHERE p_brand IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
_add("group_mode", "part_m", _mode("(SELECT * FROM part_m WHERE p_type IS NOT NULL)", "p_brand", "p_type"))
_add(
    "describe_columns",
    "",
    f"""SELECT "column", count(*) AS n, {_r('avg(value)', 4)} AS mean, {_r('stddev_samp(value)', 4)} AS std, {_r('min(value)', 4)} AS lowest, {_r('max(value)', 4)} AS highest,
 {_r('skewness(value)', 4)} AS skewness, {_r('quantile_cont(value, 0.25)', 4)} AS q25, {_r('quantile_cont(value, 0.5)', 4)} AS q50, {_r('quantile_cont(value, 0.75)', 4)} AS q75 FROM v GROUP BY 1""",
    f"v AS ({_long('lineitem', ['l_quantity', 'l_extendedprice', 'l_discount'])})",
)
_add(
    "iqr_summary",
    "events_m",
    f"""SELECT 'value' AS "column", count_if(value < lower OR value > upper) AS outliers, {_r('count_if(value < lower OR value > upper) * 100e0 / count(value)')} AS outlier_pct,
 {_r('skewness(value)')} AS skewness, {_r('avg(value)')} AS mean, {_r('avg(value) FILTER (value BETWEEN lower AND upper)')} AS clean_mean, {_r('stddev_samp(value)')} AS std,
 {_r('stddev_samp(value) FILTER (value BETWEEN lower AND upper)')} AS clean_std, {_r('max(lower)')} AS lower, {_r('max(upper)')} AS upper, min(value) > 0 AS log_scale_ok FROM events_m, b""",
    _IQR,
    _IQR_BOUNDS,
)
_add(
    "iqr_capped",
    "events_m",
    f"SELECT event_id, user_id, event_type, {_r('CASE WHEN value < lower THEN lower WHEN value > upper THEN upper ELSE value END')} AS value FROM events_m, b",
    _IQR,
    _IQR_BOUNDS,
)


def _limit_row(c: str, hi: float) -> str:
    out = f"({c} < 0 OR {c} > {hi})"
    clean = f"avg({c}) FILTER (NOT {out})"
    return f"""SELECT '{c}' AS "column", count_if({out}) AS outliers, {_r(f'count_if({out}) * 100e0 / count({c})')} AS outlier_pct, count_if({c} < 0) AS below, count_if({c} > {hi}) AS above,
 {hi}e0 AS upper, {_r(f'min({c}) FILTER ({c} < 0)')} AS extreme_min, {_r(f'max({c}) FILTER ({c} > {hi})')} AS extreme_max, {_r(f'avg({c})')} AS mean, {_r(clean)} AS clean_mean,
 {_r(f'(avg({c}) - {clean}) * 100e0 / nullif({clean}, 0)')} AS mean_change_pct FROM products"""


_add("limit_summary", "products", _union(_limit_row(c, v) for c, v in _LIMITS.items()))
_add(
    "limit_cleaned",
    "products",
    "SELECT code, " + ", ".join(_r(f"CASE WHEN {c} < 0 OR {c} > {v} THEN NULL ELSE {c} END") + f" AS {c}" for c, v in _LIMITS.items()) + " FROM products",
)


def _bins(value: str, low: str, high: str, bins: str) -> str:
    return f"CAST(coalesce(least(floor(({value} - {low}) / nullif({high} - {low}, 0) * {bins}), {bins} - 1), 0) AS BIGINT)"


_add(
    "histogram",
    "products",
    f"""SELECT bin, {_r('a + bin * ((b - a) / k)')} AS left_edge, {_r('a + (bin + 1) * ((b - a) / k)')} AS right_edge, n, {_r('n / (sum(n) OVER () * ((b - a) / k))')} AS density
 FROM (SELECT {_bins('energy', 'a', 'b', 'k')} AS bin, a, b, k, count(*) AS n FROM products, s WHERE energy IS NOT NULL GROUP BY 1, 2, 3, 4) x""",
    "s AS (SELECT min(energy) AS a, max(energy) AS b, least(50, greatest(10, ceil(log2(count(energy))) + 1)) AS k FROM products)",
)
_add(
    "score_histogram",
    "products",
    f"""SELECT bin, {_r('-30e0 + bin')} AS left_edge, {_r('-30e0 + bin + 1')} AS right_edge, n, {_r('n / sum(n) OVER ()')} AS density
 FROM (SELECT {_bins('fr_score', '-30e0', '30e0', '60')} AS bin, count(*) AS n FROM products WHERE fr_score BETWEEN -30 AND 30 GROUP BY 1) x""",
)
_add(
    "box_statistics",
    "products",
    f"""SELECT grade, "column", count(*) AS n, {_r('quantile_cont(value, 0.25)')} AS q1, {_r('quantile_cont(value, 0.5)')} AS median, {_r('quantile_cont(value, 0.75)')} AS q3,
 {_r('avg(value)')} AS mean, {_r('min(value)')} AS lowest, {_r('max(value)')} AS highest FROM v
 WHERE grade IN (SELECT grade FROM products WHERE grade IS NOT NULL GROUP BY 1 HAVING count(*) >= 5) GROUP BY 1, 2""",
    f"v AS ({_long('products', _MACROS, 'grade')})",
)
_add("correlations", "products", _union(f"SELECT '{a}' AS a, '{b}' AS b, {_r(f'corr({a}, {b})')} AS corr FROM products" for a in _MACROS for b in _MACROS))
_add(
    "category_statistics",
    "products",
    f"""SELECT grp AS category, "column", {_r('avg(value)')} AS mean, {_r('median(value)')} AS median, count(*) AS n FROM v
 WHERE grp IN (SELECT grp FROM products WHERE grp IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, grp LIMIT 6) GROUP BY 1, 2""",
    f"v AS ({_long('products', _MACROS, 'grp')})",
)
_add("cross_counts", "part_labels", "SELECT parent, label, count(*) AS n FROM part_labels WHERE parent IS NOT NULL AND label IS NOT NULL AND parent <> 'unknown' AND label <> 'unknown' GROUP BY 1, 2")
_add("cross_table", "products", "SELECT grp, " + ", ".join(f"count_if(grade = '{g}') AS {g}" for g in "abcde") + " FROM products WHERE grp IS NOT NULL GROUP BY 1")


def _fit(group: str) -> str:
    """Weighted line per group of p(group, x, y, w)."""
    return f"""SELECT {group}, points, {_r('slope')} AS slope, {_r('my - slope * mx')} AS intercept,
 {_r('1 - (SELECT sum((p.y - (f.my - f.slope * f.mx) - f.slope * p.x) ** 2) FROM p WHERE p.g = f.g) / nullif(vy, 0)')} AS r2,
 {_r('1 - (SELECT sum(p.w * (p.y - (f.my - f.slope * f.mx) - f.slope * p.x) ** 2) FROM p WHERE p.g = f.g) / nullif(wyy, 0)')} AS r2_weighted,
 {_r('min_x')} AS min_x, {_r('max_x')} AS max_x, {_r('min_y')} AS min_y, {_r('max_y')} AS max_y FROM
 (SELECT g, g AS {group}, count(*) AS points, sum(w * (x - mx) * (y - my)) / sum(w * (x - mx) ** 2) AS slope, mx, my, sum((y - uy) ** 2) AS vy, sum(w * (y - my) ** 2) AS wyy,
 min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM p JOIN m USING (g) GROUP BY g, mx, my HAVING count(*) >= 3) f"""


_MEANS = "m AS (SELECT g, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, avg(y) AS uy FROM p GROUP BY 1)"
_add(
    "line_fit",
    "products",
    _fit("grade"),
    "p AS (SELECT grade AS g, fr_score AS x, uk_score AS y, CAST(count(*) AS DOUBLE) AS w FROM products WHERE grade IS NOT NULL AND fr_score IS NOT NULL AND uk_score IS NOT NULL GROUP BY 1, 2, 3)",
    _MEANS,
)
_add(
    "weighted_line_fit",
    "",
    _fit("l_returnflag"),
    "p AS (SELECT l_returnflag AS g, l_quantity AS x, round(l_extendedprice, -3) AS y, CAST(count(*) AS DOUBLE) AS w FROM lineitem GROUP BY 1, 2, 3)",
    _MEANS,
)
_add(
    "compare_statistics",
    "products",
    """SELECT "column", round(avg(b), 2) + 0e0 AS before_mean, round(avg(a), 2) + 0e0 AS after_mean, round(avg(a) - avg(b), 2) + 0e0 AS mean_diff,
 round((avg(a) - avg(b)) * 100 / avg(b), 1) + 0e0 AS mean_change_pct, round(median(b), 2) + 0e0 AS before_median, round(median(a), 2) + 0e0 AS after_median,
 round(stddev_samp(b), 2) + 0e0 AS before_std, round(stddev_samp(a), 2) + 0e0 AS after_std FROM v GROUP BY 1""",
    "v AS (" + _union(f"SELECT '{c}' AS \"column\", {c} AS b, coalesce({c}, 50e0) AS a FROM products" for c in _MACROS) + ")",
)
_add(
    "group_growth",
    "orders_m",
    f"""SELECT o_orderstatus, o_orderpriority, count_before, count_after, count_after - count_before AS difference, {_r('pct')} AS pct_change,
 {_r('CASE WHEN pct < 0 THEN 0e0 WHEN pct > 1000 THEN 1000e0 ELSE pct END')} AS pct_capped,
 CASE WHEN count_before = 0 AND count_after > 0 THEN 'New' ELSE printf('%.1f%%', round_even(pct, 1)) END AS label FROM
 (SELECT *, CASE WHEN count_before > 0 THEN (count_after - count_before) * 100e0 / count_before WHEN count_after > 0 THEN 100e0 ELSE 0e0 END AS pct FROM
 (SELECT o_orderstatus, o_orderpriority, coalesce(x, 0) AS count_before, coalesce(y, 0) AS count_after FROM
 (SELECT o_orderstatus, o_orderpriority, count(*) AS x FROM orders_m WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2) b
 FULL JOIN (SELECT o_orderstatus, o_orderpriority, count(*) AS y FROM a WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2) a USING (o_orderstatus, o_orderpriority)) x) y""",
    "a AS (SELECT coalesce(o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE 'F' END) AS o_orderstatus, o_orderpriority FROM orders_m WHERE o_orderpriority IS NULL OR o_orderpriority <> '5-LOW' OR o_orderkey % 4 = 0)",
)
_NUMBER_BINS = _union(
    f"""SELECT frame, '{c}' AS "column", CAST({_bins(c, 'lo', 'hi', '30')} AS VARCHAR) AS bucket, count(*) AS n FROM f, (SELECT min({c}) AS lo, max({c}) AS hi FROM f) e WHERE {c} IS NOT NULL GROUP BY 1, 2, 3"""
    for c in ("energy", "sugars")
)
_add(
    "distribution_comparison",
    "products",
    _NUMBER_BINS
    + """ UNION ALL SELECT frame, 'grp' AS "column", grp AS bucket, n FROM (SELECT frame, grp, count(*) AS n, row_number() OVER (PARTITION BY frame ORDER BY count(*) DESC, grp) AS r
 FROM f WHERE grp IS NOT NULL GROUP BY 1, 2) x WHERE r <= 10""",
    "f AS (SELECT 'before' AS frame, energy, sugars, grp FROM products UNION ALL SELECT 'after', coalesce(energy, 600), sugars, coalesce(grp, 'other') FROM products)",
)

# --- windows, sets ------------------------------------------------------------------------------

_add(
    "frequent_combinations",
    "part_m",
    f"""SELECT p_brand, p_type, p_size, frequency, running, {_r('running * 100e0 / total')} AS cumulative_pct FROM
 (SELECT *, CAST(sum(frequency) OVER (ORDER BY frequency DESC, p_brand NULLS FIRST, p_type NULLS FIRST, p_size NULLS FIRST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running, sum(frequency) OVER () AS total FROM
 (SELECT p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, count(*) AS frequency FROM part_m GROUP BY 1, 2, 3) c) r WHERE running <= 0.5 * total""",
)
_add(
    "group_mean_fill",
    "products",
    "SELECT code, grp, " + ", ".join(_r(f"coalesce({c}, CASE WHEN grp IS NOT NULL THEN avg({c}) OVER (PARTITION BY grp) END)") + f" AS {c}" for c in ("energy", "fat")) + " FROM products",
)
_add(
    "duplicate_flags",
    "part_m",
    "SELECT p_partkey, p_brand, p_brand IS NOT NULL AND row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) > 1 AS is_duplicate FROM part_m",
)
_add(
    "top_by_magnitude",
    "",
    f"""SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment, {_r('balance', 2)} AS balance FROM (SELECT c_nationkey, c_mktsegment, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1, 2) x
 ORDER BY abs(balance) DESC, c_nationkey, c_mktsegment LIMIT 15""",
)
_add(
    "version_diff",
    "",
    "SELECT *, 'Added' AS change FROM (SELECT * FROM n EXCEPT SELECT * FROM o) UNION ALL SELECT *, 'Removed' AS change FROM (SELECT * FROM o EXCEPT SELECT * FROM n)",
    "o AS (SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_mktsegment FROM customer)",
    "n AS (SELECT CAST(c_nationkey + CASE WHEN c_custkey % 100 = 1 THEN 25 ELSE 0 END AS BIGINT) AS c_nationkey, c_mktsegment FROM customer WHERE c_custkey % 10 < 7)",
)

# --- rules --------------------------------------------------------------------------------------

# Fixed values, as in the rule tables.
_MAXIMA = {"energy": 4300, "fat": 95, "saturated_fat": 55, "carbohydrates": 95, "sugars": 95, "proteins": 90, "sodium": 3, "salt": 6}
_NUTRIENTS = [c for c in _FEATURES]
_OTHERS = ["code", "grp", "grade", "fr_score", "uk_score"]
_LIMITED = "l AS (SELECT code, grp, grade, fr_score, uk_score, " + ", ".join(f"CASE WHEN {c} > {_MAXIMA[c]} THEN NULL ELSE {c} END AS {c}" for c in _NUTRIENTS) + " FROM products)"


def _final(changes: dict[str, str] | None = None, names=None) -> str:
    changes = changes or {}
    out = []
    for c in names or _PRODUCT_NAMES:
        x = changes.get(c, c)
        out.append(f"{x} AS {c}" if c in ("code", "grp", "grade") else f"{_r(x)} AS {c}")
    return ", ".join(out)


_add(
    "integrity_checked",
    "products",
    "SELECT "
    + _final({"saturated_fat": "CASE WHEN saturated_fat > fat THEN NULL ELSE saturated_fat END", "sodium": "CASE WHEN sodium > salt THEN NULL ELSE sodium END"})
    + " FROM l",
    _LIMITED,
)
_add(
    "integrity_violations",
    "products",
    _union(
        [f"SELECT code, '{c} > {_MAXIMA[c]}' AS rule, {_r(c)} AS value FROM products WHERE {c} > {_MAXIMA[c]}" for c in _NUTRIENTS]
        + [f"SELECT code, '{a} > {b}' AS rule, {_r(a)} AS value FROM l WHERE {a} > {b}" for a, b in (("saturated_fat", "fat"), ("sodium", "salt"))]
    ),
    _LIMITED,
)
_RANGES = {"a": (-15, -1, -15, -1), "b": (0, 2, 0, 2), "c": (3, 10, -3, 10), "d": (11, 18, 11, 19), "e": (19, 40, 19, 40)}
_BAD_GRADE = "CASE grade " + " ".join(
    f"WHEN '{g}' THEN NOT coalesce(fr_score BETWEEN {a} AND {b} AND uk_score BETWEEN {c} AND {d}, false)" for g, (a, b, c, d) in _RANGES.items()
) + " ELSE false END"
_add(
    "grades_checked",
    "products",
    f"SELECT code, CASE WHEN NOT bad THEN grade END AS grade, CASE WHEN NOT bad THEN fr_score END AS fr_score, CASE WHEN NOT bad THEN uk_score END AS uk_score FROM (SELECT *, {_BAD_GRADE} AS bad FROM products) x",
)
_add("datetime_filled", "event_times", f"SELECT event_id, strftime(coalesce({_ISO}, CAST({_UNIX_DAY} AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS created FROM event_times")
_add(
    "datetime_discrepancies",
    "event_times",
    f"SELECT event_id, CAST({_UNIX_DAY} AS VARCHAR) AS unix_date, CAST(CAST({_ISO} AS DATE) AS VARCHAR) AS datetime_date FROM event_times WHERE {_UNIX_DAY} <> CAST({_ISO} AS DATE)",
)


def _step(name: str, source: str, changes: dict[str, str]) -> str:
    return f"{name} AS (SELECT " + ", ".join(f"{changes[c]} AS {c}" if c in changes else c for c in _PRODUCT_NAMES) + f" FROM {source})"


_CAPS = {**_MAXIMA, "energy": 950}
_THEORY = "(proteins * 4 + carbohydrates * 4 + fat * 9)"
_SUM = "(fat + carbohydrates + proteins)"
_CONSTRAINTS = [
    _step("c1", "products", {c: f"CASE WHEN {c} < 0 THEN 0e0 ELSE {c} END" for c in _NUTRIENTS}),
    _step(
        "c2",
        "c1",
        {"proteins": "CASE WHEN proteins = 0 AND grp = 'meat' THEN 10e0 WHEN proteins = 0 AND grp = 'dairy' THEN 3e0 WHEN proteins = 0 AND grp IN ('fruits and vegetables', 'cereals', 'fish') THEN 0.5e0 ELSE proteins END"},
    ),
    _step(
        "c3",
        "c2",
        {
            "energy": "CASE WHEN energy = 0 THEN 1e0 ELSE energy END",
            "carbohydrates": "CASE WHEN carbohydrates = 0 THEN 0.1e0 ELSE carbohydrates END",
            "proteins": "CASE WHEN proteins = 0 AND coalesce(grp <> 'beverages', true) THEN 0.1e0 ELSE proteins END",
            "fat": "CASE WHEN fat = 0 AND coalesce(grp <> 'beverages', true) THEN 0.01e0 ELSE fat END",
        },
    ),
    _step("c4", "c3", {"salt": "coalesce(salt, sodium * 2.5e0)", "sodium": "coalesce(sodium, salt / 2.5e0)"}),
    _step(
        "c5",
        "c4",
        {"salt": "CASE WHEN sodium = 0 AND salt > 0 THEN sodium * 2.5e0 WHEN sodium <> 0 AND (salt / sodium < 2.4e0 OR salt / sodium > 2.6e0) THEN sodium * 2.5e0 ELSE salt END"},
    ),
    _step(
        "c6",
        "c5",
        {
            "saturated_fat": "CASE WHEN saturated_fat > fat THEN fat * 0.8e0 WHEN fat > 0.5 AND saturated_fat = 0 AND grp IS NOT NULL THEN fat * CASE WHEN grp = 'dairy' THEN 0.6e0 WHEN grp IN ('meat', 'fish') THEN 0.3e0 ELSE 0.2e0 END ELSE saturated_fat END",
            "sugars": "CASE WHEN sugars > carbohydrates THEN carbohydrates * 0.9e0 WHEN carbohydrates > 0.5 AND sugars = 0 AND grp IS NOT NULL THEN carbohydrates * CASE grp WHEN 'fruits and vegetables' THEN 0.7e0 WHEN 'beverages' THEN 0.8e0 WHEN 'cereals' THEN 0.1e0 ELSE 0.2e0 END ELSE sugars END",
        },
    ),
    _step(
        "c7",
        "c6",
        {"fr_score": "round_even(fr_score, 0)", "uk_score": "round_even(uk_score, 0)", **{c: f"CASE WHEN {c} > {_CAPS[c]} THEN {_CAPS[c]}e0 ELSE {c} END" for c in _NUTRIENTS}},
    ),
    _step("c8", "c7", {c: f"CASE WHEN {_SUM} > 105 THEN {c} * (100e0 / {_SUM}) ELSE {c} END" for c in ("fat", "carbohydrates", "proteins")}),
    _step(
        "c9",
        "c8",
        {"energy": f"CASE WHEN energy IS NULL THEN {_THEORY} WHEN energy > 0 AND {_THEORY} > 0 AND abs(energy - {_THEORY}) / nullif({_THEORY}, 0) > 0.2e0 THEN (energy + {_THEORY}) / 2 ELSE energy END"},
    ),
]
_add("constraints", "products", "SELECT " + _final() + " FROM c9", *_CONSTRAINTS)
_add(
    "missing_shares",
    "products",
    _union(
        f"SELECT '{c}' AS \"column\", {_r(f'(count(*) - count({c})) / count(*)')} AS missing_share, '{tag}' AS frame FROM {source}"
        for tag, source in (("before", "products"), ("after", "c9"))
        for c in _PRODUCT_NAMES
    ),
    *_CONSTRAINTS,
)
_SALT_OFF = "CASE WHEN sodium = 0 THEN salt <> 0 ELSE abs((salt - sodium * 2.5e0) / (sodium * 2.5e0) * 100) > 10 END"
_ENERGY_OFF = f"CASE WHEN {_THEORY} = 0 THEN energy <> 0 ELSE abs((energy - {_THEORY}) / nullif({_THEORY}, 0) * 100) > 20 END"
_add(
    "sodium_salt_fixed",
    "products",
    f"SELECT code, {_r('sodium')} AS sodium, {_r(f'CASE WHEN sodium IS NOT NULL AND salt IS NOT NULL AND {_SALT_OFF} THEN sodium * 2.5e0 ELSE salt END')} AS salt FROM products",
)


def _solve(c: str, rest: str, per_gram: str, cap: int) -> str:
    x = f"((energy - ({rest})) / {per_gram})"
    return _r(f"CASE WHEN {c} IS NULL THEN CASE WHEN {x} < 0 THEN 0e0 WHEN {x} > {cap} THEN {cap}e0 ELSE {x} END ELSE {c} END") + f" AS {c}"


_add(
    "energy_macros_fixed",
    "products",
    f"SELECT code, {_r(f'CASE WHEN {_ENERGY_OFF} THEN CASE WHEN {_THEORY} > 950 THEN 950e0 ELSE {_THEORY} END ELSE energy END')} AS energy, "
    + ", ".join(
        [
            _solve("fat", "proteins * 4 + carbohydrates * 4", "9e0", 95),
            _solve("carbohydrates", "proteins * 4 + fat * 9", "4e0", 95),
            _solve("proteins", "carbohydrates * 4 + fat * 9", "4e0", 90),
        ]
    )
    + " FROM products",
)
_SALT_SEEN = "sodium IS NOT NULL AND salt IS NOT NULL"
_ENERGY_SEEN = "energy IS NOT NULL AND proteins IS NOT NULL AND carbohydrates IS NOT NULL AND fat IS NOT NULL"


def _relation(name: str, seen: str, off: str, solved: bool) -> str:
    macros = ("proteins", "carbohydrates", "fat")
    extra = ", ".join(
        (f"count_if(energy IS NOT NULL AND {m} IS NULL AND " + " AND ".join(f"{o} IS NOT NULL" for o in macros if o != m) + ")" if solved else "CAST(NULL AS BIGINT)") + f" AS {m}_solved"
        for m in macros
    )
    bad = f"count_if({seen} AND {off})"
    return f"SELECT '{name}' AS relation, count_if({seen}) AS checked, count_if({seen}) - {bad} AS consistent, {bad} AS inconsistent, {_r(f'100e0 - {bad} * 100e0 / count_if({seen})')} AS consistent_pct, {extra} FROM products"


_add("relation_summary", "products", _relation("sodium-salt", _SALT_SEEN, _SALT_OFF, False) + " UNION ALL " + _relation("energy-macronutrients", _ENERGY_SEEN, _ENERGY_OFF, True))
ORACLES["relation_counters"] = ORACLES["stream_relation_counters"] = ORACLES["relation_summary"]
_add(
    "integrity_counters",
    "products",
    _union(
        [f"SELECT '{c} > {_MAXIMA[c]}' AS rule, count_if({c} > {_MAXIMA[c]}) AS n FROM products" for c in _NUTRIENTS]
        + [f"SELECT '{a} > {b}' AS rule, count_if({a} > {b}) AS n FROM l" for a, b in (("saturated_fat", "fat"), ("sodium", "salt"))]
    ),
    _LIMITED,
)
_LINES = {"a": (1.0, 0.0), "b": (0.9998, -0.0048), "c": (1.0946, -0.7569), "d": (1.1226, -1.6237), "e": (1.3735, -8.6686)}
_add(
    "scores_aligned",
    "products",
    """SELECT code, grade, CAST(round_even(CASE WHEN fr_score IS NULL THEN fitted WHEN abs(uk_score - (fr_score * s + i)) > 0.5 AND abs(fr_score - fitted) > 0.1 THEN fitted ELSE fr_score END, 0) AS BIGINT) AS fr_score
 FROM (SELECT p.*, s, i, (uk_score - i) / s AS fitted FROM products p LEFT JOIN g USING (grade)) x""",
    "g(grade, s, i) AS (VALUES " + ", ".join(f"('{g}', {s}e0, {i}e0)" for g, (s, i) in _LINES.items()) + ")",
)

# --- label consolidation ------------------------------------------------------------------------

_CLEAN = r"trim(lower(regexp_replace(label, '\W', ' ', 'g')))"
_add(
    "merge_spellings",
    "type_spellings",
    f"""SELECT label, n, first_value(label) OVER (PARTITION BY k ORDER BY n DESC, label) AS standard, CAST(sum(n) OVER (PARTITION BY k) AS BIGINT) AS total
 FROM (SELECT label, {_CLEAN} AS k, count(*) AS n FROM type_spellings WHERE label IS NOT NULL AND label <> 'unknown' GROUP BY 1, 2) c""",
)
_add(
    "rare_label_mapping",
    "swapped_names",
    "SELECT label, CASE WHEN n >= 10 THEN label ELSE coalesce((SELECT m.label FROM c m WHERE m.n >= 10 AND m.k = c.k ORDER BY m.n DESC, m.label LIMIT 1), 'Other') END AS target FROM c",
    f"c AS (SELECT label, {_TOKENS.format('label')} AS k, count(*) AS n FROM swapped_names WHERE label IS NOT NULL AND label <> 'unknown' GROUP BY 1, 2)",
)
_add(
    "group_combinations",
    "orders_m",
    f"""SELECT concat(coalesce(o_orderpriority, 'nan'), ' ') AS "group", o_orderstatus, o_orderpriority, frequency, {_r('frequency * 100e0 / sum(frequency) OVER ()')} AS percentage,
 CAST(sum(frequency) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS total_frequency, {_r('sum(frequency) OVER (PARTITION BY o_orderpriority) * 100e0 / sum(frequency) OVER ()')} AS total_percentage FROM c""",
    f"c AS ({_COMBINATIONS})",
)
_add(
    "canonical_combinations",
    "part_m",
    """SELECT first_value(p_brand) OVER w AS p_brand, first_value(p_type) OVER w AS p_type, frequency, "group", concat_ws('/', p_brand, p_type) AS member FROM
 (SELECT p_brand, p_type, count(*) AS frequency, p_brand AS "group" FROM part_m GROUP BY 1, 2) c
 WINDOW w AS (PARTITION BY "group" ORDER BY frequency DESC, p_brand NULLS FIRST, p_type NULLS FIRST)""",
)
_add(
    "commonest_parents",
    "customer_geo",
    "SELECT n_name AS label, coalesce(mode, 'Other') AS parent FROM (SELECT DISTINCT n_name FROM customer_geo WHERE n_name IS NOT NULL) c LEFT JOIN m USING (n_name)",
    f"m AS ({_mode('(SELECT * FROM customer_geo WHERE n_name IS NOT NULL)', 'r_name', 'n_name')})",
)

# --- imputers -----------------------------------------------------------------------------------


def _median(c: str, source: str = "products") -> str:
    return f"(SELECT median({c}) FROM {source})"


def _top(c: str, source: str = "products") -> str:
    return f"(SELECT mode FROM ({_mode(source, c)}) z)"


_add(
    "constant_fill",
    "products",
    "SELECT code, " + ", ".join(_r(f"coalesce({c}, {_median(c)})") + f" AS {c}" for c in ("energy", "fat", "salt")) + f", coalesce(grp, {_top('grp')}) AS grp, coalesce(grade, {_top('grade')}) AS grade FROM products",
)
_add("mean_fill", "products", "SELECT code, " + ", ".join(_r(f"coalesce({c}, (SELECT avg({c}) FROM products))") + f" AS {c}" for c in ("energy", "fat")) + " FROM products")
_add("staged_fill_zero", "products", "SELECT code, " + ", ".join(_r(f"coalesce({c}, 0e0)") + f" AS {c}" for c in _FEATURES) + " FROM products")
_add(
    "method_median",
    "part_n",
    "SELECT p_partkey, " + ", ".join(_r(f"coalesce({c}, {_median(c, 'part_n')})") + f" AS {c}" for c in ("size", "price", "weight")) + " FROM part_n",
)
_add(
    "knn_labels",
    "part_m",
    "SELECT p_partkey, coalesce(p_type, v) AS p_type FROM part_m LEFT JOIN best USING (p_partkey)",
    "f AS (SELECT median(CAST(p_size AS DOUBLE)) AS f1, median(p_retailprice) AS f2 FROM part_m WHERE p_type IS NOT NULL)",
    "x AS (SELECT p_partkey, p_type, coalesce(CAST(p_size AS DOUBLE), f1) AS a, coalesce(p_retailprice, f2) AS b FROM part_m, f)",
    f"s AS (SELECT {_sig('avg(a)')} AS ma, {_sig('stddev_pop(a)')} AS sa, {_sig('avg(b)')} AS mb, {_sig('stddev_pop(b)')} AS sb FROM x WHERE p_type IS NOT NULL)",
    "z AS (SELECT p_partkey, p_type, (a - ma) / sa AS a, (b - mb) / sb AS b FROM x, s)",
    f"""k AS (SELECT q.p_partkey, d.p_type, row_number() OVER (PARTITION BY q.p_partkey ORDER BY {_sig('(q.a - d.a) * (q.a - d.a) + (q.b - d.b) * (q.b - d.b)')}, d.p_partkey) AS r
 FROM z q JOIN z d ON q.p_type IS NULL AND d.p_type IS NOT NULL)""",
    "best AS (SELECT p_partkey, p_type AS v FROM (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_partkey ORDER BY count(*) DESC, p_type) AS o FROM k WHERE r <= 5 GROUP BY 1, 2) t WHERE o = 1)",
)
_SHARED = "(1 + CAST(q.price IS NOT NULL AND d.price IS NOT NULL AS INTEGER) + CAST(q.weight IS NOT NULL AND d.weight IS NOT NULL AS INTEGER))"
_NAN_DISTANCE = _sig(f"((q.size - d.size) * (q.size - d.size) + coalesce((q.price - d.price) * (q.price - d.price), 0) + coalesce((q.weight - d.weight) * (q.weight - d.weight), 0)) * (3e0 / {_SHARED})")


def _knn_target(t: str) -> str:
    return f"""n_{t} AS (SELECT p_partkey, avg(v) AS v FROM (SELECT q.p_partkey, d.{t} AS v, row_number() OVER (PARTITION BY q.p_partkey ORDER BY {_NAN_DISTANCE}, d.p_partkey) AS r
 FROM part_n q JOIN part_n d ON q.{t} IS NULL AND d.{t} IS NOT NULL) z WHERE r <= 5 GROUP BY 1)"""


_add(
    "knn_numbers",
    "part_n",
    f"SELECT p.p_partkey, {_r('size', 4)} AS size, {_r('coalesce(price, a.v)', 4)} AS price, {_r('coalesce(weight, b.v)', 4)} AS weight FROM part_n p LEFT JOIN n_price a ON p.p_partkey = a.p_partkey LEFT JOIN n_weight b ON p.p_partkey = b.p_partkey",
    _knn_target("price"),
    _knn_target("weight"),
)


def _weighted_target(t: str) -> str:
    distance = "(((q.size - sc.m1) / sc.s1 - (d.size - sc.m1) / sc.s1) ** 2 + coalesce(((q.price - sc.m2) / sc.s2 - (d.price - sc.m2) / sc.s2) ** 2, 0) + coalesce(((q.weight - sc.m3) / sc.s3 - (d.weight - sc.m3) / sc.s3) ** 2, 0)) * (3e0 / " + _SHARED + ")"
    return f"""w_{t} AS (SELECT p_partkey, CASE WHEN count_if(e = 0) > 0 THEN avg(v) FILTER (e = 0) ELSE sum(v / sqrt(e)) / sum(1 / sqrt(e)) END AS v FROM
 (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY {_sig('e')}, donor) AS r FROM (SELECT q.p_partkey, d.p_partkey AS donor, d.{t} AS v, {distance} AS e
 FROM part_n q JOIN part_n d ON q.{t} IS NULL AND d.{t} IS NOT NULL CROSS JOIN sc) y) z WHERE r <= 5 GROUP BY 1)"""


_add(
    "staged_fill",
    "part_n",
    f"SELECT p.p_partkey, {_r('size', 4)} AS size, {_r('coalesce(price, a.v)', 4)} AS price, {_r('coalesce(weight, b.v)', 4)} AS weight FROM part_n p LEFT JOIN w_price a ON p.p_partkey = a.p_partkey LEFT JOIN w_weight b ON p.p_partkey = b.p_partkey",
    "sc AS (SELECT " + ", ".join(f"median({c}) AS m{i}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS s{i}" for i, c in enumerate(("size", "price", "weight"), 1)) + " FROM part_n)",
    _weighted_target("price"),
    _weighted_target("weight"),
)
_add(
    "fitted_values_only",
    "part_m",
    f"""SELECT p_partkey, CASE WHEN t IS NULL OR t IN (SELECT p_type FROM f WHERE p_type IS NOT NULL) THEN t ELSE {_top('p_type', 'f')} END AS p_type
 FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'STRANGE' ELSE p_type END AS t FROM part_m) x""",
    "f AS (SELECT * FROM part_m WHERE p_partkey % 3 = 0)",
)
_add(
    "hierarchy_fill",
    "customer_geo",
    f"""SELECT c_custkey, coalesce(x.r_name, p.mode) AS r_name, x.n_name, {_r('c_acctbal', 2)} AS c_acctbal FROM
 (SELECT c_custkey, g.r_name, coalesce(g.n_name, c.mode) AS n_name, c_acctbal FROM customer_geo g LEFT JOIN c ON g.r_name = c.r_name) x LEFT JOIN p ON x.n_name = p.n_name""",
    "k AS (SELECT * FROM customer_geo WHERE r_name IS NOT NULL AND n_name IS NOT NULL)",
    f"c AS ({_mode('k', 'n_name', 'r_name')})",
    f"p AS ({_mode('k', 'r_name', 'n_name')})",
)
_add(
    "chained_line_fill",
    "part_m",
    f"""SELECT p_partkey, CAST(p_partkey AS DOUBLE) AS x, {_r('coalesce(p_retailprice, i + s * p_partkey)', 4)} AS p_retailprice FROM part_m,
 (SELECT regr_intercept(p_retailprice, CAST(p_partkey AS DOUBLE)) AS i, regr_slope(p_retailprice, CAST(p_partkey AS DOUBLE)) AS s FROM part_m) f""",
)
_add(
    "chained_step_fill",
    "part_steps",
    "SELECT p_partkey, tier, size, CAST(coalesce(step, CASE p_partkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 70 WHEN 2 THEN 20 ELSE 45 END) AS DOUBLE) AS step FROM part_steps",
)
_add(
    "score_grade_fill",
    "products",
    f"SELECT code, {_r('f')} AS fr_score, coalesce(grade, {_grade_of('f')}) AS grade, {_r('uk_score')} AS uk_score FROM (SELECT *, coalesce(fr_score, {_median('fr_score')}) AS f FROM products) x",
)
_add(
    "stratified_median_fill",
    "products",
    "SELECT code, "
    + ", ".join(_r(f"coalesce({c}, g.m_{c}, {_median(c)})") + f" AS {c}" for c in ("energy", "fat"))
    + " FROM products LEFT JOIN g USING (grp)",
    "g AS (SELECT grp, median(energy) AS m_energy, median(fat) AS m_fat FROM products WHERE grp IS NOT NULL GROUP BY 1 HAVING count(*) > 20)",
)
_add(
    "stratified_mode_fill",
    "part_m",
    f"SELECT p_partkey, coalesce(p_type, m.mode, {_top('p_type', 'part_m')}) AS p_type FROM part_m LEFT JOIN (SELECT * FROM g WHERE p_size IN (SELECT p_size FROM part_m GROUP BY 1 HAVING count(*) > 30)) m USING (p_size)",
    f"g AS ({_mode('part_m', 'p_type', 'p_size')})",
)


def _cells(source: str, columns: str, floor: str) -> str:
    return _union(
        f"SELECT code, '{c}' AS \"column\", {_r(f'least(0.95e0, greatest({floor}, (SELECT count({c}) / count(*) FROM {source})))')} AS confidence, 'fill' AS stage FROM {source} WHERE {c} IS NULL"
        for c in columns.split()
    )


_add("confidence_cells", "products", _cells("products", "energy salt grp", "0.5e0"))
_add(
    "confidence_report",
    "products",
    f"""SELECT "column", count(*) AS imputed, {_r('avg(confidence)')} AS mean_confidence, {_r('count_if(confidence >= 0.8) * 100e0 / count(*)')} AS high_pct,
 {_r('count_if(confidence < 0.5) * 100e0 / count(*)')} AS low_pct FROM t GROUP BY 1""",
    "h AS (SELECT * FROM products WHERE code % 2 = 0)",
    f"t AS ({_cells('products', 'energy salt', '0.8e0')} UNION ALL {_cells('h', 'grade salt', '0.2e0')})",
)
_HIDE = "code * 7 % 10 < 2"


def _quality(c: str) -> str:
    rest = f"(SELECT median({c}) FROM products WHERE NOT ({_HIDE}))"
    d = f"({rest} - {c})"
    return f"""SELECT '{c}' AS "column", 'number' AS kind, count(*) AS hidden, {_r(f'sqrt(avg({d} * {d}))', 4)} AS rmse, {_r(f'avg(abs({d}))', 4)} AS mae,
 {_r(f'avg(abs({d} / nullif({c}, 0))) * 100', 4)} AS mape, CAST(NULL AS DOUBLE) AS accuracy FROM products WHERE {_HIDE} AND {c} IS NOT NULL"""


_add(
    "imputation_quality",
    "products",
    _quality("energy")
    + " UNION ALL "
    + _quality("sugars")
    + f""" UNION ALL SELECT 'grp' AS "column", 'text' AS kind, count(*) AS hidden, CAST(NULL AS DOUBLE) AS rmse, CAST(NULL AS DOUBLE) AS mae, CAST(NULL AS DOUBLE) AS mape,
 {_r(f"avg(CAST(grp = {_top('grp', '(SELECT * FROM products WHERE NOT (' + _HIDE + '))')} AS DOUBLE))", 4)} AS accuracy FROM products WHERE {_HIDE} AND grp IS NOT NULL""",
)

_GAPS = _union(
    f"SELECT '{m}' AS method, '{c}' AS \"column\", count(*) - count({c}) AS filled, CAST(0 AS BIGINT) AS \"left\", CAST(0 AS BIGINT) AS changed FROM products"
    for m in ("kmeans", "random_forest", "iterative_imputer")
    for c in _MACROS
)
_add("fill_guarantees", "products", _GAPS)
_add(
    "full_imputation_gaps",
    "products",
    _union(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS noted, CAST(0 AS BIGINT) AS \"left\" FROM products" for c in _PRODUCT_NAMES),
)


_TESTED = [c for c in _PRODUCT_NAMES if c != "code"]
_add(
    "run_quality",
    "products",
    _union(
        f"SELECT '{c}' AS \"column\", '{'text' if c in ('grp', 'grade') else 'number'}' AS kind, count({c}) AS hidden, TRUE AS measured FROM products WHERE code % {len(_TESTED)} = {i}"
        for i, c in enumerate(_TESTED)
    ),
)


def _label_pass(out: str, source: str, focus: str) -> list[str]:
    """One pass of label votes among the rows in focus."""
    fills = ", ".join(f"median({c}) AS f_{c}" for c in ("size", "price", "weight"))
    spread = ", ".join(f"{_sig(f'avg({c})')} AS m_{c}, {_sig(f'stddev_pop({c})')} AS s_{c}" for c in ("size", "price", "weight"))
    distance = " + ".join(f"(q.{c} - d.{c}) * (q.{c} - d.{c})" for c in ("size", "price", "weight"))
    return [
        f"{out}_f AS (SELECT {fills} FROM {source} WHERE {focus} AND p_type IS NOT NULL)",
        f"{out}_x AS (SELECT p_partkey, p_type, " + ", ".join(f"coalesce({c}, f_{c}) AS {c}" for c in ("size", "price", "weight")) + f" FROM {source}, {out}_f WHERE {focus})",
        f"{out}_s AS (SELECT {spread} FROM {out}_x WHERE p_type IS NOT NULL)",
        f"{out}_z AS (SELECT p_partkey, p_type, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in ("size", "price", "weight")) + f" FROM {out}_x, {out}_s)",
        f"""{out}_k AS (SELECT q.p_partkey, d.p_type, row_number() OVER (PARTITION BY q.p_partkey ORDER BY {_sig(distance)}, d.p_partkey) AS r
 FROM {out}_z q JOIN {out}_z d ON q.p_type IS NULL AND d.p_type IS NOT NULL)""",
        f"{out}_b AS (SELECT p_partkey, p_type AS v FROM (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_partkey ORDER BY count(*) DESC, p_type) AS o FROM {out}_k WHERE r <= 5 GROUP BY 1, 2) t WHERE o = 1)",
        f"{out} AS (SELECT s.p_partkey, coalesce(s.p_type, b.v) AS p_type, size, price, weight, n FROM {source} s LEFT JOIN {out}_b b ON s.p_partkey = b.p_partkey)",
    ]


_COUNTED = "l0 AS (SELECT *, 1 + CAST(price IS NOT NULL AS INTEGER) + CAST(weight IS NOT NULL AS INTEGER) AS n FROM part_l)"


def _at_least(p: float) -> str:
    return f"n >= (SELECT quantile_cont(CAST(n AS DOUBLE), {p}) FROM l0)"


_add(
    "label_passes",
    "part_l",
    "SELECT p_partkey, p_type FROM l3",
    _COUNTED,
    *_label_pass("l1", "l0", _at_least(0.5)),
    *_label_pass("l2", "l1", _at_least(0.65)),
    *_label_pass("l3", "l2", "true"),
)
_add(
    "label_pass_confidence",
    "part_l",
    f"""SELECT p_partkey, 'p_type' AS "column", CASE WHEN {_at_least(0.5)} THEN 0.9e0 ELSE 0.3e0 END AS confidence, CASE WHEN {_at_least(0.5)} THEN 'labels-1' ELSE 'labels-last' END AS stage
 FROM l0 WHERE p_type IS NULL""",
    _COUNTED,
)

# --- clusters and models ------------------------------------------------------------------------

_TWO = f"t AS (SELECT abs(corr(coalesce(sodium, {_median('sodium')}), coalesce(salt, {_median('salt')}))) AS r FROM products)"
_add("projection_of_two", "products", f"SELECT CAST(1 AS BIGINT) AS component, {_r('(1 + r) / 2')} AS explained FROM t UNION ALL SELECT CAST(2 AS BIGINT), {_r('(1 - r) / 2')} FROM t", _TWO)
_add(
    "component_choice",
    "products",
    f"SELECT CAST(1 AS BIGINT) AS component, {_r('(1 + r) / 2')} AS explained, {_r('(1 + r) / 2')} AS cumulative FROM t UNION ALL SELECT CAST(2 AS BIGINT), {_r('(1 - r) / 2')}, 1e0 FROM t",
    _TWO,
)
_NEAR = "e AS (SELECT a.c_custkey AS a, b.c_custkey AS b FROM points a JOIN points b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 3600)"
_CORE = "core AS (SELECT a AS k FROM e GROUP BY 1 HAVING count(*) >= 3)"
_add("core_points", "points", "SELECT c_custkey, c_custkey IN (SELECT k FROM core) AS is_core FROM points", _NEAR, _CORE)
_add(
    "density_clusters",
    "points",
    """SELECT c_custkey, coalesce(CAST(n AS BIGINT), -1) AS cluster FROM points LEFT JOIN
 (SELECT e.a, min(l.n) AS n FROM e JOIN numbered l ON e.b = l.k WHERE e.a NOT IN (SELECT k FROM core) GROUP BY 1 UNION ALL SELECT k, n FROM numbered) c ON c_custkey = c.a""",
    _NEAR,
    _CORE,
    "links AS (SELECT a, b FROM e WHERE a IN (SELECT k FROM core) AND b IN (SELECT k FROM core))",
    "reach AS (SELECT k AS a, k AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)",
    "labelled AS (SELECT a AS k, min(b) AS label FROM reach GROUP BY 1)",
    "numbered AS (SELECT k, dense_rank() OVER (ORDER BY label) - 1 AS n FROM labelled)",
)
_PROFILED = ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
_add(
    "profile_clusters",
    "",
    """SELECT CAST(50 AS BIGINT) AS min_fill, CAST(3 AS BIGINT) AS eps, p."column", coalesce(CAST(n AS BIGINT), -1) AS cluster FROM pts p LEFT JOIN
 (SELECT k, dense_rank() OVER (ORDER BY label) - 1 AS n FROM (SELECT a AS k, min(b) AS label FROM reach GROUP BY 1) l) c ON p."column" = c.k""",
    "pts AS (" + _union(f"SELECT '{c}' AS \"column\", round(count({c}) * 100e0 / count(*), 2) AS x, round(count(DISTINCT {c}) * 100e0 / count({c}), 2) AS y FROM lineitem" for c in _PROFILED) + ")",
    'e AS (SELECT a."column" AS a, b."column" AS b FROM pts a JOIN pts b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 9)',
    # With two points as the least, every point with a neighbour is a core point.
    "core AS (SELECT a AS k FROM e GROUP BY 1 HAVING count(*) >= 2)",
    "reach AS (SELECT k AS a, k AS b FROM core UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)",
)
_add(
    "preprocessed_features",
    "part_m",
    f"""SELECT p_partkey, CAST(k.i AS INTEGER) AS position, CAST(x.t = k.t AS INTEGER) + 0e0 AS value FROM x CROSS JOIN k
 UNION ALL SELECT p_partkey, CAST((SELECT count(*) FROM k) AS INTEGER), {_r('(a - avg(a) OVER ()) / stddev_samp(a) OVER ()')} FROM x
 UNION ALL SELECT p_partkey, CAST((SELECT count(*) FROM k) + 1 AS INTEGER), {_r('(b - avg(b) OVER ()) / stddev_samp(b) OVER ()')} FROM x""",
    f"x AS (SELECT p_partkey, coalesce(p_type, {_top('p_type', 'part_m')}) AS t, CAST(p_size AS DOUBLE) AS a, coalesce(p_retailprice, {_median('p_retailprice', 'part_m')}) AS b FROM part_m)",
    "k AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS i FROM (SELECT DISTINCT t FROM x) y)",
)
_add(
    "detected_tasks",
    "part_m",
    _union(
        f"SELECT '{c}' AS \"column\", CASE WHEN {'count(*) >= 0' if t == 'string' else f'count(DISTINCT {c}) < 10'} THEN 'classification' ELSE 'regression' END AS task FROM d"
        for c, t in {**_PART_TYPES, "few": "bigint"}.items()
    ),
    "d AS (SELECT *, p_partkey % 4 AS few FROM part_m)",
)
_REPORT = [
    "k AS (SELECT label AS c FROM predicted UNION SELECT prediction FROM predicted)",
    "s AS (SELECT c, count_if(label = c) AS support, count_if(prediction = c) AS predicted, count_if(label = c AND prediction = c) AS hits FROM k, predicted GROUP BY 1)",
    "m AS (SELECT c, coalesce(hits / nullif(predicted, 0), 0e0) AS p, coalesce(hits / nullif(support, 0), 0e0) AS r, 2e0 * hits / (support + predicted) AS f, support, hits FROM s)",
]
_add(
    "class_report",
    "predicted",
    f"""SELECT c AS "class", {_r('p')} AS "precision", {_r('r')} AS recall, {_r('f')} AS f1, support FROM m
 UNION ALL SELECT 'Weighted Avg', {_r('sum(p * support) / sum(support)')}, {_r('sum(r * support) / sum(support)')}, {_r('sum(f * support) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM m
 UNION ALL SELECT 'Accuracy', {_r('sum(hits) / sum(support)')}, NULL, NULL, NULL FROM m""",
    *_REPORT,
)
_add("classification_metrics", "predicted", f"SELECT {_r('sum(hits) / sum(support)')} AS accuracy, {_r('sum(f * support) / sum(support)')} AS f1 FROM m", *_REPORT)
_add("confusion_counts", "predicted", "SELECT label, prediction, count(*) AS n FROM predicted GROUP BY 1, 2")
_ERR = "(value - guess)"
_add(
    "regression_metrics",
    "predicted",
    f"SELECT {_r(f'avg({_ERR} * {_ERR})')} AS mse, {_r(f'sqrt(avg({_ERR} * {_ERR}))')} AS rmse, {_r(f'avg(abs({_ERR}))')} AS mae, {_r(f'1 - avg({_ERR} * {_ERR}) / var_pop(value)')} AS r2 FROM predicted",
)
_add(
    "encoded_labels",
    "products",
    "SELECT code, CAST(dense_rank() OVER (ORDER BY coalesce(grp, 'nan')) - 1 AS BIGINT) AS grp, CAST(dense_rank() OVER (ORDER BY coalesce(grade, 'nan')) - 1 AS BIGINT) AS grade FROM products",
)

# --- streams ------------------------------------------------------------------------------------

_add(
    "stream_cleaned",
    "",
    f"SELECT event_id, {_NORMAL.format('event_type')} AS event_type, {_r('CASE WHEN value < 1 THEN 1e0 WHEN value > 200 THEN 200e0 ELSE value END')} AS value FROM events",
)
_add("stream_imputed", "events_m", f"SELECT event_id, {_r('coalesce(value, (SELECT median(value) FROM events_m))')} AS value FROM events_m")
