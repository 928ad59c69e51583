"""Registered queries: every operator on the given tables, over all of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gapweave.functions import scalars as fn
from gapweave.functions.similarity import ratio
from gapweave.operators import density, impute, increments, joins, labels, models, neighbours, profile, rules, selection, stats, windows
from gapweave.plans import imputation
from gapweave.plans.views import PRODUCT_ROLES, table, view
from gapweave.session import scratch_path
from gapweave.sources import delimited, dictionary, tables
from gapweave.streaming import rowwise

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MACROS = ["energy", "fat", "carbohydrates", "sugars", "proteins"]
FEATURES = ["energy", "fat", "saturated_fat", "carbohydrates", "sugars", "proteins", "sodium", "salt"]
LIMITS = {"energy": 950.0, "fat": 95.0, "sugars": 80.0, "salt": 6.0}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rnd(c: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, counts as bigint, so that both engines agree to the digit."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(fn.quoted(name))
        if kind in ("double", "float"):
            c = rnd(c.cast("double"), digits)
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(name))
    return df.select(*out)


# --- sources and sinks --------------------------------------------------------------------------


@query
def scan_delimited(spark, sf):
    path = scratch_path(spark, "tsv")
    tables.write_table(view(spark, sf, "orders_m"), path, "csv", "\t")
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string, o_totalprice double"
    return rounded(delimited.scan(spark, path, "\t", spark.createDataFrame([], schema).schema))


@query
def scan_separator_fallback(spark, sf):
    path = scratch_path(spark, "csvs")
    tables.write_table(view(spark, sf, "orders_m").select("o_orderkey", "o_orderstatus", "o_orderpriority"), path, "csv", ",")
    frames = delimited.load_frames(spark, path)
    return windows.union_tagged(frames).drop("frame")


@query
def scan_grouped(spark, sf):
    path, orders = scratch_path(spark, "exports"), view(spark, sf, "orders_m")
    cut = orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    tables.write_table(cut.where("o_orderkey % 3 = 0").repartition(5), f"{path}/a", "csv", ",")
    tables.write_table(cut.where("o_orderkey % 3 = 1").repartition(5), f"{path}/b", "csv", "\t")
    tables.write_table(cut.where("o_orderkey % 3 = 2").select("o_orderkey", "o_orderpriority"), f"{path}/c", "csv", "\t")
    found = delimited.scan_groups(spark, delimited.list_files(spark, f"{path}/*"))
    parts = [df.select(F.lit(len(g.columns)).alias("width"), F.lit(g.separator == ",").alias("commas"), "*") for g, df in found.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return rounded(out)


@query
def scan_tolerant(spark, sf):
    e = table(spark, sf, "events")
    line = F.concat_ws(
        ",",
        F.col("event_id"),
        F.col("user_id"),
        F.when(F.col("event_id") % 70 != 3, F.col("event_type")),
        F.when(F.col("event_id") % 50 == 0, F.lit("extra")),
    )
    path = scratch_path(spark, "lines")
    e.select(line.alias("value")).write.text(path)
    good, bad = delimited.scan_tolerant(spark, path, ["event_id", "user_id", "event_type"], header=False)
    none = F.lit(None).cast("string")
    return good.withColumn("line", none).unionByName(bad.select(*[none.alias(c) for c in good.columns], "line"))


@query
def drop_empty_columns(spark, sf):
    df = view(spark, sf, "orders_m").withColumn("nothing", F.lit(None).cast("double"))
    return rounded(delimited.drop_null_columns(df))


@query
def load_cached(spark, sf):
    source, cache = scratch_path(spark, "source"), scratch_path(spark, "cache")
    tables.write_table(view(spark, sf, "orders_m"), source, "csv", "\t")
    load = lambda s, p: delimited.scan(s, p, "\t")
    tables.cached_load(spark, source, cache, load, by_content=True)
    again = tables.cached_load(spark, source, cache, load, by_content=True)
    return stats.combination_counts(again, ["o_orderstatus", "o_orderpriority"])


@query
def cast_by_suffix(spark, sf):
    e = view(spark, sf, "event_times")
    text = e.select(
        F.col("event_id").cast("string").alias("code"),
        F.when(F.col("event_id") % 9 == 5, "soon").otherwise(F.col("created_t").cast("string")).alias("created_t"),
        F.col("created_datetime"),
        F.when(F.col("event_id") % 8 == 3, "n/a").otherwise(F.col("value").cast("string")).alias("value_100g"),
        F.when(F.col("event_id") % 4 == 1, "a, b ,c").otherwise("d").alias("kinds_tags"),
    )
    typed = dictionary.apply_suffix_types(text)
    return typed.select(
        "code", "created_t", F.col("created_datetime").cast("date").cast("string").alias("created_day"), rnd("value_100g").alias("value_100g"),
        F.array_join("kinds_tags", "|").alias("kinds"),
    )


@query
def nested_groups(spark, sf):
    fields = ["o_orderpriority", "o_orderstatus"]
    counted = stats.combination_counts(view(spark, sf, "orders_m"), fields)
    totals = counted.groupBy(F.coalesce("o_orderpriority", F.lit("nan")).alias("group")).agg(F.sum("frequency").alias("total_frequency"))
    grouped = counted.withColumn("group", F.coalesce("o_orderpriority", F.lit("nan"))).join(totals, "group")
    grouped = grouped.withColumns({"percentage": F.col("frequency") * 1.0, "score": F.lit(100), "total_percentage": F.col("total_frequency") * 1.0})
    path = scratch_path(spark, "groups")
    nested = labels.nest_groups(grouped, fields)
    tables.write_table(nested, path, "json")
    back = spark.read.schema(nested.schema).json(path).select("group", F.explode("combinations").alias("m"), "total_frequency")
    return back.select(
        "group", F.get("m.combination", F.lit(0)).alias("a"), F.get("m.combination", F.lit(1)).alias("b"), F.col("m.frequency").alias("frequency"), "total_frequency"
    )


@query
def write_formats(spark, sf):
    counted = stats.combination_counts(view(spark, sf, "orders_m"), ["o_orderstatus", "o_orderpriority"])
    frames = {}
    for kind in ("csv", "json", "parquet"):
        path = tables.write_table(counted, scratch_path(spark, kind), kind)
        reader = spark.read.schema(counted.schema)
        frames[kind] = reader.csv(path, header=True, escape='"') if kind == "csv" else (reader.json(path) if kind == "json" else reader.parquet(path))
    return windows.union_tagged(frames, "kind")


@query
def frame_summary(spark, sf):
    return rounded(profile.frame_summary(view(spark, sf, "orders_m"), "orders"))


@query
def version_compare(spark, sf):
    root = scratch_path(spark, "versions")
    old = view(spark, sf, "part_m").select("p_partkey", "p_name", "p_brand")
    new = old.where("p_partkey % 50 <> 3").withColumn("p_brand", F.when(F.col("p_partkey") % 20 == 1, "Brand#0").otherwise(F.col("p_brand")))
    tables.save_and_compare(old, root, "2024-01-01")
    return tables.save_and_compare(new, root, "2024-02-01")


# --- projections, filters, samples --------------------------------------------------------------


@query
def select_by_kind(spark, sf):
    df = view(spark, sf, "orders_m")
    return rounded(selection.ColumnSelector(selection.columns_of_kind(df, "number", ["o_custkey"])).transform(df))


@query
def keep_filled_columns(spark, sf):
    return selection.keep_filled_columns(view(spark, sf, "events_m"), 85.0)


@query
def filter_rows(spark, sf):
    df = selection.drop_null_rows(view(spark, sf, "orders_m"), ["o_orderstatus", "o_totalprice"])
    df = selection.keep_valid(df, "o_orderstatus", ["F", "O"])
    return rounded(selection.reshape_columns(df, {"o_totalprice": "price"}, ["o_custkey"]))


@query
def most_complete_rows(spark, sf):
    return selection.most_complete_rows(view(spark, sf, "products"), FEATURES, 65.0).select("code")


@query
def exact_sample(spark, sf):
    df = view(spark, sf, "orders_m")
    return selection.exact_sample(df, 500, ["o_orderkey"], F.col("o_orderkey") * 7919 % 10007).select("o_orderkey")


@query
def stable_split(spark, sf):
    df = view(spark, sf, "orders_m")
    train, test = selection.split(df, ["o_orderkey"], 80, F.col("o_orderkey") * 31 % 100)
    return windows.union_tagged({"train": train, "test": test}, "part").groupBy("part", "o_orderstatus").agg(F.count("*").alias("n"))


@query
def outlier_samples(spark, sf):
    df = view(spark, sf, "events_m")
    return rounded(selection.outlier_samples(df, ["value"], "event_id", order=F.col("event_id") * 7919 % 10007))


# --- scalar functions ---------------------------------------------------------------------------


@query
def label_functions(spark, sf):
    df = view(spark, sf, "part_labels")
    return df.select(
        "p_partkey",
        fn.normalize_label("label").alias("normal"),
        fn.token_sorted("label").alias("sorted_tokens"),
        fn.is_bad_null(F.when(F.col("p_partkey") % 10 == 3, "NULL").otherwise(F.col("parent"))).alias("bad_null"),
        fn.null_if("parent", "unknown").alias("parent"),
        fn.fill_null("parent", "none").alias("parent_filled"),
        F.size(fn.tags(F.concat("label", F.lit(", x,,y")))).cast("bigint").alias("n_tags"),
        fn.same_prefix("label", F.lit("red")).alias("is_red"),
    )


@query
def number_functions(spark, sf):
    p = view(spark, sf, "products")
    tiny = fn.zero_tiny_negatives(p.withColumn("fat", F.when(F.col("code") % 7 == 1, F.lit(-5e-6)).otherwise(F.col("fat"))))
    return tiny.select(
        "code",
        fn.to_number(F.when(F.col("code") % 5 == 1, "x").otherwise(F.col("energy").cast("string"))).alias("number"),
        fn.grade_to_number(F.upper("grade")).cast("bigint").alias("grade_number"),
        fn.number_to_grade(F.col("fr_score") / 2).alias("grade_of_half"),
        fn.score_to_grade("fr_score").alias("grade_of_score"),
        fn.round_half_even(F.col("fr_score") / 2).cast("bigint").alias("half_even"),
        fn.clip("energy", 100.0, 900.0).alias("clipped"),
        rnd("fat").alias("fat"),
        fn.change_label(F.col("energy") * 0.5, F.col("code") % 4 == 0).alias("change"),
    )


@query
def time_functions(spark, sf):
    e = view(spark, sf, "event_times")
    return e.select(
        "event_id",
        fn.unix_to_date("created_t").cast("string").alias("unix_day"),
        fn.iso_to_timestamp("created_datetime").cast("date").cast("string").alias("iso_day"),
    )


@query
def tuple_text(spark, sf):
    o = view(spark, sf, "order_labels")
    part = F.when(F.col("b").isNull(), "nan").otherwise(F.concat(F.lit("'"), "b", F.lit("'")))
    text = F.concat(F.lit("("), part, F.lit(", "), F.col("a").cast("double").cast("string"), F.lit(", nan)"))
    fields = fn.tuple_text_to_struct(text, {"b": "string", "a": "double", "c": "double"})
    return o.select("o_orderkey", fields.alias("t")).select("o_orderkey", "t.b", "t.a", F.col("t.c").alias("c"))


@query
def similarity_scores(spark, sf):
    pairs = view(spark, sf, "part_labels").join(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey").select("label", "p_name").distinct()
    return pairs.select("label", "p_name", ratio(F.col("label"), F.col("p_name")).alias("score"), ratio(fn.token_sorted("label"), fn.token_sorted("p_name")).alias("token_score"))


# --- joins --------------------------------------------------------------------------------------


@query
def map_labels(spark, sf):
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    nation = joins.lookup_join(table(spark, sf, "nation"), region, ["n_regionkey"])
    return joins.map_values(view(spark, sf, "customer_geo").select("c_custkey", "n_name"), "n_name", nation.select("n_name", "r_name"), "n_name", "r_name", "region")


@query
def write_back_cells(spark, sf):
    df = view(spark, sf, "orders_m")
    updates = df.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.lit(1.5).alias("o_totalprice"))
    return rounded(joins.write_back(df, updates, ["o_orderkey"], ["o_orderstatus", "o_totalprice"]))


@query
def member_filter(spark, sf):
    df = view(spark, sf, "part_m")
    valid = table(spark, sf, "part").where("p_size < 10")
    kept = joins.keep_members(df, "p_brand", valid.where("p_retailprice < 950"), "p_brand")
    return joins.keep_members(kept, "p_partkey", valid, "p_partkey", negate=True).select("p_partkey", "p_brand")


@query
def nearest_vectors(spark, sf):
    """The five nearest other vectors of every vector."""
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    donors = e.select(F.col("vec_id").alias("key"), "vec", F.array(F.col("vec_id").cast("string")).alias("values"))
    # One more than asked for: a vector is its own nearest.
    hits = neighbours.nearest(e.select("vec", F.array(F.lit(0)).alias("wanted")), donors, 6)
    back = joins.lookup_join(e, hits.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("rank", "donor", "distance"))).alias("near")), ["vec"])
    others = F.slice(F.filter("near", lambda x: x.donor != F.col("vec_id")), 1, 5)
    placed = back.select("vec_id", F.posexplode(others).alias("at", "x"))
    return placed.select("vec_id", (F.col("at") + 1).cast("bigint").alias("rank"), F.col("x.donor").alias("donor"), rnd("x.distance").alias("distance"))


@query
def nearest_small_scale(spark, sf):
    """The nearest other customer by a feature of the order of 1e-6."""
    e = table(spark, sf, "customer").select("c_custkey", F.array(F.col("c_acctbal") * 1e-9).alias("vec"))
    donors = e.select(F.col("c_custkey").alias("key"), "vec", F.array(F.col("c_custkey").cast("string")).alias("values"))
    hits = neighbours.nearest(e.select("vec", F.array(F.lit(0)).alias("wanted")), donors, 2)
    back = joins.lookup_join(e, hits.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct("rank", "donor"))).alias("near")), ["vec"])
    return back.select("c_custkey", F.get(F.filter("near", lambda x: x.donor != F.col("c_custkey")), F.lit(0)).donor.alias("donor"))


@query
def fuzzy_best_match(spark, sf):
    keys = view(spark, sf, "part_labels").select(F.col("label").alias("key")).distinct().withColumn("text", fn.clean_text("key"))
    choices = table(spark, sf, "part").groupBy(F.col("p_name").alias("choice")).agg(F.count("*").alias("n")).withColumn("text", fn.clean_text("choice"))
    return labels.best_match(keys, choices, 85)


@query
def fuzzy_all_matches(spark, sf):
    keys = view(spark, sf, "part_labels").select(F.col("label").alias("key")).distinct().withColumn("text", fn.clean_text("key"))
    choices = table(spark, sf, "part").groupBy(F.col("p_name").alias("choice")).agg(F.count("*").alias("n")).withColumn("text", fn.clean_text("choice"))
    return labels.all_matches(keys, choices, 85)


# --- profiles and aggregations ------------------------------------------------------------------


@query
def column_profile(spark, sf):
    return rounded(profile.column_profile(view(spark, sf, "part_m"), "part"))


@query
def column_profile_sketched(spark, sf):
    return rounded(profile.column_profile(table(spark, sf, "lineitem"), "lineitem", exact=False)).drop("distinct", "unique_pct", "most_common", "most_common_count")


@query
def incremental_profile(spark, sf):
    lines, root = table(spark, sf, "lineitem"), scratch_path(spark, "states")
    for i in range(3):
        increments.add_version(lines.where(F.pmod("l_orderkey", F.lit(3)) == i), root, str(i))
    merged = increments.stored_profile(spark, root)
    exact = profile.column_profile(lines, "lineitem").select("column", F.col("distinct").alias("n"))
    within = (F.abs(F.col("distinct") - F.col("n")) <= 0.05 * F.col("n")).alias("distinct_within")
    few = F.col("column").isin("l_returnflag", "l_linestatus", "l_linenumber", "l_discount", "l_tax")  # the sketch is exact there
    return rounded(merged.join(exact, "column").select(
        "column", "dtype", "non_null", "nulls", "fill_pct", "low", "high", within, F.when(few, F.col("most_common_count")).alias("most_common_count")
    ))


@query
def type_profile(spark, sf):
    df = view(spark, sf, "part_m").withColumn("mixed", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size").cast("string")).when(F.col("p_partkey") % 10 == 1, "NULL").otherwise(F.col("p_name")))
    return rounded(profile.type_profile(df))


@query
def dictionary_match(spark, sf):
    names = ["p_partkey", "p_name", "p_brand", "p_retailprice"]
    declared = spark.createDataFrame([(n, t) for n, t in zip(names, ["integer", "string", "strict", "double"])], "field string, type string")
    return profile.match_dictionary(profile.type_profile(view(spark, sf, "part_m"), parse_text=False), declared).select("column", "observed_type", "declared_type", "types_match")


@query
def column_categories(spark, sf):
    return profile.column_categories(profile.column_profile(view(spark, sf, "part_m"), "part"), 25.0)


@query
def missing_report(spark, sf):
    return rounded(profile.missing_report(view(spark, sf, "products")))


@query
def columns_by_missing(spark, sf):
    df = view(spark, sf, "products")
    rows = [(c, above) for above in (True, False) for c in selection.columns_by_missing(df, 0.1, above)]
    return spark.createDataFrame(rows, "column string, above boolean")


@query
def combination_counts(spark, sf):
    return stats.combination_counts(view(spark, sf, "orders_m"), ["o_orderstatus", "o_orderpriority"])


@query
def top_values(spark, sf):
    return stats.top_values(view(spark, sf, "part_m"), "p_brand", 10)


@query
def group_mode(spark, sf):
    return stats.mode_by(view(spark, sf, "part_m"), "p_brand", ["p_type"]).where(F.col("p_type").isNotNull())


@query
def describe_columns(spark, sf):
    return rounded(stats.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), 4)


@query
def iqr_summary(spark, sf):
    return rounded(stats.iqr_outliers(view(spark, sf, "events_m"), ["value"])[0])


@query
def iqr_capped(spark, sf):
    return rounded(stats.iqr_outliers(view(spark, sf, "events_m"), ["value"])[1])


@query
def limit_summary(spark, sf):
    return rounded(stats.limit_outliers(view(spark, sf, "products"), LIMITS)[0])


@query
def limit_cleaned(spark, sf):
    return rounded(stats.limit_outliers(view(spark, sf, "products"), LIMITS)[1].select("code", *LIMITS))


@query
def histogram(spark, sf):
    return rounded(stats.histogram(view(spark, sf, "products"), "energy"))


@query
def score_histogram(spark, sf):
    return rounded(stats.histogram(view(spark, sf, "products"), "fr_score", 60, -30.0, 30.0))


@query
def box_statistics(spark, sf):
    return rounded(stats.box_statistics(view(spark, sf, "products"), "grade", MACROS))


@query
def correlations(spark, sf):
    return rounded(stats.correlations(view(spark, sf, "products"), MACROS))


@query
def category_statistics(spark, sf):
    return rounded(stats.category_statistics(view(spark, sf, "products"), "grp", MACROS))


@query
def cross_counts(spark, sf):
    return stats.cross_counts(view(spark, sf, "part_labels"), "parent", "label", ["unknown"])


@query
def cross_table(spark, sf):
    return stats.cross_table(view(spark, sf, "products").where("grp is not null"), "grp", "grade", ["a", "b", "c", "d", "e"])


@query
def line_fit(spark, sf):
    return rounded(stats.score_line_fit(view(spark, sf, "products"), "grade", "fr_score", "uk_score", ["a", "b", "c", "d", "e"], 1.0))


@query
def weighted_line_fit(spark, sf):
    points = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_quantity", F.round(F.col("l_extendedprice"), -3).alias("price")).agg(F.count("*").alias("frequency"))
    return rounded(stats.weighted_line_fit(points, "l_returnflag", "l_quantity", "price", "frequency"))


@query
def missing_shares(spark, sf):
    before = view(spark, sf, "products")
    return rounded(stats.missing_shares(before, rules.apply_constraints(before, PRODUCT_ROLES)))


@query
def compare_statistics(spark, sf):
    before = view(spark, sf, "products").select("code", *MACROS)
    return rounded(stats.compare_statistics(before, impute.fill_constants(before, dict.fromkeys(MACROS, 50.0)), MACROS), 2)


@query
def group_growth(spark, sf):
    before = view(spark, sf, "orders_m")
    after = before.withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, "N").otherwise("F"))).where("o_orderpriority is null or o_orderpriority <> '5-LOW' or o_orderkey % 4 = 0")
    return rounded(stats.group_growth(before, after, ["o_orderstatus", "o_orderpriority"]))


@query
def distribution_comparison(spark, sf):
    before = view(spark, sf, "products")
    after = impute.fill_constants(before, {"energy": 600.0, "grp": "other"})
    return rounded(stats.distribution_comparison(before, after, ["grp"], ["energy", "sugars"]))


# --- windows, sets ------------------------------------------------------------------------------


@query
def frequent_combinations(spark, sf):
    return rounded(stats.frequent_combinations(view(spark, sf, "part_m"), ["p_brand", "p_type", "p_size"], 0.5))


@query
def group_mean_fill(spark, sf):
    return rounded(windows.fill_by_group_mean(view(spark, sf, "products"), "grp", ["energy", "fat"]).select("code", "grp", "energy", "fat"))


@query
def duplicate_flags(spark, sf):
    return windows.flag_duplicates(view(spark, sf, "part_m").select("p_partkey", "p_brand"), "p_brand", "p_partkey")


@query
def top_by_magnitude(spark, sf):
    totals = table(spark, sf, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.sum("c_acctbal").alias("balance")).withColumn("balance", rnd("balance", 2))
    return rounded(windows.top_by_magnitude(totals, "balance", 15))


@query
def version_diff(spark, sf):
    old = table(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    new = table(spark, sf, "customer").where("c_custkey % 10 < 7").select((F.col("c_nationkey") + F.when(F.col("c_custkey") % 100 == 1, 25).otherwise(0)).alias("c_nationkey"), "c_mktsegment")
    return rounded(windows.version_diff(old, new))


# --- rules --------------------------------------------------------------------------------------


@query
def integrity_checked(spark, sf):
    return rounded(rules.check_integrity(view(spark, sf, "products"), columns=PRODUCT_ROLES))


@query
def integrity_violations(spark, sf):
    return rounded(rules.integrity_violations(view(spark, sf, "products"), "code", columns=PRODUCT_ROLES))


@query
def grades_checked(spark, sf):
    return rounded(rules.check_grades(view(spark, sf, "products"), PRODUCT_ROLES).select("code", "grade", "fr_score", "uk_score"))


@query
def datetime_filled(spark, sf):
    out = rules.fill_datetime(view(spark, sf, "event_times"), "created_t", "created_datetime")
    return out.select("event_id", F.date_format("created_datetime", "yyyy-MM-dd HH:mm:ss").alias("created"))


@query
def datetime_discrepancies(spark, sf):
    out = rules.datetime_discrepancies(view(spark, sf, "event_times"), "event_id", "created_t", "created_datetime")
    return out.select("event_id", F.col("unix_date").cast("string").alias("unix_date"), F.col("datetime_date").cast("string").alias("datetime_date"))


@query
def constraints(spark, sf):
    return rounded(rules.apply_constraints(view(spark, sf, "products"), PRODUCT_ROLES))


@query
def sodium_salt_fixed(spark, sf):
    return rounded(rules.fix_sodium_salt(view(spark, sf, "products"), PRODUCT_ROLES).select("code", "sodium", "salt"))


@query
def energy_macros_fixed(spark, sf):
    return rounded(rules.fix_energy_macros(view(spark, sf, "products"), PRODUCT_ROLES).select("code", "energy", "fat", "carbohydrates", "proteins"))


@query
def relation_summary(spark, sf):
    return rounded(rules.validate_relations(view(spark, sf, "products"), PRODUCT_ROLES)[0])


@query
def relation_counters(spark, sf):
    fixed, seen = rules.observed_relations(view(spark, sf, "products"), PRODUCT_ROLES)
    tables.write_table(fixed, scratch_path(spark, "fixed"), "parquet")
    return rounded(rules.relation_rows(spark, seen.get))


@query
def integrity_counters(spark, sf):
    fixed, seen = rules.observed_integrity(view(spark, sf, "products"), columns=PRODUCT_ROLES)
    tables.write_table(fixed, scratch_path(spark, "limited"), "parquet")
    return rules.counter_rows(spark, seen.get)


@query
def scores_aligned(spark, sf):
    return rounded(rules.align_scores(view(spark, sf, "products"), PRODUCT_ROLES).select("code", "grade", "fr_score"))


# --- label consolidation ------------------------------------------------------------------------


@query
def merge_spellings(spark, sf):
    return labels.merge_similar(labels.label_counts(view(spark, sf, "type_spellings"), "label"))


@query
def merge_similar_names(spark, sf):
    return labels.merge_similar(labels.label_counts(view(spark, sf, "part_labels"), "label"))


@query
def rare_label_mapping(spark, sf):
    counts = labels.label_counts(view(spark, sf, "swapped_names"), "label")
    return labels.rare_label_mapping(counts, 10)


@query
def simplify_categories(spark, sf):
    return labels.simplify_categories(view(spark, sf, "part_labels"), "parent", "label", 30)[0]


@query
def group_combinations(spark, sf):
    groups = labels.group_combinations(view(spark, sf, "orders_m"), ["o_orderstatus", "o_orderpriority"])
    return rounded(groups.drop("score"))


@query
def group_similar_combinations(spark, sf):
    return labels.group_combinations(view(spark, sf, "order_labels"), ["a", "b", "c"])


@query
def canonical_combinations(spark, sf):
    counted = stats.combination_counts(view(spark, sf, "part_m"), ["p_brand", "p_type"])
    grouped = counted.withColumn("group", F.col("p_brand")).withColumn("member", F.concat_ws("/", "p_brand", "p_type"))
    return labels.canonical_combinations(grouped, ["p_brand", "p_type"])


@query
def commonest_parents(spark, sf):
    return labels.commonest_parent(view(spark, sf, "customer_geo"), "n_name", "r_name")


# --- imputers -----------------------------------------------------------------------------------


@query
def constant_fill(spark, sf):
    df = view(spark, sf, "products")
    df = impute.ConstantImputer(["energy", "fat", "salt"], "median").fit(df).transform(df)
    df = impute.ConstantImputer(["grp", "grade"], "mode").fit(df).transform(df)
    return rounded(df.select("code", "energy", "fat", "salt", "grp", "grade"))


@query
def mean_fill(spark, sf):
    df = view(spark, sf, "products")
    return rounded(impute.ConstantImputer(["energy", "fat"], "mean").fit(df).transform(df).select("code", "energy", "fat"))


@query
def staged_fill_zero(spark, sf):
    df = view(spark, sf, "products")
    return rounded(impute.MultiStageImputer(FEATURES, "code", strategy="zero").fit(df).transform(df).select("code", *FEATURES))


@query
def staged_fill(spark, sf):
    df = view(spark, sf, "part_n")
    return rounded(impute.MultiStageImputer(["size", "price", "weight"], "p_partkey").fit(df).transform(df), 4)


@query
def knn_labels(spark, sf):
    df = view(spark, sf, "part_m")
    return impute.KnnLabelImputer(["p_type"], "p_partkey", ["p_size", "p_retailprice"]).fit(df).transform(df).select("p_partkey", "p_type")


@query
def knn_numbers(spark, sf):
    df = view(spark, sf, "part_n")
    return rounded(impute.knn_fill(df, ["size", "price", "weight"], "p_partkey"), 4)


@query
def fitted_values_only(spark, sf):
    fitted = view(spark, sf, "part_m").where("p_partkey % 3 = 0")
    changed = view(spark, sf, "part_m").withColumn("p_type", F.when(F.col("p_partkey") % 10 == 0, "STRANGE").otherwise(F.col("p_type")))
    return impute.restrict_to_fitted(changed, fitted, ["p_type"]).select("p_partkey", "p_type")


@query
def hierarchy_fill(spark, sf):
    df = view(spark, sf, "customer_geo")
    return rounded(impute.HierarchyImputer([("r_name", "n_name")]).fit(df).transform(df), 2)


@query
def chained_line_fill(spark, sf):
    df = view(spark, sf, "part_m").select("p_partkey", F.col("p_partkey").cast("double").alias("x"), "p_retailprice")
    return rounded(impute.ChainedImputer(["x", "p_retailprice"], ridge=0.0).fit(df).transform(df), 4)


@query
def chained_step_fill(spark, sf):
    """Randomised trees fill a step function of one other column exactly."""
    return rounded(impute.ChainedImputer(["tier", "size", "step"], estimator="trees").fit(df := view(spark, sf, "part_steps")).transform(df), 4)


@query
def chained_fill(spark, sf):
    df = view(spark, sf, "products")
    return impute.ChainedImputer(FEATURES).fit(df).transform(df).select("code", *FEATURES)


@query
def cluster_mean_fill(spark, sf):
    df = view(spark, sf, "products")
    return impute.ClusterMeanImputer(MACROS).fit(df).transform(df).select("code", *MACROS)


@query
def forest_fill(spark, sf):
    df = view(spark, sf, "products")
    return impute.ForestImputer(MACROS).fit(df).transform(df).select("code", *MACROS)


@query
def score_grade_fill(spark, sf):
    df = view(spark, sf, "products")
    return rounded(impute.ScoreGradeImputer("fr_score", "grade").fit(df).transform(df).select("code", "fr_score", "grade", "uk_score"))


@query
def iterative_label_fill(spark, sf):
    return impute.iterative_labels(view(spark, sf, "products"), ["grp"], "code", MACROS)[0].select("code", "grp")


@query
def iterative_label_confidence(spark, sf):
    return impute.iterative_labels(view(spark, sf, "products"), ["grp"], "code", MACROS)[1]


@query
def label_passes(spark, sf):
    return impute.iterative_labels(view(spark, sf, "part_l"), ["p_type"], "p_partkey", ["size", "price", "weight"])[0].select("p_partkey", "p_type")


@query
def label_pass_confidence(spark, sf):
    return impute.iterative_labels(view(spark, sf, "part_l"), ["p_type"], "p_partkey", ["size", "price", "weight"])[1]


@query
def fill_guarantees(spark, sf):
    """Per method and column: cells filled, gaps left, observed cells changed."""
    df = view(spark, sf, "products").select("code", *MACROS)
    out = None
    for method, options in (("kmeans", {}), ("random_forest", {}), ("iterative_imputer", {})):
        done = impute.impute_numbers(df, method, MACROS, "code", **options).withColumnsRenamed({c: f"new_{c}" for c in MACROS})
        both = df.join(done, "code")
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("old"), F.col(f"new_{c}").alias("new")) for c in MACROS])
        part = both.select(F.explode(cells).alias("x")).groupBy(F.col("x.column").alias("column")).agg(
            F.count_if(F.col("x.old").isNull() & F.col("x.new").isNotNull()).alias("filled"),
            F.count_if(F.col("x.new").isNull()).alias("left"),
            F.count_if(F.abs(F.col("x.old") - F.col("x.new")) > 1e-9).alias("changed"),
        ).withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    return out


@query
def full_imputation_gaps(spark, sf):
    """Cells noted per column by the full run, and the gaps it leaves."""
    p = view(spark, sf, "products")
    run = imputation.ImputationRun("code", PRODUCT_ROLES, relations=True)
    done = run.fit_transform(p)
    noted = run.confidence.groupBy("column").agg(F.count("*").alias("noted"))
    left = done.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in p.columns]).unpivot([], p.columns, "column", "left")
    return left.join(noted, "column", "left").select("column", F.coalesce("noted", F.lit(0).cast("long")).alias("noted"), "left")


@query
def stratified_median_fill(spark, sf):
    df = view(spark, sf, "products")
    return rounded(impute.stratified_fill(df, "grp", ["energy", "fat"]).select("code", "energy", "fat"))


@query
def stratified_mode_fill(spark, sf):
    df = view(spark, sf, "part_m")
    return impute.stratified_fill(df, "p_size", ["p_type"], 30, "mode").select("p_partkey", "p_type")


@query
def confidence_cells(spark, sf):
    return rounded(impute.imputed_confidence(view(spark, sf, "products"), ["code"], ["energy", "salt", "grp"]))


@query
def confidence_report(spark, sf):
    p = view(spark, sf, "products")
    cells = impute.imputed_confidence(p, ["code"], ["energy", "salt"], 0.8).unionByName(impute.imputed_confidence(p.where("code % 2 = 0"), ["code"], ["grade", "salt"], 0.2))
    return rounded(stats.confidence_report(cells))


@query
def full_imputation(spark, sf):
    return imputation.ImputationRun("code", PRODUCT_ROLES, relations=True).fit_transform(view(spark, sf, "products"))


@query
def full_imputation_report(spark, sf):
    run = imputation.ImputationRun("code", PRODUCT_ROLES, relations=True)
    run.fit_transform(view(spark, sf, "products"))
    return run.report()


@query
def run_quality(spark, sf):
    """One run over all columns scores every one: cells hidden, and whether each column's error and hits are those of a filled column."""
    p = view(spark, sf, "products")
    tested = [c for c in p.columns if c != "code"]
    run = lambda x: imputation.ImputationRun("code", PRODUCT_ROLES).fit_transform(x)
    scores = imputation.imputation_quality(p, "code", run, mask=lambda c: F.col("code") % len(tested) == tested.index(c))
    measured = F.when(F.col("kind") == "number", F.col("rmse").isNotNull() & F.col("mae").isNotNull()).otherwise(F.col("accuracy").isNotNull())
    return scores.select("column", "kind", "hidden", measured.alias("measured"))


@query
def single_level_imputation(spark, sf):
    return imputation.single_level_run("code", PRODUCT_ROLES).fit_transform(view(spark, sf, "products"))


@query
def imputation_quality(spark, sf):
    """Scores of a constant fill, which SQL can follow."""
    df = view(spark, sf, "products").select("code", "energy", "sugars", "grp")

    def fill(x: DataFrame) -> DataFrame:
        x = impute.ConstantImputer(["energy", "sugars"]).fit(x).transform(x)
        return impute.ConstantImputer(["grp"], "mode").fit(x).transform(x)

    return rounded(imputation.imputation_quality(df, "code", fill, mask=lambda c: F.col("code") * 7 % 10 < 2), 4)


@query
def method_median(spark, sf):
    return rounded(impute.impute_numbers(view(spark, sf, "part_n"), "median", ["size", "price", "weight"], "p_partkey"))


# --- relations, clusters, models ----------------------------------------------------------------


@query
def feature_relations(spark, sf):
    return models.feature_relations(view(spark, sf, "products"), ["code"])


@query
def strata(spark, sf):
    return models.stratify(view(spark, sf, "products"), ["code"], FEATURES).select("code", "stratum")


@query
def projection_scores(spark, sf):
    return models.project(view(spark, sf, "products"), FEATURES, 3, ["code", "grade"]).scores


@query
def projection_of_two(spark, sf):
    p = models.project(view(spark, sf, "products"), ["sodium", "salt"], 2)
    return rounded(spark.createDataFrame([(i + 1, x) for i, x in enumerate(p.explained)], "component bigint, explained double"))


@query
def component_choice(spark, sf):
    return rounded(models.component_choice(view(spark, sf, "products"), ["sodium", "salt"])[0])


@query
def component_clusters(spark, sf):
    p = models.project(view(spark, sf, "products"), FEATURES, 3, ["code", "grade"])
    return models.cluster_components(p, 5, "grade")["by_label"]


@query
def projection_report(spark, sf):
    return models.projection_report(view(spark, sf, "products"), FEATURES, "grade", ["code"])["biplot"]


@query
def core_points(spark, sf):
    return density.core_points(view(spark, sf, "points"), "c_custkey", "x", "y", 60.0, 3)


@query
def density_clusters(spark, sf):
    return density.density_clusters(view(spark, sf, "points"), "c_custkey", "x", "y", 60.0, 3)


@query
def profile_clusters(spark, sf):
    p = profile.column_profile(table(spark, sf, "lineitem"), "lineitem", ["l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag"])
    return rounded(density.profile_clusters(p, eps_values=(3,), min_fills=(50,)))


@query
def preprocessed_features(spark, sf):
    df = view(spark, sf, "part_m").select("p_partkey", "p_type", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    out = Pipeline(stages=models.preprocessing(["p_size", "p_retailprice"], ["p_type"])).fit(df).transform(df)
    cells = out.select("p_partkey", F.posexplode(vector_to_array("features")).alias("position", "value"))
    return cells.select("p_partkey", "position", rnd(F.col("value")).alias("value"))


@query
def detected_tasks(spark, sf):
    df = view(spark, sf, "part_m").withColumn("few", F.col("p_partkey") % 4)
    return spark.createDataFrame(list(models.tasks_of(df, df.columns).items()), "column string, task string")


@query
def compared_models(spark, sf):
    df = view(spark, sf, "products")
    logistic, forest = LogisticRegression(maxIter=20), RandomForestClassifier(numTrees=100, maxDepth=5, seed=42)
    choices = {
        "LogisticRegression": (logistic, ParamGridBuilder().addGrid(logistic.regParam, [0.01, 0.1]).build()),
        "RandomForest": (forest, [{}]),
        "SVC": models.default_models("classification", df.count())["SVC"],
    }
    return models.compare_models(df, "grade", ["code"], MACROS, ["grp"], choices).results


@query
def compared_regressions(spark, sf):
    df = view(spark, sf, "products")
    full = models.default_models("regression", df.count())
    forest, boosted = models.RandomForestRegressor(numTrees=100, maxDepth=5, seed=42), models.GBTRegressor(maxIter=20, maxDepth=3, seed=42)
    choices = {"ElasticNet": full["ElasticNet"], "SVR": full["SVR"], "RandomForest": (forest, [{}]), "GradientBoosting": (boosted, [{}])}
    return models.compare_models(df, "energy", ["code"], FEATURES, ["grp", "grade"], choices).results


@query
def feature_importances(spark, sf):
    forest = RandomForestClassifier(numTrees=100, maxDepth=5, seed=42)
    found = models.compare_models(view(spark, sf, "products"), "grade", ["code"], MACROS, ["grp"], {"RandomForest": (forest, [{}])})
    return models.named_importances(found.models["RandomForest"], view(spark, sf, "products"), ["grp"], MACROS)


@query
def classification_metrics(spark, sf):
    return rounded(models.classification_metrics(view(spark, sf, "predicted"), "label", "prediction"))


@query
def regression_metrics(spark, sf):
    return rounded(models.regression_metrics(view(spark, sf, "predicted"), "value", "guess"))


@query
def confusion_counts(spark, sf):
    return models.confusion_counts(view(spark, sf, "predicted"), "label", "prediction")


@query
def class_report(spark, sf):
    return rounded(models.class_report(view(spark, sf, "predicted"), "label", "prediction"))


@query
def predicted_labels(spark, sf):
    return models.predict_labels(view(spark, sf, "products"), "grp", MACROS).select("code", "grp", "predicted")


@query
def encoded_labels(spark, sf):
    return rounded(models.encode_labels(view(spark, sf, "products").select("code", "grp", "grade"), ["grp", "grade"])[0])


# --- streams ------------------------------------------------------------------------------------


@query
def stream_cleaned(spark, sf):
    schema = table(spark, sf, "events").schema
    clean = lambda x: x.select("event_id", fn.normalize_label("event_type").alias("event_type"), fn.clip("value", 1.0, 200.0).alias("value"))
    return rounded(rowwise.drain(spark, f"{sf}/events*.parquet", schema, clean))


@query
def stream_relation_counters(spark, sf):
    rows = scratch_path(spark, "products")
    tables.write_table(view(spark, sf, "products").repartition(6), rows, "parquet")
    fix = lambda x: rules.observed_relations(x, PRODUCT_ROLES, "relations")[0]
    _, counts = rowwise.drain_counted(spark, rows, spark.read.parquet(rows).schema, fix, "relations", files_per_trigger=2)
    return rounded(rules.relation_rows(spark, counts))


@query
def stream_imputed(spark, sf):
    model = impute.ConstantImputer(["value"]).fit(view(spark, sf, "events_m"))
    schema = table(spark, sf, "events").schema
    gaps = lambda x: x.select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    return rounded(rowwise.drain(spark, f"{sf}/events*.parquet", schema, lambda x: model.transform(gaps(x))))
