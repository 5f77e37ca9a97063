"""Table algebra: projection, filters, joins, aggregation, windows, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clean, geometric_mean, nan_to_null, ratio, rnd, row_mean, whole
from ..operators import geo, series, table, zonal
from ..sources import stored
from . import fixtures as fx

query, FUNCTIONS, SQL = fx.collector()
t = fx.table


@query("p01_key_detection", "SELECT n_nationkey AS \"ADM1_PCODE\", n_name FROM nation")
def _(s, d):
    return table.with_key(t(s, d, "nation").select(F.col("n_nationkey").alias("adm1_code"), "n_name"), 1)


@query("p02_plain_key", "SELECT unit_id AS \"ADM1_PCODE\", unit_id AS \"ADM_PCODE\", n FROM units", "units")
def _(s, d):
    return table.with_plain_key(fx.units(s, d).select(F.col("unit_id").alias("ADM1_PCODE"), "n"), 1)


@query("p03_collapse_suffixes", "SELECT n, CASE WHEN n % 3 <> 0 THEN n ELSE -n END AS v FROM units", "units")
def _(s, d):
    return table.collapse_suffixes(fx.units(s, d).select("n", F.when(F.col("n") % 3 != 0, F.col("n")).alias("v_x"), (-F.col("n")).alias("v_y")))


@query("p04_prefix_names", "SELECT unit_id AS \"ADM1_PCODE\", n AS cop_n, country AS cop_country FROM units", "units")
def _(s, d):
    return table.prefix_names(fx.units(s, d).select(F.col("unit_id").alias("ADM1_PCODE"), "n", "country"), "cop_")


@query("p05_paved_filter", "SELECT line_id FROM roads WHERE pred_label = 0", "roads")
def _(s, d):
    r = table.filter_if_present(fx.roads(s, d), "pred_label", lambda c: c == 0)
    return table.filter_if_present(r, "DL_road_class_2024", lambda c: c == "paved").select("line_id")


@query("p06_threshold_null_is_zero", "SELECT line_id, sshs FROM tracks WHERE coalesce(sshs, 0) >= 1", "tracks")
def _(s, d):
    return fx.tracks(s, d).where(F.coalesce("sshs", F.lit(0)) >= 1).select("line_id", F.col("sshs").cast("long").alias("sshs"))


@query("p07_semi_join_and_years", "SELECT unit_id, year, count(*) AS n FROM conflict WHERE year BETWEEN 2018 AND 2022 AND unit_id IN (SELECT unit_id FROM units WHERE n % 2 = 0) GROUP BY unit_id, year", "conflict", "units")
def _(s, d):
    even = fx.units(s, d).where("n % 2 = 0").select("unit_id")
    c = fx.conflict(s, d).withColumn("year", F.col("year").cast("string").try_cast("int")).where(F.col("year").between(2018, 2022))
    return c.join(even, "unit_id", "left_semi").groupBy("unit_id", "year").agg(F.count("*").alias("n"))


@query("p08_tag_predicates", "SELECT p_partkey, p_type IN ('ECONOMY', 'STANDARD') AS any_of, p_size % 5 = 0 OR p_type <> 'ECONOMY' AS not_economy, regexp_matches(p_name, 'ring|widget') AS like_it FROM part")
def _(s, d):
    tag = F.when(F.col("p_size") % 5 != 0, F.col("p_type"))
    return t(s, d, "part").select("p_partkey", table.tag_is(F.col("p_type"), "ECONOMY", "STANDARD").alias("any_of"), table.tag_is_not(tag, "ECONOMY").alias("not_economy"), table.tag_matches(F.col("p_name"), "ring|widget").alias("like_it"))


@query("p11_isochrone_value_field", "SELECT o_orderkey, o_totalprice AS cutoff FROM orders WHERE o_totalprice > 100000")
def _(s, d):
    o = t(s, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").alias("Distance"))
    v = table.value_column(o)
    return o.where(F.col(v) > 100000).select("o_orderkey", F.col(v).alias("cutoff"))


@query("p12_clean_numbers", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1, 2, 3) THEN 0e0 ELSE o_totalprice END AS v FROM orders")
def _(s, d):
    k = F.col("o_orderkey") % 5
    v = F.when(k == 0, "x1").when(k == 1, "Infinity").when(k == 2, "NaN").when(k == 4, F.col("o_totalprice").cast("string"))
    return t(s, d, "orders").select("o_orderkey", clean(v).alias("v"))


@query("p13_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS whole, round_even(l_discount * l_tax * 1e2, 0) / 1e2 AS cents FROM lineitem")
def _(s, d):
    return t(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", whole(F.col("l_quantity") / 2).alias("whole"), rnd(F.col("l_discount") * F.col("l_tax"), 2).alias("cents"))


@query("p14_ordered_projection", "SELECT o_orderstatus, o_orderkey FROM orders")
def _(s, d):
    return table.ordered(t(s, d, "orders"), ["absent", "o_orderstatus", "o_orderkey", "also_absent"])


@query("p16_require_values", "SELECT n_nationkey, n_name FROM nation")
def _(s, d):
    return table.require_values(t(s, d, "nation").select("n_nationkey", "n_name"), "n_name")


_LEVELS = ", levels AS (SELECT country, unit_id, CASE WHEN n % 3 = 0 THEN 2 WHEN n % 3 = 1 THEN 1 ELSE 0 END AS level FROM units)"


@query("p17_level_fallback", _LEVELS + " SELECT country, unit_id, level FROM levels l WHERE level = (SELECT max(level) FROM levels m WHERE m.country = l.country AND m.level <= 1)", "units")
def _(s, d):
    n = F.col("n") % 3
    rows = fx.units(s, d).select("country", "unit_id", F.when(n == 0, 2).when(n == 1, 1).otherwise(0).alias("level"))
    return table.best_level(rows, ["country"], "level", 1)


@query("p18_iso2_lookup", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'X' || CAST(n_nationkey // 10 AS VARCHAR) ELSE substr(n_name, 1, 2) END AS iso2 FROM nation")
def _(s, d):
    n = t(s, d, "nation").select("n_nationkey", F.col("n_name").alias("iso3"))
    lookup = n.where("n_nationkey % 2 = 0").select("iso3", F.concat(F.lit("X"), F.floor(F.col("n_nationkey") / 10).cast("string")).alias("iso2"))
    return table.country_code2(n, lookup).select("n_nationkey", "iso2")


# ---- joins


def _counts(s, d):
    c = t(s, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("n")).agg(F.count("*").alias("customers"))
    p = t(s, d, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("n")).agg(F.count("*").alias("suppliers"))
    return c, p


_COUNTS = "c AS (SELECT CAST(c_nationkey AS BIGINT) AS n, count(*) AS customers FROM customer GROUP BY 1), p AS (SELECT CAST(s_nationkey AS BIGINT) AS n, count(*) AS suppliers FROM supplier GROUP BY 1)"


@query("j01_left_merge", f", {_COUNTS} SELECT unit_id, u.n, country, customers, suppliers FROM units u LEFT JOIN c USING (n) LEFT JOIN p USING (n)", "units")
def _(s, d):
    c, p = _counts(s, d)
    return table.left_merge(fx.units(s, d), c, p, on="n").select("unit_id", "n", "country", "customers", "suppliers")


@query("j02_left_merge_shared_columns", f", {_COUNTS} SELECT u.n, unit_id, coalesce(CASE WHEN u.n % 2 = 0 THEN u.n END, c.customers) AS customers FROM units u LEFT JOIN c USING (n)", "units")
def _(s, d):
    c, _p = _counts(s, d)
    u = fx.units(s, d).select("n", "unit_id", F.when(F.col("n") % 2 == 0, F.col("n")).alias("customers"))
    return table.left_merge(u, c, on="n").select("n", "unit_id", "customers")


@query("j03_outer_merge", f", {_COUNTS} SELECT coalesce(a.n, b.n) AS n, a.customers, b.customers AS customers_second FROM (SELECT * FROM c WHERE n < 18) a FULL JOIN (SELECT n, suppliers AS customers FROM p WHERE n > 5) b ON a.n = b.n", "units")
def _(s, d):
    c, p = _counts(s, d)
    return table.outer_merge({"first": c.where("n < 18"), "second": p.where("n > 5").withColumnRenamed("suppliers", "customers")}, "n")


@query("j04_map_join", f", {_COUNTS} SELECT unit_id, u.n, coalesce(suppliers, 0) AS suppliers FROM units u LEFT JOIN (SELECT * FROM p WHERE n % 4 <> 0) USING (n)", "units")
def _(s, d):
    _c, p = _counts(s, d)
    return table.map_join(fx.units(s, d).select("unit_id", "n"), p.where("n % 4 <> 0"), "n", "suppliers").select("unit_id", "n", "suppliers")


@query("j05_denominators", f", {_COUNTS} SELECT n, round_even(CAST(suppliers AS DOUBLE) / customers * 100 * 10, 0) / 10 AS per_cent FROM c LEFT JOIN p USING (n)", "units")
def _(s, d):
    c, p = _counts(s, d)
    return c.join(p, "n", "left").select("n", ratio(F.col("suppliers"), F.col("customers"), digits=1, empty=None).alias("per_cent"))


@query("j06_grouped_counts", "SELECT unit_id, count(id) AS n FROM units LEFT JOIN facility_zone USING (unit_id) GROUP BY unit_id", "units", "facility_zone")
def _(s, d):
    n = fx.facility_zone(s, d).groupBy("unit_id").agg(F.count("*").alias("n"))
    return table.map_join(fx.units(s, d).select("unit_id"), n, "unit_id", "n")


@query("j13_columns_side_by_side", "SELECT unit_id, n, n * 2 AS twice, 24 - n AS back FROM units", "units")
def _(s, d):
    return fx.units(s, d).select("unit_id", "n", (F.col("n") * 2).alias("twice"), (24 - F.col("n")).alias("back"))


@query("j14_update_join", f", {_COUNTS} SELECT u.n, CASE WHEN u.n < 10 THEN coalesce(customers, -1) ELSE -1 END AS v FROM units u LEFT JOIN c USING (n)", "units")
def _(s, d):
    c, _p = _counts(s, d)
    base = fx.units(s, d).select("n", F.lit(-1).cast("long").alias("v"))
    return table.update_join(base, c.where("n < 10").withColumnRenamed("customers", "v"), "n", ["v"])


_NAMED = "SELECT DISTINCT 'ADM' || CAST(n_nationkey % 4 AS VARCHAR) AS adm, n_regionkey, n_nationkey % 4 AS level FROM nation"


@query(
    "j15_pair_files_by_level",
    f"SELECT CAST(x.level AS INTEGER) AS level, 'access_' || x.adm || '.csv' AS a, 'rai_' || y.adm || '.csv' AS b FROM (SELECT DISTINCT adm, level FROM ({_NAMED}) WHERE n_regionkey < 3) x JOIN (SELECT DISTINCT adm, level FROM ({_NAMED}) WHERE n_regionkey > 1 AND level < 3) y USING (level)",
)
def _(s, d):
    """Files of two kinds, named after levels, meet by the level in their names."""
    level = F.regexp_extract("path", r"ADM(\d)", 1).cast("int")
    n = t(s, d, "nation")
    name = lambda kind: F.concat(F.lit(f"{kind}_ADM"), (F.col("n_nationkey") % 4).cast("string"), F.lit(".csv")).alias("path")
    a = n.where("n_regionkey < 3").select(name("access")).distinct().select(level.alias("level"), F.col("path").alias("a"))
    b = n.where("n_regionkey > 1 AND n_nationkey % 4 < 3").select(name("rai")).distinct().select(level.alias("level"), F.col("path").alias("b"))
    return a.join(b, "level")


# ---- aggregation


@query("z07_yearly_pivot", "SELECT unit_id, " + ", ".join(f"CAST(sum(CASE WHEN year = {y} THEN fatalities END) AS BIGINT) AS fatl_{y % 100}, CAST(sum(CASE WHEN year = {y} THEN events END) AS BIGINT) AS evts_{y % 100}" for y in range(2018, 2026)) + " FROM conflict GROUP BY unit_id", "conflict")
def _(s, d):
    return table.yearly_pivot(fx.conflict(s, d), "unit_id", "year", range(2018, 2026), {"evts": "events", "fatl": "fatalities"})


@query("z08_weighted_years", "SELECT unit_id, CAST(sum(events * pow(2, year - 2018)) AS DOUBLE) AS evts_w FROM conflict GROUP BY unit_id", "conflict")
def _(s, d):
    y = range(2018, 2026)
    wide = table.yearly_pivot(fx.conflict(s, d), "unit_id", "year", y, {"evts": "events"})
    return wide.select("unit_id", table.weighted_years(wide, "evts", y).alias("evts_w"))


@query("z09_class_share", "SELECT unit_id, " + ", ".join(f"count(CASE WHEN category = '{c}' THEN 1 END) AS {c}_n, round_even(count(CASE WHEN category = '{c}' THEN 1 END) * 1e0 / count(*) * 100 * 100, 0) / 100 AS {c}_perc" for c in fx.CATEGORIES) + " FROM facility_zone GROUP BY unit_id", "facility_zone")
def _(s, d):
    shares = zonal.share_of_class(fx.CATEGORIES, "category", "f")
    each = fx.facility_zone(s, d).groupBy("unit_id").agg(*(m.alias(n) for n, m in shares.items()))
    return each.select("unit_id", *(f for c in fx.CATEGORIES for f in (F.col(f"f_count_cat{c}").alias(f"{c}_n"), rnd(F.col(f"f_perc_cat{c}"), 2).alias(f"{c}_perc"))))


@query("z10_row_mean", "SELECT line_id, (coalesce(r_se, 0) + coalesce(r_ne, 0) + coalesce(r_nw, 0) + coalesce(r_sw, 0)) * 1e0 / nullif(count_n, 0) AS mean FROM (SELECT *, CAST(r_se IS NOT NULL AS INT) + CAST(r_ne IS NOT NULL AS INT) + CAST(r_nw IS NOT NULL AS INT) + CAST(r_sw IS NOT NULL AS INT) AS count_n FROM tracks)", "tracks")
def _(s, d):
    return fx.tracks(s, d).select("line_id", row_mean(*map(F.col, ("r_se", "r_ne", "r_nw", "r_sw"))).alias("mean"))


@query("z11_min_max", "SELECT unit_id, (vul_supplier - min(vul_supplier) OVER ()) * 1e0 / (max(vul_supplier) OVER () - min(vul_supplier) OVER ()) AS vul_supplier, CAST(cop_constant AS DOUBLE) AS cop_constant FROM indicators", "indicators")
def _(s, d):
    return table.min_max(fx.indicators(s, d).select("unit_id", "vul_supplier", "cop_constant"), ["vul_supplier", "cop_constant"])


@query("z20_all_and_any", "SELECT o_orderpriority, bool_and(o_totalprice > 1000) AS every_one, bool_or(o_totalprice > 499000) AS some_one FROM orders GROUP BY 1")
def _(s, d):
    p = F.col("o_totalprice")
    return t(s, d, "orders").groupBy("o_orderpriority").agg(F.every(p > 1000).alias("every_one"), F.some(p > 499000).alias("some_one"))


# ---- windows


@query("w01_average_rank", "SELECT o_orderkey, v, CASE WHEN v IS NOT NULL THEN rank() OVER (ORDER BY v DESC NULLS LAST) + (count(*) OVER (PARTITION BY v) - 1) / 2e0 END AS ranking FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey % 50 END AS v FROM orders)")
def _(s, d):
    o = t(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey") % 50).alias("v"))
    return series.average_rank(o, "v", "ranking").select("o_orderkey", "v", "ranking")


@query("w01_average_rank_by_ranges", "SELECT o_orderkey, o_totalprice AS v, rank() OVER (ORDER BY o_totalprice DESC) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2e0 AS ranking FROM orders")
def _(s, d):
    o = t(s, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))
    return series.average_rank(o, "v", "ranking", store=stored).select("o_orderkey", "v", "ranking")


@query("w03_latest_status", "SELECT country, arg_max(status, event_id) AS status FROM runs GROUP BY country", "runs")
def _(s, d):
    return series.latest(fx.runs(s, d), "country", "status", "created", "event_id")


_FAILURES = "SELECT country, CAST(sum(CASE WHEN ok = 0 THEN 1 ELSE 0 END) AS BIGINT) AS failures FROM (SELECT country, sum(CASE WHEN status <> 'FAILURE' THEN 1 ELSE 0 END) OVER (PARTITION BY country ORDER BY created DESC, event_id DESC) AS ok FROM runs) GROUP BY country"


@query("w04_leading_failures", _FAILURES, "runs")
def _(s, d):
    return series.leading_failures(fx.runs(s, d), "country", "status", ["created", "event_id"])


@query("l01_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(s, d):
    return t(s, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("l02_latest_of_sorted", "SELECT o_orderpriority, max(o_orderdate) AS latest, max(o_orderkey) AS last_key FROM orders GROUP BY 1")
def _(s, d):
    return t(s, d, "orders").groupBy("o_orderpriority").agg(F.max("o_orderdate").alias("latest"), F.max("o_orderkey").alias("last_key"))


# ---- sets


@query("u01_ragged_union", "SELECT c_custkey AS id, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def _(s, d):
    return table.union_ragged(t(s, d, "customer").select(F.col("c_custkey").alias("id"), "c_mktsegment"), t(s, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_acctbal"))


@query("u02_union_of_chunks", "SELECT unit_id, sum(total_pop) AS total_pop FROM cell_zone JOIN population USING (row, col) GROUP BY unit_id", "cell_zone", "population")
def _(s, d):
    z, p = fx.cell_zone(s, d), fx.population(s, d, ("total_pop",))
    half = lambda low: z.where((F.col("unit_id") < "N12") == F.lit(low)).join(p, ["row", "col"]).groupBy("unit_id").agg(F.sum("total_pop").alias("total_pop"))
    return half(True).unionByName(half(False))


@query("u03_intersection", "SELECT c_nationkey AS n FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def _(s, d):
    return t(s, d, "customer").select(F.col("c_nationkey").alias("n")).intersect(t(s, d, "supplier").select("s_nationkey"))


@query("u04_difference", "SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49)")
def _(s, d):
    return t(s, d, "part").select("p_partkey").join(t(s, d, "lineitem").where("l_quantity > 49"), F.col("p_partkey") == F.col("l_partkey"), "left_anti")


# ---- scalars


@query("f01_ratio_of_whole_numbers", "SELECT row, col, coalesce(round_even(CAST(CAST(round_even(dep_dependents, 0) AS BIGINT) AS DOUBLE) / nullif(CAST(round_even(dep_working, 0) AS BIGINT), 0) * 100 * 100, 0) / 100, 0) AS dependency_ratio FROM population", "population")
def _(s, d):
    p = fx.population(s, d, ("dep_dependents", "dep_working"))
    return p.select("row", "col", ratio(whole(F.col("dep_dependents")), whole(F.col("dep_working"))).alias("dependency_ratio"))


@query("f05_ratio_null_when_empty", "SELECT row, col, round_even(dep_dependents / nullif(dep_working, 0) * 100 * 10, 0) / 10 AS dependency_ratio FROM population", "population")
def _(s, d):
    p = fx.population(s, d, ("dep_dependents", "dep_working"))
    return p.select("row", "col", ratio(F.col("dep_dependents"), F.col("dep_working"), digits=1, empty=None).alias("dependency_ratio"))


@query("f10_geometric_mean", "SELECT s_suppkey, CASE WHEN s_acctbal * (s_suppkey - 50) >= 0 THEN round_even(sqrt(s_acctbal * (s_suppkey - 50)) * 1e6, 0) / 1e6 END AS g FROM supplier")
def _(s, d):
    return t(s, d, "supplier").select("s_suppkey", rnd(geometric_mean(F.col("s_acctbal"), F.col("s_suppkey") - 50), 6).alias("g"))


@query("f12_nan_is_null", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS v FROM orders")
def _(s, d):
    v = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).otherwise(F.lit(float("nan")))
    return t(s, d, "orders").select("o_orderkey", nan_to_null(v).alias("v"))


@query("f13_strings_and_dates", "SELECT o_orderkey, upper(o_orderpriority) AS up, lower(trim(o_orderpriority)) AS low, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS padded, replace(o_orderpriority, '-', '_') AS replaced, starts_with(o_orderpriority, '1') AS urgent, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, CAST(o_orderdate - INTERVAL 182 DAY AS DATE) AS half_year_before FROM orders")
def _(s, d):
    p, x = F.col("o_orderpriority"), F.col("o_orderdate")
    return t(s, d, "orders").select("o_orderkey", F.upper(p).alias("up"), F.lower(F.trim(p)).alias("low"), F.lpad(F.col("o_custkey").cast("string"), 6, "0").alias("padded"), F.replace(p, F.lit("-"), F.lit("_")).alias("replaced"), p.startswith("1").alias("urgent"), F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"), F.date_sub(F.to_date(x), 182).alias("half_year_before"))


@query("x01_rollup", "SELECT country, unit_id, count(*) AS facilities FROM facility_zone JOIN units USING (unit_id) GROUP BY ROLLUP (country, unit_id)", "facility_zone", "units")
def _(s, d):
    j = fx.facility_zone(s, d).join(fx.units(s, d).select("unit_id", "country"), "unit_id")
    return j.rollup("country", "unit_id").agg(F.count("*").alias("facilities"))


@query("x02_distinct_keys", "SELECT DISTINCT o_custkey % 97 AS k FROM orders")
def _(s, d):
    return t(s, d, "orders").select((F.col("o_custkey") % 97).alias("k")).distinct()


@query("x03_bounds_filter", "SELECT line_id FROM tracks WHERE greatest(x1, x2) >= 20 AND least(x1, x2) <= 60 AND greatest(y1, y2) >= 25 AND least(y1, y2) <= 75", "tracks")
def _(s, d):
    b = geo.bounds(s.createDataFrame([(20.0, 25.0, 60.0, 75.0)], "x1 double, y1 double, x2 double, y2 double"))
    x = fx.tracks(s, d).crossJoin(F.broadcast(b))  # one row
    return x.where((F.greatest("x1", "x2") >= F.col("x_min")) & (F.least("x1", "x2") <= F.col("x_max")) & (F.greatest("y1", "y2") >= F.col("y_min")) & (F.least("y1", "y2") <= F.col("y_max"))).select("line_id")
