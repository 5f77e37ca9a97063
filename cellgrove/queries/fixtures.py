"""Synthetic geodata derived from the driver's tables by integer arithmetic, once on Spark and once as SQL.

A 100 x 100 grid of unit cells; 25 admin units (one per nation, some with a hole) in a 5 x 5 layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geo

AGES = [0, 1, *range(5, 85, 5)]
#: Ages and sexes of each population indicator.
INDICATORS = {
    "total_pop": (AGES, "fm"),
    "female_pop": (AGES, "f"),
    "children_u5": ([0, 1], "fm"),
    "female_u5": ([0, 1], "f"),
    "elderly": ([65, 70, 75, 80], "fm"),
    "pop_u15": ([0, 1, 5, 10], "fm"),
    "female_u15": ([0, 1, 5, 10], "f"),
    "wra_pop": (list(range(15, 50, 5)), "f"),
    "dep_dependents": ([0, 1, 5, 10, 65, 70, 75, 80], "fm"),
    "dep_working": (list(range(15, 65, 5)), "fm"),
}
SETTLEMENT = [10, 11, 12, 13, 21, 22, 23, 30]
RETURN_PERIODS = [10, 50, 100, 500]
CATEGORIES = ["education", "hospitals", "primary_healthcare"]

SQL: dict[str, tuple[list[str], str]] = {}
QUERIES: dict[str, Callable] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_sql(body: str, *needs: str) -> str:
    """``body`` behind the fixtures it needs, and those they need."""
    done: dict[str, str] = {}

    def add(n: str) -> None:
        if n not in done:
            for m in SQL[n][0]:
                add(m)
            done[n] = SQL[n][1]

    for n in needs:
        add(n)
    return ("WITH " + ",\n".join(f"{n} AS ({t})" for n, t in done.items()) + "\n" if done else "") + body


def case_sql(name: str) -> str:
    ages, sexes = INDICATORS[name]
    return f"age IN ({', '.join(map(str, ages))})" + ("" if len(sexes) == 2 else f" AND sex = '{sexes}'")


def is_in(name: str):
    ages, sexes = INDICATORS[name]
    return F.col("age").isin(ages) & F.col("sex").isin(list(sexes))


# ---- units


def units(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("unit_id"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country"), F.col("n_nationkey").cast("long").alias("n"))


SQL["units"] = ([], "SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS unit_id, 'R' || CAST(n_regionkey AS VARCHAR) AS country, CAST(n_nationkey AS BIGINT) AS n FROM nation")


def rings(spark: SparkSession, d: str) -> DataFrame:
    u = units(spark, d)
    n = F.col("n")
    x0, y0 = (n % 5 * 20).cast("double"), (F.floor(n / 5) * 20).cast("double")
    p = lambda x, y: F.struct((x0 + x).cast("double").alias("x"), (y0 + y).cast("double").alias("y"))
    outer = F.array(p(1 + n % 3, F.lit(1)), p(F.lit(19), 2 + n % 4), p(18 - n % 2, F.lit(19)), p(F.lit(2), F.lit(17)))
    hole = F.array(*(p(F.lit(x), F.lit(y)) for x, y in ((8, 8), (11, 8), (11, 11), (8, 11))))
    return u.select("unit_id", F.lit(0).alias("ring"), outer.alias("points")).unionAll(u.where("n % 5 = 0").select("unit_id", F.lit(1).alias("ring"), hole.alias("points")))


def edges(spark: SparkSession, d: str) -> DataFrame:
    return geo.edges_from_rings(rings(spark, d))


SQL["corners"] = (
    ["units"],
    """SELECT unit_id, 0 AS ring, k, CAST(n % 5 * 20 AS DOUBLE) + CASE k WHEN 0 THEN 1 + n % 3 WHEN 1 THEN 19 WHEN 2 THEN 18 - n % 2 ELSE 2 END AS x,
       CAST(n // 5 * 20 AS DOUBLE) + CASE k WHEN 0 THEN 1 WHEN 1 THEN 2 + n % 4 WHEN 2 THEN 19 ELSE 17 END AS y FROM units, range(4) t(k)
  UNION ALL SELECT unit_id, 1, k, CAST(n % 5 * 20 AS DOUBLE) + CASE WHEN k IN (1, 2) THEN 11 ELSE 8 END, CAST(n // 5 * 20 AS DOUBLE) + CASE WHEN k < 2 THEN 8 ELSE 11 END
  FROM units, range(4) t(k) WHERE n % 5 = 0""",
)
SQL["edges"] = (["corners"], "SELECT a.unit_id, a.ring, a.k AS seq, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corners a JOIN corners b ON a.unit_id = b.unit_id AND a.ring = b.ring AND b.k = (a.k + 1) % 4")


def grid(spark: SparkSession) -> DataFrame:
    return spark.range(10000).select(F.floor(F.col("id") / 100).cast("int").alias("row"), (F.col("id") % 100).cast("int").alias("col"))


SQL["grid"] = ([], "SELECT CAST(i // 100 AS INTEGER) AS row, CAST(i % 100 AS INTEGER) AS col, i // 100 + 0.5e0 AS py, i % 100 + 0.5e0 AS px FROM range(10000) t(i)")


def cell_zone(spark: SparkSession, d: str) -> DataFrame:
    return geo.cells_in_polygons(grid(spark), edges(spark, d))


SQL["cell_zone"] = (
    ["grid", "edges"],
    "SELECT unit_id, row, col FROM grid JOIN edges ON (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 GROUP BY unit_id, row, col HAVING count(*) % 2 = 1",
)

# ---- rasters


def pop_bins(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("l_partkey") % 18
    return table(spark, d, "lineitem").select(
        (F.col("l_partkey") % 100).cast("int").alias("row"),
        (F.col("l_suppkey") % 100).cast("int").alias("col"),
        F.when(F.col("l_linenumber") % 2 == 0, "f").otherwise("m").alias("sex"),
        F.when(k < 2, k).otherwise((k - 1) * 5).cast("int").alias("age"),
        F.col("l_quantity").alias("value"),
    )


SQL["pop_bins"] = (
    [],
    "SELECT CAST(l_partkey % 100 AS INTEGER) AS row, CAST(l_suppkey % 100 AS INTEGER) AS col, CASE WHEN l_linenumber % 2 = 0 THEN 'f' ELSE 'm' END AS sex, CAST(CASE WHEN l_partkey % 18 < 2 THEN l_partkey % 18 ELSE (l_partkey % 18 - 1) * 5 END AS INTEGER) AS age, l_quantity AS value FROM lineitem",
)


def population(spark: SparkSession, d: str, names=tuple(INDICATORS)) -> DataFrame:
    """One column per indicator and cell: all ten in one scan and one aggregation."""
    return pop_bins(spark, d).groupBy("row", "col").agg(*(F.sum(F.when(is_in(n), F.col("value")).otherwise(0.0)).alias(n) for n in names))


SQL["population"] = (["pop_bins"], "SELECT row, col, " + ", ".join(f"sum(CASE WHEN {case_sql(n)} THEN value ELSE 0 END) AS {n}" for n in INDICATORS) + " FROM pop_bins GROUP BY row, col")


def settlement(spark: SparkSession, d: str) -> DataFrame:
    """A class a cell, the next one for every item there."""
    n = table(spark, d, "lineitem").groupBy((F.col("l_partkey") % 100).cast("int").alias("row"), (F.col("l_orderkey") % 100).cast("int").alias("col")).agg(F.count("*").alias("n"))
    k = (F.floor(F.col("row") / 9) + F.floor(F.col("col") / 7) + F.coalesce("n", F.lit(0))) % 8
    return grid(spark).join(n, ["row", "col"], "left").select("row", "col", F.array(*map(F.lit, SETTLEMENT))[k.cast("int")].alias("code"))


SQL["settlement"] = (
    ["grid"],
    f"SELECT row, col, {SETTLEMENT}[CAST((row // 9 + col // 7 + coalesce(n, 0)) % 8 + 1 AS INTEGER)] AS code FROM grid LEFT JOIN (SELECT l_partkey % 100 AS row, l_orderkey % 100 AS col, count(*) AS n FROM lineitem GROUP BY ALL) USING (row, col)",
)


def hazard(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    v = o.groupBy((F.col("o_orderkey") % 100).cast("int").alias("row"), (F.col("o_custkey") % 100).cast("int").alias("col")).agg(F.max((F.col("o_orderkey") * 7 + F.col("o_custkey") * 3) % 100).alias("v"))
    return v.select("row", "col", F.posexplode(F.array(*map(F.lit, RETURN_PERIODS))).alias("k", "rp"), "v").select("rp", "row", "col", (F.col("v") * (F.col("k") + 1) / 400.0).alias("depth"))


SQL["hazard"] = (
    [],
    f"SELECT ({RETURN_PERIODS})[k + 1] AS rp, row, col, CAST(v * (k + 1) AS DOUBLE) / 400e0 AS depth FROM (SELECT CAST(o_orderkey % 100 AS INTEGER) AS row, CAST(o_custkey % 100 AS INTEGER) AS col, max((o_orderkey * 7 + o_custkey * 3) % 100) AS v FROM orders GROUP BY ALL), range(4) t(k)",
)

# ---- points and lines


def facilities(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("c_mktsegment")
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(s.isin("AUTOMOBILE", "BUILDING"), "education").when(s.isin("FURNITURE", "HOUSEHOLD"), "hospitals").otherwise("primary_healthcare").alias("category"),
        (F.col("c_custkey") * 37 % 1000 / 10.0 + 0.05).alias("x"),
        (F.col("c_custkey") * 53 % 1000 / 10.0 + 0.05).alias("y"),
    )


SQL["facilities"] = (
    [],
    "SELECT c_custkey AS id, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'education' WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'hospitals' ELSE 'primary_healthcare' END AS category, CAST(c_custkey * 37 % 1000 AS DOUBLE) / 10e0 + 0.05e0 AS x, CAST(c_custkey * 53 % 1000 AS DOUBLE) / 10e0 + 0.05e0 AS y FROM customer",
)
SQL["facility_zone"] = (
    ["facilities", "edges"],
    "SELECT id, category, x, y, unit_id FROM facilities JOIN edges ON (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1",
)


def facility_zone(spark: SparkSession, d: str) -> DataFrame:
    return geo.points_in_polygons(facilities(spark, d), edges(spark, d), "unit_id")


def roads(spark: SparkSession, d: str) -> DataFrame:
    x, y = (F.col("o_orderkey") % 7 * 15).cast("double"), (F.col("o_custkey") % 100).cast("double")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("line_id"), F.col("o_orderpriority").alias("surface"), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 0).otherwise(1).alias("pred_label"), x.alias("x1"), y.alias("y1"), (x + F.col("o_orderkey") % 3 - 1).alias("x2"), (y + 2).alias("y2"))


SQL["roads"] = (
    [],
    "SELECT o_orderkey AS line_id, o_orderpriority AS surface, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE 1 END AS pred_label, CAST(o_orderkey % 7 * 15 AS DOUBLE) AS x1, CAST(o_custkey % 100 AS DOUBLE) AS y1, CAST(o_orderkey % 7 * 15 AS DOUBLE) + o_orderkey % 3 - 1 AS x2, CAST(o_custkey % 100 AS DOUBLE) + 2 AS y2 FROM orders",
)


def tracks(spark: SparkSession, d: str) -> DataFrame:
    x, y = (F.col("o_custkey") % 100).cast("double"), (F.col("o_orderkey") % 5 * 20 + 10).cast("double")
    none_if_0 = lambda c: F.nullif(c, F.lit(0))
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("line_id"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_orderkey") % 6).cast("int").alias("sshs"),
        none_if_0(F.col("o_orderkey") % 30).alias("r_se"),
        none_if_0(F.col("o_orderkey") % 20).alias("r_ne"),
        none_if_0(F.col("o_orderkey") % 10).alias("r_nw"),
        none_if_0(F.col("o_orderkey") % 15).alias("r_sw"),
        x.alias("x1"), y.alias("y1"), (x + 2).alias("x2"), (y + F.col("o_orderkey") % 3 - 1).alias("y2"),
    )


SQL["tracks"] = (
    [],
    "SELECT o_orderkey AS line_id, CASE WHEN o_custkey % 11 <> 0 THEN o_orderkey % 6 END AS sshs, nullif(o_orderkey % 30, 0) AS r_se, nullif(o_orderkey % 20, 0) AS r_ne, nullif(o_orderkey % 10, 0) AS r_nw, nullif(o_orderkey % 15, 0) AS r_sw, CAST(o_custkey % 100 AS DOUBLE) AS x1, CAST(o_orderkey % 5 * 20 + 10 AS DOUBLE) AS y1, CAST(o_custkey % 100 AS DOUBLE) + 2 AS x2, CAST(o_orderkey % 5 * 20 + 10 AS DOUBLE) + o_orderkey % 3 - 1 AS y2 FROM orders",
)
DISTANCE_SQL = "pow(px - (x1 + {t} * (x2 - x1)), 2) + pow(py - (y1 + {t} * (y2 - y1)), 2)".format(t="greatest(0e0, least(1e0, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0)))")


def isochrones(spark: SparkSession, d: str) -> DataFrame:
    """Diamonds around each unit's middle: (unit_id is the site, cutoff); neighbours' overlap."""
    u = units(spark, d).withColumn("k", F.explode(F.array(F.lit(3), F.lit(6), F.lit(12))))
    x, y, k = (F.col("n") % 5 * 20 + 10).cast("double"), (F.floor(F.col("n") / 5) * 20 + 10).cast("double"), F.col("k") + 0.25
    p = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    r = u.select(F.concat("unit_id", F.lit(":"), F.col("k").cast("string")).alias("piece"), F.lit(0).alias("ring"), F.array(p(x - k, y), p(x, y - k), p(x + k, y), p(x, y + k)).alias("points"))
    return geo.edges_from_rings(r, "piece")


SQL["isochrones"] = (
    ["units"],
    """SELECT unit_id || ':' || CAST(k AS VARCHAR) AS piece, cx + ux AS x1, cy + uy AS y1, cx + vx AS x2, cy + vy AS y2 FROM (
    SELECT unit_id, k, CAST(n % 5 * 20 + 10 AS DOUBLE) AS cx, CAST(n // 5 * 20 + 10 AS DOUBLE) AS cy,
      CASE i WHEN 0 THEN -(k + 0.25e0) WHEN 2 THEN k + 0.25e0 ELSE 0 END AS ux, CASE i WHEN 1 THEN -(k + 0.25e0) WHEN 3 THEN k + 0.25e0 ELSE 0 END AS uy,
      CASE (i + 1) % 4 WHEN 0 THEN -(k + 0.25e0) WHEN 2 THEN k + 0.25e0 ELSE 0 END AS vx, CASE (i + 1) % 4 WHEN 1 THEN -(k + 0.25e0) WHEN 3 THEN k + 0.25e0 ELSE 0 END AS vy
    FROM units, (SELECT unnest([3, 6, 12]) AS k), range(4) t(i))""",
)
SQL["iso_cells"] = (["grid", "isochrones"], "SELECT piece, row, col FROM grid JOIN isochrones ON (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1")

# ---- series, events, runs


def series(spark: SparkSession, d: str) -> DataFrame:
    """Mean event value (in cents, summed as integers) per user and day; a low mean is a dry step."""
    e = table(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("cell"), F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("step")).agg(F.sum(F.rint(F.col("value") * 100).cast("long")).alias("cents"), F.count("*").alias("n"))


SQL["series"] = ([], "SELECT user_id AS cell, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS step, CAST(sum(CAST(round_even(value * 100, 0) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n FROM events GROUP BY ALL")
DRY = 6000


def conflict(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(units(spark, d), F.col("c_nationkey") == F.col("n"))
    return j.select("unit_id", (F.year("o_orderdate") + 23).alias("year"), F.lit(1).alias("events"), (F.col("o_orderkey") % 10).alias("fatalities"))


SQL["conflict"] = (["units"], "SELECT unit_id, CAST(year(o_orderdate) + 23 AS INTEGER) AS year, 1 AS events, o_orderkey % 10 AS fatalities FROM orders JOIN customer ON o_custkey = c_custkey JOIN units ON c_nationkey = n")


def runs(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("event_type")
    return table(spark, d, "events").select(F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("country"), F.when(t == "purchase", "SUCCESS").when(t == "error", "FAILURE").when(t == "signup", "CANCELED").when(t == "view", "STARTED").otherwise("FAILURE").alias("status"), F.col("ts").alias("created"), "event_id")


SQL["runs"] = ([], "SELECT 'C' || CAST(user_id AS VARCHAR) AS country, CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILURE' WHEN 'signup' THEN 'CANCELED' WHEN 'view' THEN 'STARTED' ELSE 'FAILURE' END AS status, ts AS created, event_id FROM events")


def indicators(spark: SparkSession, d: str) -> DataFrame:
    """One wide row per unit with cop_, vul_ and exp_ columns, some null or constant."""
    u = units(spark, d)
    c = table(spark, d, "customer").groupBy(F.col("c_nationkey").cast("long").alias("n")).agg(F.count("*").alias("cop_customers"), F.sum(F.floor("c_acctbal")).alias("vul_balance"))
    s = table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("n")).agg(F.count("*").alias("cop_suppliers"), F.max(F.floor("s_acctbal")).alias("vul_supplier"))
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").cast("long").alias("n")).agg(F.count("*").alias("exp_flo_orders"), F.sum(F.floor("o_totalprice")).alias("exp_flo_price"), F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("exp_cyc_open"))
    out = u.join(c, "n", "left").join(s, "n", "left").join(o, "n", "left")
    return out.withColumns({"exp_cyc_open": F.when(F.col("n") % 7 != 0, F.col("exp_cyc_open")), "vul_balance": F.when(F.col("n") % 11 != 0, F.col("vul_balance")), "cop_constant": F.lit(0).cast("long")})


SQL["indicators"] = (
    ["units"],
    """SELECT unit_id, country, n, cop_customers, cop_suppliers, CAST(0 AS BIGINT) AS cop_constant, CASE WHEN n % 11 <> 0 THEN vul_balance END AS vul_balance, vul_supplier,
    exp_flo_orders, exp_flo_price, CASE WHEN n % 7 <> 0 THEN exp_cyc_open END AS exp_cyc_open FROM units
    LEFT JOIN (SELECT CAST(c_nationkey AS BIGINT) AS n, count(*) AS cop_customers, CAST(sum(floor(c_acctbal)) AS BIGINT) AS vul_balance FROM customer GROUP BY 1) USING (n)
    LEFT JOIN (SELECT CAST(s_nationkey AS BIGINT) AS n, count(*) AS cop_suppliers, CAST(max(floor(s_acctbal)) AS BIGINT) AS vul_supplier FROM supplier GROUP BY 1) USING (n)
    LEFT JOIN (SELECT CAST(c_nationkey AS BIGINT) AS n, count(*) AS exp_flo_orders, CAST(sum(floor(o_totalprice)) AS BIGINT) AS exp_flo_price, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS exp_cyc_open FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1) USING (n)""",
)


def collector():
    """A decorator that registers a query under a name, with its SQL, and the two dictionaries it fills."""
    functions: dict[str, Callable] = {}
    sql: dict[str, str] = {}

    def query(name: str, body: str | None = None, *needs: str):
        def keep(f):
            functions[name] = f
            if body is not None:
                sql[name] = with_sql(body, *needs)
            return f

        return keep

    return query, functions, sql
