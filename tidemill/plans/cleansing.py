"""Cleansing, imputation, constraints and table modification. Dirt is injected by key arithmetic, then repaired."""

from pyspark.sql import functions as F

from ..functions import dates as D, numeric as N
from ..operators import cleansing as C, modify as M, ordering as O
from ..session import cut_lineage
from ..sources.tables import table
from .registry import query

# Branch codes by order-id prefix, and the dishes of the menu.
BRANCH_PREFIX = {"ORDA": "NK", "ORDB": "TP", "ORDC": "BK"}
DISHES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_DISH_SQL = "list_value(" + ", ".join(f"'{d}'" for d in DISHES) + ")"
_MENU_SQL = "SELECT p_type, CAST(round(avg(CAST(p_retailprice AS DECIMAL(12,2))), 2) AS DECIMAL(12,2)) AS price FROM part GROUP BY 1"


@query("impute_mean_mode", """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
                      CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS qty,
                      CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_extendedprice END AS price,
                      CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS flag FROM lineitem),
         m AS (SELECT round(avg(qty), 1) AS q, round(avg(price), 1) AS p FROM d),
         f AS (SELECT flag FROM d WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, coalesce(qty, m.q) AS qty, coalesce(price, m.p) AS price,
           coalesce(d.flag, f.flag) AS flag FROM d, m, f""")
def impute_mean_mode(spark, sf):
    dirty = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.expr("if(l_partkey % 7 = 0, 'NA', cast(l_quantity as string))").alias("qty"),
        F.expr("if(l_suppkey % 9 = 0, null, cast(l_extendedprice as string))").alias("price"),
        F.expr("if(l_orderkey % 5 = 0, 'NA', l_returnflag)").alias("flag"))
    return C.impute(dirty, ["qty", "price"], ["flag"])


def _dirty_orders(spark, sf):
    """Orders with lower-cased, missing or wrong branch codes, garbled or missing dates and flipped coordinates."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "concat('ORD', element_at(array('A', 'B', 'C'), cast(o_orderkey % 3 + 1 as int)), o_orderkey) as order_id",
        "case when o_orderkey % 10 = 1 then null when o_orderkey % 10 = 2 then element_at(array('nk', 'tp', 'bk'), cast(o_orderkey % 3 + 1 as int)) "
        "when o_orderkey % 10 = 3 then 'TP' else element_at(array('NK', 'TP', 'BK'), cast(o_orderkey % 3 + 1 as int)) end as branch_code",
        "case when o_orderkey % 16 = 5 then null when o_orderkey % 16 = 6 then 'soon' when o_orderkey % 8 = 3 then date_format(o_orderdate, 'dd-MM-yyyy') "
        "     when o_orderkey % 8 = 4 and day(o_orderdate) > 12 then date_format(o_orderdate, 'yyyy-dd-MM') "
        "     else date_format(o_orderdate, 'yyyy-MM-dd') end as day",
        "if(o_orderkey % 11 = 5, 1, -1) * (37 + (o_custkey % 90) / 100.0) as lat",
        "144 + (o_custkey % 97) / 100.0 as lon")


def _fix_codes(df):
    return C.repair_code(df, "order_id", "branch_code", BRANCH_PREFIX)


def _fix_days(df):
    return df.withColumn("day", D.repair_date(F.col("day")))


def _fix_places(df):
    fixed = N.repair_latlon(F.col("lat"), F.col("lon"))
    return df.withColumns({"lat": fixed["lat"], "lon": fixed["lon"]})


_CLEAN_ORDERS_SQL = """
    SELECT o_orderkey, list_value('NK', 'TP', 'BK')[CAST(o_orderkey % 3 + 1 AS INT)] AS branch_code,
           CASE o_orderkey % 16 WHEN 5 THEN NULL WHEN 6 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day, round(-(37 + (o_custkey % 90) / 100.0), 4)::DOUBLE AS lat,
           round(144 + (o_custkey % 97) / 100.0, 4)::DOUBLE AS lon FROM orders"""


@query("repair_code", """
    SELECT o_orderkey, list_value('NK', 'TP', 'BK')[CAST(o_orderkey % 3 + 1 AS INT)] AS branch_code FROM orders""")
def repair_code(spark, sf):
    return _fix_codes(_dirty_orders(spark, sf)).select("o_orderkey", "branch_code")


@query("repair_steps", _CLEAN_ORDERS_SQL)
def repair_steps(spark, sf):
    fixed = C.repair(_dirty_orders(spark, sf), [_fix_codes, _fix_days, _fix_places])
    return fixed.select("o_orderkey", "branch_code", "day", F.round(F.col("lat").cast("double"), 4).alias("lat"),
                        F.round(F.col("lon").cast("double"), 4).alias("lon"))


@query("repair_audit", """
    SELECT 'branch_code' AS column_name, count(*) FILTER (WHERE o_orderkey % 10 IN (1, 2) OR (o_orderkey % 10 = 3 AND o_orderkey % 3 <> 1)) AS n_changed FROM orders
    UNION ALL SELECT 'day', count(*) FILTER (WHERE o_orderkey % 8 = 3 OR (o_orderkey % 8 = 4 AND day(o_orderdate) > 12)) FROM orders
    UNION ALL SELECT 'lat', count(*) FILTER (WHERE o_orderkey % 11 = 5) FROM orders
    UNION ALL SELECT 'lon', 0 FROM orders GROUP BY 1""")
def repair_audit(spark, sf):
    raw = _dirty_orders(spark, sf)
    return C.audit(raw, C.repair(raw, [_fix_codes, _fix_days, _fix_places]), ["o_orderkey"],
                   ["branch_code", "day", "lat", "lon"])


@query("infer_unit_prices", """
    WITH m AS (SELECT l_returnflag, (count(*) % 1000) / 100.0 + 1 AS rice, (sum(l_linenumber) % 1000) / 100.0 + 1 AS fish,
                      (CAST(sum(l_quantity) AS BIGINT) % 1000) / 100.0 + 1 AS soup FROM lineitem GROUP BY 1)
    SELECT l_returnflag, item, round(CAST(price AS DOUBLE), 2) AS price FROM (
        SELECT l_returnflag, 'rice' AS item, rice AS price FROM m UNION ALL SELECT l_returnflag, 'fish', fish FROM m
        UNION ALL SELECT l_returnflag, 'soup', soup FROM m)""")
def infer_unit_prices(spark, sf):
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_returnflag", "cast(l_quantity as int) as rice", "l_linenumber as fish", "cast(l_suppkey % 7 as int) as soup",
        "l_linenumber", "l_quantity")
    menu = lines.groupBy("l_returnflag").agg(
        (F.count("*") % 1000 / 100.0 + 1).alias("p_rice"), (F.sum("l_linenumber") % 1000 / 100.0 + 1).alias("p_fish"),
        (F.sum("l_quantity").cast("bigint") % 1000 / 100.0 + 1).alias("p_soup"))
    bills = lines.join(menu, "l_returnflag").selectExpr(
        "l_returnflag", "rice", "fish", "soup", "rice * p_rice + fish * p_fish + soup * p_soup as total")
    return C.infer_unit_prices(bills, "l_returnflag", ["rice", "fish", "soup"], "total")


def _menu(spark, sf):
    price = F.round(F.avg(F.col("p_retailprice").cast("decimal(12,2)")), 2)
    return table(spark, sf, "part").groupBy(F.col("p_type").alias("item")).agg(price.alias("price"))


def _meals(spark, sf):
    """Two dishes per order; on some orders the second dish has an unknown name."""
    dishes = F.array(*[F.lit(d) for d in DISHES])
    first = F.element_at(dishes, (F.col("o_orderkey") % 6 + 1).cast("int"))
    second = F.element_at(dishes, ((F.col("o_orderkey") + 1 + F.col("o_custkey") % 5) % 6 + 1).cast("int"))
    pair = lambda b: F.array(
        F.struct(first.alias("item"), (F.col("o_custkey") % 7 + 1).cast("int").alias("qty")),
        F.struct(b.alias("item"), (F.col("o_orderkey") % 4 + 1).cast("int").alias("qty")))
    dirty = F.when(F.col("o_custkey") % 4 == 0, F.lit("Mystery")).otherwise(second)
    meals = table(spark, sf, "orders").select("o_orderkey", pair(second).alias("clean"), pair(dirty).alias("items"))
    return C.recompute_total(meals, ["o_orderkey"], "clean", _menu(spark, sf), "total")


_MEALS_SQL = f"""
    WITH menu AS ({_MENU_SQL}), m AS (SELECT o_orderkey, o_custkey % 7 + 1 AS qa, o_orderkey % 4 + 1 AS qb,
        {_DISH_SQL}[CAST(o_orderkey % 6 + 1 AS INT)] AS a, {_DISH_SQL}[CAST((o_orderkey + 1 + o_custkey % 5) % 6 + 1 AS INT)] AS b
        FROM orders)"""


@query("repair_items", f"""{_MEALS_SQL} SELECT o_orderkey, a || ':' || qa || ',' || b || ':' || qb AS items FROM m""")
def repair_items(spark, sf):
    fixed = C.repair_items(_meals(spark, sf), ["o_orderkey"], "items", "total", _menu(spark, sf))
    text = F.array_join(F.transform("items", lambda e: F.concat_ws(":", e["item"], e["qty"].cast("string"))), ",")
    return fixed.select("o_orderkey", text.alias("items"))


@query("recompute_total", f"""{_MEALS_SQL}
    SELECT o_orderkey, CAST(x.price * qa + y.price * qb AS DOUBLE) AS total
    FROM m JOIN menu x ON a = x.p_type JOIN menu y ON b = y.p_type""")
def recompute_total(spark, sf):
    return _meals(spark, sf).select("o_orderkey", F.col("total").cast("double").alias("total"))


# lines with missing prices, quantities and flags
_LINES_SQL = """
    SELECT * REPLACE (CASE WHEN l_partkey % 11 > 0 THEN l_extendedprice END AS l_extendedprice,
        CASE WHEN l_suppkey % 13 > 0 THEN l_quantity END AS l_quantity,
        CASE WHEN l_orderkey % 17 > 0 THEN l_returnflag END AS l_returnflag) FROM lineitem"""


def _gappy_lines(spark, sf):
    gap = {"l_extendedprice": "l_partkey % 11", "l_quantity": "l_suppkey % 13", "l_returnflag": "l_orderkey % 17"}
    return table(spark, sf, "lineitem").withColumns({c: F.expr(f"if({key} > 0, {c}, null)") for c, key in gap.items()})


@query("infer_modal_prices", """
    WITH m AS (SELECT l_returnflag, (count(*) % 1000) / 100.0 + 1 AS rice, (sum(l_linenumber) % 1000) / 100.0 + 1 AS fish FROM lineitem GROUP BY 1)
    SELECT l_returnflag, item, round(CAST(price AS DOUBLE), 2) AS price FROM (
        SELECT l_returnflag, 'rice' AS item, rice AS price FROM m UNION ALL SELECT l_returnflag, 'fish', fish FROM m)""")
def infer_modal_prices(spark, sf):
    """Every ninth bill has a wrong total, every eleventh none."""
    lines = table(spark, sf, "lineitem").selectExpr("l_returnflag", "cast(l_quantity as int) as rice", "l_linenumber as fish",
                                                    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    menu = lines.groupBy("l_returnflag").agg((F.count("*") % 1000 / 100.0 + 1).alias("p_rice"),
                                             (F.sum("l_linenumber") % 1000 / 100.0 + 1).alias("p_fish"))
    # stored, so that its few rows travel to the lines and not all lines of a flag to one task
    bills = lines.join(cut_lineage(menu), "l_returnflag").withColumn("total", F.expr(
        "case when l_partkey % 11 = 0 then null else rice * p_rice + fish * p_fish + if(l_orderkey % 9 = 4, 25, 0) end"))
    return C.infer_modal_prices(bills, "l_returnflag", ["rice", "fish"], "total",
                                ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], block_rows=6)


# The dish that the menu of each order status lacks.
MISSING_DISH = {"F": "ECONOMY", "O": "LARGE", "P": "PROMO"}


def _meals_by_status(spark, sf):
    """Menus and prices per status; on some orders the second dish is one that only other menus have."""
    menu = table(spark, sf, "part").select(F.explode(F.array(*map(F.lit, MISSING_DISH))).alias("o_orderstatus"), "p_type", "p_retailprice")
    lacks = F.element_at(F.create_map(*[F.lit(x) for kv in MISSING_DISH.items() for x in kv]), F.col("o_orderstatus"))
    more = F.element_at(F.create_map(*[F.lit(x) for i, k in enumerate(MISSING_DISH) for x in (k, i)]), F.col("o_orderstatus"))
    price = F.round(F.avg(F.col("p_retailprice").cast("decimal(12,2)")), 2) + more
    menu = menu.where(F.col("p_type") != lacks).groupBy("o_orderstatus", F.col("p_type").alias("item")).agg(price.alias("price"))
    dishes = F.filter(F.array(*map(F.lit, DISHES)), lambda d: d != lacks)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", dishes.alias("d"), lacks.alias("lacks"))
    first = F.element_at("d", (F.col("o_orderkey") % 5 + 1).cast("int"))
    second = F.element_at("d", ((F.col("o_orderkey") + 1 + F.col("o_custkey") % 4) % 5 + 1).cast("int"))
    pair = lambda b: F.array(
        F.struct(first.alias("item"), (F.col("o_custkey") % 7 + 1).cast("int").alias("qty")),
        F.struct(b.alias("item"), (F.col("o_orderkey") % 4 + 1).cast("int").alias("qty")))
    dirty = F.when(F.col("o_custkey") % 4 == 0, F.col("lacks")).otherwise(second)
    meals = orders.select("o_orderkey", "o_orderstatus", pair(second).alias("clean"), pair(dirty).alias("items"))
    return C.recompute_total(meals, ["o_orderkey"], "clean", menu, "total", group="o_orderstatus"), menu


@query("repair_items_by_menu", f"""
    WITH s AS (SELECT * FROM (VALUES {', '.join(f"('{k}', '{v}', {i})" for i, (k, v) in enumerate(MISSING_DISH.items()))}) AS v(status, lacks, more)),
    menu AS (SELECT status, p_type, CAST(round(avg(CAST(p_retailprice AS DECIMAL(12,2))), 2) AS DECIMAL(12,2)) + any_value(more) AS price
             FROM part, s WHERE p_type <> lacks GROUP BY 1, 2),
    d AS (SELECT o_orderkey, status, o_custkey % 7 + 1 AS qa, o_orderkey % 4 + 1 AS qb, list_filter({_DISH_SQL}, lambda x: x <> lacks) AS l, o_custkey
          FROM orders JOIN s ON o_orderstatus = status),
    m AS (SELECT *, l[CAST(o_orderkey % 5 + 1 AS INT)] AS a, l[CAST((o_orderkey + 1 + o_custkey % 4) % 5 + 1 AS INT)] AS b FROM d)
    SELECT o_orderkey, a || ':' || qa || ',' || b || ':' || qb AS items, CAST(x.price * qa + y.price * qb AS DOUBLE) AS total
    FROM m JOIN menu x ON x.status = m.status AND a = x.p_type JOIN menu y ON y.status = m.status AND b = y.p_type""")
def repair_items_by_menu(spark, sf):
    meals, menu = _meals_by_status(spark, sf)
    fixed = C.repair_items(meals, ["o_orderkey"], "items", "total", menu, group="o_orderstatus")
    text = F.array_join(F.transform("items", lambda e: F.concat_ws(":", e["item"], e["qty"].cast("string"))), ",")
    return fixed.select("o_orderkey", text.alias("items"), F.col("total").cast("double").alias("total"))


_FIT_SQL = f"""
    WITH lines AS ({_LINES_SQL}),
         s AS (SELECT l_returnflag, l_linestatus, count(*) AS n, avg(l_extendedprice) AS my, avg(l_quantity) AS m1,
                      avg(l_discount) AS m2, avg(l_linenumber) AS m3, var_pop(l_quantity) AS a11, var_pop(l_discount) AS a22,
                      var_pop(l_linenumber) AS a33, covar_pop(l_quantity, l_discount) AS a12,
                      covar_pop(l_quantity, l_linenumber) AS a13, covar_pop(l_discount, l_linenumber) AS a23,
                      covar_pop(l_quantity, l_extendedprice) AS b1, covar_pop(l_discount, l_extendedprice) AS b2,
                      covar_pop(l_linenumber, l_extendedprice) AS b3 FROM lines
               WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL GROUP BY 1, 2),
         d AS (SELECT *, a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det FROM s),
         c AS (SELECT *, (b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3)) / det AS c1,
                      (a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13)) / det AS c2,
                      (a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13)) / det AS c3 FROM d),
         fit AS (SELECT *, my - c1 * m1 - c2 * m2 - c3 * m3 AS c0 FROM c)"""
_FEATURES = ["l_quantity", "l_discount", "l_linenumber"]


def _fit(spark, sf):
    fit = C.group_linear_fit(_gappy_lines(spark, sf), ["l_returnflag", "l_linestatus"], _FEATURES, "l_extendedprice")
    return cut_lineage(fit)     # one row per group, used by several branches


@query("group_linear_fit", f"""{_FIT_SQL}
    SELECT l_returnflag, l_linestatus, n, round(c1, 3) AS c1, round(c2, 3) AS c2, round(c3, 3) AS c3, round(c0, 3) AS c0 FROM fit""")
def group_linear_fit(spark, sf):
    coefs = [F.round(F.col("coefs")[i], 3).alias(f"c{i + 1}") for i in range(3)]
    return _fit(spark, sf).select("l_returnflag", "l_linestatus", "n", *coefs, F.round("intercept", 3).alias("c0"))


_RESIDUAL_SQL = f"""{_FIT_SQL},
    r AS (SELECT l.l_returnflag, l_linestatus, l_orderkey, l_partkey, l_suppkey, l.l_linenumber, l.l_extendedprice,
                 c0 + c1 * l_quantity + c2 * l_discount + c3 * l_linenumber AS pred
          FROM lines l LEFT JOIN fit f USING (l_linestatus) WHERE l.l_returnflag IS NOT DISTINCT FROM f.l_returnflag)"""


def _scored_lines(spark, sf):
    return C.predict_linear(_gappy_lines(spark, sf), _fit(spark, sf), ["l_returnflag", "l_linestatus"], _FEATURES)


@query("residual_outliers", f"""{_RESIDUAL_SQL},
    e AS (SELECT *, l_extendedprice - pred AS res FROM r),
    q AS (SELECT l_returnflag, l_linestatus, quantile_cont(res, 0.25) AS q1, quantile_cont(res, 0.75) AS q3 FROM e GROUP BY 1, 2)
    SELECT e.l_returnflag, e.l_linestatus, count(*) AS n, count(*) FILTER (WHERE res IS NULL) AS n_unknown,
           count(*) FILTER (WHERE res < q1 - 0.5 * (q3 - q1) OR res > q3 + 0.5 * (q3 - q1)) AS n_outliers
    FROM e JOIN q ON e.l_linestatus = q.l_linestatus AND e.l_returnflag IS NOT DISTINCT FROM q.l_returnflag GROUP BY 1, 2""")
def residual_outliers(spark, sf):
    scored = _scored_lines(spark, sf).withColumn("res", F.col("l_extendedprice") - F.col("pred"))
    marked = C.mark_outliers(scored.select("l_returnflag", "l_linestatus", "res"), "res", ["l_returnflag", "l_linestatus"], t=0.5)
    return marked.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.count_if(F.col("is_outlier").isNull()).alias("n_unknown"), F.sum("is_outlier").alias("n_outliers"))


@query("ratio_flag", f"""{_RESIDUAL_SQL}
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN pred / l_extendedprice >= 1.5 THEN 1 ELSE 0 END AS loyal FROM r""")
def ratio_flag(spark, sf):
    return _scored_lines(spark, sf).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        N.ratio_flag(F.col("pred"), F.col("l_extendedprice")).alias("loyal"))


@query("update_rows", """
    SELECT s_suppkey, CASE WHEN s_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_3')
               THEN (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_4') ELSE s_nationkey END AS s_nationkey,
           CASE WHEN s_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_3')
               THEN round(s_acctbal / 2, 4) ELSE s_acctbal END AS s_acctbal FROM supplier""")
def update_rows(spark, sf):
    nation = table(spark, sf, "nation")
    of = lambda name: nation.where(F.col("n_name") == name).select("n_nationkey").scalar()
    out = M.update_rows(table(spark, sf, "supplier"), F.col("s_nationkey") == of("NATION_3"), {
        "s_acctbal": F.round(F.col("s_acctbal") / 2, 4), "s_nationkey": of("NATION_4")})
    return out.select("s_suppkey", "s_nationkey", "s_acctbal")


@query("delete_cascade", """
    WITH gone AS (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_5')
    SELECT 'orders' AS table_name, o_orderkey AS key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)
    UNION ALL SELECT 'customer', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM gone)""")
def delete_cascade(spark, sf):
    customer = table(spark, sf, "customer")
    which = table(spark, sf, "nation").where("n_name = 'NATION_5'").select("n_nationkey").scalar()
    doomed = customer.where(F.col("c_nationkey") == which).select("c_custkey")
    child, parent = M.delete_cascade(customer, table(spark, sf, "orders"), "c_custkey", "o_custkey", doomed)
    return (child.select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("key"))
            .unionByName(parent.select(F.lit("customer").alias("table_name"), F.col("c_custkey").alias("key"))))


@query("bridge_table", """
    SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS member, 1 AS role_no FROM orders WHERE o_custkey % 10 <> 0
    UNION ALL SELECT o_orderkey, o_custkey + 1000000, 2 FROM orders WHERE o_orderstatus = 'P'""")
def bridge_table(spark, sf):
    orders = table(spark, sf, "orders").withColumn("member", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")))
    helpers = orders.where("o_orderstatus = 'P'").select(
        "o_orderkey", (F.col("o_custkey") + 1000000).alias("member"), F.lit(2).alias("role_no"))
    return M.bridge_table(orders, "o_orderkey", "member", 1, helpers)


@query("add_column_update", """
    SELECT p_partkey, p_size, p_size // 2 AS re_order_level FROM part""")
def add_column_update(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size").withColumn(
        "re_order_level", F.floor(F.col("p_size") / 2).cast("int"))


@query("surrogate_keys", """
    SELECT o_orderkey, 200000 + 10 * (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS adm_no FROM orders""")
def surrogate_keys(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return O.surrogate_keys(orders, ["o_orderdate", "o_orderkey"], "adm_no").select("o_orderkey", "adm_no")


@query("constraint_report", """
    WITH d AS (SELECT o_orderkey - o_orderkey % 2 * (o_orderkey % 100 = 1)::INT AS id, CASE WHEN o_custkey % 50 = 0 THEN NULL WHEN o_custkey % 37 = 5 THEN -o_custkey ELSE o_custkey END AS cust,
                      CASE WHEN o_orderkey % 40 = 7 THEN 'X' ELSE o_orderstatus END AS status, o_totalprice AS price FROM orders)
    SELECT 'not_null(cust)' AS constraint_name, count(*) FILTER (WHERE cust IS NULL) AS n_violations FROM d
    UNION ALL SELECT 'not_null(status)', count(*) FILTER (WHERE status IS NULL) FROM d
    UNION ALL SELECT 'check(status in)', count(*) FILTER (WHERE status NOT IN ('O', 'F', 'P')) FROM d
    UNION ALL SELECT 'check(price range)', count(*) FILTER (WHERE NOT price BETWEEN 1000 AND 400000) FROM d
    UNION ALL SELECT 'unique(id)', (SELECT count(*) FROM (SELECT id FROM d GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'foreign(cust)', count(*) FILTER (WHERE cust NOT IN (SELECT c_custkey FROM customer)) FROM d""")
def constraint_report(spark, sf):
    d = table(spark, sf, "orders").selectExpr(
        "if(o_orderkey % 100 = 1, o_orderkey - o_orderkey % 2, o_orderkey) as id",
        "case when o_custkey % 50 = 0 then null when o_custkey % 37 = 5 then -o_custkey else o_custkey end as cust", "if(o_orderkey % 40 = 7, 'X', o_orderstatus) as status",
        "o_totalprice as price")
    return M.constraint_report(
        d, unique=[["id"]], not_null=["cust", "status"],
        checks={"status in": F.col("status").isin("O", "F", "P"), "price range": F.col("price").between(1000, 400000)},
        foreign=[("cust", table(spark, sf, "customer"), "c_custkey")])


@query("reject_rows", """
    SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 AND c_nationkey % 2 = 0 THEN 'rejected' ELSE 'accepted' END AS verdict FROM customer""")
def reject_rows(spark, sf):
    names = table(spark, sf, "customer").select(
        "c_custkey", F.expr("if(c_custkey % 6 = 0, null, c_name)").alias("first"),
        F.expr("if(c_nationkey % 2 = 0, null, c_mktsegment)").alias("last"))
    good, bad = M.reject_rows(names, F.col("first").isNull() & F.col("last").isNull())
    return (good.select("c_custkey", F.lit("accepted").alias("verdict"))
            .unionByName(bad.select("c_custkey", F.lit("rejected").alias("verdict"))))


@query("snapshot_diff", """
    WITH old AS (SELECT p_partkey, CASE WHEN p_partkey % 23 > 0 THEN p_brand END AS p_brand, CASE WHEN p_partkey % 23 > 0 THEN p_size END AS p_size
                 FROM part WHERE p_partkey % 19 > 0),
         new AS (SELECT p_partkey, CASE WHEN p_partkey % 23 > 0 THEN p_brand || CASE WHEN p_partkey % 13 = 0 THEN '-new' ELSE '' END END AS p_brand,
                        CASE WHEN p_partkey % 23 > 0 THEN p_size + CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END END AS p_size FROM part WHERE p_partkey % 11 > 0),
         b AS (SELECT coalesce(o.p_partkey, n.p_partkey) AS p_partkey, o.p_partkey IS NULL OR n.p_partkey IS NULL AS alone, o.p_brand AS ob, n.p_brand AS nb,
                      CAST(o.p_size AS VARCHAR) AS os, CAST(n.p_size AS VARCHAR) AS ns FROM old o FULL JOIN new n ON o.p_partkey = n.p_partkey)
    SELECT p_partkey, 'p_brand' AS column_name, ob AS old_value, nb AS new_value FROM b WHERE alone OR ob IS DISTINCT FROM nb
    UNION ALL SELECT p_partkey, 'p_size', os, ns FROM b WHERE alone OR os IS DISTINCT FROM ns""")
def snapshot_diff(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.expr("if(p_partkey % 23 > 0, p_brand, null)").alias("p_brand"),
                                           F.expr("if(p_partkey % 23 > 0, p_size, null)").alias("p_size"))
    new = part.withColumns({"p_brand": F.expr("if(p_partkey % 13 = 0, concat(p_brand, '-new'), p_brand)"),
                            "p_size": F.expr("if(p_partkey % 17 = 0, p_size + 1, p_size)")})
    return M.snapshot_diff(part.where("p_partkey % 19 > 0"), new.where("p_partkey % 11 > 0"), "p_partkey", ["p_brand", "p_size"])


@query("audit_versions", """
    SELECT 'p_brand' AS column_name, count(*) FILTER (WHERE p_partkey % 19 = 0 OR p_partkey % 11 = 0 OR p_partkey % 13 = 0) AS n_changed FROM part
    WHERE p_partkey % 19 > 0 OR p_partkey % 11 > 0""")
def audit_versions(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    new = part.withColumn("p_brand", F.expr("if(p_partkey % 13 = 0, null, p_brand)"))
    return C.audit(part.where("p_partkey % 19 > 0"), new.where("p_partkey % 11 > 0"), ["p_partkey"], ["p_brand"])


@query("stock_after_usage", """
    SELECT p_partkey, p_size * 100 - coalesce(used, 0) AS stock_left FROM part
    LEFT JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS used FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
    ON p_partkey = l_partkey""")
def stock_after_usage(spark, sf):
    stock = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 100).cast("bigint").alias("stock"))
    usage = table(spark, sf, "lineitem").where("l_returnflag = 'N'").select("l_partkey", F.col("l_quantity").cast("bigint").alias("q"))
    return M.stock_after_usage(stock, usage, "p_partkey", "stock", "l_partkey", "q").select("p_partkey", "stock_left")
