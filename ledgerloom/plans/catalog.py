"""The operators at work on the shipped tables, and the same in DuckDB SQL.

Inputs are one SQL text for both engines; what differs is the operator: DataFrame calls here, plain
SQL in the oracle. Amounts are rounded to cents (rates to six places) on both sides."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures, periods, rules, text
from ..operators import fill, flows, graph, partition, quality, resolve, select

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """A query over {table} names, each read from its parquet."""
    names = sorted(set(re.findall(r"\{(\w+)\}", query)))
    return spark.sql(query, **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names})


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = re.sub(r"\{(\w+)\}", r"\1", oracle)
        return f

    return keep


def cents(c: str | Column) -> Column:
    return F.round(c, 2)


DAY = "CAST(o_orderdate AS DATE)"
PANEL = f"""
    SELECT c_nationkey AS nation, last_day(make_date(year({DAY}), quarter({DAY}) * 3, 1)) AS period,
        round(sum(o_totalprice), 2) AS total, count(*) AS n,
        round(sum(CASE WHEN o_orderpriority LIKE '1%' THEN o_totalprice END), 2) AS urgent,
        round(sum(CASE WHEN o_orderpriority LIKE '2%' THEN o_totalprice END), 2) AS high,
        round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS finished
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey GROUP BY 1, 2"""
YTD = f"SELECT nation, period, round(sum(total) OVER (PARTITION BY nation, year(period) ORDER BY period), 2) AS ytd FROM ({PANEL}) p"
GAPPED = f"SELECT * FROM ({YTD}) y WHERE quarter(period) = 1 OR (nation + year(period)) % 3 <> quarter(period) - 2"
RESTARTED = f"SELECT nation, period, CASE WHEN nation % 3 = 0 AND quarter(period) = 3 THEN floor(ytd * 0.125) ELSE ytd END AS ytd FROM ({YTD}) y"
SIDES = "SELECT l_suppkey AS s, l_returnflag AS f, l_linestatus AS t, CAST(l_shipdate AS DATE) AS d, l_extendedprice AS v, l_partkey AS p, l_orderkey AS o, l_linenumber AS i FROM {lineitem}"


# ---- selection and deduplication ----


@query("""
    SELECT user_id, event_type, CAST(ts AS DATE) AS day, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS event_id,
        arg_max(value, struct_pack(a := ts, b := event_id)) AS value, count(*) AS n_versions,
        abs(max(value) - min(value)) / greatest(abs(max(value)), 1.0) > 0.005 AS restated
    FROM events GROUP BY 1, 2, 3""")
def dedup_latest_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "SELECT user_id, event_type, CAST(ts AS DATE) AS day, ts, event_id, value FROM {events}")
    return select.deduplicate(df, ["user_id", "event_type", "day"], "value", ["ts", "event_id"]).drop("ts")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS r FROM lineitem) x WHERE r = 1")
def topk_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_extendedprice FROM {lineitem}")
    return select.top_one(df, ["l_orderkey"], F.desc("l_extendedprice"), F.asc("l_linenumber"))


CUTS = f"""
    SELECT s, CASE WHEN s % 3 = 0 THEN 'old' ELSE 'new' END AS tag, 'returnflag' AS axes, f AS member, round(sum(v), 2) AS v FROM ({SIDES}) x WHERE s % 4 <> 1 GROUP BY 1, 2, 3, 4
    UNION ALL SELECT s, 'new', 'linestatus', t, round(sum(v), 2) FROM ({SIDES}) x WHERE s % 5 <> 2 AND d < DATE '1998-01-01' GROUP BY 1, 4
    UNION ALL SELECT s, 'new', 'linestatus|returnflag', concat(f, t), round(sum(v), 2) FROM ({SIDES}) x GROUP BY 1, 4"""
SIGNATURE = """
    WITH c AS ({cuts}), p AS (
        SELECT s, tag, axes, -round(sum(abs(v)), 2) AS less, CASE tag WHEN 'new' THEN 1 ELSE 2 END AS k, len(string_split(axes, '|')) AS n FROM c GROUP BY s, tag, axes
    ), r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY k, {order}, axes) AS r FROM p)
    SELECT c.* FROM c JOIN r ON r.r = 1 AND c.s = r.s AND c.tag = r.tag AND c.axes = r.axes"""


@query(SIGNATURE.replace("{cuts}", CUTS).replace("{order}", "n, less"))
def best_signature_parsimony(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.best_signature(read(spark, sf_dir, CUTS), ["s"], "tag", "axes", "v", ["new", "old"])


@query(SIGNATURE.replace("{cuts}", CUTS).replace("{order}", "less, n"))
def best_signature_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.best_signature(read(spark, sf_dir, CUTS), ["s"], "tag", "axes", "v", ["new", "old"], prefer="coverage")


MEMBERS = "SELECT l_suppkey AS s, l_returnflag AS m, l_linenumber AS w, l_quantity AS v, l_shipdate AS filed, l_orderkey AS o FROM {lineitem}"


@query(f"""
    WITH x AS (SELECT s, m, w, arg_max(v, struct_pack(a := filed, b := o, c := v)) AS v FROM ({MEMBERS}) y GROUP BY 1, 2, 3)
    SELECT s, sum(DISTINCT v) AS quantity FROM x GROUP BY s""")
def member_sum_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.sum_members(read(spark, sf_dir, MEMBERS), ["s"], ["m", "w"], "v", ["filed", "o"], "quantity")


@query(f"SELECT p, o, i, v FROM (SELECT *, max(abs(v)) OVER (PARTITION BY p) AS big FROM ({SIDES}) x) y WHERE big <= 0 OR abs(v) * 10 >= big")
def drop_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.drop_fragments(read(spark, sf_dir, SIDES), ["p"], "v").select("p", "o", "i", "v")


@query(f"""
    WITH a AS (SELECT nation, period, urgent AS x, CASE WHEN nation % 2 = 0 THEN finished END AS y FROM ({PANEL}) p WHERE nation % 3 <> 0),
        b AS (SELECT nation, period, total AS x, total AS y FROM ({PANEL}) p WHERE nation % 3 <> 1)
    SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.period, b.period) AS period, coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y
    FROM a FULL JOIN b ON a.nation = b.nation AND a.period = b.period""")
def fill_nulls_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, PANEL)
    a = p.where("nation % 3 <> 0").select("nation", "period", F.col("urgent").alias("x"), F.when(F.col("nation") % 2 == 0, F.col("finished")).alias("y"))
    b = p.where("nation % 3 <> 1").select("nation", "period", F.col("total").alias("x"), F.col("total").alias("y"))
    return select.fill_from(a, b, ["nation", "period"])


# ---- periods and flows ----


@query(f"""
    SELECT o_orderkey, year(d) AS year, quarter(d) AS qtr, concat(year(d), 'Q', quarter(d)) AS quarter, last_day(make_date(year(d), quarter(d) * 3, 1)) AS q_end,
        CAST(date_trunc('quarter', d) AS DATE) - 1 AS q_before, month(d) IN (3, 6, 9, 12) AND day(d) >= 28 AS at_end
    FROM (SELECT o_orderkey, {DAY} AS d FROM {{orders}}) x""")
def quarter_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = periods.with_period_labels(read(spark, sf_dir, f"SELECT o_orderkey, {DAY} AS d FROM {{orders}}"), "d")
    d = F.col("d")
    return df.select("o_orderkey", "year", "qtr", "quarter", periods.quarter_end(d).alias("q_end"), periods.previous_quarter_end(d).alias("q_before"), periods.is_quarter_end(d).alias("at_end"))


@query(f"""
    SELECT o_orderkey, CASE WHEN {DAY} >= CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN DATE '1999-10-01' ELSE DATE '1998-01-01' END
        THEN 'CECL' ELSE 'incurred_loss' END AS basis FROM {{orders}}""")
def basis_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, f"SELECT o_orderkey, {DAY} AS d, CASE WHEN o_custkey % 5 = 0 THEN NULL WHEN o_custkey % 5 = 1 THEN DATE '1999-10-01' ELSE DATE '1998-01-01' END AS adopted FROM {{orders}}")
    return df.select("o_orderkey", periods.basis_label(F.col("d"), F.col("adopted")).alias("basis"))


QUARTERISED = """
    WITH y AS ({input}), x AS (
        SELECT *, quarter(period) = 1 AS first, lag(ytd) OVER w AS b,
            coalesce(year(lag(period) OVER w) = year(period) AND quarter(lag(period) OVER w) = quarter(period) - 1, false) AS joined
        FROM y WINDOW w AS (PARTITION BY nation ORDER BY period)
    ), z AS (SELECT *, NOT first AND joined AND coalesce(b - ytd > 0.5, false) AS flow_reset FROM x)
    SELECT nation, period, flow_reset, round(CASE WHEN first OR flow_reset THEN ytd WHEN joined THEN ytd - b END, 2) AS ytd FROM z"""


def _quarterised(spark: SparkSession, sf_dir: str, source: str, **more) -> DataFrame:
    out = flows.quarterise(read(spark, sf_dir, source), "nation", "period", ["ytd"], **more)
    return out.select("nation", "period", "flow_reset", cents("ytd").alias("ytd"))


@query(QUARTERISED.replace("{input}", YTD))
def ytd_to_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarterised(spark, sf_dir, YTD)


@query(QUARTERISED.replace("{input}", GAPPED))
def ytd_gap_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarterised(spark, sf_dir, GAPPED)


@query(QUARTERISED.replace("{input}", RESTARTED))
def ytd_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarterised(spark, sf_dir, RESTARTED)


@query(f"""
    WITH q AS ({QUARTERISED.replace("{input}", YTD)}), y AS ({YTD})
    SELECT q.nation, q.period, flow_reset, round(q.ytd - coalesce(CASE WHEN q.nation % 4 = 0 AND q.period = DATE '1997-09-30' AND NOT flow_reset THEN y.ytd END, 0), 2) AS ytd
    FROM q LEFT JOIN y ON y.nation = q.nation + 1 AND y.period = DATE '1997-06-30'""")
def pooled_adjustment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = read(spark, sf_dir, "SELECT n_nationkey AS nation, n_nationkey + 1 AS predecessor, DATE '1997-09-30' AS period FROM {nation} WHERE n_nationkey % 4 = 0")
    return _quarterised(spark, sf_dir, YTD, pooled=pooled)


FACTS = f"""
    SELECT nation, make_date(year(period), 1, 1) AS starts, period, ytd AS v, year(period) * 10 + 1 AS filed FROM ({YTD}) y
    UNION ALL SELECT nation, CAST(date_trunc('quarter', period) AS DATE), period, total + 1, year(period) * 10 FROM ({PANEL}) p WHERE nation % 2 = 0 AND quarter(period) <> 3"""


@query(f"""
    WITH f AS (SELECT *, date_diff('day', starts, period) AS span FROM ({FACTS}) x),
    n AS (SELECT nation, starts, period, v, filed, 'reported' AS basis FROM f WHERE span BETWEEN 80 AND 100),
    c AS (SELECT *, row_number() OVER (PARTITION BY nation, starts, period ORDER BY filed DESC NULLS LAST, v DESC) AS r FROM f),
    l AS (SELECT *, span - lag(span) OVER w AS implied, v - lag(v) OVER w AS step FROM c WHERE r = 1 WINDOW w AS (PARTITION BY nation, starts ORDER BY period)),
    u AS (SELECT * FROM n UNION ALL SELECT nation, starts, period, step, filed, 'derived' FROM l WHERE implied BETWEEN 80 AND 100),
    b AS (SELECT *, row_number() OVER (PARTITION BY nation, period ORDER BY basis DESC, filed DESC NULLS LAST, starts, v DESC) AS r FROM u)
    SELECT nation, period, basis, round(v, 2) AS v FROM b WHERE r = 1""")
def reported_vs_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = flows.reported_or_derived(read(spark, sf_dir, FACTS), ["nation"], "starts", "period", "v", "filed")
    return out.select("nation", "period", "basis", cents("v").alias("v"))


# ---- partitions ----

PARTS = f"""
    SELECT s, f AS category, round(sum(v), 2) AS v FROM ({SIDES}) x GROUP BY 1, 2
    UNION ALL SELECT s, 'total', round(sum(v) * CASE WHEN s % 3 = 0 THEN 1.0 ELSE 1.5 END, 2) FROM ({SIDES}) x WHERE s % 3 <> 2 GROUP BY s"""
TREE = {"total": None, "A": "total", "N": "total", "R": "total"}


@query(f"""
    WITH p AS ({PARTS}), b AS (SELECT s, sum(v) AS below FROM p WHERE category <> 'total' GROUP BY s)
    SELECT p.s, round(sum(CASE WHEN category = 'total' AND below <> 0 AND abs(v - below) <= abs(v) * 0.001 THEN 0 ELSE v END), 2) AS total FROM p LEFT JOIN b ON p.s = b.s GROUP BY p.s""")
def partition_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = partition.partition_total(read(spark, sf_dir, PARTS), ["s"], "category", "v", rules.closure(spark, TREE), "total")
    return out.select("s", cents("total").alias("total"))


@query(f"""
    WITH r AS (SELECT s, v FROM ({PARTS}) p WHERE category = 'total' AND s % 2 = 0), b AS (SELECT s, sum(v) AS v FROM ({PARTS}) p WHERE category <> 'total' GROUP BY s)
    SELECT coalesce(r.s, b.s) AS s, round(coalesce(r.v, b.v), 2) AS v FROM r FULL JOIN b ON r.s = b.s""")
def total_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, PARTS)
    built = p.where("category <> 'total'").groupBy("s").agg(F.sum("v").alias("v"))
    out = partition.with_fallback(p.where("category = 'total' and s % 2 = 0").select("s", "v"), built, ["s"], "v")
    return out.select("s", cents("v").alias("v"))


LEVELS = "SELECT o_custkey AS c, substr(o_orderpriority, 1, 1) AS b, o_totalprice AS v FROM {orders}"


@query(f"""
    WITH w AS (SELECT c, {", ".join(f"sum(CASE WHEN b = '{b}' THEN v END) AS cq_{b}" for b in "1234")} FROM ({LEVELS}) x GROUP BY c)
    SELECT c, {", ".join(f"round(cq_{b}, 2) AS cq_{b}" for b in "1234")},
        round(CASE WHEN cq_2 IS NOT NULL OR cq_3 IS NOT NULL THEN coalesce(cq_2, 0) + coalesce(cq_3, 0) END, 2) AS cq_classified,
        round(CASE WHEN coalesce(cq_1, cq_2, cq_3) IS NOT NULL THEN coalesce(cq_1, 0) + coalesce(cq_2, 0) + coalesce(cq_3, 0) END, 2) AS cq_criticized FROM w""")
def ladder_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = partition.ladder(read(spark, sf_dir, LEVELS), ["c"], "b", "v", list("1234"), "cq_", {"classified": ["2", "3"], "criticized": ["1", "classified"]})
    return out.select("c", *(cents(x).alias(x) for x in out.columns[1:]))


BOOK = f"""
    SELECT s, round(sum(v), 2) AS total, round(sum(CASE WHEN f = 'A' THEN v END), 2) AS a, round(sum(CASE WHEN f = 'N' THEN v END), 2) AS n,
        round(sum(CASE WHEN f = 'R' AND s % 4 <> 0 THEN v END), 2) AS r, CASE WHEN s % 7 = 0 THEN 1 ELSE 0 END AS backfilled FROM ({SIDES}) x GROUP BY s"""


@query(f"""
    WITH b AS ({BOOK}), c AS (SELECT *, CASE WHEN backfilled = 0 AND coalesce(a, n, r) IS NOT NULL THEN coalesce(a, 0) + coalesce(n, 0) + coalesce(r, 0) - total END AS g FROM b)
    SELECT s, round(g, 2) + 0.0 AS residual, round(CASE WHEN abs(total) > 0 THEN g / total * 100 END, 6) + 0.0 AS pct, round(-g, 2) + 0.0 AS unallocated FROM c""")
def partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = partition.partition_check(read(spark, sf_dir, BOOK), ["a", "n", "r"], "total", unless="backfilled")
    return out.select("s", (cents("partition_residual") + 0.0).alias("residual"), (F.round("partition_residual_pct", 6) + 0.0).alias("pct"), (cents("unallocated") + 0.0).alias("unallocated"))


@query(f"SELECT s, a IS NULL OR r IS NULL AS built, round(coalesce(r, coalesce(a, 0) + coalesce(n, 0)), 2) AS r, round(coalesce(a, n), 2) AS a FROM ({BOOK}) b WHERE coalesce(a, n) IS NOT NULL")
def built_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, f"SELECT * FROM ({BOOK}) b WHERE coalesce(a, n) IS NOT NULL")
    out = partition.built_totals(df, {"a": ["n"], "r": ["a", "n"]}, "built")
    return out.select("s", "built", cents("r").alias("r"), cents("a").alias("a"))


# ---- measures ----


@query(f"""
    SELECT nation, period, round(CASE WHEN abs(total) > 0 THEN urgent / total END * 100, 6) AS urgent_pct, round(CASE WHEN abs(total) > 0 THEN finished / total END * 400, 6) AS finished_rate
    FROM ({PANEL}) p""")
def ratios_annualised(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.with_ratios(read(spark, sf_dir, PANEL), {"urgent_pct": ("urgent", "total", False), "finished_rate": ("finished", "total", True), "absent": ("nowhere", "total", False)})
    return out.select("nation", "period", *(F.round(c, 6).alias(c) for c in ("urgent_pct", "finished_rate")))


@query(f"""
    SELECT nation, period, round(CASE WHEN lag(total) OVER w > 0 THEN (pow(total / lag(total) OVER w, 4) - 1) * 100 END, 4) AS total_qoq,
        round(CASE WHEN lag(total, 4) OVER w > 0 THEN (total / lag(total, 4) OVER w - 1) * 100 END, 4) AS total_yoy
    FROM ({PANEL}) p WINDOW w AS (PARTITION BY nation ORDER BY period)""")
def growth_qoq_yoy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.with_growth(read(spark, sf_dir, PANEL), ["total"], ["nation"])
    return out.select("nation", "period", F.round("total_qoq", 4).alias("total_qoq"), F.round("total_yoy", 4).alias("total_yoy"))


@query(f"""
    SELECT s, round(CASE WHEN coalesce(a, r) IS NOT NULL THEN coalesce(a, 0) + coalesce(r, 0) END, 2) AS group_sum, round(CASE WHEN a IS NOT NULL THEN a + coalesce(r, 0) END, 2) AS npa,
        round(coalesce(r, n - a), 2) AS net, round(coalesce(r, CASE WHEN a IS NOT NULL AND n IS NOT NULL AND a + n <> 0 THEN a + n END), 2) AS rolled FROM ({BOOK}) b""")
def null_aware_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, n, r = F.col("a"), F.col("n"), F.col("r")
    made = {"group_sum": measures.null_aware_sum(a, r), "npa": measures.npa(a, r), "net": measures.net_of(n, a, r), "rolled": measures.rolled_up(r, [a, n])}
    return read(spark, sf_dir, BOOK).select("s", *(cents(v).alias(k) for k, v in made.items()))


# ---- resolution of items ----

ITEMS = [
    resolve.Item("loans", (("total",), ("A", "N", "R")), ("O", "F"), ("even", "odd")),
    resolve.Item("first_r", (("none",), ("R",)), ("F", "O"), ("odd", "even"), prefer="first"),
    resolve.Item("with_plus", (("A",),), ("O",), ("even", "odd"), plus="F"),
]
LONG = f"""
    SELECT s, CASE WHEN s % 2 = 0 THEN 'even' ELSE 'odd' END AS schedule, t AS prefix, f AS item, round(sum(v), 0) AS value FROM ({SIDES}) x WHERE s % 5 <> 0 OR f <> 'N' GROUP BY 1, 2, 3, 4
    UNION ALL SELECT s, CASE WHEN s % 2 = 0 THEN 'odd' ELSE 'even' END, 'F', 'total', round(sum(v), 0) FROM ({SIDES}) x WHERE s % 3 = 0 GROUP BY 1"""


@query(f"""
    WITH l AS ({LONG}),
    g AS (SELECT s, item, arg_min(value, (CASE prefix WHEN 'O' THEN 0 ELSE 1 END) * 2 + (CASE schedule WHEN 'even' THEN 0 ELSE 1 END)) AS v,
        arg_min(value, (CASE prefix WHEN 'F' THEN 0 ELSE 1 END) * 2 + (CASE schedule WHEN 'odd' THEN 0 ELSE 1 END)) AS w,
        sum(CASE WHEN prefix = 'O' THEN value END) AS o, sum(CASE WHEN prefix = 'F' THEN value END) AS fv FROM l GROUP BY 1, 2),
    k AS (SELECT s, max(CASE WHEN item = 'total' THEN v END) AS t, count(CASE WHEN item = 'total' THEN 1 END) AS nt, sum(CASE WHEN item IN ('A', 'N', 'R') THEN v END) AS p,
        count(CASE WHEN item IN ('A', 'N', 'R') THEN 1 END) AS np, max(CASE WHEN item = 'R' THEN w END) AS r, max(CASE WHEN item = 'A' THEN o END) AS ao, max(CASE WHEN item = 'A' THEN fv END) AS af FROM g GROUP BY s)
    SELECT s, CASE WHEN np > nt THEN p ELSE t END * 1000 AS loans, r * 1000 AS first_r, CASE WHEN coalesce(ao, af) IS NOT NULL THEN coalesce(ao, 0) + coalesce(af, 0) END * 1000 AS with_plus FROM k""")
def variant_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_items(read(spark, sf_dir, LONG), ITEMS, ["s"])


# ---- graph, claims, rollups ----

EDGES = f"SELECT o_custkey AS parent, o_orderkey AS child, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE {DAY} END AS start, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE {DAY} + 200 END AS ends FROM {{orders}}"
DAYS = f"SELECT DISTINCT last_day(make_date(year({DAY}), quarter({DAY}) * 3, 1)) AS period FROM {{orders}} WHERE {DAY} BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'"


@query(f"SELECT period, parent, child FROM ({EDGES}) e JOIN ({DAYS}) d ON (start IS NULL OR start <= period) AND (ends IS NULL OR ends >= period)")
def asof_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = read(spark, sf_dir, EDGES.replace(f"{DAY} + 200", f"date_add({DAY}, 200)")).withColumnRenamed("ends", "end")
    return graph.edges_at(edges, read(spark, sf_dir, DAYS))


@query("""
    WITH RECURSIVE e AS (SELECT c_custkey // 2 AS parent, c_custkey AS child FROM customer WHERE c_custkey > 1),
    w AS (SELECT s_suppkey AS root, s_suppkey AS node, 0 AS depth FROM supplier UNION SELECT root, child, depth + 1 FROM w JOIN e ON node = parent WHERE depth < 4)
    SELECT root, node, min(depth) AS depth FROM w GROUP BY 1, 2""")
def bounded_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = read(spark, sf_dir, "SELECT c_custkey DIV 2 AS parent, c_custkey AS child, 1 AS g FROM {customer} WHERE c_custkey > 1")
    roots = read(spark, sf_dir, "SELECT s_suppkey AS root, 1 AS g FROM {supplier}")
    return graph.closure(roots, edges, ["g"], 4).select("root", "node", "depth")


CLAIMS = "SELECT s_suppkey AS rssd, n_nationkey AS holding, CASE WHEN n_regionkey = s_suppkey % 5 THEN 0 ELSE 1 END AS pass FROM {supplier} JOIN {nation} ON (s_suppkey + n_nationkey) % 6 = 0 OR s_nationkey = n_nationkey"


@query(f"SELECT rssd, holding, pass FROM (SELECT *, row_number() OVER (PARTITION BY rssd ORDER BY pass, holding) AS r FROM ({CLAIMS}) c) x WHERE r = 1")
def claim_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.claim_once(read(spark, sf_dir, CLAIMS), ["rssd"], [F.asc("pass"), F.asc("holding")])


CHARTERS = f"SELECT s, round(sum(v), 2) AS total, round(sum(CASE WHEN f = 'R' AND s % 3 = 0 THEN v END), 2) AS part, round(sum(v) / 7, 2) AS weight FROM ({SIDES}) x GROUP BY s"
HOLDERS = "SELECT s_suppkey AS s, s_nationkey AS nation, s_suppkey % 10 = 0 AS failed FROM {supplier}"


@query(f"""
    SELECT nation, round(sum(total), 2) AS total, round(sum(part), 2) AS part, count(DISTINCT c.s) AS n_members,
        array_to_string(list_sort(list(DISTINCT c.s)), ';') AS members, bool_or(failed) AS any_failed,
        round(coalesce(sum(CASE WHEN part IS NOT NULL THEN weight END), 0) / nullif(sum(weight), 0) * 100, 6) AS covered
    FROM ({CHARTERS}) c JOIN ({HOLDERS}) h ON c.s = h.s GROUP BY nation""")
def null_aware_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = graph.roll_up(read(spark, sf_dir, CHARTERS), read(spark, sf_dir, HOLDERS), ["s"], ["nation"], ["total", "part"], "s", {"any_failed": "failed"}, ("covered", "part", "weight"))
    return out.withColumns({"total": cents("total"), "part": cents("part"), "covered": F.round("covered", 6)})


@query("""
    WITH f AS (SELECT o_orderkey AS k, o_totalprice AS v FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT o_orderkey AS k, o_totalprice * 2 AS v FROM orders WHERE o_orderkey % 2 = 0)
    SELECT k, v, 'filed' AS source FROM f UNION ALL SELECT k, v, 'backfill' FROM b WHERE k NOT IN (SELECT k FROM f) AND k IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber > 3)""")
def semi_anti_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    filed = read(spark, sf_dir, "SELECT o_orderkey AS k, o_totalprice AS v FROM {orders} WHERE o_orderkey % 3 <> 0")
    back = read(spark, sf_dir, "SELECT o_orderkey AS k, o_totalprice * 2 AS v FROM {orders} WHERE o_orderkey % 2 = 0")
    return graph.merge_backfill(filed, back, read(spark, sf_dir, "SELECT l_orderkey AS k FROM {lineitem} WHERE l_linenumber > 3"), ["k"])


@query("SELECT l_orderkey AS k, CAST(unnest(list_filter(string_split(array_to_string(list_sort(list(DISTINCT l_partkey)), ';'), ';'), lambda x: len(x) > 0)) AS BIGINT) AS part FROM lineitem GROUP BY 1")
def split_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = read(spark, sf_dir, "SELECT l_orderkey AS k, l_partkey FROM {lineitem}").groupBy("k").agg(graph.ordered_list("l_partkey").alias("parts"))
    return graph.split_ids(lists, "parts", "part").select("k", "part")


@query(f"""
    SELECT CAST(sum(CASE WHEN g <= greatest(1.0, total * 1e-6) THEN 1 ELSE 0 END) AS BIGINT) AS parts_held, count(g) AS parts_checked
    FROM (SELECT abs(a + n + r - total) AS g, total FROM ({BOOK}) b) x""")
def identity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.identity_checks(read(spark, sf_dir, BOOK), {"parts": (["a", "n", "r"], "total")})


@query("""
    SELECT p AS period, s_nationkey AS holding, count(*) AS n_insured_not_filing, array_to_string(list_sort(list(s_suppkey)), ';') AS insured_not_filing
    FROM supplier, (VALUES (DATE '1997-03-31'), (DATE '1997-06-30')) AS q(p)
    WHERE s_suppkey % 4 <> 0 AND NOT (s_suppkey % 3 = 0 AND month(p) = 3) AND DATE '1995-01-01' + CAST(s_suppkey * 10 AS INTEGER) <= p GROUP BY 1, 2""")
def unfiled_depositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    quarters = "(SELECT explode(array(DATE '1997-03-31', DATE '1997-06-30')) AS period)"
    closed = read(spark, sf_dir, f"SELECT s_nationkey AS holding, s_suppkey AS node, period FROM {{supplier}} CROSS JOIN {quarters} q")
    roster = read(spark, sf_dir, "SELECT s_suppkey AS rssd, DATE '1997-03-31' AS period FROM {supplier} WHERE s_suppkey % 3 = 0")
    entities = read(spark, sf_dir, "SELECT s_suppkey AS rssd, s_suppkey % 4 AS fdic_cert, 'SMB' AS entity_type, date_add(DATE '1995-01-01', CAST(s_suppkey * 10 AS INT)) AS opened, CAST(NULL AS DATE) AS ended FROM {supplier}")
    return graph.unfiled(closed, roster, entities, ("SMB", "NMB"), ["holding"])
