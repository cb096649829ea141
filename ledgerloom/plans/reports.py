"""Catalogue, second part: ranked sources, reports, text and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures, rules, text
from ..operators import fill, quality
from ..sources import discovery
from ..sources import documents as docs
from .catalog import DAY, PANEL, query, read

KEY = ["nation", "period"]
SOURCES = f"SELECT nation, period, CASE WHEN nation % 3 <> 0 THEN total END AS total, CASE WHEN nation % 2 = 0 THEN urgent END AS urgent FROM ({PANEL}) p"


@query(f"""
    WITH a AS ({SOURCES}), b AS (SELECT nation, period, total + 1 AS total, CASE WHEN nation % 5 <> 0 THEN urgent END AS urgent FROM ({PANEL}) p WHERE nation % 4 <> 1)
    SELECT a.nation, a.period, coalesce(a.total, b.total) AS total, CASE WHEN a.total IS NOT NULL THEN 'tagged' WHEN b.total IS NOT NULL THEN 'html' END AS total__source,
        coalesce(a.urgent, b.urgent) AS urgent, CASE WHEN a.urgent IS NOT NULL THEN 'tagged' WHEN b.urgent IS NOT NULL THEN 'html' END AS urgent__source
    FROM a LEFT JOIN b ON a.nation = b.nation AND a.period = b.period""")
def gap_fill_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = fill.tag_sources(read(spark, sf_dir, SOURCES), ["total", "urgent"], "tagged")
    other = read(spark, sf_dir, f"SELECT nation, period, total + 1 AS total, CASE WHEN nation % 5 <> 0 THEN urgent END AS urgent FROM ({PANEL}) p WHERE nation % 4 <> 1")
    return fill.fill_gaps(panel, other, KEY, "html")


READINGS = f"""
    SELECT nation, period, nation * 10 + year(period) % 10 AS doc, 'total' AS variable, total / CASE nation % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1000.0 ELSE 1000000.0 END AS value FROM ({PANEL}) p
    UNION ALL SELECT nation, period, nation * 10 + year(period) % 10, 'urgent', urgent / CASE WHEN nation % 4 = 3 AND quarter(period) < 4 THEN 17.0 ELSE 1000.0 END FROM ({PANEL}) p WHERE urgent IS NOT NULL"""


SNAP = "CASE " + " ".join(f"WHEN abs(k / nullif(value, 0) / {s} - 1) <= 0.02 THEN {s}" for s in ("1.0", "1000.0", "1000000.0", "1000000000.0")) + " END"
SCALED = f"""
    WITH r AS ({READINGS}), k AS (SELECT nation, period, 'total' AS variable, total AS k FROM ({PANEL}) p UNION ALL SELECT nation, period, 'urgent', urgent FROM ({PANEL}) p WHERE urgent IS NOT NULL),
    v AS (SELECT doc, {SNAP} AS s FROM r JOIN k USING (nation, period, variable)), c AS (SELECT doc, s, count(*) AS n FROM v WHERE s IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT doc, s, n FROM (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY n DESC, s) AS q FROM c) x WHERE q = 1)"""


@query(SCALED + " SELECT r.nation, r.period, r.doc, r.variable, m.s AS scale, coalesce(m.n, 0) AS scale_evidence FROM r LEFT JOIN m ON r.doc = m.doc")
def scale_mode_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill.infer_scale(read(spark, sf_dir, READINGS), read(spark, sf_dir, PANEL), KEY, ["total", "urgent"], ["doc"])
    return out.select("nation", "period", "doc", "variable", "scale", "scale_evidence")


@query(SCALED + """ SELECT r.nation, r.period, r.variable, round(value * coalesce(CASE WHEN r.nation % 5 = 0 THEN 1000.0 END, CASE WHEN m.n >= 2 THEN m.s END), 2) AS value
    FROM r LEFT JOIN m ON r.doc = m.doc WHERE r.nation % 5 = 0 OR m.n >= 2""")
def declared_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill.infer_scale(read(spark, sf_dir, READINGS), read(spark, sf_dir, PANEL), KEY, ["total", "urgent"], ["doc"])
    out = fill.scaled(out.withColumn("declared", F.when(F.col("nation") % 5 == 0, 1000.0)), "declared")
    return out.select("nation", "period", "variable", F.round("value", 2).alias("value"))


WIDE = f"SELECT nation, period, total * CASE WHEN nation % 6 = 0 THEN 0.5 ELSE 1.01 END AS total, urgent * CASE WHEN nation % 4 = 0 THEN 9 ELSE 1 END AS part_urgent, finished AS part_finished FROM ({PANEL}) p"


@query(f"""
    SELECT w.nation, w.period, CASE WHEN NOT coalesce(abs(w.total / nullif(p.total, 0) - 1) > 0.2, false) THEN round(part_urgent, 2) END AS part_urgent,
        CASE WHEN NOT coalesce(abs(w.total / nullif(p.total, 0) - 1) > 0.2, false) THEN round(part_finished, 2) END AS part_finished
    FROM ({WIDE}) w JOIN ({PANEL}) p USING (nation, period)""")
def reject_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill.reject_partial(read(spark, sf_dir, WIDE), read(spark, sf_dir, PANEL), KEY, "total", "part_")
    return out.select(*KEY, F.round("part_urgent", 2).alias("part_urgent"), F.round("part_finished", 2).alias("part_finished"))


@query(f"""
    SELECT w.nation, w.period, CASE WHEN abs(part_urgent) <= abs(p.total) * 1.05 THEN round(part_urgent, 2) END AS part_urgent,
        CASE WHEN abs(part_finished) <= abs(p.total) * 1.05 THEN round(part_finished, 2) END AS part_finished FROM ({WIDE}) w JOIN ({PANEL}) p USING (nation, period)""")
def reject_implausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill.reject_implausible(read(spark, sf_dir, WIDE), read(spark, sf_dir, PANEL), KEY, "total", ("part_",))
    return out.select(*KEY, F.round("part_urgent", 2).alias("part_urgent"), F.round("part_finished", 2).alias("part_finished"))


@query(f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY nation, period, variable ORDER BY doc % 3 DESC, doc DESC, value DESC) AS q FROM ({READINGS}) x)
    SELECT nation, period, max(CASE WHEN variable = 'total' THEN round(value, 6) END) AS total, max(CASE WHEN variable = 'urgent' THEN round(value, 6) END) AS urgent FROM r WHERE q = 1 GROUP BY 1, 2""")
def widen_best_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, f"SELECT *, doc % 3 AS confidence, doc AS filed FROM ({READINGS}) x")
    out = fill.widen(r, KEY, ["total", "urgent"])
    return out.select(*KEY, F.round("total", 6).alias("total"), F.round("urgent", 6).alias("urgent"))


@query(f"""
    SELECT nation, period, round(coalesce(CASE WHEN nation % 2 = 0 THEN 1.5 END, CASE WHEN abs(total) > 0 THEN urgent / total * 100 END), 6) AS urgent_pct,
        CASE WHEN nation % 2 <> 0 AND urgent IS NOT NULL AND abs(total) > 0 THEN 'derived' END AS urgent_pct__source FROM ({PANEL}) p""")
def refresh_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, f"SELECT *, CASE WHEN nation % 2 = 0 THEN 1.5 END AS urgent_pct FROM ({PANEL}) p")
    out = fill.refresh_ratios(df, {"urgent_pct": quality.ratio(F.col("urgent"), F.col("total"))}, "derived")
    return out.select(*KEY, F.round("urgent_pct", 6).alias("urgent_pct"), "urgent_pct__source")


# ---- reports ----

SPARSE = f"SELECT nation, CASE WHEN nation % 5 <> 0 THEN total END AS total, CASE WHEN (nation + quarter(period)) % 3 = 0 THEN urgent END AS urgent, finished FROM ({PANEL}) p"
COVERED = f"""
    WITH u AS (SELECT nation, 'total' AS variable, total AS v FROM ({SPARSE}) s UNION ALL SELECT nation, 'urgent', urgent FROM ({SPARSE}) s UNION ALL SELECT nation, 'finished', finished FROM ({SPARSE}) s),
    c AS (SELECT nation, variable, count(*) AS n_periods, count(v) AS n_present, round(count(v) * 100.0 / count(*), 1) AS pct_present, nation = 3 AND variable = 'urgent' AS not_applicable FROM u GROUP BY 1, 2),
    d AS (SELECT *, CASE WHEN not_applicable THEN 'n/a' WHEN n_present = 0 THEN 'missing' WHEN pct_present < 60 THEN 'sparse' ELSE 'ok' END AS status FROM c)"""


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = spark.createDataFrame([(3, "urgent")], "nation int, variable string")
    return quality.coverage(read(spark, sf_dir, SPARSE), ["nation"], ["total", "urgent", "finished"], not_applicable=none)


@query(COVERED + " SELECT * FROM d")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _covered(spark, sf_dir)


@query(COVERED + """, g AS (SELECT variable, count(*) AS n_entities, count(CASE WHEN status = 'ok' THEN 1 END) AS n_ok, count(CASE WHEN status = 'sparse' THEN 1 END) AS n_sparse,
    count(CASE WHEN status = 'missing' THEN 1 END) AS n_missing, round(avg(pct_present), 1) AS mean_pct FROM d WHERE NOT not_applicable GROUP BY 1)
    SELECT *, round(n_ok * 100.0 / n_entities, 1) AS pct_ok FROM g""")
def gap_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gap_summary(_covered(spark, sf_dir))


@query(f"""
    WITH a AS (SELECT nation, count(*) AS n_after FROM ({PANEL}) p GROUP BY 1), b AS (SELECT nation, count(*) AS n_before FROM ({PANEL}) p WHERE period >= DATE '1998-01-01' AND nation % 6 <> 0 GROUP BY 1)
    SELECT a.nation, n_after, coalesce(n_before, 0) AS n_before, n_after - coalesce(n_before, 0) AS gained FROM a LEFT JOIN b ON a.nation = b.nation""")
def coverage_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, PANEL)
    return quality.coverage_delta(p.where("period >= DATE '1998-01-01' AND nation % 6 <> 0"), p, ["nation"])


CHECKS = {"urgent_exceeds_high": ("urgent", "high"), "finished_exceeds_total": ("finished", "total"), "high_exceeds_finished": ("high", "finished")}


@query(f"""
    WITH f AS (SELECT nation, period, {", ".join(f"coalesce({p} > {w} * 1.0001, false) AS {k}" for k, (p, w) in CHECKS.items())} FROM ({PANEL}) p)
    SELECT *, {" + ".join(f"CAST({k} AS INTEGER)" for k in CHECKS)} AS n_flags FROM f WHERE {" OR ".join(CHECKS)}""")
def quality_flags_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.wide_flags(read(spark, sf_dir, PANEL), KEY, quality.bound_checks(CHECKS))


@query(" UNION ALL ".join(f"SELECT nation, period, '{k}' AS flag, concat('{p} over {w} in ', year(period)) AS detail FROM ({PANEL}) p WHERE {p} > {w} * 1.0001" for k, (p, w) in CHECKS.items()))
def flags_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {k: (c, F.concat(F.lit(f"{CHECKS[k][0]} over {CHECKS[k][1]} in "), F.year("period").cast("string"))) for k, c in quality.bound_checks(CHECKS).items()}
    return quality.long_flags(read(spark, sf_dir, PANEL), KEY, checks)


LEFT = "SELECT o_custkey AS c, round(sum(o_totalprice), 2) AS price, count(*) AS n FROM {orders} GROUP BY 1"
RIGHT = "SELECT o_custkey AS c, round(sum(l_extendedprice), 2) AS price, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE count(DISTINCT o_orderkey) END AS n FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY 1"
COMPARED = f"""
    WITH l AS (SELECT c, 'price' AS variable, price AS a FROM ({LEFT}) x UNION ALL SELECT c, 'n', n FROM ({LEFT}) x), r AS (SELECT c, 'price' AS variable, price AS b FROM ({RIGHT}) x UNION ALL SELECT c, 'n', n FROM ({RIGHT}) x),
    d AS (SELECT c, variable, a AS left_value, CAST(b AS DOUBLE) AS right_value, b - a AS difference, (b - a) / nullif(a, 0) * 100 AS difference_pct, b / nullif(a, 0) AS ratio,
        CASE WHEN a IS NULL OR b IS NULL THEN 'one_source_only' WHEN abs((b - a) / nullif(a, 0) * 100) <= 0.5 THEN 'agree' ELSE 'differ' END AS verdict
        FROM l JOIN r USING (c, variable) WHERE a IS NOT NULL OR b IS NOT NULL),
    s AS (SELECT c % 10 AS g, variable, count(*) AS n, count(CASE WHEN verdict = 'agree' THEN 1 END) AS n_agree, count(CASE WHEN verdict = 'differ' THEN 1 END) AS n_differ,
        count(CASE WHEN verdict = 'one_source_only' THEN 1 END) AS n_one_source, median(ratio) AS median_ratio, stddev_samp(ratio) AS std_ratio FROM d GROUP BY 1, 2)"""


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compare(read(spark, sf_dir, LEFT), read(spark, sf_dir, RIGHT), ["c"], ["price", "n"])


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summarise(_compared(spark, sf_dir).withColumn("g", F.col("c") % 10), ["g", "variable"])


@query(COMPARED + " SELECT c, variable, round(difference, 2) AS difference, round(difference_pct, 6) AS difference_pct, round(ratio, 6) AS ratio, verdict FROM d")
def compare_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _compared(spark, sf_dir)
    return out.select("c", "variable", F.round("difference", 2).alias("difference"), F.round("difference_pct", 6).alias("difference_pct"), F.round("ratio", 6).alias("ratio"), "verdict")


@query(COMPARED + " SELECT g, variable, n, n_agree, n_differ, n_one_source, round(median_ratio, 6) AS median_ratio, round(std_ratio, 6) AS std_ratio, round(n_agree * 100.0 / nullif(n_agree + n_differ, 0), 6) AS pct_agree FROM s")
def compare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _summary(spark, sf_dir)
    return out.withColumns({c: F.round(c, 6) for c in ("median_ratio", "std_ratio", "pct_agree")})


@query(COMPARED + " SELECT g, variable, round(std_ratio / nullif(abs(median_ratio), 0), 6) AS instability FROM s WHERE std_ratio / nullif(abs(median_ratio), 0) > 0.15")
def compare_unstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unstable(_summary(spark, sf_dir)).select("g", "variable", F.round("instability", 6).alias("instability"))


@query(f"""
    SELECT nation, min(period) AS first_period, max(period) AS last_period, count(*) AS n_periods, arg_max(total, period) AS last_value, nation IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 9 = 0) AS in_other
    FROM ({PANEL}) p GROUP BY nation""")
def coverage_gained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.coverage_gained(read(spark, sf_dir, PANEL), read(spark, sf_dir, "SELECT s_nationkey AS nation FROM {supplier} WHERE s_suppkey % 9 = 0"), "nation", "period", "total")


RATES = f"""
    SELECT nation, period, urgent AS num, total / CASE WHEN nation % 5 = 1 AND year(period) = 1996 AND quarter(period) = 2 THEN 500.0 WHEN nation % 5 = 2 AND year(period) = 1997 AND quarter(period) = 1 THEN 20.0 ELSE 1.0 END AS den,
        urgent / total * 400 * CASE WHEN nation % 5 IN (1, 2, 3) AND quarter(period) <= 2 AND year(period) IN (1996, 1997) THEN 20 ELSE 1 END AS rate FROM ({PANEL}) p WHERE total > 0"""


@query(f"""
    WITH m AS (SELECT nation, median(rate) AS med, median(den) AS dm FROM ({RATES}) r GROUP BY 1),
    w AS (SELECT r.*, med, dm, CASE WHEN abs(den) > 0 THEN num / den * 100 * 4 END AS again FROM ({RATES}) r JOIN m USING (nation)),
    v AS (SELECT *, CASE WHEN NOT coalesce(abs(med) > 1e-9 AND abs(rate) > 10 * abs(med), false) THEN 'ok'
        WHEN coalesce(den IS NULL OR abs(den) <= 0 OR abs(den) < 0.01 * abs(dm) OR abs(num) > abs(den), false) THEN 'nulled'
        WHEN coalesce(abs(rate - again) > 1e-6 * abs(again) + 1e-9, false) THEN 'corrected' ELSE 'kept' END AS audit FROM w)
    SELECT nation, period, audit, round(CASE audit WHEN 'nulled' THEN NULL WHEN 'corrected' THEN again ELSE rate END, 6) AS rate FROM v""")
def rate_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.audit_rate(read(spark, sf_dir, RATES), ["nation"], "rate", "num", "den")
    return out.select(*KEY, "audit", F.round("rate_audited", 6).alias("rate"))


@query(f"SELECT period, round(median(total), 2) AS peer_median, count(total) AS n FROM ({PANEL}) p GROUP BY 1")
def peer_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.peer_median(read(spark, sf_dir, PANEL), "period", "total").withColumn("peer_median", F.round("peer_median", 2))


@query(f"SELECT nation, period, urgent FROM ({PANEL}) p WHERE period = (SELECT max(period) FROM ({PANEL}) q) AND urgent IS NOT NULL")
def latest_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_ranking(read(spark, sf_dir, PANEL), "period", "urgent").select("nation", "period", "urgent")


@query(f"SELECT period, round(sum(urgent) / nullif(sum(total), 0) * 100, 6) AS urgent_pct, round(sum(high) / nullif(sum(total), 0) * 100, 6) AS high_pct FROM ({PANEL}) p GROUP BY 1")
def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.weighted_mix(read(spark, sf_dir, PANEL), "period", ["urgent", "high"], "total")
    return out.select("period", F.round("urgent_pct", 6).alias("urgent_pct"), F.round("high_pct", 6).alias("high_pct"))


@query(f"SELECT count(*) AS n_rows, count(DISTINCT nation) AS n_entities, min(period) AS first_period, max(period) AS last_period, count(total) + count(urgent) AS n_cells FROM ({PANEL}) p")
def build_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.build_info(read(spark, sf_dir, PANEL), ["total", "urgent"], "period", "nation")


# ---- text and sources ----

KINDS = (("Small|SMALL", "small"), ("^Promo|^PROMO|brass|BRASS", "promo"), ("copper|COPPER|steel|STEEL", "metal"))
_CASE = "CASE WHEN p_type = 'none' THEN 'given' " + " ".join(f"WHEN regexp_matches(p_type, '{p}') THEN '{c}'" for p, c in KINDS) + " END"


@query(f"SELECT p_partkey, p_type, {_CASE} AS kind FROM part")
def classify_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(read(spark, sf_dir, "SELECT p_partkey, p_type FROM {part}"), "p_type", "kind", KINDS, overrides={"none": "given"}).select("p_partkey", "p_type", "kind")


@query(f"SELECT p_type, count(*) AS n FROM part WHERE {_CASE} IS NULL AND p_type IS NOT NULL GROUP BY 1")
def unmapped_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = rules.classify(read(spark, sf_dir, "SELECT p_partkey, p_type FROM {part}"), "p_type", "kind", KINDS)
    return rules.unmapped(df, "p_type", "kind")


TITLES = f"""
    SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN concat('Supplement_', quarter({DAY}), 'Q', year({DAY}), '.pdf') WHEN 1 THEN concat('Q', quarter({DAY}), '-', year({DAY}), ' results')
        WHEN 2 THEN concat('x', year({DAY}), ' q', quarter({DAY})) WHEN 3 THEN concat('Report for the ', CASE quarter({DAY}) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'third' ELSE 'FOURTH' END, ' Quarter of ', year({DAY}))
        WHEN 4 THEN concat('deck', CAST(10 + quarter({DAY}) AS STRING)) ELSE concat(year({DAY}), '/', quarter({DAY}), 'Q+letter') END AS title, year({DAY}) AS y, quarter({DAY}) AS q FROM {{orders}}"""


@query(f"SELECT k, CASE WHEN k % 6 <> 4 THEN y END AS year, CASE WHEN k % 6 <> 4 THEN q END AS quarter FROM ({TITLES}) t")
def parse_quarter_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = read(spark, sf_dir, TITLES).select("k", text.document_quarter(F.col("title")).alias("at"))
    return out.select("k", F.col("at.y").alias("year"), F.col("at.q").alias("quarter"))


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 4 THEN NULL WHEN c_custkey % 5 = 0 THEN -CAST(c_custkey * 1000 AS DOUBLE) ELSE CAST(c_custkey * 1000 AS DOUBLE) END AS value FROM customer")
def parse_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, """SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN concat('$ (', format_number(c_custkey * 1000, 0), ')') WHEN 1 THEN format_number(c_custkey * 1000, 0)
        WHEN 2 THEN concat('$', c_custkey * 1000, '.0') WHEN 3 THEN concat(' ', c_custkey * 1000, ' ') ELSE '—' END AS cell FROM {customer}""")
    return df.select("k", text.financial_number(F.col("cell")).alias("value"))


NAMES = "SELECT s_suppkey AS k, concat(s_name, CASE s_suppkey % 4 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' Holdings  Corp' WHEN 2 THEN ' Company, N.A.' ELSE '' END) AS name, concat('EIN ', CASE WHEN s_suppkey % 9 = 0 THEN '00-0' ELSE concat(s_suppkey, '-7') END) AS id FROM {supplier}"


@query("SELECT s_suppkey AS k, upper(s_name) || CASE WHEN s_suppkey % 4 = 2 THEN ' COMPANY N A' WHEN s_suppkey % 4 = 1 THEN ' HOLDINGS' ELSE '' END AS name, CASE WHEN s_suppkey % 9 <> 0 THEN lpad(s_suppkey || '7', 9, '0') END AS id FROM supplier")
def normalise_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, NAMES).select("k", text.company_name(F.col("name")).alias("name"), text.employer_id(F.col("id")).alias("id"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS value, 'k' AS name FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "SELECT event_id, props FROM {events}")
    return docs.flat_json(df, "props", "map<string,bigint>", ["name", "value"]).select("event_id", "value", "name")


# ---- stress, capital, discovery ----

BALANCE = f"SELECT nation, period, total AS assets, urgent AS equity, CASE WHEN nation % 3 = 0 THEN high / 10 END AS goodwill, high / 100 AS acl_total, finished / 50 AS nonaccrual_total, CASE WHEN nation % 4 <> 0 THEN high / 50 END AS past_due_90, CASE WHEN nation % 5 = 0 THEN high END AS borrowings_other, high AS tier1_capital_basel1, CASE WHEN year(period) > 1997 THEN urgent END AS tier1_capital, total AS rwa, total AS rwa_basel1, total / 2 AS assets_average FROM ({PANEL}) p"


@query(f"""
    WITH b AS ({BALANCE}), t AS (SELECT *, equity - coalesce(goodwill, 0) AS te FROM b)
    SELECT nation, period, round(nonaccrual_total + past_due_90, 5) AS noncurrent, round(te, 5) AS tangible_equity, round(borrowings_other, 5) AS wholesale_funding,
        round(CASE WHEN te + coalesce(acl_total, 0) > 0 THEN (nonaccrual_total + past_due_90) / (te + coalesce(acl_total, 0)) * 100 END, 4) AS texas_ratio FROM t""")
def stress_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.stress_inputs(read(spark, sf_dir, BALANCE))
    return out.select(*KEY, *(F.round(c, 5).alias(c) for c in ("noncurrent", "tangible_equity", "wholesale_funding")), F.round("texas_ratio", 4).alias("texas_ratio"))


@query(f"""
    SELECT nation, period, round(tier1_capital / nullif(rwa, 0) * 100, 6) AS tier1_ratio, round(tier1_capital_basel1 / nullif(rwa_basel1, 0) * 100, 6) AS tier1_ratio_basel1,
        round(coalesce(tier1_capital, tier1_capital_basel1) / nullif(assets_average, 0) * 100, 6) AS leverage_ratio FROM ({BALANCE}) b""")
def capital_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.capital_ratios(read(spark, sf_dir, BALANCE))
    return out.select(*KEY, *(F.round(c, 6).alias(c) for c in ("tier1_ratio", "tier1_ratio_basel1", "leverage_ratio")))


SLOTS = "SELECT o_custkey AS bank, o_orderkey AS path, CASE o_orderkey % 3 WHEN 0 THEN 'feed' WHEN 1 THEN 'page' ELSE 'filing' END AS origin, CASE o_orderkey % 4 WHEN 0 THEN 'pdf' WHEN 1 THEN 'xlsx' WHEN 2 THEN 'htm' ELSE 'doc' END AS format FROM {orders}"


@query(f"""
    SELECT bank, path, origin, format FROM (SELECT *, row_number() OVER (PARTITION BY bank ORDER BY CASE origin WHEN 'feed' THEN 1 WHEN 'page' THEN 2 ELSE 3 END,
        CASE format WHEN 'xlsx' THEN 1 WHEN 'htm' THEN 4 WHEN 'pdf' THEN 5 ELSE 6 END, path) AS r FROM ({SLOTS}) s) x WHERE r = 1""")
def document_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.one_per_slot(read(spark, sf_dir, SLOTS), ["bank"], ("feed", "page", "filing"))


@query(f"SELECT nation, period, round(urgent + high, 2) AS top_two, round(coalesce(urgent, 0) + coalesce(high, 0) + coalesce(finished, 0), 2) AS all_three FROM ({PANEL}) p WHERE urgent IS NOT NULL AND high IS NOT NULL")
def loan_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, f"SELECT * FROM ({PANEL}) p WHERE urgent IS NOT NULL AND high IS NOT NULL")
    out = measures.with_groups(df, {"top_two": ["urgent", "high"], "all_three": ["top_two", "finished"]})
    return out.select(*KEY, F.round("top_two", 2).alias("top_two"), F.round("all_three", 2).alias("all_three"))
