"""Catalogue, fourth part: readers, over documents that the queries make of the shipped tables."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import taxonomy, text
from ..functions.periods import stamp_to_date
from ..operators import fill, graph, lineage, quality
from ..session import checkpoint_dir
from ..sources import discovery, documents, grids, registry, specs
from .builds import CHARTER, CHARTERED
from .catalog import DAY, PANEL, query, read
from .reports import KEY, READINGS, SCALED

# ---- JSON ----

FORM = "CASE o_orderkey % 5 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q/A' WHEN 2 THEN '8-K' ELSE '10-Q' END"


@query(f"""
    SELECT o_custkey AS cik, CASE WHEN o_orderkey % 2 = 0 THEN 'Loans' ELSE 'Deposits' END AS tag, 'USD' AS unit, {DAY} AS period, CASE WHEN o_orderkey % 3 = 0 THEN {DAY} - 90 END AS period_start, o_orderkey % 3 <> 0 AS instant,
        o_totalprice AS value, {FORM} AS form, concat('a', o_orderkey) AS accn, {DAY} + 30 AS filed FROM orders WHERE o_orderkey % 5 <> 2 AND {DAY} >= DATE '1996-01-01' AND o_orderkey % 7 <> 0""")
def company_facts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document of facts per customer, by namespace, tag and unit; unwanted tags are not read."""
    item = f"""named_struct('end', CAST({DAY} AS STRING), 'start', CASE WHEN o_orderkey % 3 = 0 THEN CAST(date_sub({DAY}, 90) AS STRING) END, 'val', o_totalprice, 'accn', concat('a', o_orderkey),
        'fy', year({DAY}), 'fp', 'Q1', 'form', {FORM}, 'filed', CAST(date_add({DAY}, 30) AS STRING))"""
    tag = "CASE WHEN o_orderkey % 7 = 0 THEN 'Other' WHEN o_orderkey % 2 = 0 THEN 'Loans' ELSE 'Deposits' END"
    docs = read(spark, sf_dir, f"""SELECT to_json(named_struct('cik', cik, 'entityName', 'x', 'facts', map('us-gaap', map_from_entries(collect_list(struct(tag, named_struct('units', map('USD', items)))))))) AS value
        FROM (SELECT o_custkey AS cik, {tag} AS tag, collect_list({item}) AS items FROM {{orders}} GROUP BY 1, 2) x GROUP BY cik""")
    out = documents.company_facts(docs, tags=["Loans", "Deposits"], since="1996-01-01")
    return out.select("cik", "tag", "unit", "period", "period_start", "instant", "value", "form", "accn", "filed")


@query(f"SELECT concat('a', o_orderkey) AS accn, {FORM} AS form, CAST({DAY} AS VARCHAR) AS filed, concat('d', o_orderkey, '.htm') AS document FROM orders WHERE o_orderkey % 5 IN (0, 3, 4) AND {DAY} >= DATE '1997-01-01'")
def filing_index_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parallel arrays to filings: base forms of one kind from a day on, without amendments."""
    blocks = read(spark, sf_dir, f"""SELECT named_struct('accessionNumber', collect_list(concat('a', o_orderkey)), 'form', collect_list({FORM}), 'filingDate', collect_list(CAST({DAY} AS STRING)),
        'reportDate', collect_list(CAST({DAY} AS STRING)), 'primaryDocument', collect_list(concat('d', o_orderkey, '.htm'))) AS b FROM {{orders}} GROUP BY o_custkey""")
    out = documents.filing_index(blocks, F.col("b"), ("10-Q", "10-K"), "1997-01-01")
    return out.select(F.col("accessionNumber").alias("accn"), "form", F.col("filingDate").alias("filed"), F.col("primaryDocument").alias("document"))


@query("""
    SELECT s_suppkey + 5000 AS rssd, s_suppkey AS cert, DATE '2010-12-31' AS period, s_acctbal * 1000 AS assets, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_nationkey * 1000 AS DOUBLE) END AS deposits, 'tfr' AS source FROM supplier WHERE s_suppkey % 4 <> 0""")
def bankfind_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "SELECT to_json(named_struct('CERT', s_suppkey, 'REPDTE', '20101231', 'ASSET', s_acctbal, 'DEP', CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey END)) AS j FROM {supplier}")
    rows = raw.select(F.from_json("j", "struct<CERT:bigint,REPDTE:string,ASSET:double,DEP:double>").alias("r")).select("r.*")
    known = read(spark, sf_dir, "SELECT s_suppkey AS cert, s_suppkey + 5000 AS rssd FROM {supplier} WHERE s_suppkey % 4 <> 0")
    return documents.bankfind(rows, known).select("rssd", "cert", "period", "assets", "deposits", "source")


@query("SELECT DISTINCT s_suppkey AS cert FROM supplier WHERE s_suppkey % 3 <> 0")
def uncached_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.missing_from_cache(read(spark, sf_dir, "SELECT s_suppkey AS cert FROM {supplier}"), read(spark, sf_dir, "SELECT s_suppkey AS cert FROM {supplier} WHERE s_suppkey % 3 = 0"), "cert")


# ---- XML ----

_LINES_OF = """SELECT l_orderkey, collect_list(line) AS lines FROM (SELECT l_orderkey, struct(l_linenumber, l_partkey, l_returnflag, CAST(l_quantity AS INT) AS quantity, CAST(CAST(l_shipdate AS DATE) AS STRING) AS day, concat(l_linenumber, 'x', l_partkey, l_returnflag, date_format(l_shipdate, 'yyyyMMdd')) AS id) AS line
    FROM (SELECT /*+ REPARTITION(l_orderkey) */ * FROM {lineitem}) x) y GROUP BY l_orderkey"""  # rows travel, not texts
_XML = """concat('<x xmlns="http://www.xbrl.org/2003/instance" xmlns:g="http://g/2024" xmlns:d="http://xbrl.org/2006/xbrldi" xmlns:i="http://www.w3.org/2001/XMLSchema-instance"><unit id="u"><measure>iso4217:USD</measure></unit>',
    '<unit id="r"><divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>', array_join(sort_array(transform(lines, l -> concat(
    '<context id="c', l.id, '"><entity><segment><d:explicitMember dimension="g:ClassAxis">g:', l.l_returnflag, 'Member</d:explicitMember>', CASE WHEN l.l_linenumber % 2 = 0 THEN concat('<d:typedMember dimension="g:PartAxis"><v>', l.l_partkey, '</v></d:typedMember>') ELSE '' END,
    '</segment></entity><period>', CASE WHEN l.l_linenumber % 3 = 0 THEN concat('<startDate>1996-01-01</startDate><endDate>', l.day, '</endDate>') ELSE concat('<instant>', l.day, '</instant>') END, '</period></context>',
    '<g:Quantity contextRef="c', l.id, '" unitRef="', CASE WHEN l.l_linenumber = 2 THEN 'r' ELSE 'u' END, '" scale="3"', CASE WHEN l.l_returnflag = 'R' THEN ' sign="-"' ELSE '' END, CASE WHEN l.l_linenumber = 5 THEN ' i:nil="true"' ELSE '' END, '>', l.quantity, '</g:Quantity>'))), ''),
    CASE WHEN l_orderkey % 97 = 0 THEN '<broken' ELSE '</x>' END)"""


@query("""
    SELECT CAST(l_orderkey AS VARCHAR) AS doc, 'Quantity' AS tag, CASE WHEN l_linenumber % 3 = 0 THEN DATE '1996-01-01' END AS period_start, CAST(l_shipdate AS DATE) AS period, l_linenumber % 3 <> 0 AS instant, floor(l_quantity) * 1000.0 * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS value,
        CASE WHEN l_linenumber = 2 THEN 'USD/shares' ELSE 'USD' END AS unit, l_returnflag || 'Member' AS loan_class, CASE WHEN l_linenumber % 2 = 0 THEN 'ClassAxis|PartAxis' ELSE 'ClassAxis' END AS dim_axes, CASE WHEN l_linenumber % 2 = 0 THEN concat('PartAxis=', l_partkey) ELSE '' END AS other_dims,
        CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 1 END AS n_dims, false AS failed FROM lineitem WHERE l_orderkey % 97 <> 0 AND l_linenumber <> 5
    UNION ALL SELECT DISTINCT CAST(l_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true FROM lineitem WHERE l_orderkey % 97 = 0""")
def xbrl_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An instance per order: contexts with explicit and typed members, units, scale, sign and nil; a
    broken one comes back with its message and no fact."""
    found = read(spark, sf_dir, f"SELECT CAST(l_orderkey AS STRING) AS path, CAST({_XML} AS BINARY) AS content FROM ({_LINES_OF}) o")
    rows = documents.promote_axes(documents.instances(found), {"loan_class": ["Missing", "ClassAxis"]})
    bad = F.col("error").isNotNull()
    keep = lambda c: F.when(~bad, F.col(c)).alias(c)
    return rows.select(F.col("path").alias("doc"), "tag", "period_start", "period", "instant", "value", "unit", "loan_class", keep("dim_axes"), keep("other_dims"), keep("n_dims"), bad.alias("failed"))


# ---- zipped tables ----


def _zips(charters: DataFrame) -> DataFrame:
    """path and content: a bulk archive per period, one schedule in two files."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        day = frame["period"].iloc[0].strftime("%m%d%Y")
        line = lambda *cells: "\t".join(map(str, cells)) + "\n"
        rows = frame.sort_values("s").itertuples(index=False)
        rc, rn, ra, por = ([], [], [], [])
        for r in rows:
            rc.append(line(r.s, "CONF" if r.s % 7 == 0 else int(r.v), "" if r.s % 3 else int(r.w)))
            rn.append(line(r.s, int(r.a)))
            ra.append(line(r.s, "NR" if r.s % 5 == 0 else int(r.w)))
            por.append(line(r.s, 1, 2, 3, 4, f"BANK {r.s}", "", "", "", "", "041" if r.s % 2 else "031"))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(f"Call Schedule RC {day}.txt", line('"IDRSSD"', "RCON2170", "RCFD2170") + line("", "Total assets", "Total assets") + "".join(rc))
            z.writestr(f"Call Schedule RCN {day}(1 of 2).txt", line('"IDRSSD"', "RCON1403") + line("", "Nonaccrual") + "".join(rn))
            z.writestr(f"Call Schedule RCN {day}(2 of 2).txt", line('"IDRSSD"', "RCON1407") + line("", "Past due") + "".join(ra))
            z.writestr(f"Call Bulk POR {day}.txt", line('"IDRSSD"', *"abcd", "Financial Institution Name", *"efgh", "Financial Institution Filing Type") + "".join(por))
        return pd.DataFrame({"path": [day + ".zip"], "content": [b"no zip" if day.startswith("0331") and day.endswith("1996") else out.getvalue()]})

    return charters.groupBy("period").applyInPandas(build, "path string, content binary")


_READ = f"SELECT * FROM ({CHARTER}) c WHERE period <> DATE '1996-03-31'"


@query(f"""
    SELECT s AS rssd, period, 'RC' AS schedule, 'RCON' AS prefix, '2170' AS item, CASE WHEN s % 7 <> 0 THEN CAST(v AS DOUBLE) END AS value FROM ({_READ}) x UNION ALL SELECT s, period, 'RC', 'RCFD', '2170', CAST(w AS DOUBLE) FROM ({_READ}) x WHERE s % 3 = 0
    UNION ALL SELECT s, period, 'RCN', 'RCON', '1403', CAST(a AS DOUBLE) FROM ({_READ}) x UNION ALL SELECT s, period, 'RCN', 'RCON', '1407', CASE WHEN s % 5 <> 0 THEN CAST(w AS DOUBLE) END FROM ({_READ}) x""")
def call_report_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide schedules to long rows; one archive is broken and gives none."""
    return documents.sound(documents.call_reports(_zips(read(spark, sf_dir, CHARTERED)))).drop("code")


@query(f"SELECT s AS rssd, concat('BANK ', s) AS name, CASE WHEN s % 2 = 0 THEN '031' ELSE '041' END AS form, period FROM ({_READ}) x")
def roster_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.sound(documents.rosters(_zips(read(spark, sf_dir, CHARTERED))))


@query(f"SELECT DISTINCT period, schedule, code, label FROM ({_READ}) x, (VALUES ('RC', 'RCON2170', 'Total assets'), ('RC', 'RCFD2170', 'Total assets'), ('RCN', 'RCON1403', 'Nonaccrual'), ('RCN', 'RCON1407', 'Past due')) l(schedule, code, label)")
def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.sound(documents.dictionaries(_zips(read(spark, sf_dir, CHARTERED))))


@query("SELECT '03311996.zip' AS path, 'BadZipFile: File is not a zip file' AS error")
def failed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.failures(documents.call_reports(_zips(read(spark, sf_dir, CHARTERED))))


def _books(rows: DataFrame) -> DataFrame:
    """path and content: a workbook per nation, with shared texts, inline texts and a gap."""
    wrap = '<?xml version="1.0"?><{0} xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">{1}</{0}>'

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        nation, frame = frame["nation"].iloc[0], frame.sort_values("s")
        lines = "".join(f'<row r="{i}"><c r="A{i}" t="s"><v>{i - 1}</v></c><c r="C{i}"><v>{r.s}</v></c><c r="D{i}" t="inlineStr"><is><t>n{nation}</t></is></c></row>' for i, r in enumerate(frame.itertuples(index=False), 1))
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr("xl/workbook.xml", wrap.format("workbook", '<sheets><sheet name="Loans" sheetId="1" r:id="x1"/></sheets>'))
            z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="x1" Target="worksheets/sheet1.xml"/></Relationships>')
            z.writestr("xl/sharedStrings.xml", wrap.format("sst", "".join(f"<si><r><t>Name </t></r><r><t>{r.s}</t></r></si>" for r in frame.itertuples(index=False))))
            z.writestr("xl/worksheets/sheet1.xml", wrap.format("worksheet", f"<sheetData>{lines}</sheetData>"))
        return pd.DataFrame({"path": [f"{nation}.xlsx"], "content": [out.getvalue()]})

    return rows.groupBy("nation").applyInPandas(build, "path string, content binary")


@query("SELECT s_nationkey || '.xlsx' AS path, 'Loans' AS sheet, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS row, concat('Name ', s_suppkey, '||', s_suppkey, '|n', s_nationkey) AS cells FROM supplier")
def workbook_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = documents.workbooks(_books(read(spark, sf_dir, "SELECT s_nationkey AS nation, s_suppkey AS s FROM {supplier}")))
    return out.where("error is null").select("path", "sheet", "row", F.array_join("cells", "|").alias("cells"))


@query("""
    SELECT s_suppkey AS k, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CASE s_suppkey % 5 WHEN 0 THEN 'release' WHEN 1 THEN 'presentation' WHEN 2 THEN 'supplement' WHEN 3 THEN 'presentation' ELSE CASE WHEN s_suppkey % 2 = 0 THEN 'supplement' END END END AS kind FROM supplier""")
def content_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents told by their opening text, by exhibit number where it says nothing, and not at all
    where there is hardly any text."""
    docs = read(spark, sf_dir, """SELECT s_suppkey AS k, CASE WHEN s_suppkey % 2 = 0 THEN 'EX-99.2' ELSE 'EX-1' END AS exhibit, concat('<style>press release</style><p>',
        CASE s_suppkey % 5 WHEN 0 THEN 'For Immediate Release' WHEN 1 THEN 'Investor Presentation: financial highlights' WHEN 2 THEN 'Quarterly Performance Summary' WHEN 3 THEN 'earnings call' ELSE 'nothing' END, '</p>', repeat('<b>word</b> ', CASE WHEN s_suppkey % 7 = 0 THEN 3 ELSE 100 END)) AS html FROM {supplier}""")
    return docs.select("k", taxonomy.content_kind(F.col("html"), F.col("exhibit")).alias("kind"))


# ---- registry ----

_STAMP = "date_format({}, 'yyyyMMdd')"
ATTRIBUTES = f"""SELECT CAST(s_suppkey AS STRING) AS ID_RSSD, concat(' ', s_name, ' ') AS NM_LGL, CASE WHEN s_suppkey % 2 = 0 THEN 'SMB' ELSE 'FHD' END AS ENTITY_TYPE, CASE WHEN s_suppkey % 6 = 0 THEN '0' ELSE concat(s_suppkey % 10, '-77') END AS ID_TAX, '0' AS ID_LEI,
    CASE WHEN s_suppkey % 4 = 0 THEN '0' ELSE CAST(s_suppkey + 100 AS STRING) END AS ID_FDIC_CERT, CASE WHEN s_suppkey % 5 = 0 THEN '1' ELSE '0' END AS BHC_IND, '0' AS IHC_IND, {_STAMP.format("date_add(DATE '1990-01-01', CAST(s_suppkey AS INT))")} AS DT_OPEN, {{end}} AS DT_END, {{reason}} AS REASON_TERM_CD FROM {{{{supplier}}}} WHERE {{where}}"""
ACTIVE, CLOSED = (ATTRIBUTES.format(end=e, reason=r, where=w) for e, r, w in (("'99991231'", "'0'", "s_suppkey % 3 <> 0"), ("'20090930'", "CASE WHEN s_suppkey % 9 = 0 THEN '4' ELSE '1' END", "s_suppkey % 3 = 0 OR s_suppkey % 10 = 1")))
EVENTS = f"""SELECT CAST(o_orderkey AS STRING) AS ID_RSSD_PREDECESSOR, CASE WHEN o_orderkey % 13 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END AS ID_RSSD_SUCCESSOR, CASE WHEN o_orderkey % 17 = 0 THEN '199613' ELSE {_STAMP.format(DAY)} END AS DT_TRANS,
    CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '50' WHEN 2 THEN '9 ' ELSE '7' END AS TRNSFM_CD, CAST(o_orderkey % 2 AS STRING) AS ACCT_METHOD FROM {{orders}}"""
RELATIONS = f"""SELECT CAST(o_custkey AS STRING) AS ID_RSSD_PARENT, CAST(o_orderkey + 1000000 AS STRING) AS ID_RSSD_OFFSPRING, CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE '1' END AS CTRL_IND, {_STAMP.format(DAY)} AS DT_START, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '99991231' ELSE {_STAMP.format(f"date_add({DAY}, 200)")} END AS DT_END FROM {{orders}}"""
_ENTITY = """SELECT s_suppkey AS rssd, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'SMB' ELSE 'FHD' END AS entity_type, CASE WHEN s_suppkey % 6 <> 0 THEN concat(s_suppkey % 10, '-77') END AS ein, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey + 100 END AS fdic_cert, s_suppkey % 5 = 0 AS is_bhc,
    s_suppkey % 3 <> 0 AS active, DATE '1990-01-01' + CAST(s_suppkey AS INTEGER) AS opened, CASE WHEN s_suppkey % 3 = 0 THEN DATE '2009-09-30' END AS ended, CASE WHEN s_suppkey % 3 <> 0 THEN '0' WHEN s_suppkey % 9 = 0 THEN '4' ELSE '1' END AS reason_term FROM supplier"""
_EVENT = f"SELECT o_orderkey AS predecessor, o_custkey AS successor, {DAY} AS date, CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '50' ELSE '9' END AS code, o_orderkey % 2 = 1 AS pooled, o_orderkey % 4 = 1 AS failure FROM orders WHERE o_orderkey % 4 <> 3 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0"


def _entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.entities(read(spark, sf_dir, ACTIVE), read(spark, sf_dir, CLOSED))


@query(_ENTITY)
def registry_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir).select("rssd", "name", "entity_type", "ein", "fdic_cert", "is_bhc", "active", "opened", "ended", "reason_term")


@query(_EVENT)
def registry_successions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.successions(read(spark, sf_dir, EVENTS))


@query(f"SELECT o_custkey AS parent, o_orderkey + 1000000 AS child, {DAY} AS start, CASE WHEN o_orderkey % 3 = 2 THEN {DAY} + 200 END AS \"end\" FROM orders WHERE o_orderkey % 5 <> 0")
def registry_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.relationships(read(spark, sf_dir, RELATIONS))


@query(f"SELECT predecessor AS rssd FROM ({_EVENT}) e WHERE failure UNION SELECT s_suppkey FROM supplier WHERE s_suppkey % 9 = 0")
def registry_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.failed(registry.successions(read(spark, sf_dir, EVENTS)), _entities(spark, sf_dir))


@query(f"SELECT successor, count(*) AS n, min(date) AS first, arg_min(predecessor, struct_pack(a := date, b := predecessor)) AS oldest FROM ({_EVENT}) e GROUP BY 1")
def registry_by_successor(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = registry.by_successor(registry.successions(read(spark, sf_dir, EVENTS)))
    return out.select("successor", F.size("events").cast("long").alias("n"), F.col("events")[0]["date"].alias("first"), F.col("events")[0]["predecessor"].alias("oldest"))


@query("SELECT lpad(concat(s_suppkey % 10, '77'), 9, '0') AS ein, array_to_string(list_sort(list(s_suppkey)), ';') AS rssds FROM supplier WHERE s_suppkey % 6 <> 0 GROUP BY 1")
def registry_by_employer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.by_employer(_entities(spark, sf_dir)).withColumn("rssds", F.array_join(F.transform("rssds", lambda x: x.cast("string")), ";"))


_AT = "(VALUES (DATE '1996-06-30'), (DATE '1997-03-31'))"


@query(f"SELECT period, o_orderkey + 1000000 AS child, CAST(o_custkey AS VARCHAR) AS parents FROM orders, {_AT} q(period) WHERE o_orderkey % 5 <> 0 AND {DAY} <= period AND (o_orderkey % 3 <> 2 OR {DAY} + 200 >= period)")
def registry_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read(spark, sf_dir, f"SELECT col1 AS period FROM VALUES {_AT[8:-1]}")
    out = registry.parents_at(registry.relationships(read(spark, sf_dir, RELATIONS)), days)
    return out.withColumn("parents", F.array_join(F.transform("parents", lambda x: x.cast("string")), ";"))


@query("""
    WITH RECURSIVE d AS (SELECT * FROM (VALUES (DATE '1996-06-30'), (DATE '1997-03-31')) q(period)), e AS (SELECT period, c_custkey // 3 AS parent, c_custkey AS child FROM customer, d WHERE c_custkey > 2 AND (c_custkey % 4 <> 0 OR period < DATE '1997-01-01')),
    r AS (SELECT period, c_custkey AS rssd FROM customer, d WHERE c_custkey % 3 <> 1 OR period < DATE '1997-01-01'),
    w AS (SELECT period, root, root AS rssd, 0 AS depth FROM (SELECT period, parent AS root FROM e UNION SELECT period, rssd FROM r) s WHERE root BETWEEN 1 AND 5 UNION SELECT w.period, root, child, depth + 1 FROM w JOIN e ON w.period = e.period AND rssd = parent WHERE depth < 12)
    SELECT DISTINCT w.period, root, w.rssd FROM w JOIN r ON w.period = r.period AND w.rssd = r.rssd""")
def filers_under_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = read(spark, sf_dir, "SELECT c_custkey DIV 3 AS parent, c_custkey AS child, CAST(NULL AS DATE) AS start, CASE WHEN c_custkey % 4 = 0 THEN DATE '1996-12-31' END AS end FROM {customer} WHERE c_custkey > 2")
    roster = read(spark, sf_dir, "SELECT c_custkey AS rssd, explode(CASE WHEN c_custkey % 3 <> 1 THEN array(DATE '1996-06-30', DATE '1997-03-31') ELSE array(DATE '1996-06-30') END) AS period FROM {customer}")
    roots = read(spark, sf_dir, "SELECT n_nationkey + 1 AS root FROM {nation} WHERE n_nationkey < 5")  # a holding has a few roots
    return registry.filers_under(roots, edges, roster)


@query("SELECT s_suppkey AS rssd, s_suppkey + 100 AS fdic_cert FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 = 0")
def missing_depositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = read(spark, sf_dir, "SELECT s_nationkey AS holding, array_join(array_sort(collect_list(s_suppkey)), ';') AS insured_not_filing FROM {supplier} WHERE s_suppkey % 5 = 0 GROUP BY 1")
    return registry.missing_depositories(gaps, _entities(spark, sf_dir))


# ---- lineage ----

_ABSORBED = "SELECT c_custkey AS predecessor, c_custkey {} 2 AS successor, {} AS date, CASE WHEN c_custkey % 10 = 0 THEN '50' ELSE '1' END AS code, c_custkey % 3 = 0 AS pooled FROM {} WHERE c_custkey > 5"


@query(f"""
    WITH RECURSIVE e AS ({_ABSORBED.format('//', "DATE '2004-05-20' - CAST(c_custkey * 37 % 1500 AS INTEGER)", 'customer')}),
    w AS (SELECT n_nationkey + 1 AS holding, n_nationkey + 1 AS node, DATE '2004-06-30' AS date FROM nation WHERE n_nationkey < 5
        UNION SELECT holding, predecessor, e.date FROM w JOIN e ON node = successor WHERE e.date <= w.date AND e.date >= DATE '2001-01-01')
    SELECT w.holding, predecessor, successor, e.date AS effective_to, CASE WHEN code = '50' OR predecessor % 7 = 0 THEN 'fdic_assisted' ELSE 'merger' END AS succession_type, code, pooled FROM w JOIN e ON node = predecessor WHERE w.date = e.date""")
def lineage_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mergers that chain into five holdings; an absorption counts only if it came before the one that
    took its successor."""
    holdings = read(spark, sf_dir, "SELECT n_nationkey + 1 AS holding, n_nationkey + 1 AS rssd FROM {nation} WHERE n_nationkey < 5")
    events = read(spark, sf_dir, _ABSORBED.format("DIV", "date_sub(DATE '2004-05-20', CAST(c_custkey * 37 % 1500 AS INT))", "{customer}"))
    quarters = spark.sql("SELECT last_day(d) AS period FROM (SELECT explode(sequence(DATE '2001-03-01', DATE '2004-06-01', INTERVAL 3 MONTHS)) AS d) x")
    known = read(spark, sf_dir, "SELECT c_custkey AS rssd, true AS depository, c_custkey % 7 = 0 AS failed, CAST(NULL AS DATE) AS opened FROM {customer}")
    edges = spark.createDataFrame([], "parent bigint, child bigint, start date, end date")
    return lineage.resolve(holdings, quarters, edges, events, known, "2001-01-01")


@query("""
    WITH e AS (SELECT s_suppkey AS rssd, s_nationkey AS ein, s_suppkey % 3 <> 0 AS active, s_suppkey % 2 = 0 AS holds, s_suppkey % 5 = 0 AS files FROM supplier),
    r AS (SELECT n_nationkey AS target, rssd, row_number() OVER (PARTITION BY n_nationkey ORDER BY NOT files, NOT active, NOT holds, rssd) AS q FROM nation JOIN e ON ein = n_nationkey)
    SELECT target, rssd, true AS by_ein FROM r WHERE q = 1""")
def matched_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets to institutions: by employer id, then filing, active, holding, the lesser id."""
    targets = read(spark, sf_dir, "SELECT n_nationkey AS target, lpad(CAST(n_nationkey + 1 AS STRING), 9, '0') AS ein, n_name AS name FROM {nation}")
    known = read(spark, sf_dir, "SELECT s_suppkey AS rssd, lpad(CAST(s_nationkey + 1 AS STRING), 9, '0') AS ein, s_name AS name, s_suppkey % 3 <> 0 AS active, s_suppkey % 2 = 0 AS is_holding FROM {supplier}")
    return lineage.matched_entities(targets, known, read(spark, sf_dir, "SELECT s_suppkey AS rssd FROM {supplier} WHERE s_suppkey % 5 = 0"))


@query(f"SELECT DISTINCT o_custkey AS rssd, o_orderkey AS predecessor, last_day(make_date(year({DAY}), quarter({DAY}) * 3, 1)) AS period FROM orders WHERE o_orderkey % 2 = 1 AND o_orderkey % 4 <> 3 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_custkey IN (SELECT s_suppkey FROM supplier)")
def pooled_mergers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.pooled_events(registry.successions(read(spark, sf_dir, EVENTS)), read(spark, sf_dir, "SELECT s_suppkey AS rssd FROM {supplier}"))


@query("""
    SELECT CAST(s_suppkey AS BIGINT) AS rssd, p AS period, 'N' || s_nationkey AS ticker, 'tfr' AS via_type FROM supplier, (VALUES (DATE '1997-03-31'), (DATE '1997-06-30')) q(p) WHERE s_suppkey % 3 = 0""")
def backfill_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = read(spark, sf_dir, "SELECT concat('N', s_nationkey) AS ticker, explode(array(DATE '1997-03-31', DATE '1997-06-30')) AS period, array_join(array_sort(collect_list(s_suppkey)), ';') AS insured_not_filing FROM {supplier} WHERE s_suppkey % 3 = 0 GROUP BY s_nationkey")
    return graph.split_ids(gaps, "insured_not_filing", "rssd").select("rssd", "period", "ticker", F.lit("tfr").alias("via_type")).distinct()


# ---- HTML, grids, lines ----

_TABLE = """SELECT o_custkey AS doc, concat('<html><h2>Credit ', o_custkey, '</h2><p>Loans outstanding at period end (in ', CASE WHEN o_custkey % 2 = 0 THEN 'millions' ELSE 'thousands' END, ')</p><table><tr><th colspan=2>Class</th><th>1996</th></tr>',
    '<tr><td>Commercial real estate</td><td>$</td><td>', format_number(a, 0), '</td></tr><tr><td>Office</td><td></td><td>', format_number(b, 0), '</td></tr><tr><td>Loss</td><td>(</td><td>', c, '</td><td>)</td></tr></table></html>') AS html
    FROM (SELECT o_custkey, CAST(max(o_totalprice) AS BIGINT) + 1000 AS a, CAST(min(o_totalprice) AS BIGINT) AS b, CAST(count(*) AS BIGINT) AS c FROM {orders} GROUP BY 1) x"""
_AMOUNTS = "SELECT o_custkey AS doc, floor(max(o_totalprice)) + 1000 AS a, floor(min(o_totalprice)) AS b, count(*) AS c FROM orders GROUP BY 1"
_UNIT = "CASE WHEN doc % 2 = 0 THEN 1e6 ELSE 1e3 END"
SPEC = grids.Table("loans", (r"loans outstanding", r"commercial real estate"), ((r"^office", "loans_office_cre"), (r"commercial real estate", "loans_cre_total"), (r"^loss", "loss")), refuse=(r"segment",))


@query("""
    SELECT page_id AS doc, 'Page ' || page_id AS heading, 'Before ' || page_id AS caption, 'A|A|B' AS head, concat('x & y|', page_id, '|', page_id % 7) AS body FROM pages""")
def html_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings, captions and cells, with spans repeated and entities resolved; scripts of the shipped
    pages go through the same parser."""
    pages = read(spark, sf_dir, "SELECT page_id AS doc, concat('<h1>Page <b>', page_id, '</b></h1><p>Before ', page_id, '</p><table><tr><th colspan=\"2\">A</th><th>B</th></tr><tr><td> x &amp;  y</td><td>', page_id, '</td><td><i>', page_id % 7, '</i></td></tr></table><p>after</p>') AS html FROM {pages}")
    first = documents.html_outline(pages, "doc", "html").withColumn("t", F.col("tables")[0])
    cells = lambda i: F.array_join(F.col("t.cells")[i], "|")
    return first.select("doc", F.element_at("headings", -1).alias("heading"), F.regexp_extract("t.caption", r"(Before \d+)$", 1).alias("caption"), cells(0).alias("head"), cells(1).alias("body"))


@query("SELECT page_id, 0 AS n_tables FROM pages")
def page_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped pages hold no table; the parser reads every one of them whole."""
    return documents.html_outline(read(spark, sf_dir, "SELECT page_id, html FROM {pages}"), "page_id", "html").select("page_id", F.size("tables").alias("n_tables"))


@query(f"""
    WITH t AS ({_AMOUNTS}) SELECT CAST(doc AS VARCHAR) AS doc, 'loans_cre_total' AS variable, CAST(a AS DOUBLE) AS value, {_UNIT} AS scale FROM t UNION ALL SELECT CAST(doc AS VARCHAR), 'loans_office_cre', b, {_UNIT} FROM t UNION ALL SELECT CAST(doc AS VARCHAR), 'loss', -c, {_UNIT} FROM t""")
def table_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    outline = documents.html_outline(read(spark, sf_dir, _TABLE), "doc", "html")
    return discovery.surest(grids.readings(outline, "doc", [SPEC]), ["doc", "variable"]).select("doc", "variable", "value", "scale")


AGING = grids.Grid("aging", "past due", ((r"30.?[–-].?(59|89)|60.?[–-].?89", "dpd_30_89"), (r"90", "dpd_90_plus")), ((r"mortgage", "resi"), (r"card", "card")))


@query(f"""
    WITH r AS (SELECT doc, a + 99000 AS a, b + 100000 AS b, c FROM ({_AMOUNTS}) t WHERE doc % 3 <> 0) SELECT CAST(doc AS VARCHAR) AS doc, 'dpd_30_89_resi' AS variable, CAST(a + b AS DOUBLE) AS value FROM r UNION ALL SELECT CAST(doc AS VARCHAR), 'dpd_90_plus_resi', c FROM r
    UNION ALL SELECT CAST(doc AS VARCHAR), 'dpd_30_89_card', b + c FROM r UNION ALL SELECT CAST(doc AS VARCHAR), 'dpd_90_plus_card', a FROM r""")
def grid_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns by their headers; totals are never read, nor grids of another year."""
    docs = read(spark, sf_dir, """SELECT o_custkey AS doc, 1996 AS year, concat('<p>Loans past due</p><table><tr><th>Class</th><th>30-59 days ', CASE WHEN o_custkey % 3 = 0 THEN 1994 ELSE 1996 END, '</th><th>60-89 days</th><th>90 days or more</th><th>Total past due</th></tr><tr><td>Residential mortgage</td><td>',
        a, '</td><td>', b, '</td><td>', c, '</td><td>', a + b + c, '</td></tr><tr><td>Credit card</td><td>', b, '</td><td>', c, '</td><td>', a, '</td><td>9</td></tr></table>') AS html
        FROM (SELECT o_custkey, CAST(max(o_totalprice) AS BIGINT) + 100000 AS a, CAST(min(o_totalprice) AS BIGINT) + 100000 AS b, CAST(count(*) AS BIGINT) AS c FROM {orders} GROUP BY 1) x""")
    outline = documents.html_outline(docs, "doc", "html").join(docs.select("doc", "year"), "doc")
    return grids.readings(outline, "doc", [], [AGING], "year").select("doc", "variable", "value")


_SCHEDULE = """SELECT o_custkey AS doc, concat('<p>Loans by class (in millions)</p><table><tr><th>December 31</th><th>1996</th><th>1995</th></tr><tr><td>Commercial and industrial</td><td>$</td><td>', a, '</td></tr><tr><td>Commercial real estate</td><td>', b, '</td></tr><tr><td>Residential mortgage</td><td>', c,
    '</td></tr><tr><td>Credit card loans held for sale</td><td>1</td></tr><tr><td>Credit card</td><td>', a + b, '</td></tr><tr><td>Total loans</td><td>', a + b + c, '</td></tr></table><p>', CASE WHEN o_custkey % 2 = 0 THEN 'Term loans by origination year' ELSE 'Comparative balances' END,
    '</p><table><tr><th>Class</th><th>2019</th><th>2018 (1)</th><th>2017</th><th>2016</th><th>2015</th><th>2014</th></tr><tr><td>Pass</td><td>', a, '</td><td>', b, '</td><td>3</td><td>4</td><td>5</td><td>6</td></tr><tr><td>Special mention</td><td>', c, '</td><td>2</td><td>3</td><td>4</td><td>5</td><td>6</td></tr></table>') AS html
    FROM (SELECT o_custkey, CAST(max(o_totalprice) AS BIGINT) + 100000 AS a, CAST(min(o_totalprice) AS BIGINT) + 100000 AS b, CAST(count(*) AS BIGINT) AS c FROM {orders} GROUP BY 1) x"""


@query(f"""
    WITH t AS (SELECT CAST(doc AS VARCHAR) AS d, doc, a + 99000 AS a, b + 100000 AS b, c FROM ({_AMOUNTS}) x), e AS (SELECT * FROM t WHERE doc % 2 = 0)
    SELECT d AS doc, 'loans_ci' AS variable, CAST(a AS DOUBLE) AS value FROM t UNION ALL SELECT d, 'loans_cre_total', b FROM t UNION ALL SELECT d, 'loans_resi_mortgage', c FROM t UNION ALL SELECT d, 'loans_credit_card', a + b FROM t UNION ALL SELECT d, 'loans_total', a + b + c FROM t UNION ALL SELECT d, 'cq_pass', a FROM t UNION ALL SELECT d, 'cq_special_mention', c FROM t
    UNION ALL SELECT d, 'vintage_total_2019', a + c FROM e UNION ALL SELECT d, 'vintage_criticized_2019', c FROM e UNION ALL SELECT d, 'vintage_total_2018', b + 2 FROM e UNION ALL SELECT d, 'vintage_criticized_2018', 2 FROM e
    UNION ALL SELECT d, 'vintage_total_' || y, v * 2 FROM e, (VALUES (2017, 3), (2016, 4), (2015, 5)) q(y, v) UNION ALL SELECT d, 'vintage_criticized_' || y, v FROM e, (VALUES (2017, 3), (2016, 4), (2015, 5)) q(y, v)""")
def catalogue_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's loan schedule and vintage table; a table of reporting periods is no vintage."""
    outline = documents.html_outline(read(spark, sf_dir, _SCHEDULE), "doc", "html")
    out = grids.readings(outline, "doc", specs.TABLES, skip=specs.SKIP_LABEL, vintage=(specs.VINTAGE_CAPTION, specs.VINTAGE_YEAR, specs.VINTAGE_GRADES, specs.VINTAGE_KEPT))
    return out.select("doc", "variable", "value")


@query("SELECT count(*) AS n, 18 AS by_class, 60 AS by_vintage FROM (VALUES (1)) x(a)")
def document_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many columns only documents fill."""
    names = specs.new_columns()
    n = sum(c.startswith("dpd") for c in names)
    return spark.createDataFrame([(1, n, len(names) - n)], "n bigint, by_class int, by_vintage int")


@query(" UNION ALL ".join(f"SELECT '{stem}_{row}' AS variable" for stem in ("dpd_30_89", "dpd_90_plus") for row in ("resi", "card")))
def grid_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(c,) for c in grids.grid_columns([AGING])], "variable string")


@query(f"""
    WITH t AS ({_AMOUNTS}) SELECT doc, 'total_loans' AS variable, CAST(a AS DOUBLE) AS value, {_UNIT} AS scale FROM t UNION ALL SELECT doc, 'credit_card', -b, {_UNIT} FROM t""")
def line_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a text: averages and percentages do not count, the unit stands above."""
    docs = read(spark, sf_dir, """SELECT o_custkey AS doc, concat('Average balances\\nTotal loans 7\\nPeriod-end balances (in ', CASE WHEN o_custkey % 2 = 0 THEN 'millions' ELSE 'thousands' END, ')\\nTotal loans (1) $ ', format_number(CAST(max(o_totalprice) AS BIGINT) + 1000, 0), ' 95,000\\nCredit card 12%\\nCredit card (', format_number(CAST(min(o_totalprice) AS BIGINT), 0), ')') AS text FROM {orders} GROUP BY 1""")
    return grids.line_readings(docs, "doc", "text", ((r"^total loans", "total_loans"), (r"^credit card", "credit_card"))).select("doc", "variable", "value", "scale")


@query("SELECT s_suppkey AS doc, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(100 - s_suppkey % 60 AS DOUBLE) END AS north, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 60 AS DOUBLE) END AS south FROM supplier")
def phrase_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of one phrase, where they add up to about 100."""
    docs = read(spark, sf_dir, "SELECT s_suppkey AS doc, concat('Mix by region: North ', 100 - s_suppkey % 60 + CASE WHEN s_suppkey % 5 = 0 THEN 20 ELSE 0 END, '% and South ', s_suppkey % 60, '%.\\n\\nNorth 5%') AS t FROM {supplier}")
    found = discovery.shares(F.col("t"), "Mix by region:", {"north": r"North (\d+)%", "south": r"South (\d+)%"})
    return docs.select("doc", found.alias("s")).select("doc", "s.north", "s.south")


@query("""
    SELECT o_custkey AS bank, o_orderkey % 4 AS variable, arg_min(o_orderkey, struct_pack(a := CASE o_orderkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END, b := -o_totalprice, c := o_orderkey)) AS doc FROM orders GROUP BY 1, 2""")
def consolidated_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "SELECT o_custkey AS bank, o_orderkey % 4 AS variable, o_orderkey AS doc, o_totalprice AS value, 0.5D AS confidence, CASE o_orderkey % 3 WHEN 0 THEN 'supplement' WHEN 1 THEN 'release' ELSE 'presentation' END AS kind FROM {orders}")
    return discovery.consolidated(rows, ["bank", "variable"]).select("bank", "variable", "doc")


@query("SELECT o_orderkey AS doc, o_totalprice * CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS value FROM orders")
def second_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a reading in the first pass are read again."""
    all_ = read(spark, sf_dir, "SELECT o_orderkey AS doc, o_totalprice AS value FROM {orders}")
    return discovery.second_pass(all_.where("doc % 3 = 0"), all_, "doc", lambda left: left.withColumn("value", F.col("value") * 2))


@query("SELECT p_partkey AS k, 'ex' || p_partkey || '.htm' AS document FROM part UNION ALL SELECT p_partkey, '2Q26_' || p_partkey || '.pdf' FROM part")
def exhibit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, """SELECT p_partkey AS k, concat('<a href="/ix?doc=/Archives/ex', p_partkey, '.htm&x=1">1</a> <A class="z" HREF="/a/2Q26_', p_partkey, '.pdf?x#y">2</A> <a href="#top">') AS h FROM {part}""")
    return discovery.exhibits(pages, "k", "h").select("k", "document")


@query(f"""
    SELECT o_orderkey AS k, year({DAY}) AS year, quarter({DAY}) AS quarter, 'supplement' AS kind, CASE WHEN o_orderkey % 2 = 0 THEN 'pdf' ELSE 'xlsx' END AS format FROM orders WHERE o_orderkey % 3 <> 0""")
def cached_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names to year, quarter, kind and format; annual reports and names without a quarter go."""
    paths = read(spark, sf_dir, f"""SELECT o_orderkey AS k, concat('/c/', CASE WHEN o_orderkey % 3 = 0 THEN 'annual report ' ELSE '' END, quarter({DAY}), 'Q', year({DAY}), '_Supplement.', CASE WHEN o_orderkey % 2 = 0 THEN 'pdf' ELSE 'xlsx' END) AS path FROM {{orders}}""")
    return discovery.cached(paths).select("k", "year", "quarter", "kind", "format")


@query(f"""
    SELECT o_custkey AS bank, concat(year({DAY}), 'Q', quarter({DAY})) AS quarter, 'supplement' AS doc_type, 'cache' AS origin, 'pdf' AS ext, concat('Supplement ', o_orderkey) AS title, concat('/c/', o_orderkey, '.pdf') AS path, o_orderkey % 1000 AS bytes FROM orders""")
def document_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of documents, written as CSV and read back."""
    docs = read(spark, sf_dir, f"SELECT o_custkey AS bank, year({DAY}) AS year, quarter({DAY}) AS quarter, 'supplement' AS kind, 'cache' AS origin, 'pdf' AS format, concat('Supplement ', o_orderkey) AS title, concat('/c/', o_orderkey, '.pdf') AS path, o_orderkey % 1000 AS bytes FROM {{orders}}")
    folder = f"{checkpoint_dir(spark)}/manifest-{spark.sparkContext.applicationId}"
    documents.write_csv(discovery.manifest(docs), folder)
    return spark.read.option("header", "true").schema("bank bigint, quarter string, doc_type string, origin string, ext string, title string, path string, bytes bigint").csv(folder)


# ---- scalars ----


@query("""
    SELECT c_custkey AS k, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN CAST(c_custkey AS DOUBLE) ELSE -c_custkey * 1.5 END AS filed, CASE c_custkey % 3 WHEN 0 THEN 1e6 WHEN 1 THEN 1e3 END AS scale,
        CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE abs(c_acctbal) END AS signed, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Total loans' END AS label, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey AS DOUBLE) END AS value,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE DATE '1996-01-31' + CAST(c_custkey % 300 AS INTEGER) END AS day FROM customer""")
def text_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, """SELECT c_custkey AS k, c_acctbal AS v, CASE c_custkey % 5 WHEN 0 THEN 'CONF' WHEN 1 THEN ' ' WHEN 2 THEN 'n/a' WHEN 3 THEN concat(' ', c_custkey, ' ') ELSE CAST(-c_custkey * 1.5D AS STRING) END AS raw,
        CASE c_custkey % 3 WHEN 0 THEN 'Loans (in millions)' WHEN 1 THEN 'In Thousands of dollars' ELSE 'Loans' END AS caption, CASE WHEN c_custkey % 2 = 0 THEN 'net_income' ELSE 'loans_ci' END AS variable,
        CASE WHEN c_custkey % 4 = 0 THEN concat('Share ', c_custkey % 90, '%') ELSE concat('Total loans (1) $ ', c_custkey) END AS cell,
        CASE WHEN c_custkey % 3 = 0 THEN '99991231' ELSE date_format(date_add(DATE '1996-01-31', CAST(c_custkey % 300 AS INT)), 'yyyyMMdd') END AS stamp FROM {customer}""")
    label, value = text.label_and_value(F.col("cell"))
    return df.select("k", text.filed_value(F.col("raw")).alias("filed"), text.declared_scale(F.col("caption")).alias("scale"), text.magnitude(F.col("variable"), F.col("v")).alias("signed"), label.alias("label"), value.alias("value"), stamp_to_date(F.col("stamp")).alias("day"))


# ---- reconciliation ----


@query(SCALED + f""", u AS (SELECT r.nation, r.period, r.variable, value * m.s AS value FROM r JOIN m ON r.doc = m.doc AND m.n >= 2), w AS (SELECT nation, period, max(CASE WHEN variable = 'total' THEN value END) AS total, max(CASE WHEN variable = 'urgent' THEN value END) AS urgent FROM u GROUP BY 1, 2),
    p AS (SELECT nation, period, total, CASE WHEN nation % 3 <> 0 THEN urgent END AS urgent FROM ({PANEL}) p)
    SELECT p.nation, p.period, round(coalesce(p.urgent, CASE WHEN abs(w.urgent) <= abs(p.total) * 1.05 THEN w.urgent END), 2) AS urgent,
        CASE WHEN p.urgent IS NOT NULL THEN 'xbrl' WHEN abs(w.urgent) <= abs(p.total) * 1.05 THEN 'html' END AS urgent__source,
        round(CASE WHEN abs(p.total) > 0 THEN coalesce(p.urgent, CASE WHEN abs(w.urgent) <= abs(p.total) * 1.05 THEN w.urgent END) / p.total * 100 END, 4) AS urgent_pct
    FROM p LEFT JOIN w ON p.nation = w.nation AND p.period = w.period""")
def reconciled_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole driver: sources tagged, scales inferred, what is implausible refused, gaps filled,
    ratios refreshed."""
    panel = read(spark, sf_dir, f"SELECT nation, period, total, CASE WHEN nation % 3 <> 0 THEN urgent END AS urgent FROM ({PANEL}) p")
    readings = read(spark, sf_dir, f"SELECT *, 0.5D AS confidence, 0 AS filed FROM ({READINGS}) x")
    known = read(spark, sf_dir, PANEL).select("nation", "period", "total", "urgent")
    out = fill.reconcile(panel, readings, KEY, ["total", "urgent"], ["doc"], total="total", prefixes=("urgent",), proof=known, ratios={"urgent_pct": quality.ratio(F.col("urgent"), F.col("total"))})
    return out.select(*KEY, F.round("urgent", 2).alias("urgent"), "urgent__source", F.round("urgent_pct", 4).alias("urgent_pct"))
