"""Readers on files built in memory, extraction from grids and lines, and sinks."""

import datetime as dt
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import discovery, documents, grids
from ledgerloom.streaming import ingest

D = dt.date


def zipped(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


REPORT = {
    "FFIEC CDR Call Bulk POR 03312024.txt": '"IDRSSD"\tCert\tOCC\tABA\tPrimary\tFinancial Institution Name\tA\tB\tC\tD\tFinancial Institution Filing Type\n37\t1\t2\t3\t4\tFIRST BANK\t\t\t\t\t041\n',
    "FFIEC CDR Call Schedule RC 03312024.txt": '"IDRSSD"\tRCFD2170\tRCON2170\tRCON9999\n\tTotal assets\tTotal assets\tOther\n37\t\t100\t5\n38\tCONF\tNR\t7\n',
    "FFIEC CDR Call Schedule RCN 03312024(1 of 2).txt": '"IDRSSD"\tRCON1403\n\tNonaccrual\n37\t3\n',
    "Readme.txt": "x",
}


def test_call_reports(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(zipped(REPORT))
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    found = documents.files(spark, str(tmp_path))
    long = documents.call_reports(found, {"RC": {"RCFD2170", "RCON2170"}, "RCN": {"RCON1403"}})
    failed = documents.failures(long).collect()
    assert len(failed) == 1 and failed[0]["path"].endswith("broken.zip") and "BadZipFile" in failed[0]["error"]
    labels = documents.latest_labels(documents.sound(documents.dictionaries(found))).collect()
    assert sorted(map(tuple, labels)) == [("RC", "RCFD2170", "Total assets"), ("RC", "RCON2170", "Total assets"), ("RC", "RCON9999", "Other"), ("RCN", "RCON1403", "Nonaccrual")]
    with pytest.raises(Exception, match="cannot be read"):
        documents.parsed(found, documents.call_report, documents.LONG_SCHEMA, errors=False).collect()
    assert sorted((r["rssd"], r["schedule"], r["prefix"], r["item"], r["value"]) for r in long.where("value is not null").collect()) == [(37, "RC", "RCON", "2170", 100.0), (37, "RCN", "RCON", "1403", 3.0)]
    assert long.where("rssd = 38").count() == 2 and long.where("rssd = 38").first()["period"] == D(2024, 3, 31)
    long = documents.sound(long)
    assert [tuple(r) for r in documents.sound(documents.rosters(found)).collect()] == [(37, "FIRST BANK", "041", D(2024, 3, 31))]


def test_zipped_csv(spark, tmp_path):
    (tmp_path / "e.zip").write_bytes(zipped({"e.csv": "#ID_RSSD,NM\n1,A\n2,B\n"}))
    assert sorted(map(tuple, documents.sound(documents.zipped_csv(documents.files(spark, str(tmp_path)), ["ID_RSSD", "NM"])).collect())) == [("1", "A"), ("2", "B")]


INSTANCE = b"""<?xml version="1.0"?><xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:g="http://fasb.org/us-gaap/2024" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
<context id="a"><entity><segment><xbrldi:explicitMember dimension="g:ClassAxis">g:CreditCardMember</xbrldi:explicitMember><xbrldi:typedMember dimension="g:OtherAxis"><x>North</x></xbrldi:typedMember></segment></entity><period><instant>2024-03-31</instant></period></context>
<context id="b"><period><startDate>2024-01-01</startDate><endDate>2024-03-31</endDate></period></context>
<unit id="u"><measure>iso4217:USD</measure></unit><unit id="s"><divide><unitNumerator><measure>iso4217:USD</measure></unitNumerator><unitDenominator><measure>shares</measure></unitDenominator></divide></unit>
<g:Loans contextRef="a" unitRef="u" scale="3">1,234</g:Loans><g:Net contextRef="b" unitRef="u" sign="-">5</g:Net><g:Nil contextRef="b" unitRef="u" xsi:nil="true"/><g:Text contextRef="b">words</g:Text><g:Eps contextRef="b" unitRef="s">1.5</g:Eps></xbrl>"""


def test_instances_and_axes(spark, tmp_path):
    (tmp_path / "i.xml").write_bytes(INSTANCE)
    (tmp_path / "i.xml.gz").write_bytes(gzip.compress(INSTANCE))
    rows = documents.instances(documents.files(spark, str(tmp_path)))
    got = {r["tag"]: r for r in documents.promote_axes(rows.dropDuplicates(["tag"]), {"loan_class": ["Missing", "ClassAxis"]}).collect()}
    assert set(got) == {"Loans", "Net", "Eps"}
    assert (got["Loans"]["value"], got["Loans"]["instant"], got["Loans"]["loan_class"], got["Loans"]["dim_axes"], got["Loans"]["other_dims"], got["Loans"]["n_dims"]) == (1234000.0, True, "CreditCardMember", "ClassAxis|OtherAxis", "OtherAxis=North", 2)
    assert (got["Net"]["value"], got["Net"]["period_start"], got["Net"]["dim_axes"]) == (-5.0, D(2024, 1, 1), "") and got["Eps"]["unit"] == "USD/shares"


def test_json_sources(spark):
    item = {"end": "2024-03-31", "val": 5, "accn": "a", "fy": 2024, "fp": "Q1", "form": "10-Q/A", "filed": "2024-05-01"}
    facts = {"cik": 7, "entityName": "B", "facts": {"us-gaap": {"Loans": {"units": {"USD": [item, item | {"form": "8-K"}, item | {"start": "2024-01-01", "val": 2}]}}, "Other": {"units": {"USD": [item]}}}}}
    out = documents.company_facts(spark.createDataFrame([(json.dumps(facts),)], "value string"), tags=["Loans"], since="2013-01-01")
    assert sorted((r["cik"], r["tag"], r["instant"], r["value"]) for r in out.collect()) == [(7, "Loans", False, 2.0), (7, "Loans", True, 5.0)]
    block = [("a1", "10-Q", "2024-05-01"), ("a2", "10-Q/A", "2024-06-01"), ("a3", "8-K", "2024-06-02"), ("a4", "10-K", "2024-02-01")]
    names = ["accessionNumber", "form", "filingDate", "reportDate", "primaryDocument"]
    recent = spark.createDataFrame([(tuple([b[min(i, 2)] for b in block] for i in range(5)),)], "b struct<" + ",".join(f"{n}:array<string>" for n in names) + ">")
    assert [r["accessionNumber"] for r in documents.filing_index(recent, F.col("b"), ("10-Q", "10-K"), "2024-01-01").collect()] == ["a1", "a4"]
    thrift = documents.bankfind(spark.createDataFrame([(9, "20101231", 3.0), (8, "20101231", 4.0)], "CERT int, REPDTE string, ASSET double"), spark.createDataFrame([(9, 99)], "cert bigint, rssd bigint"))
    assert [(r["rssd"], r["period"], r["assets"], r["source"]) for r in thrift.collect()] == [(99, D(2010, 12, 31), 3000.0, "tfr")]


PAGE = """<h1>Credit</h1><p>Loans outstanding at period end (in millions)</p><table><tr><th colspan=2>Class</th><th>2026</th></tr><tr><td>Commercial real estate</td><td>$</td><td>20,000</td></tr>
<tr><td>Office</td><td></td><td>858</td></tr><tr><td>Loss</td><td>(</td><td>12</td><td>)</td></tr></table>"""
SPEC = grids.Table("loans", (r"loans outstanding", r"commercial real estate"), ((r"^office", "loans_office_cre"), (r"commercial real estate", "loans_cre_total"), (r"^loss", "loss")), refuse=(r"segment",))


def test_html_tables_and_readings(spark):
    outline = documents.html_outline(spark.createDataFrame([("a", PAGE), ("b", PAGE.replace("Loans outst", "Segment loans outst")), ("c", None)], "doc string, html string"), "doc", "html")
    first = outline.where("doc = 'a'").first()
    assert first["headings"] == ["Credit"] and first["tables"][0]["cells"][0] == ["Class", "Class", "2026"] and "in millions" in first["tables"][0]["caption"]
    got = {r["variable"]: (r["value"], r["scale"]) for r in grids.readings(outline, "doc", [SPEC]).collect()}
    assert got == {"loans_cre_total": (20000.0, 1e6), "loans_office_cre": (858.0, 1e6), "loss": (-12.0, 1e6)}


@pytest.mark.parametrize(("cells", "want"), [(["a", "(", "5", ")"], ["a", "(5)", "", ""]), (["(5", ")", "7"], ["(5)", "", "7"]), (["(5", "", ")"], ["(5)", "", ""]), (["5", "6"], ["5", "6"]), (["(5", "x", ")"], ["(5", "x", ")"])])
def test_split_parentheses(cells, want):
    assert grids.joined_parentheses(cells) == want


def test_delinquency_grid():
    grid = grids.Grid("aging", "past due", ((r"30.?[–-].?(59|89)|60.?[–-].?89", "dpd_30_89"), (r"90", "dpd_90_plus")), ((r"mortgage", "resi"), (r"card", "card")))
    cells = [["Class", "30-59 days", "60-89 days", "90 days or more", "Total past due", "Performing"], ["Residential mortgage", "667", "972", "1,639", "3,278", "90,000"], ["Credit card", "1", "2", "3", "6", "7"]]
    got = {v: n for v, _, n in grids.read_grid("Loans past due at March 31, 2026", cells, grid, 2026)}
    assert got == {"dpd_30_89_resi": 1639.0, "dpd_90_plus_resi": 1639.0, "dpd_30_89_card": 3.0, "dpd_90_plus_card": 3.0}
    assert grids.read_grid("Segment results", cells, grid) == []
    assert grids.read_grid("past due", [["Class", "30-59 days 2024", "90 days 2024"], *cells[1:]], grid, 2026) == []


def test_lines():
    rows = ((r"^total loans", "loans_total"), (r"^credit card", "loans_credit_card"))
    text = "Average balances\nTotal loans 95,000\nPeriod-end balances (in millions)\nTotal loans (1) $ 96,723 95,000\nCredit card 12%\nCredit card 4,890"
    assert [(v, n, s) for v, _, n, s in grids.read_lines(text, rows)] == [("loans_total", 96723.0, 1e6), ("loans_credit_card", 4890.0, 1e6)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, [2, 3]), (4, [])], "a int, b array<int>")
    documents.write_parquet(df, f"{tmp_path}/p", ["a"])
    documents.write_csv(df, f"{tmp_path}/c")
    documents.write_json(df, f"{tmp_path}/j")
    assert spark.read.parquet(f"{tmp_path}/p").count() == spark.read.json(f"{tmp_path}/j").count() == 2
    assert {r["b"] for r in spark.read.option("header", "true").csv(f"{tmp_path}/c").collect()} == {"2;3", None}


def test_ingest_reads_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.xml").write_bytes(INSTANCE)
    (source / "bad.xml").write_bytes(b"<x")
    for expected in (3, 3, 6):
        if expected == 6:
            (source / "b.xml").write_bytes(INSTANCE)
        ingest.ingest(spark, str(source), f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
        rows = spark.read.parquet(f"{tmp_path}/t")
        assert rows.where("error is null").count() == expected and rows.where("error is not null").count() == 1


def test_discovery(spark):
    index = spark.createDataFrame([("f", '<a href="/ix?doc=/Archives/edgar/ex991.htm&x=1">1</a> <A class="z" HREF=\'/a/b/2Q26_Supplement.pdf?x#y\'>2</A> <a href="#top">')], "k string, h string")
    assert [r["document"] for r in discovery.exhibits(index, "k", "h").orderBy("seq").collect()] == ["ex991.htm", "2Q26_Supplement.pdf"]
    files = spark.createDataFrame([("/c/2Q26_Supplement.pdf",), ("/c/2Q26-supplement.xlsx",), ("/c/annual report 2Q26.pdf",), ("/c/misc.pdf",)], "path string").withColumn("origin", F.lit("cache"))
    slots = discovery.one_per_slot(discovery.cached(files), ["year", "quarter", "kind"], ("cache",)).collect()
    assert [(r["path"], r["year"], r["quarter"], r["kind"]) for r in slots] == [("/c/2Q26-supplement.xlsx", 2026, 2, "supplement")]
    phrase = spark.createDataFrame([("Mix by region: North 60% and South 41%.\n\nOther 5%",), ("Mix by region: North 60%.",)], "t string")
    got = [r[0] for r in phrase.select(discovery.shares(F.col("t"), "Mix by region:", {"north": r"North (\d+)%", "south": r"South (\d+)%"})).collect()]
    assert got[0] is not None and (got[0]["north"], got[0]["south"]) == (60.0, 41.0) and got[1] is None


def test_second_pass(spark):
    filings = spark.createDataFrame([("a",), ("b",)], "doc string")
    first = spark.createDataFrame([("a", 1.0)], "doc string, value double")
    out = discovery.second_pass(first, filings, "doc", lambda left: left.withColumn("value", F.lit(2.0)))
    assert sorted(map(tuple, out.collect())) == [("a", 1.0), ("b", 2.0)]
