"""Filings to rows: JSON by Spark's own functions; XML, HTML and zipped tables by parsers of the
standard library inside mapInArrow (mapInPandas for HTML), a file per row, with a failed file as a row of its own."""

from __future__ import annotations

import csv
import gzip
import io
import re
import zipfile
from collections.abc import Callable, Iterator
from functools import lru_cache
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.members import PROMOTED_AXES
from ..functions.text import filed_value

BLOCK = 10_000  # rows


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and content of every file below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "content")


def parsed(found: DataFrame, parse: Callable[[str, bytes], list[tuple]], schema: str, errors: bool = True) -> DataFrame:
    """One row per tuple that ``parse(path, content)`` returns, with its path and a null error. A file
    that fails gives one row that holds its path and the message alone (see ``sound`` and
    ``failures``); without ``errors`` it ends the job. The largest file decides the memory: rows of
    small ones leave together, in blocks of at least BLOCK."""
    names = [c.split()[0].strip("`") for c in re.split(r",\s*(?![^<]*>)", schema)]
    full = schema + ", path string, error string" if errors else schema
    fields = to_arrow_schema(StructType.fromDDL(full))

    def block(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                path = path.as_py()
                try:
                    rows = parse(path, content.as_py())
                    out += [(*r, path, None) for r in rows] if errors else rows
                except Exception as problem:  # a bad document must not end the job
                    if not errors:
                        raise ValueError(f"{path} cannot be read") from problem
                    out.append((*[None] * len(names), path, f"{type(problem).__name__}: {problem}"))
                if len(out) >= BLOCK:
                    yield block(out)
                    out = []
        if out:
            yield block(out)

    return found.select("path", "content").mapInArrow(run, full)


def sound(rows: DataFrame) -> DataFrame:
    """The rows of documents that could be read, without path and error."""
    return rows.where("error is null").drop("path", "error")


def failures(rows: DataFrame) -> DataFrame:
    """path and error of documents that could not be read."""
    return rows.where("error is not null").select("path", "error")


# ---- JSON ----


def flat_json(df: DataFrame, column: str, kind: str, names: list[str]) -> DataFrame:
    """Explode a JSON map or array column to ``names``."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.explode(F.from_json(column, kind)).alias(*names))


FACTS = "struct<cik:bigint,entityName:string,facts:map<string,map<string,struct<units:map<string,array<struct<start:string,`end`:string,val:double,accn:string,fy:int,fp:string,form:string,filed:string>>>>>>>"


def company_facts(texts: DataFrame, column: str = "value", forms: tuple[str, ...] = ("10-K", "10-Q"), since: str | None = None, tags: list[str] | None = None) -> DataFrame:
    """Long facts from documents of facts by namespace, tag, unit: a filter on the base form, the
    end date and the tag; an instant is a fact without a start."""
    f = texts.select(F.from_json(column, FACTS).alias("j")).select("j.cik", F.explode("j.facts").alias("namespace", "by_tag"))
    f = f.select("cik", "namespace", F.explode("by_tag").alias("tag", "t"))
    if tags is not None:
        f = f.where(F.col("tag").isin(tags))
    f = f.select("cik", "namespace", "tag", F.explode("t.units").alias("unit", "items")).select("cik", "namespace", "tag", "unit", F.explode("items").alias("i"))
    day = lambda c: F.to_date(F.col(c))
    out = f.where(F.regexp_replace("i.form", "/A$", "").isin(*forms)).select(
        "cik", "namespace", "tag", "unit", day("i.end").alias("period"), day("i.start").alias("period_start"), F.col("i.start").isNull().alias("instant"),
        F.col("i.val").alias("value"), "i.form", "i.fy", "i.fp", "i.accn", day("i.filed").alias("filed"),
    )
    return out.where(F.col("period") >= F.lit(since).cast("date")) if since else out


def transposed(df: DataFrame, block: Column, fields: list[str]) -> DataFrame:
    """Rows of a struct of parallel arrays."""
    return df.select(F.inline(F.arrays_zip(*(block[f].alias(f) for f in fields))))


def filing_index(blocks: DataFrame, block: Column, forms: tuple[str, ...], since: str, amendments: bool = False) -> DataFrame:
    rows = transposed(blocks, block, ["accessionNumber", "form", "filingDate", "reportDate", "primaryDocument"])
    base = F.regexp_replace("form", "/A$", "")
    keep = base.isin(*forms) & (F.col("filingDate") >= since)
    if not amendments:
        keep = keep & (base == F.col("form"))
    return rows.where(keep).orderBy(F.desc("filingDate"), "accessionNumber")


# Fields of the BankFind reply and the columns they fill.
BANKFIND = {
    "ASSET": "assets", "DEP": "deposits", "EQ": "equity", "LNLSGR": "loans_total", "LNATRES": "acl_total", "LNRENRES": "loans_cre_nonfarm_nonres", "LNRECONS": "loans_construction",
    "LNREMULT": "loans_multifamily", "LNCI": "loans_ci", "NALNLS": "nonaccrual_total", "P3ASSET": "past_due_30_89", "P9ASSET": "past_due_90", "DRLNLS": "charge_offs_total", "CRLNLS": "recoveries_total",
}


def bankfind(rows: DataFrame, rssd_of: DataFrame) -> DataFrame:
    """rssd, cert, period, source and amounts in dollars; certificates without an id are dropped."""
    amounts = {out: F.col(f).cast("double") * 1000 for f, out in BANKFIND.items() if f in rows.columns}
    out = rows.select(F.col("CERT").cast("bigint").alias("cert"), F.to_date("REPDTE", "yyyyMMdd").alias("period"), *(v.alias(k) for k, v in amounts.items()))
    return out.join(rssd_of.select("cert", "rssd"), "cert").withColumn("source", F.lit("tfr"))


# ---- XML ----

FACT_SCHEMA = "namespace string, tag string, period date, period_start date, instant boolean, value double, unit string, dims map<string,string>"


@lru_cache(10_000)
def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def instance_facts(path: str, content: bytes) -> list[tuple]:
    """Numeric facts of an XBRL instance: nil, empty and non-numeric ones left out; scale and sign
    applied; dims maps each axis to its member (a typed one to its text)."""
    import datetime as dt

    root = ElementTree.fromstring(gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content)
    contexts: dict[str, tuple] = {}
    units: dict[str, str] = {}
    found = []
    for node in root:
        kind = _local(node.tag)
        if node.get("contextRef") is not None:
            found.append(node)
        if kind == "context":
            dates, dims = {}, {}
            for part in node.iter():
                name = _local(part.tag)
                if name in ("startDate", "endDate", "instant"):
                    dates[name] = dt.date.fromisoformat((part.text or "").strip()[:10])
                elif name == "explicitMember":
                    dims[part.attrib["dimension"].split(":")[-1]] = (part.text or "").strip().split(":")[-1]
                elif name == "typedMember":
                    dims[part.attrib["dimension"].split(":")[-1]] = "".join(t.strip() for t in part.itertext())
            contexts[node.attrib["id"]] = (dates.get("startDate"), dates.get("endDate") or dates.get("instant"), dims)
        elif kind == "unit":
            units[node.attrib["id"]] = "/".join((m.text or "").strip().split(":")[-1] for m in node.iter() if _local(m.tag) == "measure")
    out = []
    for node in found:
        attrib = node.attrib
        context = contexts.get(attrib["contextRef"])
        text = (node.text or "").strip().replace(",", "")
        if context is None or not text or any([v in ("true", "1") and _local(k) == "nil" for k, v in attrib.items()]):
            continue
        try:
            value = float(text)
        except ValueError:
            continue
        value *= 10.0 ** int(attrib.get("scale", 0)) * (-1 if attrib.get("sign") == "-" else 1)
        start, end, dims = context
        space = node.tag[1:].split("}")[0] if node.tag.startswith("{") else ""
        out.append((space, _local(node.tag), end, start, start is None, value, units.get(attrib.get("unitRef", ""), ""), dims))
    return out


def instances(found: DataFrame) -> DataFrame:
    """Facts, path and error of each document: a row per fact, or one that tells why there is none."""
    return parsed(found, instance_facts, FACT_SCHEMA)


def promote_axes(df: DataFrame, promoted: dict[str, tuple[str, ...]] = PROMOTED_AXES, dims: str = "dims") -> DataFrame:
    """One column per promoted group, from the first of its axes that is there; the axes' signature
    and what no column took stay as text."""
    keys = F.sort_array(F.map_keys(dims))
    picks = {out: F.coalesce(*(F.try_element_at(dims, F.lit(a)) for a in axes)) for out, axes in promoted.items()}
    first = [F.coalesce(*(F.when(F.map_contains_key(dims, a), F.lit(a)) for a in axes)) for axes in promoted.values()]
    rest = F.array_except(keys, F.array_compact(F.array(*first)))
    other = F.array_join(F.transform(rest, lambda k: F.concat(k, F.lit("="), F.try_element_at(F.col(dims), k))), ";")
    return df.withColumns({**picks, "dim_axes": F.array_join(keys, "|"), "other_dims": other, "n_dims": F.size(dims)})


# ---- zipped tables ----

LONG_SCHEMA = "rssd bigint, period date, schedule string, code string, raw string"
_NAME = re.compile(r"Schedule (\w+) (\d{8})")


def call_report(path: str, content: bytes, wanted: dict[str, set[str]] | None = None) -> list[tuple]:
    """Bulk schedules of a zip, wide to long: the first row has codes, the second labels, data from
    the third. Only wanted codes of wanted schedules are kept; blanks are left out."""
    import datetime as dt

    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in z.namelist():
            m = _NAME.search(name)
            if not m or (wanted is not None and m[1] not in wanted):
                continue
            day = dt.datetime.strptime(m[2], "%m%d%Y").date()
            with z.open(name) as raw:
                rows = csv.reader(io.TextIOWrapper(raw, encoding="utf-8", errors="replace"), delimiter="\t")
                codes = [c.strip().strip('"') for c in next(rows, [])]
                next(rows, None)
                keep = [i for i, c in enumerate(codes) if i and c and (wanted is None or c in wanted[m[1]])]
                for row in rows:
                    if row and row[0].strip().isdigit():
                        out += [(int(row[0]), day, m[1], codes[i], row[i]) for i in keep if i < len(row) and row[i].strip()]
    return out


def call_reports(found: DataFrame, wanted: dict[str, set[str]] | None = None) -> DataFrame:
    """rssd, period, schedule, code, prefix, item, value (CONF and NR are null), path and error."""
    long = parsed(found, lambda p, c: call_report(p, c, wanted), LONG_SCHEMA)
    return long.select("rssd", "period", "schedule", "code", F.left("code", F.lit(4)).alias("prefix"), F.substring("code", 5, 8).alias("item"), filed_value(F.col("raw")).alias("value"), "path", "error")


def roster(path: str, content: bytes) -> list[tuple]:
    """rssd, name, form and period of the filers listed in a zip."""
    import datetime as dt

    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in z.namelist():
            m = re.search(r"POR (\d{8})", name)
            if not m:
                continue
            day = dt.datetime.strptime(m[1], "%m%d%Y").date()
            with z.open(name) as raw:
                rows = list(csv.reader(io.TextIOWrapper(raw, encoding="utf-8", errors="replace"), delimiter="\t"))
            head = [c.strip().strip('"').lower() for c in rows[0]] if rows else []
            at = lambda want, else_, head=head: next((i for i, h in enumerate(head) if want in h), else_)
            who, form = at("institution name", 5), at("filing type", 10)
            out += [(int(r[0]), r[who] if who < len(r) else None, r[form] if form < len(r) else None, day) for r in rows[1:] if r and r[0].strip().isdigit()]
    return out


def rosters(found: DataFrame) -> DataFrame:
    """Filers of each zip, with path and error."""
    return parsed(found, roster, "rssd bigint, name string, form string, period date")


def dictionary(path: str, content: bytes) -> list[tuple]:
    """period, schedule, code and label: the second row of each schedule of a zip."""
    import datetime as dt

    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for name in z.namelist():
            if not (m := _NAME.search(name)):
                continue
            day = dt.datetime.strptime(m[2], "%m%d%Y").date()
            with z.open(name) as raw:
                rows = csv.reader(io.TextIOWrapper(raw, encoding="utf-8", errors="replace"), delimiter="\t")
                codes, labels = next(rows, []), next(rows, [])
                out += [(day, m[1], c.strip().strip('"'), t.strip()) for c, t in list(zip(codes, labels, strict=False))[1:] if c.strip() and t.strip()]
    return out


def dictionaries(found: DataFrame) -> DataFrame:
    """What each code stands for, with path and error; ``latest_labels`` keeps one label per code."""
    return parsed(found, dictionary, "period date, schedule string, code string, label string")


def latest_labels(labels: DataFrame) -> DataFrame:
    """schedule, code, label: the newest label, then the lesser one."""
    return labels.groupBy("schedule", "code").agg(F.min_by("label", F.struct(-F.unix_date("period"), "label")).alias("label"))


def zipped_csv(found: DataFrame, columns: list[str]) -> DataFrame:
    """Named columns, as text, of the CSV files inside zips (a leading # in the header is dropped),
    with path and error."""

    def parse(path: str, content: bytes) -> list[tuple]:
        out = []
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in z.namelist():
                with z.open(name) as raw:
                    rows = csv.DictReader(io.TextIOWrapper(raw, encoding="utf-8", errors="replace"))
                    rows.fieldnames = [c.lstrip("#").strip() for c in rows.fieldnames or []]
                    out += [tuple(r.get(c) for c in columns) for r in rows]
        return out

    return parsed(found, parse, ", ".join(f"`{c}` string" for c in columns))


# ---- HTML ----


class _Tables(HTMLParser):
    """Tables as rows of cells, a cell repeated over the columns it spans, and the text before each."""

    def __init__(self, reach: int = 200):
        super().__init__(convert_charrefs=True)
        self.tables: list[tuple[str, list[list[str]]]] = []
        self.headings: list[str] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[str] | None = None
        self.span, self.before, self.reach, self.heading = 1, "", reach, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append([])
            self.tables.append((self.before.strip()[-self.reach :], self.open[-1]))
        elif tag == "tr" and self.open:
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open:
            wide = dict(attrs).get("colspan") or "1"
            self.cell, self.span = [], int(wide) if wide.isdigit() else 1
        elif re.fullmatch("h[1-6]|title", tag):
            self.heading = True
            self.headings.append("")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None and self.open:
            if not self.open[-1]:
                self.open[-1].append([])
            self.open[-1][-1] += [" ".join("".join(self.cell).split())] * self.span
            self.cell = None
        elif tag == "table" and self.open:
            self.open.pop()
            self.before = ""
        elif re.fullmatch("h[1-6]|title", tag):
            self.heading = False

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)
        elif not self.open:
            self.before = (self.before + " " + data.strip())[-4 * self.reach :]
        if self.heading:
            self.headings[-1] += data


def tables_of(html: str | None) -> tuple[list[str], list[tuple[str, list[list[str]]]]]:
    reader = _Tables()
    reader.feed(html or "")
    return [" ".join(h.split()) for h in reader.headings], reader.tables


def html_outline(df: DataFrame, key: str, html: str) -> DataFrame:
    """key, headings (array) and tables (array of caption and cells); null HTML has neither."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [tables_of(h) for h in frame[html]]
            yield pd.DataFrame({key: frame[key], "headings": [h for h, _ in found], "tables": [[{"caption": c, "cells": g} for c, g in t] for _, t in found]})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, html).mapInPandas(run, f"{key} {kind}, headings array<string>, tables array<struct<caption:string,cells:array<array<string>>>>")


# ---- workbooks ----

WORKBOOK_SCHEMA = "sheet string, row int, cells array<string>"


def workbook(path: str, content: bytes) -> list[tuple]:
    """sheet, row (from 1) and cells of an xlsx file: shared and inline texts, numbers and booleans as
    they are stored; gaps between cells are empty, rows without a cell are left out."""

    def texts(node) -> str:
        return "".join(t.text or "" for t in node.iter() if _local(t.tag) == "t")

    def column(ref: str) -> int:
        n = 0
        for ch in ref:
            if ch.isalpha():
                n = 26 * n + ord(ch.upper()) - 64
        return n

    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = [texts(x) for x in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        links = {r.attrib["Id"]: r.attrib["Target"] for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = [n for n in ElementTree.fromstring(z.read("xl/workbook.xml")).iter() if _local(n.tag) == "sheet"]
        for sheet in sheets:
            target = links[next(v for k, v in sheet.attrib.items() if _local(k) == "id")]
            root = ElementTree.fromstring(z.read(target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
            for at, row in enumerate((n for n in root.iter() if _local(n.tag) == "row"), 1):
                cells: list[str] = []
                for cell in row:
                    kind = cell.attrib.get("t", "n")
                    value = next((v.text or "" for v in cell if _local(v.tag) == "v"), "")
                    text = shared[int(value)] if kind == "s" else texts(cell) if kind == "inlineStr" else value
                    place = column(cell.attrib["r"]) if "r" in cell.attrib else len(cells) + 1
                    cells += [""] * (place - 1 - len(cells)) + [text]
                if cells:
                    out.append((sheet.attrib["name"], int(row.attrib.get("r", at)), cells))
    return out


def workbooks(found: DataFrame) -> DataFrame:
    """Rows of every sheet, with path and error."""
    return parsed(found, workbook, WORKBOOK_SCHEMA)


# ---- sinks ----


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    (df.write.mode("overwrite").partitionBy(*by) if by else df.write.mode("overwrite")).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; arrays as text joined by ``;``."""
    flat = {f.name: F.array_join(F.transform(f.name, lambda x: x.cast("string")), ";") for f in df.schema if f.dataType.typeName() == "array"}
    (df.withColumns(flat) if flat else df).write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
