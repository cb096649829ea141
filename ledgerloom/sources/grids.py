"""Amounts out of table grids and text lines: which table, which column, which row."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame

READING_SCHEMA = "doc string, caption string, variable string, label string, value double, scale double, confidence double"
_UNIT = re.compile(r"\bin (thousand|million|billion)s?\b", re.IGNORECASE)
_FACTOR = {"thousand": 1e3, "million": 1e6, "billion": 1e9}
_YEAR = re.compile(r"\b(?:19|20)\d\d\b")


@dataclass(frozen=True)
class Table:
    """Rows of a table by label: ``signals`` choose the table (three times as strong in its caption
    and first rows), ``refuse`` rules it out, ``rows`` are (pattern, variable), the first that fits."""

    name: str
    signals: tuple[str, ...]
    rows: tuple[tuple[str, str], ...]
    refuse: tuple[str, ...] = ()
    least: int = 3


@dataclass(frozen=True)
class Grid:
    """Rows and columns: ``columns`` are (header pattern, variable stem), ``rows`` (label pattern,
    suffix); a column that ``skip`` names is never read."""

    name: str
    caption: str
    columns: tuple[tuple[str, str], ...]
    rows: tuple[tuple[str, str], ...]
    skip: str = r"\btotal past due|performing|^total$"


def number(cell: str | None) -> float | None:
    """As functions.text.financial_number, for a cell in a worker."""
    flat = re.sub(r"[$,\s—–]", "", cell or "")
    bare = flat.strip("()")
    if not re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", bare):
        return None
    value = float(bare)
    return -value if "(" in flat or ")" in flat else value


def joined_parentheses(cells: list[str]) -> list[str]:
    """Put together a figure whose parentheses stand in cells of their own; only blank cells may lie
    between, so that a neighbour's figure is never taken."""
    out, i = list(cells), 0
    while i < len(out):
        text = out[i].strip()
        if re.fullmatch(r"\(?\s*\$?\s*\(?\s*[\d,.]*", text) and text.count("(") > text.count(")"):
            k = i + 1
            while k < len(out) and not out[k].strip():
                k += 1
            while k < len(out) and text.count("(") > text.count(")") and re.fullmatch(r"[\d,.]*\)?%?|\)", out[k].strip()):
                text, out[k] = text + out[k].strip(), ""
                k += 1
            out[i] = text
        i += 1
    return out


def scale_of(*texts: str) -> float | None:
    for t in texts:
        if m := _UNIT.search(t or ""):
            return _FACTOR[m[1].lower()]
    return None


def choose(caption: str, cells: list[list[str]], specs: list[Table]) -> Table | None:
    head = " ".join([caption, *(" ".join(r) for r in cells[:2])]).lower()
    body = " ".join(r[0] for r in cells if r).lower()
    ranked = []
    for place, spec in enumerate(specs):
        if any(re.search(p, head) for p in spec.refuse):
            continue
        points = sum(3 * bool(re.search(p, head)) + bool(re.search(p, body)) for p in spec.signals)
        if points >= spec.least:
            ranked.append((-points, place, spec))
    return min(ranked)[2] if ranked else None


def read_rows(caption: str, cells: list[list[str]], spec: Table) -> list[tuple[str, str, float]]:
    """(variable, label, value): the first pattern that fits a row, its left-most figure; the first
    row per variable."""
    out: dict[str, tuple[str, float]] = {}
    for row in map(joined_parentheses, cells):
        label = next((c for c in row if c.strip() and number(c) is None), "")
        variable = next((v for p, v in spec.rows if re.search(p, label, re.IGNORECASE)), None)
        values = [n for c in row if "%" not in c and (n := number(c)) is not None]
        if variable and values and variable not in out:
            out[variable] = (label, values[0])
    return [(v, label, value) for v, (label, value) in out.items()]


def read_grid(caption: str, cells: list[list[str]], spec: Grid, year: int | None = None) -> list[tuple[str, str, float]]:
    """(stem_suffix, label, value) summed over rows of one suffix. The caption must fit; headers with
    years must include the asked one; a header repeated over columns counts once, by its first figure."""
    if not re.search(spec.caption, caption, re.IGNORECASE) or not cells:
        return []
    body = next((i for i, r in enumerate(cells) if sum(number(c) is not None for c in r[1:]) > 1 and not _YEAR.search(" ".join(r[1:]))), len(cells))
    width = max(map(len, cells))
    heads = [" ".join(dict.fromkeys(r[c] for r in cells[:body] if c < len(r) and r[c])) for c in range(width)]
    years = {int(y) for h in heads for y in _YEAR.findall(h)}
    if year and years and year not in years:
        return []
    groups: dict[str, list[int]] = {}
    for c, head in enumerate(heads[1:], 1):
        if head and not re.search(spec.skip, head, re.IGNORECASE):
            stem = next((s for p, s in spec.columns if re.search(p, head, re.IGNORECASE)), None)
            if stem:
                groups.setdefault(f"{stem}\0{head}", []).append(c)
    sums: dict[str, tuple[str, float]] = {}
    for row in map(joined_parentheses, cells[body:]):
        suffix = next((s for p, s in spec.rows if row and re.search(p, row[0], re.IGNORECASE)), None)
        if suffix is None:
            continue
        for name, columns in groups.items():
            value = next((n for c in columns if c < len(row) and (n := number(row[c])) is not None), None)
            if value is not None:
                key = f"{name.split(chr(0))[0]}_{suffix}"
                sums[key] = (row[0], sums.get(key, ("", 0.0))[1] + value)
    return [(k, label, v) for k, (label, v) in sums.items()]


def read_vintage(caption: str, cells: list[list[str]], asked: str, year: str, grades: tuple[tuple[str, str], ...], kept: int = 5) -> list[tuple[str, str, float]]:
    """(vintage_total_yyyy or vintage_criticized_yyyy, label, value): balances by origination year, the
    ``kept`` latest, summed over the rows of grades, of which there must be two at least; a table that
    its caption does not name is none, for its years may be reporting periods."""
    if not re.search(asked, caption, re.IGNORECASE):
        return []
    columns: dict[int, list[int]] = {}
    for row in cells[:6]:
        for c, cell in enumerate(row):
            if m := re.search(year, cell.strip()):
                columns.setdefault(int(m[1]), []).append(c)
    rows = [(next((g for p, g in grades if row and re.search(p, row[0], re.IGNORECASE)), None), row) for row in map(joined_parentheses, cells)]
    rows = [(g, row) for g, row in rows if g]
    if len(rows) < 2:
        return []
    out: dict[str, float] = {}
    for when in sorted(columns, reverse=True)[:kept]:
        for grade, row in rows:
            value = next((n for c in dict.fromkeys(columns[when]) if c < len(row) and (n := number(row[c])) is not None), None)
            if value is not None:
                for name in ("total", "criticized")[: 1 + (grade == "criticized")]:
                    out[f"vintage_{name}_{when}"] = out.get(f"vintage_{name}_{when}", 0.0) + value
    return [(k, caption[-80:], v) for k, v in out.items()]


def read_lines(text: str, rows: tuple[tuple[str, str], ...]) -> list[tuple[str, str, float, float | None]]:
    """(variable, label, value, scale) of text lines: a line that states a unit sets the scale, one
    that speaks of averages stops reading until one of period-end balances; figures followed by %
    and lone page numbers do not count."""
    out: dict[str, tuple] = {}
    scale, average = None, False
    for line in text.splitlines():
        scale = scale_of(line) or scale
        if re.search(r"\baverage\b", line, re.IGNORECASE):
            average = True
        if re.search(r"\b(period|quarter|year).end\b|\bspot\b", line, re.IGNORECASE):
            average = False
        m = re.match(r"\s*(\D*?(?:\(\d{1,2}\)\D*?)*)\$?\s*(?!\(\d{1,2}\))(\(?\d[\d,]*\.?\d*\)?)(?!\s?%|[\d.])", line)
        if average or not m or not m[1].strip():
            continue
        label = re.sub(r"\(\d{1,2}\)", "", m[1]).strip()
        variable = next((v for p, v in rows if re.search(p, label, re.IGNORECASE)), None)
        if variable and variable not in out and (value := number(m[2])) is not None:
            out[variable] = (variable, label, value, scale)
    return list(out.values())


def readings(outlines: DataFrame, key: str, tables: list[Table], grids: list[Grid] = (), year: str | None = None, skip: str | None = None, vintage: tuple | None = None) -> DataFrame:
    """``skip`` names rows that are never read, ``vintage`` the caption, year and grades of a vintage
    table. All readings of documents whose tables ``documents.html_outline`` has found; per variable and
    document the most confident, then the largest, is kept by the caller (operators.select.top_one)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for i, found in enumerate(frame["tables"]):
                for t in found:
                    caption, cells = t["caption"] or "", [list(r) for r in t["cells"]]
                    scale = scale_of(caption, *(" ".join(r) for r in cells[:2]))
                    if skip:
                        cells = [r for r in cells if not (r and re.search(skip, r[0], re.IGNORECASE))]
                    if vintage:
                        rows += [(str(frame[key].iloc[i]), caption, v, label, n, scale, 0.5) for v, label, n in read_vintage(caption, cells, *vintage)]
                    if spec := choose(caption, cells, tables):
                        rows += [(str(frame[key].iloc[i]), caption, v, label, n, scale, 0.6) for v, label, n in read_rows(caption, cells, spec)]
                    asked = int(frame[year].iloc[i]) if year else None
                    for grid in grids:
                        rows += [(str(frame[key].iloc[i]), caption, v, label, n, scale, 0.5) for v, label, n in read_grid(caption, cells, grid, asked)]
            yield pd.DataFrame(rows, columns=["doc", "caption", "variable", "label", "value", "scale", "confidence"])

    return outlines.mapInPandas(run, READING_SCHEMA)


def line_readings(docs: DataFrame, key: str, text: str, rows: tuple[tuple[str, str], ...]) -> DataFrame:
    """key, variable, label, value, scale of texts read line by line; a null text gives none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(k, *r) for k, t in zip(frame[key], frame[text], strict=True) for r in read_lines(t or "", rows)]
            yield pd.DataFrame(found, columns=[key, "variable", "label", "value", "scale"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInPandas(run, f"{key} {kind}, variable string, label string, value double, scale double")


def grid_columns(specs: list[Grid]) -> list[str]:
    """Every column that the grids may write, in order: what a panel may take from them."""
    return list(dict.fromkeys(f"{stem}_{suffix}" for g in specs for stem in dict.fromkeys(s for _, s in g.columns) for suffix in dict.fromkeys(s for _, s in g.rows)))
