"""Which documents there are, which one fills a slot, and which reading of several stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.taxonomy import document_kind
from ..functions.text import document_quarter
from ..operators.select import top_one

#: Formats in the order in which they are read best.
FORMATS = ("xlsx", "xls", "html", "htm", "pdf")


def rank_in(value: Column, order: tuple[str, ...]) -> Column:
    """Place in a list; what is not in it comes last."""
    place = F.array_position(F.array(*(F.lit(x) for x in order)), value)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def exhibits(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, seq, href, document: the links of a filing index; a viewer's ``doc=`` is unwrapped."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?i)<a\s[^>]*href\s*=\s*[\"']([^\"'#][^\"']*)[\"']"), 1)
    each = pages.select(key, F.posexplode(links).alias("seq", "href"))
    inner = F.regexp_extract("href", r"[?&]doc=([^&#]+)", 1)
    target = F.when(inner != "", inner).otherwise(F.regexp_replace("href", "[?#].*$", ""))
    return each.withColumn("document", F.element_at(F.split(target, "/"), -1))


def cached(paths: DataFrame, path: str = "path") -> DataFrame:
    """Add year, quarter, kind and format, as the file's name tells them; files that name no quarter
    or no known kind go."""
    name = F.element_at(F.split(path, "/"), -1)
    out = paths.withColumn("_at", document_quarter(name))
    out = out.withColumns({"year": F.col("_at.y"), "quarter": F.col("_at.q"), "kind": document_kind(name), "format": F.lower(F.element_at(F.split(name, r"\."), -1))})
    return out.where(F.col("year").isNotNull() & F.col("kind").isNotNull()).drop("_at")


def one_per_slot(found: DataFrame, slot: list[str], routes: tuple[str, ...], route: str = "origin", path: str = "path") -> DataFrame:
    """The first route keeps a slot; within it the best format, then the lesser path."""
    return top_one(found, slot, rank_in(F.col(route), routes), rank_in(F.col("format"), FORMATS), F.asc(path))


def surest(readings: DataFrame, slot: list[str]) -> DataFrame:
    """Within a document: the most confident reading per slot, then the largest."""
    return top_one(readings, slot, F.desc("confidence"), F.desc(F.abs("value")), F.asc("label"))


def consolidated(readings: DataFrame, slot: list[str], kinds: tuple[str, ...] = ("supplement", "release", "presentation")) -> DataFrame:
    """Across documents: the supplement's reading first, then the largest, then the surest."""
    return top_one(readings, slot, rank_in(F.col("kind"), kinds), F.desc(F.abs("value")), F.desc("confidence"), F.asc("doc"))


def second_pass(first: DataFrame, filings: DataFrame, key: str, again) -> DataFrame:
    """Readings of a first pass, and those that ``again`` finds in filings which gave none."""
    silent = filings.join(first.select(key).distinct(), key, "left_anti")
    return first.unionByName(again(silent))


def missing_from_cache(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(cache.select(key).distinct(), key, "left_anti")


def shares(text: Column, section: str, fields: dict[str, str], boundary: str = r"\n\s*\n", within: tuple[float, float] = (95.0, 105.0)) -> Column:
    """A phrase read as a whole: after ``section`` and up to ``boundary``, each field's pattern holds
    one percentage; a struct of them where all are there and add up to about 100, else null."""
    part = F.split(F.regexp_extract(text, f"(?s){section}(.*)", 1), boundary)[0]
    found = {k: F.regexp_extract(part, p, 1).try_cast("double") for k, p in fields.items()}
    total = sum(found.values(), F.lit(0.0))
    return F.when(total.between(*within), F.struct(*(v.alias(k) for k, v in found.items())))


def manifest(docs: DataFrame) -> DataFrame:
    """What the documents are: bank, quarter, doc_type, origin, ext, title (160 characters), path and
    bytes, for a sink."""
    quarter = F.concat(F.col("year").cast("string"), F.lit("Q"), F.col("quarter").cast("string"))
    return docs.select("bank", quarter.alias("quarter"), F.col("kind").alias("doc_type"), "origin", F.col("format").alias("ext"), F.left("title", F.lit(160)).alias("title"), "path", "bytes")
