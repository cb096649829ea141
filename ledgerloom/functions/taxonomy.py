"""Classes, scopes and buckets of dimension members, by the rule tables of ``members``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import members
from .rules import first_match, lookup

def scope_of(member: Column) -> Column:
    """The measurement basis that a member states: an exact entry, else a rule; null for a class."""
    return lookup(member, members.SCOPES, first_match(member, members.SCOPE_RULES))


def loan_category(member: Column, ticker: Column | None = None) -> Column:
    """What one filer's own reading says, else nothing for a measurement basis, else the rules."""
    ruled = F.when(scope_of(member).isNull(), first_match(member, members.LOAN_CLASSES))
    if ticker is None:
        return ruled
    own = F.lit(None).cast("string")
    for (who, name), category in members.OVERRIDES.items():
        own = F.when((ticker == who) & (member == name), category).otherwise(own)
    return F.coalesce(own, ruled)


def credit_quality(member: Column) -> Column:
    return first_match(member, members.CREDIT_QUALITY)


def credit_quality_family(bucket: Column) -> Column:
    """The family that a bucket may share a ratio with; null for a null bucket."""
    table = {b: family for family, buckets in members.CREDIT_QUALITY_FAMILIES.items() for b in buckets}
    return F.when(bucket.isNotNull(), lookup(bucket, table, F.lit("regulatory")))


def past_due(member: Column) -> Column:
    return first_match(member, members.PAST_DUE, ignore_case=True)


def document_kind(title: Column) -> Column:
    """The kind that a title or file name tells; null for what is not quarterly."""
    plain = F.trim(F.regexp_replace(title, r"[+_\-/\\.]+", " "))
    return F.when(~plain.rlike("(?i)" + members.NOT_QUARTERLY), first_match(plain, members.DOCUMENTS, ignore_case=True))


def content_kind(html: Column, exhibit: Column | None = None) -> Column:
    """The kind that a document's opening text tells, else the one that its exhibit number suggests. A
    document with hardly any readable text (slides of images) has no kind."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    head = F.left(F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), r"\s+", " ")), F.lit(members.OPENING))
    told = first_match(head, members.CONTENTS, ignore_case=True)
    if exhibit is not None:
        told = F.coalesce(told, lookup(exhibit, members.EXHIBITS))
    return F.when(F.length(head) >= members.READABLE, told)


def _stated(dims: Column) -> Column:
    """The first measurement basis among the members of "axis=member;axis=member"."""
    named = F.transform(F.split(F.coalesce(dims, F.lit("")), ";"), lambda x: scope_of(F.regexp_extract(x, "=(.*)$", 1)))
    return F.get(F.filter(named, lambda x: x.isNotNull()), F.lit(0))


def attach_categories(facts: DataFrame, superseded: dict[tuple[str, str], tuple[str, ...]] | None = None, by_tag: dict[str, str] | None = None) -> DataFrame:
    """Add loan_cat, cq_cat, pd_cat and scope to facts with ticker, tag, segment, loan_class,
    credit_quality, past_due and other_dims. Names of columns that begin with _ are this call's.

    The class goes before the segment. A measurement basis, wherever it is stated, leaves no loan
    category. A rollup in ``superseded`` ((ticker, rollup) -> parts; ``members.SUPERSEDED`` if none is
    given) has the scope "rollup" at an instant where the same filer's instants of that period have
    one of its parts: one window over the facts. ``by_tag`` tells the past-due bucket of old tags,
    where no member does. Rules run once per distinct (ticker, members), which then meets its rows."""
    superseded = members.SUPERSEDED if superseded is None else superseded
    keys = ["ticker", "segment", "loan_class", "credit_quality", "past_due", "other_dims"]
    member = F.coalesce(F.when(F.col("loan_class") != "", F.col("loan_class")), "segment")
    scope = F.coalesce(scope_of(F.col("loan_class")), scope_of(F.col("segment")), _stated(F.col("other_dims")))
    named = facts.select(*keys).distinct().withColumns({"_scope": scope, "_loan": loan_category(member, F.col("ticker")), "_cq": credit_quality(F.col("credit_quality")), "_pd": past_due(F.col("past_due"))})
    other = named.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "_scope", "_loan", "_cq", "_pd")
    same = [facts[k].eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    met = facts.join(other, same, "left").drop(*(f"_k_{k}" for k in keys))
    final = F.col("_scope")
    if superseded:
        # only the named parts are gathered, so the set is as small as the rule table
        parts = sorted({x for found in superseded.values() for x in found})
        seen = F.array_distinct(F.flatten(F.collect_set(F.when(F.col("instant"), F.array_intersect(F.array(F.coalesce("loan_class", F.lit("")), F.coalesce("segment", F.lit(""))), F.array(*map(F.lit, parts))))).over(Window.partitionBy("ticker", "period"))))
        met = met.withColumn("_seen", seen)
        for (who, rollup), own in superseded.items():
            hit = F.col("instant") & (F.col("ticker") == who) & (member == rollup) & F.arrays_overlap("_seen", F.array(*map(F.lit, own)))
            final = F.when(F.coalesce(hit, F.lit(False)), "rollup").otherwise(final)
    out = met.withColumn("scope", final)
    out = out.withColumns({
        "loan_cat": F.when(F.col("scope").isNull(), F.col("_loan")),
        "cq_cat": F.col("_cq"),
        "pd_cat": F.coalesce(F.col("_pd"), lookup(F.col("tag"), by_tag)) if by_tag else F.col("_pd"),
    })
    return out.drop("_scope", "_loan", "_cq", "_pd", "_seen")
