"""The registry of institutions: who exists, who absorbed whom, who controls whom.

Inputs are the registry's tables as text columns (``documents.zipped_csv`` reads them); stamps are
YYYYMMDD, and zero, blank and open-ended ones are null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.periods import stamp_to_date
from ..functions.text import employer_id
from ..operators import graph
from ..operators.select import top_one

# Codes of a transformation that ends the predecessor, the one of a failure, and the
# reasons of termination that state one.
ABSORBED, FAILED, FAILED_REASONS = ("1", "9", "50"), "50", ("4", "5")
ENTITY = ("ID_RSSD", "NM_LGL", "ENTITY_TYPE", "ID_TAX", "ID_LEI", "ID_FDIC_CERT", "BHC_IND", "IHC_IND", "DT_OPEN", "DT_END", "REASON_TERM_CD")
EVENT = ("ID_RSSD_PREDECESSOR", "ID_RSSD_SUCCESSOR", "DT_TRANS", "TRNSFM_CD", "ACCT_METHOD")
RELATION = ("ID_RSSD_PARENT", "ID_RSSD_OFFSPRING", "CTRL_IND", "DT_START", "DT_END")


def _text(name: str) -> Column:
    """Without blanks at the ends; null where nothing is left."""
    return F.nullif(F.trim(name), F.lit(""))


def _marked(name: str) -> Column:
    """Null where the registry means none: blank or zero."""
    return F.nullif(_text(name), F.lit("0"))


def entities(active: DataFrame, closed: DataFrame) -> DataFrame:
    """One row per id; a closed institution never stands for an active one of the same id. Repeated
    rows of one table: the one with the earliest opening, then the lesser name."""
    both = active.select(*ENTITY).withColumn("active", F.lit(True)).unionByName(closed.select(*ENTITY).withColumn("active", F.lit(False)))
    rows = both.select(
        F.trim("ID_RSSD").try_cast("bigint").alias("rssd"), _text("NM_LGL").alias("name"), _text("ENTITY_TYPE").alias("entity_type"), _marked("ID_TAX").alias("ein"), _marked("ID_LEI").alias("lei"),
        _marked("ID_FDIC_CERT").try_cast("bigint").alias("fdic_cert"), (F.coalesce(F.trim("BHC_IND"), F.lit("0")) == "1").alias("is_bhc"), (F.coalesce(F.trim("IHC_IND"), F.lit("0")) == "1").alias("is_ihc"), "active",
        stamp_to_date(F.col("DT_OPEN")).alias("opened"), stamp_to_date(F.col("DT_END")).alias("ended"), F.coalesce(_text("REASON_TERM_CD"), F.lit("0")).alias("reason_term"),
    )
    return top_one(rows.where("rssd is not null"), ["rssd"], F.desc("active"), F.asc_nulls_last("opened"), F.asc("name"))


def successions(events: DataFrame) -> DataFrame:
    """predecessor, successor, date, code, pooled, failure: events that end the predecessor. Rows
    without two ids or a valid day are left out."""
    code = F.trim("TRNSFM_CD")
    rows = events.where(code.isin(*ABSORBED)).select(
        F.trim("ID_RSSD_PREDECESSOR").try_cast("bigint").alias("predecessor"), F.trim("ID_RSSD_SUCCESSOR").try_cast("bigint").alias("successor"), stamp_to_date(F.col("DT_TRANS")).alias("date"),
        code.alias("code"), (F.coalesce(F.trim("ACCT_METHOD"), F.lit("")) == "1").alias("pooled"), (code == FAILED).alias("failure"),
    )
    return rows.where("predecessor is not null and successor is not null and date is not null")


def relationships(rows: DataFrame) -> DataFrame:
    """parent, child, start, end of control; a null bound is open."""
    kept = rows.where(F.trim("CTRL_IND") == "1")
    out = kept.select(F.trim("ID_RSSD_PARENT").try_cast("bigint").alias("parent"), F.trim("ID_RSSD_OFFSPRING").try_cast("bigint").alias("child"), stamp_to_date(F.col("DT_START")).alias("start"), stamp_to_date(F.col("DT_END")).alias("end"))
    return out.where("parent is not null and child is not null")


def failed(events: DataFrame, known: DataFrame) -> DataFrame:
    """rssd of all that failed, by the events or by the reason of termination."""
    return events.where("failure").select(F.col("predecessor").alias("rssd")).unionByName(known.where(F.col("reason_term").isin(*FAILED_REASONS)).select("rssd")).distinct()


def by_successor(events: DataFrame) -> DataFrame:
    """successor and its events, oldest first: what one institution absorbed."""
    each = F.struct("date", "predecessor", "code", "pooled", "failure")
    return events.groupBy("successor").agg(F.array_sort(F.collect_list(each)).alias("events"))


def by_employer(known: DataFrame) -> DataFrame:
    """ein (nine digits) and the ids that have it, in order; ids without one are left out."""
    return known.withColumn("ein", employer_id(F.col("ein"))).where("ein is not null").groupBy("ein").agg(F.array_sort(F.collect_set("rssd")).alias("rssds"))


def parents_at(edges: DataFrame, days: DataFrame) -> DataFrame:
    """period, child and its parents, in order, on each of the days."""
    return graph.edges_at(edges, days).groupBy("period", "child").agg(F.array_sort(F.collect_set("parent")).alias("parents"))


def filers_under(roots: DataFrame, edges: DataFrame, roster: DataFrame, depth: int = 12) -> DataFrame:
    """period, root, rssd: the root and what it controls, as far as they filed. roots: root; roster:
    rssd, period."""
    days = roster.select("period").distinct()
    dated = graph.edges_at(edges, days)
    starts = dated.select("period", F.col("parent").alias("root")).unionByName(roster.select("period", F.col("rssd").alias("root"))).distinct()
    closed = graph.closure(starts.join(roots.select("root").distinct(), "root", "left_semi"), dated, ["period"], depth)
    return closed.withColumnRenamed("node", "rssd").join(roster.select("rssd", "period").distinct(), ["rssd", "period"], "left_semi").select("period", "root", "rssd")


def missing_depositories(unfiled: DataFrame, known: DataFrame) -> DataFrame:
    """rssd and certificate of every institution that some quarter lists as not filing (ids joined
    by ``;`` in insured_not_filing)."""
    ids = graph.split_ids(unfiled.select("insured_not_filing"), "insured_not_filing", "rssd").select("rssd").distinct()
    return ids.join(known.select("rssd", "fdic_cert"), "rssd").where("fdic_cert is not null")
