"""Ranked sources: scale inference, plausibility, and gap filling that keeps provenance.

Readings are long: (key, variable, value, ...). The panel is wide, with a ``<column>__source``
beside each value column once ``tag_sources`` has run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALES = (1.0, 1e3, 1e6, 1e9)


def unpivot(df: DataFrame, key: list[str], columns: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.select(*key, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(key, columns, variable, value)


def snapped(ratio: Column, within: float = 0.02) -> Column:
    """The scale that a ratio is within 2 % of; null if none."""
    return reduce(lambda acc, s: F.when(F.abs(ratio / s - 1) <= within, s).otherwise(acc), SCALES, F.lit(None).cast("double"))


def infer_scale(readings: DataFrame, panel: DataFrame, key: list[str], columns: list[str], document: list[str]) -> DataFrame:
    """Add scale and scale_evidence: the factor that most of a document's readings need to meet the
    panel's values, ties to the smaller; evidence 0 and a null scale where none meets."""
    known = unpivot(panel, key, columns, value="_known").where("_known is not null")
    met = readings.join(known, [*key, "variable"])
    votes = met.withColumn("_s", snapped(F.col("_known") / F.nullif(F.col("value"), F.lit(0.0)))).where("_s is not null")
    counts = votes.groupBy(*document, "_s").agg(F.count("*").alias("_n"))
    mode = counts.groupBy(*document).agg(F.max_by(F.struct("_s", "_n"), F.struct("_n", -F.col("_s"))).alias("_m"))
    out = readings.join(mode, document, "left")
    return out.withColumns({"scale": F.col("_m._s"), "scale_evidence": F.coalesce("_m._n", F.lit(0))}).drop("_m")


def scaled(readings: DataFrame, declared: str | None = None, least: int = 2) -> DataFrame:
    """Values in units; a declared scale stands before an inferred one, which needs ``least`` pieces
    of evidence. A reading whose scale is unproven is dropped."""
    inferred = F.when(F.col("scale_evidence") >= least, F.col("scale"))
    use = F.coalesce(declared, inferred) if declared else inferred
    return readings.withColumn("_use", use).where("_use is not null").withColumn("value", F.col("value") * F.col("_use")).drop("_use")


def widen(readings: DataFrame, key: list[str], variables: list[str]) -> DataFrame:
    """The best reading per key and variable (confidence, then latest filed), one column each."""
    w = Window.partitionBy(*key, "variable").orderBy(F.desc("confidence"), F.desc_nulls_last("filed"), F.desc("value"))
    best = readings.withColumn("_r", F.row_number().over(w)).where("_r = 1")
    return best.groupBy(*key).pivot("variable", variables).agg(F.first("value"))


def reject_partial(wide: DataFrame, panel: DataFrame, key: list[str], total: str, prefix: str, within: float = 0.2) -> DataFrame:
    """Where the parsed total is off the panel's by more than 20 %, the document speaks of a part of
    the book: its ``prefix`` columns become null."""
    both = wide.join(panel.select(*key, F.col(total).alias("_t")), key, "left")
    off = F.coalesce(F.abs(F.col(total) / F.nullif(F.col("_t"), F.lit(0.0)) - 1) > within, F.lit(False))
    return both.withColumns({c: F.when(~off, F.col(c)) for c in wide.columns if c.startswith(prefix) and c not in key}).drop("_t")


def reject_implausible(wide: DataFrame, panel: DataFrame, key: list[str], total: str, prefixes: tuple[str, ...], ceiling: float = 1.05) -> DataFrame:
    """Null what exceeds 1.05 times the panel's total, for columns that are parts of it."""
    both = wide.join(panel.select(*key, F.col(total).alias("_t")), key, "left")
    keep = lambda c: F.when(F.col("_t").isNull() | (F.abs(c) <= F.abs("_t") * ceiling), F.col(c))
    return both.withColumns({c: keep(c) for c in wide.columns if c not in key and c != total and c.startswith(prefixes)}).drop("_t")


def tag_sources(panel: DataFrame, columns: list[str], source: str) -> DataFrame:
    return panel.withColumns({f"{c}__source": F.when(F.col(c).isNotNull(), source) for c in columns})


def fill_gaps(panel: DataFrame, wide: DataFrame, key: list[str], source: str, allow_new: bool = False) -> DataFrame:
    """Null cells only are written, each with its source; new columns only if allowed."""
    given = [c for c in wide.columns if c not in key]
    use = [c for c in given if allow_new or c in panel.columns]
    met = panel.join(wide.select(*key, *(F.col(c).alias(f"_w_{c}") for c in use)), key, "left")
    out = {}
    for c in use:
        own = F.col(c) if c in panel.columns else F.lit(None).cast("double")
        tag = F.col(f"{c}__source") if f"{c}__source" in panel.columns else F.lit(None).cast("string")
        out[f"{c}__source"] = F.when(own.isNull() & F.col(f"_w_{c}").isNotNull(), source).otherwise(tag)
        out[c] = F.coalesce(own, f"_w_{c}")
    return met.withColumns(out).drop(*(f"_w_{c}" for c in use)) if use else panel


def refresh_ratios(panel: DataFrame, ratios: dict[str, Column], source: str) -> DataFrame:
    """Null ratios only are worked out anew, and say so."""
    out = {}
    for name, value in ratios.items():
        own = F.col(name) if name in panel.columns else F.lit(None).cast("double")
        tag = F.col(f"{name}__source") if f"{name}__source" in panel.columns else F.lit(None).cast("string")
        out[f"{name}__source"] = F.when(own.isNull() & value.isNotNull(), source).otherwise(tag)
        out[name] = F.coalesce(own, value)
    return panel.withColumns(out)


def reconcile(panel: DataFrame, readings: DataFrame, key: list[str], columns: list[str], document: list[str], total: str, prefixes: tuple[str, ...], source: str = "html", tagged: str | None = "xbrl", declared: str | None = None, proof: DataFrame | None = None, partial: str | None = None, ratios: dict[str, Column] | None = None, allow_new: bool = False) -> DataFrame:
    """Fill a panel's gaps from one source of readings: scales inferred against ``proof`` (else the
    panel) or declared, unproven ones dropped; columns of a part of the book (``partial``: their
    prefix) and those that exceed the total refused; null cells filled with their source; null ratios
    worked out anew. ``tagged`` names the source of what the panel has; None where it says so itself,
    as after a first call, so sources merge in the order of the calls."""
    out = tag_sources(panel, columns, tagged) if tagged else panel
    wide = widen(scaled(infer_scale(readings, proof or panel, key, columns, document), declared), key, columns)
    if partial:
        wide = reject_partial(wide, panel, key, total, partial)
    wide = reject_implausible(wide, panel, key, total, prefixes)
    filled = fill_gaps(out, wide, key, source, allow_new)
    return refresh_ratios(filled, ratios, f"derived_{source}") if ratios else filled
