"""Dated ownership graphs: edges as of a day, bounded closures, claims and rollups."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def alive(day: Column, start: Column, end: Column) -> Column:
    """Whether [start, end] holds the day; a null bound is open."""
    return (start.isNull() | (start <= day)) & (end.isNull() | (end >= day))


def edges_at(edges: DataFrame, days: DataFrame, day: str = "period") -> DataFrame:
    """(day, parent, child) for every edge and each of ``days`` it covers, by exploding an edge's
    own quarter ends instead of comparing every pair; open bounds are clipped to the days."""
    span = days.agg(F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    low, high = span.first() or (None, None)
    if low is None:
        return edges.select(F.lit(None).cast("date").alias(day), "parent", "child").limit(0)
    start = F.greatest(F.coalesce("start", F.lit(low)), F.lit(low))
    end = F.least(F.coalesce("end", F.lit(high)), F.lit(high))
    ends = F.filter(F.transform(F.sequence(F.trunc(start, "quarter"), F.trunc(end, "quarter"), F.expr("interval 3 months")), lambda d: F.last_day(F.add_months(d, 2))), lambda d: (d >= start) & (d <= end))
    covered = edges.where(start <= end).select("parent", "child", F.explode(ends).alias(day))
    return covered.join(days.select(day).distinct(), day, "left_semi").distinct()


def closure(roots: DataFrame, edges: DataFrame, group: list[str], depth: int | None = 12) -> DataFrame:
    """(group, root, node, depth): what each root reaches within ``depth`` steps (None: as far as the
    edges go), breadth first, the root itself at depth 0. Cycles end by an anti-join on what was seen. Roots,
    edges and every round are checkpoints, so no round runs again what made them, plans stay short and a
    lost executor costs one round."""
    seen = cut(roots.select(*group, "root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct())
    front = seen
    keyed = cut(edges.select(*group, F.col("parent").alias("node"), "child"))
    for d in count(1) if depth is None else range(1, depth + 1):
        reached = front.join(keyed, [*group, "node"]).select(*group, "root", F.col("child").alias("node")).distinct()
        front = cut(reached.join(seen, [*group, "root", "node"], "left_anti").withColumn("depth", F.lit(d)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def claim_once(candidates: DataFrame, item: list[str], order: list[Column]) -> DataFrame:
    """Each item goes to the claimant that a greedy pass in ``order`` would give it to: the claim
    that comes first takes it, whatever else is claimed, so one ranking decides them all."""
    w = Window.partitionBy(*item).orderBy(*order)
    return candidates.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def unfiled(closed: DataFrame, roster: DataFrame, entities: DataFrame, types: tuple[str, ...], key: list[str]) -> DataFrame:
    """Insured institutions of a closure that did not file: count and ids joined by ``;``.

    closed: key, period, node; roster: rssd, period; entities: rssd, fdic_cert, entity_type, opened,
    ended (dates)."""
    ids = closed.select(*key, "period", F.col("node").alias("rssd")).distinct()
    missing = ids.join(roster.select("rssd", "period").distinct(), ["rssd", "period"], "left_anti")
    live = missing.join(entities.where((F.col("fdic_cert") > 0) & F.col("entity_type").isin(*types)), "rssd").where(alive(F.col("period"), F.col("opened"), F.col("ended")))
    return live.groupBy(*key, "period").agg(F.count("*").alias("n_insured_not_filing"), ordered_list("rssd").alias("insured_not_filing"))


def ordered_list(column: str) -> Column:
    """Distinct values in their own order, then as text joined by ``;``."""
    return F.array_join(F.transform(F.array_sort(F.collect_set(column)), lambda x: x.cast("string")), ";")


def roll_up(members: DataFrame, mapping: DataFrame, on: list[str], key: list[str], sums: list[str], member: str, flags: dict[str, str] | None = None, weighted: tuple[str, str, str] | None = None) -> DataFrame:
    """Sum members to their holder; a column that no member reports stays null. Adds n_members and
    the ordered list; ``flags``: out -> boolean column of the mapping, true if any is;
    ``weighted``: (out, value, weight), the weight covered by members that report the value, in
    percent of all weight."""
    m = members.join(mapping, on)
    aggs = [F.sum(c).alias(c) for c in sums] + [F.count_distinct(member).alias("n_members"), ordered_list(member).alias("members")]
    aggs += [F.max(F.coalesce(c, F.lit(False))).alias(out) for out, c in (flags or {}).items()]
    if weighted:
        out, value, weight = weighted
        covered = F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))
        aggs.append((F.coalesce(covered, F.lit(0.0)) / F.nullif(F.sum(weight), F.lit(0.0)) * 100).alias(out))
    return m.groupBy(*key).agg(*aggs)


def merge_backfill(filed: DataFrame, backfill: DataFrame, claimed: DataFrame, key: list[str], names: tuple[str, str] = ("filed", "backfill")) -> DataFrame:
    """All filed rows, and those backfilled rows that nobody filed and somebody claims."""
    extra = backfill.join(filed.select(*key), key, "left_anti").join(claimed.select(*key).distinct(), key, "left_semi")
    return filed.withColumn("source", F.lit(names[0])).unionByName(extra.withColumn("source", F.lit(names[1])), allowMissingColumns=True)


def split_ids(df: DataFrame, column: str, out: str, cast: str = "bigint") -> DataFrame:
    """One row per id of a ``;`` list."""
    return df.withColumn(out, F.explode(F.filter(F.split(column, ";"), lambda x: F.length(x) > 0))).withColumn(out, F.col(out).cast(cast))


def identity_checks(df: DataFrame, checks: dict[str, tuple[list[str], str]]) -> DataFrame:
    """Per check (terms, total): how many rows hold it, of how many that have all of its columns;
    tolerance max(1, 1e-6 |total|)."""
    out = []
    for name, (terms, total) in checks.items():
        signed = [-F.col(t[1:]) if t.startswith("-") else F.col(t) for t in terms]
        built = reduce(lambda a, b: a + b, signed)
        usable = built.isNotNull() & F.col(total).isNotNull()
        holds = usable & (F.abs(built - F.col(total)) <= F.greatest(F.lit(1.0), F.abs(total) * 1e-6))
        out += [F.count_if(holds).alias(f"{name}_held"), F.count_if(usable).alias(f"{name}_checked")]
    return df.agg(*out)


def pooled_events(events: DataFrame, rssds: DataFrame) -> DataFrame:
    """rssd, predecessor, period: mergers of interest whose survivor restates the year, dated by the
    first quarter end on or after them."""
    from ..functions.periods import quarter_end

    hit = events.where("pooled").join(rssds.select(F.col("rssd").alias("successor")).distinct(), "successor")
    return hit.select(F.col("successor").alias("rssd"), "predecessor", quarter_end(F.col("date")).alias("period")).distinct()


def top_holders(nodes: DataFrame, edges: DataFrame, depth: int | None = None) -> DataFrame:
    """(node, holder): the ancestors of each node that nobody holds, however far up they are unless
    ``depth`` bounds the steps."""
    up = edges.select(F.col("child").alias("parent"), F.col("parent").alias("child"), F.lit(1).alias("_g"))
    reached = closure(nodes.select(F.col("node").alias("root"), F.lit(1).alias("_g")), up, ["_g"], depth)
    held = edges.select(F.col("child").alias("node")).distinct()
    return reached.join(held, "node", "left_anti").select(F.col("root").alias("node"), F.col("node").alias("holder"))
