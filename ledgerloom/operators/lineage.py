"""Who became part of whom: predecessors of each holding, walked back quarter by quarter.

The walk depends on its own results (a predecessor found in a later quarter is a root in earlier
ones), so each holding is one group of applyInPandas; the graph that a holding's walk can reach is
cut out before, by joins, and is what the group holds."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

FAILURE, REORGANISED, MERGED, BOUGHT = "fdic_assisted", "reorg", "merger", "ACQ"
SCHEMA = "holding bigint, predecessor bigint, successor bigint, effective_to date, succession_type string, code string, pooled boolean"


class Graph:
    """Dated edges and events of one holding's surroundings."""

    def __init__(self, edges: pd.DataFrame, events: pd.DataFrame):
        self.children: dict[int, list] = defaultdict(list)
        self.parents: dict[int, list] = defaultdict(list)
        for p, c, start, end in edges[["parent", "child", "start", "end"]].itertuples(index=False):
            span = (pd.Timestamp.min if pd.isna(start) else pd.Timestamp(start), pd.Timestamp.max if pd.isna(end) else pd.Timestamp(end))
            self.children[int(p)].append((int(c), *span))
            self.parents[int(c)].append((int(p), *span))
        self.into: dict[int, list] = defaultdict(list)
        for e in events.itertuples(index=False):
            self.into[int(e.successor)].append((int(e.predecessor), pd.Timestamp(e.date), str(e.code), bool(e.pooled)))

    def below(self, roots: set[int], day: pd.Timestamp, depth: int = 12) -> set[int]:
        seen, front = set(roots), set(roots)
        for _ in range(depth):
            front = {c for n in front for c, a, b in self.children[n] if a <= day <= b} - seen
            if not front:
                break
            seen |= front
        return seen


def walk(own: set[int], quarters: list[pd.Timestamp], graph: Graph, depository: set[int], failed: set[int], opened: dict[int, pd.Timestamp], floor: pd.Timestamp) -> list[tuple]:
    """(predecessor, successor, effective_to, type, code, pooled) of one holding."""
    found: dict[int, tuple] = {}

    def roots(day: pd.Timestamp) -> set[int]:
        return own | {p for p, f in found.items() if f[1] >= day}

    def inside(node: int, before: pd.Timestamp, event: pd.Timestamp) -> bool:
        """A member at the quarter end before the event, by a root that outlives it."""
        lasting = own | {p for p, f in found.items() if f[1] > event and p != node}
        return node in graph.below(lasting, before)

    def take(node: int, successor: int, day: pd.Timestamp, code: str, pooled: bool) -> None:
        todo = [(node, successor, day, code, pooled)]
        while todo:
            p, s, when, cd, pool = todo.pop()
            if p in own or p in found or when < floor:
                continue
            before = when - pd.offsets.QuarterEnd(1)
            kind = FAILURE if cd == "50" or p in failed else REORGANISED if cd != BOUGHT and inside(p, before, when) else MERGED
            found[p] = (s, when, kind, cd, pool)
            todo += [(a, p, d, c, f) for a, d, c, f in graph.into[p] if floor <= d <= when]

    for end in sorted(quarters, reverse=True):
        if end < floor:
            continue
        start = end - pd.offsets.QuarterEnd(1)
        for member in sorted(graph.below(roots(end), end)):
            for p, day, code, pooled in graph.into[member]:
                if start < day <= end:
                    take(p, member, day, code, pooled)
        members, before = graph.below(roots(end), end), graph.below(roots(start), start)
        for member in sorted(members - before - own - set(found)):
            joins = [a for p, a, _ in graph.parents[member] if p in members and start < a <= end]
            newer = member in opened and opened[member] > start
            under = any(p in before for p, a, b in graph.parents[member] if a <= start <= b)
            if joins and not newer and not under and graph.below({member}, start) & depository:
                up = min(p for p, a, _ in graph.parents[member] if p in members and a == min(joins))
                take(member, up, min(joins), BOUGHT, False)
    return [(p, *f) for p, f in sorted(found.items())]


def resolve(holdings: DataFrame, quarters: DataFrame, edges: DataFrame, events: DataFrame, entities: DataFrame, floor: str, hops: int = 24) -> DataFrame:
    """Predecessors of all holdings. holdings: holding, rssd; quarters: period; edges: parent, child,
    start, end (dates); events: predecessor, successor, date, code, pooled; entities: rssd,
    depository, failed, opened."""
    ends = [pd.Timestamp(r[0]) for r in quarters.select("period").distinct().orderBy("period").collect()]
    first = pd.Timestamp(floor)
    # only what is alive or happens within the days asked can be met
    if ends:
        edges = edges.where((F.col("start").isNull() | (F.col("start") <= F.lit(max(ends).date()))) & (F.col("end").isNull() | (F.col("end") >= F.lit(min(ends[0], first).date()) - F.expr("interval 3 months"))))
        events = events.where(F.col("date").between(F.lit(first.date()), F.lit(max(ends).date())))
    near = holdings.select("holding", F.col("rssd").alias("node")).distinct()
    links = edges.select(F.col("parent").alias("node"), F.col("child").alias("next")).unionByName(events.select(F.col("successor").alias("node"), F.col("predecessor").alias("next"))).distinct()
    front = near
    for _ in range(hops):  # whatever the dated walk can meet lies in this reach
        front = cut(front.join(links, "node").select("holding", F.col("next").alias("node")).distinct().join(near, ["holding", "node"], "left_anti"))
        if front.isEmpty():
            break
        near = near.unionByName(front)
    up = edges.join(near.withColumnRenamed("node", "child"), "child")
    packed = {
        "own": holdings.groupBy("holding").agg(F.collect_set("rssd").alias("own")),
        "edges": up.groupBy("holding").agg(F.collect_list(F.struct("parent", "child", "start", "end")).alias("edges")),
        "events": events.join(near.withColumnRenamed("node", "successor"), "successor").groupBy("holding").agg(F.collect_list(F.struct("predecessor", "successor", "date", "code", "pooled")).alias("events")),
        "facts": entities.join(near.withColumnRenamed("node", "rssd"), "rssd").groupBy("holding").agg(F.collect_list(F.struct("rssd", "depository", "failed", "opened")).alias("facts")),
    }
    each = packed.pop("own")
    for part in packed.values():
        each = each.join(part, "holding", "left")

    def frame(rows, columns: list[str]) -> pd.DataFrame:
        return pd.DataFrame([{c: r[c] for c in columns} for r in (rows if rows is not None else [])], columns=columns)

    def run(frames):
        for batch in frames:
            out = []
            for row in batch.itertuples(index=False):
                graph = Graph(frame(row.edges, ["parent", "child", "start", "end"]), frame(row.events, ["predecessor", "successor", "date", "code", "pooled"]))
                facts = frame(row.facts, ["rssd", "depository", "failed", "opened"])
                pick = lambda c, facts=facts: {int(r) for r, v in zip(facts["rssd"], facts[c], strict=True) if v}
                opened = {int(r): pd.Timestamp(o) for r, o in zip(facts["rssd"], facts["opened"], strict=True) if not pd.isna(o)}
                for p, s, when, kind, code, pooled in walk({int(x) for x in row.own}, ends, graph, pick("depository"), pick("failed"), opened, first):
                    out.append((int(row.holding), p, s, when.date(), kind, code, pooled))
            yield pd.DataFrame(out, columns=["holding", "predecessor", "successor", "effective_to", "succession_type", "code", "pooled"], dtype=object)

    return each.mapInPandas(run, SCHEMA)


def claimed(holdings: DataFrame, lineage: DataFrame, quarters: DataFrame, closures: DataFrame, roster: DataFrame) -> DataFrame:
    """period, rssd, holding, via: each filer once. Own roots come before predecessors, holdings in
    their order, failures and mergers before reorganisations, the longest-lived predecessor first.

    closures: period, root, node; holdings: holding, rssd, ord and maybe until (date)."""
    from .graph import claim_once

    own = holdings.select("holding", "ord", F.col("rssd").alias("root"), F.lit(None).cast("bigint").alias("via"), F.lit(0).alias("pass"), F.lit(False).alias("reorg"), F.col("until"))
    old = lineage.join(holdings.select("holding", "ord").distinct(), "holding").select(
        "holding", "ord", F.col("predecessor").alias("root"), F.col("predecessor").alias("via"), F.lit(1).alias("pass"), (F.col("succession_type") == REORGANISED).alias("reorg"), F.col("effective_to").alias("until")
    )
    reach = closures.join(own.unionByName(old), "root").where(F.col("until").isNull() | (F.col("until") >= F.col("period")))
    able = reach.withColumnRenamed("node", "rssd").join(roster.select("rssd", "period").distinct(), ["rssd", "period"], "left_semi")
    order = [F.asc("pass"), F.asc("ord"), F.asc("reorg"), F.asc("until"), F.asc("via")]
    return claim_once(able, ["period", "rssd"], order).select("period", "rssd", "holding", "via")


def matched_entities(targets: DataFrame, entities: DataFrame, filers: DataFrame) -> DataFrame:
    """Targets (target, ein, name) to entities (rssd, ein, name, active, is_holding), names and eins
    normalised before: by ein, else by equal name or a name that starts with the target's first
    word group; ranked by ein, filing, active, holding, then the lesser id."""
    filing = filers.select("rssd").distinct().withColumn("files", F.lit(True))
    e = entities.join(filing, "rssd", "left").fillna({"files": False})
    by_ein = targets.join(e.withColumnRenamed("name", "ename"), "ein").select("target", "rssd", "files", "active", "is_holding", F.lit(True).alias("by_ein"))
    named = e.drop("ein").withColumn("head", F.substring_index("name", " ", 1))
    by_name = targets.withColumn("head", F.substring_index("name", " ", 1)).withColumnRenamed("name", "tname").join(named, "head")
    by_name = by_name.where((F.col("name") == F.col("tname")) | F.col("name").startswith(F.concat(F.col("tname"), F.lit(" "))))
    both = by_ein.unionByName(by_name.select("target", "rssd", "files", "active", "is_holding", F.lit(False).alias("by_ein")))
    rank = F.struct((~F.col("by_ein")).alias("a"), (~F.col("files")).alias("b"), (~F.col("active")).alias("c"), (~F.col("is_holding")).alias("d"), F.col("rssd").alias("e"))
    return both.groupBy("target").agg(F.min_by(F.struct("rssd", "by_ein"), rank).alias("m")).select("target", "m.rssd", "m.by_ein")
