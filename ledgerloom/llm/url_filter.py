"""URL verdicts: listed rules first, then segmented words and multinomial naive Bayes.

1. Rules are (host, path) pairs: one fits its host and all subdomains if the path starts with the
   rule's; the longest (host, then path) decides.
2. Other urls are judged by naive Bayes. A unigram model over the words that stand alone in hosts
   and paths splits names that run words together, by Viterbi over all cuts. Multinomial naive
   Bayes over the segmented tokens of host and path learns from the urls that rules decide.

A word has at most ``LONGEST`` letters, so a longer name is always cut. Distinct names are segmented
once each; urls are counted by a combined aggregation. Words, tokens
and odds are tables over all names: a name meets the words it may hold, and its tokens their odds,
by equi-joins. Only the odds of the most frequent ``VOCABULARY`` names reach the driver and all
workers; urls with any other name get theirs by a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import staged

VOCABULARY = 200_000
LONGEST = 24
# The rules, as host, path and verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, by its host's length and then its path's."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]), len(r[1]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def names(col: Column) -> Column:
    """Maximal runs of letters, in lower case; digits and signs part them."""
    return F.filter(F.split(F.lower(col), r"[^\p{L}]+"), lambda x: x != "")


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    unknown: float = -20.0

    def segment(self, name: str) -> list[str]:
        """The most probable split; a letter outside every word costs as much as an unseen word.
        Ties go to the longer last word."""
        best, cut = [0.0], [0]
        for end in range(1, len(name) + 1):
            top, at = -math.inf, end - 1
            for start in range(max(0, end - LONGEST), end):
                word = name[start:end]
                gain = self.words.get(word)
                if gain is None:
                    gain = self.unknown * (end - start)
                if best[start] + gain > top:
                    top, at = best[start] + gain, start
            best.append(top)
            cut.append(at)
        out, end = [], len(name)
        while end:
            out.append(name[cut[end] : end])
            end = cut[end]
        return out[::-1]


@dataclass
class Learnt:
    """names: f, w, o (log odds of block against allow of a field's name), n."""

    names: DataFrame
    prior: float


def _parts_of(words: DataFrame, least: int, most: Column) -> DataFrame:
    """w, s: the distinct parts of each name of ``least`` to ``most`` letters."""
    parts = F.expr(f"flatten(transform(sequence(1, length(w)), i -> transform(filter(sequence({least}, {LONGEST}), k -> i + k - 1 <= length(w)), k -> substring(w, i, k))))")
    return words.select("w", F.explode(F.array_distinct(parts)).alias("s")).where(F.length("s") <= most)


def train(judged: DataFrame) -> Learnt:
    """judged: host, path, verdict (null where no rule fits). Words come from all rows, naive Bayes
    from the decided ones; without both verdicts the odds are even, which means allow."""
    urls = judged.groupBy("host", "path", "verdict").agg(F.count("*").alias("n"))
    each = urls.select("n", "verdict", F.explode(F.concat(
        F.transform(names(F.col("host")), lambda x: F.struct(F.lit("h").alias("f"), x.alias("w"))),
        F.transform(names(F.col("path")), lambda x: F.struct(F.lit("p").alias("f"), x.alias("w"))),
    )).alias("t"))
    counted = staged(each.groupBy("t.f", "t.w", "verdict").agg(F.sum("n").alias("n")), "names")
    total = counted.agg(F.sum("n")).first()[0] or 1
    freq = counted.groupBy("w").agg(F.sum("n").alias("n"))
    # a name counts as a word by its share of the names, damped by its length, so that a frequent
    # compound does not stand against the words it is made of
    known = staged(freq.where(F.length("w").between(2, LONGEST)).select("w", F.log(F.col("n") / F.lit(total)).alias("lp")), "words")
    unknown = math.log(1 / (total + 1)) - 2
    words = known.join(_compounds(known), "w", "left_anti")

    @F.pandas_udf("array<string>")
    def segment(w, found):
        import pandas as pd

        return pd.Series([Model({} if f is None else {x["s"]: x["lp"] for x in f}, unknown).segment(x) for x, f in zip(w, found, strict=True)], dtype="object")

    found = _parts_of(freq, 2, F.lit(LONGEST)).join(words.withColumnRenamed("w", "s"), "s")
    found = found.groupBy("w").agg(F.collect_list(F.struct("s", "lp")).alias("found"))
    cut = staged(freq.select("w").join(found, "w", "left").select("w", segment("w", "found").alias("parts")), "segments")

    decided = counted.where("verdict in ('block', 'allow')").join(cut, "w").select("f", F.explode("parts").alias("t"), "verdict", "n")
    count = lambda v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0))
    tokens = staged(decided.groupBy("f", "t").agg(count("block").alias("b"), count("allow").alias("a")), "tokens")
    vocab, block, allow = tokens.agg(F.count("*"), F.sum("b"), F.sum("a")).first()
    every = counted.groupBy("f", "w").agg(F.sum("n").alias("n"))
    if not block or not allow:
        return Learnt(every.select("f", "w", F.lit(0.0).alias("o"), "n"), 0.0)
    size = vocab + 1
    odds = lambda b, a: F.log((b + 1) / F.lit(block + size)) - F.log((a + 1) / F.lit(allow + size))
    known_odds = tokens.select("f", "t", odds(F.col("b"), F.col("a")).alias("o"))
    spread = every.join(cut, "w").select("f", "w", "n", F.posexplode("parts").alias("at", "t"))
    met = spread.join(known_odds, ["f", "t"], "left").withColumn("o", F.coalesce("o", odds(F.lit(0), F.lit(0))))
    summed = met.groupBy("f", "w").agg(F.any_value("n").alias("n"), F.array_sort(F.collect_list(F.struct("at", "o"))).alias("os"))
    named = summed.select("f", "w", F.aggregate("os", F.lit(0.0), lambda acc, x: acc + x.o).alias("o"), "n")
    n = dict(judged.where("verdict is not null").groupBy("verdict").count().collect())
    return Learnt(staged(named, "odds"), math.log(n["block"] / n["allow"]))


def _compounds(known: DataFrame) -> DataFrame:
    """w: names that two or more other words of three letters and over make up exactly."""

    @F.pandas_udf("boolean")
    def made(w, found):
        import pandas as pd

        def one(x: str, known: set[str]) -> bool:
            reach = [True] + [False] * len(x)
            for end in range(3, len(x) + 1):
                reach[end] = any(reach[s] and x[s:end] in known for s in range(end - 2) if (s, end) != (0, len(x)))
            return reach[-1]

        return pd.Series([one(x, set(f)) for x, f in zip(w, found, strict=True)], dtype="bool")

    long = known.where(F.length("w") > 2).select("w")
    parts = _parts_of(long, 3, F.length("w") - 3).join(long.withColumnRenamed("w", "s"), "s")
    return staged(parts.groupBy("w").agg(F.collect_list("s").alias("found")).where(made("w", "found")).select("w"), "compounds")


def judge(pages: DataFrame, url: str = "url", key: str = "page_id", rules: tuple = RULES) -> DataFrame:
    """key, host, path, rule (null where none fits), verdict, block_odds (null where a rule decides).
    Null urls and those without :// have an empty host and path; no rule fits them and the prior
    decides. Null keys stay, repeated rows repeat, an empty table gives no rows; odds of zero allow.
    Other columns of ``pages``, whatever their names, are not looked at."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    parts = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = parts.select("*", rule.alias("rule"), verdict.alias("verdict"))
    learnt = train(judged.select("host", "path", "verdict"))
    ranked = learnt.names.orderBy(F.desc("n"), "w", "f").limit(VOCABULARY + 1).collect()
    prior, head, more = learnt.prior, {(r["f"], r["w"]): r["o"] for r in ranked[:VOCABULARY]}, len(ranked) > VOCABULARY

    @F.pandas_udf("double")
    def odds(hosts, paths):
        import pandas as pd

        # null where a name is not in the head
        def one(h, p):
            if h is None:  # a rule decides
                return None
            known = [head.get(("h", x)) for x in h] + [head.get(("p", x)) for x in p]
            return None if None in known else prior + sum(known)

        return pd.Series([one(h, p) for h, p in zip(hosts, paths, strict=True)], dtype="float64")

    open_ = lambda c: F.when(F.col("verdict").isNull(), names(F.col(c)))
    out = judged.withColumn("block_odds", odds(open_("host"), open_("path")))
    if more:
        out = staged(out, "scored")
        late_one = F.col("block_odds").isNull() & F.col("verdict").isNull()
        rest = out.where(late_one).select("host", "path").distinct()
        pairs = F.concat(
            F.transform(names(F.col("host")), lambda x, i: F.struct(F.lit("h").alias("f"), x.alias("w"), i.alias("at"))),
            F.transform(names(F.col("path")), lambda x, i: F.struct(F.lit("p").alias("f"), x.alias("w"), i.alias("at"))),
        )
        met = rest.select("host", "path", F.explode(pairs).alias("t")).select("host", "path", "t.*").join(learnt.names.select("f", "w", "o"), ["f", "w"])
        met = met.groupBy("host", "path").agg(F.array_sort(F.collect_list(F.struct("f", "at", "o"))).alias("os"))
        late = met.select("host", "path", F.aggregate("os", F.lit(prior), lambda acc, x: acc + x.o).alias("late"))
        late = out.where(late_one).drop("block_odds").join(late, ["host", "path"])
        out = out.where(~late_one).unionByName(late.withColumnRenamed("late", "block_odds"))
    return out.select(F.col("key").alias(key), "host", "path", "rule", F.coalesce("verdict", F.when(F.col("block_odds") > 0, "block").otherwise("allow")).alias("verdict"), "block_odds")
