"""Personal data by fixed patterns and bootstrapped contextual extraction, in DataFrame functions.

Base spans are regular expressions with a check (octets, Luhn, digit counts). Each expression is
written so that a long text costs time in proportion to its length: repeats are possessive, and a
match may only begin where a run of its characters begins or where the last match ended, which
changes no match.

Bootstrapping: base spans are the seeds. Candidates are number groups of 7 to 25 digits, and words of
5 to 64 characters that hold a digit or an @ (without the signs around them), that no base span
overlaps. Contexts (two words before; a word before and one after, whole words within ``REACH``
characters) are patterns, and patterns and the distinct strings met in them form a graph:

* a pattern's reliability is the confidence of its strings, summed, over their number plus one; it
  needs ``LEAST_SEEDS`` distinct confident strings;
* a candidate's confidence is 1 - prod(1 - reliability) over its patterns; seeds have 1.

After ``ROUNDS`` rounds, occurrences of candidates with a confidence of ``LEAST_CONFIDENCE`` are
added as kind ``context``. What the graph holds is strings and contexts, never texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import staged, whole

KINDS = ("email", "ip", "card", "phone", "context")
LEAST_SEEDS, LEAST_CONFIDENCE, ROUNDS, REACH = 3, 0.6, 3, 48

_MARK, _SPARE = "\x01", "\x02"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # 12 to 19 digits that no further one precedes or follows with at most one sign between
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "context": r"(?<![\p{L}\p{N}_])[0-9](?:[\x20./()-]{0,2}+[0-9]){6,24}+(?![\p{L}\p{N}_])|(?<![^\s(\[<\"':=])(?=\S{0,63}[0-9@])[\p{L}\p{N}#@+_][^\s\"'<>]{3,62}(?<=[\p{L}\p{N}])(?=[.,;:!?)\]>\"']{0,4}(?:\s|$))",
}


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def octets(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))


def luhn(text: Column) -> Column:
    """Whether every second digit from the right, doubled, and the others add up to a multiple of 10."""
    digits = F.split(F.reverse(_digits(text)), "")

    def add(acc: Column, d: Column) -> Column:
        value = F.coalesce(d.try_cast("int"), F.lit(0)) * F.when(acc["odd"], 2).otherwise(1)
        return F.struct((acc["sum"] + value - F.when(value > 9, 9).otherwise(0)).alias("sum"), (~acc["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(F.filter(digits, lambda d: d != ""), start, add, lambda acc: acc["sum"] % 10 == 0)


CHECKS = {
    "email": lambda t: F.lit(True),
    "ip": octets,
    "card": luhn,
    "phone": lambda t: F.length(_digits(t)).between(9, 15),
    "context": lambda t: F.lit(True),
}


def _passes(kind: str) -> Callable[[Column], Column]:
    return lambda span: CHECKS[kind](span["text"])


def _placed(parts: Column, kind: int) -> Column:
    """Texts and matches by turns -> array of structs: start, kind, end, text, before, after."""
    none = "array<struct<start:int,end:int>>"
    begin = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.array().cast(none).alias("out"))

    def walk(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        here = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), (~acc["hit"]).alias("hit"), F.when(acc["hit"], F.concat(acc["out"], here)).otherwise(acc["out"]).alias("out"))

    places = F.aggregate(parts, begin, walk, lambda acc: acc["out"])
    return F.transform(
        places,
        lambda p, i: F.struct(
            p["start"].alias("start"),
            F.lit(kind).alias("kind"),
            p["end"].alias("end"),
            F.get(parts, 2 * i + 1).alias("text"),
            F.right(F.get(parts, 2 * i), F.lit(REACH)).alias("before"),
            F.left(F.get(parts, 2 * i + 2), F.lit(REACH)).alias("after"),
        ),
    )


def base_spans(docs: DataFrame, key: Column) -> DataFrame:
    """uid, key (whatever the caller wants to keep), base (spans of the four kinds) and maybe
    (candidates), written out: what follows never reads the expressions' texts again."""
    span = "array<struct<start:int,kind:int,end:int,text:string,before:string,after:string>>"
    df = docs.select(key.alias("key"), F.translate(whole(), _MARK, _SPARE).alias("t"))
    needs = {"email": "@", "phone": "+"}
    marked = {
        k: F.when(F.col("t").contains(needs[k]), F.regexp_replace("t", p, f"{_MARK}$0{_MARK}")) if k in needs else F.regexp_replace("t", p, f"{_MARK}$0{_MARK}")
        for k, p in PATTERNS.items()
    }
    df = df.select("key", *(v.alias(f"m_{k}") for k, v in marked.items()))
    df = df.select("key", *(F.when(F.col(f"m_{k}").contains(_MARK), F.split(f"m_{k}", _MARK, -1)).alias(f"p_{k}") for k in KINDS))
    df = df.select("key", *(F.coalesce(F.when(F.col(f"p_{k}").isNotNull(), _placed(F.col(f"p_{k}"), i)), F.array().cast(span)).alias(k) for i, k in enumerate(KINDS)))
    kept = [F.filter(k, _passes(k)) for k in KINDS]
    df = df.select("key", F.array_sort(F.concat(*kept[:4])).alias("base"), kept[4].alias("maybe"))
    clear = F.filter("maybe", lambda m: ~F.exists("base", lambda b: (b["start"] < m["end"]) & (b["end"] > m["start"])))
    return staged(df.select(F.monotonically_increasing_id().alias("uid"), "key", "base", clear.alias("maybe")), "spans")


def _contexts(span: Column) -> Column:
    # a blank in front of a window that is not full: the text begins there, so its first word is whole
    edge = lambda side: F.when(F.length(side) < REACH, F.lit(" ")).otherwise(F.lit(""))
    before = F.concat(edge(span["before"]), F.lower(span["before"]))
    after = F.concat(F.lower(span["after"]), edge(span["after"]))
    two = F.regexp_extract(before, r"\s(\S+\s+\S+)\s*$", 1)
    left, right = F.regexp_extract(before, r"\s(\S+)\s*$", 1), F.regexp_extract(after, r"^\s*(\S+)\s", 1)
    both = F.when((left != "") & (right != ""), F.concat(F.lit("LR:"), left, F.lit(" _ "), right))
    return F.filter(F.array(F.when(two != "", F.concat(F.lit("L:"), F.regexp_replace(two, r"\s+", " "))), both), lambda p: p.isNotNull())


def discover(spans: DataFrame) -> DataFrame:
    """text and confidence of the candidates, after some rounds over the pattern-instance graph."""
    each = spans.select(F.explode(F.concat("base", "maybe")).alias("s"))
    edges = staged(
        each.select(F.explode(_contexts(F.col("s"))).alias("pattern"), F.col("s.text").alias("text"), (F.col("s.kind") < 4).alias("seed")).groupBy("pattern", "text").agg(F.max("seed").alias("seed")),
        "graph",
    )
    belief = edges.groupBy("text").agg(F.max(F.col("seed").cast("double")).alias("confidence"))
    for _ in range(ROUNDS):
        rated = edges.join(belief, "text").groupBy("pattern")
        sure = F.count_if(F.col("confidence") >= LEAST_CONFIDENCE)
        patterns = rated.agg((F.sum("confidence") / (F.count("*") + 1)).alias("reliability"), sure.alias("sure")).where(F.col("sure") >= LEAST_SEEDS)
        doubt = F.sum(F.log(1 - F.coalesce("reliability", F.lit(0.0))))
        now = edges.join(patterns, "pattern", "left").groupBy("text").agg(F.max("seed").alias("seed"), doubt.alias("doubt"))
        belief = staged(now.select("text", F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("doubt")).alias("confidence")), "beliefs")
    return belief


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _found(spans: DataFrame) -> DataFrame:
    """key, base and found (base and added), arrays of start, kind, end in order, of each row. Rows
    without a candidate pass through; the others meet what is added to them by their uid."""
    slim = "array<struct<start:int,kind:int,end:int>>"
    short = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))).cast(slim)
    open_ = spans.where(F.size("maybe") > 0)
    sure = discover(spans).where(F.col("confidence") >= LEAST_CONFIDENCE).select("text")
    maybe = open_.select("uid", F.explode("maybe").alias("s")).withColumn("text", F.col("s.text"))
    added = maybe.join(sure, "text", "left_semi").groupBy("uid").agg(F.collect_list(F.struct("s.start", "s.kind", "s.end")).alias("added"))
    # a merge join at every size: how many texts have a candidate is not bounded
    both = open_.join(added.hint("merge"), "uid", "left").select("key", short.alias("base"), F.coalesce(F.col("added").cast(slim), F.array().cast(slim)).alias("added"))
    met = both.select("key", "base", F.array_sort(F.concat("base", "added")).alias("found"))
    return met.unionByName(spans.where(F.size("maybe") == 0).select("key", short.alias("base"), short.alias("found")))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (text) and found (array of start,
    kind, end), a row per row of ``docs``. Offsets are code points, ends are exclusive. Null text is
    empty; a text without a span has an empty string (and its digest)."""
    all_ = _found(base_spans(docs, F.col("doc_id"))).withColumnRenamed("key", "doc_id")
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return all_.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"), "found")


def _masked(text: Column, found: Column) -> Column:
    """The text with each span, or group of overlapping spans, replaced by the first one's kind."""
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def walk(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        more = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, more).otherwise(acc["out"]).alias("out"))

    return F.aggregate(found, begin, walk, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def redact(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs``, whatever their names, with personal data in text replaced by
    <KIND>, and n_chars, where there is such a column, that of the new text. Rows are written once
    beside their spans; only those with a candidate meet anything by a join. Null texts stay null."""
    row = F.struct(*(F.col(f"`{c}`").alias(c) for c in docs.columns))
    met = _found(base_spans(docs, row)).select("key", "found")
    text = F.when(F.size("found") == 0, F.col("key")["text"]).otherwise(_masked(F.col("key")["text"], F.col("found")))
    met = met.withColumn("text", text)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("found") == 0, F.col("key")["n_chars"]).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return met.select(*(new.get(c, F.col("key")[c]).alias(c) for c in docs.columns))
