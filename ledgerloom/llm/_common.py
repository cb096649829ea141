"""What the corpus operators share: staging tables, blocks of documents, components, links."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

_HELD: dict[str, tuple[SparkSession, str]] = {}


#: Rows of a batch that goes to a Python worker, where the session has left Spark's own number: a
#: batch of long texts is held by the JVM and by the worker at once.
BATCH_ROWS, BATCH_SETTING = "3000", "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.conf.get(BATCH_SETTING, "10000") in ("10000", None):
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_dir(spark: SparkSession) -> str:
    """This application's folder below the one place that driver and executors share."""
    app = spark.sparkContext.applicationId
    if app not in _HELD:
        _HELD[app] = (spark, f"{checkpoint_dir(spark)}/ledgerloom-{app}")
    return _HELD[app][1]


@atexit.register
def _sweep() -> None:
    for spark, folder in _HELD.values():
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended before: its cluster clears the folder
            pass


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: lineage ends here, and a lost
    executor costs at most a reread."""
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(parts))


def bounded_texts(docs: DataFrame, ids: list[tuple], extra: str, room: Callable[[tuple], str], chars: dict[str, int]) -> list[tuple]:
    """(text, *id and what came with it) of the ids, one text per id: of rows that repeat an id, the
    one whose text has the least hash. ``ids``: (doc_id, ...) in order of preference, ``extra``: the
    further columns' types; ``room`` names the purse that a row draws on, ``chars`` how many characters
    each holds. A text that does not fit is passed over, so no more than that reaches the driver."""
    if not ids:
        return []
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", whole().alias("_t")).withColumn("_h", F.xxhash64("_t"))
    names = f"doc_id {kind}" + (f", {extra}" if extra else "")
    chosen = F.broadcast(spark.createDataFrame(ids, names))
    found = rows.join(chosen.select("doc_id"), "doc_id").groupBy("doc_id").agg(F.min(F.struct("_h", F.length("_t").alias("n"))).alias("s"))
    sizes = {r["doc_id"]: (r["s"]["_h"], r["s"]["n"]) for r in found.collect()}
    left, fits = dict(chars), []
    for r in ids:
        if r[0] in sizes and sizes[r[0]][1] <= left[room(r)]:
            left[room(r)] -= sizes[r[0]][1]
            fits.append((r[0], sizes[r[0]][0]))
    if not fits:
        return []
    keys = F.broadcast(spark.createDataFrame(fits, f"doc_id {kind}, _h bigint"))
    texts = dict(rows.join(keys, ["doc_id", "_h"]).select("doc_id", "_t").dropDuplicates(["doc_id"]).collect())
    return [(texts[r[0]], *r) for r in ids if r[0] in texts]


def width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the splitmix generator: 64 bits to 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def per_block(
    fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
    weight: str = "text",
    most: int = 4_000_000,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: hand ``fn`` slices whose ``weight`` column holds about ``most`` bytes at
    most (one long row may exceed it), so memory does not depend on the batch size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(weight)), 0))
            block = np.cumsum(size.astype(np.int64)) // most
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            for a, b in zip(starts, np.r_[starts[1:], len(block)], strict=True):
                out = fn(batch.slice(int(a), int(b - a)))
                yield from [out] if isinstance(out, pa.RecordBatch) else out
                del out
                pa.default_memory_pool().release_unused()  # else a reused worker keeps its largest block

    return run


class TimeMajor:
    """Sequences of unequal length laid side by side, the longest first: step t is one slice.

    ``take`` reorders a flat sequence-major array to step-major order; ``put`` undoes it.
    """

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        ranked = lengths[self.order]
        longest = int(ranked[0]) if len(ranked) else 0
        self.active = np.searchsorted(-ranked, -np.arange(1, longest + 1), side="right")
        self.offset = np.r_[0, np.cumsum(self.active)]
        starts = np.r_[0, np.cumsum(lengths)][:-1][self.order]
        step = np.repeat(np.arange(longest), self.active)
        self.index = starts[np.arange(len(step)) - self.offset[step]] + step
        self.lengths, self.steps = lengths, longest

    def spans(self, most: int) -> list[tuple[int, int]]:
        """Steps cut into spans of about ``most`` positions, so that what is held per position and state
        stays bounded however long a sequence is."""
        cuts = [0]
        while cuts[-1] < self.steps:
            far = int(np.searchsorted(self.offset, self.offset[cuts[-1]] + most, side="right")) - 1
            cuts.append(min(self.steps, max(far, cuts[-1] + 1)))
        return list(zip(cuts[:-1], cuts[1:], strict=True))

    def take(self, flat: np.ndarray) -> np.ndarray:
        return flat[self.index]

    def put(self, stepped: np.ndarray) -> np.ndarray:
        out = np.empty_like(stepped)
        out[self.index] = stepped
        return out


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root the least node.

    Alternating large-star and small-star steps; every step is a map-side combined minimum and
    an equi-join, so a hub of any degree is split by skew handling. Nodes without an edge do
    not appear. Each step is written to the shared folder; the steps end when every node has one
    edge, to a node that has none."""
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(rounds):
        ends = now.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(now.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if not ends.agg(F.count_if(F.expr("up > 1 or up = 1 and down = 1"))).first()[0]:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v"), "edges")
        # small star: u and its smaller neighbours all point to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = staged(small.where("u <> v").distinct(), "edges")
    raise RuntimeError("components did not settle")


#: Rows of a block, and bytes of what they carry.
BLOCK, BLOCK_BYTES = 1000, 8_000_000


def linked_in_blocks(
    members: DataFrame,
    carried: DataFrame,
    find: Callable[[np.ndarray, np.ndarray, pa.Table, np.ndarray | None], tuple[np.ndarray, np.ndarray]],
    name: str,
) -> DataFrame:
    """Links (a, b) that join what a group holds of different roots.

    members: g (the group), id, r (its root so far), w (bytes it carries); carried: id and columns
    that ``find`` needs. Groups of one root are left out. A larger group is dealt into blocks of
    about ``BLOCK`` rows and ``BLOCK_BYTES`` bytes, and every two blocks meet once, in one task;
    ``find`` gets ids, roots, the carried columns and, where two blocks meet, the side of each row
    (pairs of one side are another meeting's). It returns links enough that afterwards all rows that
    are alike are connected, so a meeting yields fewer links than it has rows."""
    spark = members.sparkSession
    sizes = members.groupBy("g").agg(F.count("*").alias("n"), F.sum("w").alias("bytes"), F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo <> hi")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1)).cast("int")
    dealt = members.join(sizes.select("g", parts.alias("parts")), "g")
    dealt = dealt.withColumn("s", F.pmod(F.xxhash64("id"), "parts").cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = staged(dealt.select("g", F.least("s", "o").alias("lo"), F.greatest("s", "o").alias("hi"), "s", "id", "r"), f"{name}-dealt")
    extra = [c for c in carried.columns if c != "id"]
    names = ["g", "lo", "hi", "s", "id", "r", *extra]

    def starts_of(held: pa.Table) -> np.ndarray:
        cols = [held.column(c).to_numpy() for c in ("g", "lo", "hi")]
        return np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols], 0)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows < 2 * BLOCK and held.nbytes < 2 * BLOCK_BYTES:
                continue
            starts = starts_of(held)
            yield from meetings(held, starts[:-1], starts[1:])
            held = held.slice(int(starts[-1])).combine_chunks()
        if held is not None:
            starts = starts_of(held)
            yield from meetings(held, starts, np.r_[starts[1:], held.num_rows])

    def meetings(held: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        for x, y in zip(starts.tolist(), ends.tolist(), strict=True):
            part = held.slice(x, y - x)
            ids, roots, s = (part.column(c).to_numpy() for c in ("id", "r", "s"))
            if roots.min() == roots.max():
                continue
            a, b = find(ids, roots, part.select(extra), s if s.min() != s.max() else None)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])

    met = dealt.join(carried, "id").select(names).repartition(width(spark), "g", "lo", "hi").sortWithinPartitions("g", "lo", "hi")
    return staged(met.mapInArrow(run, "a bigint, b bigint"), name)


def rows_to_meet(roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(order, labels in that order, how many rows must look at those behind them): rows of the
    largest root come last, since pairs of one root need no look."""
    _, of, counts = np.unique(roots, return_inverse=True, return_counts=True)
    order = np.argsort(of == counts.argmax(), kind="stable")
    return order, of[order], len(of) - int(counts.max())


def spark_frame(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, schema)


class Words:
    """The words of a block of texts, coded against the block's own vocabulary.

    codes: one per word, texts in order; counts: words of each text; vocab: the distinct words.
    What an operator needs to know of a word it works out once per distinct word and gathers."""

    def __init__(self, texts: pa.Array, split: Callable[[pa.Array], pa.ListArray]):
        lists = split(texts)
        flat = lists.flatten()
        self.counts = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
        coded = flat.dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.codes, self.vocab = np.asarray(coded.indices), coded.dictionary

    def drop_empty(self) -> Words:
        """Without empty words, which splitting leaves at the ends of a text."""
        empty = np.asarray(pa.compute.equal(pa.compute.binary_length(self.vocab), 0))
        if empty.any():
            keep = ~empty[self.codes]
            owner = np.repeat(np.arange(len(self.counts)), self.counts)
            self.counts = np.bincount(owner[keep], minlength=len(self.counts)).astype(np.int64)
            self.codes = self.codes[keep]
        return self


_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[9:14] = 32
_PLAIN[65:91] += 32


def lower_words(texts: pa.Array) -> Words:
    """Words between ASCII white space, A-Z in lower case; bytes beyond ASCII stay as they are."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_PLAIN[data]))
    return Words(plain, lambda x: pa.compute.split_pattern(x, " ")).drop_empty()
