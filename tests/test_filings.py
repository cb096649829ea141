"""Queries on documents, over small tables made for what the shipped ones do not show."""

from itertools import accumulate

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.operators import graph
from ledgerloom.plans import filings
from ledgerloom.sources import documents


def test_charters_are_summed_exactly(spark, tmp_path):
    """2,500 amounts of 333.20 are 833 thousand; added up one by one as doubles they fall below."""
    n = 2500
    assert list(accumulate([333.2] * n))[-1] < 833000
    sold = {"l_suppkey": 1, "l_returnflag": "A", "l_linestatus": "F", "l_shipdate": pd.Timestamp("1997-02-03"), "l_extendedprice": 333.2, "l_partkey": 1, "l_orderkey": range(n), "l_linenumber": 1}
    pd.DataFrame(sold).astype({"l_shipdate": "datetime64[us]"}).to_parquet(tmp_path / "lineitem.parquet")
    got = filings.call_report_zip(spark, str(tmp_path)).collect()
    assert sorted((r["prefix"], r["item"], r["value"]) for r in got) == [("RCON", "1403", 833.0), ("RCON", "1407", 833.0), ("RCON", "2170", 833.0)]


def test_closure_reads_edges_and_roots_once(spark):
    """A checkpoint may run what it keeps twice, but no round runs it again."""
    edges_read, roots_read = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def counted(total):
        def same(x):
            total.add(1)
            return x

        return F.udf(same, "bigint")

    edges = spark.range(1, 9).select(F.lit(1).alias("g"), counted(edges_read)(F.col("id")).alias("parent"), (F.col("id") + 1).alias("child"))
    roots = spark.range(1, 2).select(F.lit(1).alias("g"), counted(roots_read)(F.col("id")).alias("root"))
    assert graph.closure(roots, edges, ["g"]).count() == 9
    assert edges_read.value <= 2 * 8 and roots_read.value <= 2


def test_small_documents_leave_in_blocks(spark):
    """Rows of many small documents share a block, a failed one among them."""

    class Found:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    def parse(path, content):
        return [(int(content), {"a": path})]

    n = documents.BLOCK + 5
    batch = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(n)], "content": [b"x" if i == 7 else b"%d" % i for i in range(n)]})
    out = list(documents.parsed(Found(), parse, "v bigint, m map<string,string>")(iter([batch])))
    assert [b.num_rows for b in out] == [documents.BLOCK, 5]
    rows = [r for b in out for r in b.to_pylist()]
    assert rows[8] == {"v": 8, "m": [("a", "8")], "path": "8", "error": None} and rows[7]["v"] is None and rows[7]["error"].startswith("ValueError")
