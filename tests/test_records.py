"""Records from lines in any order and cut (P9, P11)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweave.operators import multiline
from logweave.operators.multiline import CONT, END, SKIP, START, _packed, assemble_records
from logweave.operators.solr import solr_log
from logweave.session import release


def expected(rows):
    """Records of (file, line, state, value, map, text) rows by the rules, one line after the other."""
    out = []
    for f in sorted({r[0] for r in rows}):
        open_ = None

        def close():
            nonlocal open_
            if open_ and (open_["line_i"] or open_["v"] is not None or open_["m"] or open_["t"] is not None):
                out.append((f, open_["line_i"], open_["first"], open_["last"], open_["n"], open_["v"], tuple(sorted((open_["m"] or {}).items())), open_["t"]))  # noqa: B023
            open_ = None

        for _, line, state, v, m, t in sorted(r for r in rows if r[0] == f):
            if state not in (START, CONT, END):
                continue
            if state == START:
                close()
            if open_ is None:
                open_ = {"line_i": line if state == START else None, "first": line, "n": 0, "v": None, "m": None, "t": None}
            open_["last"], open_["n"] = line, open_["n"] + 1
            if v is not None:
                open_["v"] = v
            if m:
                open_["m"] = {**(open_["m"] or {}), **m}
            if t is not None:
                open_["t"] = (open_["t"] or "") + t
            if state == END:
                close()
        close()
    return sorted(out, key=str)


def random_rows(rng, files=4, lines=120):
    rows = []
    for f in range(files):
        odds = rng.dirichlet([1, 3, 1, 1])
        for i in range(1, int(rng.integers(2, lines))):
            if rng.random() < 0.1:
                continue  # a blank line, dropped before
            state = rng.choice([START, CONT, END, SKIP], p=odds)
            value = int(rng.integers(100)) if rng.random() < 0.4 else None
            entries = {str(rng.choice(list("abc"))): str(rng.integers(9))} if rng.random() < 0.4 else None
            rows.append((f"f{f}", i, str(state) if rng.random() < 0.95 else None, value, entries, f"<{i}é>" if rng.random() < 0.6 else None))
    return rows


@pytest.mark.parametrize("seed", range(5))
def test_any_order_and_cut(spark, seed):
    rng = np.random.default_rng(seed)
    rows = random_rows(rng)
    schema = "file string, line_num bigint, state string, v bigint, m map<string,string>, t string"
    df = spark.createDataFrame(rows, schema)
    for lines, chunk in ((df.coalesce(1), 7), (df.repartition(5), 1 << 20), (df.repartitionByRange(3, "file", "line_num").sortWithinPartitions("file", "line_num"), 1), (df.sort(F.desc("line_num")), 50)):
        got = assemble_records(lines, fields=["v"], map_col="m", text_col="t", chunk_lines=chunk).collect()
        assert sorted(((r.file, r.line_i, r.first_line, r.last_line, r.n_lines, r.v, tuple(sorted((r.m or {}).items())), r.t) for r in got), key=str) == expected(rows)
        assert all(r.orphan == (r.line_i is None) for r in got)
    assert release(spark) >= 4


def test_only_ends_of_runs_are_shuffled(spark):
    lines = spark.range(0, 200000, 1, 4).select(F.lit("f").alias("file"), (F.col("id") + 1).alias("line_num"),
                                                F.when(F.col("id") % 10 == 0, START).otherwise(CONT).alias("state"), F.concat(F.lit(" "), F.col("id").cast("string")).alias("t"))
    packed = _packed(lines, "state", [], None, "t", 1 << 20)
    assert packed.filter("__whole").count() > 19980 and packed.filter("not __whole").count() <= 2 * 4
    got = assemble_records(lines, text_col="t")
    assert got.count() == 20000 and got.filter("n_lines <> 10 or line_i <> first_line").count() == 0
    one = assemble_records(lines.withColumn("state", F.lit(CONT)), text_col="t").collect()
    assert len(one) == 1 and one[0].t == "".join(f" {i}" for i in range(200000))


def test_search_log_without_a_start(spark, lines_of):
    text = "\n".join(f"no  start {i}" for i in range(1, 1001))
    parts = solr_log(lines_of({"f": text}), "%{SOLR_651_LOG4J}", pieces=True, chunk_lines=64).orderBy("part_no").collect()
    assert len(parts) == 16 and {r.first_line for r in parts} == {1}
    assert "".join(r.text for r in parts) == "".join(f" no start {i}" for i in range(1, 1001))


def test_rendered_requests_lie_in_order_in_bounded_tasks(spark, tmp_path, monkeypatch):
    from logweave.plans import render as R
    from logweave.plans.catalog import solr_requests

    n = 3000
    orders = spark.range(n).select(((F.col("id") * 7) % n).alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
                                   F.lit(1.0).alias("o_totalprice"), F.expr("timestamp'2020-01-01 00:00:00'").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(R, "TASK_ROWS", 100)
    held = []
    monkeypatch.setattr(multiline, "keep", lambda df, real=multiline.keep: held.append(real(df)) or held[-1])
    got = solr_requests(spark, str(tmp_path))
    assert got.count() == n and got.agg(F.sum("line_i"), F.countDistinct("file", "line_i")).first() == (3 * 500500, n)
    sizes = [r["n"] for r in held[0].groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) >= 25 and max(sizes) < 300  # four tasks of 750 rows before
    assert held[0].filter("__whole").count() > 0.9 * n  # neighbours meet in the task, only ends of runs move
