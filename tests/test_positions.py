"""Row numbers over whole tables against a plain sort."""

import random

from pyspark.sql import functions as F

from auditmill.operators import findings as fd
from auditmill.operators.positions import page, with_positions
from auditmill.plans.audit import all_findings
from auditmill.plans.storage import write_once

SAMPLE = "/root/testdata/sf0.001"


def none_first(value):
    return (value is not None, value)


def test_positions_of_all_rows(spark):
    rows = [(random.Random(n).randrange(50), n) for n in range(3000)] + [(None, 3000)]
    df = spark.createDataFrame(rows, "k int, n int").repartition(7)
    got = {r["n"]: r["position"] for r in with_positions(df, ["k", "n"]).collect()}
    expected = sorted(rows, key=lambda r: (none_first(r[0]), r[1]))
    assert got == {n: i for i, (_, n) in enumerate(expected)}


def test_positions_in_groups_with_a_hot_and_a_null_group(spark):
    rows = [("hot" if n % 3 else f"g{n % 20}" if n % 4 else None, n) for n in range(4000)]
    df = spark.createDataFrame(rows, "k string, n int").repartition(9, "n")
    got = {r["n"]: (r["at"], r["rows_of_k"]) for r in with_positions(df, ["n"], ["k"], name="at", total="rows_of_k").collect()}
    expected = {}
    for k in {k for k, _ in rows}:
        own = sorted(n for key, n in rows if key == k)
        expected |= {n: (i, len(own)) for i, n in enumerate(own)}
    assert got == expected


def test_equal_rows_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a", 5)] * 4 + [(0, "b", 6)], "place int, Part string, n int")
    numbered = with_positions(df, ["place"])
    assert numbered.columns == ["place", "Part", "n", "position"]
    rows = sorted(map(tuple, numbered.collect()), key=lambda r: r[3])
    assert rows == [(0, "b", 6, 0), *[(1, "a", 5, i) for i in range(1, 5)]]
    assert sorted(map(tuple, numbered.collect())) == sorted(rows)  # stored, so a second read gives the same numbers
    empty = with_positions(df.where("n < 0"), ["place"], ["Part"], total="t")
    assert empty.columns == ["place", "Part", "n", "position", "t"] and empty.count() == 0


def corpus_findings(spark):
    from auditmill.sources.corpora import audit_corpus

    return write_once(all_findings(audit_corpus(spark, SAMPLE)), "findings")


def test_pages_and_deep_details(spark, monkeypatch):
    findings = corpus_findings(spark)
    listed = findings.orderBy(*fd.ordered_columns()).select("finding_id").collect()
    positions = write_once(fd.finding_positions(findings), "positions")
    assert [r["finding_id"] for r in positions.orderBy("report_position").collect()] == [r[0] for r in listed]
    third = page(positions, 21, 10, name="report_position").orderBy("report_position").collect()
    assert [r["finding_id"] for r in third] == [r[0] for r in listed[20:30]]
    shallow = [tuple(fd.finding_detail(findings, n).first()) for n in (0, 40, len(listed) - 1)]
    monkeypatch.setattr(fd, "TOP_ROWS", 0)
    deep = [tuple(fd.finding_detail(findings, n).first()) for n in (0, 40, len(listed) - 1)]
    assert deep == shallow and fd.finding_detail(findings, len(listed)).count() == 0
    plan = fd.finding_detail(findings, 40)._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_no_window_sees_the_rows_themselves(spark):
    """The only window runs over counts per partition."""
    df = write_once(spark.range(1000).withColumn("v", F.col("id") % 7), "numbers")
    plan = with_positions(df, ["v", "id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") == 1 and plan.index("Window ") < plan.index("Aggregate ")
