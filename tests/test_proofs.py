"""Membership proofs and gates of several groupings."""

import random

from pyspark.sql import functions as F

from auditmill.operators.gates import LEVELS, gate_plan, gate_plan_rollup
from auditmill.operators.proofs import PREFIXES, artifact_proofs, input_proofs, input_tree, proven_root
from auditmill.operators.dependencies import analyze_dependencies
from auditmill.plans.audit import all_findings
from auditmill.plans.storage import write_once
from tests.samples import FILES


def proven(df, hash_column="content_hash"):
    return df.withColumn("ok", proven_root(F.col(hash_column), F.col("copies"), F.col("steps")) == F.col("root"))


def test_every_proof_leads_to_the_root(spark, make):
    files = [(f"f{n}.py", f"x = {n % 150}", "X") for n in range(200)]  # fifty contents occur twice
    artifacts = make(files)
    proofs = proven(artifact_proofs(artifacts)).collect()
    assert len(proofs) == 200 and all(r.ok for r in proofs) and {len(r.steps) for r in proofs} == {len(PREFIXES)}
    assert sorted(r.copies for r in proofs) == [1] * 100 + [2] * 100
    assert max(s.siblings for r in proofs for s in r.steps) <= 15  # sixteen-fold; the lowest groups hold one hash here


def test_changed_hashes_counts_and_steps_fail(spark, make):
    proofs = artifact_proofs(make([(f"f{n}.py", f"x = {n}", "X") for n in range(60)]))
    changed = proofs.withColumn("other", F.concat(F.substring("content_hash", 1, 63), F.when(F.col("content_hash").endswith("0"), "1").otherwise("0")))
    assert proven(changed, "other").where("ok").count() == 0
    assert proven(proofs.withColumn("copies", F.col("copies") + 1)).where("ok").count() == 0
    swapped = F.transform("steps", lambda s: F.struct(s["after"].alias("before"), s["before"].alias("after"), s["siblings"].alias("siblings")))
    assert proven(proofs.withColumn("steps", swapped)).where("ok AND exists(steps, s -> s.siblings > 0 AND s.before <> s.after)").count() == 0


def test_the_root_depends_on_every_artifact(spark, make):
    files = [(f"f{n}.py", f"x = {n}", "X") for n in range(20)]
    root = lambda chosen: input_tree(make(chosen)).root.first()[0]
    mixed = files[:]
    random.Random(1).shuffle(mixed)
    assert root(mixed) == root(files) and len({root(files), root(files[:-1]), root([*files, files[0]])}) == 3
    assert input_tree(make(files).where("false")).root.count() == 0 and artifact_proofs(make(files).where("false")).count() == 0


def keyed(artifacts):
    """Stored findings, dependencies and artifacts with the columns that the levels group by."""
    dependencies = write_once(analyze_dependencies(artifacts), "dependencies")
    found = write_once(all_findings(artifacts, dependencies=dependencies), "findings")
    name = lambda df, source, file: df.withColumns({"source": F.col(source), "language": F.substring_index(file, ".", -1)})
    return name(found, "artifact_source", "artifact_filename"), name(dependencies, "artifact_source", "source_file"), name(artifacts, "source", "filename")


def test_rollup_equals_one_plan_per_level(spark, make):
    found, dependencies, artifacts = keyed(make([*FILES, ("clean.py", "x = 1", "CLAUDE")]))
    rolled = gate_plan_rollup(found, dependencies, artifacts).collect()
    columns = ["gate_ord", "gate_type", "failure_action", "tools"]
    for level, keys in LEVELS.items():
        expected = gate_plan(found, dependencies, artifacts=artifacts, keys=list(keys))
        own = [r for r in rolled if r.level == level]
        told = lambda rows: sorted(repr([r[c] for c in (*keys, *columns)]) for r in rows)
        assert told(own) == told(expected.collect())
        assert all(r[k] is None for r in own for k in ("source", "language", "artifact_id") if k not in keys)


def test_rollup_is_one_aggregate(spark, make):
    rolled = gate_plan_rollup(*keyed(make(FILES)))
    plan = rolled._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and plan.count("Expand") == 1 and "Join" not in plan


def test_a_null_source_is_a_group_of_its_own(spark, make):
    found, dependencies, artifacts = keyed(make(FILES))
    blank = [df.withColumn("source", F.lit(None).cast("string")) for df in (found, dependencies, artifacts)]
    rolled = gate_plan_rollup(*blank).collect()
    assert sum(r.level == "source" and r.source is None for r in rolled) == 5 and sum(r.level == "total" for r in rolled) == 5


def test_no_step_is_moved(spark, make):
    """Steps are made above all joins, so that what a shuffle moves does not grow by the proofs' kilobytes."""
    artifacts = make([(f"f{n}.py", f"x = {n}", "X") for n in range(40)])
    plan = artifact_proofs(artifacts)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" in plan and "array_join" not in plan[plan.index("Join") :]
    tree = input_tree(artifacts)
    told = lambda df: sorted(map(repr, df.select("content_hash", "copies", "steps").collect()))
    assert told(input_proofs(tree)) == told(artifact_proofs(artifacts))
