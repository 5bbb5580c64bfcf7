"""Risk of arriving artifacts where a newer version replaces an older one.

State per artifact key: the version that counts, and its findings and score. A newer version takes the old one's back
and adds its own, as rows that sum up; older versions and repetitions change nothing. So the sums over all rows are those
of a batch over the latest versions, however the versions were dealt to batches and in whatever order they came. The
state is one small row per key, as large as the inventory of artifacts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from auditmill.functions.scoring import severity_weight
from auditmill.operators.regex_scan import scan_lines
from auditmill.rules import Ruleset

KEY = ("artifact_key", "version")
CHANGE = "artifact_key string, version bigint, artifacts bigint, findings bigint, score bigint"
_STATE = "version bigint, findings bigint, score bigint"


def score_changes(arrivals: DataFrame, rules: str | Ruleset = "core") -> DataFrame:
    """A stream of artifacts with `artifact_key` and `version` to a stream of changes (`CHANGE`): +1 artifact with its findings
    and score, or -1 with those it had. Scanning is stateless; findings reach the state as ids and weights."""
    weights = scan_lines(arrivals, rules, extra=KEY).select(*KEY, "finding_id", severity_weight(F.col("severity")).alias("weight"))
    # A row for the artifact itself, so that a version without findings replaces too.
    marks = arrivals.select(*KEY, F.lit(None).cast("string").alias("finding_id"), F.lit(0).alias("weight"))
    rows = weights.unionByName(marks).where("artifact_key IS NOT NULL AND version IS NOT NULL")
    return rows.groupBy("artifact_key").applyInPandasWithState(_replace, CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout)


def _replace(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    latest, found = None, {}
    for rows in batches:
        top = int(rows["version"].max())
        if latest is None or top > latest:
            latest, found = top, {}
        own = rows[(rows["version"] == latest) & rows["finding_id"].notna()]
        found.update(zip(own["finding_id"], own["weight"]))  # an id counts once, however often its version is repeated
    if state.exists and state.get[0] >= latest:
        return
    changes = []
    if state.exists:
        old, findings, score = state.get
        changes.append((key[0], old, -1, -findings, -score))
    now = (latest, len(found), int(sum(found.values())))
    state.update(now)
    changes.append((key[0], latest, 1, *now[1:]))
    yield pd.DataFrame(changes, columns=[field.split()[0] for field in CHANGE.split(", ")])


def current_scores(changes: DataFrame) -> DataFrame:
    """(artifact_key, version, finding_count, risk_score) of what counts now."""
    totals = changes.groupBy("artifact_key").agg(
        F.max("version").alias("version"), F.sum("artifacts").alias("n"),
        F.sum("findings").cast("bigint").alias("finding_count"), F.sum("score").cast("bigint").alias("risk_score"),
    )
    return totals.where("n = 1").drop("n")


def latest_versions(artifacts: DataFrame) -> DataFrame:
    """The batch counterpart: the artifacts of each key's highest version."""
    top = artifacts.groupBy("artifact_key").agg(F.max("version").alias("version"))
    return artifacts.join(top, list(KEY), "left_semi")
