"""The findings table: common shape, union, order, lookup join, filters, facets, detail and top-k."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditmill.functions.scoring import DOC_FINDING_TYPES, DOC_SEVERITIES, FINDING_TYPES, SEVERITIES, severity_rank
from auditmill.functions.text import FIELD_SEP, constant
from auditmill.operators.positions import page, with_positions
from auditmill.schemas import FINDING, FINDING_ORDER, PHASES, declared

#: Up to here a position is found by a top-n selection.
TOP_ROWS = 1000

DEPENDENCY_TYPES = ("INSECURE_DEPENDENCY", "HALLUCINATED_PACKAGE")


def finding_id() -> Column:
    key = F.expr("array(artifact_id, string(phase), string(position), string(rule_ord), string(dup))")
    return F.sha2(F.concat_ws(FIELD_SEP, key), 256)


def emission_texts(emissions: Iterable) -> Column:
    """Finding texts as one constant array; rows carry only an index into it until the last projection."""
    fields = ("finding_type", "severity", "rule_id", "description", "remediation_guidance", "cwe_mapping")
    schema = f"array<struct<{', '.join(f'{f}: string' for f in fields)}>>"
    return constant([{f: getattr(e, f) for f in fields} for e in emissions], schema)


def as_findings(rows: DataFrame, extra: Iterable[str] = ()) -> DataFrame:
    """Cast to the declared findings schema, adding the deterministic id; `extra` columns stay behind it."""
    full = rows.withColumn("finding_id", finding_id())
    return full.selectExpr(*declared(FINDING), *extra)


def split_by_domain(findings: DataFrame, *, doc: bool = False) -> tuple[DataFrame, DataFrame]:
    """(findings whose severity and type are in the domain, quarantine rows for the others). `doc` takes the domain of
    the documentation variant."""
    severities, types = (DOC_SEVERITIES, DOC_FINDING_TYPES) if doc else (SEVERITIES, FINDING_TYPES)
    valid = F.col("severity").isin(*severities) & F.col("finding_type").isin(*types)
    bad = findings.where(~F.coalesce(valid, F.lit(False))).select(
        F.col("finding_id").alias("path"), F.lit("findings").alias("stage"), F.lit("OutOfDomain").alias("error_class"),
        F.concat_ws("/", "severity", "finding_type").alias("message"),
    )
    return findings.where(valid), bad


def union_findings(*parts: DataFrame) -> DataFrame:
    """UNION ALL of scanner outputs; duplicates stay."""
    return reduce(DataFrame.unionByName, parts)


def ordered_columns() -> list[Column]:
    return [F.col(c).asc() for c in FINDING_ORDER]


def with_filename(findings: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Look the filename up by artifact id; `N/A` where the inventory lacks the artifact.

    For stored findings. Scanner output already carries `artifact_filename` and needs no join.
    """
    names = artifacts.groupBy("artifact_id").agg(
        F.min_by("filename", F.struct("artifact_seq", "filename")).alias("artifact_filename")
    )
    return (
        findings.drop("artifact_filename")
        .join(names, "artifact_id", "left")
        .withColumn("artifact_filename", F.coalesce("artifact_filename", F.lit("N/A")))
    )


def filter_findings(findings: DataFrame, severities=None, finding_types=None) -> DataFrame:
    """Keep selected severities and types; None selects all."""
    out = findings
    if severities is not None:
        out = out.where(F.col("severity").isin(*severities))
    if finding_types is not None:
        out = out.where(F.col("finding_type").isin(*finding_types))
    return out


def findings_view(findings: DataFrame, *, wide: bool = False) -> DataFrame:
    """Display projection; the wide form adds evidence and remediation."""
    extra = ("evidence_snippet", "remediation_guidance") if wide else ()
    return findings.select(
        "severity", "finding_type", "rule_id", "artifact_filename", "location", "description", *extra
    )


def finding_positions(findings: DataFrame, *, first: int = 1) -> DataFrame:
    """Every finding with its place in report order, counted from `first`: what a user pages through.

    Findings are read twice, so hand in stored ones; `positions.page` reads a page of the (stored) result.
    """
    numbered = with_positions(findings, FINDING_ORDER, name="report_position")
    return numbered.withColumn("report_position", F.col("report_position") + first)


def finding_detail(findings: DataFrame, position: int) -> DataFrame:
    """The n-th finding (0-based) in report order. Up to `TOP_ROWS` by a top-n selection, which sorts nothing else; a
    deeper one by its stored position, so that no list of `position` rows ends on the driver."""
    if position < TOP_ROWS:
        found = findings.orderBy(*ordered_columns()).offset(position).limit(1)
    else:
        found = page(finding_positions(findings, first=0), position, 1, name="report_position")
    label = F.format_string("%s - %s (%s)", "severity", "rule_id", "artifact_filename")
    return found.select(
        label.alias("label"), "severity", "rule_id", "artifact_filename", "location", "description",
        "evidence_snippet", "remediation_guidance",
    )


def dependency_related(findings: DataFrame) -> DataFrame:
    return findings.where(F.col("finding_type").isin(*DEPENDENCY_TYPES))


def facets(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Distinct values of several columns in one pass: (facet, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.facet", "p.value").distinct()


def drop_repeated(findings: DataFrame) -> DataFrame:
    """Keep one of the findings that one node yields through several registrations of a check."""
    return findings.where(F.col("dup") == 0)


def findings_by_phase(findings: DataFrame) -> DataFrame:
    """What each pass added, zero where it added nothing: one partial aggregate, then three rows."""
    counts = findings.agg(*[F.count_if(F.col("phase") == n).alias(name) for n, name in PHASES])
    rows = F.array(*[
        F.struct(F.lit(n).alias("phase"), F.lit(name).alias("phase_name"), F.col(name).alias("new_findings"))
        for n, name in PHASES
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def top_findings(findings: DataFrame, k: int = 5, rank_by: str = "severity_text") -> DataFrame:
    """Top k with a rank column. `severity_text` compares severities as text (MEDIUM before CRITICAL), the report's
    order; `severity_rank` puts CRITICAL first."""
    if rank_by == "severity_rank":
        first = severity_rank(F.col("severity")).desc()
    else:
        first = F.col("severity").desc()
    keys = [first, F.col("finding_type").desc(), *ordered_columns()]
    best = findings.orderBy(*keys).limit(k)
    # The window sees at most k rows.
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*keys)))
