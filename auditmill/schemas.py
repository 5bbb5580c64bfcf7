"""Declared schemas and column orders of the tables the engine reads and writes."""

from pyspark.sql import types as T


def _fields(*pairs):
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


def declared(schema: T.StructType) -> list[str]:
    """Select list that casts every column to its declared type."""
    return [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]


S, L, I = T.StringType(), T.LongType(), T.IntegerType()

ARTIFACT = _fields(
    ("artifact_id", S), ("artifact_seq", L), ("filename", S), ("language", S), ("content_hash", S),
    ("source", S), ("created_at", T.TimestampType()), ("content", S),
)

# Public finding fields in report order, then the keys that give the total order, then what scans carry along.
FINDING_FIELDS = (
    "finding_id", "artifact_id", "finding_type", "severity", "rule_id", "description", "location",
    "evidence_snippet", "remediation_guidance", "cwe_mapping",
)
FINDING_ORDER = ("phase", "artifact_seq", "artifact_id", "position", "rule_ord", "dup")
FINDING_CARRY = ("artifact_filename", "artifact_source")
FINDING = T.StructType(
    _fields(*[(name, S) for name in FINDING_FIELDS]).fields
    + _fields(
        ("phase", I), ("artifact_seq", L), ("position", L), ("rule_ord", I), ("dup", I), ("line_no", I),
        ("artifact_filename", S), ("artifact_source", S),
    ).fields
)

DEPENDENCY_FIELDS = ("name", "version_spec", "source_file", "status", "risk_notes")
DEPENDENCY = _fields(
    *[(name, S) for name in DEPENDENCY_FIELDS],
    ("artifact_id", S), ("artifact_seq", L), ("artifact_source", S), ("line_no", I), ("entry", S),
    ("suspicious", T.BooleanType()),
)

SCAN_ERROR = _fields(("artifact_id", S), ("stage", S), ("error_class", S), ("message", S))
QUARANTINE = _fields(("path", S), ("stage", S), ("error_class", S), ("message", S))

PHASES = ((1, "regex"), (2, "ast"), (3, "dependency"))
