"""Syntax-tree scan: parse every Python content once, report sinks and files that do not parse."""

from __future__ import annotations

import ast
import warnings
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auditmill.functions.text import any_match
from auditmill.operators.findings import as_findings, emission_texts
from auditmill.plans.storage import write_once
from auditmill.rules import Ruleset, ruleset
from auditmill.sources.artifacts import code_artifacts

ROWS_PER_BATCH = 4096

_HIT_FIELDS = (
    ("position", "bigint", pa.int64()),
    ("emission", "int", pa.int32()),
    ("rule_ord", "int", pa.int32()),
    ("dup", "int", pa.int32()),
    ("line_no", "int", pa.int32()),
    ("name", "string", pa.string()),
    ("snippet", "string", pa.string()),
    ("error_class", "string", pa.string()),
    ("message", "string", pa.string()),
)
HIT_SCHEMA = ", ".join(f"{name} {kind}" for name, kind, _ in _HIT_FIELDS)
OWNER = ("artifact_id", "artifact_seq", "filename", "source")


def may_hit(content: Column, catalog: Ruleset) -> Column:
    """A necessary condition for any hit of a built-in catalog, checked in the JVM before Python sees a content.

    ASCII code must spell a sink's name out; identifiers with other characters are folded by the parser, so any
    content outside ASCII passes.
    """
    if catalog.tokens is None:
        return content.isNotNull()
    return any_match(content, [r"[^\x00-\x7f]", *catalog.tokens], r"[^\x00-\x7f]" + "".join(t[0] for t in catalog.tokens))


def scan_trees(
    artifacts: DataFrame,
    rules: str | Ruleset = "core",
    *,
    once_per_content: bool = False,
    report_errors: bool = True,
) -> DataFrame:
    """Raw scan rows per artifact: hits, plus one row per file that cannot be parsed when `report_errors`.

    The scan is narrow, without any shuffle. `once_per_content` instead parses each distinct content once, where one of its
    artifacts lies, and joins the hits back by content hash: for inputs made of many copies. Only hashes and ids are
    shuffled to choose those artifacts. Rows are the same either way.
    """
    catalog = ruleset(rules)
    code = artifacts.where(F.col("language") == "python") if catalog.python_only else artifacts
    code = code_artifacts(code)
    parsed = code.where("content IS NOT NULL" if report_errors else may_hit(F.col("content"), catalog))
    worker = tree_worker(catalog, report_errors, 1 if once_per_content else len(OWNER))
    if not once_per_content:
        owner_schema = "artifact_id string, artifact_seq bigint, filename string, source string"
        return parsed.select(*OWNER, "content").mapInArrow(worker, f"{owner_schema}, {HIT_SCHEMA}")
    # Stored, so that its measured size decides the join: few copies to leave out move no content.
    copies = write_once(copies_of_contents(parsed), "copies")
    hits = parsed.join(copies, "artifact_id", "left_anti").select("content_hash", "content").mapInArrow(
        worker, f"content_hash string, {HIT_SCHEMA}"
    ).distinct()  # an artifact that is listed twice has been parsed twice
    # The owners' side names no content: from a stored artifact table it reads ids and hashes only.
    return code.select("content_hash", *OWNER).join(hits, "content_hash").drop("content_hash")


def one_per_content(code: DataFrame) -> DataFrame:
    """(content_hash, artifact_id): of each distinct content the artifact with the smallest id."""
    return code.groupBy("content_hash").agg(F.min("artifact_id").alias("artifact_id"))


def copies_of_contents(code: DataFrame) -> DataFrame:
    """(artifact_id) of every artifact but the one of each content. Contents stay where they are."""
    shared = code.groupBy("content_hash").agg(F.min("artifact_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return code.select("content_hash", "artifact_id").join(shared, "content_hash").where("artifact_id <> first").select("artifact_id")


def tree_findings(raw: DataFrame, rules: str | Ruleset = "core") -> DataFrame:
    """Findings from raw scan rows; texts are attached here from constants, not shipped through Python."""
    catalog = ruleset(rules)
    text = F.get(emission_texts(_emissions(catalog)), F.col("emission"))
    rows = raw.where("error_class IS NULL").withColumn("text", text).selectExpr(
        "artifact_id", "artifact_seq", "filename AS artifact_filename", "source AS artifact_source",
        "line_no", "position", "rule_ord", "dup", "name", "snippet AS evidence_snippet",
        f"concat('{catalog.location_label} ', line_no) AS location", "2 AS phase", "text.*",
    )
    return as_findings(rows.withColumn("description", F.expr("replace(description, '{name}', coalesce(name, ''))")))


def tree_errors(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("error_class").isNotNull()).select(
        "artifact_id", F.lit("ast").alias("stage"), "error_class", "message"
    )


def scan_tree_findings(artifacts: DataFrame, rules: str | Ruleset = "core", *, once_per_content: bool = False) -> DataFrame:
    raw = scan_trees(artifacts, rules, once_per_content=once_per_content, report_errors=False)
    return tree_findings(raw, rules)


def scan_errors(artifacts: DataFrame, rules: str | Ruleset = "core", *, once_per_content: bool = False) -> DataFrame:
    return tree_errors(scan_trees(artifacts, rules, once_per_content=once_per_content))


def _emissions(catalog: Ruleset) -> list:
    """Distinct emissions of the tree rules, in registration order."""
    return list(dict.fromkeys(e for _, rule in catalog.tree_rules for e in rule.emits))


def tree_worker(catalog: Ruleset, report_errors: bool, n_keys: int):
    """Arrow worker: leading key columns and a content column in, keys and hit fields out."""
    emissions = _emissions(catalog)
    ordinal_of = {rule.rule_id: i for i, rule in reversed(catalog.tree_rules)}
    numbered = [(i, rule, [emissions.index(e) for e in rule.emits]) for i, rule in catalog.tree_rules]
    wanted = tuple({kind for _, rule, _ in numbered for kind in rule.node_types})
    as_source = catalog.source_segment

    def hits_of(text: str) -> list[tuple]:
        source = text.encode().splitlines(keepends=True) if as_source else None
        found = []
        for position, node in enumerate(ast.walk(ast.parse(text))):
            if not isinstance(node, wanted):
                continue
            seen, snippet = Counter(), None
            for own_ordinal, rule, codes in numbered:
                outcome = rule.check(node) if isinstance(node, rule.node_types) else None
                for local, name in [(0, None)] if outcome is True else outcome or ():
                    code = codes[local]
                    ordinal = ordinal_of.get(emissions[code].rule_id, own_ordinal)
                    if snippet is None:
                        snippet = _segment(source, node) if as_source else ast.unparse(node)
                    found.append((position, code, ordinal, seen[code], getattr(node, "lineno", None), name, snippet, None, None))
                    seen[code] += 1
        return found

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        warnings.simplefilter("ignore")
        types = [kind for _, _, kind in _HIT_FIELDS]
        for batch in batches:
            keys, contents = [batch.column(i) for i in range(n_keys)], batch.column(n_keys)
            names = batch.schema.names[:n_keys] + [n for n, _, _ in _HIT_FIELDS]
            owner, rows = [], []

            def flush():
                index = pa.array(owner, pa.int64())
                columns = [k.take(index) for k in keys]
                columns += [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                return pa.RecordBatch.from_arrays(columns, names)

            for i, content in enumerate(contents):
                try:
                    found = hits_of(content.as_py())
                except (SyntaxError, ValueError, RecursionError, MemoryError) as e:
                    found = [(None,) * 7 + (type(e).__name__, str(e))] if report_errors else []
                rows += found
                owner += [i] * len(found)
                if len(rows) >= ROWS_PER_BATCH:
                    yield flush()
                    owner, rows = [], []
            if rows:
                yield flush()

    return worker


def _segment(lines: list[bytes], node: ast.AST) -> str:
    """Source text of a node; columns are UTF-8 offsets."""
    part = lines[node.lineno - 1:node.end_lineno]
    part[-1] = part[-1][:node.end_col_offset]
    part[0] = part[0][node.col_offset:]
    return b"".join(part).decode()
