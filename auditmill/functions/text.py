"""Text primitives with Python's line, whitespace and regex semantics, as built-in Column expressions."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The line boundaries of Python's str.splitlines and the characters str.strip removes.
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"
WHITESPACE = (
    "\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

FIELD_SEP = "\u0001"


def constant(value, schema: str) -> Column:
    """A constant of any shape as one expression; Catalyst folds it to a literal."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def strip(col: Column) -> Column:
    """Trim every Unicode whitespace character, not only blanks."""
    return F.btrim(col, F.lit(WHITESPACE))


def split_lines(col: Column) -> Column:
    """Raw line array; a final '' stands for a closing line break (see `drop_final_empty`)."""
    return F.split(col, LINE_BREAK, -1)


def drop_final_empty(parts: Column) -> Column:
    closing = F.when(F.element_at(parts, -1) == "", 1).otherwise(0)
    return F.slice(parts, F.lit(1), F.size(parts) - closing)


def explode_lines(df: DataFrame, keep: Sequence[str], content: str = "content") -> DataFrame:
    """One row per line: `keep` columns, 1-based `line_no`, `line`. Narrow; no shuffle."""
    # Two projections: Catalyst keeps them apart, so the regex split runs once per row.
    parts = df.select(*keep, split_lines(F.col(content)).alias("_parts"))
    return parts.select(*keep, F.posexplode(drop_final_empty(F.col("_parts"))).alias("_pos", "line")).select(
        *keep, (F.col("_pos") + 1).cast("int").alias("line_no"), "line"
    )


_CLASS_ESCAPES = {
    "s": r"\s\x1c-\x1f",
    "w": r"\p{L}\p{N}_",
    "d": r"\p{Nd}",
}
_INLINE_FLAGS = re.compile(r"\(\?([imsxau]+)\)")


def java_pattern(pattern: str, checked: bool = False) -> str:
    """Rewrite a Python `re` pattern so that Java's engine gives Python's Unicode-aware matches.

    Java allows no underscore in group names, so named groups become `g1`, `g2`, ...; comments are dropped. `checked`: the
    pattern is known to be valid.
    """
    if not checked:
        re.compile(pattern)  # a malformed rule fails here, on the driver
    flags = set()
    lead = _INLINE_FLAGS.match(pattern)
    if lead:
        flags, pattern = set(lead.group(1)), pattern[lead.end():]
    unicode_mode = "a" not in flags
    out, i, in_class, groups = [], 0, False, {}
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            nxt = pattern[i + 1]
            body = _CLASS_ESCAPES.get(nxt.lower()) if unicode_mode else None
            if body and nxt.islower():
                out.append(body if in_class else f"[{body}]")
            elif body:
                out.append(f"[^{body}]")
            elif nxt == "Z":
                out.append(r"\z")
            else:
                out.append(ch + nxt)
            i += 2
            continue
        if in_class:
            if ch == "]":
                in_class = False
            elif ch == "[" or (ch == "&" and pattern[i + 1] == "&"):
                ch = "\\" + ch
        elif ch == "[":
            in_class = True
            head = re.match(r"\[\^?\]?", pattern[i:]).group()
            out.append(head.replace("]", r"\]"))
            i += len(head)
            continue
        elif pattern.startswith("(?P<", i):
            end = pattern.index(">", i)
            name = groups.setdefault(pattern[i + 4:end], f"g{len(groups) + 1}")
            out.append(f"(?<{name}>")
            i = end + 1
            continue
        elif pattern.startswith("(?P=", i):
            end = pattern.index(")", i)
            out.append(rf"\k<{groups[pattern[i + 4:end]]}>")
            i = end + 1
            continue
        elif pattern.startswith("(?#", i):
            i = pattern.index(")", i) + 1
            continue
        out.append(ch)
        i += 1
    java_flags = "".join(sorted(flags & set("imsx")))
    if unicode_mode:
        java_flags += "uU" if "i" in flags else "U"
    return (f"(?{java_flags})" if java_flags else "") + "".join(out)


_ACCEPTED: set[str] = set()


def check_patterns(spark: SparkSession, patterns: Sequence[str]) -> None:
    """Let Java's engine compile the patterns (already in Java form) on the driver, so that one it does not take
    raises while a plan is built and not inside a task. The one-row plan runs without a job."""
    row = spark.sql("SELECT '' AS probe")
    for pattern in patterns:
        if pattern in _ACCEPTED:
            continue
        try:
            row.select(F.col("probe").rlike(pattern)).collect()
        except PySparkException as e:
            raise ValueError(f"pattern has no equivalent in Java's engine: {pattern}") from e
        _ACCEPTED.add(pattern)


_CLASS_OR_ESCAPE = re.compile(r"\\[^bBAZ1-9]|\[\^?\]?(?:\\.|[^\]\\])*\]")
_CONTEXT_SENSITIVE = re.compile(r"\\[bBAZ1-9]|\^|\$|\(\?[=!<>(]|\(\?P=|[+*?}]\+")


def context_free(pattern: str) -> bool:
    """True when a match depends on the matched text alone (no anchor, look-around, boundary or possessive).

    Then a line that matches implies that the whole content matches, which makes the content prefilter exact.
    """
    return not _CONTEXT_SENSITIVE.search(_CLASS_OR_ESCAPE.sub("x", pattern))


def any_match(col: Column, patterns: Sequence[str], opens: str | None = None) -> Column:
    """One alternation over all patterns (already in Java form), each with its own inline flags.

    `opens` is the body of a character class that every match begins with; testing it first skips most positions.
    """
    if not patterns:
        return F.lit(False)
    alternation = "|".join(f"(?:{p})" for p in patterns)
    if opens:
        return col.rlike(f"(?=[{opens}])(?:{alternation})")
    return col.rlike(alternation)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 over a row; nulls count as empty text, so the same text results on any SQL engine."""
    return F.sha2(F.concat_ws(FIELD_SEP, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def size_text(n_bytes: Column) -> Column:
    """`12.34 KB` below one MiB, else `1.23 MB`; exact decimals with half-even rounding."""
    n = n_bytes.cast("decimal(17,0)")
    kb = F.bround(n * F.expr("CAST(0.0009765625 AS DECIMAL(10,10))"), 2)
    mb = F.bround(n * F.expr("CAST(0.00000095367431640625 AS DECIMAL(20,20))"), 2)
    return F.when(n_bytes >= 1048576, F.concat(mb.cast("decimal(20,2)").cast("string"), F.lit(" MB"))).otherwise(
        F.concat(kb.cast("decimal(20,2)").cast("string"), F.lit(" KB"))
    )
