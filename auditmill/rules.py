"""Rule catalogs (three variants) and the pluggable `Rule` type."""

from __future__ import annotations

import ast
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

from auditmill.functions.scoring import finding_type_of
from auditmill.functions.text import java_pattern


class Emission(NamedTuple):
    """The finding text one syntax-tree hit stands for; `{name}` in the description is the called name."""

    rule_id: str
    finding_type: str
    severity: str
    description: str
    remediation_guidance: str
    cwe_mapping: str | None


class Hint(NamedTuple):
    """A cheap condition that every match of a line rule meets: a pattern found wherever the rule's pattern is, and
    the plain characters that a match of the hint begins with."""

    opens: str
    pattern: str


@dataclass(frozen=True)
class Rule:
    """A line rule (`pattern`) or a syntax-tree rule (`check`).

    `check(node)` returns a falsy value for no hit, True for the rule's own finding, or an iterable of
    `(index into emits, name)`. `node_types` limits the node classes it is asked about.
    `hint` speeds a line rule up and never changes its result; the line scan tests hints before patterns.
    """

    rule_id: str
    method: str
    severity: str
    description: str
    remediation_guidance: str
    cwe_mapping: str | None = None
    pattern: str | None = None
    check: Callable[[ast.AST], object] | None = None
    emits: tuple[Emission, ...] = ()
    node_types: tuple[type, ...] = (ast.AST,)
    finding_type: str | None = None
    hint: Hint | None = None

    def __post_init__(self):
        if (self.pattern is None) == (self.check is None):
            raise ValueError(f"{self.rule_id}: give either a pattern or a check")
        if self.pattern is not None:
            java_pattern(self.pattern)
        kind = self.finding_type or (None if self.emits else finding_type_of(self.rule_id))
        if not self.emits:
            own = Emission(
                self.rule_id, kind, self.severity, self.description, self.remediation_guidance, self.cwe_mapping
            )
            object.__setattr__(self, "emits", (own,))
        object.__setattr__(self, "finding_type", kind or self.emits[0].finding_type)


@dataclass(frozen=True)
class Ruleset:
    """A rule catalog with the few presentation choices in which the variants differ."""

    name: str
    rules: tuple[Rule, ...]
    location_label: str = "line"
    source_segment: bool = False  # evidence of tree hits: source text instead of normalised code
    python_only: bool = False  # scan only artifacts whose language is python by extension
    tokens: tuple[str, ...] | None = field(default=None)  # any tree hit needs one of these identifiers

    @property
    def line_rules(self) -> list[tuple[int, Rule]]:
        return [(i, r) for i, r in enumerate(self.rules) if r.pattern is not None]

    @property
    def tree_rules(self) -> list[tuple[int, Rule]]:
        return [(i, r) for i, r in enumerate(self.rules) if r.check is not None]

    def with_rules(self, *extra: Rule) -> Ruleset:
        return Ruleset(f"{self.name}+custom", self.rules + extra, self.location_label, self.source_segment,
                       self.python_only, None)


# --- Syntax-tree checks ------------------------------------------------------------------------------------------

EXECUTION, SHELL = 0, 1


def _runs_shell(node: ast.AST) -> bool:
    match node:
        case ast.Call(func=ast.Attribute(value=ast.Name(id="subprocess"), attr="run"), keywords=options):
            return any(isinstance(o.value, ast.Constant) and o.arg == "shell" and o.value.value is True for o in options)
    return False


def dynamic_execution(node: ast.AST) -> Iterable[tuple[int, str]]:
    """eval / exec as a called name, a called attribute or a bare attribute; literal subprocess.run(shell=True)."""
    match node:
        case (
            ast.Call(func=ast.Name(id="eval" | "exec" as name))
            | ast.Call(func=ast.Attribute(attr="eval" | "exec" as name))
            | ast.Attribute(attr="eval" | "exec" as name)
        ):
            return [(EXECUTION, name)]
    return [(SHELL, "run")] if _runs_shell(node) else []


def unsafe_loads(node: ast.AST) -> bool:
    match node:
        case ast.Call(func=ast.Attribute(value=ast.Name(id="pickle"), attr="loads")):
            return True
    return False


# --- Fixed values: rule ids, patterns and finding texts ------------------------------------------------------------

_EVAL_EXEC = Emission(
    "AST_DANGEROUS_EVAL_EXEC", "DANGEROUS_EXEC", "HIGH",
    "Use of {name}() detected, which can lead to arbitrary code execution.",
    "Avoid eval/exec for untrusted input. Consider safer alternatives like ast.literal_eval.",
    "CWE-94",
)
_SHELL_TRUE = Emission(
    "AST_SUBPROCESS_SHELL_TRUE", "DANGEROUS_EXEC", "HIGH",
    "subprocess.run() with shell=True detected, which is dangerous with untrusted input.",
    "Avoid shell=True. Pass commands as a list of arguments instead.",
    "CWE-78",
)
_PICKLE_LOADS = Emission(
    "AST_PICKLE_LOADS", "UNSAFE_DESERIALIZATION", "CRITICAL",
    "Use of pickle.loads() detected, which is unsafe for untrusted input due to arbitrary code execution risk.",
    "Avoid pickle for untrusted data. Use safer serialization formats like JSON or Protocol Buffers.",
    "CWE-502",
)
_CALL_NODES = (ast.Call, ast.Attribute)
_TREE_TOKENS = ("eval", "exec", "subprocess", "pickle")

_AWS_KEY = Rule(
    "SECRET_AWS_KEY", "REGEX", "CRITICAL",
    "Hard-coded AWS access key/secret detected.",
    "Use IAM roles or environment variables for AWS credentials.",
    "CWE-798",
    r"(AKIA|A3T|AGPA|AIDA|AROA|AIPA|ANPA|ANVA|ASIA)[A-Z0-9]{16}",
    hint=Hint("A", r"A[3A-Z][A-Z]{1,2}[A-Z0-9]{16}"),
)
_GENERIC_PASSWORD = Rule(
    "SECRET_GENERIC_PASSWORD", "REGEX", "HIGH",
    "Generic hard-coded password pattern detected.",
    "Avoid hard-coding passwords. Use secure secret management.",
    "CWE-798",
    r"""(password|passwd|pwd)\s*=\s*["'][a-zA-Z0-9!@#$%^&*()_+]{8,}["']""",
    hint=Hint("=", r"""=\s*["'][a-zA-Z0-9!@#$%^&*()_+]{8,}["']"""),
)
_SQL_TEXT = (
    "Potential SQL injection due to f-string formatting in query.",
    "Use parameterized queries instead of f-strings or string concatenation for SQL.",
    "CWE-89",
)
_MD5 = Rule(
    "UNSAFE_CRYPTO_MD5", "REGEX", "MEDIUM",
    "Use of MD5 for security-sensitive operations, which is cryptographically weak.",
    "Use SHA256 or stronger hashing algorithms for security purposes.",
    "CWE-327",
    r"hashlib\.md5",
    hint=Hint("h", r"hashlib\.md5"),
)
# Both execution rules are registered with one check, so each of its hits is reported once per registration.
_TREE_RULES = (
    Rule(
        "AST_DANGEROUS_EVAL_EXEC", "AST", "HIGH",
        "Dangerous use of eval() or exec() detected.",
        "Review use of dynamic code execution. Prefer safer alternatives.",
        "CWE-94", check=dynamic_execution, emits=(_EVAL_EXEC, _SHELL_TRUE), node_types=_CALL_NODES,
    ),
    Rule(
        "AST_SUBPROCESS_SHELL_TRUE", "AST", "HIGH",
        "subprocess.run with shell=True is dangerous.",
        "Refactor to pass commands as a list and avoid shell=True.",
        "CWE-78", check=dynamic_execution, emits=(_EVAL_EXEC, _SHELL_TRUE), node_types=_CALL_NODES,
    ),
    Rule(
        "AST_PICKLE_LOADS", "AST", "CRITICAL",
        "Unsafe deserialization using pickle.loads detected.",
        "Avoid pickle.loads with untrusted input. Use JSON or similar for data exchange.",
        "CWE-502", check=unsafe_loads, emits=(_PICKLE_LOADS,), node_types=(ast.Call,),
    ),
)

CORE = Ruleset(
    "core",
    (
        Rule(
            "SECRET_API_KEY", "REGEX", "CRITICAL",
            "Hard-coded API key or secret detected.",
            "Use environment variables or a secure secret management system.",
            "CWE-798",
            r"""(?i)(api_key|secret|token|password|auth_token|aws_secret|api_secret)\s*=\s*["'][a-zA-Z0-9\-_/+]{20,}["']""",
            hint=Hint("=", r"""(?i)=\s*["'][a-zA-Z0-9\-_/+]{20,}["']"""),
        ),
        _AWS_KEY,
        _GENERIC_PASSWORD,
        Rule(
            "INJECTION_SQL_FSTRING", "REGEX", "HIGH", *_SQL_TEXT,
            r"""f"\s*(SELECT|INSERT|UPDATE|DELETE|select|insert|update|delete).*\{.*\}""",
            hint=Hint("f", r"""f"\s*(SELECT|INSERT|UPDATE|DELETE|select|insert|update|delete)"""),
        ),
        _MD5,
        *_TREE_RULES,
    ),
    tokens=_TREE_TOKENS,
)

NOTEBOOK = Ruleset(
    "notebook",
    (
        Rule(
            "SECRET_API_KEY", "REGEX", "CRITICAL",
            "Hard-coded API key detected.",
            "Use environment variables or a secure secret management system.",
            "CWE-798",
            r"""(api_key|secret|token|password|auth_token)\s*=\s*["'](sk-|AKIA|eyJ)[a-zA-Z0-9\-_]{16,}["']""",
            hint=Hint("=", r"""=\s*["'](sk-|AKIA|eyJ)[a-zA-Z0-9\-_]{16,}["']"""),
        ),
        _AWS_KEY,
        _GENERIC_PASSWORD,
        Rule(
            "INJECTION_SQL_FSTRING", "REGEX", "HIGH", *_SQL_TEXT,
            r"""(cursor\.execute\s*\(f"(SELECT|INSERT|UPDATE|DELETE).*')""",
            hint=Hint("c", r"cursor\.execute"),
        ),
        _MD5,
        *_TREE_RULES,
    ),
    tokens=_TREE_TOKENS,
)

DOC = Ruleset(
    "doc",
    (
        Rule(
            "S101", "REGEX", "CRITICAL",
            "Hardcoded secret found.", "Use environment variables or a secrets manager.", None,
            r"""(api_key|secret|token|password)\s*=\s*['"]\w{16,128}['"]""",
            hint=Hint("=", r"""=\s*['"]\w{16,128}['"]"""),
            finding_type="HARDCODED_SECRET",
        ),
        Rule(
            "S102", "REGEX", "HIGH",
            "Use of eval() detected.", "Avoid eval() due to arbitrary code execution risks.", None,
            r"eval\(",
            hint=Hint("e", r"eval\("),
            finding_type="DANGEROUS_EXECUTION",
        ),
        Rule(
            "S103", "REGEX", "MEDIUM",
            "Use of MD5 detected.", "Use strong cryptographic hashes like SHA256.", None,
            r"hashlib\.md5\(",
            hint=Hint("h", r"hashlib\.md5\("),
            finding_type="WEAK_CRYPTO",
        ),
        Rule(
            "A201", "AST", "HIGH",
            "subprocess.run with shell=True detected.", "Avoid shell=True with untrusted input.",
            check=_runs_shell, node_types=(ast.Call,), finding_type="DANGEROUS_EXECUTION",
        ),
        Rule(
            "A202", "AST", "CRITICAL",
            "pickle.loads detected, insecure deserialization risk.", "Avoid pickle for untrusted data.",
            check=unsafe_loads, node_types=(ast.Call,), finding_type="INSECURE_DESERIALIZATION",
        ),
    ),
    location_label="Line",
    source_segment=True,
    python_only=True,
    tokens=("subprocess", "pickle"),
)

RULESETS = {"core": CORE, "notebook": NOTEBOOK, "doc": DOC}


def ruleset(name_or_set: str | Ruleset) -> Ruleset:
    return RULESETS[name_or_set] if isinstance(name_or_set, str) else name_or_set
