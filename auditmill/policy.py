"""Package policies: allow and deny lists, naming heuristics, manifest dialects."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dialect:
    """How one manifest kind is read: file suffix, anchored entry pattern, and a marker the whole file must hold."""

    suffix: str
    pattern: str
    version_group: int = 2
    marker: str | None = None


@dataclass(frozen=True)
class Policy:
    name: str
    allowlist: tuple[str, ...]
    denylist: tuple[str, ...]
    suffixes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    dialects: tuple[Dialect, ...] = ()
    allow_first: bool = False  # which list wins for a name on both
    fold_case: bool = False  # compare list entries lowercased
    keep_name_case: bool = False
    null_version: bool = False  # an absent version is null instead of ''
    suspicious_pattern: str | None = None  # replaces the suffix and prefix tests
    suspicious_status: str = "UNKNOWN"


# --- Fixed values: lists, suffixes, prefixes and entry patterns ---------------------------------------------------

_ALLOW = ("requests", "numpy", "pandas", "Flask", "fastapi", "sqlalchemy")
_DENY = ("shodan", "pickle", "pyyaml", "MD5", "Crypto.Cipher.ARC4")
_DIALECTS = (
    Dialect("requirements.txt", r"([a-zA-Z0-9_\-\.]+)(?:\s*[<>=!~]+(.+))?"),
    Dialect("pyproject.toml", r'"([a-zA-Z0-9_\-\.]+)(?:[<>=!~]+(.+))?"', marker="dependencies"),
    # One opening brace: a prefix of the doubled form, so real package.json files qualify as well.
    Dialect("package.json", r'"([a-zA-Z0-9_\-\.\/]+)"\s*:\s*"(.+)"', marker='"dependencies": {'),
)

CORE = Policy(
    "core", _ALLOW, _DENY,
    suffixes=("-pro", "-enterprise", "-ai", "-securelib", "-advanced", "-extras", "-utils", "-enhanced", "-premium",
              "-plus", "-secure"),
    prefixes=("flask", "django", "numpy", "pandas", "requests", "tensorflow", "pytorch", "scikit", "boto", "aws"),
    dialects=_DIALECTS,
)

NOTEBOOK = Policy(
    "notebook", _ALLOW, _DENY,
    suffixes=("-pro", "-enterprise", "-ai", "-securelib"),
    dialects=_DIALECTS,
)

DOC = Policy(
    "doc",
    ("requests", "pandas", "numpy", "streamlit"),
    ("pyyaml", "unsafe-package-xyz"),
    dialects=(Dialect("requirements.txt", r"([\w.-]+)(==|>=|<=|>|<|~=)?([\w.]+)?", version_group=3),),
    allow_first=True,
    fold_case=True,
    keep_name_case=True,
    null_version=True,
    suspicious_pattern=r"(-pro|-ai|-enterprise|secure-pro|gpt)",
    suspicious_status="HALLUCINATED",
)

POLICIES = {"core": CORE, "notebook": NOTEBOOK, "doc": DOC}


def policy(name_or_policy: str | Policy) -> Policy:
    return POLICIES[name_or_policy] if isinstance(name_or_policy, str) else name_or_policy
