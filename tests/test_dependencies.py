"""Manifest dialects, classification precedence, variants and dependency queries."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from auditmill import policy
from auditmill.operators.dependencies import (
    analyze_dependencies,
    classify,
    dependencies_view,
    dependency_findings,
    dependency_risk_summary,
    hallucinated_packages,
    parse_manifests,
)


def parsed(df):
    return [(r.name, r.version_spec) for r in df.orderBy("artifact_seq", "line_no").collect()]


def test_requirements_edges(make):
    text = "\n# note\n-r base.txt\nuvicorn[standard]==0.1\npkg\n  Django >= 4.2 # x \n\t\n!odd\na~=1,<2\n==1\nb===2\x0cc==3"
    assert parsed(parse_manifests(make({"x/requirements.txt": text}))) == [
        ("-r", ""), ("uvicorn", ""), ("pkg", ""), ("django", " 4.2 # x"), ("a", "1,<2"), ("b", "2"), ("c", "3")]


def test_pyproject_edges(make):
    body = '"SQLAlchemy >= 1.4"\n  "Flask>=2",\n"bare"\n"a==1", "b==2"\nname = "x"\n'
    files = {"a/pyproject.toml": "dependencies = [\n" + body, "b/pyproject.toml": body}
    assert parsed(parse_manifests(make(files))) == [("flask", "2"), ("bare", ""), ("a", '1", "b==2')]


def test_package_json_edges(make):
    body = '  "@scope/x": "1",\n  "left-pad" : "^1.3.0", "b": "2"\n  "n": 3\n  "e": ""\n'
    files = {
        "a/package.json": '{\n  "name": "app",\n  "dependencies": {\n' + body,
        "b/package.json": '"dependencies": {{\n' + body,
        "c/package.json": '{"devDependencies": {\n' + body,
        "other.json": '"dependencies": {\n' + body,
    }
    hit = ("left-pad", '^1.3.0", "b": "2')
    assert parsed(parse_manifests(make(files))) == [("name", "app"), hit, hit]


def test_precedence_and_naming(make):
    names = ["requests", "Flask", "pyyaml", "MD5", "pickle", "requests-pro", "scikit-learn", "boto3", "flask-x", "x-utils", "prox"]
    rows = {r.name: (r.status, r.suspicious) for r in analyze_dependencies(make({"requirements.txt": "\n".join(names)})).collect()}
    assert rows == {
        "requests": ("ALLOW", False), "flask": ("UNKNOWN", False), "pyyaml": ("DENY", False), "md5": ("UNKNOWN", False),
        "pickle": ("DENY", False), "requests-pro": ("UNKNOWN", True), "scikit-learn": ("UNKNOWN", True),
        "boto3": ("UNKNOWN", False), "flask-x": ("UNKNOWN", True), "x-utils": ("UNKNOWN", True), "prox": ("UNKNOWN", False)}
    notebook = analyze_dependencies(make({"requirements.txt": "\n".join(names)}), "notebook")
    assert {r.name for r in notebook.where("suspicious").collect()} == {"requests-pro"}


def test_policy_table_replaces_lists(spark, make):
    table = spark.createDataFrame(
        [("left-pad", "DENY"), ("left-pad", "ALLOW"), ("internal-pro", "ALLOW"), ("noise", "OTHER")], "name string, status string")
    entries = parse_manifests(make({"requirements.txt": "left-pad\ninternal-pro\nrequests\nx-pro"}))
    rows = {r.name: (r.status, r.suspicious) for r in classify(entries, policy_table=table).collect()}
    assert rows == {"left-pad": ("DENY", False), "internal-pro": ("ALLOW", False), "requests": ("UNKNOWN", False), "x-pro": ("UNKNOWN", True)}


def test_doc_variant(make):
    files = {"requirements.txt": "Requests==2\nPyYAML>=5.1 # x\nchatGPT-tool\nFlask-Pro==1.0\nplain", "pyproject.toml": 'dependencies = [\n"a==1"'}
    deps = analyze_dependencies(make(files, variant="doc"), "doc")
    rows = {r.name: (r.version_spec, r.status) for r in deps.collect()}
    assert rows == {"Requests": ("2", "ALLOW"), "PyYAML": ("5.1", "DENY"), "chatGPT-tool": (None, "HALLUCINATED"),
                    "Flask-Pro": ("1.0", "HALLUCINATED"), "plain": (None, "UNKNOWN")}
    found = dependency_findings(deps, "doc").orderBy("line_no").collect()
    assert [(r.rule_id, r.severity, r.evidence_snippet) for r in found] == [("DEP_H01", "HIGH", "chatGPT-tool"), ("DEP_H01", "HIGH", "Flask-Pro")]


def test_view_and_summary(make):
    deps = analyze_dependencies(make({"requirements.txt": "pyyaml\nx-pro==1\nx-pro==2\nplain\nnumpy"}))
    found = dependency_findings(deps)
    rows = sorted((r.name, r.hallucination_risk) for r in dependencies_view(deps, found, ["UNKNOWN", "DENY"]).collect())
    assert rows == [("plain", "No"), ("pyyaml", "No"), ("x-pro", "Yes"), ("x-pro", "Yes")]
    assert dependencies_view(deps, found, only_hallucinated=True).columns == ["name", "version", "status", "source_file", "hallucination_risk"]
    assert dependencies_view(deps, found, only_hallucinated=True).count() == 2
    assert [r[0] for r in hallucinated_packages(found).collect()] == ["x-pro"]
    assert tuple(dependency_risk_summary(deps, found, ["DENY"]).first()) == (1, 0, 1, False)
    clean = analyze_dependencies(make({"requirements.txt": "numpy"}))
    assert tuple(dependency_risk_summary(clean, dependency_findings(clean)).first()) == (0, 0, 0, True)


def test_real_sample_four(make):
    text = "pyyaml==5.3.1\nrequests==2.25.0\nflask-secure-pro==1.0.0\ndjango-utils-advanced==2.3.4\nnumpy-extras==1.18.0\n"
    deps = analyze_dependencies(make({"requirements.txt": text}))
    assert [(r.severity, r.finding_type) for r in dependency_findings(deps).orderBy("line_no").collect()] == [
        ("HIGH", "INSECURE_DEPENDENCY")] + [("MEDIUM", "HALLUCINATED_PACKAGE")] * 3


PIECES = st.lists(st.sampled_from(
    ["a", "Flask", "numpy", "x-pro", "-", ".", "_", "==", ">=", "~", "!=", " ", "\t", '"', ":", ",", "#", "1.0", "^2", "[x]", "/", "é", "{",
     "}", "'", "\u00a0", "\x1f"]), max_size=9).map("".join)


def brute(name, text, chosen):
    for n, line in enumerate(text.splitlines(), start=1):
        line = line.strip()
        for dialect in chosen.dialects:
            if line and line[0] != "#" and name.endswith(dialect.suffix) and (dialect.marker or "") in text:
                match = re.match(dialect.pattern, line)
                if match and match.group(1):
                    version = match.group(dialect.version_group)
                    package = match.group(1) if chosen.keep_name_case else match.group(1).lower()
                    yield (name, n, package, version if version or chosen.null_version else "", line)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(PIECES, max_size=15), min_size=3, max_size=30), st.sampled_from(["core", "doc"]))
def test_parsing_equals_brute_force(make, files, variant):
    heads = ("", "dependencies = [\n", '"dependencies": {\n')
    kinds = ("requirements.txt", "pyproject.toml", "package.json")
    files = [(f"{n}/{kinds[n % 3]}", heads[n % 3] + "\n".join(lines), "UNKNOWN") for n, lines in enumerate(files)]
    expected = [row for name, text, _ in files for row in brute(name, text, policy.policy(variant))]
    got = parse_manifests(make(files), variant).select("source_file", "line_no", "name", "version_spec", "entry").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
