"""Rules kept as a table against the same rules as constants and against brute force."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from auditmill.operators.regex_scan import scan_lines
from auditmill.operators.rule_table import RULE_TABLE, index_rules, required_grams, rule_table, scan_lines_by_table, split_rules
from auditmill.plans.storage import write_once
from auditmill.rules import RULESETS
from tests.samples import FILES
from tests.test_scans import SNIPPETS

TEXT = ("finding_id", "artifact_id", "rule_id", "finding_type", "severity", "description", "location", "evidence_snippet",
        "remediation_guidance", "cwe_mapping", "line_no", "rule_ord", "dup", "position")


def rows_of(df):
    return sorted(map(repr, df.select(*TEXT).collect()))


def rules_from(spark, patterns):
    rows = [(n, f"R_{n}", "SECRET", "LOW", f"rule {n}", "r", None, p) for n, p in patterns]
    return spark.createDataFrame(rows, RULE_TABLE)


def fold(line):
    return line.translate(str.maketrans("ſKİı", "skii")).lower()


@pytest.mark.parametrize("name", list(RULESETS))
def test_catalogs_as_tables_find_the_same(spark, make, name):
    texts = "\n".join([*SNIPPETS, "toKen = '" + "a" * 20 + "'", "ſecret = '" + "a" * 20 + "'", "TOKEN\u00a0= '" + "b" * 20 + "'"])
    files = [*FILES, ("more.py", texts, "AGENT"), ("empty.py", "", "AGENT"), ("blank.py", "\n\n", "AGENT")]
    artifacts = make(files)
    catalog = RULESETS[name]
    expected = scan_lines(artifacts.where("language = 'python'"), catalog)
    found = scan_lines_by_table(artifacts, rule_table(spark, catalog))
    if name == "doc":  # another label of places, and languages by extension
        columns = [c for c in TEXT if c != "location"]
        assert {tuple(r) for r in expected.select(*columns).collect()} <= {tuple(r) for r in found.select(*columns).collect()}
    else:
        assert rows_of(found) == rows_of(expected)


def test_ten_thousand_rules_without_a_nested_loop(spark, make):
    """Rules of many shapes, some without any literal, equal to brute force; the plan meets them by equality."""
    pick = random.Random(4)
    word = lambda: "".join(pick.choice("abcdefgh_0123") for _ in range(pick.randrange(4, 9)))
    shapes = (
        lambda a, b: rf"{a}\s*=\s*{b}", lambda a, b: rf"(?i)\b({a}|{b})\b", lambda a, b: rf"^{a}.*{b}$", lambda a, b: rf"(?:{a})+[xyz]?{b}?",
        lambda a, b: rf"({a}|[0-9]+){b}", lambda a, b: rf"(?P<first>{a})\.{b}",
    )
    patterns = [(n, shapes[n % len(shapes)](word(), word())) for n in range(10_000)]
    patterns += [(20_000, r"\d{7}"), (20_001, "^$"), (20_002, r"[xy]+z")]
    used = [re.sub(r"\\[sb.]\*?|\(\?P<first>|[()^$.*+?:\[\]]|\(\?i\)", " ", p).split() for _, p in pick.sample(patterns, 150)]
    lines = [" ".join(parts) for parts in used] + ["", "1234567", "xyz", "nothing to see"]
    lines += [p[1:].replace(".*", " and ").rstrip("$") for _, p in patterns[2:200:6]]
    lines += [p.replace(r"\s*", " ") for _, p in patterns[0:200:6]] + [p[9:].replace(r")\.", ".") for _, p in patterns[5:200:6]]
    artifacts = make([("a.py", "\n".join(lines[::2]), "AGENT"), ("b.py", "\n".join(lines[1::2]), "AGENT")])
    rules = write_once(rules_from(spark, patterns), "rules")
    found = scan_lines_by_table(artifacts, rules)
    compiled = [(n, re.compile(p)) for n, p in patterns]
    expected = sorted(
        (name, i, n) for name, part in (("a.py", lines[::2]), ("b.py", lines[1::2]))
        for i, line in enumerate("\n".join(part).splitlines(), 1) for n, p in compiled if p.search(line)
    )
    assert sorted(map(tuple, found.select("artifact_filename", "line_no", "rule_ord").collect())) == expected and len(expected) > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Exchange hashpartitioning(gram" not in plan  # the index is sent to the lines


def test_the_same_when_the_index_is_too_large_to_send(spark, make):
    artifacts, rules = make(FILES), rule_table(spark)
    expected = rows_of(scan_lines(artifacts))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert rows_of(scan_lines_by_table(artifacts, rules)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ATOMS = st.sampled_from(["a", "b", "K", "s", "é", ".", "[ab]", "[^a]", r"\d", r"\w", "(ab|c)", "(?:abc|sk)", "(?i:ks)", "^", "$", r"\b", "(?=a)", "abc", "ssk"])
PIECES = st.tuples(ATOMS, st.sampled_from(["", "", "", "?", "*", "+", "{2}", "{1,3}"])).map(
    lambda t: t[0] + ("" if t[0] in ("^", "$", r"\b", "(?=a)") else t[1])
)


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=6), st.text("abcksKSſKé01 ", max_size=14), st.booleans())
def test_every_match_holds_a_required_gram(pieces, line, fold_case):
    pattern = ("(?i)" if fold_case else "") + "".join(pieces)
    grams = required_grams(pattern)
    if grams is not None and re.search(pattern, line):
        assert any(g in fold(line) for g in grams)


def test_rules_that_are_no_rules(spark, make):
    rules = rules_from(spark, [(1, "good_rule"), (2, "("), (3, None), (4, "eval"), (5, "")])
    rules = rules.withColumn("severity", rules.severity).replace("LOW", "HIGH", "severity")
    usable, rejected = split_rules(rules)
    assert sorted(r.rule_ord for r in usable.collect()) == [1, 4, 5]
    assert sorted(r.rule_ord for r in rejected.collect()) == [2, 3]
    found = scan_lines_by_table(make({"a.py": "eval(good_rule)\nx"}), rules)
    assert sorted(map(tuple, found.select("rule_ord", "line_no").collect())) == [(1, 1), (4, 1), (5, 1), (5, 2)]
    assert scan_lines_by_table(make({"a.py": "x"}), rules.where("false")).count() == 0
    assert index_rules(rules.where("false")).count() == 0


def test_too_many_rules_without_literals(spark, make):
    with pytest.raises(ValueError, match="literal"):
        scan_lines_by_table(make({"a.py": "x"}), rules_from(spark, [(n, rf"\d{{{n + 1}}}") for n in range(201)]))


def test_rules_that_differ_in_a_number_only_share_no_gram(spark, make):
    """Else every line of that shape would meet all of them."""
    patterns = [(n, [rf'hashlib\.md5\(b"{n}"\)', rf"^x{n}\s*=\s*{n}$", rf'(?:sha1\(b"{n}"\)|md5\(b"{n}"\))'][n % 3]) for n in range(4_000_000, 4_000_600)]
    grams = [r.gram for r in index_rules(rules_from(spark, patterns)).collect()]
    assert len(set(grams)) == len(grams) == 800
    lines = ['h = hashlib.md5(b"4000002")', "x4000003 = 4000003", "x4000003 = 4000004", 'sha1(b"4000001") + md5(b"4000001")', 'md5(b"4000004") md5(b"4000004")', "x4000006=4000006"]
    found = scan_lines_by_table(make({"a.py": "\n".join(lines)}), rules_from(spark, patterns))
    expected = sorted((i, n) for i, line in enumerate(lines, 1) for n, p in patterns if re.search(p, line))
    assert sorted(map(tuple, found.select("line_no", "rule_ord").collect())) == expected and len(expected) == 5
