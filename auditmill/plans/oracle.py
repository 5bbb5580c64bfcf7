"""Equivalent DuckDB SQL for the registered queries, over the same benchmark tables.

Findings of the line rules come from RE2 over independently rebuilt files; findings of the tree rules follow from the
line templates the corpus is made of, so no parser is involved.
"""

from __future__ import annotations

from auditmill.operators import dependencies as dep
from auditmill.operators import summary
from auditmill.policy import CORE as CORE_POLICY
from auditmill.policy import NOTEBOOK as NOTEBOOK_POLICY
from auditmill.rules import CORE, DOC, NOTEBOOK, Ruleset
from auditmill.sources.corpora import NESTED_FILES

ORACLE: dict[str, str] = {}


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(v if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


# --- Corpora --------------------------------------------------------------------------------------------------------

SPACE = r"[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def stripped(col: str) -> str:
    return f"regexp_replace(regexp_replace({col}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def lines_of(col: str) -> str:
    """List of lines; a final empty element (closing line break, empty text) is no line."""
    parts = f"string_split_regex({col}, '{BREAK}')"
    return f"CASE WHEN {parts}[-1] = '' THEN {parts}[1:len({parts}) - 1] ELSE {parts} END"


ARTIFACT_ID = "sha256(concat_ws(chr(1), filename, source, sha256(content), CAST(artifact_seq AS VARCHAR)))"

DOCUMENTS = f"""
docs AS (
  SELECT doc_id AS artifact_seq, 'documents/' || doc_id || '.md' AS filename, source, text AS content FROM documents),
doc_artifacts AS (
  SELECT *, 'python' AS language, sha256(content) AS content_hash, {ARTIFACT_ID} AS artifact_id FROM docs)"""

CODE = f"""
code_lines AS (
  SELECT user_id, event_id, ts, event_id // 131072 AS block, event_id % 24 AS r,
    CASE event_id % 24
      WHEN 0 THEN 'x' || event_id || ' = ' || event_id
      WHEN 1 THEN 'api_key = "' || md5(CAST(event_id AS VARCHAR)) || '"'
      WHEN 2 THEN 'ACCESS = "AKIA' || upper(left(md5(CAST(event_id AS VARCHAR)), 16)) || '"'
      WHEN 3 THEN 'password = "p@' || left(md5(CAST(event_id AS VARCHAR)), 10) || '"'
      WHEN 4 THEN 'query = f"SELECT * FROM t WHERE id = {{x}}"'
      WHEN 5 THEN 'h = hashlib.md5(b"' || event_id || '").hexdigest()'
      WHEN 6 THEN 'eval("x")'
      WHEN 7 THEN 'model.eval()'
      WHEN 8 THEN 'subprocess.run("ls", shell=True)'
      WHEN 9 THEN 'obj = pickle.loads(blob)'
      WHEN 10 THEN 'exec("y = 1")'
      WHEN 11 THEN 'subprocess.run(["ls"], shell=False)'
      WHEN 12 THEN 'sp.run("ls", shell=True)'
      WHEN 13 THEN 'obj = json.loads(blob)'
      WHEN 14 THEN '# eval("x") in a comment'
      WHEN 15 THEN 'password = "short"'
      WHEN 16 THEN 'token = "abc"'
      WHEN 17 THEN 'hashlib.sha256(b"x")'
      WHEN 18 THEN 'query = f"select name from t where id = {{x}}"'
      WHEN 19 THEN 'query = "SELECT * FROM t WHERE id = %s"'
      WHEN 20 THEN 'pwd = "' || md5(CAST(event_id AS VARCHAR)) || '"'
      WHEN 21 THEN 'password = "' || md5(CAST(event_id AS VARCHAR)) || '"'
      WHEN 22 THEN 'f = eval'
      ELSE 'g = builtins.eval' END AS line
  FROM events),
code_files AS (
  SELECT block * 4294967296 + user_id AS artifact_seq, user_id, block,
    'u' || user_id || CASE WHEN block = 0 THEN '' ELSE '_' || block END || '.py' AS filename,
    ['COPILOT', 'CLAUDE', 'AGENT', 'UNKNOWN'][user_id % 4 + 1] AS source, min(ts) AS created_at,
    string_agg(line, chr(10) ORDER BY event_id)
      || CASE WHEN user_id % 17 = 0 THEN chr(10) || 'def broken(:' ELSE '' END AS content
  FROM code_lines GROUP BY user_id, block),
code_artifacts AS (
  SELECT *, 'python' AS language, sha256(content) AS content_hash, {ARTIFACT_ID} AS artifact_id FROM code_files),
code_rows AS (
  SELECT a.artifact_id, a.artifact_seq, a.user_id, a.filename, a.source, l.event_id, l.line, l.r,
    row_number() OVER (PARTITION BY l.user_id, l.block ORDER BY l.event_id) AS line_no
  FROM code_lines l JOIN code_artifacts a ON a.user_id = l.user_id AND a.block = l.block)"""

DEPS = f"""
dep_files AS (
  SELECT (p_partkey // 131072) * 4294967296 + CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) * 3 + p_size % 3 AS artifact_seq,
    p_brand || CASE WHEN p_partkey // 131072 = 0 THEN '' ELSE '/' || (p_partkey // 131072) END || '/'
      || ['requirements.txt', 'pyproject.toml', 'package.json'][p_size % 3 + 1] AS filename,
    'UNKNOWN_DEPENDENCY_FILE' AS source,
    ['# comment' || chr(10) || chr(10), 'dependencies = [' || chr(10), '"dependencies": {{' || chr(10)][p_size % 3 + 1]
      || string_agg(CASE p_size % 3
           WHEN 0 THEN pkg || CASE WHEN p_partkey % 5 = 0 THEN '>=' || p_size || '.0.0 # note' ELSE '==' || p_size || '.0.0' END
           WHEN 1 THEN '    "' || pkg || '>=' || p_size || '.0.0",'
           ELSE '    "' || pkg || '": "^' || p_size || '.0.0",' END, chr(10) ORDER BY p_partkey)
      || ['', chr(10) || ']', chr(10) || '}}'][p_size % 3 + 1] AS content
  FROM (SELECT *, ['requests', 'numpy', 'pandas', 'fastapi', 'SQLAlchemy', 'Flask', 'pyyaml', 'shodan', 'MD5',
          'flask-secure-pro', 'django-utils-advanced', 'scikit-learn', 'boto3', 'left-pad', 'requests-ai', 'pickle']
          [p_partkey % 16 + 1] AS pkg FROM part)
  GROUP BY p_brand, p_size % 3, p_partkey // 131072),
dep_artifacts AS (
  SELECT *, 'python' AS language, sha256(content) AS content_hash, {ARTIFACT_ID} AS artifact_id FROM dep_files),
dep_lines AS (
  SELECT artifact_id, artifact_seq, filename, source, content, i AS line_no, {stripped('ls[i]')} AS entry
  FROM (SELECT *, i FROM (SELECT *, {lines_of('content')} AS ls FROM dep_artifacts), unnest(range(1, len(ls) + 1)) AS t(i))),
dep_entries AS (SELECT * FROM dep_lines WHERE entry <> '' AND NOT starts_with(entry, '#'))"""

REQ = r"^([a-zA-Z0-9_\-\.]+)(?:\s*[<>=!~]+(.+))?"
TOML = r'^"([a-zA-Z0-9_\-\.]+)(?:[<>=!~]+(.+))?"'
JSON = r'^"([a-zA-Z0-9_\-\.\/]+)"\s*:\s*"(.+)"'


def parsed_sql() -> str:
    def pick(group: int) -> str:
        return f"""CASE WHEN filename LIKE '%requirements.txt' THEN regexp_extract(entry, '{REQ}', {group})
          WHEN filename LIKE '%pyproject.toml' AND contains(content, 'dependencies') THEN regexp_extract(entry, '{TOML}', {group})
          WHEN filename LIKE '%package.json' AND contains(content, '"dependencies": {{') THEN regexp_extract(entry, '{JSON}', {group})
          ELSE '' END"""

    return f"""
parsed AS (SELECT * FROM (
  SELECT artifact_id, artifact_seq, filename AS source_file, source AS artifact_source, line_no, entry,
    lower({pick(1)}) AS name, {pick(2)} AS version_spec FROM dep_entries) WHERE name <> '')"""


def naming_sql(policy) -> str:
    return "|".join([f"{s}$" for s in policy.suffixes] + [f"^{p}-" for p in policy.prefixes])


NAMING = naming_sql(CORE_POLICY)


def classified_sql(policy=CORE_POLICY) -> str:
    naming = naming_sql(policy)
    deny = ", ".join(map(text, policy.denylist))
    allow = ", ".join(map(text, policy.allowlist))
    return f"""{parsed_sql()},
listed AS (
  SELECT *, CASE WHEN name IN ({deny}) THEN 'DENY' WHEN name IN ({allow}) THEN 'ALLOW' ELSE 'UNKNOWN' END AS status FROM parsed),
deps AS (
  SELECT *, status = 'UNKNOWN' AND regexp_matches(name, '{naming}') AS suspicious FROM listed),
dep_report AS (
  SELECT *, CASE WHEN status = 'DENY' THEN 'Package ''' || name || ''' is on the denylist.'
    WHEN suspicious THEN 'Package ''' || name || ''' flagged as potential hallucination risk (suspicious naming).'
    WHEN status = 'UNKNOWN' THEN 'Package ''' || name || ''' is not in the allowlist or denylist.' END AS risk_notes FROM deps)"""


PARSED_DOC = r"""
deps AS (
  SELECT *, coalesce(status0 = 'UNKNOWN' AND regexp_matches(lower(name), '(-pro|-ai|-enterprise|secure-pro|gpt)'), false) AS suspicious,
    CASE WHEN status0 = 'UNKNOWN' AND regexp_matches(lower(name), '(-pro|-ai|-enterprise|secure-pro|gpt)') THEN 'HALLUCINATED' ELSE status0 END AS status
  FROM (SELECT artifact_id, artifact_seq, filename AS source_file, source AS artifact_source, line_no, entry,
      regexp_extract(entry, '^([\w.-]+)(==|>=|<=|>|<|~=)?([\w.]+)?', 1) AS name,
      nullif(regexp_extract(entry, '^([\w.-]+)(==|>=|<=|>|<|~=)?([\w.]+)?', 3), '') AS version_spec,
      CASE WHEN lower(regexp_extract(entry, '^[\w.-]+')) IN ('requests', 'pandas', 'numpy', 'streamlit') THEN 'ALLOW'
        WHEN lower(regexp_extract(entry, '^[\w.-]+')) IN ('pyyaml', 'unsafe-package-xyz') THEN 'DENY' ELSE 'UNKNOWN' END AS status0
    FROM dep_entries WHERE filename LIKE '%requirements.txt') WHERE name <> '')"""


# --- Findings -------------------------------------------------------------------------------------------------------


def line_rules_sql(catalog: Ruleset, rows: str, name: str) -> str:
    """Findings of the line rules over `rows(artifact_id, artifact_seq, filename, source, line_no, line)`."""
    branches = []
    for ordinal, rule in catalog.line_rules:
        e = rule.emits[0]
        branches.append(f"""
  SELECT artifact_id, artifact_seq, filename AS artifact_filename, source AS artifact_source,
    {text(e.finding_type)} AS finding_type, {text(e.severity)} AS severity, {text(e.rule_id)} AS rule_id,
    {text(e.description)} AS description, '{catalog.location_label} ' || line_no AS location,
    {stripped('line')} AS evidence_snippet, {text(e.remediation_guidance)} AS remediation_guidance,
    CAST({text(e.cwe_mapping)} AS VARCHAR) AS cwe_mapping, 1 AS phase, line_no, {ordinal} AS rule_ord, 0 AS dup
  FROM {rows} WHERE regexp_matches(line, {text(rule.pattern)})""")
    return f"{name} AS ({' UNION ALL '.join(branches)})"


# Expected tree hits by line template: (r, emission rule id, called name, evidence, number of findings).
CORE_TREE = [
    (6, "AST_DANGEROUS_EVAL_EXEC", "eval", "eval('x')", 2),
    (7, "AST_DANGEROUS_EVAL_EXEC", "eval", "model.eval()", 2),
    (7, "AST_DANGEROUS_EVAL_EXEC", "eval", "model.eval", 2),
    (8, "AST_SUBPROCESS_SHELL_TRUE", "run", "subprocess.run('ls', shell=True)", 2),
    (9, "AST_PICKLE_LOADS", "", "pickle.loads(blob)", 1),
    (10, "AST_DANGEROUS_EVAL_EXEC", "exec", "exec('y = 1')", 2),
    (23, "AST_DANGEROUS_EVAL_EXEC", "eval", "builtins.eval", 2),
]
DOC_TREE = [
    (8, "A201", "", 'subprocess.run("ls", shell=True)', 1),
    (9, "A202", "", "pickle.loads(blob)", 1),
]


def tree_sql(catalog: Ruleset, hits, name: str = "tree_findings", more: str = "") -> str:
    texts = {e.rule_id: (i, e) for i, r in reversed(catalog.tree_rules) for e in r.emits if e.rule_id == r.rule_id}
    rows = []
    for r, rule_id, called, snippet, copies in hits:
        ordinal, e = texts[rule_id]
        rows += [
            (r, text(e.finding_type), text(e.severity), text(rule_id), text(e.description.replace("{name}", called)),
             text(snippet), text(e.remediation_guidance), text(e.cwe_mapping), ordinal, dup)
            for dup in range(copies)
        ]
    return f"""
{name} AS (
  SELECT c.artifact_id, c.artifact_seq, c.filename AS artifact_filename, c.source AS artifact_source, t.finding_type,
    t.severity, t.rule_id, t.description, '{catalog.location_label} ' || c.line_no AS location, t.evidence_snippet,
    t.remediation_guidance, CAST(t.cwe_mapping AS VARCHAR) AS cwe_mapping, 2 AS phase, c.line_no, t.rule_ord, t.dup{more}
  FROM code_rows c JOIN (VALUES {values(rows)}) AS t(r, finding_type, severity, rule_id, description, evidence_snippet,
    remediation_guidance, cwe_mapping, rule_ord, dup) ON c.r = t.r
  WHERE c.user_id % 17 <> 0)"""


# Expected tree hits by nested file: (file, position, line, emission rule id, called name, evidence, number of findings).
# Positions count the nodes of the syntax tree breadth first, from 0 for the module.
NESTED_TREE = [
    (0, 12, 7, "AST_DANGEROUS_EVAL_EXEC", "eval", "eval('1 + 1')", 2),
    (0, 14, 6, "AST_PICKLE_LOADS", "", "pickle.loads(blob)", 1),
    (1, 4, 1, "AST_DANGEROUS_EVAL_EXEC", "eval", "eval('1')", 2),
    (1, 6, 1, "AST_DANGEROUS_EVAL_EXEC", "exec", "exec('2')", 2),
    (2, 12, 3, "AST_SUBPROCESS_SHELL_TRUE", "run", "subprocess.run(['ls'], shell=True)", 2),
    (2, 14, 7, "AST_DANGEROUS_EVAL_EXEC", "eval", "builtins.eval(exec('z'))", 2),
    (2, 19, 7, "AST_DANGEROUS_EVAL_EXEC", "eval", "builtins.eval", 2),
    (2, 20, 7, "AST_DANGEROUS_EVAL_EXEC", "exec", "exec('z')", 2),
]


def nested_sql() -> str:
    """Tree findings of the nested files; `tree_sql` gives their texts, one pseudo line per (file, position)."""
    files = values((n, text(body)) for n, body in enumerate(NESTED_FILES))
    places = values((100 * f + p, f, p, line) for f, p, line, *_ in NESTED_TREE)
    hits = [(100 * f + p, rule_id, called, snippet, copies) for f, p, _, rule_id, called, snippet, copies in NESTED_TREE]
    return f"""
nested AS (
  SELECT o_orderkey AS artifact_seq, 'o' || o_orderkey || '.py' AS filename,
    ['COPILOT', 'CLAUDE', 'AGENT', 'UNKNOWN'][o_orderkey % 4 + 1] AS source, body || '# order ' || o_orderkey AS content
  FROM orders JOIN (VALUES {files}) AS b(f, body) ON f = o_orderkey % 4),
code_rows AS (
  SELECT {ARTIFACT_ID} AS artifact_id, artifact_seq, filename, source, 1 AS user_id, r, position, line_no
  FROM nested JOIN (VALUES {places}) AS p(r, f, position, line_no) ON f = artifact_seq % 4),
{tree_sql(CORE, hits, more=", c.position")}"""


def dep_findings_sql(doc: bool = False) -> str:
    branches = []
    reasons = [(0, dep._SUSPICIOUS_DOC, "suspicious")] if doc else [
        (0, dep._DENIED, "status = 'DENY'"), (1, dep._SUSPICIOUS, "suspicious")]
    for ordinal, e, condition in reasons:
        before, after = e.description.split("{name}")
        branches.append(f"""
  SELECT artifact_id, artifact_seq, source_file AS artifact_filename, artifact_source, {text(e.finding_type)} AS finding_type,
    {text(e.severity)} AS severity, {text(e.rule_id)} AS rule_id, {text(before)} || name || {text(after)} AS description,
    'File: ' || source_file AS location, {'name' if doc else 'entry'} AS evidence_snippet,
    {text(e.remediation_guidance)} AS remediation_guidance, CAST({text(e.cwe_mapping)} AS VARCHAR) AS cwe_mapping,
    3 AS phase, line_no, {ordinal} AS rule_ord, 0 AS dup
  FROM deps WHERE {condition}""")
    return f"dep_findings AS ({' UNION ALL '.join(branches)})"


def findings_sql() -> str:
    return ",".join([
        CODE, DEPS, classified_sql(), line_rules_sql(CORE, "code_rows", "line_findings"), tree_sql(CORE, CORE_TREE),
        dep_findings_sql(),
        """
findings AS (SELECT * FROM line_findings UNION ALL SELECT * FROM tree_findings UNION ALL SELECT * FROM dep_findings),
artifacts AS (SELECT artifact_id, artifact_seq, filename, source, language, content_hash, content FROM code_artifacts
  UNION ALL SELECT artifact_id, artifact_seq, filename, source, language, content_hash, content FROM dep_artifacts)""",
    ])


def doc_findings_sql() -> str:
    return ",".join([
        CODE, DEPS, PARSED_DOC, line_rules_sql(DOC, "code_rows", "line_findings"), tree_sql(DOC, DOC_TREE),
        dep_findings_sql(doc=True),
        """
findings AS (SELECT * FROM line_findings UNION ALL SELECT * FROM tree_findings UNION ALL SELECT * FROM dep_findings)""",
    ])


COPIES = f"""
docs AS (
  SELECT row_number() OVER (PARTITION BY coalesce(source, 'UNKNOWN'), text) - 1 AS artifact_seq, 'snippet.py' AS filename, source, text AS content
  FROM documents WHERE text IS NOT NULL),
doc_artifacts AS (
  SELECT *, 'python' AS language, sha256(content) AS content_hash, {ARTIFACT_ID} AS artifact_id
  FROM (SELECT * REPLACE (coalesce(source, 'UNKNOWN') AS source) FROM docs))"""


def doc_rows_sql(documents: str = DOCUMENTS) -> str:
    return f"""{documents},
doc_rows AS (
  SELECT artifact_id, artifact_seq, filename, source, i AS line_no, ls[i] AS line
  FROM (SELECT *, {lines_of('content')} AS ls FROM doc_artifacts), unnest(range(1, len(ls) + 1)) AS t(i))"""


FINDING_COLUMNS = (
    "artifact_id, artifact_filename, artifact_source, finding_type, severity, rule_id, description, location, "
    "evidence_snippet, remediation_guidance, cwe_mapping, phase, CAST(line_no AS INTEGER) AS line_no, rule_ord, dup"
)
LINE_ID = ("sha256(concat_ws(chr(1), artifact_id, CAST(phase AS VARCHAR), CAST(line_no AS VARCHAR), "
           "CAST(rule_ord AS VARCHAR), CAST(dup AS VARCHAR))) AS finding_id")
WEIGHT = "CASE severity WHEN 'CRITICAL' THEN 100 WHEN 'HIGH' THEN 50 WHEN 'MEDIUM' THEN 10 WHEN 'LOW' THEN 1 ELSE 0 END"


def put(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = f"WITH {ctes.strip()} {body}"


AUDITED = """, audited AS (SELECT artifact_id, artifact_seq, filename, language, content FROM code_artifacts
  UNION ALL SELECT artifact_id, artifact_seq, filename, language, content FROM dep_artifacts)"""

# --- Sources and routing --------------------------------------------------------------------------------------------

put("artifact_inventory", DOCUMENTS, """SELECT artifact_id, artifact_seq, filename, source, language, content_hash,
  left(content_hash, 16) || '...' AS hash_preview FROM doc_artifacts""")
put("code_artifact_inventory", CODE, """SELECT filename, source, language, left(content_hash, 16) || '...' AS hash_preview,
  strftime(created_at, '%Y-%m-%d %H:%M') AS created FROM code_artifacts""")
put("code_artifact_inventory_legacy", CODE, """SELECT filename, source, left(content_hash, 10) || '...' AS hash_preview,
  strftime(created_at, '%Y-%m-%d %H:%M') AS created FROM code_artifacts""")
put("artifact_language", f"{CODE},{DEPS}{AUDITED}", """SELECT artifact_seq, filename,
  CASE WHEN filename LIKE '%.py' THEN 'python' WHEN filename LIKE '%.txt' THEN 'text' WHEN filename LIKE '%.toml' THEN 'toml'
  ELSE 'unknown' END AS language FROM audited""")
put("artifact_routing", f"{CODE},{DEPS}{AUDITED}", """SELECT artifact_seq, filename,
  CASE WHEN regexp_matches(filename, '\\.(txt|toml|json)$') THEN 'dependency_scan' ELSE 'code_scan' END AS route FROM audited""")
put("sniffed_filename", f"""{CODE},{DEPS}{AUDITED},
snippets AS (SELECT 'turn/' || conv_id || '/' || turn AS snippet_id, text AS content FROM conversations
  UNION ALL SELECT 'file/' || filename, content FROM audited),
entries AS (SELECT snippet_id, {stripped('l')} AS l
  FROM (SELECT snippet_id, unnest(string_split_regex({stripped('content')}, '{BREAK}')) AS l FROM snippets)),
shares AS (SELECT snippet_id, avg(CASE WHEN regexp_matches(l, '^[a-zA-Z0-9_\\-\\.]+\\s*[<>=!~]+') THEN 1.0 ELSE 0.0 END) AS share
  FROM entries WHERE l <> '' AND NOT starts_with(l, '#') GROUP BY snippet_id)""",
    """SELECT s.snippet_id, CASE WHEN share > 0.5 THEN 'requirements.txt' ELSE 'snippet.py' END AS filename,
  sha256(content) AS content_hash FROM snippets s LEFT JOIN shares USING (snippet_id) WHERE content <> ''""")
put("artifact_lines", doc_rows_sql(), "SELECT artifact_seq, CAST(line_no AS INTEGER) AS line_no, line FROM doc_rows")

_UPLOADED = "'d' || doc_id || '.txt' AS filename, sha256({t}) AS content_hash, CAST(octet_length(encode({t})) AS INTEGER) AS n_bytes, CAST(NULL AS VARCHAR) AS error_class FROM documents WHERE text IS NOT NULL"
ORACLE["upload_round_trip"] = "SELECT " + _UPLOADED.format(t="text")
ORACLE["archive_round_trip"] = "SELECT " + _UPLOADED.format(t="replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))")

# --- Scans ----------------------------------------------------------------------------------------------------------

put("secret_findings_documents", f"{doc_rows_sql()},{line_rules_sql(CORE, 'doc_rows', 'found')}",
    f"SELECT {LINE_ID}, {FINDING_COLUMNS} FROM found")
put("regex_findings", f"{CODE},{line_rules_sql(CORE, 'code_rows', 'found')}", f"SELECT {LINE_ID}, {FINDING_COLUMNS} FROM found")
put("regex_findings_notebook", f"{CODE},{line_rules_sql(NOTEBOOK, 'code_rows', 'found')}", f"SELECT {FINDING_COLUMNS} FROM found")
put("regex_findings_doc", f"{CODE},{line_rules_sql(DOC, 'code_rows', 'found')}", f"SELECT {FINDING_COLUMNS} FROM found")
put("ast_findings", f"{CODE},{tree_sql(CORE, CORE_TREE)}", f"SELECT {FINDING_COLUMNS} FROM tree_findings")
ORACLE["ast_findings_in_place"] = ORACLE["ast_findings"]
ORACLE["ast_findings_incremental"] = ORACLE["ast_findings"]
put("ast_findings_dedup", f"{CODE},{tree_sql(CORE, CORE_TREE)}", f"SELECT {FINDING_COLUMNS} FROM tree_findings WHERE dup = 0")
put("ast_findings_doc", f"{CODE},{tree_sql(DOC, DOC_TREE)}", f"SELECT {FINDING_COLUMNS} FROM tree_findings")
put("ast_findings_nested", nested_sql(), f"""SELECT sha256(concat_ws(chr(1), artifact_id, CAST(phase AS VARCHAR),
    CAST(position AS VARCHAR), CAST(rule_ord AS VARCHAR), CAST(dup AS VARCHAR))) AS finding_id,
  CAST(position AS BIGINT) AS position, {FINDING_COLUMNS} FROM tree_findings""")
put("scan_errors", CODE, """SELECT artifact_id, 'ast' AS stage, 'SyntaxError' AS error_class FROM code_artifacts
  WHERE user_id % 17 = 0""")
ORACLE["audit_scan_errors"] = ORACLE["scan_errors"]
put("custom_rule_findings", CODE, """SELECT artifact_id, filename AS artifact_filename, source AS artifact_source,
  CASE r WHEN 13 THEN 'INJECTION_SINK' ELSE 'DANGEROUS_EXEC' END AS finding_type,
  CASE r WHEN 13 THEN 'LOW' ELSE 'HIGH' END AS severity,
  CASE r WHEN 13 THEN 'INJECTION_JSON_LOADS' ELSE 'DANGEROUS_EXEC_ALIASED_SHELL' END AS rule_id,
  CASE r WHEN 13 THEN 'JSON is loaded.' ELSE 'Shell call through an alias.' END AS description,
  'line ' || line_no AS location,
  CASE r WHEN 13 THEN 'obj = json.loads(blob)' ELSE 'sp.run(''ls'', shell=True)' END AS evidence_snippet,
  CASE r WHEN 13 THEN 'Validate the input.' ELSE 'Avoid shell=True.' END AS remediation_guidance,
  CASE r WHEN 13 THEN 'CWE-20' ELSE 'CWE-78' END AS cwe_mapping,
  CASE r WHEN 13 THEN 1 ELSE 2 END AS phase, CAST(line_no AS INTEGER) AS line_no,
  CASE r WHEN 13 THEN 8 ELSE 9 END AS rule_ord, 0 AS dup
  FROM code_rows WHERE r = 13 OR (r = 12 AND user_id % 17 <> 0)""")
# Order rules of shape 0 and 3 match the MD5 line of the event with the order's number, shape 1 the plain assignment.
put("rule_table_findings", f"""{CODE},{line_rules_sql(CORE, 'code_rows', 'line_findings')},
order_findings AS (
  SELECT artifact_id, artifact_seq, filename AS artifact_filename, source AS artifact_source, 'UNSAFE_CRYPTO' AS finding_type,
    'LOW' AS severity, 'ORDER_' || o_orderkey AS rule_id, 'Mark of order ' || o_orderkey || '.' AS description,
    'line ' || line_no AS location, line AS evidence_snippet, 'Remove the mark.' AS remediation_guidance, 'CWE-1' AS cwe_mapping,
    1 AS phase, line_no, CAST(o_orderkey + 100 AS INTEGER) AS rule_ord, 0 AS dup
  FROM code_rows JOIN orders ON o_orderkey = event_id AND ((r = 5 AND o_orderkey % 4 IN (0, 3)) OR (r = 0 AND o_orderkey % 4 = 1))),
found AS (SELECT * FROM line_findings UNION ALL SELECT * FROM order_findings)""",
    f"SELECT {LINE_ID}, {FINDING_COLUMNS} FROM found")
put("rule_catalog", f"""{CODE},{line_rules_sql(CORE, 'code_rows', 'line_findings')},{tree_sql(CORE, CORE_TREE)},
hits AS (SELECT rule_id, count(*) AS n FROM (SELECT rule_id FROM line_findings UNION ALL SELECT rule_id FROM tree_findings) GROUP BY 1)""",
    f"""SELECT c.*, coalesce(n, 0) AS finding_count FROM (VALUES {values([
        (text('SECRET_API_KEY'), text('REGEX'), text('CRITICAL'), text('SECRET'), text('CWE-798')),
        (text('SECRET_AWS_KEY'), text('REGEX'), text('CRITICAL'), text('SECRET'), text('CWE-798')),
        (text('SECRET_GENERIC_PASSWORD'), text('REGEX'), text('HIGH'), text('SECRET'), text('CWE-798')),
        (text('INJECTION_SQL_FSTRING'), text('REGEX'), text('HIGH'), text('INJECTION_SINK'), text('CWE-89')),
        (text('UNSAFE_CRYPTO_MD5'), text('REGEX'), text('MEDIUM'), text('UNSAFE_CRYPTO'), text('CWE-327')),
        (text('AST_DANGEROUS_EVAL_EXEC'), text('AST'), text('HIGH'), text('DANGEROUS_EXEC'), text('CWE-94')),
        (text('AST_SUBPROCESS_SHELL_TRUE'), text('AST'), text('HIGH'), text('DANGEROUS_EXEC'), text('CWE-78')),
        (text('AST_PICKLE_LOADS'), text('AST'), text('CRITICAL'), text('UNSAFE_DESERIALIZATION'), text('CWE-502')),
    ])}) AS c(rule_id, detection_method, severity, finding_type, cwe_mapping) LEFT JOIN hits USING (rule_id)""")

# --- Dependencies ---------------------------------------------------------------------------------------------------

for _key, _suffix in (("requirements", "requirements.txt"), ("pyproject", "pyproject.toml"), ("package_json", "package.json")):
    put(f"dep_parse_{_key}", f"{DEPS},{parsed_sql()}", f"""SELECT artifact_id, source_file, CAST(line_no AS INTEGER) AS line_no,
  name, version_spec FROM parsed WHERE source_file LIKE '%{_suffix}'""")

_CLASSIFIED = """SELECT artifact_id, source_file, CAST(line_no AS INTEGER) AS line_no, name, version_spec, status, suspicious FROM deps"""
put("dep_classification", f"{DEPS},{classified_sql()}", _CLASSIFIED)
put("dep_classification_notebook", f"{DEPS},{classified_sql(NOTEBOOK_POLICY)}", _CLASSIFIED)
put("dep_classification_doc", f"{DEPS},{PARSED_DOC}", _CLASSIFIED)
put("dep_classification_policy_table", f"""{DEPS},{parsed_sql()},
policy AS (SELECT ['requests', 'numpy', 'pandas', 'left-pad', 'shodan', 'boto3'][p_partkey % 6 + 1] AS name,
  bool_or(p_partkey % 6 >= 4 AND p_size > 25) AS denied FROM part GROUP BY 1),
listed AS (SELECT p.*, CASE WHEN denied THEN 'DENY' WHEN NOT denied THEN 'ALLOW' ELSE 'UNKNOWN' END AS status
  FROM parsed p LEFT JOIN policy USING (name)),
deps AS (SELECT *, status = 'UNKNOWN' AND regexp_matches(name, '{NAMING}') AS suspicious FROM listed)""", _CLASSIFIED)
put("dependency_report", f"{DEPS},{classified_sql()}", """SELECT artifact_id, CAST(line_no AS INTEGER) AS line_no, name,
  version_spec, source_file, status, risk_notes FROM dep_report""")
put("dependency_findings", f"{DEPS},{classified_sql()},{dep_findings_sql()}", f"SELECT {LINE_ID}, {FINDING_COLUMNS} FROM dep_findings")
put("dependency_findings_doc", f"{DEPS},{PARSED_DOC},{dep_findings_sql(doc=True)}", f"SELECT {FINDING_COLUMNS} FROM dep_findings")
put("hallucinated_packages", f"{DEPS},{classified_sql()},{dep_findings_sql()}", """SELECT DISTINCT
  lower(string_split(description, '''')[2]) AS package_name FROM dep_findings WHERE finding_type = 'HALLUCINATED_PACKAGE'""")

_NAMES = ", names AS (SELECT DISTINCT name FROM deps WHERE suspicious)"
_VIEW = """SELECT name, version_spec AS version, status, source_file,
  CASE WHEN name IN (SELECT name FROM names) THEN 'Yes' ELSE 'No' END AS hallucination_risk FROM deps"""
put("dependencies_filtered", f"{DEPS},{classified_sql()}{_NAMES}", f"{_VIEW} WHERE status IN ('UNKNOWN', 'DENY')")
put("dependencies_hallucinated", f"{DEPS},{classified_sql()}{_NAMES}", f"SELECT * FROM ({_VIEW}) WHERE hallucination_risk = 'Yes'")
put("dependency_facets", f"{DEPS},{classified_sql()}", "SELECT DISTINCT 'status' AS facet, status AS value FROM deps")
put("dependency_risk_summary", f"{DEPS},{classified_sql()}{_NAMES}", """SELECT denylisted, unknown, potential_hallucinations,
  denylisted = 0 AND unknown = 0 AND potential_hallucinations = 0 AS all_allowed FROM (
  SELECT count(*) FILTER (status = 'DENY') AS denylisted, count(*) FILTER (status = 'UNKNOWN') AS unknown,
    (SELECT count(*) FROM names) AS potential_hallucinations FROM deps WHERE status = 'UNKNOWN')""")

# --- Findings -------------------------------------------------------------------------------------------------------

F_ALL = findings_sql()
put("all_findings", F_ALL, f"SELECT {FINDING_COLUMNS} FROM findings")
put("finding_artifact_lookup", F_ALL, """SELECT f.artifact_id, coalesce(c.filename, 'N/A') AS artifact_filename, rule_id,
  CAST(line_no AS INTEGER) AS line_no, dup FROM findings f LEFT JOIN code_artifacts c USING (artifact_id)""")
put("findings_by_phase", F_ALL, """SELECT p.phase, phase_name, count(f.rule_id) AS new_findings
  FROM (VALUES (1, 'regex'), (2, 'ast'), (3, 'dependency')) AS p(phase, phase_name) LEFT JOIN findings f ON f.phase = p.phase GROUP BY 1, 2""")
put("findings_filtered", F_ALL, """SELECT severity, finding_type, rule_id, artifact_filename, location, description FROM findings
  WHERE severity IN ('CRITICAL', 'MEDIUM') AND finding_type IN ('SECRET', 'UNSAFE_CRYPTO', 'HALLUCINATED_PACKAGE')""")
put("findings_wide", F_ALL, """SELECT severity, finding_type, rule_id, artifact_filename, location, description,
  evidence_snippet, remediation_guidance FROM findings""")
put("finding_detail", F_ALL, """SELECT severity || ' - ' || rule_id || ' (' || artifact_filename || ')' AS label, severity, rule_id,
  artifact_filename, location, description, evidence_snippet, remediation_guidance FROM findings WHERE severity = 'HIGH'
  ORDER BY phase, artifact_seq, artifact_id, line_no, rule_ord, dup LIMIT 1 OFFSET 7""")
# Report order. Tree findings follow the breadth-first walk: the attribute inside a call lies one level below all calls.
_REPORT = "phase, artifact_seq, artifact_id, phase = 2 AND evidence_snippet = 'model.eval', line_no, rule_ord, dup"
put("finding_positions", F_ALL, f"""SELECT row_number() OVER (ORDER BY {_REPORT}) AS report_position, {FINDING_COLUMNS} FROM findings""")
put("finding_detail_deep", F_ALL, f"""SELECT severity || ' - ' || rule_id || ' (' || artifact_filename || ')' AS label, severity, rule_id,
  artifact_filename, location, description, evidence_snippet, remediation_guidance FROM findings
  ORDER BY {_REPORT} LIMIT 1 OFFSET 1500""")
put("finding_facets", F_ALL, """SELECT DISTINCT 'severity' AS facet, severity AS value FROM findings
  UNION ALL SELECT DISTINCT 'finding_type', finding_type FROM findings""")
put("finding_type_breakdown", F_ALL, """SELECT t.finding_type, count(f.rule_id) AS finding_count
  FROM (VALUES ('SECRET'), ('INSECURE_DEPENDENCY'), ('HALLUCINATED_PACKAGE')) AS t(finding_type)
  LEFT JOIN findings f USING (finding_type) GROUP BY 1""")
_SEVERITIES = "(VALUES (1, 'CRITICAL'), (2, 'HIGH'), (3, 'MEDIUM'), (4, 'LOW')) AS s(ord, severity)"
put("severity_breakdown", F_ALL, f"""SELECT s.severity, count(f.rule_id) AS finding_count FROM {_SEVERITIES}
  LEFT JOIN findings f USING (severity) GROUP BY 1""")
put("severity_breakdown_documents", f"{doc_rows_sql()},{line_rules_sql(CORE, 'doc_rows', 'found')}",
    f"SELECT s.severity, count(f.rule_id) AS finding_count FROM {_SEVERITIES} LEFT JOIN found f USING (severity) GROUP BY 1")
_ORDER = "finding_type DESC, phase, artifact_seq, artifact_id, line_no, rule_ord, dup"
_RANK = "CASE severity WHEN 'CRITICAL' THEN 4 WHEN 'HIGH' THEN 3 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 1 ELSE 0 END"


def top_sql(first: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY {first} DESC, {_ORDER}) AS INTEGER) AS rank, severity, finding_type, rule_id,
  description, artifact_filename, location, remediation_guidance FROM findings ORDER BY rank LIMIT 5"""


put("top_findings", F_ALL, top_sql("severity"))
put("top_findings_ranked", F_ALL, top_sql(_RANK))

# --- Risk, gates, summary -------------------------------------------------------------------------------------------

put("total_risk_score", F_ALL, f"SELECT CAST(coalesce(sum({WEIGHT}), 0) AS BIGINT) AS total_risk_score FROM findings")
put("artifact_risk_score", F_ALL, f"""SELECT a.artifact_id, a.artifact_seq, a.filename, a.source, count(f.rule_id) AS finding_count,
  CAST(coalesce(sum({WEIGHT}), 0) AS BIGINT) AS risk_score FROM artifacts a LEFT JOIN findings f USING (artifact_id) GROUP BY ALL""")
put("artifact_risk_score_copies", f"{doc_rows_sql(COPIES)},{line_rules_sql(CORE, 'doc_rows', 'findings')}",
    f"""SELECT a.artifact_id, a.artifact_seq, a.filename, a.source, count(f.rule_id) AS finding_count,
  CAST(coalesce(sum({WEIGHT}), 0) AS BIGINT) AS risk_score FROM doc_artifacts a LEFT JOIN findings f USING (artifact_id) GROUP BY ALL""")

FLAGS = f""", flags AS (SELECT
  EXISTS (SELECT 1 FROM findings WHERE severity IN ('CRITICAL', 'HIGH')) AS severe,
  EXISTS (SELECT 1 FROM findings WHERE finding_type = 'SECRET') AS secrets,
  EXISTS (SELECT 1 FROM deps WHERE status IN ('DENY', 'UNKNOWN')) AS risky,
  (SELECT CAST(coalesce(sum({WEIGHT}), 0) AS BIGINT) FROM findings) AS score)"""
put("gate_flags", F_ALL + FLAGS, """SELECT severe AS has_high_critical_findings, secrets AS has_secret_findings,
  risky AS has_risky_dependencies, score AS total_risk_score FROM flags""")


def gates_sql(source: str, keys: str = "") -> str:
    def gate(n, kind, tools, checks, action, owner, evidence):
        return (f"SELECT {keys}{n} AS gate_ord, '{kind}' AS gate_type, {tools} AS tools, {checks} AS required_checks, "
                f"{action} AS failure_action, '{owner}' AS owner_role, '{evidence}' AS evidence_required FROM {source}")

    return " UNION ALL ".join([
        gate(1, "CI_SECURITY", "'SAST Scanner|Dependency Scanner'",
             "'No HIGH/CRITICAL Vulnerabilities|Dependency Allowlist Compliance'",
             "CASE WHEN severe OR risky THEN 'BLOCK' ELSE 'WARN' END", "DevSecOps Team",
             "code_gen_risk_findings.json|dependency_risk_report.json"),
        gate(2, "PRE_COMMIT", "CASE WHEN secrets THEN 'Secret Scanner' ELSE 'Secret Scanner|Linter' END",
             "CASE WHEN secrets THEN 'No Hardcoded Secrets' ELSE 'No Hardcoded Secrets|Code Formatting' END",
             "CASE WHEN secrets THEN 'BLOCK' ELSE 'WARN' END", "DevSecOps Team", "code_gen_risk_findings.json"),
        gate(3, "CI_BUILD", "'Build Tool|Linter'", "'Successful Build|Code Linting'", "'BLOCK'", "Development Team", ""),
        gate(4, "CI_TEST", "'Test Runner'", "'All Unit Tests Pass'", "'BLOCK'", "QA Team", ""),
        gate(5, "PRE_DEPLOY", "'Manual Review|Audit Artifact Check'", "'Security Audit Approval|Artifact Integrity Check'",
             "CASE WHEN score > 0 THEN 'BLOCK' ELSE 'WARN' END", "Release Manager", ""),
    ])


def group_flags_sql(key: str, finding_key: str, dep_key: str) -> str:
    return f""", flags AS (SELECT g.{key}, coalesce(severe, false) AS severe, coalesce(secrets, false) AS secrets,
    coalesce(risky, false) AS risky, coalesce(score, 0) AS score
  FROM (SELECT DISTINCT {key} FROM artifacts) g
  LEFT JOIN (SELECT {finding_key} AS {key}, bool_or(severity IN ('CRITICAL', 'HIGH')) AS severe,
    bool_or(finding_type = 'SECRET') AS secrets, sum({WEIGHT}) AS score FROM findings GROUP BY 1) f USING ({key})
  LEFT JOIN (SELECT {dep_key} AS {key}, bool_or(status IN ('DENY', 'UNKNOWN')) AS risky FROM deps GROUP BY 1) d USING ({key}))"""


put("gate_plan", F_ALL + FLAGS, gates_sql("flags"))
put("gate_plan_by_source", F_ALL + group_flags_sql("source", "artifact_source", "artifact_source"), gates_sql("flags", "source, "))
put("gate_plan_by_artifact", F_ALL + group_flags_sql("artifact_id", "artifact_id", "artifact_id"),
    f"SELECT artifact_id, gate_ord, gate_type, failure_action FROM ({gates_sql('flags', 'artifact_id, ')})")

_LANGUAGE = "CASE WHEN {f} LIKE '%.py' THEN 'python' WHEN {f} LIKE '%.txt' THEN 'text' WHEN {f} LIKE '%.toml' THEN 'toml' ELSE 'unknown' END"


def rollup_sql() -> str:
    facts = f"""COALESCE(bool_or(severity IN ('CRITICAL', 'HIGH')), false) AS severe, COALESCE(bool_or(finding_type = 'SECRET'), false) AS secrets,
      COALESCE(bool_or(status IN ('DENY', 'UNKNOWN')), false) AS risky, COALESCE(sum({WEIGHT}), 0) AS score FROM stacked"""
    keys = ("source", "language", "artifact_id")
    levels = []
    for level, own in (("total", None), ("source", "source"), ("language", "language"), ("artifact", "artifact_id")):
        columns = ", ".join(k if k == own else f"CAST(NULL AS VARCHAR) AS {k}" for k in keys)
        levels.append(f"SELECT '{level}' AS level, {columns}, {facts}" + (f" GROUP BY {own}" if own else ""))
    return f""", stacked AS (
  SELECT artifact_source AS source, {_LANGUAGE.format(f='artifact_filename')} AS language, artifact_id, severity, finding_type, NULL AS status FROM findings
  UNION ALL SELECT artifact_source, {_LANGUAGE.format(f='source_file')}, artifact_id, NULL, NULL, status FROM deps
  UNION ALL SELECT source, {_LANGUAGE.format(f='filename')}, artifact_id, NULL, NULL, NULL FROM artifacts),
rolled AS ({' UNION ALL '.join(levels)})"""


put("gate_plan_rollup", F_ALL + rollup_sql(), f"""SELECT level, source, language, artifact_id, gate_ord, gate_type, failure_action, owner_role
  FROM ({gates_sql('rolled', 'level, source, language, artifact_id, ')})""")

DOC_FLAGS = f""", counted AS (SELECT
  (SELECT count(*) FROM findings WHERE finding_type = 'HARDCODED_SECRET') AS secrets,
  (SELECT count(*) FROM findings WHERE severity IN ('CRITICAL', 'HIGH')) AS severe,
  (SELECT CAST(coalesce(sum({WEIGHT}), 0) AS BIGINT) FROM findings) AS score,
  (SELECT count(*) FROM deps WHERE status = 'DENY') AS denied,
  (SELECT count(*) FROM deps WHERE status = 'HALLUCINATED') AS invented),
doc_gates AS (
  SELECT 1 AS gate_ord, 'PRE_COMMIT' AS gate_type, CASE WHEN secrets > 0 THEN 'BLOCK' ELSE 'PASS' END AS action,
    CASE WHEN secrets > 0 THEN 'Hardcoded secrets detected.' ELSE 'No hardcoded secrets detected.' END AS reason,
    CASE WHEN secrets > 0 THEN 'findings=' || secrets END AS details,
    CASE WHEN secrets > 0 THEN 'Pre-commit gate blocking due to hardcoded secrets.' END AS message FROM counted
  UNION ALL SELECT 2, 'CI_SECURITY', CASE WHEN severe > 0 THEN 'BLOCK' WHEN score > 20 THEN 'WARN' ELSE 'PASS' END,
    CASE WHEN severe > 0 THEN 'Critical or High severity security findings detected.'
      WHEN score > 20 THEN 'Medium severity security findings detected.'
      ELSE 'No critical/high findings or significant risk score.' END,
    CASE WHEN severe > 0 THEN 'findings=' || severe || ',risk_score=' || score WHEN score > 20 THEN 'risk_score=' || score END,
    CASE WHEN severe > 0 THEN 'CI Security gate blocking due to Critical/High findings.'
      WHEN score > 20 THEN 'CI Security gate warning due to Medium findings.' END FROM counted
  UNION ALL SELECT 3, 'CI_BUILD', CASE WHEN denied + invented > 0 THEN 'BLOCK' ELSE 'PASS' END,
    CASE WHEN denied + invented > 0 THEN 'Denylisted or potentially hallucinated dependencies detected.'
      ELSE 'All dependencies appear safe.' END,
    CASE WHEN denied + invented > 0 THEN 'denylisted=' || denied || ',hallucinated=' || invented END,
    CASE WHEN denied + invented > 0 THEN 'CI Build gate blocking due to insecure/hallucinated dependencies.' END FROM counted)"""
D_ALL = doc_findings_sql()
put("gate_plan_doc", D_ALL + DOC_FLAGS, "SELECT gate_ord, gate_type, action, reason, details FROM doc_gates")
# Places of the tree findings in the breadth-first walk: the module, its statements, then the statements' children, of
# which an expression has one, an assignment two (the value is the second) and a comment line none.
PLACES = """, shapes AS (SELECT artifact_id, line_no, r,
    CASE WHEN r = 14 THEN 0 WHEN r IN (6, 7, 8, 10, 11, 12, 17) THEN 1 ELSE 2 END AS children FROM code_rows),
places AS (SELECT artifact_id, line_no, CAST(children - 1 + count(*) FILTER (r <> 14) OVER (PARTITION BY artifact_id) + 1
    + coalesce(sum(children) OVER (PARTITION BY artifact_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS BIGINT) AS position FROM shapes),
named AS (SELECT f.finding_type, f.severity, sha256(concat_ws(chr(1), f.artifact_id, CAST(phase AS VARCHAR),
    CAST(CASE WHEN phase = 2 THEN p.position ELSE f.line_no END AS VARCHAR), CAST(rule_ord AS VARCHAR), CAST(dup AS VARCHAR))) AS finding_id
  FROM findings f LEFT JOIN places p ON p.artifact_id = f.artifact_id AND p.line_no = f.line_no)"""
put("gate_details_doc", D_ALL + PLACES, """SELECT 'PRE_COMMIT' AS gate_type, 'finding_id' AS detail, finding_id AS value
    FROM named WHERE finding_type = 'HARDCODED_SECRET'
  UNION ALL SELECT 'CI_SECURITY', 'finding_id', finding_id FROM named WHERE severity IN ('CRITICAL', 'HIGH')
  UNION ALL SELECT 'CI_BUILD', 'denylisted', name FROM deps WHERE status = 'DENY'
  UNION ALL SELECT 'CI_BUILD', 'hallucinated', name FROM deps WHERE status = 'HALLUCINATED'""")
put("gate_status_doc", D_ALL + DOC_FLAGS, """SELECT sha256(string_agg(concat_ws(chr(1), gate_type, action, reason,
    coalesce(details, '')), chr(1) ORDER BY gate_ord)) AS plan_id, CASE WHEN bool_or(action = 'BLOCK') THEN 'BLOCK' WHEN bool_or(action = 'WARN') THEN 'WARN'
  ELSE 'PASS' END AS overall_status, CASE WHEN count(message) > 0 THEN 'Analysis completed. ' || string_agg(message, ' ' ORDER BY gate_ord)
  ELSE 'Analysis completed. No significant risks found to block the pipeline.' END AS summary FROM doc_gates""")

THEMES = f""", themes AS (SELECT row_number() OVER (ORDER BY o) AS theme_ord, theme FROM (
  SELECT 1 AS o, {text(summary.THEME_SECRETS)} AS theme WHERE EXISTS (SELECT 1 FROM findings WHERE finding_type = 'SECRET')
  UNION ALL SELECT 2, {text(summary.THEME_EXECUTION)}
    WHERE EXISTS (SELECT 1 FROM findings WHERE finding_type IN ('INJECTION_SINK', 'DANGEROUS_EXEC', 'UNSAFE_DESERIALIZATION'))
  UNION ALL SELECT 3, {text(summary.THEME_PACKAGES)}
    WHERE EXISTS (SELECT 1 FROM findings WHERE finding_type IN ('INSECURE_DEPENDENCY', 'HALLUCINATED_PACKAGE'))
  UNION ALL SELECT 4, {text(summary.THEME_NONE)}
    WHERE NOT EXISTS (SELECT 1 FROM findings WHERE finding_type IN ('SECRET', 'INJECTION_SINK', 'DANGEROUS_EXEC',
      'UNSAFE_DESERIALIZATION', 'INSECURE_DEPENDENCY', 'HALLUCINATED_PACKAGE'))))"""
put("risk_themes", F_ALL + THEMES, "SELECT CAST(theme_ord AS INTEGER) AS theme_ord, theme FROM themes")
SUMMARY = f"""{THEMES}, summary_rows AS (
  SELECT 'overview' AS section, 1 AS ord, 'code_artifacts' AS key, CAST(count(*) AS VARCHAR) AS value FROM artifacts
  UNION ALL SELECT 'overview', 2, 'dependencies', CAST(count(*) AS VARCHAR) FROM deps
  UNION ALL SELECT 'severity', s.ord, s.severity, CAST(count(f.rule_id) AS VARCHAR) FROM {_SEVERITIES}
    LEFT JOIN findings f USING (severity) GROUP BY s.ord, s.severity
  UNION ALL SELECT 'risk_themes', CAST(theme_ord AS INTEGER), 'theme', theme FROM themes
  UNION ALL SELECT 'top_findings', rank, rule_id, '[' || severity || '] ' || description || ' in ' || artifact_filename || ' at '
    || location || '. Remediation: ' || remediation_guidance FROM ({top_sql('severity')})
  UNION ALL SELECT 'top_findings', 1, 'none', {text(summary.NO_FINDINGS)} WHERE NOT EXISTS (SELECT 1 FROM findings))"""
put("executive_summary", F_ALL + SUMMARY, "SELECT section, ord, key, value FROM summary_rows")
put("dashboard_metrics", F_ALL, """SELECT (SELECT count(*) FROM artifacts) AS artifacts, (SELECT count(*) FROM findings) AS total_findings,
  (SELECT count(*) FROM findings WHERE severity = 'CRITICAL') AS critical_findings,
  (SELECT count(*) FROM findings WHERE severity = 'HIGH') AS high_findings, (SELECT count(*) FROM deps) AS dependencies,
  (SELECT count(*) FROM deps WHERE status IN ('DENY', 'UNKNOWN')) AS risky_dependencies""")

# --- Evidence -------------------------------------------------------------------------------------------------------


def tree_digest(digests: str) -> str:
    """Scalar subquery: root of the three-level digest tree over a subquery with one `digest` column."""
    return f"""(SELECT sha256(coalesce(string_agg(entry, '' ORDER BY entry), '')) FROM (
      SELECT left(entry, 2) || ':' || sha256(string_agg(entry, '' ORDER BY entry)) AS entry FROM (
        SELECT left(entry, 5) || ':' || sha256(string_agg(entry, '' ORDER BY entry)) AS entry FROM (
          SELECT digest || ':' || count(*) AS entry FROM ({digests}) GROUP BY digest)
        GROUP BY left(entry, 5))
      GROUP BY left(entry, 2)))"""


def rows_digest(table: str, columns: str) -> str:
    cells = ", ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), '')" for c in columns.split(","))
    return tree_digest(f"SELECT sha256(concat_ws(chr(1), {cells})) AS digest FROM {table}")


put("inputs_hash", DOCUMENTS, "SELECT sha256(string_agg(content_hash, '' ORDER BY content_hash)) AS inputs_hash FROM doc_artifacts")
put("inputs_hash_tree", DOCUMENTS, f"SELECT {tree_digest('SELECT content_hash AS digest FROM doc_artifacts')} AS inputs_hash_tree")
OUTPUTS = f"""sha256(
  {rows_digest('findings', 'artifact_id, finding_type, severity, rule_id, description, location, evidence_snippet, '
               'remediation_guidance, cwe_mapping')} ||
  {rows_digest('dep_report', 'name, version_spec, source_file, status, risk_notes')} ||
  {rows_digest('gate_rows', 'gate_ord, gate_type, tools, required_checks, failure_action, owner_role, evidence_required')} ||
  {rows_digest('summary_rows', 'section, ord, key, value')})"""
OUTPUT_TABLES = f"{F_ALL}{FLAGS}{SUMMARY}, gate_rows AS ({gates_sql('flags')})"
put("outputs_hash", OUTPUT_TABLES, f"SELECT {OUTPUTS} AS outputs_hash")
put("evidence_manifest", f"""{OUTPUT_TABLES}, header AS (SELECT {OUTPUTS} AS outputs_hash,
  {tree_digest('SELECT content_hash AS digest FROM artifacts')} AS inputs_hash_tree)""",
    """SELECT sha256(inputs_hash_tree || outputs_hash) AS run_id, 'InnovateTech DevSecOps' AS team_or_user,
  '1.0.0-alpha' AS app_version, inputs_hash_tree, outputs_hash FROM header""")
put("evidence_manifest_artifacts", F_ALL, "SELECT artifact_id, filename, content_hash FROM artifacts")
put("package_size", f"{CODE},{DEPS}{AUDITED},{DOCUMENTS}", """SELECT n AS total_bytes,
  CASE WHEN n >= 1048576 THEN printf('%.2f MB', n / 1048576) ELSE printf('%.2f KB', n / 1024) END AS size_text
  FROM (SELECT CAST(sum(octet_length(encode(content))) AS BIGINT) AS n FROM
    (SELECT content FROM audited UNION ALL SELECT content FROM doc_artifacts))""")

ORACLE["stream_secret_findings"] = ORACLE["secret_findings_documents"]

LATEST = f"""
docs AS (SELECT doc_id AS artifact_seq, 'a' || doc_id // 4 || '.md' AS filename, source, text AS content FROM documents
  WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id // 4 ORDER BY doc_id % 4 DESC) = 1),
doc_artifacts AS (SELECT *, 'python' AS language, sha256(content) AS content_hash, {ARTIFACT_ID} AS artifact_id FROM docs)"""
put("stream_latest_scores", f"{doc_rows_sql(LATEST)},{line_rules_sql(CORE, 'doc_rows', 'findings')}",
    f"""SELECT 'a' || a.artifact_seq // 4 AS artifact_key, a.artifact_seq % 4 AS version, count(f.rule_id) AS finding_count,
  CAST(coalesce(sum({WEIGHT}), 0) AS BIGINT) AS risk_score FROM doc_artifacts a LEFT JOIN findings f USING (artifact_id) GROUP BY a.artifact_seq""")


def proofs_sql(lengths=(6, 5, 4, 3, 2, 1, 0)) -> str:
    """Roots of the sixteen-fold tree and, per hash, how many entries share its groups."""
    ctes = ["e0 AS (SELECT content_hash || ':' || count(*) AS entry FROM doc_artifacts GROUP BY content_hash)"]
    for i, n in enumerate(lengths):
        ctes.append(f"g{i} AS (SELECT left(entry, {n}) AS prefix, count(*) - 1 AS others, sha256(string_agg(entry, '' ORDER BY entry)) AS node FROM e{i} GROUP BY 1)")
        ctes.append(f"e{i + 1} AS (SELECT prefix || ':' || node AS entry FROM g{i})")
    last = len(lengths) - 1
    joins = " ".join(f"JOIN g{i} ON g{i}.prefix = left(content_hash, {n})" for i, n in enumerate(lengths))
    others = " + ".join(f"g{i}.others" for i in range(len(lengths)))
    return f"""{', '.join(ctes)}
SELECT artifact_id, content_hash, count(*) OVER (PARTITION BY content_hash) AS copies, g{last}.node AS root, {others} AS n_siblings,
  true AS proven, false AS other_proven FROM doc_artifacts {joins}"""


ORACLE["artifact_proofs"] = f"WITH {DOCUMENTS.strip()}, {proofs_sql()}"
put("package_round_trip", f"""{OUTPUT_TABLES}, sizes AS (
  SELECT 'artifacts' AS dataset, count(*) AS n_rows FROM artifacts UNION ALL SELECT 'findings', count(*) FROM findings
  UNION ALL SELECT 'dependencies', count(*) FROM deps UNION ALL SELECT 'gate_plan', count(*) FROM gate_rows
  UNION ALL SELECT 'executive_summary', count(*) FROM summary_rows
  UNION ALL SELECT 'scan_errors', count(*) FROM code_artifacts WHERE user_id % 17 = 0
  UNION ALL SELECT 'out_of_domain', 0 UNION ALL SELECT '_manifest/header', 1
  UNION ALL SELECT '_manifest/artifacts', count(*) FROM artifacts)""",
    f"SELECT dataset, n_rows, true AS valid, {OUTPUTS} AS outputs_hash FROM sizes")
