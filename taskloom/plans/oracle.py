"""The queries of the catalog in the SQL of DuckDB, for comparison."""

from __future__ import annotations

from ..functions import codegen, fixed, minhash
from ..sources.projects import CAPACITIES

_ACTS = """acts AS (
  SELECT l_orderkey AS project, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INTEGER) AS id,
         CAST(floor(l_quantity) AS INTEGER) AS duration, 'R' || CAST(l_suppkey % 4 + 1 AS VARCHAR) AS resource, CAST(l_linenumber % 3 AS INTEGER) AS demand, CAST(l_partkey % 5 AS INTEGER) AS lag FROM lineitem),
sizes AS (SELECT project, CAST(count(*) AS INTEGER) AS n FROM acts GROUP BY 1),
edges AS (SELECT a.project, a.id AS i, a.id + 2 AS j, CASE a.id % 4 WHEN 0 THEN 'SS' WHEN 2 THEN 'FF' ELSE 'FS' END AS relation, a.lag AS lag_min, CASE WHEN a.id % 3 = 0 THEN a.lag + a.demand * 3 - 1 END AS lag_max,
                 a.duration AS di, b.duration AS dj FROM acts a JOIN acts b ON a.project = b.project AND b.id = a.id + 2)"""
_CAPS = "caps(resource, capacity) AS (VALUES ('R1', 4), ('R2', 3), ('R3', 2), ('R4', 5))"
_METRICS = f"""{_ACTS}, {_CAPS},
used AS (SELECT project, sum(CASE WHEN demand > 0 THEN 1 ELSE 0 END) AS used FROM acts GROUP BY 1),
loads AS (SELECT s.project, c.resource, s.n, c.capacity, sum(CASE WHEN a.resource = c.resource THEN a.demand ELSE 0 END) AS load FROM sizes s CROSS JOIN caps c JOIN acts a ON a.project = s.project GROUP BY ALL),
strength AS (SELECT project, min(CASE WHEN load > 0 THEN least(1.0, CAST(capacity AS DOUBLE) / (CAST(load AS DOUBLE) / n)) ELSE 1.0 END) AS rs FROM loads GROUP BY 1),
links AS (SELECT project, count(*) AS e FROM edges GROUP BY 1),
m AS (SELECT s.project, s.n, CAST(u.used AS DOUBLE) / (s.n * 4) AS rf, t.rs, CASE WHEN s.n < 2 THEN 0.0 ELSE coalesce(l.e, 0) / (s.n * (s.n - 1) / 2.0) END AS density
      FROM sizes s JOIN used u USING (project) JOIN strength t USING (project) LEFT JOIN links l USING (project)),
d AS (SELECT *, CASE WHEN rf <= 0.4 AND rs >= 0.6 THEN 'easy' WHEN rf >= 0.65 AND rs <= 0.35 THEN 'hard' ELSE 'medium' END AS difficulty FROM m),
paths AS (SELECT project, max(total) AS cp FROM (SELECT project, id % 2 AS chain, sum(duration) AS total FROM acts GROUP BY ALL) GROUP BY 1)"""
_WORDS = r"words AS (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS w FROM documents)"
_GATE0 = (
    r"""CASE WHEN len(w) = 0 THEN 'no words' WHEN len(w) < 50 THEN len(w) || ' words, at least 50 are needed' WHEN len(w) > 1500 THEN len(w) || ' words, at most 1500 are allowed'
    WHEN NOT contains(lower(text), 'context:') THEN 'no section context:' WHEN NOT contains(lower(text), 'resources:') THEN 'no section resources:'
    WHEN NOT contains(lower(text), 'tasks:') THEN 'no section tasks:' WHEN NOT contains(lower(text), 'disruption:') THEN 'no section disruption:'
    WHEN len(regexp_extract_all(text, '\b[tT]\d+\b')) < 2 THEN 'names ' || len(regexp_extract_all(text, '\b[tT]\d+\b')) || ' tasks, at least 2 are needed'
    WHEN NOT regexp_matches(text, '(?i)\b(?:R\d+|M\d+|NR\d+)\b|(?:Team-\w+|NR-\w+)') THEN 'names no resource'
    WHEN part_words < 10 THEN part_words || ' words on the disruption, at least 10 are needed' WHEN kind = 'TYPE-B' AND NOT contains(text, '-M') THEN 'names no mode of a task' END"""
)
_GATE0_PARTS = r"len(list_filter(regexp_split_to_array(lower(regexp_extract(text, '(?is)disruption:(.*?)(?:\n\n|\z)', 1)), '\s+'), lambda w: w <> '')) AS part_words"
_DRESSED = r"""dressed AS (SELECT doc_id, CASE WHEN doc_id % 11 = 3 THEN 'TYPE-B' ELSE 'TYPE-A' END AS kind,
  CASE WHEN doc_id % 11 <> 1 THEN 'CONTEXT: ' ELSE '' END || coalesce(text, '') || chr(10) || chr(10) || CASE WHEN doc_id % 11 <> 2 THEN 'RESOURCES: ' ELSE '' END || CASE WHEN doc_id % 11 <> 4 THEN 'R1(cap=4)' ELSE '' END || chr(10) || chr(10)
  || CASE WHEN doc_id % 11 <> 5 THEN 'TASKS: ' ELSE '' END || CASE doc_id % 11 WHEN 6 THEN 'T1' WHEN 7 THEN 'T1-M1, T2-M1' ELSE 'T1, T2' END || chr(10) || chr(10)
  || CASE WHEN doc_id % 11 = 8 THEN '' ELSE 'DISRUPTION: ' END || repeat('stop ', CAST(CASE WHEN doc_id % 11 = 9 THEN doc_id % 10 ELSE 12 END AS INTEGER)) AS text FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '') AS w, """ + _GATE0_PARTS + " FROM dressed)"  # fmt: skip
_WORDS_G0 = _WORDS.replace("SELECT doc_id, text,", "SELECT doc_id, text, 'TYPE-A' AS kind, " + _GATE0_PARTS + ",")
_SHINGLES = f"""{_WORDS}, grams AS (SELECT doc_id, md5(array_to_string(w[k:k + 2], ' ')) AS h FROM words, unnest(range(1, greatest(2, len(w) - 1))) AS t(k)),
shingles AS (SELECT DISTINCT doc_id, CAST(('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2)) AS BIGINT) AS s FROM grams)"""
_A, _B = minhash.coefficients()
_COEF = "coef(k, a, b) AS (VALUES " + ", ".join(f"({k}, {a}::HUGEINT, {b}::HUGEINT)" for k, (a, b) in enumerate(zip(_A, _B))) + ")"
_SIGNED = f"""{_SHINGLES}, {_COEF}, positions AS (SELECT doc_id, k, min((a * s + b) % {fixed.PRIME}) AS v FROM shingles CROSS JOIN coef GROUP BY ALL)"""
_BANDED = f"""{_SIGNED}, banded AS (SELECT doc_id, k // 8 AS band, md5('[' || string_agg(CAST(v AS VARCHAR), ', ' ORDER BY k) || ']') AS bucket FROM positions GROUP BY ALL)"""
_SPLIT = """placed AS (SELECT doc_id, (row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42'), doc_id) - 1) / CAST(count(*) OVER (PARTITION BY lang) AS DOUBLE) AS share FROM documents),
splits AS (SELECT doc_id, CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.8 THEN 'val' ELSE 'test' END AS split FROM placed)"""
_SEVERITY = f"""{_METRICS}, heads AS (SELECT a.project, a.resource, c.capacity, CAST(p.cp AS INTEGER) AS cp, ['minor', 'moderate', 'major', 'critical'][a.project % 4 + 1] AS severity, CAST('0x' || substr(md5(CAST(a.project AS VARCHAR)), 1, 8) AS BIGINT) AS draw
  FROM acts a JOIN caps c USING (resource) JOIN paths p USING (project) WHERE a.id = 1),
numbers AS (SELECT *, CASE severity WHEN 'minor' THEN 1 WHEN 'moderate' THEN 2 WHEN 'major' THEN greatest(1, capacity // 2) ELSE greatest(1, CAST(floor(capacity * 0.9) AS INTEGER)) END AS delta,
  greatest(1, cp // (CASE severity WHEN 'minor' THEN 8 WHEN 'moderate' THEN 5 WHEN 'major' THEN 3 ELSE 2 END)) AS length, 2 * cp // 5 + draw % (3 * cp // 5 - 2 * cp // 5 + 1) AS t_start FROM heads)"""


def _quoted(text: str) -> str:
    """text as a SQL literal."""
    return "'" + text.replace("'", "''") + "'"


def _kinds() -> str:
    """The four resources of the projects made of orders as JSON, a SQL literal."""
    return _quoted(",".join(f'{{"id":"{k}","capacity":{v},"downtime":[]}}' for k, v in CAPACITIES.items()))


_PARTS = """m AS (SELECT l_partkey AS project, CAST(l_linenumber AS INTEGER) AS id, CAST(row_number() OVER (PARTITION BY l_partkey, l_linenumber ORDER BY l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS INTEGER) AS mode_id,
    CAST(floor(l_quantity) AS INTEGER) AS duration, CAST(l_suppkey % 3 AS INTEGER) AS r1, CAST(l_orderkey % 4 AS INTEGER) AS nr1 FROM lineitem),
  a AS (SELECT project, id, count(*) AS n, min(nr1) AS least, min(nr1) FILTER (mode_id > 1) AS rest, min(duration) FILTER (mode_id = 1) AS d1 FROM m GROUP BY 1, 2),
  p AS (SELECT project, min(id) AS first, sum(least) AS budget, sum(n) AS n_modes FROM a GROUP BY 1),
  f AS (SELECT p.*, a.n, a.d1, p.budget - a.least + coalesce(a.rest, 0) AS without FROM p JOIN a ON a.project = p.project AND a.id = p.first)"""
_RING = """n AS (SELECT l_orderkey AS project, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS id, CAST(floor(l_quantity) AS INTEGER) AS d,
    l_partkey % 5 AS lag, count(*) OVER (PARTITION BY l_orderkey) AS size FROM lineitem),
  e AS (SELECT a.project, a.id AS i, b.id AS j, ['FS', 'SS', 'FF', 'SF'][a.id % 4 + 1] AS relation, CASE WHEN a.id = a.size THEN -(a.project % 7) * 20 ELSE a.lag END AS lo, a.d AS di, b.d AS dj
        FROM n a JOIN n b ON a.project = b.project AND b.id = a.id % a.size + 1 WHERE a.size >= 3),
  w AS (SELECT project, i, j, CASE relation WHEN 'FS' THEN di + lo WHEN 'SS' THEN lo WHEN 'FF' THEN di - dj + lo ELSE lo - dj END AS weight FROM e)"""

ORACLE_SQL = {
    "gate0_rules": f"WITH {_DRESSED} SELECT doc_id, {_GATE0} AS reason FROM words",
    "mutations_multi": f"""WITH {_PARTS}, r AS (SELECT *, CASE project % 5 WHEN 0 THEN CASE WHEN d1 + project % 7 - 3 <= 0 THEN '#0: duration must stay positive' END
          WHEN 1 THEN CASE WHEN n = 1 THEN '#0: no mode would be left' WHEN without > 30 THEN '#0: budget NR1 cannot cover the modes that are left' END
          WHEN 2 THEN CASE WHEN project % 4 = 0 THEN 'mutation failed: a mode needs a positive duration and no negative demands' END
          WHEN 3 THEN CASE WHEN project % 33 NOT BETWEEN 1 AND 29 THEN '#0: the cut must be positive and smaller than the budget' WHEN budget > 30 - project % 33 THEN '#0: the rest of the budget cannot cover the least demand' END
          ELSE CASE WHEN project % 2 = 1 THEN 'mutation failed: weighted tardiness needs weights and deadlines' END END AS reason FROM f)
        SELECT project, ['alter_mode_profile', 'restrict_modes', 'add_mode', 'reduce_nonrenewable_budget', 'alter_objective'][project % 5 + 1] AS op, reason,
          CAST(CASE WHEN reason IS NULL THEN CASE project % 5 WHEN 0 THEN d1 + project % 7 - 3 WHEN 1 THEN n_modes - 1 WHEN 2 THEN n_modes + 1 WHEN 3 THEN 30 - project % 33 ELSE 1 END END AS BIGINT) AS measure FROM r""",
    "mutations_single": f"""WITH {_ACTS}, e AS (SELECT project, count(*) AS n_edges, sum(lag_min) AS lags, bool_or(coalesce(lag_max < lag_min, false)) AS cycle, max(CASE WHEN i = 1 THEN lag_min END) AS first_lag FROM edges GROUP BY 1),
        d AS (SELECT project, sum(duration) AS days, bool_or(resource = 'R2' AND demand > 0) AS r2 FROM acts GROUP BY 1),
        r AS (SELECT s.project, s.n, coalesce(n_edges, 0) AS n_edges, coalesce(lags, 0) AS lags, coalesce(cycle, false) AS cycle, first_lag, days, r2 FROM sizes s JOIN d USING (project) LEFT JOIN e USING (project)),
        why AS (SELECT *, CASE WHEN project % 5 = 0 AND project % 6 = 0 THEN '#0: delta must be > 0' WHEN project % 5 = 0 AND project % 6 >= 4 THEN '#0: delta >= capacity; freeze_resource is for a full shutdown' WHEN project % 5 = 0 AND project % 7 = 0 THEN '#0: t_start >= t_end'
          WHEN project % 5 = 2 AND n < 3 THEN '#0: unknown activity 3' WHEN project % 5 = 3 AND n < 2 THEN '#0: unknown activity 2' WHEN cycle THEN 'temporal constraints form a positive cycle'
          WHEN project % 5 = 1 AND r2 AND project % 150 + 1 >= days + lags THEN 'R2 is shut for the whole horizon' END AS reason FROM r)
        SELECT project, ['reduce_capacity', 'freeze_resource', 'enforce_time_lag', 'add_precedence', 'alter_objective'][project % 5 + 1] AS op, reason,
          CAST(CASE WHEN reason IS NULL THEN CASE project % 5 WHEN 0 THEN (project % 6) * (project % 7) WHEN 1 THEN 3 * (project % 150 + 1) WHEN 2 THEN lags - first_lag + greatest(first_lag, project % 9) WHEN 3 THEN n_edges + 1 ELSE 1 END END AS BIGINT) AS measure FROM why""",
    "ring_cycles": f"""WITH RECURSIVE {_RING}, walks(project, origin, node, length, steps) AS (SELECT project, i, j, weight, 1 FROM w UNION SELECT k.project, k.origin, w.j, k.length + w.weight, k.steps + 1 FROM walks k JOIN w ON w.project = k.project AND w.i = k.node WHERE k.steps < 30)
        SELECT DISTINCT n.project, coalesce(b.bad, false) AS infeasible FROM n LEFT JOIN (SELECT project, bool_or(node = origin AND length > 0) AS bad FROM walks GROUP BY 1) b USING (project)""",
    "branching_paths": f"""WITH RECURSIVE {_ACTS}, b AS (SELECT a.project, a.id AS i, c.id AS j, c.duration AS d FROM acts a JOIN acts c ON a.project = c.project AND (c.id = a.id + 2 OR (a.id % 3 <> 0 AND c.id = a.id + 1) OR (a.id = 1 AND c.id = a.id + 5))),
        paths(project, node, length) AS (SELECT project, id, duration FROM acts UNION SELECT p.project, b.j, p.length + b.d FROM paths p JOIN b ON b.project = p.project AND b.i = p.node)
        SELECT project, CAST(max(length) AS BIGINT) AS length FROM paths GROUP BY 1""",
    "gate6_evidence": r"""WITH t AS (SELECT doc_id, doc_id % 8 AS v, 'r1 ' || repeat('w ', CAST(doc_id % 14 AS INTEGER)) || 'offline' AS near FROM documents)
        SELECT doc_id, CASE v WHEN 0 THEN CASE WHEN NOT regexp_matches(near, 'r1\s+(?:\S+\s+){0,10}offline') THEN 'the text does not tell of downtime R1' END WHEN 1 THEN CASE WHEN NOT regexp_matches(near, 'r1\s+(?:\S+\s+){0,10}offline') THEN 'the text does not tell of downtime R1' END
          WHEN 3 THEN 'the text does not tell of time_lag 1 2 FS' WHEN 4 THEN 'the text stops r2, the model does not' WHEN 6 THEN 'the text does not tell of objective_change minimize_weighted_tardiness' WHEN 7 THEN 'the text has no section on the disruption' END AS reason FROM t""",
    "gate0_prefilter": f"WITH {_WORDS_G0} SELECT doc_id, {_GATE0} AS reason FROM words",
    "gate0_report": f"WITH {_WORDS_G0} SELECT regexp_replace(coalesce({_GATE0}, 'pass'), '\\d+ words, ', '', 'g') AS reason, count(*) AS n FROM words GROUP BY 1",
    "project_metrics": f"WITH {_METRICS} SELECT project, round(rf, 9) AS rf, round(rs, 9) AS rs, round(density, 9) AS density, difficulty FROM d",
    "structural_hash": f"WITH {_ACTS}, e AS (SELECT project, string_agg('[' || i || ', ' || j || ']', ', ' ORDER BY i, j) AS t FROM edges GROUP BY 1) SELECT s.project, substr(sha256('[' || coalesce(t, '') || ']'), 1, 16) AS structural_hash FROM sizes s LEFT JOIN e USING (project)",
    "difficulty_hist": f"WITH {_METRICS} SELECT difficulty, count(*) AS n FROM d GROUP BY 1",
    "critical_path": f"WITH {_METRICS} SELECT project, CAST(cp AS BIGINT) AS critical_path_length FROM paths",
    "horizon": f"WITH {_ACTS}, e AS (SELECT project, sum(lag_min) AS lags FROM edges GROUP BY 1), d AS (SELECT project, sum(duration) AS days FROM acts GROUP BY 1) SELECT project, CAST(days + coalesce(lags, 0) AS BIGINT) AS horizon FROM d LEFT JOIN e USING (project)",
    "distance_edges": f"""WITH {_ACTS} SELECT project, i AS source, j AS target, CASE relation WHEN 'FS' THEN di + lag_min WHEN 'SS' THEN lag_min ELSE di - dj + lag_min END AS weight FROM edges
        UNION ALL SELECT project, j, i, CASE relation WHEN 'FS' THEN -(di + lag_max) WHEN 'SS' THEN -lag_max ELSE dj - di - lag_max END FROM edges WHERE lag_max IS NOT NULL""",
    "cycle_flags": f"WITH {_ACTS} SELECT s.project, coalesce(bool_or(e.lag_max < e.lag_min), false) AS infeasible FROM sizes s LEFT JOIN edges e USING (project) GROUP BY 1",
    "structure_text": f"""WITH {_ACTS}, t AS (SELECT project, string_agg('  T' || id || ':' || duration || 'h(' || CASE WHEN resource = 'R1' THEN demand ELSE 0 END || ',' || CASE WHEN resource = 'R2' THEN demand ELSE 0 END || ',' || CASE WHEN resource = 'R3' THEN demand ELSE 0 END || ',' || CASE WHEN resource = 'R4' THEN demand ELSE 0 END || ')', chr(10) ORDER BY id) AS tasks FROM acts GROUP BY 1),
        e AS (SELECT project, string_agg('  T' || i || '-[' || relation || ',' || lag_min || coalesce(',max' || lag_max, '') || ']->T' || j, chr(10) ORDER BY i) AS links FROM edges GROUP BY 1)
        SELECT project, concat_ws(chr(10), 'RESOURCES:', '  R1(renewable,cap=4)', '  R2(renewable,cap=3)', '  R3(renewable,cap=2)', '  R4(renewable,cap=5)', '', 'TASKS:', '  (id, dur, R1, R2, R3, R4):', tasks, '  Precedences:', links) AS body FROM t LEFT JOIN e USING (project)""",
    "graph_summary": f"""WITH {_METRICS} SELECT project, concat_ws(chr(10), 'instance_id: o' || project, 'constraint_type: TYPE-C', 'activities: ' || n, 'renewable resources: R1(cap=4), R2(cap=3), R3(cap=2), R4(cap=5)', 'critical_path_length: ' || CAST(cp AS INTEGER),
        'network_density: ' || printf('%.2f', round(density + 1e-9, 2)), 'RF: ' || printf('%.2f', round(rf + 1e-9, 2)) || '   RS: ' || printf('%.2f', round(rs + 1e-9, 2)), 'difficulty: ' || difficulty) AS body FROM d JOIN paths USING (project)""",
    "generated_program": f"""WITH {_ACTS}, t AS (SELECT project, sum(duration) AS days, string_agg('{{"id":' || id || ',"duration":' || duration || ',"demands":{{"' || resource || '":' || demand || '}}}}', ',' ORDER BY id) AS tasks FROM acts GROUP BY 1),
        e AS (SELECT project, sum(lag_min) AS lags, string_agg('{{"i":' || i || ',"j":' || j || ',"relation":"' || relation || '","lag_min":' || lag_min || coalesce(',"lag_max":' || lag_max, '') || '}}', ',' ORDER BY i) AS links FROM edges GROUP BY 1)
        SELECT project, concat_ws(chr(10), {_quoted(codegen.IMPORTS)},
          '# 2. data' || chr(10) || 'DATA = json.loads(''{{"constraint_type":"TYPE-C","activities":[' || tasks || '],"resources":[' || {_kinds()} || '],"precedences":[' || coalesce(links, '') || '],"objective":{{"type":"minimize_makespan"}}}}'')' || chr(10),
          '# 3. model' || chr(10) || 'HORIZON = ' || CAST(days + coalesce(lags, 0) AS BIGINT) || chr(10) || 'model = cp_model.CpModel()' || chr(10),
          {", ".join(_quoted(x) for x in (codegen.VARIABLES_SINGLE, codegen.RESOURCES_SINGLE, codegen.PRECEDENCES, codegen.OBJECTIVE, codegen.SOLVE, codegen.OUTPUT))}) AS c FROM t LEFT JOIN e USING (project)""",
    "code_syntax": "SELECT DISTINCT l_orderkey AS project, l_orderkey % 3 <> 0 AS compiles FROM lineitem",
    "gate1_structural": f"WITH {_ACTS} SELECT project, CASE WHEN bool_or(duration <= 0) THEN 'a duration is not positive' ELSE 'no mutations applied' END AS reason FROM acts GROUP BY 1",
    "severity_numbers": f"WITH {_SEVERITY} SELECT project, resource, severity, CAST(delta AS INTEGER) AS delta, CAST(length AS INTEGER) AS length, CAST(t_start AS INTEGER) AS t_start FROM numbers",
    "mutation_apply": f"""WITH {_SEVERITY}, bad AS (SELECT project, bool_or(lag_max < lag_min) AS cycle FROM edges GROUP BY 1), r AS (SELECT n.project, CASE WHEN n.delta >= n.capacity THEN '#0: delta >= capacity; freeze_resource is for a full shutdown' WHEN coalesce(b.cycle, false) THEN 'temporal constraints form a positive cycle' END AS reason FROM numbers n LEFT JOIN bad b USING (project))
        SELECT project, reason, CASE WHEN reason IS NULL THEN 1 END AS n_windows, CASE WHEN reason IS NULL THEN 1 END AS n_mutations FROM r""",
    "shingle_counts": f"WITH {_SHINGLES} SELECT doc_id, count(*) AS n_shingles FROM shingles GROUP BY 1",
    "minhash_signature": f"WITH {_SHINGLES} SELECT doc_id, " + ", ".join(f"CAST(min(({_A[k]}::HUGEINT * s + {_B[k]}) % {fixed.PRIME}) AS BIGINT) AS p{k}" for k in range(4)) + " FROM shingles GROUP BY 1",
    "minhash_bands": f"WITH {_BANDED} SELECT doc_id, CAST(band AS INTEGER) AS band, bucket FROM banded",
    "lsh_pairs": f"""WITH {_BANDED}, whole AS (SELECT doc_id, string_agg(bucket, '' ORDER BY band) AS s FROM banded GROUP BY 1), firsts AS (SELECT min(doc_id) AS doc_id FROM whole GROUP BY s),
        met AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM banded x JOIN banded y ON x.band = y.band AND x.bucket = y.bucket AND x.doc_id < y.doc_id WHERE x.doc_id IN (FROM firsts) AND y.doc_id IN (FROM firsts)),
        agree AS (SELECT a, b, count(*) AS same FROM met JOIN positions p ON p.doc_id = a JOIN positions q ON q.doc_id = b AND q.k = p.k AND q.v = p.v GROUP BY ALL)
        SELECT a, b, CAST(same AS INTEGER) AS same FROM agree WHERE same >= {fixed.SAME_LEAST}""",
    "exact_keys": f"""WITH {_ACTS} SELECT project, substr(sha256('o' || project || '::[["reduce_capacity", "' || resource || '", "", "", ""]]'), 1, 16) AS key FROM acts WHERE id = 1""",
    "quota_hold": "SELECT doc_id, lang || '::' || source AS cell, count(*) OVER w AS n_before, count(*) OVER w >= 20 AS held FROM documents WINDOW w AS (PARTITION BY lang, source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)",
    "split_leaks": "SELECT n_splits, count(*) AS n FROM (SELECT l_partkey, count(DISTINCT l_orderkey % 10 < 7) AS n_splits FROM lineitem GROUP BY 1) GROUP BY 1",
    "stratified_split": f"WITH {_SPLIT} SELECT doc_id, split FROM splits",
    "split_counts": f"WITH {_SPLIT} SELECT split, count(*) AS n FROM splits GROUP BY 1",
    "expansion": f"""WITH {_SPLIT}, e AS (SELECT doc_id, split, CAST(k AS INTEGER) AS expansion FROM splits, unnest(range(1, CASE WHEN split = 'train' THEN 4 ELSE 2 END)) AS t(k)),
        r AS (SELECT *, CAST('0x' || substr(md5(concat_ws(':', CAST(doc_id AS VARCHAR), CAST(expansion AS VARCHAR), '42')), 1, 8) AS BIGINT) % 100 AS draw FROM e)
        SELECT doc_id, split, expansion, CASE WHEN draw < 50 THEN 'optimization' WHEN draw < 75 THEN 'feasibility' ELSE 'rescheduling' END AS question_type FROM r""",
    "mode_requests": f"WITH {_ACTS} SELECT project, resource, CAST(count(*) AS INTEGER) AS n_modes, min(duration) AS least_duration, arg_min(duration, id) AS first_duration FROM acts GROUP BY ALL",
    "gap_loss_weight": """WITH g AS (SELECT l_orderkey, l_partkey, l_linenumber, l_returnflag, CASE WHEN l_returnflag = 'N' OR l_extendedprice = 0 THEN 0.0 ELSE abs(l_extendedprice - l_extendedprice * (1 - l_discount)) / greatest(abs(l_extendedprice), 1e-9) END AS gap FROM lineitem),
        f AS (SELECT *, l_returnflag <> 'N' AND gap > 0.05 AS approx FROM g)
        SELECT l_orderkey, l_partkey, l_linenumber, round(gap, 6) AS gap, approx, round(CASE WHEN approx THEN 0.3 ELSE greatest(0.5, least(1.0, 1 - gap / 0.15 * 0.5)) END, 6) AS loss_weight FROM f""",
    "first_failure": f"""WITH {_ACTS}, r AS (SELECT project, id, CASE WHEN demand = 0 THEN 'no demand' WHEN duration > 40 THEN 'too long' END AS reason FROM acts)
        SELECT project, min(id) AS first_id, arg_min(reason, id) AS reason FROM r WHERE reason IS NOT NULL GROUP BY 1""",
    "resource_join": f"""WITH {_ACTS}, k(rid, capacity) AS (VALUES ('R1', 4), ('R2', 3), ('R3', 2)) SELECT resource, count(*) AS n, count(rid) AS n_known, CAST(sum(CASE WHEN demand > capacity THEN 1 ELSE 0 END) AS BIGINT) AS n_over FROM acts LEFT JOIN k ON resource = rid GROUP BY 1""",
    "batch_stats": """SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS accepted, count(*) FILTER (o_orderstatus = 'O') AS rejected, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 4) AS acceptance_rate,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS cost FROM orders GROUP BY 1""",
    "call_costs": """WITH w AS (SELECT conv_id, role, len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS n FROM conversations),
        c AS (SELECT conv_id, CAST(sum(CASE WHEN role = 'user' THEN n ELSE 0 END) AS BIGINT) AS tokens_in, CAST(sum(CASE WHEN role = 'assistant' THEN n ELSE 0 END) AS BIGINT) AS tokens_out FROM w GROUP BY 1)
        SELECT *, round((tokens_in * CAST(0.0025 AS DOUBLE) + tokens_out * CAST(0.01 AS DOUBLE)) / 1000, 8) AS cost FROM c""",
    "quota_caps": """WITH o AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'easy' WHEN 'O' THEN 'medium' ELSE 'hard' END AS level FROM orders),
        h AS (SELECT *, count(*) OVER (PARTITION BY o_orderpriority, level ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= CASE level WHEN 'easy' THEN 300 WHEN 'medium' THEN 500 ELSE 200 END AS held FROM o)
        SELECT o_orderpriority, level, count(*) AS n, count(*) FILTER (held) AS n_held FROM h GROUP BY ALL""",
}
