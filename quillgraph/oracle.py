"""Standard SQL with the same results as the registered queries, for checking them on another engine."""

from __future__ import annotations

from .functions.codes import CHAPTER_BOUNDS
from .registry import (
    CONCEPT_NAMES,
    DOC_DISTANCE,
    ITEM_DISTANCE,
    ITEM_PROBES,
    ITEM_RULE,
    SWEEP,
    TABLES,
    TITLE_DISTANCE,
    TITLE_RULE,
)

# --- shared pieces --------------------------------------------------------------------------------------------------

_ITEM_NAME = "concat_ws(' ', p_name, p_brand, p_type, p_size::varchar)"


def _token_set(text: str) -> str:
    # The upper case of ß is SS here, as in Java and Python; upper() of some engines gives a capital ß instead.
    return (
        f"list_sort(list_distinct(list_filter(regexp_split_to_array(upper(replace(trim(coalesce({text}, '')), 'ß', 'ss')), '\\s+'), "
        "lambda w: w <> '')))"
    )


def _md5_number(text: str, digits: int = 15) -> str:
    return f"('0x' || substr(md5({text}), 1, {digits}))::bigint"


_ITEMS = f"""items AS (
  SELECT name, min(p_partkey) AS id, arg_min(p_brand, p_partkey) AS code, arg_min(p_type, p_partkey) AS kind
  FROM (SELECT *, {_ITEM_NAME} AS name FROM part) GROUP BY name),
item_sets AS (
  SELECT min(id) AS id, tokens, len(tokens) AS n FROM (SELECT id, {_token_set('name')} AS tokens FROM items) GROUP BY tokens)"""

_DOC_SETS = f"""doc_tokens AS (SELECT doc_id AS id, {_token_set('text')} AS tokens FROM documents),
doc_sets AS (SELECT min(id) AS id, tokens, len(tokens) AS n FROM doc_tokens WHERE len(tokens) > 0 GROUP BY tokens)"""


def _similar(sets: str, distance: float) -> str:
    return f"""alike AS (
  SELECT id_a, id_b, 1.0::double - shared::double / (na + nb - shared) AS jaccard_dist FROM (
    SELECT a.id AS id_a, b.id AS id_b, a.n AS na, b.n AS nb, count(*) AS shared
    FROM (SELECT id, n, unnest(tokens) AS t FROM {sets}) a JOIN (SELECT id, n, unnest(tokens) AS t FROM {sets}) b
      ON a.t = b.t AND a.id < b.id AND least(a.n, b.n) >= {1 - distance - 1e-9} * greatest(a.n, b.n)
    GROUP BY ALL)
  WHERE 1.0::double - shared::double / (na + nb - shared) < {distance})"""


_PAIRS = f"""{_ITEMS},
{_similar('item_sets', ITEM_DISTANCE)},
total AS (SELECT count(*) AS n FROM items),
drawn AS (
  SELECT id AS x, {_md5_number("id::varchar || '|' || d::varchar")} % (SELECT n FROM total) AS slot
  FROM items, range(1, {ITEM_PROBES + 1}) r(d)),
homes AS (SELECT id AS y, {_md5_number('id::varchar')} % (SELECT n FROM total) AS slot FROM items),
pairs AS (
  SELECT id_a, id_b FROM alike
  UNION SELECT least(x, y), greatest(x, y) FROM drawn JOIN homes USING (slot) WHERE x <> y),
named AS (
  SELECT id_a, id_b, a.name AS name_a, b.name AS name_b, a.code AS code_a, b.code AS code_b, a.kind AS kind_a, b.kind AS kind_b
  FROM pairs JOIN items a ON a.id = id_a JOIN items b ON b.id = id_b),
scored AS (
  SELECT *, jaro_winkler_similarity(upper(name_a), upper(name_b)) AS jw,
    1.0::double - levenshtein(upper(name_a), upper(name_b))::double / greatest(length(upper(name_a)), length(upper(name_b))) AS lev,
    (len(list_intersect({_token_set('name_a')}, {_token_set('name_b')}))::double
      / len(list_distinct(list_concat({_token_set('name_a')}, {_token_set('name_b')})))) AS token_overlap,
    (left(replace(code_a, '-', ''), 9) = left(replace(code_b, '-', ''), 9))::int::double AS same_code
  FROM named)"""

_TITLES = f"""titles AS (
  SELECT p_name AS name, min(p_partkey) AS id, arg_min(p_type, p_partkey) AS kind FROM part GROUP BY p_name),
title_sets AS (
  SELECT min(id) AS id, tokens, len(tokens) AS n FROM (SELECT id, {_token_set('name')} AS tokens FROM titles) GROUP BY tokens),
{_similar('title_sets', TITLE_DISTANCE)},
drawn AS (
  SELECT id AS x, {_md5_number("id::varchar || '|' || d::varchar")} % (SELECT count(*) FROM titles) AS slot
  FROM titles, range(1, {ITEM_PROBES + 1}) r(d)),
homes AS (SELECT id AS y, {_md5_number('id::varchar')} % (SELECT count(*) FROM titles) AS slot FROM titles),
pairs AS (
  SELECT id_a, id_b FROM alike
  UNION SELECT least(x, y), greatest(x, y) FROM drawn JOIN homes USING (slot) WHERE x <> y),
scored AS (
  SELECT id_a, id_b, jaro_winkler_similarity(upper(a.name), upper(b.name)) AS jw,
    1.0::double - levenshtein(upper(a.name), upper(b.name))::double / greatest(length(a.name), length(b.name)) AS lev,
    (len(list_intersect({_token_set('a.name')}, {_token_set('b.name')}))::double
      / len(list_distinct(list_concat({_token_set('a.name')}, {_token_set('b.name')})))) AS token_overlap,
    (left(a.kind, 3) = left(b.kind, 3))::int::double AS same_code
  FROM pairs JOIN titles a ON a.id = id_a JOIN titles b ON b.id = id_b)"""

_DICT = r"""dict AS (
  SELECT DISTINCT w AS name, 'W:' || w AS concept_id
  FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS w FROM benchmark)
  WHERE length(w) > 3)"""

_WORDS = r"""pieces AS (
  SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS p FROM documents)),
words AS (
  SELECT doc_id, piece, (sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) - length(piece))::bigint AS char_start
  FROM pieces)"""


def _is_word(character: str) -> str:
    return f"coalesce(regexp_full_match({character}, '[\\p{{L}}\\p{{N}}_]'), false)"


def _places(names: str, prefix: str) -> str:
    """Where names stand between word boundaries: those of one word by that word, the others by splitting the text."""
    return f"""{prefix}_odd AS (
  SELECT doc_id, name, t, unnest(p) AS part, generate_subscripts(p, 1) AS i, len(p) AS n FROM (
    SELECT doc_id, name, lower(text) AS t, string_split(lower(text), name) AS p
    FROM documents JOIN {names} ON NOT regexp_full_match(name, '[\\p{{L}}\\p{{N}}_]+') AND contains(lower(text), name))),
{prefix}_odd_at AS (
  SELECT doc_id, name, t, i, n, (sum(length(part) + length(name)) OVER (PARTITION BY doc_id, name ORDER BY i))::bigint
    - length(name) AS char_start FROM {prefix}_odd),
{prefix} AS (
  SELECT doc_id, name, char_start FROM words JOIN {names} ON piece = name
  UNION ALL SELECT doc_id, name, char_start FROM {prefix}_odd_at
  WHERE i < n AND {_is_word('left(name, 1)')} <> (char_start > 0 AND {_is_word('substr(t, char_start, 1)')})
    AND {_is_word('right(name, 1)')} <> {_is_word('substr(t, char_start + length(name) + 1, 1)')})"""


_MENTIONS = f"""{_DICT},
{_WORDS},
{_places('dict', 'places')},
mentions AS (
  SELECT doc_id AS note_id, concept_id, name, char_start, char_start + length(name) AS char_end, name AS entity_text
  FROM places JOIN dict USING (name))"""

_DX = "dx AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst FROM lineitem)"
_DXE = "dxe AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst, l_linenumber AS seq_num FROM lineitem)"
_RX = "rx AS (SELECT DISTINCT l_orderkey AS src, l_suppkey AS dst FROM lineitem)"
_BX = "bx AS (SELECT DISTINCT l_orderkey AS src, p_brand AS dst FROM lineitem JOIN part ON l_partkey = p_partkey)"


def _cooccur(pairs: str, support: int) -> str:
    return f"""co AS (
  SELECT a.dst AS code_a, b.dst AS code_b, count(*) AS co_count
  FROM {pairs} a JOIN {pairs} b ON a.src = b.src AND a.dst < b.dst GROUP BY ALL HAVING count(*) >= {support})"""


_FINGERPRINTS = "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents"

_JOIN_AGG = """SELECT o_custkey, count(l_partkey) AS total_codes, count(DISTINCT l_partkey) AS unique_codes
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey"""

_NULL_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "l_orderkey", "l_partkey",
    "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    "l_shipdate",
]

_EVENT_JSON = (
    "to_json({'event_id': event_id::varchar, 'user_id': user_id::varchar, 'event_type': event_type, "
    "'value': value::varchar, 'props': props})::varchar"
)

_NODE_COUNTS = {
    "Patient": "SELECT count(*) AS n FROM customer",
    "Admission": "SELECT count(*) AS n FROM orders",
    "Diagnosis": "SELECT count(*) AS n FROM part",
    "Procedure": "SELECT count(DISTINCT o_orderpriority) AS n FROM orders",
    "Medication": "SELECT count(DISTINCT s_suppkey) AS n FROM supplier",
    "LabTest": "SELECT count(DISTINCT event_type) AS n FROM events",
    "ClinicalNote": "SELECT count(*) AS n FROM documents",
    "Concept": "SELECT count(DISTINCT concept_id) AS n FROM mentions",
    "Caregiver": "SELECT count(*) AS n FROM nation",
}
_EDGE_COUNTS = {
    "HAS_ADMISSION": (
        "SELECT count(*) AS n FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders "
        "WHERE o_custkey IN (SELECT c_custkey FROM customer))"
    ),
    "HAS_DIAGNOSIS": "SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem)",
    "UNDERWENT": "SELECT count(*) AS n FROM (SELECT DISTINCT o_orderkey, o_orderpriority FROM orders)",
    "PRESCRIBED": "SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)",
    "HAD_LAB_RESULT": (
        "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type, event_id FROM events "
        "WHERE user_id IN (SELECT o_orderkey FROM orders))"
    ),
    "DOCUMENTED_IN": (
        "SELECT count(*) AS n FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IN (SELECT o_orderkey FROM orders))"
    ),
    "MENTIONS": "SELECT count(*) AS n FROM (SELECT DISTINCT note_id, concept_id FROM mentions)",
}
_NODE_KEYS = {
    "Patient": ("customer", "c_custkey"),
    "Admission": ("orders", "o_orderkey"),
    "Diagnosis": ("part", "p_partkey"),
    "Procedure": ("(SELECT DISTINCT o_orderpriority FROM orders)", "o_orderpriority"),
    "Medication": ("(SELECT DISTINCT s_suppkey FROM supplier)", "s_suppkey"),
    "LabTest": ("(SELECT DISTINCT event_type FROM events)", "event_type"),
    "ClinicalNote": ("documents", "doc_id"),
    "Concept": ("(SELECT DISTINCT concept_id FROM mentions)", "concept_id"),
    "Caregiver": ("nation", "n_nationkey"),
}


def _unions(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _stats() -> str:
    parts = [f"SELECT 'node' AS kind, '{k}' AS name, n FROM ({q})" for k, q in _NODE_COUNTS.items()]
    parts += [f"SELECT 'edge' AS kind, '{k}' AS name, n FROM ({q})" for k, q in _EDGE_COUNTS.items()]
    return f"WITH {_MENTIONS}\n{_unions(parts)}"


def _key_check(name: str, table: str, keys: str) -> str:
    nulls = " OR ".join(f"{k} IS NULL" for k in keys.split(", "))
    return f"""SELECT '{name}' AS check_name, duplicate_keys, null_keys, (duplicate_keys = 0 AND null_keys = 0)::int AS ok
FROM (SELECT count(*) FILTER (n > 1 AND NOT no_key) AS duplicate_keys, coalesce(sum(n) FILTER (no_key), 0)::bigint AS null_keys
      FROM (SELECT {keys}, count(*) AS n, bool_or({nulls}) AS no_key FROM {table} GROUP BY {keys}))"""


def _key_checks() -> str:
    parts = [_key_check(label, *_NODE_KEYS[label]) for label in _NODE_KEYS]
    parts.append(_key_check("line numbers", "lineitem", "l_orderkey, l_linenumber"))
    return f"WITH {_MENTIONS}\n{_unions(parts)}"


_ORPHANS = {
    "no orphan Admission": (
        "SELECT count(*) AS orphans FROM orders WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer)"
    ),
    "no orphan ClinicalNote": "SELECT count(*) AS orphans FROM documents WHERE doc_id NOT IN (SELECT o_orderkey FROM orders)",
    "no orphan Diagnosis": "SELECT count(*) AS orphans FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)",
    "no orphan Medication": (
        "SELECT count(DISTINCT s_suppkey) AS orphans FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem)"
    ),
}


def _orphan_checks() -> str:
    limits = {"no orphan ClinicalNote": 100}
    parts = [
        f"SELECT '{name}' AS check_name, orphans, (orphans < {limits.get(name, 1)})::int AS ok FROM ({q})"
        for name, q in _ORPHANS.items()
    ]
    parts.append(
        "SELECT 'no empty Admission', count(*), (count(*) = 0)::int FROM orders "
        "WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
    )
    return _unions(parts)


def _integrity() -> str:
    labels = ["Patient", "Admission", "Diagnosis", "Medication", "LabTest", "ClinicalNote", "Concept", "Caregiver"]
    types = ["HAS_ADMISSION", "HAS_DIAGNOSIS", "PRESCRIBED", "MENTIONS"]
    row = "SELECT '{}' AS check_name, ({})::int AS ok, '{}=' || {}::varchar AS detail FROM ({})"
    parts = [row.format(f"{k} nodes loaded", "n > 0", "count", "n", _NODE_COUNTS[k]) for k in labels]
    parts += [row.format(f"{k} edges exist", "n > 0", "count", "n", _EDGE_COUNTS[k]) for k in types]
    parts.append(row.format("no orphan Admission", "orphans < 1", "orphans", "orphans", _ORPHANS["no orphan Admission"]))
    parts.append(row.format("no orphan ClinicalNote", "orphans < 100", "orphans", "orphans", _ORPHANS["no orphan ClinicalNote"]))
    for k in labels:
        check = _key_check(k, *_NODE_KEYS[k])
        parts.append(f"SELECT 'unique {k}', ok, 'duplicates=' || duplicate_keys::varchar FROM ({check})")
    lonely = "SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"
    parts.append(row.format("patients have a subgraph", "n = 0", "without", "n", lonely))
    return f"WITH {_MENTIONS}\n{_unions(parts)}"


def _chapters() -> str:
    whens = " ".join(f"WHEN c < {bound} THEN '{name}'" for name, bound in CHAPTER_BOUNDS if bound)
    return f"""WITH codes AS (
  SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN left(lpad(p_partkey::varchar, greatest(4, 4), '0'), 4)
    WHEN p_type = 'SMALL' THEN ' ' || reverse(p_partkey::varchar) || ' '
    WHEN p_type = 'LARGE' THEN 'V' || p_partkey::varchar
    WHEN p_type = 'PROMO' THEN ''
    ELSE p_size::varchar || left(lpad(p_partkey::varchar, 5, '0'), 5) END AS code FROM part)
SELECT p_partkey, code, CASE WHEN code = '' THEN 'UNK' WHEN c IS NULL THEN 'OTHER' {whens} ELSE 'INJURY' END AS chapter
FROM (SELECT *, try_cast(substr(trim(code), 1, 3) AS int) AS c FROM codes)"""


def _pagerank_co(rounds: int) -> str:
    parts = [
        f"WITH {_DX}, {_cooccur('dx', 3)}",
        "e AS (SELECT code_a AS src, code_b AS dst FROM co UNION ALL SELECT code_b, code_a FROM co)",
        "d AS (SELECT src, count(*) AS deg FROM e GROUP BY src)",
        "r0 AS (SELECT src AS id, 0.15::double AS rank FROM d)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} AS (SELECT dst AS id, 0.15::double + 0.85::double * sum(rank / deg) AS rank "
            f"FROM e JOIN d USING (src) JOIN r{i - 1} ON id = src GROUP BY dst)"
        )
    return ",\n".join(parts) + f"\nSELECT id, round(rank, 9) AS rank FROM r{rounds}"


_BIPARTITE = f"""WITH {_RX},
deg AS (SELECT src, count(*) AS k FROM rx GROUP BY src),
gain AS (SELECT dst, sum(0.15::double / k) AS s FROM rx JOIN deg USING (src) GROUP BY dst),
ranks AS (
  SELECT 'A:' || o_orderkey::varchar AS id, 0.15::double AS rank FROM orders
  UNION ALL SELECT 'M:' || s_suppkey::varchar, 0.15::double + 0.85::double * coalesce(s, 0) FROM supplier LEFT JOIN gain ON dst = s_suppkey)"""

_LINKS = f"""{_MENTIONS},
links AS (
  SELECT 'Patient:' || o_custkey AS a, 'Admission:' || o_orderkey AS b FROM orders
  UNION SELECT 'Admission:' || l_orderkey, 'Diagnosis:' || l_partkey FROM lineitem
  UNION SELECT 'Admission:' || l_orderkey, 'Medication:' || l_suppkey FROM lineitem
  UNION SELECT 'Admission:' || o_orderkey, 'Procedure:' || o_orderpriority FROM orders
  UNION SELECT 'Admission:' || user_id, 'LabTest:' || event_type FROM events WHERE user_id IN (SELECT o_orderkey FROM orders)
  UNION SELECT 'Admission:' || doc_id, 'ClinicalNote:' || doc_id FROM documents WHERE doc_id IN (SELECT o_orderkey FROM orders)
  UNION SELECT 'ClinicalNote:' || note_id, 'Concept:' || concept_id FROM mentions),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links)"""


def _top(source: str, count: str, k: int) -> str:
    return f"SELECT code, p_name AS title, {count} FROM ({source}) JOIN part ON p_partkey = code ORDER BY {count} DESC, code LIMIT {k}"


_ELEMENT = "max(value) FILTER (i = floor(n * {q}))"

_KEPT_ORDERS = "SELECT * FROM orders WHERE o_orderstatus <> 'P'"
_KEPT_KEYS = "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'"
_KEPT_LINES = f"SELECT * FROM lineitem WHERE l_orderkey IN ({_KEPT_KEYS})"

ORACLE: dict[str, str] = {
    "csv_roundtrip": _FINGERPRINTS,
    "parquet_roundtrip": _FINGERPRINTS,
    "partitioned_pruned_read": (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate::varchar AS o_orderdate, o_orderpriority "
        "FROM orders WHERE o_custkey = 1"
    ),
    "table_counts": _unions([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES]),
    "null_profile": "WITH j AS (SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)\n"
    + _unions(
        [
            f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS null_count, "
            f"round(count(*) FILTER ({c} IS NULL)::double / count(*), 6) AS null_share FROM j"
            for c in _NULL_COLUMNS
        ]
    ),
    "key_frequency": "SELECT l_suppkey, count(*) AS frequency FROM lineitem GROUP BY l_suppkey",
    "group_mean_std": (
        "SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean_value, "
        "round(stddev_samp(l_extendedprice), 4) AS sd_value FROM lineitem GROUP BY l_returnflag"
    ),
    "latency_percentiles": f"""SELECT event_type, max(n) AS n, round(quantile_cont(value, 0.5), 6) AS p50,
  {_ELEMENT.format(q='0.95::double')} AS p95, {_ELEMENT.format(q='0.99::double')} AS p99
FROM (SELECT event_type, value, count(*) OVER (PARTITION BY event_type) AS n,
        row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i FROM events)
GROUP BY event_type""",
    "publish_messages": f"SELECT user_id::varchar AS key, {_EVENT_JSON} AS value FROM events",
    "event_time_parse": """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d') || ' 00:00:00' END AS event_time FROM events""",
    "parse_json_events": """SELECT CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN user_id END AS user_id,
  CASE WHEN ok THEN event_type END AS event_type, CASE WHEN ok THEN value END AS value,
  CASE WHEN ok THEN (props->>'$.k')::bigint END AS k FROM (SELECT *, event_type <> 'error' AS ok FROM events)""",
    "stream_ingest_notes": "SELECT doc_id, lang, source, md5(text) AS text_md5 FROM documents",
    "nodes_patient": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer",
    "nodes_admission": (
        "SELECT o_orderkey AS id, o_custkey AS patient, o_orderdate::varchar AS admitted, o_orderstatus AS status, "
        "o_orderpriority AS priority, o_totalprice AS price FROM orders"
    ),
    "nodes_diagnosis": "SELECT p_partkey AS id, p_name AS title, p_brand AS brand, p_type AS kind FROM part",
    "nodes_medication": "SELECT s_suppkey AS id, min(s_name) AS drug FROM supplier GROUP BY s_suppkey",
    "nodes_concept": f"WITH {_MENTIONS} SELECT DISTINCT concept_id AS id, name FROM mentions",
    "nodes_lab_test": "SELECT DISTINCT event_type AS id FROM events",
    "nodes_procedure": "SELECT DISTINCT o_orderpriority AS id FROM orders",
    "nodes_caregiver": "SELECT n_nationkey AS id, n_name AS label FROM nation",
    "nodes_note": "SELECT doc_id AS id, lang, source FROM documents",
    "nodes_filled": (
        "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS status, "
        "o_orderpriority AS priority FROM orders"
    ),
    "nodes_with_rank": f"""{_BIPARTITE}
SELECT s_suppkey AS id, s_name AS drug, round(rank, 9) AS rank FROM supplier JOIN ranks ON id = 'M:' || s_suppkey::varchar""",
    "edges_has_admission": (
        "SELECT DISTINCT o_custkey AS src, o_orderkey AS dst FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)"
    ),
    "edges_same_as": f"""WITH {_PAIRS}
SELECT id_a AS src, id_b AS dst, round(jw, 6) AS confidence FROM scored
WHERE jw > 0.88 AND split_part(upper(name_a), ' ', 1) = split_part(upper(name_b), ' ', 1)
  AND id_a IN (SELECT p_partkey FROM part WHERE p_size > 10) AND id_b IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
    "edges_co_occurs": f"""WITH {_DX}, {_cooccur('dx', 3)}
SELECT code_a AS src, code_b AS dst, co_count AS count, round(ln(co_count), 6) AS log_count FROM co""",
    "dangling_edges": _unions(
        [
            f"SELECT '{kind}' AS kind, '{name}' AS name, count(*) AS n FROM ({rows})"
            for kind, name, rows in (
                ("node", "Admission", _KEPT_ORDERS),
                ("edge", "HAS_ADMISSION", f"SELECT DISTINCT o_custkey, o_orderkey FROM ({_KEPT_ORDERS})"),
                ("edge", "HAS_DIAGNOSIS", f"SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM ({_KEPT_LINES})"),
                ("edge", "UNDERWENT", f"SELECT DISTINCT o_orderkey, o_orderpriority FROM ({_KEPT_ORDERS})"),
                ("edge", "PRESCRIBED", f"SELECT DISTINCT l_orderkey, l_suppkey FROM ({_KEPT_LINES})"),
                (
                    "edge",
                    "HAD_LAB_RESULT",
                    f"SELECT DISTINCT user_id, event_type, event_id FROM events WHERE user_id IN ({_KEPT_KEYS})",
                ),
                ("edge", "DOCUMENTED_IN", f"SELECT doc_id FROM documents WHERE doc_id IN ({_KEPT_KEYS})"),
                ("orphan", "no orphan ClinicalNote", f"SELECT doc_id FROM documents WHERE doc_id NOT IN ({_KEPT_KEYS})"),
                (
                    "orphan",
                    "no orphan Diagnosis",
                    f"SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM ({_KEPT_LINES}))",
                ),
                (
                    "orphan",
                    "no orphan Medication",
                    f"SELECT DISTINCT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM ({_KEPT_LINES}))",
                ),
            )
        ]
    ),
    "node_upsert_unversioned": """SELECT c_custkey AS id, c_name AS name, coalesce(p, c_mktsegment) AS segment, c_acctbal AS balance, last_status
FROM customer FULL JOIN (SELECT o_custkey, min(o_orderpriority) FILTER (o_orderpriority LIKE '1%') AS p,
  min(o_orderstatus) AS last_status FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "edge_upsert_properties": """WITH l AS (SELECT l_orderkey AS src, l_suppkey AS dst, l_quantity AS dose, l_returnflag AS route FROM lineitem),
cur AS (SELECT * FROM l WHERE route <> 'R' QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY dose, route) = 1),
inc AS (SELECT src, dst, min(dose) AS dose FROM l WHERE route = 'R' GROUP BY src, dst)
SELECT src, dst, coalesce(inc.dose, cur.dose) AS dose, route, CASE WHEN inc.dose IS NOT NULL THEN 'returned' END AS flag
FROM cur FULL JOIN inc USING (src, dst)""",
    "er_title_features": f"""WITH {_TITLES}
SELECT id_a, id_b, round(jw, 6) AS jw, round(lev, 6) AS lev, round(token_overlap, 6) AS token_overlap, same_code FROM scored""",
    "er_title_labels": f"""WITH {_TITLES},
pos AS (SELECT id_a, id_b FROM scored WHERE same_code = 1 AND jw > {TITLE_RULE.positive_jw}),
neg AS (SELECT id_a, id_b, row_number() OVER (ORDER BY {_md5_number("id_a::varchar || '|' || id_b::varchar")}) AS i
  FROM scored WHERE jw < {TITLE_RULE.negative_jw} AND token_overlap < {TITLE_RULE.negative_overlap})
SELECT id_a, id_b, 1.0::double AS label FROM pos
UNION ALL SELECT id_a, id_b, 0.0::double FROM neg WHERE i <= {TITLE_RULE.negatives_per_positive} * (SELECT count(*) FROM pos)""",
    "er_training_counts": f"""WITH {_PAIRS},
l AS (SELECT id_a, id_b, jw > 0.88 AND split_part(upper(name_a), ' ', 1) = split_part(upper(name_b), ' ', 1) AS hit FROM scored),
neg AS (SELECT id_a, id_b, hit, row_number() OVER (ORDER BY {_md5_number("id_a::varchar || '|' || id_b::varchar")}) AS i
  FROM l WHERE NOT hit),
t AS (SELECT id_a, id_b, hit FROM l WHERE hit
  UNION ALL SELECT id_a, id_b, hit FROM neg WHERE i <= greatest(4 * (SELECT count(*) FROM l WHERE hit), 20))
SELECT count(*) FILTER (hit) AS positives, count(*) FILTER (NOT hit) AS negatives,
  count(*) FILTER ({_md5_number("id_a::varchar || '|' || id_b::varchar", 7)} % 100 >= 80) AS held_out FROM t""",
    "pairs_lsh_docs_check": "SELECT 0::bigint AS outside, 1 AS enough",
    "lsh_sweep_truth": f"""WITH {_ITEMS}, {_similar('item_sets', max(t for _, t in SWEEP))},
all_of AS (SELECT (count(*) * (count(*) - 1)) // 2 AS p FROM item_sets)
"""
    + _unions(
        [
            f"SELECT {n} AS num_tables, {t}::double AS threshold, (SELECT count(*) FROM alike WHERE jaccard_dist < {t}) AS exact_pairs, "
            "(SELECT p FROM all_of) AS all_pairs, 1 AS possible"
            for n, t in SWEEP
        ]
    ),
    "same_as_check": "SELECT 0::bigint AS outside, 0::bigint AS doubtful",
    "louvain_check": "SELECT 0::bigint AS misnamed, 0::bigint AS split, 1 AS better",
    "edges_has_diagnosis": f"WITH {_DXE} SELECT src, dst, seq_num FROM dxe",
    "edges_prescribed": """SELECT l_orderkey AS src, l_suppkey AS dst, l_quantity AS dose, l_returnflag AS route
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_quantity, l_returnflag) = 1""",
    "edges_mentions": f"WITH {_MENTIONS} SELECT DISTINCT note_id AS src, concept_id AS dst, 1.0::double AS score FROM mentions",
    "edges_documented_in": """SELECT 'DOCUMENTED_IN' AS type, doc_id::varchar AS src, doc_id::varchar AS dst FROM documents
UNION ALL SELECT 'UNDERWENT', o_orderkey::varchar, o_orderpriority FROM orders""",
    "edges_lab_result": (
        "SELECT user_id AS src, event_type AS dst, value, event_id FROM events WHERE user_id IN (SELECT o_orderkey FROM orders)"
    ),
    "node_upsert": """SELECT c_custkey AS id, c_name AS name, coalesce(p, c_mktsegment) AS segment, c_acctbal AS balance, last_price
FROM customer FULL JOIN (SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) AS p, arg_max(o_totalprice, o_orderkey) AS last_price
  FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "edge_upsert": """WITH ok AS (SELECT l_orderkey AS src, l_suppkey AS dst, l_quantity AS dose, l_returnflag AS route FROM lineitem
  WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))
SELECT src, dst, dose, route FROM ok
QUALIFY row_number() OVER (PARTITION BY src, dst ORDER BY (route = 'R') DESC, dose, route) = 1""",
    "graph_detach_delete": _unions(
        [f"SELECT '{k}' AS name, n FROM ({_NODE_COUNTS[k]})" for k in ("Patient", "Admission", "Diagnosis")]
        + [f"SELECT '{k}' AS name, n FROM ({_EDGE_COUNTS[k]})" for k in ("HAS_ADMISSION", "HAS_DIAGNOSIS")]
    ),
    "dedup_by_key": """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_suppkey) = 1""",
    "graph_prep_counts": """WITH stays AS (SELECT DISTINCT o_orderkey, o_custkey FROM orders),
c AS (SELECT 'admissions' AS part, count(*) AS row_count FROM stays
  UNION ALL SELECT 'diagnoses', count(*) FROM lineitem JOIN stays ON o_orderkey = l_orderkey
  UNION ALL SELECT 'prescriptions', count(*) FROM lineitem JOIN stays ON o_orderkey = l_orderkey WHERE l_suppkey IS NOT NULL)
SELECT part, row_count FROM c UNION ALL SELECT 'total', sum(row_count)::bigint FROM c""",
    "graph_stats": _stats(),
    "key_uniqueness": _key_checks(),
    "orphan_checks": _orphan_checks(),
    "integrity_report": _integrity(),
    "patient_subgraph_counts": """SELECT o_custkey AS patient, count(DISTINCT o_orderkey) AS admissions,
  count(DISTINCT l_partkey) AS diagnoses, count(DISTINCT l_suppkey) AS medications
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""",
    "patient_subgraph_edges": f"""WITH {_DX}, {_RX}
SELECT 'Patient_' || o_custkey AS src, 'Admission_' || o_orderkey AS adm, 'Diagnosis_' || p_partkey || ': ' || p_name AS diag,
  CASE WHEN rx.dst IS NOT NULL THEN 'Med: ' || s_name END AS med
FROM orders JOIN dx ON dx.src = o_orderkey JOIN part ON p_partkey = dx.dst
LEFT JOIN rx ON rx.src = o_orderkey LEFT JOIN supplier ON s_suppkey = rx.dst
WHERE o_custkey = 1 ORDER BY adm, diag, med NULLS FIRST LIMIT 80""",
    "q1_shortest_path": f"""WITH RECURSIVE {_LINKS},
walk AS (SELECT 'Patient:0' AS node, 0::bigint AS depth
  UNION SELECT b, depth + 1 FROM walk JOIN steps ON a = node WHERE depth < 6)
SELECT 'Patient:0' AS source, 'Patient:1' AS target, min(depth) AS path_length FROM walk WHERE node = 'Patient:1' HAVING min(depth) IS NOT NULL""",
    "q2_differential_dx": f"""WITH {_MENTIONS}, {_DX},
stays AS (SELECT DISTINCT note_id FROM mentions WHERE name IN ({', '.join(repr(n) for n in CONCEPT_NAMES)}))
{_top('SELECT dst AS code, count(*) AS support FROM dx JOIN stays ON src = note_id GROUP BY dst', 'support', 10)}""",
    "q2b_top_diagnoses": f"WITH {_DXE} " + _top("SELECT dst AS code, count(*) AS support FROM dxe GROUP BY dst", "support", 10),
    "q3_similar_cohort": f"""WITH {_DX}, ref AS (SELECT min(l_orderkey) AS id FROM lineitem),
sizes AS (SELECT src, count(*) AS n FROM dx GROUP BY src),
shared AS (SELECT o.src, count(*) AS s FROM dx o JOIN dx r ON o.dst = r.dst AND r.src = (SELECT id FROM ref)
  WHERE o.src <> r.src GROUP BY o.src)
SELECT src AS admission, round(s::double / (n + (SELECT n FROM sizes WHERE src = (SELECT id FROM ref)) - s), 6) AS jaccard
FROM shared JOIN sizes USING (src)
WHERE s::double / (n + (SELECT n FROM sizes WHERE src = (SELECT id FROM ref)) - s) > 0.1
ORDER BY s::double / (n + (SELECT n FROM sizes WHERE src = (SELECT id FROM ref)) - s) DESC, admission LIMIT 20""",
    "q4_medication_diagnoses": f"WITH {_DXE}, {_RX} "
    + _top(
        "SELECT dxe.dst AS code, count(*) AS co_count FROM dxe JOIN rx ON rx.src = dxe.src AND rx.dst = 1 GROUP BY dxe.dst",
        "co_count",
        15,
    ),
    "q5_top_drugs": f"""WITH {_DXE}, {_RX}
SELECT medication, s_name AS drug, rx_count FROM (
  SELECT rx.dst AS medication, count(*) AS rx_count FROM rx JOIN dxe ON rx.src = dxe.src AND dxe.dst = 1 GROUP BY rx.dst)
JOIN supplier ON s_suppkey = medication ORDER BY rx_count DESC, medication LIMIT 10""",
    "top_k_per_key": f"""WITH {_BX}, {_RX}
SELECT diagnosis, medication, rx_count, rank FROM (
  SELECT bx.dst AS diagnosis, rx.dst AS medication, count(*) AS rx_count,
    row_number() OVER (PARTITION BY bx.dst ORDER BY count(*) DESC, rx.dst) AS rank
  FROM bx JOIN rx USING (src) GROUP BY bx.dst, rx.dst) WHERE rank <= 3""",
    "join_agg_default": _JOIN_AGG,
    "join_agg_broadcast": _JOIN_AGG,
    "join_agg_hash": _JOIN_AGG,
    "join_agg_coalesce": _JOIN_AGG,
    "join_agg_range": _JOIN_AGG,
    "join_salted": _JOIN_AGG,
    "hash_sample": f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE {_md5_number('o_orderkey::varchar', 7)} % 1000 < 300",
    "token_sets": f"SELECT p_partkey, array_to_string({_token_set(_ITEM_NAME)}, ',') AS tokens FROM part",
    "block_keys": (
        "SELECT p_partkey, coalesce(nullif(left(regexp_split_to_array(upper(trim(p_name)), '\\s+')[1], 6), ''), 'UNKNOWN') "
        "AS block_key FROM part"
    ),
    "code_chapter_lookup": _chapters(),
    "keyword_dictionary": f"WITH {_DICT} SELECT concept_id, name FROM dict",
    "mentions_extract": f"WITH {_MENTIONS} SELECT note_id, concept_id, char_start, char_end, entity_text FROM mentions",
    "stream_mentions": f"WITH {_MENTIONS} SELECT note_id, concept_id, char_start, char_end, entity_text FROM mentions",
    "mentions_per_note": f"""WITH {_MENTIONS}
SELECT (SELECT count(*) FROM documents) AS notes, count(*) AS mentions,
  round(count(*)::double / (SELECT count(*) FROM documents), 6) AS avg_mentions FROM mentions""",
    "span_f1": f"""WITH {_MENTIONS},
guess_dict AS (SELECT name FROM dict WHERE length(name) > 6
  UNION SELECT w FROM (SELECT unnest(regexp_split_to_array(lower(p_name), '\\s+')) AS w FROM part) WHERE length(w) > 3),
{_places('guess_dict', 'guessed')},
g AS (SELECT DISTINCT note_id, char_start, char_end FROM mentions),
p AS (SELECT DISTINCT doc_id AS note_id, char_start, char_start + length(name) AS char_end FROM guessed),
c AS (SELECT count(*) FILTER (a AND b) AS tp, count(*) FILTER (a AND NOT b) AS fp, count(*) FILTER (b AND NOT a) AS fn
  FROM (SELECT p.note_id IS NOT NULL AS a, g.note_id IS NOT NULL AS b FROM p FULL JOIN g USING (note_id, char_start, char_end))),
s AS (SELECT *, tp / (tp + fp + 1e-9) AS precision, tp / (tp + fn + 1e-9) AS recall FROM c)
SELECT tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(2 * precision * recall / (precision + recall + 1e-9), 6) AS f1 FROM s""",
    "weighted_prf": """WITH r AS (SELECT quality AS l, (n_chars > 1000)::int AS p FROM labels JOIN documents USING (doc_id)),
cls AS (SELECT DISTINCT l AS c FROM r UNION SELECT DISTINCT p FROM r),
k AS (SELECT c, (SELECT count(*) FROM r WHERE l = c) AS actual, (SELECT count(*) FROM r WHERE p = c) AS claimed,
  (SELECT count(*) FROM r WHERE l = c AND p = c) AS hit FROM cls),
m AS (SELECT *, CASE WHEN claimed > 0 THEN hit::double / claimed ELSE 0 END AS pr,
  CASE WHEN actual > 0 THEN hit::double / actual ELSE 0 END AS re FROM k)
SELECT sum(actual)::bigint AS n_rows, round(sum(actual * pr) / sum(actual), 6) AS weighted_precision,
  round(sum(actual * re) / sum(actual), 6) AS weighted_recall,
  round(sum(actual * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END) / sum(actual), 6) AS weighted_f1 FROM m""",
    "sim_jaro_winkler": f"WITH {_PAIRS} SELECT id_a, id_b, round(jw, 6) AS jw FROM scored",
    "sim_levenshtein": f"WITH {_PAIRS} SELECT id_a, id_b, round(lev, 6) AS lev FROM scored",
    "sim_token_jaccard": f"WITH {_PAIRS} SELECT id_a, id_b, round(token_overlap, 6) AS token_overlap FROM scored",
    "er_features_names": f"""WITH {_PAIRS}
SELECT id_a, id_b, round(jw, 6) AS jw, round(lev, 6) AS lev, round(token_overlap, 6) AS token_overlap,
  round(token_overlap, 6) AS jaccard_sim, same_code, NULL::double AS label FROM scored""",
    "er_rule_labels": f"""WITH {_PAIRS}
SELECT id_a, id_b, (jw > 0.88 AND split_part(upper(name_a), ' ', 1) = split_part(upper(name_b), ' ', 1))::int::double AS name_label,
  (left(kind_a, 3) = left(kind_b, 3) OR token_overlap >= 0.4)::int::double AS family_label FROM scored""",
    "er_gold_labels": f"""WITH {_PAIRS},
pos AS (SELECT id_a, id_b FROM scored WHERE same_code = 1 AND jw > {ITEM_RULE.positive_jw}),
neg AS (SELECT id_a, id_b, row_number() OVER (ORDER BY {_md5_number("id_a::varchar || '|' || id_b::varchar")}) AS i
  FROM scored WHERE jw < {ITEM_RULE.negative_jw} AND token_overlap < {ITEM_RULE.negative_overlap})
SELECT id_a, id_b, 1.0::double AS label FROM pos
UNION ALL SELECT id_a, id_b, 0.0::double FROM neg WHERE i <= {ITEM_RULE.negatives_per_positive} * (SELECT count(*) FROM pos)""",
    "pairs_bruteforce": "SELECT '*' AS block, count(*) AS members, (count(*) * (count(*) - 1)) // 2 AS pairs FROM part",
    "pairs_blocked": """SELECT a.b AS block, max(n) AS members, count(*) FILTER (x < y) AS pairs
FROM (SELECT left(p_name, 1) AS b, p_partkey AS x, count(*) OVER (PARTITION BY left(p_name, 1)) AS n FROM part) a
JOIN (SELECT left(p_name, 1) AS b, p_partkey AS y FROM part) c ON a.b = c.b GROUP BY a.b""",
    "pairs_exact_jaccard": f"WITH {_ITEMS}, {_similar('item_sets', ITEM_DISTANCE)} SELECT id_a, id_b, round(jaccard_dist, 6) AS jaccard_dist FROM alike",
    "pairs_lsh": f"WITH {_ITEMS}, {_similar('item_sets', ITEM_DISTANCE)} SELECT id_a, id_b, round(jaccard_dist, 6) AS jaccard_dist FROM alike",
    "pairs_exact_docs": f"WITH {_DOC_SETS}, {_similar('doc_sets', DOC_DISTANCE)} SELECT id_a, id_b, round(jaccard_dist, 6) AS jaccard_dist FROM alike",
    "copy_links": f"WITH {_DOC_SETS} SELECT t.id, s.id AS rep_id FROM doc_tokens t JOIN doc_sets s ON t.tokens = s.tokens AND t.id <> s.id",
    "er_clusters": f"""WITH RECURSIVE {_DOC_SETS}, {_similar('doc_sets', DOC_DISTANCE)},
near AS (SELECT id_a AS a, id_b AS b FROM alike
  UNION ALL SELECT s.id, t.id FROM doc_tokens t JOIN doc_sets s ON t.tokens = s.tokens AND t.id <> s.id),
both_ways AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT id, b FROM reach JOIN both_ways ON a = other)
SELECT id, min(other) AS cluster FROM reach GROUP BY id""",
    "cooccurrence": f"WITH {_BX}, {_cooccur('bx', 5)} SELECT code_a, code_b, co_count, round(ln(co_count), 6) AS log_count FROM co",
    "cooccurrence_pmi": f"""WITH {_DX}, {_cooccur('dx', 2)}, n AS (SELECT dst, count(*) AS c FROM dx GROUP BY dst)
SELECT code_a, code_b, co_count, round(ln(co_count), 6) AS log_count,
  round(ln(co_count::double * (SELECT count(DISTINCT src) FROM dx) / (a.c::double * b.c)), 6) AS pmi
FROM co JOIN n a ON a.dst = code_a JOIN n b ON b.dst = code_b""",
    "projection_counts": f"""WITH {_DX}, {_RX}, {_cooccur('dx', 2)}
SELECT 'diagnosis' AS graph_name, (SELECT count(*) FROM part) AS node_count, (SELECT 2 * count(*) FROM co) AS relationship_count
UNION ALL SELECT 'medication', (SELECT count(*) FROM orders) + (SELECT count(DISTINCT s_suppkey) FROM supplier), (SELECT count(*) FROM rx)""",
    "connected_nodes": f"""WITH {_DX}, {_cooccur('dx', 2)}
SELECT count(*) AS connected_nodes FROM (SELECT code_a FROM co UNION SELECT code_b FROM co)""",
    "wcc": f"""WITH RECURSIVE {_DX}, {_cooccur('dx', 3)},
e AS (SELECT code_a AS a, code_b AS b FROM co UNION ALL SELECT code_b, code_a FROM co),
reach AS (SELECT p_partkey AS id, p_partkey AS other FROM part UNION SELECT id, b FROM reach JOIN e ON a = other)
SELECT id, min(other) AS component FROM reach GROUP BY id""",
    "pagerank_bipartite": f"{_BIPARTITE} SELECT id, round(rank, 9) AS rank FROM ranks",
    "pagerank_top": f"""{_BIPARTITE}
SELECT id, s_name AS name, round(rank, 9) AS rank FROM ranks JOIN supplier ON id = 'M:' || s_suppkey::varchar
ORDER BY round(ranks.rank, 9) DESC, id LIMIT 20""",
    "pagerank_cooccurrence": _pagerank_co(5),
    "modularity": f"""WITH {_BX}, {_cooccur('bx', 5)},
e AS (SELECT code_a AS a, code_b AS b, co_count::double AS w FROM co UNION ALL SELECT code_b, code_a, co_count FROM co),
c AS (SELECT right(a, 1) AS k, sum(CASE WHEN right(a, 1) = right(b, 1) THEN w ELSE 0 END) AS inside, sum(w) AS total FROM e GROUP BY 1)
SELECT round(sum(inside) / sum(total) - sum(total * total) / (sum(total) * sum(total)), 9) AS modularity FROM c""",
}

#: Merges into stored tables have the rows of the merges in memory.
ORACLE |= {"node_upsert_versions": ORACLE["node_upsert"], "edge_upsert_versions": ORACLE["edge_upsert"]}
