"""The same queries as SQL, written independently of the Spark jobs."""

from __future__ import annotations

from riftlog.operators.catalogue import CATALOGUE, catalogue_regex, specificity

LINE = (
    r"^([^\s]+)\s+(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d+)\s+(\d+)\s+([A-Z]+)\s+([^\[]+)\s*"
    r"(?:\[([^\]]+)\])?\s*(.*)"
)

_LINES = """lines AS (
  SELECT event_id AS line_no, concat_ws(' ',
    CASE WHEN event_type IN ('click', 'view') THEN 'nova-api.log'
         WHEN event_type = 'error' THEN 'nova-scheduler.log' ELSE 'nova-compute.log' END,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%g'),
    CAST(2000 + user_id % 97 AS VARCHAR),
    CASE WHEN event_id % 13 = 0 THEN 'info' WHEN event_type = 'error' THEN 'ERROR'
         WHEN event_type = 'signup' THEN 'WARNING' ELSE 'INFO' END,
    CASE event_type WHEN 'click' THEN 'nova.osapi_compute.wsgi.server'
         WHEN 'view' THEN 'nova.metadata.wsgi.server'
         WHEN 'error' THEN 'nova.scheduler.host_manager' ELSE 'nova.compute.manager' END,
    CASE WHEN event_id % 7 = 0 THEN '[-]' WHEN event_id % 11 = 0 THEN NULL
         ELSE '[req-' || user_id || ']' END,
    CASE event_type
      WHEN 'click' THEN '10.11.10.' || (user_id % 250) || ' "GET /v2/servers/detail" status: 200 len: '
        || CAST(floor(value) AS BIGINT) || ' time: 0.' || (event_id % 1000)
      WHEN 'view' THEN 'image img-' || (event_id % 17) || ' at (/var/lib/nova/base): checking'
      WHEN 'error' THEN 'The instance sync for host ''cp-' || (user_id % 5)
        || ''' did not match. Re-created its InstanceList.'
      WHEN 'signup' THEN '[instance: i-' || user_id || '] Instance spawned successfully.'
      ELSE '[instance: i-' || user_id || '] Took ' || (event_id % 30) || '.' || (event_id % 100)
        || ' seconds to build instance.' END) AS value
  FROM events)"""

_PARSED = f"""{_LINES}, parsed AS (
  SELECT line_no, g[1] AS source, g[2] AS "timestamp", TRY_CAST(g[3] AS BIGINT) AS pid, g[4] AS level,
    g[5] AS component, nullif(g[6], '') AS request_id, nullif(g[7], '') AS message
  FROM (SELECT line_no, [{", ".join(f"regexp_extract(value, '{LINE}', {i})" for i in range(1, 8))}] AS g
        FROM lines WHERE regexp_matches(value, '{LINE}')))"""

_CLEANED = f"""{_PARSED}, cleaned AS (
  SELECT * REPLACE (CASE WHEN request_id = '-' THEN 'rca-system' ELSE request_id END AS request_id)
  FROM parsed)"""

_SPACE = r"[\t\n\x0B\f\r\x1C-\x1F\x{85}\p{Z}]+"


_WORD = r"[\p{L}\p{N}_]{2,}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}|{_SPACE}$', '', 'g')"


def _shape(x: str) -> str:
    return (
        f"nullif(array_to_string(list_transform(string_split_regex({_strip(x)}, '\\s+'), "
        f"lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END), ' '), '')"
    )


_SHAPED = f"""{_CLEANED}, shaped AS (SELECT *, {_shape("message")} AS shape FROM cleaned)"""


def _shapes(rows: str, to: str = "shapes") -> str:
    return f"""{to} AS (
  SELECT shape, count(*) AS n_rows, min(line_no) AS first_line_no,
    CAST(len(string_split(shape, ' ')) AS INTEGER) AS n_tokens, string_split(shape, ' ')[1] AS first_token
  FROM ({rows}) WHERE shape IS NOT NULL GROUP BY shape)"""


def _consensus(shapes: str = "shapes") -> str:
    """One template per number of tokens and first token: what all shapes share."""
    return f"""tokens AS (
  SELECT n_tokens, first_token, unnest(string_split(shape, ' ')) AS t,
    unnest(range(n_tokens)) AS pos FROM {shapes}),
agreed AS (
  SELECT n_tokens, first_token, pos, CASE WHEN count(DISTINCT t) = 1 THEN min(t) ELSE '<*>' END AS t
  FROM tokens GROUP BY ALL),
known AS (
  SELECT 'LG_KEY_' || row_number() OVER (ORDER BY first_line_no) AS log_key, *
  FROM (SELECT n_tokens, first_token, string_agg(t, ' ' ORDER BY pos) AS template
        FROM agreed GROUP BY ALL)
  JOIN (SELECT n_tokens, first_token, sum(n_rows)::BIGINT AS n_rows, min(first_line_no) AS first_line_no
        FROM {shapes} GROUP BY ALL) USING (n_tokens, first_token))"""


_DOCUMENT_LINES = f"""document_lines AS (
  SELECT doc_id, unnest(kept) AS line, unnest(range(len(kept))) AS line_no
  FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: {_strip("x")}),
                                   lambda x: length(x) > 0) AS kept FROM documents))"""

_LEAF_TEMPLATES = f"""WITH {_DOCUMENT_LINES},
{_shapes(f"SELECT doc_id * 100000 + line_no AS line_no, {_shape('line')} AS shape FROM document_lines")},
{_consensus()}
SELECT log_key, md5(template) AS template_md5, n_rows, first_line_no, n_tokens FROM known"""

def _grown(shapes: str = "shapes", similarity: float = 0.4) -> str:
    """Mining step by step: in each leaf shapes join the most similar template, in
    order of appearance. ``steps`` has one row per shape, ``versions`` one per
    change of a template, ``known`` the templates at the end."""
    return f"""ordered AS (
  SELECT n_tokens, first_token, string_split(shape, ' ') AS toks, n_rows, first_line_no,
    row_number() OVER (PARTITION BY n_tokens, first_token ORDER BY first_line_no) AS i FROM {shapes}),
steps AS (
  SELECT n_tokens, first_token, CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[][]) AS known,
    CAST(0 AS BIGINT) AS place, CAST(NULL AS VARCHAR[]) AS template, false AS changed,
    CAST(0 AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS line_no
  FROM (SELECT DISTINCT n_tokens, first_token FROM {shapes})
  UNION ALL
  SELECT n_tokens, first_token, i,
    CASE WHEN fits = 0 THEN list_append(known, toks)
      ELSE list_concat(list_append(known[1:fits - 1], merged), known[fits + 1:]) END,
    CASE WHEN fits = 0 THEN len(known) + 1 ELSE fits END,
    CASE WHEN fits = 0 THEN toks ELSE merged END, fits = 0 OR merged <> known[fits], n_rows, first_line_no
  FROM (SELECT *, CASE WHEN fits > 0 THEN list_transform(list_zip(known[fits], toks),
          lambda p: CASE WHEN p[1] = p[2] THEN p[1] ELSE '<*>' END) END AS merged
    FROM (SELECT *, CASE WHEN len(known) = 0 OR same[best] < {similarity} * n_tokens THEN 0 ELSE best END AS fits
      FROM (SELECT *, list_position(ranks, list_max(ranks)) AS best
        FROM (SELECT *, list_transform(list_zip(same, wild), lambda p: p[1] * (n_tokens + 1) + p[2]) AS ranks
          FROM (SELECT s.n_tokens, s.first_token, o.i, s.known, o.toks, o.n_rows, o.first_line_no,
              list_transform(s.known, lambda t: len(list_filter(list_zip(t, o.toks),
                lambda p: p[1] = p[2] AND p[1] <> '<*>'))) AS same,
              list_transform(s.known, lambda t: len(list_filter(t, lambda x: x = '<*>'))) AS wild
            FROM steps s JOIN ordered o ON o.n_tokens = s.n_tokens AND o.first_token = s.first_token AND o.i = s.i + 1)))))),
placed AS (
  SELECT *, sum(n_rows) OVER leaf_place AS total, min(line_no) OVER leaf_place AS first_line_no
  FROM steps WHERE i > 0 WINDOW leaf_place AS (PARTITION BY n_tokens, first_token, place)),
versions AS (
  SELECT n_tokens, first_token, array_to_string(template, ' ') AS template, first_line_no,
    line_no AS since_line_no, CAST(row_number() OVER older AS INTEGER) AS version,
    row_number() OVER (PARTITION BY n_tokens, first_token, place ORDER BY i DESC) = 1 AS is_current,
    CAST(total AS BIGINT) AS n_rows
  FROM placed WHERE changed WINDOW older AS (PARTITION BY n_tokens, first_token, place ORDER BY i)),
merged AS (
  SELECT template, n_tokens, first_token, CAST(sum(n_rows) AS BIGINT) AS n_rows, min(first_line_no) AS first_line_no
  FROM versions WHERE is_current GROUP BY ALL),
known AS (SELECT 'LG_KEY_' || row_number() OVER (ORDER BY first_line_no) AS log_key, * FROM merged)"""


_LINE_SHAPES = f"""{_DOCUMENT_LINES},
turns AS (SELECT doc_id * 100000 + line_no AS line_no, {_shape('line')} AS shape FROM document_lines)"""


def _tree(shapes: str, to: str, children: int = 4) -> str:
    """Shapes of ``shapes`` with the way through a tree two tokens deep."""
    ways = []
    for level in (1, 2):
        before, node = (shapes, "''") if level == 1 else (f"{to}_1", "way")
        ways.append(f"""{to}_first{level} AS (
  SELECT n_tokens, {node} AS node, string_split(shape, ' ')[{level}] AS t, min(first_line_no) AS since
  FROM {before} WHERE len(string_split(shape, ' ')) >= {level} AND string_split(shape, ' ')[{level}] <> '<*>' GROUP BY ALL),
{to}_branch{level} AS (
  SELECT * FROM {to}_first{level} QUALIFY row_number() OVER (PARTITION BY n_tokens, node ORDER BY since) <= {children}),
{to}_{level} AS (
  SELECT s.* EXCLUDE ({'first_token' if level == 1 else 'way'}),
    {'' if level == 1 else "way || "}CASE WHEN len(string_split(shape, ' ')) < {level} THEN ''
      ELSE {"''" if level == 1 else "' '"} || coalesce(b.t, '<*>') END AS way
  FROM {before} s LEFT JOIN {to}_branch{level} b ON b.n_tokens = s.n_tokens AND b.node = {"''" if level == 1 else "s.way"}
    AND b.t = string_split(s.shape, ' ')[{level}])""")
    return ", ".join(ways) + f", {to} AS (SELECT * EXCLUDE (way), way AS first_token FROM {to}_2)"


_TREE_MINED = f"""WITH RECURSIVE {_LINE_SHAPES},
{_shapes("SELECT * FROM turns", "plain")}, {_tree("plain", "shapes")}, {_grown()}"""

# The way of a shape through the branches that the templates have.
_TREE_TAGGED = f"""WITH RECURSIVE {_LINE_SHAPES},
{_shapes("SELECT * FROM turns WHERE line_no % 2 = 0", "plain")}, {_tree("plain", "shapes")}, {_grown()},
asked AS (SELECT DISTINCT shape, string_split(shape, ' ') AS toks, CAST(len(string_split(shape, ' ')) AS INTEGER) AS n_tokens FROM turns WHERE shape IS NOT NULL),
one AS (
  SELECT a.*, CASE WHEN EXISTS (SELECT 1 FROM known k WHERE k.n_tokens = a.n_tokens AND string_split(k.first_token, ' ')[1] = toks[1])
    THEN toks[1] ELSE '<*>' END AS w1 FROM asked a),
two AS (
  SELECT o.*, CASE WHEN o.n_tokens = 1 THEN w1 WHEN EXISTS (
      SELECT 1 FROM known k WHERE k.n_tokens = o.n_tokens AND k.first_token = w1 || ' ' || toks[2])
    THEN w1 || ' ' || toks[2] ELSE w1 || ' <*>' END AS way FROM one o),
fits AS (
  SELECT shape, log_key, row_number() OVER (PARTITION BY shape ORDER BY
      len(list_filter(string_split(template, ' '), lambda t: t = '<*>')), CAST(split_part(log_key, '_', 3) AS INTEGER)) AS rank
  FROM two JOIN known k ON k.n_tokens = two.n_tokens AND k.first_token = way
  WHERE list_bool_and(list_transform(list_zip(toks, string_split(template, ' ')), lambda p: p[2] = '<*>' OR p[1] = p[2])))
SELECT line_no, CASE WHEN shape IS NOT NULL THEN coalesce(log_key, 'UNMAPPED') END AS log_key
FROM turns LEFT JOIN (SELECT * FROM fits WHERE rank = 1) USING (shape)"""

_STRICT_MINED = f"""WITH RECURSIVE {_LINE_SHAPES},
{_shapes("SELECT * FROM turns", "plain")}, shapes AS (SELECT * REPLACE ('' AS first_token) FROM plain), {_grown()}"""

_DOCUMENT_SHAPED = f"""WITH RECURSIVE {_DOCUMENT_LINES}, shaped AS (
  SELECT doc_id * 100000 + line_no AS line_no, line AS message, {_shape('line')} AS shape FROM document_lines),
{_shapes("SELECT * FROM shaped")}"""

_TWO_LOGS = f"""{_SHAPED}, both_logs AS (
  SELECT line_no, message, shape FROM shaped
  UNION ALL SELECT 1000000000000 + conv_id * 1000 + turn, text, {_shape('text')} FROM conversations)"""

_MATCHED = f"""{_TWO_LOGS},
{_shapes("SELECT * FROM shaped", "log_shapes")},
{_consensus("log_shapes")},
{_shapes("SELECT * FROM both_logs")},
matched AS (
  SELECT shape, template, log_key FROM shapes JOIN known USING (n_tokens, first_token)
  WHERE list_bool_and(list_transform(list_zip(string_split(shape, ' '), string_split(template, ' ')),
    lambda p: p[2] = '<*>' OR p[1] = p[2]))),
tagged AS (
  SELECT s.line_no, CASE WHEN s.message IS NOT NULL THEN coalesce(m.log_key, 'UNMAPPED') END AS log_key
  FROM both_logs s LEFT JOIN matched m USING (shape))"""

# Leaves of the document lines first, by line, then the new leaves of the conversations.
_LEARNED = f"""{_DOCUMENT_LINES}, learn_rows AS (
  SELECT doc_id * 100000 + line_no AS line_no, {_shape('line')} AS shape, true AS is_old FROM document_lines
  UNION ALL SELECT conv_id * 1000 + turn, {_shape('text')}, false FROM conversations),
{_shapes("SELECT is_old, line_no, shape FROM learn_rows")},
{_consensus()},
leaf_starts AS (
  SELECT CAST(len(string_split(shape, ' ')) AS INTEGER) AS n_tokens, string_split(shape, ' ')[1] AS first_token,
    bool_or(is_old) AS is_old, min(line_no) FILTER (is_old) AS old_line, min(line_no) AS any_line
  FROM learn_rows WHERE shape IS NOT NULL GROUP BY ALL),
learned AS (
  SELECT n_tokens, first_token, template, n_rows,
    'LG_KEY_' || row_number() OVER (ORDER BY is_old DESC, coalesce(old_line, any_line)) AS log_key
  FROM known JOIN leaf_starts USING (n_tokens, first_token))"""


def _top(table: str, text: str, doc: str, limit: int | None = 1000) -> str:
    cap = f"ORDER BY corpus_count DESC, term LIMIT {limit}" if limit else ""
    return f"""words AS (
  SELECT {doc} AS doc_id, unnest(regexp_extract_all(lower({text}), '{_WORD}')) AS term
  FROM {table}),
vocab AS (
  SELECT term, count(*) AS corpus_count, count(DISTINCT doc_id) AS doc_count FROM words GROUP BY term {cap}),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM {table})) / (1 + doc_count)) + 1 AS idf FROM vocab)"""


_WEIGHTS = """weights AS (
  SELECT doc_id, term, count(*) * any_value(idf) AS w FROM {words} JOIN idf USING (term) GROUP BY doc_id, term)
SELECT doc_id, term, CAST(round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS DECIMAL(18, 6)) AS weight
FROM weights"""

def _session_weights(limit: int | None) -> str:
    shown = f"WITH {_SHAPED}, sessions AS (SELECT request_id, shape FROM shaped WHERE request_id IS NOT NULL AND shape IS NOT NULL)"
    top = _top("sessions", "shape", "request_id", limit).replace("count(*) FROM sessions", "count(DISTINCT request_id) FROM sessions")
    return f"{shown}, {top}, {_WEIGHTS.format(words='words')}".replace("SELECT doc_id, term, CAST", "SELECT doc_id AS session_id, term, CAST")


_CENTERS = """places AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(64)) AS pos FROM embeddings),
centers AS (SELECT label AS cluster, pos, avg(x) AS c FROM places GROUP BY ALL),
distances AS (
  SELECT vec_id, any_value(label) AS label, cluster, sqrt(sum((x - c) * (x - c))) AS d
  FROM places JOIN centers USING (pos) GROUP BY vec_id, cluster),
nearest AS (
  SELECT vec_id, cluster, d FROM distances
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)"""


_STUMPS = """paths AS (
  SELECT vec_id, CASE WHEN embedding[4 * t + 1] <= 0 THEN 40 + t ELSE 216 - t END AS n
  FROM embeddings CROSS JOIN (SELECT unnest(range(16)) AS t)),
scored AS (
  SELECT vec_id, -pow(2, -avg(1 + 2 * (ln(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n)
    / (2 * (ln(255) + 0.5772156649015329) - 2.0 * 255 / 256)) AS score FROM paths GROUP BY vec_id)"""


def _silhouette(distance: str) -> str:
    return f"""WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
means AS (
  SELECT a.vec_id, a.label, b.label AS other, sum({distance}) AS total, count(*) AS n
  FROM v a CROSS JOIN v b GROUP BY ALL),
parts AS (
  SELECT vec_id, max(CASE WHEN label = other THEN n END) AS n,
    max(CASE WHEN label = other AND n > 1 THEN total / (n - 1) END) AS a,
    min(CASE WHEN label <> other THEN total / n END) AS b
  FROM means GROUP BY vec_id)
SELECT CAST(round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS DECIMAL(18, 6))
  AS silhouette FROM parts"""


_LOSSES = """months AS (
  SELECT year(l_shipdate) * 12 + month(l_shipdate) AS m, l_discount, l_tax FROM lineitem),
losses AS (
  SELECT CAST(m - (SELECT min(m) FROM months) AS INTEGER) AS epoch, round(avg(l_discount), 6) AS val_loss,
    round(avg(l_tax), 6) AS train_loss FROM months GROUP BY m)"""


def _dec(x: str, digits: int = 6) -> str:
    return f"CAST(round({x}, {digits}) AS DECIMAL(18, {digits}))"


def _histogram(table: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(b.bin AS INTEGER) AS bin,
    {_dec("any_value(r.lo) + b.bin * any_value(r.hi - r.lo) / 30", 4)} AS low,
    {_dec("any_value(r.lo) + (b.bin + 1) * any_value(r.hi - r.lo) / 30", 4)} AS high,
    count(x.x) AS n
  FROM (SELECT unnest(range(30)) AS bin) b
  CROSS JOIN (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {table}) r
  LEFT JOIN (SELECT {column}::DOUBLE AS x,
      least(floor(({column} - min({column}) OVER ()) / (max({column}) OVER () - min({column}) OVER ()) * 30), 29) AS bin
    FROM {table} WHERE {column} IS NOT NULL) x ON x.bin = b.bin
  GROUP BY b.bin"""


def _pieces(size: int) -> str:
    return f"""WITH {_SHAPED}, numbered AS (
  SELECT request_id AS session_id, line_no, shape,
    (row_number() OVER (PARTITION BY request_id ORDER BY line_no) - 1) // {size} AS piece
  FROM shaped WHERE request_id IS NOT NULL AND shape IS NOT NULL)
SELECT session_id, piece, count(*) AS n_events, string_agg(shape, ' ' ORDER BY line_no) AS sequence
FROM numbered GROUP BY session_id, piece"""


def _windows(rows: str, keys: str, order: str, value: str, size: int, out: str) -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""SELECT {out} FROM (
  SELECT *, list({value}) OVER w AS win, count(*) OVER w AS n FROM {rows}
  WINDOW w AS ({part}ORDER BY {order} ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)) WHERE n = {size}"""


_COLUMNS = ("line_no", "source", "timestamp", "pid", "level", "component", "request_id", "message")
_TYPES = {"line_no": "bigint", "pid": "bigint"}


def _summary(columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {i} AS place, '{_TYPES.get(c, "string")}' AS dtype,
        count(*) AS row_count, count(*) - count("{c}") AS missing FROM parsed"""
        for i, c in enumerate(columns)
    )


_COUNTS = "counts AS (SELECT request_id AS value, count(*) AS n FROM parsed GROUP BY request_id)"
_IDS = """ids AS (SELECT coalesce(sum(n) FILTER (value IS NULL), 0)::BIGINT AS null_count,
  coalesce(sum(n) FILTER (value = '-'), 0)::BIGINT AS dash_count, bool_or(n > 1) AS has_duplicates FROM counts)"""
_TOP50 = "top50 AS (SELECT value, n FROM counts ORDER BY n DESC, value ASC NULLS FIRST LIMIT 50)"

_MESSAGES = """messages AS (
  SELECT event_id, '{"message":"' || CASE WHEN event_type = 'error' THEN 'retrain_model' ELSE 'model_updated' END
    || '","user_id":' || user_id || '}' AS body FROM events)"""

_CATALOGUE_ROWS = ", ".join(
    "('{}', '{}', {})".format(n, catalogue_regex(t).replace("'", "''"), specificity(t)) for n, t in CATALOGUE
)

_FAILED = """SELECT 'timestamp' AS "column", 'exists' AS rule, CAST(NULL AS VARCHAR) AS expected, 0 AS failed, 'warning' AS severity
  UNION ALL SELECT 'timestamp', 'type', 'timestamp_ntz',
    (SELECT count(*) FROM parsed WHERE "timestamp" IS NOT NULL AND TRY_CAST("timestamp" AS TIMESTAMP) IS NULL), 'error'
  UNION ALL SELECT 'pid', 'exists', NULL, 0, 'warning'
  UNION ALL SELECT 'pid', 'type', 'bigint', 0, 'error'
  UNION ALL SELECT 'request_id', 'exists', NULL, 0, 'warning'
  UNION ALL SELECT 'request_id', 'type', 'bigint',
    (SELECT count(*) FROM parsed WHERE request_id IS NOT NULL AND TRY_CAST(request_id AS BIGINT) IS NULL), 'error'
  UNION ALL SELECT 'status', 'exists', NULL, 1, 'warning'
  UNION ALL SELECT 'message', 'exists', NULL, 0, 'error'
  UNION ALL SELECT 'pid', 'type', 'string', (SELECT count(pid) FROM parsed), 'error'"""

ORACLE = {
    "raw_lines": f"WITH {_LINES} SELECT row_number() OVER (ORDER BY line_no) - 1 AS line_no, value FROM lines",
    "trim_nonblank_lines": f"WITH {_DOCUMENT_LINES} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, line FROM document_lines",
    "csv_roundtrip": f'WITH {_PARSED} SELECT source, "timestamp", pid, level, component, request_id, message FROM parsed',
    "csv_headerless": "SELECT o_orderkey AS order_key, o_orderstatus, o_totalprice AS price, o_orderpriority FROM orders",
    "json_roundtrip": "SELECT event_id, event_type, value, props FROM events",
    "single_file_export": f"WITH {_CLEANED} SELECT request_id AS value, count(*) AS n, 1 AS files FROM cleaned GROUP BY request_id",
    "model_update_record": """SELECT event_id, '{"task":"airflow_trigger","timestamp":"'
      || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '","extra":{"user":"' || user_id || '","kind":"' || event_type
      || '"},"message":"model_updated"}' AS body FROM events""",
    "retrain_requests": f"WITH {_MESSAGES} SELECT * FROM messages WHERE body LIKE '%retrain_model%'",
    "stream_retrain": f"WITH {_MESSAGES} SELECT body FROM messages WHERE body LIKE '%retrain_model%'",
    "appended_updates": """SELECT '{"task":"airflow_trigger","timestamp":"2024-01-01 00:00:00.000000","extra":{"'
      || k || '":"' || v || '"},"message":"model_updated"}' AS body
      FROM (SELECT 'n' AS k, count(*) AS v FROM events UNION ALL SELECT 'k', count(DISTINCT event_type) FROM events)""",
    "profile_report": f"""WITH {_PARSED}, {_COUNTS}, {_IDS}, {_TOP50}, summary AS ({_summary(_COLUMNS[1:])})
      SELECT 'column' AS section, "column" AS item, 'dtype' AS metric, dtype AS value FROM summary
      UNION ALL SELECT 'column', "column", 'missing', missing::VARCHAR FROM summary
      UNION ALL SELECT 'column', "column", 'row_count', row_count::VARCHAR FROM summary
      UNION ALL SELECT 'id', 'request_id', 'null_count', null_count::VARCHAR FROM ids
      UNION ALL SELECT 'id', 'request_id', 'dash_count', dash_count::VARCHAR FROM ids
      UNION ALL SELECT 'id', 'request_id', 'has_duplicates', has_duplicates::VARCHAR FROM ids
      UNION ALL SELECT 'top', value, 'n', n::VARCHAR FROM top50""",
    "parse_log": f"WITH {_PARSED} SELECT * FROM parsed",
    "parse_rejects": f"WITH {_LINES} SELECT * FROM lines WHERE NOT regexp_matches(value, '{LINE}')",
    "event_times": f"""WITH {_PARSED} SELECT line_no, TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts,
      rtrim(component) AS component_trimmed, request_id = '-' OR starts_with(request_id, 'req-') AS request_id_valid
      FROM parsed""",
    "impute_request_id": f"WITH {_CLEANED} SELECT line_no, request_id FROM cleaned",
    "drop_missing_message": f"WITH {_PARSED} SELECT line_no, message FROM parsed WHERE message IS NOT NULL",
    "numeric_columns": f"WITH {_PARSED} SELECT line_no, pid FROM parsed",
    "sequence_text": """SELECT row_number() OVER (ORDER BY conv_id) - 1 AS row_no, sequence FROM (
        SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS sequence FROM conversations GROUP BY conv_id)
      WHERE sequence <> ''""",
    "log_scalars": f"""WITH {_CLEANED} SELECT line_no, source || ', ' || level AS joined, 'LG_KEY_' || pid AS formatted,
      strftime(CAST("timestamp" AS TIMESTAMP), '%Y%m%d_%H%M%S') AS stamp,
      CASE level WHEN 'ERROR' THEN 'high' WHEN 'WARNING' THEN 'medium' ELSE 'low' END AS severity,
      contains(message, 'instance') AS has_instance,
      array_to_string(string_split(message, ' ')[2:3], ' ') AS part FROM cleaned""",
    "preview_lines": f"WITH {_PARSED} SELECT line_no, message FROM parsed ORDER BY line_no LIMIT 10",
    "request_id_top50": f"WITH {_PARSED}, {_COUNTS}, {_TOP50} SELECT * FROM top50",
    "request_id_top50_map": f"WITH {_PARSED}, {_COUNTS}, {_TOP50} SELECT coalesce(value, '') AS value, n FROM top50",
    "request_id_profile": f"WITH {_PARSED}, {_COUNTS}, {_IDS} SELECT * FROM ids",
    "column_summary": f"WITH {_PARSED} {_summary(_COLUMNS)}",
    "histogram_lineitem": " UNION ALL ".join(_histogram("lineitem", c) for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")),
    "histogram_pid": f"WITH {_PARSED} {_histogram('parsed', 'pid')}",
    "mean_impute": f"""WITH holes AS (
        SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value,
          CASE WHEN event_type <> 'click' THEN user_id END AS user_id FROM events)
      SELECT event_id, {_dec("coalesce(value, (SELECT avg(value) FROM holes))")} AS value,
        {_dec("coalesce(user_id::DOUBLE, (SELECT avg(user_id) FROM holes))")} AS user_id FROM holes""",
    "validation_report": f"WITH {_PARSED}, r AS ({_FAILED}) SELECT *, failed = 0 AS success FROM r",
    "stored_validation_report": f"WITH {_PARSED}, r AS ({_FAILED}) SELECT *, failed = 0 AS success FROM r",
    "validated_log": f"WITH {_PARSED} SELECT line_no, pid::DOUBLE AS pid FROM parsed",
    "mask_shapes": f"WITH {_SHAPED}, {_shapes('SELECT * FROM shaped')} SELECT shape, n_rows, first_line_no, n_tokens FROM shapes",
    "mask_document_shapes": f"""WITH {_shapes(f"SELECT doc_id AS line_no, {_shape('text')} AS shape FROM documents")}
      SELECT md5(shape) AS shape_md5, n_rows, first_line_no, n_tokens, first_token FROM shapes""",
    "template_keys": f"""WITH {_SHAPED}, {_shapes('SELECT * FROM shaped')}
      SELECT shape AS template, n_rows, first_line_no,
        'LG_KEY_' || row_number() OVER (ORDER BY first_line_no) AS log_key FROM shapes""",
    "mine_leaf_templates": _LEAF_TEMPLATES,
    "mine_templates": f"WITH RECURSIVE {_SHAPED}, {_shapes('SELECT * FROM shaped')}, {_grown()} SELECT * FROM known",
    "mine_document_templates": f"""{_DOCUMENT_SHAPED}, {_grown()}
      SELECT log_key, md5(template) AS template_md5, n_rows, first_line_no, n_tokens FROM known""",
    "mine_templates_strict": f"{_STRICT_MINED} SELECT log_key, md5(template) AS template_md5, n_rows, first_line_no, n_tokens FROM known",
    "mine_templates_tree": f"{_TREE_MINED} SELECT log_key, md5(template) AS template_md5, n_rows, first_line_no, n_tokens FROM known",
    "tag_by_tree": _TREE_TAGGED,
    "template_versions": f"WITH RECURSIVE {_SHAPED}, {_shapes('SELECT * FROM shaped')}, {_grown()} SELECT * FROM versions",
    "document_template_versions": f"""{_DOCUMENT_SHAPED}, {_grown()}
      SELECT * EXCLUDE (first_token) REPLACE (md5(template) AS template) FROM versions""",
    "template_state_roundtrip": f"""{_DOCUMENT_SHAPED}, {_grown()}, fits AS (
        SELECT shape, arg_min(log_key, len(list_filter(string_split(template, ' '), lambda x: x = '<*>')) * 1000000000
          + CAST(log_key[8:] AS BIGINT)) AS log_key
        FROM shapes JOIN known USING (n_tokens, first_token)
        WHERE list_bool_and(list_transform(list_zip(string_split(shape, ' '), string_split(template, ' ')),
          lambda p: p[2] = '<*>' OR p[1] = p[2])) GROUP BY shape)
      SELECT line_no, coalesce(log_key, 'UNMAPPED') AS log_key FROM shaped LEFT JOIN fits USING (shape)""",
    "stream_templates": f"""WITH RECURSIVE {_SHAPED}, timed AS (
        SELECT epoch_us(CAST("timestamp" AS TIMESTAMP)) AS line_no, shape FROM shaped), {_shapes('SELECT * FROM timed')},
      {_grown()} SELECT n_tokens, first_token, version, template, first_line_no, n_rows FROM versions WHERE is_current""",
    "match_templates": f"WITH {_MATCHED} SELECT * FROM matched",
    "tag_log_key": f"WITH {_MATCHED} SELECT * FROM tagged",
    "template_usage": f"WITH {_MATCHED} SELECT log_key, count(*) AS n FROM tagged GROUP BY log_key",
    "unseen_templates": f"""WITH {_TWO_LOGS}, {_shapes('SELECT * FROM both_logs')}, {_consensus()},
      seen AS (SELECT DISTINCT CAST(len(string_split(shape, ' ')) AS INTEGER) AS n_tokens,
        string_split(shape, ' ')[1] AS first_token FROM shaped WHERE shape IS NOT NULL)
      SELECT log_key, template FROM known ANTI JOIN seen USING (n_tokens, first_token)""",
    "learn_templates": f"WITH {_LEARNED} SELECT md5(template) AS template_md5, n_rows, n_tokens, log_key FROM learned",
    "match_catalogue": f"""WITH {_PARSED}, catalogue(event_id, pattern, weight) AS (VALUES {_CATALOGUE_ROWS}),
      hits AS (SELECT line_no, arg_max(event_id, weight) AS event_id FROM parsed
        JOIN catalogue ON regexp_matches(message, pattern) GROUP BY line_no)
      SELECT line_no, event_id FROM parsed LEFT JOIN hits USING (line_no)""",
    "session_sequences": _pieces(1 << 40),
    "session_sequences_from_parts": _pieces(1 << 40),
    "session_pieces": _pieces(256),
    "conversation_sequences": """SELECT conv_id AS session_id, CAST(0 AS BIGINT) AS piece, count(*) AS n_events,
      string_agg(text, ' ' ORDER BY turn) AS sequence FROM conversations GROUP BY conv_id""",
    "sliding_windows": f"WITH {_LINES} " + _windows("lines", "", "line_no", "value", 10, "line_no, array_to_string(win, ' ') AS sequence"),
    "user_windows": _windows("events", "user_id", "event_id", "event_type", 10, "user_id, event_id, array_to_string(win, ' ') AS sequence"),
    "conversation_windows": _windows("conversations", "conv_id", "turn", "role", 4, "conv_id, turn, array_to_string(win, ' ') AS sequence"),
    "short_files": "SELECT conv_id, count(*) AS n_lines FROM conversations GROUP BY conv_id HAVING count(*) < 5",
    "context_payload": f"WITH {_LINES} " + _windows(
        "lines", "", "line_no", "value", 10,
        "line_no, CAST(to_json({'anomaly_line': win[1], 'log_window': win}) AS VARCHAR) AS payload",
    ) + " AND contains(win[1], ' ERROR ')",
    "vocabulary_top1000": f"WITH {_top('documents', 'text', 'doc_id')} SELECT * FROM vocab",
    "tfidf_capped": f"WITH {_top('documents', 'text', 'doc_id')}, {_WEIGHTS.format(words='words')}",
    "tfidf_full": f"WITH {_top('documents', 'text', 'doc_id', None)}, {_WEIGHTS.format(words='words')}",
    "session_tfidf": _session_weights(None),
    "session_tfidf_top20": _session_weights(20),
    "tfidf_transform": f"""WITH {_top('documents', 'text', 'doc_id')}, turn_words AS (
        SELECT conv_id * 1000 + turn AS doc_id,
          unnest(regexp_extract_all(lower(text), '{_WORD}')) AS term FROM conversations),
      {_WEIGHTS.format(words='turn_words')}""",
    "dense_vectors": f"""WITH {_top('conversations', 'text', 'conv_id * 1000 + turn')}, weights AS (
        SELECT doc_id, term, count(*) * any_value(idf) AS w FROM words JOIN idf USING (term) GROUP BY doc_id, term),
      sums AS (SELECT doc_id, sum(w) / sqrt(sum(w * w)) AS total FROM weights GROUP BY doc_id)
      SELECT conv_id, turn, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS dim, {_dec("coalesce(total, 0)")} AS total
      FROM conversations LEFT JOIN sums ON doc_id = conv_id * 1000 + turn""",
    "token_ids_padded": f"""WITH {_top('documents', 'text', 'doc_id', 30520)}, ids AS (
        SELECT term, row_number() OVER (ORDER BY corpus_count DESC, term) + 1 AS token_id FROM vocab),
      cut AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM (
        SELECT doc_id, regexp_extract_all(lower(text), '{_WORD}')[1:64] AS w FROM documents)),
      per_doc AS (SELECT doc_id, list(coalesce(token_id, 1) ORDER BY pos) AS ids
        FROM cut LEFT JOIN ids USING (term) GROUP BY doc_id),
      filled AS (SELECT doc_id, coalesce(ids, []) AS ids FROM documents LEFT JOIN per_doc USING (doc_id))
      SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(64 - len(ids)), lambda x: 0)), ',') AS input_ids,
        array_to_string(list_transform(range(64), lambda x: CASE WHEN x < len(ids) THEN 1 ELSE 0 END), ',') AS attention_mask
      FROM filled""",
    "split_80_20": """SELECT doc_id, floor(((((doc_id + 42) % 2147483648) * 2654435761) % 4294967296) * 100 / 4294967296.0) < 80
      AS is_train FROM documents""",
    "split_tail10": """SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 >= floor((SELECT count(*) FROM documents) * 0.9)
      AS is_validation FROM documents""",
    "nearest_centroid": f"""WITH {_CENTERS} SELECT vec_id, cluster, {_dec("d")} AS anomaly_score, d > 0.5 AS is_anomaly FROM nearest""",
    "centroid_distance": f"""WITH {_CENTERS} SELECT vec_id, cluster, {_dec("d")} AS distance FROM distances WHERE cluster = label""",
    "cluster_sizes": f"WITH {_CENTERS} SELECT cluster, count(*) AS n FROM nearest GROUP BY cluster",
    "inertia": f"""WITH {_CENTERS} SELECT {_dec("sum(d * d)", 4)} AS inertia FROM nearest""",
    "silhouette_exact": _silhouette("list_distance(a.e, b.e)"),
    "silhouette_squared": _silhouette("pow(list_distance(a.e, b.e), 2)"),
    "reconstruction_mse": f"""WITH {_CENTERS} SELECT vec_id, {_dec("d * d / 64", 9)} AS mse FROM distances WHERE cluster = label""",
    "contamination_cut": f"""SELECT CAST(p AS DECIMAL(18, 2)) AS p, {_dec("cut", 4)} AS cut FROM (
      SELECT unnest([0.01, 0.05, 0.1]) AS p, unnest(quantile_cont(l_extendedprice, [0.01, 0.05, 0.1])) AS cut FROM lineitem)""",
    "iforest_stump_scores": f"WITH {_STUMPS} SELECT vec_id, {_dec('score + 0.43')} AS anomaly_score, score + 0.43 < 0 AS is_anomaly FROM scored",
    "iforest_stump_mean": f"WITH {_STUMPS} SELECT {_dec('avg(-(score + 0.43))')} AS mean_score FROM scored",
    "network_errors": f"""WITH x AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(64)) AS i FROM embeddings),
      latent AS (SELECT vec_id, greatest(0, sum(x * (i % 5 - 2) / 8.0) + 0.25) AS a,
        greatest(0, sum(x * ((i + 3) % 5 - 2) / 8.0) + 0.125) AS b FROM x GROUP BY vec_id),
      outs AS (SELECT vec_id, a, b, x, 1 / (1 + exp(-(a * (i % 7 - 3) / 8.0 + b * ((i + 2) % 7 - 3) / 8.0))) AS y
        FROM x JOIN latent USING (vec_id))
      SELECT vec_id, {_dec("any_value(a)")} AS latent_0, {_dec("any_value(b)")} AS latent_1,
        {_dec("avg((x - y) * (x - y))")} AS error FROM outs GROUP BY vec_id""",
    "score_windows_given_centers": f"""WITH {_top('conversations', 'text', 'conv_id * 1000 + turn')},
      tf AS (SELECT doc_id, term, count(*) * any_value(idf) AS w FROM words JOIN idf USING (term) GROUP BY doc_id, term),
      unit AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM tf),
      roles AS (SELECT conv_id * 1000 + turn AS doc_id, CASE WHEN role = 'user' THEN 0 ELSE 1 END AS cluster FROM conversations),
      sizes AS (SELECT cluster, count(*) AS n FROM roles GROUP BY cluster),
      centers AS (SELECT cluster, term, sum(w) / any_value(n) AS c FROM unit JOIN roles USING (doc_id)
        JOIN sizes USING (cluster) GROUP BY cluster, term),
      squares AS (SELECT cluster, sum(c * c) AS cc FROM centers GROUP BY cluster),
      wins AS (SELECT * FROM (SELECT conv_id, turn, text, count(*) OVER w AS n,
          string_agg(text, ' ') OVER w AS sequence FROM conversations
          WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) WHERE n = 3),
      win_words AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(sequence), '{_WORD}')) AS term FROM wins),
      win_tf AS (SELECT conv_id, turn, term, count(*) * any_value(idf) AS w FROM win_words JOIN idf USING (term) GROUP BY ALL),
      win_unit AS (SELECT conv_id, turn, term, w / sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)) AS w FROM win_tf),
      dots AS (SELECT conv_id, turn, cluster, sum(w * c) AS xc FROM win_unit JOIN centers USING (term) GROUP BY ALL),
      lengths AS (SELECT conv_id, turn, sum(w * w) AS xx FROM win_unit GROUP BY ALL),
      far AS (SELECT w.conv_id, w.turn, w.text, s.cluster,
          sqrt(greatest(0, coalesce(xx, 0) - 2 * coalesce(xc, 0) + cc)) AS d
        FROM wins w CROSS JOIN squares s LEFT JOIN lengths USING (conv_id, turn)
        LEFT JOIN dots ON dots.conv_id = w.conv_id AND dots.turn = w.turn AND dots.cluster = s.cluster)
      SELECT conv_id, turn AS line_no, md5(any_value(text)) AS window_start_line, arg_min(cluster, d) AS cluster,
        {_dec("min(d)")} AS anomaly_score, min(d) > 0.5 AS is_anomaly FROM far GROUP BY conv_id, turn""",
    "feature_covariance": """WITH places AS (
      SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(64)) AS pos FROM embeddings)
    SELECT CAST(a.pos AS INTEGER) AS i, CAST(b.pos AS INTEGER) AS j, CAST(round(covar_pop(a.x, b.x), 6) AS DECIMAL(18, 6)) AS covariance
    FROM places a JOIN places b USING (vec_id) GROUP BY ALL""",
    "best_setting": """WITH means AS (
      SELECT o_orderpriority, o_orderstatus, avg(o_totalprice) AS price FROM orders GROUP BY ALL)
    SELECT o_orderpriority, o_orderstatus, CAST(round(price, 4) AS DECIMAL(18, 4)) AS score,
      (SELECT CAST(count(*) AS INTEGER) FROM means) AS n_settings
    FROM means ORDER BY price DESC LIMIT 1""",
    "early_stop_epoch": f"""WITH {_LOSSES}, marked AS (
        SELECT epoch, val_loss, coalesce(val_loss < min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS is_new FROM losses),
      waited AS (SELECT *, epoch - max(CASE WHEN is_new THEN epoch END) OVER (ORDER BY epoch) AS waiting FROM marked),
      stop AS (SELECT coalesce(min(epoch) FILTER (waiting >= 5), max(epoch)) AS stop_epoch FROM waited)
      SELECT stop_epoch, epoch AS best_epoch, {_dec("val_loss", 4)} AS best_loss FROM waited, stop
      WHERE epoch <= stop_epoch ORDER BY val_loss, epoch LIMIT 1""",
    "best_run": f"""SELECT run_no, {_dec("score", 2)} AS score, n FROM (
      SELECT o_custkey % 50 AS run_no, round(avg(o_totalprice), 2) AS score, count(*) AS n FROM orders GROUP BY run_no)
      ORDER BY score DESC, run_no LIMIT 1""",
    "loss_curve": f"""WITH {_LOSSES} SELECT 'run' AS run_id, epoch AS step, {_dec("train_loss")} AS train_loss,
      {_dec("val_loss")} AS val_loss FROM losses""",
}

ORACLE["mine_templates_in_pieces"] = ORACLE["mine_document_templates"]
ORACLE["anomaly_payload"] = f"""SELECT conv_id, line_no, md5(payload) AS payload
  FROM ({ORACLE['score_windows_given_centers']}) scored JOIN ({_windows(
    "conversations", "conv_id", "turn", "text", 3,
    "conv_id, turn AS line_no, CAST(to_json({'anomaly_line': win[1], 'log_window': win}) AS VARCHAR) AS payload",
)}) lists USING (conv_id, line_no) WHERE is_anomaly"""

_TURN_WINDOWS = """wins AS (SELECT * FROM (SELECT conv_id, turn, text, count(*) OVER w AS n,
    string_agg(unit, ' ') OVER w AS sequence FROM {units}
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) WHERE n = 3),
  win_words AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(sequence), '""" + _WORD + """')) AS term FROM wins)"""

ORACLE["score_forest_given_stumps"] = f"""WITH {_top('conversations', 'text', 'conv_id * 1000 + turn')},
  {_TURN_WINDOWS.replace("{units}", "(SELECT *, text AS unit FROM conversations)")},
  asked AS (SELECT term, (row_number() OVER (ORDER BY term) - 1) / 4 AS t FROM vocab),
  has AS (SELECT DISTINCT conv_id, turn, CAST(t AS INTEGER) AS t FROM win_words JOIN asked USING (term) WHERE t = floor(t) AND t < 16),
  paths AS (SELECT conv_id, turn, text, CASE WHEN has.t IS NULL THEN 40 + s.t ELSE 216 - s.t END AS n
    FROM wins CROSS JOIN (SELECT unnest(range(16))::INTEGER AS t) s LEFT JOIN has USING (conv_id, turn, t)),
  scored AS (SELECT conv_id, turn, any_value(text) AS text,
    -pow(2, -avg(1 + 2 * (ln(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n)
      / (2 * (ln(255) + 0.5772156649015329) - 2.0 * 255 / 256)) + 0.43 AS score FROM paths GROUP BY conv_id, turn)
  SELECT conv_id, turn AS line_no, md5(text) AS window_start_line, {_dec("score")} AS anomaly_score,
    score < 0 AS is_anomaly FROM scored"""

ORACLE["score_encoder_learning"] = f"""WITH {_LEARNED}, {_top('conversations', 'text', 'conv_id * 1000 + turn')},
  units AS (SELECT conv_id, turn, text, template AS unit FROM (SELECT *, {_shape('text')} AS shape FROM conversations)
    LEFT JOIN learned ON n_tokens = len(string_split(shape, ' ')) AND first_token = string_split(shape, ' ')[1]),
  {_TURN_WINDOWS.replace("{units}", "units")},
  places AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS i FROM vocab),
  tf AS (SELECT conv_id, turn, term, count(*) * any_value(idf) AS w FROM win_words JOIN idf USING (term) GROUP BY ALL),
  x AS (SELECT conv_id, turn, i, w / sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)) AS x FROM tf JOIN places USING (term)),
  latent AS (SELECT conv_id, turn, any_value(text) AS text,
      greatest(0, coalesce(sum(x * (i % 5 - 2) / 8.0), 0) + 0.25) AS a,
      greatest(0, coalesce(sum(x * ((i + 3) % 5 - 2) / 8.0), 0) + 0.125) AS b
    FROM wins LEFT JOIN x USING (conv_id, turn) GROUP BY conv_id, turn),
  errors AS (SELECT conv_id, turn, avg(pow(coalesce(x, 0)
      - 1 / (1 + exp(-(a * (i % 7 - 3) / 8.0 + b * ((i + 2) % 7 - 3) / 8.0))), 2)) AS e
    FROM latent CROSS JOIN places LEFT JOIN x USING (conv_id, turn, i) GROUP BY conv_id, turn)
  SELECT conv_id, conv_id * 1000 + turn AS line_no, md5(text) AS log_window_start, {_dec("e")} AS anomaly_score,
    CASE WHEN a * a + b * b <= pow(a - 0.5, 2) + pow(b - 0.5, 2) THEN 0 ELSE 1 END AS cluster
  FROM latent JOIN errors USING (conv_id, turn)"""

ORACLE["model_roundtrip"] = f"""WITH {_PARSED}, upload AS (
    SELECT source AS file, message, row_number() OVER (PARTITION BY source ORDER BY line_no) - 1 AS line_no,
      count(*) OVER (PARTITION BY source) AS n FROM parsed WHERE message IS NOT NULL)
  SELECT file, line_no, message AS window_start_line, true AS same FROM upload WHERE line_no + 10 <= n"""

ORACLE["stream_score"] = f"""WITH {_LINES}, n AS (SELECT count(*) AS n FROM lines), arriving AS (
    SELECT value, line_no AS place, CAST(line_no >= n // 3 AS INTEGER) + CAST(line_no >= n * 2 // 3 AS INTEGER) AS file FROM lines, n),
  upload AS (SELECT value, row_number() OVER (PARTITION BY file ORDER BY place) - 1 AS line_no,
    count(*) OVER (PARTITION BY file) AS n FROM arriving)
  SELECT line_no, value AS window_start_line, true AS same FROM upload WHERE line_no + 10 <= n"""

ORACLE["forest_roundtrip"] = ORACLE["score_forest_given_stumps"]
ORACLE["normal_windows_given_stumps"] = f"SELECT * FROM ({ORACLE['score_forest_given_stumps'].replace('+ 0.43', '+ 0.57')}) scored WHERE NOT is_anomaly"
_ORDER_RUNS = """means AS (
  SELECT o_orderstatus AS kind, o_orderstatus || '/' || (o_custkey % 7) AS run_id, o_custkey % 7 AS no,
    round(avg(o_totalprice), 2) AS price, count(*) AS n FROM orders GROUP BY ALL)"""
ORACLE["run_log_written"] = f"""WITH {_ORDER_RUNS}
  SELECT run_id, 'param' AS kind, 'n_orders' AS key, CAST(n AS VARCHAR) AS value FROM means
  UNION ALL SELECT run_id, 'metric', 'mean_price', CAST(price AS VARCHAR) FROM means
  UNION ALL SELECT run_id, 'tag', 'model_path', run_id FROM means"""
ORACLE["best_over_kinds"] = f"""WITH {_ORDER_RUNS}, best AS (
  SELECT * FROM means QUALIFY row_number() OVER (PARTITION BY kind ORDER BY price DESC, no) = 1),
spread AS (SELECT kind, avg(price) AS mean, stddev_pop(price) AS deviation, count(*) AS n_runs FROM means GROUP BY kind)
  SELECT kind, run_id, {_dec("price", 2)} AS score, {_dec("lead")} AS lead
  FROM (SELECT *, CASE WHEN deviation > 0 THEN (price - mean) / deviation ELSE 0 END AS lead FROM best JOIN spread USING (kind))
  ORDER BY lead DESC, n_runs DESC, kind LIMIT 1"""
ORACLE["one_day_of_log"] = f"""WITH {_PARSED}, days AS (
  SELECT *, CAST(TRY_CAST("timestamp" AS TIMESTAMP) AS DATE) AS day FROM parsed), last_day AS (SELECT max(day) AS last FROM days)
  SELECT line_no, level, message, CAST(day AS VARCHAR) AS day,
    (SELECT count(*) FROM days) - (SELECT count(*) FROM days, last_day WHERE day = last AND level = 'ERROR') AS n_all
  FROM days, last_day WHERE day = last AND level <> 'ERROR'"""
