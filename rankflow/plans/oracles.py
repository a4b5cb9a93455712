"""SQL for another engine, written independently of the operators, one text per query."""

from __future__ import annotations

from rankflow.functions.hashing import INCREMENT, MIXERS, MODULUS, MULTIPLIER
from rankflow.functions.permutation import HALF_ROUNDS, SHIFT, round_key
from rankflow.operators.metrics import PREDICTION_BUCKETS, PREDICTION_GROWTH, PREDICTION_LEAST
from rankflow.operators.pagerank import DAMPING, ITERATIONS
from rankflow.plans import graph as G
from rankflow.plans import learning as N
from rankflow.plans.tables import CLASSES, RAW_LINK_SQL, SIDE, WIDTH


def _key(column: str, seed: str = "0") -> str:
    factor = f"(({MULTIPLIER} * (2 * ({seed})::BIGINT + 1)) % {MODULUS})"
    key = f"((({column}::BIGINT % {MODULUS}) * {factor} + {INCREMENT}) % {MODULUS})"
    for mixer in MIXERS:
        key = f"((xor({key}, {key} >> 16) * {mixer}) % {MODULUS})"
    return f"xor({key}, {key} >> 15)"


def _feed(table: str, key: str, batch: str, seeds: list[int], columns: str = "") -> list[str]:
    """CTEs up to ``o<seed>(key, columns, pos)``: the place of each row in an epoch's order, stripe by stripe.

    ``batch`` is an expression over ``n``, the number of rows; stripes cut it into at least 64 equal parts.
    """
    parts = [
        f"fn AS MATERIALIZED (SELECT n, {batch} AS batch FROM (SELECT count(*) AS n FROM {table}))",
        """fs AS MATERIALIZED (SELECT n, coalesce((SELECT max(d) FROM (SELECT unnest(range(1, batch // 64 + 1)) AS d, batch FROM fn)
          WHERE batch % d = 0), 1) AS s FROM fn)""",
        """fg AS MATERIALIZED (SELECT m, s, a, (m + a - 1) // a AS b FROM (SELECT m, s, unnest(range(
            greatest(1, least(2, m), floor(sqrt(m))::BIGINT // 2), 2 * floor(sqrt(m))::BIGINT + 2)) AS a
            FROM (SELECT n // s AS m, s FROM fs))
          ORDER BY a * ((m + a - 1) // a) - m, a LIMIT 1)""",
        f"""base AS MATERIALIZED (SELECT {key}{columns}, row_number() OVER (ORDER BY {_key(key)}, {key}) - 1 AS p FROM {table})""",
    ]
    for seed in seeds:
        cells = "SELECT m, s, a, b, v, v // b AS l, v % b AS r FROM (SELECT *, unnest(range(0, a * b)) AS v FROM fg)"
        for i in range(HALF_ROUNDS):
            fixed, left, right = ("r", f"(l + ((y * y) >> {SHIFT})) % a", "r") if i % 2 == 0 else (
                "l", "l", f"(r + ((y * y) >> {SHIFT})) % b")
            cells = f"""SELECT m, s, a, b, v, {left} AS l, {right} AS r FROM (
              SELECT *, ({fixed} * {MULTIPLIER} + {round_key(seed, i)}) % {MODULUS} AS y FROM ({cells}))"""
        parts += [
            f"e{seed} AS MATERIALIZED (SELECT m, s, v, l * b + r AS e FROM ({cells}))",
            f"""k{seed} AS (SELECT m, s, v, e FROM e{seed} WHERE v < m
              UNION ALL SELECT k.m, k.s, k.v, x.e FROM k{seed} k JOIN e{seed} x ON x.v = k.e WHERE k.e >= k.m)""",
            f"""o{seed} AS MATERIALIZED (SELECT {key}{columns}, e * s + p % s AS pos
              FROM base JOIN (SELECT * FROM k{seed} WHERE e < m) ON v = p // (SELECT s FROM fs))""",
        ]
    return parts


# --- graph -----------------------------------------------------------------------------------


def _trade(broken: bool = False) -> str:
    suppliers = "WHERE l_partkey % 7 <> 0" if broken else ""
    orders = "WHERE l_orderkey % 5 <> 0" if broken else ""
    return f"""
      SELECT 'o' || l_orderkey AS src, 'p' || l_partkey AS dst FROM lineitem
      UNION ALL SELECT 'p' || l_partkey, 's' || l_suppkey FROM lineitem {suppliers}
      UNION ALL SELECT 's' || l_suppkey, 'o' || l_orderkey FROM lineitem {orders}"""


def _ranks(broken: bool = False, only_left: bool = False, keep: bool = False) -> str:
    parts = [
        f"e AS MATERIALIZED ({_trade(broken)})",
        "d AS MATERIALIZED (SELECT src, count(*) AS deg FROM e GROUP BY src)",
        "r0 AS MATERIALIZED (SELECT src AS node, 1.0::DOUBLE AS rank FROM d)",
    ]
    for i in range(1, ITERATIONS + 1):
        sent = f"""SELECT e.dst AS node, r.rank / d.deg AS part
            FROM e JOIN r{i - 1} r ON r.node = e.src JOIN d ON d.src = e.src"""
        if keep:
            sent += f" UNION ALL SELECT r.node, 0.0 FROM r{i - 1} r JOIN d ON d.src = r.node"
        parts.append(
            f"r{i} AS MATERIALIZED (SELECT node, {1 - DAMPING} + {DAMPING} * sum(part) AS rank"
            f" FROM ({sent}) GROUP BY node)"
        )
    where = "WHERE node IN (SELECT src FROM d)" if only_left else ""
    return f"WITH {', '.join(parts)} SELECT node, round(rank, 6) AS rank FROM r{ITERATIONS} {where}"


ADJACENCY = f"""
WITH e AS (SELECT src, dst, count(*) AS w FROM ({_trade()}) GROUP BY src, dst),
n AS (SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {G.ADJACENCY_QUERY_ENTRIES} AS chunk FROM e)
SELECT src, chunk, string_agg(dst || ':' || w, ',' ORDER BY dst) AS dsts, sum(w)::BIGINT AS size
FROM n GROUP BY src, chunk"""

PARSE_EDGES = f"""
WITH lines AS (SELECT {RAW_LINK_SQL} AS value FROM orders),
fields AS (
  SELECT list_transform(
    list_filter(
      list_transform(regexp_split_to_array(value, '\\t+'),
        lambda x: regexp_replace(x, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')),
      lambda x: x <> ''),
    lambda x: lower(x)) AS f
  FROM lines WHERE NOT starts_with(value, '#'))
SELECT f[1] AS src, f[2] AS dst FROM fields
WHERE len(f) = 2
  AND (NOT contains(f[1], ':') OR starts_with(f[1], 'category:'))
  AND (NOT contains(f[2], ':') OR starts_with(f[2], 'category:'))"""

CUSTOMER_LINES = (
    "SELECT c_custkey || chr(9) || c_name || chr(9) || c_mktsegment AS value FROM customer"
)
SUPPLIER_LINES = "SELECT s_nationkey || chr(9) || s_name AS value FROM supplier"
ORDER_TABLE = """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey,
  nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority || ', ' || o_orderstatus AS o_orderpriority
FROM orders"""


def _graph() -> dict[str, str]:
    plain = _ranks()
    return {
        "pagerank_naive": plain,
        "pagerank_adjacency": plain,
        "pagerank_hash_partition": plain,
        "pagerank_range_partition": _ranks(only_left=True),
        "pagerank_cached": plain,
        "pagerank_hash_edges": plain,
        "pagerank_only_left": _ranks(broken=True, only_left=True),
        "pagerank_keep_zero": _ranks(broken=True, keep=True),
        "out_degree": f"SELECT src, count(*) AS out_degree FROM ({_trade()}) GROUP BY src",
        "adjacency": ADJACENCY,
        "initial_ranks": f"SELECT DISTINCT src AS node, 1.0::DOUBLE AS rank FROM ({_trade()})",
        "parse_edges": PARSE_EDGES,
        "text_scan": CUSTOMER_LINES,
        "union_sources": f"{CUSTOMER_LINES} UNION ALL {SUPPLIER_LINES} UNION ALL {CUSTOMER_LINES}",
        "csv_scan": ORDER_TABLE,
        "ranks_sink": f"""
            SELECT '(' || src || ',' || count(*) || ')' AS value FROM ({_trade()}) GROUP BY src""",
        "table_sink": """
            SELECT 0 AS position, 'event_id,user_id,event_type' AS value UNION ALL
            SELECT row_number() OVER (ORDER BY event_type, user_id, event_id), event_id || ',' || user_id || ',' || event_type
            FROM events""",
        "file_headers": """
            SELECT CASE WHEN c_custkey % 50 = 0 THEN 'key_' || c_custkey % 3 ELSE c_custkey::VARCHAR END AS field_0,
              CASE WHEN c_custkey % 50 = 0 THEN 'name_' || c_custkey % 3 ELSE c_name END AS field_1,
              field_0 || ',' || field_1 AS field_2 FROM customer""",
        "lines_sink": f"""
            SELECT row_number() OVER (ORDER BY o_orderstatus NULLS FIRST, o_orderkey) - 1 AS position,
              o_orderkey || ',' || o_custkey || ',' || coalesce(o_orderstatus, '') || ',"' || o_orderpriority || '"' AS value
            FROM ({ORDER_TABLE})""",
        "short_rows": """
            SELECT c_custkey::VARCHAR AS key, c_name AS name,
              CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment FROM customer""",
        "sort_two_keys": """
            SELECT row_number() OVER (ORDER BY event_type, ts, event_id) - 1 AS position,
              event_type, event_id FROM events""",
        "sort_positional": f"""
            SELECT row_number() OVER (ORDER BY o_orderstatus NULLS FIRST, o_orderpriority, o_orderkey) - 1
              AS position, o_orderstatus, o_orderpriority, o_orderkey FROM ({ORDER_TABLE})""",
    }


# --- splits and labels -----------------------------------------------------------------------


def _split(source: str, columns: str) -> str:
    return f"""
      SELECT {columns}, CASE WHEN row_number() OVER (ORDER BY {_key('doc_id')}, doc_id) <= 350
        THEN 'validation' ELSE 'train' END AS split FROM {source}"""


def _sharded(source: str, columns: str) -> str:
    return f"""
      SELECT {columns}, split,
        ((row_number() OVER (PARTITION BY split ORDER BY {_key('doc_id')}, doc_id) - 1)
          // ceil(count(*) OVER (PARTITION BY split) / 5.0)::BIGINT)::INT AS shard
      FROM ({_split(source, columns)})"""


RECORDS = """(SELECT doc_id, text AS content, nullif(lang, 'en') AS format,
  nullif(doc_id % 5, 0) AS label FROM documents)"""


def _splits() -> dict[str, str]:
    epochs = " UNION ALL ".join(f"SELECT vec_id, {epoch} AS epoch, pos AS position FROM o{epoch}" for epoch in range(3))
    return {
        "train_valid_split": _split("labels", "doc_id"),
        "epoch_batches": f"""
            WITH RECURSIVE {', '.join(_feed('embeddings', 'vec_id', '1', [0, 1, 2]))}
            SELECT vec_id, epoch, position, position // 64 AS batch FROM ({epochs})
            WHERE position // 64 < (SELECT count(*) // 64 FROM embeddings)""",
        "batch_shard": f"""
            WITH RECURSIVE {', '.join(_feed('documents', 'doc_id', '1', [0]))}
            SELECT doc_id, pos AS position, pos // 64 AS batch, (pos // 64) % 4 AS worker, (pos % 64) // 16 AS replica FROM o0
            WHERE pos // 64 < (SELECT count(*) // 64 // 4 * 4 FROM documents)""",
        "shard_assign": f"""
            SELECT *, printf('flowers_%s_%05d-of-%05d', split, shard, 5) AS shard_file
            FROM ({_sharded('documents', 'doc_id')})""",
        "split_read": f"""
            SELECT doc_id, coalesce(content, '') AS content, coalesce(format, 'png') AS format,
              coalesce(label, 0) AS label, shard
            FROM ({_sharded(RECORDS, 'doc_id, content, format, label')}) WHERE split = 'validation'""",
        "split_counts": f"""
            SELECT split, count(*) AS rows, count(DISTINCT lang) AS classes
            FROM ({_split('documents', 'doc_id, lang')}) GROUP BY split""",
        "class_ids": """
            SELECT o_orderkey, o_orderpriority,
              dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS class_id FROM orders""",
        "dictionary_build": """
            SELECT 0 AS label, 'background' AS name UNION ALL
            SELECT row_number() OVER (ORDER BY p_partkey), p_name FROM part WHERE p_size <= 25""",
        "class_ids_null": """
            WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders),
            c AS (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS class_id
              FROM (SELECT DISTINCT o_orderpriority FROM o WHERE o_orderpriority IS NOT NULL))
            SELECT o_orderkey, o.o_orderpriority, class_id::INT AS class_id FROM o LEFT JOIN c USING (o_orderpriority)""",
        "label_map_fallback": "SELECT p_partkey AS label, p_brand || ':' || p_type AS name FROM part",
        "class_folders": """
            SELECT lang AS class, sum(octet_length(encode(line)) + 1)::BIGINT AS bytes, count(*) AS lines,
              sum(('0x' || substr(md5(line), 1, 8))::BIGINT)::BIGINT AS digest
            FROM (SELECT lang, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY lang""",
        "label_map_format": """
            SELECT p_partkey || ':' || p_brand || ':' || p_type AS value FROM part""",
        "label_map_read": "SELECT p_partkey AS label, p_brand || ':' || p_type AS name FROM part",
    }


# --- vectors ---------------------------------------------------------------------------------

VALUES = """(SELECT vec_id, label, j, embedding[j + 1]::DOUBLE AS value
  FROM embeddings, range(len(embedding)) AS t(j))"""

FIXED = f"(SELECT j, k, sin(j * {CLASSES} + k + 1) AS w FROM range({WIDTH}) a(j), range({CLASSES}) b(k))"

SCORES = f"""
z AS MATERIALIZED (SELECT v.vec_id, v.label, f.k, sum(v.value * f.w) AS z
  FROM {VALUES} v JOIN {FIXED} f ON f.j = v.j GROUP BY v.vec_id, v.label, f.k),
m AS MATERIALIZED (SELECT vec_id, max(z) AS top, sum(exp(z)) AS total FROM z GROUP BY vec_id),
p AS MATERIALIZED (SELECT z.*, m.top, exp(z.z) / m.total AS p FROM z JOIN m ON m.vec_id = z.vec_id)"""


LABELLED = "vec_id % 5 <> 0 AND vec_id % 7 <> 0"


def _top_hits(k: int, extra: str = "vec_id") -> str:
    return f"""
      SELECT own.{extra}, (count(*) FILTER (WHERE other.z > own.z) < {k})::INT AS hit
      FROM z own JOIN z other ON other.vec_id = own.vec_id WHERE own.k = own.label GROUP BY own.vec_id"""


def _vectors() -> dict[str, str]:
    boxes = ", ".join(
        f"round(embedding[{1 + i * N.BOXES} + j]::DOUBLE, 6) + 0.0 AS {name}"
        for i, name in enumerate(("ymin", "xmin", "ymax", "xmax"))
    )
    height, width = N.CROP
    crop_h, pad_h = max(SIDE - height, 0) // 2, max(height - SIDE, 0) // 2
    crop_w, pad_w = max(SIDE - width, 0) // 2, max(width - SIDE, 0) // 2
    return {
        "zip_boxes": f"""
            SELECT vec_id, j AS object, {boxes} FROM embeddings, range({N.BOXES}) AS t(j)""",
        "one_hot": f"""
            SELECT vec_id, label,
              array_to_string([CASE WHEN k = label THEN 1 ELSE 0 END FOR k IN range({CLASSES})], ',') AS one_hot
            FROM embeddings""",
        "standardize_rows": f"""
            SELECT vec_id, j AS cell, round((value - mean) / greatest(sd, 1 / sqrt(n)), 6) + 0.0 AS value
            FROM {VALUES} JOIN (SELECT vec_id AS id, avg(value) AS mean, stddev_pop(value) AS sd, count(*) AS n
              FROM {VALUES} GROUP BY vec_id) ON id = vec_id""",
        "crop_or_pad": f"""
            WITH cells AS (SELECT c AS cell, c // {width} + {crop_h - pad_h} AS y, c % {width} + {crop_w - pad_w} AS x
              FROM range({height * width}) AS t(c))
            SELECT vec_id, cell, round(CASE WHEN y BETWEEN 0 AND {SIDE - 1} AND x BETWEEN 0 AND {SIDE - 1}
              THEN embedding[y * {SIDE} + x + 1]::DOUBLE ELSE 0.0 END, 6) + 0.0 AS value
            FROM embeddings, cells""",
        "variable_summary": f"""
            SELECT round(avg(value), 6) + 0.0 AS mean, round(stddev_pop(value), 6) + 0.0 AS stddev,
              round(max(value), 6) + 0.0 AS max, round(min(value), 6) + 0.0 AS min FROM {VALUES}""",
        "histogram": f"""
            WITH v AS MATERIALIZED (SELECT value FROM {VALUES}),
            s AS (SELECT min(value) AS lo, (max(value) - min(value)) / {N.HISTOGRAM_BUCKETS} AS width FROM v),
            b AS (SELECT least(floor((value - lo) / width), {N.HISTOGRAM_BUCKETS - 1})::INT AS bucket, lo, width FROM v, s)
            SELECT bucket, round(lo + bucket * width, 6) + 0.0 AS low,
              round(lo + (bucket + 1) * width, 6) + 0.0 AS high, count(*) AS rows
            FROM b GROUP BY bucket, lo, width""",
        "l2_term": f"""
            SELECT label, round({N.DECAY} * sum(value * value) / 2, 6) + 0.0 AS l2 FROM {VALUES} GROUP BY label""",
        "predict": f"""
            WITH {SCORES}
            SELECT vec_id, min(k) FILTER (WHERE z = top)::INT AS predicted, round(max(p), 6) AS probability
            FROM p GROUP BY vec_id""",
        "softmax_loss": f"""
            WITH {SCORES} SELECT round(avg(-ln(p)), 6) + 0.0 AS loss FROM p WHERE k = label""",
        "softmax_loss_l2": f"""
            WITH {SCORES}
            SELECT round(avg(-ln(p)) + (SELECT {N.DECAY} * sum(w * w) / 2 FROM {FIXED}), 6) + 0.0 AS loss
            FROM p WHERE k = label""",
        "accuracy": f"""
            WITH {SCORES}, best AS (SELECT vec_id, min(k) FILTER (WHERE z = top) AS k, min(label) AS label FROM p GROUP BY vec_id)
            SELECT round(avg((k = label)::INT), 6) + 0.0 AS accuracy FROM best""",
        "precision_at_k": f"""
            WITH {SCORES}, hits AS ({_top_hits(N.PRECISION_K)})
            SELECT sum(hit)::BIGINT AS correct, count(*) AS rows,
              round(sum(hit) / count(*), 6) + 0.0 AS precision FROM hits""",
        "checkpoint_precision": f"""
            WITH {SCORES}, hits AS ({_top_hits(1)})
            SELECT sum(hit)::BIGINT AS correct, count(*) AS rows,
              round(sum(hit) / count(*), 6) + 0.0 AS precision FROM hits""",
        "unlabelled_metrics": f"""
            WITH {SCORES}, hits AS ({_top_hits(N.PRECISION_K)}),
            best AS (SELECT vec_id, min(k) FILTER (WHERE z = top) AS k, min(label) AS label FROM p GROUP BY vec_id)
            SELECT 'loss' AS name, round(avg(-ln(p)), 6) + 0.0 AS value FROM p WHERE k = label AND {LABELLED}
            UNION ALL SELECT 'accuracy', round(avg((k = label)::INT), 6) + 0.0 FROM best WHERE {LABELLED}
            UNION ALL SELECT 'precision', round(sum(hit) / count(*), 6) + 0.0 FROM hits WHERE {LABELLED}
            UNION ALL SELECT 'rows', count(*)::DOUBLE FROM hits WHERE {LABELLED}""",
        "running_precision": f"""
            WITH {SCORES}, hits AS ({_top_hits(1)}),
            b AS (SELECT vec_id // {N.PRECISION_BATCH} AS batch, sum(hit)::BIGINT AS correct, count(*) AS rows
              FROM hits GROUP BY batch)
            SELECT batch, correct, rows,
              round(sum(correct) OVER (ORDER BY batch) / sum(rows) OVER (ORDER BY batch), 6) + 0.0 AS precision
            FROM b""",
    }


# --- training --------------------------------------------------------------------------------

# Rows with a constant input 1 at j = WIDTH, whose weights are the biases.
INPUTS = f"""
x AS MATERIALIZED (SELECT vec_id, j, value AS v FROM {VALUES}
  UNION ALL SELECT vec_id, {WIDTH}, 1.0 FROM embeddings)"""

NAMED = f"""CASE WHEN j = {WIDTH} THEN 'biases' ELSE 'weights' END AS name,
  CASE WHEN j = {WIDTH} THEN 0 ELSE j END AS row, k AS col"""

START = f"SELECT j, k, 0.0::DOUBLE AS w FROM range({WIDTH + 1}) a(j), range({CLASSES}) b(k)"


def _gradient(tag: str, params: str, rows: str) -> list[str]:
    """CTEs up to ``g_<tag>(j, k, g)``, the mean gradient over the rows named by a query."""
    return [
        f"rows_{tag} AS MATERIALIZED ({rows})",
        f"""z_{tag} AS MATERIALIZED (SELECT x.vec_id, q.k, sum(x.v * q.w) AS z FROM x
          JOIN rows_{tag} r ON r.vec_id = x.vec_id JOIN {params} q ON q.j = x.j GROUP BY x.vec_id, q.k)""",
        f"t_{tag} AS MATERIALIZED (SELECT vec_id, sum(exp(z)) AS total FROM z_{tag} GROUP BY vec_id)",
        f"""d_{tag} AS MATERIALIZED (SELECT r.vec_id, z.k, exp(z.z) / t.total - (z.k = r.label)::INT AS d
          FROM rows_{tag} r JOIN z_{tag} z ON z.vec_id = r.vec_id JOIN t_{tag} t ON t.vec_id = r.vec_id)""",
        f"""g_{tag} AS MATERIALIZED (SELECT x.j, d.k, sum(x.v * d.d) / (SELECT count(*) FROM rows_{tag}) AS g
          FROM d_{tag} d JOIN x ON x.vec_id = d.vec_id GROUP BY x.j, d.k)""",
    ]


def _vectors_feed(parts: int, seeds: tuple[int, ...] = (0,)) -> list[str]:
    """Orders of the vectors for batches of ``n // parts`` rows."""
    return _feed("embeddings", "vec_id", f"n // {parts}", list(seeds), ", label")


def _steps(step_rows: list[str], delay: int = 0, prefix: str = "") -> list[str]:
    """CTEs of plain descent with one query of rows per step; a gradient is taken ``delay`` models ago."""
    parts = [f"{prefix}w0 AS MATERIALIZED ({START})"]
    for step, rows in enumerate(step_rows):
        parts += _gradient(f"{prefix}{step}", f"{prefix}w{max(0, step - delay)}", rows)
        parts.append(
            f"""{prefix}w{step + 1} AS MATERIALIZED (SELECT w.j, w.k, w.w - {N.LEARNING_RATE} * g.g AS w
              FROM {prefix}w{step} w JOIN g_{prefix}{step} g ON g.j = w.j AND g.k = w.k)"""
        )
    return parts


def _descent(batches: int, step_rows: list[str], delay: int = 0) -> str:
    parts = [INPUTS, *_vectors_feed(batches), *_steps(step_rows, delay)]
    return f"WITH RECURSIVE {', '.join(parts)} SELECT {NAMED}, round(w, 6) + 0.0 AS value FROM w{len(step_rows)}"


def _step_metrics(batches: int, step_rows: list[str]) -> str:
    """The mean loss, accuracy and histogram of probabilities in each step of plain descent."""
    parts, rows = [INPUTS, *_vectors_feed(batches), *_steps(step_rows)], []
    bucket = f"floor(ln(greatest(exp(z.z) / t.total, {PREDICTION_LEAST}) / {PREDICTION_LEAST}) / ln({PREDICTION_GROWTH}))"
    for step in range(len(step_rows)):
        own = f"""rows_{step} r JOIN z_{step} z ON z.vec_id = r.vec_id JOIN t_{step} t ON t.vec_id = r.vec_id"""
        rows += [
            f"""SELECT {step}::BIGINT AS step, 0 AS epoch, 'loss' AS name, NULL::INT AS bucket,
              round(avg(ln(t.total) - z.z), 6) + 0.0 AS value FROM {own} WHERE z.k = r.label""",
            f"""SELECT {step}, 0, 'accuracy', NULL, round(avg((best = label)::INT), 6) + 0.0
              FROM (SELECT r.vec_id, r.label, min(z.k) FILTER (WHERE z.z = top.z) AS best FROM {own}
                JOIN (SELECT vec_id, max(z) AS z FROM z_{step} GROUP BY vec_id) top ON top.vec_id = r.vec_id
                GROUP BY r.vec_id, r.label)""",
            f"""SELECT {step}, 0, 'prediction', bucket, count(*)::DOUBLE
              FROM (SELECT least({bucket}, {PREDICTION_BUCKETS - 1})::INT AS bucket FROM {own}) GROUP BY bucket""",
        ]
    return f"WITH RECURSIVE {', '.join(parts)} {' UNION ALL '.join(rows)}"


def _sweep() -> str:
    """Two runs of plain descent, with batches of one and of two parts of the rows."""
    steps, parts, ends = N.QUERY_STEPS, [INPUTS, *_vectors_feed(N.QUERY_STEPS)], []
    for run, factor in enumerate(N.SWEEP_FACTORS):
        size = f"({factor} * {_size(steps)})"
        rows = [f"SELECT vec_id, label FROM o0 WHERE pos // {size} = {step}" for step in range(steps // factor)]
        parts += _steps(rows, prefix=f"r{run}_")
        ends.append(f"""SELECT 'batch_' || {size} AS run, {NAMED}, round(w, 6) + 0.0 AS value FROM r{run}_w{len(rows)}""")
    return f"WITH RECURSIVE {', '.join(parts)} {' UNION ALL '.join(ends)}"


RANDOM_INIT = f"""
WITH c AS (SELECT DISTINCT j AS row, label AS col FROM {VALUES}),
h AS (SELECT row, col, (row * {CLASSES} + col)::BIGINT AS cell FROM c),
u AS (SELECT row, col, ({_key('cell', str(2 * N.INIT_SEED))} + 1) / {MODULUS}.0 AS a,
  ({_key('cell', str(2 * N.INIT_SEED + 1))} + 1) / {MODULUS}.0 AS b FROM h)
SELECT row, col, round({N.INIT_STDDEV} * sqrt(-2 * ln(a)) * cos(2 * pi() * b), 6) + 0.0 AS value FROM u"""


def _size(parts: int) -> str:
    return f"(SELECT count(*) // {parts} FROM embeddings)"


def _range_rows(step: int, size: str, order: int = 0) -> str:
    return f"SELECT vec_id, label FROM o{order} WHERE pos // {size} = {step}"


def _momentum() -> str:
    steps = N.QUERY_STEPS
    parts = [INPUTS, *_vectors_feed(steps)]
    parts.append(f"w0 AS MATERIALIZED (SELECT *, 0.0::DOUBLE AS v FROM ({START}))")
    for step in range(steps):
        parts += _gradient(str(step), f"w{step}", _range_rows(step, _size(steps)))
        weights = f"0.5 * pow(pow(1.0 / 250, 1.0 / 3), floor({step} / ({steps} / 3.0)))"
        biases = f"1.0 * pow(1.0 / 10, floor({step} / {steps}.0))"
        parts.append(
            f"""v{step} AS MATERIALIZED (SELECT w.j, w.k, w.w,
                0.9 * w.v + g.g + CASE WHEN w.j < {WIDTH} THEN {N.DECAY} * w.w ELSE 0 END AS v
              FROM w{step} w JOIN g_{step} g ON g.j = w.j AND g.k = w.k)"""
        )
        parts.append(
            f"""w{step + 1} AS MATERIALIZED (SELECT j, k,
                w - CASE WHEN j < {WIDTH} THEN {weights} ELSE {biases} END * v AS w, v FROM v{step})"""
        )
    return f"WITH RECURSIVE {', '.join(parts)} SELECT {NAMED}, round(w, 6) + 0.0 AS value FROM w{steps}"


def _local() -> str:
    steps, workers = N.LOCAL_STEPS, N.LOCAL_WORKERS
    parts = [INPUTS, *_vectors_feed(steps * workers)]
    for worker in range(workers):
        parts.append(f"w_{worker}_0 AS MATERIALIZED ({START})")
        for step in range(steps):
            tag = f"{worker}_{step}"
            rows = _range_rows(step * workers + worker, _size(steps * workers))
            parts += _gradient(tag, f"w_{tag}", rows)
            parts.append(
                f"""w_{worker}_{step + 1} AS MATERIALIZED (SELECT w.j, w.k, w.w - {N.LEARNING_RATE} * g.g AS w
                  FROM w_{tag} w JOIN g_{tag} g ON g.j = w.j AND g.k = w.k)"""
            )
    ends = " UNION ALL ".join(f"SELECT * FROM w_{worker}_{steps}" for worker in range(workers))
    return f"""WITH RECURSIVE {', '.join(parts)} SELECT {NAMED}, round(w, 6) + 0.0 AS value
      FROM (SELECT j, k, avg(w) AS w FROM ({ends}) GROUP BY j, k)"""


def _training() -> dict[str, str]:
    steps = N.QUERY_STEPS
    fixed = f"""f AS MATERIALIZED (SELECT j, k, w FROM {FIXED}
      UNION ALL SELECT {WIDTH}, k, 0.0 FROM range({CLASSES}) b(k))"""
    step = ", ".join([INPUTS, fixed, *_gradient("0", "f", "SELECT vec_id, label FROM embeddings")])
    known = f"SELECT vec_id, label FROM embeddings WHERE {LABELLED}"
    known_step = ", ".join([INPUTS, fixed, *_gradient("0", "f", known)])
    return {
        "unlabelled_gradient": f"WITH {known_step} SELECT {NAMED}, round(g, 6) + 0.0 AS value FROM g_0",
        "metrics_table": _step_metrics(steps, [_range_rows(s, _size(steps)) for s in range(steps)]),
        "random_init": RANDOM_INIT,
        "train_sweep": _sweep(),
        "train_delayed": _descent(2 * steps, [_range_rows(s, _size(2 * steps)) for s in range(2 * steps)], N.DELAY),
        "gradient_step": f"WITH {step} SELECT {NAMED}, round(g, 6) + 0.0 AS value FROM g_0",
        "train_minibatch": _descent(steps, [_range_rows(s, _size(steps)) for s in range(steps)]),
        "train_sync": _descent(
            2 * steps,
            [
                f"SELECT vec_id, label FROM o0 WHERE pos // {_size(2 * steps)} // 2 = {s}"
                for s in range(steps)
            ],
        ),
        "train_sync_full_pass": _full_pass(),
        "train_momentum": _momentum(),
        "train_local_sgd": _local(),
    }


def _full_pass() -> str:
    """Each step averages the gradients of two workers, each on a batch of its own order."""
    steps, workers = N.QUERY_STEPS, 2
    parts = [INPUTS, *_vectors_feed(steps, tuple(range(workers)))]
    parts.append(f"w0 AS MATERIALIZED ({START})")
    for step in range(steps):
        for worker in range(workers):
            rows = _range_rows(step, _size(steps), worker)
            parts += _gradient(f"{step}_{worker}", f"w{step}", rows)
        parts.append(
            f"""w{step + 1} AS MATERIALIZED (SELECT w.j, w.k, w.w - {N.LEARNING_RATE} * (a.g + b.g) / 2 AS w
              FROM w{step} w JOIN g_{step}_0 a ON a.j = w.j AND a.k = w.k
              JOIN g_{step}_1 b ON b.j = w.j AND b.k = w.k)"""
        )
    return f"WITH RECURSIVE {', '.join(parts)} SELECT {NAMED}, round(w, 6) + 0.0 AS value FROM w{steps}"


# --- schedules and reports -------------------------------------------------------------------


def _reports() -> dict[str, str]:
    steps = "(SELECT count(*) FROM events)::DOUBLE"
    return {
        "lr_schedule": f"""
            SELECT event_id AS step,
              round(0.001 * pow(pow(1.0 / 250, 1.0 / 3), floor(event_id / ({steps} / 3))), 9) + 0.0 AS weights_rate,
              round(0.002 * pow(0.1, floor(event_id / {steps})), 9) + 0.0 AS biases_rate
            FROM events""",
        "throughput": """
            SELECT round(avg(128.0::DOUBLE / (value + 1)), 6) + 0.0 AS examples_per_s,
              round(avg(value + 1), 6) + 0.0 AS s_per_batch FROM events""",
        "epoch_report": """
            SELECT (event_id // 1000)::INT AS epoch, arg_max(value, event_id) AS value,
              max(event_id * 0.25::DOUBLE) AS elapsed_s FROM events GROUP BY epoch""",
        "latest_checkpoint": """
            WITH m AS (SELECT event_id // 97 * 100 AS step, 'w' || user_id AS name,
              (event_id % 97)::INT AS row, value FROM events)
            SELECT * FROM m WHERE step = (SELECT max(step) FROM m)""",
    }


def sql() -> dict[str, str]:
    return {**_graph(), **_splits(), **_vectors(), **_training(), **_reports()}
