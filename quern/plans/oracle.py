"""The same queries as SQL for DuckDB, for checking."""

from __future__ import annotations

LINES = """lines AS (
  SELECT doc_id, line_no, doc_id * 2147483648 + line_no AS line_id, line FROM (
    SELECT doc_id, unnest(range(len(p))) AS line_no, unnest(p) AS line
    FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)))"""

WORDS = r"""list_filter(list_transform(regexp_split_to_array(lower({}), '[ \t\n\r\f]+'),
    lambda w: regexp_replace(w, '^[^a-z]+|[^a-z]+$', '', 'g')), lambda w: w <> '')"""

RAW = r"list_filter(regexp_split_to_array({}, '[ \t\n\r\f]+'), lambda w: w <> '')"

TOKENS = f"""{LINES}, arrays AS (SELECT line_id, {WORDS.format('line')} AS t FROM lines),
tokens AS (SELECT line_id, unnest(range(len(t))) AS pos, unnest(t) AS token FROM arrays)"""

CUT = f"""{TOKENS}, bags AS (SELECT DISTINCT line_id, token FROM tokens WHERE pos < 40)"""

WHOLE = f"""{TOKENS}, bags AS (SELECT DISTINCT line_id, token FROM tokens)"""

FREQUENCY = "frequency AS (SELECT token, count(*) AS n FROM bags GROUP BY token)"

BIGRAMS = f"""{TOKENS}, bigrams AS (
  SELECT a.token AS left_word, b.token AS right_word, count(*) AS n
  FROM tokens a JOIN tokens b ON a.line_id = b.line_id AND b.pos = a.pos + 1 GROUP BY ALL)"""

WINDOW_PAIRS = f"""{TOKENS}, offsets AS (SELECT unnest([-2, -1, 1, 2]) AS d), pairs AS (
  SELECT a.token AS left_word, b.token AS right_word, count(*) AS n
  FROM (SELECT line_id, pos + d AS at, token FROM tokens, offsets) a
  JOIN tokens b ON a.line_id = b.line_id AND b.pos = a.at GROUP BY ALL)"""

PMI_PAIRS = f"""WITH {CUT}, {FREQUENCY}, pairs AS (
  SELECT a.token AS left_word, b.token AS right_word, count(*) AS n
  FROM bags a JOIN bags b ON a.line_id = b.line_id AND a.token <> b.token
  GROUP BY ALL HAVING count(*) >= 10)
SELECT left_word, right_word,
  round(log10((SELECT count(*) FROM lines)::DOUBLE * p.n / (x.n * y.n)), 6) + 0.0 AS pmi, p.n AS n
FROM pairs p JOIN frequency x ON p.left_word = x.token JOIN frequency y ON p.right_word = y.token"""

STRIPES = """SELECT left_word, count(*) AS n_right, string_agg(right_word || ' ' || p.n || ' ' ||
  round({log}({total}::DOUBLE * p.n / x.n / y.n) * 1000000)::BIGINT, chr(10) ORDER BY right_word) AS stripe
FROM pairs p JOIN frequency x ON p.left_word = x.word JOIN frequency y ON p.right_word = y.word
GROUP BY left_word"""

RELATIVE = """SELECT left_word, right_word,
  round(n::DOUBLE / sum(n) OVER (PARTITION BY left_word), 6) + 0.0 AS frequency FROM bigrams"""

POSTINGS = f"""{TOKENS}, postings AS (
  SELECT token AS term, line_id, count(*)::INT AS tf FROM tokens GROUP BY ALL)"""

BOOLEAN = f"""{TOKENS}, has AS (SELECT DISTINCT token, line_id FROM tokens),
hits AS (
  SELECT 'q1' AS query_id, line_id FROM (
    SELECT line_id FROM has WHERE token = 'the' INTERSECT SELECT line_id FROM has WHERE token = 'of')
  UNION ALL SELECT 'q2', line_id FROM (
    (SELECT line_id FROM has WHERE token = 'der' INTERSECT SELECT line_id FROM has WHERE token = 'und')
    UNION SELECT line_id FROM has WHERE token = 'la')
  UNION ALL SELECT 'q3', line_id FROM (
    SELECT line_id FROM has WHERE token = 'the'
    INTERSECT SELECT line_id FROM has WHERE token IN ('is', 'that')
    INTERSECT SELECT line_id FROM has WHERE token IN ('with', 'this'))
  UNION ALL SELECT 'q4', line_id FROM (
    SELECT line_id FROM has WHERE token = 'zzyzx' INTERSECT SELECT line_id FROM has WHERE token = 'the')
  UNION ALL SELECT 'q5', line_id FROM (SELECT line_id FROM has WHERE token IN ('zzyzx', 'que'))
  UNION ALL SELECT 'q6', line_id FROM has WHERE token = 'was')"""

SOLD = """links AS (
  SELECT {distinct} o_custkey * 3 AS src, l_partkey * 3 + 1 AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT {distinct} l_partkey * 3 + 1, l_suppkey * 3 + 2 FROM lineitem)"""
TRADE = SOLD.format(distinct="DISTINCT")
TRADE_REPEATED = SOLD.format(distinct="")

RECORDS = """nodes AS (
  SELECT c_custkey * 3 AS node_id FROM customer
  UNION ALL SELECT p_partkey * 3 + 1 FROM part {where}
  UNION ALL SELECT s_suppkey * 3 + 2 FROM supplier)"""
NODES = RECORDS.format(where="")
NODES_MISSING = RECORDS.format(where="WHERE p_size <> 1")
NODES_CYCLIC = """nodes AS (
  SELECT c_custkey * 3 AS node_id FROM customer UNION ALL SELECT p_partkey * 3 + 1 FROM part)"""
CYCLIC = """pairs AS (
  SELECT DISTINCT o_custkey * 3 AS c, l_partkey * 3 + 1 AS p
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
links AS (SELECT c AS src, p AS dst FROM pairs UNION ALL SELECT p, c FROM pairs)"""


def _iterations(nodes: str, links: str, steps: int) -> str:
    parts = [
        nodes,
        links,
        "degrees AS (SELECT src, count(*) AS degree FROM links GROUP BY src)",
        "sources AS (SELECT node_id AS source FROM nodes WHERE node_id IN (0, 3, 6))",
        "r0 AS (SELECT source, source AS node_id, 1.0::DOUBLE AS rank FROM sources)",
    ]
    for i in range(1, steps + 1):
        parts.append(f"""in{i} AS (
  SELECT r.source, l.dst AS node_id, sum(r.rank / d.degree) AS mass
  FROM r{i - 1} r JOIN links l ON r.node_id = l.src JOIN degrees d ON l.src = d.src
  WHERE l.dst IN (SELECT node_id FROM nodes) GROUP BY r.source, l.dst)""")
        parts.append(f"""m{i} AS (
  SELECT s.source, greatest(0, 1 - coalesce(sum(mass), 0)) AS missing
  FROM sources s LEFT JOIN in{i} i ON i.source = s.source GROUP BY s.source)""")
        parts.append(f"""r{i} AS (
  SELECT source, node_id, sum(rank) AS rank FROM (
    SELECT source, node_id, 0.85 * mass AS rank FROM in{i}
    UNION ALL SELECT source, source, 0.15 + 0.85 * missing FROM m{i})
  GROUP BY source, node_id)""")
    return ",\n".join(parts)


def _ranks(nodes: str, links: str) -> str:
    return f"""WITH {_iterations(nodes, links, 3)}
SELECT source, node_id, round(rank, 8) + 0.0 AS rank FROM r3 WHERE rank > 0"""


FEATURE = "('0x' || substr(md5({}), 1, 5))::INT"
INSTANCES = f"""inst AS (
  SELECT d.doc_id, l.toxic AS label,
    list_transform({WORDS.format('d.text')}, lambda w: {FEATURE.format('w')}) AS features
  FROM documents d JOIN labels l USING (doc_id)),
occurrences AS (SELECT doc_id, label, unnest(features) AS feature FROM inst)"""
MODELS = f"""{INSTANCES}, models AS (
  SELECT m.model_id, feature, ((feature * m.model_id) % 201 - 100) / 1000.0::DOUBLE AS weight
  FROM (SELECT DISTINCT feature FROM occurrences),
       (SELECT unnest([1, 2, 3])::INT AS model_id) m)"""
SCORED = f"""{MODELS}, scored AS (
  SELECT i.doc_id, i.label, m.model_id, round(coalesce(s.score, 0), 10) AS score
  FROM inst i CROSS JOIN (SELECT DISTINCT model_id FROM models) m
  LEFT JOIN (
    SELECT doc_id, model_id, sum(weight) AS score
    FROM occurrences JOIN models USING (feature) GROUP BY ALL) s
  ON s.doc_id = i.doc_id AND s.model_id = m.model_id)"""


def _trained(instances: str) -> str:
    """Online training, one document per model and step; ``instances`` gives the order."""
    return f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY order_key, doc_id) AS step
  FROM ({instances}) WHERE len(features) > 0),
uses AS (SELECT model_id, step, label, feature, count(*) AS times
  FROM (SELECT model_id, step, label, unnest(features) AS feature FROM numbered) GROUP BY ALL),
trained(model_id, feature, weight, step) USING KEY (model_id, feature) AS (
  SELECT DISTINCT model_id, feature, 0.0::DOUBLE, 0::BIGINT FROM uses
  UNION
  SELECT u.model_id, u.feature, t.weight + u.times * 0.002::DOUBLE * (u.label - 1 / (1 + exp(
    -sum(t.weight * u.times) OVER (PARTITION BY u.model_id)))), u.step
  FROM (SELECT model_id, max(step) AS step FROM trained GROUP BY model_id) done
  JOIN uses u ON u.model_id = done.model_id AND u.step = done.step + 1
  JOIN recurring.trained t ON t.model_id = u.model_id AND t.feature = u.feature)"""


ROC = """ranked AS (SELECT model_id, label, rank() OVER w
    + (count(*) OVER (PARTITION BY model_id, score) - 1) / 2.0::DOUBLE AS place
  FROM r WINDOW w AS (PARTITION BY model_id ORDER BY score)),
sums AS (SELECT model_id, sum(CASE WHEN label = 1 THEN place END) AS places,
    count(*) FILTER (label = 1) AS spam, count(*) FILTER (label <> 1) AS ham
  FROM ranked GROUP BY model_id)
SELECT model_id, round((1 - (places - spam * (spam + 1) / 2.0::DOUBLE) / (spam * ham)) * 100, 6)
  + 0.0 AS one_minus_roca FROM sums"""
ANSWER = "CASE WHEN score > 0 THEN 'spam' ELSE 'ham' END AS answer"

SHIPPED = "CAST(l_shipdate AS DATE) = DATE '1996-01-02'"
SHIPDATE_TEXT = "strftime(l_shipdate, '%Y-%m-%d')"


def _windows(start: str, step: str, keys: str = "", source: str = "events") -> str:
    comma = f"{keys}, " if keys else ""
    return f"""SELECT {comma}{start} AS window_start, {start} + INTERVAL {step} AS window_end,
  count(*) AS n FROM {source} GROUP BY ALL"""


HOUR = "time_bucket(INTERVAL 1 hour, ts)"
STAMPS = """strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end"""
LOCATED = """points AS (
  SELECT *, CASE WHEN event_type = 'click' THEN user_id ELSE value END AS x,
    CASE WHEN event_type = 'click' THEN value ELSE user_id END AS y FROM events),
located AS (
  SELECT *, CASE WHEN x > 10 AND x < 40 AND y > 5 AND y < 50 THEN 'west'
    WHEN x > 80 AND x < 120 AND y > 20 AND y < 90 THEN 'east' END AS region FROM points)"""
IN_REGION = "(SELECT * FROM located WHERE region IS NOT NULL)"


def _filled(key: str = "", source: str = "events") -> str:
    """Hourly counts with the silent windows up to the last event of all."""
    comma, group = (f"{key}, ", f"GROUP BY {key}") if key else ("", "")
    return f"""w AS ({_windows(HOUR, '1 hour', key, source)}),
spans AS (SELECT {comma}unnest(generate_series(min(window_start),
    (SELECT max({HOUR}) FROM events), INTERVAL 1 hour)) AS window_start FROM w {group}),
filled AS (SELECT {comma}window_start, window_start + INTERVAL 1 hour AS window_end, coalesce(n, 0) AS n
  FROM spans LEFT JOIN w USING ({comma}window_start))"""


def _history(closed: str) -> str:
    return f"""w AS ({_windows(HOUR, '1 hour', 'event_type')}),
spans AS (SELECT event_type, unnest(generate_series(min(window_start),
    (SELECT max(window_start) FROM w), INTERVAL 1 hour)) AS window_start
  FROM w GROUP BY event_type),
filled AS (SELECT s.event_type, s.window_start, s.window_start + INTERVAL 1 hour AS window_end,
    coalesce(w.n, 0) AS current
  FROM spans s LEFT JOIN w ON w.event_type = s.event_type AND w.window_start = s.window_start),
history AS (SELECT *, coalesce(lag(current) OVER (
    PARTITION BY event_type ORDER BY window_start), 0) AS previous FROM filled),
shown AS (SELECT event_type, {STAMPS}, lpad(epoch_ms(h.window_end)::VARCHAR, 13, '0') AS time_stamp,
    current, previous FROM history h WHERE {closed})"""


ALERT = "current >= 5 AND current >= 2 * previous"


def all_sql() -> dict[str, str]:
    return {
        "scan_delimited": f"SELECT * REPLACE ({SHIPDATE_TEXT} AS l_shipdate) FROM lineitem",
        "scan_parquet": "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) "
        "FROM orders",
        "scan_lines": f"WITH {LINES} SELECT doc_id, line_no::INT AS line_no, line_id, line FROM lines",
        "scan_adjacency": """SELECT l_orderkey AS node_id, 2 AS out_degree,
  l_partkey || ',' || l_suppkey AS neighbours FROM lineitem
UNION ALL SELECT c_custkey, 0, '' FROM customer""",
        "scan_labelled_features": f"""WITH {INSTANCES}
SELECT doc_id::VARCHAR AS doc_id, label, len(features)::INT AS num_features,
  array_to_string(features, ',') AS features FROM inst""",
        "stream_files": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id,
  event_type, value FROM events""",
        "write_text_table": "SELECT * FROM customer",
        "model_store": f"""WITH {MODELS} SELECT model_id, feature, round(weight, 6) AS weight
FROM models WHERE model_id IN (1, 3)""",
        "index_store": f"""WITH {POSTINGS} SELECT term, count(*) AS df, count(*) AS stored,
  min(line_id) AS first_id, max(line_id) AS last_id FROM postings GROUP BY term""",
        "stream_sink_windows": f"""WITH w AS ({_windows(HOUR, '1 hour')})
SELECT epoch_ms(window_end) AS window_ms, n FROM w""",
        "shipdate_filter": f"""SELECT * REPLACE ({SHIPDATE_TEXT} AS l_shipdate) FROM lineitem
WHERE contains({SHIPDATE_TEXT}, '1996-01')""",
        "shipdate_filter_fragment": f"""SELECT {SHIPDATE_TEXT} AS shipdate, count(*) AS n
FROM lineitem WHERE contains({SHIPDATE_TEXT}, '6-01-0') GROUP BY 1""",
        **{
            key: f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
  count(*) AS open_lines
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
WHERE strftime(o_orderdate, '%Y-%m-%d') < '{date}' AND {SHIPDATE_TEXT} > '{date}' GROUP BY ALL"""
            for key, date in (
                ("date_before_after", "1996-01-02"),
                ("date_before_after_month", "1996-01"),
            )
        },
        "month_bucket": f"""SELECT substr({SHIPDATE_TEXT}, 1, 7) AS month, count(*) AS n
FROM lineitem GROUP BY 1""",
        "tokenize_lines": f"WITH {TOKENS} SELECT line_id, pos::INT AS pos, token FROM tokens",
        "first_k_distinct_tokens": f"WITH {CUT} SELECT line_id, token FROM bags",
        "region_assign": f"""WITH {LOCATED} SELECT event_id, event_type, region
FROM located WHERE region IS NOT NULL""",
        "region_join": f"""WITH {LOCATED}, boxes AS (
  SELECT p_partkey AS place, 'box ' || p_partkey AS name, (p_partkey * 37 % 1000)::DOUBLE AS x0,
    (p_partkey * 91 % 500)::DOUBLE AS y0,
    CASE WHEN p_partkey % 100 = 0 THEN 300 ELSE p_size / 8.0::DOUBLE END::DOUBLE AS wide FROM part)
SELECT event_id, event_type, arg_min(name, place) AS region
FROM points JOIN boxes ON x > x0 AND x < x0 + wide AND y > y0 AND y < y0 + wide / 2
GROUP BY event_id, event_type""",
        "orders_by_shipdate": f"""SELECT o_orderpriority AS clerk, o_orderkey
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE {SHIPPED}
ORDER BY o_orderkey, clerk LIMIT 20""",
        "orders_by_shipdate_semi": f"""SELECT o_orderpriority AS clerk, o_orderkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {SHIPPED})
ORDER BY o_orderkey, clerk LIMIT 20""",
        "part_supplier_by_shipdate": f"""SELECT l_orderkey, p_name, s_name FROM lineitem
JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey WHERE {SHIPPED}
ORDER BY l_orderkey, l_partkey, l_suppkey LIMIT 20""",
        "graph_missing_structure": f"""WITH {NODES_MISSING}, {TRADE}
SELECT dst, count(*) AS num_edges FROM links
WHERE dst NOT IN (SELECT node_id FROM nodes) GROUP BY dst""",
        "shipdate_count": f"SELECT count(*) AS n FROM lineitem WHERE {SHIPPED}",
        "nation_shipments": f"""SELECT n_nationkey, n_name, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE {SHIPPED} GROUP BY ALL""",
        "nation_monthly_shipments": f"""SELECT n_nationkey, n_name,
  substr({SHIPDATE_TEXT}, 1, 7) AS month, count(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE n_name IN ('NATION_2', 'NATION_3') GROUP BY ALL""",
        "pricing_summary": f"""SELECT l_returnflag, l_linestatus,
  round(sum(l_quantity)::DECIMAL(38, 6), 2)::DOUBLE AS sum_qty, round(sum(l_extendedprice)::DECIMAL(38, 6), 2)::DOUBLE AS sum_base_price,
  round(sum(l_extendedprice * (1 - l_discount))::DECIMAL(38, 6), 2)::DOUBLE AS sum_disc_price,
  round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax))::DECIMAL(38, 6), 2)::DOUBLE AS sum_charge,
  round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 6) AS avg_price,
  round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE {SHIPPED} GROUP BY ALL""",
        "unshipped_revenue_topk": f"""SELECT c_name, o_orderkey,
  round(sum(l_extendedprice * (1 - l_discount))::DECIMAL(38, 6), 2)::DOUBLE AS revenue,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority AS priority
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE strftime(o_orderdate, '%Y-%m-%d') < '1996-01-02' AND {SHIPDATE_TEXT} > '1996-01-02'
GROUP BY ALL ORDER BY revenue DESC, o_orderkey LIMIT 10""",
        "word_count": f"WITH {TOKENS} SELECT token, count(*) AS n FROM tokens GROUP BY token",
        "word_count_min": f"""WITH {TOKENS} SELECT token, count(*) AS n FROM tokens
GROUP BY token HAVING count(*) > 1""",
        "line_doc_frequency": f"WITH {CUT} SELECT token, count(*) AS n FROM bags GROUP BY token",
        "line_count": f"WITH {LINES} SELECT count(*) AS n FROM lines",
        "top_terms": f"""WITH {TOKENS} SELECT token, count(*) AS n FROM tokens
GROUP BY token ORDER BY n DESC, token LIMIT 10""",
        "bigram_count": f"WITH {BIGRAMS} SELECT left_word, right_word, n FROM bigrams",
        "bigram_relfreq_pairs": f"""WITH {BIGRAMS} {RELATIVE}
UNION ALL SELECT left_word, '*', sum(n)::DOUBLE FROM bigrams GROUP BY left_word""",
        "bigram_relfreq_stripes": f"WITH {BIGRAMS} {RELATIVE}",
        "cooccurrence_window": f"WITH {WINDOW_PAIRS} SELECT left_word, right_word, n FROM pairs",
        "pmi_pairs": PMI_PAIRS,
        "pmi_stripes": PMI_PAIRS,
        "pmi_occurrence": f"""WITH {WHOLE},
frequency AS (SELECT token AS word, count(*) AS n FROM tokens GROUP BY token), pairs AS (
  SELECT a.token AS left_word, b.token AS right_word, count(*) AS n
  FROM bags a JOIN bags b ON a.line_id = b.line_id AND a.token <> b.token GROUP BY ALL)
{STRIPES.format(log='log10', total='(SELECT count(*) FROM tokens)')}""",
        "pmi_forward": f"""WITH {LINES},
words AS MATERIALIZED (SELECT {RAW.format('line')} AS t FROM lines),
places AS (SELECT t, unnest(range(1, len(t) + 1)) AS i FROM words),
pairs AS (SELECT left_word, right_word, count(*) AS n FROM (
  SELECT t[i] AS left_word, unnest(list_distinct(t[i + 1:])) AS right_word FROM places) GROUP BY ALL),
frequency AS (SELECT word, count(*) AS n FROM (
  SELECT unnest(list_distinct(t)) AS word FROM words) GROUP BY word)
{STRIPES.format(log='ln', total='(SELECT count(*) FROM words)')}""",
        "pmi_window": f"""WITH {WINDOW_PAIRS},
bags AS (SELECT DISTINCT line_id, token FROM tokens), {FREQUENCY}
SELECT left_word, right_word,
  round(ln((SELECT count(*) FROM lines)::DOUBLE * p.n / (x.n * y.n)), 6) + 0.0 AS pmi, p.n AS n
FROM pairs p JOIN frequency x ON p.left_word = x.token JOIN frequency y ON p.right_word = y.token
WHERE p.n >= 10""",
        "inverted_index": f"""WITH {POSTINGS} SELECT term,
  count(*) OVER (PARTITION BY term) AS df, line_id, tf FROM postings""",
        "postings_gaps": f"""WITH {POSTINGS} SELECT term,
  line_id - coalesce(lag(line_id) OVER (PARTITION BY term ORDER BY line_id), 0) AS gap, tf
FROM postings""",
        "postings_gaps_decode": f"WITH {POSTINGS} SELECT term, line_id, tf FROM postings",
        "postings_lookup": f"""WITH {POSTINGS} SELECT term, line_id, tf FROM postings
WHERE term IN ('the', 'der', 'que', 'zzyzx')""",
        "boolean_retrieval": f"WITH {BOOLEAN} SELECT query_id, line_id FROM hits",
        "fetch_snippets": f"""WITH {BOOLEAN} SELECT query_id, line_id,
  CASE WHEN length(line) > 80 THEN substr(line, 1, 80) || '...' ELSE line END AS snippet
FROM hits JOIN lines USING (line_id)""",
        "graph_nodes": f"""WITH {NODES}, {TRADE_REPEATED},
adjacency AS (SELECT src, count(*) AS degree, string_agg(dst::VARCHAR, ',' ORDER BY dst) AS dsts
  FROM links GROUP BY src)
SELECT node_id, 0 AS slice, coalesce(degree, 0) AS out_degree, coalesce(dsts, '') AS neighbours,
  (node_id = 0)::INT || ',' || (node_id = 3)::INT || ',' || (node_id = 6)::INT AS ranks
FROM nodes LEFT JOIN adjacency ON node_id = src""",
        "graph_stats": f"""WITH {NODES}, {TRADE}
SELECT (SELECT count(*) FROM nodes) AS num_nodes, (SELECT count(*) FROM links) AS num_edges,
  (SELECT count(DISTINCT src) FROM links) AS num_active_nodes""",
        "graph_partition": f"""WITH {NODES}, {TRADE_REPEATED},
degrees AS (SELECT src, count(*) AS degree FROM links GROUP BY src)
SELECT (node_id % 7)::INT AS part, count(*) AS num_nodes, coalesce(sum(degree), 0)::BIGINT AS num_edges
FROM nodes LEFT JOIN degrees ON src = node_id GROUP BY 1""",
        "graph_duplicate_nodes": f"""WITH {NODES},
doubled AS (SELECT node_id FROM nodes UNION ALL SELECT l_partkey FROM lineitem)
SELECT node_id, count(*) AS records FROM doubled GROUP BY node_id HAVING count(*) > 1""",
        "ppr_step": f"""WITH {_iterations(NODES_MISSING, TRADE_REPEATED, 2)}
SELECT source, node_id, round(mass, 8) + 0.0 AS mass FROM in2""",
        "ppr_missing_mass": f"""WITH {_iterations(NODES_MISSING, TRADE_REPEATED, 2)}
SELECT source, round(missing, 8) + 0.0 AS missing FROM m2""",
        "personalized_pagerank": _ranks(NODES, TRADE),
        "personalized_pagerank_cyclic": _ranks(NODES_CYCLIC, CYCLIC),
        "personalized_pagerank_unknown_nodes": _ranks(NODES_MISSING, TRADE_REPEATED),
        "personalized_pagerank_records": _ranks(NODES_MISSING, TRADE_REPEATED),
        "personalized_pagerank_resumed": _ranks(NODES, TRADE),
        "ppr_topk": f"""WITH {_iterations(NODES, TRADE, 3)}, placed AS (
  SELECT source, node_id, rank, row_number() OVER (
    PARTITION BY source ORDER BY round(rank, 10) DESC, node_id)::INT AS place FROM r3)
SELECT source, place, node_id, round(rank::DECIMAL(18, 10), 5)::DOUBLE AS rank
FROM placed WHERE place <= 10""",
        "doc_features": f"""SELECT doc_id, unnest(list_transform({WORDS.format('text')},
  lambda w: {FEATURE.format('w')})) AS feature FROM documents""",
        "shuffle_instances": """SELECT md5('1:' || doc_id) AS order_key, doc_id, toxic AS label
FROM documents JOIN labels USING (doc_id)""",
        "train_sgd": f"""WITH RECURSIVE {INSTANCES}, {_trained(
            "SELECT (doc_id % 3)::INT AS model_id, md5('1:' || doc_id) AS order_key, * FROM inst"
        )} SELECT model_id, feature, round(weight, 8) + 0.0 AS weight FROM trained""",
        "shuffle_trials": f"""WITH RECURSIVE {INSTANCES}, {_trained(
            "SELECT seed::INT AS model_id, md5(seed || ':' || doc_id) AS order_key, * FROM inst, range(1, 11) AS seeds(seed)"
        )}, r AS (SELECT seed::INT AS model_id, i.label, round(coalesce(s.score, 0), 10) AS score
  FROM inst i CROSS JOIN range(1, 11) AS seeds(seed) LEFT JOIN (
    SELECT doc_id, model_id, sum(weight) AS score
    FROM occurrences JOIN trained USING (feature) GROUP BY ALL) s
  ON s.doc_id = i.doc_id AND s.model_id = seed), {ROC}""",
        "ensemble_stored": f"""WITH RECURSIVE {INSTANCES}, {_trained(
            "SELECT (doc_id % 3)::INT AS model_id, md5('1:' || doc_id) AS order_key, * FROM inst"
        )}, scored AS (SELECT i.doc_id, i.label, m.model_id, round(coalesce(s.score, 0), 10) AS score
  FROM inst i CROSS JOIN (VALUES (0), (2)) AS m(model_id) LEFT JOIN (
    SELECT doc_id, model_id, sum(weight) AS score
    FROM occurrences JOIN trained USING (feature) GROUP BY ALL) s
  ON s.doc_id = i.doc_id AND s.model_id = m.model_id),
e AS (SELECT doc_id, label, round(avg(score), 10) AS score FROM scored GROUP BY ALL)
SELECT doc_id, label, round(score, 6) + 0.0 AS score, {ANSWER} FROM e""",
        "train_batch": f"""WITH {INSTANCES},
s1 AS (SELECT feature, sum((label - 0.5::DOUBLE) * 0.002::DOUBLE) AS weight
  FROM occurrences GROUP BY feature),
p1 AS (SELECT doc_id, 1 / (1 + exp(-sum(weight))) AS p
  FROM occurrences JOIN s1 USING (feature) GROUP BY doc_id),
s2 AS (SELECT feature, sum((label - p) * 0.002::DOUBLE) AS weight
  FROM occurrences JOIN p1 USING (doc_id) GROUP BY feature)
SELECT feature, round(s1.weight + s2.weight, 8) + 0.0 AS weight
FROM s1 JOIN s2 USING (feature)""",
        "score_documents": f"""WITH {SCORED}
SELECT doc_id, label, model_id, round(score, 6) + 0.0 AS score, {ANSWER} FROM scored""",
        "ensemble_average": f"""WITH {SCORED}, e AS (
  SELECT doc_id, label, round(avg(score), 10) AS score FROM scored GROUP BY ALL)
SELECT doc_id, label, round(score, 6) + 0.0 AS score, {ANSWER} FROM e""",
        "ensemble_vote": f"""WITH {SCORED}, e AS (
  SELECT doc_id, label, sum(CASE WHEN score > 0 THEN 1.0::DOUBLE ELSE -1 END) AS score
  FROM scored GROUP BY ALL)
SELECT doc_id, label, score, {ANSWER} FROM e""",
        "one_minus_roca": f"""WITH {SCORED},
r AS (SELECT model_id, label, round(score, 4) AS score FROM scored),
{ROC}""",
        "event_count_tumbling": f"""WITH {_filled()}
SELECT {STAMPS}, n FROM filled""",
        "event_count_tumbling_stream": f"""WITH {_filled()}
SELECT {STAMPS}, n FROM filled""",
        "region_event_count": f"""WITH {LOCATED}, {_filled('region', IN_REGION)}
SELECT region, {STAMPS}, n FROM filled""",
        "region_event_count_stream": f"""WITH {LOCATED}, {_filled('region', IN_REGION)}
SELECT region, {STAMPS}, n FROM filled""",
        "window_state_history": f"WITH {_history('true')} SELECT * FROM shown",
        "window_state_history_stream": f"WITH {_history('true')} SELECT * FROM shown",
        "trending_alerts": f"WITH {_history('true')} SELECT * FROM shown WHERE {ALERT}",
        "trending_alerts_stream": f"WITH {_history('true')} SELECT * FROM shown WHERE {ALERT}",
        "sliding_window_count": f"""WITH steps AS (SELECT unnest([0, 15, 30, 45]) AS back),
w AS (SELECT time_bucket(INTERVAL 15 minutes, ts) - to_minutes(back) AS window_start,
    time_bucket(INTERVAL 15 minutes, ts) - to_minutes(back) + INTERVAL 1 hour AS window_end,
    count(*) AS n FROM events, steps GROUP BY ALL)
SELECT {STAMPS}, n FROM w""",
        "stream_recovery": f"""WITH {_filled()}
SELECT {STAMPS}, n FROM filled""",
    }
