"""SQL text of the adapter tables, for the comparison queries."""

from riskengine.schema import FEEDBACK_SOURCES, V_COLS

V_LIST = ", ".join(V_COLS)
_V_DEFS = ", ".join(f"CAST(e.embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(V_COLS))
_T_US = "(epoch_us(ts) - 1704067200000000)"
_SOURCES = ", ".join(f"'{s}'" for s in FEEDBACK_SOURCES)

LOG = f"""log AS (SELECT event_id AS txn_id, user_id AS card_id, ts, {_T_US} AS t_us,
  {_T_US} // 1000000 AS time_s, value AS Amount,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS Class FROM events)"""

TXN = f"""{LOG}, txn AS (SELECT l.*, {_V_DEFS}
  FROM log l JOIN embeddings e ON e.vec_id = l.txn_id % (SELECT count(*) FROM embeddings))"""

RAW = f"""{TXN}, raw AS (SELECT CAST(time_s AS DOUBLE) AS Time, {V_LIST}, Amount,
  CAST(Class AS BIGINT) AS Class FROM txn)"""

SCORED = f"""{LOG}, scored AS (
  SELECT 'model_a' AS model_name, txn_id, ts, Amount, Class AS label,
    ((txn_id * 7919) % 10007 + 4000 * Class) / 14007.0::DOUBLE AS p FROM log
  UNION ALL
  SELECT 'model_b', txn_id, ts, Amount, Class,
    ((txn_id * 6007) % 10007 + 1000 * Class) / 11007.0::DOUBLE FROM log)"""

AUDIT = f"""{SCORED},
transactions AS (SELECT CAST(txn_id AS VARCHAR) AS transaction_id, ts AS timestamp_received,
  CAST(time_s AS DOUBLE) AS time_seconds, Amount AS amount, CAST(card_id AS VARCHAR) AS card_id,
  CAST(NULL AS VARCHAR) AS merchant_id FROM log),
predictions AS (SELECT model_name || '-' || txn_id AS prediction_id, CAST(txn_id AS VARCHAR) AS transaction_id,
  model_name, '1.0' AS model_version, p AS fraud_probability, p >= 0.5 AS is_fraud, 0.5::DOUBLE AS decision_threshold,
  (txn_id % 97) / 10.0::DOUBLE AS inference_time_ms, ts AS created_at FROM scored WHERE txn_id % 11 <> 0),
ground_truth AS (SELECT 'fb-' || txn_id AS feedback_id, CAST(txn_id AS VARCHAR) AS transaction_id, Class AS true_label,
  ([{_SOURCES}])[txn_id % 4 + 1] AS feedback_source, ts + INTERVAL 1 DAY AS reported_at,
  CAST(NULL AS VARCHAR) AS notes FROM log WHERE txn_id % 5 <> 0),
feedback_log AS (SELECT * FROM ground_truth UNION ALL
  SELECT feedback_id || '-b', transaction_id, 1 - true_label, 'manual_review', reported_at + INTERVAL 2 DAY, 'corrected'
  FROM ground_truth WHERE CAST(transaction_id AS BIGINT) % 7 = 0)"""

DIRTY = f"""{TXN}, dirty AS (SELECT * REPLACE (CASE WHEN txn_id % 47 = 0 THEN 99999.0::DOUBLE
  WHEN txn_id % 43 = 0 THEN 'NaN'::DOUBLE WHEN txn_id % 41 = 0 THEN NULL
  WHEN txn_id % 40 = 0 THEN -Amount ELSE Amount END AS Amount) FROM txn)"""

DUPLICATED = f"""{TXN}, duplicated AS (SELECT * FROM txn UNION ALL SELECT * FROM txn WHERE txn_id % 100 = 0)"""

SHIPMENTS = """shipments AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 86400 AS time_s,
  l_extendedprice AS Amount, l_returnflag FROM lineitem)"""


def trailing(table: str, width: int, tag: str, key: str = "txn_id", by: str = "") -> str:
    """Count, mean and population deviation of the trailing window with the tie rule, each over
    the rows themselves: those of the value range that are not after the row in (time, key) order."""
    keys = [k.strip() for k in key.split(",")]
    same = f"a.{by} = b.{by} AND " if by else ""
    not_after = f"(b.time_s < a.time_s OR ({', '.join(f'b.{k}' for k in keys)}) <= ({', '.join(f'a.{k}' for k in keys)}))"
    own = ", ".join(f"a.{k}" for k in keys)
    return f"""{tag} AS (SELECT {own}, count(*) AS count_{tag}, avg(b.Amount) AS avg_{tag}, stddev_pop(b.Amount) AS std_{tag}
   FROM {table} a JOIN (SELECT *, unnest([time_s // {width}, time_s // {width} + 1]) AS bk FROM {table}) b
   ON {same}b.bk = a.time_s // {width} AND b.time_s BETWEEN a.time_s - {width} AND a.time_s AND {not_after} GROUP BY {own})"""


def areas(table: str, by: str, tag: str) -> str:
    """CTEs ``tag``: samples, positives, pr_auc, average_precision, roc_auc, tn, fp, fn, tp at 0.5 per ``by`` of a table with p and label."""
    return f"""{tag}_c AS (SELECT {by}, p, count(*) AS n, sum(label) AS pos FROM {table} GROUP BY ALL),
 {tag}_r AS (SELECT *, coalesce(sum(n) OVER w, 0) AS bn, coalesce(sum(pos) OVER w, 0) AS bp FROM {tag}_c
  WINDOW w AS (PARTITION BY {by} ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
 {tag}_s AS (SELECT {by}, sum(n)::BIGINT AS samples, sum(pos)::BIGINT AS positives, sum(pos * ((bp + pos) / (bn + n) + CASE WHEN bn > 0 THEN bp / bn ELSE 1 END) / 2) AS trapezoid,
  sum(pos * ((bp + pos) / (bn + n))) AS step, sum((n - pos) * (bp + pos / 2)) AS pairs, coalesce(sum(pos) FILTER (p >= 0.5), 0)::BIGINT AS tp, coalesce(sum(n - pos) FILTER (p >= 0.5), 0)::BIGINT AS fp
  FROM {tag}_r GROUP BY ALL),
 {tag} AS (SELECT {by}, samples, positives, CASE WHEN positives > 0 AND positives < samples THEN trapezoid / positives ELSE 0 END AS pr_auc,
  CASE WHEN positives > 0 AND positives < samples THEN step / positives ELSE 0 END AS average_precision,
  CASE WHEN positives > 0 AND positives < samples THEN pairs / (positives::DOUBLE * (samples - positives)) ELSE 0 END AS roc_auc, tp, fp, positives - tp AS fn, samples - positives - fp AS tn FROM {tag}_s)"""
