"""DuckDB twins of the registered queries (the correctness oracle).

Each query is an independent ANSI-SQL formulation over the driver tables
(customer, nation, orders, lineitem, events).  Shared steps are CTEs that a
query pulls in by name; ``build(body, *ctes)`` resolves their dependencies.
"""

from __future__ import annotations

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql.strip().replace("@MS@", MS.format(x="amount")), deps or [])


def build(body: str, *names: str) -> str:
    body = body.replace("@MS@", MS.format(x="amount"))
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


MS = "CAST(CAST(SUM(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,12))) AS VARCHAR) AS DOUBLE)"  # exact money sum


# ---------------------------------------------------------------- inputs
cte(
    "customers_raw",
    """
SELECT c.c_custkey AS customer_id,
       s.signup_date,
       n.n_name AS country,
       c.c_mktsegment AS industry,
       CASE WHEN c.c_acctbal < 3300 THEN 'Basic'
            WHEN c.c_acctbal < 7300 THEN 'Professional'
            WHEN c.c_acctbal < 9300 THEN 'Enterprise'
            ELSE 'Premium' END AS subscription_type,
       GREATEST(c.c_acctbal, 0.0) / 10.0 AS monthly_fee
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS signup_date
           FROM orders GROUP BY o_custkey) s ON s.o_custkey = c.c_custkey
""",
)

cte(
    "txn_raw",
    """
SELECT l.l_orderkey * 10 + l.l_linenumber AS transaction_id,
       o.o_custkey AS customer_id,
       CAST(l.l_shipdate AS DATE) AS transaction_date,
       CASE WHEN l.l_returnflag = 'R' THEN -(l.l_extendedprice * (1.0 - l.l_discount))
            ELSE l.l_extendedprice * (1.0 - l.l_discount) END AS amount,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Credit Card'
                              WHEN '2-HIGH' THEN 'Bank Transfer'
                              WHEN '3-MEDIUM' THEN 'PayPal'
                              WHEN '4-NOT SPECIFIED' THEN 'Wire Transfer'
                              WHEN '5-LOW' THEN 'ACH'
                              ELSE 'Other' END AS payment_method,
       CASE WHEN l.l_returnflag = 'R' THEN 'Refunded'
            WHEN l.l_linestatus = 'F' THEN 'Completed'
            WHEN l.l_linestatus = 'O' THEN 'Pending'
            ELSE l.l_linestatus END AS transaction_status
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""",
)

cte(
    "cust_dedup",
    """
SELECT customer_id, signup_date, country, industry, subscription_type, monthly_fee
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
        ORDER BY signup_date NULLS FIRST, country NULLS FIRST, industry NULLS FIRST,
                 subscription_type NULLS FIRST, monthly_fee NULLS FIRST) AS rn
      FROM customers_raw) t
WHERE rn = 1
""",
    ["customers_raw"],
)

cte(
    "customers",
    """
SELECT customer_id, signup_date, country, industry, subscription_type,
       COALESCE(CAST(monthly_fee AS DOUBLE),
                (SELECT quantile_cont(monthly_fee, 0.5) FROM cust_dedup)) AS monthly_fee
FROM cust_dedup
""",
    ["cust_dedup"],
)

cte(
    "txns",
    """
SELECT transaction_id, customer_id, transaction_date, CAST(amount AS DOUBLE) AS amount,
       payment_method, transaction_status
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY transaction_id
        ORDER BY transaction_date NULLS FIRST, customer_id NULLS FIRST, amount NULLS FIRST,
                 payment_method NULLS FIRST, transaction_status NULLS FIRST) AS rn
      FROM txn_raw) t
WHERE rn = 1 AND amount IS NOT NULL AND NOT isnan(amount)
  AND transaction_status IN ('Completed', 'Failed', 'Pending', 'Refunded')
""",
    ["txn_raw"],
)

cte("completed", "SELECT * FROM txns WHERE transaction_status = 'Completed'", ["txns"])

cte(
    "customer_features",
    """
SELECT c.customer_id, c.signup_date, c.country, c.industry, c.subscription_type, c.monthly_fee,
       COALESCE(m.total_transactions, 0) AS total_transactions,
       COALESCE(m.total_revenue, 0.0) AS total_revenue,
       COALESCE(m.avg_transaction, 0.0) AS avg_transaction,
       COALESCE(m.std_transaction, 0.0) AS std_transaction,
       m.first_transaction, m.last_transaction,
       COALESCE(m.successful_transactions, 0) AS successful_transactions,
       COALESCE(m.failed_transactions, 0) AS failed_transactions,
       COALESCE(CAST(r.ref - c.signup_date AS INTEGER), 0) AS customer_tenure_days,
       COALESCE(CAST(r.ref - m.last_transaction AS INTEGER), 0) AS days_since_last_transaction,
       COALESCE(CAST(m.total_transactions AS DOUBLE) / NULLIF(CAST(r.ref - c.signup_date AS INTEGER) + 1, 0) * 30, 0.0)
           AS transaction_frequency,
       COALESCE(CAST(COALESCE(m.failed_transactions, 0) AS DOUBLE) / NULLIF(m.total_transactions + 1, 0), 0.0)
           AS payment_failure_rate,
       COALESCE(m.total_revenue / NULLIF(CAST(r.ref - c.signup_date AS INTEGER) / 30 + 1, 0), 0.0)
           AS avg_monthly_revenue,
       CASE WHEN CAST(r.ref - m.last_transaction AS INTEGER) > 60 THEN 1 ELSE 0 END AS is_churned,
       COALESCE(m.total_revenue, 0.0) AS customer_ltv
FROM customers c
LEFT JOIN (
  SELECT customer_id,
         COUNT(transaction_id) AS total_transactions,
         @MS@ AS total_revenue,
         @MS@ / NULLIF(COUNT(amount), 0) AS avg_transaction,
         ROUND(STDDEV_SAMP(amount), 6) AS std_transaction,
         MIN(transaction_date) AS first_transaction,
         MAX(transaction_date) AS last_transaction,
         COUNT(*) FILTER (WHERE transaction_status = 'Completed') AS successful_transactions,
         COUNT(*) FILTER (WHERE transaction_status = 'Failed') AS failed_transactions
  FROM txns GROUP BY customer_id) m ON c.customer_id = m.customer_id
CROSS JOIN (SELECT MAX(transaction_date) AS ref FROM txns) r
""",
    ["customers", "txns"],
)

ORACLE: dict[str, str] = {}


def register(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = build(body, *ctes)


register("clean_customers", "SELECT * FROM customers", "customers")
register("clean_transactions", "SELECT * FROM txns", "txns")
register("customer_features", "SELECT * FROM customer_features", "customer_features")
register(
    "transaction_features",
    """
SELECT *, CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
       CAST(quarter(transaction_date) AS INTEGER) AS quarter,
       CAST(isodow(transaction_date) - 1 AS INTEGER) AS day_of_week,
       CAST(day(transaction_date) AS INTEGER) AS day_of_month,
       CAST(weekofyear(transaction_date) AS INTEGER) AS week_of_year,
       CASE WHEN isodow(transaction_date) - 1 >= 5 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN day(transaction_date) <= 5 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN day(transaction_date) >= 25 THEN 1 ELSE 0 END AS is_month_end,
       CASE WHEN transaction_status = 'Completed' THEN 1 ELSE 0 END AS is_successful,
       CASE WHEN amount > 0 THEN 1 ELSE 0 END AS is_revenue
FROM txns
""",
    "txns",
)
register(
    "daily_revenue",
    """
SELECT transaction_date AS date, @MS@ AS revenue,
       COUNT(transaction_id) AS transaction_count
FROM completed GROUP BY transaction_date
""",
    "completed",
)
register(
    "monthly_revenue",
    """
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
       @MS@ AS revenue,
       COUNT(transaction_id) AS transaction_count,
       COUNT(DISTINCT customer_id) AS unique_customers,
       make_date(CAST(year(transaction_date) AS INTEGER), CAST(month(transaction_date) AS INTEGER), 1) AS date
FROM completed GROUP BY 1, 2
""",
    "completed",
)
register(
    "monthly_revenue_agg",
    """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month,
       @MS@ AS total_revenue,
       COUNT(amount) AS transaction_count,
       @MS@ / NULLIF(COUNT(amount), 0) AS avg_transaction,
       COUNT(DISTINCT customer_id) AS unique_customers
FROM txn_raw WHERE transaction_status = 'Completed' GROUP BY 1
""",
    "txn_raw",
)
register(
    "monthly_acquisitions",
    """
SELECT strftime(signup_date, '%Y-%m') AS signup_month, COUNT(*) AS new_customers
FROM customers GROUP BY 1
""",
    "customers",
)

# ---------------------------------------------------------------- RFM
FS = "CAST(SUM(CAST({x} AS DECIMAL(38,9))) AS DOUBLE)"  # exact derived-double sum


def ms(x: str) -> str:
    return MS.format(x=x)


def fs(x: str) -> str:
    return FS.format(x=x)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _rules_case(rules, default: str) -> str:
    from tidemark.operators.rfm import rule_sql

    parts = []
    for name, cond in rules:
        parts.append(f"WHEN {rule_sql(cond)} THEN {_sql_str(name)}")
    return "CASE " + " ".join(parts) + f" ELSE {_sql_str(default)} END"


def _quantile_edges(src: str, col: str, probs: list[str], prefix: str) -> str:
    """Exact linear quantiles of ``col`` (lo + (hi - lo) * frac), one row."""
    sel = []
    for i, p in enumerate(probs):
        h = f"(CAST(n - 1 AS DOUBLE) * CAST({p} AS DOUBLE))"
        lo = f"MAX(CASE WHEN pos = FLOOR({h}) THEN v END)"
        hi = f"MAX(CASE WHEN pos = CEIL({h}) THEN v END)"
        fr = f"MAX({h} - FLOOR({h}))"
        sel.append(f"{lo} + ({hi} - {lo}) * {fr} AS {prefix}{i}")
    return (
        f"SELECT {', '.join(sel)} FROM (SELECT CAST({col} AS DOUBLE) AS v, "
        f"ROW_NUMBER() OVER (ORDER BY {col}) - 1 AS pos, COUNT(*) OVER () AS n "
        f"FROM {src} WHERE {col} IS NOT NULL) t"
    )


def _rfm_ctes(variant: str, plus: int) -> None:
    from tidemark.operators.rfm import VARIANTS

    v = VARIANTS[variant]
    cte(
        f"rfm_base_{variant}",
        f"""
SELECT p.customer_id, CAST(r.ref - p.last AS INTEGER) AS recency, p.frequency,
       GREATEST(p.m, 0.0) AS monetary
FROM (SELECT customer_id, MAX(transaction_date) AS last, COUNT(transaction_id) AS frequency,
             {ms('amount')} AS m
      FROM completed GROUP BY customer_id) p
CROSS JOIN (SELECT CAST(MAX(transaction_date) + {plus} AS DATE) AS ref FROM txns) r
""",
        ["completed", "txns"],
    )
    cte(f"rfm_edges_{variant}", _quantile_edges(f"rfm_base_{variant}", "recency", ["0.2", "0.4", "0.6", "0.8"], "e"),
        [f"rfm_base_{variant}"])
    fscore = "CAST(CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, (5 * ({r} - 1) + n - 2) // GREATEST(n - 1, 1)) END AS INTEGER)"
    cte(
        f"rfm_scored_{variant}",
        f"""
SELECT customer_id, recency, frequency, monetary, R_score, F_score, M_score,
       CAST(R_score AS VARCHAR) || CAST(F_score AS VARCHAR) || CAST(M_score AS VARCHAR) AS RFM_score,
       R_score + F_score + M_score AS RFM_total
FROM (
  SELECT b.*,
         CAST(CASE WHEN recency <= e.e0 THEN 5 WHEN recency <= e.e1 THEN 4 WHEN recency <= e.e2 THEN 3
                   WHEN recency <= e.e3 THEN 2 WHEN recency IS NOT NULL THEN 1 END AS INTEGER) AS R_score,
         {fscore.format(r='rf')} AS F_score,
         {fscore.format(r='rm')} AS M_score
  FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY frequency, customer_id) AS rf,
               ROW_NUMBER() OVER (ORDER BY monetary, customer_id) AS rm,
               COUNT(*) OVER () AS n
        FROM rfm_base_{variant}) b CROSS JOIN rfm_edges_{variant} e) s
""",
        [f"rfm_base_{variant}", f"rfm_edges_{variant}"],
    )
    extra = ", c.signup_date" if variant == "B" else ""
    cte(
        f"rfm_{variant}",
        f"""
SELECT s.*, {_rules_case(v['rules'], v['default'])} AS {v['col']},
       c.country, c.industry, c.subscription_type{extra}
FROM rfm_scored_{variant} s LEFT JOIN customers c ON s.customer_id = c.customer_id
""",
        [f"rfm_scored_{variant}", "customers"],
    )


_rfm_ctes("A", 0)
_rfm_ctes("B", 1)


def _seg_summary(src: str, col: str) -> str:
    return f"""
SELECT {col} AS segment, COUNT(customer_id) AS customer_count, AVG(recency) AS avg_recency,
       AVG(frequency) AS avg_frequency, {ms('monetary')} AS total_revenue,
       {ms('monetary')} / NULLIF(COUNT(monetary), 0) AS avg_revenue, AVG(RFM_total) AS avg_rfm_score
FROM {src} GROUP BY {col}
"""


cte("rfm_summary_a", _seg_summary("rfm_A", "segment"), ["rfm_A"])


def _seg_text_case(idx: int) -> str:
    from tidemark.operators.rfm import SEGMENT_TEXT_B

    parts = " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(v[idx])}" for k, v in SEGMENT_TEXT_B.items())
    return f"CASE segment {parts} ELSE 'N/A' END"


cte(
    "rfm_summary_b",
    f"""
SELECT s.*, {_seg_text_case(0)} AS description, {_seg_text_case(1)} AS recommended_action,
       round_even(CAST(s.customer_count AS DOUBLE) / NULLIF(t.nc, 0) * 100, 1) AS customer_pct,
       round_even(s.total_revenue / NULLIF(t.rv, 0) * 100, 1) AS revenue_pct
FROM ({_seg_summary('rfm_B', 'rfm_segment')}) s
CROSS JOIN (SELECT COUNT(*) AS nc, {ms('monetary')} AS rv FROM rfm_B) t
""",
    ["rfm_B"],
)

register(
    "rfm_scores",
    "SELECT customer_id, recency, frequency, monetary, R_score, F_score, M_score, RFM_score, RFM_total FROM rfm_A",
    "rfm_A",
)
register("rfm_segments_a", "SELECT * FROM rfm_A", "rfm_A")
register("rfm_segments_b", "SELECT * FROM rfm_B", "rfm_B")
register(
    "rfm_metric_summary",
    f"""
SELECT MIN(recency) AS recency_min, MAX(recency) AS recency_max, AVG(recency) AS recency_mean,
       MIN(frequency) AS frequency_min, MAX(frequency) AS frequency_max, AVG(frequency) AS frequency_mean,
       MIN(monetary) AS monetary_min, MAX(monetary) AS monetary_max,
       {ms('monetary')} / NULLIF(COUNT(monetary), 0) AS monetary_mean
FROM rfm_B
""",
    "rfm_B",
)
register("rfm_summary_a", "SELECT * FROM rfm_summary_a", "rfm_summary_a")
register("rfm_summary_b", "SELECT * FROM rfm_summary_b", "rfm_summary_b")
register(
    "segment_kpis",
    "SELECT segment, customer_count, customer_pct, total_revenue, revenue_pct, avg_revenue, avg_rfm_score FROM rfm_summary_b",
    "rfm_summary_b",
)
register(
    "segment_insights",
    """
SELECT arg_min(segment, (-avg_rfm_score, segment)) AS top_segment,
       arg_min(segment, (-customer_count, segment)) AS largest_segment,
       arg_min(segment, (-avg_revenue, segment)) AS highest_value_segment
FROM rfm_summary_b
""",
    "rfm_summary_b",
)

# ---------------------------------------------------------------- cohorts
cte(
    "cohorted",
    """
SELECT t.*, strftime(c.cm, '%Y-%m') AS cohort,
       CAST((year(t.transaction_date) - year(c.cm)) * 12 + month(t.transaction_date) - month(c.cm) AS INTEGER)
           AS cohort_index
FROM completed t
JOIN (SELECT customer_id, CAST(date_trunc('month', signup_date) AS DATE) AS cm FROM customers) c
  ON t.customer_id = c.customer_id
WHERE c.cm IS NOT NULL
""",
    ["completed", "customers"],
)
cte(
    "cohort_counts",
    "SELECT cohort, cohort_index, COUNT(DISTINCT customer_id) AS customers FROM cohorted GROUP BY 1, 2",
    ["cohorted"],
)
cte(
    "cohort_cells",
    """
SELECT s.cohort, s.cohort_index, cc.customers, b.base
FROM (SELECT * FROM (SELECT DISTINCT cohort FROM cohort_counts) a
      CROSS JOIN (SELECT DISTINCT cohort_index FROM cohort_counts) i) s
LEFT JOIN cohort_counts cc ON cc.cohort = s.cohort AND cc.cohort_index = s.cohort_index
LEFT JOIN (SELECT cohort, customers AS base FROM cohort_counts
           WHERE cohort_index = (SELECT MIN(cohort_index) FROM cohort_counts)) b ON b.cohort = s.cohort
""",
    ["cohort_counts"],
)
cte(
    "cohort_retention_a",
    """
SELECT cohort, cohort_index,
       COALESCE(CAST(customers AS DOUBLE) / NULLIF(CAST(base AS DOUBLE), 0) * 100, 0.0) AS retention
FROM cohort_cells
""",
    ["cohort_cells"],
)
cte(
    "cohort_retention_b",
    """
SELECT cohort, cohort_index,
       CAST(COALESCE(customers, 0) AS DOUBLE) / NULLIF(CAST(base AS DOUBLE), 0) * 100 AS retention
FROM cohort_cells
""",
    ["cohort_cells"],
)
cte(
    "retention_curve",
    f"SELECT cohort_index AS month, {fs('retention')} / NULLIF(COUNT(retention), 0) AS avg_retention "
    "FROM cohort_retention_b GROUP BY 1",
    ["cohort_retention_b"],
)
cte(
    "cohort_revenue",
    f"""
SELECT cohort, customers, total_revenue, transactions,
       total_revenue / customers AS avg_revenue_per_customer,
       CAST(transactions AS DOUBLE) / customers AS avg_transactions_per_customer,
       total_revenue / NULLIF(tot, 0) * 100 AS revenue_contribution_pct,
       CAST(SUM(customers) OVER (ORDER BY cohort ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
           AS cumulative_customers,
       total_revenue / customers AS cohort_ltv
FROM (SELECT cohort, COUNT(DISTINCT customer_id) AS customers, {ms('amount')} AS total_revenue,
             COUNT(transaction_id) AS transactions
      FROM cohorted GROUP BY cohort) p
CROSS JOIN (SELECT {ms('amount')} AS tot FROM cohorted) t
""",
    ["cohorted"],
)

register("cohort_counts", "SELECT * FROM cohort_counts", "cohort_counts")
register("cohort_retention", "SELECT * FROM cohort_retention_a", "cohort_retention_a")
register(
    "average_retention",
    f"SELECT cohort_index AS month, {fs('retention')} / NULLIF(COUNT(retention), 0) AS avg_retention "
    "FROM cohort_retention_a GROUP BY 1",
    "cohort_retention_a",
)
register("retention_curve", "SELECT * FROM retention_curve", "retention_curve")
register(
    "retention_dashboard",
    """
SELECT r.cohort_index, r.cohort, r.retention FROM cohort_retention_b r
WHERE r.cohort_index IN (SELECT cohort_index FROM (SELECT DISTINCT cohort_index FROM cohort_retention_b)
                         ORDER BY cohort_index LIMIT 12)
""",
    "cohort_retention_b",
)
register("cohort_revenue", "SELECT * FROM cohort_revenue", "cohort_revenue")
register(
    "cohort_revenue_overall",
    f"""
SELECT COUNT(*) AS total_cohorts, CAST(SUM(customers) AS BIGINT) AS total_customers,
       {ms('total_revenue')} AS total_revenue, {fs('cohort_ltv')} / NULLIF(COUNT(cohort_ltv), 0) AS avg_ltv
FROM cohort_revenue
""",
    "cohort_revenue",
)
register(
    "segmentation_metrics",
    f"""
SELECT * FROM (VALUES ('total_customers', (SELECT CAST(COUNT(*) AS DOUBLE) FROM rfm_B)),
  ('total_revenue', (SELECT {ms('monetary')} FROM rfm_B)),
  ('avg_recency', (SELECT AVG(recency) FROM rfm_B)),
  ('avg_frequency', (SELECT AVG(frequency) FROM rfm_B)),
  ('avg_monetary', (SELECT {ms('monetary')} / COUNT(monetary) FROM rfm_B)),
  ('num_segments', (SELECT CAST(COUNT(DISTINCT rfm_segment) AS DOUBLE) FROM rfm_B)),
  ('num_cohorts', (SELECT CAST(COUNT(DISTINCT cohort) AS DOUBLE) FROM cohorted)),
  ('avg_retention_month1', COALESCE((SELECT avg_retention FROM retention_curve WHERE month = 1), 0.0)),
  ('avg_retention_month6', COALESCE((SELECT avg_retention FROM retention_curve WHERE month = 6), 0.0))
) v(metric, value)
""",
    "rfm_B",
    "cohorted",
    "retention_curve",
)

# ---------------------------------------------------------------- lifecycle
LIFECYCLE_CASE = """CASE WHEN customer_tenure_days <= 90 THEN 'New (0-3 months)'
     WHEN customer_tenure_days <= 180 THEN CASE WHEN days_since_last_transaction <= 45
          THEN 'Growing (3-6 months)' ELSE 'Early Churn Risk' END
     WHEN customer_tenure_days <= 365 THEN CASE WHEN days_since_last_transaction <= 45
          THEN 'Established (6-12 months)' ELSE 'Declining' END
     ELSE CASE WHEN days_since_last_transaction <= 45 THEN 'Mature (12+ months)'
               WHEN days_since_last_transaction <= 90 THEN 'At Risk' ELSE 'Churned/Dormant' END END"""
register(
    "lifecycle_stages",
    f"SELECT customer_id, {LIFECYCLE_CASE} AS lifecycle_stage, customer_tenure_days, days_since_last_transaction "
    "FROM customer_features",
    "customer_features",
)
register(
    "lifecycle_summary",
    f"""
SELECT {LIFECYCLE_CASE} AS stage, COUNT(customer_id) AS customer_count, {ms('total_revenue')} AS total_revenue,
       {ms('total_revenue')} / NULLIF(COUNT(total_revenue), 0) AS avg_revenue,
       {fs('customer_ltv')} / NULLIF(COUNT(customer_ltv), 0) AS avg_ltv,
       AVG(customer_tenure_days) AS avg_tenure_days
FROM customer_features GROUP BY 1
""",
    "customer_features",
)

# ---------------------------------------------------------------- profitability
def dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


cte(
    "profit_base",
    f"""
SELECT f.customer_id, f.signup_date, f.country, f.industry, f.subscription_type, f.monthly_fee,
       f.total_transactions, COALESCE(v.verified_revenue, 0.0) AS total_revenue, f.avg_transaction,
       f.std_transaction, f.first_transaction, f.last_transaction, f.successful_transactions,
       f.failed_transactions, f.customer_tenure_days, f.days_since_last_transaction, f.transaction_frequency,
       f.payment_failure_rate, f.avg_monthly_revenue, f.is_churned, f.customer_ltv,
       COALESCE(v.verified_revenue, 0.0) AS verified_revenue
FROM customer_features f
LEFT JOIN (SELECT customer_id, {ms('amount')} AS verified_revenue FROM completed GROUP BY customer_id) v
  ON f.customer_id = v.customer_id
""",
    ["customer_features", "completed"],
)
cte(
    "profit_costs",
    f"""
SELECT *, acquisition_cost + servicing_cost + transaction_cost + support_cost + infrastructure_cost
          + payment_processing_cost AS total_cost
FROM (SELECT *,
        CASE subscription_type WHEN 'Basic' THEN {dbl(50)} WHEN 'Professional' THEN {dbl(100)}
             WHEN 'Enterprise' THEN {dbl(200)} WHEN 'Premium' THEN {dbl(300)} END AS acquisition_cost,
        total_revenue * {dbl(0.15)} AS servicing_cost,
        total_transactions * {dbl(0.5)} AS transaction_cost,
        CASE subscription_type WHEN 'Basic' THEN {dbl(5)} WHEN 'Professional' THEN {dbl(15)}
             WHEN 'Enterprise' THEN {dbl(40)} WHEN 'Premium' THEN {dbl(75)} END
          * (customer_tenure_days / 30) AS support_cost,
        total_revenue * {dbl(0.05)} AS infrastructure_cost,
        total_revenue * {dbl(0.029)} AS payment_processing_cost
      FROM profit_base) t
""",
    ["profit_base"],
)
cte(
    "profit",
    """
SELECT *, CASE profitability_tier WHEN 'Loss-Making' THEN 0 WHEN 'Low Profit' THEN 1
                                  WHEN 'Medium Profit' THEN 2 WHEN 'High Profit' THEN 3 END AS tier_rank
FROM (SELECT *, CASE WHEN gross_profit < 0 THEN 'Loss-Making' WHEN profit_margin < 20 THEN 'Low Profit'
                     WHEN profit_margin < 50 THEN 'Medium Profit' ELSE 'High Profit' END AS profitability_tier
      FROM (SELECT *,
              CASE WHEN total_revenue > 0 THEN gross_profit / total_revenue * 100 ELSE -100.0 END AS profit_margin,
              gross_profit / GREATEST(customer_tenure_days / 30, 1.0) AS monthly_profit,
              CASE WHEN total_cost > 0 THEN gross_profit / total_cost * 100 ELSE 0.0 END AS customer_roi,
              CASE WHEN total_transactions > 0 THEN gross_profit / total_transactions ELSE 0.0 END
                  AS profit_per_transaction
            FROM (SELECT *, total_revenue - total_cost AS gross_profit FROM profit_costs) a) b) c
""",
    ["profit_costs"],
)
cte(
    "profit_totals",
    f"SELECT COUNT(*) AS n, {ms('total_revenue')} AS rev, {fs('gross_profit')} AS gp FROM profit",
    ["profit"],
)

PROFIT_COLS = (
    "customer_id, signup_date, country, industry, subscription_type, monthly_fee, total_transactions, "
    "total_revenue, avg_transaction, std_transaction, first_transaction, last_transaction, "
    "successful_transactions, failed_transactions, customer_tenure_days, days_since_last_transaction, "
    "transaction_frequency, payment_failure_rate, avg_monthly_revenue, is_churned, customer_ltv, "
    "verified_revenue, acquisition_cost, servicing_cost, transaction_cost, support_cost, infrastructure_cost, "
    "payment_processing_cost, total_cost, gross_profit, profit_margin, monthly_profit, customer_roi, "
    "profit_per_transaction, profitability_tier, tier_rank"
)
register("verified_revenue", "SELECT customer_id, verified_revenue, total_revenue FROM profit_base", "profit_base")
register(
    "revenue_percentiles",
    "SELECT * FROM (VALUES (25, 0), (50, 1), (75, 2), (90, 3), (95, 4), (99, 5)) p(percentile, i) "
    "JOIN (SELECT * FROM (" + _quantile_edges("profit_base", "total_revenue",
                                              ["0.25", "0.5", "0.75", "0.9", "0.95", "0.99"], "p") + ") "
    "UNPIVOT (value FOR k IN (p0, p1, p2, p3, p4, p5))) q ON q.k = 'p' || CAST(p.i AS VARCHAR)",
    "profit_base",
)
ORACLE["revenue_percentiles"] = ORACLE["revenue_percentiles"].replace(
    "SELECT * FROM (VALUES", "SELECT percentile, value FROM (VALUES", 1
)
register(
    "customer_costs",
    "SELECT customer_id, subscription_type, total_revenue, acquisition_cost, servicing_cost, transaction_cost, support_cost, "
    "infrastructure_cost, payment_processing_cost, total_cost FROM profit",
    "profit",
)
register("customer_profit", f"SELECT {PROFIT_COLS} FROM profit", "profit")
register(
    "cost_breakdown",
    f"""
SELECT cost_type, total, total / NULLIF(al, 0) * 100 AS pct_of_total_cost
FROM (SELECT {fs('acquisition_cost')} AS acquisition_cost, {fs('servicing_cost')} AS servicing_cost,
             {fs('transaction_cost')} AS transaction_cost, {fs('support_cost')} AS support_cost,
             {fs('infrastructure_cost')} AS infrastructure_cost,
             {fs('payment_processing_cost')} AS payment_processing_cost, {fs('total_cost')} AS al
      FROM profit)
UNPIVOT (total FOR cost_type IN (acquisition_cost, servicing_cost, transaction_cost, support_cost,
                                 infrastructure_cost, payment_processing_cost))
""",
    "profit",
)
register(
    "profit_tier_summary",
    f"""
SELECT tier, customer_count, total_revenue, total_cost, total_profit, avg_margin, avg_monthly_profit,
       CAST(customer_count AS DOUBLE) / NULLIF(t.n, 0) * 100 AS customer_pct,
       total_revenue / NULLIF(t.rev, 0) * 100 AS revenue_pct,
       total_profit / NULLIF(t.gp, 0) * 100 AS profit_pct
FROM (SELECT profitability_tier AS tier, COUNT(customer_id) AS customer_count,
             {ms('total_revenue')} AS total_revenue, {fs('total_cost')} AS total_cost,
             {fs('gross_profit')} AS total_profit,
             {fs('profit_margin')} / NULLIF(COUNT(profit_margin), 0) AS avg_margin,
             {fs('monthly_profit')} / NULLIF(COUNT(monthly_profit), 0) AS avg_monthly_profit
      FROM profit GROUP BY 1) s CROSS JOIN profit_totals t
""",
    "profit",
    "profit_totals",
)


def _contribution_sql(dim: str, margin: bool) -> str:
    m = f", {fs('profit_margin')} / NULLIF(COUNT(profit_margin), 0) AS profit_margin" if margin else ""
    mcol = ", profit_margin" if margin else ""
    return f"""
SELECT {dim}, customer_id, total_revenue, gross_profit{mcol},
       total_revenue / NULLIF(t.rev, 0) * 100 AS revenue_contribution_pct,
       gross_profit / NULLIF(t.gp, 0) * 100 AS profit_contribution_pct
FROM (SELECT {dim}, COUNT(customer_id) AS customer_id, {ms('total_revenue')} AS total_revenue,
             {fs('gross_profit')} AS gross_profit{m}
      FROM profit GROUP BY {dim}) s CROSS JOIN profit_totals t
"""


register("contribution_tier", _contribution_sql("profitability_tier", False), "profit", "profit_totals")
register("contribution_subscription", _contribution_sql("subscription_type", True), "profit", "profit_totals")
register("contribution_country", _contribution_sql("country", True), "profit", "profit_totals")
register("contribution_industry", _contribution_sql("industry", True), "profit", "profit_totals")
register(
    "profit_dashboard",
    """
SELECT customer_id, country, industry, subscription_type, total_revenue, total_cost, gross_profit,
       profit_margin, monthly_profit, customer_roi, profitability_tier, customer_tenure_days, total_transactions,
       '$' || format('{:,.2f}', total_revenue) AS revenue_formatted,
       '$' || format('{:,.2f}', gross_profit) AS profit_formatted,
       printf('%.1f', profit_margin) || '%' AS margin_formatted,
       round_even(customer_tenure_days / 30, 1) AS tenure_months
FROM profit
""",
    "profit",
)
register(
    "profit_kpis",
    f"""
SELECT * FROM (VALUES
  ('total_revenue', (SELECT {ms('total_revenue')} FROM profit)),
  ('total_cost', (SELECT {fs('total_cost')} FROM profit)),
  ('gross_profit', (SELECT {fs('gross_profit')} FROM profit)),
  ('overall_margin', (SELECT {fs('gross_profit')} / NULLIF({ms('total_revenue')}, 0) * 100 FROM profit)),
  ('total_customers', (SELECT CAST(COUNT(*) AS DOUBLE) FROM profit)),
  ('profitable_customers', (SELECT CAST(COUNT(*) FILTER (WHERE gross_profit > 0) AS DOUBLE) FROM profit)),
  ('loss_customers', (SELECT CAST(COUNT(*) FILTER (WHERE gross_profit <= 0) AS DOUBLE) FROM profit)),
  ('avg_profit_per_customer', (SELECT {fs('gross_profit')} / COUNT(gross_profit) FROM profit)),
  ('avg_monthly_profit', (SELECT {fs('monthly_profit')} / COUNT(monthly_profit) FROM profit)),
  ('avg_roi', (SELECT {fs('customer_roi')} / COUNT(customer_roi) FROM profit))
) v(metric, value)
""",
    "profit",
)
register(
    "top_profitable",
    "SELECT customer_id, subscription_type, gross_profit, profit_margin FROM profit "
    "ORDER BY gross_profit DESC, customer_id LIMIT 10",
    "profit",
)
register(
    "top_losses",
    "SELECT customer_id, subscription_type, gross_profit, profit_margin FROM profit WHERE gross_profit < 0 "
    "ORDER BY gross_profit, customer_id LIMIT 10",
    "profit",
)
register(
    "tier_costs",
    f"""
SELECT s.tier, s.tier_order, p.avg_revenue, p.avg_cost
FROM (VALUES ('Loss-Making', 0), ('Low Profit', 1), ('Medium Profit', 2), ('High Profit', 3)) s(tier, tier_order)
LEFT JOIN (SELECT profitability_tier AS tier, {fs('total_revenue')} / COUNT(total_revenue) AS avg_revenue,
                  {fs('total_cost')} / COUNT(total_cost) AS avg_cost FROM profit GROUP BY 1) p ON p.tier = s.tier
""",
    "profit",
)

# ---------------------------------------------------------------- churn risk and retention


def _retention_ctes() -> None:
    from tidemark.operators.retention import ACTION_TEMPLATES, STRATEGIES

    cte(
        "churn_pred",
        f"""
SELECT customer_id, country, industry, subscription_type, monthly_fee, total_revenue, customer_tenure_days,
       is_churned, p AS churn_probability,
       CASE WHEN p >= {dbl(0)} AND p <= {dbl(0.3)} THEN 'Low'
            WHEN p > {dbl(0.3)} AND p <= {dbl(0.6)} THEN 'Medium'
            WHEN p > {dbl(0.6)} AND p <= {dbl(1.0)} THEN 'High' END AS churn_risk_level
FROM (SELECT *, LEAST({dbl(1.0)}, days_since_last_transaction / {dbl(365)}) AS p FROM customer_features) t
""",
        ["customer_features"],
    )
    cte(
        "churn_data",
        """
SELECT p.*, f.transaction_frequency, f.avg_monthly_revenue, f.days_since_last_transaction,
       f.payment_failure_rate, f.successful_transactions, f.failed_transactions
FROM churn_pred p LEFT JOIN customer_features f ON p.customer_id = f.customer_id
""",
        ["churn_pred", "customer_features"],
    )
    cte(
        "value_scored",
        f"""
SELECT *, DENSE_RANK() OVER (PARTITION BY churn_risk_level ORDER BY value_score DESC) AS priority_rank
FROM (SELECT *, revenue_score * {dbl(0.5)} + engagement_score * {dbl(0.3)} + tenure_score * {dbl(0.2)} AS value_score
      FROM (SELECT d.*, d.total_revenue / NULLIF(m.mr, 0) * 100 AS revenue_score,
                   d.transaction_frequency / NULLIF(m.mf, 0) * 100 AS engagement_score,
                   CAST(d.customer_tenure_days AS DOUBLE) / NULLIF(m.mt, 0) * 100 AS tenure_score
            FROM churn_data d CROSS JOIN (SELECT MAX(total_revenue) AS mr, MAX(transaction_frequency) AS mf,
                                                 MAX(customer_tenure_days) AS mt FROM churn_data) m) a) b
""",
        ["churn_data"],
    )

    def by_risk(i: int) -> str:
        parts = " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(str(v[i])) if isinstance(v[i], str) else v[i]}"
                         for k, v in STRATEGIES.items())
        return f"CASE churn_risk_level {parts} END"

    def template(i: int) -> str:
        parts = " ".join(
            f"WHEN churn_risk_level = {_sql_str(r)} AND subscription_type = {_sql_str(s)} THEN {_sql_str(t[i])}"
            for (r, s), t in ACTION_TEMPLATES.items()
        )
        return f"replace(CASE {parts} END, '{{discount}}', CAST(recommended_discount_pct AS VARCHAR))"

    cte(
        "recs",
        f"""
SELECT customer_id, country, industry, subscription_type, monthly_fee, total_revenue, churn_probability,
       churn_risk_level, round_even(value_score, 2) AS value_score, CAST(priority_rank AS INTEGER) AS priority_rank,
       {by_risk(2)} AS urgency, {by_risk(3)} AS action_timeline, {by_risk(6)} AS contact_channel,
       {by_risk(0)} AS primary_action, {by_risk(1)} AS secondary_action,
       CASE WHEN payment_failure_rate > {dbl(0.1)}
              THEN 'Address payment issues - offer alternative payment methods'
            WHEN days_since_last_transaction > 90
              THEN 'Re-engagement campaign - ' || CAST(days_since_last_transaction AS VARCHAR) || ' days inactive'
            WHEN transaction_frequency < {dbl(0.5)} THEN 'Increase engagement - schedule product demo'
            ELSE {template(0)} END AS specific_recommendation,
       recommended_discount_pct,
       {template(0)} AS action_1, {template(1)} AS action_2, {template(2)} AS action_3, {template(3)} AS action_4
FROM (SELECT *, CAST(TRUNC({by_risk(4)} + ({by_risk(5)} - {by_risk(4)}) * (value_score / 100)) AS INTEGER)
                  AS recommended_discount_pct
      FROM value_scored) t
""",
        ["value_scored"],
    )


_retention_ctes()
register(
    "churn_predictions",
    "SELECT * FROM churn_pred",
    "churn_pred",
)
register(
    "churn_risk_summary",
    f"""
SELECT churn_risk_level AS risk_level, COUNT(customer_id) AS customer_count,
       {ms('total_revenue')} AS revenue_at_risk,
       {fs('churn_probability')} / NULLIF(COUNT(churn_probability), 0) AS avg_probability
FROM churn_pred GROUP BY 1
""",
    "churn_pred",
)
register(
    "high_risk_list",
    """
SELECT customer_id, country, industry, subscription_type, monthly_fee, total_revenue, customer_tenure_days,
       days_since_last_transaction, transaction_frequency, payment_failure_rate, churn_probability,
       churn_risk_level
FROM churn_data WHERE churn_risk_level = 'High'
""",
    "churn_data",
)
register(
    "value_scores",
    "SELECT * EXCLUDE (priority_rank), CAST(priority_rank AS INTEGER) AS priority_rank FROM value_scored",
    "value_scored",
)
register("retention_recommendations", "SELECT * FROM recs", "recs")
register(
    "retention_action_summary",
    f"""
SELECT churn_risk_level AS risk_level, COUNT(customer_id) AS customer_count,
       {ms('total_revenue')} AS total_revenue_at_risk,
       {fs('value_score')} / NULLIF(COUNT(value_score), 0) AS avg_value_score,
       AVG(recommended_discount_pct) AS avg_recommended_discount
FROM recs GROUP BY 1
""",
    "recs",
)
register(
    "retention_by_risk_sub",
    f"SELECT churn_risk_level AS risk_level, subscription_type, COUNT(customer_id) AS customer_count, "
    f"{ms('total_revenue')} AS revenue FROM recs GROUP BY 1, 2",
    "recs",
)
for _lvl in ("High", "Medium", "Low"):
    register(f"retention_list_{_lvl.lower()}", f"SELECT * FROM recs WHERE churn_risk_level = '{_lvl}'", "recs")
register(
    "retention_impact",
    f"SELECT CAST(COUNT(*) // 2 AS BIGINT) AS customers_saved, COALESCE({ms('total_revenue')}, 0.0) / 2 "
    "AS revenue_protected FROM recs WHERE churn_risk_level = 'High'",
    "recs",
)
register(
    "retention_top_at_risk",
    "SELECT customer_id, subscription_type, total_revenue, churn_probability, specific_recommendation FROM recs "
    "WHERE churn_risk_level = 'High' ORDER BY value_score DESC, customer_id LIMIT 10",
    "recs",
)

# ---------------------------------------------------------------- monthly series (company level)


def osum_sql(x: str) -> str:
    return (f"CASE WHEN COUNT({x}) > 0 THEN list_reduce(list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL)), "
            f"lambda a, b: a + b) END")


def omean_sql(x: str) -> str:
    return f"({osum_sql(x)}) / NULLIF(COUNT({x}), 0)"


cte(
    "mseries",
    f"""
SELECT s.date, COALESCE(v.value, 0.0) AS value
FROM (SELECT CAST(unnest(generate_series(MIN(m), MAX(m), INTERVAL 1 MONTH)) AS DATE) AS date
      FROM (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS m FROM completed) b) s
LEFT JOIN (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS date, {ms('amount')} AS value
           FROM completed GROUP BY 1) v ON v.date = s.date
""",
    ["completed"],
)


def _positions_sql(src: str, keys: tuple[str, ...] = ()) -> str:
    kc = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"""
SELECT *, CAST(CASE WHEN n >= 24 THEN 12 ELSE LEAST(12, FLOOR(n / 2)) END AS INTEGER) AS period, n >= 24 AS mult
FROM (SELECT {kc}date, value, CAST(ROW_NUMBER() OVER ({part}ORDER BY date) - 1 AS INTEGER) AS pos,
             COUNT(*) OVER ({part.strip()}) AS n
      FROM {src}) t
"""


def _decompose_sql(src: str, name: str, keys: tuple[str, ...] = ()) -> None:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    kc = "".join(f"{k}, " for k in keys)
    kjoin = "".join(f" AND t.{k} = c.{k}" for k in keys)
    kjoin2 = " AND ".join(f"c.{k} = m.{k}" for k in keys)
    terms = []
    for k in range(-6, 7):
        y = "value" if k == 0 else (f"LAG(value, {-k}) OVER ({part}ORDER BY date)" if k < 0 else f"LEAD(value, {k}) OVER ({part}ORDER BY date)")
        wk = (f"(CASE WHEN {abs(k)} > FLOOR(period / 2) THEN 0.0 WHEN period % 2 = 0 AND {abs(k)} = FLOOR(period / 2) "
              f"THEN 0.5 ELSE 1.0 END)")
        terms.append(f"COALESCE({y}, 0.0) * {wk}")
    total = "0.0 + " + " + ".join(terms)
    cte(
        f"{name}_t",
        f"""
SELECT *, CASE WHEN mult THEN value / NULLIF(trend, 0) ELSE value - trend END AS det,
       pos % GREATEST(period, 1) AS cls
FROM (SELECT *, CASE WHEN period >= 2 AND pos >= FLOOR(period / 2) AND pos <= n - 1 - FLOOR(period / 2)
                     THEN ({total}) / period END AS trend
      FROM ({_positions_sql(src, keys)}) p) q
""",
        [src],
    )
    cm_sql = f"SELECT {kc}cls, {omean_sql('det')} AS cm FROM {name}_t GROUP BY {kc}cls"
    if keys:
        cmm = f"SELECT {kc}{omean_sql('cm')} AS cmm FROM ({cm_sql}) GROUP BY {', '.join(keys)}"
        cjoin = f"JOIN ({cmm}) m ON {kjoin2}"
    else:
        cjoin = f"CROSS JOIN (SELECT {omean_sql('cm')} AS cmm FROM ({cm_sql})) m"
    cte(
        f"{name}_c",
        f"SELECT {''.join(f'c.{k}, ' for k in keys)}c.cls, c.cm, m.cmm FROM ({cm_sql}) c {cjoin}",
        [f"{name}_t"],
    )
    cte(
        name,
        f"""
SELECT {''.join(f'{k}, ' for k in keys)}date, value AS observed, trend, seasonal,
       CASE WHEN mult THEN (value / NULLIF(seasonal, 0)) / NULLIF(trend, 0) ELSE det - seasonal END AS residual,
       period, CASE WHEN mult THEN 'multiplicative' ELSE 'additive' END AS model
FROM (SELECT t.*, CASE WHEN period >= 2 THEN CASE WHEN mult THEN c.cm / NULLIF(c.cmm, 0) ELSE c.cm - c.cmm END END
                  AS seasonal
      FROM {name}_t t LEFT JOIN {name}_c c ON t.cls = c.cls{kjoin}) s
""",
        [f"{name}_t", f"{name}_c"],
    )
    cte(
        f"{name}_si",
        f"""
SELECT m.month, CASE m.month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr'
         WHEN 5 THEN 'May' WHEN 6 THEN 'Jun' WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep'
         WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec' END AS month_name,
       COALESCE(s.si, n.neutral) AS seasonal_index
FROM (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS month) m
CROSS JOIN (SELECT CASE WHEN MAX(model) = 'additive' THEN 0.0 ELSE 1.0 END AS neutral FROM {name}) n
LEFT JOIN (SELECT CAST(month(date) AS INTEGER) AS month, {omean_sql('seasonal')} AS si FROM {name} GROUP BY 1) s
  ON s.month = m.month
""",
        [name],
    )


def _kc(keys: tuple[str, ...], t: str = "") -> str:
    return "".join(f"{t}{k}, " for k in keys)


def _by(keys: tuple[str, ...]) -> str:
    return f" GROUP BY {', '.join(keys)}" if keys else ""


def _on(keys: tuple[str, ...], a: str, b: str, more: str = "") -> str:
    """JOIN condition on the series keys; one series joins its one row."""
    return " AND ".join([f"{a}.{k} = {b}.{k}" for k in keys] + ([more] if more else [])) or "true"


def _over(keys: tuple[str, ...]) -> str:
    return (f"PARTITION BY {', '.join(keys)} " if keys else "") + "ORDER BY date"


def _ols_sql(y: str, x: str) -> str:
    both = f"({y}) IS NOT NULL AND ({x}) IS NOT NULL"
    y, x = f"(CASE WHEN {both} THEN {y} END)", f"(CASE WHEN {both} THEN {x} END)"
    return (f"COUNT({y}) AS _n, {osum_sql(x)} AS _sx, {osum_sql(y)} AS _sy, {osum_sql(f'{x} * {x}')} AS _sxx, "
            f"{osum_sql(f'{x} * {y}')} AS _sxy, {osum_sql(f'{y} * {y}')} AS _syy")


def _ols_fit_sql(inner: str) -> str:
    return f"""
SELECT *, (_sy - slope * _sx) / NULLIF(_n, 0) AS intercept, GREATEST(cyy - slope * cxy, 0.0) AS sse
FROM (SELECT *, COALESCE(cxy / NULLIF(cxx, 0), 0.0) AS slope
      FROM (SELECT *, _sxx - _sx * _sx / NULLIF(_n, 0) AS cxx, _sxy - _sx * _sy / NULLIF(_n, 0) AS cxy,
                   _syy - _sy * _sy / NULLIF(_n, 0) AS cyy
            FROM ({inner}) a) b) c
"""


def _gram_sql(rows: str, width: str) -> str:
    return (f"list_transform(range(1, {width} + 1), lambda i: list_transform(range(1, {width} + 1), lambda j: "
            f"list_reduce(list_transform({rows}, lambda r: r[i] * r[j]), lambda a, v: a + v, CAST(0 AS DOUBLE))))")


def _swept_sql(g: str, upto: str) -> str:
    """The matrix ``g`` swept on its first ``upto`` columns, one after another."""
    cell = ("CASE WHEN i = k AND j = k THEN -1 / acc[k][k] WHEN i = k OR j = k THEN x / acc[k][k] "
            "ELSE x - r[k] * acc[k][j] / acc[k][k] END")
    return (f"list_reduce(range(1, {upto} + 1), lambda acc, k: CASE WHEN acc[k][k] <= 1e-12 * {g}[k][k] THEN acc ELSE "
            f"list_transform(acc, lambda r, i: list_transform(r, lambda x, j: {cell})) END, {g})")


def _stationarity_sql(src: str, name: str, keys: tuple[str, ...] = ()) -> None:
    obs = ("list_transform(range({p} + 2, _n + 1), lambda t: list_concat([CAST(1 AS DOUBLE), z[t - 1]], "
           "list_transform(range(1, {p} + 1), lambda i: z[t - i] - z[t - i - 1]), [z[t] - z[t - 1]]))")
    n = "CAST(NULLIF(n_obs, 0) AS DOUBLE)"
    k = ", ".join(keys) + ", " if keys else ""
    score = (f"list_transform(range(0, most + 1), lambda p: rows * ln(GREATEST({_swept_sql('g', 'p + 2')}[most + 3][most + 3], 1e-24) / rows)"
             " + 2 * (p + 2))")
    density = "exp(-x * x / 2) * 0.3989422804014327"
    tail = "list_reduce(list_reverse(range(1, 121)), lambda a, i: 1 + x * x / (2 * i + 1) * a, CAST(1 AS DOUBLE))"
    cte(f"{name}_y", f"SELECT {_kc(keys)}COALESCE(list(value ORDER BY date), []) AS y, COUNT(*) AS _n, AVG(value) AS mean FROM {src}{_by(keys)}", [src])
    cte(
        f"{name}_z",
        f"""
SELECT {k}_n, z, CASE WHEN top > 0 AND most >= 0 THEN most END AS most, _n - 1 - most AS rows
FROM (SELECT *, list_transform(y, lambda v: (v - mean) / NULLIF(top, 0)) AS z,
             CAST(LEAST(ceil(12 * pow(_n / 100, 0.25)), floor(_n / 2) - 2) AS BIGINT) AS most
      FROM (SELECT *, list_max(list_transform(y, lambda v: abs(v - mean))) AS top FROM {name}_y) a) b
""",
        [f"{name}_y"],
    )
    cte(f"{name}_g", f"SELECT *, CASE WHEN most IS NOT NULL THEN {_gram_sql(obs.format(p='most'), '(most + 3)')} END AS g FROM {name}_z", [f"{name}_z"])
    cte(
        f"{name}_p",
        f"SELECT {k}_n, z, CASE WHEN most IS NOT NULL THEN list_position(s, list_min(s)) - 1 END AS p "
        f"FROM (SELECT *, CASE WHEN most IS NOT NULL THEN {score} END AS s FROM {name}_g) a",
        [f"{name}_g"],
    )
    cte(
        f"{name}_t",
        f"""
SELECT {k}n_obs, p, CASE WHEN s[2][2] < 0 AND s[p + 3][p + 3] > 1e-12 * h[p + 3][p + 3]
                         THEN s[2][p + 3] / sqrt(s[p + 3][p + 3] / (n_obs - p - 2) * -s[2][2]) END AS tstat
FROM (SELECT *, GREATEST(_n - 1 - COALESCE(p, 0), 0) AS n_obs, CASE WHEN p IS NOT NULL THEN {_swept_sql('h', 'p + 2')} END AS s
      FROM (SELECT *, CASE WHEN p IS NOT NULL THEN {_gram_sql(obs.format(p='p'), '(p + 3)')} END AS h FROM {name}_p) a) b
""",
        [f"{name}_p"],
    )
    cte(
        name,
        f"""
SELECT {k}n_obs, CAST(CASE WHEN tstat IS NOT NULL THEN p END AS INTEGER) AS lags, tstat AS adf_statistic, critical_value_5pct, p_value,
       CASE WHEN p_value < 0.05 THEN 0 ELSE 1 END AS d
FROM (SELECT *, CASE WHEN tstat > 2.74 THEN 1.0 WHEN tstat < -18.83 THEN 0.0
                     WHEN tstat IS NOT NULL THEN GREATEST(LEAST(0.5 + x * {tail} * {density}, 1), 0) END AS p_value
      FROM (SELECT *, -2.86154 + -2.8903 / {n} + -4.234 / ({n} * {n}) + -40.04 / ({n} * {n} * {n}) AS critical_value_5pct,
                   GREATEST(LEAST(CASE WHEN tstat <= -1.61 THEN 2.1659 + 1.4412 * tstat + 0.038269 * tstat * tstat
                        ELSE 1.7339 + 0.93202 * tstat - 0.12745 * tstat * tstat - 0.010368 * tstat * tstat * tstat END, 8), -8) AS x
            FROM {name}_t) f) e
""",
        [f"{name}_t"],
    )


def _arma_sql(st: str, name: str, keys: tuple[str, ...] = ()) -> None:
    """``{name}``: AIC and fit of all orders of the series behind the stationarity test ``st``; ``{name}_fc``: the best one's forecast."""
    k = ", ".join(keys) + ", " if keys else ""
    zero = "CAST(0 AS DOUBLE)"
    back_of = lambda values, n: f"list_transform(range(1, {n} + 1), lambda i: {values}[t - i])"
    total = lambda values: f"list_reduce({values}, lambda a, v: a + v, {zero})"
    cte(
        f"{name}_x",
        f"""
SELECT *, list_transform(x, lambda v: CASE WHEN top > 0 THEN (v - mean) / top ELSE {zero} END) AS z,
       n - m - 3 < 8 AS short, CASE WHEN n - m - 3 < 8 THEN 0 ELSE m + 3 END AS start
FROM (SELECT *, COALESCE(list_max(list_transform(x, lambda v: abs(v - mean))), 0) AS top, GREATEST(1, LEAST(7, n // 4)) AS m
      FROM (SELECT *, len(x) AS n, COALESCE(list_avg(x), 0) AS mean
            FROM (SELECT {_kc(keys, 'a.')}a.y, b.d, CASE WHEN b.d = 1 THEN list_transform(range(2, len(a.y) + 1), lambda t: a.y[t] - a.y[t - 1]) ELSE a.y END AS x
                  FROM {st}_y a JOIN {st} b ON {_on(keys, 'a', 'b')} WHERE len(a.y) > 0) w) v) u
""",
        [f"{st}_y", st],
    )
    cte(
        f"{name}_l",
        f"""
SELECT *, list_transform(range(1, m + 2), lambda i: CASE WHEN ls[i][i] < 0 THEN ls[i][m + 2] ELSE 0 END) AS lb
FROM (SELECT *, CASE WHEN NOT short THEN {_swept_sql('lg', 'm + 1')} END AS ls
      FROM (SELECT *, CASE WHEN NOT short THEN {_gram_sql('lr', '(m + 2)')} END AS lg
            FROM (SELECT *, CASE WHEN short THEN [] ELSE list_transform(range(m + 1, n + 1), lambda t: list_concat([CAST(1 AS DOUBLE)], {back_of('z', 'm')}, [z[t]])) END AS lr
                  FROM {name}_x) a) b) c
""",
        [f"{name}_x"],
    )
    fitted = total("list_transform(range(1, m + 2), lambda i: r[i] * lb[i])")
    cte(
        f"{name}_r",
        f"""
SELECT *, list_transform(range(start + 1, n + 1), lambda t: list_concat([CAST(1 AS DOUBLE)], {back_of('z', 'p')}, {back_of('e', 'q')}, [z[t]])) AS rs
FROM (SELECT *, list_concat(list_transform(range(0, m), lambda i: {zero}), list_transform(lr, lambda r: r[m + 2] - {fitted})) AS e FROM {name}_l) a
JOIN (SELECT CAST(i // 4 AS INTEGER) AS p, CAST(i % 4 AS INTEGER) AS q FROM range(16) o(i)) o ON NOT short OR (p = 0 AND q = 0)
""",
        [f"{name}_l"],
    )
    cte(
        name,
        f"""
SELECT *, CASE WHEN flat THEN NULL ELSE (n - start) * ln(v) + 2 * (p + q + 1) END AS aic,
       CASE WHEN flat THEN 'constant' WHEN short THEN 'short' ELSE 'ok' END AS status
FROM (SELECT *, CASE WHEN flat THEN 0 ELSE s[p + q + 2][p + q + 2] / (n - start) * top * top END AS v,
             list_transform(range(1, p + q + 2), lambda i: CASE WHEN s[i][i] < 0 THEN s[i][p + q + 2] ELSE 0 END) AS b
      FROM (SELECT *, NOT s[p + q + 2][p + q + 2] > 1e-12 * g[p + q + 2][p + q + 2] AS flat
            FROM (SELECT *, {_swept_sql('g', 'p + q + 1')} AS s
                  FROM (SELECT *, {_gram_sql('rs', '(p + q + 2)')} AS g FROM {name}_r) a) c) h) i
""",
        [f"{name}_r"],
    )
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    past = total("list_transform([1, 2, 3], lambda i: phi[i] * acc[len(acc) - i + 1])")
    shock = total("list_transform([1, 2, 3], lambda j: CASE WHEN j >= k THEN theta[j] * ends[len(ends) - (j - k)] ELSE 0 END)")
    residual = total("list_transform(range(1, p + q + 2), lambda i: r[i] * b[i])")
    pad = f"[{zero}, {zero}, {zero}]"
    cte(
        f"{name}_fc",
        f"""
WITH best AS (
  SELECT *, list_transform([1, 2, 3], lambda i: CASE WHEN i <= p THEN b[1 + i] ELSE 0 END) AS phi,
         list_transform([1, 2, 3], lambda j: CASE WHEN j <= q THEN b[1 + p + j] ELSE 0 END) AS theta,
         list_concat({pad}, list_transform(rs, lambda r: r[p + q + 2] - {residual})) AS ends
  FROM {name} QUALIFY row_number() OVER ({part}ORDER BY COALESCE(aic, CAST('-Infinity' AS DOUBLE)), p + q, p) = 1),
paths AS (
  SELECT *, list_transform(list_reduce(range(1, 13), lambda acc, k: list_append(acc, b[1] + {past} + {shock}), list_concat({pad}, z)),
                           lambda v: mean + top * v)[-12:] AS ahead,
         list_reduce(range(1, 12), lambda acc, k: list_append(acc, {past} + CASE WHEN k <= 3 THEN theta[k] ELSE 0 END), [{zero}, {zero}, CAST(1 AS DOUBLE)])[3:] AS psi
  FROM best),
steps AS (SELECT *, CAST(unnest(range(1, 13)) AS INTEGER) AS step FROM paths),
bands AS (
  SELECT *, CASE WHEN d = 1 THEN y[-1] + list_sum(ahead[1:step]) ELSE ahead[step] END AS fc,
         1.96 * sqrt(v * list_sum(list_transform(range(1, step + 1), lambda h: CASE WHEN d = 1 THEN list_sum(psi[1:h]) ELSE psi[h] END ** 2))) AS half
  FROM steps)
SELECT {k}step, p, q, status, fc AS forecast, fc - half AS lower, fc + half AS upper FROM bands
""",
        [name],
    )


def _forecast_ar_sql(src: str, name: str, horizon: int, keys: tuple[str, ...] = ()) -> None:
    _stationarity_sql(src, f"{name}_st", keys)
    cte(
        f"{name}_z",
        f"""
SELECT *, LAG(z) OVER ({_over(keys)}) AS zl
FROM (SELECT {_kc(keys, 's.')}s.date, s.value, st.d,
             CASE WHEN st.d = 1 THEN s.value - LAG(s.value) OVER ({_over(tuple('s.' + k for k in keys)).replace('BY date', 'BY s.date')}) ELSE s.value END AS z
      FROM {src} s JOIN {name}_st st ON {_on(keys, 's', 'st')}) a
""",
        [src, f"{name}_st"],
    )
    fit = _ols_fit_sql(f"SELECT {_kc(keys)}{_ols_sql('z', 'zl')} FROM {name}_z{_by(keys)}")
    cte(
        name,
        f"""
SELECT {_kc(keys)}CAST(T + to_months(step) AS DATE) AS date, step, fc AS forecast,
       CASE WHEN half IS NOT NULL THEN fc - half END AS lower, CASE WHEN half IS NOT NULL THEN fc + half END AS upper
FROM (SELECT *, CASE WHEN d = 1 THEN yT + hh * mu + (zT - mu) * slope * ((1 - ph) / NULLIF(1 - slope, 0))
                     ELSE mu + ph * (yT - mu) END AS fc,
             CASE WHEN s2 IS NOT NULL THEN 1.96 * sqrt(GREATEST(s2 * CASE WHEN d = 1 THEN
                 (hh - 2 * slope * ((1 - ph) / NULLIF(1 - slope, 0)) + (slope * slope) * s0)
                   / NULLIF((1 - slope) * (1 - slope), 0)
               ELSE s0 END, 0.0)) END AS half
      FROM (SELECT *, CAST(step AS DOUBLE) AS hh, pow(slope, CAST(step AS DOUBLE)) AS ph,
                   (1 - pow(slope * slope, CAST(step AS DOUBLE))) / NULLIF(1 - slope * slope, 0) AS s0
            FROM (SELECT f.*, COALESCE(intercept, 0.0) / NULLIF(1 - slope, 0) AS mu,
                         CASE WHEN _n > 2 THEN sse / (_n - 2) END AS s2,
                         l.T, l.yT, COALESCE(l.zT, 0.0) AS zT, l.d, CAST(unnest(generate_series(1, {horizon})) AS INTEGER) AS step
                  FROM ({fit}) f
                  JOIN (SELECT {_kc(keys)}MAX(date) AS T, arg_max(value, date) AS yT, arg_max(z, date) AS zT,
                               FIRST(d) AS d FROM {name}_z{_by(keys)}) l ON {_on(keys, 'f', 'l')}) a) b) c
""",
        [f"{name}_z"],
    )


def _forecast_st_sql(src: str, name: str, horizon: int, keys: tuple[str, ...] = ()) -> None:
    """Trend on the deseasonalised series; the component of a position class goes with it."""
    _decompose_sql(src, f"{name}_dec", keys)
    cte(
        f"{name}_h",
        f"""
SELECT *, CASE WHEN mult THEN observed / NULLIF(s, 0) ELSE observed - s END AS ds
FROM (SELECT *, pos % GREATEST(period, 1) AS cls, COALESCE(seasonal, CASE WHEN mult THEN 1.0 ELSE 0.0 END) AS s
      FROM (SELECT *, CAST(ROW_NUMBER() OVER ({_over(keys)}) - 1 AS INTEGER) AS pos, model = 'multiplicative' AS mult
            FROM {name}_dec) p) q
""",
        [f"{name}_dec"],
    )
    cte(f"{name}_f", _ols_fit_sql(f"SELECT {_kc(keys)}{_ols_sql('ds', 'CAST(pos AS DOUBLE)')} FROM {name}_h{_by(keys)}"), [f"{name}_h"])
    line = "(f.intercept + f.slope * {x})"
    cte(
        f"{name}_fit",
        f"SELECT h.*, CASE WHEN h.mult THEN {line.format(x='h.pos')} * h.s ELSE {line.format(x='h.pos')} + h.s END AS fitted "
        f"FROM {name}_h h JOIN {name}_f f ON {_on(keys, 'h', 'f')}",
        [f"{name}_h", f"{name}_f"],
    )
    cte(
        f"{name}_sd",
        f"SELECT {_kc(keys)}sqrt(({osum_sql('(observed - fitted) * (observed - fitted)')}) / NULLIF(COUNT(observed) - 1, 0)) AS sd, "
        f"MAX(date) AS T, COUNT(*) AS nn, MAX(period) AS period FROM {name}_fit{_by(keys)}",
        [f"{name}_fit"],
    )
    cte(
        name,
        f"""
SELECT {_kc(keys, 'a.')}a.date, a.fitted AS forecast, a.fitted - 1.96 * b.sd AS lower, a.fitted + 1.96 * b.sd AS upper, false AS is_forecast
FROM {name}_fit a JOIN {name}_sd b ON {_on(keys, 'a', 'b')}
UNION ALL
SELECT {_kc(keys)}date, fitted, fitted - 1.96 * sd, fitted + 1.96 * sd, true
FROM (SELECT {_kc(keys, 'x.')}x.date, x.sd, CASE WHEN c.mult THEN {line.format(x='(x.nn - 1 + x.step)')} * c.s
                          ELSE {line.format(x='(x.nn - 1 + x.step)')} + c.s END AS fitted
      FROM (SELECT *, CAST(T + to_months(step) AS DATE) AS date FROM
             (SELECT *, CAST(unnest(generate_series(1, {horizon})) AS INTEGER) AS step FROM {name}_sd) q) x
      JOIN {name}_f f ON {_on(keys, 'x', 'f')}
      JOIN (SELECT DISTINCT {_kc(keys)}cls, s, mult FROM {name}_h) c
        ON {_on(keys, 'x', 'c', 'c.cls = (x.nn - 1 + x.step) % GREATEST(x.period, 1)')}) y
""",
        [f"{name}_fit", f"{name}_sd", f"{name}_f", f"{name}_h"],
    )


def _sweep_sql(g: str, k: str) -> str:
    cell = f"CASE WHEN i = {k} AND j = {k} THEN -1 / {g}[{k}][{k}] WHEN i = {k} OR j = {k} THEN x / {g}[{k}][{k}] ELSE x - r[{k}] * {g}[{k}][j] / {g}[{k}][{k}] END"
    return f"list_transform({g}, lambda r, i: list_transform(r, lambda x, j: {cell}))"


def _bent_sql(st: str, name: str, horizon: int, keys: tuple[str, ...] = ()) -> None:
    """The bent trend on the deseasonalised series ``{st}_h``: one step of the selection a CTE."""
    k = ", ".join(keys) + ", " if keys else ""
    cte(
        f"{name}_y",
        f"""
SELECT *, CASE WHEN k > 0 THEN list_transform(range(1, k + 1), lambda i: (2 * i * (hist - 1) + k) // (2 * k)) ELSE [] END AS cps
FROM (SELECT *, CASE WHEN n < 12 THEN 0 ELSE LEAST(25, hist - 1) END AS k
      FROM (SELECT {_kc(keys)}COUNT(*) AS n, COUNT(*) * 4 // 5 AS hist, GREATEST(COUNT(*) - 1, 1) AS span, list(ds ORDER BY pos) AS y,
                   COALESCE(NULLIF(MAX(abs(ds)), 0), 1) AS scale, MIN(date) AS first_date
            FROM {st}_h{_by(keys)}{"" if keys else " HAVING COUNT(*) > 0"}) a) b
""",
        [f"{st}_h"],
    )
    row = ("list_concat([CAST(1 AS DOUBLE), t / span], list_transform(cps, lambda c: GREATEST(t - c, 0) / span), [y[t + 1] / scale])")
    cte(
        f"{name}_0",
        f"""
SELECT *, {_swept_sql('g', '2')} AS s
FROM (SELECT *, {_gram_sql('seen', '(k + 3)')} AS g
      FROM (SELECT *, list_transform(list_filter(range(0, n), lambda t: y[t + 1] IS NOT NULL), lambda t: {row}) AS seen FROM {name}_y) a) b
""",
        [f"{name}_y"],
    )
    others = "* EXCLUDE (s, gains, best, gain, sse, least)"
    for step in range(5):
        cte(
            f"{name}_{step + 1}",
            f"""
SELECT {others}, CASE WHEN k > 0 AND sse > least AND len(seen) * ln(sse / GREATEST(sse - gain, least)) > 2 * ln(len(seen))
                      THEN {_sweep_sql('s', 'best')} ELSE s END AS s
FROM (SELECT *, 2 + list_position(gains, list_max(gains)) AS best, list_max(gains) AS gain, s[k + 3][k + 3] AS sse, 1e-12 * g[k + 3][k + 3] AS least
      FROM (SELECT *, list_transform(range(3, k + 3), lambda c: CASE WHEN s[c][c] > 1e-9 * g[c][c] THEN s[c][k + 3] * s[c][k + 3] / s[c][c] ELSE 0 END) AS gains
            FROM {name}_{step}) a) b
""",
            [f"{name}_{step}"],
        )
    cte(
        f"{name}_b",
        f"SELECT *, list_transform(range(1, k + 3), lambda i: CASE WHEN s[i][i] < 0 THEN s[i][k + 3] * scale ELSE 0 END) AS b FROM {name}_5",
        [f"{name}_5"],
    )
    trend = ("m.b[1] + m.b[2] * {t} / m.span + COALESCE(list_sum(list_transform(range(1, m.k + 1), lambda i: m.b[i + 2] * GREATEST({t} - m.cps[i], 0) / m.span)), 0)")
    season = lambda t: f"CASE WHEN h.mult THEN ({trend.format(t=t)}) * h.s ELSE ({trend.format(t=t)}) + h.s END"
    cte(
        f"{name}_past",
        f"SELECT {_kc(keys, 'h.')}h.date, h.observed, {season('h.pos')} AS f, h.pos, h.cls, m.n FROM {st}_h h JOIN {name}_b m ON {_on(keys, 'h', 'm')}",
        [f"{st}_h", f"{name}_b"],
    )
    cte(
        name,
        f"""
SELECT {_kc(keys, 'a.')}a.date, a.f AS forecast, a.f - 1.96 * b.sd AS lower, a.f + 1.96 * b.sd AS upper, a.ahead AS is_forecast
FROM (SELECT {_kc(keys)}date, f, false AS ahead FROM {name}_past
      UNION ALL
      SELECT {_kc(keys, 'm.')}CAST(m.first_date + to_months(CAST(m.n - 1 + o.step AS INTEGER)) AS DATE), {season('(m.n - 1 + o.step)')}, true
      FROM {name}_b m CROSS JOIN (SELECT unnest(range(1, {horizon + 1})) AS step) o
      JOIN {st}_h h ON {_on(keys, 'h', 'm', 'h.pos = (m.n - 1 + o.step) % GREATEST(h.period, 1)')}) a
JOIN (SELECT {_kc(keys)}CASE WHEN COUNT(*) > 1 THEN sqrt(SUM((observed - f) * (observed - f)) / (COUNT(*) - 1)) END AS sd FROM {name}_past{_by(keys)}) b
  ON {_on(keys, 'a', 'b')}
""",
        [f"{name}_past", f"{name}_b", f"{st}_h"],
    )
    cte(
        f"{name}_cp",
        f"""
SELECT {k}CAST(first_date + to_months(CAST(cps[i] AS INTEGER)) AS DATE) AS date, list_sum(b[2:i + 1]) / span AS slope_before, list_sum(b[2:i + 2]) / span AS slope_after
FROM (SELECT *, unnest(range(1, k + 1)) AS i FROM {name}_b) a WHERE s[i + 2][i + 2] < 0
""",
        [f"{name}_b"],
    )


def _holdout_sql(src: str, name: str, keys: tuple[str, ...] = ()) -> None:
    over = _over(keys).replace("ORDER BY date", "ORDER BY date DESC")
    cte(f"{name}_rk", f"SELECT *, ROW_NUMBER() OVER ({over}) AS rk FROM {src}", [src])
    cte(f"{name}_train", f"SELECT {_kc(keys)}date, value FROM {name}_rk WHERE rk > 3", [f"{name}_rk"])
    cte(f"{name}_test", f"SELECT {_kc(keys)}date, value AS actual FROM {name}_rk WHERE rk <= 3", [f"{name}_rk"])
    _forecast_ar_sql(f"{name}_train", f"{name}_ar", 3, keys)
    _forecast_st_sql(f"{name}_train", f"{name}_stf", 3, keys)
    err = "(f.forecast - t.actual)"
    one = lambda fc, model: (
        f"SELECT {_kc(keys, 't.')}{omean_sql(f'abs({err})')} AS mae, sqrt({omean_sql(f'{err} * {err}')}) AS rmse, "
        f"({omean_sql(f'abs({err}) / GREATEST(abs(t.actual), 2.220446049250313e-16)')}) * 100 AS mape, '{model}' AS model "
        f"FROM {name}_test t LEFT JOIN {fc} f ON {_on(keys, 't', 'f', 'f.date = t.date')}"
        + (f" GROUP BY {', '.join('t.' + k for k in keys)}" if keys else "")
    )
    cte(
        name,
        f"SELECT * FROM ({one(f'(SELECT * FROM {name}_stf WHERE is_forecast)', 'seasonal_trend')}) "
        f"UNION ALL SELECT * FROM ({one(f'{name}_ar', 'ar')})",
        [f"{name}_test", f"{name}_stf", f"{name}_ar"],
    )


_decompose_sql("mseries", "decomp")
_stationarity_sql("mseries", "stationarity")
_arma_sql("stationarity", "arma")
_forecast_ar_sql("mseries", "fc_ar", 12)
_forecast_st_sql("mseries", "fc_st", 12)
_holdout_sql("mseries", "fc_metrics")
_bent_sql("fc_st", "fc_bent", 12)

cte(
    "combined",
    """
SELECT *, CAST(CAST(SUM(CAST(CAST(forecast_ensemble AS VARCHAR) AS DECIMAL(38,12))) OVER (ORDER BY date ROWS BETWEEN
                        UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS DOUBLE) AS cumulative_forecast
FROM (SELECT s.date, s.forecast AS forecast_seasonal, a.forecast AS forecast_ar,
             (s.forecast + a.forecast) / 2 AS forecast_ensemble, CAST(year(s.date) AS INTEGER) AS year, CAST(month(s.date) AS INTEGER) AS month,
             strftime(s.date, '%B') AS month_name, CAST(quarter(s.date) AS INTEGER) AS quarter
      FROM (SELECT * FROM fc_st WHERE is_forecast) s JOIN fc_ar a ON a.date = s.date) j
""",
    ["fc_st", "fc_ar"],
)

_R2 = "ROUND({0}, 2) AS {0}"
BAND = ", ".join(_R2.format(c) for c in ("forecast", "lower", "upper"))
TEST = "ROUND(adf_statistic, 6) AS adf_statistic, ROUND(critical_value_5pct, 6) AS critical_value_5pct, ROUND(p_value, 6) AS p_value"
ERRORS = ", ".join(f"ROUND({c}, 4) AS {c}" for c in ("mae", "rmse", "mape"))
ENSEMBLE = ", ".join(_R2.format(c) for c in ("forecast_seasonal", "forecast_ar", "forecast_ensemble", "cumulative_forecast"))

register("monthly_series", "SELECT * FROM mseries", "mseries")
register("decomposition", "SELECT * FROM decomp", "decomp")
register("seasonal_indices", "SELECT * FROM decomp_si", "decomp_si")
register(
    "trend_growth",
    "SELECT trend_start, trend_end, (trend_end / NULLIF(trend_start, 0) - 1) * 100 AS trend_growth_pct FROM "
    "(SELECT arg_min(trend, date) AS trend_start, arg_max(trend, date) AS trend_end, COUNT(*) AS nt "
    "FROM decomp WHERE trend IS NOT NULL) t WHERE nt > 1",
    "decomp",
)
SLOPES = ", ".join(_R2.format(c) for c in ("slope_before", "slope_after"))
register("forecast_bent_trend", f"SELECT * REPLACE ({BAND}) FROM fc_bent", "fc_bent")
register("trend_change_points", f"SELECT * REPLACE ({SLOPES}) FROM fc_bent_cp", "fc_bent_cp")
_AHEAD = "CAST((SELECT MAX(date) FROM {src} m{on}) + to_months(step) AS DATE) AS date"
register("arma_order_aic", "SELECT p, q, status, ROUND(aic, 4) AS aic FROM arma", "arma")
register("forecast_arma", f"SELECT * REPLACE ({BAND}), {_AHEAD.format(src='mseries', on='')} FROM arma_fc", "arma_fc", "mseries")
register("stationarity", f"SELECT * REPLACE ({TEST}) FROM stationarity", "stationarity")
register("forecast_ar", f"SELECT * REPLACE ({BAND}) FROM fc_ar", "fc_ar")
register("forecast_seasonal_trend", f"SELECT * REPLACE ({BAND}) FROM fc_st", "fc_st")
register("forecast_metrics", f"SELECT * REPLACE ({ERRORS}) FROM fc_metrics", "fc_metrics")
register(
    "model_comparison",
    """
SELECT m.metric, ROUND(m.seasonal_trend, 4) AS seasonal_trend, ROUND(m.ar, 4) AS ar, b.best_model FROM (
  SELECT metric, MAX(CASE WHEN model = 'seasonal_trend' THEN value END) AS seasonal_trend,
         MAX(CASE WHEN model = 'ar' THEN value END) AS ar
  FROM (SELECT model, 'MAE' AS metric, mae AS value FROM fc_metrics UNION ALL
        SELECT model, 'RMSE', rmse FROM fc_metrics UNION ALL SELECT model, 'MAPE (%)', mape FROM fc_metrics) l
  GROUP BY metric) m
CROSS JOIN (SELECT arg_min(model, (mape, CASE WHEN model = 'ar' THEN 0 ELSE 1 END)) AS best_model FROM fc_metrics) b
""",
    "fc_metrics",
)
register("combined_forecast", f"SELECT * REPLACE ({ENSEMBLE}) FROM combined", "combined")
register(
    "forecast_totals",
    f"SELECT ROUND({ms('forecast_ensemble')}, 2) AS forecasted_revenue_total, "
    f"ROUND({ms('forecast_ensemble')} / NULLIF(COUNT(forecast_ensemble), 0), 2) AS avg_monthly_forecast FROM combined",
    "combined",
)

# ---------------------------------------------------------------- rule clusters (labels as in M12)
cte(
    "rule_clusters",
    "SELECT *, CASE WHEN RFM_total >= 12 THEN 0 WHEN RFM_total >= 9 THEN 1 WHEN RFM_total >= 6 THEN 2 ELSE 3 END AS cluster FROM rfm_B",
    ["rfm_B"],
)
cte(
    "rule_profile",
    f"""
SELECT *, (['VIP Elite', 'Engaged Regulars', 'Growth Potential', 'Casual Buyers', 'Dormant', 'At-Risk', 'Lost'])[
          ROW_NUMBER() OVER (ORDER BY avg_rfm_score DESC, cluster)] AS behavioral_segment
FROM (SELECT cluster, COUNT(customer_id) AS customer_count, AVG(recency) AS avg_recency, AVG(frequency) AS avg_frequency,
             {ms('monetary')} AS total_revenue, {fs('monetary')} / NULLIF(COUNT(monetary), 0) AS avg_revenue,
             AVG(RFM_total) AS avg_rfm_score
      FROM rule_clusters GROUP BY cluster) g
""",
    ["rule_clusters"],
)
cte(
    "rule_labels",
    "SELECT c.customer_id, p.behavioral_segment FROM rule_clusters c JOIN rule_profile p ON p.cluster = c.cluster",
    ["rule_clusters", "rule_profile"],
)
register("rule_cluster_profile", "SELECT * FROM rule_profile", "rule_profile")
register(
    "rule_segmentation_dashboard",
    """
SELECT b.customer_id, recency, frequency, monetary, R_score, F_score, M_score, RFM_score, RFM_total, rfm_segment,
       l.behavioral_segment, country, industry, subscription_type, '$' || format('{:,.2f}', monetary) AS revenue_formatted
FROM rfm_B b LEFT JOIN rule_labels l ON l.customer_id = b.customer_id
""",
    "rfm_B",
    "rule_labels",
)

# ---------------------------------------------------------------- unified / executive exports
cte(
    "master",
    """
SELECT *, (['Bronze', 'Silver', 'Gold', 'Platinum'])[
          CASE WHEN n <= 1 THEN 1 ELSE GREATEST(1, (4 * (vr - 1) + n - 2) // GREATEST(n - 1, 1)) END] AS customer_value_tier
FROM (
  SELECT f.customer_id, f.signup_date, f.country, f.industry, f.subscription_type, f.monthly_fee, f.total_revenue,
         f.customer_tenure_days, f.is_churned,
         COALESCE(c.churn_probability, 0.0) AS churn_probability,
         COALESCE(c.churn_risk_level, 'Unknown') AS churn_risk_level,
         COALESCE(r.primary_action, 'Not Assigned') AS retention_action, r.urgency, r.recommended_discount_pct,
         r.specific_recommendation,
         p.gross_profit, p.profit_margin, COALESCE(p.profitability_tier, 'Unknown') AS profitability_tier, p.total_cost,
         COALESCE(b.rfm_segment, 'Unknown') AS customer_segment, b.R_score, b.F_score, b.M_score, b.RFM_total,
         cl.behavioral_segment,
         strftime(f.signup_date, '%Y-%m') AS signup_cohort, CAST(year(f.signup_date) AS INTEGER) AS signup_year,
         CAST(quarter(f.signup_date) AS INTEGER) AS signup_quarter,
         round_even(CAST(m.ref - f.signup_date AS INTEGER) / 30, 1) AS lifetime_months,
         ROW_NUMBER() OVER (ORDER BY f.total_revenue, f.customer_id) AS vr, COUNT(*) OVER () AS n
  FROM customer_features f
  LEFT JOIN churn_pred c ON c.customer_id = f.customer_id
  LEFT JOIN recs r ON r.customer_id = f.customer_id
  LEFT JOIN profit p ON p.customer_id = f.customer_id
  LEFT JOIN rfm_B b ON b.customer_id = f.customer_id
  LEFT JOIN rule_labels cl ON cl.customer_id = f.customer_id
  CROSS JOIN (SELECT MAX(transaction_date) AS ref FROM txns) m) t
""",
    ["customer_features", "churn_pred", "recs", "profit", "rfm_B", "rule_labels", "txns"],
)
MASTER_COLS = (
    "customer_id, signup_date, country, industry, subscription_type, monthly_fee, total_revenue, customer_tenure_days, "
    "is_churned, churn_probability, churn_risk_level, retention_action, urgency, recommended_discount_pct, "
    "specific_recommendation, gross_profit, profit_margin, profitability_tier, total_cost, customer_segment, R_score, "
    "F_score, M_score, RFM_total, behavioral_segment, signup_cohort, signup_year, signup_quarter, lifetime_months, "
    "customer_value_tier"
)
cte(
    "mbs",
    f"""
SELECT month, revenue, transactions, active_customers,
       COALESCE((revenue / NULLIF(LAG(revenue) OVER (ORDER BY month), 0) - 1) * 100, 0.0) AS revenue_mom,
       COALESCE((CAST(active_customers AS DOUBLE) / NULLIF(LAG(active_customers) OVER (ORDER BY month), 0) - 1) * 100, 0.0)
           AS customer_mom,
       COALESCE(a.new_customers, 0) AS new_customers,
       COALESCE(ch.churned_customers, 0) AS churned_customers, COALESCE(ch.churn_rate, 0.0) AS churn_rate,
       COALESCE(ch.avg_churn_prob, 0.0) AS avg_churn_prob,
       COALESCE(revenue * mg.am, 0.0) AS estimated_profit, COALESCE(mg.am * 100, 0.0) AS profit_margin_pct,
       hr.total_high_risk_customers, COALESCE(hr.revenue_at_risk, 0.0) AS revenue_at_risk,
       CAST(CAST(SUM(CAST(CAST(revenue AS VARCHAR) AS DECIMAL(38,12))) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS VARCHAR) AS DOUBLE) AS cumulative_revenue,
       CAST(SUM(COALESCE(a.new_customers, 0)) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS cumulative_customers
FROM (SELECT strftime(transaction_date, '%Y-%m') AS month, {ms('amount')} AS revenue,
             COUNT(transaction_id) AS transactions, COUNT(DISTINCT customer_id) AS active_customers
      FROM completed GROUP BY 1) mo
LEFT JOIN (SELECT strftime(signup_date, '%Y-%m') AS m2, COUNT(*) AS new_customers FROM customers GROUP BY 1) a
  ON a.m2 = mo.month
LEFT JOIN (SELECT signup_cohort AS m3, CAST(SUM(is_churned) AS BIGINT) AS churned_customers,
                  round_even(CAST(SUM(is_churned) AS DOUBLE) / NULLIF(COUNT(is_churned), 0) * 100, 2) AS churn_rate,
                  {fs('churn_probability')} / NULLIF(COUNT(churn_probability), 0) AS avg_churn_prob
           FROM master GROUP BY 1) ch ON ch.m3 = mo.month
CROSS JOIN (SELECT {fs('profit_margin')} / NULLIF(COUNT(profit_margin), 0) / 100 AS am FROM profit) mg
CROSS JOIN (SELECT COUNT(*) AS total_high_risk_customers, {ms('total_revenue')} AS revenue_at_risk
            FROM master WHERE churn_risk_level = 'High') hr
""",
    ["completed", "customers", "master", "profit"],
)
register("master_customers", f"SELECT {MASTER_COLS} FROM master", "master")
register("monthly_business_summary", "SELECT * FROM mbs", "mbs")
register(
    "fact_customer_metrics",
    "SELECT customer_id, signup_date, total_revenue, gross_profit, churn_probability, customer_tenure_days, "
    "lifetime_months, CAST(strftime(signup_date, '%Y%m%d') AS INTEGER) AS date_key FROM master",
    "master",
)
register(
    "dim_customer_attributes",
    "SELECT customer_id, country, industry, subscription_type, customer_segment, behavioral_segment, "
    "profitability_tier, churn_risk_level, customer_value_tier, signup_cohort FROM master",
    "master",
)
register(
    "dim_retention_actions",
    "SELECT customer_id, retention_action, urgency, recommended_discount_pct AS recommended_discount, "
    "specific_recommendation AS specific_action FROM master",
    "master",
)
register("fact_monthly_summary", "SELECT * FROM mbs", "mbs")
register(
    "fact_revenue_forecast",
    f"SELECT * REPLACE ({ENSEMBLE}), CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, 'Ensemble' AS forecast_type FROM combined",
    "combined",
)
register(
    "dim_date",
    """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, strftime(d, '%Y-%m') AS year_month,
       CAST(d > mx AS INTEGER) AS is_forecast_period
FROM (SELECT CAST(unnest(generate_series(lo, CAST(mx + INTERVAL 12 MONTH AS DATE), INTERVAL 1 DAY)) AS DATE) AS d, mx
      FROM (SELECT (SELECT MIN(signup_date) FROM customers) AS lo, (SELECT MAX(transaction_date) FROM txns) AS mx) b) t
""",
    "customers",
    "txns",
)
register(
    "dim_date_v2",
    """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week,
       strftime(d, '%A') AS day_name, CAST(isodow(d) - 1 >= 5 AS INTEGER) AS is_weekend,
       CAST(year(d) AS INTEGER) AS fiscal_year, CAST(quarter(d) AS INTEGER) AS fiscal_quarter
FROM (SELECT CAST(unnest(generate_series(lo, CAST(mx + INTERVAL 12 MONTH AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT MIN(transaction_date) AS lo, MAX(transaction_date) AS mx FROM txns) b) t
""",
    "txns",
)
_KPI_CAT = """CASE WHEN lower(kpi_name) LIKE '%revenue%' OR lower(kpi_name) LIKE '%profit%' THEN 'Financial'
     WHEN lower(kpi_name) LIKE '%customer%' OR lower(kpi_name) LIKE '%churn%' THEN 'Customer'
     WHEN lower(kpi_name) LIKE '%forecast%' THEN 'Forecast' ELSE 'Other' END"""
register(
    "kpi_summary",
    f"""
SELECT kpi_name, kpi_value, kpi_text, {_KPI_CAT} AS kpi_category FROM (
  SELECT kpi_name, kpi_value, CAST(NULL AS VARCHAR) AS kpi_text FROM (
    SELECT a.*, CAST(churned_customers AS DOUBLE) / NULLIF(total_customers, 0) * 100 AS churn_rate,
           mo.monthly_avg_revenue, fc.forecasted_revenue_12m, fc.avg_monthly_forecast
    FROM (SELECT {ms('total_revenue')} AS total_revenue,
                 {ms('total_revenue')} / NULLIF(COUNT(total_revenue), 0) AS avg_revenue_per_customer,
                 COUNT(*) AS total_customers, COUNT(*) FILTER (WHERE is_churned = 0) AS active_customers,
                 COUNT(*) FILTER (WHERE is_churned = 1) AS churned_customers,
                 {fs('gross_profit')} AS total_profit,
                 {fs('profit_margin')} / NULLIF(COUNT(profit_margin), 0) AS avg_profit_margin,
                 COUNT(*) FILTER (WHERE gross_profit > 0) AS profitable_customers,
                 COUNT(*) FILTER (WHERE churn_risk_level = 'High') AS high_risk_customers,
                 COALESCE({ms("CASE WHEN churn_risk_level = 'High' THEN total_revenue END")}, 0.0) AS revenue_at_risk,
                 {fs('lifetime_months')} / NULLIF(COUNT(lifetime_months), 0) AS avg_customer_lifetime_months,
                 {ms('total_revenue')} / NULLIF(COUNT(total_revenue), 0) AS avg_customer_ltv,
                 COUNT(DISTINCT customer_segment) AS num_segments
          FROM master) a
    CROSS JOIN (SELECT {ms('revenue')} / NULLIF(COUNT(revenue), 0) AS monthly_avg_revenue FROM mbs) mo
    CROSS JOIN (SELECT {ms('forecast_ensemble')} AS forecasted_revenue_12m,
                       {ms('forecast_ensemble')} / NULLIF(COUNT(forecast_ensemble), 0) AS avg_monthly_forecast
                FROM combined) fc) w
  UNPIVOT INCLUDE NULLS (kpi_value FOR kpi_name IN (
    total_revenue, avg_revenue_per_customer, monthly_avg_revenue, total_customers, active_customers,
    churned_customers, churn_rate, total_profit, avg_profit_margin, profitable_customers, high_risk_customers,
    revenue_at_risk, avg_customer_lifetime_months, avg_customer_ltv, forecasted_revenue_12m, avg_monthly_forecast,
    num_segments))
  UNION ALL
  SELECT 'top_segment', CAST(NULL AS DOUBLE), arg_min(customer_segment, (-c, customer_segment))
  FROM (SELECT customer_segment, COUNT(*) AS c FROM master GROUP BY 1)) k
""",
    "master",
    "mbs",
    "combined",
)
register(
    "segment_summary",
    f"""
SELECT customer_segment AS segment, COUNT(customer_id) AS customers, {ms('total_revenue')} AS revenue,
       {fs('gross_profit')} AS profit, {fs('churn_probability')} / NULLIF(COUNT(churn_probability), 0) AS avg_churn_prob
FROM master GROUP BY 1
""",
    "master",
)
register(
    "executive_kpis",
    f"""
SELECT metric, CAST(value AS DOUBLE) AS value FROM (
  SELECT * FROM (
    SELECT c.*, t.total_transactions, d.total_revenue, d.avg_transaction_value, d.successful_transactions,
           CAST(d.successful_transactions AS DOUBLE) / NULLIF(t.total_transactions, 0) * 100 AS transaction_success_rate,
           pc.avg_revenue_per_customer, pm.avg_monthly_revenue, p.total_profit, p.avg_profit_margin,
           p.profitable_customers_pct
    FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS total_customers,
                 CAST(COUNT(*) FILTER (WHERE is_churned = 0) AS DOUBLE) AS active_customers,
                 CAST(COUNT(*) FILTER (WHERE is_churned = 1) AS DOUBLE) AS churned_customers,
                 AVG(is_churned) * 100 AS churn_rate, AVG(customer_tenure_days) AS avg_customer_tenure_days,
                 {fs('customer_ltv')} / NULLIF(COUNT(customer_ltv), 0) AS avg_customer_ltv
          FROM customer_features) c
    CROSS JOIN (SELECT CAST(COUNT(*) AS DOUBLE) AS total_transactions FROM txns) t
    CROSS JOIN (SELECT {ms('amount')} AS total_revenue, {ms('amount')} / NULLIF(COUNT(amount), 0) AS avg_transaction_value,
                       CAST(COUNT(*) AS DOUBLE) AS successful_transactions FROM completed) d
    CROSS JOIN (SELECT {fs('r')} / NULLIF(COUNT(r), 0) AS avg_revenue_per_customer
                FROM (SELECT {ms('amount')} AS r FROM completed GROUP BY customer_id)) pc
    CROSS JOIN (SELECT {fs('r')} / NULLIF(COUNT(r), 0) AS avg_monthly_revenue
                FROM (SELECT {ms('amount')} AS r FROM completed GROUP BY strftime(transaction_date, '%Y-%m'))) pm
    CROSS JOIN (SELECT {fs('gross_profit')} AS total_profit,
                       {fs('profit_margin')} / NULLIF(COUNT(profit_margin), 0) AS avg_profit_margin,
                       AVG(CAST(profit_margin > 0 AS INTEGER)) * 100 AS profitable_customers_pct FROM profit) p) w
  UNPIVOT (value FOR metric IN (total_customers, active_customers, churned_customers, churn_rate, total_revenue,
     avg_revenue_per_customer, avg_transaction_value, total_transactions, successful_transactions,
     transaction_success_rate, avg_monthly_revenue, avg_customer_tenure_days, avg_customer_ltv, total_profit,
     avg_profit_margin, profitable_customers_pct))
  UNION ALL
  SELECT 'customers_' || lower(subscription_type), CAST(COUNT(*) AS DOUBLE) FROM customer_features GROUP BY subscription_type
  UNION ALL
  SELECT 'high_risk_customers', CAST(COUNT(*) AS DOUBLE) FROM churn_pred WHERE churn_risk_level = 'High'
  HAVING COUNT(*) > 0
  UNION ALL
  SELECT 'revenue_at_risk', {ms('total_revenue')} FROM churn_pred WHERE churn_risk_level = 'High' HAVING COUNT(*) > 0
) u
""",
    "customer_features",
    "txns",
    "completed",
    "profit",
    "churn_pred",
)
register(
    "fact_transactions",
    "SELECT transaction_id, customer_id, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key, amount, "
    "payment_method, transaction_status, CAST(transaction_status = 'Completed' AS INTEGER) AS is_successful FROM txns",
    "txns",
)
register(
    "dim_customers",
    "SELECT customer_id, signup_date, country, industry, subscription_type, monthly_fee, "
    "CAST(strftime(signup_date, '%Y%m%d') AS INTEGER) AS signup_date_key FROM customers",
    "customers",
)
register(
    "monthly_summary",
    f"SELECT strftime(transaction_date, '%Y-%m') AS month, {ms('amount')} AS revenue, COUNT(transaction_id) AS transactions, "
    "COUNT(DISTINCT customer_id) AS unique_customers FROM completed GROUP BY 1",
    "completed",
)
register(
    "customer_metrics",
    """
SELECT f.customer_id, f.total_revenue, f.total_transactions, f.customer_tenure_days, f.is_churned, f.customer_ltv,
       c.churn_probability, c.churn_risk_level, a.R_score, a.F_score, a.M_score, a.segment
FROM customer_features f LEFT JOIN churn_pred c ON c.customer_id = f.customer_id
LEFT JOIN rfm_A a ON a.customer_id = f.customer_id
""",
    "customer_features",
    "churn_pred",
    "rfm_A",
)
register(
    "margin_by_subscription",
    f"SELECT subscription_type, {fs('profit_margin')} / NULLIF(COUNT(profit_margin), 0) AS avg_margin FROM profit GROUP BY 1",
    "profit",
)
register(
    "top_segments",
    "SELECT segment, customers, CAST(customers AS DOUBLE) / NULLIF(n, 0) * 100 AS pct FROM "
    "(SELECT segment, COUNT(*) AS customers FROM rfm_A GROUP BY 1) s CROSS JOIN (SELECT COUNT(*) AS n FROM rfm_A) t "
    "ORDER BY customers DESC, segment LIMIT 5",
    "rfm_A",
)

# ---------------------------------------------------------------- metrics on the deterministic score, charts
cte(
    "det_scored",
    "SELECT customer_id, CAST(is_churned AS DOUBLE) AS label, churn_probability FROM churn_pred",
    ["churn_pred"],
)
register(
    "classification_metrics",
    """
SELECT CAST(tp + tn AS DOUBLE) / NULLIF(tp + fp + tn + fn, 0) AS accuracy,
       COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0.0) AS precision,
       COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0.0) AS recall,
       COALESCE(2 * (CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0)) * (CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0))
                / NULLIF(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0) + CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0), 0.0) AS f1,
       a.roc_auc
FROM (SELECT COUNT(*) FILTER (WHERE churn_probability >= 0.5 AND label = 1) AS tp,
             COUNT(*) FILTER (WHERE churn_probability >= 0.5 AND label = 0) AS fp,
             COUNT(*) FILTER (WHERE churn_probability < 0.5 AND label = 0) AS tn,
             COUNT(*) FILTER (WHERE churn_probability < 0.5 AND label = 1) AS fn FROM det_scored) c
CROSS JOIN (
  SELECT (SUM(pos * (below + (k + 1) / 2.0)) - SUM(pos) * (SUM(pos) + 1) / 2.0) / NULLIF(SUM(pos) * SUM(neg), 0) AS roc_auc
  FROM (SELECT *, SUM(k) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k AS below
        FROM (SELECT churn_probability AS s, COUNT(*) FILTER (WHERE label = 1) AS pos,
                     COUNT(*) FILTER (WHERE label = 0) AS neg, COUNT(*) AS k FROM det_scored GROUP BY 1) g) h) a
""",
    "det_scored",
)
register(
    "confusion_matrix",
    "SELECT CAST(label AS INTEGER) AS actual, CAST(churn_probability >= 0.5 AS INTEGER) AS predicted, COUNT(*) AS count "
    "FROM det_scored GROUP BY 1, 2",
    "det_scored",
)
register(
    "roc_curve",
    """
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0 AS fpr, 0.0 AS tpr
UNION ALL
SELECT s AS threshold, CAST(fp AS DOUBLE) / NULLIF(nn, 0) AS fpr, CAST(tp AS DOUBLE) / NULLIF(pp, 0) AS tpr
FROM (SELECT s, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS pp, SUM(neg) OVER () AS nn
      FROM (SELECT churn_probability AS s, COUNT(*) FILTER (WHERE label = 1) AS pos,
                   COUNT(*) FILTER (WHERE label = 0) AS neg FROM det_scored GROUP BY 1) g
      WINDOW w AS (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) t
""",
    "det_scored",
)
def _histogram_sql(table: str, col: str, bins: int) -> str:
    ends = f"(SELECT MIN({col}) AS lo, MAX({col}) AS hi FROM {table})"
    return f"""
SELECT b.bin, lo + (b.bin - 1) * ((hi - lo) / {bins}) AS bin_start, lo + b.bin * ((hi - lo) / {bins}) AS bin_end,
       COALESCE(c.count, 0) AS count
FROM (SELECT CAST(unnest(generate_series(1, {bins})) AS BIGINT) AS bin) b
CROSS JOIN {ends} m
LEFT JOIN (SELECT CASE WHEN hi = lo THEN 1 ELSE LEAST(CAST(FLOOR(CAST({bins} AS DOUBLE) * ({col} - lo) / (hi - lo)) AS BIGINT) + 1, {bins}) END
                  AS bin, COUNT(*) AS count
           FROM {table} CROSS JOIN {ends} mm
           WHERE {col} IS NOT NULL GROUP BY 1) c ON c.bin = b.bin
"""


register("histogram_margin", _histogram_sql("profit", "profit_margin", 40), "profit")
register("histogram_rfm_total", _histogram_sql("rfm_B", "RFM_total", 13), "rfm_B")
register("histogram_churn_probability", _histogram_sql("churn_pred", "churn_probability", 30), "churn_pred")
register(
    "rf_matrix",
    """
SELECT r.R_score, f.F_score, COALESCE(c.customers, 0) AS customers
FROM (SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS R_score) r
CROSS JOIN (SELECT CAST(unnest(generate_series(1, 5)) AS INTEGER) AS F_score) f
LEFT JOIN (SELECT R_score, F_score, COUNT(*) AS customers FROM rfm_B GROUP BY 1, 2) c
  ON c.R_score = r.R_score AND c.F_score = f.F_score
""",
    "rfm_B",
)
register(
    "cohort_heatmap",
    """
SELECT r.cohort_index, r.cohort, r.retention FROM cohort_retention_a r
WHERE r.cohort IN (SELECT cohort FROM (SELECT DISTINCT cohort FROM cohort_retention_a) ORDER BY cohort DESC LIMIT 12)
  AND r.cohort_index IN (SELECT cohort_index FROM (SELECT DISTINCT cohort_index FROM cohort_retention_a)
                         ORDER BY cohort_index LIMIT 12)
""",
    "cohort_retention_a",
)
register(
    "revenue_by_country_top8",
    f"SELECT country, {ms('total_revenue')} AS revenue FROM master GROUP BY 1 ORDER BY revenue DESC, country LIMIT 8",
    "master",
)
register(
    "revenue_by_segment",
    f"SELECT customer_segment, {ms('total_revenue')} AS revenue FROM master GROUP BY 1",
    "master",
)
register(
    "revenue_by_subscription",
    f"SELECT subscription_type, {ms('total_revenue')} AS revenue FROM master GROUP BY 1",
    "master",
)
register(
    "risk_revenue_by_segment_top6",
    f"SELECT customer_segment, {ms('total_revenue')} AS revenue FROM master WHERE churn_risk_level = 'High' "
    "GROUP BY 1 ORDER BY revenue DESC, customer_segment LIMIT 6",
    "master",
)
register(
    "action_counts_top5",
    "SELECT specific_recommendation, COUNT(*) AS customers FROM recs GROUP BY 1 "
    "ORDER BY customers DESC, specific_recommendation LIMIT 5",
    "recs",
)
register(
    "profit_by_tier",
    f"""
SELECT s.tier, s.tier_order, p.total_profit
FROM (VALUES ('Loss-Making', 0), ('Low Profit', 1), ('Medium Profit', 2), ('High Profit', 3)) s(tier, tier_order)
LEFT JOIN (SELECT profitability_tier AS tier, {fs('gross_profit')} AS total_profit FROM profit GROUP BY 1) p
  ON p.tier = s.tier
""",
    "profit",
)
register(
    "risk_level_counts",
    """
SELECT s.risk_level, s.risk_order, COALESCE(c.customers, 0) AS customers
FROM (VALUES ('Low', 0), ('Medium', 1), ('High', 2)) s(risk_level, risk_order)
LEFT JOIN (SELECT churn_risk_level AS risk_level, COUNT(*) AS customers FROM churn_pred GROUP BY 1) c
  ON c.risk_level = s.risk_level
""",
    "churn_pred",
)

# ---------------------------------------------------------------- other transaction grains (adapters A and C)
PAYMENT_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'Bank Transfer'
     WHEN '3-MEDIUM' THEN 'PayPal' WHEN '4-NOT SPECIFIED' THEN 'Wire Transfer' WHEN '5-LOW' THEN 'ACH'
     ELSE 'Other' END"""
cte(
    "txn_raw_orders",
    f"""
SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS transaction_date,
       o_totalprice AS amount, {PAYMENT_CASE} AS payment_method,
       CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Pending' WHEN 'P' THEN 'Failed'
            ELSE o_orderstatus END AS transaction_status
FROM orders
""",
)
cte(
    "txn_raw_events",
    """
SELECT event_id AS transaction_id, user_id AS customer_id, CAST(ts AS DATE) AS transaction_date, value AS amount,
       'Credit Card' AS payment_method,
       CASE event_type WHEN 'purchase' THEN 'Completed' WHEN 'error' THEN 'Failed' ELSE 'Pending' END
           AS transaction_status
FROM events
""",
)
for _g in ("orders", "events"):
    cte(f"txns_{_g}", CTES["txns"][0].replace("FROM txn_raw)", f"FROM txn_raw_{_g})"), [f"txn_raw_{_g}"])
    cte(
        f"customer_features_{_g}",
        CTES["customer_features"][0].replace("FROM txns", f"FROM txns_{_g}"),
        ["customers", f"txns_{_g}"],
    )
    register(f"customer_features_{_g}", f"SELECT * FROM customer_features_{_g}", f"customer_features_{_g}")
    register(
        f"monthly_revenue_{_g}",
        build(
            f"""
SELECT CAST(year(transaction_date) AS INTEGER) AS year, CAST(month(transaction_date) AS INTEGER) AS month,
       {ms('amount')} AS revenue, COUNT(transaction_id) AS transaction_count,
       COUNT(DISTINCT customer_id) AS unique_customers,
       make_date(CAST(year(transaction_date) AS INTEGER), CAST(month(transaction_date) AS INTEGER), 1) AS date
FROM txns_{_g} WHERE transaction_status = 'Completed' GROUP BY 1, 2
""",
            f"txns_{_g}",
        ),
    )

# ---------------------------------------------------------------- A18 describe
DESCRIBE_COLS = ["total_revenue", "total_transactions", "customer_tenure_days", "transaction_frequency"]


def _describe_sql(col: str) -> str:
    q = _quantile_edges("customer_features", col, ["0.25", "0.5", "0.75"], "p")
    return f"""
SELECT '{col}' AS "column", stat, value FROM (
  SELECT CAST(COUNT({col}) AS DOUBLE) AS "count", {fs(col)} / NULLIF(COUNT({col}), 0) AS mean,
         ROUND(STDDEV_SAMP({col}), 6) AS std, CAST(MIN({col}) AS DOUBLE) AS "min",
         CAST(MAX({col}) AS DOUBLE) AS "max", q.p0 AS "25%", q.p1 AS "50%", q.p2 AS "75%"
  FROM customer_features CROSS JOIN ({q}) q GROUP BY q.p0, q.p1, q.p2) a
UNPIVOT (value FOR stat IN ("count", mean, std, "min", "25%", "50%", "75%", "max"))
"""


register("customer_describe", " UNION ALL ".join(_describe_sql(c) for c in DESCRIBE_COLS), "customer_features")

# ---------------------------------------------------------------- D12 other bases, A15 pivot
cte(
    "cohort_cells_bases",
    """
SELECT s.cohort, s.cohort_index, cc.customers, m0.customers AS base_m0, sz.size AS base_size
FROM (SELECT * FROM (SELECT DISTINCT cohort FROM cohort_counts) a
      CROSS JOIN (SELECT DISTINCT cohort_index FROM cohort_counts) i) s
LEFT JOIN cohort_counts cc ON cc.cohort = s.cohort AND cc.cohort_index = s.cohort_index
LEFT JOIN (SELECT cohort, customers FROM cohort_counts WHERE cohort_index = 0) m0 ON m0.cohort = s.cohort
LEFT JOIN (SELECT strftime(signup_date, '%Y-%m') AS cohort, COUNT(DISTINCT customer_id) AS size FROM customers
           WHERE signup_date IS NOT NULL GROUP BY 1) sz ON sz.cohort = s.cohort
""",
    ["cohort_counts", "customers"],
)
register(
    "cohort_retention_month0",
    "SELECT cohort, cohort_index, COALESCE(CAST(customers AS DOUBLE) / NULLIF(CAST(base_m0 AS DOUBLE), 0) * 100, 0.0) "
    "AS retention FROM cohort_cells_bases",
    "cohort_cells_bases",
)
register(
    "cohort_retention_size",
    "SELECT cohort, cohort_index, COALESCE(CAST(customers AS DOUBLE) / NULLIF(CAST(base_size AS DOUBLE), 0) * 100, 0.0) "
    "AS retention FROM cohort_cells_bases",
    "cohort_cells_bases",
)
register(
    "cohort_counts_matrix",
    "SELECT cohort, CAST(12 * FLOOR(cohort_index / 12.0) AS INTEGER) AS first_index, "
    + ", ".join(f"MAX(CASE WHEN cohort_index - 12 * FLOOR(cohort_index / 12.0) = {k} THEN customers END) AS m{k}" for k in range(12))
    + " FROM cohort_counts GROUP BY 1, 2",
    "cohort_counts",
)
# the columns are the offsets that occur
register("cohort_counts_wide", "SELECT * FROM (PIVOT cohort_counts ON cohort_index USING FIRST(customers) GROUP BY cohort) w", "cohort_counts")
register(
    "profit_tiers",
    "SELECT customer_id, gross_profit, profit_margin, profitability_tier, tier_rank FROM profit",
    "profit",
)

cte(
    "mseries_industry",
    f"""
SELECT s.industry, s.date, COALESCE(v.value, 0.0) AS value
FROM (SELECT industry, CAST(unnest(generate_series(MIN(date), MAX(date), INTERVAL 1 MONTH)) AS DATE) AS date
      FROM iv GROUP BY industry) s
LEFT JOIN iv v ON v.industry = s.industry AND v.date = s.date
""",
    ["iv"],
)
cte(
    "iv",
    """
SELECT c.industry, m.date, CAST(CAST(SUM(m.v) AS VARCHAR) AS DOUBLE) AS value
FROM (SELECT customer_id, CAST(date_trunc('month', transaction_date) AS DATE) AS date,
             SUM(CAST(CAST(amount AS VARCHAR) AS DECIMAL(38,12))) AS v
      FROM completed GROUP BY 1, 2) m
JOIN customers c ON c.customer_id = m.customer_id
GROUP BY 1, 2
""",
    ["completed", "customers"],
)
_decompose_sql("mseries_industry", "decomp_industry", ("industry",))
register("monthly_series_by_industry", "SELECT * FROM mseries_industry", "mseries_industry")
register("decomposition_by_industry", "SELECT * FROM decomp_industry", "decomp_industry")
_K = ("industry",)
_stationarity_sql("mseries_industry", "stationarity_industry", _K)
_forecast_ar_sql("mseries_industry", "fc_ar_industry", 12, _K)
_forecast_st_sql("mseries_industry", "fc_st_industry", 12, _K)
_holdout_sql("mseries_industry", "fc_metrics_industry", _K)
_arma_sql("stationarity_industry", "arma_industry", _K)
register(
    "forecast_arma_by_industry",
    f"SELECT * REPLACE ({BAND}), {_AHEAD.format(src='mseries_industry', on=' WHERE m.industry IS NOT DISTINCT FROM f.industry')} FROM arma_industry_fc f",
    "arma_industry_fc",
    "mseries_industry",
)
register("stationarity_by_industry", f"SELECT * REPLACE ({TEST}) FROM stationarity_industry", "stationarity_industry")
register("forecast_ar_by_industry", f"SELECT * REPLACE ({BAND}) FROM fc_ar_industry", "fc_ar_industry")
register("forecast_seasonal_trend_by_industry", f"SELECT * REPLACE ({BAND}) FROM fc_st_industry", "fc_st_industry")
_bent_sql("fc_st_industry", "fc_bent_industry", 12, _K)
register("forecast_bent_trend_by_industry", f"SELECT * REPLACE ({BAND}) FROM fc_bent_industry", "fc_bent_industry")
register("trend_change_points_by_industry", f"SELECT * REPLACE ({SLOPES}) FROM fc_bent_industry_cp", "fc_bent_industry_cp")
register("forecast_metrics_by_industry", f"SELECT * REPLACE ({ERRORS}) FROM fc_metrics_industry", "fc_metrics_industry")

# ---------------------------------------------------------------- M3 counts of the split, M9 on tied scores
register(
    "churn_split_counts",
    """
SELECT label, p < round(nc * 0.2) AS is_test, CAST(p % 5 AS INTEGER) AS fold, COUNT(*) AS customers
FROM (SELECT label, unnest(generate_series(0, nc - 1)) AS p, nc
      FROM (SELECT is_churned AS label, COUNT(*) AS nc FROM customer_features GROUP BY 1) a) b
GROUP BY 1, 2, 3
""",
    "customer_features",
)
_one = ORACLE["classification_metrics"]
register(
    "churn_score_comparison",
    f"SELECT m.*, x.model, 'logistic_regression' AS best_model FROM ({_one}) m "
    "CROSS JOIN (SELECT unnest(['logistic_regression', 'random_forest']) AS model) x",
)
