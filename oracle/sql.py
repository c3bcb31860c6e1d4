"""DuckDB oracle: every registered query written independently as SQL over
the driver's pre-registered tables.

Written from the operator semantics, not from the Spark code: cohorts use the
plain join formulation, session numbers a single window, quantiles
``quantile_disc``. Rounding is made engine-independent:

* money means: integer cents, half-up ``(2*S + n) // (2*n)`` (amounts are
  non-negative, cent-exact);
* other ``round(x, 2)``: ``round(x::DECIMAL(38,10), 2)``, which reproduces
  half-up rounding of the shortest decimal form of a double;
* ``%.2f`` text the same way before ``printf``.
"""

from __future__ import annotations

# Literal, so that a wrong constant in the package shows.
CORRELATION_COLUMNS = ["session_duration", "pages_viewed", "purchase_amount", "review_score", "has_purchased"]
DESCRIBE_COLUMNS = ["session_duration", "pages_viewed", "purchase_amount", "review_score"]
PAGES_MIN_SESSIONS = 50
TOKEN_LETTERS = "a-zéèêëàâäôöùûüÿçœ"
TOKEN_MIN_LENGTH = 3
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

AS_OF = "2002-01-01"

RAW_COLUMNS = [("session_id", "long"), ("user_id", "string"), ("session_duration", "integer"),
               ("pages_viewed", "integer"), ("product_category", "string"),
               ("purchase_amount", "double"), ("review_score", "double"),
               ("review_text", "string"), ("timestamp", "timestamp_ntz"),
               ("device_type", "string"), ("country", "string"), ("city", "string")]


def r2(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def money_avg(x: str) -> str:
    cents = f"sum(CAST(round({x} * 100) AS BIGINT))"
    return f"CAST((2 * {cents} + count({x})) // (2 * count({x})) AS DOUBLE) / 100.0"


def money_sum(x: str) -> str:
    return f"CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS DOUBLE) / 100.0"


def money_avg_raw(x: str) -> str:
    return f"(CAST(sum(CAST(round({x} * 100) AS BIGINT)) AS DOUBLE) / 100.0) / count({x})"


def pct(part: str, whole: str) -> str:
    return r2(f"CAST({part} AS DOUBLE) * 100.0 / {whole}")


BASE = f"""
li AS (
  SELECT l_orderkey, CAST(sum(l_linenumber) AS INTEGER) AS sd,
         CAST(count(*) AS INTEGER) AS pv, min(l_partkey) AS pk
  FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT o.o_orderkey AS session_id,
         'U' || CAST(o.o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o.o_orderkey % 97 = 0 THEN -1 ELSE li.sd END AS session_duration,
         CASE WHEN o.o_orderkey % 89 = 0 THEN -1 ELSE li.pv END AS pages_viewed,
         p.p_type AS product_category,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_totalprice END AS purchase_amount,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
              ELSE CAST(substr(o.o_orderpriority, 1, 1) AS DOUBLE) END AS review_score,
         d.text AS review_text,
         o.o_orderdate + to_seconds(CAST(o.o_orderkey * 7919 % 86400 AS BIGINT)) AS "timestamp",
         CASE WHEN o.o_orderkey % 5 < 3 THEN 'Mobile' ELSE 'Desktop' END AS device_type,
         n.n_name AS country,
         'CITY_' || CAST(o.o_custkey % 100 AS VARCHAR) AS city
  FROM orders o
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON p.p_partkey = li.pk
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey),
clean AS (
  SELECT session_id, user_id, session_duration, pages_viewed, product_category,
         coalesce(purchase_amount, 0.0) AS purchase_amount,
         coalesce(review_score, (SELECT avg(review_score) FROM raw)) AS review_score,
         review_text, "timestamp", device_type, country, city
  FROM raw WHERE session_duration >= 0 AND pages_viewed >= 0),
enriched AS (
  SELECT *,
         CAST("timestamp" AS DATE) AS date,
         CAST(hour("timestamp") AS INTEGER) AS hour,
         dayname("timestamp") AS day_of_week,
         CAST(month("timestamp") AS INTEGER) AS month,
         CAST(year("timestamp") AS INTEGER) AS year,
         CASE WHEN session_duration < 5 THEN 'Courte'
              WHEN session_duration >= 5 AND session_duration < 15 THEN 'Moyenne'
              ELSE 'Longue' END AS session_category,
         CASE WHEN purchase_amount > 0 THEN 1 ELSE 0 END AS has_purchased,
         CASE WHEN review_score <= 2 THEN 'Négatif'
              WHEN review_score = 3 THEN 'Neutre'
              WHEN review_score >= 4 THEN 'Positif'
              ELSE 'Non évalué' END AS review_category,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", session_id) AS INTEGER)
           AS session_number
  FROM clean),
um AS (
  SELECT user_id,
         count(*) AS total_sessions,
         CAST(sum(has_purchased) AS BIGINT) AS total_purchases,
         {money_avg('purchase_amount')} AS avg_purchase_value,
         {money_sum('purchase_amount')} AS customer_lifetime_value,
         {r2('avg(review_score)')} AS avg_rating,
         max("timestamp") AS last_session,
         CASE WHEN count(*) > 0 THEN CAST(sum(has_purchased) AS DOUBLE) / count(*) ELSE 0.0 END
           AS purchase_frequency
  FROM enriched GROUP BY user_id),
rfm AS (
  SELECT *, CAST(date_diff('day', CAST(last_session AS DATE), DATE '{AS_OF}') AS INTEGER) AS recency_days,
         total_purchases AS frequency, customer_lifetime_value AS monetary
  FROM um),
rq AS (
  SELECT {", ".join(f"CAST(quantile_disc({d}, {p}) AS DOUBLE) AS {d[0]}{i}"
                    for d in ("recency_days", "frequency", "monetary")
                    for i, p in enumerate((0.2, 0.4, 0.6, 0.8)))}
  FROM rfm),
scored AS (
  SELECT rfm.*,
         CASE WHEN recency_days <= r0 THEN 5 WHEN recency_days <= r1 THEN 4
              WHEN recency_days <= r2 THEN 3 WHEN recency_days <= r3 THEN 2 ELSE 1 END AS r_score,
         CASE WHEN frequency >= f3 THEN 5 WHEN frequency >= f2 THEN 4
              WHEN frequency >= f1 THEN 3 WHEN frequency >= f0 THEN 2 ELSE 1 END AS f_score,
         CASE WHEN monetary >= m3 THEN 5 WHEN monetary >= m2 THEN 4
              WHEN monetary >= m1 THEN 3 WHEN monetary >= m0 THEN 2 ELSE 1 END AS m_score
  FROM rfm CROSS JOIN rq),
scored2 AS (SELECT *, r_score + f_score + m_score AS rfm_score FROM scored),
segmented AS (
  SELECT *, CASE WHEN rfm_score >= 13 THEN 'Champions'
                 WHEN rfm_score >= 10 THEN 'Loyal Customers'
                 WHEN rfm_score >= 9 AND r_score >= 4 THEN 'Recent Customers'
                 WHEN rfm_score >= 9 AND f_score >= 4 THEN 'Frequent Customers'
                 WHEN rfm_score >= 9 AND m_score >= 4 THEN 'Big Spenders'
                 WHEN rfm_score >= 6 AND rfm_score < 9 THEN 'Potential Loyalists'
                 WHEN rfm_score = 5 AND r_score < 2 THEN 'At Risk'
                 WHEN rfm_score = 4 THEN 'About to Sleep'
                 WHEN rfm_score = 3 THEN 'Need Attention'
                 ELSE 'Lost' END AS rfm_segment
  FROM scored2),
behav AS (
  SELECT *, CASE WHEN total_purchases = 0 THEN 'Non-acheteur'
                 WHEN total_purchases = 1 THEN 'One-time buyer'
                 WHEN total_purchases >= 2 AND total_purchases < 5 THEN 'Repeat customer'
                 WHEN total_purchases >= 5 THEN 'Loyal customer'
                 ELSE 'Unknown' END AS user_segment
  FROM um),
firsts AS (
  SELECT user_id, min("timestamp") AS first_session,
         CAST(year(min("timestamp")) AS INTEGER) AS cohort_year,
         CAST(month(min("timestamp")) AS INTEGER) AS cohort_month,
         CAST(year(min("timestamp")) AS VARCHAR) || '-' || CAST(month(min("timestamp")) AS VARCHAR) AS cohort
  FROM enriched GROUP BY user_id),
cohort_data AS (
  SELECT e.user_id, e.has_purchased, e.purchase_amount, f.cohort,
         CAST((year(e."timestamp") - f.cohort_year) * 12 + (month(e."timestamp") - f.cohort_month) AS INTEGER)
           AS months_since_first
  FROM enriched e JOIN firsts f ON e.user_id = f.user_id),
cohort_act AS (
  SELECT cohort, months_since_first, count(DISTINCT user_id) AS active_users,
         CAST(sum(has_purchased) AS BIGINT) AS purchases,
         {money_avg('purchase_amount')} AS avg_purchase
  FROM cohort_data GROUP BY cohort, months_since_first),
cohort_size AS (
  SELECT cohort, count(DISTINCT user_id) AS initial_users
  FROM cohort_data WHERE months_since_first = 0 GROUP BY cohort),
toks AS (
  SELECT session_id, review_category,
         list_filter(string_split_regex(
             regexp_replace(lower(review_text), '[^{TOKEN_LETTERS}\\s]', '', 'g'), '\\s+'),
           lambda t: length(t) >= {TOKEN_MIN_LENGTH}) AS tokens
  FROM enriched WHERE review_text IS NOT NULL),
terms AS (SELECT session_id, review_category, unnest(tokens) AS term FROM toks),
daily AS (
  SELECT date, sum(CAST(round(purchase_amount * 100) AS BIGINT)) AS cents,
         count(*) AS order_count, {money_avg_raw('purchase_amount')} AS avg_order_value
  FROM enriched WHERE has_purchased = 1 GROUP BY date)
"""


def q(body: str) -> str:
    return f"WITH {BASE.strip()}\n{body.strip()}"


def recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql.removeprefix("WITH")


def _null_counts() -> str:
    parts = []
    for c, kind in RAW_COLUMNS:
        cond = f'"{c}" IS NULL' + (f" OR \"{c}\" = ''" if kind == "string" else "")
        parts.append(f"SELECT '{c}' AS column_name, CAST(count_if({cond}) AS BIGINT) AS null_count FROM raw")
    return q("\nUNION ALL\n".join(parts))


def _describe() -> str:
    parts = []
    for c in DESCRIBE_COLUMNS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"SELECT '{c}' AS column_name, count({x}) AS count, avg({x}) AS mean, "
                     f"stddev_samp({x}) AS stddev, min({x}) AS min, max({x}) AS max FROM enriched")
    return q("\nUNION ALL\n".join(parts))


def _describe_text() -> str:
    of = "CASE summary WHEN 'count' THEN CAST(count AS DOUBLE) WHEN 'mean' THEN mean WHEN 'stddev' THEN stddev " \
         "WHEN 'min' THEN min ELSE max END"
    cols = ", ".join(f"max({of}) FILTER (column_name = '{c}') AS {c}" for c in DESCRIBE_COLUMNS)
    return (f"SELECT summary, {cols} FROM ({_describe()}) CROSS JOIN (VALUES ('count'), ('mean'), ('stddev'), ('min'), ('max')) "
            "AS s(summary) GROUP BY summary")


def _correlation() -> str:
    parts = []
    for a in CORRELATION_COLUMNS:
        for b in CORRELATION_COLUMNS:
            xa, xb = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
            if a == b:
                val = f"CASE WHEN var_pop({xa}) = 0 THEN NULL ELSE var_pop({xa}) / var_pop({xa}) END"
            else:
                den = f"(stddev_pop({xa}) * stddev_pop({xb}))"
                val = f"CASE WHEN {den} = 0 THEN NULL ELSE covar_pop({xa}, {xb}) / {den} END"
            parts.append(f"SELECT '{a}' AS feature1, '{b}' AS feature2, {val} AS correlation "
                         f"FROM enriched WHERE {a} IS NOT NULL AND {b} IS NOT NULL")
    return q("\nUNION ALL\n".join(parts))


def _fixed2(x: str) -> str:
    return f"coalesce(printf('%.2f', {r2(x)}), 'N/A')"


def _data_quality() -> str:
    numeric = [c for c, k in RAW_COLUMNS if k in ("integer", "double", "long")]
    bounds = ", ".join(
        f"CAST(quantile_disc({c}, 0.25) AS DOUBLE) - 1.5 * (CAST(quantile_disc({c}, 0.75) AS DOUBLE) - "
        f"CAST(quantile_disc({c}, 0.25) AS DOUBLE)) AS lo_{c}, "
        f"CAST(quantile_disc({c}, 0.75) AS DOUBLE) + 1.5 * (CAST(quantile_disc({c}, 0.75) AS DOUBLE) - "
        f"CAST(quantile_disc({c}, 0.25) AS DOUBLE)) AS hi_{c}"
        for c in numeric)
    parts = []
    for c, kind in RAW_COLUMNS:
        qc = f'"{c}"'
        missing = f"{qc} IS NULL" + (f" OR {qc} = ''" if kind == "string" else "")
        distinct = f"(count(DISTINCT {qc}) + coalesce(max(CASE WHEN {qc} IS NULL THEN 1 ELSE 0 END), 0))"
        if c in numeric:
            lo, hi = f"coalesce(CAST(min({qc}) AS VARCHAR), 'N/A')", f"coalesce(CAST(max({qc}) AS VARCHAR), 'N/A')"
            mean, sd = _fixed2(f"avg({qc})"), _fixed2(f"stddev_samp({qc})")
            out = f"CAST(count_if({qc} < b.lo_{c} OR {qc} > b.hi_{c}) AS BIGINT)"
        else:
            lo = hi = mean = sd = "'N/A'"
            out = "CAST(0 AS BIGINT)"
        total = "count(*)"
        parts.append(
            f"SELECT '{c}' AS column_name, '{kind}' AS data_type, {total} AS total_count, "
            f"CAST(count_if({missing}) AS BIGINT) AS null_count, "
            f"CAST(count_if({missing}) AS DOUBLE) * 100.0 / {total} AS null_percent, "
            f"CAST({distinct} AS BIGINT) AS distinct_count, "
            f"CAST({distinct} AS DOUBLE) * 100.0 / {total} AS distinct_percent, "
            f"{lo} AS min_value, {hi} AS max_value, {mean} AS mean, {sd} AS stddev, "
            f"{out} AS outlier_count, CAST({out} AS DOUBLE) * 100.0 / {total} AS outlier_percent "
            f"FROM raw CROSS JOIN b")
    body = f"""
, b AS (SELECT {bounds} FROM raw)
{" UNION ALL ".join(parts)}"""
    return f"WITH {BASE.strip()}{body}"


def _dashboard() -> str:
    series = [("category", "product_category"), ("hour", "hour"), ("device", "device_type"),
              ("pages", "pages_viewed"), ("weekday", "day_of_week"), ("rating", "review_score")]
    parts = []
    for name, c in series:
        where = " WHERE review_score IS NOT NULL" if name == "rating" else ""
        having = f" HAVING count(*) > {PAGES_MIN_SESSIONS}" if name == "pages" else ""
        parts.append(
            f"SELECT '{name}' AS series, CAST({c} AS VARCHAR) AS key, count(*) AS sessions, "
            f"CAST(sum(has_purchased) AS BIGINT) AS purchases, "
            f"{pct('sum(has_purchased)', 'count(*)')} AS rate FROM enriched{where} GROUP BY {c}{having}")
    return q("\nUNION ALL\n".join(parts))


def _conv(key: str, rate: str = "conversion_rate_percent", purchases: str = "sessions_with_purchase") -> str:
    return q(f"""
SELECT {key}, count(*) AS total_sessions, CAST(sum(has_purchased) AS BIGINT) AS {purchases},
       {pct('sum(has_purchased)', 'count(*)')} AS {rate}
FROM enriched GROUP BY {key}""")


def _dist(key: str) -> str:
    return q(f"""
SELECT {key}, count(*) AS count, {money_avg('purchase_amount')} AS avg_purchase,
       {r2('avg(review_score)')} AS avg_review
FROM enriched GROUP BY {key}""")


def _activity(key: str) -> str:
    return q(f"""
SELECT {key}, count(*) AS sessions, CAST(sum(has_purchased) AS BIGINT) AS purchases,
       {money_avg('purchase_amount')} AS avg_purchase_amount
FROM enriched GROUP BY {key}""")


def _terms(category: str) -> str:
    return q(f"SELECT term, count(*) AS count FROM terms WHERE review_category = '{category}' GROUP BY term")


ENRICHED_COLS = ("session_id, user_id, session_duration, pages_viewed, product_category, purchase_amount, "
                 "review_score, review_text, \"timestamp\", device_type, country, city, date, hour, "
                 "day_of_week, month, year, session_category, has_purchased, review_category, session_number")

# --- models ------------------------------------------------------------------

# a label that two features and some noise decide
SIGNAL = ("CASE WHEN session_duration + CASE WHEN device_type = 'Desktop' THEN 6 ELSE 0 END "
          "+ (session_id * 31) % 17 >= 22 THEN 1 ELSE 0 END")
CATEGORIES = ("device_type", "product_category", "day_of_week")
REG, ELASTIC_NET = 0.01, 0.8
NEWTON, SWEEPS = 12, 120


def _model_rows(label: str) -> str:
    """labelled: sessions with label y; names: the features by position j; cells:
    (session_id, j, x), zeros of the categories left out."""
    names = ["SELECT 0 AS g, i, n AS c, n FROM (VALUES (1, 'session_duration'), (2, 'pages_viewed'), (3, 'hour')) t(i, n)"]
    names += [f"SELECT {g}, row_number() OVER (ORDER BY count(*) DESC, {c}), '{c}', {c} FROM train WHERE {c} IS NOT NULL GROUP BY {c}"
              for g, c in enumerate(CATEGORIES, 1)]
    cells = [f"SELECT session_id, n.j, CAST({c} AS DOUBLE) AS x FROM labelled JOIN names n ON n.c = '{c}'"
             for c in ("session_duration", "pages_viewed", "hour")]
    cells += [f"SELECT session_id, n.j, CAST(1 AS DOUBLE) FROM labelled JOIN names n ON n.c = '{c}' AND n.n = {c}"
              for c in CATEGORIES]
    return f"""
, labelled AS (SELECT *, {label} AS y, (session_id * 7919) % 100 < 70 AS training FROM enriched),
train AS (SELECT * FROM labelled WHERE training),
names AS (SELECT row_number() OVER (ORDER BY g, i) AS j, c, n FROM ({" UNION ALL ".join(names)})),
cells AS ({" UNION ALL ".join(cells)})"""


def _logistic(label: str) -> str:
    """Weights of the elastic-net logistic model: Newton steps on counts of equal
    rows, each solved by coordinate descent over a quadratic without intercept.
    Ends with fitted(b, v): intercept, and weights of features over their deviation."""
    l1, l2 = REG * ELASTIC_NET, REG * (1 - ELASTIC_NET)
    steps = [f"""
alike AS (SELECT min(session_id) AS r, CAST(count(*) AS DOUBLE) AS n, CAST(y AS DOUBLE) AS y FROM train
  GROUP BY session_duration, pages_viewed, hour, device_type, product_category, day_of_week, y),
total AS (SELECT sum(n) AS n, max(j) AS p FROM (SELECT sum(n) AS n FROM alike), (SELECT max(j) AS j FROM names)),
spread AS (SELECT j, sqrt(greatest(sum(n * x * x) - sum(n * x) * sum(n * x) / any_value(t), 0) / (any_value(t) - 1)) AS s
  FROM (SELECT j, a.n, x, total.n AS t FROM alike a JOIN cells c ON c.session_id = a.r, total) GROUP BY j),
scaled AS (SELECT a.r, a.n / total.n AS n, a.y, c.j, c.x / s.s AS x
  FROM alike a JOIN cells c ON c.session_id = a.r JOIN spread s ON s.j = c.j AND s.s > 0, total),
w0 AS (SELECT CAST(0 AS DOUBLE) AS b, list_transform(range(p), lambda i: CAST(0 AS DOUBLE)) AS v FROM total)"""]
    for t in range(NEWTON):
        steps.append(f"""
p{t} AS MATERIALIZED (SELECT r, n, y, 1 / (1 + exp(-(any_value(b) + sum(x * v[j])))) AS p FROM scaled, w{t} GROUP BY r, n, y),
o{t} AS MATERIALIZED (SELECT sum(n * (p - y)) AS g, sum(n * p * (1 - p)) AS h FROM p{t}),
g{t} AS MATERIALIZED (SELECT j, sum(s.n * (p - s.y) * x) AS g, sum(s.n * p * (1 - p) * x) AS h
  FROM scaled s JOIN p{t} USING (r) GROUP BY j),
h{t} AS MATERIALIZED (SELECT a.j AS j, c.j AS k, sum(a.n * p * (1 - p) * a.x * c.x) AS h
  FROM scaled a JOIN scaled c ON a.r = c.r JOIN p{t} ON p{t}.r = a.r GROUP BY a.j, c.j),
-- the intercept follows from the others: rows of the matrix without it
m{t} AS (SELECT d.j, d.k, coalesce(h{t}.h, 0) - a.h * c.h / o{t}.h AS h
  FROM (SELECT a.j AS j, c.j AS k FROM names a, names c) d LEFT JOIN h{t} ON h{t}.j = d.j AND h{t}.k = d.k
  LEFT JOIN g{t} a ON a.j = d.j LEFT JOIN g{t} c ON c.j = d.k, o{t}),
q{t} AS MATERIALIZED (SELECT list(row ORDER BY j) AS m, list(c ORDER BY j) AS c, list(gj ORDER BY j) AS g, list(hj ORDER BY j) AS h FROM (
  SELECT m.j, any_value(m.row) AS row, coalesce(any_value(g{t}.g), 0) AS gj, coalesce(any_value(g{t}.h), 0) AS hj,
    coalesce(any_value(g{t}.g - g{t}.h * o{t}.g / o{t}.h), 0) - any_value(list_dot_product(m.row, w{t}.v)) AS c
  FROM (SELECT j, list(coalesce(h, 0) ORDER BY k) AS row FROM m{t} GROUP BY j) m LEFT JOIN g{t} ON g{t}.j = m.j, o{t}, w{t}
  GROUP BY m.j)),
d{t}(step, v) AS (
  SELECT CAST(0 AS BIGINT), v FROM w{t}
  UNION ALL
  SELECT step + 1, list_concat(list_concat(v[:j - 1], [CASE WHEN mjj > 0 THEN
      -sign(f) * greatest(abs(f) - {l1}, 0) / (mjj + {l2}) ELSE 0 END]), v[j + 1:])
  FROM (SELECT step, v, step % p + 1 AS j, m[step % p + 1][step % p + 1] AS mjj,
          c[step % p + 1] + list_dot_product(m[step % p + 1], v) - m[step % p + 1][step % p + 1] * v[step % p + 1] AS f
        FROM d{t}, q{t}, total WHERE step < {SWEEPS} * p)),
w{t + 1} AS MATERIALIZED (SELECT w.b - (o.g + list_dot_product(q.h, n.v) - list_dot_product(q.h, w.v)) / o.h AS b, n.v
  FROM (SELECT arg_max(v, step) AS v FROM d{t}) n, w{t} w, o{t} o, q{t} q)""")
    return _model_rows(label) + "," + ",".join(steps) + f"""
, fitted AS (SELECT b, v FROM w{NEWTON})"""


def _lr_coefficients(label: str) -> str:
    return recursive(q(_logistic(label) + """
SELECT CAST(names.j - 1 AS INTEGER) AS position,
  CASE WHEN c = n THEN n ELSE c || '_vec_' || n END AS feature,
  round(CASE WHEN s > 0 THEN v[names.j] / s ELSE 0 END, 4) + 0.0 AS coefficient
FROM names JOIN spread USING (j), fitted
UNION ALL SELECT CAST(p AS INTEGER), '(intercept)', round(b, 4) FROM fitted, total"""))


_CHANCES = """
, chances AS (SELECT l.session_id, any_value(y) AS y, 1 / (1 + exp(-(any_value(b) + sum(CASE WHEN s > 0 THEN x * v[c.j] / s ELSE 0 END)))) AS p
  FROM labelled l JOIN cells c USING (session_id) JOIN spread USING (j), fitted WHERE NOT training GROUP BY l.session_id)"""


def _lr_scores(label: str) -> str:
    return recursive(q(_logistic(label) + _CHANCES + """
SELECT session_id, y AS label, CASE WHEN p > 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS prediction,
  round(100 * p, 2) AS purchase_probability, CASE WHEN p > 0.5 THEN CAST(1 AS DOUBLE) ELSE 0 END AS predicted_purchase
FROM chances"""))


# pairs of a positive and a negative row in which the positive is ahead, ties half
AREA = """
SELECT {name} AS model, CAST(sum(positives + negatives) AS BIGINT) AS test_rows,
  sum(positives * (below + CAST(negatives AS DOUBLE) / 2)) / nullif(sum(positives), 0) / nullif(sum(negatives), 0) AS auc
FROM (SELECT *, sum(negatives) OVER (ORDER BY score) - negatives AS below FROM
  (SELECT score, count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives FROM {scored} GROUP BY score))"""


def _lr_auc(label: str) -> str:
    # equal rows may differ in the last digits here, where sums run in any order
    return recursive(q(_logistic(label) + _CHANCES + AREA.format(
        name="'logistic_regression'", scored="(SELECT y, round(p, 10) AS score FROM chances)")))


def _tree(label: str, depth: int = 5) -> str:
    """Leaf shares of a tree grown by one histogram (node, feature, value, label) a
    level; thresholds lie in the middle between neighbouring values of a feature, and
    sibling leaves that predict the same become one."""
    steps = ["""
rowset AS (SELECT session_id, y, training FROM labelled),
every AS (SELECT r.session_id, y, training, n.j, coalesce(x, 0) AS x
  FROM rowset r CROSS JOIN names n LEFT JOIN cells c ON c.session_id = r.session_id AND c.j = n.j),
known AS (SELECT j, x, lead(x) OVER (PARTITION BY j ORDER BY x) AS above FROM (SELECT DISTINCT j, x FROM every WHERE training)),
n0 AS (SELECT session_id, y, training, CAST(1 AS BIGINT) AS node FROM rowset)"""]
    gini = lambda p, n: f"(1 - ({p} / {n}) * ({p} / {n}) - (({n} - {p}) / {n}) * (({n} - {p}) / {n}))"
    for t in range(depth):
        steps.append(f"""
hist{t} AS (SELECT node, j, x, CAST(count(*) AS DOUBLE) AS n, CAST(sum(e.y) AS DOUBLE) AS p
  FROM n{t} JOIN every e USING (session_id) WHERE e.training GROUP BY node, j, x),
left{t} AS (SELECT node, j, x, sum(n) OVER upto AS ln, sum(p) OVER upto AS lp, sum(n) OVER whole AS n, sum(p) OVER whole AS p
  FROM hist{t} WINDOW whole AS (PARTITION BY node, j), upto AS (PARTITION BY node, j ORDER BY x)),
gain{t} AS (SELECT *, {gini('p', 'n')} - ln / n * {gini('lp', 'ln')} - (n - ln) / n * {gini('(p - lp)', '(n - ln)')} AS gain
  FROM left{t} WHERE ln < n),
best{t} AS (SELECT node, j, (x + above) / 2 AS cut FROM gain{t} JOIN known USING (j, x) WHERE gain > 1e-12
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 13) DESC, j, x) = 1),
n{t + 1} AS MATERIALIZED (SELECT a.session_id, a.y, a.training,
    CASE WHEN cut IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN e.x > cut THEN 1 ELSE 0 END END AS node
  FROM n{t} a LEFT JOIN best{t} b ON b.node = a.node LEFT JOIN every e ON e.session_id = a.session_id AND e.j = b.j)""")
    for t in range(depth, -1, -1):
        steps.append(f"""
s{t} AS (SELECT node, avg(y) AS share FROM n{t} WHERE training GROUP BY node),
leaf{t} AS (SELECT node, share > 0.5 AS says FROM s{t}""" + (")" if t == depth else f""" WHERE node NOT IN (SELECT node FROM best{t})
  UNION ALL SELECT b.node, a.says FROM best{t} b JOIN leaf{t + 1} a ON a.node = 2 * b.node
  JOIN leaf{t + 1} c ON c.node = 2 * b.node + 1 WHERE a.says = c.says)"""))
    joins = " ".join(f"JOIN n{t} a{t} ON a{t}.session_id = r.session_id LEFT JOIN leaf{t} l{t} ON l{t}.node = a{t}.node "
                     f"LEFT JOIN s{t} ON s{t}.node = l{t}.node" for t in range(depth + 1))
    share = ", ".join(f"s{t}.share" for t in range(depth + 1))
    return q(_model_rows(label) + "," + ",".join(steps) + f"""
SELECT r.session_id, r.y AS label, coalesce({share}) AS probability FROM rowset r {joins} WHERE NOT r.training""")


SQL: dict[str, str] = {
    # sources / cleaning
    "scan_sessions": q("SELECT * FROM raw"),
    "scan_csv": q("SELECT user_id, session_duration, pages_viewed, product_category, purchase_amount, "
                  "review_score, review_text, \"timestamp\", device_type, country, city FROM raw"),
    "null_counts": _null_counts(),
    "clean_audit": q("SELECT count(*) AS rows_before, "
                     "CAST(count_if(session_duration >= 0 AND pages_viewed >= 0) AS BIGINT) AS rows_after FROM raw"),
    "clean_sessions": q("SELECT * FROM clean"),
    # features
    "time_features": q("SELECT session_id, date, hour, day_of_week, month, year FROM enriched"),
    "session_category": q("SELECT session_id, session_duration, session_category FROM enriched"),
    "purchase_flag": q("SELECT session_id, purchase_amount, has_purchased FROM enriched"),
    "review_category": q("SELECT session_id, review_score, review_category FROM enriched"),
    "session_number": q('SELECT session_id, user_id, "timestamp", session_number FROM enriched'),
    "enriched_sessions": q(f"SELECT {ENRICHED_COLS} FROM enriched"),
    "parquet_sink": q(f"SELECT {ENRICHED_COLS.replace('review_text, ', '')} FROM enriched"),
    "pages_per_minute": q("SELECT session_id, CASE WHEN session_duration > 0 "
                          "THEN CAST(pages_viewed AS DOUBLE) / session_duration ELSE 0.0 END AS pages_per_minute "
                          "FROM enriched"),
    "user_history": q(f"""
SELECT user_id, {money_avg_raw('purchase_amount')} AS avg_purchase_amount,
       CAST(sum(has_purchased) AS BIGINT) AS total_purchases, count(*) AS total_sessions,
       CAST(sum(has_purchased) AS DOUBLE) / count(*) AS purchase_frequency
FROM enriched GROUP BY user_id"""),
    "session_features": q(f"""
, hist AS (
  SELECT user_id, {money_avg_raw('purchase_amount')} AS avg_purchase_amount,
         CAST(sum(has_purchased) AS BIGINT) AS total_purchases, count(*) AS total_sessions,
         CAST(sum(has_purchased) AS DOUBLE) / count(*) AS purchase_frequency
  FROM enriched GROUP BY user_id)
SELECT e.session_id, e.user_id, e.session_duration, e.pages_viewed, e.product_category, e.purchase_amount,
       e.review_score, e."timestamp", e.device_type, e.country, e.city, e.date, e.hour, e.day_of_week,
       e.month, e.year, e.session_category, e.has_purchased, e.review_category, e.session_number,
       CASE WHEN e.session_duration > 0 THEN CAST(e.pages_viewed AS DOUBLE) / e.session_duration ELSE 0.0 END
         AS pages_per_minute,
       h.avg_purchase_amount, h.total_purchases, h.total_sessions, h.purchase_frequency
FROM enriched e LEFT JOIN hist h ON e.user_id = h.user_id"""),
    # descriptive
    "describe_sessions": _describe(),
    "category_distribution": _dist("product_category"),
    "country_distribution": _dist("country"),
    "conversion_rate": q(f"""
SELECT count(*) AS total_sessions, CAST(sum(has_purchased) AS BIGINT) AS sessions_with_purchase,
       {pct('sum(has_purchased)', 'count(*)')} AS conversion_rate_percent FROM enriched"""),
    "conversion_by_device": _conv("device_type"),
    "conversion_by_session_category": _conv("session_category"),
    "correlation_matrix": _correlation(),
    # temporal
    "sessions_by_hour": _activity("hour"),
    "sessions_by_weekday": _activity("day_of_week"),
    "sessions_by_month": q(f"""
SELECT year, month, count(*) AS sessions, CAST(sum(has_purchased) AS BIGINT) AS purchases,
       {money_sum('purchase_amount')} AS total_sales, {money_avg('purchase_amount')} AS avg_purchase_amount
FROM enriched GROUP BY year, month"""),
    "weekday_hour_counts": q("SELECT day_of_week, hour, count(*) AS count FROM enriched GROUP BY day_of_week, hour"),
    "peak_hour_by_weekday": q("""
SELECT day_of_week, hour, count FROM (
  SELECT day_of_week, hour, count,
         row_number() OVER (PARTITION BY day_of_week ORDER BY count DESC, hour ASC) AS rk
  FROM (SELECT day_of_week, hour, count(*) AS count FROM enriched GROUP BY day_of_week, hour))
WHERE rk = 1"""),
    "daily_sales": q("SELECT date, CAST(cents AS DOUBLE) / 100.0 AS total_sales, order_count, avg_order_value FROM daily"),
    "sales_trend": q("""
SELECT date, CAST(cents AS DOUBLE) / 100.0 AS total_sales, order_count, avg_order_value,
       (CAST(sum(cents) OVER w AS DOUBLE) / 100.0) / count(*) OVER w AS sales_7day_avg,
       avg(order_count) OVER w AS orders_7day_avg
FROM daily WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""),
    # segmentation
    "user_metrics": q("SELECT * FROM um"),
    "behavior_segments": q("SELECT * FROM behav"),
    "segment_distribution": q(f"""
SELECT user_segment, count(*) AS count, {money_avg('customer_lifetime_value')} AS avg_clv,
       {money_avg('avg_rating')} AS avg_rating
FROM behav GROUP BY user_segment"""),
    "rfm_base": q("SELECT * FROM rfm"),
    "rfm_quantiles": q("\nUNION ALL\n".join(
        f"SELECT '{d}' AS dimension, CAST({p} AS DOUBLE) AS quantile, CAST(quantile_disc({d}, {p}) AS DOUBLE) AS cut_point FROM rfm"
        for d in ("recency_days", "frequency", "monetary") for p in (0.2, 0.4, 0.6, 0.8))),
    "rfm_scores": q("SELECT * FROM scored2"),
    "rfm_segments": q("SELECT * FROM segmented"),
    "rfm_distribution": q(f"""
SELECT rfm_segment, count(*) AS count, {money_avg('customer_lifetime_value')} AS avg_clv
FROM segmented GROUP BY rfm_segment"""),
    # cohorts
    "user_cohorts": q("SELECT user_id, first_session, cohort_year, cohort_month, cohort FROM firsts"),
    "cohort_activity": q("SELECT * FROM cohort_act"),
    "cohort_sizes": q("SELECT * FROM cohort_size"),
    "cohort_retention": q(f"""
SELECT a.cohort, a.months_since_first, a.active_users, a.purchases, a.avg_purchase, s.initial_users,
       {pct('a.active_users', 's.initial_users')} AS retention_rate
FROM cohort_act a JOIN cohort_size s ON a.cohort = s.cohort"""),
    # reviews
    "review_distribution": q("SELECT review_score, count(*) AS count FROM enriched "
                             "WHERE review_score IS NOT NULL GROUP BY review_score"),
    "reviews_by_category": q("SELECT product_category, review_category, count(*) AS count FROM enriched "
                             "WHERE review_score IS NOT NULL GROUP BY product_category, review_category"),
    "reviews_by_country": q(f"""
SELECT country, count(review_score) AS review_count, {r2('avg(review_score)')} AS avg_review_score
FROM enriched WHERE review_score IS NOT NULL GROUP BY country"""),
    "review_tokens": q("""
SELECT session_id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos, unnest(tokens) AS term
FROM toks"""),
    "common_positive_terms": _terms("Positif"),
    "common_negative_terms": _terms("Négatif"),
    "top_terms": q("""
SELECT review_category, term, count, CAST(rk AS INTEGER) AS rank FROM (
  SELECT review_category, term, count,
         row_number() OVER (PARTITION BY review_category ORDER BY count DESC, term ASC) AS rk
  FROM (SELECT review_category, term, count(*) AS count FROM terms
        WHERE review_category IN ('Positif', 'Négatif') GROUP BY review_category, term))
WHERE rk <= 10"""),
    "review_impact": q("""
SELECT round(avg_user_review) AS rounded_review_score, avg(purchase_count) AS avg_purchases_per_user,
       count(*) AS user_count
FROM (SELECT user_id, avg(review_score) AS avg_user_review, sum(has_purchased) AS purchase_count
      FROM enriched WHERE review_score IS NOT NULL GROUP BY user_id)
GROUP BY round(avg_user_review)"""),
    # dashboard series
    "chart_category_distribution": q("SELECT product_category, count(*) AS count FROM enriched GROUP BY product_category"),
    "chart_conversion_by_category": _conv("product_category", "conversion_rate", "purchases"),
    "chart_sessions_by_hour": q("SELECT hour, count(*) AS sessions, CAST(sum(has_purchased) AS BIGINT) AS purchases "
                                "FROM enriched GROUP BY hour"),
    "chart_review_distribution": q("SELECT review_score, count(*) AS count FROM enriched "
                                   "WHERE review_score IS NOT NULL GROUP BY review_score"),
    "chart_purchase_by_pages": q(f"""
SELECT pages_viewed, count(*) AS sessions, CAST(sum(has_purchased) AS BIGINT) AS purchases,
       {pct('sum(has_purchased)', 'count(*)')} AS purchase_rate
FROM enriched GROUP BY pages_viewed HAVING count(*) > {PAGES_MIN_SESSIONS}"""),
    "chart_conversion_by_device": _conv("device_type", "conversion_rate", "purchases"),
    "chart_sessions_by_day": q(f"""
SELECT day_of_week, count(*) AS sessions, CAST(sum(has_purchased) AS BIGINT) AS purchases,
       CAST(coalesce(list_position({[d for d in WEEKDAYS]}, day_of_week), 0) - 1 AS INTEGER) AS day_index
FROM enriched GROUP BY day_of_week"""),
    "dashboard_series": _dashboard(),
    # data quality and utilities
    "data_quality": _data_quality(),
    "table_summary": q("SELECT count(*) AS row_count, 12 AS column_count FROM raw"),
    "cap_outliers": q("""
, b AS (SELECT CAST(quantile_disc(session_duration, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc(session_duration, 0.75) AS DOUBLE) AS q3 FROM clean)
SELECT session_id,
       CASE WHEN session_duration > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1)
            WHEN session_duration < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
            ELSE CAST(session_duration AS DOUBLE) END AS session_duration
FROM clean CROSS JOIN b"""),
    "remove_outliers": q("""
, b AS (SELECT quantile_disc(session_duration, 0.25) AS q1, quantile_disc(session_duration, 0.75) AS q3 FROM raw)
SELECT session_id, session_duration FROM raw CROSS JOIN b
WHERE session_duration >= q1 - 1.5 * (q3 - q1) AND session_duration <= q3 + 1.5 * (q3 - q1)"""),
    "table_schema": q("\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{n}' AS column_name, '{t}' AS data_type, count({n}) AS filled FROM raw" for i, (n, t) in enumerate(
            [("session_id", "bigint"), ("user_id", "string"), ("session_duration", "int"), ("pages_viewed", "int"),
             ("product_category", "string"), ("purchase_amount", "double"), ("review_score", "double"),
             ("review_text", "string"), ("timestamp", "timestamp_ntz"), ("device_type", "string"),
             ("country", "string"), ("city", "string")]))),
    "table_preview": q("SELECT session_id, user_id, session_duration, pages_viewed, product_category, purchase_amount, "
                       "review_score, device_type, country, city FROM raw ORDER BY session_id LIMIT 5"),
    "feature_vectors": q("""
, train AS (SELECT * FROM enriched WHERE (session_id * 7919) % 100 < 70),
d AS (SELECT device_type AS v, row_number() OVER (ORDER BY count(*) DESC, device_type) AS i FROM train
      WHERE device_type IS NOT NULL GROUP BY device_type),
c AS (SELECT product_category AS v, row_number() OVER (ORDER BY count(*) DESC, product_category) AS i FROM train
      WHERE product_category IS NOT NULL GROUP BY product_category),
w AS (SELECT day_of_week AS v, row_number() OVER (ORDER BY count(*) DESC, day_of_week) AS i FROM train
      WHERE day_of_week IS NOT NULL GROUP BY day_of_week)
SELECT session_id, concat_ws(',', CAST(session_duration AS DOUBLE), CAST(pages_viewed AS DOUBLE), CAST(hour AS DOUBLE),
  (SELECT string_agg(CASE WHEN d.v = e.device_type THEN '1.0' ELSE '0.0' END, ',' ORDER BY i) FROM d),
  (SELECT string_agg(CASE WHEN c.v = e.product_category THEN '1.0' ELSE '0.0' END, ',' ORDER BY i) FROM c),
  (SELECT string_agg(CASE WHEN w.v = e.day_of_week THEN '1.0' ELSE '0.0' END, ',' ORDER BY i) FROM w)) AS features
FROM enriched e WHERE NOT (session_id * 7919) % 100 < 70"""),
    "purchase_learnable_auc": q("""
SELECT 'logistic_regression' AS model, count(*) AS test_rows, true AS auc_above_0_9
FROM enriched WHERE NOT (session_id * 7919) % 100 < 70"""),
    # ML inputs
    "model_input": q("SELECT session_id, session_duration, pages_viewed, hour, device_type, product_category, "
                     "day_of_week, has_purchased AS label FROM enriched"),
    "train_test_split": q("SELECT session_id, (session_id * 7919) % 100 < 70 AS in_training FROM enriched"),
}


SQL |= {
    "purchase_lr_coefficients": _lr_coefficients("has_purchased"),
    "purchase_scores": _lr_scores("has_purchased"),
    "purchase_saved_model": _lr_scores("has_purchased"),
    "purchase_lr_auc": _lr_auc("has_purchased"),
    "purchase_tree": _tree("has_purchased"),
    "signal_lr_coefficients": _lr_coefficients(SIGNAL),
    "signal_saved_model": _lr_scores(SIGNAL),
    "signal_lr_auc": _lr_auc(SIGNAL),
    "signal_tree": _tree(SIGNAL),
}
SQL["top_terms_sketched"] = SQL["top_terms"]
SQL["staged_sessions"] = SQL["enriched_sessions"]
CSV_COLUMNS = "user_id, session_duration, pages_viewed, product_category, purchase_amount, review_score, review_text, timestamp, device_type, country, city"
SQL["csv_good"] = q(f"SELECT {CSV_COLUMNS} FROM raw WHERE session_id % 50 NOT BETWEEN 1 AND 6")
SQL["csv_quarantine"] = q("""
SELECT CASE session_id % 50 WHEN 1 THEN 'bad session_duration' WHEN 2 THEN 'bad purchase_amount' WHEN 3 THEN 'bad timestamp'
    WHEN 4 THEN 'ragged' WHEN 5 THEN 'ragged' WHEN 6 THEN 'bad session_duration, purchase_amount' ELSE 'good' END AS reason,
  count(*) AS lines, count(*) FILTER (session_id % 50 BETWEEN 1 AND 6) AS kept_lines
FROM raw GROUP BY 1""")
SQL["approximate_cut_ranks"] = q("\nUNION ALL\n".join(
    f"SELECT '{of}' AS of, '{c}' AS column_name, CAST({p} AS DOUBLE) AS quantile, count({c}) AS rows, true AS within FROM {table}"
    for of, table, columns, probs in (
        ("sessions", "enriched", ("session_duration", "pages_viewed", "purchase_amount", "review_score"), (0.25, 0.5, 0.75)),
        ("rfm", "rfm", ("recency_days", "frequency", "monetary"), (0.2, 0.4, 0.6, 0.8)))
    for c in columns for p in probs))
SQL["approximate_distinct"] = q("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, true AS within FROM enriched"
    for c in ("session_id", "user_id", "product_category", "purchase_amount", "timestamp", "city")))
SQL["csv_enriched"] = f"SELECT {', '.join(c for c in ENRICHED_COLS.replace('session_id, ', '').split(', '))} FROM ({SQL['enriched_sessions']})"

# Reports: the results of each by name, with all their rows and columns.
REPORTS = {
    "descriptive_report": {
        "stats": "describe_text", "statsTyped": "describe_sessions", "categoryDistribution": "category_distribution",
        "countryDistribution": "country_distribution", "conversionRate": "conversion_rate",
        "conversionByDevice": "conversion_by_device", "conversionBySessionCategory": "conversion_by_session_category",
        "correlations": "correlation_matrix"},
    "temporal_report": {
        "sessionsByHour": "sessions_by_hour", "sessionsByDayOfWeek": "sessions_by_weekday",
        "sessionsByMonth": "sessions_by_month", "peakHours": "peak_hour_by_weekday", "salesTrend": "sales_trend"},
    "segmentation_report": {
        "behaviorSegmentation": "behavior_segments", "segmentDistribution": "segment_distribution",
        "rfmAnalysis": "rfm_scores", "rfmSegments": "rfm_segments", "rfmDistribution": "rfm_distribution",
        "cohortRetention": "cohort_retention"},
    "review_report": {
        "reviewDistribution": "review_distribution", "reviewsByCategory": "reviews_by_category",
        "reviewsByCountry": "reviews_by_country", "commonPositiveTerms": "common_positive_terms",
        "commonNegativeTerms": "common_negative_terms", "topTerms": "top_terms", "reviewImpact": "review_impact"},
}


def oracle_sql() -> dict[str, str]:
    results = SQL | {"describe_text": _describe_text()}
    reports = {name: " UNION ALL BY NAME ".join(f"SELECT '{result}' AS result, * FROM ({results[key]})"
                                                for result, key in parts.items()) for name, parts in REPORTS.items()}
    return SQL | reports
