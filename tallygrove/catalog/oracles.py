"""SQL that each registered query must agree with, in the dialect of DuckDB.

Models appear here as closed forms: multinomial naive Bayes, group rates for logistic regression on
one category, and the best split for trees of one or two levels.
"""

from __future__ import annotations

PROFILE = """
lines AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS n_lines, sum(l_quantity) AS sum_qty,
         sum(l_extendedprice * (1 - l_discount)) AS revenue
  FROM lineitem GROUP BY l_orderkey),
profile AS (
  SELECT o_orderkey, o_orderstatus, o_orderpriority, c_mktsegment, n_lines, sum_qty, c_acctbal,
         CASE WHEN revenue > 200000 THEN '>200K' ELSE '<=200K' END AS revenue_band
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN lines ON o_orderkey = l_orderkey),
prepared AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END AS o_orderstatus,
         o_orderpriority, c_mktsegment, n_lines, sum_qty,
         CASE WHEN contains(revenue_band, '>200K') THEN 1 ELSE 0 END AS label
  FROM profile),
hashed AS (SELECT *, md5(concat(o_orderkey, '-', 42)) AS h FROM prepared),
inside AS (SELECT * EXCLUDE (h) FROM hashed WHERE substr(h, 1, 8) < 'cccccccc'),
outside AS (SELECT * EXCLUDE (h) FROM hashed WHERE substr(h, 1, 8) >= 'cccccccc'),
folded AS (
  SELECT * EXCLUDE (h), CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM hashed WHERE substr(h, 1, 8) < 'cccccccc')
"""

CATEGORIES = ("o_orderstatus", "o_orderpriority", "c_mktsegment")


def with_profile(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([PROFILE.strip(), *(c.strip() for c in ctes)]) + "\n" + body


def naive_bayes(fit: str, rows: str, smoothing: str = "", whole_lines: bool = True) -> str:
    """Multinomial naive Bayes of every group ``g``: ``fit`` trains it, ``rows`` are scored.

    Both are queries with ``g`` before the prepared columns. ``smoothing`` is a query of (g, lam);
    left out, every lam is 1. ``whole_lines`` cuts the mean of the integer column to an integer.
    """
    mean_lines = "trunc(avg(n_lines))" if whole_lines else "avg(n_lines)"

    def long(table: str) -> str:
        parts = [
            f"SELECT g, o_orderkey, label, '{c}=' || {c} AS slot, 1.0::DOUBLE AS x "
            f"FROM {table} WHERE {c} IS NOT NULL"
            for c in CATEGORIES
        ]
        parts += [
            f"SELECT g, o_orderkey, label, 'n_lines', coalesce(n_lines, m_lines)::DOUBLE "
            f"FROM {table} JOIN nb_means USING (g)",
            f"SELECT g, o_orderkey, label, 'sum_qty', coalesce(sum_qty, m_qty) "
            f"FROM {table} JOIN nb_means USING (g)",
        ]
        return "\n  UNION ALL ".join(parts)

    smoothing = smoothing or "SELECT DISTINCT g, 1.0::DOUBLE AS lam FROM nb_fit"
    return f"""
nb_fit AS ({fit}),
nb_rows AS ({rows}),
nb_lam AS ({smoothing}),
nb_means AS (
  SELECT g, {mean_lines} AS m_lines, avg(sum_qty) AS m_qty FROM nb_fit GROUP BY g),
nb_fit_long AS ({long('nb_fit')}),
nb_long AS ({long('nb_rows')}),
nb_slots AS (SELECT DISTINCT g, slot FROM nb_fit_long),
nb_dims AS (SELECT g, count(*) AS d FROM nb_slots GROUP BY g),
nb_sums AS (
  SELECT s.g, c.label, s.slot, coalesce(sum(f.x), 0) AS s
  FROM nb_slots s CROSS JOIN (VALUES (0), (1)) c(label)
  LEFT JOIN nb_fit_long f ON f.g = s.g AND f.slot = s.slot AND f.label = c.label
  GROUP BY s.g, c.label, s.slot),
nb_totals AS (SELECT g, label, sum(s) AS t FROM nb_sums GROUP BY g, label),
nb_theta AS (
  SELECT g, label, slot, ln(s + lam) - ln(t + lam * d) AS theta
  FROM nb_sums JOIN nb_totals USING (g, label) JOIN nb_dims USING (g) JOIN nb_lam USING (g)),
nb_priors AS (
  SELECT g,
         ln(count(*) FILTER (label = 0) + any_value(lam)) - ln(count(*) + 2 * any_value(lam)) AS pi0,
         ln(count(*) FILTER (label = 1) + any_value(lam)) - ln(count(*) + 2 * any_value(lam)) AS pi1
  FROM nb_fit JOIN nb_lam USING (g) GROUP BY g),
nb_scores AS (
  SELECT r.g, r.o_orderkey, r.label,
         any_value(pi0) + coalesce(sum(x * theta) FILTER (t.label = 0), 0) AS raw0,
         any_value(pi1) + coalesce(sum(x * theta) FILTER (t.label = 1), 0) AS raw1
  FROM nb_long r JOIN nb_theta t ON t.g = r.g AND t.slot = r.slot
  JOIN nb_priors p ON p.g = r.g
  GROUP BY r.g, r.o_orderkey, r.label),
nb AS (
  SELECT *, 1 / (1 + exp(raw0 - raw1)) AS p1, CASE WHEN raw1 > raw0 THEN 1 ELSE 0 END AS prediction
  FROM nb_scores)
"""


# One model trained on the first part of the split, with 0 as its group.
FIT_INSIDE = "SELECT 0 AS g, * FROM inside"
NB = naive_bayes(FIT_INSIDE, "SELECT 0 AS g, * FROM outside")
NB_INSIDE = naive_bayes(FIT_INSIDE, "SELECT 0 AS g, * FROM inside")
NB_ALL = naive_bayes(FIT_INSIDE, "SELECT 0 AS g, * FROM prepared")
NB_TEXT = naive_bayes(FIT_INSIDE, "SELECT 0 AS g, * FROM outside", whole_lines=False)
NB_TEXT_ALL = naive_bayes(FIT_INSIDE, "SELECT 0 AS g, * FROM prepared", whole_lines=False)
# One model per fold, trained on the other folds.
NB_FOLDS = naive_bayes(
    "SELECT k AS g, folded.* EXCLUDE (fold) FROM folded, range(5) r(k) WHERE fold <> k",
    "SELECT fold AS g, folded.* EXCLUDE (fold) FROM folded",
)
# One model per candidate and fold; g = 10 * candidate + fold.
CANDIDATES = "(VALUES (0, 0.5), (1, 1.0), (2, 4.0)) c(candidate, lam)"
# The search's list: the default smoothing, then its variants in seeded order.
_TRIED = (1.0, 2.0, 0.5, 4.0, 0.25)
SEARCHED = f"(VALUES {', '.join(f'({n}, {lam})' for n, lam in enumerate(_TRIED))}) c(candidate, lam)"


def candidate_folds(candidates: str = CANDIDATES) -> str:
    return naive_bayes(
        f"SELECT 10 * candidate + k AS g, folded.* EXCLUDE (fold) "
        f"FROM folded, range(5) r(k), {candidates} WHERE fold <> k",
        f"SELECT 10 * candidate + fold AS g, folded.* EXCLUDE (fold) FROM folded, {candidates}",
        f"SELECT 10 * candidate + k AS g, lam::DOUBLE AS lam FROM range(5) r(k), {candidates}",
    )


def auc(source: str, by: str, name: str = "aucs") -> str:
    """Area under the ROC curve of every group, by the tie-corrected rank sum of the positives."""
    return f"""
{name}_ranks AS (
  SELECT {by}, label, rank() OVER (PARTITION BY {by} ORDER BY round(p1, 12))
         + (count(*) OVER (PARTITION BY {by}, round(p1, 12)) - 1) / 2.0 AS r
  FROM {source}),
{name} AS (
  SELECT {by}, (sum(r) FILTER (label = 1)
          - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
         / count(*) FILTER (label = 1) / count(*) FILTER (label = 0) AS auc
  FROM {name}_ranks GROUP BY {by})
"""


CANDIDATE_TABLE = """
tried AS (
  SELECT CAST(g // 10 AS INTEGER) AS candidate, avg(auc) AS mean_auc,
         stddev_pop(auc) AS stddev_auc
  FROM aucs GROUP BY g // 10),
named AS (
  SELECT candidate, 'naive_bayes' AS algorithm, 'smoothing=' || lam AS params,
         lam::DOUBLE AS lam, mean_auc, stddev_auc,
         CAST(row_number() OVER (ORDER BY mean_auc DESC, candidate) AS INTEGER) AS rank
  FROM tried JOIN (VALUES (0, 0.5), (1, 1.0), (2, 4.0)) c(candidate, lam) USING (candidate))
"""

SEARCH = (candidate_folds(), auc("nb", "g"), CANDIDATE_TABLE)

ERRORS = """(
    count(*) FILTER (label = 1 AND prediction = 0) / count(*) FILTER (label = 1)
  + count(*) FILTER (label = 0 AND prediction = 1) / count(*) FILTER (label = 0)) / 2"""
ACCURACY = "count(*) FILTER (label = prediction) / count(*)"
LOSS = """avg(-ln(least(greatest(
    CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END, 1e-15), 1 - 1e-15)))"""
PERFORMANCE = f"""count(*) AS n, round({ACCURACY}, 6) AS accuracy,
  round({ERRORS}, 6) AS mean_per_class_error, round({LOSS}, 6) AS log_loss,
  count(*) FILTER (label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (label = 0 AND prediction = 1) AS fp,
  count(*) FILTER (label = 0 AND prediction = 0) AS tn"""
NB_ROWS = "SELECT o_orderkey, round(p1, 6) AS p1, prediction FROM nb"

# Best split of a node: every slot and every number of lines is a column of 0/1 or whole values.
_SLOTS = "\n  UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS source, {c} AS v, '{c}_vec_' || {c} AS feature FROM inside"
    for c in CATEGORIES
)


def _tree_long(table: str) -> str:
    parts = [
        f"SELECT o_orderkey, label, feature, CASE WHEN t.{c} = v THEN 1 ELSE 0 END AS value "
        f"FROM {table} t, slots WHERE source = '{c}'"
        for c in CATEGORIES
    ]
    parts.append(
        f"SELECT o_orderkey, label, 'n_lines_IMPUTED', coalesce(n_lines, m_lines) "
        f"FROM {table}, line_mean"
    )
    return "\n  UNION ALL ".join(parts)


def best_split(name: str, source: str) -> str:
    """Highest Gini gain per node over all features and cuts of ``source(node, ...)``."""
    return f"""
{name}_values AS (
  SELECT node, feature, value, count(*) AS n, sum(label) AS pos
  FROM {source} GROUP BY node, feature, value),
{name}_cuts AS (
  SELECT node, feature, value,
         lead(value) OVER w AS nxt,
         sum(n) OVER w AS nl, sum(pos) OVER w AS pl,
         sum(n) OVER f AS nt, sum(pos) OVER f AS pt
  FROM {name}_values
  WINDOW w AS (PARTITION BY node, feature ORDER BY value),
         f AS (PARTITION BY node, feature)),
{name}_rates AS (
  SELECT *, pl / nl AS left_rate, (pt - pl) / (nt - nl) AS right_rate, pt / nt AS rate
  FROM {name}_cuts WHERE nxt IS NOT NULL),
{name}_gains AS (
  SELECT *, (value + nxt) / 2 AS threshold,
         2 * rate * (1 - rate) - nl / nt * 2 * left_rate * (1 - left_rate)
         - (nt - nl) / nt * 2 * right_rate * (1 - right_rate) AS gain
  FROM {name}_rates),
{name} AS MATERIALIZED (
  SELECT * FROM {name}_gains
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature) = 1)
"""


TREE = (
    f"""
line_mean AS (SELECT trunc(avg(n_lines)) AS m_lines FROM inside),
slots AS MATERIALIZED ({_SLOTS}),
tree_fit AS MATERIALIZED ({_tree_long('inside')}),
tree_rows AS MATERIALIZED ({_tree_long('outside')}),
root_rows AS MATERIALIZED (SELECT 0 AS node, * FROM tree_fit)
""",
    best_split("root", "root_rows"),
)


def stump(probability: str) -> str:
    return with_profile(
        f"""
SELECT o_orderkey, round(p1, 6) AS p1, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS prediction
FROM (SELECT o_orderkey, CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END AS leaf,
             {probability} AS p1
      FROM tree_rows t JOIN root USING (feature))
""",
        *TREE,
    )


# The second boosting round: the split that best explains the first round's pseudo-residuals.
SECOND_ROUND = """
first_round AS MATERIALIZED (
  SELECT o_orderkey, label,
         2 * CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END - 1 AS margin
  FROM tree_fit t JOIN root USING (feature)),
residuals AS MATERIALIZED (
  SELECT o_orderkey, 4 * (2 * label - 1) / (1 + exp(2 * (2 * label - 1) * margin)) AS r
  FROM first_round),
second_values AS MATERIALIZED (
  SELECT feature, value, count(*) AS n, sum(r) AS s
  FROM tree_fit JOIN residuals USING (o_orderkey) GROUP BY feature, value),
second_cuts AS (
  SELECT feature, value, lead(value) OVER w AS nxt, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
         sum(n) OVER f AS nt, sum(s) OVER f AS st
  FROM second_values
  WINDOW w AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)),
second_split AS MATERIALIZED (
  SELECT feature, (value + nxt) / 2 AS cut, sl / nl AS left_mean, (st - sl) / (nt - nl) AS right_mean,
         st / nt AS all_mean
  FROM second_cuts WHERE nxt IS NOT NULL
  ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, feature LIMIT 1),
margins AS (
  SELECT o_orderkey,
         max(CASE WHEN t.feature = root.feature
                  THEN 2 * CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END - 1 END)
         + 0.1 * max(CASE WHEN t.feature = q.feature
                          THEN CASE WHEN t.value <= cut THEN left_mean ELSE right_mean END END) AS margin
  FROM tree_rows t CROSS JOIN root CROSS JOIN second_split q
  WHERE t.feature IN (root.feature, q.feature)
  GROUP BY o_orderkey)
"""

# A fifth of the inside rows, by a hash of its own, says when boosted trees stop; the others learn.
LEARNED = """
marked AS (
  SELECT *, substr(md5(concat(o_orderkey, '-', o_orderkey, '-', 42)), 1, 8) < '33333333' AS held FROM inside),
learned AS (SELECT * EXCLUDE (held) FROM marked WHERE NOT held)
"""
VALIDATED_TREE = (
    f"""
line_mean AS (SELECT trunc(avg(n_lines)) AS m_lines FROM inside),
slots AS MATERIALIZED ({_SLOTS}),
tree_fit AS MATERIALIZED ({_tree_long('learned')}),
tree_rows AS MATERIALIZED ({_tree_long('inside')}),
root_rows AS MATERIALIZED (SELECT 0 AS node, * FROM tree_fit)
""",
    best_split("root", "root_rows"),
)


def second_order(rounds: int) -> str:
    """Rounds of one-split trees by gradients and hessians, of the rows that are neither out nor held:
    ``so0``, ``so1``, ... hold each row's margin."""
    parts = [
        """
so0 AS (
  SELECT o_orderkey, label, o_orderstatus, o_orderpriority, c_mktsegment, n_lines,
         substr(h, 1, 8) >= 'cccccccc' AS is_out, {held} AS held, 0.0::DOUBLE AS margin FROM hashed)"""
    ]
    for k in range(1, rounds + 1):
        by_value = "\n  UNION ALL ".join(
            f"SELECT {i} AS col, false AS ml, NULL::INTEGER AS cut, {c} AS v, sum(g) AS gl, sum(hess) AS hl "
            f"FROM so{k}_grad GROUP BY {c}"
            for i, c in enumerate(CATEGORIES)
        )
        left = " ".join(f"WHEN {i} THEN t.{c} IS NOT DISTINCT FROM b.v" for i, c in enumerate(CATEGORIES))
        parts.append(
            f"""
so{k}_grad AS MATERIALIZED (
  SELECT *, p - label AS g, p * (1 - p) AS hess
  FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM so{k - 1}) WHERE NOT is_out AND NOT held),
so{k}_cuts AS (
  SELECT DISTINCT n_lines AS cut FROM so{k}_grad
  WHERE n_lines > (SELECT min(n_lines) FROM so{k}_grad)),
so{k}_sides AS (
  {by_value}
  UNION ALL
  SELECT {len(CATEGORIES)}, ml, cut, NULL,
         coalesce(sum(g) FILTER (n_lines < cut OR (ml AND n_lines IS NULL)), 0),
         coalesce(sum(hess) FILTER (n_lines < cut OR (ml AND n_lines IS NULL)), 0)
  FROM so{k}_grad CROSS JOIN so{k}_cuts CROSS JOIN (VALUES (false), (true)) m(ml) GROUP BY ml, cut),
so{k}_best AS MATERIALIZED (
  SELECT *, round((gl * gl / (hl + 1) + (gt - gl) * (gt - gl) / (ht - hl + 1) - gt * gt / (ht + 1)) / 2, 9) AS gain
  FROM so{k}_sides CROSS JOIN (SELECT sum(g) AS gt, sum(hess) AS ht FROM so{k}_grad)
  WHERE hl >= 1 AND ht - hl >= 1
  ORDER BY gain DESC, col, ml, cut NULLS FIRST, v NULLS FIRST LIMIT 1),
so{k} AS MATERIALIZED (
  SELECT t.* REPLACE (margin - 0.3 * CASE WHEN CASE col {left} ELSE coalesce(n_lines < cut, ml) END
    THEN gl / (hl + 1) ELSE (gt - gl) / (ht - hl + 1) END AS margin)
  FROM so{k - 1} t CROSS JOIN so{k}_best b)"""
        )
    return ",".join(parts)


def _second_order_scores(rounds: int) -> str:
    return with_profile(
        f"SELECT o_orderkey, round(1 / (1 + exp(-margin)), 6) AS p1, "
        f"CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction FROM so{rounds} WHERE is_out",
        second_order(rounds).format(held="false"),
    )


_HELD = "substr(md5(concat(o_orderkey, '-', o_orderkey, '-', 42)), 1, 8) < '33333333'"

# Contributions by cover: each tree's column gets what the row's leaf is above the tree's mean.
_SOURCES = "(VALUES ('o_orderstatus'), ('o_orderpriority'), ('c_mktsegment'), ('n_lines')) f(feature)"


def _source(feature: str) -> str:
    return f"replace(split_part({feature}, '_vec_', 1), '_IMPUTED', '')"


PATH_ROUNDS = f"""
rounds AS (
  SELECT t.o_orderkey, {_source('t.feature')} AS source,
         2 * (2 * CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END - 1) AS leaf,
         2 * (2 * rate - 1) AS mean
  FROM tree_rows t JOIN root USING (feature)
  UNION ALL
  SELECT t.o_orderkey, {_source('t.feature')},
         0.2 * CASE WHEN t.value <= cut THEN left_mean ELSE right_mean END, 0.2 * all_mean
  FROM tree_rows t JOIN second_split USING (feature)),
path_parts AS (
  SELECT o_orderkey, f.feature,
         coalesce(sum(leaf - mean) FILTER (source = f.feature), 0) AS contribution
  FROM rounds CROSS JOIN {_SOURCES} GROUP BY o_orderkey, f.feature)
"""

_NAMES = "SELECT feature AS name FROM slots UNION ALL SELECT 'n_lines_IMPUTED'"
IMPORTANCE = (
    *TREE,
    """
sides AS (
  SELECT o_orderkey, CASE WHEN t.value <= threshold THEN 1 ELSE 2 END AS node
  FROM tree_fit t JOIN root USING (feature)),
child_rows AS (SELECT s.node, t.* FROM tree_fit t JOIN sides s USING (o_orderkey))
""",
    best_split("child", "child_rows"),
    f"""
gained AS (
  SELECT feature, gain * nt AS amount FROM root
  UNION ALL
  SELECT feature, gain * nt FROM child
  WHERE gain > 0 AND (left_rate > 0.5) <> (right_rate > 0.5)),
importance AS (
  SELECT name, coalesce(sum(amount), 0) / (SELECT sum(amount) FROM gained) AS score
  FROM ({_NAMES}) LEFT JOIN gained ON feature = name GROUP BY name)
""",
)

# Log-odds weights of naive Bayes and the mean of every slot over the training rows.
CONTRIBUTIONS = """
weights AS (
  SELECT slot, sum(theta) FILTER (label = 1) - sum(theta) FILTER (label = 0) AS w
  FROM nb_theta GROUP BY slot),
slot_means AS (
  SELECT slot, sum(x) / (SELECT count(*) FROM nb_fit) AS m FROM nb_fit_long GROUP BY slot),
offsets AS (
  SELECT split_part(slot, '=', 1) AS feature, sum(w * m) AS o
  FROM weights JOIN slot_means USING (slot) GROUP BY ALL),
contrib AS (
  SELECT r.o_orderkey, o.feature, coalesce(sum(x * w), 0) - any_value(o) AS contribution
  FROM nb_rows r CROSS JOIN offsets o
  LEFT JOIN nb_long l ON l.o_orderkey = r.o_orderkey AND split_part(l.slot, '=', 1) = o.feature
  LEFT JOIN weights USING (slot)
  GROUP BY r.o_orderkey, o.feature)
"""

BANDED = """
banded AS (
  SELECT o_orderkey, label,
         CAST(CAST(least(floor(coalesce(sum_qty, 0) / 40), 4) AS BIGINT) AS VARCHAR) AS qty_band
  FROM prepared),
band_fit AS (
  SELECT b.* FROM banded b JOIN inside USING (o_orderkey)),
band_rows AS (
  SELECT b.* FROM banded b JOIN outside USING (o_orderkey)),
band_rates AS (
  SELECT qty_band, avg(label) AS rate, count(*) / (SELECT count(*) FROM band_fit) AS share
  FROM band_fit GROUP BY qty_band)
"""

ORDERS_TEXT = """
SELECT o_orderkey, ' ' || o_orderstatus AS o_orderstatus, round(o_totalprice, 6) AS o_totalprice,
       1 AS custkey_missing
FROM orders"""


def _describe(column: str, numeric: bool, table: str = "prepared") -> str:
    if numeric:
        return (
            f"SELECT '{column}' AS \"column\", count({column}) AS n, round(avg({column}), 6) AS mean, "
            f"round(stddev_samp({column}), 6) AS stddev, round(min({column})::DOUBLE, 6) AS min, "
            f"round(max({column})::DOUBLE, 6) AS max, NULL::VARCHAR AS min_text, "
            f"NULL::VARCHAR AS max_text FROM {table}"
        )
    return (
        f"SELECT '{column}', count({column}), NULL, NULL, NULL, NULL, min({column}), max({column}) "
        f"FROM {table}"
    )


def _summary(column: str) -> str:
    def quantile(share: float) -> str:
        return (
            f"round((SELECT min(v) FROM (SELECT {column}::DOUBLE AS v, "
            f"count(*) OVER (ORDER BY {column}) AS upto FROM lineitem WHERE {column} IS NOT NULL) "
            f"WHERE upto >= {share} * (SELECT count({column}) FROM lineitem)), 4)"
        )

    return (
        f"SELECT '{column}' AS \"column\", count({column}) AS n, round(avg({column}), 4) AS mean, "
        f"round(stddev_samp({column}), 4) AS stddev, round(min({column})::DOUBLE, 4) AS min, "
        f"round(max({column})::DOUBLE, 4) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text, "
        f"{quantile(0.25)} AS p25, {quantile(0.5)} AS p50, {quantile(0.75)} AS p75 FROM lineitem"
    )


def _ranked(column: str, table: str = "prepared") -> str:
    """Values of a column with their index: by falling frequency, then by value."""
    return (
        f"SELECT {column} AS v, "
        f"CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS INTEGER) AS idx, "
        f"CAST(count(*) OVER () AS INTEGER) AS width "
        f"FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"
    )


INDEXES = ",\n".join(f"{c}_index AS ({_ranked(c)})" for c in CATEGORIES) + """,
offset_of AS (
  SELECT (SELECT any_value(width) FROM o_orderstatus_index) AS status,
         (SELECT any_value(width) FROM o_orderpriority_index) AS priority,
         (SELECT any_value(width) FROM c_mktsegment_index) AS segment),
filled AS (
  SELECT *, coalesce(n_lines, (SELECT trunc(avg(n_lines)) FROM prepared)) AS lines_filled,
         coalesce(sum_qty, (SELECT avg(sum_qty) FROM prepared)) AS qty_filled
  FROM prepared)"""

BEST_F1 = """
steps AS (
  SELECT round(p1, 12) AS s, sum(label) AS pos, count(*) AS n FROM nb GROUP BY 1),
totals AS (
  SELECT s, sum(pos) OVER w AS tp, sum(n) OVER w AS called, sum(pos) OVER () AS n_pos
  FROM steps WINDOW w AS (ORDER BY s DESC)),
best AS (SELECT s FROM totals ORDER BY 2 * tp / (called + n_pos) DESC, s DESC LIMIT 1)"""

_BOARD = (
    "CAST(rank AS INTEGER) AS rank, 'done' AS status, true AS good, true AS in_order, true AS in_bounds, "
    "CAST(count(*) OVER () AS INTEGER) AS candidates"
)

# The curve of naive Bayes on the rows it learned from and on the others: totals at and above each score.
CURVE = (
    naive_bayes(FIT_INSIDE, "SELECT 0 AS g, * FROM prepared"),
    """
points AS (
  SELECT CASE WHEN i.o_orderkey IS NULL THEN 'holdout' ELSE 'train' END AS part, round(p1, 12) AS s,
         count(*) FILTER (nb.label = 1) AS pos, count(*) FILTER (nb.label = 0) AS neg
  FROM nb LEFT JOIN inside i ON i.o_orderkey = nb.o_orderkey GROUP BY ALL),
curve AS MATERIALIZED (
  SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER p AS n_pos, sum(neg) OVER p AS n_neg
  FROM points WINDOW w AS (PARTITION BY part ORDER BY s DESC), p AS (PARTITION BY part)),
cells AS (
  SELECT part, s, tp::DOUBLE AS tp, fp::DOUBLE AS fp, (n_pos - tp)::DOUBLE AS fn, (n_neg - fp)::DOUBLE AS tn
  FROM curve)""",
)


def _f(beta: float) -> str:
    square = beta * beta
    return f"{1 + square} * tp / ({1 + square} * tp + {square} * fn + fp)"


_CRITERIA = {
    "f1": _f(1),
    "f2": _f(2),
    "f0point5": _f(0.5),
    "accuracy": "(tp + tn) / (tp + fp + tn + fn)",
    "precision": "tp / (tp + fp)",
    "recall": "tp / (tp + fn)",
    "specificity": "tn / (tn + fp)",
    "absolute_mcc": "CASE WHEN tn + fn > 0 THEN "
    "abs((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))) END",
    "min_per_class_accuracy": "least(tp / (tp + fn), tn / (tn + fp))",
    "mean_per_class_accuracy": "(tp / (tp + fn) + tn / (tn + fp)) / 2",
}

ORACLES: dict[str, str] = {
    "read_delimited": ORDERS_TEXT,
    "read_delimited_header": ORDERS_TEXT,
    "scores_round_trip": with_profile(NB_ROWS, NB),
    "model_round_trip": with_profile(NB_ROWS, NB),
    "leader_round_trip": with_profile(NB_ROWS, NB),
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "binary_label": """
        SELECT o_orderkey, o_orderpriority,
               CASE WHEN contains(o_orderpriority, 'URGENT') THEN 1 ELSE 0 END AS label
        FROM orders""",
    "replace_sentinel": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END
               AS o_orderstatus, o_orderpriority
        FROM orders""",
    "projection": "SELECT l_orderkey, l_returnflag, l_quantity FROM lineitem",
    "feature_columns": with_profile(
        """
        SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_orderpriority', 'c_mktsegment',
                       'n_lines', 'sum_qty']) AS feature,
               unnest([count(o_orderkey), count(o_orderstatus), count(o_orderpriority),
                       count(c_mktsegment), count(n_lines), count(sum_qty)]) AS filled
        FROM prepared"""
    ),
    "as_category": with_profile(
        """
        SELECT o_orderkey, CAST(n_lines AS VARCHAR) AS n_lines,
               coalesce(idx, (SELECT any_value(width) FROM ranked)) AS n_lines_idx
        FROM prepared LEFT JOIN ranked ON CAST(n_lines AS VARCHAR) = v""",
        "texts AS (SELECT CAST(n_lines AS VARCHAR) AS t FROM prepared)",
        f"ranked AS ({_ranked('t', 'texts')})",
    ),
    "positive_probability": with_profile(
        "SELECT o_orderkey, round(CAST(CAST(p1 AS FLOAT) AS DOUBLE), 5) AS prob FROM nb", NB
    ),
    "predictions_with_inputs": with_profile(
        "SELECT outside.*, round(p1, 6) AS p1, prediction FROM outside JOIN nb USING (o_orderkey)",
        NB,
    ),
    "predictions_without_label": with_profile(
        "SELECT outside.* EXCLUDE (label), round(p1, 6) AS p1 "
        "FROM outside JOIN nb USING (o_orderkey)",
        NB,
    ),
    "prepare_table": with_profile("SELECT * FROM prepared"),
    "hash_split": with_profile(
        "SELECT o_orderkey, 'train' AS part FROM inside "
        "UNION ALL SELECT o_orderkey, 'validation' FROM outside"
    ),
    "stratified_split": with_profile(
        """
        SELECT o_orderkey, label,
               CASE WHEN row_number() OVER (PARTITION BY label ORDER BY h)
                         <= floor(0.6 * count(*) OVER (PARTITION BY label))
                    THEN 'first' ELSE 'rest' END AS part
        FROM hashed"""
    ),
    "assign_fold": with_profile(
        "SELECT o_orderkey, CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) % 5 AS INTEGER) AS fold "
        "FROM hashed"
    ),
    "sample_by": with_profile(
        "SELECT o_orderkey, label FROM hashed "
        "WHERE substr(h, 1, 8) < CASE WHEN label = 0 THEN '40000000' ELSE '80000000' END"
    ),
    "deal_split": """
        WITH kinds AS (
          SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS copies,
                 md5('{"c0":"' || l_returnflag || '","c1":"' || l_linestatus || '","c2":'
                     || l_linenumber || '}-42') AS h
          FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber),
        shares AS (
          SELECT *, CAST(floor(copies * 0.8::DOUBLE
                   + CAST('0x' || substr(h, 1, 8) AS BIGINT)::DOUBLE / 4294967296) AS BIGINT) AS n_inside
          FROM kinds)
        SELECT l_returnflag, l_linestatus, l_linenumber, CAST(0 AS INTEGER) AS part, n_inside AS n
        FROM shares WHERE n_inside > 0
        UNION ALL SELECT l_returnflag, l_linestatus, l_linenumber, 1, copies - n_inside
        FROM shares WHERE copies > n_inside""",
    "hash_split_n": with_profile(
        """
        SELECT o_orderkey, CASE WHEN substr(h, 1, 8) < '80000000' THEN 0
                                WHEN substr(h, 1, 8) < 'c0000000' THEN 1 ELSE 2 END AS part
        FROM hashed"""
    ),
    "split_sizes": with_profile(
        """
        SELECT (SELECT count(*) FROM prepared) AS n_all, (SELECT count(*) FROM inside) AS n_train,
               (SELECT count(*) FROM outside) AS n_validation"""
    ),
    "label_distribution": with_profile(
        'SELECT label, count(*) AS "count" FROM inside GROUP BY label'
    ),
    "frequency_table": 'SELECT event_type, count(*) AS "count" FROM events GROUP BY event_type',
    "schema_table": with_profile(
        """
        SELECT CAST(unnest([0, 1, 2, 3, 4, 5, 6]) AS INTEGER) AS position,
               unnest(['o_orderkey', 'o_orderstatus', 'o_orderpriority', 'c_mktsegment',
                       'n_lines', 'sum_qty', 'label']) AS "column",
               unnest(['bigint', 'string', 'string', 'string', 'int', 'double', 'int']) AS type,
               unnest([count(o_orderkey), count(o_orderstatus), count(o_orderpriority),
                       count(c_mktsegment), count(n_lines), count(sum_qty), count(label)]) AS filled
        FROM prepared"""
    ),
    "preview": with_profile("SELECT * FROM prepared ORDER BY o_orderkey LIMIT 10"),
    "describe_table": with_profile(
        "\nUNION ALL ".join(
            _describe(c, numeric)
            for c, numeric in (
                ("o_orderkey", True),
                ("o_orderstatus", False),
                ("o_orderpriority", False),
                ("c_mktsegment", False),
                ("n_lines", True),
                ("sum_qty", True),
                ("label", True),
            )
        )
    ),
    "summary_table": "\nUNION ALL ".join(
        _summary(c) for c in ("l_quantity", "l_extendedprice", "l_partkey")
    )
    + """
UNION ALL SELECT 'l_returnflag', count(l_returnflag), NULL, NULL, NULL, NULL, min(l_returnflag),
       max(l_returnflag), NULL, NULL, NULL FROM lineitem""",
    "merged_sketches": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, round(min({c})::DOUBLE, 4) AS min, "
        f"round(max({c})::DOUBLE, 4) AS max, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text, "
        f"true AS near FROM lineitem"
        for c in ("l_extendedprice", "l_discount", "l_partkey")
    )
    + """
UNION ALL SELECT 'l_returnflag', count(l_returnflag), NULL, NULL, NULL, NULL, min(l_returnflag),
       max(l_returnflag), NULL FROM lineitem""",
    "impute_mean": with_profile(
        "SELECT o_orderkey, CAST(lines_filled AS INTEGER) AS \"n_lines_IMPUTED\", "
        "round(qty_filled, 6) AS \"sum_qty_IMPUTED\" FROM filled",
        INDEXES,
    ),
    "index_categories": with_profile(
        """
        SELECT o_orderkey, s.idx AS o_orderstatus_idx, p.idx AS o_orderpriority_idx,
               m.idx AS c_mktsegment_idx
        FROM prepared JOIN o_orderstatus_index s ON s.v = o_orderstatus
        JOIN o_orderpriority_index p ON p.v = o_orderpriority
        JOIN c_mktsegment_index m ON m.v = c_mktsegment""",
        INDEXES,
    ),
    "one_hot": with_profile(
        "SELECT o_orderkey, idx AS slot, 1.0::DOUBLE AS value "
        "FROM prepared JOIN o_orderpriority_index ON v = o_orderpriority",
        INDEXES,
    ),
    "category_dictionary": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, "
        f"row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) - 1 AS \"index\" "
        f"FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("l_partkey", "l_returnflag", "l_linenumber")
    ),
    "dictionary_index": with_profile(
        "SELECT o_orderkey, "
        + ", ".join(
            f"coalesce((SELECT idx FROM {c}_seen WHERE v = CAST({c} AS VARCHAR)), "
            f"(SELECT count(*) FROM {c}_seen))::INTEGER AS {c}_idx"
            for c in (*CATEGORIES, "n_lines")
        )
        + " FROM prepared",
        *(
            f"{c}_text AS (SELECT CAST({c} AS VARCHAR) AS t FROM prepared WHERE label = 1),\n"
            f"{c}_seen AS ({_ranked('t', f'{c}_text')})"
            for c in (*CATEGORIES, "n_lines")
        ),
    ),
    "dictionary_one_hot": with_profile(
        """
        SELECT o_orderkey, idx AS slot, 1.0::DOUBLE AS value
        FROM prepared JOIN o_orderpriority_index ON v = o_orderpriority
        UNION ALL SELECT o_orderkey, priority + idx, 1.0
        FROM offset_of, prepared JOIN ranked ON v = CAST(n_lines AS VARCHAR)""",
        INDEXES,
        "texts AS (SELECT CAST(n_lines AS VARCHAR) AS t FROM prepared)",
        f"ranked AS ({_ranked('t', 'texts')})",
    ),
    "assemble": with_profile(
        "SELECT o_orderkey, 0 AS slot, round(qty_filled, 6) AS value FROM filled "
        "UNION ALL SELECT o_orderkey, 1, lines_filled FROM filled",
        INDEXES,
    ),
    "feature_frame": with_profile(
        """
        SELECT o_orderkey, idx AS slot, 1.0::DOUBLE AS value
        FROM prepared JOIN o_orderstatus_index ON v = o_orderstatus
        UNION ALL SELECT o_orderkey, status + idx, 1.0
        FROM offset_of, prepared JOIN o_orderpriority_index ON v = o_orderpriority
        UNION ALL SELECT o_orderkey, status + priority + idx, 1.0
        FROM offset_of, prepared JOIN c_mktsegment_index ON v = c_mktsegment
        UNION ALL SELECT o_orderkey, status + priority + segment, lines_filled
        FROM filled, offset_of
        UNION ALL SELECT o_orderkey, status + priority + segment + 1, round(qty_filled, 6)
        FROM filled, offset_of""",
        INDEXES,
    ),
    "feature_names": with_profile(
        """
        SELECT idx AS slot, 'o_orderstatus_vec_' || v AS feature FROM o_orderstatus_index
        UNION ALL SELECT status + idx, 'o_orderpriority_vec_' || v
        FROM o_orderpriority_index, offset_of
        UNION ALL SELECT status + priority + idx, 'c_mktsegment_vec_' || v
        FROM c_mktsegment_index, offset_of
        UNION ALL SELECT status + priority + segment, 'n_lines_IMPUTED' FROM offset_of
        UNION ALL SELECT status + priority + segment + 1, 'sum_qty_IMPUTED' FROM offset_of""",
        INDEXES,
    ),
    "decision_tree_stump": stump("leaf"),
    "random_forest_stump": stump("leaf"),
    "gbt_stump": stump("1 / (1 + exp(-2 * (2 * leaf - 1)))"),
    "gbt_two_rounds": with_profile(
        "SELECT o_orderkey, round(1 / (1 + exp(-2 * margin)), 6) AS p1, "
        "CASE WHEN margin > 0 THEN 1 ELSE 0 END AS prediction FROM margins",
        *TREE,
        SECOND_ROUND,
    ),
    "second_order_stump": _second_order_scores(1),
    "second_order_two_rounds": _second_order_scores(2),
    "second_order": with_profile(
        "SELECT o_orderkey, label, true AS score_is_sound, true AS class_agrees, true AS ranks_well FROM outside"
    ),
    "second_order_round_losses": with_profile(
        "\nUNION ALL ".join(
            f"SELECT {k} AS round, CASE WHEN held THEN 'validation' ELSE 'train' END AS part, "
            f"round(avg(ln(1 + exp(-(2 * label - 1) * margin))), 6) AS loss "
            f"FROM so{k} WHERE NOT is_out GROUP BY held"
            for k in (1, 2)
        ),
        second_order(2).format(held=_HELD),
    ),
    "gbt_round_losses": with_profile(
        """
        SELECT round, CASE WHEN held THEN 'validation' ELSE 'train' END AS part,
               round(avg(ln(1 + exp(-2 * (2 * label - 1) * margin))), 6) AS loss
        FROM (SELECT 2 AS round, o_orderkey, margin FROM margins
              UNION ALL
              SELECT 1, o_orderkey, 2 * CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END - 1
              FROM tree_rows t JOIN root USING (feature))
        JOIN marked USING (o_orderkey) GROUP BY round, held""",
        LEARNED,
        *VALIDATED_TREE,
        SECOND_ROUND,
    ),
    "search_with_early_stopping": """
        SELECT 0 AS candidate, 'gbt' AS algorithm, CAST(fold AS INTEGER) AS fold, true AS stopped
        FROM range(2) r(fold)""",
    "logistic_regression_totals": with_profile(
        "\nUNION ALL ".join(
            f"SELECT {c} AS category, count(*) AS n, round(avg(label), 4) AS positive_rate "
            f"FROM inside GROUP BY {c}"
            for c in CATEGORIES
        )
    ),
    "naive_bayes": with_profile(NB_ROWS, NB),
    "logistic_regression_groups": with_profile(
        "SELECT o_orderkey, round(rate, 5) AS p1 FROM band_rows JOIN band_rates USING (qty_band)",
        BANDED,
    ),
    "auto_search_naive_bayes": with_profile(
        f"""
        SELECT CAST(row_number() OVER (ORDER BY avg(auc) DESC) AS INTEGER) AS rank,
               'naive_bayes' AS algorithm,
               CASE WHEN lam = 1 THEN '' ELSE 'smoothing=' || lam::DOUBLE END AS params,
               round(avg(auc), 6) AS auc
        FROM aucs JOIN {SEARCHED} ON candidate = g // 10 GROUP BY lam""",
        candidate_folds(SEARCHED),
        auc("nb", "g"),
    ),
    "cross_validate": with_profile(
        "SELECT 0 AS candidate, CAST(g AS INTEGER) AS fold, 'areaUnderROC' AS metric, "
        "round(auc, 6) AS value FROM aucs",
        NB_FOLDS,
        auc("nb", "g"),
    ),
    "best_params": with_profile(
        "SELECT 'smoothing' AS name, lam AS value FROM named WHERE rank = 1", *SEARCH
    ),
    "cv_summary": with_profile(
        "SELECT candidate, algorithm, params, round(mean_auc, 6) AS mean_auc, "
        "round(stddev_auc, 6) AS stddev_auc FROM named",
        *SEARCH,
    ),
    "leaderboard": with_profile(
        "SELECT rank, candidate, algorithm, params, round(mean_auc, 6) AS auc, round(loss, 6) AS log_loss, "
        "round(error, 6) AS mean_per_class_error, 'done' AS status FROM named JOIN quality USING (candidate)",
        *SEARCH,
        f"""
quality AS (
  SELECT CAST(g // 10 AS INTEGER) AS candidate, avg(e) AS error, avg(l) AS loss
  FROM (SELECT g, {ERRORS} AS e, {LOSS} AS l FROM nb GROUP BY g) GROUP BY g // 10)""",
    ),
    "search_with_a_limit": with_profile(
        """
        SELECT 1 AS rank, 0 AS candidate, 'naive_bayes' AS algorithm, 'done' AS status,
               round(avg(auc), 6) AS auc FROM aucs
        UNION ALL SELECT NULL, 1, 'gbt', 'cancelled', NULL""",
        NB_FOLDS,
        auc("nb", "g"),
    ),
    "leader_params": with_profile(
        """
        SELECT * FROM (VALUES
          ('featuresCol', 'features'), ('labelCol', 'label'), ('modelType', 'multinomial'),
          ('predictionCol', 'prediction'), ('probabilityCol', 'probability'),
          ('rawPredictionCol', 'rawPrediction')) p(name, value)
        UNION ALL SELECT 'smoothing', CAST(lam AS VARCHAR) FROM named WHERE rank = 1""",
        *SEARCH,
    ),
    "oof_predictions": with_profile(
        "SELECT o_orderkey, CAST(g AS INTEGER) AS fold, label, round(p1, 6) AS p1 FROM nb",
        NB_FOLDS,
    ),
    "compare_naive_bayes": with_profile(
        f"""
        SELECT 'naive_bayes' AS algorithm, part, round(any_value(auc), 6) AS auc,
               round({ACCURACY}, 6) AS accuracy, round({ERRORS}, 6) AS mean_per_class_error
        FROM judged JOIN aucs USING (part) GROUP BY part""",
        naive_bayes(
            "SELECT 0 AS g, hashed.* EXCLUDE (h) FROM hashed WHERE substr(h, 1, 8) < '80000000'",
            "SELECT 0 AS g, hashed.* EXCLUDE (h) FROM hashed WHERE substr(h, 1, 8) >= '80000000'",
        ),
        """
judged AS (
  SELECT nb.*, CASE WHEN substr(h, 1, 8) < 'c0000000' THEN 'validation' ELSE 'test' END AS part
  FROM nb JOIN hashed USING (o_orderkey))""",
        auc("judged", "part"),
    ),
    "score": with_profile(NB_ROWS, NB_INSIDE),
    "area_under_roc": with_profile(
        "SELECT round(auc, 6) AS auc FROM aucs", NB, auc("nb", "g")
    ),
    "area_by_group": with_profile(
        "SELECT o_orderpriority, round(auc, 6) AS auc FROM aucs",
        NB,
        "judged AS (SELECT nb.*, o_orderpriority FROM nb JOIN outside USING (o_orderkey))",
        auc("judged", "o_orderpriority"),
    ),
    "log_loss": with_profile(f"SELECT round({LOSS}, 6) AS log_loss FROM nb", NB),
    "mean_per_class_error": with_profile(
        f"SELECT round({ERRORS}, 6) AS mean_per_class_error FROM nb", NB
    ),
    "confusion_matrix": with_profile(
        'SELECT label, prediction AS predicted, count(*) AS "count" FROM nb '
        "GROUP BY label, prediction",
        NB,
    ),
    "confusion_matrix_max_f1": with_profile(
        """
        SELECT label, CASE WHEN round(p1, 12) >= s THEN 1 ELSE 0 END AS predicted,
               count(*) AS "count"
        FROM nb, best GROUP BY ALL""",
        NB,
        BEST_F1,
    ),
    "score_table": with_profile(
        """
        SELECT o_orderkey, round(raw0, 6) AS raw0, round(raw1, 6) AS raw1,
               round(1 - p1, 6) AS p0, round(p1, 6) AS p1, prediction::DOUBLE AS prediction,
               round(CAST(CAST(p1 AS FLOAT) AS DOUBLE), 5) AS prob
        FROM nb""",
        NB,
    ),
    "class_table": with_profile(
        """
        SELECT prediction AS predict, round(1 - p1, 6) AS p0, round(p1, 6) AS p1, outside.*
        FROM outside JOIN nb USING (o_orderkey)""",
        NB,
    ),
    "performance_bundle": with_profile(
        f"SELECT part, {PERFORMANCE}, round(any_value(auc), 6) AS auc "
        "FROM judged JOIN aucs USING (part) GROUP BY part",
        naive_bayes(
            "SELECT k AS g, folded.* EXCLUDE (fold) FROM folded, range(6) r(k) WHERE fold <> k",
            "SELECT fold AS g, folded.* EXCLUDE (fold) FROM folded "
            "UNION ALL SELECT 5, * FROM prepared",
        ),
        """
judged AS (
  SELECT nb.*, CASE WHEN g < 5 THEN 'cv' WHEN i.o_orderkey IS NULL THEN 'holdout'
                    ELSE 'train' END AS part
  FROM nb LEFT JOIN inside i ON i.o_orderkey = nb.o_orderkey)""",
        auc("judged", "part"),
    ),
    "ranking_areas": with_profile(
        """
        SELECT part,
               round(sum(neg * (tp - pos + pos / 2)) / any_value(n_pos::DOUBLE * n_neg), 6) AS auc,
               round(sum(pos * tp / (tp + fp)) / any_value(n_pos), 6) AS auc_pr
        FROM curve GROUP BY part""",
        *CURVE,
    ),
    "best_thresholds": with_profile(
        "\nUNION ALL ".join(
            f"SELECT part, '{name}' AS criterion, round(s, 6) AS threshold, round(v, 6) AS value "
            f"FROM (SELECT part, s, {value} AS v FROM cells) WHERE v IS NOT NULL "
            "QUALIFY row_number() OVER (PARTITION BY part ORDER BY v DESC, s DESC) = 1"
            for name, value in _CRITERIA.items()
        ),
        *CURVE,
    ),
    "gains_lift": with_profile(
        """
        SELECT part, CAST(slice AS INTEGER) AS "group", n, round(low, 6) AS lower_threshold,
               round((tp + fp) / total, 6) AS cumulative_share,
               round(pos / n, 6) AS response_rate, round(pos / n / base, 6) AS lift,
               round(tp / (tp + fp), 6) AS cumulative_response_rate,
               round(tp / (tp + fp) / base, 6) AS cumulative_lift,
               round(pos / n_pos, 6) AS capture_rate, round(tp / n_pos, 6) AS cumulative_capture_rate,
               round(100 * (pos / n / base - 1), 6) AS gain,
               round(100 * (tp / (tp + fp) / base - 1), 6) AS cumulative_gain,
               round(tp / n_pos - fp / n_neg, 6) AS kolmogorov_smirnov
        FROM (
          SELECT part, floor((tp + fp - pos - neg) * 16 / (n_pos + n_neg)) + 1 AS slice, min(s) AS low,
                 sum(pos) AS pos, sum(neg) AS neg, max(tp) AS tp, max(fp) AS fp,
                 any_value(n_pos) AS n_pos, any_value(n_neg) AS n_neg,
                 (sum(pos) + sum(neg))::BIGINT AS n, any_value(n_pos + n_neg) AS total,
                 any_value(n_pos / (n_pos + n_neg)) AS base
          FROM curve GROUP BY part, slice)""",
        *CURVE,
    ),
    "cv_metrics_summary": with_profile(
        """
        SELECT metric, fold, round(value, 6) AS value,
               round(avg(value) OVER (PARTITION BY metric), 6) AS mean,
               round(stddev_samp(value) OVER (PARTITION BY metric), 6) AS stddev
        FROM long""",
        NB_FOLDS,
        auc("nb", "g"),
        f"""
per_fold AS (
  SELECT CAST(g AS INTEGER) AS fold, any_value(auc) AS auc, {ACCURACY} AS accuracy,
         {ERRORS} AS mean_per_class_error, {LOSS} AS log_loss
  FROM nb JOIN aucs USING (g) GROUP BY g),
long AS (
  UNPIVOT per_fold ON auc, accuracy, mean_per_class_error, log_loss
  INTO NAME metric VALUE value)""",
    ),
    "feature_importance": with_profile(
        "SELECT name, round(score, 6) AS score FROM importance", *IMPORTANCE
    ),
    "variable_importance": with_profile(
        """
        SELECT name AS variable, round(score, 6) AS relative_importance,
               round(score / (SELECT max(score) FROM importance), 6) AS scaled_importance,
               round(score / (SELECT sum(score) FROM importance), 6) AS percentage
        FROM importance""",
        *IMPORTANCE,
    ),
    "linear_contributions": with_profile(
        "SELECT o_orderkey, feature, round(contribution, 6) AS contribution FROM contrib",
        NB,
        CONTRIBUTIONS,
    ),
    "logistic_contributions": with_profile(
        """
        SELECT o_orderkey, 'qty_band' AS feature,
               round(ln(rate / (1 - rate))
                     - (SELECT sum(share * ln(rate / (1 - rate))) FROM band_rates), 4)
               AS contribution
        FROM band_rows JOIN band_rates USING (qty_band)""",
        BANDED,
    ),
    "tree_contributions": with_profile(
        """
        SELECT o_orderkey, f.feature,
               CASE WHEN f.feature || '_IMPUTED' = root.feature
                    THEN round(CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END
                         - CASE WHEN m_lines <= threshold THEN left_rate ELSE right_rate END, 6)
                    ELSE 0 END AS contribution
        FROM tree_rows t JOIN root USING (feature) CROSS JOIN line_mean
        CROSS JOIN (VALUES ('o_orderstatus'), ('o_orderpriority'), ('c_mktsegment'), ('n_lines'))
                   f(feature)""",
        *TREE,
    ),
    "path_contributions": with_profile(
        f"""
        SELECT o_orderkey, f.feature,
               CASE WHEN f.feature = {_source('root.feature')}
                    THEN round(CASE WHEN t.value <= threshold THEN left_rate ELSE right_rate END - rate, 6)
                    ELSE 0 END AS contribution
        FROM tree_rows t JOIN root USING (feature) CROSS JOIN {_SOURCES}
        UNION ALL SELECT o_orderkey, 'BiasTerm', round(rate, 6) FROM outside CROSS JOIN root""",
        *TREE,
    ),
    "boosted_path_contributions": with_profile(
        """
        SELECT o_orderkey, feature, round(contribution, 6) AS contribution FROM path_parts
        UNION ALL SELECT o_orderkey, 'BiasTerm', round(sum(mean), 6) FROM rounds GROUP BY o_orderkey""",
        *TREE,
        SECOND_ROUND,
        PATH_ROUNDS,
    ),
    "path_summary": with_profile(
        "SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs_contribution FROM path_parts "
        "GROUP BY feature",
        *TREE,
        SECOND_ROUND,
        PATH_ROUNDS,
    ),
    "path_additivity": with_profile(
        "SELECT o_orderkey, 6::BIGINT AS n, 0.0::DOUBLE AS gap FROM outside"
    ),
    "explain_row": with_profile(
        "SELECT o_orderkey, feature, round(contribution, 6) AS contribution FROM contrib "
        "WHERE o_orderkey = 7",
        NB_ALL,
        CONTRIBUTIONS,
    ),
    "contribution_summary": with_profile(
        "SELECT feature, round(avg(abs(contribution)), 6) AS mean_abs_contribution FROM contrib "
        "GROUP BY feature",
        NB,
        CONTRIBUTIONS,
    ),
    "train_job": with_profile(
        """
        SELECT 'train ' || label AS name, count(*)::DOUBLE AS value FROM inside GROUP BY label
        UNION ALL SELECT 'validation ' || label, count(*) FROM outside GROUP BY label
        UNION ALL SELECT 'auc', round(auc, 6) FROM aucs""",
        NB_TEXT,
        auc("nb", "g"),
    ),
    "tune_job_naive_bayes": with_profile(
        """
        SELECT round(judged.auc, 6) AS auc, round(mean_auc, 6) AS cv_auc, lam AS smoothing
        FROM named, judged WHERE rank = 1 AND judged.g = 100 + candidate""",
        naive_bayes(
            f"SELECT 10 * candidate + k AS g, folded.* EXCLUDE (fold) "
            f"FROM folded, range(5) r(k), {CANDIDATES} WHERE fold <> k "
            f"UNION ALL SELECT 100 + candidate, inside.* FROM inside, {CANDIDATES}",
            f"SELECT 10 * candidate + fold AS g, folded.* EXCLUDE (fold) FROM folded, {CANDIDATES} "
            f"UNION ALL SELECT 100 + candidate, outside.* FROM outside, {CANDIDATES}",
            f"SELECT 10 * candidate + k AS g, lam::DOUBLE AS lam FROM range(5) r(k), {CANDIDATES} "
            f"UNION ALL SELECT 100 + candidate, lam::DOUBLE FROM {CANDIDATES}",
            whole_lines=False,
        ),
        auc("nb", "g", "judged"),
        "aucs AS (SELECT * FROM judged WHERE g < 100)",
        CANDIDATE_TABLE,
    ),
    "automl_job_naive_bayes": with_profile(
        f"SELECT part, {PERFORMANCE}, round(any_value(auc), 6) AS auc "
        "FROM judged JOIN part_aucs USING (part) GROUP BY part",
        """
all_folds AS (
  SELECT * EXCLUDE (h), CAST(CAST('0x' || substr(h, 9, 8) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM hashed)""",
        # Of each candidate a model per fold, g = 10 * candidate + fold, and one of all rows.
        naive_bayes(
            f"SELECT 10 * candidate + k AS g, all_folds.* EXCLUDE (fold) "
            f"FROM all_folds, range(6) r(k), {SEARCHED} WHERE fold <> k",
            f"SELECT 10 * candidate + fold AS g, all_folds.* EXCLUDE (fold) FROM all_folds, {SEARCHED} "
            f"UNION ALL SELECT 10 * candidate + 5, prepared.* FROM prepared, {SEARCHED}",
            f"SELECT 10 * candidate + k AS g, lam::DOUBLE AS lam FROM range(6) r(k), {SEARCHED}",
            whole_lines=False,
        ),
        auc("nb", "g"),
        """
best AS (
  SELECT g // 10 AS candidate FROM aucs WHERE g % 10 < 5
  GROUP BY g // 10 ORDER BY avg(auc) DESC, g // 10 LIMIT 1),
judged AS (
  SELECT nb.*, CASE WHEN g % 10 < 5 THEN 'cv' ELSE 'train' END AS part
  FROM nb JOIN best ON g // 10 = candidate)""",
        auc("judged", "part", "part_aucs"),
    ),
    "automl_job": with_profile(
        """
        SELECT part, count(*) AS n, count(*) FILTER (label = 1) AS positives, true AS cells_add_up,
               true AS ranks_well, true AS loss_is_sound
        FROM prepared, (VALUES ('train'), ('cv')) p(part) GROUP BY part"""
    ),
    "job_parameters": with_profile(
        """
        SELECT name, value FROM (VALUES ('maxDepth', '4'), ('numTrees', '9'), ('seed', '7'),
                                        ('subsamplingRate', '0.75')) p(name, value)
        UNION ALL
        SELECT CASE WHEN substr(md5(concat(o_orderkey, '-', 7)), 1, 8) < '80000000' THEN 'train'
                    ELSE 'validation' END, CAST(count(*) AS VARCHAR)
        FROM prepared GROUP BY 1"""
    ),
    "score_new_files": with_profile(
        "SELECT o_orderkey, round(p1, 6) AS p1, prediction, count(*) OVER () AS rows_seen, 0::BIGINT AS idle_rows FROM nb",
        NB_ALL,
    ),
    "svm_calibration": with_profile(
        "SELECT count(*) AS n, round(avg(label), 4) AS positive_rate, round(avg(label), 4) AS mean_chance FROM inside"
    ),
    "predict_job_svm": with_profile(
        "SELECT o_orderkey, true AS in_bounds, true AS by_margin, true AS rises, true AS ranks_well FROM prepared"
    ),
    "predict_job_without_key": with_profile(
        "SELECT p.o_orderkey, o_orderstatus_raw AS o_orderstatus, p.o_orderpriority, p.c_mktsegment, "
        "p.n_lines, round(p.sum_qty, 6) AS sum_qty, round(p1, 6) AS p1 "
        "FROM prepared p JOIN nb USING (o_orderkey) "
        "JOIN (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE o_orderstatus END "
        "AS o_orderstatus_raw FROM profile) USING (o_orderkey)",
        NB_ALL,
    ),
    "predict_job": with_profile(NB_ROWS, NB_ALL),
    "train_and_score": with_profile(NB_ROWS, NB_TEXT_ALL),
    "random_split": with_profile(
        """
        SELECT count(DISTINCT o_orderkey) AS n, max(times)::BIGINT AS most_parts_of_a_row,
               true AS near_the_rate
        FROM (SELECT o_orderkey, count(*) AS times FROM prepared GROUP BY o_orderkey)"""
    ),
    **{
        algorithm: with_profile(
            "SELECT o_orderkey, label, true AS score_is_sound, true AS class_agrees, true AS ranks_well "
            "FROM outside"
        )
        for algorithm in (
            "random_forest", "gbt", "linear_svm", "logistic_regression", "decision_tree",
        )
    },
    "linear_svm_groups": with_profile(
        "SELECT o_orderkey, CASE WHEN rate > 0.5 THEN 1 ELSE 0 END AS prediction "
        "FROM band_rows JOIN band_rates USING (qty_band)",
        BANDED,
    ),
    "svm_area_under_roc": with_profile(
        "SELECT count(*) AS n, true AS areas_agree, true AS ranks_well FROM outside"
    ),
    "performance_at_max_f1": with_profile(
        """
        SELECT 'holdout' AS part, count(*) AS n,
               count(*) FILTER (label = 1 AND round(p1, 12) >= s) AS tp,
               count(*) FILTER (label = 1 AND round(p1, 12) < s) AS fn,
               count(*) FILTER (label = 0 AND round(p1, 12) >= s) AS fp,
               count(*) FILTER (label = 0 AND round(p1, 12) < s) AS tn,
               round(any_value(auc), 6) AS auc
        FROM nb, best, aucs""",
        NB,
        auc("nb", "g"),
        BEST_F1,
    ),
    "auto_search": f"SELECT {_BOARD} FROM range(1, 6) r(rank)",
    "tune_job": f"SELECT {_BOARD} FROM range(1, 10) r(rank)",
    "param_grid": """
        SELECT CAST(3 * d.i + t.i AS INTEGER) AS candidate, 'random_forest' AS algorithm,
               'maxDepth=' || d.v || ', numTrees=' || t.v AS params, true AS good, true AS folds_differ
        FROM (VALUES (0, 3), (1, 5), (2, 7)) d(i, v), (VALUES (0, 50), (1, 100), (2, 200)) t(i, v)""",
    "compare": """
        SELECT algorithm, part, true AS ranks_well, true AS classes_well
        FROM (VALUES ('random_forest'), ('gbt'), ('linear_svm'), ('logistic_regression'),
                     ('decision_tree'), ('naive_bayes')) a(algorithm),
             (VALUES ('validation'), ('test')) p(part)""",
    "forest_importance": with_profile(
        f"SELECT name, true AS sound, 1.0::DOUBLE AS total FROM ({_NAMES} UNION ALL SELECT 'sum_qty_IMPUTED')",
        *TREE,
    ),
    "boosted_contributions": with_profile(
        "SELECT o_orderkey, 5::BIGINT AS n, 0.0::DOUBLE AS gap FROM outside"
    ),
    "wide_contributions": with_profile(
        "SELECT o_orderkey, 8::BIGINT AS n, 0.0::DOUBLE AS gap FROM outside"
    ),
}
