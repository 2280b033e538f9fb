"""Models fitted on the tables. Training parts are chosen by key, seeds are fixed."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.models import bayes, clusters, factors, linear, logistic, metrics, recommend, splits, trees
from millrace.operators.features import assemble, index_category, key_split, scale
from millrace.operators.relational import one_per_key
from millrace.plans import text_classes
from millrace.queries.aggregates import rounded
from millrace.queries.scalars import _TOKENS
from millrace.queries.text import _STOP, STOP, labelled_texts
from millrace.registry import query
from millrace.workspace import materialize

SEED = 42
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# --- regression ----------------------------------------------------------------

@query(
    "linear_fit",
    """SELECT 'l_quantity' AS term, round(regr_slope(l_extendedprice, l_quantity), 4) AS value FROM lineitem
       UNION ALL SELECT 'intercept', round(regr_intercept(l_extendedprice, l_quantity), 4) FROM lineitem""",
)
def linear_fit(t):
    model = linear.fit_linear(t.lineitem, ["l_quantity"], "l_extendedprice")
    return rounded(linear.coefficients(t.lineitem, model, ["l_quantity"]), 4)


_TWO = """SELECT sum(x * x) AS xx, sum(z * z) AS zz, sum(x * z) AS xz, sum(x * y) AS xy, sum(z * y) AS zy FROM
            (SELECT l_quantity - avg(l_quantity) OVER () AS x, f - avg(f) OVER () AS z,
                    l_extendedprice - avg(l_extendedprice) OVER () AS y
             FROM (SELECT l_quantity, l_extendedprice, CAST(l_returnflag = (SELECT l_returnflag FROM lineitem GROUP BY 1
                     ORDER BY count(*) DESC, 1 LIMIT 1) AS INTEGER) AS f FROM lineitem))"""


@query(
    "linear_fit_indexed",
    f"""SELECT unnest(['l_quantity', 'flag']) AS term,
               unnest([round((zz * xy - xz * zy) / (xx * zz - xz * xz), 4), round((xx * zy - xz * xy) / (xx * zz - xz * xz), 4)]) AS value
        FROM ({_TWO})""",
)
def linear_fit_indexed(t):
    """Two features, one of them the most frequent value of an indexed category."""
    lines = index_category(t.lineitem.select("l_quantity", "l_extendedprice", "l_returnflag"), "l_returnflag", "index")
    lines = lines.withColumn("flag", (F.col("index") == 0).cast("double"))
    model = linear.fit_linear(lines, ["l_quantity", "flag"], "l_extendedprice")
    return rounded(linear.coefficients(lines, model, ["l_quantity", "flag"]).filter("term != 'intercept'"), 4)


_TRAINED = """line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
              FROM lineitem WHERE l_orderkey % 10 < 7),
              scored AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS y, a * l_quantity + b AS p
                         FROM lineitem, line WHERE l_orderkey % 10 >= 7)"""


def _held_out(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    train, test = key_split(lines, "l_orderkey")
    return linear.score(test, linear.fit_linear(train, ["l_quantity"], "l_extendedprice"), ["l_quantity"])


@query(
    "regression_metrics",
    f"""WITH {_TRAINED}
        SELECT round(avg((y - p) ** 2), 2) AS mse, round(sqrt(avg((y - p) ** 2)), 4) AS rmse, round(avg(abs(y - p)), 4) AS mae,
               round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM scored""",
)
def regression_metrics(t):
    return metrics.regression_metrics(_held_out(t), "l_extendedprice", "prediction").select(
        F.round("mse", 2).alias("mse"), F.round("rmse", 4).alias("rmse"),
        F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"),
    )


@query(
    "score_linear",
    f"WITH {_TRAINED} SELECT l_orderkey, l_linenumber, round(p, 4) AS prediction, round(y - p, 4) AS residual FROM scored",
)
def score_linear(t):
    scored = linear.residuals(_held_out(t), "l_extendedprice")
    return rounded(scored.select("l_orderkey", "l_linenumber", "prediction", "residual"), 4)


# --- classification --------------------------------------------------------------

def _lines(t):
    """Lines with a 0/1 label: whether the price of a piece is above 1,500."""
    label = F.when(F.col("l_extendedprice") > F.col("l_quantity") * 1500, 1.0).otherwise(0.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", *LINE, label.alias("label"))


def _status(t):
    """Lines with a 0/1 label: whether the line is still open."""
    label = F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", *LINE, label.alias("label"))


@query("logistic_scores")
def logistic_scores(t):
    train, test = key_split(_status(t), "l_orderkey")
    scored = linear.probabilities(linear.score(test, linear.fit_logistic(train, LINE, "label"), LINE))
    return scored.select("l_orderkey", "l_linenumber", "label", "prediction", "p1")


def _balance(train, model):
    """Sum of labels and of predicted probabilities over the training rows (equal at the optimum), and rows."""
    scored = linear.probabilities(linear.score(train, model, LINE))
    return scored.agg(
        F.round(F.sum("label"), 0).alias("labels"), F.round(F.sum("p1"), 0).alias("predicted"), F.count("prediction").alias("scored")
    )


@query(
    "logistic_balance",
    """SELECT round(CAST(count(*) FILTER (l_linestatus = 'O') AS DOUBLE), 0) AS labels,
              round(CAST(count(*) FILTER (l_linestatus = 'O') AS DOUBLE), 0) AS predicted, count(*) AS scored
       FROM lineitem WHERE l_orderkey % 10 < 7""",
)
def logistic_balance(t):
    """First-order condition of the fit: predicted probabilities add up to the labels."""
    train, _ = key_split(_status(t), "l_orderkey")
    return _balance(train, linear.fit_logistic(train, LINE, "label"))


_OPEN = "SELECT *, CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0 END AS y FROM lineitem WHERE l_orderkey % 10 < 7"


@query(
    "logistic_equations",
    " UNION ALL ".join(
        f"SELECT '{term}' AS term, round(sum(y * {column}), 2) AS observed, round(sum(y * {column}), 2) AS predicted FROM ({_OPEN})"
        for term, column in [("intercept", "1.0"), *[(c, c) for c in LINE]]
    ),
)
def logistic_equations(t):
    """Score equations of the fit: every feature sums up alike over the labels and over the probabilities."""
    train, _ = key_split(_status(t), "l_orderkey")
    return rounded(logistic.score_equations(train, logistic.fit_newton(train, LINE, "label"), "label"), 2)


@query(
    "logistic_first_step",
    f"""SELECT unnest(['intercept', 'l_quantity']) AS term,
               unnest([round(4 * regr_intercept(y - 0.5, l_quantity), 8), round(4 * regr_slope(y - 0.5, l_quantity), 8)]) AS coefficient FROM ({_OPEN})""",
)
def logistic_first_step(t):
    """The first Newton step from zero: least squares of the label less one half, times four."""
    train, _ = key_split(_status(t), "l_orderkey")
    fit = logistic.fit_newton(train, ["l_quantity"], "label", most=1)
    return logistic.summary(train, fit).select("term", F.round("coefficient", 8).alias("coefficient"))


@query("logistic_summary")
def logistic_summary(t):
    """Coefficient, standard error and z of each term."""
    train, _ = key_split(_status(t), "l_orderkey")
    return logistic.summary(train, logistic.fit_newton(train, LINE, "label"))


@query(
    "logistic_training_scores",
    """SELECT CAST(l_shipdate >= TIMESTAMP '1998-01-01' AS INTEGER)::DOUBLE AS late, count(*) AS rows,
              round(avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END), 6) AS observed, round(avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END), 6) AS predicted
       FROM lineitem WHERE l_orderkey % 10 < 7 GROUP BY 1""",
)
def logistic_training_scores(t):
    """Predictions on the training rows, by the one feature of the fit: with a 0/1 feature they are the shares of its groups."""
    late = (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).cast("double")
    lines = t.lineitem.select("l_orderkey", late.alias("late"), F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("label"))
    train, _ = key_split(lines, "l_orderkey")
    scored = logistic.score(train, logistic.fit_newton(train, ["late"], "label"))
    return scored.groupBy("late").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("label"), 6).alias("observed"), F.round(F.avg("p1"), 6).alias("predicted")
    )


@query(
    "tree_balance",
    """SELECT round(CAST(count(*) FILTER (l_extendedprice > l_quantity * 1500) AS DOUBLE), 0) AS labels,
              round(CAST(count(*) FILTER (l_extendedprice > l_quantity * 1500) AS DOUBLE), 0) AS predicted, count(*) AS scored
       FROM lineitem WHERE l_orderkey % 10 < 7""",
)
def tree_balance(t):
    """The leaves of a tree hold shares of its training rows, so they add up to the labels."""
    train, _ = key_split(_lines(t), "l_orderkey")
    return _balance(train, trees.fit_tree(train, LINE, "label", seed=SEED))


_SCORED_SQL = """SELECT l_orderkey, l_linenumber, CASE WHEN l_extendedprice > l_quantity * 1500 THEN 1.0::DOUBLE ELSE 0.0 END AS label,
                        true AS valid FROM lineitem WHERE l_orderkey % 10 >= 7"""


def _valid(scored):
    """Whether a row has a class and a probability on the class's side."""
    side = (F.col("p1") >= 0.5).cast("double") == F.col("prediction")
    return scored.select("l_orderkey", "l_linenumber", "label", (side & F.col("p1").between(0, 1)).alias("valid"))


@query("forest_rows", _SCORED_SQL)
def forest_rows(t):
    """Every held-out row is scored, and its class is the more probable one."""
    return _valid(_tree_scores(t, trees.fit_forest))


@query("gbt_rows", _SCORED_SQL)
def gbt_rows(t):
    return _valid(_tree_scores(t, trees.fit_gbt, maxIter=10))


@query(
    "auc_hard",
    """SELECT round((avg(CASE WHEN quality = 1 THEN toxic END) + avg(CASE WHEN quality = 0 THEN 1 - toxic END)) / 2, 6) AS auc
       FROM labels""",
)
def auc_hard(t):
    """The toxic flag read as a prediction of the quality flag."""
    return rounded(metrics.auc_hard(t.labels, "quality", "toxic"))


@query(
    "auc_scored",
    """SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM
         (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS below FROM
            (SELECT l_quantity, count(*) FILTER (l_extendedprice > l_quantity * 1500)::DOUBLE AS pos,
                    count(*) FILTER (l_extendedprice <= l_quantity * 1500)::DOUBLE AS neg
             FROM lineitem GROUP BY l_quantity))""",
)
def auc_scored(t):
    """Exact area under ROC of a real-valued score."""
    return rounded(metrics.auc(_lines(t), "label", "l_quantity"))


@query("accuracy", "SELECT round(avg(CAST(quality = toxic AS INTEGER)), 6) AS accuracy FROM labels")
def accuracy(t):
    return rounded(metrics.classification_metrics(t.labels, "quality", "toxic").select("accuracy"))


@query(
    "confusion_matrix",
    "SELECT quality AS label, toxic AS prediction, count(*) AS count FROM labels GROUP BY quality, toxic",
)
def confusion_matrix(t):
    return metrics.confusion_matrix(t.labels, "quality", "toxic")


def _tree_scores(t, fit, **params):
    train, test = key_split(_lines(t), "l_orderkey")
    model = fit(train, LINE, "label", seed=SEED, **params)
    return linear.probabilities(linear.score(test, model, LINE)).select(
        "l_orderkey", "l_linenumber", "label", "prediction", "p1"
    )


@query("tree_scores")
def tree_scores(t):
    return _tree_scores(t, trees.fit_tree)


@query("forest_scores")
def forest_scores(t):
    return _tree_scores(t, trees.fit_forest)


@query("gbt_scores")
def gbt_scores(t):
    return _tree_scores(t, trees.fit_gbt, maxIter=10)


@query("feature_importance")
def feature_importance(t):
    lines = _lines(t)
    return trees.importances(lines, trees.fit_forest(lines, LINE, "label", seed=SEED), LINE)


@query("compare_models")
def compare_models(t):
    train, test = key_split(_lines(t), "l_orderkey")
    return trees.compare_models(train, test, LINE, "label", seed=SEED)


# Trees by histograms, over columns of few values, so that every threshold is a midpoint of neighbours.
BINNED = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def _binned(t):
    """Lines with a 0/1 label: whether they are open and dear."""
    label = F.when((F.col("l_linestatus") == "O") & (F.col("l_extendedprice") > 30000), 1.0).otherwise(0.0)
    return t.lineitem.select("l_orderkey", "l_linenumber", *BINNED[:3], label.alias("label"))


_BINNED = """(SELECT *, CASE WHEN l_linestatus = 'O' AND l_extendedprice > 30000 THEN 1.0::DOUBLE ELSE 0.0 END AS label FROM lineitem)"""
_GINI = "2 * ({s} / {n}) * (1 - {s} / {n})"
_VARIANCE = "({q} / {n} - ({s} / {n}) * ({s} / {n}))"


def _gains_sql(rows: str, impurity: str = _GINI, columns=BINNED) -> str:
    """Every split of every node of ``rows`` (node, y, w, columns) at the midpoints of the whole table's values."""
    cells = " UNION ALL ".join(f"SELECT node, {i} AS place, '{c}' AS feature, {c}::DOUBLE AS x, y, w FROM {rows}" for i, c in enumerate(columns))
    values = " UNION ALL ".join(f"SELECT {i} AS place, {c}::DOUBLE AS x, (x + lead(x) OVER (ORDER BY x)) / 2 AS threshold FROM (SELECT DISTINCT {c} FROM lineitem)" for i, c in enumerate(columns))
    left, right = impurity.format(n="n_left", s="s_left", q="q_left"), impurity.format(n="(n - n_left)", s="(s - s_left)", q="(q - q_left)")
    return f"""SELECT *, {impurity.format(n="n", s="s", q="q")} - n_left / n * {left} - (n - n_left) / n * {right} AS gain FROM
        (SELECT node, place, feature, threshold, sum(n) OVER a AS n, sum(s) OVER a AS s, sum(q) OVER a AS q, sum(n) OVER b AS n_left, sum(s) OVER b AS s_left, sum(q) OVER b AS q_left
         FROM (SELECT node, place, feature, x, sum(w)::DOUBLE AS n, sum(w * y) AS s, sum(w * y * y) AS q FROM ({cells}) WHERE w > 0 GROUP BY ALL) JOIN ({values}) USING (place, x)
         WINDOW a AS (PARTITION BY node, place), b AS (PARTITION BY node, place ORDER BY x ROWS UNBOUNDED PRECEDING))
        WHERE n_left < n AND threshold IS NOT NULL"""


def _best_sql(gains: str) -> str:
    return f"SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, threshold) AS r FROM {gains}) WHERE r = 1"


_AT = "(CASE {f} " + " ".join(f"WHEN '{c}' THEN {c}" for c in BINNED) + " END)"  # the value of a named feature

_DEPTH2 = f"""WITH root_rows AS (SELECT *, 1 AS node, label AS y, 1 AS w FROM {_BINNED}), root_gains AS ({_gains_sql("root_rows")}), root AS ({_best_sql("root_gains")}),
       child_rows AS (SELECT t.* EXCLUDE (node), CASE WHEN {_AT.format(f="feature")} <= threshold THEN 2 ELSE 3 END AS node
                      FROM root_rows t CROSS JOIN (SELECT feature, threshold FROM root)),
       child_gains AS ({_gains_sql("child_rows")}), child AS ({_best_sql("child_gains")}),
       nodes AS (SELECT node AS id, feature, threshold, gain, n, s / n AS mean FROM root UNION ALL SELECT node, feature, threshold, gain, n, s / n FROM child
                 UNION ALL SELECT 2 * node, NULL, NULL, NULL, n_left, s_left / n_left FROM child
                 UNION ALL SELECT 2 * node + 1, NULL, NULL, NULL, n - n_left, (s - s_left) / (n - n_left) FROM child)"""


@query(
    "tree_splits",
    f"""WITH t AS (SELECT *, 1 AS node, label AS y, 1 AS w FROM {_BINNED})
        SELECT feature, round(threshold, 6) AS threshold, n_left, round(gain, 9) AS gain FROM ({_gains_sql("t")})""",
)
def tree_splits(t):
    """The gain of every split of every feature, from one histogram of the table."""
    lines = _binned(t)
    points = splits.split_points(lines, BINNED, 64)
    gains = splits.split_gains(splits.histogram(lines, points, F.col("label")), points)
    return gains.select("feature", F.round("threshold", 6).alias("threshold"), "n_left", F.round("gain", 9).alias("gain"))


@query(
    "tree_first_split",
    f"""WITH t AS (SELECT *, 1 AS node, label AS y, 1 AS w FROM {_BINNED}), g AS ({_gains_sql("t")})
        SELECT feature, round(threshold, 6) AS threshold, round(gain, 9) AS gain, round(s_left / n_left, 9) AS left_mean, round((s - s_left) / (n - n_left), 9) AS right_mean
        FROM ({_best_sql("g")})""",
)
def tree_first_split(t):
    """The best first split."""
    lines = _binned(t)
    points = splits.split_points(lines, BINNED, 64)
    best = splits.best_splits(splits.split_gains(splits.histogram(lines, points, F.col("label")), points))
    right = (F.col("s") - F.col("s_left")) / (F.col("n") - F.col("n_left"))
    return best.select(
        "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 9).alias("gain"),
        F.round(F.col("s_left") / F.col("n_left"), 9).alias("left_mean"), F.round(right, 9).alias("right_mean"),
    )


def _grown(t, depth):
    lines = _binned(t)
    return splits.grow(lines, splits.split_points(lines, BINNED, 64), F.col("label"), depth=depth)


@query(
    "tree_nodes",
    f"{_DEPTH2} SELECT CAST(id AS BIGINT) AS id, feature, round(threshold, 6) AS threshold, round(gain, 9) AS gain, n, round(mean, 9) AS mean FROM nodes",
)
def tree_nodes(t):
    """All nodes of a tree of two levels."""
    nodes = _grown(t, 2).table(t.lineitem)
    return nodes.select("id", "feature", F.round("threshold", 6).alias("threshold"), F.round("gain", 9).alias("gain"), "n", F.round("mean", 9).alias("mean"))


@query(
    "tree_importance",
    f"""{_DEPTH2} SELECT feature, round(sum(gain * n) / (SELECT sum(gain * n) FROM nodes), 9) AS importance FROM nodes WHERE feature IS NOT NULL GROUP BY feature""",
)
def tree_importance(t):
    """Share of each feature in the gains of that tree, weighted by rows."""
    nodes = _grown(t, 2).table(t.lineitem).withColumn("tree", F.lit(0))
    return splits.importances(nodes).select("feature", F.round("importance", 9).alias("importance"))


@query(
    "importance_total",
    f"""{_DEPTH2} SELECT count(DISTINCT feature) AS features, round(sum(gain * n), 6) AS total FROM nodes""",
)
def importance_total(t):
    """How many features split that tree, and what all its splits gain."""
    nodes = _grown(t, 2).table(t.lineitem)
    return nodes.agg(F.count_distinct("feature").alias("features"), F.round(F.sum(F.col("gain") * F.col("n")), 6).alias("total"))


# Three stumps, each on its own columns and its own draw of the rows.
_MEMBERS = [(BINNED[:2], 2), (BINNED[2:], 3), (BINNED[1:3], 5)]


def _member_sql(i: int, columns: list[str], by: int) -> str:
    weight = f"((l_orderkey * {by} + l_linenumber) % 3)"
    return f"""t{i} AS (SELECT *, 1 AS node, label AS y, {weight} AS w FROM {_BINNED} WHERE l_orderkey % 10 < 7), g{i} AS ({_gains_sql(f"t{i}", columns=columns)}),
       b{i} AS (SELECT feature AS f{i}, threshold AS h{i}, s_left / n_left AS l{i}, (s - s_left) / (n - n_left) AS r{i} FROM ({_best_sql(f"g{i}")}))"""


@query(
    "forest_votes",
    f"""WITH {", ".join(_member_sql(i, c, by) for i, (c, by) in enumerate(_MEMBERS))}
        SELECT l_orderkey, l_linenumber, label, round((v0 + v1 + v2) / 3, 9) AS p1, CAST(v0 + v1 + v2 > 1.5 AS INTEGER)::DOUBLE AS prediction FROM
          (SELECT *, {", ".join(f"CASE WHEN {_AT.format(f=f'f{i}')} <= h{i} THEN l{i} ELSE r{i} END AS v{i}" for i in range(3))}
           FROM {_BINNED} CROSS JOIN b0 CROSS JOIN b1 CROSS JOIN b2 WHERE l_orderkey % 10 >= 7)""",
)
def forest_votes(t):
    """Held-out lines scored by a forest of given draws: the mean of the trees' leaf shares."""
    train, test = key_split(_binned(t), "l_orderkey")
    points = splits.split_points(_binned(t), BINNED, 64)
    members = [(columns, F.pmod(F.col("l_orderkey") * by + F.col("l_linenumber"), F.lit(3))) for columns, by in _MEMBERS]
    trees_ = splits.forest(train, points, F.col("label"), members, depth=1)
    scored = splits.predicted(test, trees_, BINNED, "p1")
    return scored.select("l_orderkey", "l_linenumber", "label", F.round("p1", 9).alias("p1"), (F.col("p1") > 0.5).cast("double").alias("prediction"))


_STUMP = "SELECT CASE WHEN {at} <= threshold THEN l ELSE r END AS m, t.* FROM {rows} t CROSS JOIN {stump}"


def _stump_sql(gains: str) -> str:
    return f"SELECT feature, threshold, gain, s_left / n_left AS l, (s - s_left) / (n - n_left) AS r FROM ({_best_sql(gains)})"


_BOOST = f"""WITH r0 AS (SELECT *, 1 AS node, 2 * label - 1 AS y, 1 AS w FROM {_BINNED}), g0 AS ({_gains_sql("r0", _VARIANCE)}), b0 AS ({_stump_sql("g0")}),
       r1 AS (SELECT t.* EXCLUDE (y, m), m AS margin, 4 * (2 * label - 1) / (1 + exp(2 * (2 * label - 1) * m)) AS y FROM ({_STUMP.format(at=_AT.format(f="feature"), rows="r0", stump="b0")}) t),
       g1 AS ({_gains_sql("r1", _VARIANCE)}), b1 AS ({_stump_sql("g1")}),
       r2 AS (SELECT t.* EXCLUDE (y, m, margin), margin + 0.1 * m AS margin FROM ({_STUMP.format(at=_AT.format(f="feature"), rows="r1", stump="b1")}) t)"""


@query(
    "boost_rounds",
    f"""{_BOOST} SELECT 0 AS round, feature, round(threshold, 6) AS threshold, round(gain, 9) AS gain, round(l, 9) AS left_value, round(r, 9) AS right_value FROM b0
        UNION ALL SELECT 1, feature, round(threshold, 6), round(gain, 9), round(l, 9), round(r, 9) FROM b1""",
)
def boost_rounds(t):
    """The stumps of two boosting rounds: the first fits the labels, the second what is left of them."""
    lines = _binned(t)
    model = splits.boost(lines, splits.split_points(lines, BINNED, 64), F.col("label"), rounds=2)
    nodes = [tree.table(lines).withColumn("round", F.lit(i)) for i, tree in enumerate(model.trees)]
    side = lambda i: F.max(F.when(F.col("id") == i, F.col("mean")))
    split = lambda c: F.max(F.when(F.col("id") == 1, F.col(c)))
    return nodes[0].unionAll(nodes[1]).groupBy("round").agg(
        split("feature").alias("feature"), F.round(split("threshold"), 6).alias("threshold"), F.round(split("gain"), 9).alias("gain"),
        F.round(side(2), 9).alias("left_value"), F.round(side(3), 9).alias("right_value"),
    )


@query(
    "boost_scores",
    f"{_BOOST} SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-2 * margin)), 9) AS p1 FROM r2",
)
def boost_scores(t):
    """Every line's probability after the two rounds."""
    lines = _binned(t)
    model = splits.boost(lines, splits.split_points(lines, BINNED, 64), F.col("label"), rounds=2)
    return lines.select("l_orderkey", "l_linenumber", F.round(model.probability(), 9).alias("p1"))


_RULES = {"price": "l_extendedprice > 40000", "quantity": "l_quantity > 25", "tax": "l_tax < 0.04"}
_CLASS = "CASE WHEN {x} THEN 1.0::DOUBLE ELSE 0.0 END"


def _compared_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{m}' AS model, {_CLASS.format(x='l_extendedprice > l_quantity * 1500')} AS label, {_CLASS.format(x=rule)} AS prediction FROM lineitem" for m, rule in _RULES.items()
    )
    return f"""WITH p AS ({long}),
        c AS (SELECT model, y, count(*) FILTER (label = y)::DOUBLE AS n, count(*) FILTER (prediction = y)::DOUBLE AS predicted, count(*) FILTER (label = y AND prediction = y)::DOUBLE AS hit
              FROM p CROSS JOIN (SELECT unnest([0.0::DOUBLE, 1.0]) AS y) GROUP BY model, y),
        m AS (SELECT *, coalesce(hit / nullif(predicted, 0), 0) AS precision, hit / n AS recall FROM c)
        SELECT model, CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS unscored, round(sum(hit) / sum(n), 6) AS accuracy, round(sum(precision * n) / sum(n), 6) AS precision,
               round(sum(recall * n) / sum(n), 6) AS recall, round(sum(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) * n) / sum(n), 6) AS f1
        FROM m GROUP BY model"""


@query("compare_predictions", _compared_sql())
def compare_predictions(t):
    """Three given rules side by side, from their stored predictions."""
    rules = [F.when(F.expr(rule), 1.0).otherwise(0.0).alias(m) for m, rule in _RULES.items()]
    stored = materialize(_lines(t).select("label", *rules), "predictions")
    return rounded(trees.compare_predictions(stored, list(_RULES)))


_BAYES = f"""WITH msg AS (SELECT doc_id, CASE WHEN quality = 1 THEN 1 ELSE 0 END AS label, text FROM documents JOIN labels USING (doc_id)),
       tokens AS (SELECT doc_id, unnest({_TOKENS}) AS term FROM msg),
       tf AS (SELECT doc_id, term, count(*) AS tf FROM tokens WHERE term NOT IN ({_STOP}) GROUP BY doc_id, term),
       train AS (SELECT * FROM msg WHERE doc_id % 10 < 7), test AS (SELECT * FROM msg WHERE doc_id % 10 >= 7),
       known AS (SELECT label, term, sum(tf)::DOUBLE AS weight FROM tf JOIN train USING (doc_id) GROUP BY label, term),
       mass AS (SELECT label, sum(weight) AS mass FROM known GROUP BY label),
       classes AS (SELECT label AS class, ln((count(*) + 1) / ((SELECT count(*) FROM train) + 2.0)) AS prior,
                          -ln(any_value(mass) + (SELECT count(DISTINCT term) FROM known)) AS rest
                   FROM train JOIN mass USING (label) GROUP BY label),
       used AS (SELECT doc_id, class, term, tf, rest FROM tf JOIN test USING (doc_id) CROSS JOIN classes
                WHERE term IN (SELECT term FROM known)),
       odds AS (SELECT doc_id, class, sum(tf * (rest + ln(coalesce(weight, 0) + 1))) AS likelihood
                FROM used LEFT JOIN known ON known.label = class AND known.term = used.term GROUP BY doc_id, class),
       wide AS (SELECT test.doc_id, label, c.class, prior + coalesce(likelihood, 0) AS s
                FROM test CROSS JOIN classes c LEFT JOIN odds o ON o.doc_id = test.doc_id AND o.class = c.class)"""


@query(
    "naive_bayes_scores",
    f"""{_BAYES} SELECT doc_id, label, CAST(arg_max(class, s) AS INTEGER) AS prediction, round(1 / sum(exp(s - top)), 4) AS probability
        FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM wide) GROUP BY doc_id, label""",
)
def naive_bayes_scores(t):
    """Quality of a text from the counts of its terms, whatever their number; the model sees the training texts only."""
    messages = labelled_texts(t).withColumn("label", F.when(F.col("class") == "good", 1).otherwise(0))
    train, test = key_split(messages, "doc_id")
    counts = text_classes.term_weights(messages, "doc_id", stop=STOP).select("doc_id", "term", F.col("tf").cast("double").alias("weight"))
    model = bayes.fit_terms(counts, train, "doc_id")
    found = bayes.classify(bayes.score_terms(model, counts.join(test.select("doc_id"), "doc_id", "left_semi"), test, "doc_id"), "doc_id")
    return test.select("doc_id", "label").join(found, "doc_id").withColumn("probability", F.round("probability", 4))


# --- clusters ----------------------------------------------------------------------

def _points(t):
    return clusters.array_features(t.embeddings, "embedding").select("vec_id", "label", "features")


@query("kmeans_assign")
def kmeans_assign(t):
    points = _points(t)
    model = clusters.fit_kmeans(points, "features", 3, seed=SEED)
    return clusters.assign(points, model).select("vec_id", F.col("prediction").alias("cluster"))


@query(
    "wssse_fixed_centers",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
            c AS (SELECT label, i, avg(v) AS m FROM x GROUP BY label, i)
       SELECT round(sum((v - m) ** 2), 4) AS cost FROM x JOIN c USING (label, i)""",
)
def wssse_fixed_centers(t):
    return rounded(clusters.wssse(_points(t), "features", "label"), 4)


def _sessions(t):
    """Lines as scaled feature vectors."""
    return scale(assemble(t.lineitem.select(*LINE), LINE)).select(F.col("scaled").alias("features"))


@query("kmeans_sweep")
def kmeans_sweep(t):
    return clusters.kmeans_sweep(_sessions(t), "features", range(2, 9), seed=SEED)


def _sweep_centres(k):
    """Given centres of lines: k points along the ranges of the four columns."""
    return [[50 * (i + 0.5) / k, 100000 * (i + 0.5) / k, 0.1 * (i + 0.5) / k, 0.08 * (k - i - 0.5) / k] for i in range(k)]


_SWEEP = f"""WITH x AS (SELECT row_number() OVER () AS id, {", ".join(f"{c}::DOUBLE AS x{i}" for i, c in enumerate(LINE))} FROM lineitem),
       c0 AS (SELECT * FROM (VALUES {", ".join(f"({k}, {i}, {', '.join(f'{v!r}::DOUBLE' for v in c)})" for k in range(2, 9) for i, c in enumerate(_sweep_centres(k)))}) v(k, centre, m0, m1, m2, m3)),
       d0 AS (SELECT k, centre, x.*, {" + ".join(f"(x{i} - m{i}) ** 2" for i in range(4))} AS apart FROM x CROSS JOIN c0),
       a0 AS (SELECT k, id, arg_min(centre, (apart, centre)) AS centre, min(apart) AS apart FROM d0 GROUP BY k, id),
       c1 AS (SELECT k, centre, {", ".join(f"coalesce(n{i}, m{i}) AS m{i}" for i in range(4))} FROM c0 LEFT JOIN
                (SELECT k, centre, {", ".join(f"avg(x{i}) AS n{i}" for i in range(4))} FROM a0 JOIN x USING (id) GROUP BY k, centre) USING (k, centre)),
       a1 AS (SELECT k, id, min({" + ".join(f"(x{i} - m{i}) ** 2" for i in range(4))}) AS apart FROM x CROSS JOIN c1 GROUP BY k, id)"""


@query(
    "kmeans_sweep_step",
    f"""{_SWEEP} SELECT k::INTEGER AS k, round(cost / 1e6, 3) AS cost, round(next_cost / 1e6, 3) AS next_cost
        FROM (SELECT k, sum(apart) AS cost FROM a0 GROUP BY k) JOIN (SELECT k, sum(apart) AS next_cost FROM a1 GROUP BY k) USING (k)""",
)
def kmeans_sweep_step(t):
    """Cost of given centres for k from 2 to 8, and after one step of each: two scans for all seven."""
    points = t.lineitem.select(F.array(*[F.col(c).cast("double") for c in LINE]).alias("point"))
    step = clusters.sweep_step(points, "point", {k: _sweep_centres(k) for k in range(2, 9)})
    return step.select("k", *[F.round(F.col(c) / 1e6, 3).alias(c) for c in ("cost", "next_cost")])


@query("cluster_sizes")
def cluster_sizes(t):
    points = _sessions(t)
    model = clusters.fit_kmeans(points, "features", 2, seed=SEED)
    return clusters.cluster_sizes(clusters.assign(points, model))


def _agreeing(points, model, *keep):
    """Points with the fitted cluster, and whether it is the nearest of the fitted centres."""
    centres = clusters.centers(points, model).select("cluster", F.col("center").alias("centre"))
    flat = clusters.assign(points, model).select(*keep, F.col("prediction").alias("fitted"), vector_to_array("features").alias("point"))
    return clusters.nearest(flat, centres, "point").withColumn("agrees", F.col("cluster") == F.col("fitted"))


@query("kmeans_rows", "SELECT vec_id, true AS assigned FROM embeddings")
def kmeans_rows(t):
    """Every point is in the cluster of the nearest of the fitted centres."""
    points = _points(t)
    model = clusters.fit_kmeans(points, "features", 3, seed=SEED)
    return _agreeing(points, model, "vec_id").select("vec_id", F.col("agrees").alias("assigned"))


@query("cluster_rows", "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS nearest, CAST(2 AS BIGINT) AS clusters FROM lineitem")
def cluster_rows(t):
    """The sizes of the clusters add up to the rows, each counted with the nearest of the fitted centres."""
    points = _sessions(t)
    model = clusters.fit_kmeans(points, "features", 2, seed=SEED)
    by_cluster = _agreeing(points, model).groupBy("fitted").agg(F.count(F.lit(1)).alias("count"), F.count_if("agrees").alias("agreeing"))
    return by_cluster.agg(F.sum("count").alias("rows"), F.sum("agreeing").alias("nearest"), F.count(F.lit(1)).alias("clusters"))


@query(
    "kmeans_step",
    """WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
            c AS (SELECT label AS cluster, i, avg(v) AS m FROM x GROUP BY label, i),
            d AS (SELECT vec_id, cluster, sum((v - m) ** 2) AS distance FROM x JOIN c USING (i) GROUP BY vec_id, cluster)
       SELECT vec_id, arg_min(cluster, distance) AS cluster, round(min(distance), 6) AS distance FROM d GROUP BY vec_id""",
)
def kmeans_step(t):
    """One assignment step from given centres: the means of the labelled groups."""
    points = t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("point"))
    found = clusters.nearest(points, clusters.means(points, "label", "point"), "point")
    return found.select("vec_id", "cluster", F.round("distance", 6).alias("distance"))


# --- recommendations -------------------------------------------------------------------

_RATINGS_SQL = "(SELECT l_suppkey AS user, l_partkey AS item, avg(l_quantity) AS rating FROM lineitem GROUP BY ALL)"
_HELD = "(user * 31 + item) % 10 >= 8"


def _ratings(t):
    """Mean quantities by supplier and part with 32-bit ids, stored once: several jobs read them."""
    return recommend.with_int_ids(_stored_ratings(t))


def _stored_ratings(t):
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity")
    return materialize(recommend.ratings_table(lines, F.col("l_suppkey"), F.col("l_partkey"), F.col("l_quantity")), "ratings")


def _als(t):
    table = _ratings(t)
    slot = F.pmod(F.col("user") * 31 + F.col("item"), F.lit(10))
    return recommend.predict(recommend.fit_als(table.filter(slot < 8), seed=SEED), table.filter(slot >= 8))


@query("als_predictions")
def als_predictions(t):
    return _als(t).select("user", "item", "rating", "prediction")


@query("als_rows", f"SELECT user, item, round(rating, 6) AS rating FROM {_RATINGS_SQL} WHERE {_HELD}")
def als_rows(t):
    """Every held-out pair stays, whether the fit has seen its user and item or not."""
    return _als(t).select("user", "item", F.round("rating", 6).alias("rating"))


@query("als_top3")
def als_top3(t):
    return recommend.recommend(_als(t).select("user", "item", "prediction"), 3)


@query(
    "als_top3_rows",
    f"SELECT user, least(count(*), 3) AS items FROM {_RATINGS_SQL} WHERE {_HELD} GROUP BY user",
)
def als_top3_rows(t):
    """Three items a user, or as many as there are."""
    return als_top3(t).groupBy("user").agg(F.count(F.lit(1)).alias("items"))


@query("als_user_list")
def als_user_list(t):
    """The ten best items of the whole catalogue for the supplier of the least key."""
    table = _ratings(t)
    model = recommend.fit_als(table, seed=SEED)
    user = table.orderBy("user").limit(1).select("user_id")
    listed = recommend.recommend_unseen(model, user, 10)
    items = table.select("item_id", "item").distinct()
    return listed.join(items, "item_id").select("item", "prediction")


@query("als_all_lists")
def als_all_lists(t):
    """The three best parts of the whole catalogue for every supplier, by the fitted factors."""
    model = recommend.fit_als(_ratings(t), seed=SEED)
    users = model.userFactors.select(F.col("id").alias("user"), F.col("features").alias("factors"))
    items = model.itemFactors.select(F.col("id").alias("item"), F.col("features").alias("factors"))
    return factors.top_items(users, items, 3)


def _given(table, key, output, *parts):
    """Factors of given numbers for every key of a table."""
    return table.select(F.col(key).alias(output), F.array(*[p.cast("double") for p in parts]).alias("factors"))


def _item_factors(t):
    item = F.col("p_partkey")
    return _given(t.part, "p_partkey", "item", 1 + F.pmod(item, F.lit(7)), F.pmod(item, F.lit(3)) - 1)


@query(
    "als_half_step",
    f"""WITH r AS (SELECT user, rating, 1.0::DOUBLE + item % 7 AS a, item % 3 - 1.0::DOUBLE AS b FROM {_RATINGS_SQL}),
            s AS (SELECT user, sum(a * a) + 0.1 * count(*) AS aa, sum(a * b) AS ab, sum(b * b) + 0.1 * count(*) AS bb,
                         sum(rating * a) AS ra, sum(rating * b) AS rb FROM r GROUP BY user)
       SELECT user, round((ra * bb - rb * ab) / (aa * bb - ab * ab), 6) AS first, round((rb * aa - ra * ab) / (aa * bb - ab * ab), 6) AS second FROM s""",
)
def als_half_step(t):
    """Best factors of every supplier for given factors of the parts."""
    users = factors.half_step(_stored_ratings(t), _item_factors(t), on="item", solve="user", rank=2, reg=0.1)
    return users.select("user", F.round(F.col("factors")[0], 6).alias("first"), F.round(F.col("factors")[1], 6).alias("second"))


_ROUNDS = f"""WITH r AS (SELECT * FROM {_RATINGS_SQL}), train AS (SELECT * FROM r WHERE NOT {_HELD}),
       v0 AS (SELECT DISTINCT item, 1 + (item % 5) / 10.0::DOUBLE AS v FROM train),
       u1 AS (SELECT user, sum(rating * v) / (sum(v * v) + 0.01 * count(*)) AS u FROM train JOIN v0 USING (item) GROUP BY user),
       v1 AS (SELECT item, sum(rating * u) / (sum(u * u) + 0.01 * count(*)) AS v FROM train JOIN u1 USING (user) GROUP BY item),
       u2 AS (SELECT user, sum(rating * v) / (sum(v * v) + 0.01 * count(*)) AS u FROM train JOIN v1 USING (item) GROUP BY user),
       v2 AS (SELECT item, sum(rating * u) / (sum(u * u) + 0.01 * count(*)) AS v FROM train JOIN u2 USING (user) GROUP BY item)"""


def _rounds(t):
    """Ratings, and factors of rank 1 after two rounds on the training part."""
    table = _stored_ratings(t)
    slot = F.pmod(F.col("user") * 31 + F.col("item"), F.lit(10))
    train = table.filter(slot < 8)
    start = one_per_key(train, ["item"]).select("item", F.array(1 + F.pmod("item", F.lit(5)) / 10.0).alias("factors"))
    users, items = factors.alternate(train, rank=1, rounds=2, reg=0.01, start=start)
    return table.filter(slot >= 8), train, users, items


@query(
    "als_rounds",
    f"""{_ROUNDS} SELECT user, item, round(rating, 6) AS rating, round(u * v, 6) AS prediction
        FROM r LEFT JOIN u2 USING (user) LEFT JOIN v2 USING (item) WHERE {_HELD}""",
)
def als_rounds(t):
    """Predictions for held-out pairs by two rounds of alternating half steps from given factors."""
    held, _, users, items = _rounds(t)
    scored = factors.score_pairs(held, users, items)
    return scored.select("user", "item", F.round("rating", 6).alias("rating"), F.round("prediction", 6).alias("prediction"))


@query(
    "als_loss",
    f"""{_ROUNDS} SELECT round(sum((rating - u * v) ** 2 + 0.01 * (u * u + v * v)), 3) AS loss FROM train JOIN u2 USING (user) JOIN v2 USING (item)""",
)
def als_loss(t):
    """Training loss after the two rounds."""
    _, train, users, items = _rounds(t)
    return rounded(factors.loss(train, users, items, reg=0.01), 3)


@query(
    "als_top_items",
    """WITH s AS (SELECT s_suppkey AS user, p_partkey AS item,
                         CAST((s_suppkey % 5 - 1) * (1 + p_partkey % 7) + (s_suppkey % 4) * (p_partkey % 3 - 1) AS DOUBLE) AS prediction
                  FROM supplier JOIN part ON true)
       SELECT * FROM (SELECT user, item, prediction, CAST(row_number() OVER (PARTITION BY user ORDER BY prediction DESC, item) AS INTEGER) AS rank FROM s)
       WHERE rank <= 5""",
)
def als_top_items(t):
    """The five best parts of the whole catalogue for every supplier, by given factors."""
    user = F.col("s_suppkey")
    users = _given(t.supplier, "s_suppkey", "user", F.pmod(user, F.lit(5)) - 1, F.pmod(user, F.lit(4)))
    return factors.top_items(users, _item_factors(t), 5)


@query(
    "rmse",
    "SELECT round(sqrt(avg((l_quantity - l_linenumber * 7) ** 2)), 6) AS rmse FROM lineitem",
)
def rmse(t):
    scored = t.lineitem.select("l_quantity", (F.col("l_linenumber") * 7).alias("prediction"))
    return rounded(metrics.rmse(scored, "l_quantity", "prediction"))
