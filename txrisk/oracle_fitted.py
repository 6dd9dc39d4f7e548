"""Independent DuckDB SQL for the queries over fitted models (``txrisk.plans.fitted``).

On one text column the fits have a closed form.  With balanced class weights, let ``p`` be the weighted share of fraud
among the training rows of a band.  An unpenalised logistic regression and an unsampled tree score the band with ``p``.
Boosted trees on the labels -1 and 1 start with the band's mean ``2 p - 1`` and add, at each further stage, the learning
rate times the band's mean residual ``4 y / (1 + exp(2 y f))``; the score is ``1 / (1 + exp(-2 f))``.
"""

from __future__ import annotations

from txrisk.oracle import _SCORED_CTE, _SPLIT, TXN_CTE

_REPORT_CTES = _SCORED_CTE[_SCORED_CTE.index("counts AS ("):]

_BANDS = """CASE WHEN amount < 0.005 THEN 'none' WHEN amount < 150 THEN 'small' WHEN amount < 300 THEN 'middle'
              WHEN amount < 600 THEN 'large' ELSE 'huge' END"""
_HALVES = "CASE WHEN amount < 450 THEN 'low' ELSE 'high' END"


def _closed_form(bands: str) -> str:
    """Scores of the test rows; the forest always has two bands."""
    return f""",
sides AS (
  SELECT transaction_id, is_fraud AS label, {_SPLIT} AS split, unnest([{bands}, {_HALVES}]) AS band, unnest([1, 2]) AS kind FROM txn
),
classes AS (
  SELECT CAST(count(*) AS DOUBLE) / (2 * count(*) FILTER (WHERE label = 1)) AS w1,
         CAST(count(*) AS DOUBLE) / (2 * count(*) FILTER (WHERE label = 0)) AS w0
  FROM sides WHERE split = 'train' AND kind = 1
),
shares AS (
  SELECT kind, band, sum(CASE WHEN label = 1 THEN w1 ELSE 0 END) / sum(CASE WHEN label = 1 THEN w1 ELSE w0 END) AS p
  FROM sides, classes WHERE split = 'train' GROUP BY kind, band
),
boosted AS (
  SELECT model, model_rank, rate, band, p, 1 AS stage, 2 * p - 1 AS f
  FROM shares, (VALUES ('XGBoost', 3, 0.1::DOUBLE), ('LightGBM', 4, 0.05::DOUBLE)) v(model, model_rank, rate) WHERE kind = 1
  UNION ALL
  SELECT model, model_rank, rate, band, p, stage + 1,
         f + rate * (p * 4 / (1 + exp(2 * f)) - (1 - p) * 4 / (1 + exp(-2 * f)))
  FROM boosted WHERE stage < 5
),
band_scores AS (
  SELECT 'LogisticRegression' AS model, 1 AS model_rank, 1 AS kind, band, p AS score FROM shares WHERE kind = 1
  UNION ALL SELECT 'RandomForest', 2, 2, band, p FROM shares WHERE kind = 2
  UNION ALL SELECT model, model_rank, 1, band, 1 / (1 + exp(-2 * f)) FROM boosted WHERE stage = 5
),
scored2 AS (
  SELECT s.model, s.model_rank, b.transaction_id, b.label, s.score, CAST(s.score > 0.5 AS INTEGER) AS prediction
  FROM sides b JOIN band_scores s USING (kind, band) WHERE b.split = 'test'
),
{_REPORT_CTES}"""


def with_fitted(body: str, bands: str = _BANDS) -> str:
    return "WITH RECURSIVE " + TXN_CTE.strip() + _closed_form(bands) + "\n" + body.strip()


_NUMBERS = ["amount", "customer_age", "latitude", "longitude", "account_balance", "transaction_hour", "loyalty_points"]
_TEXTS = ["currency", "customer_segment", "location", "transaction_type", "device_os", "merchant_category",
          "payment_method", "day_of_week"]


def _features_sql() -> str:
    numbers = "\nUNION ALL\n".join(
        f"SELECT {i} AS col, 0::BIGINT AS slot, '{c}' AS feature, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS stddev, "
        f"0.0::DOUBLE AS total FROM train" for i, c in enumerate(_NUMBERS))
    texts = "\nUNION ALL\n".join(
        f"SELECT {len(_NUMBERS) + i}, row_number() OVER (ORDER BY count(*) DESC, {c}), '{c}=' || {c}, NULL, NULL, "
        f"count(*)::DOUBLE FROM train WHERE {c} IS NOT NULL GROUP BY {c}\nUNION ALL\n"
        f"SELECT {len(_NUMBERS) + i}, 1000000, '{c}=<unknown>', NULL, NULL, (count(*) FILTER (WHERE {c} IS NULL))::DOUBLE FROM train"
        for i, c in enumerate(_TEXTS))
    return ("WITH " + TXN_CTE.strip() + f""",
train AS (SELECT * FROM txn WHERE {_SPLIT} = 'train'),
features AS (
{numbers}
UNION ALL
{texts}
)
SELECT row_number() OVER (ORDER BY col, slot) - 1 AS place, feature, mean, stddev, total FROM features""")


_PARAMS = [
    ("LogisticRegression", "max_iter", 500), ("LogisticRegression", "C", 1e12), ("LogisticRegression", "tol", 1e-9),
    ("RandomForest", "n_estimators", 1), ("RandomForest", "max_depth", 12), ("RandomForest", "min_samples_leaf", 1),
    ("RandomForest", "max_features", "all"), ("RandomForest", "bootstrap", "False"),
    ("XGBoost", "n_estimators", 5), ("XGBoost", "learning_rate", 0.1), ("XGBoost", "max_depth", 5),
    ("LightGBM", "n_estimators", 5), ("LightGBM", "learning_rate", 0.05), ("LightGBM", "max_depth", 5),
]
_METRICS = ["precision_class_0", "recall_class_0", "precision_class_1", "recall_class_1", "support_class_0", "support_class_1",
            "accuracy", "f1_score_class_0", "f1_score_class_1", "macro_avg_precision", "weighted_avg_precision",
            "macro_avg_recall", "weighted_avg_recall", "macro_avg_f1_score", "weighted_avg_f1_score", "roc_auc", "auc_pr"]


def _run_record_sql() -> str:
    params = ",\n  ".join(f"('{m}', 'param:{k}', {'NULL' if isinstance(v, str) else f'{v!r}::DOUBLE'}, "
                          f"{chr(39) + v + chr(39) if isinstance(v, str) else 'NULL'}, 'completed')" for m, k, v in _PARAMS)
    metrics = "\nUNION ALL ".join(f"SELECT model, '{c}', round({c}::DOUBLE, 9), NULL, 'completed' FROM model_metrics WHERE {c} IS NOT NULL"
                                  for c in _METRICS)
    return with_fitted(f"""
SELECT * FROM (VALUES
  {params}) v(model, metric, value, text, status)
UNION ALL {metrics}
UNION ALL SELECT * FROM (SELECT model, 'best_model_f1_class_1', round(f1_score_class_1, 9), model, 'completed' FROM model_metrics
                         ORDER BY f1_score_class_1 DESC, model_rank LIMIT 1)
UNION ALL SELECT NULL, 'run_status', NULL, NULL, 'parent_completed'""", _HALVES)


ORACLE: dict[str, str] = {
    "smote_balance": "WITH " + TXN_CTE.strip() + f""",
counts AS (SELECT is_fraud AS label, count(*) AS n FROM txn WHERE {_SPLIT} = 'train' GROUP BY 1)
SELECT label, (SELECT max(n) FROM counts) AS rows, (SELECT max(n) FROM counts) - n AS synthetic, 0::BIGINT AS outside FROM counts""",
    "fitted_features": _features_sql(),
    "fitted_scores": with_fitted("SELECT model, transaction_id, label, round(score, 4) AS score, prediction FROM scored2"),
    "fitted_model_metrics": with_fitted("SELECT * EXCLUDE (model_rank) FROM model_metrics"),
    "fitted_best_model": with_fitted(
        "SELECT model, f1_score_class_1 FROM model_metrics ORDER BY f1_score_class_1 DESC NULLS LAST, model_rank LIMIT 1"),
    "fitted_confusion_matrix": with_fitted(
        "SELECT model, label, prediction, CAST(count(*) AS BIGINT) AS count FROM scored2 GROUP BY 1, 2, 3"),
    "fitted_importances": with_fitted("""
SELECT model, (SELECT count(DISTINCT band) + 1 FROM sides WHERE split = 'train' AND kind = 2) AS features, 1.0::DOUBLE AS total
FROM (VALUES ('RandomForest'), ('XGBoost'), ('LightGBM')) v(model)"""),
    "run_record": _run_record_sql(),
    "fit_invariants": "WITH " + TXN_CTE.strip() + f""",
sides AS (SELECT count(*) FILTER (WHERE {_SPLIT} = 'train') AS trained, count(*) FILTER (WHERE {_SPLIT} = 'test') AS scored FROM txn)
SELECT model, trained, scored, scored AS rows, 0::BIGINT AS outside, 0::BIGINT AS inconsistent,
       true AS better_than_chance, true AS residuals_vanish
FROM sides, (VALUES ('LogisticRegression'), ('RandomForest'), ('XGBoost'), ('LightGBM')) v(model)""",
}
