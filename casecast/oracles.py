"""The answers to the queries as plain SQL that DuckDB runs on the same tables. Kept apart from the Spark code."""

from casecast.sources.orders import orders_as_cases_sql

CASES = f"cases AS ({orders_as_cases_sql()})"

CONFIRMED = """confirmed AS (
  SELECT case_id, sexo AS sex, edad AS age, fecha_inicio_sintomas AS symptom_date,
         fecha_internacion AS admission_date, cuidado_intensivo AS icu_raw,
         asistencia_respiratoria_mecanica AS ventilator_raw, clasificacion AS classification,
         fecha_diagnostico AS diagnosis_date
  FROM cases WHERE clasificacion_resumen = 'Confirmado')"""

DERIVED = """derived AS (
  SELECT case_id, sex, CASE WHEN sex = 'M' THEN 1 ELSE 0 END AS male, age,
         CASE WHEN icu_raw = 'SI' THEN 1 ELSE 0 END AS icu,
         CASE WHEN ventilator_raw = 'SI' THEN 1 ELSE 0 END AS ventilator,
         CAST(date_diff('day', symptom_date, admission_date) AS INT) AS days_to_admission,
         CAST(date_diff('day', symptom_date, diagnosis_date) AS INT) AS days_to_diagnosis,
         CAST(CASE WHEN classification LIKE '%Fallecido%' THEN 1 ELSE 0 END AS DOUBLE) AS label
  FROM confirmed)"""

MEANS = """means AS (
  SELECT CAST(ceil(avg(CASE WHEN sex = 'M' THEN age END)) AS BIGINT) AS mean_age_m,
         CAST(ceil(avg(CASE WHEN sex <> 'M' THEN age END)) AS BIGINT) AS mean_age_other,
         CAST(ceil(avg(days_to_diagnosis)) AS BIGINT) AS mean_days_dx
  FROM derived)"""

PREPARED = """prepared AS (
  SELECT case_id, male,
         CAST(CASE WHEN sex = 'M' AND age IS NULL THEN mean_age_m ELSE mean_age_other END AS DOUBLE) AS age,
         icu, ventilator, days_to_admission,
         CAST(coalesce(days_to_diagnosis, mean_days_dx) AS BIGINT) AS days_to_diagnosis, label
  FROM derived, means)"""

COMPLETE = "complete AS (SELECT * FROM prepared WHERE days_to_admission IS NOT NULL)"

PARTED = """parted AS (
  SELECT *, CASE WHEN h % 1000 < 700 THEN 'train' WHEN h % 1000 < 900 THEN 'test' ELSE 'validation' END AS split,
         CAST((h // 1000) % 3 AS INT) AS fold
  FROM (SELECT *, ('0x' || substr(md5(case_id::VARCHAR), 1, 8))::BIGINT AS h FROM complete))"""

STEPS = [CASES, CONFIRMED, DERIVED, MEANS, PREPARED, COMPLETE, PARTED]
CASES_ONLY, TO_CONFIRMED, TO_DERIVED, TO_MEANS, TO_PREPARED, TO_COMPLETE, TO_PARTED = (
    STEPS[: i + 1] for i in range(len(STEPS))
)


def with_steps(steps, query):
    return "WITH " + ",\n".join(steps) + "\n" + query


EVENTS = """events_with_gaps AS (
  SELECT event_id, event_type, user_id, CASE WHEN value >= 5.0 THEN value END AS value FROM events)"""


def filled_events(group):
    return with_steps(
        [EVENTS],
        f"""SELECT event_id, {group}, round(CAST(coalesce(value, ceil(round(avg(value) OVER (PARTITION BY {group}), 9)),
            ceil(round(avg(value) OVER (), 9))) AS DOUBLE), 6) AS value FROM events_with_gaps""",
    )


def confusion_cells(steps, source, keys=()):
    listed = "".join(f"{key}, " for key in keys)
    cells = f"cells AS (SELECT {listed}label, prediction, count(*) AS n FROM {source} GROUP BY ALL)"
    return [*steps, cells]


ICU_RULE = "ruled AS (SELECT *, CAST(icu AS DOUBLE) AS prediction FROM parted)"
LARGEST_ENTRY_RULE = """ruled AS (
  SELECT CAST(label AS DOUBLE) AS label,
         CAST((list_position(embedding, list_max(embedding)) - 1) % 10 AS DOUBLE) AS prediction FROM embeddings)"""

METRIC_COLUMNS = """
  round(sum(s / t * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END), 6) AS f1,
  round(sum(hit) / max(t), 6) AS accuracy,
  round(sum(s / t * p), 6) AS weighted_precision,
  round(sum(s / t * r), 6) AS weighted_recall,
  round(sum(s / t * r), 6) AS weighted_true_positive_rate,
  round(sum(s / t * CASE WHEN t > s THEN (said - hit) / (t - s) ELSE 0 END), 6) AS weighted_false_positive_rate"""


def metric_steps(steps, keys=()):
    """Support, hits and predictions per actual class by correlated counting."""
    same = "".join(f" AND c.{key} = a.{key}" for key in keys)
    listed = "".join(f"{key}, " for key in keys)
    classes = f"""classes AS (
      SELECT {listed}s, t, hit, said, hit / s AS r, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS p FROM (
        SELECT {"".join(f"a.{key}, " for key in keys)}
          CAST((SELECT sum(n) FROM cells c WHERE c.label = a.label{same}) AS DOUBLE) AS s,
          CAST((SELECT sum(n) FROM cells c WHERE true{same}) AS DOUBLE) AS t,
          CAST((SELECT coalesce(sum(n), 0) FROM cells c
                WHERE c.label = a.label AND c.prediction = a.label{same}) AS DOUBLE) AS hit,
          CAST((SELECT coalesce(sum(n), 0) FROM cells c WHERE c.prediction = a.label{same}) AS DOUBLE) AS said
        FROM (SELECT DISTINCT {listed}label FROM cells) a))"""
    return [*confusion_cells(steps, "ruled", keys), classes]


def metrics_sql(steps, keys=()):
    listed = "".join(f"{key}, " for key in keys)
    return with_steps(metric_steps(steps, keys), f"SELECT {listed}{METRIC_COLUMNS} FROM classes GROUP BY ALL")


ICU_STEPS = [*TO_PARTED, ICU_RULE]
METRIC_NAMES = (
    "f1, accuracy, weighted_precision, weighted_recall, weighted_true_positive_rate, weighted_false_positive_rate"
)


def wide_metrics(keys):
    listed = "".join(f"{key}, " for key in keys)
    return f"wide AS (SELECT {listed}{METRIC_COLUMNS} FROM classes GROUP BY ALL)"


# The report of the ICU rule, line by line.
REPORT = with_steps(
    [*metric_steps(ICU_STEPS, ["split"]), wide_metrics(["split"])]
    + [
        """named AS (SELECT *, upper(split[1]) || split[2:] AS part FROM wide WHERE split <> 'train')""",
        """cell_named AS (SELECT *, upper(split[1]) || split[2:] AS part FROM cells WHERE split <> 'train')""",
    ],
    """SELECT 'How icu rule did on held-out cases' AS "Text"
       UNION ALL SELECT part || ' set' FROM named
       UNION ALL SELECT part || ': Confusion matrix, predicted 0.0 1.0' FROM named
       UNION ALL SELECT part || ': actual ' || printf('%.1f', label) || ': '
           || coalesce(sum(n) FILTER (prediction = 0), 0) || ' ' || coalesce(sum(n) FILTER (prediction = 1), 0)
         FROM cell_named GROUP BY part, label
       UNION ALL SELECT part || ': F1-Score ' || printf('%.6f', f1) FROM named
       UNION ALL SELECT part || ': Accuracy ' || printf('%.6f', accuracy) FROM named
       UNION ALL SELECT part || ': Weighted precision ' || printf('%.6f', weighted_precision) FROM named
       UNION ALL SELECT part || ': Weighted recall ' || printf('%.6f', weighted_recall) FROM named
       UNION ALL SELECT part || ': Weighted true positive rate ' || printf('%.6f', weighted_true_positive_rate)
         FROM named
       UNION ALL SELECT part || ': Weighted false positive rate ' || printf('%.6f', weighted_false_positive_rate)
         FROM named""",
)


def axis(name, values):
    """One grid axis as numbered text values."""
    rows = ", ".join(f"({i}, '{value}')" for i, value in enumerate(values.split()))
    return f"(VALUES {rows}) AS {name}(i, v)"


# The four grids, points numbered with the last axis running fastest.
GRID_SELECTS = [
    f"""SELECT 'rf' AS model, (a.i * 3 + b.i) * 6 + c.i AS point,
          'impurity=' || a.v || ' seed=' || b.v || ' numTrees=' || c.v AS params
        FROM {axis("a", "gini entropy")}, {axis("b", "512 1024 2048")}, {axis("c", "100 200 400 600 800 1000")}""",
    f"""SELECT 'lr', ((a.i * 6 + b.i) * 6 + c.i) * 4 + d.i,
          'maxIter=' || a.v || ' elasticNetParam=' || b.v || ' regParam=' || c.v || ' tol=' || d.v
        FROM {axis("a", "100 300 500 700")}, {axis("b", "0.8 0.7 0.5 0.4 0.3 0.15")},
             {axis("c", "0.1 0.2 0.3 0.4 0.5 0.7")}, {axis("d", "0.0 0.1 0.2 0.3")}""",
    f"""SELECT 'svm', (a.i * 5 + b.i) * 4 + c.i, 'maxIter=' || a.v || ' regParam=' || b.v || ' tol=' || c.v
        FROM {axis("a", "100 300 500 700 900")}, {axis("b", "0.1 0.2 0.3 0.4 0.5")}, {axis("c", "0.0 0.1 0.2 0.3")}""",
    f"""SELECT 'gbt', (a.i * 2 + b.i) * 2 + c.i, 'maxIter=' || a.v || ' seed=' || b.v || ' stepSize=' || c.v
        FROM {axis("a", "100 300 500")}, {axis("b", "1024 2048")}, {axis("c", "0.2 0.3")}""",
]

RATES = "rates AS (SELECT icu, avg(label) AS p FROM derived GROUP BY icu)"

# The folds of the training part over all confirmed cases, and the weighted F1 of predicting survival throughout.
MAJORITY = """hashed AS (
  SELECT label, ('0x' || substr(md5(case_id::VARCHAR), 1, 8))::BIGINT AS h FROM derived),
fold_f1 AS (
  SELECT (h // 1000) % 3 AS fold, avg(1 - label) AS q FROM hashed WHERE h % 1000 < 700 GROUP BY 1),
scored AS (SELECT avg(q * 2 * q / (1 + q)) AS a, stddev_pop(q * 2 * q / (1 + q)) AS s FROM fold_f1)"""

# Runs that predict survival for every held-out case.
SURVIVAL_STEPS = [
    *TO_PARTED,
    """ruled AS (SELECT split AS dataset, label, CAST(0 AS DOUBLE) AS prediction FROM parted WHERE split <> 'train')""",
]
SURVIVAL_METRICS = [*metric_steps(SURVIVAL_STEPS, ["dataset"]), wide_metrics(["dataset"])]

ALL_MODELS = "(VALUES ('rf'), ('lr'), ('svm'), ('gbt')) AS m(model)"

# Each fold of the training part judged by what the other folds say of its level of care.
ICU_FOLDS = [
    """foldrows AS (
  SELECT icu, label, (h // 1000) % 3 AS fold
  FROM (SELECT icu, label, ('0x' || substr(md5(case_id::VARCHAR), 1, 8))::BIGINT AS h FROM derived) WHERE h % 1000 < 700)""",
    """learned AS (
  SELECT f.fold, r.icu, avg(r.label) > 0.5 AS dies FROM (SELECT DISTINCT fold FROM foldrows) f
  JOIN foldrows r ON r.fold <> f.fold GROUP BY f.fold, r.icu)""",
    """cells4 AS (
  SELECT r.fold, count(*) AS n, count(*) FILTER (dies AND label = 1) AS tp, count(*) FILTER (dies AND label = 0) AS fp,
    count(*) FILTER (NOT dies AND label = 1) AS fn, count(*) FILTER (NOT dies AND label = 0) AS tn
  FROM foldrows r JOIN learned l ON r.fold = l.fold AND r.icu = l.icu GROUP BY r.fold)""",
    """icu_f1 AS (
  SELECT fold, ((tp + fn) * coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)
    + (tn + fp) * coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0)) / n AS f1 FROM cells4)""",
]


def icu_winner(majority, icu):
    """The tuning table of a point that predicts survival and one that follows the ICU flag."""
    return with_steps(
        [*TO_DERIVED, MAJORITY, *ICU_FOLDS],
        f"""SELECT 0 AS point, '{majority}' AS params, round(a, 6) AS avg_f1, round(s, 6) AS std_f1, false AS best FROM scored
            UNION ALL
            SELECT 1, '{icu}', round(avg(f1), 6), round(stddev_pop(f1), 6), true FROM icu_f1""",
    )


def stored_results(models):
    names = ", ".join(f"('{name}')" for name in models)
    return with_steps(
        TO_PARTED,
        f"""SELECT model, split AS dataset, count(*) AS n, CAST(sum(label) AS BIGINT) AS deaths,
            CAST(6 AS BIGINT) AS metrics, CAST(0 AS BIGINT) AS mismatches
            FROM parted, (VALUES {names}) AS m(model) WHERE split <> 'train' GROUP BY model, split""",
    )


ORACLES = {
    "csv_scan_roundtrip": with_steps(CASES_ONLY, "SELECT * FROM cases"),
    "csv_scan_inferred": with_steps(CASES_ONLY, "SELECT * FROM cases"),
    "csv_scan_other_headers": with_steps(CASES_ONLY, "SELECT * FROM cases"),
    "parquet_scan_roundtrip": with_steps(CASES_ONLY, "SELECT * FROM cases"),
    "confirmed_cases": with_steps(TO_CONFIRMED, "SELECT * FROM confirmed"),
    "care_flags": with_steps(TO_DERIVED, "SELECT case_id, male, icu, ventilator FROM derived"),
    "group_means": with_steps(TO_MEANS, "SELECT * FROM means"),
    "death_label": with_steps(TO_DERIVED, "SELECT case_id, label FROM derived"),
    "age_as_computed": with_steps(TO_PREPARED, "SELECT case_id, age FROM prepared"),
    "day_gaps": with_steps(TO_DERIVED, "SELECT case_id, days_to_admission, days_to_diagnosis FROM derived"),
    "fill_days_to_diagnosis": with_steps(TO_PREPARED, "SELECT case_id, days_to_diagnosis FROM prepared"),
    "prepared_as_computed": with_steps(TO_PREPARED, "SELECT * FROM prepared"),
    "model_inputs_base": with_steps(
        TO_COMPLETE,
        """SELECT case_id, CAST(male AS DOUBLE) AS male, age, CAST(icu AS DOUBLE) AS icu,
           CAST(ventilator AS DOUBLE) AS ventilator, CAST(days_to_admission AS DOUBLE) AS days_to_admission, label
           FROM complete""",
    ),
    "model_inputs_with_diagnosis": with_steps(
        TO_COMPLETE,
        """SELECT case_id, CAST(male AS DOUBLE) AS male, age, CAST(icu AS DOUBLE) AS icu,
           CAST(ventilator AS DOUBLE) AS ventilator, CAST(days_to_admission AS DOUBLE) AS days_to_admission,
           CAST(days_to_diagnosis AS DOUBLE) AS days_to_diagnosis, label FROM complete""",
    ),
    "impute_age_by_sex": with_steps(
        TO_DERIVED,
        """SELECT case_id, CAST(coalesce(age, ceil(avg(CASE WHEN sex IS NOT NULL THEN age END) OVER (PARTITION BY male)))
           AS BIGINT) AS age FROM derived""",
    ),
    "impute_event_value": filled_events("event_type"),
    "impute_event_value_many_groups": filled_events("user_id"),
    "split_counts": with_steps(
        TO_PARTED, "SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS deaths FROM parted GROUP BY split"
    ),
    "fold_counts": with_steps(
        TO_PARTED,
        """SELECT fold, count(*) AS n, CAST(sum(label) AS BIGINT) AS deaths FROM parted
           WHERE split = 'train' GROUP BY fold""",
    ),
    "random_split_cover": with_steps(
        TO_COMPLETE,
        """SELECT count(DISTINCT case_id) AS cases, count(*) AS "rows", CAST(1 AS BIGINT) AS most_parts_of_a_case,
           true AS shares_kept FROM complete""",
    ),
    "case_profiles": with_steps(
        TO_PARTED,
        """SELECT split, fold, male, age, icu, ventilator, days_to_admission, label, count(*) AS n
           FROM parted GROUP BY ALL""",
    ),
    "search_plan": with_steps(
        [*TO_PARTED, f"points AS ({' UNION ALL '.join(GRID_SELECTS)})"],
        """SELECT model, CAST(point AS INT) AS point, params, fold, n - n_validation AS n_train, n_validation
           FROM points, (SELECT fold, count(*) AS n_validation FROM parted WHERE split = 'train' GROUP BY fold),
             (SELECT count(*) AS n FROM parted WHERE split = 'train')""",
    ),
    "confusion": with_steps(confusion_cells(ICU_STEPS, "ruled"), "SELECT * FROM cells"),
    "confusion_by_split": with_steps(confusion_cells(ICU_STEPS, "ruled", ["split"]), "SELECT * FROM cells"),
    "confusion_matrix": with_steps(
        ICU_STEPS,
        """SELECT label, count(*) FILTER (prediction = 0) AS "0.0", count(*) FILTER (prediction = 1) AS "1.0"
           FROM ruled GROUP BY label""",
    ),
    "confusion_multiclass": with_steps(confusion_cells([LARGEST_ENTRY_RULE], "ruled"), "SELECT * FROM cells"),
    "metrics": metrics_sql(ICU_STEPS),
    "metrics_by_split": metrics_sql(ICU_STEPS, ["split"]),
    "metrics_multiclass": metrics_sql([LARGEST_ENTRY_RULE]),
    "metrics_by_name": with_steps(
        [*metric_steps(ICU_STEPS, ["split"]), wide_metrics(["split"])],
        f"SELECT split, metric, value FROM (UNPIVOT wide ON {METRIC_NAMES} INTO NAME metric VALUE value)",
    ),
    "selection_metric": with_steps([*metric_steps(ICU_STEPS), wide_metrics([])], "SELECT f1 FROM wide"),
    "evaluation_report": REPORT,
    "base_rates": with_steps(
        TO_COMPLETE,
        """SELECT icu, ventilator, count(*) AS n, CAST(sum(label) AS BIGINT) AS deaths,
           round(avg(label), 6) AS death_rate, round(avg(days_to_admission), 6) AS avg_days_to_admission
           FROM complete GROUP BY icu, ventilator""",
    ),
    "forest_stump": with_steps([*TO_DERIVED, RATES], "SELECT icu, round(p, 6) AS p FROM rates"),
    "logit_intercept": with_steps(
        [*TO_DERIVED, RATES],
        """SELECT icu, round((SELECT ln(avg(label) / (1 - avg(label))) FROM derived), 6) AS intercept FROM rates""",
    ),
    "logit_saturated": with_steps(
        [*TO_DERIVED, RATES], "SELECT icu, round(ln(p / (1 - p)), 4) AS margin FROM rates"
    ),
    "boost_stump": with_steps([*TO_DERIVED, RATES], "SELECT icu, round(2 * p - 1, 6) AS margin FROM rates"),
    "boost_counted_stump": with_steps([*TO_DERIVED, RATES], "SELECT icu, round(2 * p - 1, 6) AS margin FROM rates"),
    "split_candidates": with_steps(
        TO_DERIVED,
        """, counted AS (
          SELECT feature, v, count(*) AS n
          FROM (SELECT unnest([0, 1]) AS feature, unnest([CAST(age AS DOUBLE), CAST(days_to_admission AS DOUBLE)]) AS v
                FROM derived WHERE age IS NOT NULL AND days_to_admission IS NOT NULL)
          GROUP BY feature, v),
        ranked AS (
          SELECT feature, v, n, lead(v) OVER up AS following, sum(n) OVER up AS passed,
                 sum(n) OVER (PARTITION BY feature) AS total, count(*) OVER (PARTITION BY feature) AS kinds
          FROM counted WINDOW up AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING))
        SELECT CAST(feature AS INT) AS feature, (v + following) / 2 AS border FROM ranked
        WHERE following IS NOT NULL AND (kinds <= 16 OR passed * 16 // total > (passed - n) * 16 // total)""",
    ),
    "svm_majority": with_steps(
        [*TO_DERIVED, RATES],
        "SELECT icu, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM rates",
    ),
    "svm_hinge": with_steps(
        [*TO_DERIVED, "counts AS (SELECT icu, count(*) AS n, sum(label) AS d FROM derived GROUP BY icu)"],
        "SELECT round(sum(2 * least(d, n - d)) / sum(n), 6) AS least, true AS reached FROM counts",
    ),
    "svm_on_counts": with_steps(
        TO_DERIVED, "SELECT count(*) AS n, true AS reached FROM derived WHERE age IS NOT NULL AND days_to_admission IS NOT NULL"
    ),
    "svm_score_consistency": with_steps(
        TO_COMPLETE, "SELECT count(*) AS n, CAST(0 AS BIGINT) AS mismatches FROM complete"
    ),
    "cross_validation_majority": with_steps(
        [*TO_DERIVED, MAJORITY],
        """SELECT CAST(point AS INT) AS point, params, round(a, 6) AS avg_f1, round(s, 6) AS std_f1, point = 0 AS best
           FROM scored, (VALUES (0, 'elasticNetParam=1.0 regParam=10.0'), (1, 'elasticNetParam=1.0 regParam=20.0'))
             AS t(point, params)""",
    ),
    "cross_validation_winner": icu_winner("elasticNetParam=1.0 regParam=10.0 tol=1e-09", "elasticNetParam=1.0 regParam=0.0 tol=1e-09"),
    "search_resumed": icu_winner("elasticNetParam=1.0 regParam=10.0 tol=1e-09", "elasticNetParam=1.0 regParam=0.0 tol=1e-09"),
    "search_forest_winner": icu_winner("numTrees=1 maxDepth=0", "numTrees=1 maxDepth=1"),
    "search_boosted_winner": icu_winner("maxIter=1 maxDepth=0", "maxIter=1 maxDepth=1"),
    "search_svm_winner": icu_winner("maxIter=5 regParam=10.0 tol=0.01", "maxIter=5 regParam=0.0 tol=0.01"),
    "forest_counted": with_steps(TO_DERIVED, "SELECT icu, true AS mean_kept, true AS spread_kept FROM derived GROUP BY icu"),
    "stamped_runs": f"""
        SELECT dataset, metric, CAST(2 AS BIGINT) AS runs, CAST(2 AS BIGINT) AS n, true AS agree
        FROM (VALUES ('test'), ('validation')) AS d(dataset), (SELECT unnest(string_split('{METRIC_NAMES}', ', ')) AS metric)""",
    "training_run": stored_results(["rf", "lr", "svm", "gbt"]),
    "training_run_with_diagnosis": stored_results(["lr", "rf"]),
    "tuned_parameters": """
        SELECT 'tuned' AS run_id, model, param, value
        FROM (VALUES ('rf', 'impurity', 'entropy'), ('rf', 'seed', '512'), ('rf', 'numTrees', '3'),
          ('lr', 'elasticNetParam', '0.5'), ('lr', 'maxIter', '20'), ('lr', 'regParam', '0.2'), ('lr', 'tol', '0.1'),
          ('gbt', 'seed', '1024'), ('gbt', 'maxIter', '2'), ('gbt', 'stepSize', '0.2'),
          ('svm', 'maxIter', '3'), ('svm', 'regParam', '0.4'), ('svm', 'tol', '0.2')) AS t(model, param, value)""",
    "scored_cases": with_steps(TO_COMPLETE, "SELECT case_id, label, CAST(0 AS INT) AS off_side FROM complete"),
    "majority_run_metrics": with_steps(
        SURVIVAL_METRICS,
        f"""SELECT 'majority' AS run_id, 'base' AS features, model, dataset, metric, value
            FROM (UNPIVOT wide ON {METRIC_NAMES} INTO NAME metric VALUE value), {ALL_MODELS}""",
    ),
    "majority_run_confusion": with_steps(
        confusion_cells(SURVIVAL_STEPS, "ruled", ["dataset"]),
        f"SELECT 'majority' AS run_id, 'with_diagnosis' AS features, model, cells.* FROM cells, {ALL_MODELS}",
    ),
    "majority_run_leaderboard": with_steps(
        SURVIVAL_METRICS,
        f"""SELECT 'majority' AS run_id, 'base' AS features, model, {METRIC_NAMES}
            FROM wide, {ALL_MODELS} WHERE dataset = 'test'""",
    ),
    "majority_run_parameters": """
        SELECT 'majority' AS run_id, model, param, value
        FROM (VALUES ('rf', 'impurity', 'gini'), ('rf', 'seed', '512'), ('rf', 'numTrees', '2'),
          ('lr', 'elasticNetParam', '1.0'), ('lr', 'maxIter', '100'), ('lr', 'regParam', '10.0'), ('lr', 'tol', '0.1'),
          ('svm', 'maxIter', '20'), ('svm', 'regParam', '100.0'), ('svm', 'tol', '0.1'),
          ('gbt', 'seed', '1024'), ('gbt', 'maxIter', '1'), ('gbt', 'stepSize', '0.2')) AS t(model, param, value)""",
    "majority_run_scores": with_steps(
        [*TO_PARTED, "seen AS (SELECT avg(label) AS p FROM parted WHERE split = 'train')"],
        """SELECT case_id, label, CAST(0 AS DOUBLE) AS prediction, round(ln(p / (1 - p)), 6) AS margin,
           round(p, 6) AS probability, 'lr' AS model FROM complete, seen""",
    ),
    "saved_model_scores": with_steps(
        [*TO_DERIVED, RATES],
        """SELECT case_id, label, CASE WHEN p > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
           round(p, 6) AS probability FROM derived JOIN rates USING (icu)""",
    ),
}
