"""The registered queries as SQL over the raw ``events`` table, for checking results."""

from __future__ import annotations

from wearline import schema as S
from wearline.operators.series import TIES
from wearline.plans import load_queries, stream_queries

READING = [f.name for f in S.READING_SCHEMA.fields]
_KEY = "dataset_id, engine_id"


def _rounded(expression: str, digits: int) -> str:
    """Rounding without a signed zero."""
    return f"(round({expression}, {digits}) + 0.0)"


def _reading_columns() -> str:
    special = {
        "sensor_01": "518.67::DOUBLE",
        "sensor_02": "value",
        "sensor_03": "CASE WHEN event_id % 97 <> 0 THEN value + 100 END",
        "sensor_04": "k",
        "sensor_07": "value + 500",
        "sensor_11": "k / 2 + 40",
    }
    lines = [f"{special.get(s, f'value + {int(s[-2:])}')} AS {s}" for s in S.SENSORS]
    return ",\n    ".join(lines)


_BRONZE = f"""
keyed AS (
  SELECT *,
    'FD00' || (user_id % 4 + 1) AS dataset_id,
    (user_id // 12 + 1)::INTEGER AS engine_id,
    json_extract_string(props, '$.k')::DOUBLE AS k,
    user_id >= (SELECT max(user_id) FROM events) - 3 AND event_id % 5 = 0 AS rare
  FROM events
),
bronze AS MATERIALIZED (
  SELECT
    dataset_id,
    engine_id,
    (row_number() OVER (PARTITION BY {_KEY} ORDER BY ts, event_id))::INTEGER AS cycle,
    (event_id % 6)::DOUBLE * 7 + (event_id % 9 - 4)::DOUBLE / 1000 AS op_setting_1,
    CASE WHEN rare THEN 9.0::DOUBLE ELSE (event_id % 6)::DOUBLE / 10 END AS op_setting_2,
    100.0::DOUBLE AS op_setting_3,
    {_reading_columns()}
  FROM keyed
)"""


def _status(required: tuple[str, ...], positive: tuple[str, ...]) -> str:
    missing = " OR ".join(f"{c} IS NULL" for c in required)
    text = f"CASE WHEN {missing} THEN 'invalid_null'"
    if positive:
        text += " WHEN " + " OR ".join(f"{c} <= 0" for c in positive)
        text += " THEN 'invalid_sensor_range'"
    return text + " ELSE 'valid' END"


_STATUS = {
    "full": _status(("engine_id", "cycle", *S.KEY_SENSORS), S.KEY_SENSORS),
    "nulls_only": _status(("engine_id", "cycle", *S.KEY_SENSORS), ()),
    "staging": _status(("engine_id", "cycle"), ("sensor_02", "sensor_04")),
}


def _silver(rules: str = "full") -> str:
    return f"""{_BRONZE},
lived AS (
  SELECT *, {_STATUS[rules]} AS status, max(cycle) OVER (PARTITION BY {_KEY}) AS max_cycle
  FROM bronze
),
silver AS MATERIALIZED (
  SELECT *,
    {_rounded('cycle::DOUBLE / max_cycle', 3)} AS cycle_pct,
    max_cycle - cycle AS rul
  FROM lived
),
valid AS (SELECT * FROM silver WHERE status = 'valid')"""


def _frame(aggregate: str, rows: int) -> str:
    return (
        f"{aggregate} OVER (PARTITION BY {_KEY} ORDER BY cycle"
        f" ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    )


def _delta(sensor: str) -> str:
    return f"{sensor} - lag({sensor}) OVER (PARTITION BY {_KEY} ORDER BY cycle)"


def _features(rul: str, digits: int | None = 6, fine: int | None = None) -> str:
    """``fine``: digits of everything but the mean, where they differ."""
    derived = {
        "s02_mean_10": _frame("avg(sensor_02)", 10),
        "s02_std_10": _frame("stddev_samp(sensor_02)", 10),
        "s02_delta": _delta("sensor_02"),
        "s04_delta": _delta("sensor_04"),
    }
    shown = ", ".join(
        f"{e if digits is None else _rounded(e, digits if fine is None or 'mean' in n else fine)} AS {n}"
        for n, e in derived.items()
    )
    return f"""
features AS MATERIALIZED (
  SELECT {_KEY}, cycle, {rul} AS rul, cycle_pct, op_setting_1, op_setting_2,
    sensor_02, sensor_04, sensor_11, {shown}
  FROM valid
)"""


def _health(means: int, spread: int) -> str:
    return f"""
health AS (
  SELECT {_KEY}, max(cycle) AS total_cycles,
    {_rounded('avg(sensor_02)', means)} AS avg_sensor_02,
    {_rounded('avg(sensor_04)', means)} AS avg_sensor_04,
    {_rounded('avg(sensor_11)', means)} AS avg_sensor_11,
    {_rounded('stddev_samp(sensor_02)', spread)} AS stddev_sensor_02,
    CASE WHEN max(cycle) > 200 THEN 'long_life'
         WHEN max(cycle) > 130 THEN 'medium_life' ELSE 'short_life' END AS life_category
  FROM valid GROUP BY {_KEY}
)"""

_HEALTH = _health(9, 9)
_DRIFT_NAMES = ("s02", "s04", "s11")


def _period(suffix: str, condition: str) -> str:
    means = ", ".join(f"avg(sensor_{n[1:]}) AS {n}_{suffix}" for n in _DRIFT_NAMES)
    return f"""
{suffix} AS (
  SELECT {_KEY}, {means} FROM valid WHERE {condition} GROUP BY {_KEY}
)"""


_PERIODS = f"{_period('early', 'cycle <= 30')},{_period('late', 'rul <= 30')}"


def _drift(digits: int) -> str:
    changes = ", ".join(f"{_rounded(f'{n}_late - {n}_early', digits)} AS {n}_drift" for n in _DRIFT_NAMES)
    return f"{_PERIODS},\ndrift AS (SELECT {_KEY}, {changes} FROM early JOIN late USING ({_KEY}))"


_DRIFT = _drift(9)


def _scores() -> str:
    windowed = ", ".join(
        f"{_frame(f'avg({s})', 20)} AS {S.short_name(s)}_m,"
        f" {_frame(f'stddev_samp({s})', 20)} AS {S.short_name(s)}_d"
        for s in ("sensor_02", "sensor_11")
    )
    scored = ", ".join(
        f"CASE WHEN {n}_d > 0 THEN ({s} - {n}_m) / {n}_d ELSE 0.0::DOUBLE END AS {n}_z"
        for s, n in (("sensor_02", "s02"), ("sensor_11", "s11"))
    )
    shown = ", ".join(
        f"{s}, {_rounded(f'{n}_m', 6)} AS {n}_rolling_mean, {_rounded(f'{n}_d', 6)} AS {n}_rolling_std,"
        f" {_rounded(f'{n}_z', 6)} AS {n}_zscore, abs(round({n}_z, 9)) > 2.0 AS {n}_anomaly"
        for s, n in (("sensor_02", "s02"), ("sensor_11", "s11"))
    )
    return f"""
windowed AS (SELECT *, {windowed} FROM valid),
scored AS (SELECT *, {scored} FROM windowed),
scores AS MATERIALIZED (SELECT {_KEY}, cycle, rul, {shown} FROM scored),
stages AS (
  SELECT CASE WHEN rul > 100 THEN 'early (RUL > 100)' WHEN rul > 30 THEN 'mid (RUL 30-100)'
              ELSE 'late (RUL < 30)' END AS life_stage,
    count(*) AS total_readings, count(*) FILTER (s02_anomaly) AS anomalies,
    {_rounded('count(*) FILTER (s02_anomaly) / count(*)::DOUBLE * 100', 9)} AS anomaly_rate_pct
  FROM scores GROUP BY 1
),
summary AS (
  SELECT {_KEY}, count(*) AS total_cycles,
    count(*) FILTER (s02_anomaly) AS s02_anomalies,
    count(*) FILTER (s11_anomaly) AS s11_anomalies,
    {_rounded('count(*) FILTER (s02_anomaly) / count(*)::DOUBLE * 100', 9)} AS s02_anomaly_pct
  FROM scores GROUP BY {_KEY}
)"""


_SPLIT = f"""
ranked AS (
  SELECT {_KEY},
    row_number() OVER (PARTITION BY dataset_id ORDER BY engine_id) AS place,
    count(*) OVER (PARTITION BY dataset_id) AS engines
  FROM (SELECT DISTINCT {_KEY} FROM valid)
),
split AS MATERIALIZED (
  SELECT {_KEY}, place <= floor(engines * 0.8::DOUBLE) AS is_train FROM ranked
)"""

_CONDITION = "concat_ws('_', {}, {})".format(
    *(
        f"CASE WHEN isnan({c}) THEN 'nan' ELSE coalesce(round({c}, 2)::DECIMAL(18,2)::VARCHAR, 'null') END"
        for c in ("op_setting_1", "op_setting_2")
    )
)
_COMPLETE = " AND ".join(f"{f} IS NOT NULL" for f in S.FEATURES)


def _scaler(by: str, source: str = "train") -> str:
    parts = (
        f"SELECT {by}, '{f}' AS feature, avg({f}) AS mean,"
        f" CASE WHEN stddev_pop({f}) = 0 THEN 1.0::DOUBLE ELSE stddev_pop({f}) END AS scale"
        f" FROM {source} GROUP BY {by}"
        for f in S.FEATURES
    )
    return " UNION ALL ".join(parts)


_STUDY = f"""{_silver()},{_features('least(rul, 125)', None)},{_SPLIT},
model_rows AS MATERIALIZED (
  SELECT f.*, {_CONDITION} AS op_cond, s.is_train
  FROM features f JOIN split s USING ({_KEY}) WHERE {_COMPLETE}
),
train AS (SELECT * FROM model_rows WHERE is_train),
test AS (SELECT * FROM model_rows WHERE NOT is_train),
by_condition AS MATERIALIZED ({_scaler('dataset_id, op_cond')}),
by_dataset AS MATERIALIZED ({_scaler('dataset_id')}),
spare AS MATERIALIZED (
  SELECT dataset_id, feature, avg(mean) AS mean, avg(scale) AS scale
  FROM by_condition GROUP BY dataset_id, feature
)"""

_MODEL = f"{_KEY}, cycle, rul, op_cond, " + ", ".join(
    f"{_rounded(f, 6)} AS {f}" for f in S.FEATURES
)


def _scaled(condition: bool) -> str:
    """Standardized feature rows, by unpivoting the features and pivoting back."""
    listed = ", ".join(S.FEATURES)
    keys = f"{_KEY}, cycle, rul, op_cond"
    if condition:
        value = "coalesce((x - c.mean) / c.scale, (x - g.mean) / (g.scale + 1e-8::DOUBLE))"
        joins = (
            "LEFT JOIN by_condition c USING (dataset_id, op_cond, feature)"
            " LEFT JOIN spare g USING (dataset_id, feature)"
        )
    else:
        value, joins = "(x - c.mean) / c.scale", "LEFT JOIN by_dataset c USING (dataset_id, feature)"
    back = ", ".join(f"max(z) FILTER (feature = '{f}') AS {f}" for f in S.FEATURES)
    return f"""{_STUDY},
long AS (UNPIVOT (SELECT {keys}, {listed} FROM model_rows) ON {listed} INTO NAME feature VALUE x),
standard AS (SELECT {keys}, feature, {_rounded(value, 6)} AS z FROM long {joins}),
 wide AS (SELECT {keys}, {back} FROM standard GROUP BY {keys})
SELECT * FROM wide"""


def _long_scaler(source: str, by: str) -> str:
    return (
        f"{_STUDY} SELECT {by}, feature, {_rounded('mean', 9)} AS mean,"
        f" {_rounded('scale', 9)} AS scale FROM {source}"
    )


def _checks() -> str:
    """The declared checks, one SELECT each."""
    def row(model: str, table: str, column: str, kind: str, fails: str) -> str:
        return (
            f"SELECT '{model}' AS model, '{column}' AS column_name, '{kind}' AS check_kind,"
            f" count(*) FILTER ({fails}) AS failures FROM {table}"
        )

    def accepted(model: str, table: str, column: str, values: tuple[str, ...]) -> str:
        listed = ", ".join(f"'{v}'" for v in values)
        return row(model, table, column, "accepted_values", f"{column} NOT IN ({listed})")

    declared = {
        ("staging", "valid"): ("engine_id", "cycle"),
        ("staging", "silver"): ("status",),
        ("health", "health"): ("dataset_id", "engine_id", "total_cycles", "life_category"),
        ("features", "features"): ("dataset_id", "engine_id", "cycle", "rul", "cycle_pct"),
        ("drift", "drift"): ("dataset_id", "engine_id", "s02_drift", "s04_drift", "s11_drift"),
    }
    rows = [
        row(model, table, c, "not_null", f"{c} IS NULL")
        for (model, table), columns in declared.items()
        for c in columns
    ]
    rows.append(accepted("staging", "silver", "status", S.STATUSES))
    rows.append(accepted("health", "health", "life_category", S.LIFE_CATEGORIES))
    return " UNION ALL ".join(rows)


def all_oracles() -> dict[str, str]:
    reading = ", ".join(READING)
    silver, bronze = _silver(), _BRONZE
    scores = f"{silver},{_scores()}"
    study = _STUDY
    periods, drift = f"{silver},{_PERIODS}", f"{silver},{_DRIFT}"

    def damaged(engine: str, where: str) -> str:
        tail = READING[20:]
        kept = ", ".join(f"CASE WHEN cycle % 101 <> 0 THEN {c} END AS {c}" for c in tail)
        return (
            f"{bronze} SELECT dataset_id, {engine} AS engine_id, {', '.join(READING[1:20])}, {kept}"
            f" FROM bronze WHERE {where}"
        )

    def period(name: str) -> str:
        means = ", ".join(f"{_rounded(f'{n}_{name}', 9)} AS {n}_{name}" for n in _DRIFT_NAMES)
        return f"{periods} SELECT {_KEY}, {means} FROM {name}"

    def counted(table: str, column: str, prefix: str = silver) -> str:
        return f"{prefix} SELECT {column}, count(*) AS row_count FROM {table} GROUP BY {column}"

    whole = f"{bronze} SELECT {reading}, dataset_id FROM bronze"
    rolling = ", ".join(
        f"{_rounded(_frame(f'avg({s})', n), 6)} AS {s}_avg_{n}"
        for s, n in (("sensor_02", 10), ("sensor_02", 30), ("sensor_04", 10))
    )
    error = "(125.0::DOUBLE * (1 - cycle_pct) - rul)"
    bodies = {
        "scan_readings": whole,
        "scan_glob": f"{bronze} SELECT {_KEY}, cycle, sensor_02 FROM bronze",
        "dataset_from_filename": counted("bronze", "dataset_id", bronze),
        "scan_permissive": damaged("CASE WHEN cycle % 103 <> 0 THEN engine_id END", "true"),
        "scan_malformed": damaged("engine_id", "cycle % 103 <> 0 AND sensor_03 IS NOT NULL"),
        "scan_layer": f"{silver} SELECT {_KEY}, cycle, status, rul FROM silver",
        "union_datasets": whole,
        "bronze_append": counted("bronze", "dataset_id", bronze),
        "bronze_appended_rows": whole,
        "stream_damaged": f"{bronze} SELECT dataset_id, engine_id, cycle, sensor_02,"
        " CASE WHEN cycle % 89 <> 0 THEN sensor_21 END AS sensor_21,"
        " CASE WHEN cycle % 79 <> 0 THEN 1704067200::BIGINT + cycle * 60 END AS emitted_second,"
        " false AS quarantined FROM bronze WHERE cycle % 73 <> 0"
        " UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, true FROM bronze WHERE cycle % 73 = 0",
        "stream_ingest": f"{bronze} SELECT {reading}, dataset_id,"
        " 1704067200::BIGINT + cycle * 60 AS emitted_second FROM bronze",
        "bronze_union": f"{silver} SELECT {reading}, dataset_id, status,"
        " dataset_id = 'FD004' AS from_stream FROM silver",
        "gold_write": f"{silver}, {_HEALTH.strip()},{_DRIFT}"
        + " UNION ALL ".join(
            f" SELECT '{name}' AS table_name, count(*) AS row_count FROM {table}"
            for name, table in (
                ("rolling_averages", "valid"), ("engine_health", "health"),
                ("ml_features", "valid"), ("sensor_drift", "drift"), ("anomaly_scores", "valid"),
            )
        ),
        "silver_valid": f"{silver} SELECT {reading}, dataset_id, status FROM valid",
        "silver_derived": f"{silver} SELECT {_KEY}, cycle, max_cycle, cycle_pct, rul FROM silver",
        "rul_capped": f"{silver} SELECT {_KEY}, cycle, rul, least(rul, 125) AS rul_capped FROM valid",
        "rows_by_dataset": counted("bronze", "dataset_id", bronze),
        "rows_by_status": counted("silver", "status"),
        "engine_count": f"{bronze} SELECT count(*) AS engines"
        f" FROM (SELECT DISTINCT {_KEY} FROM bronze)",
        "rolling_averages": f"{silver} SELECT {_KEY}, cycle, sensor_02, sensor_04, sensor_11,"
        f" {rolling} FROM valid",
        "engine_health": f"{silver},{_HEALTH} SELECT * FROM health",
        "health_top": f"{silver},{_HEALTH} SELECT * FROM health"
        f" ORDER BY total_cycles DESC, {_KEY} LIMIT 10",
        "stg_sensor_readings": f"{_silver('staging')} SELECT {reading}, dataset_id, status, max_cycle,"
        " cycle_pct, rul FROM silver",
        "mart_engine_health": f"{_silver('staging')},{_HEALTH} SELECT * FROM health",
        "mart_sensor_drift": f"{_silver('staging')},{_DRIFT} SELECT * FROM drift",
        "life_category_counts": f"{silver},{_HEALTH}"
        " SELECT life_category, count(*) AS engines FROM health GROUP BY life_category",
        "ml_features": f"{silver},{_features('rul')} SELECT * FROM features",
        "mart_ml_features": f"{_silver('staging')},{_features('least(rul, 125)')}"
        " SELECT * FROM features",
        "early_means": period("early"),
        "late_means": period("late"),
        "sensor_drift": f"{drift} SELECT * FROM drift",
        "sensor_drift_join": f"{drift} SELECT * FROM drift",
        "top_drift": f"{drift} SELECT * FROM drift ORDER BY abs(s02_drift) DESC, {_KEY} LIMIT 10",
        "anomaly_scores": f"{scores} SELECT * FROM scores",
        "anomaly_table": f"{scores} SELECT * FROM scores",
        "anomaly_summary": f"{scores} SELECT * FROM summary",
        "top_anomalous_engines": f"{scores} SELECT * FROM summary"
        f" ORDER BY s02_anomaly_pct DESC, {_KEY} LIMIT 10",
        "anomaly_rate": f"{scores} SELECT count(*) FILTER (s02_anomaly) AS anomalies,"
        " count(*) AS total_readings,"
        f" {_rounded('count(*) FILTER (s02_anomaly) / count(*)::DOUBLE * 100', 9)}"
        " AS anomaly_rate_pct FROM scores",
        "anomaly_by_life_stage": f"{scores} SELECT * FROM stages",
        "anomaly_points": f"{scores} SELECT {_KEY}, cycle, sensor_02, s02_zscore"
        " FROM scores WHERE s02_anomaly",
        "engine_trace": f"{scores} SELECT {_KEY}, cycle, sensor_02, s02_rolling_mean, s02_anomaly,"
        " rul FROM scores WHERE dataset_id = 'FD001' AND engine_id = 1",
        "rul_preview": f"{silver} SELECT {_KEY}, cycle, rul FROM valid"
        " WHERE dataset_id = 'FD001' AND engine_id = 1 ORDER BY cycle LIMIT 5",
        "op_condition": f"{silver} SELECT {_KEY}, cycle, {_CONDITION} AS op_cond FROM valid",
        "op_condition_missing": f"{silver}, spoiled AS (SELECT {_KEY}, cycle,"
        " CASE WHEN cycle % 7 = 0 THEN NULL WHEN cycle % 11 = 0 THEN 'nan'::DOUBLE"
        " ELSE op_setting_1 END AS op_setting_1,"
        " CASE WHEN cycle % 5 <> 0 THEN op_setting_2 END AS op_setting_2 FROM valid)"
        f" SELECT {_KEY}, cycle, {_CONDITION} AS op_cond FROM spoiled",
        "engine_split": f"{silver},{_SPLIT} SELECT * FROM split",
        "engine_split_fixed": f"{silver} SELECT DISTINCT {_KEY}, CASE"
        " WHEN dataset_id = 'FD001' AND engine_id BETWEEN 1 AND 80 THEN 'train'"
        " WHEN dataset_id = 'FD001' AND engine_id BETWEEN 81 AND 100 THEN 'test'"
        " ELSE 'neither' END AS part FROM valid",
        "engine_split_ranges": f"{silver} SELECT DISTINCT {_KEY}, CASE"
        " WHEN engine_id BETWEEN 1 AND 2 THEN 'train' WHEN engine_id = 3 THEN 'test'"
        " ELSE 'neither' END AS part FROM valid",
        "engine_split_rows": f"{silver},{_SPLIT} SELECT {_KEY}, cycle, rul FROM valid"
        f" WHERE ({_KEY}) IN (SELECT ({_KEY}) FROM split WHERE is_train)",
        "train_rows": f"{study} SELECT {_MODEL} FROM train",
        "test_rows": f"{study} SELECT {_MODEL} FROM test",
        "model_rows": f"{study} SELECT {_KEY}, cycle, is_train FROM model_rows",
        "rul_distribution": f"{study} SELECT dataset_id, min(rul) AS min_rul, max(rul) AS max_rul,"
        f" {_rounded('avg(rul)', 9)} AS mean_rul FROM train GROUP BY dataset_id",
        "scaler_global": _long_scaler("by_dataset", "dataset_id"),
        "scaler_per_condition": _long_scaler("by_condition", "dataset_id, op_cond"),
        "scaler_fallback": _long_scaler("spare", "dataset_id"),
        "condition_count": f"{study} SELECT dataset_id, count(DISTINCT op_cond) AS conditions"
        " FROM train GROUP BY dataset_id",
        "unseen_conditions": f"{study} SELECT DISTINCT dataset_id, op_cond FROM test"
        " WHERE (dataset_id, op_cond) NOT IN (SELECT (dataset_id, op_cond) FROM train)",
        "scaled_features": _scaled(True),
        "scaled_features_global": _scaled(False),
        "regression_metrics": f"{study} SELECT dataset_id,"
        f" {_rounded(f'sqrt(avg({error} * {error}))', 9)} AS rmse,"
        f" {_rounded(f'avg(abs({error}))', 9)} AS mae FROM test GROUP BY dataset_id",
        "feature_vectors": _scaled(True).removesuffix("SELECT * FROM wide")
        + f"SELECT {_KEY}, cycle, CASE WHEN {_COMPLETE} THEN [{', '.join(S.FEATURES)}] END AS features FROM wide",
        "rul_check": f"{study}, known AS (SELECT dataset_id, avg(rul) AS mean_rul,"
        " count(DISTINCT engine_id) AS train_engines FROM train GROUP BY dataset_id)"
        " SELECT dataset_id, count(*) AS test_rows, count(DISTINCT engine_id) AS test_engines,"
        f" max(train_engines) AS train_engines, {_rounded('sqrt(avg((mean_rul - rul) ** 2))', 9)} AS rmse_of_mean,"
        " true AS in_range, true AS importances_sum_to_one"
        " FROM test JOIN known USING (dataset_id) GROUP BY dataset_id",
        "display_sample": f"{study} SELECT {_KEY}, cycle, rul,"
        f" {_rounded('125.0::DOUBLE * (1 - cycle_pct)', 6)} AS guess FROM test"
        " QUALIFY row_number() OVER (PARTITION BY dataset_id"
        " ORDER BY md5(concat_ws('|', dataset_id, engine_id, cycle))) <= 200",
        "quality_report": f"{silver},{_HEALTH},{_features('rul')},{_DRIFT} {_checks()}",
        "rul_violations": f"{silver},"
        f" stepped AS (SELECT *, lag(rul) OVER (PARTITION BY {_KEY} ORDER BY cycle) AS prior"
        f" FROM valid) SELECT {_KEY}, count(*) AS readings,"
        f" count(*) FILTER (rul >= prior) AS violations FROM stepped GROUP BY {_KEY}",
        "late_stage_report": f"{scores} SELECT"
        " max(anomaly_rate_pct) FILTER (life_stage = 'late (RUL < 30)') AS late_rate_pct,"
        " max(anomaly_rate_pct) AS highest_rate_pct,"
        " max(anomaly_rate_pct) FILTER (life_stage = 'late (RUL < 30)') >= max(anomaly_rate_pct)"
        " AS late_is_highest FROM stages",
    }
    bodies |= {
        "gold_written_rolling_averages": bodies["rolling_averages"],
        "gold_written_engine_health": f"{silver},{_health(2, 3)} SELECT * FROM health",
        "gold_written_ml_features": f"{silver},{_features('rul', 3, 4)} SELECT * FROM features",
        "gold_written_sensor_drift": f"{silver},{_drift(3)} SELECT * FROM drift",
        "gold_written_anomaly_scores": bodies["anomaly_scores"],
    }
    ties = ", ".join(f"{c} NULLS FIRST" for c in ("cycle", *TIES))
    repeated = ", ".join(
        _rounded(_frame(f"avg({s})", n).replace("ORDER BY cycle", f"ORDER BY {ties}"), 6) + f" AS {s}_avg_{n}"
        for s, n in (("sensor_02", 10), ("sensor_02", 30), ("sensor_04", 10))
    )
    for name in ("whole", "blocked", "crowded"):
        bodies[f"rolling_averages_{name}"] = (
            f"{silver}, repeated AS (SELECT * REPLACE ("
            "CASE WHEN cycle % 50 <> 0 THEN cycle // 3 END AS cycle) FROM valid)"
            f" SELECT {_KEY}, cycle, sensor_02, sensor_04, sensor_11, {repeated} FROM repeated"
        )
    for name, rule in _STATUS.items():
        bodies[f"silver_status_{name}"] = (
            f"{bronze} SELECT {_KEY}, cycle, {rule} AS status FROM bronze"
        )
    bodies["quality_written"] = bodies["quality_report"]
    bodies |= load_queries.oracle_sql(bodies, silver)
    bodies |= stream_queries.oracle_sql(bronze, silver, _scores(), _STATUS["full"])
    return {name: f"WITH {body.strip()}" for name, body in bodies.items()}
