"""The same results in DuckDB SQL, built from a shared set of named subqueries."""

from __future__ import annotations

import re

from checks.adapters import AS_OF, CENSUS_AS_OF

NOTE_KEYWORD = "license"


def _mean(value: str, digits: int) -> str:
    """Average of whole non-negative numbers, rounded half up in integer arithmetic."""
    scale = 10**digits
    total = f"SUM(CAST({value} AS HUGEINT))"
    return (
        f"CAST((2 * {total} * {scale} + COUNT({value})) // (2 * COUNT({value})) AS DOUBLE) / {scale}"
    )


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _true(flag: str) -> str:
    return _big(f"SUM(CAST({flag} AS INT))")


CTES = {
    # Source rows -------------------------------------------------------------------
    "patients_cdc": """
SELECT CAST(c_custkey AS INT) AS patient_id, c_name AS mrn,
  'Given' || CAST(c_custkey AS VARCHAR) AS first_name,
  'Family' || CAST(c_custkey AS VARCHAR) AS last_name,
  CASE WHEN c_custkey % 41 = 40 THEN NULL WHEN c_custkey % 50 = 49 THEN 'unknown'
       WHEN c_custkey % 3 = 0 THEN CAST((c_custkey * 37) % 20000 - 12000 AS VARCHAR)
       ELSE '19' || CAST(30 + c_custkey % 70 AS VARCHAR) || '-06-15' END AS date_of_birth,
  CASE c_custkey % 6 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'male' WHEN 3 THEN 'Female'
       WHEN 4 THEN 'X' END AS gender,
  '900-' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-'
    || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS ssn,
  CASE WHEN c_custkey % 9 = 8 THEN NULL
       ELSE '555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
  lower(c_name) || '@example.com' AS email, c_mktsegment AS address,
  'INS-' || CAST(100000 + c_custkey AS VARCHAR)
    || CASE WHEN v.ver = 1 THEN '' ELSE '-R' END AS insurance_id,
  v.op AS op, v.ver AS ver
FROM customer
CROSS JOIN (SELECT 1 AS ver, 'c' AS op UNION ALL SELECT 2, 'u' UNION ALL SELECT 3, 'd') v
WHERE v.ver = 1 OR (v.ver = 2 AND c_custkey % 4 = 0) OR (v.ver = 3 AND c_custkey % 10 = 0)""",
    "adt_raw": """
SELECT CAST(event_id AS INT) AS event_id, CAST(user_id AS INT) AS patient_id,
  CASE event_type WHEN 'signup' THEN 'ADMIT' WHEN 'view' THEN 'ADMIT'
       WHEN 'purchase' THEN 'discharge' ELSE 'TRANSFER' END AS event_type,
  epoch_us(ts) AS event_timestamp, 'FAC-00' || CAST(1 + event_id % 3 AS VARCHAR) AS facility_id,
  CASE event_id % 6 WHEN 0 THEN 'ICU' WHEN 1 THEN 'Cardiology' WHEN 2 THEN 'Med-Surg'
       WHEN 3 THEN 'Maternity' WHEN 4 THEN 'Neuro-icu' END AS ward,
  'BED-' || CAST(100 + event_id % 40 AS VARCHAR) AS bed_number,
  'Dr. ' || CAST(event_id % 12 AS VARCHAR) AS attending_doctor,
  props AS reason, epoch_us(ts) AS created_at
FROM events""",
    "labs_raw": """
SELECT CAST(o_orderkey AS INT) AS result_id, CAST(o_custkey AS INT) AS patient_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'TROP' WHEN 1 THEN 'ABG' WHEN 2 THEN 'LACT' WHEN 3 THEN 'K'
       WHEN 4 THEN 'NA' WHEN 5 THEN 'HBA1C' WHEN 6 THEN 'CBC' ELSE 'BNP' END AS test_code,
  'Test ' || CAST(o_orderkey % 8 AS VARCHAR) AS test_name,
  CASE WHEN o_orderkey % 97 = 0 THEN 'POS' ELSE CAST(o_custkey % 500 AS VARCHAR) || '.'
       || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') END AS result_value,
  CASE WHEN o_orderkey % 2 = 0 THEN 'ng/mL' ELSE 'pH' END AS unit,
  CASE WHEN o_orderstatus = 'F' THEN 'H' WHEN o_orderstatus = 'O' THEN 'L'
       WHEN o_orderkey % 3 = 0 THEN 'N' WHEN o_orderkey % 3 = 1 THEN 'h' END AS abnormal_flag,
  epoch_us(o_orderdate) - (1 + o_orderkey % 200) * 60000000 AS collected_at,
  CASE WHEN o_orderkey % 11 <> 10 THEN epoch_us(o_orderdate) END AS resulted_at,
  epoch_us(o_orderdate) AS created_at
FROM orders""",
    "vitals_raw": """
SELECT l_orderkey * 8 + l_linenumber AS vital_id, CAST(l_partkey % 200 AS INT) AS patient_id,
  CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN 0
       ELSE CAST(35 + (l_orderkey * 7 + l_linenumber) % 120 AS INT) END AS heart_rate,
  CAST(70 + (l_orderkey * 3) % 200 AS INT) AS systolic_bp,
  CAST(25 + (l_suppkey * 11 + l_orderkey) % 140 AS INT) AS diastolic_bp,
  CASE WHEN l_partkey % 29 = 0 THEN NULL
       ELSE CAST(80 + (l_orderkey + l_partkey) % 22 AS INT) END AS spo2,
  CAST(880 + l_orderkey % 240 AS DOUBLE) / 10 AS temperature,
  epoch_us(l_shipdate) AS created_at, CAST(round(l_extendedprice * 100) AS BIGINT) AS tie
FROM lineitem""",
    "notes": """
SELECT CAST(doc_id AS INT) AS note_id, CAST(doc_id % 150 AS INT) AS patient_id,
  CASE doc_id % 4 WHEN 0 THEN 'ADMISSION' WHEN 1 THEN 'PROGRESS' WHEN 2 THEN 'NURSING'
       ELSE 'DISCHARGE' END AS note_type,
  source AS authored_by,
  make_timestamp(1704067200000000 + doc_id * 60000000) AS authored_at, text AS note_text
FROM documents""",
    # Bronze ------------------------------------------------------------------------
    "brz_patients": """
SELECT patient_id, mrn, date_of_birth, gender, insurance_id, op, ver,
  substr(sha256(mrn), 1, 16) AS mrn_hash, substr(sha256(ssn), 1, 16) AS ssn_masked,
  substr(sha256(phone), 1, 16) AS phone_masked, substr(sha256(email), 1, 16) AS email_masked,
  'patients' AS source_table
FROM patients_cdc""",
    "brz_adt": """
SELECT *, coalesce(event_type = 'ADMIT' AND contains(upper(ward), 'ICU'), FALSE) AS is_icu,
  'adt_events' AS source_table
FROM adt_raw""",
    "brz_labs": """
SELECT *, TRY_CAST(result_value AS DOUBLE) AS result_numeric,
  test_code IN ('TROP', 'ABG', 'LACT', 'K', 'NA') AND abnormal_flag IN ('H', 'L') AS is_critical,
  'lab_results' AS source_table
FROM labs_raw""",
    "vital_flags": """
SELECT *, concat_ws('|',
  CASE WHEN heart_rate <> 0 AND heart_rate > 130 THEN 'TACHYCARDIA' END,
  CASE WHEN heart_rate <> 0 AND heart_rate < 50 THEN 'BRADYCARDIA' END,
  CASE WHEN spo2 <> 0 AND spo2 < 90 THEN 'CRITICAL_LOW_SPO2' END,
  CASE WHEN systolic_bp <> 0 AND systolic_bp > 180 THEN 'HYPERTENSIVE_CRISIS' END) AS labels
FROM vitals_raw""",
    "brz_vitals": """
SELECT * EXCLUDE (labels), CASE WHEN labels = '' THEN 'NORMAL' ELSE labels END AS alert_flags,
  labels <> '' AS has_alerts, 'vitals' AS source_table
FROM vital_flags""",
    # Silver ------------------------------------------------------------------------
    "born": """
SELECT patient_id, ver, date_of_birth, gender,
  CASE WHEN TRY_CAST(date_of_birth AS INT) IS NOT NULL
       THEN DATE '1970-01-01' + TRY_CAST(date_of_birth AS INT)
       ELSE TRY_CAST(date_of_birth AS DATE) END AS date_of_birth_dt
FROM patients_cdc""",
    "aged": f"""
SELECT *, CAST(floor(date_diff('day', date_of_birth_dt, DATE '{AS_OF}') / CAST(365.25 AS DOUBLE)) AS BIGINT)
  AS age_years
FROM born""",
    "newest_patients": """
SELECT * FROM brz_patients
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ver DESC) = 1""",
    "slv_patients": f"""
SELECT p.patient_id, p.date_of_birth, p.insurance_id, p.op AS cdc_op,
  CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS updated_at,
  substr(md5(p.mrn), 1, 16) AS mrn_hash, a.date_of_birth_dt,
  CASE WHEN upper(p.gender) IN ('M', 'MALE') THEN 'M'
       WHEN upper(p.gender) IN ('F', 'FEMALE') THEN 'F' ELSE 'U' END AS gender,
  a.age_years,
  CASE WHEN a.age_years < 18 THEN 'PEDIATRIC' WHEN a.age_years < 65 THEN 'ADULT'
       ELSE 'SENIOR' END AS age_group,
  coalesce(upper(p.gender) IN ('M', 'MALE', 'F', 'FEMALE'), FALSE) AS dq_complete,
  CAST(DATE '1997-01-01' + CAST(p.patient_id % 400 + p.ver AS INT) AS TIMESTAMP) AS silver_ts
FROM newest_patients p JOIN aged a ON a.patient_id = p.patient_id AND a.ver = p.ver""",
    "patients": "SELECT * FROM slv_patients WHERE cdc_op <> 'd'",
    "adt": f"""
SELECT patient_id, event_id, upper(event_type) AS event_type, event_timestamp, facility_id, ward,
  bed_number, attending_doctor, reason, is_icu, created_at, 'c' AS cdc_op,
  make_timestamp(event_timestamp) AS event_time, make_timestamp(created_at) AS created_at_ts,
  TIMESTAMP '{AS_OF} 00:00:00' AS silver_ts
FROM brz_adt""",
    "labs": f"""
SELECT patient_id, result_id, test_code, test_name, result_value, unit, abnormal_flag,
  result_numeric, is_critical, collected_at, resulted_at, created_at, 'c' AS cdc_op,
  make_timestamp(created_at) AS result_time,
  CASE upper(abnormal_flag) WHEN 'H' THEN 'HIGH' WHEN 'L' THEN 'LOW' ELSE 'NORMAL' END
    AS abnormal_direction,
  abnormal_flag IN ('H', 'L') AS is_abnormal,
  TIMESTAMP '{AS_OF} 00:00:00' AS silver_ts
FROM brz_labs""",
    "scored": """
SELECT *,
  CASE WHEN spo2 <= 91 THEN 3 WHEN spo2 <= 93 THEN 2 WHEN spo2 <= 95 THEN 1 ELSE 0 END
    AS news_spo2_flag,
  CASE WHEN heart_rate <= 40 THEN 3 WHEN heart_rate <= 50 THEN 1 WHEN heart_rate <= 90 THEN 0
       WHEN heart_rate <= 110 THEN 1 WHEN heart_rate <= 130 THEN 2 ELSE 3 END AS news_hr_flag
FROM brz_vitals""",
    "risked": """
SELECT *, news_spo2_flag + news_hr_flag AS news2_score,
  CASE WHEN news_spo2_flag + news_hr_flag >= 5 THEN 'HIGH'
       WHEN news_spo2_flag + news_hr_flag >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS news2_risk
FROM scored""",
    "vitals": f"""
SELECT patient_id, vital_id,
  CAST(CASE WHEN heart_rate BETWEEN 30 AND 250 THEN heart_rate END AS DOUBLE) AS heart_rate,
  CAST(CASE WHEN systolic_bp BETWEEN 60 AND 250 THEN systolic_bp END AS DOUBLE) AS systolic_bp,
  CAST(CASE WHEN diastolic_bp BETWEEN 30 AND 150 THEN diastolic_bp END AS DOUBLE) AS diastolic_bp,
  CAST(CASE WHEN spo2 BETWEEN 50 AND 100 THEN spo2 END AS DOUBLE) AS spo2,
  CASE WHEN temperature BETWEEN 90 AND 110 THEN temperature END AS temperature,
  alert_flags, has_alerts, created_at, 'c' AS cdc_op, make_timestamp(created_at) AS recorded_at,
  news_spo2_flag, news_hr_flag, news2_score, news2_risk,
  TIMESTAMP '{AS_OF} 00:00:00' AS silver_ts
FROM risked
QUALIFY row_number() OVER (PARTITION BY vital_id ORDER BY created_at DESC, tie DESC) = 1""",
    # Gold --------------------------------------------------------------------------
    "latest_vitals": """
SELECT patient_id, systolic_bp AS latest_sbp, diastolic_bp AS latest_dbp,
  heart_rate AS latest_hr, spo2 AS latest_spo2, temperature AS latest_temp_f,
  news2_risk AS latest_news2_risk, recorded_at AS vitals_recorded_at
FROM vitals
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY recorded_at DESC, vital_id DESC) = 1""",
    "encounters": f"""
SELECT patient_id, COUNT(event_id) AS total_encounters,
  COUNT(*) FILTER (event_type = 'ADMIT') AS total_admits,
  MAX(event_time) AS last_admit_date, {_true("is_icu")} AS icu_admissions
FROM adt GROUP BY patient_id""",
    "labs_90d": f"""
SELECT patient_id, COUNT(result_id) AS lab_count_90d,
  {_true("is_abnormal")} AS abnormal_labs_90d, {_true("is_critical")} AS critical_labs_90d
FROM labs WHERE CAST(result_time AS DATE) >= DATE '{AS_OF}' - 90 GROUP BY patient_id""",
    "vital_ranges": """
SELECT *, CASE WHEN max_news2_score >= 5 THEN 'HIGH' WHEN max_news2_score >= 3 THEN 'MEDIUM'
               ELSE 'LOW' END AS news2_risk
FROM (SELECT patient_id, COUNT(vital_id) AS vital_count, AVG(systolic_bp) AS avg_sbp,
        MIN(spo2) AS min_spo2, MAX(heart_rate) AS max_hr, MAX(news2_score) AS max_news2_score
      FROM vitals GROUP BY patient_id)""",
    "patient_summary": """
SELECT patient_id, mrn_hash, gender, age_years, age_group, dq_complete, latest_sbp, latest_dbp,
  latest_hr, latest_spo2, latest_temp_f, latest_news2_risk, vitals_recorded_at,
  total_encounters, total_admits, icu_admissions, last_admit_date, lab_count_90d,
  abnormal_labs_90d, critical_labs_90d
FROM patients LEFT JOIN latest_vitals USING (patient_id) LEFT JOIN encounters USING (patient_id)
  LEFT JOIN labs_90d USING (patient_id)""",
    "encounter_metrics": """
SELECT event_id, patient_id, event_type, event_time, facility_id, ward, bed_number,
  attending_doctor, reason, is_icu, vital_count, avg_sbp, min_spo2, max_hr, max_news2_score,
  news2_risk
FROM adt LEFT JOIN vital_ranges USING (patient_id)""",
    "daily_census": """
SELECT CAST(event_time AS DATE) AS event_date, ward, event_type, COUNT(event_id) AS event_count
FROM adt GROUP BY ALL""",
    "critical_alerts": f"""
SELECT result_id, patient_id, mrn_hash, age_years, gender, test_name, test_code, result_numeric,
  unit, abnormal_direction, abnormal_flag, result_time
FROM labs LEFT JOIN patients USING (patient_id)
WHERE is_critical AND CAST(result_time AS DATE) >= DATE '{AS_OF}' - 7""",
    "dq_patients": f"""
SELECT CAST(silver_ts AS DATE) AS metric_date, COUNT(patient_id) AS patient_count,
  {_true("dq_complete")} AS dq_complete_count,
  CAST(SUM(CAST(dq_complete AS INT)) AS DOUBLE) / COUNT(patient_id) * 100 AS dq_completeness_pct
FROM patients GROUP BY ALL""",
    "dq_labs": f"""
SELECT CAST(result_time AS DATE) AS metric_date, COUNT(result_id) AS lab_count,
  {_true("is_abnormal")} AS abnormal_count, {_true("is_critical")} AS critical_count,
  CAST(SUM(CAST(is_critical AS INT)) AS DOUBLE) / COUNT(result_id) * 100 AS critical_rate_pct
FROM labs GROUP BY ALL""",
    "dq_vitals": f"""
SELECT CAST(recorded_at AS DATE) AS metric_date, COUNT(vital_id) AS vital_count,
  {_true("has_alerts")} AS alert_count
FROM vitals GROUP BY ALL""",
    "quality_dashboard": """
SELECT * FROM dq_patients FULL OUTER JOIN dq_labs USING (metric_date)
  FULL OUTER JOIN dq_vitals USING (metric_date)""",
    "note_weights": """
SELECT bucket, ln(((SELECT COUNT(*) FROM notes) + 1) / (COUNT(*) + 1)) + 1 AS weight FROM note_words GROUP BY bucket""",
    "odd_units": """
SELECT vec_id, len(v) AS dims, v, sqrt(list_dot_product(v, v)) + 1e-10 AS norm
FROM (SELECT vec_id, CASE WHEN vec_id % 10 = 0
        THEN list_append(CAST(embedding AS DOUBLE[]), CAST(vec_id % 7 AS DOUBLE)) ELSE CAST(embedding AS DOUBLE[]) END AS v
      FROM embeddings WHERE vec_id % 10 NOT IN (1, 2, 3))""",
    "odd_hits": """
SELECT q.vec_id AS query_id, c.vec_id AS note_id,
  round(list_dot_product(q.v, c.v) / (q.norm * c.norm), 12) AS score
FROM odd_units q JOIN odd_units c ON q.dims = c.dims
QUALIFY row_number() OVER (PARTITION BY q.vec_id
  ORDER BY round(list_dot_product(q.v, c.v) / (q.norm * c.norm), 12) DESC, c.vec_id DESC) <= 3""",
    # Retrieval ---------------------------------------------------------------------
    "units": """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v,
  sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) + 1e-10 AS norm
FROM embeddings""",
    "hits": """
SELECT q.vec_id AS query_id, c.vec_id AS note_id,
  round(list_dot_product(q.v, c.v) / (q.norm * c.norm), 12) AS score
FROM units q CROSS JOIN units c
QUALIFY row_number() OVER (PARTITION BY q.vec_id
  ORDER BY round(list_dot_product(q.v, c.v) / (q.norm * c.norm), 12) DESC, c.vec_id DESC) <= 3""",
    "found": """
SELECT h.query_id, n.*, round(h.score, 3) AS score, h.place
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, note_id DESC) AS place
      FROM hits) h
JOIN notes n USING (note_id)""",
}


def with_ctes(body: str) -> str:
    """The body preceded by the subqueries it names, directly or through another one."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                add(CTES[name])
                needed.append(name)

    add(body)
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {parts}\n{body}" if parts else body


def _summary(condition: str) -> str:
    return f"""SELECT patient_id, gender, age_years, latest_spo2, latest_news2_risk, icu_admissions,
      critical_labs_90d FROM patient_summary WHERE {condition}"""


def _domain(table: str, column: str, *allowed: str) -> str:
    values = ", ".join(f"'{v}'" for v in allowed)
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, COUNT(*) AS row_count,
      COUNT(*) - COUNT({column}) AS null_count,
      COUNT(*) FILTER ({column} NOT IN ({values})) AS violation_count FROM {table}"""


def _orphans(child: str) -> str:
    return f"""SELECT '{child}' AS child, 'patient_summary' AS parent, COUNT(*) AS orphan_rows,
      COUNT(DISTINCT patient_id) AS orphan_keys FROM {child} t
      WHERE patient_id IS NOT NULL AND NOT EXISTS (
        SELECT 1 FROM patient_summary p WHERE p.patient_id = t.patient_id)"""


def _health(layer: str, name: str, table: str, minutes: str, status: str) -> str:
    return f"""SELECT '{layer}' AS layer, '{name}' AS table_name, COUNT(*) AS row_count,
      CAST({minutes} AS DOUBLE) AS age_minutes, '{status}' AS status FROM {table}"""


_RISKS = ("HIGH", "MEDIUM", "LOW")
_EVENTS = ("ADMIT", "DISCHARGE", "TRANSFER")
_DOC_RESPONSE = "'```sql' || chr(10) || text || chr(10) || '```' || chr(10)"
_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"
_PROSE = " OR ".join(
    f"starts_with(lower(line), '{start}')"
    for start in (
        "here", "this query", "the query", "note:", "explanation", "this sql", "i''ll",
        "this will", "the following",
    )
)
_SHOWN = "coalesce(CAST({} AS VARCHAR), 'None')"


def _text(*parts: str) -> str:
    """Concatenation of literals and, where a part starts with @, of shown columns."""
    return " || ".join(
        _SHOWN.format(p[1:]) if p.startswith("@") else "'" + p + "'" for p in parts
    )


_ABOUT = _text(
    "  Patient ", "@patient_id", ": age=", "@age_years", " gender=", "@gender", " NEWS2=",
    "@latest_news2_risk", " SpO2=", "@latest_spo2", "% HR=", "@latest_hr", "bpm SBP=",
    "@latest_sbp", "mmHg ICU=", "@icu_admissions", " critical_labs=", "@critical_labs_90d",
)
_ALERT = _text(
    "  Patient ", "@patient_id", ": ", "@test_name", " = ", "@result_numeric", " ", "@unit",
    " (", "@abnormal_direction", ")",
)
_NOTE_BLOCK = (
    _text(
        "[Patient ", "@patient_id", " | ", "@note_type", " by ", "@authored_by",
        " | similarity=", "@score", " | ",
    )
    + " || strftime(authored_at, '%Y-%m-%d %H:%M') || ']' || chr(10) || note_text"
)

_EMBED_TEXT = _text("Patient ", "@patient_id", " | ", "@note_type", " by ", "@authored_by", ": ", "@note_text")
CTES["note_words"] = rf"""
SELECT note_id, CAST(('0x' || substr(md5(word), 1, 8))::BIGINT % 256 AS INT) AS bucket, COUNT(*) AS n
FROM (SELECT note_id, unnest(regexp_split_to_array(lower({_EMBED_TEXT}), '[ \t\n\x0b\f\r]+')) AS word FROM notes)
WHERE word <> '' GROUP BY ALL"""

BODIES = {
    # Sources and sinks
    "src_parquet": "SELECT o_orderkey, o_custkey, o_orderdate FROM orders",
    "src_json_parse_union": """
SELECT 'ehr.public.patients' AS topic, CAST(patient_id AS BIGINT) AS patient_id,
  CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS result_id,
  CAST(NULL AS BIGINT) AS vital_id, CAST(NULL AS VARCHAR) AS event_type,
  CAST(NULL AS VARCHAR) AS test_code, gender, CAST(NULL AS INT) AS heart_rate,
  CAST(NULL AS DOUBLE) AS temperature, CAST(NULL AS VARCHAR) AS created_at
FROM patients_cdc
UNION ALL SELECT 'ehr.public.adt_events', patient_id, event_id, NULL, NULL, event_type, NULL, NULL,
  NULL, NULL, CAST(created_at AS VARCHAR) FROM adt_raw
UNION ALL SELECT 'ehr.public.lab_results', patient_id, NULL, result_id, NULL, NULL, test_code, NULL,
  NULL, NULL, CAST(created_at AS VARCHAR) FROM labs_raw
UNION ALL SELECT 'ehr.public.vitals', patient_id, NULL, NULL, vital_id, NULL, NULL, NULL,
  heart_rate, temperature, CAST(created_at AS VARCHAR) FROM vitals_raw""",
    "src_json_parse_topic": """
SELECT vital_id, CAST(patient_id AS BIGINT) AS patient_id, heart_rate, systolic_bp, diastolic_bp,
  spo2, temperature, created_at, created_at // 86400000000 * 10000000000 + tie AS kafka_offset,
  'c' AS cdc_op
FROM vitals_raw""",
    "src_topic_route": f"""
SELECT 'patients' AS table_name, COUNT(*) AS row_count, {_big("SUM(patient_id)")} AS key_sum FROM patients_cdc
UNION ALL SELECT 'adt_events', COUNT(*), {_big("SUM(event_id)")} FROM adt_raw
UNION ALL SELECT 'lab_results', COUNT(*), {_big("SUM(result_id)")} FROM labs_raw
UNION ALL SELECT 'vitals', COUNT(*), {_big("SUM(vital_id)")} FROM vitals_raw""",
    "src_delta_fallback": "SELECT * FROM daily_census",
    "src_view_register": """
SELECT c_mktsegment, COUNT(*) AS order_count FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment""",
    "snk_merge_cdc": """
SELECT patient_id, mrn, insurance_id, op, ver FROM (
  SELECT *, first_value(op) OVER newest AS last_op, row_number() OVER newest AS place
  FROM patients_cdc WINDOW newest AS (PARTITION BY patient_id ORDER BY ver DESC))
WHERE place = 1 AND last_op <> 'd'""",
    "chk_bronze_peek": """
SELECT patient_id, mrn_hash, gender, ver AS pipeline_ts FROM brz_patients
ORDER BY patient_id, ver LIMIT 10""",
    "chk_bronze_count": "SELECT COUNT(*) AS row_count FROM brz_patients",
    "snk_stream_append": """
SELECT CAST(event_id AS BIGINT) AS event_id, CAST(patient_id AS BIGINT) AS patient_id, event_type,
  ward, is_icu, 'c' AS cdc_op FROM brz_adt""",
    "snk_foreach_batch": """
SELECT CAST(result_id AS BIGINT) AS result_id, test_code, result_numeric, is_critical,
  'c' AS cdc_op FROM brz_labs""",
    "snk_gold_overwrite": "SELECT * FROM daily_census",
    # Bronze
    "brz_mask_pii": """
SELECT patient_id, ver, ssn_masked, phone_masked, email_masked FROM brz_patients""",
    "brz_patients": "SELECT * FROM brz_patients",
    "brz_adt": "SELECT event_id, patient_id, event_type, ward, is_icu, source_table FROM brz_adt",
    "brz_labs": """
SELECT result_id, test_code, abnormal_flag, result_value, result_numeric, is_critical, source_table
FROM brz_labs""",
    "brz_vitals": """
SELECT vital_id, tie, heart_rate, spo2, systolic_bp, alert_flags, has_alerts, source_table
FROM brz_vitals""",
    "brz_live_filter": "SELECT patient_id, mrn_hash, ver FROM brz_patients WHERE op <> 'd'",
    "brz_tombstone": """
SELECT CAST(patient_id AS BIGINT) AS patient_id, mrn, op AS cdc_op,
  CAST(patient_id * 3 + ver AS BIGINT) AS kafka_offset FROM patients_cdc""",
    # Silver
    "slv_key_filter": "SELECT vital_id, patient_id, tie FROM vitals_raw WHERE tie % 5 <> 0",
    "slv_cdc_op": "SELECT patient_id, ver, op AS cdc_op FROM patients_cdc",
    "slv_mrn_hash": """
SELECT patient_id, ver, substr(md5(mrn), 1, 16) AS mrn_hash FROM patients_cdc""",
    "slv_dob": "SELECT patient_id, ver, date_of_birth, date_of_birth_dt FROM born",
    "slv_age": "SELECT patient_id, ver, age_years FROM aged",
    "slv_age_group": """
SELECT patient_id, ver, age_years, CASE WHEN age_years < 18 THEN 'PEDIATRIC'
  WHEN age_years < 65 THEN 'ADULT' ELSE 'SENIOR' END AS age_group FROM aged""",
    "slv_gender": """
SELECT patient_id, ver, CASE WHEN upper(gender) IN ('M', 'MALE') THEN 'M'
  WHEN upper(gender) IN ('F', 'FEMALE') THEN 'F' ELSE 'U' END AS gender FROM patients_cdc""",
    "slv_dq_complete": "SELECT patient_id, dq_complete FROM slv_patients",
    "slv_event_time": "SELECT event_id, event_time, created_at_ts FROM adt",
    "slv_event_type": "SELECT event_id, event_type, is_icu FROM adt",
    "slv_lab_direction": "SELECT result_id, abnormal_direction FROM labs",
    "slv_is_abnormal": "SELECT result_id, is_abnormal FROM labs",
    "slv_news_spo2": "SELECT vital_id, tie, spo2, news_spo2_flag FROM scored",
    "slv_news_hr": "SELECT vital_id, tie, heart_rate, news_hr_flag FROM scored",
    "slv_news2": "SELECT vital_id, tie, news2_score, news2_risk FROM risked",
    "slv_vital_bounds": """
SELECT vital_id, tie,
  CASE WHEN systolic_bp BETWEEN 60 AND 250 THEN systolic_bp END AS systolic_bp,
  CASE WHEN diastolic_bp BETWEEN 30 AND 150 THEN diastolic_bp END AS diastolic_bp,
  CASE WHEN heart_rate BETWEEN 30 AND 250 THEN heart_rate END AS heart_rate,
  CASE WHEN spo2 BETWEEN 50 AND 100 THEN spo2 END AS spo2,
  CASE WHEN temperature BETWEEN 90 AND 110 THEN temperature END AS temperature
FROM vitals_raw""",
    "slv_cast_vitals": """
SELECT vital_id, tie, CAST(systolic_bp AS DOUBLE) AS systolic_bp,
  CAST(diastolic_bp AS DOUBLE) AS diastolic_bp, CAST(heart_rate AS DOUBLE) AS heart_rate,
  CAST(spo2 AS DOUBLE) AS spo2, temperature FROM vitals_raw""",
    "slv_dedupe_latest": """
SELECT vital_id, patient_id, created_at, tie FROM vitals_raw
QUALIFY row_number() OVER (PARTITION BY vital_id ORDER BY created_at DESC, tie DESC) = 1""",
    "slv_patients": "SELECT * FROM slv_patients",
    "slv_adt": "SELECT * FROM adt",
    "slv_labs": "SELECT * FROM labs",
    "slv_vitals": "SELECT * FROM vitals",
    # Joins
    "join_left_chain": """
SELECT patient_id, latest_hr, total_encounters, lab_count_90d FROM patient_summary""",
    "join_left_agg": """
SELECT event_id, patient_id, vital_count, max_news2_score FROM encounter_metrics""",
    "join_left_dim": """
SELECT result_id, patient_id, gender, age_years FROM labs LEFT JOIN patients USING (patient_id)
WHERE is_critical""",
    "join_full_outer_using": """
SELECT metric_date, patient_count, lab_count, vital_count FROM quality_dashboard""",
    "join_merge_key": """
SELECT patient_id, mrn, ver FROM patients_cdc GROUP BY patient_id, mrn, ver
HAVING ver = 1 AND NOT (patient_id % 4 = 0 OR patient_id % 10 = 0)""",
    "join_notes": """
SELECT note_id, patient_id, note_type, gender, latest_news2_risk
FROM notes JOIN patient_summary USING (patient_id)""",
    "join_id_filter": """
SELECT 'STRUCTURED DATA' AS section, COUNT(*) AS line_count, COUNT(DISTINCT patient_id) AS patient_count
FROM patient_summary WHERE patient_id IN (SELECT patient_id FROM notes)
UNION ALL SELECT 'CRITICAL ALERTS', COUNT(*), COUNT(DISTINCT patient_id)
FROM critical_alerts WHERE patient_id IN (SELECT patient_id FROM notes)""",
    # Aggregations, marts, windows
    "agg_encounters": "SELECT * FROM encounters",
    "agg_labs_90d": "SELECT * FROM labs_90d",
    "agg_vitals": "SELECT * FROM vital_ranges",
    "agg_dq_patients": "SELECT * FROM dq_patients",
    "agg_dq_labs": "SELECT * FROM dq_labs",
    "agg_dq_vitals": "SELECT * FROM dq_vitals",
    "gold_patient_summary": "SELECT * FROM patient_summary",
    "gold_encounter_metrics": "SELECT * FROM encounter_metrics",
    "gold_daily_census": "SELECT * FROM daily_census",
    "gold_critical_alerts": "SELECT * FROM critical_alerts",
    "gold_quality_dashboard": "SELECT * FROM quality_dashboard",
    "gold_lab_turnaround": """
SELECT CAST(make_timestamp(resulted_at) AS DATE) AS metric_date, test_code,
  COUNT(*) AS result_count, AVG((resulted_at - collected_at) / 60000000) AS avg_minutes,
  MIN((resulted_at - collected_at) / 60000000) AS min_minutes,
  MAX((resulted_at - collected_at) / 60000000) AS max_minutes
FROM labs WHERE resulted_at IS NOT NULL AND collected_at IS NOT NULL GROUP BY ALL""",
    "gold_turnaround_quantiles": """
SELECT test_code, CAST(date_trunc('month', make_timestamp(resulted_at)) AS DATE) AS month, COUNT(*) AS result_count,
  TRUE AS p50_within, TRUE AS p95_within
FROM labs WHERE resulted_at IS NOT NULL AND collected_at IS NOT NULL GROUP BY ALL""",
    "win_latest_per_key": """
SELECT patient_id, op, ver, insurance_id FROM patients_cdc
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ver DESC) = 1""",
    "win_latest_vitals": "SELECT * FROM latest_vitals",
    # Reports
    "q1_population": f"""
SELECT COUNT(*) AS total_patients, {_mean("age_years", 1)} AS avg_age,
  {_big("SUM(CASE gender WHEN 'F' THEN 1 END)")} AS female,
  {_big("SUM(CASE gender WHEN 'M' THEN 1 END)")} AS male,
  {_mean("total_encounters", 1)} AS avg_encounters,
  {_big("SUM(icu_admissions)")} AS total_icu_admissions,
  {_big("SUM(critical_labs_90d)")} AS total_critical_labs_90d
FROM patient_summary""",
    "q2_age_groups": f"""
SELECT age_group, COUNT(*) AS patient_count, {_mean("total_encounters", 1)} AS avg_encounters,
  {_mean("critical_labs_90d", 2)} AS avg_critical_labs, {_big("SUM(icu_admissions)")} AS total_icu
FROM patient_summary GROUP BY age_group""",
    "q3_top_critical": """
SELECT patient_id, mrn_hash, age_years, gender, age_group, total_encounters, icu_admissions,
  abnormal_labs_90d, critical_labs_90d, latest_sbp, latest_spo2, latest_news2_risk
FROM patient_summary
ORDER BY critical_labs_90d DESC NULLS LAST, abnormal_labs_90d DESC NULLS LAST, patient_id
LIMIT 10""",
    "q4_wards": f"""
SELECT ward, COUNT(*) AS encounters, COUNT(*) FILTER (is_icu) AS icu_count,
  round(AVG(avg_sbp), 1) AS avg_sbp, {_mean("min_spo2", 1)} AS avg_min_spo2
FROM encounter_metrics WHERE event_type = 'ADMIT' GROUP BY ward""",
    "q5_risk_dist": f"""
SELECT news2_risk, COUNT(*) AS encounter_count, round(AVG(avg_sbp), 1) AS avg_sbp,
  {_mean("min_spo2", 1)} AS avg_min_spo2, {_mean("max_hr", 1)} AS avg_max_hr
FROM encounter_metrics WHERE news2_risk IS NOT NULL GROUP BY news2_risk""",
    "q6_census_pivot": f"""
SELECT event_date, {_big("coalesce(SUM(event_count) FILTER (event_type = 'ADMIT'), 0)")} AS admissions,
  {_big("coalesce(SUM(event_count) FILTER (event_type = 'DISCHARGE'), 0)")} AS discharges,
  {_big("coalesce(SUM(event_count) FILTER (event_type = 'TRANSFER'), 0)")} AS transfers,
  {_big("SUM(event_count)")} AS total_events
FROM daily_census GROUP BY event_date ORDER BY event_date DESC NULLS LAST LIMIT 14""",
    "q7_busiest_wards": f"""
SELECT ward, {_big("SUM(event_count)")} AS total_events,
  {_big("coalesce(SUM(event_count) FILTER (event_type = 'ADMIT'), 0)")} AS admissions
FROM daily_census GROUP BY ward""",
    "q8_alert_list": """
SELECT result_id, mrn_hash, age_years, gender, test_name, test_code, result_numeric, unit,
  abnormal_direction, result_time
FROM critical_alerts ORDER BY result_time DESC NULLS LAST, result_id LIMIT 20""",
    "q9_alerts_by_test": f"""
SELECT test_name, test_code, COUNT(*) AS alert_count,
  {_big("SUM(CASE abnormal_direction WHEN 'HIGH' THEN 1 END)")} AS high_count,
  {_big("SUM(CASE abnormal_direction WHEN 'LOW' THEN 1 END)")} AS low_count,
  {_mean("CAST(round(result_numeric * 100) AS BIGINT)", 0)} / 100 AS avg_value,
  {_mean("age_years", 1)} AS avg_patient_age
FROM critical_alerts GROUP BY test_name, test_code""",
    "q10_dq_kpis": """
SELECT metric_date, patient_count, dq_complete_count,
  round(dq_completeness_pct, 1) AS completeness_pct, lab_count, abnormal_count, critical_count,
  round(critical_rate_pct, 2) AS critical_rate_pct, vital_count, alert_count
FROM quality_dashboard ORDER BY metric_date DESC NULLS LAST LIMIT 30""",
    # Described layer and questions
    "sem_domain_check": " UNION ALL ".join(
        [
            _domain("patient_summary", "gender", "M", "F"),
            _domain("patient_summary", "age_group", "SENIOR", "PEDIATRIC"),
            _domain("patient_summary", "latest_news2_risk", *_RISKS),
            _domain("critical_alerts", "gender", "M", "F"),
            _domain("critical_alerts", "abnormal_direction", "HIGH", "LOW"),
            _domain("encounter_metrics", "event_type", *_EVENTS),
            _domain("encounter_metrics", "news2_risk", *_RISKS),
            _domain("daily_census", "event_type", *_EVENTS),
            _domain("notes", "note_type", "ADMISSION", "PROGRESS", "NURSING", "DISCHARGE").replace(
                "'notes' AS", "'clinical_notes' AS"
            ),
        ]
    ),
    "sem_relationship_check": " UNION ALL ".join(
        [
            _orphans("critical_alerts"),
            _orphans("encounter_metrics"),
            _orphans("notes").replace("'notes' AS", "'clinical_notes' AS"),
        ]
    ),
    "sem_sql_clean": f"""
SELECT doc_id, CASE WHEN length(sql_text) >= 10 THEN sql_text END AS sql_text,
  length(sql_text) >= 10 AS is_valid
FROM (SELECT doc_id, trim(array_to_string(list_filter(
          string_split(trim(response, {_BLANKS}), chr(10)),
          lambda line: NOT ({_PROSE} OR starts_with(trim(line, {_BLANKS}), '```'))), chr(10)),
        {_BLANKS}) AS sql_text
  FROM (SELECT doc_id, CASE doc_id % 6
      WHEN 0 THEN text
      WHEN 1 THEN '```sql' || chr(10) || text || chr(10) || '```'
      WHEN 2 THEN 'Here is the query:' || chr(10) || '  ' || text || chr(10) || chr(10)
        || 'This query reads one table.'
      WHEN 3 THEN 'NOTE: none' || chr(10) || text
      WHEN 4 THEN ' ' || chr(10) || chr(9) || '```' || chr(10) || 'SELECT '
        || CAST(doc_id AS VARCHAR) || chr(10) || ' ```  ' || chr(10) || 'Explanation: ' || text
      ELSE 'note: ' || text || chr(10) || chr(9) || text END AS response FROM documents
    UNION ALL SELECT doc_id, 'NOTE: none' || chr(10) || left(text, 4) FROM documents
    UNION ALL SELECT doc_id, '' FROM documents))""",
    "sem_fence_strip": f"""
SELECT doc_id, trim(replace(replace({_DOC_RESPONSE}, '```sql', ''), '```', ''), {_BLANKS}) AS sql_text
FROM documents""",
    "sem_run_sql": """
SELECT coalesce(CAST(patient_id AS VARCHAR), '—') AS patient_id,
  coalesce(mrn_hash, '—') AS mrn_hash, coalesce(age_group, '—') AS age_group,
  coalesce(CAST(total_encounters AS VARCHAR), '—') AS total_encounters,
  coalesce(latest_news2_risk, '—') AS latest_news2_risk
FROM (SELECT * FROM patient_summary ORDER BY patient_summary.patient_id LIMIT 100)""",
    "nl_icu_patients": _summary("icu_admissions > 0"),
    "nl_critical_patients": _summary("critical_labs_90d > 0"),
    "nl_high_risk_spo2": _summary("latest_news2_risk = 'HIGH' AND latest_spo2 < 92"),
    "nl_female_over_60": _summary("gender = 'F' AND age_years > 60"),
    "nl_admissions_week": f"""
SELECT ward, {_big("SUM(event_count)")} AS admissions FROM daily_census
WHERE event_type = 'ADMIT' AND event_date >= DATE '{CENSUS_AS_OF}' - 7 GROUP BY ward""",
    "nl_risk_counts": """
SELECT latest_news2_risk, COUNT(*) AS patient_count FROM patient_summary GROUP BY ALL""",
    "nl_note_search": f"""
SELECT note_id, patient_id, authored_by, gender, latest_news2_risk
FROM notes JOIN patient_summary USING (patient_id)
WHERE lower(note_text) LIKE '%{NOTE_KEYWORD}%'""",
    "nl_note_search_indexed": f"""
SELECT note_id, patient_id, authored_by, gender, latest_news2_risk
FROM notes JOIN patient_summary USING (patient_id)
WHERE lower(note_text) LIKE '%{NOTE_KEYWORD}%'""",
    "nl_notes_by_author": """
SELECT authored_by, COUNT(*) AS note_count FROM notes GROUP BY authored_by
ORDER BY note_count DESC, authored_by LIMIT 1""",
    # Retrieval
    "rag_note_text": f"""
SELECT note_id, {_text("Patient ", "@patient_id", " | ", "@note_type", " by ", "@authored_by", ": ", "@note_text")}
  AS embed_text FROM notes""",
    "rag_embed": """
SELECT note_id, bucket, CAST(round(CAST(value / norm AS FLOAT), 4) AS DECIMAL(7,4)) AS value
FROM (SELECT *, sqrt(SUM(value * value) OVER (PARTITION BY note_id)) AS norm
      FROM (SELECT note_id, bucket, n * weight AS value FROM note_words JOIN note_weights USING (bucket)))""",
    "rag_topk_odd_vectors": "SELECT query_id, note_id, round(score, 3) AS score FROM odd_hits",
    "rag_cosine_topk": "SELECT query_id, note_id, round(score, 3) AS score FROM hits",
    "rag_cosine_cells": "SELECT query_id, note_id, round(score, 3) AS score FROM hits",
    "rag_structured_ctx": f"""
SELECT 'STRUCTURED DATA' AS section, patient_id, CAST(NULL AS BIGINT) AS result_id,
  {_ABOUT} AS line
FROM patient_summary WHERE patient_id IN (SELECT patient_id FROM found)
UNION ALL SELECT 'CRITICAL ALERTS', patient_id, result_id, {_ALERT}
FROM critical_alerts WHERE patient_id IN (SELECT patient_id FROM found)""",
    "rag_note_ctx": f"""
SELECT query_id, string_agg(block, chr(10) || chr(10) ORDER BY place) AS context
FROM (SELECT query_id, place, {_NOTE_BLOCK} AS block FROM found) GROUP BY query_id""",
    "rag_notes_used": """
SELECT query_id, place, patient_id, note_type, authored_by, score,
  substring(note_text, 1, 200) || '...' AS text FROM found""",
    "rag_patient_ids": "SELECT DISTINCT query_id, patient_id FROM found",
    # Metrics and streaming
    "met_topic_offsets": """
SELECT event_type AS topic, CAST(user_id % 3 AS INT) AS "partition",
  MIN(event_id) AS earliest_offset, MAX(event_id) + 1 AS latest_offset,
  MAX(event_id) + 1 - MIN(event_id) AS total_messages FROM events GROUP BY ALL""",
    "met_topic_health": """
SELECT topic, coalesce(latest_offset, -1) AS latest_offset, coalesce(total_messages, -1) AS total_messages
FROM (VALUES ('signup'), ('view'), ('never sent')) t(topic) LEFT JOIN (
  SELECT topic, CAST(SUM(latest) AS BIGINT) AS latest_offset, CAST(SUM(latest - earliest) AS BIGINT) AS total_messages
  FROM (SELECT event_type AS topic, user_id % 3 AS part, MAX(event_id) + 1 AS latest, MIN(event_id) AS earliest
        FROM events GROUP BY ALL) GROUP BY topic) USING (topic)""",
    "met_stream_listener": """
SELECT 'bronze_lab_results' AS entity, metric, CAST(CASE WHEN metric IN ('num_input_rows', 'records_read')
  THEN (SELECT COUNT(*) FROM labs_raw) ELSE 0 END AS DOUBLE) AS value
FROM (VALUES ('num_input_rows'), ('records_read'), ('tombstones'), ('records_without_key')) m(metric)""",
    "met_layer_health": " UNION ALL ".join(
        [
            _health("gold", name, name, "12.0", "ok")
            for name in (
                "patient_summary", "encounter_metrics", "daily_census", "critical_alerts",
                "quality_dashboard",
            )
        ]
        + [
            """SELECT 'gold' AS layer, 'lab_turnaround' AS table_name, COUNT(*) AS row_count,
      CAST(12 AS DOUBLE) AS age_minutes, 'ok' AS status
      FROM (SELECT DISTINCT CAST(make_timestamp(resulted_at) AS DATE), test_code FROM labs
            WHERE resulted_at IS NOT NULL)""",
            _health("bronze", "patients", "brz_patients", "-1", "ok"),
            _health("bronze", "adt_events", "brz_adt", "-1", "ok"),
            _health("bronze", "lab_results", "brz_labs", "-1", "ok"),
            _health("bronze", "vitals", "brz_vitals", "-1", "ok"),
        ]
    ),
    "str_bronze_multi": """
SELECT 'patients' AS source_table, CAST(patient_id AS BIGINT) AS row_key, op AS cdc_op
FROM patients_cdc
UNION ALL SELECT 'adt_events', event_id, 'c' FROM adt_raw
UNION ALL SELECT 'lab_results', result_id, 'c' FROM labs_raw
UNION ALL SELECT 'vitals', vital_id, 'c' FROM vitals_raw""",
    "str_silver_upsert": """
SELECT vital_id, CAST(patient_id AS BIGINT) AS patient_id, heart_rate, spo2, recorded_at,
  news2_score, alert_flags FROM vitals""",
    "pipe_run": "SELECT * FROM patient_summary",
}

BODIES["met_published_health"] = " UNION ALL ".join(_health("gold", n, n, "12.0", "ok") for n in ("encounter_metrics", "daily_census"))
BODIES["str_record_limit"] = "SELECT event_id, TRUE AS within_limit FROM brz_adt"
BODIES["str_rate_limit"] = "SELECT event_id, CAST(0 AS INT) AS batches_not_of_one_file FROM brz_adt"
BODIES["report_runner"] = " UNION ALL ".join(
    f"SELECT '{name}' AS name, COUNT(*) AS row_count FROM (SELECT * FROM ({BODIES[name]}) r)"
    for name in (
        "q1_population", "q2_age_groups", "q3_top_critical", "q4_wards", "q5_risk_dist", "q6_census_pivot",
        "q7_busiest_wards", "q8_alert_list", "q9_alerts_by_test", "q10_dq_kpis",
    )
) + " UNION ALL SELECT 'nonsense', -1"

BODIES["snk_schema_merge"] = """
SELECT CAST(event_id AS BIGINT) AS event_id, ward, CASE WHEN event_id % 2 = 1 THEN CAST(event_id % 5 AS BIGINT) END AS triage,
  CASE WHEN event_id % 2 = 1 THEN 'x' END AS unit FROM adt_raw"""
_LOG = 'SELECT CAST(patient_id AS BIGINT) * 3 + ver AS "offset" FROM patients_cdc'
BODIES["src_dead_letters"] = f"""
SELECT "offset", 'row' AS went, COUNT(*) AS n FROM ({_LOG}) GROUP BY ALL
UNION ALL SELECT "offset", 'not a JSON object', COUNT(*) FROM ({_LOG}) WHERE "offset" % 5 = 0 GROUP BY ALL
UNION ALL SELECT "offset", 'no key', COUNT(*) FROM ({_LOG}) WHERE "offset" % 7 = 0 GROUP BY ALL"""
BODIES["snk_merge_on_read"] = BODIES["snk_merge_cdc"]
TURNAROUND = """(SELECT CAST(make_timestamp(resulted_at) AS DATE) AS metric_date, test_code, COUNT(*) AS result_count,
  MIN((resulted_at - collected_at) / 60000000) AS min_minutes, MAX((resulted_at - collected_at) / 60000000) AS max_minutes
  FROM labs WHERE resulted_at IS NOT NULL GROUP BY ALL)"""
MART_ROWS = {
    "patient_summary": "patient_id, gender, latest_news2_risk, total_encounters, latest_hr, lab_count_90d, icu_admissions",
    "encounter_metrics": "event_id, ward, news2_risk, vital_count, max_hr, min_spo2, max_news2_score",
    "daily_census": "event_date, ward, event_type, event_count, NULL, NULL, NULL",
    "critical_alerts": "result_id, gender, test_code, age_years, result_numeric, NULL, NULL",
    "quality_dashboard": "metric_date, NULL, NULL, lab_count, vital_count, alert_count, abnormal_count",
    "lab_turnaround": "metric_date, test_code, NULL, result_count, min_minutes, max_minutes, NULL",
}


def _mart_rows(mart: str, columns: str) -> str:
    names = columns.split(", ")
    chosen = [f"CAST({c} AS VARCHAR) AS k{i}" for i, c in enumerate(names[:3], 1)]
    chosen += [f"CAST({c} AS DOUBLE) AS n{i}" for i, c in enumerate(names[3:], 1)]
    source = TURNAROUND if mart == "lab_turnaround" else mart
    some = " WHERE lab_count IS NOT NULL OR vital_count IS NOT NULL" if mart == "quality_dashboard" else ""
    return f"SELECT '{mart}' AS mart, {', '.join(chosen)} FROM {source} m{some}"


BODIES["pipe_changes"] = " UNION ALL ".join(_mart_rows(mart, columns) for mart, columns in MART_ROWS.items())
ORACLE_SQL = {name: with_ctes(body).strip() for name, body in BODIES.items()}
