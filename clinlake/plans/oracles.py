"""SQL for DuckDB of the queries in plans.queries, written independently of their plans."""

PATIENTS = """patients AS (SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
  strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 16000 AS INTEGER), '%Y-%m-%d') AS birth_date, c_mktsegment AS address FROM customer)"""
VISITS = """visits AS (SELECT CAST(o_orderkey AS VARCHAR) AS visit_id, o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS patient_id, o_orderpriority AS dept,
  CASE o_orderstatus WHEN 'O' THEN 'outpatient' WHEN 'F' THEN 'inpatient' ELSE 'emergency' END AS visit_type, o_orderdate AS admit_time,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_hours(o_orderkey % 240) END AS discharge_time, 'D' || (o_orderkey % 100) AS diagnosis FROM orders)"""
MEDS = """meds AS (SELECT l_orderkey || '-' || l_linenumber AS order_id, CAST(l_orderkey AS VARCHAR) AS visit_id, p_name AS drug_name, l_shipdate AS order_time,
  CASE l_returnflag WHEN 'A' THEN 'executed' WHEN 'R' THEN 'cancelled' ELSE 'pending' END AS status, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
LATEST = MEDS + """, latest AS (SELECT * FROM meds QUALIFY row_number() OVER (PARTITION BY order_id
  ORDER BY order_time DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, status DESC) = 1)"""
LOG = """log AS (SELECT event_id AS pos, CAST(user_id AS VARCHAR) AS pk, event_type AS event, ts,
  CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op_type,
  sha256('his_mysql_01|Users|' || CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END || '|{"user_id":"' || user_id || '"}|bin.000001|' || event_id || '|0') AS idempotency_key FROM events)"""
WIDE = PATIENTS + ", " + VISITS + """, wide AS (SELECT v.visit_id, v.patient_id, p.name AS patient_name, p.gender, v.dept, v.visit_type, v.diagnosis, strftime(admit_time, '%Y-%m-%d %H:%M:%S') AS admit_time,
  round(date_diff('day', CAST(birth_date AS DATE), CAST(admit_time AS DATE)) / 365, 4) AS age, date_diff('hour', admit_time, coalesce(discharge_time, TIMESTAMP '2002-01-01')) AS los_hours
  FROM visits v LEFT JOIN patients p ON v.patient_id = p.patient_id AND p.k % 10 <> 0)"""
DAILY = VISITS + ", daily AS (SELECT strftime(admit_time, '%Y-%m-%d') AS visit_date, dept, visit_type, count(*) AS visit_count, count(DISTINCT patient_id) AS patient_count FROM visits GROUP BY ALL)"
DRUGS = LATEST + ", drugs AS (SELECT strftime(order_time, '%Y-%m-%d') AS order_date, drug_name, count(*) AS total_orders, count(*) FILTER (WHERE status = 'executed') AS executed_orders, count(*) FILTER (WHERE status = 'cancelled') AS cancelled_orders FROM latest GROUP BY ALL)"
MONTHLY = VISITS + ", monthly AS (SELECT strftime(admit_time, '%Y-%m') AS year_month, dept, visit_type, count(DISTINCT patient_id) AS patient_count, count(*) AS visit_count FROM visits GROUP BY ALL)"
VERSIONS = VISITS + ", versions AS (SELECT *, 1 AS version FROM visits UNION ALL SELECT * REPLACE ('MOVED' AS dept), 2 AS version FROM visits WHERE k % 7 = 0), newest AS (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY visit_id ORDER BY version DESC) = 1)"
STATE = LOG + ", state AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY pk ORDER BY pos DESC) = 1)"
LEDGER = LOG + ", ledger AS (SELECT idempotency_key, ts AS applied_at FROM log WHERE pos % 3 = 0)"
LINES = """lines AS (SELECT event_id, CASE event_id % 10 WHEN 3 THEN 'bad' WHEN 7 THEN 'empty' ELSE 'good' END AS state, event_type, user_id FROM events)"""
LAT = "lat AS (SELECT event_id, event_type, (event_id * 7919) % 4000 AS ms FROM events)"
META = '"meta":{"source":"urn:hospital:data-platform:cdc"}'

EVERYTHING = f"""WITH {LATEST}, {VISITS}, {PATIENTS}, e AS (
        SELECT patient_id, 0 AS r, 'Patient' AS kind, patient_id AS id, 'match' AS search_mode,
          '{{"resourceType":"Patient","id":"' || patient_id || '","identifier":[{{"system":"urn:hospital:his:patient-id","value":"' || patient_id || '"}},{{"system":"urn:hospital:empi"' || CASE WHEN k % 4 <> 0 THEN ',"value":"EMPI-' || lpad(patient_id, 8, '0') || '"' ELSE '' END
          || '}}],"name":[{{"use":"official","text":"' || name || '"}}],"gender":"' || CASE gender WHEN 'M' THEN 'male' ELSE 'female' END || '","birthDate":"' || birth_date || '","address":[{{"use":"home","text":"' || address || '"}}],{META}}}' AS resource FROM patients
        UNION ALL SELECT patient_id, 1, 'Encounter', visit_id, 'include',
          '{{"resourceType":"Encounter","id":"' || visit_id || '","identifier":[{{"system":"urn:hospital:his:visit-id","value":"' || visit_id || '"}}],"status":"' || CASE WHEN discharge_time IS NULL THEN 'in-progress' ELSE 'finished' END
          || '","class":{{"system":"http://terminology.hl7.org/CodeSystem/v3-ActCode","code":"' || CASE visit_type WHEN 'outpatient' THEN 'AMB' WHEN 'inpatient' THEN 'IMP' ELSE 'EMER' END || '","display":"' || visit_type || '"}},"subject":{{"reference":"Patient/' || patient_id
          || '"}},"period":{{"start":"' || strftime(admit_time, '%Y-%m-%dT%H:%M:%S.000Z') || '"' || coalesce(',"end":"' || strftime(discharge_time, '%Y-%m-%dT%H:%M:%S.000Z') || '"', '') || '}},"reasonCode":[{{"text":"' || diagnosis || '"}}],"serviceProvider":{{"display":"' || dept || '"}},{META}}}' FROM visits
        UNION ALL SELECT v.patient_id, 2, 'MedicationRequest', order_id, 'include',
          '{{"resourceType":"MedicationRequest","id":"' || order_id || '","identifier":[{{"system":"urn:hospital:his:order-id","value":"' || order_id || '"}}],"status":"' || CASE status WHEN 'executed' THEN 'completed' WHEN 'pending' THEN 'active' ELSE 'cancelled' END
          || '","intent":"order","medicationCodeableConcept":{{"text":"' || drug_name || '"}},"subject":{{"reference":"Patient/' || v.patient_id || '"}},"encounter":{{"reference":"Encounter/' || l.visit_id || '"}},"authoredOn":"' || strftime(order_time, '%Y-%m-%dT%H:%M:%S.000Z') || '",{META}}}'
          FROM latest l JOIN visits v ON l.visit_id = v.visit_id
        UNION ALL SELECT CAST(user_id AS VARCHAR), 3, 'DiagnosticReport', CAST(event_id AS VARCHAR), 'include',
          '{{"resourceType":"DiagnosticReport","id":"' || event_id || '","identifier":[{{"system":"urn:hospital:lis:result-id","value":"' || event_id || '"}}],"status":"final","category":[{{"coding":[{{"system":"http://terminology.hl7.org/CodeSystem/v2-0074","code":"LAB"}}]}}],"code":{{"coding":[{{"code":"' || event_type
          || '","display":"' || upper(event_type[1]) || event_type[2:] || '"}}]}},"subject":{{"reference":"Patient/' || user_id || '"}},"effectiveDateTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","result":[{{"display":"' || upper(event_type[1]) || event_type[2:] || '"}}],"conclusion":"' || CASE WHEN value > 50 THEN '异常' ELSE '正常' END || '",{META}}}' FROM events)
      SELECT patient_id, CAST(row_number() OVER (PARTITION BY patient_id ORDER BY r, id) AS INTEGER) AS position, kind, id, search_mode, resource, count(*) OVER (PARTITION BY patient_id) AS total FROM e WHERE patient_id IN (SELECT patient_id FROM patients)"""

MIXED = """mixed AS (
  SELECT 'ods_his_users' AS target, CAST(user_id AS VARCHAR) AS id, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op_type, event_type AS event, event_id AS n FROM events
  UNION ALL SELECT 'ods_crm_clients', CAST(client_id AS VARCHAR), CASE op WHEN 'I' THEN 'INSERT' WHEN 'D' THEN 'DELETE' ELSE 'UPDATE' END, segment, change_id FROM client_changes
  UNION ALL SELECT 'ods_shop_clients', CAST(client_id AS VARCHAR), 'INSERT', segment, client_id FROM clients
), last AS (SELECT target, id, op_type, event FROM mixed QUALIFY row_number() OVER (PARTITION BY target, id ORDER BY n DESC) = 1), kept AS (SELECT * FROM last WHERE op_type <> 'DELETE')"""

SQL = {
    "apply_many_tables": f"WITH {MIXED} SELECT * FROM kept",
    "apply_levels": f"WITH {MIXED} SELECT target, event, count(*) AS keys FROM kept GROUP BY ALL",
    "stream_state": f"WITH {MIXED} SELECT * FROM kept",
    "stream_clicks_once": "SELECT click_id, client_id, kind, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, sha256(props) AS props FROM (SELECT DISTINCT * FROM clicks WHERE arrived_at IS NOT NULL)",
    "stream_two_phase": f"""WITH {MIXED} SELECT CASE target WHEN 'ods_his_users' THEN 'cdc.his.Users' WHEN 'ods_crm_clients' THEN 'cdc.crm.Clients' ELSE 'cdc.shop.Clients' END AS topic,
      count(*) AS messages, count(DISTINCT id) AS keys FROM mixed GROUP BY 1""",
    "lookup_indexed": f"WITH {VISITS} SELECT visit_id, patient_id, dept, strftime(admit_time, '%Y-%m-%d %H:%M:%S') AS admit_time FROM visits WHERE patient_id = '77'",
    "month_from_layout": f"WITH {VISITS} SELECT dept, count(*) AS visits FROM visits WHERE admit_time >= TIMESTAMP '1997-03-01' AND admit_time < TIMESTAMP '1997-04-01' GROUP BY dept",
    "rollup_states": f"WITH {VISITS} SELECT strftime(admit_time, '%Y-%m') AS year_month, dept, count(*) AS visit_count, true AS patients_close FROM visits GROUP BY ALL",
    "report_from_states": f"WITH {VISITS} SELECT strftime(admit_time, '%Y-%m') AS year_month, visit_type, count(*) AS visit_count FROM visits WHERE dept = '1-URGENT' GROUP BY ALL",
    "latency_states": f"WITH {LAT} SELECT event_type, count(*) AS events, true AS ok_50, true AS ok_95, true AS ok_99 FROM lat GROUP BY event_type",
    "visit_wide": f"WITH {WIDE} SELECT * FROM wide",
    "dept_daily_visits": f"WITH {DAILY} SELECT * FROM daily",
    "drug_daily_orders": f"WITH {DRUGS} SELECT * FROM drugs",
    "patient_monthly": f"WITH {MONTHLY} SELECT * FROM monthly",
    "rollup_merge_partials": f"WITH {DAILY} SELECT visit_date, dept, visit_type, visit_count FROM daily",
    "rollup_incremental": f"WITH {VISITS} SELECT strftime(admit_time, '%Y-%m-%d') AS visit_date, CASE WHEN k % 100 = 0 THEN 'MOVED' ELSE dept END AS dept, visit_type, count(*) AS visit_count, count(DISTINCT patient_id) AS patient_count FROM visits GROUP BY ALL",
    "partition_pruned_month": f"WITH {VISITS} SELECT dept, count(*) AS visits FROM visits WHERE admit_time >= TIMESTAMP '1997-03-01' AND admit_time < TIMESTAMP '1997-04-01' GROUP BY dept",
    "latest_version": f"WITH {LATEST} SELECT order_id, drug_name, status, strftime(order_time, '%Y-%m-%d %H:%M:%S') AS order_time, l_partkey, l_suppkey FROM latest",
    "latest_version_visits": f"WITH {VERSIONS} SELECT visit_id, dept, version FROM newest",
    "latest_version_orders": f"WITH {LATEST} SELECT visit_id, count(*) AS orders, count(*) FILTER (WHERE status = 'executed') AS executed FROM latest GROUP BY visit_id",
    "lookup_patient": f"WITH {PATIENTS} SELECT * EXCLUDE (k) FROM patients WHERE patient_id = '77'",
    "lookup_visit": f"WITH {VERSIONS} SELECT visit_id, patient_id, dept, visit_type, strftime(admit_time, '%Y-%m-%d %H:%M:%S') AS admit_time FROM newest WHERE visit_id = '77'",
    "incremental_pull": "WITH e AS (SELECT event_id, date_trunc('hour', ts) AS h, event_type FROM events) SELECT event_id, strftime(h, '%Y-%m-%d %H:%M:%S') AS ts, event_type FROM e WHERE (h, event_id) > (TIMESTAMP '2024-01-05 03:00:00', 40) ORDER BY h, event_id LIMIT 200",
    "ods_typed_cast": "SELECT CAST(event_id AS VARCHAR) AS result_id, CASE WHEN event_id % 11 <> 0 THEN CAST(CAST(round(value, 2) AS DECIMAL(18,2)) AS DOUBLE) END AS value, CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS is_abnormal, CASE WHEN event_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS result_day FROM events",
    "cdc_envelope": f"WITH {LOG} SELECT 'his_mysql_01' AS source_id, op_type, pk, pos, CASE WHEN op_type <> 'DELETE' THEN event END AS after_event, CASE WHEN op_type = 'DELETE' THEN event END AS before_event FROM log",
    "cdc_decode_op": "SELECT CASE event_id % 6 WHEN 1 THEN 'DELETE' WHEN 3 THEN 'UPDATE' WHEN 4 THEN 'UPDATE' ELSE 'INSERT' END AS op_type, count(*) AS n FROM events GROUP BY ALL",
    "cdc_pair_updates": "SELECT event_id // 2 AS pk, lpad(upper(to_hex(event_id // 2)), 20, '0') AS lsn, 'UPDATE' AS op_type, max(event_type) FILTER (WHERE event_id % 2 = 0) AS before, max(event_type) FILTER (WHERE event_id % 2 = 1) AS after FROM events GROUP BY event_id // 2",
    "cdc_poll_range": "WITH c AS (SELECT event_id, lpad(upper(to_hex(event_id // 4)), 20, '0') AS lsn, event_id % 6 AS op_code FROM events WHERE event_id // 4 > 16 AND event_id // 4 <= 900), f AS (SELECT max(lsn) AS last FROM (SELECT lsn FROM c ORDER BY lsn, event_id LIMIT 1001)) SELECT event_id, lsn, op_code FROM c, f WHERE lsn <= last",
    "parse_skip_bad_json": f"WITH {LINES} SELECT state = 'good' AS ok, count(*) AS lines, CAST(coalesce(sum(user_id) FILTER (WHERE state = 'good'), 0) AS BIGINT) AS users FROM lines GROUP BY ALL",
    "json_roundtrip": f"WITH {LINES} SELECT event_id, event_type AS kind, CAST(user_id AS VARCHAR) AS user FROM lines WHERE state = 'good'",
    "mask_fields": "SELECT c_custkey AS id, c_name AS name, '***' AS phone FROM customer",
    "normalize_text": "SELECT CAST(o_orderkey * 1000000 AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS at, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS final FROM orders",
    "route_topic": "SELECT 'cdc.his_mysql_01.users' AS topic, count(*) AS n FROM events",
    "route_target_table": "SELECT 'ods_his_users' AS target, count(*) AS n FROM events",
    "partition_key": f"WITH {LOG} SELECT pk, count(*) AS n FROM log GROUP BY pk",
    "idempotency_key": f"WITH {LOG} SELECT pos AS binlog_pos, idempotency_key FROM log",
    "dedup_idempotent": f"WITH {LEDGER} SELECT pos AS binlog_pos, op_type FROM log WHERE idempotency_key NOT IN (SELECT idempotency_key FROM ledger)",
    "dedup_retention": f"WITH {LEDGER} SELECT strftime(applied_at, '%Y-%m-%d') AS day, count(*) AS kept FROM ledger WHERE applied_at >= TIMESTAMP '2024-01-30' - INTERVAL 168 HOUR GROUP BY ALL",
    "apply_changes": f"WITH {STATE} SELECT pk, op_type, pos AS binlog_pos, event FROM state WHERE op_type <> 'DELETE'",
    "upsert_merge": f"WITH {STATE} SELECT pk, event, pos FROM state WHERE op_type <> 'DELETE'",
    "delete_anti_join": f"WITH {PATIENTS}, {VISITS} SELECT patient_id, name FROM patients WHERE patient_id NOT IN (SELECT patient_id FROM visits WHERE visit_type = 'emergency')",
    "exists_semi": f"WITH {PATIENTS}, {VISITS} SELECT patient_id, name FROM patients p WHERE EXISTS (SELECT 1 FROM visits v WHERE v.patient_id = p.patient_id AND visit_type = 'inpatient')",
    "union_sources": "SELECT 'his' AS system, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer UNION ALL SELECT 'lis', CAST(s_suppkey AS VARCHAR), s_name FROM supplier",
    "offset_latest": "SELECT 'src_' || event_type AS source_id, lpad(CAST(event_id // 1000 AS VARCHAR), 6, '0') AS file, event_id AS pos FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) = 1",
    "event_counts_by_op": f"WITH {LOG} SELECT 'Users' AS \"table\", op_type, count(*) AS n FROM log GROUP BY op_type",
    "e2e_latency": "SELECT event_id AS binlog_pos, epoch_us(TIMESTAMP '2024-02-01') // 1000 - epoch_us(ts) // 1000 AS latency_ms FROM events",
    "latency_histogram": f"WITH {LAT}, b AS (SELECT CAST(unnest([5, 10, 25, 50, 100, 250, 500, 1000, 2500, 5000]) AS INTEGER) AS le) SELECT le, CAST(count(ms) AS BIGINT) AS count FROM b LEFT JOIN lat ON ms <= le GROUP BY le",
    "latency_percentiles": f"WITH {LAT} SELECT event_type, round(quantile_cont(ms, 0.5), 3) AS p50, round(quantile_cont(ms, 0.95), 3) AS p95, round(quantile_cont(ms, 0.99), 3) AS p99 FROM lat GROUP BY event_type",
    "report_dept_daily": f"WITH {DAILY} SELECT * FROM daily WHERE dept = '1-URGENT'",
    "report_drug_consumption": f"WITH {DRUGS} SELECT drug_name, CAST(sum(total_orders) AS BIGINT) AS total_orders, CAST(sum(executed_orders) AS BIGINT) AS executed_orders, CAST(sum(cancelled_orders) AS BIGINT) AS cancelled_orders FROM drugs WHERE order_date BETWEEN '1996-01-01' AND '1996-12-31' GROUP BY drug_name",
    "report_patient_monthly": f"WITH {MONTHLY} SELECT * FROM monthly WHERE year_month = '1998-05'",
    "report_visit_wide": f"WITH {WIDE} SELECT visit_id, patient_name, admit_time, los_hours FROM wide WHERE dept = '2-HIGH' AND visit_type = 'inpatient' ORDER BY admit_time, visit_id LIMIT 100",
    "topk_dept": f"WITH {VISITS} SELECT dept, count(*) AS visits FROM visits GROUP BY dept ORDER BY visits DESC, dept LIMIT 3",
    "topk_drug": f"WITH {LATEST} SELECT drug_name, count(*) AS orders FROM latest GROUP BY drug_name ORDER BY orders DESC, drug_name LIMIT 10",
    "uniq_exact": f"WITH {VISITS} SELECT dept, count(DISTINCT patient_id) AS patients FROM visits GROUP BY dept",
    "empi_resolve": "SELECT CAST(event_id AS VARCHAR) AS result_id, 'L' || user_id AS patient_id, CASE WHEN c_custkey % 5 <> 3 THEN 'EMPI-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS empi_id FROM events LEFT JOIN customer ON c_custkey = user_id",
    "empi_by_id": "SELECT 'EMPI-' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS empi_id, c_name AS name, CAST(CASE WHEN c_custkey % 5 <> 3 THEN 2 ELSE 1 END AS INTEGER) AS identifiers FROM customer WHERE c_custkey = 42",
    "empi_fuzzy_match": f"""WITH {PATIENTS}, q AS (SELECT patient_id AS query_id, name, gender, CASE WHEN k % 40 = 0 THEN '1900-01-01' ELSE birth_date END AS birth_date FROM patients WHERE k % 20 = 0),
      m AS (SELECT query_id, 'EMPI-' || lpad(CAST(p.k AS VARCHAR), 8, '0') AS empi_id, CAST(CASE WHEN q.name = p.name THEN 4 WHEN contains(p.name, q.name) OR contains(q.name, p.name) THEN 2 ELSE 0 END
        + CASE WHEN q.gender = p.gender THEN 2 ELSE 0 END + CASE WHEN q.birth_date = p.birth_date THEN 4 ELSE 0 END AS INTEGER) AS score FROM q, patients p) SELECT * FROM m WHERE score >= 4""",
    "access_check": f"""WITH {VISITS}, r AS (SELECT visit_id, ['role_admin', 'role_doctor', 'role_nurse', 'role_lab_tech', 'role_guest'][k % 5 + 1] AS role, ['Patient', 'Encounter', 'DiagnosticReport'][k % 3 + 1] AS resource, CASE WHEN k % 7 <> 0 THEN dept END AS dept FROM visits)
      SELECT visit_id, role, resource, CASE role WHEN 'role_admin' THEN true WHEN 'role_doctor' THEN coalesce(dept = '2-HIGH', false) WHEN 'role_nurse' THEN resource <> 'DiagnosticReport' AND coalesce(dept = '2-HIGH', false) WHEN 'role_lab_tech' THEN resource <> 'Encounter' ELSE false END AS allowed FROM r""",
    "access_field_filter": f"""WITH {VISITS}, c AS (SELECT visit_id AS id, visit_type, CASE visit_type WHEN 'outpatient' THEN 'AMB' WHEN 'inpatient' THEN 'IMP' ELSE 'EMER' END AS class_code FROM visits)
      SELECT id, 'Encounter' AS resourceType, class_code, '{{"resourceType":"Encounter","id":"' || id || '","class":{{"system":"http://terminology.hl7.org/CodeSystem/v3-ActCode","code":"' || class_code || '","display":"' || visit_type || '"}}}}' AS json FROM c""",
    "fhir_patient": f"""WITH {PATIENTS}, g AS (SELECT *, CASE gender WHEN 'M' THEN 'male' ELSE 'female' END AS sex FROM patients)
      SELECT patient_id AS id, sex AS gender, birth_date AS "birthDate", name,
      '{{"resourceType":"Patient","id":"' || patient_id || '","identifier":[{{"system":"urn:hospital:his:patient-id","value":"' || patient_id || '"}},{{"system":"urn:hospital:empi"' || CASE WHEN k % 4 <> 0 THEN ',"value":"EMPI-' || lpad(patient_id, 8, '0') || '"' ELSE '' END
      || '}}],"name":[{{"use":"official","text":"' || name || '"}}],"gender":"' || sex || '","birthDate":"' || birth_date || '","address":[{{"use":"home","text":"' || address || '"}}],{META}}}' AS json FROM g""",
    "fhir_encounter": f"""WITH {VISITS} SELECT visit_id AS id, CASE WHEN discharge_time IS NULL THEN 'in-progress' ELSE 'finished' END AS status, CASE visit_type WHEN 'outpatient' THEN 'AMB' WHEN 'inpatient' THEN 'IMP' ELSE 'EMER' END AS class_code,
      'Patient/' || patient_id AS subject, strftime(admit_time, '%Y-%m-%dT%H:%M:%S.000Z') AS start, strftime(discharge_time, '%Y-%m-%dT%H:%M:%S.000Z') AS "end" FROM visits""",
    "fhir_medication_request": f"""WITH {LATEST}, {VISITS} SELECT order_id AS id, CASE status WHEN 'executed' THEN 'completed' WHEN 'pending' THEN 'active' ELSE 'cancelled' END AS status, drug_name AS drug,
      'Patient/' || v.patient_id AS subject, 'Encounter/' || l.visit_id AS encounter, strftime(order_time, '%Y-%m-%dT%H:%M:%S.000Z') AS "authoredOn" FROM latest l LEFT JOIN visits v ON l.visit_id = v.visit_id""",
    "fhir_diagnostic_report": "SELECT CAST(event_id AS VARCHAR) AS id, 'final' AS status, event_type AS code, 'Patient/' || user_id AS subject, CASE WHEN value > 50 THEN '异常' ELSE '正常' END AS conclusion, 'LAB' AS category FROM events",
    "fhir_bundle": f"WITH {PATIENTS}, {VISITS} SELECT p.patient_id AS id, 'searchset' AS type, 1 + count(v.visit_id) AS total, coalesce(string_agg(v.visit_id, ',' ORDER BY v.visit_id), '') AS encounters FROM patients p LEFT JOIN visits v ON v.patient_id = p.patient_id GROUP BY p.patient_id",
    "patient_everything": f"""WITH {LATEST}, {VISITS}, {PATIENTS}, e AS (SELECT patient_id, 'Patient' AS kind FROM patients UNION ALL SELECT patient_id, 'Encounter' FROM visits UNION ALL SELECT v.patient_id, 'MedicationRequest' FROM latest l JOIN visits v ON l.visit_id = v.visit_id
      UNION ALL SELECT CAST(user_id AS VARCHAR), 'DiagnosticReport' FROM events) SELECT patient_id, kind, count(*) AS entries FROM e WHERE patient_id IN (SELECT patient_id FROM patients) GROUP BY ALL""",
    "duplicate_pks": f"WITH {MEDS} SELECT order_id, count(*) AS n FROM meds GROUP BY order_id HAVING count(*) > 1",
    "reconcile_counts": f"WITH {VISITS} SELECT dept, count(*) AS source_rows, count(*) FILTER (WHERE k % 50 <> 0) AS target_rows, count(*) = count(*) FILTER (WHERE k % 50 <> 0) AS equal FROM visits GROUP BY dept",
    "reconcile_rows": f"WITH {VISITS} SELECT visit_id, dept, visit_type FROM visits WHERE k % 97 = 0",
    "name_prefix_filter": "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_name LIKE 'Customer#00000001%'",
    "everything_bundle": EVERYTHING,
    "bundle_pages": f"""SELECT patient_id, CAST((position - 1) // 1000 + 1 AS INTEGER) AS page, any_value(total) AS total,
      '{{"resourceType":"Bundle","type":"searchset","total":' || any_value(total) || ',"timestamp":"2024-02-01T00:00:00.000Z","entry":[' || string_agg('{{"resource":' || resource || ',"search":{{"mode":"' || search_mode || '"}}}}', ',' ORDER BY position) || ']}}' AS bundle
      FROM ({EVERYTHING}) GROUP BY ALL""",
    "cdc_row_events": "SELECT event_id, CAST(0 AS INTEGER) AS row_seq, CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS op_type, CAST(user_id AS VARCHAR) AS pk, CASE WHEN event_type = 'error' THEN event_type WHEN event_type <> 'signup' THEN coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id), 'none') END AS before_event, CASE WHEN event_type <> 'error' THEN event_type END AS after_event FROM events",
    "cdc_lsn_bounds": "SELECT min(lpad(upper(to_hex(event_id // 4)), 20, '0')) AS min_lsn, max(lpad(upper(to_hex(event_id // 4)), 20, '0')) AS max_lsn FROM events",
    "cdc_key_columns": "SELECT * FROM (VALUES ('dbo', 'lab_results', 'result_id'), ('his', 'visits', 'patient_id,visit_id')) t(table_schema, table_name, key_columns)",
    "normalize_time": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN '.25' WHEN 2 THEN '.5' ELSE '.75' END || 'Z' AS at FROM events",
    "ods_auto_create": "SELECT event_type AS event, props, CAST(user_id AS VARCHAR) AS user_id FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) WHERE event_type <> 'error'",
    "olap_typed": "SELECT CAST(event_id AS VARCHAR) AS result_id, CASE WHEN event_id % 11 <> 0 THEN round(CAST(CAST(round(value, 2) AS DECIMAL(18,2)) AS DOUBLE), 2) END AS value, CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' END AS is_abnormal, CASE WHEN event_id % 11 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS result_time FROM events",
    "route_configured": "SELECT CASE WHEN event_id % 2 = 0 THEN 'cdc.his.users' ELSE 'cdc.his.Other' END AS topic, CAST(user_id AS VARCHAR) AS key, count(*) AS n FROM events GROUP BY ALL",
    "distinct_topics": "SELECT DISTINCT 'cdc.his_mysql_01.' || event_type AS topic FROM events WHERE event_type <> 'error'",
    "empi_ranked": f"""WITH {PATIENTS}, q AS (SELECT patient_id AS query_id, name, gender, birth_date FROM patients WHERE k % 20 = 0),
      m AS (SELECT query_id, 'EMPI-' || lpad(CAST(p.k AS VARCHAR), 8, '0') AS empi_id, p.name, CAST(CASE WHEN q.name = p.name THEN 4 WHEN contains(p.name, q.name) OR contains(q.name, p.name) THEN 2 ELSE 0 END
        + CASE WHEN q.gender = p.gender THEN 2 ELSE 0 END + CASE WHEN q.birth_date = p.birth_date THEN 4 ELSE 0 END AS INTEGER) AS score FROM q, patients p)
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, empi_id) AS INTEGER) AS rank FROM m WHERE score >= 4""",
    "list_users": "SELECT * FROM (VALUES ('U001', 'doctor_zhang', '张医生', 'role_doctor', '心内科'), ('U002', 'nurse_li', '李护士', 'role_nurse', '心内科'), ('U003', 'lab_wang', '王技师', 'role_lab_tech', '检验科'), ('U004', 'admin', '系统管理员', 'role_admin', '信息科')) t(user_id, username, name, role, department)",
    "fhir_numbers": """SELECT CAST(event_id AS VARCHAR) AS id, '{"id":"' || event_id || '"' || CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN ',"valueQuantity":{"value":' || (event_id % 50) || '}' ELSE ',"valueQuantity":{"value":' || (event_id % 50) || '.5}' END
      || ',"effectiveDateTime":"' || CASE event_id % 3 WHEN 0 THEN '2024-01-02T03:04:05+08:00' WHEN 1 THEN '2024-01-02T03:04:05.000Z' ELSE 'no time' END || '"}' AS json FROM events""",
    "seed_patients": "SELECT i AS patient_id, '患者' || i AS name, CASE i % 2 WHEN 0 THEN 'M' ELSE 'F' END AS gender, strftime(DATE '1950-01-01' + CAST(i * 7919 % 21915 AS INTEGER), '%Y-%m-%d') AS birth_date, '北京市朝阳区' || (i % 1000) || '号' AS address FROM range(2000) t(i)",
    "seed_visits": "SELECT i AS visit_id, i % 500 AS patient_id, ['内科', '外科', '儿科', '妇产科', '急诊科', '骨科'][i % 6 + 1] AS dept, '医生' || (i % 50) AS doctor, ['outpatient', 'inpatient', 'emergency'][i % 3 + 1] AS visit_type, strftime(TIMESTAMP '2024-01-01' - to_hours((i * 7919 + 1) % 720), '%Y-%m-%d %H:%M:%S') AS admit_time, '诊断结果' || (i % 100) AS diagnosis FROM range(2000) t(i)",
    "seed_orders": "SELECT i AS order_id, i % 1000 AS visit_id, ['阿莫西林', '布洛芬', '头孢克洛', '阿司匹林', '奥美拉唑', '甲硝唑'][i % 6 + 1] AS drug_name, (50 + (i * 7919 + 2) % 450) || '.0mg' AS dosage, '每日三次' AS frequency, ['口服', '静脉注射', '肌肉注射', '外用'][i % 4 + 1] AS route, strftime(TIMESTAMP '2024-01-01' + to_seconds(i), '%Y-%m-%d %H:%M:%S') AS order_time, '医生' || (i % 50) AS doctor, 'pending' AS status FROM range(2000) t(i)",
    "seed_labs": "SELECT i AS result_id, i % 1000 + 1 AS visit_id, i % 500 + 1 AS patient_id, 'CBC' || lpad(CAST(i % 20 AS VARCHAR), 3, '0') AS item_code, '全血细胞计数' AS item_name, (50 + (i * 7919 + 3) % 150) / 10 AS value, 'g/L' AS unit, i % 5 = 0 AS is_abnormal, strftime(TIMESTAMP '2024-01-01' + to_seconds(i), '%Y-%m-%d %H:%M:%S') AS result_time FROM range(2000) t(i)",
}

SQL["reconcile_tree"] = SQL["reconcile_rows"]
SQL["visit_wide_colocated"] = SQL["visit_wide"]
SQL["everything_colocated"] = SQL["everything_bundle"]
SQL["access_projected"] = f"""WITH {VISITS}, r AS (SELECT *, ['role_admin', 'role_doctor', 'role_nurse', 'role_lab_tech', 'role_guest'][k % 5 + 1] AS role FROM visits), p AS (
  SELECT visit_id, role, '{{"resourceType":"Encounter","id":"' || visit_id || '"' AS head, ',"identifier":[{{"system":"urn:hospital:his:visit-id","value":"' || visit_id || '"}}]' AS identifier,
    ',"status":"' || CASE WHEN discharge_time IS NULL THEN 'in-progress' ELSE 'finished' END || '"' AS status,
    ',"class":{{"system":"http://terminology.hl7.org/CodeSystem/v3-ActCode","code":"' || CASE visit_type WHEN 'outpatient' THEN 'AMB' WHEN 'inpatient' THEN 'IMP' ELSE 'EMER' END || '","display":"' || visit_type || '"}}' AS class,
    ',"period":{{"start":"' || strftime(admit_time, '%Y-%m-%dT%H:%M:%S.000Z') || '"' || coalesce(',"end":"' || strftime(discharge_time, '%Y-%m-%dT%H:%M:%S.000Z') || '"', '') || '}}' AS period,
    ',"subject":{{"reference":"Patient/' || patient_id || '"}}' AS subject, ',"reasonCode":[{{"text":"' || diagnosis || '"}}],"serviceProvider":{{"display":"' || dept || '"}},{META}' AS rest FROM r)
  SELECT visit_id AS id, role, CASE role WHEN 'role_guest' THEN NULL WHEN 'role_nurse' THEN head || identifier || class || period || '}}' WHEN 'role_lab_tech' THEN head || identifier || status || '}}'
    ELSE head || identifier || status || class || subject || period || rest || '}}' END AS json FROM p"""
SQL["columns_grown"] = """SELECT click_id, TRY_CAST(json_extract_string(j, '$.k') AS BIGINT) AS k, CASE WHEN ts IS NULL OR ts >= TIMESTAMP '2024-02-01' THEN json_extract_string(j, '$.device.os') END AS os,
  CASE WHEN json_type(j, '$.items') = 'ARRAY' THEN CAST(json_array_length(j, '$.items') AS BIGINT) END AS n_items
  FROM (SELECT click_id, ts, CASE WHEN json_valid(props) THEN props END AS j FROM (SELECT DISTINCT click_id, ts, props FROM clicks))"""
TOPICS = {"cdc.his.Users": "ods_his_users", "cdc.crm.Clients": "ods_crm_clients", "cdc.shop.Clients": "ods_shop_clients"}
SQL["route_default"] = f"WITH {MIXED} SELECT CASE target " + " ".join(f"WHEN '{t}' THEN '{n}'" for n, t in TOPICS.items()) + " END AS topic, count(*) AS n FROM mixed GROUP BY 1"
SQL["dedup_positions"] = f"WITH {MIXED} SELECT target, op_type, count(DISTINCT (n, id)) AS changes FROM mixed WHERE n % 2 <> 0 GROUP BY ALL"
SQL["uniq_approx_close"] = f"WITH {VISITS} SELECT dept, count(DISTINCT patient_id) AS patients, true AS close FROM visits GROUP BY dept"
SQL["stream_settings"] = f"""WITH {MIXED} SELECT CASE target WHEN 'ods_his_users' THEN 'cdc.his.Users' ELSE 'cdc.all.clients' END AS topic, count(*) AS messages, count(DISTINCT id) AS keys, CAST(0 AS BIGINT) AS shown FROM mixed GROUP BY 1"""
