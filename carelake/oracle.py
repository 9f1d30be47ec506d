"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently in plain SQL over the driver's tables (views
``customer``, ``orders``, ``lineitem``, ``events``, ``pages``, ``nation``,
...). Shared CTE fragments are composed by small Python helpers.
"""

from __future__ import annotations

import datetime as dt

AS_OF = "DATE '2001-08-02'"
LOAD = "TIMESTAMP '2001-08-02 00:00:00'"
T1 = "TIMESTAMP '2001-08-01 00:00:00'"
CODE_DAY = "DATE '2024-06-30'"


def ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def d(x: dt.date) -> str:
    return f"DATE '{x:%Y-%m-%d}'"


ENC_TYPES = """enc_types(visit_type_c, encounter_type, is_active) AS (
  VALUES (101, 'OFFICE', true), (102, 'FOLLOWUP', true), (103, 'WELLNESS', true),
         (201, 'ACUTE', true), (0, 'OTHER', true))"""

CODES = """codes(measure_id, code_type, code_value, effective_date, expiration_date) AS (
  VALUES ('CDC','CPT','99213', DATE '2024-01-01', NULL::DATE),
         ('CDC','CPT','99214', DATE '2024-01-01', NULL::DATE),
         ('CDC','ICD10','E119', DATE '2024-01-01', NULL::DATE),
         ('AWV','CPT','99395', DATE '2024-01-01', NULL::DATE),
         ('AWV','CPT','G0438', DATE '2024-01-01', NULL::DATE),
         ('AWV','CPT','G0439', DATE '2024-01-01', NULL::DATE),
         ('CBP','ICD10','I10', DATE '2024-01-01', NULL::DATE),
         ('AAB','ICD10','J45909', DATE '2024-01-01', NULL::DATE),
         ('LBP','ICD10','M545', DATE '2024-01-01', NULL::DATE))"""

MEASURE_DEFS = """measure_defs(measure_id, measure_name) AS (
  VALUES ('CDC','Comprehensive Diabetes Care'), ('AWV','Annual Wellness Visit'),
         ('CBP','Controlling High Blood Pressure'), ('AAB','Appropriate Asthma Treatment'))"""


def bronze_patient(name="bronze_patient", where="TRUE", payer="payer_name") -> str:
    return f"""{name} AS (
  SELECT pat_id, mrn, first_name, last_name, birth_date, gender, zip_code, {payer} AS payer_name
  FROM (SELECT 'P' || c_custkey AS pat_id, c_custkey,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'M' || c_custkey END AS mrn,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE '  ' || c_mktsegment || ' ' END AS first_name,
    c_name AS last_name,
    CASE WHEN c_custkey % 17 = 0 THEN NULL
         ELSE CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 20000 AS INTEGER) AS DATE) END AS birth_date,
    CASE c_nationkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE NULL END AS gender,
    lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip_code,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS payer_name
  FROM customer) WHERE {where})"""


def stg_patient(name="stg_patient", src="bronze_patient") -> str:
    return f"""{name} AS (
  SELECT pat_id, mrn_token, first_name, last_name, birth_date, gender, zip_code, payer_name,
    sha256(concat_ws('|', mrn_token, first_name, last_name, CAST(birth_date AS VARCHAR),
                     gender, zip_code, payer_name)) AS attr_hash
  FROM (SELECT pat_id, sha256(coalesce(mrn, '')) AS mrn_token,
      coalesce(trim(first_name), 'UNKNOWN') AS first_name,
      coalesce(trim(last_name), 'UNKNOWN') AS last_name,
      CAST(birth_date AS DATE) AS birth_date,
      coalesce(trim(gender), 'U') AS gender,
      coalesce(trim(zip_code), '00000') AS zip_code,
      coalesce(trim(payer_name), 'UNKNOWN') AS payer_name
    FROM {src} WHERE pat_id IS NOT NULL))"""


def dim_patient(name="dim_patient", src="stg_patient", as_of=AS_OF, load=LOAD) -> str:
    return f"""{name} AS (
  SELECT pat_id, mrn_token, first_name, last_name, birth_date, gender, zip_code, payer_name,
    {as_of} AS effective_date, NULL::DATE AS expiration_date, true AS is_current,
    {load} AS load_dttm
  FROM {src})"""


def bronze_encounter(name="bronze_encounter", where="TRUE", status="o_orderstatus", table="orders") -> str:
    return f"""{name} AS (
  SELECT 'P' || o_custkey AS pat_id, 'E' || o_orderkey AS encounter_id,
    CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 201 WHEN '2-HIGH' THEN 101
         WHEN '3-MEDIUM' THEN 102 WHEN '4-NOT SPECIFIED' THEN 103 ELSE 999 END AS INTEGER) AS visit_type_c,
    o_orderdate AS encounter_dttm,
    'D' || (o_orderkey % 7) AS dept_id, 'R' || (o_orderkey % 23) AS prov_id,
    CASE o_orderkey % 5 WHEN 0 THEN 'DX_E119' WHEN 1 THEN 'DX_I10' WHEN 2 THEN 'J45909'
         WHEN 3 THEN 'DX_M545' ELSE 'DX_Z000' END AS primary_dx_id,
    {status} AS encounter_status
  FROM {table} WHERE {where})"""


def dim_encounter(name="dim_encounter", src="bronze_encounter", load=LOAD) -> str:
    return f"""{name} AS (
  SELECT pat_id, encounter_id, visit_type_c, encounter_type, encounter_dttm, dept_id, prov_id,
         primary_dx_id, primary_dx_code, encounter_status, {load} AS load_dttm
  FROM (SELECT e.pat_id, e.encounter_id, e.visit_type_c,
      coalesce(t.encounter_type, 'OTHER') AS encounter_type, e.encounter_dttm, e.dept_id,
      e.prov_id, e.primary_dx_id, regexp_replace(e.primary_dx_id, '^DX_', '') AS primary_dx_code,
      e.encounter_status,
      row_number() OVER (PARTITION BY e.encounter_id ORDER BY e.encounter_dttm DESC NULLS LAST,
        e.pat_id ASC NULLS LAST, e.visit_type_c ASC NULLS LAST, e.dept_id ASC NULLS LAST,
        e.prov_id ASC NULLS LAST, e.primary_dx_id ASC NULLS LAST,
        e.encounter_status ASC NULLS LAST) AS rn
    FROM {src} e LEFT JOIN (SELECT * FROM enc_types WHERE is_active) t
      ON e.visit_type_c = t.visit_type_c
    WHERE e.pat_id IS NOT NULL AND e.encounter_id IS NOT NULL) x
  WHERE rn = 1)"""


def bronze_charge(name="bronze_charge", where="TRUE", status=None, table="lineitem") -> str:
    status = status or """CASE WHEN l_returnflag = 'R' THEN 'DENIED'
         WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL ELSE 'PAID' END"""
    return f"""{name} AS (
  SELECT 'E' || l_orderkey AS encounter_id, 'C' || l_linenumber AS charge_id,
    CASE l_partkey % 6 WHEN 0 THEN '99213' WHEN 1 THEN '9921' WHEN 2 THEN '99395'
         WHEN 3 THEN 'G0438' WHEN 4 THEN '99214' ELSE '80053' END AS cpt_code,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS billed_amt,
    CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE
      CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(12,2)) AS DECIMAL(12,2))
           - CAST(l_linenumber AS DECIMAL(12,2)) AS DECIMAL(12,2)) END AS paid_amt,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) - CAST(l_quantity AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS allowed_amt,
    {status} AS claim_status, l_shipdate AS charge_dttm
  FROM {table} WHERE {where})"""


def staged_charges(name="staged_charges", src="bronze_charge", load=LOAD) -> str:
    return f"""{name} AS (
  SELECT encounter_id, charge_id, cpt_code,
    coalesce(billed_amt, 0.00::DECIMAL(12,2)) AS billed_amt,
    coalesce(paid_amt, 0.00::DECIMAL(12,2)) AS paid_amt,
    coalesce(allowed_amt, 0.00::DECIMAL(12,2)) AS allowed_amt,
    claim_status, charge_dttm, {load} AS load_dttm
  FROM {src} WHERE encounter_id IS NOT NULL AND charge_id IS NOT NULL)"""


def fact_charges(name="fact_charges", src="bronze_charge", load=LOAD) -> str:
    """Staged charges, the latest per key: by charge time, then code, amounts and status, all descending."""
    return f"""{staged_charges(f"{name}_staged", src, load)},
{name} AS (
  SELECT * FROM {name}_staged
  QUALIFY row_number() OVER (PARTITION BY encounter_id, charge_id ORDER BY
    charge_dttm DESC NULLS LAST, cpt_code DESC NULLS LAST, billed_amt DESC NULLS LAST,
    allowed_amt DESC NULLS LAST, paid_amt DESC NULLS LAST, claim_status DESC NULLS LAST) = 1)"""


def silver_ctes(as_of=AS_OF, load=LOAD) -> list[str]:
    return [ENC_TYPES, CODES, MEASURE_DEFS, bronze_patient(), stg_patient(),
            dim_patient(as_of=as_of, load=load), bronze_encounter(), dim_encounter(load=load),
            bronze_charge(), fact_charges(load=load)]


def completed_years_sql(t: str, b: str) -> str:
    """Spark ``floor(months_between(t, b) / 12)``: whole months, minus one
    when the day of month has not been reached (unless both are month ends)."""
    return f"""CAST(floor((12 * (year({t}) - year({b})) + month({t}) - month({b})
      - CASE WHEN day({t}) < day({b})
              AND NOT (CAST({t} AS DATE) = last_day({t}) AND CAST({b} AS DATE) = last_day({b}))
             THEN 1 ELSE 0 END) / 12.0) AS INTEGER)"""


def eligibility(name="eligibility", as_of=CODE_DAY, load=LOAD, enc="dim_encounter",
                compliant=("WELLNESS", "FOLLOWUP"), charges="fact_charges", codes="codes") -> str:
    """Codes seen at an encounter, whatever their kind, matched once with the codes in force."""
    comp = ", ".join(f"'{c}'" for c in compliant)
    return f"""{name}_in_force AS (
  SELECT measure_id, code_type, code_value FROM {codes}
  WHERE {as_of} BETWEEN effective_date AND coalesce(expiration_date, DATE '9999-12-31')),
{name}_seen AS (
  SELECT encounter_id, 'CPT' AS code_type, cpt_code AS code_value FROM {charges}
  UNION ALL SELECT encounter_id, 'ICD10', primary_dx_code FROM {enc}),
{name}_hits AS (
  SELECT encounter_id, measure_id FROM {name}_seen JOIN {name}_in_force USING (code_type, code_value)
  GROUP BY encounter_id, measure_id),
{name} AS (
  SELECT pat_id, encounter_id, measure_id,
    coalesce(names[measure_id], measure_id) AS measure_name, 'Y' AS measure_eligible,
    if(coalesce(list_contains([{comp}], encounter_type), false), 'Y', 'N') AS measure_compliant,
    {completed_years_sql('encounter_dttm', 'birth_date')} AS age_at_encounter,
    encounter_type, {load} AS load_dttm
  FROM {name}_hits
  JOIN (SELECT pat_id, encounter_id, encounter_dttm, encounter_type FROM {enc}
        WHERE encounter_dttm IS NOT NULL) USING (encounter_id)
  JOIN (SELECT pat_id, birth_date FROM dim_patient
        WHERE is_current AND birth_date IS NOT NULL) USING (pat_id),
  (SELECT map(list(measure_id), list(measure_name)) AS names FROM measure_defs))"""


def billing(name="billing", as_of=AS_OF, load=LOAD, lookback=90, enc="dim_encounter", charges="fact_charges") -> str:
    """Claims that were not denied, of visits at most ``lookback`` days old whose type is mapped."""
    return f"""{name}_visits AS (
  SELECT pat_id, encounter_id, encounter_dttm, primary_dx_code,
    (SELECT any_value(t.encounter_type) FROM enc_types t
     WHERE t.is_active AND t.visit_type_c = v.visit_type_c) AS encounter_type
  FROM {enc} v WHERE datediff('day', CAST(encounter_dttm AS DATE), {as_of}) <= {lookback}),
{name} AS (
  SELECT pat_id, encounter_id, charge_id, encounter_dttm, encounter_type, cpt_code, primary_dx_code,
    NULL::VARCHAR AS payer_id, billed_amt, allowed_amt, paid_amt,
    CAST(allowed_amt - paid_amt AS DECIMAL(12,2)) AS patient_responsibility,
    if(billed_amt > 10000, 'Y', 'N') AS high_cost_flag,
    claim_status, {load} AS load_dttm, {load} AS updated_dttm
  FROM (SELECT * EXCLUDE (load_dttm) FROM {charges} WHERE claim_status <> 'DENIED')
  JOIN (FROM {name}_visits WHERE encounter_type IS NOT NULL) USING (encounter_id))"""


def quality(name="quality", year=2000, load=LOAD, src="eligibility", enc="dim_encounter") -> str:
    return f"""{name} AS (
  SELECT pat_id, encounter_id, encounter_dttm, mrn,
    CAST(datediff('year', birth_date, CAST(encounter_dttm AS DATE)) AS INTEGER) AS age_at_encounter,
    measure_id, measure_name, measure_eligible, measure_compliant, encounter_type,
    {load} AS load_dttm, {load} AS updated_dttm
  FROM (SELECT encounter_id, encounter_dttm FROM {enc}
        WHERE encounter_dttm >= DATE '{year}-01-01' AND encounter_dttm < DATE '{year + 1}-01-01')
  JOIN (SELECT * EXCLUDE (age_at_encounter, load_dttm) FROM {src}
        WHERE measure_eligible = 'Y') USING (encounter_id)
  JOIN (SELECT pat_id, birth_date, mrn_token AS mrn FROM dim_patient WHERE is_current) USING (pat_id))"""


def gaps(name="gaps", as_of=AS_OF, load=LOAD, src="quality") -> str:
    """Priority by counting the limits that the days since the last visit exceed."""
    return f"""{name}_last AS (
  SELECT pat_id, datediff('day', CAST(encounter_dttm AS DATE), {as_of}) AS idle, kind FROM (
    SELECT pat_id, encounter_id, encounter_dttm, t.encounter_type AS kind
    FROM dim_encounter LEFT JOIN (FROM enc_types WHERE is_active) t USING (visit_type_c)
    WHERE encounter_dttm IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY pat_id
      ORDER BY encounter_dttm DESC, t.encounter_type IS NULL, encounter_id DESC) = 1)
  WHERE kind IS NOT NULL),
{name} AS (
  SELECT pat_id, mrn, measure_id, measure_name, CAST(idle AS INTEGER) AS days_since_last_encounter,
    ['LOW', 'MEDIUM', 'HIGH'][1 + CAST(coalesce(idle, 0) > 180 AS INTEGER)
                                + CAST(coalesce(idle, 0) > 365 AS INTEGER)] AS gap_priority,
    kind AS encounter_type_for_outreach, primary_payer_id, {load} AS load_dttm, {load} AS updated_dttm
  FROM (SELECT pat_id, measure_id, max(measure_name) AS measure_name FROM {src}
        GROUP BY pat_id, measure_id, measure_eligible, measure_compliant
        HAVING measure_eligible = 'Y' AND measure_compliant = 'N')
  LEFT JOIN (SELECT pat_id, mrn_token AS mrn, payer_name AS primary_payer_id FROM dim_patient
             WHERE is_current) USING (pat_id)
  LEFT JOIN {name}_last USING (pat_id))"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _core() -> list[str]:
    return silver_ctes() + [eligibility(), quality(), gaps(), billing()]


def build_batches() -> dict[str, str]:
    core = _core()
    q = {}
    q["stage_patients"] = with_([bronze_patient(), stg_patient()], "SELECT * FROM stg_patient")
    q["stage_encounters"] = with_([ENC_TYPES, bronze_encounter(), dim_encounter()],
                                  "SELECT * FROM dim_encounter")
    q["stage_charges"] = with_([bronze_charge(), staged_charges()], "SELECT * FROM staged_charges")
    q["eligibility"] = with_(core, "SELECT * FROM eligibility")
    q["billing_batch"] = with_(core, "SELECT * FROM billing")
    q["quality_batch"] = with_(core, "SELECT * FROM quality")
    q["gap_batch"] = with_(core, "SELECT * FROM gaps")
    q["mart_summary"] = with_(core, """SELECT count(*) AS row_count,
      count(DISTINCT (pat_id, encounter_id, measure_id)) FILTER (WHERE pat_id IS NOT NULL
        AND encounter_id IS NOT NULL AND measure_id IS NOT NULL) AS distinct_keys,
      CAST(count(*) FILTER (WHERE measure_compliant = 'Y') AS BIGINT) AS compliant_count,
      CASE WHEN count(*) > 0 AND count(*) != count(DISTINCT (pat_id, encounter_id, measure_id))
           THEN 'FAIL' ELSE 'PASS' END AS status
      FROM quality WHERE year(encounter_dttm) = 2000""")
    q["gap_summary"] = with_(core, """SELECT count(*) AS row_count,
      count(DISTINCT (pat_id, measure_id)) AS distinct_keys,
      CAST(count(*) FILTER (WHERE gap_priority = 'HIGH') AS BIGINT) AS high_priority,
      CASE WHEN count(*) > 0 AND count(*) != count(DISTINCT (pat_id, measure_id))
           THEN 'FAIL' ELSE 'PASS' END AS status
      FROM gaps""")
    q["gap_distribution"] = with_(core, """SELECT gap_priority, count(*) AS gap_count
      FROM gaps GROUP BY gap_priority""")
    return q


ENC_COLS = ("pat_id, encounter_id, visit_type_c, encounter_type, encounter_dttm, dept_id, "
            "prov_id, primary_dx_id, primary_dx_code, encounter_status, load_dttm")
T_0702 = "TIMESTAMP '2001-07-02 00:00:00'"
T_0201 = "TIMESTAMP '2001-02-01 00:00:00'"
PAT_ATTRS = ["mrn_token", "first_name", "last_name", "gender", "zip_code", "payer_name"]


def _anti_union(target: str, source: str, keys: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (f"SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {on})\n"
            f"UNION ALL SELECT * FROM {source}")


def _merge_keep_load(target: str, source: str, keys: list[str]) -> str:
    """Matched: source values except keys and load_dttm (from target)."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return f"""SELECT s.* REPLACE (t.load_dttm AS load_dttm) FROM {target} t JOIN {source} s ON {on}
UNION ALL SELECT t.* FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {on})
UNION ALL SELECT s.* FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"""


def _enc_mod(col: str = "encounter_id") -> str:
    return f"CAST(substr({col}, 2) AS BIGINT) % 3"


def build_more() -> dict[str, str]:
    q = {}
    core = _core()
    # --- upserts -----------------------------------------------------------------
    q["encounter_upsert"] = with_([
        ENC_TYPES,
        bronze_encounter("b1", "o_orderkey % 3 != 2"), dim_encounter("s1", "b1", T1),
        bronze_encounter("b2", "o_orderkey % 3 != 0", "'F'"), dim_encounter("s2", "b2", LOAD),
    ], _anti_union("s1", "s2", ["encounter_id"]))
    q["charge_upsert"] = with_([
        bronze_charge("b1", "l_orderkey % 3 != 2"), fact_charges("s1", "b1", T1),
        bronze_charge("b2", "l_orderkey % 3 != 0", "'ADJUSTED'"), fact_charges("s2", "b2", LOAD),
    ], _anti_union("s1", "s2", ["encounter_id", "charge_id"]))
    changed = " OR ".join([f"v.{a} != s.{a}" for a in PAT_ATTRS]
                          + ["v.birth_date IS DISTINCT FROM s.birth_date"])
    cols = "pat_id, mrn_token, first_name, last_name, birth_date, gender, zip_code, payer_name"
    q["patient_scd2"] = with_([
        bronze_patient("b1", "c_custkey % 4 != 3"), stg_patient("s1", "b1"),
        bronze_patient("b2", "TRUE", "CASE WHEN c_custkey % 5 = 0 THEN 'SELF-PAY' ELSE payer_name END"),
        stg_patient("s2", "b2"),
        dim_patient("v1", "s1", "DATE '2001-08-01'", T1),
        f"""chg AS (SELECT v.pat_id FROM v1 v JOIN s2 s ON v.pat_id = s.pat_id WHERE {changed})""",
    ], f"""SELECT * FROM v1 WHERE pat_id NOT IN (SELECT pat_id FROM chg)
UNION ALL SELECT * REPLACE (DATE '2001-08-02' AS expiration_date, false AS is_current)
  FROM v1 WHERE pat_id IN (SELECT pat_id FROM chg)
UNION ALL SELECT {cols}, DATE '2001-08-02' AS effective_date, NULL::DATE AS expiration_date,
  true AS is_current, {LOAD} AS load_dttm
  FROM s2 WHERE pat_id IN (SELECT pat_id FROM chg) OR pat_id NOT IN (SELECT pat_id FROM v1)""")
    q["eligibility_upsert"] = with_(silver_ctes() + [
        f"enc1 AS (SELECT * FROM dim_encounter WHERE {_enc_mod()} != 2)",
        f"enc2 AS (SELECT * FROM dim_encounter WHERE {_enc_mod()} != 0)",
        eligibility("e1", load=T1, enc="enc1"), eligibility("e2", load=LOAD, enc="enc2"),
    ], _anti_union("e1", "e2", ["pat_id", "encounter_id", "measure_id"]))
    billing_both = silver_ctes() + [billing("b_prior", "DATE '2001-07-02'", T_0702), billing()]
    q["billing_upsert"] = with_(billing_both, _merge_keep_load(
        "b_prior", "billing", ["encounter_id", "charge_id"]))
    q["quality_upsert"] = with_(silver_ctes() + [
        eligibility(), eligibility("e_old", load=T1, compliant=("WELLNESS",)),
        quality("q99", 1999, T1, "e_old"), quality("q00_old", 2000, T1, "e_old"),
        "q_prior AS (SELECT * FROM q99 UNION ALL SELECT * FROM q00_old)",
        quality(),
    ], _merge_keep_load("q_prior", "quality", ["pat_id", "encounter_id", "measure_id"]))
    q["gap_upsert"] = with_(silver_ctes() + [
        eligibility(), quality(), gaps(),
        quality("q99", 1999, T_0201), gaps("g_prior", "DATE '2001-02-01'", T_0201, "q99"),
    ], _merge_keep_load("g_prior", "gaps", ["pat_id", "measure_id"]))
    q["idempotency"] = with_(billing_both + [
        "merged AS (" + _merge_keep_load("b_prior", "billing", ["encounter_id", "charge_id"]) + ")"
    ], """SELECT count(*) AS row_count,
      count(DISTINCT (encounter_id, charge_id)) AS distinct_keys,
      CASE WHEN count(*) > 0 AND count(*) != count(DISTINCT (encounter_id, charge_id))
           THEN 'FAIL' ELSE 'PASS' END AS status FROM merged""")
    q["dup_keys"] = with_([bronze_charge()], """SELECT encounter_id, charge_id, count(*) AS dup_count
      FROM bronze_charge GROUP BY encounter_id, charge_id HAVING count(*) > 1""")
    q["false_positives"] = with_(core + ["""probes AS (SELECT encounter_id, count(*) AS n
      FROM fact_charges WHERE cpt_code = '9921' GROUP BY encounter_id)""",
        "full_code AS (SELECT measure_id FROM codes WHERE (code_type, code_value) = ('CPT', '99213'))"],
        """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS fp_count
      FROM eligibility SEMI JOIN full_code USING (measure_id) JOIN probes USING (encounter_id)""")
    # --- checks ------------------------------------------------------------------------
    ncols = ["pat_id", "mrn", "first_name", "birth_date", "gender", "payer_name"]
    parts = [f"""SELECT 'bronze.dim_patient' AS table_name, '{c}' AS column_name,
        count(*) AS row_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count,
        CASE WHEN count(*) > 0 THEN round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6)
             ELSE 0.0 END AS null_rate FROM bronze_patient""" for c in ncols]
    q["null_rate"] = with_([bronze_patient(), "r AS (" + " UNION ALL ".join(parts) + ")"],
                           """SELECT *, CASE WHEN row_count > 0 AND null_rate > 0.0 THEN 'FAIL'
                              ELSE 'PASS' END AS column_status FROM r""")
    q["row_count_threshold"] = with_([
        """snaps AS (SELECT CAST(ts AS DATE) AS day, count(*) AS row_count, max(ts) AS assertion_dttm
           FROM events WHERE ts < TIMESTAMP '2024-01-30 00:00:00' GROUP BY 1)""",
        """hist AS (SELECT row_count FROM snaps WHERE assertion_dttm >= TIMESTAMP '2024-01-23 00:00:00')""",
        """cur AS (SELECT count(*) AS c FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30')""",
        """agg AS (SELECT (SELECT c FROM cur) AS current_count, count(row_count) AS history_samples,
           avg(row_count) AS a FROM hist)""",
    ], """SELECT 'events' AS table_name, current_count, history_samples,
      round(a, 2) AS trailing_avg, CAST(floor(a * 0.8) AS BIGINT) AS minimum_required,
      CASE WHEN history_samples = 0 THEN 'PASS'
           WHEN current_count >= CAST(floor(a * 0.8) AS BIGINT) THEN 'PASS' ELSE 'FAIL' END AS status
      FROM agg""")
    orph = """orph AS (SELECT DISTINCT pat_id FROM quality q
      WHERE NOT EXISTS (SELECT 1 FROM billing b WHERE b.pat_id = q.pat_id))"""
    q["referential_integrity"] = with_(core + [orph], """SELECT 'gold_quality.measures' AS child_table,
      'gold_billing.claims_processed' AS parent_table, 'pat_id' AS key_column,
      count(*) AS orphan_count, CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
      FROM orph""")
    q["orphan_sample"] = with_(core + [orph],
                               "SELECT pat_id FROM orph ORDER BY pat_id NULLS FIRST LIMIT 10")
    nk = []
    for tname, cte, cols_ in [("silver.dim_patient", "dim_patient", ["pat_id"]),
                              ("silver.dim_encounter", "dim_encounter", ["pat_id", "encounter_id"]),
                              ("silver.fact_charges", "fact_charges", ["encounter_id"])]:
        for c in cols_:
            nk.append(f"""SELECT '{tname}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
              count(*) FILTER (WHERE {c} IS NULL) AS null_count,
              CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
              FROM {cte}""")
    q["silver_null_keys"] = with_(silver_ctes(), " UNION ALL ".join(nk))
    q["mapping_drift"] = with_(silver_ctes(), """SELECT count(*) AS unmapped_count,
      if(count(*) = 0, 'PASS', 'FAIL') AS status
      FROM dim_encounter WHERE encounter_type <> 'OTHER'
        AND visit_type_c NOT IN (SELECT visit_type_c FROM enc_types)""")
    bad = {"short_codes": "(code_type = 'CPT' AND length(code_value) < 4) OR (code_type = 'ICD10' AND length(code_value) < 3)",
           "delimited_codes": "regexp_matches(code_value, '[, ]')",
           "invalid_types": "code_type NOT IN ('CPT', 'ICD10')"}
    counted = ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in bad.items())
    per = "\n      UNION ALL ".join(
        f"""SELECT {t} AS code_type, {m} AS measure_id, count(*) AS row_count,
          count(DISTINCT (measure_id, code_type, code_value)) AS distinct_keys, {counted}
        FROM observed GROUP BY {by}""" for t, m, by in (("code_type", "NULL", "code_type"), ("NULL", "measure_id", "measure_id")))
    q["validate_codes"] = with_(silver_ctes() + [f"""observed AS (
      SELECT coalesce(c.measure_id, 'NONE') AS measure_id, o.code_type, o.code_value FROM (
        SELECT 'CPT' AS code_type, cpt_code AS code_value FROM fact_charges WHERE cpt_code IS NOT NULL
        UNION SELECT 'ICD10', primary_dx_code FROM dim_encounter WHERE primary_dx_code IS NOT NULL) o
      LEFT JOIN codes c USING (code_type, code_value))""", f"per AS ({per})"],
        """SELECT *, if(row_count = distinct_keys AND short_codes + delimited_codes + invalid_types = 0, 'PASS', 'FAIL')
           AS status FROM per""")
    q["unmapped_types"] = with_([ENC_TYPES, bronze_encounter()], """SELECT visit_type_c, count(*) AS encounters
      FROM bronze_encounter WHERE visit_type_c IS NULL
        OR visit_type_c NOT IN (SELECT visit_type_c FROM enc_types WHERE is_active) GROUP BY visit_type_c""")
    q["mapping_drift_retired"] = with_([bronze_encounter()], """SELECT count(*) AS unmapped_count,
      if(count(*) = 0, 'PASS', 'FAIL') AS status
      FROM (SELECT DISTINCT encounter_id FROM bronze_encounter WHERE visit_type_c = 201)""")
    q["dated_codes"] = with_(silver_ctes() + ["""more_codes AS (FROM codes
      UNION ALL VALUES ('OLD', 'CPT', '99213', DATE '2020-01-01', DATE '2024-06-29'),
        ('LAST', 'CPT', '99213', DATE '2020-01-01', DATE '2024-06-30'),
        ('FIRST', 'CPT', '99213', DATE '2024-06-30', NULL), ('LATER', 'ICD10', 'I10', DATE '2024-07-01', NULL))""",
        eligibility("dated", codes="more_codes")],
        "SELECT measure_id, count(*) AS eligible_rows FROM dated GROUP BY measure_id")
    key = "CAST(substr(encounter_id, 2) AS BIGINT)"
    flawed = {
        "encounter": (f"""SELECT if(k % 101 = 0, NULL, if(k % 103 = 0, ' ', pat_id)) AS pat_id,
            if(k % 107 = 0, '', if(k % 109 = 0, encounter_id || ',E0', encounter_id)) AS encounter_id,
            if(k % 113 = 0, NULL, encounter_dttm) AS encounter_dttm
          FROM (SELECT *, {key} AS k FROM bronze_encounter)""",
                      {"pat_id_not_null": "pat_id IS NULL", "encounter_id_not_null": "encounter_id IS NULL",
                       "pat_id_filled": "trim(pat_id) = ''", "encounter_id_filled": "trim(encounter_id) = ''",
                       "encounter_id_single": "regexp_matches(encounter_id, '[, ]')",
                       "encounter_dttm_not_null": "encounter_dttm IS NULL"}),
        "charge_detail": (f"""SELECT encounter_id, if(k % 127 = 0, NULL, charge_id) AS charge_id,
            CASE WHEN k % 101 = 0 THEN '' WHEN k % 103 = 0 THEN '99213, 99214' WHEN k % 107 = 0 THEN '992' ELSE cpt_code END AS cpt_code,
            billed_amt, allowed_amt, if(k % 109 = 0, -paid_amt, paid_amt) AS paid_amt
          FROM (SELECT *, {key} AS k FROM bronze_charge)""",
                          {"encounter_id_not_null": "encounter_id IS NULL", "charge_id_not_null": "charge_id IS NULL",
                           "encounter_id_filled": "trim(encounter_id) = ''", "charge_id_filled": "trim(charge_id) = ''",
                           "cpt_code_filled": "trim(cpt_code) = ''", "cpt_code_single": "regexp_matches(cpt_code, '[, ]')",
                           "cpt_code_length": "length(cpt_code) < 4",
                           "amounts_not_negative": "billed_amt < 0 OR allowed_amt < 0 OR paid_amt < 0"})}
    parts = []
    for name, (rows, rules) in flawed.items():
        any_bad = " OR ".join(f"coalesce({c}, false)" for c in rules.values())
        parts += [f"""SELECT '{name}' AS table_name, '{r}' AS rule, count(*) FILTER (WHERE {c}) AS rows_broken,
          count(*) FILTER (WHERE NOT ({any_bad})) AS rows_kept, count(*) FILTER (WHERE {any_bad}) AS rows_quarantined
        FROM flawed_{name}""" for r, c in rules.items()]
    q["row_constraints"] = with_([bronze_encounter(), bronze_charge()] + [
        f"flawed_{n} AS ({r})" for n, (r, _) in flawed.items()], "\n      UNION ALL ".join(parts))
    q["sql_billed_by_type"] = with_(silver_ctes(), f"""SELECT encounter_type, count(*) AS charges,
        sum(billed_amt)::DECIMAL(22,2) AS billed, count(*) FILTER (WHERE billed_amt > 10000) AS high_cost,
        count(*) FILTER (WHERE claim_status = 'DENIED') AS denied
      FROM dim_encounter JOIN (SELECT * EXCLUDE (load_dttm) FROM fact_charges) USING (encounter_id)
      WHERE datediff('day', CAST(encounter_dttm AS DATE), {AS_OF}) <= 90 GROUP BY encounter_type""")
    q["table_properties"] = """SELECT unnest(['quality', 'source', 'description', 'rows', 'customers']) AS property,
        unnest(['reference', 'customer', 'it''s by segment', count(DISTINCT c_mktsegment)::VARCHAR, count(*)::VARCHAR]) AS value
      FROM customer"""
    # --- stage log / SLA / reports ---------------------------------------------------------
    stage_log = f"""stage_log AS (SELECT 'run-' || user_id AS run_id, event_type AS stage_name,
      min(ts) AS start_time, max(ts) AS end_time,
      CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      count(*) AS row_count, '{{"source":"events"}}' AS details, {LOAD} AS logged_at
      FROM events GROUP BY user_id, event_type)"""
    q["stage_log"] = with_([stage_log], "SELECT * FROM stage_log")
    q["sla_report"] = with_([stage_log, """runs AS (SELECT run_id, max(end_time) AS run_end_time,
        count(*) AS stage_count, count(*) FILTER (WHERE status = 'FAILED') AS failed_stages
        FROM stage_log GROUP BY run_id)"""],
        """SELECT *, run_completed_local <= CAST(CAST(run_completed_local AS DATE) AS TIMESTAMP)
                     + INTERVAL 6 HOUR AS sla_met
           FROM (SELECT *, timezone('America/New_York', timezone('UTC', run_end_time))
                 AS run_completed_local FROM runs)""")
    q["inventory_census"] = """SELECT CAST(coalesce(sum(segments), 0) AS BIGINT) AS total_schemas,
      count(*) AS total_catalogs,
      if(sum(segments) = 15 AND count(*) = 3, 'PASS', 'FAIL') AS census_result
      FROM (SELECT n_name, count(DISTINCT c_mktsegment) AS segments
            FROM nation JOIN customer ON n_nationkey = c_nationkey
            WHERE regexp_full_match(n_name, 'NATION_[123]') AND list_contains(
              ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment)
            GROUP BY n_name)"""
    q["pattern_report"] = """SELECT page_id, url,
      CASE WHEN url LIKE 'https://%.example.%/%' THEN 'PASS' ELSE 'FAIL' END AS url_format_check
      FROM pages"""
    q["recent_activity"] = """SELECT event_id, ts, user_id, event_type, value,
      CAST(json_extract(props, '$.k') AS INTEGER) AS prop_k
      FROM events WHERE event_type = 'error'
        AND ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY
      ORDER BY ts DESC, event_id DESC LIMIT 20"""
    return q


def _pipeline_ctes() -> list[str]:
    return ([ENC_TYPES, CODES, MEASURE_DEFS, bronze_patient(), stg_patient(), dim_patient(),
             bronze_encounter(), dim_encounter(), bronze_charge(), fact_charges()]
            + [eligibility(), quality(), billing(), gaps(),
               """ri AS (SELECT count(DISTINCT pat_id) AS orphans FROM quality q
                  WHERE NOT EXISTS (SELECT 1 FROM billing b WHERE b.pat_id = q.pat_id))""",
               """cnt AS (SELECT (SELECT count(*) FROM orders) AS n_orders,
                  (SELECT count(*) FROM eligibility) AS n_elig,
                  (SELECT count(*) FROM billing) AS n_bill,
                  (SELECT count(*) FROM quality) AS n_qual,
                  (SELECT count(*) FROM gaps) AS n_gaps,
                  (SELECT orphans FROM ri) AS orphans)"""])


def build_pipeline() -> dict[str, str]:
    """Stage log and audit trail of the gated run. Gates on nulls and row
    counts pass by construction (keys are never NULL, no history yet); the
    cross-mart check fails exactly when quality has patients without claims."""
    ri_status = "CASE WHEN orphans > 0 THEN 'FAILED' ELSE 'SUCCESS' END"
    after = "CASE WHEN orphans > 0 THEN 'UPSTREAM_FAILED' ELSE 'SUCCESS' END"
    gated = with_(_pipeline_ctes(), f"""
      SELECT 'bronze_ingestion' AS stage_name, 'SUCCESS' AS status, n_orders AS row_count FROM cnt
      UNION ALL SELECT 'silver_patient_encounter', 'SUCCESS', n_orders FROM cnt
      UNION ALL SELECT 'silver_hedis_eligibility', 'SUCCESS', n_elig FROM cnt
      UNION ALL SELECT 'gold_billing_mart', 'SUCCESS', n_bill FROM cnt
      UNION ALL SELECT 'billing_dq', 'SUCCESS', n_bill FROM cnt
      UNION ALL SELECT 'gold_quality_mart', 'SUCCESS', n_qual FROM cnt
      UNION ALL SELECT 'quality_dq', {ri_status}, n_qual FROM cnt
      UNION ALL SELECT 'gold_care_gaps', {after},
        CASE WHEN orphans > 0 THEN NULL ELSE n_gaps END FROM cnt
      UNION ALL SELECT 'care_gaps_dq', {after},
        CASE WHEN orphans > 0 THEN NULL ELSE n_gaps END FROM cnt""")
    b, qn, g = ("gold_billing.claims_processed", "gold_quality.measures",
                "gold_care_mgmt.gap_queue")
    per_mart = "".join(f"""
      UNION ALL SELECT '{m}', 'null_rate:{keys}', 'PASS', {n}, 0.0::DOUBLE, NULL, NULL, NULL FROM cnt{where}
      UNION ALL SELECT '{m}', 'row_count_threshold', 'PASS', {n}, NULL, 0.8::DOUBLE, 7, NULL FROM cnt{where}
      UNION ALL SELECT '{m}', 'row_count_snapshot', 'PASS', {n}, NULL, NULL, NULL, NULL FROM cnt{where}"""
                       for m, keys, n, where in (
                           (b, "pat_id,encounter_id,charge_id", "n_bill", ""),
                           (qn, "pat_id,encounter_id,measure_id", "n_qual", ""),
                           (g, "pat_id,measure_id", "n_gaps", " WHERE orphans = 0")))
    hist = with_(_pipeline_ctes(), f"""
      SELECT '{qn}' AS mart_name, 'referential_integrity:{qn}->{b}' AS assertion_name,
             CASE WHEN orphans > 0 THEN 'FAIL' ELSE 'PASS' END AS status, orphans AS observed_count,
             NULL::DOUBLE AS max_null_rate, NULL::DOUBLE AS threshold_ratio,
             NULL::BIGINT AS trailing_days, least(orphans, 10)::BIGINT AS listed_orphans FROM cnt{per_mart}""")
    gate = "CASE WHEN rows < floor(coalesce(before, 0) * 0.8) THEN 'FAILED' ELSE 'SUCCESS' END"
    later = lambda t, key, day, extra: f"""{t}2 AS (FROM {t} UNION ALL
      SELECT * REPLACE ({day} + INTERVAL 1 DAY AS {day}{extra}) FROM {t} WHERE {key} % 50 = 0 UNION ALL
      SELECT * REPLACE ({key} + 10000000000 AS {key}) FROM {t} WHERE {key} % 100 = 7)"""  # noqa: E731
    pairs = lambda keys, a, b: f"(SELECT count(*) FROM (SELECT {keys} FROM {a} UNION SELECT {keys} FROM {b}))"
    nights = with_(_pipeline_ctes() + [
        later("orders", "o_orderkey", "o_orderdate", ", 'F' AS o_orderstatus"),
        later("lineitem", "l_orderkey", "l_shipdate", ""),
        bronze_encounter("be2", table="orders2"), dim_encounter("de2", "be2"),
        bronze_charge("bc2", table="lineitem2"), fact_charges("fc2", "bc2"),
        eligibility("el2", enc="de2", charges="fc2"), quality("qu2", src="el2", enc="de2"),
        billing("b_first", "DATE '2001-08-01'"), billing("bi2", enc="de2", charges="fc2"),
        """open1 AS (SELECT pat_id, measure_id FROM quality WHERE measure_compliant = 'N')""",
        """open2 AS (SELECT pat_id, measure_id FROM qu2 WHERE measure_compliant = 'N')""",
        f"""n2 AS (SELECT (SELECT count(*) FROM orders2) AS bronze2, (SELECT count(*) FROM de2) AS enc2,
          {pairs("pat_id, encounter_id, measure_id", "eligibility", "el2")} AS elig2,
          (SELECT count(*) FROM b_first) AS bill1, {pairs("encounter_id, charge_id", "b_first", "bi2")} AS bill2,
          {pairs("pat_id, encounter_id, measure_id", "quality", "qu2")} AS qual2,
          {pairs("pat_id, measure_id", "open1", "open2")} AS gaps2, cnt.* FROM cnt)""",
        """outputs AS (
          SELECT unnest([{'stage': 'bronze_ingestion', 'one': n_orders, 'two': bronze2},
            {'stage': 'silver_patient_encounter', 'one': n_orders, 'two': enc2},
            {'stage': 'silver_hedis_eligibility', 'one': n_elig, 'two': elig2},
            {'stage': 'gold_billing_mart', 'one': bill1, 'two': bill2},
            {'stage': 'billing_dq', 'one': bill1, 'two': bill2},
            {'stage': 'gold_quality_mart', 'one': n_qual, 'two': qual2},
            {'stage': 'quality_dq', 'one': n_qual, 'two': qual2},
            {'stage': 'gold_care_gaps', 'one': n_gaps, 'two': gaps2},
            {'stage': 'care_gaps_dq', 'one': n_gaps, 'two': gaps2}]) AS o FROM n2)""",
        """runs AS (SELECT 1 AS night, o.stage AS stage_name, o.one AS rows, NULL::BIGINT AS before FROM outputs
          UNION ALL SELECT 2, o.stage, o.two, CASE WHEN o.stage LIKE '%_dq' THEN o.one END FROM outputs)""",
    ], f"SELECT night, stage_name, {gate} AS status, rows AS row_count FROM runs")
    return {"gated_run": gated, "dq_history": hist, "two_nights": nights}


def build_runtime() -> dict[str, str]:
    return {"dedupe_latest": """SELECT event_id, ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                     ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
        FROM events) x WHERE rn = 1""",
            "ingest_profile": """SELECT table_name, total_rows, 1::BIGINT AS distinct_batches,
        total_rows AS rows_with_metadata, true AS times_in_order, true AS observed_agrees
      FROM (SELECT 'bronze.encounter' AS table_name, count(*) AS total_rows FROM orders
        UNION ALL SELECT 'bronze.charge_detail', count(*) FROM lineitem
        UNION ALL SELECT 'bronze.dim_patient', count(*) FROM customer
        UNION ALL SELECT 'bronze.icd10_reference', count(*) FROM part
        UNION ALL SELECT 'bronze.hedis_measure_definition', 4)"""}


def build() -> dict[str, str]:
    q = build_batches()
    q.update(build_more())
    q.update(build_runtime())
    q.update(build_pipeline())
    return q
