"""Independent SQL statements of every registered query (DuckDB dialect).

They run against the raw fixture tables only (``customer``, ``nation``,
``region``, ``orders``) and restate the mapping, the rules and the reports in
plain SQL, so a Spark result can be compared with another engine. Doubles are
written with an exponent (``100e0``) and rounding goes through
``DECIMAL(38,12)`` exactly as in :mod:`tierone.functions.rounding`.
"""

from __future__ import annotations

from tierone.config import FIXED_RUN, FIXTURE_SOURCE

RUN_ID = FIXED_RUN.run_id
RUN_TS = FIXED_RUN.run_ts_sql
INGESTED_AT = FIXED_RUN.ingested_at
RUN_DATE = FIXED_RUN.run_date.isoformat()
# Completion time of the earlier, partial ingest in the ledger queries.
EARLIER_INGESTED_AT = "2024-06-30T00:00:00"
# Run id of the one-quarter re-run in ``partition_overwrite``.
RERUN_ID = "20250115_000000"
RERUN_TS = "2025-01-15 00:00:00"

# Descriptions of the dimension and its columns.
DIM_DESCRIPTION = "Institution dimension with effective / expiry dated versions"
DIM_COLUMNS = {
    "cert": "Institution certificate number",
    "name": "Institution name",
    "city": "City",
    "stalp": "State code",
    "instcat": "Institution category",
    "charterclass": "Charter class",
    "active": "Active flag",
    "effective_date": "First report date of this version YYYYMMDD",
    "expiry_date": "Report date of the next version, 99991231 if current",
    "is_current": "True for the open version",
    "row_created_at": "Run time that built the row (UTC)",
}


def r(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


INST = f"""
inst AS (
  SELECT
    CASE WHEN c.c_custkey % 97 = 3 THEN NULL ELSE 10001 + CAST(c.c_custkey AS BIGINT) END AS cert,
    CASE WHEN c.c_custkey % 89 = 5 THEN '   ' WHEN c.c_custkey % 89 = 6 THEN NULL
         ELSE c.c_name END AS name,
    n.n_name AS city,
    r.r_name AS stname,
    'N' || CAST(n.n_nationkey AS VARCHAR) AS stalp,
    CAST(ROUND(c.c_acctbal * 100e0) AS BIGINT) AS asset,
    '20241231' AS repdte,
    CAST(CASE WHEN c.c_custkey % 83 = 7 THEN 9 WHEN c.c_custkey % 83 = 8 THEN NULL
              WHEN c.c_custkey % 12 = 11 THEN 0 ELSE 1 END AS BIGINT) AS active,
    CAST(1 + c.c_custkey % 4 AS BIGINT) AS instcat,
    CASE c.c_custkey % 4 WHEN 0 THEN 'N' WHEN 1 THEN 'SM' WHEN 2 THEN 'NM' ELSE 'SB' END
      AS charterclass,
    '{INGESTED_AT}' AS _ingested_at,
    '{FIXTURE_SOURCE}' AS _source
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

FIN = f"""
fin_base AS (
  SELECT CAST(o_custkey AS BIGINT) AS k,
         CAST(EXTRACT(YEAR FROM o_orderdate) + 24 AS INTEGER) AS year,
         CAST(EXTRACT(QUARTER FROM o_orderdate) AS INTEGER) AS quarter,
         CAST(SUM(CAST(ROUND(o_totalprice * 100e0) AS BIGINT)) AS BIGINT) AS a
  FROM orders GROUP BY 1, 2, 3
),
fin_m AS (
  SELECT *, k * 7919 + CAST(year AS BIGINT) * 104729 + CAST(quarter AS BIGINT) * 1299709 AS m
  FROM fin_base
),
fin AS (
  SELECT
    CASE WHEN m % 211 = 0 THEN NULL ELSE 10001 + k END AS cert,
    CASE WHEN m % 223 = 0 THEN '2024Q1'
         ELSE CAST(year AS VARCHAR) || CASE quarter WHEN 1 THEN '0331' WHEN 2 THEN '0630'
                                                    WHEN 3 THEN '0930' WHEN 4 THEN '1231' END
    END AS repdte,
    CASE WHEN m % 227 = 0 THEN CAST(0 AS BIGINT) ELSE a END AS asset,
    CASE WHEN m % 229 = 0 THEN CAST(-1 AS BIGINT)
         ELSE CAST(FLOOR(a * (650 + m % 201) / 1000e0) AS BIGINT) END AS dep,
    CAST(FLOOR(a * (450 + m % 251) / 1000e0) AS BIGINT) AS lnlsnet,
    CAST(FLOOR(a * (100 + m % 51) / 10000e0) AS BIGINT) AS intinc,
    CAST(FLOOR(a * (20 + m % 41) / 10000e0) AS BIGINT) AS eintexp,
    CAST(FLOOR(a * (10 + m % 31) / 10000e0) AS BIGINT) AS netinc,
    CASE WHEN m % 233 = 0 THEN 101e0 WHEN m % 239 = 0 THEN NULL
         ELSE (400 + m % 1401) / 100e0 END AS rbct1,
    CAST(FLOOR(a * (50 + m % 251) / 10000e0) AS BIGINT) AS nperfv,
    '{INGESTED_AT}' AS _ingested_at,
    '{FIXTURE_SOURCE}' AS _source,
    year,
    quarter
  FROM fin_m
)"""

INST_TAGGED = """
inst_t AS (
  SELECT *, CONCAT_WS('; ',
      CASE WHEN cert IS NULL THEN 'cert_is_null' END,
      CASE WHEN asset <= 0 THEN 'asset_non_positive' END,
      CASE WHEN name IS NULL OR TRIM(name) = '' THEN 'name_empty' END,
      CASE WHEN NOT (active IN (0, 1)) THEN 'active_invalid_value' END) AS rejection_reason
  FROM inst
)"""

FIN_TAGGED = """
fin_t AS (
  SELECT *, CONCAT_WS('; ',
      CASE WHEN cert IS NULL THEN 'cert_is_null' END,
      CASE WHEN asset <= 0 THEN 'asset_non_positive' END,
      CASE WHEN dep <= 0 THEN 'dep_non_positive' END,
      CASE WHEN rbct1 < 0 OR rbct1 > 100 THEN 'rbct1_out_of_range' END,
      CASE WHEN LENGTH(repdte) <> 8 THEN 'repdte_invalid_format' END) AS rejection_reason
  FROM fin
)"""

SILVER = f"""
inst_s AS (
  SELECT cert, name, city, stname, stalp, asset, repdte, active, instcat, charterclass,
         _ingested_at, _source, '{RUN_ID}' AS _transformed_at
  FROM inst_t WHERE rejection_reason = ''
),
fin_s AS (
  SELECT cert, repdte, asset, dep, lnlsnet, intinc, eintexp, netinc, rbct1, nperfv,
         _ingested_at, _source, '{RUN_ID}' AS _transformed_at, year, quarter
  FROM fin_t WHERE rejection_reason = ''
)"""

HEALTH = f"""
health AS (
  SELECT f.cert, i.name, i.city, i.stalp, f.repdte, f.year, f.quarter, f.asset, f.dep,
         f.lnlsnet, f.rbct1,
         {r("f.nperfv / NULLIF(f.asset, 0) * 100e0", 2)} AS npl_ratio_pct,
         {r("f.netinc / NULLIF(f.asset, 0) * 100e0", 4)} AS roa_pct,
         {r("f.dep / NULLIF(f.asset, 0) * 100e0", 2)} AS deposit_to_asset_pct,
         CASE WHEN f.rbct1 >= 10 THEN 'Well Capitalised'
              WHEN f.rbct1 >= 8 THEN 'Adequately Capitalised'
              WHEN f.rbct1 >= 6 THEN 'Undercapitalised'
              ELSE 'Critically Undercapitalised' END AS capital_adequacy_flag,
         TIMESTAMP '{RUN_TS}' AS _loaded_at
  FROM fin_s f LEFT JOIN inst_s i ON f.cert = i.cert
)"""

DIM = f"""
dim AS (
  SELECT cert, name, city, stalp, instcat, charterclass, active,
         repdte AS effective_date, '99991231' AS expiry_date, TRUE AS is_current,
         TIMESTAMP '{RUN_TS}' AS row_created_at
  FROM inst_s
)"""

SCORE = f"""
score AS (
  SELECT '{RUN_ID}' AS run_id, DATE '{RUN_DATE}' AS run_date, dataset,
         'silver_transform' AS pipeline_stage, total_records, clean_records,
         total_records - clean_records AS quarantine_records,
         {r("clean_records * 100e0 / NULLIF(total_records, 0)", 4)} AS dq_pass_pct,
         TIMESTAMP '{RUN_TS}' AS created_at
  FROM (
    SELECT 'institutions' AS dataset, COUNT(*) AS total_records,
           COUNT(CASE WHEN rejection_reason = '' THEN 1 END) AS clean_records FROM inst_t
    UNION ALL
    SELECT 'financials', COUNT(*), COUNT(CASE WHEN rejection_reason = '' THEN 1 END) FROM fin_t
  ) c
)"""

UNITS = """
units AS (
  SELECT 'institutions_master' AS run_key, CAST(NULL AS INTEGER) AS year,
         CAST(NULL AS INTEGER) AS quarter
  UNION ALL
  SELECT DISTINCT 'financials_' || CAST(year AS VARCHAR) || '_Q' || CAST(quarter AS VARCHAR),
         year, quarter
  FROM fin
)"""

SNAPSHOTS = "\nsnaps AS (\n" + "\n  UNION ALL\n".join(
    f"""  SELECT cert, name, city, stalp, instcat,
         CASE WHEN (cert + {x}) % 5 = 0 THEN 'XX' ELSE charterclass END AS charterclass,
         active, '{d}' AS repdte FROM inst_s"""
    for x, d in ((1, "20231231"), (2, "20240630"), (3, "20241231"))) + "\n)"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = (INST, FIN, INST_TAGGED, FIN_TAGGED, SILVER)

_TREND = f"""
trend AS (
  SELECT year, quarter, COUNT(DISTINCT cert) AS bank_count,
         {r("AVG(rbct1)", 2)} AS avg_tier1_ratio, {r("AVG(npl_ratio_pct)", 3)} AS avg_npl_pct
  FROM health GROUP BY year, quarter
)"""

_PREV = """
p AS (
  SELECT *, CAST(CASE WHEN quarter = 1 THEN year - 1 ELSE year END AS INTEGER) AS py,
            CAST(CASE WHEN quarter = 1 THEN 4 ELSE quarter - 1 END AS INTEGER) AS pq
  FROM {src}
)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["bronze_institutions"] = with_(INST) + "\nSELECT * FROM inst"
    q["bronze_financials"] = with_(FIN) + "\nSELECT * FROM fin"
    q["bronze_lineage"] = with_(INST, FIN) + """
SELECT dataset, _source, _ingested_at, COUNT(*) AS row_count FROM (
  SELECT 'institutions' AS dataset, _source, _ingested_at FROM inst
  UNION ALL SELECT 'financials', _source, _ingested_at FROM fin) t
GROUP BY dataset, _source, _ingested_at"""
    q["bronze_roundtrip"] = q["bronze_institutions"]
    q["bronze_write_counts"] = with_(INST, FIN) + """
SELECT 'institutions' AS dataset, COUNT(*) AS row_count FROM inst
UNION ALL SELECT 'financials', COUNT(*) FROM fin"""
    q["bronze_partitioned_scan"] = with_(FIN) + "\nSELECT * FROM fin WHERE year = 2024 AND quarter = 4"
    q["ingest_work_units"] = with_(FIN, UNITS) + "\nSELECT run_key FROM units"
    q["ingest_pending"] = with_(FIN, UNITS) + """
SELECT run_key FROM units u
WHERE NOT EXISTS (SELECT 1 FROM units d
                  WHERE (d.year < 2023 OR d.year IS NULL) AND d.run_key = u.run_key)"""
    q["ingest_ledger_after_run"] = with_(FIN, UNITS) + f"""
SELECT run_key,
       CASE WHEN year < 2023 OR year IS NULL THEN '{EARLIER_INGESTED_AT}'
            ELSE '{INGESTED_AT}' END AS completed_at
FROM units"""
    q["dq_institutions"] = with_(INST, INST_TAGGED) + "\nSELECT * FROM inst_t"
    q["dq_financials"] = with_(FIN, FIN_TAGGED) + "\nSELECT * FROM fin_t"
    q["silver_institutions"] = with_(*BASE) + "\nSELECT * FROM inst_s"
    q["silver_financials"] = with_(*BASE) + "\nSELECT * FROM fin_s"
    q["quarantine_institutions"] = with_(INST, INST_TAGGED) + \
        f"\nSELECT *, '{RUN_ID}' AS _run_id FROM inst_t WHERE rejection_reason <> ''"
    q["quarantine_financials"] = with_(FIN, FIN_TAGGED) + \
        f"\nSELECT *, '{RUN_ID}' AS _run_id FROM fin_t WHERE rejection_reason <> ''"
    q["partition_overwrite"] = with_(*BASE) + f"""
SELECT cert, repdte, asset, dep, lnlsnet, intinc, eintexp, netinc, rbct1, nperfv,
       _ingested_at, _source,
       CASE WHEN year = 2024 AND quarter = 4 THEN '{RERUN_ID}' ELSE _transformed_at END
         AS _transformed_at,
       year, quarter
FROM fin_s"""
    q["catalog_external_scan"] = with_(*BASE) + """
SELECT year, quarter, COUNT(*) AS row_count, COUNT(DISTINCT cert) AS cert_count
FROM fin_s GROUP BY year, quarter"""
    q["raw_load_replace"] = with_(*BASE) + """
SELECT 'financials_raw' AS table_id, COUNT(*) AS row_count FROM fin_s
UNION ALL SELECT 'institutions_raw', COUNT(*) FROM inst_s"""
    q["raw_load_append"] = with_(*BASE) + """
SELECT 'financials_raw' AS table_id, 2 * COUNT(*) AS row_count FROM fin_s
UNION ALL SELECT 'institutions_raw', 2 * COUNT(*) FROM inst_s"""
    q["derive_period"] = with_(*BASE) + """
SELECT cert, repdte, TRY_CAST(SUBSTR(repdte, 1, 4) AS INTEGER) AS year,
       TRY_CAST(CEIL(TRY_CAST(SUBSTR(repdte, 5, 2) AS DOUBLE) / 3e0) AS INTEGER) AS quarter,
       year AS partition_year, quarter AS partition_quarter
FROM fin_s"""
    q["ratio_npl"] = with_(*BASE) + \
        f"\nSELECT cert, year, quarter, {r('nperfv / NULLIF(asset, 0) * 100e0', 2)} AS npl_ratio_pct FROM fin_s"
    q["ratio_roa"] = with_(*BASE) + \
        f"\nSELECT cert, year, quarter, {r('netinc / NULLIF(asset, 0) * 100e0', 4)} AS roa_pct FROM fin_s"
    q["ratio_deposit"] = with_(*BASE) + \
        f"\nSELECT cert, year, quarter, {r('dep / NULLIF(asset, 0) * 100e0', 2)} AS deposit_to_asset_pct FROM fin_s"
    q["capital_adequacy"] = with_(*BASE) + """
SELECT cert, year, quarter, rbct1,
       CASE WHEN rbct1 >= 10 THEN 'Well Capitalised'
            WHEN rbct1 >= 8 THEN 'Adequately Capitalised'
            WHEN rbct1 >= 6 THEN 'Undercapitalised'
            ELSE 'Critically Undercapitalised' END AS capital_adequacy_flag
FROM fin_s"""
    q["bank_health_metrics"] = with_(*BASE, HEALTH) + "\nSELECT * FROM health"
    q["health_partition_pruned"] = with_(*BASE, HEALTH) + \
        "\nSELECT * FROM health WHERE year = 2024 AND quarter = 4 AND stalp = 'N3'"
    q["dim_institution"] = with_(*BASE, DIM) + "\nSELECT * FROM dim"
    q["dim_current_sample"] = with_(*BASE, DIM) + """
SELECT cert, name, effective_date, expiry_date, is_current FROM dim
WHERE is_current ORDER BY cert LIMIT 5"""
    q["dim_clustered_lookup"] = with_(*BASE, HEALTH, DIM) + """
SELECT cert, name, city, stalp, instcat, charterclass, active FROM dim
WHERE is_current AND cert IN (
  SELECT cert FROM health
  WHERE capital_adequacy_flag = 'Critically Undercapitalised'
    AND year * 10 + quarter = (SELECT MAX(year * 10 + quarter) FROM health))"""
    q["dq_scorecard"] = with_(INST, FIN, INST_TAGGED, FIN_TAGGED, SCORE) + "\nSELECT * FROM score"
    q["dq_scorecard_pipeline"] = with_(INST, FIN, INST_TAGGED, FIN_TAGGED, SCORE) + f"""
SELECT '{RUN_ID}' AS run_id, DATE '{RUN_DATE}' AS run_date, 'full_pipeline' AS dataset,
       'gold_load' AS pipeline_stage, CAST(SUM(total_records) AS BIGINT) AS total_records,
       CAST(SUM(clean_records) AS BIGINT) AS clean_records,
       CAST(SUM(total_records) - SUM(clean_records) AS BIGINT) AS quarantine_records,
       {r("SUM(clean_records) * 100e0 / NULLIF(SUM(total_records), 0)", 4)} AS dq_pass_pct,
       TIMESTAMP '{RUN_TS}' AS created_at
FROM score"""
    q["dq_scorecard_audit"] = with_(INST, FIN, INST_TAGGED, FIN_TAGGED, SCORE) + f"""
SELECT run_id, dataset, total_records, clean_records, dq_pass_pct FROM score
UNION ALL
SELECT '{RUN_ID}', 'full_pipeline', CAST(SUM(total_records) AS BIGINT),
       CAST(SUM(clean_records) AS BIGINT),
       {r("SUM(clean_records) * 100e0 / NULLIF(SUM(total_records), 0)", 4)}
FROM score
ORDER BY dataset, run_id"""
    q["capital_distribution"] = with_(*BASE, HEALTH) + f"""
SELECT capital_adequacy_flag, COUNT(*) AS bank_quarters,
       {r("AVG(rbct1)", 2)} AS avg_t1_ratio, {r("AVG(npl_ratio_pct)", 3)} AS avg_npl_pct
FROM health WHERE year = 2024 GROUP BY capital_adequacy_flag ORDER BY capital_adequacy_flag"""
    q["quarter_trend"] = with_(*BASE, HEALTH, _TREND) + "\nSELECT * FROM trend ORDER BY year, quarter"
    q["quarter_change"] = with_(*BASE, HEALTH, _TREND, _PREV.format(src="trend")) + f"""
SELECT a.year, a.quarter, a.avg_tier1_ratio, b.avg_tier1_ratio AS prev_avg_tier1_ratio,
       {r("a.avg_tier1_ratio - b.avg_tier1_ratio", 2)} AS tier1_change,
       a.avg_npl_pct, b.avg_npl_pct AS prev_avg_npl_pct,
       {r("a.avg_npl_pct - b.avg_npl_pct", 3)} AS npl_change
FROM p a LEFT JOIN trend b ON a.py = b.year AND a.pq = b.quarter
ORDER BY a.year, a.quarter"""
    q["regional_summary"] = with_(*BASE, HEALTH) + f"""
SELECT stalp, COUNT(*) AS bank_count, {r("AVG(rbct1)", 2)} AS avg_t1
FROM health WHERE year = 2024 AND quarter = 4
GROUP BY stalp ORDER BY bank_count DESC, stalp NULLS FIRST"""
    q["table_descriptions"] = with_(*BASE, DIM) + "\n" + "\nUNION ALL ".join(
        f"SELECT 'dim_institution' AS table_id, '{DIM_DESCRIPTION}' AS table_description, "
        f"'{column}' AS column_name, '{text}' AS description, COUNT({column}) AS filled FROM dim"
        for column, text in DIM_COLUMNS.items())
    q["table_inventory"] = with_(*BASE) + """
SELECT * FROM (
  SELECT 'bank_health_metrics' AS table_id, COUNT(*) AS row_count FROM fin_s
  UNION ALL SELECT 'dim_institution', COUNT(*) FROM inst_s
  UNION ALL SELECT 'dq_scorecard', 3
  UNION ALL SELECT 'financials_raw', COUNT(*) FROM fin_s
  UNION ALL SELECT 'institutions_raw', COUNT(*) FROM inst_s) t
ORDER BY table_id"""
    q["table_inventory_sizes"] = f"SELECT *, TRUE AS has_size FROM ({q['table_inventory']}) i"
    q["scd2_history"] = with_(*BASE, SNAPSHOTS) + f"""
,
chg AS (
  SELECT *, LAG(name) OVER w AS p_name, LAG(city) OVER w AS p_city,
         LAG(stalp) OVER w AS p_stalp, LAG(instcat) OVER w AS p_instcat,
         LAG(charterclass) OVER w AS p_charterclass, LAG(active) OVER w AS p_active,
         ROW_NUMBER() OVER w AS rn
  FROM snaps
  WINDOW w AS (PARTITION BY cert ORDER BY repdte)
),
ver AS (
  SELECT * FROM chg
  WHERE rn = 1 OR name IS DISTINCT FROM p_name OR city IS DISTINCT FROM p_city
     OR stalp IS DISTINCT FROM p_stalp OR instcat IS DISTINCT FROM p_instcat
     OR charterclass IS DISTINCT FROM p_charterclass OR active IS DISTINCT FROM p_active
)
SELECT cert, name, city, stalp, instcat, charterclass, active, repdte AS effective_date,
       COALESCE(LEAD(repdte) OVER (PARTITION BY cert ORDER BY repdte), '99991231') AS expiry_date,
       LEAD(repdte) OVER (PARTITION BY cert ORDER BY repdte) IS NULL AS is_current,
       TIMESTAMP '{RUN_TS}' AS row_created_at
FROM ver"""
    q["dq_pass_trend"] = with_(FIN, FIN_TAGGED) + f"""
,
per AS (
  SELECT year, quarter, COUNT(*) AS total_records,
         COUNT(CASE WHEN rejection_reason = '' THEN 1 END) AS clean_records,
         {r("COUNT(CASE WHEN rejection_reason = '' THEN 1 END) * 100e0 / NULLIF(COUNT(*), 0)", 4)}
           AS dq_pass_pct
  FROM fin_t GROUP BY year, quarter
),
{_PREV.format(src="per").strip()}
SELECT a.year, a.quarter, a.total_records, a.clean_records, a.dq_pass_pct,
       b.dq_pass_pct AS prev_dq_pass_pct,
       {r("a.dq_pass_pct - b.dq_pass_pct", 4)} AS pass_pct_change
FROM p a LEFT JOIN per b ON a.py = b.year AND a.pq = b.quarter
ORDER BY a.year, a.quarter"""
    q["stream_silver_financials"] = q["silver_financials"]
    q["ingest_changed_units"] = with_(FIN) + """
SELECT 'financials_' || CAST(year AS VARCHAR) || '_Q' || CAST(quarter AS VARCHAR) AS run_key,
       CAST(2 AS BIGINT) AS landing, COUNT(*) AS row_count
FROM fin WHERE year >= 2023 GROUP BY year, quarter HAVING COUNT(CASE WHEN cert % 50 = 0 THEN 1 END) > 0
UNION ALL SELECT 'financials_2030_Q1', 2, 0"""
    named = "COALESCE(cert % 43, 1) <> 0"
    q["derive_period_moved"] = with_(*BASE) + f"""
SELECT cert, repdte, asset, year, quarter,
       CASE WHEN (year = 2024 AND quarter = 4)
              OR (year = 2024 AND quarter = 3 AND EXISTS (
                    SELECT 1 FROM fin_s WHERE cert % 7 = 0 AND {named} AND year = 2024 AND quarter = 3))
            THEN '{RERUN_ID}' ELSE _transformed_at END AS _transformed_at
FROM fin_s WHERE {named}"""
    lost = """
  SELECT cert, asset,
         CAST(CASE WHEN cert % 7 = 0 AND quarter = 4 THEN year + 1 ELSE year END AS INTEGER) AS year,
         CAST(CASE WHEN cert % 7 <> 0 THEN quarter WHEN quarter = 4 THEN 1 ELSE quarter + 1 END AS INTEGER)
           AS quarter, 'repdte_without_period' AS rejection_reason
  FROM fin WHERE cert % 43 = 0 AND NOT COALESCE(asset <= 0, FALSE) AND NOT COALESCE(dep <= 0, FALSE)
             AND NOT COALESCE(rbct1 < 0 OR rbct1 > 100, FALSE)"""
    q["quarantine_without_period"] = with_(FIN) + f""",
lost AS ({lost})
SELECT *, '{RUN_ID}' AS _run_id FROM lost
UNION ALL SELECT *, '{RERUN_ID}' FROM lost WHERE year = 2024 AND quarter = 4"""
    q["quarantine_of_clean_input"] = q["quarantine_institutions"] + " AND FALSE"
    q["dim_versions"] = q["scd2_history"].replace(
        f"TIMESTAMP '{RUN_TS}' AS row_created_at",
        """CASE repdte WHEN '20231231' THEN TIMESTAMP '2024-01-31 00:00:00'
                   WHEN '20240630' THEN TIMESTAMP '2024-07-31 00:00:00'
                   ELSE TIMESTAMP '2025-01-31 00:00:00' END AS row_created_at""")
    versions = q["scd2_history"].removeprefix("WITH ")
    head, _, last = versions.rpartition("\nSELECT cert, name")
    q["health_as_of"] = f"WITH {head},\n{HEALTH.strip()},\nversions AS (SELECT cert, name{last})" + """
SELECT f.cert, f.repdte, f.year, f.quarter, f.asset, f.dep, f.lnlsnet, f.rbct1, f.npl_ratio_pct, f.roa_pct,
       f.deposit_to_asset_pct, f.capital_adequacy_flag, v.name, v.city, v.stalp, v.instcat, v.charterclass,
       v.active, v.effective_date
FROM health f LEFT JOIN versions v
  ON f.cert = v.cert AND f.repdte >= v.effective_date AND f.repdte < v.expiry_date"""
    rate = "clean_records * 100e0 / NULLIF(total_records, 0)"
    bad = "(year = 2024 AND COALESCE(cert % 5 = 0, FALSE))"
    q["dq_run_trend"] = with_(INST, FIN, INST_TAGGED, FIN_TAGGED) + f""",
f AS (SELECT year, rejection_reason = '' AS ok, rejection_reason = '' AND NOT {bad} AS ok_worse,
             MAX(CASE WHEN {bad} AND asset <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY year, quarter) AS again
      FROM fin_t),
i AS (SELECT rejection_reason = '' AS ok, rejection_reason = '' AND COALESCE(cert % 4 <> 0, TRUE) AS ok_nameless
      FROM inst_t),
states AS (
  SELECT 'financials' AS dataset, 1 AS n, COUNT(*) AS processed_records, COUNT(*) AS total_records,
         COUNT(CASE WHEN ok THEN 1 END) AS clean_records FROM f WHERE year < 2023
  UNION ALL SELECT 'financials', 2, COUNT(CASE WHEN year >= 2023 THEN 1 END), COUNT(*),
         COUNT(CASE WHEN ok THEN 1 END) FROM f
  UNION ALL SELECT 'financials', 3, COUNT(CASE WHEN again = 1 THEN 1 END), COUNT(*),
         COUNT(CASE WHEN ok_worse THEN 1 END) FROM f
  UNION ALL SELECT 'financials', 4, COUNT(*), COUNT(*), COUNT(CASE WHEN ok THEN 1 END) FROM f
  UNION ALL SELECT 'institutions', 1, COUNT(*), COUNT(*), COUNT(CASE WHEN ok THEN 1 END) FROM i
  UNION ALL SELECT 'institutions', 4, COUNT(*), COUNT(*), COUNT(CASE WHEN ok_nameless THEN 1 END) FROM i),
rates AS (
  SELECT *, {r(rate, 4)} AS dq_pass_pct FROM states),
prev AS (SELECT *, LAG(dq_pass_pct) OVER (PARTITION BY dataset ORDER BY n) AS prev_dq_pass_pct FROM rates),
days AS (SELECT unnest([1, 2, 3, 4]) AS n, unnest([DATE '2024-03-31', DATE '2024-06-30', DATE '2024-09-30',
                                                  DATE '2024-12-31']) AS run_date)
SELECT dataset, strftime(run_date, '%Y%m%d_000000') AS run_id, run_date, processed_records, total_records,
       clean_records, dq_pass_pct, prev_dq_pass_pct, {r("dq_pass_pct - prev_dq_pass_pct", 4)} AS pass_pct_change
FROM prev JOIN days USING (n)"""
    q["dq_rule_counts"] = with_(INST, FIN, INST_TAGGED, FIN_TAGGED) + """,
t AS (
  SELECT 'institutions' AS dataset, string_split(rejection_reason, '; ') AS l FROM inst_t WHERE rejection_reason <> ''
  UNION ALL SELECT 'financials', string_split(rejection_reason, '; ') FROM fin_t WHERE rejection_reason <> ''),
p AS (
  SELECT dataset, l[a] AS rule, CASE WHEN b > a THEN l[b] END AS with_rule
  FROM (SELECT dataset, l, a, unnest(range(a, len(l) + 1)) AS b
        FROM (SELECT dataset, l, unnest(range(1, len(l) + 1)) AS a FROM t)))
SELECT dataset, rule, with_rule, COUNT(*) AS failures FROM p GROUP BY dataset, rule, with_rule"""
    q["health_republished"] = with_(*BASE, HEALTH) + f"""
SELECT * REPLACE (CASE WHEN year = 2024 THEN TIMESTAMP '{RERUN_TS}' ELSE _loaded_at END AS _loaded_at)
FROM health"""
    q["health_point_lookup"] = with_(*BASE, HEALTH) + """
SELECT * FROM health WHERE cert IN (SELECT cert FROM inst_s WHERE cert % 59 = 0)"""
    q["banks_by_year"] = with_(*BASE, HEALTH) + """
SELECT year, COUNT(DISTINCT cert) AS bank_count FROM health GROUP BY year"""
    for name in ("quarter_trend", "capital_distribution", "regional_summary"):
        q[f"partials_{name}"] = q[name]
    return q
