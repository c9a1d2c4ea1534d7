"""One declared schema per dataset, used for reads, writes, catalog
registration and contract tests. Column comments travel in the field metadata
(``comment``), which Spark carries into catalog tables.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, metadata={"comment": comment})


LINEAGE_FIELDS = [
    _f("_ingested_at", T.StringType(), "ISO-8601 UTC time the row was landed"),
    _f("_source", T.StringType(), "Producer of the landed row"),
]

# Partition keys of the financials datasets.
PERIOD_FIELDS = [
    _f("year", T.IntegerType(), "Report year (partition key)"),
    _f("quarter", T.IntegerType(), "Report quarter 1-4 (partition key)"),
]

INSTITUTIONS_BUSINESS = [
    _f("cert", T.LongType(), "Institution certificate number (key)"),
    _f("name", T.StringType(), "Institution name"),
    _f("city", T.StringType(), "City of the head office"),
    _f("stname", T.StringType(), "State name"),
    _f("stalp", T.StringType(), "State code"),
    _f("asset", T.LongType(), "Total assets"),
    _f("repdte", T.StringType(), "Report date YYYYMMDD"),
    _f("active", T.LongType(), "1 = active, 0 = inactive"),
    _f("instcat", T.LongType(), "Institution category 1-4"),
    _f("charterclass", T.StringType(), "Charter class code"),
]

FINANCIALS_BUSINESS = [
    _f("cert", T.LongType(), "Institution certificate number"),
    _f("repdte", T.StringType(), "Quarter-end report date YYYYMMDD"),
    _f("asset", T.LongType(), "Total assets"),
    _f("dep", T.LongType(), "Total deposits"),
    _f("lnlsnet", T.LongType(), "Net loans and leases"),
    _f("intinc", T.LongType(), "Interest income"),
    _f("eintexp", T.LongType(), "Interest expense"),
    _f("netinc", T.LongType(), "Net income"),
    _f("rbct1", T.DoubleType(), "Tier-1 risk-based capital ratio, percent"),
    _f("nperfv", T.LongType(), "Non-performing loans"),
]

BRONZE_INSTITUTIONS = T.StructType(INSTITUTIONS_BUSINESS + LINEAGE_FIELDS)
# Partition columns last: that is where partition discovery puts them.
BRONZE_FINANCIALS = T.StructType(FINANCIALS_BUSINESS + LINEAGE_FIELDS + PERIOD_FIELDS)

TRANSFORMED_AT = _f("_transformed_at", T.StringType(), "Run id of the silver transform")
REJECTION_REASON = _f("rejection_reason", T.StringType(), "Failed rule names, '; '-separated")
RUN_ID_FIELD = _f("_run_id", T.StringType(), "Run id that quarantined the row (partition key)")

SILVER_INSTITUTIONS = T.StructType(INSTITUTIONS_BUSINESS + LINEAGE_FIELDS + [TRANSFORMED_AT])
SILVER_FINANCIALS = T.StructType(
    FINANCIALS_BUSINESS + LINEAGE_FIELDS + [TRANSFORMED_AT] + PERIOD_FIELDS)

QUARANTINE_INSTITUTIONS = T.StructType(
    INSTITUTIONS_BUSINESS + LINEAGE_FIELDS + [REJECTION_REASON, RUN_ID_FIELD])
QUARANTINE_FINANCIALS = T.StructType(
    FINANCIALS_BUSINESS + LINEAGE_FIELDS + PERIOD_FIELDS + [REJECTION_REASON, RUN_ID_FIELD])

BANK_HEALTH_METRICS = T.StructType([
    _f("cert", T.LongType(), "Institution certificate number"),
    _f("name", T.StringType(), "Institution name (NULL when unmatched)"),
    _f("city", T.StringType(), "City"),
    _f("stalp", T.StringType(), "State code (clustering key)"),
    _f("repdte", T.StringType(), "Report date YYYYMMDD"),
    _f("quarter", T.IntegerType(), "Report quarter"),
    _f("asset", T.LongType(), "Total assets"),
    _f("dep", T.LongType(), "Total deposits"),
    _f("lnlsnet", T.LongType(), "Net loans and leases"),
    _f("rbct1", T.DoubleType(), "Tier-1 capital ratio, percent"),
    _f("npl_ratio_pct", T.DoubleType(), "Non-performing loans / assets, percent, 2 dp"),
    _f("roa_pct", T.DoubleType(), "Net income / assets, percent, 4 dp"),
    _f("deposit_to_asset_pct", T.DoubleType(), "Deposits / assets, percent, 2 dp"),
    _f("capital_adequacy_flag", T.StringType(), "Capital class on rbct1"),
    _f("_loaded_at", T.TimestampNTZType(), "Run time of the gold load (UTC)"),
    _f("year", T.IntegerType(), "Report year (partition key)"),
])

DIM_INSTITUTION = T.StructType([
    _f("cert", T.LongType(), "Institution certificate number"),
    _f("name", T.StringType(), "Institution name"),
    _f("city", T.StringType(), "City"),
    _f("stalp", T.StringType(), "State code"),
    _f("instcat", T.LongType(), "Institution category"),
    _f("charterclass", T.StringType(), "Charter class"),
    _f("active", T.LongType(), "Active flag"),
    _f("effective_date", T.StringType(), "First report date of this version YYYYMMDD"),
    _f("expiry_date", T.StringType(), "Report date of the next version, 99991231 if current"),
    _f("is_current", T.BooleanType(), "True for the open version"),
    _f("row_created_at", T.TimestampNTZType(), "Run time that built the row (UTC)"),
])

DQ_SCORECARD = T.StructType([
    _f("run_id", T.StringType(), "Pipeline run id YYYYMMDD_HHMMSS"),
    _f("dataset", T.StringType(), "institutions, financials or full_pipeline"),
    _f("pipeline_stage", T.StringType(), "silver_transform or gold_load"),
    _f("total_records", T.LongType(), "Rows processed"),
    _f("clean_records", T.LongType(), "Rows passing every rule"),
    _f("quarantine_records", T.LongType(), "Rows failing at least one rule"),
    _f("dq_pass_pct", T.DoubleType(), "clean / total, percent, 4 dp"),
    _f("created_at", T.TimestampNTZType(), "Row creation time (UTC)"),
    _f("run_date", T.DateType(), "Date of the run (partition key)"),
])

LEDGER = T.StructType([
    _f("run_key", T.StringType(), "Unit of ingest work"),
    _f("completed_at", T.StringType(), "ISO-8601 UTC time the unit committed"),
    _f("landing", T.LongType(), "How many times the unit has been landed"),
    _f("n_rows", T.LongType(), "Source rows of the unit"),
    _f("hash_sum", T.DecimalType(38, 0), "Sum of the source rows' hashes"),
    _f("hash_xor", T.LongType(), "Exclusive or of the source rows' hashes"),
])

# Filed period -> period named by the report date, where the two differ.
SILVER_ROUTES = T.StructType([
    _f("year", T.IntegerType(), "Year the rows are filed under"),
    _f("quarter", T.IntegerType(), "Quarter the rows are filed under"),
    _f("to_year", T.IntegerType(), "Year their report date names"),
    _f("to_quarter", T.IntegerType(), "Quarter their report date names"),
])

DQ_UNIT_COUNTS = T.StructType([
    _f("dataset", T.StringType(), "institutions or financials"),
    _f("run_date", T.DateType(), "Date of the run"),
    _f("created_at", T.TimestampNTZType(), "Run time (UTC)"),
    _f("rule_mask", T.LongType(), "Failed rules, one bit each; 0 = clean"),
    _f("n_rows", T.LongType(), "Rows of the unit with this mask"),
    _f("run_id", T.StringType(), "Run that validated the unit (partition key)"),
    _f("run_key", T.StringType(), "Unit of ingest work (partition key)"),
])

HEALTH_PARTIALS = T.StructType([
    _f("stalp", T.StringType(), "State code"),
    _f("capital_adequacy_flag", T.StringType(), "Capital class"),
    _f("n", T.LongType(), "Rows"),
    _f("n_rbct1", T.LongType(), "Rows with a Tier-1 ratio"),
    _f("sum_rbct1", T.DoubleType(), "Sum of the Tier-1 ratios"),
    _f("n_npl", T.LongType(), "Rows with a non-performing-loan ratio"),
    _f("sum_npl", T.DoubleType(), "Sum of the non-performing-loan ratios"),
    *PERIOD_FIELDS,
])

BANK_SETS = T.StructType([
    _f("bucket", T.LongType(), "Stretch of 32,768 certificate numbers"),
    _f("bits", T.BinaryType(), "Bitmap of the numbers present"),
    *PERIOD_FIELDS,
])

TABLE_COMMENTS = {
    "bank_health_metrics": "Bank financial health metrics with capital adequacy classification",
    "dim_institution": "Institution dimension with effective / expiry dated versions",
    "dq_scorecard": "Data-quality audit trail: pass rates per pipeline run",
}


def ddl(schema: T.StructType, exclude: tuple[str, ...] = ()) -> str:
    """``name TYPE COMMENT '...'`` list for CREATE TABLE statements."""
    cols = []
    for f in schema.fields:
        if f.name in exclude:
            continue
        comment = f.metadata.get("comment", "").replace("'", "\\'")
        cols.append(f"`{f.name}` {f.dataType.simpleString().upper()} COMMENT '{comment}'")
    return ",\n  ".join(cols)
