"""Known data issues of the raw tables, counted from the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import enrich
from ..operators.quality import Issue, count_issues, issue_registry
from . import fixed_values as fixed
from .raw import SALES_COLUMNS

_MARITAL = ", ".join(f"'{v}'" for v in fixed.MARITAL_VALUES)
_EDUCATION = ", ".join(f"'{v}'" for v in fixed.EDUCATION_VALUES)
_CODES = ", ".join(f"'{v}'" for v in fixed.REGION_CODES)
_BLANK = " AND ".join(f"{c} IS NULL" for c in SALES_COLUMNS)

# Ids, names, types and severities of the registry.
ISSUES = [
    Issue("DQ-001", "customers", "CustomerID", "valid_customer_id", "schema_variation",
          "critical", "The customer id has three column names across the files",
          "Take the first id column that holds a value",
          affected="coalesce(CustomerID, Customer_ID, cust_id) IS NOT NULL"),
    Issue("DQ-002", "customers", "Region", "valid_region", "schema_variation", "high",
          "Regions are given as one-letter codes", "Map the codes to region names",
          affected=f"Region IN ({_CODES})"),
    Issue("DQ-003", "customers", "Region", "valid_region", "schema_variation", "high",
          "The region column is named Reg", "Read Reg where Region is missing",
          affected="Reg IS NOT NULL"),
    Issue("DQ-004", "customers", "Education", "valid_education", "column_swap", "critical",
          "Education and marital status are swapped",
          "Recognise the swap by the values and swap back",
          affected=f"Education IN ({_MARITAL}) OR Marital_status IN ({_EDUCATION})"),
    Issue("DQ-005", "customers", "Education", "valid_education", "data_corruption", "medium",
          "Education holds the truncated value terto", "Replace it by tertiary",
          affected="Education = 'terto'"),
    Issue("DQ-006", "customers", "Marital_status", "valid_marital", "missing_column", "high",
          "A source has no marital column under any name", "Accept NULL as marital status",
          absent_in_source=("Marital", "Marital_status")),
    Issue("DQ-007", "customers", "HHInsurance", "missing_column", "missing_column", "medium",
          "A source has no household insurance column", "Keep NULL and tell the source owner",
          absent_in_source=("HHInsurance",)),
    Issue("DQ-008", "claims", "incident_date", "valid_date_format", "data_corruption",
          "critical", "Incident dates are minute fragments, not dates",
          "Keep the text for audit; no date can be recovered",
          affected=f"try_to_timestamp(incident_date, '{fixed.MINUTE_FORMAT}') IS NULL"),
    Issue("DQ-009", "claims", "Claim_Processed_On", "null_string_check", "data_corruption",
          "high", "Unprocessed claims carry the text NULL", "Turn the text into a real NULL",
          affected="Claim_Processed_On = 'NULL'"),
    Issue("DQ-010", "claims", "property_damage", "unknown_value_check", "unknown_values",
          "medium", "A question mark stands for an unknown answer", "Turn it into NULL",
          affected="property_damage = '?'"),
    Issue("DQ-011", "claims", "vehicle", "type_cast_check", "type_mismatch", "medium",
          "The text NULL in an amount column prevents the cast",
          "Turn it into NULL before the cast", affected="vehicle = 'NULL'"),
    Issue("DQ-012", "sales", "sales_id", "blank_row_check", "blank_rows", "critical",
          "Rows without any value, left by the export", "Drop them, do not quarantine",
          affected=_BLANK),
    Issue("DQ-013", "policy", "umbrella_limit", "valid_umbrella_limit", "invalid_value", "high",
          "The umbrella limit is negative", "Quarantine the policy",
          affected="try_cast(umbrella_limit AS int) < 0"),
    Issue("DQ-014", "customers", "customer_id", "duplicate_check", "duplicate_records",
          "critical", "Customers are in regional files and in the master file",
          "Keep one row per customer, the master file first", repeated_key="customer_id"),
]


def registry(raw: dict[str, DataFrame]) -> DataFrame:
    """All issues with affected rows, total rows and ratio."""
    parts = []
    for table in ("customers", "claims", "sales", "policy"):
        df = raw[table]
        if table == "customers":
            df = df.withColumn("customer_id",
                               F.coalesce("CustomerID", "Customer_ID", "cust_id"))
        issues = [i for i in ISSUES if i.table == table]
        per_source = any(i.absent_in_source for i in issues)
        parts.append(count_issues(df, issues, fixed.SOURCE_FILE if per_source else None))
    return issue_registry(reduce(DataFrame.unionByName, parts), ISSUES)


EXPLANATION_PROMPT = (
    "Explain data issue {issue_id} to a compliance officer. Table {table}, column {column}, "
    "rule {rule}, type {kind}, severity {severity}: {affected} of {total} rows ({percent}%). "
    "Finding: {description}. Fix: {fix}. Cover the finding, its business impact, the root "
    "cause, the remediation applied and how to prevent it, each in a section of its own: Finding, "
    "Business Impact, Root Cause, Remediation, Prevention."
)


def explanation_prompt() -> Column:
    return text.template(
        EXPLANATION_PROMPT, issue_id=F.col("issue_id"), table=F.col("table_name"),
        column=F.col("column_name"), rule=F.col("rule_name"), kind=F.col("issue_type"),
        severity=F.col("severity"), affected=F.col("affected_records"),
        total=F.col("total_records"),
        percent=F.format_number(F.col("affected_ratio") * 100, 1),
        description=F.col("description"), fix=F.col("suggested_fix"))


def explanation_report(issues: DataFrame, fn: enrich.Generator | None, model_name: str) -> DataFrame:
    """The registry with a generated explanation per issue instead of description and fix."""
    prepared = issues.withColumn("_prompt", explanation_prompt()).drop(
        "description", "suggested_fix", "detected_at")
    return enrich.generate(prepared, "_prompt", fn, model_name, output="ai_explanation",
                           error_prefix=fixed.ERROR_PREFIX)
