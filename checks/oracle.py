"""Independent SQL (DuckDB dialect) for every checkable query.

Written against the driver tables only. `CTES` are shared building blocks, `FINAL` the last
SELECT of each query; a query's text is its SELECT behind the blocks it needs.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2002-01-01'"

# Money is summed exactly, as decimals: sums of doubles depend on the order of addition.
# Rounding is half-up on the printed decimal value everywhere, hence the casts around round().

CTES: dict[str, str] = {}

# ------------------------------------------------------------------------------------- raw
CTES["base"] = """
SELECT c_custkey AS k, n_name AS st, c_mktsegment AS job,
  CASE WHEN c_custkey % 97 = 5 THEN 'Nowhere' WHEN c_custkey % 101 = 7 THEN NULL
       WHEN n_regionkey = 0 THEN 'East' WHEN n_regionkey = 1 THEN 'West'
       WHEN n_regionkey = 2 THEN 'Central' WHEN n_regionkey = 3 THEN 'South' ELSE 'North' END AS region,
  CASE WHEN c_custkey % 89 = 3 THEN 'widowed' WHEN c_custkey % 4 = 0 THEN 'single'
       WHEN c_custkey % 4 = 1 THEN 'married' WHEN c_custkey % 4 = 2 THEN 'divorced' END AS marital,
  CASE WHEN c_custkey % 5 = 0 THEN 'primary' WHEN c_custkey % 5 = 1 THEN 'secondary'
       WHEN c_custkey % 5 = 2 THEN 'tertiary' WHEN c_custkey % 5 = 3 THEN 'NA' END AS education,
  CAST(CAST(floor(c_acctbal) AS INT) AS VARCHAR) AS balance,
  CASE WHEN c_custkey % 10 = 0 THEN '1' ELSE '0' END AS dflt,
  CAST(c_custkey % 2 AS VARCHAR) AS hh,
  CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE '0' END AS loan
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

CTES["customers_raw"] = """
SELECT 'customers_1' AS src, k AS CustomerID, CAST(NULL AS BIGINT) AS Customer_ID,
  CAST(NULL AS BIGINT) AS cust_id, CAST(NULL AS VARCHAR) AS Region, region AS Reg, st AS State,
  st AS City, CAST(NULL AS VARCHAR) AS City_in_state, CAST(NULL AS VARCHAR) AS Job,
  CAST(NULL AS VARCHAR) AS Marital, marital AS Marital_status, education AS Education,
  CAST(NULL AS VARCHAR) AS Edu, dflt AS Defaulted, balance AS Balance, hh AS HHInsurance,
  loan AS CarLoan
FROM base WHERE k % 7 = 0
UNION ALL SELECT 'customers_2', NULL, k, NULL, region, NULL, st, NULL, st, job, NULL, NULL, NULL,
  education, dflt, balance, NULL, loan FROM base WHERE k % 7 = 1
UNION ALL SELECT 'customers_3', NULL, NULL, k, region, NULL, st, st, NULL, job, marital, NULL,
  education, NULL, dflt, balance, hh, loan FROM base WHERE k % 7 = 2
UNION ALL SELECT 'customers_4', k, NULL, NULL, region, NULL, st, st, NULL, job, marital, NULL,
  NULL, NULL, dflt, balance, hh, loan FROM base WHERE k % 7 = 3
UNION ALL SELECT 'customers_5', k, NULL, NULL,
  CASE region WHEN 'East' THEN 'E' WHEN 'West' THEN 'W' WHEN 'Central' THEN 'C'
              WHEN 'South' THEN 'S' ELSE region END,
  NULL, st, st, NULL, job, marital, NULL,
  CASE WHEN education = 'tertiary' THEN 'terto' ELSE education END, NULL, dflt, balance, hh, loan
  FROM base WHERE k % 7 = 4
UNION ALL SELECT 'customers_6', k, NULL, NULL, region, NULL, st, st, NULL, job, NULL, education,
  marital, NULL, dflt, balance, hh, loan FROM base WHERE k % 7 = 5
UNION ALL SELECT 'customers_7', k, NULL, NULL, region, NULL, st, st, NULL, job, marital, NULL,
  education, NULL, dflt, balance, hh, loan FROM base WHERE k % 7 <> 4"""

CTES["policy_raw"] = """
SELECT CASE WHEN o_orderkey % 211 = 9 THEN NULL ELSE o_orderkey END AS policy_number,
  strftime(o_orderdate, '%Y-%m-%d') AS policy_bind_date,
  'STATE_' || (o_custkey % 9) AS policy_state,
  CASE WHEN o_orderkey % 4 = 0 THEN '100/300' WHEN o_orderkey % 4 = 1 THEN '250/500'
       WHEN o_orderkey % 4 = 2 THEN '500/1000' ELSE '300/300' END AS policy_csl,
  CASE WHEN o_orderkey % 3 = 0 THEN '500' WHEN o_orderkey % 3 = 1 THEN '1000' ELSE '2000' END
    AS policy_deductable,
  CASE WHEN o_orderkey % 307 = 11 THEN '0' ELSE CAST(o_totalprice / 100 AS VARCHAR) END
    AS policy_annual_premium,
  CASE WHEN o_orderkey % 401 = 13 THEN '-1000000' WHEN o_orderkey % 5 = 0 THEN '5000000'
       WHEN o_orderkey % 499 = 21 THEN NULL ELSE '0' END AS umbrella_limit,
  CASE WHEN o_orderkey % 503 = 17 THEN NULL WHEN o_orderkey % 509 = 23 THEN 100000000
       ELSE o_orderkey % 200 END AS car_id,
  o_custkey AS customer_id, 'policy' AS src
FROM orders"""

CTES["claims_raw"] = """
SELECT l_orderkey * 10 + l_linenumber AS ClaimID,
  CASE WHEN l_partkey % 101 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS PolicyID,
  'STATE_' || (l_suppkey % 9) AS incident_state, 'CITY_' || (l_suppkey % 25) AS incident_city,
  l_partkey || ' Main St' AS incident_location,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Single Vehicle Collision'
       ELSE 'Multi-vehicle Collision' END AS incident_type,
  CASE l_suppkey % 4 WHEN 0 THEN 'Rear Collision' WHEN 1 THEN 'Side Collision'
       WHEN 2 THEN 'Front Collision' ELSE '?' END AS collision_type,
  CASE WHEN l_returnflag = 'A' THEN 'Minor Damage' WHEN l_returnflag = 'N' THEN 'Major Damage'
       ELSE 'Trivial Damage' END AS incident_severity,
  CASE WHEN l_quantity < 10 THEN 'Police' WHEN l_quantity < 20 THEN 'Fire'
       WHEN l_quantity < 30 THEN 'Ambulance' WHEN l_quantity < 40 THEN 'Other' ELSE 'None' END
    AS authorities_contacted,
  CASE WHEN l_partkey % 89 = 2 THEN 'NULL' ELSE CAST(l_extendedprice AS VARCHAR) END AS injury,
  CASE WHEN l_partkey % 83 = 4 THEN ''
       ELSE CAST(CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS VARCHAR) END AS property,
  CASE WHEN l_partkey % 29 = 0 THEN 'NULL'
       ELSE CAST(CAST(floor(l_extendedprice * l_tax) AS BIGINT) AS VARCHAR) END AS vehicle,
  CAST(1 + l_linenumber % 4 AS VARCHAR) AS number_of_vehicles_involved,
  CASE WHEN l_partkey % 3 = 0 THEN 'YES' WHEN l_partkey % 3 = 1 THEN 'NO' ELSE '?' END
    AS property_damage,
  CASE WHEN l_orderkey % 3 = 0 THEN 'YES' WHEN l_orderkey % 3 = 1 THEN 'NO' ELSE '?' END
    AS police_report_available,
  CAST(l_linenumber % 3 AS VARCHAR) AS bodily_injuries,
  CAST(l_suppkey % 4 AS VARCHAR) AS witnesses,
  CASE WHEN l_partkey % 61 = 1 THEN '?' WHEN l_partkey % 67 = 1 THEN NULL
       WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS Claim_Rejected,
  CASE WHEN l_linestatus = 'O' THEN 'NULL' ELSE (l_suppkey % 60) || ':30.0' END
    AS Claim_Processed_On,
  (l_orderkey % 60) || ':00.0' AS incident_date,
  CASE WHEN l_partkey % 97 = 9 THEN NULL ELSE (l_partkey % 60) || ':00.0' END
    AS Claim_Logged_On,
  'claims_' || (1 + l_orderkey % 2) AS src
FROM lineitem"""

CTES["sales_raw"] = """
SELECT CASE WHEN blank = 1 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS sales_id,
  CASE WHEN blank = 1 THEN NULL WHEN o_orderkey % 71 = 5 THEN '27:00.0'
       ELSE strftime(o_orderdate, '%d-%m-%Y %H:%M') END AS ad_placed_on,
  CASE WHEN blank = 1 OR o_orderstatus = 'O' THEN NULL
       ELSE strftime(o_orderdate + INTERVAL 10 DAY, '%d-%m-%Y %H:%M') END AS sold_on,
  CASE WHEN blank = 1 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END
    AS original_selling_price,
  CASE WHEN blank = 1 THEN NULL ELSE o_orderpriority END AS Region,
  CASE WHEN blank = 1 THEN NULL ELSE 'STATE_' || (o_custkey % 9) END AS State,
  CASE WHEN blank = 1 THEN NULL ELSE 'CITY_' || (o_custkey % 25) END AS City,
  CASE WHEN blank = 1 THEN NULL WHEN o_custkey % 2 = 0 THEN 'Dealer' ELSE 'Individual' END
    AS seller_type,
  CASE WHEN blank = 1 OR o_orderkey % 73 = 4 THEN NULL WHEN o_custkey % 3 = 0 THEN 'First Owner'
       ELSE 'Second Owner' END AS owner,
  CASE WHEN blank = 1 OR o_orderkey % 67 = 3 THEN NULL WHEN o_orderkey % 509 = 23 THEN 100000000
       ELSE o_orderkey % 200 END AS car_id, src
FROM (SELECT orders.*, CASE WHEN o_orderkey % 3 = 0 THEN 'sales_1' WHEN o_orderkey % 3 = 1
        THEN 'sales_2' ELSE 'sales_4' END AS src,
        CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END AS blank FROM orders
      UNION ALL
      SELECT orders.*, 'sales_4' AS src, 0 AS blank FROM orders WHERE o_orderkey % 59 = 0) t"""

CTES["cars_raw"] = """
SELECT p_partkey AS car_id, p_name AS name, CAST(1000 + p_partkey * 7 % 90000 AS VARCHAR) AS km_driven,
  p_type AS fuel, CASE WHEN p_partkey % 2 = 0 THEN 'Manual' ELSE 'Automatic' END AS transmission,
  CASE WHEN p_partkey % 73 = 0 THEN 'n/a' ELSE p_size || '.5 kmpl' END AS mileage,
  (p_size * 20 + 800) || ' CC' AS engine, (p_size + 60) || ' bhp' AS max_power,
  (p_size + 100) || 'Nm@ 2000rpm' AS torque,
  CASE WHEN p_partkey % 83 = 5 THEN '0' WHEN p_partkey % 79 = 6 THEN NULL
       ELSE CAST(4 + p_partkey % 4 AS VARCHAR) END AS seats,
  p_brand AS model, 'cars' AS src
FROM part"""

# ----------------------------------------------------------------------------------- typed
CTES["customers_typed"] = """
SELECT COALESCE(CustomerID, Customer_ID, cust_id) AS customer_id,
  CASE COALESCE(Region, Reg) WHEN 'E' THEN 'East' WHEN 'W' THEN 'West' WHEN 'C' THEN 'Central'
       WHEN 'S' THEN 'South' ELSE COALESCE(Region, Reg) END AS region,
  State AS state, COALESCE(City, City_in_state) AS city, Job AS job,
  CASE WHEN Education IN ('single','married','divorced') THEN Education
       ELSE COALESCE(Marital, Marital_status) END AS marital,
  CASE WHEN Marital_status IN ('primary','secondary','tertiary','NA') THEN Marital_status
       WHEN COALESCE(Education, Edu) = 'terto' THEN 'tertiary'
       ELSE COALESCE(Education, Edu) END AS education,
  TRY_CAST(Defaulted AS INT) AS default_flag, TRY_CAST(Balance AS INT) AS balance,
  TRY_CAST(HHInsurance AS INT) AS hh_insurance, TRY_CAST(CarLoan AS INT) AS car_loan,
  src AS _source_file
FROM customers_raw"""

CTES["customers_one"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY CASE WHEN contains(_source_file, 'customers_7') THEN 0 ELSE 1 END, _source_file) AS rn
  FROM customers_typed WHERE customer_id IS NOT NULL)
WHERE rn = 1
UNION ALL SELECT * FROM customers_typed WHERE customer_id IS NULL"""

CTES["claims_typed"] = """
SELECT ClaimID AS claim_id, PolicyID AS policy_id, incident_state, incident_city,
  incident_location, incident_type, collision_type, incident_severity, authorities_contacted,
  TRY_CAST(CASE WHEN injury NOT IN ('NULL','') THEN injury END AS DOUBLE) AS injury_amount,
  TRY_CAST(CASE WHEN property NOT IN ('NULL','') THEN property END AS DOUBLE) AS property_amount,
  TRY_CAST(CASE WHEN vehicle NOT IN ('NULL','') THEN vehicle END AS DOUBLE) AS vehicle_amount,
  TRY_CAST(number_of_vehicles_involved AS INT) AS number_of_vehicles_involved,
  NULLIF(property_damage, '?') AS property_damage,
  NULLIF(police_report_available, '?') AS police_report_available,
  TRY_CAST(bodily_injuries AS INT) AS bodily_injuries, TRY_CAST(witnesses AS INT) AS witnesses,
  Claim_Rejected AS claim_rejected,
  CASE WHEN Claim_Processed_On NOT IN ('NULL','') THEN Claim_Processed_On END
    AS claim_processed_on_raw,
  incident_date AS incident_date_raw, Claim_Logged_On AS claim_logged_on_raw,
  src AS _source_file
FROM claims_raw"""

CTES["policy_typed"] = """
SELECT policy_number, CAST(try_strptime(policy_bind_date, '%Y-%m-%d') AS DATE) AS policy_bind_date,
  policy_state, policy_csl, TRY_CAST(policy_deductable AS INT) AS policy_deductable,
  TRY_CAST(policy_annual_premium AS DOUBLE) AS policy_annual_premium,
  TRY_CAST(umbrella_limit AS INT) AS umbrella_limit, car_id, customer_id, src AS _source_file
FROM policy_raw"""

CTES["sales_typed"] = f"""
SELECT sales_id, ad_placed_on, sold_on, original_selling_price, region, state, city, seller_type,
  owner, car_id,
  CAST(CASE WHEN sold_on IS NULL THEN date_diff('day', CAST(ad_placed_on AS DATE), {AS_OF}) END
    AS INT) AS days_unsold, src AS _source_file
FROM (
  SELECT TRY_CAST(sales_id AS BIGINT) AS sales_id,
    try_strptime(ad_placed_on, '%d-%m-%Y %H:%M') AS ad_placed_on,
    try_strptime(sold_on, '%d-%m-%Y %H:%M') AS sold_on,
    TRY_CAST(original_selling_price AS DOUBLE) AS original_selling_price,
    Region AS region, State AS state, City AS city, seller_type, owner, car_id, src
  FROM sales_raw
  WHERE NOT (sales_id IS NULL AND ad_placed_on IS NULL AND sold_on IS NULL
    AND original_selling_price IS NULL AND Region IS NULL AND State IS NULL AND City IS NULL
    AND seller_type IS NULL AND owner IS NULL AND car_id IS NULL)) t"""

CTES["cars_typed"] = r"""
SELECT car_id, name, TRY_CAST(km_driven AS INT) AS km_driven, fuel, transmission,
  TRY_CAST(regexp_extract(mileage, '([\d.]+)', 1) AS DOUBLE) AS mileage_kmpl,
  TRY_CAST(regexp_extract(engine, '([\d.]+)', 1) AS DOUBLE) AS engine_cc,
  TRY_CAST(regexp_extract(max_power, '([\d.]+)', 1) AS DOUBLE) AS max_power_bhp,
  torque AS torque_raw, TRY_CAST(seats AS INT) AS seats, model, src AS _source_file
FROM cars_raw"""

# ------------------------------------------------------------------ reasons, clean, failed
CTES["customers_flagged"] = """
SELECT *, concat_ws(', ',
  CASE WHEN customer_id IS NULL THEN 'null customer_id' END,
  CASE WHEN region IS NULL THEN 'null region'
       WHEN region NOT IN ('East','West','Central','South','North')
       THEN 'invalid region: ' || region END,
  CASE WHEN marital NOT IN ('single','married','divorced') THEN 'invalid marital' END,
  CASE WHEN education NOT IN ('primary','secondary','tertiary','NA') THEN 'invalid education' END
) AS _rejection_reason FROM customers_one"""
CTES["claims_flagged"] = """
SELECT *, concat_ws(', ',
  CASE WHEN claim_id IS NULL THEN 'null claim_id' END,
  CASE WHEN policy_id IS NULL THEN 'null policy_id' END,
  CASE WHEN claim_rejected IS NULL THEN 'null claim_rejected'
       WHEN claim_rejected NOT IN ('Y','N') THEN 'invalid claim_rejected' END,
  CASE WHEN injury_amount IS NULL THEN 'injury not castable to float' END,
  CASE WHEN property_amount IS NULL THEN 'property not castable to float' END
) AS _rejection_reason FROM claims_typed"""
CTES["policy_flagged"] = """
SELECT *, concat_ws(', ',
  CASE WHEN policy_number IS NULL THEN 'null policy_number' END,
  CASE WHEN customer_id IS NULL THEN 'null customer_id' END,
  CASE WHEN car_id IS NULL THEN 'null car_id' END,
  CASE WHEN policy_annual_premium IS NULL THEN 'null policy_annual_premium'
       WHEN policy_annual_premium <= 0 THEN 'invalid premium' END,
  CASE WHEN umbrella_limit IS NULL THEN 'null umbrella_limit'
       WHEN umbrella_limit < 0 THEN 'negative umbrella_limit' END
) AS _rejection_reason FROM policy_typed"""
CTES["sales_flagged"] = """
SELECT *, concat_ws(', ',
  CASE WHEN sales_id IS NULL THEN 'null sales_id' END,
  CASE WHEN ad_placed_on IS NULL THEN 'null ad_placed_on' END,
  CASE WHEN car_id IS NULL THEN 'null car_id' END
) AS _rejection_reason FROM sales_typed"""
CTES["cars_flagged"] = """
SELECT *, concat_ws(', ',
  CASE WHEN car_id IS NULL THEN 'null car_id' END,
  CASE WHEN seats IS NULL THEN 'null seats' WHEN seats <= 0 THEN 'invalid seats' END
) AS _rejection_reason FROM cars_typed"""
for _t in ("customers", "claims", "policy", "sales", "cars"):
    CTES[f"{_t}_clean"] = (f"SELECT * EXCLUDE (_rejection_reason) FROM {_t}_flagged "
                           "WHERE _rejection_reason = ''")
    CTES[f"{_t}_failed"] = f"SELECT * FROM {_t}_flagged WHERE _rejection_reason <> ''"

# ------------------------------------------------------------------------------------ gold
_TIER = ("CASE policy_csl WHEN '100/300' THEN 'Low' WHEN '250/500' THEN 'Medium' "
         "WHEN '500/1000' THEN 'High' ELSE 'Unknown' END")
CTES["dim_policy"] = f"""
SELECT policy_number, policy_bind_date, policy_state, policy_csl, {_TIER} AS policy_csl_tier,
  policy_deductable, policy_annual_premium, umbrella_limit, car_id, customer_id, _source_file
FROM policy_clean"""
CTES["dim_customer"] = """
SELECT customer_id, region, state, city, job, marital, education, default_flag, balance,
  hh_insurance, car_loan, _source_file FROM customers_clean"""
CTES["dim_car"] = """
SELECT car_id, name, model, fuel, transmission, km_driven, mileage_kmpl, engine_cc,
  max_power_bhp, torque_raw, seats, _source_file FROM cars_clean"""
CTES["fact_claims"] = """
SELECT c.claim_id, c.policy_id, p.customer_id, p.policy_csl, p.policy_csl_tier,
  p.policy_deductable, p.policy_annual_premium, h.region, h.state,
  c.incident_severity, c.incident_type, c.collision_type, c.incident_state, c.incident_city,
  c.authorities_contacted, c.property_damage, c.police_report_available, c.claim_rejected,
  CASE WHEN c.claim_rejected = 'Y' THEN 1 ELSE 0 END AS is_rejected,
  c.injury_amount, c.property_amount, c.vehicle_amount,
  COALESCE(c.injury_amount, 0.0::DOUBLE) + COALESCE(c.property_amount, 0.0::DOUBLE)
    + COALESCE(c.vehicle_amount, 0.0::DOUBLE) AS total_claim_amount,
  c.number_of_vehicles_involved, c.bodily_injuries, c.witnesses, c.incident_date_raw,
  c.claim_logged_on_raw, c.claim_processed_on_raw, c._source_file
FROM claims_clean c LEFT JOIN dim_policy p ON c.policy_id = p.policy_number
LEFT JOIN customers_clean h ON p.customer_id = h.customer_id"""
CTES["fact_sales"] = """
SELECT s.sales_id, s.car_id, c.name AS car_name, c.model AS car_model, c.fuel, c.transmission,
  c.seats, s.region, s.state, s.city, s.seller_type, s.owner, s.ad_placed_on, s.sold_on,
  CAST(year(s.ad_placed_on) AS INT) AS listing_year,
  CAST(month(s.ad_placed_on) AS INT) AS listing_month,
  CASE WHEN s.sold_on IS NOT NULL THEN 1 ELSE 0 END AS is_sold, s.original_selling_price,
  s.days_unsold,
  CASE WHEN s.sold_on IS NULL THEN s.original_selling_price END AS revenue_at_risk,
  s._source_file
FROM sales_clean s LEFT JOIN cars_clean c ON s.car_id = c.car_id"""
CTES["retrieval_hits"] = """
SELECT query_id, vec_id, rank, distance, 1.0 / (1.0 + distance) AS confidence FROM (
  SELECT q.query_id, e.vec_id, q.distance_to AS distance,
    row_number() OVER (PARTITION BY q.query_id ORDER BY q.distance_to, e.vec_id) AS rank
  FROM (SELECT qq.query_id, ee.vec_id,
          list_sum(list_transform(list_zip(ee.embedding, qq.embedding),
            lambda x: pow(CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE), 2))) AS distance_to
        FROM questions qq, embeddings ee) q
  JOIN embeddings e ON e.vec_id = q.vec_id)
WHERE rank <= 5"""
CTES["questions"] = """
SELECT label AS query_id, arg_min(embedding, vec_id) AS embedding FROM embeddings GROUP BY label"""


def needed(text: str) -> list[str]:
    """Blocks that `text` refers to, dependencies first."""
    order: list[str] = []

    def visit(body: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", body) and name not in order:
                if CTES[name] is not body:
                    visit(CTES[name])
                    if name not in order:
                        order.append(name)

    visit(text)
    return order


def with_blocks(select: str) -> str:
    blocks = needed(select)
    if not blocks:
        return select.strip()
    head = ",\n".join(f"{name} AS ({CTES[name]}\n)" for name in blocks)
    return f"WITH {head}\n{select.strip()}"


# ----------------------------------------------------------------------- further blocks
CTES["scored"] = """
SELECT *, high_amount_points + severity_mismatch_points + missing_documentation_points
    + no_witnesses_multi_vehicle_points + injury_without_property_points AS anomaly_score
FROM (SELECT *,
  CASE WHEN z > 2.0 THEN 30 WHEN z > 1.5 THEN 20 WHEN z > 1.0 THEN 10 ELSE 0 END
    AS high_amount_points,
  CASE WHEN incident_severity = 'Trivial Damage' AND total_claim_amount > 12652.40 THEN 25
       WHEN incident_severity = 'Minor Damage' AND total_claim_amount > 35665 THEN 20 ELSE 0 END
    AS severity_mismatch_points,
  CASE WHEN property_damage = 'YES' AND police_report_available IS NULL THEN 20
       WHEN property_damage = 'YES' AND police_report_available = 'NO' THEN 15
       WHEN authorities_contacted = 'None' THEN 10 ELSE 0 END AS missing_documentation_points,
  CASE WHEN number_of_vehicles_involved >= 3 AND witnesses = 0 THEN 15
       WHEN number_of_vehicles_involved >= 3 AND witnesses = 1 THEN 8 ELSE 0 END
    AS no_witnesses_multi_vehicle_points,
  CASE WHEN bodily_injuries = 2 AND (property_damage = 'NO' OR property_damage IS NULL) THEN 10
       WHEN bodily_injuries >= 1 AND property_damage = 'NO' AND vehicle_amount IS NULL THEN 10
       ELSE 0 END AS injury_without_property_points
FROM (SELECT *, (total_claim_amount - 12652.40::DOUBLE) / 10743.84::DOUBLE AS z
      FROM claims_totals) t) u"""
CTES["claims_totals"] = """
SELECT *, COALESCE(injury_amount, 0.0::DOUBLE) + COALESCE(property_amount, 0.0::DOUBLE)
  + COALESCE(vehicle_amount, 0.0::DOUBLE) AS total_claim_amount FROM claims_clean"""
_TIERED = """*, CASE WHEN anomaly_score >= 40 THEN 'HIGH' WHEN anomaly_score >= 20 THEN 'MEDIUM'
    ELSE 'LOW' END AS priority_tier,
  concat_ws(', ', CASE WHEN high_amount_points > 0 THEN 'HIGH_AMOUNT' END,
    CASE WHEN severity_mismatch_points > 0 THEN 'SEVERITY_MISMATCH' END,
    CASE WHEN missing_documentation_points > 0 THEN 'MISSING_DOCUMENTATION' END,
    CASE WHEN no_witnesses_multi_vehicle_points > 0 THEN 'NO_WITNESSES_MULTI_VEHICLE' END,
    CASE WHEN injury_without_property_points > 0 THEN 'INJURY_WITHOUT_PROPERTY' END)
    AS triggered_rules"""
CTES["tiered"] = f"SELECT {_TIERED} FROM scored"
CTES["amount_stats"] = """
SELECT avg(total_claim_amount) AS mean, stddev_samp(total_claim_amount) AS std,
  (SELECT min(v) FROM (SELECT total_claim_amount AS v,
      row_number() OVER (ORDER BY total_claim_amount) AS rn,
      count(*) OVER () AS n FROM claims_totals) WHERE rn >= ceil(0.95::DOUBLE * n)) AS p95
FROM claims_totals"""
CTES["calibrated"] = CTES["scored"].replace("12652.40::DOUBLE", "mean").replace(
    "10743.84::DOUBLE", "std").replace("12652.40", "mean").replace("35665", "p95").replace(
    "FROM claims_totals", "FROM claims_totals, amount_stats")
CTES["tiered_calibrated"] = f"SELECT {_TIERED} FROM calibrated"
CTES["prompts"] = """
SELECT claim_id, 'Prepare an investigation brief for claim ' || claim_id || ' under policy '
  || policy_id || '. Claimed in total $' || format('{:,.2f}', total_claim_amount)
  || ': injury $' || format('{:,.2f}', COALESCE(injury_amount, 0.0::DOUBLE))
  || ', property $' || format('{:,.2f}', COALESCE(property_amount, 0.0::DOUBLE))
  || ', vehicle $' || format('{:,.2f}', COALESCE(vehicle_amount, 0.0::DOUBLE))
  || '. Incident: ' || incident_severity || ', ' || incident_type || ', collision type '
  || collision_type || ', ' || number_of_vehicles_involved || ' vehicles, ' || bodily_injuries
  || ' injured, ' || witnesses || ' witnesses. Property damage reported: '
  || COALESCE(property_damage, 'None') || '; police report: '
  || COALESCE(police_report_available, 'None') || '; authorities contacted: '
  || authorities_contacted || '. Risk score ' || anomaly_score || '/100 (' || priority_tier
  || '), triggered by: ' || triggered_rules
  || '. State what is suspicious, the risk factors in this claim''s own numbers, and the next '
  || 'steps for the adjuster. Answer in three sections: Suspicious Findings, Risk Factors, '
  || 'Recommended Actions.' AS prompt
FROM tiered WHERE priority_tier IN ('HIGH', 'MEDIUM')"""
CTES["policy_docs"] = """
SELECT policy_number, 'Policy ' || policy_number || ' is a ' || policy_csl_tier
  || '-tier auto insurance policy in ' || policy_state || ' with coverage limits of '
  || policy_csl || ' (CSL). It was bound on ' || CAST(policy_bind_date AS VARCHAR) || ' with a $'
  || format('{:,}', policy_deductable) || ' deductible and an annual premium of $'
  || format('{:,.2f}', policy_annual_premium) || '. This policy has '
  || CASE WHEN umbrella_limit > 0 THEN '$' || format('{:,}', umbrella_limit)
     || ' umbrella coverage' ELSE 'no umbrella coverage' END
  || '. It covers car ' || car_id || ' for customer ' || customer_id || '.' AS document
FROM dim_policy"""
_COUNTS = ("list_transform(['0','1','2','3','4','5','6','7','8','9','a','e','i','n','o','r','s','t'], "
           "lambda c: CAST(length({0}) - length(replace({0}, c, '')) AS DOUBLE))")
CTES["policy_vectors"] = f"""
SELECT policy_number, {_COUNTS.format('document')} AS v FROM policy_docs"""
CTES["question_vectors"] = f"""
SELECT query_id, {_COUNTS.format("('Which policies resemble ' || query_id || '?')")} AS v FROM questions"""
CTES["policy_hits"] = """
SELECT query_id, policy_number, rank, 1.0 / (1.0 + distance) AS confidence FROM (
  SELECT query_id, policy_number, distance,
    row_number() OVER (PARTITION BY query_id ORDER BY distance, policy_number) AS rank
  FROM (SELECT q.query_id, p.policy_number,
          list_sum(list_transform(list_zip(p.v, q.v), lambda x: pow(x[1] - x[2], 2))) AS distance
        FROM question_vectors q, policy_vectors p))
WHERE rank <= 5"""
CTES["issue_counts"] = """
SELECT issue_id, CAST(a AS BIGINT) AS affected_records, CAST(t AS BIGINT) AS total_records FROM (
  SELECT 'DQ-001' AS issue_id, count_if(COALESCE(CustomerID, Customer_ID, cust_id) IS NOT NULL) AS a, count(*) AS t FROM customers_raw
  UNION ALL SELECT 'DQ-002', count_if(Region IN ('E','W','C','S')), count(*) FROM customers_raw
  UNION ALL SELECT 'DQ-003', count_if(Reg IS NOT NULL), count(*) FROM customers_raw
  UNION ALL SELECT 'DQ-004', count_if(Education IN ('single','married','divorced')
    OR Marital_status IN ('primary','secondary','tertiary','NA')), count(*) FROM customers_raw
  UNION ALL SELECT 'DQ-005', count_if(Education = 'terto'), count(*) FROM customers_raw
  UNION ALL SELECT 'DQ-006', count_if(src = 'customers_2'), count(*) FROM customers_raw
  UNION ALL SELECT 'DQ-007', count_if(src = 'customers_2'), count(*) FROM customers_raw
  UNION ALL SELECT 'DQ-008', count_if(try_strptime(incident_date, '%d-%m-%Y %H:%M') IS NULL), count(*) FROM claims_raw
  UNION ALL SELECT 'DQ-009', count_if(Claim_Processed_On = 'NULL'), count(*) FROM claims_raw
  UNION ALL SELECT 'DQ-010', count_if(property_damage = '?'), count(*) FROM claims_raw
  UNION ALL SELECT 'DQ-011', count_if(vehicle = 'NULL'), count(*) FROM claims_raw
  UNION ALL SELECT 'DQ-012', count_if(sales_id IS NULL AND ad_placed_on IS NULL AND sold_on IS NULL
    AND original_selling_price IS NULL AND Region IS NULL AND State IS NULL AND City IS NULL
    AND seller_type IS NULL AND owner IS NULL AND car_id IS NULL), count(*) FROM sales_raw
  UNION ALL SELECT 'DQ-013', count_if(TRY_CAST(umbrella_limit AS INT) < 0), count(*) FROM policy_raw
  UNION ALL SELECT 'DQ-014', count(*) - count(DISTINCT COALESCE(CustomerID, Customer_ID, cust_id)), count(*) FROM customers_raw)"""
_META = [
    ("DQ-001", "customers", "CustomerID", "valid_customer_id", "schema_variation", "critical", "The customer id has three column names across the files", "Take the first id column that holds a value"),
    ("DQ-002", "customers", "Region", "valid_region", "schema_variation", "high", "Regions are given as one-letter codes", "Map the codes to region names"),
    ("DQ-003", "customers", "Region", "valid_region", "schema_variation", "high", "The region column is named Reg", "Read Reg where Region is missing"),
    ("DQ-004", "customers", "Education", "valid_education", "column_swap", "critical", "Education and marital status are swapped", "Recognise the swap by the values and swap back"),
    ("DQ-005", "customers", "Education", "valid_education", "data_corruption", "medium", "Education holds the truncated value terto", "Replace it by tertiary"),
    ("DQ-006", "customers", "Marital_status", "valid_marital", "missing_column", "high", "A source has no marital column under any name", "Accept NULL as marital status"),
    ("DQ-007", "customers", "HHInsurance", "missing_column", "missing_column", "medium", "A source has no household insurance column", "Keep NULL and tell the source owner"),
    ("DQ-008", "claims", "incident_date", "valid_date_format", "data_corruption", "critical", "Incident dates are minute fragments, not dates", "Keep the text for audit; no date can be recovered"),
    ("DQ-009", "claims", "Claim_Processed_On", "null_string_check", "data_corruption", "high", "Unprocessed claims carry the text NULL", "Turn the text into a real NULL"),
    ("DQ-010", "claims", "property_damage", "unknown_value_check", "unknown_values", "medium", "A question mark stands for an unknown answer", "Turn it into NULL"),
    ("DQ-011", "claims", "vehicle", "type_cast_check", "type_mismatch", "medium", "The text NULL in an amount column prevents the cast", "Turn it into NULL before the cast"),
    ("DQ-012", "sales", "sales_id", "blank_row_check", "blank_rows", "critical", "Rows without any value, left by the export", "Drop them, do not quarantine"),
    ("DQ-013", "policy", "umbrella_limit", "valid_umbrella_limit", "invalid_value", "high", "The umbrella limit is negative", "Quarantine the policy"),
    ("DQ-014", "customers", "customer_id", "duplicate_check", "duplicate_records", "critical", "Customers are in regional files and in the master file", "Keep one row per customer, the master file first"),
]
CTES["issue_meta"] = ("SELECT * FROM (VALUES "
                      + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in _META)
                      + ") AS t(issue_id, table_name, column_name, rule_name, issue_type, "
                      "severity, description, suggested_fix)")

# ------------------------------------------------------------------------- final selects
FINAL: dict[str, str] = {}

FINAL["harmonize_customers"] = "SELECT * FROM customers_typed"
FINAL["dedup_priority"] = "SELECT * FROM customers_one"
for _t in ("customers", "claims", "policy", "sales", "cars"):
    FINAL[f"clean_{_t}"] = f"SELECT * FROM {_t}_clean"
    FINAL[f"quarantine_{_t}"] = f"SELECT * FROM {_t}_failed"

_RULES = {
    "customers_one": [
        ("valid_customer_id", "customer_id IS NOT NULL"),
        ("valid_region", "region IN ('East','West','Central','South','North')"),
        ("valid_marital", "marital IS NULL OR marital IN ('single','married','divorced')"),
        ("valid_education",
         "education IS NULL OR education IN ('primary','secondary','tertiary','NA')")],
    "claims_typed": [
        ("valid_claim_id", "claim_id IS NOT NULL"), ("valid_policy_id", "policy_id IS NOT NULL"),
        ("valid_rejected", "claim_rejected IN ('Y','N')"),
        ("valid_injury", "injury_amount IS NOT NULL"),
        ("valid_property", "property_amount IS NOT NULL")],
    "policy_typed": [
        ("valid_policy_number", "policy_number IS NOT NULL"),
        ("valid_customer_id", "customer_id IS NOT NULL"), ("valid_car_id", "car_id IS NOT NULL"),
        ("valid_premium", "policy_annual_premium > 0"),
        ("valid_umbrella", "umbrella_limit >= 0")],
    "sales_typed": [
        ("valid_sales_id", "sales_id IS NOT NULL"),
        ("valid_ad_placed", "ad_placed_on IS NOT NULL"), ("valid_car_id", "car_id IS NOT NULL")],
    "cars_typed": [("valid_car_id", "car_id IS NOT NULL"), ("valid_seats", "seats > 0")],
}
FINAL["rule_counts"] = "\nUNION ALL ".join(
    f"SELECT '{block.split('_')[0]}' AS table_name, '{name}' AS rule_name, count(*) AS total_rows, "
    f"CAST(count_if({test}) AS BIGINT) AS passed_rows, "
    f"count(*) - CAST(count_if({test}) AS BIGINT) AS failed_rows FROM {block}"
    for block, tests in _RULES.items() for name, test in tests)
FINAL["dq_registry"] = """
SELECT m.issue_id, m.table_name, m.column_name, m.rule_name, m.issue_type, m.severity,
  c.affected_records, c.total_records,
  CAST(round(CAST(CAST(CAST(c.affected_records AS DOUBLE) / c.total_records AS VARCHAR) AS DECIMAL(38, 14)), 3) AS DOUBLE) AS affected_ratio,
  m.description, m.suggested_fix FROM issue_meta m JOIN issue_counts c USING (issue_id)"""
FINAL["duplicate_excess"] = """
SELECT count(*) AS total_rows, count(DISTINCT id) AS distinct_keys,
  count(id) - count(DISTINCT id) AS excess_rows
FROM (SELECT COALESCE(CustomerID, Customer_ID, cust_id) AS id FROM customers_raw)"""
FINAL["split_once"] = """
SELECT CASE WHEN _rejection_reason = '' THEN 'clean' ELSE 'failed' END AS part,
  _rejection_reason AS reason, count(*) AS row_count FROM policy_flagged GROUP BY ALL"""
FINAL["email_check"] = r"""
SELECT c_custkey, email,
  COALESCE(regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$'), false)
    AS is_valid
FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 1 THEN c_custkey || '.example.com'
    WHEN 2 THEN NULL WHEN 3 THEN 'a b' || c_custkey || '@x.org'
    ELSE 'user.' || c_custkey || '@mail.example.com' END AS email FROM customer)"""

for _t in ("dim_customer", "dim_policy", "dim_car", "fact_claims", "fact_sales"):
    FINAL[_t] = f"SELECT * FROM {_t}"
FINAL["dim_date"] = """
SELECT strftime(d, '%Y%m%d') AS date_key, CAST(d AS DATE) AS full_date,
  CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
  CAST(month(d) AS INT) AS month, strftime(d, '%B') AS month_name,
  CAST(dayofweek(d) + 1 AS INT) AS day_of_week, strftime(d, '%A') AS day_name,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
FROM (SELECT unnest(generate_series(min(policy_bind_date)::TIMESTAMP,
    max(policy_bind_date)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM policy_clean)"""

_RATE = "CAST(round(CAST(CAST(CAST(sum(is_rejected) AS DOUBLE) * 100.0 / count(*) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE)"
_RATE1 = "CAST(round(CAST(CAST(CAST(sum(is_rejected) AS DOUBLE) * 100.0 / count(*) AS VARCHAR) AS DECIMAL(38, 14)), 1) AS DOUBLE)"
FINAL["rollup_rejection_by_tier_region"] = f"""
SELECT policy_csl, policy_csl_tier, region, count(*) AS total_claims,
  CAST(sum(is_rejected) AS BIGINT) AS rejected_claims, {_RATE} AS rejection_rate_pct,
  CAST(round(CAST(CAST(CAST(sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS DOUBLE) / count(total_claim_amount) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_claim_amount,
  CAST(round(sum(CAST(total_claim_amount AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_claim_amount
FROM fact_claims GROUP BY policy_csl, policy_csl_tier, region"""
FINAL["rollup_severity"] = f"""
SELECT incident_severity, count(*) AS total_claims,
  CAST(sum(is_rejected) AS BIGINT) AS rejected_claims, {_RATE} AS rejection_rate_pct,
  CAST(round(sum(CAST(total_claim_amount AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_claim_amount,
  CAST(round(CAST(CAST(CAST(sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS DOUBLE) / count(total_claim_amount) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_claim_amount,
  CAST(round(CAST(CAST(avg(bodily_injuries) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_bodily_injuries,
  CAST(round(CAST(CAST(avg(number_of_vehicles_involved) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_vehicles_involved
FROM fact_claims GROUP BY incident_severity"""
FINAL["rollup_customers_by_region"] = """
SELECT region, count(*) AS customer_count, count(DISTINCT state) AS states_covered,
  CAST(round(CAST(CAST(avg(balance) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_balance,
  CAST(count_if(default_flag = 1) AS BIGINT) AS customers_with_default,
  CAST(count_if(hh_insurance = 1) AS BIGINT) AS customers_with_hh_insurance,
  CAST(count_if(car_loan = 1) AS BIGINT) AS customers_with_car_loan
FROM dim_customer GROUP BY region"""
FINAL["rollup_unsold_aging"] = """
SELECT car_model, region, count(*) AS unsold_count, max(days_unsold) AS max_days_unsold,
  CAST(round(CAST(CAST(avg(days_unsold) AS VARCHAR) AS DECIMAL(38, 14)), 1) AS DOUBLE) AS avg_days_unsold, min(days_unsold) AS min_days_unsold,
  CAST(round(sum(CAST(revenue_at_risk AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_revenue_at_risk,
  CAST(round(CAST(CAST(CAST(sum(CAST(original_selling_price AS DECIMAL(20, 4))) AS DOUBLE) / count(original_selling_price) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_listing_price,
  CAST(count_if(days_unsold > 60) AS BIGINT) AS unsold_over_60_days,
  CAST(count_if(days_unsold > 90) AS BIGINT) AS unsold_over_90_days
FROM fact_sales WHERE is_sold = 0 GROUP BY car_model, region"""
FINAL["rollup_premium_by_tier"] = """
SELECT policy_csl, policy_csl_tier, count(*) AS policy_count,
  CAST(round(CAST(CAST(CAST(sum(CAST(policy_annual_premium AS DECIMAL(20, 4))) AS DOUBLE) / count(policy_annual_premium) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_annual_premium,
  CAST(round(sum(CAST(policy_annual_premium AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_premium_revenue,
  CAST(round(CAST(CAST(avg(policy_deductable) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_deductable,
  CAST(round(CAST(CAST(avg(umbrella_limit) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_umbrella_limit,
  CAST(sum(COALESCE(n, 0)) AS BIGINT) AS total_claims_filed,
  CAST(round(CAST(CAST(CAST(sum(COALESCE(r, 0)) AS DOUBLE) * 100.0 / greatest(sum(COALESCE(n, 0)), 1) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE)
    AS overall_rejection_rate_pct,
  CAST(round(sum(COALESCE(v, 0)), 2) AS DOUBLE) AS total_claims_exposure
FROM dim_policy p LEFT JOIN (
  SELECT policy_id, count(*) AS n, sum(is_rejected) AS r,
    sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS v
  FROM fact_claims GROUP BY policy_id) c ON p.policy_number = c.policy_id
GROUP BY policy_csl, policy_csl_tier"""
FINAL["gold_row_counts"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
    for t in ("dim_customer", "dim_policy", "dim_car", "fact_claims", "fact_sales"))

FINAL["profile_row_counts"] = """
SELECT src AS table_name, count(*) AS row_count FROM customers_raw GROUP BY src
UNION ALL SELECT src, count(*) FROM sales_raw GROUP BY src
UNION ALL SELECT 'policy', count(*) FROM policy_raw
UNION ALL SELECT 'cars', count(*) FROM cars_raw"""
_VARIANTS = {
    "id_col": ["CustomerID", "Customer_ID", "cust_id"], "region_col": ["Region", "Reg"],
    "city_col": ["City", "City_in_state"], "education_col": ["Education", "Edu"],
    "marital_col": ["Marital", "Marital_status"]}
FINAL["profile_schema_variants"] = "\nUNION ALL ".join(
    f"SELECT src AS source_table, '{logical}' AS logical_column, CASE "
    + " ".join(f"WHEN count({c}) > 0 THEN '{c}'" for c in names)
    + " END AS physical_column FROM customers_raw GROUP BY src"
    for logical, names in _VARIANTS.items())
_NULLS = {
    "customerid": "COALESCE(CustomerID, Customer_ID, cust_id)",
    "region": "CASE WHEN src = 'customers_1' THEN Reg ELSE Region END", "state": "State",
    "city": "CASE WHEN src = 'customers_2' THEN City_in_state ELSE City END",
    "education": "CASE WHEN src = 'customers_2' THEN Edu ELSE Education END"}
FINAL["profile_nulls_customers"] = "\nUNION ALL ".join(
    f"SELECT src AS table_name, '{name}' AS column_name, count(*) AS total_rows, "
    + (f"CASE WHEN src <> 'customers_4' THEN count(*) - count({e}) END" if name == "education"
       else f"count(*) - count({e})")
    + " AS null_rows FROM customers_raw GROUP BY src" for name, e in _NULLS.items())
FINAL["profile_region_values"] = f"""
SELECT src AS table_name, 'region' AS column_name, {_NULLS['region']} AS value, count(*) AS cnt
FROM customers_raw GROUP BY ALL"""
FINAL["profile_education_values"] = f"""
SELECT src AS table_name, 'education' AS column_name, {_NULLS['education']} AS value,
  count(*) AS cnt FROM customers_raw WHERE src <> 'customers_4' GROUP BY ALL"""
FINAL["profile_swap"] = """
SELECT 'Education' AS column_name, Education AS value, count(*) AS cnt
FROM customers_raw WHERE src = 'customers_6' GROUP BY Education
UNION ALL SELECT 'Marital_status', Marital_status, count(*)
FROM customers_raw WHERE src = 'customers_6' GROUP BY Marital_status"""
_REST = "Defaulted AS default_flag, Balance AS balance"
FINAL["harmonized_union"] = f"""
SELECT src AS source_table, CustomerID AS customer_id, Reg AS region, State AS state, City AS city,
  CAST(NULL AS VARCHAR) AS job, Marital_status AS marital_status, Education AS education, {_REST},
  HHInsurance AS hh_insurance, CarLoan AS car_loan FROM customers_raw WHERE src = 'customers_1'
UNION ALL SELECT src, Customer_ID, Region, State, City_in_state, Job, NULL, Edu, {_REST},
  NULL, CarLoan FROM customers_raw WHERE src = 'customers_2'
UNION ALL SELECT src, cust_id, Region, State, City, Job, Marital, Education, {_REST},
  HHInsurance, CarLoan FROM customers_raw WHERE src = 'customers_3'
UNION ALL SELECT src, CustomerID, Region, State, City, Job, Marital, NULL, {_REST},
  HHInsurance, CarLoan FROM customers_raw WHERE src = 'customers_4'
UNION ALL SELECT src, CustomerID, CASE Region WHEN 'E' THEN 'East' WHEN 'W' THEN 'West'
  WHEN 'C' THEN 'Central' WHEN 'S' THEN 'South' ELSE Region END, State, City, Job, Marital,
  CASE WHEN Education = 'terto' THEN 'tertiary' ELSE Education END, {_REST},
  HHInsurance, CarLoan FROM customers_raw WHERE src = 'customers_5'
UNION ALL SELECT src, CustomerID, Region, State, City, Job, Education, Marital_status, {_REST},
  HHInsurance, CarLoan FROM customers_raw WHERE src = 'customers_6'"""
FINAL["profile_source_keys"] = """
SELECT src AS source_table, count(*) AS rows_in_source,
  count(DISTINCT COALESCE(CustomerID, Customer_ID, cust_id)) AS distinct_keys
FROM customers_raw WHERE src <> 'customers_7' GROUP BY src"""
FINAL["anti_master"] = """
SELECT CustomerID FROM customers_raw WHERE src = 'customers_7' AND CustomerID NOT IN (
  SELECT COALESCE(CustomerID, Customer_ID, cust_id) FROM customers_raw
  WHERE src <> 'customers_7')"""
FINAL["profile_policy_keys"] = """
SELECT count(*) AS total_rows, count(DISTINCT policy_number) AS distinct_policy_number,
  count(DISTINCT customer_id) AS distinct_customer_id, count(DISTINCT car_id) AS distinct_car_id,
  count(*) - count(policy_number) AS null_policy_number,
  count(*) - count(customer_id) AS null_customer_id, count(*) - count(car_id) AS null_car_id,
  count(*) - count(policy_bind_date) AS null_policy_bind_date FROM policy_raw"""
_POLICY = """p.policy_number, p.policy_bind_date, p.policy_state, p.policy_csl,
  p.policy_deductable, p.policy_annual_premium, p.umbrella_limit, p.car_id, p.customer_id,
  p.src AS _source_file"""
FINAL["suspicious_policies"] = f"""
SELECT {_POLICY} FROM policy_raw p WHERE TRY_CAST(umbrella_limit AS DOUBLE) < 0
  OR TRY_CAST(policy_annual_premium AS DOUBLE) <= 0 OR TRY_CAST(policy_deductable AS DOUBLE) <= 0"""
FINAL["anti_policy_customer"] = f"""
SELECT {_POLICY} FROM policy_raw p WHERE NOT EXISTS (
  SELECT 1 FROM customers_raw c WHERE c.src = 'customers_7' AND c.CustomerID = p.customer_id)"""
FINAL["anti_policy_car"] = f"""
SELECT {_POLICY} FROM policy_raw p WHERE NOT EXISTS (
  SELECT 1 FROM cars_raw c WHERE c.car_id = p.car_id)"""
_BLANK = """sales_id IS NULL AND ad_placed_on IS NULL AND sold_on IS NULL
  AND original_selling_price IS NULL AND Region IS NULL AND State IS NULL AND City IS NULL
  AND seller_type IS NULL AND owner IS NULL AND car_id IS NULL"""
FINAL["blank_rows"] = f"""
SELECT * EXCLUDE (src), src AS _source_file FROM sales_raw WHERE {_BLANK}"""
FINAL["blank_row_counts"] = f"""
SELECT src AS table_name, count(*) AS blank_rows FROM sales_raw WHERE {_BLANK} GROUP BY src"""
FINAL["partial_rows"] = """
SELECT * EXCLUDE (src), src AS _source_file FROM sales_raw
WHERE ad_placed_on IS NOT NULL AND (sales_id IS NULL OR original_selling_price IS NULL
  OR Region IS NULL OR State IS NULL OR City IS NULL OR seller_type IS NULL OR owner IS NULL
  OR car_id IS NULL)"""
FINAL["usable_rows"] = f"""
SELECT src AS table_name, count(*) AS usable_rows FROM sales_raw WHERE NOT ({_BLANK})
GROUP BY src"""
FINAL["unsold_by_source"] = """
SELECT src AS table_name, count(*) AS unsold_count FROM sales_raw
WHERE sold_on IS NULL AND car_id IS NOT NULL GROUP BY src"""
FINAL["aging_buckets"] = f"""
SELECT src AS source_table, Region AS region, count(*) AS unsold_cars,
  CAST(count_if(age >= 90) AS BIGINT) AS unsold_90_plus_days,
  CAST(count_if(age >= 60) AS BIGINT) AS unsold_60_plus_days
FROM (SELECT *, date_diff('day', CAST(try_strptime(ad_placed_on, '%d-%m-%Y %H:%M') AS DATE),
    {AS_OF}) AS age FROM sales_raw
  WHERE car_id IS NOT NULL AND try_strptime(sold_on, '%d-%m-%Y %H:%M') IS NULL)
GROUP BY ALL"""
FINAL["dups_across_sources"] = """
SELECT sales_id, car_id, count(*) AS cnt,
  string_agg(DISTINCT src, ', ' ORDER BY src) AS source_tables
FROM sales_raw WHERE sales_id IS NOT NULL AND car_id IS NOT NULL
GROUP BY sales_id, car_id HAVING count(*) > 1"""
FINAL["profile_cars"] = ("SELECT count(*) AS total_rows, count(DISTINCT car_id) AS distinct_car_id, "
                         + ", ".join(f"count(*) - count({c}) AS null_{c}" for c in (
                             "car_id", "name", "fuel", "transmission", "mileage", "engine",
                             "max_power", "torque")) + " FROM cars_raw")
FINAL["profile_car_mix"] = """
SELECT fuel, transmission, seats, count(*) AS cnt FROM cars_raw GROUP BY ALL"""
FINAL["anti_sales_car"] = """
SELECT src AS source_table, car_id FROM sales_raw s WHERE car_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM cars_raw c WHERE c.car_id = s.car_id)"""
FINAL["join_preview"] = """
SELECT p.policy_number, p.policy_bind_date, p.policy_state, p.policy_annual_premium, p.customer_id,
  c.Region AS region, c.State AS state, c.City AS city, c.Job AS job, c.Marital AS marital,
  c.Education AS education, p.car_id, v.name AS car_name, v.model, v.fuel, v.transmission
FROM policy_raw p
LEFT JOIN (SELECT * FROM customers_raw WHERE src = 'customers_7') c ON p.customer_id = c.CustomerID
LEFT JOIN cars_raw v ON p.car_id = v.car_id
ORDER BY p.policy_number NULLS LAST, p.policy_bind_date NULLS LAST, p.policy_state NULLS LAST,
  p.policy_annual_premium NULLS LAST, p.customer_id NULLS LAST, p.car_id NULLS LAST,
  region NULLS FIRST, state NULLS FIRST, city NULLS FIRST, job NULLS FIRST, marital NULLS FIRST,
  education NULLS FIRST, car_name NULLS FIRST, model NULLS FIRST, fuel NULLS FIRST,
  transmission NULLS FIRST LIMIT 100"""
FINAL["profile_nulls_claims"] = """
SELECT 'ClaimID' AS column_name, count(*) AS total_rows, count(*) - count(ClaimID) AS null_rows
FROM claims_raw
UNION ALL SELECT 'Claim_Logged_On', count(*), count(*) - count(Claim_Logged_On) FROM claims_raw"""
_CLAIM_COLUMNS = [
    "ClaimID", "PolicyID", "incident_state", "incident_city", "incident_location",
    "incident_type", "collision_type", "incident_severity", "authorities_contacted", "injury",
    "property", "vehicle", "number_of_vehicles_involved", "property_damage",
    "police_report_available", "bodily_injuries", "witnesses", "Claim_Rejected",
    "Claim_Processed_On", "incident_date", "Claim_Logged_On"]
FINAL["profile_schema"] = "\nUNION ALL ".join(
    f"SELECT 'claims' AS table_name, count(*) AS total_rows, {i} AS position, "
    f"'{c}' AS column_name, '{'bigint' if i <= 2 else 'string'}' AS data_type, "
    f"count({c}) AS filled_rows FROM claims_raw" for i, c in enumerate(_CLAIM_COLUMNS, 1))
FINAL["dups_key"] = """
SELECT ClaimID, count(*) AS cnt FROM claims_raw GROUP BY ClaimID HAVING count(*) > 1"""
FINAL["missing_timestamp"] = """
SELECT * EXCLUDE (src), src AS _source_file FROM claims_raw WHERE Claim_Logged_On IS NULL"""
FINAL["claim_log_dates"] = """
SELECT ClaimID, Claim_Logged_On, try_strptime(Claim_Logged_On, '%d-%m-%Y %H:%M') AS parsed_claim_ts
FROM claims_raw"""
FINAL["anti_claims_policy"] = """
SELECT * EXCLUDE (src), src AS _source_file FROM claims_raw c WHERE NOT EXISTS (
  SELECT 1 FROM policy_raw p WHERE p.policy_number = c.PolicyID)"""
FINAL["key_coverage"] = "\nUNION ALL ".join(
    f"SELECT 'claims.{lk} -> {table}.{rk}' AS key_pair, count(*) AS total_rows, "
    f"CAST(count_if({lk} IN (SELECT {rk} FROM {table}_raw WHERE {rk} IS NOT NULL{extra})) AS BIGINT) AS matched_rows, "
    f"CAST(count_if({lk} NOT IN (SELECT {rk} FROM {table}_raw WHERE {rk} IS NOT NULL{extra})) AS BIGINT) AS unmatched_rows "
    "FROM claims_raw"
    for table, rk, extra in (("policy", "policy_number", ""),
                             ("customers", "CustomerID", " AND src = 'customers_7'"))
    for lk in ("PolicyID", "ClaimID"))
_PATHS = (("nation", "n_regionkey", "region", "r_regionkey"),
          ("customer", "c_nationkey", "nation", "n_nationkey"),
          ("supplier", "s_nationkey", "nation", "n_nationkey"),
          ("orders", "o_custkey", "customer", "c_custkey"),
          ("lineitem", "l_orderkey", "orders", "o_orderkey"),
          ("lineitem", "l_partkey", "part", "p_partkey"),
          ("lineitem", "l_suppkey", "supplier", "s_suppkey"))
FINAL["join_paths"] = "\nUNION ALL ".join(
    f"SELECT '{t}.{c} -> {u}.{k}' AS key_pair, count(*) AS total_rows, "
    f"CAST(count_if({c} IN (SELECT {k} FROM {u})) AS BIGINT) AS matched_rows, "
    f"CAST(count(*) - count_if({c} IN (SELECT {k} FROM {u})) AS BIGINT) AS unmatched_rows FROM {t}"
    for t, c, u, k in _PATHS)
_RENAMED = {"Customer_ID": "CustomerID", "cust_id": "CustomerID", "Reg": "Region",
            "City_in_state": "City", "Edu": "Education", "Marital_status": "Marital"}
_SWAPPED = {"Education": "Marital", "Marital_status": "Education"}
FINAL["column_matches"] = "\nUNION ALL ".join(
    f"SELECT src AS source_table, '{c}' AS physical_column, CASE WHEN src = 'customers_6' THEN "
    f"'{_SWAPPED.get(c, _RENAMED.get(c, c))}' ELSE '{_RENAMED.get(c, c)}' END AS logical_column "
    f"FROM customers_raw WHERE src <> 'customers_7' GROUP BY src "
    f"HAVING count({c.replace('Default', 'Defaulted')}) > 0"
    for c in ("CustomerID", "Region", "State", "City", "Job", "Marital", "Education", "Default",
              "Balance", "HHInsurance", "CarLoan", *_RENAMED))
FINAL["matched_union"] = """
SELECT src AS _source_file, COALESCE(CustomerID, Customer_ID, cust_id) AS CustomerID,
  COALESCE(Region, Reg) AS Region, State, COALESCE(City, City_in_state) AS City, Job,
  CASE WHEN src = 'customers_6' THEN Education ELSE COALESCE(Marital, Marital_status) END AS Marital,
  CASE WHEN src = 'customers_6' THEN Marital_status ELSE COALESCE(Education, Edu) END AS Education,
  Defaulted AS "Default", Balance, HHInsurance, CarLoan FROM customers_raw"""
FINAL["profile_numeric"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(round(CAST(CAST(avg({c}) AS VARCHAR) AS DECIMAL(38, 14)), 4) AS DOUBLE) AS mean, "
    f"CAST(round(CAST(CAST(stddev_samp({c}) AS VARCHAR) AS DECIMAL(38, 14)), 4) AS DOUBLE) AS stddev FROM claims_clean"
    for c in ("injury_amount", "property_amount", "vehicle_amount"))
FINAL["profile_amounts"] = """
SELECT CAST(round(CAST(CAST(CAST(sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS DOUBLE) / count(total_claim_amount) AS VARCHAR) AS DECIMAL(38, 14)), 4) AS DOUBLE) AS mean, CAST(round(CAST(CAST(stddev_samp(total_claim_amount) AS VARCHAR) AS DECIMAL(38, 14)), 4) AS DOUBLE) AS stddev,
  max(total_claim_amount) AS max, min(total_claim_amount) AS min,
  (SELECT p95 FROM amount_stats) AS quantile FROM claims_totals"""
FINAL["profile_claim_categories"] = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS cnt "
    f"FROM claims_clean GROUP BY {c}" for c in (
        "incident_severity", "claim_rejected", "bodily_injuries", "witnesses",
        "number_of_vehicles_involved", "authorities_contacted"))
FINAL["profile_damage_reports"] = """
SELECT property_damage, police_report_available, count(*) AS cnt FROM claims_clean GROUP BY ALL"""

_SCORE_COLUMNS = """claim_id, policy_id, total_claim_amount, CAST(round(CAST(CAST(z AS VARCHAR) AS DECIMAL(38, 14)), 6) AS DOUBLE) AS amount_zscore,
  high_amount_points, severity_mismatch_points, missing_documentation_points,
  no_witnesses_multi_vehicle_points, injury_without_property_points, anomaly_score,
  priority_tier, triggered_rules"""
FINAL["score_claims"] = f"SELECT {_SCORE_COLUMNS} FROM tiered"
FINAL["score_claims_calibrated"] = f"SELECT {_SCORE_COLUMNS} FROM tiered_calibrated"
FINAL["score_tiers"] = "SELECT priority_tier, count(*) AS cnt FROM tiered GROUP BY priority_tier"
FINAL["score_summary"] = """
SELECT CAST(round(CAST(CAST(avg(anomaly_score) AS VARCHAR) AS DECIMAL(38, 14)), 4) AS DOUBLE) AS avg_score, max(anomaly_score) AS max_score,
  min(anomaly_score) AS min_score,
  CAST(count_if(priority_tier IN ('HIGH','MEDIUM')) AS BIGINT) AS flagged_claims,
  CAST(round(CAST(CAST(CAST(count_if(priority_tier IN ('HIGH','MEDIUM')) AS DOUBLE) * 100.0 / count(*) AS VARCHAR) AS DECIMAL(38, 14)), 1) AS DOUBLE)
    AS flagged_pct FROM tiered"""
for _name, _tier, _k in (("top_flagged", "HIGH", 5), ("top_medium", "MEDIUM", 1)):
    FINAL[_name] = f"""
SELECT claim_id, anomaly_score, priority_tier, total_claim_amount, incident_severity,
  triggered_rules FROM tiered WHERE priority_tier = '{_tier}'
ORDER BY anomaly_score DESC, claim_id, total_claim_amount DESC, incident_severity,
  triggered_rules LIMIT {_k}"""
FINAL["prompt_text"] = "SELECT claim_id, prompt FROM prompts"
FINAL["scored_output"] = """
SELECT claim_id, policy_id, incident_severity, incident_type, collision_type, total_claim_amount,
  COALESCE(injury_amount, 0.0::DOUBLE) AS injury_amount,
  COALESCE(property_amount, 0.0::DOUBLE) AS property_amount,
  COALESCE(vehicle_amount, 0.0::DOUBLE) AS vehicle_amount, number_of_vehicles_involved,
  bodily_injuries, witnesses, property_damage, police_report_available, authorities_contacted,
  claim_rejected, anomaly_score, priority_tier, triggered_rules,
  CASE WHEN priority_tier <> 'LOW' THEN 'Prepare an investigation brief for claim ' || claim_id
    || ' under policy ' || policy_id || '.' END AS ai_investigation_brief,
  CASE WHEN priority_tier <> 'LOW' THEN 'template' END AS model_name,
  CASE WHEN priority_tier <> 'LOW' THEN 'success' ELSE 'not_flagged' END AS generation_status
FROM tiered"""
FINAL["generation_status"] = """
SELECT CASE WHEN priority_tier <> 'LOW' THEN 'success' ELSE 'not_flagged' END AS generation_status,
  count(*) AS cnt FROM tiered GROUP BY 1"""
FINAL["generation_resumed"] = """
SELECT claim_id, priority_tier, CASE WHEN priority_tier <> 'LOW' THEN 'Prepare an investigation brief for claim '
    || claim_id || ' under policy ' || policy_id || '.' END AS brief,
  CASE WHEN priority_tier <> 'LOW' THEN 'success' ELSE 'not_flagged' END AS generation_status,
  CASE WHEN priority_tier <> 'LOW' THEN 'template' END AS model_name,
  CASE WHEN priority_tier <> 'LOW' THEN incident_severity IS DISTINCT FROM 'Trivial Damage' END
    AS from_first_run
FROM tiered"""
FINAL["generation_failures"] = """
SELECT priority_tier, generation_status, CASE WHEN generation_status <> 'not_flagged' THEN 'refusing' END AS model_name,
  count(*) AS row_count, CAST(count_if(generation_status = 'failed') AS BIGINT) AS error_texts
FROM (SELECT priority_tier, CASE WHEN priority_tier = 'LOW' THEN 'not_flagged'
        WHEN incident_severity = 'Trivial Damage' THEN 'failed' ELSE 'success' END AS generation_status
      FROM tiered)
GROUP BY priority_tier, generation_status"""
FINAL["issue_report"] = """
SELECT m.issue_id, m.table_name, m.column_name, m.rule_name, m.issue_type, m.severity,
  c.affected_records, c.total_records,
  CAST(round(CAST(CAST(CAST(c.affected_records AS DOUBLE) / c.total_records AS VARCHAR) AS DECIMAL(38, 14)), 3) AS DOUBLE) AS affected_ratio,
  'Explain data issue ' || m.issue_id || ' to a compliance officer.' AS ai_explanation,
  'success' AS generation_status, 'template' AS model_name
FROM issue_meta m JOIN issue_counts c USING (issue_id)"""
FINAL["generate_in_sql"] = """
SELECT region, 'Region ' || region || ' has ' || count(*) || ' claims of which '
  || sum(is_rejected) || ' were rejected.' AS summary
FROM fact_claims WHERE region IS NOT NULL GROUP BY region"""
FINAL["extract_text_block"] = "SELECT conv_id, turn, role, text AS extracted FROM conversations"

FINAL["kpi_policy_count"] = "SELECT count(*) AS total_policies FROM dim_policy"
FINAL["kpi_policy_by_tier"] = """
SELECT policy_csl_tier, count(*) AS "count", CAST(round(CAST(CAST(CAST(sum(CAST(policy_annual_premium AS DECIMAL(20, 4))) AS DOUBLE) / count(policy_annual_premium) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_premium,
  CAST(round(sum(CAST(policy_annual_premium AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_revenue FROM dim_policy GROUP BY policy_csl_tier"""
FINAL["kpi_policy_by_state"] = """
SELECT policy_state, count(*) AS "count" FROM dim_policy GROUP BY policy_state"""
FINAL["kpi_umbrella"] = """
SELECT CAST(count_if(umbrella_limit > 0) AS BIGINT) AS with_umbrella,
  CAST(count_if(umbrella_limit = 0) AS BIGINT) AS without_umbrella,
  CAST(round(CAST(CAST(avg(CASE WHEN umbrella_limit > 0 THEN umbrella_limit END) AS VARCHAR) AS DECIMAL(38, 14)), 0) AS DOUBLE) AS avg_umbrella_amount
FROM dim_policy"""
FINAL["kpi_policy_by_deductible"] = """
SELECT policy_deductable, count(*) AS "count" FROM dim_policy GROUP BY policy_deductable"""
FINAL["kpi_claims_overall"] = f"""
SELECT count(*) AS total_claims, CAST(sum(is_rejected) AS BIGINT) AS total_rejected,
  count(*) - CAST(sum(is_rejected) AS BIGINT) AS total_approved, {_RATE1} AS rejection_rate_pct,
  CAST(round(sum(CAST(total_claim_amount AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_exposure,
  CAST(round(CAST(CAST(CAST(sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS DOUBLE) / count(total_claim_amount) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_claim_amount FROM fact_claims"""
FINAL["kpi_claims_by_severity"] = """
SELECT incident_severity, count(*) AS "count", CAST(sum(is_rejected) AS BIGINT) AS rejected,
  CAST(round(CAST(CAST(CAST(sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS DOUBLE) / count(total_claim_amount) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_amount FROM fact_claims GROUP BY incident_severity"""
FINAL["kpi_claims_by_region"] = f"""
SELECT region, count(*) AS "count", CAST(sum(is_rejected) AS BIGINT) AS rejected,
  {_RATE1} AS rejection_rate, CAST(round(sum(CAST(total_claim_amount AS DECIMAL(20, 4))), 2) AS DOUBLE) AS total_exposure
FROM fact_claims WHERE region IS NOT NULL GROUP BY region"""
FINAL["kpi_claims_by_tier"] = f"""
SELECT policy_csl_tier, count(*) AS "count", {_RATE1} AS rejection_rate
FROM fact_claims WHERE policy_csl_tier IS NOT NULL GROUP BY policy_csl_tier"""
FINAL["kpi_customer_count"] = "SELECT count(*) AS total_customers FROM dim_customer"
FINAL["kpi_customers_by_region"] = """
SELECT region, count(*) AS "count", CAST(round(CAST(CAST(avg(balance) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_balance
FROM dim_customer GROUP BY region"""
FINAL["kpi_customer_risk"] = """
SELECT CAST(sum(default_flag) AS BIGINT) AS customers_with_default,
  CAST(sum(hh_insurance) AS BIGINT) AS customers_with_hh_insurance,
  CAST(sum(car_loan) AS BIGINT) AS customers_with_car_loan,
  CAST(round(CAST(CAST(avg(balance) AS VARCHAR) AS DECIMAL(38, 14)), 2) AS DOUBLE) AS avg_balance FROM dim_customer"""
for _c in ("education", "marital"):
    FINAL[f"kpi_customers_by_{_c}"] = f"""
SELECT {_c}, count(*) AS "count" FROM dim_customer WHERE {_c} IS NOT NULL GROUP BY {_c}"""

FINAL["topk_l2"] = """
SELECT query_id, vec_id, CAST(rank AS INT) AS rank, CAST(round(CAST(CAST(distance AS VARCHAR) AS DECIMAL(38, 14)), 6) AS DOUBLE) AS distance,
  CAST(round(CAST(CAST(confidence AS VARCHAR) AS DECIMAL(38, 14)), 6) AS DOUBLE) AS confidence FROM retrieval_hits"""
FINAL["topk_l2_all"] = """
SELECT query_id, vec_id, CAST(rank AS INT) AS rank,
  CAST(round(CAST(CAST(distance AS VARCHAR) AS DECIMAL(38, 14)), 6) AS DOUBLE) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, e.vec_id,
      list_sum(list_transform(list_zip(e.embedding, q.embedding),
        lambda x: pow(CAST(x[1] AS DOUBLE) - CAST(x[2] AS DOUBLE), 2))) AS distance
    FROM embeddings q, embeddings e))
WHERE rank <= 5"""
FINAL["retrieval_log"] = """
SELECT query_id, string_agg(CAST(vec_id AS VARCHAR), ', ' ORDER BY rank) AS retrieved_ids,
  string_agg(printf('%.4f', confidence), ', ' ORDER BY rank) AS confidence_scores,
  CAST(count(*) AS INT) AS num_chunks_retrieved FROM retrieval_hits GROUP BY query_id"""
FINAL["retrieval_answer"] = """
SELECT h.query_id, 'Which policies resemble ' || h.query_id || '?' AS question,
  ['specific_lookup','comparative','filter_based','deductible_inquiry','coverage_tier']
    [CAST(h.query_id % 5 AS INT) + 1] AS query_type,
  string_agg(CAST(h.policy_number AS VARCHAR), ', ' ORDER BY rank) AS retrieved_policy_ids,
  string_agg(printf('%.4f', confidence), ', ' ORDER BY rank) AS confidence_scores,
  CAST(count(*) AS INT) AS num_chunks_retrieved, 'counts' AS embedding_model,
  string_agg('[Policy ' || h.policy_number || ']: ' || document, chr(10) || chr(10) ORDER BY rank)
    AS answer, 'success' AS generation_status, 'template' AS model_name
FROM policy_hits h JOIN policy_docs d ON h.policy_number = d.policy_number GROUP BY h.query_id"""
FINAL["doc_text"] = "SELECT policy_number, document FROM policy_docs"
FINAL["lookup_by_number"] = "SELECT * FROM dim_policy WHERE policy_number = 804"
FINAL["top_premium"] = """
SELECT policy_number, policy_csl_tier, policy_state, policy_annual_premium FROM dim_policy
ORDER BY policy_annual_premium DESC, policy_number LIMIT 5"""
FINAL["umbrella_by_state"] = """
SELECT policy_number, policy_state, umbrella_limit FROM dim_policy
WHERE policy_state = 'STATE_3' AND umbrella_limit > 0"""
FINAL["by_deductible"] = """
SELECT policy_number, policy_deductable, policy_csl_tier FROM dim_policy
WHERE policy_deductable = 2000"""
FINAL["tier_by_state"] = """
SELECT policy_state, count(*) AS policies FROM dim_policy WHERE policy_csl_tier = 'High'
GROUP BY policy_state"""

FINAL["ingest_stream"] = "SELECT * FROM customers_typed"
FINAL["ingest_rescued"] = """
SELECT src AS table_name, count(*) AS row_count, count(CustomerID) AS declared_ids,
  count(COALESCE(Customer_ID, cust_id)) AS rescued_ids, count(Job) AS rescued_jobs
FROM customers_raw GROUP BY src"""
FINAL["ingest_json"] = "SELECT * EXCLUDE (_source_file) FROM claims_typed"
FINAL["ingest_batch_typed"] = """
SELECT CAST(car_id AS INT) AS car_id, name, CAST(km_driven AS INT) AS km_driven, fuel, transmission,
  mileage, engine, max_power, torque, CAST(seats AS INT) AS seats, model FROM cars_raw"""
FINAL["publish_table"] = "SELECT * FROM dim_policy"
FINAL["publish_after_failure"] = FINAL["publish_table"]
FINAL["ingest_evolving"] = "\nUNION ALL ".join(
    f"SELECT '{column}' AS column_name, '{kind}' AS data_type, {types} AS types, "
    f"{since} AS since_batch, count({column}) AS value_count FROM policy_raw "
    f"WHERE COALESCE(policy_number, 0) % 3 >= {since}"
    for column, kind, types, since in (
        ("policy_number", "bigint", 1, 0), ("policy_annual_premium", "double", 2, 0),
        ("policy_csl", "string", 1, 0), ("umbrella_limit", "bigint", 1, 1),
        ("policy_state", "string", 1, 2)))

_PIPELINE = {
    "dim_date": "SELECT 4018",
    **{t: f"SELECT count(*) FROM {t}_clean" for t in
       ("customers", "claims", "policy", "sales", "cars")},
    **{f"{t}_failed": f"SELECT count(*) FROM {t}_failed" for t in
       ("customers", "claims", "policy", "sales", "cars")},
    **{t: f"SELECT count(*) FROM {t}" for t in
       ("dim_customer", "dim_policy", "dim_car", "fact_claims", "fact_sales")},
    "agg_claim_rejection_by_policy_region":
        "SELECT count(*) FROM (SELECT DISTINCT policy_csl, policy_csl_tier, region FROM fact_claims)",
    "agg_claim_severity_breakdown":
        "SELECT count(*) FROM (SELECT DISTINCT incident_severity FROM fact_claims)",
    "agg_customer_count_by_region": "SELECT count(*) FROM (SELECT DISTINCT region FROM dim_customer)",
    "agg_unsold_inventory_by_model_region":
        "SELECT count(*) FROM (SELECT DISTINCT car_model, region FROM fact_sales WHERE is_sold = 0)",
    "agg_policy_premium_by_coverage_tier":
        "SELECT count(*) FROM (SELECT DISTINCT policy_csl FROM dim_policy)",
}
FINAL["stored_pipeline"] = "\nUNION ALL ".join(
    f"SELECT '{name}' AS table_name, ({count}) AS row_count" for name, count in _PIPELINE.items())


def _half_up(value: str, digits: int) -> str:
    return f"round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 14)), {digits})"


_P, _C, _K = "policy_portfolio", "claims_performance", "customer_profile"
_REJECTED = "CAST(sum(is_rejected) AS DOUBLE) * 100.0 / count(*)"
_PREMIUMS = "CAST(sum(CAST(policy_annual_premium AS DECIMAL(20, 4))) AS DOUBLE)"
_CLAIMED = "CAST(sum(CAST(total_claim_amount AS DECIMAL(20, 4))) AS DOUBLE)"


def _figures(domain: str, section: str, source: str, member: str | None, **measures: str) -> str:
    """Rows (domain, section, member, measure, value) of one section: one per group and measure."""
    columns = ", ".join(f"CAST({sql} AS DOUBLE) AS m{i}" for i, sql in enumerate(measures.values()))
    grouped = f"SELECT {member or 'NULL'} AS g, {columns} FROM {source}" + (
        f" GROUP BY {member}" if member else "")
    return "\nUNION ALL ".join(
        f"SELECT '{domain}' AS domain_name, '{section}' AS section, CAST(g AS VARCHAR) AS member, "
        f"'{name}' AS measure, m{i} AS value FROM ({grouped}) t"
        for i, name in enumerate(measures))


_N = {"count": "count(*)"}
_RATE_1 = _half_up(_REJECTED, 1)
_BALANCE = _half_up("CAST(sum(balance) AS DOUBLE) / count(balance)", 2)
_KNOWN = "(SELECT * FROM {0} WHERE {1} IS NOT NULL) s"
FINAL["kpi_document_figures"] = "\nUNION ALL ".join([
    _figures(_P, "total_policies", "dim_policy", None, value="count(*)"),
    _figures(_P, "by_tier", "dim_policy", "policy_csl_tier", **_N,
             avg_premium=_half_up(f"{_PREMIUMS} / count(*)", 2),
             total_revenue=_half_up(_PREMIUMS, 2)),
    _figures(_P, "by_state", "dim_policy", "policy_state", **_N),
    _figures(_P, "umbrella", "dim_policy", None, with_umbrella="count_if(umbrella_limit > 0)",
             without_umbrella="count_if(umbrella_limit = 0)",
             avg_umbrella_amount="round(avg(CASE WHEN umbrella_limit > 0 THEN umbrella_limit END))"),
    _figures(_P, "by_deductible", "dim_policy", "policy_deductable", **_N),
    _figures(_C, "total_claims", "fact_claims", None, value="count(*)"),
    _figures(_C, "overall", "fact_claims", None, total_rejected="sum(is_rejected)",
             total_approved="count(*) - sum(is_rejected)", rejection_rate_pct=_RATE_1,
             total_exposure=_half_up(_CLAIMED, 2),
             avg_claim_amount=_half_up(f"{_CLAIMED} / count(*)", 2)),
    _figures(_C, "by_severity", "fact_claims", "incident_severity", **_N,
             rejected="sum(is_rejected)", avg_amount=_half_up(f"{_CLAIMED} / count(*)", 2)),
    _figures(_C, "by_region", _KNOWN.format("fact_claims", "region"), "region", **_N,
             rejected="sum(is_rejected)", rejection_rate=_RATE_1,
             total_exposure=_half_up(_CLAIMED, 2)),
    _figures(_C, "by_coverage_tier", _KNOWN.format("fact_claims", "policy_csl_tier"),
             "policy_csl_tier", **_N, rejection_rate=_RATE_1),
    _figures(_K, "total_customers", "dim_customer", None, value="count(*)"),
    _figures(_K, "by_region", "dim_customer", "region", **_N, avg_balance=_BALANCE),
    _figures(_K, "risk_indicators", "dim_customer", None,
             customers_with_default="sum(default_flag)",
             customers_with_hh_insurance="sum(hh_insurance)",
             customers_with_car_loan="sum(car_loan)", avg_balance=_BALANCE),
    _figures(_K, "by_education", _KNOWN.format("dim_customer", "education"), "education", **_N),
    _figures(_K, "by_marital", _KNOWN.format("dim_customer", "marital"), "marital", **_N),
])

FINAL["split_counts"] = FINAL["rule_counts"]
FINAL["dedup_incremental"] = FINAL["dedup_priority"]
for _t in ("rejection_by_tier_region", "severity", "customers_by_region", "unsold_aging",
           "premium_by_tier"):
    FINAL[f"incremental_{_t}"] = FINAL[f"rollup_{_t}"]
FINAL["landing_to_gold"] = FINAL["rollup_rejection_by_tier_region"]
FINAL["ingest_batch_tables"] = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}_raw"
    for t in ("policy", "cars", "claims"))
FINAL["issue_preview"] = f"""
SELECT issue_id, table_name, column_name, severity, affected_records, ai_explanation,
  generation_status FROM ({FINAL["issue_report"]}) ORDER BY issue_id LIMIT 3"""

FINAL["scored_view"] = """
SELECT incident_severity, count(*) AS high_claims, max(anomaly_score) AS max_score
FROM tiered WHERE priority_tier = 'HIGH' GROUP BY incident_severity"""


# ----------------------------------------------------------------- landing with the defaults
def _arrived(table: str, source: str, key: str, rescued: str = "0") -> str:
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, count({key}) AS keyed_rows, "
            f"count(DISTINCT {key}) AS distinct_keys, CAST({rescued} AS BIGINT) AS rescued_rows "
            f"FROM {source}")


FINAL["ingest_defaults"] = "\nUNION ALL ".join([
    _arrived("customers", "customers_raw", "COALESCE(CustomerID, Customer_ID, cust_id)"),
    _arrived("claims", "claims_raw", "ClaimID"),
    _arrived("policy", "policy_raw", "policy_number", "count_if(policy_number % 97 = 0)"),
    _arrived("sales", "sales_raw", "sales_id"),
    _arrived("cars", "cars_raw", "car_id")])


# ------------------------------------------------------------------ documentation of columns
_COLUMN_TYPES = {
    "dim_policy": "policy_number bigint, policy_bind_date date, policy_state string, "
                  "policy_csl string, policy_csl_tier string, policy_deductable int, "
                  "policy_annual_premium double, umbrella_limit int, car_id bigint, "
                  "customer_id bigint",
    "dim_customer": "customer_id bigint, region string, state string, city string, job string, "
                    "marital string, education string, default_flag int, balance int, "
                    "hh_insurance int, car_loan int",
    "fact_claims": "claim_id bigint, policy_id bigint, customer_id bigint, policy_csl string, "
                   "policy_csl_tier string, policy_deductable int, policy_annual_premium double, "
                   "region string, state string, incident_severity string, "
                   "incident_type string, collision_type string, incident_state string, "
                   "incident_city string, authorities_contacted string, "
                   "property_damage string, police_report_available string, "
                   "claim_rejected string, is_rejected int, injury_amount double, "
                   "property_amount double, vehicle_amount double, total_claim_amount double, "
                   "number_of_vehicles_involved int, bodily_injuries int, witnesses int",
}


def _documented() -> str:
    from tablewright.plans.pipeline import COLUMN_COMMENTS

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    rows = []
    for table, columns in _COLUMN_TYPES.items():
        for column in columns.split(", "):
            name, kind = column.split(" ")
            rows.append(f"({text(table)}, {text(name)}, {text(kind)}, "
                        f"{text(COLUMN_COMMENTS[table][name])})")
    return (f"SELECT * FROM (VALUES {', '.join(rows)}) "
            "AS t(table_name, col_name, data_type, \"comment\")")


FINAL["publish_metadata"] = _documented()
