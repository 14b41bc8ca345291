"""Raw insurance-style tables derived from the driver's star-schema tables.

The operators need inputs with drifting column names, swapped columns, sentinel texts, blank
rows, broken dates and repeated keys. Each function below turns whole driver tables into one
such raw table by deterministic expressions, in one scan of the large table (the nation table,
25 rows, is the only join and Spark broadcasts it by its size). As in the landing files, all
measures and flags are text; keys keep their integer type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixed_values import DATE_FORMAT, MINUTE_FORMAT, SOURCE_FILE

# Reference day in place of today, so that ages do not drift between runs.
AS_OF = "2002-01-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(*pairs: tuple[str, object], otherwise: object = None) -> Column:
    chain = F
    for condition, value in pairs:
        chain = chain.when(F.expr(condition), value)
    return chain.otherwise(otherwise)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven source files under seven header variants, stacked by column name.

    Every customer is in at most one regional file and, but for one residue class, in the
    master file. The copies come from an explode over the source names, not from a union of
    seven scans.
    """
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    person = read(spark, sf_dir, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").alias("k"),
        F.col("n_name").alias("st"),
        F.col("c_mktsegment").alias("job"),
        _cases(("c_custkey % 97 = 5", "Nowhere"), ("c_custkey % 101 = 7", None),
               ("n_regionkey = 0", "East"), ("n_regionkey = 1", "West"),
               ("n_regionkey = 2", "Central"), ("n_regionkey = 3", "South"),
               otherwise="North").alias("region"),
        _cases(("c_custkey % 89 = 3", "widowed"), ("c_custkey % 4 = 0", "single"),
               ("c_custkey % 4 = 1", "married"), ("c_custkey % 4 = 2", "divorced")
               ).alias("marital"),
        _cases(("c_custkey % 5 = 0", "primary"), ("c_custkey % 5 = 1", "secondary"),
               ("c_custkey % 5 = 2", "tertiary"), ("c_custkey % 5 = 3", "NA")
               ).alias("education"),
        F.floor("c_acctbal").cast("int").cast("string").alias("balance"),
        _cases(("c_custkey % 10 = 0", "1"), otherwise="0").alias("dflt"),
        (F.col("c_custkey") % 2).cast("string").alias("hh"),
        _cases(("c_custkey % 3 = 0", "1"), otherwise="0").alias("loan"),
    )
    regional = F.when(F.expr("k % 7 < 6"),
                      F.concat(F.lit("customers_"), (F.expr("k % 7") + 1).cast("string")))
    master = F.when(F.expr("k % 7 <> 4"), F.lit("customers_7"))
    copies = person.withColumn("src", F.explode(F.array_compact(F.array(regional, master))))

    def only(column: str | Column, *files: int) -> Column:
        value = F.col(column) if isinstance(column, str) else column
        return F.when(F.col("src").isin([f"customers_{n}" for n in files]), value)

    abbreviated = F.coalesce(
        F.create_map(*[F.lit(x) for x in ("East", "E", "West", "W", "Central", "C",
                                          "South", "S")])[F.col("region")], F.col("region"))
    misspelt = F.when(F.col("education") == "tertiary", "terto").otherwise(F.col("education"))
    return copies.select(
        F.col("src").alias(SOURCE_FILE),
        only("k", 1, 4, 5, 6, 7).alias("CustomerID"),
        only("k", 2).alias("Customer_ID"),
        only("k", 3).alias("cust_id"),
        F.coalesce(only(abbreviated, 5), only("region", 2, 3, 4, 6, 7)).alias("Region"),
        only("region", 1).alias("Reg"),
        F.col("st").alias("State"),
        only("st", 1, 3, 4, 5, 6, 7).alias("City"),
        only("st", 2).alias("City_in_state"),
        only("job", 2, 3, 4, 5, 6, 7).alias("Job"),
        only("marital", 3, 4, 5, 7).alias("Marital"),
        F.coalesce(only("marital", 1), only("education", 6)).alias("Marital_status"),
        F.coalesce(only("education", 1, 3, 7), only(misspelt, 5), only("marital", 6))
        .alias("Education"),
        only("education", 2).alias("Edu"),
        F.col("dflt").alias("Default"),
        F.col("balance").alias("Balance"),
        only("hh", 1, 3, 4, 5, 6, 7).alias("HHInsurance"),
        F.col("loan").alias("CarLoan"),
    )


def policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        _cases(("o_orderkey % 211 = 9", None), otherwise=F.col("o_orderkey"))
        .alias("policy_number"),
        F.date_format("o_orderdate", DATE_FORMAT).alias("policy_bind_date"),
        F.concat(F.lit("STATE_"), F.expr("o_custkey % 9").cast("string"))
        .alias("policy_state"),
        _cases(("o_orderkey % 4 = 0", "100/300"), ("o_orderkey % 4 = 1", "250/500"),
               ("o_orderkey % 4 = 2", "500/1000"), otherwise="300/300").alias("policy_csl"),
        _cases(("o_orderkey % 3 = 0", "500"), ("o_orderkey % 3 = 1", "1000"),
               otherwise="2000").alias("policy_deductable"),
        _cases(("o_orderkey % 307 = 11", "0"),
               otherwise=(F.col("o_totalprice") / 100).cast("string"))
        .alias("policy_annual_premium"),
        _cases(("o_orderkey % 401 = 13", "-1000000"), ("o_orderkey % 5 = 0", "5000000"),
               ("o_orderkey % 499 = 21", None), otherwise="0").alias("umbrella_limit"),
        _cases(("o_orderkey % 503 = 17", None), ("o_orderkey % 509 = 23", F.lit(100000000)),
               otherwise=F.col("o_orderkey") % 200).alias("car_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit("policy").alias(SOURCE_FILE),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    def whole(expression: str) -> Column:
        return F.floor(F.expr(expression)).cast("bigint").cast("string")

    def fraction(expression: str, tail: str) -> Column:
        return F.concat(F.expr(expression).cast("string"), F.lit(tail))

    return read(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("ClaimID"),
        _cases(("l_partkey % 101 = 0", F.expr("l_orderkey + 100000000")),
               otherwise=F.col("l_orderkey")).alias("PolicyID"),
        F.concat(F.lit("STATE_"), F.expr("l_suppkey % 9").cast("string"))
        .alias("incident_state"),
        F.concat(F.lit("CITY_"), F.expr("l_suppkey % 25").cast("string"))
        .alias("incident_city"),
        F.concat(F.col("l_partkey").cast("string"), F.lit(" Main St"))
        .alias("incident_location"),
        _cases(("l_linenumber % 2 = 0", "Single Vehicle Collision"),
               otherwise="Multi-vehicle Collision").alias("incident_type"),
        _cases(("l_suppkey % 4 = 0", "Rear Collision"), ("l_suppkey % 4 = 1", "Side Collision"),
               ("l_suppkey % 4 = 2", "Front Collision"), otherwise="?")
        .alias("collision_type"),
        _cases(("l_returnflag = 'A'", "Minor Damage"), ("l_returnflag = 'N'", "Major Damage"),
               otherwise="Trivial Damage").alias("incident_severity"),
        _cases(("l_quantity < 10", "Police"), ("l_quantity < 20", "Fire"),
               ("l_quantity < 30", "Ambulance"), ("l_quantity < 40", "Other"),
               otherwise="None").alias("authorities_contacted"),
        _cases(("l_partkey % 89 = 2", "NULL"),
               otherwise=F.col("l_extendedprice").cast("string")).alias("injury"),
        _cases(("l_partkey % 83 = 4", ""), otherwise=whole("l_extendedprice * l_discount"))
        .alias("property"),
        _cases(("l_partkey % 29 = 0", "NULL"), otherwise=whole("l_extendedprice * l_tax"))
        .alias("vehicle"),
        F.expr("1 + l_linenumber % 4").cast("string").alias("number_of_vehicles_involved"),
        _cases(("l_partkey % 3 = 0", "YES"), ("l_partkey % 3 = 1", "NO"), otherwise="?")
        .alias("property_damage"),
        _cases(("l_orderkey % 3 = 0", "YES"), ("l_orderkey % 3 = 1", "NO"), otherwise="?")
        .alias("police_report_available"),
        F.expr("l_linenumber % 3").cast("string").alias("bodily_injuries"),
        F.expr("l_suppkey % 4").cast("string").alias("witnesses"),
        _cases(("l_partkey % 61 = 1", "?"), ("l_partkey % 67 = 1", None),
               ("l_linestatus = 'F'", "Y"), otherwise="N").alias("Claim_Rejected"),
        _cases(("l_linestatus = 'O'", "NULL"), otherwise=fraction("l_suppkey % 60", ":30.0"))
        .alias("Claim_Processed_On"),
        fraction("l_orderkey % 60", ":00.0").alias("incident_date"),
        _cases(("l_partkey % 97 = 9", None), otherwise=fraction("l_partkey % 60", ":00.0"))
        .alias("Claim_Logged_On"),
        F.concat(F.lit("claims_"), F.expr("1 + l_orderkey % 2").cast("string"))
        .alias(SOURCE_FILE),
    )


SALES_COLUMNS = ["sales_id", "ad_placed_on", "sold_on", "original_selling_price", "Region",
                 "State", "City", "seller_type", "owner", "car_id"]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three files; some rows blank, some listings in two files, some dates broken."""
    home = F.concat(F.lit("sales_"), _cases(("o_orderkey % 3 = 0", "1"),
                                            ("o_orderkey % 3 = 1", "2"), otherwise="4"))
    again = F.when(F.expr("o_orderkey % 59 = 0"),
                   F.struct(F.lit("sales_4").alias("src"), F.lit(0).alias("blank")))
    first = F.struct(home.alias("src"),
                     F.expr("CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END").alias("blank"))
    copies = read(spark, sf_dir, "orders").withColumn(
        "copy", F.explode(F.array_compact(F.array(first, again))))
    there = F.col("copy.blank") == 0
    return copies.select(
        F.when(there, F.col("o_orderkey").cast("string")).alias("sales_id"),
        F.when(there, F.when(F.expr("o_orderkey % 71 = 5"), F.lit("27:00.0"))
               .otherwise(F.date_format("o_orderdate", MINUTE_FORMAT))).alias("ad_placed_on"),
        F.when(there & (F.col("o_orderstatus") != "O"),
               F.date_format(F.expr("o_orderdate + INTERVAL '10' DAY"), MINUTE_FORMAT))
        .alias("sold_on"),
        F.when(there, F.col("o_totalprice").cast("string")).alias("original_selling_price"),
        F.when(there, F.col("o_orderpriority")).alias("Region"),
        F.when(there, F.concat(F.lit("STATE_"), F.expr("o_custkey % 9").cast("string")))
        .alias("State"),
        F.when(there, F.concat(F.lit("CITY_"), F.expr("o_custkey % 25").cast("string")))
        .alias("City"),
        F.when(there, _cases(("o_custkey % 2 = 0", "Dealer"), otherwise="Individual"))
        .alias("seller_type"),
        F.when(there & F.expr("o_orderkey % 73 <> 4"),
               _cases(("o_custkey % 3 = 0", "First Owner"), otherwise="Second Owner"))
        .alias("owner"),
        F.when(there, _cases(("o_orderkey % 67 = 3", None),
                             ("o_orderkey % 509 = 23", F.lit(100000000)),
                             otherwise=F.col("o_orderkey") % 200)).alias("car_id"),
        F.col("copy.src").alias(SOURCE_FILE),
    )


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("car_id"),
        F.col("p_name").alias("name"),
        F.expr("1000 + p_partkey * 7 % 90000").cast("string").alias("km_driven"),
        F.col("p_type").alias("fuel"),
        _cases(("p_partkey % 2 = 0", "Manual"), otherwise="Automatic").alias("transmission"),
        _cases(("p_partkey % 73 = 0", "n/a"),
               otherwise=F.concat(size.cast("string"), F.lit(".5 kmpl"))).alias("mileage"),
        F.concat((size * 20 + 800).cast("string"), F.lit(" CC")).alias("engine"),
        F.concat((size + 60).cast("string"), F.lit(" bhp")).alias("max_power"),
        F.concat((size + 100).cast("string"), F.lit("Nm@ 2000rpm")).alias("torque"),
        _cases(("p_partkey % 83 = 5", "0"), ("p_partkey % 79 = 6", None),
               otherwise=F.expr("4 + p_partkey % 4").cast("string")).alias("seats"),
        F.col("p_brand").alias("model"),
        F.lit("cars").alias(SOURCE_FILE),
    )
