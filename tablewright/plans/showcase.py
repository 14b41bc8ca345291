"""Queries that exercise operators with side effects or caller-supplied functions.

Files and tables they write are derived from whole driver tables and go to the shared folder
of the session.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..functions.cleaning import matches
from ..operators import discover, enrich, incremental, quality, retrieve
from ..session import shared_folder
from ..sources import files, tables
from ..streaming import ingest
from . import fixed_values as fixed
from . import increments, kpi, profiling, raw, retrieval, scoring, silver
from .layers import Layers

# Rows of a compressed landing file: one task reads such a file as a whole.
LANDED_ROWS = 15_000
# Files named with brackets, which Spark's file stream lists once for every file of their batch.
BRACKETED = 8


def _land(df: DataFrame, file_format: str, folder: str) -> None:
    """Write compressed landing files of bounded length."""
    df.write.format(file_format).option("header", "true").option("compression", "gzip") \
        .option("maxRecordsPerFile", LANDED_ROWS).save(folder)


def land_customers(customers: DataFrame, root: str) -> None:
    """Write the stacked customers back as CSV files, each source under its own header."""
    for depth, (source, columns) in enumerate(fixed.CUSTOMER_HEADERS.items()):
        folder = f"{root}/unit {depth}/{source}" if depth else f"{root}/{source}"
        customers.where(F.col(fixed.SOURCE_FILE) == source).select(*columns, *fixed.CUSTOMER_COMMON) \
            .write.option("header", "true").csv(folder)


def _named_by_folder(df: DataFrame) -> DataFrame:
    name = F.regexp_extract(F.col(fixed.SOURCE_FILE), r"(customers_\d)/", 1)
    return df.withColumn(fixed.SOURCE_FILE, name)


def ingest_stream(layers: Layers) -> DataFrame:
    """Land seven header variants, ingest them incrementally, harmonize what was stored."""
    spark = layers.spark
    base = shared_folder(spark, "ingest-stream")
    land_customers(layers.raw("customers"), f"{base}/landing")
    ingest.ingest(spark, f"{base}/landing", "*.csv", f"{base}/table", f"{base}/checkpoint")
    typed = silver.harmonized_customers(_named_by_folder(ingest.stored(spark, f"{base}/table")))
    return typed.withColumn("customer_id", F.col("customer_id").cast("bigint")).drop(
        fixed.LOAD_TIMESTAMP)


def ingest_rescued(layers: Layers) -> DataFrame:
    """Ingest the same files under a narrow declared schema; count what went to the rescue."""
    spark = layers.spark
    base = shared_folder(spark, "ingest-rescued")
    declared = ["CustomerID", "Region", "State", "Balance"]
    land_customers(layers.raw("customers"), f"{base}/landing")
    ingest.ingest(spark, f"{base}/landing", "*.csv", f"{base}/table", f"{base}/checkpoint",
                  declared=declared)
    stored = _named_by_folder(ingest.stored(spark, f"{base}/table", declared))
    rescued = F.from_json(fixed.RESCUED, "map<string,string>")
    return stored.groupBy(F.col(fixed.SOURCE_FILE).alias("table_name")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("CustomerID").alias("declared_ids"),
        F.count(F.coalesce(rescued["Customer_ID"], rescued["cust_id"])).alias("rescued_ids"),
        F.count(rescued["Job"]).alias("rescued_jobs"))


def ingest_evolving(layers: Layers) -> DataFrame:
    """Ingest policies in three waves, each with a column more and wider values than the last; what
    the schema log tells of each column, and how many values the typed table has in it."""
    spark = layers.spark
    base = shared_folder(spark, "ingest-evolving")
    raw_policy = layers.raw("policy").withColumn(
        "wave", F.coalesce(F.col("policy_number"), F.lit(0)) % 3)
    columns = ["policy_number", "policy_annual_premium", "policy_csl"]
    for wave, more in enumerate(([], ["umbrella_limit"], ["umbrella_limit", "policy_state"])):
        rows = raw_policy.where(F.col("wave") == wave)
        if wave == 0:
            rows = rows.withColumn("policy_annual_premium",
                                   F.floor("policy_annual_premium").cast("bigint"))
        rows.select(*more, *columns).write.option("header", "true").csv(f"{base}/in/{wave}")
        ingest.ingest(spark, f"{base}/in", "*.csv", f"{base}/table", f"{base}/checkpoint",
                      infer_types=True)
    table = ingest.stored(spark, f"{base}/table", typed=True)
    history = ingest.schema_history(spark, f"{base}/table")
    newest = history.groupBy("column_name").agg(
        F.max_by("data_type", "version").alias("data_type"),
        F.count_distinct("data_type").cast("int").alias("types"),
        F.min("since_batch").cast("int").alias("since_batch"))
    names = [*columns, "umbrella_limit", "policy_state"]
    counted = table.agg(*[F.count(c).alias(c) for c in names]).unpivot(
        [], names, "column_name", "value_count")
    return newest.join(counted, "column_name")


def ingest_json(layers: Layers) -> DataFrame:
    """Write the raw claims as JSON lines, read them back as text, clean them."""
    spark = layers.spark
    base = shared_folder(spark, "ingest-json")
    _land(layers.raw("claims").drop(fixed.SOURCE_FILE), "json", f"{base}/claims")
    back = files.read_json_text(spark, f"{base}/claims", glob="*.json.gz")
    typed = silver.claims(back).drop(fixed.SOURCE_FILE, fixed.LOAD_TIMESTAMP)
    return typed.withColumns({c: F.col(c).cast("bigint") for c in ("claim_id", "policy_id")})


def landing_to_gold(layers: Layers) -> DataFrame:
    """Landing files of all five sources to the published rejection rollup."""
    from . import bronze, pipeline

    spark = layers.spark
    base = shared_folder(spark, "landing")
    land_customers(layers.raw("customers"), f"{base}/in/customers")
    _land(layers.raw("claims").drop(fixed.SOURCE_FILE), "json", f"{base}/in/claims")
    for table in ("policy", "sales", "cars"):
        _land(layers.raw(table).drop(fixed.SOURCE_FILE), "csv", f"{base}/in/{table}")
    tables_in = bronze.ingest_all(
        spark, {t: f"{base}/in/{t}" for t in bronze.DECLARED}, f"{base}/bronze",
        globs={t: "*.json.gz" if t == "claims" else "*.csv*" for t in bronze.DECLARED},
        formats={**bronze.FORMATS, "claims": "jsonl"})
    schema = f"gold_{uuid.uuid4().hex[:8]}"
    pipeline.run(spark, tables_in, schema, f"{base}/tables", layers.as_of)
    return spark.table(f"{schema}.agg_claim_rejection_by_policy_region")


def _rename_parts(spark: SparkSession, folder: str, name: str, later: str | None = None) -> None:
    """Give the data files of a written folder a landing name; `{n}` in it is their number. Files
    after the first BRACKETED ones are named by `later`, if given."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    system = jvm_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted(status.getPath().getName() for status in system.listStatus(jvm_path(folder))
                   if status.getPath().getName().startswith("part-"))
    for n, part in enumerate(parts):
        given = later if later and n >= BRACKETED else name
        target = jvm_path(f"{folder}/{given.replace('{n}', str(n))}")
        if "/" in given:
            system.mkdirs(target.getParent())
        system.rename(jvm_path(f"{folder}/{part}"), target)


def _write_raw_csv(df: DataFrame, columns: list[str], folder: str, extra: str) -> None:
    """CSV files in which each record has one value more than the header has names."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    lines = df.select(F.concat_ws(",", *values, F.lit(extra)).alias(",".join(columns)))
    # One column, whose name is the header; with another separator commas are plain text.
    lines.write.option("header", "true").option("sep", "\u0001").csv(folder)


def ingest_defaults(layers: Layers) -> DataFrame:
    """Land all five sources under their own names, ingest them with the default globs and
    formats, and count what arrived: rows, keys, rows with rescued data.

    Among the files are four layouts of JSON, compressed under their plain names, over-long records,
    a header of more than 64 KiB and names with brackets.
    """
    from . import bronze

    spark = layers.spark
    base = shared_folder(spark, "ingest-defaults")
    land = f"{base}/landing"

    customers = layers.raw("customers")
    for source, columns in fixed.CUSTOMER_HEADERS.items():
        folder = f"{land}/{source}"
        rows = customers.where(F.col(fixed.SOURCE_FILE) == source).select(
            *columns, *fixed.CUSTOMER_COMMON)
        if source == "customers_2":
            rows = rows.withColumns({f"{'wide' * 750}_{i}": F.lit("") for i in range(30)})
        rows.write.option("header", "true").csv(folder)
        _rename_parts(spark, folder, f"{source}-{{n}}.csv")

    claims = layers.raw("claims").drop(fixed.SOURCE_FILE)
    # One object per line, an array per line, pretty-printed, and all objects on one line.
    rows = claims.select("ClaimID", F.struct("*").alias("row"))
    layouts = {
        "claims_{n}.json": F.to_json("row"),
        "claims_[{n}].json": F.concat(F.lit("["), F.to_json("row"), F.lit("]")),
        "claims_long_{n}.json": F.to_json("row", {"pretty": "true"}),
        "claims_wide_{n}.json": F.to_json("row")}
    for part, (name, value) in enumerate(layouts.items()):
        folder = f"{land}/layout_{part}"
        rows.where(F.col("ClaimID") % len(layouts) == part).select(value).write.option(
            "lineSep", " " if "wide" in name else "\n").option("compression", "gzip").option(
            "maxRecordsPerFile", LANDED_ROWS).text(folder)
        _rename_parts(spark, folder, name, name.replace("[{n}]", "list_{n}"))

    policy = layers.raw("policy").drop(fixed.SOURCE_FILE)
    overlong = F.coalesce(F.col("policy_number") % 97 == 0, F.lit(False))
    policy.where(~overlong).write.option("header", "true").csv(f"{land}/policy")
    _rename_parts(spark, f"{land}/policy", "{n}/policy.csv")
    _write_raw_csv(policy.where(overlong), policy.columns, f"{land}/overlong", "beyond")
    _rename_parts(spark, f"{land}/overlong", "{n}/policy.csv")

    sales = layers.raw("sales")
    for source, name in (("sales_1", "sales_1-{n}.csv"), ("sales_2", "Sales_[2]-{n}.csv"),
                         ("sales_4", "new sales_4-{n}.csv")):
        sales.where(F.col(fixed.SOURCE_FILE) == source).drop(fixed.SOURCE_FILE).write.option(
            "header", "true").csv(f"{land}/{source}")
        _rename_parts(spark, f"{land}/{source}", name)
    layers.raw("cars").drop(fixed.SOURCE_FILE).write.option("header", "true").csv(f"{land}/cars")
    _rename_parts(spark, f"{land}/cars", "{n}/cars.csv")

    schema = f"bronze_{uuid.uuid4().hex[:8]}"
    bronze.ingest_all(spark, land, f"{base}/bronze", schema=schema)
    tables_in = {table: spark.table(f"{schema}.{table}") for table in bronze.DECLARED}
    keys = {"customers": F.coalesce("CustomerID", "Customer_ID", "cust_id"),
            "claims": F.col("ClaimID"), "policy": F.col("policy_number"),
            "sales": F.col("sales_id"), "cars": F.col("car_id")}
    return reduce(DataFrame.unionByName, [
        tables_in[table].agg(
            F.count(F.lit(1)).alias("row_count"), F.count(key).alias("keyed_rows"),
            F.count_distinct(key).alias("distinct_keys"),
            F.count(fixed.RESCUED).alias("rescued_rows"),
        ).select(F.lit(table).alias("table_name"), "row_count", "keyed_rows", "distinct_keys",
                 "rescued_rows")
        for table, key in keys.items()])


def batch_tables(layers: Layers) -> DataFrame:
    """Load CSV and JSON files as tables with inferred types; count their rows."""
    from ..operators.profile import row_counts

    spark = layers.spark
    base = shared_folder(spark, "batch-tables")
    prefix = f"batch_{uuid.uuid4().hex[:8]}_"
    for table in ("policy", "cars"):
        _land(layers.raw(table).drop(fixed.SOURCE_FILE), "csv", f"{base}/in/{table}")
    _land(layers.raw("claims").drop(fixed.SOURCE_FILE), "json", f"{base}/in/claims")
    files.load_tables(spark, {t: f"{base}/in/{t}" for t in ("policy", "cars")}, prefix, base)
    files.load_json_table(spark, f"{prefix}claims", f"{base}/in/claims", base, False)
    return row_counts({t: spark.table(f"{prefix}{t}") for t in ("policy", "cars", "claims")})


def dedup_incremental(layers: Layers) -> DataFrame:
    """Customers in three batches that come out of order, the second one twice; the winners."""
    spark = layers.spark
    rows = silver.harmonized_customers(layers.raw("customers"))
    part = F.pmod(F.xxhash64(fixed.SOURCE_FILE, "state", "balance"), F.lit(3))
    runs = incremental.Runs(spark, shared_folder(spark, "winners"))
    winners = incremental.Winners(runs, "customer_id", silver.customer_order)
    for batch in (2, 0, 0, 1):
        winners.update(batch, rows.where(part == batch))
        if batch == 2:
            winners.compact()
    return winners.current()


def rollup_incremental(layers: Layers, name: str) -> DataFrame:
    """One rollup after three batches: each brings a third of the claims and listings, the master
    file comes last, so that customers change, and policies and cars come after rows that need them."""
    spark = layers.spark
    state = increments.IncrementalGold(spark, shared_folder(spark, "increments"), layers.as_of, (name,))

    def third(table: str, key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(table), key), F.lit(3))

    master = F.col(fixed.SOURCE_FILE).contains(fixed.MASTER_SOURCE)
    part = {"customers": F.when(master, 2).otherwise(F.pmod(F.xxhash64("Balance"), F.lit(2))),
            "claims": third("claims", "ClaimID"), "policy": third("policy", "policy_number"),
            "sales": third("sales", "sales_id"), "cars": third("cars", "car_id")}
    for batch in range(3):
        state.update(batch, {t: layers.raw(t).where(p == batch) for t, p in part.items()})
        if batch == 1:
            state.compact()
    state.update(0, {t: layers.raw(t) for t in part})        # taken in before: changes nothing
    return state.result(name)


def issue_preview(layers: Layers) -> DataFrame:
    """The first three rows of the issue report, as shown after it is written."""
    return issue_report(layers).select(
        "issue_id", "table_name", "column_name", "severity", "affected_records",
        "ai_explanation", "generation_status").orderBy("issue_id").limit(3)


def ingest_typed(layers: Layers) -> DataFrame:
    """Write the raw cars as CSV and read them back with inferred types."""
    base = shared_folder(layers.spark, "ingest-typed")
    layers.raw("cars").drop(fixed.SOURCE_FILE).write.option("header", "true").csv(base)
    return files.read_typed_csv(layers.spark, base).drop("ingestion_ts", "source_file")


def _publish(layers: Layers, name: str) -> str:
    from .pipeline import COLUMN_COMMENTS, COMMENTS

    table = f"{name}_{uuid.uuid4().hex[:8]}"
    spec = tables.TableSpec(table, COMMENTS[name], "gold", columns=COLUMN_COMMENTS[name])
    tables.publish(getattr(layers, name), spec, path=shared_folder(layers.spark, "publish"))
    return table


def publish_table(layers: Layers) -> DataFrame:
    """Publish the policy dimension and read the stored table."""
    return layers.spark.table(_publish(layers, "dim_policy"))


def publish_after_failure(layers: Layers) -> DataFrame:
    """Publish the policy dimension, then fail in the middle of replacing it; what is there after."""
    name = _publish(layers, "dim_policy")
    root = shared_folder(layers.spark, "publish")
    broken = layers.dim_policy.withColumn("policy_number", F.when(
        F.col("policy_number") % 2 == 0, F.raise_error(F.lit("lost"))).otherwise(
        F.col("policy_number")).cast("bigint"))
    try:
        tables.publish(broken, tables.TableSpec(name), path=root)
    except PySparkException:
        return layers.spark.table(name)
    raise RuntimeError("the write was to fail")


def publish_metadata(layers: Layers) -> DataFrame:
    """Publish the three main tables and show the documentation of their columns."""
    from .pipeline import COLUMN_COMMENTS

    parts = []
    for name, columns in COLUMN_COMMENTS.items():
        described = tables.table_description(layers.spark, _publish(layers, name))
        parts.append(described.where(F.col("col_name").isin(list(columns))).select(
            F.lit(name).alias("table_name"), "col_name", "data_type", "comment"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def scored_view(scored: DataFrame) -> DataFrame:
    """Scored claims as a session view, asked from SQL with a text predicate."""
    tables.as_view(scored, "scored_claims")
    return scored.sparkSession.sql(
        "SELECT incident_severity, count(*) AS high_claims, max(anomaly_score) AS max_score "
        "FROM scored_claims WHERE priority_tier = 'HIGH' GROUP BY incident_severity")


def split_once(layers: Layers) -> DataFrame:
    """Store the clean and the quarantined policies in one pass; report both and the reasons."""
    clean, failed = quality.write_split(
        layers.typed("policy"), silver.CHECKS["policy"],
        shared_folder(layers.spark, "split"))
    return clean.select(F.lit("clean").alias("part"), F.lit("").alias("reason")).unionByName(
        failed.select(F.lit("failed").alias("part"), F.col(quality.REASON).alias("reason"))
    ).groupBy("part", "reason").agg(F.count(F.lit(1)).alias("row_count"))


def split_counts(layers: Layers) -> DataFrame:
    """Store the halves of all five tables; the counts of every rule, taken by the same passes."""
    parts = []
    for table, checks in silver.CHECKS.items():
        counts = Observation()
        quality.write_split(layers.typed(table), checks, shared_folder(layers.spark, "split"), counts)
        parts.append(quality.observed_counts(layers.spark, counts, checks, table))
    return reduce(DataFrame.unionByName, parts)


def stored_pipeline(layers: Layers) -> DataFrame:
    """Build and publish every layer, then count what each published table holds."""
    from ..operators.profile import row_counts
    from . import pipeline

    spark = layers.spark
    schema = f"run_{uuid.uuid4().hex[:8]}"
    pipeline.run_on(spark, layers.sf_dir, schema, shared_folder(spark, "pipeline"))
    names = [*pipeline.SILVER, *[f"{t}_failed" for t in pipeline.SILVER],
             *[n for n in pipeline.COMMENTS
               if n.removesuffix("_failed") not in pipeline.SILVER]]
    return row_counts({n: spark.table(f"{schema}.{n}") for n in names})


def _members(section: Column, name: str, group: str) -> Column:
    """The rows of a document's list: section, group name, all other fields."""
    rows = F.from_json(section, "array<map<string,string>>")
    return F.transform(rows, lambda row: F.struct(
        F.lit(name).alias("section"), row[group].alias("member"),
        F.map_filter(row, lambda key, _: key != group).alias("values")))


def document_figures(layers: Layers) -> DataFrame:
    """Every figure of the KPI documents, read back out of them: domain, section, member of the
    section (its group's name, or none) and measure."""
    docs = kpi.documents(layers.dim_policy, layers.fact_claims, layers.dim_customer)
    objects = {"policy_portfolio": ["umbrella"], "claims_performance": ["overall"],
               "customer_profile": ["risk_indicators"]}
    totals = {"policy_portfolio": "total_policies", "claims_performance": "total_claims",
              "customer_profile": "total_customers"}
    lists = {"policy_portfolio": {"by_tier": "policy_csl_tier", "by_state": "policy_state",
                                  "by_deductible": "policy_deductable"},
             "claims_performance": {"by_severity": "incident_severity", "by_region": "region",
                                    "by_coverage_tier": "policy_csl_tier"},
             "customer_profile": {"by_region": "region", "by_education": "education",
                                  "by_marital": "marital"}}
    parts = []
    for domain in totals:
        doc = docs.where(F.col("domain_name") == domain).select(
            F.from_json("kpi_data_json", "map<string,string>").alias("sections"))
        entries = [F.array(F.struct(
            F.lit(totals[domain]).alias("section"), F.lit(None).cast("string").alias("member"),
            F.create_map(F.lit("value"), F.col("sections")[totals[domain]]).alias("values")))]
        for name in objects[domain]:
            entries.append(F.array(F.struct(
                F.lit(name).alias("section"), F.lit(None).cast("string").alias("member"),
                F.from_json(F.col("sections")[name], "map<string,string>").alias("values"))))
        for name, group in lists[domain].items():
            entries.append(_members(F.col("sections")[name], name, group))
        parts.append(doc.select(F.explode(F.concat(*entries)).alias("e")).select(
            F.lit(domain).alias("domain_name"), "e.section", "e.member",
            F.explode("e.values").alias("measure", "text")))
    return reduce(DataFrame.unionByName, parts).select(
        "domain_name", "section", "member", "measure", F.col("text").cast("double").alias("value"))


def email_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The address predicate on addresses built from customers, some of them malformed."""
    key = F.col("c_custkey").cast("string")
    email = (
        F.when(F.expr("c_custkey % 5 = 1"), F.concat(key, F.lit(".example.com")))
        .when(F.expr("c_custkey % 5 = 2"), F.lit(None))
        .when(F.expr("c_custkey % 5 = 3"), F.concat(F.lit("a b"), key, F.lit("@x.org")))
        .otherwise(F.concat(F.lit("user."), key, F.lit("@mail.example.com"))))
    return raw.read(spark, sf_dir, "customer").select("c_custkey", email.alias("email")).select(
        "c_custkey", "email", matches(F.col("email"), fixed.EMAIL_PATTERN).alias("is_valid"))


def text_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies as block arrays or as plain text, reduced to their text."""
    turns = raw.read(spark, sf_dir, "conversations")
    reasoning = F.struct(F.lit("reasoning").alias("type"), F.lit("...").alias("text"))
    content = F.struct(F.lit("text").alias("type"), F.col("text"))
    reply = F.when(F.col("role") == "assistant", F.to_json(F.array(reasoning, content))
                   ).otherwise(F.col("text"))
    return turns.select("conv_id", "turn", "role", text.block_text(reply).alias("extracted"))


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question vector per label of the embedding table: its first vector."""
    return raw.read(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("query_id")).agg(
        F.min_by("embedding", "vec_id").alias("embedding"))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.topk_l2(questions(spark, sf_dir), raw.read(spark, sf_dir, "embeddings"),
                            "query_id", "vec_id", "embedding", fixed.TOP_K)


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, sf_dir).select(
        "query_id", "vec_id", "rank", F.round("distance", 6).alias("distance"),
        F.round("confidence", 6).alias("confidence"))


def retrieval_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retrieve.retrieval_log(nearest(spark, sf_dir), "query_id", "vec_id",
                                  fixed.SCORE_FORMAT)


def quote_passages(prompt: str) -> str:
    """Generator without a model: answers with the passages it was given."""
    return prompt.split("Passages: ", 1)[1].rsplit(" Question: ", 1)[0]


# Characters whose counts make up a vector.
COUNTED = "0123456789aeinorst"


def character_counts(texts: list[str]) -> list[list[float]]:
    """Encoder without a model: how often each of a few characters occurs."""
    return [[float(text.count(c)) for c in COUNTED] for text in texts]


def nearest_to_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding asked against all of them."""
    vectors = raw.read(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieve.topk_l2(asked, vectors, "query_id", "vec_id", "embedding",
                            fixed.TOP_K).select(
        "query_id", "vec_id", "rank", F.round("distance", 6).alias("distance"))


def retrieval_answer(layers: Layers) -> DataFrame:
    """Questions answered over the documents of all policies."""
    spark, sf_dir = layers.spark, layers.sf_dir
    documents = retrieval.embed(retrieval.policy_documents(layers.dim_policy), "document",
                                character_counts)
    types = F.array(*map(F.lit, fixed.QUERY_TYPES))
    asked = retrieval.embed(questions(spark, sf_dir).select(
        "query_id",
        F.concat(F.lit("Which policies resemble "), F.col("query_id").cast("string"),
                 F.lit("?")).alias("question"),
        F.get(types, F.pmod("query_id", F.lit(len(fixed.QUERY_TYPES))).cast("int"))
        .alias("query_type")), "question", character_counts)
    return retrieval.answer(asked, documents, enrich.each(quote_passages), "template", "counts").drop(
        "generated_at")


def generate_in_sql(layers: Layers) -> DataFrame:
    """The generator called from SQL text, on one prompt per region."""
    spark = layers.spark
    enrich.register_generator(spark, "generate_text", enrich.each(scoring.summary_line))
    by_region = kpi.claims_by_region(layers.fact_claims)
    return spark.sql(
        "SELECT region, generate_text('template', concat('Region ', region, ' has ', "
        "`count`, ' claims of which ', rejected, ' were rejected. Summarize.')).reply AS summary "
        "FROM {kpis}", kpis=by_region)


def flagged_prompts(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("priority_tier").isin(fixed.FLAGGED_TIERS)).select(
        "claim_id", scoring.investigation_prompt().alias("prompt"))


def scored_report(scored: DataFrame) -> DataFrame:
    return scoring.scored_report(scored).drop("generated_at")


def refuse_trifles(prompts: list[str]) -> list[enrich.Reply]:
    """Generator that fails on trivial damage, as a model may on some prompts."""
    return [ValueError("nothing to investigate") if "Trivial Damage" in prompt
            else scoring.summary_line(prompt) for prompt in prompts]


def generation_failures(scored: DataFrame) -> DataFrame:
    """How generation ended for claims of each tier, under a generator that fails on some."""
    report = scoring.scored_report(scored, refuse_trifles, "refusing")
    return report.groupBy("priority_tier", "generation_status", "model_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("ai_investigation_brief").startswith(
            f"{fixed.ERROR_PREFIX}nothing to investigate")).alias("error_texts"))


def generation_resumed(scored: DataFrame) -> DataFrame:
    """Briefs of two runs over one store of replies: the second asks only what failed before."""
    store = shared_folder(scored.sparkSession, "replies")
    flagged = F.col("priority_tier").isin(fixed.FLAGGED_TIERS)
    claims = scored.select("claim_id", "priority_tier",
                           F.when(flagged, scoring.investigation_prompt()).alias("prompt"))

    def run(fn: enrich.Generator) -> DataFrame:
        return enrich.generate_resumed(claims, "prompt", fn, "template", store, output="brief",
                                       skipped=fixed.STATUS_NOT_FLAGGED)

    first = run(refuse_trifles).agg(F.max("reply_run")).first()[0]
    return run(enrich.each(scoring.summary_line)).select(
        "claim_id", "priority_tier", "brief", "generation_status", "model_name",
        (F.col("reply_run") <= F.lit(first)).alias("from_first_run"))


def issue_report(layers: Layers) -> DataFrame:
    from . import issues

    registry = issues.registry({t: layers.raw(t) for t in
                                ("customers", "claims", "sales", "policy")})
    return issues.explanation_report(registry, None, "template").drop(
        "generated_at")


def insight_report(layers: Layers) -> DataFrame:
    docs = kpi.documents(layers.dim_policy, layers.fact_claims, layers.dim_customer)
    return kpi.insight_report(docs, None, "template").drop("generated_at")


def described(layers: Layers) -> DataFrame:
    from ..operators.profile import described_columns

    return described_columns("claims", layers.raw("claims").drop(fixed.SOURCE_FILE))


def join_preview(layers: Layers) -> DataFrame:
    return profiling.join_preview(layers.raw("policy"), layers.raw("customers"),
                                  layers.raw("cars"))


def spread(scored: DataFrame, value: Column | str) -> DataFrame:
    from ..operators.profile import spread_profile

    return spread_profile(scored, value, 0.95)


# Least score of a join path that the query reports: that of a column wholly contained in a key of
# the same name, however little of the key it covers.
CLEAR_PATH = 0.8


def join_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join paths among the driver's related tables, found from their values, checked exactly."""
    related = {name: raw.read(spark, sf_dir, name) for name in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem")}
    clear = [p for p in discover.join_paths(related) if p.score >= CLEAR_PATH]
    return discover.checked_paths(related, clear)


def _matches(customers: DataFrame) -> list[tuple[str, str, str, float]]:
    return discover.matched_columns(customers, fixed.SOURCE_FILE, fixed.MASTER_SOURCE)


def column_matches(layers: Layers) -> DataFrame:
    """The master file's column behind each column of the regional files."""
    return layers.spark.createDataFrame(
        _matches(layers.raw("customers")),
        "source_table string, physical_column string, logical_column string, score double",
    ).drop("score")


def matched_union(layers: Layers) -> DataFrame:
    """All customer files under the master's names, by the matches that were found."""
    customers = layers.raw("customers")
    matches = _matches(customers)
    return discover.unified(customers, fixed.SOURCE_FILE, fixed.MASTER_SOURCE, matches,
                            sorted({name for _, _, name, _ in matches}))
