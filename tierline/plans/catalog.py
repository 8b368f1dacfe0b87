"""The registered queries: every operator over the given tables.

Queries on table operations write to a new folder under ``spark.checkpoint.dir`` and
return what is read back. Times of the run itself are left out of the results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tierline.operators import (
    access,
    audit,
    clean,
    dashboard,
    expectations,
    features,
    forecast,
    marts,
    neighbours,
    policies,
    retrieval,
)
from tierline.operators.expectations import SILVER_RULES, Expectation
from tierline.plans import jobs, steps
from tierline.schemas import RAW_COLUMNS, SILVER_PARTITION, SILVER_TRANSACTIONS, null_report
from tierline.sources import append_table, snapshot_table, upkeep
from tierline.sources.layout import Layout
from tierline.sources.retail_feed import first_delivery, raw_feed, write_csv
from tierline.sources.scratch import scratch_dir
from tierline.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


# What the customer index is asked.
QUESTIONS = (
    "Which customer was first seen in 1995 and last seen in 2001?",
    "Did customer C-0000007 order in August, on the 17?",
)

# The given tables spread few rows over 2,500 days, so Silver is divided by month.
MONTHLY = f"month({SILVER_PARTITION})"


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Event times carry no zone; one zone on both sides keeps them as written.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _plain(df: DataFrame) -> DataFrame:
    """Without run times, and with timestamps as the given tables hold them."""
    out = df.drop("ingest_ts", "_rejected_at", "_ingest_ts", "_raw")
    return out.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in out.schema.fields
            if isinstance(f.dataType, TimestampType)
        }
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.silver(raw_feed(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_revenue(_silver(spark, sf_dir))


def _ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_ltv(_silver(spark, sf_dir))


# ---- projections, gates, dedup ------------------------------------------------------


@_query
def typed_projection(spark, sf_dir):
    """Safe casts and normalised text for every raw row."""
    return _plain(clean.typed(raw_feed(spark, sf_dir)))


@_query
def quality_clean(spark, sf_dir):
    """Rows that pass all gates, copies included."""
    return _plain(clean.clean_rows(clean.typed(raw_feed(spark, sf_dir))))


@_query
def quality_rejects(spark, sf_dir):
    """Rows that fail a gate, with all reasons and the strings as they came."""
    rejects = clean.silver_rejects(raw_feed(spark, sf_dir), bronze="bronze/transactions")
    return _plain(
        rejects.withColumns(
            {
                "_reason": F.array_join("_reason", "; "),
                "raw_quantity": F.col("_raw.quantity"),
                "raw_event_ts": F.col("_raw.event_ts"),
            }
        )
    )


@_query
def quality_reject_reasons(spark, sf_dir):
    """Rejected rows by first reason."""
    rejects = clean.rejected_rows(clean.typed(raw_feed(spark, sf_dir)))
    return rejects.groupBy(F.get("_reason", F.lit(0)).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows")
    )


@_query
def silver_dedup(spark, sf_dir):
    """Silver: gated, one row per transaction, enriched."""
    return _plain(_silver(spark, sf_dir))


# ---- marts and dashboard ------------------------------------------------------------


@_query
def gold_daily_revenue(spark, sf_dir):
    """Flagship: raw feed to daily revenue, in order of day and country."""
    return marts.by_day(_daily(spark, sf_dir))


@_query
def gold_customer_ltv(spark, sf_dir):
    return _plain(marts.by_value(_ltv(spark, sf_dir)))


@_query
def gold_daily_narrow(spark, sf_dir):
    return marts.daily_narrow(_silver(spark, sf_dir))


@_query
def dashboard_kpis(spark, sf_dir):
    return dashboard.kpis(_daily(spark, sf_dir), _ltv(spark, sf_dir))


@_query
def revenue_by_country_pivot(spark, sf_dir):
    """Date by country matrix; the columns are the countries of the nation table."""
    names = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        clean.normalized(F.col("n_name")).alias("country")
    )
    countries = [r["country"] for r in names.distinct().orderBy("country").collect()]
    return dashboard.revenue_by_country(_daily(spark, sf_dir), countries)


@_query
def top_customers(spark, sf_dir):
    return _plain(dashboard.top_customers(_ltv(spark, sf_dir)))


# ---- expectations and audits --------------------------------------------------------


def _ungated(spark, sf_dir):
    return clean.silver_before_rules(raw_feed(spark, sf_dir))


@_query
def expect_drop(spark, sf_dir):
    """One drop rule over typed rows."""
    rule = Expectation("positive_qty", "quantity > 0", "drop")
    return _plain(rule.apply(clean.typed(raw_feed(spark, sf_dir))))


@_query
def expect_quarantine(spark, sf_dir):
    """The rows one quarantine rule sets aside."""
    rule = Expectation("real_ts", "event_ts IS NOT NULL", "quarantine")
    return _plain(rule.split(clean.typed(raw_feed(spark, sf_dir)))[1])


@_query
def expect_null_not_violation(spark, sf_dir):
    """Kept and quarantined rows when a NULL predicate counts as neither."""
    rule = Expectation(
        "recent", "event_ts >= TIMESTAMP '1998-01-01 00:00:00'", "quarantine", False
    )
    good, bad = rule.split(clean.typed(raw_feed(spark, sf_dir)))
    return _plain(
        good.withColumn("_expectation", F.lit("kept")).unionByName(bad.drop("_rejected_at"))
    )


@_query
def expect_chain_declarative(spark, sf_dir):
    """Silver under the declared rules: deduplicated first, then checked."""
    return _plain(expectations.kept(expectations.tag(_ungated(spark, sf_dir), SILVER_RULES)))


@_query
def expect_chain_rejects(spark, sf_dir):
    """Rows the declared rules set aside, each with the first rule it breaks."""
    tagged = expectations.tag(_ungated(spark, sf_dir), SILVER_RULES)
    return _plain(expectations.quarantined(tagged, SILVER_RULES))


@_query
def expect_violations(spark, sf_dir):
    """Violations per declared rule, from one pass."""
    tagged = expectations.tag(_ungated(spark, sf_dir), SILVER_RULES)
    return expectations.violations(tagged, SILVER_RULES)


@_query
def audit_silver(spark, sf_dir):
    return audit.audit_silver(_silver(spark, sf_dir))


@_query
def audit_ungated(spark, sf_dir):
    """The same audit over clean rows before deduplication, where it finds copies."""
    return audit.audit_silver(clean.clean_rows(clean.typed(raw_feed(spark, sf_dir))))


@_query
def reconcile_gold_silver(spark, sf_dir):
    return audit.reconcile(_daily(spark, sf_dir), _silver(spark, sf_dir))


@_query
def schema_contract_report(spark, sf_dir):
    """NULLs per required Silver column before gating."""
    return null_report(clean.typed(raw_feed(spark, sf_dir)), SILVER_TRANSACTIONS)


@_query
def row_counts(spark, sf_dir):
    """Rows of each layer; a layer that does not exist counts NULL."""
    raw = raw_feed(spark, sf_dir)
    return audit.row_counts(
        {
            "bronze": raw,
            "silver": clean.silver(raw),
            "rejects": clean.rejected_rows(clean.typed(raw)),
            "daily_revenue": _daily(spark, sf_dir),
            "customer_ltv": _ltv(spark, sf_dir),
            "archive": None,
        }
    )


# ---- features, access ---------------------------------------------------------------


@_query
def lag_features(spark, sf_dir):
    return features.lag_features(_daily(spark, sf_dir))


@_query
def lag_features_by_ranges(spark, sf_dir):
    """The same features with every country's series cut into ranges of about two hundred days."""
    return features.lag_features_by_ranges(_daily(spark, sf_dir), rows=200)


@_query
def row_filter(spark, sf_dir):
    """Daily revenue as the analyst of region 2 sees it; scopes come from the nation table."""
    scope = spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        F.concat(F.lit("analyst-"), F.col("n_regionkey").cast("string")).alias("analyst"),
        clean.normalized(F.col("n_name")).alias("country"),
    )
    return access.visible_rows(_daily(spark, sf_dir), scope, "analyst-2")


@_query
def row_filter_admin(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return access.visible_rows(daily, daily.select("country"), "root", is_admin=True)


@_query
def column_mask(spark, sf_dir):
    return _plain(access.with_masked_customer(_silver(spark, sf_dir), may_see=False))


@_query
def secured_view(spark, sf_dir):
    """Silver by SQL against a view under the policies, as the analyst of region 2 sees it: own countries, hashed customers."""
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    scope = nations.select(
        F.concat(F.lit("analyst-"), F.col("n_regionkey").cast("string")).alias("analyst"),
        clean.normalized(F.col("n_name")).alias("country"),
    )
    groups = scope.select(F.col("analyst").alias("member"), F.lit("analysts").alias("group_name")).distinct()
    policies.install(spark, scope, groups, "analyst-2")
    policies.secured_view(spark, "secured_silver", _plain(_silver(spark, sf_dir)), mask="customer_id")
    return spark.sql("SELECT transaction_id, customer_id, country, revenue, event_date FROM secured_silver")


# ---- table operations ---------------------------------------------------------------


def _two_deliveries(spark, sf_dir, table, divided=MONTHLY):
    """Silver written from the first delivery, then upserted with the second."""
    first = clean.silver(raw_feed(spark, sf_dir, first_delivery()))
    second = clean.silver(raw_feed(spark, sf_dir, ~first_delivery()))
    for rows in (first, second):
        snapshot_table.write_or_upsert(rows, table, [clean.KEY], (divided,))
    return second


@_query
def merge_upsert(spark, sf_dir):
    """Newest version after two deliveries: later rows replace earlier ones by key."""
    table = scratch_dir(spark, "merge")
    _two_deliveries(spark, sf_dir, table)
    return _plain(snapshot_table.read(spark, table))


@_query
def merge_idempotent(spark, sf_dir):
    """The second delivery upserted twice changes nothing more."""
    table = scratch_dir(spark, "merge")
    second = _two_deliveries(spark, sf_dir, table)
    snapshot_table.upsert(second, table, [clean.KEY])
    return _plain(snapshot_table.read(spark, table))


@_query
def time_travel_first_version(spark, sf_dir):
    """Version 0 read after the upsert: the first delivery alone."""
    table = scratch_dir(spark, "travel")
    _two_deliveries(spark, sf_dir, table)
    return _plain(snapshot_table.read(spark, table, version=0))


@_query
def append_doubles(spark, sf_dir):
    """The feed appended twice: copies per transaction, and per version when read as of 0."""
    table = scratch_dir(spark, "append")
    for _ in range(2):
        append_table.append(raw_feed(spark, sf_dir), table)

    def copies(df, name):
        return df.groupBy("transaction_id").agg(F.count(F.lit(1)).alias(name))

    now = copies(append_table.read(spark, table), "copies")
    before = copies(append_table.read(spark, table, as_of=0), "copies_as_of_0")
    return now.join(before, "transaction_id")


@_query
def schema_evolution_append(spark, sf_dir):
    """Two deliveries with different columns in one table; the missing one reads NULL."""
    table = scratch_dir(spark, "evolve")
    hinted = raw_feed(spark, sf_dir, first_delivery()).withColumn(
        "_source_hint", F.lit("transactions.csv")
    )
    append_table.append(hinted, table)
    append_table.append(raw_feed(spark, sf_dir, ~first_delivery()), table)
    return append_table.read(spark, table).select(
        *RAW_COLUMNS, "_source_hint", F.col(append_table.VERSION).cast("bigint")
    )


@_query
def compact_files(spark, sf_dir):
    """Rows after compaction equal the rows before."""
    table = scratch_dir(spark, "compact")
    snapshot_table.overwrite(_silver(spark, sf_dir), table, spread=False)
    upkeep.optimize(spark, table)
    return _plain(snapshot_table.read(spark, table))


@_query
def cluster_by_customer(spark, sf_dir):
    """Rows after clustering by customer within days equal the rows before."""
    table = scratch_dir(spark, "cluster")
    snapshot_table.overwrite(_silver(spark, sf_dir), table, (MONTHLY,))
    upkeep.optimize(spark, table, cluster_by="customer_id")
    return _plain(snapshot_table.read(spark, table))


@_query
def cluster_by_customer_and_product(spark, sf_dir):
    """Rows after weaving customers and products into one order equal the rows before."""
    table = scratch_dir(spark, "cluster")
    snapshot_table.overwrite(_silver(spark, sf_dir), table)
    upkeep.optimize(spark, table, cluster_by=["customer_id", "product_id"])
    return _plain(snapshot_table.read(spark, table))


@_query
def vacuum_candidates(spark, sf_dir):
    """Folders only the replaced version needs, once its retention is over."""
    table = scratch_dir(spark, "vacuum")
    _two_deliveries(spark, sf_dir, table, SILVER_PARTITION)
    dead = upkeep.vacuum_candidates(spark, table, retain_hours=0, force=True)
    return dead.select(
        F.regexp_extract("folder", r"data_version=(\d+)", 1).cast("bigint").alias("data_version"),
        F.regexp_extract("folder", r"event_date=(.*)$", 1).cast("date").alias("event_date"),
    )


# ---- ingest -------------------------------------------------------------------------


def _csv_layout(spark, sf_dir) -> Layout:
    layout = Layout(scratch_dir(spark, "lakehouse"), MONTHLY)
    write_csv(raw_feed(spark, sf_dir), layout.raw)
    return layout


@_query
def batch_csv_ingest(spark, sf_dir):
    """Feed written as CSV and ingested into Bronze; empty fields arrive as NULL."""
    layout = _csv_layout(spark, sf_dir)
    jobs.bronze_job(spark, layout, layout.raw)
    bronze = append_table.read(spark, layout.bronze)
    return bronze.select(
        *RAW_COLUMNS, "_source_hint", F.col("_source_file").endswith(".csv").alias("from_csv")
    )


@_query
def changing_headers_ingest(spark, sf_dir):
    """Two deliveries whose headers differ in order and columns, in one folder: each file goes by its own header."""
    layout = Layout(scratch_dir(spark, "lakehouse"), MONTHLY)
    later = raw_feed(spark, sf_dir, ~first_delivery())
    # The later files lack the currency, bring two columns more and come in another order.
    shop = F.concat(F.lit("shop, "), F.right("product_id", F.lit(1)))
    more = later.withColumns({"Shop": shop, "line": F.substring_index("transaction_id", "-", -1)})
    write_csv(raw_feed(spark, sf_dir, first_delivery()), layout.raw)
    write_csv(more.select("Shop", *reversed(RAW_COLUMNS), "line").drop("currency"), layout.raw, "append")
    jobs.bronze_job(spark, layout, layout.raw, by_header=True)
    return append_table.read(spark, layout.bronze).select(*RAW_COLUMNS, "Shop", "line")


def _streamed(spark, layout):
    ingest.ingest_available(spark, layout.raw, layout.bronze, layout.checkpoint("bronze"))


@_query
def stream_ingest_available_now(spark, sf_dir):
    """The CSV folder drained by a stream."""
    layout = _csv_layout(spark, sf_dir)
    _streamed(spark, layout)
    return append_table.read(spark, layout.bronze).select(*RAW_COLUMNS)


@_query
def stream_rerun_no_duplicates(spark, sf_dir):
    """Draining again with the same checkpoint adds nothing."""
    layout = _csv_layout(spark, sf_dir)
    for _ in range(2):
        _streamed(spark, layout)
    return append_table.read(spark, layout.bronze).select(*RAW_COLUMNS)


# ---- whole jobs ---------------------------------------------------------------------


def _jobs_run(spark, sf_dir) -> Layout:
    layout = _csv_layout(spark, sf_dir)
    jobs.bronze_job(spark, layout, layout.raw)
    jobs.silver_job(spark, layout)
    return layout


@_query
def jobs_daily_revenue(spark, sf_dir):
    """CSV to Bronze to Silver to Gold, read back through the mart's view."""
    layout = _jobs_run(spark, sf_dir)
    jobs.gold_job(spark, layout)
    return spark.table("gold_daily_revenue")


@_query
def jobs_rejects(spark, sf_dir):
    """Rejects table after two Silver runs over the same Bronze: no row twice."""
    layout = _jobs_run(spark, sf_dir)
    jobs.silver_job(spark, layout)
    rejects = append_table.read(spark, layout.rejects)
    return rejects.select(
        "transaction_id",
        F.array_join("_reason", "; ").alias("reasons"),
        F.col("_raw.event_ts").alias("raw_event_ts"),
    )


@_query
def upsert_blank_partitions(spark, sf_dir):
    """Upsert into a table partitioned by a text that is empty or NULL in many rows: none is lost.

    Spark reads the empty text back as NULL.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus")
    first = orders.select("o_orderkey", "o_custkey", F.expr("if(o_orderstatus = 'F', 'F', NULL)").alias("part"))
    blank = F.expr("if(o_orderstatus = 'F', 'F', '')").alias("part")
    changed = orders.where("o_orderkey % 3 = 0").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), blank)
    table = scratch_dir(spark, "blank-partitions")
    snapshot_table.write_or_upsert(first.where("o_orderkey % 2 = 0"), table, ["o_orderkey"], ("part",))
    snapshot_table.write_or_upsert(first.where("o_orderkey % 2 = 1"), table, ["o_orderkey"], ("part",))
    snapshot_table.write_or_upsert(changed, table, ["o_orderkey"], ("part",))
    return snapshot_table.read(spark, table)


@_query
def jobs_incremental_silver(spark, sf_dir):
    """Silver after two deliveries, each cleaned on arrival: as if cleaned at once."""
    layout = Layout(scratch_dir(spark, "lakehouse"), MONTHLY)
    for delivery in (first_delivery(), ~first_delivery()):
        append_table.append(raw_feed(spark, sf_dir, delivery), layout.bronze)
        jobs.silver_job(spark, layout)
    return _plain(snapshot_table.read(spark, layout.silver))


@_query
def ingest_counts(spark, sf_dir):
    """Rows of every layer as the writing jobs counted them, and what a stream took from the same folder."""
    layout = _jobs_run(spark, sf_dir)
    jobs.gold_job(spark, layout)
    counts = jobs.layer_counts(spark, layout)
    other = Layout(scratch_dir(spark, "streamed"))
    drained = ingest.drain(spark, layout.raw, other.bronze, other.checkpoint("bronze"))
    counts["stream"] = drained.taken
    return spark.createDataFrame(list(counts.items()), "layer STRING, rows BIGINT")


@_query
def replaced_batch_silver(spark, sf_dir):
    """Silver after the second delivery came again with a third of its orders: the others go or give way to earlier copies."""
    layout = Layout(scratch_dir(spark, "lakehouse"), MONTHLY)
    second = ~first_delivery()
    append_table.append(raw_feed(spark, sf_dir, first_delivery()), layout.bronze, "first")
    append_table.append(raw_feed(spark, sf_dir, second), layout.bronze, "second")
    jobs.silver_job(spark, layout)
    append_table.append(raw_feed(spark, sf_dir, second & (F.col("l_orderkey") % 3 == 0)), layout.bronze, "second")
    jobs.silver_job(spark, layout)
    return _plain(snapshot_table.read(spark, layout.silver))


@_query
def gold_after_deliveries(spark, sf_dir):
    """Both marts after three deliveries, each brought in by increments: as if built at once."""
    layout = Layout(scratch_dir(spark, "lakehouse"), MONTHLY)
    days = [F.lit(d).cast("timestamp_ntz") for d in ("1997-12-01", "1998-06-01")]
    shipped = F.col("l_shipdate")
    for part in (shipped < days[0], (shipped >= days[0]) & (shipped < days[1]), shipped >= days[1]):
        append_table.append(raw_feed(spark, sf_dir, part), layout.bronze)
        jobs.silver_job(spark, layout)
        jobs.gold_job(spark, layout)
    daily = snapshot_table.read(spark, layout.daily_revenue).withColumnRenamed("gross_revenue", "revenue")
    ltv = snapshot_table.read(spark, layout.customer_ltv).withColumnRenamed("lifetime_revenue", "revenue")
    return _plain(daily.withColumnRenamed("order_count", "orders").unionByName(ltv, allowMissingColumns=True))


@_query
def jobs_declarative_daily(spark, sf_dir):
    """CSV to Bronze, then the declared steps; the narrow daily mart."""
    layout = _csv_layout(spark, sf_dir)
    jobs.bronze_job(spark, layout, layout.raw)
    steps.declarative_job(spark, layout)
    return snapshot_table.read(spark, layout.daily_narrow)


# ---- forecasting --------------------------------------------------------------------


@_query
def forecast_error_metrics(spark, sf_dir):
    """Errors of the simplest forecasts: each lag feature taken as the prediction."""
    rows = features.lag_features(_daily(spark, sf_dir))
    forecasts = rows.unpivot("gross_revenue", ["lag_1", "lag_7", "rolling_3"], "forecast", "value")
    return forecast.error_metrics(forecasts, prediction="value", by=("forecast",)).select(
        "forecast", F.round("mae", 2).alias("mae"), F.round("r2", 6).alias("r2"), "rows"
    )


@_query
def forecast_split_by_date(spark, sf_dir):
    """Rows on each side of a date cut."""
    rows = forecast.training_frame(_daily(spark, sf_dir))
    train, test = forecast.split(rows, cut="2000-01-01")
    return train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))


@_query
def train_forecaster_metrics(spark, sf_dir):
    """A forest trained on the whole mart; its recorded run."""
    layout = Layout(scratch_dir(spark, "forecast"))
    daily = _daily(spark, sf_dir)
    snapshot_table.overwrite(daily, layout.daily_revenue)
    forecast.train(snapshot_table.read(spark, layout.daily_revenue), layout)
    runs = append_table.read(spark, layout.runs)
    return runs.select(
        "model_name",
        F.col("metrics")["mae"].alias("mae"),
        F.col("metrics")["r2"].alias("r2"),
        F.col("params")["train_rows"].cast("bigint").alias("train_rows"),
        F.array_join("features", ",").alias("features"),
    )


@_query
def register_best_run(spark, sf_dir):
    """Runs of the simplest forecasts, the best of them registered twice."""
    layout = Layout(scratch_dir(spark, "registry"))
    for r in forecast_error_metrics(spark, sf_dir).collect():  # one row per forecast
        forecast.record_run(
            spark, layout.runs, r["forecast"], {}, {"mae": r["mae"], "r2": r["r2"]}
        )
    for _ in range(2):
        forecast.register(spark, layout)
    return forecast.registry(spark, layout).select("name", "model_version", "alias", "run_id")


# ---- retrieval ----------------------------------------------------------------------


@_query
def knn_exact(spark, sf_dir):
    """The three vectors nearest to vector 0, over all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    query = vectors.filter("vec_id = 0").select("embedding").scalar()
    return retrieval.nearest(vectors.withColumnRenamed("vec_id", "id"), query)


@_query
def customer_documents(spark, sf_dir):
    """One sentence per customer."""
    return retrieval.customer_documents(_ltv(spark, sf_dir)).select(
        "id", "text", "metadata.orders", "metadata.lifetime_revenue"
    )


@_query
def grounded_answer(spark, sf_dir):
    """Answer from the customers nearest to the highest orders and revenue of all.

    The vectors are shares of those highest values, so the ideal customer is (1, 1).
    """
    ltv = _ltv(spark, sf_dir)

    def share(name: str):
        return F.col(f"metadata.{name}") / ltv.agg(F.max(name).cast("double")).scalar()

    documents = retrieval.customer_documents(ltv).withColumn(
        "embedding", F.array(share("orders"), share("lifetime_revenue"))
    )
    ideal = F.array(F.lit(1.0), F.lit(1.0))
    return retrieval.compose_answer(
        retrieval.DEFAULT_QUESTION, retrieval.nearest(documents, ideal)
    )


def _customer_index(spark, sf_dir) -> str:
    """Customer mart written and indexed; returns the index path."""
    layout = Layout(scratch_dir(spark, "index"))
    snapshot_table.overwrite(_ltv(spark, sf_dir), layout.customer_ltv)
    retrieval.build_index(snapshot_table.read(spark, layout.customer_ltv), layout.customer_index)
    return layout.customer_index


@_query
def text_embed_search(spark, sf_dir):
    """Index of all customers, asked a question; its hits."""
    path = _customer_index(spark, sf_dir)
    hits = retrieval.retrieve(spark, path, QUESTIONS[0])
    return hits.select("id", "text", F.round("distance", 9).alias("distance"))


@_query
def text_ask(spark, sf_dir):
    """Index of all customers and the answers to three questions, of which the default one matches nobody."""
    questions = spark.createDataFrame(list(enumerate([*QUESTIONS, retrieval.DEFAULT_QUESTION])), "question_id INT, question STRING")
    return retrieval.ask_all(spark, _customer_index(spark, sf_dir), questions)


@_query
def knn_batch(spark, sf_dir):
    """The three vectors nearest to each of the first fifty, exactly, all questions at once."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    questions = vectors.where("id < 50").select(F.col("id").alias("question_id"), "embedding")
    return neighbours.nearest_batch(vectors, questions, 3)


@_query
def knn_index(spark, sf_dir):
    """What an index of sixteen lists finds of the ten nearest of every twentieth vector, probing eleven."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    path = scratch_dir(spark, "vector-index")
    neighbours.build_index(vectors, path, centres=16)
    questions = vectors.where("id % 20 = 0").select(F.col("id").alias("question_id"), "embedding")
    return neighbours.search(spark, path, questions, 10, probes=11)
