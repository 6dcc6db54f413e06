"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each reads the driver tables whole.  Computed columns carry the same names
as in ``riverbend.plans.oracle``; values that would otherwise be doubles are
returned as fixed-scale decimals so that two engines print them alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.functions.scores import band
from riverbend.functions.text import clean_long_tokens, letter_count
from riverbend.operators import customer, keyed, records, report, search, stats, vault, windows
from riverbend.plans import tables as tb
from riverbend.plans.tables import Tables, codes_from_tables, incidents_from_tables
from riverbend.session import apply_defaults, materialize


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    apply_defaults(spark)
    # the tables' timestamps are UTC wall-clock values (timestamp_ntz); casts
    # to instants (watermarks, epoch millis) must read them as UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return Tables(spark, sf_dir)


def dec4(col: str) -> F.Column:
    return F.round(F.col(col), 4).cast("decimal(18,4)").alias(col)


# --------------------------------------------------------------------------
# A. incident report
# --------------------------------------------------------------------------

def incident_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship report; the district comes from the supplier dimension, so the
    facts are pre-aggregated before that join."""
    t = _t(spark, sf_dir)
    rep = report.incident_report(tb.incident_facts(t), codes_from_tables(t), name_sep=" ",
                                 districts=_districts(t), district_key="l_suppkey")
    return rep.select("DISTRICT", "crimes_total", "crimes_monthly", "frequent_crime_types",
                      dec4("lat"), dec4("lng"))


def incident_report_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report as Spark SQL text over temporary views."""
    from riverbend.plans.sql_views import incident_report_sql as report_sql
    t = _t(spark, sf_dir)
    rep = report_sql(spark, incidents_from_tables(t), codes_from_tables(t), name_sep=" ")
    return rep.select("DISTRICT", "crimes_total", "crimes_monthly", "frequent_crime_types",
                      dec4("lat"), dec4("lng"))


# The input schemas of the reference's file sources (positional binding).
INCIDENT_CSV_SCHEMA = (
    "INCIDENT_NUMBER string, OFFENSE_CODE long, OFFENSE_CODE_GROUP string, OFFENSE_DESCRIPTION string, DISTRICT string, "
    "REPORTING_AREA int, SHOOTING string, OCCURRED_ON_DATE string, YEAR int, MONTH int, DAY_OF_WEEK string, HOUR int, "
    "UCR_PART string, STREET string, LAT decimal(18,2), LONG decimal(18,2), LOCATION string")
CODES_CSV_SCHEMA = "CODE long, NAME string"
TWEET_CSV_SCHEMA = ("target int, id long, raw_timestamp string, query_status string, "
                    "author string, tweet string")
WINE_SCHEMA = ("id decimal(38,0), country string, points decimal(38,0), title string, "
               "variety string, winery string")
# The defaults printed for missing wine fields.
WINE_DEFAULTS = {"country": "empty country", "title": "empty title",
                 "variety": "empty variety", "winery": "empty winery"}


def incident_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report from CSV files with header and fixed schemas (the
    reference's input format), its result saved as one parquet file."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources import readers, sinks
    inc_path, codes_path = scratch_path(spark, "incidents-csv"), scratch_path(spark, "codes-csv")
    incidents = incidents_from_tables(t)
    names = [c.split()[0] for c in INCIDENT_CSV_SCHEMA.split(", ")]
    sinks.write_csv(incidents.select(*[F.col(c) if c in incidents.columns else F.lit(None).cast("string").alias(c) for c in names]), inc_path)
    sinks.write_csv(codes_from_tables(t), codes_path)
    rep = report.incident_report(readers.read_csv(spark, inc_path, INCIDENT_CSV_SCHEMA),
                                 readers.read_csv(spark, codes_path, CODES_CSV_SCHEMA), name_sep=" ")
    out = scratch_path(spark, "report-parquet")
    sinks.write_parquet(rep, out, single_file=True)
    return readers.read_parquet(spark, out).select(
        "DISTRICT", "crimes_total", "crimes_monthly", "frequent_crime_types", dec4("lat"), dec4("lng"))


def _districts(t: Tables) -> DataFrame:
    return tb.supplier_district(t).withColumnRenamed("s_suppkey", "l_suppkey")


def median_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return report.monthly_median(tb.incident_facts(t), _districts(t), "l_suppkey") \
                 .filter(F.col("DISTRICT").isNotNull())


def top3_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    codes = report.clean_codes(codes_from_tables(t), name_sep=" ")
    inc = tb.incident_facts(t)
    joined = inc.join(codes, inc["OFFENSE_CODE"] == codes["CODE"], "inner")
    counts = report.counts_by_district(joined, ["NAME"], _districts(t), "l_suppkey")
    return report.top_k_per_group(counts, "DISTRICT", "NAME", "counts",
                                  out="frequent_crime_types") \
                 .filter(F.col("DISTRICT").isNotNull())


def code_name_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code dimension cleaning on names like ``'5-LOW'``: distinct pairs, head."""
    t = _t(spark, sf_dir)
    codes = t.orders.select(F.col("o_orderstatus").alias("CODE"),
                            F.col("o_orderpriority").alias("NAME"))
    return report.clean_codes(codes, name_sep="-")



# --------------------------------------------------------------------------
# customer weight (left joins)
# --------------------------------------------------------------------------

FIXED_LOAD_TS = "2024-01-01 00:00:00"


def customer_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("purchaser"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"),
                              F.col("l_partkey").alias("product_id"))
    products = t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("weight"))
    return customer.customer_weight(customers, orders, products, lines,
                                    load_ts=FIXED_LOAD_TS, name_cols=("name",))


# a bound that the smallest tables exceed
CUSTOMER_MAX_ID = 100


# large parts of a few types: the dimension that keeps few of the facts
PART_MIN_SIZE = 45


def _large_parts(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_size") >= PART_MIN_SIZE).select("p_partkey", "p_brand")


def _sales_by_brand(joined: DataFrame) -> DataFrame:
    return joined.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("quantity"))


def replicated_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of large parts per brand: the parts, of a measured size, are copied to the executors."""
    from riverbend.operators.joins import dimension_join
    t = _t(spark, sf_dir)
    return _sales_by_brand(dimension_join(t.lineitem.select("l_partkey", "l_quantity"), _large_parts(t), "l_partkey", "p_partkey"))


def bloom_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as if the parts were too many to be copied: a Bloom filter of
    their keys thins the lines out before both sides are shuffled."""
    from riverbend.operators.joins import dimension_join
    t = _t(spark, sf_dir)
    return _sales_by_brand(dimension_join(t.lineitem.select("l_partkey", "l_quantity"), _large_parts(t), "l_partkey", "p_partkey", replicate_bytes=0))


def customer_weight_upto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for customers up to an id: the filter reaches both scans."""
    t = _t(spark, sf_dir)
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("purchaser"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"))
    products = t.part.select(F.col("p_partkey").alias("id"), F.col("p_size").alias("weight"))
    return customer.customer_weight(customers, orders, products, lines, max_id=CUSTOMER_MAX_ID,
                                    load_ts=FIXED_LOAD_TS, name_cols=("name",))


# --------------------------------------------------------------------------
# C. warehouse load
# --------------------------------------------------------------------------

def _inline_log(spark: SparkSession) -> DataFrame:
    """The file log before this load: an earlier reference-data file."""
    return spark.createDataFrame(
        [(1, "ERP", "STG_REF", "2023-12-01 00:00:00")],
        "FILE_ID long, SOURCE string, FILE_NAME string, LOAD_TS string",
    ).withColumn("LOAD_TS", F.col("LOAD_TS").cast("timestamp_ntz"))


def _log_after_insert(spark: SparkSession, stage: DataFrame) -> DataFrame:
    log = _inline_log(spark)
    return log.unionByName(vault.new_file_rows(stage, log, load_ts=FIXED_LOAD_TS))


def file_log_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return _log_after_insert(spark, tb.stage_from_supplier(t))


def latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest log row per (SOURCE, FILE_NAME) with events as the log."""
    t = _t(spark, sf_dir)
    log = t.events.select(F.col("event_id").alias("FILE_ID"), F.col("event_type").alias("SOURCE"),
                          F.col("user_id").cast("string").alias("FILE_NAME"),
                          F.col("ts").alias("LOAD_TS"))
    return vault.latest_files(log)


ODS_DDL, HUB_DDL, SAT_DDL = vault.ODS_DDL, vault.HUB_DDL, vault.SAT_DDL


def _interrupted_load(spark: SparkSession, t: Tables):
    """Stage, log and targets after a load of the current file that stopped
    once the districts of the first two regions were written."""
    # the stage is a stored table in the load chain; the file log is read
    # once, as the current file's scalar row
    stage = materialize(tb.stage_from_supplier(t), "stage")
    log = _log_after_insert(spark, stage)
    first = stage.join(tb.districts_of_regions(t, tb.FIRST_LOAD_REGIONS), "District", "left_semi")
    row = vault.current_file_row(log)
    ods = vault.ods_delta(first, log, spark.createDataFrame([], ODS_DDL), file_row=row)
    hub = vault.hub_delta(first, log, spark.createDataFrame([], HUB_DDL), file_row=row)
    sat = vault.sat_delta(first, log, spark.createDataFrame([], SAT_DDL), file_row=row)
    return stage, log, row, ods, hub, sat


def ods_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, log, row, ods, _, _ = _interrupted_load(spark, _t(spark, sf_dir))
    return vault.ods_delta(stage, log, ods, file_row=row)


def hub_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, log, row, _, hub, _ = _interrupted_load(spark, _t(spark, sf_dir))
    return vault.hub_delta(stage, log, hub, file_row=row)


def sat_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, log, row, _, _, sat = _interrupted_load(spark, _t(spark, sf_dir))
    return vault.sat_delta(stage, log, sat, file_row=row)


def vault_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table-backed load chain run three times (suppliers as the first
    file, customers as a later one, which is then loaded again with every
    total one lower) into fresh parquet tables, then the current view: hub x
    satellite, the satellite row loaded last per district."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    root = scratch_path(spark, "dwh")
    vault.run_load_chain(tb.stage_from_supplier(t), root, file_name="STG_OPER",
                         load_ts="2024-01-01 00:00:00")
    vault.run_load_chain(tb.stage_from_customer(t), root, file_name="STG_OPER_2",
                         load_ts="2024-02-01 00:00:00")
    vault.run_load_chain(tb.stage_from_customer(t).withColumn("Crimes_total", F.col("Crimes_total") - 1), root,
                         file_name="STG_OPER_2", load_ts="2024-03-01 00:00:00")
    return vault.current_from_tables(spark, root)


def vault_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three loads into catalog tables of a schema of their own: each
    file an external table over its parquet files, inserted into the stage;
    stage, ODS, hub and satellite segmented by their keys.  The current view
    is kept and the schema dropped."""
    t = _t(spark, sf_dir)
    import uuid

    from riverbend.operators import warehouse as dwh
    from riverbend.session import join_root, save, scratch_path
    root = scratch_path(spark, "catalog")
    house = dwh.Warehouse(spark, f"dwh_{uuid.uuid4().hex}", location=join_root(root, "schema"))
    house.create()
    try:
        again = tb.stage_from_customer(t).withColumn("Crimes_total", F.col("Crimes_total") - 1)
        loads = [(tb.stage_from_supplier(t), "STG_OPER"), (tb.stage_from_customer(t), "STG_OPER_2"), (again, "STG_OPER_2")]
        for month, (rows, file_name) in enumerate(loads, 1):
            path = join_root(root, f"crimes-{month}")
            rows.write.parquet(path)
            dwh.drop_table(spark, house.name("crimes"))
            dwh.create_external_table(spark, house.name("crimes"), dwh.STAGE_DDL, path)
            house.fill_stage(house.table("crimes"))
            house.load(file_name=file_name, load_ts=f"2024-0{month}-01 00:00:00")
        return save(house.current(), "current")[0]
    finally:
        house.drop()


def report_to_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow: incident report -> one parquet file -> read back as the
    crimes table -> stage (warehouse types) -> table-backed load chain ->
    current view."""
    from riverbend.session import scratch_path
    from riverbend.sources import readers, sinks
    rep = incident_report(spark, sf_dir)
    crimes_path = scratch_path(spark, "crimes-parquet")
    sinks.write_parquet(rep, crimes_path, single_file=True)
    crimes = readers.read_parquet(spark, crimes_path)
    stage = crimes.select(
        F.col("DISTRICT").alias("District"),
        F.col("crimes_total").alias("Crimes_total"),
        F.col("crimes_monthly").alias("Crimes_monthly"),
        F.col("frequent_crime_types").alias("Frequent_crime_types"),
        F.col("lat").cast("decimal(37,15)").alias("Lat"),
        F.col("lng").cast("decimal(37,15)").alias("Lng"))
    root = scratch_path(spark, "dwh")
    vault.run_load_chain(stage, root, load_ts=FIXED_LOAD_TS)
    return vault.current_from_tables(spark, root)


def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return vault.key_violations(t.orders, ["o_custkey"])


# --------------------------------------------------------------------------
# D. keyed lookups, change application
# --------------------------------------------------------------------------

def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    requests = t.orders.select("o_orderkey", "o_custkey")
    return keyed.lookup_by_id(tb.customer_store(t), requests, request_key="o_custkey")


def lookup_by_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    requests = t.supplier.select("s_suppkey", "s_nationkey")
    return keyed.lookup_by_attr(tb.customer_store(t), requests, request_attr="s_nationkey")


def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    changes = tb.event_ops(t).select("user_id", "ts", "event_id", "event_type",
                                     F.col("value").cast("decimal(18,2)").alias("value"), "op")
    return keyed.apply_changes(changes, ["user_id"], ["ts", "event_id"])


def upsert_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records replaced by the customer's last order: status and total."""
    t = _t(spark, sf_dir)
    updates = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("phone"),
                              F.col("o_totalprice").cast("decimal(18,2)").alias("ltv"), "o_orderdate", "o_orderkey")
    return keyed.upsert(tb.customer_store(t), updates, ["customer_id"], ["o_orderdate", "o_orderkey"])


# --------------------------------------------------------------------------
# E. change streams: batch forms
# --------------------------------------------------------------------------

def cdc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return records.parse_cdc(tb.cdc_messages(t))


def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return records.parse_json(t.events, T.StructType([T.StructField("k", T.LongType())]),
                              col="props", keep=("event_id",))


def guarded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from riverbend.streaming.consumers import guarded_type_counts
    t = _t(spark, sf_dir)
    return guarded_type_counts(tb.change_events(t))


def slide_300_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    ev = t.events.select("ts", F.col("event_type").alias("type"))
    return windows.sliding_counts(ev, "ts", 300, 10, ["type"])


def stream_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    out = stats.stream_stats(t.events, "ts", ["event_type"])
    return out.withColumn("messages_per_sec", F.col("messages_per_sec").cast("decimal(18,4)"))


SEARCH_GTE_MS = 1704672000000   # 2024-01-08T00:00:00Z
SEARCH_LTE_MS = 1705881599999   # 2024-01-21T23:59:59.999Z


def search_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    ev = t.events
    cond = search.epoch_millis_range(ev, "ts", SEARCH_GTE_MS, SEARCH_LTE_MS)
    return search.search(ev, must=[cond], terms_field="user_id", size=10)


def search_must_not(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top event types of a time range, without error events and nameless users."""
    ev = _t(spark, sf_dir).events
    cond = search.epoch_millis_range(ev, "ts", SEARCH_GTE_MS, SEARCH_LTE_MS)
    return search.search(ev, must=[cond, F.col("user_id").isNotNull()], must_not=[F.col("event_type") == "error"],
                         terms_field="event_type", size=10)


# --------------------------------------------------------------------------
# F. text: labels, bands, histogram, cleaning
# --------------------------------------------------------------------------

# line breaks in a CSV cell would make the file unsplittable, so they are
# written as private-use characters and put back by the reader's projection
_BREAKS, _STAND_INS = "\r\n", "\ue00d\ue00a"


def _tweets_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as the 6-column tweet CSV without header (target 4
    = positive), read back with the fixed schema."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources import readers, sinks
    path = scratch_path(spark, "tweets-csv")
    docs = tb.labelled_documents(t)
    sinks.write_csv(docs.select((F.col("label") * 4).cast("int").alias("target"),
                                F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("raw_timestamp"),
                                F.lit("NO_QUERY").alias("query_status"), F.lit(None).cast("string").alias("author"),
                                F.translate("tweet", _BREAKS, _STAND_INS).alias("tweet")), path, header=False,
                    quote_all=True)
    raw = readers.read_csv(spark, path, TWEET_CSV_SCHEMA, header=False)
    return raw.withColumn("tweet", F.translate("tweet", _STAND_INS, _BREAKS))


def tweet_text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tweet's label and the hash of its text after the CSV round trip."""
    from riverbend.functions.scores import binary_label
    return _tweets_csv(spark, sf_dir).select("id", binary_label("target").alias("label"), F.md5("tweet").alias("tweet_md5"))


def tweet_labels_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label balance of the tweet CSV."""
    from riverbend.functions.scores import binary_label
    raw = _tweets_csv(spark, sf_dir)
    return raw.groupBy(binary_label("target").alias("label")).agg(F.count(F.lit(1)).alias("count"))


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as JSON-lines records (missing fields omitted), read back as typed
    records with FAILFAST and printed defaults for missing fields."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources import readers, sinks
    path = scratch_path(spark, "records-json")
    recs = t.part.select(F.col("p_partkey").alias("id"),
                         F.when(F.col("p_size") > 25, F.col("p_brand")).alias("country"),
                         F.col("p_size").alias("points"), F.col("p_name").alias("title"),
                         F.col("p_type").alias("variety"))
    sinks.write_json(recs, path, mode="errorifexists")
    typed = readers.read_json_records(spark, path, WINE_SCHEMA)
    return records.json_field_defaults(typed, WINE_DEFAULTS)


def json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts appended twice to one JSON folder, one file each time; copies of each."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources import readers, sinks
    path = scratch_path(spark, "append-json")
    for _ in range(2):
        sinks.write_json(t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title")), path)
    rows = readers.read_json_records(spark, path, "id long, title string")
    return rows.groupBy("id", "title").agg(F.count(F.lit(1)).alias("copies"))


def record_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a stream of JSON records, in two runs; each record, with
    printed defaults for missing fields, is written by a ``foreach`` writer
    in the executors, once.  What was written, read back."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources import sinks
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import effects
    feed, root = scratch_path(spark, "record-feed"), scratch_path(spark, "record-effects")
    recs = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("country"),
                         F.col("p_size").alias("points"), F.col("p_name").alias("title"), F.col("p_type").alias("variety"))
    for part in (F.col("id") % 3 == 0, F.col("id") % 3 != 0):
        sinks.write_json(recs.where(part), feed)
        stream = file_stream(spark, feed, WINE_SCHEMA, max_files_per_trigger=None, max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
        effects.run_effects(records.json_field_defaults(stream, WINE_DEFAULTS), root)
    kinds = {"id": "decimal(38,0)", "points": "decimal(38,0)"}
    names = ("id", "country", "points", "title", "variety", "winery")
    line = F.from_json("value", ", ".join(f"{n} string" for n in names))
    written = effects.rendered(spark, root).select(line.alias("r"))
    return written.select(*[F.col(f"r.{n}").cast(kinds.get(n, "string")).alias(n) for n in names])


def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return tb.labelled_documents(t).groupBy("label").agg(F.count(F.lit(1)).alias("count"))


def letter_share(col: str) -> F.Column:
    n = F.length(F.col(col))
    return F.when(n > 0, letter_count(col) / n)


def score_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    scored = t.documents.select(band(letter_share("text")).alias("clean_probability"))
    return scored.groupBy("clean_probability").agg(F.count(F.lit(1)).alias("count"))


def histogram10(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    h = stats.histogram(t.events, "value", 10)
    return h.select("bin", F.col("bin_start").cast("decimal(18,4)").alias("bin_start"),
                    F.col("bin_end").cast("decimal(18,4)").alias("bin_end"), "count")


def clean_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _t(spark, sf_dir)
    toks = clean_long_tokens("text", 3)
    return t.documents.select("doc_id", F.size(toks).cast("long").alias("n_tokens"),
                              F.array_join(toks, " ").alias("tokens"))


# --------------------------------------------------------------------------
# E. change streams: streaming forms (availableNow replay of the tables)
# --------------------------------------------------------------------------

# Fixed value: the channel the language stream leaves out.
EXCLUDED_CHANNEL = "click"


def window_append_20_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-bot events per type in 20 s windows sliding by 10 s, watermark
    20 s, append mode, run as a stream over the events table."""
    _t(spark, sf_dir)
    from riverbend.sources.readers import table_stream
    from riverbend.streaming import consumers, runner
    changes = tb.change_events_of(table_stream(spark, sf_dir, "events"))
    counts = consumers.window_counts(consumers.non_bot_changes(changes))
    out = runner.run_to_table(counts, "window-append")
    return consumers.flatten_window(runner.read_table(spark, out))


def window_append_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows from JSON change messages: decode, parse with the
    narrow change-event schema, epoch seconds to timestamp, non-bot filter,
    watermark, 20 s / 10 s windows, append sink with a checkpoint."""
    t = _t(spark, sf_dir)
    from riverbend.functions.time import epoch_seconds_to_ts
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import consumers, runner
    feed = scratch_path(spark, "change-feed")
    tb.change_messages(t).write.json(feed)
    stream = file_stream(spark, feed, "key string, value string", fmt="json", max_files_per_trigger=None)
    typed = records.parse_json(stream, records.CHANGE_EVENT_NARROW)
    changes = typed.select("type", "bot", epoch_seconds_to_ts("timestamp").alias("timestamp"))
    out = runner.run_to_table(consumers.window_counts(consumers.non_bot_changes(changes)), "window-json")
    return consumers.flatten_window(runner.read_table(spark, out))


def filtered_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language stream without one channel and without bots, five fields."""
    _t(spark, sf_dir)
    from riverbend.sources.readers import table_stream
    from riverbend.streaming import consumers, runner
    lang = tb.language_stream_of(table_stream(spark, sf_dir, "events"))
    out = runner.run_to_table(consumers.filtered_projection(lang, EXCLUDED_CHANNEL), "filtered")
    return runner.read_table(spark, out)


# Fixed value: the index mapping of the language stream (date, keyword, keyword, text).
LANG_INDEX_MAPPING = {"CREATEDAT": "date", "CHANNEL": "keyword", "WIKIPAGE": "keyword",
                      "USERNAME": "keyword", "DIFFURL": "text"}


def lang_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language-stream chain: filtered stream -> index documents with the
    mapped field types (message key not used) -> range + terms search on the
    index (top channels by count in a time range)."""
    _t(spark, sf_dir)
    from riverbend.sources.readers import table_stream
    from riverbend.sources.sinks import index_documents
    from riverbend.streaming import consumers, runner
    lang = tb.language_stream_of(table_stream(spark, sf_dir, "events"))
    docs = index_documents(consumers.filtered_projection(lang, EXCLUDED_CHANNEL), LANG_INDEX_MAPPING)
    index = runner.read_table(spark, runner.run_to_table(docs, "lang-index"))
    cond = search.epoch_millis_range(index, "CREATEDAT", SEARCH_GTE_MS, SEARCH_LTE_MS)
    return search.search(index, must=[cond], terms_field="CHANNEL", size=10)


def typed_change_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary key/value messages of the full change event as a stream: decoded,
    parsed with the whole schema, star-expanded, appended to a table."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import runner
    n = F.col("event_id")
    event = F.struct(
        n.alias("id"), F.col("event_type").alias("type"), (F.col("event_type") == "error").alias("bot"),
        F.col("user_id").cast("string").alias("user"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.struct(F.concat(F.lit("dom"), (n % 7).cast("string")).alias("domain")).alias("meta"),
        F.struct(n.alias("new"), (n - 1).alias("old")).alias("length"), F.struct((n * 2).alias("new")).alias("revision"),
        n.cast("string").alias("title"))
    feed = scratch_path(spark, "typed-feed")
    t.events.select(n.cast("string").cast("binary").alias("key"), F.to_json(event).cast("binary").alias("value")).write.parquet(feed)
    stream = file_stream(spark, feed, "key binary, value binary", fmt="parquet", max_files_per_trigger=None,
                         max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
    typed = records.parse_json(records.decode_kv(stream), records.CHANGE_EVENT_SCHEMA)
    out = runner.run_to_table(typed.where("id is not null"), "typed-changes")
    return runner.read_table(spark, out).select(
        "id", "type", "bot", "user", "timestamp", F.col("meta.domain").alias("meta_domain"), F.col("length.new").alias("length_new"),
        F.col("length.old").alias("length_old"), F.col("revision.new").alias("revision_new"), "title")


# micro-batches of the replayed feeds are cut by size
FEED_BYTES_PER_TRIGGER = 8 << 30


LEGACY_FEED_DDL = "value string, arrived timestamp"


def _legacy_messages(t: Tables) -> DataFrame:
    """Change events as JSON texts with their time of arrival."""
    changes = tb.change_events(t).withColumn("timestamp", F.unix_timestamp(F.col("timestamp").cast("timestamp")))
    message = F.to_json(F.struct(*[c for c in changes.columns if c not in ("props", "value")]))
    return changes.select(message.alias("value"), F.timestamp_seconds("timestamp").alias("arrived"))


def legacy_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events as JSON texts with their time of arrival; per micro-batch
    each is parsed once, the schema inferred, the ``bot`` and ``type`` columns
    looked for and non-bot events counted per type and 5 seconds; the counts
    are summed over 5-minute windows of the arrival clock."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import legacy
    feed = scratch_path(spark, "legacy-feed")
    _legacy_messages(t).write.parquet(feed)
    stream = file_stream(spark, feed, LEGACY_FEED_DDL, fmt="parquet", max_files_per_trigger=None, max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
    return legacy.windowed_type_counts(legacy.run_legacy_counts(stream, "legacy"))


def _cut_in_time(rows: DataFrame, clock: str, shares: tuple[float, ...]) -> list[DataFrame]:
    """``rows`` cut at these shares of the time they span."""
    ends = rows.agg(F.min(clock).alias("first"), F.max(clock).alias("last")).select(F.unix_micros("first"), F.unix_micros("last")).first()
    if ends[0] is None:
        return [rows]
    at = [int(ends[0] + (ends[1] - ends[0]) * share) for share in shares]
    micros = F.unix_micros(clock)
    bounds = [(None, at[0]), *zip(at, at[1:]), (at[-1], None)]
    return [rows.where((F.lit(True) if low is None else micros >= low) & (F.lit(True) if high is None else micros < high)) for low, high in bounds]


def legacy_live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages arriving in three parts: after each, the per-batch
    counts go to the state store of the sliding sums, which writes every sum
    that changed; the table holds what was written last."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import legacy
    feed = scratch_path(spark, "live-feed")
    live = legacy.LiveSums(spark, scratch_path(spark, "live-sums"))
    for part in _cut_in_time(_legacy_messages(t), "arrived", (0.4, 0.7)):
        part.write.mode("append").parquet(feed)
        live.advance(file_stream(spark, feed, LEGACY_FEED_DDL, fmt="parquet", max_files_per_trigger=None, max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER))
    return live.table()


def window_state_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 s / 10 s windows over a feed that stops in the middle of a window:
    the first run ends there, a second one resumes from the checkpoint.  The
    windows that the watermark closed come from the sink, those still open
    are read back from the state store's files."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import consumers, state
    feed, root = scratch_path(spark, "restart-feed"), scratch_path(spark, "restart-windows")
    changes = consumers.non_bot_changes(tb.change_events(t))
    for part in _cut_in_time(changes, "timestamp", (0.5,)):
        part.write.mode("append").parquet(feed)
        stream = file_stream(spark, feed, changes.schema, fmt="parquet", max_files_per_trigger=None, max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
        state.run_windows(consumers.window_counts(stream), root)
    return state.windows_with_state(spark, root)


def cdc_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CDC feed with every third message delivered again, in the same run
    and in the next: the duplicates are dropped by key and log position as
    the stream is applied.  The current rows, with how many messages of each
    row were applied."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import cdc, state
    feed, root = scratch_path(spark, "cdc-again"), scratch_path(spark, "cdc-once")
    messages, third = tb.cdc_messages(t), F.col("offset") % 3 == 0
    for rows in (messages.unionByName(messages.where(third)), messages.where(third)):
        rows.write.mode("append").json(feed)
        stream = file_stream(spark, feed, "key string, value string, offset long", fmt="json", max_files_per_trigger=None,
                             max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
        with state.rocksdb(spark):
            cdc.apply_stream(cdc.once(stream), root)
    return cdc.current_table(spark, root).join(cdc.applied(spark, root), "id")


def cdc_apply_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as CDC messages in JSON files, streamed and applied to a current
    table with ``foreachBatch``, in two runs on one root: every third message
    is written after the first run has ended."""
    t = _t(spark, sf_dir)
    from riverbend.session import scratch_path
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import cdc
    feed, root = scratch_path(spark, "cdc-feed"), scratch_path(spark, "cdc-state")
    messages, late = tb.cdc_messages(t), F.col("offset") % 3 == 0
    for part in (~late, late):
        messages.where(part).write.mode("append").json(feed)
        cdc.apply_stream(file_stream(spark, feed, "key string, value string, offset long", fmt="json", max_files_per_trigger=None,
                                     max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER), root)
    return cdc.current_table(spark, root)


# --------------------------------------------------------------------------
# F. text classification (no SQL oracle: model fitting and sampling)
# --------------------------------------------------------------------------

def _all_documents(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.col("text").alias("tweet"))


def _quality_labels(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", F.col("quality").alias("label"))


def lr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit the hashing-TF logistic pipeline on the labelled documents, save
    and reload it, and score every document."""
    t = _t(spark, sf_dir)
    from riverbend.operators import text_ml
    from riverbend.session import scratch_path
    model = text_ml.fit_hashed(text_ml.lr_pipeline(), _all_documents(t), _quality_labels(t))
    model = text_ml.save_and_reload(model, scratch_path(spark, "lr-model"))
    return text_ml.score(model, _all_documents(t))


def rf_stream_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random-forest pipeline fitted on the reference's training split (10 %,
    then 70 % of that), applied to a tweet feed: the documents as JSON
    ``{"tweet": ...}`` files; score bands counted per micro-batch."""
    t = _t(spark, sf_dir)
    from riverbend.operators import text_ml
    from riverbend.session import scratch_path
    from riverbend.sources import sinks
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import scoring
    model = text_ml.with_label_names(text_ml.fit_hashed(text_ml.rf_pipeline(), _all_documents(t), _quality_labels(t),
                                                        pick=text_ml.rf_training_rows))
    feed = scratch_path(spark, "tweet-feed")
    sinks.write_json(t.documents.select(F.col("text").alias("tweet")), feed, mode="errorifexists")
    stream = file_stream(spark, feed, "tweet string", fmt="json", max_files_per_trigger=None,
                         max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
    sink = scoring.score_stream(model, stream, "rf-bands")
    return (sinks.read_or_empty(spark, sink, scoring.BANDS_DDL).groupBy("clean_probability")
                 .agg(F.sum("count").alias("count")))


def block_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A foreign (numpy) model, its weights saved and loaded again, scored over
    every document in Arrow batches."""
    t = _t(spark, sf_dir)
    from riverbend.operators import text_ml
    from riverbend.session import scratch_path
    # features before the join: three numbers a row are shuffled, not texts
    features = text_ml.numeric_features(_all_documents(t)).drop("tweet")
    path = scratch_path(spark, "weights")
    text_ml.save_weights(spark, text_ml.fit_foreign_model(features.join(_quality_labels(t), "doc_id")), path)
    scores = text_ml.block_scores(_all_documents(t), text_ml.load_weights(spark, path))
    return scores.select("doc_id", F.round("proba", 6).cast("decimal(18,6)").alias("proba"))


def _labelled_numbers(spark: SparkSession, t: Tables) -> DataFrame:
    """Three numbers and the label of each labelled document, computed once: texts are not shuffled."""
    from riverbend.operators import text_ml
    numbers = text_ml.numeric_features(_all_documents(t)).drop("tweet")
    return materialize(numbers.join(_quality_labels(t), "doc_id"), "labelled-numbers")


def newton_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression of the quality label on three numbers of a
    document, fitted by Newton's method with one aggregate a step."""
    t = _t(spark, sf_dir)
    from riverbend.operators import newton, text_ml
    model = newton.fit(_labelled_numbers(spark, t), text_ml.NUMERIC_FEATURES, ridge=text_ml.LR_REG_PARAM)
    rows = [("intercept", model.intercept), *zip(model.features, model.coefficients, strict=True)]
    return spark.createDataFrame(rows, "term string, coefficient double").select("term", F.round("coefficient", 6).cast("decimal(18,6)").alias("coefficient"))


def newton_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by that model."""
    t = _t(spark, sf_dir)
    from riverbend.operators import newton, text_ml
    model = newton.fit(_labelled_numbers(spark, t), text_ml.NUMERIC_FEATURES, ridge=text_ml.LR_REG_PARAM)
    return text_ml.numeric_features(_all_documents(t)).select("doc_id", F.round(model.probability(), 6).cast("decimal(18,6)").alias("proba"))


def newton_stream_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That model applied to a tweet feed: the documents as JSON ``{"tweet": ...}``
    files, scored and counted by score band in every micro-batch."""
    t = _t(spark, sf_dir)
    from riverbend.operators import newton, text_ml
    from riverbend.session import scratch_path
    from riverbend.sources import sinks
    from riverbend.sources.readers import file_stream
    from riverbend.streaming import scoring
    model = newton.fit(_labelled_numbers(spark, t), text_ml.NUMERIC_FEATURES, ridge=text_ml.LR_REG_PARAM)
    feed = scratch_path(spark, "number-feed")
    sinks.write_json(t.documents.select(F.col("text").alias("tweet")), feed, mode="errorifexists")
    stream = file_stream(spark, feed, "tweet string", fmt="json", max_files_per_trigger=None, max_bytes_per_trigger=FEED_BYTES_PER_TRIGGER)
    sink = scoring.band_stream(text_ml.numeric_features(stream), "number-bands", probability=model.probability())
    return sinks.read_or_empty(spark, sink, scoring.BANDS_DDL).groupBy("clean_probability").agg(F.sum("count").alias("count"))


def lower_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipelines' tokens of every document: their number, and a hash of them."""
    t = _t(spark, sf_dir)
    from riverbend.operators import text_ml
    words = text_ml.lower_tokens(_all_documents(t))
    return words.select("doc_id", F.size("words").cast("long").alias("n_tokens"), F.md5(F.array_join("words", " ")).alias("tokens_md5"))


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-fold cross validation of the tf-idf random forest over 18 settings."""
    t = _t(spark, sf_dir)
    from riverbend.operators import text_ml
    results, _ = text_ml.grid_search(tb.labelled_documents(t), parallelism=8)
    return results


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded samples and a seeded 70/30 split of the labelled documents, by their ids."""
    t = _t(spark, sf_dir)
    from riverbend.operators import text_ml
    return text_ml.samples(t.documents.select("doc_id").join(t.labels.select("doc_id"), "doc_id"))


QUERIES = {
    "incident_report": incident_report,
    "incident_report_sql": incident_report_sql,
    "incident_report_csv": incident_report_csv,
    "median_monthly": median_monthly,
    "top3_types": top3_types,
    "code_name_head": code_name_head,
    "customer_weight": customer_weight,
    "customer_weight_upto": customer_weight_upto,
    "upsert_last": upsert_last,
    "search_must_not": search_must_not,
    "tweet_text_csv": tweet_text_csv,
    "json_append": json_append,
    "typed_change_stream": typed_change_stream,
    "file_log_once": file_log_once,
    "latest_file": latest_file,
    "ods_delta": ods_delta,
    "hub_delta": hub_delta,
    "sat_delta": sat_delta,
    "vault_current": vault_current,
    "vault_catalog": vault_catalog,
    "report_to_vault": report_to_vault,
    "key_check": key_check,
    "lookup_by_id": lookup_by_id,
    "lookup_by_attr": lookup_by_attr,
    "apply_changes": apply_changes,
    "cdc_parse": cdc_parse,
    "json_flatten": json_flatten,
    "guarded_counts": guarded_counts,
    "slide_300_10": slide_300_10,
    "stream_stats": stream_stats,
    "search_top10": search_top10,
    "label_balance": label_balance,
    "record_effects": record_effects,
    "replicated_join": replicated_join,
    "bloom_join": bloom_join,
    "newton_coefficients": newton_coefficients,
    "newton_scores": newton_scores,
    "newton_stream_bands": newton_stream_bands,
    "lower_tokens": lower_tokens,
    "tweet_labels_csv": tweet_labels_csv,
    "json_records": json_records,
    "score_bands": score_bands,
    "histogram10": histogram10,
    "clean_tokens": clean_tokens,
    "window_append_20_10": window_append_20_10,
    "window_append_json": window_append_json,
    "filtered_stream": filtered_stream,
    "lang_index_search": lang_index_search,
    "cdc_apply_stream": cdc_apply_stream,
    "legacy_type_counts": legacy_type_counts,
    "legacy_live_counts": legacy_live_counts,
    "window_state_restart": window_state_restart,
    "cdc_redelivered": cdc_redelivered,
    "lr_scores": lr_scores,
    "rf_stream_bands": rf_stream_bands,
    "block_scores": block_scores,
    "grid_search": grid_search,
    "samples": samples,
}
