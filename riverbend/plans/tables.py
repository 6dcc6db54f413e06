"""Loading the driver tables and shaping them into the reference's inputs.

Each ``*_from_tables`` function maps driver tables onto one input schema of
the reference (FIXTURES.md section 2).  They only project, join and cast;
they never subset rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



class Tables:
    """Lazy parquet readers for ``{sf_dir}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"


def money(col: str) -> F.Column:
    """A double amount as an exact two-decimal value (``decimal(18,2)``: held
    in a long, so sums stay on the fast path)."""
    return F.col(col).cast("decimal(18,2)")


def supplier_district(t: Tables) -> DataFrame:
    """``(s_suppkey, DISTRICT)``: a supplier's nation name."""
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("DISTRICT"))
    return (t.supplier.select("s_suppkey", "s_nationkey")
             .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
             .select("s_suppkey", "DISTRICT"))


def incidents_from_tables(t: Tables) -> DataFrame:
    """Incidents: one per lineitem; code = part, district = supplier's nation,
    month of the ship date, location = (extended price, discount)."""
    facts = incident_facts(t)
    district = supplier_district(t)
    return (facts.join(district, facts["l_suppkey"] == district["s_suppkey"], "left")
                 .select("DISTRICT", "OFFENSE_CODE", "MONTH", "LAT", "LONG"))


def incident_facts(t: Tables) -> DataFrame:
    """Incidents before the district lookup: ``l_suppkey`` names the district
    through the supplier dimension (see ``supplier_district``)."""
    return t.lineitem.select(
        F.col("l_partkey").alias("OFFENSE_CODE"),
        "l_suppkey",
        F.month("l_shipdate").alias("MONTH"),
        money("l_extendedprice").alias("LAT"),
        money("l_discount").alias("LONG"),
    )


def codes_from_tables(t: Tables) -> DataFrame:
    """Offence codes: part key and part name."""
    return t.part.select(F.col("p_partkey").alias("CODE"), F.col("p_name").alias("NAME"))


# ---------------------------------------------------------------- warehouse

FIRST_LOAD_REGIONS = ("AFRICA", "AMERICA")


def _stage_by_nation(t: Tables, rows: DataFrame, nation_col: str, name_col: str,
                     bal_col: str) -> DataFrame:
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("District"))
    joined = rows.join(nation, rows[nation_col] == nation["n_nationkey"], "inner")
    return joined.groupBy("District").agg(
        F.count(F.lit(1)).alias("Crimes_total"),
        F.sum(F.when(F.col(bal_col) > 0, 1).otherwise(0)).cast("long").alias("Crimes_monthly"),
        F.min(name_col).alias("Frequent_crime_types"),
        F.min(bal_col).cast("decimal(18,2)").cast("decimal(37,15)").alias("Lat"),
        F.max(bal_col).cast("decimal(18,2)").cast("decimal(37,15)").alias("Lng"),
    )


def stage_from_supplier(t: Tables) -> DataFrame:
    """Staged district metrics: suppliers grouped by nation."""
    return _stage_by_nation(t, t.supplier, "s_nationkey", "s_name", "s_acctbal")


def stage_from_customer(t: Tables) -> DataFrame:
    """A second, later stage of the same shape: customers grouped by nation."""
    return _stage_by_nation(t, t.customer, "c_nationkey", "c_name", "c_acctbal")


def districts_of_regions(t: Tables, regions) -> DataFrame:
    region = t.region.filter(F.col("r_name").isin(list(regions))).select("r_regionkey")
    return (t.nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
                    .select(F.col("n_name").alias("District")))


# ---------------------------------------------------------------- events

def change_events(t: Tables) -> DataFrame:
    return change_events_of(t.events)


def change_events_of(events: DataFrame) -> DataFrame:
    """Events as page-change events: ``type``, ``bot`` (error events are
    bots), ``timestamp`` (event time), ``user``, ``id``."""
    return events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("type"),
        (F.col("event_type") == "error").alias("bot"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("user"),
        F.col("value"),
        F.col("props"),
    )


def change_messages(t: Tables) -> DataFrame:
    """Events as change-feed messages: ``key`` = event id, ``value`` = the
    change event as JSON (epoch-second ``timestamp``, as on the feed)."""
    ev = change_events(t)
    body = F.struct(F.col("bot"), F.col("id"), F.col("type"), F.col("user"),
                    F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("timestamp"))
    return ev.select(F.col("id").cast("string").alias("key"), F.to_json(body).alias("value"))


def language_stream_of(events: DataFrame) -> DataFrame:
    """Events as the language stream: created-at millis, channel (event type),
    user name, page (the props text), diff url (event id), bot flag."""
    return events.select(
        F.unix_millis(F.col("ts").cast("timestamp")).alias("CREATEDAT"),
        F.col("event_type").alias("CHANNEL"),
        F.col("user_id").cast("string").alias("USERNAME"),
        F.col("props").alias("WIKIPAGE"),
        F.col("event_id").cast("string").alias("DIFFURL"),
        (F.col("event_type") == "error").alias("ISBOT"),
    )


def event_ops(t: Tables) -> DataFrame:
    """Events as row changes keyed by user: signup creates, error deletes,
    everything else updates."""
    op = (F.when(F.col("event_type") == "signup", "c")
           .when(F.col("event_type") == "error", "d").otherwise("u"))
    return t.events.withColumn("op", op)


def cdc_messages(t: Tables) -> DataFrame:
    """Events as CDC messages: ``key``, ``value`` (the envelope as JSON) and
    ``offset``.  A delete follows an update of the same row in the same
    transaction; every second creation is a snapshot row, which has no
    transaction.  The log position grows with the event id."""
    steps = F.when(F.col("op") == "d", F.array(F.lit("u"), F.lit("d"))).when(
        (F.col("op") == "c") & (F.col("event_id") % 2 == 0), F.array(F.lit("r"))).otherwise(F.array(F.col("op")))
    ev = event_ops(t).select("*", F.posexplode(steps).alias("step", "code"))
    row = F.struct(F.col("user_id").cast("int").alias("id"),
                   F.col("event_type").alias("first_name"),
                   F.col("event_id").cast("string").alias("last_name"),
                   F.col("props").alias("email"))
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    offset = F.col("event_id") * 10 + F.col("step")
    snapshot = F.col("code") == "r"
    payload = F.struct(
        F.when(~F.col("code").isin("c", "r"), row).alias("before"),
        F.when(F.col("code") != "d", row).alias("after"),
        F.struct(F.lit("shop").alias("db"), F.lit("events").alias("table"),
                 F.when(~snapshot, F.col("event_id")).alias("txId"), offset.alias("lsn"),
                 (ts_ms * 1000).alias("ts_usec"), snapshot.alias("snapshot")).alias("source"),
        F.col("code").alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return ev.select(F.col("event_id").cast("string").alias("key"),
                     F.to_json(F.struct(payload.alias("payload"))).alias("value"), offset.alias("offset"))


# ---------------------------------------------------------------- keyed

def customer_store(t: Tables) -> DataFrame:
    """Customer value records: id, secondary attribute (the nation key as
    text, shared by many customers), lifetime value."""
    return t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_nationkey").cast("string").alias("phone"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("ltv"),
    )


# ---------------------------------------------------------------- text

def labelled_documents(t: Tables) -> DataFrame:
    """``(doc_id, label, tweet)``: labelled documents, label = quality."""
    return (t.documents.select("doc_id", F.col("text").alias("tweet"))
             .join(t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id", "inner"))
