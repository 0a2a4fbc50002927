"""Claims-domain views over the star-schema test tables.

The engine itself never depends on these; they give tests, benchmarks and registered queries
members, providers, claims, notes and predictions derived from whole tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import constants as C


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def _code(prefix: str, key: str, width: int) -> Column:
    text = F.col(key).cast("string")
    # lpad would cut longer keys, so it is applied only where the key is short
    return F.concat(
        F.lit(prefix), F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    )


def _choice(key: Column, values: dict, default) -> Column:
    chain = None
    for value, label in values.items():
        chain = F.when(key == value, label) if chain is None else chain.when(key == value, label)
    return chain.otherwise(default)


def claims(spark: SparkSession, base: str) -> DataFrame:
    """One claim per order; its lines give provider, codes, procedure count and the fraud mark."""
    lines = (
        table(spark, base, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.min("l_suppkey").alias("suppkey"),
            F.min("l_partkey").alias("partkey"),
            F.min("l_quantity").alias("quantity"),
            F.max("l_discount").alias("discount"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        )
    )
    part = table(spark, base, "part").select("p_partkey", "p_type", "p_brand")
    joined = (
        table(spark, base, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(part, F.col("partkey") == F.col("p_partkey"), "left")
    )
    on_twelve = F.col("o_orderkey") % 12 == 0
    return joined.select(
        _code("CLM", "o_orderkey", 7).alias("claim_id"),
        _code("MBR", "o_custkey", 6).alias("member_id"),
        F.when(F.col("suppkey").isNotNull(), _code("PRV", "suppkey", 4)).alias("provider_id"),
        F.col("o_orderdate").cast("date").alias("claim_date"),
        _choice(
            F.col("o_orderpriority"),
            {"1-URGENT": "Emergency", "2-HIGH": "Inpatient", "3-MEDIUM": "Outpatient", "5-LOW": "Pharmacy"},
            "Lab",
        ).alias("claim_type"),
        F.col("p_type").alias("diagnosis_code"),
        F.col("p_brand").alias("procedure_code"),
        F.col("o_totalprice").alias("claim_amount"),
        F.when((F.col("o_orderstatus") != "P") & ~on_twelve, F.col("o_totalprice") * 0.8)
        .otherwise(0.0)
        .alias("approved_amount"),
        F.when(F.col("o_orderstatus") == "P", "Denied")
        .when(on_twelve, "Pending")
        .otherwise("Approved")
        .alias("claim_status"),
        F.when(
            F.col("o_orderpriority") == "2-HIGH", F.coalesce(F.col("quantity").cast("int") % 15, F.lit(0))
        )
        .otherwise(0)
        .alias("days_in_hospital"),
        F.coalesce("n_lines", F.lit(1)).cast("int").alias("num_procedures"),
        (F.col("o_custkey") % 2).cast("int").alias("prior_auth"),
        F.coalesce(((F.col("discount") >= 0.10) & (F.col("n_returned") >= 3)).cast("int"), F.lit(0)).alias(
            "is_fraud"
        ),
    )


def members(spark: SparkSession, base: str) -> DataFrame:
    nation = table(spark, base, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey")
    return (
        table(spark, base, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _code("MBR", "c_custkey", 6).alias("member_id"),
            (18 + key % 68).cast("int").alias("age"),
            _choice(key % 3, {0: "M", 1: "F"}, "Other").alias("gender"),
            F.col("n_name").alias("state"),
            F.when(key % 50 != 0, 15 + (F.col("c_acctbal") + 1000) / 11000 * 40).alias("bmi"),
            (key % 11 < 2).cast("int").alias("smoker"),
            _choice(
                F.col("c_mktsegment"),
                {"AUTOMOBILE": "Bronze", "BUILDING": "Silver", "FURNITURE": "Gold", "HOUSEHOLD": "Platinum"},
                "Silver",
            ).alias("plan_type"),
            (1 + (key * 7) % 120).cast("int").alias("tenure_months"),
            (key % 4).cast("int").alias("num_chronic_conditions"),
            (3000 + F.abs("c_acctbal") * 1.5).alias("annual_premium"),
            _choice(key % 5, {0: 500, 1: 1000, 2: 2000, 3: 3500}, 5000).alias("deductible"),
        )
    )


def providers(spark: SparkSession, base: str) -> DataFrame:
    nation = table(spark, base, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, base, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            _code("PRV", "s_suppkey", 4).alias("provider_id"),
            F.col("s_name").alias("provider_name"),
            _choice(
                F.col("s_suppkey") % 5,
                {0: "Hospital", 1: "Clinic", 2: "Specialist", 3: "Lab"},
                "Pharmacy",
            ).alias("provider_type"),
            F.col("n_name").alias("state"),
        )
    )


def _in_turn(words: Sequence[str], key: Column) -> Column:
    """The listed words one after another as ``key`` goes up."""
    return F.get(F.array(*[F.lit(w) for w in words]), (key % len(words)).cast("int"))


def notes(spark: SparkSession, base: str) -> DataFrame:
    """One note per document: its whole text, then an abbreviation and a keyword of the diagnosis rules in turn."""
    key = F.col("doc_id")
    keywords = [*[word for word, _, _ in C.DIAGNOSIS_RULES], "wellness"]
    closing = F.concat(F.upper(_in_turn(tuple(C.ABBREVIATIONS), key)), F.lit(", "), _in_turn(keywords, key), F.lit("!"))
    return table(spark, base, "documents").select(
        _code("NOTE", "doc_id", 6).alias("note_id"),
        F.format_string("MBR%06d", key % 100 + 1).alias("member_id"),
        F.date_add(F.lit("1997-01-01").cast("date"), (key % 730).cast("int")).alias("note_date"),
        F.concat(F.coalesce("text", F.lit("")), F.lit(" "), closing).alias("clinical_note"),
    )


def feedback(spark: SparkSession, base: str) -> DataFrame:
    """Every turn of every conversation, closed by two of the sentiment words in turn."""
    words = [*C.TOKEN_POSITIVE, *C.TOKEN_NEGATIVE, *C.SUBSTRING_NEGATIVE, "nothing"]
    first, second = F.col("conv_id") * 3 + F.col("turn"), F.col("conv_id") + F.col("turn") * 5
    return table(spark, base, "conversations").select(
        "conv_id",
        "turn",
        F.concat(
            F.coalesce("text", F.lit("")), F.lit(" "), F.upper(_in_turn(words, first)), F.lit(" "), _in_turn(words, second)
        ).alias("text"),
    )


def _versions() -> Column:
    """One scoring run per claim, two for every tenth claim."""
    both = F.array(F.lit("v1"), F.lit("v2"))
    return F.explode(F.when(F.col("o_orderkey") % 10 == 0, both).otherwise(F.array(F.lit("v1"))))


def claim_predictions(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").select(
        _code("CLM", "o_orderkey", 7).alias("claim_id"),
        _code("MBR", "o_custkey", 6).alias("member_id"),
        _versions().alias("model_version"),
        ((F.col("o_orderkey") % 100).cast("double") / 100).alias("risk_score"),
    )


def fraud_predictions(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "orders").select(
        _code("CLM", "o_orderkey", 7).alias("claim_id"),
        _versions().alias("model_version"),
        ((F.col("o_orderkey") % 97).cast("double") / 97).alias("anomaly_score"),
    )


def claim_requests(spark: SparkSession, base: str) -> DataFrame:
    """Incoming claim requests; some break a rule and some leave optional fields out."""
    key = F.substring("claim_id", 4, 20).cast("long")
    enriched = claims(spark, base).join(members(spark, base), "member_id", "left")
    return enriched.select(
        "claim_id",
        "member_id",
        F.when(key % 29 == 0, -F.col("claim_amount")).otherwise(F.col("claim_amount")).alias("claim_amount"),
        "claim_type",
        F.coalesce("diagnosis_code", F.lit("NONE")).alias("diagnosis_code"),
        F.coalesce("procedure_code", F.lit("NONE")).alias("procedure_code"),
        F.when(key % 13 != 0, F.col("num_procedures")).alias("num_procedures"),
        F.when(key % 17 != 0, F.col("days_in_hospital")).alias("days_in_hospital"),
        "prior_auth",
        F.when(key % 31 == 0, F.col("age") + 90).otherwise(F.col("age")).cast("int").alias("member_age"),
        F.col("bmi").alias("member_bmi"),
        F.col("smoker").alias("member_smoker"),
        F.when(key % 7 != 0, F.col("plan_type")).alias("member_plan"),
        F.col("num_chronic_conditions").alias("num_chronic"),
        F.when(key % 11 != 0, F.col("state")).alias("state"),
    )


def plan_requests(spark: SparkSession, base: str) -> DataFrame:
    """Members asking for a plan; income follows the member key, every ninth leaves it out."""
    key = F.substring("member_id", 4, 20).cast("long")
    return members(spark, base).select(
        "member_id",
        "age",
        "bmi",
        "num_chronic_conditions",
        "tenure_months",
        "annual_premium",
        "deductible",
        F.when(key % 9 != 0, (key % 10) / 10).alias("income_score"),
    )
