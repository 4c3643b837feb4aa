"""Classification of service errors, and run alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import variants as V

# What counts as worth a retry.
TRANSIENT_STATUS = (429, 500, 502, 503, 529)
TRANSIENT_TYPES = ("overloaded_error", "rate_limit_error", "api_error")


def error_type(body: Column) -> Column:
    """Lowered error type of a reply body (VARIANT), empty when it states none."""
    def filled(v: Column, path: str) -> Column:
        return F.nullif(F.try_variant_get(v, path, "string"), F.lit(""))

    inner = F.when(V.is_object(V.field(body, "error")), filled(body, "$.error.type"))
    outer = filled(body, "$.type")
    return F.lower(F.coalesce(inner, F.when(outer != "error", outer), F.lit("")))


def classify(events: DataFrame) -> DataFrame:
    """Add type, transient and missing-model flags and the report label.

    ``events`` has ``status_code``, ``body`` (JSON text) and ``message``. An
    error may arrive with status 200 in the middle of a stream, so the type in
    the body counts as much as the status.
    """
    status, message = F.col("status_code"), F.lower(F.coalesce("message", F.lit("")))
    typed = events.withColumn("error_type", F.coalesce(error_type(F.try_parse_json("body")), F.lit("")))
    kind = F.col("error_type")
    blob = F.concat(kind, F.lit(" "), message)
    known = F.coalesce(status, F.lit(-1))
    transient = (
        known.isin(*TRANSIENT_STATUS) | kind.isin(*TRANSIENT_TYPES)
        | F.contains(blob, F.lit("overloaded")) | F.contains(blob, F.lit("rate_limit"))
    )
    missing = (known == 404) | (
        (known == 400) & F.contains(message, F.lit("model")) & F.contains(message, F.lit("not_found"))
    )
    label = (
        F.when(known == 429, "rate limit exceeded")
        .when(known == 401, "authentication failed")
        .when((known == 400) & message.rlike("credit|billing"), "credits exhausted")
        .when(known == 400, "request error")
        .when(F.contains(kind, F.lit("overloaded")) | (known == 529), "overloaded")
        .when(F.contains(kind, F.lit("rate_limit")), "rate limited")
        .otherwise("api error")
    )
    return typed.withColumns({
        "transient": transient, "model_missing": missing, "label": label,
        "suggest_action": suggest_action(F.col("message")),
    })


def suggest_action(message: Column) -> Column:
    """Does the message hint at credits, rates or billing. Parts of words count."""
    return F.lower(F.coalesce(message, F.lit(""))).rlike("credit|rate|billing")


def error_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("label").agg(
        F.count("*").alias("n_events"),
        F.count_if("transient").alias("n_transient"),
        F.count_if("model_missing").alias("n_model_missing"),
    )


def alerts(runs: DataFrame) -> DataFrame:
    """Alert rows of runs with ``run, n_new, n_threads, n_to_build, n_built``."""
    found = F.filter(
        F.array(
            F.when(F.col("n_new") == 0, "no new articles"),
            F.when(F.col("n_threads") == 0, "no thread articles"),
            F.when((F.col("n_to_build") > 0) & (F.col("n_built") == 0), "no threads built"),
        ),
        lambda a: a.isNotNull(),
    )
    return runs.select("run", F.explode(found).alias("alert"))


def calendar(counts: DataFrame, after: int = 0) -> DataFrame:
    """Every day from the first to ``after`` days behind the last ``run`` that is a day."""
    day = F.try_to_date("run", "yyyy-MM-dd")
    span = counts.agg(F.min(day).alias("a"), F.date_add(F.max(day), after).alias("b")).filter("a IS NOT NULL")
    return span.select(F.explode(F.sequence("a", "b")).alias("d")).select(F.date_format("d", "yyyy-MM-dd").alias("run"))


def run_stats(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts of every run: of those in ``counts``, and zeros for others that have left no rows at all."""
    names = ("n_new", "n_threads", "n_to_build", "n_built")
    joined = runs.select("run").join(counts, "run", "full")
    return joined.select("run", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names])
