"""Hit-level operators: dimension lookups, whitelists, session times (PIP2 parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrition.config import Params
from attrition.functions import recodes as R
from attrition.functions import time as TM
from attrition.functions import values as V


def session_id() -> F.Column:
    # upstream concatenates without a separator; kept so ids stay comparable
    return F.concat(F.col("id_ga"), F.col("visitId").cast("string"))


def with_session_dimensions(ga: DataFrame) -> DataFrame:
    """ARR3 + CND9: login flag (dimension 4) and customer id (dimension 68), first match or null."""
    return (ga.withColumn("logado", R.login_flag(R.first_dimension("customDimensions", V.LOGIN_DIMENSION)))
              .withColumn("idcliente", R.first_dimension("customDimensions", V.CUSTOMER_DIMENSION)))


def exploded_dimensions(ga: DataFrame, *keep: str) -> DataFrame:
    """ARR2 + CND5: one row per hit custom dimension; hits with null/empty arrays drop out."""
    return (ga.select(*keep, F.explode("hits.customDimensions").alias("custom_hit"))
            .withColumn("template_screen", R.dimension_value(F.col("custom_hit"), V.SCREEN_DIMENSION))
            .withColumn("depart_pageview", R.dimension_value(F.col("custom_hit"), V.DEPARTMENT_DIMENSION)))


def event_names(prefix: str = "hits.eventInfo.") -> dict[str, F.Column]:
    """FN12: category_action and category_action_label, nulls skipped."""
    cat, act, lab = (F.col(prefix + n) for n in ("eventCategory", "eventAction", "eventLabel"))
    return {"event_v1": F.concat_ws("_", cat, act), "event_v2": F.concat_ws("_", cat, act, lab)}


def action_columns(p: Params | None = None) -> dict[str, F.Column]:
    """CND6: the two action whitelists over the event names."""
    ev = event_names()
    return {"action_event_v1": R.whitelist(ev["event_v1"], V.ACTION_EVENTS_V1),
            "action_event_v2": R.whitelist(ev["event_v2"], V.ACTION_EVENTS_V2)}


def session_times(ga: DataFrame) -> DataFrame:
    """WIN2 + FN9 as a grouped aggregate: first/last hit text, parsed, and minutes between.

    The text is fixed-width, so min/max of the parsed times equal the parsed
    min/max text; aggregating timestamps keeps a hash aggregate (text min/max
    would force a sort-based one). Grouping with partial aggregation before the
    shuffle, instead of a window, keeps a very long session from landing whole
    in one task.
    """
    hit_time = F.try_to_timestamp("timestamp_hit")
    key = F.col("session_id") if "session_id" in ga.columns else session_id().alias("session_id")
    return (ga.groupBy(key)
            .agg(F.min(hit_time).alias("visitStartTime"), F.max(hit_time).alias("visitEndTime"))
            .withColumn("SessionVisitTime_minutes", TM.minutes_between("visitStartTime", "visitEndTime")))


NULL_BUCKET = -(1 << 40)  # below every real bucket: null hit numbers rank first, as ascending order puts them


def hit_rank(ga: DataFrame, bucket_size: int = 1024) -> DataFrame:
    """WIN3: dense rank of the hit number inside its session (computed upstream, never used).

    A plain window would hold a whole session in one task. Here the distinct
    (session, hit number) pairs are cut into buckets of `bucket_size`
    consecutive hit numbers: the rank is the row number inside the bucket
    (at most `bucket_size` rows per window group) plus the number of distinct
    hit numbers in the session's earlier buckets (one row per bucket). Null
    hit numbers get the first bucket, so they rank 1 like a nulls-first sort.
    """
    hits = ga.select(session_id().alias("session_id"), F.col("hits.HitNumber").alias("hit_number"))
    h = F.col("hit_number")
    bucket = F.when(h.isNull(), F.lit(NULL_BUCKET)).otherwise(F.floor(h / bucket_size)).cast("long")
    pairs = hits.distinct().withColumn("bucket", bucket)
    within = pairs.withColumn("r_in", F.row_number().over(Window.partitionBy("session_id", "bucket")
                                                          .orderBy("hit_number")))
    earlier = Window.partitionBy("session_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (pairs.groupBy("session_id", "bucket").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    cond = ((within["session_id"].eqNullSafe(offsets["session_id"])) & (within["bucket"] == offsets["bucket"]))
    ranks = within.join(offsets, cond).select(within["session_id"].alias("rs"), within["hit_number"].alias("rh"),
                                              (F.col("r_in") + F.col("offset")).cast("int").alias("hit_rank"))
    back = hits["session_id"].eqNullSafe(ranks["rs"]) & hits["hit_number"].eqNullSafe(ranks["rh"])
    return hits.join(ranks, back).select("session_id", "hit_number", "hit_rank")
