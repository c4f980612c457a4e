"""Install definition table (PIP1): one row per single install in the period.

Plan shape (all shuffles keyed, none on a single hot group):

* single installs: distinct install rows, a pre-aggregated `count` per
  advertising id (map-side combine, so a hot id is one row per map task) and a
  left-semi join back; no window, so no task ever buffers a whole id;
* history (JN1): a range join of the single installs against the earlier
  installs, reduced with a grouped count right after the join; an id has one
  single install, so the join has at most the rows of the history;
* uninstalls (JN2): an app id can have many of both, so nothing is paired;
  the uninstalls in an install's window are a difference of running counts
  (`intervals.py`).

Upstream multiplies the two fan-outs and then aggregates; here each side is
counted on its own and the product is taken arithmetically, which gives the
same numbers without materialising o × u rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.config import Params
from attrition.functions import recodes as R
from attrition.functions import time as TM
from attrition.functions import values as V
from attrition.operators.intervals import counts_within
from attrition.session import materialise
from attrition.sources import tables

INSTALL_COLUMNS = ["advertising_appsflyer", "appsflyer_id", "install_date", "install_date_sm",
                   "install_manha", "install_tarde", "install_noite", "install_madrugada",
                   "install_grouping", "install_channel", "install_source"]
DEFINITIVE_COLUMNS = ["advertising_appsflyer", "appsflyer_id", "install_date_sm",
                      "install_manha", "install_tarde", "install_noite", "install_madrugada",
                      "install_grouping", "install_channel", "install_source", "uninstall",
                      "total_installs_antigos", "recencia_last_install"]


def _in_period(p: Params):
    # A half-open date range instead of date_format(..) = 'yyyy-MM': same rows, and prunable.
    d = F.col("event_time_sm")
    return (d >= F.lit(p.period_start).cast("date")) & (d < F.date_add(F.lit(p.period_end).cast("date"), 1))


def install_rows(events: DataFrame, p: Params) -> DataFrame:
    """Distinct recoded install rows of the period (before the single-install test)."""
    return (events
            .filter(_in_period(p) & F.col("event_name").isin(*V.INSTALL_EVENTS) & R.valid_id("advertising_id"))
            .select(F.col("advertising_id").alias("advertising_appsflyer"),
                    "appsflyer_id",
                    TM.as_timestamp("event_time").alias("install_date"),
                    TM.as_date("event_time_sm").alias("install_date_sm"),
                    R.attribution_channel("atribuicao_canais").alias("install_grouping"),
                    F.col("channel").alias("install_channel"),
                    R.media_source("media_source", p.media_sources).alias("install_source"))
            .withColumns(R.daypart_flags(F.hour("install_date")))
            .dropDuplicates())


def single_installs(events: DataFrame, p: Params) -> DataFrame:
    """Install rows of advertising ids seen exactly once in the period (FLT10)."""
    rows = install_rows(events, p)
    once = (rows.groupBy("advertising_appsflyer").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") == 1).select("advertising_appsflyer"))
    return rows.join(once, "advertising_appsflyer", "left_semi").select(*INSTALL_COLUMNS)


@dataclass(frozen=True)
class Reach:
    """First and last instant of the single installs, in microseconds; what their history and uninstalls can lie between.

    They reach the driver as numbers: as local times they would be ambiguous in the hour that is repeated when summer time ends.
    """

    first: int | None
    last: int | None

    def earlier(self) -> F.Column:
        return F.lit(False) if self.last is None else TM.as_timestamp("event_time") < _instant(self.last)

    def uninstalled(self, window_days: int) -> F.Column:
        """After the first install, at most ``window_days`` after the last (the window ends at midnight)."""
        if self.first is None:
            return F.lit(False)
        t = TM.as_timestamp("event_time")
        return (t > _instant(self.first)) & (t <= F.date_add(_instant(self.last), window_days).cast("timestamp"))


def _instant(micros: int) -> F.Column:
    """A constant timestamp (folded before planning, so it is pushed down like a literal)."""
    return F.timestamp_micros(F.lit(micros).cast("long"))


def reach(single: DataFrame) -> Reach:
    """From the (materialised) single installs themselves: the period is a test on another column, the install day,
    which need not be the day of the install instant."""
    at = F.unix_micros("install_date")
    row = single.agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
    return Reach(row["first"], row["last"])


def earlier_installs(events: DataFrame, bound: Reach | None = None) -> DataFrame:
    """All install/reinstall instants per advertising id (any earlier period), distinct."""
    within = F.lit(True) if bound is None else bound.earlier()
    return (events
            .filter(F.col("event_name").isin(*V.INSTALL_EVENTS) & within & R.valid_id("advertising_id"))
            .select(F.col("advertising_id").alias("advertising_antigo"),
                    TM.as_timestamp("event_time").alias("install_date_antigo"))
            .dropDuplicates())


def uninstalls(events: DataFrame, bound: Reach | None = None, window_days: int = 8) -> DataFrame:
    """Uninstall instants per appsflyer id, distinct (given a bound, only those that some install can reach)."""
    within = F.lit(True) if bound is None else bound.uninstalled(window_days)
    return (events
            .filter(F.col("event_name").isin(*V.UNINSTALL_EVENTS) & within & R.valid_id("advertising_id"))
            .select(F.col("appsflyer_id").alias("appsflyer_id_un"),
                    TM.as_timestamp("event_time").alias("uninstall_date"))
            .dropDuplicates())


def _uninstall_condition(installs: DataFrame, un: DataFrame, window_days: int):
    return ((installs["appsflyer_id"] == un["appsflyer_id_un"])
            & (installs["install_date"] < un["uninstall_date"])
            # date_add truncates to the day: day+N 00:00:00 is inside, 00:00:01 is not
            & (F.date_add(installs["install_date"], window_days) >= un["uninstall_date"]))


def uninstall_matches(installs: DataFrame, un: DataFrame, window_days: int = 8) -> DataFrame:
    """JN2 as a literal left interval join: one row per uninstall in the window, or one null row."""
    return (installs.join(un, _uninstall_condition(installs, un, window_days), "left")
            .withColumn("uninstall", F.when(F.col("uninstall_date").isNotNull(), 1).otherwise(0)))


def history_stats(installs: DataFrame, old: DataFrame) -> DataFrame:
    """JN1 reduced per install: earlier distinct installs `o` and the latest one.

    Single installs are unique per advertising id, so the id is the row key.
    """
    cond = ((installs["advertising_appsflyer"] == old["advertising_antigo"])
            & (installs["install_date"] > old["install_date_antigo"]))
    return (installs.select("advertising_appsflyer", "install_date").join(old, cond, "inner")
            .groupBy("advertising_appsflyer")
            .agg(F.count(F.lit(1)).alias("n_old"), F.max("install_date_antigo").alias("last_install_antigo")))


def uninstall_stats(installs: DataFrame, un: DataFrame, window_days: int) -> DataFrame:
    """JN2 reduced per install: number `u` of distinct uninstalls inside the window (installs without any are left out)."""
    windows = installs.select(F.col("appsflyer_id").alias("key"), F.col("install_date").alias("after"),
                              F.date_add("install_date", window_days).cast("timestamp").alias("upto"), "advertising_appsflyer")
    found = counts_within(un.select(F.col("appsflyer_id_un").alias("key"), F.col("uninstall_date").alias("at")), windows,
                          "advertising_appsflyer")
    return found.withColumnRenamed("n", "n_uninstall")


def install_history(events: DataFrame, p: Params) -> DataFrame:
    """AGG1 without the uninstall fan-out: earlier installs and recency per single install."""
    single = single_installs(events, p)
    hist = history_stats(single, earlier_installs(events))
    return (single.join(hist, "advertising_appsflyer", "left")
            .select("advertising_appsflyer", "install_date_sm",
                    F.coalesce(F.col("n_old"), F.lit(0)).alias("total_installs_antigos"),
                    "last_install_antigo",
                    F.coalesce(F.datediff("install_date_sm", "last_install_antigo"), F.lit(-1))
                    .alias("recencia_last_install")))


def build_installs(attribution: DataFrame, p: Params) -> DataFrame:
    """PIP1: the install definition table, one row per single install in the period.

    ``attribution`` is the raw attribution event table; the brand/device/login
    filters are applied here. By default `total_installs_antigos` reproduces
    the upstream o × u fan-out; ``p.dedupe_uninstalls`` gives o.
    """
    events = tables.attribution_events(attribution, p, dedupe=False)
    # four consumers below: compute the single installs once
    single = materialise(single_installs(events, p), p.materialise, "single-installs")
    bound = reach(single) if p.materialise else None
    hist = history_stats(single, earlier_installs(events, bound))
    unc = uninstall_stats(single, uninstalls(events, bound, p.uninstall_window_days), p.uninstall_window_days)
    n_old = F.coalesce(F.col("n_old"), F.lit(0))
    n_un = F.coalesce(F.col("n_uninstall"), F.lit(0))
    total = n_old if p.dedupe_uninstalls else n_old * F.greatest(n_un, F.lit(1))
    return (single.join(hist, "advertising_appsflyer", "left")
            .join(unc, "advertising_appsflyer", "left")
            .select("advertising_appsflyer", "appsflyer_id", "install_date_sm",
                    "install_manha", "install_tarde", "install_noite", "install_madrugada",
                    "install_grouping", "install_channel", "install_source",
                    F.when(n_un > 0, 1).otherwise(0).alias("uninstall"),
                    total.cast("long").alias("total_installs_antigos"),
                    F.coalesce(F.datediff("install_date_sm", "last_install_antigo"), F.lit(-1))
                    .alias("recencia_last_install")))


def sample_range(installs: DataFrame, p: Params) -> DataFrame:
    """FLT8: installs whose install day is inside [sample_start, sample_end]."""
    d = F.col("install_date_sm")
    return installs.filter(d.between(F.lit(p.sample_start).cast("date"), F.lit(p.sample_end).cast("date")))
