"""A feature store in one folder: the jobs that tie operators and stored tables together."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import moment
from tidemark.operators import (
    asof,
    backfill,
    distribution,
    lineage,
    model_quality,
    online,
    registry,
    retrieval,
    run_log,
    training,
)
from tidemark.operators.features import feature_vector
from tidemark.schemas import VERSION
from tidemark.sources import definitions, online_log, tables
from tidemark.streaming.refresh import refresh_online


def _clock() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class FeatureStore:
    """Every method takes the time it should act at; only run records read the clock.

    `root` is a folder that all executors reach. Results come back as DataFrames; the jobs that
    write give back a small summary.
    """

    def __init__(self, spark: SparkSession, root: str, version: str = VERSION):
        self.spark, self.root, self.version = spark, root.rstrip("/"), version

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.root, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _raw(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The raw tables, with one row per user: no key keeps copies out of the users table.

        Of several rows the one created last counts, then the one with the largest values.
        """
        users, transactions, tickets = tables.raw_tables(self.spark, self.root)
        rest = [c for c in users.columns if c not in ("user_id", "created_at")]
        newest = users.groupBy("user_id").agg(F.max(F.struct("created_at", *rest)).alias("_row"))
        return newest.select("user_id", "_row.*").select(*users.columns), transactions, tickets

    def _online(self) -> DataFrame:
        return online_log.read_online(self.spark, self.path("online_features"))

    def load_raw(self, users: DataFrame, transactions: DataFrame, tickets: DataFrame) -> DataFrame:
        return tables.load_raw(
            self.root, raw_users=users, raw_transactions=transactions, raw_support_tickets=tickets
        )

    def entity_ids(self) -> DataFrame:
        return self._raw()[0].select("user_id").distinct().orderBy("user_id")

    # History

    def compute_features(self, snapshot: datetime) -> DataFrame:
        """Store one snapshot; gives the number of rows stored for it."""
        features = feature_vector(*self._raw(), snapshot, self.version)
        tables.append_history(self.path("feature_history"), features, snapshot, snapshot, snapshot, unique=True)
        return tables.snapshot_row_count(self.table("feature_history"), snapshot, self.version)

    def run_backfill(self, now: datetime, days: int = 90, interval_hours: int = 24, dry_run: bool = False) -> DataFrame:
        """Store all snapshots of the grid that are missing, in one job, and log each of them.

        Returns the plan: each snapshot with its state before the run. Running it again after a
        failure continues where rows are missing; a row that is stored is never rewritten.
        """
        now = now.replace(minute=0, second=0, microsecond=0)
        anchor = self.spark.range(1).select(moment(now).alias("now"))
        spine = backfill.spine_from(anchor, "now", days, interval_hours)
        # One row per snapshot of the grid; kept apart from the history that is about to change.
        expected = self._raw()[0].count()
        stored = tables.scan_history(
            self.table("feature_history"), self.version, backfill.spine_start(now, days, interval_hours), now
        )
        states = backfill.backfill_plan(spine, stored, self.version, expected).collect()
        plan = self.spark.createDataFrame(states, "event_time timestamp_ntz, stored_rows bigint, state string")
        missing = [s["event_time"] for s in states if s["state"] != "stored"]
        if dry_run or not missing:
            return plan
        started = _clock()
        pending = plan.where("state <> 'stored'").select("event_time")
        first, steps = min(missing), (max(missing) - min(missing)) // timedelta(hours=interval_hours)
        fresh = backfill.history_on_grid(*self._raw(), first, steps, interval_hours, self.version, only=missing)
        try:
            tables.append_history(self.path("feature_history"), fresh, now, first, max(missing), unique=True)
        except Exception as error:
            failed = pending.withColumns({"processed": F.lit(0), "entities_failed": F.lit(1)})
            self._log(failed, "failed", started, str(error))
            raise
        stored = tables.scan_history(self.table("feature_history"), self.version, first, max(missing))
        per_snapshot = stored.groupBy("event_time").agg(F.count(F.lit(1)).alias("processed"))
        done = pending.join(per_snapshot, "event_time").withColumn("entities_failed", F.lit(0))
        self._log(done, "success", started, None)
        return plan

    def _log(self, runs: DataFrame, status: str, started: datetime, error: str | None) -> None:
        """Append a record for each row of `runs` (processed, entities_failed, perhaps run_id)."""
        if "run_id" not in runs.columns:
            runs = runs.withColumn("run_id", F.substring(F.expr("uuid()"), 1, 8))
        timed = runs.withColumns({
            "status": F.lit(status),
            "error": F.lit(error),
            "started_at": moment(started),
            "completed_at": moment(_clock()),
        })
        tables.append(self.path("materialization_log"), run_log.run_records(timed, self.version))

    def latest_features(self, ids: DataFrame, as_of: datetime) -> DataFrame:
        return asof.latest_for_ids(self.table("feature_history"), ids, as_of, self.version)

    def training_dataset(self, labels: DataFrame) -> DataFrame:
        return asof.pit_join(labels, self.table("feature_history"), self.version)

    def feature_stats(self, as_of: datetime, since_days: int = 7) -> DataFrame:
        return distribution.feature_stats(
            distribution.window_rows(self.table("feature_history"), as_of, since_days, self.version)
        )

    # Online table

    def run_materialization(self, as_of: datetime) -> dict:
        """Newest rows into the online table; rows that break a rule go to `quarantine` instead."""
        started, run_id = _clock(), uuid.uuid4().hex[:12]
        try:
            return self._materialize(as_of, started, run_id)
        except Exception as error:
            failed = self.spark.range(1).select(F.lit(run_id).alias("run_id"), F.lit(0).alias("processed")).join(
                self._raw()[0].agg(F.count_distinct("user_id").alias("entities_failed"))
            )
            self._log(failed, "failed", started, str(error))
            raise

    def _materialize(self, as_of: datetime, started: datetime, run_id: str) -> dict:
        checked_path = f"{self.path('checked_features')}/{run_id}"
        history = tables.only_latest_snapshots(self.table("feature_history"), as_of, self.version)
        online.materialize_rows(history, as_of, self.version).write.parquet(checked_path)
        try:
            checked = self.spark.read.parquet(checked_path)
            good = online.as_online(checked.where(F.size("violations") == 0), as_of)
            bad = checked.where(F.size("violations") > 0)
            tables.append(self.path("quarantine"), bad.withColumns({"run_id": F.lit(run_id), "quarantined_at": moment(as_of)}))
            online_log.write_online(self.spark, self.path("online_features"), good, unique=True)
            summary = online.materialize_summary(self._raw()[0].select("user_id"), checked).first().asDict()
        finally:
            tables.delete_path(self.spark, checked_path)
        record = self.spark.createDataFrame(
            [(run_id, summary["processed"], summary["validation_failures"])],
            "run_id string, processed bigint, entities_failed bigint",
        )
        self._log(record, summary["status"], started, None)
        return {"run_id": run_id, **summary}

    def refresh_online(self, as_of: datetime) -> None:
        """As `run_materialization`, into the same table, but only for history files that arrived since the last call."""
        refresh_online(
            self.spark, self.path("feature_history"), self.path("online_features"), self.path("refresh_checkpoint"),
            as_of, self.version,
        )

    def online_features(self, ids: DataFrame, as_of: datetime) -> DataFrame:
        return online.lookup(self._online(), ids, as_of, self.version)

    def online_size(self, as_of: datetime) -> DataFrame:
        return online.size(self._online(), as_of)

    def delete_online(self, ids: DataFrame) -> None:
        online_log.delete_online(self.spark, self.path("online_features"), ids)

    def write_online(self, rows: DataFrame, as_of: datetime) -> None:
        """Merge rows (entity_type, entity_id, feature_version, features, event_time)."""
        online_log.write_online(self.spark, self.path("online_features"), online.as_online(rows, as_of))

    def features_for(self, ids: DataFrame, as_of: datetime) -> DataFrame:
        return retrieval.dual_path_batch(self._online(), *self._raw(), ids, as_of, self.version)

    # Drift, labels, registry, lineage, logs

    def snapshot_training_distribution(self, as_of: datetime, since_days: int = 7) -> None:
        self._snapshot("training", as_of, since_days)

    def snapshot_serving_distribution(self, as_of: datetime, since_days: int = 1) -> None:
        self._snapshot("serving", as_of, since_days)

    def _snapshot(self, context: str, as_of: datetime, since_days: int) -> None:
        """Log the statistics of a window and, for training, its values: the baseline of later reports."""
        history, name = self.table("feature_history"), uuid.uuid4().hex[:12]
        rows = distribution.skew_snapshot(history, context, as_of, since_days, name, self.version)
        tables.append(self.path("skew_snapshots"), rows)
        if context == "training":
            values = distribution.baseline(history, context, as_of, since_days, name, self.version)
            tables.append(self.path("skew_baselines"), values)

    def skew_report(
        self, as_of: datetime, trained_at: datetime | None = None, serving_days: int = 1, training_days: int = 7
    ) -> DataFrame:
        """Serving window up to `as_of` against the baseline of the training snapshot logged last, or
        against the history of the window up to `trained_at`; the serving statistics go to the log."""
        history = self.table("feature_history")
        if trained_at is None:
            logged = self.table("skew_baselines").where((F.col("feature_version") == self.version) & (F.col("context") == "training"))
            if logged.isEmpty():
                raise ValueError("no training distribution is logged: take a snapshot or give trained_at")
            training_side = distribution.latest_baseline(logged, "training", self.version)
        else:
            training_side = distribution.long_form(distribution.window_rows(history, trained_at, training_days, self.version))
        self._snapshot("serving", as_of, serving_days)
        serving = distribution.window_rows(history, as_of, serving_days, self.version)
        return distribution.skew_report_of(training_side, distribution.long_form(serving))

    def churn_labels(self, now: datetime, first_n: int | None = None) -> DataFrame:
        """Labels 30 days before `now`, the last moment whose 30 days after are known; of all users
        unless `first_n` keeps those with the smallest ids."""
        users, transactions, _ = self._raw()
        return training.churn_labels(users, transactions, now - timedelta(days=30), first_n=first_n)

    def pit_training_set(self, labels: DataFrame) -> DataFrame:
        return training.pit_training_set(labels, self.table("feature_history"), self.version)

    def leakage_audit(self, labels: DataFrame, as_of: datetime) -> DataFrame:
        return training.leakage_audit(labels, self.table("feature_history"), as_of, self.version)

    def train(self, labels: DataFrame, as_of: datetime) -> DataFrame:
        """Fit and evaluate a model on point-in-time features and, beside it, one on the newest features at
        `as_of`, as `model_quality.compare_models`; the scored test rows go to the table `model_scores`."""
        history = self.table("feature_history")
        sets = {
            "point_in_time": training.pit_training_set(labels, history, self.version),
            "naive": training.naive_training_set(labels, history, as_of, self.version),
        }
        scores = model_quality.score_models(sets)
        tables.append(self.path("model_scores"), scores.withColumn("trained_at", moment(as_of)))
        return model_quality.compare_models(scores)

    def sync_registry(self, at: datetime) -> None:
        tables.replace_version(self.path("feature_registry"), definitions.registry_rows(self.spark, at, self.version))
        tables.replace_version(self.path("lineage_edges"), definitions.lineage_rows(self.spark, at, self.version))

    def registry(self) -> DataFrame:
        return registry.listing(self.table("feature_registry"), self.version)

    def lineage(self) -> DataFrame:
        return lineage.edges(self.table("lineage_edges"), self.version)

    def lineage_for(self, feature: str) -> DataFrame:
        return lineage.for_feature(self.table("lineage_edges"), feature, self.version)

    def lineage_subgraph(self, feature: str) -> DataFrame:
        """The feature, everything it comes from and feeds into, and its siblings."""
        return lineage.subgraph(self.table("lineage_edges"), feature, self.version)

    def recent_runs(self, limit: int = 50) -> DataFrame:
        return run_log.recent_runs(self.table("materialization_log"), limit)

    def log_requests(self, requests: DataFrame) -> None:
        tables.append(self.path("request_log"), requests)

    def latency(self) -> DataFrame:
        return run_log.latency_percentiles(self.table("request_log"))

    def metrics(self, as_of: datetime) -> DataFrame:
        """One row per serving path, also for those without requests, with the hit rate and the online size."""
        return run_log.serving_metrics(self.table("request_log"), self.online_size(as_of))

    def cache_hit_rate(self) -> DataFrame:
        return run_log.cache_hit_rate(self.table("request_log"))
