"""All tables of the platform over one source, as lazy plans that depend on each other."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import FEATURE_LEXICON, Scorer, lexicon_scorer
from ..operators import features, mlops, serving
from ..sources import adapter
from ..sources.ops_adapter import INPUTS, ops_table

AS_OF = datetime.date(2001, 8, 1)

# Names of the published tables, and of those that say when they were refreshed.
#: What each table is made of; a published copy replaces the plan.
PUBLISHED = (
    "logs_base", "summaries_base", "messages_base", "features_player_match", "features_player_recent_form", "serving_player_profiles", "serving_map_overview_daily",
    "serving_player_match_deep_dive", "serving_ml_model_registry", "serving_ml_pipeline_progress_daily", "serving_ml_prediction_quality_daily",
)


#: Tables that say when they were refreshed.
STAMPED = ("serving_player_profiles", "serving_map_overview_daily", "serving_player_match_deep_dive", "serving_ml_model_registry", "serving_ml_pipeline_progress_daily", "serving_ml_prediction_quality_daily")


def stamped(df: DataFrame, at: datetime.datetime) -> DataFrame:
    return df.withColumn("updated_at", F.to_timestamp_ntz(F.lit(f"{at:%Y-%m-%d %H:%M:%S.%f}")))  # the same in any time zone


class Tables(Mapping[str, DataFrame]):
    """A table is planned when first asked for and kept; ``replace`` puts a written copy in its place, so that
    what depends on it reads that copy."""

    def __init__(self, spark: SparkSession, sf_dir: str, lexicon: str = FEATURE_LEXICON, as_of: datetime.date = AS_OF, scorer: Scorer | None = None):
        """``scorer`` takes the place of the lexicon's, say one of a model."""
        self.spark, self.sf_dir, self.scorer, self.as_of = spark, sf_dir, scorer or lexicon_scorer(lexicon), as_of
        self.refreshed_at = datetime.datetime.combine(as_of, datetime.time())
        self._made: dict[str, DataFrame] = {}

    def replace(self, name: str, df: DataFrame) -> None:
        self._made[name] = df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            made = ops_table(self.spark, self.sf_dir, name) if name in INPUTS else getattr(self, f"_{name}")()
            self._made[name] = stamped(made, self.refreshed_at) if name in STAMPED else made
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter([n[1:] for n in dir(type(self)) if n.startswith("_") and not n.startswith("__") and n[1:] in (*PUBLISHED, "logs", "summaries", "messages")] + list(INPUTS))

    def __len__(self) -> int:
        return len(list(iter(self)))

    def _logs(self):
        return adapter.logs(self.spark, self.sf_dir)

    def _summaries(self):
        return adapter.summaries(self.spark, self.sf_dir)

    def _messages(self):
        return adapter.messages(self.spark, self.sf_dir)

    def _logs_base(self):
        return features.logs_base(self["logs"])

    def _summaries_base(self):
        return features.summaries_base(self["summaries"])

    def _messages_base(self):
        return features.messages_base(self["messages"])

    def _features_player_match(self):
        return features.player_match(self["summaries_base"], self["logs_base"], self["messages_base"], self.scorer)

    def _features_player_recent_form(self):
        return features.recent_form(self["features_player_match"])

    def _serving_player_profiles(self):
        return serving.player_profiles(self["features_player_match"])

    def _serving_map_overview_daily(self):
        return serving.map_overview_daily(self["logs_base"], self["summaries_base"], self["features_player_match"])

    def _serving_player_match_deep_dive(self):
        return serving.deep_dive_at_once(self["features_player_match"])

    def _serving_ml_model_registry(self):
        return mlops.serving_registry(self["ml_model_registry"], self["ml_training_dataset_snapshots"], self.as_of)

    def _serving_ml_pipeline_progress_daily(self):
        return mlops.pipeline_progress_daily(self["ops_pipeline_runs"], self["ml_training_dataset_snapshots"], self["ml_model_registry"], self["ml_model_stage_history"])

    def _serving_ml_prediction_quality_daily(self):
        return mlops.prediction_quality_daily(self["ml_model_validation_metrics_daily"], self["ml_model_registry"], self["ml_training_dataset_snapshots"], self.as_of)
