"""Settings shared by every job."""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

# The column contract of a flight row, in file order.
FLIGHT_COLUMNS = (
    "FL_DATE", "OP_CARRIER", "OP_CARRIER_FL_NUM", "ORIGIN", "DEST",
    "CRS_DEP_TIME", "DEP_TIME", "DEP_DELAY", "TAXI_OUT", "WHEELS_OFF",
    "WHEELS_ON", "TAXI_IN", "CRS_ARR_TIME", "ARR_TIME", "ARR_DELAY",
    "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME", "ACTUAL_ELAPSED_TIME",
    "AIR_TIME", "DISTANCE",
)

# The numeric columns that are monitored and modelled.
INPUT_FEATURES = ("DEP_DELAY", "TAXI_OUT", "CRS_ELAPSED_TIME", "DISTANCE")

# Day shift used when old history is replayed as recent data.
HISTORY_SHIFT_DAYS = 365 * 5


@dataclass(frozen=True)
class FlightConfig:
    """One run's settings; the defaults are the production ones.

    ``as_of`` pins "today", so a run can be repeated; ``None`` means the
    current date.  ``max_train_size`` is a cap on the training rows for those who
    ask for one; ``None`` means that a model is trained on all of them.
    """

    output_prefix: str = "hdfs:///flights"
    dataset_name: str = "prod_ds"
    model_name: str = "prod_model"
    date_dk: str = "FL_DATE"
    target_column: str = "ARR_DELAY"
    required_columns: tuple[str, ...] = FLIGHT_COLUMNS
    input_features: tuple[str, ...] = INPUT_FEATURES
    max_train_size: int | None = None
    max_history_days: int = 100
    val_days: int = 7
    replicates: int = 3000
    seed: int = 42
    significance: float = 0.05
    impute_scope: str = "train"
    accumulate_mode: str = "replace_days"
    as_of: dt.date | None = None

    def run_date(self) -> dt.date:
        return self.as_of or dt.date.today()

    @property
    def model_features(self) -> list[str]:
        return [*self.input_features, *(f"flight_weekday_{k}" for k in range(1, 8))]

    # The folder names under ``output_prefix``.
    @property
    def raw_path(self) -> str:
        return f"{self.output_prefix}/raw_data.parquet"

    @property
    def fresh_path(self) -> str:
        return f"{self.output_prefix}/fresh_data_part.parquet"

    @property
    def clean_path(self) -> str:
        return f"{self.output_prefix}/clean_data_part.parquet"

    @property
    def features_path(self) -> str:
        return f"{self.output_prefix}/features_{self.dataset_name}.parquet"

    @property
    def train_path(self) -> str:
        return f"{self.output_prefix}/datasets/{self.dataset_name}/train.parquet"

    @property
    def test_path(self) -> str:
        return f"{self.output_prefix}/datasets/{self.dataset_name}/test.parquet"

    def stats_path(self, table: str) -> str:
        return f"{self.output_prefix}/stats/{table}"

    @property
    def watermark_path(self) -> str:
        return f"{self.output_prefix}/state/watermark"

    @property
    def registry_path(self) -> str:
        return f"{self.output_prefix}/state/registry"

    @property
    def runs_path(self) -> str:
        return f"{self.output_prefix}/state/runs"

    @property
    def day_stats_path(self) -> str:
        """Rows and moments of the feature table's days, kept up to date by accumulation."""
        return f"{self.output_prefix}/stats/days_{self.dataset_name}"

    @property
    def ingested_path(self) -> str:
        return f"{self.output_prefix}/ingested.parquet"

    def checkpoint_path(self, source: str) -> str:
        """The stream state of one source."""
        return f"{self.output_prefix}/state/stream-{hashlib.sha256(source.encode()).hexdigest()[:16]}"

    def model_path(self, version: int) -> str:
        return f"{self.output_prefix}/models/{self.model_name}/{version}"
