"""Where the layers of one lake live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Paths of every table under one base path (local, HDFS or object store)."""

    base: str

    def bronze(self, table: str) -> str:
        return f"{self.base}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.base}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.base}/gold/{table}"

    def features(self, table: str) -> str:
        return f"{self.base}/features/{table}"

    def predictions(self, table: str) -> str:
        return f"{self.base}/predictions/{table}"

    def model(self, version: str) -> str:
        return f"{self.base}/models/{version}/model"

    @property
    def run_registry(self) -> str:
        return f"{self.base}/models/run_registry"

    @property
    def batches(self) -> str:
        return f"{self.base}/metadata/batches"

    @property
    def high_marks(self) -> str:
        return f"{self.base}/metadata/high_marks"

    @property
    def load_plans(self) -> str:
        return f"{self.base}/metadata/load_plans"

    @property
    def customer_counts(self) -> str:
        return f"{self.base}/metadata/customer_counts"

    @property
    def touched_days(self) -> str:
        return f"{self.base}/metadata/touched_days"

    def staging(self, table: str, run_id: str) -> str:
        return f"{self.base}/staging/{table}/{run_id}"
