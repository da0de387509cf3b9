"""Where the data sets live below one root URI."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """Locations below ``root``, which may be any URI Spark can read."""

    root: str = "artifacts"

    def _below(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def raw(self) -> str:
        return self._below("data", "raw")

    @property
    def output(self) -> str:
        return self._below("data", "output")

    @property
    def experiment(self) -> str:
        return self._below("data", "experiment")

    @property
    def test(self) -> str:
        return self._below("data", "test")

    @property
    def demo(self) -> str:
        return self._below("data", "demo")

    @property
    def feature_store(self) -> str:
        return self._below("data", "feature_store")

    @property
    def model(self) -> str:
        return self._below("model")

    @property
    def log_file(self) -> str:
        return f"{self.raw}/Log_Problem.csv"

    @property
    def user_file(self) -> str:
        return f"{self.raw}/Info_UserData.csv"

    @property
    def content_file(self) -> str:
        return f"{self.raw}/Info_Content.csv"
