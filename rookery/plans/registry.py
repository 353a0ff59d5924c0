"""One entry per job of the inventory: how to build it from the tables, and SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from rookery.views import Tables, with_views


@dataclass(frozen=True)
class Job:
    key: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None


JOBS: dict[str, Job] = {}


def job(key: str, oracle: str | None = None):
    """Register a builder under its inventory key."""

    def register(build: Callable[[Tables], DataFrame]):
        if key in JOBS:
            raise ValueError(f"{key} registered twice")
        JOBS[key] = Job(key, build, with_views(oracle) if oracle else None)
        return build

    return register
