"""Jobs as lists of units of work: each unit stands alone, failures are counted, and a run ends in one row of the log."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewright.operators.quality import FAILURE, PARTLY, SUCCESS

RUN = "job_name string, status string, processed long, failed long, failed_codes array<string>, duration_secs double, finished_at long"


@dataclass
class Run:
    """What a run did so far."""

    name: str
    dry_run: bool = False
    processed: int = 0
    failures: list[tuple[str, str]] = field(default_factory=list)
    crashed: bool = False

    def add_success(self, n: int = 1) -> None:
        self.processed += n

    def add_failure(self, code: str, reason: str) -> None:
        self.failures.append((code, reason))

    @property
    def status(self) -> str:
        if self.crashed or (self.failures and not self.processed):
            return FAILURE
        return PARTLY if self.failures else SUCCESS


def parser(description: str) -> argparse.ArgumentParser:
    """The options that all jobs have."""
    out = argparse.ArgumentParser(description=description)
    out.add_argument("--dry-run", action="store_true", help="tell what would be written and write nothing")
    out.add_argument("--date", help="the day to work on, as YYYY-MM-DD")
    out.add_argument("--limit", type=int, default=0, help="units to work on; 0 means all")
    out.add_argument("--codes", help="codes to work on, joined by commas")
    return out


def codes_of(text: str | None) -> list[str] | None:
    """The codes of an option, each once and in order; none means all."""
    codes = list(dict.fromkeys(c.strip() for c in (text or "").split(",") if c.strip()))
    return codes or None


def run(spark: SparkSession, name: str, units: Iterable[tuple[str, Callable[[Run], object]]], clock: Callable[[], float], limit: int = 0, dry_run: bool = False) -> tuple[Run, DataFrame]:
    """Work on (code, action) units in order; an action that raises is a failure of its unit. What is done for many rows is for
    actions to do as DataFrames. (the run, its row of the log)."""
    began, out = clock(), Run(name, dry_run)
    try:
        for k, (code, action) in enumerate(units):
            if limit and k >= limit:
                break
            try:
                action(out)
                out.add_success()
            except Exception as e:
                out.add_failure(code, f"{type(e).__name__}: {e}")
    except Exception as e:  # the list of units itself
        out.crashed = True
        out.add_failure(name, f"{type(e).__name__}: {e}")
    ended = clock()
    row = (name, out.status, out.processed, len(out.failures), [c for c, _ in out.failures], float(ended - began), int(ended))
    return out, spark.createDataFrame([row], RUN)
