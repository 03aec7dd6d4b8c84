"""One run of the layers: its clock, its zone and its batch sizes."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo


@dataclass(frozen=True)
class RunConfig:
    """Every clock value of a run comes from ``run_ts``, so a run can be repeated exactly.

    ``pages_per_folder`` and ``folders_per_batch`` shape file counts only; raise them with
    the volume of the feed. A job puts the small files of a partition that it wrote together
    when there are ``small_files`` of them.
    """

    run_ts: datetime
    zone: str = "America/Sao_Paulo"
    folder_prefix: str = "feedpage"
    pages_per_folder: int = 10
    folders_per_batch: int = 10
    small_files: int = 32
    lookback_days: int = 7

    def __post_init__(self) -> None:
        if self.run_ts.tzinfo is None:
            raise ValueError("run_ts must carry a time zone")
        if "_" in self.folder_prefix:
            raise ValueError("folder_prefix must not contain '_', names are split on it")

    @property
    def local_ts(self) -> datetime:
        return self.run_ts.astimezone(ZoneInfo(self.zone))

    @property
    def stamp(self) -> str:
        """Run stamp ``yyyyMMdd_HHmmss`` on the feed's own clock."""
        return self.local_ts.strftime("%Y%m%d_%H%M%S")

    @property
    def run_date(self) -> date:
        """Upper bound of what a run loads."""
        return self.local_ts.date()

    @property
    def period(self) -> str:
        """Run month ``yyyyMM``: raw period and silver/gold partition."""
        return self.stamp[:6]

    @property
    def default_start(self) -> date:
        """Lower bound when neither target nor source has a row."""
        return self.run_date - timedelta(days=self.lookback_days)
