"""Parameters of the match, passed as arguments: no operator reads the environment."""

from __future__ import annotations

from dataclasses import dataclass

DAY_SECONDS = 86_400


@dataclass(frozen=True)
class MatchConfig:
    """Everything that changes which planned departure a passage is matched to, or how it is judged.

    ``time_zone`` is the zone in which instants are read as clock time; ``None`` means the session zone.
    ``bucket_seconds`` only changes the physical plan, never the rows.
    """

    rollover_hour: int = 4
    tolerance_seconds: int = 7_200
    delay_threshold_minutes: float = 5.0
    collapse_whitespace: bool = False
    time_zone: str | None = None
    bucket_seconds: int = 900

    @property
    def first_second(self) -> int:
        """First second of the service day."""
        return self.rollover_hour * 3_600

    @property
    def last_second(self) -> int:
        """Last second of the service day, past midnight counted on."""
        return self.first_second + DAY_SECONDS - 1
