"""The four scanners are one pipeline with different settings."""

from __future__ import annotations

from dataclasses import dataclass

# Operating constants of the scanners.
STEP_MS = 500
THRESHOLD_PAISE = 50_000 * 100
BURST_S = 10
BASELINE_S = 900
RESET_S = 5
OI_LOCK = "09:30"


@dataclass(frozen=True)
class Profile:
    name: str
    clock: str  # trade column the windows run on: exchange time `ltt` or `arrival_ms`
    window_s: float | None  # None: trades never expire
    reset_on_alert: bool
    category: str  # "momentum", "flow" or "side"
    quiet_exit: str = "EXITING"
    score: str | None = None  # "day" or "flow"
    baseline_s: float | None = None
    threshold_paise: int = THRESHOLD_PAISE
    time_text: str = "dd/MM/yyyy HH:mm:ss"

    @property
    def width(self) -> int | None:
        """Window length in check instants."""
        return None if self.window_s is None else int(self.window_s * 1000 / STEP_MS)

    @property
    def base_width(self) -> int | None:
        return None if self.baseline_s is None else int(self.baseline_s * 1000 / STEP_MS)


ARRIVAL = Profile("arrival", "arrival_ms", RESET_S, True, "momentum", time_text="HH:mm:ss")
BARS = Profile("bars", "ltt", None, True, "flow", quiet_exit="DISTRIBUTION", time_text="MMM dd HH:mm:ss")
RESET = Profile("reset", "ltt", RESET_S, True, "flow", score="day")
# Not reset, so one burst alerts on every check it lasts; `replace(SLIDING, reset_on_alert=True)`
# alerts once per burst.
SLIDING = Profile("sliding", "ltt", BURST_S, False, "side", score="flow", baseline_s=BASELINE_S)

PROFILES = {p.name: p for p in (ARRIVAL, BARS, RESET, SLIDING)}
