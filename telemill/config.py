"""Data-quality rules and job defaults.

Everything an operator checks a record against lives in one immutable ``RuleSet``, so another
fleet (other id scheme, other limits, other codes) is a matter of passing another instance.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# They define which records count as valid, so they must stay as they are for
# results to agree with the documented data contract.
ID_PREFIX = "BMW-"
FAULT_CODES = ("NONE", "TEMP_HIGH", "BATTERY_LOW", "ENGINE_FAULT")
NO_FAULT = "NONE"
FAULT_ALIASES = MappingProxyType(
    {"temphigh": "TEMP_HIGH", "batterylow": "BATTERY_LOW", "enginefault": "ENGINE_FAULT"}
)
LIMITS = MappingProxyType(
    {"speed": (0, 250), "battery_level": (0, 100), "temperature": (-20, 120)}
)
REQUIRED_FIELDS = ("vehicle_id", "timestamp", "speed", "battery_level", "temperature", "fault_code")
MEASURES = ("speed", "battery_level", "temperature")

# Reasons written to the dead-letter table (fixed values).
MALFORMED = "malformed_json"
INVALID = "invalid_telemetry_values"

# Thresholds of the analytics (fixed values).
HOT_TEMPERATURE = 90.0
LOW_BATTERY = 20.0

DEFAULT_WINDOW = "5 minutes"
DEFAULT_WATERMARK = "2 minutes"


@dataclass(frozen=True)
class RuleSet:
    """The checks a telemetry record has to pass."""

    id_prefix: str = ID_PREFIX
    id_tail: str = "[A-Z0-9-]+"
    id_tail_any_case: str = "[A-Za-z0-9-]+"
    limits: Mapping[str, tuple[float, float]] = field(default_factory=lambda: LIMITS)
    fault_codes: tuple[str, ...] = FAULT_CODES
    fault_aliases: Mapping[str, str] = field(default_factory=lambda: FAULT_ALIASES)

    # \A..\z instead of ^..$: in a Java pattern `$` also matches before a final line break.
    @property
    def id_pattern(self) -> str:
        return rf"\A\Q{self.id_prefix}\E{self.id_tail}\z"

    @property
    def id_pattern_any_case(self) -> str:
        return rf"\A\Q{self.id_prefix}\E{self.id_tail_any_case}\z"


DEFAULT_RULES = RuleSet()
