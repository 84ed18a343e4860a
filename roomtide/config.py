"""Cost and capacity settings of the overbooking decision."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path


@dataclass(frozen=True)
class CostConfig:
    # Defaults of the decision layer.
    capacity: Mapping[str, int] = field(default_factory=lambda: {"Resort Hotel": 91, "City Hotel": 190})
    default_capacity: int = 300
    k_values: Sequence[float] = (1.5, 2.0, 3.0)
    default_k: float = 2.0
    fixed_overbook_pct: float = 0.05
    n_sims: int = 2000
    seed: int = 42
    o_max_pct: float = 0.30
    default_rate: float = 0.05

    def capacity_of(self, hotel: str) -> int:
        return int(self.capacity.get(hotel, self.default_capacity))


def load_config(path: str) -> CostConfig:
    """Settings from a YAML or JSON file; keys that are absent keep their defaults."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("reading YAML settings needs PyYAML; use JSON instead") from error
        found = yaml.safe_load(text)
    simulation = found.get("monte_carlo", {})
    named = {name: found[name] for name in ("default_capacity", "default_k", "fixed_overbook_pct") if name in found}
    named |= {name: simulation[name] for name in ("n_sims", "seed", "o_max_pct") if name in simulation}
    if "capacity" in found:
        named["capacity"] = {hotel: int(rooms) for hotel, rooms in found["capacity"].items()}
    if "k_values" in found:
        named["k_values"] = tuple(float(k) for k in found["k_values"])
    return CostConfig(**named)
