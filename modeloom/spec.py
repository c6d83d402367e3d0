"""How a column is to be encoded.  Columns are addressed by name."""

from __future__ import annotations

from dataclasses import dataclass

# The model defaults and the marker for a missing value.
N_COMPONENTS = 10
EPS = 0.005
WEIGHT_PRIOR = 0.001
MAX_ITER = 300
ENCODE_CLIP = 0.99
DECODE_CLIP = 1.0
DRAW_FLOOR = 1e-6
MISSING_MARKER = -9999999.0


@dataclass(frozen=True)
class Continuous:
    """A numeric column without special values."""


@dataclass(frozen=True)
class Mixed:
    """A numeric column in which the ``modal`` values mean something of their own."""

    modal: tuple[float, ...]
    missing: float = MISSING_MARKER

    def __post_init__(self):
        values = tuple(float(v) for v in self.modal)
        if not values:
            raise ValueError("a mixed column needs at least one modal value")
        if len(set(values)) != len(values):
            raise ValueError(f"modal values repeat: {values}")
        object.__setattr__(self, "modal", values)


@dataclass(frozen=True)
class Categorical:
    """A column encoded by the frequency rank of its labels."""
