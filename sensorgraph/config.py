"""Settings of the feature jobs, with the reference values as defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

# Rows of one sensor that a single window task may sort; longer series are cut into pieces.
ROWS_PER_TASK = 2_000_000
# Beyond so many tasks of one shuffle a warning is given; no work is left out.
MOST_TASKS = 50_000
# A side of a join is broadcast by hand only up to this many (narrow) rows.
BROADCAST_ROWS = 1_000_000
# Links of one source sensor kept together when its links are joined by shuffle.
LINKS_PER_SLOT = 500_000
# Time steps of one sensor handled by one window task of the dense panel.
STEPS_PER_TASK = 100_000
# Nodes per array of an exported snapshot.
NODES_PER_BLOCK = 4096


@dataclass(frozen=True)
class SeriesConfig:
    free_flow: float = 60
    moderate: float = 40
    lags: tuple[int, ...] = (1, 2, 3, 6, 12)
    frames: tuple[int, ...] = (3, 6, 12)
    tiebreak: str | None = None
    keep_scaled: bool = False
    rows_per_task: int | None = ROWS_PER_TASK


@dataclass(frozen=True)
class GraphConfig:
    iterations: int = 10
    reset: float = 0.15
    store_every: int = 5
    broadcast_rows: int = BROADCAST_ROWS
    links_per_slot: int = LINKS_PER_SLOT


@dataclass(frozen=True)
class SequenceConfig:
    length: int = 12
    horizon: int = 12
    train_fraction: float = 0.8
    steps_per_task: int = STEPS_PER_TASK


@dataclass(frozen=True)
class GoldConfig:
    series: SeriesConfig = field(default_factory=SeriesConfig)
    graph: GraphConfig = field(default_factory=GraphConfig)
