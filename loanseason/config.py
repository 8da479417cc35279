"""Tunable settings. The defaults are fixed values that published results rest on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Windows:
    """Loan-age windows in months since origination, both ends inclusive."""

    feature_last: int = 12
    label_first: int = 13
    label_last: int = 24


@dataclass(frozen=True)
class ExitCodes:
    prepaid: str = "01"
    default: tuple[str, ...] = ("02", "03", "09", "15")
    forbearance_status: str = "XX"
    modified: str = "Y"


@dataclass(frozen=True)
class SplitBands:
    """Vintage-year bands, checked in the order train, val, test, stress."""

    train: tuple[int, int] = (2000, 2015)
    val: tuple[int, int] = (2016, 2017)
    test: tuple[int, int] = (2018, 2019)
    stress: tuple[int, int] = (2020, 2020)
    rest: str = "holdout"

    def items(self) -> list[tuple[str, tuple[int, int]]]:
        return [(name, getattr(self, name)) for name in ("train", "val", "test", "stress")]

    def bounds(self, split: str) -> tuple[int, int]:
        named = dict(self.items())
        if split not in named:
            raise ValueError(f"unknown split {split!r}; expected one of {sorted(named)}")
        return named[split]


@dataclass(frozen=True)
class NullLimit:
    """Largest tolerated share of NULLs; ``label`` names it in the report."""

    column: str
    limit: float
    label: str
    enforced: bool = True


@dataclass(frozen=True)
class RangeLimit:
    """Closed interval; more than ``tolerance`` of rows outside is a violation."""

    column: str
    low: float
    high: float
    enforced: bool = True
    tolerance: float = 0.01


@dataclass(frozen=True)
class EraBound:
    """Plausible delinquency rates for vintages of these years, both ends inclusive."""

    first_year: int
    last_year: int
    low: float
    high: float


# The quality contract.
DEFAULT_NULL_LIMITS = (
    NullLimit("CSCORE_B", 0.30, "null_cscore"),
    NullLimit("DTI", 0.10, "null_dti"),
    NullLimit("OLTV", 0.05, "null_oltv"),
    NullLimit("ORIG_RATE", 0.01, "null_origrate"),
    NullLimit("ORIG_UPB", 0.01, "null_origupb", enforced=False),
    NullLimit("rate_incentive", 0.20, "null_rate_incentive"),
    NullLimit("macro_mortgage30us", 0.20, "null_macro_mortgage30us"),
    NullLimit("hpi_state_ratio_curr_to_orig", 0.80, "null_hpi_ratio"),
)
DEFAULT_RANGE_LIMITS = (
    RangeLimit("CSCORE_B", 300, 850),
    RangeLimit("OLTV", 0, 200),
    RangeLimit("DTI", 0, 65),
    RangeLimit("ORIG_RATE", 0, 20, enforced=False),
    RangeLimit("ORIG_UPB", 1_000, 2_000_000, enforced=False),
)
DEFAULT_ERAS = (
    EraBound(2000, 2003, 0.001, 0.08),
    EraBound(2004, 2008, 0.001, 0.25),
    EraBound(2009, 2012, 0.001, 0.30),
    EraBound(2013, 2019, 0.001, 0.08),
    EraBound(2020, 2025, 0.001, 0.15),
)


@dataclass(frozen=True)
class QualityContract:
    """``all_declared`` also checks the limits that are declared but not enforced."""

    null_limits: tuple[NullLimit, ...] = DEFAULT_NULL_LIMITS
    range_limits: tuple[RangeLimit, ...] = DEFAULT_RANGE_LIMITS
    eras: tuple[EraBound, ...] = DEFAULT_ERAS
    all_declared: bool = False
    price_index_available: bool = True

    def active_null_limits(self) -> list[NullLimit]:
        return [
            n
            for n in self.null_limits
            if (n.enforced or self.all_declared)
            and (self.price_index_available or n.column != "hpi_state_ratio_curr_to_orig")
        ]

    def active_range_limits(self) -> list[RangeLimit]:
        return [r for r in self.range_limits if r.enforced or self.all_declared]


@dataclass(frozen=True)
class TreeSettings:
    """Boosted-tree settings. Average precision on ``val`` chooses the rounds.

    Fits grow from ``first_rounds`` by doubling until ``patience`` rounds have brought nothing
    better or ``rounds`` are reached.
    """

    depth: int = 6
    learning_rate: float = 0.05
    rounds: int = 1000
    row_share: float = 0.8
    column_share: float = 0.8
    min_rows_per_leaf: int = 50
    patience: int = 50
    first_rounds: int = 64
    seed: int = 42


@dataclass(frozen=True)
class NetworkSettings:
    """Two-task network: both tasks share every hidden layer.

    An epoch is ``steps`` steps of the solver. Training ends when ``patience`` epochs have not raised
    the joint average precision on ``val``. The weights say how much each task's loss counts.
    """

    hidden: tuple[int, ...] = (256, 128)
    epochs: int = 40
    steps: int = 5
    patience: int = 6
    delinq_weight: float = 1.0
    prepay_weight: float = 1.0
    block_size: int = 4096
    seed: int = 42


RECALL_LEVELS: tuple[float, ...] = (0.05, 0.10, 0.20)
CALIBRATION_BINS: int = 10
