"""Parameter objects. Defaults are the reference's detection and business values."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from decimal import Decimal


@dataclass(frozen=True)
class RuleParams:
    # The reference's rule thresholds (literals in its rule SQL).
    band_low: Decimal = Decimal("8000")
    band_high: Decimal = Decimal("9999.99")
    r001_band_low: Decimal = Decimal("8000")
    r001_hours: int = 48
    r001_min_count: int = 3
    r002_hours: int = 24
    r002_threshold: Decimal = Decimal("10000")
    r002_min_count: int = 2
    r003_min_credit: Decimal = Decimal("15000")
    r003_hours: int = 72
    r003_ratio: Decimal = Decimal("0.80")
    r004_min_amount: Decimal = Decimal("5000")
    r005_window_days: int = 30
    r005_baseline_from: int = 119
    r005_baseline_to: int = 30
    r005_min_baseline_days: int = 20
    r005_multiplier: float = 3.0
    r005_min_volume: Decimal = Decimal("25000")
    r006_min_amount: Decimal = Decimal("5000")
    r006_unit: int = 1000
    r006_hours: int = 168
    r006_min_count: int = 3
    r006_channels: tuple[str, ...] = ("wire", "emt")
    r007_gap_days: int = 60
    r007_window_days: int = 7
    r007_min_volume: Decimal = Decimal("25000")
    r008_days: int = 30
    r008_min_count: int = 5


# Parameters under which every rule fires on the driver-derived ledgers
# (the ledgers span 30 days of small amounts, so a few thresholds are lowered).
FIXTURE_RULES = RuleParams(
    r001_band_low=Decimal("2000"), r001_min_count=2,
    r005_multiplier=0.5,
    r006_unit=10, r006_min_count=2,
    r008_min_count=3,
)


@dataclass(frozen=True)
class SplitParams:
    train_end_day: int = 120
    valid_end_day: int = 150


# The 30-day EVT ledger uses a proportionally shorter split.
FIXTURE_SPLIT = SplitParams(train_end_day=15, valid_end_day=22)


@dataclass(frozen=True)
class ModelParams:
    # The reference's model configuration.
    n_estimators: int = 400
    learning_rate: float = 0.05
    num_leaves: int = 31
    min_child_samples: int = 40
    logistic_c: float = 0.5
    logistic_max_iter: int = 2000
    seed: int = 20260723
    min_category_rows: int = 20


@dataclass(frozen=True)
class EvalParams:
    bootstrap_iterations: int = 1000
    bootstrap_ci: float = 0.95
    required_validation_recall: float = 1.0
    recall_targets: tuple[float, ...] = (1.0, 0.99, 0.98, 0.95, 0.90)
    tier1_pct: float = 0.10
    tier2_pct: float = 0.40


@dataclass(frozen=True)
class CostParams:
    # The reference's business-case assumptions.
    investigator_base_salary_cad: float = 75000.0
    loading_factor: float = 1.4
    productive_hours_per_year: float = 1800.0
    minutes_per_alert_l1: float = 22.0
    build_effort_person_days: float = 45.0
    blended_day_rate_cad: float = 900.0
    annual_platform_cost_cad: float = 18000.0
    annual_model_governance_cost_cad: float = 25000.0
    deferred_work_reduction: float = 0.60
    queue_position_gain: float = 0.45
    prioritisation_value_share: float = 0.10
    # Days of the holdout; the queries derive it from the date dimension and the split.
    holdout_window_days: int = 30
    sensitivity_minutes: tuple[float, ...] = (15.0, 22.0, 30.0)
    sensitivity_rates: tuple[tuple[float, str], ...] = ((0.8, "low"), (1.0, "base"), (1.25, "high"))
    sensitivity_targets: tuple[float, ...] = (1.0, 0.99, 0.95)

    @property
    def hourly_rate(self) -> float:
        return self.investigator_base_salary_cad * self.loading_factor / self.productive_hours_per_year


@dataclass(frozen=True)
class FeatureParams:
    windows: tuple[int, ...] = (7, 30, 90)
    active_window: int = 90
    epsilon: float = 1e-9
    offhours_start: int = 8
    offhours_end: int = 18
    round_unit: int = 1000
    round_min: Decimal = Decimal("5000")
    band_low: Decimal = Decimal("8000")
    band_high: Decimal = Decimal("9999.99")
    label_grace_days: int = 7


@dataclass(frozen=True)
class Params:
    rules: RuleParams = field(default_factory=RuleParams)
    split: SplitParams = field(default_factory=SplitParams)
    model: ModelParams = field(default_factory=ModelParams)
    evaluation: EvalParams = field(default_factory=EvalParams)
    cost: CostParams = field(default_factory=CostParams)
    features: FeatureParams = field(default_factory=FeatureParams)


FIXTURE_PARAMS = Params(rules=FIXTURE_RULES, split=FIXTURE_SPLIT)

__all__ = ["RuleParams", "SplitParams", "ModelParams", "EvalParams", "CostParams",
           "FeatureParams", "Params", "FIXTURE_RULES", "FIXTURE_SPLIT", "FIXTURE_PARAMS",
           "replace"]
