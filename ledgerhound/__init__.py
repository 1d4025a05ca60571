"""ledgerhound: transaction-ledger risk analytics as Spark DataFrame plans.

Every operator is a function DataFrame(s) + parameters -> DataFrame with no
hidden actions, unless its docstring says it collects a bounded statistic
(sample boundaries, a handful of thresholds or model coefficients).
"""

__all__ = ["session", "params"]
