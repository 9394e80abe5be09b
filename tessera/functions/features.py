"""Engineered features (the reference's ``add_custom_features``) as one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .expressions import cut, nan_string, signed_log1p

# Fixed values that must equal the reference's for the same results.
WORK_TYPE_EDGES = (0.0, 35.0, 45.0, 100.0)
WORK_TYPE_LABELS = ("part_time", "full_time", "overtime")
MARRIED_VALUES = ("Married-civ-spouse", "Married-AF-spouse")
DROP_AFTER_FEATURES = ("fnlwgt", "native_country")


def add_custom_features(df: DataFrame, married_values: Sequence[str] = MARRIED_VALUES,
                        drop: Sequence[str] = DROP_AFTER_FEATURES) -> DataFrame:
    """Interaction, flag, bin and log features, then drop the unused columns.

    All expressions are fused by Catalyst into a single projection.
    """
    types = dict(df.dtypes)
    # narrowed integers would overflow in products and differences
    age, edu, hours, gain, loss = (F.col(c).cast("bigint") if types[c] in ("tinyint", "smallint") else F.col(c) for c in
                                   ("age", "education_num", "hours_per_week", "capital_gain", "capital_loss"))
    net = gain - loss
    cols = {
        "edu_age_inter": edu * age,
        "work_hours_edu": hours * edu,
        "net_capital": net,
        # pandas: NaN > 0 is False, so a missing side never marks activity
        "has_capital_activity": (F.coalesce(gain > 0, F.lit(False))
                                 | F.coalesce(loss > 0, F.lit(False))).cast("int"),
        "work_type": cut(hours, WORK_TYPE_EDGES, WORK_TYPE_LABELS),
    }
    if "sex" in df.columns and "relationship" in df.columns:
        cols["sex_rel_inter"] = F.concat_ws("_", nan_string("sex"), nan_string("relationship"))
    cols["is_married"] = F.coalesce(F.col("marital_status").isin(list(married_values)),
                                    F.lit(False)).cast("int")
    cols["net_capital_log"] = signed_log1p(net)
    out = df.withColumns(cols)
    return out.drop(*[c for c in drop if c in out.columns])
