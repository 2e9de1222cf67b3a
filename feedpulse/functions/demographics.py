"""Labels for gender and age."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report labels.
MALE, FEMALE = "male", "female"
UNDER_25, TO_35, TO_50, OVER_50 = "below 25", "25-35", "36-50", "50+"


def gender_label() -> Column:
    """1 is male; any other code, NULL included, is female."""
    return F.when(F.col("gender") == 1, MALE).otherwise(FEMALE)


def age_group() -> Column:
    """Age bands; a NULL age falls into the last one."""
    age = F.col("age")
    return (
        F.when(age < 25, UNDER_25)
        .when(age.between(25, 35), TO_35)
        .when(age.between(36, 50), TO_50)
        .otherwise(OVER_50)
    )
