"""attrition: a Spark-native app-uninstall propensity pipeline.

Feature build (installs x hits x customers -> one row per user), distributed
training and scoring, and idempotent date-partition sinks, all as
DataFrame -> DataFrame operators.
"""

__version__ = "0.1.0"
