"""Marketing measurement as Spark DataFrames: adstock, attribution, geo lift, marts."""

from tallyspark.params import DEFAULTS, MeasurementParams
from tallyspark.plans.models import MeasurementModels, RawTables

__all__ = ["DEFAULTS", "MeasurementModels", "MeasurementParams", "RawTables"]
