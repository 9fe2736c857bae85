"""Loan buyout eligibility screening on Spark DataFrames."""

from scrubline.plans.pipeline import eligibility
from scrubline.plans.variants import CURRENT, MONTH_END
from scrubline.sources.tables import Tables

__all__ = ["CURRENT", "MONTH_END", "Tables", "eligibility"]
