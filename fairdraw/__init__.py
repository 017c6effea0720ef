"""Stratified sampling and its reports on Spark DataFrames."""

from fairdraw.plans.quota import Quota
from fairdraw.plans.selection import draw

__all__ = ["Quota", "draw"]
