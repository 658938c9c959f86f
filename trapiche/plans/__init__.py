"""End-to-end plans over the operators."""

from trapiche.plans.etl import detail_from_feeds, run_etl
from trapiche.plans.modelling import run_model

__all__ = ["detail_from_feeds", "run_etl", "run_model"]
