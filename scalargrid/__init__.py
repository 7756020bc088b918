"""Longitudinal collation of scalar tables, as Spark DataFrame jobs."""

from scalargrid.plans.job import Outputs, build, run

__all__ = ["Outputs", "build", "run"]
