"""End-to-end jobs and the catalog of registered queries."""

from payrisk.plans.jobs import (
    build_marts,
    label_reports,
    run_export,
    run_stream,
    run_training,
    write_marts,
    write_scored,
)

__all__ = [
    "build_marts",
    "label_reports",
    "run_export",
    "run_stream",
    "run_training",
    "write_marts",
    "write_scored",
]
