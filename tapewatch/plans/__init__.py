"""Composed jobs: batch, reports, marts, warehouse load, analytics, run metrics."""
