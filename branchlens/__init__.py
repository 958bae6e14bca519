"""branchlens: multi-branch point-of-sale analytics on Spark DataFrames.

Sub-packages:
  functions  – Column-level helpers (null, rounding and text semantics)
  sources    – readers, landed-document flattening, test fixtures, sinks
  operators  – conform / marts / KPIs / reports / bookings / incremental / quality
  plans      – the query catalogue, its SQL oracle and the nightly batch job
  streaming  – file-fed upsert with Structured Streaming
"""

from branchlens.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
