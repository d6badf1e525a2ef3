"""tidemark: hourly liquidity-pool analytics as Spark DataFrame transforms.

Layers (each a ``DataFrame -> DataFrame`` function):

raw JSON envelope -> typed staging -> rolling per-pool features -> labels ->
scores -> dashboard views / feature-store export, plus an incremental
maintenance path, a distributed Isolation Forest and Structured Streaming
variants of the hourly loop.
"""

from tidemark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
