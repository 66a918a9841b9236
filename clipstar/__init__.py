"""clipstar: video-engagement analytics as Spark DataFrame plans.

Layers: landed JSON (``sources``) -> typed, deduplicated Silver
(``operators.silver``) -> media/visitor dimensions and the daily engagement
fact (``operators.dims``, ``operators.fact``) -> SQL marts
(``operators.marts``).  Incremental ingestion against per-media high
watermarks lives in ``operators.incremental``; the Structured Streaming path
in ``streaming`` reuses the same DataFrame functions.
"""

__version__ = "0.1.0"
