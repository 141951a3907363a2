"""caliper: Spark-native table profiling, text features, model fitting and evaluation.

Every operator is a function ``DataFrame -> DataFrame`` (or a ``pyspark.ml``
stage) that keeps its core work distributed; the only rows brought to the
driver are bounded model tables (coefficients, vocabularies capped by
``max_features``, thresholds, per-class counts, bucket boundaries).
"""

from caliper.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
