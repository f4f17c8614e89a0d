"""tidemark — churn analytics on Spark DataFrames.

Features, validation, profiling, splits, MLlib ensembles, exact evaluation
metrics, drift and missingness monitoring, what-if perturbation and
reporting queries, all expressed as DataFrame / SQL plans.
"""

from tidemark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
