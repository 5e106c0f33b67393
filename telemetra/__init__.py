"""telemetra: data quality, anomaly detection and drift monitoring as Spark jobs.

Every operator is a function ``DataFrame -> DataFrame`` with column-name
parameters.  Nothing is collected to the driver except small, bounded
parameter tables (bin edges, category lists) whose size does not grow with
the data.
"""

from telemetra.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
