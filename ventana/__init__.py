"""ventana: monthly-demand analytics as Spark DataFrame, MLlib and Structured Streaming jobs."""

from ventana.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]
__version__ = "0.1.0"
