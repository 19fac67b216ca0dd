"""Hospital-claims risk and KPI analytics as Spark DataFrame jobs.

Sub-packages: ``sources`` (raw extracts, warehouse tables), ``functions``
(column expressions and row-wise feature transforms), ``operators`` (jobs that
join, group, window or train), ``plans`` (whole pipelines, query catalogue and
oracle SQL) and ``streaming`` (micro-batch sinks).
"""

from wardline.config import Settings, load_settings

__all__ = ["Settings", "load_settings"]
