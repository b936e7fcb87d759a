"""hirelens — job-posting analytics as Spark DataFrame operators.

Packages: ``functions`` (column expressions and rule classifiers), ``sources``
(schemas, readers, flatteners, sinks), ``operators`` (matching, statistics,
de-duplication, reports, checks), ``plans`` (staging models, marts, pipeline,
driver bindings), ``streaming`` (file-stream feed load and trend).
"""

__version__ = "0.1.0"
