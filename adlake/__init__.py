"""adlake: booking and ad-spend lakehouse jobs for PySpark.

``functions`` holds column expressions, ``operators`` pure DataFrame-to-DataFrame
steps, ``sources`` readers, intake and sinks, ``plans`` whole jobs and reports, and
``streaming`` the Structured Streaming counterparts of the batch jobs.
"""

__version__ = "0.1.0"
