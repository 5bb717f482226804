"""playlens: cohort and content-popularity analytics over audio-device play logs,
written as native Spark DataFrame operators.

Packages: ``functions`` (column expressions), ``sources`` (readers, writers),
``operators`` (DataFrame → DataFrame steps), ``plans`` (composed pipelines,
jobs, test-table adapter, query catalogue).
"""

__version__ = "0.1.0"
