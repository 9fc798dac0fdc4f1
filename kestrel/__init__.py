"""kestrel: product-growth analytics as Spark DataFrame operators.

Layout
------
sources/    parquet scans, the test-table mapping (views) and sinks
functions/  column helpers (safe ratios, z-scores, scores, ranks) and
            vectorised special functions for p-values
operators/  the analytical operators, grouped by stage of the pipeline
plans/      compositions of operators into marts and the query registry
"""

__all__ = ["session"]
