"""loanseason: loan performance analytics expressed as Spark jobs.

Monthly loan records go in; leakage-safe loan rows, quality reports, ranking
metrics, attributions and outreach lists come out. Every operator takes and
returns DataFrames.
"""

__version__ = "0.1.0"
