"""riskloom: credit-risk analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` that takes column
names as parameters.  Heavy work (scans, aggregates, windows, joins, model
fits) runs on Spark; the driver only sees bounded summaries (class counts,
quantile cut points, candidate grids).
"""

__version__ = "0.1.0"
