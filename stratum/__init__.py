"""stratum: ordered-sequence, range, grid, graph, geometry and bit-set
analytics as plain Spark DataFrame-to-DataFrame operators.

Every operator takes DataFrames plus column names and returns a lazy
DataFrame; the only driver-side work is the round counter and stop test
of the fixpoint loops in ``stratum.plans.loops``.
"""

__version__ = "0.1.0"
