"""tessera: grid outliers, k-center, word counts and stream frequency sketches on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; the work stays in Catalyst plans
(built-in expressions, partial aggregation, shuffles keyed for balance) with pandas only where a
sequential step is inherent (farthest-first traversal inside one bounded group, sticky-sampling state).
"""

__version__ = "0.1.0"
