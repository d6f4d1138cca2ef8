"""cohortkit — monthly customer-cohort selection, tagging and scoring on Spark.

The library is a set of composable DataFrame operators:

* ``sources``    — table contracts, Parquet / ORC snapshot readers, struct unwrap,
                   schema-gated partition union, and the test-table adapter.
* ``functions``  — rule tables (ordered classification, bands, flag renderers)
                   and month arithmetic, all as built-in Column expressions.
* ``operators``  — business operators: cohort, holdings, agent dimension,
                   customer profile, exclusion flags, scoring, publishing.
* ``plans``      — the end-to-end lead plan and the query registry.

Every operator is lazy: it takes DataFrames and a :class:`RunParams` and
returns a DataFrame.  Only the publish step acts.
"""

from cohortkit.params import RunParams

__all__ = ["RunParams"]
__version__ = "0.1.0"
