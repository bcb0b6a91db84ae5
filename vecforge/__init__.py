"""vecforge: exact nearest-neighbour classification and vector analytics on Spark DataFrames.

Everything is expressed with the DataFrame API so that Catalyst plans it and the
work is spread over the cluster:

* ``vecforge.sources``    label-first CSV scans, split layouts, report sinks, table loaders
* ``vecforge.functions``  array<double> column expressions (dot, norms, distances, ...)
* ``vecforge.operators``  row ids, pair scores, block kNN, votes, PCA, classifiers, metrics
* ``vecforge.plans``      the named queries (and their DuckDB oracles) built from the above
* ``vecforge.llm``        operators for training corpora (a removable subpackage)
"""

from vecforge.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
