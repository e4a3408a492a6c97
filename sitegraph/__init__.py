"""sitegraph: crawled-page analytics as Spark DataFrame plans.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns).  Per-page work is expressed as row-local Catalyst expressions
over the ``html`` column (no shuffle); cross-page work (link graph, crawl,
sitemap) is expressed as joins and aggregations keyed by page or URL.
"""

from sitegraph.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
