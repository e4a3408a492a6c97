"""Which pages an operator cannot work on, and why.

The reference fails on such a page with an error of its own; here it is a row with a
status (or, in a stream, a row of the quarantine table), never a failed job.  A blank
page is no failure: it is an empty page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegraph.functions import urls as U


def bad_reason(url: Column, html: Column) -> Column:
    """``no_html`` (nothing was read), ``bad_url`` (no base to judge links by), or null."""
    return (F.when(html.isNull(), F.lit("no_html"))
            .when(url.isNull() | U.origin(url).isNull(), F.lit("bad_url")))


def page_status(url: Column, html: Column) -> Column:
    """``ok`` or ``bad_page``."""
    return F.when(bad_reason(url, html).isNull(), F.lit("ok")).otherwise(F.lit("bad_page"))
