"""sameitem: find which shop listings are the same product, on Spark.

Listings go through column-expression cleaning and attribute extraction,
title-level blocking joins, pair scoring, rule decisions, optional external
verdicts, connected components and one aggregate row per product.
"""

from sameitem.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
