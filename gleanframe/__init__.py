"""Crawl-data jobs for Spark: stored responses, pages and fetch logs in, clean records out.

Every public operator is a plain function from DataFrame(s) to DataFrame.
"""

__version__ = "0.1.0"
