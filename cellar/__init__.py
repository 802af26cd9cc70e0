"""cellar: crawl records into a keyed, versioned crawl table, on Spark."""

from cellar.options import CrawlOptions

__all__ = ["CrawlOptions"]
__version__ = "0.1.0"
