"""rollcall: a K-12 school data warehouse built on Spark DataFrames.

``Warehouse(spark, sources, config)`` resolves dataset names to lazy
DataFrames; ``rollcall.plans`` holds the dataset definitions,
``rollcall.operators`` the reusable dataflow operators, ``rollcall.functions``
the Column helpers, ``rollcall.sources`` the staging relations and seeds.
"""

from .config import CUSTOM_CONFIG, TEST_CONFIG, Config
from .plans.registry import DATASETS, Warehouse, load_all

__all__ = ["Config", "TEST_CONFIG", "CUSTOM_CONFIG", "Warehouse", "DATASETS", "load_all"]
