"""Every operator as a query on the order-processing tables, with SQL that must give the same rows."""

from lumbung.workload import (  # noqa: F401  (importing a module registers its queries)
    aggregates,
    cleaning,
    explorer,
    imputation,
    joins,
    quality,
    reshaping,
    sources,
    statistics,
    windows,
)
from lumbung.workload.base import ORACLES, QUERIES  # noqa: F401
