from . import dedup, feeds, grid, incremental, lookup, resolve, topk, totals  # noqa: F401
