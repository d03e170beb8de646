from . import dates, formats, keys, ratios  # noqa: F401
