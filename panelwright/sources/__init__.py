from . import layers, rows, star_csv  # noqa: F401
