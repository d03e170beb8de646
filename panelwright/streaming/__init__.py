from . import reload  # noqa: F401
