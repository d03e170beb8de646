from . import calendars, marts, mastering, measures, panels, periods, quality, reports, star  # noqa: F401
