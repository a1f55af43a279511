from panelweave.queries import rows  # noqa: F401  (defines inputs that later modules use)
from panelweave.queries import cells, files, intervals, iterative, models, multi, timeseries  # noqa: F401
from panelweave.queries.registry import ORACLES, QUERIES  # noqa: F401
