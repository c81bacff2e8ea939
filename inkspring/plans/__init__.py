"""All registered queries of the chapter engine."""

from inkspring.plans import assembly, banks, geometry, graphs, identities, json_trees, page_masks, people, quality_checks, rasters, relations, scalars, sequential, sources, stages, streams, windows  # noqa: F401
from inkspring.registry import ORACLES, QUERIES  # noqa: F401
