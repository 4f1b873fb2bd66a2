"""Curation of conversation datasets as Spark jobs."""

import sys

from pyspark import cloudpickle

from gleaner.config import CurationConfig, load_config
from gleaner.plans.curate import CurationResult, Curator, curate, curate_turns

# Ship the helpers used inside tasks with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "CurationConfig",
    "CurationResult",
    "Curator",
    "curate",
    "curate_turns",
    "load_config",
]
