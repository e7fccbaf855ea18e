"""Operators for training-data pipelines, and their registered queries."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along: a cluster needs no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from wattlane.llm import (  # noqa: E402, F401
    conversation_trie,
    decontamination,
    exact_dedup,
    language_id,
    lexical_search,
    license_scan,
    line_dedup,
    lm_scoring,
    mixing,
    near_copies,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
)
from wattlane.llm.common import ORACLES, QUERIES  # noqa: E402

__all__ = ["QUERIES", "ORACLES"]
