"""What the driver sees of this folder."""

from __future__ import annotations

import re

import __spark_entry__
import corpus_pipeline
from shelfline.llm.registry import LLM_ORACLES, LLM_QUERIES


def test_every_operator_and_the_pipeline_are_registered():
    numbers = sorted(int(m[1]) for n in LLM_QUERIES if (m := re.match(r"op(\d+)_\w+$", n)))
    assert numbers == [*range(1, 14)] and LLM_QUERIES["pipeline"] is corpus_pipeline.run
    assert len(LLM_QUERIES) == 14 and set(LLM_ORACLES) <= set(LLM_QUERIES)
    assert LLM_QUERIES.items() <= __spark_entry__.queries().items()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "near-duplicates", "substring duplicates", "packing",
    ]
