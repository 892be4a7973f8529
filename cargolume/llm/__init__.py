"""Operators for preparing training data, one module each, with their registered queries."""

from cargolume.llm import bpe, exact, interaction, language, lines, middle, mixing, near, quality, rules, substrings, topk, warc
from cargolume.llm.common import REGISTRY

__all__ = ["REGISTRY", "bpe", "exact", "interaction", "language", "lines", "middle", "mixing", "near", "quality", "rules", "substrings", "topk", "warc"]
