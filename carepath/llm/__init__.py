"""Operators for training-data pipelines and their registered queries."""

from . import (  # noqa: F401
    align,
    bestfit,
    bond,
    chat,
    decontaminate,
    edits,
    html,
    language,
    packing,
    quality,
    rans,
    simhash,
    substring,
)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
