"""Documents to training sequences: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from graphloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
