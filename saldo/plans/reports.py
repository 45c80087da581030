"""Report payloads as the dashboard reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from saldo.operators.planactual import BY_MONTH, BY_NATURE, BY_PROJECT, plan_actual_lines, totals
from saldo.session import ensure_checkpoint_dir


def plan_payload(planned: DataFrame, executed: DataFrame, strict: bool = False) -> dict[str, DataFrame]:
    """Month, nature and project totals, from report lines computed once.

    The lines are kept as a checkpoint, so the three aggregates and whatever is
    built on them do not repeat the scans and joins.
    """
    ensure_checkpoint_dir(planned.sparkSession)
    lines = plan_actual_lines(planned, executed, strict).checkpoint()
    return {
        "mensal": totals(lines, BY_MONTH),
        "natureza": totals(lines, BY_NATURE),
        "projeto": totals(lines, BY_PROJECT),
    }
