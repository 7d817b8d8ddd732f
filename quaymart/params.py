"""Run parameters, parsed once on the driver."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class MartParams:
    """Everything a result depends on besides its input tables.

    ``as_of`` stands in for the wall clock: "now" is midnight of that day, so a
    replay of an old day gives the old result.
    """

    as_of: dt.date
    excluded_company_ids: tuple[int, ...] = ()
    dead_stock_days: int = 90
    anomaly_pct: float = 0.2
    otif_threshold: float = 0.8
    abc_a_pct: float = 0.80
    abc_b_pct: float = 0.15
    abc_c_pct: float = 0.05  # accepted for completeness; class C is whatever is left
    forecast_scope: str = "only_class_a"
    full_refresh_models: frozenset[str] = frozenset()
    alert_email: str = ""
    helpdesk_team_id: int | None = None
    # Monthly marts: build only from this month on, as after a load that touched no older one.
    from_month: dt.date | None = None

    @classmethod
    def from_variables(
        cls, variables: Mapping[str, str], as_of: dt.date, *, team_key: str = "helpdesk_team_id"
    ) -> MartParams:
        """Read the string-valued job variables; a missing one keeps its default.

        ``team_key`` is the full name of the variable with the helpdesk team.
        """
        defaults = cls(as_of=as_of)
        team = variables.get(team_key)
        return cls(
            as_of=as_of,
            excluded_company_ids=parse_id_list(variables.get("excluded_company_ids", "[]")),
            dead_stock_days=int(variables.get("dead_stock_days", defaults.dead_stock_days)),
            anomaly_pct=float(variables.get("anomaly_pct", defaults.anomaly_pct)),
            otif_threshold=float(variables.get("otif_threshold", defaults.otif_threshold)),
            abc_a_pct=float(variables.get("abc_a_pct", defaults.abc_a_pct)),
            abc_b_pct=float(variables.get("abc_b_pct", defaults.abc_b_pct)),
            abc_c_pct=float(variables.get("abc_c_pct", defaults.abc_c_pct)),
            forecast_scope=variables.get("forecast_top_n_or_only_class_a", defaults.forecast_scope),
            full_refresh_models=parse_model_list(variables.get("full_refresh_models", "[]")),
            alert_email=variables.get("procurement_manager_email", ""),
            helpdesk_team_id=int(team) if team else None,
        )

    def sql_args(self) -> dict[str, object]:
        """The named parameters for ``spark.sql(text, args=...)``."""
        return {
            "as_of": self.as_of,
            "dead_stock_days": self.dead_stock_days,
            "anomaly_pct": self.anomaly_pct,
            "otif_threshold": self.otif_threshold,
            "abc_a_pct": self.abc_a_pct,
            "abc_b_pct": self.abc_b_pct,
        }


def parse_id_list(text: str) -> tuple[int, ...]:
    """A JSON list of ids; anything malformed counts as no ids."""
    try:
        return tuple(int(value) for value in json.loads(text))
    except (ValueError, TypeError):
        return ()


def parse_model_list(text: str) -> frozenset[str]:
    """A JSON list of model names, or the names separated by commas."""
    try:
        values = json.loads(text)
    except (ValueError, TypeError):
        values = None
    if isinstance(values, list):
        return frozenset(value for value in values if isinstance(value, str))
    return frozenset(part.strip() for part in str(text).split(",") if part.strip())
