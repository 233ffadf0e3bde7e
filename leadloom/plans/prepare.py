"""From the raw customer-month panel to a tagged, cleaned, imputed and encoded table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadloom.functions.names import UNEXPLAINED_PARTS
from leadloom.operators import columns as cols


@dataclass(frozen=True)
class Roles:
    """Column roles; ``ids`` are kept out of encoding and dropping."""

    ids: tuple[str, ...] = ("customerseqid", "monthyearid", "target_flag")
    target: str = "target_flag"
    time: str = "monthyearid"
    customer: str = "customerseqid"

    @property
    def protected(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*self.ids, self.target, self.time, self.customer, "holdout", "for_scoring"]))


@dataclass(frozen=True)
class PanelPrep:
    """What the panel taught: constant columns, levels and fill values."""

    roles: Roles
    holdout_periods: int
    constant: tuple[str, ...]
    encoder: cols.OneHot
    fill: cols.StatFill

    @classmethod
    def fit(cls, panel: DataFrame, roles: Roles = Roles(), holdout_periods: int = 2, date_part: str = "days_",
            strategy: str = "max", max_levels: int | None = None) -> PanelPrep:
        """Two passes: one for all statistics, one for the levels of the text columns."""
        panel = panel.drop("hid")
        kept = cols.drop_timestamps(panel).columns
        text = [c for c in cols.text_columns(panel) if c not in roles.ids]
        dated = [c for c in cols.numeric_columns(panel) if date_part in c]
        candidates = [c for c in panel.columns if c not in roles.protected]
        wanted = [cols.is_constant(panel, c).alias(f"constant {c}") for c in candidates]
        if strategy != "zeroes":
            wanted += [cols.fill_statistic(cols.without_sentinels(panel, c), strategy).alias(f"fill {c}") for c in dated]
        found = cols.one_row(panel, wanted)
        constant = tuple(c for c in candidates if found[f"constant {c}"])
        text = [c for c in text if c not in constant]
        dated = [c for c in dated if c not in constant and c in kept]
        filled = cols.null_sentinels(panel.select(*[cols.quoted(c) for c in text])).fillna(cols.MISSING_LEVEL) if text else panel
        encoder = cols.OneHot.fit(filled, text, max_levels)
        values = {c: 0 if strategy == "zeroes" else found[f"fill {c}"] for c in dated}
        fill = cols.StatFill({c: v for c, v in values.items() if v is not None})
        return cls(roles, holdout_periods, constant, encoder, fill)

    def transform(self, panel: DataFrame) -> DataFrame:
        tagged = cols.tag_latest_periods(panel.drop("hid"), self.roles.time, self.holdout_periods)
        clean = cols.drop_timestamps(cols.null_sentinels(tagged.drop(*self.constant)))
        text = list(self.encoder.levels)
        filled = clean.fillna(cols.MISSING_LEVEL, subset=[cols.quoted(c) for c in text]) if text else clean
        wide = self.encoder.transform(filled)
        return cols.drop_unexplained(cols.fill_zero(self.fill.transform(wide)), UNEXPLAINED_PARTS)


def prepare_panel(panel: DataFrame, roles: Roles = Roles(), **options: object) -> DataFrame:
    """Fit and apply in one step."""
    return PanelPrep.fit(panel, roles, **options).transform(panel)
