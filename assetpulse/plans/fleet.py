"""The whole job: screening decides which assets get facts, facts become model input, and every asset left out has a cause."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assetpulse.constants import ASSET
from assetpulse.functions import as_date, numbers_filled
from assetpulse.operators import model
from assetpulse.operators import signals as sig
from assetpulse.plans import screening
from assetpulse.plans.daily_facts import FactSettings, FactSources, daily_facts

#: Flags of the status table in the order in which the first that applies is the cause, and the causes.
SCREEN_CAUSES = {
    "inactive": "not active",
    "manual_only": "log status manual",
    "irregular": "irregular work",
    "too_few_rows": "too few work rows",
    "future_install": "install date in the future",
}


@dataclass(frozen=True)
class Fleet:
    """Sources whose valid list is the screening's, and the screening's status table."""

    status: DataFrame
    sources: FactSources
    as_of: dt.date | str

    def valid(self) -> DataFrame:
        return screening.valid_assets(self.status)

    def facts(self, settings: FactSettings | None = None) -> DataFrame:
        return daily_facts(self.sources, self.as_of, settings)

    def dropped(self) -> DataFrame:
        return dropped_ledger(self.status, self.sources, self.as_of)


def screen_fleet(
    sources: FactSources,
    life_events: DataFrame,
    as_of: dt.date | str,
    settings: screening.ScreenSettings | None = None,
) -> Fleet:
    """Screens the assets of the fact sources; facts are then built for valid assets alone."""
    status = screening.asset_status(sources.work, sources.assets, life_events, as_of, settings)
    return Fleet(status, replace(sources, valid=screening.valid_assets(status)), as_of)


def dropped_ledger(status: DataFrame, sources: FactSources, as_of: dt.date | str) -> DataFrame:
    """(asset, cause): every asset of the master or with work that has no facts, with the first cause that applies.

    First the screening's reasons, then what a fact needs: work up to as_of, a master row with an install day up to as_of, and
    a device row where devices are given. All of it is one pass over the per-asset status table."""
    master = sig.install_signal(sources.assets).select(ASSET, "installed", "product_identifier")
    known = status.join(master, ASSET, "left")
    cause = F.lit(None).cast("string")
    worked = F.coalesce(F.col("first_date") <= as_date(as_of), F.lit(False))
    needs = [
        (~worked, "no work"),
        (~F.col("in_master"), "not in master"),
        (F.col("installed").isNull(), "no install date"),
        (F.col("installed") > as_date(as_of), "installed after as_of"),
    ]
    if sources.asset_features is not None:
        devices = sources.asset_features.select("product_identifier").dropna().distinct().withColumn("device", F.lit(True))
        known = known.join(devices, "product_identifier", "left")
        needs.append((F.col("device").isNull(), "no device row"))
    for failed, name in reversed([*[(F.col(flag), name) for flag, name in SCREEN_CAUSES.items()], *needs]):
        cause = F.when(failed, name).otherwise(cause)
    return known.select(ASSET, cause.alias("cause")).filter(F.col("cause").isNotNull())


def prepared_facts(
    sources: FactSources,
    security_map: DataFrame,
    model_map: DataFrame,
    as_of: dt.date | str,
    last_date: dt.date | str,
    first_date: dt.date | str = model.FIRST_DATE,
    settings: FactSettings | None = None,
) -> DataFrame:
    """Model input as model.prepare gives it, with names encoded once per device instead of once per fact row: the maps are joined
    to the device table, a row per product, before it meets the states; nothing is joined to days."""
    coded = replace(sources, asset_features=model.encode_devices(sources.asset_features, security_map, model_map))
    ranged = replace(settings or FactSettings(), first_date=first_date, last_date=last_date)
    return numbers_filled(daily_facts(coded, as_of, ranged).drop("day_to_failure"))
