"""The panel binding: which column of a DataFrame plays which role."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

RATE_COLUMN = "Cumulative_number_for_14_days_of_COVID-19_cases_per_100000"


@dataclass(frozen=True)
class Panel:
    """An entity-by-date table. The defaults are the column names of the daily surveillance CSV."""

    df: DataFrame
    date: str = "dateRep"
    entity: str = "countriesAndTerritories"
    area: str = "continentExp"
    cases: str = "cases"
    deaths: str = "deaths"
    pop: str = "popData2019"
    rate: str = RATE_COLUMN

    @property
    def measures(self) -> tuple[str, str]:
        return (self.cases, self.deaths)

    def using(self, df: DataFrame, **roles: str) -> Panel:
        """The same binding over another DataFrame, with some roles re-bound."""
        return replace(self, df=df, **roles)

    def where(self, condition) -> Panel:
        return self.using(self.df.filter(condition))
