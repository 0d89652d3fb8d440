from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from panelkit import Panel  # noqa: E402
from panelkit.session import build_session  # noqa: E402
from panelkit.sources.panel_csv import CSV_COLUMNS, read_panel  # noqa: E402

HEADER = ",".join(CSV_COLUMNS)

# date, cases, deaths, entity, population, area, rate
ROWS = [
    ("30/12/2019", "10", "1", "Alpha_Land", "1000", "Europe", "1.5"),
    ("01/01/2020", "20", "2", "Alpha_Land", "1000", "Europe", "2.5"),
    ("01/01/2021", "30", "3", "Alpha_Land", "1000", "Europe", ""),
    ("01/01/2020", "", "5", "Alpha_Land", "1000", "Europe", "x"),
    ("02/01/2020", "abc", "1", "Beta", "", "Asia", "4"),
    ("02/01/2020", "60", "6", "Beta", "", "Asia", "6"),
    ("31/02/2020", "7", "0", "Beta", "", "Asia", "8"),
    ("", "1", "0", "Beta", "", "Asia", ""),
    ("03/01/2020", "0", "0", "Quiet", "0", "Asia", "0"),
    ("03/01/2020", "68", "4", "Curaçao", "500", "America", "9"),
    ("03/01/2020", "5", "1", "Bonaire, Saint Eustatius and Saba", "20", "America", ""),
    ("04/01/2020", "2", "0", "", "20", "America", "1"),
]


def csv_line(row):
    date, cases, deaths, entity, pop, area, rate = row
    entity = f'"{entity}"' if "," in entity else entity
    return ",".join([date, "", "", "", cases, deaths, entity, "", "", pop, area, rate])


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def csv_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("panel") / "data.csv"
    path.write_text("\n".join([HEADER, *map(csv_line, ROWS)]) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="session")
def panel(spark, csv_path) -> Panel:
    return read_panel(spark, csv_path)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def as_dict(df, key, *values):
    found = {r[key]: tuple(r[v] for v in values) for r in df.collect()}
    return {k: v[0] if len(v) == 1 else v for k, v in found.items()}
