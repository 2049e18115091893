"""The declared tables: names, types, order, comments, keys."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import types as T

from flowaudit.schemas import TABLES, counter_columns

FIXTURES = Path(__file__).resolve().parents[1] / "FIXTURES.md"
SPARK_NAMES = {
    T.LongType(): "bigint",
    T.StringType(): "string",
    T.TimestampType(): "timestamp",
    T.DecimalType(38, 9): "decimal(38,9)",
    T.BooleanType(): "boolean",
}


def declared() -> dict[str, list[tuple[str, str]]]:
    text = FIXTURES.read_text().split("## 2.")[0]
    tables = {}
    for block in re.split(r"\n### ", text)[1:]:
        name = re.match(r"`(\w+)`", block).group(1)
        tables[name] = re.findall(r"`(\w+) ([\w(),]+)`@\d+", block)
    return tables


def test_twelve_tables_and_182_columns():
    assert len(TABLES) == 12
    assert sum(len(t.columns) for t in TABLES.values()) == 182


@pytest.mark.parametrize("name", list(TABLES))
def test_columns_match_the_blueprint(name):
    ours = [(f.name, SPARK_NAMES[f.dataType]) for f in TABLES[name].schema]
    assert ours == declared()[name]


def test_all_columns_are_nullable():
    assert all(f.nullable for t in TABLES.values() for f in t.schema)


def test_documented_columns():
    documented = [f for t in TABLES.values() for f in t.schema if f.metadata.get("comment")]
    assert len(documented) == 136


def test_declared_keys():
    assert sum(t.key_declared for t in TABLES.values()) == 7
    for table in TABLES.values():
        assert table.row_id == table.columns[0]
        assert set(table.natural_key) <= set(table.columns)


def test_counter_order():
    assert counter_columns()[:3] == [
        "src_num_of_deletes", "tgt_num_of_deletes", "diff_num_of_deletes",
    ]
    assert len(counter_columns()) == 15
