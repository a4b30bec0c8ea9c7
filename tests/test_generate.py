"""Properties of generated rows."""

import pytest
from pyspark.sql import functions as F

from quotaloom.plans import generate as G

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return G.generated(spark, SF).toPandas()


def test_counts_are_exact(spark, rows):
    want = {r.cell: r.target for r in G.cells(spark, SF).collect()}
    for cell, n in rows.groupby("seed_cell").size().items():
        assert n == want[cell]


def test_texts(rows):
    assert not rows.text.str.contains(r"[0-9{}]|  ").any()
    assert (rows.text == rows.text.str.strip()).all()
    assert rows.id.is_unique


def test_no_pair_of_template_and_entity_repeats_early(rows):
    assert rows.groupby(["seed_cell", "entity_id", "template_id"]).size().max() <= rows.groupby(["seed_cell", "entity_id"]).size().max() / 2 + 1


def test_audit_columns_tell_the_text(rows):
    legacy = rows[rows.name_variant == "legacy"]
    assert legacy.province_legacy.notna().all() and rows[rows.name_variant != "legacy"].province_legacy.isna().all()
    assert all(a.lower() in t.lower() for a, t in zip(legacy.province_legacy, legacy.text))


def test_cells_are_independent(spark, rows):
    one = rows.seed_cell.iloc[0]
    alone = G.G.generate(G.cells(spark, SF).filter(F.col("cell") == one), G.pool(spark, SF), G.bank(spark), G.G.alias_candidates(G.aliases(spark, SF), G.provinces(spark, SF)), G.STYLE).toPandas()
    assert sorted(alone.text) == sorted(rows[rows.seed_cell == one].text)
