"""Every query with SQL gives the same rows in DuckDB."""

import pytest
from compare import compare, connect

from segloom.plans import registry

registry.load()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_names_match():
    assert set(registry.ORACLE) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_rows(spark, sf, con, name):
    same, _, message = compare(spark, con, sf, name, registry.QUERIES[name], registry.ORACLE[name])
    assert same, message


SLOW = {"variant_grid", "catalogue_cells", "streamed_assignment", "forest_scores", "batch_assignment", "cluster_predictions", "k_sweep", "kmeans_best", "assigned_rows"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE) - SLOW))
def test_gives_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0
