"""Components of small graphs, and how much work they take."""

import random

import pytest

from strata.llm import components


@pytest.mark.parametrize("few", [0, 1_000])
def test_components_with_few_and_many_links(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW_LINKS", few)
    r = random.Random(few)
    edges = [(r.randrange(150), r.randrange(150)) for _ in range(90)] + [(k, k + 1) for k in range(200, 230)] + [(240 - k, 240) for k in range(9)]
    name = {v: v for e in edges for v in e if e[0] != e[1]}
    for _ in name:
        for a, b in edges:
            if a != b:
                name[a] = name[b] = min(name[a], name[b])
    df = spark.createDataFrame(edges + edges[:20], "a bigint, b bigint")
    assert {(r["node"], r["comp"]) for r in components.connected_components(df).collect()} == set(name.items())


def test_components_settle_without_another_round(spark, monkeypatch):
    """A star is settled after one round, and that is seen by one aggregate."""
    made, plain = [], components.stored
    monkeypatch.setattr(components, "stored", lambda rows, label: made.append(label) or plain(rows, label))
    star = spark.createDataFrame([(0, k) for k in range(1, 40)], "a bigint, b bigint")
    assert {tuple(r) for r in components.connected_components(star).collect()} == {(k, 0) for k in range(40)}
    assert len(made) <= 4
    assert components.connected_components(star.limit(0)).count() == 0
