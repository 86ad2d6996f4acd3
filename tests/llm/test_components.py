from meterflow.llm import common
from meterflow.llm.components import components


def test_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, j) for j in range(6, 40)]
    links += [(7, 7), (200, 201), (201, 202), (202, 200), (39, 38)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(frame).collect()}
    assert {found[i] for i in range(101, 161)} == {100}
    assert {found[j] for j in range(6, 40)} == {5}
    assert found[201] == found[202] == 200 and 200 not in found


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeats_missing_nodes_and_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "PART_ROWS", 3)
    links = [(1, j) for j in range(50, 80)] * 2 + [(j, 1) for j in range(60, 90)]
    links += [(None, 4), (4, None), (None, None), (300, 301), (301, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{j: 1 for j in range(50, 90)}, 301: 300}
