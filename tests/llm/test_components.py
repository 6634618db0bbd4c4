import random

import pytest

from gridframe.llm import components


def smallest_reachable(links):
    label = {node: node for link in links for node in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("task_rows, sent_hooks", [(components.TASK_ROWS, components.SENT_HOOKS), (7, 0)])
def test_components_by_broadcast_and_by_shuffle(spark, monkeypatch, task_rows, sent_hooks):
    monkeypatch.setattr(components, "TASK_ROWS", task_rows)
    monkeypatch.setattr(components, "SENT_HOOKS", sent_hooks)
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(0, 40)]
    links = [*chain, (100, 100), (-5, 200), (200, 201), *[(rng.randint(300, 360), rng.randint(300, 360)) for _ in range(45)], (200, -5)]
    rng.shuffle(links)
    found = components.connected_components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint"))
    rows = [tuple(row) for row in found.collect()]
    assert len(rows) == len(set(rows)) and dict(rows) == smallest_reachable(links)


def test_no_links(spark):
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
