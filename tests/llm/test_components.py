import random

import pytest

from tunelake.llm.components import components, merged


def plain(links):
    root = {}

    def top(node):
        while root.setdefault(node, node) != node:
            node = root[node]
        return node

    for a, b in links:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {node: top(node) for node in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_classes_equal_those_of_all_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(500, 500)]
    frame = lambda some: spark.createDataFrame(some, "a long, b long")
    classes = components(frame(links[:40]))
    assert {r.node: r.root for r in classes.collect()} == plain(links[:40])
    found = merged(classes, frame(links[40:])).collect()
    assert len(found) == len({r.node for r in found}) and {r.node: r.root for r in found} == plain(links)
    assert {r.node: r.root for r in merged(classes, frame(links[:10])).collect()} == plain(links[:40])
