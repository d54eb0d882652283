"""Fitted tree ensembles as tables and columns: scoring needs no model object, and others can read the same nodes."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: tree and its weight; node, numbered as in a heap (children of i are 2i and 2i + 1, the root is 1); feature and
#: threshold of a split (values up to it go left), or the value of a leaf.
NODES = "tree int, weight double, node long, feature string, threshold double, value double"
#: How a fitted ensemble describes itself, a line a branch.
TREE, BRANCH, LEAF = re.compile(r"Tree (\d+) \(weight (\S+)\)"), re.compile(r"(If|Else) \(feature (\d+) (<=|>) (\S+)\)"), re.compile(r"Predict: (\S+)")


def nodes_of(model, features: list[str]) -> list[tuple]:
    """The nodes of a fitted pyspark.ml ensemble over numeric features, as rows of NODES."""
    out, tree, weight, path = [], 0, 1.0, []
    for line in model.toDebugString.splitlines():
        depth = len(line) - len(line.lstrip())
        if found := TREE.search(line):
            tree, weight, path = int(found[1]), float(found[2]), []
        elif found := BRANCH.search(line):
            path = [p for p in path if p[0] < depth]
            node = 1
            for _, side in path:
                node = 2 * node + side
            if found[1] == "If":
                out.append((tree, weight, node, features[int(found[2])], float(found[4]), None))
            path.append((depth, 0 if found[1] == "If" else 1))
        elif found := LEAF.search(line):
            path = [p for p in path if p[0] < depth]
            node = 1
            for _, side in path:
                node = 2 * node + side
            out.append((tree, weight, node, None, None, float(found[1])))
    return out


def node_table(spark: SparkSession, nodes: list[tuple]) -> DataFrame:
    return spark.createDataFrame(nodes, NODES)


def score(nodes: list[tuple]) -> Column:
    """The ensemble's weighted sum, as one expression of the features' columns; NULL features count as greater than any
    threshold. Trees are added in their order."""
    by_tree: dict[int, dict[int, tuple]] = {}
    for row in nodes:
        by_tree.setdefault(row[0], {})[row[2]] = row

    def branch(tree: dict[int, tuple], node: int) -> Column:
        _, _, _, feature, threshold, value = tree[node]
        if feature is None:
            return F.lit(float(value))
        left = F.col(feature).cast("double") <= F.lit(float(threshold))
        return F.when(left, branch(tree, 2 * node)).otherwise(branch(tree, 2 * node + 1))

    parts = [branch(by_tree[t], 1) * F.lit(by_tree[t][1][1]) for t in sorted(by_tree)]
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def probability(nodes: list[tuple]) -> Column:
    """The probability that a boosted classifier gives its positive class."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * score(nodes)))
