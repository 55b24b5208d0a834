"""Counting the operators of an executed plan."""

from __future__ import annotations

from collections import Counter


def _walk(node, seen: Counter) -> None:
    name = node.getClass().getSimpleName()
    if name.startswith("Reused"):
        seen[name] += 1
        return
    if name == "AdaptiveSparkPlanExec":
        _walk(node.executedPlan(), seen)
        return
    if name.endswith("QueryStageExec"):
        _walk(node.plan(), seen)
        return
    seen[name] += 1
    if name == "SortMergeJoinExec" and node.isSkewJoin():
        seen["skew"] += 1
    for children in (node.children(), node.subqueries()):
        it = children.iterator()
        while it.hasNext():
            _walk(it.next(), seen)


def executed(df) -> Counter:
    """Class names of the nodes that ran, after an action on `df`.

    Reused exchanges and subqueries are counted as such and not entered, so
    FileSourceScanExec is the number of times a table was read.
    """
    seen: Counter = Counter()
    _walk(df._jdf.queryExecution().executedPlan(), seen)
    return seen
