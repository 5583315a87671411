"""Metrics of an executed plan, read from its nodes."""


def nodes(df):
    """Every node of the final plan, subqueries left out."""

    def walk(node):
        kind = node.getClass().getSimpleName()
        yield kind, node
        if kind == "AdaptiveSparkPlanExec":
            yield from walk(node.executedPlan())
            return
        if kind.endswith("QueryStageExec"):
            yield from walk(node.plan())
            return
        children = node.children()
        for k in range(children.size()):
            yield from walk(children.apply(k))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def metric(df, kind: str, name: str) -> list[int]:
    """One value a node of ``kind`` that has the metric."""
    found = [node.metrics().get(name) for k, node in nodes(df) if k == kind]
    return [m.get().value() for m in found if m.isDefined()]
