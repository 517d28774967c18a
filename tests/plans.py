"""Walk an executed plan: which operators really ran, reused exchanges left out."""

from collections import Counter


def executed_operators(df):
    """Node names of the final plan after running ``df``, subqueries included."""
    return Counter(node.getClass().getSimpleName() for node in _executed(df))


def scanned(df):
    """The folders and files that the final plan read, once for each scan."""
    return [
        node.relation().location().rootPaths().apply(0).toString()
        for node in _executed(df)
        if node.getClass().getSimpleName() == "FileSourceScanExec"
    ]


def rows_made(df, name):
    """Rows that each operator of a name made in the final plan."""
    return [
        node.metrics().apply("numOutputRows").value()
        for node in _executed(df)
        if node.getClass().getSimpleName() == name
    ]


def _executed(df):
    df.collect()
    names = []
    seen = set()

    def children(seq):
        return [seq.apply(i) for i in range(seq.size())]

    def walk(node):
        name = node.getClass().getSimpleName()
        if name in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            names.append(node)
            return
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
            return
        if name.endswith("QueryStageExec"):
            walk(node.plan())
            return
        names.append(node)
        for sub in children(node.subqueries()):
            # One subquery may hang on several nodes; it runs once.
            if sub.id() not in seen:
                seen.add(sub.id())
                walk(sub)
        for child in children(node.children()):
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return names


def nested_loops(operators):
    return operators["CartesianProductExec"] + operators["BroadcastNestedLoopJoinExec"]
