"""Numbers from an executed plan: every exchange once, reused ones left out."""


def nodes(plan):
    """The operators of a final plan, down through query stages and into subqueries."""
    out, todo = [], [plan]
    while todo:
        p = todo.pop()
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
            continue
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec", "TableCacheQueryStageExec"):
            todo.append(p.plan())
            continue
        out.append((name, p))
        if name == "ReusedExchangeExec":
            continue
        for seq in (p.children(), p.subqueries()):
            todo += [seq.apply(i) for i in range(seq.size())]
        if name in ("SubqueryExec", "SubqueryAdaptiveBroadcastExec"):
            todo.append(p.child())
    return out


def executed(df):
    """Collect ``df`` and return its rows and operators."""
    rows = df.collect()
    return rows, nodes(df._jdf.queryExecution().executedPlan())


def shuffled_records(ops) -> int:
    """Records written by all hash exchanges."""
    total = 0
    for name, p in ops:
        if name == "ShuffleExchangeExec" and "hashpartitioning" in p.outputPartitioning().toString():
            total += p.metrics().apply("shuffleRecordsWritten").value()
    return total
