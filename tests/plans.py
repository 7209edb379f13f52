"""Plan text helpers."""


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_text(df):
    df.collect()
    return ran_plan_text(df)


def ran_plan_text(df):
    """What ran in a collected frame: the plan after adaptive changes, without the plans it started from."""
    kept, skip_from = [], None
    for line in plan_text(df).splitlines():
        indent = len(line) - len(line.lstrip(" :+-"))
        if skip_from is not None and indent >= skip_from:
            continue
        skip_from = None
        if "== Initial Plan ==" in line:
            skip_from = indent
            continue
        kept.append(line)
    return "\n".join(kept)


def files_read(df):
    """How many files each scan of a collected frame read, subqueries included."""
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numFiles").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            left.append(node.executedPlan())
        elif hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            left.append(node.plan())
        for group in (node.children(), node.subqueries()):
            left += [group.apply(i) for i in range(group.size())]
    return found
