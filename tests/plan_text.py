"""Reading physical plans that have not run yet."""


def own_operators(frame) -> list[str]:
    """One line per operator; what once filled a cache is not part of the plan."""
    lines = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
            return
        lines.append(node.simpleString(1000))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(frame._jdf.queryExecution().executedPlan())
    return lines


def count(frame, name: str) -> int:
    return sum(line.startswith(name) for line in own_operators(frame))
