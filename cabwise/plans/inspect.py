"""Physical-plan inspection: the reference prints plans to compare join
strategies; here the plan is also available as text and as the name of the
join operator, so tests and reports can assert on it."""

from __future__ import annotations

import contextlib
import io
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

JOIN_NODES = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
              "BroadcastNestedLoopJoin", "CartesianProduct")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` would print (initial plan under AQE)."""
    qe = df._jdf.queryExecution()
    if mode == "formatted":
        return qe.explainString(_explain_mode(df, "formatted"))
    return qe.executedPlan().toString()


def _explain_mode(df: DataFrame, name: str):
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.execution.ExplainMode.fromString(name)


def join_nodes(df: DataFrame) -> list[str]:
    """Join operators of the physical plan, outermost first."""
    text = plan_text(df, "simple")
    return [m.group(1) for m in re.finditer(r"(%s)" % "|".join(JOIN_NODES), text)]


def join_node(df: DataFrame) -> str | None:
    nodes = join_nodes(df)
    return nodes[0] if nodes else None


def has_node(df: DataFrame, name: str) -> bool:
    return name in plan_text(df, "simple")


def python_udf_nodes(df: DataFrame) -> list[str]:
    text = plan_text(df, "simple")
    return re.findall(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", text)


def exchanges(df: DataFrame) -> list[tuple[str, list[str]]]:
    """(partitioning, output column names) of every shuffle exchange in the
    physical plan, subqueries included: what each shuffle actually moves."""
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":      # its initial plan holds the exchanges
            stack.append(node.initialPlan())
            continue
        if name == "ShuffleExchangeExec":
            cols = node.output()
            found.append((node.outputPartitioning().toString(),
                          [cols.apply(i).name() for i in range(cols.size())]))
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
        subqueries = node.subqueries()
        stack.extend(subqueries.apply(i) for i in range(subqueries.size()))
    return found


# ---------------------------------------------------------------- from the printed plan alone

@dataclass
class PlanNode:
    """An operator of a printed plan: its name, what stands behind it, and its inputs."""

    name: str
    details: str
    children: list[PlanNode] = field(default_factory=list)

    def walk(self):
        """This operator and all below it, outermost first."""
        yield self
        for child in self.children:
            yield from child.walk()


def printed_plan(df: DataFrame) -> str:
    """What ``df.explain()`` prints. Needs no JVM handle, so that it serves frames
    of a remote session too."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


#: A line of a printed tree: the branches of outer levels, its own branch, a codegen stage, the operator.
_LINE = re.compile(r"^(?P<lead>(?:[: ]  )*)(?P<branch>[:+]- )?(?:\*\(\d+\) |\* )?(?P<name>[A-Za-z]\w*)(?P<details>.*)$")


def parse_plan(text: str) -> list[PlanNode]:
    """The trees of an explained plan: the plan itself, and any that are printed
    beside it (initial plans, subqueries). Lines that aren't operators are part
    of the details of the one before."""
    roots: list[PlanNode] = []
    path: list[tuple[int, PlanNode]] = []
    for line in text.splitlines():
        if line.startswith("==") or not line.strip():
            path = [] if line.startswith("== Physical") else path
            continue
        found = _LINE.match(line)
        depth = len(found["lead"]) // 3 + bool(found["branch"]) if found else 0
        if not found or (path and not found["branch"]):
            if path:
                path[-1][1].details += "\n" + line
            continue
        node = PlanNode(found["name"], found["details"].strip())
        while path and path[-1][0] >= depth:
            path.pop()
        if path:
            path[-1][1].children.append(node)
        else:
            roots.append(node)
        path.append((depth, node))
    return roots


def plan_nodes(df: DataFrame) -> list[PlanNode]:
    """All operators of the printed plan, outermost first."""
    return [node for root in parse_plan(printed_plan(df)) for node in root.walk()]


def printed_join_nodes(df: DataFrame) -> list[str]:
    """Join operators of the printed plan, outermost first."""
    return [n.name for n in plan_nodes(df) if n.name in JOIN_NODES]


def printed_exchanges(df: DataFrame) -> list[str]:
    """The partitioning of every shuffle of the printed plan."""
    return [n.details for n in plan_nodes(df) if n.name == "Exchange"]
