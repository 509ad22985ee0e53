"""Newick trees as node rows."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"\s*(?:(\[[^\]]*\]|'[^']*')|([(),;])|(:|#|\$|@|=)?\s*([^\s(),:;#$@=\[\]']+))")
MARKS = {":": "length", "#": "label", "$": "clade", "@": "age", "=": "age"}


@dataclass
class Node:
    node_id: int
    father: int | None
    name: str | None = None
    length: float | None = None
    label: float | None = None
    clade: float | None = None
    age: float | None = None
    annotation: str | None = None
    sons: list[int] = field(default_factory=list)


def parse_newick(text: str) -> list[Node]:
    """Nodes in order of appearance, the root first. Names may be numbers; :length #label $clade @age 'annotation' follow a node."""
    nodes = [Node(0, None)]
    at, text = 0, text.strip().rstrip(";")
    for m in TOKEN.finditer(text):
        quoted, sign, mark, word = m.groups()
        if quoted:
            nodes[at].annotation = quoted[1:-1]
        elif sign in ("(", ","):
            father = at if sign == "(" else nodes[at].father
            if father is None:
                raise ValueError("a comma outside the root")
            nodes.append(Node(len(nodes), father))
            nodes[father].sons.append(len(nodes) - 1)
            at = len(nodes) - 1
        elif sign == ")":
            if nodes[at].father is None:
                raise ValueError("unbalanced parentheses")
            at = nodes[at].father
        elif word is not None:
            if mark:
                setattr(nodes[at], MARKS[mark], float(word))
            elif nodes[at].name is None and "{" not in word[:1]:
                nodes[at].name = word.split("{")[0]
    if at:
        raise ValueError("unbalanced parentheses")
    return nodes


def to_newick(nodes: list[Node], at: int = 0) -> str:
    n = nodes[at]
    inner = f"({','.join(to_newick(nodes, s) for s in n.sons)})" if n.sons else ""
    return inner + (n.name or "") + (f":{n.length:g}" if n.length is not None else "") + ("" if at else ";")


def tree_rows(texts: DataFrame, id_col: str = "tree_id", text_col: str = "newick") -> DataFrame:
    """(tree_id, node_id, father_id, name, branch_length, age, label, annotation, is_tip) of every tree; each is read in its row's task."""
    kind = texts.schema[id_col].dataType.simpleString()
    schema = "array<struct<node_id:int,father_id:int,name:string,branch_length:double,age:double,label:double,annotation:string,is_tip:boolean>>"

    @F.udf(schema, useArrow=True)
    def parsed(text):
        return [(n.node_id, n.father, n.name, n.length, n.age, n.label, n.annotation, not n.sons) for n in parse_newick(text)] if text else []

    rows = texts.select(F.col(id_col).cast(kind).alias("tree_id"), F.explode(parsed(text_col)).alias("n"))
    return rows.select("tree_id", "n.*")
